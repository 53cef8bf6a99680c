"""Main text of web pages by equivalence-class template deduction.

Pages of a host come from templates.  A page is read as tokens: its block
tags in their role (the path of open blocks, with classes) and its text
blocks in theirs.  Tokens of a host that occur equally often on every page
have the same occurrence vector; they form an equivalence class.  Classes that
are frequent and keep their order are valid; the class of tokens that occur
once a page is the root of the template, the others (list items, cells)
nest in the gaps between its tokens.  What lies in the gaps is data.  The
main text is the data of the gaps that the template's own markup declares as
article or, without such markup, the data of all gaps that are not navigation,
advert, form, notice, comment or the like.  Template text is data in neither;
only where it is more than half of an article's text is the page a near copy
of the others, and the article stays whole.

Occurrence vectors are never gathered: a vector is a sum over pages of a hash
of (page, count), so classes come from two aggregates by (host, token) and
(host, vector), combined map-side, however many pages a host has.  A host's
template is bounded by the tokens of two average pages.  Pages meet their
template by host.  Rows of equal html on a host are one page of its template:
rows of (host, page digest, tokens) meet by host and are counted there once
each, so what one page only says leaves no task; hosts with more than a thousandth of all pages (at most a
thousand, hence broadcast) are salted.

Cases: null html and pages without text give an empty text; a null url is a
host of its own; hosts of fewer than `MIN_PAGES` pages, and pages that break
the order of their template, are read by their own markup; repeated rows and
ids are pages each; ties between classes go to the larger, then the smaller
vector; very long pages are read whole; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from emolens.llm.common import text_or_empty, written

MIN_PAGES, SUPPORT = 3, 0.5
#: A host with more than this share of all pages is salted.
HOT_SHARE = 0.001
PAGES_PER_SALT = 5_000

#: The HTML elements of each kind.
BLOCKS = frozenset("html head body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody "
                   "tfoot tr td th blockquote pre address figure figcaption header footer nav aside form fieldset legend "
                   "details summary menu dialog hr title center noscript template button select option textarea iframe "
                   "object svg math canvas audio video label".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Containers whose text is never main text.
APART = frozenset("head nav footer aside form menu dialog noscript template button select textarea iframe object svg math "
                  "canvas audio video title".split())
MAIN = frozenset(("article", "main"))
#: Words of class, id and role names that say the same of any other block.
APART_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored sidebar side menu nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe subscription share sharing social related recommended recommendations comment comments disqus "
    "reply replies respond widget widgets pagination pager toolbar login signup signin search skip complementary contentinfo".split())
#: Of them, names of places whose articles are not the page's own.
ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored sidebar side menu nav navbar navigation "
    "breadcrumb breadcrumbs footer related recommended recommendations comment comments disqus reply replies respond widget widgets "
    "complementary contentinfo".split())
#: Words that leave the meaning of such a name: "ad-slot", "site-header".
NEUTRAL = frozenset("site page top bottom left right primary secondary global main box block wrap wrapper container area list item items section "
                    "bar inner outer unit slot group panel links posts articles stories form title text icons buttons button".split())
HARD, SOFT, FREE = 2, 1, 0
COMMENT_NAMES = frozenset("comment comments reply replies respond".split())
CLOSES_P = BLOCKS - frozenset(("html", "head", "body", "title", "button", "label", "select", "option", "iframe", "object", "svg",
                               "math", "canvas", "audio", "video", "noscript", "template", "textarea"))
#: A start tag that ends an open one of the same group.
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"),
        "option": ("option",)}
BOUNDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"),
          "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(script|style)\b(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"""
                  r"""|<(/?)([a-z][a-z0-9:-]*+)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-z][a-z0-9:-]*+)([^>]*+)>|<[!?/][^>]*+>""",
                  re.S | re.I)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPLIT = re.compile(r"[^a-z]+")


@dataclass(slots=True)
class Block:
    """A run of text between block tags."""

    path: str
    apart: int
    main: bool
    gap: int
    pieces: list[str] = field(default_factory=list)

    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


def _labels(attributes: str) -> tuple[str, list[set[str]]]:
    """The names in a tag's label, and each name's words."""
    found = [(a or b or c).lower() for _, a, b, c in _NAMES.findall(attributes)] if attributes else []
    words = [w for x in found for name in x.split() if (w := {y for y in _SPLIT.split(name) if y})]
    return " ".join(re.sub(r"\d+", "0", x) for x in found), words


def _apart(names: list[set[str]], main: bool) -> int:
    """How far whole names put a block apart: every word of one must say so or
    be neutral ("no-sidebar", "content-sidebar-wrap", "entry-header" do not)."""
    level = FREE
    for words in names:
        said = words & APART_NAMES
        if said and words <= APART_NAMES | NEUTRAL and not (main and said <= {"header", "masthead"}):
            level = max(level, HARD if said & ASIDE_NAMES else SOFT)
    return level


def _comment(names: list[set[str]]) -> bool:
    return any(words & COMMENT_NAMES and words <= COMMENT_NAMES | NEUTRAL for words in names)


def read_page(page: str) -> tuple[list[Block], list[str]]:
    """Text blocks in page order, and the page's tag tokens in order; a
    block's ``gap`` is the number of tag tokens before it."""
    stack: list[tuple[str, str, int, bool]] = []
    blocks: list[Block] = []
    tags: list[str] = []
    current: Block | None = None

    def path() -> str:
        return stack[-1][1] if stack else ""

    def add(raw: str) -> None:
        nonlocal current
        if current is None:
            apart, main = (stack[-1][2], stack[-1][3]) if stack else (FREE, False)
            current = Block(path(), apart, main, len(tags))
            blocks.append(current)
        current.pieces.append(entities.unescape(raw) if "&" in raw else raw)

    def close(i: int) -> None:
        nonlocal current
        while len(stack) > i:
            tags.append("/" + stack.pop()[1])
        current = None

    at = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        name = m[3] or m[6]
        if not name:
            continue
        name, end, attributes = name.lower(), m[2] or m[5], m[4] or m[7] or ""
        if name == "br":
            add(" ")
            continue
        if name not in BLOCKS:
            continue
        if end:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close(i)
                    break
            else:
                current = None
            continue
        if name in CLOSES_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in ("td", "th", "button", "object"):
                    break
        for i in range(len(stack) - 1, -1, -1) if name in SAME else ():
            if stack[i][0] in SAME[name]:
                close(i)
                break
            if stack[i][0] in BOUNDS[name]:
                break
        current = None
        label, words = _labels(attributes)
        apart, main = (stack[-1][2], stack[-1][3]) if stack else (FREE, False)
        if name in APART or name == "header" and not main:
            apart = max(apart, SOFT if name == "form" and not main else HARD)
        elif name in MAIN:
            # of a layout wrapper or a form around the page, not of an aside
            apart = HARD if apart == HARD or _comment(words) else FREE
            main = True
        elif name not in ("html", "body"):
            level = _apart(words, main)
            # within an article nothing apart holds the page's own article
            apart = max(apart, HARD if level and main else level)
        role = f"{path()}/{name}" + (f"[{label}]" if label else "")
        tags.append(role)
        if name not in VOID and not attributes.rstrip().endswith("/"):
            stack.append((name, role, apart, main))
        if name in ("textarea", "iframe") and (x := re.compile(rf"</{name}", re.I).search(page, at)) is None:
            break
    if at < len(page):
        add(page[at:])
    return [b for b in blocks if b.text()], tags


def page_tokens(blocks: list[Block], tags: list[str]) -> list[int]:
    """64-bit tokens of a page in page order: tags, and whole text blocks in
    their role, in articles too."""
    out, k = [], 0
    for b in blocks:
        out += [xxhash.xxh64_intdigest(t) for t in tags[k:b.gap]]
        k = b.gap
        out.append(xxhash.xxh64_intdigest(b.path + "\0" + b.text()))
    return out + [xxhash.xxh64_intdigest(t) for t in tags[k:]]


def host_of(url: str = "url") -> Column:
    """The host of a url in lower case; a null url's is null."""
    return F.lower(F.regexp_extract(F.col(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#]*@)?([^/?#:]*)", 1))


_TOKENS = "host string, salts int, salt int, digest binary, tokens array<long>"
_COUNTED = "host string, token long, low long, high long, pages long, total long, place long"
_M32 = (1 << 32) - 1


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each different page of a host in the task."""
    seen: set[tuple] = set()
    for b in batches:
        rows: list[list] = [[], [], [], [], []]
        for host, salts, salt, page in zip(*(b.column(c).to_pylist() for c in ("host", "salts", "salt", "html")), strict=True):
            digest = xxhash.xxh3_128_digest(page)
            if (host, digest) in seen:
                continue
            seen.add((host, digest))
            for to, x in zip(rows, (host, salts, salt, digest, [_signed(t) for t in page_tokens(*read_page(page))]), strict=True):
                to.append(x)
        if rows[0]:
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], ["host", "salts", "salt", "digest", "tokens"])


def _signed(t: int) -> int:
    return t - (1 << 64) if t >> 63 else t


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host, salt and token, for rows in order of host, salt and digest: the
    vector's share in two 32-bit halves, pages, occurrences, and the place on
    the least page.  Token 0 counts pages.  Tokens of one page are left out
    where a host has one salt."""
    now, last, sums = None, None, {}

    def flushed() -> pa.RecordBatch:
        kept = [(t, s) for t, s in sums.items() if t == 0 or now[1] > 1 or s[2] > 1]
        return pa.RecordBatch.from_arrays(
            [pa.array([now[0]] * len(kept), pa.string()), pa.array([t for t, _ in kept], pa.int64()),
             *(pa.array([s[i] for _, s in kept], pa.int64()) for i in range(5))],
            ["host", "token", "low", "high", "pages", "total", "place"])

    for b in batches:
        for *of, digest, tokens in zip(*(b.column(c).to_pylist() for c in ("host", "salts", "salt", "digest", "tokens")), strict=True):
            if of != now:
                if sums:
                    yield flushed()
                now, last, sums = of, None, {}
            if digest == last:
                continue
            last = digest
            first: dict[int, int] = {}
            for i, t in enumerate(tokens):
                first.setdefault(t, i)
            page_hash = int.from_bytes(digest[:8], "little")
            for t, n in [*Counter(tokens).items(), (0, 1)]:
                x = xxhash.xxh64_intdigest(digest[:8] + n.to_bytes(4, "little"))
                s = sums.setdefault(t, [0, 0, 0, 0, 1 << 62])
                s[0] += x & _M32
                s[1] += x >> 32
                s[2] += 1
                s[3] += n
                s[4] = min(s[4], (page_hash >> 34 << 32) | first.get(t, 0))
    if sums:
        yield flushed()


def templates(pages: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(host, n_pages, classes) of hosts with a template; ``pages`` has
    (host, key, html), ``hot`` (host, salts) of hosts to deal out.  ``classes`` lists tokens with their class (vector),
    whether it is the root, and their order."""
    salted = pages.join(F.broadcast(hot), "host", "left") if hot is not None else pages.withColumn("salts", F.lit(1))
    # a null host has no template
    salted = salted.where(F.col("host").isNotNull()).withColumn("salts", F.coalesce("salts", F.lit(1)))
    salted = salted.select("host", "salts", F.pmod(F.xxhash64("html"), F.col("salts")).cast("int").alias("salt"), "html")
    by_host = salted.mapInArrow(_tokens, _TOKENS).repartition("host", "salt").sortWithinPartitions("host", "salt", "digest")
    sums = (by_host.mapInArrow(_counted, _COUNTED).groupBy("host", "token")
            .agg(*[F.sum(c).alias(c) for c in ("low", "high", "pages", "total")], F.min("place").alias("place")))
    # a token on one page only is data; it is not kept
    sums = written(sums.where("token = 0 or pages > 1"), "tokens")
    count = sums.where("token = 0").select("host", F.col("pages").alias("n_pages"))
    frequent = sums.where("token <> 0").join(count.where(F.col("n_pages") >= MIN_PAGES), "host").where(
        F.col("pages") >= F.col("n_pages") * SUPPORT)
    # classes: tokens of one host with one vector
    classes = frequent.groupBy("host", "low", "high").agg(
        F.first("n_pages").alias("n_pages"), F.max("pages").alias("pages"), F.max("total").alias("total"), F.count("*").alias("size"),
        F.sort_array(F.collect_list(F.struct("place", "token"))).alias("tokens"))
    once = F.col("pages") == F.col("total")
    return (classes.groupBy("host").agg(
        F.first("n_pages").alias("n_pages"),
        F.sort_array(F.collect_list(F.struct(
            F.when(once, -F.col("pages")).otherwise(F.lit(0)).alias("rank"), (-F.col("size")).alias("less"), "low", "high",
            F.col("tokens.token").alias("tokens")))).alias("classes")))


def _own(blocks: list[Block], fixed: set[int]) -> list[Block]:
    """Blocks that are no template text."""
    return [b for b in blocks if xxhash.xxh64_intdigest(b.path + "\0" + b.text()) not in fixed] if fixed else blocks


def main_text(page: str, classes: list[list[int]] | None) -> str:
    """The main text of a page; ``classes``: its host's template, the root
    first, each class's tokens in order."""
    blocks, tags = read_page(page)
    fixed: set[int] = set()
    if classes:
        tokens = page_tokens(blocks, tags)
        at: dict[int, list[int]] = {}
        for i, t in enumerate(tokens):
            at.setdefault(t, []).append(i)
        for k, one in enumerate(classes):
            # valid on this page: its tokens are there, equally often and in the template's order
            seen = [at.get(t, []) for t in one]
            counts = {len(s) for s in seen}
            if k == 0 and (counts != {1} or any(a >= b for (a,), (b,) in zip(seen, seen[1:], strict=False))):
                break
            if len(counts) == 1 and counts != {0}:
                fixed.update(one)
    data = [b for b in blocks if not b.apart]
    if not any(b.main for b in data):
        # a form or wrapper around the page: more than half of the page's text
        soft = [b for b in blocks if b.apart == SOFT]
        if sum(len(b.text()) for b in soft) > sum(len(b.text()) for b in data):
            data = [b for b in blocks if b.apart != HARD]
    if any(b.main for b in data):
        data = [b for b in data if b.main]
        own = _own(data, fixed)
        if 2 * sum(len(b.text()) for b in own) >= sum(len(b.text()) for b in data):
            data = own
    else:
        data = _own(data, fixed)
    return "\n".join(b.text() for b in data)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select("page_id", "url", host_of().alias("host"), text_or_empty("html").alias("html")).withColumn(
        "key", F.xxhash64("page_id", "url"))
    counts = rows.groupBy("host").agg(F.count("*").alias("n"))
    total = rows.count()
    # hosts above the share: at most 1 / HOT_SHARE of them
    hot = counts.where((F.col("n") > total * HOT_SHARE) & (F.col("n") > PAGES_PER_SALT) & F.col("host").isNotNull()).select(
        "host", F.ceil(F.col("n") / PAGES_PER_SALT).cast("int").alias("salts"))
    hot = written(hot, "hot-hosts")
    found = written(templates(rows.select("host", "key", "html"), hot), "templates")
    salts = F.coalesce("salts", F.lit(1))
    # a null host has no template; its pages are dealt out by key
    left = (rows.join(F.broadcast(hot), "host", "left")
            .withColumn("salt", F.pmod("key", salts).cast("int")).drop("salts"))
    right = (found.join(F.broadcast(hot), "host", "left")
             .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
             .select("host", "salt", F.col("classes.tokens").alias("classes")))
    schema = StructType([rows.schema["page_id"], rows.schema["url"], StructField("text", StringType(), False),
                         StructField("n_chars", LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, classes = None, None
        for b in batches:
            out = []
            templates_ = b.column("classes")
            for i, (host, page) in enumerate(zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True)):
                if host != now or i == 0:
                    now, raw = host, templates_[i].as_py()
                    classes = raw and [[t & ((1 << 64) - 1) for t in one] for one in raw]
                out.append(main_text(page, classes))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string()),
                                              pa.array([len(x) for x in out], pa.int64())], schema.names)

    joined = left.join(right, ["host", "salt"], "left").select("page_id", "url", "host", "html", "classes")
    return joined.mapInArrow(run, schema)
