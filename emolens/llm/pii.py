"""Personal data replaced by keyed, type-consistent surrogates.

Entities (e-mail addresses, phone, card and social security numbers, IBANs,
IPv4 addresses, access keys, secrets after their names, persons after a
title) are detected in whole texts.  An entity's canonical form gets a
surrogate from an HMAC under a secret key: same type, length and format,
check digits that hold if the original's held, a name of the same script and
gender.  Written forms of one entity (spacing, case) share the surrogate, in
their own form, in every document.

A titled name holds for its whole document: its full, first-only and last-only
mentions without a title get the matching parts of the same surrogate, and a
shorter titled name ("Mr Smith") belongs to the longer one of the same gender
in that document ("Mr John Smith"); of several, to the one named last before,
else first after.  Mentions are capitalised words; inflected forms are not linked.

Collision checks: surrogates of different entities must differ, and no
surrogate may be an entity of the corpus.  Entities that clash are drawn
again until none does.  Later draws have more room: names get a further
syllable every `LONGER_EVERY` draws; from draw `WIDER` on private addresses
come from 10.0.0.0/8 and then from the reserved 240.0.0.0/4, phone numbers
change their country code too.  `MOST_DRAWS` draws without an end are an error,
not a silent clash.

Plan: documents that hold a digit, an at sign, a title or a secret are scanned; only
their spans are kept.  Entities are made distinct with map-side combine (one
address in a third of all documents is one row), drawn in tasks and compared
by joins.  Spans meet their surrogates by (type, entity) and their documents
by id and text hash; documents without spans never move.

Cases: null and empty texts pass; rows with one id and text share their
spans, so repeated rows come out alike; null ids are matched null-safely;
other columns pass through; patterns are anchored so that long runs without
white space stay linear.
"""

from __future__ import annotations

import bisect
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from emolens.llm.common import free_name, map_in_arrow, text_chunks, written

KEY = "replace-this-key"
MOST_DRAWS = 64
#: Draws after which a name gets a further syllable, and from which an address
#: or number is taken from a larger range.
LONGER_EVERY, WIDER = 2, 24

MALE, FEMALE = "m", "f"
#: Titles before a person's name, by gender.
TITLES = {
    "Mr": MALE, "Mister": MALE, "Herr": MALE, "Monsieur": MALE, "Señor": MALE, "Sr": MALE, "Господин": MALE, "г-н": MALE, "Κύριος": MALE,
    "Mrs": FEMALE, "Ms": FEMALE, "Miss": FEMALE, "Frau": FEMALE, "Madame": FEMALE, "Mme": FEMALE, "Señora": FEMALE, "Sra": FEMALE,
    "Госпожа": FEMALE, "г-жа": FEMALE, "Κυρία": FEMALE,
}
_MARK = "[\u0300-\u036f]*"
_UP = "".join(c for c in map(chr, range(0xD800)) if unicodedata.category(c) in ("Lu", "Lt"))
_NAME = rf"[{_UP}]{_MARK}(?:['’]?[^\W\d_]{_MARK})+(?:-[{_UP}]{_MARK}(?:[^\W\d_]{_MARK})+)?"
#: Function words that begin sentences: never a name's part without its title.
_NO_NAMES = frozenset("the a an and or but for of in on at to by he she it they we you is was his her this that then there der die das "
                      "und ist sie er es wir ihr ein eine le la les un une et il elle nous vous el los las una y de que".split())
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_SECRETS = r"(?i:token|password|passwd|pwd|secret|api[_\-]?key)"
PATTERNS = {
    "email": r"(?<![\w.%+\-])[\w.%+\-]{1,64}@(?:[A-Za-z0-9\-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9\-])",
    "access_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])" + _SECRETS + r"[\"']?\s{0,3}[=:]\s{0,3}"
              r"(?:(?P<quote>[\"'])(?P<quoted>(?:(?!(?P=quote))[^\r\n]){8,}+)(?P=quote)|[\"']?(?P<bare>[^\s\"'<>,;&(){}\[\]]{8,}+)(?!\())",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ipv4": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "phone": r"(?:(?<![\w+])\+1[ .\-]?\(?\d{3}\)?[ .\-]?\d{3}[ .\-]?\d{4}|(?<![\w+])\+[1-9](?:[ .\-/\xa0‑–]?\(?\d\)?){6,14}"
             r"|(?<![\w(])\(\d{3}\)[ .\-]?\d{3}[ .\-]\d{4}|(?<![\d.\-])\d{3}([.\-])\d{3}\1\d{4}"
             # national forms: 3-3-4, pairs after a trunk 0, an area code with its 0, 9 digits from 6 to 9, area code and 7 digits
             r"|(?<![\w.,+\-/])(?<!\d[ \xa0])(?:\d{3}[ \xa0]\d{3}[ \xa0]\d{4}|0\d(?:[ .\xa0]\d\d){4}|0\d{2,4}[ /\-\xa0]\d{3,8}(?:[ \-\xa0]\d{2,5}){0,3}"
             r"|\(0\d{1,4}\)[ \xa0]?\d{3,8}(?:[ \-\xa0]\d{2,5}){0,3}|[6-9]\d{2}[ \xa0]\d{3}[ \xa0]\d{3}|[89]\d[ \xa0]\d{3}[ \xa0]\d\d[ \xa0]\d\d|[2-9]\d{2}[ \xa0]\d{7}))(?!\d)",
    "card": r"(?<![\d.\-])(?:\d{13,19}|\d{4}([ \-])\d{4}\1\d{4}\1\d{1,7}|\d{4}[ \-]\d{6}[ \-]\d{5})(?![\d\-])",
    "person": rf"(?<!\w)(?P<title>{'|'.join(TITLES)})\.?\s{{1,3}}(?P<name>{_NAME}(?:[^\S\r\n]{{1,3}}{_NAME}){{0,2}})",
}
#: What a text must hold to be scanned: a digit or at sign, a title, a secret's
#: name before its sign, or the prefix of an access key.
HINT_TITLE = rf"(?=[{''.join(sorted({x[0] for x in TITLES}))}])(?:{'|'.join(TITLES)})\.?[^A-Za-z0-9]"
HINT_SECRET = _SECRETS.replace("(?i:", "(?iu:") + r"[^A-Za-z0-9]{0,4}[=:]"
_names = re.compile(rf"(?<!\w){_NAME}").finditer
_scan = {k: re.compile(v).finditer for k, v in PATTERNS.items()}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_holds(s: str) -> bool:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, entity) of the entities of a text in order; where
    they overlap, the type named first in `PATTERNS` wins."""
    found: list[tuple[int, int, str, str]] = []

    def add(a: int, b: int, kind: str, entity: str) -> None:
        # spans in order do not overlap, so their neighbours tell
        i = bisect.bisect(found, (a,))
        if (i == len(found) or b <= found[i][0]) and (i == 0 or found[i - 1][1] <= a):
            found.insert(i, (a, b, kind, entity))

    for kind in PATTERNS:
        if kind == "person":
            for a, b, entity in _persons(text):
                add(a, b, kind, entity)
            continue
        if kind not in ("secret", "access_key") and not any(c in text for c in ("@" if kind == "email" else "0123456789")):
            continue
        for m in _scan[kind](text):
            a, b = m.span()
            if kind == "secret":
                a, b = m.span("quoted" if m["quoted"] else "bare")
                if m["bare"]:
                    b = a + len(text[a:b].rstrip(".?:"))
                if not _is_secret(text[m.start():a], text[a:b], bool(m["quoted"])):
                    continue
            raw = text[a:b]
            if kind == "iban" and not (15 <= len(raw.replace(" ", "")) <= 34 and iban_holds(raw.replace(" ", ""))):
                continue
            if kind == "phone" and not 7 <= sum(c.isdigit() for c in raw) <= 15:
                continue
            entity = canonical(kind, raw)
            add(a, b, kind, entity)
    return found


def _is_secret(before: str, value: str, quoted: bool) -> bool:
    """Whether a value after a secret's name is one, not prose: behind an equals
    sign or in quotes any value, else one with a digit; phrases behind an equals
    sign only."""
    if len(value) < 8 or not any(c.isalnum() for c in value):
        return False
    if "=" in before:
        return True
    return not any(c.isspace() for c in value) and (quoted or any(c.isdigit() for c in value))


def _unpossessed(text: str, a: int, b: int) -> int:
    """The end of a name without a possessive s."""
    return b - 2 if b - a > 3 and text[b - 2] in "'’" and text[b - 1] in "sS" else b


def _persons(text: str) -> list[tuple[int, int, str]]:
    """(start, end, entity) of titled names and of their mentions."""
    titled = []
    for m in _scan["person"](text):
        a, b = m.span("name")
        b = _unpossessed(text, a, b)
        titled.append((a, b, TITLES[m["title"]], tuple(canonical("person", text[a:b]).split())))
    if not titled:
        return []
    # a shorter name belongs to a longer one of its gender that holds its parts
    holders: dict[tuple[str, str], list[int]] = {}
    for i, (_, _, gender, parts) in enumerate(titled):
        for p in dict.fromkeys(parts):
            holders.setdefault((gender, p), []).append(i)
    longer: dict[tuple, list[int]] = {}
    entities, out = [], []
    for i, (a, b, gender, parts) in enumerate(titled):
        if (gender, parts) not in longer:
            longer[gender, parts] = [k for k in holders[gender, parts[-1]] if len(titled[k][3]) > len(parts) and _is_short_of(parts, titled[k][3])]
        ks = longer[gender, parts]
        if ks:
            most = max(len(titled[k][3]) for k in ks)
            ks = [k for k in ks if len(titled[k][3]) == most]
            parts = titled[ks[max(0, bisect.bisect(ks, i) - 1)]][3]
        entities.append((gender, parts))
        out.append((a, b, f"{gender}:{' '.join(parts)}"))
    # mentions: the titled places of every first and last part, and persons by first part
    places: dict[str, list[int]] = {}
    fulls: dict[str, dict[tuple, str]] = {}
    for i, (gender, parts) in enumerate(entities):
        for p in dict.fromkeys((parts[0], parts[-1])):
            if p not in _NO_NAMES:
                places.setdefault(p, []).append(i)
        fulls.setdefault(parts[0], {}).setdefault(parts, gender)
    words = []
    for m in _names(text):
        b = _unpossessed(text, *m.span())
        words.append((m.start(), b, canonical("person", text[m.start():b])))
    starts, i = [x[0] for x in titled], 0
    while i < len(words):
        a, b, word = words[i]
        took, entity = 1, None
        for parts, gender in fulls.get(word, {}).items():
            for form in dict.fromkeys((parts, (parts[0], parts[-1]))):
                n = len(form)
                if took < n <= len(words) - i and all(words[i + k][2] == form[k] for k in range(n)) and all(
                        0 < words[i + k][0] - words[i + k - 1][1] <= 3 and text[words[i + k - 1][1]:words[i + k][0]].isspace() for k in range(1, n)):
                    took, b, entity = n, words[i + n - 1][1], f"{gender}:{' '.join(parts)}"
        if entity is None and word in places:
            of = places[word]
            gender, parts = entities[of[max(0, bisect.bisect(of, bisect.bisect(starts, a) - 1) - 1)]]
            entity = f"{gender}:{' '.join(parts)}"
        if entity is not None:
            out.append((a, b, entity))
        i += took
    return out


def _is_short_of(parts: tuple, of: tuple) -> bool:
    """Whether a shorter name is some of a longer one's parts, in order."""
    left = iter(of)
    return all(p in left for p in parts)


def canonical(kind: str, raw: str) -> str:
    """The form that all written forms of an entity share."""
    if kind == "email":
        return raw.lower()
    if kind in ("phone", "card", "ssn"):
        return ("+" if raw.startswith("+") else "") + "".join(c for c in raw if c.isdigit())
    if kind == "iban":
        return raw.replace(" ", "")
    if kind == "person":
        return " ".join(raw.casefold().split())
    return raw


class _Draw:
    """A stream of keyed numbers for one entity and draw."""

    def __init__(self, key: str, *of: object):
        self.key, self.seed, self.n, self.pool = key.encode(), "\x1f".join(map(str, of)).encode(), 0, 0
        self.left = 1

    def below(self, n: int) -> int:
        if self.left < n << 32:
            more = hmac.digest(self.key, self.seed + b"\x1f" + str(self.n).encode(), "sha256")
            self.n, self.pool, self.left = self.n + 1, int.from_bytes(more, "big"), 1 << 256
        self.pool, out = divmod(self.pool, n)
        self.left //= n
        return out

    def like(self, c: str, letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
        if c.isdigit():
            return str(self.below(10))
        if c.isalpha():
            x = letters[self.below(len(letters))]
            return x.upper() if c.isupper() else x
        return c


#: Syllables of generated names, by script; an ending tells the gender.
_SYLLABLES = {
    "latin": ("ba be bi da de do fa fe ga go ka ke la le li lo ma me mi na ne no pa ra re ri ro sa se ta te ti va ve vi za", "n r s l", "a ia"),
    "cyrillic": ("ба бе ви во га го да де ла ле ли ма ме ми на не но па ра ре ри ро са се та те ти ва за", "н р с л", "а ия"),
    "greek": ("βα βε γα δα δε κα κε λα λε λι μα με μι να νε νο πα ρα ρε ρι σα σε τα τε τι ζα", "ς ν", "α ια"),
}


def script_of(word: str) -> str:
    for c in word:
        if "Ͱ" <= c <= "Ͽ" or "\u1f00" <= c <= "\u1fff":
            return "greek"
        if "Ѐ" <= c <= "ӿ":
            return "cyrillic"
    return "latin"


def _name(draw: _Draw, gender: str, name: str, longer: int = 0) -> str:
    out = []
    for i, part in enumerate(re.split(r"([ \-])", name)):
        if part in (" ", "-"):
            out.append(part)
            continue
        core, male, female = (x.split() for x in _SYLLABLES[script_of(part)])
        word = "".join(core[draw.below(len(core))] for _ in range(max(2, min(6, len(part) // 2)) + longer))
        ends = female if gender == FEMALE and i == 0 else male
        out.append(word.rstrip("aeiouаеиоαειο") + ends[draw.below(len(ends))] if i == 0 else word + male[draw.below(len(male))])
    return "".join(out)


def _digits(draw: _Draw, digits: str, keep: int) -> str:
    out = list(digits[:keep]) + [str(draw.below(10)) for _ in digits[keep:]]
    if len(out) > keep and out[keep] in "01" and digits[keep] not in "01":
        out[keep] = str(2 + draw.below(8))
    return "".join(out)


def surrogate(kind: str, entity: str, draw_no: int, key: str = KEY) -> str:
    """The canonical surrogate of an entity at a draw."""
    draw = _Draw(key, kind, entity, draw_no)
    if kind == "email":
        local, _, domain = entity.partition("@")
        # a domain keeps one surrogate at the first draw, for all its addresses
        of_domain = _Draw(key, "domain", domain, draw_no // 8)
        host = "".join(of_domain.like("a") for _ in range(10))
        return "".join(draw.like(c) for c in local) + f"@{host}.example.{domain.rpartition('.')[2]}"
    if kind == "phone":
        if entity.startswith("+"):
            code = 0 if draw_no >= WIDER else 1 if entity.startswith("+1") else 2
            return "+" + _digits(draw, entity[1:], code)
        # a trunk 0 and the first digit of nine stay
        return _digits(draw, entity, int(entity.startswith("0") or len(entity) == 9))
    if kind == "ssn":
        return _digits(draw, entity, 0)
    if kind == "card":
        while luhn(out := _digits(draw, entity, 1)) != luhn(entity):
            pass
        return out
    if kind == "iban":
        body = "".join(draw.like(c) if c.isdigit() else draw.like("A") for c in entity[4:])
        return entity[:2] + f"{98 - int(''.join(str(int(c, 36)) for c in body + entity[:2] + '00')) % 97:02d}" + body
    if kind == "ipv4":
        a, b, *_ = map(int, entity.split("."))
        tail = lambda n: [str(draw.below(256)) for _ in range(n)]
        private = a in (10, 127) or (a, b) == (192, 168) or a == 172 and 16 <= b < 32 or a == 169 and b == 254
        if private and draw_no >= WIDER:
            return ".".join(["10", *tail(3)] if draw_no < WIDER + 8 else [str(240 + draw.below(15)), *tail(3)])
        if a in (10, 127):
            return ".".join([str(a), *tail(3)])
        if private:
            return ".".join([str(a), str(b), *tail(2)])
        return ".".join([str(11 + draw.below(89)), *tail(2), str(1 + draw.below(254))])
    if kind == "access_key":
        return entity[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[draw.below(32)] for _ in entity[4:])
    if kind == "secret":
        letters = "abcdef" if re.fullmatch(r"[0-9a-fA-F]+", entity) else "abcdefghijklmnopqrstuvwxyz"
        # later draws change signs too, and lengthen
        return "".join(draw.like(c if draw_no < 8 or c.isalnum() else "a", letters) for c in entity + "a" * max(0, draw_no - 15))
    gender, _, name = entity.partition(":")
    return _name(draw, gender, name, draw_no // LONGER_EVERY)


def render(kind: str, raw: str, canon: str, entity: str = "") -> str:
    """A canonical surrogate in the written form of the original; of a person
    (``entity``) the parts that the original names."""
    if kind in ("phone", "card", "ssn", "iban"):
        left = iter(canon.removeprefix("+") if kind == "phone" else canon)
        return "".join(next(left) if (c.isalnum()) else c for c in raw)
    if kind == "person":
        old, new, named = entity[2:].split(), canon.split(), canonical(kind, raw).split()
        if entity and len(named) < len(new) == len(old):
            # from the end, so that a last name is the last part
            at, left = [], len(old)
            for p in reversed(named):
                left = max((k for k in range(left) if old[k] == p), default=max(left - 1, 0))
                at.append(left)
            canon = " ".join(new[k] for k in reversed(at))
        return canon.upper() if raw.isupper() else re.sub(r"(^|[ \-])(\w)", lambda m: m[1] + m[2].upper(), canon)
    if kind == "email" and raw.isupper():
        return canon.upper()
    return canon


def hinted(text: str) -> Column:
    """Whether a text may hold an entity; null for a null text."""
    t = F.col(text)
    return (t.rlike("[0-9@]") | (t.contains("=") | t.contains(":")) & t.rlike(HINT_SECRET)
            | t.contains("AKIA") | t.contains("ASIA") | t.rlike(HINT_TITLE))


_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType()),
                    StructField("kind", StringType()), StructField("entity", StringType())])


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_hash, spans) of the texts that hold entities."""
    hashed = docs.where(hinted(text)).select(key, text, F.xxhash64(text).alias("text_hash"))
    schema = StructType([docs.schema[key], StructField("text_hash", LongType()), StructField("spans", ArrayType(_SPAN))])
    names = [f.name for f in _SPAN]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in text_chunks(batches, text):
            found = [detect(t) for t in texts]
            some = pa.array([i for i, f in enumerate(found) if f], pa.int64())
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [b.column(key).take(some), b.column("text_hash").take(some),
                     pa.array([[dict(zip(names, s, strict=True)) for s in f] for f in found if f], pa.list_(pa.struct(
                         [("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("entity", pa.string())])))],
                    schema.names)

    return hashed.select(*dict.fromkeys([key, "text_hash", text])).mapInArrow(run, schema)


def draw_surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, entity, surrogate): distinct surrogates, none an entity.

    ``entities`` has distinct (kind, entity).  Every round writes the entities
    settled so far and those still to draw."""
    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("kind", "entity", "draw")]
            made = [surrogate(k, e, n, key) for k, e, n in zip(*cols, strict=True)]
            # persons are distinct as names, whatever their gender
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("kind", "entity", "draw")), pa.array(made, pa.string())],
                                             ["kind", "entity", "draw", "surrogate"])

    known = entities.select("kind", F.when(F.col("kind") == "person", F.substring("entity", 3, 1 << 30))
                            .otherwise(F.col("entity")).alias("surrogate")).distinct()
    todo, settled = entities.withColumn("draw", F.lit(0)), None
    for n in range(MOST_DRAWS):
        made = written(todo.mapInArrow(drawn, "kind string, entity string, draw int, surrogate string"), "drawn")
        free = made.join(known, ["kind", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled, ["kind", "surrogate"], "left_anti")
        won = free.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        won = written(won.select("kind", "entity", "surrogate"), "won")
        settled = won if settled is None else settled.unionAll(won)
        todo = made.join(won, ["kind", "entity"], "left_anti").select("kind", "entity", F.lit(n + 1).alias("draw"))
        if not todo.limit(1).count():
            return settled
    raise ValueError(f"no distinct surrogates after {MOST_DRAWS} draws: a type's number space is full")


def replace_entities(docs: DataFrame, key: str = "doc_id", text: str = "text", secret: str = KEY,
                     replaced: str | None = None) -> DataFrame:
    """``docs`` with entities replaced in ``text``; ``replaced`` names an extra
    column, the number of replacements."""
    h, plan = (free_name([*docs.columns, replaced or ""], n) for n in ("text_hash_", "plan_"))
    found = written(spans(docs, key, text).dropDuplicates([key, "text_hash"]), "spans")
    each = found.select(key, "text_hash", F.explode("spans").alias("s")).select(key, "text_hash", "s.*")
    chosen = draw_surrogates(written(each.select("kind", "entity").distinct(), "entities"), secret)
    todo = (each.join(chosen, ["kind", "entity"]).groupBy(F.col(key).alias("k_"), F.col("text_hash").alias("h_"))
            .agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind", "surrogate", "entity"))).alias(plan)))

    columns, extra = docs.columns, [StructField(replaced, LongType(), False)] if replaced else []
    schema = StructType([*docs.schema.fields, *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, counts = [], []
            for t, steps in zip(b.column(text).to_pylist(), b.column(plan).to_pylist(), strict=True):
                counts.append(len(steps or ()))
                parts, at = [], 0
                for s in steps or ():
                    parts += [t[at:s["start"]], render(s["kind"], t[s["start"]:s["end"]], s["surrogate"], s["entity"])]
                    at = s["end"]
                out.append("".join([*parts, t[at:]]) if steps else t)
            cols = [pa.array(out, pa.string()) if c == text else b.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(counts, pa.int64())] if replaced else []), schema.names)

    hint = F.coalesce(hinted(text), F.lit(False))
    quiet = docs.where(~hint)
    if replaced:
        quiet = quiet.withColumn(replaced, F.lit(0).cast("long"))
    loud = docs.where(hint).withColumn(h, F.xxhash64(text)).alias("a").join(
        todo.alias("b"), F.col(f"a.{key}").eqNullSafe(F.col("b.k_")) & (F.col(f"a.{h}") == F.col("b.h_")), "left")
    loud = loud.select(*[F.col(f"a.`{c}`") for c in docs.columns], F.col(f"b.{plan}").alias(plan))
    return quiet.unionByName(map_in_arrow(loud, run, schema))
