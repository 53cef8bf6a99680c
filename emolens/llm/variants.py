"""Spelling variants by composing finite-state machines.

The vocabulary is a minimised acceptor A (states of equal futures are one
state).  A is composed with the one-edit transducer E and with A again: a
state of A . E . A is (state, edited?, state); both sides read the same
letters until the edit, which deletes, inserts or replaces one letter, and the
same letters after it.  After the edit a pair of states needs what both accept,
which is computed once per pair of states; states merged by minimisation share
it.  E edits at the first difference only, so every pair is accepted once.

Partitions: the composition is enumerated per initial-state partition, the
words that reach one state of A by their first `DEPTH` letters.  Pairs that
differ within these letters share the last `DEPTH` ones (a word has six
letters or more), so the reversed vocabulary is partitioned too, and gives the
pairs whose first letters differ.  A partition of more than `PARTITION` words
is replaced by those of its state's successors, again and again; pairs edited
exactly at that state are enumerated by what follows the edit, which both
words share.  So no partition exceeds the bound however many words begin
alike, no pair is lost, and no word is in more partitions than it has letters.

Plan: words are counted by one aggregate that combines before its shuffle; the
vocabulary is written; partitions are sorted runs of a hash partitioning, read
one after the other, and what a task finds is summed by word before it leaves.
Forms follow by one aggregate, roots by pointer doubling (five joins).  Only
counts reach the driver.

Cases: null and empty texts have no words, a null id is written as nothing
before the colon; texts of any length are read whole; repeated rows count as
often as they occur; ties between near words go to the smaller word in
code-point order; an empty table gives no rows; further columns take no part.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emolens.llm.common import written

LETTERS = "A-Za-zÀ-ÿ"
SHORTEST, LEAST = 6, 5
DEPTH = 3
PARTITION = 8_000


# ------------------------------------------------------------- vocabulary

def ascii_lower(word: Column) -> Column:
    """A-Z in lower case; `lower` alone would also change other letters."""
    plain = F.octet_length(word) == F.char_length(word)
    return F.when(plain, F.lower(word)).otherwise(
        F.translate(word, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", typo_every: int = 199,
               shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n): words of ``shortest`` letters found ``least`` times or more.
    Of one run in ``typo_every``, by its hash with the row's key, a letter is
    taken out."""
    # a run that is too short has no word in it
    runs = F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run")) \
        .select("id", ascii_lower(F.col("run")).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    cut = F.pmod(h, F.char_length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.char_length("run")))
    words = found.select(F.when(F.pmod(h, F.lit(typo_every)) == 0, less).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") >= least)


# ------------------------------------------------- acceptor and composition

class Acceptor:
    """The minimal acceptor of some words: ``next[state]`` maps letters to
    states, ``final`` holds the accepting states, ``start`` is the first."""

    def __init__(self, words: list[str]):
        self.next: list[dict[str, int]] = []
        self.final: set[int] = set()
        known: dict[tuple, int] = {}

        def state(end: bool, arcs: dict[str, int]) -> int:
            sign = (end, *arcs.items())
            s = known.get(sign)
            if s is None:
                s = known[sign] = len(self.next)
                self.next.append(arcs)
                if end:
                    self.final.add(s)
            return s

        # words in order: what the next word leaves is complete and minimised
        ends, arcs, last = [False], [{}], ""

        def close(depth: int) -> None:
            for i in range(len(last), depth, -1):
                arcs[i - 1][last[i - 1]] = state(ends.pop(), arcs.pop())

        for word in sorted(set(words)):
            same = 0
            for a, b in zip(last, word, strict=False):
                if a != b:
                    break
                same += 1
            close(same)
            for _ in range(same, len(word)):
                ends.append(False)
                arcs.append({})
            ends[len(word)] = True
            last = word
        close(0)
        self.start = state(ends[0], arcs[0])


def near_pairs(words: list[str], low: int = 0, high: int | None = None) -> Iterator[tuple[str, str]]:
    """Pairs of words one edit apart, each once, whose first difference lies
    at a place from ``low`` to ``high``: the accepted pairs of A . E . A."""
    a = Acceptor(words)
    arcs, final = a.next, a.final
    both: dict[tuple[int, int], tuple[str, ...]] = {}

    def common(p: int, q: int) -> tuple[str, ...]:
        """What both states accept."""
        if p > q:
            p, q = q, p
        got = both.get((p, q))
        if got is None:
            at, chain = (p, q), []
            while True:  # along the letters without a choice
                small, large = sorted((arcs[p], arcs[q]), key=len)
                shared = [c for c in small if c in large]
                ends = p in final and q in final
                if ends or len(shared) != 1:
                    break
                chain.append(shared[0])
                p, q = arcs[p][shared[0]], arcs[q][shared[0]]
            lead, out = "".join(chain), []
            if ends:
                out.append(lead)
            for c in shared:
                out += [lead + c + x for x in common(arcs[p][c], arcs[q][c])]
            got = both[at] = tuple(out)
        return got

    def edits(state: int, prefix: str) -> Iterator[tuple[str, str]]:
        own = list(arcs[state].items())
        for i, (c, p) in enumerate(own):
            for d, q in own[:i]:  # c replaced by d
                for rest in common(p, q):
                    yield prefix + c + rest, prefix + d + rest
            # c deleted; what follows begins with another letter
            if p in final and state in final:
                yield prefix + c, prefix
            for x, q in arcs[p].items():
                s = arcs[state].get(x)
                if x != c and s is not None:
                    for rest in common(q, s):
                        yield prefix + c + x + rest, prefix + x + rest

    stack, path = [(a.start, 0, "")], []
    while stack:
        state, size, letter = stack.pop()
        path[max(size - 1, 0):] = letter
        # a state of one arc that accepts nothing has no edit
        if size >= low and (len(arcs[state]) > 1 or state in final):
            yield from edits(state, "".join(path))
        if high is None or size < high:
            stack += [(q, size + 1, c) for c, q in arcs[state].items()]


# ------------------------------------------------------------- partitions

def partitions(vocab: DataFrame, depth: int = DEPTH, limit: int = PARTITION) -> DataFrame:
    """(part, low, high, back, word, n): the words of each initial-state
    partition and the places at which its pairs differ first."""
    out = None
    for back in (False, True):
        words = vocab.select(F.lit(back).alias("back"), (F.reverse("word") if back else F.col("word")).alias("word"), "n")
        at = depth
        while words is not None:
            here = words.withColumn("head", F.substring("word", 1, at))
            sizes = here.groupBy("head").agg(F.count(F.lit(1)).alias("size"))
            large = written(sizes.where(F.col("size") > limit).select("head"), "large")
            none = large.isEmpty()
            kind = F.lit(f"{'b' if back else 'f'}{at}:")
            fits = here if none else here.join(large, "head", "left_anti")
            made = fits.select(F.concat(kind, "head").alias("part"), F.lit(at).alias("low"),
                               F.lit(None).cast("int").alias("high"), "back", "word", "n")
            if none:
                words = None
            else:
                # pairs edited at this state: by what follows the edit, with
                # the letter there taken out or left
                words = written(here.join(large, "head", "left_semi").drop("head"), "split")
                rest = F.expr(f"substring(word, {at + 1})")
                keys = F.array(rest, F.when(F.char_length("word") > at, F.expr(f"substring(word, {at + 2})")))
                edge = words.withColumn("rest", F.explode(keys)).where(F.col("rest").isNotNull())
                name = F.concat(F.lit("e"), kind, F.substring("word", 1, at), F.lit("|"), F.col("rest"))
                made = made.unionByName(edge.select(name.alias("part"), F.lit(at).alias("low"), F.lit(at).alias("high"),
                                                    "back", "word", "n"))
            out = made if out is None else out.unionByName(made)
            at += 1
    return out


def _near(parts: DataFrame, depth: int, limit: int) -> DataFrame:
    """(word, n_near, form_n, form): per word of a partition its near words
    there, and the most frequent one.  Partitions are runs of sorted rows."""
    schema = "word string, n_near bigint, form_n bigint, form string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # as deep as a partition's words can branch
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 3 * limit + 1000))
        part, held, best = None, {}, {}

        def note(word: str, other: str, n: int) -> None:
            old = best.get(word)
            if old is None:
                best[word] = (1, n, other)
            else:
                better = n > old[1] or n == old[1] and other < old[2]
                best[word] = (old[0] + 1, n, other) if better else (old[0] + 1, *old[1:])

        def finish() -> None:
            if len(held) < 2:
                return
            _, low, high, back = part
            for u, v in near_pairs(list(held), low, high):
                n_u, n_v = held[u], held[v]
                if back:
                    u, v = u[::-1], v[::-1]
                    if u[:depth] == v[:depth]:  # found by their first letters
                        continue
                note(u, v, n_v)
                note(v, u, n_u)

        def flush() -> pa.RecordBatch:
            cols = list(zip(*((w, *x) for w, x in best.items()), strict=True)) or [(), (), (), ()]
            best.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                ["word", "n_near", "form_n", "form"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("part", "low", "high", "back", "word", "n")]
            for *key, word, n in zip(*cols, strict=True):
                if key != part:
                    finish()
                    part, held = key, {}
                    if len(best) > 50_000:
                        yield flush()
                held[word] = n
        finish()
        yield flush()

    dealt = parts.repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, schema)


def near_words(vocab: DataFrame, ratio: int = 5, depth: int = DEPTH, limit: int = PARTITION) -> DataFrame:
    """``vocab`` with ``n_near``, and ``form`` and ``form_n``: the near word
    of largest n, if that is ``ratio`` times the word's or more.  ``vocab``
    is read several times: pass a written table."""
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    found = _near(partitions(vocab, depth, limit), depth, limit).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    strong = -F.col("best.less") >= ratio * F.col("n")
    return vocab.join(found, "word", "left").select(
        "word", F.when(strong, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, -F.col("best.less")).cast("long").alias("form_n"))


def with_roots(words: DataFrame, ratio: int = 5, name: str = "roots") -> DataFrame:
    """``words`` with ``root``: the last word when following forms.  A form
    is ``ratio`` times as frequent, so chains are short: their length is
    bounded by the largest n, and each doubling halves what is left."""
    edges = written(words.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), name)
    most = words.agg(F.max("n")).first()[0] or 1  # one number
    longest = 0
    while most >= ratio:
        most, longest = most // ratio, longest + 1
    while longest > 1:
        after = edges.select(F.col("word").alias("root"), F.col("root").alias("next"))
        edges = written(edges.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root")), name)
        longest = -(-longest // 2)
    return words.join(edges, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    vocab = written(vocabulary(docs, key, text), "vocabulary")
    words = written(near_words(vocab), "near-words")
    return with_roots(words).select("word", "form", "root", "n", "n_near", "form_n")
