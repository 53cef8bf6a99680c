"""Similarity join on word n-grams: MinHash bands, verified on full sets.

Documents are joined when the Jaccard similarity of their sets of word
n-grams (n = 5; a text of 1 to 4 words is one n-gram) reaches the threshold
(0.8).  Steps:

1. each text gets a MinHash signature, cut into bands; band and row counts
   follow from the recall wanted at the threshold (`choose_bands`);
2. equal texts (SHA-256) become one class, so copies never meet in pairs;
3. band hashes are shuffled; classes that share one are tied to the smallest
   class of the bucket (as many ties as bucket entries, no pairs) and ties are
   contracted to candidate groups;
4. candidate groups are dealt into blocks of bounded size; every pair of
   blocks of a group is verified on full n-gram sets in one task.  A group,
   however large, is verified whole: there is no cap.  A task returns, per
   class, its number of links and a root of its linked classes - not pairs;
5. roots are contracted to components: `class_id` is the smallest document id
   of the component, `n_links` the number of other documents at or above the
   threshold (copies included).

Recall: a pair at the threshold shares a band with the probability given to
`choose_bands` (0.9999), a closer pair more surely; and a pair need not share
a band if others tie it to its group.  Verification is exact up to collisions
of 64-bit n-gram hashes.

Cases: null text is empty; texts without words have no n-grams and are joined
to equal texts only; rows without an id count as documents, a class of such
rows only has a null `class_id`; repeated rows are copies of each other;
other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from emolens.llm.common import WORD, free_name, text_chunks, written
from emolens.llm.graph import components

N, THRESHOLD, RECALL, MOST_HASHES, SEED = 5, 0.8, 0.9999, 256, 77
#: Classes of a block; a task holds the sets of two blocks.
BLOCK = 256

_word = re.compile(WORD).findall


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective rows per band whose number of bands
    for the recall at the threshold stays within ``most`` hashes."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-threshold ** rows))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(texts: list[str], n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all word n-grams, text after text, and their number
    per text."""
    words = [_word(t) for t in texts]
    count = np.array([len(w) for w in words], np.int64)
    flat = [w for one in words for w in one]
    sizes = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    if not flat:
        return np.zeros(0, np.uint64), sizes
    ids, unique = pd.factorize(np.array(flat, dtype=object))
    h = pd.util.hash_array(np.array(unique, dtype=object), categorize=False)[ids]
    starts = np.cumsum(count) - count
    first = np.repeat(starts, sizes) + (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    padded = np.append(h, np.zeros(n, np.uint64))
    end = np.repeat(starts + count, sizes)
    out = np.zeros(len(first), np.uint64)
    for j in range(n):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + np.where(first + j < end, padded[first + j], np.uint64(j + 1)))
    return out, sizes


def band_hashes(shingles: np.ndarray, sizes: np.ndarray, bands: int, rows: int, seed: int = SEED) -> np.ndarray:
    """(texts x bands) hashes of each band's minima, for texts with n-grams."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    rng = np.random.default_rng(seed)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(starts), b + 1, np.uint64)
        for _ in range(rows):
            flip, times = rng.integers(0, 1 << 32, 2, np.uint64).astype(np.uint32)
            y = (x ^ flip) * (times | np.uint32(1))
            y ^= y >> np.uint32(15)
            low = np.minimum.reduceat(y, starts)
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + low)
        out[:, b] = h
    return out


def signatures(docs: DataFrame, key: str, text: str, bands: int, rows: int, n: int) -> DataFrame:
    """(key, digest, bands) of each row; no bands without n-grams."""
    schema = StructType([docs.schema[key], StructField("digest", BinaryType(), False),
                         StructField("bands", ArrayType(LongType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in text_chunks(batches, text):
            hashes, sizes = shingle_hashes(texts, n)
            found = iter(band_hashes(hashes, sizes, bands, rows).view(np.int64).tolist() if len(hashes) else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(key), pa.array([hashlib.sha256(t.encode("utf-8")).digest() for t in texts], pa.binary()),
                 pa.array([next(found) if s else [] for s in sizes], pa.list_(pa.field("element", pa.int64(), False)))],
                schema.names)

    return docs.select(*dict.fromkeys([key, text])).mapInArrow(run, schema)


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def overlaps(a: list[np.ndarray], b: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of sorted sets, as a matrix."""
    sets = [*a, *b]
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    out = np.zeros((len(a), len(b)))
    total = int(code[-1]) + 1 if len(code) else 0
    for lo in range(0, total, columns):
        i, j = np.searchsorted(code, [lo, lo + columns])
        m = np.zeros((len(sets), min(columns, total - lo)), np.float32)
        m[owner[i:j], code[i:j] - lo] = 1
        out += m[:len(a)] @ m[len(a):].T
    return out


def linked(a: list[np.ndarray], b: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets reach the Jaccard threshold."""
    if len(a) == len(b) == 1:
        both = np.array([[len(np.intersect1d(a[0], b[0], assume_unique=True))]], float)
    else:
        both = overlaps(a, b)
    union = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None] - both
    return both >= threshold * union - 1e-9


_FOUND = "vid long, root long, n long, several boolean"


def verify_blocks(batches: Iterator[pa.RecordBatch], threshold: float, n: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (comp, a, b); one pair of blocks at a time."""
    def verified(rows: list[dict]) -> list[tuple]:
        shingles, sizes = shingle_hashes([r["t"] or "" for r in rows], n)
        sets = [np.unique(s) for s in np.split(shingles, np.cumsum(sizes)[:-1])]
        left = [i for i, r in enumerate(rows) if r["block"] == rows[0]["a"]]
        right = left if rows[0]["a"] == rows[0]["b"] else [i for i, r in enumerate(rows) if r["block"] == rows[0]["b"]]
        if not left or not right or len(left) == len(right) == 1 and left == right:
            return []
        if left is right and len(left) == 2:
            left, right, inner = left[:1], left[1:], False
        else:
            inner = left is right
        hit = linked([sets[i] for i in left], [sets[i] for i in right], threshold)
        if inner:
            np.fill_diagonal(hit, False)
        copies = np.array([r["copies"] for r in rows], np.int64)
        count, forest = np.zeros(len(rows), np.int64), _Forest(len(rows))
        count[left] += hit @ copies[right]
        if not inner:
            count[right] += hit.T @ copies[left]
        for i, j in zip(*np.nonzero(hit), strict=True):
            forest.join(left[i], right[j])
        return [(r["vid"], rows[forest.root(i)]["vid"], int(count[i]), r["blocks"] > 1)
                for i, r in enumerate(rows) if count[i]]

    def emit(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)],
            ["vid", "root", "n", "several"])

    now, group, out = None, [], []
    for batch in batches:
        for r in batch.to_pylist():
            at = (r["comp"], r["a"], r["b"])
            if at != now:
                out += verified(group) if group else []
                now, group = at, []
                if len(out) > 5000:
                    yield emit(out)
                    out = []
            group.append(r)
    out += verified(group) if group else []
    if out:
        yield emit(out)


def join_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD,
                 recall: float = RECALL, most_hashes: int = MOST_HASHES, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(documents, classes): documents has (key, digest); classes has one row
    per text (digest, copies, class_id, class_digest, n_links)."""
    bands, rows = choose_bands(threshold, recall, most_hashes)
    signed = written(signatures(docs, key, text, bands, rows, n), "signatures")
    classes = written(
        signed.groupBy("digest").agg(F.min(key).alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
        .withColumn("vid", F.monotonically_increasing_id()), "classes")

    entries = classes.select("vid", F.explode("bands").alias("band"))
    buckets = entries.groupBy("band").agg(F.min("vid").alias("low"), F.count("*").alias("c")).where("c > 1").drop("c")
    ties = entries.join(buckets, "band").where("vid <> low").select(F.col("vid").alias("u"), F.col("low").alias("v"))
    tied = components(ties)
    sizes = tied.groupBy("root").agg((F.count("*") + 1).alias("m"))
    member = (tied.select(F.col("node").alias("vid"), F.col("root").alias("comp"))
              .unionAll(sizes.select(F.col("root").alias("vid"), F.col("root").alias("comp")))
              .join(sizes.select(F.col("root").alias("comp"), F.ceil(F.col("m") / block).cast("int").alias("blocks")), "comp"))
    wanted = classes.select("vid", "digest", "rep", "copies").join(member, "vid")

    body, digest = F.coalesce(F.col(text), F.lit("")), free_name([key], "digest")
    texts = docs.select(F.col(key).alias("rep"), body.alias("t")).withColumn(
        digest, F.unhex(F.sha2(F.encode("t", "utf-8"), 256)))
    at = texts.alias("x").join(wanted.alias("w"), (F.col(f"x.{digest}") == F.col("w.digest"))
                               & F.col("x.rep").eqNullSafe(F.col("w.rep")))
    own = F.pmod(F.xxhash64("w.vid"), F.col("w.blocks")).cast("int")
    dealt = (at.select("w.vid", "w.comp", "w.blocks", "w.copies", own.alias("block"), "x.t")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("vid", "comp", "blocks", "copies", "block", "t",
                     F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b")))
    ordered = dealt.dropDuplicates(["vid", "comp", "a", "b"]) if _repeats(signed, key) else dealt
    ordered = ordered.repartition("comp", "a", "b").sortWithinPartitions("comp", "a", "b")
    found = written(ordered.mapInArrow(lambda b: verify_blocks(b, threshold, n), _FOUND), "verified")

    counts = found.groupBy("vid").agg(F.sum("n").alias("n"))
    roots = found.where("not several").select("vid", "root").unionAll(
        components(found.where("several").select(F.col("vid").alias("u"), F.col("root").alias("v")))
        .select(F.col("node").alias("vid"), "root"))
    placed = written(classes.select("vid", "digest", "rep", "copies").join(counts, "vid", "left").join(roots, "vid", "left")
                     .select("digest", "rep", "copies", F.coalesce("root", "vid").alias("root"),
                             (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "placed")
    heads = placed.groupBy("root").agg(F.min("rep").alias("class_id"), F.min(F.struct(
        F.col("rep").isNull().alias("none"), "rep", "digest")).alias("h")).select("root", "class_id", F.col("h.digest").alias("class_digest"))
    return signed.select(key, "digest"), placed.join(heads, "root").select(
        "digest", "copies", "class_id", "class_digest", "n_links")


def _repeats(signed: DataFrame, key: str) -> bool:
    """Whether a row (id and text) occurs twice."""
    return bool(signed.groupBy(key, "digest").count().where("count > 1").limit(1).count())


def similarity_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: key, ``class_id``, ``n_links``."""
    rows, classes = join_classes(docs, key, text, **options)
    return rows.join(classes, "digest").select(key, "class_id", "n_links")


def one_per_class(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class, that of the smallest id
    (classes without ids: of the smallest digest); repeated rows become one."""
    rows, classes = join_classes(docs, key, text, **options)
    heads = classes.select("class_id", "class_digest").distinct()
    digest = free_name(docs.columns, "digest_")
    marked = docs.withColumn(digest, F.unhex(F.sha2(F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8"), 256)))
    kept = marked.alias("a").join(heads.alias("h"), (F.col(f"a.{digest}") == F.col("h.class_digest"))
                                  & F.col(f"a.{key}").eqNullSafe(F.col("h.class_id")), "left_semi")
    if _repeats(rows, key):
        kept = kept.dropDuplicates([key, digest])
    return kept.select(*[f"`{c}`" for c in docs.columns])
