"""Exact top-k inner products by pivot-table elimination.

Inner products become distances: with M the largest norm, a candidate x is
lifted to (x, sqrt(M^2 - |x|^2)) and a query q to (q, 0), so that

    |q' - x'|^2 = |q|^2 + M^2 - 2 <q, x>

and the highest scores are the nearest candidates.  A table holds every
candidate's distance to many pivots; the largest |d(q', p) - d(x', p)| is a
lower bound of its distance to the query.  A query evaluates candidates in
order of that bound and stops when the next bound exceeds its k-th distance:
no candidate is left out that could enter (bounds are loosened by their
rounding error, ties are evaluated).

Scale: candidates and queries are dealt into blocks of bounded size; each
(candidate block, query block) is one row group of an equi-join on the query
block, worked on its own and reduced to k rows per query, then merged by
query.  The work is (queries x rows) at worst, which is what the task states;
the blocks keep every task's memory bounded.  Broadcast: the pivots only
(a parameter).

Cases: vectors that are null, or hold null or non-finite components, take no
part, nor do rows without an id; vectors of different length are compared as
if the shorter ended in zeros; an empty vector scores 0 with everything;
repeated rows are candidates each, and never their own query's candidates.
Scores are exact while they stay below 2^53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emolens.llm.common import written

PIVOTS = 48
#: Rows that pivots are chosen from, those of least hash (documented bound).
PIVOT_SAMPLE = 2_000
BLOCK, QUERY_BLOCK = 4096, 512


def usable(vector: str) -> Column:
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(False))


def integer_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, v): floor(scale * x) of each component of the usable vectors."""
    return rows.where(F.col(key).isNotNull() & usable(vector)).select(
        F.col(key).cast("long").alias("id"),
        F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double")).alias("v"))


def choose_pivots(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Farthest-first pivots of a sample: spread pivots bound best."""
    if not len(sample):
        return sample
    picked = [int(np.argmax((sample ** 2).sum(1)))]
    gap = ((sample - sample[picked[0]]) ** 2).sum(1)
    while len(picked) < min(n, len(sample)) and gap.max() > 0:
        picked.append(int(np.argmax(gap)))
        gap = np.minimum(gap, ((sample - sample[picked[-1]]) ** 2).sum(1))
    return sample[picked]


def _matrix(batch_column: pa.Array, dim: int) -> np.ndarray:
    lists = batch_column.to_pylist()
    out = np.zeros((len(lists), dim))
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return out


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    """Candidates with the component that makes all norms equal."""
    return np.hstack([x, np.sqrt(np.maximum(top - (x ** 2).sum(1), 0))[:, None]])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d = (x ** 2).sum(1)[:, None] + (pivots ** 2).sum(1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(d, 0))


def search_block(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, pivots: np.ndarray, table: np.ndarray,
                 top: float, k: int, step: int = 128) -> tuple[list[tuple[int, int, int]], int]:
    """The k best candidates of a block for each query, and how many
    candidates were evaluated.  ``table``: candidates' distances to the
    lifted pivots; ``top``: the square of the largest norm."""
    out, evaluated = [], 0
    to_pivots = _distances(np.hstack([q, np.zeros((len(q), 1))]), pivots)
    norm = (q ** 2).sum(1)
    for i in range(len(q)):
        bound = np.abs(table - to_pivots[i]).max(1)
        # what a score can be at most; loosened by far more than rounding
        most = (norm[i] + top - np.maximum(bound - 1e-4 * (1 + bound), 0) ** 2) / 2 + 1e-6 * (1 + norm[i] + top)
        order = np.argsort(-most, kind="stable")
        order = order[cid[order] != qid[i]]
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        for a in range(0, len(order), step):
            if len(ids) == k and most[order[a]] < scores[-1]:
                break
            at = order[a:a + step]
            evaluated += len(at)
            ids = np.append(ids, cid[at])
            scores = np.append(scores, c[at] @ q[i])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
        out += [(int(qid[i]), int(x), int(s)) for x, s in zip(ids, scores, strict=True)]
    return out, evaluated


def top_k(rows: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
          scale: int = 256, block: int = BLOCK, query_block: int = QUERY_BLOCK, n_pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, id, score) of each query row's k best candidates."""
    spark = rows.sparkSession
    vecs = written(integer_vectors(rows, key, vector, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = vecs.withColumnRenamed("id", key).where(is_query).withColumnRenamed(key, "id")
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, dim, top = vecs.agg(F.count("*"), F.max(F.size("v")), F.max(norm2)).first()
    n_asked = asked.count()
    dim, top = int(dim or 0), float(top or 0)
    n_blocks, n_groups = -(-n // block) or 1, -(-n_asked // query_block) or 1
    sample = vecs.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).select("v").collect()
    full = np.zeros((len(sample), dim))
    for i, r in enumerate(sample):
        full[i, :len(r[0])] = r[0]
    pivots = choose_pivots(_lift(full, top), n_pivots)

    # the pivot table, one row per candidate
    def tabled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("v"), dim)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("row"), pa.array([r.tobytes() for r in x], pa.binary()),
                 pa.array([r.tobytes() for r in _distances(_lift(x, top), pivots)], pa.binary())], ["id", "row", "v", "far"])

    pairs = vecs.mapInArrow(tabled, "id long, row long, v binary, far binary").withColumn(
        "block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int"))
    # each candidate block meets each group of queries: rows of the join are whole blocks
    blocks = pairs.groupBy("block").agg(F.collect_list(F.struct("id", "v", "far")).alias("c")).select(
        F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("part"), "block", "c")
    groups = (asked.mapInArrow(lambda bs: (pa.RecordBatch.from_arrays(
        [b.column("id"), b.column("row"), pa.array([r.tobytes() for r in _matrix(b.column("v"), dim)], pa.binary())],
        ["id", "row", "v"]) for b in bs), "id long, row long, v binary")
        .withColumn("part", F.pmod(F.xxhash64("row"), F.lit(n_groups)).cast("int"))
        .groupBy("part").agg(F.collect_list(F.struct("id", "v")).alias("q")))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c, q in zip(b.column("c").to_pylist(), b.column("q").to_pylist(), strict=True):
                arr = lambda rows, f: np.array([np.frombuffer(r[f]) for r in rows]).reshape(len(rows), -1)
                ids = lambda rows: np.array([r["id"] for r in rows], np.int64)
                found, _ = search_block(ids(q), arr(q, "v"), ids(c), arr(c, "v"), pivots, arr(c, "far"), top, k)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)],
                                                     ["query_id", "id", "score"])

    # the join fixes one row per pair of blocks; dealing them out by pair spreads the work
    met = (blocks.join(groups, "part").repartition(max(1, min(n_blocks * n_groups, 4 * spark.sparkContext.defaultParallelism)),
                                                   "part", "block"))
    near = met.select("c", "q").mapInArrow(searched, "query_id long, id long, score long")
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))), 1, k)
    return (near.groupBy("query_id").agg(best.alias("b"))
            .select("query_id", F.posexplode("b").alias("i", "x"))
            .select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.id").alias(key),
                    (-F.col("x.s")).alias("score")))
