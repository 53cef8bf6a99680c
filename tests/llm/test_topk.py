import math

import numpy as np
from pyspark.sql import functions as F

from emolens.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, row string, far int"


def rows():
    rng = np.random.default_rng(3)
    out = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, 8)], 0, "", 0) for i in range(300)]
    same = out[7][1]
    out += [(1000 + i, same, 0, None, 0) for i in range(120)]
    out += [(2000, None, 0, "", 0), (2050, [1.0, None], 0, "", 0), (2100, [math.nan] * 8, 0, "", 0), (2150, [math.inf] * 8, 0, "", 0),
            (None, same, 0, "", 0), (2200, [], 0, "", 0), (2250, [0.5, 0.5], 0, "", 0), (2300, [0.0] * 8, 0, "", 0), out[3], out[3]]
    return out


def brute(k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows()
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, v in ok:
        if q % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found)}
    return out


def test_matches_brute_force(spark):
    table = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    for block, group in ((4096, 512), (50, 3)):
        got = topk.top_k(table, F.col("vec_id") % 50 == 0, block=block, query_block=group)
        assert {tuple(r) for r in got.collect()} == brute()


def test_bounds_stop_early_and_stay_exact():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 60, (12, 16))
    x = np.floor(centres[rng.integers(0, 12, 3000)] + rng.normal(0, 3, (3000, 16)))
    top = float((x ** 2).sum(1).max())
    lifted = topk._lift(x, top)
    pivots = topk.choose_pivots(lifted[:500], 32)
    ids = np.arange(len(x))
    found, evaluated = topk.search_block(ids[:40], x[:40], ids, x, pivots, topk._distances(lifted, pivots), top, 5)
    assert evaluated < 0.5 * 40 * len(x)
    want = [(q, i, int(s)) for q in range(40) for s, i in
            sorted(((x[q] @ x[i], i) for i in range(len(x)) if i != q), key=lambda z: (-z[0], z[1]))[:5]]
    assert found == want


def test_few_and_no_rows(spark):
    two = spark.createDataFrame([(0, [1.0], 0, "", 0), (1, [2.0], 0, "", 0)], SCHEMA)
    assert [tuple(r) for r in topk.top_k(two, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(two.limit(0), F.col("vec_id") % 50 == 0).count() == 0
