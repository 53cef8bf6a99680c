import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from emolens.llm import merkle
from tests.llm.data import DOC_SCHEMA, awkward, awkward_rows, empty

H = lambda *p: hashlib.sha256("".join(p).encode()).hexdigest()
ORDER = merkle.FIELDS


def leaf(row):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(*(part(row[f]) for f in ORDER))


def tree(hashes):
    """Levels of nodes from the leaves up."""
    levels = [list(hashes)]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([H(*now[i:i + 8]) for i in range(0, len(now), 8)])
    return levels


def siblings(levels, pos):
    for nodes in levels[:-1]:
        lo = pos // 8 * 8
        yield nodes[lo:pos], nodes[pos + 1:lo + 8]
        pos //= 8


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) per row."""
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for g_at, g in enumerate(names):
        for pos, (has, _, h, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps = [*siblings(trees[g], pos), *siblings(top, g_at)]
            r = dict(r)
            if has and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
                r["text"] = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
            back = leaf(r)
            for a, b in steps:
                back = H(*a, back, *b)
            out.append((r["doc_id"], h, trees[g][-1][0], top[-1][0], H(*(x for a, b in steps for x in (*a, *b))), back,
                        back == top[-1][0]))
    return out


def named(rows):
    return [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows]


def check(spark, rows, extra=None):
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)
    got = merkle.verify_tampered(docs if extra is None else extra(docs))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(tuple(r) for r in got.collect()) == Counter(brute(named(rows)))


def test_awkward_rows_against_brute_force(spark):
    check(spark, awkward_rows())


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_run_lengths(spark, n):
    check(spark, [(i, f"Text {i}", "en", "s", 6) for i in range(n)])


def test_many_groups_of_unlike_sizes(spark):
    rows = [(i, f"Text {i}", None if i % 29 == 0 else f"l{i % 17}" if i % 3 else "hot", "s", None) for i in range(400)]
    rows += rows[:40]  # repeated rows
    check(spark, rows)


def test_fields_do_not_run_together():
    row = {"doc_id": 1, "source": "a", "lang": "b", "n_chars": 1, "text": "x"}
    other = row | {"source": "a1:b", "lang": None}
    assert leaf(row) != leaf(other) and leaf(row | {"text": None}) != leaf(row | {"text": ""})


def test_clashing_columns_take_no_part(spark):
    extra = lambda d: d.withColumns({c: F.lit("x") for c in ("h", "grp", "pos", "n", "row", "key", "changed", "a.b")})
    check(spark, awkward_rows(), extra)


def test_no_document_moves_the_root_alone(spark):
    """A changed, missing or moved row changes the root."""
    rows = [(i, f"t{i}", "en", "s", 2) for i in range(20)]
    root = lambda rs: merkle.verify_tampered(spark.createDataFrame(rs, DOC_SCHEMA)).first()["root"]
    roots = {root(rows), root(rows[:-1]), root([*rows[:5], (5, "other", "en", "s", 2), *rows[6:]]),
             root([(99, *rows[0][1:]), *rows[1:]])}
    assert len(roots) == 4


def test_window_partitions_are_runs(spark):
    """No window holds a group: each partitions by (group, run) or by the
    sort partition."""
    m = merkle.build(awkward(spark), {"doc_id": F.col("doc_id")}, {}, F.col("lang"), F.col("doc_id"))
    plan = merkle.with_siblings(m.leaves)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and all("[grp#" in x and "run#" in x for x in plan.split("\n") if x.strip().startswith("+- Window"))


def test_empty_table(spark):
    assert merkle.verify_tampered(empty(spark)).count() == 0
