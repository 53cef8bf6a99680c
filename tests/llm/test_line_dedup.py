import re
from collections import defaultdict

from pyspark.sql import functions as F

from emolens.llm import line_dedup
from tests.llm.data import awkward, empty, text

W = re.compile(r"[^\x20\x09-\x0D]")


def brute(rows):
    """rows: (id, text, chunks) -> texts."""
    first = defaultdict(set)
    several = lambda c: sum(bool(W.search(x)) for x in c.split("\n")) >= 2
    order = lambda i: (i is not None, i or 0)
    for i, t, cs in rows:
        for k, c in enumerate(cs or ()):
            if several(c):
                first[c].add((order(i), t, k))
    out = []
    for i, t, cs in rows:
        if t is None:
            out.append((i, None))
            continue
        kept = []
        for k, c in enumerate(cs):
            places = first.get(c, ())
            # of one id, the row hash decides; the cases here hold one text per id
            if not places or min((o, n) for o, _, n in places) == (order(i), k):
                kept.append(c)
        out.append((i, t if len(kept) == len(cs) else "\n".join(kept)))
    return out


def test_matches_brute_force(spark):
    docs = awkward(spark).where("doc_id is not null").withColumn("pos_", F.lit(1)).withColumn("drop_", F.lit(2))
    rows = [(r.doc_id, r.text, r.c) for r in docs.select("doc_id", "text", line_dedup.chunks(F.col("text")).alias("c")).collect()]
    assert all("\n".join(cs) == t for _, t, cs in rows if t is not None)
    out = line_dedup.remove_repeated_chunks(docs)
    assert out.schema == docs.schema
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted(brute(rows), key=str)
    by = defaultdict(list)
    for i, t in got:
        by[i].append(t)
    assert len(by[16]) == 2 and by[16][0] == by[16][1] == text(16, 60)
    assert len(by[2][0]) < 40 < len(by[1][0])


def test_boundaries_resist_shifts(spark):
    base = text(7, 900)
    docs = spark.createDataFrame([(1, base), (2, "one new line\n" + base), (3, base.replace("\n", "\nmiddle line\n", 1))],
                                 "doc_id long, text string")
    out = {r.doc_id: r.text for r in line_dedup.remove_repeated_chunks(docs).collect()}
    assert out[1] == base and len(out[2]) < 0.3 * len(base) and len(out[3]) < 0.3 * len(base)


def test_single_and_blank_lines_stay(spark):
    docs = spark.createDataFrame([(i, t) for i in range(4) for t in ["one common line"]] + [(10, "\n\n\n"), (11, "\n\n\n"), (12, None)],
                                 "doc_id long, text string")
    out = line_dedup.remove_repeated_chunks(docs, removed="n")
    assert [r.n for r in out.collect()] == [0] * 7
    assert sorted(str(r.text) for r in out.collect()) == sorted(str(r.text) for r in docs.collect())


def test_null_id_is_first_and_empty_table(spark):
    t = text(3, 200)
    docs = spark.createDataFrame([(None, t), (1, t)], "doc_id long, text string")
    out = {r.doc_id: r.text for r in line_dedup.remove_repeated_chunks(docs).collect()}
    assert out[None] == t and len(out[1]) < len(t) // 3
    assert line_dedup.remove_repeated_chunks(empty(spark)).count() == 0


def test_plan_has_no_python(spark):
    plan = line_dedup.remove_repeated_chunks(awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def brute_runs(rows):
    """rows: (id, text), one text per id -> texts, number of passages."""
    def windows(t):
        at = [i for i, x in enumerate(t.split("\n")) if W.search(x)]
        return [(a, b, "\n".join(t.split("\n")[a:b + 1])) for a, b in zip(at, at[1:], strict=False)]

    order = lambda i: (i is not None, i or 0)
    first = {}
    for i, t in sorted(rows, key=lambda r: order(r[0])):
        for k, (_, _, c) in enumerate(windows(t or "")):
            first.setdefault(c, (order(i), k))
    out = []
    for i, t in rows:
        cut = set()
        for k, (a, b, c) in enumerate(windows(t or "")):
            if first[c] < (order(i), k) and first[c] != (order(i), k - 1):
                cut |= set(range(a, b + 1))
        lines = (t or "").split("\n")
        for n in range(1, len(lines)):
            if n - 1 in cut and not W.search(lines[n]):
                cut.add(n)
        out.append((i, t if t is None else "\n".join(x for n, x in enumerate(lines) if n not in cut),
                    sum(bool(W.search(lines[n])) and not any(m in cut and W.search(lines[m]) and not any(W.search(x) for x in lines[m + 1:n])
                                                             for m in range(n)) for n in cut)))
    return out


def test_runs_match_brute_force(spark):
    rows = {i: t for i, t in ((r.doc_id, r.text) for r in awkward(spark).collect())}
    rows.pop(None), rows.pop(12)
    rows |= {30: "a\na\na", 31: "b\nb\nb\nb\nb", 32: "\n\na one\n\nb one\n \nc", 33: "x\na one\n\nb one\nc", 34: "q\na one\nb one", 35: "\n\n"}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, line_dedup.remove_shared_runs(docs, removed="n").collect()), key=str)
    assert got == sorted(brute_runs(list(rows.items())), key=str)
    assert dict((i, t) for i, t, _ in got)[31] == "b\nb" and dict((i, t) for i, t, _ in got)[30] == "a\na\na"


def test_short_passages_inside_documents(spark):
    rows = []
    for n in range(2, 7):
        passage = text(1000 + n, 9 * n)
        rows += [(100 * n + k, f"{text(100 * n + k, 45)}\n{passage}\n{text(5000 + 100 * n + k, 45)}") for k in range(4)]
    out = {r.doc_id: r for r in line_dedup.remove_shared_runs(spark.createDataFrame(rows, "doc_id long, text string"), removed="n").collect()}
    for i, t in rows:
        if i % 100 == 0:
            assert out[i].text == t and out[i].n == 0
        else:
            assert out[i].text == f"{text(i, 45)}\n{text(5000 + i, 45)}" and out[i].n == 1


def test_runs_of_equal_hash_are_compared(spark, monkeypatch):
    monkeypatch.setattr(line_dedup.F, "xxhash64", lambda *a: F.hash(F.lit(1)).cast("long") + F.length(F.concat(*a)) * 0)
    rows = [(1, "a\nb\nc\nd"), (2, "x\nb\nc\ny"), (3, "e\nf\ng\nh")]
    out = dict(map(tuple, line_dedup.remove_shared_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert out == {1: "a\nb\nc\nd", 2: "x\ny", 3: "e\nf\ng\nh"}


def test_runs_of_repeated_rows_nulls_and_plan(spark):
    t = text(3, 200)
    docs = spark.createDataFrame([(None, t), (1, t), (2, text(4, 90)), (2, text(4, 90))], "doc_id long, text string")
    out = [tuple(r) for r in line_dedup.remove_shared_runs(docs).collect()]
    assert sorted(out, key=str) == sorted([(None, t), (1, ""), (2, text(4, 90)), (2, text(4, 90))], key=str)
    assert line_dedup.remove_shared_runs(empty(spark)).count() == 0
    plan = line_dedup.remove_shared_runs(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
