import hashlib

import numpy as np
import pytest

from emolens.llm import suffix
from tests.llm.data import awkward, awkward_rows, empty, text


def brute(rows, length=50):
    raw = [((1 << 63) - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in raw:
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for (i, b), (d, _) in zip(raw, rows, strict=True):
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < i:
                gone[k:k + length] = True
        gone = gone[:len(b)]
        runs = int((np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1).sum())
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return sorted(out, key=str)


def test_suffix_array_and_prefixes_match_brute_force():
    rng = np.random.default_rng(0)
    for trial in range(150):
        n, k = int(rng.integers(1, 150)), int(rng.integers(1, 6))
        t = rng.integers(1, k + 1, n)
        if trial % 3 == 0:
            t = np.tile(t[:4], 20)
        t = np.append(t, 0)
        sa = suffix.suffix_array(t, len(t))
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
        p = suffix.permuted_prefixes(t.astype(np.uint8), sa, 20)
        for a, b in zip(sa, sa[1:]):
            x, y = t[a:].tolist(), t[b:].tolist()
            m = next((i for i, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))
            assert min(int(p[b]), 20) >= min(m, 20) if m == len(x) or m == len(y) else p[b] == min(m, 20)


def test_large_alphabets_are_doubled(monkeypatch):
    rng = np.random.default_rng(1)
    t = np.append(rng.integers(1, 5000, 4000), 0)
    assert suffix.suffix_array(t, len(t)).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def test_anchors_depend_on_the_window_only():
    rng = np.random.default_rng(2)
    for noise in (4, 26):
        core = bytes(rng.integers(97, 97 + noise, 50).astype(np.uint8))
        seen = set()
        for _ in range(20):
            a, b = (bytes(rng.integers(97, 97 + noise, int(rng.integers(0, 90))).astype(np.uint8)) for _ in range(2))
            window, anchor, h = suffix.anchors(np.frombuffer(a + core + b, np.uint8), np.array([0]))
            seen.add(int(h[anchor[window == len(a)][0]]))
        assert len(seen) == 1


def rows():
    out = [(i, t) for i, t, *_ in awkward_rows()]
    common = text(70, 40)
    out += [(200 + i, text(300 + i, 30) + common + text(400 + i, 30)) for i in range(30)]
    out += [(300, "ab" * 300), (301, "ab" * 40), (302, "\x00" * 120), (303, "\x00" * 80 + "x"), (304, "é" * 60), (305, "xé" + "é" * 40)]
    return out


@pytest.mark.parametrize("options", [{}, {"heavy": 2}, {"heavy": 3, "hot_bytes": 2000}])
def test_matches_brute_force(spark, options):
    docs = spark.createDataFrame(rows(), "doc_id long, text string").repartition(3)
    got = suffix.remove_repeats(docs, **options).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == brute(rows())
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_long_texts_are_dealt_out_in_parts(monkeypatch):
    t = text(5, 3000).encode()
    whole = suffix.anchors(np.frombuffer(t, np.uint8), np.array([0]))
    parts = [(w + o[0][1], h[a]) for d, s, o in suffix._pieces_of([t], [0], 700) for w, a, h in [suffix.anchors(d, s)]]
    assert np.concatenate([w for w, _ in parts]).tolist() == whole[0].tolist()
    assert np.concatenate([h for _, h in parts]).tolist() == whole[2][whole[1]].tolist()


def test_clashing_columns_and_empty_table(spark):
    docs = awkward(spark).withColumnRenamed("lang", "id").withColumnRenamed("source", "text_hash")
    assert suffix.remove_repeats(docs).count() == len(awkward_rows())
    assert suffix.remove_repeats(empty(spark)).count() == 0
