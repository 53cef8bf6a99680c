import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from emolens.llm import packing
from tests.llm.data import awkward, awkward_rows, empty

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def test_hilbert_visits_every_cell_by_single_steps():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1).T
        place = packing.hilbert(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        path = cells[np.argsort(place)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_pieces_partition_every_document(spark):
    docs = awkward(spark).withColumn("ids", F.lit(1)).withColumn("place", F.lit(2)).withColumn("row_key", F.lit(3))
    rows = packing.piece_checksums(packing.pack(docs, PATH, length=64)).collect()
    ids = defaultdict(list)
    for i, t, *_ in awkward_rows():
        ids[i].append(LIBRARY.encode(t or "", add_special_tokens=False).ids + [2])
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    got, want = defaultdict(int), defaultdict(int)
    for r in rows:
        texts = [x for x in ids[r.doc_id] if len(x) == r.doc_tokens and crc(x[r.start:r.start + r.length]) == r.ids_crc32]
        assert texts
        got[r.doc_id] += r.length
    for i, all_ in ids.items():
        want[i] += sum(map(len, all_))
    assert got == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for s, parts in by.items():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == 64 or s == max(by)
    assert sorted(by) == list(range(len(by)))


def test_checksums_of_the_cutting_task(spark):
    rows = lambda df: sorted((r.doc_id or 0, r.start, r.sequence_id, r.offset, r.length, r.doc_tokens, r.ids_crc32) for r in df.collect())
    docs = awkward(spark).where("doc_id <> 16")
    later = packing.piece_checksums(packing.pack(docs, PATH, length=64))
    assert rows(packing.pack(docs, PATH, length=64, checksums=True)) == rows(later)


def test_neighbours_share_sequences(spark):
    rows = [(i, ("alpha beta gamma " if i % 2 else "uno dos tres ") * 20, "", "", 0) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    pieces = packing.pack(docs, PATH, length=64).orderBy("sequence_id", "offset").collect()
    kinds = [r.doc_id % 2 for r in pieces]
    assert sum(a != b for a, b in zip(kinds, kinds[1:])) == 1


def test_empty_table(spark):
    assert packing.pack(empty(spark), PATH).count() == 0
