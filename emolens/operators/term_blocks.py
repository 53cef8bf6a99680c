"""TF-IDF of whole texts without a row per (document, term).

Documents are dealt into blocks by a hash of their key.  A block is read in one
group: its distinct terms are numbered, its cells (document, term, tf) are
arrays.  What leaves a block is its list of distinct terms, once, dealt by a
hash of the term and packed; so a shuffle holds a term once a block and not
once a document, and no (document, term) row is ever shuffled or written:

1. ``fit``: blocks -> distinct terms with document and term counts -> per part
   of the terms the totals, which give the vocabulary and, for each block, the
   weights of its terms in their order;
2. blocks and their weights meet and are materialised with the vocabulary's
   terms only (``docs``, ``cells``, ``terms``, packed with zstd);
3. what follows reads these blocks: `TextFeatures.long` makes the rows
   (doc, feature, value) where a query asks for them, ``sums`` the totals by
   feature and class, ``pairs`` an array per document of the selected features.

A block holds about `BLOCK_CHARS` characters of text, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emolens.functions.text import MISSING_TEXT, tokenize
from emolens.session import cut_lineage

BLOCK_CHARS = 16_000_000
TEXT_PREFIX = "0:"
PACKED = "block long, part int, packed binary"
BLOCKS = "block long, docs binary, cells binary, terms binary"
LONG = "feature string, value double"


def pack(**columns) -> bytes:
    batch = pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data) -> dict[str, pa.Array]:
    table = pa.ipc.open_stream(pa.py_buffer(data)).read_all().combine_chunks()
    return {n: _array(table[n]) for n in table.column_names}


def _array(column) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no chunk, or too many bytes for one
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column


def _rows(schema: dict, **columns) -> pa.Table:
    return pa.table({k: pa.array(columns[k], t) for k, t in schema.items()})


_PACKED = {"block": pa.int64(), "part": pa.int32(), "packed": pa.binary()}


def parts_of(terms: pa.Array, parts: int) -> np.ndarray:
    """The part of each term: a polynomial hash of its bytes."""
    n = len(terms)
    if not n:
        return np.zeros(0, np.int64)
    ends = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset:terms.offset + n + 1].astype(np.int64)
    data = np.frombuffer(terms.buffers()[2], np.uint8)[ends[0]:ends[-1]].astype(np.uint64)
    ends = ends - ends[0]
    lengths = np.diff(ends)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max()), 1_099_511_628_211, np.uint64))
        at = np.arange(len(data)) - np.repeat(ends[:-1], lengths)
        sums = np.add.reduceat((data + np.uint64(1)) * powers[at], ends[:-1])
        mixed = (sums ^ (sums >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(parts)).astype(np.int64)


@dataclass
class Counted:
    """A block: distinct documents, distinct terms by (part, term), and cells
    by (document, term) with their term frequency."""

    docs: pa.Array
    terms: pa.Array
    part: np.ndarray
    doc_at: np.ndarray
    term_at: np.ndarray
    tf: np.ndarray


def count_block(doc: pa.Array, tokens: pa.Array, ngram: tuple[int, int], parts: int) -> Counted:
    """Rows of one key count together; n-grams end with their row."""
    coded = doc.dictionary_encode(null_encoding="encode")
    lengths = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
    words = tokens.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(lengths)), lengths)
    of_row = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    word, n_words = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(words.dictionary)
    names, docs, codes, first = [], [], [], 0
    # grams of the level so far: where they begin, their code and their text
    start, code, text = np.arange(len(word)), word, words.dictionary
    for n in range(1, ngram[1] + 1):
        if n > 1:
            inside = start + n - 1 < len(word)
            start, code = start[inside], code[inside]
            inside = row[start] == row[start + n - 1]
            start, code = start[inside], code[inside]
            pair, code = np.unique(code * n_words + word[start + n - 1], return_inverse=True)
            text = pc.binary_join_element_wise(text.take(pa.array(pair // max(n_words, 1))),
                                               words.dictionary.take(pa.array(pair % max(n_words, 1))), " ")
        if n >= ngram[0]:
            names.append(text)
            docs.append(of_row[row[start]])
            codes.append(code + first)
            first += len(text)
    terms = pa.concat_arrays([x.cast(pa.string()) for x in names])
    order = pc.sort_indices(terms).to_numpy()
    part = parts_of(terms, parts)
    order = order[np.argsort(part[order], kind="stable")]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    size = max(len(terms), 1)
    cell, tf = np.unique(np.concatenate(docs) * size + place[np.concatenate(codes)], return_counts=True)
    return Counted(coded.dictionary, terms.take(pa.array(order)), part[order], cell // size, cell % size, tf)


def _by_part(c: Counted):
    """(part, first, last) runs of a block's terms."""
    starts = np.flatnonzero(np.r_[True, np.diff(c.part) > 0]) if len(c.part) else np.zeros(0, np.int64)
    return [(int(c.part[a]), a, b) for a, b in zip(starts, np.r_[starts[1:], len(c.part)])]


def _totals(rows: list[dict], values: Sequence[str]):
    """Distinct terms of packed rows, each row's terms as numbers of them, and
    the totals of ``values``."""
    each = [unpack(r) for r in rows]
    coded = pa.chunked_array([x["term"] for x in each]).combine_chunks()
    coded = _array(coded).dictionary_encode()
    at = coded.indices.to_numpy(zero_copy_only=False)
    sums = [np.bincount(at, weights=np.concatenate([x[v].to_numpy() for x in each]), minlength=len(coded.dictionary)) for v in values]
    return coded.dictionary, at, [len(x["term"]) for x in each], sums


class TextBlocks:
    """Rows (doc, text) dealt into blocks; terms are counted where needed."""

    def __init__(self, rows: DataFrame, doc: str, text: str, ngram: tuple[int, int] = (1, 1), blocks: int | None = None):
        t = F.coalesce(F.col(text), F.lit(MISSING_TEXT))
        self.doc, self.ngram = doc, (int(ngram[0]), int(ngram[1]))
        if blocks is None:
            chars = rows.agg(F.sum(F.length(t))).first()[0] or 0
            cores = rows.sparkSession.sparkContext.defaultParallelism
            blocks = max(1, -(-chars // BLOCK_CHARS), min(cores, -(-chars // (BLOCK_CHARS // 8))))
        self.blocks = int(blocks)
        dealt = rows.select(doc, t.alias("_t"), block_of(doc, self.blocks).alias("block"))
        # dealt by block as texts, which are smaller than their tokens
        self.rows = dealt.repartition("block").select("block", F.col(doc).cast("string").alias("doc"), tokenize("_t").alias("tokens"))

    def dictionary(self) -> DataFrame:
        """(block, part, packed): each block's distinct terms with their counts."""
        ngram, parts = self.ngram, self.blocks

        def terms(table: pa.Table) -> pa.Table:
            c = count_block(_array(table["doc"]), _array(table["tokens"]), ngram, parts)
            df = np.bincount(c.term_at, minlength=len(c.terms)).astype(np.int32)
            cf = np.bincount(c.term_at, weights=c.tf, minlength=len(c.terms)).astype(np.int64)
            runs = _by_part(c)
            block = table["block"][0].as_py()
            return _rows(_PACKED, block=[block] * len(runs), part=[p for p, _, _ in runs],
                         packed=[pack(term=c.terms.slice(a, b - a), df=df[a:b], cf=cf[a:b]) for _, a, b in runs])

        return self.rows.groupBy("block").applyInArrow(terms, PACKED)

    def fit(self, n_docs: float, min_df: int, max_df: float) -> DataFrame:
        """(block, part, packed): per block the idf of its terms, 0 for those
        that the vocabulary leaves out, and with block -1 the vocabulary."""

        def vocabulary(table: pa.Table) -> pa.Table:
            part = table["part"][0].as_py()
            terms, at, sizes, (df, cf) = _totals(table["packed"].to_pylist(), ("df", "cf"))
            kept = (df >= min_df) & (df <= max_df * n_docs)
            idf = np.where(kept, np.log((1.0 + n_docs) / (1.0 + df)) + 1.0, 0.0)
            ends = np.cumsum([0, *sizes])
            own = [pack(idf=idf[at[a:b]]) for a, b in zip(ends[:-1], ends[1:])]
            chosen = np.flatnonzero(kept)
            whole = pack(term=terms.take(pa.array(chosen)), df=df[chosen].astype(np.int64), cf=cf[chosen].astype(np.int64), idf=idf[chosen])
            return _rows(_PACKED, block=[*table["block"].to_pylist(), -1], part=[part] * (len(own) + 1), packed=[*own, whole])

        return cut_lineage(self.dictionary().groupBy("part").applyInArrow(vocabulary, PACKED))

    def lookup(self, vocabulary: DataFrame) -> DataFrame:
        """(block, part, packed) like `fit`, from the (term, idf) of a vocabulary."""
        parts = self.blocks

        def dealt(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array(parts_of(_array(b["term"]), parts), pa.int32()), b["term"], b["idf"]],
                                                 ["part", "term", "idf"])

        def found(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return _rows(_PACKED, block=[], part=[], packed=[])
            known, idf = _array(right["term"]), np.r_[_array(right["idf"]).to_numpy(zero_copy_only=False), 0.0]
            own = []
            for x in left["packed"].to_pylist():
                at = pc.index_in(unpack(x)["term"], value_set=known).fill_null(len(known)).to_numpy(zero_copy_only=False)
                own.append(pack(idf=idf[at]))
            return _rows(_PACKED, block=left["block"].to_pylist(), part=left["part"].to_pylist(), packed=own)

        words = vocabulary.select("term", "idf").mapInArrow(dealt, "part int, term string, idf double")
        return self.dictionary().groupBy("part").cogroup(words.groupBy("part")).applyInArrow(found, PACKED)

    def weigh(self, weights: DataFrame, only: Sequence[str] | None = None) -> "TextFeatures":
        """The blocks with the terms that have a weight (of ``only`` those)."""
        ngram, parts = self.ngram, self.blocks
        schema = {"block": pa.int64(), "docs": pa.binary(), "cells": pa.binary(), "terms": pa.binary()}

        def block(left: pa.Table, right: pa.Table) -> pa.Table:
            c = count_block(_array(left["doc"]), _array(left["tokens"]), ngram, parts) if left.num_rows else None
            if c is None or not len(c.terms):
                return _rows(schema, block=[], docs=[], cells=[], terms=[])
            had = dict(zip(right["part"].to_pylist(), right["packed"].to_pylist()))
            idf = np.concatenate([unpack(had[p])["idf"].to_numpy() for p, _, _ in _by_part(c)])
            if only is not None:
                idf = np.where(pc.is_in(c.terms, value_set=pa.array(only, pa.string())).to_numpy(zero_copy_only=False), idf, 0.0)
            kept = idf[c.term_at] > 0
            doc_at, term_at, tf = c.doc_at[kept], c.term_at[kept], c.tf[kept]
            w = (1.0 + np.log(tf)) * idf[term_at]
            norm = np.sqrt(np.bincount(doc_at, weights=w * w, minlength=len(c.docs)))
            chosen = np.flatnonzero(idf > 0)
            place = np.zeros(len(idf), np.int64)
            place[chosen] = np.arange(len(chosen))
            here = np.bincount(doc_at, minlength=len(c.docs))
            some = np.flatnonzero(here > 0)  # cells lie by document
            return _rows(schema, block=[left["block"][0].as_py()],
                         docs=[pack(doc=c.docs.take(pa.array(some)), cells=here[some].astype(np.int32), norm=norm[some])],
                         cells=[pack(term=place[term_at].astype(np.int32), tf=tf.astype(np.int32))],
                         terms=[pack(term=c.terms.take(pa.array(chosen)), idf=idf[chosen])])

        met = self.rows.groupBy("block").cogroup(weights.where("block >= 0").groupBy("block")).applyInArrow(block, BLOCKS)
        return TextFeatures(cut_lineage(met), self.doc, self.blocks)


def block_of(doc: str, blocks: int):
    return F.pmod(F.xxhash64(F.col(doc).cast("string")), F.lit(blocks))


def vocabulary_rows(weights: DataFrame) -> DataFrame:
    """(term, df, cf, idf) of what `TextBlocks.fit` gives."""
    def rows(batches):
        for b in batches:
            for x in b.column(0).to_pylist():
                x = unpack(x)
                for a in range(0, len(x["term"]), 100_000):
                    yield pa.RecordBatch.from_arrays([x[n].slice(a, 100_000) for n in ("term", "df", "cf", "idf")], ["term", "df", "cf", "idf"])

    return weights.where("block = -1").select("packed").mapInArrow(rows, "term string, df long, cf long, idf double")


def _block_cells(docs, cells, terms, names: pa.Array | None):
    """(docs, document of each cell, term of each cell, value, terms); of the
    terms in ``names`` only, numbered as there."""
    docs, cells, terms = unpack(docs), unpack(cells), unpack(terms)
    doc_at = np.repeat(np.arange(len(docs["doc"])), docs["cells"].to_numpy())
    at = cells["term"].to_numpy()
    tf, named = cells["tf"].to_numpy(), terms["term"]
    idf = terms["idf"].to_numpy()
    if names is not None:
        to = pc.index_in(named, value_set=names).fill_null(-1).to_numpy(zero_copy_only=False)
        inside = to[at] >= 0
        doc_at, at, tf = doc_at[inside], at[inside], tf[inside]
    value = (1.0 + np.log(tf)) * idf[at] / docs["norm"].to_numpy()[doc_at]
    return (docs["doc"], doc_at, at, value, named) if names is None else (docs["doc"], doc_at, to[at], value, names)


@dataclass
class TextFeatures:
    """Weighted blocks; ``names`` are the features that are selected, in
    order, or None for the whole vocabulary."""

    blocks: DataFrame
    doc: str
    n_blocks: int
    names: tuple[str, ...] | None = None

    def only(self, names: Sequence[str]) -> "TextFeatures":
        return replace(self, names=tuple(sorted(x for x in names if x.startswith(TEXT_PREFIX))))

    def _names(self) -> pa.Array | None:
        return None if self.names is None else pa.array([x[len(TEXT_PREFIX):] for x in self.names], pa.string())

    def long(self) -> DataFrame:
        """(doc, feature, value) rows."""
        names = self._names()

        def rows(batches):
            for b in batches:
                for x in zip(*(b.column(i).to_pylist() for i in range(3))):
                    docs, doc_at, at, value, terms = _block_cells(*x, names)
                    named = pc.binary_join_element_wise(pa.scalar(TEXT_PREFIX), terms, "")
                    for a in range(0, len(at), 50_000):
                        cut = slice(a, a + 50_000)
                        yield pa.RecordBatch.from_arrays(
                            [docs.take(pa.array(doc_at[cut])), named.take(pa.array(at[cut])), pa.array(value[cut])], ["doc", "feature", "value"])

        made = self.blocks.select("docs", "cells", "terms").mapInArrow(rows, f"doc string, {LONG}")
        return made.withColumnRenamed("doc", self.doc)

    def features(self) -> DataFrame:
        """(feature): the distinct features."""
        names = self._names()

        def rows(batches):
            for b in batches:
                for x in b.column(0).to_pylist():
                    terms = unpack(x)["term"]
                    terms = terms if names is None else terms.filter(pc.is_in(terms, value_set=names))
                    yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(pa.scalar(TEXT_PREFIX), terms, "")], ["feature"])

        return self.blocks.select("terms").mapInArrow(rows, "feature string").distinct()

    def sums(self, labels: DataFrame, label: str) -> DataFrame:
        """(feature, label, o): the values of a feature summed by class; each
        row of ``labels`` (doc, label) counts for its document."""
        names, parts = self._names(), self.n_blocks
        rows = labels.select(block_of(self.doc, self.n_blocks).alias("block"), F.col(self.doc).cast("string").alias("doc"),
                             F.col(label).cast("string").alias("label"))

        def block(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return _rows({"part": pa.int32(), "packed": pa.binary()}, part=[], packed=[])
            docs, doc_at, at, value, terms = _block_cells(*(left[c][0].as_py() for c in ("docs", "cells", "terms")), names)
            classes = _array(right["label"]).dictionary_encode(null_encoding="encode")
            own = pc.index_in(_array(right["doc"]), value_set=docs).to_numpy(zero_copy_only=False)
            code, known = classes.indices.to_numpy(zero_copy_only=False), ~np.isnan(own)
            # a cell counts once for each label row of its document
            own, code = own[known].astype(np.int64), code[known].astype(np.int64)
            code, rows_of = code[np.argsort(own, kind="stable")], np.bincount(own, minlength=len(docs))
            times = rows_of[doc_at]
            cell = np.repeat(np.arange(len(at)), times)
            nth = np.arange(len(cell)) - np.repeat(np.cumsum(times) - times, times)
            cls = code[(np.cumsum(rows_of) - rows_of)[doc_at[cell]] + nth]
            k = max(len(classes.dictionary), 1)
            key, to = np.unique(at[cell] * k + cls, return_inverse=True)
            o, term, cls = np.bincount(to, weights=value[cell], minlength=len(key)), key // k, key % k
            part = parts_of(terms, parts)[term]
            found = []
            for p in np.unique(part):
                i = part == p
                found.append((p, pack(term=terms.take(pa.array(term[i])), label=classes.dictionary.take(pa.array(cls[i])), o=o[i])))
            return _rows({"part": pa.int32(), "packed": pa.binary()}, part=[p for p, _ in found], packed=[x for _, x in found])

        def totals(table: pa.Table) -> pa.Table:
            each = [unpack(x) for x in table["packed"].to_pylist()]
            whole = pa.table({n: pa.chunked_array([x[n] for x in each]) for n in ("term", "label", "o")})
            got = whole.group_by(["term", "label"]).aggregate([("o", "sum")])
            named = pc.binary_join_element_wise(pa.scalar(TEXT_PREFIX), got["term"], "")
            return pa.table({"feature": named, "label": got["label"], "o": got["o_sum"]})

        packed = self.blocks.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(block, "part int, packed binary")
        got = packed.groupBy("part").applyInArrow(totals, "feature string, label string, o double")
        return got.withColumn("label", F.col("label").cast(labels.schema[label].dataType)).withColumnRenamed("label", label)

    def pairs(self, index: dict[str, int]) -> DataFrame:
        """(doc, p): per document the (index, value) of the features in ``index``."""
        chosen = sorted(x for x in index if x.startswith(TEXT_PREFIX) and (self.names is None or x in set(self.names)))
        names, number = pa.array([x[len(TEXT_PREFIX):] for x in chosen], pa.string()), np.array([index[x] for x in chosen], np.int32)

        def rows(batches):
            for b in batches:
                for x in zip(*(b.column(i).to_pylist() for i in range(3))):
                    docs, doc_at, at, value, _ = _block_cells(*x, names)
                    ends = np.searchsorted(doc_at, np.arange(len(docs) + 1)).astype(np.int32)
                    for a in range(0, len(docs), 2_000):
                        e = ends[a:a + 2_001]
                        s = slice(e[0], e[-1])
                        cells = pa.StructArray.from_arrays([pa.array(number[at[s]], pa.int32()), pa.array(value[s])], ["index", "value"])
                        yield pa.RecordBatch.from_arrays([docs.slice(a, 2_000), pa.ListArray.from_arrays(pa.array(e - e[0]), cells)], ["doc", "p"])

        made = self.blocks.select("docs", "cells", "terms").mapInArrow(rows, "doc string, p array<struct<index:int,value:double>>")
        return made.withColumnRenamed("doc", self.doc)


@dataclass
class Features:
    """The assembled features of a row set: text as blocks, the others (a
    category and a few numbers per document) as rows (doc, feature, value)."""

    text: TextFeatures
    other: DataFrame | None = None
    made: tuple[dict, DataFrame] | None = None

    @property
    def doc(self) -> str:
        return self.text.doc

    def long(self) -> DataFrame:
        return self.text.long() if self.other is None else self.text.long().unionByName(self.other)

    def only(self, selected: DataFrame) -> "Features":
        """Of the features in ``selected``, a bounded table, only."""
        names = [r[0] for r in selected.select("feature").collect()]
        other = None if self.other is None else self.other.join(F.broadcast(selected.select("feature")), "feature", "left_semi")
        return Features(self.text.only(names), other)

    def sums(self, labels: DataFrame, label: str) -> DataFrame:
        text = self.text.sums(labels, label)
        if self.other is None:
            return text
        rest = self.other.join(labels.select(self.doc, label), self.doc).groupBy("feature", label).agg(F.sum("value").alias("o"))
        return text.unionByName(rest)

    def names(self) -> DataFrame:
        """(feature): the distinct features."""
        text = self.text.features()
        return text if self.other is None else text.unionByName(self.other.select("feature").distinct())

    def pairs(self, index: DataFrame) -> DataFrame:
        """(doc, _p): per document its (index, value) pairs by index, of the
        features in ``index``, a bounded table.  Materialised: an array per
        document is read more than once."""
        number = {r["feature"]: r["index"] for r in index.collect()}
        if self.made is not None and self.made[0] == number:
            return self.made[1]
        p = self.text.pairs(number)
        if self.other is not None:
            rest = self.other.join(F.broadcast(index.select("feature", "index")), "feature").select(
                self.doc, F.array(F.struct("index", "value")).alias("p"))
            p = p.unionByName(rest)
        got = cut_lineage(p.groupBy(self.doc).agg(F.array_sort(F.flatten(F.collect_list("p"))).alias("_p")))
        self.made = number, got
        return got
