"""BPE encoding by forced-boundary splitting, and decoding.

A pair of neighbouring bytes that occurs inside no vocabulary token can never
be joined by a merge, so a cut between them is certain.  A text is cut at
white space, at the pre-tokenizer's boundaries and at these byte pairs; the
fragments are encoded independently and their ids concatenated.  The words of
a slice of texts are found and looked up together, by array operations, in a
cache of a fixed number of bytes; those that it lacks are cut and encoded
together, over all their fragments.  No shuffle: one pass over the rows,
memory bounded by the cache and the longest text.

Built for tokenizer files whose pre-tokenizer is the word pattern
`WORD_PATTERN` and whose model is BPE over byte characters with an
end-of-word suffix; `load` checks that.

Cases: null and empty texts have no ids; special-token strings in a text
become their ids, as in the tokenizers library; rows are independent, so
repeated rows, ties and empty tables need nothing special.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from emolens.llm.common import text_chunks

#: Fixed values of the tokenizer file's format.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SUFFIX = "</w>"

#: Bytes of text encoded together.
SLICE = 1_000_000

#: Bytes of the cache, and what a word takes: two slots and a few ids.
CACHE, ENTRY = 40_000_000, 80

#: Words looked up together.
BLOCK = 1 << 18

#: The white space of the pattern's \s, as a character class.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WHITE = regex.compile(f"[{_SPACE}]+")
_PIECES = regex.compile(WORD_PATTERN.replace(r"\s", _SPACE)).findall
#: White space of two and three bytes of UTF-8, as numbers.
_WIDE = [np.array([int.from_bytes(b) for c in map(chr, range(0x80, 0x3001))
                   if _WHITE.match(c) and len(b := c.encode("utf-8")) == n]) for n in (2, 3)]

# Kinds of bytes: white space, letter, digit, apostrophe, other ASCII, part of a
# longer character.  Whatever stands around them, the pattern cuts next to a
# digit, after a letter, and before one that follows another ASCII character.
_KIND = np.full(256, 4, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 1
_KIND[[*b"0123456789"]] = 2
_KIND[ord("'")] = 3
_KIND[128:] = 5
_CUT = np.zeros((8, 8), bool)
_CUT[1, [2, 3, 4]] = _CUT[2, [1, 2, 3, 4]] = _CUT[4, [1, 2]] = True
_BEGINS, _ENDS = _CUT.copy(), _CUT.copy()
_BEGINS[0, 1:] = _ENDS[1:, 0] = True


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: itself where printable, else the next free one from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


class _Merges:
    """The merges as an open-addressing table: a pair of ids -> its rank."""

    NONE = np.int32(2**31 - 1)

    def __init__(self, pairs: np.ndarray):
        bits = max(8, int(len(pairs) * 8).bit_length())
        self._shift = np.uint64(64 - bits)
        self._keys = np.full(1 << bits, -1, np.int64)
        self._ranks = np.full(1 << bits, self.NONE, np.int32)
        keys = pairs[:, 0].astype(np.int64) << 32 | pairs[:, 1]
        slots, todo, self._probes = self._slot(keys), np.arange(len(keys)), 0
        while len(todo):  # a slot taken by another pair: the next one
            free = todo[self._keys[slots[todo]] < 0]
            _, first = np.unique(slots[free], return_index=True)
            put = free[first]
            self._keys[slots[put]], self._ranks[slots[put]] = keys[put], put
            todo = np.setdiff1d(todo, put)
            slots[todo] = (slots[todo] + 1) & (len(self._keys) - 1)
            self._probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self._shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        slots = self._slot(keys)
        out = np.where(self._keys[slots] == keys, self._ranks[slots], self.NONE)
        for _ in range(self._probes - 1):
            slots = (slots + 1) & (len(self._keys) - 1)
            hit = self._keys[slots] == keys
            out[hit] = self._ranks[slots[hit]]
        return out


class _Words:
    """Ids of words of up to `LONGEST` bytes, as an open-addressing table.  A
    word's key is the word: its bytes and their number in two 64-bit numbers.
    A full table is emptied."""

    LONGEST = 15
    _MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

    def __init__(self, room: int):
        self._room, self._held, self._used = max(1, room), 0, 0
        bits = (2 * self._room).bit_length()
        self._shift, self._last = np.uint64(64 - bits), (1 << bits) - 1
        self._low, self._high = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self._at, self._n = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
        self._ids = np.zeros(1 << 12, np.uint32)

    def keys(self, raw: bytes, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of words in ``raw``, which goes on for 16 bytes after the
        last; those of longer words are in no table."""
        eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
        short = np.minimum(size, self.LONGEST + 1)
        return (eight[starts] & self._MASKS[np.minimum(short, 8)],
                eight[starts + 8] & self._MASKS[np.clip(short - 8, 0, 7)] | short.astype(np.uint64) << np.uint64(56))

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        h = (low ^ high * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x9E3779B97F4A7C15)
        return ((h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93) >> self._shift).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each word begin and how many they are, or -1."""
        at, n = np.full(len(low), -1, np.int64), np.zeros(len(low), np.int64)
        todo, slots = np.arange(len(low)), self._slots(low, high)
        while len(todo):
            there = self._high[slots]
            hit = (there == high[todo]) & (self._low[slots] == low[todo])
            at[todo[hit]], n[todo[hit]] = self._at[slots[hit]], self._n[slots[hit]]
            on = ~hit & (there != 0)
            todo, slots = todo[on], slots[on] + 1 & self._last
        return at, n

    def add(self, ids: np.ndarray) -> int:
        """Where some ids begin."""
        begin = self._used
        if begin + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids[:begin], np.zeros(max(begin, len(ids)), np.uint32)])
        self._ids[begin:begin + len(ids)] = ids
        self._used += len(ids)
        return begin

    def ids(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The ids of words, end to end."""
        return self._ids[np.repeat(at - np.cumsum(n) + n, n) + np.arange(n.sum())]

    def keep(self, low: np.ndarray, high: np.ndarray, begin: int, n: np.ndarray) -> None:
        """Keep distinct words that the table lacks, whose ids were added at
        ``begin``; ids after theirs are dropped."""
        if self._held + len(low) > self._room:
            low, high, n = low[:self._room], high[:self._room], n[:self._room]
            self._ids = self._ids[begin:begin + n.sum()].copy()
            self._high[:] = 0
            self._held = begin = 0
        self._used = begin + int(n.sum())
        at = begin + np.cumsum(n) - n
        todo, slots = np.arange(len(low)), self._slots(low, high)
        while len(todo):  # of words that want one free slot one gets it, the others the next
            free = self._high[slots] == 0
            self._at[slots[free]] = todo[free]
            free &= self._at[slots] == todo
            put, here = todo[free], slots[free]
            self._low[here], self._high[here], self._at[here], self._n[here] = low[put], high[put], at[put], n[put]
            todo, slots = todo[~free], slots[~free] + 1 & self._last
        self._held += len(low)


class BoundaryEncoder:
    """Encoder and decoder of one tokenizer file; one per task process."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], json.dumps(spec["pre_tokenizer"])
        kinds = [n.get("type") for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != SUFFIX or model.get("continuing_subword_prefix") \
                or json.dumps(WORD_PATTERN) not in pre or kinds != ["NFC", "Replace", "Lowercase"] \
                or spec["decoder"] is not None or spec["post_processor"] is not None:
            raise ValueError(f"{path}: not a word BPE file of the expected form")
        vocab = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        pairs = np.array([(vocab[a], vocab[b]) for a, b in merges], np.int32).reshape(-1, 2)
        self._made = np.array([vocab[a + b] for a, b in merges], np.int32)
        # a token is made by one merge, after its parts: so all places of the
        # lowest pair can be joined at once
        if (np.diff(self._made) <= 0).any() or (pairs.max(axis=1, initial=0) >= self._made).any():
            raise ValueError(f"{path}: tokens are not made in the order of their merges")
        self._merges = _Merges(pairs)
        self._byte = byte_characters()
        self._inner = np.array([vocab[c] for c in self._byte], np.int32)
        self._last = np.array([vocab[c + SUFFIX] for c in self._byte], np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.tokens = {i: t for t, i in (vocab | self.special).items()}
        self.joined = {pair for t in vocab for pair in zip(t.removesuffix(SUFFIX), t.removesuffix(SUFFIX)[1:], strict=False)}
        self._apart = np.array([[(a, b) not in self.joined for b in self._byte] for a in self._byte])
        self._words = _Words(CACHE // ENTRY)

    def fragments(self, piece: str) -> list[str]:
        """A pre-token as byte characters, cut at the forced boundaries."""
        code = np.frombuffer(piece.encode("utf-8"), np.uint8)
        cuts = (np.flatnonzero(self._apart[code[:-1], code[1:]]) + 1).tolist()
        s = "".join([self._byte[b] for b in code])
        return [s[a:b] for a, b in zip([0, *cuts], [*cuts, len(s)], strict=True)]

    def _merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens, end to end, and where each begins (and the
        last ends).  All are cut at the forced boundaries and the fragments
        encoded at once, each by itself: in every round each fragment joins
        the places of its lowest pair."""
        none = _Merges.NONE
        code = np.frombuffer("".join(pieces).encode("utf-8"), np.uint8)
        size = np.fromiter((len(p) if p.isascii() else len(p.encode("utf-8")) for p in pieces), np.int64, len(pieces))
        ends = np.cumsum(size) - 1
        begins = np.zeros(len(code) + 1, bool)
        begins[0] = begins[ends + 1] = True
        begins[1:-1] |= self._apart[code[:-1], code[1:]]
        of = np.cumsum(begins[:-1], dtype=np.int32)
        piece_of = np.repeat(np.arange(len(pieces), dtype=np.int32), size)[begins[:-1]]  # by fragment
        ids = self._inner[code]
        ids[ends] = self._last[code[ends]]

        def at(i: np.ndarray) -> np.ndarray:
            """Ranks of the pairs that begin at some places."""
            out = np.full(len(i), none, np.int32)
            inner = i + 1 < len(ids)
            inner[inner] = of[i[inner]] == of[i[inner] + 1]
            out[inner] = self._merges.ranks(ids[i[inner]], ids[i[inner] + 1])
            return out

        rank, done = at(np.arange(len(ids))), []
        while len(of):
            starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            length = np.diff(starts, append=len(of))
            best = np.minimum.reduceat(rank, starts)
            going = best < none
            if not going.all():
                on = np.repeat(going, length)
                done.append((of[~on], ids[~on]))
                of, ids, rank, best, length = of[on], ids[on], rank[on], best[going], length[going]
                if not len(of):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, length))
            # of overlapping places of a doubled token, every second
            alone = np.concatenate([[True], np.diff(hit) > 1])
            run = np.maximum.accumulate(np.where(alone, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            ids[hit] = self._made[rank[hit]]
            keep = np.ones(len(of), bool)
            keep[hit + 1] = False
            of, ids, rank = of[keep], ids[keep], rank[keep]
            here = hit - np.arange(len(hit))
            rank[here] = at(here)
            before = here[here > 0] - 1
            rank[before] = at(before)
        of, ids = (np.concatenate([d[i] for d in done]) if done else np.zeros(0, np.int32) for i in (0, 1))
        return ids[np.argsort(of, kind="stable")], np.concatenate([[0], np.cumsum(np.bincount(piece_of[of - 1], minlength=len(size)))])

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, end to end, and where each begins."""
        pieces: list[str] = []
        ends = [0]
        for w in words:
            if w.isalpha():  # letters alone are one pre-token
                pieces.append(w)
            else:
                pieces += _PIECES(w)
            ends.append(len(pieces))
        ids, cut = self._merged(pieces)
        return ids, cut[ends]

    def _looked_up(self, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of ``raw``, end to end, and how many each has."""
        size = ends - starts
        low, high = self._words.keys(raw, starts, size)
        at, n = self._words.find(low, high)
        lacking = np.flatnonzero(at < 0)
        if not len(lacking):
            return self._words.ids(at, n), n
        is_long = size[lacking] > self._words.LONGEST
        short, long = lacking[~is_long], lacking[is_long]
        order = np.lexsort((low[short], high[short]))
        short = short[order]
        other = np.ones(len(short), bool)
        other[1:] = (low[short[1:]] != low[short[:-1]]) | (high[short[1:]] != high[short[:-1]])
        first = short[other]
        text = {raw[a:b]: None for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)}
        named = [raw[a:b] for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
        text.update(dict.fromkeys(named))
        number = dict(zip(text, range(len(text)), strict=True))
        ids, cut = self._encoded([w.decode("utf-8") for w in text])
        begin, count = self._words.add(ids), np.diff(cut)
        of = np.concatenate([np.cumsum(other) - 1, np.array([number[w] for w in named], np.int64)])
        new = np.concatenate([short, long])
        at[new], n[new] = begin + cut[of], count[of]
        out = self._words.ids(at, n)
        self._words.keep(low[first], high[first], begin, n[first])
        return out, n

    def _normal(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower().encode("utf-8")

    def _plain(self, texts: list[str]) -> list[bytes]:
        """The ids of texts without special tokens."""
        parts = [self._normal(t) for t in texts]
        raw = b"\n".join([*parts, bytes(16)])
        code = np.frombuffer(raw, np.uint8)
        kind = np.zeros(len(raw) - 15, np.uint8)
        kind[1:] = _KIND[code[:-16]]
        if not raw.isascii():
            lead = np.flatnonzero(code == 0xC2)
            lead = lead[np.isin(code[lead].astype(np.int64) << 8 | code[lead + 1], _WIDE[0])]
            kind[lead + 1] = kind[lead + 2] = 0
            lead = np.flatnonzero((code >= 0xE1) & (code <= 0xE3))
            lead = lead[np.isin(code[lead].astype(np.int64) << 16 | code[lead + 1].astype(np.int64) << 8 | code[lead + 2], _WIDE[1])]
            kind[lead + 1] = kind[lead + 2] = kind[lead + 3] = 0
        pair = kind[:-1] << 3 | kind[1:]
        starts, ends = np.flatnonzero(_BEGINS.ravel()[pair]), np.flatnonzero(_ENDS.ravel()[pair])
        blocks = [self._looked_up(raw, starts[i:i + BLOCK], ends[i:i + BLOCK]) for i in range(0, len(starts), BLOCK)]
        ids, n = (np.concatenate([b[i] for b in blocks]) if blocks else np.zeros(0, np.int64) for i in (0, 1))
        begin = np.cumsum([0, *(len(p) + 1 for p in parts)])
        cut = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(starts, begin)].tolist()
        ids = ids.astype("<u4", copy=False)
        return [ids[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers.
        The words of all texts are looked up together."""
        if self._special is None or not any(s in t for t in texts for s in self.special):
            return self._plain(texts)
        # special tokens stand as their ids between the parts of a text
        split = [self._special.split(t) for t in texts]
        ids = iter(self._plain([x for parts in split for x in parts[::2]]))
        return [b"".join([self.special[x].to_bytes(4, "little") if i % 2 else next(ids) for i, x in enumerate(parts)]) for parts in split]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The text of ids; without a decoder in the file, tokens are joined
        by spaces."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def load(path: str) -> BoundaryEncoder:
    return BoundaryEncoder(path)


def encode_column(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` with ``ids`` (binary, unsigned 32-bit little-endian) and
    ``decoded``, the text of the ids."""
    schema = StructType([docs.schema[c] for c in keep] + [StructField("ids", BinaryType(), False),
                                                          StructField("decoded", StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load(path)
        for rows, texts in text_chunks(batches, text, SLICE):
            ids = enc.encode_all(texts)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in keep), pa.array(ids, pa.binary()),
                 pa.array([enc.decode(x) for x in ids], pa.string())], [*keep, "ids", "decoded"])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, number of ids, SHA-256 of the ids and of their decoded
    text.  Digests are taken in the encoding task, so that ids and decoded
    texts never leave it."""
    schema = StructType([docs.schema[key], StructField("n_tokens", LongType(), False),
                         StructField("ids_sha256", StringType(), False),
                         StructField("decoded_sha256", StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load(path)
        for rows, texts in text_chunks(batches, text, SLICE):
            ids = enc.encode_all(texts)
            sha = lambda x: hashlib.sha256(x).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [rows.column(key), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([sha(x) for x in ids], pa.string()),
                 pa.array([sha(enc.decode(x).encode("utf-8")) for x in ids], pa.string())],
                [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(*dict.fromkeys([key, text])).mapInArrow(run, schema)
