"""Repeated substrings across documents, by induced suffix arrays of shards.

`remove_repeats` cuts from every document the bytes that lie in a string of
`length` (50) bytes which also starts in a document with a smaller id.

A suffix array of a whole corpus fits no task, so strings that can be equal
are brought together in shards first:

1. every `length`-byte window has an anchor, the `GRAM`-byte string inside it
   of least hash; equal windows have equal anchors.  Anchors (about one in
   fourteen bytes) are sent, packed, to buckets by hash, and those found in
   two documents or more come back with their first document, the *home*;
2. consecutive windows of one home make a segment; segments go to the shard of
   their home.  All windows of an anchor have its home, so equal windows of
   different documents always meet in a shard;
3. a shard's segments are one text.  Its suffix array is made by induced
   sorting: suffixes are classified, the leftmost-smaller (LMS) substrings are
   sorted and named, the named string is sorted recursively, and the array
   induced from the sorted LMS suffixes in one linear scan each way; then the
   permuted common prefixes tell where neighbours share `length` bytes.  A run
   of such neighbours is one string: its smallest document keeps it;
4. removed intervals meet their documents again by id and text hash.

Hot groups: an anchor in many documents of a task is sent once per task, with
the documents as one packed row that joins the anchor's home later; a home
whose segments exceed `HOT_BYTES` is salted over several shards, each with the
home's own segments; windows that the home does not hold are then compared by
a plain aggregate over the window bytes.  Nothing is capped.

Order: ids are compared as 64-bit integers; a null id counts as the largest;
rows of one id are one document and do not remove from each other.  Null texts
are empty; texts shorter than `length` lose nothing; removed text is judged on
the input, whole texts, in UTF-8 bytes.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from emolens.llm.common import text_chunks, text_or_empty, written

LENGTH, GRAM = 50, 24
BUCKET_BYTES, SHARD_BYTES, HOT_BYTES = 24_000_000, 1_500_000, 48_000_000
#: An anchor in so many documents of a task's chunk goes as one packed row.
HEAVY = 64
#: Bytes of text whose anchors are computed at once.
CHUNK_CHARS = 400_000
#: Alphabets up to this are induced bucket by bucket; longer ones, which only
#: named strings have, are sorted by doubling.
BUCKETED = 1024
LAST_ID = (1 << 63) - 1

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


# --- suffix arrays -----------------------------------------------------------

def _lms(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """S-type marks (suffix smaller than the next) and positions of LMS
    suffixes of a text that ends in a unique smallest symbol."""
    n = len(t)
    nearest = np.where(t[:-1] != t[1:], np.arange(n - 1), n)
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]
    s = np.ones(n, bool)
    s[:-1] = t[nearest] < t[nearest + 1]
    return s, np.flatnonzero(s[1:] & ~s[:-1]) + 1


def _place(sa: np.ndarray, t: np.ndarray, p: np.ndarray, at: np.ndarray, step: int) -> None:
    """Puts positions ``p`` into their buckets, in order, from each bucket's
    place ``at`` on, upwards or downwards."""
    if not len(p):
        return
    symbol = t[p]
    order = np.argsort(symbol, kind="stable")
    symbol, p = symbol[order], p[order]
    new = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
    size = np.diff(np.append(new, len(p)))
    rank = np.arange(len(p)) - np.repeat(new, size)
    if step > 0:
        sa[at[symbol] + rank] = p
        at[symbol[new]] += size
    else:
        sa[at[symbol] - 1 - rank] = p
        at[symbol[new]] -= size


def induce(t: np.ndarray, s: np.ndarray, lms: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The array that follows from ``lms``, the LMS suffixes in order: larger
    (L) suffixes from the left, smaller (S) ones from the right.  A bucket is
    one step; its own suffixes that precede each other are further steps."""
    n, sigma, larger = len(t), len(start) - 1, ~s
    sa = np.zeros(n, np.int32)
    head, tail = start[:-1].copy(), start[1:].copy()
    first = t[lms]
    edge = np.searchsorted(first, np.arange(sigma + 1))
    present = np.flatnonzero(np.diff(start)).tolist()
    for c in present:
        done = start[c]
        while done < head[c]:
            q, done = sa[done:head[c]], int(head[c])
            p = q[q > 0] - 1
            _place(sa, t, p[larger[p]], head, 1)
        q = lms[edge[c]:edge[c + 1]]
        p = q[q > 0] - 1
        _place(sa, t, p[larger[p]], head, 1)
    for c in reversed(present):
        done = start[c + 1]
        while done > tail[c]:
            q, done = sa[tail[c]:done][::-1], int(tail[c])
            p = q[q > 0] - 1
            _place(sa, t, p[s[p]], tail, -1)
        q = sa[start[c]:head[c]][::-1]
        p = q[q > 0] - 1
        _place(sa, t, p[s[p]], tail, -1)
    sa[0] = n - 1
    return sa


def _named(t: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings, which ``order`` lists in order, by
    position: equal substrings have equal names."""
    end = np.append(lms[1:], lms[-1])
    size = np.zeros(len(t), np.int64)
    size[lms] = end - lms + 1
    a, b = order[:-1], order[1:]
    same = size[a] == size[b]
    left, k = np.flatnonzero(same), 0
    while len(left):
        off = t[a[left] + k] != t[b[left] + k]
        same[left[off]] = False
        k += 1
        left = left[~off]
        left = left[size[a[left]] > k]
    name = np.zeros(len(t), np.int64)
    name[order] = np.append(0, np.cumsum(~same))
    return name[lms]


def _doubled(t: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes by their first ``depth`` symbols."""
    rank, h = t.astype(np.int64), 1
    order = np.argsort(rank)
    while h < depth:
        after = np.zeros(len(t), np.int64)
        after[:-h] = rank[h:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key)
        key = key[order]
        new = np.append(0, np.cumsum(key[1:] != key[:-1]))
        rank = np.empty(len(t), np.int64)
        rank[order] = new
        if new[-1] == len(t) - 1:
            break
        h *= 2
    return order


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """Positions of a text (non-negative symbols, the last one 0 and unique)
    in the order of their suffixes; suffixes that agree in their first
    ``depth`` symbols may stand in any order."""
    n, sigma = len(t), int(t.max()) + 1
    if sigma > BUCKETED:
        return _doubled(t, depth)
    if n < 3:
        return np.arange(n)[::-1].copy()
    t = t.astype(np.int16)
    start = np.append(0, np.cumsum(np.bincount(t, minlength=sigma)))
    s, lms = _lms(t)
    sa = induce(t, s, lms[np.argsort(t[lms], kind="stable")], start)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]
    name = _named(t, lms, order)
    if name.max() + 1 < len(lms):
        # neighbouring LMS suffixes are two symbols apart at least
        order = lms[suffix_array(name, depth // 2 + 1)]
    return induce(t, s, order, start)


def permuted_prefixes(data: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """By position: the length, up to ``most``, of what a suffix shares with
    its neighbour to the left in ``sa``."""
    n = len(data)
    before = np.empty(n, np.int32)
    before[sa] = np.append(sa[0], sa[:-1])
    padded = np.append(data, np.zeros(most + 8, np.uint8))
    word = np.zeros(n + most, np.uint64)
    for k in range(8):
        word |= padded[k:k + n + most].astype(np.uint64) << np.uint64(8 * k)
    out = np.full(n, most, np.int64)
    left = np.flatnonzero(before != np.arange(n))
    out[sa[0]] = 0
    for k in range(0, most, 8):
        diff = word[left + k] ^ word[before[left] + k]
        off = diff != 0
        at, d = left[off], diff[off]
        low = d & (~d + np.uint64(1))
        out[at] = np.minimum(k + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3), most)
        left = left[~off]
    return out


def shard_removals(docs: np.ndarray, pieces: list[bytes], length: int = LENGTH, home: int | None = None
                   ) -> tuple[list[list[tuple[int, int]]], list[tuple[int, int]]]:
    """Per piece, the intervals covered by windows that a smaller document
    also holds.  With ``home`` (a salted shard) only windows that the home
    holds are decided; the others are returned as (piece, start)."""
    size = np.array([len(p) for p in pieces], np.int64)
    start = np.cumsum(size + 1) - size - 1
    raw = np.frombuffer(b"\0".join(pieces) + b"\0\0", np.uint8)
    t = raw.astype(np.int16) + 2
    t[start + size] = 1
    t[-1] = 0
    n = len(t)
    owner = np.repeat(np.arange(len(pieces)), size + 1)
    sa = suffix_array(t, length)
    shared = permuted_prefixes(raw, sa, length)[sa]
    # a piece's last bytes start no window
    fits = np.zeros(n, bool)
    inside = np.arange(n - 1) - start[owner]
    fits[:-1] = inside + length <= size[owner]
    ok = fits[sa]
    # all that stands between two equal windows is equal to them, so a window after a non-window begins a run
    new = (~np.append(False, ok[:-1]) | (shared < length))[ok]
    sa = sa[ok]
    if not len(sa):
        return [[] for _ in pieces], []
    doc = docs[owner[sa]]
    run = np.cumsum(new) - 1
    least = np.minimum.reduceat(doc, np.flatnonzero(new))[run]
    undecided = []
    gone = doc > least
    if home is not None:
        held = np.logical_or.reduceat(doc == home, np.flatnonzero(new))[run]
        undecided = [(int(owner[p]), int(p - start[owner[p]])) for p in sa[~held]]
        gone &= held
    first = np.zeros(n + length, np.int8)
    first[sa[gone]] = 1
    mark = first.copy()
    mark[length:] -= first[:n]
    covered = np.cumsum(mark, dtype=np.int32)[:n] > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([0], covered.view(np.int8), [0]))))
    out: list[list[tuple[int, int]]] = [[] for _ in pieces]
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        i = int(owner[a])
        out[i].append((a - int(start[i]), b - int(start[i])))
    return out, undecided


# --- anchors -----------------------------------------------------------------

def anchors(data: np.ndarray, starts: np.ndarray, length: int = LENGTH, gram: int = GRAM
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts laid end to end (``starts``, first 0): the windows that lie
    within a text, by start; each one's anchor, as an index; the anchors'
    hashes."""
    n = len(data)
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if n < length:
        return none
    power = np.full(n + 1, _BASE)
    back = np.full(n + 1, _BACK)
    power[0] = back[0] = 1
    power, back = np.cumprod(power), np.cumprod(back)
    symbol = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ np.uint64(0xA0761D6478BD642F)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(symbol[data] * power[:n], out=total[1:])
    h = (total[gram:] - total[:-gram]) * back[:n - gram + 1]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    # least hash, then leftmost: the position is in the low bits
    key = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    width, have = length - gram + 1, 1
    while 2 * have <= width:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    if have < width:
        key = np.minimum(key[:len(key) - (width - have)], key[width - have:])
    at = (key & np.uint64(0xFFFFFF)).astype(np.int64)
    end = np.append(starts[1:], n)
    window = np.concatenate([np.arange(a, max(a, b - length + 1)) for a, b in zip(starts.tolist(), end.tolist(), strict=True)])
    if not len(window):
        return none
    at = at[window]
    new = np.append(True, at[1:] != at[:-1])
    return window, np.cumsum(new) - 1, h[at[new]]


def _pieces_of(texts: list[bytes], ids: list, limit: int = 1 << 23) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Texts joined to arrays of about ``limit`` bytes; a longer text is dealt
    out in overlapping parts, so that every window is in one of them."""
    data, starts, own, size = [], [], [], 0
    for t, i in zip(texts, ids, strict=True):
        for lo in range(0, max(1, len(t) - LENGTH + 1), limit):
            part = t[lo:lo + limit + LENGTH - 1]
            data.append(part)
            starts.append(size)
            own.append((i, lo))
            size += len(part)
            if size >= limit:
                yield np.frombuffer(b"".join(data), np.uint8), np.array(starts), own
                data, starts, own, size = [], [], [], 0
    if data:
        yield np.frombuffer(b"".join(data), np.uint8), np.array(starts), own


_SENT = "bucket long, heavy boolean, f binary, docs binary, chunk long"


def _send(batches: Iterator[pa.RecordBatch], buckets: int, many: int = HEAVY) -> Iterator[pa.RecordBatch]:
    """Anchors of a chunk of documents, packed by bucket: hashes and the ids
    they occur in, one by one; an anchor of many documents of the chunk goes
    with its smallest id there, and its ids as a row of their own."""
    for rows, texts in text_chunks(batches, "text", 4_000_000):
        raw = [t.encode("utf-8") for t in texts]
        hashes, owner = [], []
        for data, starts, own in _pieces_of(raw, rows.column("id").to_pylist(), CHUNK_CHARS):
            window, anchor, h = anchors(data, starts)
            if len(h):
                first = np.append(0, np.flatnonzero(np.diff(anchor)) + 1)
                hashes.append(h)
                owner.append(np.array([i for i, _ in own], np.int64)[np.searchsorted(starts, window[first], side="right") - 1])
        if not hashes:
            continue
        f, d = np.concatenate(hashes), np.concatenate(owner)
        order = np.lexsort((d, f))
        f, d = f[order], d[order]
        fresh = np.append(True, (f[1:] != f[:-1]) | (d[1:] != d[:-1]))
        f, d = f[fresh], d[fresh]
        group = np.flatnonzero(np.append(True, f[1:] != f[:-1]))
        size = np.diff(np.append(group, len(f)))
        out: list[tuple] = []
        # rows of one chunk meet again to be sorted by document
        chunk = rows.column("id")[0].as_py()
        single = np.ones(len(f), bool)
        for g, n in zip(group[size >= many].tolist(), size[size >= many].tolist(), strict=True):
            out.append((int(f[g] % np.uint64(buckets)), True, f[g:g + 1].tobytes(), d[g:g + n].tobytes(), chunk))
            single[g:g + n] = False
        f, d = f[single], d[single]
        b = (f % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(b, kind="stable")
        b, f, d = b[order], f[order], d[order]
        cut = np.append(np.flatnonzero(np.append(True, b[1:] != b[:-1])), len(b)) if len(b) else np.zeros(1, np.int64)
        out += [(int(b[x]), False, f[x:y].tobytes(), d[x:y].tobytes(), chunk) for x, y in zip(cut[:-1], cut[1:], strict=True)]
        kinds = (pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                         ["bucket", "heavy", "f", "docs", "chunk"])


_HOMES = "heavy boolean, f long, id long, home long, docs binary, chunk long"


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: anchors of two documents or more, with each
    document and the home.  Packed rows pass through, after the home of their
    anchor."""
    def solved(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        f = [np.frombuffer(r[1], np.uint64) for r in rows]
        d = [np.frombuffer(r[2], np.int64) for r in rows]
        heavy = {int(x[0]): None for r, x in zip(rows, f, strict=True) if r[0]}
        one = [i for i, r in enumerate(rows) if not r[0]]
        hashes = np.concatenate([f[i] for i in one] + [f[i][:1] for i, r in enumerate(rows) if r[0]])
        docs = np.concatenate([d[i] for i in one] + [d[i][:1] for i, r in enumerate(rows) if r[0]])
        light = np.append(np.ones(sum(len(f[i]) for i in one), bool), np.zeros(len(rows) - len(one), bool))
        order = np.lexsort((docs, hashes))
        hashes, docs, light = hashes[order], docs[order], light[order]
        group = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        size = np.diff(np.append(group, len(hashes)))
        home = docs[group]
        several = (docs[group + size - 1] != home)
        for g in np.flatnonzero(np.isin(hashes[group], np.array(list(heavy), np.uint64))) if heavy else ():
            heavy[int(hashes[group[g]])] = int(home[g])
            several[g] = True
        keep = np.repeat(several, size) & light
        yield table(False, hashes[keep].view(np.int64), docs[keep], np.repeat(home, size)[keep], None, None)
        for (is_heavy, _, packed, chunk), x in zip(rows, f, strict=True):
            if is_heavy:
                yield table(True, x.view(np.int64), x.view(np.int64)[:1] * 0, np.array([heavy[int(x[0])]]), [packed], [chunk])

    def table(is_heavy, f, ids, home, packed, chunk) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([is_heavy] * len(f), pa.bool_()), pa.array(f), pa.array(ids), pa.array(home),
             pa.array(packed or [None] * len(f), pa.binary()), pa.array(chunk or [None] * len(f), pa.int64())],
            ["heavy", "f", "id", "home", "docs", "chunk"])

    for rows in _grouped(batches, ("heavy", "f", "docs", "chunk")):
        yield from solved(rows)


def _grouped(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], by: str = "bucket") -> Iterator[list[tuple]]:
    """Groups of rows that follow each other with the same ``by``."""
    now, group = None, []
    for b in batches:
        for k, *r in zip(b.column(by).to_pylist(), *(b.column(c).to_pylist() for c in columns), strict=True):
            if k != now and group:
                yield group
                group = []
            now = k
            group.append(tuple(r))
    if group:
        yield group


_SEGMENTS = "home long, id long, text_hash long, start long, piece binary"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their shared anchors' homes -> segments: the bytes of
    consecutive windows of one home."""
    def mixed(row: np.ndarray, f: np.ndarray) -> np.ndarray:
        return f ^ ((row.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))

    for rows, texts in text_chunks(batches, "text", 4_000_000):
        raw = [t.encode("utf-8") for t in texts]
        ids, hashes = rows.column("id").to_numpy(), rows.column("text_hash").to_numpy()
        lists = rows.column("homes")
        flat = lists.flatten()
        known_f = flat.field("f").to_numpy().view(np.uint64)
        known_home = flat.field("home").to_numpy()
        known_row = np.repeat(np.arange(len(raw)), np.diff(lists.offsets.to_numpy()))
        # (row, anchor) as one number; what is found is compared in both
        known = mixed(known_row, known_f)
        order = np.argsort(known)
        known, known_f, known_home, known_row = known[order], known_f[order], known_home[order], known_row[order]
        for data, starts, own in _pieces_of(raw, list(range(len(raw))), CHUNK_CHARS):
            window, anchor, h = anchors(data, starts)
            if not len(h):
                continue
            part = np.searchsorted(starts, window, side="right") - 1
            row = np.array([i for i, _ in own], np.int64)
            first = np.append(0, np.flatnonzero(np.diff(anchor)) + 1)
            anchor_row = row[part[first]]
            at = np.minimum(np.searchsorted(known, mixed(anchor_row, h)), len(known) - 1)
            there = (known_f[at] == h) & (known_row[at] == anchor_row)
            # windows of one home, side by side
            of, shared = np.where(there, known_home[at], 0)[anchor], there[anchor]
            edge = np.append(True, (of[1:] != of[:-1]) | (shared[1:] != shared[:-1]) | (part[1:] != part[:-1]))
            begin = np.flatnonzero(edge)
            last = np.append(begin[1:], len(window)) - 1
            begin, last = begin[shared[begin]], last[shared[begin]]
            if not len(begin):
                continue
            lo, hi, which = window[begin], window[last] + LENGTH, part[begin]
            skipped = np.array([x for _, x in own], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(of[begin]), pa.array(ids[row[which]]), pa.array(hashes[row[which]]), pa.array(lo - starts[which] + skipped[which]),
                 pa.array([data[x:y].tobytes() for x, y in zip(lo.tolist(), hi.tolist(), strict=True)], pa.binary())],
                ["home", "id", "text_hash", "start", "piece"])


_CUTS = "id long, text_hash long, spans binary, window binary, start long"


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard -> removed intervals, and undecided windows of
    salted shards."""
    for rows in _grouped(batches, ("salted", "home", "id", "text_hash", "start", "piece"), "shard"):
        salted, home = rows[0][0], rows[0][1]
        cuts, open_ = shard_removals(np.array([r[2] for r in rows], np.int64), [r[5] for r in rows], LENGTH,
                                     home if salted else None)
        out = [(r[2], r[3], (np.array(c, np.int64) + r[4]).tobytes(), None, None) for r, c in zip(rows, cuts, strict=True) if c]
        out += [(rows[i][2], rows[i][3], None, rows[i][5][a:a + LENGTH], rows[i][4] + a) for i, a in open_]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()), strict=True)],
                ["id", "text_hash", "spans", "window", "start"])


def _cut(text: bytes, spans: list[bytes]) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed, the maximal removed runs."""
    pairs = np.concatenate([np.frombuffer(s, np.int64) for s in spans]).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    keep, at, runs, end = [], 0, 0, -1
    for a, b in pairs.tolist():
        if a > end:
            runs += 1
            keep.append(text[at:a])
        end = max(end, b)
        at = max(at, b)
    keep.append(text[at:])
    left = b"".join(keep)
    return left, len(text) - len(left), runs


def removed_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", hot_bytes: int = HOT_BYTES,
                  heavy: int = HEAVY) -> DataFrame:
    """(id, text_hash, spans): removed intervals, packed pairs of byte
    offsets, several rows per document."""
    rows = _rows(docs, key, text)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, total // BUCKET_BYTES)
    n_tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    sent = rows.select("id", "text").mapInArrow(lambda b: _send(b, buckets, heavy), _SENT)
    homes = written(sent.repartition(n_tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(_homes, _HOMES), "homes")
    light = homes.where("not heavy").select("id", F.array(F.struct("f", "home")).alias("homes"))
    packed = (homes.where("heavy").select("chunk", "f", "home", "docs").repartition(n_tasks, "chunk")
              .sortWithinPartitions("chunk").mapInArrow(_unpacked, "id long, homes array<struct<f:long,home:long>>"))
    anchored = light.unionAll(packed).groupBy("id").agg(F.flatten(F.collect_list("homes")).alias("homes"))
    segments = written(rows.join(anchored, "id").select("id", "text_hash", "text", "homes").mapInArrow(_segments, _SEGMENTS),
                       "segments")

    size = segments.agg(F.sum(F.length("piece"))).first()[0] or 0
    shards = max(1, size // SHARD_BYTES)
    hot = written(segments.groupBy("home").agg(F.sum(F.length("piece")).alias("n")).where(F.col("n") > hot_bytes)
                  .select("home", F.ceil(F.col("n") / (hot_bytes / 4)).cast("int").alias("salts")), "hot")
    one = segments.select(F.concat(F.lit("s"), F.pmod(F.xxhash64("home"), F.lit(shards)).cast("string")).alias("shard"),
                          F.lit(False).alias("salted"), "home", "id", "text_hash", "start", "piece")
    n_hot = hot.count()
    if n_hot:
        salt = F.when(F.col("id") == F.col("home"), F.sequence(F.lit(0), F.col("salts") - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("id", "start"), F.col("salts")).cast("int")))
        salted = (segments.join(hot, "home").withColumn("salt", F.explode(salt))
                  .select(F.concat_ws(":", F.lit("h"), "home", "salt").alias("shard"), F.lit(True).alias("salted"),
                          "home", "id", "text_hash", "start", "piece"))
        one = one.join(hot, "home", "left_anti").select(*salted.columns).unionAll(salted)
    cuts = one.repartition(n_tasks, "shard").sortWithinPartitions("shard").mapInArrow(_shards, _CUTS)
    if not n_hot:
        return cuts.select("id", "text_hash", "spans")
    cuts = written(cuts, "cuts")
    window = cuts.where("window is not null").select("window", "id", "text_hash", "start").distinct()
    least = window.groupBy("window").agg(F.min("id").alias("least"))
    more = (window.join(least, "window").where("id > least").select("id", "text_hash", "start")
            .mapInArrow(_as_spans, "id long, text_hash long, spans binary"))
    return cuts.where("spans is not null").select("id", "text_hash", "spans").unionAll(more)


def _as_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        spans = [np.array([s, s + LENGTH], np.int64).tobytes() for s in b.column("start").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("text_hash"), pa.array(spans, pa.binary())],
                                         ["id", "text_hash", "spans"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed rows sorted by chunk -> a row per document of the chunk, with
    all its anchors of this kind."""
    for rows in _grouped(batches, ("f", "home", "docs"), "chunk"):
        ids = [np.frombuffer(packed, np.int64) for *_, packed in rows]
        size = [len(x) for x in ids]
        flat = np.concatenate(ids)
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
        f, home = (np.repeat(np.array([r[k] for r in rows], np.int64), size)[order] for k in (0, 1))
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(flat)), pa.int32()),
                                         pa.StructArray.from_arrays([pa.array(f), pa.array(home)], ["f", "home"]))
        yield pa.RecordBatch.from_arrays([pa.array(flat[first]), lists], ["id", "homes"])


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.coalesce(F.col(key).cast("long"), F.lit(LAST_ID)).alias("id"),
                       text_or_empty(text).alias("text")).withColumn("text_hash", F.xxhash64("text"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", hot_bytes: int = HOT_BYTES,
                   heavy: int = HEAVY, keep_bytes: bool = True) -> DataFrame:
    """Per document: key, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256`` and, if asked for, ``kept``: the bytes left (a string may
    be cut inside a character)."""
    rows = _rows(docs, key, text)
    spans = removed_spans(docs, key, text, hot_bytes, heavy).groupBy("id", "text_hash").agg(F.collect_list("spans").alias("spans"))
    schema = StructType([StructField(key, docs.schema[key].dataType), StructField("n_bytes", LongType(), False),
                         StructField("n_removed", LongType(), False), StructField("n_spans", LongType(), False),
                         StructField("kept_sha256", StringType(), False)]
                        + [StructField("kept", BinaryType(), False)] * keep_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [t.encode("utf-8") for t in b.column("text").to_pylist()]
            done = [_cut(t, s) if s else (t, 0, 0) for t, s in zip(raw, b.column("spans").to_pylist(), strict=True)]
            cols = [b.column("key"), pa.array([len(t) for t in raw], pa.int64()), pa.array([x[1] for x in done], pa.int64()),
                    pa.array([x[2] for x in done], pa.int64()),
                    pa.array([hashlib.sha256(x[0]).hexdigest() for x in done], pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array([x[0] for x in done], pa.binary())] * keep_bytes, schema.names)

    joined = rows.join(spans, ["id", "text_hash"], "left").select("key", "text", "spans")
    return joined.mapInArrow(run, schema)
