"""Repeated byte strings by a sparse suffix array: sampled splitters, buckets sorted by multikey quicksort.

Removed from a document is each byte that lies in a string of `length` (50) bytes that also starts in a document with a
smaller key. Sorting a suffix for each byte would move every text fifty times over, so suffixes are taken at anchors: of
the 8-byte words within a string the one with the least hash, the first of equal ones. Equal strings have equal anchors
at equal places, so both start with the same suffix, whatever stands around them. An anchor serves a run of strings; it
travels once, with what lies left and right of it in that run, about 70 bytes for each 21 of text, packed.

1. Splitters are sampled from the anchors of documents dealt by hash. A task takes its documents' anchors, keeps of equal
   records the one of the smallest key (the others are found already), deals them to the ranges between splitters by the
   leading 24 bytes of their suffixes, and hands them on as compressed blocks.
2. A bucket sorts its suffixes by multikey quicksort, eight bytes at a time, in which only equal ones go on to the next
   eight; the same with what lies to the left, read backwards. Common lengths with the neighbours in both orders bound
   what a record can share with any other, which drops nearly all that don't repeat. Of those left, whole equal records
   are settled at once, and each string of the others is compared with the equal ones byte by byte.
3. A string whose part to the right of its anchor is a prefix of a splitter may have equal ones in the next buckets; such
   strings go through one more exchange, by the whole string, and are settled there (the comparison across boundaries).
4. What was found is gathered by document and cut out of the texts.

So every string of every document is judged, and a hot passage leaves a record a task. Tasks hold some megabytes of
text, or one bucket's records, or one document.

Defined cases: a null text is empty; texts under `length` bytes lose nothing; rows with a null key neither lose anything nor
count as smaller; rows with equal keys don't count against each other, be they equal or not; equal rows fare alike; a
kept column that has the name of a result gives way to it; an empty table gives an empty result. Texts are cut at bytes,
so what is kept is binary.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, partitions, passed, quoted, saved

LENGTH = 50
#: Bytes of a word that anchors are chosen by; the widest run of strings of one anchor.
WORD = 8
RUN = LENGTH - WORD + 1
#: Bytes that a record has room for, right and left of its anchor, and how many of them tell ranges apart.
RIGHT, LEFT, LEAD = 56, 48, 24
#: Bytes of text that a task looks at together, and hands on together; bytes of text for each bucket.
SLICE, FLUSH, BUCKET = 2_000_000, 10_000_000, 8_000_000
#: Sampled anchors for each bucket; buckets at most, so that splitters take 24 MB at most (beyond, buckets grow).
SAMPLED, MOST_BUCKETS = 40, 1_000_000
#: Of the anchors of a sampled document, one in so many.
SPARSE = 64

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_HIGH = np.uint64(0xFFFFFFFF00000000)
_ODD = (np.arange(1, 20, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _masks() -> tuple[np.ndarray, np.ndarray]:
    """By number of bytes: which of a record's right and left words they are."""
    right, left = np.zeros((LENGTH + 1, RIGHT), np.uint8), np.zeros((LENGTH + 1, LEFT), np.uint8)
    for n in range(LENGTH + 1):
        right[n, :n] = 255
        left[n, max(0, LEFT - n) :] = 255
    return right.view(np.uint64), left.view(np.uint64)


_RIGHT, _LEFT = _masks()


def _same(words: np.ndarray) -> np.ndarray:
    """Equal leading bytes of big-endian words, by the difference (xor) of two."""
    differ = words.byteswap().view(np.uint8).reshape(-1, 8) != 0
    return np.where(differ.any(1), differ.argmax(1), 8)


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last): of each run of strings in data the place of its anchor, and where its first and last string start.

    A string lies within one of the stretches from starts to ends.
    """
    n = len(data)
    if n < LENGTH:
        return (np.empty(0, np.int64),) * 3
    padded = np.concatenate([data, np.zeros(WORD, np.uint8)])
    h = np.ndarray((n,), "<u8", padded.data, 0, (1,)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h &= _HIGH
    h |= np.arange(n, dtype=np.uint64)
    width = 1
    while 2 * width <= RUN:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    rest = RUN - width
    h = np.minimum(h[: len(h) - rest], h[rest:])[: n - LENGTH + 1]
    place = (h & ~_HIGH).astype(np.int64)
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        place[max(a, b - LENGTH + 1) : b] = -1
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.append(first[1:], len(place)) - 1
    place = place[first]
    there = place >= 0
    return place[there], first[there], last[there]


class Records:
    """Anchors with their strings: words right and left of them, the strings' offsets before them, and whose they are."""

    fields = ("right", "left", "low", "high", "doc", "tag", "pos")

    def __init__(self, right, left, low, high, doc, tag, pos):
        self.right, self.left, self.low, self.high, self.doc, self.tag, self.pos = right, left, low, high, doc, tag, pos

    def __len__(self) -> int:
        return len(self.low)

    def take(self, at: np.ndarray) -> Records:
        return Records(*(getattr(self, f)[at] for f in self.fields))

    @staticmethod
    def joined(parts: list[Records]) -> Records:
        return Records(*(np.concatenate([getattr(p, f) for p in parts]) for f in Records.fields))

    @staticmethod
    def of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, tag: np.ndarray, base: np.ndarray) -> Records:
        """Of stretches of data, each of a document with this key and tag, from this place of it on."""
        place, first, last = anchors(data, starts, ends)
        padded = np.concatenate([np.zeros(LEFT, np.uint8), data, np.zeros(RIGHT, np.uint8)])
        n = len(data)
        right = np.ndarray((n,), f"V{RIGHT}", padded.data, LEFT, (1,))[place].view(np.uint64).reshape(-1, RIGHT // 8)
        left = np.ndarray((n,), f"V{LEFT}", padded.data, 0, (1,))[place].view(np.uint64).reshape(-1, LEFT // 8)
        low, high = place - last, place - first
        right &= _RIGHT[LENGTH - low]
        left &= _LEFT[high]
        of = np.searchsorted(starts, place, "right") - 1
        return Records(right, left, low.astype(np.int8), high.astype(np.int8), doc[of], tag[of], place - starts[of] + base[of])

    def found(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Strings at these offsets before the anchors, as rows key, tag, first and last place."""
        return np.stack([self.doc, self.tag, self.pos - high, self.pos - low], 1)


def _hashes(parts: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(parts[0]), np.uint64)
    for words in parts:
        for i in range(words.shape[1]):
            x = words[:, i] ^ (words[:, i] >> np.uint64(29))
            h ^= x * _ODD[i]
            h = (h << np.uint64(23)) | (h >> np.uint64(41))
            h *= _ODD[i + 8]
    return h ^ (h >> np.uint64(32))


def groups(parts: list[np.ndarray], hashes=_hashes) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal rows (of all parts side by side) stand together, and where in it groups of equal rows begin.

    Rows are put together by a hash and compared word by word; where one hash stands for several, they are sorted instead.
    """
    h = hashes(parts)
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.concatenate([[True], s[1:] != s[:-1]])[: len(s)]
    tied = np.flatnonzero(~new)
    a, b = order[tied], order[tied - 1]
    if not all((p[a] == p[b]).all() for p in parts):
        words = np.concatenate(parts, 1)
        order = np.lexsort(words.T[::-1])
        new = np.concatenate([[True], (words[order[1:]] != words[order[:-1]]).any(1)])
    return order, np.flatnonzero(new)


def least(doc: np.ndarray, order: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The smallest key of each row's group."""
    out = np.empty(len(doc), doc.dtype)
    if len(heads):
        out[order] = np.repeat(np.minimum.reduceat(doc[order], heads), np.diff(np.append(heads, len(order))))
    return out


def settle_equal(r: Records) -> tuple[Records, np.ndarray]:
    """Of equal records those of the smallest key stay; the strings of the others are found."""
    order, heads = groups([r.right, r.left, np.stack([r.low, r.high], 1).astype(np.uint64)])
    later = r.doc > least(r.doc, order, heads)
    gone = r.take(later)
    return r.take(~later) if len(gone) else r, gone.found(gone.low, gone.high)


def multikey(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of words, and of each the leading bytes that it has in common with the one before it.

    Only rows that are equal so far go on to the next word.
    """
    n, levels = words.shape
    order = np.argsort(words[:, 0], kind="stable")
    common = np.zeros(n, np.int64)
    if not n:
        return order, common
    active, run = np.arange(n), np.zeros(n, np.int64)  # places in the order that are still tied, and the run of ties of each
    for level in range(levels):
        w = words[order[active], level]
        if level:
            by = np.lexsort((w, run))
            order[active], w = order[active][by], w[by]
        tied = np.concatenate([[False], run[1:] == run[:-1]])
        equal = tied.copy()
        equal[1:] &= w[1:] == w[:-1]
        apart = np.flatnonzero(tied & ~equal)
        common[active[apart]] = 8 * level + _same(w[apart] ^ w[apart - 1])
        common[active[equal]] = 8 * (level + 1)
        on = equal | np.append(equal[1:], False)
        run = np.cumsum(~equal)[on]
        active = active[on]
        if not len(active):
            break
    return order, common


def _reach(words: np.ndarray) -> np.ndarray:
    """The most leading bytes that each row has in common with any other."""
    order, common = multikey(words)
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(common, np.append(common[1:], 0))
    return out


def _prefixes(r: Records) -> np.ndarray:
    """The suffixes' leading words, in an order that numbers compare by."""
    return r.right.byteswap()


def _strings(r: Records, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for o in range(int(low.min(initial=RUN)), int(high.max(initial=-1)) + 1):
        at = np.flatnonzero((low <= o) & (o <= high))
        if len(at):
            yield o, at


def settle(r: Records, splitters: list[np.ndarray], hashes=_hashes) -> tuple[np.ndarray, list[tuple]]:
    """A bucket's records -> what is found, and strings (bytes, key, tag, place) that other buckets may share.

    splitters: those at the bucket's ends, as leading words.
    """
    if not len(r):
        return np.empty((0, 4), np.int64), []
    open_, found, lead = [], [], _prefixes(r)
    high = r.high.astype(np.int64)
    for s in splitters:  # strings whose right part is a prefix of a splitter
        near = np.flatnonzero(lead[:, 0] == s[0])
        if not len(near):
            continue
        common = np.full(len(near), WORD)
        for level in range(1, LEAD // 8):
            full = common == 8 * level
            common[full] += _same(lead[near[full], level] ^ s[level])
        from_ = np.maximum(r.low[near].astype(np.int64), LENGTH - np.minimum(common, LEAD - 1))
        own = r.take(near)
        for o, at in _strings(own, from_, high[near]):
            whole = np.concatenate([(own.left[at] & _LEFT[o]).view(np.uint8).reshape(-1, LEFT)[:, LEFT - o :], own.right[at].view(np.uint8).reshape(-1, RIGHT)[:, : LENGTH - o]], 1)
            open_ += zip(map(bytes, whole), own.doc[at].tolist(), own.tag[at].tolist(), (own.pos[at] - o).tolist(), strict=True)
        high[near] = np.minimum(high[near], from_ - 1)
    low = r.low.astype(np.int64)
    keep = low <= high
    r, low, high, lead = r.take(keep), low[keep], high[keep], lead[keep]
    if len(r):
        right = _reach(lead)
        may = np.flatnonzero(right >= WORD)
        before = np.concatenate([lead[may, :1], r.left[may][:, ::-1]], 1)
        left = _reach(before) - WORD
        low, high = np.maximum(low[may], LENGTH - right[may]), np.minimum(high[may], left)
        keep = low <= high
        r, low, high = r.take(may[keep]), low[keep], high[keep]
    if len(r):
        # equal records have equal bounds, so those of later documents are found as a whole
        order, heads = groups([r.right, r.left, np.stack([low, high, r.low, r.high], 1).astype(np.uint64)], hashes)
        later = r.doc > least(r.doc, order, heads)
        gone = r.take(later)
        found.append(gone.found(low[later], high[later]))
        r, low, high = r.take(~later), low[~later], high[~later]
        for o, at in _strings(r, low, high):
            order, heads = groups([r.right[at] & _RIGHT[LENGTH - o], r.left[at] & _LEFT[o]], hashes)
            hit = at[r.doc[at] > least(r.doc[at], order, heads)]
            if len(hit):
                own = r.take(hit)
                found.append(own.found(np.full(len(hit), o), np.full(len(hit), o)))
    return (_runs(np.concatenate(found)) if found else np.empty((0, 4), np.int64)), open_


def _runs(found: np.ndarray) -> np.ndarray:
    """Found strings with those that start side by side, or again, as one run."""
    found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]
    same = np.concatenate([[False], (found[1:, :2] == found[:-1, :2]).all(1)])[: len(found)]
    far = found[:, 3].copy()
    near = np.concatenate([[False], found[1:, 2] <= found[:-1, 3] + 1])[: len(found)]
    head = np.flatnonzero(~(same & near))
    if not len(head):
        return found
    return np.column_stack([found[head, :3], np.maximum.reduceat(far, head)])


def _planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _unplaned(b: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(kind).ravel()


def packed(r: Records, z: zstandard.ZstdCompressor) -> bytes:
    """Records as bytes: only what their strings cover, and keys by their differences."""
    keys, of = np.unique(np.stack([r.doc, r.tag], 1), axis=0, return_inverse=True)
    both = np.concatenate([r.right, r.left], 1).view(np.uint8)
    text = both[_cover(r.low, r.high)]
    parts = [
        text.tobytes(), r.low.tobytes(), r.high.tobytes(), _planes(of.ravel().astype("<u4")), _planes(r.pos.astype("<u8")),
        _planes(np.diff(keys[:, 0], prepend=0).astype("<i8")), _planes(keys[:, 1].astype("<u4")),
    ]
    return pickle.dumps([z.compress(p) for p in parts], protocol=5)


def _cover(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return np.concatenate([_RIGHT[LENGTH - low.astype(np.int64)], _LEFT[high.astype(np.int64)]], 1).view(np.uint8) != 0


def unpacked(blob: bytes, z: zstandard.ZstdDecompressor) -> Records:
    text, low, high, of, pos, doc, tag = (z.decompress(p) for p in pickle.loads(blob))
    low, high = np.frombuffer(low, np.int8), np.frombuffer(high, np.int8)
    both = np.zeros((len(low), RIGHT + LEFT), np.uint8)
    both[_cover(low, high)] = np.frombuffer(text, np.uint8)
    words = both.view(np.uint64)
    of = _unplaned(of, "<u4")
    doc, tag = np.cumsum(_unplaned(doc, "<i8")), _unplaned(tag, "<u4").astype(np.int64)
    return Records(words[:, : RIGHT // 8], words[:, RIGHT // 8 :], low, high, doc[of], tag[of], _unplaned(pos, "<u8").astype(np.int64))


def _tag(data: memoryview) -> int:
    """Tells rows of one key apart: 32 bits of a hash of the text."""
    return xxhash.xxh32_intdigest(data)


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A binary column's bytes and offsets, nulls as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8), offsets


def _records(batches: Iterator[pa.RecordBatch], most: int = SLICE) -> Iterator[Records]:
    """Columns key and text -> records of some megabytes of text at a time; longer texts come in several parts."""
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        data, at = _texts(batch.column(1))
        tags = np.array([_tag(data[a:b].data) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], np.int64)
        i = 0
        while i < len(keys):
            if at[i + 1] - at[i] > most:
                for c in range(int(at[i]), int(at[i + 1]), most):
                    part = data[c : min(c + most + LENGTH - 1, int(at[i + 1]))]
                    yield Records.of(part, np.array([0]), np.array([len(part)]), keys[i : i + 1], tags[i : i + 1], np.array([c - at[i]]))
                i += 1
                continue
            j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
            own = np.diff(at[i : j + 1]) > 0
            starts, ends = at[i:j][own] - at[i], at[i + 1 : j + 1][own] - at[i]
            if len(starts):
                yield Records.of(data[at[i] : at[j]], starts, ends, keys[i:j][own], tags[i:j][own], np.zeros(len(starts), np.int64))
            i = j


def _bucket(lead: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """How many splitters are not above each row of leading words."""
    if not len(splitters):
        return np.zeros(len(lead), np.int64)
    low, high = (np.searchsorted(splitters[:, 0], lead[:, 0], side) for side in ("left", "right"))
    close = np.flatnonzero(low < high)
    if len(close):
        text = lambda x: np.ascontiguousarray(x.byteswap()).view(f"S{LEAD}").ravel()
        low[close] = np.searchsorted(text(splitters), text(np.ascontiguousarray(lead[close, : LEAD // 8])), "right")
    return low


def _sample(docs: DataFrame, total: int, buckets: int) -> np.ndarray:
    """Splitters as leading words: quantiles of sampled anchors, whose number follows that of the buckets."""
    wanted = SAMPLED * buckets
    share = min(1.0, wanted * SPARSE * 25 / total)
    dealt = docs.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000) + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _records(batches):
            lead = _prefixes(r)[:, : LEAD // 8]
            lead = lead[(lead[:, 0] * _ODD[3] ^ r.pos.astype(np.uint64) * _ODD[5]) >> np.uint64(58) == 0].astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(lead[:, i]).view(np.int64)) for i in range(LEAD // 8)], names=["a", "b", "c"])

    rows = map_arrow(dealt, run, "a long, b long, c long").collect()
    lead = np.array([tuple(r) for r in rows], np.int64).reshape(-1, LEAD // 8).view(np.uint64)
    lead = lead[np.lexsort(lead.T[::-1])]
    at = np.linspace(0, len(lead), buckets + 1)[1:-1].astype(np.int64) if len(lead) else []
    return np.unique(lead[at], axis=0)


def _rows(found: np.ndarray) -> list[pa.Array]:
    return [pa.array(np.ascontiguousarray(found[:, i])) for i in range(4)]


FOUND = "key long, tag long, first long, last long"


def repeated(docs: DataFrame) -> DataFrame:
    """docs (key long, text binary) -> rows key, tag, first, last: strings that start at first to last of that text are in an earlier one."""
    docs = docs.where("key is not null and octet_length(text) >= " + str(LENGTH))
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, min(MOST_BUCKETS, -(-total // BUCKET)))
    splitters = _sample(docs, total, buckets) if buckets > 1 else np.empty((0, LEAD // 8), np.uint64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(3)
        held: list[Records] = []

        def out() -> Iterator[pa.RecordBatch]:
            r = Records.joined(held)
            held.clear()
            r, found = settle_equal(r)
            lead = _prefixes(r)
            of = _bucket(lead, splitters)
            order = np.lexsort((lead[:, 0], of))
            of = of[order]
            heads = np.flatnonzero(np.diff(of, prepend=-1))
            blobs = [packed(r.take(order[a:b]), z) for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(of)], strict=True)]
            told = [z.compress(_runs(found).astype("<i8").tobytes()), *[None] * (len(blobs) - 1)]
            yield pa.RecordBatch.from_arrays([pa.array(of[heads], pa.int64()), pa.array(blobs, pa.binary()), pa.array(told, pa.binary())], names=["bucket", "records", "found"])

        size = 0
        for r in _records(batches):
            if len(r):
                held.append(r)
                size += len(r)
            if size * 20 >= FLUSH:
                yield from out()
                size = 0
        if held:
            yield from out()

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        z, b = zstandard.ZstdDecompressor(), int(pdf["bucket"].iloc[0])
        r = Records.joined([unpacked(x, z) for x in pdf["records"]])
        got, straddling = settle(r, [splitters[i] for i in (b - 1, b) if 0 <= i < len(splitters)])
        told = [np.frombuffer(z.decompress(x), "<i8").reshape(-1, 4) for x in pdf["found"] if x is not None]
        got = pd.DataFrame(np.concatenate([got, *told]), columns=["key", "tag", "first", "last"])
        rest = pd.DataFrame({"string": [s[0] for s in straddling], **{c: np.array([s[i] for s in straddling], np.int64) for i, c in enumerate(("key", "tag", "first"), 1)}})
        rest["last"] = rest["first"]
        return pd.concat([got.assign(string=None), rest])[["key", "tag", "first", "last", "string"]]

    dealt = map_arrow(docs, deal, "bucket long, records binary, found binary")
    got = saved(dealt.groupBy("bucket").applyInPandas(meet, f"{FOUND}, string binary"))
    across = got.where("string is not null")
    earliest = across.groupBy("string").agg(F.min("key").alias("earliest"))
    met = across.join(earliest, "string").where("key > earliest")
    return got.where("string is null").drop("string").unionByName(met.select("key", "tag", "first", "last"))


MADE = "n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def without_repeats(docs: DataFrame, key: str = "doc_id", keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """keep's columns, n_bytes, spans (maximal removed runs, end exclusive) and kept, the bytes that are left."""
    own = passed(keep, ("n_bytes", "spans", "kept"))
    held = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(own)]).alias("own"), F.col(quoted(key)).cast("long").alias("key"), F.col(quoted(text)).cast("binary").alias("text"))
    found = repeated(held.select("key", "text"))
    spans = found.groupBy("key", "tag").agg(F.collect_list(F.struct("first", "last")).alias("found"))
    kind = held.schema["own"].dataType

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(1)
        for b in batches:
            data, at = _texts(b.column(2))
            cut = [data[i:j].data for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([_tag(t) for t in cut], pa.int64()), pa.array([z.compress(t) for t in cut], pa.binary())], names=["own", "key", "tag", "text"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for b in batches:
            texts = [z.decompress(t) for t in b.column(1).to_pylist()]
            lists = b.column(2)
            flat, ends = lists.flatten(), np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)
            first, last = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            spans, kept = [], []
            for t, i, j in zip(texts, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                runs = merged_spans(first[i:j], last[i:j] + LENGTH)
                spans.append([{"start": a, "end": e} for a, e in runs])
                edges = [0, *(x for r in runs for x in r), len(t)]
                kept.append(b"".join(t[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2)) if runs else t)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())], names=["own", "n_bytes", "spans", "kept"])

    small = map_arrow(held, squeeze, f"own {kind.simpleString()}, key long, tag long, text binary")
    met = small.join(spans, ["key", "tag"], "left").select("own", "text", "found")
    out = map_arrow(met, cut, f"own {kind.simpleString()}, {MADE}")
    return out.select(*[F.col(f"own.c{i}").alias(c) for i, c in enumerate(own)], "n_bytes", "spans", "kept")


def merged_spans(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of what the spans cover."""
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    head = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    return list(zip(start[head].tolist(), end[np.append(head[1:], len(end)) - 1].tolist(), strict=True))
