"""SimHash near-duplicates by meet-in-the-middle ball hashing over 64-bit fingerprints.

Two fingerprints that differ in at most three bits meet at a third within half of that way of each. The
parity of a fingerprint says which half is longer, so the work isn't done twice: an odd one emits its 64
one-bit variants; an even one itself, its 64 one-bit variants, and its two-bit variants whose bits lie in
one half of the word (of three bits two always do). Variants are shuffled; where a variant was reached
by one bit from some fingerprint, every other fingerprint there is within three bits of that one, so a
group gives a star of links, checked again by popcount, and never all its pairs. A group can't hold more
fingerprints than a ball does. Links come to components, and those to all rows.

Variants travel as arrays of 8 bytes and a 2-byte number of the flipped bits, dealt to buckets whose
number follows the number of distinct fingerprints.

Defined cases: a null or empty text, or one of blanks, has fingerprint zero and is linked like any
other; fewer than three words count as one shingle; long texts are hashed whole; a null id is kept and
never names a component unless all its ids are null; of equal ids any names it; repeated rows each get
a row; a kept column that has the name of a result gives way to it; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, map_texts, partitions, passed, quoted, saved
from .components import components

SEED = 42
#: Variants in a bucket, about.
BUCKET = 100_000
#: Variants a task makes before it hands them on.
FLUSH = 300_000
#: Fingerprints that a task deals, about; each makes several hundred variants of 10 bytes.
DEALT = 4_000
#: Bytes of variants that a task gathers by bucket before it hands them on.
GATHER = 32_000_000

_BIT = [1 << i for i in range(64)]
#: What flips: nothing, one bit, two bits of one half.
MASKS = np.array([0, *_BIT, *(_BIT[i] | _BIT[j] for h in (0, 32) for i in range(h, h + 32) for j in range(i + 1, h + 32))], np.uint64)
_ONE = slice(1, 65)
_PER_PAIR = (len(MASKS) + 64) / 2  # variants a fingerprint emits on average


def shingles(text: str | None, n: int = 3) -> list[bytes]:
    """Word n-grams with repeats, A-Z lower-cased, joined by spaces; the whole where there are fewer words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < n:
        return [b" ".join(words)] if words else []
    return [b" ".join(x) for x in zip(*(words[i:] for i in range(n)), strict=False)]


def simhashes(texts: list[str | None], n: int = 3) -> np.ndarray:
    """Fingerprints as unsigned 64-bit integers: a bit is set if it is in over half of the hashes."""
    out = np.zeros(len(texts), np.uint64)
    hash64 = xxhash.xxh64_intdigest
    weights = np.array(_BIT, np.uint64)
    gathered: list[int] = []
    owner: list[tuple[int, int]] = []

    def flush() -> None:
        if owner:
            h = np.array(gathered, "<u8")
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            sums = np.add.reduceat(bits, [a for _, a in owner], axis=0, dtype=np.int32)
            sizes = np.diff([*(a for _, a in owner), len(gathered)])
            out[[i for i, _ in owner]] = ((2 * sums > sizes[:, None]) * weights).sum(1, dtype=np.uint64)
            gathered.clear()
            owner.clear()

    for i, t in enumerate(texts):
        got = shingles(t, n)
        if got:
            owner.append((i, len(gathered)))
            gathered += [hash64(x, SEED) for x in got]
            if len(gathered) > 100_000:
                flush()
    flush()
    return out


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", n: int = 3) -> DataFrame:
    """keep's columns and fp, the fingerprint as a signed long."""
    return map_texts(docs, lambda: lambda texts: ([pa.array(simhashes(texts, n).view(np.int64), pa.int64())], None), "fp long", keep, text)


def _deal(fps: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, variants, numbers of their masks) of some fingerprints."""
    odd = (np.bitwise_count(fps) & 1).astype(bool)
    even, odd = fps[~odd], fps[odd]
    v = np.empty(len(even) * len(MASKS) + len(odd) * 64, np.uint64)
    k = np.empty(len(v), np.uint16)
    cut = len(even) * len(MASKS)
    np.bitwise_xor(even[:, None], MASKS, out=v[:cut].reshape(len(even), len(MASKS)))
    np.bitwise_xor(odd[:, None], MASKS[_ONE], out=v[cut:].reshape(len(odd), 64))
    k[:cut].reshape(len(even), len(MASKS))[:] = np.arange(len(MASKS))
    k[cut:].reshape(len(odd), 64)[:] = np.arange(1, 65)
    mixed = v >> np.uint64(31)
    mixed ^= v
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed >>= np.uint64(32)
    mixed *= np.uint64(buckets)
    mixed >>= np.uint64(32)
    bucket = mixed.astype(np.int32)
    del mixed
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(v)], strict=True):
        own = order[a:b]
        yield int(bucket[a]), v[own].tobytes(), k[own].tobytes()


def _meet(v: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars of links between the fingerprints that share a variant, one of them a bit away from it."""
    order = np.argsort(v, kind="stable")
    v, k = v[order], k[order]
    new = np.diff(v) != 0
    lone = np.concatenate([[True], new]) & np.concatenate([new, [True]])
    v, k = v[~lone], k[~lone]
    if not len(v):
        return v, v
    head = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
    size = np.diff(np.append(head, len(v)))
    fp = v ^ MASKS[k]
    near = np.where((k >= 1) & (k <= 64), np.arange(len(v)), len(v))
    centre = np.repeat(np.minimum.reduceat(near, head), size)
    ok = centre < len(v)
    a, b = fp[centre[ok]], fp[ok]
    link = (a != b) & (np.bitwise_count(a ^ b) <= 3)
    a, b = a[link], b[link]
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def links(fps: DataFrame, count: int) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) that span every component of those within three bits."""
    buckets = max(1, -(-int(count * _PER_PAIR) // BUCKET))
    at_once = max(1, FLUSH // len(MASKS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[bytes], list[bytes]]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            own, part = list(held.items()), []
            for i, (bucket, (v, k)) in enumerate(own, 1):
                part.append((bucket, b"".join(v), b"".join(k)))
                if len(part) >= 64 or i == len(own):
                    cols = list(zip(*part, strict=True))
                    part = []
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())], names=["bucket", "v", "k"])
            held.clear()

        for batch in batches:
            column = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(column), at_once):
                for bucket, v, k in _deal(column[i : i + at_once], buckets):
                    lists = held.setdefault(bucket, ([], []))
                    lists[0].append(v)
                    lists[1].append(k)
                    size += len(v) + len(k) + 150
                if size > GATHER:
                    yield from out()
                    size = 0
        if held:
            yield from out()

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = _meet(np.frombuffer(b"".join(pdf["v"]), np.uint64), np.frombuffer(b"".join(pdf["k"]), np.uint16))
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    # a fingerprint grows several hundredfold, so they are spread by their number, not by their bytes
    spread = fps.select("fp").repartition(max(1, min(partitions(fps), -(-count // DEALT))), "fp")
    return map_arrow(spread, deal, "bucket long, v binary, k binary").groupBy("bucket").applyInPandas(meet, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", keep: tuple[str, ...] = (), text: str = "text", n: int = 3) -> DataFrame:
    """key, keep's columns, fingerprint (hex) and component_id, the smallest key reachable."""
    own = [key, *passed((c for c in keep if c != key), ("fingerprint", "component_id"))]
    held = docs.select(F.struct(*[F.col(quoted(c)) for c in own]).alias("own"), F.col(quoted(text)).alias("text"))
    rows = saved(fingerprints(held, ("own",), "text", n))
    least = F.col(f"own.{quoted(key)}")
    fps = saved(rows.groupBy("fp").agg(F.min(least).alias("least")))
    label = components(links(fps, fps.count())).select(F.col("node").alias("fp"), "label")
    named = fps.join(label, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    whole = named.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = saved(named.join(whole, "label").select("fp", "component_id"))
    return rows.join(ids, "fp").select("own.*", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
