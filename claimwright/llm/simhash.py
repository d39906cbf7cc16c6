"""Operator 3: SimHash near duplicates by Golay-code fuzzy hashing.

Fingerprint: 64 bits; a bit is set if it is set in over half of the XXH64 of the document's word shingles.

Keys. Two fingerprints within 3 bits agree on one of the four 16-bit segments (pigeonhole: 3 errors, 4
segments). Given such a segment, the 48 other bits are two windows of 23 bits and 2 bits over; one window has
at most one error. A window is decoded by the binary Golay code [23, 12, 7], which is perfect: every 23-bit
word is within 3 bits of just one codeword. So a key is (segment, window, the segment's 16 bits, the 12-bit
index of the nearest codeword). The index of a word one bit away may differ, so a fingerprint asks under the
index of each word within one bit, which are 1 or 6 different ones, and is filed under its own: 8 tables, one
filed key and 1 or 6 asking keys in each, 28 bits long.

Join and verify. Equal fingerprints are one row before any key is made, so copies cost nothing. Rows are dealt
and sorted by key. A task goes through its runs of equal keys, counts the bits that differ and passes on a
spanning forest of the links found, never the pairs: a run of n fingerprints leaves as n - 1 links at most.
A run longer than ``block`` is cut into blocks; the forest of each block comes from its own task, those between
two blocks from a task of their own each, so no task holds more than two blocks.

Components are label stars over the links. Null and empty texts have fingerprint zero, linked like any other.
Rows that repeat an id have a fingerprint each. component_id is the smallest doc_id reachable (nulls left
aside). Empty tables give no rows. Other columns are not read by the report.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from claimwright.llm.common import carried, map_batches, stored, whole_texts
from claimwright.llm.components import components

SEED = 42
#: Generator polynomial of the Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
BITS = 64


# Fingerprints ------------------------------------------------------------------------------------


def fingerprint(text: str, shingle: int) -> bytes:
    """8 bytes, most significant first."""
    words = text.encode().lower().split()  # of bytes: A-Z only, and the six ASCII spaces
    if not words:
        return bytes(8)
    if len(words) < shingle:
        return xxhash.xxh64_digest(b" ".join(words), SEED)
    n = len(words) - shingle + 1
    digests = map(xxhash.xxh64_digest, map(b" ".join, zip(*(words[k:] for k in range(shingle)))), repeat(SEED))
    ones = np.zeros(BITS, np.int64)
    step, at = 1 << 16, 0
    raw = np.frombuffer(b"".join(digests), np.uint8).reshape(n, 8)
    while at < n:
        ones += np.unpackbits(raw[at : at + step], axis=1).sum(axis=0, dtype=np.int32)
        at += step
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, mark (a hash of the text) and fp (the fingerprint as a signed 64-bit number)."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        raw = b"".join(fingerprint(t, shingle) for t in rows.column("text").to_pylist())
        fps = pa.array(np.frombuffer(raw, ">i8").astype(np.int64))
        return pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("mark"), fps], names=["doc_id", "mark", "fp"])

    return map_batches(whole_texts(docs).withColumn("mark", F.xxhash64("text")), batch, "doc_id bigint, mark bigint, fp bigint")


# Golay keys --------------------------------------------------------------------------------------


@cache
def _decoder() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the upper 12 and lower 11 bits' values (the code is linear), and each syndrome's error."""

    def syndrome(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << bit - 11
        return word

    of_bit = [syndrome(1 << b) for b in range(23)]
    upper = np.zeros(1 << 12, np.int32)
    for b in range(12):
        upper[1 << b : 2 << b] = upper[: 1 << b] ^ of_bit[11 + b]
    errors = np.full(1 << 11, -1, np.int32)
    for a in range(-1, 23):
        for b in range(-1, 23):
            for c in range(-1, 23):
                chosen = {x for x in (a, b, c) if x >= 0}
                s = e = 0
                for x in chosen:
                    s, e = s ^ of_bit[x], e | 1 << x
                errors[s] = e
    return upper, np.arange(1 << 11, dtype=np.int32), errors


def nearest_index(words: np.ndarray) -> np.ndarray:
    """12-bit index of the nearest codeword of 23-bit words."""
    upper, lower, errors = _decoder()
    return (words ^ errors[upper[words >> 11] ^ lower[words & 0x7FF]]) >> 11


def keys(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of the 8 tables: keys under which to ask, one column per word within one bit, the own one first."""
    fps = fps.astype(np.uint64)
    flips = np.concatenate([[0], 1 << np.arange(23)]).astype(np.int32)
    for segment in range(4):
        shift = np.uint64(16 * segment)
        exact = (fps >> shift & np.uint64(0xFFFF)).astype(np.int64)
        low = fps & ((np.uint64(1) << shift) - np.uint64(1))
        high = (fps >> shift >> np.uint64(16)) << shift
        rest = low | high  # the 48 other bits
        for window in range(2):
            word = (rest >> np.uint64(23 * window) & np.uint64(0x7FFFFF)).astype(np.int32)
            index = nearest_index(word[:, None] ^ flips[None, :]).astype(np.int64)
            yield (np.int64(segment * 2 + window) << 28) | exact[:, None] << 12 | index


def keyed(distinct: DataFrame) -> DataFrame:
    """(key, fp, filed) rows of each fingerprint: filed under its own key, asking under the near ones."""

    def batch(rows: pa.RecordBatch) -> pa.Table:
        parts = []
        whole = np.asarray(rows.column("fp"))
        for at in range(0, len(whole), 4096):
            fps = whole[at : at + 4096]
            for table in keys(fps.view(np.uint64)):
                own = table[:, 0].copy()
                table.sort(axis=1)
                other = np.ones(table.shape, bool)
                other[:, 1:] = table[:, 1:] != table[:, :-1]
                other &= table != own[:, None]
                row, _ = np.nonzero(other)
                key = np.concatenate([own, table[other]])
                fp = np.concatenate([fps, fps[row]])
                filed = np.arange(len(key)) < len(own)
                parts.append(pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp), pa.array(filed)], names=["key", "fp", "filed"]))
        return pa.Table.from_batches(parts)

    return map_batches(distinct, batch, "key bigint, fp bigint, filed boolean")


# Join and verify ---------------------------------------------------------------------------------

_FOUND = "a bigint, b bigint, key bigint, block int, fps array<bigint>"


def forest(left: np.ndarray, right: np.ndarray | None, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within ``left``, or between ``left`` and ``right`` if given."""
    nodes = left if right is None else np.concatenate([left, right])
    side = np.arange(len(nodes)) < len(left)
    open_, a, b = np.ones(len(nodes), bool), [], []
    while open_.any():
        seed = int(np.argmax(open_))
        open_[seed] = False
        front = np.array([seed])
        while len(front) and open_.any():
            rest = np.nonzero(open_)[0]
            near = np.bitwise_count(nodes[front][:, None] ^ nodes[rest][None, :]) <= most
            if right is not None:
                near &= side[front][:, None] != side[rest][None, :]
            hit = near.any(axis=0)
            new, by = rest[hit], front[near[:, hit].argmax(axis=0)] if hit.any() else front[:0]
            a.append(nodes[by])
            b.append(nodes[new])
            open_[new] = False
            front = new
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def _links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    n = len(a)
    columns = [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", "key", "block", "fps"])


def _block(key: int, number: int, fps: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "a": pa.nulls(1, pa.int64()), "b": pa.nulls(1, pa.int64()), "key": pa.array([key], pa.int64()), "block": pa.array([number], pa.int32()),
        "fps": pa.array([fps.view(np.int64)], pa.list_(pa.int64())),
    })


def runs(batches: Iterable[pa.RecordBatch], most: int, block: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, fp): links of every run, or its blocks where it is longer than one."""
    kept_key, kept, number, any_filed = None, np.zeros(0, np.uint64), 0, False

    def close(last: bool):
        """Of the run held: its links, or one block of a long run."""
        nonlocal kept, number
        if len(kept) > 1 and number == 0 and last:
            if any_filed:
                a, b = forest(kept, None, most)
                if len(a):
                    yield _links(a, b)
        elif number or not last:
            if len(kept):
                yield _block(kept_key, number, kept)
            number += 1
        kept = kept[:0]

    for batch in batches:
        key, fp, filed = (np.asarray(batch.column(c)) if c != "filed" else batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp", "filed"))
        fp = fp.view(np.uint64)
        starts = np.concatenate([[0], np.nonzero(key[1:] != key[:-1])[0] + 1])
        ends = np.append(starts[1:], len(key))
        # Most runs hold one fingerprint; all but the first and last of a batch are complete, so those go at once.
        more = np.nonzero((ends - starts > 1) | (np.arange(len(starts)) == 0) | (np.arange(len(starts)) == len(starts) - 1))[0]
        for r in more.tolist():
            s, e = int(starts[r]), int(ends[r])
            if key[s] != kept_key:
                yield from close(last=True)
                kept_key, number, any_filed = int(key[s]), 0, False
            any_filed = any_filed or bool(filed[s:e].any())
            part = fp[s:e]
            for k in range(0, len(part), block):
                piece = part[k : k + block]
                fresh = np.unique(np.concatenate([kept, piece]))
                kept = fresh
                while len(kept) > block:
                    whole, rest = kept[:block], kept[block:]
                    kept = whole
                    yield from close(last=False)
                    kept = rest
    yield from close(last=True)


def links(distinct: DataFrame, most: int, block: int = 1024) -> DataFrame:
    """(a, b): fingerprints that differ in ``most`` bits or fewer; enough of them to keep all that is connected."""
    if most > 3:
        raise ValueError("the tables are complete up to 3 differing bits")
    rows = keyed(distinct).repartition("key").sortWithinPartitions("key", "fp")
    found = stored(rows.mapInArrow(lambda batches: runs(batches, most, block), _FOUND), "runs")
    blocks = found.filter("key is not null").select("key", "block", "fps")
    one = blocks.select("key", F.col("block").alias("i"), F.col("fps").alias("left"))
    two = blocks.select("key", F.col("block").alias("j"), F.col("fps").alias("right"))
    pairs = one.join(two, "key").filter("i <= j").repartition("key", "i", "j").select("left", "right", (F.col("i") == F.col("j")).alias("same"))

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                left, right = (np.asarray(batch.column(c)[row].values).view(np.uint64) for c in ("left", "right"))
                a, b = forest(left, None if batch.column("same")[row].as_py() else right, most)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    between = pairs.mapInArrow(verify, "a bigint, b bigint")
    return found.filter("key is null").select("a", "b").unionByName(between)


def rooted(docs: DataFrame, shingle: int, most: int, block: int) -> DataFrame:
    """doc_id, mark, fp, root (a fingerprint of the component, the same for all of it), component_id of every row."""
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    stars = components(links(distinct.select("fp"), most, block))
    of_fp = distinct.join(stars, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = of_fp.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(of_fp.join(least, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, most: int = 3, block: int = 1024) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rooted(docs, shingle, most, block).select("doc_id", hexed, "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, most: int = 3, block: int = 1024) -> DataFrame:
    """Documents with all their columns, one of each component: the row with the component's smallest doc_id.

    Of rows that share that id, or where a component has no id at all, the least hash of the text decides, then
    that of the whole row.
    """
    least = Window.partitionBy("root").orderBy("mark")
    stay = rooted(docs, shingle, most, block).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = stay.withColumn("n", F.row_number().over(least)).filter("n = 1").select(F.col("doc_id").alias("i"), F.col("mark").alias("m"))
    rows = carried(docs, "doc_id", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("mark"))
    kept = rows.join(stay, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m")), "left_semi")
    first = Window.partitionBy("doc_id", "mark").orderBy(F.xxhash64("whole_row"))
    return kept.withColumn("n", F.row_number().over(first)).filter("n = 1").select("whole_row.*")
