"""Operator 4: exact duplicates by an extendible-hash index on shared files.

1. Keys. Every text has a 64-bit key, its XXH64, and a SHA-256.
2. Directory. A bucket is a prefix of the key, of its local depth. The directory starts at a depth that would
   hold the distinct keys in half-full buckets; while some bucket holds more than ``capacity`` distinct keys
   it is split by its next bits and the directory doubles (its global depth is the longest prefix). Copies
   have one key, so they never overfill a bucket. The directory has a few rows per bucket, is a table of
   its own in the shared folder, and is joined, not broadcast by force.
3. Records. Each task first collapses the copies among its own rows (bytes compared, memory bounded), so a
   text that makes up a third of all rows leaves a task as a few records.
4. Owners. Consecutive buckets go to one owner task: a key range. The owner sorts by key and chains the
   texts of equal keys, comparing bytes; a collision gets a link of its own in the chain. Each link becomes
   one index entry (bucket, key, link, sha256, n_bytes, keep_id, group_size) in the shared files.
5. Every row looks its entry up by key and SHA-256; that join is the one place where copies meet again, narrow
   and splittable by adaptive execution.

Null texts count as empty. Equal texts: the largest doc_id stays (nulls are smaller than any; if all ids of a
group are null, keep_id is null and the null rows stay). Rows that repeat both id and text are all marked
kept; ``without_copies`` keeps one of them. Empty tables give empty results. Other columns are not read by
the report; ``without_copies`` returns them as they were.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from claimwright.llm.common import carried, folder, stored

SEED = 42
_RECORD = "key bigint, text string, keep_id bigint, n bigint"
_ENTRY = "bucket bigint, key bigint, link int, sha256 string, n_bytes bigint, keep_id bigint, group_size bigint"


def normalised(text: Column) -> Column:
    """The contract's texts are equal when identical after no change; null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def keyed(docs: DataFrame, text: Column) -> DataFrame:
    """doc_id, key, sha256: the narrow side."""
    return docs.select("doc_id", F.xxhash64(text).alias("key"), F.sha2(text, 256).alias("sha256"))


def collapsed(docs: DataFrame, text: Column, held_bytes: int = 16 << 20) -> DataFrame:
    """Distinct texts of each task with their largest doc_id and number of rows. A task holds up to
    ``held_bytes`` of distinct text and passes the rest on; nothing is lost, a text may only leave twice."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0
        for batch in batches:
            for doc_id, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                entry = held.get(t)
                if entry is None:
                    held[t] = [doc_id, 1]
                    size += len(t)
                    if size >= held_bytes:
                        yield from _records(held)
                        held, size = {}, 0
                    continue
                entry[1] += 1
                if doc_id is not None and (entry[0] is None or doc_id > entry[0]):
                    entry[0] = doc_id
        if held:
            yield from _records(held)

    return docs.select("doc_id", text.alias("text")).mapInArrow(run, _RECORD)


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def _records(held: dict[str, list], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    texts = list(held)
    for k in range(0, len(texts), rows):
        part = texts[k : k + rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([_signed(xxhash.xxh64_intdigest(t.encode(), SEED)) for t in part], pa.int64()), pa.array(part, pa.string()),
             pa.array([held[t][0] for t in part], pa.int64()), pa.array([held[t][1] for t in part], pa.int64())],
            names=["key", "text", "keep_id", "n"],
        )


def _prefix(depth) -> Column:
    """The first ``depth`` bits of the key as a left-aligned number below 2^62, so that prefixes order like keys."""
    return F.expr(f"shiftleft(shiftrightunsigned(key, 64 - ({depth})), 62 - ({depth}))")


def directory(keys: DataFrame, capacity: int, label: str = "directory") -> tuple[DataFrame, list[int]]:
    """Buckets (depth, bucket, keys, owner) and the local depths in use. ``keys``: a column key.

    A split takes as many bits as the bucket's own count asks for, so a skewed range needs few rounds.
    """
    distinct = stored(keys.select("key").distinct(), "keys")
    n = distinct.count()
    start = max(1, math.ceil(math.log2(max(1, 2 * n / capacity))))
    open_keys, parts, depths, deepest = distinct, [], [], 62
    while True:
        cells = stored(open_keys.groupBy(_prefix(start).alias("bucket")).agg(F.count(F.lit(1)).alias("keys")), label)
        overfull = (F.col("keys") > capacity) & F.lit(start < deepest)
        full = cells.filter(overfull)
        most = full.agg(F.max("keys")).first()[0]
        parts.append(cells.filter(~overfull).withColumn("depth", F.lit(start)))
        depths.append(start)
        if not most:
            break
        open_keys = open_keys.withColumn("bucket", _prefix(start)).join(full.select("bucket"), "bucket", "left_semi").select("key")
        start = min(deepest, start + max(1, math.ceil(math.log2(2 * most / capacity))))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found, depths


def owned(buckets: DataFrame, keys_per_owner: int) -> DataFrame:
    """Owner of each bucket: consecutive buckets, a key range, until the owner has its share of keys.

    The running sum goes over one row per bucket, in two steps: first by the bucket's own upper bits.
    """
    upper = F.shiftright("bucket", 50).alias("upper")
    with_upper = buckets.withColumn("upper", upper)
    sums = with_upper.groupBy("upper").agg(F.sum("keys").alias("of_upper"))
    before = Window.orderBy("upper").rowsBetween(Window.unboundedPreceding, -1)  # 4,096 rows at most
    sums = sums.select("upper", F.coalesce(F.sum("of_upper").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("upper").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("base") + F.coalesce(F.sum("keys").over(within), F.lit(0))
    return with_upper.join(sums, "upper").select("depth", "bucket", "keys", F.floor(at / keys_per_owner).cast("int").alias("owner"))


def chained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owner's work on records sorted by (bucket, key): one chain per key, one link per different text."""
    from hashlib import sha256

    key, bucket, chain, out = None, None, [], []

    def closed():
        for link, (data, keep_id, n) in enumerate(chain):
            out.append((bucket, key, link, sha256(data).hexdigest(), len(data), keep_id, n))

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("bucket", "key", "text", "keep_id", "n")]
        for b, k, text, keep_id, n in zip(*columns):
            if (b, k) != (bucket, key):
                closed()
                bucket, key, chain = b, k, []
                if len(out) >= 10_000:
                    yield _entries(out)
                    out = []
            data = text.encode()
            for link in chain:
                if link[0] == data:
                    link[2] += n
                    if keep_id is not None and (link[1] is None or keep_id > link[1]):
                        link[1] = keep_id
                    break
            else:
                chain.append([data, keep_id, n])
    closed()
    if out:
        yield _entries(out)


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in _ENTRY.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)


def build_index(docs: DataFrame, capacity: int = 4096, keys_per_owner: int = 16_384, text: Column | None = None) -> DataFrame:
    """The index entries, one per different text, written to the shared folder and read back."""
    spark = docs.sparkSession
    text = normalised(F.col("text")) if text is None else text
    found, depths = directory(docs.select(F.xxhash64(text).alias("key")), capacity)
    root = folder(spark, "index")
    owned(found, keys_per_owner).write.parquet(f"{root}/directory")
    buckets = spark.read.parquet(f"{root}/directory").select("depth", "bucket", "owner")
    owners = (buckets.agg(F.max("owner")).first()[0] or 0) + 1
    records = collapsed(docs, text)
    # The bucket of a key is the one directory row that equals its prefix at one of the depths in use.
    if len(depths) == 1:
        placed = records.withColumn("bucket", _prefix(depths[0])).join(buckets.drop("depth"), "bucket")
    else:
        looked_up = F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(d).alias("bucket")) for d in depths])
        places = records.select("key").distinct().select("key", F.inline(looked_up)).join(buckets, ["depth", "bucket"])
        placed = records.join(places.drop("depth"), "key")
    ordered = placed.select("bucket", "key", "text", "keep_id", "n", "owner").repartitionById(owners, F.col("owner"))
    ordered = ordered.drop("owner").sortWithinPartitions("bucket", "key")
    ordered.mapInArrow(chained, _ENTRY).write.parquet(f"{root}/entries")
    return spark.read.schema(_ENTRY).parquet(f"{root}/entries")


def exact_duplicates(docs: DataFrame, capacity: int = 4096, keys_per_owner: int = 16_384) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    text = normalised(F.col("text"))
    entries = build_index(docs, capacity, keys_per_owner).select("key", "sha256", "keep_id", "group_size")
    found = keyed(docs, text).join(entries, ["key", "sha256"])
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                        F.col("sha256").alias("text_sha256"))


def without_copies(docs: DataFrame, capacity: int = 4096, keys_per_owner: int = 16_384) -> DataFrame:
    """The documents that stay, with all their columns: one row per different text.

    Rows to keep are matched by (doc_id, text); of rows that repeat both, one stays, chosen by a hash of the
    whole row, so that a rerun agrees.
    """
    entries, text = build_index(docs, capacity, keys_per_owner), normalised(F.col("text"))
    rows = carried(docs, "doc_id", F.xxhash64(text).alias("key"), F.sha2(text, 256).alias("sha256"))
    stay = entries.select(F.col("key").alias("k"), F.col("sha256").alias("s"), "keep_id")
    same = (F.col("key") == F.col("k")) & (F.col("sha256") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    first = Window.partitionBy("sha256").orderBy(F.xxhash64("whole_row"))
    return rows.join(stay, same, "left_semi").withColumn("n", F.row_number().over(first)).filter("n = 1").select("whole_row.*")
