"""Operator 7: approximate nearest neighbours by a hash-prefix forest.

Index. ``trees`` trees; in each a vector has a string of 64 bits, the sides of 64 random planes. A tree is the
sorted array of its strings. It is stored in pages, a page being the strings with one prefix, sorted; pages
that hold more rows than planned are cut into slices by a hash of the row, so no task holds more than a slice.

Descend. A query finds its string's place in each tree by binary search and counts, for every prefix length, how
many strings share that much: in its own page from the page, above it from the pages' sizes. The longest
prefix that some string shares is where the descent ends.

Ascend. All trees go up together, one bit at a time, until the nodes reached hold at least
max(``least``, ``share`` x rows) rows over all trees. The rows below these nodes, the whole of every node, are the
candidates; in each page they are compared with the query in double precision, and the best go on.

``share``: with vectors without structure, such as the test tables', no index finds most of the nearest among few
candidates; a share of the rows keeps the recall at every size, and nodes are read page by page, in blocks. With
clustered vectors a smaller share does.

Equal vectors are one row of the index with their smallest ids (one more than asked for, no more can be in any
result), so a vector that makes up a third of all rows is one entry. Queries of a page are cut into blocks too.

Vectors that are null, zero or hold nulls or non-finite numbers, and rows with a null id, take no part; nor do
vectors of another length than the most common one. Ids that repeat are ids of several vectors; none is its own
neighbour. Ties go to the smaller id. With few rows the ascent reaches the root: every row is a candidate.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from claimwright.llm.common import map_batches, stored

BITS = 64


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0))
    usual = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("embedding") == (usual["n"] if usual else 0))


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """rep (smallest id), ids (the ``ids`` smallest), embedding: one row per different vector."""
    first = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= ids)
    return few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("rep"), "ids", "embedding")


def _planes(width: int, trees: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((width, trees * BITS))


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def strings(rows: DataFrame, id_column: str, trees: int, width: int, seed: int) -> DataFrame:
    """(id, tree, string, vector) rows; a string is an unsigned 64-bit number in a signed column, first bit on top."""

    def batch(part: pa.RecordBatch) -> pa.Table:
        x, out = _matrix(part.column("embedding"), part.num_rows), []
        sides = (x @ _planes(width, trees, seed) > 0).reshape(len(x), trees, BITS)
        packed = np.packbits(sides, axis=2).view(">u8").reshape(len(x), trees).astype(np.uint64)
        raw = pa.array([v.tobytes() for v in np.ascontiguousarray(x)], pa.binary())
        for t in range(trees):
            out.append(pa.RecordBatch.from_arrays(
                [part.column(id_column), pa.array(np.full(len(x), t, np.int32)), pa.array(packed[:, t].view(np.int64)), raw],
                names=["id", "tree", "string", "vector"]))
        return pa.Table.from_batches(out)

    return map_batches(rows.select(id_column, "embedding"), batch, "id bigint, tree int, string bigint, vector binary")


def _page(bits: int) -> Column:
    return F.shiftrightunsigned("string", BITS - bits).cast("bigint") if bits else F.lit(0).cast("bigint")


def _prefixes(string: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last 64-bit string below the node of ``depth`` bits on the way to ``string``."""
    free = (BITS - depth).astype(np.uint64)
    mask = np.where(depth == 0, ~np.uint64(0), (np.uint64(1) << np.minimum(free, np.uint64(63))) - np.uint64(1))
    return string & ~mask, string | mask


def nearest(vectors: DataFrame, queries: Column, k: int = 5, trees: int = 20, share: float = 1.0, least: int = 1000,
            page_rows: int = 4096, query_block: int = 8192, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row for which ``queries`` holds."""
    spark = vectors.sparkSession
    rows = stored(usable(vectors), "vectors")
    head = rows.select(F.size("embedding").alias("n")).first()
    if head is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    width = head["n"]
    distinct = stored(distinct_vectors(rows, k + 1), "distinct")
    n = distinct.count()
    bits = max(0, math.ceil(math.log2(n / page_rows)))
    wanted = max(least, math.ceil(share * n))

    # Pages: their sizes, slices, and the sizes of the nodes above them.
    hashed = strings(distinct, "rep", trees, width, seed).withColumn("page", _page(bits))
    sizes = hashed.groupBy("tree", "page").agg(F.count(F.lit(1)).alias("rows"))
    above = [F.sum("rows").over(Window.partitionBy("tree", F.shiftright("page", bits - d))) for d in range(bits)]
    pages = sizes.select("tree", "page", "rows", F.ceil(F.col("rows") / (2 * page_rows)).cast("int").alias("slices"),
                         (F.array(*above) if above else F.array().cast("array<bigint>")).alias("above"))
    pages = stored(pages, "pages")
    slice_of = F.pmod(F.xxhash64("id"), F.col("slices")).cast("int").alias("slice")
    index = hashed.join(pages.select("tree", "page", "slices"), ["tree", "page"]).select("tree", "page", slice_of, "string", "id", "vector")
    index = stored(index.repartition("tree", "page", "slice").sortWithinPartitions("tree", "page", "slice", "string"), "forest")

    asked = stored(strings(rows.filter(queries), "vec_id", trees, width, seed).withColumn("page", _page(bits)), "queries")
    every_slice = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
    blocks = max(1, math.ceil(asked.count() / trees / query_block))
    block_of = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("part")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("part")
    cell = ["tree", "page", "slice", "part"]

    def descend(entries: pa.Table, ask: pa.Table) -> pa.Table:
        if not entries.num_rows or not ask.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "counts": pa.array([], pa.list_(pa.int64()))})
        array = np.sort(entries["string"].to_numpy().view(np.uint64))
        at = ask["string"].to_numpy().view(np.uint64)
        counts = np.zeros((len(at), BITS + 1), np.int64)
        for depth in range(bits, BITS + 1):
            low, high = _prefixes(at, np.full(len(at), depth))
            counts[:, depth] = np.searchsorted(array, high, "right") - np.searchsorted(array, low, "left")
            if not counts[:, depth].any():
                break
        flat = pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * (BITS + 1), counts.ravel())
        return pa.table({"id": ask["id"].combine_chunks(), "counts": flat})

    to_pages = asked.join(pages.select("tree", "page", "slices", "above"), ["tree", "page"])
    routed = to_pages.select("id", "string", "tree", "page", every_slice, block_of)
    in_pages = (
        index.select("tree", "page", "slice", "string", every_block).groupBy(*cell)
        .cogroup(routed.groupBy(*cell)).applyInArrow(descend, "id bigint, counts array<bigint>")
    )
    deep = in_pages.groupBy("id").agg(F.array(*[F.sum(F.col("counts")[d]) for d in range(BITS + 1)]).alias("deep"))
    shallow = to_pages.groupBy("id").agg((F.array(*[F.sum(F.col("above")[d]) for d in range(bits)]) if bits else F.array().cast("array<bigint>")).alias("shallow"))
    both = deep.join(shallow, "id")
    held = [F.col("shallow")[d] if d < bits else F.col("deep")[d] for d in range(BITS + 1)]
    depth = F.greatest(F.lit(0), *[F.when(held[d] >= wanted, F.lit(d)).otherwise(0) for d in range(1, BITS + 1)])
    depths = stored(both.select("id", depth.alias("depth")), "depths")

    def ascend(entries: pa.Table, ask: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if entries.num_rows and ask.num_rows:
            strings_ = entries["string"].to_numpy().view(np.uint64)
            order = np.argsort(strings_, kind="stable")
            array, reps = strings_[order], entries["id"].to_numpy()[order]
            x = np.frombuffer(b"".join(entries["vector"].to_pylist()), np.float64).reshape(len(order), -1)[order]
            x = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
            at, deep_ = ask["string"].to_numpy().view(np.uint64), ask["depth"].to_numpy()
            low, high = _prefixes(at, deep_)
            first, last = np.searchsorted(array, low, "left"), np.searchsorted(array, high, "right")
            # A node above this page holds all of it.
            first, last = np.where(deep_ <= bits, 0, first), np.where(deep_ <= bits, len(array), last)
            q = np.frombuffer(b"".join(ask["vector"].to_pylist()), np.float64).reshape(len(at), -1)
            q = q / np.sqrt(np.einsum("ij,ij->i", q, q))[:, None]
            for lo in range(0, len(at), 256):
                scores = q[lo : lo + 256] @ x.T
                for row, s in enumerate(scores):
                    a, b = int(first[lo + row]), int(last[lo + row])
                    s = s[a:b]
                    if b - a > k + 1:
                        best = np.nonzero(s >= np.partition(s, b - a - k - 1)[b - a - k - 1])[0]
                    else:
                        best = np.arange(b - a)
                    best = best[np.lexsort((reps[a + best], -s[best]))][: k + 1]
                    found.append((np.full(len(best), lo + row), reps[a + best], s[best]))
        if not found:
            return pa.table({"query_id": pa.array([], pa.int64()), "rep": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        who, rep, score = (np.concatenate(c) for c in zip(*found))
        return pa.table({"query_id": ask["id"].to_numpy()[who], "rep": rep, "score": score})

    # At a node above the pages, every page below it.
    span = F.expr(f"shiftleft(1L, {bits} - least(depth, {bits}))")
    low = F.col("page") - F.pmod(F.col("page"), span)
    below = asked.join(depths, "id").withColumn("_low", low).withColumn("_span", span).withColumn("page", F.explode(F.sequence(F.col("_low"), F.col("_low") + F.col("_span") - 1)))
    routed = below.join(pages.select("tree", "page", "slices"), ["tree", "page"]).select("id", "string", "depth", "vector", "tree", "page", every_slice, block_of)
    best = (
        index.select("tree", "page", "slice", "string", "id", "vector", every_block).groupBy(*cell)
        .cogroup(routed.groupBy(*cell)).applyInArrow(ascend, "query_id bigint, rep bigint, score double")
    )
    best = best.groupBy("query_id", "rep").agg(F.max("score").alias("score"))
    each = best.join(distinct.select("rep", "ids"), "rep").select("query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id <> query_id")
    each = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
