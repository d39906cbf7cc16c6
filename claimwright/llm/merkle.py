"""Operator 13: a Merkle manifest of a dataset by nested-struct rollup.

Every row is a leaf. The leaves of a group ascend by id; every ``RUN`` consecutive nodes are hashed into one
until a group's subroot is left, and the subroots, in order of their group, likewise into the root.

Ranks. Rows are dealt by ranges of (group, id, leaf), so that a group with a third of the rows takes many tasks; a
row's place within its task and the counts of the tasks before it give its rank.

Rollup. A rank's digits in base ``RUN`` say where a node stands. ``DIGITS`` of them, the lowest first, are grouped away
one after another, each time nesting the child structs in their parent: a block of at most RUN ** DIGITS leaves is one
row, dealt once, as the grouping keys only shrink. Block roots are the nodes of the next round, until each
group has one. A round holds one node for every RUN ** DIGITS of the round before.

Proofs. The way from a block's root to the top comes down as a row of its own and is grouped with the block; transforms
walk through the nested structs and note the siblings on the left and right of each step, and explode emits the nodes
with their path. No join takes part, so null groups need no care. Only hashes travel, texts are read once.

All of it is Spark's own functions. A null group is a group, before all others; null ids come first. Rows that
share an id are ordered by their leaves; equal rows have leaves of their own, next to each other. Null fields are `-`,
empty texts `0:`; a text is hashed whole, whatever its length. An empty table gives no rows. Other columns of
the input are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from claimwright.llm.common import stored

RUN, DIGITS = 3, 6
ROWS_PER_TASK = 500_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon, and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    return digest(*map(field, values))


def _tasks(nodes: DataFrame) -> int:
    return max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), nodes.count() // ROWS_PER_TASK)


def ranked(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Written nodes (grp, hash, item) with the rank among those of their group and the group's size n."""
    keys = [F.col("grp").asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order)]
    dealt = nodes.repartitionByRange(_tasks(nodes), *keys).sortWithinPartitions(*keys)
    placed = stored(dealt.select("grp", "hash", "item", F.monotonically_increasing_id().alias("place")), "merkle-places")
    # The upper bits of such an id are those of its task.
    placed = placed.withColumn("part", F.shiftright("place", 33))
    held = placed.groupBy("part", "grp").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = F.expr("coalesce(sum(rows) over (partition by grp order by part rows between unbounded preceding and 1 preceding), 0)")
    held = held.select(F.col("part").alias("p"), F.col("grp").alias("g"), (before - F.col("first")).alias("shift"), F.expr("sum(rows) over (partition by grp)").alias("n"))
    same = (F.col("part") == F.col("p")) & F.col("grp").eqNullSafe(F.col("g"))
    return placed.join(held, same).select("grp", (F.col("place") + F.col("shift")).alias("rank"), "n", "hash", "item")


def rolled(nodes: DataFrame) -> DataFrame:
    """grp, block, n, node: blocks of nodes as one nested struct each."""
    size = RUN**DIGITS
    digits = [F.expr(f"cast(rank div {RUN**d} % {RUN} as int)").alias(f"d{d}") for d in range(DIGITS)]
    rows = nodes.select("grp", F.expr(f"rank div {size}").alias("block"), "n", *digits, F.struct("hash", "item").alias("node"))
    rows = rows.repartition(_tasks(nodes), "grp", "block")
    for d in range(DIGITS):
        keys = ["grp", "block", "n", *(f"d{i}" for i in range(d + 1, DIGITS))]
        kids = F.sort_array(F.collect_list(F.struct(f"d{d}", "node")))["node"]
        rows = rows.groupBy(*keys).agg(kids.alias("kids"))
        # A group that is one node already is not hashed any more.
        parent = F.when(F.col("n") > RUN**d, digest(F.array_join(F.col("kids")["hash"], ""))).otherwise(F.col("kids")[0]["hash"])
        rows = rows.select(*keys, F.struct(parent.alias("hash"), F.col("kids")).alias("node"))
    return rows


def _below(node: Column, level: int) -> Column:
    """The leaves of a nested node: place, hash, item and path, an entry per step from the leaf to the node."""
    if not level:
        return F.array(F.struct(F.lit(0).cast("bigint").alias("place"), node["hash"].alias("hash"), node["item"].alias("item"), F.array().cast(_PATH).alias("path")))
    kids, width = node["kids"], RUN ** (level - 1)

    def beside(kid: Column, i: Column) -> Column:
        left, right = F.slice(kids["hash"], 1, i), F.slice(kids["hash"], i + 2, F.lit(RUN))
        return F.struct(kid.alias("kid"), i.alias("i"), F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right")).alias("step"))

    def under(run: Column) -> Column:
        def longer(leaf: Column) -> Column:
            path = F.when(F.col("n") > width, F.concat(leaf["path"], F.array(run["step"]))).otherwise(leaf["path"])
            return F.struct((leaf["place"] + run["i"] * width).alias("place"), leaf["hash"].alias("hash"), leaf["item"].alias("item"), path.alias("path"))

        return F.transform(_below(run["kid"], level - 1), longer)

    return F.flatten(F.transform(F.transform(kids, beside), under))


def unrolled(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Nodes of the blocks with their path to the top. above: grp, rank (of the block), path from there, top."""
    none = F.lit(None)
    kinds = dict(blocks.dtypes)
    down = above.select("grp", F.col("rank").alias("block"), none.cast("bigint").alias("n"), none.cast(kinds["node"]).alias("node"), "path", "top")
    up = blocks.select("grp", "block", "n", "node", none.cast(_PATH).alias("path"), none.cast(dict(above.dtypes)["top"]).alias("top"))
    both = up.unionByName(down).repartition(_tasks(blocks), "grp", "block").groupBy("grp", "block")
    # One block and one way up per group: what is not null of either.
    met = both.agg(F.max("n").alias("n"), *(F.collect_list(c)[0].alias(c) for c in ("node", "path", "top")))
    rows = met.select("grp", "block", F.col("path").alias("rest"), "top", F.explode(_below(F.col("node"), DIGITS)).alias("leaf"))
    rank = (F.col("block") * RUN**DIGITS + F.col("leaf.place")).alias("rank")
    return rows.select("grp", rank, "leaf.hash", "leaf.item", F.concat("leaf.path", "rest").alias("path"), "top")


def rounds(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The written blocks of each round, and the one node (grp, hash) left of every group."""
    found = []
    while True:
        blocks = stored(rolled(nodes), "merkle-blocks")
        found.append(blocks)
        nodes = blocks.select("grp", F.col("block").alias("rank"), F.ceil(F.col("n") / RUN**DIGITS).cast("bigint").alias("n"), F.col("node.hash").alias("hash"), F.lit(None).cast("string").alias("item"))
        if (nodes.agg(F.max("n")).first()[0] or 1) == 1:
            return found, nodes.select("grp", "hash")


def descended(found: list[DataFrame], above: DataFrame) -> DataFrame:
    for blocks in reversed(found):
        nodes = unrolled(blocks, above)
        above = nodes.select("grp", "rank", "path", "top")
    return nodes


def proofs(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """grp, rank, hash, item, path, subroot, root for every leaf. leaves: a written table of grp, hash, item, and
    what they are ordered by within a group.

    path: from the leaf to the root, the hashes on the left and on the right of each step, joined."""
    found, subroots = rounds(ranked(leaves, order))
    # The subroots are the leaves of one more tree, whose only group is null.
    tops = stored(subroots.select(F.lit(None).cast("string").alias("grp"), "hash", F.struct(F.col("grp").alias("name")).alias("item")), "merkle-subroots")
    over, root = rounds(ranked(tops, ["item"]))
    # The root is one row; it comes down beside the path.
    start = root.select("grp", F.lit(0).cast("bigint").alias("rank"), F.array().cast(_PATH).alias("path"), F.struct(F.col("hash").alias("root")).alias("top"))
    groups = descended(over, start)
    above = groups.select(F.col("item.name").alias("grp"), F.lit(0).cast("bigint").alias("rank"), "path", F.struct(F.col("hash").alias("subroot"), F.col("top.root").alias("root")).alias("top"))
    rows = descended(found, stored(above, "merkle-groups"))
    return rows.select("grp", "rank", "hash", "item", "path", "top.subroot", "top.root")


def proof_digest(path: Column) -> Column:
    """One hash of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda node, s: digest(s["left"], node, s["right"]))


def manifest(docs: DataFrame, group: str = "source", id_column: str = "doc_id", fields: Sequence[str] = FIELDS, found: dict[str, Column] | None = None) -> DataFrame:
    """id, group, rank, leaf, subroot, root, path, folded_root, verified for every row.

    The manifest is that of ``docs``. ``found``: columns as they are met later, in place of those of the same name;
    a row is verified if the leaf made of them still leads to the root."""
    now = [(found or {}).get(c, F.col(c)) for c in fields]
    before = [F.col(c) for c in fields]
    leaves = docs.select(
        F.col(group).cast("string").alias("grp"), F.col(id_column).alias("id"), leaf(before).alias("hash"),
        (leaf(now) if found else F.lit(None).cast("string")).alias("met"))
    item = F.struct("id", F.when(F.col("met") != F.col("hash"), F.col("met")).alias("met"))
    leaves = stored(leaves.select("grp", "id", "hash", item.alias("item")), "merkle-leaves")
    rows = proofs(leaves, ["id", "hash"])
    fold = folded(F.coalesce("item.met", "hash"), F.col("path"))
    rows = rows.select(F.col("item.id").alias(id_column), F.col("grp").alias(group), "rank", F.col("hash").alias("leaf"), "subroot", "root", "path", fold.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
