"""Operator 10: mixing sources to target weights by Pareto order sampling.

Targets. Sources share ``share`` of all sizes by weight; no target exceeds ``most`` times its source's size, and
what is above is shared again by weight among the others (the water level of that process, in closed form).

Sample. A document's inclusion is target / size of its source, times its relative priority where a priority
column is given. Its whole part is certain copies; the fractional part is an inclusion probability p. With
u drawn from a hash of the id, the documents of a source are ranked by (u / (1 - u)) / (p / (1 - p)), random odds
over inclusion odds, and taken in that order: a sample of fixed size, in words. The prefix that fits is
taken, then the one further document that comes nearest to the words still missing.

Scale. No source is sorted as a whole. The rank is mapped to [0, 1) and cut into 4,096 bins per source, summed in
every task before the shuffle; the bin in which the target falls is cut again, until it holds few rows. Only
those rows are ordered. What is joined back to the documents is one row per source.

Null and empty texts have size 0 and take 0 words. A null source is a source of its own, after the others.
Rows that repeat an id share its draw. Those that repeat the text as well are one row with their number until the
end; if the target falls among them, as many of them are taken as fit, so a tied group comes as near its target as
single rows do, and a hot one is never ordered. Documents of an empty source, or of one with weight 0, take
nothing. Texts are read whole, whatever their length; of other columns those named like the module's own do no harm.
Reruns agree: nothing random but the hash. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimwright.llm.common import WORD, carried, stored

BINS = 4096
#: Rows that one task makes of a row with a number.
EXPAND = 10_000
_DRAW_BITS = 52
#: Words of all rows of a group.
_WORDS = "size * number"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float], share: float = 1.0, most: float = 3.0) -> DataFrame:
    """source, source_size, target from (source, size) rows. One row per source from here on."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, [float(w) for w in weights])), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    sources = sources.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(most)).alias("cap"))
    # Filled sources are those with the smallest cap per weight. Before each source, what the filled ones
    # take and the weight still open; the level is the first at which that source is not filled.
    rank = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    so_far, rest = rank.rowsBetween(Window.unboundedPreceding, -1), rank.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    ahead = sources.select(
        "*", ((total * F.lit(share) - F.coalesce(F.sum("cap").over(so_far), F.lit(0.0))) / F.sum("weight").over(rest)).alias("level"),
    )
    # To fill a source that fits never raises the level, so the largest level that fits is the level.
    level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(Window.partitionBy())
    fitted = ahead.withColumn("at", level)
    return fitted.select("source", "source_size", F.least("cap", F.coalesce(F.col("at") * F.col("weight"), F.col("cap"))).alias("target"))


def draw(*parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of MD5 of the parts, so that other engines draw the same."""
    digits = F.substring(F.md5(F.concat_ws("/", *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + F.lit(0.5)) / F.lit(float(1 << _DRAW_BITS))


def _cut(rows: DataFrame, few: int) -> DataFrame:
    """The words that fit and the place of the first group that does not fit whole: (source, fits, at_rank, at_id, at_mark,
    at_taken). at_taken: how many of its rows do.

    rows: source, size, number, rank in [0, 1), doc_id, mark, wanted (words of the fraction). ``few``: groups of a source
    that may be ordered in one task.
    """
    by_source, level = F.col("source"), 0
    pool = rows.withColumn("before", F.lit(0).cast("bigint"))
    while True:
        level += 1
        bin_of = F.floor(F.col("rank") * F.lit(float(BINS**level))).cast("bigint")
        bins = pool.groupBy("source", "wanted", "before", bin_of.alias("bin")).agg(F.sum(F.expr(_WORDS)).alias("size"), F.count(F.lit(1)).alias("rows"))
        running = Window.partitionBy("source").orderBy("bin")  # BINS rows per source at most
        bins = bins.withColumn("upto", F.col("before") + F.sum("size").over(running))
        cut = bins.filter(F.col("upto") > F.col("wanted")).withColumn("_n", F.row_number().over(running)).filter("_n = 1")
        cut = stored(cut.select("source", "bin", "rows", (F.col("upto") - F.col("size")).alias("cut_before")), "cut")
        at = cut.select(by_source.alias("_source"), F.col("bin").alias("_bin"), "cut_before")
        pool = pool.join(at, by_source.eqNullSafe(F.col("_source")) & (bin_of == F.col("_bin")))
        pool = pool.drop("before", "_source", "_bin").withColumnRenamed("cut_before", "before")
        if level == 4 or (cut.agg(F.max("rows")).first()[0] or 0) <= few:
            break
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "mark")
    upto = pool.withColumn("upto", F.col("before") + F.sum(F.expr(_WORDS)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    first = upto.filter(F.col("upto") > F.col("wanted")).withColumn("_n", F.row_number().over(order)).filter("_n = 1")
    before = F.col("upto") - F.expr(_WORDS)
    whole = F.floor(F.greatest(F.col("wanted") - before, F.lit(0.0)) / F.nullif(F.col("size"), F.lit(0))).cast("bigint")
    whole = F.coalesce(whole, F.lit(0).cast("bigint"))
    return first.select("source", (before + whole * F.col("size")).alias("fits"), F.col("rank").alias("at_rank"),
                        F.col("doc_id").alias("at_id"), F.col("mark").alias("at_mark"), whole.alias("at_taken"))


def _each(groups: DataFrame, number: Column) -> DataFrame:
    """Every row as often as ``number`` says; a large number is dealt over tasks first."""
    counted = groups.withColumn("_number", number)
    one = counted.filter(F.col("_number") <= EXPAND).withColumn("_i", F.explode(F.expr("sequence(1, cast(_number as int))")))
    many = counted.filter(F.col("_number") > EXPAND).withColumn("_part", F.explode(F.expr(f"sequence(0, cast((_number - 1) div {EXPAND} as int))")))
    many = many.repartition("_part").withColumn("_i", F.explode(F.expr(f"sequence(1, cast(least({EXPAND}, _number - _part * {EXPAND}) as int))"))).drop("_part")
    return one.unionByName(many).drop("_number", "_i")


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, mark, source, size, source_size, target, taken (words, repeats counted), copies of every row."""
    groups = mixed_groups(docs, **settings)
    # More of a group's rows have a further copy, or less, by one decision per group.
    kinds = [groups.withColumn("copies", F.col("certain") + more).withColumn("_of", n) for more, n in ((1, F.col("further")), (0, F.col("number") - F.col("further")))]
    rows = _each(kinds[0].unionByName(kinds[1]).filter("_of > 0"), F.col("_of"))
    return rows.select("doc_id", "mark", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed_groups(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.0, most: float = 3.0,
                 priority: Column | None = None, seed: str = "mix", few: int = 50_000) -> DataFrame:
    """Rows of equal doc_id, mark (hash of the text), source and priority as one row with their ``number``: size, source_size,
    target, ``certain`` copies of each, and of how many a ``further`` one is taken."""
    sized = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.col("source").cast("string").alias("source"),
                        words(F.col("text")).alias("size"), (F.lit(1.0) if priority is None else priority.cast("double")).alias("priority"))
    sized = sized.groupBy("doc_id", "mark", "source", "size", "priority").agg(F.count(F.lit(1)).alias("number"))
    sized = stored(sized, "sizes")
    goal = targets(sized.select("source", F.expr(_WORDS).alias("size")), weights, share, most)
    if priority is None:
        per_source = goal.withColumn("mean", F.lit(1.0))
    else:
        mean = sized.groupBy(F.col("source").alias("_s")).agg((F.sum(F.col("priority") * F.expr(_WORDS)) / F.sum(F.expr(_WORDS))).alias("mean"))
        per_source = goal.join(mean, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    per_source = stored(per_source.withColumnRenamed("source", "_source"), "targets")
    rows = sized.join(per_source, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    inclusion = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * (F.col("priority") / F.col("mean")))
    rows = rows.withColumn("inclusion", F.least(F.coalesce(inclusion, F.lit(0.0)), F.lit(float(most))))
    rows = rows.withColumn("certain", F.floor("inclusion").cast("bigint")).withColumn("p", F.col("inclusion") - F.col("certain"))
    u = draw(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    odds = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
    rows = rows.withColumn("rank", F.when(F.col("p") > 0, odds / (1 + odds)))
    certain = rows.groupBy(F.col("source").alias("_source")).agg(F.sum(F.col("certain") * F.expr(_WORDS)).alias("sure"), F.first("target").alias("_target"))
    wanted = stored(certain.select("_source", (F.col("_target") - F.col("sure")).alias("wanted")), "wanted")
    rows = rows.join(wanted, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    pool = rows.filter("rank is not null").select("source", "size", "number", "rank", "doc_id", "mark", "wanted")
    cut = stored(_cut(pool, few).withColumnRenamed("source", "_source"), "cuts")
    rows = rows.join(cut, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    place = F.struct(F.col("rank"), F.col("doc_id"), F.col("mark"))
    ahead = F.col("at_rank").isNull() | (place < F.struct(F.col("at_rank"), F.col("at_id"), F.col("at_mark")))
    at = (F.col("rank") == F.col("at_rank")) & F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("mark") == F.col("at_mark"))
    fitting = F.when(F.col("rank").isNull(), 0).when(F.coalesce(at, F.lit(False)), F.col("at_taken")).when(ahead, F.col("number")).otherwise(0)
    rows = rows.withColumn("sampled", fitting.cast("bigint"))
    # The words still missing: the one document of the rest that comes nearest, if that is nearer than none.
    missing = F.col("wanted") - F.col("fits")
    gap = F.abs(F.col("size") - missing)
    rest = rows.filter("rank is not null and sampled < number and at_rank is not null").filter(gap < missing)
    nearest = rest.groupBy(F.col("source").alias("_source")).agg(F.min(F.struct(gap.alias("gap"), "rank", "doc_id", "mark")).alias("x"))
    closing = stored(nearest.select("_source", F.col("x.rank").alias("_rank"), F.col("x.doc_id").alias("_id"), F.col("x.mark").alias("_mark")), "closing")
    rows = rows.join(closing, F.col("source").eqNullSafe(F.col("_source")), "left")
    closes = (F.col("rank") == F.col("_rank")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    further = F.col("sampled") + F.coalesce(closes, F.lit(False)).cast("bigint")
    return rows.select("doc_id", "mark", "source", "priority", "number", "size", "source_size", "target", "certain", further.alias("further"))


def repeated(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: every document as often as it was taken, with all its columns.

    Where some rows of a group have a further copy and some not, rows that are alike in all columns are counted, and
    the first ones in order of their hash have it."""
    names = {"doc_id": "i", "mark": "m", "source": "s", "priority": "w"}
    groups = mixed_groups(docs, **settings).select(*(F.col(c).alias(a) for c, a in names.items()), "number", "certain", "further")
    groups = stored(groups, "mixed")
    priority = settings.get("priority")
    rows = carried(docs, "doc_id", F.xxhash64("text").alias("mark"), F.col("source").cast("string").alias("source"),
                   (F.lit(1.0) if priority is None else priority.cast("double")).alias("priority"))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(a)) for c, a in names.items()))
    split = (F.col("further") > 0) & (F.col("further") < F.col("number"))
    taken = groups.filter(~split).withColumn("copies", F.col("certain") + (F.col("further") > 0).cast("bigint")).filter("copies > 0")
    each = _each(rows.join(taken, same).select("whole_row", "copies"), F.col("copies")).select("whole_row.*")
    # One group per source at most, the one at its cut.
    cut = groups.filter(split)
    if cut.isEmpty():
        return each
    alike = rows.join(cut, same).groupBy("whole_row", *names.values(), "certain", "further").agg(F.count(F.lit(1)).alias("alike"))
    order = Window.partitionBy(*names.values()).orderBy(F.xxhash64("whole_row"), "whole_row")
    before = F.sum("alike").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("alike")
    first = F.greatest(F.lit(0), F.least(F.col("alike"), F.col("further") - before))
    some = alike.withColumn("copies", F.col("certain") * F.col("alike") + first).filter("copies > 0")
    return each.unionByName(_each(some.select("whole_row", "copies"), F.col("copies")).select("whole_row.*"))
