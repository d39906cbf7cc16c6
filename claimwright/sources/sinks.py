"""Silver, quarantine, metrics and Gold outputs, and the check that they are all there."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright.contracts import CLAIMS
from claimwright.session import COMPRESSION
from claimwright.sources.key_index import KeyIndex
from claimwright.sources.versions import VersionedTable

DATASETS = ("members", "providers", "diagnoses", "claims")
GOLD = ("dim_member", "dim_provider", "fact_claims")


@dataclass(frozen=True)
class Layout:
    """Where each layer lives below one root."""

    root: str

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def silver_table(self, name: str) -> VersionedTable:
        return VersionedTable(self.silver(name))

    def claim_index(self) -> KeyIndex:
        """Months in which each claim of Silver stands."""
        return KeyIndex(f"{self.root}/silver_index/{CLAIMS.name}", CLAIMS.key, "service_year_month")

    def quarantine(self, name: str) -> str:
        return f"{self.root}/quarantine/{name}"

    def metrics(self, name: str) -> str:
        return f"{self.root}/metrics/latest/{name}"

    def metrics_history(self, name: str) -> str:
        return f"{self.root}/metrics/history/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def artifacts(self) -> dict[str, str]:
        found = {}
        for name in DATASETS:
            found |= {f"bronze/{name}": self.bronze(name), f"silver/{name}": self.silver(name)}
            found |= {f"quarantine/{name}": self.quarantine(name), f"metrics/{name}": self.metrics(name)}
        return found | {f"gold/{name}": self.gold(name) for name in GOLD}


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Overwrite ``path``. Before a partitioned write the rows are rebalanced by the partition
    columns: few files per partition, and AQE still splits one that holds most of the rows."""
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression=COMPRESSION)
    else:
        df.write.mode("overwrite").parquet(path, compression=COMPRESSION)
    return path


def write_silver(df: DataFrame, layout: Layout, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace a Silver table and return it as read back. Readers of the version before are not disturbed. The index of
    claims is that of the table that goes, so it goes first."""
    if name == CLAIMS.name:
        layout.claim_index().forget()
    layout.silver_table(name).replace(df, partition_by)
    return read_silver(df.sparkSession, layout, name)


def read_silver(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """The newest published version of a Silver table."""
    return layout.silver_table(name).read(spark)


def write_quarantine(df: DataFrame, layout: Layout, name: str) -> str:
    return write_table(df, layout.quarantine(name))


def write_metrics(metrics: DataFrame, layout: Layout, name: str) -> str:
    """One-row JSON: appended to the history and replacing the latest."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    row = metrics.withColumns({"dataset": F.lit(name), "generated_at": now}).toArrow()
    one = metrics.sparkSession.createDataFrame(row)
    one.write.mode("append").json(layout.metrics_history(name))
    one.write.mode("overwrite").json(layout.metrics(name))
    return layout.metrics(name)


def read_united(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet folders as one table: columns matched by name, absent ones NULL, partitions kept."""
    return united(*[spark.read.option("mergeSchema", True).parquet(p) for p in paths])


def united(*tables: DataFrame) -> DataFrame:
    """Tables as one: columns matched by name, absent ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def materialise(spark: SparkSession, df: DataFrame, layout: Layout, name: str, view: bool = True) -> DataFrame:
    """Write a Gold table and return it as read back, by default also as a temporary view for SQL."""
    table = spark.read.parquet(write_table(df, layout.gold(name)))
    if view:
        table.createOrReplaceTempView(name)
    return table


def check_outputs(spark: SparkSession, layout: Layout, strict: bool = True) -> DataFrame:
    """(artifact, present, row_count) for every layer. With ``strict``, fail naming what is missing."""
    parts, missing = [], []
    for artifact, path in layout.artifacts().items():
        layer, name = artifact.split("/")
        try:
            if layer == "silver":
                found = read_silver(spark, layout, name)
            else:
                found = spark.read.format("json" if layer == "metrics" else "parquet").load(path)
            rows = found.agg(F.count(F.lit(1)).alias("row_count"))
        except (AnalysisException, FileNotFoundError) as e:
            if isinstance(e, AnalysisException) and e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            missing.append(artifact)
            rows = spark.range(1).select(F.lit(None).cast("bigint").alias("row_count"))
        parts.append(
            rows.select(F.lit(artifact).alias("artifact"), F.lit(artifact not in missing).alias("present"), "row_count")
        )
    if strict and missing:
        raise FileNotFoundError(f"missing outputs: {', '.join(missing)}")
    return reduce(DataFrame.unionByName, parts)
