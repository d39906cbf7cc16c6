"""Inputs that registered queries share: landed CSV files and a written lake, both derived from the
whole test tables and kept in the shared folder for the life of the session."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import partial
from threading import Lock

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright.checks.bronze import SQL, TABLES, Lazy, bronze
from claimwright.checks.oracle import AS_OF
from claimwright.contracts import CONTRACTS
from claimwright.plans.lake import run_gold, stage_as, write_built, write_layers
from claimwright.plans.silver import DIMENSIONS, build_claims
from claimwright.session import COMPRESSION, concurrently, input_bytes, remove, shared_dir, small_tasks
from claimwright.sources.registry import Source, default_sources
from claimwright.sources.sinks import GOLD, Layout, read_silver

AT = "2024-07-01T00:00:00+00:00"
ORDERS_PER_FILE = 50_000

_made: dict[tuple, str] = {}
_making: defaultdict[tuple, Lock] = defaultdict(Lock)
_guard = Lock()


def fresh(spark: SparkSession, label: str) -> str:
    return shared_dir(spark, label, uuid.uuid4().hex)


def _fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    """Changes when a table below ``sf_dir`` is replaced; from the listing only."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(sf_dir)
    row = files.agg(
        F.count(F.lit(1)), F.sum("length"), F.max("modificationTime"),
        F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")),
    ).first()
    return tuple(row)


def _once(spark: SparkSession, label: str, sf_dir: str, make: Callable[[str], None]) -> str:
    key = (label, spark.sparkContext.applicationId, sf_dir, _fingerprint(spark, sf_dir))
    with _guard:
        making = _making[key]
    with making:  # one lock for each input: making one may ask for others, also from other threads
        if key not in _made:
            root = fresh(spark, label)
            make(root)
            _made[key] = root
        return _made[key]


def raw(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The Bronze tables, each derived and written once per session, so that queries time themselves and not the
    joins that make their input."""
    small_tasks(spark, input_bytes(spark, *(f"{sf_dir}/{t}.parquet" for t in TABLES)))

    def written(name: str) -> DataFrame:
        derived = bronze(spark, sf_dir)[name]
        make = partial(derived.write.parquet, compression=COMPRESSION)
        return spark.read.schema(derived.schema).parquet(_once(spark, f"raw-{name}", sf_dir, make))

    return Lazy(SQL, written)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV as a source system would write it: empty cells empty, spaces kept, quotes doubled.

    One file per ``drop``, rows in column order, so its bytes can be predicted. The list of files is
    collected, never their rows.
    """
    columns = [c for c in df.columns if c != "drop"]
    drops = sorted(r["drop"] for r in df.select("drop").distinct().collect())
    numbers = pa.table({"drop": drops, "number": pa.array(range(len(drops)), pa.int32())})
    numbered = df.join(df.sparkSession.createDataFrame(numbers), "drop")
    (
        numbered.repartitionById(len(drops), F.col("number")).sortWithinPartitions(*columns).select(*columns).write
        .options(header=True, emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def with_drop(name: str, df: DataFrame) -> DataFrame:
    """Business columns plus the landed file they go to. Claims take one file per source file and
    range of orders, so files are many and bounded; the others one per source file."""
    stem = F.regexp_replace("source_file", r"\.csv$", "")
    if name == "claims":
        order = F.split_part(F.expr("substr(claim_id, 2)"), F.lit("-"), F.lit(1)).cast("bigint")
        stem = F.concat_ws("-", stem, F.floor(order / ORDERS_PER_FILE).cast("string"))
    return df.select(*CONTRACTS[name].business, stem.alias("drop"))


def _write_landing(spark: SparkSession, sf_dir: str, root: str) -> None:
    for name, df in raw(spark, sf_dir).items():
        rows = with_drop(name, df)
        if name != "claims":
            write_csv(rows, f"{root}/{name}/v1")
            continue
        # Files after the first batch carry the added column.
        second = ~F.col("drop").startswith("claims_batch_1")
        write_csv(rows.filter(~second).drop("adjustment_amount"), f"{root}/{name}/v1")
        write_csv(rows.filter(second), f"{root}/{name}/v2")


def landing(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, "landing", sf_dir, lambda root: _write_landing(spark, sf_dir, root))


def sources(spark: SparkSession, sf_dir: str, bronze_root: str) -> dict[str, Source]:
    """The declared sources, reading the landed files and writing below ``bronze_root``."""
    root = landing(spark, sf_dir)
    return {
        name: replace(s.under(root, bronze_root), source_dir=f"{root}/{name}/v*", file_pattern="part-*.csv")
        for name, s in default_sources().items()
    }


def build_lake(spark: SparkSession, sf_dir: str, root: str) -> None:
    layout = Layout(root)
    write_layers(spark, raw(spark, sf_dir), layout, as_of=AS_OF)
    run_gold(spark, layout, views=False)


def _silver_part(spark: SparkSession, sf_dir: str, layout: Layout, name: str) -> None:
    """Silver, quarantine and metrics of one dataset; of claims, from the dimensions that stand."""
    if name != "claims":
        write_layers(spark, raw(spark, sf_dir), layout, [name], AS_OF)
        return
    root = fresh(spark, "checked")
    dims = concurrently(*[lambda d=d: read_silver(spark, part(spark, sf_dir, d), d) for d in DIMENSIONS])
    write_built(spark, build_claims(raw(spark, sf_dir)[name], *dims, stage=stage_as(spark, name, root)), layout)
    remove(root)


def _gold_part(spark: SparkSession, sf_dir: str, layout: Layout, name: str) -> None:
    for needed in GOLD_OF[name]:
        part(spark, sf_dir, needed)
    run_gold(spark, layout, views=False, only=name)


#: The parts that each Gold table is made from.
GOLD_OF = {"dim_member": ["members"], "dim_provider": ["providers"], "fact_claims": ["claims", "dim_member", "dim_provider"]}


def part(spark: SparkSession, sf_dir: str, name: str) -> Layout:
    """The session's lake, in which at least the table ``name`` and those that it is made from stand."""
    layout = Layout(_once(spark, "lake", sf_dir, lambda root: None))
    make = _gold_part if name in GOLD_OF else _silver_part
    _once(spark, f"lake-{name}", sf_dir, lambda root: make(spark, sf_dir, layout, name))
    return layout


def lake(spark: SparkSession, sf_dir: str) -> Layout:
    """Silver, quarantine, metrics and Gold written once per session; queries read the tables."""
    return [part(spark, sf_dir, name) for name in (*CONTRACTS, *GOLD)][0]


def tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """Gold and quarantine tables by name, each made when it is first asked for."""

    def opened(name: str) -> DataFrame:
        if name in GOLD:
            return spark.read.parquet(part(spark, sf_dir, name).gold(name))
        dataset = name.removeprefix("quarantine_")
        return spark.read.parquet(part(spark, sf_dir, dataset).quarantine(dataset))

    return Lazy([*GOLD, *(f"quarantine_{n}" for n in CONTRACTS)], opened)


def silver(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """Silver tables by name, each made when it is first asked for."""
    return Lazy(CONTRACTS, lambda n: read_silver(spark, part(spark, sf_dir, n), n))


def portable(df: DataFrame) -> DataFrame:
    """Types that every engine returns alike: dates as text, decimals as double, arrays joined."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind in ("date", "timestamp"):
            c = c.cast("string")
        elif kind.startswith("decimal"):
            c = c.cast("double")
        elif kind.startswith("array"):
            c = F.concat_ws("; ", c)
        out.append(c.alias(name))
    return df.select(*out)
