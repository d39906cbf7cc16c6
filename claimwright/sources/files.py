"""Landed files: listing, content identity, header, and the CSV scan."""

from __future__ import annotations

import csv
import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimwright.session import ship
from claimwright.sources.records import FIELD_LIMIT, NO_LIMIT, Lines, field_limit, file_name, literally, plain, read_records, slices_by_split
from claimwright.sources.registry import Source

LISTING = "path string, source_file string, modified_time string, bytes bigint"
PROFILE = "file_hash string, header array<string>, spanning boolean, error string"


def discover(spark: SparkSession, source: Source) -> DataFrame:
    """Files of a source by name, from the listing alone (no content is read), those of zero bytes as well."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", source.file_pattern).load(source.source_dir)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LISTING)
        raise
    listed = files.select("path", file_name().alias("source_file"), "modificationTime", F.col("length").alias("bytes"))
    modified = F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("modified_time")
    return listed.unionByName(_empty(spark, files)).select("path", "source_file", modified, "bytes").orderBy("source_file")


def _empty(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Files of zero bytes: a scan knows them from its listing, but makes no rows of them. Their status alone is
    asked of the file system, by way of Spark's own, which reaches every store that Spark reads."""
    def plain(uri: Column) -> Column:
        return F.regexp_replace(uri, "^([^:/]+):///", "$1:/")  # an empty authority is written or left out

    uris = spark.createDataFrame(pa.table({"uri": pa.array(files.inputFiles(), pa.string())})).select(plain(F.col("uri")).alias("uri"))
    rest = uris.join(files.select(plain(F.col("_metadata.file_path")).alias("uri")), "uri", "left_anti")
    jvm, conf, rows = spark._jvm, spark._jsc.hadoopConfiguration(), []
    for row in rest.collect():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row["uri"]))
        status = path.getFileSystem(conf).getFileStatus(path)
        rows.append((path.toString(), path.getName(), status.getModificationTime(), status.getLen()))
    found = spark.createDataFrame(rows, "path string, source_file string, at bigint, bytes bigint")
    return found.select("path", "source_file", F.timestamp_millis("at").alias("modificationTime"), "bytes")


def _unsplit(spark: SparkSession) -> SparkSession:
    """A session whose scans give every file a task of its own."""
    own = spark.newSession()
    whole = str(1 << 60)
    for key in ("maxPartitionBytes", "openCostInBytes"):
        own.conf.set(f"spark.sql.files.{key}", whole)
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    return own


class _Hashed:
    """Feeds lines to the CSV reader, and their bytes to the digest as they pass."""

    def __init__(self, lines: Lines, size: int):
        self.lines, self.size, self.seen, self.digest = lines, size, 0, hashlib.sha256()

    def take(self, lines: bytes) -> None:
        self.seen += len(lines)
        # The file may lack the end of its last line.
        self.digest.update(lines[:-1] if self.seen > self.size else lines)

    def __iter__(self) -> Iterator[str]:
        for line in self.lines:
            self.take(line)
            yield line.decode()


def _profile(slices: Iterator[pa.Array], size: int) -> tuple[str, list[str], bool, str | None]:
    """SHA-256 of the bytes, first record, whether a record spans lines, why the file cannot be read.

    Between two records, an array of plain lines is hashed as it is: nothing in it can span lines or fail."""
    lines, header, spanning, error = Lines(slices), None, False, None
    source = _Hashed(lines, size)
    try:
        while True:
            if not lines.left:
                taken = lines.take()
                if taken is None:
                    break
                whole = plain(taken, FIELD_LIMIT)
                if whole is not None:
                    source.take(whole)
                    header = (taken[0].decode().split(",") if taken[0] else []) if header is None else header
                    continue
                lines.feed(taken)
            reader, before = csv.reader(source), 0
            for row in reader:
                header = row if header is None else header
                spanning = spanning or reader.line_num > before + 1
                before = reader.line_num
                if not lines.left:
                    break
    except (csv.Error, UnicodeDecodeError) as e:
        error = f"{type(e).__name__}: {e}"
        for line in lines:
            source.take(line)
    return source.digest.hexdigest(), header or [], spanning, error


def profile(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """The listed files with ``file_hash``, ``header``, ``spanning`` (a quoted field holds a line break) and
    ``error`` (why the content cannot be read, else null).

    The hash is the SHA-256 of a file's bytes, whatever its size: it cannot be split, so a file is streamed by one
    task, in little memory, and files are read side by side. The same pass reads every record once, so that a
    file that cannot be parsed or decoded, or has a field above the ``csv`` module's limit, is known before anything
    is landed.
    """
    paths = [r["path"] for r in listing.select("path").collect()]  # of the files to be read: the scan's own list
    if not paths:
        return listing.selectExpr("*", *(f"cast(null as {f.split()[1]}) as {f.split()[0]}" for f in PROFILE.split(", ")))
    ship(spark)
    text = _unsplit(spark).read.option("lineSep", "\n").text(literally(paths))
    lines = text.select(F.col("value").cast("binary").alias("line"), file_name().alias("source_file"), F.col("_metadata.file_size").alias("split"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, size), content in slices_by_split(batches):
            with field_limit(FIELD_LIMIT):
                file_hash, header, spanning, error = _profile(content, size)
            yield pa.RecordBatch.from_pydict({
                "source_file": [file], "file_hash": [file_hash], "header": pa.array([header], pa.list_(pa.string())), "spanning": [spanning],
                "error": pa.array([error], pa.string())})

    found = lines.mapInArrow(run, f"source_file string, {PROFILE}")
    empty = {"file_hash": F.lit(hashlib.sha256().hexdigest()), "header": F.array().cast("array<string>"), "spanning": F.lit(False)}
    return listing.join(found, "source_file", "left").select(*listing.columns, *(F.coalesce(c, v).alias(c) for c, v in empty.items()), "error")


def read_csv(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], multiline: bool = True, limit: int = NO_LIMIT) -> DataFrame:
    """CSV files that share one header, every value a string, plus ``source_file``; read in splits.

    ``multiline=False`` says that no quoted field holds a line break, which saves a look at all lines. ``limit`` is the
    longest field in characters; landed files are held to the one that they were profiled with.
    """
    ship(spark)
    return read_records(spark, paths, columns, spanning=multiline, limit=limit)
