"""CSV records of files that are read in splits, whatever lies in their quoted fields.

One parser for every file: Python's ``csv`` module with its defaults. A quote opens a field only at the field's
begin, a doubled quote is one, line breaks in quotes stay as they are, and an unclosed quote runs to the end of the
file. How long a field may be is up to the caller: records have no limit of their own unless one is named.

A split may begin inside a quoted field. So the splits of files that have such fields are looked at first: where
does a split end, if it begins outside of quotes, and if it begins inside? Put together in order of the splits
that says how each begins. Then every split is parsed on its own; the lines of a record that runs over its
borders are passed on as pieces, none longer than its split, and put together.

Lines come in Arrow batches. Those of a batch without any quote or carriage return are records as they are: they are cut at
their commas all at once, and never become Python objects one by one. Anything else goes through the parser.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from itertools import groupby

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv as arrow_csv
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

_GLOB = re.compile(r"([\\{}\[\]*?])")
_LINE_ENDS = re.compile(rb"(?<=\r)(?!\n)")
#: Characters of a field: the ``csv`` module's own limit, and more than any cell of Spark holds.
FIELD_LIMIT, NO_LIMIT = 131_072, (1 << 31) - 1
#: Characters of the rows that are handed on at once, beside the row that passes them.
_AT_ONCE = 1 << 24


@contextmanager
def field_limit(limit: int) -> Iterator[None]:
    """The ``csv`` module's limit in this process, which later tasks may share."""
    before = csv.field_size_limit(limit)
    try:
        yield
    finally:
        csv.field_size_limit(before)


def literally(paths: Sequence[str]) -> list[str]:
    """Paths as they are, for readers that expand patterns."""
    return [_GLOB.sub(r"\\\1", p) for p in paths]


def file_name() -> Column:
    """The file's own name; Spark reports it as part of a URI. A plus sign is itself there."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def physical_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Bytes of every line with its file and the split it begins in, in file order within a split."""
    lines = spark.read.option("lineSep", "\n").text(literally(paths))
    return lines.select(F.col("value").cast("binary").alias("line"), file_name().alias("source_file"), F.col("_metadata.file_block_start").alias("split"))


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a line that begins inside or outside of quotes ends inside."""
    at, size = 0, len(line)
    while True:
        if not inside:
            # At the begin of a field; quotes elsewhere in a field that did not begin with one mean nothing.
            if at < size and line[at] == 34:
                inside, at = True, at + 1
                continue
        else:
            closing = line.find(b'"', at)
            if closing < 0:
                return True
            if line[closing + 1 : closing + 2] == b'"':
                at = closing + 2
                continue
            inside, at = False, closing + 1
        comma = line.find(b",", at)
        if comma < 0:
            return False
        at = comma + 1


def lines_by_split(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[bytes]]]:
    """(file, split) and its lines with their ends; a carriage return alone ends a line as well. A last line that
    has no end gets one."""

    def rows():
        for batch in batches:
            for line, file, split in zip(*(batch.column(c).to_pylist() for c in ("line", "source_file", "split"))):
                if b"\r" in line:
                    for part in _LINE_ENDS.split(line + b"\n"):
                        yield (file, split), part
                else:
                    yield (file, split), line + b"\n"

    for key, group in groupby(rows(), key=lambda r: r[0]):
        yield key, (line for _, line in group)


def slices_by_split(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[pa.Array]]]:
    """(file, split) and its lines, without their ends, in arrays of at most a batch."""

    def slices():
        for batch in batches:
            files, splits, begin = batch.column("source_file"), batch.column("split"), 0
            for end in sorted({e for c in (files, splits) for e in pc.run_end_encode(c).run_ends.to_pylist()}):
                yield (files[begin].as_py(), splits[begin].as_py()), batch.column("line").slice(begin, end - begin)
                begin = end

    for key, group in groupby(slices(), key=lambda s: s[0]):
        yield key, (lines for _, lines in group)


def plain(lines: list[bytes], limit: int) -> bytes | None:
    """The lines with their ends if each of them is a record that a comma cuts, in UTF-8 and with no field above ``limit``."""
    whole = b"\n".join(lines) + b"\n"
    if b'"' in whole or b"\r" in whole or len(whole) > limit and max(map(len, lines)) > limit:
        return None
    try:
        whole.decode()
    except UnicodeDecodeError:
        return None
    return whole


class Lines:
    """Lines with their ends, as the parser wants them, of arrays that are taken up one after another. ``left``: lines
    of the present array that were not handed out. A carriage return alone ends a line as well."""

    def __init__(self, slices: Iterator[pa.Array]):
        self.slices, self.ready, self.left = slices, iter(()), 0

    def take(self) -> list[bytes] | None:
        """The next array's lines, in place of the present one's; none at the end."""
        for lines in self.slices:
            return lines.to_pylist()
        return None

    def feed(self, lines: list[bytes]) -> None:
        ended = [part for line in lines for part in (_LINE_ENDS.split(line + b"\n") if b"\r" in line else (line + b"\n",))]
        self.ready, self.left = iter(ended), len(ended)

    def __iter__(self) -> Iterator[bytes]:
        while True:
            if not self.left:
                lines = self.take()
                if lines is None:
                    return
                self.feed(lines)
            self.left -= 1
            yield next(self.ready)


def _begins(spark: SparkSession, lines: DataFrame) -> set[tuple[str, int]]:
    """The splits that begin inside a quoted field: one entry for each, never lines."""

    def ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, split), part in lines_by_split(batches):
            from_outside, from_inside = False, True
            for line in part:
                if b'"' in line:
                    from_outside, from_inside = ends_inside(line, from_outside), ends_inside(line, from_inside)
            yield pa.RecordBatch.from_pydict({"source_file": [file], "split": [split], "outside": [from_outside], "inside": [from_inside]})

    def begin(group: pa.Table) -> pa.Table:
        inside, found = False, []
        for row in group.sort_by("split").to_pylist():
            if inside:
                found.append(row)
            inside = row["inside"] if inside else row["outside"]
        return pa.Table.from_pylist([{"source_file": r["source_file"], "split": r["split"]} for r in found], pa.schema([("source_file", pa.string()), ("split", pa.int64())]))

    ended = lines.mapInArrow(ends, "source_file string, split bigint, outside boolean, inside boolean")
    found = ended.groupBy("source_file").applyInArrow(begin, "source_file string, split bigint")
    return {(r["source_file"], r["split"]) for r in found.collect()}


def _cells(rows: list[list[str]], width: int) -> list[pa.Array]:
    """Columns of the rows: a cell that a short row lacks is empty, cells beyond the header are left out."""
    return [pa.array([r[k] if k < len(r) else "" for r in rows], pa.string()) for k in range(width)]


def _cut(whole: bytes, width: int, header: bool) -> pa.Table | None:
    """The cells of plain lines, all at once; none where a line has not just ``width`` of them."""
    if whole.startswith(b"\xef\xbb\xbf"):  # it would be taken for a mark
        return None
    cells = [f"c{k}" for k in range(width)]
    try:
        return arrow_csv.read_csv(
            pa.BufferReader(whole),
            read_options=arrow_csv.ReadOptions(use_threads=False, block_size=len(whole) + 1, column_names=cells, skip_rows=int(header)),
            parse_options=arrow_csv.ParseOptions(quote_char=False, double_quote=False, escape_char=False),
            convert_options=arrow_csv.ConvertOptions(column_types=dict.fromkeys(cells, pa.string()), strings_can_be_null=False),
        )
    except pa.ArrowInvalid:
        return None


def _parsed(batches: Iterable[pa.RecordBatch], width: int, inside: set[tuple[str, int]], rows_at_once: int = 5000, limit: int = NO_LIMIT) -> Iterator[pa.RecordBatch]:
    names = [*(f"c{k}" for k in range(width)), "source_file", "split", "part", "piece"]

    def filled(columns, n, file):
        return pa.RecordBatch.from_arrays([*columns, pa.array([file] * n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)

    def out(rows, file):
        return filled(_cells(rows, width), len(rows), file)

    def piece(key, part, lines):
        return pa.RecordBatch.from_arrays(
            [*(pa.nulls(1, pa.string()) for _ in range(width)), pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([part], pa.int32()), pa.array([b"".join(lines)])], names=names)

    for key, slices in slices_by_split(batches):
        lines, held = Lines(slices), []
        state = key in inside
        if state:
            for line in lines:
                held.append(line)
                if b'"' in line and not ends_inside(line, True):
                    state = False
                    break
            yield piece(key, 0, held)
            if state:
                continue
            held = []

        def fed():
            nonlocal state
            for line in lines:
                if b'"' in line:
                    state = ends_inside(line, state)
                held.append(line)
                yield line.decode()

        rows: list[list[str]] = []
        size, first = 0, key[1] == 0
        while True:
            if not lines.left:  # between two records
                taken = lines.take()
                if taken is None:
                    break
                whole = plain(taken, limit)
                cut = None if whole is None else _cut(whole, width, first)
                if cut is not None:
                    first = False
                    for batch in cut.to_batches():
                        yield filled(batch.columns, batch.num_rows, key[0])
                    continue
                lines.feed(taken)
            for row in csv.reader(fed()):
                if state:
                    break  # the lines ended within quotes: the record goes on in the next split
                held.clear()
                if first:
                    first = False
                elif row:
                    rows.append(row)
                    size += sum(map(len, row))
                if len(rows) >= rows_at_once or size >= _AT_ONCE:
                    yield out(rows, key[0])
                    rows, size = [], 0
                if not lines.left:
                    break
            if state:
                break
        if rows:
            yield out(rows, key[0])
        if held:
            yield piece(key, 1, held)


def read_records(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], spanning: bool = True, limit: int = NO_LIMIT) -> DataFrame:
    """Every record but the headers of files that share one: all cells as strings, plus ``source_file``.

    ``spanning``: whether quoted fields may hold line breaks. Files known to have none need no look ahead.
    ``limit``: characters of a field above which the read fails, wherever the splits are.
    """
    width = len(columns)
    lines = physical_lines(spark, paths)
    inside = _begins(spark, lines) if spanning else set()
    cells = [f"c{k}" for k in range(width)]
    schema = ", ".join([*(f"{c} string" for c in cells), "source_file string", "split bigint", "part int", "piece binary"])

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with field_limit(limit):
            yield from _parsed(batches, width, inside, limit=limit)

    parsed = lines.mapInArrow(parse, schema)
    named = [F.col(c).alias(name) for c, name in zip(cells, columns)] + [F.col("source_file")]
    whole = parsed.filter("piece is null").select(*named)
    if not spanning:
        return whole

    # Part 1 of a split begins a record; part 0 of the splits after it belong to the same one.
    pieces = parsed.filter("piece is not null").select("source_file", "split", "part", "piece")
    order = Window.partitionBy("source_file").orderBy("split", "part")
    numbered = pieces.withColumn("record", F.sum("part").over(order))
    joined = numbered.groupBy("source_file", "record").agg(F.sort_array(F.collect_list(F.struct("split", "part", "piece"))).alias("p"))
    texts = joined.select("source_file", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["piece"])).alias("record"))

    def put_together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows, files):
            return pa.RecordBatch.from_arrays([*_cells(rows, width), pa.array(files, pa.string())], names=[*cells, "source_file"])

        with field_limit(limit):
            for batch in batches:
                rows, files, size = [], [], 0
                for file, record in zip(batch.column("source_file").to_pylist(), batch.column("record").to_pylist()):
                    for row in csv.reader(io.StringIO(record.decode(), newline="")):
                        rows.append(row)
                        files.append(file)
                    size += len(record)
                    if size >= _AT_ONCE:
                        yield out(rows, files)
                        rows, files, size = [], [], 0
                yield out(rows, files)

    stitched = texts.mapInArrow(put_together, ", ".join([*(f"{c} string" for c in cells), "source_file string"]))
    return whole.unionByName(stitched.select(*named))
