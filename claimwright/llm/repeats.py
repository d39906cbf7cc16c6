"""Operator 12: substring dedup by Rabin-Karp hashes of every window of words.

Every run of ``window`` words of a document gets a Rabin-Karp hash: a polynomial of its words' digests, rolled over the
text by prefix sums, of 88 bits from two polynomials modulo 2 ** 64 (two different windows share one with odds
of some 10 ** -26). Of the windows with one hash, those that start at the least (doc_id, start) stay; the others
are repeats. Removal intervals are the unions of repeats, as long as they go.

1. hash    a task takes a block of whole texts (``BLOCK`` bytes), hashes all windows and settles those that repeat
           within the block, so that a hash that is everywhere is one entry per block.
2. count   entries are dealt by ranges of the hash, packed into arrays; the task of a range counts each hash, finds the
           first place, and answers every block with the entries that lost. Ranges hold ``RANGE`` bytes of text each.
3. merge   the answers of a block, with what it settled itself, become maximal intervals per document.
4. cut     intervals meet the documents by id and text; only here do texts travel, compressed, and only if the
           intervals are too many to be broadcast.

A block's number comes from its contents, so a task that is run again answers to the same number; an answer to a
block that is not there is an error, not a loss.

Null and empty texts have no words; texts shorter than a window stay whole. A text longer than a block is a block of its
own: a task holds the longest text. Rows that share a doc_id are one document in this respect: of two windows at one
place of it neither is earlier, so repeated rows keep the same words. A null doc_id stands behind all others.
Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_128_intdigest, xxh64_intdigest
from zstandard import ZstdCompressor, ZstdDecompressor

from claimwright.llm.common import map_batches

WINDOW = 20
BLOCK, RANGE = 6 << 20, 12 << 20
MOST_TASKS = 20_000
LAST = (1 << 63) - 1
#: Bytes kept of the second polynomial.
CHECK = 3
#: Odd multipliers of the two polynomials (the golden ratio's digits, and the square root of two's).
BASES = (0x9E3779B97F4A7C15, 0x6A09E667F3BCC909)
_MASK = (1 << 64) - 1

_PACKED = "range bigint, block bigint, hashes binary, checks binary, docs binary, bases binary, places binary"
_ANSWER = "block bigint, docs binary, keys binary, ends binary, lost binary, twins binary, places binary"


def pack(a: np.ndarray) -> bytes:
    """Differences of whole numbers, small ones of either sign as small numbers, byte by byte over all of them, then
    compressed. The last 8 bytes tell how many."""
    steps = np.diff(np.ascontiguousarray(a, dtype=np.int64), prepend=np.int64(0))
    plain = ((steps << 1) ^ (steps >> 63)).view(np.uint64)
    width = (int(plain.max(initial=0)).bit_length() + 7) // 8
    planes = np.ascontiguousarray(plain.view(np.uint8).reshape(-1, 8).T[:width])
    return ZstdCompressor(level=1).compress(planes.tobytes()) + len(plain).to_bytes(8, "little")


def unpack(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[-8:], "little")
    planes = np.zeros((8, n), dtype=np.uint8)
    held = np.frombuffer(ZstdDecompressor().decompress(b[:-8]), np.uint8)
    planes[: len(held) // max(n, 1)] = held.reshape(-1, n) if n else 0
    plain = np.ascontiguousarray(planes.T).view(np.uint64).ravel()
    return np.cumsum((plain >> np.uint64(1)).view(np.int64) ^ -(plain & np.uint64(1)).view(np.int64))


class Digests(dict):
    """Word to its place in two lists of 64-bit digests; kept between blocks, up to a bound."""

    def __init__(self, entries: int = 500_000):
        super().__init__()
        self.entries, self.halves = entries, (array("Q"), array("Q"))

    def __missing__(self, word: bytes) -> int:
        digest = xxh3_128_intdigest(word)
        self.halves[0].append(digest & _MASK)
        self.halves[1].append(digest >> 64)
        place = self[word] = len(self)
        return place

    def of(self, words: list[bytes]) -> list[np.ndarray]:
        if len(self) > self.entries:
            self.clear()
            self.halves = (array("Q"), array("Q"))
        places = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return [np.array(half, dtype=np.uint64)[places] for half in self.halves]


def rolled(digests: np.ndarray, base: int, window: int) -> np.ndarray:
    """sum(digest[i + k] * base ** k for k < window) modulo 2 ** 64, for every place i that has a whole window."""
    n = len(digests)
    if n < window:
        return np.zeros(0, dtype=np.uint64)

    def powers(b: int, count: int) -> np.ndarray:
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(count - 1, b, np.uint64)]), dtype=np.uint64)

    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(digests * powers(base, n), dtype=np.uint64)])
    return (sums[window:] - sums[:-window]) * powers(pow(base, -1, 1 << 64), n - window + 1)


def groups_of(hashes: np.ndarray, checks: np.ndarray, *order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries whose hash occurs more than once, sorted by hash and then by ``order``, and the first one of each's group."""
    by_hash = np.argsort(hashes)
    same = hashes[by_hash][1:] == hashes[by_hash][:-1]
    again = by_hash[np.concatenate([[False], same]) | np.concatenate([same, [False]])] if len(same) else by_hash[:0]
    again = again[np.lexsort((*(o[again] for o in reversed(order)), checks[again], hashes[again]))]
    new = np.ones(len(again), dtype=bool)
    new[1:] = (hashes[again][1:] != hashes[again][:-1]) | (checks[again][1:] != checks[again][:-1])
    return again, again[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(again) else again


def blocks(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with at most ``size`` bytes of text, or one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _named(texts: pa.RecordBatch, digests: Digests, window: int):
    """Ids, keys and ends of a block's different texts of a window and more, in order, and the digests of their words."""
    rows = {}
    for doc, key, text in zip(*(texts.column(c).to_pylist() for c in ("doc_id", "key", "text"))):
        doc = LAST if doc is None else doc
        if (doc, key) not in rows and len(words := text.split()) >= window:
            rows[doc, key] = words
    if not rows:
        return None
    named = sorted(rows)
    docs, keys = (np.array(c, dtype=np.int64) for c in zip(*named))
    ends = np.cumsum([len(rows[r]) for r in named])
    return docs, keys, ends, digests.of([word for r in named for word in rows.pop(r)])


def _hashed(texts: pa.RecordBatch, digests: Digests, window: int, ranges: int, part: int, alone: bool) -> Iterator[pa.RecordBatch]:
    """The packed entries of a block, by range, and the row that tells what its places mean."""
    if (found := _named(texts, digests, window)) is None:
        return
    docs, keys, ends, halves = found
    number = xxh64_intdigest(docs.tobytes() + keys.tobytes(), part) - (1 << 63)

    row_of = np.repeat(np.arange(len(docs)), np.diff(ends, prepend=0))
    place = np.flatnonzero(np.arange(ends[-1]) + window <= ends[row_of])
    start = place - (ends - np.diff(ends, prepend=0))[row_of[place]]
    doc = docs[row_of[place]]
    hashes, checks = (rolled(half, base, window)[place] for half, base in zip(halves, BASES))
    checks >>= np.uint64(64 - 8 * CHECK)

    # Places ascend by (doc, start). Two rows of one doc may meet at one place of it: neither is earlier.
    again, first = groups_of(hashes, checks, place)
    tied = (doc[again] == doc[first]) & (start[again] == start[first])
    twin = tied & (again != first)
    stays = np.ones(len(place), dtype=bool)
    stays[again[again != first]] = False
    twins = np.concatenate([place[first[twin]], place[again[twin]]])
    lost = np.sort(place[again[~tied]])

    # The row of the block itself goes through any range.
    home = (number % ranges) & _MASK
    yield pa.RecordBatch.from_pydict({
        "range": [home], "block": [number], "hashes": [None], "checks": [pack(lost)], "docs": [pack(docs)], "bases": [keys.tobytes()],
        "places": [_joined(pack(ends), pack(twins))]}, schema=_schema(_PACKED))
    in_range = (((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)
    order = np.flatnonzero(stays)
    order = order[np.argsort(in_range[order], kind="stable")]
    cuts = np.flatnonzero(np.diff(in_range[order], prepend=-1))
    out = {c: [] for c in ("range", "block", "hashes", "checks", "docs", "bases", "places")}
    for entry in np.split(order, cuts[1:]) if len(order) else []:
        for name, value in zip(out, (
                int(in_range[entry[0]]), number, hashes[entry].view(np.uint8).reshape(-1, 8)[:, : _sent(ranges)].tobytes(), checks[entry].view(np.uint8).reshape(-1, 8)[:, :CHECK].tobytes(), pack(doc[entry]), None if alone else pack((place - start)[entry]), pack(place[entry]))):
            out[name].append(value)
    if out["range"]:
        yield pa.RecordBatch.from_pydict(out, schema=_schema(_PACKED))


def _sent(ranges: int) -> int:
    """Low bytes of a hash that its range does not tell."""
    return 8 - (ranges.bit_length() - 1) // 8


def _whole(parts: list[bytes], width: int, kind) -> np.ndarray:
    """Numbers of ``width`` bytes each as numpy's."""
    held = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, width)
    out = np.zeros((len(held), np.dtype(kind).itemsize), dtype=np.uint8)
    out[:, :width] = held
    return out.view(kind).ravel()


def _joined(a: bytes, b: bytes) -> bytes:
    return len(a).to_bytes(8, "little") + a + b


def _parted(both: bytes) -> tuple[bytes, bytes]:
    n = 8 + int.from_bytes(both[:8], "little")
    return both[8:n], both[n:]


def _schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _settled(entries: list[dict], width: int) -> Iterator[dict]:
    """Per block, the places of a range's entries that are not the first of their hash."""
    hashes, checks = _whole([r["hashes"] for r in entries], width, np.uint64), _whole([r["checks"] for r in entries], CHECK, np.uint32)
    docs = np.concatenate([unpack(r["docs"]) for r in entries])
    starts = np.concatenate([unpack(r["places"]) - (unpack(r["bases"]) if r["bases"] is not None else 0) for r in entries])
    again, first = groups_of(hashes, checks, docs, starts)
    lost = np.sort(again[(docs[again] != docs[first]) | (starts[again] != starts[first])])
    sizes = np.cumsum([len(r["hashes"]) // width for r in entries])
    for r, begin, end in zip(entries, np.concatenate([[0], sizes[:-1]]), sizes):
        mine = lost[np.searchsorted(lost, begin): np.searchsorted(lost, end)] - begin
        if len(mine):
            yield {"block": r["block"], "places": pack(unpack(r["places"])[mine])}


def _counted(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """One range after another, in the order of the rows."""
    schema, held, now = _schema(_ANSWER), [], None

    def flush() -> Iterator[pa.RecordBatch]:
        if held and (found := list(_settled(held, width))):
            yield pa.RecordBatch.from_pylist(found, schema=schema)
        held.clear()

    for batch in batches:
        for i in range(batch.num_rows):
            r = batch.slice(i, 1).to_pylist()[0]
            if r["hashes"] is None:
                ends, twins = _parted(r["places"])
                yield pa.RecordBatch.from_pylist([{"block": r["block"], "docs": r["docs"], "keys": r["bases"], "ends": ends, "lost": r["checks"], "twins": twins}], schema=schema)
                continue
            if r["range"] != now:
                yield from flush()
                now = r["range"]
            held.append(r)
    yield from flush()


def spans_of(repeats: np.ndarray, ends: np.ndarray, window: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """Row, starts and ends of the maximal intervals that windows at these places cover, within each row."""
    steps = np.zeros(int(ends[-1]) + 1, dtype=np.int64)
    np.add.at(steps, repeats, 1)
    np.add.at(steps, repeats + window, -1)
    covered = np.cumsum(steps[:-1]) > 0
    begins = ends - np.diff(ends, prepend=0)
    # A word opens an interval if the one before is kept or belongs to another row.
    opens, closes = covered.copy(), covered.copy()
    opens[1:] &= ~covered[:-1] | np.isin(np.arange(1, len(covered)), begins)
    closes[:-1] &= ~covered[1:] | np.isin(np.arange(len(covered) - 1), ends - 1)
    first, last = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    row = np.searchsorted(ends, first, "right")
    for i in np.unique(row):
        mine = row == i
        yield int(i), (first[mine] - begins[i]).tolist(), (last[mine] - begins[i]).tolist()


def _merged(window: int):
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])

    def finish(number: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        heads = [r for r in rows if r["docs"] is not None]
        if not heads:
            raise RuntimeError(f"an answer came for block {number}, which is not there")
        head = heads[0]
        docs, keys, ends = unpack(head["docs"]), np.frombuffer(head["keys"], np.int64), unpack(head["ends"])
        answers = [unpack(r["places"]) for r in rows if r["places"] is not None]
        answered = np.concatenate([np.zeros(0, np.int64), *answers])
        of, twins = np.split(unpack(head["twins"]), 2)
        lost = np.concatenate([unpack(head["lost"]), answered, twins[np.isin(of, answered)]])
        found = [(int(docs[i]), int(keys[i]), s, e) for i, s, e in spans_of(lost, ends, window)] if len(lost) else []
        if found:
            doc, key, s, e = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array([None if d == LAST else d for d in doc], pa.int64()), pa.array(key, pa.int64()), pa.array(s, pa.list_(pa.int32())),
                                              pa.array(e, pa.list_(pa.int32()))], schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["block"] != now and rows:
                    yield from finish(now, rows)
                    rows = []
                now = r["block"]
                rows.append(r)
        if rows:
            yield from finish(now, rows)

    return run


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, the whole text as bytes (null: empty) and its 64-bit key."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("key"), text.cast("binary").alias("text"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, block: int = BLOCK, in_range: int = RANGE) -> DataFrame:
    """doc_id, key, starts, ends: for every document that repeats words said earlier, the maximal intervals of words
    to remove. key: xxhash64 of the text, as rows may share an id. Blocks and ranges hold so many bytes of text."""
    rows = keyed(docs)
    spark = docs.sparkSession
    per_id = rows.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("size"), F.count(F.lit(1)).alias("rows"))
    size, most = per_id.agg(F.coalesce(F.sum("size"), F.lit(0)), F.max("rows")).first()
    # Where every id is one row, places of one document meet in one block, in order: their starts need not travel.
    alone = most == 1
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // in_range)
    # A multiple of 256: the first byte of a hash, at least, need not travel with it.
    ranges = -(-tasks // 256) * 256
    tasks = min(tasks, MOST_TASKS)

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, part = Digests(), TaskContext.get().partitionId()
        for batch in batches:
            for texts in blocks(batch, block):
                yield from _hashed(texts, digests, window, ranges, part, alone)

    entries = rows.mapInArrow(hashed, _PACKED).repartitionById(tasks, F.expr(f"cast(range * {tasks} div {ranges} as int)")).sortWithinPartitions("range")
    answers = entries.mapInArrow(lambda batches: _counted(batches, _sent(ranges)), _ANSWER).repartition(tasks, "block").sortWithinPartitions("block")
    spans = answers.mapInArrow(_merged(window), "doc_id bigint, key bigint, starts array<int>, ends array<int>")
    # Rows repeated in several blocks have the same intervals in each.
    return spans.dropDuplicates(["doc_id", "key"])


def _met(docs: DataFrame, window: int, **sizes: int) -> DataFrame:
    def squeezed(rows: pa.RecordBatch) -> pa.RecordBatch:
        squeeze = ZstdCompressor(level=1).compress
        return pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("key"), pa.array([squeeze(t) for t in rows.column("text").to_pylist()], pa.binary())], names=["doc_id", "key", "text"])

    rows = map_batches(keyed(docs), squeezed, "doc_id bigint, key bigint, text binary")
    spans = repeated_spans(docs, window, **sizes).select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "starts", "ends")
    return rows.join(spans, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left").select("doc_id", "text", "starts", "ends")


def kept_words(text: bytes, starts: list[int] | None, ends: list[int] | None) -> tuple[int, list[bytes]]:
    words, kept, at = text.split(), [], 0
    for start, end in zip(starts or (), ends or ()):
        kept += words[at:start]
        at = end
    return len(words), kept + words[at:] if at else words


def without_repeats(docs: DataFrame, window: int = WINDOW, keep_text: bool = True, **sizes: int) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row, and kept_text if asked for: what is left, joined by one space."""
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * keep_text

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        words, left, texts, digests = [], [], [], []
        whole = ZstdDecompressor().decompress
        for text, starts, ends in zip(*(rows.column(c).to_pylist() for c in ("text", "starts", "ends"))):
            n, kept = kept_words(whole(text), starts, ends)
            joined = b" ".join(kept)
            words.append(n)
            left.append(n - len(kept))
            digests.append(sha256(joined).hexdigest())
            if keep_text:
                texts.append(joined)
        out = [rows.column("doc_id"), pa.array(words, pa.int64()), pa.array(left, pa.int64()), pa.array(digests, pa.string())]
        if keep_text:
            out.append(pa.array(texts, pa.binary()).cast(pa.string()))
        return pa.RecordBatch.from_arrays(out, names=names)

    kinds = ["bigint", "bigint", "bigint", "string", "string"]
    return map_batches(_met(docs, window, **sizes), batch, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
