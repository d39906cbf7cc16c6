"""Operator 2: token ids in length-delimited binary records, with an offset index beside them.

One shard file per partition, documents in ascending doc_id order across and within shards. A record is

    length (u64) | masked crc32c of the length (u32) | payload | masked crc32c of the payload (u32)

little-endian, as in the public record format of that shape. The payload is a u16 that is 1 for a null
doc_id, a u16 with the bytes of an id (2 where every id of the vocabulary fits, else 4), the doc_id (i64), then
the ids, unsigned. Beside ``part-N.records`` lies ``part-N.index``: one
fixed-size entry per record (null mark, doc_id, offset, payload length, ids), so that a record can be read
at random without the others.

The one shuffle is the range partitioning by doc_id. A task streams its rows to a file of its own attempt,
which is renamed when complete: a lost executor's task is run again and replaces nothing half-written.
Offsets of whole shards are summed from the manifest (one row per shard), never from rows.

Null and empty texts become a record with the end id alone. Null doc_ids come first. Rows that repeat a
doc_id stay, in the order of their text's hash. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from claimwright.llm.common import Memo, pieces, whole_texts
from claimwright.llm.vocabulary import byte_alphabet

ENTRY = np.dtype([("null", "<u4"), ("doc_id", "<i8"), ("offset", "<u8"), ("length", "<u8"), ("n_ids", "<u8")])
HEAD = np.dtype([("null", "<u2"), ("width", "<u2"), ("doc_id", "<i8")])
_CODE = {2: "H", 4: "I"}
MANIFEST = "shard int, records bigint, n_ids bigint, bytes bigint, path string"
_FRAME = 12  # length and its checksum
_BLOCK = 512  # bytes whose checksums are computed side by side
_READ = 8 << 20


# Checksums ---------------------------------------------------------------------------------------


@cache
def _crc_tables() -> np.ndarray:
    """tables[k][b]: crc32c of byte b followed by k zero bytes (reflected polynomial 0x82F63B78)."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0x82F63B78), t >> 1).astype(np.uint32)
    tables = [t]
    for _ in range(3):
        tables.append(t[tables[-1] & 0xFF] ^ (tables[-1] >> 8))
    return np.stack(tables)


def _advance(crc: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Raw checksums after one little-endian 32-bit word each."""
    t, x = _crc_tables(), crc ^ words
    return t[3][x & 0xFF] ^ t[2][x >> 8 & 0xFF] ^ t[1][x >> 16 & 0xFF] ^ t[0][x >> 24]


@cache
def _skip_block() -> np.ndarray:
    """The linear map "append a block of zero bytes", as four tables by byte of the checksum."""
    basis = (np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)).astype(np.uint32)
    flat, zero = basis.ravel(), np.zeros(1024, np.uint32)
    for _ in range(_BLOCK // 4):
        flat = _advance(flat, zero)
    return flat.reshape(4, 256)


def crc32c(data: bytes) -> int:
    """Whole blocks are summed side by side and joined by the zero-block map; the rest follows word by word."""
    t, n = _crc_tables(), len(data) // _BLOCK
    crc = 0xFFFFFFFF
    if n > 1:
        words = np.frombuffer(data, "<u4", n * _BLOCK // 4).reshape(n, -1)
        sums = np.zeros(n, np.uint32)
        for k in range(words.shape[1]):
            sums = _advance(sums, words[:, k])
        skip = _skip_block().tolist()
        for s in sums.tolist():
            crc = skip[0][crc & 255] ^ skip[1][crc >> 8 & 255] ^ skip[2][crc >> 16 & 255] ^ skip[3][crc >> 24] ^ s
        data = data[n * _BLOCK :]
    one = _byte_table()
    for b in data:
        crc = one[(crc ^ b) & 255] ^ crc >> 8
    return crc ^ 0xFFFFFFFF


@cache
def _byte_table() -> list[int]:
    return _crc_tables()[0].tolist()


def crc32c_many(items: list[bytes]) -> np.ndarray:
    """Checksums of many records at once: all their blocks side by side, then joined record by record."""
    lengths = np.array([len(x) for x in items], np.int64)
    blocks = -(-lengths // _BLOCK)
    # Zero bytes before the first byte do not change a sum that starts at zero, so records are padded in front;
    # the start value is worked in by inverting the first four bytes.
    total = int(blocks.sum())
    if not total:
        return np.array([crc32c(x) for x in items], np.uint32)
    short = lengths < 4
    space, at = bytearray(total * _BLOCK), np.concatenate([[0], np.cumsum(blocks)])
    for item, end in zip(items, (at[1:] * _BLOCK).tolist()):
        space[end - len(item) : end] = item
    raw = np.frombuffer(space, np.uint8)
    first = (at[1:] * _BLOCK - lengths)[~short]
    for k in range(4):
        raw[first + k] ^= 0xFF
    words, sums = raw.view("<u4").reshape(total, -1), np.zeros(total, np.uint32)
    for column in np.ascontiguousarray(words.T):
        sums = _advance(sums, column)
    skip, out = _skip_block(), np.zeros(len(items), np.uint32)
    for k in range(int(blocks.max())):
        has = blocks > k
        c = out[has]
        out[has] = skip[0][c & 255] ^ skip[1][c >> 8 & 255] ^ skip[2][c >> 16 & 255] ^ skip[3][c >> 24] ^ sums[at[:-1][has] + k]
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.nonzero(short)[0]:
        out[i] = crc32c(items[i])
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated and offset, so that a checksum of data that holds checksums stays a good one."""
    crc = crc.astype(np.uint32)
    return ((crc >> 15 | crc << 17) + np.uint32(0xA282EAD8)).astype("<u4")


# Encoding ----------------------------------------------------------------------------------------


#: The pattern of byte-level files; texts are cut by it a block at a time. Others are cut text by text.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WHITE = 1
_AFTER = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]


@cache
def _kinds() -> np.ndarray:
    """By code point: 0, white space (1), letter or number, as the pattern's own library has them."""
    import regex

    every, kinds = "".join(map(chr, range(0x110000))), np.zeros(0x110000, np.uint8)
    for kind, of_kind in ((_WHITE, r"\s+"), (2, r"\p{L}+"), (3, r"\p{N}+")):
        for run in regex.finditer(of_kind, every):
            kinds[run.start() : run.end()] = kind
    return kinds


def piece_starts(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which code points begin a piece of ``_PATTERN``, which splits the texts that begin at ``starts`` one by one."""
    kinds, apart = _kinds()[points], np.zeros(len(points) + 3, bool)
    apart[starts] = apart[len(points) :] = True
    white, out = kinds == _WHITE, np.ones(len(points), bool)
    # A piece goes on in its kind, or after a space before it; of white space the last goes with what follows, or by itself.
    out[1:] = np.where(white[1:], ~white[:-1], (kinds[1:] != kinds[:-1]) & (points[:-1] != 32))
    out[:-1] |= white[:-1] & ~white[1:] & ~apart[1 : len(points)]
    out |= apart[: len(points)]
    # An apostrophe that begins a piece takes some letters after it.
    at = np.flatnonzero(out & (points == ord("'")))
    at = at[~apart[at + 1]]
    one = points[at + 1]
    two = np.where(apart[at + 2], 0, points[np.minimum(at + 2, len(points) - 1)])
    size = np.isin(one, [ord(c) for c in "stmd"]) + 2 * np.logical_or.reduce([(one == a) & (two == b) for a, b in _AFTER])
    at, size = at[size > 0], size[size > 0]
    out[at + 1] = False
    after = at + 1 + size
    out[after[after < len(points)]] = True
    return out


class ByteLevelEncoder:
    """Ids of whole texts by the tokenizers library, each distinct pre-split piece encoded once while held.

    Pieces of byte-level files never depend on their neighbours. Special strings are cut out first, as the
    library does, and the rest is split by the pattern. A piece is looked up once in each block of texts. Only pieces
    are held: of words there are many fewer than of words with what follows them.
    """

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        # The model is asked for once: the library wraps it anew each time.
        self._tokenize, self._bytes = library.model.tokenize, byte_alphabet()
        self._special = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self._special, key=len, reverse=True))) + ")")
        self._pieces, self._by_block = regex.compile(pattern), pattern == _PATTERN
        self.width = 2 if max([*library.get_vocab().values(), *self._special.values()]) < 1 << 16 else 4
        self._piece = Memo(self._by_library, 600_000)  # some 100 MB: the library takes longest, about 4 us for each one missing

    def _by_library(self, piece: str) -> bytes:
        """The library's merges on a piece that is already split; its bytes as the library spells them."""
        if piece in self._special:  # cut out whole, and in no other piece
            return self.packed([self._special[piece]])
        if piece.isascii() and piece.isprintable():  # only the space is spelled by another character
            spelled = piece.replace(" ", self._bytes[32])
        else:
            spelled = piece.encode().decode("latin-1").translate(self._bytes)
        return self.packed([t.id for t in self._tokenize(spelled)])

    def packed(self, ids: list[int]) -> bytes:
        return array(_CODE[self.width], ids).tobytes()

    def _split(self, parts: list[list[str]]) -> tuple[pa.Array, np.ndarray]:
        """Pieces of all texts, and how many come before each text and in all. Every second part is a special string."""
        if not self._by_block:
            lists = [[q for k, p in enumerate(of_text) for q in ([p] if k % 2 else self._pieces.findall(p))] for of_text in parts]
            return pa.array(list(chain.from_iterable(lists)), pa.large_string()), np.cumsum([0, *map(len, lists)])
        text = "".join(map("".join, parts))
        data = text.encode()
        points = np.frombuffer(data, np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le"), "<u4")
        ends = np.cumsum([0, *(len(p) for of_text in parts for p in of_text)])
        begins = np.append(piece_starts(points, ends[:-1]), True)
        special = np.array([k % 2 for of_text in parts for k in range(len(of_text))], bool)
        for a, b in zip(ends[:-1][special].tolist(), ends[1:][special].tolist()):
            begins[a + 1 : b] = False
        at = np.flatnonzero(begins)
        before = np.searchsorted(at, ends[np.cumsum([0, *map(len, parts)])])
        if len(data) > len(text):
            sizes = (points >= 0x80).view(np.uint8) + (points >= 0x800) + (points >= 0x10000) + np.uint8(1)
            at = np.concatenate([[0], np.cumsum(np.add.reduceat(sizes, at[:-1], dtype=np.int64))])
        return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)]), before

    def many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned integers of ``width`` bytes."""
        every, before = self._split([self._cut.split(t) if "<|" in t else [t] for t in texts])
        every = every.dictionary_encode()
        found = list(map(self._piece.__getitem__, every.dictionary.to_pylist()))
        sizes, which = np.fromiter(map(len, found), np.int64, len(found)) // self.width, every.indices.to_numpy()
        first, counts = np.cumsum(sizes) - sizes, sizes[which]
        ends = np.concatenate([[0], np.cumsum(counts)])
        places = np.repeat(first[which] - ends[:-1], counts) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(found), f"<u{self.width}")[places].tobytes()
        bounds = (ends[before] * self.width).tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]


@cache
def byte_level(path: str, pattern: str) -> ByteLevelEncoder:
    return ByteLevelEncoder(path, pattern)


# Writing and reading -----------------------------------------------------------------------------


def _at(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def framed(ids: list[bytes], doc_ids: list[int | None], width: int) -> tuple[list[bytes], list[int]]:
    heads = np.zeros(len(ids), HEAD)
    heads["null"] = [d is None for d in doc_ids]
    heads["width"], heads["doc_id"] = width, [d or 0 for d in doc_ids]
    heads = heads.tobytes()
    payloads = [heads[k * HEAD.itemsize : (k + 1) * HEAD.itemsize] + x for k, x in enumerate(ids)]
    lengths = [len(p).to_bytes(8, "little") for p in payloads]
    of_length, of_payload = masked(crc32c_many(lengths)), masked(crc32c_many(payloads))
    records = [a + b.tobytes() + c + d.tobytes() for a, b, c, d in zip(lengths, of_length, payloads, of_payload)]
    return records, [len(p) for p in payloads]


def write_records(docs: DataFrame, root: str, make_encoder: Callable[[], ByteLevelEncoder], end_id: int, shards: int | None = None) -> DataFrame:
    """Write the shards below ``root``; returns their manifest, read back from the shared folder. Without a number
    of shards, adaptive execution merges the session's shuffle partitions up to its advisory size."""
    spark = docs.sparkSession

    def shard(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        number, attempt, encode = TaskContext.get().partitionId(), uuid.uuid4().hex, make_encoder()
        end, width = encode.packed([end_id]), encode.width
        fs, base = _at(f"{root}/shards")
        fs.create_dir(base, recursive=True)
        name, offset, n_ids, n = f"{base}/part-{number:05d}", 0, 0, 0
        own = f"{base}/_{attempt}-{number:05d}"
        with fs.open_output_stream(own + ".records") as data, fs.open_output_stream(own + ".index") as index:
            for block in chain.from_iterable(map(pieces, chain([first], batches))):
                all_ids, all_docs = encode.many(block.column("text").to_pylist()), block.column("doc_id").to_pylist()
                for k in range(0, len(all_ids), 256):
                    ids, doc_ids = [i + end for i in all_ids[k : k + 256]], all_docs[k : k + 256]
                    records, lengths = framed(ids, doc_ids, width)
                    entries = np.zeros(len(ids), ENTRY)
                    entries["null"], entries["doc_id"] = [d is None for d in doc_ids], [d or 0 for d in doc_ids]
                    sizes = np.array([len(r) for r in records], np.int64)
                    entries["offset"], entries["length"] = offset + np.cumsum(sizes) - sizes, lengths
                    entries["n_ids"] = [len(i) // width for i in ids]
                    data.write(b"".join(records))
                    index.write(entries.tobytes())
                    offset, n_ids, n = offset + int(sizes.sum()), n_ids + int(entries["n_ids"].sum()), n + len(ids)
        for kind in (".records", ".index"):
            fs.move(own + kind, name + kind)
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([number], pa.int32()), "records": [n], "n_ids": [n_ids], "bytes": [offset], "path": [f"{root}/shards/part-{number:05d}"]}
        )

    ranges = (shards, "doc_id") if shards else ("doc_id",)
    rows = whole_texts(docs).repartitionByRange(*ranges).sortWithinPartitions("doc_id", F.xxhash64("text"))
    rows.mapInArrow(shard, MANIFEST).write.parquet(f"{root}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def unframed(path: str) -> Iterator[tuple[list[bytes], list[int | None]]]:
    """Ids (32 bits each) and doc_ids of a shard, some MB at a time, every length and checksum verified."""
    fs, base = _at(path)
    with fs.open_input_stream(base + ".index") as index, fs.open_input_stream(base + ".records") as data:
        while chunk := index.read(ENTRY.itemsize * 4096):
            entries = np.frombuffer(chunk, ENTRY)
            at, payloads, doc_ids, sums, lengths = 0, [], [], [], []
            for null, doc_id, _, length, _ in entries.tolist():
                record = data.read(_FRAME + length + 4)
                lengths.append(record[:8])
                sums.append((record[8:12], record[-4:]))
                payloads.append(record[_FRAME:-4])
                doc_ids.append(None if null else doc_id)
                at += len(record)
                if at >= _READ:
                    yield _verified(path, payloads, doc_ids, sums, lengths)
                    at, payloads, doc_ids, sums, lengths = 0, [], [], [], []
            if payloads:
                yield _verified(path, payloads, doc_ids, sums, lengths)


def _verified(path, payloads, doc_ids, sums, lengths) -> tuple[list[bytes], list[int | None]]:
    good = [len(p).to_bytes(8, "little") for p in payloads] == lengths
    good = good and b"".join(s[0] for s in sums) == masked(crc32c_many(lengths)).tobytes()
    if not good or b"".join(s[1] for s in sums) != masked(crc32c_many(payloads)).tobytes():
        raise ValueError(f"damaged record in {path}")
    return [_ids(p) for p in payloads], doc_ids


def _ids(payload: bytes) -> bytes:
    """The ids of a payload as unsigned 32-bit integers."""
    width = int.from_bytes(payload[2:4], "little")
    return np.frombuffer(payload, f"<u{width}", offset=HEAD.itemsize).astype("<u4").tobytes()


def read_record(path: str, offset: int, length: int) -> tuple[int | None, array]:
    """One record by its index entry, without reading the others."""
    fs, base = _at(path)
    with fs.open_input_file(base + ".records") as data:
        record = data.read_at(_FRAME + length + 4, offset)
    head = np.frombuffer(record, HEAD, 1, _FRAME)[0]
    ids, _ = _verified(path, [record[_FRAME:-4]], [None], [(record[8:12], record[-4:])], [record[:8]])
    return None if head["null"] else int(head["doc_id"]), array("I", ids[0])


def read_records(manifest: DataFrame) -> DataFrame:
    """shard, place, doc_id, start, n_tokens, ids_crc32 of every record. start counts all ids of records before it."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = manifest.select("shard", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start = row["base"]
                for payloads, doc_ids in unframed(row["path"]):
                    counts = np.array([len(p) // 4 for p in payloads], np.int64)
                    starts = start + np.cumsum(counts) - counts
                    start += int(counts.sum())
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array([row["shard"]] * len(counts), pa.int32()), "doc_id": pa.array(doc_ids, pa.int64()), "start": starts,
                        "n_tokens": counts, "ids_crc32": pa.array([zlib.crc32(p) for p in payloads], pa.int64()),
                    })

    spread = shards.repartitionById(max(1, manifest.count()), F.col("shard"))
    return spread.mapInArrow(read, "shard int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def write_and_read(spark: SparkSession, docs: DataFrame, root: str, path: str, pattern: str, end_id: int) -> DataFrame:
    manifest = write_records(docs, root, lambda: byte_level(path, pattern), end_id)
    return read_records(manifest)
