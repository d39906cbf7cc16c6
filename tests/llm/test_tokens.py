"""Operators 1, 2 and 9 against the tokenizers library."""

import random
import struct
import unicodedata
import zlib
from array import array
from collections import Counter
from hashlib import sha256

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimwright.llm.automaton import Automaton, Codec, codec, encoded
from claimwright.llm.common import folder
from claimwright.llm.records import ByteLevelEncoder, crc32c, crc32c_many, read_record, read_records, byte_level, unframed, write_and_read, write_records
from claimwright.llm.token_counts import counter, merged_length, token_counts
from claimwright.llm.vocabulary import vocabulary

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTES)


def odd_texts(n, seed):
    rng, letters = random.Random(seed), "abcdeghinorst aeiouth   ing'st'll\n\t.,!?123é ÉßΣσİçñ你好\x1c\xa0aaaa$$$%%%́ \r"
    out = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 120))) for _ in range(n)]
    return out + ["a" * 999, "hahaha" * 50, "the " * 60, "ΑΣ ΑΣΣ", "é ́a", "zzzz ooooo loool", "......", "", " ", "\n", " a", "a \n b", "\n\n\na", "x\n y",
                  "<|startoftext|>x<|endoftext|>", "<|endoftext|>  <|endoftext|>\n", "<|endoftext", "I'll we've 's"]


def test_words_equal_the_library(word_library):
    count, code = counter(WORDS), codec(WORDS)
    vocab = [w.replace("</w>", "") for w in word_library.get_vocab()]
    rng = random.Random(2)
    joined = [" ".join(rng.choice(vocab) + rng.choice(vocab) for _ in range(15)) for _ in range(400)]
    for text in odd_texts(1500, 1) + joined:
        want = word_library.encode(text, add_special_tokens=False).ids
        ids = code.encode(text)
        assert list(array("I", ids)) == want, text
        assert count(text) == len(want)
        assert code.decode(ids) == word_library.decode(want, skip_special_tokens=False)


def test_every_code_point_equals_the_library(word_library):
    """Between two letters and after a mark: what is a letter, and how marks are ordered, is the library's own."""
    code, count = codec(WORDS), counter(WORDS)
    # All code points passed; planes without a character are sampled here, to save minutes.
    points = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x33500), *range(0x33500, 0x110000, 101), *range(0xE0000, 0xE0200)]]
    marks = [c for c in points if unicodedata.category(c) in ("Mn", "Mc", "Me", "Cn") and ord(c) < 0x20000]
    for pattern, points in (("a{}b", points), ("e\u0301{}x", marks)):
        for at in range(0, len(points), 50_000):
            texts = [pattern.format(c) for c in points[at: at + 50_000]]
            for text, want in zip(texts, word_library.encode_batch(texts, add_special_tokens=False)):
                assert array("I", code.encode(text)).tolist() == want.ids, hex(ord(text[1]))
                assert count(text) == len(want.ids)


def test_fuzzed_texts_equal_the_library(word_library):
    rng = random.Random(11)
    blocks = [(0x20, 0x7F), (0xA0, 0x250), (0x300, 0x370), (0x370, 0x600), (0x900, 0x1000), (0x1AB0, 0x1B00), (0x2000, 0x2100), (0x3040, 0x3100), (0x4E00, 0x4F00), (0xA700, 0xA800), (0x1F600, 0x1F650)]
    texts = ["".join(chr(rng.randrange(*rng.choice(blocks))) if rng.random() < 0.5 else rng.choice("abc the ing ") for _ in range(rng.randrange(1, 40))) for _ in range(50_000)]
    code, count = codec(WORDS), counter(WORDS)
    for text, want in zip(texts, word_library.encode_batch(texts, add_special_tokens=False)):
        assert array("I", code.encode(text)).tolist() == want.ids, text
        assert count(text) == len(want.ids)


def test_ids_beyond_16_bits():
    """Pairs of large ids are keys of their own."""
    big = 70_000
    merges = [(big, 1, big + 1), (1, big, big + 2)]
    ranks = {a << 32 | b: r for r, (a, b, _) in enumerate(merges)}
    assert merged_length([big, 1, 1, big], ranks, [m[2] for m in merges]) == 2
    assert merged_length([big - 65_536, 1], ranks, [m[2] for m in merges]) == 2


def test_bytes_equal_the_library(byte_library):
    encode = byte_level(BYTES, public_tokenizers.PATTERN)
    for text in odd_texts(3000, 3):
        assert encode.width == 2 and list(array("H", encode(text))) == byte_library.encode(text, add_special_tokens=False).ids, text


def test_merging_by_heap_is_merging_by_rank():
    """Against the plain way: find the lowest rank, merge it everywhere from the left, repeat."""
    rng = random.Random(4)
    for _ in range(300):
        merges, known = [], list(range(3))
        for new in range(3, 12):
            a, b = rng.choice(known), rng.choice(known)
            if (a, b) not in [m[:2] for m in merges]:
                merges.append((a, b, new))
                known.append(new)
        symbols = [rng.randrange(3) for _ in range(rng.randrange(0, 40))]
        plain = list(symbols)
        ranks = {m[:2]: (r, m[2]) for r, m in enumerate(merges)}
        while found := [ranks[p] for p in zip(plain, plain[1:]) if p in ranks]:
            rank, new = min(found)
            i = next(i for i, p in enumerate(zip(plain, plain[1:])) if ranks.get(p, (None,))[0] == rank)
            plain[i : i + 2] = [new]
        assert merged_length(symbols, {a << 32 | b: r for r, (a, b, _) in enumerate(merges)}, [m[2] for m in merges]) == len(plain)


def test_every_accepted_pair_is_what_merging_leaves(word_library):
    """An arc exists just where the two labels, spelled out and merged again, come back as they were."""
    v = vocabulary(WORDS)
    machine, rng = Automaton(v), random.Random(5)
    inner = [s for s in v.ids if not s.endswith("</w>")]
    model = word_library.model
    checked = Counter()
    while checked.total() < 1500:
        a, b = rng.choice(inner[:3000]), rng.choice(list(v.ids)[:3000])
        if not b.endswith("</w>") or v.ids[a] not in machine.live or v.ids[b] not in machine.live:
            continue
        if [t.id for t in model.tokenize(a + b[:-4])] != [v.ids[a], v.ids[b]]:
            assert not machine.arc(v.ids[a], v.ids[b])
            checked["none"] += 1
        else:
            assert machine.arc(v.ids[a], v.ids[b])
            checked["arc"] += 1
    assert min(checked.values()) > 20


def test_counts_of_odd_rows(odd, odd_rows, nothing, word_library):
    want = Counter()
    for doc_id, text, *_ in odd_rows:
        n = len(word_library.encode(text or "", add_special_tokens=False).ids)
        want[doc_id, len((text or "").encode()), n, n > 100] += 1
    assert Counter(map(tuple, token_counts(odd, WORDS, limit=100).collect())) == want
    assert token_counts(nothing, WORDS).collect() == []


def test_codec_on_odd_rows(odd, odd_rows, nothing, word_library):
    want = Counter()
    for doc_id, text, *_ in odd_rows:
        ids = word_library.encode(text or "", add_special_tokens=False).ids
        decoded = word_library.decode(ids, skip_special_tokens=False)
        want[doc_id, len(ids), sha256(array("I", ids).tobytes()).hexdigest(), sha256(decoded.encode()).hexdigest(), array("I", ids).tobytes(), decoded] += 1
    got = encoded(odd, WORDS).collect()
    assert Counter((*r[:4], bytes(r[4]), r[5]) for r in got) == want
    assert encoded(nothing, WORDS, keep_ids=False).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert encoded(nothing, WORDS).collect() == []


def test_checksums_are_crc32c():
    def plain(data):
        crc = 0xFFFFFFFF
        for b in data:
            crc ^= b
            for _ in range(8):
                crc = crc >> 1 ^ 0x82F63B78 if crc & 1 else crc >> 1
        return crc ^ 0xFFFFFFFF

    assert crc32c(b"123456789") == 0xE3069283  # the published check value
    rng = random.Random(6)
    items = [rng.randbytes(n) for n in (0, 1, 3, 4, 5, 8, 100, 511, 512, 513, 1024, 1536, 5000)]
    assert [plain(x) for x in items] == [crc32c(x) for x in items] == crc32c_many(items).tolist()
    assert crc32c_many([]).tolist() == []


def test_records_round_trip(spark, odd, odd_rows, nothing, byte_library):
    root = folder(spark, "test-records")
    got = write_and_read(spark, odd, root, BYTES, public_tokenizers.PATTERN, end_id=0).collect()
    ids = [(d, byte_library.encode(t or "", add_special_tokens=False).ids + [0]) for d, t, *_ in odd_rows]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(i), zlib.crc32(array("I", i).tobytes())) for d, i in ids)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == [sum(x.n_tokens for x in ordered[:k]) for k in range(len(ordered))]
    assert [r.doc_id for r in ordered] == sorted((d for d, _ in ids), key=lambda d: (d is not None, d or 0))
    assert write_and_read(spark, nothing, folder(spark, "test-records"), BYTES, public_tokenizers.PATTERN, end_id=0).collect() == []


def test_files_are_framed_records_with_an_index(spark, documents):
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(200)]
    manifest = write_records(documents(rows), folder(spark, "test-files"), lambda: byte_level(BYTES, public_tokenizers.PATTERN), 0, shards=4)
    shards = manifest.orderBy("shard").collect()
    assert sum(s.records for s in shards) == 200 and len(shards) > 1
    entry = struct.Struct("<IqQQQ")
    encode, seen = byte_level(BYTES, public_tokenizers.PATTERN), []
    for s in shards:
        path = s.path.removeprefix("file:")
        data, index = open(path + ".records", "rb").read(), open(path + ".index", "rb").read()
        for null, doc_id, offset, length, n_ids in entry.iter_unpack(index):
            size, of_size = struct.unpack_from("<QI", data, offset)
            payload = data[offset + 12 : offset + 12 + size]
            (of_payload,) = struct.unpack_from("<I", data, offset + 12 + size)
            for crc, part in ((of_size, data[offset : offset + 8]), (of_payload, payload)):
                plain = crc32c(part)
                assert crc == ((plain >> 15 | plain << 17) + 0xA282EAD8) & 0xFFFFFFFF
            assert size == length and struct.unpack_from("<HHq", payload) == (0, 2, doc_id) and not null
            assert payload[12:] == encode(dict(rows)[doc_id]) + b"\0\0" and len(payload[12:]) == 2 * n_ids
            assert read_record(s.path, offset, length) == (doc_id, array("I", array("H", payload[12:])))
            seen.append(doc_id)
    assert seen == sorted(seen) and len(seen) == 200
    path = shards[0].path.removeprefix("file:") + ".records"
    with open(path, "r+b") as f:
        f.seek(20)
        f.write(b"\xff")
    with pytest.raises(ValueError, match="damaged"):
        list(unframed(shards[0].path))
    with pytest.raises(Exception, match="damaged"):
        read_records(manifest).collect()


def test_batches_are_cut_by_bytes():
    import pyarrow as pa

    from claimwright.llm.common import pieces

    texts = ["x" * n for n in (10, 5000, 20, 30, 900, 900, 900, 0)]
    batch = pa.record_batch([pa.array(range(8)), pa.array(texts)], names=["i", "text"])
    found = list(pieces(batch, 1500))
    assert [i for p in found for i in p.column("i").to_pylist()] == list(range(8))
    assert all(p.num_rows == 1 or p.nbytes <= 1500 for p in found) and len(found) > 3
    assert list(pieces(batch.slice(0, 0))) == [] and len(list(pieces(batch))) == 1


def test_a_round_trip_is_the_encoding_and_its_decoding():
    code = codec(WORDS)
    texts = ["", " ", "a", "The cat's internationalisation!!", "x" * 70, "naïve  日本語\x1ftext", "<|endoftext|> a<|endoftext|><|endoftext|>b", "2024-01-02 " * 3]
    for text in texts:
        ids = code.encode(text)
        assert code.round_trip(text) == (ids, code.decode(ids)), text
    # A word is looked up only where its last symbols allow a label, which never leaves one out.
    ends = code.automaton.longest
    assert all(len(label) < 4 or ends[label[-4:]] >= len(label) for label in code.v.ids)


def test_a_path_asks_for_few_arcs(word_library):
    """A label is tried only next to the path that leads to the word's end, not at every place of the word."""
    v = vocabulary(WORDS)
    machine, rng, asked = Automaton(v), random.Random(12), []
    arc = machine.arc
    machine.arc = lambda state, label: asked.append(1) or arc(state, label)

    class Forgetful(dict):
        def __setitem__(self, key, value):
            pass

    machine._known = Forgetful()
    words = ["".join(rng.choice(["tion", "er", "an", "th", "ouq", "ble", "zx", "é"]) for _ in range(6)) for _ in range(500)]
    n_symbols = n_labels = 0
    code = Codec(WORDS)
    code.automaton = machine
    for word in words:
        ids = array("I", code.encode(word))
        assert ids.tolist() == word_library.encode(word, add_special_tokens=False).ids
        n_symbols, n_labels = n_symbols + len(v.spelled(word)), n_labels + len(ids)
    assert len(asked) < 1.5 * n_labels < n_symbols


def test_words_of_latin_texts_are_held_once(word_library):
    code = Codec(WORDS)
    texts = ["Über naïve, naïve; (naïve) NAÏVE!\nÀ l'été: ÿ ß ÐØ×÷", "naïvé Σας 你好 \x1c a\x85b\xa0c"]
    for text in texts:
        assert array("I", code.encode(text)).tolist() == word_library.encode(text, add_special_tokens=False).ids
    code = Codec(WORDS)
    code.encode("The naïve, naïve; (naïve) NAÏVE!")
    assert not code._chunk and set(code._word) == {"the", "naïve", ",", ";", "(", ")", "!"}


def test_pieces_are_held_once(byte_library):
    encode = ByteLevelEncoder(BYTES, public_tokenizers.PATTERN)
    for text in ("word word, word. (word) word! word?\nword", "word\tword  word"):
        assert list(array("H", encode(text))) == byte_library.encode(text, add_special_tokens=False).ids
    held = [key for memo in vars(encode).values() if isinstance(memo, dict) for key in memo if "word" in str(key)]
    assert sorted(held) == [" word", "word"]


def test_a_block_of_texts_is_split_at_once(byte_library):
    class Counting(dict):
        asked = []

        def __getitem__(self, piece):
            self.asked.append(piece)
            return encode._by_library(piece)

    encode = ByteLevelEncoder(BYTES, public_tokenizers.PATTERN)
    encode._pieces, encode._piece = None, Counting()  # neither is a text split by itself nor a piece looked up for each place
    rng = random.Random(7)
    parts = ["a", "é", "你", "😀", "́", "1", "²", "!", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", "　", "​", "'", "'s", "'t", "'re", "'ll", "'S", "'r", "s", "l", "<|", "<|endoftext|>"]
    plain = [p for p in parts if p.isascii()]
    for of in (parts, plain, plain[:9]):
        texts = ["".join(rng.choices(of, k=rng.randrange(12))) for _ in range(3000)] + ["", "x'", "'", " ", "\n ", "s's't", "'s's'll", "a  'd"]
        encode._piece.asked.clear()
        got = encode.many(texts)
        assert [list(array("H", g)) for g in got] == [e.ids for e in byte_library.encode_batch(texts, add_special_tokens=False)]
        assert len(encode._piece.asked) == len(set(encode._piece.asked))
    assert encode.many([]) == [] and encode.many(["", ""]) == [b"", b""]
    # Another spelling of the pattern is left to the library of patterns, text by text.
    assert ByteLevelEncoder(BYTES, f"(?:{public_tokenizers.PATTERN})").many(texts) == got
