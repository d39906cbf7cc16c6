"""Operator 12 against brute force over all windows."""

import random
import re
from hashlib import sha256

import numpy as np
import pytest

from claimwright.llm.repeats import BASES, Digests, groups_of, pack, repeated_spans, rolled, spans_of, unpack, without_repeats

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, window):
    """(doc_id, n_words, n_removed, kept text) of (doc_id, text) rows; a null id behind all others."""
    rows = [(d, WORDS.findall(t or "")) for d, t in rows]
    first = {}
    for d, words in rows:
        for i in range(len(words) - window + 1):
            place, said = (d is None, d or 0, i), tuple(words[i: i + window])
            first[said] = min(first.get(said, place), place)
    out = []
    for d, words in rows:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if (d is None, d or 0, i) > first[tuple(words[i: i + window])]:
                gone[i: i + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((d, len(words), sum(gone), sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def got(docs, window, **sizes):
    return sorted(map(tuple, without_repeats(docs, window, **sizes).collect()), key=str)


def passages(seed, n=120):
    """Documents out of few words and shared passages: repeats within and between them, of all lengths."""
    rng = random.Random(seed)
    shared = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 40))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.4 else " ".join(f"{rng.randrange(40)}" for _ in range(rng.randrange(1, 15))) for _ in range(rng.randrange(1, 6))]
        rows.append((rng.randrange(n), rng.choice([" ", "\n", " \t"]).join(parts)))
    return rows + [rng.choice(rows) for _ in range(20)]


@pytest.mark.parametrize("seed, window, sizes", [(0, 5, {}), (1, 5, {"block": 200, "in_range": 300}), (2, 1, {"block": 1, "in_range": 50}), (3, 20, {"block": 1000, "in_range": 10**6})])
def test_equals_brute_force(documents, seed, window, sizes):
    rows = passages(seed)
    assert got(documents(rows, 4), window, **sizes) == plain(rows, window)


def test_odd_rows(documents, odd_rows, odd, nothing):
    rows = [r[:2] for r in odd_rows]
    assert got(odd, 20) == plain(rows, 20)
    assert got(odd, 3, block=500) == plain(rows, 3)
    assert got(nothing, 20) == [] and repeated_spans(nothing).collect() == []


@pytest.mark.parametrize("sizes", [{}, {"block": 300, "in_range": 1000}])
def test_ids_of_one_row_each(documents, sizes):
    rows = [(i, text) for i, (_, text) in enumerate(passages(7))]
    assert got(documents(rows, 4), 5, **sizes) == plain(rows, 5)


def test_rows_that_share_an_id(documents):
    """At one place of a document neither row is earlier, wherever the rows are; both lose against an earlier document."""
    said = " ".join(f"w{i}" for i in range(12))
    rows = [(5, f"{said} x{k}") for k in range(30)] + [(5, f"{said} x1")] * 30 + [(None, f"{said} {k}") for k in range(30)] + [(None, said)]
    for sizes in ({}, {"block": 1}, {"block": 300}):
        assert got(documents(rows, 6), 6, **sizes) == plain(rows, 6)
        assert got(documents([*rows, (4, said)], 6), 6, **sizes) == plain([*rows, (4, said)], 6)


def test_one_window_on_every_row(documents):
    """A passage that a third of the rows share is one entry per block, and stays in its first document alone."""
    said = " ".join(f"w{i}" for i in range(25))
    rows = [(i, f"{i} {said} end" if i % 3 == 0 else f"text {i} of its own") for i in range(600)]
    rows += [(1000, "la " * 3000)]
    assert got(documents(rows, 8), 20, block=2000, in_range=5000) == plain(rows, 20)


def test_query_on_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(docs, 20) == plain([tuple(r) for r in docs.select("doc_id", "text").collect()], 20)


def test_hash_is_the_polynomial_of_the_digests():
    digests = Digests()
    words = [b"a", b"b", b"a", b"c", b"b", b"a", b"c"]
    for half, base in zip(digests.of(words), BASES):
        want = [sum(int(half[i + k]) * pow(base, k) for k in range(3)) % 2**64 for i in range(5)]
        assert rolled(half, base, 3).tolist() == want and len(rolled(half, base, 8)) == 0
    assert len(digests) == 3


def test_digests_stay_right_when_emptied():
    small, large = Digests(entries=10), Digests()
    for k in range(20):
        words = [f"{i % 7 * k}".encode() for i in range(30)]
        assert all((a == b).all() for a, b in zip(small.of(words), large.of(words)))


def test_packed_numbers_come_back():
    g = np.random.default_rng(1)
    for a in ([], [0], [2**63 - 1, -2**63, 0, 5], g.integers(-2**62, 2**62, 100), np.arange(1000)):
        assert unpack(pack(np.array(a, dtype=np.int64))).tolist() == list(a)


def test_groups_hold_repeats_in_order():
    hashes, checks = np.array([5, 7, 5, 5, 9, 7], np.uint64), np.array([1, 2, 1, 3, 1, 2], np.uint64)
    again, first = groups_of(hashes, checks, np.array([3, 1, 2, 0, 0, 0]))
    assert list(zip(again.tolist(), first.tolist())) == [(2, 2), (0, 2), (3, 3), (5, 5), (1, 5)]


def test_spans_are_maximal_and_end_with_their_row():
    ends = np.array([10, 14, 30])
    assert list(spans_of(np.array([2, 4, 7, 10, 11, 14, 20]), ends, 3)) == [(0, [2], [10]), (1, [0], [4]), (2, [0, 6], [3, 9])]
