"""Operators 3 and 4 against brute force."""

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from claimwright.llm import simhash
from claimwright.llm.components import components
from claimwright.llm.exact import build_index, chained, directory, exact_duplicates, without_copies
from claimwright.llm.simhash import near_duplicates, one_of_each


def plain_fingerprint(text, shingle=3):
    text = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, most=3):
    """Row number to smallest reachable doc_id, and to a group number."""
    fps = np.array([plain_fingerprint(t) for _, t, *_ in rows], np.uint64)
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in np.nonzero(np.bitwise_count(fps ^ fps[i]) <= most)[0].tolist():
            a, b = group[i], group[j]
            if a != b:
                group = [min(a, b) if g in (a, b) else g for g in group]
    least = {}
    for g, (d, *_) in zip(group, rows):
        least[g] = d if least.get(g) is None else least[g] if d is None else min(d, least[g])
    return fps, [least[g] for g in group], group


def near_rows(copies=60, seed=3):
    """A large group of near copies, exact copies among them, and texts of their own."""
    rng, words = random.Random(seed), [f"w{k}" for k in range(400)]
    base = [rng.choice(words) for _ in range(220)]
    rows = []
    for i in range(copies):
        text = list(base)
        for _ in range(rng.randrange(0, 4)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    return rows + [(copies + i, " ".join(rng.choice(words) for _ in range(50))) for i in range(40)]


def test_keys_meet_within_three_bits():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * 2 + rng.integers(0, 2, 4000).astype(np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, i % 4, replace=False):
            y[i] ^= np.uint64(1) << np.uint64(b)
    tables = list(zip(simhash.keys(x), simhash.keys(y)))
    assert len(tables) == 8
    assert np.any([(kx == ky[:, :1]).any(axis=1) for kx, ky in tables], axis=0).all()
    assert all(len(set(r)) in (1, 6) for kx, _ in tables for r in kx[:200].tolist())


def test_golay_code_is_perfect():
    words = np.arange(1 << 23, step=37, dtype=np.int32)
    index = simhash.nearest_index(words)
    upper, lower, errors = simhash._decoder()
    assert (errors >= 0).all() and len(set(errors.tolist())) == 2048 and max(bin(e).count("1") for e in errors.tolist()) == 3
    code = words ^ errors[upper[words >> 11] ^ lower[words & 0x7FF]]
    assert (code >> 11 == index).all() and (np.bitwise_count((words ^ code).astype(np.uint32)) <= 3).all()


@pytest.mark.parametrize("block", [2, 5, 1024])
def test_near_copies_equal_brute_force(documents, block):
    rows = near_rows()
    fps, least, _ = plain_groups(rows)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(documents(rows), block=block).collect()}
    assert got == {d: (f"{fp:016x}", c) for (d, _), fp, c in zip(rows, fps.tolist(), least)}
    assert len(set(least)) < len(rows) - 20


def test_near_copies_of_odd_rows(odd, odd_rows, nothing):
    fps, least, group = plain_groups(odd_rows)
    got = Counter(map(tuple, near_duplicates(odd).collect()))
    assert got == Counter((d, f"{fp:016x}", c) for (d, *_), fp, c in zip(odd_rows, fps.tolist(), least))
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    stay = kept.collect()
    assert len(stay) == len(set(group))
    assert Counter(r.doc_id for r in stay) == Counter(dict(zip(group, least)).values())
    assert near_duplicates(nothing).collect() == [] and one_of_each(nothing).collect() == []


def test_components_of_a_long_chain(spark):
    rng = random.Random(1)
    ids = rng.sample(range(10_000), 300)
    links = [(a, b) for a, b in zip(ids, ids[1:])] + [(20_001, 20_000), (20_002, 20_001), (30_000, 30_000)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert {got[i] for i in ids if i in got} | {min(ids)} == {min(ids)}
    assert got[20_001] == got[20_002] == 20_000 and 30_000 not in got


def plain_copies(rows):
    groups = {}
    for d, t, *_ in rows:
        groups.setdefault(t or "", []).append(d)
    out = Counter()
    for d, t, *_ in rows:
        ids = groups[t or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out[d, keep, len(ids), d == keep, sha256((t or "").encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("capacity", [1, 3, 4096])
def test_exact_copies(documents, odd, odd_rows, nothing, capacity):
    assert Counter(map(tuple, exact_duplicates(odd, capacity, 4).collect())) == plain_copies(odd_rows)
    rng = random.Random(7)
    rows = [(i, "hot text") if i % 3 == 0 else (i, f"text {rng.randrange(150)}") for i in range(600)]
    assert Counter(map(tuple, exact_duplicates(documents(rows, 6), capacity, 20).collect())) == plain_copies(rows)
    assert exact_duplicates(nothing, capacity).collect() == []


def test_one_row_of_each_text_stays(odd, odd_rows, nothing):
    kept = without_copies(odd, capacity=2)
    assert kept.columns == odd.columns
    want = Counter({k[:2] + (k[4],): 1 for k in plain_copies(odd_rows) if k[3] or k[0] is None and k[1] is None})
    got = Counter((r.doc_id, r.doc_id, sha256((r.text or "").encode()).hexdigest()) for r in kept.collect())
    assert got == want
    assert without_copies(nothing).collect() == []


def test_overfull_buckets_split_until_they_fit(spark):
    """Keys that share long prefixes need more bits than the others."""
    rng = random.Random(8)
    keys = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(500)] + [(5 << 40) + k * 3 for k in range(300)]
    found, depths = directory(spark.createDataFrame([(k,) for k in keys * 2], "key bigint"), capacity=8)
    buckets = found.collect()
    assert len(depths) > 1 and max(b["keys"] for b in buckets) <= 8
    held = {(b.depth, b.bucket): b["keys"] for b in buckets}
    assert sum(held.values()) == 800
    for k in keys:
        u = k & (1 << 64) - 1
        assert sum((d, u >> 64 - d << 62 - d) in held for d in depths) == 1


def test_one_index_entry_for_each_text(documents):
    rows = [(i, f"t{i % 90}") for i in range(400)]
    entries = build_index(documents(rows), capacity=4, keys_per_owner=10).collect()
    assert len(entries) == 90 and {e.link for e in entries} == {0} and sum(e.group_size for e in entries) == 400


def test_collisions_are_chained_and_told_apart():
    rows = [(7, 1, "a", 5, 1), (7, 1, "b", 3, 2), (7, 1, "a", None, 4), (7, 1, "b", 9, 1), (7, 2, "a", 1, 1)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("bucket", "key", "text", "keep_id", "n"), r)) for r in part]) for part in (rows[:2], rows[2:])]
    out = [tuple(r.values()) for b in chained(batches) for r in b.to_pylist()]
    digest = {t: sha256(t.encode()).hexdigest() for t in "ab"}
    assert out == [(7, 1, 0, digest["a"], 1, 5, 5), (7, 1, 1, digest["b"], 1, 9, 3), (7, 2, 0, digest["a"], 1, 1, 1)]
