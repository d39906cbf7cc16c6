"""Operator 13 against a plain tree, with blocks small enough for several rounds."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from claimwright.llm import merkle, queries
from claimwright.llm.merkle import manifest, proof_digest, ranked, rolled


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """The root, and of each node the siblings on both sides of every step."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i: i + 3] for i in range(0, len(nodes), 3)]
        for path, p in zip(paths, at):
            path.append((runs[p // 3][: p % 3], runs[p // 3][p % 3 + 1:]))
        nodes, at = [h(*run) for run in runs], [p // 3 for p in at]
    return nodes[0], paths


def plain(rows):
    """rows: (doc_id, text, lang, source, n_chars)"""
    by_source = {}
    for d, text, lang, source, n in rows:
        met = text.replace("\n", "") if text is not None and d is not None and zlib.crc32(str(d).encode()) % 2 == 0 else text
        by_source.setdefault(source, []).append((d, leaf((d, source, lang, n, text)), leaf((d, source, lang, n, met))))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for found in by_source.values():
        found.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: tree([x[1] for x in by_source[s]]) for s in names}
    if not names:
        return []
    root, over = tree([trees[s][0] for s in names])
    out = []
    for s, up in zip(names, over):
        subroot, paths = trees[s]
        for (d, own, met), path in zip(by_source[s], paths):
            node = met
            for left, right in path + up:
                node = h(*left, node, *right)
            out.append((d, own, subroot, root, h(*(x for left, right in path + up for x in left + right)), node, node == root))
    return out


def query(docs):
    tampered = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = manifest(docs, found={"text": tampered})
    rows = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("p"), "folded_root", "verified")
    return sorted(map(tuple, rows.collect()), key=str)


def made(seed, counts):
    rng = random.Random(seed)
    return [(rng.randrange(500), rng.choice(["a\nb", "", None, "naïve\n", "plain"]), rng.choice(["en", None]), source, rng.choice([1, None]))
            for source, n in counts.items() for _ in range(n)]


@pytest.mark.parametrize("digits, counts", [(1, {"a": 30, None: 1, "b": 2}), (2, {"a": 100, "é": 9, "": 10, None: 3, **{f"s{i}": 1 for i in range(12)}}), (6, {"a": 28, "b": 4})])
def test_equals_a_plain_tree(documents, monkeypatch, digits, counts):
    monkeypatch.setattr(merkle, "DIGITS", digits)
    rows = made(digits, counts)
    assert query(documents(rows, 5)) == sorted(plain(rows), key=str)


def test_odd_rows(documents, odd_rows, nothing, monkeypatch):
    monkeypatch.setattr(merkle, "DIGITS", 2)
    rows = [(*r, *(None,) * (5 - len(r))) for r in odd_rows]
    assert query(documents(rows)) == sorted(plain(rows), key=str)
    assert query(nothing) == []
    one = [(7, "only\n", None, "a", 5)]
    assert query(documents(one)) == plain(one)


def test_hot_group_is_dealt_over_tasks(documents):
    """A group's ranks run on over the range tasks, and equal rows have ranks of their own."""
    rows = [(d % 50, "t", None, None if d % 3 else "x", 1) for d in range(900)]
    leaves = documents(rows).select(F.col("source").alias("grp"), F.col("doc_id").alias("id"), merkle.leaf([F.col("doc_id")]).alias("hash"), F.struct("doc_id").alias("item"))
    got = ranked(leaves, ["id", "hash"])
    assert got.groupBy("grp").agg(F.min("rank"), F.max("rank"), F.count_distinct("rank"), F.min("n"), F.max("n")).sort("grp").collect() == [
        (None, 0, 599, 600, 600, 600), ("x", 0, 299, 300, 300, 300)]
    assert all(r.rank == r.place for r in got.selectExpr("grp", "rank", "row_number() over (partition by grp order by item.doc_id, rank) - 1 as place").collect())


def test_a_block_is_dealt_once_and_runs_no_python(spark):
    nodes = spark.range(5000).selectExpr("cast(id % 2 as string) as grp", "id div 2 as rank", "id - id + 2500 as n", "sha2(cast(id as string), 256) as hash", "cast(null as string) as item")
    plan = rolled(nodes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = queries.QUERIES["op13_merkle"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain(rows), key=str)
    assert {r.verified for r in got} == {True, False}
