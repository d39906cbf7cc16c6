"""Operators 6, 7 and 10 against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimwright.llm import mixing
from claimwright.llm.mixing import mixed, repeated, targets
from claimwright.llm.neighbours import nearest
from claimwright.llm.preferences import preference_pairs, swapped_pairs, swapped_replies

# Preferences -------------------------------------------------------------------------------------

TURNS = "pair_id bigint, turn bigint, role string, text string"


def plain_pair(chosen, rejected):
    def order(turns):
        return sorted(turns, key=lambda t: tuple((x is not None, x) for x in t))

    def shown(turn):
        return f"<|im_start|>{turn[1] or 'unknown'}\n", f"{turn[2] or ''}<|im_end|>\n"

    c, r = order(chosen), order(rejected)
    n = next((i for i, (a, b) in enumerate(zip(c, r)) if a[1:] != b[1:]), min(len(c), len(r)))

    def completion(turns):
        text, mask = "", []
        for t in turns:
            head, body = shown(t)
            if t[1] == "assistant":
                mask.append((len(text) + len(head), len(text) + len(head) + len(body)))
            text += head + body
        return text, mask

    return n, completion(c[:n])[0], *completion(c[n:]), *completion(r[n:])


def random_pairs(seed):
    rng, out = random.Random(seed), {}
    for pair in [None, *range(40)]:
        turns = [(k if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "é你", None, "", "x" * 50])) for k in range(rng.randrange(0, 6))]
        cut = rng.randrange(0, len(turns) + 1)
        other = turns[:cut] + [(9, rng.choice(["user", "assistant"]), rng.choice("ab")) for _ in range(rng.randrange(0, 3))]
        out[pair] = (turns, other)
    out[100], out[101] = ([(0, "user", "q"), (1, "assistant", "a")],) * 2, ([(0, "user", "q")] * 2, [(0, "user", "q")])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_pairs_equal_brute_force(spark, seed):
    pairs = random_pairs(seed)
    sides = [spark.createDataFrame([(p, *t) for p, both in pairs.items() for t in both[k]], TURNS).withColumn("t", F.lit("clash")).withColumn("c", F.lit(1)) for k in (0, 1)]
    got = {r.pair_id: (r.n_common, r.prompt, r.chosen, [tuple(s) for s in r.chosen_mask], r.rejected, [tuple(s) for s in r.rejected_mask])
           for r in preference_pairs(*sides).collect()}
    assert got == {p: plain_pair(*both) for p, both in pairs.items() if both[0] or both[1]}


def test_replies_are_swapped_between_neighbours(spark):
    turns = [(0, 0, "user", "q0"), (0, 1, "assistant", "a0"), (0, 2, "user", "bye"), (1, 0, "user", "q1"), (1, 1, "assistant", "x"), (1, 2, "user", "more"),
             (1, 3, "assistant", "a1"), (2, 0, "user", "alone"), (2, 1, "assistant", "a2"), (4, 0, "user", "no reply"), (5, 0, "user", "q5"), (5, 1, "assistant", None),
             (None, 0, "user", "q"), (None, 1, "assistant", "a")]
    chosen, rejected = swapped_replies(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("last", F.lit(1)))
    got = {r.pair_id: (r.n_common, r.chosen, r.rejected) for r in preference_pairs(chosen, rejected).collect()}

    def say(text):
        return f"<|im_start|>assistant\n{text}<|im_end|>\n"

    assert got == {0: (1, say("a0"), say("a1")), 1: (3, say("a1"), say("a0")), 2: (1, say("a2"), ""), 4: (1, "", ""), 5: (1, say(""), ""), None: (1, say("a"), "")}
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert preference_pairs(*swapped_replies(empty)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_pairs_of_neighbours_equal_those_of_two_tables(spark, seed):
    """Null ids, turns, roles and texts, negative ids, repeated turns, tied replies and conversations without neighbour."""
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(-4, 9)]), rng.choice([None, 0, 1, 2, 3]), rng.choice([None, "user", "assistant", "assistant"]),
             rng.choice([None, "", "a", "b", "naïve 你好"])) for _ in range(70)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'!' as k", "'!' as c", "'!' as other").repartition(3)
    want = preference_pairs(*swapped_replies(turns)).collect()
    got = swapped_pairs(turns).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(want) > 10
    assert swapped_pairs(turns.limit(0)).collect() == []


def test_neighbours_meet_in_one_shuffle(spark):
    df = swapped_pairs(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Join", plan)
    assert len(re.findall("Exchange hash", plan)) == 1 and len(re.findall("FileScan", plan)) == 1 and not re.search(r"\bSortAggregate", plan)


def test_preferences_run_no_python(spark):
    df = preference_pairs(*swapped_replies(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Neighbours --------------------------------------------------------------------------------------


def plain_nearest(rows, modulus, k):
    """Queries to {vec_id: score} of everything at least as near as the k-th, and the exact first k."""
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    out = {}
    for q in np.nonzero(ids % modulus == 0)[0]:
        s = np.round(x @ x[q], 12)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[i]), s[i]) for i in order]
    return out


def found(df):
    out = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, round(r.score, 12)))
    return dict(out)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit(1)).withColumn("page", F.lit("x"))


def test_few_rows_are_searched_whole(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)]  # a third of all rows are one vector
    odd = [(5000, None), (5050, []), (5100, [0.0] * 8), (5150, [float("nan")] + [1.0] * 7), (5200, [float("inf")] + [1.0] * 7), (5250, [None] + [1.0] * 7),
           (5300, [1.0] * 7), (None, [1.0] * 8)]
    got = found(nearest(vectors(spark, rows + odd), F.pmod("vec_id", F.lit(50)) == 0, k=5))
    assert got == plain_nearest(rows, 50, 5)
    assert nearest(vectors(spark, odd), F.pmod("vec_id", F.lit(50)) == 0).collect() == []
    assert nearest(vectors(spark, []), F.pmod("vec_id", F.lit(50)) == 0).collect() == []
    assert found(nearest(vectors(spark, rows[:3]), F.pmod("vec_id", F.lit(50)) == 0, k=5)) == plain_nearest(rows[:3], 50, 5)


@pytest.mark.parametrize(("page_rows", "query_block", "share"), [(32, 4, 1.0), (100, 8192, 1.0), (64, 8192, 3.0)])
def test_pages_slices_and_blocks_keep_the_recall(spark, page_rows, query_block, share):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 24)) * 3
    rows = [(i, (centres[i % 12] * (i % 3 > 0) + rng.normal(size=24)).astype(np.float32).tolist()) for i in range(1500)]
    want = plain_nearest(rows, 50, 5)
    got = found(nearest(vectors(spark, rows), F.pmod("vec_id", F.lit(50)) == 0, k=5, least=50, share=share, page_rows=page_rows, query_block=query_block))
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = {r[0]: np.array(r[1], float) for r in rows}
    for q, near in got.items():
        for v, s in near:
            a, b = exact[q], exact[v]
            assert abs(s - a @ b / math.sqrt((a @ a) * (b @ b))) < 1e-9


def test_recall_on_the_test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want, got = plain_nearest(rows, 50, 5), found(nearest(table, F.pmod("vec_id", F.lit(50)) == 0, k=5))
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.92 * 5 * len(want)


# Mixing ------------------------------------------------------------------------------------------


def plain_targets(sizes, weights, most=3.0):
    """Share, cut, share the excess again, until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    fixed, open_ = {}, set(names)
    left = float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not above:
            return fixed | {s: level * weight[s] for s in open_}
        for s in above:
            fixed[s] = most * sizes[s]
            left -= fixed[s]
        open_ -= above
    return fixed


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 100, None: 5, "ä": 1000}, {"a": 1}, {"a": 0, "b": 7}, {k: 3 ** (ord(k) - 96) for k in "abcdefgh"}, {"a": 5, "b": 5}])
def test_targets_equal_sharing_again_and_again(spark, sizes):
    got = {r.source: r.target for r in targets(spark.createDataFrame(list(sizes.items()), "source string, size bigint"), (5, 2, 1)).collect()}
    want = plain_targets(sizes, (5, 2, 1))
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) <= 1e-9 * max(1, want[s]) for s in want)


def mix_rows(n=900, seed=4):
    rng = random.Random(seed)
    names = ["hot"] * 5 + ["a", "b", "c", None]
    return [(i, " ".join(["w"] * rng.choice([0, 1, 5, 30, 200])), "en", rng.choice(names)) for i in range(n)]


def check_mix(rows, got, near=0.02):
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, *_ in rows)
    taken, size, target = Counter(), Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        size[r.source] += r.size
        target[r.source] = r.target
        assert r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size
    want = plain_targets(size, (5, 2, 1))
    for s in size:
        assert abs(target[s] - want[s]) <= 1e-6 * max(1, want[s])
        assert abs(taken[s] - want[s]) <= max(1, near * want[s])


@pytest.mark.parametrize("few", [1, 40, 50_000])
def test_taken_words_come_near_the_targets(documents, few):
    rows = mix_rows()
    got = mixed(documents(rows), few=few).collect()
    check_mix(rows, got)
    again = mixed(documents(rows, 7), few=50_000).collect()  # other partitions, one cut: the same documents
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


@pytest.mark.parametrize("few, expand", [(50_000, 10_000), (1, 7)])
def test_a_repeated_row_at_the_cut_is_taken_in_part(documents, monkeypatch, few, expand):
    """A third of a source is one row, ids are null: the words still come near, and the mix holds what was decided."""
    monkeypatch.setattr(mixing, "EXPAND", expand)
    for seed in range(3):
        rng = random.Random(seed)
        rows = [(None, "ten words of a text that is here many times", "en", "a")] * 300
        rows += [(None, f"{i} " + "word " * rng.randrange(1, 12), rng.choice(["en", "de"]), "a") for i in range(300)]
        rows += [(5, "one and the same", rng.choice(["en", "de", None]), "b")] * 200 + [(i, f"text {i}", "en", None) for i in range(40)]
        docs = documents(rows, 5)
        got = mixed(docs, few=few).collect()
        check_mix(rows, got)
        want = Counter()
        for r in got:
            want[r.doc_id, r.size, r.source] += r.copies
        mix = repeated(docs, few=few)
        assert mix.columns == docs.columns
        assert Counter((r.doc_id, len(r.text.split()), r.source) for r in mix.collect()) == +want


def test_the_order_is_odds_over_odds(documents):
    """With priorities, documents of a higher one are taken more often, and the words still come near the target."""
    rows = [(i, "w " * 20, "en", "a" if i % 2 else "b") for i in range(2000)]
    docs = documents(rows)
    got = mixed(docs, weights=(1, 3), priority=F.when(F.col("doc_id") % 4 < 2, 3.0).otherwise(1.0)).collect()
    share = {s: {p: np.mean([r.copies for r in got if r.source == s and (r.doc_id % 4 < 2) == p]) for p in (True, False)} for s in "ab"}
    assert all(2 < share[s][True] / share[s][False] < 4.5 for s in "a")
    for s in "ab":
        taken, target = sum(r.taken for r in got if r.source == s), next(r.target for r in got if r.source == s)
        assert abs(taken - target) <= 20


def test_mix_of_odd_rows(odd, odd_rows, nothing):
    got = mixed(odd).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in odd_rows)
    mix = repeated(odd)
    assert mix.columns == odd.columns
    want = Counter()
    for r in got:
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mix.collect()) == +want
    assert mixed(nothing).collect() == [] and repeated(nothing).collect() == []
    assert {r.taken for r in mixed(odd.withColumn("text", F.lit(""))).collect()} == {0}
