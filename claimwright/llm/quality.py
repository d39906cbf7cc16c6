"""Operator 5: a quality classifier by Bradley-Terry pairwise ranking.

A document's score is w . x of its text's features x. The weights make preferred documents (label 1) score above
the others (label 0): for pairs (i, j) the model says P(i before j) = sigmoid(w . (x_i - x_j)), and the
logistic loss over the pairs is minimised by Newton steps. The threshold is a quantile of the learning rows'
scores, at the share that label 0 has among them; the result is sigmoid(score - threshold), 0.5 at the threshold.

Learning takes every row with a label, and each is in ``rounds`` pairs or more. Up to ``PAIRED`` rows of a label meet in the
driver. Beyond that the rows are dealt to blocks by a hash of the id and the text, and pairs are made within a block; a row
of a label too rare for all blocks is in several. Every sum over the pairs is made block by block where the blocks lie, and
the quantile by four counts of the scores' leading bits, so the driver holds some thousand numbers, whatever the table.
``per_label`` bounds the rows of each label (those with the least hash of their id), for a model in a hurry. Features are
made once, for learning and for scoring, and stored; scoring is one pass without a shuffle.

A null or empty text has features like any other (all zero shares). Rows whose label is null, or whose id is
null, are not learned from. Where one label has no rows there are no pairs, every score is 0.5 and every
document is kept. Ids that repeat with different labels are learned with each, and with each different text; copies of
a text under one id are one row. Empty tables give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from claimwright.llm.common import carried, crc_bucket, map_batches, stored, whole_texts

FEATURES = (
    "few_words", "more_words", "word_length", "long_words", "short_words", "distinct_words", "top_word", "word_runs", "distinct_pairs",
    "capitals", "all_capitals", "digits", "symbols", "bars", "exclamations", "commas", "full_stops", "spaces", "non_ascii",
    "line_length", "distinct_lines", "closed_lines", "symbol_runs", "byte_entropy", "odd_word_ends", "evidence",
)
PAIRED = 4000  # rows of the larger label in a block
RARE = 64  # rows of the smaller label that a block is to hold; where there are fewer, it holds them all
FOLDS = 256  # sums of blocks that reach the driver at once
FEW = 6  # words at which shares count for half of what they count for in a long text

_CLASS = np.zeros(256, np.int8)  # 0 small letters and other bytes, else as named below
for _i, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#$%&*+<=>@[\\]^_`{}~/", b"|", b"!?", b",;:", b".", b" \t\n\r\x0b\x0c"), 1):
    _CLASS[list(_chars)] = _i
_CLASS[128:] = 9


def features(text: str) -> list[float]:
    """Shares and averages over the whole text, in the order of FEATURES."""
    words, lines = text.split(), text.split("\n")
    raw = np.frombuffer(text.encode(), np.uint8)
    if not words:
        return [0.0] * len(FEATURES)  # no evidence: the score of the mean
    n, counts = len(words), Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    bytes_ = np.bincount(raw, minlength=256)
    kinds = np.bincount(_CLASS, weights=bytes_, minlength=10) / len(raw)
    shares = bytes_[bytes_ > 0] / len(raw)
    pairs = max(1, n - 1)
    symbol = (_CLASS[raw] == 3) | (_CLASS[raw] == 5)
    return [
        min(1.0, 8 / n), np.log1p(n) / 10, lengths.mean() / 10, (lengths > 12).mean(), (lengths < 4).mean(),
        np.log(len(counts)) / np.log(n) if n > 1 else 1.0, (max(counts.values()) - 1) / n, sum(map(eq, words, words[1:])) / pairs,
        np.log(len(set(zip(words, words[1:]))) + 1) / np.log(n + 1),
        kinds[1], sum(w.isupper() and len(w) > 1 for w in counts) / len(counts), kinds[2], kinds[3], kinds[4], kinds[5], kinds[6], kinds[7], kinds[8],
        kinds[9], np.log1p(len(text) / len(lines)) / 10, len(set(lines)) / len(lines),
        sum(x.rstrip()[-1:] in (".", "!", "?") for x in lines) / len(lines), float((symbol[1:] & symbol[:-1]).mean()) if len(raw) > 1 else 0.0,
        float(-(shares * np.log2(shares)).sum()) / 8, sum(not w[-1].isalnum() and w[-1] not in ".," for w in counts) / len(counts),
        n / (n + FEW),
    ]


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float

    def ranked(self, x: np.ndarray) -> np.ndarray:
        return (standard(x, self.mean, self.spread) * self.weights).sum(axis=1)  # row by row: not a matter of the batch

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.ranked(x) - self.threshold, -30, 30)))


def standard(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Distances from the mean in spreads; those of a short text, whose shares say little, are drawn in."""
    return np.clip((x - mean) / spread, -8, 8) * x[:, -1:]


def differences(good: np.ndarray, poor: np.ndarray, rounds: int, seed) -> np.ndarray:
    """Of pairs of a row of each side. Each row is in as many pairs as any other of its side, give or take one."""
    rng, n = np.random.default_rng(seed), rounds * max(len(good), len(poor))
    i, j = (np.concatenate([rng.permutation(len(a)) for _ in range(-(-n // len(a)))])[:n] for a in (good, poor))
    return good[i] - poor[j]


def slopes(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the loss at ``w``, summed over the pairs."""
    p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
    return d.T @ (p - 1), (d * (p * (1 - p))[:, None]).T @ d


def descend(at: Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]], ridge: float, steps: int) -> np.ndarray:
    """Newton steps to the weights of least loss. at: the number of pairs, and their slopes at some weights."""
    w = np.zeros(len(FEATURES))
    for _ in range(steps):
        n, gradient, curvature = at(w)
        step = np.linalg.solve(curvature / n + ridge * np.eye(len(w)), gradient / n + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def level(spread: np.ndarray) -> np.ndarray:
    return np.where(spread > 1e-9, spread, 1.0)


def no_model() -> Model:
    width = len(FEATURES)
    return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0)


def fit(x: np.ndarray, label: np.ndarray, rounds: int = 8, ridge: float = 1e-3, steps: int = 25, seed: int = 5) -> Model:
    """Weights from pairs of a label 1 and a label 0 row; threshold from the quantile at label 0's share."""
    good, poor = x[label == 1], x[label == 0]
    if not len(good) or not len(poor):
        return no_model()
    mean, spread = x.mean(axis=0), level(x.std(axis=0))
    good, poor = standard(good, mean, spread), standard(poor, mean, spread)
    d = differences(good, poor, rounds, seed)
    w = descend(lambda w: (len(d), *slopes(d, w)), ridge, steps)
    scores = np.concatenate([good @ w, poor @ w])
    return Model(mean, spread, w, float(np.quantile(scores, len(poor) / len(scores))))


# Blocks -----------------------------------------------------------------------------------

_ROWS = {"label": np.int8, "own": bool, "x": np.float64}  # own: the block is the row's first


def in_blocks(rows: DataFrame, blocks: int, rare: int, copies: int) -> DataFrame:
    """One row for each block, with its rows' labels and features as bytes. Rows of the label ``rare`` are in ``copies`` blocks."""
    again = F.explode(F.sequence(F.lit(0), F.when(F.col("label") == rare, copies - 1).otherwise(0))).alias("copy")
    dealt = rows.select("doc_id", "mark", "label", "x", again)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("doc_id", "mark") + F.col("copy"), F.lit(blocks)).cast("int"))

    def pack(t: pa.Table) -> pa.Table:
        t = t.combine_chunks().sort_by([("label", "ascending"), ("doc_id", "ascending"), ("mark", "ascending")])
        held = {"label": t["label"].to_numpy(), "own": t["copy"].to_numpy() == 0, "x": matrix(t["x"])}
        return pa.table({"block": pa.array([t["block"][0].as_py()], pa.int32()), **{c: [held[c].astype(kind).tobytes()] for c, kind in _ROWS.items()}})

    return dealt.groupBy("block").applyInArrow(pack, "block int, label binary, own binary, x binary")


def matrix(x: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.array(x.combine_chunks().flatten() if isinstance(x, pa.ChunkedArray) else x.flatten(), float).reshape(-1, len(FEATURES))


def opened(rows: pa.RecordBatch):
    """Number, labels, marks of own rows and features of every block."""
    for r in rows.to_pylist():
        label, own, x = (np.frombuffer(r[c], kind) for c, kind in _ROWS.items())
        yield r["block"], label, own, x.reshape(-1, len(FEATURES))


def summed(blocks: DataFrame, number: int, of: Callable[..., np.ndarray]) -> np.ndarray:
    """Sum over the blocks of the numbers that ``of`` gives, always added in one order."""
    schema = "block int, sums array<double>"

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        found = [(block, of(block, label, own, x)) for block, label, own, x in opened(rows)]
        return pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int32()), pa.array([s.tolist() for _, s in found], pa.list_(pa.float64()))], names=["block", "sums"])

    def fold(t: pa.Table) -> pa.Table:
        return pa.table({"block": pa.array([t["block"][0].as_py() % FOLDS], pa.int32()), "sums": pa.array([total(t).tolist()], pa.list_(pa.float64()))})

    def total(t: pa.Table) -> np.ndarray:
        return np.array(t.sort_by("block")["sums"].to_pylist(), float).sum(axis=0)

    sums = map_batches(blocks, batch, schema)
    if number > FOLDS:
        sums = sums.groupBy(F.pmod("block", F.lit(FOLDS))).applyInArrow(fold, schema)
    return total(sums.toArrow())


def fit_blocks(blocks: DataFrame, number: int, rounds: int = 8, ridge: float = 1e-3, steps: int = 25, seed: int = 5) -> Model:
    """As ``fit``, of rows in blocks and with pairs within them; no threshold yet."""
    width = len(FEATURES)
    counted = summed(blocks, number, lambda block, label, own, x: np.array([own.sum(), *x[own].sum(axis=0)]))
    mean = counted[1:] / counted[0]
    spread = level(np.sqrt(summed(blocks, number, lambda block, label, own, x: ((x[own] - mean) ** 2).sum(axis=0)) / counted[0]))

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def of(block: int, label: np.ndarray, own: np.ndarray, x: np.ndarray) -> np.ndarray:
            if label.all() or not label.any():
                return np.zeros(1 + width + width * width)
            z = standard(x, mean, spread)
            d = differences(z[label == 1], z[label == 0], rounds, [seed, block])
            gradient, curvature = slopes(d, w)
            return np.array([len(d), *gradient, *curvature.ravel()])

        found = summed(blocks, number, of)
        return found[0], found[1 : 1 + width], found[1 + width :].reshape(width, width)

    return Model(mean, spread, descend(at, ridge, steps), 0.0)


def ordered_bits(z: np.ndarray) -> np.ndarray:
    """Numbers without a sign that are in the order of ``z``."""
    bits = np.ascontiguousarray(z, np.float64).view(np.int64)
    return (bits ^ ((bits >> 63) & np.int64(2**63 - 1))).view(np.uint64) ^ np.uint64(2**63)


def from_ordered_bits(key: int) -> float:
    bits = np.array([key ^ 2**63], np.uint64).view(np.int64)
    return float((bits ^ ((bits >> 63) & np.int64(2**63 - 1))).view(np.float64)[0])


def quantile(blocks: DataFrame, model: Model, weight: tuple[float, float], share: float) -> float:
    """The least score up to which ``share`` of the weight lies; rows weigh by label. The score is found by 16 bits at a time."""
    found, below, whole = 0, 0.0, 0.0
    for shift in (48, 32, 16, 0):

        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            digits, ones = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for _, label, own, x in opened(rows):
                key = ordered_bits(model.ranked(x[own]))
                here = np.ones(len(key), bool) if shift == 48 else key >> np.uint64(shift + 16) == np.uint64(found)
                digits.append((key[here] >> np.uint64(shift) & np.uint64(0xFFFF)).astype(np.int64))
                ones.append(label[own][here].astype(np.int64))
            both, counts = np.unique(np.concatenate(digits) * 2 + np.concatenate(ones), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(both // 2, pa.int32()), pa.array(counts * (1 - both % 2), pa.int64()), pa.array(counts * (both % 2), pa.int64())], names=["digit", "zeros", "ones"])

        counts = map_batches(blocks, batch, "digit int, zeros bigint, ones bigint").groupBy("digit").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
        counts = counts.toArrow().sort_by("digit")
        upto = below + np.cumsum(counts["zeros"].to_numpy() * weight[0] + counts["ones"].to_numpy() * weight[1])
        whole = whole or upto[-1]
        at = min(int(np.searchsorted(upto, share * whole)), len(upto) - 1)
        found = found << 16 | counts["digit"][at].as_py()
        below = upto[at - 1] if at else below
    return from_ordered_bits(found)


# ------------------------------------------------------------------------------------------


def with_features(docs: DataFrame) -> DataFrame:
    """doc_id, mark (a hash of the text) and x of every whole text."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        x = pa.array([features(t) for t in rows.column("text").to_pylist()], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("mark"), x], names=["doc_id", "mark", "x"])

    return map_batches(whole_texts(docs).select("doc_id", F.xxhash64("text").alias("mark"), "text"), batch, "doc_id bigint, mark bigint, x array<double>")


def learn(docs: DataFrame, labels: DataFrame, learned: Column, per_label: int | None = None, **settings) -> Model:
    """labels: doc_id, quality. learned: a condition on doc_id. per_label: most rows of a label, by default all."""
    return learn_rows(with_features(docs), labels, learned, per_label, **settings)


def learn_rows(rows: DataFrame, labels: DataFrame, learned: Column, per_label: int | None = None, **settings) -> Model:
    """As ``learn``, from the rows of ``with_features``. The label 0 share is that of the labels, also if rows are bounded."""
    named = labels.select("doc_id", F.col("quality").cast("int").alias("label")).filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & learned).distinct()
    share = {r["label"]: r["n"] for r in named.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    if not min(share.get(0, 0), share.get(1, 0)):
        return no_model()
    if per_label is None:
        found = rows.join(named, "doc_id").dropDuplicates(["doc_id", "label", "mark"])
    else:
        by_hash = [named.filter(F.col("label") == label).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(per_label) for label in (0, 1)]
        found = rows.join(F.broadcast(by_hash[0].unionByName(by_hash[1])), "doc_id")
        # Where an id repeats, its text with the least hash stands for it, so that the bound holds for rows as well.
        found = found.groupBy("doc_id", "label").agg(F.min(F.struct("mark", "x")).alias("least")).select("doc_id", "label", "least.mark", "least.x")
    found = stored(found.select("doc_id", "label", "mark", "x"), "quality-learned")
    counts = {r["label"]: r["n"] for r in found.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    fewer, more = sorted((0, 1), key=lambda label: counts.get(label, 0))
    if not counts.get(fewer, 0):
        return no_model()
    # The quantile counts rows as often as they stand for, where the bound or absent documents thinned one label more.
    weight = (share[0] / counts[0], share[1] / counts[1])
    number = -(-counts[more] // PAIRED)
    if number > 1:
        copies = min(number, -(-RARE * number // counts[fewer]))
        blocks = stored(in_blocks(found, number, fewer, copies), "quality-blocks")
        model = fit_blocks(blocks, number, **settings)
        return Model(model.mean, model.spread, model.weights, quantile(blocks, model, weight, share[0] / (share[0] + share[1])))
    few = found.toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending"), ("mark", "ascending")])  # the same model at every rerun
    x, label = matrix(few["x"]), few["label"].to_numpy()
    model = fit(x, label, **settings)
    z = model.ranked(x)
    at = np.argsort(z, kind="stable")
    each = np.where(label == 0, *weight)
    upto = np.cumsum(each[at]) / each.sum()
    return Model(model.mean, model.spread, model.weights, float(z[at][np.searchsorted(upto, share[0] / (share[0] + share[1]))]))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted of every whole text."""
    return scored_rows(with_features(docs), model)


def scored_rows(rows: DataFrame, model: Model) -> DataFrame:
    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        s = model.scores(matrix(rows.column("x")))
        return pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return map_batches(rows.select("doc_id", "x"), batch, "doc_id bigint, score double, predicted int")


def held_out() -> Column:
    """The contract's rows that are never learned from."""
    return crc_bucket("doc_id", 3) == 1


def quality(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    rows = stored(with_features(docs), "quality-features")
    model = learn_rows(rows, labels, ~held_out(), **settings)
    return scored_rows(rows, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The documents that are not rejected, with all their columns, which are stored beside their features: no join."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = stored(carried(docs, "doc_id", F.xxhash64(text).alias("mark"), _features(text).alias("x")), "quality-features")
    model = learn_rows(rows.select("doc_id", "mark", "x"), labels, ~held_out(), **settings)
    return rows.filter(_scorer(model)("x") >= 0.5).select("whole_row.*")


@F.pandas_udf(ArrayType(DoubleType()))
def _features(texts: pd.Series) -> pd.Series:
    return texts.map(features)


def _scorer(model: Model) -> Callable[[Column], Column]:
    @F.pandas_udf("double")
    def score(rows: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array(rows.to_list(), float).reshape(-1, len(FEATURES))))

    return score
