"""Operator 8: language identification in two steps, family first.

Step 1 tells language families apart, by one linear support vector machine per family against the rest. Step 2
tells the languages of the family apart, one machine for each pair, by votes and then by margins.

A text is the square roots of its shares of byte 1- to 4-grams of its letters, hashed to ``width`` places: each n-gram
length has its own part of the vector. Machines minimise the squared hinge loss with an L2 penalty.

Learning takes at most ``per_language`` rows of each language, those with the least hash of their id (a
documented bound on what reaches the driver). The window that picks them keeps at most that many rows of a
language in each task, so a language with a third of all rows is no hot spot. Scoring is one pass over all rows,
without a shuffle; whole texts count.

Null texts and texts without a letter are ``und``, with score 0. Rows with a null lang or id are not learned from.
With one language learned, every text with a letter is that; with none, ``und``. Empty tables give no rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from claimwright.llm.common import crc_bucket, map_batches

UNDETERMINED = "und"
#: Which languages are close relatives. Any other language is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is"),
    "romance": ("fr", "es", "it", "pt", "ca", "gl", "ro"),
    "slavic": ("ru", "uk", "be", "bg", "pl", "cs", "sk", "sl", "hr", "sr"),
}
WIDTH = 4096
_LETTER = regex.compile(r"\p{L}")
# Bytes of words as they stand, ASCII capitals as small letters, everything else as one separator.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def family_of(language: str) -> str:
    return next((f for f, members in FAMILIES.items() if language in members), language)


def features(text: str, width: int = WIDTH) -> np.ndarray:
    raw = np.frombuffer(b" " + b" ".join(text.encode().translate(_FOLD).split()) + b" ", np.uint8).astype(np.uint32)
    out = np.zeros(width, np.float32)
    part, code = width // 4, np.zeros(len(raw), np.uint32)
    for n in range(1, 5):
        if len(raw) < n:
            break
        code = code[: len(raw) - n + 1] * np.uint32(257) + raw[n - 1 :]
        place = (code * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(part)
        counts = np.bincount(place, minlength=part)
        out[(n - 1) * part : n * part] = np.sqrt(counts / counts.sum())
    return out / 2


@dataclass(frozen=True)
class Machine:
    weights: np.ndarray
    offset: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.offset


def fit_machine(x: np.ndarray, y: np.ndarray, c: float = 30.0, steps: int = 80) -> Machine:
    """y: 1 or -1. Accelerated gradient steps on the primal squared hinge; both classes weigh the same."""
    n, width = x.shape
    x = np.ascontiguousarray(x, np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, v, t = np.zeros(width + 1), np.zeros(width + 1), 1.0
    rate = 1 / (1 + 2 * c * 2)  # rows have a norm of 1, 2 squared with the offset
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v[:-1].astype(np.float32) + v[-1]))
        pull = -2 * c * weight * y * slack
        new = v - rate * (v * np.append(np.ones(width), 0.0) + np.append(pull.astype(np.float32) @ x, pull.sum()))
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / s * (new - w), new, s
    return Machine(w[:-1].astype(np.float32), float(w[-1]))


@dataclass(frozen=True)
class Model:
    families: dict[str, tuple[str, ...]]
    of_family: dict[str, Machine]
    of_pair: dict[tuple[str, str], Machine]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(x)
        if not self.families:
            return [UNDETERMINED] * n, np.zeros(n)
        names = sorted(self.families)
        if len(names) > 1:
            margins = np.stack([self.of_family[f].margin(x) for f in names], axis=1)
            chosen, sure = margins.argmax(axis=1), margins.max(axis=1)
        else:
            chosen, sure = np.zeros(n, int), np.full(n, 3.0)
        out, score = np.empty(n, object), sure.copy()
        for k, f in enumerate(names):
            rows, members = np.nonzero(chosen == k)[0], self.families[f]
            votes, total = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            for a, b in combinations(range(len(members)), 2):
                m = self.of_pair[members[a], members[b]].margin(x[rows])
                votes[:, a] += m > 0
                votes[:, b] += m <= 0
                total[:, a] += np.tanh(m)
                total[:, b] -= np.tanh(m)
            best = (votes + total / (2 * len(members))).argmax(axis=1)
            out[rows] = np.array(members, object)[best]
            if len(members) > 1:
                score[rows] = np.minimum(sure[rows], total[np.arange(len(rows)), best] * 3 / (len(members) - 1))
        return out.tolist(), 1 / (1 + np.exp(-2 * np.clip(score, -15, 15)))


def fit(x: np.ndarray, language: list[str]) -> Model:
    known = sorted(set(language))
    families: dict[str, tuple[str, ...]] = {}
    for lang in known:
        families[family_of(lang)] = (*families.get(family_of(lang), ()), lang)
    lang = np.array(language, object)
    family = np.array([family_of(a) for a in language], object)
    of_family = {f: fit_machine(x, np.where(family == f, 1.0, -1.0)) for f in families} if len(families) > 1 else {}
    of_pair = {}
    for members in families.values():
        for a, b in combinations(members, 2):
            rows = (lang == a) | (lang == b)
            of_pair[a, b] = fit_machine(x[rows], np.where(lang[rows] == a, 1.0, -1.0))
    return Model(families, of_family, of_pair)


def learn(docs: DataFrame, learned: Column, per_language: int = 400) -> Model:
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & learned & F.col("text").rlike(r"\p{L}"))
    order = [F.md5(F.col("doc_id").cast("string")), F.col("doc_id")]
    ids = rows.select("doc_id", "lang").distinct().withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    for keys in (("lang", "part"), ("lang",)):  # the first rows of a language are among those of its parts
        ids = ids.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("n") <= per_language)
    chosen = rows.join(F.broadcast(ids.select("doc_id", "lang")), ["doc_id", "lang"]).withColumn("mark", F.xxhash64("text"))
    # Where an id repeats, its text with the least hash stands for it, so that the bound holds for rows as well.
    least = chosen.groupBy("doc_id", "lang").agg(F.min("mark").alias("mark"))
    chosen = chosen.join(F.broadcast(least), ["doc_id", "lang", "mark"]).select("doc_id", "lang", "text")

    def batch(part: pa.RecordBatch) -> pa.RecordBatch:
        x = [zlib.compress(features(t).tobytes(), 1) for t in part.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), pa.array(x, pa.binary())], names=["doc_id", "lang", "x"])

    found = map_batches(chosen, batch, "doc_id bigint, lang string, x binary").dropDuplicates(["doc_id", "lang"])  # copies of one text
    found = found.toArrow().sort_by([("lang", "ascending"), ("doc_id", "ascending")])
    if not found.num_rows:
        return Model({}, {}, {})
    x = np.stack([np.frombuffer(zlib.decompress(b), np.float32) for b in found["x"].to_pylist()])
    return fit(x, found["lang"].to_pylist())


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every whole text."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = rows.column("text").to_pylist()
        lettered = [k for k, t in enumerate(texts) if t is not None and _LETTER.search(t)]
        lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        for at in range(0, len(lettered), 1024):
            part = lettered[at : at + 1024]
            found, sure = model.predict(np.stack([features(texts[k]) for k in part]))
            score[part] = sure
            for k, name in zip(part, found):
                lang[k] = name
        return pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return map_batches(docs.select("doc_id", F.col("text").cast("string").alias("text")), batch, "doc_id bigint, lang_pred string, score double")


def held_out() -> Column:
    """The contract's rows that are never learned from."""
    return crc_bucket("doc_id", 4) == 2


def languages(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    model = learn(docs, ~held_out(), **settings)
    return predicted(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
