"""Quality: Bradley-Terry pairwise ranking over text features.

A text's worth is a linear function of its features; the chance that one
text is preferred to another is the logistic function of the difference of
their worths. All labelled rows outside the held-out fold teach: their features are
dealt into groups by hash, and in a group every row meets ``PAIRS_PER_ROW`` rows of the
other class at least (rows of a rare class go to several groups). The weights are the optimum of
the logistic loss on these preference pairs (a text marked good over one marked bad), found by
Newton steps whose sums over all groups Spark takes. The worth that divides the labelled rows at the
share of bad ones is the threshold; the score is a logistic function of the worth that is ``CUT`` at
the threshold.

Defined results: NULL and empty texts have all features 0 and still get a
score; rows with a NULL label or id teach nothing; of several labels for one
document the smallest counts; with one class only in training, every score
is that class's smoothed share.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents, fold, labels, stored

CUT = 0.7
PAIRS_PER_ROW = 8
GROUP = 256  # labelled rows of a group, about
LEAST = 32  # rows of each class that a group has, about; of a rarer class all
STEPS = 30
PENALTY = 1e-3
UNIT = 1 << 20  # sums are taken in whole units, so that their order does not matter
BINS = 1024
_KINDS = np.zeros(256, np.int64)  # kind of each UTF-8 byte: 0 other letters, 1 lower, 2 upper, 3 digit, 4 space, 5 mark
_KINDS[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 5
_KINDS[[*range(0x00, 0x21), 0x7F]] = 4
_KINDS[0x30:0x3A], _KINDS[0x41:0x5B], _KINDS[0x61:0x7B] = 3, 2, 1
_COMMON = np.frombuffer(b".,;:'\"-!?()", np.uint8)
N_FEATURES = 20


def features(text: str | None) -> np.ndarray:
    """Features of a whole text: characters, words, lines and their repetition."""
    out = np.zeros(N_FEATURES)
    if not text:
        return out
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    bytes_ = np.bincount(data, minlength=256)
    kinds = np.bincount(_KINDS, bytes_, 6) / len(data)
    words = text.split()
    n = len(words)
    if not n:
        return out
    distinct = len(set(words))
    sizes = np.fromiter(map(len, words), np.float64, n)
    lines = text.split("\n")
    marks = max(kinds[5] * len(data), 1)
    rare = (kinds[5] * len(data) - bytes_[_COMMON].sum()) / n
    same = sum(map(str.__eq__, words, words[1:])) / n
    pairs = len(set(zip(words, words[1:]))) / max(n - 1, 1)
    alpha = sum(map(str.isalpha, words)) / n
    out[:] = (
        np.log1p(n), np.log1p(n) ** 2 / 10, kinds[0] + kinds[1], kinds[2], kinds[3], kinds[4], kinds[5],
        min(rare, 3.0), bytes_[_COMMON].sum() / marks, distinct / n, distinct / n ** 0.8, same, pairs, alpha,
        sizes.mean() / 10, min(sizes.std() / 10, 3.0), len(set(lines)) / len(lines), np.log1p(n / len(lines)),
        sum(map(str.isupper, words)) / n, min(bytes_[0x2E] / n, 1.0),
    )
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    shift: float  # the threshold
    spread: float

    def worth(self, x: np.ndarray) -> np.ndarray:
        return expand((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (self.worth(x) - self.shift) / self.spread + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def expand(z: np.ndarray) -> np.ndarray:
    """Standardised features, bounded, with their squares: both ends of a feature can be bad."""
    z = np.clip(z, -6, 6)
    return np.hstack([z, z ** 2 / 3])


def _sums(good: np.ndarray, bad: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Over the pairs of one group: their number, loss, gradient and second derivatives in a row."""
    k, m = len(w), max(len(good), len(bad))
    if not len(good) or not len(bad):
        return np.zeros(2 + k + k * k)
    at = np.arange(m)
    diff = np.concatenate([good[at % len(good)] - bad[(at + s) % len(bad)] for s in range(PAIRS_PER_ROW)])
    z = diff @ w
    p = 1 / (1 + np.exp(np.clip(z, -500, 500)))  # chance given to the wrong order
    return np.concatenate([[len(diff), np.logaddexp(0, -z).sum()], -(p @ diff),
                           ((diff * (p * (1 - p))[:, None]).T @ diff).ravel()])


def _weights(total: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Bradley-Terry weights by Newton steps, halved where the loss grows; ``total``: ``_sums`` over all groups."""
    k = 2 * N_FEATURES
    w, step, least, best = np.zeros(k), np.zeros(k), np.inf, np.zeros(k)
    for _ in range(STEPS):
        got = total(w)
        loss = got[1] / got[0] + PENALTY / 2 * (w @ w)
        if loss > least + 1e-9:
            step = step / 2
        else:
            least, best = loss, w
            step = -np.linalg.solve(got[2 + k:].reshape(k, k) / got[0] + PENALTY * np.eye(k), got[2: 2 + k] / got[0] + PENALTY * w)
        if np.abs(step).max() < 1e-4:
            break
        w = best + step
    return best


def _one_class(mean: np.ndarray, scale: np.ndarray, bad: int, good: int) -> Model:
    share = (good + 1) / (bad + good + 2)
    return Model(mean, scale, np.zeros(2 * N_FEATURES), float(np.log(CUT / (1 - CUT)) - np.log(share / (1 - share))), 1.0)


def train(x: np.ndarray, y: np.ndarray, bad_share: float) -> Model:
    """The model of one group of rows."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = expand((x - mean) / scale)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return _one_class(mean, scale, len(bad), len(good))
    w = _weights(lambda v: _sums(z[good], z[bad], v))
    worth = z @ w
    # the classes' shares may be others than those of the rows
    weight = np.where(y == 0, bad_share / len(bad), (1 - bad_share) / len(good))
    order = np.argsort(worth)
    at = min(int(np.searchsorted(np.cumsum(weight[order]), bad_share)), len(order) - 1)
    lower = worth[order[max(at - 1, 0)]]
    return Model(mean, scale, w, float((worth[order[at]] + lower) / 2), float(max(worth.std(), 1e-6) / 2))


def _matrix(column) -> np.ndarray:
    """Features of the rows, kept as bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, N_FEATURES)


def _grouped(own: DataFrame, bad: int, good: int) -> DataFrame:
    """(g, bad, good): features of the rows of each group by class, in a fixed order."""
    n = max(1, (bad + good) // GROUP)
    copies = [min(n, -(-LEAST * n // c)) for c in (bad, good)]
    first = F.pmod(F.xxhash64("doc_id", "x"), F.lit(n))
    each = F.sequence(F.lit(0), F.when(F.col("y") == 1, copies[1]).otherwise(copies[0]) - 1)
    dealt = own.select("y", "x", F.xxhash64("x", "doc_id").alias("h"), first.alias("first"), F.explode(each).alias("j"))
    of = lambda c: F.sort_array(F.collect_list(F.when(F.col("y") == c, F.struct("h", "x"))))["x"]
    return dealt.groupBy(((F.col("first") + F.col("j")) % n).alias("g")).agg(of(0).alias("bad"), of(1).alias("good"))


def _total(groups: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``_sums`` over all groups."""
    def run(batches):
        for batch in batches:
            total = np.zeros(2 + len(w) + len(w) ** 2, np.int64)
            for pair in zip(batch["good"], batch["bad"]):
                rows = [expand((_matrix(pa.array(c.as_py(), pa.binary())) - mean) / scale) for c in pair]
                total += np.rint(_sums(*rows, w) * UNIT).astype(np.int64)
            yield pa.record_batch({"at": pa.array(np.arange(len(total))), "v": pa.array(total)})

    got = groups.mapInArrow(run, "at long, v long").groupBy("at").agg(F.sum("v").alias("v")).toPandas()
    return got.sort_values("at")["v"].to_numpy(np.float64) / UNIT


def value_at(rows: DataFrame, name: str, place: int) -> float:
    """The value at ``place`` (from 0) of the sorted column: counts in bins, then in finer ones around the place."""
    low, high = rows.agg(F.min(name), F.max(name)).first()
    while low < high:
        # both ends of the range are values: every turn leaves some out
        bin_ = F.least(F.floor((F.col(name) - low) / (high - low) * BINS), F.lit(BINS - 1))
        found = (rows.where(F.col(name).between(low, high)).groupBy(bin_.alias("bin"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("low"), F.max(name).alias("high")).orderBy("bin").collect())
        for r in found:
            if place < r["n"]:
                low, high = r["low"], r["high"]
                break
            place -= r["n"]
    return low


def learn(rows: DataFrame, marks: DataFrame) -> Model:
    """Model from all labelled rows: features (doc_id, x) and labels (doc_id, y)."""
    own = stored(rows.join(marks, "doc_id").select("doc_id", "y", "x"), "quality-labelled")

    def moments(batches):
        for batch in batches:
            x = _matrix(batch["x"])
            total = np.rint(np.concatenate([x, x ** 2], axis=1) * UNIT).astype(np.int64).sum(axis=0)
            good = int(batch["y"].to_numpy().sum())
            yield pa.record_batch({"at": pa.array(np.arange(len(total) + 2)),
                                   "v": pa.array(np.concatenate([[len(x) - good, good], total]))})

    got = own.mapInArrow(moments, "at long, v long").groupBy("at").agg(F.sum("v").alias("v")).toPandas().sort_values("at")["v"].to_numpy()
    if not len(got):
        return _one_class(np.zeros(N_FEATURES), np.ones(N_FEATURES), 0, 1)
    bad, good = map(int, got[:2])
    mean, square = np.split(got[2:] / UNIT / (bad + good), 2)
    scale = np.sqrt(np.maximum(square - mean ** 2, 0)) + 1e-6
    if not bad or not good:
        return _one_class(mean, scale, bad, good)
    groups = stored(_grouped(own, bad, good), "quality-groups")
    w = _weights(lambda v: _total(groups, mean, scale, v))
    model = Model(mean, scale, w, 0.0, 1.0)

    def worths(batches):
        for batch in batches:
            yield pa.record_batch({"worth": pa.array(model.worth(_matrix(batch["x"])))})

    found = stored(own.select("x").mapInArrow(worths, "worth double"), "quality-worths")
    threshold = (value_at(found, "worth", bad - 1) + value_at(found, "worth", bad)) / 2
    spread = found.agg(F.stddev_pop("worth")).first()[0]
    return Model(mean, scale, w, float(threshold), max(spread, 1e-6) / 2)


def featured(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the features of every whole text, as bytes."""
    def run(batches):
        for batch in batches:
            x = [features(t).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(x, pa.binary())], names=["doc_id", "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, x binary")


def rated(rows: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of features (doc_id, x)."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.score(_matrix(batch["x"])))],
                                             names=["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text."""
    return rated(featured(docs), model)


def marked(marks: DataFrame) -> DataFrame:
    """(doc_id, y) of quality labels outside the held-out fold."""
    own = marks.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", 4) != 2))
    return own.groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("y"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text; labels of the held-out fold are not read."""
    rows = stored(featured(documents(spark, sf_dir)), "quality-features")
    model = learn(rows, marked(labels(spark, sf_dir)))
    return rated(rows, model).select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                                     "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
