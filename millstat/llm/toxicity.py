"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the mean of the embeddings of its hashed character n-grams, a text
the mean of its words; a linear softmax over two classes scores it.
Embeddings and softmax are trained together in numpy, so a misspelling or an
unseen ending shares the vectors of the n-grams it has in common. Because
the model is linear after the averages, scoring needs one number per distinct
word and a mean per text. Only n-grams whose share of texts differs between the
classes by ``MIN_Z`` standard errors are learned, the others count as 0: a toxic
word is some 2 % of a text, which the chance weights of tens of thousands of
n-grams would cover.

Training reads a bounded, documented sample: about ``MAX_PER_CLASS`` rows of
each label, chosen by hash; the softmax bias is then corrected for the share
of each class that was taken.

Defined results: NULL, empty and letterless texts get the score of the bias
alone; rows with a NULL label or id teach nothing; of several labels for one
document the largest counts; with one class only in training, its smoothed
share is every text's score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents, fold, labels, stored
from .words import WordTable, char_ngrams, chunks

SIZES = (3, 4, 5)
BUCKETS = 1 << 17
DIM = 8
EPOCHS = 30
BATCH = 64
RATE = 1.0
MIN_DOCS = 3
MIN_Z = 3.0  # standard errors between the classes' shares of texts with an n-gram that is learned
MAX_PER_CLASS = 2000
PRIOR_WEIGHT = 0.25  # the averaged logit is flatter than a log-likelihood, so is its prior


def clean(word: str) -> str:
    return word if word.isalpha() else "".join(c for c in word if c.isalnum())


@dataclass
class Model:
    weights: np.ndarray  # per bucket: its embedding times the softmax difference
    bias: float

    def word_rows(self, words: list[str]) -> np.ndarray:
        """Per word: (mean of its n-grams' weights, 1), or zeros for a word without letters or digits."""
        text = [clean(w) for w in words]
        bucket, owner = char_ngrams(text, SIZES, BUCKETS)
        n = np.maximum(np.bincount(owner, minlength=len(words)), 1)
        counted = np.fromiter(map(bool, text), np.float64, len(text))
        return np.stack([np.bincount(owner, self.weights[bucket], len(words)) / n * counted, counted], axis=1)

    def score(self, table: WordTable, texts: list) -> np.ndarray:
        out = np.zeros(len(texts))
        for start, end in chunks(texts):
            split = [(t or "").lower().split() for t in texts[start:end]]
            at = table.lookup([w for words in split for w in words])
            if len(at):
                sizes = np.fromiter(map(len, split), np.int64, len(split))
                owner = np.repeat(np.arange(len(split)), sizes)
                rows = table.rows[at]
                total = np.bincount(owner, rows[:, 0], len(split))
                out[start:end] = total / np.maximum(np.bincount(owner, rows[:, 1], len(split)), 1)
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -40, 40)))


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a whole text and the weight of each in its average."""
    words: dict[str, int] = {}
    for w in (text or "").lower().split():
        w = clean(w)
        if w:
            words[w] = words.get(w, 0) + 1
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    bucket, owner = char_ngrams(list(words), SIZES, BUCKETS)
    times = np.fromiter(words.values(), np.float64, len(words))
    weight = times[owner] / np.bincount(owner, minlength=len(words))[owner] / times.sum()
    ids, inverse = np.unique(bucket, return_inverse=True)
    return ids.astype(np.int32), np.bincount(inverse, weight).astype(np.float32)


def train(texts: list, y: np.ndarray, taken: tuple[float, float] = (1.0, 1.0), epochs: int = EPOCHS,
          rate: float = RATE, seed: int = 7) -> Model:
    """Joint training of embeddings and softmax with Adagrad; ``taken``: sampled share of class 0 and 1."""
    n1 = int(y.sum())
    if n1 in (0, len(y)):
        return Model(np.zeros(BUCKETS), float(np.log((n1 + 1) / (len(y) - n1 + 1))))
    bags = [bag(t) for t in texts]
    n0 = len(y) - n1
    pos, neg = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for (ids, _), label in zip(bags, y):
        (pos if label else neg)[ids] += 1
    share = (pos + neg) / len(y)
    error = np.sqrt(np.maximum(share * (1 - share) * (1 / n1 + 1 / n0), 1e-12))
    # z is at most the root of the number of texts
    known = ((pos + neg >= min(MIN_DOCS, max(1, n1 // 4)))
             & (np.abs(pos / n1 - neg / n0) / error >= min(MIN_Z, len(y) ** 0.5 / 2)))
    bags = [(ids[known[ids]], w[known[ids]]) for ids, w in bags]
    sizes = np.array([len(ids) for ids, _ in bags])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.concatenate([b for b, _ in bags])
    weights = np.concatenate([w for _, w in bags])
    rng = np.random.default_rng(seed)
    emb = ((rng.random((BUCKETS, DIM)) - 0.5) / DIM).astype(np.float32)
    # the first dimension starts at the smoothed log-ratio of the classes that the n-gram occurs in
    emb[:, 0] = np.where(known, np.log((pos + 1) / (n1 + 2)) - np.log((neg + 1) / (n0 + 2)), 0)
    soft = np.zeros((DIM, 2), np.float32)
    soft[0] = (-4.0, 4.0)
    bias = np.zeros(2)
    g_emb, g_soft, g_bias = np.full_like(emb, 1e-8), np.full_like(soft, 1e-8), np.full(2, 1e-8)
    balance = np.where(y == 1, len(y) / (2 * n1), len(y) / (2 * n0))
    for epoch in range(epochs):
        for docs in np.array_split(rng.permutation(len(y)), -(-len(y) // BATCH)):
            at = np.concatenate([np.arange(starts[d], starts[d + 1]) for d in docs])
            owner = np.repeat(np.arange(len(docs)), sizes[docs])
            rows, inverse = np.unique(ids[at], return_inverse=True)
            local, w = emb[rows], weights[at]
            x = np.stack([np.bincount(owner, w * local[inverse, k], len(docs)) for k in range(DIM)], axis=1)
            z = x @ soft + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(docs)), y[docs]] -= 1
            p *= (balance[docs] / len(docs))[:, None]
            d_soft, d_bias, d_x = x.T @ p, p.sum(axis=0), (p @ soft.T)
            for param, grad, acc in ((soft, d_soft, g_soft), (bias, d_bias, g_bias)):
                acc += grad ** 2
                param -= rate * grad / np.sqrt(acc)
            grad = np.stack([np.bincount(inverse, w * d_x[owner, k], len(rows)) for k in range(DIM)], axis=1)
            g_emb[rows] += grad ** 2
            emb[rows] -= 0.2 * rate * grad / np.sqrt(g_emb[rows])
    diff = soft[:, 1] - soft[:, 0]
    # classes were balanced by weight: back to their shares among the labelled rows
    prior = np.log((n1 / taken[1]) / (n0 / taken[0]))
    return Model((emb @ diff).astype(np.float64) * known, float(bias[1] - bias[0] + PRIOR_WEIGHT * prior))


def labelled(docs: DataFrame, y: DataFrame, per_class: int) -> tuple[DataFrame, tuple[float, float]]:
    """(doc_id, text, y) of about ``per_class`` labelled documents of each class (a share by hash), and the shares taken.

    ``y``: (doc_id, y). The draw reads labels only and is written, so that the few drawn ids
    go to the documents and no text is shuffled.
    """
    counts = {r["y"]: r["n"] for r in y.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = tuple(min(1.0, per_class / max(counts.get(k, 0), 1)) for k in (0, 1))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    limit = F.when(F.col("y") == 1, int(taken[1] * (1 << 20))).otherwise(int(taken[0] * (1 << 20)))
    drawn = stored(y.where(draw < limit).coalesce(1), "label-draw")
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(drawn, "doc_id"), taken


def marked(marks: DataFrame) -> DataFrame:
    """(doc_id, y) of toxicity labels outside the held-out fold."""
    own = marks.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", 5) != 0))
    return own.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y"))


def bounded_sample(docs: DataFrame, y: DataFrame, per_class: int) -> tuple[list, np.ndarray, tuple[float, float]]:
    """Texts, labels and shares of ``labelled``."""
    rows, taken = labelled(docs, y, per_class)
    got = rows.select("doc_id", "text", "y").toPandas().sort_values(["doc_id", "text"], kind="stable")
    return got["text"].tolist(), got["y"].to_numpy(np.int64), taken


def learn(docs: DataFrame, y: DataFrame, per_class: int = MAX_PER_CLASS) -> Model:
    """Model from documents and their labels (doc_id, y)."""
    return train(*bounded_sample(docs, y, per_class))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket

    def run(batches):
        table = WordTable(shared.value.word_rows)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(shared.value.score(table, batch["text"].to_pylist()))],
                names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text; labels of the held-out fold are not read."""
    docs = documents(spark, sf_dir)
    model = learn(docs, marked(labels(spark, sf_dir)))
    return score(docs, model).select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                                     "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
