"""Language ID: script ranges narrow the candidates, Viterbi labels spans.

A word's script (the one most of its letters are in) narrows it to the
languages that use this script in the training texts. Each word has a score
per candidate: the log-likelihood of its character n-grams. Viterbi over the
words, with a penalty for each switch of language, labels spans; a text's
language is the one whose spans hold most letters, and its score that
language's share of all letters.

Defined results: NULL, empty or letterless text is ``und`` with score 0 and
no spans; letters in scripts of no learned language count in no span, and a
text of such letters alone gets the most frequent learned language with score
0; ties go to the alphabetically first language; repeated rows each get their
row; without any training row every text is ``und``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents, fold, lean, numbered, pieces
from .words import WordTable, char_ngrams, chunks

UND = "und"
SIZES = (1, 2, 3, 4)
BUCKETS = 1 << 16
MAX_TRAIN_DOCS = 20_000  # about; the training sample is a share of the learnable rows by hash
SWITCH_PENALTY = 12.0
MIN_SCORE = 0.2  # share of a text's letters in its language, below which a text is rejected
CHARS = 250_000  # of texts whose words are held at once
NEW_WORDS = 8_192  # that are scored at once
SCRIPT_SHARE = 0.01  # a language uses a script that holds this share of its letters

#: fixed values: first and last code point of the letters of each script
SCRIPTS = [
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x6FF), ("arabic", 0x750, 0x77F),
    ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("gurmukhi", 0xA00, 0xA7F), ("gujarati", 0xA80, 0xAFF),
    ("tamil", 0xB80, 0xBFF), ("telugu", 0xC00, 0xC7F), ("thai", 0xE00, 0xE7F), ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF), ("hiragana", 0x3040, 0x309F),
    ("katakana", 0x30A0, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF),
]
OTHER = "other"
NAMES = sorted({n for n, _, _ in SCRIPTS}) + [OTHER]
_LETTERS = re.compile(r"[^\W\d_]+")
_BOUNDS = np.array(sorted((lo, hi, NAMES.index(n)) for n, lo, hi in SCRIPTS))


def script_of(word: str) -> int:
    """Index in NAMES of the script that most of the word's letters are in."""
    if word.isascii():
        return NAMES.index("latin")
    codes = np.array([ord(c) for c in word])
    k = np.searchsorted(_BOUNDS[:, 0], codes, "right") - 1
    inside = (k >= 0) & (codes <= _BOUNDS[k, 1])
    return int(np.bincount(np.where(inside, _BOUNDS[k, 2], NAMES.index(OTHER)), minlength=len(NAMES)).argmax())


def letters_of(word: str) -> str:
    """The word's letters, in lower case, joined."""
    return word.lower() if word.isalpha() else "".join(_LETTERS.findall(word)).lower()


@dataclass
class Model:
    """Log-probabilities of n-grams (buckets x languages) and languages by script."""

    languages: list[str]
    logp: np.ndarray
    uses: np.ndarray  # scripts x languages, bool
    frequent: int

    def word_rows(self, words: list[str]) -> np.ndarray:
        """Per word: score of each language (0 for the best), letters, letters in learned scripts."""
        k = len(self.languages)
        clean = [letters_of(w) for w in words]
        out = np.zeros((len(words), k + 2), np.float32)
        bucket, owner = char_ngrams(clean, SIZES, BUCKETS)
        for j in range(k):
            out[:, j] = np.bincount(owner, self.logp[bucket, j], len(words)) / len(SIZES)
        lengths = np.fromiter(map(len, clean), np.int64, len(clean))
        out[lengths == 0, :k] = 0
        scripts = np.fromiter(map(script_of, clean), np.int64, len(clean))
        uses = self.uses[scripts]
        known = uses.any(axis=1)
        out[~known, :k] = 0
        out[:, :k] = np.where(uses | ~known[:, None], out[:, :k], -np.inf)
        out[:, :k] -= out[:, :k].max(axis=1, keepdims=True)
        out[:, :k] = np.maximum(out[:, :k], -50.0)
        out[:, k], out[:, k + 1] = lengths, np.where(known, lengths, 0)
        return out


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """Best language per word: sum of word scores minus ``penalty`` per switch."""
    total = scores.sum(axis=0)
    best = int(total.argmax())
    over = scores - scores[:, best: best + 1]
    run = np.vstack([np.zeros((1, scores.shape[1]), over.dtype), np.cumsum(over, axis=0)])
    # no stretch gains half a penalty in another language, so no path with switches can win
    if (run - np.minimum.accumulate(run, axis=0)).max() < penalty / 2:
        return np.full(len(scores), best)
    states = range(scores.shape[1])
    value, back = [0.0] * len(states), []
    for row in scores.tolist():
        top = max(states, key=value.__getitem__)
        switch = value[top] - penalty
        back.append([top if switch > value[s] else s for s in states])
        value = [max(value[s], switch) + row[s] for s in states]
    path = np.empty(len(scores), np.int64)
    at = max(states, key=value.__getitem__)
    for i in range(len(scores) - 1, -1, -1):
        path[i] = at
        at = back[i][at]
    return path


def learn(train: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> Model | None:
    """Model from (doc_id, text, lang) rows: a share by hash of about ``max_docs`` rows, whole texts."""
    rows = train.where("text is not null and lang is not null")
    n = rows.count()
    if not n:
        return None
    share = min(1.0, max_docs / n)
    sample = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def count(batches):
        for batch in pieces(batches):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                grams, scripts = np.zeros(BUCKETS, np.int64), np.zeros(len(NAMES), np.int64)
                for start, end in chunks(texts, CHARS):
                    words: dict[str, int] = {}
                    for t in texts[start:end]:
                        for w in t.split():
                            words[w] = words.get(w, 0) + 1
                    clean = [letters_of(w) for w in words]
                    times = np.fromiter(words.values(), np.float64, len(words))
                    times[[not w for w in clean]] = 0
                    bucket, owner = char_ngrams(clean, SIZES, BUCKETS)
                    grams += np.bincount(bucket, times[owner], BUCKETS).astype(np.int64)
                    sizes = np.fromiter(map(len, clean), np.float64, len(clean))
                    at = np.fromiter(map(script_of, clean), np.int64, len(clean))
                    scripts += np.bincount(at, sizes * times, len(NAMES)).astype(np.int64)
                both = np.concatenate([grams, scripts])
                at = np.flatnonzero(both)
                yield pa.record_batch({"lang": pa.array([lang] * len(at)), "at": pa.array(at),
                                       "n": pa.array(both[at])})

    counts = sample.select("lang", "text").mapInArrow(lean(count), "lang string, at long, n long")
    # at most languages x (buckets + scripts) rows
    got = counts.groupBy("lang", "at").agg(F.sum("n").alias("n")).toPandas()
    if got.empty:
        return None
    languages = sorted(got["lang"].unique())
    table = np.zeros((BUCKETS + len(NAMES), len(languages)))
    table[got["at"], got["lang"].map(languages.index)] = got["n"]
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    logp = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BUCKETS)).astype(np.float32)
    uses = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return Model(languages, logp, uses, int(scripts.sum(axis=0).argmax()))


PREDICTED = "lang_pred string, score double, spans array<struct<lang:string,first:int,words:int>>"


def predict(docs: DataFrame, model: Model | None, penalty: float = SWITCH_PENALTY, keep: tuple = ("doc_id",),
            text: str = "text") -> DataFrame:
    """Adds lang_pred, score and spans (language, first word, words) to the ``keep`` columns of ``docs``.

    A string column ``text`` that is kept goes to the workers once.
    """
    if model is None:
        empty = F.array().cast("array<struct<lang:string,first:int,words:int>>")
        return docs.select(*keep, F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"), empty.alias("spans"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x buckets, a fixed size
    fields = docs.select(*keep).schema
    once = text in keep and docs.schema[text].dataType.simpleString() == "string"
    source = text if once else "_text"
    span = pa.struct([("lang", pa.string()), ("first", pa.int32()), ("words", pa.int32())])

    def run(batches):
        m = shared.value
        k, table = len(m.languages), WordTable(m.word_rows, at_once=NEW_WORDS)
        for batch in pieces(batches):
            texts, langs, scores, spans = batch[source].to_pylist(), [], [], []
            for start, end in chunks(texts, CHARS):
                split = [(t or "").split() for t in texts[start:end]]
                at = table.lookup([w for words in split for w in words])
                pos = 0
                for words in split:
                    rows = table.rows[at[pos: pos + len(words)]] if words else np.zeros((0, k + 2), np.float32)
                    pos += len(words)
                    letters = rows[:, k].sum(dtype=np.float64)
                    if not letters:
                        langs.append(UND), scores.append(0.0), spans.append([])
                        continue
                    path = viterbi(rows[:, :k].astype(np.float64), penalty)
                    held = np.bincount(path, rows[:, k + 1], k)
                    top = int(held.argmax()) if held.any() else m.frequent
                    edge = np.flatnonzero(np.diff(path, prepend=-1))
                    langs.append(m.languages[top])
                    scores.append(float(held[top] / letters))
                    spans.append([{"lang": m.languages[path[i]], "first": int(i), "words": int(n)}
                                  for i, n in zip(edge, np.diff(edge, append=len(path)))] if held.any() else [])
            cols = [batch[c] for c in keep] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                                               pa.array(spans, pa.list_(span))]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "lang_pred", "score", "spans"])

    rows = docs.select(*keep) if once else docs.select(*keep, F.col(text).cast("string").alias(source))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", " + PREDICTED
    return rows.mapInArrow(lean(run), schema)


def learnable(docs: DataFrame) -> DataFrame:
    """Rows outside the held-out fold."""
    return docs.where(F.coalesce(fold("doc_id", 4), F.lit(0)) != 2)


def accepted(docs: DataFrame, model: Model | None, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the texts that have no letters or hardly any in a learned language's script."""
    own = numbered(docs)
    names = tuple(own.columns)
    found = predict(own, model, keep=names, text=names[docs.columns.index("text")])
    return found.where((F.col("lang_pred") != UND) & (F.col("score") >= min_score)).select(*names).toDF(*docs.columns)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text; learned outside the held-out fold."""
    docs = documents(spark, sf_dir)
    found = predict(docs, learn(learnable(docs)))
    return found.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred",
                        "score", F.size("spans").alias("n_spans"))
