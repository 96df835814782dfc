"""Periodic runs of words by string synchronising sets, and their removal.

A run is a stretch of words with smallest period q and at least 4 q long
that neither neighbour extends. Per chunk of documents:

* periods 1 to 3, the small ones, and every region found so far are the highly
  periodic regions. They are detected separately, by comparing words q apart;
* at each scale t = 4, 8, 16, ... a synchronising set holds the positions i
  where the least hash of the t-word blocks that begin in [i, i + t] is that of
  block i or i + t. Blocks within a region of period <= t / 4 do not count. So
  equal contexts of 2 t words choose equal positions, and every t positions
  outside the regions hold one;
* consecutive positions of equal context, d apart with t <= d < 2 t, propose
  the period d: a run of such a period always has two of them. Each proposal
  is verified, and its stretches extended, word by word;
* a document without equal contexts and without a region at a scale has no
  longer period and leaves.

Contexts are compared by 64-bit hashes built pairwise from halves; words
are numbered per document, so nothing equals anything of another document.

Defined results: NULL, empty or blank texts have no words, no runs and an empty
collapsed text; a NULL doc_id stays NULL; repeated rows are rows of their
own; an empty table gives no rows. Columns besides doc_id and text are not
looked at.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents
from .words import _mix, chunks

LEAST = 6      #: words of a run at least
POWER = 4      #: periods of a run at least
SMALL = (1, 2, 3)
FAR = np.uint64(0xFFFFFFFFFFFFFFFF)
FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def stretches(codes: np.ndarray, period: int) -> list[tuple[int, int]]:
    """(start, end) of the maximal stretches of at least POWER periods."""
    same = np.zeros(max(len(codes) - period, 0) + 2, np.int8)
    same[1:-1] = codes[period:] == codes[:-period]
    turns = np.flatnonzero(np.diff(same))
    starts, ends = turns[::2], turns[1::2]
    long = ends - starts >= (POWER - 1) * period
    return list(zip(starts[long].tolist(), (ends[long] + period).tolist()))


def _shifted(values: np.ndarray, by: int, fill) -> np.ndarray:
    out = np.full(len(values), fill, values.dtype)
    if by < len(values):
        out[: len(values) - by] = values[by:]
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of [i, i + width) for each i, from running minima of blocks of ``width``."""
    n = len(values)
    rows = np.full((-(-n // width) + 1, width), FAR, np.uint64)
    rows.reshape(-1)[:n] = values
    forward = np.minimum.accumulate(rows, axis=1).reshape(-1)
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[:n], forward[width - 1: width - 1 + n])


def _doubled(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of blocks of 2 ``size`` words from those of their halves."""
    with np.errstate(over="ignore"):
        return _mix(hashes * np.uint64(0x9E3779B97F4A7C15) + _mix(_shifted(hashes, size, np.uint64(0)) + np.uint64(size)))


def find_runs(codes: np.ndarray, doc: np.ndarray) -> dict[tuple[int, int], int]:
    """(start, end) -> smallest period of every stretch of at least POWER periods.

    ``codes``: words as numbers that no two documents share; ``doc``: document of each.
    """
    found: dict[tuple[int, int], int] = {}

    def add(period: int, spans: list[tuple[int, int]], base: int = 0) -> None:
        for start, end in spans:
            found.setdefault((start + base, end + base), period)  # periods ascend: the smallest stays

    for q in SMALL:
        add(q, stretches(codes, q))
    place = np.arange(len(codes))  # of the words that are left
    hashes = _mix(codes.astype(np.uint64))
    for size in (1, 2):
        hashes = _doubled(hashes, size)
    own, scale = doc, 4
    edges = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=int(doc[-1]) + 1))]) if len(doc) else np.zeros(1, np.int64)
    while len(place):
        left = np.bincount(own, minlength=len(edges) - 1)
        if int(left.max()) < POWER * scale:
            break
        # blocks inside a region of period <= scale / 4
        deep = np.zeros(len(codes) + 1, np.int32)
        for (start, end), q in found.items():
            if q * 4 <= scale <= end - start:
                deep[start] += 1
                deep[end - scale + 1] -= 1
        deep = np.cumsum(deep[:-1])[place] > 0
        block = np.where(deep, FAR, hashes)
        least = _least(block, scale + 1)
        chosen = np.flatnonzero((least != FAR) & ((least == block) | (least == _shifted(block, scale, FAR))))
        hashes = _doubled(hashes, scale)
        order = chosen[np.argsort(hashes[chosen], kind="stable")]
        same = hashes[order[1:]] == hashes[order[:-1]]
        first, gap = order[:-1][same], np.diff(place[order])[same]
        near = (gap >= scale) & (gap < 2 * scale)
        proposals = np.unique(np.stack([gap[near], own[first[near]]]), axis=1)
        for q, d in proposals.T.tolist():
            add(q, stretches(codes[edges[d]: edges[d + 1]], q), int(edges[d]))
        alive = np.zeros(len(edges) - 1, bool)
        alive[own[first]] = True
        alive[own[deep]] = True
        alive &= left >= 2 * POWER * scale
        stay = alive[own]
        place, hashes, own, scale = place[stay], hashes[stay], own[stay], 2 * scale
    return found


def collapse(texts: list) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """Per text: number of words, runs by start and period, and the text without the repeats of its runs."""
    parts = [t.split() if t else [] for t in texts]  # bytes are split at space and 09 to 0D
    every = [w for p in parts for w in p]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(every))}
    sizes = [len(p) for p in parts]
    doc = np.repeat(np.arange(len(parts)), sizes)
    codes = np.fromiter(map(numbers.__getitem__, every), np.int64, len(every)) + (doc << 32)
    base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    runs: list[list] = [[] for _ in parts]
    kept = np.ones(len(every), bool)
    for (start, end), q in find_runs(codes, doc).items():
        if end - start >= LEAST:
            d = int(doc[start])
            runs[d].append((start - int(base[d]), end - start, q))
            kept[start + q: end] = False
    out = []
    for d, words in enumerate(parts):
        rest = compress(words, kept[base[d]: base[d + 1]].tolist()) if runs[d] else words
        out.append((len(words), sorted(runs[d], key=lambda r: (r[0], r[2])), b" ".join(rest)))
    return out


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per document: n_words, its runs (start, length, period) and its text without their repeats."""
    def run(batches):
        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            for start, end in chunks(texts):
                rows = collapse(texts[start:end])
                flat = [r for x in rows for r in x[1]]
                cuts = np.cumsum([0, *(len(x[1]) for x in rows)])
                yield pa.record_batch({
                    "doc_id": pa.array(ids[start:end], pa.int64()),
                    "n_words": pa.array([x[0] for x in rows], pa.int64()),
                    "runs": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, _RUN)),
                    "collapsed": pa.array([x[2] for x in rows], pa.binary()).cast(pa.string())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, FOUND)


def repeating(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with every tenth text, by the crc32 of its id, made periodic from one of its words on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.expr("_h div 10")
    split = docs.select("doc_id", "text", h.alias("_h")).withColumn(
        "_w", F.when(F.col("_h") % 10 == 0, F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), "")))
    n = F.size("_w").cast("long")
    at = split.withColumn("_n", n).withColumn("_a", F.when(F.col("_n") > 0, g % F.col("_n")))
    at = at.withColumn("_p", F.expr("1 + (_n - _a) div (3 + (_h div 10) % 8)"))
    made = F.expr("array_join(concat(slice(_w, 1, int(_a)), slice(flatten(array_repeat("
                  "slice(_w, int(_a) + 1, int(_p)), int((_n - _a) div _p) + 1)), 1, int(_n - _a))), ' ')")
    return at.select("doc_id", F.when((F.col("_h") % 10 == 0) & (F.col("_n") > 0), made).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The columns of ``op11`` from ``periodic_runs``."""
    best = F.expr("array_min(transform(runs, r -> struct(-(r.length / r.period) AS x, r.start AS start, r.period AS period, "
                  "r.length AS length)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    top = found.select("*", best.alias("_b"), lines.alias("_l"))
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_b.start").alias("start"),
        F.col("_b.length").alias("length"), F.col("_b.period").alias("period"),
        F.expr("(1000 * _b.length) div _b.period").alias("exponent_milli"),
        F.sha2(F.col("_l").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole text, every tenth of them made periodic: the digests."""
    return digests(periodic_runs(repeating(documents(spark, sf_dir))))
