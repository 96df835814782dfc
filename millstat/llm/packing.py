"""Best-fit packing of token sequences by exact-complement hashing.

Lengths are integers up to the sequence length, so the packing is planned on
the histogram of piece lengths (at most ``max_tokens`` rows, whatever the
number of documents). From the longest length down, the gap it leaves is
looked up among single lengths, then sums of two, then sums of three; a
combination that fills the gap exactly is consumed as often as the
availability counts allow. What remains is packed best-fit, longest first.
The plan says how often each combination of lengths occurs; pieces then find
their places by their rank within their length.

Defined results: NULL or empty text is the end id alone; only texts longer
than a sequence are cut; repeated rows are packed each on their own; an empty
table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import shared
from .shared import documents, lean, stored
from .tokenize import WORD_BPE, encoder

MAX_TOKENS = 2048
END_ID = 0
BUCKET_ROWS = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"


def pieces(docs: DataFrame, max_tokens: int = MAX_TOKENS, vocabulary: str = WORD_BPE, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """Documents (doc_id, text) to pieces of at most ``max_tokens`` ids; ``with_ids`` adds the packed ids."""
    end = np.array([end_id], "<u4").tobytes()
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids

    def cut(batches):
        own = encoder(vocabulary)
        for batch in shared.pieces(batches):
            out: list[tuple] = []
            for doc_id, packed in zip(batch["doc_id"].to_pylist(), own.packed(batch["text"].to_pylist())):
                packed += end
                for k, at in enumerate(range(0, len(packed), 4 * max_tokens)):
                    part = packed[at: at + 4 * max_tokens]
                    out.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part)[: len(fields)])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), fields)],
                                                 names=[n for n, _ in fields])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(cut), PIECES + ", ids binary" * with_ids)


def plan(counts: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[tuple[tuple[int, ...], int]]:
    """Histogram of lengths to ``[(lengths of one sequence, how many such sequences)]``.

    The work depends on ``max_tokens``, not on the counts: every step uses up
    a length or leaves it with fewer pieces than the combination needs.
    """
    have = np.zeros(max_tokens + 1, np.int64)
    for length, n in counts.items():
        have[length] = n
    patterns: dict[tuple[int, ...], int] = defaultdict(int)

    def take(combo: tuple[int, ...]) -> None:
        need = np.bincount(combo, minlength=max_tokens + 1)
        n = int(min(have[v] // need[v] for v in set(combo)))
        have[:] -= n * need
        patterns[tuple(sorted(combo, reverse=True))] += n

    if have[max_tokens]:
        take((max_tokens,))
    for find in (_single, _pair, _triple):
        for length in range(max_tokens - 1, 0, -1):
            while have[length]:
                have[length] -= 1  # the piece whose gap is looked up
                rest = find(have, max_tokens - length)
                have[length] += 1
                if rest is None:
                    break
                take((length, *rest))
    _best_fit(have, max_tokens, patterns)
    return sorted(((k, v) for k, v in patterns.items() if v), reverse=True)


def _single(have: np.ndarray, gap: int) -> tuple[int, ...] | None:
    return (gap,) if have[gap] else None


def _pair(have: np.ndarray, gap: int, most: int | None = None) -> tuple[int, ...] | None:
    """Two available lengths with sum ``gap``, the longer one as long as possible."""
    a = np.arange(gap - 1 if most is None else min(most, gap - 1), (gap - 1) // 2, -1)
    b = gap - a
    ok = (have[a] > 0) & (have[b] > 0) & ((a != b) | (have[a] > 1))
    k = int(ok.argmax()) if len(ok) else 0
    return (int(a[k]), int(b[k])) if len(ok) and ok[k] else None


def _triple(have: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """Three available lengths with sum ``gap``: the longest, then a pair for the rest."""
    for a in np.flatnonzero(have[: max(gap - 1, 0)])[::-1]:
        a = int(a)
        if 3 * a < gap:
            return None
        have[a] -= 1
        rest = _pair(have, gap - a, a) if gap - a >= 2 else None
        have[a] += 1
        if rest is not None:
            return (a, *rest)
    return None


def _best_fit(have: np.ndarray, max_tokens: int, patterns: dict) -> None:
    """The rest, longest first, into the open sequences with the least room that takes it."""
    still: dict[int, dict[tuple[int, ...], int]] = {max_tokens: {}}  # room -> combination -> sequences
    for length in range(max_tokens, 0, -1):
        n = int(have[length])
        while n:
            room = min((r for r, c in still.items() if r >= length and c), default=max_tokens)
            combo, free = still[room].popitem() if still[room] else ((), n)
            each = min(room // length, n)
            filled = min(free, n // each)
            if combo and free > filled:
                still[room][combo] = free - filled
            left = still.setdefault(room - each * length, {})
            new = combo + (length,) * each
            left[new] = left.get(new, 0) + filled
            n -= each * filled
    for by_combo in still.values():
        for combo, n in by_combo.items():
            patterns[tuple(sorted(combo, reverse=True))] += n


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, list[np.ndarray]]:
    """Per length: first rank, first sequence and offset of each run of places, by rank."""
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for combo, n in patterns:
        offset = 0
        for length in combo:
            runs[length].append((used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return {length: list(np.array(r, np.int64).T) for length, r in runs.items()}


def ranked(found: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds ``rank`` from 0 within each length.

    Pieces are numbered inside buckets by hash, and the buckets' counts are
    summed up, so a length that most pieces have is still dealt over all tasks.
    """
    buckets = max(16, found.count() // bucket_rows)
    rows = found.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    counts = rows.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("length", "_b", (F.sum("_n").over(
        Window.partitionBy("length").orderBy("_b")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("length", "_b").orderBy("doc_id", "piece", "ids_crc32"))
    return (rows.withColumn("_r", inside).join(before, ["length", "_b"])
            .withColumn("rank", F.col("_before") + F.col("_r") - 1).drop("_b", "_r", "_before"))


def pack(found: DataFrame, max_tokens: int = MAX_TOKENS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Pieces (see ``pieces``; read several times, so pass a written table) with sequence_id and offset."""
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = slots(plan(counts, max_tokens))
    names = [f.split()[0] for f in PIECES.split(", ")]

    def place(batches):
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for v in np.unique(length):
                first, seq, off = places[int(v)]
                at = length == v
                k = np.searchsorted(first, rank[at], "right") - 1
                sequence[at], offset[at] = seq[k] + rank[at] - first[k], off[k]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(sequence), pa.array(offset)],
                                             names=[*names, "sequence_id", "offset"])

    return ranked(found.select(*names), bucket_rows).select(*names, "rank").mapInArrow(lean(place), PLACED)


def pack_documents(docs: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Documents (doc_id, text) to placed pieces; the ids' digests only."""
    return pack(stored(pieces(docs, max_tokens), "pieces"), max_tokens)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack_documents(documents(spark, sf_dir))
