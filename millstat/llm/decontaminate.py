"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of tokens. In its template, numbers, amounts,
percentages, units after a number and names (capitalised words inside a
sentence) are typed placeholders; the words they replace are the slots.
Windows of ``WINDOW`` template tokens of the documents are hash-joined with those of
the benchmark items, so a question with other numbers and names still meets
its item. Windows of one document and one item at the same distance form a match; it
counts if its slots are consistent: equal item slots have equal document
slots and different ones different. A second join on the plain
lower-cased tokens finds copies whose capitals or sentence breaks changed,
whatever numbers and names they hold.

Before the join, tasks drop windows whose hash is not in a bitmap of the
benchmark's hashes (a fixed size, whatever the benchmark); the join decides.

Defined results: NULL and empty documents or items match nothing; template windows
need ``LITERAL`` tokens that are no slots, so an item with fewer such tokens is only
matched literally; items shorter than a window are one window of their own length, and
literal only below ``LITERAL`` tokens, down to one word;
repeated document rows count as one document; rows with a NULL doc_id or
item_id are left out; without any match there are no rows.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .shared import documents, lean, pieces, stored
from .words import WordTable, chunks, windows

WINDOW = 8
LITERAL = 5
FILTER_BITS = 1 << 26
_TOKEN = re.compile(r"[^\W\d_]+|[$€£]?\d+(?:[.,]\d+)*%?|[.!?:\n]")
WORD, CAPITAL, UNIT, SLOT, BREAK = range(5)

#: fixed values: unit words that are placeholders after a number
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t gram grams kilogram kilograms ton tons "
    "oz ounce ounces lb lbs pound pounds ml cl l liter liters litre litres gallon gallons s sec second seconds min minute "
    "minutes h hr hour hours day days week weeks month months year years k c f degrees degree w kw mw kwh v a ohm hz khz mhz "
    "ghz b kb mb gb tb byte bytes percent cent cents dollar dollars euro euros usd eur gbp mph kph bar pa kpa j kj cal kcal "
    "euros meter meters metre metres metro metros kilometer kilometers kilometre kilometres stunde stunden tag tage jahr jahre "
    "heure heures jour jours an ans hora horas dia dias".split())


def _placeholder(name: str) -> int:
    return xxh3_64_intdigest(f"\0{name}")


_NUM, _MONEY, _SHARE, _NAME, _MEASURE = map(_placeholder, ("num", "money", "share", "name", "unit"))


def _token_rows(tokens: list[str]) -> np.ndarray:
    """Per token: hash of its lower-cased form, kind, hash of its placeholder."""
    low = list(map(str.lower, tokens))
    kinds, holders = [], []
    for t, small in zip(tokens, low):
        kind, holder = WORD, 0
        if t[0].isalpha():
            if small in UNITS:
                kind, holder = UNIT, _MEASURE
            elif small != t and len(t) > 1 and t[0].isupper() and t[1:].islower():
                kind, holder = CAPITAL, _NAME
        elif t in ".!?:\n":
            kind = BREAK
        elif t[-1] == "%":
            kind, holder = SLOT, _SHARE
        elif t[0] in "$€£":
            kind, holder = SLOT, _MONEY
        elif t[0].isdigit():
            kind, holder = SLOT, _NUM
        kinds.append(kind)
        holders.append(holder)
    hashes = np.fromiter(map(xxh3_64_intdigest, low), np.uint64, len(low))
    return np.stack([hashes, np.array(kinds, np.uint64), np.array(holders, np.uint64)], axis=1)


@lru_cache(maxsize=1)
def canonicaliser() -> Canonical:
    """The canonicaliser of this Python worker: its tokens serve all its tasks."""
    return Canonical()


class Canonical:
    """Token hashes of texts: plain and as templates, and which tokens are slots."""

    def __init__(self):
        self.table = WordTable(_token_rows)

    def tokens(self, texts: list) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens and breaks of all texts in a row; of the tokens: place there, text's number, hashes plain and as template, slot flags."""
        split = [_TOKEN.findall(t or "") for t in texts]
        flat = list(chain.from_iterable(split))
        owner = np.repeat(np.arange(len(split)), [len(w) for w in split])
        at = self.table.lookup(flat)
        rows = self.table.rows[at] if len(at) else np.zeros((0, 3), np.uint64)
        kind = rows[:, 1].astype(np.int64)
        real = kind != BREAK
        first = np.ones(len(kind), bool)  # begins a sentence
        first[1:] = ~real[:-1] | (owner[1:] != owner[:-1])
        where = np.flatnonzero(real)
        kind, owner, first = kind[real], owner[real], first[real]
        after_number = np.zeros(len(kind), bool)
        after_number[1:] = (kind[:-1] == SLOT) & (owner[1:] == owner[:-1])
        slot = (kind == SLOT) | ((kind == UNIT) & after_number) | ((kind == CAPITAL) & ~first)
        plain = rows[real, 0]
        return flat, where, owner, plain, np.where(slot, rows[real, 2], plain), slot


HITS = "id long, pos int, kind string, hash long, slots array<string>"


def _hits(texts: DataFrame, widths: tuple[int, ...], literal: int, bitmap=None, short: bool = False) -> DataFrame:
    """Windows (id, pos, kind, hash, slots) of (id, text) rows whose hash is in the bitmap.

    ``short``: a text shorter than the window is one window (for items).
    """
    top = max(widths)

    def run(batches):
        canonical = canonicaliser()
        for batch in pieces(batches):
            ids, texts = batch["id"].to_pylist(), batch["text"].to_pylist()
            for start, end in chunks(texts):
                words, where, owner, plain, template, slot = canonical.tokens(texts[start:end])
                sizes = np.bincount(owner, minlength=end - start)
                begin = np.concatenate([[0], np.cumsum(sizes)])
                kept = np.concatenate([[0], np.cumsum(~slot)])
                slots = np.concatenate([[0], np.cumsum(slot)])
                cols: tuple[list, ...] = ([], [], [], [], [])
                for width in widths:
                    n = len(plain) - width + 1
                    if n <= 0:
                        continue
                    inside = owner[:n] == owner[width - 1:]
                    if short:  # only whole items have windows shorter than the full width
                        inside &= (sizes[owner[:n]] == width) | (width == top)
                    # without slots the plain window says the same; with few other tokens a template says too little
                    enough = inside & (slots[width:] > slots[:-width]) & (kept[width:] - kept[:-width] >= literal)
                    for kind, codes, ok in (("template", template, enough), ("plain", plain, inside)):
                        at = np.flatnonzero(ok)
                        if not len(at):
                            continue
                        h = windows(codes, width)[at]
                        if bitmap is not None:
                            bit = (h >> np.uint64(38)).astype(np.int64)
                            hit = (bitmap.value[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1
                            at, h = at[hit], h[hit]
                        for i, code in zip(at.tolist(), h.view(np.int64).tolist()):
                            cols[0].append(ids[start + owner[i]])
                            cols[1].append(i - int(begin[owner[i]]))
                            cols[2].append(kind)
                            cols[3].append(code)
                            cols[4].append([words[where[k]].lower() for k in range(i, i + width) if slot[k]]
                                           if kind == "template" else [])
                if cols[0]:
                    yield pa.record_batch({
                        "id": pa.array(cols[0], pa.int64()), "pos": pa.array(cols[1], pa.int32()), "kind": cols[2],
                        "hash": pa.array(cols[3], pa.int64()), "slots": pa.array(cols[4], pa.list_(pa.string()))})

    return texts.where("id is not null and text is not null").mapInArrow(lean(run), HITS)


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of the hashes in 32-bit words: FILTER_BITS / 8 bytes at most."""
    got = hashes.groupBy(F.expr("shiftrightunsigned(hash, 43)").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(shiftrightunsigned(hash, 38) & 31 as int)))").alias("bits")).toPandas()
    table = np.zeros(FILTER_BITS >> 5, np.uint32)
    table[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return table


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literal: int = LITERAL) -> DataFrame:
    """(doc_id, item_id, first, last, windows, kind): matched stretches of documents (token numbers)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    widths = tuple(range(1, window + 1))
    known = stored(_hits(items, widths, literal, short=True).select(
        F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), "kind", "hash", F.col("slots").alias("item_slots"))
        .distinct(), "decon-items")
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(known))
    # an item shorter than the window has windows of its own length: search the widths that occur
    used = sorted(r["n"] for r in _item_widths(items, window).collect())
    found = _hits(texts, tuple(used) or (window,), literal, bitmap).withColumnRenamed("id", "doc_id")
    met = found.join(known, ["kind", "hash"]).where(F.size("slots") == F.size("item_slots"))
    pairs = F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d"))
    by_shift = met.withColumn("shift", F.col("pos") - F.col("item_pos")).groupBy("doc_id", "item_id", "kind", "shift").agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"), F.count_distinct("pos").alias("windows"),
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"))
    # one document value for each item value, and the other way round
    size = F.size("pairs")
    consistent = (F.size(F.array_distinct("pairs.i")) == size) & (F.size(F.array_distinct("pairs.d")) == size)
    return by_shift.where(consistent).select("doc_id", "item_id", "first", "last", "windows", "kind")


def _item_widths(items: DataFrame, window: int) -> DataFrame:
    """Window widths that items need: the full one, and the lengths of shorter items."""
    def run(batches):
        canonical = canonicaliser()
        for batch in batches:
            _, _, owner, *_ = canonical.tokens(batch["text"].to_pylist())
            n = np.minimum(np.bincount(owner, minlength=batch.num_rows), window)
            yield pa.record_batch({"n": pa.array(np.unique(n[n > 0]), pa.int32())})

    return items.where("id is not null and text is not null").select("text").mapInArrow(lean(run), "n int").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literal: int = LITERAL) -> DataFrame:
    """One row per document with benchmark content: doc_id, item_ids, n_items, windows, kinds."""
    return matches(docs, benchmark, window, literal).groupBy("doc_id").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.count_distinct("item_id").alias("n_items"),
        F.sum("windows").alias("windows"), F.sort_array(F.collect_set("kind")).alias("kinds"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold windows of ``benchmark``, literal or with other slots."""
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
