"""N-gram Jaccard join: pivots, Voronoi regions and triangle-inequality windows.

Jaccard distance (1 - similarity) of word-shingle sets is a metric, and a link
is a distance of at most ``T``. The join has to return every document's
component under the links, so it looks for links between different
components and skips what the triangle inequality already settles.

1. Documents with equal sets form a class with one representative.
2. Cells. Two sets at similarity s or more share one of their first
   ``n - ceil(s n) + 1`` shingles under any fixed order, so each
   representative is put into the cells of these. Cells with one
   member vanish: sets far from all others never meet anyone. Shingles that are frequent
   (marked in a bitmap of fixed size) come last, so a passage that many documents share makes
   no large cell; the others are ordered by how common their words are (counted in a table of fixed
   size), then by hash. So cells are shingles of rare words, which sets hardly share by chance,
   however many there are. Prefixes are a little longer, by ``extra``, so sets that are
   similar enough share several cells; a representative that shares fewer with
   all others together, like a document with a quoted line, goes.
3. Regions. In a cell with more than ``DIRECT_LEAVES * LEAF`` members a few members become
   pivots. Every member gets its distance to them; a distance up to T is a link.
   Each member belongs to the region of its nearest pivot and is replicated
   into any region whose pivot is at most 2T further: a partner within T lives
   there. Members at least ``FAR`` from every pivot form a region of their own, with
   those within T of that bound replicated into it. Regions are the cells of the
   next round; a region whose members are all in one component is done.
4. In small regions, and when splitting no longer pays, members of different
   components are compared directly (all but those of the region's largest
   component, with everyone): first along a spanning forest of the pairs that their
   bounds allow, so that a task returns fewer pairs than members; where a pair of
   the forest turned out to be no link, all pairs of cells that are still apart follow.

Every comparison first bounds the intersection from the sets' counts in 256
hash classes (distances to 256 fixed pivots in the symmetric-difference
metric); long sets, whose classes are full, then from their counts in more classes;
at last the whole sets are compared. All steps are exact; shingles are
told apart by 64-bit hashes.

Defined results: NULL, empty and wordless texts have an empty set (size 0) and
link with nothing; texts shorter than a shingle have one shingle, the whole
sequence; repeated rows and equal texts share a component; rows with a NULL
doc_id are returned with a NULL component and take no part; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import components, dealt, documents, finished, kept, lean, narrowed, pieces, possible, stored
from .words import INVERSE, MULTIPLIER, _mix, chunks, powers, windows

WORDS = 5
PERCENT = 80  # similarity, in hundredths
LEAF = 48
PIVOTS = 3
FREQUENT = 6  # distinct sets within one task that hold a shingle, to call it frequent
FREQUENT_BITS = 1 << 24  # size of the bitmap of frequent shingles, whatever the input
SLOTS = 1 << 16  # size of the table of how often words occur, whatever the input
TOP_RANK = 2000  # of a shingle, by how common its words are; frequent ones come after it, and both fit 12 bits
EXTRA = 2  # hundredths of a set that go into cells beyond the prefix
CLASSES = 256
LONG = 512  # sets with more shingles also have counts in about half as many classes as shingles
MAX_CLASSES = 1 << 16
BLOCK = 256
DIRECT_LEAVES = 8  # cells of up to so many leaves are compared by their class counts, without pivots
FEW = 24  # members outside the largest component that are compared directly
MAX_ROUNDS = 2
PAIRS_PER_TASK = 1000
TEXT_CHUNK = 200_000
PAIR_BLOCK = 8_192  # pairs whose class counts are held at once
PAIRS = "a long, b long"
HELD = 2_000_000  # shingles that a task holds to find the frequent ones


def _space() -> np.ndarray:
    out = np.zeros(256, bool)
    out[[0x20, *range(0x09, 0x0E)]] = True
    return out


def _values() -> np.ndarray:
    """A 64-bit value for each byte, equal for A-Z and a-z."""
    out = np.random.default_rng(5).integers(0, 1 << 64, 256, np.uint64)
    out[0x41:0x5B] = out[0x61:0x7B]
    return out


_IS_SPACE, _VALUE = _space(), _values()
_powers_of: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64, kept for the next call."""
    have = _powers_of.get(base)
    if have is None or len(have) < n:
        have = _powers_of[base] = powers(base, max(n, 2 * TEXT_CHUNK))
    return have[:n]


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in a row, and how many words each text has.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z in lower case; a hash is a polynomial in
    the values of a word's bytes, modulo 2^64.
    """
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    edge = np.flatnonzero(np.diff(_IS_SPACE[data], prepend=True))  # starts and ends of words by turns
    begin, end = edge[::2], edge[1::2]
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUE[data] * _powers(MULTIPLIER, len(data)), out=sums[1:])
        h = _mix((sums[end] - sums[begin]) * _powers(INVERSE, len(data))[begin] + (end - begin).astype(np.uint64))
    limits = np.cumsum([len(p) + 1 for p in parts])
    return h, np.diff(np.searchsorted(begin, limits), prepend=0)


def _slot(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(48)).astype(np.int64)


def shingle_sets(texts: list, words: int = WORDS, tally: np.ndarray | None = None) -> Iterator[list[np.ndarray]]:
    """Sorted distinct shingle hashes of each text, in lists for consecutive texts of bounded size.

    ``tally``: gets the words of each slot counted.
    """
    for start, stop in chunks(texts, TEXT_CHUNK):
        codes, sizes = word_hashes(texts[start:stop])
        full = windows(codes, words)
        if tally is not None:
            tally += np.bincount(_slot(codes), minlength=SLOTS)
        out, pos = [], 0
        for n in sizes.tolist():
            if n >= words:
                out.append(_distinct(full[pos: pos + n - words + 1]))
            else:
                out.append(windows(codes[pos: pos + n], n) if n else np.empty(0, np.uint64))
            pos += n
        yield out


def _prefixes(texts: list, words: int, percent: int, table: np.ndarray, levels: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of consecutive texts: keys of their sets, how many shingles of each set are put into cells, and the cells of these.

    Frequent shingles (``table``) come last, others by how common their words are (``levels``), then by hash: a
    function of the shingle alone.
    """
    for start, stop in chunks(texts, TEXT_CHUNK):
        codes, sizes = word_hashes(texts[start:stop])
        full = windows(codes, words)
        sums = np.concatenate([[0], np.cumsum(levels[_slot(codes)], dtype=np.int64)])
        rank = (sums[words:] - sums[:-words] if len(full) else sums[:0]) + (TOP_RANK + 1) * _is_hot(full, table)
        order = (rank.astype(np.uint64) << np.uint64(52)) | (full >> np.uint64(12))
        sets, firsts, pos = [], [], 0
        for n in sizes.tolist():
            if n >= words:
                own = _distinct(full[pos: pos + n - words + 1])
                first = _distinct(order[pos: pos + n - words + 1])[: prefix_size(len(own), percent) + extra(len(own))]
            else:
                own = first = windows(codes[pos: pos + n], n) if n else np.empty(0, np.uint64)
            sets.append(own)
            firsts.append(first)
            pos += n
        cells = (_mix(np.concatenate(firsts)) >> np.uint64(16)).view(np.int64)
        yield _keys(sets), np.fromiter(map(len, firsts), np.int64, len(firsts)), cells


def _distinct(values: np.ndarray) -> np.ndarray:
    own = np.sort(values)
    return own[np.concatenate([[True], own[1:] != own[:-1]])]


def _is_hot(shingles: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = (shingles >> np.uint64(40)).astype(np.int64)
    return (table[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1


def extra(n: int) -> int:
    """By how many shingles the prefix of a set of ``n`` is longer than it has to be.

    Sets of ``m`` and ``n`` shingles that are similar enough then share one cell more than these of the smaller one.
    """
    return n * EXTRA // 100


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-n * percent // 100) + 1


def _keys(sets: list[np.ndarray]) -> np.ndarray:
    """64-bit key of each set: equal for equal sets; 0 for an empty one."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.zeros(len(sets), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        with np.errstate(over="ignore"):
            total = np.add.reduceat(_mix(flat + np.uint64(0x1234567)), starts)
            out[full] = _mix(total + sizes[full].astype(np.uint64)) | np.uint64(1)
    return out.view(np.int64)


def _class_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles of each set fall into each hash class (255 at most)."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    if not sizes.sum():
        return np.zeros((len(sets), CLASSES), np.uint8)
    at = (np.concatenate(sets) >> np.uint64(20)).astype(np.int64) % CLASSES
    at += np.repeat(np.arange(len(sets)) * CLASSES, sizes)
    return np.minimum(np.bincount(at, minlength=len(sets) * CLASSES), 255).astype(np.uint8).reshape(-1, CLASSES)


def _fine_counts(s: np.ndarray) -> bytes | None:
    """Counts of a long set in a power of two of hash classes (255 at most); None for a short set."""
    if len(s) <= LONG:
        return None
    classes = min(1 << (len(s) // 2).bit_length(), MAX_CLASSES)
    at = (s >> np.uint64(20)).astype(np.int64) % classes
    return np.minimum(np.bincount(at, minlength=classes), 255).astype(np.uint8).tobytes()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _profile(docs: DataFrame, words: int) -> DataFrame:
    """Rows (doc_id, n, k, counts, fine) of documents, rows (word, bits) marking frequent shingles, rows (slot, times) of words."""
    names = ["doc_id", "n", "k", "counts", "fine", "word", "bits", "slot", "times"]

    def frequent(new: dict, seen: set) -> Iterator[pa.RecordBatch]:
        values, times = np.unique(np.concatenate(list(new.values())), return_counts=True)
        hot = set((values[times >= FREQUENT] >> np.uint64(40)).astype(np.int64).tolist()) - seen
        seen |= hot
        if hot:
            bits, empty = np.array(sorted(hot), np.int64), pa.nulls(len(hot), pa.int64())
            none = pa.nulls(len(hot), pa.binary())
            yield pa.RecordBatch.from_arrays([empty, empty, empty, none, none, pa.array(bits >> 5), pa.array(1 << (bits & 31)),
                                              empty, empty], names=names)

    def common(tally: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(tally)
        empty, none = pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary())
        yield pa.RecordBatch.from_arrays([empty, empty, empty, none, none, empty, empty, pa.array(at), pa.array(tally[at])],
                                         names=names)

    def run(batches):
        seen: set = set()
        new: dict[int, np.ndarray] = {}
        held, tally = 0, np.zeros(SLOTS, np.int64)
        for batch in pieces(batches):
            ids, texts, at = batch["doc_id"], batch["text"].to_pylist(), 0
            for sets in shingle_sets(texts, words, tally):
                keys, none = _keys(sets), pa.nulls(len(sets), pa.int64())
                counts = [row.tobytes() for row in _class_counts(sets)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys),
                     pa.array(counts, pa.binary()), pa.array(map(_fine_counts, sets), pa.binary()), none, none, none, none], names=names)
                at += len(sets)
                for k, s in zip(keys.tolist(), sets):
                    if k and k not in new:
                        new[k] = s
                        held += len(s)
                if held >= HELD:
                    yield from frequent(new, seen)
                    new, held = {}, 0
        if new:
            yield from frequent(new, seen)
        yield from common(tally)

    return _texts(docs).mapInArrow(lean(run), "doc_id long, n long, k long, counts binary, fine binary, word long, bits long, "
                                              "slot long, times long")


def _frequent(profile: DataFrame) -> np.ndarray:
    """The bitmap of frequent shingles as 32-bit words: FREQUENT_BITS / 8 bytes at most."""
    got = profile.where("word is not null").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    table = np.zeros(FREQUENT_BITS >> 5, np.uint32)
    table[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return table


def _levels(profile: DataFrame, words: int) -> np.ndarray:
    """How common the words of each slot are, in eighths of a power of two: SLOTS numbers, whose sums make ranks."""
    got = profile.where("slot is not null").groupBy("slot").agg(F.sum("times").alias("times")).toPandas()
    times = np.zeros(SLOTS)
    times[got["slot"].to_numpy(np.int64)] = got["times"].to_numpy(np.int64)
    return np.minimum(np.round(8 * np.log2(1 + times)), TOP_RANK // words).astype(np.int16)


def _entries(docs: DataFrame, words: int, percent: int, order) -> DataFrame:
    """(k, cell) of every set's prefix, once for each set of a batch. Cells are 48 bits: two that meet only add candidates."""
    def run(batches):
        table, levels = order.value
        for batch in batches:
            seen: set = set()
            for piece in pieces([batch]):
                for keys, sizes, cells in _prefixes(piece["text"].to_pylist(), words, percent, table, levels):
                    new = []
                    for k in keys.tolist():
                        new.append(k != 0 and k not in seen)
                        seen.add(k)
                    if any(new):
                        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(keys[new], sizes[new])),
                                                          pa.array(cells[np.repeat(new, sizes)])], names=["k", "cell"])

    return _texts(docs).mapInArrow(lean(run), "k long, cell long")


def _marked(ids: np.ndarray) -> np.ndarray:
    return (_mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(40)).astype(np.int64)


def _classes(usable: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(k, doc_id, n, counts, fine) of the ``n`` classes in ``nodes`` (k)."""
    return possible(usable, "k", nodes, n).join(nodes, "k", "left_semi").groupBy("k").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("counts").alias("counts"), F.first("fine").alias("fine"))


def _sets(docs: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """(k, shingles): the sorted sets, packed, of the classes in ``needed`` (doc_id, k).

    A bitmap of fixed size tells tasks which documents to read; the join decides.
    """
    def bits(batches):
        for batch in batches:
            at = np.unique(_marked(batch["doc_id"].to_numpy()))
            yield pa.record_batch({"word": pa.array(at >> 5), "bits": pa.array(1 << (at & 31))})

    bitmap = docs.sparkSession.sparkContext.broadcast(
        _frequent(needed.select("doc_id").mapInArrow(lean(bits), "word long, bits long")))

    def run(batches):
        table = bitmap.value
        for batch in pieces(batches):
            batch = batch.filter(pa.compute.is_valid(batch["doc_id"]))
            at = _marked(batch["doc_id"].to_numpy())
            batch = batch.filter(pa.array((table[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1))
            for sets in shingle_sets(batch["text"].to_pylist(), words):
                yield pa.RecordBatch.from_arrays([pa.array(_keys(sets)), pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 names=["k", "shingles"])

    found = _texts(docs).mapInArrow(lean(run), "k long, shingles binary")
    return found.join(needed.select("k"), "k", "left_semi").groupBy("k").agg(F.first("shingles").alias("shingles"))


def _plausible(pairs: DataFrame, ends: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b), with these ends, that the fine counts of long sets allow; pairs with a short set all stay."""
    def run(batches):
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("na", "nb", "fa", "fb"))
            keep = pa.array([_fine_allows(*x, percent) for x in zip(*columns)], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    long = possible(classes.where("fine is not null"), "k", ends, n).join(ends, "k", "left_semi")
    left = long.select(F.col("k").alias("a"), F.col("n").alias("na"), F.col("fine").alias("fa"))
    right = long.select(F.col("k").alias("b"), F.col("n").alias("nb"), F.col("fine").alias("fb"))
    rows = pairs.join(left, "a", "left").join(right, "b", "left").select("a", "b", "na", "nb", "fa", "fb")
    return narrowed(rows, n, 10 * PAIRS_PER_TASK).mapInArrow(lean(run), PAIRS)


def _fine_allows(nx: int, ny: int, x: bytes | None, y: bytes | None, percent: int) -> bool:
    if x is None or y is None:
        return True
    cx, cy = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if (cx == 255).any() or (cy == 255).any():  # may hold more
        return True
    few = min(len(cx), len(cy))  # classes of the larger table fold into those of the smaller one
    most = int(np.minimum(cx.reshape(-1, few).sum(axis=0, dtype=np.int64), cy.reshape(-1, few).sum(axis=0, dtype=np.int64)).sum())
    return 100 * most >= percent * (nx + ny - most)


def _distances(pairs: DataFrame, ends: DataFrame, sets: DataFrame, n: int) -> DataFrame:
    """The ``n`` pairs (a, b), with these ends, and the sizes of intersection and union of their whole sets."""
    def run(batches):
        for batch in batches:
            shared, total = [], []
            for x, y in zip(batch["sa"], batch["sb"]):
                both, union = _overlap(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
                shared.append(both)
                total.append(union)
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(shared, pa.int64()),
                                              pa.array(total, pa.int64())], names=["a", "b", "shared", "total"])

    # the ends are written: few are broadcast, a bitmap tells many, and only their sets travel
    sets = possible(sets, "k", ends, n).join(ends, "k", "left_semi")
    left = sets.select(F.col("k").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("k").alias("b"), F.col("shingles").alias("sb"))
    return (narrowed(pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb"), n, PAIRS_PER_TASK)
            .mapInArrow(lean(run), "a long, b long, shared long, total long"))


def _overlap(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
    return both, len(x) + len(y) - both


def _forest(la: np.ndarray, lb: np.ndarray, most: np.ndarray) -> list[int]:
    """Places of the edges (la, lb) in a spanning forest with the largest bounds."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    order = np.lexsort((lb, la, -most))
    kept = []
    for at, x, y in zip(order.tolist(), la[order].tolist(), lb[order].tolist()):
        x, y = top(x), top(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(at)
    return kept


def _allowed(frame: dict, i: np.ndarray, j: np.ndarray, percent: int, tree: bool) -> tuple[np.ndarray, ...]:
    """Of the pairs of rows (i, j): keys of those in different components that the class counts allow.

    With ``tree`` only those of a spanning forest of the components.
    """
    out = []
    for at in range(0, len(i), PAIR_BLOCK):
        x, y = i[at: at + PAIR_BLOCK], j[at: at + PAIR_BLOCK]
        apart = frame["label"][x] != frame["label"][y]
        x, y = x[apart], y[apart]
        cx, cy, nx, ny = frame["have"][x], frame["have"][y], frame["n"][x], frame["n"][y]
        least, most = np.minimum(nx, ny), np.minimum(cx, cy).sum(axis=1, dtype=np.int64)
        # a class counted up to 255 may hold more
        most = np.where((cx == 255).any(axis=1) | (cy == 255).any(axis=1), least, np.minimum(most, least))
        ok = 100 * most >= percent * (nx + ny - most)
        x, y, most = x[ok], y[ok], most[ok]
        a, b, la, lb = frame["k"][x], frame["k"][y], frame["label"][x], frame["label"][y]
        found = np.stack([np.minimum(a, b), np.maximum(a, b), np.minimum(la, lb), np.maximum(la, lb), most], axis=1)
        out.append(found[_forest(*found.T[2:])] if tree else found)
    if not out:
        return (np.empty(0, np.int64),) * 2
    found = np.concatenate(out)
    return tuple((found[_forest(*found.T[2:])] if tree and len(out) > 1 else found).T[:2])


def _frame(columns: dict) -> dict:
    out = {c: np.asarray(columns[c]) for c in ("k", "label", "n")}
    return out | {"have": np.frombuffer(b"".join(columns["counts"]), np.uint8).reshape(-1, CLASSES)}


def _in_small(cells: DataFrame, counts: DataFrame, percent: int, tree: bool) -> DataFrame:
    """Candidate pairs within cells of at most LEAF members: rows of a cell stand together, sorted."""
    def run(batches):
        rest = None  # rows of the cell that the next batch may go on with
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            cell = table["cell"].to_numpy()
            cut = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
            rest = table.slice(cut)
            if cut:
                yield pairs(table.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield pairs(rest)

    def pairs(table):
        cell = table["cell"].to_numpy()
        frame = _frame({c: table[c].to_numpy() if c != "counts" else table[c].to_pylist() for c in ("k", "label", "n", "counts")})
        i, j, step = [], [], 1
        while True:
            at = np.flatnonzero(cell[step:] == cell[:-step]) if step < len(cell) else []
            if not len(at):
                break
            i.append(at)
            j.append(at + step)
            step += 1
        found = _allowed(frame, np.concatenate(i), np.concatenate(j), percent, tree) if i else (np.empty(0, np.int64),) * 2
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["a", "b"])

    rows = cells.select("cell", "k", "label").join(counts, "k").select("cell", "k", "label", "n", "counts")
    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(lean(run), PAIRS)


def _in_blocks(cells: DataFrame, counts: DataFrame, percent: int, tree: bool, block: int = BLOCK) -> DataFrame:
    """Candidate pairs of minor members with all, by pairs of blocks, so that a cell of any size is dealt over tasks."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        own = _frame({c: frame[c].to_numpy() if c != "counts" else frame[c].tolist() for c in ("k", "label", "n", "counts")})
        minor = frame["minor"].to_numpy()
        i, j = np.flatnonzero(minor), np.flatnonzero(~minor)
        a, b = _allowed(own, np.repeat(i, len(j)), np.tile(j, len(i)), percent, tree)
        return pd.DataFrame({"a": a, "b": b})

    of = lambda n: F.ceil(F.col(n) / block).cast("int")
    home = lambda n: F.pmod(F.xxhash64("k", "cell"), of(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), of(n) - 1))
    left = cells.where("minor").select("cell", "k", "label", "minor", home("minors").alias("i"), each("size").alias("j"))
    right = cells.select("cell", "k", "label", F.lit(False).alias("minor"), each("minors").alias("i"), home("size").alias("j"))
    rows = left.unionByName(right.select(left.columns)).join(counts, "k").repartition("cell", "i", "j")
    return rows.groupBy("cell", "i", "j").applyInPandas(run, PAIRS)


def _candidates(cells: DataFrame, counts: DataFrame, percent: int, leaf: int, tree: bool) -> DataFrame:
    """Pairs of sets in different components that share a cell (cell, k, label, minor, size, minors)."""
    small = F.col("size") <= leaf
    few, many = cells.agg(F.count_if(small), F.count_if(~small)).first()
    found = []
    if few or not many:
        found.append(_in_small(cells.where(small), counts, percent, tree))
    if many:
        found.append(_in_blocks(cells.where(~small), counts, percent, tree))
    return reduce(DataFrame.unionByName, found).distinct()


def _ends(pairs: DataFrame, n: int) -> tuple[DataFrame, int]:
    """The sets in ``n`` pairs, written, and how many there are."""
    return kept(dealt(pairs, 2 * n).select(F.explode(F.array("a", "b")).alias("k")).distinct(), "jaccard-ends")


def _regions(members: DataFrame, pivots: DataFrame, dist: DataFrame, t: float, far: float) -> DataFrame:
    """Voronoi regions of each cell as new cells; boundary members are replicated, pivots are done."""
    eps = 1e-9  # rounding must not lose a partner on the bound
    rest = members.join(pivots.select("cell", F.col("pivot").alias("k")), ["cell", "k"], "left_anti")
    d = (rest.join(pivots, "cell").select("cell", "k", "pivot", F.least("k", "pivot").alias("a"),
                                          F.greatest("k", "pivot").alias("b"))
         .join(dist, ["a", "b"]).select("cell", "k", "pivot", "d"))
    near = d.groupBy("cell", "k").agg(F.min("d").alias("r"), F.collect_list(F.struct("d", "pivot")).alias("all"))
    into = (near.where(F.col("r") < far).select("cell", "k", "r", F.explode("all").alias("x"))
            .where(F.col("x.d") <= F.col("r") + 2 * t + eps)
            .select(F.xxhash64("cell", "x.pivot").alias("cell"), "k"))
    outside = near.where(F.col("r") >= far - t - eps).select(F.xxhash64("cell", F.lit("far")).alias("cell"), "k")
    return into.unionByName(outside)


def _distinct_cells(members: DataFrame) -> DataFrame:
    """One cell of those with the same members: (cell, k, times), the number of cells that it stands for."""
    marks = members.groupBy("cell").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("k")).alias("k1"),
        F.sum(F.xxhash64("k", F.lit(1)) % 1_000_000_007).alias("k2"), F.min("k").alias("k3"))
    keep = marks.where("size > 1").groupBy("size", "k1", "k2", "k3").agg(
        F.min("cell").alias("cell"), F.count(F.lit(1)).alias("times")).select("cell", "times")
    return members.select("cell", "k").join(keep, "cell")


def _meeting(members: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The members (cell, k, times) that share as many cells with others as with any partner alone; sizes: (k, n).

    A partner has ``percent`` of a set's shingles at least, and shares one cell more than its own ``extra``.
    """
    enough = (members.groupBy("k").agg(F.sum("times").alias("cells")).join(sizes, "k")
              .where(f"cells > (n * {percent} + 99) div 100 * {EXTRA} div 100").select("k").distinct())
    return members.join(stored(enough, "jaccard-meeting"), "k", "left_semi")


def jaccard_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, leaf: int = LEAF,
                 max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(doc_id, text) to (doc_id, n_shingles, component_id), a table in the shared folder; all others are deleted."""
    return finished(docs.sparkSession, lambda: _joined(docs, words, percent, leaf, max_rounds), "jaccard-found")


def _joined(docs: DataFrame, words: int, percent: int, leaf: int, max_rounds: int) -> DataFrame:
    spark = docs.sparkSession
    t = 1 - percent / 100
    far = 1 - 2 * t
    profile = stored(_profile(docs, words), "jaccard-profile")
    rows = profile.where("k is not null")
    usable = rows.where("n > 0 and doc_id is not null")
    order = spark.sparkContext.broadcast((_frequent(profile), _levels(profile, words)))
    source = docs.where(F.col("doc_id").isNotNull())
    over = Window.partitionBy("cell")
    met = (_entries(source, words, percent, order).withColumn("lo", F.min("k").over(over)).withColumn("hi", F.max("k").over(over))
           .where("lo <> hi").select("cell", "k"))
    members, _ = kept(_distinct_cells(kept(met.distinct(), "jaccard-cells")[0]), "jaccard-cells")
    members, _ = kept(_meeting(members, usable.select("k", "n"), percent), "jaccard-members")
    members, _ = kept(_distinct_cells(members).select("cell", "k"), "jaccard-cells")
    nodes, n = kept(members.select("k").distinct(), "jaccard-nodes")
    classes = stored(_classes(usable, nodes, n), "jaccard-classes")
    labels, sets = nodes.select("k", F.col("k").alias("label")), None
    joined = []  # (node, component) of every step: labels that became others

    def compare(pairs: DataFrame, ends: DataFrame, n: int) -> DataFrame:
        found = _distances(pairs, ends, sets, n).withColumn("d", 1 - F.col("shared") / F.col("total"))
        return kept(found, "jaccard-distances")[0]

    def link(dist: DataFrame) -> None:
        """Join the components that new links connect; labels stand for what earlier links joined."""
        nonlocal labels
        found = dist.where(F.col("shared") * 100 >= F.col("total") * percent).select("a", "b")
        if joined:  # else every set is its own component
            found = _between(found, labels)
        top = components(found, "jaccard-components").withColumnRenamed("node", "label")
        joined.append(top.where("label <> component").select(F.col("label").alias("a"), F.col("component").alias("b")))
        labels, _ = kept(labels.join(top, "label", "left").select("k", F.coalesce("component", "label").alias("label")),
                         "jaccard-labels")

    large = None
    for turn in range(max_rounds + 1):
        last = turn == max_rounds
        for tree in (True, False):
            if not tree:  # a forest reaches all ends of the pairs allowed: others have no partner in cells compared
                members = (cells.where(direct).join(ends, "k", "left_semi").unionByName(large).select("cell", "k"))
            cells, opened = kept(_opened(members, labels), "jaccard-open")
            direct = F.lit(last) | (F.col("size") <= DIRECT_LEAVES * leaf) | (F.col("minors") <= FEW)
            large = cells.where(~direct)
            if not opened:
                break
            if joined:  # settled members need no label any more
                labels, _ = kept(cells.select("k", "label").distinct(), "jaccard-labels")
            counts, _ = kept(classes.select("k", "n", "counts").join(labels, "k", "left_semi"), "jaccard-counts")
            pairs, n = kept(_candidates(cells.where(direct), counts, percent, leaf, tree), "jaccard-pairs", PAIRS_PER_TASK)
            ends, ended = _ends(pairs, n)
            if sets is None:  # later steps only meet these and members of large cells
                needed = dealt(ends.unionByName(large.select("k")), ended + opened).distinct()
                sets = stored(_sets(source, stored(classes.join(needed, "k", "left_semi").select("doc_id", "k"), "jaccard-needed"),
                                    words), "jaccard-sets")
            if not n:
                break
            pairs, m = kept(_plausible(pairs, ends, classes, n, percent), "jaccard-plausible", PAIRS_PER_TASK)
            if m:
                dist = compare(pairs, ends if m == n else _ends(pairs, m)[0], m)
                link(dist)
                if dist.where(F.col("shared") * 100 >= F.col("total") * percent).count() == n:
                    break  # all pairs of the forests are links: nothing that they span is apart
        if large.isEmpty():
            break
        # cells overlap: each member takes part in its largest one, the others wait for the new labels
        best = large.groupBy("k").agg(F.max(F.struct("size", "cell")).alias("m")).select("m.cell").distinct()
        now, _ = kept(large.join(best, "cell", "left_semi"), "jaccard-now")
        draws = [F.min_by(F.when(F.col("minor"), F.col("k")),
                          F.when(F.col("minor"), F.xxhash64("k", F.lit(1000 * turn + i)))).alias(f"p{i}") for i in range(PIVOTS)]
        pivots, _ = kept(now.groupBy("cell").agg(*draws).select(
            "cell", F.explode(F.array_distinct(F.array(*[f"p{i}" for i in range(PIVOTS)]))).alias("pivot")), "jaccard-pivots")
        spokes, n = kept(now.join(pivots, "cell").where("k <> pivot").select(
            F.least("k", "pivot").alias("a"), F.greatest("k", "pivot").alias("b")).distinct(), "jaccard-spokes", PAIRS_PER_TASK)
        dist = compare(spokes, _ends(spokes, n)[0], n)
        link(dist)
        waiting = large.join(best, "cell", "left_anti").select("cell", "k")
        regions = _regions(now.select("cell", "k"), pivots, dist.select("a", "b", "d"), t, far)
        regions, _ = kept(waiting.unionByName(regions.distinct()), "jaccard-regions")
        members, _ = kept(_distinct_cells(regions).select("cell", "k"), "jaccard-cells")
    # an id on several rows with different texts holds its classes together
    rows, _ = kept(rows.select("doc_id", "n", "k"), "jaccard-rows")
    known = rows.where("n > 0 and doc_id is not null")
    held = known.groupBy("doc_id").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).where("lo <> hi")
    same = known.join(held, "doc_id").where("k <> lo").select(F.col("lo").alias("a"), F.col("k").alias("b"))
    edges = same
    for step in joined:
        edges = edges.unionByName(step)
    top = components(kept(edges, "jaccard-steps")[0], "jaccard-components").withColumnRenamed("node", "k")
    found = rows.join(top, "k", "left").select("doc_id", "n", F.coalesce("component", "k").alias("label"))
    # documents without shingles have no class; the others' component is named by its smallest id
    ids = found.where("n > 0 and doc_id is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return (found.join(ids, "label", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(
        (F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def _between(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Links (a, b) of members as links of their components."""
    a = labels.select(F.col("k").alias("a"), F.col("label").alias("la"))
    b = labels.select(F.col("k").alias("b"), F.col("label").alias("lb"))
    return links.join(a, "a").join(b, "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))


def _opened(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Cells with members in more than one component: (cell, k, label, minor, size, minors).

    ``minor``: not in the cell's largest component.
    """
    rows = members.join(labels, "k")
    by_label = rows.groupBy("cell", "label").agg(F.count(F.lit(1)).alias("n"))
    per_cell = (by_label.groupBy("cell").agg(F.sum("n").alias("size"), F.max(F.struct("n", "label")).alias("top"),
                                             F.count(F.lit(1)).alias("parts")).where("parts > 1")
                .select("cell", "size", F.col("top.label").alias("major"), (F.col("size") - F.col("top.n")).alias("minors")))
    return rows.join(per_cell, "cell").select("cell", "k", "label", (F.col("label") != F.col("major")).alias("minor"),
                                              "size", "minors")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents at 80 % of the union, sets of five-word shingles."""
    return jaccard_join(documents(spark, sf_dir))
