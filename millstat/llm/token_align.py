"""Cross-tokenizer alignment by whitespace-token anchors.

Two vocabularies cut one text: A (byte-level BPE) encodes a space and the
text, B (pieces with byte fallback) the text, before which it puts a space
itself. Both encode the text in full. Then:

* anchors: byte offsets where a space-marked token of A and one of B begin,
  verified by the ends of the tokens before them, cut a text into windows of
  token ids;
* a window's alignment depends on its ids alone: the windows of a block of texts
  are aligned once per id tuples, in one pass, and a worker keeps the alignments by the
  words that they spell, one to one with the ids of A;
* groups: the offsets where tokens of A and of B both end cut the tokens into
  groups; the two tokens that end there are a link.

An A-B pair of ids can be linked only if one entry's bytes end with the
other's. The two vocabularies allow 400 thousand such pairs at most
(``possible_pairs`` counts them), whatever the input: so much and no more are
the counts that ``graded`` hands to the tasks.

Defined results: texts that are NULL, empty, or whose joined A or B bytes
differ from space+text have no tokens (zeros, empty groups); a NULL doc_id
stays NULL; repeated rows are rows of their own; an empty table gives no
rows. Columns besides doc_id and text are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .shared import documents, stored
from .tokenize import _BYTES, BYTE_BPE
from .words import chunks

PIECE_BPE = "piece_bpe_32k.model"
SPACE = "▁"
KEPT = 250_000  #: parts that a worker keeps in each of two generations
LONG = 64       #: longer ones are not kept
WIDTH = 1 << 15  #: a pair of ids as one number: a * WIDTH + b, below 2^31

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links binary"
GRADED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Entries:
    """Bytes of a vocabulary's entries: their lengths, and which begin with a space."""

    def __init__(self, values: list[bytes]):
        self.values = values
        self.lengths = np.array([len(v) for v in values], np.int64)
        self.spaced = np.array([v[:1] == b" " for v in values])

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.values.__getitem__, ids.tolist()))


class PieceModel:
    """Ids of B. The model puts a space before what it encodes."""

    def __init__(self, vocabulary: str = PIECE_BPE):
        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
        self.alone = [self.model.piece_to_id(SPACE)]

    def entries(self) -> Entries:
        m = self.model
        return Entries([bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(m.id_to_piece(list(range(m.get_piece_size()))))])

    def ids(self, parts: list[str]) -> list[list[int]]:
        """Ids of parts given with their first space."""
        found = self.model.encode([p[1:] for p in parts], num_threads=1)
        return [i if len(p) > 1 else self.alone for p, i in zip(parts, found)]


@lru_cache(maxsize=1)
def _byte_model() -> tuple[Tokenizer, Entries]:
    tok = Tokenizer.from_file(public_tokenizers.path(BYTE_BPE))
    tok.encode_special_tokens = True  # their strings in a text are ordinary text
    own = {letter: b for b, letter in _BYTES.items()}
    names = [tok.id_to_token(i) for i in range(tok.get_vocab_size())]
    return tok, Entries([bytes(own[c] for c in n) if all(c in own for c in n) else b"" for n in names])


class Memory:
    """What was met lately: two generations, the older one goes when the newer one is full."""

    def __init__(self):
        self.new: dict = {}
        self.old: dict = {}

    def recall(self, keys) -> list:
        """Brings known keys to the newer generation; the others are returned."""
        if len(self.new) > KEPT:
            self.new, self.old = {}, self.new
        new, old, unknown = self.new, self.old, []
        for k in keys:
            if k not in new:
                if k in old:
                    new[k] = old[k]
                else:
                    unknown.append(k)
        return unknown


class Aligner:
    """Aligns texts; one per Python worker, so what it keeps serves all its tasks.

    Neither vocabulary has an entry with a space after another character, and A's
    split pattern begins a piece at a space after a character that is none. So the
    ids of a text are those of its parts between such places: a part met lately is
    not encoded again.
    """

    PARTS = re.compile(r"(?<=\S)(?= )")

    def __init__(self):
        (self.a, self.of_a), self.b = _byte_model(), PieceModel()
        self.of_b = self.b.entries()
        self.parts = Memory()  # part -> n_a, n_b, groups, links of its windows; None if its tokens do not spell it
        # an id with what follows it: in A "," or, last of its group, "|"; in B "," or ";" or, last of its window, a line end
        self.text_a = [x for i in range(len(self.of_a.values)) for x in (f"{i},", f"{i}|")]
        self.text_b = [x for i in range(len(self.of_b.values)) for x in (f"{i},", f"{i};", f"{i}\n")]
        self.write = [*self.text_a, *self.text_b].__getitem__

    def _encode(self, parts: list[str]) -> Iterator[tuple[str, list | None]]:
        """Parts and their tokens, cut into windows (ids of A, ids of B) at verified anchors; None if the tokens do not spell the part."""
        parts.sort(key=lambda p: p[-1].isspace())  # stable; those that end with a space cannot stand before another
        n = next((k for k, p in enumerate(parts) if p[-1].isspace()), len(parts))
        texts = ["".join(parts[:n]), *parts[n:]]
        ids_a = np.fromiter(chain.from_iterable([e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]), np.uint32)
        ids_b = np.fromiter(chain.from_iterable(self.b.ids(parts)), np.uint32)
        data = [p.encode() for p in parts]
        last, whole = np.cumsum([len(d) for d in data]), b"".join(data)
        # anchors: ends before space-marked tokens that A and B share; a part's end must be one
        ends_a, ends_b = np.cumsum(self.of_a.lengths[ids_a]), np.cumsum(self.of_b.lengths[ids_b])
        cuts = [np.append(ends[np.flatnonzero(entries.spaced[ids[1:]])], last[-1])
                for ids, ends, entries in ((ids_a, ends_a, self.of_a), (ids_b, ends_b, self.of_b))]
        cut = np.intersect1d(*cuts)
        if self.of_a.joined(ids_a) != whole or self.of_b.joined(ids_b) != whole or not np.isin(last, cut).all():
            if len(parts) == 1:
                yield parts[0], None
            else:
                yield from self._encode(parts[: len(parts) // 2])
                yield from self._encode(parts[len(parts) // 2:])
            return
        keys = list(zip(_slices(ids_a, np.searchsorted(ends_a, cut) + 1), _slices(ids_b, np.searchsorted(ends_b, cut) + 1)))
        first = 0
        for part, end in zip(parts, (np.searchsorted(cut, last) + 1).tolist()):
            yield part, keys[first:end]
            first = end

    def _align(self, keys: list[tuple[bytes, bytes]]) -> dict[tuple[bytes, bytes], tuple[str, bytes]]:
        """Groups and links by window (ids of A, ids of B), all in one pass over their tokens."""
        ids_a, ids_b = (np.frombuffer(b"".join([k[side] for k in keys]), np.uint32) for side in (0, 1))
        ends_a, ends_b = np.cumsum(self.of_a.lengths[ids_a]), np.cumsum(self.of_b.lengths[ids_b])
        _, i, j = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)  # last tokens of the groups
        of_a, of_b = np.searchsorted(i, np.arange(len(ids_a))), np.searchsorted(j, np.arange(len(ids_b)))
        ends_window = np.cumsum([len(k[1]) // 4 for k in keys]) - 1  # last token of B
        follows_b = np.zeros(len(ids_b), np.int64)
        follows_b[j] = 1
        follows_b[ends_window] = 2
        follows_a = np.zeros(len(ids_a), np.int64)
        follows_a[i] = 1
        code = np.empty(len(ids_a) + len(ids_b), np.int64)
        code[np.arange(len(ids_a)) + np.concatenate([[0], j + 1])[of_a]] = ids_a.astype(np.int64) * 2 + follows_a
        code[np.arange(len(ids_b)) + (i + 1)[of_b]] = len(self.text_a) + ids_b.astype(np.int64) * 3 + follows_b
        groups = "".join(map(self.write, code.tolist())).split("\n")
        links = ids_a[i] * np.uint32(WIDTH) + ids_b[j]
        return dict(zip(keys, zip(groups, _slices(links, np.searchsorted(j, ends_window) + 1))))

    def texts(self, texts: list[str | None]) -> list[tuple[int, int, str, bytes]]:
        """n_a, n_b, groups, packed links of whole texts."""
        # B writes a space for U+2581
        split = [self.PARTS.split(" " + t) if t and SPACE not in t else [] for t in texts]
        unknown = self.parts.recall(dict.fromkeys(chain.from_iterable(split)))
        rows = self.parts.new
        if unknown:
            cut = list(self._encode(unknown))
            unmet = list(dict.fromkeys(chain.from_iterable(k for _, k in cut if k)))
            windows = self._align(unmet) if unmet else {}
            for part, keys in cut:
                if keys is None:
                    rows[part] = None
                elif len(keys) == 1:
                    rows[part] = (len(keys[0][0]) // 4, len(keys[0][1]) // 4, *windows[keys[0]])
                else:
                    groups, links = zip(*[windows[k] for k in keys])
                    n_a, n_b = (sum(map(len, side)) // 4 for side in zip(*keys))
                    rows[part] = (n_a, n_b, ";".join(groups), b"".join(links))
        out = []
        for parts in split:
            found = [rows[p] for p in parts]
            if not found or None in found:
                out.append((0, 0, "", b""))
            else:
                n_a, n_b, groups, links = zip(*found)
                out.append((sum(n_a), sum(n_b), ";".join(groups), b"".join(links)))
        for p in unknown:
            if len(p) > LONG:
                del rows[p]
        return out


def _slices(values: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The values up to each end, as packed bytes."""
    data, cuts = values.tobytes(), [0, *(4 * ends).tolist()]
    return [data[x:y] for x, y in zip(cuts, cuts[1:])]


@lru_cache(maxsize=1)
def _aligner() -> Aligner:
    return Aligner()


def possible_pairs() -> int:
    """How many id pairs can be linked at all: one entry's bytes end with the other's."""
    a, b = _byte_model()[1].values, PieceModel().entries().values
    own = [{}, {}]
    for seen, values in zip(own, (a, b)):
        for v in values:
            seen[v] = seen.get(v, 0) + 1
    total = sum(own[1].get(v[k:], 0) for v in a for k in range(len(v)))
    return total + sum(own[0].get(v[k:], 0) for v in b for k in range(1, len(v)))


def align(docs: DataFrame) -> DataFrame:
    """Per document: token counts, groups (``a1,a2|b1;a3|b2,b3``) and its links (packed a * WIDTH + b, in order)."""
    def run(batches):
        own = _aligner()
        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            for start, end in chunks(texts):
                rows = own.texts(texts[start:end])
                n = pa.array([len(r[3]) // 4 for r in rows], pa.int64())  # a group ends with a link
                yield pa.record_batch({
                    "doc_id": pa.array(ids[start:end], pa.int64()),
                    "n_a": pa.array([r[0] for r in rows], pa.int64()), "n_b": pa.array([r[1] for r in rows], pa.int64()),
                    "n_groups": n, "n_links": n,
                    "groups": pa.array([r[2] for r in rows], pa.string()),
                    "links": pa.array([r[3] for r in rows], pa.binary())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, ALIGNED)


def link_counts(aligned: DataFrame) -> DataFrame:
    """How often each id pair is linked: (pair, times). Tasks sum before the shuffle."""
    def count(batches):
        pairs, times = np.empty(0, np.uint32), np.empty(0, np.int64)
        for batch in batches:
            new, n = np.unique(np.frombuffer(b"".join(batch["links"].to_pylist()), np.uint32), return_counts=True)
            pairs, at = np.unique(np.concatenate([pairs, new]), return_inverse=True)
            times = np.bincount(at, np.concatenate([times, n]), len(pairs)).astype(np.int64)
        yield pa.record_batch({"pair": pa.array(pairs.astype(np.int64)), "times": pa.array(times)})

    return (aligned.select("links").mapInArrow(count, "pair long, times long")
            .groupBy("pair").agg(F.sum("times").alias("times")))


def graded(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document: links whose pair is linked as often as its B id's best pair, and the sum of the links' counts.

    The counts go to all tasks: at most ``possible_pairs()`` rows of 16 bytes.
    """
    table = counts.orderBy("pair").toArrow()
    pairs, times = table["pair"].to_numpy().astype(np.uint32), table["times"].to_numpy()
    best = np.zeros(WIDTH, np.int64)
    np.maximum.at(best, pairs % WIDTH, times)
    shared = aligned.sparkSession.sparkContext.broadcast((pairs, times, times == best[pairs % WIDTH]))

    def look_up(batches):
        pairs, times, top = shared.value
        for batch in batches:
            rows = [np.searchsorted(pairs, np.frombuffer(x, np.uint32)) for x in batch["links"].to_pylist()]
            out = {c: batch[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
            out["n_best"] = pa.array([int(top[r].sum()) for r in rows], pa.int64())
            out["count_sum"] = pa.array([int(times[r].sum()) for r in rows], pa.int64())
            yield pa.record_batch(out | {"groups_sha256": batch["groups_sha256"]})

    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "links", "groups_sha256").mapInArrow(look_up, GRADED)


def digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Alignment of every document, its digest and its links' counts in all documents."""
    found = align(docs).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "links", F.when(
        F.col("n_groups") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("").alias("groups_sha256"))
    kept = stored(found, "token-align")
    return graded(kept, stored(link_counts(kept), "token-align-counts"))


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text aligned: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    return digests(spark, documents(spark, sf_dir))
