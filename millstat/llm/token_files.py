"""Token-id files: independent zstandard frames, a trailing seek table, checksums.

One file per range of document ids. Layout (zstandard seekable format, so any
zstandard tool can decompress it):

* data frames: packed little-endian uint32 ids. A frame ends at a document's
  end once it holds ``frame_bytes``; a longer document fills several frames;
* a skippable frame with the document index (Arrow: doc_id, n_tokens),
  compressed;
* a skippable frame with the seek table: per frame its compressed size, its
  size and the low 32 bits of its xxh64, then the footer.

Readers load the two trailing frames, then decompress only the frames that
overlap the requested documents, checking each frame's checksum.

Defined results: NULL or empty text has only the end id; a NULL doc_id sorts
first and is kept as NULL; repeated rows are kept, ordered by (doc_id, hash
of the text); an empty table gives no files and no rows.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ..session import scratch_path
from .shared import documents
from .tokenize import BYTE_BPE, encoder

#: fixed values of the zstandard format and its seekable extension
SKIPPABLE = 0x184D2A5E
INDEX_FRAME = 0x184D2A50
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80

END_ID = 2
FRAME_BYTES = 1 << 18
MANIFEST = "part int, path string, docs long, tokens long"
ROWS = "part int, doc_id long, at long, n_tokens long, ids_crc32 long"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; a bare path is on the shared mount."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class TokenFileWriter:
    """Appends documents to one file; ``close`` writes index and seek table."""

    def __init__(self, path: str, frame_bytes: int = FRAME_BYTES, level: int = 1):
        self.files, self.path = _open(path)
        self.files.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.out = self.files.open_output_stream(self.path, compression=None)  # the frames are the compression
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.frame_bytes, self.buffer = frame_bytes, bytearray()
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, packed: bytes) -> None:
        self.ids.append(doc_id)
        self.counts.append(len(packed) // 4)
        for at in range(0, len(packed), self.frame_bytes):
            self.buffer += packed[at: at + self.frame_bytes]
            if len(self.buffer) >= self.frame_bytes:
                self._flush()

    def _flush(self) -> None:
        if self.buffer:
            data = bytes(self.buffer)
            frame = self.zstd.compress(data)
            self.out.write(frame)
            self.frames.append((len(frame), len(data), xxh64_intdigest(data) & 0xFFFFFFFF))
            self.buffer.clear()

    def close(self) -> None:
        self._flush()
        batch = pa.record_batch({"doc_id": pa.array(self.ids, pa.int64()), "n_tokens": pa.array(self.counts, pa.int64())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as w:
            w.write_batch(batch)
        index = self.zstd.compress(sink.getvalue().to_pybytes())
        self.out.write(struct.pack("<II", INDEX_FRAME, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class TokenFile:
    """Random access to one token file."""

    def __init__(self, path: str):
        files, name = _open(path)
        self.file = files.open_input_file(name)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError(f"{path}: no seek table")
        table = self.file.read_at(12 * n, size - 9 - 12 * n)
        rows = np.frombuffer(table, "<u4").reshape(n, 3).astype(np.int64)
        self.sums = rows[:, 2]
        self.packed_at = np.concatenate([[0], np.cumsum(rows[:, 0])])
        self.data_at = np.concatenate([[0], np.cumsum(rows[:, 1])])
        at = int(self.packed_at[-1])
        magic, length = struct.unpack("<II", self.file.read_at(8, at))
        if magic != INDEX_FRAME:
            raise ValueError(f"{path}: no document index")
        raw = zstandard.ZstdDecompressor().decompress(self.file.read_at(length, at + 8))
        index = pa.ipc.open_stream(raw).read_all()
        self.doc_ids = index["doc_id"].to_pylist()
        self.counts = index["n_tokens"].to_numpy()
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.zstd = zstandard.ZstdDecompressor()
        self.frames_read = 0
        self._last: tuple[int, bytes] = (-1, b"")

    def _frame(self, k: int) -> bytes:
        if self._last[0] != k:
            at, end = int(self.packed_at[k]), int(self.packed_at[k + 1])
            data = self.zstd.decompress(self.file.read_at(end - at, at))
            if xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[k]:
                raise ValueError(f"frame {k}: checksum differs")
            self.frames_read += 1
            self._last = (k, data)
        return self._last[1]

    def parts(self, row: int) -> Iterator[bytes]:
        """The packed ids of one document, frame by frame."""
        at, end = 4 * int(self.starts[row]), 4 * int(self.starts[row + 1])
        k = int(np.searchsorted(self.data_at, at, "right")) - 1
        while at < end:
            base = int(self.data_at[k])
            data = self._frame(k)
            yield data[at - base: end - base]
            at, k = int(self.data_at[k + 1]), k + 1

    def ids(self, row: int) -> np.ndarray:
        return np.frombuffer(b"".join(self.parts(row)), "<u4")

    def close(self) -> None:
        self.file.close()


def write_token_files(docs: DataFrame, folder: str, vocabulary: str = BYTE_BPE, end_id: int = END_ID,
                      frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files under ``folder`` in ascending doc_id order.

    Returns the manifest (part, path, docs, tokens), written beside the files. Only
    files that the manifest names count: a task that runs twice writes
    under another name, and the manifest keeps the attempt that succeeded.
    """
    end = struct.pack("<I", end_id)

    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        path = f"{folder}/ids-{part:06d}-{uuid.uuid4().hex[:12]}.zst"
        own, out = encoder(vocabulary), None
        for batch in batches:
            if batch.num_rows and out is None:
                out = TokenFileWriter(path, frame_bytes)
            for doc_id, packed in zip(batch["doc_id"].to_pylist(), own.packed(batch["text"].to_pylist())):
                out.add(doc_id, packed + end)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "path": path, "docs": len(out.ids),
                                               "tokens": sum(out.counts)}],
                                             pa.schema([("part", pa.int32()), ("path", pa.string()),
                                                        ("docs", pa.int64()), ("tokens", pa.int64())]))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64("text").alias("_h"))
    spread = rows.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h").select("doc_id", "text")
    manifest = f"{folder}/manifest"
    spread.mapInArrow(write, MANIFEST).write.parquet(manifest)
    return docs.sparkSession.read.schema(MANIFEST).parquet(manifest)


def read_token_files(manifest: DataFrame, doc_ids: set | None = None) -> DataFrame:
    """Per document of the files: part, doc_id, at (ids before it in its file), n_tokens, crc32 of its ids.

    ``doc_ids``: only these documents; frames without any of them are not decompressed.
    """
    files = manifest.count()

    def read(batches):
        for batch in batches:
            for part, path in zip(batch["part"].to_pylist(), batch["path"].to_pylist()):
                file, crcs = TokenFile(path), []
                rows = [i for i, d in enumerate(file.doc_ids) if doc_ids is None or d in doc_ids]
                for i in rows:
                    crc = 0
                    for piece in file.parts(i):
                        crc = zlib.crc32(piece, crc)
                    crcs.append(crc)
                file.close()
                yield pa.record_batch({
                    "part": pa.array([part] * len(rows), pa.int32()),
                    "doc_id": pa.array([file.doc_ids[i] for i in rows], pa.int64()),
                    "at": pa.array(file.starts[:-1][rows], pa.int64()),
                    "n_tokens": pa.array(file.counts[rows], pa.int64()),
                    "ids_crc32": pa.array(crcs, pa.int64()),
                })

    return manifest.select("part", "path").repartition(max(files, 1), "part").mapInArrow(read, ROWS)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through the file format and back: doc_id, start, n_tokens, ids_crc32."""
    manifest = write_token_files(documents(spark, sf_dir), scratch_path(spark, "token-files"))
    # one row per file: the running sum over files is a small window
    before = manifest.select("part", F.coalesce(F.sum("tokens").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return (read_token_files(manifest).join(F.broadcast(before), "part")
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))
