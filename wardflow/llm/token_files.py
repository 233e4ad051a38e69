"""Token ids in files of independent zstandard frames with a trailing seek table.

A shard file holds, in this order:

* data frames, each a whole zstandard frame with the ids of consecutive documents (unsigned 32-bit little endian);
* one skippable frame (magic 0x184D2A5D) with the document index, itself compressed: per document its id, whether
  it has one, and its number of ids;
* the seek table of the public zstandard seekable format: a skippable frame (magic 0x184D2A5E) with compressed size,
  size and checksum (low 32 bits of XXH64 of the content) per data frame, then the number of frames, a descriptor
  byte and the magic 0x8F92EAB1.

A reader takes the table from the end of the file and decompresses only the frames that hold the documents asked
for. Shards follow each other in ascending ``doc_id`` order (null first) and so do the documents in them.
Each task writes under a name of its own attempt, and the manifest, a Parquet table, lists the files of the
attempts that counted; files of lost attempts are not listed and never read.

Cases: a null or empty text is its end token only. Repeated rows are written each on its own, equal ids in an
order set by their texts. An empty table makes no shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardflow.llm.tokens import encoder
from wardflow.session import new_work_dir

# Fixed values of the zstandard seekable format.
INDEX_MAGIC, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
CHECKSUM_FLAG = 0x80
FRAME_BYTES = 256 << 10
LEVEL = 1
MANIFEST = "shard int, path string, n_docs long, n_tokens long, n_frames long, first_id long, last_id long"


class ShardWriter:
    """Writes one shard; documents go in one by one."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES) -> None:
        self.out, self.frame_bytes = out, frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.held: list[bytes] = []
        self.held_bytes = 0
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.held.append(ids)
        self.held_bytes += len(ids)
        if self.held_bytes >= self.frame_bytes:
            self._flush()

    def _flush(self) -> None:
        if self.held:
            content = b"".join(self.held)
            frame = self.zstd.compress(content)
            self.out.write(frame)
            self.frames.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
            self.held, self.held_bytes = [], 0

    def finish(self) -> None:
        self._flush()
        known = np.array([i is not None for i in self.ids], "u1")
        ids = np.array([i or 0 for i in self.ids], "<i8")
        index = self.zstd.compress(known.tobytes() + ids.tobytes() + np.array(self.counts, "<u8").tobytes())
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        entries = b"".join(struct.pack("<III", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(entries) + len(footer)) + entries + footer)


class ShardReader:
    """Reads the documents of one shard by position, decompressing only the frames they lie in."""

    def __init__(self, file) -> None:
        self.file = file
        size = file.size()
        frames, _, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC:
            raise ValueError("no seek table at the end of the file")
        table = np.frombuffer(self._at(size - 9 - 12 * frames, 12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.sizes, self.checks = table[:, 0], table[:, 2]
        self.file_at = np.concatenate([[0], np.cumsum(table[:, 0])])
        self.content_at = np.concatenate([[0], np.cumsum(table[:, 1])])
        start = int(self.file_at[-1])
        magic, length = struct.unpack("<II", self._at(start, 8))
        if magic != INDEX_MAGIC:
            raise ValueError("no document index behind the data frames")
        index = zstandard.ZstdDecompressor().decompress(self._at(start + 8, length))
        n = len(index) // 17
        known = np.frombuffer(index, "u1", n)
        self.ids = [int(i) if k else None for i, k in zip(np.frombuffer(index, "<i8", n, n), known)]
        self.counts = np.frombuffer(index, "<u8", n, 9 * n).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.decompressed = 0
        self._held: tuple[int, bytes] = (-1, b"")

    def _at(self, offset: int, length: int) -> bytes:
        self.file.seek(int(offset))
        return self.file.read(int(length))

    def frame(self, k: int) -> bytes:
        if self._held[0] != k:
            content = zstandard.ZstdDecompressor().decompress(self._at(self.file_at[k], self.sizes[k]))
            if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.checks[k]:
                raise ValueError(f"frame {k} fails its checksum")
            self._held = (k, content)
            self.decompressed += 1
        return self._held[1]

    def document(self, position: int) -> bytes:
        """The ids of the document at ``position``; it lies in one frame."""
        start, length = 4 * int(self.starts[position]), 4 * int(self.counts[position])
        k = int(np.searchsorted(self.content_at, start, side="right")) - 1
        at = start - int(self.content_at[k])
        return self.frame(k)[at : at + length]


def _store(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root)


def write_tokens(docs: DataFrame, root: str, vocabulary: str, end_id: int = 1) -> DataFrame:
    """Encode every text, write the shards below ``root`` (a folder all executors reach), return the manifest."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        store, folder = _store(root)
        writer = out = None
        for batch in batches:
            if batch.num_rows and writer is None:
                path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.zst"
                out = store.open_output_stream(path, compression=None)
                writer = ShardWriter(out)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder(vocabulary).encode(batch.column("text"))):
                writer.add(doc_id, ids + end)
        if writer is not None:
            writer.finish()
            out.close()
            known = [i for i in writer.ids if i is not None]
            row = (shard, path, len(writer.ids), sum(writer.counts), len(writer.frames))
            row += (known[0], known[-1]) if known else (None, None)
            kinds = [pa.int32(), pa.string(), *[pa.int64()] * 5]
            names = [part.split()[0] for part in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    store, folder = _store(root)
    store.create_dir(folder, recursive=True)
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{root.rstrip('/')}/manifest")
    return read_manifest(spark, root)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/manifest")


def read_tokens(manifest: DataFrame, root: str, wanted: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents, or of those whose id is in ``wanted``.

    ``start`` counts the ids of all documents before. ``ids`` are unsigned 32-bit little endian. With ``wanted``,
    shards without such a document are not opened and frames without one are not decompressed.
    """
    # One row per shard: the running sum goes over file sizes, not over documents.
    base = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = manifest.withColumn("base", base)
    if wanted is None:
        shards = shards.withColumn("doc_ids", F.lit(None).cast("array<long>"))
    else:
        asked = F.array(*[F.lit(i).cast("long") for i in wanted]).cast("array<long>")
        here = F.filter(asked, lambda i: (i >= F.col("first_id")) & (i <= F.col("last_id")))
        shards = shards.withColumn("doc_ids", here).where(F.size("doc_ids") > 0)
    shards = shards.select("shard", "path", "base", "doc_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _store(root)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(row["path"]) as file:
                    reader = ShardReader(file)
                    asked = None if row["doc_ids"] is None else set(row["doc_ids"])
                    held, size = [], 0
                    for k, doc_id in enumerate(reader.ids):
                        if asked is not None and doc_id not in asked:
                            continue
                        ids = reader.document(k)
                        held.append((doc_id, row["base"] + int(reader.starts[k]), len(ids) // 4, ids))
                        size += len(ids)
                        if size >= 4 << 20:
                            yield _token_batch(held)
                            held, size = [], 0
                    if held:
                        yield _token_batch(held)

    files = max(1, manifest.count())
    return shards.repartitionByRange(files, "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def _token_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    arrays = [pa.array(v, k) for v, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids"])


def tokens_round_trip(docs: DataFrame, vocabulary: str, end_id: int = 1) -> DataFrame:
    """Write all documents to a fresh folder in the shared one and read them back from its files."""
    root = new_work_dir(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, root, vocabulary, end_id), root)
