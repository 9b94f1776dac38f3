"""Token ids in files of bit or byte planes.

Ids go into blocks of a fixed number. A block's ids, as little-endian unsigned 32-bit integers, are transposed: first
the lowest plane of all ids, then the next. Each plane is compressed with zstandard by itself; a plane of zeros takes no
bytes. Lengths and ids of documents are stored the same way behind the blocks, and an index at the end of the file says
where every plane of every chunk lies, so that a reader fetches the chunks it needs.

File: MAGIC, the chunks' planes, the index as JSON, its length (4 bytes, little endian), MAGIC.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cohortflow.llm.shipping import ship_package
from cohortflow.llm.tokens import library_encoder
from cohortflow.llm.words import slices
from cohortflow.operators.ranking import running_total
from cohortflow.session import scratch_path, settle

MAGIC = b"IDPLANE1"
#: Ids in a block, and in a file, after which a task begins another one.
BLOCK_IDS, FILE_IDS = 1 << 18, 1 << 25
LEVEL = 3

MANIFEST = "path string, part int, file int, n_docs bigint, n_ids bigint, n_bytes bigint"


def to_planes(values: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of little-endian unsigned integers, lowest first; one per bit or per byte."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    if not bits:
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(values.itemsize)]
    planes = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(planes[:, k], bitorder="little").tobytes() for k in range(8 * values.itemsize)]


def from_planes(planes: list[bytes | None], count: int, kind: str, bits: bool) -> np.ndarray:
    """The integers again; None stands for a plane of zeros."""
    kind = np.dtype(kind)
    raw = np.zeros((count, kind.itemsize), np.uint8)
    for k, plane in enumerate(planes):
        if plane is None:
            continue
        found = np.frombuffer(plane, np.uint8)
        if bits:
            raw[:, k // 8] |= np.unpackbits(found, count=count, bitorder="little") << np.uint8(k % 8)
        else:
            raw[:, k] = found
    return raw.view(kind).reshape(count)


class PlaneWriter:
    """Writes one file, block by block, to any stream that takes bytes."""

    def __init__(self, sink, bits: bool, block_ids: int) -> None:
        self.sink, self.bits, self.block_ids = sink, bits, block_ids
        self.press = zstandard.ZstdCompressor(level=LEVEL)
        self.chunks: list[dict] = []
        self.waiting: list[np.ndarray] = []
        self.count = self.held = 0
        self.docs: list[tuple[np.ndarray, ...]] = []
        sink.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, doc_ids: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Documents (null: without an id), their numbers of ids, and all their ids in a row."""
        known = doc_ids.is_valid().to_numpy(zero_copy_only=False)
        self.docs.append((doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"), known.astype("u1"), lengths.astype("<u4")))
        self.waiting.append(ids.astype("<u4"))
        self.held += len(ids)
        while self.held >= self.block_ids:
            flat = np.concatenate(self.waiting)
            self._chunk("ids", flat[:self.block_ids], "<u4")
            self.waiting, self.held = [flat[self.block_ids:]], self.held - self.block_ids

    def _chunk(self, what: str, values: np.ndarray, kind: str) -> None:
        planes = []
        for plane in to_planes(values, self.bits):
            packed = self.press.compress(plane) if any(plane) else b""
            self.sink.write(packed)
            planes.append([self.at, len(packed)])
            self.at += len(packed)
        self.chunks.append({"what": what, "kind": kind, "count": len(values), "first": self.count if what == "ids" else 0, "planes": planes})
        self.count += len(values) if what == "ids" else 0

    def close(self) -> tuple[int, int, int]:
        """Numbers of documents, ids and bytes."""
        if self.held:
            self._chunk("ids", np.concatenate(self.waiting), "<u4")
        n_docs = sum(len(d[0]) for d in self.docs)
        for k, (what, kind) in enumerate((("doc_ids", "<i8"), ("has_id", "u1"), ("lengths", "<u4"))):
            self._chunk(what, np.concatenate([np.zeros(0, kind), *[d[k] for d in self.docs]]), kind)
        index = json.dumps({"bits": self.bits, "chunks": self.chunks}).encode()
        tail = index + len(index).to_bytes(4, "little") + MAGIC
        self.sink.write(tail)
        return n_docs, self.count, self.at + len(tail)


class PlaneReader:
    """Reads chunks of one file through its index; source: a file that can seek."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        tail = len(MAGIC) + 4
        if size < 2 * len(MAGIC) + 4:
            raise ValueError("not a file of id planes")
        source.seek(size - tail)
        end = source.read(tail)
        if end[4:] != MAGIC:
            raise ValueError("not a file of id planes")
        length = int.from_bytes(end[:4], "little")
        source.seek(size - tail - length)
        index = json.loads(source.read(length))
        self.bits, self.chunks = index["bits"], index["chunks"]
        self.open = zstandard.ZstdDecompressor()

    def chunk(self, entry: dict) -> np.ndarray:
        planes = []
        for at, size in entry["planes"]:
            if size:
                self.source.seek(at)
            planes.append(self.open.decompress(self.source.read(size)) if size else None)
        return from_planes(planes, entry["count"], entry["kind"], self.bits)

    def named(self, what: str) -> np.ndarray:
        return np.concatenate([self.chunk(c) for c in self.chunks if c["what"] == what])

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """Each document's id and token ids in order; one block is held at a time."""
        blocks = iter([c for c in self.chunks if c["what"] == "ids"])
        held, at = np.zeros(0, "<u4"), 0
        for doc, known, length in zip(*(self.named(w).tolist() for w in ("doc_ids", "has_id", "lengths")), strict=True):
            parts = []
            while length:
                if at == len(held):
                    held, at = self.chunk(next(blocks)), 0
                take = min(length, len(held) - at)
                parts.append(held[at:at + take])
                at += take
                length -= take
            yield doc if known else None, np.concatenate(parts) if len(parts) != 1 else parts[0]


def write_ids(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 0, bits: bool = False, block_ids: int = BLOCK_IDS, file_ids: int = FILE_IDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode all texts, end_id behind each, into files below folder, ascending by id over (part, file).

    Returns the manifest, written: path, part, file, n_docs, n_ids, n_bytes. Rows without an id come
    first and keep none; a null text is a document of the end id alone; rows that share an id are ordered by a hash
    of their text, so that the sort's sample holds no texts. An empty
    table gives no file. Names hold the attempt, and only files in the manifest count, so a lost task leaves a file
    that nobody reads. The folder may be in any store that pyarrow opens.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocabulary, True)
        part, file, writer, sink, path = TaskContext.get().partitionId(), 0, None, None, ""
        where, base = fs.FileSystem.from_uri(folder)
        where.create_dir(base, recursive=True)

        def closed() -> pa.RecordBatch:
            docs_ids_bytes = writer.close()
            sink.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([part], pa.int32()), pa.array([file], pa.int32()), *(pa.array([n], pa.int64()) for n in docs_ids_bytes)], ["path", "part", "file", "n_docs", "n_ids", "n_bytes"])

        for batch in batches:
            for rows in slices(batch):
                flat, bounds = encoder.encode(rows.column("text"))
                ids = np.insert(flat, bounds[1:], end_id)
                if writer is None:
                    path = f"{folder.rstrip('/')}/ids-{part:06d}-{file:04d}-{uuid.uuid4().hex[:8]}.planes"
                    sink = where.open_output_stream(fs.FileSystem.from_uri(path)[1])
                    writer = PlaneWriter(sink, bits, block_ids)
                writer.add(rows.column(0), np.diff(bounds) + 1, ids)
                if writer.count >= file_ids:
                    yield closed()
                    writer, file = None, file + 1
        if writer is not None:
            yield closed()

    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return settle(rows.orderBy("doc_id", F.xxhash64("text")).mapInArrow(run, MANIFEST), "manifest")


def read_ids(manifest: DataFrame) -> DataFrame:
    """What the files of a manifest hold: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    ship_package(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist(), strict=True):
                where, inside = fs.FileSystem.from_uri(path)
                with where.open_input_file(inside) as source:
                    rows = []
                    for doc, ids in PlaneReader(source).documents():
                        rows.append((doc, start, len(ids), crc32(np.ascontiguousarray(ids, "<u4"))))
                        start += len(ids)
                        if len(rows) == 50_000:
                            yield _rows(rows)
                            rows = []
                    yield _rows(rows)

    ordered = running_total(manifest.withColumn("_all", F.lit(0)), ["_all"], ["part", "file"], "n_ids", "upto")
    files = ordered.select("path", (F.col("upto") - F.col("n_ids")).alias("before"))
    return files.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _rows(rows: list[tuple[int | None, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])


def written_and_read(docs: DataFrame, vocabulary: str, end_id: int = 0, bits: bool = False) -> DataFrame:
    """write_ids into a new place in the shared folder, then read_ids."""
    return read_ids(write_ids(docs, vocabulary, scratch_path(docs.sparkSession, "planes"), end_id, bits))
