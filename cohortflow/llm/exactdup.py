"""Exact deduplication by Grace hash partitioning.

Records are dealt to buckets by a hash of their whole normalised text; the shuffle's files are the spill files. A bucket's
task fills an open-addressing table that compares complete texts. When the table has reached its bytes it takes no new
text: records whose text is not in it are written out and dealt again by another hash into as many buckets as their bytes
need, until every text has found a table. Equal texts are folded before each shuffle, so a group of copies that holds a
third of all rows reaches its bucket as one record per batch read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortflow.llm.shipping import bound_batches, ship_package
from cohortflow.llm.words import ascii_lower, parts, text_bytes
from cohortflow.session import scratch_path

#: Bytes of distinct texts that one bucket's table may hold.
TABLE_BYTES = 128 << 20

RECORD = "hash bigint, digest string, text binary, ids array<bigint>"
#: digest with ids: members of a group; digest with keep_id and n: a group; with text: still to be dealt.
FOUND = RECORD + ", keep_id bigint, n bigint"


class TextTable:
    """Open addressing with linear probing; a slot holds the position of an entry, equal means equal in full."""

    def __init__(self) -> None:
        self.slots, self.hashes, self.texts, self.bytes = np.full(1 << 10, -1, np.int64), [], [], 0

    def find(self, code: int, text: bytes) -> tuple[int, int]:
        """The entry of the text or -1, and the slot where the search ended."""
        mask = len(self.slots) - 1
        at = code & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == code and self.texts[entry] == text:
                return int(entry), at
            at = (at + 1) & mask
        return -1, at

    def add(self, code: int, text: bytes, at: int) -> int:
        """A new entry in the free slot that find gave."""
        entry = len(self.texts)
        self.slots[at] = entry
        self.hashes.append(code)
        self.texts.append(text)
        self.bytes += len(text)
        if 2 * len(self.texts) > len(self.slots):
            self.slots = np.full(2 * len(self.slots), -1, np.int64)
            mask = len(self.slots) - 1
            for i, h in enumerate(self.hashes):
                at = h & mask
                while self.slots[at] >= 0:
                    at = (at + 1) & mask
                self.slots[at] = i
        return entry


def _records(rows: list[tuple]) -> pa.RecordBatch:
    """rows: hash, digest, text, ids, keep_id, n."""
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64())
    names = ["hash", "digest", "text", "ids", "keep_id", "n"]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as records, equal texts of a slice as one."""
    for part in parts(batches):
        data, bounds = text_bytes(part.column("text"))
        data = ascii_lower(data).tobytes()
        table, ids, codes = TextTable(), [], []
        for i, doc in enumerate(part.column(0).to_pylist()):
            text = data[bounds[i]:bounds[i + 1]]
            code = xxhash.xxh64_intdigest(text) >> 1
            entry, at = table.find(code, text)
            if entry < 0:
                table.add(code, text, at)
                ids.append([])
                codes.append(code)
            ids[entry].append(doc)
        yield _records([(c, sha256(t).hexdigest(), t, i, None, None) for c, t, i in zip(codes, table.texts, ids, strict=True)]).select(["hash", "digest", "text", "ids"])


def _bucket(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, digests, keep, sizes = TextTable(), [], [], []
        for batch in batches:
            out = []
            for code, digest, text, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                entry, at = table.find(code, text)
                if entry < 0 and table.texts and table.bytes + len(text) > most:
                    out.append((code, digest, text, ids, None, None))
                    continue
                if entry < 0:
                    entry = table.add(code, text, at)
                    digests.append(digest)
                    keep.append(None)
                    sizes.append(0)
                known = [i for i in ids if i is not None]
                if known:
                    keep[entry] = max(known) if keep[entry] is None else max(keep[entry], *known)
                sizes[entry] += len(ids)
                out.append((None, digest, None, ids, None, None))
            yield _records(out)
        if len(set(digests)) < len(digests):
            raise ValueError("two different texts share a digest; groups cannot be told apart by it")
        for first in range(0, len(digests), 10_000):
            span = slice(first, first + 10_000)
            yield _records([(None, d, None, None, k, n) for d, k, n in zip(digests[span], keep[span], sizes[span], strict=True)])

    return run


def groups(docs: DataFrame, table_bytes: int = TABLE_BYTES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The group of equal texts of every row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty. The largest id of a group is
    its keep_id and kept marks the rows that have it (rows that repeat an id with its text are all marked). A null id
    counts in group_size; it is kept only in a group without other ids, whose keep_id is null. Empty table: no rows.
    Ids are whole numbers; other columns are left out. The text travels once, and again only where a bucket overflows.
    """
    spark: SparkSession = docs.sparkSession
    ship_package(spark)
    bound_batches(spark)
    records = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(_folded, RECORD)
    buckets, level, found = int(spark.conf.get("spark.sql.shuffle.partitions")), 0, []
    while buckets:
        path = scratch_path(spark, f"buckets-{level}")
        dealt = records.repartition(buckets, F.col("hash"), F.lit(level))
        dealt.mapInArrow(_bucket(table_bytes), FOUND).write.parquet(path)
        written = spark.read.schema(FOUND).parquet(path)
        found.append(written.filter(F.col("hash").isNull()).drop("text", "hash"))
        records = written.filter(F.col("hash").isNotNull()).select("hash", "digest", "text", "ids")
        over = records.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
        buckets = 0 if not over[1] else 2 + 2 * int(over[0]) // table_bytes
        level += 1
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    heads = every.filter(F.col("n").isNotNull()).select(F.col("digest").alias("_digest"), "keep_id", F.col("n").alias("group_size"))
    members = every.filter(F.col("n").isNull()).select("digest", "ids")
    return (members.join(heads, F.col("digest") == F.col("_digest"))
            .select(F.explode("ids").alias("doc_id"), "keep_id", "group_size", F.col("digest").alias("text_sha256"))
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))
