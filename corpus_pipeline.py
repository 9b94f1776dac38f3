"""From documents to packed sequences: toxic texts go, then low quality, then copies, then near copies; the rest is packed.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of documents for the
rows they keep. Defined results for odd rows, at every stage: a null text counts as empty; rows without an id stay unless
their text is rejected or copied; extra columns are carried along whatever their names; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortflow.llm import exactdup, hostrules, neardup, packing, toxicity
from cohortflow.llm.queries import vocabulary
from cohortflow.llm.words import fold_of
from cohortflow.session import scratch_path

#: Toxicity from which a document goes.
TOXIC = 0.5


def _among(docs: DataFrame, chosen: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Rows of docs whose keys are a row of chosen, null equal to null; keys: chosen's column -> expression over docs."""
    names = [f"_among_{i}" for i in range(len(keys))]
    right = chosen.select(*[F.col(c).alias(n) for c, n in zip(keys, names, strict=True)]).distinct()
    same = F.lit(True)
    for n, key in zip(names, keys.values(), strict=True):
        same = same & key.eqNullSafe(right[n])
    return docs.join(right, same, "left_semi")


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that docs doesn't have."""
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below TOXIC. The model learns as in op1, from the labelled documents of sf_dir."""
    known = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = toxicity.fit(known, spark.read.parquet(f"{sf_dir}/labels.parquet"), fold_of(F.col("doc_id"), 5) != 0)
    into = _unused(docs, "_toxicity")
    return toxicity.score(docs, model, into=into).filter(F.col(into) < TOXIC).drop(into)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the host rules keep. Rows alike in id, source and text are judged alike."""
    text = F.xxhash64(F.col("text"))
    judged = hostrules.judge(docs, [F.col("doc_id").alias("_id"), F.col("source").alias("_source"), text.alias("_hash")])
    return _among(docs, judged.filter("kept"), {"_id": F.col("doc_id"), "_source": F.col("source"), "_hash": text})


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id; of rows that repeat this id with its text, one."""
    found = exactdup.groups(docs).filter("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("times"))
    lower = F.translate(F.coalesce(F.col("text"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    keys = {"doc_id": F.col("doc_id"), "text_sha256": F.sha2(lower, 256)}
    once = _among(docs, found.filter("times = 1"), keys)
    repeated = _among(docs, found.filter("times > 1"), keys)
    digest = _unused(docs, "_digest")
    one = repeated.withColumn(digest, F.sha2(lower, 256)).dropDuplicates(["doc_id", digest]).drop(digest)
    return once.unionByName(one)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of near-duplicates join, the one with the smallest id."""
    found = neardup.near_duplicates(docs).filter("kept")
    return _among(docs, found, {"doc_id": F.col("doc_id")})


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in sequences of at most 4096, one row per piece."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality_rules", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: SQL can't express the string kernel machine or BPE; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
