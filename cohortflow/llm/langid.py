"""Language identification in two steps: the family first, then the language within it.

Texts become frequencies of hashed byte sequences. Linear support vector machines, one for every two families, vote for
the family; machines for every two languages of this family, trained on those two alone, vote for the language, so that
what tells close languages apart isn't drowned by what tells families apart. Margins are calibrated; the score is the
product of both votes' shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cohortflow.llm.linear import calibrated, sigmoid, support_vectors
from cohortflow.llm.shipping import ship_package
from cohortflow.llm.words import ascii_lower, is_space, slices, text_bytes

#: Texts per language that the machines are fitted on, and in all, shared out evenly among many languages; the bound of
#: what they learn from and of what the driver holds.
PER_LANGUAGE, MOST_TEXTS = 600, 4000
#: Hashed features, and the longest byte sequence.
FEATURES, LONGEST = 4096, 4
#: Families by the tags of their languages (fixed values); a tag not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tt"),
    "indo-aryan": ("hi", "ur", "bn", "mr", "gu", "pa", "ne", "si"),
    "semitic": ("ar", "he", "mt", "am"),
    "baltic": ("lt", "lv"),
    "celtic": ("ga", "cy", "br", "gd"),
}
UNKNOWN = "und"


class Machine(NamedTuple):
    """Tells first from second; a positive margin means first."""

    first: str
    second: str
    weights: np.ndarray
    intercept: float
    slope: float
    shift: float


class Model(NamedTuple):
    families: dict[str, list[str]]
    between: list[Machine]
    within: dict[str, list[Machine]]


def family_of(language: str, families: dict[str, tuple[str, ...]] = FAMILIES) -> str:
    base = language.lower().replace("_", "-").split("-")[0]
    return next((name for name, tags in families.items() if base in tags), f"only {language}")


def frequencies(texts: pa.Array) -> np.ndarray:
    """Square roots of the shares of hashed sequences of 1 to LONGEST bytes, of unit length; A-Z lower-cased, white space as one blank."""
    data, bounds = text_bytes(texts)
    data = ascii_lower(data)
    space = is_space(data)
    data = np.where(space, np.uint8(32), data)
    kept = np.ones(len(data), bool)
    kept[1:] = ~(space[1:] & space[:-1])
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))[kept]
    data = data[kept].astype(np.uint32)
    out = np.zeros((len(texts), FEATURES), np.float32)
    code = np.zeros(len(data), np.uint32)
    for n in range(1, LONGEST + 1):
        if len(data) < n:
            break
        code = code[:len(data) - n + 1] * np.uint32(257) + data[n - 1:]
        same = text[:len(code)] == text[n - 1:]
        at = ((code * np.uint32(2654435761)) >> np.uint32(20))[same]  # the upper twelve bits
        flat = text[:len(code)][same] * FEATURES + at
        out += np.bincount(flat, minlength=out.size).reshape(out.shape).astype(np.float32)
    out = np.sqrt(out)
    return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-9)


def _machine(x: np.ndarray, first: np.ndarray, names: tuple[str, str]) -> Machine:
    w, b = support_vectors(x, first, c=1.0)
    slope, shift = calibrated(x @ w + b, first)
    return Machine(*names, w, b, slope, shift)


def fit(docs: DataFrame, fold: Column | None = None, per_language: int = PER_LANGUAGE, text_column: str = "text", lang_column: str = "lang", id_column: str = "doc_id") -> Model:
    """Learn from rows that fold marks, with a language and a text that has a letter.

    At most per_language rows of each language and MOST_TEXTS in all, chosen by a hash of id and text, leave the executors, as features. Rows
    of a language beyond that are counted in each task before they are ranked, so a frequent language loads no task.
    """
    ship_package(docs.sparkSession)
    known = docs.filter(F.lit(True) if fold is None else fold).select(
        F.col(text_column).cast("string").alias("text"), F.col(lang_column).cast("string").alias("lang"),
        F.xxhash64(F.col(id_column), F.col(text_column)).alias("h")).filter("lang IS NOT NULL AND lang <> '' AND text IS NOT NULL")
    # how far a language's hashes go before its bound is reached, from its number of rows
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return Model({}, [], {})
    per_language = max(1, min(per_language, MOST_TEXTS // len(counts)))
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, 1.2 * per_language / n))])
    likely = known.filter((F.col("h").cast("double") / 2.0 ** 64 + 0.5) <= F.element_at(share, F.col("lang")))
    first = likely.withColumn("_r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("_r") <= per_language)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = frequencies(part.column("text")).astype(np.float16)
                rows = part.append_column("x", pa.array([r.tobytes() for r in x], pa.binary())).select(["lang", "x"])
                yield rows.filter(_has_letter(part.column("text")))

    rows = first.select("text", "lang").mapInArrow(run, "lang string, x binary").toArrow()
    x = np.stack([np.frombuffer(v.as_buffer(), np.float16) for v in rows.column("x")]).astype(np.float32) if rows.num_rows else np.zeros((0, FEATURES), np.float32)
    lang = np.array(rows.column("lang").to_pylist(), str)
    del rows
    families: dict[str, list[str]] = {}
    for name in sorted(set(lang.tolist())):
        families.setdefault(family_of(name), []).append(name)
    family = np.array([family_of(name) for name in lang.tolist()])

    def pairs(names: list[str], of: np.ndarray) -> list[Machine]:
        out = []
        for a, b in combinations(sorted(names), 2):
            some = (of == a) | (of == b)
            out.append(_machine(x[some], of[some] == a, (a, b)))
        return out

    return Model(families, pairs(list(families), family), {f: pairs(members, lang) for f, members in families.items()})


def _has_letter(texts: pa.Array) -> pa.Array:
    return pc.match_substring_regex(texts.fill_null(""), r"\p{L}")


def _votes(x: np.ndarray, names: list[str], machines: list[Machine]) -> np.ndarray:
    """Share of each name, rows by names: the machines' probabilities added up."""
    if len(names) == 1:
        return np.ones((len(x), 1))
    out = np.zeros((len(x), len(names)))
    for m in machines:
        p = sigmoid(m.slope * (x @ m.weights + m.intercept) + m.shift)
        out[:, names.index(m.first)] += p
        out[:, names.index(m.second)] += 1 - p
    return out / (len(names) - 1)


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id_column, lang_pred and score (0 to 1) of every whole text.

    A null text, one without a letter, and every text if nothing was learned: `und` with score 0. Equal votes go to the
    name that sorts first. Other columns are left out.
    """
    ship_package(docs.sparkSession)
    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        families = sorted(model.families)
        for batch in batches:
            for part in slices(batch, most=4 << 20):
                n = part.num_rows
                for f in range(0, n, 512):
                    some = part.slice(f, 512)
                    texts = some.column(1)
                    named = np.full(some.num_rows, UNKNOWN, object)
                    score = np.zeros(some.num_rows)
                    told = _has_letter(texts).to_numpy(zero_copy_only=False)
                    if families and told.any():
                        x = frequencies(texts)
                        votes = _votes(x, families, model.between)
                        best = votes.argmax(1)
                        for k, name in enumerate(families):
                            rows = np.flatnonzero((best == k) & told)
                            if len(rows):
                                members = model.families[name]
                                inner = _votes(x[rows], members, model.within[name])
                                top = inner.argmax(1)
                                named[rows] = np.array(members, object)[top]
                                score[rows] = votes[rows, k] * inner[np.arange(len(rows)), top]
                    yield pa.RecordBatch.from_arrays([some.column(0), pa.array(named, pa.string()), pa.array(np.clip(score, 0, 1))], schema.names)

    return docs.select(F.col(id_column), F.col(text_column).cast("string").alias("text")).mapInArrow(run, schema)
