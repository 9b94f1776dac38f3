"""The registered queries of the training-data operators, with SQL where it can state their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortflow.catalog.base import Query, table
from cohortflow.llm import alignment, bitplanes, bpe, exactdup, hostrules, langid, maxent, neardup, packing, periodic, sharding, toxicity, urls
from cohortflow.llm.words import fold_of


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = fold_of(F.col("doc_id"), 5)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold != 0)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


#: Host and path starts with their verdicts.
URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostrules.judge(table(spark, sf_dir, "documents")).drop("rate")


def op3_ctes(docs: str) -> str:
    """CTEs up to `judged`, one row per row of docs, which has doc_id, text and source; also for the pipeline's SQL."""
    return f"""
q_docs AS (SELECT row_number() OVER () AS r, doc_id, source, trim(coalesce(text, ''), E' \\t\\n\\x0b\\f\\r') AS t FROM {docs}),
q_words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i
            FROM (SELECT r, regexp_split_to_array(t, '[ \\t-\\r]+') AS w FROM q_docs WHERE t <> '')),
q_sizes AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM q_words GROUP BY r),
q_windows AS (SELECT r, i, array_to_string(list(word) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING), ' ') AS w,
                     count(*) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS n FROM q_words),
q_twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS c FROM q_windows WHERE n = 8) WHERE c > 1),
q_gaps AS (SELECT r, least(8, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 8)) AS g FROM q_twice),
q_repeats AS (SELECT r, sum(g) AS n_repeat_words FROM q_gaps GROUP BY r),
q_lines AS (SELECT r, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines
            FROM (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS l FROM q_docs)),
q_all AS (SELECT d.r, doc_id, source, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
                 length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, n_lines::BIGINT AS n_lines,
                 n_dup_lines::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
          FROM q_docs d LEFT JOIN q_sizes USING (r) LEFT JOIN q_repeats USING (r) LEFT JOIN q_lines USING (r)),
q_rules AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
                   10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR word_chars > 20 * n_words AS other_failed FROM q_all),
q_hosts AS (SELECT source AS host, count(*) AS n, sum((base_failed OR other_failed)::INT) AS f FROM q_rules WHERE source IS NOT NULL GROUP BY source),
q_moments AS (SELECT sum(f) / sum(n) AS m, sum(n * (f / n) * (f / n)) / sum(n) - (sum(f) / sum(n)) * (sum(f) / sum(n)) AS v FROM q_hosts),
q_prior AS (SELECT m, CASE WHEN v > 1e-12 THEN greatest({hostrules.LEAST_WEIGHT}, least({hostrules.MOST_WEIGHT}, m * (1 - m) / v - 1))
                      ELSE {hostrules.MOST_WEIGHT} END AS k FROM q_moments),
q_verdicts AS (SELECT host, (f + m * k) / (n + k) AS rate FROM q_hosts, q_prior),
judged AS (SELECT r, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines,
                  CASE WHEN rate > {hostrules.REJECT} THEN 'reject' WHEN rate < {hostrules.TRUST} THEN 'trust' ELSE 'watch' END AS host_verdict,
                  NOT base_failed AND coalesce(rate <= {hostrules.REJECT}, TRUE) AND (coalesce(rate < {hostrules.TRUST}, FALSE) OR NOT other_failed) AS kept
           FROM q_rules LEFT JOIN q_verdicts ON source = host)"""


OP3_SQL = f"WITH {op3_ctes('documents')} SELECT * EXCLUDE (r) FROM judged"


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.groups(table(spark, sf_dir, "documents"))


#: Lower-cases A-Z alone.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5_SQL = f"""
WITH d AS (SELECT doc_id, {_LOWER} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM d WINDOW same AS (PARTITION BY norm)
"""


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op7_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.written_and_read(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = fold_of(F.col("doc_id"), 3)
    held_out = F.coalesce(fold == 1, F.lit(False)).alias("held_out")
    return langid.predict(docs, langid.fit(docs, fold != 1)).select("doc_id", held_out, "lang_pred", "score")


def op9_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = fold_of(F.col("doc_id"), 7)
    return maxent.score(table(spark, sf_dir, "documents"), fold != 2).select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; where crc32(doc_id) is divisible by 10, the words from some word on repeat with some period.

    With h the crc32, g = h div 10 and n words, word i >= a = g mod n becomes word a + (i - a) mod p of the text, where
    p = 1 + (n - a) div (3 + g mod 8). Rows without an id and texts without words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("_g"), F.when(h % 10 == 0, split).alias("_words"))
    rows = rows.withColumn("_n", F.size("_words")).withColumn("_a", (F.col("_g") % F.greatest("_n", F.lit(1))).cast("int"))
    rows = rows.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    left = F.col("_n") - F.col("_a")
    copies = F.array_repeat(F.slice("_words", F.col("_a") + 1, F.col("_p")), F.ceil(left / F.col("_p")).cast("int"))
    words = F.concat(F.slice("_words", F.lit(1), F.col("_a")), F.slice(F.flatten(copies), F.lit(1), left))
    return rows.select("doc_id", F.when(F.col("_n") > 0, F.concat_ws(" ", words)).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_repeated_tails(table(spark, sf_dir, "documents")), exponent=4, least=6)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("before"), (-r.period).alias("shorter"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    start, period = -best.before, -best.shorter
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), best.length.alias("length"), period.alias("period"),
        F.floor(1000 * best.length / period).alias("exponent_milli"), F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


#: crc32 of the id bit by bit; runs as islands of equal three-word passages a period apart, at the smallest period of a stretch.
OP11_SQL = r"""
WITH q_docs AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), E'[ \t-\r]+'), lambda x: x <> '') AS w,
    CASE WHEN doc_id IS NOT NULL THEN xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda acc, add: xor(xor(acc, add) >> 1, CASE WHEN xor(acc, add) & 1 = 1 THEN 3988292384 ELSE 0 END))) END AS h FROM documents),
q_tails AS (SELECT r, doc_id, w, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN h // 10 % len(w) END AS a FROM q_docs),
q_lists AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i:
    CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) END AS w FROM q_tails),
q_words AS (SELECT r, n, unnest(w) AS word, unnest(range(n)) AS i FROM q_lists WHERE n > 0),
q_three AS (SELECT r, n, i, word || ' ' || lead(word) OVER u || ' ' || lead(word, 2) OVER u AS t FROM q_words WINDOW u AS (PARTITION BY r ORDER BY i)),
q_pairs AS (SELECT x.r, x.i, y.i - x.i AS q FROM q_three x JOIN q_three y ON x.r = y.r AND x.t = y.t AND y.i > x.i AND (y.i - x.i) * 4 <= x.n),
q_islands AS (SELECT r, q, min(i) AS s, max(i) + 3 + q - min(i) AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM q_pairs) GROUP BY r, q, k),
q_runs AS (SELECT r, s, length, min(q) AS q FROM q_islands WHERE length >= greatest(6, 4 * q) GROUP BY r, s, length),
q_found AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS listed FROM q_runs GROUP BY r),
q_best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY length DESC, s, q) AS k FROM q_runs) WHERE k = 1),
q_dropped AS (SELECT DISTINCT w.r, w.i FROM q_words w JOIN q_runs x ON x.r = w.r AND w.i >= x.s + x.q AND w.i < x.s + x.length),
q_kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS collapsed FROM q_words ANTI JOIN q_dropped USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, b.s::BIGINT AS start, b.length::BIGINT AS length, b.q::BIGINT AS period,
       (1000 * b.length // b.q)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM q_lists LEFT JOIN q_found USING (r) LEFT JOIN q_best b USING (r) LEFT JOIN q_kept USING (r)
"""


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=16).withColumn("grown_shard", F.lit(None).cast("int"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_strength(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": Query(op1_toxicity),
    "op2_url_filter": Query(op2_url_filter),
    "op3_host_rules": Query(op3_host_rules, OP3_SQL),
    "op4_near_dedup": Query(op4_near_dedup),
    "op5_exact_dedup": Query(op5_exact_dedup, OP5_SQL),
    "op6_bpe_round_trip": Query(op6_bpe_round_trip),
    "op7_id_planes": Query(op7_id_planes),
    "op8_language": Query(op8_language),
    "op9_maxent_scores": Query(op9_maxent_scores),
    "op10_packing": Query(op10_packing),
    "op11_periodic_runs": Query(op11_periodic_runs, OP11_SQL),
    "op12_shards": Query(op12_shards),
    "op13_alignment": Query(op13_alignment),
}
