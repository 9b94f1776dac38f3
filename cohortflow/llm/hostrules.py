"""Quality rules by host: failures are counted per domain, rates shrunk by a beta prior, verdicts joined back.

DataFrame functions only. A document's measures are written once, without its text; hosts are counted from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortflow.session import settle

#: White space: 0x20 and 0x09 to 0x0D.
BLANKS = " \t\n\u000b\f\r"
WINDOW = 8
#: A host whose shrunk failure rate is above REJECT loses all its documents; below TRUST a document's own failures are forgiven.
REJECT, TRUST = 0.8, 0.01
#: Hosts whose verdicts may travel to every task, some 60 bytes each.
SMALL = 100_000
#: Bounds of the prior's weight in documents.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1e6


def measures(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """docs without text_column, with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (all long).

    Lines are those of the untrimmed text, white space at their ends included; lines of white space alone don't count.
    Windows of eight words are compared by 64-bit hashes inside one text. Rows keep their number and other columns; a
    null text has no words. Columns of docs with these names are replaced.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    carried = [c for c in docs.columns if c != text_column and c not in made]
    carry = [F.col(f"`{c}`") for c in carried]
    whole = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    step = docs.select(*carry, whole.alias("_whole")).select(*carry, "_whole", F.btrim("_whole", F.lit(BLANKS)).alias("_t"))
    no_words = F.array().cast("array<string>")
    step = step.select(
        *carry,
        F.when(F.col("_t") == "", no_words).otherwise(F.split("_t", "[ \t-\r]+")).alias("_words"),
        F.regexp_count("_t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("_whole", "\n"), lambda x: x.rlike("[^ \t-\r]")).alias("_lines"),
    )
    step = step.select(
        *carry, "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
    )
    reach = 1
    while reach < WINDOW:  # hashes of 2, 4, 8 words from two hashes of half as many
        kept = [c for c in step.columns if c != "_h"]
        left = F.size("_h") - reach
        both = F.zip_with(F.slice("_h", F.lit(1), left), F.slice("_h", F.lit(1 + reach), left), lambda a, b: F.xxhash64(a, b))
        step = step.select(*[F.col(f"`{c}`") for c in kept], F.when(left > 0, both).otherwise(F.array().cast("array<bigint>")).alias("_h"))
        reach *= 2
    kept = [F.col(f"`{c}`") for c in step.columns if c != "_h"]
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    placed = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.select(*kept, F.when(repeats, placed).alias("_s"))
    twice = F.filter(F.transform("_s", lambda x, k: F.when(
        x["h"].eqNullSafe(F.get("_s", k - 1)["h"]) | x["h"].eqNullSafe(F.get("_s", k + 1)["h"]), x["i"])), lambda i: i.isNotNull())
    step = step.select(*kept, F.sort_array(twice).alias("_p"))
    covered = F.transform("_p", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", k + 1) - i, F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0), lambda a, n: a + n)
    return step.select(*kept, F.coalesce(total, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rule_failed() -> Column:
    """Any rule a host is judged by: the base rules, a symbol for ten words, over half of the lines repeated, words too long."""
    return (base_failed() | (10 * F.col("n_symbols") > F.col("n_words")) | (2 * F.col("n_dup_lines") > F.col("n_lines"))
            | (F.col("word_chars") > 20 * F.col("n_words")))


def host_verdicts(measured: DataFrame, host_column: str = "source") -> DataFrame:
    """host, n_docs, n_failed, rate (shrunk), host_verdict (reject, watch or trust).

    The prior is fitted to all hosts: its mean is the share of failed documents, its weight follows from the spread of
    the hosts' rates (moments). A null host is none. Counts are summed before they are shuffled, so a host with a third
    of all documents costs no more than another.
    """
    hosts = (measured.filter(F.col(host_column).isNotNull()).groupBy(F.col(host_column).alias("host"))
             .agg(F.count(F.lit(1)).alias("n_docs"), F.sum(rule_failed().cast("long")).alias("n_failed")))
    rate = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(
        (F.sum("n_failed") / F.sum("n_docs")).alias("_m"),
        (F.sum(F.col("n_docs") * rate * rate) / F.sum("n_docs")).alias("_s"))
    mean, spread = F.col("_m"), F.col("_s") - F.col("_m") * F.col("_m")
    weight = F.when(spread > 1e-12, F.greatest(F.lit(LEAST_WEIGHT), F.least(F.lit(MOST_WEIGHT), mean * (1 - mean) / spread - 1))).otherwise(F.lit(MOST_WEIGHT))
    first = prior.select(mean.alias("m"), weight.alias("k")).first()
    m, k = (first["m"] or 0.0, first["k"] or MOST_WEIGHT) if first else (0.0, MOST_WEIGHT)
    shrunk = (F.col("n_failed") + F.lit(m * k)) / (F.col("n_docs") + F.lit(k))
    return hosts.withColumn("rate", shrunk).withColumn(
        "host_verdict", F.when(F.col("rate") > REJECT, "reject").when(F.col("rate") < TRUST, "trust").otherwise("watch"))


def judge(docs: DataFrame, keys: list[Column] | None = None, host_column: str = "source", text_column: str = "text") -> DataFrame:
    """keys (doc_id if none), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines, rate, host_verdict.

    kept: no base rule fails, the host isn't rejected, and no other rule fails unless the host is trusted. Documents
    without a host are judged as of a watched one. One row per row of docs; an empty table gives none.
    """
    rows = docs.select(*(keys or [F.col("doc_id")]), F.col(host_column).alias("_host"), F.col(text_column).alias("_text"))
    measured = settle(measures(rows, "_text"), "measures")
    hosts = settle(host_verdicts(measured, "_host").select(F.col("host").alias("_of"), "rate", "host_verdict"), "hosts")
    if hosts.count() <= SMALL:  # beyond that documents and hosts are dealt by host, and Spark splits a hot one
        hosts = F.broadcast(hosts)
    joined = measured.join(hosts, F.col("_host") == F.col("_of"), "left").withColumn("host_verdict", F.coalesce("host_verdict", F.lit("watch")))
    kept = ~base_failed() & (F.col("host_verdict") != "reject") & ((F.col("host_verdict") == "trust") | ~rule_failed())
    named = [c for c in measured.columns if c not in ("_host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")]
    return joined.select(*named, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base_failed().alias("base_failed"), kept.alias("kept"), "n_lines", "rate", "host_verdict")
