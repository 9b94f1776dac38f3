"""Host rules and the pipeline's stages against brute force, on odd rows and clashing columns."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortflow.llm import hostrules
from tests.llm.helpers import ODD, prose
from tests.llm.test_dedup import exact, near, lowered

BLANK = "[\x20\x09-\x0d]"


def measured(text):
    text = text or ""
    w = re.findall(f"[^{BLANK[1:]}+", text)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(f"[^{BLANK[1:]}", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered)


def judged(rows):
    """rows: id, text, source. Verdicts in their order."""
    facts = [(i, s, measured(t)) for i, t, s in rows]
    base = [n < 20 or 100 * r > 30 * n for _, _, (n, *_, r) in facts]
    other = [10 * sym > n or 2 * dup > lines or chars > 20 * n for _, _, (n, chars, sym, lines, dup, _) in facts]
    hosts = defaultdict(lambda: [0, 0])
    for (_, s, _), b, o in zip(facts, base, other, strict=True):
        if s is not None:
            hosts[s][0] += 1
            hosts[s][1] += b or o
    n, f = sum(x for x, _ in hosts.values()), sum(y for _, y in hosts.values())
    m = f / n if n else 0.0
    v = sum(x * (y / x) ** 2 for x, y in hosts.values()) / n - m * m if n else 0.0
    k = max(hostrules.LEAST_WEIGHT, min(hostrules.MOST_WEIGHT, m * (1 - m) / v - 1)) if v > 1e-12 else hostrules.MOST_WEIGHT
    out = []
    for (i, s, (n, chars, sym, _, dup, rep)), b, o in zip(facts, base, other, strict=True):
        rate = (hosts[s][1] + m * k) / (hosts[s][0] + k) if s is not None else None
        trust, reject = rate is not None and rate < hostrules.TRUST, rate is not None and rate > hostrules.REJECT
        out.append((i, n, chars, sym, dup, rep, b, not b and not reject and (trust or not o)))
    return out


def host_rows():
    rows = [(i, t, "odd") for i, t in ODD] + [(500, prose(9, 40), None), (501, "# " * 30, None), (502, None, None)]
    for i in range(60):
        rows.append((600 + i, prose(i, 30 + i), "good.example"))
        rows.append((700 + i, "| % " * 40 if i % 20 else prose(i, 50), "bad.example"))
        rows.append((800 + i, (prose(i, 12) + "\n") * (1 + i % 3) + prose(i + 1, 30), f"small{i % 7}.example"))
    rows += [(900 + i, "* " + prose(i, 6) + " $", "bad.example") for i in range(200)]
    rows.append((999, f"{prose(7, 9)} a {prose(7, 9)}" + " # $ %" * 12, "good.example"))
    return rows


@pytest.mark.parametrize("small", [100_000, 0])
def test_host_rules(spark, monkeypatch, small):
    monkeypatch.setattr(hostrules, "SMALL", small)
    rows = host_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_words", F.lit("clash")).withColumn("kept", F.lit(0))
    found = hostrules.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(judged(rows), key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert hostrules.judge(docs.limit(0)).count() == 0


def test_lines_keep_their_own_white_space(spark):
    rows = [(1, "abc\r\nabc\r\n", 1), (2, " x y\n x y", 1), (3, "x y\nx y ", 0), (4, "\n\n a\n a\n\n", 1), (5, "a\r\nb\r\na", 0), (6, " \n ", 0), (7, None, 0)]
    rows += [(10 + i, f"{end}{prose(i, 30)}{end}{prose(i, 30)}{end}", None) for i, end in enumerate(["\r\n", "\n", "\n\t", " \n"])]
    docs = spark.createDataFrame([(i, t, "h") for i, t, _ in rows], "doc_id long, text string, source string")
    found = {r.doc_id: (r.n_lines, r.n_dup_lines) for r in hostrules.measures(docs).collect()}
    for i, text, repeats in rows:
        assert found[i] == measured(text)[3:5] and repeats in (None, found[i][1])


def test_prior_pulls_small_hosts_to_the_mean(spark):
    rows = host_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    hosts = {r.host: r for r in hostrules.host_verdicts(hostrules.measures(docs), "source").collect()}
    mean = sum(r.n_failed for r in hosts.values()) / sum(r.n_docs for r in hosts.values())
    for r in hosts.values():
        low, high = sorted((r.n_failed / r.n_docs, mean))
        assert low - 1e-9 <= r.rate <= high + 1e-9
    assert hosts["bad.example"].host_verdict == "reject"


EXTRA = {"source": "string", "_among_0": "int", "kept": "string", "score": "string", "_toxicity": "string", "_digest": "int", "n_words": "string"}


@pytest.fixture(scope="module")
def crowded(spark):
    rows = [(i, t, "en", s, 0) for i, t, s in host_rows()] + [(7, "x" * 30_000, "en", "odd", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, kind in EXTRA.items():
        if name != "source":
            docs = docs.withColumn(name, F.lit(1).cast(kind))
    return docs


def pairs(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text").collect()), key=repr)


def test_stages_keep_what_they_should(spark, sf_dir, crowded):
    rows = [tuple(r) for r in crowded.select("doc_id", "text", "source").collect()]
    stage = dict(corpus_pipeline.STAGES)

    clean = stage["toxicity"](spark, crowded, sf_dir)
    assert clean.columns == crowded.columns and len(pairs(clean)) == len(rows)  # nothing toxic in these

    good = stage["quality_rules"](spark, crowded, sf_dir)
    want = [(i, t) for (i, t, _), verdict in zip(rows, judged(rows), strict=True) if verdict[-1]]
    assert good.columns == crowded.columns and pairs(good) == sorted(want, key=repr)

    once = stage["exact_dedup"](spark, crowded, sf_dir)
    texts = [(i, t) for i, t, _ in rows]
    keep = {lowered(t): i for i, t in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0))}
    got = pairs(once)
    assert once.columns == crowded.columns and sorted(((lowered(t), i) for i, t in got), key=repr) == sorted(keep.items(), key=repr)
    assert len(exact(texts)) == len(texts)

    apart = stage["near_dedup"](spark, once, sf_dir)
    left = {i for i, _, component, kept in near(got) if kept}
    assert apart.columns == crowded.columns and pairs(apart) == sorted(((i, t) for i, t in got if i in left), key=repr)

    packed = stage["packing"](spark, apart, sf_dir)
    assert sorted({r.doc_id for r in packed.select("doc_id").collect()}, key=repr) == sorted(left, key=repr)


def test_stages_take_nothing(spark, sf_dir, crowded):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, crowded.limit(0), sf_dir).count() == 0


def test_run_applies_the_stages_in_order(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "exact_dedup", "near_dedup", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    packed = {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").collect()}
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("toxic = 1").collect()}
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    failed = {v[0] for v in judged(rows) if v[6]}
    assert packed and not packed & failed and len(packed & toxic) < len(toxic) / 2
