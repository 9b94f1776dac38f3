"""Toxicity, URL filter, language and language-model scores: held-out accuracy, brute-force parts, odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortflow.llm import langid, linear, maxent, toxicity, urls
from cohortflow.llm.queries import QUERIES, URL_RULES
from cohortflow.llm.words import fold_of
from tests.llm.helpers import ODD, SCHEMA, prose, words

INSULTS = ("blockhead", "numbskull", "dimwitted", "worthless")


def feature_map(word):
    """The kernel's features written out: subsequences of three letters, each occurrence weighted by its span."""
    out = Counter()
    for i in range(len(word)):
        for j in range(i + 1, len(word)):
            for k in range(j + 1, len(word)):
                if k - i < toxicity.SPAN:
                    out[word[i] + word[j] + word[k]] += toxicity.DECAY ** (k - i + 1)
    return out


def kernel(a, b):
    x, y = feature_map(a), feature_map(b)
    norm = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    k = sum(v * y[u] for u, v in x.items()) / norm if norm else 0.0
    k *= sum(v for u, v in y.items() if u in x) / sum(y.values())  # the share of the landmark's subsequences that the word holds
    return k if k >= toxicity.FLOOR else 0.0


def test_kernel_equals_its_definition():
    said = ["blockhead", "blxockhead", "bloockhead", "block", "ab", "headblock", "numbskull", "aaaa", "dimwited", "calm"]
    found = toxicity.Similarity([w.encode() for w in INSULTS]).texts(pa.array(said))
    for i, w in enumerate(said):
        for j, mark in enumerate(INSULTS):
            assert found[i, j] == pytest.approx(kernel(w, mark), abs=1e-4)


def test_kernel_sees_through_marks_blanks_and_length():
    similarity = toxicity.Similarity([b"blockhead"])
    for text in ("b-l-o-c-k-h-e-a-d", "you b l o c k h e a d !", "BLOCKHEAD,", "calm " * 5000 + "blockhead", "wtrspvunyqzxgfmw" * 3 + "blockhead" + "tuvwyxrszpqmngfw" * 3):
        assert similarity.texts(pa.array(["calm words", text, None]))[:, 0].tolist()[1] > 0.05, text
    assert similarity.texts(pa.array(["", None, "a b c", "é"])).max() == 0


def test_kernel_keeps_heavily_gapped_words():
    for mark, said in (("moron", "moxrxon"), ("stupid", "stxuxpid"), ("idiot", "ixdxixoxt"), ("worthless", "woxrtxhlexss"), ("numbskull", "nuxmbsxkuxll"), ("idiot", "abcdidiotwxyzuvkl")):
        assert toxicity.Similarity([mark.encode()]).texts(pa.array([said]))[0, 0] == pytest.approx(kernel(said, mark), abs=1e-4) and kernel(said, mark) > 0
    for word in (b"idiot", b"worthless"):
        gapped = toxicity._gapped(word)
        assert {len(g) - len(word) for g in gapped} == set(range(1, toxicity.GAPS + 1)) and all(g.replace(b"x", b"") == word for g in gapped)


@pytest.fixture(scope="module")
def toxic_docs(spark):
    rng, rows = random.Random(4), []
    for i in range(240):
        text = prose(i, 60).split()
        if i % 3 == 0:
            for w in rng.sample(INSULTS, 2):
                text.insert(rng.randint(0, 60), w)
        rows.append((i, " ".join(text), int(i % 3 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_held_out(spark, toxic_docs):
    docs, labels = toxic_docs.select("doc_id", "text"), toxic_docs.select("doc_id", "toxic")
    model = toxicity.fit(docs, labels, fold_of(F.col("doc_id"), 5) != 0)
    assert {w.decode() for w in model.landmarks} >= set(INSULTS)
    found = toxicity.score(docs, model).join(labels, "doc_id").collect()
    assert all((r.toxicity >= 0.5) == (r.toxic == 1) for r in found)
    extra = [(1, "what a bl_ockhead"), (2, "you dimmwitted one"), (3, "a plain remark"), *[(100 + i, t) for i, (_, t) in enumerate(ODD)]]
    frame = spark.createDataFrame(extra, SCHEMA).withColumn("toxicity", F.lit("clash")).withColumn("score", F.lit(None).cast("string"))
    scored = {r.doc_id: r.toxicity for r in toxicity.score(frame, model).collect()}
    assert scored[1] >= 0.5 and scored[2] >= 0.5 and all(0 <= s < 0.5 for i, s in scored.items() if i > 2)
    assert toxicity.score(frame.limit(0), model).count() == 0
    gapped = spark.createDataFrame([(1, "you woxrthxless one"), (2, "a nuxmbsxkull"), (3, "the blxockxhead"), (4, "dixmwixtted"), (5, prose(900, 60))], SCHEMA)
    *several, clean = [r.toxicity for r in toxicity.score(gapped, model).orderBy("doc_id").collect()]
    assert min(several) > 2 * clean  # two letters put in: nearer to toxic than to clean texts
    assert min(several) >= 0.5 > clean


INSULTS_THERE = ("trash", "pathetic", "idiot", "disgusting", "worthless", "stupid", "clown", "loser", "scum", "moron")


@pytest.mark.parametrize("sf, recall", [("sf0.01", 0.6), ("sf0.1", 0.78)])
def test_toxicity_of_the_tables(spark, sf, recall):
    """Each insult alone is toxic, with a letter put in too; plain texts aren't; recall and false share where nothing was learnt."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    fold = fold_of(F.col("doc_id"), 5)
    model = toxicity.fit(docs, labels, fold != 0)
    assert (model.weights >= 0).all()
    said = [(f"{w}-{g}", f"you are a {w[:len(w) // 2] + 'x' * g + w[len(w) // 2:]} here") for w in INSULTS_THERE for g in (0, 1)]
    plain = [("empty", ""), ("null", None), ("plain", "a plain remark about the weather"), ("long", prose(5, 3_000))]
    scored = {r.name: r.toxicity for r in toxicity.score(spark.createDataFrame(said + plain, "name string, text string"), model).collect()}
    assert all(scored[n] >= 0.5 for n, _ in said) and all(scored[n] < 0.5 for n, _ in plain), scored
    held = toxicity.score(docs.join(labels, "doc_id").filter(fold == 0), model).select("toxic", "toxicity").collect()
    caught = [r.toxicity >= 0.5 for r in held if r.toxic == 1]
    false = [r.toxicity >= 0.5 for r in held if r.toxic == 0]
    assert sum(caught) >= recall * len(caught) and sum(false) <= 0.05 * len(false)


def test_toxicity_without_a_class(spark, toxic_docs):
    docs = toxic_docs.select("doc_id", "text")
    for labels in (toxic_docs.select("doc_id", "toxic").filter("toxic = 0"), toxic_docs.select("doc_id", "toxic").limit(0)):
        model = toxicity.fit(docs, labels)
        assert model is None and {r.toxicity for r in toxicity.score(docs, model).collect()} == {0.0}


def test_toxicity_query(spark, sf_dir):
    rows = QUERIES["op1_toxicity"].run(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def reference_url(url):
    if url is None or "://" not in url:
        return "", "", None
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in URL_RULES if (host == (h := r.split("/")[0]) or host.endswith("." + h)) and path.startswith(r[len(h):])]
    return host, path, max(fits, key=len, default=None)


ODD_URLS = [None, "", "abc", "http://", "http://A.com", "http://A.com/", "x://www.EXAMPLE.com/en/?q", "http://example.com?x://y", "a://b://c/d", "http://h#f/x",
            "http://net/es/", "http://foo.net/es", "//x", "http://a.com:80/p\nq?z", "http://É.COM/en/", "ftp://com/", "http://" + "long." * 5000 + "net/fr/", None]


def test_url_rules_and_model(spark, sf_dir):
    given = [(r.page_id, r.url) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()]
    given += [(10_000 + i, u) for i, u in enumerate(ODD_URLS)] + [(None, "http://a.org")]
    pages = spark.createDataFrame(given, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("score", F.lit("x"))
    found = {r.page_id: r for r in urls.judge(pages, URL_RULES).collect()}
    assert len(found) == len(given)
    for page, url in given:
        host, path, rule = reference_url(url)
        r = found[page]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (URL_RULES[rule] if rule else "block" if r.score >= urls.BLOCKED_FROM else "allow")
    assert found[10_000].verdict == "allow"
    assert urls.judge(pages.limit(0), URL_RULES).count() == 0


def test_url_model_generalises():
    w, b = urls.fit()
    score = lambda u: linear.sigmoid(urls.features(*map(list, zip(urls._parts(u), strict=True))) @ w + b)[0]
    assert all(score(u) > 0.5 for u in ("http://mega-casino.net/", "https://cheap-pills-now.org/en/4", "http://free-xxx.com/adult"))
    assert all(score(u) < 0.5 for u in ("https://en.wikipedia.org/wiki/Cat", "http://www.weather.gov/today", "https://blog.roses.org/de/7"))
    assert not urls.fit((), ())[0].any()


def test_language_held_out(spark, sf_dir):
    rows = QUERIES["op8_language"].run(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    rng = random.Random(6)
    syllables = {"en": "the and ing er", "de": "der und ung sch", "fr": "le et eau oi", "es": "el y cion os", "tlh": "qa plj ghot", "ja": "日本 です"}
    rows = [(f"{rng.choice(s.split())}{rng.choice(s.split())} " * 30, lang) for lang, s in syllables.items() for _ in range(25)]
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert set(model.families) == {"germanic", "romance", "only tlh", "only ja"} and len(model.within["romance"]) == 1
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert sum(got[i].lang_pred == lang for i, (_, lang) in enumerate(rows)) / len(rows) > 0.95
    odd = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(ODD)], SCHEMA).withColumn("score", F.lit("clash"))
    told = {r.doc_id: r for r in langid.predict(odd, model).collect()}
    for i, (_, text) in enumerate(ODD):
        assert (told[i].lang_pred == "und") == (text is None or not any(c.isalpha() for c in text))
        assert 0 <= told[i].score <= 1
    nothing = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"} and langid.predict(odd.limit(0), model).count() == 0


def base_scores(rows, learns):
    counts = Counter(w for i, t in rows if learns(i) for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    return n, [(i, len(w), sum(x in counts for x in w), sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)) for i, t in rows for w in [[*words(t), None]]]


@pytest.mark.parametrize("frequent", [1 << 19, 600])
def test_language_model_base_and_gain(spark, sf_dir, frequent):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()] + ODD[:4] + ODD[7:]
    rows = list({i: (i, t) for i, t in rows}.values())
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("clash"))
    found = {r.doc_id: r for r in maxent.score(docs, fold_of(F.col("doc_id"), 7) != 2, rounds=2, frequent=frequent).collect()}
    n, want = base_scores(rows, lambda i: zlib.crc32(str(i).encode()) % 7 != 2)
    base = model = 0.0
    for i, tokens, known, score in want:
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, n) and r.base_score == pytest.approx(score, rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0
        if zlib.crc32(str(i).encode()) % 7 == 2:
            base, model = base + r.base_score, model + r.score
    assert model > base  # on texts it hasn't seen


def test_language_model_shares_add_up_and_gradients_point_up():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, maxent._START, 3000)
    starts = np.array([0, 1000, 1000, 3000])
    flat = maxent.initial(np.bincount(ids[ids < maxent._VOCAB], minlength=maxent._VOCAB), 50.0)
    before = maxent.log_shares(maxent._views(flat), ids, starts).sum()
    trainer = maxent.Trainer(flat, 0.1)
    for _ in range(5):
        trainer.learn(ids, starts)
    view = maxent._views(trainer.flat)
    assert maxent.log_shares(view, ids, starts).sum() > before
    zero = np.zeros(1, np.int64)
    outer, _ = maxent._features(zero, zero, zero, zero)
    total = maxent._shares(view, outer)[0, -1]
    for c in range(maxent.CLASSES):
        _, inner = maxent._features(zero, zero, zero, zero + c)
        total += maxent._shares(view, outer)[0, c] * maxent._shares(view, inner).sum()
    assert total == pytest.approx(1.0, abs=1e-4)


def test_language_model_with_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "c")], SCHEMA)
    found = sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in maxent.score(docs, F.lit(False)).collect())
    assert found == [(1, 0, 0, 0.0), (2, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert maxent.score(docs.limit(0), F.lit(True)).count() == 0


def test_language_model_tells_words_beyond_the_vocabulary_apart():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(1 << 62), 1 << 62, 4000)
    n = maxent._VOCAB
    first, second = keys[:40], keys[40:80]  # each of the first is followed by its own one of the second
    at = rng.integers(0, 40, 6000)
    text = np.stack([first[at], second[at]], 1).ravel()
    ids, starts = n + text % maxent.RARE, np.array([0, len(text)])
    bits = maxent.leaf_bits(len(keys))
    sizes = np.bincount(maxent.leaf_of(np.concatenate([keys, text]), bits), minlength=1 << bits)
    leaves = maxent.Leaves(sizes)
    assert (1 << bits) * maxent.LEAF_WORDS <= len(keys) < (1 << bits) * maxent.LEAF_WORDS * 2
    flat = maxent.initial(np.zeros(n), float(len(text)), maxent.fine_rows(len(keys)))
    trainer = maxent.Trainer(flat, 0.15, leaves)
    for _ in range(6):
        trainer.learn(ids, starts, text)
    follows = maxent.log_shares(trainer.view, ids, starts, keys=text, leaves=leaves)[1::2].mean()
    mixed = text.copy()
    mixed[1::2] = second[(at + 1 + rng.integers(0, 39, len(at))) % 40]
    other = maxent.log_shares(trainer.view, n + mixed % maxent.RARE, starts, keys=mixed, leaves=leaves)[1::2].mean()
    assert follows > other + 1
    # all leaves together have the share of their class
    spread, total = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits), 0.0
    for k in spread.view(np.int64):
        pair = np.array([text[0], k])
        total += 10 ** maxent.log_shares(trainer.view, n + pair % maxent.RARE, np.array([0, 2]), keys=pair, leaves=leaves)[1]
    assert total == pytest.approx(10 ** maxent.log_shares(trainer.view, n + text[:2] % maxent.RARE, np.array([0, 2]), keys=text[:2])[1], rel=1e-3)


def test_language_model_walks_by_one_weight_a_level_and_feature():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 50, 1 << 7)
    leaves, fine = maxent.Leaves(sizes), 1 << 15
    keys = (np.arange(1 << 7, dtype=np.uint64) << np.uint64(64 - 7)).view(np.int64)
    flat = maxent.initial(np.zeros(maxent._VOCAB), float(sizes.sum()), fine)
    view, start = maxent._views(flat), np.array([0, 1])
    rare = np.array([maxent._VOCAB])
    of_class = maxent.log_shares(view, rare, start, keys=keys[:1])[0]
    # before anything is learnt, leaves have the shares of their counts
    shares = [10 ** (maxent.log_shares(view, rare, start, keys=k, leaves=leaves)[0] - of_class) for k in keys[:, None]]
    assert shares == pytest.approx((sizes + 1) / (sizes + 1).sum(), rel=1e-4)
    trainer = maxent.Trainer(flat, 0.15, leaves)
    trainer.learn(rare, start, keys[77:78])
    changed = (trainer.flat != flat)[-fine * maxent.WORDS:].sum()
    assert changed <= 2 * (maxent.CLASSES + 1) + 3 * 7  # the class by two fine rows, then seven levels by three features
    assert maxent.log_shares(trainer.view, rare, start, keys=keys[77:78], leaves=leaves)[0] > math.log10(shares[77]) + of_class


def test_changes_are_averaged_over_the_tasks_that_made_them():
    a, b = np.zeros(2 * maxent.GROUP, np.float16), np.zeros(2 * maxent.GROUP, np.float16)
    a[:maxent.GROUP], b[0], b[maxent.GROUP:] = 1, 4, 2
    parts = [maxent._parted(a, 10), maxent._parted(b, 20)]
    data, seen = maxent._averaged([p[0][0] for p in parts], [p[1][0] for p in parts])
    found = np.frombuffer(data, np.float16)
    assert found[0] == 3 and (found[maxent.GROUP:] == 2).all() and np.frombuffer(seen, np.float32).tolist() == [30, 20]


def test_linear_models_separate():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 5))
    y = x @ np.array([1, -2, 0.5, 0, 0]) + 0.3 > 0
    w, b = linear.support_vectors(x, y, 10.0)
    assert ((x @ w + b > 0) == y).mean() > 0.97
    slope, shift = linear.calibrated(x @ w + b, y)
    assert slope > 0 and (np.abs(linear.sigmoid(slope * (x @ w + b) + shift) - y) < 0.5).mean() > 0.97
    w, b = linear.logistic(x, y.astype(float), 0.01)
    assert ((x @ w + b > 0) == y).mean() > 0.97
