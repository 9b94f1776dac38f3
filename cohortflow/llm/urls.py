"""URL filter: host and path rules first, a logistic regression on hashed character n-grams for the rest.

The model is fitted on a small labelled table of URLs, given or the one below, on the driver. Host and path are hashed
apart, so that a word means one thing in a host and another in a path; white space and case don't count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cohortflow.llm.linear import logistic, sigmoid
from cohortflow.llm.shipping import ship_package

#: Hashed features, and the shortest and longest character sequences.
FEATURES, SHORTEST, LONGEST = 1 << 14, 3, 5
RIDGE = 0.005
#: Distinct URLs that are taken apart at once.
BATCH = 2000
BLOCKED_FROM = 0.5

#: A small labelled table (fixed values, made up): URLs to block and URLs to allow.
BLOCK_URLS = (
    "http://cheap-pills.example/buy/viagra-online", "http://www.best-casino.example/bonus/free-spins", "https://online-casino-slots.example/en/jackpot",
    "http://poker-bonus.example/join", "https://xxx-videos.example/free-porn", "http://adult-cams.example/live/sex-chat", "https://hot-singles.example/dating/sex",
    "http://payday-loans.example/apply/fast-cash", "https://quick-loan.example/bad-credit", "http://replica-watches.example/rolex/cheap", "https://cheap-meds.example/pharmacy/no-prescription",
    "http://discount-pharmacy.example/pills/order", "https://crack-keygen.example/download/serial", "http://torrent-movies.example/full/free-download", "http://free-warez.example/crack/photoshop",
    "https://win-prize.example/claim/free-iphone", "http://lottery-winner.example/claim-now", "https://make-money-fast.example/work-from-home", "http://get-rich.example/crypto-bonus",
    "https://seo-links.example/buy-backlinks", "http://buy-followers.example/cheap-likes", "https://weight-loss.example/miracle-diet-pills", "http://diet-pills.example/order/cheap",
    "https://betting-tips.example/sports-bet/odds", "http://slots.example/casino/spin", "http://escort-girls.example/city", "https://nude-pics.example/gallery/xxx",
    "http://fake-id.example/buy/passport", "https://cheap-viagra.example/order", "http://spam-host.example/click/here?win=1", "https://casino.example/poker", "http://pills.example/cheap/generic",
    "http://www.free-bets.example/en/31", "https://blog.casino-bonus.example/de/345", "http://m.adult-videos.example/fr/9", "https://win-casino.example/es/77.html", "http://www.cheap-rolex.example/de/603",
    "https://m.free-casino.example/en/190?page=2", "http://blog.sex-shop.example/fr/418#top", "https://adult-x.example/es/555/", "http://www.big-win.example/en/820", "https://bets-online.example/de/74?ref=x",
    "http://pills-shop.example/fr/266", "https://www.xxx-adult.example/en/939.html", "http://ads-tracker.example/de/12", "https://track-ads.example/en/88", "http://popup-ads.example/es/41",
)
ALLOW_URLS = (
    "https://www.library.example/catalogue/history", "http://blog.gardening.example/2019/05/roses", "https://news.example/en/politics/budget", "https://university.example/department/physics/lecture-notes.html",
    "http://museum.example/exhibitions/impressionists", "https://docs.software.example/guide/install.html", "https://forum.cooking.example/thread/1234", "http://www.city-council.example/en/services/waste",
    "https://recipes.example/soups/lentil", "https://encyclopedia.example/wiki/Photosynthesis", "http://weather.example/forecast/today", "https://journal.example/articles/2020/12",
    "https://open-source.example/project/readme", "http://school.example/de/stundenplan.html", "https://hospital.example/patients/visiting-hours", "https://travel.example/fr/paris/musees",
    "http://books.example/authors/austen", "https://maps.example/es/madrid", "https://music.example/orchestra/season", "http://blog.astronomy.example/en/847#top", "https://www.railway.example/timetable/785.html",
    "http://m.newspaper.example/en/25?page=2", "https://science.example/de/artikel/502.html", "http://research.example/papers/681", "https://www.theatre.example/fr/programme/12", "http://archive.example/en/300?utm_source=feed",
    "https://birds.example/en/species/27/", "http://chess.example/es/partidas/92", "https://law.example/en/statutes/460?page=2&ref=x", "http://farm.example/de/obst/252", "https://www.history.example/en/9#top", "http://m.philosophy.example/fr/588",
    "http://www.theatre-notes.example/en/31", "https://blog.weather-there.example/de/345", "http://m.other-lands.example/fr/9", "https://rather-than.example/es/77.html", "http://www.leather-craft.example/de/603",
    "https://m.mother-tongue.example/en/190?page=2", "http://blog.thesis.example/fr/418#top", "https://thermal-baths.example/es/555/", "http://www.together.example/en/820", "https://station-house.example/de/74?ref=x",
    "http://nation-state.example/fr/266", "https://www.thrift.example/en/939.html", "http://a.example/", "http://x.example/p", "https://ab.example/1", "https://www.b.example",
    "http://roads.example/de/12", "https://racing.example/en/88", "http://pop-music.example/es/41",
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null URL or one without ://."""
    known = url.isNotNull() & url.contains("://")
    rest = F.substring_index(F.regexp_replace(url, "(?s)^.*?://", ""), "#", 1)
    rest = F.substring_index(rest, "?", 1)
    slash = F.instr(rest, "/")
    host = F.when(slash > 0, F.left(rest, slash - 1)).otherwise(rest)
    path = F.when(slash > 0, F.substring(rest, slash, F.length(rest))).otherwise("")
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(known, lower).otherwise(""), F.when(known, path).otherwise("")


def rule_for(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (ties: first in order of text) that fits, or null; rules: host and path start -> allow or block."""
    found: Column | None = None
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        of, start = rule[: rule.index("/")], rule[rule.index("/"):]
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(start)
        found = F.when(fits, rule) if found is None else found.when(fits, rule)
    return F.lit(None).cast("string") if found is None else found


def features(hosts: list[str], paths: list[str]) -> np.ndarray:
    """Unit rows of hashed n-grams of host and path, with marks at both ends; a host's last label is left out."""
    hosts = [h.rpartition(".")[0] or h for h in hosts]
    out = np.zeros((len(hosts), FEATURES), np.float32)
    for i, parts in enumerate(zip(hosts, paths, strict=True)):
        for kind, part in zip("hp", parts, strict=True):
            text = f"^{part.lower()}$"
            for n in range(SHORTEST, LONGEST + 1):
                for k in range(len(text) - n + 1):
                    out[i, xxhash.xxh32_intdigest(kind + text[k:k + n]) % FEATURES] += 1
    np.sqrt(out, out=out)
    return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-9)


def _parts(url: str) -> tuple[str, str]:
    rest = url.partition("://")[2].partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return host.lower(), slash + path


def fit(block: tuple[str, ...] = BLOCK_URLS, allow: tuple[str, ...] = ALLOW_URLS) -> tuple[np.ndarray, float]:
    """Weights and intercept; the table is small enough for the driver. Without URLs of both kinds: all zeros."""
    if not block or not allow:
        return np.zeros(FEATURES), 0.0
    hosts, paths = zip(*map(_parts, (*block, *allow)), strict=True)
    w, b = logistic(features(list(hosts), list(paths)).astype(float), np.array([1.0] * len(block) + [0.0] * len(allow)), RIDGE)
    return w, b


def judge(pages: DataFrame, rules: dict[str, str], block: tuple[str, ...] = BLOCK_URLS, allow: tuple[str, ...] = ALLOW_URLS, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row.

    score is the model's probability that the URL should be blocked; the verdict is the longest fitting rule's, else block
    from BLOCKED_FROM on. A null URL or one without :// has an empty host and path, no rule, and the model's verdict on
    them, allow where the labelled table gives no reason for another. Other columns are left out.
    """
    ship_package(pages.sparkSession)
    weights, intercept = fit(block, allow)
    host, path = host_and_path(F.col(url_column).cast("string"))
    parts = pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path"))
    kind = parts.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in range(0, batch.num_rows, BATCH):
                some = batch.slice(f, BATCH)
                x = features(some.column("host").to_pylist(), some.column("path").to_pylist())
                score = np.where((x != 0).any(1), sigmoid(x @ weights + intercept), 0.0)
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(score)], ["page_id", "host", "path", "score"])

    scored = parts.mapInArrow(run, f"page_id {kind}, host string, path string, score double")
    ruled = scored.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    verdict = F.when(F.col("score") >= BLOCKED_FROM, "block").otherwise("allow")
    for rule, what in rules.items():
        verdict = F.when(F.col("rule") == rule, what).otherwise(verdict)
    return ruled.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
