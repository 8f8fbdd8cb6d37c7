"""URL filters: host and path rules first, then a logistic regression on hashed character n-grams.

DataFrame and SQL functions only. The model is trained from a small labelled table of urls inside one SQL expression:
the rows' hashed n-gram vectors are gathered into one array (at most MAX_LABELLED rows, checked), and gradient steps
are an aggregate over it. The weights, one double for each bucket, become a literal of the scoring expression.

Null urls and urls without ``://`` have an empty host and path, no rule, and the model's verdict on no n-grams (its
bias). Repeated rows are judged alike; columns besides the id and url are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A row of the labelled table: url, 1 to allow or 0 to block.
LABELLED = [
    ("https://docs.library.org/en/guide/intro", 1), ("https://www.university.edu/research/paper/1204", 1),
    ("https://news.daily.org/2024/05/science-report.html", 1), ("https://en.encyclopedia.org/wiki/Granite", 1),
    ("https://blog.maker.net/posts/how-to-solder", 1), ("https://museum.gov/collection/item/883", 1),
    ("https://forum.gardeners.net/topic/211/tomatoes", 1), ("https://www.recipes.com/bread/rye.html", 1),
    ("https://journal.medicine.org/article/2231", 1), ("https://school.edu/lessons/algebra/3", 1),
    ("https://www.city.gov/services/water", 1), ("https://archive.books.org/text/77/chapter/4", 1),
    ("https://weather.example.org/de/12", 1), ("https://m.history.example.org/fr/771.html", 1),
    ("https://blog.travel.example.net/en/1034", 1), ("https://www.code.example.org/en/55/", 1),
    ("https://wiki.birds.net/species/wren", 1), ("https://lists.kernel.org/archive/msg0042.html", 1),
    ("https://poems.example.net/de/921", 1), ("https://www.law.gov/statute/55/section/2", 1),
    ("http://casino-bonus.biz/win/free-spins?ref=x", 0), ("http://cheap-pills.shop/buy/viagra", 0),
    ("http://xxx-video.club/watch/hot", 0), ("http://ads.tracker.biz/click?utm_source=spam", 0),
    ("http://login.secure-bank.top/verify/account", 0), ("http://free-download.click/crack/keygen.exe", 0),
    ("http://poker-online.win/bonus/deposit", 0), ("http://adult-cams.club/live/girls", 0),
    ("http://loan-fast.biz/apply/now?utm_campaign=mail", 0), ("http://seo-links.top/buy/backlinks", 0),
    ("http://slots.casino.win/play/jackpot", 0), ("http://replica-watch.shop/sale/discount", 0),
    ("http://popup.ads.click/banner/redirect", 0), ("http://sex-dating.top/join/free", 0),
    ("http://lottery-prize.win/claim/winner", 0), ("http://torrent-crack.click/serial/full", 0),
    ("http://bet-odds.biz/sports/bonus", 0), ("http://tracker.click/pixel?utm_source=ads", 0),
    ("http://miracle-diet.shop/pills/buy-now", 0), ("http://spam-mail.top/unsubscribe/click", 0),
]

#: (host, path, verdict) in the form host + path: a rule fits its host and all subdomains.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]

MAX_LABELLED = 2000
BUCKETS = 512
SIZES = (3, 4, 5)
EPOCHS, RATE, DECAY = 25, 0.5, 1e-4


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null and where there is no ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def buckets(host: Column, path: Column) -> Column:
    """Hash buckets of the character n-grams of host and path, each with marks at its ends."""

    def sized(marked: Column, kind: str, n: int) -> Column:
        places = F.when(F.length(marked) >= n, F.sequence(F.lit(1), F.length(marked) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.pmod(F.xxhash64(F.lit(f"{kind}{n}"), F.substring(marked, i, F.lit(n))), F.lit(BUCKETS)).cast("int"))

    def grams(text: Column, kind: str) -> Column:
        marked = F.concat(F.lit("^"), text, F.lit("$"))
        return F.concat(*[sized(marked, kind, n) for n in SIZES])

    return F.concat(grams(host, "h"), grams(path, "p"))


def labelled_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LABELLED, "url string, label int")


def train(labelled: DataFrame) -> list[float]:
    """Weights of the buckets and, last, the bias. labelled: (url, label 0 or 1), at most MAX_LABELLED rows; rows with nulls are left out."""
    rows = labelled.select("url", "label").dropna().limit(MAX_LABELLED + 1)
    host, path = split_url(F.col("url"))
    found = rows.select(F.col("url"), F.col("label").cast("double").alias("y"), buckets(host, path).alias("b"))
    share = 1 / F.greatest(F.sqrt(F.size("b").cast("double")), F.lit(1.0))
    counts = F.aggregate("b", F.create_map().cast("map<int,double>"), lambda m, k: F.map_concat(F.map_filter(m, lambda a, _: a != k), F.create_map(k, F.coalesce(F.try_element_at(m, k), F.lit(0.0)) + 1.0)))
    found = found.withColumn("m", counts).withColumn("x", F.concat(F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda i: F.coalesce(F.try_element_at(F.col("m"), i), F.lit(0.0)) * share), F.array(F.lit(1.0))))
    gathered = found.agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct(F.xxhash64("url").alias("h"), "y", "x"))).alias("rows"))
    # the gradient's factor is worked out once for each row, not once for each weight
    factor = lambda w, r: RATE * (1 / (1 + F.exp(-F.aggregate(F.zip_with(w, r["x"], lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p))) - r["y"])
    step = lambda w, r: F.element_at(F.transform(F.array(factor(w, r)), lambda g: F.zip_with(w, r["x"], lambda a, v: a * (1 - RATE * DECAY) - v * g)), 1)
    start = F.array_repeat(F.lit(0.0), BUCKETS + 1)
    many = F.flatten(F.array_repeat(F.col("rows"), EPOCHS))
    n, weights = gathered.select("n", F.aggregate(many, start, step).alias("w")).first()
    if n > MAX_LABELLED:
        raise ValueError(f"the labelled table has over {MAX_LABELLED} rows")
    return weights


def judge(urls: DataFrame, weights: Sequence[float], rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = 0.5) -> DataFrame:
    """urls (page_id, url) with host, path, rule, the model's score (1: allow) and the verdict."""
    host, path = split_url(F.col("url"))
    out = urls.select("page_id", host.alias("host"), path.alias("path"))
    longest_first = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = lambda r: ((F.col("host") == r[0]) | F.col("host").endswith("." + r[0])) & F.col("path").startswith(r[1])
    rule, by_rule = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(longest_first):
        rule, by_rule = F.when(fits(r), r[0] + r[1]).otherwise(rule), F.when(fits(r), r[2]).otherwise(by_rule)
    table = F.lit(list(map(float, weights[:-1])))
    total = F.aggregate(buckets(F.col("host"), F.col("path")), F.lit(0.0), lambda s, k: s + F.element_at(table, k + 1))
    size = F.greatest(F.sqrt(F.size(buckets(F.col("host"), F.col("path"))).cast("double")), F.lit(1.0))
    score = 1 / (1 + F.exp(-(total / size + float(weights[-1]))))
    out = out.withColumns({"rule": rule, "score": score, "by_rule": by_rule})
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.when(F.col("score") >= threshold, "allow").otherwise("block")).alias("verdict"), "score")
