"""URL filtering by rules and a logistic regression on hashed character n-grams of host and path, with DataFrame functions only.

The regression is fitted to a labelled table by Spark's own optimiser, whose gradients are sums over the rows by features, so
the driver holds weights of a fixed number and no rows. The weights go into the scoring expression as one literal.
"""

from __future__ import annotations

import random
from hashlib import blake2b

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, Normalizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words that names of sites to block are made of, with what commonly stands beside them, from general vocabulary.
BLOCKED = """casino poker roulette jackpot slots betting bets lottery bingo gambling pills pharma viagra meds porn xxx adult sex cams escort
dating spam scam phishing malware virus warez crack keygen torrent payday loans debt ads adserver banner popups tracker clicks traffic""".split()
BESIDE = "online best bonus club vip world deals now hot 24 farm cheap free".split()
BLOCKED_PATHS = """win-bonus free-spins cheap-pills adult-videos live-cams nude-pics hot-singles bet-now jackpot-winner crack-download keygen-free
payday-loan track/click ads/banner popunder phishing-login casino-games poker-room sex-chat xxx-movies torrent-files""".split()
#: Words that names of sites to allow are made of.
ALLOWED = """news library university museum garden weather recipes council health school travel archive maps music journal science history
theatre gallery water mountain river forest house kitchen family winter summer market bridge village church castle island harbour station
letter paper painting language teacher student doctor hospital research engine planet ocean animal flower bread cheese coffee
cycling football chess running sailing climbing logic number reader writer office insurance bank energy solar railway airport hotel
furniture clothing shoes pottery carpentry software hardware robotics statistics chemistry biology geology law parliament embassy charity""".split()
PARTS = "the of and city open free-time daily local".split()
ALLOWED_PATHS = """about contact articles news/today products/shoes recipes/soup docs/install wiki/history help/faq events/2023 gallery/photos
courses/maths jobs team blog/garden reports/annual weather/week sports/results books/reviews en de fr es index.html 2021/05""".split()
#: Most sites have names that mean nothing; these are made of syllables, so that a name is not held against its site for being unknown.
STARTS, MIDDLES, ENDS = "b br c ch d f g gr h k l m n p pl r s sh st t th tr v w wh z".split(), "a e i o u ea ou io".split(), "l m n nd ng r s st t ly".split()


def invented_names(n: int) -> list[str]:
    """Names of two and three syllables by turns, from the digits of a hash of their number."""
    out = []
    for i in range(n):
        h = int.from_bytes(blake2b(f"name {i}".encode(), digest_size=16).digest(), "big")
        name = ""
        for _ in range(2 + i % 2):
            for part in (STARTS, MIDDLES, [*ENDS, ""]):
                h, k = divmod(h, len(part))
                name += part[k]
        out.append(name)
    return out


def labelled_urls(thirds: tuple[int, ...] = (0, 1, 2)) -> list[tuple[str, int]]:
    """(url, 1 to block) of the names and paths whose number modulo 3 is among ``thirds``; all by default.

    Names are a word, a word and what stands beside it, or syllables. A name to block is so with any path, and a path to block
    with any name; prefixes, domains and numbers are alike in both classes, so that they tell nothing.
    """
    bad = [x for i, w in enumerate(BLOCKED) for x in (w, *(f"{w}-{BESIDE[(i + k) % len(BESIDE)]}" if k % 2 else f"{BESIDE[(i + k) % len(BESIDE)]}-{w}" for k in range(1, 6)))]
    good = [x for i, w in enumerate(ALLOWED) for x in (w, f"{w}-{PARTS[i % len(PARTS)]}", f"{PARTS[(i + 3) % len(PARTS)]}-{w}")] + invented_names(600)
    rows = [(name, None, label, i, k) for label, names in ((1, bad), (0, good)) for i, name in enumerate(names) for k in range(10 if label else 3)]
    rows += [(None, path, 1, i, k) for i, path in enumerate(BLOCKED_PATHS) for k in range(24)]
    out = []
    for name, path, label, i, k in rows:
        if i % 3 in thirds:
            pick = random.Random(f"{name} {path} {k}")  # the rest of an address is drawn alike for both classes
            host = pick.choice(["", "www.", "m.", "blog."]) + (name or pick.choice(good)) + pick.choice([".example.com", ".example.net", ".example.org"])
            out.append((f"{pick.choice(['http', 'https'])}://{host}/{path or pick.choice(ALLOWED_PATHS)}{pick.choice(['', '/', f'/{pick.randrange(1000)}'])}", label))
    return out


#: Fixed values: (verdict, host, beginning of the path).
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """From the first :// to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the host to ?, # or the end; empty for null or without ://."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_number(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Index of the longest rule that fits, or null; ties go to the first in the list. For short lists: one test a rule."""
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i][1] + rules[i][2]), i))
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.lit(i)) for i in order for _, h, p in (rules[i],)]
    return F.coalesce(*fits) if fits else F.lit(None).cast("int")


def grams(host: Column, path: Column, dims: int, sizes: tuple[int, ...] = (3, 4, 5)) -> Column:
    """Distinct hashed n-grams of host and of path (each with marks at its ends), and the constant feature ``dims``."""

    def of(part: Column, mark: str) -> Column:
        t = F.concat(F.lit(mark), part, F.lit("$"))
        return F.concat(*(F.when(F.length(t) >= n, F.transform(F.sequence(F.lit(1), F.length(t) - (n - 1)), lambda i, n=n: F.pmod(F.xxhash64(F.lit(mark), F.substr(t, i, F.lit(n))), F.lit(dims)).cast("int"))).otherwise(F.array().cast("array<int>")) for n in sizes))

    return F.array_distinct(F.concat(of(host, "^"), of(path, "/"), F.array(F.lit(dims))))


def fit(labelled: DataFrame, dims: int = 32768, decay: float = 3e-6, steps: int = 60) -> list[float]:
    """Weights of ``dims`` hashed n-grams and the constant, from rows (url, label 0 or 1).

    They make the mean loss, to which both labels contribute one half, plus decay / 2 times their squares least, in at most ``steps`` steps of the optimiser. Null urls or labels are
    left out; repeated rows count each. Features are scaled so that an example has length 1. An empty table gives zero weights, which
    allow nothing and block nothing by themselves (a probability of one half).
    """
    rows = labelled.where("url is not null and label is not null").select(F.col("label").cast("double").alias("y"), F.transform(grams(host_of(F.col("url")), path_of(F.col("url")), dims), lambda g: g.cast("string")).alias("g"))
    if rows.isEmpty():
        return [0.0] * (dims + 1)
    share = rows.agg(F.avg("y")).first()[0]
    even = F.when(F.col("y") == 1, F.lit(0.5 / share) if share else F.lit(1.0)).otherwise(F.lit(0.5 / (1 - share)) if share < 1 else F.lit(1.0))
    names = CountVectorizer(inputCol="g", outputCol="n", vocabSize=dims + 1, binary=True).fit(rows)
    x = Normalizer(inputCol="n", outputCol="x").transform(names.transform(rows)).select("x", "y", even.alias("w"))
    model = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=decay, maxIter=steps, tol=1e-9, fitIntercept=False, standardization=False).fit(x)
    out = [0.0] * (dims + 1)
    for g, w in zip(names.vocabulary, model.coefficients.toArray().tolist(), strict=True):
        out[int(g)] = w
    return out


def probability(features: Column, weights: list[float]) -> Column:
    """Of the class 1, for an array of distinct features."""
    w = F.from_json(F.lit("[" + ",".join(repr(x) for x in weights) + "]"), "array<double>")
    total = F.aggregate(features, F.lit(0.0), lambda s, i: s + F.get(w, i))
    return 1 / (1 + F.exp(-total / F.sqrt(F.size(features))))


def labelled_table(spark: SparkSession, thirds: tuple[int, ...] = (0, 1, 2)) -> DataFrame:
    return spark.createDataFrame(labelled_urls(thirds), "url string, label int").coalesce(1)


def judge(pages: DataFrame, weights: list[float], rules: list[tuple[str, str, str]] = RULES, threshold: float = 0.5, url: str = "url", key: str = "page_id") -> DataFrame:
    """(key, host, path, rule, verdict, block_probability) of every row.

    rule is host and path of the longest rule that fits (its host or a subdomain, its path a beginning of
    the url's) or null; verdict is the rule's, else by the regression. A null url, or one without ://, has
    an empty host and path and is judged by the constant alone and the marks. Ties cannot arise between
    rules of one length that both fit, unless they are equal: then the first counts. Repeated rows and null keys are
    judged like others; other columns are not read.
    """
    rows = pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.withColumn("n", rule_number(F.col("host"), F.col("path"), rules)).withColumn("p", probability(grams(F.col("host"), F.col("path"), len(weights) - 1), weights))
    rule = F.coalesce(*(F.when(F.col("n") == i, F.lit(h + p)) for i, (_, h, p) in enumerate(rules)), F.lit(None).cast("string"))
    ruled = F.coalesce(*(F.when(F.col("n") == i, F.lit(v)) for i, (v, _, _) in enumerate(rules)), F.lit(None).cast("string"))
    verdict = F.coalesce(ruled, F.when(F.col("p") >= threshold, F.lit("block")).otherwise(F.lit("allow")))
    return rows.select(F.col("key").alias(key), "host", "path", rule.alias("rule"), verdict.alias("verdict"), F.col("p").alias("block_probability"))
