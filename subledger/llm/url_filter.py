"""Operator 6, URL filter: longest-match rules, then logistic regression on hashed character n-grams.

Host and path are cut from the URL with built-in functions. Rules fit a host and its subdomains when the path
starts with the rule's path; the longest rule wins. For URLs without a rule the verdict comes from a
logistic regression (MLlib) on hashed character 3- to 5-grams of host and path, trained on a small table of labelled URLs
(:func:`labelled_urls`). Its weights become one literal array; scoring is a sum over the URL's n-grams inside the
scan stage: no join, no shuffle, no Python."""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bind

BITS = 4096
SIZES = (3, 4, 5)
CUT = 0.5
# host/path rules of the contract: (action, host, path)
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]

# Words of hosts that corpora leave out, by kind, and words of ordinary hosts. Written from what such
# hosts are called in general; the pages that the filter judges had no part in it.
LEFT_OUT = {
    "gambling": "casino poker slots roulette jackpot bingo wager bets betting blackjack lottery gamble",
    "drugs": "pills viagra pharma meds tablets dosage slimming steroid tramadol xanax",
    "adult": "adult sex porn xxx nude cam escort erotic fetish hookup",
    "money": "payday loan forex crypto prize cash rich earn money credit",
    "piracy": "warez crack keygen torrent serial nulled cracked pirate",
    "spam": "spam linkfarm seo backlink traffic clickbait autoblog scraper",
    "tracking": "ads tracker track banner popup click pixel affiliate adserver redirect",
    "lures": "cheap free discount replica offer deal win bonus winner giveaway",
}
ORDINARY = ("news garden museum library school travel weather recipe history science music theatre railway chess "
            "painting archive nature health city law forum wiki university journal sport cycling football river "
            "mountain village kitchen bakery church hospital physics maths poetry novel cinema radio harbour island "
            "forest farmhouse market bridge castle airport bicycle coffee astronomy biology language grammar craft "
            "pottery knitting sailing hiking camping orchestra gallery festival council parliament newspaper").split()
SYLLABLES = "ba lo ri ne ta mo vi su ker lan tor mel dan fi gar hol jun pas que ster".split()
STARTS, ENDS = ["", "www.", "m.", "blog."], [".com", ".org", ".net", ".info"]
PATHS = ["/", "/en/1204.html", "/page/7", "/de/88", "/articles/2019/story", "/index.html", "/fr/310", "/post/15"]


def labelled_urls() -> list[tuple[str, str, int]]:
    """The training table (host, path, 1: leave out), made from the words by rule.

    Left out: every word alone, with the next one of its kind, with a lure behind it, and with a common ending.
    Ordinary: every word alone, with a later one, with a common ending, and invented names of syllables. Starts, ends
    and paths go round in the same way on both sides, so they tell nothing."""
    bad, good = [], []
    lures = LEFT_OUT["lures"].split()
    for k, words in enumerate(w.split() for w in LEFT_OUT.values()):
        for i, w in enumerate(words):
            bad += [w, f"{w}-{words[(i + 1) % len(words)]}", f"{w}{lures[(3 * i + k) % len(lures)]}", f"{w}-online", f"my{w}"]
    for i, w in enumerate(ORDINARY):
        good += [w, f"{w}-{ORDINARY[(i + 7) % len(ORDINARY)]}", f"the{w}", f"{w}-online", f"my{w}"]
    n = len(SYLLABLES)
    good += [SYLLABLES[i % n] + SYLLABLES[(i * 7 + i // n) % n] + SYLLABLES[(i * 3 + 1) % n] for i in range(6 * n)]
    out = []
    for label, names in ((1, bad), (0, good)):
        for i, name in enumerate(names):
            out.append((STARTS[i % 4] + name + ENDS[i // 4 % 4], PATHS[i // 2 % len(PATHS)], label))
    return out


def in_test_part(host: str) -> bool:
    """One URL in four of the table is left out of a fit that is to be tested."""
    return zlib.crc32(host.encode()) % 4 == 0


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to / ? # or end, A-Z lower-cased; then up to ? # or end. NULL or
    no ``://``: both empty."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(has, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, action) of the longest fitting rule, else NULL."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, h, p in sorted(RULES, key=lambda r: (len(r[1]) + len(r[2]), r[1])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p).otherwise(rule)
        action = F.when(fits, act).otherwise(action)
    return rule, action


def buckets(host: Column, path: Column) -> Column:
    """Hash buckets of the distinct character n-grams; ``^`` and ``$`` mark the ends of the host."""
    text = F.concat(F.lit("^"), host, F.lit("$"), path)

    def grams(t: Column) -> Column:
        each = [F.when(F.length(t) >= n, F.transform(
            F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(t) - (n - 1))), lambda i: F.substr(t, i, F.lit(n))))
            .otherwise(F.array().cast("array<string>")) for n in SIZES]
        return F.array_distinct(F.transform(F.concat(*each),
                                            lambda g: F.pmod(F.xxhash64(g), F.lit(BITS)).cast("int")))

    return bind(text, grams)


def train(spark: SparkSession, rows: list[tuple[str, str, int]] | None = None) -> tuple[list[float], float]:
    """(weight of each bucket, intercept) of the logistic regression; label 1: leave out. Without ``rows`` the whole
    table is learned."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    table = spark.createDataFrame([(h, p, float(y)) for h, p, y in rows or labelled_urls()],
                                  "host string, path string, label double")
    grams = table.select("label", buckets(F.col("host"), F.col("path")).alias("grams")).collect()  # the fixed table
    frame = spark.createDataFrame([(r["label"], Vectors.sparse(BITS, {g: 1.0 for g in r["grams"]})) for r in grams],
                                  ["label", "features"]).coalesce(1)
    model = LogisticRegression(regParam=0.002, maxIter=60, standardization=False).fit(frame)
    return [float(x) for x in model.coefficients.toArray()], float(model.intercept)


def block_probability(host: Column, path: Column, weights: list[float], intercept: float) -> Column:
    table = F.from_json(F.lit(json.dumps(weights)), "array<double>")  # folded to one literal
    total = F.aggregate(buckets(host, path), F.lit(intercept), lambda acc, b: acc + F.get(table, b))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def op6_url_filter(pages: DataFrame) -> DataFrame:
    """Contract rows page_id, host, path, rule, verdict, plus block_score of the regression.

    NULL and malformed URLs have an empty host and path and are judged by the regression like others. Repeated rows
    are judged each; other columns are ignored; an empty table gives an empty result."""
    weights, intercept = train(pages.sparkSession)
    host, path = parts(F.col("url"))
    cut = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, action = rule_of(F.col("host"), F.col("path"))
    score = block_probability(F.col("host"), F.col("path"), weights, intercept)
    return cut.select("page_id", "host", "path", rule.alias("rule"), action.alias("action"),
                      F.round(score, 6).alias("block_score")).select(
        "page_id", "host", "path", "rule", F.coalesce(
            "action", F.when(F.col("block_score") >= CUT, "block").otherwise("allow")).alias("verdict"),
        "block_score")
