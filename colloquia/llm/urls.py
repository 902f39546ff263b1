"""URL filters (native): rules first, else logistic regression on hashed character n-grams.

The model is trained from a small labelled table by a fold inside one SQL expression (the
labelled table and the model have fixed sizes), and scoring is one narrow projection.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlModelParams:
    buckets: int = 2048
    gram: int = 4
    epochs: int = 10
    rate: float = 2.0
    max_labelled: int = 2000  # bound of the labelled table that training gathers
    threshold: float = 0.5


#: Rules as (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

#: Words of unwanted and of ordinary sites, and url shapes that both take in turn.
UNWANTED = (
    "spam", "spam-mail", "link-farm", "content-farm", "casino", "casino-online", "win-casino", "poker", "jackpot", "slots", "bets", "free-spins",
    "betting", "adult", "adult-chat", "adult-video", "xxx", "x-rated", "porn", "pills", "cheap-meds", "cheap-deals", "pharma-pills", "viagra",
    "replica", "ads", "ad-server", "ads-click", "tracker", "track-pixel", "click-track", "free-money", "free-prize", "payday-loan", "warez", "crack-keys",
)
ORDINARY = (
    "news", "library", "museum", "garden", "weather", "school", "college", "research", "journal", "history", "science", "music", "theatre", "times", "cooking", "recipes", "travel", "docs",
    "manual", "wiki", "forum", "review", "market", "city", "hospital", "bank", "radio", "sport", "football", "railway", "airport", "insurance", "kitchen", "furniture", "software", "cloud",
    "archive", "gazette", "herald", "council", "society", "institute", "academy", "press", "books", "maps", "photo", "film", "video", "chat", "mail", "online", "server", "click", "deals", "money", "loan", "farm", "free",
)
SHAPES = ("{w}.com/", "www.{w}.org/about/7.html", "blog.{w}.net/posts/2019/12", "m.{w}.co.uk/index.php", "{w}.info/en/item/300", "pages.site.com/{w}/45")
#: Names of letters by chance stand for sites of which nothing is known, which are ordinary. Shapes of each unwanted, ordinary and made-up word.
MADE_UP, SEED, TURNS = 150, 17, (6, 4, 2)


def made_up(count: int = MADE_UP, seed: int = SEED) -> list[str]:
    """Names of two to four syllables, each of one or two consonants and a vowel, of any letters."""
    rng = random.Random(seed)
    syllable = lambda: "".join(rng.choices("bcdfghjklmnpqrstvwxyz", k=rng.randint(1, 2))) + rng.choice("aeiouy")
    return ["".join(syllable() for _ in range(rng.randint(2, 4))) for _ in range(count)]


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty where the url is null or has no ``://``."""
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)


def grams(host: Column, path: Column, params: UrlModelParams) -> Column:
    """Bucket of each character n-gram of ``^host/path$``; host grams and path grams hash apart."""

    def of(text: Column, seed: int) -> Column:
        return let(text, lambda s: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(s) - params.gram + 1, F.lit(1))),
            lambda i: F.pmod(F.xxhash64(F.substr(s, i, F.lit(params.gram)), F.lit(seed)), F.lit(params.buckets)).cast("int"),
        ))

    # Digits are made alike: numbers tell pages apart, not sites.
    return F.array_distinct(F.concat(of(F.translate(F.concat(F.lit("^"), host, F.lit("$")), "0123456789", "0" * 10), 1), of(F.translate(path, "0123456789", "0" * 10), 2)))


def logit(weights: Column, features: Column) -> Column:
    """Weights end with the bias; features are divided by the root of their number."""
    total = F.aggregate(features, F.lit(0.0), lambda a, f: a + F.get(weights, f))
    return total / F.sqrt(F.greatest(F.size(features), F.lit(1)).cast("double")) + F.element_at(weights, -1)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table (url, bad)."""
    rows = []
    for bad, words, turns in zip((1.0, 0.0, 0.0), (UNWANTED, ORDINARY, made_up()), TURNS, strict=True):
        rows += [(f"https://{SHAPES[(i + t) % len(SHAPES)].format(w=w)}", bad) for i, w in enumerate(words) for t in range(turns)]
    return spark.createDataFrame(rows, "url string, bad double")


def train(labelled: DataFrame, params: UrlModelParams = UrlModelParams()) -> list[float]:
    """Weights after stochastic gradient descent over the labelled table in an order fixed by hash.

    Raises where the table has more than ``max_labelled`` rows: it is gathered into one value.
    """
    host, path = url_parts(F.col("url"))
    rows = labelled.where(F.col("bad").isNotNull()).select(F.col("bad").cast("double").alias("y"), grams(host, path, params).alias("x"), F.xxhash64("url").alias("o"))
    one = rows.limit(params.max_labelled + 1).agg(F.array_sort(F.collect_list(F.struct("o", "y", "x"))).alias("rows"))
    zero = F.array_repeat(F.lit(0.0), params.buckets + 1)

    def epoch(w: Column, e: Column) -> Column:
        def step(w: Column, row: Column) -> Column:
            x = row["x"]
            error = row["y"] - F.lit(1.0) / (F.lit(1.0) + F.exp(-logit(w, x)))
            size = F.sqrt(F.greatest(F.size(x), F.lit(1)).cast("double"))
            rate = F.lit(params.rate) / (F.lit(1.0) + e.cast("double") * 0.2)
            return let(F.struct((error * rate / size).alias("g"), (error * rate * 0.1).alias("b")), lambda u: F.transform(
                w, lambda v, j: F.when(j == params.buckets, v + u["b"]).when(F.array_contains(x, j), v + u["g"]).otherwise(v)
            ))

        return F.aggregate("rows", w, step)

    fitted = one.select(F.size("rows").alias("n"), F.aggregate(F.sequence(F.lit(0), F.lit(params.epochs - 1)), zero, epoch).alias("w")).first()
    if fitted["n"] > params.max_labelled:
        raise ValueError(f"the labelled table has more than {params.max_labelled} rows")
    return fitted["w"]


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, nulls if none does."""
    name = verdict = None
    for kind, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return (name, verdict) if rules else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def judge_urls(pages: DataFrame, weights: list[float], rules=RULES, params: UrlModelParams = UrlModelParams(), url: str = "url", id_col: str = "page_id") -> DataFrame:
    """One row per input row: id, host, path, rule, bad (probability), verdict.

    Rules are a bounded parameter and become one CASE. A url without host takes the model's
    verdict like any other; repeated rows give repeated results; other columns are ignored.
    """
    host, path = url_parts(F.col(url))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    w = F.from_json(F.lit(repr([float(x) for x in weights])), "array<double>")
    bad = F.lit(1.0) / (F.lit(1.0) + F.exp(-let(grams(F.col("host"), F.col("path"), params), lambda x: logit(w, x))))
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    scored = parts.select("*", name.alias("rule"), bad.alias("bad"), verdict.alias("_v"))
    model = F.when(F.col("bad") >= params.threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", "bad", F.coalesce("_v", model).alias("verdict"))
