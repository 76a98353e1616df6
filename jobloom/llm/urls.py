"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

All of it is DataFrame work: parsing and n-grams are built-in functions, hashing and regression are those of Spark's ML
library, and the labelled table that the model learns from is a DataFrame with ``url`` and ``label`` (1 to block).
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAMS = (3, 4, 5)
BUCKETS = 1 << 15
#: (allow or block, rule): a host with its subdomains, then a path that the url's path starts with.
RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
)
# Words of addresses that are to be blocked and of others, written down from general knowledge. No host of a table
# that is judged was looked at for them.
BLOCKED_WORDS = (
    "jackpot", "roulette", "poker", "blackjack", "slots", "baccarat", "lottery", "wager", "sportsbook", "bookmaker",
    "viagra", "cialis", "steroids", "pharmarx", "dietkeys", "payday", "quickloan", "getrich", "doubler", "replica",
    "knockoff", "porn", "xxx", "hentai", "camgirls", "escort", "nude", "clickbait", "adserver", "popunder",
    "banner", "doubleclick", "malware", "phishing", "warez", "crackz", "keygen", "torrentz", "giveaway", "prizewinner",
)
ALLOWED_WORDS = (
    "library", "university", "museum", "archive", "encyclopedia", "dictionary", "science", "physics", "biology", "history",
    "weather", "forecast", "newspaper", "journal", "magazine", "recipes", "kitchen", "gardening", "hiking", "railway",
    "timetable", "ministry", "council", "parliament", "hospital", "school", "courses", "lecture", "tutorial", "manual",
    "opensource", "compiler", "database", "bookshop", "publisher", "theatre", "orchestra", "gallery", "football", "chess",
)
ENDINGS = ("test", "example", "invalid")
#: Paths that say nothing; both kinds of addresses have them.
PATHS = ("", "/", "/index.html", "/a/{}", "/p?id={}", "/{}.html", "/{}/#top")


def parts(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path; both empty where the url is null or has no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, k), F.lit("")) for k in (1, 2))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def grams(text: Column, mark: str) -> Column:
    """Marked character n-grams of a text between two bounds; none of an empty text."""

    def of_size(signs: Column, n: int) -> Column:
        starts = F.slice(signs, F.lit(1), F.greatest(F.size(signs) - n + 1, F.lit(0)))
        return F.transform(starts, lambda x, i: F.concat(F.lit(mark), x, *[F.get(signs, i + k) for k in range(1, n)]))

    split = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
    # The array of one element makes the split a value that all sizes share.
    found = F.transform(F.array(split), lambda signs: F.concat(*[of_size(signs, n) for n in GRAMS]))[0]
    return F.when(text == "", F.array().cast("array<string>")).otherwise(found)


def _featured(rows: DataFrame) -> DataFrame:
    """``rows`` (host, path) with ``features``: the hashed n-grams that occur."""
    rows = rows.withColumn("grams", F.concat(grams(F.col("host"), "h"), grams(F.col("path"), "p")))
    return HashingTF(numFeatures=BUCKETS, binary=True, inputCol="grams", outputCol="features").transform(rows).drop("grams")


def labelled_urls() -> list[tuple[str, int]]:
    """Addresses by rule from the two lists of words: each word alone, and beside the next but two, in hosts and in paths."""
    rows = []
    for label, words in ((1, BLOCKED_WORDS), (0, ALLOWED_WORDS)):
        for k, word in enumerate(words):
            other, ending = words[(k + 3) % len(words)], ENDINGS[k % len(ENDINGS)]
            path = [p.format(k + 1) for p in (PATHS[k % len(PATHS)], PATHS[(k + 2) % len(PATHS)])]
            rows.append((f"https://www.{word}.{ending}{path[0]}", label))
            rows.append((f"http://{word}-{other}.{ending}{path[1]}", label))
            rows.append((f"https://site{k}.{ending}/{word}/{other}-{k}", label))
    return rows


def labelled(spark: SparkSession) -> DataFrame:
    """The small labelled table."""
    values = ", ".join(f"('{url}', {label})" for url, label in labelled_urls())
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(url, label)")


def train(table: DataFrame) -> LogisticRegressionModel:
    """Logistic regression on a labelled table; rows with a null in it are left out."""
    host, path = parts(F.col("url"))
    rows = table.dropna(subset=["url", "label"]).select(host.alias("host"), path.alias("path"), F.col("label").cast("double").alias("label"))
    return LogisticRegression(maxIter=60, regParam=0.01, tol=1e-6).fit(_featured(rows).coalesce(1))


def by_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls. A rule fits its host and all subdomains."""
    rule = verdict = F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the last that fits is the outermost condition
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def judge(
    pages: DataFrame, table: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str]] = RULES
) -> DataFrame:
    """``key``, host, path, rule, verdict and the model's ``score`` (probability to block) of every row.

    A null url, or one without ``://``, has an empty host and path, fits no rule, and is judged by the model on no n-gram
    at all, that is by its intercept. Repeated rows are judged each; other columns are not read, whatever their names; an empty
    table gives an empty result.
    """
    model = train(table)
    host, path = parts(F.col(url))
    rows = _featured(pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path")))
    scored = model.transform(rows)
    rule, verdict = by_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("prediction") == 1, "block").otherwise("allow")
    return scored.select(
        F.col("key").alias(key), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
        vector_to_array("probability")[1].alias("score"),
    )


def judge_pages(pages: DataFrame) -> DataFrame:
    """Result of the query: the verdict on every page's url."""
    return judge(pages.select("page_id", "url"), labelled(pages.sparkSession))
