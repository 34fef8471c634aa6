"""URL filters: longest-match rules, then a logistic regression on hashed character n-grams.

Only DataFrame functions and the DataFrame-based machine-learning library are used.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAMS, BUCKETS = (3, 4, 5), 1 << 18
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words of unwanted and of ordinary hosts, from which the small labelled
#: table is built by a rule.
UNWANTED = ("casino", "poker", "bets", "betting", "slots", "jackpot", "lottery", "pills", "viagra",
            "pharmacy", "adult", "porn", "xxx", "sexcam", "dating", "spam", "ads", "adserver", "track",
            "tracker", "popup", "malware", "phishing", "warez", "torrent", "crack", "loan", "payday",
            "cheap", "replica", "hack", "bonus", "prize", "giveaway", "crypto-win", "click")
ORDINARY = ("news", "blog", "science", "university", "library", "recipes", "garden", "travel", "history",
            "music", "school", "docs", "wiki", "museum", "weather", "health", "sports", "books", "research",
            "theatre", "economy", "software", "nature", "gallery", "archive", "journal", "forum", "city",
            "council", "language", "teaching", "physics", "biology", "letters", "heritage", "transport",
            "northern", "thing", "nation", "other", "lantern", "anthem", "ether", "reading", "station",
            "mountain", "orient", "island", "winter", "river", "planet", "student", "shelter", "theory",
            "time", "people", "year", "work", "life", "world", "hand", "part", "child", "woman", "place",
            "week", "case", "point", "company", "number", "group", "problem", "fact", "other", "than",
            "then", "that", "with", "there", "where", "these", "those", "through", "thanks", "method",
            "months", "earth", "north", "south", "father", "mother", "together", "thread", "thrive", "author",
            "athens", "athlete", "cathedral", "northwest", "table", "handle", "blessing", "reason", "season",
            "person", "ocean", "stand", "street", "interest", "question", "action", "nature", "animal")
_HOSTS = ("{}.example.com", "www.{}.example.net", "blog.{}-site.example.org", "m.my-{}.example.com")
_PATHS = ("/en/12", "/de/3041/", "/fr/77.html", "/es/905")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or a url without ://."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """url, label (1 unwanted): every word in hosts and paths of the same forms."""
    rows = []
    for label, words in ((1.0, UNWANTED), (0.0, ORDINARY)):
        for k, word in enumerate(words):
            for j, host in enumerate(_HOSTS):
                rows.append((f"https://{host.format(word)}{_PATHS[(k + j) % 4]}", label))
            rows.append((f"http://site-{k}.example.org/{word}/{k}", label))
    return spark.createDataFrame(rows, "url string, label double")


def character_ngrams(host: Column, path: Column) -> Column:
    """All n-grams of the host, with its ends marked, and of the path, told apart."""
    def grams(tag: str, text: Column, n: int) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.char_length(text) - (n - 1)),
                            lambda i: F.concat(F.lit(tag), F.substring(text, i, F.lit(n))))
        return F.when(F.char_length(text) >= n, every).otherwise(F.array().cast("array<string>"))

    marked = F.concat(F.lit("^"), host, F.lit("$"))
    return F.concat(*[grams(tag, text, n) for tag, text in (("h", marked), ("p", path)) for n in GRAMS])


def _features(urls: DataFrame) -> DataFrame:
    grams = urls.withColumn("__grams", character_ngrams(F.col("host"), F.col("path")))
    return HashingTF(inputCol="__grams", outputCol="__features", numFeatures=BUCKETS,
                     binary=True).transform(grams).drop("__grams")


def fit(labelled: DataFrame) -> LogisticRegressionModel:
    """The model from a small labelled table (url, label); null urls are left out."""
    host, path = split_url(F.col("url"))
    rows = labelled.filter("url is not null and label is not null").select(
        host.alias("host"), path.alias("path"), F.col("label").cast("double").alias("label"))
    learner = LogisticRegression(featuresCol="__features", labelCol="label", regParam=0.01, maxIter=60,
                                 probabilityCol="__probability", rawPredictionCol="__raw",
                                 predictionCol="__label")
    return learner.fit(_features(rows))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule, rule_verdict of the distinct (host, path) that a rule fits.

    A rule (host, path, verdict) fits its host and all subdomains where the path starts
    with the rule's. The longest host and path wins, then the rule that sorts first.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    known = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"),
                         F.concat("host", "path").alias("rule"), F.col("verdict").alias("rule_verdict"))
    found = (urls.select("host", "path").distinct()
             .select("host", "path", F.explode(suffixes).alias("rule_host"))
             .join(known, "rule_host").filter(F.col("path").startswith(F.col("rule_path"))))
    best = F.min_by(F.struct("rule", "rule_verdict"), F.struct(-F.length("rule"), F.col("rule"), "rule_verdict"))
    return found.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.*")


def judge_urls(pages: DataFrame, rules: DataFrame, labelled: DataFrame, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every page.

    verdict is the rule's where one fits, else block where the model's probability
    (score) reaches the threshold, else allow. A null url has an empty host and path and
    is judged like any other; repeated rows are judged alike.
    """
    host, path = split_url(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    scored = fit(labelled).transform(_features(urls))
    scored = scored.withColumn("score", vector_to_array("__probability")[1])
    judged = scored.join(match_rules(urls, rules), ["host", "path"], "left")
    own = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule",
                         F.coalesce("rule_verdict", own).alias("verdict"), "score")
