"""URL filters: allow and block rules, and logistic regression on hashed character n-grams for the rest.

Native: DataFrame functions and Spark ML only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom.llm.tables import fresh, save

# The rules of the registered query (fixed values).
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)

# The small labelled URL table: hosts of each class, crossed with the paths of each class.
BLOCKED_HOSTS = (
    "spam-links.example.net", "linkspam.example.com", "m.bulk-spam.example.org", "seo-farm.example.net",
    "pills-online.example.net", "www.pharmacy-deals.example.com", "buy-meds-cheap.example.org", "viagra-shop.example.com",
    "online-casino.example.org", "www.royal-casino.example.com", "slots-bonus.example.org", "win-jackpot.example.com",
    "sport-bets.example.net", "m.bet-now.example.com", "poker-free.example.net", "betting-tips.example.org",
    "adult-cams.example.net", "xxx-videos.example.org", "porn-tube.example.com", "blog.hot-adult.example.com",
    "ad-tracker.example.net", "www.click-ads.example.org", "m.track-pixel.example.com", "pop-ads.example.net",
    "vegas-casino.example.net", "casino-games.example.com", "m.mycasino.example.org", "win-big.example.net",
    "cheap-watches.example.com", "diet-pills.example.org", "pills-discount.example.com", "cheapest-pills.example.net",
    "comment-spam.example.net", "www.spam-mail.example.com", "content-farm.example.org", "click-farm.example.com",
    "adult-dating.example.net", "www.adult-sex.example.org", "ads-network.example.com", "tracking-ads.example.org",
    "free-money.example.com", "get-rich-quick.example.net", "crack-keygen.example.org", "free-downloads.example.net",
)
ALLOWED_HOSTS = tuple(
    f"{front}{word}.example.{end}"
    for number, word in enumerate(
        "library news weather docs university museum garden recipes history science research travel maps bread kitchen river "
        "mountain school teacher music orchestra painting gallery village harbor forest animal doctor hospital engine "
        "bridge railway station letter language grammar dictionary atlas planet ocean island desert winter summer calendar "
        "journal article essay poetry novel theater cinema camera lens window furniture carpenter farmer market "
        "time year people day man thing woman life child world state family student group country problem hand part place case "
        "week company system program question work government number night point home water room mother area story fact month "
        "study book eye word business issue side kind head house service friend father power hour line member law city community "
        "name president team minute idea body information parent face others level office door health person art".split()
    )
    for front, end in ((("", "www.", "blog.", "m.")[number % 4], ("com", "net", "org")[number % 3]), ("", "com"))
)
PATHS = ("", "/", "/en/12", "/de/345.html", "/fr/7/", "/es/890", "/index.html", "/en/2024/05/article")
BLOCKED_PATHS = ("/casino/bonus", "/buy/cheap-pills", "/adult/xxx", "/free-bets/win", "/ads/track")
ALLOWED_PATHS = ("/about", "/archive/history", "/docs/manual", "/library/books", "/science/article")

HASHED_FEATURES, PENALTY = 1 << 14, 0.003
NGRAM_SIZES = (3, 4)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or where `://` is missing."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"^(?s).*?://", "")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule (host/path prefix) that fits the host or a parent domain; null if none does."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _ngrams(chars: Column, tag: str) -> Column:
    """Tagged n-grams of an array of characters; each n-gram costs its own length only."""

    def of_size(n: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(chars) - n, F.lit(0)))
        return F.transform(starts, lambda i: F.concat(F.lit(tag), *[F.coalesce(F.get(chars, i + k), F.lit("")) for k in range(n)]))

    return F.concat(*[of_size(n) for n in NGRAM_SIZES])


def _features(df: DataFrame, host: str, path: str, output: str) -> DataFrame:
    """Adds the hashed n-grams of host and path, each between two marks."""
    words, of_host, of_path = (fresh(df, n) for n in ("ngrams", "host_chars", "path_chars"))
    marked = {of_host: F.col(host), of_path: F.col(path)}
    # Characters are columns of their own step: inside a lambda the split would be made again for each n-gram.
    rows = df.withColumns({name: F.split(F.concat(F.lit("^"), text, F.lit("$")), "") for name, text in marked.items()})
    rows = rows.withColumn(words, F.concat(_ngrams(F.col(of_host), "h:"), _ngrams(F.col(of_path), "p:"))).drop(of_host, of_path)
    return HashingTF(inputCol=words, outputCol=output, numFeatures=HASHED_FEATURES, binary=True).transform(rows).drop(words)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table: (url, blocked 0.0 or 1.0), a few hundred rows."""

    parts = (
        (BLOCKED_HOSTS, PATHS, 1), (ALLOWED_HOSTS, PATHS, 0), (ALLOWED_HOSTS[:12:2], BLOCKED_PATHS, 1), (ALLOWED_HOSTS, ALLOWED_PATHS, 0)
    )
    rows = [F.lit(f"{label} https://{host}{path}") for hosts, paths, label in parts for host in hosts for path in paths]
    row = F.split(F.col("row"), " ")
    table = spark.range(1).select(F.explode(F.array(*rows)).alias("row"))
    return table.select(row[1].alias("url"), row[0].cast("double").alias("blocked"))


def train_url_model(labelled: DataFrame) -> LogisticRegressionModel:
    """Logistic regression with an L2 penalty, both classes of equal weight; the table must be small (url, blocked)."""
    host, path = url_parts(F.col("url"))
    parts = save(labelled.select(host.alias("host"), path.alias("path"), "blocked").coalesce(1))
    share = parts.agg(F.avg("blocked")).first()[0] or 0.0
    weight = F.when(F.col("blocked") == 1, 0.5 / max(share, 1e-6)).otherwise(0.5 / max(1 - share, 1e-6))
    parts = parts.withColumn("weight", weight)
    fit = LogisticRegression(labelCol="blocked", featuresCol="features", weightCol="weight", regParam=PENALTY, maxIter=30, standardization=False)
    return fit.fit(_features(parts, "host", "path", "features"))


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    labelled: DataFrame | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """One row per page: id, host, path, rule, score (probability of block) and verdict.

    A rule decides where one fits, the longest first; elsewhere the model does (block from 0.5).
    Null urls and those without `://` have an empty host and path and are judged by the model on
    those. Repeated rows are judged alike, an empty table gives an empty result, other columns are
    not read. Only row-wise expressions: no shuffle.
    """
    model = train_url_model(labelled if labelled is not None else labelled_urls(pages.sparkSession))
    host, path = url_parts(F.col(url_column))
    parts = pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path"))
    scored = model.transform(_features(parts, "host", "path", "features"))
    scored = scored.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    score = vector_to_array("probability")[1]
    by_rule = F.coalesce(*[F.when(F.col("rule") == r, F.lit(v)) for r, v in rules]) if rules else F.lit(None).cast("string")
    verdict = F.coalesce(by_rule, F.when(score >= 0.5, F.lit("block")).otherwise(F.lit("allow")))
    return scored.select("page_id", "host", "path", "rule", score.alias("score"), verdict.alias("verdict"))
