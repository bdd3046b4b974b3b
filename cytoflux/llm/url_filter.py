"""URL filters: host-suffix and path-prefix expressions equi-joined with rules on a short hash prefix.

Every distinct (host, path) expands into each suffix of its host (at dots) times each prefix of its path (at
slashes), no deeper than the deepest rule. An expression joins the rules on the first 32 bits of its SHA-256;
the full digest and the rest of the rule's path are then confirmed, and the longest confirmed rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytoflux.llm.common import LOWER, UPPER, cut, fresh

#: Rules up to this many rows are broadcast; more are joined by a shuffle, salted.
BROADCAST_RULES = 200_000
SALTS = 16
RULES = T.StructType([T.StructField(c, T.StringType()) for c in ("host", "path", "verdict")])


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, RULES)


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lowered; empty for null or no `://`."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty for null or no `://`."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def _folder(path: Column) -> Column:
    """The path up to its last slash, included; empty without a slash."""
    return F.regexp_extract(path, r"(?s)\A(.*/)", 1)


def _digest(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), folder), 256)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", broadcast_rows: int = BROADCAST_RULES) -> DataFrame:
    """pages plus host, path, rule and verdict.

    Rules have host, path and verdict (allow or block). A rule fits its host and all subdomains of it where the
    url's path starts with the rule's path; the longest rule (host plus path) wins, block before allow among
    equals; where none fits, rule is null and the verdict is `default`. A null url, or one without `://`, has an
    empty host and path and gets `default`. Rules with a null or empty host fit nothing. Repeated rows each keep
    their own result; the columns host, path, rule and verdict replace ones of the same name in pages, any others
    stay. A url of any length is judged whole; it expands no deeper than the deepest rule. Empty pages give no rows.
    """
    rules = rules.where((F.col("host") != "") & F.col("verdict").isNotNull()).select(
        F.col("host").alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), F.col("verdict").alias("r_verdict")
    ).distinct()
    rules = rules.withColumn("full", _digest(F.col("r_host"), _folder(F.col("r_path")))).withColumn("short", _short(F.col("full")))
    bounds = rules.agg(F.count("*"), F.max(F.size(F.split("r_host", r"\."))), F.max(F.length(F.regexp_replace("r_path", "[^/]", "")))).first()
    n_rules, labels, slashes = bounds[0], bounds[1] or 0, bounds[2] or 0

    host, path, b_host, b_path, b_rule, b_verdict = fresh(pages, "host_of_url", "path_of_url", "b_host", "b_path", "b_rule", "b_verdict")
    pages = pages.withColumns({host: url_host(F.col(url)), path: url_path(F.col(url))})
    places = pages.select(F.col(host).alias("host"), F.col(path).alias("path")).where(F.col("host") != "").distinct()

    # The last k labels for k up to the deepest rule's; the path up to its j-th slash, from none on.
    parts, steps = F.split("host", r"\."), F.split("path", "/")
    places = places.withColumns({"parts": parts, "steps": steps})
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size("parts"), F.lit(max(labels, 1)))), lambda k: F.array_join(F.slice("parts", F.size("parts") - k + 1, k), "."))
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size("steps") - 1, F.lit(slashes))),
        lambda j: F.when(j == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice("steps", 1, j), "/"), F.lit("/"))),
    )
    asked = places.select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
    asked = asked.select("host", "path", "suffix", F.explode("prefixes").alias("folder"))
    asked = asked.select("host", "path", _digest(F.col("suffix"), F.col("folder")).alias("asked_full")).withColumn("asked_short", _short(F.col("asked_full")))

    if n_rules <= broadcast_rows:
        met = asked.join(F.broadcast(rules), F.col("asked_short") == F.col("short"))
    else:
        rules = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        asked = asked.withColumn("asked_salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int"))
        met = asked.join(rules, (F.col("asked_short") == F.col("short")) & (F.col("asked_salt") == F.col("salt")))
    met = met.where((F.col("asked_full") == F.col("full")) & F.startswith(F.col("path"), F.col("r_path")))
    best = met.groupBy("host", "path").agg(
        F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")), F.struct(F.length("r_host") + F.length("r_path"), F.col("r_verdict") == "block", "r_host")).alias("best")
    )
    # Written, so that the join has an exchange of its own on either side and the pages of one very frequent url can be split.
    best = cut(best.select(F.col("host").alias(b_host), F.col("path").alias(b_path), F.col("best.rule").alias(b_rule), F.col("best.verdict").alias(b_verdict)))
    out = pages.join(best, (F.col(host) == F.col(b_host)) & (F.col(path) == F.col(b_path)), "left")
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict", host.lower(), path.lower())]
    return out.select(*[F.col(f"`{c}`") for c in kept], F.col(host).alias("host"), F.col(path).alias("path"), F.col(b_rule).alias("rule"), F.coalesce(b_verdict, F.lit(default)).alias("verdict"))
