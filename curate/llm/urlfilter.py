"""URL filter: host and path rules, and gradient-boosted trees on lexical features.

A rule decides the urls it fits (longest rule wins).  For the others a
gradient-boosted tree classifier decides from the url's text alone: lengths, depth, digit
ratio, entropy, parameter counts and how common its host and file suffixes are.  It is trained from
labelled urls, here those that rules decide.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curate.llm.textbytes import materialise

#: Labelled urls that the trees are fitted on (about; a hash of the url picks them).
LABELLED = 20_000
#: Host and file suffixes whose counts are broadcast (the most common ones, of at most so many
#: characters); the counts of all others are joined by a shuffle, with equal results.
SUFFIXES, SUFFIX_CHARS = 1_000, 256
SEED = 7
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rules of the query: host, path, verdict (fixed values).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

FEATURES = ("url_length", "host_length", "path_length", "depth", "labels", "hyphens", "digit_ratio", "entropy", "parameters", "fragment", "host_suffix", "file_suffix")


def url_host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def lexical(df: DataFrame) -> DataFrame:
    """``df`` (url, host, path) plus the lexical features; null urls count as empty."""
    url = F.coalesce(F.col("url"), F.lit(""))
    size = F.length(url)
    share = lambda c: (size - F.length(F.replace(url, c, F.lit("")))) / size
    chars = F.array_distinct(F.split(url, ""))
    entropy = F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return df.withColumns({
        "url_length": size.cast("double"), "host_length": F.length("host").cast("double"), "path_length": F.length("path").cast("double"),
        "depth": _count(F.col("path"), "/"), "labels": _count(F.col("host"), "[^.]+"), "hyphens": _count(F.col("host"), "-"),
        "digit_ratio": F.when(size > 0, _count(url, "[0-9]") / size).otherwise(0.0), "entropy": F.when(size > 0, entropy).otherwise(0.0),
        "parameters": _count(query, "[^&]+"), "fragment": url.contains("#").cast("double"),
        "_host_suffix": F.substring_index("host", ".", -1), "_file_suffix": F.regexp_extract("path", r"\.([A-Za-z0-9]{1,8})$", 1)})


def suffix_share(df: DataFrame, column: str, out: str) -> DataFrame:
    """``out``: log share of the rows with the row's suffix, over all rows, for every suffix (null: 0).

    The commonest suffixes, the only hot ones, are broadcast.  Rows of others meet their count by a
    shuffle; rows already served are spread over it by a hash, so that they don't meet in one task.
    """
    counts = materialise(df.groupBy(column).agg(F.count("*").alias("_n")), "suffixes")
    total = counts.agg(F.sum("_n")).first()[0] or 1
    known = counts.select(F.col(column).alias("_suffix"), F.log1p(F.col("_n") * F.lit(1e6 / total)).alias("_share"), "_n")
    short = F.length("_suffix") <= SUFFIX_CHARS
    top = known.filter(short).orderBy(F.desc("_n"), "_suffix").limit(SUFFIXES).select("_suffix", "_share")
    served = df.join(F.broadcast(top), F.col(column) == F.col("_suffix"), "left").withColumnRenamed("_share", out).drop("_suffix")
    if counts.count() <= SUFFIXES and known.filter(~short).isEmpty():
        return served.withColumn(out, F.coalesce(out, F.lit(0.0)))
    rest = known.join(F.broadcast(top.select("_suffix")), "_suffix", "left_anti").select("_suffix", "_share", F.lit(0).cast("bigint").alias("_salt"))
    spread = F.when(F.col(out).isNull(), F.lit(0)).otherwise(F.xxhash64("url").bitwiseOR(F.lit(1).cast("bigint"))).cast("bigint")
    return (served.withColumn("_spread", spread).join(rest, (F.col(column) == F.col("_suffix")) & (F.col("_spread") == F.col("_salt")), "left")
            .withColumn(out, F.coalesce(out, "_share", F.lit(0.0))).drop("_suffix", "_share", "_salt", "_spread"))


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, score (of block).

    A null url or one without :// has an empty host and path, fits no rule and is judged by its
    features.  Without labelled urls the method allows, with labels of one kind it gives that kind.
    Repeated rows and ids, null ones too, are judged each on its own.  Further columns are not read.
    """
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    urls = urls.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    data = lexical(urls.withColumns({"rule": rule, "_ruled": verdict}))
    data = suffix_share(suffix_share(data, "_host_suffix", "host_suffix"), "_file_suffix", "file_suffix")
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(data)
    labelled = data.filter("_ruled is not null").select((F.col("_ruled") == "block").cast("double").alias("label"), "features", F.xxhash64("url").alias("_h"))
    kinds = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}
    if len(kinds) == 2:
        share = min(1.0, LABELLED / sum(kinds.values()))
        sample = labelled.filter(F.pmod("_h", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
        model = GBTClassifier(featuresCol="features", labelCol="label", maxIter=12, maxDepth=4, maxBins=32, stepSize=0.2, seed=SEED).fit(sample.select("label", "features"))
        data = model.transform(data).withColumn("score", vector_to_array("probability")[1])
    else:
        data = data.withColumn("score", F.lit(max(kinds, default=0.0)))
    return data.select("page_id", "host", "path", "rule", F.coalesce("_ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {"op3_url_filter": op3_url_filter}
ORACLE: dict[str, str] = {}
