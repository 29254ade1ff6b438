"""URL filter: rules first, then gradient-boosted trees on lexical features.

Features are built-in expressions of the URL; trees are fitted and applied by Spark's
own ML, so no row passes through Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.sources.scratch import written_out

#: Labelled URLs that a fit takes, chosen by a hash. The suffixes among them bound the
#: table of suffix statistics, which is broadcast.
MAX_LABELLED = 50_000

TREES = 20
DEPTH = 4
LEARNING_RATE = 0.2
SEED = 17

#: Labelled URLs by which a suffix's rate is drawn to the mean.
PRIOR_URLS = 20.0

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains and the start of a path, like ``example.com/en/``."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Empty where the URL is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, _UPPER, _UPPER.lower()), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``; else null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _entropy(text: Column) -> Column:
    """Bits a character."""
    size = F.greatest(F.length(text), F.lit(1))
    shares = F.transform(F.array_distinct(F.split(text, "")), lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size)
    return F.aggregate(
        F.filter(shares, lambda share: share > 0), F.lit(0.0), lambda sum_, share: sum_ - share * F.log2(share)
    )


def lexical_features(url: Column) -> dict[str, Column]:
    text = F.coalesce(url.cast("string"), F.lit(""))
    host, path = host_and_path(text)
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    size = F.greatest(F.length(text), F.lit(1))
    labels = F.split(host, r"\.")
    return {
        "url_length": F.length(text),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))),
        "labels": F.size(labels),
        "longest_label": F.array_max(F.transform(labels, F.length)),
        "digit_ratio": F.length(F.regexp_replace(text, "[^0-9]", "")) / size,
        "other_ratio": F.length(F.regexp_replace(text, "[A-Za-z0-9]", "")) / size,
        "hyphens": F.length(text) - F.length(F.replace(text, F.lit("-"), F.lit(""))),
        "entropy": F.coalesce(_entropy(text), F.lit(0.0)),
        "host_entropy": F.coalesce(_entropy(host), F.lit(0.0)),
        "parameters": F.when(F.length(query) > 0, F.size(F.split(query, "&"))).otherwise(0),
        "is_https": text.startswith("https://").cast("int"),
        "has_fragment": (F.instr(text, "#") > 0).cast("int"),
    }


def _suffix(url: Column) -> Column:
    return F.substring_index(host_and_path(url)[0], ".", -1)


@dataclass(frozen=True)
class UrlModel:
    """Fitted trees, and by suffix the smoothed share of blocked URLs."""

    trees: GBTClassificationModel | None
    suffixes: DataFrame | None
    prior: float


def _prepared(urls: DataFrame, suffixes: DataFrame, prior: float) -> tuple[DataFrame, list[str]]:
    features = lexical_features(F.col("url"))
    known = urls.select("*", *(c.cast("double").alias(f"f_{n}") for n, c in features.items()), _suffix(F.coalesce("url", F.lit(""))).alias("f_suffix"))
    joined = known.join(F.broadcast(suffixes), F.col("f_suffix") == F.col("suffix"), "left")
    filled = joined.withColumns(
        {"f_suffix_rate": F.coalesce("rate", F.lit(prior)), "f_suffix_urls": F.log1p(F.coalesce("urls", F.lit(0)))}
    ).drop("suffix", "rate", "urls", "f_suffix")
    return filled, [*(f"f_{n}" for n in features), "f_suffix_rate", "f_suffix_urls"]


def fit(labelled: DataFrame, max_labelled: int = MAX_LABELLED) -> UrlModel:
    """A model of ``labelled`` (``url``, ``blocked``: 0 or 1). Null labels are left out;
    with labels of one kind only, or none, the model blocks nothing."""
    sample = written_out(
        labelled.filter("blocked IS NOT NULL")
        .select("url", F.col("blocked").cast("double").alias("blocked"))
        .orderBy(F.xxhash64("url"), "url", "blocked")
        .limit(max_labelled)
    )
    known = sample.agg(F.avg("blocked").alias("prior"), F.countDistinct("blocked").alias("kinds")).first()
    if known["kinds"] < 2:
        return UrlModel(None, None, 0.0)
    prior = known["prior"]
    suffixes = (
        sample.groupBy(_suffix(F.coalesce("url", F.lit(""))).alias("suffix"))
        .agg(F.count(F.lit(1)).alias("urls"), F.sum("blocked").alias("blocked"))
        .select("suffix", "urls", ((F.col("blocked") + PRIOR_URLS * prior) / (F.col("urls") + PRIOR_URLS)).alias("rate"))
    )
    suffixes = written_out(suffixes)
    prepared, names = _prepared(sample, suffixes, prior)
    vectors = VectorAssembler(inputCols=names, outputCol="f_all").transform(prepared)
    trees = GBTClassifier(
        featuresCol="f_all", labelCol="blocked", maxIter=TREES, maxDepth=DEPTH, stepSize=LEARNING_RATE, seed=SEED
    ).fit(vectors)
    return UrlModel(trees, suffixes, prior)


def block_probability(urls: DataFrame, model: UrlModel) -> DataFrame:
    """``urls`` (with a column ``url``) and ``block_probability``."""
    if model.trees is None:
        return urls.withColumn("block_probability", F.lit(0.0))
    prepared, names = _prepared(urls, model.suffixes, model.prior)
    vectors = VectorAssembler(inputCols=names, outputCol="f_all").transform(prepared)
    scored = model.trees.setFeaturesCol("f_all").transform(vectors)
    return scored.select(*urls.columns, vector_to_array("probability")[1].alias("block_probability"))


def filter_urls(pages: DataFrame, labelled: DataFrame, rules: Sequence[Rule] = (), least_block: float = 0.5) -> DataFrame:
    """A verdict on the URL of every page: the longest fitting rule's, else the model's.

    Needs ``page_id`` and ``url``; other columns are ignored. Returns ``page_id``,
    ``url``, ``host``, ``path``, ``rule``, ``verdict``, ``block_probability``.

    Null URLs and those without ``://`` have an empty host and path, fit no rule and are
    judged by the model on an empty text. Long URLs are read whole, repeated rows are
    judged alike, a null page_id is kept. Rules of equal length cannot fit one URL
    unless they are the same. An empty table gives no rows.
    """
    model = fit(labelled)
    scored = block_probability(pages.select("page_id", "url"), model)
    host, path = host_and_path(F.coalesce("url", F.lit("")))
    by_model = F.when(F.col("block_probability") >= least_block, "block").otherwise("allow")
    return (
        scored.withColumn("host", host)
        .withColumn("path", path)
        .withColumn("by_rule", rule_of(F.col("host"), F.col("path"), rules))
        .select(
            "page_id",
            "url",
            "host",
            "path",
            F.col("by_rule.rule").alias("rule"),
            F.coalesce("by_rule.verdict", by_model).alias("verdict"),
            "block_probability",
        )
    )
