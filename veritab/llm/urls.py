"""URL filter (DataFrame functions and Spark ML trees only).

A short rule table decides the hosts and paths it covers; every other URL is judged by gradient-boosted trees
on lexical features: lengths, depths, digit ratios, entropy, parameter counts and suffix statistics (smoothed
block rates of the host's last label and last two labels). The trees and the suffix statistics are fitted on
a bounded sample of labelled URLs (``sample_rows``, chosen by a hash of the URL); scoring covers every row.

Labels are best given by the caller. Without any, the rules' own verdicts are the labels, and then the suffix
statistics stay out: every such row lies under a rule's host, so the rates would only repeat the rule table
and pass a rule for one path of a host on to all of its other paths.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
FEATURES = ["url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "host_digit_ratio", "entropy", "parameters", "hyphens", "has_fragment", "is_https"]
SUFFIX_FEATURES = ["tld_rate", "domain_rate"]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest fitting rule; null where none fits. A rule fits its host and all
    subdomains when the path starts with the rule's path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """Add host, path, tld, domain and the lexical features of every URL (a null URL reads as empty)."""
    u = F.coalesce(F.col(url), F.lit(""))
    df = df.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url))).withColumn("__u", u)
    n, labels = F.length("__u"), F.split("host", r"\.")
    digits = lambda c: F.length(F.regexp_replace(c, "[^0-9]", ""))
    chars = F.array_distinct(F.split("__u", ""))
    share = lambda ch: (n - F.length(F.replace(F.col("__u"), ch, F.lit("")))) / n
    entropy = F.aggregate(chars, F.lit(0.0), lambda acc, ch: acc - F.when((ch != "") & (share(ch) > 0), share(ch) * F.log2(share(ch))).otherwise(F.lit(0.0)))
    return df.withColumns({
        "url_length": n.cast("double"),
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "host_depth": F.size(labels).cast("double"),
        "path_depth": (F.length("path") - F.length(F.replace(F.col("path"), F.lit("/"), F.lit("")))).cast("double"),
        "digit_ratio": _ratio(digits(F.col("__u")), n),
        "host_digit_ratio": _ratio(digits(F.col("host")), F.length("host")),
        "entropy": F.when(n > 0, entropy).otherwise(F.lit(0.0)),
        "parameters": F.size(F.array_remove(F.split(F.regexp_extract("__u", r"(?s)\?([^#]*)", 1), "[&;]"), "")).cast("double"),
        "hyphens": (F.length("__u") - F.length(F.replace(F.col("__u"), F.lit("-"), F.lit("")))).cast("double"),
        "has_fragment": F.contains(F.col("__u"), F.lit("#")).cast("double"),
        "is_https": F.startswith(F.col("__u"), F.lit("https://")).cast("double"),
        "tld": F.element_at(labels, -1),
        "domain": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."),
    }).drop("__u")


class UrlModel:
    """Fitted trees with the suffix statistics they were fitted on (``rates``: empty when they had none)."""

    def __init__(self, trees, rates: dict[str, DataFrame], prior: float):
        self.trees, self.rates, self.prior = trees, rates, prior

    def assemble(self, df: DataFrame) -> DataFrame:
        # suffix tables come from the bounded sample, so they have at most ``sample_rows`` rows each
        for name, table in self.rates.items():
            df = df.join(F.broadcast(table), name, "left").withColumn(f"{name}_rate", F.coalesce(f"{name}_rate", F.lit(self.prior)))
        return VectorAssembler(inputCols=FEATURES + (SUFFIX_FEATURES if self.rates else []), outputCol="__features").transform(df)

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``block_probability``; all rows get the prior when the labels had one class only."""
        if self.trees is None:
            return df.withColumn("block_probability", F.lit(self.prior))
        scored = self.trees.transform(self.assemble(df))
        return scored.withColumn("block_probability", vector_to_array("__probability")[1]).drop("__features", "__probability", "__raw", "__prediction", *SUFFIX_FEATURES)


def fit(labelled: DataFrame, sample_rows: int = 20_000, trees: int = 10, depth: int = 4, smoothing: float = 20.0, seed: int = 7, suffixes: bool = True) -> UrlModel:
    """Fit on rows of ``lexical`` with a column ``label`` (1 block, 0 allow); at most about ``sample_rows`` of them
    are used, the ones with the smallest URL hashes. ``suffixes``: whether the suffix statistics are features."""
    total = labelled.count()
    if total > sample_rows:
        labelled = labelled.where(F.pmod(F.xxhash64("host", "path", "url_length"), F.lit(1 << 20)) < int((1 << 20) * sample_rows / total))
    labelled = labelled.select("label", "tld", "domain", *FEATURES).persist()
    try:
        prior = labelled.agg(F.avg("label").alias("p")).first()["p"]
        if prior in (None, 0.0, 1.0):
            return UrlModel(None, {}, float(prior or 0.0))
        rate = lambda name: labelled.groupBy(name).agg(((F.sum("label") + smoothing * prior) / (F.count("*") + smoothing)).alias(f"{name}_rate"))
        spark = labelled.sparkSession
        tables = {name: spark.createDataFrame(rate(name).collect(), f"{name} string, {name}_rate double") for name in ("tld", "domain") if suffixes}  # at most sample_rows rows
        model = UrlModel(None, tables, float(prior))
        train = model.assemble(labelled).select(F.col("label").cast("double").alias("label"), "__features")
        gbt = GBTClassifier(featuresCol="__features", labelCol="label", predictionCol="__prediction", maxIter=trees, maxDepth=depth, maxBins=32, stepSize=0.3, seed=seed)
        model.trees = gbt.setProbabilityCol("__probability").setRawPredictionCol("__raw").fit(train)
        return model
    finally:
        labelled.unpersist()


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, url: str = "url", threshold: float = 0.5, labelled: DataFrame | None = None, **settings) -> DataFrame:
    """Add host, path, rule, verdict (allow or block) and block_probability to every row.

    ``labelled`` has URLs (column ``url``) with a ``label`` (1 block, 0 allow) that train the trees, which judge
    what no rule covers. Without it the rule table's own verdicts are the labels: URLs that a rule covers train
    the trees, without the suffix statistics. Null URLs and URLs without ``://`` have an empty host and path and are judged by the trees."""
    made = {"host", "path", "rule", "verdict", "block_probability"}
    if made & set(pages.columns):
        raise ValueError(f"columns {sorted(made & set(pages.columns))} are made by this operator")
    rows = lexical(pages, url)
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("__says", says)
    if labelled is None:
        model = fit(rows.where("__says IS NOT NULL").withColumn("label", (F.col("__says") == "block").cast("int")), **{**settings, "suffixes": False})
    else:
        model = fit(lexical(labelled.where("label IS NOT NULL").select(url, "label"), url), **settings)
    scored = model.score(rows)
    verdict = F.coalesce("__says", F.when(F.col("block_probability") >= threshold, F.lit("block")).otherwise(F.lit("allow")))
    return scored.withColumn("verdict", verdict).select(*pages.columns, "host", "path", "rule", "verdict", "block_probability")


def accuracy(scored: DataFrame, threshold: float = 0.5) -> float:
    """Share of labelled rows (``label``) that the trees alone judge right."""
    right = reduce(lambda a, b: a | b, [(F.col("label") == 1) & (F.col("block_probability") >= threshold), (F.col("label") == 0) & (F.col("block_probability") < threshold)])
    return scored.agg(F.avg(right.cast("double"))).first()[0]
