"""URL filters: rules by host and path, and gradient-boosted trees on lexical features where no rule fits.

The URLs that rules judge are the labels. Features: lengths, depth, digit ratio, entropy of the characters, numbers of
parameters and other marks, and statistics of the host's suffix and of the path's first segment (how often rules block
URLs of it, smoothed by all labels, and without the URL's own label). The trees are trained on a bounded sample of labelled URLs and applied to every URL.

Edge cases: a null URL or one without ``://`` has an empty host and path, fits no rule and is judged by its features.
Equal URLs get equal verdicts. With labels of one kind only, or none, there is nothing to learn: URLs without a rule
then get that label, or are allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutelake.llm.common import ascii_lower, stage, table


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: the rules in force
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)

#: labelled URLs to train on (a bounded sample, the same in each run)
SAMPLE_ROWS = 20_000
TREES, DEPTH, SEED = 20, 4, 7
#: URLs that a suffix's share leans on
LEAN = 20.0

FEATURES = ["n_url", "n_host", "n_path", "depth", "labels", "digit_ratio", "entropy", "n_params", "n_marks", "n_hyphens", "secure", "fragment", "suffix_share", "suffix_log_count", "segment_share", "segment_log_count"]


def url_parts(url: Column) -> dict[str, Column]:
    """host: after the first ``://`` up to ``/``, ``?``, ``#``, in lower case; path: from there to ``?`` or ``#``."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return {"host": ascii_lower(host), "path": F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^([^?#]*)", 1)}


def rule_of(rules: tuple[Rule, ...], host: Column, path: Column) -> dict[str, Column]:
    """rule and its verdict: the longest that fits the host or a domain above it, and starts the path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):  # the longest is asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return {"rule": rule, "rule_verdict": verdict}


def lexical(url: str, host: str, path: str) -> dict[str, Column]:
    whole, n = F.coalesce(F.col(url), F.lit("")), F.length(F.coalesce(F.col(url), F.lit("")))

    def counted(pattern: str, of: Column = whole) -> Column:
        return F.regexp_count(of, F.lit(pattern)).cast("double")

    def share(c: Column) -> Column:
        return (n - F.length(F.replace(whole, c))) / n

    entropy = F.aggregate(F.array_distinct(F.split(whole, "")), F.lit(0.0), lambda a, c: F.when((F.length(c) > 0) & (share(c) > 0), a - share(c) * F.log2(share(c))).otherwise(a))
    return {
        "n_url": n.cast("double"), "n_host": F.length(host).cast("double"), "n_path": F.length(path).cast("double"), "depth": counted("/[^/]+", F.col(path)), "labels": counted(r"[^.]+", F.col(host)),
        "digit_ratio": F.when(n > 0, counted("[0-9]") / n).otherwise(0.0), "entropy": entropy, "n_params": counted(r"[?&][^=&#]+="), "n_marks": counted(r"[^A-Za-z0-9/.:?&=#-]"), "n_hyphens": counted("-"),
        "secure": whole.startswith("https:").cast("double"), "fragment": whole.contains("#").cast("double"),
    }


def url_filter(spark: SparkSession, urls: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``urls`` (any columns, with url) with host, path, rule and verdict; columns of these four names are replaced."""
    urls, given = urls.withColumnsRenamed({c: f"kept {i}" for i, c in enumerate(urls.columns) if c != "url"}), urls.columns
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    names = {"host": "__host", "path": "__path", "rule": "__rule", "rule_verdict": "__said"}
    rows = urls.withColumns({names[k]: v for k, v in url_parts(F.col("url")).items()})
    rows = rows.withColumns({names[k]: v for k, v in rule_of(rules, F.col("__host"), F.col("__path")).items()})
    rows = rows.withColumns({"__suffix": F.substring_index("__host", ".", -2), "__segment": F.regexp_extract("__path", "^/([^/]*)", 1)})
    rows = stage(spark, rows.withColumns({f"__{k}": v for k, v in lexical("url", "__host", "__path").items()}), "urls")

    # suffix statistics: grouped over all labelled URLs
    blocked = (F.col("__said") == "block").cast("double")
    labelled = rows.where("__said IS NOT NULL")
    totals = labelled.agg(F.sum(blocked).alias("b"), F.count("*").alias("n")).first()
    n, b = float(totals["n"]), totals["b"] or 0.0
    if b in (0.0, n):
        return named(given, rows, names, F.lit("block" if n and b == n else "allow"))

    own, label = F.when(F.col("__said").isNotNull(), 1.0).otherwise(0.0), F.coalesce(blocked, F.lit(0.0))
    for key in ("suffix", "segment"):
        sums = labelled.groupBy(f"__{key}").agg(F.sum(blocked).alias("__b"), F.count("*").cast("double").alias("__n"))
        many = F.coalesce("__n", F.lit(0.0)) - own
        share = (F.coalesce("__b", F.lit(0.0)) - label + LEAN * b / n) / (many + LEAN)
        rows = rows.join(sums, f"__{key}", "left").withColumns({f"__{key}_share": share, f"__{key}_log_count": F.log1p(many)}).drop("__b", "__n")

    features = [f"__{x}" for x in FEATURES]
    sample = rows.where("__said IS NOT NULL").select(*features, blocked.alias("label"), F.xxhash64("url").alias("key"))
    sample = sample.orderBy("key", *features, "label").limit(sample_rows).drop("key")
    gather = VectorAssembler(inputCols=features, outputCol="__features")
    trees = GBTClassifier(featuresCol="__features", labelCol="label", predictionCol="__predicted", maxIter=TREES, maxDepth=DEPTH, seed=SEED)
    trees = trees.setRawPredictionCol("__raw").setProbabilityCol("__probability")
    model = trees.fit(gather.transform(stage(spark, sample, "sample")))
    return named(given, model.transform(gather.transform(rows)), names, F.when(F.col("__predicted") > 0.5, "block").otherwise("allow"))


def named(given: list[str], rows: DataFrame, names: dict[str, str], learned: Column) -> DataFrame:
    made = {"host": F.col("__host"), "path": F.col("__path"), "rule": F.col("__rule"), "verdict": F.coalesce("__said", learned)}
    return rows.select(*[F.col("url" if c == "url" else f"`kept {i}`").alias(c) for i, c in enumerate(given) if c not in made], *[v.alias(k) for k, v in made.items()])


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(spark, table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")
