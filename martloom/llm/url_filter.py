"""URL filter: host rules, and gradient-boosted trees for the URLs that no rule decides.

A rule such as ``example.net/en/`` fits its host, all subdomains of it, and the paths that
start like its own; of several that fit, the longest decides. The URLs that a rule decides are
the labelled ones: the trees learn from lexical features of theirs (lengths, depth, digits,
entropy, parameters) and from how often URLs of the same suffix were blocked, over the last
label, the last two labels, and the last two with the first directory.

Everything on the main path is a built-in expression; suffix statistics are aggregated over all
labelled URLs, and the trees are fitted on a bounded sample of them (SAMPLE). Rules are a
parameter in the driver, and each is a condition of the plan: a list of some hundreds.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits no rule;
repeated rows are judged alike; if the labelled URLs are all of one kind, that kind is the
verdict for the others, and without any they are allowed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.scratch import materialize

RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}
SAMPLE = 20_000
TREES = 12
DEPTH = 4
SMOOTHING = 10.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SUFFIXES = ("label", "domain", "directory")
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio",
    "entropy", "parameters", "hyphens", "fragment",
    *[f"{s}_share" for s in _SUFFIXES], *[f"{s}_seen" for s in _SUFFIXES],
)


def parsed(urls: DataFrame) -> DataFrame:
    """``urls`` (page_id, url) with host and path."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce("url", F.lit(""))
    host = F.translate(F.regexp_extract(url, pattern, 1), _UPPER, _LOWER)
    return urls.select(
        "page_id", "url", host.alias("host"), F.regexp_extract(url, pattern, 2).alias("path")
    )


def _fits(rule: str) -> Column:
    host, slash, path = rule.partition("/")
    at_host = (F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))
    return at_host & F.startswith(F.col("path"), F.lit(slash + path))


def ruled(urls: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """With the longest rule that fits, null if none, and its verdict."""
    ordered = sorted(rules, key=lambda r: (-len(r), r))
    none = F.lit(None).cast("string")
    rule = F.coalesce(*[F.when(_fits(r), F.lit(r)) for r in ordered], none)
    verdict = F.coalesce(*[F.when(F.col("rule") == r, F.lit(rules[r])) for r in ordered], none)
    return urls.withColumn("rule", rule).withColumn("verdict", verdict)


def _count(text: Column, what: str) -> Column:
    return F.regexp_count(text, F.lit(what)).cast("double")


def _entropy(text: Column) -> Column:
    """Bits per sign."""
    size = F.length(text)
    signs = F.array_distinct(F.split(text, ""))
    own = F.transform(
        signs, lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size
    )
    bits = F.aggregate(own, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return F.when(size > 0, bits).otherwise(0.0)


def lexical(urls: DataFrame) -> DataFrame:
    """Lexical features, and the suffixes whose statistics are looked up."""
    url = F.coalesce("url", F.lit(""))
    host, path = F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    domain = F.substring_index(host, ".", -2)
    return urls.withColumns(
        {
            "url_length": F.length(url).cast("double"),
            "host_length": F.length(host).cast("double"),
            "path_length": F.length(path).cast("double"),
            "depth": _count(path, "/"),
            "labels": _count(host, r"\.") + 1,
            "digit_ratio": _count(url, "[0-9]") / F.greatest(F.length(url), F.lit(1)),
            "entropy": _entropy(url),
            "parameters": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1),
            "hyphens": _count(host, "-"),
            "fragment": F.contains(url, F.lit("#")).cast("double"),
            "label": F.substring_index(host, ".", -1),
            "domain": domain,
            "directory": F.concat(domain, F.lit("/"), F.element_at(F.split(F.concat(path, F.lit("//")), "/"), 2)),
        }
    )


def suffix_statistics(labelled: DataFrame) -> DataFrame:
    """(level, suffix, seen, blocked) over all labelled URLs."""
    pairs = F.array(*[F.struct(F.lit(s).alias("level"), F.col(s).alias("suffix")) for s in _SUFFIXES])
    rows = labelled.select(F.explode(pairs).alias("s"), (F.col("verdict") == "block").alias("b"))
    return rows.groupBy("s.level", "s.suffix").agg(
        F.count("*").alias("seen"), F.count_if("b").alias("blocked")
    )


def featured(urls: DataFrame, statistics: DataFrame, prior: float) -> DataFrame:
    """Each suffix' share of blocked URLs, drawn towards the next wider suffix' share."""
    wider = F.lit(prior)
    for level in _SUFFIXES:
        own = statistics.where(F.col("level") == level).select(
            F.col("suffix").alias(level), F.col("seen").alias("_seen"), F.col("blocked").alias("_blocked")
        )
        seen = F.coalesce("_seen", F.lit(0))
        share = (F.coalesce("_blocked", F.lit(0)) + SMOOTHING * wider) / (seen + SMOOTHING)
        urls = urls.join(own, level, "left").withColumns(
            {f"{level}_share": share, f"{level}_seen": F.log1p(seen)}
        )
        urls = urls.drop("_seen", "_blocked")
        wider = F.col(f"{level}_share")
    return urls


def _assembled(urls: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(urls)


def judged(pages: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score (null where a rule decides), a row per page."""
    urls = ruled(parsed(pages), rules)
    labelled = lexical(urls).where("rule IS NOT NULL")
    statistics = materialize(suffix_statistics(labelled), "suffixes")
    totals = statistics.where("level = 'label'").agg(F.sum("seen"), F.sum("blocked")).first()
    seen, blocked = totals[0] or 0, totals[1] or 0
    columns = ["page_id", "host", "path", "rule"]
    if blocked in (0, seen):
        only = "block" if seen and blocked == seen else "allow"
        verdict = F.coalesce("verdict", F.lit(only)).alias("verdict")
        return urls.select(*columns, verdict, F.lit(None).cast("double").alias("score"))
    prior = blocked / seen
    chosen = labelled.orderBy(F.xxhash64("url"), "url").limit(SAMPLE)
    sample = featured(chosen, statistics, prior).withColumn(
        "target", (F.col("verdict") == "block").cast("double")
    )
    sample = materialize(sample.select("target", *FEATURES), "url_sample")
    trees = GBTClassifier(
        labelCol="target", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, seed=7
    )
    model = trees.fit(_assembled(sample))
    scored = model.transform(_assembled(featured(lexical(urls), statistics, prior)))
    score = vector_to_array("probability")[1]
    free = F.col("rule").isNull()
    return scored.select(
        *columns,
        F.when(free, F.when(score >= 0.5, "block").otherwise("allow")).otherwise(F.col("verdict")).alias("verdict"),
        F.when(free, score).alias("score"),
    )
