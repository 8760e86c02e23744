"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

URLs that a rule decides are the labelled ones. From at most ``SAMPLE`` distinct ones of
each class, weighted to the class's share of all, Spark's gradient-boosted trees learn to judge by length, depth, digit ratio, entropy, parameter
counts and suffix statistics; no word of a URL is a feature. Suffix statistics are the
share of blocked URLs per hashed suffix over *all* labelled rows, a table of bounded
size.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no
rule and is judged by its other features. If all labelled rows are of one class, or there
are none, the trees are left out and that class, or ``allow``, is the verdict.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Columns, map_rows, materialize, only, table

# Fixed values: (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
# Distinct labelled URLs of each class that the trees learn from, taken by a hash of the URL.
SAMPLE = 20_000
TREES, DEPTH = 20, 4
BUCKETS = 1024
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame) -> DataFrame:
    """Add ``host`` and ``path``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.expr("substr(coalesce(url, ''), locate('://', coalesce(url, '')) + 3)"))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.translate(host, _UPPER, _LOWER), "path": path})


def with_rule(parts: DataFrame) -> DataFrame:
    """Add ``rule`` and ``ruled``: the longest rule that fits, and its verdict."""
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, verdict in sorted(RULES, key=lambda r: len(r[0] + r[1])):
        fits = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits = fits & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        ruled = F.when(fits, F.lit(verdict)).otherwise(ruled)
    return parts.withColumns({"rule": rule, "ruled": ruled})


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(k / n * math.log2(k / n) for k in Counter(text).values()) if n else 0.0


FEATURES = (
    "length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digits",
    "hyphens", "host_entropy", "path_entropy", "parameters", "parameter_length", "fragment",
    "secure", "last_segment", "longest_label",
)


def lexical(url: str | None, host: str, path: str) -> list[float]:
    """The features of one URL, in the order of ``FEATURES``."""
    url = url or ""
    query = url.partition("#")[0].partition("?")[2]
    digits = sum("0" <= c <= "9" for c in url)
    return [
        float(len(url)), float(len(host)), float(len(path)),
        float(len([s for s in path.split("/") if s])), float(len(host.split("."))),
        digits / max(1, len(url)), float(sum("0" <= c <= "9" for c in host)),
        float(host.count("-")), _entropy(host), _entropy(path),
        float(len([p for p in query.split("&") if p])), float(len(query)), float("#" in url),
        float(url.startswith("https")), float(len(path.rsplit("/", 1)[-1])),
        float(max(map(len, host.split(".")))),
    ]


def suffixes(host: str) -> tuple[str, str]:
    """The last label and the last two."""
    labels = host.split(".")
    return labels[-1], ".".join(labels[-2:])


def _bucket(suffix):
    return F.pmod(F.xxhash64(suffix), F.lit(BUCKETS)).cast("int")


def _suffix_columns(df: DataFrame) -> DataFrame:
    labels = F.split("host", r"\.")
    one = F.element_at(labels, -1)
    two = F.array_join(F.slice(F.reverse(labels), 1, 2), ".")
    return df.withColumns({"suffix1": _bucket(one), "suffix2": _bucket(two)})


def suffix_shares(labelled: DataFrame) -> dict[str, np.ndarray]:
    """Smoothed share of blocked URLs per bucket of each suffix length, over all labelled rows."""
    shares = {}
    for column in ("suffix1", "suffix2"):
        counts = (
            labelled.groupBy(column)
            .agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("ruled") == "block").cast("int")).alias("k"))
            .collect()  # BUCKETS rows at most
        )
        n, k = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for r in counts:
            n[r[column]], k[r[column]] = r["n"], r["k"]
        mean = k.sum() / max(1, n.sum())
        shares[column] = (k + 4 * mean) / (n + 4)
    return shares


def featured(df: DataFrame, shares: dict[str, np.ndarray]) -> DataFrame:
    """page_id, host, path, rule, ruled and ``features`` of every row."""
    kept = ("page_id", "host", "path", "rule", "ruled")

    def work(c: Columns) -> Columns:
        rows = [lexical(*r) for r in zip(c["url"], c["host"], c["path"], strict=True)]
        for row, a, b in zip(rows, c["suffix1"], c["suffix2"], strict=True):
            row += [float(shares["suffix1"][a]), float(shares["suffix2"][b])]
        return {k: c[k] for k in kept} | {"features": rows}

    return map_rows(
        df.select("url", "suffix1", "suffix2", *kept),
        "page_id long, host string, path string, rule string, ruled string, features array<double>",
        work,
    )


def learned_rows(labelled: DataFrame, shares: dict[str, np.ndarray]) -> tuple[DataFrame | None, float]:
    """label, weight and features of the sample, if there are both classes; else the one label."""
    known, _ = materialize(labelled.select("url", "ruled").distinct(), "url-labelled")
    counts = {r["ruled"]: r["count"] for r in known.groupBy("ruled").count().collect()}
    if len(counts) < 2:
        return None, float("block" in counts)
    taken, weight = None, F.lit(1.0)
    for verdict, n in sorted(counts.items()):
        own = F.col("ruled") == verdict
        part = known.where(own).orderBy(F.xxhash64("url"), "url").limit(SAMPLE)
        taken = part if taken is None else taken.union(part)
        weight = F.when(own, F.lit(n / min(n, SAMPLE))).otherwise(weight)
    parts = with_rule(with_parts(taken.select("url", F.lit(None).cast("long").alias("page_id"))))
    sample = featured(_suffix_columns(parts), shares).select(
        (F.col("ruled") == "block").cast("double").alias("label"), weight.alias("weight"),
        array_to_vector("features").alias("features"),
    )
    return materialize(sample, "url-sample")[0], 0.0


def filter_urls(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every page (``page_id``, ``url``)."""
    parts = _suffix_columns(with_rule(with_parts(only(pages, "page_id", "url"))))
    labelled = parts.where(F.col("ruled").isNotNull())
    shares = suffix_shares(labelled)
    rows, _ = materialize(featured(parts, shares), "url-features")
    sample, constant = learned_rows(labelled, shares)
    if sample is not None:
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=1, weightCol="weight")
        model = trees.fit(sample)
        judged = model.transform(rows.withColumn("features", array_to_vector("features")))
        judged = judged.withColumn("score", vector_to_array("probability")[1])
    else:
        judged = rows.withColumn("score", F.lit(constant))
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score"
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every page."""
    return filter_urls(table(spark, sf_dir, "pages"))
