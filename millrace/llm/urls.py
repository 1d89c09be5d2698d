"""URL filter: rules by host and path, and a logistic regression on character n-grams.

Judging is done in DataFrame functions alone. Only the fit, over a bounded table of
labelled URLs, runs in the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 4
FEATURES = 4096
# Labelled URLs the fit takes at most; those with the smallest hashes are taken.
FIT_ROWS = 4000
STEPS = 120

# Fixed rules of the query: verdict, then host and path.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """Add ``host`` (A-Z lowered) and ``path``; both empty if ``url`` is null or has no ``://``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return pages.withColumns({"host": F.translate(host, upper, upper.lower()), "path": path})


def rule_of(rules=RULES):
    """The longest rule that fits ``host`` or a domain above it and starts ``path``, else null."""
    fits = []
    for _, rule in sorted(rules, key=lambda r: -len(r[1])):
        domain, _, rest = rule.partition("/")
        host, path = F.col("host"), F.col("path")
        below = (host == domain) | host.endswith("." + domain)
        fits.append(F.when(below & path.startswith("/" + rest), F.lit(rule)))
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def grams(gram=GRAM, features=FEATURES):
    """Numbers of the hashed n-grams of host and path; a shorter text is one gram."""
    def of(part):
        starts = F.sequence(F.lit(1), F.greatest(F.length(part) - gram + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.pmod(
            F.xxhash64(F.lit(part), F.substr(F.col(part), i, F.lit(gram))), F.lit(features)
        ).cast("int"))

    return F.concat(of("host"), of("path"))


def fit(labelled: DataFrame, rows=FIT_ROWS, features=FEATURES, steps=STEPS):
    """Weights of a logistic regression for ``label`` (1: block) of ``host`` and ``path``.

    At most ``rows`` distinct URLs are taken. No rows at all: zeros, which blocks nothing.
    The last weight is the intercept.
    """
    sample = (
        labelled.select("host", "path", "label").distinct()
        .orderBy(F.xxhash64("host", "path"), "host", "path").limit(rows)
        .select(grams(features=features).alias("grams"), "label").collect()
    )
    x = np.zeros((len(sample), features + 1))
    y = np.array([row["label"] for row in sample], float)
    for i, row in enumerate(sample):
        np.add.at(x[i], row["grams"], 1 / np.sqrt(len(row["grams"])))
        x[i, -1] = 1
    weights = np.zeros(features + 1)
    for _ in range(steps if len(sample) else 0):
        miss = 1 / (1 + np.exp(-x @ weights)) - y
        weights -= 4.0 * (x.T @ miss / len(y) + 1e-4 * weights)
    return weights


def block_probability(weights):
    """The model's probability that the URL of ``host`` and ``path`` is to be blocked."""
    table = F.split(F.lit(",".join(map(repr, map(float, weights[:-1])))), ",").cast("array<double>")
    found = grams(features=len(weights) - 1)
    total = F.aggregate(found, F.lit(0.0), lambda sum_, g: sum_ + F.get(table, g))
    score = total / F.sqrt(F.size(found)) + F.lit(float(weights[-1]))
    return 1 / (1 + F.exp(-score))


def judge_urls(pages: DataFrame, labelled: DataFrame = None, rules=RULES) -> DataFrame:
    """Add ``host, path, rule, block_score, verdict`` to pages.

    The verdict is the longest fitting rule's, else the model's: block if its probability is
    over a half. ``labelled`` holds ``host, path, label``; by default the URLs that a rule
    judges are the labelled ones. Empty, null and broken URLs are judged like any other.
    """
    parsed = with_host_and_path(pages.drop("host", "path", "rule", "block_score", "verdict"))
    ruled = parsed.withColumn("rule", rule_of(rules))
    blocked = [rule for verdict, rule in rules if verdict == "block"]
    is_blocked = F.col("rule").isin(blocked) if blocked else F.lit(False)
    if labelled is None:
        labelled = ruled.where("rule is not null").select(
            "host", "path", is_blocked.cast("int").alias("label")
        )
    scored = ruled.withColumn("block_score", block_probability(fit(labelled)))
    blocks = F.when(F.col("rule").isNotNull(), is_blocked).otherwise(F.col("block_score") > 0.5)
    return scored.withColumn("verdict", F.when(blocks, "block").otherwise("allow"))
