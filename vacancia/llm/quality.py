"""Quality classifier with hierarchical empirical Bayes.

A logistic model judges each document by the statistics of its text. Grouped aggregation over all
documents gives each host, and each path within it, the mean of these judgements; both are shrunk
toward what lies above (path to host, host to all) by as much as their variance between groups says,
so a site with few documents has hardly a voice. A document's posterior odds are its own evidence
times the odds of its path against those of all, its own share in the means left out.

Null text and text without words are rejected. Null hosts and paths are groups like any other. Rows
that repeat are judged each. Labels without key or quality are ignored, several for one key are
averaged; without labels of both classes every document with words is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import BATCH_ROWS, new_folder, small, stored

#: Labelled documents (those of smallest key hash) that the model is fitted on, at most.
SAMPLE = 20_000
#: Documents whose posterior is below this are rejected.
THRESHOLD = 0.5
RIDGE, STEPS, CLIP = 1.0, 30, 1e-6
FEATURES = 14

_KIND = np.zeros((8, 256))
for _b in range(256):
    _c = chr(_b)
    if _b >= 128:
        _KIND[0, _b] = 1
    elif _c.isupper():
        _KIND[1, _b] = 1
    elif _c.islower():
        _KIND[2, _b] = 1
    elif _c.isdigit():
        _KIND[3, _b] = 1
    elif _c in " \t\r\x0b\x0c":
        _KIND[4, _b] = 1
    elif _c == "\n":
        _KIND[5, _b] = 1
    elif _c in ".,;:'\"?-()":
        _KIND[6, _b] = 1
    else:
        _KIND[7, _b] = 1


def features(bodies: list[bytes]) -> np.ndarray:
    """Shares of byte classes, variety and length of words, and length, of each text."""
    out = np.zeros((len(bodies), FEATURES))
    for i, body in enumerate(bodies):
        words = body.split()
        if not words:
            continue
        share = _KIND @ np.bincount(np.frombuffer(body, np.uint8), minlength=256) / len(body)
        letters = share[:3].sum() or 1.0
        distinct = len(set(words))
        rare = distinct / len(words)
        out[i] = [1.0, *share, share[1] / letters, rare, rare * np.log(len(words)), len(body) / len(words) / 10, np.log(len(words))]
    return out


@dataclass(frozen=True)
class Model:
    """Weights over standardised features."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    constant: float | None = None

    def probabilities(self, bodies: list[bytes]) -> np.ndarray:
        x = features(bodies)
        worded = x[:, 0] > 0
        if self.constant is not None:
            return np.where(worded, self.constant, 0.0)
        z = ((x - self.centre) / self.scale) @ self.weights[1:] + self.weights[0]
        return np.where(worded, np.clip(1 / (1 + np.exp(-np.clip(z, -30, 30))), CLIP, 1 - CLIP), 0.0)


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Ridge logistic regression by Newton steps."""
    if not len(y) or y.min() > 0.5 or y.max() < 0.5:
        return Model(np.zeros(0), np.zeros(0), np.zeros(0), constant=1.0 - CLIP)
    centre, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1.0
    z = np.hstack([np.ones((len(x), 1)), (x - centre) / scale])
    w = np.zeros(z.shape[1])
    keep = np.full(z.shape[1], RIDGE)
    keep[0] = 1e-6
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - y) + keep * w
        bend = (z * (p * (1 - p))[:, None]).T @ z + np.diag(keep)
        move = np.linalg.solve(bend, slope)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return Model(centre, scale, w)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit on the labelled documents of smallest key hash, `SAMPLE` of them at most."""
    known = labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).dropna()
    known = known.groupBy("doc_id").agg(F.avg("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    known = small(stored(known, new_folder(docs.sparkSession, "labels")), 16)  # SAMPLE rows at most

    @F.pandas_udf("array<double>")
    def described(body: pd.Series) -> pd.Series:
        return pd.Series(list(features(body.tolist())))

    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), body.alias("body")).join(known, "doc_id")
    rows = docs.groupBy("doc_id").agg(F.first("y").alias("y"), F.min(described("body")).alias("x")).toPandas()
    rows = rows.sort_values("doc_id")
    return fit(np.array(rows["x"].tolist()).reshape(-1, FEATURES), (rows["y"].to_numpy(float) >= 0.5).astype(float))


def _sums(prefix: str) -> list[Column]:
    return [F.count(F.lit(1)).alias(f"{prefix}_n"), F.sum("p").alias(f"{prefix}_sum"), F.sum(F.col("p") * F.col("p")).alias(f"{prefix}_squares")]


def _credibility(groups: int, n: float, n2: float, weighted: float, within: float) -> float:
    """Documents that the level above is worth: variance within over variance between groups.

    `weighted` is the sum over groups of n times the squared distance of their mean from the mean
    above, `within` the sum of squares within groups.
    """
    inside = within / max(n - groups, 1)
    spread = n - n2 / n if n else 0.0
    between = (weighted - max(groups - 1, 0) * inside) / spread if spread > 0 else 0.0
    return min(max(inside, 1e-9) / between, 1e9) if between > 1e-12 else 1e9


def score(docs: DataFrame, model: Model, host: str = "source", path: str = "lang", text: str = "text") -> DataFrame:
    """(row, p, host_mean, path_mean, posterior) of every row, `row` holding all its columns."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    @F.pandas_udf("double")
    def judged(body: pd.Series) -> pd.Series:
        return pd.Series(model.probabilities(body.tolist()))

    own = judged(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    judgements = docs.select(F.col(host).alias("host"), F.col(path).alias("path"), own.alias("p"))
    paths = stored(judgements.groupBy("host", "path").agg(*_sums("path")), new_folder(spark, "site-sums"))
    hosts = paths.groupBy("host").agg(
        F.sum("path_n").alias("host_n"), F.sum("path_sum").alias("host_sum"), F.sum("path_squares").alias("host_squares")
    )
    hosts = stored(hosts, new_folder(spark, "host-sums"))
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_sum").alias("s")).first()
    mean = total.s / total.n if total.n else 0.5

    def level(table: DataFrame, name: str, above: Column) -> float:
        n, s = F.col(f"{name}_n"), F.col(f"{name}_sum")
        r = table.agg(
            F.count(F.lit(1)).alias("groups"), F.sum(n).cast("double").alias("n"), F.sum(n.cast("double") * n).alias("n2"),
            F.sum(n * F.pow(s / n - above, F.lit(2))).alias("weighted"), F.sum(F.col(f"{name}_squares") - s * s / n).alias("within"),
        ).first()
        return _credibility(r.groups, r.n or 0.0, r.n2 or 0.0, r.weighted or 0.0, r.within or 0.0)

    joined = paths.join(hosts.withColumnRenamed("host", "host_"), F.col("host").eqNullSafe(F.col("host_"))).drop("host_")
    sites = stored(joined.select("host", "path", "path_n", "path_sum", "path_squares", "host_n", "host_sum"), new_folder(spark, "sites"))
    host_worth = level(hosts, "host", F.lit(mean))
    path_worth = level(sites, "path", F.col("host_sum") / F.col("host_n"))

    sites = small(sites.select(F.col("host").alias("host_"), F.col("path").alias("path_"), "path_n", "path_sum", "host_n", "host_sum"), 128)
    rows = docs.select(F.struct("*").alias("row"), F.col(host).alias("host"), F.col(path).alias("path"), own.alias("p"))
    rows = rows.join(sites, F.col("host").eqNullSafe(F.col("host_")) & F.col("path").eqNullSafe(F.col("path_")), "left")
    host_mean = (F.lit(host_worth * mean) + F.col("host_sum") - F.col("p")) / (F.lit(host_worth) + F.col("host_n") - 1)
    path_mean = (F.lit(path_worth) * F.col("host_mean") + F.col("path_sum") - F.col("p")) / (F.lit(path_worth) + F.col("path_n") - 1)
    rows = rows.withColumn("host_mean", host_mean).withColumn("path_mean", path_mean)

    def odds(p: Column) -> Column:
        p = F.greatest(F.least(p, F.lit(1 - CLIP)), F.lit(CLIP))
        return F.log(p / (1 - p))

    logit = odds(F.col("p")) + odds(F.col("path_mean")) - odds(F.lit(mean))
    posterior = F.when(F.col("p") == 0, F.lit(0.0)).otherwise(1 / (1 + F.exp(-logit)))
    return rows.select("row", "p", "host_mean", "path_mean", posterior.alias("posterior"))


def keep_good(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `score` that are not rejected, with their own columns."""
    return scored.filter(F.col("posterior") >= threshold).select("row.*")
