"""URL filters: rules on host and path, and logistic regression for the rest (operator 8).

Host and path are cut out by column expressions. Where a rule fits, the longest
one decides. Other URLs are judged by logistic regression on hashed character
n-grams of the host and of the path (counted apart, square-rooted, scaled to unit
length), trained by stochastic gradient descent in numpy from a small labelled
table of URLs. ``labelled_by_rules`` makes such a table: at most ``rows_kept``
distinct URLs that a rule decides, drawn by hash.

Defined results: a null URL, or one without ``://``, has an empty host and path
and no rule; a URL without features gets the model's bias; without labelled rows
of both verdicts every such URL is allowed; equal URLs get equal verdicts; an
empty table gives an empty result. Extra columns of the input are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ngrams import hashed_ngrams

BITS, SIZES = 15, (2, 3, 4, 5)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case
    (A-Z only). Path: what follows, up to ``?``, ``#`` or the end."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits (struct of name and verdict), or null."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in reversed(ordered):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def block_probability(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        z = np.full(len(hosts), self.bias)
        counts = url_features(hosts, paths)
        z += np.bincount(counts[0], self.weights[counts[1]] * counts[2], len(hosts))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def url_features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (url, bucket, value) of unit length."""
    found = [np.zeros(0, dtype=np.int64)]
    for salt, strings in ((1, hosts), (2, paths)):
        for owner, bucket in hashed_ngrams(strings, SIZES, BITS, salt):
            found.append(owner.astype(np.int64) << BITS | bucket)
    keys, counts = np.unique(np.concatenate(found), return_counts=True)
    owner, value = keys >> BITS, np.sqrt(counts)
    length = np.sqrt(np.bincount(owner, value**2, len(hosts)))
    return owner, keys & ((1 << BITS) - 1), value / length[owner]


def fit(hosts: list[str], paths: list[str], blocked: list[int], epochs: int = 30, rate: float = 4.0, l2: float = 1e-5, seed: int = 11) -> Model:
    """Mini-batch gradient descent on the logistic loss, classes weighted equally."""
    y = np.array(blocked, dtype=np.float64)
    if len(set(blocked)) < 2:
        return Model(np.zeros(1 << BITS), -1.0)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    owner, bucket, value = url_features(hosts, paths)
    begin = np.searchsorted(owner, np.arange(len(y) + 1))
    model, rng = Model(np.zeros(1 << BITS), 0.0), np.random.default_rng(seed)
    for epoch in range(epochs):
        order, step = rng.permutation(len(y)), rate / (1 + epoch)
        for k in range(0, len(order), 32):
            batch = order[k : k + 32]
            rows = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in batch])
            local = np.repeat(np.arange(len(batch)), begin[batch + 1] - begin[batch])
            z = model.bias + np.bincount(local, model.weights[bucket[rows]] * value[rows], len(batch))
            error = weight[batch] * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[batch])
            np.subtract.at(model.weights, bucket[rows], step * error[local] * value[rows] / len(batch))
            model.bias -= step * 0.1 * error.mean()
        model.weights *= 1 - l2 * step
    return model


def labelled_by_rules(urls: DataFrame, rules: list[Rule], rows_kept: int = 4000, url_col: str = "url") -> DataFrame:
    """A small labelled table (host, path, blocked), half of each verdict at most."""
    host, path = host_and_path(F.col("url"))
    rows = urls.select(F.col(url_col).alias("url")).select(host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules)).where("rule IS NOT NULL")
    rows = rows.select("host", "path", (F.col("rule.verdict") == "block").cast("int").alias("blocked"))
    key = F.xxhash64(F.lit("urls"), "host", "path")
    sides = [rows.where(F.col("blocked") == b).orderBy(key, "host", "path").limit(rows_kept // 2) for b in (0, 1)]
    return reduce(DataFrame.unionAll, sides)


def train(labelled: DataFrame) -> Model:
    """``labelled``: host, path, blocked (0 or 1); a small table."""
    rows = sorted((r["host"] or "", r["path"] or "", r["blocked"]) for r in labelled.distinct().collect())
    return fit([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows])


def block_probability(host: Column, path: Column, model: Model) -> Column:
    @F.arrow_udf("double")
    def score(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for hosts, paths in batches:
            yield pa.array(model.block_probability(hosts.to_pylist(), paths.to_pylist()), pa.float64())

    return score(host, path)


def judge(pages: DataFrame, rules: list[Rule], model: Model, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, block_probability."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("r", fitting_rule(F.col("host"), F.col("path"), rules)).withColumn("p", block_probability(F.col("host"), F.col("path"), model))
    learned = F.when(F.col("p") >= 0.5, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", F.col("r.name").alias("rule"), F.coalesce("r.verdict", learned).alias("verdict"), F.col("p").alias("block_probability"))
