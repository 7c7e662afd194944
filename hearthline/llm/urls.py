"""URL filters: a rule table first, then logistic regression on hashed character n-grams of host and path.

The regression is trained from a small table of labelled URLs: at most ``TRAINING_ROWS`` of those given, picked by the
hash of the URL, in full-batch steps on the driver, so that reruns agree. A rule fits its host and all subdomains if
the path starts with the rule's; of several the longest stands (then the one that sorts first).

Edge cases: a null URL or one without ``://`` has an empty host and path and is judged by the regression (its bias
alone); without labels of both kinds the regression allows; rows that repeat an id are judged each, very long URLs whole; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.textbytes import U64, mix

#: (host, path, blocks)
Rules = tuple[tuple[str, str, bool], ...]
TRAINING_ROWS = 5000
BUCKETS = 1 << 15
SIZES = (2, 3, 4, 5)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Rules) -> Column:
    """The name (host and path) of the longest rule that fits; null if none."""
    out = F.lit(None).cast("string")
    for h, p, _ in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        # from the shortest on, so that the longest is asked first
        out = F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.lit(h + p)).otherwise(out)
    return out


def features(hosts: pa.Array, paths: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of all character n-grams of `` host `` and of `` path ``, the two told apart."""
    rows, buckets = [], []
    for kind, column in enumerate((hosts, paths)):
        texts = column.to_pylist()
        text = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le"), "<u4").astype(U64)
        at = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
        for size in SIZES:
            if len(text) < size:
                continue
            key = np.full(len(text) - size + 1, 10 * size + kind, U64)
            for j in range(size):
                key = key * U64(0x9E3779B97F4A7C15) + text[j : len(text) - size + 1 + j]
            inside = at[: len(key)] == at[size - 1 :]
            rows.append(at[: len(key)][inside])
            buckets.append((mix(key[inside]) & U64(BUCKETS - 1)).astype(np.int64))
    return (np.concatenate(rows), np.concatenate(buckets)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _shares(row: np.ndarray, n: int) -> np.ndarray:
    """Each row's n-grams weigh 1 over the root of their number."""
    return 1 / np.sqrt(np.bincount(row, minlength=n).clip(1))[row]


def train(labelled: DataFrame, rows: int = TRAINING_ROWS, steps: int = 200, rate: float = 2.0, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """From (host, path, blocks): weights and bias."""
    pick = F.xxhash64("host", "path")
    got = labelled.where("blocks is not null").select("host", "path", F.col("blocks").cast("boolean").alias("blocks")).orderBy(pick, "host", "path", "blocks").limit(rows).toArrow()
    y = np.array(got["blocks"].to_pylist(), float)
    weights = np.zeros(BUCKETS)
    if not len(y) or y.min() == y.max():
        return weights, (4.0 if len(y) and y.min() == 1 else -4.0)
    row, bucket = features(got["host"].combine_chunks(), got["path"].combine_chunks())
    share, bias = _shares(row, len(y)), 0.0
    for step in range(steps):
        p = 1 / (1 + np.exp(-(np.bincount(row, weights[bucket] * share, len(y)) + bias)))
        slope = (p - y) / len(y)
        now = rate * 10 / (1 + step / 50)
        weights -= now * (np.bincount(bucket, slope[row] * share, BUCKETS) + decay * weights)
        bias -= now * slope.sum()
    return weights, bias


def judge_urls(pages: DataFrame, rules: Rules, labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, block_score (of the regression). Without a labelled table, the
    URLs that a rule fits are the labelled ones."""
    d = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    d = d.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    blocking = [h + p for h, p, blocks in rules if blocks]
    by_rule = F.col("rule").isin(blocking)
    model = train(labelled if labelled is not None else d.where("rule is not null").select("host", "path", by_rule.alias("blocks")))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weights, bias = shared.value
        for batch in batches:
            row, bucket = features(batch.column(1), batch.column(2))
            score = np.bincount(row, weights[bucket] * _shares(row, batch.num_rows), batch.num_rows) + bias
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-score)))], ["id", "host", "path", "rule", "block_score"])

    kind = d.schema["id"].dataType.simpleString()
    judged = d.mapInArrow(run, f"id {kind}, host string, path string, rule string, block_score double")
    verdict = F.when(F.coalesce(by_rule, F.col("block_score") >= threshold), "block").otherwise("allow")
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "block_score")
