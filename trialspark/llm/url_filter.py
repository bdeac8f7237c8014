"""URL filter: host and path rules, and logistic regression on hashed character n-grams beyond them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import mix64, slices

ALLOW, BLOCK = "allow", "block"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest ``(verdict, host, path)`` rule that fits; null where none does.

    A rule fits its host and the subdomains of it when the path starts with the rule's path.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, at, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(prefix)
        name = F.when(fits, F.lit(at + prefix)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _grams(hosts: list[str], paths: list[str], sizes: Sequence[int], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of host and path, apart by a seed: feature and row of each, once per row."""
    found, rows = [], []
    for seed, texts in ((1, hosts), (2, paths)):
        marked = [f"^{t}$".encode("utf-8", "surrogatepass") for t in texts]
        flat = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
        length = np.array([len(t) for t in marked])
        row = np.repeat(np.arange(len(marked)), length)
        for n in sizes:
            if len(flat) < n:
                continue
            code = np.full(len(flat) - n + 1, seed * 64 + n, np.uint64)
            for k in range(n):
                code = code * np.uint64(1099511628211) + flat[k : len(flat) - n + 1 + k]
            inside = row[: len(code)] == row[n - 1 :]
            found.append((mix64(code[inside]) >> np.uint64(64 - bits)).astype(np.int64))
            rows.append(row[: len(code)][inside])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    once = np.unique(np.concatenate(rows) << np.int64(bits) | np.concatenate(found))
    return once & np.int64((1 << bits) - 1), once >> np.int64(bits)


def fit(hosts: list[str], paths: list[str], blocked: np.ndarray, sizes: Sequence[int], bits: int, rounds: int = 200, l2: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and intercept of the ridge-penalised logistic regression, by gradient steps with momentum.

    Rows count with the inverse share of their class. Without rows of both
    classes the weights are 0 and the intercept is the sign of the only class.
    """
    weights, bias = np.zeros(1 << bits), 0.0
    n = len(blocked)
    if not n or blocked.min() == blocked.max():
        return weights, (20.0 if n and blocked[0] else -20.0)
    feature, row = _grams(hosts, paths, sizes, bits)
    scale = 1 / np.sqrt(np.maximum(1, np.bincount(row, minlength=n)))
    value = scale[row]
    share = np.where(blocked == 1, 0.5 / blocked.mean(), 0.5 / (1 - blocked.mean()))
    speed, lean, step = np.zeros_like(weights), 0.0, 4.0
    for _ in range(rounds):
        score = np.bincount(row, weights[feature] * value, minlength=n) + bias
        wrong = (1 / (1 + np.exp(-score)) - blocked) * share / n
        slope = np.bincount(feature, wrong[row] * value, minlength=len(weights)) + l2 * weights / n
        speed = 0.9 * speed - step * slope
        lean = 0.9 * lean - step * wrong.sum()
        weights, bias = weights + speed, bias + lean
    return weights, float(bias)


def train(labelled: DataFrame, sizes: Sequence[int] = (3, 4, 5), bits: int = 16, sample_rows: int = 4096) -> tuple[np.ndarray, float]:
    """Fit on a small table ``host, path, blocked`` (0 or 1).

    At most ``sample_rows`` distinct urls are used, those of the smallest hashes,
    so the fit depends neither on the order nor on the partitions of the table.
    Rows with a null label don't count.
    """
    distinct = labelled.filter("blocked is not null").groupBy("host", "path").agg(F.max("blocked").alias("blocked"))
    order = F.xxhash64("host", "path")
    sample = distinct.orderBy(order, "host", "path").limit(sample_rows).collect()
    blocked = np.array([r["blocked"] for r in sample], np.float64)
    return fit([r["host"] for r in sample], [r["path"] for r in sample], blocked, sizes, bits)


def score(urls: DataFrame, weights: np.ndarray, bias: float, sizes: Sequence[int] = (3, 4, 5)) -> DataFrame:
    """Adds ``score``, the chance of block, to rows with ``host, path``; the weights have a fixed size."""
    bits = len(weights).bit_length() - 1
    model = urls.sparkSession.sparkContext.broadcast((weights.astype(np.float64), bias))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = model.value
        for batch in slices(batches, "path", 1 << 20):
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                feature, row = _grams(part.column("host").to_pylist(), part.column("path").to_pylist(), sizes, bits)
                n = part.num_rows
                scale = 1 / np.sqrt(np.maximum(1, np.bincount(row, minlength=n)))
                total = np.bincount(row, w[feature], minlength=n) * scale + b
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(1 / (1 + np.exp(-total)))], [*part.schema.names, "score"])

    return urls.mapInArrow(judge, urls.withColumn("score", F.lit(0.0)).schema)


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    least: float = 0.5,
    sample_rows: int = 4096,
) -> DataFrame:
    """One row per row of ``pages``: ``id, host, path, rule, score, verdict``.

    The urls that a rule decides are the labelled table the classifier learns
    from; it judges the others, blocking from score ``least`` on. Null urls and
    urls without ``://`` have an empty host and path and are judged as such.
    Repeated rows stay; an empty table gives no rows; other columns are not read.
    """
    host, path = host_and_path(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumns({"rule": rule, "by_rule": verdict})
    labelled = ruled.filter("rule is not null").select("host", "path", (F.col("by_rule") == BLOCK).cast("int").alias("blocked"))
    weights, bias = train(labelled, sample_rows=sample_rows)
    scored = score(ruled, weights, bias)
    judged = F.when(F.col("score") >= least, BLOCK).otherwise(ALLOW)
    return scored.select("id", "host", "path", "rule", "score", F.coalesce("by_rule", judged).alias("verdict"))
