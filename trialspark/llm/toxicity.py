"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import cut_lineage, mix64, slices

BITS = 20
#: ASCII characters that end a word: all but letters, digits and the apostrophe.
_BREAKS = bytes(c if c > 127 or chr(c).isalnum() or c == 0x27 else 32 for c in range(256))
_PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def features(texts: list[str | None], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words, neighbouring pairs and pairs with one word between, and the text each stands in."""
    words = [(t or "").lower().encode("utf-8", "surrogatepass").translate(_BREAKS).split() for t in texts]
    count = [len(w) for w in words]
    row = np.repeat(np.arange(len(texts)), count)
    one = np.fromiter((h for w in words for h in map(xxhash.xxh3_64_intdigest, w)), np.uint64, len(row))
    hashes, rows = [one], [row]
    for gap, factor in ((1, _PAIR), (2, _SKIP)):
        inside = row[:-gap] == row[gap:]
        hashes.append((one[:-gap] * factor + mix64(one[gap:]))[inside])
        rows.append(row[gap:][inside])
    return (mix64(np.concatenate(hashes)) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(rows)


class Ftrl:
    """Follow-the-regularised-leader, proximal: a learning rate and an L1 threshold per coordinate."""

    def __init__(self, size: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 8.0, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.bias_z, self.bias_n = 0.0, 0.0

    def _weight(self, z, n):
        held = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, held / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    @property
    def bias(self) -> float:
        return -self.bias_z / ((self.beta + np.sqrt(self.bias_n)) / self.alpha)

    def learn(self, at: np.ndarray, label: int) -> None:
        """One step on a text whose distinct features are ``at``."""
        z, n = self.z[at], self.n[at]
        w, bias = self._weight(z, n), self.bias
        g = 1 / (1 + np.exp(-min(35.0, max(-35.0, w.sum() + bias)))) - label
        self.z[at] = z + g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g
        self.bias_z += g - (np.sqrt(self.bias_n + g * g) - np.sqrt(self.bias_n)) / self.alpha * bias
        self.bias_n += g * g

    def weights(self) -> np.ndarray:
        return self._weight(self.z, self.n)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found, row = features(batch.column("text").to_pylist())
        once = np.unique(row << np.int64(BITS) | found)
        ends = np.searchsorted(once >> np.int64(BITS), np.arange(batch.num_rows + 1))
        values = (once & np.int64((1 << BITS) - 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("ord"), batch.column("toxic"), pa.array([values[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())], ["ord", "toxic", "found"]
        )


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = 12_000,
    sample_chars: int = 200_000,
    epochs: int = 5,
) -> tuple[np.ndarray, float]:
    """Weights and intercept from the labelled texts.

    A bounded sample is fitted on the driver: the ``sample_rows`` labelled ids of
    the smallest hashes, without texts above ``sample_chars`` (about 4 bytes a
    feature reach the driver). Rows with a null id or label don't count, an id
    labelled twice counts once, with its larger label. The order of the steps
    follows the hashes, so equal tables give equal weights. Without labels the
    weights are 0.
    """
    order = F.xxhash64(F.col("id").cast("string"), F.lit("order"))
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).dropna().groupBy("id").agg(F.max("toxic").alias("toxic"))
    chosen = marked.select("id", "toxic", order.alias("ord")).orderBy("ord", "id").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(cut_lineage(chosen)), "id")
    texts = texts.filter(F.coalesce(F.length("text"), F.lit(0)) <= sample_chars)
    sample = cut_lineage(texts.select("ord", "toxic", "text").mapInArrow(_sets, "ord long, toxic int, found binary"))
    taken = sample.sort("ord", "found").limit(2 * sample_rows).toArrow()
    found = [np.frombuffer(x.as_py(), np.int32) for x in taken.column("found")]
    toxic = taken.column("toxic").to_pylist()
    model = Ftrl(1 << BITS)
    for _ in range(epochs):
        for at, label in zip(found, toxic):
            model.learn(at, label)
    return model.weights(), model.bias


def score(docs: DataFrame, weights: np.ndarray, bias: float, text_col: str = "text", name: str = "score") -> DataFrame:
    """Adds the chance of label 1 to every row; only the non-zero weights are sent out, at most ``2 ** BITS``."""
    kept = np.flatnonzero(weights)
    model = docs.sparkSession.sparkContext.broadcast((kept, weights[kept], bias))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, b = model.value
        dense = np.zeros(1 << BITS)
        dense[at] = values
        for batch in slices(batches, text_col):
            found, row = features(batch.column(text_col).to_pylist())
            heavy = dense[found] != 0
            once = np.unique(row[heavy] << np.int64(BITS) | found[heavy])
            total = np.bincount(once >> np.int64(BITS), dense[once & np.int64((1 << BITS) - 1)], minlength=batch.num_rows) + b
            result = pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))
            yield pa.RecordBatch.from_arrays([*batch.columns, result], [*batch.schema.names, name])

    return docs.mapInArrow(judge, docs.withColumn(name, F.lit(0.0)).schema)


def held_out(id_col: str):
    """A third of the ids, by the remainder of their CRC-32, is never learnt from."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "utf-8")) % 3 == 1, F.lit(False))


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    limit: float = 0.7,
    sample_rows: int = 12_000,
) -> DataFrame:
    """One row per row of ``docs``: ``id, held_out, score, predicted``.

    Null and empty texts are scored by the intercept alone. Repeated rows stay;
    empty documents give no rows; without labels every score is 0.5. A null id
    is not held out. Only id, text and label are read.
    """
    learn_from = labels.filter(~held_out(id_col))
    weights, bias = train(docs, learn_from, id_col, text_col, label_col, sample_rows)
    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    scored = score(rows, weights, bias)
    return scored.select("id", "held_out", "score", (F.col("score") >= limit).cast("int").alias("predicted"))
