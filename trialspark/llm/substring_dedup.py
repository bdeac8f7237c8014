"""Substring duplicates: repeated runs of consecutive sentences, removed wherever they are not the first."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import cut_lineage, document_key, mix64, release, slices

#: What a sentence ends with, and the white space after it. A run of white space is gone through once.
_BREAK = re.compile(r"[.!?…]\s+|\n\s*")
_WORD = re.compile(r"\s*\S+\s*")
_BASE = 0x9E3779B97F4A7C15


def cuts(words: list[str], longest: int) -> list[int]:
    """Places that cut ``words`` into pieces of at most ``longest``, set by the words around them.

    A cut stands before a word whose hash with the next one is the smallest of
    four on either side, so that cuts fall into step again after an edit or
    another beginning; a piece that stays too long is cut at its smallest hash.
    """
    near = 4
    n = len(words)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, " ".join(words).encode("utf-8", "surrogatepass").split(b" ")), np.uint64, n)
    pair = one * np.uint64(_BASE)
    pair[:-1] += one[1:]
    pair = mix64(pair)
    least = pair.copy()
    for k in range(1, min(near, n - 1) + 1):
        np.minimum(least[k:], pair[:-k], out=least[k:])
        np.minimum(least[:-k], pair[k:], out=least[:-k])
    places = np.flatnonzero(pair == least).tolist()
    out, open_ = [], [(a, b) for a, b in zip([0, *places], [*places, n])]
    while open_:
        a, b = open_.pop()
        if b - a > longest:
            at = a + 1 + int(np.argmin(pair[a + 1 : b]))
            open_ += [(a, at), (at, b)]
        elif a:
            out.append(a)
    return sorted(set(out))


def split(text: str, longest: int = 24) -> tuple[list[int], list[int], list[int]]:
    """End, number of words and hash of every sentence; white space belongs to the sentence before it.

    A sentence ends at ``. ! ? …`` before white space and at a line break. One
    of more than ``longest`` words is cut at places that its words set (see cuts).
    Case and the kind of white space don't count in the hash.
    """
    ends, counts, hashes = [], [], []
    bounds = [m.end() for m in _BREAK.finditer(text)]
    if text and (not bounds or bounds[-1] < len(text)):
        bounds.append(len(text))
    low = text.lower()
    same = len(low) == len(text)  # no letter became two: places are the same in both
    digest = xxhash.xxh3_64_intdigest
    start = 0
    for end in bounds:
        words = (low[start:end] if same else text[start:end].lower()).split()
        if len(words) <= longest:
            ends.append(end)
            counts.append(len(words))
            hashes.append(digest(" ".join(words).encode("utf-8", "surrogatepass")))
        else:
            after = [start + m.end() for m in _WORD.finditer(text[start:end])]
            at = [0, *cuts(words, longest), len(words)]
            for i, j in zip(at, at[1:]):
                ends.append(after[j - 1])
                counts.append(j - i)
                hashes.append(digest(" ".join(words[i:j]).encode("utf-8", "surrogatepass")))
        start = end
    return ends, counts, hashes


def sentences(text: str, longest: int = 24) -> list[str]:
    """Sentences with the white space after them; joined they are the text again."""
    ends = split(text, longest)[0]
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def span_hashes(one: np.ndarray, count: np.ndarray, run: int, words: int, ends: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first and end sentence of every run: at least ``run`` sentences and ``words`` words, as few as possible.

    ``one`` and ``count`` are the hash and the number of words of each sentence.
    A run begins at every sentence; with ``ends`` one ends at every sentence too.
    Sentences without words are skipped.
    """
    full = np.flatnonzero(count)
    n = len(full)
    if n < run:
        return np.zeros(0, np.uint64), full[:0], full[:0]
    upto = np.r_[0, np.cumsum(count[full])]
    end = np.maximum(np.arange(n) + run, np.searchsorted(upto, upto[:-1] + words))
    start = np.flatnonzero(end <= n)
    end = end[start]
    if ends:
        last = np.arange(run, n + 1)
        begin = np.minimum(last - run, np.searchsorted(upto, upto[last] - words, "right") - 1)
        both = np.unique(np.r_[start * (n + 1) + end, (begin * (n + 1) + last)[begin >= 0]])
        start, end = both // (n + 1), both % (n + 1)
    # a polynomial in the place of each sentence, brought back to place 0
    power = np.cumprod(np.full(n + 1, _BASE, np.uint64))
    back = np.cumprod(np.full(n + 1, pow(_BASE, -1, 1 << 64), np.uint64))
    total = np.r_[np.uint64(0), np.cumsum(mix64(one[full]) * power[:n])]
    value = mix64((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64))
    return value, full[start], full[end - 1] + 1


def _split_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 1 << 20):
        found = [split(t or "") for t in batch.column("text").to_pylist()]
        packed = [pa.array([np.array(f[i], kind).tobytes() for f in found], pa.binary()) for i, kind in enumerate(("<i4", "<i4", "<u8"))]
        size = pa.array([len(f[0]) for f in found], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("doc"), size, *packed], ["id", "doc", "n", "ends", "counts", "hashes"])


def _spans(run: int, words: int, ends: bool):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "hashes", 1 << 18):
            pairs = zip(batch.column("hashes").to_pylist(), batch.column("counts").to_pylist())
            found = [span_hashes(np.frombuffer(h, "<u8"), np.frombuffer(c, "<i4"), run, words, ends) for h, c in pairs]
            row = pa.array(np.repeat(np.arange(batch.num_rows), [len(f[0]) for f in found]))
            span, first, end = (np.concatenate([f[i] for f in found]) for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(span.astype(np.int64)), batch.column("doc").take(row), batch.column("id").take(row), pa.array(first.astype(np.int32)), pa.array(end.astype(np.int32))],
                ["span", "doc", "id", "first", "end"],
            )

    return emit


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document with spans to drop: how many sentences go, and the places in its text where what goes begins and ends."""
    for batch in slices(batches, "ends", 1 << 18):
        removed, edges = [], []
        for ends, drop in zip(batch.column("ends").to_pylist(), batch.column("drop").to_pylist()):
            at = np.r_[0, np.frombuffer(ends, "<i4")]
            covered = np.zeros(len(at), np.int64)
            np.add.at(covered, [d["first"] for d in drop], 1)
            np.add.at(covered, [d["end"] for d in drop], -1)
            gone = np.r_[False, np.cumsum(covered)[:-1] > 0, False]
            removed.append(int(gone.sum()))
            edges.append(at[np.flatnonzero(gone[1:] != gone[:-1])].astype("<i4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(removed, pa.int32()), pa.array(edges, pa.binary())], ["doc", "n_removed", "edges"])


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 4 << 20):
        text, edges = batch.column("text"), batch.column("edges")
        cut = edges.is_valid()
        kept = []
        for t, e in zip(text.filter(cut).to_pylist(), edges.filter(cut).to_pylist()):
            at = [0, *np.frombuffer(e, "<i4").tolist(), len(t)]
            kept.append("".join(t[a:b] for a, b in zip(at[::2], at[1::2])))
        text = pc.replace_with_mask(text, cut, pa.array(kept, pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_sentences"), batch.column("n_removed"), text], ["id", "n_sentences", "n_removed", "text"])


def remove_repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = 2, words: int = 16, ends: bool = True
) -> DataFrame:
    """One row per row of ``docs``: ``id, n_sentences, n_removed, text`` without repeated spans.

    From every sentence on, the shortest run of at least ``run`` sentences and
    ``words`` words is hashed, and unless ``ends`` is false also the shortest that
    ends with every sentence. Both together cover what equal runs of any length do, the
    first kind alone can leave the last sentences of a passage. Of equal runs anywhere the first stays, by id
    (null last), then document, then place; sentences covered by any other are
    removed. A text without such runs is returned as it is: a null text stays
    null, one with nothing left is empty. Rows that repeat id and text are one
    document and get the same text. Empty tables give no rows; other columns are
    not read.

    Every text is split once; its sentences' ends, numbers of words and hashes
    are written, and the runs made from them. Runs are counted where they are
    read before the shuffle; the runs that occur twice or more are joined back,
    which leaves a frequent one to be split as a skewed key. What a document
    gathers is bounded by its own sentences. Texts are read again to cut out what
    goes.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("doc", document_key("id", "text"))
    kind = dict(rows.dtypes)["id"]
    marks = cut_lineage(rows.mapInArrow(_split_texts, f"id {kind}, doc long, n int, ends binary, counts binary, hashes binary"))
    # listed twice: writing all runs would take more disk than the texts
    spans = marks.select("id", "doc", "counts", "hashes").mapInArrow(_spans(run, words, ends), f"span long, doc long, id {kind}, first int, end int")
    place = F.struct(F.col("id").isNull().alias("nil"), "id", "doc", "first")
    least = spans.groupBy("span").agg(F.min(place).alias("least"), F.max(place).alias("most"))
    repeated = cut_lineage(least.filter("least != most").select("span", F.col("least.doc").alias("at_doc"), F.col("least.first").alias("at_first")))
    later = spans.join(repeated, "span").filter((F.col("doc") != F.col("at_doc")) | (F.col("first") != F.col("at_first")))
    drop = later.groupBy("doc").agg(F.collect_set(F.struct("first", "end")).alias("drop"))
    of_doc = marks.select("doc", "ends").join(drop, "doc").dropDuplicates(["doc"])
    places = cut_lineage(of_doc.mapInArrow(_places, "doc long, n_removed int, edges binary"))
    release(repeated)
    sizes = marks.groupBy("doc").agg(F.max("n").alias("n_sentences"))
    joined = rows.join(sizes, "doc").join(places, "doc", "left").select("id", "text", "n_sentences", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), "edges")
    return joined.mapInArrow(_without, f"id {kind}, n_sentences int, n_removed int, text string")
