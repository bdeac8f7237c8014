"""Token counts of texts of any length, by overlapping chunks that are spliced where both agree."""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import cut_lineage, release, slices

#: Fixed pattern of byte-level vocabularies: what is a word.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters at the end of a chunk whose cuts may depend on what follows: a special string is shorter.
MARGIN = 64


class Counter:
    """Cuts texts into parts and counts the tokens of each part with the library, once per part seen."""

    def __init__(self, source: str, remember: int = 150_000):
        # tasks are the unit of parallelism: no threads inside them
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(source)
        self.find = regex.compile(WORDS).findall
        self.loose = regex.compile(r" (?:[\s\x1c-\x1f]|\Z)").search
        specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        if any(len(s) >= MARGIN for s in specials):
            raise ValueError("a special string is longer than the margin")
        self.marks = {s[:2] for s in specials}
        self.remember = remember
        #: Tokens of words and first parts, and of parts after a blank.
        self.words: dict[str, int] = {}
        self.after: dict[str, int] = {}
        self.alphabet: dict[str, bool] = {}

    def plain(self, text: str) -> bool:
        """Whether the pattern here cuts the text as the library does: no special strings, only known characters."""
        if any(m in text for m in self.marks):
            return False
        if text.isascii():
            return True
        known = self.alphabet
        for c in set(text):
            if c not in known:
                known[c] = unicodedata.category(c) not in ("Cn", "Co", "Cs")
            if not known[c]:
                return False
        return True

    def cut(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Lengths of the parts each text is cut into, all at word starts, and the tokens of each part.

        A blank before anything but white space starts a word; so a text whose
        blanks are all of that kind is cut at its blanks, other plain texts at
        every word. The rest is left to the library, whose word numbers tell the
        cuts.
        """
        out: list = [None] * len(texts)
        for i, text in enumerate(texts):
            if not self.plain(text):
                out[i] = self._by_library(text)
            elif self.loose(text):
                words = self.find(text)
                out[i] = (list(map(len, words)), words, self.words)
            else:
                first, *rest = text.split(" ")
                out[i] = ([len(first), *(len(p) + 1 for p in rest)], [first, *rest], self.after)
        if len(self.words) + len(self.after) > self.remember:
            self.words.clear()
            self.after.clear()
        self._learn(self.words, "", [x[1] if x[2] is self.words else x[1][:1] for x in out if len(x) == 3])
        self._learn(self.after, " ", [x[1][1:] for x in out if len(x) == 3 and x[2] is self.after])
        done = []
        for x in out:
            if len(x) == 3:
                first = [self.words[p] for p in x[1][:1]]
                x = (x[0], first + list(map(x[2].__getitem__, x[1][1:])))
            done.append(x)
        return done

    def _learn(self, known: dict[str, int], lead: str, parts: list[list[str]]) -> None:
        new = list(set().union(*parts) - known.keys())
        for at in range(0, len(new), 2_000):
            part = new[at : at + 2_000]
            codes = self.library.encode_batch_fast([lead + p for p in part] if lead else part, add_special_tokens=False)
            known.update(zip(part, (len(c.ids) for c in codes)))

    def _by_library(self, text: str) -> tuple[list[int], list[int]]:
        code = self.library.encode(text, add_special_tokens=False)
        if not code.ids:
            return [], []
        word = np.array([-1 if w is None else w for w in code.word_ids])
        starts, ends = np.array(code.offsets, np.int64).T
        # a word ends where the word number changes and the characters do too
        new = np.flatnonzero(np.r_[True, ((word[1:] != word[:-1]) | (word[1:] < 0)) & (starts[1:] >= ends[:-1])])
        return np.diff(np.r_[starts[new], len(text)]).tolist(), np.diff(np.r_[new, len(word)]).tolist()


_COUNTERS: dict[int, Counter] = {}


def counter_of(source: str) -> Counter:
    """One counter per worker process and vocabulary, kept over tasks: loading takes time and memory."""
    if (key := hash(source)) not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(source)
    return _COUNTERS[key]


def _chunks(size: int, overlap: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1):
            key, text = batch.column("key")[0].as_py(), batch.column("text")[0].as_py()
            n = max(1, -(-len(text) // size))
            for at in range(0, n, 64):
                parts = range(at, min(n, at + 64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(parts), pa.int64()), pa.array(list(parts), pa.int32()), pa.array([k == n - 1 for k in parts]), pa.array([text[k * size : (k + 1) * size + overlap] for k in parts], pa.string())],
                    ["key", "k", "last", "text"],
                )

    return cut


def _bounds(source, size: int, overlap: int):
    """Per chunk: its tokens, and the word starts in both overlaps with the tokens before each."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(source.value)
        for batch in slices(batches, "text", 1 << 20):
            columns: dict[str, list] = {c: [] for c in ("total", "left_at", "left_before", "right_at", "right_before")}
            texts = batch.column("text").to_pylist()
            for text, last, (lengths, tokens) in zip(texts, batch.column("last").to_pylist(), counter.cut(texts)):
                at = np.r_[0, np.cumsum(np.array(lengths, np.int64))]
                before = np.r_[0, np.cumsum(np.array(tokens, np.int64))]
                columns["total"].append(int(before[-1]))
                for side, start in (("left", 0), ("right", size)):
                    end = start + overlap if last else min(start + overlap, len(text) - MARGIN)
                    own = slice(*np.searchsorted(at, [start, max(start, end)]))
                    columns[f"{side}_at"].append((at[own] - start).tolist())
                    columns[f"{side}_before"].append(before[own].tolist())
            kinds = {"total": pa.int64()}
            arrays = [pa.array(v, kinds.get(c, pa.list_(pa.int64()))) for c, v in columns.items()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("k"), batch.column("last"), *arrays], ["key", "k", "last", *columns])

    return measure


def _long_counts(texts: DataFrame, source, size: int, overlap: int) -> DataFrame:
    """``key, n_tokens`` of distinct long texts.

    Chunk ``k`` begins ``k * size`` characters in and runs ``overlap`` beyond the
    next one's start. A word start that the earlier chunk has in the overlap is
    true as long as it lies before its margin, since cuts look ahead only; where
    the later chunk has a word start at the same place, both go on alike from
    there, so the counts are spliced at the first such place. A text without one
    in some overlap is cut again with overlaps eight times as wide; once an
    overlap is as long as the text, the text is one chunk.
    """
    spark, done, todo = texts.sparkSession, [], texts
    while True:
        chunk = max(size, overlap)
        parts = todo.mapInArrow(_chunks(chunk, overlap), "key long, k int, last boolean, text string")
        parts = parts.repartition(F.xxhash64("key", "k"))
        shape = "key long, k int, last boolean, total long, left_at array<long>, left_before array<long>, right_at array<long>, right_before array<long>"
        found = cut_lineage(parts.mapInArrow(_bounds(source, chunk, overlap), shape))
        after = found.select("key", (F.col("k") - 1).alias("k"), F.col("left_at").alias("next_at"), F.col("left_before").alias("next_before"))
        both = found.filter("not last").join(after, ["key", "k"])
        both = both.withColumn("at", F.array_min(F.array_intersect("right_at", "next_at")))
        place = lambda at, before: F.element_at(before, F.array_position(at, F.col("at")).cast("int"))
        ends = both.select("key", F.when(F.col("at").isNotNull(), place("right_at", "right_before") - place("next_at", "next_before")).alias("gain"), F.col("at").isNull().alias("missed"))
        ends = ends.unionByName(found.filter("last").select("key", F.col("total").alias("gain"), F.lit(False).alias("missed")))
        counts = cut_lineage(ends.groupBy("key").agg(F.sum("gain").alias("n_tokens"), F.max("missed").alias("missed")))
        release(found)
        done.append(counts.filter("not missed").select("key", "n_tokens"))
        missed = counts.filter("missed").select("key")
        if missed.isEmpty():
            break
        todo = todo.join(missed, "key", "left_semi")
        overlap *= 8
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def count_tokens(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", size: int = 32_768, overlap: int = 512
) -> DataFrame:
    """One row per row of ``docs``: ``id, n_bytes, n_tokens``, as the vocabulary file's library counts.

    ``vocabulary`` is the path of a file of the tokenizers library, read by the
    driver; it must have no normaliser, byte-level words and no template. Null
    counts as empty (0 and 0). Special strings inside texts count as one token.
    Texts above ``size`` characters are cut into chunks that are dealt out anew,
    so one huge document spreads over tasks; equal long texts are counted once.
    Repeated rows stay; empty tables give no rows; other columns are not read.
    """
    with open(vocabulary, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["id"]
    long = F.length("text") > size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(source.value)
        for batch in slices(batches, "text", 1 << 20):
            texts = batch.column("text").to_pylist()
            tokens = pa.array([sum(n) for _, n in counter.cut(texts)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), tokens], ["id", "n_bytes", "n_tokens"])

    measured = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    short = measured.filter(~long).mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    key = F.xxhash64("text", F.lit("long"))
    texts = rows.filter(long).select(key.alias("key"), "text").dropDuplicates(["key"])
    counted = _long_counts(texts, source, size, overlap)
    of_long = measured.filter(long).select("id", "n_bytes", key.alias("key")).join(counted, "key")
    return short.unionByName(of_long.select("id", "n_bytes", "n_tokens"))
