"""Byte-pair encoding and decoding in batched numpy merge rounds."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import slices

#: Fixed pattern of the vocabulary file: what is a word.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves; the others follow from U+0100 on, in order.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


@dataclass
class Vocabulary:
    """Tables of a vocabulary file: ids of the bytes, pairs by sorted key, written forms."""

    base: np.ndarray
    last: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    written: list[bytes]
    special: dict[str, int]
    source: str
    normalises: bool = True
    rank_order: np.ndarray = field(default=None)  # merged id by rank


def load(path: str) -> Vocabulary:
    """Read a vocabulary file with word ends, once, on the driver; its size is fixed."""
    with open(path, encoding="utf-8") as f:
        source = f.read()
    spec = json.loads(source)
    model = spec["model"]
    vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    parts = [(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    left = np.array([vocab[a] for a, _ in parts], np.int64)
    right = np.array([vocab[b] for _, b in parts], np.int64)
    into = np.array([vocab[a + b] for a, b in parts], np.int64)
    keys = left << np.int64(32) | right
    order = np.argsort(keys, kind="stable")
    written = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for token, i in {**vocab, **special}.items():
        written[i] = token.encode("utf-8")
    letters = byte_letters()
    return Vocabulary(
        np.array([vocab[c] for c in letters], np.int64), np.array([vocab[c + end] for c in letters], np.int64),
        keys[order], order.astype(np.int64), into[order], written, special, source, rank_order=into,
    )


def encode_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words in one flat array, and the number of symbols of each word.

    In every round each word merges the pair of its lowest rank wherever it
    stands, from left to right; words without a known pair are finished.
    """
    length = np.array([len(w) for w in words], np.int64)
    raw = np.frombuffer(b"".join(words), np.uint8)
    symbol, word = v.base[raw], np.repeat(np.arange(len(words)), length)
    ends = np.cumsum(length)[length > 0] - 1
    symbol[ends] = v.last[raw[ends]]
    done_symbol, done_word, done_place = [], [], []
    place = np.arange(len(symbol))
    none = len(v.ranks)
    while len(symbol):
        key = symbol[:-1] << np.int64(32) | symbol[1:]
        spot = np.searchsorted(v.pairs, key)
        spot[spot == none] = 0
        known = (v.pairs[spot] == key) & (word[:-1] == word[1:])
        rank = np.append(np.where(known, v.ranks[spot], none), none)
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        best = np.minimum.reduceat(rank, starts)
        size = np.diff(np.append(starts, len(word)))
        lowest = np.repeat(best, size)
        over = lowest == none
        if over.any():
            done_symbol.append(symbol[over])
            done_word.append(word[over])
            done_place.append(place[over])
            symbol, word, place, rank, lowest = symbol[~over], word[~over], place[~over], rank[~over], lowest[~over]
            if not len(symbol):
                break
        hit = np.flatnonzero(rank == lowest)
        # neighbouring hits overlap (a pair of equal symbols): every second of a run counts
        fresh = np.r_[True, np.diff(hit) > 1]
        first = hit[np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))]
        hit = hit[(hit - first) % 2 == 0]
        symbol[hit] = v.rank_order[rank[hit]]
        keep = np.ones(len(symbol), bool)
        keep[hit + 1] = False
        symbol, word, place = symbol[keep], word[keep], place[keep]
    if not done_symbol:
        return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
    symbol, word, place = map(np.concatenate, (done_symbol, done_word, done_place))
    order = np.argsort(place, kind="stable")
    return symbol[order], np.bincount(word, minlength=len(words))


class Encoder:
    """Texts to ids, by pieces between white space; pieces seen before are remembered up to a bound.

    Texts are brought to NFC and lower case and cut into pieces, and new pieces
    into words. Characters that this Python does not know (unassigned in its
    Unicode tables) may be classed otherwise by the vocabulary's own library,
    whose normaliser and splitter then cut that text.
    """

    def __init__(self, v: Vocabulary, remember: int = 120_000):
        self.v, self.remember = v, remember
        self.find = regex.compile(WORDS).findall
        #: Separators that str.split takes for white space and the pattern does not.
        self.controls = regex.compile(r"[\x1c-\x1f]")
        self.special = regex.compile("(" + "|".join(map(regex.escape, v.special)) + ")") if v.special else None
        self.ids: dict[str, bytes] = {}
        self.alphabet: dict[str, bool] = {}
        self.library = None

    def _strange(self, text: str) -> bool:
        known = self.alphabet
        for c in set(text):
            if c not in known:
                known[c] = unicodedata.category(c) in ("Cn", "Co", "Cs")
            if known[c]:
                return True
        return False

    def _cut(self, text: str) -> list[str]:
        if not text.isascii():
            if self._strange(text):
                if self.library is None:
                    from tokenizers import Tokenizer

                    self.library = Tokenizer.from_str(self.v.source)
                plain = self.library.normalizer.normalize_str(text)
                return ["\n" + plain[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(plain)]
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        return self.find(text) if self.controls.search(text) else text.split()

    def pieces(self, text: str) -> list[str]:
        """Pieces and special strings of a text, in order.

        A piece after a line break is one word as it is; one after a blank only
        looks like a special string.
        """
        if self.special is None or "<|" not in text:
            return self._cut(text)
        out = []
        for part in self.special.split(text):
            out += [part] if part in self.v.special else [f" {p}" if p in self.v.special else p for p in self._cut(part)]
        return out

    def learn(self, texts: list[list[str]]) -> None:
        """Encode the pieces of ``texts`` that are not remembered, all at once."""
        if len(self.ids) > self.remember:
            self.ids = {}
        if not self.ids:
            self.ids = {token: i.to_bytes(4, "little") for token, i in self.v.special.items()}
        new = list(set().union(*texts) - self.ids.keys())
        cut = [[p[1:]] if p[0] == "\n" else self.find(p) for p in new]
        words = [w.encode("utf-8", "surrogatepass") for c in cut for w in c]
        symbols, counts = encode_words(words, self.v)
        words_before = np.cumsum([0, *map(len, cut)])
        ends = np.r_[0, np.cumsum(counts)][words_before].tolist()
        flat = symbols.astype("<u4").tobytes()
        for piece, start, end in zip(new, ends, ends[1:]):
            self.ids[piece] = flat[4 * start : 4 * end]

    def encode(self, texts: list[str | None]) -> Iterator[tuple[bytes, list[str]]]:
        """Ids of each text as little-endian 32-bit integers, with its pieces."""
        cut = [self.pieces(t or "") for t in texts]
        self.learn(cut)
        for pieces in cut:
            yield b"".join(map(self.ids.__getitem__, pieces)), pieces

    def written(self, pieces: list[str]) -> bytes:
        """Text of the ids of the pieces."""
        return self.decode(b"".join(map(self.ids.__getitem__, pieces)))

    def decode(self, ids: bytes) -> bytes:
        """Text of ids: their written forms, joined by spaces."""
        return b" ".join(map(self.v.written.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_ENCODERS: dict[int, Encoder] = {}


def encoder_of(v: Vocabulary) -> Encoder:
    """One encoder per worker process and vocabulary, kept over tasks."""
    if (key := hash(v.source)) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(v)
    return _ENCODERS[key]


def encode_documents(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True, digests: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``id, n_tokens`` and, as asked, ``ids, decoded`` or their digests.

    ``vocabulary`` is the path of a vocabulary file, read by the driver. Null
    texts count as empty; special strings inside texts become their ids; nothing
    is added, cut or padded. ``ids`` are little-endian 32-bit integers in one
    binary, ``decoded`` is the text that the ids stand for. Rows are independent:
    repeated rows repeat, empty tables give no rows, other columns are not read.
    """
    tables = docs.sparkSession.sparkContext.broadcast(load(vocabulary))
    fields = "id {}, n_tokens long" + (", ids binary, decoded string" if ids else "") + (", ids_sha256 string, decoded_sha256 string" if digests else "")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tables.value)
        for batch in slices(batches, "text", 1 << 20):
            codes, decoded = [], []
            for code, _ in encoder.encode(batch.column("text").to_pylist()):
                codes.append(code)
                decoded.append(encoder.decode(code))
            out = {"id": batch.column("id"), "n_tokens": pa.array([len(c) // 4 for c in codes], pa.int64())}
            if ids:
                out |= {"ids": pa.array(codes, pa.binary()), "decoded": pa.array([d.decode() for d in decoded], pa.string())}
            if digests:
                out |= {k: pa.array([hashlib.sha256(x).hexdigest() for x in xs]) for k, xs in (("ids_sha256", codes), ("decoded_sha256", decoded))}
            yield pa.RecordBatch.from_pydict(out)

    return rows.mapInArrow(run, fields.format(dict(rows.dtypes)["id"]))


def decode_documents(encoded: DataFrame, vocabulary: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``id, decoded`` from rows whose ids are little-endian 32-bit integers; null ids decode to an empty text."""
    tables = encoded.sparkSession.sparkContext.broadcast(load(vocabulary))
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tables.value)
        for batch in slices(batches, "ids"):
            texts = [encoder.decode(x or b"").decode() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "decoded"])

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, decoded string")
