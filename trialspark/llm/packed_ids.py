"""Token ids in files of fixed bit width: written in id order by Spark tasks, read back whole or at any place."""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trialspark.llm.common import cut_lineage, slices
from trialspark.session import checkpoint_dir

MAGIC = b"IDBITS01"
#: Header: magic, bits of an id, ids of a block. Trailer: where documents and block offsets begin, number of ids, magic.
HEADER, TRAILER = struct.Struct("<8sII"), struct.Struct("<QQQ8s")
#: Ids of a block, a multiple of eight: eight ids of any width fill whole bytes.
BLOCK = 1 << 16
#: Ids after which a task goes on in another file, and ids that are unpacked at a time.
FILE_IDS, READ_IDS = 1 << 27, 1 << 20
#: Bytes of text encoded at a time; longer texts are cut where a word starts.
PIECE = 8 << 20

#: A blank before anything but white space starts a word in a byte-level vocabulary, whatever stands around it.
_WORD_START = re.compile(r" (?=[^\s\x1c-\x1f])")
#: Texts with another blank than that (RE2 syntax; more classes than the library counts as white space do no harm).
_OTHER_BLANK = r" (?:[\s\x0b\x1c-\x1f\x{85}]|\p{Z}|\z)"


def bits_for(largest: int) -> int:
    """Fewest bits that hold the ids up to ``largest``."""
    return max(1, int(largest).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids in ``width`` bits each, lowest bit first, without gaps; the last byte is filled with zeros."""
    n = len(ids)
    eights = np.zeros(-(-n // 8) * 8, np.uint64)
    eights[:n] = ids
    eights = eights.reshape(-1, 8)
    out = np.zeros((len(eights), width), np.uint8)
    for j in range(8):
        byte, shift = divmod(j * width, 8)
        bits = eights[:, j] << np.uint64(shift)
        for k in range(-(-(shift + width) // 8)):
            out[:, byte + k] |= (bits >> np.uint64(8 * k)).astype(np.uint8)
    return out.tobytes()[: -(-n * width // 8)]


def unpack(raw: bytes, width: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed bytes, as unsigned 32-bit integers."""
    eights = -(-n // 8)
    data = np.zeros(eights * width, np.uint8)
    have = np.frombuffer(raw, np.uint8)[: eights * width]
    data[: len(have)] = have
    data = data.reshape(eights, width)
    out = np.empty((eights, 8), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for j in range(8):
        byte, shift = divmod(j * width, 8)
        bits = np.zeros(eights, np.uint64)
        for k in range(-(-(shift + width) // 8)):
            bits |= data[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, j] = (bits >> np.uint64(shift)) & mask
    return out.reshape(-1)[:n]


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder, given as a path or as the address of a store that pyarrow knows."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


class PackedWriter:
    """Writes one file: header, blocks of packed ids, the documents with their starts, the offsets of the blocks, trailer."""

    def __init__(self, system: fs.FileSystem, path: str, width: int, block: int = BLOCK):
        if block % 8:
            raise ValueError("a block must hold a multiple of eight ids")
        self.width, self.block, self.n = width, block, 0
        self.out = system.open_output_stream(path)
        self.out.write(HEADER.pack(MAGIC, width, block))
        self.offsets, self.at = [], HEADER.size
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self.documents: list[pa.RecordBatch] = []

    def add(self, ids: np.ndarray, doc_ids: pa.Array, counts: np.ndarray) -> None:
        """Append documents: their ids one after another, and the number of ids of each."""
        starts = self.n + np.cumsum(counts) - counts
        self.documents.append(pa.RecordBatch.from_arrays([doc_ids, pa.array(starts.astype(np.int64)), pa.array(counts.astype(np.int64))], ["id", "start", "n_tokens"]))
        self.n += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            ready = np.concatenate(self.waiting)
            whole = self.held - self.held % self.block
            for at in range(0, whole, self.block):
                self._write(ready[at : at + self.block])
            self.waiting, self.held = [ready[whole:].copy()], self.held - whole

    def _write(self, ids: np.ndarray) -> None:
        raw = pack(ids, self.width)
        self.offsets.append(self.at)
        self.out.write(raw)
        self.at += len(raw)

    def close(self) -> tuple[int, int]:
        """Finish the file; returns its numbers of documents and ids."""
        if self.held:
            self._write(np.concatenate(self.waiting))
        table = pa.Table.from_batches(self.documents)
        documents, blocks = _ipc(table), np.array(self.offsets, "<u8").tobytes()
        self.out.write(documents)
        self.out.write(blocks)
        self.out.write(TRAILER.pack(self.at, self.at + len(documents), self.n, MAGIC))
        self.out.close()
        return table.num_rows, self.n


class PackedReader:
    """Random access to one file: any range of ids is read from the blocks that hold it."""

    def __init__(self, system: fs.FileSystem, path: str):
        self.file = system.open_input_file(path)
        size = self.file.size()
        magic, self.width, self.block = HEADER.unpack(self.file.read_at(HEADER.size, 0))
        at, blocks, self.n, end = TRAILER.unpack(self.file.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC or end != MAGIC:
            raise ValueError(f"not a file of packed ids: {path}")
        self.documents = pa.ipc.open_stream(self.file.read_at(blocks - at, at)).read_all().combine_chunks()
        offsets = np.frombuffer(self.file.read_at(size - TRAILER.size - blocks, blocks), "<u8")
        self.offsets = np.r_[offsets, np.uint64(at)].astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids number ``start`` up to ``stop``, counted from the beginning of the file."""
        if not 0 <= start <= stop <= self.n:
            raise IndexError(f"ids {start} to {stop} of {self.n}")
        if start == stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        raw = self.file.read_at(int(self.offsets[last + 1] - self.offsets[first]), int(self.offsets[first]))
        from_block = first * self.block
        return unpack(raw, self.width, stop - from_block)[start - from_block :]

    def document(self, i: int) -> np.ndarray:
        """Ids of the document at place ``i`` of the file."""
        start, n = (self.documents.column(c)[i].as_py() for c in ("start", "n_tokens"))
        return self.ids(start, start + n)


class BatchEncoder:
    """Ids of whole columns of texts.

    Texts are cut before every blank that starts a word; no token crosses such a
    place. The distinct parts of a batch go to the vocabulary's library, once
    while they are remembered, and their ids are laid out by one gather. Special
    strings are cut out first, as the library does.
    """

    def __init__(self, source: str, remember: int = 250_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the unit of parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(source)
        if self.library.normalizer is not None or type(self.library.pre_tokenizer).__name__ != "ByteLevel" or self.library.pre_tokenizer.add_prefix_space:
            raise ValueError("a byte-level vocabulary without normaliser and leading blank is needed")
        tokens = self.library.get_added_tokens_decoder()
        special = [t.content for t in tokens.values()]
        if any(t.lstrip or t.rstrip or t.single_word for t in tokens.values()):
            raise ValueError("special strings that take in what stands around them are not foreseen")
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.marks = special
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        #: Bytes that each id stands for: a letter of the vocabulary is one byte, special strings are themselves.
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.size[i] = len(token.encode()) if i in tokens else len(token)
        self.remember = remember
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    @property
    def largest(self) -> int:
        return len(self.size) - 1

    def _segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """Pieces of a text with special strings or of great length, and whether a blank was cut off before each."""
        for part in self.special.split(text) if self.special else [text]:
            at, led = 0, False
            while len(part) - at > PIECE and (cut := _WORD_START.search(part, at + PIECE)):
                yield part[at : cut.start()], led
                at, led = cut.end(), True
            yield part[at:], led

    def _codes(self, parts: list[str]) -> list[bytes]:
        """Ids of each part; parts used since the last turn of the store stay in it."""
        if len(self.known) > self.remember:
            self.before, self.known = self.known, {}
        known, before = self.known, self.before
        new = []
        for part in parts:
            if part not in known:
                if (code := before.get(part)) is not None:
                    known[part] = code
                else:
                    new.append(part)
        led, bare = [], []
        for part in new:
            (led if _WORD_START.match(part) else bare).append(part)
        for at in range(0, len(led), 20_000):
            known.update(zip(some := led[at : at + 20_000], self._together(some)))
        known.update(zip(bare, (np.array(c.ids, "<u4").tobytes() for c in self.library.encode_batch_fast(bare, add_special_tokens=False))))
        return list(map(known.__getitem__, parts))

    def _together(self, parts: list[str]) -> Iterator[bytes]:
        """Ids of parts that begin with a word start, encoded as one text: the bytes of the ids tell where each part ends."""
        flat = np.array(self.library.encode_batch_fast(["".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum(np.fromiter((len(p.encode("utf-8", "surrogatepass")) for p in parts), np.int64, len(parts)))
        edges = (4 * np.r_[0, np.searchsorted(np.cumsum(self.size[flat]), ends) + 1]).tolist()
        raw = flat.tobytes()
        return (raw[a:b] for a, b in zip(edges, edges[1:]))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids of each; null is empty."""
        texts = pc.fill_null(texts, "")
        n, owner, led = len(texts), None, np.zeros(len(texts), bool)
        care = pc.greater(pc.binary_length(texts), PIECE)
        for mark in self.marks:
            care = pc.or_(care, pc.match_substring(texts, mark))
        if pc.any(care).as_py():
            pieces = [(i, *s) for i, (t, c) in enumerate(zip(texts.to_pylist(), care.to_pylist())) for s in (self._segments(t) if c else [(t, False)])]
            owner = np.array([p[0] for p in pieces])
            texts, led = pa.array([p[1] for p in pieces], pa.string()), np.array([p[2] for p in pieces])
        loose = pc.match_substring_regex(texts, _OTHER_BLANK).to_numpy(zero_copy_only=False)
        # loose texts are cut one by one, all others at every blank
        own = [_WORD_START.split(t) for t in texts.filter(pa.array(loose)).to_pylist()]
        lists = pc.split_pattern(texts.filter(pa.array(~loose)), " ")
        parts = np.empty(len(texts), np.int64)
        parts[loose] = list(map(len, own))
        parts[~loose] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        coded = pa.concat_arrays([lists.flatten(), pa.array([p for ps in own for p in ps], pa.string())]).dictionary_encode()
        # back into the order of the texts
        code = coded.indices.to_numpy().astype(np.int64)
        if loose.any():
            code = code[np.argsort(np.repeat(np.r_[np.flatnonzero(~loose), np.flatnonzero(loose)], np.r_[parts[~loose], parts[loose]]), kind="stable")]
        words = coded.dictionary.to_pylist()
        first = (np.cumsum(parts) - parts)[~led]
        bare, at = np.unique(code[first], return_inverse=True)
        code[first] = len(words) + at
        blobs = self._codes([" " + w for w in words] + [words[i] for i in bare])
        size = np.array(list(map(len, blobs)), np.int64) >> 2
        flat = np.frombuffer(b"".join(blobs), "<u4")
        begin = np.cumsum(size) - size
        length = size[code]
        after = np.cumsum(length)
        ids = flat[np.repeat(begin[code] - (after - length), length) + np.arange(after[-1] if len(after) else 0)]
        total = np.r_[0, after]
        ends = np.cumsum(parts)
        counts = total[ends] - total[ends - parts]
        if owner is not None:
            counts = np.bincount(owner, counts, n).astype(np.int64)
        return ids, counts


_ENCODERS: dict[int, BatchEncoder] = {}


def encoder_of(source: str) -> BatchEncoder:
    """One encoder per worker process and vocabulary, kept over tasks."""
    if (key := hash(source)) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = BatchEncoder(source)
    return _ENCODERS[key]


def with_ends(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with ``end`` after each document, and their counts."""
    out = np.full(len(ids) + len(counts), end, np.uint32)
    own = np.ones(len(out), bool)
    own[np.cumsum(counts + 1) - 1] = False
    out[own] = ids
    return out, counts + 1


def write_ids(
    docs: DataFrame,
    vocabulary: str,
    folder: str | None = None,
    end: int | None = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_ids: int = FILE_IDS,
    block: int = BLOCK,
) -> DataFrame:
    """Encode texts and write their ids in ascending order of ``id_col``; returns the list of files.

    The list has a row per file: ``task, part, folder, file, n_docs, n_tokens``;
    files that are not in it (of tasks that were lost or ran twice) don't count.
    ``vocabulary`` is a byte-level file of the tokenizers library, read by the
    driver; ids take the fewest bits that its largest id needs. ``folder`` must
    be one that all executors share (a path or an address that pyarrow opens);
    by default it is a new one beside the written steps. After each document
    stands ``end``, unless that is None.

    Null texts are empty, null ids come first, rows of one id follow in the order
    of a hash of their texts; equal rows are written as often as they occur, and
    their place in the table keeps them from piling up in one task. A text of any
    length is one document; it is encoded in pieces cut at word starts, and a
    text without any blank in one piece. No rows, no files. Other columns are not
    read.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        text = f.read()
    width = bits_for(max(BatchEncoder(text).largest, end or 0))
    source = spark.sparkContext.broadcast(text)
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    order = ["id", "same", "place"]
    placed = rows.withColumns({"same": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = encoder_of(source.value), TaskContext.get().partitionId()
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        out, part = None, 0

        def done() -> pa.RecordBatch:
            n_docs, n_tokens = out.close()
            row = {"task": task, "part": part, "folder": folder, "file": name, "n_docs": n_docs, "n_tokens": n_tokens}
            return pa.RecordBatch.from_pylist([row], schema)

        schema = pa.schema([("task", pa.int32()), ("part", pa.int32()), ("folder", pa.string()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
        for batch in slices(batches, "text", min(PIECE, 4 * file_ids)):
            if out is None:
                name = f"{task:06d}-{part:04d}-{uuid.uuid4().hex}.ids"
                out = PackedWriter(system, f"{path}/{name}", width, block)
            ids, counts = encoder.encode(batch.column("text"))
            if end is not None:
                ids, counts = with_ends(ids, counts, end)
            out.add(ids, batch.column("id"), counts)
            if out.n >= file_ids:
                yield done()
                out, part = None, part + 1
        if out is not None:
            yield done()

    return cut_lineage(ordered.mapInArrow(write, "task int, part int, folder string, file string, n_docs long, n_tokens long"))


def read_ids(files: DataFrame, id_type: str = "long", ids: bool = True, digests: bool = False) -> DataFrame:
    """Documents of written files: ``id, start, n_tokens`` and, as asked, ``ids`` (little-endian, 32 bits) or their ``ids_crc32``.

    ``files`` is the list that :func:`write_ids` returned, or rows of it;
    ``start`` counts the ids of all listed files before. Each task reads whole
    files, some documents at a time; a long document's digest is taken piece by
    piece.
    """
    before = Window.orderBy("task", "part").rowsBetween(Window.unboundedPreceding, -1)
    # one slim row per file
    listed = files.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    spread = listed.repartitionByRange(max(1, files.count()), "task", "part")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = open_folder(row["folder"])
                reader = PackedReader(system, f"{path}/{row['file']}")
                starts, counts = (reader.documents.column(c).to_numpy() for c in ("start", "n_tokens"))
                group = (starts + counts - 1) // READ_IDS
                edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
                for a, b in zip(edges, edges[1:]):
                    some = reader.documents.slice(a, b - a)
                    out = {"id": some.column("id").combine_chunks(), "start": pa.array(starts[a:b] + row["before"]), "n_tokens": pa.array(counts[a:b])}
                    first, last = int(starts[a]), int(starts[b - 1] + counts[b - 1])
                    if ids or last - first <= 2 * READ_IDS:
                        raw = reader.ids(first, last).astype("<u4").tobytes()
                        cut = [raw[4 * (s - first) : 4 * (s - first + n)] for s, n in zip(starts[a:b].tolist(), counts[a:b].tolist())]
                        digest = map(zlib.crc32, cut)
                    else:
                        digest = [_crc(reader, s, s + n) for s, n in zip(starts[a:b].tolist(), counts[a:b].tolist())]
                    if ids:
                        out["ids"] = pa.array(cut, pa.binary())
                    if digests:
                        out["ids_crc32"] = pa.array(digest, pa.int64())
                    yield pa.RecordBatch.from_pydict(out)

    return spread.mapInArrow(read, f"id {id_type}, start long, n_tokens long" + ", ids binary" * ids + ", ids_crc32 long" * digests)


def _crc(reader: PackedReader, start: int, stop: int) -> int:
    crc = 0
    for at in range(start, stop, READ_IDS):
        crc = zlib.crc32(reader.ids(at, min(stop, at + READ_IDS)).astype("<u4").tobytes(), crc)
    return crc
