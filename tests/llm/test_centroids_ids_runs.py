"""Centroid clustering, packed ids and periodic runs against plain versions and the vocabulary's library."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trialspark.llm import centroid_clustering, packed_ids, periodic_runs, queries

SF = "/root/testdata/sf0.001"
BYTE = str(public_tokenizers.path("byte_bpe_50k.json"))


# --- centroid clustering ---


def plain_clusters(rows, k, rounds, dims, scale=256, seed=2):
    """Rows ``(id, vector)`` to ``(id, cluster, distance)`` and the last centroids, in plain Python."""
    limit = centroid_clustering.largest_component(dims) / scale
    fits = lambda v: v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x) <= limit for x in v)
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if fits(v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]
    far = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    assign = lambda: [min((far(v, c), j) for j, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        near = assign()
        for j in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, near) if c == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    return [(i, c, d) for (i, _), (d, c) in zip(kept, assign())], centroids


@pytest.mark.parametrize(("axes", "bits"), [(1, 4), (2, 4), (3, 3), (5, 2)])
def test_hilbert_curve_goes_from_cell_to_neighbour(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    keys = centroid_clustering.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_boxes_keep_the_nearest_centroid_and_leave_out_far_ones():
    rng = np.random.default_rng(4)
    left = 0
    for _ in range(200):
        dims, size = int(rng.integers(1, 9)), int(rng.choice([2, 30, 400]))
        v = rng.integers(-300, 300, dims) + rng.integers(0, size, (40, dims))
        centroids = rng.integers(-400, 400, (12, dims))
        among = centroid_clustering.candidates(v.min(axis=0), v.max(axis=0), centroids)
        cluster, distance = centroid_clustering.nearest(v, centroids, among)
        far = ((v[:, None] - centroids) ** 2).sum(axis=2)
        assert (cluster == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()
        left += len(among)
    assert left < 200 * 12 * 0.6


def test_distances_are_exact_where_doubles_are_not():
    large = centroid_clustering.largest_component(3)
    v = np.array([[large, -large, large - 1], [large - 1, -large, large]])
    centroids = np.array([[-large, large, -large], [large, 1 - large, large]])
    cluster, distance = centroid_clustering.nearest(v, centroids, np.arange(2))
    assert cluster.tolist() == [1, 1] and distance.tolist() == [2, 2]
    assert centroid_clustering.nearest(v, centroids[:1], np.arange(1))[1][0] == (2 * large) ** 2 * 2 + (2 * large - 1) ** 2


def test_clusters_by_a_plain_version(spark):
    random.seed(6)
    rows = [(i, [random.gauss(3 * (i % 5), 0.3) for _ in range(3)]) for i in range(300)]
    rows += [(1000 + i, [1.0, 1.0, 1.0]) for i in range(150)]  # ties along the curve
    rows += [(7, rows[7][1]), (7, [0.0, 0.0, 0.0]), (None, [1.0, 2.0, 3.0]), (None, None), (2000, [1.0, None, 2.0]), (2001, [1.0, math.nan, 2.0])]
    rows += [(2002, [1.0, math.inf, 2.0]), (2003, [1.0, 2.0]), (2004, []), (2005, [1e30, 0.0, 0.0]), (2006, [500_000.0, 0.0, -3.0])]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, v int")
    for k, rounds in ((8, 3), (1, 1), (1000, 1)):
        want, centroids = plain_clusters(rows, k, rounds, 3)
        got = centroid_clustering.centroid_clusters(table, k, rounds, 3, block=16).collect()
        assert sorted(map(repr, ((r["id"], r["cluster"], r["distance"]) for r in got))) == sorted(map(repr, want))
        for r in got:
            assert list(r["centroid"]) == centroids[r["cluster"]]
            assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
            assert r["inertia"] == sum(d for _, _, d in want)
    nothing = centroid_clustering.centroid_clusters(table.limit(0), 8, 3, 3)
    assert nothing.count() == 0 and nothing.columns == got[0].__fields__


# --- packed ids ---


@pytest.mark.parametrize("width", [1, 3, 8, 13, 16, 17, 24, 31, 32])
def test_packing_of_any_width(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1003).astype(np.uint32)
    raw = packed_ids.pack(ids, width)
    assert len(raw) == -(-1003 * width // 8)
    assert (packed_ids.unpack(raw, width, 1003) == ids).all()
    assert packed_ids.bits_for((1 << width) - 1) == width
    bits = "".join(f"{b:08b}"[::-1] for b in raw)
    assert int(bits[5 * width : 6 * width][::-1], 2) == ids[5]


def odd_texts(n):
    random.seed(3)
    parts = ["a", "b", "don't", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "é", "日", "<|endoftext|>", "<|", "<|endoftext", "12", ".", "!", "'s", " x y", "᠎", "͸", "😀", " the"]
    return ["".join(random.choice(parts) for _ in range(random.randint(0, 12))) for _ in range(n)]


@pytest.mark.parametrize("piece", [40, 8 << 20])
def test_ids_are_those_of_the_library(monkeypatch, piece):
    monkeypatch.setattr(packed_ids, "PIECE", piece)
    with open(BYTE, encoding="utf-8") as f:
        encoder = packed_ids.BatchEncoder(f.read(), remember=500)
    library = Tokenizer.from_file(BYTE)
    texts = [*odd_texts(3000), "", None, " ", "word " * 200, "x" * 3000]
    for at in range(0, len(texts), 700):
        some = texts[at : at + 700]
        ids, counts = encoder.encode(pa.array(some, pa.string()))
        want = [library.encode(t or "", add_special_tokens=False).ids for t in some]
        assert ids.tolist() == [i for w in want for i in w]
        assert counts.tolist() == list(map(len, want))


def test_files_hold_all_documents_in_order(spark, documents, tmp_path):
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()] + [(i, t) for i, t in enumerate(odd_texts(200), 100)]
    texts += [(500, "same row")] * 40
    table = spark.createDataFrame([(i, t, 9, "y") for i, t in texts], "doc_id long, text string, start int, file string").repartition(5)
    files = packed_ids.write_ids(table, BYTE, folder=str(tmp_path / "ids"), file_ids=3000, block=64)
    listed = files.orderBy("task", "part").collect()
    assert sum(r["n_docs"] for r in listed) == len(texts) and len({r["task"] for r in listed}) < len(listed)
    rows = sorted(packed_ids.read_ids(files, digests=True).collect(), key=lambda r: r["start"])
    ids = [r["id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    library = Tokenizer.from_file(BYTE)
    code = lambda t: np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
    assert sorted((str(r["id"]), bytes(r["ids"])) for r in rows) == sorted((str(i), code(t)) for i, t in texts)
    at = 0
    for r in rows:
        assert (r["start"], 4 * r["n_tokens"], r["ids_crc32"]) == (at, len(r["ids"]), zlib.crc32(r["ids"]))
        at += r["n_tokens"]
    everything = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in rows])
    at = 0
    for r in listed:  # any range of any file
        system, folder = packed_ids.open_folder(r["folder"])
        reader = packed_ids.PackedReader(system, f"{folder}/{r['file']}")
        assert (reader.width, reader.n) == (16, r["n_tokens"])
        for _ in range(20):
            a, b = sorted(random.choices(range(reader.n + 1), k=2))
            assert (reader.ids(a, b) == everything[at + a : at + b]).all()
        place = random.randrange(r["n_docs"])
        start = reader.documents.column("start")[place].as_py()
        assert (reader.document(place) == everything[at + start :][: reader.documents.column("n_tokens")[place].as_py()]).all()
        with pytest.raises(IndexError):
            reader.ids(0, reader.n + 1)
        at += reader.n


def test_long_documents_are_read_in_pieces(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(packed_ids, "READ_IDS", 50)  # also in the workers, which get the function with it
    table = spark.createDataFrame([(1, "a b " * 400), (0, "c"), (2, None)], "doc_id long, text string")
    files = packed_ids.write_ids(table, BYTE, folder=f"file:{tmp_path}/x", end=None)
    got = packed_ids.read_ids(files, ids=False, digests=True).orderBy("id").collect()
    library = Tokenizer.from_file(BYTE)
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ("c", "a b " * 400, "")]
    assert [(r["n_tokens"], r["ids_crc32"]) for r in got] == [(len(w) // 4, zlib.crc32(w)) for w in want]
    assert packed_ids.read_ids(packed_ids.write_ids(table.limit(0), BYTE)).count() == 0


def test_packed_query_over_the_table(spark):
    library = Tokenizer.from_file(BYTE)
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    want, at = [], 0
    for r in rows:
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        want.append((r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = queries.QUERIES["op12_packed_ids"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


# --- periodic runs ---


def plain_lyndon(codes):
    """A longest Lyndon word ends where the next smaller suffix begins."""
    out = []
    for i in range(len(codes)):
        j = i + 1
        while j < len(codes) and codes[j:] > codes[i:]:
            j += 1
        out.append(j - i)
    return out


def plain_runs(words, least=24, times=3):
    """For every period, the longest stretches in which each word is the one a period later."""
    codes = np.unique(np.array(words, object).astype(str), return_inverse=True)[1] if words else np.zeros(0, int)
    found = {}
    for q in range(1, len(codes) // times + 1):
        same = np.r_[False, codes[:-q] == codes[q:], False]
        starts, ends = np.flatnonzero(~same[:-1] & same[1:]), np.flatnonzero(same[:-1] & ~same[1:])
        for start, end in zip(starts.tolist(), ends.tolist()):
            if end - start + q >= max(least, times * q):
                found.setdefault((start, end - start + q), q)  # the smallest period comes first
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def test_lyndon_arrays_and_runs_by_brute_force():
    random.seed(5)
    for _ in range(800):
        n, k = random.randint(0, 40), random.choice([1, 2, 2, 3, 5])
        codes = [random.randrange(k) for _ in range(n)]
        if n and random.random() < 0.5:
            codes = (codes[: random.randint(1, 9)] * 40)[:n]
            codes[random.randrange(n)] += random.random() < 0.5
        array = np.array(codes, np.int64)
        assert periodic_runs.lyndon_array(array).tolist() == plain_lyndon(codes)
        for least, times in ((3, 3), (6, 3), (8, 4)):
            assert periodic_runs.runs_of(array, least, times) == plain_runs(codes, least, times)


def worded(n):
    random.seed(8)
    out = []
    for _ in range(n):
        words = [random.choice(["a", "b", "c", "dd", f"w{random.randrange(60)}", f"v{random.randrange(60)}"]) for _ in range(random.randint(0, 90))]
        for _ in range(random.randint(0, 3)):
            block, at = [random.choice("abz") for _ in range(random.randint(1, 14))], random.randint(0, len(words))
            words[at:at] = (block * 70)[: random.randint(10, 70)]
        out.append("".join(random.choice([" ", "  ", "\n", "\t "]) * (i > 0 or random.random() < 0.1) + w for i, w in enumerate(words)) + random.choice(["", " "]))
    return out


def test_runs_of_texts_by_brute_force(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()] + list(enumerate(worded(400), 100))
    rows += [(900, "la " * 30_000), (901, "é\xa0ß " * 24), (902, "x y z\x0b" * 7 + "x y z"), (902, "x y z\x0b" * 7 + "x y z"), (903, "a b " * 11 + "a")]
    table = spark.createDataFrame([(i, t, 5, "r") for i, t in rows], "doc_id long, text string, n_words int, runs string")
    for least, times in ((24, 3), (9, 4)):
        got = periodic_runs.periodic_runs(table, least, times).collect()
        assert len(got) == len(rows)
        want = []
        for i, t in rows:
            words = [w for w in (t or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
            runs = plain_runs(words, least, times)
            gone = {j for s, n, q in runs for j in range(s + q, s + n)}
            want.append(repr((i, len(words), runs, " ".join(w for j, w in enumerate(words) if j not in gone))))
        assert sorted(repr((r["id"], r["n_words"], [tuple(x) for x in r["runs"]], r["text"])) for r in got) == sorted(want)
    assert periodic_runs.periodic_runs(table.limit(0)).count() == 0


def test_small_batches_give_the_same_runs(monkeypatch):
    texts = [*worded(60), None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["id", "text"])
    whole = [r for b in periodic_runs._found(24, 3)(iter([batch])) for r in b.to_pylist()]
    monkeypatch.setattr(periodic_runs, "PIECE", 50)
    assert [r for b in periodic_runs._found(24, 3)(iter([batch.slice(0, 7), batch.slice(7)])) for r in b.to_pylist()] == whole


def test_planted_periods_follow_the_rule(spark, documents):
    rows = [(i, t) for i, t in enumerate(worded(200))] + [(10_000 + i, None if i % 3 else " \t") for i in range(40)]
    table = spark.createDataFrame([*rows, (None, "kept as it is")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in queries.with_planted_periods(table).collect()}
    assert got.pop(None) == "kept as it is"
    for i, t in rows:
        h = zlib.crc32(str(i).encode())
        words, g = (t or "").split(), h // 10
        if h % 10 == 0:
            if words:
                a = g % len(words)
                p = 1 + (len(words) - a) // (3 + g % 8)
                words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            assert got[i] == " ".join(words)
        else:
            assert got[i] == t
    digests = queries.QUERIES["op13_periodic_runs"](spark, SF).filter(F.col("runs_sha256").isNull() | F.col("collapsed_sha256").isNull())
    assert digests.count() == 0
