import hashlib
import random
import re
import tracemalloc
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trialspark.llm import bpe, components, embedding_dedup, exact_dedup, line_dedup, mixing, ngram_join, queries, substring_dedup, token_counts, toxicity, url_filter
from trialspark.llm.common import cut_lineage, document_key

SF = "/root/testdata/sf0.001"
WORD, BYTE = (str(public_tokenizers.path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def groups_of(nodes, links):
    """Smallest member reachable, by a plain search."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for start in sorted(nodes):
        if start not in out:
            stack, out[start] = [start], start
            while stack:
                for y in near[stack.pop()]:
                    if y not in out:
                        out[y] = start
                        stack.append(y)
    return out


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(queries.SQL[name])
    columns = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))


def test_components(spark):
    random.seed(1)
    links = [(random.randrange(400), random.randrange(400)) for _ in range(330)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = groups_of({x for e in links for x in e}, links)
    assert got == {k: v for k, v in want.items() if k != v}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_sets(texts, words=5):
    out = []
    for t in texts:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        out.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    return out


def test_ngram_join_on_hard_rows(spark, documents, nothing):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    sets = brute_sets([t for _, t in rows])
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    top = groups_of(range(len(rows)), links)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top[i]].append(d)
    # a row without words keeps its own id
    want = sorted(repr((d, len(sets[i]), min(least[top[i]]) if sets[i] else d)) for i, (d, _) in enumerate(rows))
    got = ngram_join.ngram_jaccard_join(documents).select("id", "n_shingles", "component").collect()
    assert sorted(repr(tuple(r)) for r in got) == want
    assert ngram_join.ngram_jaccard_join(nothing).count() == 0


def test_ngram_join_of_large_groups(spark, monkeypatch):
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(900)]
    base = [random.choice(vocabulary) for _ in range(120)]
    texts = []
    for i in range(120):
        w = base if i % 3 else [random.choice(vocabulary) for _ in range(120)] + base[:30]
        w = list(w)
        for _ in range(random.randrange(0, 5)):
            w[random.randrange(len(w))] = random.choice(vocabulary)
        texts.append(" ".join(w))
    big = [random.choice(vocabulary) for _ in range(3000)]
    texts += [" ".join(big), " ".join(big[:2900]), " ".join(big[:2000])]
    sets = brute_sets(texts)
    links = [(i, j) for i in range(len(texts)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    want = groups_of(range(len(texts)), links)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for points, shingles in ((4096, 1_000_000), (8, 500)):
        monkeypatch.setattr(ngram_join, "TILE_POINTS", points)
        monkeypatch.setattr(ngram_join, "TILE_SHINGLES", shingles)
        assert {r["id"]: r["component"] for r in ngram_join.ngram_jaccard_join(docs).collect()} == want


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_banded_distance_and_segments():
    random.seed(3)
    lines = []
    for _ in range(60):
        x = [random.choice("abcdé") for _ in range(random.randrange(20, 40))]
        lines.append("".join(x))
        for _ in range(3):
            y = list(x)
            for _ in range(random.randrange(0, 5)):
                k = random.randrange(len(y))
                y[k : k + random.randrange(2)] = random.choice(["", "a", "xy"])
            lines.append("".join(y) or "a")
    size = np.array([len(x) for x in lines])
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
    i, j = np.triu_indices(len(lines), 1)
    for distance in (1, 2, 3):
        near = line_dedup.within(codes, np.cumsum(size) - size, size, i, j, distance)
        true = np.array([levenshtein(lines[a], lines[b]) <= distance for a, b in zip(i, j)])
        assert (near == true).all()
        key, row, role = line_dedup.segment_keys(lines, distance)
        by_key = defaultdict(list)
        for k, r, o in zip(key, row, role):
            by_key[k].append((r, o))
        met = {tuple(sorted((a, b))) for rows in by_key.values() for a, o in rows for b, _ in rows if o and a != b}
        assert {(a, b) for a, b, t in zip(i, j, true) if t and lines[a] != lines[b]} <= met


def test_banded_distance_in_bounded_memory():
    lines = ["a" * 20 + str(i % 7) for i in range(2000)] + ["b" * 20_000, "b" * 19_999]
    size = np.array([len(x) for x in lines])
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
    x = np.r_[np.arange(0, 2000, 2), np.arange(0, 1998, 2), 2000]
    y = np.r_[np.arange(1, 2000, 2), np.arange(2, 2000, 2), 2001]
    tracemalloc.start()
    near = line_dedup.within(codes, np.cumsum(size) - size, size, x, y, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert near.all() and peak < 300e6


def test_line_dedup(spark, monkeypatch):
    random.seed(4)
    pool = [" ".join(random.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(random.randrange(50)) for _ in range(6)) for _ in range(25)]
    rows = []
    for d in range(40):
        lines = [random.choice(pool) for _ in range(4)] + ["short"]
        lines = [x.replace("a", "", 1) if random.random() < 0.3 else x for x in lines] + ["  ".join(random.choice(pool).split())]
        rows.append((d, "\n".join(lines)))
    rows += [(40, None), (41, ""), (42, rows[0][1]), (None, rows[1][1]), (0, rows[0][1])]
    ordered = sorted({(d is None, d or 0, t or "") for d, t in rows})
    at = [(k, n, " ".join(x.split())) for k, (_, _, t) in enumerate(ordered) for n, x in enumerate(t.split("\n")) if len(" ".join(x.split())) >= 20]
    distinct = sorted({x for _, _, x in at})
    links = [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if abs(len(a) - len(b)) <= 2 and levenshtein(a, b) <= 2]
    top, first, gone = groups_of(distinct, links), {}, defaultdict(set)
    for k, n, x in at:
        if first.setdefault(top[x], (k, n)) != (k, n):
            gone[k].add(n)
    want = []
    for d, t in rows:
        k = ordered.index((d is None, d or 0, t or ""))
        want.append(repr((d, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[k]) if gone[k] else t, len(gone[k]))))
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, line long")
    for tile in (1_000_000, 200):
        monkeypatch.setattr(line_dedup, "TILE_CHARS", tile)
        got = line_dedup.remove_near_lines(docs).select("doc_id", "line_text", "lines_removed").collect()
        assert sorted(repr(tuple(r)) for r in got) == sorted(want)
    assert line_dedup.remove_near_lines(docs.limit(0)).count() == 0


def test_line_dedup_of_short_lines(spark):
    random.seed(6)
    pool = ["".join(random.choice("abc ") for _ in range(random.randrange(1, 24))) for _ in range(90)] + ["Les.", "Of, edti oner.", "Erheed. Titionly.", "abcabcabcabcabcabca", "abcabcabcabcabcabcab"]
    for _ in range(90):
        x = list(random.choice(pool))
        k = random.randrange(len(x))
        x[k : k + random.randrange(2)] = random.choice(["", "d", "ef"])
        pool.append("".join(x) or "a")
    rows = [(d, "\n".join(random.choice(pool) for _ in range(9))) for d in range(60)] + [(60, "\n \n\n"), (61, "Les.\n\nLes.\nLes")]
    at = [(d, n, " ".join(x.split())) for d, t in rows for n, x in enumerate(t.split("\n")) if x.split()]
    distinct = sorted({x for _, _, x in at})
    most = lambda x: 2 if len(x) >= 20 else 1 if len(x) >= 8 else 0
    links = [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if levenshtein(a, b) <= min(most(a), most(b))]
    assert {min(most(a), most(b)) for a, b in links} == {1, 2}
    top, first, gone = groups_of(distinct, links), {}, defaultdict(set)
    for d, n, x in at:
        if first.setdefault(top[x], (d, n)) != (d, n):
            gone[d].add(n)
    want = {d: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[d]) for d, t in rows}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["line_text"] for r in line_dedup.remove_near_lines(docs, shorter=queries.SHORT_LINES).collect()}
    assert got == want and got[60] == rows[60][1]


def test_bpe_as_the_library(spark, documents, nothing):
    library = Tokenizer.from_file(WORD)
    got = bpe.encode_documents(documents, WORD, digests=True).collect()
    source = documents.collect()
    assert len(got) == len(source)
    want = []
    for r in source:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        raw = np.array(ids, "<u4").tobytes()
        want.append(repr((r["doc_id"], len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), text)))
    assert sorted(repr((r["id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["decoded"])) for r in got) == sorted(want)
    decoded = bpe.decode_documents(bpe.encode_documents(documents, WORD), WORD).collect()
    assert sorted(repr(r["decoded"]) for r in decoded) == sorted(repr(r["decoded"]) for r in got)
    assert bpe.encode_documents(nothing, WORD).count() == 0


def test_bpe_of_odd_characters():
    library, encoder = Tokenizer.from_file(WORD), bpe.Encoder(bpe.load(WORD))
    random.seed(2)
    texts = ["<|ENDOFTEXT|> <|endoftext|>b \x1c<|EndOfText|>", "aaaa aaa", "I'M we'LL 's"]
    texts += ["".join(chr(random.choice([random.randrange(32, 0xD7FF), random.randrange(0x10000, 0x1FFFF), 32, 0x1C, 0x85])) for _ in range(300)) for _ in range(10)]
    for text, (ids, pieces) in zip(texts, encoder.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert encoder.written(pieces).decode() == encoder.decode(ids).decode() == library.decode(want, skip_special_tokens=False)


def test_budgets_and_mixture(spark, documents, nothing):
    supply = spark.createDataFrame([("a", "x", 10), ("a", "y", 100), ("b", "x", 30), ("b", None, 0)], "d string, s string, tokens long")
    leaves = {(r["d"], r["s"]): r["budget"] for r in mixing.leaf_budgets(supply, ["d", "s"], {("a",): 3.0}, 80, 1).collect()}
    # a gets 60: x gives its 10, its sibling takes the other 50
    assert leaves == {("a", "x"): 10.0, ("a", "y"): 50.0, ("b", "x"): 20.0, ("b", None): 0.0}
    leaves = {(r["d"], r["s"]): r["budget"] for r in mixing.leaf_budgets(supply, ["d", "s"], {("b",): 9.0}, 100, 1).collect()}
    # b is used up with 30, so the rest passes to the other branch
    assert leaves[("b", "x")] == 30.0 and leaves[("a", "x")] == 10.0 and leaves[("a", "y")] == 60.0
    got = mixing.mix(documents, queries.source_domain(), {("d0",): 2.0}, 0.5, 2)
    assert got.count() == documents.count()
    taken = got.agg(F.sum(F.col("mix_tokens") * F.col("mix_copies")), F.sum("mix_tokens")).first()
    assert 0 < taken[0] <= 0.5 * taken[1]
    assert mixing.mix(nothing, queries.source_domain()).count() == 0


def test_token_counts(spark, documents, nothing):
    library = Tokenizer.from_file(BYTE)
    source = documents.collect()
    want = sorted(repr((r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids))) for r in source)
    for size, overlap in ((32_768, 512), (700, 128), (300, 70)):
        got = token_counts.count_tokens(documents, BYTE, size=size, overlap=overlap).collect()
        assert sorted(repr(tuple(r)) for r in got) == want
    assert token_counts.count_tokens(nothing, BYTE).count() == 0


def test_token_counter_on_white_space():
    library, counter = Tokenizer.from_file(BYTE), token_counts.Counter(open(BYTE, encoding="utf-8").read())
    random.seed(7)
    for _ in range(300):
        text = "".join(random.choice(" a\n\tb's1.\u00a0\u2003é\x1c ") for _ in range(60))
        for t in (text, re.sub(" +", " ", text), text + "<|endoftext|>" + text):
            lengths, tokens = counter.cut([t])[0]
            assert sum(lengths) == len(t) and sum(tokens) == len(library.encode(t, add_special_tokens=False).ids)


def test_exact_duplicates(spark, documents, nothing):
    source = [(r["doc_id"], re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")) for r in documents.collect()]
    same = defaultdict(list)
    for d, t in source:
        same[t].append(d)
    keep = {t: min((d for d in ds if d is not None), default=None) for t, ds in same.items()}
    want = sorted(repr((d, hashlib.sha256(t.encode()).hexdigest(), keep[t], len(same[t]), d == keep[t])) for d, t in source)
    for capacity in (50_000, 2):
        got = exact_dedup.exact_duplicates(documents, capacity=capacity).select("id", "sha", "keep", "group_size", "kept").collect()
        assert sorted(repr(tuple(r)) for r in got) == want
    assert exact_dedup.exact_duplicates(nothing).count() == 0


def test_directory_doubles(spark):
    crowded = spark.range(300).select(F.shiftleft("id", 50).alias("key"))
    entries = spark.range(4700).select(F.xxhash64("id").alias("key")).union(crowded)
    depth, bucket = exact_dedup.directory(entries, capacity=100)
    cells = entries.select(exact_dedup.cell(depth).alias("c")).groupBy("c").count().collect()
    held = defaultdict(int)
    for r in cells:
        held[bucket[r["c"]]] += r["count"]
    assert sum(held.values()) == 5000 and max(held.values()) <= 100 and len(bucket) == 1 << depth
    assert len(held) < len(bucket)


def test_embeddings(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(60):
        center = rng.standard_normal(16)
        rows += [(center + rng.standard_normal(16) * 0.08).tolist() for _ in range(rng.integers(1, 6))]
    rows += [rows[0], rows[0], None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [1.0, 2.0], [2.0, 4.0], [float("inf")] * 16]
    frame = spark.createDataFrame([(i, v, 1) for i, v in enumerate(rows)] + [(None, rows[1], 0)], "vec_id long, embedding array<double>, rep long")
    good = [i for i, v in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for i in good:
        for j in good:
            if j < i and len(rows[i]) == len(rows[j]):
                a, b = np.array(rows[i]), np.array(rows[j])
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95:
                    links.append((i, j))
    top, count = groups_of(range(len(rows)), links), np.bincount(np.array(links).ravel(), minlength=len(rows))
    want = sorted(repr((i, int(count[i]), top[i], top[i] == i)) for i in range(len(rows))) + [repr((None, 0, None, None))]
    for tile in (2048, 3):
        monkeypatch.setattr(embedding_dedup, "TILE", tile)
        got = embedding_dedup.embedding_duplicates(frame, recall=0.999999)
        assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(want)
    assert embedding_dedup.embedding_duplicates(frame.limit(0)).count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://EXAMPLE.org/es/1?x", "https://a.example.org/en/12#y", "http://org/", "http://myorg/x", "http://x.com/de/1", "http://x.com/fr/", "ftp://x.com", "http://x.net/a\nb?c", "http://x.net/a://b/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, queries.URL_RULES).collect()}
    assert got[0][:3] == got[1][:3] == got[2][:3] == ("", "", None)
    assert got[3] == ("example.org", "/es/1", "example.org/es/", "block")
    assert got[4] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert got[5] == ("org", "/", "org/", "allow") and got[6][2] is None
    assert got[7][2:] == ("com/de/", "block") and got[8][2:] == ("com/fr/", "allow") and got[9][:3] == ("x.com", "", None)
    assert got[10][:2] == ("x.net", "/a\nb") and got[11][:2] == ("x.net", "/a://b/")
    assert url_filter.filter_urls(pages.limit(0), queries.URL_RULES).count() == 0


def test_url_classifier_learns():
    random.seed(1)
    word = lambda letters: "".join(random.choice(letters) for _ in range(6))
    urls = [(f"{word('abcd')}.pills.net" if i % 3 == 0 else f"{word('abcd')}.news.net", f"/{word('xyz')}") for i in range(600)]
    blocked = np.array([i % 3 == 0 for i in range(600)], float)
    weights, bias = url_filter.fit([h for h, _ in urls[:400]], [p for _, p in urls[:400]], blocked[:400], (3, 4, 5), 14)
    feature, row = url_filter._grams([h for h, _ in urls[400:]], [p for _, p in urls[400:]], (3, 4, 5), 14)
    score = np.bincount(row, weights[feature], minlength=200) / np.sqrt(np.bincount(row, minlength=200)) + bias
    assert ((score > 0) == (blocked[400:] == 1)).mean() > 0.97


def test_repeated_spans(spark, documents, nothing):
    a = "One two three four five six. Seven eight nine ten eleven twelve thirteen. Fourteen fifteen sixteen seventeen!"
    rows = [(3, f"Start here now. {a} End."), (1, f"Other words stand first.\n{a}\nLast."), (2, None), (5, ""), (4, f"{a}\n{a}"), (6, "Clean text alone. It stays."), (1, f"Other words stand first.\n{a}\nLast."), (None, a)]
    docs = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, span long")
    got = {(r["id"], r["n_removed"]): r["text"] for r in substring_dedup.remove_repeated_spans(docs).collect()}
    assert got[(1, 0)] == rows[1][1] and got[(3, 3)] == "Start here now. End." and got[(4, 6)] == ""
    assert got[(2, 0)] is None and got[(5, 0)] == "" and got[(6, 0)] == rows[5][1] and got[(None, 3)] == ""
    assert substring_dedup.remove_repeated_spans(documents).count() == documents.count()
    assert substring_dedup.remove_repeated_spans(nothing).count() == 0


def test_repeated_spans_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    seen, want = {}, {}
    for d, t in rows:
        parts = substring_dedup.sentences(t)
        assert "".join(parts) == t
        full = [(i, p.lower().split()) for i, p in enumerate(parts) if p.split()]
        drop = set()
        enough = lambda i, j: j - i >= 2 and sum(len(w) for _, w in full[i:j]) >= 16
        n = len(full)
        runs = {next(((i, j) for j in range(i + 2, n + 1) if enough(i, j)), None) for i in range(n)}
        runs |= {next(((i, j) for i in range(j - 2, -1, -1) if enough(i, j)), None) for j in range(n + 1)}
        for i, j in sorted(runs - {None}):
            key = tuple(tuple(w) for _, w in full[i:j])
            if seen.setdefault(key, (d, i)) != (d, i):
                drop |= set(range(full[i][0], full[j - 1][0] + 1))
        want[d] = "".join(p for i, p in enumerate(parts) if i not in drop) if drop else t
    got = {r["id"]: r["text"] for r in substring_dedup.remove_repeated_spans(docs).collect()}
    assert got == want and any(want[d] != t for d, t in rows)


def test_repeated_spans_of_any_length(spark):
    random.seed(8)
    tail = ["A b c d e f g h i j.", "K l m n o p q r s t.", "U v w x y z a b c d.", "E f g."]
    pool = [" ".join(random.choice("abcdefgh") + str(random.randrange(9)) for _ in range(random.randrange(1, 13))) + "." for _ in range(200)]
    texts = [tail, ["Head."] + tail + ["Foot."]]
    for _ in range(60):
        k = random.randrange(190)
        texts.append(random.sample(pool, 4) + pool[k : k + random.randrange(1, 9)] + random.sample(pool, 2))
    seen, want = {}, {}
    for d, parts in enumerate(texts):
        split, drop = [p.lower().split() for p in parts], set()
        for i in range(len(parts)):
            for j in range(i + 2, len(parts) + 1):
                if sum(map(len, split[i:j])) >= 16 and seen.setdefault(tuple(map(tuple, split[i:j])), (d, i)) != (d, i):
                    drop |= set(range(i, j))
        want[d] = len(drop), "".join(p + " " for i, p in enumerate(parts) if i not in drop)
    docs = spark.createDataFrame([(d, "".join(p + " " for p in parts)) for d, parts in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r["id"]: (r["n_removed"], r["text"]) for r in substring_dedup.remove_repeated_spans(docs).collect()}
    assert got == want and got[1] == (4, "Head. Foot. ")


def test_white_space_is_gone_through_once():
    for text in ("a" + " " * 300_000 + "b", " \t" * 100_000 + "\n", "a.\n \n  b \n\n c? d", "\n\na", "", "İİ. Ab c.\nX"):
        assert "".join(substring_dedup.sentences(text)) == text
    assert substring_dedup.sentences("a. b\n \nc  d!  \n e…f") == ["a. ", "b\n \n", "c  d!  \n ", "e…f"]


def test_cuts_of_long_sentences_follow_the_words(spark):
    random.seed(9)
    made = lambda n: ["".join(random.choice("abcdefghij") for _ in range(5)) for _ in range(n)]
    shared = [made(60) for _ in range(20)]
    rows = [(d, " ".join(made(7 + d) + p + made(5))) for d, p in enumerate(shared)]
    # another beginning, and one word more before and inside of the passage
    rows += [(100 + d, "\t".join(made(18 + 2 * d) + p[:3] + ["new"] + p[3:] + made(9))) for d, p in enumerate(shared)]
    rows += [(200, " ".join(made(2000))), (201, " ".join(["same"] * 100)), (202, " \t x" + "\u00a0y" * 40 + "  ")]
    for _, t in rows:
        parts = substring_dedup.sentences(t)
        assert "".join(parts) == t and max(len(p.split()) for p in parts) <= 24
    got = {r["id"]: r["text"] for r in substring_dedup.remove_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    gone = [len(rows[20 + d][1].split()) - len(got[100 + d].split()) for d in range(20)]
    assert min(gone) >= 16 and sum(gone) / 20 > 35 and all(got[d] == rows[d][1] for d in range(20))
    assert all({*rows[20 + d][1].split()} - {*got[100 + d].split()} <= {*p} for d, p in enumerate(shared))


def test_toxicity(spark, documents, nothing):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.toxicity(docs, labels).filter("held_out").withColumnRenamed("id", "doc_id").join(labels, "doc_id")
    true, found, both = scored.agg(F.sum("toxic"), F.sum("predicted"), F.sum(F.col("toxic") * F.col("predicted"))).first()
    assert both / found > 0.95 and both / true > 0.6
    few = labels.limit(0)
    assert {r["score"] for r in toxicity.toxicity(documents, few).collect()} == {0.5}
    assert toxicity.toxicity(nothing, labels).count() == 0


def similar_groups(texts):
    """Which texts reach each other by links of 5-word shingles at 0.8."""
    sets = brute_sets(texts)
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    return groups_of(range(len(texts)), links)


def line_groups(lines):
    """Which lines reach each other by edits: none below 8 characters, one below 20, two from there on."""
    allowed = lambda n: 0 if n < 8 else 1 if n < 20 else 2
    links = []
    for i in range(len(lines)):
        for j in range(i):
            most = allowed(min(len(lines[i]), len(lines[j])))
            if abs(len(lines[i]) - len(lines[j])) <= most and lines[i] != lines[j] and edits(lines[i], lines[j], most) <= most:
                links.append((i, j))
    return groups_of(range(len(lines)), links)


def edits(a, b, most):
    """Plain edit distance, given up once every entry of a row is above ``most``."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        if min(row) > most:
            return most + 1
    return row[-1]


def pipeline_rows():
    """Documents with copies, near copies, repeated lines, blank texts, null ids and ids that stand twice."""
    random.seed(12)
    word = lambda: "".join(random.choice("abcdefghijklmnop") for _ in range(random.randint(2, 8)))
    line = lambda n: " ".join(word() for _ in range(n))
    rows, bases = [], [[line(random.randint(4, 14)) for _ in range(random.randint(1, 6))] for _ in range(14)]
    for i in range(60):
        lines = list(random.choice(bases)) if i % 3 == 0 else [line(random.randint(1, 14)) for _ in range(random.randint(1, 6))]
        if i % 4 == 0:
            lines[random.randrange(len(lines))] += "x"
        if i % 5 == 0:
            lines.insert(random.randint(0, len(lines)), random.choice(["All rights reserved by us.", "Share this", "- 1 -"]))
        rows.append([i, "\n".join(lines)])
    rows += [[60, "one two three"], [61, "one two three"], [62, " "], [63, ""], [64, None], [None, rows[1][1]], [None, rows[1][1]], [3, rows[4][1]], [3, line(30)], [70, rows[2][1]], [70, rows[2][1]]]
    long = line(60).split()
    for k in range(4):  # similar on one line, yet too many edits for the line stage
        rows.append([80 + k, " ".join(long[:30] + [word() + word()] + long[30:])])
    return [(i, t, random.choice(["en", "de", None]), random.choice(["src0", "src1", "src2", "src5"]), len(t or ""), "kept", 1, 2, 3) for i, t in rows]


def test_pipeline_by_plain_versions_of_its_stages(spark):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, line_text string, mix_copies int, toxicity int, row int"
    rows = pipeline_rows()
    docs = spark.createDataFrame(rows, schema).repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    plain = lambda df: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["text"] is None) for r in df.collect())
    # toxicity: its own model, applied in plain Python to every text
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    weights, bias = toxicity.train(docs, labels.filter(~toxicity.held_out("doc_id")))
    stay = [r for r in rows if 1 / (1 + np.exp(-(bias + sum(weights[k] for k in set(toxicity.features([r[1]])[0].tolist()))))) < 0.7]
    kept = cut_lineage(stages["toxicity"](spark, docs, SF))
    assert kept.columns == docs.columns and sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, stay))

    # line dedup: of the lines that edits connect the first stays; a document that loses all its words goes
    key = {(r["doc_id"], r["text"]): r["k"] for r in kept.select("doc_id", "text", document_key("doc_id", "text").alias("k")).collect()}
    order = sorted({(r[0], r[1]) for r in stay}, key=lambda r: (r[0] is None, r[0] or 0, key[r]))
    lines = [(d, n, " ".join(x.split())) for d in order for n, x in enumerate((d[1] or "").split("\n")) if x.split()]
    group = line_groups(sorted({x for _, _, x in lines}))
    number = {x: group[i] for i, x in enumerate(sorted({x for _, _, x in lines}))}
    first, gone = {}, defaultdict(set)
    for d, n, x in lines:
        if first.setdefault(number[x], (d, n)) != (d, n):
            gone[d].add(n)
    want = []
    for r in stay:
        d = (r[0], r[1])
        text = "\n".join(x for n, x in enumerate(r[1].split("\n")) if n not in gone[d]) if gone[d] else r[1]
        if not gone[d] or text.split():
            want.append((r[0], text, *r[2:4], len(text) if gone[d] else r[4], *r[5:]))
    deduped = cut_lineage(stages["line_dedup"](spark, kept, SF))
    assert deduped.columns == docs.columns and sorted(map(repr, map(tuple, deduped.collect()))) == sorted(map(repr, want))
    assert len(want) < len(stay) and any(gone.values())

    # n-gram join: one row of each group, the smallest by id, text key and place; applied to rows with copies too
    for before in (deduped, kept):
        have = [(r["doc_id"], r["text"]) for r in before.collect()]
        keys = {(r["doc_id"], r["text"]): r["k"] for r in before.select("doc_id", "text", F.xxhash64("text").alias("k")).collect()}
        have.sort(key=lambda r: (r[0] is None, r[0] or 0, keys[r]))
        one_each = [have[i] for i, top in similar_groups([t for _, t in have]).items() if i == top]
        after = cut_lineage(stages["ngram_jaccard_join"](spark, before, SF))
        assert after.columns == docs.columns
        assert plain(after) == sorted((i is None, i or 0, t or "", t is None) for i, t in one_each) and len(one_each) < len(have)

    # mixing: every copy that the mixture asks for, whole rows
    mixed = cut_lineage(stages["source_mixing"](spark, deduped, SF))
    asked = mixing.mix(deduped.drop("mix_copies"), queries.source_domain(), queries.MIX_WEIGHTS, corpus_pipeline.MIX_SHARE, corpus_pipeline.MIX_EPOCHS, corpus_pipeline.MIX_SEED)
    want = sorted(repr((r["doc_id"], r["text"], r["n_chars"])) for r in asked.collect() for _ in range(r["mix_copies"]))
    assert mixed.columns == docs.columns and sorted(repr((r["doc_id"], r["text"], r["n_chars"])) for r in mixed.collect()) == want

    # ids and text of the library
    library = Tokenizer.from_file(WORD)
    encoded = stages["bpe"](spark, mixed, SF)
    want = []
    for r in mixed.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append(repr((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())))
    assert sorted(repr((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])) for r in encoded.collect()) == sorted(want)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, at = docs, []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF)
        if name != "bpe":
            assert after.columns == docs.columns and after.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
            after = spark.createDataFrame(after.collect(), docs.schema)
        at.append((name, after.count()))
        if name == "source_mixing":
            mixed = after
        before = after
    counts = dict(at)
    assert counts["toxicity"] <= 200 and counts["line_dedup"] <= counts["toxicity"] and counts["ngram_jaccard_join"] <= counts["line_dedup"]
    library = Tokenizer.from_file(WORD)
    assert counts["bpe"] == counts["source_mixing"] == corpus_pipeline.run(spark, SF).count()
    source = {r["doc_id"]: len(library.encode(r["text"], add_special_tokens=False).ids) for r in mixed.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in before.collect()} == source
