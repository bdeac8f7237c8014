"""One query per text operator, over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialspark.llm import (
    bpe,
    centroid_clustering,
    embedding_dedup,
    exact_dedup,
    line_dedup,
    mixing,
    ngram_join,
    packed_ids,
    periodic_runs,
    substring_dedup,
    token_counts,
    toxicity,
    url_filter,
)
from trialspark.llm.common import SPACES

#: Rules of the url query: verdict, host, path.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: Target weights of the mixing query by domain, then language, then source; others weigh 1.
MIX_WEIGHTS = {
    ("d0",): 4.0,
    ("d1",): 3.0,
    ("d2",): 2.0,
    ("d0", "en"): 3.0,
    ("d1", "en"): 2.0,
    ("d1", "de"): 2.0,
    ("d0", "en", "src0"): 2.0,
}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.5, 2, 7
#: Edits that lines under 20 characters may differ by: from 8 characters on one, below that none.
SHORT_LINES = ((1, 0), (8, 1))
#: A document above this many tokens is over the limit.
TOKEN_LIMIT = 1024
#: Centroids and rounds of the clustering query, components of its vectors, their scale and the seed of the first centroids.
CLUSTERS, CLUSTER_ROUNDS, CLUSTER_DIMS, CLUSTER_SCALE, CLUSTER_SEED = 40, 5, 64, 256, 2
#: Words and periods that a run has at least.
RUN_WORDS, RUN_PERIODS = 24, 3


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file on the driver."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def source_domain(source: str = "source") -> Column:
    """Domain of a source: its number modulo 4."""
    number = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), "([0-9]{1,9})$", 1)
    return F.when(number == "", F.lit("other")).otherwise(F.concat(F.lit("d"), (number.cast("long") % 4).cast("string")))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join.ngram_jaccard_join(_table(spark, sf_dir, "documents"), words=5, least=80)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_near_lines(_table(spark, sf_dir, "documents"), distance=2, shortest=20, shorter=SHORT_LINES)
    return out.select("doc_id", "line_count", "lines_removed", F.col("line_text").alias("text"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_documents(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), ids=False, digests=True)
    return out.withColumnRenamed("id", "doc_id")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(_table(spark, sf_dir, "documents"), source_domain(), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return out.select("doc_id", F.col("mix_domain").alias("domain"), "lang", "source", F.col("mix_tokens").alias("n_tokens"), F.col("mix_copies").alias("copies"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts.count_tokens(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.col("keep").alias("keep_id"), "group_size", "kept", F.col("sha").alias("text_sha256"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = embedding_dedup.embedding_duplicates(_table(spark, sf_dir, "embeddings"), least=0.95)
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filter.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)
    return out.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "score")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeated_spans(_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_sentences", "n_removed", "text")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.withColumnRenamed("id", "doc_id")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = centroid_clustering.centroid_clusters(_table(spark, sf_dir, "embeddings"), CLUSTERS, CLUSTER_ROUNDS, CLUSTER_DIMS, CLUSTER_SCALE, CLUSTER_SEED)
    digest = F.sha2(F.array_join("centroid", ","), 256)
    return out.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def op12_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    files = packed_ids.write_ids(docs, vocabulary("byte_bpe_50k.json"), end=0)
    return packed_ids.read_ids(files, dict(docs.dtypes)["doc_id"], ids=False, digests=True).withColumnRenamed("id", "doc_id")


def with_planted_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts of a tenth of the documents, chosen by a checksum of the id, repeat a stretch of their words up to their end."""
    h = F.crc32(F.col(id_col).cast("string"))
    g = F.floor(h / 10).cast("long")

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (3 + g % 8))).cast("int")
        copies = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a), F.slice(copies, F.lit(1), n - a)), " ")

    words = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), SPACES), lambda x: x != "")
    changed = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))[0]
    return docs.withColumn(text_col, F.when(h % 10 == 0, changed).otherwise(F.col(text_col)))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_periods(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    out = periodic_runs.periodic_runs(docs, RUN_WORDS, RUN_PERIODS)

    def before(x: Column, y: Column) -> Column:
        """Greatest length over period first, compared exactly, then start, then period."""
        order = ((y.length * x.period, x.length * y.period), (x.start, y.start), (x.period, y.period))
        step = F.lit(0)
        for small, large in reversed(order):
            step = F.when(small < large, -1).when(small > large, 1).otherwise(step)
        return step

    line = lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return out.withColumn("best", F.get(F.array_sort("runs", before), F.lit(0))).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_line_dedup,
        op3_bpe,
        op4_source_mixing,
        op5_token_counts,
        op6_exact_dedup,
        op7_embedding_dedup,
        op8_url_filter,
        op9_substring_dedup,
        op10_toxicity,
        op11_centroid_clustering,
        op12_packed_ids,
        op13_periodic_runs,
    )
}

_JACCARD_SQL = """
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM worded
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM sets LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = doc_id
"""

_EXACT_SQL = """
WITH norm AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM norm GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM norm JOIN g USING (t)
"""

_EMBEDDING_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), normed AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM good),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM normed a JOIN normed b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.95
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), c AS (SELECT a, min(b) AS m FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""


def _mix_sql() -> str:
    levels = ("domain", "lang", "source")

    def weight(depth: int) -> str:
        cases = "".join(
            " WHEN " + " AND ".join(f"{c} = '{v}'" for c, v in zip(levels, path)) + f" THEN {w}" for path, w in MIX_WEIGHTS.items() if len(path) == depth
        )
        return f"CASE{cases} ELSE 1.0 END" if cases else "1.0"

    ctes = [
        """rows_ AS (SELECT doc_id, text, lang, source,
  CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) = '' THEN 'other'
    ELSE 'd' || (CAST(regexp_extract(source, '([0-9]{1,9})$', 1) AS BIGINT) % 4) END AS domain,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents)""",
        f"""leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, count(*) AS n_rows,
  CAST(sum(n_tokens) AS DOUBLE) * {MIX_EPOCHS} AS able FROM rows_ GROUP BY ALL)""",
        f"given0 AS (SELECT least(sum(able), {MIX_SHARE} * sum(tokens)) AS given FROM leaves)",
    ]
    for depth in range(1, 4):
        path, parent = levels[:depth], levels[: depth - 1]
        cols, join = ", ".join(path), f"JOIN given{depth - 1} USING ({', '.join(parent)})" if parent else "CROSS JOIN given0"
        family = f"PARTITION BY {', '.join(parent)}" if parent else ""
        ctes += [
            f"""nodes{depth} AS (SELECT *, able / w AS use FROM (SELECT {cols}, sum(able) AS able, max({weight(depth)}) AS w FROM leaves GROUP BY {cols}) {join})""",
            f"""levels{depth} AS (SELECT *, (given - coalesce(sum(able) OVER ({family} ORDER BY use, {cols} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(w) OVER ({family} ORDER BY use, {cols} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS water FROM nodes{depth})""",
            f"""stands{depth} AS (SELECT *, max(CASE WHEN water < use THEN water END) OVER ({family}) AS stands FROM levels{depth})""",
            f"given{depth} AS (SELECT {cols}, CASE WHEN stands IS NULL THEN able ELSE least(able, w * stands) END AS given FROM stands{depth})",
        ]
    ctes += [
        f"""plan AS (SELECT domain, lang, source, tokens, given,
  least(CASE WHEN tokens > 0 THEN CAST(floor(given / tokens) AS INT) ELSE 0 END, {MIX_EPOCHS}) AS whole FROM leaves JOIN given3 USING (domain, lang, source))""",
        f"""ordered AS (SELECT r.doc_id, r.domain, r.lang, r.source, n_tokens, whole, floor(given - whole * tokens) AS rest,
  md5(concat_ws(':', '{MIX_SEED}', CAST(whole AS VARCHAR), CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS o
  FROM rows_ r JOIN plan USING (domain, lang, source))""",
        "run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY o) AS upto FROM ordered)",
    ]
    return "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, domain, lang, source, n_tokens, CAST(whole + CASE WHEN whole < {MIX_EPOCHS} AND upto <= rest THEN 1 ELSE 0 END AS INT) AS copies FROM run"


def _cluster_sql() -> str:
    whole = f"list_transform(embedding, lambda x: CAST(floor({CLUSTER_SCALE} * CAST(x AS DOUBLE)) AS BIGINT))"
    far = "CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    ctes = [
        f"""kept AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS r, {whole} AS v FROM embeddings
  WHERE len(embedding) = {CLUSTER_DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY o) - 1 AS INT) AS cluster, v AS c
  FROM (SELECT v, sha256('{CLUSTER_SEED}:' || vec_id) AS o FROM kept ORDER BY o LIMIT {CLUSTERS}))""",
    ]
    for k in range(CLUSTER_ROUNDS + 1):
        ctes.append(f"""a{k} AS MATERIALIZED (SELECT r, vec_id, v, arg_min(cluster, (far, cluster)) AS cluster, min(far) AS far
  FROM (SELECT r, vec_id, v, cluster, {far} AS far FROM kept CROSS JOIN c{k}) GROUP BY r, vec_id, v)""")
        if k < CLUSTER_ROUNDS:
            ctes.append(f"""m{k} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM (
  SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range({CLUSTER_DIMS})) AS i FROM a{k}) GROUP BY cluster, i) GROUP BY cluster)""")
            ctes.append(f"c{k + 1} AS MATERIALIZED (SELECT cluster, coalesce(m, c) AS c FROM c{k} LEFT JOIN m{k} USING (cluster))")
    last = CLUSTER_ROUNDS
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, cluster, far AS distance, CAST(sum(far) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(far) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} USING (cluster)"""


#: A run repeats all but its last period, 16 words or more: places whose next 8 words stand again one period later, nine at least in a row.
_RUNS_SQL = f"""
WITH h AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: [CAST(ascii(d) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, x: CASE WHEN xor(c, x) & 1 = 1 THEN xor(xor(c, x) >> 1, 3988292384) ELSE xor(c, x) >> 1 END), 4294967295) AS h
  FROM documents
), a AS (SELECT doc_id, w, h, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM h),
p AS (SELECT *, 1 + (len(w) - a) // (3 + (h // 10) % 8) AS p FROM a),
d AS MATERIALIZED (SELECT doc_id, CASE WHEN h % 10 = 0 AND len(w) > 0
  THEN list_transform(range(len(w)), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM p),
grams AS MATERIALIZED (SELECT doc_id, len(w) AS n, i, array_to_string(w[i + 1:i + 8], ' ') AS gram FROM d, unnest(range(len(w) - 7)) AS t(i)),
same AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND y.i > x.i AND {RUN_PERIODS} * (y.i - x.i) <= x.n),
rows_ AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS block FROM same),
long AS (SELECT doc_id, q, min(i) AS start, count(*) + 7 + q AS length FROM rows_ GROUP BY doc_id, q, block
  HAVING count(*) + 7 + q >= greatest({RUN_WORDS}, {RUN_PERIODS} * q)),
runs AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS period FROM long GROUP BY doc_id, start, length),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY doc_id),
best AS (SELECT x.* FROM runs x WHERE NOT EXISTS (SELECT 1 FROM runs y WHERE y.doc_id = x.doc_id AND (y.length * x.period > x.length * y.period
  OR y.length * x.period = x.length * y.period AND (y.start < x.start OR y.start = x.start AND y.period < x.period)))),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
holes AS (SELECT doc_id, list(i) AS holes FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, start, length, period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(array_to_string(CASE WHEN holes IS NULL THEN w ELSE list_transform(list_filter(range(len(w)), lambda i: NOT list_contains(holes, i)), lambda i: w[i + 1]) END, ' ')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN holes USING (doc_id)
"""


SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": _JACCARD_SQL,
    "op4_source_mixing": _mix_sql(),
    "op6_exact_dedup": _EXACT_SQL,
    "op7_embedding_dedup": _EMBEDDING_SQL,
    "op11_centroid_clustering": _cluster_sql(),
    "op13_periodic_runs": _RUNS_SQL,
}
