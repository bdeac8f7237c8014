"""A corpus pipeline of the text operators: each stage takes the documents that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialspark.llm import bpe, line_dedup, mixing, toxicity
from trialspark.llm.common import cut_lineage, free_name, put_aside, with_columns_of
from trialspark.llm.ngram_join import ngram_jaccard_join
from trialspark.llm.queries import MIX_WEIGHTS, SHORT_LINES, source_domain, vocabulary

#: Fixed pattern: a character of a word.
WORD = r"[^\x20\x09-\x0D]"
#: Share of all tokens that the mixture takes, and how often it may repeat a document.
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.9, 2, 7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject; it learns from the labels of the documents at hand."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    weights, bias = toxicity.train(docs, labels.filter(~toxicity.held_out("doc_id")))
    name = free_name(docs, "toxicity")
    scored = toxicity.score(docs, weights, bias, "text", name)
    return with_columns_of(scored.filter(F.col(name) < 0.7), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one up to two edits, short ones one or none; ``n_chars`` follows the text.

    A document that loses all its words to earlier ones is a copy of them and
    goes; one that had none stays as it is.
    """
    held, names = put_aside(docs, "line_", "lines_")
    out = line_dedup.remove_near_lines(held, shorter=SHORT_LINES)
    lost = F.col("lines_removed") > 0
    out = out.filter(~lost | F.col("line_text").rlike(WORD))
    length = F.when(lost, F.length("line_text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    out = out.withColumns({"n_chars": length, "text": F.col("line_text")}).drop("line_count", "lines_removed", "line_text")
    return with_columns_of(out.withColumnsRenamed(names), docs)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of similar ones, and all without words.

    First is the smallest id (null last), then the smallest key of the text, then
    the place in the table: rows are told apart by these, not by their id alone.
    """
    row = free_name(docs, "row")
    place = F.struct(F.col("doc_id").isNull().alias("nil"), "doc_id", F.xxhash64("text").alias("key"), F.monotonically_increasing_id().alias("place"))
    placed = cut_lineage(docs.withColumn(row, place))
    groups = ngram_jaccard_join(placed, id_col=row)
    gone = groups.filter("component < id").select(F.col("id.place").alias("gone"))
    out = placed.join(gone, placed[row]["place"] == gone["gone"], "left_anti")
    return with_columns_of(out, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them: a row for each copy."""
    held, names = put_aside(docs, "mix_")
    mixed = mixing.mix(held, source_domain(), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED).filter("mix_copies > 0")
    copies = mixed.withColumn("mix_copies", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
    return with_columns_of(copies.drop("mix_domain", "mix_tokens", "mix_copies").withColumnsRenamed(names), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with the digest of the text they decode to."""
    out = bpe.encode_documents(docs, vocabulary("word_bpe_49k.json"), ids=False, digests=True)
    return out.withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_similar),
    ("source_mixing", mix_sources),
    ("bpe", encode),
]

#: No SQL: the classifier, the edit join and the vocabulary can't be said in it. The tests hold a brute-force version against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what each keeps is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
