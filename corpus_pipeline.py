"""Corpus pipeline: documents to packed sequences, one operator per stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet to the shared folder and reads it again for the next.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.common import materialize, words
from faresight.llm.jaccard_join import jaccard_components
from faresight.llm.line_spread import remove_boilerplate
from faresight.llm.mixing import MAX_EPOCHS, mix_sources
from faresight.llm.packing import pack_documents
from faresight.llm.quality import quality_rules
from faresight.llm.tokens import vocabulary_path
from faresight.sources.tables import read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Words per block of the mix: most documents are taken whole.
MIX_BLOCK_WORDS = 256
#: Words per shingle and similarity in percent from which two documents are near copies.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _versioned(docs: DataFrame) -> DataFrame:
    """``docs`` with a hash of the text, which tells rows with equal ids apart."""
    return docs.withColumn("_version", F.xxhash64(F.coalesce("text", F.lit(""))))


def _same_row(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["_version"] == right["_version"])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep.

    Equal rows share a verdict.  Null and blank texts have no words and are
    rejected by the base rule; an empty table gives an empty result.
    """
    docs = _versioned(docs.select(COLUMNS))
    verdict = quality_rules(docs, read_table(spark, sf_dir, "labels"), carry=["_version"])
    rejected = verdict.filter("NOT kept").select("doc_id", "_version").distinct()
    return docs.join(rejected, _same_row(docs, rejected), "left_anti").select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines; those that held nothing else go.

    Repeated rows are rows of their own, null texts stay as they are; an empty
    table gives an empty result.
    """
    out = remove_boilerplate(docs.select(COLUMNS))
    return (out.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
            .withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars"))
                        .otherwise(F.char_length("text").cast("long"))).select(COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts: the smallest id, of equal ids the smallest text hash.

    Rows are linked by a key of id and text, so that rows with equal ids and different texts are judged
    each by its own links; exact copies of a row are one.
    """
    docs = _versioned(docs.select(COLUMNS))
    row = F.struct("text", "lang", "source", "n_chars")
    known = docs.filter("doc_id IS NOT NULL").withColumn("_key", F.xxhash64("doc_id", "_version"))
    groups = jaccard_components(known, id_col="_key", size=NEAR_WORDS, percent=NEAR_PERCENT)
    groups = groups.select(F.col("doc_id").alias("_key"), "component_id").distinct()
    heads = (known.select("doc_id", "_version", "_key").join(groups, "_key").groupBy("component_id")
             .agg(F.min(F.struct("doc_id", "_version")).alias("h")).select("h.*"))
    kept = known.join(heads, _same_row(known, heads), "left_semi").groupBy("doc_id", "_version").agg(F.min(row).alias("r"))
    unnamed = docs.filter("doc_id IS NULL").groupBy("doc_id", "_version").agg(F.min(row).alias("r"))
    return kept.unionByName(unnamed).select("doc_id", "r.*").select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: a row per epoch in which any of it is taken.

    A document that an epoch takes whole keeps its text; of others the taken
    words are kept in order, joined by one space.

    Repeated rows are mixed each for itself: what is taken of every copy is
    joined to the one text they share, so m equal rows give at most 2 m rows.
    Null and blank texts hold no words and go; a null source is a source of its
    own; an empty table gives an empty result.
    """
    # fields that are null are left out of the JSON by name, so rows that differ only in which field is null differ here
    content = F.struct("doc_id", "lang", "source", "n_chars", F.xxhash64("text").alias("text"), F.char_length("text").alias("size"))
    docs = docs.select(COLUMNS).withColumn("_row", F.xxhash64(F.to_json(content)))
    mixed = (mix_sources(docs, block_words=MIX_BLOCK_WORDS, carry=["_row"]).filter("taken > 0")
             .select("_row", "size", "picks"))
    # written: a plain exchange on both sides lets a row of very many copies be split
    texts = materialize(docs.dropDuplicates(["_row"]), "mix-texts")
    joined = texts.join(mixed, "_row").select(*COLUMNS, "size", "picks")
    taken = (joined.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(MAX_EPOCHS - 1))))
             .withColumn("picks", F.expr("filter(picks, p -> p.epoch = epoch)"))
             .withColumn("taken", F.expr("aggregate(picks, 0L, (n, p) -> n + p.length)")).filter("taken > 0")
             .withColumn("words", F.when(F.col("taken") < F.col("size"), words(F.col("text")))))
    part = F.array_join(F.flatten(F.transform(
        "picks", lambda p: F.slice("words", (p["start"] + 1).cast("int"), p["length"].cast("int")))), " ")
    whole = F.col("words").isNull()
    return (taken.withColumn("text", F.when(whole, F.col("text")).otherwise(part))
            .withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.char_length("text").cast("long")))
            .select(COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix in windows of 2048 tokens at the mix's proportions."""
    return pack_documents(docs, vocabulary_path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL cannot express the tokenizer of the last stage; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{i + 1}")
    return docs
