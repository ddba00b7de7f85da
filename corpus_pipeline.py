"""Corpus pipeline: language ID, line dedup, n-gram Jaccard join, mixing, byte-level BPE.

Each stage takes what its predecessor kept, written as Parquet and read again, and all but the last return the columns of
documents. Null and repeated document ids, null texts and empty tables are dealt with as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm import bpe, langid, lines, mixing, ngram_join
from linkmill.llm.common import materialise, small, text_batches

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, lang set to it; those judged `und` go."""
    text_batches(spark)
    out = langid.identify(docs, langid.fit(docs))
    return out.where(F.col("_lang_pred") != langid.UND).withColumn("lang", F.col("_lang_pred")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share; those of which nothing is left go."""
    out = lines.dedup_lines(docs).where((F.col("_n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id (null last); of repeated rows one.

    Documents are told by their id and 128 bits of their text, so that those with a null id or with one id and different texts are
    judged each for itself; those of one id or text are told by the order of their texts' hashes. Only rows that repeat or are in a
    group are looked for; the others stay where they lie.
    """
    text_batches(spark)
    k1, k2 = ngram_join.text_keys("text")
    keyed = docs.select(*COLUMNS, k1.alias("_k1"), k2.alias("_k2"))
    who = keyed.groupBy("doc_id", "_k1", "_k2").agg(F.count("*").alias("n"))
    who = materialise(who, "documents")
    shared = ngram_join.shared_components(docs)
    # a group is one text of several ids, too
    copies = who.groupBy("_k1", "_k2").agg(F.count("*").alias("ids")).where("ids > 1")
    groups = shared.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "component").join(copies, ["_k1", "_k2"], "full")
    groups = small(materialise(groups.select("_k1", "_k2", "component", F.when(F.col("component").isNull(), F.struct("_k1", "_k2")).alias("text")), "groups"))
    blank = docs.where(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))).select(k1.alias("_k1"), k2.alias("_k2")).distinct()
    groups = groups.join(blank, ["_k1", "_k2"], "left_anti")  # texts without words are nobody's copies
    named = who.join(groups, ["_k1", "_k2"]).select("component", "text", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_k1", "_k2").alias("who"))
    named = materialise(named, "named")
    first = small(materialise(named.groupBy("component", "text").agg(F.min("who").alias("first")), "first"))
    same = named["component"].eqNullSafe(first["component"]) & named["text"].eqNullSafe(first["text"])
    removed = named.join(first, same).where(~F.col("who").eqNullSafe(F.col("first"))).select("who.doc_id", "who._k1", "who._k2")
    marks = removed.withColumn("_gone", F.lit(True)).unionByName(who.where("n > 1").join(removed, [who[c].eqNullSafe(removed[c]) for c in ("doc_id", "_k1", "_k2")], "left_anti").select("doc_id", "_k1", "_k2", F.lit(False).alias("_gone")))
    marks = small(materialise(marks, "marks"))
    told = keyed.join(marks, [keyed[c].eqNullSafe(marks[c]) for c in ("doc_id", "_k1", "_k2")], "left").select(keyed["*"], "_gone")
    once = told.where("_gone IS NULL").select(*COLUMNS)
    return once.unionByName(told.where("NOT _gone").dropDuplicates(["doc_id", "_k1", "_k2"]).select(*COLUMNS))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it takes it."""
    mixed = mixing.mix(docs, keep=COLUMNS).where("copies > 0").select(F.col("_row"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return mixed.select("_row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and digests of the ids and of the bytes that they decode to."""
    import public_tokenizers

    text_batches(spark)
    out = bpe.encode_decode(docs.select("doc_id", "source", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=False)
    return out.selectExpr("doc_id", "source", "_n_tokens AS n_tokens", "_ids_sha256 AS ids_sha256", "_decoded_sha256 AS decoded_sha256")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing_sources),
    ("byte_bpe", tokenize),
]
#: The first and last stages can't be told in SQL; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
