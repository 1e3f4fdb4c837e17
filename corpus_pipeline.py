"""The corpus pipeline: toxicity, language ID, near duplicates, mixing, tokens.

Every stage takes (spark, docs, sf_dir), where docs is what the stage before
kept, and works on all of it. Between stages the rows are written as Parquet and
read again.
"""

from __future__ import annotations

import os
import sys
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starfold.llm import bpe, langid, mixing, ngram_join, toxicity  # noqa: E402
from starfold.session import checkpoint_dir, cut  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None       # learned filters have no SQL


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. The model learns from all labels of the documents at hand."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    return _columns(toxicity.score(docs, model, keep=COLUMNS).where("predicted = 0"))


def drop_unknown_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier rejects go: no letter, or too unlikely under its calibration."""
    model = langid.fit(docs)
    return _columns(langid.predict(docs, model, keep=COLUMNS).where("NOT rejected"))


def _row_key() -> Column:
    """Text that sorts as (id, hash of the text) does, rows without an id last; only equal rows share it."""
    ordered = F.lpad(F.hex(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-1 << 63))), 16, "0")
    return F.concat(F.when(F.col("doc_id").isNull(), "1").otherwise(F.concat(F.lit("0"), ordered)), F.lit(" "), F.hex(F.xxhash64("text")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of the n-gram join one row stays: that with the smallest id, or of rows with one id any one.

    Rows are told apart by id and text: several texts under one id are several
    documents, rows without an id take part like others and stay only where
    nothing in their component has an id. Of rows equal in id and text the
    first by language, source and length stays.
    """
    keyed = _columns(docs).withColumn("key", _row_key())
    stay = ngram_join.jaccard_classes(keyed, id_col="key").where("key = component_id").select("key").distinct()
    # copies of one row are folded before the shuffle, so a hot one makes no large task
    rows = keyed.groupBy("key").agg(F.min(F.struct("doc_id", "lang", "source", "n_chars", "text")).alias("row"))
    return _columns(rows.join(cut(stay), "key", "left_semi").select("row.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order; one that a target ends in is cut after its last word."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.col("text").cast("binary"))))
    keyed = _columns(docs).withColumns({"key": key, "words": mixing.word_count(F.col("text"))})
    lined = mixing.line_up(keyed, id_col="key", size=F.col("words"))
    # rows with one key are told apart by size; where that is equal too, any of them will do
    lined = lined.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("size", "place")))
    mixed = mixing.schedule(lined).select("key", F.col("nth").alias("mth"), "size", "round", "taken", "position")
    keyed = keyed.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("words", F.xxhash64("text"))))
    full = keyed.join(cut(mixed), "key").where("nth = mth")
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    text = F.when(F.col("taken") < F.col("size"), F.array_join(F.slice(words, F.lit(1), F.col("taken").cast("int")), " ")).otherwise(F.col("text"))
    full = full.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return _columns(mixing.in_training_order(full, "key"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every row as 32-bit little-endian integers."""
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), out="ids")
    return coded.select("doc_id", "lang", "source", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [("toxicity", drop_toxic), ("language_id", drop_unknown_languages), ("ngram_jaccard_join", drop_near_duplicates),
          ("source_mixing", mix_sources), ("bpe_encoding", encode_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over all of ``documents``."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, rows, sf_dir).write.parquet(f"{folder}/{name}")
        rows = spark.read.parquet(f"{folder}/{name}")
    return rows
