"""Pipeline from raw documents to packed sequences, stage by stage.

Each stage works on all rows that the one before kept, and its decisions take
effect: documents that the quality classifier or the language identification
rejects go, one document of each near-duplicate group stays, and what is left is
packed. Null and empty texts, repeated rows, empty tables and extra columns are
handled as the operators say. Near duplicates are judged by id and text: of
several different texts under one id each is a document of its own, as are
different texts without an id; rows equal in both stay once.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from homematch.llm import language_id, near_dedup, packing, quality_net, sharding
from homematch.session import saved

#: Languages below this probability are taken as not recognised.
LEAST_LANGUAGE_SCORE = 0.4


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, learned from ``labels``, scores at its threshold or above."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = quality_net.scorer(docs, quality_net.train(docs, labels, "doc_id", "text", "quality", 4, 2))
    return docs.where(score(docs["text"]) >= quality_net.THRESHOLD)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language."""
    predict = language_id.predictor(docs, language_id.train(language_id.training_rows(docs, "doc_id", "text", "lang", 3, 1)))
    found = predict(docs["text"])
    return docs.where((found["lang_pred"] != language_id.UNKNOWN) & (found["score"] >= LEAST_LANGUAGE_SCORE))


def unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def keyed(docs: DataFrame, key: str) -> DataFrame:
    """Documents with a number of their own in column ``key``.

    It is the doc_id where all rows of an id have one text. Other rows, and
    those without an id, are told apart by their text too and numbered above all
    ids, in the order of id and text; equal rows share a number.
    """
    one, low, high, number = (unused(docs, name) for name in ("row_id", "text_low", "text_high", "row_place"))
    text, own = F.coalesce("text", F.lit("")), docs["doc_id"].cast("bigint")
    marks = F.xxhash64(text), F.xxhash64(F.lit(1), text)
    ids = docs.select(own.alias(one), marks[0].alias(low)).groupBy(one).agg(F.min(low).alias("least"), F.max(low).alias("most"))
    shared = saved(ids.where(F.col(one).isNull() | (F.col("least") != F.col("most"))).select(one), "shared-ids")
    if shared.isEmpty():
        return docs.withColumn(key, own)
    highest = docs.agg(F.coalesce(F.max(own), F.lit(0)).alias("top")).scalar()
    same = own.eqNullSafe(F.col(one))
    several = docs.join(shared, same, "left_semi").select(own.alias(one), marks[0].alias(low), marks[1].alias(high)).distinct()
    places, _ = sharding.numbered(several)
    places = saved(places.select(one, low, high, (highest + 1 + F.col("row_number")).alias(number)), "row-numbers")
    found = same & (marks[0] == F.col(low)) & (marks[1] == F.col(high))
    return docs.join(places, found, "left").select(*docs.columns, F.coalesce(number, own).alias(key))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles: the one with the smallest id."""
    key = unused(docs, "row_key")
    rows = keyed(docs, key)
    judged = near_dedup.near_duplicates(rows, width=5, key=key)
    gone = judged.where("NOT kept").select(F.col("doc_id").alias(key)).distinct()
    left = rows.join(gone, key, "left_anti")
    twice = saved(rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key), "repeated")
    once = left.join(twice, key, "left_semi").dropDuplicates([key])
    return left.join(twice, key, "left_anti").unionByName(once).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents left, in sequences of at most 1024 tokens."""
    pieces = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_dedup", without_near_duplicates),
    ("packing", packed),
]

#: The first two stages are learned models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
