"""A training-data pipeline over ``documents``: each stage works on all that its predecessor kept.

Stages but the last return the columns of ``documents``; a stage's decision takes effect by the rows that it leaves out or
repeats. Each result is written as Parquet into the shared folder and reread, so a stage never recomputes
the ones before it and lost executors cost no more than their tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from mapjobs.llm import langid, mixing, simhash, tokens, winnow
from mapjobs.llm.common import crc_mod
from mapjobs.llm.queries import vocabulary
from mapjobs.session import shared_dir, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: null texts, those without letters and those with a score under 0.5 go; a score of exactly 0.5 stays.

    Row-wise once the model is fitted, so repeated rows and ids are judged alike. Without any labelled row nothing is recognised.
    """
    model = langid.train(docs, vocabulary("piece_bpe_32k.model"), allowed=crc_mod("doc_id", 3) != 1)
    return langid.keep_known(docs, model)


def keyed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): every row of docs whole, under a key of its own.

    The key, called doc_id as the operators want it, orders rows by id (null last) and tells rows of one id apart by 128 bits of hash over all their
    columns; rows that share it are equal. The columns of docs travel inside ``row``, so none of their names can clash.
    """
    columns = [c for c, kind in docs.dtypes if "map<" not in kind]  # maps cannot be hashed
    of_row = [F.xxhash64(F.lit(seed), *columns) for seed in (1, 2)]
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), of_row[0].alias("a"), of_row[1].alias("b"))
    return docs.select(F.struct("*").alias("row"), key.alias("doc_id"), "text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: the one with the smallest doc_id, of rows that share it one of any text.

    Null and word-less texts are near duplicates of each other (fingerprint zero); a row without an id stays only where no member has one. Rows of one
    doc_id in different groups are judged apart, and equal rows are one.
    """
    d = keyed(docs)
    found = simhash.near_duplicates(d.select("doc_id", "text"))
    keep = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    return d.select("doc_id", "row").join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select("row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of whose words less than 5 % lie in passages of the benchmark. Each row is judged by its own text, whatever ids repeat;
    null and word-less texts stay."""
    d = keyed(docs)
    judged = winnow.contamination(d.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return d.select("doc_id", "row").join(judged.where("contaminated").select("doc_id").distinct(), "doc_id", "left_anti").select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them; a repeated document is as many rows.

    How often depends on doc_id and source alone, so rows that share both are taken alike. Null ids and sources take part like any other;
    texts without words add nothing to their source and go with their hash.
    """
    times = mixing.mix(docs.select("doc_id", "text", "source")).where("repeats > 0").select(F.col("doc_id").alias("i"), F.col("source").alias("s"), "repeats").distinct()
    d = docs.select(F.struct("*").alias("row"), "doc_id", "source")
    d = d.join(times, F.col("doc_id").eqNullSafe(F.col("i")) & F.col("source").eqNullSafe(F.col("s")))
    return d.select("row", F.explode(F.sequence(F.lit(1), "repeats"))).select("row.*")


def token_planes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in the file format, read back: doc_id, start, n_tokens, ids_crc32 of each row."""
    written = tokens.token_table(docs, tokenizer=vocabulary("byte_bpe_50k.json"))
    return written.select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("langid", known_language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("mix", mixed),
    ("tokens", token_planes),
]

#: SQL has neither the tokenizer nor the language model; the tests check the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
