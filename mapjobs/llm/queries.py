"""The queries of the operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from mapjobs.llm import ann, html_text, importance, langid, lm, mixing, pii, repair, simhash, token_counts, tokens, toxicity, winnow
from mapjobs.llm.common import crc_mod
from mapjobs.session import table


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file; also the default for workers, where it is installed alike."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc_mod("doc_id", 5) == 0
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), allowed=~held_out)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 3) == 1
    model = langid.train(docs, vocabulary("piece_bpe_32k.model"), allowed=~held_out)
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


#: The query's key. A user passes their own and keeps it secret.
KEY = b"mapjobs op3 example key"


def op3_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(table(spark, sf_dir, "documents"), KEY).select("doc_id", "text", "n_values")


def op4_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), held_out=crc_mod("doc_id", 5) == 1)


def op5_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = tokens.token_table(table(spark, sf_dir, "documents"), tokenizer=vocabulary("byte_bpe_50k.json"))
    return written.select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(repair.damaged(table(spark, sf_dir, "conversations")))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_langid, op3_feistel_pii, op4_lattice_lm, op5_token_planes, op6_simhash, op7_html_crf, op8_nn_descent, op9_mixing, op10_winnowing, op11_token_counts, op12_repair, op13_importance)}


def oracle_sql() -> dict[str, str]:
    return {"op9_mixing": mixing.SQL, "op10_winnowing": winnow.SQL, "op12_repair": repair.SQL, "op13_importance": importance.SQL}
