"""Token counts (operator 11): a digest cache, so that a text is encoded once for each tokenizer, whatever the number of its copies and runs."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mapjobs.llm.common import held, slices, texts
from mapjobs.llm.tokens import Encoder
from mapjobs.session import cut, shared_dir

CACHE = "version string, digest binary, n_tokens long"
#: Digests that a task remembers, so that rows that repeat id and text are encoded once.
RECENT = 1 << 18


def normalised(text: Column) -> Column:
    """What is digested and encoded: null counts as the empty text, everything else stays as it is, as any other change could change a count."""
    return F.coalesce(text, F.lit(""))


def version_of(tokenizer: str) -> str:
    """A digest of the tokenizer file, its library and the library's version: counts of another file or release are never taken."""
    import sentencepiece
    import tokenizers

    library = sentencepiece if tokenizer.endswith(".model") else tokenizers
    state = hashlib.sha256(f"{library.__name__} {library.__version__} ".encode())
    with open(tokenizer, "rb") as file:
        for block in iter(lambda: file.read(1 << 20), b""):
            state.update(block)
    return state.hexdigest()


def counter_of(tokenizer: str) -> Callable[[list[str]], list[int]]:
    """Counts of the tokens of texts, by the tokenizers library (.json) or by sentencepiece (.model).

    No begin, end or other added tokens, no truncation, no padding; strings of special tokens inside a text are treated as the library does
    by default. A byte-level BPE without normalizer, whose pre-tokenizer is the usual one, goes through ``tokens.Encoder``, which
    gives the library's ids and remembers pieces of text.
    """
    if tokenizer.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=tokenizer)
        return lambda batch: [len(ids) for ids in model.encode(batch, num_threads=1)]
    with open(tokenizer, encoding="utf-8") as file:
        spec = json.load(file)
    split = spec.get("pre_tokenizer") or {}
    if spec["model"].get("type") == "BPE" and not spec.get("normalizer") and split.get("type") == "ByteLevel" and not split.get("add_prefix_space", True) and split.get("use_regex", True):
        encoder = Encoder(tokenizer, 0)
        encoder.tokenizer.no_truncation(), encoder.tokenizer.no_padding()
        return lambda batch: [len(ids) // 4 - 1 for ids in encoder.encode(batch)]  # the encoder adds an end
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer)
    library.no_truncation(), library.no_padding()
    # one text at a time: the library then uses no threads of its own, and holds the tokens of one text
    return lambda batch: [len(library.encode(t, add_special_tokens=False)) for t in batch]


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version in the cache, one row a digest; a cache that was never written is empty.

    Two jobs that append at the same time may write a digest twice; the counts are equal."""
    try:
        rows = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE)
    return rows.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def encoded(rows: DataFrame, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of rows (digest, text). A task holds a few MB of texts at once, or one longer text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, seen = held(("counts", tokenizer), lambda: counter_of(tokenizer)), set()
        for batch in slices(batches, most=2 << 20):
            digests = batch.column("digest").to_pylist()
            new = {}
            for i, d in enumerate(digests):
                if d not in seen:
                    new.setdefault(d, i)
            seen = seen if len(seen) < RECENT else set()
            seen.update(new)
            part = batch.take(pa.array(new.values(), pa.int64()))
            counts = count([t.decode("utf-8", "replace") for t in texts(part)])
            yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return rows.select("digest", "text").mapInArrow(run, "digest binary, n_tokens long")


def count_tokens(docs: DataFrame, tokenizer: str, *, cache: str | None = None, limit: int = 512, few: float = 0.02, broadcast_misses: int = 500_000) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of docs (doc_id, text).

    cache: folder of a Parquet table (version, digest, n_tokens) that all executors reach; a new one in the shared folder unless given.
    The digests of the texts are joined to the counts that the cache has for this tokenizer's version. Of each digest that it
    lacks, one row (the smallest doc_id) is encoded, and the counts are appended by Spark's committer, so a lost task leaves nothing behind. Then every row's
    count comes from the cache.

    Texts move only to be encoded, by digest and doc_id, so the copies of one text do not meet in one task, and only the chosen row of each passes. Rows are streamed
    past the digests, never sorted. Where the cache knows nearly all texts (misses are a share of ``few`` of the rows, and ``broadcast_misses`` at most), the texts stay where they are and the
    digests are sent to them instead, some 50 bytes each. The last join is plain, and can be split at a digest that many rows share.

    Null text is the empty text: 0 bytes, 0 tokens. A null doc_id stays null, and may be chosen like any other. Rows that repeat id
    and text come back repeated, and are encoded once by each task that has them. An
    empty table gives no rows and appends nothing. Texts of any length are encoded whole. Other columns are ignored.
    """
    spark, version = docs.sparkSession, version_of(tokenizer)
    cache = cache or f"{shared_dir(spark)}/counts-{uuid.uuid4().hex}"
    d = docs.select("doc_id", normalised(F.col("text")).alias("text")).withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    keyed = cut(d.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")))
    misses = keyed.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).join(stored_counts(spark, cache, version), "digest", "left_anti")
    misses = cut(misses.select(F.col("digest").alias("miss"), F.col("doc_id").alias("chosen")))
    n = misses.count()
    if n:
        side = F.broadcast(misses) if n <= min(broadcast_misses, few * keyed.count()) else misses.hint("shuffle_hash")
        wanted = d.join(side, (F.col("digest") == F.col("miss")) & F.col("doc_id").eqNullSafe(F.col("chosen")), "left_semi")
        new = encoded(wanted, tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
        new.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache)
    counts = stored_counts(spark, cache, version)
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
