"""File manifests and their comparison."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F


#: Files of more bytes are read in pieces: Spark's reader of whole files ends at 2 GB.
WHOLE = 256 << 20


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Checksums of files (uri) that are read in pieces of 8 MB."""
    for b in batches:
        for uri in b.column("uri").to_pylist():
            # Spark gives names as they are, not escaped
            local = re.match("file:/+(.*)", uri, re.DOTALL)
            store, path = (fs.LocalFileSystem(), "/" + local[1]) if local else fs.FileSystem.from_uri(quote(uri, safe=":/@"))
            found = hashlib.md5()
            with store.open_input_stream(path) as f:
                while piece := f.read(8 << 20):
                    found.update(piece)
            yield pa.RecordBatch.from_pydict({"uri": [uri], "md5": [found.hexdigest()]})


def read_manifest(spark: SparkSession, folder: str, whole: int = WHOLE) -> DataFrame:
    """(path, size, md5) of the files under a folder; path is relative to it. Files above ``whole`` bytes are streamed, each in one task, by Arrow's file systems (local, HDFS, S3)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    clean = lambda c: F.regexp_replace(c, "^[a-z]+:/+", "/")
    path = F.substring(clean(F.col("uri")), F.length(F.concat(F.regexp_replace(clean(F.lit(folder)), "/+$", ""), F.lit("/"))) + 1, F.lit(1 << 30))
    # the condition on the length is told to the reader, which then leaves large files' content alone
    small = files.where(F.col("length") <= whole).select(F.col("path").alias("uri"), F.col("length").alias("size"), F.md5("content").alias("md5"))
    large = files.where(F.col("length") > whole).select(F.col("path").alias("uri"), F.col("length").alias("size"))
    sums = large.select("uri").repartition("uri").mapInArrow(_streamed, "uri string, md5 string")
    return small.unionByName(large.join(sums, "uri")).select(path.alias("path"), "size", "md5")


def compare(source: DataFrame, copy: DataFrame) -> DataFrame:
    """(path, status) of two manifests: ok, missing, wrong size, wrong content, extra. Sizes decide before checksums."""
    c = copy.select("path", F.col("size").alias("csize"), F.col("md5").alias("cmd5"))
    j = source.withColumn("here", F.lit(True)).join(c.withColumn("there", F.lit(True)), "path", "full_outer")
    status = F.when(F.col("here").isNull(), "extra").when(F.col("there").isNull(), "missing").when(F.col("size") != F.col("csize"), "wrong size").when(F.col("md5") != F.col("cmd5"), "wrong content").otherwise("ok")
    return j.select("path", status.alias("status"))


def outcome(compared: DataFrame) -> DataFrame:
    """A10: (status, n)."""
    return compared.groupBy("status").agg(F.count("*").alias("n"))


def report(compared: DataFrame, most: int = 20) -> DataFrame:
    """T4: (status, path, rest): the first ``most`` paths of each status and how many more it has. The counts are partial sums; the ranks are limited before the shuffle."""
    first = compared.withColumn("r", F.row_number().over(W.partitionBy("status").orderBy("path"))).where(F.col("r") <= most)
    n = outcome(compared)
    return first.join(n, "status").select("status", "path", F.greatest(F.col("n") - most, F.lit(0)).alias("rest"))


def to_repair(compared: DataFrame) -> DataFrame:
    """U4: paths to copy again."""
    return compared.where(F.col("status").isin("missing", "wrong size", "wrong content")).select("path")


def extra(source: DataFrame, copy: DataFrame) -> DataFrame:
    """U4: paths of the copy that the source does not have."""
    return copy.join(source, "path", "left_anti").select("path")
