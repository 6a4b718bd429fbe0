"""Resampling towards a target distribution (operator 13): hashed n-grams, importance weights, Gumbel top-k."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from mapjobs.llm.common import release, slices, texts
from mapjobs.operators.address import running_before
from mapjobs.session import cut

#: Lower-cases A-Z and makes a blank of every ASCII character but letters and digits; bytes of longer UTF-8 characters stay.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Different hashes that a task counts before they are folded into buckets.
MOST_KEYS = 1 << 18


def pieces(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, in lists from about ``size`` bytes each: a long text never lies in memory as words all at once."""
    at = 0
    while at < len(text):
        part = text[at:at + size].translate(TABLE)
        at += len(part)
        if at < len(text) and part[-1] != 32:  # a word goes on
            more = []
            while at < len(text):
                rest = text[at:at + 256].translate(TABLE)
                end = rest.find(b" ")
                more.append(rest if end < 0 else rest[:end])
                at += len(more[-1])
                if end >= 0:
                    break
            part += b"".join(more)
        yield part.split()


def hashes(text: bytes, longest: int, size: int = 1 << 20) -> Iterator[tuple[int, list[int]]]:
    """(number of new words, hashes) of each piece of a text: crc32 of every run of 1 to ``longest`` consecutive words, joined by one blank.

    The hash of a run is that of the run without its last word, continued over a blank and that word."""
    tail: list[bytes] = []
    for words in pieces(text, size):
        new, words = len(words), tail + words
        one = [*map(crc32, words)]
        found, run, spaced = one[len(tail):], one, [b" " + w for w in words] if longest > 1 else []
        for k in range(1, longest):
            run = [*map(crc32, spaced[k:], run)]
            found += run[max(0, len(tail) - k):]  # those that end in a new word
        tail = words[max(0, len(words) - longest + 1):] if longest > 1 else []
        yield new, found


def bucket_counts(rows: DataFrame, longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """(bucket, n): features of all texts of rows (text) by bucket. A task counts, and sends a row for each bucket that it met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        total, counts = np.zeros(buckets, np.int64), Counter()

        def fold():
            keys = np.fromiter(counts.keys(), np.int64, len(counts)) % buckets
            np.add.at(total, keys, np.fromiter(counts.values(), np.int64, len(counts)))
            counts.clear()

        for batch in slices(batches):
            for text in texts(batch):
                for _, found in hashes(text, longest):
                    counts.update(found)
            if len(counts) > MOST_KEYS:
                fold()
        fold()
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met])], ["bucket", "n"])

    return rows.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000) -> list[int]:
    """For every bucket floor(1000 * log of its smoothed share in target over that in docs). ``buckets`` sums a table reach the driver, whatever the tables' sizes."""
    s, t = ({r["bucket"]: r["n"] for r in bucket_counts(x, longest, buckets).collect()} for x in (docs, target))
    all_s, all_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return [math.floor(1000 * math.log((float(t.get(b, 0) + 1) * all_s) / (float(s.get(b, 0) + 1) * all_t))) for b in range(buckets)]


def noise(doc_id: object, seed: int) -> int:
    """floor of -1000 * ln(-ln(u)): the same for an id in every run. u comes from the sha256 of seed and id; a null id counts as the empty text."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: list[int], longest: int = 1, seed: int = 2024) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of docs (doc_id, text): the floored mean gain of a document's features (0 without any), and that with noise."""
    by_bucket = np.array(gain, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in slices(batches):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                n_words = n = total = 0
                for new, found in hashes(text, longest):
                    n_words, n = n_words + new, n + len(found)
                    total += int(by_bucket[np.array(found, np.int64) % len(by_bucket)].sum())
                weight = total // n if n else 0
                out.append((n_words, n, weight, weight + noise(doc_id, seed)))
            columns = [pa.array(c, pa.int64()) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_features", "weight", "score"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, *, longest: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for every row of docs (doc_id, text), to resemble the texts of target (text).

    Of the N documents of ``least_words`` words or more, the floor(percent * N / 100) with the highest scores are drawn without replacement (Gumbel top-k); rank is 1, 2, 3 ... by
    falling score, ties to the smaller doc_id, null for the others.

    Two passes over the texts, no shuffle of them. A histogram over the scores finds the score that all drawn rows reach: scores are whole
    thousandths of logarithms, so there are some 10^5 of them for tables of any size. Only rows that reach it are dealt into ranges, numbered there and
    shifted by the rows of the ranges before (two-phase sums); a random last key deals rows that share score and id to several ranges.

    Null and word-less texts have no features, weight 0, and are drawn only if ``least_words`` is 0. A null doc_id counts as the empty text, and comes last among ties.
    Repeated rows are drawn one by one. Long texts are worked through in pieces. An empty target leaves weights by the documents' own shares; empty docs give no rows.
    Other columns are ignored.
    """
    rows = cut(scored(docs, gains(docs, target, longest, buckets), longest, seed))
    able = F.col("n_words") >= least_words
    by_score = cut(rows.where(able).groupBy("score").agg(F.count("*").alias("n")))
    most = percent * (by_score.agg(F.sum("n")).first()[0] or 0) // 100
    higher = by_score.select("score", (F.sum("n").over(W.orderBy(F.col("score").desc()).rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    last = higher.where(F.col("before") < most).agg(F.min("score")).first()[0]
    reach = able & (F.col("score") >= last) if last is not None else F.lit(False)
    near = rows.where(reach).withColumn("one", F.lit(1)).withColumn("salt", F.rand(5))
    near = running_before(near, [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("salt")], {"before": "one"})
    drawn = near.select(*rows.columns, F.when(F.col("before") < most, F.col("before") + 1).alias("rank"))
    return drawn.unionByName(rows.where(~reach).withColumn("rank", F.lit(None).cast("long")))


SQL = r"""
WITH crc AS (
  SELECT list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT r, unnest(w) AS word FROM d),
bw AS (SELECT unnest(w) AS word FROM b),
words AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
hashed AS (
  SELECT word, xor(list_reduce([4294967295] || list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT), lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1])), 4294967295) % 10000 AS bucket
  FROM words, crc),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN hashed USING (word) GROUP BY bucket),
g AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)::DOUBLE / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket)),
x AS (SELECT r, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM dw JOIN hashed USING (word) JOIN g USING (bucket) GROUP BY r),
y AS (
  SELECT r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM d LEFT JOIN x USING (r)),
z AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS k, 10 * count(*) OVER () // 100 AS most FROM y WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= most THEN k END::BIGINT AS rank FROM y LEFT JOIN z USING (r)
"""
