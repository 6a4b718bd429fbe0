"""Mixing sources to target weights (operator 9): hash-threshold histograms, DataFrame functions only."""

from __future__ import annotations

from fractions import Fraction
from math import lcm

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mapjobs.session import cut

#: Bits of the selection hash, and of one level of the histogram.
HASH_BITS, LEVEL_BITS = 48, 12


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def selection_hash(doc_id: Column) -> Column:
    """48 bits of the md5 of the id's text: the same in every run and in other SQL engines."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most_repeats: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code point order, null last, weigh ``weights``, repeating; together they share the total of
    all sizes. A target stops at ``most_repeats`` times its source's size; what that frees is dealt
    again by weight until no target is above. In order of limit / weight the stopped ones come first,
    so one running sum finds them all. The two global windows run over one row per source.
    """
    n = len(weights)
    exact = [Fraction(str(x)) for x in weights]
    if not exact or min(exact) <= 0:
        raise ValueError("weights must be above 0")
    whole = [int(x * lcm(*[y.denominator for y in exact])) for x in exact]  # in the same proportions
    w = F.element_at(F.array(*[F.lit(x) for x in whole]), ((F.col("place") - 1) % n + 1).cast("int")).cast("long")
    s = sizes.withColumn("place", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    s = s.withColumn("w", w).withColumn("limit", F.lit(most_repeats).cast("long") * F.col("source_size"))
    every = W.orderBy((F.col("limit") / F.col("w")), "place")
    s = s.withColumn("total", F.sum("source_size").over(every.rowsBetween(*_ALL)))
    s = s.withColumn("w_all", F.sum("w").over(every.rowsBetween(*_ALL)))
    s = s.withColumn("stopped_before", F.sum("limit").over(every.rowsBetween(W.unboundedPreceding, 0)) - F.col("limit"))
    s = s.withColumn("w_left", F.col("w_all") - F.sum("w").over(every.rowsBetween(W.unboundedPreceding, 0)) + F.col("w"))
    s = s.withColumn("stopped", (F.col("total") - F.col("stopped_before")) * F.col("w") >= F.col("limit") * F.col("w_left"))
    s = s.withColumn("rest", F.col("total") - F.sum(F.when(F.col("stopped"), F.col("limit")).otherwise(0)).over(every.rowsBetween(*_ALL)))
    s = s.withColumn("w_rest", F.sum(F.when(~F.col("stopped"), F.col("w")).otherwise(0)).over(every.rowsBetween(*_ALL)))
    target = F.when(F.col("stopped"), F.col("limit").cast("double")).otherwise(F.col("w") * (F.col("rest") / F.when(F.col("w_rest") > 0, F.col("w_rest"))))
    return s.select("source", "source_size", target.alias("target"))


_ALL = (W.unboundedPreceding, W.unboundedFollowing)


def mix(docs: DataFrame, *, weights: tuple[float, ...] = (5, 2, 1), most_repeats: int = 3, broadcast_sources: int = 50_000) -> DataFrame:
    """(doc_id, size, source, source_size, target, repeats, taken) for every row of docs (doc_id, text, source).

    With r = target / source_size, each document of a source is taken floor(r) times, and once more if
    the hash of its id lies under the source's threshold. The threshold is found without a sort: sizes
    are summed by (source, top 12 hash bits), the prefix of buckets that fits the budget is taken, and only
    the bucket on the boundary is summed again by its next 12 bits, down to single hash values; the last
    one is taken if that brings the sum nearer to the budget. A hot source is summed by partial
    aggregation. The table of sources is broadcast only while it has ``broadcast_sources`` rows at most (counted
    first); beyond, it is an ordinary join, which AQE splits at hot sources.

    Null text has size 0; a null source is a source of its own, placed last; rows that repeat a doc_id
    share its hash, so they are taken alike; no rows give no rows. Other columns are ignored.
    """
    d = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), selection_hash(F.col("doc_id")).alias("h"))
    # a join needs a key that is never null and never clashes
    d = cut(d.withColumn("key", F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce("source", F.lit("")))))
    sizes = d.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    s = source_targets(sizes, weights, most_repeats).withColumn("key", F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce("source", F.lit(""))))
    full = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most_repeats))).otherwise(0).cast("long")
    s = s.withColumn("full", full).withColumn("budget", F.col("target") - F.col("full") * F.col("source_size"))
    s = cut(s.drop("source"))
    small = s.count() <= broadcast_sources
    hint = F.broadcast if small else (lambda x: x)

    # bounds: key, budget still open, prefix of the boundary bucket, sum of what lies before it
    bounds = s.select("key", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"))
    left = HASH_BITS
    while left > 0:
        rows = d.select("key", "h", "size").join(hint(bounds), "key").where(F.shiftright("h", left) == F.col("prefix"))
        left -= LEVEL_BITS
        sums = rows.groupBy("key", F.shiftright("h", left).alias("bucket")).agg(F.sum("size").alias("n"))
        sums = sums.join(hint(bounds.select("key", "budget", "before")), "key")
        run = F.col("before") + F.sum("n").over(W.partitionBy("key").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
        sums = sums.withColumn("upto", run)
        fits = F.col("upto") <= F.col("budget") if left else (2 * F.col("upto") - F.col("n")) <= 2 * F.col("budget")
        nxt = sums.groupBy("key").agg(
            F.min(F.when(~fits, F.col("bucket"))).alias("prefix"),
            F.max(F.when(fits, F.col("upto"))).alias("reached"),
        )
        done = bounds.select("key", "budget", F.col("before").alias("was"), F.col("prefix").alias("old"))
        bounds = done.join(nxt, "key", "left").select(
            "key", "budget",
            # no bucket beyond the budget: the whole of the old bucket is taken
            F.coalesce("prefix", F.shiftleft(F.col("old") + 1, LEVEL_BITS)).alias("prefix"),
            F.coalesce("reached", "was").alias("before"),
        )
        bounds = cut(bounds)
    limits = s.join(bounds.select("key", F.col("prefix").alias("threshold")), "key")
    repeats = (F.col("full") + F.when(F.col("h") < F.col("threshold"), 1).otherwise(0)).cast("int")
    return d.join(hint(limits), "key").select("doc_id", "size", "source", "source_size", "target", repeats.alias("repeats"), (F.col("size") * repeats).alias("taken"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(place - 1) % 3 + 1]::BIGINT AS w, 3 * source_size AS lim FROM s),
r AS (
  SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS w_all,
         sum(lim) OVER o - lim AS stopped_before, sum(w) OVER o - w AS w_before
  FROM w WINDOW o AS (ORDER BY lim / w, place ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, (total - stopped_before) * w >= lim * (w_all - w_before) AS stopped FROM r),
t AS (
  SELECT source, source_size,
         CASE WHEN stopped THEN lim::DOUBLE
              ELSE w::DOUBLE * ((total - sum(CASE WHEN stopped THEN lim ELSE 0 END) OVER ())::DOUBLE
                        / (sum(CASE WHEN stopped THEN 0 ELSE w END) OVER ())::DOUBLE) END AS target
  FROM c),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END AS whole_times FROM t),
x AS (
  SELECT d.*, b.source_size, b.target, b.whole_times, b.target - b.whole_times * b.source_size AS budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE UNBOUNDED PRECEDING) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS same
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (size * (whole_times + CASE WHEN 2 * upto - same <= 2 * budget THEN 1 ELSE 0 END))::BIGINT AS taken
FROM x
"""
