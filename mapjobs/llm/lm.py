"""Language-model scores (operator 4): subword lattice likelihood.

The model is a stream of pieces of a public unigram vocabulary and an end. The vocabulary's own scores are the start and the prior: the file's scores
are ranks (minus the place in order of frequency), so a piece weighs 1 / (10 + rank), by Zipf's law. The weights are then fitted to the training words by
expectation maximisation: the lattice gives the expected uses of every piece over all segmentations, they are added up over all distinct words in Spark, and
the prior counts as ``prior`` further uses (a Dirichlet prior, maximum a posteriori up to the one use that its mode leaves off). A text's
probability is the sum over all its segmentations into pieces. No piece reaches over white space, so the sum is a product over words,
each worked out by the forward recursion in log space (``lattice``). The end's probability is its share of the training tokens.

Every distinct word of the documents is scored once, in the table that also counts the training tokens.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mapjobs.llm.common import held, release, slices, texts
from mapjobs.llm.lattice import Lattice, normalised, public_pieces
from mapjobs.session import cut

START = "▁"
LN10 = math.log(10)


def tokens_of(text: bytes) -> list[bytes]:
    """Words after lower-casing A-Z: runs without ASCII white space (what bytes.split() cuts at)."""
    return text.lower().split()


def word_counts(docs: DataFrame, most: int = 200_000) -> DataFrame:
    """(word, c): every word of docs (text, held_out) with its number in rows that are not held out. Each task adds up ``most`` distinct words before it shuffles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        total: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.binary()), pa.array(total.values(), pa.int64())], ["word", "c"])
            total.clear()
            return out

        for batch in slices(batches):
            for text, out in zip(texts(batch), batch.column("held_out").to_pylist()):
                words = tokens_of(text)
                total.update(dict.fromkeys(words, 0) if out else words)
            if len(total) > most:
                yield flush()
        yield flush()

    return docs.select("text", "held_out").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def piece_weights(counts: DataFrame, vocabulary: str, rounds: int, prior: float) -> tuple[list[str], np.ndarray]:
    """The pieces and their natural log probabilities, which share 1, fitted to the words of ``counts`` (word, c) in ``rounds`` steps.

    A task adds up its words' expected uses; the driver gets one number a piece, which is the size of the vocabulary. No words, or no rounds, leave the prior's weights."""
    pieces, published = public_pieces(vocabulary)
    share = 1 / (10 - published)
    share /= share.sum()
    logp = np.log(share)[:, None]
    known = counts.where("c > 0")
    for _ in range(rounds):
        shared = counts.sparkSession.sparkContext.broadcast((pieces, logp))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            pieces, logp = shared.value
            lattice, total = Lattice(pieces), np.zeros(len(pieces))
            for batch in slices(batches, "word"):
                words = [START + w.decode("utf-8", "replace") for w in texts(batch, "word")]
                total += lattice.expected(words, batch.column("c").to_numpy(zero_copy_only=False).astype(float)[:, None], logp)[:, 0]
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "n"])

        got = known.mapInArrow(expect, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        uses = prior * share
        uses[got.column("piece").to_numpy()] += got.column("n").to_numpy()
        logp = normalised(uses[:, None], 0.0)
    return pieces, logp


def word_scores(words: DataFrame, weights: tuple[list[str], np.ndarray], end: float) -> DataFrame:
    """(word, c, lp): words (word, c) with the log10 of their probability over all segmentations, under weights that share 1 - end. Bad UTF-8 is read as U+FFFD."""
    shared = words.sparkSession.sparkContext.broadcast((weights[0], weights[1] + math.log1p(-end)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, logp = shared.value
        lattice = Lattice(pieces)
        for batch in slices(batches, "word"):
            lp = lattice.score([START + w.decode("utf-8", "replace") for w in texts(batch, "word")], logp)[:, 0] / LN10
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(lp)], ["word", "c", "lp"])

    return words.mapInArrow(run, "word binary, c long, lp double")


def score(docs: DataFrame, vocabulary: str, *, held_out: Column, rounds: int = 2, prior: float = 1000.0, hot_words: int = 400_000) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of docs (doc_id, text).

    held_out: a condition on doc_id; those rows are scored but not learnt from. Counts cover all other rows, and so do the ``rounds`` in which
    pieces' weights are fitted; the published weights count as ``prior`` uses.
    The tokens of a text are its words and one end. Words with ``1 / hot_words`` of all training tokens or more are
    ``hot_words`` at most; they are broadcast with their scores and take most tokens of any text out of the shuffle, and with them every
    hot key. The rest meet their scores in a join on the word, and add up by document.

    Null and empty texts have the end alone. Repeated rows and ids are scored one by one. With no training rows
    every word is unknown, pieces keep the published weights and the end weighs a half; no rows give no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    counts = cut(word_counts(d))
    ends = d.where(~F.col("held_out")).count()
    of_words = counts.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).first()
    n, v = (of_words[0] or 0) + ends, of_words[1] + (ends > 0)
    end = (ends + 0.5) / (n + 1)
    words = cut(word_scores(counts, piece_weights(counts, vocabulary, rounds, prior), end))
    base_of = lambda c: np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    is_hot = F.col("c") * hot_words >= max(n, 1)
    found = words.where(is_hot).toArrow()
    hot = (uuid.uuid4().hex, found.column("word").combine_chunks().cast(pa.binary()), base_of(found.column("c").to_numpy()), found.column("lp").to_numpy())
    shared = spark.sparkContext.broadcast(hot)
    end_base, end_score = float(base_of(ends)), math.log10(end)
    doc = "struct<doc_id:bigint,held_out:boolean,n_tokens:bigint,n_known:bigint,base:double,score:double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each rare word of a text; the first, or a row of its own, carries what is known of the text."""
        from pyspark import TaskContext

        name, hot_word, hot_base, hot_score = shared.value
        hot_at = held(("lm", name), lambda: dict(zip(hot_word.to_pylist(), range(len(hot_word)))))
        at = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            docs, key, rare, tf = [], [], [], []
            for doc_id, out, text in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), texts(batch)):
                words = Counter(tokens_of(text))
                own, times = [], []
                first = len(rare)
                for w, t in words.items():
                    i = hot_at.get(w)
                    if i is None:
                        key.append(at), rare.append(w), tf.append(t), docs.append(None)
                    else:
                        own.append(i), times.append(t)
                i, t = np.array(own, np.int64), np.array(times, np.int64)
                told = {"doc_id": doc_id, "held_out": out, "n_tokens": words.total() + 1, "n_known": int(t.sum()) + (ends > 0), "base": float((t * hot_base[i]).sum()) + end_base, "score": float((t * hot_score[i]).sum()) + end_score}
                if len(rare) == first:
                    # a text without rare words has no word to meet; a name of its own spreads such rows
                    key.append(at), rare.append(b"\x20%d" % at), tf.append(0), docs.append(None)
                docs[first] = told
                at += 1
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(rare, pa.binary()), pa.array(tf, pa.int64()), pa.array(docs, _struct())], ["key", "word", "tf", "doc"])

    rows = d.mapInArrow(run, f"key long, word binary, tf long, doc {doc}")
    met = rows.join(words.where(~is_hot), "word", "left")
    sums = met.groupBy("key").agg(
        F.first("doc", ignorenulls=True).alias("doc"),
        F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("known"),
        F.sum(F.when(F.col("tf") > 0, F.col("tf") * F.log10((F.col("c") + 0.5) / F.lit(n + 0.5 * (v + 1)))).otherwise(0.0)).alias("base"),
        F.sum(F.when(F.col("tf") > 0, F.col("tf") * F.col("lp")).otherwise(0.0)).alias("score"),
    )
    return sums.select(
        "doc.doc_id", "doc.held_out", "doc.n_tokens", (F.col("doc.n_known") + F.col("known")).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("doc.base") + F.col("base")).alias("base_score"), (F.col("doc.score") + F.col("score")).alias("score"),
    )


def _struct() -> pa.DataType:
    return pa.struct([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])
