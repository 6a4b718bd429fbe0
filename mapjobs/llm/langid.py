"""Language identification (operator 2): unigram pieces of a public vocabulary, marginalised over segmentations.

Each language has its own probabilities over the same pieces. A word's probability in a language is the sum over all its
segmentations (forward algorithm, see ``lattice``); a text's is the product over its words. The
probabilities are learnt by expectation maximisation on the words of labelled documents.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mapjobs.llm.common import held, release, slices, texts
from mapjobs.llm.lattice import Lattice, normalised, public_pieces
from mapjobs.session import cut

UNKNOWN = "und"
WORDS = re.compile(r"[^\W\d_]+")
#: The vocabulary marks the start of a word with this character.
START = "▁"


@dataclass
class Model:
    languages: list[str]
    pieces: list[str]
    logp: np.ndarray  # (pieces, languages)
    prior: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


def letters(text: bytes) -> list[str]:
    """Lower-cased runs of letters; none if the text has no letter (signs such as a superscript digit are none)."""
    words = WORDS.findall(text.decode("utf-8", "replace").lower())
    return words if any(c.isalpha() for w in words for c in w) else []


def train(docs: DataFrame, vocabulary: str, *, allowed: Column | None = None, per_language: int = 2000, rounds: int = 2, smooth: float = 0.05) -> Model:
    """Fits a model on docs (doc_id, text, lang).

    allowed: a condition on rows that may be learnt from. The classifier is fitted on a bounded sample: of every
    language, about ``per_language`` documents, chosen by a hash of the id; their texts are
    used whole. Counts of words and expected counts of pieces are grouped sums in Spark; what reaches the driver
    is one number for each piece and language, which is the size of the model. Rows without a language teach nothing; no rows
    give a model that knows none.
    """
    d = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where("lang is not null")
    if allowed is not None:
        d = d.where(allowed)
    counts = d.groupBy("lang").count().collect()
    languages = sorted(r["lang"] for r in counts)
    pieces, _ = public_pieces(vocabulary)
    if not languages:
        return Model([], pieces, np.zeros((len(pieces), 0)), np.zeros(0))
    size = {r["lang"]: r["count"] for r in counts}
    chance = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, per_language / size[k])))])
    d = d.where(F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 20)) < chance[F.col("lang")] * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in slices(batches, most=2 << 20):
            total: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch)):
                total.setdefault(lang, Counter()).update(letters(text))
            for lang, c in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(c.keys(), pa.string()), pa.array(c.values(), pa.int64())], ["lang", "word", "n"])

    words = d.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = cut(words)
    logp = normalised(np.ones((len(pieces), len(languages))), 0.0)
    for _ in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast((pieces, languages, logp))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            pieces, languages, logp = shared.value
            lattice, place = Lattice(pieces), {k: i for i, k in enumerate(languages)}
            total = np.zeros(logp.shape)
            for batch in batches:
                lang = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
                word, n = batch.column("word").to_pylist(), batch.column("n").to_numpy(zero_copy_only=False).astype(float)
                for m in np.unique(lang):
                    of = np.flatnonzero(lang == m)
                    total[:, m] += lattice.expected([START + word[i] for i in of], n[of][:, None], logp[:, [m]])[:, 0]
            p, m = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(m, pa.int64()), pa.array(total[p, m], pa.float64())], ["piece", "model", "n"])

        # the driver gets at most one row per piece and language
        new = np.zeros(logp.shape)
        got = words.mapInArrow(expect, "piece long, model long, n double").groupBy("piece", "model").agg(F.sum("n").alias("n")).toArrow()
        new[got.column("piece").to_numpy(), got.column("model").to_numpy()] = got.column("n").to_numpy()
        logp = normalised(new, smooth)
    n = np.array([size[k] for k in languages], float)
    return Model(languages, pieces, logp, np.log(n / n.sum()))


class Predictor:
    """Scores of words are kept in about ``most`` bytes, after which all are forgotten."""

    def __init__(self, model: Model, most: int = 48 << 20):
        self.model, self.lattice, self.most = model, Lattice(model.pieces), most
        self.known: dict[str, int] = {}
        self.size = 0
        self.scores = np.zeros((0, len(model.languages)))

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if self.size > self.most:
            self.known, self.scores, self.size = {}, self.scores[:0].copy(), 0
            new = list(words)
        if new:
            at = len(self.known)
            self.known.update(zip(new, range(at, at + len(new))))
            self.size += sum(map(len, new)) + len(new) * (200 + 8 * len(self.model.languages))
            self.scores = np.vstack([self.scores, self.lattice.score([START + w for w in new], self.model.logp)])

    def predict(self, buffers: list[bytes]) -> list[tuple[str, float]]:
        words = [letters(b) for b in buffers]
        if not self.model.languages:
            return [(UNKNOWN, 0.0)] * len(buffers)
        self._learn(set().union(*words))
        out = []
        for w in words:
            if not w:
                out.append((UNKNOWN, 0.0))
                continue
            total = self.scores[np.fromiter(map(self.known.__getitem__, w), np.int64, len(w))].sum(0) + self.model.prior
            p = np.exp(total - total.max())
            best = int(p.argmax())
            out.append((self.model.languages[best], float(p[best] / p.sum())))
        return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of docs (doc_id, text).

    score: the probability of the predicted language given the whole text. ``und`` with score 0 for a text that is null or has no
    letter, or if the model knows no language. Equal languages: the first by name. Row-wise, so repeated rows and ids are no matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        predictor = held(("langid", model.name), lambda: Predictor(model))
        for batch in slices(batches, most=2 << 20):
            got = predictor.predict(texts(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of docs, with all their columns, whose language is recognised with a score of ``least`` or more.

    docs needs a text column; other columns are carried along untouched, whatever their names. Null texts and texts without a
    letter go, and all if the model knows no language; a score of exactly ``least`` stays. Repeated rows are judged alike.
    """
    shared, names = docs.sparkSession.sparkContext.broadcast(model), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        predictor = held(("langid", model.name), lambda: Predictor(model))
        for batch in slices(batches, most=2 << 20):
            keep = [x != UNKNOWN and p >= least for x, p in predictor.predict(texts(batch))]
            yield batch.filter(pa.array(keep, pa.bool_())).select(names)

    return docs.mapInArrow(run, docs.schema)
