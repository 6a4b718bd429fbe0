"""Toxicity (operator 1): a counterfactual-regularised linear classifier.

Features are the words of a text and their beginnings of four to six letters, each present or not. A logistic model
is fitted with two penalties: squared weights, and the squared change of a sentence's score when the identity terms in
it are swapped for others of their kind (counterfactual logit pairing: Garg et al. 2019). Every labelled sentence that names a group is
featurised whole, as it is and swapped, and the model is held to score both alike; so which group a sentence names cannot matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mapjobs.llm.common import slices, texts
from mapjobs.session import cut

WORDS = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")
#: Neutral terms for groups of people, by kind, in the languages at hand.
IDENTITY = {
    "gender": "woman man women men girl boy female male transgender frau mann frauen männer femme homme femmes hommes mujer hombre mujeres hombres",
    "orientation": "gay lesbian straight bisexual queer heterosexual homosexual schwul lesbisch hétérosexuel homosexuel lesbienne homosexuales lesbianas",
    "religion": "muslim christian jewish hindu buddhist catholic atheist muslime christen juden musulman chrétien juif musulmán cristiano judío",
    "origin": "black white asian african european american mexican arab turkish immigrant refugee ausländer flüchtling immigré réfugié inmigrante refugiado",
    "age": "old young elderly teenager alt jung vieux jeune viejo joven",
    "ability": "disabled blind deaf autistic behindert gehörlos handicapé sourd discapacitado sordo",
}


def word_features(word: str) -> list[str]:
    """The word, and its beginnings of 4 to 6 letters (marked)."""
    return [word, *(word[:n] + "*" for n in (4, 5, 6) if len(word) >= n)]


def features(words: list[str]) -> set[str]:
    return {f for w in set(words) for f in word_features(w)}


#: For each term the others of its kind, those that follow it in the list first.
KIN = {w: [*terms[i + 1:], *terms[:i]] for terms in map(str.split, IDENTITY.values()) for i, w in enumerate(terms)}


def counterfactuals(text: str, turns: int = 2) -> Iterator[list[str]]:
    """For each sentence that names a group, and each of ``turns`` swaps of it: how the whole sentence's feature vector changes.

    A swap puts another term of its kind in the place of every identity word at once. Features that the swapped sentence
    has and the sentence has not are marked +, those it loses -; a swap that changes nothing (both terms are there) is an empty list.
    """
    for m in SENTENCE.finditer(text.lower()):
        words = WORDS.findall(m[0])
        if KIN.keys().isdisjoint(words):
            continue
        before = features(words)
        for turn in range(turns):
            after = features([KIN[w][turn % len(KIN[w])] if w in KIN else w for w in words])
            yield [*sorted("+" + f for f in after - before), *sorted("-" + f for f in before - after)]


@dataclass
class Model:
    weights: dict[str, float]
    bias: float


@dataclass
class Sample:
    """Numbered features of texts, with labels and weights; changes by swaps, with how many sentences have each."""
    rows: list[np.ndarray]
    y: np.ndarray
    importance: np.ndarray
    changes: list[tuple[np.ndarray, np.ndarray]]  # (features, +1 or -1)
    times: np.ndarray
    size: int

    def __post_init__(self):
        join = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
        self.cols, self.row = join(self.rows, np.int64), np.repeat(np.arange(len(self.rows)), [len(r) for r in self.rows])
        self.ccols, self.csign = join([c for c, _ in self.changes], np.int64), join([s for _, s in self.changes], float)
        self.crow = np.repeat(np.arange(len(self.changes)), [len(c) for c, _ in self.changes])
        self.share = self.times / max(self.times.sum(), 1)

    def loss(self, w: np.ndarray, b: float, l2: float, fair: float) -> tuple[float, np.ndarray, float]:
        """Weighted logistic loss + l2 |w|^2 + fair * mean over swapped sentences of (change of score)^2; its gradient in w and b."""
        z = np.bincount(self.row, w[self.cols], len(self.rows)) + b
        total = self.importance.sum()
        err = self.importance * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - self.y) / total
        value = (self.importance * (np.logaddexp(0, z) - self.y * z)).sum() / total + l2 * (w * w).sum()
        g = np.bincount(self.cols, err[self.row], self.size) + 2 * l2 * w
        if len(self.changes):
            change = np.bincount(self.crow, self.csign * w[self.ccols], len(self.changes))
            value += fair * (self.share * change * change).sum()
            g += 2 * fair * np.bincount(self.ccols, self.csign * (self.share * change)[self.crow], self.size)
        return value, g, err.sum()


def _fit(sample: Sample, l2: float, fair: float, steps: int) -> tuple[np.ndarray, float]:
    """The loss's minimum, by Adam on the full sample."""
    w, b = np.zeros(sample.size), 0.0
    m, v, mb, vb = np.zeros(sample.size), np.zeros(sample.size), 0.0, 0.0
    for t in range(1, steps + 1):
        _, g, gb = sample.loss(w, b, l2, fair)
        rate = 0.1 * (1 - t / (steps + 1)) + 0.001
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        b -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return w, b


def train(docs: DataFrame, labels: DataFrame, *, allowed: Column | None = None, per_class: int = 3000, least_documents: int = 4, least_z: float = 3.5, l2: float = 1e-5, fair: float = 1.0, steps: int = 150) -> Model:
    """Fits a model on docs (doc_id, text) and labels (doc_id, toxic 0/1).

    allowed: a condition on labels' rows that may be learnt from. The classifier is fitted on a bounded sample: about
    ``per_class`` labelled rows of either class, chosen by a hash of the id; their texts are used whole and they are weighted back to
    their share. The sample's ids are broadcast (2 * per_class rows). Features are all those whose shares of documents in the
    two classes differ by ``least_z`` standard errors, and those that swaps change. Equal changes of all sentences are added up in Spark; the driver gets
    each once, and the sample's numbered features. Rows with null labels or ids are left out; without rows of both
    classes every score is the share of class 1 (0.5 without any).
    """
    spark = docs.sparkSession
    y = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    if allowed is not None:
        y = y.where(allowed)
    y = y.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["count"] for r in y.groupBy("toxic").count().collect()}
    if len(n) < 2:
        share = n.get(1, 0) / sum(n.values()) if n else 0.5
        return Model({}, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    chance = F.when(F.col("toxic") == 1, min(1.0, per_class / n[1])).otherwise(min(1.0, per_class / n[0]))
    y = y.where(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 20)) < chance * (1 << 20))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20):
            decoded = [t.decode("utf-8", "replace") for t in texts(batch)]
            found = [sorted(features(WORDS.findall(t.lower()))) for t in decoded]
            changes = [[*counterfactuals(t)] for t in decoded]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.string())), pa.array(changes, pa.list_(pa.list_(pa.string())))], ["toxic", "features", "changes"])

    sample = docs.select("doc_id", "text").join(F.broadcast(y), "doc_id").select("text", "toxic")
    sample = cut(sample.mapInArrow(featurise, "toxic int, features array<string>, changes array<array<string>>"))
    got = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(got) < 2:
        return Model({}, float(np.log((n[1] + 1) / (n[0] + 1))))
    share = lambda k: (F.sum(F.when(F.col("toxic") == k, 1).otherwise(0)) + 0.5) / (got[k] + 1.0)
    whole = (F.count("*") + 1.0) / (got[0] + got[1] + 2.0)
    z = F.abs(share(1) - share(0)) / F.sqrt(whole * (1 - whole) * (1 / got[1] + 1 / got[0]))
    chosen = sample.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(F.count("*").alias("n"), z.alias("z"))
    chosen = chosen.where((F.col("n") >= least_documents) & (F.col("z") >= least_z)).select("f")
    names = sorted(r["f"] for r in chosen.collect())
    changed = sample.select(F.explode("changes").alias("c")).groupBy("c").count().toArrow().to_pylist()
    # what swaps change belongs to the model whether or not it tells the classes apart
    place = {f: i for i, f in enumerate(dict.fromkeys([*names, *sorted({f[1:] for r in changed for f in r["c"]})]))}
    shared = spark.sparkContext.broadcast(place)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        for batch in batches:
            rows = [[place[f] for f in fs if f in place] for fs in batch.column("features").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(rows, pa.list_(pa.int32()))], ["toxic", "at"])

    rows = sample.mapInArrow(number, "toxic int, at array<int>").toArrow()
    target = rows.column("toxic").to_numpy().astype(float)
    vectors = [np.array(x, np.int64) for x in rows.column("at").to_pylist()]
    importance = np.where(target == 1, n[1] / got[1], n[0] / got[0])
    changed = sorted(((r["c"], r["count"]) for r in changed))
    changes = [(np.array([place[f[1:]] for f in c], np.int64), np.array([1.0 if f[0] == "+" else -1.0 for f in c])) for c, _ in changed]
    weights, bias = _fit(Sample(vectors, target, importance, changes, np.array([n for _, n in changed], float), len(place)), l2, fair, steps)
    return Model({f: float(weights[i]) for f, i in place.items() if weights[i]}, float(bias))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of docs (doc_id, text): the probability of label 1, 0 to 1.

    Null and empty texts get the score of a text without features. Row-wise, so repeated rows and ids are no matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value.weights, shared.value.bias
        known: dict[str, tuple[str, ...]] = {}
        for batch in slices(batches):
            out = []
            for t in texts(batch):
                words = set(WORDS.findall(t.decode("utf-8", "replace").lower()))
                for w in words.difference(known):
                    known[w] = tuple(f for f in word_features(w) if f in weights)
                there = set().union(*[k for k in map(known.__getitem__, words) if k])
                out.append(bias + sum(map(weights.__getitem__, sorted(there))))
            if len(known) > 200_000:
                known.clear()
            z = np.clip(np.array(out, float), -500, 500)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-z)), pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
