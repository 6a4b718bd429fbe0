"""Benchmark decontamination (operator 10) by winnowing.

Both sides keep, of every window of consecutive k-gram hashes, the least one (the rightmost of equal ones). With
k-grams of ``k`` words and windows of ``span - k + 1`` hashes, any shared passage of ``span`` words or more
keeps a common fingerprint (Schleimer, Wilkerson, Aiken 2003). Fingerprints of both sides are joined; hits are extended to the windows of ``span``
words that they were kept for, which are compared by a 128-bit digest of their words. Items shorter than ``span`` words have no full
window; each is sought by the hash of its whole word sequence.

Words are hashed with numpy over a slice of texts at once; no Python loop runs over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from mapjobs.llm.common import release, slices, texts
from mapjobs.session import cut, stored

#: Bytes of words are a-z, 0-9 and all above 0x7F; A-Z are lower-cased first.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
IN_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
P, Q = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(SPLIT).split()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Powers:
    """P to the powers 0, 1, ... and of its inverse, grown when needed."""

    inverse = np.uint64(pow(int(P), -1, 1 << 64))

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            steps = np.full(size, P), np.full(size, self.inverse)
            steps[0][0] = steps[1][0] = 1
            self.up, self.down = np.multiply.accumulate(steps[0]), np.multiply.accumulate(steps[1])
        return self.up[:n], self.down[:n]


def word_hashes(buffers: list[bytes], powers: Powers, piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts in a row, number of words of each text). About ``piece`` bytes are worked on at once, whatever the length of a text."""
    data = np.frombuffer((b"\n".join(buffers) + b"\n").translate(LOWER), np.uint8)
    inside = IN_WORD[data]
    hashes, places, at = [], [], 0
    while at < len(data):
        end = at + piece
        end = len(data) if end >= len(data) else end + int(np.argmin(inside[end:])) + 1  # the last byte is in no word
        part = inside[at:end]
        edge = np.diff(part.astype(np.int8), prepend=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = powers.of(len(part) + 1)
        run = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((data[at:end].astype(np.uint64) + np.uint64(1)) * up[:-1], out=run[1:])
        hashes.append(mixed((run[ends] - run[starts]) * down[starts]))
        places.append(starts + at)
        at = end
    ends_of_text = np.cumsum([len(b) + 1 for b in buffers])
    upto = np.searchsorted(np.concatenate(places), ends_of_text)
    return np.concatenate(hashes), np.diff(upto, prepend=0)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words; the last k - 1 places are absent."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * Q + h[j:j + n]
    return mixed(out)


def kept_places(g: np.ndarray, w: int) -> np.ndarray:
    """For each window of w hashes the place of its least one, the rightmost of equal ones: its fingerprint."""
    n = len(g) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, place = g[:n].copy(), np.arange(n)
    for j in range(1, w):
        now = g[j:j + n]
        less = now <= best
        best = np.where(less, now, best)
        place[less] = np.arange(j, j + n)[less]
    return place


def digest(words: list[bytes]) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(b" ".join(words))


def item_windows(items: DataFrame, span: int, k: int) -> DataFrame:
    """(item_id, n, print, w): every window of every item, w its 128-bit digest, with the fingerprint that winnowing keeps of it.

    A window is ``span`` words, or the whole item if that is shorter; n is its number of words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in slices(batches):
            for item_id, text in zip(batch.column("item_id").to_pylist(), texts(batch)):
                words = words_of(text)
                n = min(span, len(words))
                if not n:
                    continue
                h = word_hashes([text], powers)[0]
                if n < span:
                    prints = gram_hashes(h, n)
                else:
                    g = gram_hashes(h, k)
                    prints = g[kept_places(g, span - k + 1)]
                for a in range(0, len(prints), 50_000):
                    part = prints[a:a + 50_000].view(np.int64)
                    w = [digest(words[i:i + n]) for i in range(a, a + len(part))]
                    yield pa.RecordBatch.from_arrays([pa.array([item_id] * len(part), pa.string()), pa.array([n] * len(part), pa.int32()), pa.array(part), pa.array(w, pa.binary())], ["item_id", "n", "print", "w"])

    return items.mapInArrow(run, "item_id string, n int, print long, w binary")


def print_bits(windows: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of 2 ** bits places in which those of all fingerprints are set. Its size is fixed, so it may be broadcast whatever the benchmark's size."""
    place = F.col("print").bitwiseAND((1 << bits) - 1)
    one = F.expr("shiftleft(1L, cast(print & 63 as int))")
    words = windows.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(one).alias("x")).toArrow()
    out = np.zeros(1 << bits - 6, np.int64)
    out[words.column("at").to_numpy()] = words.column("x").to_numpy()
    return out.view(np.uint64)


def among(prints: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    place = prints & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


WINDOWS = pa.list_(pa.struct([("w", pa.binary()), ("starts", pa.list_(pa.int32()))]))


def document_prints(docs: DataFrame, bitmap: np.ndarray, lengths: list[int], span: int, k: int, text_slice: int) -> DataFrame:
    """Two kinds of rows, told apart by ``print``: (row, doc_id, n_words) of every document, print null; and (row, n, print, windows) of the fingerprints
    that may be in the benchmark, with the digests and starts of the windows they stand for. ``row`` numbers documents, so it needs a cut behind it.

    Equal windows of a text are one entry with many starts, so a text of one repeated word is one fingerprint with one window.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = T.StructType.fromDDL(f"row long, doc_id {kind}, n_words long, n int, print long, windows array<struct<w: binary, starts: array<int>>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        release()
        bitmap, powers, at = shared.value, Powers(), TaskContext.get().partitionId() << 40
        for batch in slices(batches, most=text_slice):
            buffers = texts(batch)
            h, counts = word_hashes(buffers, powers)
            ends, m = np.cumsum(counts), len(buffers)
            found: list[tuple[int, np.ndarray, np.ndarray]] = []  # words of a window, starts, their fingerprints
            g = gram_hashes(h, k)
            prints = g[kept_places(g, span - k + 1)]
            hit = np.flatnonzero(among(prints, bitmap))
            found.append((span, hit, prints[hit]))
            for n in lengths:
                prints = gram_hashes(h, n)
                hit = np.flatnonzero(among(prints, bitmap))
                found.append((n, hit, prints[hit]))
            rows, split = [], {}
            for n, starts, prints in found:
                text = np.searchsorted(ends, starts, "right")
                inside = starts + n <= ends[text] if len(starts) else np.zeros(0, bool)  # windows across two texts are none
                of: dict[tuple[int, int], dict[bytes, list[int]]] = {}
                for t, s, p in zip(text[inside].tolist(), starts[inside].tolist(), prints[inside].view(np.int64).tolist()):
                    if t not in split:
                        split[t] = words_of(buffers[t])
                    s -= int(ends[t] - counts[t])
                    of.setdefault((t, p), {}).setdefault(digest(split[t][s:s + n]), []).append(s)
                rows += [(at + t, n, p, [{"w": w, "starts": x} for w, x in windows.items()]) for (t, p), windows in of.items()]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + m)), batch.column("doc_id"), pa.array(counts, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()), pa.nulls(m, WINDOWS)], names)
            for a in range(0, len(rows), 10_000):
                r = [*zip(*rows[a:a + 10_000])]
                size = len(r[0])
                yield pa.RecordBatch.from_arrays([pa.array(r[0], pa.int64()), pa.nulls(size, batch.column("doc_id").type), pa.nulls(size, pa.int64()), pa.array(r[1], pa.int32()), pa.array(r[2], pa.int64()), pa.array(r[3], WINDOWS)], names)
            at += m

    names = schema.names
    return docs.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, *, span: int = 13, k: int = 5, bits: int = 26, text_slice: int = 1 << 20) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of docs (doc_id, text).

    A document word is hit if it lies in an occurrence of a window of ``span`` words of a benchmark item (of the whole item,
    if that is shorter). Contaminated: at least 5 % of the words, and one at least, are hit.

    Documents are read once. Of their fingerprints, those whose place in a bitmap of 2 ** ``bits`` places is not set cannot be in the benchmark
    (item_id, text) and are not shuffled; the others meet the benchmark's fingerprints in a join, and what is left is extended to whole windows, which are
    joined by digest. Windows that the same items hold are one class, so a passage of many windows and many items costs their sum, not their product.
    All joins are plain ones that can be split at hot fingerprints and windows.

    Null and word-less texts have no words and hit nothing; null item_ids take part as the text ``null``;
    repeated items count once; repeated documents are judged one by one; empty tables give no rows or no hits. doc_id may be of any type and null.
    Other columns are ignored.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    windows = cut(item_windows(items, span, k))
    lengths = sorted(r["n"] for r in windows.where(F.col("n") < span).select("n").distinct().collect())
    rows = cut(document_prints(docs.select("doc_id", "text"), print_bits(windows, bits), lengths, span, k, text_slice))

    # which items hold a window, as a number for each set of items
    held = windows.select("w", "item_id").distinct()
    of_set = [F.bit_xor(F.xxhash64(F.lit(seed), "item_id")) for seed in (1, 2)]
    classes = stored(held.groupBy("w").agg(F.struct(F.count("*").alias("n"), of_set[0].alias("a"), of_set[1].alias("b")).alias("set")))
    one = classes.groupBy("set").agg(F.min("w").alias("w"))
    members = stored(one.join(held, "w").select("set", "item_id"))

    met = rows.where("print is not null").join(windows.select("print"), "print", "left_semi").select("row", "n", F.explode("windows").alias("x"))
    met = cut(met.select("row", "n", "x.w", "x.starts").join(classes, "w").select("row", "n", "starts", "set"))
    spans = met.select("row", F.explode("starts").alias("start"), "n").select("row", "start", (F.col("start") + F.col("n")).alias("end")).distinct()
    reach = F.max("end").over(W.partitionBy("row").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1))
    new = F.col("end") - F.greatest("start", F.coalesce("reach", F.lit(0)))
    covered = spans.withColumn("reach", reach).groupBy("row").agg(F.sum(F.greatest(new, F.lit(0))).cast("long").alias("n_hit"))
    listed = met.select("row", "set").distinct().join(members, "set").select("row", "item_id").distinct()
    listed = listed.groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    hits = covered.join(listed, "row").select("row", "n_hit", F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("items"))
    out = rows.where("print is null").select("row", "doc_id", "n_words").join(hits, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    sha = F.sha2(F.coalesce("items", F.lit("")).cast("binary"), 256)
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), sha.alias("items_sha256"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


#: The contract's rule told plainly: every window of every item against every window of every document.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT DISTINCT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[k:k + least(13, len(w)) - 1], ' ') AS t FROM i, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS u(k) WHERE len(w) > 0),
dw AS (SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS t FROM d, (SELECT DISTINCT n FROM iw) s, unnest(range(1, len(w) - n + 2)) AS u(k)),
hit AS (SELECT r, n, k, item FROM dw JOIN iw USING (n, t)),
cov AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, p FROM (SELECT DISTINCT r, n, k FROM hit) h, unnest(range(k, k + n)) AS u(p)) z GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) z GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r)
"""
