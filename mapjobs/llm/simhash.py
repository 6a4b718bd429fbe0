"""SimHash near-duplicates (operator 6) by meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` 3 differ in one bit at most in one of their two 32-bit halves. So each distinct
fingerprint emits, for either half, all variants of that half within 1 (half the radius, rounded
down): 66 keys. Keys are shuffled, those with one member are dropped, and colliding
fingerprints are verified on all 64 bits. Exact copies share a fingerprint and are one member.

Within a key only links that join sets are kept (a star from the least member), never all pairs: small keys are
compared directly; in a large one the same idea is applied again to the other half: members emit their
ball of radius 1 in it, equal variants and variants one bit apart (three steps at most) are joined. That is linear in the
members and complete, because what it leaves out (two members that differ from the key in the same bit)
is found under the key that they share exactly. A key that very many fingerprints share does not go to one task: the balls
of its members are shuffled on variants (``links_of_heavy_keys``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mapjobs.components import connected_components
from mapjobs.llm.common import release, slices, texts
from mapjobs.session import cut

SEED, SHINGLE, RADIUS = 42, 3, 3


def fingerprint(words: list[bytes]) -> int:
    """64 majority bits over the XXH64 hashes of the word shingles, repeats included; 0 for no words."""
    import xxhash

    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = [b"%b %b %b" % s for s in zip(words, words[1:], words[2:])]
    h = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], ">u8")
    total = np.zeros(64, np.int64)
    for a in range(0, len(h), 1 << 16):
        total += np.unpackbits(h[a:a + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): fp is the 64-bit fingerprint as a signed long. A-Z are lower-cased; null counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in slices(batches):
            fps = np.array([fingerprint(t.lower().split()) for t in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    d = docs.select("doc_id", "text")
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, fp long")


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each one's component, for a few thousand members inside one task."""
    label = np.arange(n)
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if np.array_equal(before, label):
            return label


def links_of_key(key: int, members: np.ndarray, direct: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Star links (member, least of its set) among the distinct, sorted fingerprints that collide on a key.

    key: the half's number (0 low, 1 high) in bit 32, its variant in the bits below.
    """
    n = len(members)
    if n <= direct:
        a, b = np.triu_indices(n, 1)
        near = np.bitwise_count(members[a] ^ members[b]) <= RADIUS
        a, b = a[near], b[near]
    else:
        low, high = members & np.uint64(0xFFFFFFFF), members >> np.uint64(32)
        keyed, other = (high, low) if key >> 32 else (low, high)
        exact = keyed == np.uint64(key & 0xFFFFFFFF)
        flips = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(32, dtype=np.uint64)])
        at = np.flatnonzero(exact)
        variant = np.concatenate([other[~exact], (other[at][:, None] ^ flips).ravel()])
        owner = np.concatenate([np.flatnonzero(~exact), np.repeat(at, 33)])
        order = np.argsort(variant, kind="stable")
        variant, owner = variant[order], owner[order]
        value, first = np.unique(variant, return_index=True)
        pairs = [(owner, owner[first][np.searchsorted(value, variant)])]
        for f in flips[1:]:
            s = np.minimum(np.searchsorted(value, value ^ f), len(value) - 1)
            hit = value[s] == value ^ f
            pairs.append((owner[first][hit], owner[first][s[hit]]))
        a, b = (np.concatenate(x) for x in zip(*pairs))
    root = local_components(n, a, b)
    linked = np.flatnonzero(root != np.arange(n))
    return members[linked], members[root[linked]]


LOW = 0xFFFFFFFF
FLIPS = [0, *(1 << b for b in range(32))]


def heavy_keys(fps: DataFrame, most: int) -> DataFrame:
    """(key): every key with more than ``most`` members, and perhaps some with half as many.

    Members are counted by their exact halves. A key's members come from 33 halves; those under a 64th of ``most`` give it little over half of ``most``
    together, so a key over ``most`` has the rest from larger ones, which are few and alone are exploded."""
    halves = fps.select(F.explode(F.array(F.col("fp").bitwiseAND(LOW), F.shiftrightunsigned("fp", 32) + (1 << 32))).alias("half"))
    large = halves.groupBy("half").agg(F.count("*").alias("n")).where(F.col("n") * 64 > most)
    keys = large.select(F.explode(F.array(*[F.col("half").bitwiseXOR(F.lit(f).cast("long")) for f in FLIPS])).alias("key"), "n")
    return keys.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") * 64 > 31 * most).select("key")


def links_of_heavy_keys(members: DataFrame) -> DataFrame:
    """(src, dst): what ``links_of_key`` finds among the members (key, fp) of each key, without a key's members in one task.

    Members emit their variants of the other half as there. A variant goes to two cells, one of its upper and one of its lower 16 bits; in a cell the other 16 bits
    are compared, so two variants one bit apart meet in one of the two. Rows come sorted and stream by: of a variant only its first owner is
    kept until its cell ends, so a task holds 65536 numbers at most.
    """
    high = F.shiftrightunsigned("key", 32) == 1
    low32, high32 = F.col("fp").bitwiseAND(LOW), F.shiftrightunsigned("fp", 32)
    exact = F.when(high, high32).otherwise(low32) == F.col("key").bitwiseAND(LOW)
    other = F.when(high, low32).otherwise(high32)
    variants = F.when(exact, F.array(*[other.bitwiseXOR(F.lit(f).cast("long")) for f in FLIPS])).otherwise(F.array(other))
    v = members.select("key", "fp", F.explode(variants).alias("v"))
    upper, lower = F.shiftright("v", 16), F.col("v").bitwiseAND(0xFFFF)
    cells = F.array(F.struct(upper.alias("cell"), lower.alias("rest")), F.struct((lower + (1 << 16)).alias("cell"), upper.alias("rest")))
    v = v.select("key", F.explode(cells).alias("x"), "fp").select("key", "x.cell", "x.rest", "fp")

    def one_bit_apart(cell: np.ndarray, rest: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Owners of variants of one cell that differ in a bit. cell: ascending numbers; rest: ascending in a cell."""
        place = cell << 16 | rest
        src, dst = [], []
        for bit in range(16):
            at = np.searchsorted(place, place ^ (1 << bit))
            at[at == len(place)] = 0
            hit = np.flatnonzero((place[at] == place ^ (1 << bit)) & (at > np.arange(len(place))) & (owner[at] != owner))
            src.append(owner[hit]), dst.append(owner[at[hit]])
        return np.concatenate(src), np.concatenate(dst)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64)] * 4  # first owners of the variants of the last cell so far
        for batch in batches:
            if not len(batch):
                continue
            key, cell, rest, fp = (np.concatenate([a, batch.column(c).to_numpy(zero_copy_only=False)]) for a, c in zip(kept, ("key", "cell", "rest", "fp")))
            new_cell = np.concatenate([[True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])])
            new = new_cell | np.concatenate([[True], rest[1:] != rest[:-1]])
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            same = np.flatnonzero(~new & (cell < 1 << 16))  # the other cell of an owner tells the same
            number = np.cumsum(new_cell) - 1
            whole = new & (number < number[-1])
            a, b = one_bit_apart(number[whole], rest[whole], fp[whole])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([fp[same], a])), pa.array(np.concatenate([fp[first[same]], b]))], ["src", "dst"])
            last = new & (number == number[-1])
            kept = [x[last] for x in (key, cell, rest, fp)]
        a, b = one_bit_apart(np.zeros(len(kept[2]), np.int64), kept[2], kept[3])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["src", "dst"])

    return v.repartition("key", "cell").sortWithinPartitions("key", "cell", "rest", "fp").mapInArrow(run, "src long, dst long")


def links(fps: DataFrame, most: int = 20_000, broadcast_keys: int = 100_000) -> DataFrame:
    """(src, dst): links that join all fingerprints within 3 bits of each other. fps: one row per distinct fp.

    Keys of up to ``most`` members are one task's; those above are split. The heavy keys are broadcast if they are ``broadcast_keys`` or fewer."""
    low, high = F.col("fp").bitwiseAND(LOW), F.shiftrightunsigned("fp", 32)
    keys = F.array(*[low.bitwiseXOR(F.lit(f).cast("long")) for f in FLIPS], *[high.bitwiseXOR(F.lit(f).cast("long")) + (1 << 32) for f in FLIPS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; a key's rows may reach over several batches."""
        rest: list[tuple[np.ndarray, np.ndarray]] = []  # of the last key so far

        def found(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            new = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(k)))
            two = starts[sizes == 2]
            near = np.bitwise_count(f[two] ^ f[two + 1]) <= RADIUS
            src, dst = [f[two][near]], [f[two + 1][near]]
            for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
                a, b = links_of_key(int(k[s]), np.sort(f[s:s + n]))
                src.append(a), dst.append(b)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64), pa.int64()) for x in (src, dst)], ["src", "dst"])

        release()
        for batch in batches:
            k = batch.column("key").to_numpy(zero_copy_only=False)
            f = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            if not len(k):
                continue
            last = int(np.searchsorted(k, k[-1]))
            if last or (rest and rest[0][0][0] != k[0]):
                yield found(*(np.concatenate(x) for x in zip(*rest, (k[:last], f[:last]))))
                rest = []
            rest.append((k[last:].copy(), f[last:].copy()))
        if rest:
            yield found(*(np.concatenate(x) for x in zip(*rest)))

    def light(members: DataFrame) -> DataFrame:
        return members.repartition("key").sortWithinPartitions("key").mapInArrow(run, "src long, dst long")

    spread = fps.select(F.explode(keys).alias("key"), "fp")
    heavy = cut(heavy_keys(fps, most))
    n = heavy.count()
    if not n:
        return light(spread).distinct()
    told = F.broadcast(heavy) if n <= broadcast_keys else heavy
    split = links_of_heavy_keys(spread.join(told, "key", "left_semi"))
    return light(spread.join(told, "key", "left_anti")).unionByName(split).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs (doc_id, text).

    doc_id may be of any type that can be ordered. Documents whose fingerprints differ in 3 bits or fewer are linked; component_id is the smallest doc_id
    reachable over links. Word-less and null texts have fingerprint zero and are linked like any other. Rows that
    repeat a doc_id are kept; a null doc_id never names a component unless it has no other. No rows give no
    rows. Other columns are ignored.
    """
    d = cut(fingerprints(docs))
    fps = cut(d.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(links(fps.select("fp")))
    grouped = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    of_root = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.select("fp", "root").join(of_root, "root").select("fp", "component_id")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return d.join(named, "fp").select("doc_id", text.alias("fingerprint"), "component_id")
