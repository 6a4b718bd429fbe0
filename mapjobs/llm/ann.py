"""Approximate nearest neighbours (operator 8): a neighbour graph by NN-descent, queries by greedy graph search.

Equal vectors are one class, so a vector that is very common is one node; its smallest members stand for it in answers. Nodes travel
with their vectors in 16 bits a component and a scale of their own, so norms may differ by any factor; distances are double, and answers are ranked on the
original vectors.

* Start: every node is dealt into a few small random blocks and lists those it meets there, about ten random nodes.
* NN-descent (Dong, Moses, Li 2011): every node sends its vector to the nodes it lists and to those that list it. Each node compares
  all it has received with each other, if one of the two is new there, and proposes the nearest. Lists are merged in a shuffle on
  the node. A node hears a sample of those that list it, drawn before vectors are sent, so hubs stay bounded.
* Search: a query starts from its own list and expands its nearest unexpanded nodes round by round; adjacency with the neighbours'
  vectors stays partitioned by node, so a round moves the query's frontier only.

Groups are streamed from sorted partitions; no task holds more than a batch and one node's lists. Each round is checkpointed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window as W, functions as F

from mapjobs.llm.common import release
from mapjobs.session import cut, partitions

LISTS = "id long, vec binary, ids array<long>, ds array<double>, fresh array<boolean>"
FAR = np.inf
#: Largest code of a component.
MOST_CODE = 32767


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) without rows that take no part: null, empty or zero vectors, null or non-finite components, null ids."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    v = v.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    return v.where(finite & F.exists("embedding", lambda x: x != 0))


def encoded(v: np.ndarray, dim: int) -> list[bytes]:
    """Rows of v, padded to ``dim`` components: a scale (8 bytes) and 16 bits for each component."""
    scale = np.abs(v).max(1) / MOST_CODE
    scale[scale == 0] = np.finfo(float).tiny  # components too small for a scale
    codes = np.zeros((len(v), dim), "<i2")
    codes[:, :v.shape[1]] = np.rint(v / scale[:, None])
    return [s + c.tobytes() for s, c in zip(map(bytes, scale.astype("<f8").view("V8")), codes)]


def decoded(column, dim: int) -> np.ndarray:
    """The vectors of a binary column, each value one or more of them in a row."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 8 + 2 * dim)
    return np.ascontiguousarray(raw[:, 8:]).view("<i2") * np.ascontiguousarray(raw[:, :8]).view("<f8")


def _rows(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Sorted batches cut at changes of the key: all rows of a key come in one table. For keys with few rows."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        k = batch.column(key).to_numpy()
        first, last = int(np.searchsorted(k, k[0], "right")), int(np.searchsorted(k, k[-1]))
        if rest and rest[0].column(key)[0].as_py() != k[0]:
            yield pa.Table.from_batches(rest).combine_chunks()
            rest = []
        if last:
            done = [*rest, batch.slice(0, first)]
            yield pa.Table.from_batches(done).combine_chunks()
            if last > first:
                yield pa.Table.from_batches([batch.slice(first, last - first)])
            rest = []
        rest.append(batch.slice(last))
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks()


def _flat(t, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(values, row of each value) of a list column."""
    lists = t.column(name)
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())


def _lists(row: np.ndarray, n: int, *values: tuple[np.ndarray, pa.DataType]) -> list[pa.Array]:
    """List columns of n rows from flat values sorted by row."""
    offsets = pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32())
    return [pa.ListArray.from_arrays(offsets, pa.array(v, kind)) for v, kind in values]


def _nearest(at, cand, ds, fresh, old, most: int):
    """Of each node's candidates the ``most`` nearest different ones, sorted by node and distance. Of two entries of one candidate the old one counts."""
    o = np.lexsort((~old, cand, at))
    at, cand, ds, fresh, old = at[o], cand[o], ds[o], fresh[o], old[o]
    first = np.ones(len(at), bool)
    first[1:] = (at[1:] != at[:-1]) | (cand[1:] != cand[:-1])
    at, cand, ds, fresh, old = at[first], cand[first], ds[first], fresh[first], old[first]
    o = np.lexsort((cand, ds, at))
    at, cand, ds, fresh, old = at[o], cand[o], ds[o], fresh[o], old[o]
    near = np.arange(len(at)) - np.searchsorted(at, at) < most
    return at[near], cand[near], ds[near], fresh[near], old[near]


def _merged(rows: DataFrame, most: int, keep_flags: bool) -> DataFrame:
    """One row per id with its ``most`` nearest candidates. rows: LISTS; those with a vector are the lists so far, the others proposals.

    A candidate that was listed before keeps its flag, or loses it unless ``keep_flags``; a new one is fresh. Batches are merged as they come, and
    only the last node's list is carried on, however many proposals a node has."""
    def run(batches):
        release()
        none = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, bool), np.zeros(0, bool)
        last, vec, carried = None, None, none

        def out(ids, vecs, at, cand, ds, fresh, old):
            fresh = ~old | (fresh & keep_flags)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary()), *_lists(at, len(ids), (cand, pa.int64()), (ds, pa.float64()), (fresh, pa.bool_()))], ["id", "vec", "ids", "ds", "fresh"])

        for b in batches:
            if not len(b):
                continue
            ids, heads = b.column("id").to_numpy(), b.column("vec").is_valid().to_numpy(zero_copy_only=False)
            cand, row = _flat(b, "ids")
            ds, fresh = _flat(b, "ds")[0], _flat(b, "fresh")[0].astype(bool)
            cand, ds = (cand.astype(np.int64), ds.astype(float)) if len(cand) else none[:2]
            names, node = np.unique(ids, return_inverse=True)
            names, vecs = names.tolist(), [None] * len(names)
            for i in np.flatnonzero(heads):
                vecs[node[i]] = b.column("vec")[int(i)].as_py()
            parts = [node[row], cand, ds, fresh, heads[row]]
            if last is not None:
                if names[0] != last:
                    names, vecs = [last, *names], [None, *vecs]
                    parts[0] = parts[0] + 1
                vecs[0] = vecs[0] if vec is None else vec
                parts = [np.concatenate(x) for x in zip((np.zeros(len(carried[0]), np.int64), *carried), parts)]
            at, *rest = _nearest(*parts, most)
            end = int(np.searchsorted(at, len(names) - 1))
            if len(names) > 1:
                yield out(names[:-1], vecs[:-1], at[:end], *(x[:end] for x in rest))
            last, vec, carried = names[-1], vecs[-1], tuple(x[end:] for x in rest)
        if last is not None:
            yield out([last], [vec], np.zeros(len(carried[0]), np.int64), *carried)

    return rows.repartition("id").sortWithinPartitions("id").mapInArrow(run, LISTS)


def _proposals(names: np.ndarray, row: np.ndarray, cand: np.ndarray, ds: np.ndarray) -> pa.RecordBatch:
    n = len(names)
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.nulls(n, pa.binary()), *_lists(row, n, (cand, pa.int64()), (ds, pa.float64()), (np.ones(len(cand), bool), pa.bool_()))], ["id", "vec", "ids", "ds", "fresh"])


def _square(v: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all rows; leading axes are blocks."""
    n = (v * v).sum(-1)
    return np.maximum(n[..., :, None] + n[..., None, :] - 2 * (v @ np.swapaxes(v, -1, -2)), 0)


def _compared(block: np.ndarray, rank: np.ndarray, member: np.ndarray, v: np.ndarray, bound: np.ndarray, fresh: np.ndarray, offer: int) -> pa.RecordBatch | None:
    """Proposals to each member of each block: its ``offer`` nearest others there, nearer than its bound, where one of the two is fresh."""
    n, width = int(block[-1]) + 1, int(rank.max()) + 1
    names, far = np.full((n, width), -1, np.int64), np.full((n, width), -FAR)
    new, there, vec = np.zeros((n, width), bool), np.zeros((n, width), bool), np.zeros((n, width, v.shape[1]))
    names[block, rank], far[block, rank], new[block, rank], there[block, rank], vec[block, rank] = member, bound, fresh, True, v
    d = _square(vec)
    d[~there[:, None, :] | (names[:, :, None] == names[:, None, :]) | ~(new[:, :, None] | new[:, None, :]) | (d >= far[:, :, None])] = FAR
    k = min(offer, width)
    near = np.argpartition(d, k - 1, axis=2)[:, :, :k]
    dn = np.take_along_axis(d, near, 2)
    good = dn < FAR
    i, j, _ = np.nonzero(good)
    cand = np.take_along_axis(np.broadcast_to(names[:, None, :], d.shape), near, 2)[good]
    used, row = np.unique(i * width + j, return_inverse=True)
    return _proposals(names.ravel()[used], row, cand, dn[good]) if len(used) else None


def _places(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each row's group, its place there) of sorted keys."""
    group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
    return group, np.arange(len(key)) - np.searchsorted(group, group)


def _start(nodes: DataFrame, dim: int, tables: int, leaf: int, whole: int) -> DataFrame:
    """Proposals of random neighbours: in each of ``tables`` turns all nodes are dealt into blocks of ``leaf`` by a hash. Nodes of another length
    never share a block, so they never meet later. Lengths of ``whole`` nodes or fewer are one block."""
    of_length = nodes.groupBy("length").agg(F.count("*").alias("n"))
    of_length = of_length.select("length", F.when(F.col("n") <= whole, F.col("n")).otherwise(leaf).alias("leaf"), F.greatest(F.floor(F.col("n") / (8 * leaf)), F.lit(1)).alias("buckets"))
    s = nodes.join(of_length.withColumn("buckets", F.when(F.col("leaf") == leaf, F.col("buckets")).otherwise(1)), "length")
    s = s.withColumn("t", F.explode(F.array(*[F.lit(t) for t in range(tables)]))).withColumn("r", F.xxhash64("id", "t"))
    s = s.select(F.xxhash64("length", "t", F.pmod("r", "buckets")).alias("key"), "r", "leaf", "id", "vec")

    def run(batches):
        release()
        for t in _rows(batches, "key"):
            group, place = _places(t.column("key").to_numpy())
            leaf = t.column("leaf").to_numpy()
            block = np.cumsum(np.concatenate([[0], (group[1:] != group[:-1]) | (place[1:] % leaf[1:] == 0)])).astype(np.int64)
            for a in range(0, int(block[-1]) + 1, 1000):
                lo, hi = np.searchsorted(block, [a, a + 1000])
                n = hi - lo
                found = _compared(block[lo:hi] - a, _places(block[lo:hi])[1], t.column("id").to_numpy()[lo:hi], decoded(t.column("vec").slice(lo, n), dim), np.full(n, FAR), np.ones(n, bool), whole)
                if found is not None:
                    yield found

    return s.repartition("key").sortWithinPartitions("key", "r").mapInArrow(run, LISTS)


def _messages(graph: DataFrame, most: int, hear: int, turn: int, all_centers: bool) -> DataFrame:
    """(center, member, vec, kth, fresh), sorted by center: the vectors of the nodes that a center lists, and of some that list it, ``most`` + ``hear``
    together, drawn by a hash of the turn. Centers to which nothing is fresh are left out, unless ``all_centers``."""
    e = graph.select("id", F.explode(F.arrays_zip("ids", "fresh")).alias("e"))
    way = lambda center, back, member: F.struct(F.col(center).alias("center"), F.lit(back).alias("back"), F.col(member).alias("member"), F.col("e.fresh").alias("fresh"))
    both = e.select(F.explode(F.array(way("id", 0, "e.ids"), way("e.ids", 1, "id"))).alias("x")).select("x.*")
    # one shuffle of ids; the limit on the rank is applied before it too, so a hub gets few rows from each task
    w = W.partitionBy("center")
    both = both.withColumn("r", F.row_number().over(w.orderBy("back", F.xxhash64("member", F.lit(turn)), "member"))).where(F.col("r") <= most + hear)
    if not all_centers:
        both = both.withColumn("any", F.max("fresh").over(w)).where("any")
    kth = F.when(F.size("ds") < most, F.lit(float("inf"))).otherwise(F.element_at("ds", -1))
    sent = both.join(graph.select(F.col("id").alias("member"), "vec", kth.alias("kth")), "member").select("center", "member", "vec", "kth", "fresh")
    return sent.repartition("center").sortWithinPartitions("center")


def _by_center(batches, at_once: int = 256):
    """(number of each row's center, its place there, rows) for some centers at a time."""
    for t in _rows(batches, "center"):
        node, rank = _places(t.column("center").to_numpy())
        for a in range(0, int(node[-1]) + 1, at_once):
            lo, hi = np.searchsorted(node, [a, a + at_once])
            yield node[lo:hi] - a, rank[lo:hi], t.slice(lo, hi - lo)


def _join_lists(graph: DataFrame, dim: int, most: int, hear: int, offer: int, turn: int) -> DataFrame:
    """Proposals from comparing all that each node has received."""
    def run(batches):
        release()
        for node, rank, t in _by_center(batches):
            found = _compared(node, rank, t.column("member").to_numpy(), decoded(t.column("vec"), dim), t.column("kth").to_numpy(), t.column("fresh").to_numpy(), offer)
            if found is not None:
                yield found

    return _messages(graph, most, hear, turn, False).mapInArrow(run, LISTS)


def neighbour_graph(nodes: DataFrame, dim: int, *, most: int = 28, tables: int = 3, leaf: int = 4, whole: int = 32, rounds: int = 7, hear: int = 20, offer: int = 4) -> DataFrame:
    """LISTS: the ``most`` nearest found of each node, nearest first. nodes: (id, length, vec), vec from ``encoded``."""
    blank = nodes.select("id", "vec", F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<double>").alias("ds"), F.lit(None).cast("array<boolean>").alias("fresh"))
    graph = cut(_merged(blank.unionByName(_start(nodes, dim, tables, leaf, whole)), most, False))
    for turn in range(rounds):
        if _settled(graph):
            break
        graph = cut(_merged(graph.unionByName(_join_lists(graph, dim, most, hear, offer, turn)), most, False))
    return graph


def _settled(lists: DataFrame) -> bool:
    """Nothing in the lists is fresh, so another round would change nothing."""
    return lists.where(F.exists("fresh", lambda x: x)).isEmpty()


def _adjacency(graph: DataFrame, dim: int, most: int, hear: int) -> DataFrame:
    """(node, near, vecs): neighbours either way, and their vectors in a row; some 2 KB a row, so that batches stay small."""
    wide = 8 + 2 * dim
    per = max(1, 2048 // wide)

    def run(batches):
        release()
        for node, rank, t in _by_center(batches):
            begin = np.flatnonzero(rank % per == 0)
            data = t.column("vec").to_pylist()
            vecs = [b"".join(data[a:b]) for a, b in zip(begin, [*begin[1:], len(node)])]
            piece = np.cumsum(rank % per == 0) - 1
            yield pa.RecordBatch.from_arrays([pa.array(t.column("center").to_numpy()[begin]), *_lists(piece, len(vecs), (t.column("member").to_numpy(), pa.int64())), pa.array(vecs, pa.binary())], ["node", "near", "vecs"])

    return _messages(graph, most, hear, -1, True).mapInArrow(run, "node long, near array<long>, vecs binary")


def greedy_search(queries: DataFrame, adjacency: DataFrame, dim: int, *, beam: int, expand: int, rounds: int) -> DataFrame:
    """LISTS of the ``beam`` nearest nodes found for each query. queries: LISTS with the nodes to start from, all fresh."""
    def look(batches):
        for b in batches:
            for a in range(0, len(b), 1000):
                s = b.slice(a, 1000)
                near, row = _flat(s, "near")
                if not len(near):
                    continue
                v = decoded(s.column("vecs"), dim)
                q = decoded(s.column("vec"), dim)[row]
                d = ((v - q) ** 2).sum(1)
                me = s.column("id").to_numpy()
                good = (d < s.column("bound").to_numpy()[row]) & (near != me[row])
                used, at = np.unique(row[good], return_inverse=True)
                if len(used):
                    yield _proposals(me[used], at, near[good], d[good])

    for _ in range(rounds):
        if _settled(queries):
            break
        # the nearest fresh nodes of each list are expanded; lists are sorted, so those behind the last of them stay fresh
        go = F.slice(F.filter(F.arrays_zip("ids", "fresh"), lambda x: x["fresh"]), 1, expand)
        q = queries.withColumn("go", F.transform(go, lambda x: x["ids"]))
        bound = F.when(F.size("ids") >= beam, F.element_at("ds", -1)).otherwise(F.lit(FAR))
        edge = q.select("id", "vec", bound.alias("bound"), F.explode("go").alias("node"))
        found = edge.join(adjacency, "node").mapInArrow(look, LISTS)
        last = F.when(F.size("go") > 0, F.array_position("ids", F.element_at("go", -1))).otherwise(0)
        left = q.select("id", "vec", "ids", "ds", F.transform("fresh", lambda x, i: x & (i >= last)).alias("fresh"))
        queries = cut(_merged(left.unionByName(found), beam, True))
    return queries


def nearest(vectors: DataFrame, is_query, *, k: int = 10, most: int = 28, rounds: int = 7, hear: int = 20, offer: int = 4, beam: int = 300, expand: int = 120, search_rounds: int = 5, rerank: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row, by Euclidean distance in double precision.

    vectors: (vec_id, embedding); is_query: a condition on vec_id. Every other usable row is a candidate (see ``usable``) if its vector is as long as
    the query's, as others have no distance to it; all of
    them, if they are fewer than k. Equal distances go to the smaller vec_id. Equal vectors share one node, which keeps its k + 1
    smallest ids: no answer needs more. Rows that repeat a vec_id with the same vector count once; with other vectors they are other candidates.
    No usable rows give no rows. Other columns are ignored.
    """
    v = usable(vectors)
    # the limit on the rank is applied before the shuffle too, so a very common vector sends k + 1 rows a task
    ranked = v.distinct().withColumn("r", F.row_number().over(W.partitionBy("embedding").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    classes = ranked.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))
    # numbers within sorted partitions: the same in every run over the same partitions, and never two nodes' own
    classes = cut(classes.sortWithinPartitions(F.col("members")[0], "embedding").select(F.monotonically_increasing_id().alias("id"), "embedding", "members"))
    dim = classes.agg(F.max(F.size("embedding"))).first()[0] or 1

    def packed(batches):
        release()
        for b in batches:
            x, row = _flat(b, "embedding")
            length = np.bincount(row, minlength=len(b))
            dense = np.zeros((len(b), dim))
            dense[row, np.arange(len(row)) - np.searchsorted(row, row)] = x
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(length, pa.int32()), pa.array(encoded(dense, dim), pa.binary())], ["id", "length", "vec"])

    nodes = cut(classes.select("id", "embedding").mapInArrow(packed, "id long, length int, vec binary"))
    graph = neighbour_graph(nodes, dim, most=most, rounds=rounds, hear=hear, offer=offer)
    adjacency = _adjacency(graph, dim, most, hear).repartition(partitions(v.sparkSession), "node").persist(StorageLevel.MEMORY_AND_DISK)
    asked = v.where(is_query).select(F.col("vec_id").alias("query_id"), "embedding").distinct().join(classes.select("embedding", "id"), "embedding").select("query_id", "id")
    asked = cut(asked)
    starts = graph.join(asked.select("id").distinct(), "id", "left_semi").withColumn("fresh", F.transform("fresh", lambda x: F.lit(True)))
    found = greedy_search(starts, adjacency, dim, beam=beam, expand=expand, rounds=search_rounds)
    adjacency.unpersist()
    near = found.select("id", F.explode(F.concat(F.array("id"), F.slice("ids", 1, rerank))).alias("other"))
    near = near.join(classes.select("id", F.col("embedding").alias("a")), "id")
    near = near.join(classes.select(F.col("id").alias("other"), F.col("embedding").alias("b"), "members"), "other")
    square = F.aggregate(F.zip_with("a", "b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    near = near.select("id", "other", F.sqrt(square).alias("score"), F.explode("members").alias("vec_id"))
    best = near.groupBy("id").agg(F.slice(F.array_sort(F.collect_set(F.struct("score", "vec_id", "other"))), 1, k + 1).alias("best"))
    # a row is its id and its vector: one is taken out of the k + 1
    mine = lambda x: (x["vec_id"] == F.col("query_id")) & (x["other"] == F.col("id"))
    own = asked.join(best, "id").select("query_id", F.slice(F.filter("best", lambda x: ~mine(x)), 1, k).alias("best"))
    out = own.select("query_id", F.posexplode("best").alias("rank", "x"))
    return out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
