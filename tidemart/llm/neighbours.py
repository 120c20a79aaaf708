"""Nearest neighbours by cosine: a vantage-point tree per shard, searched with relaxed triangle-inequality pruning.

Vectors are dealt to shards by a hash of their id. Each shard builds one vantage-point tree over unit vectors; the distance is the
chord |a - b|, a metric that orders like cosine. Every query visits every shard's tree. At a node with vantage point v and
middle distance m, the side that may hold a nearer vector than the current k-th distance t is known from the triangle
inequality: the inner side can be left out if d(q, v) - m > t, the outer one if m - d(q, v) > t. ``relax`` multiplies that
bound: 1 is exact, larger values leave out a side if relax * |d - m| > t. Equal vectors are one point of the tree. Queries go down the tree together, so each node is one matrix
product. What is reported is scored again on the original vectors in double precision.

A shard's tree is built once, from the shard's rows, which come first in a task's stream; the queries stream past it in batches, so a task
holds one shard and one batch of queries. The best of a query are reduced per group of shards, and then over the groups.
Rows with equal (id, vector) copies beyond k + 1 in one shard cannot be among a query's k nearest and are not sent on.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, or whose length is not ``dim`` (by default
the most frequent length of the rows, of equally frequent ones the larger), take no part, neither as query nor as candidate; rows with a null id likewise. Rows with an equal id are separate candidates;
a query never meets rows of its own id. Query rows that are equal in id and vector are one query with one result; an id on
different vectors is a query for each of them, and each has its own ranks under that id. Ties go to the smaller id. With fewer candidates than k all are returned. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


K = 5
RELAX = 5.0
LEAF = 96
SHARD_ROWS = 8192
SEED = 11


def valid(vector: Column) -> Column:
    """A vector takes part if it has components, all of them finite, and a length that is neither zero nor infinite."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(whole, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


class Tree:
    """A vantage-point tree in flat arrays: nodes in preorder, rows reordered so that each node owns a range of them."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF, seed: int = SEED):
        self.v, self.leaf = vectors, leaf
        self.order = np.arange(len(vectors))
        self.nodes: list[tuple[int, int, float, int]] = []  # begin, end, middle, node of the outer side (0: leaf)
        self._build(0, len(vectors), np.random.default_rng(seed))
        self.v = np.ascontiguousarray(vectors[self.order])

    def _build(self, begin: int, end: int, rng: np.random.Generator) -> int:
        at = len(self.nodes)
        self.nodes.append((begin, end, 0.0, 0))
        if end - begin <= self.leaf:
            return at
        pick = begin + int(rng.integers(end - begin))
        self.order[[begin, pick]] = self.order[[pick, begin]]
        inside = self.order[begin + 1 : end]
        d = chord(self.v[self.order[begin]][None, :], self.v[inside])[0]
        rank = np.argsort(d, kind="stable")
        half = len(rank) // 2
        self.order[begin + 1 : end] = inside[rank]
        middle = float(d[rank[half]])
        self._build(begin + 1, begin + 1 + half, rng)
        outer = self._build(begin + 1 + half, end, rng)
        self.nodes[at] = (begin, end, middle, outer)
        return at


def chord(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


class Search:
    """The k nearest rows of a tree for many queries at once."""

    def __init__(self, tree: Tree, ids: np.ndarray, queries: np.ndarray, k: int, relax: float):
        self.t, self.ids, self.q, self.k, self.relax = tree, ids[tree.order], queries, k, relax
        self.best = np.full((len(queries), k), np.inf)
        self.row = np.full((len(queries), k), -1, np.int64)
        self.visited = 0

    def offer(self, who: np.ndarray, d: np.ndarray, rows: np.ndarray) -> None:
        """Merge the distances d[who, rows] into the lists; ties by id."""
        some = (d <= self.best[who, -1][:, None]).any(axis=1)
        if not some.any():
            return
        who, d = who[some], d[some]
        # Of the new distances only the k smallest (and their ties) of a query can enter.
        if d.shape[1] > self.k:
            edge = np.partition(d, self.k - 1, axis=1)[:, self.k - 1]
            use = (d <= edge[:, None]).any(axis=0)
            d, rows = d[:, use], rows[use]
        all_d = np.concatenate([self.best[who], d], axis=1)
        all_r = np.concatenate([self.row[who], np.broadcast_to(rows, d.shape)], axis=1)
        id_of = np.where(all_r >= 0, self.ids[all_r], np.iinfo(np.int64).max)
        first = np.lexsort((id_of, all_d), axis=1)[:, : self.k]
        self.best[who] = np.take_along_axis(all_d, first, 1)
        self.row[who] = np.where(np.isfinite(self.best[who]), np.take_along_axis(all_r, first, 1), -1)

    def run(self, at: int, who: np.ndarray) -> None:
        if not len(who):
            return
        begin, end, middle, outer = self.t.nodes[at]
        if not outer:
            rows = np.arange(begin, end)
            self.visited += len(who) * len(rows)
            if len(rows):
                self.offer(who, chord(self.q[who], self.t.v[begin:end]), rows)
            return
        d = chord(self.q[who], self.t.v[begin : begin + 1])
        self.visited += len(who)
        self.offer(who, d, np.array([begin]))
        d = d[:, 0]
        # The small slack keeps rounding from turning a bound that is met into one that is missed.
        may = lambda some: some[self.relax * (np.abs(d - middle)[np.isin(who, some, assume_unique=True)] - 1e-9) <= self.best[some, -1]]
        inner_first, outer_first = who[d <= middle], who[d > middle]
        self.run(at + 1, inner_first)
        self.run(outer, may(inner_first))
        self.run(outer, outer_first)
        self.run(at + 1, may(outer_first))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, from the original vectors."""
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


class Shard:
    """The rows of a shard as a tree over their distinct vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int):
        first = np.argsort(ids, kind="stable")
        self.ids, vectors = ids[first], vectors[first] + 0.0  # a negative zero equals a zero
        self.points, of = np.unique(vectors, axis=0, return_inverse=True)
        self.members = np.argsort(of, kind="stable")  # by class, then by id
        self.begin = np.searchsorted(of[self.members], np.arange(len(self.points) + 1))
        self.tree = Tree(unit(self.points), leaf)

    def find(self, own: np.ndarray, q: np.ndarray, k: int, relax: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the query, id and score of what is near it."""
        begin, members = self.begin, self.members
        # Beside the query's own point a few more than k, so that the exact scores below decide about near ties.
        s = Search(self.tree, self.ids[members[begin[:-1]]], unit(q), k + 4, relax)
        s.run(0, np.arange(len(q)))
        who, place = np.nonzero(s.row >= 0)
        point = self.tree.order[s.row[who, place]]
        score = cosine(q[who], self.points[point])
        # Each found point stands for its k + 1 smallest ids, one of which may be the query's own.
        copies = np.minimum(begin[point + 1] - begin[point], k + 1)
        each = np.repeat(np.arange(len(who)), copies)
        nth = np.arange(len(each)) - np.repeat(np.cumsum(copies) - copies, copies)
        vec_id = self.ids[members[begin[point[each]] + nth]]
        other = vec_id != own[who[each]]
        return who[each][other], vec_id[other], score[each][other]


FOUND = pa.schema([("query_id", pa.int64()), ("ask", pa.int64()), ("part", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])


def searched(batches: Iterator[pa.RecordBatch], k: int, relax: float, leaf: int, groups: int) -> Iterator[pa.RecordBatch]:
    """Streams shard after shard: first its rows (no ``ask``), then the queries."""
    now, held, shard = None, [], None
    for batch in batches:
        numbers = batch.column("shard").to_numpy()
        asked = batch.column("ask").is_valid().to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.append(True, (numbers[1:] != numbers[:-1]) | (asked[1:] != asked[:-1])))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), batch.num_rows], strict=True):
            part = batch.slice(a, b - a)
            if numbers[a] != now:
                now, held, shard = int(numbers[a]), [], None
            own, q = part.column("id").to_numpy(), matrix(part.column("vec"))
            if not asked[a]:
                held.append((own, q))
                continue
            if held:
                shard, held = Shard(np.concatenate([x for x, _ in held]), np.concatenate([v for _, v in held]), leaf), []
            if shard is None:  # a shard without rows
                continue
            who, vec_id, score = shard.find(own, q, k, relax)
            name = part.column("ask").to_numpy()
            columns = [own[who], name[who], np.full(len(who), now % groups, np.int32), vec_id, score]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND, strict=True)], schema=FOUND)


def nearest(
    rows: DataFrame, queries: DataFrame, id_column: str = "vec_id", vector: str = "embedding", k: int = K, relax: float = RELAX,
    shard_rows: int = SHARD_ROWS, leaf: int = LEAF, dim: int | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query its k nearest rows, nearest first."""
    clean = lambda df: df.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec")).where(F.col("id").isNotNull() & valid(F.col("vec")))
    sized = clean(rows).groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    found = (sized.where(F.col("d") == dim) if dim else sized).orderBy(F.desc("n"), F.desc("d")).first()
    length, n = (found.d, found.n) if found else (dim or 1, 0)
    whole = lambda df: clean(df).where(F.size("vec") == length)
    shards = max(1, -(-n // shard_rows))
    groups = max(1, int(shards**0.5))
    # Equal ids are dealt by their vector too, so repeated rows do not fill one shard.
    points = whole(rows).select("id", "vec", F.lit(None).cast("long").alias("ask"), F.pmod(F.xxhash64("id", "vec"), F.lit(shards)).cast("int").alias("shard"))
    asked = whole(queries).dropDuplicates(["id", "vec"]).select("id", "vec", F.xxhash64("id", "vec").alias("ask"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    stream = points.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", F.col("ask").asc_nulls_first())
    schema = "query_id long, ask long, part int, vec_id long, score double"
    near = stream.mapInArrow(lambda batches: searched(batches, k, relax, leaf, groups), schema)
    best = lambda c: F.slice(F.sort_array(F.collect_list(c)), 1, k)
    first = near.groupBy("query_id", "ask", "part").agg(best(F.struct((-F.col("score")).alias("far"), "vec_id", "score")).alias("best"))
    top = first.groupBy("query_id", "ask").agg(F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    return top.select("query_id", F.posexplode("best").alias("rank", "b")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score")
    )
