"""Exact top-k by inner product: best-first search in M-trees.

Vectors are cut into trees of bounded size by a hash.  With a further component
sqrt(M^2 - |x|^2), M the largest norm of the tree, the nearest vector of a query is the
one of highest inner product, so a metric tree applies.  Its pages hold routing objects
with covering radii and distances to their parent; the stored distances spare most
computations by the triangle inequality, and nodes are taken by their best bound.
Scores are integers; bounds are widened by a margin far above rounding error, and a
node is left out only if it cannot even tie.

Defined cases: vectors that are null or hold null or non-finite components and rows
without id take no part; a row repeated whole is a candidate as often as it is there, and
so is a query; rows of another length are no candidates; an id that repeats, with the same
vector or others, is several rows, of which a query skips all with its own id; an empty
table gives no rows.  A vector whose products with itself might pass a long (a norm of
2^31 or more after scaling) raises an error, as scores would be wrong in silence.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftworks.llm.frames import stored

K = 5
EVERY = 50
TREE_ROWS = 4096
PAGE = 128
QUERY_BLOCK = 4096


class MTree:
    """A bulk-loaded M-tree over integer vectors; equal vectors are one object."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, page: int = PAGE):
        order = np.lexsort((ids, *vectors.T[::-1])) if vectors.shape[1] else np.argsort(ids)
        vectors, ids = vectors[order], ids[order]
        new = np.ones(len(ids), bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
        at = np.flatnonzero(new)
        self.ids = np.split(ids, at[1:])  # of each object, ascending
        self.objects = vectors[at]
        self.as_float = self.objects.astype(np.float64)
        squares = (self.as_float**2).sum(axis=1)
        self.top = float(squares.max())
        self.lift = np.sqrt(np.maximum(self.top - squares, 0.0))
        self.page = page
        # Per node: is it a leaf, entries (objects or nodes), their distance to the
        # node's routing object, and for nodes below their routing objects and radii.
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(at)), None)[0]

    def _distance(self, objects: np.ndarray, pivot: int) -> np.ndarray:
        d2 = ((self.as_float[objects] - self.as_float[pivot]) ** 2).sum(axis=1)
        return np.sqrt(d2 + (self.lift[objects] - self.lift[pivot]) ** 2)

    def _build(self, members: np.ndarray, pivot: int | None) -> tuple[int, float]:
        """Number of the new node, and its radius around ``pivot``."""
        to_pivot = np.zeros(len(members)) if pivot is None else self._distance(members, pivot)
        radius = float(to_pivot.max())
        if len(members) <= self.page:
            self.nodes.append((True, members, to_pivot, None, None))
            return len(self.nodes) - 1, radius
        # Routing objects far from each other, each the farthest from those before.
        count = min(self.page, 2 + len(members) // self.page)
        pivots, nearest = [int(members[0])], self._distance(members, int(members[0]))
        owner = np.zeros(len(members), np.int64)
        while len(pivots) < count and nearest.max() > 0:
            pivots.append(int(members[nearest.argmax()]))
            d = self._distance(members, pivots[-1])
            closer = d < nearest
            owner[closer], nearest = len(pivots) - 1, np.minimum(nearest, d)
        built = [(p, *self._build(members[owner == i], p)) for i, p in enumerate(pivots)]
        routing = np.array([b[0] for b in built])
        distance = np.zeros(len(built)) if pivot is None else self._distance(routing, pivot)
        children, radii = np.array([b[1] for b in built]), np.array([b[2] for b in built])
        self.nodes.append((False, children, distance, routing, radii))
        return len(self.nodes) - 1, radius

    def search(self, query: np.ndarray, k: int, own: int) -> list[tuple[int, int]]:
        """(score, id) of the best ``k`` objects, ties to smaller ids."""
        q = query.astype(np.float64)
        q2 = float(q @ q)
        both = self.top + q2
        margin = 1e-6 * (both + 1.0)
        best: list[tuple[int, int]] = []

        def limit() -> float:
            """Nothing farther than this can be among the best."""
            if len(best) < k:
                return np.inf
            return np.sqrt(max(0.0, both - 2.0 * best[-1][0] + margin)) + 1e-6

        def distances(objects: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(both - 2.0 * (self.as_float[objects] @ q), 0.0))

        # (bound, node, distance of the query to the node's routing object or None)
        heap: list[tuple] = [(0.0, self.root, None)]
        while heap:
            bound, node, to_pivot = heapq.heappop(heap)
            reach = limit()
            if bound > reach:
                break
            leaf, entries, stored_distance, routing, radii = self.nodes[node]
            if to_pivot is not None:
                # |d(q, parent) - d(entry, parent)| <= d(q, entry): no computation.
                far = np.abs(to_pivot - stored_distance) - (0.0 if leaf else radii)
                near = np.flatnonzero(far <= reach)
            else:
                near = np.arange(len(entries))
            if not len(near):
                continue
            if leaf:
                objects = entries[near]
                scores = self.objects[objects] @ query
                if len(best) >= k:
                    good = scores >= best[-1][0]
                    objects, scores = objects[good], scores[good]
                if len(scores) > k:  # of more objects, all that tie with the k-th
                    kth = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                    good = scores >= kth
                    objects, scores = objects[good], scores[good]
                for o, s in zip(objects.tolist(), scores.tolist(), strict=True):
                    found = self.ids[o]
                    begin, end = np.searchsorted(found, [own, own], "left")[0], np.searchsorted(found, own, "right")
                    others = np.concatenate([found[: min(begin, k)], found[end : end + k]])[:k]
                    best += [(s, i) for i in others.tolist()]
                best = sorted(best, key=lambda x: (-x[0], x[1]))[:k]
            else:
                d = distances(routing[near])
                lower = np.maximum(d - radii[near], 0.0)
                for j in np.flatnonzero(lower <= reach).tolist():
                    heapq.heappush(heap, (float(lower[j]), int(entries[near[j]]), float(d[j])))
        return best


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, v, dim): finite vectors scaled to whole numbers."""
    fine = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    whole = F.forall(
        "embedding",
        lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)),
    )
    scaled = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("long"))
    # Two norms below 2^31 have a product below 2^62.
    square = F.aggregate(
        "embedding", F.lit(0.0), lambda acc, x: acc + F.floor(256 * x.cast("double")).cast("double") * F.floor(256 * x.cast("double"))
    )
    error = F.raise_error(F.lit("a vector is too long for its scores to be whole numbers of 64 bits"))
    checked = F.when(square < 2.0**62, scaled).otherwise(error.cast("array<bigint>"))
    return rows.filter(fine & whole).select("vec_id", checked.alias("v"), F.size("embedding").alias("dim"))


def top_k(rows: DataFrame, k: int = K, every: int = EVERY, tree_rows: int = TREE_ROWS) -> DataFrame:
    """For each row whose id is divisible by ``every``: its k best other rows.

    The stated queries go to every tree, in blocks: a task holds one tree and one
    block of queries, both of bounded size, and returns k rows a query.
    """
    found = stored(usable(rows), "topk-rows")
    n = found.count()
    trees = max(1, -(-n // tree_rows))
    # A row is known by its file and its place in it, so rows that are repeated stay apart.
    place = F.concat_ws(":", "_metadata.file_name", F.col("_metadata.row_index").cast("string"))
    part = lambda m: F.pmod(F.xxhash64(place), F.lit(m)).cast("int")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    data = found.select("vec_id", "v", "dim", part(trees).alias("tree"))
    queries = found.filter(F.col("vec_id") % every == 0).select("vec_id", "v", "dim", place.alias("place"))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    queries = queries.withColumns({"block": F.pmod(F.xxhash64("place"), F.lit(blocks)).cast("int"), "tree": everywhere})
    data = data.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    schema = "query_id long, place string, vec_id long, score long"
    arrow = pa.schema({"query_id": pa.int64(), "place": pa.string(), "vec_id": pa.int64(), "score": pa.int64()})
    keys = ["dim", "tree", "block"]

    def matrix(table: pa.Table) -> np.ndarray:
        lists = table["v"].combine_chunks()
        return lists.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            tree = MTree(matrix(left), left["vec_id"].to_numpy())
            asked = zip(right["vec_id"].to_pylist(), right["place"].to_pylist(), matrix(right), strict=True)
            for own, at, query in asked:
                out += [(own, at, i, s) for s, i in tree.search(query, k, own)]
        columns = list(zip(*out, strict=True)) if out else [()] * len(arrow)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    local = data.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(search, schema)
    best = Window.partitionBy("query_id", "place").orderBy(F.desc("score"), "vec_id")
    return (
        local.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def topk_digest(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings.select("vec_id", "embedding"))


ORACLE = """
WITH rows AS (
  SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.place, q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM rows q JOIN rows c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 5
"""
