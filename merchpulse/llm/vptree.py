"""Nearest neighbours by largest inner product: vantage-point trees per shard.

Every vector is indexed.  A shard (rows by hash of their id, about
``SHARD_ROWS`` of them) is one tree: inner nodes split by the median distance
to a vantage point, leaves hold vectors.  Inner products become distances by
one more coordinate: with R the largest norm, x -> (x, sqrt(R^2 - |x|^2)) and
q -> (q, 0) give |x' - q'|^2 = R^2 + |q|^2 - 2 <x, q>, so the nearest points
are those of the largest product.

The search skips a child when factor * (lower bound of the triangle
inequality) exceeds the query's k-th distance by more than rounding explains
(relative to R^2, as the lift cancels beside one very large vector).  Factor 1
restores exact search; a larger one prunes more and may lose neighbours.  In
leaves, points that a matrix product and its rounding bound leave possible get
scores on the original vectors in double precision, from the first component
to the last, and are kept by score and smallest id, so ties are never cut.

Defined cases: vectors that are null, zero or empty, or hold null or
non-finite components, take no part, neither do rows without an id; equal
vectors are one tree point that keeps its k + 1 smallest ids (more can never
be among the k nearest); a query's own id is not its neighbour; vectors of
another length than the query's are not compared; other columns are not
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchpulse.llm.tables import ship_package, written

SHARD_ROWS = 16_384
LEAF = 256
#: Queries are sent to the shards in blocks of so many.
QUERY_BLOCK = 8_192
#: Rounding of one operation on doubles.
UNIT = np.finfo(np.float64).eps / 2
#: Pairs of a query and a point that get exact scores at a time.
PAIRS = 1 << 18
INDEX_SCHEMA = "dim int, shard int, tree binary"
HIT_SCHEMA = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v array<double>)`` of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(v, lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & fine & some
    )


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    return np.asarray(flat.flatten(), np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def lifted(x: np.ndarray) -> np.ndarray:
    norms = np.einsum("ij,ij->i", x, x)
    return np.hstack([x, np.sqrt(np.maximum(norms.max(initial=0.0) - norms, 0.0))[:, None]])


def build_tree(points: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """Order of the points and nodes (first, last, vantage row, radius inside,
    smallest and largest distance of each child, children; -1 at a leaf)."""
    order, nodes, bounds = np.arange(len(points)), [], []

    def make(lo: int, hi: int) -> int:
        at = len(nodes)
        nodes.append([lo, hi, -1, -1, -1])
        bounds.append([0.0] * 4)
        if hi - lo > leaf:
            rows = order[lo:hi]
            centre = points[rows].mean(axis=0)
            vantage = rows[np.argmax(((points[rows] - centre) ** 2).sum(axis=1))]  # far from the others
            d = np.sqrt(((points[rows] - points[vantage]) ** 2).sum(axis=1))
            by = np.argsort(d, kind="stable")
            order[lo:hi], d = rows[by], d[by]
            mid = (hi - lo) // 2
            bounds[at] = [d[0], d[mid - 1], d[mid], d[-1]]
            nodes[at][2] = vantage
            nodes[at][3] = make(lo, lo + mid)
            nodes[at][4] = make(lo + mid, hi)
        return at

    if len(points):
        make(0, len(points))
    return {"order": order, "nodes": np.array(nodes, np.int64).reshape(-1, 5), "bounds": np.array(bounds, np.float64).reshape(-1, 4)}


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed from the first component to the last."""
    s = np.zeros(len(x))
    for a, b in zip(x.T, q.T):
        s += b * a
    return s


def search_tree(tree, queries, k: int, factor: float):
    """The ``k`` rows of ``tree["x"]`` with the largest (product, smallest id
    first) for each query, as (products, rows), padded with -infinity and -1.
    Queries walk the tree in groups: the nearer child first, then those that
    may still gain from the other.  With ``k`` rows in this order, no id of
    any other row is among a query's ``k`` best ids."""
    n, x, points = len(queries), tree["x"], tree["points"]
    best = np.full((n, k), -np.inf)
    found = np.full((n, k), -1, np.int64)
    order, nodes, bounds = tree["order"], tree["nodes"], tree["bounds"]
    low_id = tree["ids"][tree["first"][:-1]]
    lengths, query_lengths = np.sqrt((x**2).sum(axis=1)), np.sqrt((queries**2).sum(axis=1))
    lifted_queries = np.hstack([queries, np.zeros((n, 1))])
    radius, terms = lengths.max(initial=0.0), x.shape[1] + 8
    # two sums of a product differ by 2 * terms * UNIT * |x| * |q| at most
    slack = 4 * terms * UNIT
    # rounding of distances, node bounds and the lift, as a squared distance
    blur = 64 * terms * UNIT * (radius + query_lengths) ** 2
    far_off = radius**2 + query_lengths**2

    def leaf(rows: np.ndarray, active: np.ndarray) -> None:
        about = queries[active] @ x[rows].T
        spread = slack * query_lengths[active][:, None] * lengths[rows]
        least = best[active].min(axis=1)
        if len(rows) >= k:
            least = np.maximum(least, np.partition(about - spread, len(rows) - k, axis=1)[:, len(rows) - k])
        who, what = np.nonzero(about + spread >= least[:, None])
        if not len(who):
            return
        score = np.concatenate([products(x[rows[what[i : i + PAIRS]]], queries[active[who[i : i + PAIRS]]]) for i in range(0, len(who), PAIRS)])
        some = np.unique(who)
        who = np.concatenate([np.repeat(some, k), who])
        row = np.concatenate([found[active[some]].ravel(), rows[what]])
        score = np.concatenate([best[active[some]].ravel(), score])
        by = np.lexsort((low_id[row], -score, who))
        size = np.bincount(who)[some]
        first = np.cumsum(size) - size
        top = by[first[:, None] + np.arange(k)]
        best[active[some]], found[active[some]] = score[top], row[top]

    def visit(node: int, active: np.ndarray) -> None:
        if not len(active):
            return
        lo, hi, vantage, near, far = nodes[node]
        if vantage < 0:
            for i in range(0, len(active), 1024):
                leaf(order[lo:hi], active[i : i + 1024])
            return
        d = np.sqrt(((lifted_queries[active] - points[vantage]) ** 2).sum(axis=1))
        a, b, c, e = bounds[node]
        gaps = {near: np.maximum(np.maximum(a - d, d - b), 0.0), far: np.maximum(np.maximum(c - d, d - e), 0.0)}
        inside = gaps[near] <= gaps[far]
        for child, first in ((near, inside), (far, ~inside)):
            visit(child, active[first])
        for child, then in ((near, ~inside), (far, inside)):
            ids = active[then]
            # squared distances are far_off - 2 * product
            visit(child, ids[(factor * gaps[child][then]) ** 2 <= far_off[ids] - 2 * best[ids].min(axis=1) + blur[ids]])

    if len(x) and n:
        visit(0, np.arange(n))
    return best, found


def _pack(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def build_index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS, leaf: int = LEAF) -> DataFrame:
    """A row for each shard: its different vectors, their ids and the tree."""
    ship_package(vectors.sparkSession)
    rows = written(usable(vectors), "vectors")
    # the k + 1 smallest ids of each different vector, without gathering its copies
    total = rows.count()
    shards = max(1, -(-total // shard_rows))

    def index(table: pa.Table) -> pa.Table:
        x, ids = matrix(table["v"]), table["vec_id"].to_numpy()
        by = np.lexsort((ids, *x.T[::-1]))
        x, ids = x[by], ids[by]
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]).any(axis=1)
        start = np.flatnonzero(new)
        count = np.minimum(np.diff(np.append(start, len(x))), k + 1)
        keep = np.concatenate([np.arange(s, s + c) for s, c in zip(start, count)])
        points = lifted(x[start])
        blob = _pack(x=x[start], ids=ids[keep], first=np.append(0, np.cumsum(count)), points=points, **build_tree(points, leaf))
        return pa.table({"dim": pa.array([x.shape[1]], pa.int32()), "shard": pa.array([table["shard"][0].as_py()], pa.int32()), "tree": pa.array([blob], pa.binary())})

    dealt = rows.withColumns({"dim": F.size("v"), "shard": F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")})
    return written(dealt.groupBy("dim", "shard").applyInArrow(index, INDEX_SCHEMA), "vptrees")


def _shard_hits(block, k: int, factor: float):
    """Search one block of queries (a broadcast variable) in each shard."""
    def search(batches):
        for batch in batches:
            for row in batch.to_pylist():
                t = dict(np.load(io.BytesIO(row["tree"])))
                mine = [(q, v) for q, v in block.value if len(v) == row["dim"]]
                if not mine:
                    continue
                qid, q = np.array([i for i, _ in mine]), np.array([v for _, v in mine])
                # one more than k: the query itself is none of its neighbours
                _, found = search_tree(t, q, min(k + 1, len(t["x"])), factor)
                yield _scored(qid, q, t, found, k)

    return search


def _scored(qid, q, t, found, k) -> pa.RecordBatch:
    """Exact scores of the points found, and each query's ``k`` best ids."""
    first, out = t["first"], []
    for i in range(len(qid)):
        rows = found[i][found[i] >= 0]
        s = products(t["x"][rows], q[i : i + 1])
        ids = np.concatenate([t["ids"][first[r] : first[r + 1]] for r in rows])
        score = np.repeat(s, first[rows + 1] - first[rows])
        other = ids != qid[i]
        ids, score = ids[other], score[other]
        top = np.lexsort((ids, -score))[:k]
        out.append((np.full(len(top), qid[i]), ids[top], score[top]))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, is_query, k: int = 20, factor: float = 1.0, shard_rows: int = SHARD_ROWS,
            leaf: int = LEAF, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` nearest."""
    spark = vectors.sparkSession
    index = build_index(vectors, k, shard_rows, leaf)
    hits, block = [], []

    def send():
        sent = spark.sparkContext.broadcast(block)
        hits.append(index.mapInArrow(_shard_hits(sent, k, factor), HIT_SCHEMA))

    for r in usable(vectors).where(is_query).toLocalIterator():
        block.append((r["vec_id"], np.array(r["v"])))
        if len(block) == query_block:
            send()
            block = []
    if block or not hits:
        send()
    every = hits[0]
    for h in hits[1:]:
        every = every.union(h)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return every.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
