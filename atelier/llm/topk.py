"""Exact top-k search by inner product: a ball tree per shard, branch and bound.

1. Cells.  A coarse halving tree is fitted on a bounded sample of the vectors (``SAMPLE`` rows, those of the least
   hash) and every vector is dealt to its leaf, so that a cell's vectors are near one another.  A cell of more than
   ``SHARD_ROWS`` is split by a hash of its vectors into shards of about that size, whatever share of the rows it
   holds; rows that repeat a vector and id are one row with a count before anything is dealt.
2. Shards.  Each has a ball tree whose nodes keep a centre, a radius and the smallest id below.  ``GROUP`` shards in
   the order of the cells are a group, which one task searches; a group's summary is the balls of its trees.
3. Lead.  Queries are dealt to the same cells, into blocks.  A block first meets the group of the highest bound.
   A walk is best first by the upper bound q.c + |q| r; a node is left when that bound can't beat the k-th score so far.
   The trees of a group are searched in the order of their bounds and pass the k-th score on.
4. Rest.  The k-th scores of the lead are shared with all other searches: a query goes only to the groups whose bound
   can still beat its score, so a group that no query can gain from is never read by them.

Defined results: vectors that are null, empty or hold a null or non-finite component take no part; only
vectors of the query's own length are candidates; ties go to the smaller id; a query with fewer
candidates than k returns all; every row is a candidate, so rows that repeat a vec_id take a rank each; rows of the
query's own vec_id take no part in its result; a query_id that several rows have is one query, that of the least
vector; a null vec_id takes no part; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch, partitions, schema_with
from .textkit import tidy

SHARD_ROWS = 8192
QUERY_ROWS = 1024
LEAF = 64
EXACT = 2**53
#: Rows on which the cells are fitted; a cell holds about ``SAMPLE_LEAF`` of them.
SAMPLE, SAMPLE_LEAF = 8192, 16
#: Most shards that a task searches, and most blocks of queries that meet them there.
GROUP, BLOCKS = 8, 8
#: Balls of shards that are broadcast at most; beyond, every block meets every group.
SUMMARIES = 50_000
NONE = np.iinfo(np.int64)


def compact(v: np.ndarray) -> np.ndarray:
    """The same whole numbers in the narrowest type that holds them all: what a task keeps and sends of them."""
    low, high = (int(v.min()), int(v.max())) if v.size else (0, 0)
    return v.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def build(ids: np.ndarray, vecs: np.ndarray, leaf: int = LEAF) -> dict:
    """Ball tree as arrays; rows of a node are contiguous after reordering.  Halving by rank bounds the depth for any data."""
    order, nodes = np.arange(len(ids)), []
    x = vecs.astype(np.float64)

    def grow(lo: int, hi: int) -> int:
        part = order[lo:hi]
        mid = x[part].mean(axis=0)
        far = np.sqrt(((x[part] - mid) ** 2).sum(axis=1).max()) * (1 + 1e-12)
        me = len(nodes)
        nodes.append([lo, hi, -1, -1, mid, far, ids[part].min()])
        if hi - lo > leaf:
            spread = x[part].var(axis=0)
            rank = np.argsort(x[part] @ spread_axis(x[part], spread), kind="stable")
            order[lo:hi] = part[rank]
            half = (lo + hi) // 2
            nodes[me][2], nodes[me][3] = grow(lo, half), grow(half, hi)
        return me

    grow(0, len(ids))
    lo, hi, left, right, mid, far, least = zip(*nodes)
    return {"ids": ids[order], "vecs": compact(vecs[order]), "lo": lo, "hi": hi, "left": left, "right": right, "mid": np.array(mid), "far": np.array(far), "least": np.array(least)}


def spread_axis(x: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Direction to halve along: from the centre to the farthest point, else the axis of most variance."""
    mid = x.mean(axis=0)
    away = x[((x - mid) ** 2).sum(axis=1).argmax()] - mid
    return away if np.any(away) else np.eye(len(mid))[spread.argmax()]


class Best:
    """The k best (score, id) of each query of a block so far."""

    def __init__(self, q_ids: np.ndarray, k: int, floor: np.ndarray):
        none = np.iinfo(np.int64)
        self.q_ids, self.k = q_ids, k
        self.score = np.full((len(q_ids), k), none.min)
        self.id = np.full((len(q_ids), k), none.max)
        self.floor = floor

    def kth(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = self.score[rows, -1]
        low = self.floor[rows]
        return np.maximum(own, low), np.where(own >= low, self.id[rows, -1], np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        none = np.iinfo(np.int64)
        both = np.broadcast_to(ids, scores.shape)
        own = both == self.q_ids[rows, None]
        s = np.concatenate((self.score[rows], np.where(own, none.min, scores)), axis=1)
        i = np.concatenate((self.id[rows], np.where(own, none.max, both)), axis=1)
        pick = np.lexsort((i, -s.astype(np.float64) if abs(s[s > none.min]).max(initial=0) < EXACT else -np.maximum(s, none.min + 1)), axis=1)[:, : self.k]
        self.score[rows], self.id[rows] = np.take_along_axis(s, pick, 1), np.take_along_axis(i, pick, 1)


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products; by doubles where these are exact."""
    qf, vf = q.astype(np.float64), v.astype(np.float64)
    return (qf @ vf.T).astype(np.int64) if exact(qf, vf) else q.astype(np.int64) @ v.T.astype(np.int64)


def exact(qf: np.ndarray, vf: np.ndarray) -> bool:
    """Whether doubles give the inner products of these whole numbers exactly."""
    return float(np.abs(qf).max(initial=0)) * float(np.abs(vf).max(initial=0)) * qf.shape[1] < EXACT


def search(tree: dict, q: np.ndarray, best: Best) -> int:
    """Best-first walk of one tree by all queries of a block that can still gain; returns the number of leaves scored."""
    scored = 0
    qf, vf = q.astype(np.float64), tree["vecs"].astype(np.float64)
    size = np.sqrt((qf**2).sum(axis=1))
    doubles = exact(qf, vf)

    def bound(node: int, rows: np.ndarray) -> np.ndarray:
        top = qf[rows] @ tree["mid"][node] + size[rows] * tree["far"][node]
        return np.floor(top + 1e-9 * np.abs(top) + 1e-3)

    every = np.arange(len(q))
    heap = [(-bound(0, every).max(), 0, every)] if len(q) else []
    while heap:
        _, node, rows = heapq.heappop(heap)
        top = bound(node, rows)
        kth, kid = best.kth(rows)
        able = (top > kth) | ((top == kth) & (tree["least"][node] <= kid))
        rows = rows[able]
        if not len(rows):
            continue
        if tree["left"][node] < 0:
            lo, hi = tree["lo"][node], tree["hi"][node]
            ids = tree["ids"][lo:hi]
            scores = (qf[rows] @ vf[lo:hi].T).astype(np.int64) if doubles else products(q[rows], tree["vecs"][lo:hi])
            # only queries that gain by a row of the leaf are ranked anew
            kth, kid = kth[able, None], kid[able, None]
            gains = ((scores > kth) | ((scores == kth) & (ids <= kid))).any(axis=1)
            if gains.any():
                best.add(rows[gains], ids, scores[gains])
            scored += 1
        else:
            for child in (tree["left"][node], tree["right"][node]):
                heapq.heappush(heap, (-bound(child, rows).max(), child, rows))
    return scored


def balls(summary: tuple[np.ndarray, np.ndarray, np.ndarray], q: np.ndarray) -> np.ndarray:
    """Upper bounds of every query (rows) in every ball (columns)."""
    mid, far, _ = summary
    qf = q.astype(np.float64)
    top = qf @ mid.T + np.sqrt((qf**2).sum(axis=1))[:, None] * far[None]
    return np.floor(top + 1e-9 * np.abs(top) + 1e-3)


class Cells:
    """A coarse halving tree for each vector length, fitted on a sample."""

    def __init__(self, sample: dict[int, np.ndarray], leaf: int = SAMPLE_LEAF):
        self.trees: dict[int, list] = {}
        for dim, x in sample.items():
            nodes: list = []
            self._grow(x, leaf, nodes)
            self.trees[dim] = nodes

    def _grow(self, x: np.ndarray, leaf: int, nodes: list) -> int:
        me = len(nodes)
        nodes.append(None)
        if len(x) > leaf and np.any(x != x[0]):
            axis = spread_axis(x, x.var(axis=0))
            at = x @ axis
            cut = np.median(at)
            low = at < cut if (at < cut).any() else at <= cut
            if low.any() and not low.all():
                nodes[me] = (axis, at[~low].min(), self._grow(x[low], leaf, nodes), self._grow(x[~low], leaf, nodes))
        return me

    def of(self, x: np.ndarray) -> np.ndarray:
        """The cell of each vector; one cell for a length that the sample lacks."""
        out = np.zeros(len(x), np.int32)
        nodes = self.trees.get(x.shape[1])
        todo = [(0, np.arange(len(x)))] if nodes else []
        xf = x.astype(np.float64)
        while todo:
            node, rows = todo.pop()
            if nodes[node] is None:
                out[rows] = node
            elif len(rows):
                axis, cut, low, high = nodes[node]
                under = xf[rows] @ axis < cut
                todo += [(low, rows[under]), (high, rows[~under])]
        return out


def _lists(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _celled(cells):
    """Rows (id, v, ...) with dim and cell."""

    def run(batches):
        for batch in batches:
            dims = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int32)
            cell = np.zeros(batch.num_rows, np.int32)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                cell[at] = cells.value.of(_lists(batch.column(1).take(pa.array(at)), int(d)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(dims), pa.array(cell)], names=[*batch.schema.names, "dim", "cell"])

    return run


def _dealt(scratch: Scratch, df: DataFrame, cells, size: int, name: str) -> tuple[DataFrame, int]:
    """``df`` (id, v, n) with dim and part: numbers of parts of about ``size`` rows, in the order of the cells; and the most parts of a length."""
    id_ = df.columns[0]
    placed = scratch.table(df.mapInArrow(tidy(_celled(cells)), schema_with(df, dim="int", cell="int")), name)
    parts = placed.groupBy("dim", "cell").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))  # a row for each cell
    before = Window.partitionBy("dim").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = scratch.table(parts.withColumn("start", F.coalesce(F.sum("parts").over(before), F.lit(0)).cast("int")), f"{name}-cells")
    most = starts.agg(F.max(F.col("start") + F.col("parts"))).first()[0] or 0
    side = F.broadcast(starts) if starts.count() <= SUMMARIES else starts
    part = F.col("start") + F.pmod(F.xxhash64(F.col(id_), F.col("v")), "parts").cast("int")
    return placed.join(side, ["dim", "cell"]).select(*df.columns, "dim", part.alias("part")), most


def _packed(k: int, size: int):
    def pack(group, table):
        dim, shard = group[0].as_py(), group[1].as_py()
        times = np.minimum(table["n"].to_numpy(), k)  # no more than k equal rows can have a rank
        made = build(np.repeat(table["vec_id"].to_numpy(), times), np.repeat(_lists(table["v"], dim), times, axis=0))
        ball = (made["mid"][0], made["far"][0], made["least"][0])
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()), "grp": pa.array([shard // size], pa.int32()), "ball": pa.array([pickle.dumps(ball)], pa.binary()), "tree": pa.array([pickle.dumps(made)], pa.binary())})

    return pack


def _block(group, table):
    made = (table["query_id"].to_numpy(), compact(_lists(table["v"], group[0].as_py())), np.full(table.num_rows, NONE.min))
    return pa.table({"dim": pa.array([group[0].as_py()], pa.int32()), "block": pa.array([group[1].as_py()], pa.int32()), "asked": pa.array([pickle.dumps(made)], pa.binary())})


ROUTE = "dim int, grp int, block int, chunk int, asked binary"


def _routed(summaries, groups: dict[int, int] | None, size: int, lead: bool):
    """Blocks with the groups they go to: the one of the highest bound, or all others that can beat a query's score.

    Without summaries a block's lead is the first group, and its queries go to every other.
    """

    def run(batches):
        table = summaries.value if summaries is not None else None
        for batch in batches:
            for dim, block, blob in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("dim", "block", "asked"))):
                q_ids, q, floor = pickle.loads(blob)
                out = []
                if table is None:
                    sent = {g: np.arange(len(q)) for g in range(groups.get(dim, 0))}
                    first = 0
                elif dim not in table:
                    continue
                else:
                    names, mid, far, least = table[dim]
                    heads = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
                    # some queries at a time, which bounds the table of bounds
                    top = np.concatenate([np.maximum.reduceat(balls((mid, far, least), q[lo : lo + 64]), heads, axis=1) for lo in range(0, len(q), 64)])
                    first = names[heads[int(top.mean(axis=0).argmax())]]
                    sent = {g: np.flatnonzero(top[:, i] >= floor) for i, g in enumerate(names[heads])}
                for g, rows in sent.items():
                    if (g == first) == lead and len(rows):
                        out.append((dim, int(g), block, block // size, pickle.dumps((q_ids[rows], q[rows], floor[rows]))))
                for lo in range(0, len(out), 16):
                    cols = list(zip(*out[lo : lo + 16]))
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in cols[:4]), pa.array(cols[4], pa.binary())], names=["dim", "grp", "block", "chunk", "asked"])

    return run


def _walk(k: int):
    """A group's trees against some blocks of queries: (query_id, vec_id, score)."""

    def walk(group, trees, asked):
        made = [pickle.loads(x) for x in trees["tree"].to_pylist()]
        out = [(np.zeros(0, np.int64),) * 3]
        for blob in asked["asked"]:
            q_ids, q, floor = pickle.loads(blob.as_py())
            best = Best(q_ids, k, floor)
            tops = [balls((t["mid"][:1], t["far"][:1], None), q).max(initial=-np.inf) for t in made]
            for i in np.argsort(-np.array(tops), kind="stable"):
                search(made[i], q, best)
            # what is under a query's score of the lead can't have a rank
            row, col = np.nonzero((best.id != NONE.max) & (best.score >= floor[:, None]))
            out.append((q_ids[row], best.id[row, col], best.score[row, col]))
        return pa.table({n: pa.array(np.concatenate(c), pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), zip(*out))})

    return walk


def _floored(group, asked, seen):
    score = dict(zip(seen["query_id"].to_pylist(), seen["kth"].to_pylist()))
    rows = []
    for blob in asked["asked"]:
        q_ids, q, floor = pickle.loads(blob.as_py())
        rows.append(pickle.dumps((q_ids, q, np.array([score.get(int(x), int(f)) for x, f in zip(q_ids, floor)], np.int64))))
    return pa.table({"dim": asked["dim"], "block": asked["block"], "asked": pa.array(rows, pa.binary())})


def top_k(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, summaries: int = SUMMARIES) -> DataFrame:
    """(query_id, rank, vec_id, score).  vectors: (vec_id, v array<long>); queries: (query_id, v array<long>)."""
    scratch = Scratch(spark, "topk")
    rows = scratch.table(vectors.select("vec_id", "v").groupBy("vec_id", "v").agg(F.count("*").alias("n")), "rows")
    asks = queries.groupBy("query_id").agg(F.min("v").alias("v")).withColumn("n", F.lit(1).cast("long"))
    drawn = rows.select("v").orderBy(F.xxhash64("v", "vec_id")).limit(SAMPLE).toArrow()["v"].to_pylist()  # a bounded sample
    by_dim: dict[int, list] = {}
    for v in drawn:
        by_dim.setdefault(len(v), []).append(v)
    cells = spark.sparkContext.broadcast(Cells({d: np.array(x, np.float64) for d, x in by_dim.items()}, max(SAMPLE_LEAF, len(drawn) * shard_rows // max(1, rows.count()))))

    # groups and blocks of one task, fewer where there are not enough of them for all tasks
    each = lambda n, most: max(1, min(most, n // partitions(spark)))
    shards, n_shards = _dealt(scratch, rows, cells, shard_rows, "celled")
    trees = scratch.table(shards.groupBy("dim", "part").applyInArrow(_packed(k, each(n_shards, GROUP)), "dim int, shard int, grp int, ball binary, tree binary"), "trees")
    blocks, n_blocks = _dealt(scratch, asks, cells, query_rows, "asks")
    asked = scratch.table(blocks.groupBy("dim", "part").applyInArrow(_block, "dim int, block int, asked binary"), "asked")

    groups, table = None, None
    if trees.count() <= summaries:
        held = trees.select("dim", "grp", "shard", "ball").orderBy("dim", "shard").toArrow().to_pydict()  # a row for each shard, bounded
        found: dict[int, list] = {}
        for d, g, ball in zip(held["dim"], held["grp"], held["ball"]):
            found.setdefault(d, []).append((g, *pickle.loads(ball)))
        table = spark.sparkContext.broadcast({d: tuple(np.array(c) for c in zip(*x)) for d, x in found.items()})
    else:
        groups = {r[0]: r[1] + 1 for r in trees.groupBy("dim").agg(F.max("grp")).collect()}  # a row for each vector length

    def against(routes: DataFrame) -> DataFrame:
        """Each group meets the blocks that are sent to it, ``BLOCKS`` of them in a task: the stated query set against all rows, in blocks."""
        routes = scratch.table(routes, f"routes-{len(done)}")
        asked_for = routes.select("dim", "grp", "chunk").distinct()
        sides = trees.select("dim", "grp", "tree").join(asked_for, ["dim", "grp"])
        sent = routes.select(F.col("dim").alias("r_dim"), F.col("grp").alias("r_grp"), F.col("chunk").alias("r_chunk"), "asked")
        out = sides.groupBy("dim", "grp", "chunk").cogroup(sent.groupBy("r_dim", "r_grp", "r_chunk")).applyInArrow(_walk(k), "query_id long, vec_id long, score long")
        done.append(scratch.table(out, f"found-{len(done)}"))
        return done[-1]

    done: list[DataFrame] = []
    first = against(asked.mapInArrow(tidy(_routed(table, groups, each(n_blocks, BLOCKS), True)), ROUTE))
    ranked = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth")).filter(F.col("n") >= k)
    kth = blocks.select("dim", F.col("part").alias("block"), "query_id").join(ranked, "query_id").select(F.col("dim").alias("k_dim"), F.col("block").alias("k_block"), "query_id", "kth")
    bounded = scratch.table(asked.groupBy("dim", "block").cogroup(kth.groupBy("k_dim", "k_block")).applyInArrow(_floored, "dim int, block int, asked binary"), "bounded")
    rest = against(bounded.mapInArrow(tidy(_routed(table, groups, each(n_blocks, BLOCKS), False)), ROUTE))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return first.unionByName(rest).withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def integral(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v): floor(64 * x) of every component; vectors with a part that has no such value are left out."""
    x = F.col("embedding")
    sound = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return embeddings.filter(F.col("vec_id").isNotNull() & sound).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(F.lit(64.0) * e.cast("double")).cast("long")).alias("v"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all other vectors for every vec_id divisible by 20."""
    vectors = integral(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return top_k(spark, vectors, vectors.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"))


OP5_SQL = """
WITH v AS (SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id AS query_id, unnest(v) AS x, generate_subscripts(v, 1) AS i, len(v) AS n FROM (SELECT vec_id, min(v) AS v FROM v WHERE vec_id % 20 = 0 GROUP BY 1)),
e AS (SELECT row_id, vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i, len(v) AS n FROM v),
s AS (SELECT query_id, row_id, e.vec_id, sum(q.x * e.x)::BIGINT AS score FROM q JOIN e ON q.i = e.i AND q.n = e.n AND q.query_id <> e.vec_id GROUP BY ALL),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
