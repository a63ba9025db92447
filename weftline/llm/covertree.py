"""Exact top-k inner product search with two cover trees.

Queries and data are dealt to the same cells: the nearest of some centres, taken
from the top of a cover tree over a bounded sample (a centre for some 4096 rows,
64 at least and 4096 at most). A cell's rows, by hash in parts of bounded size,
are cut along the next levels of a cover tree into blocks of neighbours, so that
a block's radius shrinks as the table grows. Each block is one row: its vectors
and its cover tree, whose nodes have a centre and a covering radius. For a query
node (centre q, radius a) and a data node (centre p, radius b) no score exceeds
q.p + a|p| + b|q| + ab; a pair of nodes whose bound is under the worst kth
score of the query node's queries is pruned, else the larger node is opened.

First each query block searches the nearest data block of its own cell, which
gives every query a kth score. Then pairs are walked from the top: query blocks
with cells (so few that they may be broadcast), then with the blocks of the cells
that are left, pruned by the same bound over whole cells and blocks. What remains
is searched by data block, some query blocks at a time, so that a data block is
sent once for several. The search is exact: centres and sample only shape blocks.

Defined results: vectors that are null, empty or hold a null or non-finite
component take no part; vectors meet only vectors of their own length; repeated
rows (same id, same vector) count once; ties go to the smaller id; fewer than k
candidates give fewer rows; empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import first_by_hash, materialize

LEAF = 64
#: Ratio of a node's radius to its children's.
SHRINK = 0.75
FLOAT_EXACT = 2.0**52
#: Under any score, and safe to negate.
NONE = -(2**62)


class CoverTree:
    """Nodes in arrays: centre (a row), radius, rows [begin, end) of ``order``,
    children [first, last). Children of a node are more than their cover radius
    apart, and each row lies under the nearest of them."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.points, self.leaf = points.astype(np.float64), leaf
        self.centre, self.radius, self.begin, self.end, self.first, self.last = [], [], [], [], [], []
        if len(points):
            middle = self.points.mean(0)
            root = int(((self.points - middle) ** 2).sum(1).argmin())
            todo = [self._node(root, 0, len(points))]
            while todo:
                todo += self._open(todo.pop())

    def _node(self, centre: int, begin: int, end: int) -> int:
        away = np.sqrt(((self.points[self.order[begin:end]] - self.points[centre]) ** 2).sum(1))
        for name, x in (("centre", centre), ("radius", float(away.max())), ("begin", begin), ("end", end), ("first", 0), ("last", 0)):
            getattr(self, name).append(x)
        return len(self.centre) - 1

    def _open(self, node: int) -> list[int]:
        begin, end, cover = self.begin[node], self.end[node], self.radius[node] * SHRINK
        if end - begin <= self.leaf or cover == 0:
            return []
        rows = self.order[begin:end]
        own = self.points[rows]
        near, owner, centres, centre = np.full(len(rows), np.inf), np.zeros(len(rows), np.int64), [], self.centre[node]
        while True:
            away = ((own - self.points[centre]) ** 2).sum(1)
            owner[away < near] = len(centres)
            near = np.minimum(near, away)
            centres.append(centre)
            far = int(near.argmax())
            if near[far] <= cover**2:
                break
            if len(centres) * self.leaf > 2 * len(rows):
                # no scale structure: nearly every row would be its own child
                break
            centre = int(rows[far])
        if len(centres) == 1:
            return []
        by = np.argsort(owner, kind="stable")
        self.order[begin:end] = rows[by]
        cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(centres)))]) + begin
        self.first[node] = len(self.centre)
        made = [self._node(c, int(a), int(b)) for c, a, b in zip(centres, cuts[:-1], cuts[1:], strict=True) if b > a]
        self.last[node] = len(self.centre)
        return made

    def save(self) -> dict[str, np.ndarray]:
        return {"order": self.order, "nodes": np.array([self.centre, self.begin, self.end, self.first, self.last], np.int64), "radius": np.array(self.radius)}


def _pack(ids: np.ndarray, points: np.ndarray) -> bytes:
    tree = CoverTree(points).save()
    small = next(t for t in (np.int16, np.int32, np.int64) if not len(points) or max(abs(int(points.max())), abs(int(points.min()))) <= np.iinfo(t).max)
    out = io.BytesIO()
    np.savez(out, ids=ids, points=points.astype(small), **tree)
    return out.getvalue()


class _Side:
    def __init__(self, blob: bytes):
        held = np.load(io.BytesIO(blob))
        order = held["order"]
        self.ids, self.raw = held["ids"][order], held["points"][order].astype(np.int64)
        self.points = self.raw.astype(np.float64)
        centre, self.begin, self.end, self.first, self.last = held["nodes"].tolist()
        self.radius = held["radius"]
        self.centre = held["points"][centre].astype(np.float64)
        self.norm = np.sqrt((self.centre**2).sum(1))


def dual_search(query_blob: bytes, data_blob: bytes, k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's k best of one data block, without
    those under ``floor`` (a score per query, in the blob's row order)."""
    q, p = _Side(query_blob), _Side(data_blob)
    n = len(q.ids)
    best = np.full((n, k), NONE)
    names = np.full((n, k), np.iinfo(np.int64).max)
    lowest = np.full(n, NONE) if floor is None else floor[np.load(io.BytesIO(query_blob))["order"]]
    exact = np.abs(q.points).max(initial=0) * np.abs(p.points).max(initial=0) * q.points.shape[1] < FLOAT_EXACT
    todo = [(0, 0)] if n and len(p.ids) else []
    while todo:
        a, b = todo.pop()
        ra, rb = q.radius[a], p.radius[b]
        bound = q.centre[a] @ p.centre[b] + ra * p.norm[b] + rb * q.norm[a] + ra * rb
        own = slice(q.begin[a], q.end[a])
        worst = np.maximum(best[own, -1], lowest[own]).min()
        if bound + 1e-9 * abs(bound) + 1e-6 < worst:
            continue
        split_a, split_b = q.last[a] > q.first[a], p.last[b] > p.first[b]
        if split_a or split_b:
            if split_b and (not split_a or rb >= ra):
                nodes = np.arange(p.first[b], p.last[b])
                nearest = np.argsort(p.centre[nodes] @ q.centre[a])  # the best is popped first
                todo += [(a, int(x)) for x in nodes[nearest]]
            else:
                todo += [(x, b) for x in range(q.first[a], q.last[a])]
            continue
        theirs = slice(p.begin[b], p.end[b])
        score = np.rint(q.points[own] @ p.points[theirs].T).astype(np.int64) if exact else q.raw[own] @ p.raw[theirs].T
        other = p.ids[theirs]
        same = q.ids[own][:, None] == other[None, :]
        hits = (score >= np.maximum(best[own, -1], lowest[own])[:, None]) & ~same
        for i in np.flatnonzero(hits.any(1)):
            at = q.begin[a] + i
            s, x = np.concatenate([best[at], score[i][hits[i]]]), np.concatenate([names[at], other[hits[i]]])
            top = np.lexsort((x, -s))[:k] if len(s) < 4 * k else _top(s, x, k)
            best[at], names[at] = s[top], x[top]
    row, col = np.nonzero(best > NONE)
    return q.ids[row], names[row, col], best[row, col]


def _top(s: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    cut = -np.partition(-s, k - 1)[k - 1]
    rows = np.flatnonzero(s >= cut)
    return rows[np.lexsort((x[rows], -s[rows]))[:k]]


def _assign(pivots: dict[int, np.ndarray]):
    def made(batches):
        for batch in batches:
            vectors = batch.column("v")
            offsets = np.asarray(vectors.offsets)
            flat = np.asarray(vectors.values)
            length = np.diff(offsets)
            cell = np.zeros(len(length), np.int64)
            for n in np.unique(length):
                rows, centres = np.flatnonzero(length == n), pivots.get(int(n))
                if centres is None:
                    continue
                half = (centres**2).sum(1) / 2
                for part in np.array_split(rows, -(-len(rows) // 4096)):
                    x = flat[offsets[part][:, None] + np.arange(n)].astype(np.float64)
                    cell[part] = (x @ centres.T - half).argmax(1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("query"), batch.column("v"), pa.array(length.astype(np.int64)), pa.array(cell)], names=["id", "query", "v", "dim", "cell"])

    return made


def cut(points: np.ndarray, rows: int) -> list[np.ndarray]:
    """Rows of blocks of at most ``rows`` rows: nodes of a cover tree, small
    neighbours together; a node that can't be opened is cut by order."""
    if len(points) <= rows:
        return [np.arange(len(points))] if len(points) else []
    tree, out, todo = CoverTree(points, leaf=rows), [], [0]
    while todo:
        node = todo.pop()
        own = tree.order[tree.begin[node] : tree.end[node]]
        if len(own) > rows and tree.last[node] > tree.first[node]:
            small = []
            for child in range(tree.first[node], tree.last[node]):
                if tree.end[child] - tree.begin[child] > rows // 2:
                    todo.append(child)
                else:
                    small.append(child)
            while small:  # a seed, and the nearest others that fit in
                at = tree.points[[tree.centre[c] for c in small]]
                near = np.argsort(((at - at[0]) ** 2).sum(1), kind="stable")
                total = np.cumsum([tree.end[small[i]] - tree.begin[small[i]] for i in near])
                chosen = [small[i] for i in near[: max(1, int(np.searchsorted(total, rows, "right")))]]
                out.append(np.concatenate([tree.order[tree.begin[c] : tree.end[c]] for c in chosen]))
                small = [c for c in small if c not in chosen]
        else:
            out += np.array_split(own, -(-len(own) // rows))
    return out


def _blocks(rows: int):
    def made(key, table):
        dim, cell, salt = (x.as_py() for x in key)
        flat = np.concatenate([np.asarray(c.flatten()) for c in table.column("v").chunks])
        points, ids = flat.reshape(-1, dim), np.asarray(table.column("id").combine_chunks())
        by = np.argsort(ids, kind="stable")
        points, ids = points[by], ids[by]
        out = []
        for i, own in enumerate(cut(points, rows)):
            x = points[own]
            centre = x[int(((x - x.mean(0)) ** 2).sum(1).argmin())].astype(np.float64)
            radius = float(np.sqrt(((x - centre) ** 2).sum(1)).max())
            out.append((dim, cell, f"{dim}-{cell}-{salt}-{i}", len(own), centre.tolist(), radius, _pack(ids[own], x)))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.float64()), pa.float64(), pa.binary())
        names = ("dim", "cell", "block", "rows", "centre", "radius", "blob")
        return pa.table({n: pa.array([r[j] for r in out], kind) for j, (n, kind) in enumerate(zip(names, kinds, strict=True))})

    return made


FOUND = {"qblock": pa.string(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()}


def _search(k: int):
    """Of one data block and some query blocks: each query's best."""

    def made(asked, data):
        out = [pa.table({n: pa.array([], kind) for n, kind in FOUND.items()})]
        blobs = data.column("pblob").to_pylist()
        for name, query, floor in zip(*(asked.column(c).to_pylist() for c in ("qblock", "qblob", "floors")), strict=True):
            own = None
            if floor:
                known = {x["query_id"]: x["kth"] for x in floor}
                own = np.array([known.get(int(i), NONE) for i in np.load(io.BytesIO(query))["ids"]], np.int64)
            ids, others, scores = dual_search(query, blobs[0], k, own)
            out.append(pa.table({"qblock": pa.array([name] * len(ids), pa.string()), "query_id": pa.array(ids), "vec_id": pa.array(others), "score": pa.array(scores)}))
        return pa.concat_tables(out)

    return made


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", scale: float = 256.0, pivots: int | None = None, sample: int = 8, data_rows: int = 4096, query_rows: int = 2048, part_rows: int = 32768, report: dict | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k best other rows by
    inner product of components floor(scale * x). ``pivots`` is the number
    of centres, if not by size; ``sample`` rows a centre shape the index, 2048 at least; ``report`` takes the number of query blocks and of
    pairs searched."""
    fine = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("query"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    rows = rows.where(fine & F.col("id").isNotNull()).withColumn("v", F.transform("v", lambda x: F.floor(F.lit(scale) * x).cast("long")))
    rows = materialize(rows.groupBy("id", "v").agg(F.max("query").alias("query")).select("id", "query", "v"))
    # centres of the cells, for each length
    pivots = pivots or min(4096, max(64, rows.count() // data_rows))
    sample = max(2048, sample * pivots)
    mark = Window.partitionBy("dim").orderBy("mark", "id")
    chosen = first_by_hash(rows.select("id", "v", F.size("v").alias("dim"), F.xxhash64("id").alias("mark")), 4 * sample, "id", "v")
    found: dict[int, list] = {}
    for r in chosen.withColumn("n", F.row_number().over(mark)).where(F.col("n") <= sample).select("dim", "v").collect():
        found.setdefault(r.dim, []).append(r.v)
    tops = {}
    for dim, points in found.items():
        x = np.unique(np.array(points, np.float64), axis=0)
        tree = CoverTree(x, leaf=max(1, len(x) // pivots))
        level, wide = {0}, [(-tree.radius[0], 0)]
        while wide:  # open the widest node while the level is narrow enough
            _, node = heapq.heappop(wide)
            below = range(tree.first[node], tree.last[node])
            if below and len(level) - 1 + len(below) <= pivots:
                level = level - {node} | set(below)
                for c in below:
                    heapq.heappush(wide, (-tree.radius[c], c))
        tops[dim] = x[sorted({tree.centre[n] for n in level})]
    dealt = materialize(rows.mapInArrow(_assign(tops), "id long, query boolean, v array<long>, dim long, cell long"))
    counts = materialize(dealt.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.count_if("query").alias("nq")))
    placed = dealt.join(counts, ["dim", "cell"])
    shape = "dim long, cell long, block string, rows long, centre array<double>, radius double, blob binary"

    def packed(part: DataFrame, total: str, size: int) -> DataFrame:
        salt = F.pmod(F.xxhash64(F.lit(total), "id"), F.ceil(F.col(total) / part_rows))
        return materialize(part.select("dim", "cell", salt.alias("salt"), "id", "v").groupBy("dim", "cell", "salt").applyInArrow(_blocks(size), shape))

    data = packed(placed, "n", data_rows)
    asked = packed(placed.where("query"), "nq", query_rows)
    left = asked.select("dim", F.col("cell").alias("qcell"), F.col("block").alias("qblock"), F.col("rows").alias("qrows"), F.col("centre").alias("qcentre"), F.col("radius").alias("qradius"))
    right = data.select(F.col("dim").alias("pdim"), "cell", F.col("block").alias("pblock"), "centre", "radius")
    qblobs, pblobs = asked.select(F.col("block").alias("qblock"), F.col("blob").alias("qblob")), data.select(F.col("block").alias("pblock"), F.col("blob").alias("pblob"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    norm = lambda a: F.sqrt(dot(a, a))
    away = lambda a, b: F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))

    def searched(pairs: DataFrame, floors: DataFrame | None) -> DataFrame:
        """Data blocks meet some 16 query blocks at a time."""
        kind = "array<struct<query_id:bigint,kth:bigint>>"
        chunk = F.pmod(F.xxhash64("qblock"), F.ceil(F.col("times") / 16))
        spread = materialize(pairs.join(pairs.groupBy("pblock").agg(F.count("*").alias("times")), "pblock").select("qblock", "pblock", chunk.alias("chunk")))
        whole = spread.join(qblobs, "qblock")
        whole = whole.join(floors, "qblock", "left") if floors is not None else whole.withColumn("floors", F.lit(None).cast(kind))
        whole = whole.select("pblock", "chunk", "qblock", "qblob", F.col("floors").cast(kind).alias("floors"))
        theirs = spread.select("pblock", "chunk").distinct().join(pblobs, "pblock").select(F.col("pblock").alias("theirs"), F.col("chunk").alias("part"), "pblob")
        return materialize(whole.groupBy("pblock", "chunk").cogroup(theirs.groupBy("theirs", "part")).applyInArrow(_search(k), "qblock string, query_id long, vec_id long, score long"))

    own_cell = left.join(right, (left.dim == right.pdim) & (F.col("qcell") == F.col("cell")))
    home = materialize(own_cell.groupBy("qblock").agg(F.min_by("pblock", F.struct(away("qcentre", "centre").alias("away"), F.col("pblock"))).alias("pblock")))
    first = searched(home, None)
    # a query's kth score so far; a block's is its worst
    kth = first.groupBy("qblock", "query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
    floors = materialize(kth.groupBy("qblock").agg(F.collect_list(F.struct("query_id", "kth")).alias("floors"), F.min("kth").alias("worst"), F.count("*").alias("known")))
    worst = F.when(F.col("known") == F.col("qrows"), F.col("worst")).otherwise(F.lit(NONE))
    bounded = left.join(floors.select("qblock", "worst", "known"), "qblock", "left").select("dim", "qblock", "qcentre", "qradius", F.coalesce(worst, F.lit(NONE)).alias("worst"))
    bound = dot("qcentre", "centre") + F.col("qradius") * norm("centre") + F.col("radius") * norm("qcentre") + F.col("qradius") * F.col("radius")
    near = bound + F.abs(bound) * 1e-9 + 1e-6 >= F.col("worst")
    middle = right.groupBy("pdim", "cell").agg(F.min_by("centre", "pblock").alias("middle"))
    cells = right.join(middle, ["pdim", "cell"]).groupBy("pdim", "cell").agg(F.first("middle").alias("centre"), F.max(away("middle", "centre") + F.col("radius")).alias("radius"))
    cells = materialize(cells)  # as many as there are centres, at most 4096 for a length
    open_cells = bounded.join(F.broadcast(cells), F.col("dim") == F.col("pdim")).where(near).select("dim", "qblock", "qcentre", "qradius", "worst", "cell")
    pairs = open_cells.join(right, (F.col("dim") == F.col("pdim")) & (open_cells.cell == right.cell)).where(near).select("qblock", "pblock")
    pairs = materialize(pairs.join(home, ["qblock", "pblock"], "left_anti"))
    if report is not None:
        report |= {"query_blocks": asked.count(), "data_blocks": data.count(), "pairs": pairs.count() + home.count()}
    second = searched(pairs, floors.select("qblock", "floors"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = first.union(second).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
