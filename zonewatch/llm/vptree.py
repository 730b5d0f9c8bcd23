"""Approximate nearest neighbours by inner product (operator 13): vantage-point trees per shard.

Inner product is turned into distance: with M the largest norm, a vector x gets the coordinate
sqrt(M^2 - |x|^2) more and a query is scaled to norm M, with 0 there.  Then the nearest by distance are those of
the largest inner product, and the triangle inequality holds.

Index.  Rows of one vector (bit by bit) are one entry with its smallest k + 1 vec_ids: of equal
vectors no others can be among k neighbours.  Entries go to the cell of the nearest of at most ``MAX_CELLS``
pivots (the only thing fitted, on ``PIVOT_SAMPLE`` vectors); a cell is cut by hash into shards of about ``SHARD_ROWS``.  Every
entry is indexed, in the tree of its shard, which is one file in the shared folder.

Search.  A query first searches one shard of its own cell, which gives the distance that a
neighbour must keep, then the shards of the cells whose ball may hold such a neighbour.  In a tree, a
branch is left out when ``factor`` times its least possible distance exceeds the k-th best
so far: factor 1 is exact, larger factors leave out more.  Queries of one shard go through the tree together, in
blocks, so that no task holds all queries of a shard that many ask.

Cases: vectors that are null, empty, zero or hold null or non-finite components take no part.  Vectors of different
lengths are compared as if the shorter ended in zeros.  A null vec_id is a neighbour after all others at ties and
never a query.  Rows that repeat a vec_id are rows of their own: a query's own row alone is left out of its
neighbours.  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from itertools import groupby
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonewatch.llm.common import mix, put_file, run_folder, stage, store

FACTOR = 1.0
LEAF = 128
SHARD_ROWS = 16384
MAX_CELLS = 256
PIVOT_SAMPLE = 2048
BLOCK_QUERIES = 4096
NO_ID = (1 << 63) - 1  # stands for a null vec_id, after all others


class Space:
    """Distances after the reduction from inner product."""

    def __init__(self, most: float, width: int):
        self.most, self.width, self.slack = most, width, 1e-7 * most

    def matrix(self, vectors: pa.Array) -> np.ndarray:
        """Rows of a list column, filled up with zeros to the width."""
        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.combine_chunks()
        lengths = np.diff(vectors.offsets.to_numpy())
        out = np.zeros((len(vectors), self.width))
        out[np.arange(self.width) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
        return out

    def lift(self, points: np.ndarray) -> np.ndarray:
        return np.column_stack((points, np.sqrt(np.maximum(self.most ** 2 - (points ** 2).sum(1), 0))))

    def between(self, lifted: np.ndarray, one: np.ndarray) -> np.ndarray:
        return np.sqrt(((lifted - one) ** 2).sum(1))

    def of_scores(self, scores: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Distances from queries of the given norms to points of these inner products."""
        return np.sqrt(np.maximum(2 * self.most ** 2 - 2 * self.most * scores / norms, 0))


class Tree:
    """A vantage-point tree.  ``nodes`` holds, of each inner node, the vantage point, and of each child
    its number and the least and largest distance from it; leaves are ranges of points."""

    FIELDS = ("points", "ids", "n_ids", "entry", "vantage", "child", "bounds", "range")

    def __init__(self, **held: np.ndarray):
        self.__dict__.update(held)
        self.first = self.ids[:, 0]

    @classmethod
    def build(cls, space: Space, points: np.ndarray, ids: np.ndarray, n_ids: np.ndarray, entry: np.ndarray) -> Tree:
        lifted = space.lift(points)
        vantage, child, bounds, ranges = [], [], [], []
        order = np.argsort(mix(entry.astype(np.uint64)), kind="stable")
        pending = [(0, len(order), -1, 0)]
        while pending:
            start, end, parent, side = pending.pop()
            node = len(vantage)
            if parent >= 0:
                child[parent][side] = node
            vantage.append(-1)
            child.append([-1, -1])
            bounds.append([0.0] * 4)
            ranges.append((start, end))
            if end - start <= LEAF:
                continue
            own = order[start:end]
            probe = own[:: max(1, len(own) // 64)][:64]
            spread = [space.between(lifted[probe], lifted[c]).std() for c in own[:8]]  # they stand in hash order
            at = own[int(np.argmax(spread))]
            d = space.between(lifted[own], lifted[at])
            half = len(own) // 2
            split = np.argpartition(d, half)
            order[start:end] = own[split]
            near, far = d[split[:half]], d[split[half:]]
            vantage[node] = int(at)
            bounds[node] = [near.min(), near.max(), far.min(), far.max()]
            pending += [(start, start + half, node, 0), (start + half, end, node, 1)]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        where = np.array(vantage)
        where[where >= 0] = place[where[where >= 0]]
        return cls(points=points[order], ids=ids[order], n_ids=n_ids[order], entry=entry[order], vantage=where,
                   child=np.array(child), bounds=np.array(bounds), range=np.array(ranges))

    def save(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as held:
            return cls(**{f: held[f] for f in cls.FIELDS})

    def search(self, space: Space, queries: np.ndarray, floor: np.ndarray, most: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(scores, points) of the best ``most`` points a query, of ``floor`` or more; -inf and -1 where there are fewer.
        ``floor``: the score that ``most`` points elsewhere are known to reach, or -inf."""
        return _Search(self, space, queries, floor, most, factor).run()


class _Search:
    def __init__(self, tree: Tree, space: Space, queries: np.ndarray, floor: np.ndarray, most: int, factor: float):
        self.tree, self.space, self.queries, self.factor = tree, space, queries, factor
        self.norms = np.sqrt((queries ** 2).sum(1))
        self.scores = np.full((len(queries), most), -np.inf)
        self.found = np.full((len(queries), most), -1)
        self.floor = floor.copy()

    def reach(self, who: np.ndarray) -> np.ndarray:
        """How far a neighbour may be."""
        floor = self.floor[who]
        return np.where(floor == -np.inf, np.inf, self.space.of_scores(np.where(floor == -np.inf, 0, floor), self.norms[who]))

    def bound(self, node: int, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least distance to anything in either child."""
        d = self.space.of_scores(self.queries[who] @ self.tree.points[self.tree.vantage[node]], self.norms[who])
        b = self.tree.bounds[node]
        return np.maximum(b[0] - d, d - b[1]), np.maximum(b[2] - d, d - b[3])

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        everyone = np.arange(len(self.queries))
        home = np.zeros(len(everyone), np.int64)
        pending = [(0, everyone)]
        while pending:  # down to the nearer child, for a first reach
            node, who = pending.pop()
            if self.tree.vantage[node] < 0:
                home[who] = node
                self.scan(node, who)
                continue
            near, far = self.bound(node, who)
            for side, go in enumerate((near <= far, near > far)):
                if go.any():
                    pending.append((self.tree.child[node][side], who[go]))
        pending = [(0, everyone, np.zeros(len(everyone)))]
        while pending:
            node, who, least = pending.pop()
            open_ = ~(least * self.factor > self.reach(who) + self.space.slack)
            who = who[open_]
            if not len(who):
                continue
            if self.tree.vantage[node] < 0:
                self.scan(node, who[home[who] != node])
                continue
            for side, far in reversed(list(enumerate(self.bound(node, who)))):
                pending.append((self.tree.child[node][side], who, np.maximum(far, least[open_])))
        return self.scores, self.found

    def scan(self, node: int, who: np.ndarray) -> None:
        start, end = self.tree.range[node]
        points = self.tree.points[start:end]
        near = self.queries[who] @ points.T
        slack = 1e-9 * self.space.most * self.norms[who]
        row, column = np.nonzero(near >= (self.floor[who] - slack)[:, None])
        if not len(row):
            return
        exact = np.full(near.shape, -np.inf)
        exact[row, column] = np.einsum("ij,ij->i", self.queries[who[row]], points[column])
        rows = np.unique(row)
        who = who[rows]
        scores = np.concatenate((self.scores[who], exact[rows]), axis=1)
        found = np.concatenate((self.found[who], np.broadcast_to(np.arange(start, end), (len(rows), end - start))), axis=1)
        first = np.where(scores == -np.inf, NO_ID, self.tree.first[found])
        best = np.lexsort((first, -scores), axis=-1)[:, :self.scores.shape[1]]
        self.scores[who] = scores = np.take_along_axis(scores, best, 1)
        self.found[who] = np.where(scores == -np.inf, -1, np.take_along_axis(found, best, 1))
        self.floor[who] = np.maximum(self.floor[who], scores[:, -1])


class Cells:
    """Balls around pivots; bounded by ``MAX_CELLS``."""

    def __init__(self, space: Space, sample: np.ndarray, cells: int):
        self.space = space
        lifted = space.lift(sample)
        chosen = [0]
        nearest = space.between(lifted, lifted[0])
        while len(chosen) < min(cells, len(sample)):  # the farthest from those chosen
            at = int(np.argmax(nearest))
            chosen.append(at)
            nearest = np.minimum(nearest, space.between(lifted, lifted[at]))
        self.pivots = lifted[chosen]
        self.least = np.zeros(len(chosen))
        self.most = np.full(len(chosen), np.inf)

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        square = (lifted ** 2).sum(1)[:, None] + (self.pivots ** 2).sum(1) - 2 * lifted @ self.pivots.T
        return np.sqrt(np.maximum(square, 0))

    def of_queries(self, queries: np.ndarray) -> np.ndarray:
        norms = np.sqrt((queries ** 2).sum(1))
        return self.distances(np.column_stack((queries * (self.space.most / norms)[:, None], np.zeros(len(queries)))))


def _place(cells: Cells):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                d = cells.distances(cells.space.lift(cells.space.matrix(part.column("v"))))
                cell = d.argmin(1)
                yield part.append_column("cell", pa.array(cell, pa.int64())).append_column(
                    "away", pa.array(d[np.arange(len(cell)), cell]))
    return run


def _grow(space: Space, folder: str):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        ids = rows.column("ids").combine_chunks()
        n_ids = np.diff(ids.offsets.to_numpy())
        held = np.full((len(n_ids), int(n_ids.max())), NO_ID)
        held[np.arange(held.shape[1]) < n_ids[:, None]] = ids.flatten().to_numpy()
        tree = Tree.build(space, space.matrix(rows.column("v")), held, n_ids, rows.column("uid").to_numpy())
        path = f"{folder}/tree-{uuid.uuid4().hex}"  # a lost task's file is named by no row
        put_file(path, tree.save())
        return pa.table({"cell": [key[0]], "part": [key[1]], "path": [path]}, schema=pa.schema(
            [("cell", pa.int64()), ("part", pa.int64()), ("path", pa.string())]))
    return run


HIT = pa.struct([("score", pa.float64()), ("vec_id", pa.int64()), ("entry", pa.int64())])


def _search(space: Space, most: int, factor: float):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, tree = None, None
        for part in parts:
            paths = part.column("path").to_pylist()
            queries, floor, uids = space.matrix(part.column("v")), part.column("floor").to_numpy(), part.column("uid").to_numpy()
            for path, rows in groupby(range(len(paths)), paths.__getitem__):
                if path != name:
                    fs, where = store(path)
                    with fs.open_input_file(where) as f:
                        name, tree = path, Tree.load(f.read())
                at = np.array(list(rows))
                for own in np.array_split(at, ceil(len(at) / 1024)):
                    yield _hits(tree, uids[own], *tree.search(space, queries[own], floor[own], most, factor), most)
    return run


def _hits(tree: Tree, uids: np.ndarray, scores: np.ndarray, found: np.ndarray, most: int) -> pa.RecordBatch:
    """The vec_ids of the points found, by score and vec_id; and the score that ``most`` points reach."""
    query, rank = np.nonzero(found >= 0)
    point, score = found[query, rank], scores[query, rank]
    times = tree.n_ids[point]
    inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    query, point, score = (np.repeat(x, times) for x in (query, point, score))
    ids = tree.ids[point, inside]
    order = np.lexsort((ids, -score, query))
    query, point, score, ids = (x[order] for x in (query, point, score, ids))
    begin = np.searchsorted(query, np.arange(len(uids)))
    kept = np.arange(len(query)) - begin[query] < most
    query, point, score, ids = (x[kept] for x in (query, point, score, ids))
    hits = pa.StructArray.from_arrays([pa.array(score), pa.array(ids, pa.int64()), pa.array(tree.entry[point], pa.int64())], fields=list(HIT))
    ends = np.searchsorted(query, np.arange(len(uids) + 1))
    return pa.RecordBatch.from_arrays(
        [pa.array(uids, pa.int64()), pa.array(scores[:, -1]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), hits)], names=["uid", "reached", "hits"])


def _cells_to_visit(cells: Cells, factor: float):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            queries, floor = cells.space.matrix(part.column("v")), part.column("floor").to_numpy()
            d = cells.of_queries(queries)
            least = np.maximum(cells.least - d, d - cells.most)
            reach = np.full(len(floor), np.inf)
            known = floor > -np.inf
            reach[known] = cells.space.of_scores(floor[known], np.sqrt((queries[known] ** 2).sum(1)))
            go = ~(least * factor > reach[:, None] + cells.space.slack)
            yield part.append_column("go", pa.array([np.flatnonzero(g) for g in go], pa.list_(pa.int64())))
    return run


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and v (doubles) of the rows that take part."""
    v = vectors["embedding"].cast("array<double>")
    sound = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), v.alias("v")).filter(
        F.coalesce(sound & F.exists(v, lambda x: x != 0), F.lit(False)))


def nearest(vectors: DataFrame, asks: Column, k: int = 20, factor: float = FACTOR) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of every row for which ``asks`` (of vec_id) holds."""
    spark, most = vectors.sparkSession, k + 1
    folder = run_folder(spark, "vptree")
    rows = valid_vectors(vectors)
    # the limit holds in each task before the shuffle, so a vector of many rows is no large group
    first = rows.withColumn("vec_id", F.coalesce("vec_id", F.lit(NO_ID))).withColumn(
        "n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("n") <= most)
    entries = stage(first.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(
        F.monotonically_increasing_id().alias("uid"), "v", "ids"), folder, "entries")
    queries = stage(rows.filter(asks).select(F.col("vec_id").alias("query_id"), "v").join(
        entries.select("uid", "v").hint("merge"), "v"), folder, "queries")
    asked = stage(queries.dropDuplicates(["uid"]).select("uid", "v"), folder, "asked")

    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    n, widest, longest = entries.agg(F.count("*"), F.max(F.size("v")), F.max(norm)).first()
    space = Space(longest or 1.0, widest or 1)
    sample = entries.orderBy(F.xxhash64("uid"), "uid").limit(PIVOT_SAMPLE).select("v").toArrow()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    cells = Cells(space, space.matrix(sample.column("v")), min(MAX_CELLS, ceil(n / SHARD_ROWS)))
    placed = stage(entries.mapInArrow(_place(cells), "uid long, v array<double>, ids array<long>, cell long, away double"), folder, "placed")
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("away").alias("least"), F.max("away").alias("most"))
    for cell, _, least, away in sizes.collect():  # at most MAX_CELLS rows
        cells.least[cell], cells.most[cell] = least - space.slack, away + space.slack

    parts = sizes.select(F.col("cell").alias("_cell"), F.ceil(F.col("n") / SHARD_ROWS).cast("long").alias("parts"))
    sharded = placed.join(parts, F.col("cell") == F.col("_cell")).withColumn("part", F.pmod(F.xxhash64("uid"), "parts"))
    trees = stage(sharded.select("cell", "part", "uid", "v", "ids").groupBy("cell", "part").applyInArrow(
        _grow(space, folder), "cell long, part long, path string"), folder, "trees")

    blocks = max(1, ceil(asked.count() / BLOCK_QUERIES))
    shards = trees.select(F.col("cell").alias("_cell"), "part", "path")
    by_cell = shards.withColumn("slot", F.row_number().over(Window.partitionBy("_cell").orderBy("part")) - 1).withColumn(
        "parts", F.count("*").over(Window.partitionBy("_cell")))  # a part without entries has no tree

    def search(pairs: DataFrame) -> DataFrame:
        dealt = pairs.select("path", "uid", "v", "floor").repartition("path", F.pmod(F.xxhash64("uid"), F.lit(blocks)))
        return dealt.sortWithinPartitions("path").mapInArrow(
            _search(space, most, factor), "uid long, reached double, hits array<struct<score: double, vec_id: long, entry: long>>")

    homes = asked.mapInArrow(_home(cells), "uid long, v array<double>, cell long").withColumn("floor", F.lit(float("-inf")))
    home = homes.join(by_cell, F.col("cell") == F.col("_cell")).filter(
        F.col("slot") == F.pmod(F.xxhash64("uid"), "parts"))
    home = stage(home.select("path", "uid", "v", "floor"), folder, "home")
    at_home = stage(search(home), folder, "at-home")
    told = home.select("uid", "v", F.col("path").alias("_home")).join(
        at_home.select("uid", F.col("reached").alias("floor")).hint("merge"), "uid")
    visits = told.select("uid", "v", "floor", "_home").mapInArrow(
        _cells_to_visit(cells, factor), "uid long, v array<double>, floor double, _home string, go array<long>")
    away = visits.select("uid", "v", "floor", "_home", F.explode("go").alias("cell")).join(
        shards, F.col("cell") == F.col("_cell")).filter(F.col("path") != F.col("_home"))
    elsewhere = search(away)

    hits = at_home.select("uid", "hits").unionByName(elsewhere.select("uid", "hits")).select("uid", F.explode("hits").alias("h"))
    best = hits.withColumn("n", F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("h.score"), "h.vec_id"))).filter(
        F.col("n") <= most).groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("n", "h"))).alias("best"))
    named = queries.select("query_id", F.col("uid").alias("own")).join(best.hint("merge"), F.col("own") == F.col("uid"))
    own = F.array_position(F.transform("best", lambda x: (x["h"]["vec_id"] == F.col("query_id")) & (x["h"]["entry"] == F.col("own"))), True)
    others = F.slice(F.filter("best", lambda x, i: i + 1 != F.col("_own")), 1, k)
    return named.withColumn("_own", own).select("query_id", F.posexplode(others).alias("p", "x")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.when(F.col("x.h.vec_id") != NO_ID, F.col("x.h.vec_id")).alias("vec_id"),
        F.col("x.h.score").alias("score"))


def _home(cells: Cells):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                yield part.append_column("cell", pa.array(cells.of_queries(cells.space.matrix(part.column("v"))).argmin(1), pa.int64()))
    return run
