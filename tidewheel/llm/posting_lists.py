"""Approximate nearest neighbours by balanced posting lists.

A bounded sample of vectors is halved again and again between two centres, at the median, so that its leaves hold
equally many; their means are the centroids of the lists. All vectors are indexed: in the list of the nearest centroid,
and a boundary vector also in lists whose centroids are hardly further away, unless one of its lists lies between. Centroids
are found by a beam search over a graph of their nearest neighbours that every task holds in memory.

A query reads the lists whose centroid is at most `ratio` times as far away as the nearest one. The ratio is fitted: on
the sample it reaches TARGET_RECALL of all true neighbours. Vectors without any structure need most of their lists for
that; a query that has found too few reads all. Distances to what the lists hold are exact, from the original vectors.

Equal vectors are one class with its smallest ids. Neighbouring lists share a shard, in which a query keeps what it has found
from list to list, so that a query brings back its nearest of a shard, however many lists it reads there. Shards that
a dense region makes large, and the queries of a shard, are cut into blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewheel.session import materialize

SAMPLE = 131_072  # vectors at most on which the lists are fitted
SAMPLE_NUMBERS = 8_000_000  # and numbers in them
LIST_VECTORS = 128  # vectors of a list, as long as the sample can tell so many lists apart
LEAF = 4  # sampled vectors of a list at least
DEGREE = 16
ENTRIES = 32
BEAM = 32
EXPAND = 4
REPLICAS = 4
BOUNDARY = 1.15
TARGET_RECALL = 0.98
TRIALS = 512
SHARD_VECTORS = 32_768  # vectors that a task compares at once, about; lists next to each other share it
QUERY_BLOCK = 1024
SLICE = 512
_LARGEST = 1e100  # for the index alone


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, no null or non-finite number, not all zeros."""
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column, width: int) -> np.ndarray:
    """Vectors in double precision, padded with zeros to `width`."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy()
    return out


def squares(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.maximum((points ** 2).sum(axis=1)[:, None] + (others ** 2).sum(axis=1) - 2 * points @ others.T, 0)


def balanced(points: np.ndarray, leaf: int, rounds: int = 4) -> np.ndarray:
    """Means of leaves of at most `leaf` points, neighbours in the order of the halving next to each other."""
    rng, out, todo = np.random.default_rng(0), [], [points]
    while todo:
        part = todo.pop()
        if len(part) <= leaf:
            out.append(part.mean(axis=0))
            continue
        centres = part[rng.choice(len(part), 2, replace=False)]
        for _ in range(rounds):
            lean = part @ (centres[1] - centres[0])
            order = np.argsort(lean, kind="stable")
            half = len(part) // 2
            centres = np.stack([part[order[:half]].mean(axis=0), part[order[half:]].mean(axis=0)])
        todo += [part[order[half:]], part[order[:half]]]
    return np.array(out)


class Lists:
    """Centroids, the graph over them, and the fitted ratio of distances up to which a query reads lists."""

    def __init__(self, sample: np.ndarray, lists: int, k: int):
        self.centres = balanced(sample, max(LEAF, -(-len(sample) // max(1, lists))))
        self.square = (self.centres ** 2).sum(axis=1)
        n = len(self.centres)
        near = np.zeros((n, min(DEGREE, n - 1)), np.int64)
        for at in range(0, n, SLICE):
            part = np.arange(at, min(n, at + SLICE))
            far = squares(self.centres[part], self.centres)
            far[np.arange(len(part)), part] = np.inf
            near[part] = np.argsort(far, axis=1, kind="stable")[:, :near.shape[1]]
        beside = (np.arange(n)[:, None] + [-1, 1]) % n  # a ring through all leaves, so that every one can be reached
        self.graph = np.concatenate([near, beside], axis=1)
        self.entries = np.unique(np.linspace(0, n - 1, min(ENTRIES, n)).astype(np.int64))
        self.ratio = self._fit(sample, k)

    def _distances(self, points: np.ndarray, lists: np.ndarray) -> np.ndarray:
        cross = np.einsum("bd,bkd->bk", points, self.centres[lists])
        return np.sqrt(np.maximum((points ** 2).sum(axis=1)[:, None] + self.square[lists] - 2 * cross, 0))

    def nearest(self, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The `beam` nearest centroids that the graph leads to, nearest first, and how far they are."""
        beam = min(max(beam, len(self.entries)), len(self.centres))
        ids = np.repeat(self.entries[None], len(points), axis=0)
        far = self._distances(points, ids)
        seen = np.zeros(ids.shape, bool)
        ids, far, seen = self._best(ids, far, seen, beam)
        active = np.arange(len(points))
        while len(active):
            waiting = np.where(seen[active] | np.isinf(far[active]), np.inf, far[active])
            step = np.argsort(waiting, axis=1, kind="stable")[:, :EXPAND]
            rows = np.arange(len(active))[:, None]
            fresh = ~np.isinf(waiting[rows, step])
            seen[active[:, None], step] = True
            found = self.graph[np.where(fresh, ids[active[:, None], step], ids[active, :1])].reshape(len(active), -1)
            more = self._distances(points[active], found)
            width = ids.shape[1]
            best = self._best(np.concatenate([ids[active], found], axis=1), np.concatenate([far[active], more], axis=1),
                              np.concatenate([seen[active], np.zeros(found.shape, bool)], axis=1), beam)
            if best[0].shape[1] > width:
                grow = ((0, 0), (0, best[0].shape[1] - width))
                ids, far, seen = np.pad(ids, grow), np.pad(far, grow, constant_values=np.inf), np.pad(seen, grow)
            ids[active], far[active], seen[active] = (
                np.pad(x, ((0, 0), (0, ids.shape[1] - x.shape[1])), constant_values=v) for x, v in zip(best, (0, np.inf, True)))
            active = active[(~seen[active] & ~np.isinf(far[active])).any(axis=1)]
        order = np.argsort(far, axis=1, kind="stable")
        rows = np.arange(len(points))[:, None]
        return ids[rows, order], far[rows, order]

    @staticmethod
    def _best(ids, far, seen, beam):
        """The `beam` nearest of each row, each centroid once, expanded ones before their repetitions."""
        rows = np.arange(len(ids))[:, None]
        order = np.argsort(ids * 2 + ~seen, axis=1, kind="stable")
        ids, far, seen = ids[rows, order], far[rows, order], seen[rows, order]
        far = far.copy()
        far[:, 1:][ids[:, 1:] == ids[:, :-1]] = np.inf
        order = np.argsort(far, axis=1, kind="stable")[:, :beam]
        return ids[rows, order], far[rows, order], seen[rows, order]

    def homes(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, list) of the lists that hold each point: the nearest, and more for points on a boundary."""
        ids, far = self.nearest(points, BEAM)
        kept = np.zeros(ids.shape, bool)
        kept[:, 0] = True
        for j in range(1, ids.shape[1]):
            fits = (far[:, j] <= BOUNDARY * far[:, 0]) & ~np.isinf(far[:, j]) & (kept.sum(axis=1) < REPLICAS)
            for i in range(j):
                apart = np.sqrt(((self.centres[ids[:, i]] - self.centres[ids[:, j]]) ** 2).sum(axis=1))
                fits &= ~kept[:, i] | (apart >= far[:, j])
                if not fits.any():
                    break
            kept[:, j] = fits
        row, column = np.nonzero(kept)
        return row, ids[row, column]

    def reads(self, points: np.ndarray, ratio: float | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(point, list) of the lists that each query reads; the beam grows until the ratio is passed."""
        ratio = self.ratio if ratio is None else ratio
        rows, lists, todo, beam = [], [], np.arange(len(points)), BEAM
        while len(todo):
            ids, far = self.nearest(points[todo], beam)
            inside = (far <= ratio * far[:, :1]) & ~np.isinf(far)
            done = ~inside.all(axis=1) | (beam >= len(self.centres))
            row, column = np.nonzero(inside & done[:, None])
            rows.append(todo[row])
            lists.append(ids[row, column])
            todo, beam = todo[~done], beam * 4
        return np.concatenate(rows or [np.empty(0, np.int64)]), np.concatenate(lists or [np.empty(0, np.int64)])

    def _fit(self, sample: np.ndarray, k: int) -> float:
        """The ratio that finds TARGET_RECALL of the true neighbours that some sampled vectors have in the sample."""
        if len(sample) < 2:
            return 1.0
        needed = []
        for at in range(0, min(TRIALS, len(sample)), 64):
            asking = np.arange(at, min(at + 64, len(sample), TRIALS))
            far = squares(sample[asking], sample)
            far[np.arange(len(asking)), asking] = np.inf
            k = min(k, len(sample) - 1)
            true = np.argpartition(far, k - 1, axis=1)[:, :k]
            row, home = self.homes(sample[true.ravel()])
            to = np.sqrt(squares(sample[asking], self.centres))
            share = to / np.maximum(to.min(axis=1), 1e-300)[:, None]
            least = np.full(true.size, np.inf)
            np.minimum.at(least, row, share[row // k, home])
            needed.append(least)
        return float(np.quantile(np.concatenate(needed), TARGET_RECALL, method="higher")) * (1 + 1e-9)


def exact(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision."""
    with np.errstate(over="ignore"):
        apart = others - query
        out = np.sqrt((apart ** 2).sum(axis=1))
        for i in np.flatnonzero(~np.isfinite(out)):  # squares beyond the range
            largest = np.abs(apart[i]).max()
            out[i] = largest * np.sqrt(((apart[i] / largest) ** 2).sum()) if np.isfinite(largest) else np.inf
    return out


class _Best:
    """The k nearest so far of one query, ties to the smaller id; a class counts once."""
    __slots__ = ("far", "first", "node")

    def __init__(self):
        self.far, self.first, self.node = np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, far: np.ndarray, first: np.ndarray, node: np.ndarray, k: int) -> None:
        new = ~np.isin(node, self.node)
        far, first, node = (np.concatenate([x, y[new]]) for x, y in (
            (self.far, far), (self.first, first), (self.node, node)))
        order = np.lexsort((first, far))[:k]
        self.far, self.first, self.node = far[order], first[order], node[order]


def _compare(width: int, k: int):
    """A block of queries against a block of a shard, list by list: the k nearest of each query in the lists it reads.

    What a query has found so far bounds what it looks at in the next list.
    """
    def compare(queries: pa.Table, base: pa.Table) -> pa.Table:
        best: dict[int, _Best] = {}
        if queries.num_rows and base.num_rows:
            b, q = (matrix(t.column("vector"), width) for t in (base, queries))
            nodes, first, of = (base.column(c).to_numpy() for c in ("node", "first", "list"))
            names, lists = queries.column("node").to_numpy(), queries.column("lists").combine_chunks()
            reads, who = lists.flatten().to_numpy(), np.repeat(np.arange(len(q)), np.diff(lists.offsets.to_numpy()))
            order, wants = np.argsort(of, kind="stable"), np.argsort(reads, kind="stable")
            bound = np.full(len(q), np.inf)
            for number in np.unique(reads).tolist():
                held = order[slice(*np.searchsorted(of[order], [number, number + 1]))]
                here = who[wants[slice(*np.searchsorted(reads[wants], [number, number + 1]))]]
                for at in range(0, len(here) if len(held) else 0, SLICE):
                    _list(q, here[at:at + SLICE], b, held, first, nodes, bound, best, k)
        rows = [(int(names[i]), n, f) for i, found in best.items() for n, f in zip(found.node.tolist(), found.far.tolist())]
        return pa.table({"query": pa.array([r[0] for r in rows], pa.int64()), "node": pa.array([r[1] for r in rows], pa.int64()),
                         "far": pa.array([r[2] for r in rows], pa.float64())})
    return compare


def _list(q, here, b, held, first, nodes, bound, best, k) -> None:
    """Queries `here` against the vectors `held` of one list."""
    with np.errstate(over="ignore", invalid="ignore"):
        own, lengths = (q[here] ** 2).sum(axis=1)[:, None], (b[held] ** 2).sum(axis=1)
        about = own + lengths - 2 * q[here] @ b[held].T
        slack = 1e-9 * (own[:, 0] + lengths.max())
        about = np.where(np.isfinite(about) & np.isfinite(slack)[:, None], about, -np.inf)
        n = min(k, len(held)) - 1
        limit = np.minimum(np.partition(about, n, axis=1)[:, n], bound[here] ** 2) if n + 1 == k \
            else bound[here] ** 2
        near = ~(about > (limit + 2 * slack)[:, None])
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            some, name = held[near[i]], int(here[i])
            found = best.setdefault(name, _Best())
            found.add(exact(q[here[i]], b[some]), first[some], nodes[some], k)
            if len(found.far) == k:
                bound[name] = found.far[-1]


def _placed(classes: DataFrame, width: int, shared, queries: bool) -> DataFrame:
    """A row for every list that holds a vector, with the vector, or for every list that a query reads, without."""
    columns = ["size", "node"] if queries else ["size", "node", "first", "vector"]

    def place(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                points = np.clip(matrix(batch.column("vector"), width), -_LARGEST, _LARGEST)
                row, lists = (shared.value.reads if queries else shared.value.homes)(points)
                taken = batch.select(columns).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(lists.astype(np.int32))], [*columns, "list"])

    schema = ", ".join(f"{c} {classes.schema[c].dataType.simpleString()}" for c in columns)
    return classes.mapInArrow(place, f"{schema}, list int")


def _shards(base: DataFrame) -> DataFrame:
    """(size, list, shard): neighbouring lists together hold about SHARD_VECTORS; a row per list is all this looks at."""
    held = base.groupBy("size", "list").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(W.partitionBy("size").orderBy("list")) - F.col("n")
    return materialize(held.select("size", "list", F.floor(upto / SHARD_VECTORS).alias("shard")), "shards")


def _met(base: DataFrame, reads: DataFrame, asking: DataFrame, shards: DataFrame, width: int, k: int) -> DataFrame:
    """(query, node, far): for every query, shard and block the nearest. `reads` has the lists of the queries `asking`."""
    key = ["size", "shard"]
    base = base.join(shards, ["size", "list"])
    asked = reads.join(shards, ["size", "list"]).groupBy(*key, "node").agg(F.collect_list("list").alias("lists")).join(
        asking.select("node", "vector"), "node")
    asked = materialize(asked, "asked")
    cells = materialize(base.groupBy(*key).agg(F.ceil(F.count("*") / (2 * SHARD_VECTORS)).alias("base_blocks")).join(
        asked.groupBy(*key).agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("query_blocks")), key), "cells")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        every = F.sequence(F.lit(0).cast("long"), F.col(f"{other}_blocks") - 1)
        return rows.join(cells, key).withColumn(own, F.pmod(F.xxhash64("node"), F.col(f"{own}_blocks"))).withColumn(
            other, F.explode(every)).drop("base_blocks", "query_blocks")

    block = [*key, "base", "query"]
    one, two = dealt(asked, "query", "base"), dealt(base, "base", "query")
    two = two.toDF(*two.columns)  # fresh columns, as both sides stem from one frame
    return materialize(one.groupBy(*block).cogroup(two.groupBy(*block)).applyInArrow(
        _compare(width, k), "query long, node long, far double"), "met")


def _fitted(classes: DataFrame, count: int, width: int, k: int) -> Lists:
    wanted = max(1, min(SAMPLE, SAMPLE_NUMBERS // width))
    rows = classes.select("vector", "node") if count <= wanted else classes.select("vector", "node").orderBy(
        F.xxhash64("node")).limit(wanted)
    table = rows.toArrow()
    order = np.argsort(table.column("node").to_numpy() * np.int64(0x9E3779B97F4A7C1) % np.int64(1_000_003), kind="stable")
    sample = np.clip(matrix(table.column("vector"), width), -_LARGEST, _LARGEST)[order]
    return Lists(sample, -(-count // LIST_VECTORS), k)


def search(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id",
           embedding_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every vector whose id is divisible by `every`.

    Nearness is the Euclidean distance in double precision, ties go to the smaller id. All other rows are candidates;
    rows equal in id and vector are one, and an id is never its own neighbour. A vector that is null, empty or zero, or holds
    a null or a number that is not finite, takes no part, nor does a row without an id. Only vectors of one length are
    compared; a query with fewer than k candidates has them all. Other columns are dropped; an empty table has no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(embedding_col).alias("vector")).where(
        F.col("vec_id").isNotNull() & usable(F.col("vector")))
    print_ = [F.xxhash64("vector").alias("one"), F.xxhash64(F.lit("other"), "vector").alias("two")]
    single = rows.select("*", *print_).groupBy("vec_id", "one", "two").agg(F.any_value("vector").alias("vector"))
    place = F.row_number().over(W.partitionBy("one", "two").orderBy("vec_id"))
    few = single.withColumn("place", place).where(F.col("place") <= k + 1)
    classes = few.groupBy("one", "two").agg(
        F.any_value("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        "one", "two", "vector", "ids", F.col("ids")[0].alias("first"), F.size("vector").alias("size"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id", *print_).distinct().join(
        classes.select("one", "two", "node"), ["one", "two"]).select(F.col("vec_id").alias("query_id"), "node")
    queries = materialize(queries, "queries")
    asking = classes.join(queries.select("node").distinct(), "node", "left_semi")
    sizes = materialize(classes.groupBy("size").agg(F.count("*").alias("classes")), "sizes")
    count, width = sizes.agg(F.coalesce(F.sum("classes"), F.lit(0)), F.coalesce(F.max("size"), F.lit(1))).first()
    if not count:
        return queries.select("query_id", F.lit(1).alias("rank"), F.col("node").alias("vec_id"), F.lit(0.0).alias("score"))
    shared = vectors.sparkSession.sparkContext.broadcast(_fitted(classes, count, width, k))
    base = materialize(_placed(classes, width, shared, False), "base")
    reads = materialize(_placed(asking, width, shared, True), "reads")
    shards = _shards(base)
    met = _met(base, reads, asking, shards, width, k + 1)
    found = met.groupBy("query").agg(F.count_distinct("node").alias("found"))
    short = materialize(asking.join(found, F.col("node") == F.col("query"), "left").join(sizes, "size").where(
        F.coalesce("found", F.lit(0)) < F.least(F.lit(k + 1), "classes")).select("size", "node", "vector"), "short")
    if not short.isEmpty():
        lists = base.select("size", "list").distinct()
        met = met.unionByName(_met(base, short.join(lists, "size").drop("vector"), short, shards, width, k + 1))
    once = met.groupBy("query", "node").agg(F.min("far").alias("far")).join(classes.select("node", "ids"), "node")
    each = once.select("query", "far", F.explode("ids").alias("vec_id"))
    best = each.withColumn("place", F.row_number().over(W.partitionBy("query").orderBy("far", "vec_id"))).where(
        F.col("place") <= k + 1)
    listed = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("far", "vec_id"))).alias("near"))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return queries.join(listed, F.col("node") == F.col("query")).select(
        "query_id", F.posexplode(others).alias("rank", "hit")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.far").alias("score"))
