"""Embedding near-duplicates by product quantisation.

Coarse inverted lists partition the unit vectors by their nearest centroid; a vector's residual is stored as one code
per subspace, together with its exact quantisation error. As a query, a vector probes every list that can hold a
neighbour: a point within the search radius that lies in another list must lie beyond the plane between the two
centroids, so lists whose plane is further away than the radius are left out, and no others. In a list, asymmetric
distances are sums of table entries; by the triangle inequality a code further away than the radius plus its own error
cannot be a neighbour. What remains is judged by the exact cosine in double precision. So nothing is lost, whatever the
sample was that centroids and code books are fitted on; a poor fit only costs time.

Equal vectors are one class. Lists are cut into blocks of a bounded number of vectors, on both sides, and a block brings
back one count for each query and at most one edge for each vector, so a dense group of near copies is never
expanded into pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.components import components
from tidewheel.session import materialize

SAMPLE = 32_768  # vectors at most on which centroids and code books are fitted
MAX_LISTS = 1024
SUBSPACES = 8
BLOCK_VECTORS = 4096
SLICE = 256
_SLACK = 1e-9


def usable(vector: Column, label: Column) -> Column:
    """Whether a vector can be linked at all."""
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(label.isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


def _k_means(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres of the points, which come in random order."""
    centres = points[:k].copy()
    for _ in range(rounds):
        near = _nearest(points, centres)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
    return centres


class Quantiser:
    """Coarse centroids and, for each subspace, a code book of residuals; vectors are padded to `width` numbers."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = SUBSPACES):
        self.centres = _k_means(sample, min(lists, len(sample)))
        rest = sample - self.centres[_nearest(sample, self.centres)]
        self.books = [_k_means(part, min(256, len(sample))) for part in np.split(rest, subspaces, axis=1)]
        self.apart = np.sqrt(np.maximum(((self.centres[:, None] - self.centres[None]) ** 2).sum(axis=2), 0)) \
            if len(self.centres) <= 64 else self._apart()

    def _apart(self) -> np.ndarray:
        square = (self.centres ** 2).sum(axis=1)
        return np.sqrt(np.maximum(square[:, None] + square[None] - 2 * self.centres @ self.centres.T, 0))

    def probes(self, units: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every vector's own list, and the pairs of a vector and a list that it has to probe."""
        squared = (units ** 2).sum(axis=1)[:, None] + (self.centres ** 2).sum(axis=1) - 2 * units @ self.centres.T
        home = squared.argmin(axis=1)
        ahead = squared - squared[np.arange(len(units)), home][:, None]
        reach = ahead <= 2 * (radius + _SLACK) * self.apart[home] + _SLACK
        return home, *np.nonzero(reach)

    def encode(self, units: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and how far the coded vectors are from the true ones."""
        rest = units - self.centres[home]
        parts = np.split(rest, len(self.books), axis=1)
        codes = np.stack([_nearest(p, book) for p, book in zip(parts, self.books)], axis=1).astype(np.uint8)
        error = sum(((p - book[codes[:, m]]) ** 2).sum(axis=1) for m, (p, book) in enumerate(zip(parts, self.books)))
        return codes, np.sqrt(error)

    def distances(self, queries: np.ndarray, of: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric squared distances of queries and the coded vectors of list `of`, by table look-up."""
        total = np.zeros((len(queries), len(codes)))
        parts = np.split(queries - self.centres[of], len(self.books), axis=1)
        for m, (p, book) in enumerate(zip(parts, self.books)):
            table = (p ** 2).sum(axis=1)[:, None] + (book ** 2).sum(axis=1) - 2 * p @ book.T
            total += table[:, codes[:, m]]
        return total


def _matrix(column, sizes: np.ndarray, width: int) -> np.ndarray:
    """Vectors in double precision, padded with zeros."""
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat.to_numpy()
    return out


def _fit(classes: DataFrame, count: int, width: int) -> Quantiser:
    lists = max(1, min(MAX_LISTS, math.ceil(math.sqrt(count))))
    wanted = min(SAMPLE, 64 * lists)
    rows = classes.select("vector").orderBy(F.xxhash64("node")).limit(wanted).collect()
    sizes = np.array([len(r.vector) for r in rows])
    sample = _matrix(pa.array([r.vector for r in rows], pa.list_(pa.float64())), sizes, width)
    sample /= np.abs(sample).max(axis=1, keepdims=True)
    return Quantiser(sample / np.linalg.norm(sample, axis=1, keepdims=True), lists)


def _assign(classes: DataFrame, width: int, radius: float, shared) -> DataFrame:
    """Every class as a base row in its own list, and as a query row in each list that it probes."""
    def assign(batches):
        model = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sizes = batch.column("size").to_numpy()
                units = _matrix(batch.column("vector"), sizes, width)
                units /= np.abs(units).max(axis=1, keepdims=True)
                units /= np.linalg.norm(units, axis=1, keepdims=True)
                home, who, where = model.probes(units, radius)
                codes, error = model.encode(units, home)
                row = np.concatenate([np.arange(len(units)), who])
                base = np.arange(len(row)) < len(units)
                raw = [c.tobytes() for c in codes] + [None] * len(who)
                taken = batch.select(["label", "size", "node", "copies", "vector"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(np.concatenate([home, where]).astype(np.int32)), pa.array(base),
                     pa.array(raw, pa.binary()), pa.array(np.concatenate([error, np.zeros(len(who))]))],
                    ["label", "size", "node", "copies", "vector", "list", "base", "code", "error"])

    label = classes.schema["label"].dataType.simpleString()
    schema = (f"label {label}, size int, node long, copies long, vector array<double>, list int, base boolean, "
              "code binary, error double")
    return materialize(classes.mapInArrow(assign, schema), "assigned")


def _compare(width: int, threshold: float, radius: float, shared):
    """A block of queries against a block of a list: links of each query, and edges that join what is linked."""
    def compare(queries: pa.Table, base: pa.Table) -> pa.Table:
        counted, edges = ([], []), ([], [])
        if queries.num_rows and base.num_rows:
            model, of = shared.value, base.column("list")[0].as_py()
            b, q = (_matrix(t.column("vector"), t.column("size").to_numpy(), width) for t in (base, queries))
            b, q = (x / np.abs(x).max(axis=1, keepdims=True) for x in (b, q))
            b, q = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (b, q))
            codes = np.frombuffer(b"".join(base.column("code").to_pylist()), np.uint8).reshape(len(b), -1)
            limit = (radius + base.column("error").to_numpy() + _SLACK) ** 2 + _SLACK
            names, copies = base.column("node").to_numpy(), base.column("copies").to_numpy()
            asking = queries.column("node").to_numpy()
            group = np.arange(len(b))
            linked_to = np.full(len(q), -1)
            linked = np.zeros(len(b), bool)
            for at in range(0, len(q), SLICE):
                part = slice(at, at + SLICE)
                near = model.distances(q[part], of, codes) <= limit
                some = np.flatnonzero(near.any(axis=0))
                links = near[:, some] & (q[part] @ b[some].T >= threshold) & (names[some] != asking[part, None])
                n = links @ copies[some]
                hit = np.flatnonzero(n)
                counted[0].extend(asking[part][hit].tolist())
                counted[1].extend(n[hit].tolist())
                for i in hit.tolist():
                    to = some[links[i]]
                    linked[to] = True
                    roots = np.unique(group[to])
                    if len(roots) > 1:
                        group[np.isin(group, roots)] = roots[0]
                    linked_to[at + i] = to[0]
            found = np.flatnonzero(linked)
            edges[0].extend(names[found].tolist() + asking[linked_to >= 0].tolist())
            edges[1].extend(names[group[found]].tolist() + names[group[linked_to[linked_to >= 0]]].tolist())
        return pa.table({
            "a": pa.array(counted[0] + edges[0], pa.int64()),
            "b": pa.array([None] * len(counted[0]) + edges[1], pa.int64()),
            "n": pa.array(counted[1] + [None] * len(edges[0]), pa.int64())})
    return compare


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id",
                    embedding_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per row: vec_id, n_links, component_id and kept.

    Two vectors of the same label and length are linked when their cosine is at least `threshold`; `component_id` is the
    smallest id that is reachable by links. A vector that is null, zero or empty, or holds a null or a number that is
    not finite, and one without a label, is linked with nothing. Repeated rows are vectors of their own, linked with each other.
    A row without an id counts as a neighbour, but gives its component no name unless no other row of it has an id.
    Other columns are dropped; an empty table has no rows.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a cosine above 0")
    radius = math.sqrt(2 - 2 * threshold)
    vector = F.col(embedding_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.when(usable(F.col(embedding_col), F.col(label_col)), vector).alias("vector"))
    rows = rows.withColumn("node", F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector")))
    names = materialize(rows.select("vec_id", "node"), "names")
    classes = rows.where("node is not null").groupBy("label", "vector", "node").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    classes = materialize(classes.withColumn("size", F.size("vector")), "classes")
    count, longest = classes.agg(F.count("*"), F.max("size")).first()
    sums = classes.select("node", "first", "copies", F.lit(0).cast("long").alias("n"), F.col("node").alias("root"))
    if count:
        width = -(-longest // SUBSPACES) * SUBSPACES
        shared = vectors.sparkSession.sparkContext.broadcast(_fit(classes, count, width))
        assigned = _assign(classes, width, radius, shared)
        key = ["label", "size", "list"]
        cells = materialize(assigned.groupBy(*key).agg(
            F.ceil(F.count_if("base") / BLOCK_VECTORS).alias("base_blocks"),
            F.ceil(F.count_if(~F.col("base")) / BLOCK_VECTORS).alias("query_blocks")), "cells")
        placed = assigned.join(cells, key)
        one, other = F.pmod(F.xxhash64("node"), F.col("base_blocks")), F.pmod(F.xxhash64("node"), F.col("query_blocks"))
        base = placed.where("base").withColumn("bb", one).withColumn(
            "qb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_blocks") - 1)))
        asked = placed.where("not base and base_blocks > 0").withColumn("qb", other).withColumn(
            "bb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("base_blocks") - 1)))
        block = [*key, "bb", "qb"]
        base = base.toDF(*base.columns)  # fresh columns, as both sides stem from one frame
        met = asked.groupBy(*block).cogroup(base.groupBy(*block)).applyInArrow(
            _compare(width, threshold, radius, shared), "a long, b long, n long")
        met = materialize(met, "met")
        links = met.where("n is not null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
        roots = components(met.where("b is not null").select("a", "b"))
        sums = (sums.drop("n", "root").join(links, "node", "left").join(roots, "node", "left")
                .withColumns({"n": F.coalesce("n", F.lit(0)), "root": F.coalesce("root", "node")}))
    sums = materialize(sums, "sums")
    least = sums.groupBy("root").agg(F.min("first").alias("component_id"))
    known = materialize(sums.join(least, "root").select(
        "node", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id"), "known")
    out = names.join(known, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
