"""Exact top-k search for binary codes by incremental multi-index hashing.

Codes are the signs of an embedding's numbers, 64 bits to a word. A code is cut into segments, as many bits long as
the number of distinct codes has, and every segment indexes the codes by its value. A query looks at the values within
a radius of its own in every segment, first 0, then 1, and so on; after radius r in all of the m segments, every code at a
distance below m * (r + 1) has been seen. A query is finished when its k-th verified distance is below that.

The index lies in cells, random shares of the codes that are small enough for one task and hold the segment tables of
their codes. In every round the unfinished queries go to all cells, probe the tables there at the round's radius, verify
the full distance, and bring back the k best of the cell alone. Equal codes are one entry with the k smallest ids, so a
code that very many rows share costs no more than any other.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewheel.session import materialize

CELL_CODES = 1 << 16
SEGMENT_BITS = 16  # at most

_U = np.uint64


def sign_code(embedding: Column) -> Column:
    """The signs of a vector's numbers as an array of 64-bit words; null for a vector that is null, empty, or holds
    a null or a number that is not finite."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    words = F.transform(F.sequence(F.lit(0), F.floor((F.size(embedding) - 1) / 64).cast("int")), lambda w: F.aggregate(
        F.slice(embedding, w * 64 + 1, 64), F.struct(F.lit(0).cast("long").alias("code"), F.lit(0).alias("i")),
        lambda a, x: F.struct((a["code"] + F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), a["i"]))
                               .otherwise(0)).alias("code"), (a["i"] + 1).alias("i")), lambda a: a["code"]))
    return F.when((F.size(embedding) > 0) & ~bad, words)


def segments(codes: np.ndarray, bits: int, length: int) -> list[np.ndarray]:
    """The values of every segment of `length` bits of rows of words."""
    flat = np.unpackbits(np.ascontiguousarray(codes).view(np.uint8), axis=1, bitorder="little")[:, :bits]
    out = []
    for a in range(0, bits, length):
        part = flat[:, a:a + length].astype(np.int64)
        out.append(part @ (1 << np.arange(part.shape[1], dtype=np.int64)))
    return out


def masks(bits: int, radius: int) -> np.ndarray:
    return np.array([sum(1 << b for b in chosen) for chosen in combinations(range(bits), radius)], np.int64)


def _words(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().view(_U).reshape(-1, width)


def _probe(width: int, bits: int, length: int, radius: int, k: int):
    """The k best of a cell for each query, among the codes of which a segment differs from the query's in `radius` bits."""
    def probe(queries: pa.Table, codes: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "distance": []}
        if queries.num_rows and codes.num_rows:
            own, asked = _words(codes.column("code"), width), _words(queries.column("code"), width)
            tables = []
            for i, values in enumerate(segments(own, bits, length)):
                by = np.argsort(values, kind="stable")
                span = min(length, bits - i * length)
                tables.append((values[by], by, masks(span, radius) if radius <= span else np.empty(0, np.int64)))
            wanted = segments(asked, bits, length)
            ids = codes.column("ids").combine_chunks()
            id_first, id_values = ids.offsets.to_numpy(), ids.values.to_numpy()
            worst = queries.column("worst").to_numpy()
            enough = k + queries.column("own").to_numpy()  # some of them may be the query's own codes
            for q, name in enumerate(queries.column("query_id").to_pylist()):
                seen = []
                for (values, by, flips), keys in zip(tables, wanted):
                    keys = keys[q] ^ flips
                    lo, hi = np.searchsorted(values, keys), np.searchsorted(values, keys, "right")
                    n = hi - lo
                    seen.append(by[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())])
                at = np.unique(np.concatenate(seen))
                distance = np.bitwise_count(own[at] ^ asked[q]).sum(axis=1, dtype=np.int64)
                near = distance <= worst[q]
                at, distance = at[near], distance[near]
                if len(at) > enough[q]:
                    near = distance <= np.partition(distance, enough[q] - 1)[enough[q] - 1]
                    at, distance = at[near], distance[near]
                n = id_first[at + 1] - id_first[at]
                found = id_values[np.repeat(id_first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                far = np.repeat(distance, n)
                best = np.lexsort((found, far))
                best = best[found[best] != name][:k]
                out["query_id"] += [name] * len(best)
                out["vec_id"] += found[best].tolist()
                out["distance"] += far[best].tolist()
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})
    return probe


def search(vectors: DataFrame, k: int = 10, every: int = 50, id_col: str = "vec_id",
           embedding_col: str = "embedding") -> DataFrame:
    """The k nearest other vectors of every vector whose id is divisible by `every`, by the distance of their codes.

    query_id, rank from 1, vec_id and distance, in the order of distance and id. Fewer than k rows only if there are
    fewer other vectors of the same length. Vectors that are null or empty, hold a null or a number that is not finite, or
    have a null id are neither searched nor found. An id that several rows carry is one vector for each distinct code
    of it; such a vector is never its own neighbour. Vectors of different lengths are kept apart. Other columns are
    dropped; an empty table has no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.size(embedding_col).alias("bits"),
                          sign_code(F.col(embedding_col)).alias("code"))
    rows = materialize(rows.where("vec_id is not null and code is not null").distinct(), "codes")
    lengths = [r.bits for r in rows.select("bits").distinct().limit(1001).collect()]
    if len(lengths) > 1000:
        raise ValueError("more than 1000 lengths of vectors")
    result = None
    for bits in sorted(lengths):
        part = _search(rows.where(F.col("bits") == bits).select("vec_id", "code"), bits, k, every)
        result = part if result is None else result.unionByName(part)
    if result is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
                           F.lit(0).cast("long").alias("distance")).where("false")
    return result


def _search(rows: DataFrame, bits: int, k: int, every: int) -> DataFrame:
    width = -(-bits // 64)
    # k + 1 ids of each code, as one of them may be the query's own
    first = F.row_number().over(W.partitionBy("code").orderBy("vec_id"))
    codes = rows.withColumn("n", first).where(F.col("n") <= k + 1).groupBy("code").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids"))
    codes = materialize(codes, "distinct")
    count = codes.count()
    length = max(1, min(SEGMENT_BITS, bits, round(math.log2(max(count, 2)))))
    parts = -(-bits // length)
    cells = -(-count // CELL_CODES) or 1
    index = codes.withColumn("cell", F.pmod(F.xxhash64("code"), F.lit(cells)))
    queries = rows.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), "code", F.count("*").over(W.partitionBy("vec_id")).alias("own"))
    queries = materialize(queries, "queries")
    best = None
    active = queries.withColumn("worst", F.lit(bits).cast("long"))
    for radius in range(length + 1):
        sent = active.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))))
        met = sent.groupBy("cell").cogroup(index.groupBy("cell")).applyInArrow(
            _probe(width, bits, length, radius, k), "query_id long, vec_id long, distance long")
        seen = met if best is None else met.unionByName(best)
        rank = F.row_number().over(W.partitionBy("query_id").orderBy("distance", "vec_id"))
        best = materialize(seen.distinct().withColumn("rank", rank).where(F.col("rank") <= k).drop("rank"), "best")
        worst = best.groupBy("query_id").agg(F.count("*").alias("n"), F.max("distance").alias("far"))
        covered = parts * (radius + 1) - 1
        active = queries.join(worst, "query_id", "left").where(
            F.coalesce((F.col("n") < k) | (F.col("far") > covered), F.lit(True))).select(
            "query_id", "code", "own", F.when(F.col("n") >= k, F.col("far")).otherwise(bits).cast("long").alias("worst"))
        active = materialize(active, "active")
        if active.isEmpty():
            break
    order = W.partitionBy("query_id").orderBy("distance", "vec_id")
    return best.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "distance")
