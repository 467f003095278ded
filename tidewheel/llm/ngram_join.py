"""Jaccard self-join of documents on word n-grams, by vertical partitioning.

The n-grams have one global order, rare before frequent; how frequent they are comes from a count sketch of fixed
size over all documents. Two documents that are similar enough share one of the first n-grams of their sets in that
order, so candidates meet there. For verification the order is cut into fragments: every candidate's set is stored as
one segment per fragment, overlaps of segments are counted fragment by fragment, and the partial overlaps of a pair
are summed; the first fragment, of the rarest n-grams, is counted alone, as most pairs cannot be similar after that.

Documents with equal sets are one class throughout. Candidates that meet at an n-gram are first only compared with
one pivot of the n-gram, for a few pivots in turn; the first pivot is the document in which the n-gram comes earliest,
which is the one with the fewest rare n-grams of its own and so the likeliest to be similar to the others. Documents that
this has connected need no comparison with each other, as only components are asked for. What then still meets in
different components is compared pair by pair. So no link is lost, and a large group of near copies costs a few
comparisons per member.

Hashes have 64 bits: n-grams or sets of different documents are taken for equal with a chance of about pairs / 2^64.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewheel.llm.components import components
from tidewheel.llm.text import SMALL_BLOCK, Words, blocks, distinct, mix, release, segment_sum, shingles, words
from tidewheel.session import materialize

SKETCH_BITS = 20
SKETCH_PARTS = 64
LOAD_BITS = 20
FRAGMENTS = 8
PIVOTS = 2
SALTS = 64
BROADCAST_IDS = 500_000  # ids of 16 bytes each
BITMAP_WORDS = 8

_U = np.uint64


def sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-gram hashes of each document, where each begins, and each set's fingerprint."""
    block: Words = words(texts)
    values, first = distinct(*shingles(block, size))
    total = segment_sum(mix(values ^ _U(0x5851F42D4C957F2D)), first)
    prints = mix(total + np.diff(first).astype(_U) * _U(0x9E3779B97F4A7C15))
    return values, first, prints.view(np.int64)


def bitmaps(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A bit per cell of hashes, set when an odd number of a set's n-grams falls into the cell.

    Every n-gram that only one of two sets has changes one bit, so the bits in which two bitmaps differ are no more
    than the n-grams in which the sets differ.
    """
    cells = 64 * BITMAP_WORDS
    out = np.zeros((len(first) - 1, cells), np.uint8)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    odd = np.bincount(row * cells + ((values >> _U(24)) % _U(cells)).astype(np.int64), minlength=out.size) & 1
    return np.packbits(odd.reshape(out.shape).astype(np.uint8), axis=1).view(np.int64)


class Order:
    """The global order: the load of an n-gram's cell in the sketch, then its hash."""

    def __init__(self, load: np.ndarray):
        most = max(int(load.max()), 1)
        top = (1 << LOAD_BITS) - 1
        self.scaled = (load if most <= top else load * (top / most)).astype(np.uint32)
        self.hot = np.uint32(min(top, int(self.scaled.mean() * 8) + min(1000, top >> 4)))
        ascending = np.sort(self.scaled)
        mass = np.cumsum(ascending.astype(np.float64))
        self.cuts = ascending[np.searchsorted(mass, mass[-1] * np.arange(1, FRAGMENTS) / FRAGMENTS)]

    def keys(self, values: np.ndarray) -> np.ndarray:
        load = self.scaled[values & _U((1 << SKETCH_BITS) - 1)].astype(_U)
        return (load << _U(64 - LOAD_BITS)) | (values >> _U(LOAD_BITS))

    def load(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> _U(64 - LOAD_BITS)).astype(np.uint32)

    def fragment(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts, self.load(keys), "right").astype(np.int32)


def _survey(docs: DataFrame, size: int) -> DataFrame:
    """One pass over the texts: doc_id, text_hash, n, fp and bits of every row, and every task's part of the sketch."""
    schema = "doc_id long, text_hash long, n long, fp long, bits array<long>, part int, loads binary"
    names = ["doc_id", "text_hash", "n", "fp", "bits", "part", "loads"]

    def look(batches):
        load = np.zeros(1 << SKETCH_BITS, np.int64)
        release()
        for batch in blocks(batches, limit=SMALL_BLOCK):
            values, first, prints = sets(batch.column("text"), size)
            np.add.at(load, (values & _U((1 << SKETCH_BITS) - 1)).astype(np.int64), 1)
            n = np.diff(first)
            nothing = pa.nulls(len(n))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(n), pa.array(prints, mask=n == 0),
                 pa.array(list(bitmaps(values, first)), pa.list_(pa.int64())), nothing.cast(pa.int32()), nothing.cast(pa.binary())], names)
        if load.any():
            kind = np.uint16 if load.max() < 1 << 16 else np.uint64
            parts = [p.astype(kind).tobytes() for p in np.split(load, SKETCH_PARTS)]
            nothing = pa.nulls(SKETCH_PARTS, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[nothing] * 4, pa.nulls(SKETCH_PARTS, pa.list_(pa.int64())), pa.array(range(SKETCH_PARTS), pa.int32()), pa.array(parts, pa.binary())], names)

    return materialize(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(look, schema), "survey")


def _order(survey: DataFrame) -> Order:
    def add(rows: pa.Table) -> pa.Table:
        wide = (1 << SKETCH_BITS) // SKETCH_PARTS
        total = sum(np.frombuffer(x, np.uint16 if len(x) == 2 * wide else np.uint64).astype(np.uint64)
                    for x in rows.column("loads").to_pylist())
        return pa.table({"part": rows.column("part").slice(0, 1), "loads": pa.array([total.tobytes()], pa.binary())})

    parts = (survey.where("part is not null").select("part", "loads")
             .groupBy("part").applyInArrow(add, "part int, loads binary").collect())
    load = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.uint64)
    for row in parts:
        load[row.part] = np.frombuffer(row.loads, np.uint64)
    return Order(load.ravel())


def _prefixes(docs: DataFrame, size: int, percent: int, shared) -> DataFrame:
    """(g, salt, fp, n, p): the first n-grams of every class, with their places, that may be in another class too."""
    def cut(batches):
        order = shared.value
        seen: set[int] = set()
        release()
        for batch in blocks(batches, limit=SMALL_BLOCK):
            values, first, prints = sets(batch.column("text"), size)
            n = np.diff(first)
            fresh = np.zeros(len(n), bool)
            for d, fp in enumerate(prints.tolist()):  # copies within a task count once
                if n[d] and fp not in seen:
                    seen.add(fp)
                    fresh[d] = True
            keys = order.keys(values)
            for d in np.flatnonzero(fresh).tolist():
                keys[first[d]:first[d + 1]].sort()
            length = np.where(fresh, n - (percent * n + 99) // 100 + 1, 0)
            begin = np.cumsum(length) - length
            place = np.arange(length.sum()) - np.repeat(begin, length)
            g = keys[np.repeat(first[:-1], length) + place]
            fp = np.repeat(prints, length)
            salt = np.where(order.load(g) >= order.hot, fp & (SALTS - 1), -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(g.view(np.int64)), pa.array(fp), pa.array(np.repeat(n, length).astype(np.int32)),
                 pa.array((place + 1).astype(np.int32)), pa.array(salt)], ["g", "fp", "n", "p", "salt"])

    rows = docs.mapInArrow(cut, "g long, fp long, n int, p int, salt int")
    # n-grams of frequent cells are kept unseen, so that none of them gathers in one task
    members = _pivoted(rows, [F.col("p"), F.xxhash64("fp")], "g", "salt")
    return materialize(members.where("here > 1 or salt >= 0").select("g", "salt", "fp", "n", "p", "pivot"), "prefixes")


def _pivoted(rows: DataFrame, order: list[Column], *key: str) -> DataFrame:
    """`rows` with the first of the rows of their key, `pivot`, and the number of them, `here`."""
    by = W.partitionBy(*key).orderBy(*order)
    whole = by.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    member = F.struct(*[c for c in ("fp", "n", "p", "root") if c in rows.columns])
    rows = rows.repartition(*key)  # before the columns of the window are there, which would be shuffled too
    return rows.withColumns({"pivot": F.first(member).over(by), "here": F.count("*").over(whole)})


def _possible(percent: int, na: Column, pa_: Column, nb: Column, pb: Column) -> Column:
    """Whether sets of these sizes that first meet at these places can be similar enough."""
    sizes = F.least(na, nb) * 100 >= F.greatest(na, nb) * percent
    rest = F.least(na - pa_, nb - pb) + 1
    return sizes & (rest.cast("long") * (100 + percent) >= (na + nb).cast("long") * percent)


def _pairs(rows: DataFrame) -> DataFrame:
    return materialize(rows.select(F.col("pivot.fp").alias("a"), F.col("member.fp").alias("b"),
                                   F.col("pivot.n").alias("na"), F.col("member.n").alias("nb")).distinct(), "pairs")


def _with_pivots(rows: DataFrame) -> DataFrame:
    """(pivot, member): all members of an n-gram with its pivot; where it is hot, with a salt's pivot, and those with one."""
    member = F.struct(*[c for c in ("fp", "n", "p", "root") if c in rows.columns])
    heads = rows.where((F.col("salt") >= 0) & (F.col("pivot.fp") == F.col("fp"))).drop("pivot")
    heads = _pivoted(heads, [F.col("p"), F.xxhash64("fp")], "g").drop("here")
    return rows.select("pivot", member.alias("member")).unionByName(heads.select("pivot", member.alias("member")))


def _all_met(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(pivot, member): every two members of an n-gram whose bitmaps do not tell that they differ too much."""
    member = F.struct("fp", "n", "p", "root", "bits")
    rows = rows if "root" in rows.columns else rows.withColumn("root", F.col("fp"))
    full = rows.join(classes.select("fp", "bits"), "fp").select("g", member.alias("member"))
    a, b = F.col("pivot"), F.col("member")
    differ = F.aggregate(F.zip_with(a["bits"], b["bits"], lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                         F.lit(0), lambda total, x: total + x)
    near = differ * (100 + percent) <= (a["n"] + b["n"]) * (100 - percent)
    return full.withColumnRenamed("member", "pivot").join(full, "g").where(
        (a["fp"] < b["fp"]) & (a["root"] != b["root"]) & near)


def _small(df: DataFrame) -> DataFrame:
    """A broadcast of a frame of a few narrow columns, when it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def _still_open(rows: DataFrame, roots: DataFrame, turn: int) -> DataFrame:
    """The rows of n-grams whose members are in different components, with their roots as known now and a new pivot."""
    known = rows.drop("root", "pivot").join(_small(roots).withColumnRenamed("node", "fp"), "fp", "left")
    known = known.withColumn("root", F.coalesce("root", "fp"))
    able = F.col("p") * 9 > F.col("n") + 9  # beyond this place no set of the same size can be similar
    members = _pivoted(known, [able, F.xxhash64("fp", F.lit(turn))], "g", "salt")
    whole = W.partitionBy("g", "salt").orderBy(able, F.xxhash64("fp", F.lit(turn))).rowsBetween(
        W.unboundedPreceding, W.unboundedFollowing)
    members = members.withColumns({"least": F.min("root").over(whole), "most": F.max("root").over(whole)})
    return materialize(members.where("least < most or salt >= 0").drop("here", "least", "most"), "open")


def _segments(docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, shared, repeats: bool,
              first_only: bool) -> DataFrame:
    """(fp, fragment, grams) for every class in `pairs`, read from the text of its first document.

    `first_only` says whether the first fragment is wanted, or all others. `repeats` says that rows may be equal in id and text; all but one of those are left out.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    ids = classes.join(wanted, "fp", "left_semi").select(
        "fp", F.col("head.doc_id").alias("first"), F.col("head.text_hash").alias("first_hash"))
    same_row = F.col("doc_id").eqNullSafe(F.col("first")) & (F.xxhash64("text") == F.col("first_hash"))
    texts = docs.join(_small(materialize(ids, "wanted")), same_row).select("text")

    def cut(batches):
        order = shared.value
        release()
        for batch in blocks(batches, limit=SMALL_BLOCK):
            values, first, prints = sets(batch.column("text"), size)
            row = np.repeat(np.arange(len(prints)), np.diff(first))
            fragment = order.fragment(order.keys(values))
            some = np.flatnonzero((fragment == 0) == first_only)
            by = some[np.lexsort((fragment[some], row[some]))]
            row, values, fragment = row[by], values[by], fragment[by]
            edge = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (fragment[1:] != fragment[:-1])])
                                  ) if len(row) else np.empty(0, np.int64)
            grams = pa.ListArray.from_arrays(pa.array(np.append(edge, len(row)).astype(np.int32)),
                                             pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints[row[edge]]), pa.array(fragment[edge]), grams], ["fp", "fragment", "grams"])

    found = texts.mapInArrow(cut, "fp long, fragment int, grams array<long>")
    return materialize(found.dropDuplicates(["fp", "fragment"]) if repeats else found, "segments")


def _overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """(a, b, overlap): partial overlaps by fragment, summed per pair."""
    left = segments.select(F.col("fp").alias("a"), "fragment", F.col("grams").alias("grams_a"))
    right = segments.select(F.col("fp").alias("b"), "fragment", F.col("grams").alias("grams_b"))
    partial = left.join(_small(pairs.select("a", "b")), "a").join(right, ["b", "fragment"]).select(
        "a", "b", F.size(F.array_intersect("grams_a", "grams_b")).alias("overlap"))
    return partial.groupBy("a", "b").agg(F.sum("overlap").alias("overlap"))


def _links(pairs: DataFrame, segments, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar enough, by the partial overlaps of their fragments.

    The first fragment is counted alone. What a pair lacks there it cannot make up for: only pairs that could still be similar
    if all else were shared have their other fragments read and counted. `segments` gives those of pairs.
    """
    first = segments(pairs, True)
    sizes = first.select("fp", F.size("grams").alias("size"))
    sized = pairs.join(sizes.toDF("a", "sa"), "a", "left").join(sizes.toDF("b", "sb"), "b", "left").join(
        _overlaps(pairs, first), ["a", "b"], "left").fillna(0, ["sa", "sb", "overlap"])
    bound = F.col("overlap") + F.least(F.col("na") - F.col("sa"), F.col("nb") - F.col("sb"))
    able = materialize(sized.where(bound * 100 >= (F.col("na") + F.col("nb") - bound) * percent).select(
        "a", "b", "na", "nb", F.col("overlap").alias("so_far")), "able")
    if able.isEmpty():
        return able.select("a", "b")
    total = able.join(_overlaps(able, segments(able, False)), ["a", "b"], "left").withColumn(
        "overlap", F.col("so_far") + F.coalesce("overlap", F.lit(0)))
    return materialize(total.where(F.col("overlap") * 100 >= (F.col("na") + F.col("nb") - F.col("overlap")) * percent)
                       .select("a", "b"), "links")


def _linked(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The survey's rows, and for every class the first document of its component, by id, those without one last."""
    survey = _survey(docs, size)
    shared = docs.sparkSession.sparkContext.broadcast(_order(survey))
    prefixes = _prefixes(docs, size, percent, shared)
    rows = survey.where("part is null").select("doc_id", "text_hash", "n", "fp")
    head = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash"))
    classes = materialize(survey.where("fp is not null").groupBy("fp").agg(
        head.alias("head"), F.first("bits").alias("bits")), "classes")
    repeats = not rows.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty()
    edges, roots, members = [], None, prefixes
    for turn in range(PIVOTS + 1):
        met = _with_pivots(members) if turn < PIVOTS else _all_met(members, classes, percent)
        if roots is not None:
            met = met.where(F.col("pivot.root") != F.col("member.root"))
        pairs = _pairs(met.where((F.col("pivot.fp") != F.col("member.fp")) & _possible(
            percent, F.col("pivot.n"), F.col("pivot.p"), F.col("member.n"), F.col("member.p"))))
        if not pairs.isEmpty():
            edges.append(_links(pairs, lambda some, first: _segments(
                docs, classes, some, size, shared, repeats, first), percent))
            roots = components(functools.reduce(DataFrame.unionByName, edges))
        if turn < PIVOTS and roots is not None:
            members = _still_open(members, roots, turn)
    classes = classes.drop("bits")
    classes = (classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") if roots is not None
               else classes.withColumn("root", F.lit(None).cast("long")))
    classes = materialize(classes.withColumn("root", F.coalesce("root", "fp")), "classes")
    heads = classes.groupBy("root").agg(F.min("head").alias("head"))
    return rows, materialize(classes.select("fp", "root").join(heads, "root").select(
        "fp", F.col("head.doc_id").alias("first"), F.col("head.text_hash").alias("first_hash")), "heads")


def link(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles and component_id, the smallest doc_id it is connected with.

    Documents are linked when 100 * intersection >= percent * union of their sets of `size`-word n-grams. A shorter
    text is one n-gram; a null text or one without words has none, is linked with nothing and is its own component.
    Repeated rows are copies of each other. A null id takes part, but no component is named after it unless it has no
    other. Columns other than id and text are dropped; an empty table gives an empty result.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows, heads = _linked(narrow, size, percent)
    return rows.join(heads, "fp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("first")).alias("component_id"))


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """`docs`, with all its columns, without all but the first document of each component; see `link`.

    The first has the smallest id, or the smallest hash of its text among equal ids. Of rows that are equal in id and
    text one stays. Documents without words are linked with nothing, so they all stay.
    """
    rows, heads = _linked(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                      F.col("text").cast("string").alias("text")), size, percent)
    is_first = F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("text_hash") == F.col("first_hash"))
    judged = rows.where("fp is not null").join(heads, "fp").groupBy("doc_id", "text_hash").agg(
        F.max(is_first).alias("stays"), F.count("*").alias("times"))
    judged = materialize(judged.where("not stays or times > 1").select(
        F.col("doc_id").alias("key_id"), F.col("text_hash").alias("key_hash"), "stays"), "judged")
    side = F.broadcast(judged) if judged.count() <= BROADCAST_IDS else judged
    same = F.col("doc_id").eqNullSafe(F.col("key_id")) & (F.xxhash64("text") == F.col("key_hash"))
    kept = docs.join(side, same, "left_anti")
    if judged.where("stays").isEmpty():
        return kept
    names = docs.columns
    again = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    again = again.join(side.where("stays"), F.col("row.doc_id").eqNullSafe(F.col("key_id"))
                       & (F.xxhash64("row.text") == F.col("key_hash")))
    return kept.unionByName(again.groupBy("key_id", "key_hash").agg(F.min("row").alias("row")).select("row.*"))
