"""Near-duplicate passages across documents, by compact windows.

A passage is a run of at least `least` words; two passages are near duplicates when the sets of their `size`-word
n-grams have a Jaccard similarity of at least `percent`. Under each of HASHES hash functions, the Cartesian tree over
the hashes of a document's n-grams has a node for every n-gram: the window in which its hash is the smallest. All runs
of words inside a window that hold the node share the min-hash, so only nodes whose window is long enough for a passage
matter, about two in `least` n-grams. Near-duplicate passages share the node's hash with a chance of their similarity
per function, equal ones under every function.

Two runs are near duplicates when MIN_HASHES of their min-hashes agree or more. So a run of which fewer are shared with any
other document is out, and of the others only the rarest need to meet: with K functions, two runs that agree in m of them
agree in one of the K - m + 1 rarest of both. Windows that are among those for no run are left out; a frequent line alone brings
no documents together.
Documents whose windows meet in a hash are first joined with the anchor of the hash, the document of the smallest id. What is joined
are documents and hashes, not places. A pair that meets is verified, once and whole: its equal stretches of n-grams are chained along both
documents, and every part of a chain that is long enough and whose sets of n-grams are similar enough is a passage. A passage begins and
ends with n-grams that the other document has too. All n-grams are compared by 64-bit hashes.
A window is known when its own n-gram, the smallest, lies in a found passage of its document; known windows are not met as the
later ones, or the documents of a frequent passage would all meet in it. What goes on beyond a found passage is met by the
windows beyond. Of the hashes with windows that are not known yet, the n-grams around every window are compared with those around
each earlier one: two of which no runs can be similar do not meet. The others meet one after another, in every round twice as
many, until the window is known or has met them all.

Documents with the same words are one class, of which the first stands for all.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.llm.text import SHINGLE, SMALL_BLOCK, blocks, joined, mix, release, segment_sum, shingles, words
from tidewheel.session import materialize

HASHES = 6
MIN_HASHES = 5
NEARBY = 0.95  # share of what the least similar runs have in common that two windows need around them, as longer passages vary
TURNS = (1, 2, 4, 8, 16)  # a window meets one document, then two more, four more and eight more, of those found for it
FREQUENT = 1 << 30  # stands for the count of a hash that is dealt out
HOT = 8  # windows of a task that share a hash; from then on they are dealt out by document
SALTS = 64
BROADCAST_IDS = 500_000  # ids, or ends of spans, of 16 bytes each
SEEN = 1 << 17  # fingerprints that a task remembers, to leave out copies before the shuffle
SKETCH = 1 << 20  # counters of a task's window hashes
SLIP = 8  # n-grams that equal stretches may overlap where words were put in or left out

_U = np.uint64
_SEED = mix(np.arange(1, HASHES + 1, dtype=_U) * _U(0xC2B2AE3D27D4EB4F))


def prints(grams: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A fingerprint of each document's row of words."""
    place = (np.arange(len(grams)) - np.repeat(first[:-1], np.diff(first))).astype(_U)
    return mix(segment_sum(mix(grams + place * _U(0x9E3779B97F4A7C15)), first) + counts.astype(_U)).view(np.int64)


def window_nodes(hashes: np.ndarray, first: np.ndarray, least: int) -> np.ndarray:
    """The places whose hash is the smallest of some run of `least` in their document; of equal ones the leftmost."""
    return windows_of(hashes, first, least)[0]


def windows_of(hashes: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those places, and how far the window of each goes back and ahead, up to what a run of `least` can reach.

    Documents stand apart by zeros, which end every window; windows are followed no further than `least`.
    """
    docs = len(first) - 1
    apart = np.zeros(len(hashes) + docs + 1, _U)
    where = np.arange(len(hashes)) + np.repeat(np.arange(1, docs + 1), np.diff(first))
    apart[where] = np.maximum(hashes, _U(1))
    levels = [apart]  # the smallest of the 2^j values from each place on
    while 1 << len(levels) <= least:
        half = 1 << (len(levels) - 1)
        last = levels[-1]
        level = last.copy()
        level[:-half] = np.minimum(last[:-half], last[half:])
        level[-half:] = 0
        levels.append(level)
    half = max(1, least // 2)  # a long window reaches this far to one side
    reach = half.bit_length() - 1
    behind = np.zeros(len(apart), _U)
    step = 1 << reach
    behind[step - 1:] = levels[reach][:max(0, len(apart) - step + 1)]
    node = where[(levels[reach][where] >= apart[where]) | (behind[where] >= apart[where])]
    value = apart[node]
    right, left = node.copy(), node.copy()
    for j in range(len(levels) - 1, -1, -1):
        step = 1 << j
        at = np.minimum(right + 1, len(apart) - 1)
        right += np.where(levels[j][at] >= value, step, 0)
        at = left - step
        left -= np.where((at > 0) & (levels[j][np.maximum(at, 0)] > value), step, 0)
    wide = right - left + 1 >= least
    back, ahead = (np.minimum(x[wide], least - 1) for x in (node - left, right - node))
    node = node[wide]
    return node - np.searchsorted(first[:-1] + np.arange(1, docs + 1), node, "right"), back, ahead


def repeats_before(values: np.ndarray, grams: np.ndarray, at: np.ndarray, back: np.ndarray, ahead: np.ndarray,
                   doc: np.ndarray) -> np.ndarray:
    """Which windows have an earlier one of the same value and the same n-grams in the same document.

    Both stand for the same passages, so the first of them meets other documents for all.
    """
    power = np.cumprod(np.full(len(grams) + 1, 0xD1342543DE82EF95, _U))
    turned = np.cumprod(np.full(len(grams) + 1, pow(0xD1342543DE82EF95, -1, 1 << 64), _U))
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix(grams) * power[:-1])])
    around = mix((sums[at + ahead + 1] - sums[at - back]) * turned[at - back] + back.astype(_U))
    order = np.lexsort((at, around, values, doc))
    same = np.zeros(len(at), bool)
    one, two = order[:-1], order[1:]
    same[two] = (doc[one] == doc[two]) & (values[one] == values[two]) & (around[one] == around[two])
    return same


def _survey(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, n_words and fp, the fingerprint of the words, of every row."""
    def look(batches):
        release()
        for batch in blocks(batches, limit=SMALL_BLOCK):
            block = words(batch.column("text"))
            counts = np.diff(block.first)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(counts),
                 pa.array(prints(*shingles(block, size), counts))], ["doc_id", "text_hash", "n_words", "fp"])

    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    return materialize(hashed.mapInArrow(look, "doc_id long, text_hash long, n_words long, fp long"), "survey")


def _windows(docs: DataFrame, size: int, least: int) -> DataFrame:
    """(v, fp, c): the nodes that have to meet windows of other documents.

    v holds the function's number. Of equal windows of a document only the first has a row."""
    def cut(batches):
        seen: set[int] = set()
        counted = np.zeros(SKETCH, np.int32)
        release()
        for batch in blocks(batches, limit=SMALL_BLOCK):
            if len(seen) > SEEN:
                seen.clear()
            block = words(batch.column("text"))
            grams, first = shingles(block, size)
            own = prints(grams, first, np.diff(block.first))
            fresh = np.zeros(len(own), bool)
            for d, fp in enumerate(own.tolist()):  # copies within a task count once
                if fp not in seen:
                    seen.add(fp)
                    fresh[d] = True
            doc = np.repeat(np.arange(len(own)), np.diff(first))
            values, nodes, backs, aheads = [], [], [], []
            for k in range(HASHES):
                hashes = mix(grams ^ _SEED[k])
                at, back, ahead = windows_of(hashes, first, least - size + 1)
                new = fresh[doc[at]]
                at = at[new]
                values.append((hashes[at] & ~_U(7)) | _U(k))
                nodes.append(at)
                backs.append(back[new])
                aheads.append(ahead[new])
            v, at, back, ahead = (np.concatenate(x) for x in (values, nodes, backs, aheads))
            once = ~repeats_before(v, grams, at, back, ahead, doc[at])
            v, at, back, ahead = v[once], at[once], back[once], ahead[once]
            place, fp = _packed(at - first[doc[at]], back, ahead), own[doc[at]]
            kinds, which, often = np.unique(v, return_inverse=True, return_counts=True)
            cell = ((kinds >> _U(8)) % _U(SKETCH)).astype(np.int64)
            np.add.at(counted, cell, often)
            frequent = counted[cell] >= HOT
            salt = np.where(frequent[which], fp & (SALTS - 1), -1)
            hot = kinds[frequent]  # known to be shared; one row tells those that are alone elsewhere
            mark = np.zeros(len(hot), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([v, hot]).view(np.int64)), pa.array(np.concatenate([fp, mark])),
                 pa.array(np.concatenate([place, mark - 1])), pa.array(np.concatenate([salt, mark - 1]).astype(np.int32))],
                ["v", "fp", "place", "salt"])

    rows = docs.mapInArrow(cut, "v long, fp long, place long, salt int")
    here = W.partitionBy("v", "salt")
    met = rows.withColumns({"least": F.min("fp").over(here), "most": F.max("fp").over(here),
                            "mark": F.min("place").over(here), "n": F.count("*").over(here)})
    often = F.when((F.col("salt") >= 0) | (F.col("mark") < 0), FREQUENT).otherwise(F.col("n"))  # alike for all documents
    met = met.where("(least < most or salt >= 0) and place >= 0").select("v", "fp", "place", often.cast("long").alias("n"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = met.repartition(n, "fp").sortWithinPartitions("fp")
    return materialize(dealt.mapInArrow(_rarest(least - size + 1), "v long, fp long, c int"), "rarest")


def _packed(c: np.ndarray, back: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """A window's place and its two reaches, which are below 2^12, as one number."""
    return (c.astype(np.int64) << 24) | (back << 12) | ahead


def needed(fp: np.ndarray, v: np.ndarray, place: np.ndarray, often: np.ndarray, least: int) -> np.ndarray:
    """Which shared windows are, for some run of `least` n-grams, among the rarest that have to meet."""
    c, back, ahead = place >> 24, place >> 12 & 0xFFF, place & 0xFFF
    first, last = np.maximum(c - back, c - least + 1), np.minimum(c, c + ahead - least + 1)
    n = np.maximum(last - first + 1, 0)
    row = np.repeat(np.arange(len(v)), n)
    run = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    rare = np.empty(len(v), np.int64)
    rare[np.lexsort((v, often))] = np.arange(len(v))
    document = np.unique(fp, return_inverse=True)[1]
    begin = np.zeros(document.max(initial=-1) + 2, np.int64)
    np.maximum.at(begin[1:], document, last + 2)  # documents one after another, with room for all their runs
    at = np.cumsum(begin)[document][row] + run + 1
    order = np.lexsort((rare[row], at))
    at = at[order]
    new = np.flatnonzero(np.append(True, np.diff(at) > 0)) if len(at) else np.empty(0, np.int64)
    shared = np.diff(np.append(new, len(at)))
    rank = np.arange(len(at)) - np.repeat(new, shared)
    out = np.zeros(len(v), bool)
    out[row[order[rank <= np.repeat(shared, shared) - MIN_HASHES]]] = True
    return out


def _rarest(least: int):
    """Rows that come by document, cut down to the windows that are needed."""
    def cut(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            fp = table.column("fp").to_numpy()
            whole = int(np.flatnonzero(fp != fp[-1])[-1]) + 1 if len(fp) and fp[0] != fp[-1] else 0
            held = table.slice(whole)
            if whole:
                yield of(table.slice(0, whole))
        if held is not None and held.num_rows:
            yield of(held)

    def of(table):
        v, fp, place, often = (table.column(c).to_numpy() for c in ("v", "fp", "place", "n"))
        some = needed(fp, v, place, often, least)
        return pa.RecordBatch.from_arrays(
            [pa.array(v[some]), pa.array(fp[some]), pa.array((place[some] >> 24).astype(np.int32))], ["v", "fp", "c"])
    return cut


def _small(df: DataFrame) -> DataFrame:
    """A broadcast of a frame of a few numbers a row, when it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame, repeats: bool) -> DataFrame:
    """(fp, text) of the first document of the classes in `wanted`.

    `repeats` says that rows may be equal in id and text; all but one of those are left out.
    """
    side = _small(materialize(classes.join(wanted, "fp", "left_semi").select("fp", "first", "first_hash"), "wanted"))
    same_row = F.col("doc_id").eqNullSafe(F.col("first")) & (F.xxhash64("text") == F.col("first_hash"))
    found = docs.join(side, same_row).select("fp", "text")
    return materialize(found.dropDuplicates(["fp"]) if repeats else found, "texts")


def _similarity(a: np.ndarray, b: np.ndarray) -> float:
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


class Grams:
    """The n-grams of a document in order, and what all of its pairs need of them, once it is asked for."""

    def __init__(self, grams: np.ndarray):
        self.grams = grams

    @functools.cached_property
    def by(self) -> np.ndarray:
        return np.argsort(self.grams, kind="stable")

    @functools.cached_property
    def values(self) -> np.ndarray:
        return self.grams[self.by]

    @functools.cached_property
    def new(self) -> np.ndarray:
        """How many places before each hold an n-gram for the first time."""
        return _ahead(~_repeats(self.grams))

    def places(self, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in `by` each of `others` would begin, and whether it is there."""
        lo = np.searchsorted(self.values, others)
        inside = lo < len(self.values)
        inside[inside] = self.values[lo[inside]] == others[inside]
        return lo, inside


def exact_runs(first: Grams, second: Grams, least: int) -> np.ndarray:
    """Maximal equal stretches (start in a, start in b, length) that cover what b shares with a, by start in b.

    Only stretches of b are looked at in which half of some `least` places are shared. N-grams that a holds once tell the
    diagonals of most stretches; a place that none of those covers takes its longest stretch, the first of equal ones.
    """
    a, b, by = first.grams, second.grams, first.by
    lo, shared = first.places(b)
    sums = _ahead(shared)
    good = np.flatnonzero(2 * (sums[least:] - sums[:-least]) >= least) if len(b) >= least else np.empty(0, np.int64)
    if not len(good):
        return np.empty((0, 3), np.int64)
    dense = np.zeros(len(b) + 1, np.int64)
    np.add.at(dense, good, 1)
    np.add.at(dense, good + least, -1)
    open_ = shared & (np.cumsum(dense)[:-1] > 0)
    hi = lo.copy()
    hi[open_] = np.searchsorted(first.values, b[open_], "right")
    out, todo = [], open_.copy()

    def along(diagonal: int, seeds: np.ndarray) -> None:
        """The stretches of one diagonal (place in a less place in b) that hold a seed."""
        first, last = max(0, -diagonal), min(len(b), len(a) - diagonal)
        equal = a[first + diagonal:last + diagonal] == b[first:last]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
        start, end = edge[0::2] + first, edge[1::2] + first
        for k in np.unique(np.searchsorted(start, seeds, "right") - 1).tolist():
            out.append((int(start[k]) + diagonal, int(start[k]), int(end[k] - start[k])))
            todo[start[k]:end[k]] = False

    single = np.flatnonzero(open_ & (hi - lo == 1))
    diagonals = by[lo[single]] - single
    order = np.argsort(diagonals, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(diagonals[order])) + 1) if len(order) else []:
        along(int(diagonals[part[0]]), single[part])
    at = 0
    while len(rest := np.flatnonzero(todo[at:])):
        at += int(rest[0])
        here = by[lo[at]:hi[at]]
        length, step = np.zeros(len(here), np.int64), 64
        going = np.arange(len(here))
        while len(going):  # how far each is equal, by ever longer pieces
            places = here[going] + length[going]
            spans = np.minimum(step, np.minimum(len(a) - places, len(b) - at - length[going]))
            offsets = np.arange(step)
            inside = offsets < spans[:, None]
            same = inside & (a[np.minimum(places[:, None] + offsets, len(a) - 1)]
                             == b[np.minimum(at + length[going][:, None] + offsets, len(b) - 1)])
            more = np.where(same.all(axis=1), step, same.argmin(axis=1))
            length[going] += more
            going, step = going[more == step], min(2 * step, 1 << 14)
        best = int(length.argmax())
        along(int(here[best]) - at, np.array([at]))
        todo[at] = False
    return np.array(sorted(set(out), key=lambda r: (r[1], r[0])), np.int64).reshape(-1, 3)


def chains(found: np.ndarray) -> list[np.ndarray]:
    """Stretches in order along both documents, each chain broken where the gap is longer than half of what it spans."""
    done, active = [], []
    for k, (i, j, n) in enumerate(found.tolist()):
        best, least = None, None
        for c in active:
            ahead, beside = j - c[2], i - c[1]
            limit = max(48, (c[2] - c[3]) // 2, n)
            if -SLIP <= ahead <= limit and -SLIP <= beside <= limit and j + n > c[2] and i + n > c[1]:
                cost = abs(ahead) + abs(beside)
                if best is None or cost < least:
                    best, least = c, cost
        if best is None:
            best = [[], 0, 0, j]
            active.append(best)
        best[0].append(k)
        best[1], best[2] = i + n, j + n
        if k % 64 == 63:
            reach = [max(48, c[2] - c[3], int(found[k:, 2].max())) for c in active]
            done += [c for c, r in zip(active, reach) if c[2] + r < j]
            active = [c for c, r in zip(active, reach) if c[2] + r >= j]
    return [found[c[0]] for c in done + active]


def _ahead(marks: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(marks)])


def _repeats(grams: np.ndarray) -> np.ndarray:
    """Which places hold an n-gram that an earlier place holds."""
    again = np.ones(len(grams), bool)
    again[np.unique(grams, return_index=True)[1]] = False
    return again


def aligned(first: Grams | np.ndarray, second: Grams | np.ndarray, least: int, percent: int) -> list[tuple]:
    """Passages (start and end in a, start and end in b, similarity) that begin and end with shared n-grams.

    Every part of a chain of equal stretches that has at least `least` n-grams in both documents is a candidate, the longest
    first; it counts if its sets of n-grams are similar enough and it covers a stretch that none before it does. What
    cannot be similar by the counts of shared and repeated places is not compared. Passages inside others of b are left out.
    """
    found, share = [], percent / 100
    first, second = (x if isinstance(x, Grams) else Grams(x) for x in (first, second))
    a, b = first.grams, second.grams
    runs = exact_runs(first, second, least)
    long = [c for c in (chains(runs) if len(runs) else ())
            if np.ptp(c[:, :2], axis=0).min() + c[:, 2].max() >= least]
    if not long:
        return found
    in_a, in_b = _ahead(second.places(a)[1]), _ahead(first.places(b)[1])
    new_a, new_b = first.new, second.new
    for chain in long:
        i, j, n = chain.T
        s, e = np.triu_indices(len(chain))
        bounds = np.stack([i[s], (i + n)[e], j[s], (j + n)[e]])
        fits = (bounds[1] - bounds[0] >= least) & (bounds[3] - bounds[2] >= least)
        s, e, (p, q, t, u) = s[fits], e[fits], bounds[:, fits]
        both = np.minimum(in_a[q] - in_a[p], in_b[u] - in_b[t])
        others = np.maximum(new_a[q] - new_a[p] + new_b[u] - new_b[t] - both, both)
        likely = (both >= (share - 1e-9) * others) | (s == e)
        s, e, p, q, t, u = (x[likely] for x in (s, e, p, q, t, u))
        order = np.lexsort((s, t - u))
        bare = np.ones(len(chain), bool)
        while len(order):
            k = order[0]
            passage = tuple(int(x[k]) for x in (p, q, t, u))
            similar = 1.0 if s[k] == e[k] else _similarity(a[passage[0]:passage[1]], b[passage[2]:passage[3]])
            order = order[1:]
            if similar >= share - 1e-9:
                found.append((*passage, similar))
                bare[s[k]:e[k] + 1] = False
                left = _ahead(bare)
                order = order[left[e[order] + 1] > left[s[order]]]
    found.sort(key=lambda f: (f[2], -f[3]))
    out, reach = [], 0
    for f in found:
        if f[3] > reach:
            out.append(f)
            reach = f[3]
    return out


def _verify(pairs: DataFrame, texts: DataFrame, size: int, least: int, percent: int) -> DataFrame:
    """(a, b, start and end words in both, similarity) of the near-duplicate passages of pairs of classes.

    The shorter text of a pair travels with it to the longer one.
    """
    names = ["a", "b", "a_start", "a_end", "b_start", "b_end", "similarity"]

    def check(batches):
        for whole in batches:
            for batch in _bounded(whole):
                ids = {c: batch.column(c).to_pylist() for c in ("a", "b", "x", "y")}
                place: dict[int, int] = {}
                for row, fp in enumerate(ids["x"] + ids["y"]):
                    place.setdefault(fp, row)
                both = pa.concat_arrays([batch.column("text_x"), batch.column("text_y")])
                grams, first = shingles(words(both.take(pa.array(list(place.values())))), size)
                own = {fp: Grams(grams[first[d]:first[d + 1]]) for d, fp in enumerate(place)}
                rows = [(x, y, p, q + size - 1, s, t + size - 1, similar) for x, y in zip(ids["a"], ids["b"])
                        for p, q, s, t, similar in aligned(own[x], own[y], least - size + 1, percent)]
                columns = list(zip(*rows)) or [()] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], pa.float64())], names)

    shorter = F.col("na") <= F.col("nb")
    sided = pairs.select("a", "b", F.when(shorter, F.col("a")).otherwise(F.col("b")).alias("x"),
                         F.when(shorter, F.col("b")).otherwise(F.col("a")).alias("y"))
    both = sided.join(texts.toDF("x", "text_x"), "x").join(texts.toDF("y", "text_y"), "y")
    schema = "a long, b long, a_start long, a_end long, b_start long, b_end long, similarity double"
    return materialize(both.select("a", "b", "x", "y", "text_x", "text_y").mapInArrow(check, schema), "verified")


def _bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The same pairs in batches whose different texts have at most SMALL_BLOCK, or of one pair."""
    columns = [(batch.column(c).to_pylist(), pc.binary_length(batch.column(f"text_{c}")).to_pylist()) for c in ("x", "y")]
    begin, seen, held = 0, set(), 0
    for row in range(batch.num_rows):
        new = sum(size[row] for fp, size in columns if fp[row] not in seen)
        if held + new > SMALL_BLOCK and row > begin:
            yield batch.slice(begin, row - begin)
            begin, seen, held = row, set(), 0
            new = sum(size[row] for _, size in columns)
        seen.update(fp[row] for fp, _ in columns)
        held += new
    if begin < batch.num_rows:
        yield batch.slice(begin)


def _pair(earlier: str, later: str) -> list:
    return [F.col(f"{earlier}.fp").alias("a"), F.col(f"{later}.fp").alias("b"), F.col(f"{earlier}.n").alias("na"),
            F.col(f"{later}.n").alias("nb")]


def _around(rows: DataFrame, texts: DataFrame, size: int, least: int, percent: int) -> DataFrame:
    """`rows` with the n-grams of all runs that hold a window, cut to 32 bits, and how many places of the best of these runs hold
    one that a similar run of another document has around its window."""
    lists = materialize(rows.groupBy("w").agg(F.collect_list(F.struct("v", "c", "known")).alias("open")), "lists")
    reach = least - size

    def cut(batches):
        release()
        for batch in blocks(batches, limit=SMALL_BLOCK):
            grams, first = shingles(words(batch.column("text")), size)
            short = (grams >> _U(32)).astype(np.uint32)
            open_ = batch.column("open")
            doc = np.repeat(np.arange(batch.num_rows), np.diff(open_.offsets.to_numpy()))
            each = open_.flatten()
            c = each.field("c").to_numpy()
            begin, end = np.maximum(first[doc], first[doc] + c - reach), np.minimum(first[doc + 1], first[doc] + c + reach + 1)
            held = [short[i:j] for i, j in zip(begin.tolist(), end.tolist())]
            again = np.array([len(x) - len(np.unique(x)) for x in held], np.int64)  # a run may hold so many fewer different ones
            needs = np.maximum(1, NEARBY * 2 * percent / (100 + percent) * (reach + 1 - again)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [each.field("v"), batch.column("w").take(pa.array(doc)), each.field("c"), each.field("known"),
                 pa.array(np.zeros(len(doc), np.int64)), pa.array(needs), pa.array([x.tobytes() for x in held], pa.binary())],
                ["v", "w", "c", "known", "tried", "needs", "around"])

    ready = lists.join(texts, F.col("w.fp") == F.col("fp")).select("w", "open", "text")
    w = rows.schema["w"].dataType.simpleString()
    return materialize(ready.mapInArrow(cut, f"v long, w {w}, c int, known boolean, tried long, needs int, around binary"), "around")


def shared_runs(around: list[np.ndarray], asked: np.ndarray, run: int, least: np.ndarray) -> Iterator[np.ndarray]:
    """For each of the rows of numbers at `asked`, which earlier rows hold at least `least` of the places of some `run` of it."""
    sizes = np.array([len(x) for x in around])
    ids = np.unique(np.concatenate(around), return_inverse=True)[1]
    often = np.bincount(ids)
    lists, begin = np.repeat(np.arange(len(around)), sizes)[np.argsort(ids, kind="stable")], np.cumsum(often) - often
    at, before, done = np.cumsum(sizes) - sizes, np.zeros(len(often), np.int64), 0
    for i in asked.tolist():
        before += np.bincount(ids[at[done]:at[i]], minlength=len(often))  # entries of rows before i, the first of each list
        own, done = ids[at[i]:at[i] + sizes[i]], i
        n = before[own]
        held = lists[np.repeat(begin[own] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        fits = np.flatnonzero(np.bincount(held, minlength=i) >= least[i])
        if len(fits):
            column = np.full(i, -1)
            column[fits] = np.arange(len(fits))
            column, place = column[held], np.repeat(np.arange(1, len(own) + 1), n)
            shared = np.zeros((len(own) + 1, len(fits)), np.int16)
            shared[place[column >= 0], column[column >= 0]] = 1
            sums, k = shared.cumsum(axis=0, dtype=np.int16), min(run, len(own))
            fits = fits[(sums[k:] - sums[:len(sums) - k]).max(axis=0) >= least[i]]
        yield fits


_MET = T.StructField("met", T.ArrayType(T.StructType([T.StructField("fp", T.LongType()), T.StructField("n", T.IntegerType())])))


def _meeting(quota: int, run: int):
    """Of one hash the earlier documents that each window meets next: `quota` more of those with enough in common around it."""
    def meet(table: pa.Table) -> pa.Table:
        w = table.column("w").combine_chunks()
        order = np.lexsort((w.field("fp").to_numpy(), pc.fill_null(w.field("first"), 0).to_numpy(),
                            w.field("nameless").to_numpy(zero_copy_only=False)))
        table = table.take(pa.array(order))
        w = table.column("w").combine_chunks()
        fp, n = w.field("fp").to_numpy(), w.field("n").to_numpy()
        needs, tried = table.column("needs").to_numpy(), table.column("tried").to_numpy().copy()
        waits = np.flatnonzero(~table.column("known").to_numpy() & (tried >= 0))
        around = [np.frombuffer(x, np.uint32) for x in table.column("around").to_pylist()]
        mets = [np.empty(0, np.int64)] * len(fp)
        for i, fits in zip(waits.tolist(), shared_runs(around, waits, run, needs)):
            fits = fits[fp[fits] != fp[i]]
            fits = fits[np.sort(np.unique(fp[fits], return_index=True)[1])]  # a document once
            mets[i] = fits[tried[i]:tried[i] + quota]
            tried[i] = -1 if tried[i] + quota >= len(fits) else tried[i] + quota
        flat = np.concatenate(mets)
        offsets = np.cumsum([0] + [len(x) for x in mets])
        met = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(fp[flat]), pa.array(n[flat])], ["fp", "n"]))
        at = table.schema.get_field_index("tried")
        return table.set_column(at, "tried", pa.array(tried)).append_column("met", met)
    return meet


def _marked(rows: DataFrame, spans: DataFrame, size: int) -> DataFrame:
    """`rows`, marked as known where the window's own n-gram lies in a found passage of its document."""
    known = spans.groupBy(F.col("b").alias("s_fp")).agg(F.collect_set(F.struct("b_start", "b_end")).alias("spans"))
    known = materialize(known, "known")
    weight = known.agg(F.coalesce(F.sum(F.size("spans") + 1), F.lit(0))).first()[0]
    side = F.broadcast(known) if weight <= BROADCAST_IDS else known
    inside = F.exists("spans", lambda s: (F.col("c") >= s["b_start"]) & (F.col("c") + F.lit(size) <= s["b_end"]))
    return rows.join(side, F.col("w.fp") == F.col("s_fp"), "left").withColumn(
        "known", F.col("known") | F.coalesce(inside, F.lit(False))).select(rows.columns)


def _waiting(rows: DataFrame, more: Column) -> DataFrame:
    """The windows of the hashes of which one is not known, has `more` to meet, and is not of the first document."""
    later = F.max(F.when(~F.col("known") & more, F.col("w")))
    todo = rows.groupBy("v").agg(F.min("w").alias("low"), later.alias("high")).where("low < high").select("v")
    return materialize(rows.join(_small(materialize(todo, "todo")), "v", "left_semi"), "open")


def repeated(docs: DataFrame, least: int = 50, size: int = SHINGLE, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row for every passage of a document that another document, of a smaller id, has too.

    doc_id, start_word and end_word (exclusive), first_doc_id, first_start and first_end, similarity, and text_hash,
    Spark's xxhash64 of the text, which tells documents of one id apart. A document with the same words as another has
    one row over all its words, against the first of its copies; other passages of copies are given for the first
    alone. Rows equal in id and text are one document. A null id comes after all others. Texts that are null or shorter
    than a passage have no rows, nor have passages that repeat within one document only. Other columns are dropped; an empty
    table has no rows.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    survey = _survey(narrow, size)
    head = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")).alias("head")
    classes = survey.where(F.col("n_words") >= least).groupBy("fp").agg(
        head, F.count("*").alias("copies"), F.max("n_words").cast("int").alias("n"))
    classes = materialize(classes.select("fp", "copies", "n", F.col("head.doc_id").alias("first"),
                                         F.col("head.text_hash").alias("first_hash")), "classes")
    windows = _windows(narrow, size, least)
    repeats = not survey.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty()
    rows = windows.join(_small(classes.select("fp", "first", "n")), "fp").select(
        "v", F.struct(F.col("first").isNull().alias("nameless"), "first", "fp", "n").alias("w"), "c",
        F.lit(False).alias("known"))
    rows = materialize(rows, "open")
    found, checked = [], None

    def verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
        """`rows`, marked as known by what is found in those of the pairs that have not met yet."""
        nonlocal checked
        if checked is not None:
            pairs = pairs.join(checked.select("a", "b"), ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        if pairs.isEmpty():
            return rows
        checked = pairs if checked is None else checked.unionByName(pairs)
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
        spans = _verify(pairs, _texts(narrow, classes, wanted, repeats), size, least, percent)
        found.append(spans)
        return _marked(rows, spans, size)

    if not rows.isEmpty():
        anchors = materialize(rows.groupBy("v").agg(F.min("w").alias("anchor")), "anchors")
        pairs = rows.join(anchors, "v").where("anchor < w").select(*_pair("anchor", "w")).distinct()
        rows = _waiting(verified(pairs, rows), F.lit(True))
    if not rows.isEmpty():
        rows = _around(rows, _texts(narrow, classes, rows.select("w.fp").distinct(), repeats), size, least, percent)
    quota = 1
    while not rows.isEmpty():  # some are found at once, and met in turns of ever more
        met = materialize(rows.groupBy("v").applyInArrow(
            _meeting(quota * (TURNS[-1] - 1), least - size + 1), T.StructType([*rows.schema.fields, _MET])), "met")
        for begin, end in zip(TURNS, TURNS[1:]):
            some = F.slice("met", (begin - 1) * quota + 1, (end - begin) * quota)
            pairs = met.where("not known").select("w", F.explode(some).alias("m")).select(*_pair("m", "w")).distinct()
            met = verified(pairs, met)
        rows = _waiting(met.drop("met"), F.col("tried") >= 0)
        quota *= TURNS[-1]
    return _listed(survey, classes, found, least)


def _listed(survey: DataFrame, classes: DataFrame, found: list[DataFrame], least: int) -> DataFrame:
    many = classes.where("copies > 1").select("fp", "first", "first_hash")
    members = survey.where(F.col("n_words") >= least).join(many, "fp")
    copies = members.where(~(F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("text_hash") == F.col("first_hash"))))
    zero = F.lit(0).cast("long")
    whole = copies.select(
        "doc_id", zero.alias("start_word"), F.col("n_words").alias("end_word"), F.col("first").alias("first_doc_id"),
        zero.alias("first_start"), F.col("n_words").alias("first_end"), F.lit(1.0).alias("similarity"),
        "text_hash").distinct()
    if not found:
        return whole
    spans = functools.reduce(DataFrame.unionByName, found).distinct()
    parts = (spans.join(classes.select(F.col("fp").alias("a"), F.col("first").alias("first_doc_id")), "a")
             .join(classes.select(F.col("fp").alias("b"), F.col("first").alias("doc_id"),
                                  F.col("first_hash").alias("text_hash")), "b"))
    return whole.unionByName(parts.select(
        "doc_id", F.col("b_start").alias("start_word"), F.col("b_end").alias("end_word"), "first_doc_id",
        F.col("a_start").alias("first_start"), F.col("a_end").alias("first_end"), "similarity", "text_hash"))


def without_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """`docs` with the words of all `spans` cut out of their texts, and n_chars, if there, counted anew.

    A document of which no word remains goes; all others stay, with all their columns in the same order. The white
    space in front of a passage stays, that behind it goes.
    """
    cuts = spans.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.array("start_word", "end_word")).alias("cuts"))
    cuts = materialize(cuts.withColumnRenamed("doc_id", "cut_id").withColumnRenamed("text_hash", "cut_hash"), "cuts")
    weight = cuts.agg(F.coalesce(F.sum(F.size("cuts") + 1), F.lit(0))).first()[0]
    side = F.broadcast(cuts) if weight <= BROADCAST_IDS else cuts
    at = docs.columns.index("text")
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    ready = plain.join(side, F.col(names[docs.columns.index("doc_id")]).eqNullSafe(F.col("cut_id"))
                       & (F.xxhash64(names[at]) == F.col("cut_hash")), "left").select(*names, "cuts")

    def cut(batches):
        for batch in blocks(batches, names[at], SMALL_BLOCK):
            todo = batch.column("cuts").to_pylist()
            if any(x is not None for x in todo):
                texts = batch.column(names[at])
                block, data = words(texts), joined(texts)
                new = texts.to_pylist()
                for d, spans_here in enumerate(todo):
                    if spans_here is None:
                        continue
                    first, last = block.first[d], block.first[d + 1]
                    raw = data.data[data.offsets[d]:data.offsets[d + 1] - 1]
                    keep, remains = np.ones(len(raw), bool), np.ones(last - first, bool)
                    starts = np.append(block.start[first:last], len(raw))
                    for s, t in spans_here:
                        keep[starts[s]:starts[t]] = False
                        remains[s:t] = False
                    new[d] = raw[keep].tobytes().decode() if remains.any() else None
                gone = pa.array([x is not None and y is None for x, y in zip(todo, new)])
                batch = batch.set_column(at, names[at], pa.array(new, pa.string())).filter(pc.invert(gone))
            yield batch.drop_columns(["cuts"])

    fields = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields))
    result = ready.mapInArrow(cut, fields).toDF(*docs.columns)
    return result.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else result
