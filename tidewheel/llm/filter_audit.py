"""What filters remove from a corpus in every order of application, with duplicates found by radix tries.

Four filters look at a text alone; the fifth asks whether a smaller id has the same text. For that, texts are
range-partitioned by prefixes: a bounded sample of text heads is cut at equal shares of bytes, each cut is the shortest
prefix that tells its neighbours apart, and heads under which more than a share lies are looked at eight times as deep.
Every partition inserts its full texts into a compressed trie whose terminals hold the smallest id, so equality is that
of whole texts, not of hashes.

Tasks insert their blocks of texts into small tries before the shuffle, where all but the smallest id of a text are
already decided: a text that a third of all documents share is shuffled once for each block. Documents leave as counts by
part, set of failed filters and label; the 120 orders are evaluated on those, at most 128 rows a part.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.text import blocks
from tidewheel.session import materialize

FILTERS = "ABCDE"
MIN_WORDS = 200
DUPLICATE = 1 << 4
TARGET_BYTES = 16 << 20  # text in a partition's trie
BLOCK_TRIE = 8 << 20  # text in a trie before the shuffle
HEAD = 256  # characters of the first sample
SAMPLE_CHARS = 4 << 20  # characters of heads that a sample takes to the driver, about
BROADCAST_IDS = 500_000  # labels of about 16 bytes each

_CAPITALS = bytes(range(65, 91))
_INNER = bytes(range(0x80, 0xC0))  # bytes inside a character
_MARKS = re.compile(rb"[#$%&*|]")


class Node:
    """A node of a compressed trie: the bytes of the edge to it, its children by first byte, and what ends here."""
    __slots__ = ("edge", "children", "value")

    def __init__(self, edge: bytes):
        self.edge, self.children, self.value = edge, {}, None


def shared_length(one: bytes, other: bytes, at: int) -> int:
    """How many bytes of `one` `other` repeats from `at` on, by halving."""
    low, high = 0, min(len(one), len(other) - at)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if other.startswith(one[low:middle], at + low) else (low, middle - 1)
    return low


class Trie:
    def __init__(self):
        self.root = Node(b"")

    def terminal(self, text: bytes) -> Node:
        """The node at which a text ends, put in where it is missing."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                return child
            if not text.startswith(child.edge, at):
                n = shared_length(child.edge, text, at)
                fork = node.children[text[at]] = Node(child.edge[:n])
                child.edge = child.edge[n:]
                fork.children[child.edge[0]] = child
                child = fork
            at += len(child.edge)
            node = child
        return node

    def terminals(self):
        """(text, value) of all texts, a prefix before what it begins, else in the order of insertion."""
        todo = [(self.root, b"")]
        while todo:
            node, path = todo.pop()
            if node.value is not None:
                yield path, node.value
            todo += [(child, path + child.edge) for child in node.children.values()]


def failed(text: bytes) -> int:
    """The filters that a text fails by itself, as bits in the order of FILTERS."""
    found = text.split()  # at the six white space characters, as bytes do
    characters = len(text.translate(None, _INNER))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return ((len(found) < MIN_WORDS) + 2 * (100 * len(set(found)) < 50 * len(found))
            + 4 * (100 * capitals > 3 * characters) + 8 * bool(_MARKS.search(text)))


class Copies:
    """The documents of one text: `low` the smallest id, `first` counts of those that have it by class, others are
    decided."""
    __slots__ = ("mask", "low", "first")

    def __init__(self, mask: int):
        self.mask, self.low, self.first = mask, None, Counter()

    def add(self, low: int, first: dict, decided: Counter) -> None:
        if self.low is not None and low > self.low:
            late = first
        elif low == self.low:
            self.first.update(first)
            return
        else:
            late, self.low, self.first = self.first, low, Counter(first)
        for (part, good, toxic), n in late.items():
            decided[part, self.mask | DUPLICATE, good, toxic] += n


_CLASS = pa.struct([("part", pa.string()), ("mask", pa.int32()), ("good", pa.bool_()), ("toxic", pa.bool_()),
                    ("n", pa.int64())])
_CLASS_DDL = "struct<part: string, mask: int, good: boolean, toxic: boolean, n: bigint>"


def _listed(counts: dict) -> list[dict]:
    return [{"part": p, "mask": m, "good": g, "toxic": t, "n": n} for (p, m, g, t), n in counts.items()]


def _combined(cuts):
    """Blocks of documents into one row per distinct text: its place, smallest id and the documents that have it."""
    def rows(trie: Trie, decided: Counter):
        found = list(trie.terminals())
        columns = [
            pa.array([bisect_right(cuts.value, text) for text, _ in found] or [0], pa.int32()),
            pa.array([text for text, _ in found] or [None], pa.binary()),
            pa.array([c.low for _, c in found] or [None], pa.int64()),
            pa.array([_listed({(p, c.mask, g, t): n for (p, g, t), n in c.first.items()}) for _, c in found] or [[]],
                     pa.list_(_CLASS)),
            pa.array([_listed(decided)] + [None] * (len(found) - 1), pa.list_(_CLASS))]
        return pa.RecordBatch.from_arrays(columns, ["place", "text", "low", "first", "decided"])

    def combine(batches):
        trie, decided, held = Trie(), Counter(), 0
        for batch in blocks(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for text, i, *kind in zip(texts, *(batch.column(c).to_pylist() for c in ("doc_id", "part", "good", "toxic"))):
                node = trie.terminal(text)
                if node.value is None:
                    node.value = Copies(failed(text))
                    held += len(text) + 200
                if i is None:
                    decided[kind[0], node.value.mask, *kind[1:]] += 1
                else:
                    node.value.add(i, {tuple(kind): 1}, decided)
            if held > BLOCK_TRIE:
                yield rows(trie, decided)
                trie, decided, held = Trie(), Counter(), 0
        yield rows(trie, decided)
    return combine


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition's texts in one trie; counts of its documents by class."""
    trie, decided = Trie(), Counter()
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("text", "low", "first", "decided"))
        for text, low, first, known in zip(*columns):
            for c in known or ():
                decided[c["part"], c["mask"], c["good"], c["toxic"]] += c["n"]
            if low is not None:
                node = trie.terminal(text)
                if node.value is None:
                    node.value = Copies(first[0]["mask"])
                node.value.add(low, {(c["part"], c["good"], c["toxic"]): c["n"] for c in first}, decided)
    for _, copies in trie.terminals():
        for (part, good, toxic), n in copies.first.items():
            decided[part, copies.mask, good, toxic] += n
    yield pa.RecordBatch.from_struct_array(pa.array(_listed(decided), _CLASS))


def cut_points(sample: list[tuple[bytes, int]], share: float) -> list[bytes]:
    """Prefixes that cut sorted (head, bytes) into parts of about `share` bytes; equal heads stay together."""
    cuts, held, last = [], 0, None
    for head, size in sample:
        if last is not None and head != last and held >= share:
            n = shared_length(last, head, 0)
            cuts.append(head[:n + 1])
            held = 0
        held += size
        last = head
    return cuts


def _cuts(docs: DataFrame) -> list[bytes]:
    """Cut points of all texts, from samples of heads that go deeper where one head holds more than a share."""
    rows, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    share, wanted, depth, done = TARGET_BYTES / 2, docs, HEAD, []
    if size <= TARGET_BYTES:
        return []
    while True:
        every = max(1, rows * depth // SAMPLE_CHARS)
        kept = wanted.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).select("text").distinct().select(
            F.left("text", F.lit(depth)).alias("head"), F.octet_length("text").alias("size"),
            (F.length("text") <= depth).alias("whole"))
        found = [(r["head"], r["size"] * every, r["whole"]) for r in kept.collect()]
        weight = Counter()
        for head, n, whole in found:
            if not whole:
                weight[head] += n
        heavy = [head for head, n in weight.items() if n > 2 * share]
        deep = set(heavy)
        done += [(head.encode(), n) for head, n, whole in found if whole or head not in deep]
        if not heavy:
            return cut_points(sorted(done), share)
        wanted = wanted.where(F.left("text", F.lit(depth)).isin(heavy))
        rows, depth = wanted.count(), depth * 8


def counts(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           part_col: str = "lang") -> DataFrame:
    """(part, mask, good, toxic, n): documents by part, failed filters (bits in the order of FILTERS) and labels."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                            F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    marks = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    marks = materialize(marks, "marks")
    small = marks.count() <= BROADCAST_IDS
    known = docs.join(F.broadcast(marks) if small else marks, "doc_id", "left").select(
        "doc_id", "text", "part", F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"))
    cuts = documents.sparkSession.sparkContext.broadcast(_cuts(docs.select("text")))
    open_texts = known.mapInArrow(_combined(cuts), "place int, text binary, low long, "
                                  f"first array<{_CLASS_DDL}>, decided array<{_CLASS_DDL}>")
    settled = open_texts.groupBy("place").applyInArrow(
        _settled, "part string, mask int, good boolean, toxic boolean, n long")
    return materialize(settled.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")), "counts")


def audit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "lang") -> DataFrame:
    """One row per part, order of the five filters and step: what the step's filter keeps, removes and costs.

    part, filter_order, step, and the documents kept after it, removed by it, redundant (removed earlier, though it would
    fail here too), unique_fails (fail this filter alone), good_lost and toxic_lost (removed here, by label), and
    shapley, the filter's removals summed over all orders. Null texts are empty, a null part is the empty one. Equal
    rows that share the smallest id of a text are all first. A null id has no smaller one and is nobody's smaller one.
    A document is good or toxic if any of its labels says so. Other columns are dropped; no documents give no rows.
    """
    steps = [("".join(order), i + 1, 1 << FILTERS.index(name), sum(1 << FILTERS.index(x) for x in order[:i]))
             for order in permutations(FILTERS) for i, name in enumerate(order)]
    names = ["filter_order", "step", "own", "earlier"]
    listed = F.arrays_zip(*[F.lit(list(column)).alias(n) for n, column in zip(names, zip(*steps))])
    each = counts(documents, labels, id_col, text_col, part_col).withColumn("s", F.explode(listed)).select(
        "part", "mask", "good", "toxic", "n", *[F.col("s")[n].alias(n) for n in names])
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    gone = F.col("mask").bitwiseAND(F.col("earlier")) != 0
    removed = fails & ~gone

    def total(condition, value=F.col("n")):
        return F.sum(F.when(condition, value).otherwise(F.lit(0).cast("long")))

    share = (F.col("n") * (F.lit(120) / F.greatest(F.bit_count("mask"), F.lit(1))).cast("long"))
    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(removed).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"), total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"), total(fails, share).alias("shapley"))
