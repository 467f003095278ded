"""Gradient-boosted trees with Poisson or quantile loss, grown best-first from binned features.

Rows are written once as one byte per feature; rows alike in all bins and the target are one row with their number. A pass
adds up gradients, hessians and counts by (candidate, node, feature, bin): every task sums its own rows, the sums of a node
meet by exchange, and one row per node comes back with its best split. All candidates of a sweep grow in the same passes,
the candidate being part of the key. Features of few bins are summed together by their joint bins, and a feature whose bin
follows from another's, as the sine of an hour does, has its sums added up from that one's.

Best-first growth splits the leaf of the greatest gain until there are L leaves. A pass evaluates all nodes whose parents
are among the first L - 1 splits by the gains known so far; gains found later only push nodes back in that order, so
no split of the final tree is missed, and what has fallen out is not followed. A tree takes about as many passes as it is deep, not as
many as it has splits.

Up to HELD distinct rows one task per candidate keeps the rows in memory and grows all of its trees; a pass over them is then a
few additions instead of a Spark job. Both ways find the same splits.

A model is one flat table of nodes; it scores in one expression, however many trees it has.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewheel.contract import TARGET
from tidewheel.functions.encoding import clipped
from tidewheel.operators.quantiles import ordered_bits, select_rank, unordered_bits
from tidewheel.session import materialize, remove_folder, spread

# A missing value sits below every real one: one split sets it apart.
_MISSING = -1e300
_SEASONS = ["winter", "spring", "summer", "fall"]
MAX_BINS = 255
CHUNK = 1 << 16  # rows that a task works on at a time
NODES = 16  # nodes whose best split one task finds
JOINT = 1024  # joint bins of features that are summed together
HELD = 1 << 20  # distinct rows that one task holds, at some 250 bytes each


@dataclass(frozen=True)
class BoostParams:
    """`max_features` is the share of features tried per split; `depth` may bound trees besides their leaves."""

    loss: str = "poisson"
    quantile: float = 0.5
    learning_rate: float = 0.1
    rounds: int = 100
    max_leaf_nodes: int = 31
    depth: int | None = None
    min_samples_leaf: int = 20
    l2: float = 0.0
    max_features: float = 1.0
    seed: int = 0

    def __post_init__(self):
        if self.loss not in ("poisson", "quantile"):
            raise ValueError(f"unknown loss {self.loss}")
        if self.max_leaf_nodes < 2 or self.rounds < 1 or not 0 < self.quantile < 1 or not 0 < self.max_features <= 1:
            raise ValueError(f"parameters out of range: {self}")


@dataclass
class Tree:
    """Nodes as parallel arrays, the root first; a leaf is its own child."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node at which each row of bins ends."""
        at = np.zeros(len(bins), np.int64)
        for node, rows in self.reach(np.ascontiguousarray(bins.T), np.arange(len(bins))):
            at[rows] = node
        return at

    def reach(self, columns: np.ndarray, rows: np.ndarray, towards: set[int] | None = None) -> Iterator[tuple]:
        """(leaf, those of the rows that end there) for the leaves in `towards`, or all; bins lie feature by feature."""
        wanted = None
        if towards is not None:
            wanted = np.zeros(len(self.left), bool)
            wanted[list(towards)] = True
            for i in reversed(range(len(self.left))):  # children come after their parent
                wanted[i] |= wanted[self.left[i]] | wanted[self.right[i]]
        feature, bin_, left, right = (a.tolist() for a in (self.feature, self.bin, self.left, self.right))
        open_ = [(0, rows)]
        while open_:
            node, rows = open_.pop()
            if not len(rows) or wanted is not None and not wanted[node]:
                continue
            if left[node] == node:
                yield node, rows
                continue
            low = columns[feature[node]].take(rows) <= bin_[node]
            open_ += [(left[node], rows[low]), (right[node], rows[~low])]


# --- Features --------------------------------------------------------------

def columns_of(features: list[str]) -> dict[str, Column]:
    """Numeric inputs: season one-hot, everything else as a number, missing or not a number below all."""
    out = {}
    for name in features:
        if name == "season":
            out.update({f"season_{s}": (F.col("season").eqNullSafe(s)).cast("double") for s in _SEASONS})
        else:
            out[name] = F.coalesce(F.nanvl(F.col(name).cast("double"), F.lit(_MISSING)), F.lit(_MISSING))
    return out


def inputs(features: list[str]) -> Column:
    return F.array(*columns_of(features).values())


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def find_edges(rows: DataFrame, names: list[str]) -> list[np.ndarray]:
    """Where the bins of each input of a column `inputs` end.

    An input with at most MAX_BINS values gets one for each, ending halfway to the next value; one with more gets bins of
    about equally many rows, by approximate percentiles.
    """
    def distinct(batches):
        seen = [np.empty(0)] * len(names)
        for batch in batches:
            values = _matrix(batch.column("inputs"))
            for f in range(len(names)):
                if len(seen[f]) <= MAX_BINS:
                    seen[f] = np.unique(np.append(seen[f], values[:, f]))[:MAX_BINS + 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(names)), [len(s) for s in seen])), pa.array(np.concatenate(seen))], ["f", "v"])

    values = rows.mapInArrow(distinct, "f long, v double").groupBy("f").agg(F.sort_array(F.collect_set("v")).alias("v"))
    found = {r["f"]: r["v"] for r in values.select("f", F.slice("v", 1, MAX_BINS + 1).alias("v")).collect()}
    wide = [f for f, v in found.items() if len(v) > MAX_BINS]
    if wide:
        shares = [(i + 0.5) / MAX_BINS for i in range(MAX_BINS)]
        cut = rows.agg(*[F.percentile_approx(F.col("inputs")[f], shares, 10_000).alias(f"f{f}") for f in wide]).first()
        found.update({f: sorted(set(cut[f"f{f}"])) for f in wide})
    points = [np.array(found.get(f, [0.0])) for f in range(len(names))]
    return [p[:-1] + (p[1:] - p[:-1]) / 2 for p in points]


def to_bins(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, values[:, f], "left") for f, e in enumerate(edges)], axis=1).astype(np.uint8)


def packed_bins(bins: np.ndarray) -> pa.Array:
    """Rows of bins as one binary value each."""
    offsets = np.arange(len(bins) + 1, dtype=np.int32) * bins.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(bins), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(bins))])


# --- Growing ---------------------------------------------------------------

@dataclass
class _Node:
    parent: int
    depth: int
    sums: tuple  # gradient, hessian, rows
    gain: float = 0.0
    split: tuple | None = None  # feature, bin
    children: tuple | None = None
    evaluated: bool = False


class _Growth:
    """One tree while it grows."""

    def __init__(self, params: BoostParams, number: int):
        self.params, self.number = params, number
        self.nodes = [_Node(-1, 0, (0.0, 0.0, np.inf))]

    def chosen(self) -> list[int]:
        """The nodes to split, best first, as far as gains are known."""
        heap, out = [(-self.nodes[0].gain, 0)], []
        while heap and len(out) < self.params.max_leaf_nodes - 1:
            _, i = heappop(heap)
            if self.nodes[i].split is not None:
                out.append(i)
                for child in self.nodes[i].children:
                    heappush(heap, (-self.nodes[child].gain, child))
        return out

    def todo(self) -> list[int]:
        """The nodes whose best split the next pass has to find."""
        p, ahead = self.params, set(self.chosen())
        return [i for i, n in enumerate(self.nodes) if not n.evaluated and (n.parent < 0 or n.parent in ahead)
                and n.sums[2] >= 2 * p.min_samples_leaf and (p.depth is None or n.depth < p.depth)]

    def learn(self, node: int, gain: float, split: tuple, left: tuple, right: tuple) -> None:
        """The best split of a node; a gain that is not positive says that it stays a leaf."""
        n = self.nodes[node]
        n.evaluated = True
        n.sums = tuple(a + b for a, b in zip(left, right))
        if gain > 0:
            n.gain, n.split = gain, split
            n.children = (len(self.nodes), len(self.nodes) + 1)
            self.nodes += [_Node(node, n.depth + 1, left), _Node(node, n.depth + 1, right)]

    def tree(self, only: set[int] | None = None) -> tuple[Tree, list[int]]:
        """The tree of the splits in `only`, or of all found, and which node each of its nodes is."""
        order = [0]
        for i in order:
            if self.nodes[i].split is not None and (only is None or i in only):
                order += self.nodes[i].children
        at = {node: i for i, node in enumerate(order)}
        splits = [self.nodes[i].split is not None and (only is None or i in only) for i in order]
        feature, bin_, left, right = (np.zeros(len(order), np.int64) for _ in range(4))
        for i, node in enumerate(order):
            n = self.nodes[node]
            if splits[i]:
                feature[i], bin_[i] = n.split
                left[i], right[i] = (at[c] for c in n.children)
            else:
                left[i] = right[i] = i
        return Tree(feature, bin_, left, right, np.zeros(len(order)), max(self.nodes[i].depth for i in order)), order

    def final(self) -> tuple[Tree, list[int]]:
        """The grown tree with the Newton steps of its nodes, which quantile trees replace, and which node each of its nodes is."""
        tree, order = self.tree(set(self.chosen()))
        if self.params.loss == "poisson":
            for i, node in enumerate(order):
                g, h, _ = self.nodes[node].sums
                tree.value[i] = -g / max(h + self.params.l2, 1e-12)
        return tree, order


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _bins(table: pa.Table, width: int) -> np.ndarray:
    column = table.column("bins").combine_chunks() if table.num_rows else None
    if column is None:
        return np.empty((0, width), np.uint8)
    column = column if isinstance(column, pa.Array) else column.chunk(0)
    first, last = column.offset, column.offset + len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[first:last + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].reshape(-1, width)


@dataclass
class _State:
    """What a pass needs to know: stored scores, and trees grown since they were stored, for every candidate."""

    params: list[BoostParams]
    width: int
    pending: list[list[Tree]] = field(default_factory=list)

    def chunks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(table, bins feature by feature, target, number of rows alike, stored scores) of some thousand rows at a time."""
        for table in _chunks(batches):
            stored = table.column("scores").combine_chunks()
            stored = _matrix(stored if isinstance(stored, pa.Array) else stored.chunk(0))
            yield (table, np.ascontiguousarray(_bins(table, self.width).T), table.column("y").to_numpy(),
                   table.column("n").to_numpy(), stored)

    def scores(self, columns: np.ndarray, stored: np.ndarray, c: int, rows: np.ndarray) -> np.ndarray:
        """Scores of some rows of a chunk."""
        if not self.pending[c]:
            return stored[rows, c]
        total = stored[:, c].copy()
        for tree in self.pending[c]:
            for leaf, own in tree.reach(columns, rows):
                total[own] += tree.value[leaf]
        return total[rows]


def _slopes(p: BoostParams, y: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the loss."""
    if p.loss == "poisson":
        level = np.exp(score)
        return level - y, level
    return np.where(y > score, -p.quantile, 1 - p.quantile), np.ones(len(y))


@dataclass
class _Layout:
    """How the sums by bin are kept: `groups` of features are summed by their joint bins, from which each of them gets its
    own; the bin of a feature in `follows` is a function of another's, (that feature, the bins by its bins)."""

    sizes: list[int]
    groups: list[list[int]]
    follows: dict[int, tuple[int, np.ndarray]]

    def kept(self) -> list[int]:
        return [f for group in self.groups for f in group]

    def joint(self, columns: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """Per group the joint bins of rows, and how many there are."""
        out = []
        for group in self.groups:
            code, size = np.zeros(columns.shape[1], np.int64), 1
            for f in group:
                code = code * self.sizes[f] + columns[f]
                size *= self.sizes[f]
            out.append((code, size))
        return out

    def single(self, g: int, sums: np.ndarray) -> np.ndarray:
        """Sums (.., joint bin) of a group by the bins of its features, one after another."""
        group = self.groups[g]
        cube = sums.reshape(*sums.shape[:-1], *[self.sizes[f] for f in group])
        first = sums.ndim - 1
        return np.concatenate([cube.sum(axis=tuple(first + j for j in range(len(group)) if j != i))
                               for i in range(len(group))], axis=-1)

    def whole(self, sums: np.ndarray) -> list[np.ndarray]:
        """From the sums (3, node, bin) of the kept features those of each feature; empty for one that is constant."""
        kept = self.kept()
        ends = np.cumsum([0] + [self.sizes[f] for f in kept])
        own = {f: sums[..., a:b] for f, a, b in zip(kept, ends, ends[1:])}
        for f, (other, bins) in self.follows.items():
            own[f] = own[other] @ (bins[:, None] == np.arange(self.sizes[f])).astype(np.float64)
        return [own.get(f, np.empty((*sums.shape[:-1], 0))) for f in range(len(self.sizes))]


def _layout(rows: DataFrame, sizes: list[int]) -> _Layout:
    """A layout for these rows. Which features follow from others is seen from the least and greatest bin of every feature
    by each bin of every other: one record per task, merged to one."""
    starts, width = np.concatenate([[0], np.cumsum(sizes)]), len(sizes)

    def spans(batches):
        low, high = np.full((starts[-1], width), 255, np.uint8), np.zeros((starts[-1], width), np.uint8)
        for table in _chunks(batches):
            bins = _bins(table, width)
            for f in range(width):
                if sizes[f] > 1:
                    by = bins[np.argsort(bins[:, f], kind="stable")]
                    at = np.flatnonzero(np.diff(by[:, f], prepend=by[0, f])).tolist()
                    at = [0, *at]
                    place = starts[f] + by[at, f]
                    low[place] = np.minimum(low[place], np.minimum.reduceat(by, at, axis=0))
                    high[place] = np.maximum(high[place], np.maximum.reduceat(by, at, axis=0))
        yield pa.RecordBatch.from_arrays([pa.array([low.tobytes()], pa.binary()), pa.array([high.tobytes()], pa.binary())],
                                         ["low", "high"])

    def merged(batches):
        low, high = np.full((starts[-1], width), 255, np.uint8), np.zeros((starts[-1], width), np.uint8)
        for batch in batches:
            for one, two in zip(batch.column("low").to_pylist(), batch.column("high").to_pylist()):
                low = np.minimum(low, np.frombuffer(one, np.uint8).reshape(-1, width))
                high = np.maximum(high, np.frombuffer(two, np.uint8).reshape(-1, width))
        yield pa.RecordBatch.from_arrays([pa.array([low.tobytes()], pa.binary()), pa.array([high.tobytes()], pa.binary())],
                                         ["low", "high"])

    schema = "low binary, high binary"
    found = rows.select("bins").mapInArrow(spans, schema).repartition(1).mapInArrow(merged, schema).first()
    low, high = (np.frombuffer(found[c], np.uint8).reshape(-1, width) for c in ("low", "high"))
    kept, follows = [], {}
    for f in sorted(range(width), key=lambda f: -sizes[f]):
        if sizes[f] > 1:
            for other in kept:
                own = slice(starts[other], starts[other + 1])
                if (low[own, f] >= high[own, f]).all():  # a bin that no row has is above
                    follows[f] = other, np.minimum(low[own, f], sizes[f] - 1).astype(np.int64)
                    break
            else:
                kept.append(f)
    groups: list[list[int]] = []
    for f in kept or [0]:
        for group in groups:
            if np.prod([sizes[i] for i in group]) * sizes[f] <= JOINT:
                group.append(f)
                break
        else:
            groups.append([f])
    return _Layout(list(sizes), groups, follows)


def _best_splits(sums: list[np.ndarray], p: BoostParams, number: int, nodes: list[int]) -> list[tuple]:
    """(gain, feature, bin, sums left, sums right) of each node from its (gradient, hessian, rows) by bin of each feature.

    The first of equal gains wins. Without a split that leaves enough rows on both sides, the gain is 0.
    """
    total = next(s for s in sums if s.shape[-1]).sum(axis=-1)

    def score(g, h):
        return g * g / np.maximum(h + p.l2, 1e-12)

    every, whole = np.arange(len(nodes)), score(*total[:2])[:, None]
    gain, feature, bin_, left = np.zeros(len(nodes)), np.zeros(len(nodes), int), np.zeros(len(nodes), int), total.copy()
    tried = np.ones((len(nodes), len(sums)), bool)
    if p.max_features < 1:
        kept = max(1, int(p.max_features * len(sums)))
        for i, node in enumerate(nodes):
            tried[i, np.random.default_rng((p.seed, number, node)).permutation(len(sums))[kept:]] = False
    for f, own in enumerate(sums):
        if own.shape[-1] < 2:
            continue
        low = np.cumsum(own, axis=-1)[..., :-1]
        high = total[..., None] - low
        fits = ((low[2] >= p.min_samples_leaf) & (high[2] >= p.min_samples_leaf) & (low[1] > 1e-3) & (high[1] > 1e-3)
                & tried[:, f, None])
        gains = np.where(fits, score(*low[:2]) + score(*high[:2]) - whole, -np.inf)
        at = gains.argmax(axis=1)
        top = gains[every, at]
        better = np.flatnonzero(top > gain + 1e-12 * np.abs(gain))
        gain[better], feature[better], bin_[better] = top[better], f, at[better]
        left[:, better] = low[:, better, at[better]]
    right = total - left
    return [(float(gain[i]), int(feature[i]), int(bin_[i]), left[:, i], right[:, i]) for i in range(len(nodes))]


def _evaluate(rows: DataFrame, state: _State, growing: dict[int, _Growth], layout: _Layout) -> None:
    """One pass: the best split of every node that waits for one."""
    sc = rows.sparkSession.sparkContext
    waiting = {c: g.todo() for c, g in growing.items()}
    waiting = {c: nodes for c, nodes in waiting.items() if nodes}
    ready = sc.broadcast((state, layout, {c: (*growing[c].tree(), nodes) for c, nodes in waiting.items()}))

    def add(batches):
        state, layout, todo = ready.value
        own = {c: {order.index(node): i for i, node in enumerate(nodes)} for c, (_, order, nodes) in todo.items()}
        widths = [int(np.prod([layout.sizes[f] for f in group])) for group in layout.groups]
        met = {c: [np.zeros((3, len(nodes) * w)) for w in widths] for c, (_, _, nodes) in todo.items()}
        for _, columns, y, n, stored in state.chunks(batches):
            joint = layout.joint(columns)
            for c, (tree, _, nodes) in todo.items():
                parts = [(own[c][leaf], rows) for leaf, rows in tree.reach(columns, np.arange(len(y)), set(own[c]))]
                if not parts:
                    continue
                some = np.concatenate([rows for _, rows in parts])
                node = np.repeat([i for i, _ in parts], [len(rows) for _, rows in parts])
                times = n[some].astype(np.float64)
                g, h = _slopes(state.params[c], y[some], state.scores(columns, stored, c, some))
                weights = (g * times, h * times, times)
                for total, (code, size) in zip(met[c], joint):
                    code = code[some] + node * size
                    for k, weight in enumerate(weights):
                        total[k] += np.bincount(code, weight, total.shape[1])
        sums = {c: np.concatenate([layout.single(g, total.reshape(3, len(nodes), -1)) for g, total in enumerate(met[c])], axis=2)
                for c, (_, _, nodes) in todo.items()}
        keys = [(c, n) for c, (_, _, nodes) in todo.items() for n in nodes]
        packed = [sums[c][:, i].tobytes() for c, (_, _, nodes) in todo.items() for i in range(len(nodes))]
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                                          pa.array(packed, pa.binary())], ["c", "node", "sums"])

    def split(batches):
        state, layout, _ = ready.value
        met: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for c, node, packed in zip(*(batch.column(n).to_pylist() for n in ("c", "node", "sums"))):
                new = np.frombuffer(packed).reshape(3, -1)
                met[c, node] = met[c, node] + new if (c, node) in met else new
        out = [(c, node, *_best_splits(layout.whole(sums[:, None]), state.params[c], numbers[c], [node])[0])
               for (c, node), sums in met.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32()))]
            + [pa.array([list(r[i]) for r in out], pa.list_(pa.float64())) for i in (5, 6)],
            ["c", "node", "gain", "feature", "bin", "left", "right"])

    numbers = {c: g.number for c, g in growing.items()}
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(n, -(-sum(map(len, waiting.values())) // NODES))
    added = rows.mapInArrow(add, "c int, node int, sums binary").repartition(n, "c", "node")
    found = added.mapInArrow(split, "c int, node int, gain double, feature int, bin int, left array<double>, "
                             "right array<double>").collect()
    for r in sorted(found, key=lambda r: (r["c"], r["node"])):
        growing[r["c"]].learn(r["node"], r["gain"], (r["feature"], r["bin"]), tuple(r["left"]), tuple(r["right"]))
    ready.destroy()


def _quantile_values(rows: DataFrame, state: _State, trees: dict[int, Tree]) -> None:
    """Sets each leaf to the quantile of its residuals, exactly, for all candidates at once."""
    ready = rows.sparkSession.sparkContext.broadcast((state, trees))

    def residuals(batches):
        state, trees = ready.value
        for _, columns, y, n, stored in state.chunks(batches):
            every = np.arange(len(y))
            for c, tree in trees.items():
                rest, leaf = ordered_bits(y - state.scores(columns, stored, c, every)), np.zeros(len(y), np.int64)
                for at, own in tree.reach(columns, every):
                    leaf[own] = at
                yield leaf * len(state.params) + c, rest, n

    levels = {int(leaf) * len(state.params) + c: state.params[c].quantile
              for c, tree in trees.items() for leaf in np.flatnonzero(tree.left == np.arange(len(tree.left)))}
    for key, bits in select_rank(rows, residuals, levels).items():
        leaf, c = divmod(key, len(state.params))
        trees[c].value[leaf] = unordered_bits(np.array([bits], np.uint64))[0]
    ready.destroy()


class _Held:
    """All rows of one candidate in memory, and its trees."""

    def __init__(self, p: BoostParams, layout: _Layout, bins: np.ndarray, y: np.ndarray, n: np.ndarray, start: float):
        self.p, self.layout, self.y, self.n = p, layout, y, n.astype(np.float64)
        self.columns = np.ascontiguousarray(bins.T)
        self.joint = layout.joint(self.columns)
        self.score = np.full(len(y), start)

    def trees(self) -> Iterator[Tree]:
        for number in range(self.p.rounds):
            yield self._next(number)

    def _next(self, number: int) -> Tree:
        growth, own = _Growth(self.p, number), {0: np.arange(len(self.y))}
        g, h = _slopes(self.p, self.y, self.score)
        weights = (g * self.n, h * self.n, self.n)
        while todo := growth.todo():
            for node in todo:
                if node not in own:
                    self._part(growth, own, growth.nodes[node].parent)
            self._pass(growth, own, todo, weights)
        tree, order = growth.final()
        for i in np.flatnonzero(tree.left == np.arange(len(order))).tolist():
            if order[i] not in own:
                self._part(growth, own, growth.nodes[order[i]].parent)
            rows = own[order[i]]
            if self.p.loss == "quantile":
                tree.value[i] = self._quantile(rows)
            self.score[rows] += tree.value[i] * self.p.learning_rate
        tree.value *= self.p.learning_rate
        return tree

    def _part(self, growth: _Growth, own: dict[int, np.ndarray], parent: int) -> None:
        rows, (f, b) = own[parent], growth.nodes[parent].split
        low = self.columns[f].take(rows) <= b
        for child, part in zip(growth.nodes[parent].children, (rows[low], rows[~low])):
            own[child] = part

    def _pass(self, growth: _Growth, own: dict[int, np.ndarray], todo: list[int], weights: tuple) -> None:
        """The best splits of the waiting nodes."""
        some = np.concatenate([own[node] for node in todo])
        place = np.repeat(np.arange(len(todo)), [len(own[node]) for node in todo])
        weights = [w.take(some) for w in weights]
        sums = []
        for i, (code, size) in enumerate(self.joint):
            at = code.take(some) + place * size
            total = np.stack([np.bincount(at, w, len(todo) * size) for w in weights])
            sums.append(self.layout.single(i, total.reshape(3, len(todo), size)))
        found = _best_splits(self.layout.whole(np.concatenate(sums, axis=-1)), self.p, growth.number, todo)
        for node, (gain, feature, bin_, left, right) in zip(todo, found):
            growth.learn(node, gain, (feature, bin_), tuple(left.tolist()), tuple(right.tolist()))

    def _quantile(self, rows: np.ndarray) -> float:
        """The least residual at or below which the quantile's share lies."""
        if not len(rows):
            return 0.0
        rest = self.y[rows] - self.score[rows] + 0.0
        order = np.argsort(rest, kind="stable")
        upto = np.cumsum(self.n[rows][order])
        wanted = max(np.ceil(self.p.quantile * upto[-1] - 1e-9), 1)
        return float(rest[order[np.searchsorted(upto, wanted)]])


_NODES = "c int, number int, feature binary, bin binary, left binary, right binary, value binary, depth int"


def _held_trees(rows: DataFrame, candidates: list[BoostParams], layout: _Layout, begin: list[float]) -> list[list[Tree]]:
    """All trees of every candidate, each candidate's by a task of its own."""
    ready = rows.sparkSession.sparkContext.broadcast((candidates, layout, begin))
    width, kinds = len(layout.sizes), (np.uint16, np.uint8, np.int32, np.int32, np.float64)

    def grow(batches):
        candidates, layout, begin = ready.value
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        del held
        for c in pc.unique(table.column("c")).to_pylist():
            own = table.filter(pc.equal(table.column("c"), c)).combine_chunks()
            bins, y, n = _bins(own, width), own.column("y").to_numpy(), own.column("n").to_numpy()
            order = np.lexsort((y, *bins.T[::-1]))  # sums do not depend on how the rows were dealt
            grown = _Held(candidates[c], layout, bins[order], y[order], n[order], begin[c])
            for number, tree in enumerate(grown.trees()):
                arrays = (tree.feature, tree.bin, tree.left, tree.right, tree.value)
                packed = [pa.array([a.astype(kind).tobytes()], pa.binary()) for a, kind in zip(arrays, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c], pa.int32()), pa.array([number], pa.int32()), *packed, pa.array([tree.depth], pa.int32())],
                    ["c", "number", "feature", "bin", "left", "right", "value", "depth"])

    each = rows.select("bins", "y", "n", F.explode(F.array(*map(F.lit, range(len(candidates))))).alias("c"))
    found = each.repartitionById(len(candidates), F.col("c")).mapInArrow(grow, _NODES)
    out: list[list[Tree]] = [[] for _ in candidates]
    for r in sorted(found.collect(), key=lambda r: (r["c"], r["number"])):
        arrays = [np.frombuffer(r[k], kind) for k, kind in zip(("feature", "bin", "left", "right", "value"), kinds)]
        out[r["c"]].append(Tree(*[a.astype(np.int64) for a in arrays[:4]], arrays[4].copy(), r["depth"]))
    ready.destroy()
    for c, trees in enumerate(out):
        if not trees:  # no rows at all
            nothing = np.empty((0, width), np.uint8), np.empty(0), np.empty(0)
            trees += _Held(candidates[c], layout, *nothing, begin[c]).trees()
    return out


def fit_many(train: DataFrame, features: list[str], candidates: list[BoostParams], checkpoint_every: int = 4,
             target: str = TARGET) -> list[BoostedTrees]:
    """One model per candidate, grown by a task each, or beyond HELD distinct rows all in the same passes over these.

    Passes store the scores every few rounds. The driver holds the trees; what it receives in a pass is one row per node.
    """
    names = list(columns_of(features))
    raw = materialize(train.select(inputs(features).alias("inputs"), F.col(target).cast("double").alias("y")), "boost")
    edges = find_edges(raw, names)
    first = {}
    for p in candidates:
        if p.loss == "poisson" and p.loss not in first:
            first[p.loss] = float(np.log(max(raw.agg(F.avg("y")).first()[0] or 0.0, 1e-9)))
        elif p.loss == "quantile" and p.quantile not in first:
            def plain(batches):
                for table in _chunks(batches):
                    y = table.column("y").to_numpy()
                    yield np.zeros(len(y), np.int64), ordered_bits(y)

            bits = select_rank(raw, plain, {0: p.quantile})
            first[p.quantile] = float(unordered_bits(np.array([bits[0]], np.uint64))[0]) if bits else 0.0
    begin = [first["poisson" if p.loss == "poisson" else p.quantile] for p in candidates]
    shared = raw.sparkSession.sparkContext.broadcast(edges)

    def encode(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [packed_bins(to_bins(_matrix(batch.column("inputs")), shared.value)), batch.column("y")], ["bins", "y"])

    alike = raw.mapInArrow(encode, "bins binary, y double").groupBy("bins", "y").agg(F.count("*").alias("n"))
    rows = materialize(spread(alike.withColumn("scores", F.array(*[F.lit(float(b)) for b in begin]))), "binned")
    layout = _layout(rows, [len(e) + 1 for e in edges])
    state = _State(candidates, len(names), [[] for _ in candidates])
    models = [BoostedTrees(p, list(features), edges, b, []) for p, b in zip(candidates, begin)]
    if rows.count() <= HELD:
        for model, trees in zip(models, _held_trees(rows, candidates, layout, begin)):
            model.trees = trees
        return models
    start = rows
    for number in range(max(p.rounds for p in candidates)):
        growing = {c: _Growth(p, number) for c, p in enumerate(candidates) if number < p.rounds}
        while any(g.todo() for g in growing.values()):
            _evaluate(rows, state, growing, layout)
        trees = {}
        for c, growth in growing.items():
            trees[c] = growth.final()[0]
        quantiles = {c: t for c, t in trees.items() if candidates[c].loss == "quantile"}
        if quantiles:
            _quantile_values(rows, state, quantiles)
        for c, tree in trees.items():
            tree.value *= candidates[c].learning_rate
            models[c].trees.append(tree)
            state.pending[c].append(tree)
        if (number + 1) % checkpoint_every == 0:
            before, rows = rows, _stored(rows, state)
            if before is not start:
                remove_folder(raw.sparkSession, before.inputFiles()[0].rsplit("/", 1)[0])
            state = _State(candidates, len(names), [[] for _ in candidates])
    return models


def _stored(rows: DataFrame, state: _State) -> DataFrame:
    ready = rows.sparkSession.sparkContext.broadcast(state)

    def add(batches):
        state = ready.value
        for table, columns, y, _, stored in state.chunks(batches):
            every = np.arange(len(y))
            scores = np.stack([state.scores(columns, stored, c, every) for c in range(len(state.params))], axis=1)
            offsets = pa.array(np.arange(len(y) + 1, dtype=np.int32) * scores.shape[1])
            yield from pa.table({"bins": table.column("bins"), "y": table.column("y"), "n": table.column("n"),
                                 "scores": pa.ListArray.from_arrays(offsets, pa.array(scores.ravel()))}).to_batches()

    return materialize(rows.mapInArrow(add, rows.schema), "binned")


# --- Models ----------------------------------------------------------------

@dataclass
class BoostedTrees:
    params: BoostParams
    features: list[str]
    edges: list[np.ndarray]
    start: float
    trees: list[Tree]

    def raw(self, values: np.ndarray, upto: int | None = None) -> np.ndarray:
        """Scores of rows of inputs on the scale on which trees add up."""
        columns, score = np.ascontiguousarray(to_bins(values, self.edges).T), np.full(len(values), self.start)
        every = np.arange(len(values))
        for tree in self.trees[:upto]:
            for leaf, rows in tree.reach(columns, every):
                score[rows] += tree.value[leaf]
        return score

    def to_level(self, score: np.ndarray) -> np.ndarray:
        """Predictions of scores, clipped at zero."""
        return np.maximum(np.exp(score) if self.params.loss == "poisson" else score, 0.0)

    def raw_scores(self, df: DataFrame, upto: int | None = None) -> DataFrame:
        """All columns of `df` and `score`, after the first `upto` trees."""
        return df.withColumn("score", self._expression(df, lambda model, values: model.raw(values, upto)))

    def predict(self, df: DataFrame) -> DataFrame:
        """All columns of `df` and `pred`, clipped at zero."""
        return df.withColumn("pred", clipped(self._expression(df, lambda model, values: model.to_level(model.raw(values)))))

    def _expression(self, df: DataFrame, scorer) -> Column:
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.arrow_udf("double")
        def score(rows: pa.Array) -> pa.Array:
            return pa.array(scorer(shared.value, _matrix(rows)) if len(rows) else np.empty(0))

        return score(inputs(self.features))

    def uses(self) -> list[set[int]]:
        """The inputs that each tree looks at."""
        return [set(t.feature[t.left != np.arange(len(t.left))].tolist()) for t in self.trees]


def save(model: BoostedTrees, spark: SparkSession, path: str) -> None:
    """One Parquet table of all nodes, and everything else as one JSON row beside it."""
    sizes = [len(t.feature) for t in model.trees]
    nodes = pa.table({
        "tree": np.repeat(np.arange(len(sizes)), sizes), "node": np.concatenate([np.arange(n) for n in sizes]),
        **{c: np.concatenate([getattr(t, c) for t in model.trees]) for c in ("feature", "bin", "left", "right", "value")}})
    spark.createDataFrame(nodes).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    state = {"params": asdict(model.params), "features": model.features, "start": model.start,
             "edges": [e.tolist() for e in model.edges], "depths": [t.depth for t in model.trees]}
    spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.mode("overwrite").text(f"{path}/state")


def load(spark: SparkSession, path: str) -> BoostedTrees:
    state = json.loads(spark.read.text(f"{path}/state").first()["value"])
    nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").toArrow()
    number = nodes.column("tree").to_numpy()
    trees = []
    for i, depth in enumerate(state["depths"]):
        own = nodes.filter(pc.equal(nodes.column("tree"), i)) if len(state["depths"]) < 2 else nodes.slice(
            int(np.searchsorted(number, i)), int((number == i).sum()))
        trees.append(Tree(*[own.column(c).to_numpy() for c in ("feature", "bin", "left", "right", "value")], depth))
    return BoostedTrees(BoostParams(**state["params"]), state["features"], [np.array(e) for e in state["edges"]],
                        state["start"], trees)
