"""Language-model scores of documents with a weighted backoff automaton over word n-grams.

The model interpolates n-gram counts with the next lower order. With p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)) for words,
p(w | h) = (c(h w) + s p(w | h')) / (c(h) + s), where h' is h without its first token. As an automaton: every history
seen in training is a state; every n-gram seen is an arc with the weight log10 p; and each state has a failure arc to
h' with the weight log10(s / (c(h) + s)). The traversal of a text goes left to right, carries the longest known history
as its state, and adds up the weights of the arcs it takes, failure arcs included; all texts of a chunk go in step. A state
depends on the last `order` - 1 tokens alone, so a long text is read in pieces at once: each piece first reads the
tokens before it that its state depends on, without counting them. The strength s is that of STRENGTHS under which the
training tokens are likeliest, each one left out of the counts when it is predicted.

The automaton grows with the corpus and is nowhere whole. Documents are dealt into chunks of a few megabytes. Every
chunk names its distinct n-grams with their training counts in the chunk; each bucket of n-gram hashes adds up the
counts of all chunks, and answers every chunk with the totals of just those n-grams that it named, in the order in
which it named them. So a chunk holds the part of the automaton that its documents can reach.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.text import blocks, mix, words
from tidewheel.session import materialize

CHUNK_BYTES = 12 << 20
BUCKET_BYTES = 16 << 20  # of text for each bucket of n-grams
PIECE = 512  # tokens of a text that are read in one go
STRENGTHS = (4.0, 64.0, 1024.0, 16384.0, 262144.0)

_U = np.uint64
_LEVEL = mix(np.arange(1, 33, dtype=_U) * _U(0xE7037ED1A0B428DB)) | _U(1)
_END, _START = mix(np.array([0x27BB2EE687B0B0FD, 0x9FB21C651E98DF25], _U))


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from; a null id counts as the text `null`."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % 10 == 0


class Stream:
    """The tokens of documents in a row, each document's words and then its end, and the hashes of their n-grams.

    `grams[k][i]` is the n-gram of k + 1 tokens that ends with token i, where the document has as many before it; with
    one start mark in front, for k = 1, it always has.
    """

    def __init__(self, texts: pa.ChunkedArray, order: int):
        parts, counts = [], [np.empty(0, np.int64)]
        for batch in blocks(iter(pa.table({"text": texts}).to_batches())):
            block = words(batch.column("text"))
            n = np.diff(block.first)
            ends = block.first[1:] + np.arange(len(n))
            tokens = np.full(len(block.hashes) + len(n), _END)
            is_word = np.ones(len(tokens), bool)
            is_word[ends] = False
            tokens[is_word] = block.hashes
            parts.append(tokens)
            counts.append(n + 1)
        self.counts = np.concatenate(counts)
        self.first = np.cumsum(self.counts) - self.counts
        self.tokens = np.concatenate(parts) if parts else np.empty(0, _U)
        self.place = np.arange(len(self.tokens)) - np.repeat(self.first, self.counts)
        self.start = mix(np.array([_START]) * _LEVEL[0])
        self.grams = [mix(self.tokens * _LEVEL[0])]
        for k in range(1, order):
            history = np.empty(len(self.tokens), _U)
            history[1:] = self.grams[k - 1][:-1]
            history[self.first] = self.start[0]
            self.grams.append(mix(history * _LEVEL[k] + self.tokens))

    def every(self) -> np.ndarray:
        return np.concatenate([*self.grams, np.repeat(self.start, len(self.counts))])


def _bucket(values: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending in the hash, so that sorted n-grams lie bucket by bucket."""
    return ((values >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def _thin(counts: np.ndarray) -> bytes:
    """Counts as a byte each; those from 255 on follow at the end in full."""
    many = counts >= 255
    return np.where(many, 255, counts).astype(np.uint8).tobytes() + counts[many].astype("<i8").tobytes()


def _wide(packed: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(packed, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(packed, "<i8", offset=n)
    return counts


def _close(values: np.ndarray) -> bytes:
    """Ascending hashes as the steps between them, six bytes each; what a step has beyond follows at the end."""
    steps = np.diff(values, prepend=_U(0))
    far = np.flatnonzero(steps >> _U(48))
    six = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return six.tobytes() + far.astype("<u4").tobytes() + (steps[far] >> _U(48)).astype("<u2").tobytes()


def _apart(packed: bytes, n: int) -> np.ndarray:
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :6] = np.frombuffer(packed, np.uint8, 6 * n).reshape(n, 6)
    steps = steps.view("<u8").ravel()
    k = (len(packed) - 6 * n) // 6
    far = np.frombuffer(packed, "<u4", k, 6 * n)
    steps[far] |= np.frombuffer(packed, "<u2", k, 6 * n + 4 * k).astype(_U) << _U(48)
    return np.cumsum(steps, dtype=_U)


def _statistics(docs: DataFrame) -> tuple[int, int, int]:
    """Bytes of all texts, and the tokens and distinct tokens of the training documents."""
    def look(batches):
        seen = np.empty(0, _U)
        size = tokens = 0
        for batch in blocks(batches):
            size += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
            learned = batch.filter(pc.invert(batch.column("held")))
            stream = Stream(pa.chunked_array([learned.column("text")]), 1)
            tokens += len(stream.tokens)
            seen = np.union1d(seen, stream.grams[0])
        edges = np.searchsorted(_bucket(seen, 256), np.arange(257))
        packed = [seen[a:b].tobytes() for a, b in zip(edges, edges[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(256), pa.int32()), pa.array(packed, pa.binary()), pa.array([size] + [0] * 255, pa.int64()),
             pa.array([tokens] + [0] * 255, pa.int64())], ["part", "grams", "bytes", "tokens"])

    def count(table: pa.Table) -> pa.Table:
        grams = np.concatenate([np.frombuffer(x, "<u8") for x in table.column("grams").to_pylist()])
        return pa.table({"bytes": [pc.sum(table.column("bytes")).as_py()],
                         "tokens": [pc.sum(table.column("tokens")).as_py()], "kinds": [len(np.unique(grams))]})

    parts = docs.mapInArrow(look, "part int, grams binary, bytes long, tokens long")
    total = parts.groupBy("part").applyInArrow(count, "bytes long, tokens long, kinds long")
    row = total.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in total.columns]).first()
    return row.bytes, row.tokens, row.kinds


def _name_grams(order: int, buckets: int):
    """A chunk's distinct n-grams by bucket, and how often each occurs in its training documents."""
    def name(table: pa.Table) -> pa.Table:
        stream = Stream(table.column("text"), order)
        learned = ~table.column("held").to_numpy()
        values, back = np.unique(stream.every(), return_inverse=True)
        weight = np.concatenate([np.tile(np.repeat(learned, stream.counts), order), learned])
        counts = np.bincount(back, weights=weight, minlength=len(values)).astype(np.int64)
        edges = np.searchsorted(_bucket(values, buckets), np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(edges))
        chunk = table.column("chunk")[0].as_py()
        return pa.table({
            "bucket": pa.array(full), "chunk": pa.array(np.full(len(full), chunk)),
            "size": pa.array(np.diff(edges)[full]),
            "grams": pa.array([_close(values[edges[b]:edges[b + 1]]) for b in full], pa.binary()),
            "counts": pa.array([_thin(counts[edges[b]:edges[b + 1]]) for b in full], pa.binary())})
    return name


def _answer(table: pa.Table) -> pa.Table:
    """The totals of a bucket's n-grams for every chunk that named them."""
    sizes = table.column("size").to_pylist()
    grams = [_apart(x, n) for x, n in zip(table.column("grams").to_pylist(), sizes)]
    counts = np.concatenate([_wide(x, n) for x, n in zip(table.column("counts").to_pylist(), sizes)])
    values, back = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.bincount(back, weights=counts, minlength=len(values)).astype(np.int64)
    edges = np.cumsum([0, *map(len, grams)])
    packed = [_thin(total[back[a:b]]) for a, b in zip(edges, edges[1:])]
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "size": table.column("size"),
                     "totals": pa.array(packed, pa.binary())})


class Automaton:
    """The part of the backoff automaton that a chunk's documents can reach.

    Every n-gram of the chunk has a number, in the order of the hashes. `weight[a]` is the log10 probability of arc a under
    each strength and `after[a]` the state it leads to; `shorter[h]` is where the failure arc of state h leads, with the weight
    that its count `seen[h]` gives.
    A state is the number of its history; ROOT, the last, has an arc for every token.
    """

    def __init__(self, stream: Stream, values: np.ndarray, back: np.ndarray, totals: np.ndarray, order: int, norm: float):
        n = len(stream.tokens)
        root = len(values)
        self.root, self.order, self.hashes, self.start = root, order, values, int(back[order * n]) if n else root
        self.level = np.full(root + 1, -1)  # tokens of a history, less one; the root has none
        held = totals > 0
        strengths = np.array(STRENGTHS)
        p = np.zeros((root, len(STRENGTHS)))
        self.after, self.shorter = np.full(root, root), np.full(root + 1, root)
        self.arc = np.zeros(root, bool)
        for k in range(order):
            at = np.flatnonzero(stream.place >= k - 1) if k > 1 else np.arange(n)
            number, place = np.unique(back[k * n + at], return_index=True)
            place = at[place]  # one occurrence of each n-gram of k + 1 tokens
            self.level[number] = k
            if k == 0:
                p[number] = ((totals[number] + 0.1) / norm)[:, None]
                self.arc[number] = True
            else:
                before = np.maximum(place - 1, 0) + (k - 1) * n
                history = np.where(stream.place[place] > 0, back[before], self.start)
                lower = back[(k - 1) * n + place]
                p[number] = (totals[number, None] + strengths * p[lower]) / (totals[history, None] + strengths)
                self.arc[number] = held[number]
                self.shorter[number] = np.where(held[lower], lower, root)
            longest = number if k < order - 1 else self.shorter[number] if k else np.full(len(number), root)
            self.after[number] = np.where(held[number], longest, root)
        if n and order > 1:
            self.level[self.start] = 0
        with np.errstate(divide="ignore"):
            self.weight = np.log10(p, out=p)
        self.seen, self.strengths = totals, strengths

    def read(self, state: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The weights that each state takes for its token, failure arcs included, and the state after it."""
        gained = np.zeros((len(state), len(STRENGTHS)))
        state, todo = state.copy(), np.arange(len(state))
        while len(todo):
            now, token = state[todo], tokens[todo]
            level = self.level[now] + 1
            history = np.where(now == self.root, _U(0), self.hashes[np.minimum(now, self.root - 1)])
            plain = np.where(now == self.root, token * _LEVEL[0], history * _LEVEL[level] + token)
            key = mix(plain)
            arc = np.minimum(np.searchsorted(self.hashes, key), self.root - 1)
            found = (self.hashes[arc] == key) & self.arc[arc]
            gained[todo[found]] += self.weight[arc[found]]
            state[todo[found]] = self.after[arc[found]]
            lost = now[~found]  # failure arcs; the root has none, as all its tokens are found
            gained[todo[~found]] += np.log10(self.strengths / (self.seen[lost][:, None] + self.strengths))
            state[todo[~found]] = self.shorter[lost]
            todo = todo[~found]
        return gained, state

    def scores(self, stream: Stream) -> np.ndarray:
        """The log10 probability of every document under each strength."""
        pieces = -(-stream.counts // PIECE)
        of = np.repeat(np.arange(len(stream.counts)), pieces)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = stream.first[of] + nth * PIECE
        end = np.minimum(begin + PIECE, stream.first[of] + stream.counts[of])
        warm = np.where(nth > 0, np.minimum(self.order - 1, nth * PIECE), 0)
        at = begin - warm
        state = np.where((nth > 0) & (warm < nth * PIECE), self.root, self.start if self.order > 1 else self.root)
        total = np.zeros((len(of), len(STRENGTHS)))
        by = np.argsort(at - end, kind="stable")  # longest first
        for step in range(int((end - at).max(initial=0))):
            here = by[:np.searchsorted((at - end)[by], -step, "left")]
            gained, state[here] = self.read(state[here], stream.tokens[at[here] + step])
            counts = step >= warm[here]
            total[here[counts]] += gained[counts]
        out = np.zeros((len(stream.counts), len(STRENGTHS)))
        np.add.at(out, of, total)
        return out


def _traverse(order: int, tokens_learned: int, kinds: int):
    """Score a chunk's documents with its part of the automaton."""
    norm = tokens_learned + 0.1 * (kinds + 1)

    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        stream = Stream(texts.column("text"), order)
        values, back = np.unique(stream.every(), return_inverse=True)
        packed, sizes = answers.column("totals").to_pylist(), answers.column("size").to_pylist()
        by = np.argsort(answers.column("bucket").to_numpy())
        totals = np.concatenate([_wide(packed[i], sizes[i]) for i in by.tolist()])
        if len(totals) != len(values):
            raise RuntimeError("the documents changed between two readings")
        scores = Automaton(stream, values, back, totals, order, norm).scores(stream)
        left_out = left_out_of(stream, totals[back], ~texts.column("held").to_numpy(), order, norm)
        unigrams = totals[back][:len(stream.tokens)]
        base = np.add.reduceat(np.log10((unigrams + 0.1) / norm), stream.first)
        known = np.add.reduceat((unigrams > 0).astype(np.int64), stream.first)
        listed = pa.list_(pa.float64())
        return pa.table({
            "doc_id": texts.column("doc_id"), "held_out": texts.column("held"), "n_tokens": pa.array(stream.counts),
            "n_known": pa.array(known), "base_score": pa.array(base),
            "scores": pa.array(list(scores), listed), "left_out": pa.array(list(left_out), listed)})
    return score


def left_out_of(stream: Stream, count: np.ndarray, learned: np.ndarray, order: int, norm: float, less: int = 1) -> np.ndarray:
    """Per document and strength the log10 probability of training tokens, each left out of the counts once."""
    n = len(stream.tokens)
    levels = [count[k * n:(k + 1) * n] for k in range(order)]
    own = np.repeat(learned, stream.counts)
    out = np.zeros((len(learned), len(STRENGTHS)))
    for i, strength in enumerate(STRENGTHS):
        p = (levels[0][own] - less + 0.1) / norm
        for k in range(1, order):
            history = np.empty(n, np.int64)
            history[1:] = levels[k - 1][:-1]
            history[stream.first] = count[order * n:]
            long = (levels[k][own] - less + strength * p) / (history[own] - less + strength)
            p = long if k == 1 else np.where(stream.place[own] >= k - 1, long, p)
        each = np.zeros(n)
        each[own] = np.log10(p)
        out[:, i] = np.add.reduceat(each, stream.first)
    return out


def score(docs: DataFrame, order: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Tokens are the words of the whole text and one end; a null text is empty, that is the end alone. `base_score` is
    the word model's, `score` the automaton's log10 probability, both to 6 decimals. Repeated rows are learned from and
    scored as often as they occur. With no training document all counts are 0. Other columns are dropped; an empty table has
    no rows.
    """
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        held_out(F.col(id_col)).alias("held"))
    size, tokens, kinds = _statistics(narrow)
    chunks, buckets = -(-size // CHUNK_BYTES) or 1, -(-size // BUCKET_BYTES) or 1
    dealt = narrow.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    named = dealt.groupBy("chunk").applyInArrow(
        _name_grams(order, buckets), "bucket long, chunk long, size long, grams binary, counts binary")
    answers = named.groupBy("bucket").applyInArrow(_answer, "chunk long, bucket long, size long, totals binary")
    scored = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _traverse(order, tokens, kinds), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
        "scores array<double>, left_out array<double>")
    scored = materialize(scored, "scored")
    fits = scored.agg(*[F.coalesce(F.sum(F.col("left_out")[i]), F.lit(0.0)) for i in range(len(STRENGTHS))]).first()
    best = max(range(len(STRENGTHS)), key=lambda i: fits[i])
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
                         F.round("base_score", 6).alias("base_score"),
                         F.round(F.col("scores")[best], 6).alias("score"))
