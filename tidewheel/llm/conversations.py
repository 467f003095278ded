"""Conversation structure repair by a grammar-compressed min-plus DP.

A row is reduced to a symbol of its role's initial and its fault. Rows are put in order by a range partitioning over
conversation and turn, so that a conversation of any length is spread over tasks, and cut into segments of at most
SEGMENT symbols. Re-Pair over the distinct segments replaces frequent neighbours by rules; the counts of pairs are a
Spark aggregate, of which a bounded head reaches the driver in each round. Every terminal and every rule has one
transfer matrix over the four states of the role grammar: the least cost from state to state and the audit that goes
with it, as a rope of the audits of its two parts. Matrices are evaluated bottom-up and shared by all segments; a
segment's matrix is the product along its compressed symbols. Products are associative, so a long conversation is the
product of its segments' matrices: costs run back from its end, states run forward from its start.

Of one cost the ASCII-least audit wins. Two audits of one cost for the same rows from the same state are never
prefixes of each other, because every audit ends with a row's edit and an insertion more costs more; so the least
audit of a product is the product of least audits.

The digest of a conversation is one chain over its whole text. That is the only step in which the rows of a
conversation pass one task, as a stream in order, of which no more than a batch is held.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.session import materialize

SEGMENT = 4096  # rows of a segment at most
ROUNDS = 8  # rounds of Re-Pair
RULES_A_ROUND = 64
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "ABCDEFGHIJKLMNOP"  # four initials (s, u, a, other) by four faults (none, truncated, blank, duplicate)
TERMINALS = 9  # four initials, sound or truncated, and a row that must go
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
TAIL = (0, 2, 1, 0)  # insertions that end a conversation in each state
_APART = 0xFFFF


def after_turn(state: int) -> int:
    """The state after the only role, user or assistant, that may follow."""
    return ASSISTANT if state == USER else USER


def after_keep(state: int, initial: str) -> int | None:
    """The state after a kept row, or None where its role may not follow."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


# --- Ropes and matrices ----------------------------------------------------

def leaves(rope) -> Iterator[str]:
    """The strings of a rope from left to right; a rope is a string or a pair of ropes."""
    todo = [rope]
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            yield part
        else:
            todo += (part[1], part[0])


def flat(rope) -> str:
    return "".join(leaves(rope))


def before(one, other) -> bool:
    """Whether rope `one` is less than `other`; neither is a prefix of the other unless they are equal."""
    a, b, left, right = leaves(one), leaves(other), "", ""
    while True:
        left, right = left or next(a, ""), right or next(b, "")
        n = min(len(left), len(right))
        if not n or left[:n] != right[:n]:
            return left[:n] < right[:n] if n else len(left) < len(right)
        left, right = left[n:], right[n:]


def better(one, other) -> bool:
    """Of two entries (cost, rope), whether the first is to be taken."""
    return other is None or one[0] < other[0] or (one[0] == other[0] and before(one[1], other[1]))


def product(a: list, b: list) -> list:
    """The matrix of a stretch of rows followed by another; an entry is (cost, rope) or None."""
    out = [[None] * 4 for _ in range(4)]
    for i in range(4):
        for k in range(4):
            if a[i][k] is not None:
                for j in range(4):
                    if b[k][j] is not None:
                        entry = (a[i][k][0] + b[k][j][0], (a[i][k][1], b[k][j][1]))
                        if better(entry, out[i][j]):
                            out[i][j] = entry
    return out


def terminal(number: int) -> list:
    """The matrix of one row: up to two insertions in front of it, then its own edit."""
    out = [[None] * 4 for _ in range(4)]
    initial, extra = "sua-"[min(number // 2, 3)], TRUNCATED * (number % 2)
    for i in range(4):
        state = i
        for n in range(3):
            edits = [(DELETE, "D", state)]
            if number < TERMINALS - 1:
                edits.append((REROLE + extra, "R", after_turn(state)))
                if (kept := after_keep(state, initial)) is not None:
                    edits.append((KEEP + extra, "K", kept))
            for cost, letter, j in edits:
                entry = (cost + n * INSERT, "I" * n + letter)
                if better(entry, out[i][j]):
                    out[i][j] = entry
            state = after_turn(state)
    return out


def matrices(rules: list[tuple[int, int]]) -> list:
    """One matrix for each terminal and each rule, bottom-up."""
    out = [terminal(n) for n in range(TERMINALS)]
    for left, right in rules:
        out.append(product(out[left], out[right]))
    return out


def along(symbols: list[int], table: list) -> list:
    """The product over a row of symbols, in halves so that ropes stay shallow."""
    level = [table[s] for s in symbols]
    while len(level) > 1:
        level = [product(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


# --- Re-Pair ---------------------------------------------------------------

_TERMINAL = np.full(256, _APART, np.uint16)
for _n, _letter in enumerate(SYMBOLS):
    _TERMINAL[ord(_letter)] = TERMINALS - 1 if _n % 4 >= 2 else _n // 4 * 2 + _n % 4


def encoded(segments: list[str], rules: list[tuple[int, int]]) -> np.ndarray:
    """The symbols of all segments under the rules so far, each segment ended by a mark."""
    row = _TERMINAL[np.frombuffer("\n".join([*segments, ""]).encode(), np.uint8)]
    for n, (left, right) in enumerate(rules, TERMINALS):
        hit = np.flatnonzero((row[:-1] == left) & (row[1:] == right))
        if left == right and len(hit):  # of overlapping pairs every second one
            fresh = np.append(True, np.diff(hit) > 1)
            start = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - start) % 2 == 0]
        if len(hit):
            row = row.copy()
            row[hit] = n
            row = np.delete(row, hit + 1)
    return row


def learn(distinct: DataFrame, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """The rules of Re-Pair over a column `seq` of distinct segments: a round counts all neighbours and takes the most
    frequent RULES_A_ROUND that occur at least twice, until none does. The number of rules is bounded by the rounds."""
    rules: list[tuple[int, int]] = []
    for _ in range(rounds):
        known = list(rules)

        def count(batches):
            for batch in batches:
                row = encoded(batch.column("seq").to_pylist(), known).astype(np.int64)
                inside = (row[:-1] != _APART) & (row[1:] != _APART)
                pairs, n = np.unique(row[:-1][inside] * (_APART + 1) + row[1:][inside], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])

        counted = distinct.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        best = counted.where("n > 1").orderBy(F.desc("n"), "pair").limit(RULES_A_ROUND).collect()
        if not best:
            break
        rules += [divmod(r["pair"], _APART + 1) for r in best]
    return rules


# --- Rows ------------------------------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that a row's id and turn decide."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    kind = F.crc32(key.cast("binary")) % 20
    marked = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    return marked.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def _in_order(damaged: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, code and pos: the rows without their texts, numbered in order over all tasks.

    Rows of one turn are ordered by role and digest. Equal rows are told apart by a number, so that any number of them
    is cut between tasks.
    """
    bare = F.rtrim("text", F.lit(SPACE))
    fault = F.when(bare == "", 2).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    keys = ["conv_id", "turn", "role", "digest", "number"]
    narrow = damaged.select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"),
                            (_initial(F.col("role")) * 4 + fault).alias("code"),
                            F.monotonically_increasing_id().alias("number"))
    n = int(damaged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = narrow.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return materialize(ordered.withColumn("pos", F.monotonically_increasing_id()).drop("number"), "ordered")


def _segments(ordered: DataFrame) -> DataFrame:
    """conv_id, pos, the place of the first row in `turn`, `role` and `digest`, the symbols, and what turns it holds."""
    same = ["conv_id", "role", "digest"]
    shared = ordered.groupBy(*same).agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = materialize(shared.select(*[F.col(c).alias(f"s_{c}") for c in same], "first"), "shared")
    match = F.col("conv_id").eqNullSafe(F.col("s_conv_id")) & (F.col("role") == F.col("s_role")) & (
        F.col("digest") == F.col("s_digest"))
    again = (F.col("pos") > F.col("first")) & (F.col("code") % 4 != 2)
    code = F.when(again, F.col("code") - F.col("code") % 4 + 3).otherwise(F.col("code"))
    rows = ordered.join(shared, match, "left").select(
        "conv_id", "pos", "turn", "role", "digest", code.alias("code"))
    block = F.shiftright("pos", 33).alias("part"), F.floor(F.col("pos").bitwiseAND((1 << 33) - 1) / SEGMENT).alias("block")
    listed = rows.groupBy("conv_id", *block).agg(
        F.sort_array(F.collect_list(F.struct("pos", "turn", "code"))).alias("rows"),
        F.min(F.struct("pos", "turn", "role", "digest")).alias("head"))
    turns = F.filter(F.transform("rows", lambda r: r["turn"]), lambda t: t.isNotNull())
    letters = F.transform("rows", lambda r: F.substring(F.lit(SYMBOLS), r["code"] + 1, F.lit(1)))
    return materialize(listed.select(
        "conv_id", "head.*", F.array_join(letters, "").alias("seq"), F.array_min(turns).alias("low"),
        F.array_max(turns).alias("high"), F.size(F.array_distinct(turns)).alias("turns")), "segments")


def _evaluated(distinct: DataFrame) -> DataFrame:
    """For every distinct segment: costs, places among the audits of one start state, audits, fault counts, initials."""
    table = distinct.sparkSession.sparkContext.broadcast((rules := learn(distinct), matrices(rules)))

    def evaluate(batches):
        rules, known = table.value
        for batch in batches:
            listed = batch.column("seq").to_pylist()
            row = encoded(listed, rules)
            ends = np.flatnonzero(row == _APART)
            costs, ranks, audits, counts, first, last = [], [], [], [], [], []
            for seq, a, b in zip(listed, [0, *(ends[:-1] + 1).tolist()], ends.tolist()):
                matrix = along(row[a:b].tolist(), known)
                strings = [[e and flat(e[1]) for e in line] for line in matrix]
                costs.append([-1 if e is None else e[0] for line in matrix for e in line])
                ranks.append([-1 if s is None else sum(o is not None and o < s for o in line)
                              for line in strings for s in line])
                audits.append([s for line in strings for s in line])
                codes = np.frombuffer(seq.encode(), np.uint8) - ord("A")
                initials = ["sua-"[c] for c in (codes // 4).tolist()]
                illegal = sum(pair not in LEGAL for pair in zip(initials, initials[1:]))
                counts.append([*(int((codes % 4 == f).sum()) for f in (2, 3, 1)), illegal])
                first.append(initials[0])
                last.append(initials[-1])
            ints = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("seq"), pa.array(costs, ints), pa.array(ranks, ints), pa.array(audits, pa.list_(pa.string())),
                 pa.array(counts, ints), pa.array(first, pa.string()), pa.array(last, pa.string())],
                ["seq", "costs", "ranks", "audits", "counts", "first", "last"])

    schema = ("seq string, costs array<long>, ranks array<long>, audits array<string>, counts array<long>, "
              "first string, last string")
    return materialize(distinct.mapInArrow(evaluate, schema), "evaluated")


def chosen(parts: list[dict]) -> tuple[list[int], list[tuple[int, int]]]:
    """Of a conversation's segments in order: gaps, faults, illegal neighbours, cost and insertions at its end; and the
    states before and after every segment."""
    onward = [n * INSERT for n in TAIL]
    steps = []
    for part in reversed(parts):  # the cheapest way to the end from each state, and the state it passes
        best = []
        for i in range(4):
            ways = [(part["costs"][4 * i + j] + onward[j], part["ranks"][4 * i + j], j)
                    for j in range(4) if part["costs"][4 * i + j] >= 0]
            best.append(min(ways))
        steps.append([w[2] for w in best])
        onward = [w[0] for w in best]
    state, states = START, []
    for step in reversed(steps):
        states.append((state, step[state]))
        state = step[state]
    lows = [p["low"] for p in parts if p["low"] is not None]
    highs = [p["high"] for p in parts if p["high"] is not None]
    turns = sum(p["turns"] for p in parts) - sum(a == b for a, b in zip(highs, lows[1:]))
    blank, duplicate, truncated, illegal = (sum(p["counts"][n] for p in parts) for n in range(4))
    illegal += sum((a["last"], b["first"]) not in LEGAL for a, b in zip(parts, parts[1:]))
    gaps = highs[-1] - lows[0] + 1 - turns if lows else 0
    return [gaps, blank, duplicate, truncated, illegal, onward[START], TAIL[state]], states


def _choose(segments: DataFrame, evaluated: DataFrame) -> DataFrame:
    """One row per conversation: its totals, and (pos, from, to) of its segments."""
    summary = segments.select("conv_id", "pos", "seq", "low", "high", "turns").join(evaluated.drop("audits"), "seq")
    each = summary.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "pos", "low", "high", "turns", "costs", "ranks", "counts", "first", "last"))).alias("parts"))
    kind = segments.schema["conv_id"].dataType.simpleString()

    def choose(batches):
        for batch in batches:
            totals, states = [], []
            for parts in batch.column("parts").to_pylist():
                total, passed = chosen(parts)
                totals.append(total)
                states.append([{"pos": p["pos"], "way": 4 * i + j} for p, (i, j) in zip(parts, passed)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(totals, pa.list_(pa.int64())),
                 pa.array(states, pa.list_(pa.struct([("pos", pa.int64()), ("way", pa.int64())])))],
                ["conv_id", "totals", "states"])

    return materialize(each.mapInArrow(
        choose, f"conv_id {kind}, totals array<long>, states array<struct<pos: long, way: long>>"), "chosen")


def repaired(state: int, audit: str, rows: list[tuple[str, str]]) -> tuple[list[tuple[str, str]], int]:
    """The rows that a piece of audit leaves of its rows of role and text, and the state after it."""
    out, at = [], 0
    for letter in audit:
        if letter in "IR":
            state = after_turn(state)
            out.append(("user" if state == USER else "assistant", "" if letter == "I" else rows[at][1]))
        elif letter == "K":
            state = after_keep(state, rows[at][0][:1])
            out.append(rows[at])
        at += letter != "I"
    return out, state


class _Digest:
    """The running digest of one conversation: rows come in order, each piece of the audit before its own rows."""

    def __init__(self):
        self.hash, self.totals, self.pieces, self.audit, self.empty = hashlib.sha256(), None, deque(), [], True

    def put(self, rows: list[tuple[str, str]]) -> None:
        for role, text in rows:
            self.hash.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
            self.empty = False

    def row(self, role: str, text: str) -> None:
        state, audit, at = self.pieces[0]
        end = at
        while audit[end] == "I":
            end += 1
        out, state = repaired(state, audit[at:end + 1], [(role, text)])
        self.put(out)
        self.pieces[0] = (state, audit, end + 1)
        if end + 1 == len(audit):
            self.pieces.popleft()

    def result(self) -> tuple:
        *shown, tail = self.totals or [0] * 7
        self.put(repaired(USER if tail == 1 else SYSTEM, "I" * tail, [])[0])
        return (*shown, "".join(self.audit) + "I" * tail, self.hash.hexdigest())


_HEADER, _PIECE, _ROW = range(3)
NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _digests(batches):
    """Streams records in the order of conversation, rank, turn, role and digest into one row per conversation."""
    now, state, started = None, None, False

    def batch_of(done):
        columns = list(zip(*done))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, [kind] + [pa.int64()] * 6 + [pa.string()] * 2)], ["conv_id", *NAMES])

    kind = None
    for batch in batches:
        kind = batch.column("conv_id").type
        done = []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text", "totals", "state")]
        for conv, what, role, text, totals, start in zip(*columns):
            if not started or conv != now:
                if started:
                    done.append((now, *state.result()))
                now, state, started = conv, _Digest(), True
            if what == _HEADER:
                state.totals = totals
            elif what == _PIECE:
                state.pieces.append((start, text, 0))
                state.audit.append(text)
            else:
                state.row(role, text)
        if done:
            yield batch_of(done)
    if started:
        yield batch_of([(now, *state.result())])


def repair(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are damaged first, as their id and turn decide; a null counts as one space there and in role and text. Rows of
    a null id are one conversation. Rows of one turn, repeated ones as well, are ordered by role and by the SHA-256 of
    their text, a null turn comes first. A text without any character but white space is blank whatever its role; of
    equal rows the first is judged by its text, the others are duplicates. A role that begins with none of s, u and a
    fits nowhere unless rewritten. A conversation that lost all rows has zeros, an empty audit and the hash of the empty
    string; an empty table has no rows. Other columns are dropped.
    """
    rows = conversations.select(F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    damaged = damage(rows)
    ordered = _in_order(damaged)
    segments = _segments(ordered)
    evaluated = _evaluated(materialize(segments.select("seq").distinct(), "distinct"))
    ways = _choose(segments, evaluated)
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = rows.select("conv_id").distinct()
    totals = ways.select(F.col("conv_id").alias("w_conv_id"), "totals")
    none, place = F.lit(None), {"turn": "long", "role": "string", "digest": "binary"}
    header = names.join(totals, F.col("conv_id").eqNullSafe(F.col("w_conv_id")), "left").select(
        "conv_id", F.lit(_HEADER).alias("kind"), F.lit(-1).cast("long").alias("pos"),
        *[none.cast(t).alias(c) for c, t in place.items()], none.cast("string").alias("text"), "totals",
        none.cast("long").alias("state"))
    passed = ways.select(F.explode("states").alias("s")).select("s.*")
    pieces = segments.join(passed, "pos").join(evaluated.select("seq", "audits"), "seq").select(
        "conv_id", F.lit(_PIECE).alias("kind"), "pos", *place,
        F.element_at("audits", (F.col("way") + 1).cast("int")).alias("text"), none.cast("array<long>").alias("totals"),
        F.floor(F.col("way") / 4).alias("state"))
    texts = damaged.select(
        "conv_id", F.lit(_ROW).alias("kind"), F.lit(0).cast("long").alias("pos"), "turn", "role",
        F.unhex(F.sha2("text", 256)).alias("digest"), "text", none.cast("array<long>").alias("totals"),
        none.cast("long").alias("state"))
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    records = header.unionByName(pieces).unionByName(texts).withColumn("headed", F.col("kind") > _HEADER)
    streamed = records.repartition(n, "conv_id").sortWithinPartitions(
        "conv_id", "headed", "turn", "role", "digest", "kind", "pos").select(
        "conv_id", "kind", "role", "text", "totals", "state")
    return streamed.mapInArrow(_digests, f"conv_id {kind}, " + ", ".join(
        f"{c} {'string' if c in NAMES[-2:] else 'long'}" for c in NAMES))
