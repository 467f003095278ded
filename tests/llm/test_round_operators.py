"""Posting lists, the filter audit and conversation repair against plain versions, and on odd inputs."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewheel.llm import conversations, filter_audit, posting_lists

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- Conversations ---------------------------------------------------------

def after(state, initial):
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}.get((state, initial))


def plain_repair(rows):
    """conv_id -> the result columns, by a search over single edits."""
    found = {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        kept = found.setdefault(conv, [])
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn is not None, turn or 0, "user" if kind == 4 else role, hashlib.sha256(text.encode()).digest(),
                      text)] * (2 if kind == 3 else 1)
    return {conv: plain_one(sorted(kept)) for conv, kept in found.items()}


def plain_one(kept):
    faults, seen = [], set()
    for _, _, role, _, text in kept:
        ends = WORD.findall(text)
        faults.append("b" if not ends else "d" if (role, text) in seen else "" if ends[-1][-1] in ".!?" else "t")
        seen.add((role, text))
    turns = [t for known, t, *_ in kept if known]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for _, _, role, _, _ in kept]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    todo, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, at, state, out = heapq.heappop(todo)
        if at == len(kept) and state in ("", "a"):
            break
        if (at, state) in done:
            continue
        done.add((at, state))
        for initial, name in (("u", "user"), ("a", "assistant")):
            if to := after(state, initial):
                heapq.heappush(todo, (cost + 3, audit + "I", at, to, (*out, f"{name}:")))
        if at < len(kept):
            _, _, role, _, text = kept[at]
            heapq.heappush(todo, (cost + 4, audit + "D", at + 1, state, out))
            if faults[at] in ("", "t"):
                extra = 3 * (faults[at] == "t")
                if to := after(state, role[:1]):
                    heapq.heappush(todo, (cost + extra, audit + "K", at + 1, to, (*out, f"{role}:{text}")))
                for initial, name in (("u", "user"), ("a", "assistant")):
                    if to := after(state, initial):
                        heapq.heappush(todo, (cost + 3 + extra, audit + "R", at + 1, to, (*out, f"{name}:{text}")))
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def repaired(spark, rows, parts=3):
    names = ["conv_id", *conversations.NAMES]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, "
                                  "pos int, `a.b` string").repartition(parts)
    found = conversations.repair(frame)
    assert found.columns == names
    rows_out = found.collect()
    assert len({r.conv_id for r in rows_out}) == len(rows_out)
    return {r.conv_id: tuple(r)[1:] for r in rows_out}


def random_rows(rng, conv, n):
    texts = ["One two.", "three", "", " \n", "Four!", "five? ", "six \x0b", "seven ."]
    roles = ["user", "assistant", "system", "tool", "", None, "sys", "u"]
    chance = [0.3, 0.3, 0.1, 0.06, 0.06, 0.06, 0.06, 0.06]
    return [(conv, None if rng.random() < 0.05 else int(rng.integers(0, n + 3)), rng.choice(roles, p=chance),
             None if rng.random() < 0.05 else texts[rng.integers(len(texts))] if rng.random() < 0.3 else f"t{i}.")
            for i in range(n)]


def test_repair_equals_a_search_over_edits(spark):
    rng = np.random.default_rng(3)
    rows = [r for c in range(150) for r in random_rows(rng, c, int(rng.integers(1, 12)))]
    rows += random_rows(rng, None, 9) + rows[:20]
    assert repaired(spark, rows) == plain_repair(rows)


def test_long_conversation_over_many_segments(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = random_rows(rng, 7, 3000) + random_rows(rng, 8, 5) + [(9, 4, "user", "same.")] * 700
    monkeypatch.setattr(conversations, "SEGMENT", 16)
    assert repaired(spark, rows) == plain_repair(rows)


def test_conversations_without_rows(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repaired(spark, [(1, gone, "user", "x")]) == {1: nothing}
    assert repaired(spark, []) == {}


def test_rules_shorten_and_products_do_not_depend_on_them(spark):
    rng = np.random.default_rng(5)
    seqs = ["".join(rng.choice(list("EIEIFKB"), 40)) for _ in range(30)] + ["E" * 33]
    rules = conversations.learn(spark.createDataFrame([(s,) for s in seqs], "seq string"))
    assert 0 < len(rules) <= conversations.ROUNDS * conversations.RULES_A_ROUND
    table = conversations.matrices(rules)
    short, plain = conversations.encoded(seqs, rules), conversations.encoded(seqs, [])
    assert len(short) < 0.6 * len(plain)

    def each(row):
        ends = np.flatnonzero(row == 0xFFFF)
        return [conversations.along(row[a:b].tolist(), table) for a, b in zip([0, *ends[:-1] + 1], ends)]

    for one, two in zip(each(short), each(plain)):
        assert [[e and (e[0], conversations.flat(e[1])) for e in line] for line in one] == \
               [[e and (e[0], conversations.flat(e[1])) for e in line] for line in two]


# --- Filter audit ----------------------------------------------------------

def plain_audit(docs, labels):
    texts = [(i, text or "", lang or "") for i, text, lang in docs]
    least = {}
    for i, text, _ in texts:
        if i is not None:
            least[text] = min(i, least.get(text, i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, part in texts:
        w = WORD.findall(text)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                 "E": i is not None and i > least[text]}
        rows.append((part, {x for x, bad in fails.items() if bad}, i in good, i in toxic))
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, name in enumerate(order, 1):
                earlier = set(order[:step - 1])
                here = [r for r in own if name in r[1] and not r[1] & earlier]
                shapley[part, name] = shapley.get((part, name), 0) + len(here)
                out[part, order, step] = [
                    sum(not r[1] & (earlier | {name}) for r in own), len(here),
                    sum(name in r[1] and bool(r[1] & earlier) for r in own), sum(r[1] == {name} for r in own),
                    sum(r[2] for r in here), sum(r[3] for r in here)]
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def audited(spark, docs, labels):
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, lang string, mask int, "
                                  "`a.b` int").repartition(4)
    marks = spark.createDataFrame([(*x, "k") for x in labels], "doc_id long, quality int, toxic int, text string")
    rows = filter_audit.audit(frame, marks).collect()
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in rows}


def random_docs(rng, n):
    base = [" ".join(f"w{x}" for x in rng.integers(0, 400, rng.integers(0, 320))) for _ in range(n // 3)]
    docs = []
    for i in range(n):
        text = base[rng.integers(len(base))] if rng.random() < 0.6 else base[0] + f" tail {i}"
        text += rng.choice(["", "", " $ü", " ABCDEFGHIJKLMNOPQRSTUVWXYZ", "\x0b漢"])
        docs.append((None if rng.random() < 0.03 else int(rng.integers(0, n)), None if rng.random() < 0.03 else text,
                     rng.choice(["en", "de", "", None])))
    return docs + docs[:9]


@pytest.mark.parametrize("small", [False, True])
def test_audit_equals_a_plain_count(spark, monkeypatch, small):
    rng = np.random.default_rng(6)
    docs = random_docs(rng, 300)
    labels = [(None if rng.random() < 0.05 else int(rng.integers(0, 300)), *rng.choice([0, 1, None], 2)) for _ in range(200)]
    if small:  # many ranges, tries that are given out often, labels that are not broadcast
        monkeypatch.setattr(filter_audit, "TARGET_BYTES", 8000)
        monkeypatch.setattr(filter_audit, "BLOCK_TRIE", 2000)
        monkeypatch.setattr(filter_audit, "BROADCAST_IDS", 0)
        assert len(filter_audit._cuts(spark.createDataFrame([(d[1] or "",) for d in docs], "text string"))) > 5
    assert audited(spark, docs, labels) == plain_audit(docs, labels)
    assert audited(spark, [], labels) == {}


def test_ranges_go_deeper_where_heads_are_equal(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "TARGET_BYTES", 20_000)
    head = "x" * 3000
    frame = spark.createDataFrame([(f"{head}{i:05d}",) for i in range(200)], "text string")
    cuts = filter_audit._cuts(frame)
    assert len(cuts) > 10 and all(len(c) > 3000 for c in cuts)


def test_trie_keeps_all_texts():
    rng = np.random.default_rng(7)
    texts = {bytes(rng.choice([97, 98, 0xFF], rng.integers(0, 9))) for _ in range(500)} | {b"", b"a" * 9000, b"a" * 8999}
    trie = filter_audit.Trie()
    for n in (1, 2):
        for text in sorted(texts, key=hash):
            node = trie.terminal(text)
            node.value = (node.value or 0) + 1
    assert dict(trie.terminals()) == dict.fromkeys(texts, 2)


# --- Posting lists ---------------------------------------------------------

def found_and_true(spark, rows, k=10, every=100):
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, node int, "
                                  "`a.b` int").repartition(3)
    got = {}
    for r in posting_lists.search(frame, k, every).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    kept = {(i, tuple(np.float32(v).tolist())) for i, v in rows if i is not None and v and None not in v
            and np.isfinite(v).all() and np.any(v)}
    true = {}
    for i, v in kept:
        if i % every == 0:
            near = [(float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())), j) for j, w in kept if j != i and len(w) == len(v)]
            true[i] = [(n, *x) for n, x in enumerate(sorted(near)[:k], 1)]
    return {i: sorted(x) for i, x in got.items()}, {i: x for i, x in true.items() if x}


def test_neighbours_of_clustered_vectors(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16)) * 4
    points = (centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16))).astype(np.float32)
    got, true = found_and_true(spark, list(enumerate(points.tolist())))
    assert set(got) == set(true) and all([x[0] for x in g] == list(range(1, 11)) for g in got.values())
    hits = sum(len({x[2] for x in got[i]} & {x[2] for x in true[i]}) for i in true)
    assert hits >= 0.9 * 10 * len(true)


def test_neighbours_of_odd_vectors(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(i, rng.normal(size=3).tolist()) for i in range(300, 330)]
    rows += [(100, [1.0, 2.0, 3.0]), (100, [1.0, 2.0, 3.0]), (5, [1.0, 2.0, 3.0]), (400, [1.0, 2.0]), (7, [3.0, 4.0]),
             (500, [0.0, 0.0, 0.0]), (600, None), (700, [1.0, None, 2.0]), (800, [float("nan"), 1.0, 1.0]),
             (900, [float("inf"), 1.0, 1.0]), (None, [1.0, 2.0, 3.0]), (1000, []), (1100, [1e38, -1e38, 1e38, 1e38])]
    got, true = found_and_true(spark, rows)
    assert got == true and set(got) == {0, 100, 200, 300, 400}
    assert found_and_true(spark, []) == ({}, {})
    assert found_and_true(spark, [(100, [1.0])]) == ({}, {})


def test_graph_reaches_the_nearest_lists():
    rng = np.random.default_rng(10)
    sample = rng.normal(size=(2000, 8))
    model = posting_lists.Lists(sample, 200, 10)
    sizes = np.bincount(posting_lists.squares(sample, model.centres).argmin(axis=1))
    assert len(model.centres) >= 128 and sizes.max() < 60
    far = np.sqrt(posting_lists.squares(sample[:300], model.centres))
    ids, _ = model.nearest(sample[:300], posting_lists.BEAM)
    assert (ids[:, 0] == far.argmin(axis=1)).mean() > 0.97
    row, lists = model.reads(sample[:300], 1.5)
    want = far <= 1.5 * far.min(axis=1, keepdims=True)
    got = np.zeros_like(want)
    got[row, lists] = True
    assert (got & ~want).sum() <= 20 and (got & want).sum() >= 0.97 * want.sum()
    assert posting_lists.matrix(pa.array([[1.0, 2.0], [3.0]]), 3).tolist() == [[1, 2, 0], [3, 0, 0]]
