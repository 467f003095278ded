"""Numpy parts of the text operators against plain Python."""

from __future__ import annotations

import itertools
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewheel.llm import (hamming, lm_scoring, near_vectors, ngram_join, packing, passages, pretokens, text,
                           url_filter)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXT = st.text(st.sampled_from("abAB st'mdrevl.,!?1x9Éçß \n\t\r\x0b\x1c ▁–漢<|>"), max_size=80)


def lower(value: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), value)


def batches(texts):
    return iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8))
def test_shingles_equal_plain_sets(texts):
    block = text.words(pa.array(texts, pa.string()))
    grams, first = text.shingles(block)
    values, starts = text.distinct(grams.copy(), first)
    kinds = {}
    for d, value in enumerate(texts):
        w = WORD.findall(lower(value or ""))
        assert block.first[d + 1] - block.first[d] == len(w)
        raw = (value or "").encode()
        found = [raw[a:b].decode() for a, b in zip(block.start[block.first[d]:block.first[d + 1]],
                                                   block.end[block.first[d]:block.first[d + 1]])]
        assert [lower(x) for x in found] == w
        plain = [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
        assert len(set(plain)) == starts[d + 1] - starts[d]
        for gram, value in zip(plain, grams[first[d]:first[d + 1]]):
            assert kinds.setdefault(gram, value) == value
    assert len(set(kinds.values())) == len(kinds)


def test_blocks_keep_all_rows_in_order():
    texts = ["x" * n for n in (0, 5, 100, 3, 3, 3)] + [None, "y" * 50]
    parts = [b.column("text").to_pylist() for b in text.blocks(batches(texts), limit=10)]
    assert sum(parts, []) == texts and all(sum(len(t or "") for t in p) <= 10 or len(p) == 1 for p in parts)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_byte_level_pre_tokens_give_the_ids_of_the_library(texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = pretokens.byte_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    block = text.joined(pa.array(texts))
    odd = set(pretokens.odd_documents(block).tolist())
    start, end = pretokens.byte_level(block)
    ids, first = encoder.expand(encoder.look_up(block.data, start, end))
    at = first[np.searchsorted(start, block.offsets)]
    for d, value in enumerate(texts):
        if d not in odd and "<|endoftext|>" not in value:
            assert ids[at[d]:at[d + 1]].tolist() == library.encode(value, add_special_tokens=False).ids
        if not any(ord(c) > 127 for c in value):
            assert d not in odd


def test_rank_form_is_the_same_vocabulary():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = pretokens.byte_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    words = [w for w in library.get_vocab() if w.isascii() and w.isalpha()][:5000]
    assert encoder.encode([w.encode() for w in words]) == [
        library.encode(w, add_special_tokens=False).ids for w in words]
    assert isinstance(tiktoken.__version__, str)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_spaced_words_give_the_counts_of_the_library(texts):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, encoder = sentencepiece.SentencePieceProcessor(model_file=path), pretokens.piece_encoder(path)
    block = text.joined(pa.array([t.replace("▁", " ") for t in texts]), before=b" ")
    start, end = pretokens.spaced_words(block)
    entries = encoder.look_up(block.data, start, end)
    total = np.concatenate([[0], np.cumsum(encoder.length[entries])])
    first = np.searchsorted(start, block.offsets)
    for d, value in enumerate(texts):
        if value:
            assert total[first[d + 1]] - total[first[d]] == len(model.encode(value))


def test_encoder_forgets_within_its_bound(monkeypatch):
    monkeypatch.setattr(pretokens, "CACHE_ENTRIES", 10)
    encoder = pretokens.Encoder(lambda tokens: [list(t) for t in tokens])
    for part in ("a bc def g", "h ij klm no pqr", "a bc s t u v w"):
        block = text.joined(pa.array([part]), before=b" ")
        start, end = pretokens.spaced_words(block)
        ids, _ = encoder.expand(encoder.look_up(block.data, start, end))
        assert bytes(ids.astype(np.uint8)).decode() == " " + part and len(encoder.known) <= 10


@pytest.mark.parametrize("kinds", [5, 1 << 40])
def test_window_nodes_are_those_of_the_cartesian_tree(kinds):
    rng = np.random.default_rng(kinds % 97)
    for _ in range(60):
        sizes = rng.integers(0, 90, rng.integers(1, 6))
        first = np.concatenate([[0], np.cumsum(sizes)])
        h = rng.integers(1, kinds, first[-1]).astype(np.uint64)
        least = int(rng.integers(1, 50))
        wanted = set()
        for a, b in zip(first, first[1:]):
            for c in range(a, b):
                left = right = c
                while left > a and h[left - 1] > h[c]:
                    left -= 1
                while right + 1 < b and h[right + 1] >= h[c]:
                    right += 1
                if right - left + 1 >= least:
                    wanted.add(c)
        assert set(passages.window_nodes(h, first, least).tolist()) == wanted


def test_aligned_runs():
    rng = np.random.default_rng(3)
    a, b, run = (rng.integers(0, 1 << 60, n).astype(np.uint64) for n in (300, 250, 60))
    a[100:160], b[20:80] = run, run
    assert passages.aligned(a, b, 46, 80) == [(100, 160, 20, 80, 1.0)]
    b[48:51] = 0  # three n-grams changed
    assert [x[:4] for x in passages.aligned(a, b, 46, 80)] == [(100, 160, 20, 80)]
    assert passages.aligned(a, b, 61, 80) == [] == passages.aligned(a[:30], b, 46, 80) == passages.aligned(a, b[:0], 46, 80)
    a[200:260], a[0:60] = run, run  # the passage three times: once is enough
    assert len(passages.aligned(a, b, 46, 80)) == 1
    line = np.tile(run[:10], 400)  # a line repeated four hundred times in both
    found = passages.aligned(np.concatenate([a, line]), np.concatenate([line, b]), 46, 80)
    assert {x for p, q, s, t, _ in found for x in range(s, t)} >= set(range(4000)) | set(range(4020, 4080))


@pytest.mark.parametrize("length, edit", [(52, "change"), (55, "change"), (60, "change"), (55, "insert"), (57, "drop")])
def test_aligned_near_passages_with_the_edit_at_every_place(length, edit):
    rng = np.random.default_rng(length)
    wanted = 0
    for place in range(length):
        a, b = (rng.integers(0, 1 << 40, 200 + length) for _ in range(2))
        passage = rng.integers(0, 1 << 40, length)
        a[100:100 + length] = passage
        changed = {"change": np.concatenate([passage[:place], [7], passage[place + 1:]]),
                   "insert": np.insert(passage, place, 7), "drop": np.delete(passage, place)}[edit]
        b = np.concatenate([b[:60], changed, b[60:160]])
        grams = [sum(text.mix((w[i:len(w) - 4 + i] + i).astype(np.uint64)) for i in range(5)) for w in (a, b)]
        found = passages.aligned(*grams, 46, 80)
        assert all(min(q - p, t - s) >= 46 and similar >= 0.8 - 1e-9 for p, q, s, t, similar in found)
        mine, other = (np.isin(*g) for g in (grams, grams[::-1]))
        ends = [(p, q) for p in range(96, 112) for q in range(p + 46, 102 + length) if mine[p] and mine[q - 1]]
        near = any(passages._similarity(grams[0][p:q], grams[1][p - 40:t - 40]) >= 0.8
                   for p, q in ends for t in (q - 1, q, q + 1) if t - p >= 46 and other[p - 40] and other[t - 41])
        wanted += near
        assert bool(found) >= near, place
    assert wanted > 10


def test_aligned_covers_what_all_pairs_of_runs_cover():
    """Against every pair of runs, on sequences that share a piece with edits, amid noise."""
    rng = np.random.default_rng(12)
    covered = wanted = 0
    for _ in range(80):
        pool = rng.integers(0, 1 << 30, 40)

        def sequence():
            parts = [rng.integers(0, 1 << 30, rng.integers(2, 10))]
            at, n = rng.integers(0, 12), rng.integers(10, 28)
            piece = pool[at:at + n].copy()
            edited = rng.random(len(piece)) < 0.06
            piece[edited] = rng.integers(0, 1 << 30, edited.sum())
            parts += [piece, rng.integers(0, 1 << 30, rng.integers(0, 6))]
            return np.concatenate(parts).astype(np.uint64)

        a, b = sequence(), sequence()
        mine = np.zeros(len(b), bool)
        for p, q, s, t, similar in passages.aligned(a, b, 8, 80):
            assert min(q - p, t - s) >= 8 and similar >= 0.8 - 1e-9
            assert abs(similar - len(set(a[p:q]) & set(b[s:t])) / len(set(a[p:q]) | set(b[s:t]))) < 1e-9
            mine[s:t] = True
        true = np.zeros(len(b), bool)
        in_a, in_b = np.isin(a, b), np.isin(b, a)
        starts_a, starts_b = np.flatnonzero(in_a), np.flatnonzero(in_b)
        for p in starts_a:
            for q in starts_a[starts_a >= p + 7]:
                one = set(a[p:q + 1])
                for s in starts_b:
                    for t in starts_b[(starts_b >= s + 7) & (starts_b <= s + 1.4 * len(one))]:
                        if not true[s:t + 1].all():
                            two = set(b[s:t + 1])
                            if len(one & two) >= 0.8 * len(one | two):
                                true[s:t + 1] = True
        covered += (mine & true).sum()
        wanted += true.sum()
        assert not (mine & ~true).any()
    assert covered >= 0.97 * wanted and wanted > 500


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60), st.sampled_from(["norm", "dot"]),
       st.sampled_from([(64, 64, 4096), (64, 3, 4096), (64, 64, 4200)]))
def test_best_fit_keeps_every_capacity(lengths, rule, capacity):
    lengths = np.sort(np.array(lengths))[::-1]
    bins, offsets = packing.best_fit(lengths, capacity, (1.0, 0.1, 0.1), rule)
    for i in set(bins.tolist()):
        own = lengths[bins == i]
        assert own.sum() <= capacity[0] and len(own) <= capacity[1] and (own ** 2).sum() <= capacity[2]
        assert sorted(offsets[bins == i]) == np.cumsum([0, *own[np.argsort(offsets[bins == i])]])[:-1].tolist()
    if capacity == (64, 64, 4096):  # no two sequences could be one
        sums = sorted(lengths[bins == i].sum() for i in set(bins.tolist()))
        assert len(sums) < 2 or sums[0] + sums[1] > 64


def test_masks_and_segments():
    assert sorted(hamming.masks(4, 2).tolist()) == [3, 5, 6, 9, 10, 12]
    codes = np.array([[0x8000000000000001, 1]], np.uint64)
    assert [int(x[0]) for x in hamming.segments(codes, 65, 16)] == [1, 0, 0, 0x8000, 1]


def test_probes_reach_every_list_that_may_hold_a_neighbour():
    rng = np.random.default_rng(5)
    units = rng.normal(size=(4000, 16))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    near = units[:500] + rng.normal(size=(500, 16)) * 0.02
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    model = near_vectors.Quantiser(units[:1000], 40)
    radius = float(np.linalg.norm(near - units[:500], axis=1).max())
    home, who, where = model.probes(units[:500], radius)
    probed = set(zip(who.tolist(), where.tolist()))
    other = model.probes(near, radius)[0]
    assert all((i, int(c)) in probed for i, c in enumerate(other))
    assert len(probed) < 500 * 40 / 2
    codes, error = model.encode(near, other)
    for c in set(other.tolist()):
        own = np.flatnonzero(other == c)
        coded = np.sqrt(np.maximum(model.distances(units[own], c, codes[own]), 0)).diagonal()
        assert (np.abs(coded - np.linalg.norm(near[own] - units[own], axis=1)) <= error[own] + 1e-6).all()


def test_url_index(tmp_path, monkeypatch):
    rules = [url_filter.Rule("org", "/", True), url_filter.Rule("a.org", "/x", False), url_filter.Rule("B.org", "", False)]
    path = tmp_path / "rules"
    path.write_bytes(url_filter.build_index(rules))
    array = url_filter.DigestArray(str(path))
    hosts = ["a.org", "z.a.org", "a.org", "za.org", "c.b.org", "", "org"]
    paths = ["/xy", "/x", "/y", "/x", "", "/", ""]
    texts = [array.string(i) if i >= 0 else None for i in url_filter.longest_fits(array, hosts, paths)]
    assert texts == ["a.org/x", "a.org/x", "org/", "org/", "b.org", None, None]
    with pytest.raises(ValueError):
        url_filter.build_index([*rules, url_filter.Rule("org", "/", False)])
    with pytest.raises(ValueError):
        url_filter.build_index([url_filter.Rule("", "/", False)])
    # equal digests: only the stored string decides
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda data: 7)
    path.write_bytes(url_filter.build_index(rules))
    clash = url_filter.DigestArray(str(path))
    assert [clash.string(i) if i >= 0 else None for i in clash.find(["a.org/x", "org/", "no"]).tolist()] == [
        "a.org/x", "org/", None]


def test_empty_index(tmp_path):
    path = tmp_path / "rules"
    path.write_bytes(url_filter.build_index([]))
    assert url_filter.longest_fits(url_filter.DigestArray(str(path)), ["a"], ["/"]) == [-1]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=30), st.lists(st.integers(0, 10**12) | st.integers(250, 260), max_size=30))
def test_packed_hashes_and_counts(values, counts):
    values, counts = np.unique(np.array(values, np.uint64)), np.array(counts, np.int64)
    assert (lm_scoring._apart(lm_scoring._close(values), len(values)) == values).all()
    assert (lm_scoring._wide(lm_scoring._thin(counts), len(counts)) == counts).all()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sets(st.integers(0, 2**64 - 1), max_size=30), min_size=2, max_size=4))
def test_bitmaps_differ_no_more_than_the_sets(found):
    values = np.concatenate([np.array(sorted(x), np.uint64) for x in found])
    first = np.concatenate([[0], np.cumsum([len(x) for x in found])])
    bits = ngram_join.bitmaps(values, first).view(np.uint64)
    for x, a in zip(found, bits):
        for y, b in zip(found, bits):
            assert np.bitwise_count(a ^ b).sum() <= len(x ^ y)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_automaton_gives_the_interpolated_probabilities(order, monkeypatch):
    rng = np.random.default_rng(order)
    monkeypatch.setattr(lm_scoring, "PIECE", 7)
    texts = pa.chunked_array([pa.array([" ".join(f"w{x}" for x in rng.integers(0, 6, rng.integers(0, 40)))
                                        for _ in range(60)] + ["", "new words only here", None])])
    learned = np.arange(63) % 5 > 0
    learned[-2:] = False
    stream = lm_scoring.Stream(texts, order)
    values, back = np.unique(stream.every(), return_inverse=True)
    weight = np.concatenate([np.tile(np.repeat(learned, stream.counts), order), learned])
    totals = np.bincount(back, weights=weight, minlength=len(values)).astype(np.int64)
    got = lm_scoring.Automaton(stream, values, back, totals, order, 500.0).scores(stream)
    plain = lm_scoring.left_out_of(stream, totals[back], np.ones(63, bool), order, 500.0, less=0)
    assert np.allclose(got, plain, rtol=1e-10) and (got < 0).all()


def test_needed_windows_hold_a_rare_common_hash_of_every_similar_pair_of_runs():
    """Any two runs that agree in MIN_HASHES functions meet in a hash that both need."""
    rng = np.random.default_rng(21)
    least, pool = 12, rng.integers(0, 1 << 60, 300).astype(np.uint64)
    docs = [np.concatenate([pool[a:a + n] for a, n in zip(rng.integers(0, 280, 4), rng.integers(3, 25, 4))]) for _ in range(25)]
    rows, runs = [], {}
    for d, grams in enumerate(docs):
        for k in range(passages.HASHES):
            h = (text.mix(grams ^ passages._SEED[k]) & ~np.uint64(7)) | np.uint64(k)
            at, back, ahead = passages.windows_of(h, np.array([0, len(h)]), least)
            rows += [(d, int(v), p) for v, p in zip(h[at], passages._packed(at, back, ahead).tolist())]
            for s in range(len(h) - least + 1):
                runs.setdefault((d, s), []).append(int(h[s:s + least].min()))
    holders = {}
    for d, v, _ in rows:
        holders.setdefault(v, set()).add(d)
    shared = [r for r in rows if len(holders[r[1]]) > 1]
    some = passages.needed(*(np.array([r[i] for r in shared], t) for i, t in ((0, np.int64), (1, np.uint64), (2, np.int64))),
                           np.array([len(holders[r[1]]) for r in shared]), least)
    kept = {}
    for (d, v, _), keep in zip(shared, some):
        if keep:
            kept.setdefault(d, set()).add(v)
    assert 0 < some.sum() < len(shared)
    met = 0
    for ((d, _), x), ((e, _), y) in itertools.combinations(runs.items(), 2):
        if d != e and sum(a == b for a, b in zip(x, y)) >= passages.MIN_HASHES:
            met += 1
            assert kept[d] & kept[e] & set(x) & set(y)
    assert met > 100


def test_what_a_worker_holds_for_a_few_words_is_small(monkeypatch):
    """An executor's workers and all that they keep stand beside its heap."""
    monkeypatch.setattr(text, "_powers", {})
    assert len(text.words(pa.array(["a few words"])).hashes) == 3
    assert 0 < sum(p.nbytes for p in text._powers.values()) < 12 << 20
    long = text.words(pa.array(["x" * (3 << 20) + " y", "z"]))  # grows with a longer text
    assert long.first.tolist() == [0, 2, 3]


def test_pairs_are_verified_in_batches_of_few_texts():
    n = 400
    texts = ["t" * 10_000 for _ in range(n)]
    batch = pa.RecordBatch.from_pydict({"a": range(n), "b": range(n, 2 * n), "x": range(n), "y": range(n, 2 * n),
                                        "text_x": texts, "text_y": texts})
    parts = list(passages._bounded(batch))
    assert [i for part in parts for i in part.column("a").to_pylist()] == list(range(n))
    assert max(2 * 10_000 * part.num_rows for part in parts) <= 1 << 20


def test_a_document_is_sorted_once_for_all_its_pairs(monkeypatch):
    rng = np.random.default_rng(5)
    line = rng.integers(1, 1 << 62, 70).astype(np.uint64)
    plain = [np.concatenate([rng.integers(1, 1 << 62, n).astype(np.uint64), line[:m], line[5:9]])
             for n, m in ((30, 70), (200, 60), (5, 30), (0, 70))]
    expected = [passages.aligned(a, b, 46, 80) for a, b in itertools.permutations(plain, 2)]
    assert sum(map(bool, expected)) == 6
    sorts = []
    argsort = np.argsort
    monkeypatch.setattr(passages.np, "argsort", lambda x, **how: sorts.append(len(x)) or argsort(x, **how))
    kept = [passages.Grams(x) for x in plain]
    assert [passages.aligned(a, b, 46, 80) for a, b in itertools.permutations(kept, 2)] == expected
    assert sum(sorts.count(len(x)) for x in plain) <= len(plain)


def test_shared_runs_are_those_counted_by_hand():
    rng = np.random.default_rng(5)
    rows = [rng.integers(0, 40, n).astype(np.uint32) for n in (30, 12, 30, 9, 25)]
    for least in (1, 4, 7):
        needs = np.full(len(rows), least)
        for i, got in zip((0, 2, 3, 4), passages.shared_runs(rows, np.array([0, 2, 3, 4]), 10, needs)):
            held = [np.isin(rows[i], other) for other in rows[:i]]
            k = min(10, len(rows[i]))
            assert got.tolist() == [e for e, h in enumerate(held) if max(h[j:j + k].sum() for j in range(len(h) - k + 1)) >= least]


def test_documents_whose_windows_meet_without_a_similar_run_are_not_verified(spark, monkeypatch):
    """Near copies with an edit in every run of fifty words share window hashes, but no passage."""
    rng = np.random.default_rng(3)
    plain = rng.integers(0, 10_000, 150).tolist()
    rows = []
    for d in range(60):
        own = list(plain)
        for at in range(int(rng.integers(0, 16)), 150, 16):
            own[at] = 20_000 + int(rng.integers(0, 100_000))
        rows.append((d, " ".join(f"w{x}" for x in own)))
    pairs, verify = [], passages._verify
    monkeypatch.setattr(passages, "_verify", lambda p, *rest: pairs.append(p.count()) or verify(p, *rest))
    passages.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(pairs) < 5 * len(rows)


def test_vocabularies_are_given_back_by_the_next_operator():
    """A worker process that has packed texts does not hold vocabularies while it joins n-grams."""
    import public_tokenizers

    from tidewheel.llm import language, ngram_join

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    once = pretokens.byte_encoder(path, public_tokenizers.PATTERN)
    for module in (language, ngram_join, passages):
        assert pretokens.byte_encoder(path, public_tokenizers.PATTERN) and pretokens._encoders
        module.release()
        assert not pretokens._encoders
    assert once.encode([b"words"]) == pretokens.byte_encoder(path, public_tokenizers.PATTERN).encode([b"words"])
