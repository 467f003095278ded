"""Registered text queries on the smallest test tables: against their SQL, or against a plain version of their own."""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from compare import difference, duck
from tidewheel.llm import language

FOLDER = "/root/testdata/sf0.001"
NAMES = ["op1_language_id", "op2_temperature_mixing", "op3_compact_windows", "op4_ngram_join", "op5_token_counts",
         "op6_lm_scoring", "op7_hamming_topk", "op8_url_filter", "op9_best_fit_packing", "op10_product_quantisation",
         "op11_balanced_lists", "op12_filter_audit", "op13_conversation_repair", "pipeline"]
CHECKED = [n for n in NAMES if n in entry.oracle_sql()]
WORD = re.compile(r"[^\x20\x09-\x0D]+")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


def test_all_are_registered():
    assert set(NAMES) <= set(entry.queries())
    assert len(CHECKED) == 8


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_check(spark, con, name):
    assert difference(spark, con, entry.queries()[name], entry.oracle_sql()[name], FOLDER) is None


def test_language_of_held_out_documents(spark, con):
    langs = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = entry.queries()["op1_language_id"](spark, FOLDER).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)


def plain_languages(texts, langs, dimensions=1024):
    """doc_id -> cosine with every language, from letter vectors made one by one and dictionaries of trigrams."""
    def symbol(c):
        return ord(c) % ((1 << 13) - 1) + 1 if c.isalpha() else 0

    def scramble(x):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ x >> shift) * factor % 2 ** 64
        return x ^ x >> 31

    @functools.cache
    def letter(s):
        bits = []
        for column in range(dimensions // 64):
            word = scramble(scramble(((s + 1) * 0x9E3779B97F4A7C15 + column * 0xD1B54A32D192ED03) % 2 ** 64))
            bits += [(word >> 8 * byte + 7 - bit) & 1 for byte in range(8) for bit in range(8)]
        return np.array(bits) * 2 - 1

    @functools.cache
    def bound(a, b, c):
        return np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c)

    vectors = {}
    for d, t in texts.items():
        row = [0, *map(symbol, t.lower()), 0]
        counts = Counter((row[i - 1], row[i], row[i + 1]) for i in range(1, len(row) - 1) if row[i])
        vectors[d] = sum((n * bound(*g) for g, n in counts.items()), np.zeros(dimensions))
    learned = {x: sum(v for d, v in vectors.items() if langs[d] == x and zlib.crc32(str(d).encode()) % 4 != 2)
               for x in sorted({x for x in langs.values() if x})}
    return {d: {x: v @ p / max(np.linalg.norm(v) * np.linalg.norm(p), 1e-300) for x, p in learned.items()}
            for d, v in vectors.items()}


def test_language_equals_a_plain_version(spark, con, texts):
    langs = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    plain = plain_languages(texts, langs)
    for r in entry.queries()["op1_language_id"](spark, FOLDER).collect():
        best = max(plain[r.doc_id].values())
        assert abs(max(best, 0) - r.score) < 1e-5
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id]))
        assert r.lang_pred == "und" or plain[r.doc_id][r.lang_pred] > best - 1e-5


def test_texts_in_unknown_letters_are_rejected(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, "漢字漢字", None), (-2, "xqzjk wvbxq zzkkq", None), (-3, "Привет, как дела?", None)], docs.schema)
    kept = {r.doc_id for r in language.keep_identified(docs.unionByName(odd)).select("doc_id").collect()}
    assert not kept & {-1, -2, -3} and len(kept) > 190


def test_every_repeated_run_of_fifty_words_is_found(spark, texts):
    rows = entry.queries()["op3_compact_windows"](spark, FOLDER).collect()
    split = {d: words(t) for d, t in texts.items()}
    holders = {}
    for d, w in split.items():
        for i in range(len(w) - 49):
            holders.setdefault(tuple(w[i:i + 50]), set()).add(d)
    covered = {}
    for r in rows:
        covered.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
        a = split[r.first_doc_id][r.first_start:r.first_end]
        b = split[r.doc_id][r.start_word:r.end_word]
        one, two = ({tuple(x[i:i + 5]) for i in range(len(x) - 4)} for x in (a, b))
        assert min(len(a), len(b)) >= 50 and 100 * len(one & two) >= 80 * len(one | two) and r.first_doc_id < r.doc_id
        assert abs(len(one & two) / len(one | two) - r.similarity) < 1e-9
    repeated = 0
    for d, w in split.items():
        for i in range(len(w) - 49):
            if min(holders[tuple(w[i:i + 50])]) < d:
                repeated += 1
                assert covered.get(d, set()) >= set(range(i, i + 50)), (d, i)
    assert repeated > 100


def test_token_counts_of_the_library(spark, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = entry.queries()["op5_token_counts"](spark, FOLDER).collect()
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {
        (d, len(t.encode()), n := len(model.encode(t)), n > 4096) for d, t in texts.items()}


def check_pieces(rows, texts, most):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4") for d, t in texts.items()}
    own, sequences = {}, {}
    for r in rows:
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        own.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, pieces in own.items():
        starts = np.cumsum([0] + [n for *_, n in sorted(pieces)])
        assert [(p, s) for p, s, _ in sorted(pieces)] == list(enumerate(starts[:-1].tolist()))
        assert starts[-1] == len(ids[d]) and all(n == 1024 for p, _, n in pieces if p)
    for placed in sequences.values():
        ends = np.cumsum([0] + [n for _, n in sorted(placed)])
        assert [o for o, _ in sorted(placed)] == ends[:-1].tolist() and ends[-1] <= 1024
    total = sum(len(ids[d]) for d in own)
    assert len(sequences) <= most * -(-total // 1024)
    return own


def test_packing_is_a_round_trip(spark, texts):
    own = check_pieces(entry.queries()["op9_best_fit_packing"](spark, FOLDER).collect(), texts, 1.02)
    assert set(own) == set(texts)


def test_pipeline_stage_by_stage(spark, texts, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert docs.columns == columns
            kept.append({r.doc_id: r.text for r in docs.collect()})
    assert set(kept[0]) == {d for d, t in texts.items() if any(c.isalpha() for c in t)}
    sets = {d: frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) for d, t in kept[0].items()
            if (w := words(t))}
    links = {d: [e for e, y in sets.items() if 100 * len(x & y) >= 80 * len(x | y)] for d, x in sets.items()}
    seen, first = set(), set()
    for d in sorted(sets):
        if d not in seen:
            first.add(d)
            todo = [d]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += links[x]
    assert set(kept[1]) == first and all(kept[1][d] == texts[d] for d in first)
    runs = {}
    for d, t in kept[2].items():
        w = words(t)
        for i in range(len(w) - 49):
            assert runs.setdefault(tuple(w[i:i + 50]), d) == d
    assert set(kept[3]) <= set(kept[2]) and all(kept[3][d] == kept[2][d] for d in kept[3])
    tokens = [sum(len(words(t)) for t in kept[i].values()) for i in (2, 3)]
    assert 0.8 * tokens[0] < tokens[1] <= 0.9 * tokens[0]
    own = check_pieces(docs.collect(), kept[3], 1.05)
    assert set(own) == set(kept[3])
