"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, no rows and clashing column names."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewheel.llm import (components, hamming, language, lm_scoring, mixing, near_vectors, ngram_join, passages,
                           token_counts, url_filter)
from tidewheel.llm.queries import URL_RULES, packed

LONG = " ".join(f"word{i % 997} more{i}" for i in range(30_000))
PASSAGE = " ".join(f"pass{i}" for i in range(60))
#: doc_id, text, lang, source, n_chars, and names that operators use inside
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, fp long, n_words int, row string, "
          "component_id string, cuts string, `a.b` int")
ROWS = [
    (1, f"one two three {PASSAGE} four", "en", "x", 1, 1, 1, "r", "c", "k", 1),
    (2, f"ein zwei {PASSAGE} drei vier und mehr", "de", "x", 1, 1, 1, "r", "c", "k", 1),
    (3, "same text here", "en", "y", 1, None, None, None, None, None, None),
    (3, "same text here", "en", "y", 1, None, None, None, None, None, None),
    (4, "Same  TEXT\there", "en", None, 1, None, None, None, None, None, None),
    (None, "same text here", None, "y", 1, None, None, None, None, None, None),
    (5, None, "en", "x", None, None, None, None, None, None, None),
    (6, "", "en", "x", 0, None, None, None, None, None, None),
    (7, " \n\t ", "fr", None, None, None, None, None, None, None, None),
    (8, "12 34 !?", "fr", "z", 8, None, None, None, None, None, None),
    (9, LONG, "en", "z", len(LONG), None, None, None, None, None, None),
    (None, None, None, None, None, None, None, None, None, None, None),
    (10, "<|endoftext|> <s> 漢字 – ünï \x00 x", "de", "z", 9, None, None, None, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


def by_id(rows, *columns):
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append(tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]])
    return found


def test_language(docs):
    rows = by_id(language.identify(docs).collect(), "lang_pred", "score")
    assert sum(map(len, rows.values())) == len(ROWS)
    for i in (5, 6, 7, 8):
        assert rows[i] == [("und", 0.0)]
    assert rows[9][0][0] != "und" and 0 < rows[9][0][1] <= 1
    assert len(set(rows[3])) == 1
    nothing = language.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    kept = language.keep_identified(docs)
    assert kept.schema == docs.schema and sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        ["1", "2", "3", "3", "4", "None", "9"])  # the text of 10 resembles none of the two languages


def test_ngram_join(docs):
    rows = by_id(ngram_join.link(docs).collect(), "n_shingles", "component_id")
    assert rows[3] == [(1, 3), (1, 3)] and rows[4] == [(1, 3)] and sorted(rows[None], key=str) == [(0, None), (1, 3)]
    for i in (5, 6, 7):
        assert rows[i] == [(0, i)]
    assert rows[8] == [(1, 8)] and rows[9][0][1] == 9
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 3, 5, 6, 7, 8, 9, 10, None]))


def test_passages(docs):
    spans = passages.repeated(docs)
    assert [(r.doc_id, r.start_word, r.end_word, r.first_doc_id, r.first_start, r.first_end, r.similarity)
            for r in spans.collect()] == [(2, 2, 62, 1, 3, 63, 1.0)]
    cut = passages.without_repeats(docs, spans)
    assert cut.columns == docs.columns and cut.count() == len(ROWS)
    texts = by_id(cut.collect(), "text", "n_chars")
    assert texts[2] == [("ein zwei drei vier und mehr", 27)] and texts[1][0][0] == ROWS[0][1]
    assert texts[9][0][0] == LONG and texts[5] == [(None, None)]


def test_long_copies_are_cut_whole(spark):
    rows = [(i, f"{PASSAGE} {PASSAGE.upper()}") for i in (4, 2, 2, 3)] + [(None, f"{PASSAGE} {PASSAGE}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = passages.repeated(docs).select("doc_id", "start_word", "end_word", "first_doc_id").collect()
    assert sorted(map(str, spans)) == sorted(map(str, [
        spans[0].__class__(doc_id=i, start_word=0, end_word=120, first_doc_id=2) for i in (3, 4, None)]))
    left = passages.without_repeats(docs, passages.repeated(docs)).collect()
    assert [r.doc_id for r in left] == [2, 2]


def _words(rng, n):
    return [f"w{x}" for x in rng.integers(0, 1 << 40, n)]


def _found(spark, texts, pairs):
    """Those of the pairs (later, earlier) that have a row."""
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    spans = passages.repeated(rows).select("doc_id", "first_doc_id").distinct().collect()
    return {(r.doc_id, r.first_doc_id) for r in spans} & set(pairs)


def test_passages_around_a_frequent_line(spark):
    rng = np.random.default_rng(5)
    texts, pairs = [], []
    for i in range(12):
        line, before, after = _words(rng, 36), _words(rng, 10), _words(rng, 10)
        for _ in range(9):
            texts.append(_words(rng, 60) + line + _words(rng, 60))
        for _ in range(2):
            texts.append(_words(rng, 60) + before + line + after + _words(rng, 60))
        pairs.append((len(texts) - 1, len(texts) - 2))
    assert _found(spark, texts, pairs) == set(pairs)


def test_passages_after_an_earlier_variant_in_the_same_document(spark):
    rng = np.random.default_rng(6)
    texts, pairs = [], []
    for i in range(12):
        passage = _words(rng, 56)
        variant = list(passage)
        for place in (8, 24, 40):
            variant[place] = "other"
        texts.append(_words(rng, 40) + variant + _words(rng, 60) + passage + _words(rng, 40))
        texts.append(_words(rng, 50) + passage + _words(rng, 50))
        pairs.append((len(texts) - 1, len(texts) - 2))
    assert _found(spark, texts, pairs) == set(pairs)


def test_recall_of_near_passages(spark):
    """Passages of 52 to 120 words in other surroundings, with changed, new and left out words, at similarities from 0.8."""
    rng = np.random.default_rng(17)
    texts, pairs, near = [], [], []
    for _ in range(150):
        passage = _words(rng, int(rng.integers(52, 120)))
        other = list(passage)
        for _ in range(int(rng.integers(0, 4))):
            at = int(rng.integers(0, len(other)))
            other[at:at + int(rng.integers(0, 2))] = _words(rng, int(rng.integers(0, 2)))
        one, two = ({tuple(x[i:i + 5]) for i in range(len(x) - 4)} for x in (passage, other))
        if len(other) >= 52 and len(one & two) >= 0.8 * len(one | two):
            for words in (passage, other):
                texts.append(_words(rng, int(rng.integers(0, 90))) + words + _words(rng, int(rng.integers(0, 90))))
            pairs.append((len(texts) - 1, len(texts) - 2))
            near.append(len(one & two) / len(one | two))
    found = _found(spark, texts, pairs)
    assert len(pairs) > 80 and len(found) >= 0.95 * len(pairs)
    assert len([p for p, x in zip(pairs, near) if x < 1 and p in found]) >= 0.9 * sum(x < 1 for x in near)


def test_hamming_neighbours_of_an_id_with_many_codes(spark):
    def vector(flipped):
        return [-1.0 if i in flipped else 1.0 for i in range(64)]

    rows = [(0, vector({4 * i})) for i in range(8)]  # eight codes of the query's own id, two bits apart
    rows += [(i, vector({4 * s + 1 for s in range(8, 11 + i)})) for i in range(1, 6)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = hamming.search(vectors, k=3).where("query_id = 0").orderBy("rank").collect()
    assert [(r.vec_id, r.distance) for r in found] == [(1, 5), (2, 6), (3, 7)]


def test_token_counts(docs):
    rows = by_id(token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).collect(),
                 "n_bytes", "n_tokens", "over_limit")
    assert rows[5] == rows[6] == [(0, 0, False)] and rows[9][0][2] and len(rows[3]) == 2
    assert sum(map(len, rows.values())) == len(ROWS)


def test_scores(docs):
    rows = by_id(lm_scoring.score(docs).collect(), "n_tokens", "score", "base_score")
    assert sum(map(len, rows.values())) == len(ROWS) and rows[5][0][0] == rows[6][0][0] == rows[7][0][0] == 1
    assert all(s < 0 and b < 0 for found in rows.values() for _, s, b in found)
    third = by_id(lm_scoring.score(docs, order=3).collect(), "n_tokens", "score")
    assert {k: [n for n, *_ in v] for k, v in rows.items()} == {k: [n for n, _ in v] for k, v in third.items()}


def test_no_training_document(spark):
    held = [i for i in range(200) if __import__("zlib").crc32(str(i).encode()) % 10 == 0][:3]
    docs = spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")
    assert {(r.train_tokens, r.n_known, r.n_tokens) for r in lm_scoring.score(docs).collect()} == {(0, 0, 3)}


def test_mixing(docs):
    rows = mixing.mix(docs).collect()  # the budget is all there is
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in ROWS)
    assert mixing.mixed(docs).schema == docs.schema
    even = mixing.mix(docs, entropy_share=1.0).groupBy("source").agg(
        F.sum("n_tokens").alias("n"), F.max("weight").alias("w")).collect()
    assert {round(r.w, 6) for r in even if r.n} == {0.25}
    with pytest.raises(ValueError):
        mixing.mix(docs, budget_share=2.0, max_epochs=1.5)


def test_packing(docs):
    rows = packed(docs).collect()
    pieces = by_id(rows, "piece", "start", "length")
    assert pieces[5] == [(0, 0, 1)] and len(pieces[3]) == 2 and len(pieces[None]) == 2
    assert max(r.length for r in rows) <= 1024
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in held.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= 1024


def test_pages(spark):
    rows = [(1, "HTTP://A.Example.ORG/es/1?x"), (1, "HTTP://A.Example.ORG/es/1?x"), (None, "x://com/fr/"), (2, None),
            (3, ""), (4, "no scheme"), (5, "a://b://c.com/de/"), (6, "http://example.org/en/1\n2#f"), (7, "http://org")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, host string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, URL_RULES).collect()}
    assert got == {
        (1, "a.example.org", "/es/1", "example.org/es/", "block"), (None, "com", "/fr/", "com/fr/", "allow"),
        (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "", "", None, "allow"),
        (5, "b:", "//c.com/de/", None, "allow"), (6, "example.org", "/en/1\n2", "example.org/en/1", "block"),
        (7, "org", "", None, "allow")}
    assert url_filter.judge(pages, URL_RULES).count() == len(rows)


def test_rules_of_one_length_and_long_hosts(spark):
    rules = [url_filter.Rule("org", "/abcdefgh", True), url_filter.Rule("example.org", "/", False)]
    rows = [(1, "http://example.org/abcdefgh"), (2, "http://org/abcdefgh"), (3, f"http://{'a.' * 10_000}example.org/x"),
            (4, "http://..example.org/"), (5, "http://example.org./")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r.rule for r in url_filter.judge(pages, rules).collect()}
    assert got == {1: "example.org/", 2: "org/abcdefgh", 3: "example.org/", 4: "example.org/", 5: None}


VECTORS = [(1, [1.0, 0.0, 0.5]), (2, [1.0, 0.01, 0.5]), (2, [1.0, 0.01, 0.5]), (3, [-1.0, 0.0, 0.5]), (4, None), (5, []),
           (6, [0.0, 0.0, 0.0]), (7, [float("nan"), 1.0, 1.0]), (8, [None, 1.0, 1.0]), (9, [1.0, 0.0]),
           (10, [2.0, 0.0, 1.0]), (None, [1.0, 0.0, 0.5]), (11, [float("inf"), 1.0, 1.0]), (12, [1e-30, 0.0, 5e-31])]


def test_vectors(spark):
    rows = [(i, e, 1 if i != 10 else 2, "clash") for i, e in VECTORS] + [(13, [1.0, 0.0, 0.5], None, "clash")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node string")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in
                  near_vectors.near_duplicates(frame).collect()), key=str)
    lone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, 13)]
    assert got == sorted([(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (12, 4, 1, False),
                          (None, 4, 1, False)] + lone, key=str)


def test_nearest_codes(spark):
    frame = spark.createDataFrame([(i, e, "clash") for i, e in VECTORS], "vec_id long, embedding array<float>, code string")
    got = [(r.query_id, r["rank"], r.vec_id, r.distance) for r in hamming.search(frame, k=3, every=2).collect()]
    signs = {(i, tuple(x > 0 for x in e)) for i, e in VECTORS if i is not None and e and i not in (7, 8, 11)}
    wanted = []
    for q, s in sorted(signs):
        if q % 2 == 0:
            best = sorted({(sum(a != b for a, b in zip(s, t)), i) for i, t in signs if i != q and len(s) == len(t)})[:3]
            wanted += [(q, n + 1, i, d) for n, (d, i) in enumerate(best)]
    assert sorted(got) == sorted(wanted)


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 70), (55, 70), (70, 70), (80, 80), (60, 50)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 50 for i in (50, 55, 60, 70)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    for frame in (language.identify(none), language.keep_identified(none), ngram_join.link(none),
                  ngram_join.keep_first(none), passages.repeated(none),
                  passages.without_repeats(none, passages.repeated(none)),
                  token_counts.count_tokens(none, public_tokenizers.path("piece_bpe_32k.model")),
                  lm_scoring.score(none), mixing.mix(none, max_epochs=1.25), mixing.mixed(none), packed(none),
                  url_filter.judge(spark.createDataFrame([], "page_id long, url string"), URL_RULES),
                  near_vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")),
                  hamming.search(spark.createDataFrame([], "vec_id long, embedding array<float>"))):
        assert frame.count() == 0


def test_stages_on_odd_rows(spark, docs, tmp_path):
    now = docs.drop("a.b")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, "")
        out.write.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert out.columns == now.columns, name
        now = spark.read.parquet(str(tmp_path / str(i)))
    assert now.count() > 0
    none = spark.createDataFrame([], SCHEMA).drop("a.b")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "").count() == 0, name
