"""The operators of this subpackage as registered queries, with SQL that checks those which SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewheel.llm import (conversations, filter_audit, hamming, language, lm_scoring, mixing, near_vectors, ngram_join,
                           packing, passages, posting_lists, token_counts, url_filter)
from tidewheel.queries.registry import query

#: The rules that pages are judged by.
URL_RULES = (
    url_filter.Rule("org", "/", True),
    url_filter.Rule("example.org", "/es/", False),
    url_filter.Rule("example.org", "/en/1", False),
    url_filter.Rule("com", "/fr/", True),
    url_filter.Rule("com", "/de/", False),
)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


@query("op1_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(read(spark, folder, "documents"))


@query("op5_token_counts")
def token_counts_query(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


URL_SQL = """
WITH split AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         row_number() OVER () AS n
  FROM pages),
rules(rule_host, rule_path, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT n, max_by(rule_host || rule_path, {'long': length(rule_host || rule_path), 'host': length(rule_host)}) AS rule,
         max_by(verdict, {'long': length(rule_host || rule_path), 'host': length(rule_host)}) AS verdict
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM split LEFT JOIN fits USING (n)
"""


@query("op8_url_filter", URL_SQL)
def url_filter_query(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(read(spark, folder, "pages"), URL_RULES)


def packed(docs: DataFrame) -> DataFrame:
    """Sequences of 1024 tokens of the byte-level vocabulary, each document ended by id 2."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op9_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(read(spark, folder, "documents"))


NGRAM_SQL = r"""
WITH RECURSIVE numbered AS (SELECT doc_id, text, row_number() OVER () AS n FROM documents),
tokens AS (
  SELECT n, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM numbered),
grams AS (
  SELECT DISTINCT n, doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM tokens),
sizes AS (SELECT n, any_value(doc_id) AS doc_id, count(*) AS size FROM grams GROUP BY n),
common AS (
  SELECT a.n AS n, b.n AS m, count(*) AS overlap FROM grams a JOIN grams b ON a.g = b.g AND a.n <> b.n
  GROUP BY a.n, b.n),
links AS (
  SELECT o.n, o.m FROM common o JOIN sizes a ON a.n = o.n JOIN sizes b ON b.n = o.m
  WHERE 100 * overlap >= 80 * (a.size + b.size - overlap)),
reach(n, m) AS (SELECT n, n FROM numbered UNION SELECT r.n, l.m FROM reach r JOIN links l ON l.n = r.m)
SELECT any_value(x.doc_id) AS doc_id, coalesce(any_value(s.size), 0) AS n_shingles, min(y.doc_id) AS component_id
FROM reach r JOIN numbered x ON x.n = r.n JOIN numbered y ON y.n = r.m LEFT JOIN sizes s ON s.n = r.n GROUP BY r.n
"""


@query("op4_ngram_join", NGRAM_SQL)
def ngram_join_query(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.link(read(spark, folder, "documents"))


#: CRC-32 of a number's decimal text, bit by bit.
CRC_SQL = """xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(doc_id::VARCHAR, 'null'), ''),
                                                    lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
                             lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

LM_SQL = r"""
WITH rows_in AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS n FROM documents),
crc AS (SELECT n, doc_id, text, {crc} % 10 = 0 AS held FROM rows_in),
listed AS (
  SELECT n, held, list_append(list_transform(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), lambda w: 'w' || w), 'end') AS w FROM crc),
tokens AS (
  SELECT n, held, w[i] AS w, CASE WHEN i = 1 THEN 'start' ELSE w[i - 1] END AS h
  FROM (SELECT n, held, w, unnest(range(1, len(w) + 1)) AS i FROM listed)),
one AS (SELECT w, count(*) AS c FROM tokens WHERE NOT held GROUP BY w),
two AS (SELECT h, w, count(*) AS c FROM tokens WHERE NOT held GROUP BY h, w),
history AS (SELECT h, sum(c) AS c FROM two GROUP BY h),
total AS (SELECT sum(c) AS tokens, sum(c) + 0.1::DOUBLE * (count(*) + 1) AS norm FROM one),
each AS (
  SELECT n, held, coalesce(one.c, 0) AS c1, coalesce(two.c, 0) AS c2, coalesce(history.c, 0) AS ch, norm
  FROM tokens t LEFT JOIN one ON one.w = t.w LEFT JOIN two ON two.w = t.w AND two.h = t.h
  LEFT JOIN history ON history.h = t.h CROSS JOIN total),
strengths AS (SELECT unnest([{strengths}]::DOUBLE[]) AS s),
best AS (
  SELECT s FROM each CROSS JOIN strengths WHERE NOT held GROUP BY s
  ORDER BY sum(log10((c2 - 1 + s * (c1 - 1 + 0.1::DOUBLE) / norm) / (ch - 1 + s))) DESC LIMIT 1)
SELECT any_value(doc_id) AS doc_id, any_value(crc.held) AS held_out, count(*) AS n_tokens,
       count(*) FILTER (c1 > 0) AS n_known, any_value(total.tokens)::BIGINT AS train_tokens,
       round(sum(log10((c1 + 0.1::DOUBLE) / each.norm)), 6) AS base_score,
       round(sum(log10((c2 + best.s * (c1 + 0.1::DOUBLE) / each.norm) / (ch + best.s))), 6) AS score
FROM each JOIN crc USING (n) CROSS JOIN best CROSS JOIN total GROUP BY n
""".replace("{crc}", CRC_SQL).replace("{strengths}", ", ".join(map(str, lm_scoring.STRENGTHS)))


@query("op6_lm_scoring", LM_SQL)
def lm_scoring_query(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score(read(spark, folder, "documents"))


@query("op3_compact_windows")
def compact_windows(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated(read(spark, folder, "documents")).drop("text_hash")


#: The least exponent under which no source is seen more than 1.25 times in a budget of 0.9 of all tokens.
MIX = {"budget_share": 0.9, "max_epochs": 1.25}


def _search_sql(turn: int) -> str:
    """One step of the search for the exponent, as the operator takes it."""
    before = "(SELECT 0.0::DOUBLE AS low, 0.25::DOUBLE AS step)" if turn == 0 else f"t{turn - 1}"
    first = 0 if turn == 0 else 1
    return f"""
t{turn} AS (
  SELECT any_value(low) + (coalesce(min(i) FILTER (peak * 0.9 <= 1.25 OR exponent >= 1), 32) - 1) * any_value(step) AS low,
         any_value(step) / 32 AS step
  FROM (SELECT i, low, step, low + i * step AS exponent, max(pow(share, low + i * step) / share)
               / sum(pow(share, low + i * step)) AS peak
        FROM shares CROSS JOIN {before} CROSS JOIN (SELECT unnest(range({first}, 33)) AS i) WHERE share > 0
        GROUP BY i, low, step))"""


_HEX = """list_reduce(list_prepend(0::BIGINT, list_transform(string_split(substr({key}, 1, 8), ''),
          lambda c: (instr('0123456789abcdef', c) - 1)::BIGINT)), lambda a, b: a * 16 + b)"""

MIX_SQL = r"""
WITH narrow AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens,
         coalesce(doc_id::VARCHAR, 'null') AS id, row_number() OVER () AS n FROM documents),
totals AS (SELECT source, sum(n_tokens)::BIGINT AS tokens, count(*) AS documents FROM narrow GROUP BY source),
shares AS (SELECT *, tokens / sum(tokens) OVER ()::DOUBLE AS share FROM totals),""" + ",".join(
    _search_sql(i) for i in range(mixing.ROUNDS)) + r""",
weights AS (
  SELECT source, tokens, ceil(documents / 4096)::BIGINT AS blocks,
         round(pow(share, low + step * 32) / sum(pow(share, low + step * 32)) OVER (), 9) AS weight,
         floor(sum(tokens) OVER () * 0.9) AS budget FROM shares CROSS JOIN t5),
sources AS (
  SELECT source, blocks, weight, floor(weight * budget)::BIGINT // tokens AS full_passes,
         floor(weight * budget)::BIGINT % tokens AS rest FROM weights),
epochs AS (
  SELECT *, md5('0:' || epoch || ':' || id) AS key
  FROM (SELECT *, unnest(range(0, full_passes + 1)) AS epoch
        FROM narrow JOIN sources ON narrow.source IS NOT DISTINCT FROM sources.source)),
dealt AS (SELECT *, {hex} % blocks AS block FROM epochs),
running AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY block, key, doc_id, n_tokens) AS so_far FROM dealt)
SELECT doc_id, source, n_tokens, weight, epoch, block,
       row_number() OVER (PARTITION BY source, epoch, block ORDER BY key, doc_id, n_tokens)::INTEGER AS place
FROM running WHERE epoch < full_passes OR (rest > 0 AND so_far <= rest)
""".replace("{hex}", _HEX.format(key="key"))


@query("op2_temperature_mixing", MIX_SQL)
def temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents"), **MIX)


HAMMING_SQL = """
WITH codes AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x > 0) AS code FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT DISTINCT q.vec_id AS query_id, c.vec_id, len(list_filter(list_zip(q.code, c.code), lambda p: p[1] <> p[2])) AS distance
  FROM codes q JOIN codes c ON len(q.code) = len(c.code) AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, distance FROM pairs
WINDOW best AS (PARTITION BY query_id ORDER BY distance, vec_id) QUALIFY row_number() OVER best <= 10
"""


@query("op7_hamming_topk", HAMMING_SQL)
def hamming_topk(spark: SparkSession, folder: str) -> DataFrame:
    return hamming.search(read(spark, folder, "embeddings"))


VECTOR_SQL = """
WITH RECURSIVE numbered AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, row_number() OVER () AS n FROM embeddings),
usable AS (
  SELECT * FROM numbered WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x <> 0)) > 0
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.n, b.n AS m FROM usable a JOIN usable b ON a.label = b.label AND a.n <> b.n AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(n, m) AS (SELECT n, n FROM numbered UNION SELECT r.n, l.m FROM reach r JOIN links l ON l.n = r.m),
roots AS (SELECT r.n, min(y.vec_id) AS component_id FROM reach r JOIN numbered y ON y.n = r.m GROUP BY r.n),
degrees AS (SELECT n, count(*) AS n_links FROM links GROUP BY n)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM numbered JOIN roots USING (n) LEFT JOIN degrees USING (n)
"""


@query("op10_product_quantisation", VECTOR_SQL)
def product_quantisation(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_duplicates(read(spark, folder, "embeddings"))


@query("op11_balanced_lists")
def balanced_lists(spark: SparkSession, folder: str) -> DataFrame:
    return posting_lists.search(read(spark, folder, "embeddings"))


AUDIT_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
least AS (SELECT text, min(doc_id) AS low FROM docs GROUP BY text),
marks AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
          FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(docs.doc_id > low, false)::INT AS mask
  FROM docs JOIN least USING (text) LEFT JOIN marks ON marks.doc_id = docs.doc_id),
counts AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
           FROM masks GROUP BY part, mask),
letter(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit <> b.bit AND a.bit <> c.bit AND a.bit <> d.bit
    AND a.bit <> e.bit AND b.bit <> c.bit AND b.bit <> d.bit AND b.bit <> e.bit AND c.bit <> d.bit AND c.bit <> e.bit
    AND d.bit <> e.bit),
steps AS (
  SELECT filter_order, step, letter.bit AS own,
         coalesce((SELECT sum(x.bit) FROM letter x WHERE strpos(filter_order, x.l) < step), 0)::INT AS earlier
  FROM orders, (SELECT unnest(range(1, 6))::INT AS step) JOIN letter ON letter.l = substr(filter_order, step, 1))
SELECT part, filter_order, step,
       coalesce(sum(n) FILTER (mask & (own | earlier) = 0), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (mask & own > 0 AND mask & earlier = 0), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (mask & own > 0 AND mask & earlier > 0), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (mask & own > 0 AND mask & earlier = 0), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER (mask & own > 0 AND mask & earlier = 0), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * 120 // greatest(bit_count(mask), 1)) FILTER (mask & own > 0), 0)::BIGINT AS shapley
FROM counts CROSS JOIN steps GROUP BY part, filter_order, step
"""


@query("op12_filter_audit", AUDIT_SQL)
def filter_audit_query(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(read(spark, folder, "documents"), read(spark, folder, "labels"))


_TURN_KEY = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
REPAIR_SQL = r"""
WITH RECURSIVE marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS kind FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM marked WHERE kind <> 0),
ordered AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n,
         regexp_extract(text, '(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last FROM damaged),
judged AS (
  SELECT conv_id, turn, role, text, n, substr(role, 1, 1) AS initial,
         CASE WHEN last = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
              WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(role) OVER (PARTITION BY conv_id ORDER BY n) AS earlier FROM ordered),
totals AS (
  SELECT conv_id, count(*) AS rows_left, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (earlier IS NOT NULL AND substr(earlier, 1, 1) || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
moves(state, initial, state_to) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
inserted(state, state_in, ins) AS (
  VALUES (0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (0, 2, 1), (1, 2, 1), (3, 2, 1), (2, 3, 1),
         (0, 3, 2), (1, 3, 2), (3, 3, 2), (2, 2, 2)),
names AS (SELECT row_number() OVER () AS c, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
numbered AS (SELECT c, j.* FROM judged j JOIN names ON j.conv_id IS NOT DISTINCT FROM names.conv_id),
paths(c, n, state, cost, audit, repaired) AS (
  SELECT c, 0::BIGINT, 0, 0, '', '' FROM names
  UNION ALL
  SELECT c, n, state, (best).cost, (best).audit, (best).repaired
  FROM (
    SELECT c, n, state, min({'cost': cost, 'audit': audit, 'repaired': repaired}) AS best
    FROM (
      SELECT p.c, r.n, e.state_to AS state,
             p.cost + 3 * i.ins + e.price + CASE WHEN r.fault = 'truncated' AND e.edit <> 'D' THEN 3 ELSE 0 END AS cost,
             p.audit || repeat('I', i.ins) || e.edit AS audit,
             p.repaired || CASE i.ins WHEN 0 THEN '' WHEN 1 THEN CASE p.state WHEN 2 THEN chr(10) || 'assistant:'
                                                            ELSE chr(10) || 'user:' END
                           ELSE CASE p.state WHEN 2 THEN chr(10) || 'assistant:' || chr(10) || 'user:'
                                ELSE chr(10) || 'user:' || chr(10) || 'assistant:' END END
                        || CASE e.edit WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || r.role || ':' || r.text
                           ELSE chr(10) || CASE i.state_in WHEN 2 THEN 'assistant:' ELSE 'user:' END || r.text END AS repaired
      FROM paths p JOIN numbered r ON r.c = p.c AND r.n = p.n + 1 JOIN inserted i ON i.state = p.state
      JOIN (SELECT state, initial, 'K' AS edit, 0 AS price, state_to FROM moves
            UNION ALL SELECT DISTINCT state, NULL, 'R', 3, CASE state WHEN 2 THEN 3 ELSE 2 END FROM inserted
            UNION ALL SELECT DISTINCT state, NULL, 'D', 4, state FROM inserted) e
        ON e.state = i.state_in AND (e.initial IS NULL OR e.initial = r.initial)
           AND (e.edit = 'D' OR r.fault NOT IN ('blank', 'duplicate')))
    GROUP BY c, n, state)),
ended AS (
  SELECT c, min({'cost': p.cost + CASE p.state WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END,
                 'audit': p.audit || CASE p.state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
                 'repaired': p.repaired || CASE p.state WHEN 1 THEN chr(10) || 'user:' || chr(10) || 'assistant:'
                                           WHEN 2 THEN chr(10) || 'assistant:' ELSE '' END}) AS best
  FROM paths p JOIN names USING (c) LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM names.conv_id
  WHERE p.n = coalesce(rows_left, 0) GROUP BY c)
SELECT names.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, (best).cost::BIGINT AS cost, (best).audit AS audit,
       sha256(substr((best).repaired, 2)) AS repaired_sha256
FROM names JOIN ended USING (c) LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM names.conv_id
""".replace("{crc}", CRC_SQL.replace("coalesce(doc_id::VARCHAR, 'null')", _TURN_KEY))


@query("op13_conversation_repair", REPAIR_SQL)
def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair(read(spark, folder, "conversations"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
