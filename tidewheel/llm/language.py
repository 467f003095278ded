"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from the letter's number alone. A letter with its two neighbours
in the same word (or the word's edge) is a trigram; its vector binds the three letters' vectors, each rolled by its
place, by multiplication. A document's vector bundles, that is sums, those of its trigrams; a language's prototype
bundles all its training documents. A document's language is the prototype with the largest cosine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.text import blocks, mix, release
from tidewheel.session import materialize

DIMENSIONS = 1024
SYMBOLS = 1 << 13  # letters share a vector when their code points agree modulo this; 0 is the edge of a word
BLOCK = 1 << 20
MAX_LANGUAGES = 4096

_U = np.uint64
_tables: dict = {}


def _letters() -> np.ndarray:
    """The symbol of every code point: 0 for what is no letter."""
    if "letters" not in _tables:
        points = np.arange(0x110000)
        is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        _tables["letters"] = np.where(is_letter, points % (SYMBOLS - 1) + 1, 0).astype(np.int32)
    return _tables["letters"]


def letter_vectors(symbols: np.ndarray, dimensions: int) -> np.ndarray:
    """Rows of +1 and -1, one for each symbol."""
    columns = np.arange(-(-dimensions // 64), dtype=_U)
    seed = mix((symbols.astype(_U)[:, None] + _U(1)) * _U(0x9E3779B97F4A7C15) + columns * _U(0xD1B54A32D192ED03))
    bits = np.unpackbits(mix(seed).astype("<u8").view(np.uint8), axis=1)[:, :dimensions]
    return (bits.astype(np.int8) << 1) - 1


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The three symbols of all documents' trigrams, as rows, and where each document's begin; one for each letter."""
    lower = [(t or "").lower() for t in texts]
    whole = "\n".join(["", *lower, ""])
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    symbol = _letters()[points]
    at = np.flatnonzero(symbol)
    first = np.searchsorted(at, np.cumsum([1, *[len(t) + 1 for t in lower]]))
    return np.stack([symbol[at - 1], symbol[at], symbol[at + 1]]), first


def numbered(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigrams, as rows of three symbols, and which of them each trigram is."""
    symbols = np.flatnonzero(np.bincount(grams.ravel(), minlength=SYMBOLS))
    place = np.zeros(SYMBOLS, np.int64)
    place[symbols] = np.arange(len(symbols))
    n = len(symbols)
    code = (place[grams[0]] * n + place[grams[1]]) * n + place[grams[2]]
    if n ** 3 <= 1 << 22:
        distinct = np.flatnonzero(np.bincount(code, minlength=1))
        back = np.zeros(n ** 3, np.int64)
        back[distinct] = np.arange(len(distinct))
        back = back[code]
    else:
        distinct, back = np.unique(code, return_inverse=True)
    n = max(n, 1)
    return symbols[np.stack([distinct // (n * n), distinct // n % n, distinct % n], axis=1)], back


def trigram_vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    symbols, back = np.unique(grams, return_inverse=True)
    base, back = letter_vectors(symbols, dimensions), back.reshape(grams.shape)
    return (np.roll(base, 2, axis=1)[back[:, 0]] * np.roll(base, 1, axis=1)[back[:, 1]]
            * base[back[:, 2]]).astype(np.float32)


def bundles(grams: np.ndarray, row: np.ndarray, rows: int, dimensions: int) -> np.ndarray:
    """The sum of the vectors of all trigrams of each row."""
    distinct, back = numbered(grams)
    out = np.zeros((rows, dimensions), np.float32)
    width = max(1, (1 << 23) // max(rows, 1))
    for a in range(0, len(distinct), width):  # the counts of a block of very many distinct trigrams in slices
        b = min(a + width, len(distinct))
        inside = slice(None) if width >= len(distinct) else (back >= a) & (back < b)
        counts = np.bincount(row[inside] * (b - a) + back[inside] - a, minlength=rows * (b - a))
        out += counts.reshape(rows, b - a).astype(np.float32) @ trigram_vectors(distinct[a:b], dimensions)
    return out


def fit(docs: DataFrame, dimensions: int = DIMENSIONS, text_col: str = "text",
        lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages in order and their prototypes, from all rows that have a text and a language.

    Each task sums its own documents, so that what is shuffled and collected is a vector per task and language, then
    one per language.
    """
    labelled = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    labelled = labelled.where("text is not null and lang is not null")

    def sums(batches):
        total: dict[str, np.ndarray] = {}
        release()
        for batch in blocks(batches, limit=BLOCK):
            grams, first = trigrams(batch.column("text").to_pylist())
            names = batch.column("lang").to_pylist()
            own = {name: i for i, name in enumerate(sorted(set(names)))}
            row = np.repeat([own[name] for name in names], np.diff(first))
            for name, vector in zip(own, bundles(grams, row, len(own), dimensions)):
                total[name] = total.get(name, 0) + vector.astype(np.int64)
        for name, vector in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(vector)],
                ["lang", "place", "total"])

    parts = labelled.mapInArrow(sums, "lang string, place int, total long")
    rows = (parts.groupBy("lang", "place").agg(F.sum("total").alias("total"))
            .limit(MAX_LANGUAGES * dimensions + 1).collect())
    if len(rows) > MAX_LANGUAGES * dimensions:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted({r.lang for r in rows})
    prototypes = np.zeros((len(languages), dimensions))
    index = {name: i for i, name in enumerate(languages)}
    for r in rows:
        prototypes[index[r.lang], r.place] = r.total
    norms = np.linalg.norm(prototypes, axis=1, keepdims=True)
    return languages, prototypes / np.where(norms > 0, norms, 1)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from; a null id counts as the text `null`."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % 4 == 2


def annotate(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str, pred: str, score: str) -> DataFrame:
    """`docs` with two more columns, the predicted language and its score."""
    languages, prototypes = model
    dimensions = prototypes.shape[1]
    names = [*languages, "und"]

    def compare(batches):
        release()
        for batch in blocks(batches, text_col, BLOCK):
            grams, first = trigrams(batch.column(text_col).to_pylist())
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            vectors = bundles(grams, row, batch.num_rows, dimensions).astype(np.float64)
            norms = np.linalg.norm(vectors, axis=1)
            known = (norms > 0) & (len(languages) > 0)
            cosine = vectors @ prototypes.T if len(languages) else np.zeros((len(vectors), 1))
            cosine /= np.where(norms > 0, norms, 1)[:, None]
            best = np.where(known, cosine.argmax(axis=1), len(languages))
            top = np.where(known, np.clip(cosine.max(axis=1), 0, 1), 0.0)
            yield batch.append_column(pred, pa.array([names[i] for i in best.tolist()], pa.string())).append_column(
                score, pa.array(top))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(compare, f"{fields}, `{pred}` string, `{score}` double")


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred and score, the largest cosine, not below 0.

    `und` with score 0 where the text is null or has no letter, or where nothing was learned. Of equal cosines the
    first language by name wins. Whole texts count; repeated rows are predicted alike. Other columns are dropped; an
    empty table has no rows.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return annotate(narrow, model, "text", "lang_pred", "score").select("doc_id", "lang_pred", "score")


def identify(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """Learn from the documents that are not held out, predict all: doc_id, held_out, lang_pred, score."""
    model = fit(docs.where(~held_out(F.col("doc_id"))), dimensions)
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, dimensions: int = DIMENSIONS, deviations: float = 2.0) -> DataFrame:
    """`docs`, with all its columns, without the rows that resemble no language.

    Unrelated vectors have cosines around 0 with a standard deviation of 1 / sqrt(dimensions). A row stays when its best
    cosine is above `deviations` of those; so texts that are null or have no letter go, and texts in letters or words
    that no learned language has. Of one text all rows stay or go, also without an id. Where no row has a language to learn
    from, nothing can be told and every row stays.
    """
    model = fit(docs.where(~held_out(F.col("doc_id"))), dimensions)
    if not model[0]:
        return docs
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    judged = annotate(plain, model, f"c{docs.columns.index('text')}", "lang_pred", "score")
    least = deviations / dimensions ** 0.5
    kept = judged.where((F.col("lang_pred") != "und") & (F.col("score") > least)).drop("lang_pred", "score")
    return materialize(kept, "identified").toDF(*docs.columns)  # written here, in small Arrow batches
