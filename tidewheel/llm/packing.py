"""Best-fit packing of documents into sequences under several capacities.

Every document becomes its ids and an end id; documents longer than a sequence are cut into full pieces behind one
shorter first piece. Full pieces are sequences of their own. The others are packed, largest first: a sequence is open
while it has tokens, documents and attention cost (the sum of squared lengths) left, and a piece goes to that open
sequence, fitting under all three, whose residual capacities have the least weighted norm once the piece is in, or
the largest weighted dot-product with the piece's demands.

Ids come from the byte-level vocabulary. Documents whose characters are all ASCII or Latin letters are cut by byte
tables and looked up by distinct pre-token, in the rank form of the same vocabulary; all others, and those which hold
a special string, go whole through the tokenizers library. Both ways give the same ids.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.pretokens import byte_encoder, byte_level, library_tokenizer, odd_documents
from tidewheel.llm.text import blocks, joined
from tidewheel.session import materialize

GROUP_PIECES = 16_384  # pieces packed together by one call; what a group wastes is about one open sequence


def tokenized(docs: DataFrame, tokenizer: str, ranks: str, pattern: str, size: int, end_id: int,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, slot (a number of the row), n_ids with the end id, and the CRC-32 of each piece."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def tokens(batches):
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = byte_encoder(ranks, pattern)
        whole = library_tokenizer(tokenizer)
        special = [t.content for t in whole.get_added_tokens_decoder().values()]
        slot = TaskContext.get().partitionId() << 33
        for batch in blocks(batches):
            texts = pc.fill_null(batch.column("text"), "")
            block = joined(texts)
            odd = set(odd_documents(block).tolist())
            for mark in special:
                odd.update(np.flatnonzero(pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)).tolist())
            start, end = byte_level(block)
            ids, first = encoder.expand(encoder.look_up(block.data, start, end))
            at = first[np.searchsorted(start, block.offsets)]
            sizes, sums = [], []
            for d in range(len(texts)):
                own = ids[at[d]:at[d + 1]]
                if d in odd:
                    own = np.array(whole.encode(texts[d].as_py(), add_special_tokens=False).ids, np.uint32)
                own = np.append(own, np.uint32(end_id)).astype("<u4")
                cuts = [0, *range(len(own) % size or size, len(own) + 1, size)]
                sizes.append(len(own))
                sums.append([zlib.crc32(own[a:b]) for a, b in zip(cuts, cuts[1:])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.arange(slot, slot + len(sizes))), pa.array(sizes, pa.int64()),
                 pa.array(sums, pa.list_(pa.int64()))], ["doc_id", "slot", "n_ids", "crcs"])
            slot += len(sizes)

    return narrow.mapInArrow(tokens, "doc_id long, slot long, n_ids long, crcs array<long>")


def best_fit(lengths: np.ndarray, capacity: tuple[int, int, int], weights: tuple[float, float, float],
             rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of each piece. `lengths` must be in descending order."""
    limits = np.array(capacity, float)
    weight = np.array(weights, float)
    room = 1024
    left = np.zeros((room, 3))  # residual shares of the open sequences
    tokens = np.zeros(room, np.int64)
    name = np.zeros(room, np.int64)
    used, made = 0, 0
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    least = int(lengths[-1]) if len(lengths) else 0
    tiny = 1e-9
    for i, n in enumerate(lengths.tolist()):
        need = np.array([n, 1, n * n]) / limits
        rest = left[:used] - need
        fits = np.flatnonzero((rest > -tiny).all(axis=1))
        if len(fits):
            if rule == "norm":
                best = fits[np.argmin((rest[fits] ** 2) @ weight)]
            else:
                best = fits[np.argmax(left[:used][fits] @ (weight * need))]
        else:
            if used == room:
                left, tokens, name = (np.concatenate([x, np.zeros_like(x)]) for x in (left, tokens, name))
                room *= 2
            best, used = used, used + 1
            left[best], tokens[best], name[best] = 1.0, 0, made
            made += 1
        bins[i], offsets[i] = name[best], tokens[best]
        left[best] -= need
        tokens[best] += n
        if capacity[0] - tokens[best] < least or left[best].min() <= tiny:  # nothing can follow
            used -= 1
            left[best], tokens[best], name[best] = left[used], tokens[used], name[used]
    return bins, offsets


def pack(docs: DataFrame, tokenizer: str, ranks: str, pattern: str, size: int = 1024, end_id: int = 2,
         max_documents: int | None = None, max_attention: int | None = None,
         weights: tuple[float, float, float] = (1.0, 0.05, 0.05), rule: str = "norm", id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most `size` tokens; one row per piece.

    `max_documents` and `max_attention` bound the documents of a sequence and the sum of its squared piece lengths; by
    default they are `size` and its square, which no sequence can exceed. A bound below one full piece is an error.

    A null or empty text is a document of the end id alone. Every row is a document of its own, so repeated rows and
    null ids are packed as often as they occur; ties fall to the sequence opened first. Long texts are cut, never
    shortened. Columns other than id and text play no part.
    """
    most = (size, max_documents or size, max_attention or size * size)
    if most[2] < size * size or most[1] < 1:
        raise ValueError("a full piece must fit into a sequence")
    if rule not in ("norm", "dot"):
        raise ValueError("rule is norm or dot")
    table = materialize(tokenized(docs, tokenizer, ranks, pattern, size, end_id, id_col, text_col), "tokenized")
    groups = -(-table.count() // GROUP_PIECES) or 1

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("slot", ignore_index=True)
        total = rows["n_ids"].to_numpy()
        head = (total - 1) % size + 1  # the first piece
        count = (total - 1) // size + 1
        doc = np.repeat(np.arange(len(rows)), count)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        length = np.where(piece == 0, head[doc], size)
        start = np.where(piece == 0, 0, head[doc] + (piece - 1) * size)
        small = np.flatnonzero(length < size)
        small = small[np.argsort(-length[small], kind="stable")]
        sequence, offset = np.empty(len(doc), np.int64), np.zeros(len(doc), np.int64)
        sequence[small], offset[small] = best_fit(length[small], most, weights, rule)
        full = np.flatnonzero(length == size)
        sequence[full] = len(small) + np.arange(len(full))
        group = int(rows["pack"].iloc[0]) if len(rows) else 0
        return pd.DataFrame({
            "doc_id": rows["doc_id"].array[doc], "piece": piece.astype(np.int32), "start": start, "length": length,
            "ids_crc32": np.concatenate(rows["crcs"].tolist()).astype(np.int64), "sequence_id": (group << 32) + sequence,
            "offset": offset})

    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    dealt = table.withColumn("pack", F.pmod(F.xxhash64("slot"), F.lit(groups)))
    return dealt.groupBy("pack").applyInPandas(place, schema)
