"""Token counts from pre-token frequencies.

A worker counts the pieces of each distinct pre-token it meets once, in a bounded table, looks the count up at every
place of its documents and sums. No token ids of documents come into being. There is no table of all distinct pre-tokens and
no join: joining one to all documents' frequencies would shuffle more than the texts weigh.

Special strings inside texts are ordinary text, as they are for the sentencepiece library.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.pretokens import piece_encoder, spaced_words
from tidewheel.llm.text import blocks, joined


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every text, and whether the tokens exceed `limit`.

    One row per row of `docs`, repeated rows and null ids included; other columns are dropped, so their names cannot
    clash. A null text counts as empty: 0 bytes and 0 tokens. Texts of any length are counted whole. An empty table has no
    rows.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def count(batches):
        encoder = piece_encoder(model_path)
        for batch in blocks(batches):
            texts = batch.column("text")
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            marked = pc.replace_substring(texts, "▁", " ") if pc.any(pc.match_substring(texts, "▁")).as_py() else texts
            block = joined(marked, before=b" ")
            start, end = spaced_words(block)
            entries = encoder.look_up(block.data, start, end)
            pieces = encoder.length[entries].astype(np.int64)
            first = np.searchsorted(start, block.offsets)
            total = np.concatenate([[0], np.cumsum(pieces)])
            tokens = np.where(sizes.to_numpy() > 0, total[first[1:]] - total[first[:-1]], 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), sizes, pa.array(tokens), pa.array(tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return narrow.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
