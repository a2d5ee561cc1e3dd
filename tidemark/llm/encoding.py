"""SentencePiece ids of whole texts, and texts of ids, as columns (``pieces`` has the method).

Cases: a null or empty text has no ids and decodes to the empty text. Texts of any length are encoded whole. Ids that
the model does not have are an error. Rows that repeat are encoded each. Empty table: empty result. Output columns
replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import pieces
from tidemark.llm.common import without


def encode(docs: DataFrame, model_path: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ids (decimal numbers joined by commas), n_tokens, and decoded, the text made of the ids again."""
    path = model_path or pieces.default_path()

    @F.arrow_udf("ids string, n_tokens bigint, decoded string")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = pieces.loaded(path)
        for batch in batches:
            ids, decoded, counts = [], [], []
            for value in batch:
                i, d, n = model.encode_text(value.as_py() or "")
                ids.append(i), decoded.append(d), counts.append(n)
            yield pa.StructArray.from_arrays([pa.array(ids, pa.string()), pa.array(counts, pa.int64()), pa.array(decoded, pa.string())], names=["ids", "n_tokens", "decoded"])

    names = ("ids", "n_tokens", "decoded")
    done = docs.select("*", encoded(F.col(f"`{text}`")).alias("__encoded"))
    return done.select(*without(docs, *names), *(F.col(f"__encoded.{n}").alias(n) for n in names))


def decode(rows: DataFrame, model_path: str | None = None, ids: str = "ids") -> DataFrame:
    """``rows`` with text, decoded from a column of ids joined by commas."""
    path = model_path or pieces.default_path()

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = pieces.loaded(path)
        for batch in batches:
            yield pa.array([model.decode([int(i) for i in value.split(",") if i]) for value in pc.fill_null(batch, "").to_pylist()], pa.string())

    done = rows.select("*", decoded(F.col(f"`{ids}`")).alias("__decoded"))
    return done.select(*without(rows, "text"), F.col("__decoded").alias("text"))


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and decoded text."""
    return encoded.select(
        "doc_id", "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )
