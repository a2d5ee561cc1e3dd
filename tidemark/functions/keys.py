from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType

from tidemark.functions.text import _column


def surrogate_key(*parts) -> Column:
    """md5 over the parts joined by ``_``. A NULL part makes the key NULL, which ``concat_ws`` would not."""
    return F.md5(_joined(parts))


def plain_key(*parts) -> Column:
    """The same key before md5 is taken, as bytes that ``unpacked`` makes the surrogate key of. What is stored and moved are then
    the natural keys, which compress; digests do not. All frames that meet on a key must hold it in one form."""
    text = _joined(parts).cast("binary")
    # Sixteen bytes are an md5, so a plain key that would have as many gets one more.
    return F.concat(F.when(F.length(text) == 15, F.lit(_PLAIN_15)).otherwise(F.lit(_PLAIN)), text)


def _joined(parts) -> Column:
    texts: list[Column] = []
    for part in parts:
        if texts:
            texts.append(F.lit("_"))
        texts.append(_column(part).cast("string"))
    return F.concat(*texts)


def row_digest(*columns) -> Column:
    """md5 of a whole row; NULL and empty text give different digests."""
    marked = [
        F.coalesce(F.concat(F.lit("="), _column(c).cast("string")), F.lit("~")) for c in columns
    ]
    return F.md5(F.concat_ws("|", *marked))


_OTHER = b"\0" * 17  # before any key that is no md5 text, so that its packed form is longer than 16 bytes
_PLAIN, _PLAIN_15 = b"\1", b"\2\1"  # before a plain key


def packed(df: DataFrame) -> DataFrame:
    """Surrogate keys in half their bytes, for exchanges: md5 text as its 16 bytes, any other text as longer bytes, and no two
    texts alike. ``unpacked`` gives the texts back; columns that are packed already, and plain keys, stay so."""
    return _rewritten(df, StringType, _pack)


def unpacked(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """With ``schema`` only the keys that are text in it."""
    texts = [f.name for f in (schema or df.schema).fields if isinstance(f.dataType, StringType if schema else BinaryType)]
    return _rewritten(df, BinaryType, _unpack, texts)


def _rewritten(df: DataFrame, kind: type, rewrite, among: list[str] | None = None) -> DataFrame:
    keys = [f.name for f in df.schema.fields if f.name.endswith("_sk") and isinstance(f.dataType, kind) and (among is None or f.name in among)]
    return df.withColumns({c: rewrite(F.col(f"`{c}`")) for c in keys}) if keys else df


def _pack(key: Column) -> Column:
    raw = F.unhex(key)
    return F.when((F.length(key) == 32) & (F.lower(F.hex(raw)) == key), raw).otherwise(F.concat(F.lit(_OTHER), key.cast("binary")))


def _unpack(key: Column) -> Column:
    def rest(prefix: bytes) -> Column:
        return F.substring(key, len(prefix) + 1, 2**31 - 1)

    unpacks = F.when(F.length(key) == 16, F.lower(F.hex(key)))
    for prefix in (_PLAIN, _PLAIN_15):
        unpacks = unpacks.when(F.substring(key, 1, len(prefix)) == F.lit(prefix), F.md5(rest(prefix)))
    return unpacks.otherwise(rest(_OTHER).cast("string"))
