"""Token counts of whole texts, huge ones by overlap resynchronisation.

A text of up to ``chunk`` code points is encoded in one piece. A longer one is cut into chunks that overlap their
neighbours by ``overlap`` code points on either side of each cut; chunks are encoded wherever Spark puts them, and each
reports its number of tokens and, near its cuts, the offsets at which tokens end. Neighbours are spliced where both
have the same two token ends s < p: tokens up to p are taken from the left chunk, later ones from the right.

That splice is the encoding of the whole text. Byte-pair merges only ever remove boundaries, best pair first, leftmost
of equals. No merge crossed s or p in either chunk, so between s and p both merged the same characters in the same
order. In the whole text, what lies left of s meets the same neighbours as in the left chunk and what lies right of p
the same as in the right chunk; the first merge to cross s or p would have been the best one there in that chunk, too.
Ends that only the edge of a chunk makes do not count, nor do those inside the bytes of one character.

Where two neighbours share fewer than two such ends, the whole text is cut anew with overlaps four times as wide, until
all cuts hold or the text is one chunk.

Cases: a null or empty text has no bytes and no tokens. Texts that repeat are chunked and encoded once. Empty table:
empty result. Output columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import without, written
from tidemark.llm.pieces import BYTE, default_path, read_pieces

CHUNK, OVERLAP, WIDEN, LIMIT = 1 << 15, 128, 4, 4096
#: Code points of the blocks that huge texts are cut into before they are cut into chunks.
_BLOCK = 1 << 20
_NAMES = ("n_bytes", "n_tokens", "over_limit")


class Encoder:
    """The library's encoder with the code points that each token stands for."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = read_pieces(path)
        self.lengths = np.zeros(len(pieces), np.int64)
        self.follows = np.zeros(len(pieces), bool)  # bytes inside a character
        for i, (piece, _, kind) in enumerate(pieces):
            self.follows[i] = kind == BYTE and 0x80 <= int(piece[3:5], 16) < 0xC0
            self.lengths[i] = 0 if self.follows[i] else 1 if kind == BYTE else len(piece)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.library.encode(texts, num_threads=1)]

    def ends(self, text: str) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of tokens; the offsets in ``text``, its two edges left out, where a token ends and another begins;
        and the number of tokens up to each."""
        ids = np.array(self.library.encode(text), np.int64)
        ends = np.cumsum(self.lengths[ids]) - 1  # the library puts one mark in front
        if len(ids) and ends[-1] != len(text):
            raise ValueError("the model's pieces do not spell out the text; offsets cannot be told")
        last = np.append(~self.follows[ids[1:]], True)
        inside = np.flatnonzero(last & (ends > 0) & (ends < len(text)))
        return len(ids), ends[inside], inside + 1


_loaded: dict[str, Encoder] = {}


def loaded(path: str) -> Encoder:
    """One encoder for each worker process."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def _chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(digest, i, start, last, part): the overlapping chunks of ``texts`` (digest, body), one row for each of a text."""
    per_block = max(1, _BLOCK // chunk)
    block = per_block * chunk

    def numbers(size: Column, width: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.floor((size - 1) / width).cast("int")))

    def cut(text: str, start: Column, end: Column) -> Column:
        return F.substring(F.col(text), (start + 1).cast("int"), (end - start).cast("int"))

    size, first = F.col("size"), F.greatest(F.col("b").cast("bigint") * block - overlap, F.lit(0))
    blocks = texts.select("digest", "body", F.char_length("body").alias("size")).select("*", numbers(size, block).alias("b")).select(
        "digest", "size", "b", first.alias("first"), cut("body", first, (F.col("b") + 1).cast("bigint") * block + overlap).alias("body")
    )
    here = F.least(size - F.col("b").cast("bigint") * block, F.lit(block))
    i = F.col("b").cast("bigint") * per_block + F.col("c")
    start = F.greatest(i * chunk - overlap, F.lit(0))
    rows = blocks.select("*", numbers(here, chunk).alias("c")).select(
        "digest", i.alias("i"), start.alias("start"), ((i + 1) * chunk >= size).alias("last"),
        cut("body", start - F.col("first"), (i + 1) * chunk + overlap - F.col("first")).alias("part"),
    )
    # Chunks of copies meet here, after one row of each is left in every task; the exchange deals chunks out for encoding.
    return rows.groupBy("digest", "i").agg(*(F.first(c).alias(c) for c in ("start", "last", "part")))


def _encoded(chunks: DataFrame, path: str, overlap: int) -> DataFrame:
    """(digest, i, last, n, head, tail): tokens of each chunk and, as (end, tokens up to it), the token ends in the
    overlaps with the chunk before and the chunk after."""
    near = pa.list_(pa.struct([("end", pa.int64()), ("at", pa.int64())]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(path)
        for batch in batches:
            found: list[list] = [[], [], []]
            for start, last, part in zip(*(batch.column(c) for c in ("start", "last", "part"))):
                start, part = start.as_py(), part.as_py()
                n, ends, at = encoder.ends(part)
                head = ends <= (2 * overlap if start else -1)
                tail = ends >= (len(part) + 1 if last.as_py() else len(part) - 2 * overlap)
                found[0].append(n)
                for out, some in zip(found[1:], (head, tail)):
                    out.append([{"end": e, "at": a} for e, a in zip((ends[some] + start).tolist(), at[some].tolist())])
            columns = [batch.column(c) for c in ("digest", "i", "last")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found[0], pa.int64()), pa.array(found[1], near), pa.array(found[2], near)], names=["digest", "i", "last", "n", "head", "tail"]
            )

    ends = "array<struct<end: bigint, at: bigint>>"
    return chunks.mapInArrow(encode, f"digest string, i bigint, last boolean, n bigint, head {ends}, tail {ends}")


def _spliced(encoded: DataFrame) -> DataFrame:
    """(digest, n_tokens): the tokens of each text, null where two neighbours do not share two token ends."""
    in_order = Window.partitionBy("digest").orderBy("i")
    # Arrays are in the order of the text, and so is their intersection.
    shared = F.array_intersect("tail.end", F.lead("head.end").over(in_order))
    placed = encoded.select("*", F.try_element_at(shared, F.lit(2)).alias("p")).select("*", F.lag("p").over(in_order).alias("before"))

    def tokens_to(ends: str, p: str) -> Column:
        return F.get(F.filter(ends, lambda e: e["end"] == F.col(p)), F.lit(0))["at"]

    until = F.when(F.col("last"), F.col("n")).otherwise(tokens_to("tail", "p"))
    skipped = F.when(F.col("i") == 0, F.lit(0)).otherwise(tokens_to("head", "before"))
    whole = F.every(F.col("last") | F.col("p").isNotNull())
    return placed.select("digest", "last", "p", F.when(F.col("last") | F.col("p").isNotNull(), until - skipped).alias("own")).groupBy("digest").agg(
        F.when(whole, F.sum("own")).alias("n_tokens")
    )


def huge_counts(texts: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[DataFrame, int]:
    """(digest, n_tokens) for ``texts`` (digest, body), and the number of rounds it took. The driver sees counts only."""
    done, rounds, rest = None, 0, texts
    while True:
        found = written(_spliced(_encoded(_chunks(rest, chunk, overlap), path, overlap)), "token-counts")
        held = found.where("n_tokens is not null")
        done = held if done is None else done.union(held)
        rounds += 1
        failed = found.where("n_tokens is null").select("digest")
        if failed.isEmpty():
            return done, rounds
        overlap *= WIDEN
        chunk, rest = max(chunk, 4 * overlap), texts.join(failed, "digest", "left_semi")


def count_tokens(docs: DataFrame, model_path: str | None = None, text: str = "text", limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens (as the library encodes the whole text) and over_limit."""
    if not 0 < 2 * overlap < chunk:
        raise ValueError("a chunk must be longer than its two overlaps")
    path, body = model_path or default_path(), F.coalesce(F.col(f"`{text}`"), F.lit(""))

    @F.arrow_udf("bigint")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = loaded(path)
        for batch in batches:
            yield pa.array(encoder.counts(batch.to_pylist()), pa.int64())

    others = without(docs, *_NAMES)
    titles = [c for c in docs.columns if c.lower() not in _NAMES]
    names = [f"c{k}" for k in range(len(others))]
    n_bytes, is_huge = F.octet_length(body).cast("bigint").alias("n_bytes"), F.char_length(body) > chunk
    plain = [c.alias(n) for c, n in zip(others, names)]
    small = docs.where(~is_huge).select(*plain, n_bytes, counted(body).alias("n_tokens"))
    digest = F.sha2(body.cast("binary"), 256).alias("digest")
    huge = docs.where(is_huge)
    by_text, _ = huge_counts(huge.select(digest, body.alias("body")), path, chunk, overlap)
    joined = huge.select(*plain, n_bytes, digest).join(by_text, "digest").select(*names, "n_bytes", "n_tokens")
    return small.union(joined).select(
        *(F.col(n).alias(t) for n, t in zip(names, titles)), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
