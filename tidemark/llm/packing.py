"""Hierarchical packing of token ids into sequences of several lengths.

A document's ids (with the end id) give as many full windows of the longest tier as they hold; the rest is routed to
the shortest tier that holds it. Tiers are packed from the longest down: a window opens with the longest rest of its
tier, and its gap is filled with the longest fitting rests of shorter tiers, at last with the head of one that is
cut. So every window is exactly as long as its tier. What is left at the end of a packing unit is cut into windows of
powers of two. Nothing is padded.

A unit is a run of documents of one input partition with about ``unit_tokens`` tokens: units are independent, memory is
bounded by one unit (or one document), no row is shuffled, and a lost task is repeated with the same result. Each
unit's sequences are dealt to step groups of one tier: every group has the same number of tokens, and attention costs
(squares of the piece lengths) are balanced by dealing from costly to cheap, back and forth.

Cases: a null or empty text is the end id alone. A text of any length is cut into windows. Rows that repeat are packed
each. Empty table: empty result. Other columns of the input are not carried; the pieces name doc_id only, null or not.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe

TIERS, END_ID = (256, 512, 1024, 2048), 1
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "tier int, step_group bigint"
)
_ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [("tier", pa.int32()), ("step_group", pa.int64())])


def pack_unit(sizes: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length), for documents of the given numbers of tokens."""
    longest, sequences = tiers[-1], []
    rests: list[tuple[int, int, int]] = []  # (length, document, start), ascending
    for doc, size in enumerate(sizes):
        full = size // longest * longest
        sequences += [[(doc, at, longest)] for at in range(0, full, longest)]
        if size > full:
            rests.append((size - full, doc, full))
    rests.sort()
    for below, tier in reversed(list(zip((0, *tiers), tiers))):
        while rests and rests[-1][0] > below:
            length, doc, start = rests.pop()
            sequence, gap = [(doc, start, length)], tier - length
            while gap and rests:
                k = bisect_right(rests, (gap, 1 << 62, 0))
                if k:  # the longest that fits whole
                    length, doc, start = rests.pop(k - 1)
                else:  # none fits: the shortest gives its head
                    whole, doc, start = rests.pop(0)
                    length = gap
                    insort(rests, (whole - gap, doc, start + gap))
                sequence.append((doc, start, length))
                gap -= length
            sequences += [sequence] if not gap else _powers_of_two(sequence, tier - gap)
    return sequences


def _powers_of_two(pieces: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    """``pieces``, ``total`` tokens long, cut into sequences whose lengths are the powers of two of ``total``."""
    out, todo = [], list(reversed(pieces))
    for power in range(total.bit_length() - 1, -1, -1):
        room, sequence = total & 1 << power, []
        while room:
            doc, start, length = todo.pop()
            if length > room:
                todo.append((doc, start + room, length - room))
                length = room
            sequence.append((doc, start, length))
            room -= length
        if sequence:
            out.append(sequence)
    return out


def step_groups(sequences: list[list[tuple[int, int, int]]], step_tokens: int) -> list[int]:
    """A group for each sequence: of one length, ``step_tokens`` tokens in each (the last of a length may have fewer)."""
    groups, number, by_length = [0] * len(sequences), 0, {}
    for i, sequence in enumerate(sequences):
        by_length.setdefault(sum(p[2] for p in sequence), []).append(i)
    for length in sorted(by_length, reverse=True):
        members = sorted(by_length[length], key=lambda i: (-sum(p[2] ** 2 for p in sequences[i]), i))
        width = -(-len(members) * length // step_tokens)
        for k, i in enumerate(members):
            lap, place = divmod(k, width)
            groups[i] = number + (place if lap % 2 == 0 else width - 1 - place)
        number += width
    return groups


def pack(
    docs: DataFrame, tokenizer_path: str | None = None, tiers: tuple[int, ...] = TIERS, unit_tokens: int = 1 << 21, step_tokens: int = 1 << 14
) -> DataFrame:
    """One row for each piece of ``docs``, with its sequence, the tier (length) of that sequence, and its step group."""
    path = tokenizer_path or byte_bpe.default_path()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = byte_bpe.loaded(path), np.asarray([END_ID], "<u4").tobytes()
        base = TaskContext.get().partitionId() << 40
        next_sequence, next_group = base, base
        ids, tokens, held = [], [], 0

        def unit():
            nonlocal next_sequence, next_group
            sequences = pack_unit([len(t) // 4 for t in tokens], tiers)
            groups = step_groups(sequences, step_tokens)
            columns = [[] for _ in _ARROW]
            for number, (sequence, group) in enumerate(zip(sequences, groups)):
                offset, total = 0, sum(p[2] for p in sequence)
                for doc, start, length in sequence:
                    crc = zlib.crc32(memoryview(tokens[doc])[4 * start : 4 * (start + length)])
                    row = (ids[doc], start, length, crc, len(tokens[doc]) // 4, next_sequence + number, offset, total, next_group + group)
                    for column, value in zip(columns, row):
                        column.append(value)
                    offset += length
            next_sequence, next_group = next_sequence + len(sequences), next_group + max(groups) + 1
            ids.clear(), tokens.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                tokens.append(tokenizer.encode_document(text.as_py() or "") + end)
                held += len(tokens[-1]) // 4
                if held >= unit_tokens:
                    held = 0
                    yield unit()
        if ids:
            yield unit()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(packed, SCHEMA)
