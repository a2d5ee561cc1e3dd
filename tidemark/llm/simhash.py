"""SimHash fingerprints, and groups of documents whose fingerprints differ in few bits, by exact tiled comparison.

Distinct fingerprints are laid out in tiles by the population counts of the parts of the fingerprint (halves,
quarters or eighths, finer for more fingerprints). Every differing bit changes one part's count by one, so tile pairs
whose counts differ by more than the radius in sum are skipped; all others are compared in full with exclusive-or and
bit counts, block by block in numpy. A task that compares reports a spanning forest of the links it found, not the
links, so a large group of near copies costs a row per member. The forests are joined into components on Spark.

Cases: a null or empty text, or one of white space, has the fingerprint zero and is linked like any other. Fewer words
than a shingle has: the whole sequence is one shingle. Rows without a doc_id get a fingerprint and no component. Rows
that repeat share one node. Empty table: empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import marked_rows, written
from tidemark.llm.components import components

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Fingerprints of one block of a tile, and neighbours it is compared with in one task.
_BLOCK, _SLAB = 1 << 14, 1 << 17
#: Pairs held at once in a comparison.
_PAIRS = 1 << 21


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits: bit i is set if it is set in over half of the hashes of the text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(itertools.islice(words, k, None) for k in range(shingle))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(of_batches, "doc_id bigint, fp bigint")


def forest(home: np.ndarray, other: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links within ``home`` and between ``home`` and ``other``: (member, root) as positions
    in the two arrays joined."""
    every = np.concatenate([home, other])
    parent = np.arange(len(every))
    rows = max(1, _PAIRS // max(1, len(every)))
    for at in range(0, len(home), rows):
        near = np.bitwise_count(home[at : at + rows, None] ^ every[None, at:]) <= radius
        i, j = np.nonzero(near)
        i, j = i + at, j + at
        while True:
            while not np.array_equal(parent, up := parent[parent]):
                parent = up
            u, v = parent[i], parent[j]
            apart = u != v
            if not apart.any():
                break
            i, j, u, v = i[apart], j[apart], u[apart], v[apart]
            np.minimum.at(parent, np.maximum(u, v), np.minimum(u, v))
    members = np.flatnonzero(parent != np.arange(len(every)))
    return members, parent[members]


def _parts(count: int) -> int:
    """Into how many parts the fingerprints are split: so that the fullest tile stays in the order of a block."""
    return 2 if count < 1 << 20 else 4 if count < 1 << 27 else 8


def _tile(parts: int):
    width = 64 // parts
    mask = (1 << width) - 1
    return F.array(*(F.bit_count(F.expr(f"shiftrightunsigned(fp, {k * width}) & {mask}L")) for k in range(parts)))


def _moves(parts: int, radius: int) -> list[list[int]]:
    """Differences of tiles that may hold a link, those to the same or a later tile in the tiles' order."""
    def spread(left: int, budget: int):
        if not left:
            yield []
            return
        for step in range(-budget, budget + 1):
            for rest in spread(left - 1, budget - abs(step)):
                yield [step, *rest]

    return [m for m in spread(parts, radius) if m >= [0] * parts]


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Forests of the links between ``nodes`` (fp, node), fp distinct: (a, b) as nodes. Their components are those of
    all pairs that differ in at most ``radius`` bits."""
    parts = _parts(nodes.count())
    tiled = nodes.select("fp", "node", _tile(parts).alias("tile"))
    sizes = written(tiled.groupBy("tile").count(), "tiles")
    moves = F.array(*(F.array(*map(F.lit, m)) for m in _moves(parts, radius)))
    home = sizes.select(F.col("tile").alias("home"), F.col("count").alias("own"), F.explode(moves).alias("move"))
    reached = home.withColumn("tile", F.zip_with("home", "move", lambda x, y: x + y)).join(sizes, "tile")
    work = reached.groupBy("home").agg(F.first("own").alias("own"), F.sum("count").alias("near")).select(
        "home", F.ceil(F.col("own") / _BLOCK).cast("int").alias("blocks"), F.ceil(F.col("near") / _SLAB).cast("int").alias("slabs")
    )
    # Where the fingerprints of a tile go: to all slabs of their own block, or to one slab of all blocks of a near tile.
    routes = reached.select("tile", "home").join(work, "home")
    at = F.pmod(F.xxhash64("fp"), F.lit(1 << 30))
    own = F.col("tile") == F.col("home")
    sent = tiled.join(routes, "tile").select(
        "fp", "node", "home", own.alias("own"),
        (at % F.col("blocks")).alias("my_block"), (at % F.col("slabs")).alias("my_slab"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "slabs",
    ).select("*", F.explode(F.sequence(F.lit(0), F.col("slabs") - 1)).alias("slab"))
    # As home row: its own block. As other row: its slab; within its own tile, against later blocks and its own.
    is_home = F.col("own") & (F.col("block") == F.col("my_block"))
    is_other = (F.col("slab") == F.col("my_slab")) & (~F.col("own") | (F.col("my_block") > F.col("block")))
    sent = sent.where(is_home | is_other).select("home", "block", "slab", "fp", "node", is_home.alias("is_home"))

    def compare(table: pa.Table) -> pa.Table:
        first = table.column("is_home").to_numpy()
        fp, node = table.column("fp").to_numpy().view(np.uint64), table.column("node").to_numpy()
        order = np.concatenate([np.flatnonzero(first), np.flatnonzero(~first)])
        split = int(first.sum())
        members, roots = forest(fp[order[:split]], fp[order[split:]], radius)
        return pa.table({"a": pa.array(node[order[members]], pa.int64()), "b": pa.array(node[order[roots]], pa.int64())})

    return sent.groupBy("home", "block", "slab").applyInArrow(compare, "a bigint, b bigint")


def near_groups(spark: SparkSession, docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fp, fingerprint (16 hex digits) and component_id, the smallest doc_id
    reachable over links of at most ``radius`` differing bits."""
    marked = written(fingerprints(docs, shingle, seed), "simhash")
    nodes = written(marked.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-nodes")
    reached = components(links(nodes, radius))
    of_fp = nodes.join(reached, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    hex16 = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(of_fp, "fp", "left").select(
        "doc_id", "fp", hex16.alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def kept_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest doc_id; rows without a doc_id stay."""
    grouped = near_groups(spark, docs).where("doc_id <> component_id").select(F.col("doc_id").alias("key"), F.lit(True).alias("__goes")).distinct()
    others, marked = marked_rows(docs, F.col("doc_id").cast("bigint"), written(grouped, "simhash-decisions"))
    return others.union(marked.where("__goes is null").select(*docs.columns))
