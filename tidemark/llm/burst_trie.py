"""Prefix trie over conversations, as a burst trie.

A turn is the digest of role and text; a conversation is the sequence of its turns. Equal sequences are one member with
a count. All sequences start in one container, the root's. A container with more than ``limit`` turns (and more than one
sequence) bursts: its node becomes a trie head and its sequences go on to containers of their own by the next turn id.
Several bursts, one below the other, are done in one round: each sequence shows the next turns of its path, sizes are
counted for each prefix, and a sequence stays in its first container that is not too large; rounds look 1, 8, 64, 512
and then 4096 turns ahead, so a long prefix that many conversations share costs few rounds. What remains are containers of
bounded size: their suffixes, sorted, are swept once, with the current path on a stack, and every pop is a node. Heads
are summed up from the containers and heads below them. A single sequence in a container needs no sweep if it is long:
its nodes are its turns.

Sequences are kept as one row for each turn; only bounded stretches of them are gathered: what a round looks ahead, and
the suffixes within a container. Turn numbers, sums over long sequences, and the ids of conversations that end together
are computed in blocks.

Cases: rows without a conversation id belong to no conversation. A null role or text counts as empty. Turns without
a number come first; turns with the same number are in the order of their digests. Rows that repeat are turns of their
own. Empty table: no nodes, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

LIMIT = 1024
#: Turns that rounds of bursts look ahead; the last figure holds for all later rounds.
AHEAD = (1, 8, 64, 512, 4096)
_BLOCK = 4096
_ROOT = "x''"
_WORDS = "[^\\x20\\x09-\\x0D]+"


def _digest(value: Column) -> Column:
    """16 bytes of the SHA-256."""
    return F.substring(F.unhex(F.sha2(value, 256)), 1, 16)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, id, words): turns with their place from 1, the digest of role and text, and the text's words."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn"), F.floor(F.col("turn") / _BLOCK).alias("block"),
        _digest(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("id"),
        F.regexp_count(text, F.lit(_WORDS)).cast("bigint").alias("words"),
    )
    # Places within blocks of turn numbers, then the turns of the blocks before: no conversation is ordered in one task.
    counts = turns.groupBy("conv_id", "block").count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), before.alias("before"))
    own = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy("turn", "id"))
    placed = turns.select("conv_id", "block", "id", "words", own.alias("own")).join(starts, F.expr("conv_id = c and block <=> b"))
    return placed.select("conv_id", (F.col("before") + F.col("own")).alias("pos"), "id", "words")


def with_shared_heads(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the first turns of another: the first h of conversation c - c % ``every``, then those of c
    itself after its first h, with h = crc32(c) % ``most``. Returns turns (conv_id, pos, id, words) and all conv_ids."""
    conv = F.col("conv_id")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("len")).select(
        "conv_id", "len", (conv - conv % every).alias("donor"), (F.crc32(conv.cast("string").cast("binary")) % most).alias("h")
    )
    donors = convs.where(conv % every == 0).select(conv.alias("d"), F.col("len").alias("donor_len"))
    plan = written(convs.join(donors, F.col("donor") == F.col("d"), "left").select(
        conv.alias("c"), "donor", "h", F.least("h", F.coalesce("donor_len", F.lit(0))).alias("taken")
    ), "trie-conversations")
    own = turns.join(plan, conv == F.col("c")).where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "id", "words")
    first = turns.where((conv % every == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "d")
    heads = first.join(plan, F.col("d") == F.col("donor")).where("pos <= h").select(F.col("c").alias("conv_id"), "pos", "id", "words")
    return own.union(heads), plan.select(F.col("c").alias("conv_id"))


def _chained(blocks: DataFrame) -> DataFrame:
    """(seq, ends): SHA-256 over the id lists of ``blocks`` (seq, block, ids), joined by commas, in the order of blocks.
    Nothing is gathered: a sorted stream runs through the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("seq", pa.int64()), ("ends", pa.string())])
        now = state = None
        for batch in batches:
            for seq, ids in zip(batch.column("seq").to_pylist(), batch.column("ids")):
                if seq == now:
                    state.update(b",")
                else:
                    if state:
                        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], schema=schema)
                    now, state = seq, hashlib.sha256()
                state.update(ids.as_py().encode())
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], schema=schema)

    return blocks.repartition("seq").sortWithinPartitions("seq", "block").mapInArrow(run, "seq bigint, ends string")


def sequences(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(seq, len, n, ends): the different sequences, by their smallest conv_id; how many conversations have each, and the
    SHA-256 of their ids. ``convs`` has the ids of all conversations, also those without turns."""
    # Positions differ, so the combined hashes of (position, turn) tell sequences apart, whatever the order of rows.
    prints = turns.groupBy("conv_id").agg(
        F.count("*").alias("len"), F.bit_xor(F.xxhash64("pos", "id")).alias("x"), F.bit_xor(F.xxhash64("id", "pos", F.lit(1))).alias("y")
    )
    zero = F.lit(0).cast("bigint")
    members = convs.join(prints, "conv_id", "left").select("conv_id", *(F.coalesce(c, zero).alias(c) for c in ("len", "x", "y")))
    blocks = written(members.groupBy("len", "x", "y", F.shiftright("conv_id", 12).alias("block")).agg(
        F.min("conv_id").alias("least"), F.count("*").alias("n"), F.array_sort(F.collect_list("conv_id")).alias("ids")
    ).withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ",")), "trie-members")
    found = written(
        blocks.groupBy("len", "x", "y").agg(F.min("least").alias("seq"), F.sum("n").alias("n"), F.count("*").alias("blocks"), F.min_by("ids", "block").alias("ids")).select(
            "seq", "len", "x", "y", "n", F.when(F.col("blocks") == 1, F.sha2(F.col("ids").cast("binary"), 256)).alias("ends")
        ), "trie-sequences",
    )
    many = found.where("ends is null").select("seq", "len", "x", "y")
    chained = _chained(blocks.join(many, ["len", "x", "y"]).select("seq", "block", "ids")).withColumnRenamed("ends", "chained")
    return found.join(chained, "seq", "left").select("seq", "len", "n", F.coalesce("ends", "chained").alias("ends"))


def _burst(active: DataFrame, turns: DataFrame, ahead: int, limit: int) -> DataFrame:
    """One round: for each sequence of ``active`` (seq, len, n, key, d) and each of its next ``ahead`` depths a row (seq,
    len, n, d, key, parent, words), with over (whether that prefix is too large for a container), after_over (whether all
    shorter ones are) and edge (the last depth looked at)."""
    near = active.join(turns, "seq").where((F.col("pos") > F.col("d")) & (F.col("pos") <= F.col("d") + ahead))
    paths = near.groupBy("seq", "len", "n", "key", "d").agg(F.array_sort(F.collect_list(F.struct("pos", "id", "words"))).alias("next"))
    keys = F.aggregate("next", F.array("key"), lambda keys, t: F.array_append(keys, _digest(F.concat(F.element_at(keys, -1), t["id"]))))
    steps = F.transform("next", lambda t, k: F.struct(
        t["pos"].alias("d"), F.element_at("keys", k + 2).alias("key"), F.element_at("keys", k + 1).alias("parent"), t["words"].alias("words")
    ))
    shown = written(
        paths.withColumn("keys", keys).select("seq", "len", "n", (F.col("d") + ahead).alias("reach"), (F.col("d") + 1).alias("from"), F.explode(steps).alias("s"))
        .select("seq", "len", "n", "reach", "from", "s.*"), "trie-paths",
    )
    large = shown.groupBy("key").agg(F.count("*").alias("seqs"), F.sum(F.col("len") - F.col("d")).alias("rest")).where((F.col("seqs") > 1) & (F.col("rest") > limit))
    flagged = shown.join(large.select(F.col("key").alias("k")), F.col("key") == F.col("k"), "left").withColumn("over", F.col("k").isNotNull()).drop("k")
    before = F.lag("over").over(Window.partitionBy("seq").orderBy("d"))
    return flagged.select(
        "seq", "len", "n", "d", "key", "parent", "words", "over", ((F.col("d") == F.col("from")) | before).alias("after_over"), (F.col("d") == F.col("reach")).alias("edge")
    )


_NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string, top_of binary"


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers, whose rows come one container after the other, sequences sorted. The buffer holds one
    container's nodes: a node's parent is known in full only after its last member."""
    schema = pa.schema([
        ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
        ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()), ("top_of", pa.binary()),
    ])
    out: list[list] = [[] for _ in schema]
    container, above = None, None
    conv: list[int] = []  # by node; then its depth, parent's node, conversations, children, leaves, saved words, words, ends
    depth, parent, convs, children, leaves, saved, words, ends = ([] for _ in range(8))
    path: list[int] = []
    before: list[bytes] = []

    def pop() -> None:
        node = path.pop()
        leaves[node] = leaves[node] or 1
        saved[node] += (convs[node] - 1) * words[node]
        if path:
            up = path[-1]
            conv[up] = min(conv[up], conv[node])
            convs[up] += convs[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]

    def close() -> None:
        while path:
            pop()
        parents = [None if p is None else conv[p] for p in parent]
        for column, values in zip(out, (conv, depth, parents, convs, children, leaves, saved, ends)):
            column += values
        out[-1] += [above if p is None else None for p in parent]
        for values in (conv, depth, parent, convs, children, leaves, saved, words, ends):
            values.clear()

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)
        for column in out:
            column.clear()
        return batch

    for batch in batches:
        columns = [batch.column(c) for c in ("key", "parent", "d", "seq", "n", "ends", "path")]
        for row in zip(*columns):
            key, up, top, seq, n, last, turns = (value.as_py() for value in row)
            if key != container:
                close()
                if len(out[0]) >= 10_000:
                    yield flush()
                container, above, before = key, up, []
            ids = [t["id"] for t in turns]
            common = 0
            for a, b in zip(before, ids):
                if a != b:
                    break
                common += 1
            while len(path) > common:
                pop()
            for k in range(common, len(ids)):
                parent.append(path[-1] if path else None)
                path.append(len(conv))
                conv.append(seq)
                depth.append(top + k)
                words.append(turns[k]["words"])
                ends.append(None)
                for values in (convs, children, leaves, saved):
                    values.append(0)
            node = path[-1]
            conv[node] = min(conv[node], seq)
            convs[node] += n
            ends[node] = last
            before = ids
    close()
    yield flush()


def trie(spark: SparkSession, turns: DataFrame, convs: DataFrame, limit: int = LIMIT, ahead: tuple[int, ...] = AHEAD) -> DataFrame:
    """One row for each node of the trie over ``turns`` (conv_id, pos from 1, id, words) of ``convs`` (conv_id): conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = written(turns, "trie-turns")
    seqs = written(sequences(turns, convs), "trie-members")
    paths = written(turns.join(seqs.select(F.col("seq").alias("s")), F.col("conv_id") == F.col("s"), "left_semi").withColumnRenamed("conv_id", "seq"), "trie-suffixes")

    # Bursts. Passing rows are (sequence, head on its path); settled rows are sequences with their container.
    root = F.expr(_ROOT)
    active = seqs.select("seq", "len", "n", root.alias("key"), F.lit(0).cast("bigint").alias("d"))
    passing = active.select("seq", "len", "n", "d", "key", F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("words"))
    settled, number = None, 0
    while number == 0 or not active.isEmpty():
        shown = written(_burst(active, paths, ahead[min(number, len(ahead) - 1)], limit), "trie-burst")
        passing = passing.union(shown.where("over").select(*passing.columns))
        here = shown.where("not over and after_over").select("seq", "len", "n", "key", "parent", "d")
        settled = here if settled is None else settled.union(here)
        active = shown.where("over and edge and after_over").select("seq", "len", "n", "key", "d")
        number += 1
    passing, settled = written(passing, "trie-passing"), written(settled, "trie-settled")

    # Containers: long single sequences are their turns; all others are swept.
    long = settled.where(F.col("len") - F.col("d") >= limit).select("seq", "key", "d", "n", "len", "parent")
    sizes = settled.groupBy("key").agg(F.count("*").alias("seqs"))
    alone = long.join(sizes.where("seqs = 1").select(F.col("key").alias("k")), F.col("key") == F.col("k"), "left_semi")
    alone = written(alone, "trie-alone")
    nodes = written(_alone_nodes(alone, paths, seqs).union(_swept(settled, alone, paths, seqs)), "trie-nodes")

    heads = _heads(passing, nodes.where("top_of is not null"), seqs)
    parents = heads.select(F.col("key").alias("k"), F.col("conv_id").alias("p"))
    # A node below a head has its parent's id only here; all others go past the join's exchange.
    tops = nodes.where("top_of is not null").join(parents, F.col("top_of") == F.col("k")).withColumn("parent_conv_id", F.col("p"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")]
    upper = heads.join(parents, F.col("parent") == F.col("k"), "left").withColumn("parent_conv_id", F.col("p"))
    return upper.select(*columns).union(tops.select(*columns)).union(nodes.where("top_of is null").select(*columns))


def _swept(settled: DataFrame, alone: DataFrame, paths: DataFrame, seqs: DataFrame) -> DataFrame:
    rest = settled.join(alone.select(F.col("seq").alias("a")), F.col("seq") == F.col("a"), "left_anti").join(seqs.select("seq", "ends"), "seq")
    suffixes = rest.join(paths, "seq").where("pos >= d").groupBy("key", "parent", "d", "seq", "n", "ends").agg(
        F.array_sort(F.collect_list(F.struct("pos", "id", "words"))).alias("path")
    )
    narrow = suffixes.withColumn("path", F.transform("path", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))))
    return narrow.repartition("key").sortWithinPartitions("key", "path.id").mapInArrow(_sweep, _NODE)


def _alone_nodes(alone: DataFrame, paths: DataFrame, seqs: DataFrame) -> DataFrame:
    """The nodes of sequences that have a container to themselves: one for each turn, none with a branch."""
    rows = alone.join(paths, "seq").where("pos >= d").withColumn("block", F.expr(f"pos div {_BLOCK}"))
    saved = (F.col("n") - 1) * F.col("words")
    blocks = rows.groupBy("seq", "block").agg(F.sum(saved).alias("own"))
    later = Window.partitionBy("seq").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    after = blocks.select("seq", "block", F.coalesce(F.sum("own").over(later), F.lit(0)).alias("after"))
    below = F.sum(saved).over(Window.partitionBy("seq", "block").orderBy(F.desc("pos")))
    is_top, is_last = F.col("pos") == F.col("d"), F.col("pos") == F.col("len")
    return rows.withColumn("below", below).join(after, ["seq", "block"]).join(seqs.select("seq", "ends"), "seq").select(
        F.col("seq").alias("conv_id"), F.col("pos").alias("depth"), F.when(~is_top, F.col("seq")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(is_last, 0).otherwise(1).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"),
        (F.col("below") + F.col("after")).alias("saved_tokens"), F.when(is_last, F.col("ends")).alias("ends"), F.when(is_top, F.col("parent")).alias("top_of"),
    )


def _heads(passing: DataFrame, tops: DataFrame, seqs: DataFrame) -> DataFrame:
    """The heads: key, parent and the columns of a node. What lies below a head is added up along the paths: each
    container counts on the path of its smallest member, each head on that of its own."""
    ending = passing.where("len = d").join(seqs.select("seq", "ends"), "seq").select("key", "ends")
    own = passing.groupBy("key").agg(
        F.first("parent").alias("parent"), F.first("d").alias("depth"), F.first("words").alias("words"), F.sum("n").alias("n_convs"), F.min("seq").alias("conv_id")
    )
    heads = written(own.join(ending, "key", "left"), "trie-heads")
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    counted = heads.select(F.col("conv_id").alias("s"), F.col("key").alias("k"), saved)
    found = tops.select(F.col("conv_id").alias("seq"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("held"))
    lines = passing.join(counted, (F.col("key") == F.col("k")) & (F.col("seq") == F.col("s")), "left").join(found, "seq", "left")
    deeper = Window.partitionBy("seq").orderBy(F.desc("d"))
    below = lines.select("key", "leaves", (F.sum(F.coalesce("saved", F.lit(0))).over(deeper) + F.coalesce("held", F.lit(0))).alias("saved")).groupBy("key").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved_tokens")
    )
    born = heads.where("parent is not null").select(F.col("parent").alias("key")).union(tops.select(F.col("top_of").alias("key"))).groupBy("key").agg(F.count("*").alias("born"))
    return written(
        heads.join(below, "key").join(born, "key", "left").select(
            "key", "parent", "conv_id", "depth", "n_convs", F.coalesce("born", F.lit(0)).alias("n_children"),
            F.coalesce("leaves", F.lit(1)).alias("n_leaves"), "saved_tokens", "ends",
        ), "trie-summed",
    )
