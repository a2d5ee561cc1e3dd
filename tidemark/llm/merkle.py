"""Merkle manifest of a dataset, and proofs by a recursive climb.

Each row is a leaf, the SHA-256 of its fields. The leaves of each group (a source) in their order form a tree: three
consecutive nodes at a time become their parent, until one is left, the group's subroot; the subroots, ordered by
group, form the top tree in the same way, whose last node is the root.

Levels are built six at a time: the 729 nodes below a node meet in one row, which gets the levels between and is
stored, so all levels but the first six cost little. A stored node row has the siblings on its
way up to the node six levels higher, its parent link; the last node row of a group links to its place in the top
tree. The climb is one recursive query: it starts with the leaves and their first link and joins each row with the
node row its parent link names, appends that node's siblings to the proof and folds the digest with them. A digest that
was recomputed from other data climbs in the same way, and fits if it arrives at the root.

Leaves of one group meet the same node row high up. So a node row stands once for each 4096 leaves below it, up to 64
times, and the rows that climb are dealt out over these copies.

Order within a group: rows are range-partitioned by group and key, each row's place is its place in its partition plus
the rows of the partitions before, so no group is ordered in one task.

Cases: null fields enter a leaf as ``-``. Rows without a key come first; rows that repeat are leaves of their own, in the
order in which they were read. Rows without a group are a group, the first. A group of one row has its leaf as subroot,
a table of one row its leaf as root. Empty table: no leaves and an empty result. Fields may be empty or very long;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

FANOUT, LEVELS = 3, 6
_WIDTH = FANOUT**LEVELS
_COPIES, _LEAVES_PER_COPY = 64, 4096
_TOP = "^"  # the tree over the subroots; other trees are named '-' (rows without a group) or '=' and the group
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """``-`` for null, else byte length, colon and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def digest(fields: list[Column]) -> Column:
    return _sha(F.concat(*map(encoded, fields)))


def numbered(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """``rows`` (tree, place, ...; place unique) with idx, the place from 0 within the tree by ``key``, and n, its rows."""
    by = ["tree", *key, "place"]
    ordered = written(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftrightunsigned("at", 33).alias("part")
    parts = ordered.groupBy("tree", part).agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    of_tree = Window.partitionBy("tree")
    starts = parts.select(
        "tree", "part", "first", (F.sum("rows").over(of_tree.orderBy("part")) - F.col("rows")).alias("before"), F.sum("rows").over(of_tree).alias("n")
    )
    return ordered.select("*", part).join(starts, ["tree", "part"]).withColumn("idx", F.col("before") + F.col("at") - F.col("first")).drop("at", "part", "first", "before")


def _levels(rows: DataFrame) -> DataFrame:
    """One row for each 729 neighbours of ``rows`` (tree, idx, n, below, h, data; n: nodes of the tree at this level,
    below: leaves under this one): tree, up (their number), n, below, top (digest of the node above them all), members
    with their siblings."""
    grouped = rows.groupBy("tree", F.expr(f"idx div {_WIDTH}").alias("up")).agg(
        F.array_sort(F.collect_list(F.struct("idx", "h", "below", "data"))).alias("rows"), F.first("n").alias("n"), F.sum("below").alias("below")
    )
    depth = F.lit(LEVELS)
    for k in range(LEVELS - 1, -1, -1):
        depth = F.when(F.col("n") <= FANOUT**k, k).otherwise(depth)

    def above(level: str) -> Column:
        runs = F.sequence(F.lit(0), F.expr(f"cast((size({level}) - 1) div {FANOUT} as int)"))
        return F.transform(runs, lambda i: _sha(F.array_join(F.slice(level, i * FANOUT + 1, FANOUT), "")))

    levelled = grouped.select("*", depth.alias("depth"), F.transform("rows", lambda r: F.lower(F.hex(r["h"]))).alias("level0"))
    for k in range(1, LEVELS + 1):
        levelled = levelled.withColumn(f"level{k}", F.when(F.col("depth") >= k, above(f"level{k - 1}")))

    def siblings(k: Column) -> Column:
        """On the way up from the member at ``k``: for each level, the digests left and right of it in its run."""
        steps = []
        for level in range(LEVELS):
            at = F.floor(k / FANOUT**level).cast("int")
            run = F.floor(at / FANOUT).cast("int") * FANOUT
            left, right = F.slice(f"level{level}", run + 1, at - run), F.slice(f"level{level}", at + 2, run + FANOUT - 1 - at)
            steps.append(F.struct(F.unhex(F.array_join(left, "")).alias("l"), F.unhex(F.array_join(right, "")).alias("r")))
        return F.slice(F.array(*steps), F.lit(1), F.col("depth"))

    members = F.transform("rows", lambda r, k: F.struct(r["idx"].alias("idx"), r["h"].alias("h"), r["below"].alias("below"), r["data"].alias("data"), siblings(k).alias("siblings")))
    top = F.get(F.coalesce(*(F.col(f"level{k}") for k in range(LEVELS, -1, -1))), F.lit(0))
    return levelled.select("tree", "up", "n", "below", F.unhex(top).alias("top"), members.alias("members"))


def _build(rows: DataFrame) -> list[DataFrame]:
    """The written levels of all trees, from the lowest up, each holding 729 times fewer rows than the one before."""
    built = []
    while not built or not rows.isEmpty():
        built.append(written(_levels(rows), "merkle-level"))
        data = rows.schema["data"].dataType
        rows = built[-1].where(F.col("n") > _WIDTH).select(
            "tree", F.col("up").alias("idx"), F.expr(f"(n + {_WIDTH - 1}) div {_WIDTH}").alias("n"), "below", F.col("top").alias("h"), F.lit(None).cast(data).alias("data")
        )
    return built


def _copies(below: Column) -> Column:
    """How often a node row stands, by the leaves below it."""
    return F.least(F.lit(_COPIES), F.ceil(below / _LEAVES_PER_COPY)).cast("int")


def _linked(level: DataFrame, number: int, tops: DataFrame | None) -> DataFrame:
    """The node rows of a written level with their parent links; ``tops`` has the places of the trees in the top tree."""
    if tops is None:
        level, p_tree, p_idx = level.withColumn("own", F.lit(None).cast("bigint")), F.lit(None).cast("string"), F.lit(None).cast("bigint")
    else:
        # Only the last level of a tree, one row, is looked up: other rows have no key and go past the exchange's hot spots.
        level = level.withColumn("last", F.when(F.col("n") <= _WIDTH, F.col("tree"))).join(tops, F.col("last") == F.col("top_of"), "left").drop("last", "top_of")
        p_tree, p_idx = F.lit(_TOP), F.col("own")
    is_last = F.col("n") <= _WIDTH
    return level.select("tree", "up", "below", is_last.alias("is_last"), "top", "own", F.explode("members").alias("m")).select(
        "tree", F.lit(number).alias("lvl"), F.col("m.idx").alias("idx"), F.col("m.h").alias("h"), F.col("m.data").alias("data"), F.col("m.siblings").alias("siblings"), _copies(F.col("m.below")).alias("copies"), _copies(F.col("below")).alias("p_copies"),
        F.when(F.col("is_last"), p_tree).otherwise(F.col("tree")).alias("p_tree"),
        F.when(F.col("is_last"), F.lit(0)).otherwise(F.lit(number + 1)).alias("p_lvl"),
        F.when(F.col("is_last"), p_idx).otherwise(F.col("up")).alias("p_idx"), F.when(F.col("is_last"), F.col("top")).alias("top"),
    )


@dataclass(frozen=True)
class Manifest:
    """Node rows: ``leaves`` (with data: the row's key and the digest received for it) and ``nodes`` above them."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame

    def root(self) -> str | None:
        row = self.nodes.where(F.col("p_tree").isNull()).select("top").first()
        return row and row.top.hex()


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "source", key: str = "doc_id", received: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``. ``received`` replaces fields by what a copy of the rows holds; the digest of that copy
    is kept beside each leaf, for ``climb`` to fold."""
    own = {f: F.col(f"`{f}`") for f in fields}
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("-"))
    leaves = written(
        docs.select(
            name.alias("tree"), F.col(f"`{key}`").alias("key"), F.unhex(digest(list(own.values()))).alias("h"),
            F.unhex(digest(list((own | (received or {})).values()))).alias("received"), F.monotonically_increasing_id().alias("place"),
        ), "merkle-leaves",
    )
    rows = numbered(leaves, ["key"], "merkle-ordered").select("tree", "idx", "n", F.lit(1).cast("bigint").alias("below"), "h", F.struct("key", "received").alias("data"))
    levels = _build(rows)
    roots = [level.where(F.col("n") <= _WIDTH).select("tree", "top", "below") for level in levels]
    found = roots[0]
    for more in roots[1:]:
        found = found.union(more)
    groups = written(found.withColumn("place", F.monotonically_increasing_id()), "merkle-subroots")
    # Names of trees are in the order of the groups: the group without a name first, then bytewise.
    top = numbered(groups.withColumnsRenamed({"tree": "group"}).withColumn("tree", F.lit(_TOP)), ["group"], "merkle-groups")
    tops = written(top.select(F.col("group").alias("top_of"), F.col("idx").alias("own"), "n", "below", F.col("top").alias("h")), "merkle-tops")
    top_levels = _build(tops.select(F.lit(_TOP).alias("tree"), F.col("own").alias("idx"), "n", "below", "h", F.lit(None).cast(rows.schema["data"].dataType).alias("data")))
    places = tops.select("top_of", "own")
    linked = [_linked(level, k, places) for k, level in enumerate(levels)] + [_linked(level, k, None) for k, level in enumerate(top_levels)]
    nodes = linked[1]
    for more in linked[2:]:
        nodes = nodes.union(more)
    return Manifest(linked[0], written(nodes.drop("h", "data").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))), "merkle-nodes"), tops.select(F.substr("top_of", F.lit(2)).alias("group"), F.lower(F.hex("h")).alias("subroot")))


_FOLD = "aggregate(siblings, {}, (d, s) -> unhex(sha2(cast(lower(concat(hex(s.l), hex(d), hex(s.r))) as binary), 256)))"
# The join is a merge join at every size, so that the plan seen on little data is the plan on much.
_CLIMB = f"""
with recursive climb (key, leaf, folded, proof, p_tree, p_lvl, p_idx, p_copies, subroot, root) as (
    select data.key, h, {_FOLD.format("data.received")}, aggregate(siblings, x'', (p, s) -> concat(p, s.l, s.r)),
           p_tree, p_lvl, p_idx, p_copies, top, cast(null as binary)
    from {{leaves}}
    union all
    select /*+ merge(n) */ c.key, c.leaf, {_FOLD.format("c.folded")}, aggregate(siblings, c.proof, (p, s) -> concat(p, s.l, s.r)),
           n.p_tree, n.p_lvl, n.p_idx, n.p_copies, coalesce(c.subroot, n.top), if(n.p_tree is null, n.top, null)
    from climb c join {{nodes}} n
      on c.p_tree = n.tree and c.p_lvl = n.lvl and c.p_idx = n.idx and pmod(xxhash64(c.leaf, c.key), c.p_copies) = n.salt
)
select key, lower(hex(leaf)) as leaf, lower(hex(subroot)) as subroot, lower(hex(root)) as root,
       sha2(cast(lower(hex(proof)) as binary), 256) as proof_sha256, lower(hex(folded)) as folded_root, folded = root as verified
from climb where p_tree is null
"""


def climb(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """For each leaf: key, leaf, subroot, root, proof_sha256 (of its siblings up to the root), folded_root (what the
    received digest folds to) and verified (whether that is the root)."""
    limit = "spark.sql.cteRecursionRowLimit"  # a guard against endless recursion; the climb ends at the root
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        return written(spark.sql(_CLIMB, leaves=manifest.leaves, nodes=manifest.nodes), "merkle-climb")
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)
