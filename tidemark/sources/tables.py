"""Tables as written lists of partition folders, switched as a whole.

A version of a table is a manifest: one row for each of its partitions, with the folder that holds it. Folders are never
changed. A write adds folders of its own and commits a manifest that lists them together with the folders it did not
touch, so versions share unchanged partitions, and a reader sees one version whole, also while a merge runs or after one
that broke off. Commits are numbered and optimistic (``commits``): a writer that comes second starts anew from what the
first one left.

For merges, each folder has an index of its keys: a Bloom filter in blocks of one 64-bit word, kept as rows (folder,
class, word, bits), where a folder's class is the power of two of its number of words. Keys meet it in an equi-join on
class and word; only folders that may hold a key are opened, and only those that do are written anew. An index takes about four
bytes a key, whatever the key's length. Further columns can have an index of their own, for ``lookup`` and ``replace``.

Two versions differ only in the folders that one of them lists alone, so ``changes`` reads no others.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import packed, unpacked
from tidemark.operators.merge import upsert
from tidemark.session import COMPRESSION
from tidemark.sources.commits import CommitLog, Conflict

_PARTS = "part string, value string, folder string, rows bigint, checksum string, class int, index string"
_INDEX = "folder string, field string, class int, word bigint, bits bigint"
_KEY = "(key)"
_KEYS_PER_WORD = 2
_FOLDER = "data/[^/]+/part=[^/]+"


@dataclass(frozen=True)
class Staged:
    """A written version that readers do not see: its number and its entry in the log."""

    number: int
    entry: dict


def _part(by: Sequence[str]) -> Column:
    """A name for a partition, safe in paths, that tells null from any text."""
    values = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in by]
    return F.md5(F.to_json(F.array(*values))) if by else F.lit("all")


def _checksums(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """(part, checksum): row count and two order-free sums over all columns, for each partition."""
    names = [F.col(f"`{c}`") for c in sorted(df.columns)]
    whole, other = F.xxhash64(*names).cast("decimal(38,0)"), F.xxhash64(F.lit(1), *names)
    return df.groupBy(_part(by).alias("part")).agg(
        F.concat_ws(" ", F.count("*").cast("string"), F.sum(whole).cast("string"), F.bit_xor(other).cast("string")).alias("checksum")
    )


def _bits(hashed: Column) -> Column:
    """The bits, eight at most, that a key sets in its word, from a second hash."""
    places = [F.shiftrightunsigned(F.xxhash64(hashed), 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(8)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in places])


def _word(hashed: Column, size_class: Column) -> Column:
    return hashed.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), size_class) - 1)


def _matched(rows: DataFrame, values: DataFrame, field: str, how: str) -> DataFrame:
    """A semi or anti join, with surrogate keys packed on the way."""
    if rows.schema[field].dataType != values.schema[field].dataType:
        return rows.join(values, field, how)
    return unpacked(packed(rows).join(packed(values), field, how), rows.schema)


@dataclass(frozen=True)
class ManifestTable:
    """``keys`` identify a row, for merges; ``partition_by`` deals the rows out to folders; ``indexed`` are further columns
    by which rows are looked up."""

    spark: SparkSession
    root: str
    keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    indexed: tuple[str, ...] = ()
    log: CommitLog = field(init=False, repr=False)

    def __post_init__(self):
        object.__setattr__(self, "log", CommitLog(self.spark, f"{self.root}/versions"))

    # Reading

    def current_version(self) -> int | None:
        return self.log.latest()

    def exists(self) -> bool:
        return self.current_version() is not None

    def _entry(self, version: int | None) -> dict:
        version = self.current_version() if version is None else version
        if version is None:
            raise LookupError(f"nothing published under {self.root}")
        return self.log.read(version)

    def parts(self, version: int | None = None) -> DataFrame:
        """One row for each partition: part, value, folder, rows, checksum, class and index."""
        return self._parts(self._entry(version))

    def read(self, version: int | None = None, where: Column | str | None = None) -> DataFrame:
        """A version's rows, the current one's without a number. ``where`` chooses partitions by their ``value`` (text)
        before any file is opened."""
        entry = self._entry(version)
        parts = self._parts(entry)
        return self._rows(entry, parts if where is None else parts.where(where))

    def _parts(self, entry: dict) -> DataFrame:
        return self.spark.read.schema(_PARTS).parquet(f"{self.root}/{entry['parts']}")

    def _rows(self, entry: dict, parts: DataFrame) -> DataFrame:
        schema = StructType.fromJson(entry["schema"])
        folders = sorted(r.folder for r in parts.select("folder").collect())  # one row per partition
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{f}" for f in folders))

    def about(self, version: int | None = None) -> dict:
        """What the writer of a version noted down with it."""
        return self._entry(version).get("about", {})

    def lookup(self, field: str, values: DataFrame) -> DataFrame:
        """The current rows whose indexed column ``field`` has one of ``values`` (one column). Only folders whose index may
        have one are opened."""
        rows, values = self.around(field, values)
        return _matched(rows, values, field, "left_semi")

    def around(self, field: str, values: DataFrame) -> tuple[DataFrame, DataFrame]:
        """All rows of the folders that ``lookup`` opens, for joins that choose among them, and the values as their column
        holds them."""
        entry = self._entry(None)
        parts = self._parts(entry)
        values = unpacked(values.toDF(field), StructType.fromJson(entry["schema"]))
        return self._rows(entry, parts.join(self._may_hold(values, parts, field), "folder", "left_semi")), values

    def changes(self, since: int | None, until: int | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """Rows that version ``since`` has and ``until`` (the current one) has not, and the other way round, with
        ``is_new`` telling which; all rows are new without ``since``. Where only ``columns`` of them are asked for, rows meet
        by these and two 64-bit hashes of the whole row."""
        if since is None:
            rows = self.read(until)
            return (rows.select(*columns) if columns else rows).withColumn("is_new", F.lit(True))
        marked = self.weighted(since, until)
        whole = [F.col(f"`{c}`") for c in marked.columns if c != "weight"]
        if columns:
            nulls = [c.isNull() for c in whole]  # hashes pass over nulls
            hashes = [F.xxhash64(*whole, *nulls).alias("__hash"), F.xxhash64(F.lit(1), *whole, *nulls).alias("__other")]
            narrow = packed(marked.select(*columns, *hashes, "weight"))
            changed = narrow.groupBy(*columns, "__hash", "__other").agg(F.sum("weight").alias("n")).where("n <> 0")
            return unpacked(changed, marked.schema).select(*columns, (F.col("n") > 0).alias("is_new"))
        return marked.groupBy(*whole).agg(F.sum("weight").alias("n")).where("n <> 0").withColumn("is_new", F.col("n") > 0).drop("n")

    def weighted(self, since: int | None, until: int | None = None) -> DataFrame:
        """Rows of the folders that only one of two versions lists, with ``weight`` 1 for those of ``until`` (the current
        one) and -1 for those of ``since``: for sums, in which rows that both versions have cancel out without meeting."""
        new = self._entry(until)
        if since is None:
            return self._rows(new, self._parts(new)).withColumn("weight", F.lit(1))
        old = self._entry(since)
        old_parts, new_parts = self._parts(old), self._parts(new)
        gone = self._rows(old, old_parts.join(new_parts.select("folder"), "folder", "left_anti"))
        come = self._rows(new, new_parts.join(old_parts.select("folder"), "folder", "left_anti"))
        for c in come.columns:
            if c not in gone.columns:
                gone = gone.withColumn(c, F.lit(None).cast(come.schema[c].dataType))
        return gone.withColumn("weight", F.lit(-1)).unionByName(come.withColumn("weight", F.lit(1)), allowMissingColumns=True)

    # Writing

    def _fresh(self, kind: str) -> str:
        return f"{kind}/{uuid.uuid4().hex}"

    def _write(self, rows: DataFrame) -> DataFrame:
        """Write ``rows`` to folders of their own; returns their parts, indexed by key, without checksums."""
        data, index = self._fresh("data"), self._fresh("index")
        marked = packed(rows.withColumn("part", _part(self.partition_by)))
        # Rebalanced so that each partition gets few files of an even size, a large one several.
        unpacked(marked.hint("rebalance", "part"), rows.schema).write.partitionBy("part").parquet(f"{self.root}/{data}", compression=COMPRESSION)
        value = F.col(f"`{self.partition_by[0]}`").cast("string") if len(self.partition_by) == 1 else F.lit(None).cast("string")
        fields = self._fields()
        folder = F.regexp_extract(F.col("_metadata.file_path"), f"({_FOLDER})/[^/]*$", 1)
        stored = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{data}").select(folder.alias("folder"), value.alias("value"), *(h.alias(f) for f, h in fields.items()))
        words = F.ceil(F.col("rows") / _KEYS_PER_WORD)
        counted = stored.groupBy("folder").agg(F.first("value").alias("value"), F.count("*").alias("rows"))
        counted.select(
            F.regexp_extract("folder", "part=(.*)$", 1).alias("part"), "value", "folder", "rows", F.lit(None).cast("string").alias("checksum"),
            F.least(F.char_length(F.bin(words - 1)) * (words > 1).cast("int"), F.lit(39)).alias("class"), F.lit(index if fields else None).cast("string").alias("index"),
        ).write.parquet(f"{self.root}/{index}-parts")
        parts = self.spark.read.schema(_PARTS).parquet(f"{self.root}/{index}-parts")
        if fields:
            each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("h")) for f in fields)))
            sized = stored.join(parts.select("folder", "class"), "folder").select("folder", "class", each.alias("e")).select("folder", "class", "e.*")
            words = sized.groupBy("folder", "field", "class", _word(F.col("h"), F.col("class")).alias("word")).agg(F.bit_or(_bits(F.col("h"))).alias("bits"))
            words.write.parquet(f"{self.root}/{index}", compression=COMPRESSION)
        return parts

    def _fields(self) -> dict[str, Column]:
        """The hash of each index's columns."""
        keys = {_KEY: F.xxhash64(*(F.col(f"`{k}`") for k in self.keys))} if self.keys else {}
        return keys | {c: F.xxhash64(F.col(f"`{c}`")) for c in self.indexed if (c,) != self.keys}  # one index for one column

    def _staged_entry(self, parts: DataFrame, schema: StructType, about: dict | None = None) -> dict:
        manifest = self._fresh("manifests")
        parts.select(*(n.split()[0] for n in _PARTS.split(", "))).coalesce(1).write.parquet(f"{self.root}/{manifest}")
        return {"parts": manifest, "schema": schema.jsonValue()} | ({"about": about} if about else {})

    def stage(self, df: DataFrame, about: dict | None = None) -> Staged:
        """Write ``df`` as the next version without publishing it, with a note ``about`` it. Partitions whose rows are those of the current version
        are shared with it, by checksum; nothing but a manifest is written where all are."""
        last = self.current_version()
        entry = None if last is None else self.log.read(last)
        sums = self.kept(_checksums(df, self.partition_by), "checksums")
        shared = None
        if entry is not None and entry["schema"] == df.schema.jsonValue():
            shared = self._parts(entry).join(sums, ["part", "checksum"], "left_semi")
            changed = sums.join(shared.select("part"), "part", "left_anti").select("part")
        else:
            changed = sums.select("part")
        rows = df
        if shared is not None:
            rows = df.withColumn("__part", _part(self.partition_by)).join(changed.withColumnRenamed("part", "__part"), "__part", "left_semi").drop("__part")
        parts = shared
        if entry is None or not changed.isEmpty():
            written = self._write(rows).drop("checksum").join(sums, "part")
            parts = written if shared is None else shared.unionByName(written)
        return Staged((last or 0) + 1, self._staged_entry(parts, df.schema, about))

    def kept(self, df: DataFrame, kind: str) -> DataFrame:
        """A small or narrow intermediate, written and read back."""
        path = f"{self.root}/{self._fresh(f'work/{kind}')}"
        df.write.parquet(path, compression=COMPRESSION)
        return self.spark.read.schema(df.schema).parquet(path)

    def staged(self, staged: Staged) -> DataFrame:
        return self._rows(staged.entry, self._parts(staged.entry))

    def publish(self, staged: Staged) -> None:
        """Make a staged version the current one; fails if another was published since it was staged."""
        if not self.log.create(staged.number, staged.entry):
            raise Conflict(f"version {staged.number} of {self.root} was published by another writer")

    def publish_if(self, df: DataFrame, checks: Callable[[DataFrame], DataFrame]) -> tuple[int, int]:
        """Write, audit, publish. ``checks`` gets the written version and returns (check_name, violations); any violation
        leaves the published version as it is. Returns (staged version, violations)."""
        version = self.stage(df)
        found = checks(self.staged(version)).agg(F.sum("violations")).first()[0] or 0
        if found == 0:
            self.publish(version)
        return version.number, found

    # Merging

    def near(self, keys: DataFrame, where: Column | None = None) -> DataFrame:
        """The current rows of the partitions, among those ``where`` chooses, whose index may have one of ``keys``."""
        entry = self._entry(None)
        parts = self._parts(entry)
        parts = parts if where is None else parts.where(where)
        return self._rows(entry, parts.join(self.may_hold(keys, parts), "folder", "left_semi"))

    def may_hold(self, keys: DataFrame, parts: DataFrame) -> DataFrame:
        """The folders of ``parts`` whose index may have one of ``keys``: all that do, and few others."""
        return self._may_hold(keys.select(*self.keys), parts, _KEY)

    def _may_hold(self, values: DataFrame, parts: DataFrame, field: str) -> DataFrame:
        field = _KEY if (field,) == self.keys else field
        chosen = [(r["class"], r["index"]) for r in parts.select("class", "index").distinct().collect()]  # classes are few, indexes one a commit
        if not chosen:
            return parts.select("folder")
        index = self.spark.read.schema(_INDEX).parquet(*(f"{self.root}/{i}" for i in sorted({i for _, i in chosen})))
        classes = F.explode(F.array(*(F.lit(c) for c in sorted({c for c, _ in chosen}))))
        probes = values.select(self._fields()[field].alias("h")).distinct().select("h", classes.alias("class")).select(
            "class", _word(F.col("h"), F.col("class")).alias("word"), _bits(F.col("h")).alias("mask")
        )
        hits = index.where(F.col("field") == field).join(probes, ["class", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        return parts.join(hits.select("folder").distinct(), "folder", "left_semi").select("folder")

    def merge(self, source: DataFrame, order_by: str | None = None, moves: bool = True) -> int:
        """Upsert ``source``, which holds each key once. Returns how many partitions were written anew or given up: those
        that hold an old or a new row of a merged key; all others are shared with the version before.

        Columns that only the table or only the source has are kept. With ``order_by``, a source row that is older than
        the stored row of its key is left out. An empty text as partition value is NULL. With ``moves=False`` a key's
        stored row is sought only in the partition that the source names for it: for partitions that rows cannot leave.
        """
        partition, = self.partition_by
        if source.schema[partition].dataType.typeName() == "string":
            source = source.withColumn(partition, F.nullif(F.col(f"`{partition}`"), F.lit("")))
        source = source.withColumn("__part", _part(self.partition_by))
        source = self.kept(source, "sources") if self.exists() else source  # a first write reads it once
        touched = 0

        def prepare(_: int, entry: dict | None) -> dict | None:
            nonlocal touched
            touched, new = self._merged(source, entry, order_by, moves)
            return new

        self.log.commit(prepare)
        return touched

    def _merged(self, source: DataFrame, entry: dict | None, order_by: str | None, moves: bool) -> tuple[int, dict | None]:
        keys, columns = list(self.keys), [c for c in source.columns if c != "__part"]
        if entry is None:
            parts = self._write(source.select(*columns))
            touched = parts.count()
            if not touched:
                return 0, None
            return touched, self._staged_entry(parts, source.select(*columns).schema)
        parts = self._parts(entry)
        named = parts.join(source.select(F.col("__part").alias("part")).distinct(), "part", "left_semi")
        candidates = parts.join(self.may_hold(source, parts), "folder", "left_semi") if moves else named
        fresh = source.withColumn("__from", F.lit(None).cast("string"))
        if not candidates.isEmpty():
            stored = self._rows(entry, candidates)
            held = F.regexp_extract(F.col("_metadata.file_path"), "/part=([^/]+)/[^/]*$", 1)
            found = packed(stored.select(*keys, *([F.col(order_by).alias("__stored")] if order_by else []), held.alias("__from")))
            fresh = unpacked(packed(source).join(found, keys, "left"), source.schema)
            if order_by:
                fresh = fresh.where(F.col("__stored").isNull() | (F.col(f"`{order_by}`") >= F.col("__stored")))
            fresh = self.kept(fresh.select(*source.columns, "__from"), "changes")
        names = self._names(fresh.select(F.explode(F.array("__part", "__from")).alias("part")))
        touched = len(names)
        if not touched:
            return 0, None
        here = F.col("part").isin(names)
        old = self._rows(entry, parts.where(here))
        new = fresh.select(*columns)
        result = unpacked(upsert(packed(old), packed(new), keys), upsert(old, new, keys).schema)
        return touched, self._staged_entry(parts.where(~here).unionByName(self._write(result)), result.schema)

    @staticmethod
    def _names(parts: DataFrame) -> list[str]:
        return sorted(r.part for r in parts.where("part is not null").distinct().collect())  # one row per partition

    def replace(self, field: str, values: DataFrame | None, rows: DataFrame, about: dict | None = None, expected: dict | None = None) -> int:
        """Put ``rows`` in the place of all rows whose indexed column ``field`` has one of ``values`` (one column; a row of
        ``rows`` may have others), or of all rows without ``values``. Returns how many partitions were written anew or given up. With ``expected``, the note of
        the version that ``rows`` were computed from (empty for none), it fails if another one was published since."""
        rows = rows.withColumn("__part", _part(self.partition_by))
        whole = values is None or not self.exists()  # written as computed, without a copy
        if not whole:
            rows, values = self.kept(rows, "sources"), self.kept(packed(values.toDF(field)).distinct(), "values")
            values = unpacked(values, rows.schema)
        touched = 0

        def prepare(_: int, entry: dict | None) -> dict | None:
            nonlocal touched
            new = rows.drop("__part")
            if expected is not None and ((entry or {}).get("about") or {}) != expected:
                raise Conflict(f"another writer changed {self.root}")
            if entry is None or values is None:
                parts = self._write(new)
                touched = parts.count()
                return self._staged_entry(parts, new.schema, about)
            parts = self._parts(entry)
            named = rows.select(F.col("__part").alias("part"))
            holding = parts.join(self._may_hold(values, parts, field), "folder", "left_semi")
            if not holding.isEmpty():
                found = self._rows(entry, holding)
                held = F.regexp_extract(F.col("_metadata.file_path"), "/part=([^/]+)/[^/]*$", 1)
                named = named.union(_matched(found.select(field, held.alias("part")), values, field, "left_semi").select("part"))
            names = self._names(named)
            touched = len(names)
            if not touched:
                return entry | {"about": about} if about else None
            here = F.col("part").isin(names)
            result = _matched(self._rows(entry, parts.where(here)), values, field, "left_anti").unionByName(new, allowMissingColumns=True)
            return self._staged_entry(parts.where(~here).unionByName(self._write(result)), result.schema, about)

        self.log.commit(prepare)
        return touched

    def rewrite(self, where: Column, build: Callable[[int, DataFrame | None], DataFrame], unchanged: Callable[[DataFrame, DataFrame], bool]) -> int | None:
        """Put what ``build`` makes of the rows in the partitions chosen by ``where`` (over ``parts``) in their place, and
        share all others unopened. ``build`` gets the number of the new version and those rows, None without a version.
        Nothing is committed where ``unchanged`` says so of the old and the new parts. Returns the new version's number."""
        chosen = F.coalesce(where, F.lit(False))

        def prepare(number: int, entry: dict | None) -> dict | None:
            parts = None if entry is None else self._parts(entry)
            rows = build(number, None if parts is None else self._rows(entry, parts.where(chosen)))
            written = self._write(rows)
            if parts is None:
                return self._staged_entry(written, rows.schema)
            if unchanged(parts.where(chosen), written):
                return None
            return self._staged_entry(parts.where(~chosen).unionByName(written), rows.schema)

        return self.log.commit(prepare)

    # Housekeeping

    def expire(self, keep: int = 10) -> int:
        """Forget all versions but the last ``keep``, and delete the folders that only those had. Returns how many folders
        went. Folders that no version ever listed, such as those of a merge that is under way, stay."""
        numbers = self.log.numbers()
        gone, kept = numbers[:-keep], numbers[-keep:]
        if not gone:
            return 0
        listed = [{r.folder for n in some for r in self.parts(n).select("folder").collect()} for some in (gone, kept)]
        self.log.forget(keep)
        for folder in listed[0] - listed[1]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return len(listed[0] - listed[1])
