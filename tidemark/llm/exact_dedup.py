"""Exact deduplication as a stateful stream.

Every row is reduced to the SHA-256 of its normalised text, a stable identifier and a content locator; these narrow
rows are the stream. The stream keeps, per digest, the least identifier with its locator and the number of rows, in
keyed state on disk (RocksDB) that never expires: memory does not grow with the number of texts, and a key that
returns after any time is a hit. Keys are combined within each task before they are shuffled, so a text that
makes up a third of all rows is one state update per task. On hits the full bytes are checked: the rows that share a
digest are read again and grouped by their whole text, and a digest that stands for several texts is split.

Cases: a null text counts as empty. Rows without a doc_id are in order after all others. Rows that repeat with id and
text are told apart by their place, so that exactly one stays. Empty table: empty result. Other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_path, hash_bitmap, in_bitmap, marked_rows, written

#: Files of the narrow stream in one micro-batch.
FILES_PER_BATCH = 1000
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # State stores may be many and small: they take the disk they use, not a reserve of several MB each.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def keyed_state(spark: SparkSession, path: str, schema, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """The state per digest after the stream over the files in ``path``: digest, first (the row that stays), rows."""
    updates = fresh_path(spark, "dedup-updates")

    def keep(batch: DataFrame, number: int) -> None:
        # A batch that is repeated after a failure overwrites what it wrote.
        batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    state = stream.groupBy("digest").agg(F.min("stable").alias("first"), F.count("*").alias("rows"))
    before = {k: spark.conf.get(k, None) for k in _STATE}
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    try:
        query = (
            state.writeStream.outputMode("update").foreachBatch(keep).trigger(availableNow=True)
            .option("checkpointLocation", fresh_path(spark, "dedup-checkpoint")).start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if query.lastProgress is None and not spark.read.schema(schema).parquet(path).take(1):
        return spark.createDataFrame([], state.schema)
    found = spark.read.schema(f"{_ddl(state)}, batch long").parquet(updates)
    # A key's state only grows, so its last update holds.
    return found.groupBy("digest").agg(F.max_by(F.struct("first", "rows"), "batch").alias("s")).select("digest", "s.first", "s.rows")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def dedup(
    spark: SparkSession, docs: DataFrame, digest: Callable[[Column], Column] = sha256, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id (id of the row that stays), group_size, kept, text_sha256.

    ``digest`` may be any hash of the text as a string; texts that it does not tell apart are split by their bytes.
    """
    text = normalised(F.col("text"))
    # The place in the input makes identifiers stable once this narrow table is written.
    stable = F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.monotonically_increasing_id().alias("place"), F.input_file_name().alias("locator"),
    )
    path = fresh_path(spark, "dedup-digests")
    docs.select(digest(text).alias("digest"), sha256(text).alias("sha"), stable.alias("stable")).write.parquet(path)
    digests = spark.read.parquet(path)
    state = written(keyed_state(spark, path, digests.schema, files_per_batch), "dedup-state")

    # Full bytes of the hits. The bitmap only spares other rows: one that slips through is a group of its own.
    hits = digests.join(state.where("rows > 1").select("digest"), "digest").select("stable.doc_id")
    bitmap = hash_bitmap(hits, "doc_id")
    again = docs.where(in_bitmap(bitmap.scalar(), F.col("doc_id").cast("bigint"))).select(digest(text).alias("digest"), text.alias("bytes"))
    texts = written(again.groupBy("digest", "bytes").agg(F.count("*").alias("n")).groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1"), "dedup-split")

    if texts.isEmpty():
        owners, key = state.select("digest", "first", "rows"), ["digest"]
    else:  # several texts under one digest: their rows are regrouped by the text itself
        split = docs.select(digest(text).alias("digest"), sha256(text).alias("sha"), text.alias("bytes"), stable.alias("stable")).join(texts, "digest", "left_semi")
        regrouped = split.groupBy("digest", "sha", "bytes").agg(F.min("stable").alias("first"), F.count("*").alias("rows")).drop("bytes")
        whole = state.join(texts, "digest", "left_anti").select("digest", F.lit("").alias("sha"), "first", "rows")
        owners, key = whole.union(regrouped.select("digest", "sha", "first", "rows")), ["digest", "part"]
        owners = owners.withColumnRenamed("sha", "part")
        digests = digests.join(texts, "digest", "left").withColumn("part", F.when(F.col("texts").isNotNull(), F.col("sha")).otherwise(""))
    return digests.join(owners, key).select(
        F.col("stable.doc_id").alias("doc_id"), F.col("first.doc_id").alias("keep_id"), F.col("rows").alias("group_size"),
        (F.col("stable.place") == F.col("first.place")).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def kept_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that repeat the text of another one. Of rows that share id and text one stays."""
    key = _row_key(F.col("doc_id"), sha256(normalised(F.col("text"))))
    rows = dedup(spark, docs).groupBy(_row_key(F.col("doc_id"), F.col("text_sha256")).alias("key")).agg(F.max("kept").alias("__stays"), F.count("*").alias("n"))
    decisions = written(rows.where("not __stays or n > 1").select("key", "__stays"), "dedup-decisions")
    others, marked = marked_rows(docs, key, decisions)
    same = Window.partitionBy("__key").orderBy(F.lit(0))
    stays = marked.withColumn("__n", F.row_number().over(same)).where("__stays is null or (__stays and __n = 1)")
    return others.union(stays.select(*docs.columns))


def _row_key(doc_id: Column, sha: Column) -> Column:
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), sha)
