"""I-Match fingerprints with several randomised lexicons, in DataFrame functions only.

A text's terms are its distinct runs of letters and digits in lower case, held as 64-bit hashes. The lexicon has the
terms whose share of all distinct texts lies in a band, so that copies do not take their own terms out: rarer ones change with every edit, commoner ones tell nothing. At
most (mean number of distinct terms) / ``BAND[0]`` terms can reach the lower end, whatever the corpus; the lexicon is
handed out as a bitmap of fixed size over term hashes, in which terms that share a slot share membership. The sorted
terms of the text that are in the lexicon are hashed once for each of several random sub-lexicons (``SUBSETS``), from the whole down
to small ones, so that an edit leaves those hashes alone whose sub-lexicon has none of the changed terms.

The likeness of two fingerprints is the share of equal hashes among the sub-lexicons that meet either text.

Cases: a text without a term of the lexicon is fingerprinted by all its terms, and one without terms by its own hash;
so equal texts always have equal fingerprints, of likeness 1. A null text counts as empty. Of rows that share a doc_id
the one with the least text is the next document of others; rows without a doc_id have no next document (their text
is edited with nothing, and near_next is 0). Empty table: empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import hash_bitmap, in_bitmap, slots_for, written

BAND, SLOTS = (0.005, 0.1), 1 << 19
#: Sub-lexicons besides the whole one, as (bits, how many): a field of so many bits of its own in the term's hash says
#: which of 2**bits random parts of the lexicon the term belongs to, and so many of these parts are used. Large parts
#: notice every edit, small ones survive larger edits.
SUBSETS = ((3, 1), (4, 1), (5, 4), (6, 8), (7, 8), (8, 8), (9, 8))


def terms(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    runs = F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda t: t != "")
    return F.array_distinct(F.transform(runs, lambda t: F.xxhash64(t)))


def distinct_texts(texts: DataFrame) -> tuple[DataFrame, int]:
    """``texts`` without repeated rows, and their number by hash. Texts whose hash occurs once stay where they are."""
    hashes = written(texts.groupBy(F.xxhash64("text").alias("hash")).count(), "imatch-hashes")
    repeated = hashes.where("count > 1")
    slots = slots_for(repeated.count())
    maybe = in_bitmap(hash_bitmap(repeated, "hash", slots).scalar(), F.xxhash64("text"), slots)
    return texts.where(~maybe).union(texts.where(maybe).distinct()), hashes.count()


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND, slots: int = SLOTS) -> Column:
    """The lexicon of ``docs`` as a bitmap constant, from counts over all their distinct texts."""
    texts, total = distinct_texts(docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text")))
    counts = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").count()
    chosen = counts.where((F.col("count") >= band[0] * total) & (F.col("count") <= max(band[1] * total, 1.0)))
    words = hash_bitmap(chosen, "term", slots).first().bitmap  # slots / 64 numbers
    return F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")


def fingerprint(text: Column, bitmap: Column, slots: int = SLOTS) -> Column:
    """The hashes of a text by sub-lexicon, null where the sub-lexicon has none of its terms."""
    every = F.sort_array(terms(text))
    inside = F.filter(every, lambda t: in_bitmap(bitmap, t, slots))
    used = F.when(F.size(inside) > 0, inside).when(F.size(every) > 0, every).otherwise(F.array(F.xxhash64(text)))
    return _once(used, _subset_hashes)


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it occurs there."""
    return F.transform(F.array(value), use)[0]


def _subset_hashes(own: Column) -> Column:
    groups, first = [F.array(_hash(own))], 0
    for bits, used in SUBSETS:
        def part(term: Column, first=first, bits=bits) -> Column:
            return F.shiftrightunsigned(term, first).bitwiseAND(F.lit((1 << bits) - 1))

        near = F.filter(own, _compared(part, lambda x, used=used: x < used))
        groups.append(_once(near, _parts_of(part, used)))
        first += bits
    return F.flatten(F.array(*groups))


def _compared(part, test):
    return lambda term: test(part(term))


def _parts_of(part, used: int):
    return lambda near: F.array(*(_hash(F.filter(near, _compared(part, lambda x, k=k: x == k))) for k in range(used)))


def _hash(part: Column) -> Column:
    return F.when(F.size(part) > 0, F.xxhash64(part))


def likeness(a: Column, b: Column) -> Column:
    """Share of the sub-lexicons that meet either text in which both have the same hash; 1 for equal fingerprints."""
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    met = F.size(F.filter(pairs, lambda p: p["a"].isNotNull() | p["b"].isNotNull()))
    same = F.size(F.filter(pairs, lambda p: p["a"] == p["b"]))
    return F.when(a == b, 1.0).when(met > 0, same / met).otherwise(0.0)


def written_out(fingerprint_: Column) -> Column:
    """A fingerprint as text: the hashes in 16 hex digits, dots between them."""
    return F.array_join(F.transform(fingerprint_, lambda h: F.coalesce(F.lower(F.lpad(F.hex(h), 16, "0")), F.lit(""))), ".")


def previous_documents(sizes: DataFrame) -> DataFrame:
    """(doc_id, prev_id, prev_half) for distinct ids: the id before in ascending order (before the first: the last)
    and that document's half. Ids are ranged over partitions; only each range's last id is put in order in one task."""
    ranged = written(sizes.repartitionByRange("doc_id").withColumn("range", F.spark_partition_id()), "imatch-ranges")
    ends = ranged.groupBy("range").agg(F.max(F.struct("doc_id", "half")).alias("end"))
    ring = Window.orderBy("range")
    last = F.max("range").over(Window.partitionBy())
    before = ends.select("range", F.lag("end").over(ring).alias("before"), F.when(F.col("range") == last, F.col("end")).alias("closing"))
    before = before.select("range", F.coalesce("before", F.max("closing").over(Window.partitionBy())).alias("before"))
    inside = Window.partitionBy("range").orderBy("doc_id")
    own = ranged.select("range", "doc_id", F.lag(F.struct("doc_id", "half")).over(inside).alias("own"))
    previous = F.coalesce("own", "before")
    return own.join(F.broadcast(before), "range").select("doc_id", previous["doc_id"].alias("prev_id"), previous["half"].alias("prev_half"))


def compare_edits(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The edited text has its last half replaced by as much of the next document's beginning."""
    bitmap = lexicon(docs, band)
    # An id that is a bigint already stays the bare column: a renamed one would keep the joins below from sharing an exchange.
    doc_id = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("bigint").alias("doc_id")
    rows = docs.select(doc_id, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    sizes = rows.where("doc_id is not null").groupBy("doc_id").agg(F.max(half).alias("half"))
    links = written(previous_documents(sizes), "imatch-links")
    first = Window.partitionBy("doc_id").orderBy("text")
    heads = rows.join(links.hint("merge"), "doc_id").withColumn("n", F.row_number().over(first)).where("n = 1").select(
        F.col("prev_id").alias("doc_id"), F.substring(F.col("text"), F.lit(1), F.col("prev_half")).alias("head"), fingerprint(F.col("text"), bitmap).alias("next")
    )
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.char_length("text") - half), F.substring(F.coalesce(F.col("head"), F.lit("")), F.lit(1), half)
    )
    # Rows with an id are filtered as the join above filters them, so both joins read one exchange of the texts.
    paired = rows.where("doc_id is not null").join(heads.hint("merge"), "doc_id", "left").select("doc_id", "text", edited.alias("edited"), "next")
    alone = rows.where("doc_id is null").withColumns({"head": F.lit(""), "next": F.lit(None).cast("array<bigint>")})
    paired = paired.union(alone.select("doc_id", "text", edited.alias("edited"), "next"))
    marked = paired.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("text"), bitmap).alias("own"), fingerprint(F.col("edited"), bitmap).alias("other"), "next",
    )
    return marked.select(
        "doc_id", "n_chars", "edited_sha256", written_out(F.col("own")).alias("fingerprint"), written_out(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), F.coalesce(likeness(F.col("own"), F.col("next")), F.lit(0.0)).alias("near_next"),
    )
