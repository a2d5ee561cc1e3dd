"""CSV and JSON documents of any size, cut where their records end and read in parallel.

Where a record ends depends on all that stands before it: a line break inside quotes ends no CSV record, and a brace ends
a record of a JSON array only at depth one outside of strings. Both are state machines over pieces of text (lines, or what
lies between closing braces), and what a stretch of pieces does to the state can be written down without knowing the
state it starts in:

- quotes (two states) by how often the state was swapped since the last piece that leaves one state whatever it was before;
- nesting by the sum of brackets outside of strings, for either state of the quotes at the start.

So each split's pieces are summed up for both possible starts, a running composition over the splits of a file (one small
row each) gives the start that holds, and the pieces take the result that belongs to it. The files are read once; the
pieces are written to shared storage with both results, so later scans see the same splits. Pieces pass one exchange by
split to be put in order, and only those of records that consist of several pieces meet in a second one.
"""

from __future__ import annotations

import csv
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidemark.operators import intake
from tidemark.schemas import SourceSpec
from tidemark.session import shared_dir

ROW_NUMBER = "source_row_number"
FILE = "source_file"
_FIRST = Window.unboundedPreceding


def _in_order() -> WindowSpec:
    """The pieces of a split."""
    return Window.partitionBy(FILE, "split").orderBy("id")


def _splits() -> WindowSpec:
    """The splits of a file, one row each."""
    return Window.partitionBy(FILE).orderBy("split")


def _earlier() -> WindowSpec:
    return _splits().rowsBetween(_FIRST, -1)


def _pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    scan = spark.read.option("lineSep", separator).text(path)
    return scan.select("value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"))


def _kept(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/documents/{uuid.uuid4().hex}"


def _odd(number: Column) -> Column:
    return F.pmod(number, F.lit(2)).cast("int")


def _xor(a: Column, b: Column) -> Column:
    return _odd(a + b)


def _states(df: DataFrame, if_outside: str, if_inside: str, over: WindowSpec) -> DataFrame:
    """``df`` with after0 and after1, the states after each row for the starts 0 and 1, from what each row makes of
    either state: one that makes the same of both fixes the state, one that exchanges them swaps it, the others leave it."""
    f0, f1 = F.col(if_outside), F.col(if_inside)
    swaps = _odd(F.sum(F.when((f0 == 1) & (f1 == 0), 1).otherwise(0)).over(over))
    marked = df.withColumn("swaps", swaps).withColumn("fixed", F.when(f0 == f1, _xor(f0, F.col("swaps"))))
    last = F.last("fixed", ignorenulls=True).over(over)
    return marked.withColumns({f"after{s}": _xor(F.coalesce(last, F.lit(s)), F.col("swaps")) for s in (0, 1)}).drop("swaps", "fixed")


# CSV

_CELL = '(?:"(?:[^"]++|"")*+"[^,]*+|(?!")[^,]*+)'
_ENDS_OUTSIDE = f"^{_CELL}(?:,{_CELL})*+\\z"
_COMES_OUTSIDE = f'^(?:[^"]++|"")*+"[^,]*+(?:,{_CELL})*+\\z'


def _csv_records(spark: SparkSession, path: str, multiline: bool) -> DataFrame:
    """(source_file, no, value): the records of each file, numbered from 1; blank lines between records are none."""
    folder, value = _folder(spark), F.col("value")
    plain = ~F.contains(value, F.lit('"')) if multiline else F.lit(True)
    outside = F.when(plain, 0).when(value.rlike(_ENDS_OUTSIDE), 0).otherwise(1)
    inside = F.when(plain, 1 if multiline else 0).when(value.rlike(_COMES_OUTSIDE), 0).otherwise(1)
    lines = _pieces(spark, path, "\n").withColumns({"f0": outside, "f1": inside})
    blank = value.isin("", "\r")
    states = _states(lines, "f0", "f1", _in_order()).drop("f0", "f1").withColumns(
        {f"before{s}": F.lag(f"after{s}", 1, s).over(_in_order()) for s in (0, 1)}
    )
    begun = {f"begun{s}": F.sum(F.when((F.col(f"before{s}") == 0) & ~blank, 1).otherwise(0)).over(_in_order()) for s in (0, 1)}
    lines = _kept(states.withColumns(begun), f"{folder}/lines")

    ends = lines.groupBy(FILE, "split").agg(
        F.max_by(F.struct("after0", "after1"), "id").alias("end"), F.max("begun0").alias("begun0"), F.max("begun1").alias("begun1")
    ).select(FILE, "split", F.col("end.after0").alias("f0"), F.col("end.after1").alias("f1"), "begun0", "begun1")
    placed = _states(ends, "f0", "f1", _splits()).withColumn("start", F.lag("after0", 1, 0).over(_splits()))
    starts = placed.select(FILE, "split", "start", F.coalesce(F.sum(F.when(F.col("start") == 0, F.col("begun0")).otherwise(F.col("begun1"))).over(_earlier()), F.lit(0)).alias("offset"))
    starts = _kept(starts, f"{folder}/splits")

    def known(name: str) -> Column:
        return F.when(F.col("start") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    located = lines.join(starts, [FILE, "split"]).select(FILE, "split", "id", "value", known("before").alias("before"), known("after").alias("after"), (F.col("offset") + known("begun")).alias("no"))
    outer = F.col("before") == 0
    single = located.where(outer & (F.col("after") == 0) & ~blank).select(FILE, "no", "value")
    several = located.where(~outer | (F.col("after") == 1)).groupBy(FILE, "no").agg(F.array_sort(F.collect_list(F.struct("split", "id", "value"))).alias("lines"))
    records = single.union(several.select(FILE, "no", F.array_join("lines.value", "\n").alias("value")))
    value = F.regexp_replace("value", "\\r\\z", "")
    return records.select(FILE, "no", F.when(F.col("no") == 1, F.regexp_replace(value, "^\\x{FEFF}", "")).otherwise(value).alias("value"))


def scan_csv(spark: SparkSession, path: str, spec: SourceSpec, multiline: bool = True) -> DataFrame:
    """All-text CSV with a header: empty cells are NULL, surplus cells dropped, data rows count from 2.

    Line breaks (LF or CRLF) inside quotes belong to the cell; ``multiline=False`` forbids them. Quotes count where a cell
    begins with one. Columns are matched by name, for each file by its own header, its first record.
    """
    records = _kept(_csv_records(spark, path, multiline), f"{_folder(spark)}/records")
    headers = records.where("no = 1").select(FILE, F.col("value").alias("header"))
    shapes = []  # the different headers are few; files are not collected
    for row in headers.select("header").distinct().collect():
        names = next(csv.reader([row.header]))
        shapes.append((row.header, [names.index(c) if c in names else None for c in spec.payload], len(names)))
    places = spark.createDataFrame(shapes, "header string, places array<int>, width int")
    width = max([1, *(shape[2] for shape in shapes)])
    of_file = headers.join(places, "header").select(FILE, "places")
    schema = ", ".join(f"c{i} string" for i in range(width))
    cells = F.from_csv("value", schema, {"escape": '"'})
    rows = records.where("no > 1").select(FILE, "no", F.inline(F.array(cells))).join(of_file, FILE)
    row = F.array(*(F.col(f"c{i}") for i in range(width)))
    return rows.select(FILE, F.col("no").cast("bigint").alias(ROW_NUMBER), "places", row.alias("cells")).select(
        *(F.get("cells", F.col("places")[i]).alias(c) for i, c in enumerate(spec.payload)), FILE, ROW_NUMBER
    )


# JSON

_WS = "[ \\t\\n\\r]*"


def _json_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(source_file, no, value): the objects of each file's array as text, with the bracket or comma before them; and
    (source_file, no, value): what follows the last one, with the number of objects."""
    folder = _folder(spark)
    bare = F.regexp_replace("value", "(?s)\\\\.", "")  # no escapes, so all quotes begin or end a string
    free = [F.regexp_replace(text, '"[^"]*+(?:"|\\z)', "") for text in (F.col("bare"), F.regexp_replace("bare", '^[^"]*+(?:"|\\z)', ""))]

    def number(text: Column, letters: str) -> Column:
        return F.length(text) - F.length(F.translate(text, letters, ""))

    counted = _pieces(spark, path, "}").withColumn("bare", bare).select(
        FILE, "split", "id", "value", _odd(number(F.col("bare"), '"')).alias("swap"), *((number(t, "{[") - number(t, "}]")).alias(f"net{s}") for s, t in enumerate(free))
    )
    counted = counted.withColumn("swaps", F.sum("swap").over(_in_order()))
    steps = {}
    for s in (0, 1):
        before, after = _odd(F.col("swaps") - F.col("swap") + s), _odd(F.col("swaps") + s)
        # The brace that ends the piece counts if no string is open there.
        net = F.when(before == 0, F.col("net0")).otherwise(F.col("net1")) - F.when(after == 0, 1).otherwise(0)
        steps[f"depth{s}"] = F.sum(net).over(_in_order())
    pieces = counted.withColumns({**steps, "n": F.row_number().over(_in_order())})
    pieces = _kept(pieces.select(FILE, "split", "id", "n", "value", _odd(F.col("swaps")).alias("swaps"), "depth0", "depth1"), f"{folder}/pieces")

    ends = pieces.groupBy(FILE, "split").agg(F.max_by(F.struct("swaps", "depth0", "depth1"), "id").alias("end"), F.max("n").alias("pieces")).select(FILE, "split", "pieces", "end.*")
    placed = ends.withColumns({"open": _odd(F.coalesce(F.sum("swaps").over(_earlier()), F.lit(0))), "is_last": F.lead("split").over(_splits()).isNull()})
    depth = F.when(F.col("open") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    starts = _kept(placed.select(FILE, "split", "pieces", "open", "is_last", F.coalesce(F.sum(depth).over(_earlier()), F.lit(0)).alias("depth")), f"{folder}/starts")

    found = pieces.join(starts.withColumnRenamed("depth", "begin"), [FILE, "split"]).withColumns({
        "is_tail": F.col("is_last") & (F.col("n") == F.col("pieces")),
        "ends": (_xor(F.col("open"), F.col("swaps")) == 0) & (F.col("begin") + F.when(F.col("open") == 0, F.col("depth0")).otherwise(F.col("depth1")) == 1),
    })
    bounds = found.groupBy(FILE, "split").agg(
        F.count_if(F.col("ends") & ~F.col("is_tail")).alias("records"), F.every(F.col("ends") | F.col("is_tail")).alias("flat"), F.first("begin").alias("begin"), F.first("open").alias("open")
    )
    # Where every piece is a record, a record's number is that of its piece, and nothing has to meet.
    flat = F.col("flat") & (F.col("open") == 0) & (F.col("begin") <= 1)
    offsets = _kept(bounds.select(FILE, "split", flat.alias("flat"), F.coalesce(F.sum("records").over(_earlier()), F.lit(0)).alias("offset")), f"{folder}/offsets")
    located = found.join(offsets, [FILE, "split"])
    numbered = located.where("flat").select(FILE, "split", "id", "value", "is_tail", (F.col("offset") + F.col("n")).alias("no"))
    earlier = F.sum(F.when(F.col("ends") & ~F.col("is_tail"), 1).otherwise(0)).over(_in_order().rowsBetween(_FIRST, -1))
    nested = located.where("not flat").withColumn("no", F.col("offset") + F.coalesce(earlier, F.lit(0)) + 1).select(*numbered.columns)
    tails = numbered.where("is_tail").union(nested.where("is_tail")).select(FILE, (F.col("no") - 1).alias("no"), "value")
    joined = nested.where("not is_tail").groupBy(FILE, "no").agg(F.array_sort(F.collect_list(F.struct("split", "id", "value"))).alias("pieces"))
    records = numbered.where("not is_tail").select(FILE, "no", "value").union(joined.select(FILE, "no", F.array_join("pieces.value", "}").alias("value")))
    return records.withColumn("value", F.concat("value", F.lit("}"))), tails


def scan_json_array(spark: SparkSession, path: str, spec: SourceSpec) -> DataFrame:
    """A landed snapshot document: one JSON array of objects per file, numbered by place. Fields a document
    lacks are NULL. A document that is anything else, say an error report, fails the job; a file without a byte is no
    document."""
    records, tails = _json_records(spark, path)
    wrong = F.raise_error(F.concat(FILE, F.lit(" is not a JSON array of objects")))
    lead = F.regexp_extract("value", f"^{_WS}([\\[,])", 1)
    led = F.when(lead == F.when(F.col("no") == 1, "[").otherwise(","), F.regexp_replace("value", f"^{_WS}[\\[,]", "")).otherwise(wrong)
    parsed = intake.parse_json_lines(records.select(FILE, "no", led.alias("value")), spec.payload_schema)
    sound = F.when(F.col("_malformed"), wrong.cast("bigint")).otherwise(F.col("no").cast("bigint"))
    rows = parsed.select(*spec.payload, FILE, sound.alias(ROW_NUMBER))

    empty = F.when(F.col("no") == 0, F.col("value").rlike(f"^{_WS}\\[{_WS}\\]{_WS}\\z")).otherwise(F.col("value").rlike(f"^{_WS}\\]{_WS}\\z"))
    checks = tails.select(FILE, empty.alias("fine"))
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    return rows.union(checks.where(F.when(F.col("fine"), F.lit(False)).otherwise(wrong.cast("boolean"))).select(*none))
