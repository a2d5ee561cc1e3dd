import csv
import io
import json
import random

import pytest

from tidemark.operators import intake
from tidemark.schemas import SOURCES
from tidemark.sources import files

REGIONS = SOURCES["regions"]


def test_csv_cells(spark, write_lines):
    path = write_lines("r.csv", "region_id,region_name,country", 'RG1,"North ""A""",US', "RG2,,CA", "RG3,Short", "RG4,Long,MX,surplus")
    got = files.scan_csv(spark, path, REGIONS).orderBy("source_row_number").collect()
    assert [(r.region_id, r.region_name, r.country, r.source_row_number) for r in got] == [
        ("RG1", 'North "A"', "US", 2), ("RG2", None, "CA", 3), ("RG3", "Short", None, 4), ("RG4", "Long", "MX", 5)
    ]


def test_csv_header_order_and_line_breaks(spark, write_lines):
    path = write_lines("m.csv", "country,region_id,region_name,extra", 'US,RG1,"two', 'lines",x', "CA,RG2,one,y")
    got = files.scan_csv(spark, path, REGIONS, multiline=True).orderBy("source_row_number").collect()
    assert [(r.region_id, r.region_name, r.country, r.source_row_number) for r in got] == [
        ("RG1", "two\nlines", "US", 2), ("RG2", "one", "CA", 3)
    ]


def test_line_numbers_survive_splitting(spark, write_lines, tmp_path):
    for f in range(3):
        write_lines(f"n/{f}.ndjson", *[f"{f}-{i}" if i % 7 else "" for i in range(1, 4001 + f)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = files.scan_ndjson_lines(spark, str(tmp_path / "n"))
        assert spark.read.text(str(tmp_path / "n")).rdd.getNumPartitions() > 6
        got = lines.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 4000 + 4001 + 4002
    assert all(r.value == "" or r.value.split("-")[1] == str(r.source_row_number) for r in got)
    assert {(r.source_file[-8:], r.source_row_number) for r in got} == {
        (f"{f}.ndjson", i) for f in range(3) for i in range(1, 4001 + f)
    }


def test_ndjson_splits_good_from_malformed(spark, write_lines):
    good = json.dumps({"region_id": "RG1", "region_name": "N", "country": {"iso": "US"}, "surplus": 1})
    path = write_lines("d.ndjson", good, '{"region_id": "RG', "garbage", "", "[1]", "  " + good + "\t", '"text"', "x" * 3000, "7", "null")
    parsed = intake.parse_json_lines(files.scan_ndjson_lines(spark, path), REGIONS.payload_schema)
    valid = parsed.where("not _malformed").orderBy("source_row_number").collect()
    assert [(r.region_id, r.country, r.source_row_number) for r in valid] == [("RG1", '{"iso":"US"}', 1), ("RG1", '{"iso":"US"}', 6)]
    bad = intake.malformed_entries(parsed, "source_file", "source_row_number").orderBy("source_row_number").collect()
    assert [r.source_row_number for r in bad] == [2, 3, 5, 7, 8, 9, 10]
    assert {r.reason for r in bad} == {"malformed_json"} and len(bad[4].raw_record) == 3000


def test_json_array_versions(spark, write_lines, tmp_path):
    write_lines("p/v1.json", json.dumps([{"product_id": "P1", "name": "a", "category": "c", "price_cents": 5, "active": True}]))
    write_lines("p/v2.json", json.dumps([{"product_id": "P2", "brand": "B"}, {"product_id": "P3"}]))
    got = files.scan_json_array(spark, str(tmp_path / "p"), SOURCES["products"]).orderBy("product_id").collect()
    assert [(r.product_id, r.brand, r.price_cents, r.source_row_number) for r in got] == [
        ("P1", None, "5", 1), ("P2", "B", None, 1), ("P3", None, None, 2)
    ]


def test_numbers_hold_when_parallelism_changes_after_the_call(spark, write_lines, tmp_path):
    for f in range(2):
        write_lines(f"late/{f}.ndjson", *[f"{f}-{i}" for i in range(1, 30_001)])
    names = ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")
    try:
        for name, value in zip(names, ("2", "1024", "134217728")):
            spark.conf.set(name, value)
        lines = files.scan_ndjson_lines(spark, str(tmp_path / "late"))
        for name, value in zip(names, ("9", "1024", "20000")):
            spark.conf.set(name, value)
        got = lines.collect()
    finally:
        for name in names:
            spark.conf.unset(name)
    assert len(got) == 60_000 and all(r.value == f"{r.source_file[-8]}-{r.source_row_number}" for r in got)


def test_csv_files_of_different_headers(spark, write_lines, tmp_path):
    write_lines("c/1.csv", "region_id,region_name,country", 'RG1,"two', 'lines",US')
    write_lines("c/2.csv", "country,region_id,region_name", "FR,RG2,south", "DE,RG3,")
    write_lines("c/3.csv", "region_name,surplus,region_id", "west,x,RG4")
    got = files.scan_csv(spark, str(tmp_path / "c"), REGIONS).orderBy("region_id").collect()
    assert [(r.region_id, r.region_name, r.country, r.source_row_number, r.source_file[-5:]) for r in got] == [
        ("RG1", "two\nlines", "US", 2, "1.csv"), ("RG2", "south", "FR", 2, "2.csv"), ("RG3", None, "DE", 3, "2.csv"), ("RG4", "west", None, 2, "3.csv")
    ]


def test_lines_that_are_not_exactly_one_object(spark):
    lines = [
        '{"region_id":"a"} xyz', '{"region_id":"a"}{"region_id":"b"}', "{'region_id':'a'}", '{"region_id":"a"},{"region_id":"b"}', '{"region_id":NaN}', '{"region_id":"a"}]',
        '{"region_id":"a"', "{}", '{"region_id":null,"country":[1,{"x":2}]}', '{"region_id":"é \\" ]}"}',
    ]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "n int, value string")
    rows = {r.n: r for r in intake.parse_json_lines(frame, REGIONS.payload_schema).collect()}
    assert [rows[i]._malformed for i in range(10)] == [True] * 7 + [False] * 3
    assert (rows[8].region_id, rows[8].country, rows[9].region_id) == (None, '[1,{"x":2}]', 'é " ]}')


@pytest.mark.parametrize("document", ['{"detail":"Service Unavailable"}', '[{"product_id":"P1"}] x', "[1]", '[{"product_id":"P1"}'])
def test_a_document_that_is_no_array_of_objects_fails(spark, tmp_path, document):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "d.json").write_text(document + "\n")
    with pytest.raises(Exception, match="is not a JSON array of objects"):
        files.scan_json_array(spark, str(tmp_path / "bad"), SOURCES["products"]).collect()


@pytest.fixture()
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def csv_text(seed, records, end):
    """Random cells with quotes, commas and line breaks, as the csv module writes them, and the cells."""
    random.seed(seed)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    header = ["surplus", "region_id", "country", "region_name"]
    cells = [["".join(random.choices(["a", "é", " ", '"', ",", "\n", "\r\n", "bc"], k=random.randint(0, 9))) for _ in header] for _ in range(records)]
    writer.writerow(header)
    for k, row in enumerate(cells):
        row[1] = f"R{k}"
        writer.writerow(row)
        if k % 7 == 3:
            out.write(end)  # a blank line between records
    return out.getvalue(), cells


@pytest.mark.parametrize(("seed", "end"), [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_csv_of_many_splits(spark, tmp_path, small_splits, seed, end):
    (tmp_path / "c").mkdir()
    want = {}
    for f in range(3):
        text, cells = csv_text(seed * 10 + f, 120 * f + 40, end)
        (tmp_path / "c" / f"{f}.csv").write_bytes((b"\xef\xbb\xbf" if f == 1 else b"") + text.encode())
        want |= {(f"{f}.csv", k + 2): tuple(row[i] or None for i in (1, 3, 2)) for k, row in enumerate(cells)}
    got = files.scan_csv(spark, str(tmp_path / "c"), REGIONS).collect()
    assert spark.read.text(str(tmp_path / "c")).rdd.getNumPartitions() > 20
    assert {(r.source_file[-5:], r.source_row_number): (r.region_id, r.region_name, r.country) for r in got} == want and len(got) == len(want)


def test_csv_quotes_inside_a_cell_open_nothing(spark, write_lines, small_splits):
    path = write_lines("q.csv", "region_id,region_name,country", *(f'R{k},5" pipe,US' for k in range(50)), 'RX,"two', 'lines",US')
    got = files.scan_csv(spark, path, REGIONS).orderBy("source_row_number").collect()
    assert [(r.region_id, r.region_name, r.country) for r in got] == [(f"R{k}", '5" pipe', "US") for k in range(50)] + [("RX", "two\nlines", "US")]


def test_csv_record_over_many_splits(spark, write_lines, small_splits):
    inner = "\n".join(f"line {k}" for k in range(300))
    path = write_lines("long.csv", "region_id,region_name,country", "R1,a,US", f'R2,"{inner}",US', "R3,b,US")
    got = files.scan_csv(spark, path, REGIONS).orderBy("source_row_number").collect()
    assert [(r.region_id, r.region_name, r.source_row_number) for r in got] == [("R1", "a", 2), ("R2", inner, 3), ("R3", "b", 4)]
    loose = files.scan_csv(spark, path, REGIONS, multiline=False)
    assert loose.count() == 302


@pytest.mark.parametrize(("seed", "indent"), [(1, None), (2, 1), (3, None)])
def test_json_array_of_many_splits(spark, tmp_path, small_splits, seed, indent):
    random.seed(seed)
    (tmp_path / "j").mkdir()
    want = {}
    for f in range(3):
        records = []
        for k in range(150 * f):
            text = "".join(random.choices(['"', "\\", "{", "}", "]", "[", ",", "é", "\n", "x"], k=random.randint(0, 12)))
            record = {"product_id": f"P{k}", "name": text, "price_cents": k}
            if seed == 2 or k % 50 == 7:
                record["extra"] = {"deep": [{"a": text}, [{}]]}
            records.append(record)
        (tmp_path / "j" / f"{f}.json").write_text(json.dumps(records, indent=indent, ensure_ascii=False) + " \n")
        want |= {(f"{f}.json", k + 1): (r["product_id"], r["name"], str(r["price_cents"])) for k, r in enumerate(records)}
    got = files.scan_json_array(spark, str(tmp_path / "j"), SOURCES["products"]).collect()
    assert {(r.source_file[-6:], r.source_row_number): (r.product_id, r.name, r.price_cents) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("document", ["[}", "[{}}", "[{},]", "{}", '[{"a":1} {"a":2}]', '[[{"a":1}]]', "[", "]", '[{"a":1}]]', '[{"a":"}"', "[{}]\n[{}]", "[,{}]"])
def test_documents_that_are_no_array(spark, tmp_path, document, small_splits):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "d.json").write_text(document)
    with pytest.raises(Exception, match="is not a JSON array of objects"):
        files.scan_json_array(spark, str(tmp_path / "bad"), SOURCES["products"]).collect()
