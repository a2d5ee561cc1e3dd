"""The manifest against a plain one, built node by node in Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes):
    """The last node, and for each leaf the (left, right) siblings on its way."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, pos in enumerate(at):
            run = pos // 3 * 3
            paths[k].append((nodes[run:pos], nodes[pos + 1 : run + 3]))
            at[k] = pos // 3
        nodes = [sha(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def plain_manifest(rows):
    """{doc_id: (leaf, subroot, root, proof_sha256, folded_root, verified)}; doc_ids differ."""
    groups = {}
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([plain_leaf(r) for r in groups[s]]) for s in names}
    root, tops = plain_tree([trees[s][0] for s in names])
    out = {}
    for s, top in zip(names, tops):
        for row, path in zip(groups[s], trees[s][1]):
            path = path + top
            text = row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            folded = plain_leaf((*row[:4], text))
            for left, right in path:
                folded = sha(*left, folded, *right)
            proof = sha(*(h for left, right in path for h in left + right))
            out[row[0]] = (plain_leaf(row), trees[s][0], root, proof, folded, folded == root)
    return out


def of_query(spark, rows, tmp_path):
    folder = str(tmp_path / "sf")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return {r.doc_id: tuple(r)[1:] for r in queries.registered()["op12_merkle"](spark, folder).collect()}


@pytest.mark.parametrize("sizes", [[1], [2], [3, 1], [4, 81, 82], [9, 27, 28, 243, 244], [729, 730, 2200], [700, 5, 1, 1, 1, 1, 1, 1, 1, 1]])
def test_trees_of_all_shapes(spark, tmp_path, sizes):
    rows = [(1000 * k + i * 3, f"s{k:03}", "en", i, f"text {i}\nof {k}") for k, n in enumerate(sizes) for i in range(n)]
    assert of_query(spark, rows, tmp_path) == plain_manifest(rows)


def test_many_groups(spark, tmp_path):
    rows = [(i, f"host{i % 300}", None, None, "a\nb" if i % 2 else None) for i in range(700)]
    assert of_query(spark, rows, tmp_path) == plain_manifest(rows)


def test_odd_rows(spark, tmp_path):
    rows = [
        (None, None, None, None, None), (1, None, "", 0, ""), (-5, None, None, 3, "é\n漢"), (2, "", None, None, "\n"), (3, "é", "en", 9, "x" * 300_000),
        (4, "z", "en", 9, "12:3"), (5, "\U0001f600", None, -1, "a\r\nb"), (6, "ﬀ", None, 1, "\n\n"),
    ]
    assert of_query(spark, rows, tmp_path) == plain_manifest(rows)
    assert of_query(spark, [], tmp_path) == {}


def test_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "s", "en", 1, "t")] * 5 + [(None, "s", "en", 1, "t")] * 4
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("tree", "idx", "place", "h", "top", "data", "key")})
    manifest = merkle.build(docs)
    found = merkle.climb(spark, manifest).collect()
    assert sorted((r.key or 0 for r in found)) == [0] * 4 + [1] * 5 and all(r.verified for r in found)
    root, paths = plain_tree([plain_leaf(r) for r in rows[5:] + rows[:5]])
    assert {r.root for r in found} == {root} == {manifest.root()}
    assert sorted(r.proof_sha256 for r in found) == sorted(sha(*(h for a, b in p for h in a + b)) for p in paths)


def test_a_changed_row_does_not_verify(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, f"t{i}") for i in range(100)], SCHEMA)
    changed = F.when(F.col("doc_id") == 7, F.lit("de")).otherwise(F.col("lang"))
    found = merkle.climb(spark, merkle.build(docs, received={"lang": changed})).where("not verified").collect()
    assert [r.key for r in found] == [7] and found[0].folded_root != found[0].root


def test_query_over_all_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = queries.registered()["op12_merkle"](spark, SF)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    have = {r.doc_id: tuple(r)[1:] for r in found.collect()}
    assert have == plain_manifest(docs) and 0 < sum(not v[-1] for v in have.values()) < len(have)
