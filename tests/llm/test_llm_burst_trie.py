"""The trie against a plain one over all prefixes."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import burst_trie, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WORDS = re.compile("[^\x20\x09-\x0d]+")


def plain_rebuilt(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = turns.get(c // 20 * 20, [])[:h] + own[h:]
    return out


def plain_trie(sequences):
    """{(conv_id, depth): other columns}"""
    members, ends = {}, {}
    for c, turns in sorted(sequences.items()):
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    totals, out = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = [totals[p] for p in children.get(path, [])]
        own = (len(members[path]) - 1) * len(WORDS.findall(path[-1][1])) if path else 0
        totals[path] = (sum(t[0] for t in below) or 1, own + sum(t[1] for t in below))
        sha = hashlib.sha256(",".join(map(str, ends.get(path, []))).encode()).hexdigest()
        parent = min(members[path[:-1]]) if path else None
        out[min(members[path]), len(path)] = (parent, len(members[path]), len(children.get(path, [])), *totals[path], sha)
    return out


def as_dict(df):
    rows = df.collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def of_sequences(spark, sequences, **how):
    rows = [(c, k, "user", text) for c, texts in sequences.items() for k, text in enumerate(texts)]
    turns = burst_trie.numbered_turns(spark.createDataFrame(rows, SCHEMA))
    convs = spark.createDataFrame([(c,) for c in sequences], "conv_id bigint")
    return as_dict(burst_trie.trie(spark, turns, convs, **how)), plain_trie({c: [("user", t) for t in texts] for c, texts in sequences.items()})


@pytest.mark.parametrize(("limit", "ahead"), [(1, (1, 2)), (5, (1, 2, 3)), (40, (1, 8)), (10**6, (1,))])
def test_random_tries(spark, limit, ahead):
    random.seed(limit)
    sequences = {c * 7 - 500: [random.choice("ab") * random.choice([1, 1, 1, 2]) + " w" * random.randint(0, 1) for _ in range(random.randint(0, 9))] for c in range(300)}
    have, want = of_sequences(spark, sequences, limit=limit, ahead=ahead)
    assert have == want


def test_comb_of_snapshots_copies_and_long_conversations(spark):
    talk = [f"turn {k}" for k in range(90)]
    sequences = {k: talk[:k] for k in range(91)}  # one conversation, logged after each turn
    sequences |= {1000 + k: ["same", "words in all", "copies"] for k in range(200)}
    sequences |= {2000 + k: ["alone", *(f"long {j}" for j in range(300))] for k in range(2)}
    sequences |= {3000: ["alone", *(f"long {j}" for j in range(150)), "other end"]}
    for limit in (20, 200):
        have, want = of_sequences(spark, sequences, limit=limit)
        assert have == want


def test_blocks_of_long_conversations_and_of_many_ids(spark, monkeypatch):
    monkeypatch.setattr(burst_trie, "_BLOCK", 16)
    rows = [(1, 3 * k if k % 5 else -k, None, f"t{k}") for k in range(100)] + [(c * 5000, 1, "r", "hello you") for c in range(1, 40)]
    turns = burst_trie.numbered_turns(spark.createDataFrame(rows, SCHEMA))
    convs = spark.createDataFrame([(1,)] + [(c * 5000,) for c in range(1, 40)], "conv_id bigint")
    ordered = sorted((r for r in rows if r[0] == 1), key=lambda r: r[1])
    want = plain_trie({1: [("", r[3]) for r in ordered]} | {c * 5000: [("r", "hello you")] for c in range(1, 40)})
    assert as_dict(burst_trie.trie(spark, turns, convs, limit=10)) == want


def query(spark, rows, tmp_path):
    folder = str(tmp_path / "sf")
    spark.createDataFrame(rows, SCHEMA).withColumns({"seq": F.lit(1), "key": F.lit("k"), "Words": F.lit(0)}).write.mode("overwrite").parquet(f"{folder}/conversations.parquet")
    return as_dict(queries.registered()["op11_prefix_trie"](spark, folder))


def test_odd_rows(spark, tmp_path):
    rows = [(c, t, "user" if t else None, "a b  c\n" if t % 2 else None) for c in (20, 21, 22, 23, 24, 47, 48, 0, 1, 2) for t in range(c % 5)]
    rows += [(60, None, "r", "first"), (60, 2, "r", "x" * 200_000), (60, -1, "", ""), (61, 0, "r", "only"), (None, 1, "r", "t"), (None, None, None, None)]
    rows += [(62, 1, "r", "twice")] * 2
    assert query(spark, rows, tmp_path) == plain_trie(plain_rebuilt(rows))
    assert query(spark, [], tmp_path) == {}
    assert query(spark, [(5, 1, "r", "gone")], tmp_path) == plain_trie(plain_rebuilt([(5, 1, "r", "gone")]))


def test_query_over_all_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = queries.registered()["op11_prefix_trie"](spark, SF)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert as_dict(found) == plain_trie(plain_rebuilt(rows))
