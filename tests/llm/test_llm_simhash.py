"""SimHash: fingerprints by hand, tiles against all pairs, components against union-find."""

import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import components


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints(spark):
    texts = [None, "", " \t\n", "One", "One two", "one TWO three", "É é ſ K a\u2003b", "the cat sat on the mat " * 30, "w " * 40_000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, fp int")
    assert {r.doc_id: r.fp % 2**64 for r in simhash.fingerprints(docs).collect()} == {i: plain_fingerprint(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("parts", [2, 4, 8])
def test_links_are_those_of_all_pairs(spark, monkeypatch, parts):
    monkeypatch.setattr(simhash, "_parts", lambda count: parts)
    monkeypatch.setattr(simhash, "_BLOCK", 4)
    monkeypatch.setattr(simhash, "_SLAB", 8)
    draw = random.Random(parts)
    values = {0, 2**64 - 1, 1}
    for _ in range(60):
        value = draw.getrandbits(64)
        for _ in range(draw.choice([1, 1, 2, 8])):
            values.add(value)
            for bit in draw.sample(range(64), draw.choice([1, 2, 3])):
                value ^= 1 << bit
    values = sorted(values)
    near = [(i, j) for i, a in enumerate(values) for j, b in enumerate(values) if i < j and (a ^ b).bit_count() <= 2]
    nodes = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v, i) for i, v in enumerate(values)], "fp bigint, node bigint")
    found = {tuple(sorted(r)) for r in simhash.links(nodes).collect()}
    assert plain_components(found, range(len(values))) == plain_components(near, range(len(values)))
    roots = plain_components(near, range(len(values)))
    assert all(roots[a] == roots[b] for a, b in found)


def test_a_forest_has_a_row_for_each_member_at_most():
    home = np.array([1 << (k % 2) for k in range(2)] + [3, 0], np.uint64)
    members, roots = simhash.forest(home, home, 2)
    assert len(members) == 7 and set(roots) == {0}


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 201), (201, 202), (202, 200), (5, 5), (300, None)]
    draw = random.Random(1)
    edges += [(draw.randrange(1000, 1100), draw.randrange(1000, 1100)) for _ in range(90)]
    frame = spark.createDataFrame([e if draw.random() < 0.5 else e[::-1] for e in edges], "x bigint, y bigint")
    kept = [e for e in edges if None not in e and e[0] != e[1]]
    nodes = {n for e in kept for n in e}
    want = plain_components(kept, nodes)
    assert {r.node: r.component for r in components(frame).collect() if r.node != r.component} == {n: c for n, c in want.items() if n != c}


def test_groups_of_documents(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon " * 20
    rows = [(10, base), (4, base + "x"), (7, base.upper()), (3, ""), (9, None), (8, "something else"), (None, base), (10, base)]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id bigint, text string, component_id string")
    fp = [plain_fingerprint(t) for _, t in rows]
    near = [(a, b) for (a, _), x in zip(rows, fp) for (b, _), y in zip(rows, fp) if a is not None and b is not None and (x ^ y).bit_count() <= 2]
    want = plain_components(near, {i for i, _ in rows if i is not None})
    out = simhash.near_groups(spark, docs).collect()
    assert sorted(map(repr, ((r.doc_id, r.fingerprint, r.component_id) for r in out))) == sorted(repr((i, f"{f:016x}", want.get(i))) for (i, _), f in zip(rows, fp))
    assert simhash.near_groups(spark, docs.limit(0)).collect() == []
