"""SimHash fingerprints and components against all pairs."""

import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from helpers import DOCS, empty, messy

from tomelight.llm import simhash

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UPPER))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_labels(values, names):
    """The smallest name that each value's links reach; equal values share one vertex."""
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= 4:
            parent[root(a)] = root(b)
    least = {}
    for v, n in zip(values, names, strict=True):
        if n is not None:
            least[root(v)] = min(n, least.get(root(v), n))
    return [least.get(root(v)) for v in values]


def brute(rows):
    values = [brute_fingerprint(t) for _, t in rows]
    found = brute_labels(values, [i for i, _ in rows])
    return sorted(((i, f"{v:016x}", c) for (i, _), v, c in zip(rows, values, found, strict=True)), key=repr)


def near(df, **options):
    rows = simhash.near_copies(df, **options)
    assert rows.columns == ["doc_id", "fingerprint", "component_id"]
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def test_index_has_a_triple_in_every_four():
    triples = [set(t) for t in simhash.triples()]
    assert len(triples) == 20
    assert all(any(t <= set(four) for t in triples) for four in combinations(range(8), 4))


def test_fingerprints_of_edited_texts(spark):
    rng = np.random.default_rng(1)
    words = [f"Word{i}" for i in range(200)]
    rows = []
    for i in range(60):
        base = list(rng.choice(words, rng.integers(1, 150)))
        for j in range(3):
            edited = [w if rng.random() > 0.02 * j else "Edit" for w in base]
            rows.append((10 * i + j, "  ".join(edited) if i % 7 else "\x0b".join(edited)))
    assert near(spark.createDataFrame(rows, DOCS)) == brute(rows)


def signed(values):
    return [v - 2**64 if v >= 2**63 else v for v in values]


def clustered(n, seed):
    """Fingerprints around a few centres, linked by chains and at the limit of distance."""
    rng = np.random.default_rng(seed)
    centres = [int(x) for x in rng.integers(0, 2**63, 12)]
    out = set()
    while len(out) < n:
        v = centres[int(rng.integers(len(centres)))]
        for bit in rng.choice(64, rng.integers(0, 7), replace=False):
            v ^= 1 << int(bit)
        out.add(v)
    return sorted(out)


@pytest.mark.parametrize("group", [simhash.GROUP, 8, 2])
def test_links_reach_what_all_pairs_reach(spark, group):
    values = clustered(700, 5)
    found = simhash.links(spark.createDataFrame([(v,) for v in signed(values)], "bits long"), group=group)
    pairs = {(r.a % 2**64, r.b % 2**64) for r in found.collect()}
    assert all(a != b and (a ^ b).bit_count() <= 4 for a, b in pairs)
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        parent[root(a)] = root(b)
    expected = brute_labels(values, values)
    groups = {}
    for v in values:
        groups.setdefault(root(v), []).append(v)
    assert sorted(map(min, groups.values())) == sorted(set(expected))
    assert [min(groups[root(v)]) for v in values] == expected


def test_every_spoilt_choice_of_bytes_is_found(spark):
    base = 0x0123456789ABCDEF
    values = {base} | {base ^ sum(1 << (8 * i + i % 8) for i in four) for four in combinations(range(8), 4)}
    rows = spark.createDataFrame([(v,) for v in signed(values)], "bits long")
    for group in (simhash.GROUP, 1):
        pairs = {frozenset((r.a % 2**64, r.b % 2**64)) for r in simhash.links(rows, group=group).collect()}
        linked, todo = {base}, [base]
        while todo:
            v = todo.pop()
            for pair in pairs:
                if v in pair:
                    todo += pair - linked
                    linked |= pair
        assert linked == values


def test_messy_rows(spark):
    df = messy(spark, [(8, "one"), (None, "another row without an id"), (0, " \t\n"), (9, "ONE")])
    assert near(df) == brute([(r.doc_id, r.text) for r in df.collect()])
    assert near(empty(spark)) == []


def test_given_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert near(df) == brute([tuple(r) for r in df.collect()])
