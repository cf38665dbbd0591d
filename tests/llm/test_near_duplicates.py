"""Lattice hashing, SimHash and components against brute force."""

import random

import numpy as np
import pandas as pd
import pytest

from conftest import SF_DIR
from sessionloom.llm import golay_simhash as gs
from sessionloom.llm import lattice_dedup as ld
from sessionloom.llm.buckets import components, forest


def union(n, edges):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(200, 201), (201, 202), (202, 200)]
    edges += [(rng.randint(300, 420), rng.randint(300, 420)) for _ in range(90)] + [(500, 500)]
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = union(501, edges)
    touched = {x for e in edges if e[0] != e[1] for x in e}
    assert {n: got.get(n, n) for n in touched} == {n: want[n] for n in touched}


def test_forest_matches_union_find():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 300, 200), rng.integers(0, 300, 200)
    assert forest(a, b, 300).tolist() == union(300, zip(a.tolist(), b.tolist()))


def test_golay_code_is_perfect_and_keys_miss_no_linked_pair():
    parts, near, number = gs.golay_tables()
    weight = np.bitwise_count(near[:, 0])
    assert len(near) == 2048 and weight.max() == 3 and number.min() >= 1
    rng = np.random.default_rng(3)
    x = rng.integers(-(2**63), 2**63 - 1, 3000)
    flips = np.zeros(3000, np.uint64)
    for k in range(3000):
        for bit in rng.choice(64, rng.integers(0, 4), replace=False):
            flips[k] |= np.uint64(1 << int(bit))
    y = (x.view(np.uint64) ^ flips).view(np.int64)
    at, key, indexed = gs.golay_keys(x)
    index = set(zip(at[indexed].tolist(), key[indexed].tolist()))
    at, key, indexed = gs.golay_keys(y)
    met = {p for p, k in zip(at[~indexed].tolist(), key[~indexed].tolist()) if (p, k) in index}
    assert len(met) == 3000


def brute_fingerprint(text):
    import xxhash

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", "A", "a B", "One two\x0bthree FOUR", "é È x\x1fy z w", "q " * 500])
def test_fingerprint_matches_definition(text):
    assert gs.text_fingerprint(text) & (2**64 - 1) == brute_fingerprint(text)


def brute_groups(pairs):
    """(doc_id, fingerprint) -> component of each row."""
    prints = sorted({f for _, f in pairs})
    edges = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    label = dict(zip(prints, union(len(prints), edges)))
    ids = {}
    for d, f in pairs:
        if d is not None:
            ids[label[f]] = min(ids.get(label[f], d), d)
    return [(d, f"{f:016x}", ids.get(label[f])) for d, f in pairs]


def ordered(rows):
    return sorted(rows, key=repr)


def test_simhash_components_of_odd_rows(odd, none):
    got = [tuple(r) for r in gs.simhash_components(odd).collect()]
    pairs = [(r["doc_id"], brute_fingerprint(r["text"] or "")) for r in odd.select("doc_id", "text").collect()]
    assert ordered(got) == ordered(brute_groups(pairs))
    assert gs.simhash_components(none).count() == 0


def test_close_fingerprints_in_one_large_group_link(spark):
    rng = random.Random(4)
    base, prints = rng.getrandbits(64), []
    for d in range(2500):  # chains of small steps from one centre: one hot bucket
        f = base
        for b in rng.sample(range(64), rng.randint(0, 2)):
            f ^= 1 << b
        prints.append((d, f))
    prints += [(5000 + d, rng.getrandbits(64)) for d in range(300)]
    signed = [(d, f - (1 << 64) if f >> 63 else f) for d, f in prints]
    got = gs.fingerprint_groups(spark.createDataFrame(signed, "doc_id long, fingerprint long")).collect()
    have = {r["fingerprint"] & (2**64 - 1): r["component_id"] for r in got}
    want = {int(f, 16): c for _, f, c in brute_groups(prints)}
    assert have == want


def test_one_document_of_each_group_stays(odd):
    kept = gs.one_per_group(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    groups = {(r["component_id"]) for r in gs.simhash_components(odd).collect() if r["component_id"] is not None}
    assert sorted(i for i in ids if i is not None) == sorted(groups)
    assert ids.count(None) == 2


def near(rng, base, cosine):
    other = rng.normal(size=base.shape)
    other -= (other * base).sum(1, keepdims=True) * base
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    return cosine * base + np.sqrt(1 - cosine**2) * other


def unit(rng, n, dims=64):
    x = rng.normal(size=(n, dims))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_nearest_point_and_short_vectors():
    rng = np.random.default_rng(5)
    y = rng.normal(size=(500, 8)) * 2
    p, short = ld.nearest_point(y), ld.short_vectors()
    assert short.shape == (240, 8) and np.allclose((short**2).sum(1), 2)
    own = ((y - p) ** 2).sum(1)
    assert (own <= 1 + 1e-9).all()
    assert all((own <= ((y - p - v) ** 2).sum(1) + 1e-9).all() for v in short)


@pytest.mark.parametrize(("cosine", "least"), [(0.95, 0.96), (0.97, 0.998), (0.985, 0.9995)])
def test_recall_of_the_cells(cosine, least):
    rng = np.random.default_rng(6)
    a = unit(rng, 4000)
    x, y = ld.cells(a), ld.cells(near(rng, a, cosine))
    met = (x[:, :, :1] == y).any(axis=(1, 2)) | (y[:, :, :1] == x).any(axis=(1, 2))
    assert met.mean() >= least


def brute_vectors(frame):
    x = np.stack(frame["embedding"]).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    root = union(len(x), zip(*np.nonzero(link)))
    ids = frame["vec_id"].to_numpy()
    least = pd.Series(ids).groupby(root).transform("min").to_numpy()
    return sorted(zip(ids.tolist(), link.sum(1).tolist(), least.tolist()))


def result(df):
    return sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in df.collect())


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(7)
    x = unit(rng, 400)
    copies = np.repeat(x[:3], [30, 5, 2], axis=0)
    x = np.concatenate([x, near(rng, x[:100], 0.985), copies, near(rng, np.repeat(x[5:6], 700, axis=0), 0.99), 3.5 * x[50:60]])
    frame = pd.DataFrame({"vec_id": rng.permutation(len(x)), "embedding": list(x.astype(np.float32))})
    table = spark.createDataFrame(frame, "vec_id long, embedding array<float>")
    assert result(ld.lattice_components(table, 64)) == brute_vectors(frame)


def test_vectors_of_the_test_table_match_brute_force(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    assert result(ld.lattice_components(table, ld.common_length(table))) == brute_vectors(table.toPandas())


def test_odd_vectors(spark):
    good = [1.0, 2.0, 3.0, 4.0]
    rows = [
        (1, good), (2, good), (2, good), (3, [0.0] * 4), (4, None), (5, []), (6, [1.0, None, 2.0, 3.0]),
        (7, [float("nan"), 1.0, 1.0, 1.0]), (8, [float("inf"), 1.0, 1.0, 1.0]), (9, [2.0, 4.0, 6.0, 8.0]), (10, [1.0, 2.0]),
        (None, good), (11, [-1.0, -2.0, -3.0, -4.0]),
    ]
    table = spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id long, embedding array<float>, node string, links int")
    assert ld.common_length(table) == 4
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in ld.lattice_components(table, 4).collect()), key=repr)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 10, 11)]
    linked = [(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (9, 4, 1, False), (None, 4, 1, True)]
    assert got == sorted(alone + linked, key=repr)
    empty = table.limit(0)
    assert ld.common_length(empty) == 0 and ld.lattice_components(empty, 4).count() == 0
