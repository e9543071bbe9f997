import random

import numpy as np
import pytest
import xxhash

from pairscope.llm import simhash as S
from pairscope.llm.components import components, forest

from .data import SCHEMA, edited, messy, messy_rows, union_find


def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("text", ["", None, "  \n", "A", "A b", "Foo bar baz", "x y z w q  r\n t é À x y z", "ab " * 3000, "a\x85b c d e"])
def test_fingerprint(text, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 100)
    assert S.fingerprint(text, 3) == plain_fingerprint(text)


def test_hash_is_sparks_xxhash64(spark):
    got = spark.sql("select xxhash64('foo bar baz') as h").first().h
    assert got == S.signed(xxhash.xxh64_intdigest(b"foo bar baz", 42))


def near_fingerprints(seed=3):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    out = set(base)
    for b in base[:20]:
        for _ in range(40):
            out.add(b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(1, 4))))
    return sorted(out)


G = [list(range(i * 16, i * 16 + 16)) for i in range(4)]
LAYOUTS = [([(G[0], 0), (G[1], 0), (G[2], 0), (G[3], 0)], 8192), ([(G[0], 0), (G[1], 0), (G[2], 0), (G[3], 0)], 7),
           ([(G[0] + G[1], 1), (G[2] + G[3], 1)], 8192), ([(G[0], 0), (G[1], 1), (G[2] + G[3], 0)], 20),
           ([(G[0] + G[1], 2), (G[2], -1), (G[3], 0)], 8192), ([(G[0], 1), (G[1], -1), (G[2], 0), (G[3], 0)], 8192)]


@pytest.mark.parametrize("layout", range(len(LAYOUTS) + 1))
def test_links_against_all_pairs(spark, layout):
    fps = near_fingerprints()
    roots = union_find(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    signed = [S.signed(f) for f in fps]
    smallest = {}
    for x, r in zip(signed, roots):
        smallest[r] = min(smallest.get(r, x), x)
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    parts, block = LAYOUTS[layout] if layout < len(LAYOUTS) else (S.choose_parts(nodes, 3), 8192)
    got = {r.node: r.root for r in components(S.links(nodes, parts, 3, block)).collect()}
    assert {x: got.get(x, x) for x in signed} == {x: smallest[r] for x, r in zip(signed, roots)}


def test_thresholds_meet_the_pigeonhole_sum():
    counts = np.zeros((4, 4))
    counts[0] = [1e9, 2e9, 3e9, 4e9]          # a skewed group is probed least
    for n in (10, 10 ** 6, 10 ** 10):
        parts = S.plan(G, counts, n, 3)
        assert sum(t for _, t in parts) == 3 - len(parts) + 1
        assert sorted(b for bits, _ in parts for b in bits) == list(range(64))
    assert S.allocate([[0, 5, 9], [0, 1, 2]], 0) == (2.0, [-1, 1])


def test_distance_counts_against_all_pairs():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 16, 300)
    values[:100] = values[0] ^ (1 << rng.integers(0, 16, 100))
    got = S.distance_counts(np.bincount(values, minlength=1 << 16), 3)
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    assert [int(round(g)) for g in got] == [int((apart == d).sum()) for d in range(4)]


def test_correlated_bits_share_a_group():
    rng = np.random.default_rng(2)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, 40] = bits[:, 3]
    bits[:, 59] = bits[:, 3]
    both = (bits.T @ bits).astype(float)
    group = next(g for g in S.group_bits(both, 4000) if 3 in g)
    assert {3, 40, 59} <= set(group)


def brute_groups(rows):
    fps = [plain_fingerprint(r[1]) for r in rows]
    roots = union_find(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    least = {}
    for r, root in zip(rows, roots):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    return sorted((str(r[0]), f, least.get(root)) for r, f, root in zip(rows, fps, roots)), len(set(roots))


def near_rows(spark):
    rng = random.Random(5)
    rows = messy_rows(spark)
    return rows + [(20_000 + k, edited(rng, rows[k % 10][1] or "", 0.002), None, None, None) for k in range(60)]


def test_groups_of_messy_rows(spark):
    rows = near_rows(spark)
    got = S.simhash_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    want, _ = brute_groups(rows)
    assert sorted((str(r.id), r.fp % (1 << 64), r.component_id) for r in got) == want


def test_one_row_of_each_group_stays(spark):
    rows = near_rows(spark)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'old' as digest", "'old' as kept_id")
    kept = S.drop_near_duplicates(df)
    assert kept.columns == df.columns
    got = kept.collect()
    _, groups = brute_groups(rows)
    assert len(got) == groups and brute_groups([tuple(r) for r in got])[1] == groups


def test_nothing_in_nothing_out(spark):
    empty = messy(spark).limit(0)
    assert S.simhash_groups(empty).count() == 0 and S.drop_near_duplicates(empty).count() == 0


# -------------------------------------------------------------- components
@pytest.mark.parametrize("seed", range(3))
def test_components_against_union_find(spark, seed):
    rng = random.Random(seed)
    n = 400
    names = rng.sample(range(-10 ** 12, 10 ** 12), n)
    links = [(i, i + 1) for i in range(0, 150)] + [(200, j) for j in range(201, 300)]      # a chain and a star
    links += [(rng.randrange(300, n), rng.randrange(300, n)) for _ in range(60)] + [(5, 5), (7, 8), (8, 7)]
    roots = union_find(n, links)
    least = {}
    for i, r in enumerate(roots):
        least[r] = min(least.get(r, names[i]), names[i])
    df = spark.createDataFrame([(names[a], names[b]) for a, b in links] + [(None, 3)], "a long, b long").repartition(5)
    got = {r.node: r.root for r in components(df).collect()}
    assert {x: got.get(x, x) for x in names} == {x: least[r] for x, r in zip(names, roots)}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest_of_arrays():
    a, b = forest(np.array([5, 7, 9, 1]), np.array([7, 9, 11, 2]))
    assert dict(zip(a.tolist(), b.tolist())) == {7: 5, 9: 5, 11: 5, 2: 1}
