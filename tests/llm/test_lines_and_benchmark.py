import hashlib
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from pairscope.llm import decontaminate as D
from pairscope.llm import line_dedup as L

from .data import SCHEMA, edited, messy, messy_rows, union_find


# -------------------------------------------------------------- line dedup
def brute_lines(rows):
    def md5(t):
        return hashlib.md5((t or "").encode()).hexdigest()
    found = [(r[0], md5(r[1]), j, L.plain(t)) for r in rows for j, t in enumerate((r[1] or "").split("\n")) if L.plain(t)]
    lines = sorted({f[3] for f in found})
    number = {t: i for i, t in enumerate(lines)}
    grams, holders, links = [L.shingles(t) for t in lines], {}, []
    for i, s in enumerate(grams):
        both = Counter(j for g in s for j in holders.get(g, ()))
        links += [(i, j) for j, c in both.items() if c / (len(s) + len(grams[j]) - c) >= 0.8 - 1e-12]
        for g in s:
            holders.setdefault(g, []).append(i)
    roots = union_find(len(lines), links)
    first = {}
    for i, digest, j, t in found:
        place = (i is None, i or 0, digest, j)
        r = roots[number[t]]
        first[r] = min(first.get(r, place), place)
    out, seen = [], set()
    for r in rows:
        repeat = (r[0], md5(r[1])) in seen
        seen.add((r[0], md5(r[1])))
        stay, n, gone = [], 0, 0
        for j, t in enumerate((r[1] or "").split("\n")):
            p = L.plain(t)
            n += bool(p)
            if not p or not repeat and first[roots[number[p]]] == (r[0] is None, r[0] or 0, md5(r[1]), j):
                stay.append(t)
            else:
                gone += 1
        out.append((r[0], None if r[1] is None else "\n".join(stay), n, gone))
    return out


@pytest.mark.parametrize("block", [1024, 3])
def test_line_dedup_against_all_pairs(spark, block):
    rng = random.Random(4)
    rows = messy_rows(spark, 120)
    rows += [(30_000 + k, edited(rng, rng.choice(rows[:120])[1], 0.025), None, None, None) for k in range(50)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'old' as kept", "'old' as n_lines", "1 as copy", "2 as line_id")
    got = L.dedup_lines(df, block=block)
    assert set(got.columns) == {*SCHEMA.replace(",", "").split()[::2], "kept", "copy", "line_id", "n_lines", "n_dropped"}
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == Counter(brute_lines(rows))


def test_lines_that_share_half_a_hash_get_other_nodes():
    from pairscope.llm import bloom
    lines = [f"line number {i} with some words" for i in range(30)]
    halves = L.line_hashes(lines).tolist()
    collided = frozenset(a for a, _ in halves[:5])
    bits = np.zeros(1 << 17, np.uint8)
    for at in bloom.slots(np.array([a for a, _ in halves[:5]], np.int64).view(np.uint64), 20):
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    for shared in (collided, bloom.Bloom(bits, 20)):
        nodes = L.nodes_of(lines, shared)
        assert [n == a for n, (a, _) in zip(nodes, halves)] == [False] * 5 + [True] * 25 and len(set(nodes)) == 30
    assert L.nodes_of(lines, frozenset()) == [a for a, _ in halves]


def test_shingle_numbers_tell_shingles_apart():
    for lines in (["abcdefghij", "bcdefghijk", "abc", "abcdefg", "aaaaaaaaaaaaaa"], ["日本語のテキストです", "日本語のテキスト", "x"], ["a\0b", "abcdefghi", "a"]):
        got = [set(x.tolist()) for x in L.shingle_numbers(lines)]
        want = [L.shingles(t) for t in lines]
        assert [len(g) for g in got] == [len(w) for w in want]
        assert [[len(a & b) for a in got] for b in got] == [[len(a & b) for a in want] for b in want]


def test_signatures_do_not_depend_on_company():
    rng = random.Random(1)
    lines = ["ab", "abcdefg", "abcdefgh", "x" * 9] + ["".join(rng.choice("abcdef gh") for _ in range(rng.randrange(1, 400))) for _ in range(300)]
    lines.insert(7, "".join(rng.choice("abcdefgh ") for _ in range(3 * L.CHUNK + 5)))
    together = L.signatures(lines)
    assert all((L.signatures([t])[0] == together[i]).all() for i, t in enumerate(lines))


def test_signature_estimates_similarity():
    rng = random.Random(2)
    errors = []
    for _ in range(150):
        a = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(60))
        b = edited(rng, a, 0.03)
        x, y = L.shingles(a), L.shingles(b)
        s = L.signatures([a, b])
        errors.append((s[0] == s[1]).mean() - len(x & y) / len(x | y))
    assert abs(np.mean(errors)) < 0.02


@pytest.mark.parametrize("giant, frequent", [(40, 64), (10 ** 6, 64), (40, 3), (10 ** 6, 3)])
def test_buckets_over_batches_and_giants(monkeypatch, giant, frequent):
    monkeypatch.setattr(L, "GIANT", giant)
    monkeypatch.setattr(L, "FREQUENT", frequent)
    rng = np.random.default_rng(3)
    key = np.concatenate([rng.integers(0, 40, 100), np.full(80, 7)]) * 0x1234567890ABCDE
    node = rng.integers(0, 60, len(key))
    want = {(a, b) for g in pd.DataFrame({"k": key, "n": node}).groupby("k")["n"].apply(set) for a in g for b in g}
    sketch = np.stack([node, node * 3 + 1], axis=1).astype(np.uint64)
    parts = [L.packed(node[i:i + 20], key[i:i + 20, None], 5, sketch[i:i + 20]).to_pandas() for i in range(0, len(key), 20)]
    docs = [(15 + i, np.array([0, i], np.int32).tobytes(), np.array([7, 8, i, -i]).tobytes(), None if i == 3 else f"d{i}", i) for i in range(4)]
    rows = pd.concat([*parts, pd.DataFrame(docs, columns=L.PACKED.names)]).sort_values("chunk", kind="stable")
    for size in (1, 3, 1000):
        batches = (pa.RecordBatch.from_pandas(rows.iloc[i:i + size], L.PACKED, preserve_index=False) for i in range(0, len(rows), size))
        got = pd.concat([b.to_pandas() for b in L.gathered(batches, 5)])
        known = got[got["kind"] == L.SKETCH]
        assert sorted(known["node"]) == sorted(set(node.tolist()))
        assert (known["s0"] == known["node"]).all() and (known["s1"] == known["node"] * 3 + 1).all()
        lines = got[got["kind"] == L.LINE]
        assert sorted(zip(lines["digest"], lines["line"], lines["n"], lines["node"], lines["b"])) == sorted(
            x for i in range(4) for x in ((i, 0, 2, 7, 8), (i, i, 2, i, -i)))
        met = {(a, b) for g in got[got["kind"] == L.MEMBER].groupby("bucket")["node"].apply(set) for a in g for b in g}
        if giant > 1000 and frequent == 64:        # named by the smallest node: all that it meets is together
            assert met >= {(a, b) for a, b in want if (a, a) in met and (b, b) in met}
        assert {(a, b) for a, b in want if a != b} <= met
    assert not list(L.gathered(iter([]), 5))


@pytest.mark.parametrize("remembered", [3, 1 << 18])
def test_repeated_and_shared_nodes_are_found_over_tasks(monkeypatch, remembered):
    monkeypatch.setattr(L, "SEEN", remembered)
    rng = np.random.default_rng(5)
    node = rng.integers(-60, 60, 150)
    b = np.where(node % 5 == 0, rng.integers(0, 3, len(node)), node + 1)       # a fifth of the nodes is shared by other lines
    parts, new = [], []
    for i in range(0, len(node), 50):                                           # tasks of two batches
        seen = L.Seen()
        for j in (i, i + 25):
            first, hashes = seen.news(node[j:j + 25].tolist(), b[j:j + 25].tolist())
            new += node[j:j + 25][first].tolist()
            parts.append(L.packed_hashes(node[j:j + 25][hashes], b[j:j + 25][hashes], 5).to_pandas())
    rows = pd.concat(parts).sort_values("chunk", kind="stable")
    got = pd.concat([x.to_pandas() for x in L.gathered(iter([pa.RecordBatch.from_pandas(rows, L.PACKED, preserve_index=False)]), 5)])
    lines = pd.DataFrame({"node": node, "b": b}).groupby("node")["b"]
    assert set(new) == set(node.tolist())
    assert sorted(got.loc[got["kind"] == L.REPEATED, "node"]) == sorted(n for n, g in lines if len(g) > 1)
    assert sorted(got.loc[got["kind"] == L.COLLIDED, "node"]) == sorted(n for n, g in lines if g.nunique() > 1)


def test_lines_that_are_alone_do_not_travel(spark):
    near = "the quick brown fox jumps over the lazy dog and runs away into the dark green forest"
    rows = [(1, "Twice\nown line of the first\n" + near), (2, "twice\n\nsome words of the second"), (3, near.replace("lazy", "hazy") + "\nthird")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lines = L.gathered_lines(df, "text", frozenset())
    wanted = L.wanted_lines(df, "doc_id", "text", frozenset(), L.line_families(lines), lines.where(f"kind = {L.REPEATED}").select("node"))
    assert sorted((r.id, r.line) for r in wanted.where(f"kind = {L.LINE}").collect()) == [("1", 0), ("1", 2), ("2", 0), ("3", 0)]
    assert sorted(r.payload for r in wanted.where(f"kind = {L.TEXT}").collect()) == sorted([near, near.replace("lazy", "hazy")])
    assert [(r.doc_id, r.copies, r.dropped) for r in L.dropped_lines(df).withColumnRenamed("id", "doc_id").where("size(dropped) > 0").orderBy("doc_id").collect()] == [
        (2, 1, [0]), (3, 1, [0])]


@pytest.mark.parametrize("within, frequent", [(1024, 64), (1024, 2), (3, 64)])
def test_lines_that_meet_by_chance_do_not_leave_their_bucket(monkeypatch, within, frequent):
    """Buckets of up to ``within`` lines give links alone, those that the sketches of all pairs in them ask for."""
    monkeypatch.setattr(L, "FREQUENT", frequent)
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdef") for _ in range(6)) for _ in range(25)]
    lines = [" ".join(rng.choice(words) for _ in range(12)) for _ in range(900)]
    lines += [edited(rng, t, 0.02) for t in lines[:150]]
    lines = sorted(set(lines))
    node, sig = np.array(L.nodes_of(lines), np.int64), L.signatures(lines)
    keys, sketch = L.band_keys(sig), L.sketches(sig)
    parts = [L.packed(node[i:i + 200], keys[i:i + 200], 7, sketch[i:i + 200], False).to_pandas() for i in range(0, len(lines), 200)]
    parts.append(parts[0])                                                       # lines of another task
    rows = pd.concat(parts).sort_values("chunk", kind="stable")
    got = [b.to_pandas() for b in L.gathered(iter([pa.RecordBatch.from_pandas(rows, L.PACKED, preserve_index=False)]), 7, within)]
    member, link = ([g for g in got if (g["kind"] == kind).all()] for kind in (L.MEMBER, L.LINK))
    member, link = (pd.concat(x) if x else got[0].iloc[:0] for x in (member, link))
    assert len(member) + len(link) == sum(map(len, got)) and len(link)
    meet = (keys[:, None] == keys[None]).any(axis=2)
    assert meet.sum() > 10 * len(lines)
    if (within, frequent) == (1024, 64):
        assert not len(member) and len(link) < 3 * len(lines)
    known = {n: x for n, x in zip(node.tolist(), sketch.tolist())}
    assert all(known[n] == [x % 2 ** 64, y % 2 ** 64] for n, x, y in member[["node", "s0", "s1"]].astype(np.int64).itertuples(index=False))
    number = {n: i for i, n in enumerate(node.tolist())}
    near = meet & (L.agreeing(sketch[:, None], sketch[None]) >= L.AGREE)
    member = member.sort_values("bucket")
    a, b = L.compare_sketches(member.assign(unit=member["bucket"], side=0)) if len(member) else ([], [])
    links = [*zip(link["bucket"].tolist(), link["node"].tolist()), *zip(list(a), list(b))]
    want, found = (union_find(len(lines), x) for x in (list(zip(*np.nonzero(near))), [(number[x], number[y]) for x, y in links]))
    pairs = {}
    assert all(pairs.setdefault(w, f) == f for w, f in zip(want, found))         # nothing near is kept apart
    if not len(member):
        assert len(set(zip(want, found))) == len(set(found))


def test_small_buckets_send_no_members(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdef") for _ in range(6)) for _ in range(20)]
    rows = [(i, "\n".join(" ".join(rng.choice(words) for _ in range(10)) for _ in range(5))) for i in range(60)]
    near = " ".join(words)
    rows += [(100, near), (101, near.replace(words[3], "xyzxyz"))]
    lines = L.gathered_lines(spark.createDataFrame(rows, "doc_id long, text string"), "text", frozenset())
    assert {r.kind for r in lines.select("kind").distinct().collect()} <= {L.LINK, L.REPEATED}
    groups = {r.node: r.group for r in L.line_families(lines).collect()}
    a, b = L.nodes_of([rows[-2][1], rows[-1][1]])
    assert groups[a] == groups[b]


@pytest.mark.parametrize("n, sides", [(1, 1), (40, 1), (64, 2), (65, 1), (200, 1), (200, 2)])
def test_similar_lines_against_all_pairs(n, sides):
    rng = random.Random(n + sides)
    base = [" ".join(f"{rng.choice('abcdef')}{rng.randrange(30)}" for _ in range(rng.choice([4, 30]))) for _ in range(n // 6 + 1)]
    lines = [edited(rng, rng.choice(base), rng.choice([0.0, 0.02, 0.04, 0.2])) + rng.choice(["", "", " and a longer tail"]) for _ in range(n)]
    side = np.array([rng.randrange(1, 3) if sides > 1 else 0 for _ in range(n)])
    grams = [L.shingles(t) for t in lines]
    known = [(i, i + 1) for i in range(0, n - 1, 9)]
    near = [(i, j) for i in range(n) for j in range(i) if len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j]) - 1e-12
            and (side[i] != side[j] or sides == 1)]
    numbers: dict[int, int] = {}
    comp = np.array([numbers.setdefault(r, len(numbers)) for r in union_find(n, known)])
    want, got = union_find(n, known + near), L.similar(L.shingle_numbers(lines), side, comp).tolist()
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


@pytest.mark.parametrize("n, sides", [(2, 1), (5, 1), (64, 1), (65, 1), (400, 1), (50, 3), (300, 3)])
def test_sketch_links_against_all_pairs(n, sides):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 4, (6, 64))
    unit, side, node, lanes = [], [], [], []
    for u in range(5):
        for i in range(n):
            own = base[rng.integers(0, 6)].copy()
            at = rng.choice(64, rng.integers(0, 30), replace=False)
            own[at] = rng.integers(0, 4, len(at))
            unit.append(u)
            side.append(int(rng.integers(1, 3)) if sides > 1 else 0)
            node.append(int(rng.integers(0, 10 ** 6)))
            lanes.append(own)
    lanes = np.array(lanes)
    sketch = np.bitwise_or.reduce(lanes.astype(np.uint64).reshape(-1, 2, 32) << np.arange(0, 64, 2, dtype=np.uint64), axis=2)
    agree = (lanes[:, None] == lanes[None]).sum(axis=2)
    assert (L.agreeing(sketch[:, None], sketch[None]) == agree).all()
    unit, side, node = np.array(unit), np.array(side), np.array(node)
    near = (agree >= L.AGREE) & (unit[:, None] == unit) & ((side[:, None] != side) | (side == 0))
    number = {v: i for i, v in enumerate(sorted(set(node.tolist())))}
    links = [(number[node[i]], number[node[j]]) for i, j in zip(*np.nonzero(near))]
    a, b = L.link_sketches(unit, side, node, sketch)
    want, got = (union_find(len(number), x) for x in (links, [(number[x], number[y]) for x, y in zip(a.tolist(), b.tolist())]))
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


@pytest.mark.parametrize("seed", range(3))
def test_small_units_against_all_pairs(seed):
    rng = random.Random(seed)
    units = []
    for _ in range(40):
        base = "".join(rng.choice("abcdé ") for _ in range(rng.choice([1, 3, 5, 30, 90])))
        units.append([base] + [edited(rng, base, 0.1) if rng.random() < 0.3 else base + rng.choice(["", "x", " tail", "é" * 9]) for _ in range(rng.randrange(1, 6))])
    rows = pd.DataFrame([(u, 0, 100 * u + i, t) for u, own in enumerate(units) for i, t in enumerate(own)], columns=["unit", "side", "node", "payload"])
    near = [(100 * u + i, 100 * u + j) for u, own in enumerate(units) for i in range(len(own)) for j in range(i)
            if len(L.shingles(own[i]) & L.shingles(own[j])) >= 0.8 * len(L.shingles(own[i]) | L.shingles(own[j])) - 1e-12]
    for small in (0, 6):
        got = union_find(4000, list(zip(*L.compare_lines(rows, small))))
        want = union_find(4000, near)
        assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_components_in_rounds_and_in_one_task(spark):
    from pairscope.llm.components import components
    rng = random.Random(11)
    links = [(rng.randrange(900), rng.randrange(900)) for _ in range(500)] + [(i, i + 1) for i in range(1000, 1400)] + [(5, 5), (None, 3)]
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    roots = union_find(1500, [(a, b) for a, b in links if a is not None])
    least = {}
    for i, r in enumerate(roots):
        least.setdefault(r, i)
    want = {i: least[r] for i, r in enumerate(roots) if least[r] != i}
    assert {r.node: r.root for r in components(df, one_task=0).collect()} == want == {r.node: r.root for r in components(df).collect()}


def test_large_groups_are_connected_in_blocks(spark):
    """Groups far beyond a block, dense ones and ones that fall apart: the same components as all pairs."""
    rng = random.Random(7)
    base = [" ".join(f"{rng.choice('abcdef')}{rng.randrange(99)}" for _ in range(30)) for _ in range(4)]
    lines = sorted({edited(rng, base[min(int(rng.expovariate(1.5)), 3)], rng.choice([0.0, 0.03, 0.06, 0.2])) for _ in range(260)})
    rows = spark.createDataFrame([(g, 1000 * g + i, t) for g in (1, 2) for i, t in enumerate(lines) if g == 1 or i < 20], "group long, node long, payload string")
    links = [(r.a, r.b) for r in L.linked(rows, L.compare_lines, 25).collect()]
    grams = [L.shingles(t) for t in lines]
    near = [(i, j) for i in range(len(lines)) for j in range(i) if len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j]) - 1e-12]
    want = union_find(2020, [(1000 + i, 1000 + j) for i, j in near] + [(2000 + i, 2000 + j) for i, j in near if i < 20 and j < 20])
    got = union_find(2020, links)
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_repeated_rows_keep_one_copy_of_their_lines(spark):
    rows = [(1, "one line\nanother", "a")] * 3 + [(1, "one line\nanother", "b"), (None, "third line", "c"), (None, "third line", "d"), (2, "own", "a")]
    got = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()]
    assert Counter(kept) == Counter([(1, "one line\nanother", 2, 0)] + [(1, "", 2, 2)] * 3 + [(None, "third line", 1, 0), (None, "", 1, 1), (2, "own", 1, 0)])
    assert sorted(r.source for r in got.collect()) == ["a"] * 4 + ["b", "c", "d"]


@pytest.mark.parametrize("seed", range(4))
def test_families_against_all_pairs(seed):
    rng = random.Random(seed)
    base = [" ".join(f"{rng.choice('abcdef')}{rng.randrange(99)}" for _ in range(30)) + (" 日本" if seed == 3 and k == 1 else "") for k in range(3)]
    lines = sorted({edited(rng, rng.choice(base), rng.choice([0.0, 0.03, 0.1, 0.3])) for _ in range(60)} | set(base))
    family = L.Family()
    units = [sorted(rng.sample(range(len(lines)), rng.randrange(2, 25))) for _ in range(8)]
    for u in units:
        family.add(u, [lines[i] for i in u], [0] * len(u))
    grams = [L.shingles(t) for t in lines]
    links = {(i, j) for u in units for i in u for j in u if i < j and len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j]) - 1e-12}
    roots = union_find(len(lines), links)
    got = union_find(len(lines), list(zip(*family.links())))
    assert len(set(zip(roots, got))) == len(set(roots)) == len(set(got))


def test_finding_a_root_cuts_no_chain():
    family = L.Family()
    family.root = {0: 1, 1: 2, 2: 3, 3: 4, 4: 4}
    assert family.find(0) == 4 and [family.find(n) for n in range(5)] == [4] * 5


def test_short_near_copies_against_own_shingling(spark):
    """One changed character, or one swapped six-letter word, in lines of 20 to 100 characters."""
    def windows(t):
        return {t[i:i + 5] for i in range(max(len(t) - 4, 1))}
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows, lines, characters, words = [], [], 0, 0
    for n in range(20, 101):
        for kind in range(2):
            middle = "".join(rng.sample(letters, 6))
            half = ["".join(rng.choice(letters) for _ in range(m)) for m in ((n - 8) // 2, n - 8 - (n - 8) // 2)]
            line = f"{half[0]} {middle} {half[1]}"
            other = f"{half[0]} {''.join(rng.sample(letters.upper(), 6)).lower()} {half[1]}" if kind else line[:n // 2] + "#" + line[n // 2 + 1:]
            a, b = windows(line), windows(other)
            near = len(a & b) / len(a | b) >= 0.8 - 1e-12
            characters, words = characters + (near and not kind), words + (near and kind)
            lines += [(len(rows), line, 0), (len(rows) + 1, other, int(near))]
            rows += [(len(rows), line), (len(rows) + 1, other)]
    assert characters >= 52 and words >= 8      # from 49 and about 90 characters on
    got = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.text, r.n_dropped) for r in got} == {i: ("" if gone else t, gone) for i, t, gone in lines}


def test_line_dedup_of_nothing(spark):
    assert L.dedup_lines(messy(spark).limit(0)).count() == 0


# --------------------------------------------------------- decontamination
def brute_containment(rows, items, width=5, share=0.8):
    def grams(w, n):
        return {" ".join(w[i:i + n]) for i in range(len(w) - n + 1)}
    out = set()
    sets = [(i, re.findall(r"\w+", (t or "").lower())) for i, t in items]
    for r in rows:
        words = re.findall(r"\w+", (r[1] or "").lower())
        have = {n: grams(words, n) for n in range(1, width + 1)}
        for i, w in sets:
            n = min(len(w), width)
            s = grams(w, n) if w else set()
            if s and len(s & have[n]) >= share * len(s) - 1e-9:
                out.add((r[0], i, len(s & have[n]), len(s)))
    return out


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(8)
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    items += [(900, None), (901, ""), (902, "Two words"), (903, "!!"), (906, "quixotic"), (907, "one of four words"), (904, items[0][1]), (None, items[1][1]),
              (905, " ".join(f"w{i}" for i in range(3000)))]
    rows = messy_rows(spark)
    filler = rows[9][1]
    for k in range(60):
        _, t = items[k % 40]
        w = t.split()
        kind = k % 5
        if kind == 0:
            t = " ".join(w).upper().replace(".", "!!")                # case and punctuation do not count
        elif kind == 1:
            t = "\n".join(w)
        elif kind == 2:
            w[len(w) // 2] = "changed"
            t = " ".join(w)
        elif kind == 3:
            t = " ".join(w[: len(w) // 2])                            # half of an item is no match
        rows.append((40_000 + k, filler * rng.randrange(4) + " " + t + " " + filler, "en", "s", 1))
    rows += [(42_000, f"{filler} A Quixotic idea, {filler}", "en", "s", 1), (42_001, "one of four", "en", "s", 1),
             (42_002, f"this is one, of four words; {filler}", "en", "s", 1), (42_003, f"{filler} two, words", "en", "s", 1), (42_004, "two", "en", "s", 1)]
    rows += [(41_000, "two WORDS", "en", "s", 1), (41_001, "here are two words more", "en", "s", 1),
             (41_002, " ".join(f"w{i}" for i in range(2500)), "en", "s", 1), (41_003, " ".join(f"w{i}" for i in range(2300)), "en", "s", 1)]
    return rows, items


def test_containment_against_all_pairs(spark, planted):
    rows, items = planted
    got = D.containment(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "2 as digest", "3 as shingle"),
                        spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute_containment(rows, items)
    assert len(want) > 40
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got} == want and len(got) == len(want)


def test_decontaminate_keeps_clean_rows_as_they_are(spark, planted):
    rows, items = planted
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'old' as digest")
    kept = D.decontaminate(df, spark.createDataFrame(items, "item_id long, text string"))
    dirty = {(d, t) for d, t, *_ in rows if brute_containment([(d, t)], items)}
    assert kept.columns == df.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter((r[0], r[1]) for r in rows if (r[0], r[1]) not in dirty)


def test_signature_is_never_missed():
    """With 80 % of an item's shingles a document always meets the signature, whichever are missing."""
    import math
    for n in range(1, 400):
        k = math.floor(0.2 * n + 1e-9) + 1
        assert n - math.ceil(0.8 * n - 1e-9) < k


def test_empty_tables(spark, planted):
    rows, items = planted
    docs, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    assert D.containment(docs.limit(0), bench).count() == 0
    assert D.containment(docs, bench.limit(0)).count() == 0
    assert D.decontaminate(docs, bench.limit(0)).count() == len(rows)
