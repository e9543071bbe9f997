import hashlib
import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from pairscope.llm import filter_audit, quality_rules, vector_codes

from .data import SCHEMA, messy, messy_rows

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"
LABELS = "doc_id long, quality int, toxic int"


# ------------------------------------------------------------- vector codes
def plain_codes(rows, entries=256, rounds=4):
    """The contract, number by number."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max(len(v) for _, v, _ in kept) // 4)
    kept = [(i, v + [0] * (4 * width - len(v)), lab) for i, v, lab in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p * width: (p + 1) * width] for r in first] for p in range(4)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(4):
            members = defaultdict(list)
            for _, v, _ in kept:
                part = v[p * width: (p + 1) * width]
                members[nearest(part, books[p])[1]].append(part)
            for k, own in members.items():
                books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    out, sums = [], Counter()
    for i, v, lab in kept:
        found = [nearest(v[p * width: (p + 1) * width], books[p]) for p in range(4)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), lab))
        sums[lab] += out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return Counter((i, c, d, min(sums[lab], 2 ** 63 - 1), digest) for i, c, d, lab in out)


def coded(spark, rows, schema=VECTORS, **options):
    return Counter(tuple(r) for r in vector_codes.compress(spark.createDataFrame(rows, schema), **options).collect())


def random_vectors(n, dims, seed, values=None):
    rng = random.Random(seed)
    draw = (lambda: rng.choice(values)) if values else (lambda: rng.gauss(0, 0.2))
    return [(i, [draw() for _ in range(dims)], rng.choice([0, 1, 2, None])) for i in range(n)]


@pytest.mark.parametrize("n, dims, entries, values", [
    (90, 16, 8, None), (120, 8, 16, (0.0, 0.001, -0.001, 0.5)), (5, 4, 256, None), (60, 12, 300 // 2, (-0.25, 0.25))])
def test_codes_against_plain_rounds(spark, n, dims, entries, values):
    rows = random_vectors(n, dims, n, values)
    assert coded(spark, rows, entries=entries) == plain_codes(rows, entries)


def test_codes_of_awkward_rows(spark):
    rows = random_vectors(40, 8, 3)
    rows += [(100, None, 1), (101, [None] * 8, 1), (102, [float("nan")] + [0.1] * 7, 1), (103, [float("inf")] + [0.1] * 7, 1),
             (104, [0.1, -float("inf")] + [0.0] * 6, None), (None, [0.3] * 8, None), (None, [0.3] * 8, None), (7, [0.2] * 8, 1),
             rows[3], rows[3], rows[3], (105, [0.1, 0.2, 0.3], 2), (106, [], 2), (107, [-1e-9] * 8, 0), (108, [7.5] * 8, 0)]
    assert coded(spark, rows, entries=12) == plain_codes(rows, 12)
    extra = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS + ", code string, error int")
    got = Counter(tuple(r) for r in vector_codes.compress(extra, entries=12).collect())
    assert got == plain_codes(rows, 12)


def test_codes_of_odd_widths_large_numbers_and_nothing(spark):
    rows = random_vectors(30, 10, 5)                      # filled up to 12 components
    assert coded(spark, rows, entries=6) == plain_codes(rows, 6)
    huge = [(1, [1e30, -1e30, 1e5, 0.0], 1), (2, [3e38, 0.0, 0.0, 1.0], 1), (3, [0.0, 0.0, 0.0, 0.0], 1)]
    got = vector_codes.compress(spark.createDataFrame(huge, VECTORS), entries=2).collect()
    assert len(got) == 3 and all(0 <= r.error <= r.label_error <= 2 ** 63 - 1 for r in got)
    limit = vector_codes.bound(4)
    assert 4 * (2 * limit) ** 2 < 2 ** 63
    large = [(i, [x * 100.0, -x * 90.0, x, 0.0], 1) for i, x in enumerate((1.0, 900.0, -800.0, 30.0))]   # beyond exact doubles' products
    assert coded(spark, large, entries=2) == plain_codes(large, 2)
    for empty in ([], [(1, None, 1)], [(1, [float("nan")], 1)]):
        out = vector_codes.compress(spark.createDataFrame(empty, VECTORS))
        assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and out.count() == 0
    blank = vector_codes.compress(spark.createDataFrame([(1, [], 1), (2, [], None)], VECTORS)).collect()
    assert {(r.vec_id, r.code, r.error) for r in blank} == {(1, "00000000", 0), (2, "00000000", 0)}


@pytest.mark.parametrize("siblings", [1, 3, 512])
def test_trie_against_all_distances(monkeypatch, siblings):
    monkeypatch.setattr(vector_codes, "SIBLINGS", siblings)
    rng = np.random.default_rng(8)
    for width, top in ((1, 5), (3, 3), (6, 40), (5, 1 << 27)):
        parts, _ = vector_codes.sorted_distinct(rng.integers(-top, top, (200, width)))
        book = rng.integers(-top, top, (9, width))
        book[5] = book[2]
        entry, least = vector_codes.assign(parts, book)
        all_ = ((parts[:, None, :].astype(object) - book.astype(object)) ** 2).sum(axis=2)
        assert entry.tolist() == [min(range(9), key=lambda k: (d[k], k)) for d in all_]
        assert least.tolist() == all_.min(axis=1).tolist()


def test_sums_beyond_a_long_are_exact(spark):
    parts = spark.createDataFrame([(0, [1 << 27], 1 << 40), (0, [(1 << 27) - 1], 1 << 40), (0, [-5], 3)], "pos int, part array<int>, n long")
    books = np.array([[[1 << 27], [0]]] * 4)
    got = {(r.pos, r.entry, r.dim): int(r.total) for r in vector_codes.weighted_sums(parts, books).collect()}
    assert got == {(0, 0, 0): (1 << 40) * ((1 << 28) - 1), (0, 0, -1): 1 << 41, (0, 1, 0): -15, (0, 1, -1): 3}


def test_codes_do_not_depend_on_partitions(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    a = Counter(tuple(r) for r in vector_codes.compress(rows.repartition(1)).collect())
    b = Counter(tuple(r) for r in vector_codes.compress(rows.repartition(7)).collect())
    assert a == b and len(a) == rows.count()


# ------------------------------------------------------------- filter audit
def plain_audit(rows, labels):
    def words(t):
        return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
    docs = [(i, s or "", t or "") for i, t, s in rows]
    least = defaultdict(list)
    for i, _, t in docs:
        if i is not None:
            least[t].append(i)
    good, toxic = set(), set()
    for i, q, x in labels:
        if q == 1 and i is not None:
            good.add(i)
        if x == 1 and i is not None:
            toxic.add(i)
    failed = []
    for i, part, t in docs:
        w = words(t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
             "D": any(c in "#$%&*|" for c in t), "E": i is not None and any(j < i for j in least[t])}
        failed.append((i, part, {k for k, v in f.items() if v}))
    out = {}
    for part in {p for _, p, _ in failed}:
        mine = [(i, f) for i, p, f in failed if p == part]
        lost = Counter()
        for order in itertools.permutations("ABCDE"):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(f in x[1] for x in mine) - len(gone), sum(x[1] == {f} for x in mine),
                    sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone))
                lost[f] += len(gone)
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step] += (lost[f],)
    return out


def audited(spark, docs, labels):
    got = filter_audit.audit(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len({(r.part, r.filter_order, r.step) for r in got})
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got}


def test_audit_against_plain_removal(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["alpha", "Beta", "x#", "g%", "UPPER", "émile", "日本"]) + str(rng.randrange(m))
                      for _ in range(rng.choice([20, 199, 200, 260]))) for m in (1, 40, 900) for _ in range(6)]
    texts += [None, "", "A", "\x85  x", "a\x0bb\x0cc", "|", "Ab" * 49, ("w " * 400)]
    rows = [(rng.choice([i, i, None]), rng.choice(texts), rng.choice(["s1", "s2", None, ""])) for i in range(150)]
    rows += rows[:9]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame([(i, t, None, s, None) for i, t, s in rows], SCHEMA)
    for c in ("id", "part", "mask", "digest", "own", "raw", "least", "good"):
        docs = docs.selectExpr("*", f"'old' as {c}")
    assert audited(spark, docs, labels) == plain_audit(rows, labels)


def test_audit_of_messy_rows_and_nothing(spark):
    rows = [(r[0], r[1], r[3]) for r in messy_rows(spark, 20)]
    labels = [(r[0], 1, 0) for r in rows[::3]]
    assert audited(spark, messy(spark, 20), labels) == plain_audit(rows, labels)
    assert audited(spark, messy(spark, 20).limit(0), labels) == {}
    assert audited(spark, messy(spark, 20), []) == plain_audit(rows, [])


def test_ranks_and_intervals():
    orders = list(itertools.permutations(range(5)))
    assert [filter_audit.lehmer_rank(o) for o in orders] == list(range(120))
    assert filter_audit.ORDERS == sorted(filter_audit.ORDERS)
    at = filter_audit.differences().cumsum(axis=-1)
    assert at[..., -1].any() == False  # noqa: E712  every interval ends within the ranks
    for rank, order in enumerate(orders):
        for mask in range(32):
            failing = [f for f in order if mask >> f & 1]
            for step, f in enumerate(order):
                removed = bool(failing) and failing[0] == f
                kept = not any(mask >> g & 1 for g in order[: step + 1])
                redundant = f in failing and not removed
                assert at[mask, :, step, rank].tolist() == [kept, removed, redundant, mask == 1 << f]


# ------------------------------------------------------------ quality rules
def plain_counts(text):
    t = text or ""
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i: i + 3])] > 1 for k in range(3)}
    seen, dups = set(), 0
    for line in t.split("\n"):
        if any(c not in " \t\n\x0b\x0c\r" for c in line):
            dups += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dups, len(covered), n < 50 or 100 * len(covered) > 50 * n)


def test_rule_counts_against_plain_counting(spark):
    rng = random.Random(2)
    rows = messy_rows(spark, 40) + [
        (9500 + i, "".join(rng.choice(["ab ", "c#", " \t", "\n", "日本 ", "x y z ", "\x85", " ", "\x0b", "\x1f", "&<"]) for _ in range(300)), None, None, 0)
        for i in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for c in ("id", "x", "n_words", "score", "kept", "raw", "digest", "of", "y"):
        docs = docs.selectExpr("*", f"'old' as {c}")
    out = quality_rules.judge(docs, spark.createDataFrame([], LABELS))
    assert [f"{a} {b}" for a, b in out.dtypes][:8] == [
        "doc_id bigint", "n_words bigint", "word_chars bigint", "n_symbols bigint", "n_dup_lines bigint", "n_repeat_words bigint",
        "base_failed boolean", "kept boolean"]
    got = Counter(tuple(r)[:8] for r in out.collect())
    want = Counter((r[0], *plain_counts(r[1]), not plain_counts(r[1])[-1]) for r in rows)      # no labels: the fixed rules decide
    assert got == want


def test_rules_of_nothing(spark):
    assert quality_rules.judge(messy(spark).limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_junk_goes_and_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    known, unseen = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    out = quality_rules.judge(docs, known)
    found = out.join(unseen, "doc_id").where("not base_failed").groupBy("quality").agg({"*": "count", "kept": "count"})
    by = {r.quality: r["count(1)"] for r in found.collect()}
    kept = {r.quality: r["count"] for r in out.join(unseen, "doc_id").where("kept").groupBy("quality").count().collect()}
    assert kept[1] >= 0.98 * by[1] and kept.get(0, 0) <= 0.03 * by[0]


def test_path_lengths_against_a_plain_walk():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    x[:, 3] = 7.0                                        # never varies: never split
    y = np.ones(300)
    y[:5] = 0
    forest = quality_rules.grow(x, y, trees=5, sample=64, bad_share=0.03, seed=1)
    again = quality_rules.grow(x, y, trees=5, sample=64, bad_share=0.03, seed=1)
    assert np.array_equal(forest.cut, again.cut) and not (forest.feature == 3).any()
    points = rng.normal(size=(40, 4)) * 3
    want = []
    for p in points:
        total = 0.0
        for t in range(5):
            node = 0
            while forest.feature[t, node] >= 0:
                node = forest.left[t, node] + int(p[forest.feature[t, node]] > forest.cut[t, node])
            total += float(forest.value[t, node])
        want.append(2 ** (-total / 5 / forest.expected))
    assert np.allclose(forest.score(points), want)
    far, near = forest.score(np.full((1, 4), 50.0)), forest.score(np.array([[0.0, 0.0, 0.0, 7.0]]))
    assert far > near
    for n in (2, 3, 10, 1000):                           # mean depth of a random binary search tree's missing keys
        harmonic = sum(1 / i for i in range(1, n))
        assert abs(float(quality_rules.mean_depth(n)) - (2 * harmonic - 2 * (n - 1) / n)) < 0.6


def test_threshold_against_all_cuts(spark):
    rng = random.Random(9)
    rows = [(1, rng.uniform(0.3, 0.6)) for _ in range(80)] + [(0, rng.uniform(0.5, 0.8)) for _ in range(40)]
    cut = quality_rules.calibrate(spark.createDataFrame(rows, "y int, score double"))

    def benefit(c):
        return sum(y == 0 and s >= c for y, s in rows) / 40 - sum(y == 1 and s >= c for y, s in rows) / 80
    assert abs(benefit(cut) - max(benefit(k / quality_rules.BINS) for k in range(quality_rules.BINS + 1))) < 1e-12
    assert quality_rules.calibrate(spark.createDataFrame(rows[:80], "y int, score double")) == 1.0
    assert quality_rules.calibrate(spark.createDataFrame([], "y int, score double")) == 1.0
