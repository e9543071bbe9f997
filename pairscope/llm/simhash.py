"""SimHash near-duplicates by the generalised pigeonhole principle.

Documents get 64-bit fingerprints; equal fingerprints become one node.  To find
all nodes at most ``max_bits`` apart, the 64 bit positions are split into m
parts with thresholds t_1..t_m that sum to max_bits - m + 1: two fingerprints
within max_bits must lie within t_i of each other in some part i (t_i = -1: the
part is not probed).  Correlated bits share a part, and the split and its
thresholds come from a dynamic program over candidate counts estimated from all
fingerprints.  Nodes meet in buckets of equal (probed) part values and are
verified by their full distance; buckets are dealt by key, large ones as pairs
of blocks, and each task passes on a spanning forest of the links it finds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialise, remove_table, small_batches
from .components import LINKS, components, forest

HASH_SEED = 42
CHUNK = 1 << 16          # shingles hashed at a time
BLOCK = 8192             # members of a bucket compared in one task at once
PROBE_COST = 100.0       # a shuffled bucket row, in units of one comparison
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)


# ------------------------------------------------------------ fingerprints
def fingerprint(text: str | None, width: int) -> int:
    """64-bit SimHash of the word shingles of ``text``, as an unsigned number.

    A-Z are lower-cased; words are runs without ASCII white space; shingles of
    ``width`` words (repeats count, fewer words make one shingle) are hashed
    with XXH64; a bit is set if over half of the hashes have it.  No words: 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts = np.zeros((8, 256), np.int64)
    column = np.arange(8, dtype=np.int64) * 256
    digest = xxhash.xxh64_digest
    for lo in range(0, len(starts), CHUNK):
        got = b"".join([digest(joined[s:e], HASH_SEED)
                        for s, e in zip(starts[lo:lo + CHUNK].tolist(), ends[lo:lo + CHUNK].tolist())])
        by_byte = np.frombuffer(got, np.uint8).reshape(-1, 8) + column
        counts += np.bincount(by_byte.ravel(), minlength=2048).reshape(8, 256)
    ones = (counts @ BITS).ravel()
    return int.from_bytes(np.packbits(ones * 2 > len(starts)).tobytes(), "big")


def _digest(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, digest, fp) of every row: XXH64 of the text and the fingerprint as a signed long; a null text is empty."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = np.fromiter((fingerprint(t, width) for t in batch["text"]), np.uint64, len(batch))
            yield pd.DataFrame({"id": batch["id"], "digest": batch["digest"], "fp": fp.view(np.int64)})
    rows = docs.select(F.col(id_col).alias("id"), _digest(text_col).alias("digest"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    # The id travels as text, so that a null id stays a null in every batch.
    return (rows.withColumn("id", F.col("id").cast("string")).mapInPandas(run, "id string, digest long, fp long")
            .withColumn("id", F.col("id").cast(kind)))


# ------------------------------------------------------- parts and thresholds
def bit_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How often two bits are set together, over a partition (64 x 64 numbers)."""
    both = np.zeros((64, 64))
    for batch in batches:
        bits = np.unpackbits(batch["fp"].to_numpy().astype(">i8").view(np.uint8).reshape(-1, 8), axis=1)[:, ::-1]
        bits = bits.astype(np.float32)
        both += bits.T @ bits
    i, j = np.indices((64, 64))
    yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "n": both.ravel()})


def group_bits(both: np.ndarray, n: int, groups: int = 4) -> list[list[int]]:
    """The 64 bits in equal groups, the most correlated ones together (greedy)."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    left, out = list(range(64)), []
    for _ in range(groups):
        pairs = corr[np.ix_(left, left)].copy()
        np.fill_diagonal(pairs, 0)
        group = [left[int(pairs.sum(axis=1).argmax())]]
        left.remove(group[0])
        while len(group) < 64 // groups:
            best = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def distance_counts(counts: np.ndarray, most: int) -> np.ndarray:
    """Ordered pairs by the distance 0..most of their 16-bit values, from the counts of all values (Walsh-Hadamard)."""
    def transform(v: np.ndarray) -> np.ndarray:
        h = 1
        while h < len(v):
            v = v.reshape(-1, 2, h)
            v = np.stack([v[:, 0] + v[:, 1], v[:, 0] - v[:, 1]], axis=1).reshape(-1)
            h *= 2
        return v
    pairs = transform(transform(counts.astype(np.float64)) ** 2) / len(counts)
    weight = BITS.sum(axis=1)
    apart = weight[np.arange(len(counts)) >> 8] + weight[np.arange(len(counts)) & 255]
    return np.bincount(apart, weights=pairs, minlength=most + 1)[: most + 1]


def probes(width: int, t: int) -> int:
    """Bucket rows per fingerprint for a part of ``width`` bits and threshold ``t``."""
    return 0 if t < 0 else sum(comb(width, k) for k in range((t + 1) // 2 + 1))


def allocate(cost: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with the given sum and the least summed cost; ``cost[i][t + 1]``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in cost:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for k, extra in enumerate(part):
                now = (c + extra, [*ts, k - 1])
                if s + k - 1 not in nxt or now < nxt[s + k - 1]:
                    nxt[s + k - 1] = now
        best = nxt
    return best[total]


def plan(groups: list[list[int]], by_distance: np.ndarray, n: int, max_bits: int) -> list[tuple[list[int], int]]:
    """Parts (bit lists) and thresholds of least estimated cost, among merges of neighbouring groups.

    ``by_distance[g]`` has the ordered pairs at distance 0..max_bits in group g;
    merged groups are taken as independent, since correlated bits share one.
    """
    share = by_distance / max(n, 1) ** 2
    options = []
    for cuts in range(len(groups)):
        for at in combinations(range(1, len(groups)), cuts):
            spans = list(zip((0, *at), (*at, len(groups))))
            cost = []
            for lo, hi in spans:
                near = np.array([1.0])
                for g in range(lo, hi):
                    near = np.convolve(near, share[g])[: max_bits + 1]
                width = sum(len(groups[g]) for g in range(lo, hi))
                within = np.cumsum(near) * n * n / 2
                cost.append([0.0] + [PROBE_COST * n * probes(width, t) + float(within[min(t, len(within) - 1)])
                                     for t in range(max_bits + 1)])
            total, ts = allocate(cost, max_bits - len(spans) + 1)
            options.append((total, [(sum((groups[g] for g in range(lo, hi)), []), t) for (lo, hi), t in zip(spans, ts)]))
    return min(options, key=lambda o: o[0])[1]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


# ------------------------------------------------------------ probe and verify
def bucket_rows(nodes: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """(part, key, fp, d): one row per fingerprint and probed value; d is how far the value is from its own."""
    flips = []
    for i, (bits, t) in enumerate(parts):
        for d in range((t + 1) // 2 + 1 if t >= 0 else 0):
            for chosen in combinations(bits, d):
                flips.append((i, signed(sum(1 << b for b in bits)), signed(sum(1 << b for b in chosen)), d, t // 2))
    table = ", ".join(f"struct({i} as part, {m}L as mask, {f}L as flip, {d} as d, {r} as near)" for i, m, f, d, r in flips)
    table = table.replace(f"{-(1 << 63)}L", "shiftleft(1L, 63)")
    return (nodes.select("fp", F.explode(F.expr(f"array({table})")).alias("p"))
            .select("p.part", F.expr("(fp ^ p.flip) & p.mask").alias("key"), "fp",
                    F.expr("p.d <= p.near").alias("near")))


def linked(fp: np.ndarray, unit: np.ndarray, near: np.ndarray, side: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the pairs of a unit within ``max_bits``; rows are sorted by unit.

    A pair counts if one of its rows is near (else it is farther apart than the
    part's threshold) and if its sides differ or are both 0 (blocks of a split
    bucket: 1 and 2 are compared with each other only).
    """
    starts = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
    end = np.repeat(np.append(starts[1:], len(unit)), np.diff(np.append(starts, len(unit))))
    at, a, b, held = np.arange(len(unit)), [], [], 0
    step = 1
    while True:
        at = at[at + step < end[at]]
        if not len(at):
            break
        other = at + step
        ok = np.bitwise_count((fp[at] ^ fp[other]).view(np.uint64)) <= max_bits
        ok &= (near[at] | near[other]) & ((side[at] != side[other]) | (side[at] == 0)) & (fp[at] != fp[other])
        if ok.any():
            a.append(fp[at[ok]])
            b.append(fp[other[ok]])
            held += int(ok.sum())
            if held > 1 << 20:
                a, b = ([x] for x in forest(np.concatenate(a), np.concatenate(b)))
                held = len(a[0])
        step += 1
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return forest(np.concatenate(a), np.concatenate(b))


def links(nodes: DataFrame, parts: list[tuple[list[int], int]], max_bits: int, block: int = BLOCK) -> DataFrame:
    """Links between the fingerprints of ``nodes``: a spanning forest per task of all pairs within ``max_bits``."""
    rows = bucket_rows(nodes, parts)
    # Buckets over one block are dealt as pairs of blocks; there are at most rows / block of them.
    large = materialise(rows.groupBy("part", "key").agg(F.count("*").alias("n")).where(F.col("n") > block)
                        .select("part", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "buckets")
    units = (rows.join(large, ["part", "key"], "left")
             .withColumn("own", F.expr("if(blocks is null, 0, pmod(xxhash64(fp), blocks))"))
             .withColumn("with", F.explode(F.expr("if(blocks is null, array(0), sequence(0, blocks - 1))")))
             .select("part", "key", "fp", "near", F.expr("least(own, with)").alias("u"), F.expr("greatest(own, with)").alias("v"),
                     F.expr("if(own = with, 0, if(own < with, 1, 2))").alias("side"))
             # In the unit of a block with itself every row is its own; in a mixed one each block is a side.
             .withColumn("side", F.expr("if(u = v, 0, side)")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            unit = batch[["part", "key", "u", "v"]].to_numpy()
            change = np.flatnonzero((unit[1:] != unit[:-1]).any(axis=1))
            last = int(change[-1]) + 1 if len(change) else 0
            rest = batch.iloc[last:]
            if last:
                yield from found(batch.iloc[:last], unit[:last])
        if rest is not None and len(rest):
            yield from found(rest, rest[["part", "key", "u", "v"]].to_numpy())

    def found(batch: pd.DataFrame, unit: np.ndarray) -> Iterator[pd.DataFrame]:
        number = np.concatenate([[0], np.cumsum((unit[1:] != unit[:-1]).any(axis=1))])
        a, b = linked(batch["fp"].to_numpy(), number, batch["near"].to_numpy(), batch["side"].to_numpy(), max_bits)
        if len(a):
            yield pd.DataFrame({"a": a, "b": b})

    return (units.repartition("part", "key", "u", "v").sortWithinPartitions("part", "key", "u", "v")
            .mapInPandas(run, LINKS))


def choose_parts(nodes: DataFrame, max_bits: int, groups: int = 4) -> list[tuple[list[int], int]]:
    """Split and thresholds from statistics of all fingerprints: 64 x 64 bit counts and 2^16 values a group at most."""
    size = 64 // groups
    got = nodes.select("fp").mapInPandas(bit_counts, "i int, j int, n double").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    both = np.zeros((64, 64))
    for r in got:
        both[r.i, r.j] = r.n
    n = nodes.count()
    bits = group_bits(both, n, groups)
    value = lambda g: " | ".join(f"shiftleft((shiftright(fp, {b}) & 1L), {k})" for k, b in enumerate(g))
    counts = np.zeros((groups, 1 << size), np.int64)
    seen = (nodes.select(F.posexplode(F.expr("array(" + ", ".join(value(g) for g in bits) + ")")).alias("g", "v"))
            .groupBy("g", "v").agg(F.count("*").alias("n")).toPandas())
    counts[seen["g"].to_numpy(np.int64), seen["v"].to_numpy(np.int64)] = seen["n"].to_numpy(np.int64)
    return plan(bits, np.stack([distance_counts(c, max_bits) for c in counts]), n, max_bits)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                   max_bits: int = 3) -> DataFrame:
    """(id, digest, fp, root, component_id) of every row of ``docs``.

    ``fp`` is the signed fingerprint, ``root`` the smallest fingerprint of its
    component under links of at most ``max_bits`` differing bits, and
    ``component_id`` the smallest id in it (null if it has null ids only; null
    ids are otherwise passed over).  Equal rows, null and empty texts (all
    fingerprint 0) are linked like any others.  Other columns are ignored; an
    empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    rows = materialise(fingerprints(docs, id_col, text_col, width), "fingerprints")
    nodes = materialise(rows.groupBy("fp").agg(F.min("id").alias("id")), "nodes")
    if nodes.isEmpty():
        return rows.select("id", "digest", "fp", F.col("fp").alias("root"), F.col("id").alias("component_id"))
    found = components(links(nodes, choose_parts(nodes, max_bits), max_bits))
    rooted = nodes.join(found, F.col("fp") == F.col("node"), "left").select("fp", "id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    names = materialise(rooted.drop("id").join(least, "root"), "simhash-components")
    remove_table(nodes)
    return rows.join(names, "fp").select("id", "digest", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                         max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each SimHash component: that of the smallest id.

    Of rows with that id the one with the smallest text hash stays; rows that
    repeat both stay once.  A null id comes last.
    """
    kept_id, kept_digest, digest, gone = (fresh(docs.columns, c) for c in ("kept_id", "kept_digest", "digest", "gone"))
    rows = materialise(simhash_groups(docs, id_col, text_col, width, max_bits)
                       .groupBy("root", "id", "digest").agg(F.count("*").alias("n")), "simhash-rows")
    best = rows.groupBy("root").agg(F.min(F.struct(F.isnull("id").alias("none"), "id", "digest")).alias("best"))
    marked = rows.join(best, "root").select(
        F.col("id").alias(kept_id), F.col("digest").alias(kept_digest), "n",
        F.expr("not (id <=> best.id and digest = best.digest)").alias(gone))
    same = F.expr(f"`{id_col}` <=> {kept_id} and {digest} = {kept_digest}")
    hashed = docs.withColumn(digest, _digest(text_col))
    kept = hashed.join(marked.where(gone).drop("n", gone), same, "left_anti")
    repeats = materialise(marked.where(f"not {gone} and n > 1").drop("n", gone), "simhash-repeats")
    if not repeats.isEmpty():
        kept = (kept.join(repeats, same, "left_anti")
                .unionByName(hashed.join(repeats, same, "left_semi").dropDuplicates([id_col, digest])))
    return kept.drop(digest)
