"""Sharding by a Feistel permutation of global row numbers.

Every row gets a global number 0..N-1; a keyed Feistel network over a x b >= N
cells, walked until it lands below N, permutes the numbers; the permuted number
p gives shard p mod n and slot p div n.  Shard sizes differ by one row at most,
slots have no gaps, and shard and slot of any row number can be computed
without touching the data.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialise

#: Prime modulus and odd multipliers of the round function (fixed values).
PRIME = 2147483647
MULTIPLIERS = (48271, 69621, 40692, 39373, 16807, 62089911, 742938285, 950706376)
ROUNDS = len(MULTIPLIERS)
#: Walks per row.  A row still outside after this many steps stops the job; a
#: step misses with probability below 1 / sqrt(N), and never more than
#: a * b - N < sqrt(N) + 1 times in a row.
MAX_WALK = 40


def sides(n: int) -> tuple[int, int]:
    """a, b with a * b >= n and a * b - n < a."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def round_sql(half: str, i: int, seed: int) -> str:
    """Round function: squares and a multiplier modulo a prime (SQL text)."""
    key = (seed * 1000003 + i * 7919 + 12345) % PRIME
    first = f"((({half}) + {key}) % {PRIME})"
    return f"((({first} * {first}) % {PRIME} * {MULTIPLIERS[i]} + {key}) % {PRIME})"


def feistel_steps(n: int, seed: int) -> list[tuple[str, str]]:
    """The rounds as (column, SQL over ``l`` and ``r``), applied one after another."""
    a, b = sides(n)
    return [("l", f"(l + {round_sql('r', i, seed)}) % {a}") if i % 2 == 0
            else ("r", f"(r + {round_sql('l', i, seed)}) % {b}") for i in range(ROUNDS)]


def permute_python(x: int, n: int, seed: int) -> int:
    """The same permutation for one number, to compute a shard and slot by hand."""
    a, b = sides(n)

    def f(half: int, i: int) -> int:
        key = (seed * 1000003 + i * 7919 + 12345) % PRIME
        s = (half + key) % PRIME
        return (s * s % PRIME * MULTIPLIERS[i] + key) % PRIME

    while True:
        left, right = divmod(x, b)
        for i in range(ROUNDS):
            if i % 2 == 0:
                left = (left + f(right, i)) % a
            else:
                right = (right + f(left, i)) % b
        x = left * b + right
        if x < n:
            return x


def _feistel_struct(x: str, n: int, seed: int) -> str:
    """One pass of the network over the SQL expression ``x``, as nested structs' values."""
    _, b = sides(n)
    sql = f"named_struct('l', {x} div {b}, 'r', {x} % {b})"
    for col, step in feistel_steps(n, seed):
        other = "r" if col == "l" else "l"
        body = step.replace("(l +", "(s.l +").replace("(r +", "(s.r +").replace("((r)", "((s.r)").replace("((l)", "((s.l)")
        pair = {col: body, other: f"s.{other}"}
        sql = f"transform(array({sql}), s -> named_struct('l', {pair['l']}, 'r', {pair['r']}))[0]"
    return f"transform(array({sql}), s -> s.l * {b} + s.r)[0]"


def permuted(df: DataFrame, number: str, n: int, seed: int, out: str) -> DataFrame:
    """Add ``out``: the permuted value of column ``number`` (0 <= number < n)."""
    _, b = sides(n)
    names = [fresh(df.columns, c) for c in ("fl", "fr", "walk")]
    left, right, walk = names
    df = df.withColumns({left: F.expr(f"`{number}` div {b}"), right: F.expr(f"`{number}` % {b}")})
    for col, step in feistel_steps(n, seed):
        sql = step.replace("(l +", f"({left} +").replace("(r +", f"({right} +")
        sql = sql.replace("((r)", f"(({right})").replace("((l)", f"(({left})")
        df = df.withColumn(left if col == "l" else right, F.expr(sql))
    again = _feistel_struct("w", n, seed)
    df = df.withColumn(walk, F.expr(f"{left} * {b} + {right}"))
    df = df.withColumn(walk, F.expr(
        f"case when {walk} < {n} then {walk} else "
        f"aggregate(sequence(1, {MAX_WALK}), {walk}, (w, i) -> case when w < {n} then w else {again} end) end"))
    return (df.withColumn(out, F.expr(f"case when {walk} < {n} then {walk} else "
                                      f"raise_error('row left outside the permutation') end"))
            .drop(*names))


def row_hashes(columns: list[str]) -> list:
    """128 bits of a row as two hashes: no two different rows of any corpus share both."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]


def number_rows(df: DataFrame, order_by: list[str], number: str, buckets: int = 4096,
                bucket_by: list[str] | None = None) -> tuple[DataFrame, int]:
    """Number the rows 0..N-1 without a global sort; returns the frame and N.

    The order is: bucket, then the keys ``order_by`` (nulls first), then a hash
    of the whole row.  The bucket comes from the texts of ``bucket_by``, or
    from the row's hash, so that however many rows share a key they are not
    sorted in one task.  Only keys, hashes and counts are sorted (rows equal in
    every column are one entry, counted map-side); whole rows move once, to
    find their number by hash.
    """
    cols = df.columns
    names = [fresh(cols, c) for c in ("bucket", "row_a", "row_b", "copies", "upto", "start", "base", "at", "chunk", "key_a", "key_b")]
    bucket, row_a, row_b, copies, upto, start, base, at, chunk, key_a, key_b = names
    if bucket_by is None:
        place = F.pmod(row_a, F.lit(buckets))
    else:
        text = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in bucket_by])
        place = F.pmod(F.crc32(text), F.lit(buckets))
    keys = [f"k{i}_{row_a}" for i in range(len(order_by))]
    hashed = df.withColumns(dict(zip((row_a, row_b), row_hashes(cols))))
    entries = (hashed.select(place.cast("int").alias(bucket), row_a, row_b, *[F.col(c).alias(k) for c, k in zip(order_by, keys)])
               .groupBy(bucket, row_a, row_b, *keys).agg(F.count("*").alias(copies)))
    w = Window.partitionBy(bucket).orderBy(*[F.asc_nulls_first(k) for k in keys], row_a, row_b)
    entries = materialise(entries.withColumn(upto, F.sum(copies).over(w.rowsBetween(Window.unboundedPreceding, 0)))
                          .select(bucket, F.col(row_a).alias(key_a), F.col(row_b).alias(key_b), copies, upto), "numbered")
    # One row per bucket, so its size is bounded by the parameter.
    sizes = entries.groupBy(bucket).agg(F.max(upto).alias(base))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(bucket, F.coalesce(F.sum(base).over(before), F.lit(0)).alias(start))
    total = sizes.agg(F.sum(base)).first()[0] or 0
    placed = (entries.join(F.broadcast(starts), bucket)
              .select(key_a, key_b, copies, F.expr(f"{start} + {upto} - {copies}").alias(base)))
    found = F.expr(f"{row_a} = {key_a} and {row_b} = {key_b}")
    # The narrow side is hashed, so that whole rows are not sorted.
    out = hashed.join(placed.where(f"{copies} = 1").hint("shuffle_hash"), found).select(*cols, F.col(base).alias(number))
    repeated = placed.where(f"{copies} > 1")
    if not entries.where(f"{copies} > 1").isEmpty():
        # Repeats of a row are merged map-side and dealt their numbers in chunks, so many of them are no hot group.
        step = 100_000
        merged = hashed.join(repeated.select(key_a, key_b), found, "left_semi").groupBy(*cols, row_a, row_b).agg(F.count("*").alias(upto))
        dealt = (merged.join(repeated, found)
                 .withColumn(chunk, F.explode(F.expr(f"sequence(0L, ({copies} - 1) div {step})")))
                 .withColumn(at, F.explode(F.expr(
                     f"sequence({chunk} * {step}, least({copies}, ({chunk} + 1) * {step}) - 1)"))))
        out = out.unionByName(dealt.select(*cols, F.expr(f"{base} + {at}").alias(number)))
    return out, total


def shard_rows(df: DataFrame, n_shards: int, order_by: list[str], seed: int = 7,
               buckets: int = 4096, bucket_by: list[str] | None = None) -> DataFrame:
    """``df`` plus ``shard`` (int), ``slot`` (long) and ``row_number`` (long).

    Existing columns of those names are replaced.  ``order_by`` names the
    columns whose values fix the row numbers within a bucket (see
    ``number_rows``); nulls are ordinary values, rows equal in them are ordered
    by a hash of the whole row, and rows equal in every column are
    interchangeable, so the result depends on the rows alone and not on files
    or partitions.  A very long text is hashed and moved once, and never
    sorted; very many rows of one id, or none, spread over all buckets.  An
    empty table gives an empty result.
    """
    df = df.drop("shard", "slot", "row_number")
    numbered, total = number_rows(df, order_by, "row_number", buckets, bucket_by)
    place = fresh(numbered.columns, "place")
    return (permuted(numbered, "row_number", total, seed, place)
            .withColumns({"shard": F.expr(f"cast({place} % {n_shards} as int)"),
                          "slot": F.expr(f"{place} div {n_shards}")})
            .drop(place))
