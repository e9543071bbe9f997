"""Mixing sources to target weights by Poisson replication.

A source with target weight w holds on average w times the budget, so each of
its documents is repeated lambda = w * budget / size(source) times in the mean.
The count of one document is drawn by inverting the Poisson distribution at a
hash-seeded uniform number: it depends on the seed and the document alone, so
any executor draws it again alike.  Documents are exploded by their counts and
the copies are ordered by a hash, which shuffles them globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialise

#: A mean above this is drawn as a sum of independent Poisson parts of this
#: mean and a rest (such sums are Poisson again), which keeps exp(-mean) exact.
PART = 8.0
#: Terms of the cumulative sum for one part: P(Poisson(8) > 60) < 2^-53, the
#: spacing of the uniform numbers, so no draw is cut off.
TERMS = 60
#: A document with a larger mean is split into pieces of this mean, which are
#: drawn in tasks of their own, in fewer parts of a larger mean.
PIECE = 4096.0
LARGE_PART, LARGE_TERMS = 256.0, 512     # P(Poisson(256) > 512) < 2^-53
#: Numbers of copies that a piece has room for: P(Poisson(4096) > 2^20) is 0.
ROOM = 1 << 20
#: Values that one row is expanded to at once.
STEP = 100_000
#: Bytes of source names and rates up to which the rates are broadcast.
BROADCAST_BYTES = 16 << 20


def uniform_sql(parts: str) -> str:
    """52 bits of an MD5 as a number in [0, 1)."""
    return f"(cast(conv(substr(md5({parts}), 1, 13), 16, 10) as bigint) / 4503599627370496.0D)"


def poisson_sql(mean: str, uniform: str, terms: int = TERMS) -> str:
    """Inverse Poisson distribution function at ``uniform`` (SQL text).

    Walks p(k) = p(k-1) * mean / k; the count is the number of k whose
    cumulative probability is at or below the uniform number.
    """
    return (f"aggregate(sequence(1, {terms}), named_struct('p', exp(-{mean}), 'c', exp(-{mean}), 'u', {uniform}, "
            f"'k', if({uniform} >= exp(-{mean}), 1, 0)), (s, i) -> named_struct("
            f"'p', s.p * {mean} / i, 'c', s.c + s.p * {mean} / i, 'u', s.u, "
            f"'k', s.k + if(s.u >= s.c + s.p * {mean} / i, 1, 0)), s -> s.k)")


def source_rates(docs: DataFrame, source_col: str, size: Column, weights: dict[str, float] | None,
                 budget: float | None) -> DataFrame:
    """One row per source: source, size, weight (normalised), rate.

    ``weights`` None: every source weighs the same.  A source that ``weights``
    does not name weighs 0.  ``budget`` None: the size of the whole corpus.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size).alias("size"))
    if weights is None:
        sizes = sizes.withColumn("w", F.lit(1.0))
    else:
        named = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()],
                                                  "source string, w double")
        # The table of weights is a parameter, so the join's small side is bounded by it.
        sizes = (sizes.join(F.broadcast(named.withColumnRenamed("source", "named")),
                            F.expr("source <=> named"), "left")
                 .select("source", "size", F.coalesce("w", F.lit(0.0)).alias("w")))
    total = sizes.agg(F.sum("w").alias("all_w"), F.sum("size").alias("all_size"))
    return (sizes.join(F.broadcast(total))  # one row
            .withColumn("weight", F.expr("if(all_w > 0, w / all_w, 0.0)"))
            .withColumn("rate", F.col("weight") * (F.lit(float(budget)) if budget is not None
                                                   else F.col("all_size")) / F.col("size"))
            .select("source", "size", "weight", "rate"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: dict[str, float] | None = None, budget: float | None = None, seed: int = 11) -> DataFrame:
    """``docs`` repeated to the target weights: its columns, ``copy`` (long, from 1 on) and ``shuffle_key``.

    A source's size is the UTF-8 bytes of its texts plus one a document, so no
    source has size 0.  A null source is a source of its own; a null text has
    no bytes.  Equal rows (id and text) draw equal counts.  Sorting by
    ``shuffle_key`` is the global shuffle; see ``shuffled``.  Existing columns
    ``copy`` and ``shuffle_key`` are replaced.  An empty table gives an empty one.

    Rates have no bound: a document that is repeated more than 4,096 times in
    the mean is drawn and expanded in pieces in many tasks (its copies then
    number from piece x 2^20 + 1 on).  A very long text is copied as often as it
    is drawn.
    """
    docs = docs.drop("copy", "shuffle_key")
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1
    rates = source_rates(docs, source_col, size, weights, budget)
    key, rate, mixed, count, piece, chunk = (fresh([*docs.columns, "copy"], c) for c in (
        "seed_key", "rate", "mixed_source", "count", "piece", "chunk"))
    rates = materialise(rates.select(F.col("source").alias(mixed), F.col("rate").alias(rate)), "rates")
    room = rates.agg(F.sum(F.coalesce(F.octet_length(mixed), F.lit(0)) + 64)).first()[0] or 0
    if room <= BROADCAST_BYTES:  # beyond it a shuffled join, whose hot sources adaptive execution splits
        rates = F.broadcast(rates)
    ident = (f"concat_ws(':', '{seed}', coalesce(cast(`{id_col}` as string), ''), "
             f"md5(coalesce(`{text_col}`, '')))")
    seeded = docs.withColumn(key, F.expr(ident)).join(rates, F.expr(f"`{source_col}` <=> {mixed}")).where(f"{rate} > 0")
    small = seeded.where(f"{rate} <= {PIECE}").withColumn(piece, F.lit(0).cast("long"))
    out = _copies(small, key, rate, count, piece, chunk, PART, TERMS)
    if rates.where(f"{rate} > {PIECE}").limit(1).count():
        # The pieces of much repeated documents are dealt out anew, so that no task draws or expands more than a few.
        large = _expanded(seeded.where(f"{rate} > {PIECE}"), f"cast(ceil({rate} / {PIECE}) as long)", piece, chunk)
        n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))     # stated, so that few bytes are not put together
        out = out.unionByName(_copies(large.repartition(n, F.expr(f"xxhash64({key}, {piece})")), key, rate, count, piece, chunk,
                                      LARGE_PART, LARGE_TERMS))
    return (out.withColumn("shuffle_key", F.expr(f"md5(concat({key}, '/', copy))"))
            .select(*docs.columns, "copy", "shuffle_key"))


def _expanded(df: DataFrame, n: str, column: str, chunk: str) -> DataFrame:
    """Each row once for every ``column`` from 0 to ``n`` - 1 (a long), by arrays of bounded size."""
    return (df.withColumn(chunk, F.explode(F.expr(f"sequence(0L, ({n} - 1) div {STEP})")))
            .withColumn(column, F.explode(F.expr(f"sequence({chunk} * {STEP}, least({n}, ({chunk} + 1) * {STEP}) - 1)")))
            .drop(chunk))


def _copies(df: DataFrame, key: str, rate: str, count: str, piece: str, chunk: str, part: float, terms: int) -> DataFrame:
    """``df`` repeated by the counts drawn for its pieces, with ``copy``.

    The rate is a sum of parts of mean ``part`` and what is left; a piece draws
    its own of them.
    """
    each = int(PIECE / part)
    n_parts = f"greatest(cast(ceil({rate} / {part}) as long), 1L)"
    lo, hi = f"({piece} * {each} + 1)", f"least({n_parts}, ({piece} + 1) * {each})"
    u = uniform_sql(f"concat({key}, chr(58), i)")
    draws = poisson_sql("m.mean", "m.u", terms)
    drawn = df.withColumn(count, F.expr(
        f"aggregate(transform(transform(sequence({lo}, {hi}), i -> named_struct("
        f"'mean', if(i < {n_parts}, {part}D, {rate} - {part}D * ({n_parts} - 1)), "
        f"'u', {u})), m -> {draws}), 0L, (a, x) -> a + x)"))
    return (_expanded(drawn.where(f"{count} > 0"), count, "copy", chunk)
            .withColumn("copy", F.expr(f"{piece} * {ROOM} + copy + 1")))


def shuffled(mixed: DataFrame, partitions: int | None = None) -> DataFrame:
    """The global shuffle: rows in the order of their hash keys.

    The keys are uniform, so partition i takes the i-th range of their first 32
    bits: no pass over the rows has to look for ranges, and every copy is drawn once.
    """
    n = partitions or int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.expr(f"cast(conv(substr(shuffle_key, 1, 8), 16, 10) as bigint) * {n} div 4294967296L")
    return mixed.repartitionById(n, at.cast("int")).sortWithinPartitions("shuffle_key")
