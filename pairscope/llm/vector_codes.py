"""Vector code compression: product codes assigned through a lexicographic trie over distinct parts.

Components become integers, vectors four consecutive parts, and the distinct
parts of each position are kept with their counts, sorted lexicographically.
A sorted run of parts is a trie: a node is a common prefix of dimensions.  The
traversal is depth-first; a node's distances to all codebook entries,
accumulated over its prefix, are computed once and shared by everything below,
and a leaf takes the smallest of them and adds its part, weighted by its count,
to that entry.  All arithmetic is on integers, so results do not depend on how
rows are dealt to tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, small_batches

PARTS = 4
ENTRIES = 256          # per part position: a code is two hex digits
ROUNDS = 4
SCALE = 1024
#: Integers are cut to 32 bits first, and then to ``bound``.
LARGEST = 1 << 30
SIBLINGS = 512         # children of a node whose distances are held at once
EXACT = 1 << 53        # below it float64 sums of integers are exact
#: Bytes of labels and sums up to which they are broadcast.
BROADCAST_BYTES = 16 << 20


def bound(components: int) -> int:
    """Largest integer whose squared distances, summed over a vector, fit a long (2^27 for 64 components)."""
    return min(math.isqrt((1 << 62) // max(components, 1)) // 2, LARGEST)


# --------------------------------------------------------------------- trie
def _tails(x: np.ndarray, book: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Distances of whole parts, ``above`` those of their prefixes, ``x`` and ``book`` the dimensions that are left."""
    return above + (x * x).sum(axis=1)[:, None] + (book * book).sum(axis=1) - 2 * (x @ book.T)


def assign(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each of ``parts`` (n x dimensions, distinct, in lexicographic order).

    Ties go to the lower entry.  A stack frame is a trie node with the run of
    parts below it; ``SIBLINGS`` children at a time get their distances from the
    node's, so the stack holds at most dimensions x SIBLINGS rows of them.
    """
    n, width = parts.shape
    entry, least = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n or not width:
        return entry, least
    reach = int(np.abs(parts).max()) + int(np.abs(book).max())
    kind = np.float64 if width * reach * reach < EXACT else np.int64
    x, c = parts.astype(kind), book.astype(kind)

    def leaves(at: np.ndarray, distances: np.ndarray) -> None:
        best = distances.argmin(axis=1)
        entry[at] = best
        least[at] = distances[np.arange(len(at)), best].astype(np.int64)

    stack = [(0, n, 0, np.zeros(len(c), kind))]
    while stack:
        lo, hi, depth, above = stack.pop()
        column = parts[lo:hi, depth]
        start = lo + np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
        end = np.append(start[1:], hi)
        if len(start) > SIBLINGS:           # the other siblings are visited after all that is below these
            stack.append((int(start[SIBLINGS]), hi, depth, above))
            start, end = start[:SIBLINGS], end[:SIBLINGS]
        below = above + (x[start, depth][:, None] - c[:, depth]) ** 2
        alone = end - start == 1
        if depth + 1 == width:              # the parts are distinct: every child is a leaf
            leaves(start, below)
            continue
        if alone.any():                     # a child without further branches shares nothing more
            leaves(start[alone], _tails(x[start[alone], depth + 1:], c[:, depth + 1:], below[alone]))
        for i in np.flatnonzero(~alone)[::-1]:
            stack.append((int(start[i]), int(end[i]), depth + 1, below[i]))
    return entry, least


def sorted_distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, and the number of each row among them."""
    if not len(parts):
        return parts, np.zeros(0, np.int64)
    order = np.lexsort(parts.T[::-1]) if parts.shape[1] else np.arange(len(parts))
    ranked = parts[order]
    new = np.concatenate([[True], (ranked[1:] != ranked[:-1]).any(axis=1)])
    number = np.empty(len(parts), np.int64)
    number[order] = np.cumsum(new) - 1
    return ranked[new], number


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


# ----------------------------------------------------------------- codebooks
def weighted_sums(parts: DataFrame, books: np.ndarray) -> DataFrame:
    """(pos, entry, dim, total) over the stored distinct parts: sums of the parts of each entry, dim -1 their count.

    A task passes on one row per used entry and dimension, whatever it read.
    """
    width = books.shape[2]
    shared = parts.sparkSession.sparkContext.broadcast(books)   # 4 x 256 x dimensions integers

    def rows(pos: int, totals: np.ndarray) -> pa.RecordBatch:
        used = np.flatnonzero(totals[:, width])
        flat = totals[used].ravel()
        dims = np.append(np.arange(width), -1)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(flat), pos, np.int32)), pa.array(np.repeat(used, width + 1).astype(np.int32)),
             pa.array(np.tile(dims, len(used)).astype(np.int32)), pa.array([str(v) for v in flat.tolist()], pa.string())],
            names=["pos", "entry", "dim", "total"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        held: dict[int, np.ndarray] = {}
        reach: dict[int, int] = {}
        for batch in batches:
            pos, count = batch.column("pos").to_numpy(), batch.column("n").to_numpy()
            every = _matrix(batch.column("part"), width)
            for p in np.unique(pos).tolist():
                mine = np.flatnonzero(pos == p)
                x, number = sorted_distinct(every[mine])
                n = np.zeros(len(x), np.int64)
                np.add.at(n, number, count[mine])
                entry, _ = assign(x, books[p])
                whole = np.column_stack([x, np.ones(len(x), np.int64)])
                most = int(n.sum()) * int(max(np.abs(whole).max(), 1))
                if most + reach.get(p, 0) >= 1 << 62:           # long sums could overflow
                    if p in held:
                        yield rows(p, held.pop(p))
                        reach[p] = 0
                    if most >= 1 << 62:
                        whole, n = whole.astype(object), n.astype(object)
                totals = np.zeros((books.shape[1], width + 1), whole.dtype)
                np.add.at(totals, entry, whole * n[:, None])
                if whole.dtype == object:
                    yield rows(p, totals)
                else:
                    held[p] = held.get(p, 0) + totals
                    reach[p] = reach.get(p, 0) + most
        for p, totals in held.items():
            yield rows(p, totals)

    return (parts.mapInArrow(run, "pos int, entry int, dim int, total string")
            .groupBy("pos", "entry", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))


def next_books(parts: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry replaced by the floored mean of its parts; an unused one stays.  Reads 4 x 256 x dimensions sums."""
    out, width = books.copy(), books.shape[2]
    sums = {(r.pos, r.entry, r.dim): int(r.total) for r in weighted_sums(parts, books).collect()}
    for (pos, entry, dim), total in sums.items():
        if dim >= 0:
            out[pos, entry, dim] = total // sums[pos, entry, -1]
    return out


def codebook_digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal text, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


# ------------------------------------------------------------------ operator
def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, x) of the rows whose vector has finite components only."""
    fit = f"forall(`{vector_col}`, v -> v is not null and not isnan(cast(v as double)) and abs(cast(v as double)) < double('infinity'))"
    whole = (f"transform(`{vector_col}`, v -> cast(floor(greatest(least(cast(v as double) * {SCALE}D, {LARGEST - 1}D), "
             f"-{LARGEST}D)) as int))")
    return (vectors.where(f"`{vector_col}` is not null and {fit}")
            .select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.expr(whole).alias("x")))


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(id, label, code, error) of every vector, and the codebooks (part x entry x position).

    Rows whose vector is null or holds a null or non-finite component are
    dropped; an infinite or null part of a vector thus never counts.  Shorter
    vectors are filled with zeros to the longest one's length, and that to a
    multiple of four, so parts are equal whatever the lengths; without
    components all distances are 0.  Codebooks start from the rows with the
    smallest ids, null ids last and equal ids by their vectors; with fewer rows
    than entries they are that short.  Integers beyond ``bound`` (a component of
    131,072 in 64 of them) count as that, so that every error fits a long.
    Repeated rows count as often as they occur.  Columns besides the three named are ignored; an empty table gives
    an empty result and empty codebooks.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = materialise(integer_vectors(vectors, id_col, vector_col, label_col), "integer-vectors")
    width = -(-(rows.agg(F.max(F.size("x"))).first()[0] or 0) // PARTS)
    most = bound(PARTS * width)
    rows = rows.withColumn("x", F.expr(f"transform(if(size(x) = {PARTS * width}, x, concat(x, array_repeat(0, {PARTS * width} - size(x)))), "
                                       f"v -> greatest(least(v, {most}), -{most}))"))
    first = rows.orderBy(F.asc_nulls_last("id"), "x").limit(entries).select("x").collect()
    books = np.array([r.x for r in first], np.int64).reshape(len(first), PARTS, width).transpose(1, 0, 2).copy()
    if first:
        # Copies of a part meet as partial counts, so a frequent one is no hot key.
        cut = F.expr(f"transform(sequence(0, {PARTS - 1}), i -> slice(x, i * {width} + 1, {width}))")
        parts = materialise(rows.select(F.posexplode(cut).alias("pos", "part")).groupBy("pos", "part")
                            .agg(F.count("*").alias("n")).sortWithinPartitions("pos", "part"), "parts")
        for _ in range(rounds):
            books = next_books(parts, books)
    shared = spark.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        digits = np.array([f"{i:02x}" for i in range(256)])
        for batch in batches:
            n = batch.num_rows
            x = _matrix(batch.column("x"), PARTS * width).reshape(n, PARTS, width)
            code, error = np.full(n, ""), np.zeros(n, np.int64)
            for p in range(PARTS):
                part, number = sorted_distinct(x[:, p])
                entry, least = assign(part, books[p])
                code = np.char.add(code, digits[entry[number]])
                error += least[number]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(code.tolist(), pa.string()),
                                              pa.array(error)], names=["id", "label", "code", "error"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("id", "label"))
    return rows.mapInArrow(run, f"{kinds}, code string, error long"), books


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every vector; see ``encode``.

    ``label_error`` is the error summed over equal labels (nulls together), at
    most the largest long.
    """
    coded, books = encode(vectors, id_col, vector_col, label_col, entries, rounds)
    coded = materialise(coded, "codes")
    sums = materialise(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
                       .select(F.col("label").alias("of"), F.expr("cast(least(total, 9223372036854775807BD) as long)").alias("label_error")),
                       "label-errors")
    room = sums.agg(F.sum(F.coalesce(F.octet_length(F.col("of").cast("string")), F.lit(0)) + 32)).first()[0] or 0
    if room <= BROADCAST_BYTES:   # beyond it a shuffled join, whose hot labels adaptive execution splits
        sums = F.broadcast(sums)
    return (coded.join(sums, F.expr("label <=> of"))
            .select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256")))
