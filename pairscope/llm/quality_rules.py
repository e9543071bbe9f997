"""Quality rules: an isolation forest on rule statistics, its threshold calibrated from labelled rows.

Two fixed rules fail a text outright.  Every other text is judged by its rule
statistics: trees split them at random places until points are alone, and a
point that is alone after few splits is unlike the good documents.  The forest
is grown from a bounded sample of labelled rows; the threshold on the mean path
length is set on the scores of all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, small_batches

# Fixed rules and character sets.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
UPPER = bytes(range(65, 91))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics that the trees split.
NAMES = ("log_words", "word_length", "log_symbols", "dup_lines", "repeat_words", "upper", "distinct_words")

TREES = 100
#: Rows a tree is grown from, and the share of them that is labelled bad: such
#: rows stretch the ranges that splits are drawn from, so a statistic that good
#: rows never vary is split too.
SAMPLE, BAD_SHARE = 4096, 0.002
#: Bounds of the labelled rows that the forest is grown from (parameters of ``fit``).
MAX_GOOD, MAX_BAD = 16384, 1024
BINS = 10_000
EULER = 0.5772156649015329


# --------------------------------------------------------------- statistics
def statistics(raw: bytes) -> tuple[tuple[int, ...], np.ndarray]:
    """COUNTS and NAMES of one whole text (UTF-8 bytes; bytes that split words are single characters)."""
    words = raw.split()
    n = len(words)
    if not n:
        return (0, 0, len(raw) - len(raw.translate(None, SYMBOLS)), 0, 0), np.zeros(len(NAMES), np.float32)
    points = len(raw.decode("utf-8", "replace"))
    chars = points - (len(raw) - len(raw.translate(None, SPACES)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    dups = len(lines) - len(set(lines))
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    repeated = 0
    if n > 2:
        seq = np.fromiter(map(ids.__getitem__, words), np.int64, n)
        pairs = np.unique(seq[:-1] * len(ids) + seq[1:], return_inverse=True)[1]
        _, window, count = np.unique(pairs[:-1] * len(ids) + seq[2:], return_inverse=True, return_counts=True)
        often = count[window] > 1
        covered = np.zeros(n, bool)
        for i in range(3):
            covered[i: n - 2 + i] |= often
        repeated = int(covered.sum())
    upper = len(raw) - len(raw.translate(None, UPPER))
    x = np.array([np.log(n), chars / n, np.log1p(1000 * symbols / chars), dups / len(lines), repeated / n, upper / chars,
                  len(ids) / n], np.float32)
    return (n, chars, symbols, dups, repeated), x


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, COUNTS, base_failed, x) of every row: XXH64 of the text, counts, fixed rules, statistics."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [statistics(raw) for raw in batch["raw"]]
            counts = np.array([c for c, _ in found], np.int64).reshape(len(found), len(COUNTS))
            yield pd.DataFrame({"id": batch["id"], "digest": batch["digest"], **{c: counts[:, i] for i, c in enumerate(COUNTS)},
                                "x": [x for _, x in found]})
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("digest"), text.cast("binary").alias("raw"))
    kind = rows.schema["id"].dataType.simpleString()
    return (rows.withColumn("id", F.col("id").cast("string"))
            .mapInPandas(run, "id string, digest long, " + ", ".join(f"{c} long" for c in COUNTS) + ", x array<float>")
            .withColumns({"id": F.col("id").cast(kind), "base_failed": F.expr(
                f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")}))


# ------------------------------------------------------------------- forest
def mean_depth(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n, 2) - 1) + EULER) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees in flat arrays; a leaf has feature -1 and its path length as ``value``."""

    feature: np.ndarray    # trees x nodes
    cut: np.ndarray
    left: np.ndarray       # the right child follows the left one
    value: np.ndarray
    depth: int
    expected: float        # mean path length among the rows a tree is grown from

    def score(self, x: np.ndarray) -> np.ndarray:
        """2^(-mean path length / expected): near 1 for rows that are alone early, below 1/2 for ordinary ones."""
        total = np.zeros(len(x))
        if not len(self.feature):
            return np.full(len(x), 0.5)
        for f, c, l, v in zip(self.feature, self.cut, self.left, self.value):
            node = np.zeros(len(x), np.int64)
            rows = np.arange(len(x))
            for _ in range(self.depth):
                inner = f[node[rows]] >= 0
                rows = rows[inner]
                if not len(rows):
                    break
                at = node[rows]
                node[rows] = l[at] + (x[rows, f[at]] > c[at])
            total += v[node]
        return 2.0 ** (-total / len(self.feature) / self.expected)


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, sample: int = SAMPLE, bad_share: float = BAD_SHARE, seed: int = 12) -> Forest:
    """Forest from the rows ``x`` with labels ``y`` (1 good, 0 bad).

    Every tree takes ``sample`` rows at random, ``bad_share`` of them (2 at
    least) bad ones, as far as there are any.  Nodes split a statistic that
    varies in them, drawn at random, at a uniform place between its least and
    largest value.  Without rows every score is 1/2.
    """
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    b = min(max(2, round(sample * bad_share)), len(bad))
    a = min(sample - b, len(good))
    if a + b < 2:
        empty = np.zeros((0, 1))
        return Forest(empty.astype(np.int8), empty, empty.astype(np.int32), empty, 0, 1.0)
    depth = int(np.ceil(np.log2(a + b)))
    grown = []
    for _ in range(trees):
        points = x[np.concatenate([rng.choice(good, a, replace=False), rng.choice(bad, b, replace=False)])].astype(np.float64)
        feature, cut, left, value = [-1], [0.0], [0], [0.0]
        todo = [(0, np.arange(len(points)), 0)]
        while todo:
            node, rows, level = todo.pop()
            low, high = points[rows].min(axis=0), points[rows].max(axis=0)
            varied = np.flatnonzero(high > low)
            if level == depth or not len(varied):
                value[node] = level + float(mean_depth(len(rows)))
                continue
            f = int(rng.choice(varied))
            c = float(rng.uniform(low[f], high[f]))
            right = points[rows, f] > c
            if not right.any() or right.all():       # the draw met an end of the range
                c = float(low[f])
                right = points[rows, f] > c
            feature[node], cut[node], left[node] = f, c, len(feature)
            feature += [-1, -1]
            cut += [0.0, 0.0]
            left += [0, 0]
            value += [0.0, 0.0]
            todo += [(left[node], rows[~right], level + 1), (left[node] + 1, rows[right], level + 1)]
        grown.append((feature, cut, left, value))
    nodes = max(len(t[0]) for t in grown)

    def table(i: int, kind) -> np.ndarray:
        return np.array([t[i] + [0] * (nodes - len(t[i])) for t in grown], kind)
    return Forest(table(0, np.int8), table(1, np.float64), table(2, np.int32), table(3, np.float32), depth, float(mean_depth(a + b)))


def labelled(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(digest, y, x) of the labelled rows that pass the fixed rules; copies of a text with one label are one row."""
    marks = (labels.select(F.col(id_col).alias("of"), F.col(label_col).cast("int").alias("y"))
             .where("y in (0, 1) and of is not null"))
    return stats.where("not base_failed").join(marks, F.expr("id = of")).select("digest", "y", "x").dropDuplicates(["digest", "y"])


def fit(known: DataFrame, max_good: int = MAX_GOOD, max_bad: int = MAX_BAD, **options) -> Forest:
    """Forest from at most ``max_good`` good and ``max_bad`` bad rows of ``known``, those with the smallest hashes."""
    got = [known.where(f"y = {y}").orderBy(F.xxhash64("digest"), "digest").limit(most).select("y", "x").toPandas()
           for y, most in ((1, max_good), (0, max_bad))]
    got = pd.concat(got)
    x = np.stack(got["x"].to_list()) if len(got) else np.zeros((0, len(NAMES)), np.float32)
    return grow(x, got["y"].to_numpy(np.int64), **options)


def calibrate(scored: DataFrame) -> float:
    """Threshold on the score above which a row goes, from the labelled rows (score, y).

    Of the cuts at bin ends the one with the most bad rows above it less good
    rows above it (as shares), and of equal ones the largest, which keeps most.
    Without good or without bad rows nothing goes (1.0).  Reads 2 x BINS counts.
    """
    counts = np.zeros((2, BINS + 1))
    for r in scored.groupBy("y", F.expr(f"cast(least(floor(score * {BINS}), {BINS - 1}) as int)").alias("bin")).count().collect():
        counts[r.y, r.bin] = r["count"]
    if not counts[0].sum() or not counts[1].sum():
        return 1.0
    above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] / counts.sum(axis=1, keepdims=True)   # at or above a bin's start
    benefit = above[0] - above[1]
    return float(BINS - benefit[::-1].argmax()) / BINS


# ------------------------------------------------------------------ operator
def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_good: int = MAX_GOOD, max_bad: int = MAX_BAD) -> DataFrame:
    """(id, COUNTS, base_failed, kept, score) of every row of ``docs``.

    ``kept`` is false if a fixed rule fails, else whether the forest's score is
    below the threshold.  A null or empty text has no words and fails.  Rows
    without an id are judged like others but never labelled; repeated rows get
    equal results.  Label rows with other values than 0 and 1 are passed over;
    without good or without bad ones only the fixed rules decide.  Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    stats = materialise(document_statistics(docs, id_col, text_col), "rule-statistics")
    known = materialise(labelled(stats, labels, id_col, label_col), "rule-labels")
    shared = spark.sparkContext.broadcast(fit(known, max_good, max_bad))    # trees x nodes numbers

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.stack(batch.to_list()).astype(np.float64) if len(batch) else np.zeros((0, len(NAMES)))
            yield pd.Series(shared.value.score(x))

    cut = calibrate(known.select("y", score("x").alias("score")))
    return (stats.withColumn("score", score("x"))
            .select(F.col("id").alias(id_col), *COUNTS, "base_failed",
                    F.expr(f"not base_failed and (score < {cut}D or {cut}D >= 1D)").alias("kept"), "score"))
