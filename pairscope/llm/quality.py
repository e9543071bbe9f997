"""Quality classifier: gradient-boosted trees over document statistics.

One pass over the whole texts computes the statistics of every document and
stores them; the trees are fitted on a bounded sample of labelled documents
and then score the stored statistics.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gbt
from .common import held_out, materialise, small_batches

#: Bound of the labelled documents fitted on (a parameter of ``fit``).
MAX_ROWS = 20000
MARKS = ".,;:!?|#$%&*@<>{}[]()/\\_-+=~^\"'"
NAMES = (["log_bytes", "log_words", "log_lines", "word_length", "word_length_sd", "long_words", "upper", "upper_words",
          "digits", "spaces", "control", "non_ascii", "marks"]
         + [f"mark_{ord(c)}" for c in MARKS]
         + ["unique_words", "top_word", "entropy", "repeated_next", "repeated_pairs", "repeated_triples",
            "repeated_lines", "line_words", "ends_stop"])


def statistics(text: str | None) -> np.ndarray:
    """The numbers of NAMES for one whole text; an empty or null text gives zeros."""
    out = np.zeros(len(NAMES), np.float32)
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        out[0] = np.log1p(len(raw))
        return out
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = len(raw)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    upper, lower = count[65:91].sum(), count[97:123].sum()
    lines = raw.split(b"\n")
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    seq = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    freq = np.bincount(seq) / len(seq)

    def repeated(codes: np.ndarray) -> float:
        return 1 - len(np.unique(codes)) / len(codes) if len(codes) else 0.0

    pairs = seq[:-1] * len(ids) + seq[1:]
    rank = np.unique(pairs, return_inverse=True)[1] if len(pairs) else pairs
    triples = rank[:-1] * len(ids) + seq[2:] if len(seq) > 2 else rank[:0]
    out[:13] = (np.log1p(size), np.log1p(len(words)), np.log1p(len(lines)), lengths.mean(), lengths.std(),
                (lengths > 15).mean(), upper / max(upper + lower, 1), sum(map(bytes.isupper, words)) / len(words),
                count[48:58].sum() / size, (count[32] + count[9:14].sum()) / size, count[:9].sum() / size,
                count[128:].sum() / size, (count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum()) / size)
    out[13: 13 + len(MARKS)] = count[[ord(c) for c in MARKS]] / len(words)
    out[13 + len(MARKS):] = (
        len(ids) / len(words), freq.max(), -(freq * np.log(freq)).sum(),
        (seq[1:] == seq[:-1]).mean() if len(seq) > 1 else 0.0, repeated(pairs), repeated(triples),
        1 - len(set(lines)) / len(lines), len(words) / len(lines),
        sum(l.rstrip().endswith((b".", b"!", b"?")) for l in lines) / len(lines))
    return out


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, digest, x) of every row: XXH64 of the text and its statistics."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "held_out": batch["held_out"], "digest": batch["digest"],
                                "x": [statistics(t) for t in batch["text"]]})
    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return (rows.withColumn("id", F.col("id").cast("string"))
            .mapInPandas(run, "id string, held_out boolean, digest long, x array<float>")
            .withColumn("id", F.col("id").cast(kind)))


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        max_rows: int = MAX_ROWS, **options) -> gbt.Trees:
    """Trees for ``label_col`` (0 or 1; other values and nulls are passed over) from rows that are not held out.

    Copies of a text with one label count once.  If more than ``max_rows`` are
    left, those whose text hash falls below a cut are taken, with the cut set
    for 95 % of the bound.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1) and id is not null")
    known = materialise(stats.where("not held_out").join(marked, "id").select("digest", "y", "x")
                        .dropDuplicates(["digest", "y"]), "labelled")
    n = known.count()
    if n > max_rows:
        known = known.where(F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) < int((1 << 30) * 0.95 * max_rows / n)).limit(max_rows)
    got = known.orderBy("digest", "y").toPandas()
    x = np.stack(got["x"].to_list()).astype(np.float64) if len(got) else np.zeros((0, len(NAMES)))
    return gbt.fit(x, got["y"].to_numpy(np.float64), **options)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", max_rows: int = MAX_ROWS, threshold: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted) of every row of ``docs``.

    The score uses the text alone; null and empty texts are scored as texts
    without words.  Rows without an id are held out.  Repeated rows get equal
    scores; without labels every score is 1/2.  Other columns are ignored; an
    empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    stats = materialise(document_statistics(docs, id_col, text_col), "statistics")
    shared = docs.sparkSession.sparkContext.broadcast(fit(stats, labels, id_col, label_col, max_rows))  # trees x nodes numbers

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.stack(batch.to_list()).astype(np.float64) if len(batch) else np.zeros((0, len(NAMES)))
            yield pd.Series(np.concatenate([shared.value.score(x[i: i + 4096]) for i in range(0, len(x), 4096)])
                            if len(x) else np.zeros(0))

    return (stats.select(F.col("id").alias(id_col), "held_out", score("x").alias("score"))
            .withColumn("predicted", F.expr(f"if(score >= {threshold}D, 1, 0)")))
