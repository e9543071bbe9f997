"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Character 1- to 3-grams of the letters of a text are hashed into buckets;
document frequencies come from all training documents.  The model is fitted by
follow-the-regularised-leader (FTRL-proximal) with L1 and L2 penalties on a
bounded sample of labelled rows, then a temperature is fitted on further rows
that the weights have not seen.  Prediction is one pass over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, held_out, small_batches

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
CHUNK = 1 << 20           # characters hashed at a time
UNKNOWN = "und"
#: Languages that are learned, those with most texts (a parameter of ``fit``): bounds the weights, 32,769 a language.
MAX_LANGUAGES = 256
#: A text is identified if its score lies this far from an even guess to certainty, however many languages are known,
#: and at least this share of its n-grams occurs in the training documents (0.99 of a text in a learned language does,
#: about 0.2 in a script that no document has).
MIN_LIFT, MIN_KNOWN = 1 / 15, 0.5
#: Bound of the labelled rows fitted on, over all languages (a parameter of
#: ``fit``); a quarter of them only fit the temperature.
MAX_ROWS = 2400


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of the whole text; None if it has no letter.

    Case is dropped; runs of anything but letters act as one space.
    """
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters()[code]
    if not letter.any():
        return None
    code = np.where(letter, code, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]          # the first of a run of other characters stays, as the space
    code = code[keep][: None if letter[-1] else -1]
    code = np.concatenate([[np.uint32(32)], code, [np.uint32(32)]]).astype(np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    for lo in range(0, len(code), CHUNK):
        part = code[lo: lo + CHUNK + 2]
        new = min(CHUNK, len(code) - lo)      # n-grams that start in this chunk
        gram = np.zeros(len(part), np.uint32)
        for n in range(1, 4):
            gram = (gram[: len(part) - n + 1] * np.uint32(0x01000193)) ^ part[n - 1:]
            gram *= np.uint32(0x85EBCA6B)
            slot = gram[:new] >> np.uint32(32 - BUCKET_BITS)
            counts += np.bincount(slot, minlength=BUCKETS)
    return counts


@dataclass
class Model:
    classes: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    seen: np.ndarray | None = None      # whether the training documents have an n-gram

    def values(self, slots: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """TF-IDF of the n-grams in ``slots``, of length 1."""
        x = (1.0 + np.log(counts)) * self.idf[slots]
        return x / max(float(np.sqrt(x @ x)), 1e-12)

    def logits(self, slots: np.ndarray, values: np.ndarray) -> np.ndarray:
        return values @ self.weights[slots] + self.bias

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        slots = np.flatnonzero(counts)
        return softmax(self.logits(slots, self.values(slots, counts[slots])) / self.temperature)


def softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max())
    return e / e.sum()


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_classes: int, epochs: int = 4, alpha: float = 0.5,
         beta: float = 1.0, l1: float = 0.02, l2: float = 0.5, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Weights (buckets x classes) and bias of the softmax model; ``rows``: slots, values, class."""
    z = np.zeros((BUCKETS + 1, n_classes))
    n = np.zeros_like(z)

    def weights(zs: np.ndarray, ns: np.ndarray, penalty: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - penalty, 0)
        return -shrunk / ((beta + np.sqrt(ns)) / alpha + l2)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            slots, x, y = rows[i]
            at, v = np.append(slots, BUCKETS), np.append(x, 1.0)
            penalty = np.where(at < BUCKETS, l1, 0.0)[:, None]     # the bias is not shrunk
            zs, ns = z[at], n[at]
            w = weights(zs, ns, penalty)
            error = softmax(v @ w)
            error[y] -= 1
            g = v[:, None] * error
            z[at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha * w
            n[at] = ns + g * g
    penalty = np.full((BUCKETS + 1, 1), l1)
    penalty[-1] = 0
    w = weights(z, n, penalty)
    return w[:-1], w[-1]


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """Temperature of least log-loss (golden section over its logarithm).

    The labels are smoothed as if one more row had been wrong, so that rows the
    model separates fully still give a finite temperature.
    """
    rows, k = logits.shape
    target = np.full((rows, k), 1 / (rows + 2) / max(k - 1, 1))
    target[np.arange(rows), y] = 1 - (1 / (rows + 2) if k > 1 else 0)

    def loss(log_t: float) -> float:
        v = logits / np.exp(log_t)
        v = v - v.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(v).sum(axis=1)) - (target * v).sum(axis=1)))
    lo, hi, r = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    df, docs = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            counts = gram_counts(text)
            if counts is not None:
                df += counts > 0
                docs += 1
    slots = np.flatnonzero(df)
    yield pd.DataFrame({"slot": np.append(slots, BUCKETS), "n": np.append(df[slots], docs)})


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for lang, h, calibrates, text in zip(batch["lang"], batch["h"], batch["calibrates"], batch["text"]):
            counts = gram_counts(text)
            if counts is not None:
                slots = np.flatnonzero(counts)
                rows.append((lang, h, calibrates, slots.astype(np.int32).tobytes(), counts[slots].astype(np.int32).tobytes()))
        yield pd.DataFrame(rows, columns=["lang", "h", "calibrates", "slots", "counts"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_rows: int = MAX_ROWS, max_languages: int = MAX_LANGUAGES) -> Model | None:
    """Model of the languages in ``lang_col``; None if no labelled row is left.

    Learns from rows with a language that are not held out (crc32 of the id mod
    5 is 0).  Document frequencies count all of them; the weights are fitted on
    at most ``max_rows`` rows, about the same number per language, those with
    the smallest hash of their text.  Of more than ``max_languages`` values in
    ``lang_col`` those with most texts are learned.
    """
    known = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), held_out(id_col).alias("out")).where(
        "not out and lang is not null and text is not null").drop("out")
    got = known.select("text").mapInPandas(_frequencies, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(BUCKETS + 1)
    df[got["slot"].to_numpy(np.int64)] = got["n"].to_numpy(np.float64)
    digest = F.xxhash64("text", F.lit(1))
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.approx_count_distinct(digest).alias("n"))
             .orderBy(F.desc("n"), "lang").limit(max_languages).collect()}
    classes = sorted(sizes)
    if not classes or df[BUCKETS] == 0:
        return None
    per_class = max(1, max_rows // len(classes))
    # A language with more texts gives those whose hash lies below its share of all hashes.  Copies of a text count once.
    edges = docs.sparkSession.createDataFrame(
        [(c, (1 << 63) - 1 if n <= per_class else int(-(1 << 63) + (1 << 64) * 0.9 * per_class / n)) for c, n in sizes.items()],
        "lang string, most long")
    sample = (known.withColumn("h", digest).join(F.broadcast(edges), "lang").where("h <= most").drop("most")
              .dropDuplicates(["lang", "h"]).withColumn("calibrates", F.expr("pmod(h, 4) = 0"))
              .mapInPandas(_features, "lang string, h long, calibrates boolean, slots binary, counts binary")
              .collect())
    sample.sort(key=lambda r: (r.lang, r.h))
    sample = [r for c in classes for r in [x for x in sample if x.lang == c][:per_class]]
    idf = np.log((1 + df[BUCKETS]) / (1 + df[:BUCKETS])) + 1
    model = Model(classes, idf, np.zeros((BUCKETS, len(classes))), np.zeros(len(classes)), seen=df[:BUCKETS] > 0)
    number = {c: i for i, c in enumerate(classes)}
    fitting, held = [], []
    for r in sample:
        slots = np.frombuffer(r.slots, np.int32)
        row = slots, model.values(slots, np.frombuffer(r.counts, np.int32)), number[r.lang]
        (held if r.calibrates else fitting).append(row)
    model.weights, model.bias = ftrl(fitting, len(classes))
    if held:
        model.temperature = calibrate(np.stack([model.logits(slots, x) for slots, x, _ in held]), np.array([y for *_, y in held]))
    return model


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus lang_pred, score and known (the share of its n-grams that training documents have).

    Existing columns of those names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "known")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "known": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages numbers

    @F.pandas_udf("lang_pred string, score double, known double")
    def classify(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in texts:
            langs, scores, known = [], [], []
            for text in batch:
                counts = gram_counts(text)
                if counts is None:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    known.append(0.0)
                else:
                    p = m.probabilities(counts)
                    langs.append(m.classes[int(p.argmax())])
                    scores.append(float(p.max()))
                    known.append(float(counts[m.seen].sum() / counts.sum()))
            yield pd.DataFrame({"lang_pred": langs, "score": scores, "known": known})

    out = fresh(docs.columns, "prediction")
    return (docs.withColumn(out, classify(F.col(text_col)))
            .select(*docs.columns, f"{out}.lang_pred", f"{out}.score", f"{out}.known"))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` plus lang_pred (a learned language), score (its calibrated probability) and known (see ``predict``).

    A null text, or one without a letter, is ``und`` with score 0, and so is
    every row if there is nothing to learn from (an empty table, no labels).
    Repeated rows and null or clashing other columns do not matter.
    """
    small_batches(docs.sparkSession)
    return predict(docs, fit(docs, id_col, text_col, lang_col, max_rows), id_col, text_col)


def keep_identified(docs: DataFrame, min_lift: float = MIN_LIFT, min_known: float = MIN_KNOWN, id_col: str = "doc_id",
                    text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS) -> DataFrame:
    """Rows of ``docs`` whose language is identified.

    That is, not ``und``; of k learned languages the score is at least 1/k plus
    ``min_lift`` of the way to 1 (always met by a single language); and at least
    ``min_known`` of the n-grams are known.
    """
    small_batches(docs.sparkSession)
    bare = docs.select(*[F.col(c).alias(f"c_{c}") for c in docs.columns])
    names = f"c_{id_col}", f"c_{text_col}"
    model = fit(bare, *names, f"c_{lang_col}", max_rows)
    k = len(model.classes) if model else 1
    least = 1 / k + min_lift * (1 - 1 / k) if k > 1 else 0.0
    found = predict(bare, model, *names)
    return (found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least) & (F.col("known") >= min_known))
            .select(*[F.col(f"c_{c}").alias(c) for c in docs.columns]))
