"""Main text of HTML pages by a recurrent block labeller.

A page is a sequence of leaf blocks.  A block's vector is the mean vector of
its hashed tag-path words (tags, class and id words), the mean vector of its
hashed words and a few plain numbers; a bidirectional LSTM reads the whole
sequence, so every block is labelled with the context of all others.  Network
and back-propagation are numpy; it learns from generated pages of many layouts
(``html_blocks.Generator``), so no labelled pages are needed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches
from .html_blocks import NUMBERS, PATH_SLOTS, WORD_SLOTS, Block, Generator, Slots, blocks_of, inputs

PATH_SIZE, WORD_SIZE, HIDDEN = 20, 10, 20
TRAIN_PAGES, EPOCHS, BATCH = 2400, 4, 24
GROUP_BLOCKS = 20_000     # blocks of pages labelled together


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    size = PATH_SIZE + WORD_SIZE + NUMBERS
    p = {"path": rng.normal(0, 0.3, (PATH_SLOTS, PATH_SIZE)), "word": rng.normal(0, 0.1, (WORD_SLOTS, WORD_SIZE)),
         "out": rng.normal(0, 0.2, 2 * HIDDEN), "bias": np.zeros(1)}
    for d in "fb":
        p[f"{d}x"] = rng.normal(0, 1 / np.sqrt(size), (size, 4 * HIDDEN))
        p[f"{d}h"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        p[f"{d}0"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    return {k: v.astype(np.float32) for k, v in p.items()}


def lstm(x: np.ndarray, mask: np.ndarray, wx: np.ndarray, wh: np.ndarray, b: np.ndarray, keep: bool = False):
    """States (time x batch x hidden) of one direction; a masked step leaves the state as it is."""
    steps, batch, _ = x.shape
    gates = x.reshape(steps * batch, -1) @ wx + b
    gates = gates.reshape(steps, batch, -1)
    h, c = np.zeros((batch, HIDDEN), np.float32), np.zeros((batch, HIDDEN), np.float32)
    out, cache = np.empty((steps, batch, HIDDEN), np.float32), []
    for t in range(steps):
        z = gates[t] + h @ wh
        i, f, o = np.split(sigmoid(z[:, : 3 * HIDDEN]), 3, axis=1)
        g = np.tanh(z[:, 3 * HIDDEN:])
        m = mask[t][:, None]
        new_c = f * c + i * g
        tanh_c = np.tanh(new_c)
        if keep:
            cache.append((i, f, o, g, c, h, tanh_c))
        h, c = m * (o * tanh_c) + (1 - m) * h, m * new_c + (1 - m) * c
        out[t] = h
    return out, cache


def lstm_back(d_out: np.ndarray, x: np.ndarray, mask: np.ndarray, wx: np.ndarray, wh: np.ndarray, cache: list):
    """Gradients of ``lstm``: of its input, wx, wh and b."""
    steps, batch, _ = x.shape
    dz = np.empty((steps, batch, 4 * HIDDEN), np.float32)
    d_wh = np.zeros_like(wh)
    dh, dc = np.zeros((batch, HIDDEN), np.float32), np.zeros((batch, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, c, h, tanh_c = cache[t]
        m = mask[t][:, None]
        dh = dh + d_out[t]
        dh_new, dc_new = dh * m, dc * m
        dc_new = dc_new + dh_new * o * (1 - tanh_c ** 2)
        dz[t] = np.concatenate([dc_new * g * i * (1 - i), dc_new * c * f * (1 - f), dh_new * tanh_c * o * (1 - o),
                                dc_new * i * (1 - g ** 2)], axis=1)
        d_wh += h.T @ dz[t]
        dh = dh * (1 - m) + dz[t] @ wh.T
        dc = dc * (1 - m) + dc_new * f
    flat = dz.reshape(steps * batch, -1)
    return (flat @ wx.T).reshape(x.shape), x.reshape(steps * batch, -1).T @ flat, d_wh, flat.sum(axis=0)


def pooled(table: np.ndarray, ids: list[np.ndarray]) -> np.ndarray:
    """Mean row of ``table`` for each list of slots."""
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    starts = np.cumsum(lengths) - lengths
    return np.add.reduceat(table[np.concatenate(ids)], starts, axis=0) / lengths[:, None].astype(np.float32)


class Labeller:
    """The network for a batch of pages, each given as ``inputs`` of its blocks."""

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = parameters

    def layout(self, lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Mask, and the places (time, page) of all blocks forwards and with every page reversed."""
        page = np.repeat(np.arange(len(lengths)), lengths)
        step = np.concatenate([np.arange(n) for n in lengths])
        back = np.concatenate([np.arange(n)[::-1] for n in lengths])
        mask = (np.arange(max(lengths))[:, None] < np.asarray(lengths)[None, :]).astype(np.float32)
        return mask, page, step, back

    def run(self, pages: list[tuple], keep: bool = False):
        lengths = [len(n) for _, _, n in pages]
        mask, page, step, back = self.layout(lengths)
        x = np.concatenate([pooled(self.p["path"], [i for p, _, _ in pages for i in p]),
                            pooled(self.p["word"], [i for _, w, _ in pages for i in w]),
                            np.concatenate([n for _, _, n in pages])], axis=1).astype(np.float32)
        states, tapes = [], []
        for d, place in (("f", step), ("b", back)):
            padded = np.zeros((len(mask), len(pages), x.shape[1]), np.float32)
            padded[place, page] = x
            out, cache = lstm(padded, mask, self.p[f"{d}x"], self.p[f"{d}h"], self.p[f"{d}0"], keep)
            states.append(out[place, page])
            tapes.append((d, place, padded, cache))
        state = np.concatenate(states, axis=1)
        return state @ self.p["out"] + self.p["bias"][0], (mask, page, state, tapes)

    def gradients(self, pages: list[tuple], label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        score, (mask, page, state, tapes) = self.run(pages, keep=True)
        d = ((sigmoid(score) - label) * weight / max(weight.sum(), 1)).astype(np.float32)
        grad = {"out": state.T @ d, "bias": np.array([d.sum()], np.float32)}
        d_state = d[:, None] * self.p["out"][None, :]
        d_x = 0
        for k, (name, place, padded, cache) in enumerate(tapes):
            d_out = np.zeros((len(mask), len(pages), HIDDEN), np.float32)
            d_out[place, page] = d_state[:, k * HIDDEN: (k + 1) * HIDDEN]
            dx, grad[f"{name}x"], grad[f"{name}h"], grad[f"{name}0"] = lstm_back(
                d_out, padded, mask, self.p[f"{name}x"], self.p[f"{name}h"], cache)
            d_x = d_x + dx[place, page]
        for table, lo, size, which in (("path", 0, PATH_SIZE, 0), ("word", PATH_SIZE, WORD_SIZE, 1)):
            ids = [i for p in pages for i in p[which]]
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            grad[table] = np.zeros_like(self.p[table])
            np.add.at(grad[table], np.concatenate(ids), np.repeat(d_x[:, lo: lo + size] / lengths[:, None], lengths, axis=0))
        return grad


def training_pages(n: int, seed: int) -> list[tuple[tuple, np.ndarray, np.ndarray]]:
    """Inputs, labels and weights of generated pages; a text in both a main and another block has weight 0."""
    made, out = Generator(seed), []
    slots = Slots(PATH_SLOTS), Slots(WORD_SLOTS)
    for _ in range(n):
        page, mains, others = made.page()
        blocks = blocks_of(page)
        out.append((inputs(blocks, *slots), np.array([b.text in mains for b in blocks], np.float32),
                    np.array([(b.text in mains) != (b.text in others) for b in blocks], np.float32)))
    return out


@lru_cache(maxsize=2)
def train(seed: int = 3, pages: int = TRAIN_PAGES, epochs: int = EPOCHS) -> Labeller:
    """Labeller fitted by Adam; the same for the same arguments."""
    data = training_pages(pages, seed)
    model = Labeller(initial(seed))
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    order, step = np.random.default_rng(seed), 0
    for epoch in range(epochs):
        rate = 0.01 * (0.5 ** epoch)
        by_length = sorted(order.permutation(len(data)), key=lambda i: len(data[i][1]))
        batches = [by_length[i: i + BATCH] for i in range(0, len(by_length), BATCH)]
        for b in order.permutation(len(batches)):
            chosen = [data[i] for i in batches[b]]
            grad = model.gradients([c[0] for c in chosen], np.concatenate([c[1] for c in chosen]), np.concatenate([c[2] for c in chosen]))
            norm = np.sqrt(sum(float((g ** 2).sum()) for g in grad.values()))
            step += 1
            for k, g in grad.items():
                g = g * min(1.0, 1.0 / max(norm, 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model.p[k] = model.p[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    model.p = {k: v.astype(np.float32) for k, v in model.p.items()}
    return model


_fitted: dict[tuple, dict[str, np.ndarray]] = {}


def fitted(spark: SparkSession, seed: int = 3, pages: int = TRAIN_PAGES, epochs: int = EPOCHS) -> Labeller:
    """``train`` as a Spark task, so that an executor does the work; kept for the next call of this process."""
    key = (seed, pages, epochs)
    if key not in _fitted:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for _ in batches:
                p = train(*key).p
                yield pd.DataFrame({"name": list(p), "shape": [list(v.shape) for v in p.values()], "data": [v.tobytes() for v in p.values()]})
        rows = spark.range(1).repartition(1).mapInPandas(run, "name string, shape array<int>, data binary").collect()   # 0.2 MB
        _fitted[key] = {r.name: np.frombuffer(r.data, np.float32).reshape(r.shape).copy() for r in rows}
    return Labeller(_fitted[key])


def label_pages(model: Labeller, pages: list[list[Block]], slots: tuple[Slots, Slots]) -> list[np.ndarray]:
    """Whether each block is main text; pages of similar length are read together."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    group: list[int] = []
    for k, i in enumerate(order):
        group.append(i)
        if k + 1 == len(order) or (len(group) + 1) * len(pages[order[k + 1]]) > GROUP_BLOCKS:
            score, _ = model.run([inputs(pages[j], *slots) for j in group])
            cut = np.cumsum([len(pages[j]) for j in group])[:-1]
            for j, s in zip(group, np.split(score > 0, cut)):
                out[j] = s
            group = []
    return out


def extract(pages: DataFrame, html_col: str = "html", model: Labeller | None = None) -> DataFrame:
    """``pages`` without its html, plus text, n_chars, n_blocks and n_main.

    ``text`` joins the main blocks in page order by one space; it is empty if
    the html is null, empty or has no main block.  A page of a million blocks is
    read whole, in a batch of its own.  Repeated pages give repeated
    rows; other columns, nulls too, are passed on; existing columns of the new
    names are replaced; an empty table gives an empty result.
    """
    small_batches(pages.sparkSession)
    pages = pages.drop("text", "n_chars", "n_blocks", "n_main")
    shared = pages.sparkSession.sparkContext.broadcast((model or fitted(pages.sparkSession)).p)   # 0.2 MB

    @F.pandas_udf("text string, n_blocks long, n_main long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeller, slots = Labeller(shared.value), (Slots(PATH_SLOTS), Slots(WORD_SLOTS))
        for batch in batches:
            rows, held, size = [], [], 0
            for page in batch:
                held.append(blocks_of(page))
                size += len(held[-1])
                if size > 4 * GROUP_BLOCKS:
                    rows += label(labeller, held, slots)
                    held, size = [], 0
            rows += label(labeller, held, slots)
            yield pd.DataFrame(rows, columns=["text", "n_blocks", "n_main"])

    def label(labeller: Labeller, held: list[list[Block]], slots: tuple[Slots, Slots]) -> list[tuple]:
        return [(" ".join(b.text for b, k in zip(blocks, keep) if k), len(blocks), int(keep.sum()))
                for blocks, keep in zip(held, label_pages(labeller, held, slots))]

    kept = [c for c in pages.columns if c != html_col]
    out = "extracted"
    while out in pages.columns:
        out = "_" + out
    return (pages.withColumn(out, run(F.col(html_col))).select(
        *kept, f"{out}.text", F.char_length(f"{out}.text").cast("long").alias("n_chars"), f"{out}.n_blocks", f"{out}.n_main"))
