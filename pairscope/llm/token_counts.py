"""Token counts by offset-mapped attribution.

A document is encoded once, as a whole.  Byte-level BPE loses nothing, so the
byte lengths of the tokens add up to the byte offsets of each token, and these
map to character spans.  Token spans and section spans are both sorted, so the
interval join of the two is a pair of binary searches; a token that crosses a
boundary is allocated by an explicit rule.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Splitting pattern of that vocabulary (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space as that pattern knows it (fixed value).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUNS = re.compile(f"[{WHITE}]{{256,}}")
#: White space characters in a row up to which the pattern is left to find their end.
LONG = 1 << 16
#: most: the section with most of the token's characters, ties to the earlier;
#: first: the section of its first character that lies in any; split: every
#: section gets the share of the token's characters that it holds.
RULES = ("most", "first", "split")


class Encoder:
    """Token ids of a text and the byte length of each token."""

    def __init__(self, vocabulary: bytes, pattern: str):
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.splits = pattern == PATTERN
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)

    def ids(self, text: str) -> np.ndarray:
        """Token ids of the whole text.

        The pattern steps back over white space to find the last of it before a
        word, which exhausts its stack on a very long run.  Such a run is one
        piece of the pattern, but for its last character if more text follows,
        so it is cut out and encoded as that piece; the tokens are the same.
        """
        parts, at = [], 0
        if self.splits and len(text) > LONG:
            for m in RUNS.finditer(text):
                end = m.end() - (m.end() < len(text))
                if m.end() - m.start() > LONG:
                    parts += [self._encode(text[at: m.start()]), self._run(text[m.start(): end])]
                    at = end
        return np.concatenate([*parts, self._encode(text[at:])])

    def _encode(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype(np.int64)

    def _run(self, blanks: str) -> np.ndarray:
        """White space alone, which is one piece of the pattern whatever its length."""
        return np.asarray(self.encoding._encode_single_piece(blanks), np.int64)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of each token; a character that several tokens share counts for each of them."""
        ids = self.ids(text)
        if not len(ids):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        end = np.cumsum(self.lengths[ids])
        start = end - self.lengths[ids]
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        if len(raw) != len(text):
            char = np.cumsum((raw & 0xC0) != 0x80) - 1
            start, end = char[start], char[end - 1] + 1
        return start, end


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lines with their line end, as character spans that cover the text; an empty text is one empty section."""
    lengths = np.fromiter(map(len, text.split("\n")), np.int64)
    lengths[:-1] += 1
    end = np.cumsum(lengths)
    return end - lengths, end


def allocate(start: np.ndarray, end: np.ndarray, lo: np.ndarray, hi: np.ndarray, rule: str = "most") -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and how many tokens of each section cross one of its bounds.

    Sections are sorted and do not overlap; gaps and empty sections are
    allowed.  A token inside one section counts there; a token in a gap counts
    nowhere; any other follows ``rule``.
    """
    tokens, crossing = np.zeros(len(lo)), np.zeros(len(lo), np.int64)
    first = np.searchsorted(hi, start, side="right")          # first section that ends after the token begins
    last = np.searchsorted(lo, end, side="left") - 1          # last section that begins before the token ends
    inside = (first <= last) & (first < len(lo))
    at = np.minimum(first, len(lo) - 1)
    whole = inside & (first == last) & (lo[at] <= start) & (end <= hi[at])
    tokens += np.bincount(first[whole], minlength=len(lo))
    for t in np.flatnonzero(inside & ~whole):
        held = np.arange(first[t], last[t] + 1)
        share = np.minimum(end[t], hi[held]) - np.maximum(start[t], lo[held])
        held, share = held[share > 0], share[share > 0]
        if not len(held):
            continue
        crossing[held] += 1
        if rule == "split":
            tokens[held] += share / (end[t] - start[t])
        else:
            tokens[held[int(share.argmax()) if rule == "most" else 0]] += 1
    return tokens, crossing


def section_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: str = "most",
                   vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(id, section, char_start, char_end, tokens, crossing): the lines of every text with their tokens.

    Sections are lines with their line end, numbered from 0; their tokens add
    up to those of the document.  A null or empty text has one empty section
    with no tokens.  Very long texts are encoded whole, runs of millions of
    blanks or line feeds too.  Repeated rows give repeated results, a null id stays null;
    other columns are ignored; an empty table gives an empty result.
    """
    return _attribute(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), id_col, None, rule, vocabulary, pattern)


def field_tokens(rows: DataFrame, id_col: str, fields: list[str], separator: str = "\n", rule: str = "most",
                 vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Like ``section_tokens`` for the named columns, joined by ``separator`` and encoded as one document.

    Section i is field i; a null field is empty; the separators belong to none,
    so a token of a separator alone counts nowhere.
    """
    texts = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields])
    return _attribute(rows.select(F.col(id_col).alias("id"), texts.alias("text")), id_col, separator, rule, vocabulary, pattern)


def _attribute(rows: DataFrame, id_col: str, separator: str | None, rule: str, vocabulary: str, pattern: str) -> DataFrame:
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    spark: SparkSession = rows.sparkSession
    small_batches(spark)
    with open(vocabulary, "rb") as f:                # a parameter of the job, read once by the driver
        shared = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(shared.value, pattern)
        for batch in batches:
            parts, size = [], 0
            for key, text in zip(batch["id"], batch["text"]):
                if separator is None:
                    text = text or ""
                    lo, hi = line_sections(text)
                else:
                    fields = list(text)
                    lengths = np.fromiter(map(len, fields), np.int64, len(fields))
                    hi = np.cumsum(lengths + len(separator)) - len(separator)
                    lo, text = hi - lengths, separator.join(fields)
                tokens, crossing = allocate(*encoder.spans(text), lo, hi, rule)
                parts.append((np.full(len(lo), key, object), np.arange(len(lo)), lo, hi, tokens, crossing))
                size += len(lo)
                if size >= 50_000:
                    yield frame(parts)
                    parts, size = [], 0
            if parts:
                yield frame(parts)

    def frame(parts: list[tuple]) -> pd.DataFrame:
        names = ("id", "section", "char_start", "char_end", "tokens", "crossing")
        return pd.DataFrame({n: np.concatenate([p[i] for p in parts]) for i, n in enumerate(names)})

    kind = rows.schema["id"].dataType.simpleString()
    out = (rows.withColumn("id", F.col("id").cast("string"))
           .mapInPandas(run, "id string, section int, char_start long, char_end long, tokens double, crossing long"))
    number = F.col("tokens") if rule == "split" else F.col("tokens").cast("long")
    return out.select(F.col("id").cast(kind).alias(id_col), "section", "char_start", "char_end", number.alias("tokens"), "crossing")
