"""Quality rules on repetition: characters inside repeated n-grams and repeated lines.

A text's words become numbers, rolling hashes of several n-gram lengths are made over them
in numpy, and the characters of the words inside repeated n-grams are measured. Every
document is judged alone, where it was read: nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: published limits on the share of characters in repeated parts ----------
N_GRAM_LIMITS = ((5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.10))
LINE_LIMIT = 0.20
# -------------------------------------------------------------------------------------------

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

_words = re.compile("[^\x20\x09-\x0d]+").findall
_symbols = re.compile(r"[#*$%&|<>]").findall


@dataclass(frozen=True)
class Rules:
    """`slack` widens every share limit; short texts repeat a few words by chance."""

    least_words: int = 50
    most_repeated_percent: int = 50
    n_gram_limits: tuple[tuple[int, float], ...] = N_GRAM_LIMITS
    line_limit: float = LINE_LIMIT
    symbol_limit: float = 0.10  # symbols a word


def rolling(numbers: np.ndarray, n: int, shorter: np.ndarray | None, was: int) -> np.ndarray:
    """Hashes of all n-grams, continued from the hashes of the (shorter) was-grams."""
    if len(numbers) < n:
        return np.zeros(0, np.uint64)
    h = numbers if shorter is None else shorter
    with np.errstate(over="ignore"):
        for k in range(was + 1, n + 1):
            h = h[: len(numbers) - k + 1] * MULTIPLIER + numbers[k - 1 :]
            h = h ^ (h >> np.uint64(29))
    return h


def covered(codes: np.ndarray, n: int, words: int, first_too: bool) -> np.ndarray:
    """Which words lie inside an n-gram that occurs twice or more (or occurred before)."""
    inside = np.zeros(words + 1, np.int32)
    if len(codes):
        _, first, back, counts = np.unique(codes, return_index=True, return_inverse=True, return_counts=True)
        again = counts[back] > 1
        if not first_too:
            again[first] = False
        starts = np.flatnonzero(again)
        np.add.at(inside, starts, 1)
        np.add.at(inside, starts + n, -1)
    return np.cumsum(inside)[:words] > 0


def measure(text: str | None, rules: Rules) -> dict:
    """The counts and shares of one text; a null text has no words."""
    text = text or ""
    words = _words(text)
    n = len(words)
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    chars = np.fromiter(map(len, words), np.int64, n)
    total = int(chars.sum())
    # windows of three words, told apart exactly: pairs are numbered first
    if n >= 3:
        _, pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)
        threes = pairs[:-1] * len(known) + ids[2:]
    else:
        threes = np.zeros(0, np.int64)
    repeated = int(covered(threes, 3, n, True).sum())
    seen: set[str] = set()
    n_lines = line_chars = all_line_chars = 0
    for line in text.split("\n"):
        if _words(line):
            all_line_chars += len(line)
            if line in seen:
                n_lines += 1
                line_chars += len(line)
            seen.add(line)
    numbers = ids.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)
    h, was, shares = None, 1, []
    for size, _ in rules.n_gram_limits:
        h = rolling(numbers, size, h, was)
        was = size
        inside = covered(h, size, n, False)
        shares.append(float(chars[inside].sum()) / total if total else 0.0)
    symbols = len(_symbols(text))
    base_failed = n < rules.least_words or 100 * repeated > rules.most_repeated_percent * n
    line_share = line_chars / all_line_chars if all_line_chars else 0.0
    kept = (
        not base_failed
        and line_share <= rules.line_limit
        and symbols <= rules.symbol_limit * n
        and all(s <= most for s, (_, most) in zip(shares, rules.n_gram_limits))
    )
    return {
        "n_words": n,
        "word_chars": total,
        "n_symbols": symbols,
        "n_dup_lines": n_lines,
        "n_repeat_words": repeated,
        "base_failed": base_failed,
        "dup_line_share": line_share,
        "dup_gram_share": max(shares, default=0.0),
        "kept": kept,
    }


_KINDS = (
    ("n_words", "bigint"),
    ("word_chars", "bigint"),
    ("n_symbols", "bigint"),
    ("n_dup_lines", "bigint"),
    ("n_repeat_words", "bigint"),
    ("base_failed", "boolean"),
    ("dup_line_share", "double"),
    ("dup_gram_share", "double"),
    ("kept", "boolean"),
)


def judged(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id with every measure and the verdict, one row per input row.

    An empty or null text fails (no words). Only doc_id and text are read.
    """
    names = [c for c, _ in _KINDS]
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t.as_py(), rules) for t in batch.column(1)]
            columns = [pa.array([r[c] for r in rows], kinds[k]) for c, k in _KINDS]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names])

    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return narrow.mapInArrow(run, ", ".join(["doc_id bigint", *(f"{c} {k}" for c, k in _KINDS)]))


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of `docs` whose text passes, all columns as they were. One pass, no shuffle."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [measure(t.as_py(), rules)["kept"] for t in batch.column(at)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
