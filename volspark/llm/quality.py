"""Quality: a factorisation machine over hashed words, structure statistics and metadata.

    s(x) = b + Σ w_i x_i + ½ Σ_f [(Σ v_if x_i)² - Σ v_if² x_i²]

The identity of squares gives all pairwise interactions in time linear in the features. Words are
hashed into buckets; structure statistics (repetition, case, punctuation, digits, lines, word
lengths) and metadata (the length of the text) are dense features at fixed places, as values
and, where their extremes matter, as steps of them.

Defined results: a null text counts as empty; an empty text has the statistics zero and is scored
by the bias and those. Texts of any length are read whole. Equal texts get equal scores. Without
labelled rows of both classes, the score is the smoothed share of good rows everywhere. Columns
other than ``doc_id`` and ``text`` are never read, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .corpus import labelled_sample, lean
from .toxicity import logistic

#: Labelled rows that a model is fitted on, at most.
SAMPLE = 8_000
BUCKETS = 1 << 14
FACTORS = 6
THRESHOLD = 0.5
#: Words remembered by a task with their buckets.
REMEMBERED = 300_000

STATISTICS = (
    "log_chars", "log_words", "distinct_share", "top_share", "top3_share", "word_length",
    "long_words", "upper_share", "digit_share", "symbol_share", "stop_share", "bang_share",
    "pipe_share", "line_length", "line_repeats", "short_lines", "no_letter_words",
    "distinct_lines_share", "symbol_end_share", "upper_words",
)
#: Steps per statistic: a value also sets the bucket of its step.
STEPS = 12
DENSE = len(STATISTICS) * (1 + STEPS)
WIDTH = DENSE + BUCKETS
LETTERS_AND_SPACE = " \n"


def statistics(text: str, counts: Counter) -> np.ndarray:
    """Values of STATISTICS, each 0 to 1; the two logarithms are scaled by 16."""
    n, total, distinct = len(text), sum(counts.values()), len(counts)
    if not total:
        return np.zeros(len(STATISTICS))
    top = sorted(counts.values(), reverse=True)[:3]
    length = sum(map(len, counts))
    alphabetic = sum(map(str.isalpha, counts))
    ends = sum(not word[-1].isalnum() for word in counts)
    letterless = sum(word.lower() == word.upper() for word in counts)
    upper = sum(map(str.isupper, counts))
    lines = text.split("\n")
    different = len(set(lines))
    raw = text.encode("utf-8", "surrogatepass")
    kinds = np.bincount(KIND[np.frombuffer(raw, dtype=np.uint8)], minlength=8) / len(raw)
    mean_line = n / len(lines)
    return np.array(
        (
            math.log1p(n) / 16, math.log1p(total) / 16, distinct / total, top[0] / total,
            sum(top) / total, min(length / distinct / 20, 1.0), min(length / distinct / 100, 1.0),
            kinds[1], kinds[2], kinds[3], kinds[4], kinds[5], kinds[6], min(mean_line / 1000, 1.0),
            1 - different / len(lines), 1 / mean_line if mean_line > 1 else 1.0,
            letterless / distinct, different / total, ends / distinct, upper / distinct
            if alphabetic or upper else 0.0,
        )
    )


def _kinds() -> np.ndarray:
    """Of each byte: 1 upper case, 2 digit, 3 other symbol, 4 full stop or comma, 5 !, 6 |, 0 rest."""
    kind = np.zeros(256, dtype=np.int64)
    for code in range(33, 127):
        c = chr(code)
        kind[code] = 1 if c.isupper() else 2 if c.isdigit() else 0 if c.isalpha() else 3
    kind[[ord("."), ord(",")]] = 4
    kind[ord("!")], kind[ord("|")] = 5, 6
    return kind


KIND = _kinds()


def bucket(word: str) -> int:
    return DENSE + zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % BUCKETS


def encode(text: str | None, known: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's features. ``known`` remembers buckets of words."""
    text = text or ""
    counts = Counter(text.split())
    for word in counts:
        if word not in known:
            known[word] = bucket(word)
    values = statistics(text, counts)
    steps = np.minimum((np.sqrt(values) * STEPS).astype(np.int64), STEPS - 1)
    places = np.arange(len(STATISTICS))
    stepped = len(STATISTICS) + places * STEPS + steps
    words = np.unique(np.fromiter(map(known.__getitem__, counts), np.int64, len(counts)))
    if len(known) > REMEMBERED:
        known.clear()
    weight = 1 / math.sqrt(len(words)) if len(words) else 0.0
    return (
        np.concatenate((places, stepped, words)),
        np.concatenate((values, np.full(len(places), 0.5), np.full(len(words), weight))),
    )


@dataclass(frozen=True)
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, places: np.ndarray, values: np.ndarray) -> float:
        """The linear-time form: one pass over the features."""
        weighted = self.factors[places] * values[:, None]
        crossed = (weighted.sum(0) ** 2 - (weighted**2).sum(0)).sum() / 2
        return float(self.bias + self.linear[places] @ values + crossed)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` labelled rows; tasks encode them, the driver trains."""

    @lean
    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for batch in batches:
            rows = [encode(text, known) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "label": batch["label"],
                    "places": [p.astype("<u4").tobytes() for p, _ in rows],
                    "vals": [v.astype("<f4").tobytes() for _, v in rows],
                }
            )

    schema = "doc_id long, label double, places binary, vals binary"
    got = labelled_sample(docs, labels, label, sample).mapInPandas(encoded, schema).collect()
    got.sort(key=lambda r: (r.doc_id, r.label, r.places))
    y = np.array([float(r.label > 0.5) for r in got])
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    prior = float(np.log(share / (1 - share)))
    if not 0 < y.sum() < len(y):
        return Model(prior, np.zeros(WIDTH, np.float32), np.zeros((WIDTH, FACTORS), np.float32))
    places = [np.frombuffer(r.places, "<u4") for r in got]
    values = [np.frombuffer(r.vals, "<f4") for r in got]
    return train(places, values, y, prior)


def train(places: list, values: list, y: np.ndarray, bias: float, epochs: int = 8) -> Model:
    """AdaGrad on mini-batches of 64 rows, log loss with a slight pull to zero."""
    rng = np.random.default_rng(7)
    linear = np.zeros(WIDTH, dtype=np.float32)
    factors = rng.normal(0, 0.05, (WIDTH, FACTORS)).astype(np.float32)
    sum_w, sum_v = np.full(WIDTH, 1e-6, np.float32), np.full((WIDTH, FACTORS), 1e-6, np.float32)
    rate = 0.1
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for start in range(0, len(y), 64):
            rows = order[start : start + 64]
            ids = np.concatenate([places[i] for i in rows]).astype(np.int64)
            x = np.concatenate([values[i] for i in rows])
            sizes = np.array([len(places[i]) for i in rows])
            at = np.repeat(np.arange(len(rows)), sizes)
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            weighted = factors[ids] * x[:, None]
            total = np.add.reduceat(weighted, starts)
            crossed = (total**2 - np.add.reduceat(weighted**2, starts)).sum(1) / 2
            raw = bias + np.bincount(at, linear[ids] * x, len(rows)) + crossed
            error = ((logistic(raw) - y[rows]) / len(rows)).astype(np.float32)
            bias -= 0.1 * float(error.sum())
            own, back = np.unique(ids, return_inverse=True)
            scaled = (error[at] * x)[:, None]
            step = scaled * (total[at] - weighted)
            grad_v = np.stack(
                [np.bincount(back, step[:, f], len(own)) for f in range(FACTORS)], axis=1
            ) + 1e-5 * factors[own]
            grad_w = np.bincount(back, scaled[:, 0], len(own)) + 1e-5 * linear[own]
            sum_w[own] += grad_w**2
            sum_v[own] += grad_v**2
            linear[own] -= rate * grad_w / np.sqrt(sum_w[own])
            factors[own] -= 0.3 * rate * grad_v / np.sqrt(sum_v[own])
    return Model(float(bias), linear, factors)


def score(model: Model, text: str | Column = "text") -> Column:
    """The score of each text as a column, 0 to 1."""

    @F.pandas_udf("double")
    @lean
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, int] = {}
        for batch in batches:
            yield pd.Series(
                logistic(np.array([model.raw(*encode(text, known)) for text in batch], dtype=float))
            )

    return scored(F.col(text) if isinstance(text, str) else text)
