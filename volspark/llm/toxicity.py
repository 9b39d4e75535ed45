"""Toxicity: a classifier with counterfactual regularisation.

A logistic model over the distinct words of a text and their prefixes. Besides the labelled texts
it is trained on pairs of sentences that differ in an identity term only: the squared difference
of the two scores is part of the loss. A group's name may be frequent in toxic texts; the penalty
keeps it from carrying weight, so neutral mentions stay neutral.

Defined results: a null text counts as empty; an empty text, or one without any known word, has
the score of the intercept alone. Texts of any length are read whole. Equal texts get equal
scores. Without labelled rows of both classes, the score is the smoothed share of toxic rows
everywhere. Columns other than ``doc_id`` and ``text`` are never read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoint import checkpointed
from .corpus import labelled_sample, lean

#: Labelled rows that a model is fitted on, at most.
SAMPLE = 10_000
#: Features kept, at most; those of largest test statistic stay.
FEATURES = 20_000
#: Two-sample statistic that a feature must reach to be kept.
LEAST_Z = 4.0
#: Rows of sentences used as counterfactual pairs, at most.
PAIRS = 5_000
THRESHOLD = 0.7
#: Words remembered by a task with their weights.
REMEMBERED = 300_000

# Identity terms by kind; a counterfactual exchanges a term for another one of its kind.
IDENTITY = {
    "gender": ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    "person": ("woman", "man", "girl", "boy"),
    "faith": ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    "faithful": ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    "origin": ("african", "asian", "european", "american", "mexican", "arab", "indian", "chinese"),
    "colour": ("black", "white", "brown", "latino", "indigenous"),
    "love": ("gay", "straight", "lesbian", "bisexual", "queer", "heterosexual"),
    "body": ("disabled", "deaf", "blind", "autistic"),
    "age": ("old", "young", "elderly"),
    "status": ("immigrant", "refugee", "native", "foreign"),
}
SWAPS = {
    term: group[(i + 1) % len(group)] for group in IDENTITY.values() for i, term in enumerate(group)
}
EDGES = "\"'`.,;:!?()[]{}<>*_-#%&$|/\\+=~^@…«»“”‘’„–—¿¡"
SENTENCE = re.compile(r"(?<=[.!?\n])\s+|\n")


def features(token: str) -> tuple[str, ...]:
    """A token's features: the word, and its first four and five letters where it is longer."""
    word = token.strip(EDGES)
    if not word:
        return ()
    return (word, *(f"{word[:k]}*" for k in (4, 5) if len(word) > k))


def tokens(text: str | None) -> set[str]:
    return set(text.lower().split()) if text else set()


def present(text: str | None) -> list[str]:
    """The features of the distinct tokens, once for each token that has them."""
    return [f for token in tokens(text) for f in features(token)]


def counterfactual(sentence: str) -> str | None:
    """The sentence with every identity term exchanged; None if it has none."""
    words = sentence.lower().split()
    swapped = [
        word.replace(core, SWAPS[core], 1) if (core := word.strip(EDGES)) in SWAPS else word
        for word in words
    ]
    return " ".join(swapped) if swapped != words else None


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[str, float]

    def token_weight(self, token: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(token))

    def score(self, text: str | None) -> float:
        return float(logistic(self.bias + sum(map(self.token_weight, sorted(tokens(text))))))


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


@lean
def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each feature that the task has seen: rows with it, toxic rows with it."""
    rows, toxic = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"]):
            seen = set(present(text))
            rows.update(seen)
            if label > 0.5:
                toxic.update(seen)
    names = list(rows)
    for start in range(0, len(names), 50_000):
        part = names[start : start + 50_000]
        yield pd.DataFrame(
            {"feature": part, "n": [rows[f] for f in part], "pos": [toxic[f] for f in part]}
        )


def select_features(sample: DataFrame) -> tuple[list[str], int, int]:
    """Features whose share among toxic rows differs from that among others; both row counts."""
    total, positive = sample.agg(F.count("label"), F.sum((F.col("label") > 0.5).cast("int"))).first()
    positive = positive or 0
    if not 0 < positive < total:
        return [], total, positive
    n, pos = F.col("n"), F.col("pos")
    share, rest = positive / total, total - positive
    difference = (pos + 0.0) / positive - (n - pos) / rest
    spread = F.sqrt((n + 0.0) / total * (1 - (n + 0.0) / (total + 1)) * (1 / positive + 1 / rest))
    chosen = (
        sample.mapInPandas(_counted, "feature string, n long, pos long")
        .groupBy("feature")
        .agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
        .where(n >= 3)
        .withColumn("z", F.abs(difference / spread))
        .where(F.col("z") >= LEAST_Z)
        .where((pos > share * n * 2) | (pos < share * n / 2))
        .orderBy(F.desc("z"), "feature")
        .limit(FEATURES)
    )
    return sorted(row.feature for row in chosen.collect()), total, positive


def _chosen_only(index: dict[str, int]):
    """Feature numbers of each row, and of its sentence pairs: an identity term of the sentence, its
    numbers and those of the swapped one."""

    def ids(text: str) -> list[int]:
        return sorted(index[f] for f in present(text) if f in index)

    @lean
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, label in zip(batch["text"], batch["label"]):
                pairs = []
                if not SWAPS.keys().isdisjoint(t.strip(EDGES) for t in tokens(text)):
                    for sentence in SENTENCE.split(text):
                        other = counterfactual(sentence)
                        if other is not None and (a := ids(sentence)) != (b := ids(other)):
                            term = min(SWAPS.keys() & {t.strip(EDGES) for t in tokens(sentence)})
                            pairs.append({"term": term, "a": a, "b": b})
                out.append((label, ids(text), pairs))
            yield pd.DataFrame(out, columns=["label", "ids", "pairs"])

    return run


def chosen_pairs(encoded: DataFrame, most: int = PAIRS) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
    """At most ``most`` different pairs, by hash, as many of each identity term as there are."""
    pairs = encoded.select(F.explode("pairs").alias("p")).select("p.*").groupBy("a", "b").agg(F.min("term").alias("term"))
    turn = F.xxhash64("a", "b")
    by_term = Window.partitionBy("term").orderBy(turn, "a", "b")
    ranked = pairs.withColumn("n", F.row_number().over(by_term)).where(F.col("n") <= most)
    got = ranked.orderBy("n", turn, "a", "b").limit(most).select("a", "b").collect()
    return sorted((tuple(r.a), tuple(r.b)) for r in got)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    sample: int = SAMPLE,
    penalty: float = 10.0,
    shrink: float = 1e-6,
) -> Model:
    """A model from at most ``sample`` labelled rows; ``penalty`` weighs the counterfactual term.

    Which features to keep is counted by Spark over the sample; the driver gets their numbers for
    each sampled row only, and at most ``PAIRS`` sentence pairs, chosen by Spark.
    """
    rows = labelled_sample(docs, labels, label, sample)
    names, total, positive = select_features(rows)
    index = {name: i for i, name in enumerate(names)}
    if not index:
        share = (positive + 0.5) / (total + 1.0)
        return Model(float(np.log(share / (1.0 - share))), {})
    schema = "label double, ids array<int>, pairs array<struct<term: string, a: array<int>, b: array<int>>>"
    encoded = checkpointed(rows.mapInPandas(_chosen_only(index), schema))
    got = encoded.select("label", "ids").collect()
    pairs = chosen_pairs(encoded)
    bias, weights = train(
        [row.ids for row in got], np.array([row.label for row in got]), pairs, len(names),
        penalty, shrink,
    )
    return Model(bias, {name: float(w) for name, w in zip(names, weights) if w})


def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    flat = np.fromiter((i for x in lists for i in x), dtype=np.int64, count=int(sizes.sum()))
    return np.repeat(np.arange(len(lists)), sizes), flat


def train(
    rows: list, y: np.ndarray, pairs: list, width: int, penalty: float, shrink: float, steps: int = 1500
) -> tuple[float, np.ndarray]:
    """Full-batch Adam on mean log loss + shrink |w|² + penalty · mean (s(x) - s(x'))²."""
    order = sorted(range(len(rows)), key=lambda i: (tuple(rows[i]), y[i]))  # no matter how rows came
    rows, y = [rows[i] for i in order], y[order]
    at, ids = _flat(rows)
    left, right = _flat([a for a, _ in pairs]), _flat([b for _, b in pairs])
    n, w = len(y), np.zeros(width + 1)
    share = (y.sum() + 0.5) / (n + 1.0)
    w[-1] = np.log(share / (1 - share))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        p = logistic(np.bincount(at, w[ids], n) + w[-1])
        error = (p - y) / n
        grad = np.append(np.bincount(ids, error[at], width) + 2 * shrink * w[:-1], error.sum())
        if pairs:
            k = len(pairs)
            p1 = logistic(np.bincount(left[0], w[left[1]], k) + w[-1])
            p2 = logistic(np.bincount(right[0], w[right[1]], k) + w[-1])
            gap = 2 * penalty * (p1 - p2) / k
            d1, d2 = gap * p1 * (1 - p1), gap * p2 * (1 - p2)
            grad[:-1] += np.bincount(left[1], d1[left[0]], width)
            grad[:-1] -= np.bincount(right[1], d2[right[0]], width)
            grad[-1] += (d1 - d2).sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return float(w[-1]), w[:-1]


def score(model: Model, text: str | Column = "text") -> Column:
    """The score of each text as a column, 0 to 1."""

    @F.pandas_udf("double")
    @lean
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, float] = {}
        for batch in batches:
            out = np.empty(len(batch))
            for i, value in enumerate(batch):
                words = tokens(value)
                for word in words:
                    if word not in known:
                        known[word] = model.token_weight(word)
                out[i] = sum(sorted(w for w in map(known.__getitem__, words) if w))
                if len(known) > REMEMBERED:
                    known.clear()
            yield pd.Series(logistic(out + model.bias))

    return scored(F.col(text) if isinstance(text, str) else text)
