"""Language: a bidirectional gated recurrent network over bytes.

Two recurrent layers read the bytes of a word, one from each end; a softmax over both states labels
every byte with a language. The probabilities of all bytes of a document are averaged. The state
starts anew at each word, so a word has the same labels wherever it stands: a task runs the network
once for each distinct word, words of equal length together, and weighs the result by the word's
count. Long words are read in runs of at most MOST_BYTES bytes. Training is backpropagation
through time in numpy, on words of a bounded sample of labelled texts, each language equally often.

Defined results: a null text, and a text without any letter, is ``und`` with score 0. Every other
text gets one of the languages learned; without any labelled text, ``und`` with score 0. Words
without letters are not read. Texts of any length are read whole; equal texts get equal results.
Columns other than ``doc_id``, ``text`` and, in training, the language are never read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled texts that a model is fitted on, at most, and different words taken from each.
SAMPLE = 4_000
WORDS_OF_TEXT = 64
HIDDEN = 16
MOST_BYTES = 24
UNKNOWN = "und"
#: Words remembered by a task with their summed probabilities.
REMEMBERED = 300_000
#: Texts whose words a task counts at a time.
TEXTS_AT_ONCE = 1000
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, LETTER.findall(text))) if LETTER.search(text) else False


def runs(word: str) -> list[bytes]:
    raw = word.lower().encode("utf-8", "surrogatepass")
    return [raw[i : i + MOST_BYTES] for i in range(0, len(raw), MOST_BYTES)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def layer(x: np.ndarray, w: np.ndarray, u: np.ndarray, keep: bool = False):
    """States of one direction for words (rows) of equal length; what training needs, if kept."""
    rows, length = x.shape
    size = u.shape[0]
    h = np.zeros((rows, size), np.float32)
    states, kept = np.empty((length, rows, size), np.float32), []
    for t in range(length):
        a, g = w[x[:, t]], h @ u
        gates = sigmoid(a[:, : 2 * size] + g[:, : 2 * size])
        z, r = gates[:, :size], gates[:, size:]
        inner = g[:, 2 * size :]
        n = np.tanh(a[:, 2 * size :] + r * inner)
        if keep:
            kept.append((h, z, r, n, inner))
        h = n + z * (h - n)
        states[t] = h
    return states, kept


def back(x: np.ndarray, u: np.ndarray, kept: list, d_states: np.ndarray, d_w: np.ndarray) -> np.ndarray:
    """Backpropagation through time of one direction: adds to ``d_w``, returns u's gradient."""
    d_u, d_h = np.zeros_like(u), np.zeros_like(d_states[0])
    for t in reversed(range(x.shape[1])):
        h, z, r, n, inner = kept[t]
        d_h = d_h + d_states[t]
        d_n = d_h * (1 - z) * (1 - n * n)
        d_z = d_h * (h - n) * z * (1 - z)
        d_r = d_n * inner * r * (1 - r)
        d_g = np.concatenate((d_z, d_r, d_n * r), axis=1)
        np.add.at(d_w, x[:, t], np.concatenate((d_z, d_r, d_n), axis=1))
        d_u += h.T @ d_g
        d_h = d_h * z + d_g @ u.T
    return d_u


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: dict[str, np.ndarray]

    def sums(self, words: list[str]) -> np.ndarray:
        """For each word: its number of labelled bytes, and the summed probabilities of each
        language. Words without letters have none."""
        out = np.zeros((len(words), 1 + len(self.languages)), np.float32)
        by_length = defaultdict(list)
        for i, word in enumerate(words):
            if self.languages and has_letter(word):
                for run in runs(word):
                    by_length[len(run)].append((i, run))
        for length, group in sorted(by_length.items()):
            for start in range(0, len(group), 8192):
                part = group[start : start + 8192]
                x = np.frombuffer(b"".join(run for _, run in part), np.uint8).reshape(-1, length)
                p = self.probabilities(x).sum(0)
                at = np.array([i for i, _ in part])
                np.add.at(out[:, 1:], at, p)
                np.add.at(out[:, 0], at, np.float32(length))
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(position, word, language) for words of equal length."""
        w = self.weights
        ahead, _ = layer(x, w["wf"], w["uf"])
        behind, _ = layer(x[:, ::-1], w["wb"], w["ub"])
        logits = np.concatenate((ahead, behind[::-1]), axis=2) @ w["o"] + w["c"]
        e = np.exp(logits - logits.max(2, keepdims=True))
        return e / e.sum(2, keepdims=True)


def train(words: list[bytes], labels: np.ndarray, languages: tuple[str, ...], steps: int = 700) -> Model:
    """Adam on the log loss of every byte; batches of words of equal length, languages in turn."""
    rng = np.random.default_rng(11)
    k, size = len(languages), HIDDEN
    shapes = {"wf": (256, 3 * size), "wb": (256, 3 * size), "uf": (size, 3 * size),
              "ub": (size, 3 * size), "o": (2 * size, k), "c": (k,)}
    w = {n: (rng.normal(0, 0.25, s) if n != "c" else np.zeros(s)).astype(np.float32) for n, s in shapes.items()}
    m = {n: np.zeros_like(v) for n, v in w.items()}
    v = {n: np.zeros_like(x) for n, x in w.items()}
    share = 1 / np.maximum(np.bincount(labels, minlength=k), 1)
    by_length = defaultdict(list)
    for i, word in enumerate(words):
        by_length[len(word)].append(i)
    lengths = sorted(by_length)
    groups = [np.array(by_length[n]) for n in lengths]
    chances = [share[labels[g]] / share[labels[g]].sum() for g in groups]
    mass = np.array([n * share[labels[g]].sum() for n, g in zip(lengths, groups)])
    for step in range(1, steps + 1):
        at = rng.choice(len(lengths), p=mass / mass.sum())
        rows = rng.choice(groups[at], 256, p=chances[at])
        x = np.frombuffer(b"".join(words[i] for i in rows), np.uint8).reshape(256, -1)
        ahead, kept_f = layer(x, w["wf"], w["uf"], True)
        behind, kept_b = layer(x[:, ::-1], w["wb"], w["ub"], True)
        h = np.concatenate((ahead, behind[::-1]), axis=2)
        logits = h @ w["o"] + w["c"]
        e = np.exp(logits - logits.max(2, keepdims=True))
        d = e / e.sum(2, keepdims=True)
        d[:, np.arange(256), labels[rows]] -= 1
        d /= d.shape[0] * d.shape[1]
        grad = {n: np.zeros_like(x) for n, x in w.items()}
        grad["o"] = np.tensordot(h, d, axes=((0, 1), (0, 1)))
        grad["c"] = d.sum((0, 1))
        d_h = d @ w["o"].T
        grad["uf"] = back(x, w["uf"], kept_f, d_h[:, :, :size], grad["wf"])
        grad["ub"] = back(x[:, ::-1], w["ub"], kept_b, d_h[::-1, :, size:], grad["wb"])
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for n, g in grad.items():
            m[n] += 0.1 * (g - m[n])
            v[n] += 0.01 * (g * g - v[n])
            scale = np.sqrt(v[n] / (1 - 0.99**step)) + 1e-8
            w[n] -= (rate * m[n] / (1 - 0.9**step) / scale).astype(np.float32)
    return Model(languages, w)


def fit(docs: DataFrame, language: str = "lang", sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` texts with a language, those of least hash of their id."""
    rows = (
        docs.select("doc_id", "text", F.col(language).alias("label"))
        .where("text is not null and label is not null")
    )
    ids = rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    ids = ids.select(F.col("doc_id").alias("_id")).distinct()

    def some_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, label in zip(batch["text"], batch["label"]):
                words = {w for w in text.lower().split() if has_letter(w)}
                chosen = sorted(words, key=lambda w: (zlib.crc32(w.encode("utf-8", "surrogatepass")), w))
                out += [(w, label) for w in chosen[:WORDS_OF_TEXT]]
            yield pd.DataFrame(out, columns=["word", "label"])

    taken = rows.join(F.broadcast(ids), rows["doc_id"].eqNullSafe(ids["_id"])).select("text", "label")
    got = sorted((r.word, r.label) for r in taken.mapInPandas(some_words, "word string, label string").collect())
    languages = tuple(sorted({label for _, label in got}))
    pairs = [(run, languages.index(label)) for word, label in got for run in runs(word)]
    if not pairs:
        return Model((), {})
    return train([p for p, _ in pairs], np.array([i for _, i in pairs]), languages)


def predict(model: Model, text: str | Column = "text") -> Column:
    """A struct of ``lang_pred`` and ``score`` for each text."""

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        table = np.zeros((0, 1 + len(model.languages)), np.float32)
        for batch in parts(batches):
            counts = [Counter(text.split()) if text else Counter() for text in batch]
            if len(known) > REMEMBERED:
                known, table = {}, table[:0]
            new = list(dict.fromkeys(w for c in counts for w in c if w not in known))
            known.update(zip(new, range(len(table), len(table) + len(new))))
            if new:
                lowered = {w: i for i, w in enumerate(dict.fromkeys(map(str.lower, new)))}
                sums = model.sums(list(lowered))
                table = np.concatenate((table, sums[[lowered[w.lower()] for w in new]]))
            out = []
            for c in counts:
                rows = table[np.fromiter(map(known.__getitem__, c), np.int64, len(c))]
                total = np.fromiter(c.values(), np.float64, len(c)) @ rows if c else np.zeros(1)
                if total[0] and model.languages:
                    best = int(total[1:].argmax())
                    out.append((model.languages[best], round(min(total[1 + best] / total[0], 1.0), 6)))
                else:
                    out.append((UNKNOWN, 0.0))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    def parts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                yield batch[start : start + TEXTS_AT_ONCE]

    return predicted(F.col(text) if isinstance(text, str) else text)
