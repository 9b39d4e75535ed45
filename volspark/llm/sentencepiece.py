"""SentencePiece encoding and decoding: batched Viterbi in numpy.

A text is normalised as its model says (a space is written ▁, one is put in front) and cut in front
of every run of ▁: no piece crosses such a place. Of each unit the segmentation of largest total
piece score is wanted. Units of equal length advance together: at each end position, the hashes of
all substrings that end there are looked up among the sorted hashes of the pieces, and the maximum
over their starts is stored with a backpointer, the longest piece first among equals. Characters
that no piece covers cost the least score less 10 and become bytes where the vocabulary has them.
A task remembers the ids of the units it has met, a bounded number.

The best-scoring segmentation is that of a unigram model. For a vocabulary whose scores are merge
ranks, the greedy merging of its own library may cut some words otherwise; both give back the text.

Defined results: a null or empty text has no ids. A ▁ in a text is read as a space, so it comes
back as one. Texts of any length are encoded whole; equal texts get equal ids. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Units remembered by a task with their ids, and cells of one batch of equal-length units.
REMEMBERED = 200_000
#: Texts that a task encodes or decodes at a time.
TEXTS_AT_ONCE = 250
BATCH_CELLS = 1 << 20
UNKNOWN_PENALTY = 10.0
FACTOR = np.uint64(0x9E3779B97F4A7C15)
FIRST_BITS = 20
#: No piece: the unit has fewer than others.
NOTHING = -2
SHIFT = np.uint64(64 - FIRST_BITS)


class Codec:
    """Encodes and decodes with the pieces of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        skip = [
            model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)
            for i in range(len(self.pieces))
        ]
        self.unknown = model.unk_id()
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(len(skip)) if model.is_byte(i)}
        plain = [i for i, s in enumerate(skip) if not s]
        self.longest = max(len(self.pieces[i]) for i in plain)
        keys = np.array([self.key(self.pieces[i]) for i in plain], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(plain, np.int64)[order]
        scores = np.array([model.get_score(i) for i in plain])
        self.scores, self.least = scores[order], scores.min() - UNKNOWN_PENALTY
        self.lengths = np.array([len(p) for p in self.pieces])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer("".join(self.pieces).encode("utf-32-le"), "<u4")
        self.first_bits = np.zeros(1 << FIRST_BITS, bool)
        self.first_bits[self.keys >> SHIFT] = True
        self.widths = np.arange(self.longest + 1, dtype=np.uint64)
        self.powers = FACTOR ** self.widths
        self.by_text = {self.pieces[i]: i for i in plain}
        self.units: dict[str, bytes] = {}
        written = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for i, s in enumerate(skip):
            written[i] = b"" if s else written[i]
        for byte, i in self.bytes.items():
            written[i] = bytes([byte])
        self.written = written

    @staticmethod
    def key(text: str) -> np.uint64:
        h = 0
        for c in text:
            h = (h * int(FACTOR) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return np.uint64(h ^ len(text))

    def _batch(self, units: list[str]) -> list[bytes]:
        """Ids of units of equal length."""
        n, length = len(units), len(units[0])
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4").reshape(n, length)
        best = np.full((n, length + 1), -np.inf)
        best[:, 0] = 0
        from_, piece = np.zeros((n, length + 1), np.int32), np.full((n, length + 1), -1, np.int32)
        hashes = np.zeros((n, length + 1), np.uint64)
        for j in range(length):
            hashes[:, j + 1] = hashes[:, j] * FACTOR + codes[:, j].astype(np.uint64) + np.uint64(1)
        rows = np.arange(n)
        for j in range(1, length + 1):
            first = max(0, j - self.longest)
            power, width = self.powers[j - first :: -1][: j - first], self.widths[j - first :: -1][: j - first]
            probe = (hashes[:, j, None] - hashes[:, first:j] * power) ^ width
            # most substrings are no pieces, which a table of the keys' first bits tells
            r, c = np.nonzero(self.first_bits[probe >> SHIFT])
            probe = probe[r, c]
            at = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
            known = self.keys[at] == probe
            r, c, at = r[known], c[known], at[known]
            total = np.full((n, j - first), -np.inf)
            total[r, c] = best[r, first + c] + self.scores[at]
            found = np.full((n, j - first), -1, np.int32)
            found[r, c] = self.ids[at]
            total[:, -1] = np.where(found[:, -1] >= 0, total[:, -1], best[:, j - 1] + self.least)
            pick = total.argmax(1)
            best[:, j], from_[:, j], piece[:, j] = total[rows, pick], first + pick, found[rows, pick]
        steps, widths, j = [], [], np.full(n, length)
        while j.any():
            steps.append(np.where(j > 0, piece[rows, j], NOTHING))
            widths.append(j - from_[rows, j])
            j = from_[rows, j]
        ids, width = np.stack(steps[::-1], axis=1), np.stack(widths[::-1], axis=1)
        used = ids != NOTHING
        whole = (ids >= 0).sum(1) == used.sum(1)
        named = ids[whole][used[whole]]
        letters = self.lengths[named]
        if (letters != width[whole][used[whole]]).any() or (
            self.letters[np.arange(letters.sum()) + np.repeat(self.starts[named] - np.cumsum(letters) + letters, letters)]
            != codes[whole].ravel()
        ).any():  # two strings of one hash
            return [self.plain(u) for u in units]
        raw, ends = ids[used].astype("<u4").tobytes(), 4 * np.cumsum(used.sum(1))
        out = [raw[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]
        for i in np.flatnonzero(~whole).tolist():  # some characters are in no piece
            place, listed = 0, []
            for p, w in zip(ids[i][used[i]].tolist(), width[i][used[i]].tolist()):
                text = units[i][place : place + w]
                if p >= 0 and self.pieces[p] != text:
                    return [self.plain(u) for u in units]
                listed += [p] if p >= 0 else self.spelled(text)
                place += w
            out[i] = array("I", listed).tobytes()
        return out

    def spelled(self, character: str) -> list[int]:
        raw = character.encode("utf-8", "surrogatepass")
        return [self.bytes[b] for b in raw] if len(self.bytes) == 256 else [self.unknown]

    def plain(self, unit: str) -> bytes:
        """The same for one unit, piece by piece; for units in which hashes do not tell pieces apart."""
        scores = dict(zip(self.ids.tolist(), self.scores.tolist()))
        best: list[tuple[float, int, int]] = [(0.0, 0, -1)]
        for j in range(1, len(unit) + 1):
            found = (-np.inf, 0, -1)
            for i in range(max(0, j - self.longest), j):
                p = self.by_text.get(unit[i:j], -1)
                cost = scores[p] if p >= 0 else self.least if i == j - 1 else -np.inf
                if best[i][0] + cost > found[0]:
                    found = (best[i][0] + cost, i, p)
            best.append(found)
        ids, j = [], len(unit)
        while j:
            _, i, p = best[j]
            ids += [p] if p >= 0 else self.spelled(unit[i:j])[::-1]
            j = i
        return array("I", ids[::-1]).tobytes()

    def learn(self, units: set[str]) -> None:
        by_length = defaultdict(list)
        for unit in sorted(units):
            by_length[len(unit)].append(unit)
        for length, group in by_length.items():
            step = max(1, BATCH_CELLS // (length * 16))
            for start in range(0, len(group), step):
                part = group[start : start + step]
                self.units.update(zip(part, self._batch(part)))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        cut = [UNIT.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.units) > REMEMBERED:
            self.units = {}
        self.learn({u for units in cut for u in units if u not in self.units})
        return [b"".join(map(self.units.__getitem__, units)) for units in cut]

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.written.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace").removeprefix(" ")


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and ``ids`` (unsigned 32-bit, little-endian) of every whole text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(model)
        for batch in batches:
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch[start : start + TEXTS_AT_ONCE]
                keys = part["doc_id"].astype("Int64")
                yield pd.DataFrame({"doc_id": keys.array, "ids": codec.encode(list(part["text"]))})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, ids and the ``text`` that the ids stand for."""

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(model)
        for batch in batches:
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch[start : start + TEXTS_AT_ONCE]
                yield pd.Series([None if raw is None else codec.decode(raw) for raw in part])

    return encoded.select("doc_id", "ids", decoded("ids").alias("text"))
