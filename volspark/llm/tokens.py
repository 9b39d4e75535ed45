"""Token ids of whole texts by the ``tokenizers`` library, each distinct word merged once.

The library cuts a text into pieces (words with the space in front, runs of punctuation, ...) by a
pattern and merges the bytes of each piece by itself. A task cuts texts into units where a piece
ends in any case: in front of single spaces, around single line feeds, and in front of stops that
follow a letter or digit. Units repeat; the ids of a bounded number of them are remembered, and
only a new one is looked at: a word goes to the library's merge model, others are cut by the same
pattern first. That holds for letters, digits and punctuation whose Unicode classes have always
been the same; what else a text holds goes through the whole library. Special tokens in a text get
their ids, as the library gives them. A vocabulary of unknown build gets every text whole.

Most time goes into new units, so a worker can keep its encoder from task to task (``kept``). Of many
texts the units are cut as Arrow arrays, by the kinds of bytes that meet, and each is looked up once
for all.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Units that an encoder remembers with their ids; a long one counts once more per LONG bytes.
REMEMBERED, LONG = 400_000, 64
#: The same for an encoder that a worker keeps.
KEPT = 800_000
SAFE_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: Latin letters, digits and punctuation (no combining marks, no space but these, no dotted I).
PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-įı-ɏ‐-‧‰-⁞₠-₿]*")
#: White space that does not stand alone between words, or is not a space or line feed.
RUNS, RARE = ("  ", "\n\n", " \n", "\n "), re.compile(r"[^\S \n]")
STOPS = ".,;:!?"
#: A stop that may belong to a longer piece. It starts with the stop, for which ``re`` skips quickly.
JOINED_STOP = re.compile(rf"[{STOPS}](?<![^\W_].)")
#: Kinds of bytes.
OTHER, SPACE, SYMBOL, QUOTE, DIGIT, SMALL, CAPITAL, BEYOND = range(8)
KIND = np.full(256, OTHER, np.uint8)
KIND[33:127], KIND[128:] = SYMBOL, BEYOND
KIND[[*b" \n"]], KIND[[*b"'"]], KIND[48:58], KIND[65:91], KIND[97:123] = SPACE, QUOTE, DIGIT, CAPITAL, SMALL
#: Between which kinds (first * 8 + second) a piece starts in any case: of a lower-cased text, where all
#: white space parts and digits stand alone, and of one whose pieces take the space in front.
LOWERED_STARTS, SPACED_STARTS = np.zeros((2, 8, 8), bool)
for table in (LOWERED_STARTS, SPACED_STARTS):
    table[np.ix_([DIGIT, SMALL, CAPITAL], [SYMBOL, QUOTE])] = True
    table[np.ix_([DIGIT, SYMBOL], [SMALL, CAPITAL])] = True  # a quote may belong to what follows: 's
LOWERED_STARTS[:, [SPACE, DIGIT]] = True
SPACED_STARTS[np.ix_([SYMBOL, QUOTE, SMALL, CAPITAL], [SPACE, DIGIT])] = SPACED_STARTS[DIGIT, SPACE] = True
#: White space beyond ASCII, by its last two and last three bytes.
WHITE_2 = [int.from_bytes(c.encode(), "big") for c in "\x85\xa0"]
WHITE_3 = [
    int.from_bytes(chr(c).encode(), "big")
    for c in (0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
]

# How the two kinds of vocabulary cut a text into pieces.
BYTE_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself where it is visible."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in visible)
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Units(dict):
    """Ids of units; those of a new one are worked out when it is asked for.

    Once half of ``most`` is filled it becomes the older half, in place of the one before, and what
    is asked for again moves out of it: units that come often are not worked out anew.
    """

    def __init__(self, work_out, most: int):
        self.work_out, self.half, self.older = work_out, most // 2, {}
        self.room = self.half

    def __missing__(self, unit: str) -> bytes:
        ids = self.older.get(unit)
        if ids is None:
            ids = self.work_out(unit)
        if self.room <= 0:
            self.older, self.room = dict(self), self.half
            self.clear()
        self.room -= 1 + (len(unit) + len(ids)) // LONG
        self[unit] = ids
        return ids


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes; ``remembered`` bounds the units kept."""

    def __init__(self, path: str, remembered: int | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            build = json.load(file)
        cutter, normal = build.get("pre_tokenizer") or {}, build.get("normalizer") or {}
        steps = [x["type"] for x in normal.get("normalizers", [])]
        patterns = [x.get("pattern", {}).get("Regex") for x in cutter.get("pretokenizers", [])]
        self.spaced = cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not normal
        self.lowered = steps == ["NFC", "Replace", "Lowercase"] and WORD_PIECES in patterns
        added = build.get("added_tokens") or []
        plain = not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)
        self.known_build = plain and (self.spaced or self.lowered) and not cutter.get("add_prefix_space")
        self.pattern = regex.compile(BYTE_PIECES if self.spaced else WORD_PIECES)
        self.special = {t["content"]: array("I", [t["id"]]).tobytes() for t in added}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if added else None
        self.letters = _byte_letters()
        self.space = self.letters[32]
        self.units = Units(self._ids, remembered or REMEMBERED)

    def library(self, text: str) -> bytes:
        """The library's own ids of a text."""
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _ids(self, unit: str) -> bytes:
        """The ids of a unit."""
        if self.lowered and unit[:1] == " ":
            unit = unit[1:]
        if unit.isascii() and unit[1:].isalpha():  # nearly all: a word, mostly with the space in front
            if not self.spaced and unit[0].isalpha():
                return self._merged(unit) if unit.islower() else self.units[unit.lower()]
            if self.spaced and (unit[0] == " " or unit[0].isalpha()):
                return self._merged(self.space + unit[1:] if unit[0] == " " else unit)
        if unit in self.special:
            return self.special[unit]
        if not PLAIN.fullmatch(unit):
            return self.library(unit)
        text = unit if self.spaced else unit.lower()
        word = unit.removeprefix(" ") if self.spaced else unit
        pieces = [text] if word.isalpha() else self.pattern.findall(text)
        return b"".join([self._merged(p.encode().decode("latin-1").translate(self.letters)) for p in pieces])

    def _merged(self, raw: str) -> bytes:
        """The ids of a piece in the letters of the vocabulary, straight from the library's merge model."""
        return array("I", [token.id for token in self.model.tokenize(raw)]).tobytes()

    def _cut(self, text: str) -> list[str]:
        """The units of a text without special tokens."""
        stops = "" if JOINED_STOP.search(text) else STOPS
        if self.lowered:
            stops = "" if "İ" in text else stops  # ends in a combining mark when lowered
            for stop in stops:
                text = text.replace(stop, f" {stop}")
            return text.replace("\n", " ").split(" ")
        if "\0" in text or text[0].isspace() or text[-1].isspace() or any(run in text for run in RUNS) or RARE.search(text):
            return SAFE_CUT.split(text)
        for stop in stops:
            text = text.replace(stop, f"\0{stop}")
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.known_build:
            return self.library(text)
        if self.specials is None or not self.specials.search(text):
            units = self._cut(text)
        else:
            parts = enumerate(self.specials.split(text))
            units = [unit for i, part in parts if part for unit in ([part] if i % 2 else self._cut(part))]
        return b"".join(map(self.units.__getitem__, units))

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text of an array of UTF-8 bytes and nulls."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        alone = np.full(len(texts), not self.known_build)
        for content in self.special:  # also in capitals, which ``_lower`` takes away
            alone |= pc.match_substring(texts, content.encode(), ignore_case=True).to_numpy(zero_copy_only=False)
        together = iter(self._encode_together(texts.filter(pa.array(~alone))))
        return [
            self.encode(texts[i].as_py().decode("utf-8", "replace")) if one else next(together)
            for i, one in enumerate(alone.tolist())
        ]

    def _encode_together(self, texts: pa.Array) -> list[bytes]:
        """``encode_all`` for a vocabulary of known build, without special tokens."""
        bounds = np.frombuffer(texts.buffers()[1], "<i8", len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, int)
        if bounds[0] == bounds[-1]:
            return [b""] * len(texts)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        kind, first = KIND[data], np.zeros(len(data), bool)
        first[bounds[bounds < len(data)]] = True
        cut = _starts(data, kind, first, self.spaced)
        at = np.append(np.flatnonzero(cut), len(data))
        units = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at) - 1,
            [None, pa.py_buffer(at), pa.py_buffer(data if self.spaced else _lower(data, kind))],
        ).dictionary_encode()
        words = [unit.decode("utf-8", "replace") for unit in units.dictionary.to_numpy(zero_copy_only=False)]
        ids = pa.array(map(self.units.__getitem__, words), pa.large_binary(), size=len(words)).take(units.indices)
        ends = np.frombuffer(ids.buffers()[1], "<i8")[np.searchsorted(at, bounds)].tolist()
        raw = ids.buffers()[2].to_pybytes() if ends[-1] else b""
        return [raw[a:b] for a, b in zip(ends, ends[1:])]


def _starts(data: np.ndarray, kind: np.ndarray, first: np.ndarray, spaced: bool) -> np.ndarray:
    """Where a piece starts in any case; ``first`` marks the first byte of each text.

    That is where ASCII or Latin letters, digits and ASCII symbols meet, and at white space, but in
    a ``spaced`` vocabulary only at the first of a run, and behind a line feed that stands alone. No
    letter is composed across such a place, and what a piece looks ahead at stays with it.
    """
    cut = (SPACED_STARTS if spaced else LOWERED_STARTS).ravel()[kind[:-1] << 3 | kind[1:]]
    cut = np.append(True, cut) | first
    beyond = np.flatnonzero((kind[1:] <= QUOTE) & (kind[1:] != OTHER) & (kind[:-1] == BEYOND)) + 1
    beyond = beyond[(beyond > 1) & ~first[beyond - 1]]
    last = data[beyond - 2].astype(np.int64) << 8 | data[beyond - 1]
    letter = (last >> 8 & 31) << 6 | last & 63
    known = (last >= 0xC380) & (last <= 0xC98F) & ~np.isin(letter, [0xD7, 0xF7, 0x130])
    if spaced:
        white = np.isin(last, WHITE_2) | np.isin(data[beyond - 3].astype(np.int64) << 16 | last, WHITE_3)
        known |= (kind[beyond] == SPACE) & ~white
    cut[beyond[known]] = True
    if spaced:
        seen = (kind >= SYMBOL) & (kind != BEYOND) | (data >= 0xC3) & (data <= 0xDF)
        cut[1:] |= cut[:-1] & (data[:-1] == 10) & seen[1:]
    return cut


def _lower(data: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The bytes with line feeds as spaces and A-Z in lower case, so that more units are equal.

    Not in front of a letter beyond ASCII: with it a small letter may be composed (J and a caron
    are not, j and a caron are). Such units are lower-cased when they are worked out.
    """
    capital = kind == CAPITAL
    capital[:-1] &= kind[1:] != BEYOND
    return np.where(kind == SPACE, np.uint8(32), data + (capital * np.uint8(32)))


@functools.lru_cache(maxsize=1)
def _kept(path: str, version: tuple[int, int]) -> Encoder:
    return Encoder(path, KEPT)


def kept(path: str) -> Encoder:
    """This process's encoder for a vocabulary file, with the units of earlier calls; one at a time."""
    stat = os.stat(path)
    return _kept(path, (stat.st_mtime_ns, stat.st_size))


def as_ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype="<u4")
