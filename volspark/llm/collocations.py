"""Phrase collocations of each language, by best-first branch and bound over phrase prefixes.

A phrase of two or three words with a = f(phrase) >= ``least`` occurrences scores
``floor(10^6 a^2 / (l r))`` at a cut into a first part (l occurrences) and a rest (r); the cut with
the lowest score counts. A phrase is dropped if a longer one around it has half of its occurrences
or more. Wanted are the ``top`` best of those left, for each language.

Counting the words and pairs of all texts is one pass. Three-word phrases grow from their first
pair, and only where that is worth it: as f(rest) is at least a, and a at most f(pair), no phrase
that begins with the pair (v, w) scores more than ``floor(10^6 f(v w) / f(v))``. The pairs are the
frontier, best bound first, and are expanded in rounds. A round takes a score that a growing number
of known phrases reach (for each language), and expands every pair whose bound reaches it, and
every pair whose longer phrases could drop a two-word phrase of such a score. Then all phrases of
that score or more are known and their fate is settled. If ``top`` of them are left, no other
phrase can come in, ties included; else the next round goes further down, to the end if need be.

A task counts a bounded number of words at a time in numpy and hands on sums for each phrase;
Spark adds them up. Which pairs are expanded reaches the tasks as a bitmap of fixed size; a pair
that passes by chance is merely counted too. Scores are exact: products are 38-digit decimals,
enough for 10^12 occurrences.

Defined results: ASCII letters in lower case; pieces end at ``.,;:!?`` and line breaks, words at
spaces and tabs. A null language is ``und``; a null or empty text has no words. Null and repeated
ids make no difference, as ids are not read; an empty table gives an empty result. Only ``lang``
and ``text`` are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoint import checkpointed
from .corpus import release

LEAST, TOP, SCALE = 10, 2000, 1_000_000
#: Words that a task counts together.
WORDS_TOGETHER = 1 << 21
#: Known phrases whose scores the first round settles, as a multiple of those wanted; and its growth.
FIRST_ROUND, GROWTH = 1.5, 4
#: Bits of the map of expanded pairs (fixed size).
MAP_BITS = 1 << 25
#: Rows that a task hands to Spark together.
BATCH_ROWS = 1 << 16
#: Up to so many languages, a row for each of them is sent to all tasks; beyond that it is joined.
MOST_SENT = 10_000
UNKNOWN = "und"
BREAK = b"\xff"  # in no UTF-8 text
_TO_PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BREAK * 10)
_SPACED = b" " + BREAK + b" "
COUNTS = "lang string, w1 binary, w2 binary, w3 binary, n long"


def pair_hash(lang: bytes, first: bytes, second: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(b"\t".join((lang, first, second)), 42)


def _pair_slot():
    """The place in the bitmap of a pair in columns lang, w1, w2."""
    tab = F.lit(b"\t")
    return F.pmod(F.xxhash64(F.concat(F.col("lang").cast("binary"), tab, "w1", tab, "w2")), F.lit(MAP_BITS))


class Counter:
    """Words of one flush, as numbers, for each language."""

    def __init__(self, emit: Callable[[str, list[bytes], np.ndarray], Iterator[pa.RecordBatch]]):
        self.emit = emit
        self.clear()

    def clear(self) -> None:
        self.codes: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.codes[BREAK]
        self.texts: defaultdict[str, list[np.ndarray]] = defaultdict(list)
        self.words = 0

    def add(self, lang: str, text: bytes) -> None:
        tokens = text.lower().translate(_TO_PIECES).replace(BREAK, _SPACED).split()
        tokens.append(BREAK)
        self.texts[lang].append(np.fromiter(map(self.codes.__getitem__, tokens), np.int32, len(tokens)))
        self.words += len(tokens)

    def flush(self) -> Iterator[pa.RecordBatch]:
        known = list(self.codes)
        for lang, texts in self.texts.items():
            yield from self.emit(lang, known, np.concatenate(texts).astype(np.int64))
        self.clear()


def _rows(
    lang: str, known: pa.Array, columns: list[np.ndarray | None], n: np.ndarray
) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(n), BATCH_ROWS):
        part = slice(start, start + BATCH_ROWS)
        counts = pa.array(n[part].astype(np.int64))
        words = [pa.nulls(len(counts), pa.binary()) if c is None else known.take(pa.array(c[part])) for c in columns]
        name = pa.array([lang] * len(counts), pa.string())
        yield pa.RecordBatch.from_arrays([name, *words, counts], ["lang", "w1", "w2", "w3", "n"])


def _short(lang: str, known: list[bytes], codes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of one word, of two, and (no word) the number of words; code 0 ends a piece."""
    listed = pa.array(known, pa.binary())
    single = np.bincount(codes, minlength=len(known))
    single[0] = 0
    seen = np.flatnonzero(single)
    yield from _rows(lang, listed, [None, None, None], np.array([single.sum()]))
    yield from _rows(lang, listed, [seen, None, None], single[seen])
    key = (codes[:-1] << 32 | codes[1:])[(codes[:-1] > 0) & (codes[1:] > 0)]
    key, n = np.unique(key, return_counts=True)
    yield from _rows(lang, listed, [key >> 32, key & 0xFFFFFFFF, None], n)


def _long(bitmap: np.ndarray):
    """Rows of three words whose first two are in the bitmap."""

    def emit(lang: str, known: list[bytes], codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero((codes[:-2] > 0) & (codes[1:-1] > 0) & (codes[2:] > 0))
        pair, where = np.unique(codes[at] << 32 | codes[at + 1], return_inverse=True)
        name = lang.encode()
        slot = np.fromiter(
            (pair_hash(name, known[p >> 32], known[p & 0xFFFFFFFF]) for p in pair.tolist()), np.uint64, len(pair)
        )
        slot = (slot % np.uint64(MAP_BITS)).astype(np.int64)
        chosen = (bitmap[slot >> 6] >> (slot & 63)) & 1 == 1
        keep = chosen[where]
        key, n = np.unique(where[keep] << 32 | codes[at[keep] + 2], return_counts=True)
        first = pair[key >> 32]
        yield from _rows(lang, pa.array(known, pa.binary()), [first >> 32, first & 0xFFFFFFFF, key & 0xFFFFFFFF], n)

    return emit


def phrase_counts(docs: DataFrame, emit) -> DataFrame:
    """lang, w1, w2, w3, n: the occurrences of what ``emit`` lists, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(emit)
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                if text.is_valid:
                    counter.add(lang.as_py(), text.as_py())
                    if counter.words >= WORDS_TOGETHER:
                        yield from counter.flush()
        yield from counter.flush()

    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)), F.col("text").cast("binary"))
    rows = texts.mapInArrow(run, COUNTS)
    return rows.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n"))


def score(a: str, l: str, r: str):  # noqa: E741
    """floor(10^6 a^2 / (l r)), exact."""
    wide = {x: f"cast({x} as decimal(18, 0))" for x in (a, l, r)}
    return F.expr(f"{wide[a]} * {wide[a]} * {SCALE}BD div ({wide[l]} * {wide[r]})")


def pair_map(pairs: DataFrame) -> np.ndarray:
    """A bitmap of MAP_BITS for ``pairs`` (lang, w1, w2): however many, at most MAP_BITS / 64 words."""
    slot = _pair_slot()
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    words = (
        pairs.select((slot / 64).cast("int").alias("at"), bit.alias("bit"))
        .groupBy("at").agg(F.bit_or("bit").alias("bits")).collect()
    )
    bitmap = np.zeros(MAP_BITS // 64, np.int64)
    bitmap[[r["at"] for r in words]] = [r["bits"] for r in words]
    return bitmap


def scored_pairs(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """lang, w1, w2, a, l, r, score and bound of each pair."""
    left = words.select("lang", "w1", F.col("n").alias("l"))
    right = words.select("lang", F.col("w1").alias("w2"), F.col("n").alias("r"))
    return (
        pairs.select("lang", "w1", "w2", F.col("n").alias("a"))
        .join(left, ["lang", "w1"]).join(right, ["lang", "w2"])
        .withColumn("score", score("a", "l", "r"))
        .withColumn("bound", F.expr(f"cast(a as decimal(18, 0)) * {SCALE}BD div cast(l as decimal(18, 0))"))
    )


def scored_triples(pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """lang, w1, w2, w3, a, l, r, score of each phrase of three, at its lower cut (ties: the first)."""
    head = pairs.select("lang", "w1", "w2", F.col("l").alias("_l1"), F.col("a").alias("_l2"))
    tail = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("_r1"), F.col("r").alias("_r2"))
    both = (
        triples.select("lang", "w1", "w2", "w3", F.col("n").alias("a"))
        .join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"])
        .withColumn("_s1", score("a", "_l1", "_r1")).withColumn("_s2", score("a", "_l2", "_r2"))
    )
    first = F.col("_s1") <= F.col("_s2")
    return both.select(
        "lang", "w1", "w2", "w3", "a",
        F.when(first, F.col("_l1")).otherwise(F.col("_l2")).alias("l"),
        F.when(first, F.col("_r1")).otherwise(F.col("_r2")).alias("r"),
        F.least("_s1", "_s2").alias("score"),
    )


def reached_score(known: DataFrame, many: int) -> DataFrame:
    """(lang, floor): the highest score that ``many`` rows of each language reach, or 0.

    Scores lie between 0 and ``SCALE``, so counts for each score, summed up from the top, are rows
    of a bounded number for a language, however many phrases it has.
    """
    counts = known.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"))
    from_top = Window.partitionBy("lang").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    reached = counts.withColumn("reach", F.sum("n").over(from_top))
    return reached.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("reach") >= many, F.col("score"))), F.lit(0)).alias("floor"))


def by_language(floor: DataFrame) -> DataFrame:
    """``floor`` (a row for each language) as a side of a join, sent to all tasks if it is short."""
    return F.broadcast(floor) if floor.limit(MOST_SENT + 1).count() <= MOST_SENT else floor


def frontier(pairs: DataFrame, floor: DataFrame) -> DataFrame:
    """Pairs to expand so that all phrases of score ``floor`` (lang, floor) or more are settled."""
    known = pairs.join(floor, "lang")
    # a longer phrase (z, w, v) has at most f(z w) occurrences and drops (w, v) only from half of f(w v) on
    least = known.where("score >= floor").groupBy("lang", F.col("w1").alias("w2")).agg(F.min("a").alias("_least"))
    return known.join(least, ["lang", "w2"], "left").where("bound >= floor or 2 * a >= _least").select("lang", "w1", "w2", "a")


def survivors(pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """Phrases that no known longer phrase drops: lang, phrase (binary), a, l, r, score."""
    around = triples.select("lang", "w1", "w2", "a").unionByName(
        triples.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")
    )
    around = around.groupBy("lang", "w1", "w2").agg(F.max("a").alias("_most"))
    left = pairs.join(around, ["lang", "w1", "w2"], "left").where("_most is null or 2 * _most < a")
    space = F.lit(b" ")
    return left.select("lang", F.concat("w1", space, "w2").alias("phrase"), "a", "l", "r", "score").unionByName(
        triples.select("lang", F.concat("w1", space, "w2", space, "w3").alias("phrase"), "a", "l", "r", "score")
    )


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """The first ``top`` phrases of each language by score and a (descending) and phrase:
    lang, rank, phrase, a, l, r, n, score."""
    short = phrase_counts(docs, _short)
    short = checkpointed(short.where(f"w1 is null or n >= {int(least)}"))
    release(docs.sparkSession)
    totals = short.where("w1 is null").select("lang", "n")
    words = short.where("w1 is not null and w2 is null")
    pairs = checkpointed(scored_pairs(words, short.where("w2 is not null")))
    triples = None
    expanded = None
    settled_by = FIRST_ROUND * top
    while True:
        known = pairs.select("lang", "score")
        if triples is not None:
            known = known.unionByName(triples.select("lang", "score"))
        floor = reached_score(known, int(settled_by))
        floor = by_language(checkpointed(floor))
        wanted = frontier(pairs, floor)
        if expanded is not None:
            wanted = wanted.join(expanded, ["lang", "w1", "w2"], "left_anti")
        wanted = checkpointed(wanted)
        longer = phrase_counts(docs, _long(pair_map(wanted))).where(f"n >= {int(least)}")
        longer = scored_triples(pairs, longer)
        triples = checkpointed(longer if triples is None else triples.unionByName(longer).distinct())
        release(docs.sparkSession)
        left = checkpointed(survivors(pairs, triples).join(floor, "lang").where("score >= floor"))
        reached = floor.join(left.groupBy("lang").agg(F.count(F.lit(1)).alias("_left")), "lang", "left")
        if reached.where(f"floor > 0 and coalesce(_left, 0) < {int(top)}").isEmpty():
            break
        done = wanted.select("lang", "w1", "w2")
        expanded = done if expanded is None else expanded.unionByName(done)
        settled_by *= GROWTH
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= int(top))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score"
    )
