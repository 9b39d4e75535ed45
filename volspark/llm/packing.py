"""Best-fit packing of token sequences into sequences of a fixed capacity.

Items above a third of the capacity never fit three to a sequence: they are matched greedily, each
with the largest that still fits beside it. Smaller items then go, longest first, into the
narrowest gap that holds them. Only lengths matter, and there are at most ``capacity`` of them: the
whole plan is made from a histogram, as runs of equal sequences, and every item finds its place
from its rank among the items of its length. So the driver's work is bounded whatever the input.

Defined results: a null or empty text is the end token alone. Items without length, or with a
length outside 1 to capacity, get no sequence (null). Repeated rows are items of their own. Equal
lengths are ranked by the given order; rows equal in it are exchangeable. Other columns pass
through; the columns added are ``sequence_id`` and ``offset``, which replace columns so named.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoint import checkpointed
from .corpus import lean, parts
from .tokens import Encoder, kept

CAPACITY = 2048
END_ID = 0
#: Items of one length that are ranked together, about.
RANKED_TOGETHER = 100_000
#: Bytes of the texts whose pieces a task hands to Spark together.
BATCH_BYTES = 1 << 20
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary"


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
    remembered: int | None = None,
) -> DataFrame:
    """Each document's ids and the end id, cut only if longer than ``capacity``: the first piece
    takes what whole ones leave. Columns: doc_id, piece, start, length, ids (unsigned 32-bit).
    ``remembered`` bounds the words that a task remembers, which otherwise live on in its worker: less
    memory for more time."""
    end = np.array([end_id], dtype="<u4").tobytes()

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, remembered) if remembered else kept(tokenizer)
        for keys, texts in parts(batches, BATCH_BYTES):
            row, piece, start, length, ids = [], [], [], [], []
            for i, raw in enumerate(encoder.encode_all(texts)):
                raw += end
                n = len(raw) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    ids.append(raw[4 * a : 4 * b])
            columns = [
                keys.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(ids, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return texts.mapInArrow(run, PIECE_SCHEMA)


def plan(counts: Mapping[int, int], capacity: int) -> tuple[list[tuple[int, ...]], int]:
    """Runs (length, first rank, items, items per sequence, first sequence, offset); sequences.

    The item of rank r in a run goes to sequence first + (r - first rank) // per, at
    offset + (r - first rank) % per * length.
    """
    left = {length: n for length, n in counts.items() if n}
    runs: list[tuple[int, ...]] = []
    placed = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}
    widths: list[int] = []
    sequences = 0

    def put(length: int, items: int, per: int, first: int, offset: int) -> None:
        runs.append((length, placed[length], items, per, first, offset))
        placed[length] += items
        left[length] -= items

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                insort(widths, gap)
            gaps[gap].append((first, n))

    large = sorted(length for length in left if 3 * length > capacity)
    while large:
        length = large[-1]
        if not left[length]:
            large.pop()
            continue
        at = bisect_left(large, capacity - length + 1) - 1
        while at >= 0 and not left[large[at]]:
            del large[at]
            at -= 1
        other = large[at] if at >= 0 else None
        if other is None or (other == length and left[length] == 1):
            below = [x for x in large[:at] if left[x]] if other is not None else []
            other = below[-1] if below else None
        if other is None:
            n = left[length]
            put(length, n, 1, sequences, 0)
            leave(capacity - length, sequences, n)
        elif other == length:
            n = left[length] // 2
            put(length, 2 * n, 2, sequences, 0)
            leave(capacity - 2 * length, sequences, n)
        else:
            n = min(left[length], left[other])
            put(length, n, 1, sequences, 0)
            put(other, n, 1, sequences, length)
            leave(capacity - length - other, sequences, n)
        sequences += n
    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(widths, length)
            if at == len(widths):
                n = -(-left[length] // (capacity // length))
                leave(capacity, sequences, n)
                sequences += n
                continue
            gap = widths[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], widths[at]
            per = gap // length
            used = min(n, left[length] // per)
            if used:
                put(length, used * per, per, first, capacity - gap)
                leave(gap - per * length, first, used)
                leave(gap, first + used, n - used)
            else:
                items = left[length]
                put(length, items, items, first, capacity - gap)
                leave(gap - items * length, first, 1)
                leave(gap, first + 1, n - 1)
    return runs, sequences


def pack(items: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``items`` (with a column ``length``) and each one's ``sequence_id`` and ``offset``."""
    kept = [c for c in items.columns if c not in ("sequence_id", "offset")]
    items = checkpointed(items.select(*kept))
    fits = F.coalesce(F.col("length").between(1, capacity), F.lit(False))
    whole = items.where(fits & (F.col("length") == capacity))
    parts = items.where(fits & (F.col("length") < capacity))
    misfits = items.where(~fits)

    session = items.sparkSession
    spread = int(session.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(spread, -(-parts.count() // RANKED_TOGETHER))
    parts = parts.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    tally = parts.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    tally = checkpointed(tally.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    histogram = {
        int(r.length): r.n for r in tally.groupBy("length").agg(F.sum("_n").alias("n")).collect()
    }
    runs, sequences = plan(histogram, capacity)
    table = np.array(sorted(runs) or [(0,) * 6], dtype=np.int64)
    keys = (table[:, 0] << 48) | table[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, at = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        run = table[np.searchsorted(keys, (size << 48) | at, side="right") - 1]
        turn = at - run[:, 1]
        return pd.DataFrame(
            {
                "sequence_id": run[:, 4] + turn // run[:, 3],
                "offset": run[:, 5] + turn % run[:, 3] * size,
            }
        )

    among = Window.partitionBy("length", "_bucket").orderBy(*order)
    ranked = (
        parts.withColumn("_rank", F.row_number().over(among) - 1)
        .join(tally.drop("_n"), ["length", "_bucket"])
        .withColumn("_place", place("length", F.col("_rank") + F.col("_before")))
        .select(*kept, "_place.sequence_id", "_place.offset")
    )
    alone = whole.select(
        *kept,
        (F.monotonically_increasing_id() + sequences).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    nowhere = F.lit(None).cast("long")
    none = misfits.select(*kept, nowhere.alias("sequence_id"), nowhere.alias("offset"))
    return ranked.unionByName(alone).unionByName(none)


def assemble(packed: DataFrame) -> DataFrame:
    """The token ids of every sequence, from packed pieces with their ``ids``."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return (
        packed.where("sequence_id is not null")
        .groupBy("sequence_id")
        .agg(F.expr("sum(length)").alias("length"), inside.alias("_parts"))
        .withColumn(
            "ids", F.expr("aggregate(_parts, cast('' as binary), (all, one) -> concat(all, one.ids))")
        )
        .drop("_parts")
    )
