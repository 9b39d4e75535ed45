"""SimHash near-duplicates: an exact comparison of all fingerprints, tile by tile.

A fingerprint has 64 bits; a bit is 1 if over half of the hashes of a text's shingles have it.
Two documents link when their fingerprints differ in at most ``radius`` bits.

*Tiles.* Equal fingerprints are one node from the start. Two that differ in at most ``radius`` bits
agree in whole on ``agree`` of ``radius + agree`` segments of the 64 bits, so each node is dealt to
one cell for every choice of ``agree`` segments, and only nodes of one cell are compared. A cell of
up to ``TILE`` nodes is a tile; a larger one is cut into tiles by population count and by hash, and
every pair of tiles whose population counts differ by no more than the radius is a row of its own,
compared wherever Spark puts it. The other pairs are skipped: so many bits cannot be made up.

*Comparison.* Within a tile or pair, nodes are sorted by population count. Blocks of rows meet only
the columns whose counts are within the radius: one numpy exclusive-or and bit count for a block.
A link counts in the first cell in which both meet, so it counts once. Tasks return the number of
links of each node and a forest of links, never the pairs; connected components give the classes.

Defined results: a text without words, or null, has fingerprint 0, which links like any other. With
fewer words than the shingle's length the whole sequence is the only shingle. Null and repeated
ids are rows of their own; a class is named by its least id that is not null. An empty table gives
an empty result. Words are cut at ASCII white space only. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checkpoint import checkpointed
from .corpus import release, slices
from .graph import components

BITS, SEED = 64, 42
#: Nodes of a tile, about, and rows of a tile that are compared together.
TILE, ROWS = 16_384, 256
#: Above so many different fingerprints, cells are cut by two segments instead of one.
MOST_BY_ONE_SEGMENT = 1 << 28
#: Bytes of the texts, and shingles, that a task turns into bits together.
BATCH_BYTES, BATCH_SHINGLES = 1 << 20, 1 << 16


def shingle_hashes(text: bytes | None, size: int) -> list[int]:
    """XXH64 of each ``size`` words in a row, repeats included."""
    from xxhash import xxh64_intdigest

    words = text.lower().split() if text else []
    if len(words) <= size:
        return [xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[: len(words) - size])).tolist()
    return [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each of the stretches of ``sizes`` hashes, the bits that over half of them have."""
    ones = np.zeros((len(sizes), BITS), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for start in range(0, len(hashes), BATCH_SHINGLES):
        part, own = hashes[start : start + BATCH_SHINGLES], owner[start : start + BATCH_SHINGLES]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        heads = np.flatnonzero(np.diff(own, prepend=-1))
        ones[own[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int32)
    set_ = (2 * ones > sizes[:, None]).astype(np.uint8)
    return np.packbits(set_, axis=1, bitorder="little").view("<u8")[:, 0]


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """doc_id and ``fingerprint`` (the 64 bits as a long) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches, BATCH_BYTES):
            found = [shingle_hashes(text, size) for text in texts]
            sizes = np.array([len(h) for h in found], np.int64)
            flat = np.fromiter((h for one in found for h in one), np.uint64, sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(majority(flat, sizes).view(np.int64))], ["doc_id", "fingerprint"]
            )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return texts.mapInArrow(run, "doc_id long, fingerprint long")


def cell_masks(radius: int, agree: int) -> list[int]:
    """The bits that the nodes of a cell share, for each choice of segments, as signed longs."""
    bounds = np.linspace(0, BITS, radius + agree + 1).round().astype(int).tolist()
    segments = [(1 << b) - (1 << a) for a, b in zip(bounds, bounds[1:])]
    masks = [sum(chosen) for chosen in combinations(segments, agree)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def tiles(nodes: DataFrame, radius: int, masks: list[int]) -> DataFrame:
    """Pairs of tiles to compare: choice, left, right (null: the left one with itself)."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("cell")) for k, m in enumerate(masks)])
    )
    dealt = nodes.select("fp", "copies", F.bit_count("fp").alias("ones"), cells.alias("_c"))
    dealt = dealt.select("_c.*", "ones", "fp", "copies")
    counts = checkpointed(dealt.groupBy("choice", "cell", "ones").agg(F.count(F.lit(1)).alias("n")))
    large = counts.groupBy("choice", "cell").agg(F.sum("n").alias("_all")).where(F.col("_all") > TILE)
    parts = counts.join(large.drop("_all"), ["choice", "cell"]).select(
        "choice", "cell", "ones", F.ceil(F.col("n") / TILE).cast("int").alias("parts")
    )
    placed = dealt.join(parts, ["choice", "cell", "ones"], "left").select(
        "choice", "cell",
        F.when(F.col("parts").isNotNull(), F.col("ones")).otherwise(-1).alias("ones"),
        F.coalesce(F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"), F.lit(0)).alias("part"),
        F.struct("fp", "copies").alias("node"),
    )
    listed = placed.groupBy("choice", "cell", "ones", "part").agg(F.collect_list("node").alias("nodes"))
    listed = checkpointed(listed.where("ones >= 0 or size(nodes) > 1"))
    alone = listed.select("choice", F.col("nodes").alias("left"), F.lit(None).cast(listed.schema["nodes"].dataType).alias("right"))
    cut = listed.where("ones >= 0")
    near = cut.select(
        "choice", "cell", "part", F.col("nodes").alias("left"),
        F.explode(F.sequence(F.lit(0), F.lit(radius))).alias("_more"), (F.col("ones") + F.col("_more")).alias("ones"),
    )
    other = cut.select("choice", "cell", "ones", F.col("part").alias("_part"), F.col("nodes").alias("right"))
    pairs = near.join(other, ["choice", "cell", "ones"]).where("_more > 0 or _part > part")
    return alone.unionByName(pairs.select("choice", "left", "right"))


def compare(left: np.ndarray, right: np.ndarray | None, radius: int, earlier: list[np.uint64]):
    """Pairs (i, j) at most ``radius`` bits apart, in blocks: of ``left`` and ``right``, or within
    ``left`` with i < j. Both are sorted by population count. Pairs that agree on one of the
    ``earlier`` masks are left out."""
    inside = right is None
    right = left if right is None else right
    ones = np.bitwise_count(right).astype(np.int64)
    for start in range(0, len(left), ROWS):
        rows = left[start : start + ROWS]
        counts = np.bitwise_count(rows[[0, -1]]).astype(np.int64)
        first = start + 1 if inside else int(np.searchsorted(ones, counts[0] - radius))
        last = int(np.searchsorted(ones, counts[1] + radius, side="right"))
        if first >= last:
            continue
        apart = rows[:, None] ^ right[None, first:last]
        i, j = np.nonzero(np.bitwise_count(apart) <= radius)
        apart = apart[i, j]
        i, j = i + start, j + first
        keep = j > i if inside else np.ones(len(i), bool)
        for mask in earlier:
            keep &= (apart & mask) != 0
        if keep.any():
            yield i[keep], j[keep]


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Labels after the links (i, j), and those of the links that joined two classes."""
    used = []
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return label, used
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        # a link for each class is enough for this turn; what it joins needs no other
        few = np.union1d(np.unique(a, return_index=True)[1], np.unique(b, return_index=True)[1])
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        for at in few.tolist():
            x, y = top(int(a[at])), top(int(b[at]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                used.append((int(i[at]), int(j[at])))
        new = np.arange(len(label))
        for x in parent:
            new[x] = top(x)
        label = new[label]


def links(pairs: DataFrame, radius: int, masks: list[int]) -> DataFrame:
    """Rows (a, b, null), a forest of the links in each pair of tiles, and (a, null, links)."""
    unsigned = [np.uint64(m & ((1 << BITS) - 1)) for m in masks]

    def nodes_of(listed) -> tuple[np.ndarray, np.ndarray]:
        flat = listed.flatten() if isinstance(listed, pa.ListArray) else listed.values
        fp = flat.field("fp").to_numpy().view(np.uint64)
        turn = np.lexsort((fp, np.bitwise_count(fp)))
        return fp[turn], flat.field("copies").to_numpy()[turn]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n = [], [], []
            for choice, left, right in zip(*(batch.column(k) for k in range(3))):
                choice = choice.as_py()
                fp, copies = nodes_of(left)
                other, more = nodes_of(right) if right.is_valid else (None, None)
                both = fp if other is None else np.concatenate((fp, other))
                shift = 0 if other is None else len(fp)
                weight = copies if other is None else np.concatenate((copies, more))
                label, total = np.arange(len(both)), np.zeros(len(both), np.int64)
                for i, j in compare(fp, other, radius, unsigned[:choice]):
                    j = j + shift
                    np.add.at(total, i, weight[j])
                    np.add.at(total, j, weight[i])
                    label, used = merge(label, i, j)
                    if used:
                        ends = both.view(np.int64)[np.array(used)]
                        a.append(ends[:, 0])
                        b.append(ends[:, 1])
                        n.append(np.full(len(used), -1))
                hit = np.flatnonzero(total)
                a.append(both.view(np.int64)[hit])
                b.append(a[-1])
                n.append(total[hit])
            if a:
                a, b, n = (np.concatenate(x).astype(np.int64) for x in (a, b, n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b, mask=n >= 0), pa.array(n, mask=n < 0)], ["a", "b", "links"]
                )

    spread = F.xxhash64("choice", F.col("left")[0]["fp"], F.col("right")[0]["fp"])
    parts = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return pairs.repartition(parts, spread).mapInArrow(run, "a long, b long, links long")


def near_duplicates(prints: DataFrame, radius: int = 4, agree: int | None = None) -> DataFrame:
    """doc_id, fingerprint, component_id (least id reached) and n_links of each row of
    ``prints`` (doc_id, fingerprint)."""
    session = prints.sparkSession
    prints = checkpointed(prints.select("doc_id", "fingerprint"))
    nodes = prints.groupBy(F.col("fingerprint").alias("fp")).agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    nodes = checkpointed(nodes)
    agree = agree or (1 if nodes.count() <= MOST_BY_ONE_SEGMENT else 2)
    masks = cell_masks(radius, agree)
    found = checkpointed(links(tiles(nodes, radius, masks), radius, masks))
    release(session)
    members = components(found.where("b is not null"))
    counts = found.where("b is null").groupBy(F.col("a").alias("fp")).agg(F.sum("links").alias("links"))
    named = (
        nodes.join(members.withColumnsRenamed({"node": "fp"}), "fp", "left")
        .join(counts, "fp", "left")
        .select("fp", "rep", "copies", F.coalesce("root", "fp").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    named = checkpointed(named)
    classes = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(classes, "root").select(
        F.col("fp").alias("fingerprint"), "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links")
    )
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id", "n_links")
