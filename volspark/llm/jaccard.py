"""Similarity join on word n-grams: T-occurrence search over inverted lists.

Two documents link when ``100 · |A ∩ B| >= percent · |A ∪ B|`` for their sets of n-gram hashes (64
bits). Documents of equal sets are one node from the start. A node of n grams overlaps any partner
in at least T = ⌈percent n / 100⌉ of them, which the search uses three times:

1. *Sketch.* Of all its grams in hash order, a node shows the first n - T + 1 + extra(n). Linked
   nodes share more than extra of them, of the smaller node (or its T, if less). Grams shown by one node only are counted out;
   nodes left with too few shared ones link to nothing. This takes one small table for all data.
2. *Rare first.* The nodes that remain are encoded again in full, and their grams ordered by how
   many of these nodes have them. Linked nodes share one of their n - T + 1 rarest; a copy with
   more edits than the threshold allows has that many grams of its own and drops out here. Nodes
   that share a rare gram form clusters.
3. *DivideSkip.* Within a cluster, a node's grams are looked up in inverted lists: its short lists
   are merged, the L longest are set aside; who occurs T - L times in the short ones is probed for
   in the long ones by binary search, and kept if the whole overlap suffices. The short lists are
   merged in order by one vectorised sort instead of a heap of their heads.

A cluster of many grams is dealt into blocks, and pairs of blocks are tasks of their own, so no
task holds more than two blocks and no pair is missed. Tasks return a link count for each node and
a forest of links, never the pairs; connected components over the forests give the classes.

Defined results: a null text counts as empty; documents without a word have an empty set and link
with nothing. With fewer words than the gram's length, the whole sequence is the only gram. Rows
of equal id are rows of their own. Null ids are allowed: a class is named by its least id that is
not null. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoint import checkpointed
from .corpus import lean, release
from .graph import components

#: Grams shown beyond the n - T + 1 that one shared gram needs: so many, or this part of n if more.
EXTRA, EXTRA_PART = 8, 20
#: Grams in a block of a cluster, about.
BLOCK_GRAMS = 2_000_000
#: Weight of the merge in DivideSkip's choice of long lists.
MU = 0.01
#: Bits of the filter that spares the shuffle of texts that are out already (fixed size).
FILTER_BITS = 1 << 25
NO_ID = -(1 << 63)
ROWS_AT_ONCE = 500


def words_of(text: str | None) -> list[bytes]:
    """ASCII letters in lower case; words are cut at ASCII white space only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def grams(text: str | None, size: int) -> np.ndarray:
    """The sorted different hashes of all ``size`` words in a row."""
    from xxhash import xxh64_intdigest

    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    many, width = np.uint64(0x9E3779B97F4A7C15), min(size, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        out = out * many + h[i : len(h) - width + 1 + i]
    out ^= out >> np.uint64(30)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return np.unique(out)


def signature(tokens: np.ndarray) -> bytes:
    return blake2b(tokens.tobytes(), digest_size=16).digest()


def least_overlap(n, percent: int):
    return -(-n * percent // 100)


def extra(n: int) -> int:
    return max(EXTRA, n // EXTRA_PART)


def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The batches in parts of a few hundred rows, so that a task holds the grams of few texts."""
    for batch in batches:
        for start in range(0, len(batch), ROWS_AT_ONCE):
            yield batch[start : start + ROWS_AT_ONCE]


def sketches(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n, sig (of the set), shown (the first grams in hash order)."""

    @lean
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in parts(batches):
            rows = []
            for text in batch["text"]:
                tokens = grams(text, size)
                n = len(tokens)
                shown = tokens[: n - least_overlap(n, percent) + 1 + extra(n)]
                rows.append((n, signature(tokens), shown.tobytes()))
            out = pd.DataFrame(rows, columns=["n", "sig", "shown"])
            yield pd.concat((batch[["doc_id"]].astype("Int64").reset_index(drop=True), out), axis=1)

    schema = "doc_id long, n long, sig binary, shown binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, schema)


def _flat(column: str, keep: str):
    """Rows (token, keep) for each token in a binary column."""

    @lean
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts(batches):
            sizes = [len(raw) // 8 for raw in part[column]]
            token = np.frombuffer(b"".join(part[column]), "<i8")
            yield pd.DataFrame({"token": token, keep: np.repeat(part[keep].to_numpy(), sizes)})

    return run


def shared_only(rows: DataFrame) -> DataFrame:
    """Rows whose token stands in more than one, with that number (df)."""
    counts = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    return rows.join(counts, "token")


def suspects(nodes: DataFrame, percent: int) -> DataFrame:
    """Nodes that show enough grams that others show too: columns of ``nodes``."""
    brief = nodes.select(F.xxhash64("sig").alias("brief"), "shown")
    hits = shared_only(brief.mapInPandas(_flat("shown", "brief"), "token long, brief long"))
    hits = hits.groupBy("brief").agg(F.count(F.lit(1)).alias("hits"))
    overlap = lambda n: F.floor((n * percent + 99) / 100)
    smallest = overlap(F.col("n"))  # no partner has fewer grams
    least = F.least(
        F.greatest(F.lit(EXTRA), F.floor(smallest / EXTRA_PART)) + 1, overlap(smallest)
    )
    found = nodes.withColumn("brief", F.xxhash64("sig")).join(hits, "brief")
    return found.where(F.col("hits") >= least).drop("brief", "hits")


def member_filter(ids: DataFrame, column: str):
    """A condition that holds for every id of ``ids`` and for few others: one bitmap of fixed size.

    It only spares a shuffle; a join decides. However many ids there are, the driver gets at most
    FILTER_BITS / 64 words.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    words = (
        ids.select((slot / 64).cast("int").alias("at"), bit.alias("bit"))
        .groupBy("at")
        .agg(F.bit_or("bit").alias("bits"))
        .collect()
    )
    bitmap = np.zeros(FILTER_BITS // 64, np.int64)
    bitmap[[r["at"] for r in words]] = [r["bits"] for r in words]

    @F.pandas_udf("boolean")
    def inside(at: pd.Series) -> pd.Series:
        place = at.to_numpy()
        return pd.Series((bitmap[place >> 6] >> (place & 63)) & 1 == 1)

    return inside(slot)


def full_sets(docs: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """sig, n, copies, tokens of the nodes in ``found``, encoded anew from one document of each."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_key")
    wanted = found.select(F.coalesce("rep", F.lit(NO_ID)).alias("_key")).distinct()
    texts = docs.select(key, "text").where(member_filter(wanted, "_key")).join(wanted, "_key", "left_semi")

    @lean
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in parts(batches):
            tokens = [grams(text, size) for text in batch["text"]]
            yield pd.DataFrame(
                {"sig": [signature(t) for t in tokens], "tokens": [t.tobytes() for t in tokens]}
            )

    sets = texts.mapInPandas(run, "sig binary, tokens binary")
    return found.select("sig", "n", "copies").join(sets, "sig").dropDuplicates(["sig"])


def clusters(sets: DataFrame, percent: int) -> DataFrame:
    """(node, root) for nodes that share a gram among the rarest that a link needs."""
    rows = shared_only(sets.select("sig", "tokens").mapInPandas(_flat("tokens", "sig"), "token long, sig binary"))
    by_node = Window.partitionBy("sig")
    least = F.floor((F.col("n") * percent + 99) / 100)
    ranked = (
        rows.join(sets.select("sig", "n"), "sig")
        .withColumn("_own", F.col("n") - F.count(F.lit(1)).over(by_node))
        .withColumn("_rank", F.row_number().over(by_node.orderBy("df", "token")))
        .where(F.col("_own") + F.col("_rank") <= F.col("n") - least + 1)
        .select("token", "sig")
    )
    ranked = checkpointed(ranked)
    release(sets.sparkSession)
    first = ranked.groupBy("token").agg(F.min("sig").alias("b"))
    return components(ranked.join(first, "token").select(F.col("sig").alias("a"), "b"))


def tiles(sets: DataFrame, grouped: DataFrame, spread: int) -> DataFrame:
    """Each node once for every task it takes part in: tile, cross, block and its columns."""
    placed = sets.join(grouped.withColumnsRenamed({"node": "sig"}), "sig")
    weights = placed.groupBy("root").agg(F.ceil(F.sum("n") / BLOCK_GRAMS).cast("int").alias("blocks"))
    placed = placed.join(weights, "root")
    block = F.when(F.col("blocks") > 1, F.pmod(F.hash("sig"), F.col("blocks"))).otherwise(0)
    small = F.pmod(F.hash("root"), F.lit(spread)).cast("string")
    pair = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda q: F.struct(
            F.concat_ws(":", F.hex("root"), F.least(q, F.col("block")).cast("string"), F.greatest(q, F.col("block")).cast("string")).alias("tile"),
            (q != F.col("block")).alias("cross"),
        ),
    )
    alone = F.array(F.struct(small.alias("tile"), F.lit(False).alias("cross")))
    return (
        placed.withColumn("block", block)
        .withColumn("_t", F.explode(F.when(F.col("blocks") > 1, pair).otherwise(alone)))
        .select("_t.tile", "_t.cross", "block", "sig", "n", "copies", "tokens")
    )


def divide_skip(sets: list[np.ndarray], percent: int, sides: np.ndarray | None = None):
    """Links (a < b) among sets of sorted hashes, as two index arrays for each a that has any.

    With ``sides``, only links between sets of different sides are wanted.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets), dtype=np.int64), sizes)
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(token, kind="stable")
    posting = owner[order]
    starts = np.concatenate(([0], np.cumsum(np.bincount(token))))
    lengths = np.diff(starts)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    longest = math.log2(lengths.max() + 1)
    for a in range(len(sets)):
        own = token[ends[a] : ends[a + 1]]
        n = len(own)
        need = least_overlap(n, percent)
        own = own[np.argsort(lengths[own], kind="stable")]
        skip = min(need - 1, int(need / (MU * longest + 1)))
        short, long = own[: n - skip], own[n - skip :]
        short = short[lengths[short] > 1]
        if not len(short):
            continue
        merged = np.concatenate([posting[starts[t] : starts[t + 1]] for t in short])
        merged = np.sort(merged[merged > a])
        if not len(merged):
            continue
        heads = np.flatnonzero(np.concatenate(([True], merged[1:] != merged[:-1])))
        found, count = merged[heads], np.diff(np.append(heads, len(merged)))
        fits = (count >= need - skip) & (100 * n >= percent * sizes[found]) & (100 * sizes[found] >= percent * n)
        if sides is not None:
            fits &= sides[found] != sides[a]
        found, count = found[fits], count[fits]
        for t in long:
            if not len(found):
                break
            listed = posting[starts[t] : starts[t + 1]]
            at = np.minimum(np.searchsorted(listed, found), len(listed) - 1)
            count += listed[at] == found
        linked = 100 * count >= percent * (n + sizes[found] - count)
        if linked.any():
            yield a, found[linked]


def _search(percent: int):
    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("sig")
        sets = [np.frombuffer(raw, "<u8") for raw in group["tokens"]]
        copies, names = group["copies"].to_numpy(), group["sig"].to_numpy()
        sides = group["block"].to_numpy() if key[1] else None
        links, root, edges = np.zeros(len(sets), np.int64), list(range(len(sets))), []

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for a, found in divide_skip(sets, percent, sides):
            links[a] += copies[found].sum()
            links[found] += copies[a]
            for b in found.tolist():
                x, y = top(a), top(b)
                if x != y:
                    root[max(x, y)] = min(x, y)
                    edges.append((names[b], names[a], 0))
        counted = [(names[i], None, int(links[i])) for i in np.flatnonzero(links)]
        return pd.DataFrame(edges + counted, columns=["a", "b", "links"])

    return run


def join(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id reached), n_links."""
    session = docs.sparkSession
    spread = int(session.conf.get("spark.sql.shuffle.partitions"))
    rows = checkpointed(sketches(docs, size, percent))
    nodes = (
        rows.where("n > 0")
        .groupBy("sig")
        .agg(
            F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
            F.first("n").alias("n"), F.first("shown").alias("shown"),
        )
    )
    found = checkpointed(suspects(nodes, percent).drop("shown"))
    release(session)
    sets = checkpointed(full_sets(docs, found, size))
    release(session)
    grouped = clusters(sets, percent)
    total = sets.agg(F.sum("n")).first()[0] or 0
    work = tiles(sets, grouped, max(2 * spread, -(-total // BLOCK_GRAMS)))
    links = checkpointed(
        work.groupBy("tile", "cross").applyInPandas(_search(percent), "a binary, b binary, links long")
    )
    release(session)
    members = components(links.where("b is not null"))
    counts = links.where("b is null").groupBy(F.col("a").alias("sig")).agg(F.sum("links").alias("links"))
    named = (
        nodes.select("sig", "rep", "copies")
        .join(members.withColumnsRenamed({"node": "sig"}), "sig", "left")
        .join(counts, "sig", "left")
        .select("sig", "rep", "copies", F.coalesce("root", "sig").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    named = checkpointed(named)
    names = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(names, "root").select(
        "sig", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links")
    )
    linked = rows.where("n > 0").join(named, "sig").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links")
    empty = rows.where("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")
    )
    return linked.unionByName(empty)
