"""Approximate nearest neighbours by cosine over balanced posting lists.

Centroids are fitted on a bounded sample of unit vectors; their number follows the number of
vectors, so posting lists keep their length. Every vector goes to its nearest centroid's list and,
if it lies near a boundary, to those of other centroids at most (1 + REPLICATE) times as far, up
to COPIES lists, which it finds in an in-memory graph of the centroids (each linked with its
nearest ones; best-first search). A query ranks all centroids, goes to the nearest ``probes`` lists
and drops lists whose centroid is more than (1 + slack) times as far as the nearest. The vectors in
the chosen lists are compared exactly.

No fixed number of probes holds the recall as lists grow in number, so ``probes`` and ``slack`` are
measured: TUNED queries are compared with every vector, and both are taken so large that RECALL of
the neighbours so found lie in a searched list, PROBES and PRUNE at least.

Equal vectors are one entry that carries their least ids, as many as can matter; so a vector that
a third of all rows have makes no long list and no repeated search. A list longer than LIST_CHUNK
entries is dealt into chunks that are searched apart, and partial answers are merged.

Defined results: vectors that are null, empty, zero, of another dimension than most, or hold null
or non-finite components take no part, neither as queries nor as candidates. Fewer than ``k``
candidates give fewer rows. Ties in the score go to the smaller id. Repeated rows with one id are
one candidate; rows with a null id take no part. Columns other than the id and the vector are
never read. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoint import checkpointed

#: Vectors that centroids are fitted on, at most.
SAMPLE = 40_000
#: Entries that a posting list should hold, and the most centroids kept in memory.
LIST_LENGTH, MOST_CENTROIDS = 128, 1 << 14
COPIES, REPLICATE = 4, 0.25
PROBES, PRUNE = 48, 0.6
#: Queries that are compared with all vectors, at most, and the share of their neighbours to find.
TUNED, RECALL = 256, 0.98
GRAPH_DEGREE, BEAM = 24, 24
LIST_CHUNK = 4096
ROUNDS = 6


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec): rows that take part, once each; vec is an array of double."""
    vec = F.col(vector).cast("array<double>")
    plain = rows.select(F.col(key).cast("long").alias("id"), vec.alias("vec")).where(
        "id is not null and vec is not null and size(vec) > 0"
        " and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
        " and exists(vec, x -> x <> 0)"
    )
    width = plain.groupBy(F.size("vec").alias("w")).count().orderBy(F.desc("count"), "w").first()
    plain = plain.where(F.size("vec") == (width.w if width else 0))
    return plain.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0))).distinct()


def entries(plain: DataFrame, k: int) -> DataFrame:
    """(vec, ids): each different vector with its k + 1 least ids."""
    among = Window.partitionBy("vec").orderBy("id")
    few = plain.withColumn("_n", F.row_number().over(among)).where(F.col("_n") <= k + 1)
    return few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(1, keepdims=True)
    scaled = vectors / largest  # no overflow or underflow in the squares
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def fit_centroids(sample: np.ndarray, n: int) -> np.ndarray:
    """Spherical k-means whose clusters are pulled to equal size by a price on full ones."""
    rng = np.random.default_rng(5)
    centres = sample[rng.choice(len(sample), n, replace=False)].astype(np.float32)
    data, price = sample.astype(np.float32), np.zeros(n, np.float32)
    for _ in range(ROUNDS):
        near = np.concatenate([(p @ centres.T - price).argmax(1) for p in np.array_split(data, len(data) // 4096 + 1)])
        sizes = np.bincount(near, minlength=n)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, data)
        lost = sizes == 0
        sums[lost] = data[rng.choice(len(data), lost.sum())]
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
        price = np.clip(price + 0.02 * (sizes / sizes.mean() - 1), -0.1, 0.1).astype(np.float32)
    return centres


class Graph:
    """Centroids linked with their nearest ones, and a few far ones; best-first search."""

    def __init__(self, centres: np.ndarray):
        self.centres = centres
        n, degree = len(centres), min(GRAPH_DEGREE, len(centres) - 1)
        near = []
        for part in np.array_split(np.arange(n), n // 2048 + 1):
            likeness = centres[part] @ centres.T
            likeness[np.arange(len(part)), part] = -2
            near.append(np.argpartition(-likeness, max(degree - 1, 0), axis=1)[:, :degree])
        far = np.random.default_rng(1).integers(0, n, (n, 4))
        self.links = np.concatenate((np.concatenate(near), far), axis=1)
        self.starts = np.linspace(0, n - 1, min(n, 16)).astype(int)

    def search(self, query: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Centroids found, nearest first, and their cosines."""
        seen = np.zeros(len(self.centres), bool)
        seen[self.starts] = True
        first = self.centres[self.starts] @ query
        todo = [(-s, i) for s, i in zip(first.tolist(), self.starts.tolist())]
        best = [(s, i) for (s, i) in zip(first.tolist(), self.starts.tolist())]
        heapq.heapify(todo)
        heapq.heapify(best)
        while len(best) > beam:
            heapq.heappop(best)
        while todo:
            s, at = heapq.heappop(todo)
            if len(best) == beam and -s < best[0][0]:
                break
            fresh = self.links[at][~seen[self.links[at]]]
            if not len(fresh):
                continue
            fresh = np.unique(fresh)
            seen[fresh] = True
            for score, i in zip((self.centres[fresh] @ query).tolist(), fresh.tolist()):
                if len(best) < beam:
                    heapq.heappush(best, (score, i))
                elif score > best[0][0]:
                    heapq.heapreplace(best, (score, i))
                else:
                    continue
                heapq.heappush(todo, (-score, i))
        best.sort(reverse=True)
        return np.array([i for _, i in best]), np.array([s for s, _ in best])


def near_enough(cosines: np.ndarray, slack: float, most: int) -> int:
    """How many of centroids in order of cosine are at most (1 + slack) times the least distance."""
    distance = np.sqrt(np.maximum(2 - 2 * cosines, 0))
    return int(min(most, np.searchsorted(distance, distance[0] * (1 + slack) + 1e-6, side="right")))


def _routed(centres: np.ndarray, beam: int, slack: float, most: int):
    """Rows once for each list that they belong to (``list``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        graph = Graph(centres)
        for batch in filter(len, batches):
            vectors = unit(np.stack(batch["vec"].to_numpy())).astype(np.float32)
            times, lists = [], []
            for vector in vectors:
                found, cosines = graph.search(vector, beam)
                n = near_enough(cosines, slack, most)
                times.append(n)
                lists += found[:n].tolist()
            yield batch.loc[np.repeat(batch.index.to_numpy(), times)].assign(list=lists)

    return run


def ranked(centres: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All centroids of each vector, nearest first, and their cosines."""
    for part in np.array_split(vectors, len(vectors) // 512 + 1):
        for cosines in part @ centres.T:
            order = np.argsort(-cosines, kind="stable")
            yield order, cosines[order]


def _asked(centres: np.ndarray, slack: float, most: int):
    """Queries once for each list to search (``list``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in filter(len, batches):
            for start in range(0, len(batch), 512):
                rows = batch.iloc[start : start + 512]
                vectors = unit(np.stack(rows["vec"].to_numpy())).astype(np.float32)
                times, lists = [], []
                for found, cosines in ranked(centres, vectors):
                    n = near_enough(cosines, slack, most)
                    times.append(n)
                    lists += found[:n].tolist()
                yield rows.iloc[np.repeat(np.arange(len(rows)), times)].assign(list=lists)

    return run


def _nearest(asked: np.ndarray, k: int):
    """The ``k`` nearest vectors of each query among the rows of a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, scores = np.empty((len(asked), 0, asked.shape[1])), np.empty((len(asked), 0))
        for batch in filter(len, batches):
            data = np.stack(batch["vec"].to_numpy())
            fresh = asked @ unit(data).T
            take = np.argsort(-fresh, axis=1, kind="stable")[:, :k]
            scores = np.concatenate((scores, np.take_along_axis(fresh, take, 1)), axis=1)
            kept = np.concatenate((kept, data[take]), axis=1)
            take = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            scores = np.take_along_axis(scores, take, 1)
            kept = np.take_along_axis(kept, take[:, :, None], 1)
        yield pd.DataFrame(
            {"q": np.repeat(np.arange(len(asked)), scores.shape[1]), "score": scores.ravel(), "vec": list(kept.reshape(-1, asked.shape[1]))}
        )

    return run


def reach(index: DataFrame, questions: DataFrame, centres: np.ndarray, k: int) -> tuple[int, float]:
    """(probes, slack) by which RECALL of the true neighbours of some queries are found."""
    few = questions.select("vec").orderBy(F.xxhash64("vec")).limit(TUNED).collect()
    if len(centres) == 1 or not few:
        return PROBES, PRUNE
    asked = unit(np.array([r.vec for r in few]))
    near = index.select("vec").mapInPandas(_nearest(asked, k + 1), "q int, score double, vec array<double>")
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.xxhash64("vec"))
    near = near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).collect()
    found = list(ranked(centres, asked.astype(np.float32)))
    graph, ranks, ratios = Graph(centres), [], []
    for row in near:
        if row.vec == few[row.q].vec:  # the query itself
            continue
        lists, cosines = graph.search(unit(np.array([row.vec])).astype(np.float32)[0], BEAM)
        held = lists[: near_enough(cosines, REPLICATE, COPIES)]
        centroids, cosines = found[row.q]
        rank = int(np.flatnonzero(np.isin(centroids, held))[0])
        distance = np.sqrt(np.maximum(2 - 2 * cosines[[0, rank]], 0))
        ranks.append(rank + 1)
        ratios.append(distance[1] / max(distance[0], 1e-6) - 1)
    if not ranks:
        return PROBES, PRUNE
    ranks, ratios = np.array(ranks), np.array(ratios)
    for level in np.linspace(RECALL, 1, 9):
        probes, slack = (np.quantile(x, level, method="higher") for x in (ranks, ratios))
        if ((ranks <= probes) & (ratios <= slack)).mean() >= RECALL:
            break
    return max(PROBES, int(probes)), max(PRUNE, float(slack))


def _compared(k: int):
    """Queries and candidates of one chunk of a list: each query's best ids, by exact cosine."""

    def run(key, queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(found):
            data, rows = np.stack(found["vec"].to_numpy()), np.stack(queries["vec"].to_numpy())
            own = unit(data)
            for start in range(0, len(rows), 512):
                rough = unit(rows[start : start + 512]) @ own.T
                take = min(k + 2, rough.shape[1])
                cut = -np.partition(-rough, take - 1, axis=1)[:, take - 1] - 1e-9
                for i in range(len(rough)):
                    at = np.flatnonzero(rough[i] >= cut[i])
                    scores = cosine(rows[start + i], data[at])
                    best = sorted(
                        (-s, v) for s, j in zip(scores.tolist(), at.tolist()) for v in found["ids"].iat[j]
                    )[: k + 1]
                    out.append((queries["qid"].iat[start + i], [v for _, v in best], [-s for s, _ in best]))
        return pd.DataFrame(out, columns=["qid", "ids", "scores"])

    return run


def tamed(vector: np.ndarray) -> np.ndarray:
    """The vector, times a power of two where its squares would leave the range of a double."""
    largest = np.abs(vector).max()
    return vector if 1e-100 < largest < 1e100 else np.ldexp(vector, -int(np.frexp(largest)[1]))


def cosine(query: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact sums, so that the order of terms and the shape of a batch do not matter."""
    query = tamed(query)
    norm = math.sqrt(math.fsum((query * query).tolist()))
    return np.array(
        [
            max(-1.0, min(1.0, math.fsum((query * row).tolist()) / (norm * math.sqrt(math.fsum((row * row).tolist())))))
            for row in map(tamed, data)
        ]
    )


def search(rows: DataFrame, is_query: str, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row where ``is_query``
    (a condition on ``id``) holds, among all other rows."""
    session = rows.sparkSession
    empty = session.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    plain = checkpointed(usable(rows, key, vector))
    index = checkpointed(entries(plain, k))
    n = index.count()
    if not n:
        return empty
    part = min(1.0, SAMPLE / n)
    chosen = index.where(F.pmod(F.xxhash64("vec"), F.lit(1_000_000)) < math.ceil(part * 1_000_000)).select("vec")
    sample = unit(np.array([r.vec for r in chosen.orderBy(F.xxhash64("vec")).limit(SAMPLE).collect()]))
    centres = fit_centroids(sample, max(1, min(len(sample) // 4, n // LIST_LENGTH, MOST_CENTROIDS)))

    lists = index.mapInPandas(_routed(centres, BEAM, REPLICATE, COPIES), "vec array<double>, ids array<long>, list int")
    lists = checkpointed(lists)
    sizes = lists.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / LIST_CHUNK).cast("int").alias("chunks"))
    asked = plain.where(is_query)
    questions = checkpointed(asked.groupBy("vec").agg(F.min("id").alias("qid")))
    owners = asked.join(questions, "vec").select("id", "qid")
    probes, slack = reach(index, questions, centres, k)
    questions = checkpointed(
        questions.mapInPandas(_asked(centres, slack, probes), "vec array<double>, qid long, list int")
    )
    spread = questions.join(sizes, "list").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    stored = lists.join(sizes, "list").withColumn("chunk", F.pmod(F.xxhash64("vec"), F.col("chunks")).cast("int"))
    partial = (
        spread.select("list", "chunk", "qid", "vec").groupBy("list", "chunk")
        .cogroup(stored.select("list", "chunk", "vec", "ids").groupBy("list", "chunk"))
        .applyInPandas(_compared(k), "qid long, ids array<long>, scores array<double>")
    )
    pairs = partial.select("qid", F.explode(F.arrays_zip("ids", "scores")).alias("p")).select(
        "qid", F.col("p.ids").alias("vec_id"), F.col("p.scores").alias("score")
    ).distinct()
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    answers = pairs.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    answers = answers.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("all"))
    mine = F.slice(F.filter("all", lambda a: a["vec_id"] != F.col("id")), 1, k)
    return (
        owners.join(answers, "qid")
        .select(F.col("id").alias("query_id"), F.posexplode(mine).alias("at", "a"))
        .select("query_id", (F.col("at") + 1).alias("rank"), "a.vec_id", "a.score")
    )
