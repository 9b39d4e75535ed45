"""SSVI surfaces as tables: grids, fit errors, best candidate and arbitrage report."""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checkpoint import checkpointed
from ..functions.backend import ARRAY, sql
from ..functions.local_vol import with_local_vol
from ..functions.ssvi import PARAMS, arb_free, smile, ssvi_arb_free, vol, vol_at, with_ssvi_iv

# Fixed value: objective of a parameter set that violates the no-arbitrage condition.
PENALTY = 1e6

SLICE_ROWS = 20_000  # rows of one key that a task may be asked to take
SCREENED = 6  # quotes of a surface on which all candidates are tried first
PAIRS_TOGETHER = 50_000  # surfaces and candidates whose remaining quotes are summed at a time
QUOTES_TOGETHER = 50_000  # quotes that a task holds in Python at a time, beside one more surface
ROUNDING = 1e-9  # by so much, relatively, sums in another order may differ


def gather(rows: DataFrame, key: str, identity: Sequence[str]) -> tuple[DataFrame, bool]:
    """Bring the rows of a key together, but a key with many rows in slices of bounded size.

    ``identity`` names the columns that tell the rows of a key apart; they decide the slice. The
    column added is ``slices``, the number of them. Also tells whether any key has more than one;
    if none has, the rows move once and meet no join. ``rows`` is read twice.
    """
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = rows.groupBy(key).agg(F.ceil(F.count("*") / SLICE_ROWS).cast("int").alias("slices"))
    large = checkpointed(sizes.where("slices > 1"))
    if large.isEmpty():
        return rows.withColumn("slices", F.lit(1)).repartition(count, key), False
    placed = rows.join(large, key, "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    part = F.pmod(F.xxhash64(*identity), F.col("slices"))
    return placed.repartition(count, key, part), True


def literal_rows(names: Sequence[str], rows) -> str:
    """SQL text of an array of structs of DOUBLE literals."""
    structs = (
        f"struct({', '.join(f'{sql(v)} as {n}' for v, n in zip(row, names))})" for row in rows
    )
    return f"array({', '.join(structs)})"


def on_grid(surfaces: DataFrame, T_grid: Sequence[float], k_grid: Sequence[float]) -> DataFrame:
    """One row per surface and (T, k), T outermost. The grid is a literal: no join, no shuffle."""
    points = literal_rows(("T", "k"), [(T, k) for T in T_grid for k in k_grid])
    return surfaces.selectExpr("*", f"inline({points}) as (T, k)")


def iv_grid(surfaces: DataFrame, T_grid: Sequence[float], k_grid: Sequence[float]) -> DataFrame:
    """Implied-vol surface in long form."""
    return with_ssvi_iv(on_grid(surfaces, T_grid, k_grid))


def local_vol_grid(
    surfaces: DataFrame, T_grid: Sequence[float], k_grid: Sequence[float]
) -> DataFrame:
    """Local-vol surface in long form with the reason wherever it is undefined."""
    return with_local_vol(on_grid(surfaces, T_grid, k_grid))


def arbitrage_report(grid: DataFrame, keys: Sequence[str] = ("surface_id",)) -> DataFrame:
    """Failed grid points per surface and cause, from ``local_vol_grid``."""
    failed = lambda reason: F.count_if(F.col("reason") == reason).alias(reason)
    return grid.groupBy(*keys).agg(
        F.count("*").alias("points"),
        failed("butterfly"),
        failed("calendar"),
        failed("tiny_variance"),
    )


def _squared_error(weight: str | None) -> Column:
    """Sum over quotes of the squared distance between ``iv`` and the ``_model`` column."""
    return F.expr(f"sum({weight or '1D'} * (_model - iv) * (_model - iv))")


def ssvi_sse(
    quotes: DataFrame,
    params: DataFrame,
    key: str = "surface_id",
    weight: str | None = None,
) -> DataFrame:
    """Sum of squared vol errors per surface and parameter set.

    ``params`` has one row per (key, param_id); ``weight`` names a quote column, for instance the
    inverse bid/ask spread. A set that violates the no-arbitrage condition scores ``PENALTY``.
    """
    # Grouped by a struct, the sums do not count as clustered by the join: partial sums cross an
    # exchange after it, and adaptive execution may split a hot surface in the join. Sets grow with
    # the surfaces; merged, they need not fit into a task.
    scored = with_ssvi_iv(quotes.join(params.hint("merge"), key), "_model")
    sums = scored.groupBy(F.struct(F.col(key).alias("key")).alias("_surface"), "param_id").agg(
        _squared_error(weight).alias("sum_sq"), F.bool_and(ssvi_arb_free()).alias("admissible")
    ).withColumn(key, F.col("_surface.key"))
    sse = F.when(F.col("admissible"), F.col("sum_sq")).otherwise(PENALTY)
    return sums.select(key, "param_id", sse.alias("sse"))


class Candidates:
    """Weighted squared errors of parameter sets over quotes that are sorted by surface.

    Sets with the same gam and nu share the costly part of the smile.
    """

    def __init__(self, sets: Sequence[Sequence[float]]):
        self.sets = np.asarray(sets, dtype=np.float64).reshape(-1, len(PARAMS))
        self.groups: dict[tuple[float, float], list[int]] = {}
        for i, (_, _, gam, nu) in enumerate(self.sets.tolist()):
            self.groups.setdefault((gam, nu), []).append(i)
        self.admissible = arb_free(*self.sets[:, :3].T, ARRAY)

    def errors(self, T, k, iv, weight, first) -> np.ndarray:
        """Sums of each surface (rows; ``first`` is where it begins) for each set (columns)."""
        out = np.empty((len(first), len(self.sets)))
        for (gam, nu), members in self.groups.items():
            unit = smile(k, T, 0.0, 1.0, gam, nu, ARRAY).phi
            for i in members:
                miss = vol_at(unit, k, self.sets[i, 0], self.sets[i, 1], nu, ARRAY) - iv
                out[:, i] = np.add.reduceat(weight * miss * miss, first)
        return out

    def errors_of(self, chosen, T, k, iv, weight, first) -> np.ndarray:
        """Sums of each surface for one set each; ``chosen`` has it for every quote."""
        rho, eta, gam, nu = self.sets[chosen].T
        miss = vol(smile(k, T, rho, eta, gam, nu, ARRAY), ARRAY) - iv
        return np.add.reduceat(weight * miss * miss, first)

    def best(self, T, k, iv, weight, first) -> tuple[np.ndarray, np.ndarray]:
        """Least error and position of its set, for each surface; ties go to the lower position.

        Errors only grow from quote to quote. A few quotes far from the money, where sets differ
        most, are taken first, for all sets; then the whole surface, for the set that leads. A set
        that is worse on the few than the leader on all is out, and only the others are summed up.
        """
        count = np.diff(np.append(first, len(T)))
        owner = np.repeat(np.arange(len(first)), count)
        turn = np.lexsort((-np.abs(k) / np.sqrt(T), owner))
        T, k, iv, weight = (v[turn] for v in (T, k, iv, weight))
        few = np.minimum(count, SCREENED) if (weight >= 0).all() else count
        early = np.arange(len(T)) - first[owner] < few[owner]
        begin = np.cumsum(few) - few
        partial = self.errors(*(v[early] for v in (T, k, iv, weight)), begin)
        partial = np.where(np.isnan(partial), np.inf, partial)
        partial[:, ~self.admissible] = PENALTY
        rest, tail = count - few, ~early
        T, k, iv, weight = (v[tail] for v in (T, k, iv, weight))
        begin = np.cumsum(rest) - rest
        more = rest > 0

        def add(rows: np.ndarray, sets: np.ndarray) -> None:
            """Bring the sums of ``sets`` at ``rows`` from the few quotes to all."""
            sums = more[rows] & self.admissible[sets]
            rows, sets = rows[sums], sets[sums]
            for at in range(0, len(rows), PAIRS_TOGETHER):
                r, c = rows[at : at + PAIRS_TOGETHER], sets[at : at + PAIRS_TOGETHER]
                start = np.cumsum(rest[r]) - rest[r]
                quote = np.arange(rest[r].sum()) - np.repeat(start - begin[r], rest[r])
                quotes = (v[quote] for v in (T, k, iv, weight))
                partial[r, c] += self.errors_of(np.repeat(c, rest[r]), *quotes, start)

        rows = np.arange(len(first))
        leader = partial.argmin(axis=1)
        add(rows, leader)
        limit = partial[rows, leader]
        alive = partial <= (limit + ROUNDING * np.abs(limit))[:, None]
        out = ~alive
        alive[rows, leader] = False
        add(*np.nonzero(alive))
        partial[out] = np.inf
        best = partial.argmin(axis=1)
        return partial[rows, best], best


def _held_together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows that come in the order of ``surface``, some at a time; only a surface in slices is torn."""
    kept, count = [], 0
    for batch in filter(len, batches):
        kept.append(batch)
        count += len(batch)
        if count < QUOTES_TOGETHER:
            continue
        rows = pd.concat(kept, ignore_index=True)
        last = (rows["surface"] == rows["surface"].iloc[-1]) & (rows["slices"] == 1)
        if not last.all():
            yield rows[~last]
            rows = rows[last]
        kept, count = [rows], len(rows)
    if kept:
        yield pd.concat(kept, ignore_index=True)


def _candidate_scores(candidates: Candidates):
    """A row for each surface that is here as a whole, with its best set; one with the errors of
    all sets for each part of a larger surface."""

    numbers = ["T", "k", "iv", "weight"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _held_together(batches):
            rows = rows.astype(dict.fromkeys(numbers, np.float64))
            rows = rows[np.isfinite(rows[numbers]).all(axis=1) & (rows["T"] > 0)]
            for whole, part in rows.groupby(rows["slices"] == 1):
                codes, ids = pd.factorize(part["surface"])
                order = np.argsort(codes, kind="stable")
                quotes = [part[c].to_numpy()[order] for c in numbers]
                first = np.flatnonzero(np.diff(codes[order], prepend=-1))
                with np.errstate(all="ignore"):
                    if whole:
                        sse, best = candidates.best(*quotes, first)
                        yield pd.DataFrame({"surface": ids, "sse": sse, "param_id": best, "errors": None})
                    else:
                        errors = list(candidates.errors(*quotes, first))
                        yield pd.DataFrame({"surface": ids, "sse": None, "param_id": None, "errors": errors})

    return run


def best_candidate(
    quotes: DataFrame,
    candidates: Sequence[Sequence[float]],
    key: str = "surface_id",
    weight: str | None = None,
) -> DataFrame:
    """Best of a list of (rho, eta, gam, nu) candidates for every surface.

    The candidates travel with the function. The quotes of a surface are brought together, those of
    a large surface in slices, sorted by Spark, and tasks hold some surfaces at a time as arrays,
    however many there are: no quote is copied per candidate. A
    whole surface leaves its task as one row; candidates drop out early there, which is exact. The
    slices of a large surface leave as sums for all candidates. Ties go to the lower position.
    Quotes without a usable T, k, iv or weight do not count, and a surface that has no other is
    left out. Copies of a quote collapse first, into a checkpoint that is made when the result is
    built.
    """
    listed = literal_rows(PARAMS, candidates)
    chosen = Candidates(candidates)
    copies = checkpointed(quotes.groupBy(key, "T", "k", "iv").agg(F.sum(weight or F.lit(1.0)).alias("weight")))
    kind = copies.schema[key].dataType.simpleString()
    base, sliced = gather(copies, key, ("T", "k", "iv"))
    base = base.select(F.col(key).alias("surface"), "slices", "T", "k", "iv", "weight").sortWithinPartitions("surface")
    scores = base.mapInPandas(
        _candidate_scores(chosen), f"surface {kind}, sse double, param_id int, errors array<double>"
    )
    best = scores.where("errors is null").select(F.col("surface").alias(key), "sse", "param_id")
    if sliced:
        sums = (
            scores.where("errors is not null")
            .select(F.col("surface").alias(key), F.posexplode("errors").alias("param_id", "part"))
            .groupBy(key, "param_id")
            .agg(F.sum("part").alias("sse"))
        )
        fine = F.element_at(F.array(*[F.lit(bool(ok)) for ok in chosen.admissible]), F.col("param_id") + 1)
        sums = sums.withColumn("sse", F.when(fine, F.col("sse")).otherwise(PENALTY))
        least = sums.groupBy(key).agg(F.min(F.struct("sse", "param_id")).alias("least"))
        best = best.unionByName(least.select(key, "least.*"))
    best = best.withColumn("c", F.expr(f"element_at({listed}, param_id + 1)"))
    return best.select(key, "c.*", "sse", "param_id")
