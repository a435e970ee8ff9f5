"""Filling missing cells from records of the same group, with donors named.

Predictive mean matching. For each target a linear predictor is fitted on all
complete rows (one aggregation of cross products; the group enters through its
shrunken mean, so the fit knows the block). Every row gets a prediction, and a
missing cell copies the observed value of the donor of its group whose
prediction is nearest, together with that donor's id.

Every donor takes part. Donors with equal predictions are reduced to the smallest
id (none of the others could win) before anything moves, and a prediction is
looked up once however many cells ask for it. The predictions of a group are
sorted and the nearest donors below and above found in one pass each way. Blocks
that hold many rows are sorted in up to ``PIECES`` ranges of the prediction; the
outermost donors of the ranges are handed on to the ranges beside them. Rows of a
very frequent block or prediction get its mean or donor by broadcast.

Defined results: NULL, NaN and impossible values are missing; rows without a
group number are left alone; a missing cell whose group has no value stays
missing; equally near donors: the lower prediction, then the smaller id; an
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotweave.functions.text import block_number, real
from plotweave.operators.skew import hot_keys, join_spread
from plotweave.session import cut, stored

#: The two occupant methods of the reference.
METHODS = ("nsi_max_2am_2pm_emp_students", "num_units_x_census_household_size")
#: A block of more rows than this, and than its share, is sorted in ranges; at
#: most ``SHARE`` blocks can hold so much, which bounds the table of the ranges.
HOT_ROWS, SHARE, PIECES = 20_000, 500, 256
#: Means of so many blocks (under 10 MB) are broadcast; more are joined by block.
FEW_BLOCKS = 150_000
#: One row in so many fixes the ranges (they affect balance only).
SAMPLE = 8
#: Rows the group's own mean has to outweigh the overall mean.
SHRINK = 5.0


@dataclass(frozen=True)
class Target:
    """``usable``: the cell holds a value; ``score``: that value as a number."""

    name: str
    usable: Column
    score: Column


def structure_targets() -> tuple[Target, ...]:
    stories, count, method = real(F.col("NumStories")), real(F.col("OccupantCount")), F.col("OccupantCountMethod")
    named = F.coalesce(method.isin(*METHODS), F.lit(False))
    return (
        Target("NumStories", F.coalesce(stories.between(1, 200), F.lit(False)), stories),
        Target("OccupantCount", F.coalesce(count.between(0, 50_000) & ((count != 0) | named), F.lit(False)), F.log1p(F.greatest(count, F.lit(0.0)))),
        Target("OccupantCountMethod", named, (method == METHODS[0]).cast("double")),
    )


def predictors() -> list[Column]:
    """Log footprint, log height and log units, each with its own gap flag."""
    out: list[Column] = []
    for c, top in (("FootprintArea_m2", 1e6), ("HeightM", 500.0), ("NumUnits", 1e5)):
        v = real(F.col(c))
        v = F.when((v > 0) & (v <= top), F.log(v))
        out += [F.coalesce(v, F.lit(0.0)), v.isNull().cast("double")]
    return out


def _solve(row, k: int, ridge: float = 1e-3) -> np.ndarray:
    """Coefficients from the upper triangle of X'X and X'y."""
    xx = np.zeros((k, k))
    at = 0
    for i in range(k):
        for j in range(i, k):
            xx[i, j] = xx[j, i] = row[at] or 0.0
            at += 1
    xy = np.array([row[at + i] or 0.0 for i in range(k)])
    return np.linalg.solve(xx + ridge * (np.trace(xx) / k + 1) * np.eye(k), xy)


def filled_cells(structures: DataFrame) -> DataFrame:
    """record_id, field, value (text), donor_record_id, distance of every cell
    that could be filled; ``was_filled`` marks it."""
    targets = structure_targets()
    xs = predictors()
    k = len(xs) + 2
    rows = stored(structures.select(
        "record_id", block_number(F.col("CBFIPS")).alias("block"),
        *[x.alias(f"x{i}") for i, x in enumerate(xs)],
        *[c for t in targets for c in (
            F.when(t.usable, F.col(t.name).cast("string")).alias(f"v_{t.name}"), F.when(t.usable, t.score).alias(f"y_{t.name}"))],
    ).where("block is not null"), "rows")
    # group means: one small row per block, shrunken to the overall mean
    sums = cut(rows.groupBy("block").agg(F.count(F.lit(1)).alias("rows"), *[
        f(f"y_{t.name}").alias(f"{p}_{t.name}") for t in targets for p, f in (("s", F.sum), ("n", F.count))]))
    overall = sums.agg(F.count(F.lit(1)).alias("blocks"), F.max("rows").alias("most"), F.sum("rows").alias("rows"), *[
        (F.sum(f"s_{t.name}") / F.greatest(F.sum(f"n_{t.name}"), F.lit(1))).alias(t.name) for t in targets]).first()
    means = sums.select("block", "rows", *[
        ((F.coalesce(f"s_{t.name}", F.lit(0.0)) + SHRINK * (overall[t.name] or 0.0)) / (F.col(f"n_{t.name}") + SHRINK)).alias(f"g_{t.name}")
        for t in targets
    ])
    if overall["blocks"] <= FEW_BLOCKS:
        full = rows.join(F.broadcast(means), "block")
    else:
        full = join_spread(rows, means, "block", hot_keys(sums, "block", "rows"))
    # one pass for the cross products of all targets
    products: list[Column] = []
    for t in targets:
        x = [F.lit(1.0), F.col(f"g_{t.name}"), *[F.col(f"x{i}") for i in range(len(xs))]]
        y = F.col(f"y_{t.name}")
        products += [F.sum(F.when(y.isNotNull(), x[i] * x[j])) for i in range(k) for j in range(i, k)]
        products += [F.sum(x[i] * y) for i in range(k)]
    size = k * (k + 1) // 2 + k
    got = full.agg(*[p.alias(f"p{i}") for i, p in enumerate(products)]).first()
    cells = []
    for i, t in enumerate(targets):
        part = got[i * size : (i + 1) * size]
        beta = _solve(part, k)
        x = [F.lit(1.0), F.col(f"g_{t.name}"), *[F.col(f"x{j}") for j in range(len(xs))]]
        guess = sum((F.lit(float(b)) * c for b, c in zip(beta[1:], x[1:])), F.lit(float(beta[0])))
        cells.append(F.struct(F.lit(t.name).alias("field"), F.col(f"v_{t.name}").alias("value"), guess.alias("guess")))

    def long(df: DataFrame) -> DataFrame:
        return df.select("record_id", "block", F.inline(F.array(*cells))).select("record_id", F.struct("block", "field").alias("group"), "value", "guess")

    every = long(full)
    donor = F.when(F.col("value").isNotNull(), F.struct("record_id", "value"))
    asked = F.count(F.when(F.col("value").isNull(), 1))
    guesses = stored(every.groupBy("group", "guess").agg(F.min(donor).alias("d"), (asked > 0).alias("asked"), asked.alias("n")), "guesses")
    hot = max(HOT_ROWS, (overall["rows"] or 0) // SHARE)
    ranges = None
    if (overall["most"] or 0) > hot:
        few = long(full.where((F.col("rows") > hot) & (F.pmod(F.xxhash64("record_id"), F.lit(SAMPLE)) == 0)))
        ranges = cut(few.groupBy("group").agg(F.percentile_approx("guess", [i / PIECES for i in range(1, PIECES)], 2000).alias("ends")))
    near = nearest_donors(guesses, ranges)
    gaps = every.where("value is null").select("record_id", "group", "guess")
    found = join_spread(gaps, near, ["group", "guess"], hot_keys(guesses, ["group", "guess"]))
    return found.select(
        "record_id", F.col("group.field").alias("field"), F.col("m.d.value").alias("value"), F.col("m.d.record_id").alias("donor_record_id"),
        F.abs(F.col("m.guess") - F.col("guess")).alias("distance"), F.lit(True).alias("was_filled"),
    )


def nearest_donors(guesses: DataFrame, ranges: DataFrame | None) -> DataFrame:
    """group, guess, m (guess and d of the nearest donor) of every asked guess
    whose group has a donor; ``ranges``: where hot groups are split."""
    if ranges is None:
        guesses = guesses.withColumn("piece", F.lit(-1))
    else:
        ends = F.when(F.col("ends").isNotNull(), F.size(F.filter("ends", lambda e: e <= F.col("guess")))).otherwise(-1)
        guesses = guesses.join(F.broadcast(ranges), "group", "left").withColumn("piece", ends).drop("ends")  # at most 3 * SHARE groups
    own = F.when(F.col("d").isNotNull(), F.struct("guess", "d"))
    piece, so_far = Window.partitionBy("group", "piece"), (Window.unboundedPreceding, Window.currentRow)
    out = guesses.withColumn("below", F.last(own, True).over(piece.orderBy("guess").rowsBetween(*so_far)))
    out = out.withColumn("above", F.last(own, True).over(piece.orderBy(F.desc("guess")).rowsBetween(*so_far))).where("asked")
    if ranges is not None:
        edges = guesses.where("piece >= 0").groupBy("group", "piece").agg(F.min(own).alias("first"), F.max(own).alias("last"))
        pieces, before = Window.partitionBy("group"), (Window.unboundedPreceding, -1)
        edges = edges.select("group", "piece", F.last("last", True).over(pieces.orderBy("piece").rowsBetween(*before)).alias("lower"),
                             F.last("first", True).over(pieces.orderBy(F.desc("piece")).rowsBetween(*before)).alias("upper"))
        out = out.join(edges, ["group", "piece"], "left").withColumns({"below": F.coalesce("below", "lower"), "above": F.coalesce("above", "upper")})
    nearer = F.col("above").isNull() | (F.col("guess") - F.col("below.guess") <= F.col("above.guess") - F.col("guess"))
    m = F.when(F.col("below").isNull() | ~nearer, F.col("above")).otherwise(F.col("below"))
    return out.select("group", "guess", m.alias("m")).where("m is not null")


def filled_table(structures: DataFrame) -> DataFrame:
    """The structures with filled cells in place and ``<field>_filled_from``."""
    cells = filled_cells(structures)
    wide = cells.groupBy("record_id").agg(*[
        F.max(F.when(F.col("field") == t.name, F.col(c))).alias(f"{p}_{t.name}")
        for t in structure_targets() for p, c in (("v", "value"), ("d", "donor_record_id"))
    ])
    out = structures.select("record_id", *[t.name for t in structure_targets()]).join(wide, "record_id", "left")
    return out.select("record_id", *[
        c for t in structure_targets() for c in (
            F.coalesce(F.col(f"v_{t.name}").cast(structures.schema[t.name].dataType), F.col(t.name)).alias(t.name),
            F.col(f"d_{t.name}").alias(f"{t.name}_filled_from"))
    ])
