"""Best representative of each group of duplicate records.

Records of one entity are unpivoted to long rows (entity, field, value), every
row casts a vote of source trust times recency decay for its normalised value,
the votes are summed per value, ``max_by`` takes each field's winner and the
winners are pivoted back to one record.

Two weightings share that plan:

* ``gentle_votes``: ``trust_base ** -rank * 2 ** (-age / half_life)``; several
  agreeing rows can outvote a better source.
* ``steep_votes``: ``base ** -(rank gap * R + age gap)`` against the best row of
  the entity's field, ages in microseconds, ids in place of ages where rank and
  time are equal. Gaps are whole numbers, and ``base`` exceeds the number of the
  entity's rows, so the best row's vote of 1 is more than all other values' votes
  together: the strict order p1_found asks for. The best row comes from one
  aggregation; it is joined to the records before they are unpivoted, and as
  everything after it is keyed by entity, nothing moves again.

Aggregations combine before the shuffle. Entities that hold more than
``HOT_ROWS`` rows and more than one row in ``HOT_SHARE`` (there can't be more
than ``HOT_SHARE`` of them) get their best row by broadcast, so their rows are
summed where they lie.

Defined results: NULL, NaN or unusable values cast no vote; NULL or unknown
labels rank last; a NULL time is the earliest; ties go to the smallest record
id; a field without a usable value is absent (NULL after the pivot); rows with
a blank entity key belong to nobody; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotweave.functions.text import entity_key, label_key, not_blank, real, strip_ws

_EPOCH = "1900-01-01 00:00:00"
#: Entities of more rows than both bounds are summed without moving their rows.
HOT_ROWS, HOT_SHARE = 20_000, 200
#: Microseconds a rank outweighs (570 years).
RANK_GAP = float(1 << 54)


@dataclass(frozen=True)
class FusedField:
    """``name`` of the case, ``value`` (text form), ``same`` (normalised form
    votes are summed by), ``usable``, ``label`` column and its trust order."""

    name: str
    value: Column
    same: Column
    usable: Column
    label: Column
    order: tuple[str, ...]

    def rank(self) -> Column:
        key = label_key(self.label)
        at = F.array_position(F.array(*[F.lit(x.replace("_", "")) for x in self.order]), key)
        return F.when(at > 0, at).otherwise(F.lit(len(self.order) + 1)).cast("int")


def structure_fields() -> tuple[FusedField, ...]:
    """The three fields of a structure, in the order of SURVEY D7, D8/D9, D3."""
    stories, units, raw = F.col("NumStories"), F.col("NumUnits"), F.col("StructureTypeRaw")
    return (
        FusedField("NumStories", stories.cast("string"), stories.cast("string"),
                   F.coalesce((real(stories) >= 1) & (real(stories) <= 200), F.lit(False)),
                   F.col("NumStoriesSource"), ("osm", "overture", "nsi", "height_estimate")),
        FusedField("NumUnits", units.cast("string"), units.cast("string"),
                   F.coalesce(real(units) >= 1, F.lit(False)),
                   F.col("NumUnitsSource"), ("osm", "nsi", "inferred_single_family")),
        FusedField("StructureTypeSource", raw, F.lower(F.regexp_replace(strip_ws(raw), r"\s+", " ")),
                   not_blank(raw), F.col("StructureTypeSource"),
                   ("osm", "overture_class", "overture_subtype", "nsi_occtype", "nsi_damage_category")),
    )


def keyed(df: DataFrame, key: Column) -> DataFrame:
    return df.withColumn("_entity", key).where(F.col("_entity").isNotNull())


def when(time: Column, dtype) -> Column:
    return F.coalesce(time, F.lit(_EPOCH).cast(dtype))


def long_rows(df: DataFrame, fields: Sequence[FusedField], vote, values: bool = True) -> DataFrame:
    """Unpivot: one row per record and field with its ``vote`` (a function of
    field and rank). Unusable values stay as rows without a vote, so record
    counts survive. ``values=False`` leaves the value's text behind."""
    seen = when(F.col("observed_at"), df.schema["observed_at"].dataType)

    def cell(f: FusedField) -> Column:
        best = [(-f.rank()).alias("trust"), F.col("observed_at").isNotNull().alias("dated"), seen.alias("seen"), (-F.col("record_id")).alias("neg_id")]
        if values:
            best += [f.value.alias("value"), f.label.alias("label")]
        return F.struct(
            F.lit(f.name).alias("field"), F.when(f.usable, f.same if values else F.xxhash64(f.same)).alias("same"),
            F.when(f.usable, vote(f, f.rank())).alias("vote"), F.when(f.usable, F.struct(*best)).alias("best"),
        )

    return df.select(F.col("_entity").alias("entity"), F.inline(F.array(*[cell(f) for f in fields])))


def gentle_votes(df: DataFrame, half_life_days: float, trust_base: float):
    if half_life_days < 90:
        raise ValueError("a half-life under 90 days makes votes of two centuries ago too small for a double")
    seen = when(F.col("observed_at"), df.schema["observed_at"].dataType)
    age = (F.unix_seconds(F.lit("2100-01-01 00:00:00").cast("timestamp")) - F.unix_seconds(seen.cast("timestamp"))) / 86400.0
    decay = F.pow(F.lit(2.0), -age / F.lit(half_life_days))
    return lambda f, rank: F.pow(F.lit(trust_base), -rank) * decay


def best_rows(df: DataFrame, fields: Sequence[FusedField]) -> DataFrame:
    """entity, number of rows, and of each field the best row's rank, time, id."""
    seen = _micros(df)
    return df.groupBy("_entity").agg(F.count(F.lit(1)).alias("_n"), *[
        F.max(F.when(f.usable, F.struct((-f.rank()).alias("trust"), F.col("observed_at").isNotNull().alias("dated"), seen.alias("seen"), (-F.col("record_id")).alias("neg_id")))).alias(f"_best_{f.name}")
        for f in fields
    ])


def _micros(df: DataFrame) -> Column:
    return F.unix_micros(when(F.col("observed_at"), df.schema["observed_at"].dataType).cast("timestamp"))


def steep_votes(df: DataFrame):
    """Votes against the columns of ``best_rows``; an undated row is a microsecond
    older than any other time it could be taken for."""
    seen = _micros(df)

    def vote(f: FusedField, rank: Column) -> Column:
        best = F.col(f"_best_{f.name}")
        age = (best["seen"] - seen + best["dated"].cast("int") - F.col("observed_at").isNotNull().cast("int")).cast("double")
        gap = (rank + best["trust"]) * F.lit(RANK_GAP) + age
        gap = F.when(gap == 0, (F.col("record_id") + best["neg_id"]).cast("double")).otherwise(gap)
        return F.pow(F.col("_n").cast("double") + 2.0, -gap)

    return vote


def winners(rows: DataFrame) -> DataFrame:
    """entity, field, best (row of the winning value), votes, rows_of_entity. Sums
    are compared on a rounded log scale: independent of the order of addition."""
    values = rows.groupBy("entity", "field", "same").agg(F.count(F.lit(1)).alias("n"), F.sum("vote").alias("votes"), F.max("best").alias("best"))
    # votes under the smallest number still rank above none
    score = F.when(F.col("best").isNotNull(), F.struct(F.round(F.log(F.greatest("votes", F.lit(1e-300))), 9), F.col("best")))
    won = values.groupBy("entity", "field").agg(F.sum("n").alias("rows_of_entity"), F.max_by(F.struct("best", "votes"), score).alias("won"))
    return won.where(F.col("won.best").isNotNull()).select("entity", "field", "won.best", "won.votes", "rows_of_entity")


def pivot_back(won: DataFrame, fields: Sequence[FusedField], values: bool = True) -> DataFrame:
    """One record per entity: ``<field>``, ``<field>_label``, ``<field>_from``."""
    def pick(name: str, c: Column) -> Column:
        return F.max(F.when(F.col("field") == name, c))

    out = [F.max("rows_of_entity").alias("n_rows")]
    for f in fields:
        if values:
            out += [pick(f.name, F.col("best.value")).alias(f.name), pick(f.name, F.col("best.label")).alias(f"{f.name}_label")]
        out.append(pick(f.name, -F.col("best.neg_id")).alias(f"{f.name}_from"))
    return won.groupBy("entity").agg(*out)


def best_cells(structures: DataFrame) -> DataFrame:
    """p1_found: the winning row of each field of each repeated structure."""
    fields = structure_fields()
    rows = keyed(structures, entity_key(F.col("StructureID")))
    counts = rows.groupBy("_entity").agg(F.count(F.lit(1)).alias("n"))
    hot = [r[0] for r in counts.where(F.col("n") > max(HOT_ROWS, structures.count() // HOT_SHARE)).select("_entity").collect()]  # at most HOT_SHARE
    out = None
    for part, small in ((rows.where(~F.col("_entity").isin(hot)), False), (rows.where(F.col("_entity").isin(hot)), True)) if hot else ((rows, False),):
        best = best_rows(part, fields)
        found = part.join(F.broadcast(best) if small else best.hint("merge"), "_entity")
        records = pivot_back(winners(long_rows(found.where("_n > 1"), fields, steep_votes(found), values=False)), fields, values=False)
        out = records if out is None else out.unionByName(records)
    cells = F.filter(F.array(*[F.struct(F.lit(f.name).alias("field"), F.col(f"{f.name}_from").alias("record_id")) for f in fields]), lambda c: c["record_id"].isNotNull())
    return out.select(F.col("entity").alias("structureid"), F.inline(cells))


def best_records(structures: DataFrame, half_life_days: float = 730.0, trust_base: float = 4.0) -> DataFrame:
    """p1_records: one voted record for every structure."""
    fields = structure_fields()
    rows = keyed(structures, entity_key(F.col("StructureID")))
    return pivot_back(winners(long_rows(rows, fields, gentle_votes(rows, half_life_days, trust_base))), fields).withColumnRenamed("entity", "structureid")
