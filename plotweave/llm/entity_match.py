"""Matching the same buildings of two footprint sources that share no key.

A deterministic cascade: each rule is an exact join on a combination of
attributes, from strong to weak, over the records no earlier rule has resolved
(the residue is carried forward by an anti-join after each pass). Location enters
as a grid cell; each record of the second source is keyed by the cells its
tolerance square touches. A rule accepts a pair when the two are each other's
nearest among the rule's candidates and their areas agree. Confidence is the
rule's precision, smoothed by Laplace's rule, on labelled pairs if there are any,
else on silver labels (agreement of an identifier the rule did not use).

One source may be shifted as a whole from the other, differently by region.
Before the cascade each region's shift is found as the peak of the histogram of
displacements between the sources (half-metre bins are joined, not records, and
a pair of bins has one vote, so a heap of records in one place can't sway it).

Records of one side that agree in position (25 cm) and area (5 %), or without
location in the rule's key and area, can't be told apart: a heap. Its members are
numbered, and the number is part of every rule's key, so two heaps meet member by
member and never as all pairs. Members that a parcel or an address does tell apart
are matched by it first, numbered among those that share it too. What is left of
heaps after the rules on location is numbered anew and joined once more.

Defined results: ids that are NULL or blank take no part; an id's attributes are
merged over its rows (extremes of the non-NULL values); ids without usable
geometry are matched by address or parcel and area only; each id occurs in at
most one pair; ties go to the smaller id; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotweave.functions import wkb
from plotweave.functions.text import block_number, real, strip_ws
from plotweave.operators.skew import ranked
from plotweave.session import stored

#: Metres of a degree of latitude.
DEGREE_M = 111_195.08
#: Farthest a twin may lie after the shift.
REACH_M = 3.0
#: Largest regional shift looked for, its bins, the region in degrees, and the
#: least votes of a peak.
SHIFT_M, BIN_M, REGION_DEG, LEAST_VOTES = 12.0, 0.5, 0.25, 5
#: Area of the right over the left record.
RATIO = (0.7, 1.45)

# Long forms of street kinds.
STREETS = {"street": "st", "avenue": "ave", "lane": "ln", "drive": "dr", "road": "rd", "court": "ct", "boulevard": "blvd", "place": "pl"}


def address_key(c: Column) -> Column:
    """``number street kind`` without town, case and punctuation, whichever side
    the number stands on; NULL without a number or name."""
    t = F.lower(F.split_part(F.coalesce(c, F.lit("")), F.lit(","), F.lit(1)))
    number = F.regexp_extract(t, r"\b([0-9]+[a-z]?)\b", 1)
    name = F.split(F.trim(F.regexp_replace(t, r"\b[0-9]+[a-z]?\b|[^\p{L}]+", " ")), " +")
    kinds = F.create_map(*[F.lit(x) for kv in STREETS.items() for x in kv])
    last = F.element_at(name, -1)
    name = F.concat(F.slice(name, 1, F.size(name) - 1), F.array(F.coalesce(F.try_element_at(kinds, last), last)))
    return F.when((number != "") & (last != ""), F.concat_ws(" ", number, F.array_join(name, " ")))


def code_key(c: Column) -> Column:
    return F.nullif(F.upper(F.regexp_replace(c, r"[^0-9A-Za-z]", "")), F.lit(""))


def centres(blobs: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centroid and area in square metres of each geometry (NaN: none). Rings
    are signed by nesting: an outer ring counts plus, a hole minus."""
    r = wkb.read(blobs).unwrapped()
    n = r.n_geoms
    out = np.full((3, n), np.nan)
    if not len(r.xy):
        return out[0], out[1], out[2]
    base = r.xy[r.start[:-1]]  # near the ring, for precision
    of = np.repeat(np.arange(len(r.geom)), np.diff(r.start))
    first = r.xy[r.start[np.searchsorted(r.geom, r.geom)]]
    x, y = (r.xy - first[of]).T
    nx, ny = np.roll(x, -1), np.roll(y, -1)
    end = r.start[1:] - 1
    nx[end], ny[end] = x[r.start[:-1]], y[r.start[:-1]]
    cross = x * ny - nx * y
    area = np.add.reduceat(cross, r.start[:-1]) / 2
    mx = np.add.reduceat((x + nx) * cross, r.start[:-1]) / 6
    my = np.add.reduceat((y + ny) * cross, r.start[:-1]) / 6
    # writers wind holes against their outer ring; the first ring is an outer one
    lead = np.sign(area[np.searchsorted(r.geom, r.geom)])
    lead[lead == 0] = 1
    a = np.bincount(r.geom, area * lead, n)
    with np.errstate(all="ignore"):
        cx = np.bincount(r.geom, mx * lead, n) / a
        cy = np.bincount(r.geom, my * lead, n) / a
    has = np.flatnonzero(np.bincount(r.geom, minlength=n))
    at = base[np.searchsorted(r.geom, has)]
    lon, lat = cx[has] + at[:, 0], cy[has] + at[:, 1]
    ok = np.isfinite(lon) & np.isfinite(lat) & (np.abs(lat) <= 90)
    out[0, has[ok]] = (lon[ok] + 540) % 360 - 180
    out[1, has[ok]] = lat[ok]
    out[2, has[ok]] = (np.abs(a[has]) * np.cos(np.radians(lat)) * DEGREE_M**2)[ok]
    return out[0], out[1], out[2]


def sides(structures: DataFrame) -> DataFrame:
    """One row per source (``kind`` 0 and 1) and id: address, parcel, block and
    state (as 64-bit keys; rules that use them check areas too), area, lon, lat.
    Footprints are reduced to their centre before any row moves."""
    ids = F.filter(F.array(*[F.struct(F.lit(k).alias("kind"), F.nullif(strip_ws(F.col(c)), F.lit("")).alias("id")) for k, c in enumerate(("OvertureID", "MicrosoftID"))]), lambda x: x["id"].isNotNull())
    rows = structures.select(
        F.inline(ids), "geometry",
        address_key(F.col("ParcelAddress")).alias("address"), code_key(F.col("ParcelID")).alias("parcel"),
        block_number(F.col("CBFIPS")).alias("block"), F.xxhash64(F.lower(strip_ws(F.col("State")))).alias("state"), F.col("State").isNotNull().alias("stated"),
        F.when(real(F.col("FootprintArea_m2")) > 0, F.col("FootprintArea_m2")).alias("area"),
    )
    schema = "kind int, id string, address string, parcel string, block long, state long, stated boolean, area double, lon double, lat double"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lon, lat, area = (pa.array(c, mask=np.isnan(c)) for c in centres(batch.column("geometry").to_pylist()))
            known = {"lon": lon, "lat": lat, "area": pc.coalesce(batch.column("area"), area)}
            yield pa.RecordBatch.from_arrays([known[c] if c in known else batch.column(c) for c in names], names)

    rows = rows.mapInArrow(run, schema)
    # the longest address: typing errors mostly lose letters
    one = rows.groupBy("kind", "id").agg(
        F.max(F.when(F.col("address").isNotNull(), F.struct(F.length("address").alias("n"), F.col("address").alias("v")))).alias("a"),
        F.max(F.when(F.col("lon").isNotNull(), F.struct("lon", "lat"))).alias("at"), F.max(F.when(F.col("stated"), F.col("state"))).alias("state"),
        *[F.max(c).alias(c) for c in ("parcel", "block", "area")],
    )

    def key(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(c.split(".")[-1])

    return stored(one.select("kind", "id", key("a.v").alias("address"), key("parcel"), "block", "state", "area", "at.lon", "at.lat"), "sides")


def _turned(lon: Column) -> Column:
    return F.pmod(lon + 540, F.lit(360.0)) - 180


def _grid(lon: Column, lat: Column, size: float) -> Column:
    """Cell of about ``size`` metres; the width follows the latitude's band."""
    band = F.floor(lat * 4)
    wide = F.cos(F.radians((band + 0.5) / 4))
    return F.struct(
        band.cast("int").alias("b"), F.floor(_turned(lon) * wide * (DEGREE_M / size)).cast("long").alias("x"), F.floor(lat * (DEGREE_M / size)).cast("long").alias("y")
    )


def _touched(lon: Column, lat: Column, reach: float, size: float) -> Column:
    """The cells of the corners of a square; two reaches fit into one cell."""
    dy = reach / DEGREE_M
    dx = F.lit(dy) / F.cos(F.radians(lat))
    return F.array_distinct(F.array(*[_grid(lon + sx * dx, lat + sy * dy, size) for sx in (-1, 1) for sy in (-1, 1)]))


def _region(lon: Column, lat: Column) -> Column:
    return F.struct(F.floor(lon / REGION_DEG).cast("int").alias("rx"), F.floor(lat / REGION_DEG).cast("int").alias("ry"))


def shifts(left: DataFrame, right: DataFrame) -> DataFrame:
    """region, dx, dy: metres by which the right source lies east and north of
    the left one, where the displacement histogram has a clear peak."""
    size = 2 * SHIFT_M + 1

    def bins(df: DataFrame) -> DataFrame:
        band = F.floor(F.col("lat") * 4)
        wide = F.cos(F.radians((band + 0.5) / 4))
        return df.where("lon is not null and area is not null").select(
            "lon", "lat", F.floor(F.col("lon") * wide * (DEGREE_M / BIN_M)).cast("long").alias("bx"), F.floor(F.col("lat") * (DEGREE_M / BIN_M)).cast("long").alias("by"),
            F.floor(F.log("area") / 0.3).cast("int").alias("size"), band.cast("int").alias("band"),
        ).groupBy("band", "bx", "by", "size").agg(F.min("lon").alias("lon"), F.min("lat").alias("lat"))

    def cell(c: Column) -> Column:
        return F.xxhash64(c, "size", "band")

    a = bins(left).select(F.col("bx").cast("int").alias("ax"), F.col("by").cast("int").alias("ay"), cell(_grid(F.col("lon"), F.col("lat"), size)).alias("cell"))
    cells = F.transform(_touched(F.col("lon"), F.col("lat"), SHIFT_M, size), cell)
    b = bins(right).select(F.col("bx").cast("int").alias("bx"), F.col("by").cast("int").alias("by"), _region(F.col("lon"), F.col("lat")).alias("region"), F.explode(cells).alias("cell"))
    most = int(SHIFT_M / BIN_M)
    votes = (
        b.join(a, "cell")
        .select("region", (F.col("bx") - F.col("ax")).alias("dx"), (F.col("by") - F.col("ay")).alias("dy"))
        .where(F.abs("dx").between(0, most) & F.abs("dy").between(0, most))
        .groupBy("region", "dx", "dy").agg(F.count(F.lit(1)).alias("n"))
    )
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    smooth = (
        votes.select("region", "dx", "dy", "n", around.alias("o"))
        .groupBy("region", (F.col("dx") + F.col("o.i")).alias("px"), (F.col("dy") + F.col("o.j")).alias("py"))
        .agg(F.sum("n").alias("votes"), F.sum(F.col("n") * F.col("dx")).alias("sx"), F.sum(F.col("n") * F.col("dy")).alias("sy"))
    )
    best = smooth.groupBy("region").agg(F.max(F.struct("votes", F.col("px"), F.col("py"), "sx", "sy")).alias("m")).where(F.col("m.votes") >= LEAST_VOTES)
    return best.select("region", (F.col("m.sx") / F.col("m.votes") * BIN_M).alias("dx"), (F.col("m.sy") / F.col("m.votes") * BIN_M).alias("dy"))


#: name, key columns, size of the cell in metres (None: no location), identifier
#: that labels it. Cells are wide where another key keeps candidates few.
RULES = (
    ("cell+address", ("address",), 48.0, "parcel"),
    ("cell+parcel", ("parcel",), 48.0, "block"),
    ("cell", (), 12.0, "block"),
    ("parcel+area", ("parcel", "state"), None, "address"),
    ("address+area", ("address", "state"), None, "block"),
)

#: The same for members of heaps and what lies beside them.
HEAP_RULES = (("cell+parcel+address", ("parcel", "address"), 48.0, "block"), RULES[1], RULES[0])


def area_bin() -> Column:
    return F.floor(F.log("area") * 20).cast("int")


def numbered(rows: DataFrame, alike: dict[str, Column]) -> DataFrame:
    """Adds ``nth``: the number of each row among those alike (heaps only; every
    other row is 1)."""
    keys = ["kind", *alike]
    rows = rows.drop("nth")
    heaps = stored(rows.select("kind", *[c.alias(k) for k, c in alike.items()]).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "heaps")
    if heaps.isEmpty():
        return rows.withColumn("nth", F.lit(1).cast("bigint"))
    members = rows.select("kind", "id", *[c.alias(k) for k, c in alike.items()]).join(heaps, keys)
    nth = stored(ranked(members, keys, "n", "id").select("kind", "id", "nth"), "nth")
    return rows.join(nth, ["kind", "id"], "left").withColumn("nth", F.coalesce("nth", F.lit(1).cast("bigint")))


def in_place() -> dict[str, Column]:
    """What records of one place have in common; NULLs keep the rest apart."""
    return {"_y": F.floor(F.col("lat") * (4 * DEGREE_M)), "_x": F.floor(F.col("lon") * F.cos(F.radians(F.floor("lat") + 0.5)) * (4 * DEGREE_M)), "_a": area_bin()}


def beside_heaps(rows: DataFrame, size: float = 48.0) -> DataFrame:
    """The members of heaps and the rows within reach of one."""
    at = rows.where("nth > 1 and lon is not null").select(F.explode(_touched(F.col("lon"), F.col("lat"), REACH_M, size)).alias("_cell")).distinct()
    return rows.where("lon is not null").withColumn("_cell", _grid(F.col("lon"), F.col("lat"), size)).join(at, "_cell", "left_semi").drop("_cell")


def candidates(rows: DataFrame, keys: tuple[str, ...], size: float | None, label: str) -> DataFrame:
    """left_id, right_id, away, label of the pairs that share the keys and agree
    in area (and place)."""
    has = " and ".join([f"{k} is not null" for k in keys] + ["area is not null"] + (["lon is not null"] if size else []))
    rows = rows.where(has).select("kind", "id", "lon", "lat", "area", F.col(label).alias("label"), *[F.col(k).alias(f"_{k}") for k in keys], "nth")
    shared = [F.col(f"_{k}") for k in keys] + [F.col("nth")]

    def side(kind: int, p: str, key: Column, df: DataFrame = rows) -> DataFrame:
        return df.where(F.col("kind") == kind).select(key.alias("key"), *[F.col(c).alias(f"{p}_{c}") for c in ("id", "lon", "lat", "area", "label")])

    if size:
        cells = F.explode(F.transform(_touched(F.col("lon"), F.col("lat"), REACH_M, size), lambda c: F.xxhash64(c, *shared)))
        pairs = side(0, "a", F.xxhash64(_grid(F.col("lon"), F.col("lat"), size), *shared)).join(side(1, "b", cells), "key")
    else:  # only where a location can't decide: one of the two has none
        key, lost, at = F.xxhash64(*shared), rows.where("lon is null"), rows.where("lon is not null")
        pairs = side(0, "a", key, lost).join(side(1, "b", key), "key").unionByName(side(0, "a", key, at).join(side(1, "b", key, lost), "key"))
    ratio = F.col("b_area") / F.col("a_area")
    pairs = pairs.where(ratio.between(*RATIO))
    if size:
        east = (F.pmod(F.col("b_lon") - F.col("a_lon") + 540, F.lit(360.0)) - 180) * F.cos(F.radians("a_lat")) * DEGREE_M
        away = F.hypot(east, (F.col("b_lat") - F.col("a_lat")) * DEGREE_M)
    else:
        away = F.abs(F.log(ratio))
    pairs = pairs.select(F.col("a_id").alias("left_id"), F.col("b_id").alias("right_id"), away.alias("away"), (F.col("a_label") == F.col("b_label")).alias("label"))
    return pairs.where(F.col("away") <= REACH_M) if size else pairs


def mutual(pairs: DataFrame) -> DataFrame:
    """The pairs whose two are each other's nearest."""
    to_left = pairs.groupBy("left_id").agg(F.min(F.struct("away", "right_id", "label")).alias("m")).select("left_id", "m.right_id", "m.label")
    to_right = pairs.groupBy("right_id").agg(F.min(F.struct("away", "left_id")).alias("m")).select("right_id", F.col("m.left_id").alias("left_id"))
    return to_left.join(to_right, ["left_id", "right_id"])


def without(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows no pair has resolved yet."""
    ids = F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("id")) for k, c in enumerate(("left_id", "right_id"))]))
    return rows.join(found.select(ids), ["kind", "id"], "left_anti")


def matches(structures: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """overtureid, microsoftid, rule, confidence of every matched pair.
    ``labelled``: overtureid, microsoftid, same (boolean) of known pairs; rules
    they reach take their precision from them."""
    rows = sides(structures)
    # the globe has 1,036,800 regions of a quarter degree, so this table is bounded
    shift = F.broadcast(stored(shifts(rows.where("kind = 0"), rows.where("kind = 1")), "shifts"))
    rows = numbered(rows, in_place())
    moved = rows.withColumn("region", F.when(F.col("kind") == 1, _region(F.col("lon"), F.col("lat")))).join(shift, "region", "left")
    dx, dy = F.coalesce("dx", F.lit(0.0)), F.coalesce("dy", F.lit(0.0))
    rows = moved.withColumns({
        "lon": _turned(F.col("lon") - dx / (F.cos(F.radians("lat")) * DEGREE_M)), "lat": F.col("lat") - dy / DEGREE_M,
    }).drop("region", "dx", "dy")
    done: list[DataFrame] = []

    def resolve(part: DataFrame, rule: tuple) -> DataFrame:
        """The pairs of a rule."""
        name, keys, size, label = rule
        done.append(stored(mutual(candidates(part, keys, size, label)).withColumn("rule", F.lit(name)), "found"))
        return done[-1]

    if not rows.where("nth > 1").isEmpty():
        heaps = stored(beside_heaps(rows), "beside")
        for rule in HEAP_RULES:
            part = numbered(heaps, in_place() | {k: F.col(k) for k in rule[1]})
            heaps = stored(without(heaps, resolve(part, rule)), "beside")
        rows = numbered(stored(without(rows, reduce(DataFrame.unionByName, done)), "residue"), in_place())
    for rule in RULES[:3]:
        rows = stored(without(rows, resolve(rows, rule)), "residue")
    if not rows.where("nth > 1").isEmpty():
        rows = numbered(rows, in_place())
        rows = stored(without(rows, resolve(rows, RULES[2])), "residue")
    for rule in RULES[3:]:
        keys = list(rule[1])
        # only keys that some record without location has
        lost = rows.where("lon is null and area is not null").select(*keys).dropna().distinct()
        part = rows.where("area is not null").join(lost, keys, "left_semi")
        part = numbered(stored(part, "part"), {**{k: F.col(k) for k in keys}, "_a": area_bin(), "_l": F.col("lon").isNull()})
        rows = without(rows, resolve(part, rule))
    pairs = reduce(DataFrame.unionByName, done)
    trust = pairs.groupBy("rule").agg(((F.count(F.when(F.col("label"), 1)) + 1) / (F.count("label") + 2)).alias("confidence"))
    if labelled is not None:
        known = labelled.select(F.col("overtureid").alias("left_id"), F.col("microsoftid").alias("right_id"), "same").where("same is not null")
        told = pairs.join(known, ["left_id", "right_id"]).groupBy("rule").agg(((F.count(F.when(F.col("same"), 1)) + 1) / (F.count("same") + 2)).alias("told"))
        trust = trust.join(told, "rule", "left").select("rule", F.coalesce("told", "confidence").alias("confidence"))
    return pairs.join(F.broadcast(trust), "rule").select(  # a row per rule
        F.col("left_id").alias("overtureid"), F.col("right_id").alias("microsoftid"), "rule", F.round("confidence", 6).alias("confidence"))


assert all(size is None or size >= 2 * REACH_M for _, _, size, _ in RULES)
