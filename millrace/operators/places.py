"""Nearest row by great-circle distance.

Places are points of the unit sphere in space, so that there are no poles and no date line, and straight-line (chord) length orders them as the great circle does.
The right side becomes a tree of cubes: a cube with more than ``most`` places is split, down to cubes that hold few. The search goes down the tree level by level with
all left places at once. A cube stays a candidate as long as its nearest possible point is not farther than some right place that is known by then; the rings of cubes
around a left place so narrow from level to level, also where the right side is sparse or far away. Only the few places of the last cubes are measured.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators.keyed import attach_spread
from millrace.sources.session import cut_lineage

#: Levels are taken two at a time: a cube has at most 64 children, of which a sphere cuts about 16.
STEP = 2
#: Edges of 2**-39 are a hundredth of a millimetre of the Earth: such a cube is not split, whatever it holds.
DEEPEST = 40
#: Chord length (6 mm) by which a cube may be farther and still hold a place whose rounded distance ties.
MARGIN = 1e-9
AXES = ("x", "y", "z")


def on_sphere(lat: Column, lon: Column) -> dict[str, Column]:
    across = F.cos(F.radians(lat))
    return {"x": across * F.cos(F.radians(lon)), "y": across * F.sin(F.radians(lon)), "z": F.sin(F.radians(lat))}


def cube(level: int) -> Column:
    """The cube of the row's point: edges of 2 / 2**level."""
    return F.struct(F.lit(level).alias("level"), *[F.floor((F.col(a) + 1) * float(2 ** (level - 1))).cast("long").alias(a) for a in AXES])


def least_square(cell: Column) -> Column:
    """Square of the chord from the row's point to the nearest point of a cube."""
    edge = F.pow(F.lit(2.0), 1 - cell["level"])
    return sum((F.pow(F.greatest(cell[a] * edge - 1 - F.col(a), F.col(a) - (cell[a] + 1) * edge + 1, F.lit(0.0)), 2) for a in AXES), F.lit(0.0))


def square_to(point: Column) -> Column:
    return sum((F.pow(point[a] - F.col(a), 2) for a in AXES), F.lit(0.0))


def positioned(df: DataFrame, at: tuple[str, str], lat: str, lon: str) -> DataFrame:
    """Rows with a position (a latitude within 90 degrees, a finite longitude), which is copied to two new columns; a pole has one longitude."""
    latitude, longitude = (F.col(x).cast("double") for x in at)
    rows = df.withColumns({lat: latitude, lon: F.when(F.abs(latitude) == 90, 0.0).otherwise(longitude)})
    return rows.where(F.abs(lat).between(0, 90) & (F.abs(lon) < float("inf")))


def part_of(*cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(64))


def cube_tree(places: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """The cubes of each level (``cell``, ``parent``, ``leaf``, and ``some``, one of its places), and the places with their leaf cube."""
    levels, settled, open_places = [], [], places
    for level in range(STEP, DEEPEST + 1, STEP):
        here = open_places.withColumn("cell", cube(level))
        sized = here.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*AXES)).alias("some"))
        up = F.struct(F.lit(level - STEP).alias("level"), *[F.shiftright(F.col("cell")[a], STEP).alias(a) for a in AXES])
        cells = cut_lineage(sized.select("cell", up.alias("parent"), "some", (F.col("n") <= most if level < DEEPEST else F.lit(True)).alias("leaf")), "cubes")
        levels.append(cells)
        if cells.where("not leaf").isEmpty():
            settled.append(here)
            break
        marked = cut_lineage(attach_spread(here.withColumn("part", part_of(*AXES)), cells.select("cell", "leaf"), ["cell"]), "places")
        settled.append(marked.where("leaf").select(*places.columns, "cell"))
        open_places = marked.where("not leaf").select(*places.columns)
    return levels, reduce(DataFrame.union, [x.select(*places.columns, "cell") for x in settled])


def nearest_by_distance(
    left: DataFrame, k: list[str], left_at: tuple[str, str], right: DataFrame, right_id: str, right_at: tuple[str, str], unit: str = "mi", most: int = 32
) -> DataFrame:
    """For every left row the great-circle distance (rounded to six places) of the nearest right row, and its id; the smaller id wins ties.

    Rows without a position have no nearest row; where no right row has one, nobody has.
    """
    known = positioned(left, left_at, "_lat", "_lon")
    seats = known.select(F.col("_lat").alias("lat"), F.col("_lon").alias("lon")).distinct()
    targets = positioned(right, right_at, "r_lat", "r_lon").select("r_lat", "r_lon", F.col(right_id).alias("r_id")).where("r_id is not null")
    targets = targets.groupBy("r_lat", "r_lon").agg(F.min("r_id").alias("r_id")).withColumns(on_sphere(F.col("r_lat"), F.col("r_lon")))
    levels, placed = cube_tree(cut_lineage(targets, "targets"), most)

    # The cubes of the first level are at most 64: one value, from which every left place starts.
    root = levels[0].agg(F.collect_list(F.struct("cell", "leaf", "some")).alias("cells")).scalar()
    found = seats.withColumns(on_sphere(F.col("lat"), F.col("lon"))).withColumns({"cells": root, "part": part_of("lat", "lon")})
    found = cut_lineage(narrowed(found, F.lit(float("inf"))), "search")
    for cells in levels[1:]:
        children = cells.groupBy("parent").agg(F.collect_list(F.struct("cell", "leaf", "some")).alias("children"))
        wide = found.select("lat", "lon", "part", F.explode(F.filter("cells", lambda c: ~c["leaf"])).alias("c")).select("lat", "lon", "part", F.col("c.cell").alias("parent"))
        inner = attach_spread(wide, children, ["parent"]).groupBy("lat", "lon").agg(F.flatten(F.collect_list("children")).alias("inner"))
        both = found.join(inner, ["lat", "lon"], "left")
        kept = F.concat(F.filter("cells", lambda c: c["leaf"]), F.coalesce("inner", F.array().cast(inner.schema["inner"].dataType)))
        found = cut_lineage(narrowed(both.withColumn("cells", kept).drop("inner"), F.col("reach")), "search")

    distance = F.round(C.haversine(F.col("lat"), F.col("lon"), F.col("r_lat"), F.col("r_lon"), unit), 6)
    last = found.select("lat", "lon", "part", F.explode("cells.cell").alias("cell"))
    held = placed.groupBy("cell").agg(F.collect_list(F.struct("r_lat", "r_lon", "r_id")).alias("held"))
    measured = attach_spread(last, held, ["cell"]).select("lat", "lon", F.inline("held")).select("lat", "lon", F.struct(distance.alias("distance"), "r_id").alias("d"))
    best = measured.groupBy("lat", "lon").agg(F.min("d").alias("d")).select(F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), "d.*")
    rows = known.withColumn("part", part_of(*k))
    return attach_spread(rows, best, ["_lat", "_lon"]).select(*k, "distance", F.col("r_id").alias(right_id))


def narrowed(found: DataFrame, reach: Column) -> DataFrame:
    """Candidate cubes without those that are farther than a place that is known; ``reach`` is the square of the chord to it."""
    nearest = F.array_min(F.transform("cells", lambda c: square_to(c["some"])))
    found = found.withColumn("reach", F.least(reach, nearest))
    near = F.filter("cells", lambda c: F.sqrt(least_square(c["cell"])) <= F.sqrt("reach") + MARGIN)
    return found.withColumn("cells", near)
