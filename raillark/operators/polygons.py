"""Points in polygons by a cover of grid cells.

Each ring is cut to cells once.  A border cell carries the few edges that touch it and
whether its lower right corner lies in the ring; a cell wholly inside carries no
edges.  A point in a border cell is in the ring if the corner is, changed by each edge
that crosses the path from the point to the right side of the cell and down to
the corner, a path that only edges of the cell can cross.  So a point meets its own
cell's edges, whatever the size of the ring, and no row carries a ring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from raillark.functions.expr import grid_cell

#: Points this near to an edge, in degrees, lie on it.
EDGE = 1e-10
#: A cell of more points is dealt to parts of about so many.
DEAL = 1 << 16
_RING = ["code", "polygon", "ring"]


def edges(boundaries: DataFrame) -> DataFrame:
    """code, polygon, ring (0: the outer one, others are holes), x1, y1, x2, y2 of every edge; the last point joins the first."""
    rings = boundaries.select("code", F.posexplode("polygons").alias("polygon", "_rings")).select("code", "polygon", F.posexplode("_rings").alias("ring", "_r"))
    ends = F.zip_with("_r", F.concat(F.slice("_r", 2, F.size("_r")), F.slice("_r", 1, 1)), lambda a, b: F.struct(a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")))
    return rings.where(F.size("_r") > 0).select(*_RING, F.explode(ends).alias("e")).select(*_RING, "e.*")


def cover(boundaries: DataFrame, size: float) -> DataFrame:
    """code, polygon, ring, _cx, _cy, corner_in, edges: every cell that a ring touches or holds; ``edges`` is null in cells wholly inside."""
    lines = edges(boundaries)
    slack = 10 * EDGE
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = lines.withColumn("_cy", F.explode(F.sequence(grid_cell(low - slack, size), grid_cell(high + slack, size))))
    # where the edge runs within the row; a level edge runs along it
    rise = F.when(F.col("y2") != F.col("y1"), F.col("y2") - F.col("y1"))
    at = lambda y: F.col("x1") + (y - F.col("y1")) / rise * (F.col("x2") - F.col("x1"))
    inside = lambda y: F.greatest(low, F.least(high, y))
    below, above = at(inside(F.col("_cy") * F.lit(size) - slack)), at(inside((F.col("_cy") + 1) * F.lit(size) + slack))
    tilted = high - low > slack
    left = F.when(tilted, F.least(below, above)).otherwise(F.least("x1", "x2"))
    right = F.when(tilted, F.greatest(below, above)).otherwise(F.greatest("x1", "x2"))
    touched = rows.withColumn("_cx", F.explode(F.sequence(grid_cell(left - 2 * slack, size), grid_cell(right + 2 * slack, size))))
    border = touched.groupBy(*_RING, "_cx", "_cy").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))

    # the lower side of each row of cells: where edges cross it, and so which corners lie inside
    crossed = lines.where("y1 <> y2").withColumn("_cy", F.explode(F.sequence(grid_cell(low, size), grid_cell(high, size) + 1)))
    y = F.col("_cy") * F.lit(size)
    crossed = crossed.where((F.col("y1") > y) != (F.col("y2") > y)).select(*_RING, "_cy", ((F.col("x2") - F.col("x1")) * (y - F.col("y1")) / rise + F.col("x1")).alias("x"))
    order = Window.partitionBy(*_RING, "_cy").orderBy("x")
    spans = crossed.select(*_RING, "_cy", "x", F.lead("x").over(order).alias("to"), F.row_number().over(order).alias("k")).where("k % 2 = 1 and to is not null")
    corner = (F.col("_cx") + 1) * F.lit(size)
    corners = spans.withColumn("_cx", F.explode(F.sequence(grid_cell("x", size) - 1, grid_cell("to", size)))).where((corner >= F.col("x")) & (corner < F.col("to"))).select(*_RING, "_cx", "_cy", F.lit(True).alias("corner_in"))
    return border.join(corners, [*_RING, "_cx", "_cy"], "full").withColumn("corner_in", F.coalesce("corner_in", F.lit(False)))


def ring_state(local: Column, corner_in: Column, x: Column, y: Column, lon: Column, lat: Column) -> Column:
    """0 outside, 1 inside, 2 on an edge, by the edges of the point's cell whose lower right corner is (x, y)."""

    def met(e: Column) -> Column:
        x1, y1, x2, y2 = e["x1"], e["y1"], e["x2"], e["y2"]
        cross = (lon - x1) * (y2 - y1) - (lat - y1) * (x2 - x1)
        on = (F.abs(cross) <= EDGE) & lon.between(F.least(x1, x2) - EDGE, F.greatest(x1, x2) + EDGE) & lat.between(F.least(y1, y2) - EDGE, F.greatest(y1, y2) + EDGE)
        level = (x2 - x1) * (lat - y1) / F.when(y2 == y1, F.lit(1.0)).otherwise(y2 - y1) + x1
        along = ((y1 > lat) != (y2 > lat)) & (lon < level) & (level <= x)
        upright = (y2 - y1) * (x - x1) / F.when(x2 == x1, F.lit(1.0)).otherwise(x2 - x1) + y1
        down = ((x1 > x) != (x2 > x)) & (upright > y) & (upright <= lat)
        return F.struct(on.alias("on"), (along != down).alias("crosses"))

    found = F.transform(local, met)
    odd = F.size(F.filter(found, lambda m: m["crosses"])) % 2 == 1
    return F.when(local.isNull(), 1).when(F.exists(found, lambda m: m["on"]), 2).otherwise((corner_in != odd).cast("int"))


def meet(placed: DataFrame, cells: DataFrame) -> DataFrame:
    """Points joined with the rows of their cell; a cell of many points is the work of many tasks.

    The cells are the side that is held, as they carry the edges and are few beside the points.
    """
    at = ["_cx", "_cy"]
    full = placed.groupBy(*at).agg(F.count("*").alias("_n")).where(F.col("_n") > DEAL)
    full = F.broadcast(full.select(*at, F.ceil(F.col("_n") / DEAL).alias("_parts")))  # a row for thousands of points
    dealt = placed.join(full, at, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64("point_id"), F.col("_parts")), F.lit(0))).drop("_parts")
    parts = cells.join(full, at, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return dealt.join(parts.hint("shuffle_hash"), [*at, "_part"]).drop("_part")


def points_in(points: DataFrame, boundaries: DataFrame, size: float, lat: str, lon: str) -> DataFrame:
    """point_id, code of every boundary that holds a point: in or on an outer ring and not inside one of its holes."""
    placed = points.select("point_id", F.col(lon).alias("_lon"), F.col(lat).alias("_lat"), grid_cell(lon, size).alias("_cx"), grid_cell(lat, size).alias("_cy"))
    met = meet(placed, cover(boundaries, size))
    state = ring_state(F.col("edges"), F.col("corner_in"), (F.col("_cx") + 1) * F.lit(size), F.col("_cy") * F.lit(size), F.col("_lon"), F.col("_lat"))
    held = met.select("point_id", "code", "polygon", "ring", state.alias("state")).groupBy("point_id", "code", "polygon")
    held = held.agg(F.max(F.when(F.col("ring") == 0, F.col("state") > 0)).alias("outer"), F.max(F.when(F.col("ring") > 0, F.col("state") == 1)).alias("hole"))
    return held.where(F.col("outer") & ~F.coalesce("hole", F.lit(False))).select("point_id", "code").distinct()
