"""Points near points, and points in regions."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.sources.tables import broadcast_checked, cut

EARTH_M = 6_371_000.0
#: Degrees of longitude and latitude by which cells reach over their borders, so that edges along
#: them are within; uneven, so that no edge through round numbers meets a corner.
EPS, EPS_LAT = 1e-9, 0.37e-9
#: Cell sizes in degrees of the coverage, coarse to fine. A cell that a border meets is split down to
#: BORDER_LEVEL, and further while more than MOST_EDGES edges meet it, to the last level.
LEVELS = (8.0, 2.0, 0.5, 0.125, 0.03125, 0.0078125)
BORDER_LEVEL, MOST_EDGES = 2, 24
#: Rows of a near-join cell beyond which it is salted.
HOT_ROWS = 2_000

# --- regions -----------------------------------------------------------------------

_RING = re.compile(r"\(([^()]+)\)")


def rings(wkt: str | None) -> list[list[tuple[float, float]]]:
    """All rings (outer ones and holes alike) of a POLYGON or MULTIPOLYGON text; [] for
    null, empty or unreadable texts. With the even-odd rule a hole needs no mark."""
    out = []
    for body in _RING.findall(wkt or ""):
        try:
            ring = [(float(x), float(y)) for x, y in (p.split()[:2] for p in body.split(","))]
        except ValueError:
            return []
        if len(ring) > 2:
            out.append(ring if ring[0] == ring[-1] else [*ring, ring[0]])
    return out


def _inside(x: float, y: float, edges: list) -> bool:
    hit = False
    for x1, y1, x2, y2 in edges:
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            hit = not hit
    return hit


def _touches(edge: tuple, x0: float, y0: float, x1: float, y1: float) -> bool:
    """Does the segment meet the box (Liang-Barsky)?"""
    ax, ay, bx, by = edge
    dx, dy, lo, hi = bx - ax, by - ay, 0.0, 1.0
    for p, q in ((-dx, ax - x0), (dx, x1 - ax), (-dy, ay - y0), (dy, y1 - ay)):
        if p == 0:
            if q < 0:
                return False
        elif p < 0:
            lo = max(lo, q / p)
        else:
            hi = min(hi, q / p)
    return lo <= hi


def cover(wkt: str | None, levels: tuple[float, ...] = LEVELS, border_level: int = BORDER_LEVEL, most_edges: int = MOST_EDGES) -> Iterator[tuple[int, int, int, bool, bool, list]]:
    """(level, ix, iy, interior, corner, edges) of the cells that cover a region.

    A cell that no edge meets is wholly in or out: in ones are accepted as interior at the
    coarsest level possible. A cell that an edge meets is split, as far as its edges are many;
    a boundary cell carries the edges that meet it, and whether its corner (the greatest
    longitude, the least latitude) is inside: a way from a point to that corner within the cell
    crosses no other edge, which is all the exact test needs.
    """
    edges = [(*a, *b) for ring in rings(wkt) for a, b in zip(ring, ring[1:]) if a != b]
    if not edges:
        return
    xs, ys = [e[0] for e in edges], [e[1] for e in edges]
    size = levels[0]
    stack = [(0, ix, iy, edges) for ix in range(math.floor(min(xs) / size), math.floor(max(xs) / size) + 1) for iy in range(math.floor(min(ys) / size), math.floor(max(ys) / size) + 1)]
    while stack:
        level, ix, iy, near = stack.pop()
        size = levels[level]
        x0, y0, x1, y1 = ix * size - EPS, iy * size - EPS_LAT, (ix + 1) * size + EPS, (iy + 1) * size + EPS_LAT
        # edges left of the cell or above or below it can't cross a ray to the right
        ray = [e for e in near if max(e[0], e[2]) >= x0 and max(e[1], e[3]) >= y0 and min(e[1], e[3]) <= y1]
        own = [e for e in ray if _touches(e, x0, y0, x1, y1)]
        if not own:
            if _inside((x0 + x1) / 2, (y0 + y1) / 2, ray):
                yield level, ix, iy, True, True, []
        elif level + 1 == len(levels) or level >= border_level and len(own) <= most_edges:
            yield level, ix, iy, False, _inside(x1, y0, ray), own
        else:
            k = round(size / levels[level + 1])
            stack += [(level + 1, ix * k + a, iy * k + b, ray) for a in range(k) for b in range(k)]


def coverage(areas: DataFrame, key: str, outline: str, levels: tuple[float, ...] = LEVELS) -> DataFrame:
    """(area_key, level, ix, iy, interior, corner, edges): the cells of every region."""

    def work(batches):
        for b in batches:
            out = [(k, *c[:5], [list(e) for e in c[5]]) for k, wkt in zip(b["k"], b["w"]) for c in cover(wkt, levels)]
            yield pd.DataFrame(out, columns=["area_key", "level", "ix", "iy", "interior", "corner", "edges"])

    src = areas.select(F.col(key).alias("k"), F.col(outline).alias("w")).where("k is not null and w is not null").dropDuplicates()
    return src.mapInPandas(work, "area_key long, level int, ix long, iy long, interior boolean, corner boolean, edges array<array<double>>")


def points_in_regions(points: DataFrame, areas: DataFrame, key: str = "area_id", outline: str = "outline", levels: tuple[float, ...] = LEVELS) -> DataFrame:
    """(point_id, area_id): each point (point_id, lon, lat) with each region that holds it.

    Regions may overlap and have holes; a point in a hole is outside. Null coordinates or
    outlines give no row. The coverage's size depends on the regions' outlines alone, each of its rows
    holds few edges, and its bytes are measured before it is broadcast; beyond the bound the equi-join on
    cells shuffles.
    """
    cells = cut(coverage(areas, key, outline, levels))
    used = sorted(r.level for r in cells.select("level").distinct().collect())  # at most as many as there are levels
    cells = broadcast_checked(cells)
    spot = lambda i: F.struct(F.lit(i).alias("level"), F.floor(F.col("lon") / levels[i]).alias("ix"), F.floor(F.col("lat") / levels[i]).alias("iy"))
    at = points.where("lon is not null and lat is not null").select("point_id", "lon", "lat", F.explode(F.array(*map(spot, used or [0]))).alias("c")).select("point_id", "lon", "lat", "c.*")
    met = at.join(cells, ["level", "ix", "iy"])
    size = F.element_at(F.array(*map(F.lit, levels)), F.col("level") + 1)
    right, low = (F.col("ix") + 1) * size + EPS, F.col("iy") * size - EPS_LAT
    # where an edge meets a line of latitude or longitude, null if it doesn't
    meets = lambda a1, b1, a2, b2, at: F.when((b1 > at) != (b2 > at), (a2 - a1) * (at - b1) / (b2 - b1) + a1)

    def crossings(e: Column) -> Column:
        """How often an edge is crossed on the way right to the cell's border and down to its corner."""
        x1, y1, x2, y2 = (e[i] for i in range(4))
        x, y = meets(x1, y1, x2, y2, F.col("lat")), meets(y1, x1, y2, x2, right)
        across, along = (F.col("lon") < x) & (x <= right), (low < y) & (y <= F.col("lat"))
        return F.coalesce(across, F.lit(False)).cast("int") + F.coalesce(along, F.lit(False)).cast("int")

    exact = (F.aggregate("edges", F.col("corner").cast("int"), lambda n, e: n + crossings(e)) % 2) == 1
    return met.where(F.when(F.col("interior"), True).otherwise(exact)).select("point_id", F.col("area_key").alias(key))


# --- near points -------------------------------------------------------------------


def near_pairs(points: DataFrame, metres: float, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(left_id, right_id), left_id < right_id: all pairs of points at most ``metres``
    apart on the sphere. points: (point_id, lon, lat), point_id unique.

    The sphere is cut into bands of latitude and each band into cells of longitude, both at
    least ``2 * metres`` wide. A point lives in one cell and is copied into those
    neighbouring cells that it is near enough to matter in; the equi-join on cells of
    living points with all points then finds each pair once, without a cross join. A cell of more than
    ``hot_rows`` living points is salted: its left side is spread, its right side copied.
    Distances compare squared chords of unit vectors. Null coordinates give no row.
    """
    reach = math.degrees(metres / EARTH_M) * (1 + 1e-9)
    band = 2 * reach
    bands = math.ceil(180 / band)
    rad = math.pi / 180
    p = points.where("lon is not null and lat is not null").select(
        F.col("point_id").alias("id"), F.col("lat"), F.pmod(F.col("lon") + 180.0, F.lit(360.0)).alias("lon"),
        (F.cos(F.col("lat") * rad) * F.cos(F.col("lon") * rad)).alias("x"), (F.cos(F.col("lat") * rad) * F.sin(F.col("lon") * rad)).alias("y"), F.sin(F.col("lat") * rad).alias("z"),
    )

    def row(lat: Column) -> Column:
        return F.least(F.greatest(F.floor((lat + 90.0) / band), F.lit(0)), F.lit(bands - 1)).cast("int")

    def columns(b: Column) -> Column:
        """Cells of a band: as many as are 2 * metres wide where the band is narrowest."""
        edge = F.greatest(F.abs(b * band - 90.0), F.abs((b + 1) * band - 90.0))
        return F.greatest(F.lit(1), F.floor(360.0 * F.cos(F.least(edge, F.lit(90.0)) * rad) / band)).cast("int")

    def column(lon: Column, n: Column) -> Column:
        return F.pmod(F.floor(lon / 360.0 * n), n).cast("int")

    home = p.withColumn("b", row(F.col("lat"))).withColumn("c", column(F.col("lon"), columns(F.col("b"))))
    # the half width in longitude of a circle around the point; all of it near a pole
    wide = F.when(F.abs("lat") + reach >= 89.999, 180.0).otherwise(F.asin(F.least(F.lit(1.0), math.sin(reach * rad) / F.cos((F.abs("lat")) * rad))) / rad * (1 + 1e-9))
    spread = p.withColumn("w", wide).withColumn("b", F.explode(F.array_distinct(F.array(row(F.col("lat") - reach), row(F.col("lat")), row(F.col("lat") + reach))))).withColumn("n", columns(F.col("b")))
    first, last = F.floor((F.col("lon") - F.col("w")) / 360.0 * F.col("n")), F.floor((F.col("lon") + F.col("w")) / 360.0 * F.col("n"))
    last = F.least(last, first + F.col("n") - 1)
    spread = spread.withColumn("c", F.explode(F.transform(F.sequence(first, last), lambda v: F.pmod(v, F.col("n")).cast("int")))).drop("w", "n", "lat", "lon")
    home = home.drop("lat", "lon")
    hot = broadcast_checked(home.groupBy("b", "c").count().where(F.col("count") > hot_rows).select("b", "c", F.ceil(F.col("count") / hot_rows).cast("int").alias("salts")))
    left = home.join(hot, ["b", "c"], "left").select("b", "c", F.pmod(F.xxhash64("id"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"), F.col("id").alias("left_id"), F.col("x").alias("lx"), F.col("y").alias("ly"), F.col("z").alias("lz"))
    right = spread.join(hot, ["b", "c"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).select("b", "c", "salt", F.col("id").alias("right_id"), F.col("x").alias("rx"), F.col("y").alias("ry"), F.col("z").alias("rz"))
    most = (2 * math.sin(metres / EARTH_M / 2)) ** 2
    chord = sum((F.col(f"l{a}") - F.col(f"r{a}")) ** 2 for a in "xyz")
    return left.join(right, ["b", "c", "salt"]).where((F.col("left_id") < F.col("right_id")) & (chord <= most)).select("left_id", "right_id")


def pivot_points(values: DataFrame, key: str) -> DataFrame:
    """(point_id, lat, lon) of the rows of (key, quantity, value) that have both
    coordinates, unless both are 0. key is unique within a quantity; if it is repeated,
    the least value counts."""
    both = values.where(F.col("quantity").isin("latitude", "longitude")).groupBy(F.col(key).alias("point_id")).agg(F.min(F.when(F.col("quantity") == "latitude", F.col("value"))).alias("lat"), F.min(F.when(F.col("quantity") == "longitude", F.col("value"))).alias("lon"))
    return both.where("lat is not null and lon is not null and not (lat = 0 and lon = 0)")
