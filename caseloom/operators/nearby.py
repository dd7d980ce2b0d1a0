"""Points near other points, and the regions that contain them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_008.8
STRIP_DEG = 0.02
RINGS = "struct<type:string,coordinates:string>"


def distance_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres (haversine)."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def usable_point(lon: Column, lat: Column) -> Column:
    """False for null, NaN and coordinates outside the globe."""
    return F.coalesce(lon.between(-180, 180) & lat.between(-90, 90), F.lit(False))


def polygon_edges(regions: DataFrame, region: str = "area_id", geometry: str = "geometry", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(region, part, x1, y1, x2, y2, lo_x, hi_x)``: the edges of GeoJSON (Multi)Polygons.

    ``part`` numbers the polygons of a region; holes are rings of their part and
    need no mark, as parity counts all edges. ``lo_x`` and ``hi_x`` are the
    part's extent in longitude. Null, broken and other geometries give no edges.
    """
    g = F.from_json(F.col(geometry), RINGS)
    ring = "array<array<array<double>>>"
    parts = F.when(g["type"] == "Polygon", F.array(F.from_json(g["coordinates"], ring))).when(g["type"] == "MultiPolygon", F.from_json(g["coordinates"], f"array<{ring}>"))
    p = regions.select(region, *keep, F.posexplode(parts).alias("part", "_rings"))
    p = p.withColumn("_xs", F.transform(F.flatten("_rings"), lambda q: q[0]))
    p = p.select(region, *keep, "part", F.array_min("_xs").alias("lo_x"), F.array_max("_xs").alias("hi_x"), F.explode("_rings").alias("_ring"))
    pairs = F.arrays_zip(F.slice("_ring", 1, F.greatest(F.size("_ring") - 1, F.lit(0))).alias("a"), F.slice("_ring", 2, F.greatest(F.size("_ring") - 1, F.lit(0))).alias("b"))
    e = p.select(region, *keep, "part", "lo_x", "hi_x", F.explode(pairs).alias("_e"))
    return e.select(region, *keep, "part", "lo_x", "hi_x", *[F.get(F.col(f"_e.{v}"), F.lit(i)).alias(n) for n, v, i in (("x1", "a", 0), ("y1", "a", 1), ("x2", "b", 0), ("y2", "b", 1))])


def regions_of_points(points: DataFrame, regions: DataFrame, lon: str = "lon", lat: str = "lat", region: str = "area_id", geometry: str = "geometry", keep: tuple[str, ...] = (), strip: float = STRIP_DEG) -> DataFrame:
    """``(lon, lat, region, keep..., on_boundary)`` for every distinct usable point and each region that holds it.

    Crossing parity: polygon edges are binned into latitude strips (and the
    longitude bins their polygon spans), points meet the edges of their bin, and
    rightward ray crossings are summed by point and polygon; odd means inside.
    An edge counts for latitudes from its lower end up to, not including, its
    upper end, so a ray through a vertex is counted once and horizontal edges
    never. A point that lies on an edge is reported with ``on_boundary`` true and
    isn't inside (as ``within``); it may lie inside another region. Overlapping
    regions are all reported. Duplicate points are merged first, so a coordinate
    repeated any number of times is tested once. Null and impossible points,
    empty tables and regions without edges give no rows.

    The edge table grows with the regions, not with the points; its join side is
    chosen by the optimizer's size check (broadcast only under the threshold).
    """
    bins = lambda lo, hi: F.explode(F.sequence(F.floor(lo / strip).cast("int"), F.floor(hi / strip).cast("int")))
    e = polygon_edges(regions, region, geometry, keep)
    e = e.withColumn("_by", bins(F.least("y1", "y2"), F.greatest("y1", "y2"))).withColumn("_bx", bins(F.col("lo_x"), F.col("hi_x")))
    p = points.select(F.col(lon).alias("lon"), F.col(lat).alias("lat")).filter(usable_point(F.col("lon"), F.col("lat"))).distinct()
    p = p.withColumns({"_by": F.floor(F.col("lat") / strip).cast("int"), "_bx": F.floor(F.col("lon") / strip).cast("int")})
    cross = (F.col("x2") - F.col("x1")) * (F.col("lat") - F.col("y1")) - (F.col("lon") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    on_edge = (cross == 0) & F.col("lon").between(F.least("x1", "x2"), F.greatest("x1", "x2")) & F.col("lat").between(F.least("y1", "y2"), F.greatest("y1", "y2"))
    spans = (F.least("y1", "y2") <= F.col("lat")) & (F.col("lat") < F.greatest("y1", "y2"))
    right = F.when(F.col("y2") > F.col("y1"), cross > 0).otherwise(cross < 0)
    hit = p.join(e, ["_by", "_bx"]).select("lon", "lat", region, *keep, "part", (spans & right).cast("int").alias("_hit"), on_edge.cast("int").alias("_on")).filter("_hit + _on > 0")
    by = hit.groupBy("lon", "lat", region, *keep, "part").agg(F.sum("_hit").alias("_hits"), F.max("_on").alias("_on")).filter("_on = 1 or _hits % 2 = 1")
    return by.groupBy("lon", "lat", region, *keep).agg((F.max(F.when(F.col("_on") == 0, 1)).isNull()).alias("on_boundary"))


def _cells(lon: Column, lat: Column, metres: float, around: bool) -> Column:
    """Grid cells at least ``metres`` wide: the point's own, or all that may hold its neighbours.

    Latitude bands are ``metres`` high; each band has its own whole number of
    cells round the globe, so cells are wide enough at any latitude and wrap at
    the date line.
    """
    step = math.degrees(metres / EARTH_RADIUS_M) * 1.001
    band = F.floor((lat + 90) / step).cast("long")

    def cell(b: Column, shift: int) -> Column:
        far = F.least(F.greatest(F.abs(b * step - 90), F.abs((b + 1) * step - 90)) + step, F.lit(90.0))
        n = F.greatest(F.floor(360 * F.cos(F.radians(far)) / step), F.lit(1)).cast("long")
        return F.struct(b.alias("b"), F.pmod(F.floor((lon + 180) / 360 * n).cast("long") + shift, n).alias("c"))

    if not around:
        return cell(band, 0)
    return F.array_distinct(F.array(*[cell(band + i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]))


def near_points(points: DataFrame, metres: float, group: tuple[str, ...] = (), lon: str = "lon", lat: str = "lat") -> DataFrame:
    """``(group..., lon_a, lat_a, lon_b, lat_b, metres)``: pairs of distinct points at most ``metres`` apart.

    Each unordered pair stands once, a point is also paired with itself
    (distance 0), so that whoever shares a coordinate can be joined back.
    ``group`` columns must be equal on both sides. Points are merged by
    coordinate first; cells are joined with their neighbours, never all points
    with all.
    """
    p = points.select(*group, F.col(lon).alias("lon"), F.col(lat).alias("lat")).filter(usable_point(F.col("lon"), F.col("lat"))).distinct()
    a = p.select(*group, F.col("lon").alias("lon_a"), F.col("lat").alias("lat_a"), _cells(F.col("lon"), F.col("lat"), metres, False).alias("_cell"))
    b = p.select(*group, F.col("lon").alias("lon_b"), F.col("lat").alias("lat_b"), F.explode(_cells(F.col("lon"), F.col("lat"), metres, True)).alias("_cell"))
    a, b = (x.withColumns({"_cb": F.col("_cell.b"), "_cc": F.col("_cell.c")}).drop("_cell") for x in (a, b))
    pairs = a.join(b, [*group, "_cb", "_cc"]).filter("(lat_a, lon_a) <= (lat_b, lon_b)")
    d = distance_m(F.col("lon_a"), F.col("lat_a"), F.col("lon_b"), F.col("lat_b"))
    return pairs.withColumn("metres", d).filter(F.col("metres") <= metres).drop("_cb", "_cc")


def near_keys_in_regions(rows: DataFrame, regions: DataFrame, key: str, snapshot: str, metres: float = 25.0, region_label: str = "CT20", region: str = "area_id") -> DataFrame:
    """``(case_a, case_b, label)``: pairs of keys with near points in one region, in at least one common snapshot.

    Keys are trimmed; null and blank keys and unusable points are ignored, pairs
    carry the smaller key first and stand once for each region label; regions
    with a null label don't count. The snapshots in which a key stands at a
    point are folded into one set, so a point repeated in every snapshot is
    tested once.
    """
    k = rows.withColumn("_key", F.trim(F.regexp_replace(F.col(f"`{key}`"), r"^[\s ]+|[\s ]+$", ""))).filter((F.col("_key") != "") & usable_point(F.col("lon"), F.col("lat")))
    at = k.groupBy("_key", "lon", "lat").agg(F.collect_set(snapshot).alias("_in"))
    inside = regions_of_points(k, regions.filter(F.col(region_label).isNotNull()), region=region, keep=(region_label,)).filter(~F.col("on_boundary")).select("lon", "lat", region_label).distinct()
    near = near_points(inside, metres, (region_label,))
    a = at.select(F.col("_key").alias("_ka"), F.col("lon").alias("lon_a"), F.col("lat").alias("lat_a"), F.col("_in").alias("_ia"))
    b = at.select(F.col("_key").alias("_kb"), F.col("lon").alias("lon_b"), F.col("lat").alias("lat_b"), F.col("_in").alias("_ib"))
    # One coordinate shared by many keys and paired with itself would give each pair twice; keep one order there.
    same = (F.col("lon_a") == F.col("lon_b")) & (F.col("lat_a") == F.col("lat_b"))
    pairs = near.join(a, ["lon_a", "lat_a"]).join(b, ["lon_b", "lat_b"]).filter(
        (F.col("_ka") != F.col("_kb")) & (~same | (F.col("_ka") < F.col("_kb"))) & F.arrays_overlap("_ia", "_ib"))
    return pairs.select(F.least("_ka", "_kb").alias("case_a"), F.greatest("_ka", "_kb").alias("case_b"), region_label).distinct()


def near_coordinates(rows: DataFrame, regions: DataFrame, key: str, metres: float = 25.0, region_label: str = "CT20", region: str = "area_id") -> DataFrame:
    """``(lon_a, lat_a, lon_b, lat_b, label, n_a, n_b)``: near pairs of distinct coordinates in one region, with the number of keys at each.

    The compact form of ``near_keys_in_regions`` over all snapshots together:
    keys at one coordinate are a class, pairs stand between classes (a
    coordinate with itself if several keys share it), and the membership of keys
    is their rows' own coordinates.
    """
    k = rows.withColumn("_key", F.trim(F.regexp_replace(F.col(f"`{key}`"), r"^[\s\u00a0]+|[\s\u00a0]+$", ""))).filter((F.col("_key") != "") & usable_point(F.col("lon"), F.col("lat")))
    at = k.groupBy("lon", "lat").agg(F.count_distinct("_key").alias("n"))
    inside = regions_of_points(at, regions.filter(F.col(region_label).isNotNull()), region=region, keep=(region_label,)).filter(~F.col("on_boundary")).select("lon", "lat", region_label).distinct()
    near = near_points(inside, metres, (region_label,))
    a, b = (at.select(F.col("lon").alias(f"lon_{s}"), F.col("lat").alias(f"lat_{s}"), F.col("n").alias(f"n_{s}")) for s in "ab")
    same = (F.col("lon_a") == F.col("lon_b")) & (F.col("lat_a") == F.col("lat_b"))
    return near.join(a, ["lon_a", "lat_a"]).join(b, ["lon_b", "lat_b"]).filter(~same | (F.col("n_a") > 1)).select("lon_a", "lat_a", "lon_b", "lat_b", region_label, "n_a", "n_b")
