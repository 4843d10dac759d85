"""Context for buildings: nearest stations, amenities near by, areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.functions import ids
from lotline.functions.geo import census_geoid, in_rings
from lotline.functions.numbers import half_even
from lotline.functions.text import routes
from lotline.operators.spatial import count_within, in_areas, nearest

#: Kinds of amenities, a column each.
MAX_KINDS = 64

def with_points(buildings: DataFrame, borough: int | None = None, limit: int | None = None) -> DataFrame:
    d = buildings.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).where(ids.in_borough(F.col("bbl"), borough))
    return d.orderBy("bbl").limit(limit) if limit is not None else d


def nearest_station(buildings: DataFrame, stations: DataFrame, borough: int | None = None, limit: int | None = None) -> DataFrame:
    """bbl, nearest_subway, subway_dist_m, subway_lines. ``stations``: name, lat, lng, daytime_routes."""
    s = stations.select("name", "lat", "lng", routes(F.col("daytime_routes")).alias("lines"))
    d = nearest(with_points(buildings, borough, limit), s)
    return d.select("bbl", F.col("nearest.name").alias("nearest_subway"), half_even(F.col("nearest.distance")).alias("subway_dist_m"), F.col("nearest.lines").alias("subway_lines"))


def amenities(buildings: DataFrame, places: DataFrame, metres: float, borough: int | None = None) -> DataFrame:
    """bbl and, for each kind of place, how many lie within ``metres``. ``places``: kind, lat, lng."""
    kinds = sorted(r[0] for r in places.where(F.col("kind").isNotNull()).select("kind").distinct().limit(MAX_KINDS + 1).collect())
    if len(kinds) > MAX_KINDS:
        raise ValueError(f"more than {MAX_KINDS} kinds of places: a column each is no use")
    d = with_points(buildings, borough)
    for k in kinds:
        d = count_within(d, places.where(F.col("kind") == k), metres, out=f"n_{k}")
    return d.select("bbl", *[f"n_{k}" for k in kinds])


def zones(buildings: DataFrame, areas: DataFrame, borough: int | None = None, holes: bool = True) -> DataFrame:
    """bbl and the areas (flood zones, school districts) that hold it, sorted; buildings in none are left out. ``areas``: area, rings."""
    d = in_areas(with_points(buildings, borough).select("bbl", "latitude", "longitude"), areas, holes=holes)
    return d.groupBy("bbl").agg(F.array_sort(F.collect_set("area")).alias("areas"))


def inside(points: DataFrame, rings: Column, out: str, lat: str = "latitude", lng: str = "longitude") -> DataFrame:
    """Whether a point lies in one of an area's rings."""
    return points.withColumn(out, in_rings(F.col(lat), F.col(lng), rings))


def by_area(buildings: DataFrame, areas: DataFrame) -> DataFrame:
    """Joined on the census tract that borough and tract compose."""
    return buildings.withColumn("geoid", census_geoid(F.substring("bbl", 1, 1), F.col("census_tract"))).join(areas, "geoid", "left")
