"""Points, distances and polygons on doubles; rings are arrays of struct(lng, lat)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotline.functions.text import strip

# The earth's radius in metres, and the state's and counties' codes.
RADIUS = 6_371_000.0
STATE_FIPS = "36"
COUNTY_FIPS = {1: "061", 2: "005", 3: "047", 4: "081", 5: "085"}


def haversine(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    dp, dl = F.radians(lat2 - lat1) / 2, F.radians(lng2 - lng1) / 2
    a = F.pow(F.sin(dp), 2.0) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dl), 2.0)
    return F.lit(2 * RADIUS) * F.asin(F.sqrt(a))


def crosses(lat: Column, lng: Column, p: Column | dict[str, Column], q: Column | dict[str, Column]) -> Column:
    """Whether the edge from q to p lies to the right of a point, at its height."""
    x = (q["lng"] - p["lng"]) * (lat - p["lat"]) / (q["lat"] - p["lat"] + F.lit(1e-16)) + p["lng"]
    return ((p["lat"] > lat) != (q["lat"] > lat)) & (lng < x)


def odd_crossings(lat: Column, lng: Column, edges: Column) -> Column:
    """Whether an odd number of edges, structs of the points p and q, lies to the right."""
    return F.size(F.filter(edges, lambda e: crosses(lat, lng, e["p"], e["q"]))) % 2 == 1


def ring_edges(ring: Column) -> Column:
    """An array of struct(p, q): each point of a ring that has some, and the one before it."""
    n = F.size(ring)
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(ring, i).alias("p"), F.get(ring, F.pmod(i - 1, n)).alias("q")))


def in_ring(lat: Column, lng: Column, ring: Column) -> Column:
    """Ray casting: an odd number of edges lies to the right. False without a point or a ring."""
    n = F.size(ring)
    odd = odd_crossings(lat, lng, ring_edges(ring))
    return F.when((n > 0) & lat.isNotNull() & lng.isNotNull(), odd).otherwise(F.lit(False))


def in_rings(lat: Column, lng: Column, rings: Column) -> Column:
    return F.exists(rings, lambda r: in_ring(lat, lng, r))


def ring_literal(points: Sequence[tuple[float, float]]) -> Column:
    """Of (lng, lat) pairs."""
    return F.array(*[F.struct(F.lit(float(x)).alias("lng"), F.lit(float(y)).alias("lat")) for x, y in points])


def census_geoid(borough: Column, tract: Column) -> Column:
    """State, county and six digits of tract; null for what isn't a tract."""
    county = F.create_map(*[x for k, v in COUNTY_FIPS.items() for x in (F.lit(k), F.lit(v))])[borough.try_cast("int")]
    t = strip(tract.cast("string"))
    t = F.when(F.length(t) >= 6, t).otherwise(F.lpad(t, 6, "0"))
    return F.when(t.rlike(r"^\d{6}$") & (strip(tract.cast("string")) != ""), F.concat(F.lit(STATE_FIPS), county, t))
