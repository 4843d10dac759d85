"""The tree of cells against comparing each point with each place."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lotline.operators import enrich, spatial

R = 6_371_000.0


def metres(a, b):
    dp, dl = math.radians(b[0] - a[0]) / 2, math.radians(b[1] - a[1]) / 2
    return 2 * R * math.asin(math.sqrt(math.sin(dp) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(dl) ** 2))


def spots(seed, n):
    """Dense clusters, the date line, the poles, repeats and lone places."""
    rng = random.Random(seed)
    out = [(rng.choice([40.7, -10.0, 89.9]) + rng.gauss(0, 0.05), rng.choice([-74.0, 179.99, 5.0]) + rng.gauss(0, 0.05)) for _ in range(n)]
    out = [(min(90.0, a), b) for a, b in out]
    return out + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n // 10)] + out[: n // 10] + [(40.7, -180.0), (40.7, 180.0), (0.0, 0.0), (-0.0, 0.0)]


@pytest.fixture(scope="module")
def frames(spark):
    places = [(f"p{i:04}", a, b, f"l{i}") for i, (a, b) in enumerate(spots(1, 600))]
    points = [(i, a, b) for i, (a, b) in enumerate(spots(2, 150))]
    odd = [("none", None, 1.0, ""), ("nan", float("nan"), 1.0, ""), ("far", 91.0, 1.0, "")]
    p = spark.createDataFrame(places + odd, "name string, lat double, lng double, lines string")
    d = spark.createDataFrame(points + [(9000, None, 1.0), (9001, 1.0, None), (9002, float("nan"), 0.0), (9003, 95.0, 0.0)], "id int, latitude double, longitude double").withColumns({c: F.lit("x") for c in ("y", "n", "active", "place", "within2")})
    return places, points, p, d


@pytest.mark.parametrize("k", [1, 5])
def test_nearest(frames, k):
    places, points, p, d = frames
    got = {r["id"]: r["nearest"] for r in spatial.k_nearest(d, p, k).collect()}
    assert len(got) == len(points) + 4 and all(got[i] is None for i in (9000, 9001, 9002, 9003))
    for i, a, b in points:
        want = sorted((metres((a, b), (x[1], x[2])), x[0]) for x in places)[:k]
        assert [r["distance"] for r in got[i]] == pytest.approx([w[0] for w in want], abs=1e-4)
        assert len({r["name"] for r in got[i]}) == k and all(r["lines"] == f"l{int(r['name'][1:])}" for r in got[i])


def test_ties_go_by_name(spark):
    p = spark.createDataFrame([(n, 1.0, 1.0, "") for n in ("b", "a", "c")] + [("far", 3.0, 3.0, "")], "name string, lat double, lng double, lines string")
    d = spark.createDataFrame([(1, 1.1, 1.0), (2, 1.1, 1.0)], "id int, latitude double, longitude double")
    assert [[x["name"] for x in r["nearest"]] for r in spatial.k_nearest(d, p, 2).collect()] == [["a", "b"]] * 2
    assert {r["nearest"]["name"] for r in spatial.nearest(d, p).collect()} == {"a"}


@pytest.mark.parametrize("r", [0.0, 500.0, 20_000.0, 3_000_000.0, 30_000_000.0])
def test_within(frames, r):
    places, points, p, d = frames
    got = {x["id"]: x["within"] for x in spatial.count_within(d, p, r).collect()}
    assert len(got) == len(points) + 4 and got[9000] is None
    for i, a, b in points:
        assert got[i] == sum(metres((a, b), (x[1], x[2])) <= r for x in places)


def test_no_places(spark, frames):
    _, points, p, d = frames
    assert {str(r["nearest"]) for r in spatial.k_nearest(d, p.limit(0), 2).where("id < 9000").collect()} == {"[]"}
    assert {r["nearest"] for r in spatial.nearest(d, p.limit(0)).collect()} == {None}
    assert {r["within"] for r in spatial.count_within(d, p.limit(0), 5.0).where("id < 9000").collect()} == {0}
    assert spatial.in_areas(d, spark.createDataFrame([], "area int, rings array<array<struct<lng:double,lat:double>>>")).count() == 0


def test_a_point_meets_few_places_whatever_their_number(spark):
    """Rows that reach the last join, for 1,000 and for 20,000 places."""
    rng = random.Random(4)
    d = spark.createDataFrame([(i, 40 + rng.random(), -74 + rng.random()) for i in range(50)] + [(99, -40.0, 100.0)], "id int, latitude double, longitude double")
    met = []
    for n in (1_000, 20_000):
        p = spark.createDataFrame([(f"p{i}", 40 + rng.random(), -74 + rng.random(), "") for i in range(n)], "name string, lat double, lng double, lines string")
        tree = spatial.Tree(p)
        assert len(tree.top) <= spatial.TOP
        seen = []
        real = spatial.Tree.leaves
        spatial.Tree.leaves = lambda self, e: seen.append(real(self, e)) or seen[-1]
        try:
            spatial.k_nearest(d, p, 1).collect()
        finally:
            spatial.Tree.leaves = real
        met.append(seen[0].count())
    assert met[1] < 3 * met[0] and met[1] < 51 * 100


def inside(lat, lng, ring):
    odd = False
    for i, (x, y) in enumerate(ring):
        px, py = ring[i - 1]
        if (y > lat) != (py > lat) and lng < (px - x) * (lat - y) / (py - y + 1e-16) + x:
            odd = not odd
    return odd


def shapes(seed):
    rng = random.Random(seed)
    out = []
    for k in range(25):
        cx, cy, size = -74 + rng.random(), 40 + rng.random(), rng.choice([0.001, 0.05, 0.4, 30.0])
        star = lambda r, m: [(cx + r * rng.uniform(0.5, 1) * math.cos(2 * math.pi * i / m), cy + r * rng.uniform(0.5, 1) * math.sin(2 * math.pi * i / m)) for i in range(m)]  # noqa: E731, B023
        rings = [star(size, rng.randint(3, 40))]
        if k % 3 == 0:
            rings.append(star(size / 3, 6))  # a hole
        if k % 5 == 0:
            rings += [[(cx + 2 * size, cy), (cx + 3 * size, cy), (cx + 3 * size, cy + size), (cx + 2 * size, cy + size)], []]
        out.append((k, [[{"lng": x, "lat": y} for x, y in r] for r in rings]))
    out += [(100, [[{"lng": -74.0, "lat": 40.0}, {"lng": -73.0, "lat": 40.0}, {"lng": -73.0, "lat": 41.0}, {"lng": -74.0, "lat": 41.0}]]), (101, []), (102, None), (103, [[]])]
    return out


@pytest.mark.parametrize("holes", [False, True])
def test_areas(spark, holes):
    areas = shapes(7)
    a = spark.createDataFrame(areas, "area int, rings array<array<struct<lng:double,lat:double>>>")
    rng = random.Random(8)
    points = [(i, 40 + rng.uniform(-0.5, 1.5), -74 + rng.uniform(-0.5, 1.5)) for i in range(400)]
    points += [(1000 + i, p["lat"], p["lng"]) for i, p in enumerate(q for _, rings in areas for r in rings or [] for q in r)]  # corners
    points += [(5000, 40.5, -74.0), (5001, 40.0, -73.5), (5002, 41.0, -73.5), (5003, 40.5, -73.0), (5004, 40.5, -73.5), (5005, 40.5, -73.5)]
    d = spark.createDataFrame(points + [(9000, None, 1.0)], "id int, latitude double, longitude double")
    out = spatial.in_areas(d, a, holes=holes)
    got = sorted((r["id"], r["area"]) for r in out.collect())
    test = (lambda lat, lng, rings: sum(inside(lat, lng, r) for r in rings) % 2 == 1) if holes else (lambda lat, lng, rings: any(inside(lat, lng, r) for r in rings))
    want = sorted((i, k) for i, y, x in points for k, rings in areas if rings and test(y, x, [[(p["lng"], p["lat"]) for p in r] for r in rings if r]))
    assert got == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert spatial.covering(a, holes=holes).where("inner").count() > 100


def test_enrichers(spark):
    b = spark.createDataFrame([("1", 40.5, -73.5), ("2", 40.9, -73.5), ("3", None, 1.0)], "bbl string, latitude double, longitude double")
    p = spark.createDataFrame([("cafe", 40.5, -73.5), ("cafe", 40.501, -73.5), ("park", 40.9, -73.5)], "kind string, lat double, lng double")
    assert sorted(tuple(r) for r in enrich.amenities(b, p, 150.0).collect()) == [("1", 2, 0), ("2", 0, 1)]
    zone = [[{"lng": -74.0, "lat": 40.0}, {"lng": -73.0, "lat": 40.0}, {"lng": -73.0, "lat": 40.6}, {"lng": -74.0, "lat": 40.6}]]
    a = spark.createDataFrame([("flood", zone), ("school", zone)], "area string, rings array<array<struct<lng:double,lat:double>>>")
    assert [tuple(r) for r in enrich.zones(b, a).collect()] == [("1", ["flood", "school"])]


@pytest.mark.parametrize("holes", [False, True])
def test_equal_areas_are_covered_once(spark, monkeypatch, holes):
    """Areas of the same rings, a key twice and one without a name; cells of few edges, of many, and of several rings."""
    import math

    rng = random.Random(6)
    octagon = [{"lng": -73.5 + 0.3 * math.cos(i * math.pi / 4), "lat": 40.5 + 0.3 * math.sin(i * math.pi / 4)} for i in range(8)]
    star = [{"lng": -73.5 + (0.4 if i % 2 else 0.02) * math.cos(i * math.pi / 100), "lat": 40.5 + (0.4 if i % 2 else 0.02) * math.sin(i * math.pi / 100)} for i in range(200)]
    square = [{"lng": x, "lat": y} for x, y in ((-73.7, 40.3), (-73.4, 40.3), (-73.4, 40.6), (-73.7, 40.6))]
    forms = [[octagon], [star], [octagon, square]]
    areas = [(i, forms[i % 3]) for i in range(30)] + [(0, [octagon]), (None, [square]), (99, None), (98, [])]
    seen, covers, real, written = [], [], spatial.covering, spatial._written
    monkeypatch.setattr(spatial, "covering", lambda a, *x, **k: seen.append(a.where("size(rings) > 0").count()) or real(a, *x, **k))
    monkeypatch.setattr(spatial, "_written", lambda d, at: covers.append(written(d, at)) or covers[-1])
    points = [(i, 40.5 + rng.uniform(-0.42, 0.42), -73.5 + rng.uniform(-0.42, 0.42)) for i in range(300)]
    points += [(1000 + i, y, x) for i, y, x in points[:50]]
    d = spark.createDataFrame(points, "id int, latitude double, longitude double")
    a = spark.createDataFrame(areas, "area int, rings array<array<struct<lng:double,lat:double>>>")
    got = [(r["id"], r["area"]) for r in spatial.in_areas(d, a, holes=holes).collect()]
    assert seen == [4]
    test = lambda lat, lng, rings: sum(inside(lat, lng, [(p["lng"], p["lat"]) for p in r]) for r in rings)
    held = lambda n: n % 2 == 1 if holes else n > 0
    want = [(i, k) for i, y, x in points for k, rings in areas if rings and held(test(y, x, rings))]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert covers[-1].where("few").count() > 10 and covers[-1].where("NOT few AND NOT inner").count() > 10
