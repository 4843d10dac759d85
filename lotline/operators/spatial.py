"""Points, places and areas joined by a tree of cells: the nearest places, places within a radius, areas that hold a point.

Cells halve eightfold from one level to the next; a place or point has a cell on each. Of each cell that holds places the tree knows how many and the rectangle they fill, so a point's least and greatest distance to what is in a cell is known without its places. A search goes down the tree, a join a level, and keeps the cells that may still matter: what a point costs grows with the depth of the tree, not with the number of places, and a point far from all places costs no more than another. Only the top of the tree, at most ``TOP`` cells, passes the driver; tables of cells are broadcast only if Spark finds them small. Points of equal coordinates are searched once.

Points and places without coordinates, or with a latitude beyond the poles, have none: they are near nothing and in no area. Results are those of comparing each point with each place: bounds are widened by more than what rounding can be.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.functions.geo import RADIUS, crosses, haversine, odd_crossings, ring_edges
from lotline.session import scratch

#: Bits by which cells grow from level to level, levels, and the width of the finest cells in degrees.
BITS, LEVELS = 3, 8
FINEST = 360.0 / (1 << BITS * (LEVELS - 1))
#: Cells of the tree's top, places of its finest cells on average, and cells that cover an area, at most.
TOP, LEAF, COVER = 64, 8, 256
#: Edges of a cell that are columns of their own: a ray over them is compiled, one over an array isn't.
FEW = 8
#: Bounds are widened by these, relative to themselves and absolutely (as shares of the sphere).
SLACK, LEAST = 1e-9, 1e-18


def _usable(lat: Column, lng: Column) -> Column:
    return F.coalesce(F.abs(lat) <= 90, F.lit(False)) & ~F.isnan(lat) & F.coalesce(F.abs(lng) <= 1e6, F.lit(False)) & ~F.isnan(lng)


def _cell(x: Column, level: int | Column) -> Column:
    """The number of a coordinate's cell on a level (0: the coarsest)."""
    finest = F.floor((x + 180.0) / FINEST)
    if isinstance(level, int):
        return F.shiftright(finest, BITS * (LEVELS - 1 - level))
    return F.floor(finest / F.pow(F.lit(float(1 << BITS)), F.lit(LEVELS - 1) - level))


def _sin2(degrees: Column) -> Column:
    return F.pow(F.sin(F.radians(degrees) / 2), 2.0)


def _bounds(lat: Column, lng: Column, south: Column, north: Column, west: Column, east: Column) -> tuple[Column, Column]:
    """The least and greatest haversine (sine squared of half the angle) from a point to anything in a rectangle."""
    low, high = lng - east, lng - west
    has = lambda turn: F.floor((high - turn) / 360.0) * 360.0 + turn >= low  # noqa: E731  a multiple of 360, or half a turn off
    ends = _sin2(low), _sin2(high)
    near_l, far_l = F.when(has(0.0), 0.0).otherwise(F.least(*ends)), F.when(has(180.0), 1.0).otherwise(F.greatest(*ends))
    near_p = _sin2(F.greatest(F.lit(0.0), south - lat, lat - north))
    far_p = _sin2(F.greatest(F.abs(lat - south), F.abs(lat - north)))
    cos = F.cos(F.radians(lat))
    small = F.cos(F.radians(F.greatest(F.abs(south), F.abs(north))))
    large = F.when((south <= 0) & (north >= 0), 1.0).otherwise(F.cos(F.radians(F.least(F.abs(south), F.abs(north)))))
    widen = lambda a, sign: a * (1 + sign * SLACK) + sign * LEAST
    return widen(near_p + cos * small * near_l, -1), widen(far_p + cos * large * far_l, 1)


RECT = ("n", "south", "north", "west", "east")


class Tree:
    """Cells over ``places`` (lat, lng and other columns): the cells of the top, and a table of cells for each level below."""

    def __init__(self, places: DataFrame):
        self.places = places.where(_usable(F.col("lat"), F.col("lng")))
        kinds = [F.approx_count_distinct(F.struct(_cell(F.col("lat"), k), _cell(F.col("lng"), k))).alias(str(k)) for k in range(LEVELS)]
        r = self.places.agg(F.count(F.lit(1)).alias("n"), *kinds).first()
        self.deep = next((k for k in range(LEVELS) if r[str(k)] * LEAF >= r["n"]), LEVELS - 1)
        top = max((k for k in range(self.deep + 1) if r[str(k)] <= TOP // 2), default=-1)
        while top >= 0 and len(rows := self.cells(top).limit(TOP + 1).collect()) > TOP:
            top -= 1
        self.top = rows if top >= 0 else self.cells(-1).collect()
        self.levels = range(top + 1, self.deep + 1)

    def cells(self, level: int) -> DataFrame:
        """y, x and what lies in the cell; level -1 is one cell of all."""
        key = [(_cell(F.col(c), level) if level >= 0 else F.lit(0).cast("long")).alias(a) for c, a in (("lat", "y"), ("lng", "x"))]
        rect = F.count(F.lit(1)).alias("n"), F.min("lat").alias("south"), F.max("lat").alias("north"), F.min("lng").alias("west"), F.max("lng").alias("east")
        return self.places.select("lat", "lng", *key).groupBy("y", "x").agg(*rect)

    def below(self, e: DataFrame, level: int) -> DataFrame:
        """``e`` (its cells of the level above as ``active``), a row for each cell of ``level`` in them."""
        up = lambda a: (F.shiftright(a, BITS) if level else F.lit(0).cast("long")).alias(f"p{a}")
        cells = self.cells(level).select("*", up("y"), up("x"))
        return self._in_active(e, cells)

    def leaves(self, e: DataFrame) -> DataFrame:
        """``e``, a row for each place in its finest cells, as ``place``."""
        d = self.places.select(F.struct(*self.places.columns).alias("place"), _cell(F.col("lat"), self.deep).alias("py"), _cell(F.col("lng"), self.deep).alias("px"))
        return self._in_active(e, d)

    @staticmethod
    def _in_active(e: DataFrame, below: DataFrame) -> DataFrame:
        one = e.withColumn("__a", F.explode("active")).select(*[c for c in e.columns if c != "active"], F.col("__a.y").alias("py"), F.col("__a.x").alias("px"))
        return one.join(below, ["py", "px"]).drop("py", "px")

    def begin(self, spots: DataFrame) -> DataFrame:
        top = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in ("y", "x", *RECT)]) for r in self.top])
        return spots.withColumn("c", F.explode(top)).select(*spots.columns, "c.*")


def _with_bounds(e: DataFrame) -> DataFrame:
    near, far = _bounds(F.col("lat"), F.col("lng"), *map(F.col, RECT[1:]))
    return e.withColumns({"near": near, "far": far})


def _spots(points: DataFrame, lat: str, lng: str, parts: int | None = None) -> DataFrame:
    """The distinct coordinates of points that have some, in so many parts."""
    d = points.where(_usable(F.col(lat), F.col(lng))).select(F.col(lat).alias("lat"), F.col(lng).alias("lng"))
    return (d.repartition(parts, "lat", "lng") if parts else d).distinct()


def _back(points: DataFrame, found: DataFrame, lat: str, lng: str, how: str = "left") -> DataFrame:
    """``points`` with what was found for their coordinates."""
    f = found.withColumnsRenamed({"lat": "__lat", "lng": "__lng"})
    return points.join(f, (points[lat] == f["__lat"]) & (points[lng] == f["__lng"]), how).drop("__lat", "__lng")


def _distance(place: Column) -> Column:
    return haversine(F.col("lat"), F.col("lng"), place["lat"], place["lng"])


def k_nearest(points: DataFrame, places: DataFrame, k: int = 1, lat: str = "latitude", lng: str = "longitude", out: str = "nearest") -> DataFrame:
    """``points`` with the ``k`` nearest of ``places`` (name, lat, lng and other columns): an array of distance, name and the other columns, by distance, then name, then the rest. Fewer places give a shorter array; points without coordinates have null."""
    rest = [c for c in places.columns if c not in ("name", "lat", "lng")]
    tree = Tree(places.select("name", "lat", "lng", *rest))
    spots = _spots(points, lat, lng)
    reached = F.aggregate(F.array_sort(F.transform("c", lambda x: F.struct(x["far"].alias("far"), x["n"].alias("n")))), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("far")), lambda s, x: F.when(s["n"] >= k, s).otherwise(F.struct((s["n"] + x["n"]).alias("n"), x["far"].alias("far"))))

    def keep(e: DataFrame) -> DataFrame:
        d = _with_bounds(e).groupBy("lat", "lng").agg(F.collect_list(F.struct("near", "far", "n", "y", "x")).alias("c"), F.min("far").alias("least"))
        limit = F.col("least") if k == 1 else reached["far"]
        # bound to a variable: as a mere expression it would be evaluated for each cell
        kept = F.transform(F.array(limit), lambda m: F.transform(F.filter("c", lambda x: x["near"] <= m), lambda x: F.struct(x["y"].alias("y"), x["x"].alias("x"))))
        return d.select("lat", "lng", F.get(kept, F.lit(0)).alias("active"))

    kind = F.struct(F.lit(0.0).alias("distance"), *[F.col(c) for c in ("name", *rest)])
    if not tree.top:
        none = tree.places.select(kind.alias("__k"))
        empty = F.array().cast(f"array<{none.schema['__k'].dataType.simpleString()}>")
        return points.withColumn(out, F.when(_usable(F.col(lat), F.col(lng)), empty))
    state = keep(tree.begin(spots))
    for level in tree.levels:
        state = keep(tree.below(state, level))
    p = F.col("place")
    row = F.struct(_distance(p).alias("distance"), *[p[c].alias(c) for c in ("name", *rest)])
    leaves = tree.leaves(state).select("lat", "lng", row.alias("r"))
    best = F.array(F.min("r")) if k == 1 else F.slice(F.array_sort(F.collect_list("r")), 1, k)
    return _back(points, leaves.groupBy("lat", "lng").agg(best.alias(out)), lat, lng)


def nearest(points: DataFrame, places: DataFrame, lat: str = "latitude", lng: str = "longitude") -> DataFrame:
    """``points`` with nearest, a struct of distance, name and lines: the least distance, then the name. Null for points without coordinates, or without places."""
    d = k_nearest(points, places.select("name", "lat", "lng", "lines"), 1, lat, lng)
    return d.withColumn("nearest", F.get("nearest", F.lit(0)))


def count_within(points: DataFrame, places: DataFrame, metres: float, lat: str = "latitude", lng: str = "longitude", out: str = "within") -> DataFrame:
    """``points`` with the number of places within ``metres`` (the distance itself included); null for points without coordinates. Cells that lie wholly within count without their places."""
    tree = Tree(places.select("lat", "lng"))
    spots = _spots(points, lat, lng)
    if not tree.top:
        return points.withColumn(out, F.when(_usable(F.col(lat), F.col(lng)), F.lit(0).cast("long")))
    limit = _sin2(F.degrees(F.lit(min(metres / RADIUS, 3.2))))  # a haversine grows up to half a turn

    def split(e: DataFrame, sure: Column) -> DataFrame:
        d = _with_bounds(e)
        whole = (F.col("far") < limit) if metres / RADIUS < 3.1 else F.lit(True)
        some = ~whole & (F.col("near") <= limit)
        return d.groupBy("lat", "lng").agg((F.max(sure) + F.sum(F.when(whole, F.col("n")).otherwise(0))).alias("sure"), F.collect_list(F.when(some, F.struct("y", "x"))).alias("active"))

    state = split(tree.begin(spots), F.lit(0))
    done = []
    for level in tree.levels:
        done.append(state.select("lat", "lng", F.col("sure").alias("n")))
        state = split(tree.below(state.drop("sure"), level), F.lit(0))
    done.append(state.select("lat", "lng", F.col("sure").alias("n")))
    done.append(tree.leaves(state.drop("sure")).where(_distance(F.col("place")) <= metres).select("lat", "lng", F.lit(1).cast("long").alias("n")))
    total = reduce(DataFrame.unionByName, done).groupBy("lat", "lng").agg(F.sum("n").cast("long").alias(out))
    return _back(points, total, lat, lng)


def covering(areas: DataFrame, area: str = "area", rings: str = "rings", holes: bool = False) -> DataFrame:
    """level, y, x, area, inner, edges: the cells that cover each area, at most ``COVER``. No edge comes near an inner cell, so that all of it lies inside; the others may hold a border, and have of each ring the edges that a ray from the cell may cross: those that reach its latitudes."""
    ring = F.filter(F.col(rings), lambda r: F.size(r) > 0)
    flat = F.flatten(ring)
    lats, lngs = F.transform(flat, lambda p: p["lat"]), F.transform(flat, lambda p: p["lng"])
    d = areas.select(F.col(area).alias("area"), F.transform(ring, ring_edges).alias("edges"), F.array_min(lats).alias("south"), F.array_max(lats).alias("north"), F.array_min(lngs).alias("west"), F.array_max(lngs).alias("east"))
    d = d.where(_usable(F.col("south"), F.col("west")) & _usable(F.col("north"), F.col("east")))
    span = lambda lo, hi, k: _cell(F.col(hi), k) - _cell(F.col(lo), k) + 1
    fits = [F.when(span("south", "north", k) * span("west", "east", k) <= COVER, F.lit(k)) for k in reversed(range(LEVELS))]
    d = d.withColumn("level", F.coalesce(*fits, F.lit(0)))
    d = d.withColumn("y", F.explode(F.sequence(_cell(F.col("south"), F.col("level")), _cell(F.col("north"), F.col("level")))))
    width = F.lit(FINEST) * F.pow(F.lit(float(1 << BITS)), F.lit(LEVELS - 1) - F.col("level"))
    margin = width * 1e-6
    low, high = {a: F.col(a) * width - 180.0 - margin for a in ("y", "x")}, {a: (F.col(a) + 1) * width - 180.0 + margin for a in ("y", "x")}
    near = lambda e, a, c: (F.least(e["p"][c], e["q"][c]) <= high[a]) & (F.greatest(e["p"][c], e["q"][c]) >= low[a])
    row = F.transform("edges", lambda r: F.filter(r, lambda e: near(e, "y", "lat")))
    # exploded from an array of one, so that what follows doesn't compute it again
    d = d.withColumn("edges", F.explode(F.array(row)))
    d = d.withColumn("x", F.explode(F.sequence(_cell(F.col("west"), F.col("level")), _cell(F.col("east"), F.col("level")))))
    border = F.exists("edges", lambda r: F.exists(r, lambda e: near(e, "x", "lng")))
    d = d.withColumn("border", F.explode(F.array(border)))
    middle = _inside((F.col("y") + 0.5) * width - 180.0, (F.col("x") + 0.5) * width - 180.0, F.col("edges"), holes)
    return d.where(F.col("border") | middle).select("level", "y", "x", "area", (~F.col("border")).alias("inner"), F.when(F.col("border"), F.col("edges")).alias("edges"))


def _inside(lat: Column, lng: Column, edges: Column, holes: bool) -> Column:
    """Inside of any ring, or (``holes``) of an odd number of rings, by the edges of each."""
    if holes:
        return odd_crossings(lat, lng, F.flatten(edges))
    return F.exists(edges, lambda r: odd_crossings(lat, lng, r))


def in_areas(points: DataFrame, areas: DataFrame, lat: str = "latitude", lng: str = "longitude", area: str = "area", rings: str = "rings", holes: bool = False) -> DataFrame:
    """``points`` with the area that each lies in: a row for each area, none without one. ``areas``: a key and its rings, arrays of struct(lng, lat). Areas of equal rings are covered once, and points of equal coordinates cast one ray; points in an inner cell need none. The cover is written to the shared folder, as it is read more than once."""
    spark = points.sparkSession
    at, parts = scratch(spark, "areas"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = areas.where(F.col(rings).isNotNull()).select(F.col(area).alias("area"), F.col(rings).alias("rings"), F.sha2(F.to_json(F.col(rings)), 256).alias("form"))
    forms = named.groupBy("form").agg(F.any_value("rings").alias("rings")).withColumn("shape", F.monotonically_increasing_id())
    shapes = _written(forms, f"{at}/shapes")
    members = _written(named.select("area", "form").join(shapes.select("form", "shape"), "form").select("area", "shape"), f"{at}/members")
    cover = _written(_few_edges(covering(shapes.repartition(parts), "shape", "rings", holes).withColumnRenamed("area", "shape"), holes), f"{at}/cover")
    levels = sorted(r[0] for r in cover.select("level").distinct().collect())  # as many as there are levels
    if not levels:
        return points.limit(0).join(areas.select(F.col(area).alias("area")).limit(0), F.lit(True), "inner")

    def on(d: DataFrame, y: Column, x: Column, cells: DataFrame) -> DataFrame:
        cell = F.array(*[F.struct(F.lit(k).alias("level"), _cell(y, k).alias("y"), _cell(x, k).alias("x")) for k in levels])
        return d.withColumn("k", F.explode(cell)).select(*d.columns, "k.*").join(cells, ["level", "y", "x"]).drop("level", "y", "x")

    # dealt anew: a small file of points is one task's, and may lie in many areas
    p = points.where(_usable(F.col(lat), F.col(lng))).select(F.struct(*points.columns).alias("point"), F.col(lat).alias("lat"), F.col(lng).alias("lng"))
    sure = on(p.repartition(parts), F.col("lat"), F.col("lng"), cover.where("inner").select("level", "y", "x", "shape")).select("point", "shape")
    spots = _spots(points, lat, lng, parts)
    rays = lambda cells, inside: on(spots, F.col("lat"), F.col("lng"), cells).where(inside).select("lat", "lng", "shape")
    one = [F.coalesce(crosses(F.col("lat"), F.col("lng"), *ends), F.lit(False)) for ends in _ends()]
    few = rays(cover.where("few").drop("inner", "few", "edges"), reduce(lambda a, b: a != b, one))
    many = rays(cover.where("NOT inner AND NOT few").select("level", "y", "x", "shape", "edges"), _inside(F.col("lat"), F.col("lng"), F.col("edges"), holes))
    cast = few.unionByName(many)
    both = sure.join(members, "shape").unionByName(cast.join(p, ["lat", "lng"]).select("point", "shape").join(members, "shape"))
    return both.select("point.*", "area")


def _ends() -> list[tuple[dict[str, Column], dict[str, Column]]]:
    """The columns of a cell's few edges."""
    return [tuple({c: F.col(f"{end}{i}_{c}") for c in ("lat", "lng")} for end in "pq") for i in range(FEW)]


def _few_edges(cover: DataFrame, holes: bool) -> DataFrame:
    """``cover`` with few: a border cell whose edges, of one ring if each ring counts for itself, are no more than ``FEW``; they are columns then."""
    rows = F.size(F.filter("edges", lambda r: F.size(r) > 0))
    # exploded from arrays of one, so that each column doesn't compute them again
    d = cover.withColumn("flat", F.explode(F.array(F.flatten("edges"))))
    d = d.withColumn("few", F.explode(F.array(~F.col("inner") & (F.size("flat") <= FEW) & (F.lit(True) if holes else rows <= 1))))
    columns = [F.when(F.col("few"), F.get("flat", F.lit(i))[end][c]).alias(f"{end}{i}_{c}") for i in range(FEW) for end in "pq" for c in ("lat", "lng")]
    return d.select("level", "y", "x", "shape", "inner", "few", F.when(~F.col("inner") & ~F.col("few"), F.col("edges")).alias("edges"), *columns)


def _written(d: DataFrame, at: str) -> DataFrame:
    d.write.parquet(at)
    return d.sparkSession.read.schema(d.schema).parquet(at)
