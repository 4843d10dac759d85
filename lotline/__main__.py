"""Commands over a lake of tables: python -m lotline COMMAND --db FOLDER ...

Landed pages are files; what a live service would return is read from them. One broken source never stops the others.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Callable
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline import session
from lotline.functions import ids
from lotline.lake import Lake
from lotline.functions.text import normalize_unit
from lotline.operators import coverage, export, importers, keys, merges, portfolios, reconcile, resolve, rollup, units, upsert
from lotline.sources import landing, records, registry, requests
from lotline.sources.listings import MARKETPLACES, liveness
from lotline.streaming import incremental

FIELDS = [f for f in units.LISTING_FIELDS if f != "source_id"]
LISTINGS = "source string, source_id string, " + ", ".join(f"{f} {'double' if f in ('bedrooms', 'bathrooms', 'price', 'sqft', 'latitude', 'longitude') else 'int' if f.startswith('is_') else 'string'}" for f in FIELDS) + ", first_seen string, last_seen string, status string"
EVENTS = "bbl string, event_type string, event_date string, source string, amount double, party string, detail string, arrival long"
CROSSWALK = "norm_address string, bbl string, borough string, zipcode string"
HISTORY = "source string, source_id string, snapshot_date string, price double, lease_terms string, status string"


def show(df: DataFrame, n: int = 40) -> None:
    for r in df.limit(n).collect():
        print(json.dumps(r.asDict(recursive=True), ensure_ascii=False, default=str))


def scrape(lake: Lake, a: argparse.Namespace) -> int:
    """Landed pages of listing feeds into listings and price_history."""
    if a.list:
        print("\n".join(sorted(registry.LISTING_FEEDS)))
        return 0
    failed = 0
    for spec in a.pages or []:
        name, _, path = spec.partition("=")
        try:
            pages = landing.pages(lake.spark, path)
            for k, v in (x.split(":", 1) for x in a.label or []):
                pages = pages.withColumn(k, F.lit(v))
            got = registry.LISTING_FEEDS[name](pages).drop("source").withColumn("arrival", F.monotonically_increasing_id())
            table = lake.buckets("listings", LISTINGS, ["source_id"], ["source"])
            mine = table.read().where(F.col("source") == name)
            counts = upsert.pull_log(upsert.snapshot_merge(mine, got, name, a.now, FIELDS), name, a.now)
            log = lake.spark.createDataFrame(counts.collect(), counts.schema)  # one row, read before the table that it counts changes
            if not got.isEmpty():
                today = upsert.history_rows(got, name, a.now[:10])
                history = lake.buckets("price_history", HISTORY, ["source_id", "snapshot_date"], ["source"])
                history.merge(today, lambda old, new: keys.insert_or_replace(old, new.withColumn("__n", F.lit(0)), ["source", "source_id", "snapshot_date"], "__n"))
                # what the pull lacks becomes inactive: active rows of the source, and no other source, are touched too
                merge = lambda old, new: upsert.snapshot_merge(old, new.drop("source"), name, a.now, FIELDS)
                table.merge(got.withColumn("source", F.lit(name)), merge, also=(F.col("source") == name) & (F.col("status") == "active") & (F.col("last_seen") < a.now))
                lake.append("pull_log", log)
            show(log)
        except Exception as e:  # noqa: BLE001
            failed += 1
            print(f"{name}: {str(e)[:300]}", file=sys.stderr)
    if a.dedupe:
        lake.replace("unit_dedup", units.build_units(lake.read("listings", LISTINGS), marketplaces=MARKETPLACES).select("source", "source_id", "unit_id", "unit_key", "is_canonical", "cluster_size"))
        show(lake.read("unit_dedup").agg(F.count(F.lit(1)).alias("listings"), F.sum("is_canonical").alias("units")))
    if a.status:
        show(coverage.distribution(lake.read("listings", LISTINGS).where("status = 'active'"), "source"))
    return failed


def build_record(lake: Lake, a: argparse.Namespace) -> int:
    """Landed public records into buildings and building_events."""
    if a.list:
        print("\n".join(sorted(registry.RECORD_FEEDS)))
        return 0
    boro = ids.borough_code(a.boro)
    for spec in a.rows or []:
        name, _, path = spec.partition("=")
        raw = lake.spark.read.option("multiLine", "true").option("primitivesAsString", "true").json(path)
        raw = raw.limit(a.limit) if a.limit else raw
        f = registry.RECORD_FEEDS[name]
        if name == "pluto":
            lake.replace("buildings", f(raw).where(ids.in_borough(F.col("bbl"), boro)).dropDuplicates(["bbl"]))
        else:
            e = f(raw, lake.read("crosswalk", CROSSWALK)) if name in ("dob_complaints", "evictions", "sr311") else f(raw)
            if "event_type" not in e.columns:
                lake.replace(f"record_{name}", e)
                continue
            e = e.where(ids.in_borough(F.col("bbl"), boro)).withColumn("arrival", F.monotonically_increasing_id())
            new = upsert.add_events(lake.read("building_events", EVENTS), e)
            lake.append("building_events", new)
            kind = next(k for k in records.ROLLUPS if not e.where(F.col("event_type") == k).isEmpty()) if not e.isEmpty() else None
            if kind:
                lake.replace(f"rollup_{kind}", records.rolled(e, kind))
        lake.append("record_source_log", raw.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("source"), F.lit(a.now).alias("pulled_at"), "rows"))
    if a.crosswalk:
        b = lake.read("buildings").withColumn("arrival", F.monotonically_increasing_id())
        lake.replace("crosswalk", resolve.crosswalk_from_lots(b))
    if a.portfolios:
        b = lake.read("buildings").withColumn("position", F.monotonically_increasing_id())
        for c in ("owner_name", "owner_business_address"):
            b = b if c in b.columns else b.withColumn(c, F.lit(None).cast("string"))
        p, where = portfolios.build_portfolios(b)
        lake.replace("portfolios", p)
        lake.replace("building_portfolio", where)
        show(portfolios.largest(lake.read("portfolios"), 10))
    if a.status:
        show(coverage.distribution(lake.read("building_events", EVENTS), "event_type"))
        show(rollup.path_counts(lake.read("record_source_log", "source string, pulled_at string, rows long"), F.col("source")))
    return 0


ADDRESSES = "address_id string, bbl string, address string, normalized string, zipcode string, source string"
UNITS = "unit_id string, bbl string, unit_label string, normalized_unit string, first_seen string, last_seen string"
OBSERVATIONS = "observation_id string, document_id string, source string, source_ref string, observed_at string, observation_kind string, address string, unit_label string, price double, status string, raw_fields string, evidence_grade string, zipcode string"
MATCHES = "observation_id string, entity_type string, entity_id string, status string, confidence double, rationale string, matched_at string"
DOCUMENTS = "document_id string, source string, source_ref string, payload string, retrieved_at string"
EVIDENCE = "observation_id string, entity_type string, evidence_observation_id string, role string"
SOURCES = "source string, source_kind string, methodology string, first_seen string, last_seen string"


def _read(lake: Lake, name: str, schema: str) -> DataFrame:
    """A table with at least the columns of ``schema``."""
    return upsert.with_columns_of(lake.read(name, schema), dict(x.split() for x in schema.split(", ")))


def _with_addresses(lake: Lake, new: DataFrame) -> DataFrame:
    merged = upsert.address_upsert(_read(lake, "addresses", ADDRESSES).select("bbl", "normalized", "address", "zipcode", "source"), new)
    return merged.withColumn("address_id", ids.catalog_id("addr", F.col("bbl"), F.col("normalized")))


def take_in(lake: Lake, s: importers.Source, raw: DataFrame, now: str) -> None:
    """Rows of a source into the catalog's tables. Repeating it changes nothing but times: rows are merged by their keys, and all tables change at once."""
    by_address = s.bbl is None or s.by_address_too
    o = importers.observe(raw, s, now, _read(lake, "addresses", ADDRESSES) if by_address else None)
    o = lake.replace("observed", o.withColumn("arrival", F.monotonically_increasing_id()))
    last = keys.last_wins(o, ["observation_id"], "arrival")
    claimed = _read(lake, "entity_matches", MATCHES).withColumn("pass_no", F.lit(-1).cast("long"))
    buildings = last.where("building.status = 'resolved'").select(F.col("building.bbl").alias("bbl"), "source", F.lit(now).alias("first_seen"), F.lit(now).alias("last_seen"), "arrival")
    candidates = _read(lake, "candidates", "observation_id string, entity_type string, candidate_id string")
    sources = _read(lake, "sources", SOURCES)
    seen = sources.unionByName(lake.spark.createDataFrame([(s.name, s.kind, s.payload_kind, now, now)], SOURCES), allowMissingColumns=True)
    lake.replace_all({
        "source_documents": keys.insert_or_ignore(_read(lake, "source_documents", DOCUMENTS), importers.documents(o, now).withColumn("arrival", F.lit(0)), ["document_id"], "arrival").drop("arrival"),
        "observations": keys.insert_or_replace(_read(lake, "observations", OBSERVATIONS), last.drop("bbls", "building", "unit", "norm_address"), ["observation_id"], "arrival").drop("arrival"),
        "buildings": keys.insert_or_ignore(_read(lake, "buildings", "bbl string"), buildings, ["bbl"], "arrival").drop("arrival"),
        "addresses": _with_addresses(lake, importers.addresses_of(last).drop("address_id")),
        "units": upsert.unit_upsert(_read(lake, "units", UNITS), importers.units_of(last, now), ["bbl", "normalized_unit"], "unit_id", "unit_label"),
        "entity_matches": upsert.match_upsert(claimed, importers.claims(last, now).withColumn("pass_no", F.lit(0).cast("long"))).drop("pass_no"),
        "candidates": candidates.join(last.select("observation_id"), "observation_id", "left_anti").unionByName(resolve.candidate_rows(last, "observation_id")),
        "sources": seen.groupBy("source").agg(F.min("source_kind").alias("source_kind"), F.min("methodology").alias("methodology"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")),
    })


def catalog(lake: Lake, a: argparse.Namespace) -> int:
    """Catalog sources into observations and claims; coverage, gaps and capacity slots."""
    for spec in a.rows or []:
        name, _, path = spec.partition("=")
        take_in(lake, importers.SOURCES[name], lake.spark.read.option("multiLine", "true").option("primitivesAsString", "true").json(path), a.now)
    if a.demote:
        matches, left = upsert.demote(lake.read("entity_matches"), lake.read("units"), lake.read("observations"))
        lake.replace_all({"entity_matches": matches, "units": left})
    if a.reconcile:
        settle(lake, a.now)
    if a.coverage:
        done = lake.read("observations").join(lake.read("entity_matches").where("entity_type = 'unit' AND status = 'resolved'").select("observation_id"), "observation_id", "left_semi")
        show(coverage.listing_coverage(lake.read("listings", LISTINGS), done.select("source", F.col("source_ref").alias("source_id"))))
    if a.gaps:
        show(coverage.capacity_gaps(_read(lake, "buildings", "bbl string, units_res long"), lake.read("units", "bbl string"), a.gaps, ids.borough_code(a.boro)))
    if a.slots:
        slots(lake, a.slots, a.batch)
    if a.status:
        show(coverage.catalog_status(**{t: lake.read(t) for t in ("observations", "entity_matches", "units", "addresses", "buildings", "source_documents") if lake.has(t)}))
    return 0


def slots(lake: Lake, run: str, batch: int | None) -> None:
    """Capacity slots of a run: all at once, or the next ``batch`` buildings after the run's durable cursor, which changes with the slots."""
    schema = "run string, cursor string, completed boolean"
    buildings = _read(lake, "buildings", "bbl string, units_res long")
    if batch is None:
        lake.replace("housing_capacity_slots", coverage.capacity_slots(buildings, run))
        return
    runs = lake.read("capacity_runs", schema)
    mine = runs.where(F.col("run") == run).first()
    cursor = mine["cursor"] if mine else None
    if mine and mine["completed"]:
        return
    after, completed = incremental.slots_state(lake.spark, buildings, cursor, batch)
    here = buildings.where(F.col("bbl") <= after) if after is not None else buildings.limit(0)
    new = coverage.capacity_slots(here.where(F.col("bbl") > cursor) if cursor is not None else here, run)
    state = lake.spark.createDataFrame([(run, after, completed)], schema)
    old = lake.read("housing_capacity_slots") if lake.has("housing_capacity_slots") else new.limit(0)
    lake.replace_all({"housing_capacity_slots": old.unionByName(new), "capacity_runs": runs.where(F.col("run") != run).unionByName(state)})


def settle(lake: Lake, now: str) -> None:
    """Ambiguous listings that official unit evidence settles. Edges to the evidence are added: those of earlier runs stay."""
    obs, matches = lake.read("observations"), lake.read("entity_matches")
    open_ = matches.where("entity_type = 'building' AND status = 'ambiguous'").select("observation_id")
    found = lake.read("candidates", "observation_id string, entity_type string, candidate_id string").groupBy("observation_id").agg(F.collect_set("candidate_id").alias("bbls"))
    asked = obs.join(open_, "observation_id", "left_semi").join(found, "observation_id").select("observation_id", "address", "unit_label", "bbls")
    unit = matches.where("entity_type = 'unit' AND status = 'resolved'").select("observation_id", F.col("entity_id").alias("unit_id"))
    building = matches.where("entity_type = 'building' AND status = 'resolved'").select("observation_id", F.col("entity_id").alias("bbl"))
    official = obs.where("source = 'hpd_violations' AND address IS NOT NULL").join(unit, "observation_id").join(building, "observation_id")
    settled = reconcile.corroborate(asked, official.select("observation_id", "source_ref", "address", "bbl", "unit_id", normalize_unit(F.col("unit_label")).alias("normalized_unit")))
    done = settled.where("outcome = 'resolved'")
    claim = lambda kind, value: done.select("observation_id", F.lit(kind).alias("entity_type"), F.col(value).alias("entity_id"), F.lit("resolved").alias("status"), "confidence", "rationale", F.lit(now).alias("matched_at"))
    new = claim("building", "bbl").unionByName(claim("unit", "unit_id"))
    edges = keys.insert_or_ignore(lake.read("entity_match_evidence", EVIDENCE), reconcile.evidence_edges(settled).withColumn("arrival", F.lit(0)), ["observation_id", "entity_type", "evidence_observation_id"], "arrival").drop("arrival")
    lake.replace_all({"entity_matches": matches.join(new.select("observation_id", "entity_type"), ["observation_id", "entity_type"], "left_anti").unionByName(new), "entity_match_evidence": edges})
    show(lake.read("entity_match_evidence").agg(F.count_distinct("observation_id").alias("settled")))


def merge(lake: Lake, a: argparse.Namespace) -> int:
    """Archives (--rows NAME=PATH of rows with address, unit, zip, source_ref) into routed rows, units and claims."""
    archives = []
    for name, _, path in (x.partition("=") for x in a.rows or []):
        d = lake.spark.read.option("multiLine", "true").schema("address string, unit string, zip string, source_ref string").json(path)
        archives.append((name, d, {k: F.col(k) for k in merges.COLUMNS[1:]}))
    read = lambda t, extra: upsert.with_columns_of(lake.read(t, extra), {x.split()[0]: x.split()[1] for x in extra.split(", ")})
    buildings = read("buildings", "bbl string, units_res long, address string").withColumnRenamed("address", "primary_address")
    archive = read("archive_units", "unit_id string, source_systems string")
    out = merges.run(archives, read("addresses", "bbl string, normalized string, zipcode string"), read("official_unit_lots", "unit_lot_bbl string, unit_designation string"), buildings, read("units", "bbl string"), archive, a.source, a.now)
    lake.replace_all({f"merge_{k}": v for k, v in out.items()})
    grow(lake, [lake.read(f"merge_{k}") for k in out if k != "routed"], a.now)
    show(rollup.path_counts(lake.read("merge_routed"), F.col("route")))
    return 0


def grow(lake: Lake, claims: list[DataFrame], now: str) -> None:
    """Merge claims into units, observations and matches: a unit that is stored keeps its id and label, an observation and a match that is stored stays. Repeating it changes last_seen only."""
    new = reduce(DataFrame.unionByName, [d.select("unit_id", "bbl", "unit_label", "unit_normalized", "observation_id", "source", "source_ref", "confidence", "method", "observed_at") for d in claims]).withColumnRenamed("unit_normalized", "normalized_unit").withColumn("arrival", F.lit(0).cast("long"))
    d = new.withColumns({"first_seen": F.lit(now), "last_seen": F.lit(now)})
    merged = upsert.unit_upsert(_read(lake, "units", UNITS), d.select("unit_id", "bbl", "unit_label", "normalized_unit", "first_seen", "last_seen", "arrival"), ["bbl", "normalized_unit"], "unit_id", "unit_label", keep_label=True)
    stored = new.drop("unit_id").join(merged.select("bbl", "normalized_unit", "unit_id"), ["bbl", "normalized_unit"])
    o = new.select("observation_id", "source", "source_ref", "observed_at", F.lit("archive_identity_evidence").alias("observation_kind"), "unit_label", F.lit("legacy_snapshot").alias("evidence_grade"), "arrival")
    claim = lambda kind, value: stored.select("observation_id", F.lit(kind).alias("entity_type"), F.col(value).alias("entity_id"), F.lit("resolved").alias("status"), "confidence", F.col("method").alias("rationale"), F.lit(now).alias("matched_at"), "arrival")
    lake.replace_all({
        "units": merged,
        "observations": keys.insert_or_ignore(_read(lake, "observations", OBSERVATIONS), o, ["observation_id"], "arrival").drop("arrival"),
        "entity_matches": keys.insert_or_ignore(_read(lake, "entity_matches", MATCHES), claim("building", "bbl").unionByName(claim("unit", "unit_id")), ["observation_id", "entity_type"], "arrival").drop("arrival"),
    })


# The feeds with keyset pages, and their keys.
KEYSETS = {"hpd_problems": ("received_date", "problem_id"), "acris_unit_legals": ("document_id",)}


def acquire(lake: Lake, a: argparse.Namespace) -> int:
    """Pages of a landed feed, with a durable log or (--keyset) cursor; goes on where it stopped."""
    scope = incremental.scope_of(a.boro)
    feed = lake.spark.read.option("multiLine", "true").option("primitivesAsString", "true").json(a.landed)
    sink = lambda d: lake.append(f"landed_{a.source}", d)
    if a.keyset:
        return acquire_keyset(lake, a, scope, feed, sink)
    log = lake.read("acquisition_pages", "source string, scope string, offset long, requested long, rows long")
    start = incremental.next_offset(log, a.source, scope, a.offset)
    if start is None:
        print("the feed's last page was read")
        return 0
    staged = lake.replace("feed_in_order", incremental.positioned(feed))
    for offset, requested, rows in incremental.run_offset_pages(incremental.Positions(staged).page, sink, start, a.page_size, a.pages):
        lake.append("acquisition_pages", lake.spark.createDataFrame([(a.source, scope, offset, requested, rows)], log.schema))
        print(json.dumps({"offset": offset, "rows": rows}))
    return 0


def acquire_keyset(lake: Lake, a: argparse.Namespace, scope: str, feed: DataFrame, sink: Callable[[DataFrame], None]) -> int:
    if a.source not in KEYSETS or a.offset is not None:
        print(f"keyset pages are for {', '.join(KEYSETS)}, without an offset", file=sys.stderr)
        return 2
    key = KEYSETS[a.source]
    schema = "source string, scope string, cursor array<string>"
    kept = lake.read("acquisition_keysets", schema)
    mine = kept.where((F.col("source") == a.source) & (F.col("scope") == scope)).first()
    durable = tuple(mine["cursor"]) if mine else None
    if a.cursor and durable:
        print("a durable cursor exists; it can't be set by hand", file=sys.stderr)
        return 2
    if len(key) == 2:
        fetch = lambda at, n: keys.keyset_after(feed, *key, at, n)
    else:
        row = feed.withColumn("__row", F.to_json(F.struct(*feed.columns)))
        fetch = lambda at, n: keys.keyset_through(row, key[0], "__row", at[0] if at else None, n).drop("__row")
    cursor = tuple(a.cursor.split(",")) if a.cursor else None
    for at in incremental.run_keyset_pages(fetch, sink, cursor, key, a.page_size, a.pages, durable=durable):
        if at is None:
            break
        others = lake.read("acquisition_keysets", schema).where(~((F.col("source") == a.source) & (F.col("scope") == scope)))
        lake.replace("acquisition_keysets", others.unionByName(lake.spark.createDataFrame([(a.source, scope, list(at))], schema)))
        print(json.dumps({"cursor": list(at)}))
    return 0


def stage(lake: Lake, a: argparse.Namespace) -> int:
    """Raw rows into the stage; replays add nothing."""
    raw = lake.spark.read.text(a.landed, wholetext=False).withColumnRenamed("value", "payload")
    staged = lake.read("staged", "payload string, row_id string, resolved_at string")
    new = incremental.stage(raw, staged)
    before = staged.count()
    lake.replace("staged", staged.unionByName(new))
    print(json.dumps({"inserted": lake.read("staged").count() - before}))
    return 0


def release(lake: Lake, a: argparse.Namespace) -> int:
    matches = lake.read("entity_matches").withColumn("method", F.lit("official_bbl_and_unit_label"))
    obs = upsert.with_columns_of(lake.read("observations"), {"bedrooms": "double", "bathrooms": "double"})
    src = _read(lake, "sources", SOURCES)
    tables = {"units.csv": lake.read("units").dropDuplicates(["unit_id"]), "unit_observations.csv": export.unit_observations(matches, obs), "sources.csv": src}
    print(json.dumps(export.release_parts(os.path.abspath(a.out) if "://" not in a.out else a.out, tables, a.now, a.release_id)))
    return 0


def report(lake: Lake, a: argparse.Namespace) -> int:
    out = export.quality_report({t: lake.read(t) for t in ("observations", "entity_matches", "units", "addresses")}, a.release_id or "unreleased", a.commit)
    print(json.dumps(out, indent=2))
    return 0


def health(lake: Lake, a: argparse.Namespace) -> int:
    """The number of feeds without rows is the exit code."""
    live = liveness(lake.read("listings", LISTINGS).where("status = 'active'"), sorted(registry.LISTING_FEEDS)).collect()
    down = [r for r in live if not r["live"]]
    if not a.quiet:
        for r in live:
            print(f"{'up' if r['live'] else 'DOWN':4} {r['source']} {r['rows']}")
    print(f"{len(live) - len(down)} of {len(live)} feeds have rows")
    if a.readme:
        with open(a.readme, encoding="utf-8") as f:
            text = f.read()
        block = export.status_block([(r["source"], r["rows"], r["live"]) for r in live], a.now[:10], *STATUS_MARKS)
        with open(a.readme, "w", encoding="utf-8") as f:
            f.write(export.with_block(text, block, *STATUS_MARKS))
    return len(down)


def new_feed(lake: Lake, a: argparse.Namespace) -> int:
    """A module with an empty feed, --source NAME --out FOLDER; a file that is there stays."""
    path = os.path.join(a.out or ".", f"{requests.feed_name(a.source)}.py")
    if os.path.exists(path):
        print(f"{path} exists", file=sys.stderr)
        return 1
    with open(path, "w", encoding="utf-8") as f:
        f.write(requests.feed_module(a.source))
    print(path)
    return 0


COMMANDS = {"scrape": scrape, "build_record": build_record, "catalog": catalog, "acquire": acquire, "stage": stage, "catalog_export": release, "catalog_report": report, "healthcheck": health, "merge": merge, "new_feed": new_feed}
STATUS_MARKS = ("<!-- feeds -->", "<!-- /feeds -->")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lotline", description=__doc__)
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("--db", required=True, help="folder of the tables")
    p.add_argument("--now", default=datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S"))
    p.add_argument("--pages", action="append", help="FEED=PATH of landed pages")
    p.add_argument("--rows", action="append", help="SOURCE=PATH of landed JSON rows")
    p.add_argument("--label", action="append", help="COLUMN:VALUE that the landing adds to pages")
    p.add_argument("--landed", help="path of landed rows")
    p.add_argument("--source", default="feed")
    p.add_argument("--out")
    p.add_argument("--release-id")
    p.add_argument("--readme", help="a file whose table of feeds healthcheck renews")
    p.add_argument("--commit")
    p.add_argument("--boro")
    p.add_argument("--slots", metavar="RUN")
    p.add_argument("--cursor", help="KEY[,KEY] to begin keyset pages at")
    for flag in ("list", "status", "dedupe", "keyset", "crosswalk", "portfolios", "coverage", "demote", "reconcile", "quiet"):
        p.add_argument(f"--{flag}", action="store_true")
    for number, default in (("limit", None), ("gaps", None), ("batch", None), ("offset", None), ("page-size", 50_000), ("pages-count", 1)):
        p.add_argument(f"--{number}", type=int, default=default, dest="page_count" if number == "pages-count" else None)
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    a = parser().parse_args(argv)
    if a.command == "acquire":
        a.pages = a.page_count
    return COMMANDS[a.command](Lake(spark or session.build(), a.db), a)


if __name__ == "__main__":
    sys.exit(main())
