import json

from lotline.__main__ import main
from lotline.lake import Lake


def run(spark, capsys, *argv):
    code = main([str(a) for a in argv], spark)
    return code, [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{") and x.endswith("}")]


def test_listings(spark, tmp_path, capsys):
    db, page = tmp_path / "db", tmp_path / "page.json"
    item = {"id": 5, "price": 372500, "address": "30 Main St, Astoria, NY 11102", "short_address": "30 Main St Unit: 8G"}
    page.write_text(json.dumps({"listings": [item, item | {"id": 6}]}))
    code, log = run(spark, capsys, "scrape", "--db", db, "--pages", f"nooklyn={page}", "--pages", "nosuch=x", "--now", "2026-01-01 00:00:00")
    assert code == 1 and log[0]["new_count"] == 2
    page.write_text(json.dumps({"listings": [item | {"price": 1}]}))
    code, log = run(spark, capsys, "scrape", "--db", db, "--pages", f"nooklyn={page}", "--now", "2026-01-02 00:00:00", "--dedupe", "--status")
    assert code == 0 and log[0]["updated_count"] == 1 and log[-1] == {"source": "nooklyn", "n": 1}
    got = {r["source_id"]: (r["status"], r["price"], r["first_seen"]) for r in Lake(spark, str(db)).read("listings").collect()}
    assert got == {"5": ("active", 0.01, "2026-01-01 00:00:00"), "6": ("inactive", 3725.0, "2026-01-01 00:00:00")}
    assert Lake(spark, str(db)).read("price_history").count() == 3
    assert run(spark, capsys, "healthcheck", "--db", db)[0] == 11


def test_records_and_catalog(spark, tmp_path, capsys):
    db, lots, rows = tmp_path / "db", tmp_path / "lots.json", tmp_path / "rows.json"
    lots.write_text(json.dumps([{"bbl": "3000120007.0", "borough": "BK", "block": "12", "lot": "7", "address": "5 MAIN STREET", "zipcode": "11201", "yearbuilt": "1900", "unitsres": "3", "unitstotal": "3", "bldgclass": "C", "latitude": "40", "longitude": "-73", "cd": "1", "ct2010": "1"}]))
    rows.write_text(json.dumps([{"violationid": "1", "boroid": "3", "block": "12", "lot": "7", "apartment": "6B", "housenumber": "5", "streetname": "MAIN STREET", "zip": "11201", "novissueddate": None, "inspectiondate": "2026-01-05T00", "violationstatus": "Open", "class": "B", "novdescription": "x", "currentstatus": "s"}]))
    assert run(spark, capsys, "build_record", "--db", db, "--rows", f"pluto={lots}", "--crosswalk", "--portfolios")[0] == 0
    code, out = run(spark, capsys, "build_record", "--db", db, "--rows", f"hpd_violations={rows}", "--rows", f"hpd_violations={rows}", "--status")
    assert out[0] == {"event_type": "violation", "n": 1}
    code, out = run(spark, capsys, "catalog", "--db", db, "--rows", f"hpd_violations={rows}", "--gaps", 5, "--slots", "r", "--status")
    assert out[0]["unnamed"] == 2 and {"metric": "observations", "n": 1} in out
    assert Lake(spark, str(db)).read("housing_capacity_slots").count() == 3
    code, out = run(spark, capsys, "catalog_export", "--db", db, "--out", tmp_path / "rel")
    assert out[0]["files"]["unit_observations.csv"]["rows"] == 1
    assert main(["catalog_report", "--db", str(db)], spark) == 0


def table(spark, db, name, *drop):
    d = Lake(spark, str(db)).read(name).drop(*drop)
    return sorted(map(str, d.select(*sorted(d.columns)).collect()))


def test_a_repeated_catalog_run_changes_nothing(spark, tmp_path, capsys):
    db, rows, sheet = tmp_path / "db", tmp_path / "rows.json", tmp_path / "sheet.json"
    one = {"violationid": "1", "boroid": "3", "block": "12", "lot": "7", "apartment": "6B", "housenumber": "5", "streetname": "MAIN STREET"}
    rows.write_text(json.dumps([one, one | {"violationid": "2", "apartment": "Apt 6-b"}, one | {"violationid": "3", "apartment": None}, one | {"violationid": "1", "apartment": "7"}]))
    sheet.write_text(json.dumps([{"listing_id": "x", "address": "5 Main Street", "unit": "9"}]))
    args = ["catalog", "--db", db, "--rows", f"hpd_violations={rows}", "--rows", f"ose_str_snapshot={sheet}", "--now", "2026-01-01 00:00:00"]
    assert run(spark, capsys, *args)[0] == 0
    names = ["source_documents", "observations", "buildings", "addresses", "units", "entity_matches", "candidates", "sources"]
    first = {n: table(spark, db, n) for n in names}
    assert [len(first[n]) for n in names] == [4, 4, 1, 1, 3, 8, 0, 2]
    assert run(spark, capsys, *args)[0] == 0
    assert {n: table(spark, db, n) for n in names} == first
    assert run(spark, capsys, *args[:-1], "2026-01-01 09:00:00")[0] == 0
    again = {n: table(spark, db, n, "last_seen", "matched_at", "document_id") for n in names}
    assert len(again.pop("source_documents")) == 8
    assert all(len(again[n]) == len(first[n]) for n in again)
    assert {r["first_seen"] for r in Lake(spark, str(db)).read("units").collect()} == {"2026-01-01 00:00:00"}


def test_a_repeated_merge_changes_nothing(spark, tmp_path, capsys):
    db = tmp_path / "db"
    lake = Lake(spark, str(db))
    lake.replace("addresses", spark.createDataFrame([("1", "5 MAIN ST", None)], "bbl string, normalized string, zipcode string"))
    lake.replace("units", spark.createDataFrame([("u1", "1", "two", "2", "2025", "2025")], "unit_id string, bbl string, unit_label string, normalized_unit string, first_seen string, last_seen string"))
    rows = tmp_path / "a.json"
    rows.write_text(json.dumps([{"address": "5 Main St", "unit": "2", "source_ref": "r"}, {"address": "5 Main St", "unit": "3", "source_ref": "s"}]))
    args = ["merge", "--db", db, "--rows", f"a={rows}", "--now", "2026-01-01 00:00:00"]
    run(spark, capsys, *args)
    first = {n: table(spark, db, n) for n in ("units", "observations", "entity_matches")}
    assert [len(x) for x in first.values()] == [2, 2, 4]
    stored = {r["normalized_unit"]: (r["unit_id"], r["unit_label"], r["first_seen"], r["last_seen"]) for r in lake.read("units").collect()}
    assert stored["2"] == ("u1", "two", "2025", "2026-01-01 00:00:00")
    assert {r["entity_id"] for r in lake.read("entity_matches").where("entity_type = 'unit'").collect()} == {x[0] for x in stored.values()}
    run(spark, capsys, *args)
    assert {n: table(spark, db, n) for n in first} == first


def test_keyset_pages_go_on_from_a_durable_cursor(spark, tmp_path, capsys):
    db, rows = tmp_path / "db", tmp_path / "rows.json"
    rows.write_text(json.dumps([{"received_date": f"2026-01-0{i // 2 + 1}", "problem_id": str(i)} for i in range(7)]))
    args = ["acquire", "--db", db, "--source", "hpd_problems", "--landed", rows, "--page-size", 3, "--keyset"]
    assert run(spark, capsys, *args)[1] == [{"cursor": ["2026-01-03", "4"]}]
    assert run(spark, capsys, *args, "--cursor", "2026-01-01,0")[0] == 2
    assert run(spark, capsys, *args, "--pages-count", 5)[1] == [{"cursor": ["2026-01-01", "1"]}, {"cursor": ["2026-01-01", "0"]}]
    assert sorted(r["problem_id"] for r in Lake(spark, str(db)).read("landed_hpd_problems").collect()) == [str(i) for i in range(7)]
    assert run(spark, capsys, "acquire", "--db", db, "--source", "s", "--landed", rows, "--keyset")[0] == 2


def test_slots_in_batches(spark, tmp_path, capsys):
    db = tmp_path / "db"
    lake = Lake(spark, str(db))
    lake.replace("buildings", spark.createDataFrame([(str(i), i % 3) for i in range(7)], "bbl string, units_res long"))
    for _ in range(5):
        run(spark, capsys, "catalog", "--db", db, "--slots", "r", "--batch", 2)
    assert lake.read("housing_capacity_slots").count() == sum(i % 3 for i in range(7))
    assert lake.read("capacity_runs").collect()[0]["completed"]


def test_tables_change_together(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "db"))
    one = lambda x: spark.createDataFrame([(x,)], "x int")
    lake.replace_all({"a": one(1), "b": one(2)})
    old = lake.read("a")
    lake.replace_all({"a": lake.read("b"), "b": lake.read("a")})
    assert (lake.read("a").first()[0], lake.read("b").first()[0], old.first()[0]) == (2, 1, 1)
    lake.append("a", one(3))
    lake.append("c", one(4))
    assert lake.read("a").count() == 2 and lake.has("c") and not lake.has("d")
    for i in range(3):
        lake.replace("a", one(i))
    assert sum(x.name.startswith("a-") for x in (tmp_path / "db").iterdir()) == 2


def test_pages_and_stage(spark, tmp_path, capsys):
    db, rows = tmp_path / "db", tmp_path / "rows.json"
    rows.write_text(json.dumps([{"id": str(i)} for i in range(7)]))
    args = ["acquire", "--db", db, "--source", "s", "--landed", rows, "--page-size", 3, "--pages-count", 2]
    assert [x["rows"] for x in run(spark, capsys, *args)[1]] == [3, 3] and [x["rows"] for x in run(spark, capsys, *args)[1]] == [1] and run(spark, capsys, *args)[1] == []
    lines = tmp_path / "lines.txt"
    lines.write_text("a\nb\na\n")
    assert [run(spark, capsys, "stage", "--db", db, "--landed", lines)[1] for _ in range(2)] == [[{"inserted": 2}], [{"inserted": 0}]]


def test_reconcile_demote_and_merge(spark, tmp_path, capsys):
    db = tmp_path / "db"
    lake = Lake(spark, str(db))
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    lake.replace("observations", frame([("l", "listing", "1", "5 Main Street", "6B", "x"), ("v", "hpd_violations", "2", "5 MAIN ST", "6b", "x"), ("m", "archive", "3", "9 MAIN ST", "1", "text_mined")], "observation_id string, source string, source_ref string, address string, unit_label string, raw_fields string"))
    claim = "observation_id string, entity_type string, entity_id string, status string, confidence double, rationale string, matched_at string"
    lake.replace("entity_matches", frame([("l", "building", None, "ambiguous", 0.0, "", ""), ("l", "unit", None, "ambiguous", 0.0, "", ""), ("v", "building", "1", "resolved", 1.0, "", ""), ("v", "unit", "u1", "resolved", 1.0, "", ""), ("m", "unit", "u2", "resolved", 0.8, "", "")], claim))
    lake.replace("candidates", frame([("l", "building", "1"), ("l", "building", "2")], "observation_id string, entity_type string, candidate_id string"))
    lake.replace("units", frame([("u1", "1"), ("u2", "9")], "unit_id string, bbl string"))
    assert run(spark, capsys, "catalog", "--db", db, "--reconcile", "--demote")[1] == [{"settled": 1}]
    got = {(r["observation_id"], r["entity_type"]): (r["entity_id"], r["status"], r["confidence"]) for r in lake.read("entity_matches").collect()}
    assert got[("l", "unit")] == ("u1", "resolved", 0.98) and got[("l", "building")][0] == "1" and got[("m", "unit")] == (None, "unresolved", 0.0)
    assert [r["unit_id"] for r in lake.read("units").collect()] == ["u1"]
    # the edges outlive the next run, which finds nothing open
    edges = sorted(map(tuple, lake.read("entity_match_evidence").collect()))
    assert edges == [("l", k, "v", "corroborates_candidate") for k in ("building", "unit")]
    assert run(spark, capsys, "catalog", "--db", db, "--reconcile")[1] == [{"settled": 1}]
    assert sorted(map(tuple, lake.read("entity_match_evidence").collect())) == edges
    # and a third run adds what is new
    more = [("l2", "listing", "9", "5 Main Street", "6B", "x")]
    lake.append("observations", frame(more, "observation_id string, source string, source_ref string, address string, unit_label string, raw_fields string"))
    lake.append("entity_matches", frame([("l2", "building", None, "ambiguous", 0.0, "", "")], claim))
    lake.append("candidates", frame([("l2", "building", "1"), ("l2", "building", "2")], "observation_id string, entity_type string, candidate_id string"))
    assert run(spark, capsys, "catalog", "--db", db, "--reconcile")[1] == [{"settled": 2}]
    assert lake.read("entity_match_evidence").count() == 4
    lake.replace("addresses", frame([("1", "5 MAIN ST", None)], "bbl string, normalized string, zipcode string"))
    rows = tmp_path / "a.json"
    rows.write_text(json.dumps([{"address": "5 Main St", "unit": "2", "source_ref": "r"}, {"address": "x", "unit": "2", "source_ref": "q"}]))
    assert sorted((r["path"], r["n"]) for r in run(spark, capsys, "merge", "--db", db, "--rows", f"a={rows}")[1]) == [("units", 1), ("unresolved", 1)]
