import io
import json
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from lotline.sources import landing, listings, records, registry


def pages(spark, *texts, **columns):
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    return d.select("text", *[F.lit(v).alias(k) for k, v in columns.items()])


def only(df):
    (r,) = df.collect()
    return r


def test_map_markers(spark):
    page = 'new Map({ markers: [{"listing_id": 7, "address": "160 Johnson Avenue - 2A, Brooklyn, NY 11206", "unit_specs": "3 bd, 2 ba, 1,250 Sq. Ft.", "rent_range": "$2,000 - $2,500", "latitude": 40.1, "longitude": -73.9}] })'
    r = only(listings.appfolio(pages(spark, page, "<html>", label="L", subdomain="s")))
    assert (r["source_id"], r["address"], r["unit_number"], r["bedrooms"], r["price"], r["sqft"], r["borough"], r["zipcode"]) == ("appfolio-s-7", "160 Johnson Avenue", "2A", 3.0, 2000.0, 1250.0, "Brooklyn", "11206")


def test_unit_api(spark):
    unit = {"unitId": "u", "communityName": "C", "unitName": "9", "bedroomNumber": 1, "address": {"addressLine1": "343 Gold Street Apartment 1816", "city": "Astoria", "state": "NY", "zip": "1"}, "startingAtPricesUnfurnished": {"prices": {"price": 3000}}, "availableDateFurnished": "2026-01-02T00", "floorPlan": {"highResolution": "/x.png"}}
    r = only(listings.avalonbay(pages(spark, json.dumps({"items": [unit, unit | {"address": {"state": "NJ"}}]}))))
    assert (r["address"], r["unit_number"], r["price"], r["borough"], r["available_date"], r["floor_plan_url"]) == ("343 Gold Street", "1816", 3000.0, "Queens", "2026-01-02", "https://www.avalonbay.com/x.png")


def test_broker_api(spark):
    item = {"listingId": "1", "listingStatus": "Active", "address1": "5 Main St", "address2": "2", "price": 100.0, "totalBathrooms": 0, "bathrooms": 2, "listingAgency": "X"}
    d = listings.corcoran(pages(spark, json.dumps({"items": [item, item | {"listingId": "2", "closedRentedDate": "2020"}, item | {"listingId": "3", "listingStatus": "Closed"}, item | {"listingId": None}]})))
    r = only(d)
    assert (r["source_id"], r["bathrooms"], r["lease_terms"], r["description"]) == ("1", 2.0, '[{"term":"annual","price":100.0}]', "Listed by X")


def test_cards(spark):
    row = lambda u, t: f'<tr data-unitid="{u}" data-title="{t}" data-available-date="2026-01-01" data-all-dhcr-units="True"><td data-th="Sqft">1,020</td><option value="24">24 Months (3,310.00 USD)</option><option value="12">12 Months (3500.00 USD)</option>'
    html = f'x<h4 class="pc-card-title">2 Bed 2 Bath</h4>{row(1, "A")}{row(2, "B")}<h4 class="pc-card-title">More</h4>{row(3, "C")}<h4 class="pc-card-title">Studio 1 Bath</h4>{row(4, "D")}'
    got = sorted((r["source_id"], r["unit_number"], r["bedrooms"], r["bathrooms"], r["price"], r["sqft"], r["is_rent_stabilized"]) for r in listings.durst(pages(spark, html, id="p", name="N", address="A", hood="H", boro="B")).collect())
    assert got == [(f"durst-p-{i}", t, b, ba, 3500.0, 1020.0, 1) for i, t, b, ba in ((1, "A", 2.0, 2.0), (2, "B", 2.0, 2.0), (3, "C", 2.0, 2.0), (4, "D", 0.0, 1.0))]


def test_mls_api(spark):
    item = {"coreListingId": "1", "listingStatus": "Active", "listPrice": 10.0, "address": {"samlsFullAddress": "211 W 10th St 2B, New York, NY 10014"}, "images": [{"url": "a"}, {"url": None}]}
    d = pages(spark, json.dumps([item, item | {"listPrice": 11.0}, item | {"coreListingId": "2", "closePrice": 5.0}]), borough="Manhattan", page_no=1)
    r = only(listings.elliman(d))
    assert (r["address"], r["unit_number"], r["zipcode"], r["price"], r["image_urls"]) == ("211 W 10th St", "2B", "10014", 10.0, '["a"]')
    b = listings.crawl_buckets(spark.createDataFrame([("x", 300), ("y", 12)], "borough string, ids int"))
    assert b.where("borough = 'x'").count() == 7 and b.where("borough = 'y'").count() == 1


def test_two_hops(spark):
    ids = listings.glenwood_ids(pages(spark, "?lid=1 &lid=2 ?lid=1", name="N", addr="A", hood="Riverdale"))
    assert ids.count() == 2
    details = spark.createDataFrame([("1", '<p class="pprice">212.535.0500</p><p class="pprice">2 BR 1.5 Bath</p><p class="pprice">4,500</p><div class="a listing-description">An <b>apt</b></div>'), ("2", "nothing")], "lid string, text string")
    r = only(listings.glenwood(ids, details))
    assert (r["bedrooms"], r["bathrooms"], r["price"], r["borough"], r["description"]) == (2.0, 1.5, 4500.0, "Bronx", "An apt")


def test_marketplace(spark):
    r = only(listings.nooklyn(pages(spark, json.dumps({"listings": [{"id": 5, "price": 372500, "address": "30 Main St, Astoria, NY 11102", "short_address": "30 Main St Unit: 8G", "neighborhood": {"name": "Astoria"}, "date_available": "2026-01-02T0"}]}))))
    assert (r["price"], r["borough"], r["unit_number"], r["zipcode"], r["available_date"]) == (3725.0, "Queens", "8G", "11102", "2026-01-02")


def test_row_pattern(spark):
    html = '<td data-th="Unit"><span>16J</span><a data-alt="2 Beds/2.5 Baths for the plan"></a></td><td data-th="Sqft">1,100</td><td data-th="Available">Now</td><i data-rent-range="9,890.00 – 11,665.00"></i><button data-unitid=" 7 " data-unit-address=" 5 Main " data-available-date="2026-01-02">'
    r = only(listings.ogdencap(pages(spark, html, code="c", name="N", hood="H", boro="B")))
    assert (r["source_id"], r["unit_number"], r["bedrooms"], r["bathrooms"], r["price"], r["sqft"], r["address"]) == ("ogdencap-c-7", "16J", 2.0, 2.5, 9890.0, 1100.0, "5 Main")


def test_plans(spark):
    html = "<caption>Apartment Details Floor Plan: A - 1 Bedroom, 1 Bathroom</caption><th data-label='Apartment'>#5A</th><td data-label=Sq.Ft.>700</td><td data-label='Rent'>$3,100</td><a id='5A' onclick='ApplyNowClick(1,2,3,\"01/02/2026\")'>"
    r = only(listings.securecafe(pages(spark, html, subdomain="s", label="L", address="A", hood="H", boro="B")))
    assert (r["source_id"], r["bedrooms"], r["price"], r["sqft"], r["available_date"]) == ("sc-s-5A", 1.0, 3100.0, 700.0, "01/02/2026")


def test_codes_and_collections(spark):
    d = listings.stonehenge(pages(spark, json.dumps([{"value": "v", "label": "1 Bedroom | Bath 1.0 | Apt 015M | $4945"}]), code="A", label="B"), {"A": "5 Main"})
    assert (only(d)["address"], only(d)["unit_number"], only(d)["price"]) == ("5 Main", "015M", 4945.0)
    assert only(listings.stonehenge(pages(spark, json.dumps([{"value": "v", "label": ""}]), code="Z", label="B"), {"A": "5 Main"}))["address"] is None
    unit = {"unitSpk": "s", "isAvailable": True, "isCapped": True, "property": {"name": "P"}, "building": {"name": "B", "address": "A"}, "unitRates": {"24": 2.0, "12": 1.0}, "price": 9.0}
    r = only(listings.stuytown(pages(spark, json.dumps({"unitModels": [unit, unit | {"isAvailable": False}]})), {"P": ("H", "M")}))
    assert (r["building_name"], r["lease_terms"], r["neighborhood"], r["is_rent_stabilized"]) == ("P — B", '[{"term":"12 months","price":1.0},{"term":"24 months","price":2.0}]', "H", 1)
    data = {"Units": {"Data": [{"Code": "1", "PropertyCode": "p", "IsListed": True, "Apartment": "4", "Images": [{"FullUrl": "f"}, "g"]}, {"Code": "2", "IsListed": False}]}, "Properties": {"Data": [{"Code": "p", "Name": "N", "Address": "A", "Latitude": "40.5", "City": "Astoria"}]}}
    r = only(listings.tfcornerstone(pages(spark, json.dumps(data))))
    assert (r["building_name"], r["latitude"], r["borough"], r["image_urls"]) == ("N", 40.5, "Queens", '["f","g"]')


def test_liveness(spark):
    d = listings.union_feeds(listings.nooklyn(pages(spark, json.dumps({"listings": [{"id": 5}]}))), listings.avalonbay(pages(spark, "{}")))
    assert [(r["source"], r["live"]) for r in listings.liveness(d, ["nooklyn", "avalonbay"]).collect()] == [("avalonbay", False), ("nooklyn", True)]


def frame(spark, *data):
    fields = sorted({k for r in data for k in r})
    return spark.createDataFrame([tuple(r.get(k) for k in fields) for r in data], ", ".join(f"{k} {'int' if k == 'arrival' else 'string'}" for k in fields))


def test_record_feeds(spark):
    v = frame(spark, {"boroid": "1", "block": "1", "lot": "1", "novissueddate": "", "inspectiondate": "2026-01-02T", "class": "B", "novdescription": " x ", "currentstatus": "s"}, {"boroid": "8", "block": "1", "lot": "1"})
    e = records.violations(v)
    assert [tuple(r) for r in e.collect()] == [("1000010001", "violation", "2026-01-02", "hpd_violations", None, "s", "Class B x")]
    assert tuple(records.rolled(e, "violation").first()) == ("1000010001", 1, "2026-01-02")
    p = records.permits(frame(spark, {"borough": "Queens", "block": "1", "lot": "2", "issuance_date": "2/6/2026", "filing_date": None, "job_type": "A1", "permit_type": "", "work_type": "OT"}))
    assert tuple(p.first())[:3] == ("4000010002", "permit", "2026-02-06") and p.first()["detail"] == "A1 / OT"
    m = frame(spark, {"document_id": "d", "doc_type": "DEED", "document_amt": "0", "recorded_datetime": "2026-01-01T", "document_date": None}, {"document_id": "e", "doc_type": "MTGE", "document_amt": "5", "recorded_datetime": "2026", "document_date": None})
    l = frame(spark, {"document_id": "d", "borough": "1", "block": "1", "lot": "1"}, {"document_id": "d", "borough": "2", "block": "1", "lot": "1"})  # noqa: E741
    assert sorted(r["bbl"] for r in records.acris_sales(m, l).collect()) == ["1000010001", "2000010001"] and records.acris_sales(m, l, 2).count() == 1
    assert records.acris_sales(m, l).first()["amount"] is None
    cw = spark.createDataFrame([("5 MAIN ST", "1000010001", "X", "1")], "norm_address string, bbl string, borough string, zipcode string")
    c = frame(spark, {"house_number": "5", "house_street": "MAIN STREET", "zip_code": "9", "date_entered": "1/2/2026", "complaint_category": "05", "status": "ACTIVE"}, {"house_number": "", "house_street": "X"})
    assert records.dob_complaints(c, cw).first()["detail"] == "category 05 / ACTIVE" and records.dob_complaints(c, cw, 2).count() == 0
    s = frame(spark, {"bbl": " 1000010009", "incident_address": "5 Main St", "incident_zip": "1", "created_date": "2026-01-01", "status": "Open", "complaint_type": "HEAT"}, {"bbl": None, "incident_address": "5 Main St", "incident_zip": "1", "created_date": None, "status": " ", "complaint_type": "HEAT"})
    got = records.rolled(records.requests(s, cw), "311").orderBy("bbl").collect()
    assert [(r["bbl"], r["sr311_open"]) for r in got] == [("1000010001", 0), ("1000010009", 1)]
    ev = frame(spark, {"eviction_address": "5 Main Street", "eviction_zip": "1", "executed_date": "2026-01-01", "residential_commercial_ind": "R", "eviction_apt_num": "2", "bbl": "zzz"})
    assert tuple(records.evictions(ev, cw).first())[0] == "1000010001" and records.evictions(ev, cw).first()["detail"] == "R / apt 2"
    r = frame(spark, {"ucbbl": "1000010001", "unitsstab2017": "5", "j51": "", "a421": ""}, {"ucbbl": "1000010002", "unitsstab2017": "0", "j51": "2010 - 2017", "a421": "x"}, {"ucbbl": "1000010003", "unitsstab2017": "", "j51": "", "a421": " "}, {"ucbbl": "12", "unitsstab2017": "5", "j51": "", "a421": ""})
    assert sorted((x["bbl"], x["rent_stab_units"], x["rent_stab_status"]) for x in records.rent_stabilization(r).collect()) == [("1000010001", 5, "registered"), ("1000010002", None, "j51-proxy (2010 - 2017)")]
    b = records.pluto(frame(spark, {"bbl": "2054800111.00000000", "borough": "BX", "block": "5480", "lot": "111.0", "address": "a", "zipcode": "z", "yearbuilt": "0", "unitsres": "3", "unitstotal": "x", "bldgclass": "A", "latitude": "40.5", "longitude": None, "cd": "1", "ct2010": "5"})).first()
    assert (b["bbl"], b["borough"], b["lot"], b["year_built"], b["units_res"], b["units_total"]) == ("2054800111", "BRONX", 111, None, 3, None)


def test_registrations(spark):
    regs = frame(spark, {"registrationid": "1", "boroid": "9", "block": "1", "lot": "1", "arrival": 0}, {"registrationid": "2", "boroid": "9", "block": "1", "lot": "1", "arrival": 1}, {"registrationid": "3", "boroid": "x", "block": "1", "lot": "1", "arrival": 2})
    base = {f"business{n}": None for n in ("housenumber", "streetname", "apartment", "city", "state", "zip")}
    contacts = frame(spark, base | {"registrationid": "2", "type": "Agent", "corporationname": "AGENT", "firstname": None, "lastname": None, "arrival": 0}, base | {"registrationid": "2", "type": "HeadOfficer", "corporationname": "", "firstname": "A", "lastname": "B", "arrival": 1, "businesshousenumber": "5", "businessstreetname": "MAIN"}, base | {"registrationid": "1", "type": None, "corporationname": "OLD", "firstname": None, "lastname": None, "arrival": 2})
    assert [tuple(r) for r in records.registrations(regs, contacts).collect()] == [("9000010001", "A B", "5 MAIN")]


def test_readers(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "1.json").write_text(json.dumps([{"a": 1, "b": "x"}, {"a": None}]))
    assert sorted(map(tuple, landing.feed_rows(spark, str(tmp_path / "feed"), ["a", "b"]).collect()), key=repr) == [("1", "x"), (None, None)]
    assert landing.feed_rows(spark, str(tmp_path / "feed"), ["a"], where=F.col("a").isNotNull(), limit=1).count() == 1
    (tmp_path / "p.html").write_bytes(b"ok \xff")
    assert landing.pages(spark, str(tmp_path / "p.html")).first()["text"].startswith("ok ")
    (tmp_path / "c.csv").write_text("a,b\n1,2\n3\n4,5,6\n")
    assert landing.csv_rows(spark, str(tmp_path / "c.csv"), ["a"]).count() == 3
    with pytest.raises(ValueError, match="lacks"):
        landing.csv_rows(spark, str(tmp_path / "c.csv"), ["z"])
    assert [tuple(r) for r in landing.fixed_csv(spark, str(tmp_path / "c.csv"), ["a", "b"]).collect()] == [("1", "2"), ("3", None), ("4", "5")]
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("bobaadr.txt", "boro,stname,x\n1,CAFÉ ST,\n2,B ST,q\n".encode("latin-1"))
    (tmp_path / "pad.zip").write_bytes(z.getvalue())
    got = landing.zipped_csv(spark, str(tmp_path / "pad.zip"), "bobaadr.txt", ["stname", "boro", "lacking"]).collect()
    assert [tuple(r) for r in got] == [("CAFÉ ST", "1", "", 0), ("B ST", "2", "", 1)]
    assert landing.file_provenance(spark, str(tmp_path / "c.csv")).first()["sha256"]


def test_workbook(spark, tmp_path):
    sheet = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row><c r="A1" t="inlineStr"><is><t>Listing ID</t></is></c><c r="C1" t="s"><v>0</v></c></row><row><c r="A2"><v>12</v></c><c r="B2"><v>9</v></c><c r="C2" t="s"><v>1</v></c></row><row><c r="C3" t="inlineStr"><is><t>z</t></is></c></row></sheetData></worksheet>'
    shared = '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>Unit</t></si><si><r><t>6</t></r><r><t>B</t></r></si></sst>'
    with zipfile.ZipFile(tmp_path / "s.xlsx", "w") as f:
        f.writestr("xl/worksheets/sheet1.xml", sheet)
        f.writestr("xl/sharedStrings.xml", shared)
    got = landing.xlsx_rows(spark, str(tmp_path / "s.xlsx"), {"Listing ID": "listing_id", "Unit": "unit"}).collect()
    assert [(r["listing_id"], r["unit"], r["row_no"]) for r in got] == [("12", "6B", 2), ("", "z", 3)] and len(got[0]["file_sha256"]) == 64


def test_registries():
    assert len(registry.LISTING_FEEDS) == 12 and len(registry.RECORD_FEEDS) == 12 and len(registry.IMPORTERS) == 15
    assert registry.discover("lotline.streaming") == {}


def test_paged_feed(spark, tmp_path):
    from lotline.sources import paged

    paged.register(spark)
    for offset in (0, 3, 6):
        (tmp_path / f"{offset}-3.json").write_text(json.dumps([{"id": i, "name": f"n{i}", "more": {"x": 1}} for i in range(offset, min(offset + 3, 8))]))
    (tmp_path / "3-2.json").write_text(json.dumps([{"id": 3}, {"id": 4}]))
    read = spark.read.format("paged_feed").option("url", f"file://{tmp_path}/{{offset}}-{{limit}}.json").option("fields", "id, name,more").option("page_size", 3).option("pause", 0)
    got = read.load()
    assert got.count() == 8 and tuple(got.orderBy("id").first()) == ("0", "n0", '{"x": 1}')
    assert sorted(r["id"] for r in read.option("limit", 5).load().collect()) == ["0", "1", "2", "3", "4"]
    side = spark.read.format("paged_feed").option("url", f"file://{tmp_path}/{{offset}}-{{limit}}.json").option("fields", "id").option("page_size", 3).option("pages", 3).load()
    assert side.rdd.getNumPartitions() == 3 and side.count() == 8
    with pytest.raises(OSError):
        paged.fetch(f"file://{tmp_path}/none.json", retries=2, pause=0)


def test_pages_at_a_plain_path(spark, tmp_path):
    """Names that a URL would code are taken as they are."""
    from lotline.sources import paged

    paged.register(spark)
    at = tmp_path / "a b%20c"
    at.mkdir()
    (at / "count.json").write_text('[{"count": 3}]')
    for page, ids in ((1, [1, 2]), (2, [3])):
        (at / f"x = 'y' {page}.json").write_text(json.dumps([{"id": i} for i in ids]))
    for url in (str(at), paged.folder_url(str(at)), paged.folder_url(f"file:{at}"), paged.folder_url(f"file://{at}")):
        d = spark.read.format("paged_feed").option("url", url + "/{order} {page}.json").option("count", url + "/count.json").option("fields", "id").option("page_size", 2).option("order", "x = 'y'")
        assert sorted(r["id"] for r in d.load().collect()) == ["1", "2", "3"]
    with pytest.raises(FileNotFoundError):
        paged.fetch(f"{at}/none.json", retries=2, pause=0)


def test_no_page_of_a_counted_feed_is_left_out(tmp_path, monkeypatch):
    """However many pages a feed has, tasks read them all; a broken page of a task's run hides no other."""
    from pyspark.sql.types import StringType, StructField, StructType

    from lotline.sources import paged

    schema = lambda *names: StructType([StructField(n, StringType()) for n in names])
    many = paged.PagedReader(schema("id"), {"url": "", "count": f'data:,[{{"count": {10 * paged.MAX_PAGES + 1}}}]', "page_size": "10"}).partitions()
    assert [x for p in many for x in range(p.first, p.first + p.count)] == list(range(paged.MAX_PAGES + 1))
    monkeypatch.setattr(paged, "MAX_TASKS", 3)
    for page in (1, 2, 3, 5):
        (tmp_path / f"{page}.json").write_text(json.dumps([{"id": page * 2 - 1}, {"id": page * 2}][: 11 - page * 2]))
    options = {"url": f"{tmp_path}/{{page}}.json", "count": 'data:,[{"count": 9}]', "page_size": "2", "retries": "1"}
    reader = paged.PagedReader(schema("id", "_page_error"), options)
    got = [[r[0] or r[1][:7] for r in reader.read(p)] for p in reader.partitions()]
    assert got == [["1", "2", "3", "4"], ["5", "6", "page 4:"], ["9"]]


@pytest.mark.parametrize("name", ["s15_counted_pages", "t05_paged_stream"])
def test_queries_of_pages_in_a_plain_checkpoint_folder(spark, tmp_path, monkeypatch, name):
    import pyarrow.parquet as pq

    from lotline.plans import catalog, queries_scale

    events = tmp_path / "events.parquet"
    spark.createDataFrame([(i, ("click", "view", "purchase")[i % 3]) for i in range(2500)], "event_id long, event_type string").write.parquet(str(events))
    monkeypatch.setattr(queries_scale, "scratch", lambda spark, kind: str(tmp_path / f"a b%20c/{kind}"))
    got = sorted(tuple(r) for r in catalog.QUERIES[name](spark, str(tmp_path)).collect())
    rows = pq.read_table(str(events)).to_pylist()
    assert got == sorted((str(r["event_id"]), r["event_type"]) for r in rows if name.startswith("t") or r["event_type"] != "view")


class Service:
    """A feed behind HTTP: equality in where, offset and limit, counts; it keeps the requests."""

    def __init__(self, rows):
        import http.server
        import threading
        from urllib.parse import parse_qs, urlsplit

        self.rows, self.asked, self.broken = rows, [], set()
        outer = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def answer(self, q):
                q = {k: v[0] for k, v in q.items()}
                outer.asked.append(q)
                rows = outer.rows
                for term in q.get("where", "").split(" AND "):
                    if m := re.fullmatch(r"(\w+) = '(.*)'", term):
                        rows = [r for r in rows if str(r.get(m[1])) == m[2]]
                if q.get("count"):
                    body = [{"count": str(len(rows))}]
                else:
                    at, n = int(q["offset"]), int(q["limit"])
                    if at in outer.broken:
                        self.send_response(500)
                        self.end_headers()
                        return
                    names = q["select"].split(",") if q.get("select") else None
                    body = [{k: v for k, v in r.items() if names is None or k in names} for r in rows[at : at + n]]
                    if q.get("paged"):
                        body = {"items": body, "pages": -(-len(rows) // n)}
                data = json.dumps(body).encode()
                self.send_response(200)
                self.end_headers()
                self.wfile.write(data)

            def do_GET(self):
                self.answer(parse_qs(urlsplit(self.path).query))

            def do_POST(self):
                q = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                self.answer({k: [str(v)] for k, v in q.items()})

            def log_message(self, *a):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.base = f"http://127.0.0.1:{self.server.server_port}/"
        self.url = self.base + "?offset={offset}&limit={limit}&where={where}&select={select}&order={order}"
        self.count = self.base + "?count=1&where={where}"


@pytest.fixture
def service():
    s = Service([{"id": f"{i:03}", "boro": "12345"[i % 5], "name": f"it's {i}", "unused": "x" * 50} for i in range(47)])
    yield s
    s.server.shutdown()


def feed(spark, service, **options):
    from lotline.sources import paged

    paged.register(spark)
    r = spark.read.format("paged_feed").option("url", service.url).option("fields", "id,boro").option("page_size", 5).option("pause", 0)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def test_filters_and_columns_reach_the_feed(spark, service):
    d = feed(spark, service, count=service.count)
    got = sorted(r["id"] for r in d.where("boro = '3' AND id >= '010' AND id <> '012'").collect())
    want = [f"{i:03}" for i in range(47) if i % 5 == 2 and i >= 10 and i != 12]
    assert got == want
    sent = [q for q in service.asked if not q.get("count")]
    assert sent and all("boro = '3'" in q["where"] and "id >= '010'" in q["where"] and q["select"] == "id,boro" for q in sent)
    counts = [q for q in service.asked if q.get("count")]
    assert counts and all("boro = '3'" in q["where"] for q in counts)
    # 9 rows have that boro: as many tasks as pages of them
    assert len({q["offset"] for q in sent}) == 2
    service.asked.clear()
    plain = feed(spark, service, count=service.count, pushdown="false")
    assert sorted(r["id"] for r in plain.where("boro = '3' AND id >= '010' AND id <> '012'").collect()) == want
    assert all("boro" not in q.get("where", "") for q in service.asked)


def test_clauses():
    from pyspark.sql import datasource as D

    from lotline.sources.paged import clause

    assert clause(D.EqualTo(("name",), "it's")) == "name = 'it''s'"
    assert clause(D.In(("boro",), ("1", "2"))) == "boro IN ('1', '2')" and clause(D.In(("boro",), ("1", None))) is None
    assert clause(D.Not(D.IsNull(("a_b",)))) == "NOT (a_b IS NULL)" and clause(D.StringStartsWith(("bbl",), "3")) == "starts_with(bbl, '3')"
    assert clause(D.EqualTo(("x; drop",), "1")) is None and clause(D.EqualTo(("s", "x"), "1")) is None and clause(D.StringContains(("x",), "1")) is None


def test_page_count_from_the_first_answer_and_broken_pages(spark, service):
    body = json.dumps({"offset": "{offset}", "limit": "{limit}", "paged": "1"})
    d = feed(spark, service, url=service.base, body=body, rows_field="items", page_count_field="pages", fields="id,_page_error", retries=2)
    assert d.count() == 47 and d.rdd.getNumPartitions() == 10
    service.broken.add(10)
    rows = d.collect()
    assert len([r for r in rows if r["id"]]) == 42 and [r["_page_error"][:8] for r in rows if r["_page_error"]] == ["page 3: "]
    with pytest.raises(Exception, match="500"):
        feed(spark, service, url=service.base, body=body, rows_field="items", page_count_field="pages", fields="id", retries=1).count()


def test_a_stream_that_dies_after_its_write_repeats_no_row(spark, service, tmp_path):
    from lotline.sources import paged
    from lotline.streaming import incremental

    paged.register(spark)
    stream = lambda: spark.readStream.format("paged_feed").option("url", service.url).option("fields", "id,boro").option("page_size", 5).option("pause", 0).option("count", service.count).load()
    out, died = str(tmp_path / "out"), []

    def sink(d, i):
        d.write.mode("overwrite").parquet(f"{out}/batch={i}")
        if not died:
            died.append(i)
            raise RuntimeError("killed before the commit")

    with pytest.raises(Exception, match="killed"):
        incremental.run_available(stream(), sink, str(tmp_path / "checkpoint"))
    service.rows += [{"id": f"{i:03}", "boro": "9"} for i in range(47, 60)]
    for _ in range(2):
        incremental.run_available(stream(), sink, str(tmp_path / "checkpoint"))
    ids = sorted(r["id"] for r in spark.read.parquet(out).collect())
    assert ids == [f"{i:03}" for i in range(60)]
    assert spark.read.parquet(out).select("batch").distinct().count() == 2
    service.asked.clear()
    incremental.run_available(stream(), sink, str(tmp_path / "checkpoint"))
    assert all(q.get("count") for q in service.asked)  # nothing new, no page asked for
