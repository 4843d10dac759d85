"""Public record feeds: events of buildings, and what they add to the buildings table.

Each is a function of landed rows that returns events (bbl, event_type, event_date, source, amount, party, detail) or building fields; counts and latest dates are the rollups of ``operators.rollup``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.functions import ids
from lotline.functions import text as X
from lotline.functions.dates import iso_date, slashed_date
from lotline.functions.numbers import floating, positive, strict_int, truncated
from lotline.operators.keys import best
from lotline.operators.resolve import first_bbl
from lotline.operators.rollup import event_rollup

c = F.col
FEEDS: dict[str, Callable[..., DataFrame]] = {}
# Names of the rolled-up columns, deeds that are sales, and contacts by preference.
ROLLUPS = {"violation": ("violations", "viol_last"), "complaint": ("complaints", "complaints_last"), "permit": ("permits", "permit_last"), "dob_complaint": ("dob_complaints", "dob_complaints_last"), "cofo": ("cofos", "cofo_last"), "eviction": ("evictions", "eviction_last"), "litigation": ("litigations", "litigation_last"), "sale": ("sales", "sales_last"), "311": ("sr311", "sr311_last")}
SALE_DEEDS = ["DEED", "DEEDO"]
OWNER_TYPES = ["HeadOfficer", "IndividualOwner", "CorporateOwner", "Owner", "Agent"]
SNAPSHOT_YEAR = 2017


def feed(name: str) -> Callable:
    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        FEEDS[name] = f
        return f

    return add


def events(d: DataFrame, source: str, kind: str, bbl: Column, date: Column, detail: Column, party: Column | None = None, amount: Column | None = None) -> DataFrame:
    none = F.lit(None)
    out = d.select(bbl.alias("bbl"), F.lit(kind).alias("event_type"), date.alias("event_date"), F.lit(source).alias("source"), (none if amount is None else amount).cast("double").alias("amount"), (none if party is None else party).cast("string").alias("party"), detail.alias("detail"))
    return out.where(c("bbl").isNotNull())


def rolled(e: DataFrame, kind: str) -> DataFrame:
    n, last = ROLLUPS[kind]
    return event_rollup(e, n, last, open_=F.lower("party") == "open" if kind == "311" else None)


@feed("pluto")
def pluto(d: DataFrame) -> DataFrame:
    """The buildings' own facts."""
    name = F.create_map(*[F.lit(x) for _, abbr, full in ids.BOROUGHS for x in (abbr, full)])
    out = d.select(ids.float_bbl(c("bbl")).alias("bbl"), F.coalesce(name[c("borough")], c("borough")).alias("borough"), truncated(c("block")).alias("block"), truncated(c("lot")).alias("lot"), "address", "zipcode", F.nullif(truncated(c("yearbuilt")), F.lit(0)).alias("year_built"), truncated(c("unitsres")).alias("units_res"), truncated(c("unitstotal")).alias("units_total"), c("bldgclass").alias("building_class"), floating(c("latitude")).alias("latitude"), floating(c("longitude")).alias("longitude"), truncated(c("cd")).alias("community_district"), c("ct2010").alias("census_tract"))
    return out.where(c("bbl").isNotNull())


@feed("hpd_violations")
def violations(d: DataFrame) -> DataFrame:
    return events(d, "hpd_violations", "violation", ids.assembled_bbl(c("boroid"), c("block"), c("lot")), iso_date(X.first_date(c("novissueddate"), c("inspectiondate"))), X.violation_detail(c("class"), c("novdescription")), c("currentstatus"))


@feed("hpd_complaints")
def complaints(d: DataFrame) -> DataFrame:
    return events(d, "hpd_complaints", "complaint", ids.own_or(c("bbl"), ids.named_bbl(c("borough"), c("block"), c("lot"))), iso_date(c("received_date")), X.join_labels(c("major_category"), c("minor_category"), c("problem_code")), c("complaint_status"))


@feed("hpd_registrations")
def registrations(regs: DataFrame, contacts: DataFrame, arrival: str = "arrival") -> DataFrame:
    """bbl, owner_name, owner_business_address: the best contact of each registration, the last registration of each building. Boroughs aren't checked."""
    r = regs.select("registrationid", ids.assembled_bbl(c("boroid"), c("block"), c("lot"), ranged=False).alias("bbl"), c(arrival).alias("reg_arrival")).where(X.filled(c("registrationid")).isNotNull() & c("bbl").isNotNull())
    rank = F.coalesce(F.array_position(F.array(*[F.lit(t) for t in OWNER_TYPES]), F.coalesce("type", F.lit(""))), F.lit(0))
    ct = contacts.withColumn("rank", F.when(rank > 0, rank).otherwise(len(OWNER_TYPES) + 1))
    top = best(ct, ["registrationid"], [c("rank"), c(arrival)])
    j = r.join(top, "registrationid")
    j = best(j, ["bbl"], [F.desc("reg_arrival")])
    return j.select("bbl", X.owner_name(c("corporationname"), c("firstname"), c("lastname")).alias("owner_name"), X.office_address(*[c(f"business{n}") for n in ("housenumber", "streetname", "apartment", "city", "state", "zip")]).alias("owner_business_address"))


@feed("dob_permits")
def permits(d: DataFrame) -> DataFrame:
    return events(d, "dob_permits", "permit", ids.named_bbl(c("borough"), c("block"), c("lot")), slashed_date(X.first_date(c("issuance_date"), c("filing_date"))), X.join_labels(c("job_type"), c("permit_type"), c("work_type")))


@feed("dob_complaints")
def dob_complaints(d: DataFrame, crosswalk: DataFrame, borough: int | None = None) -> DataFrame:
    """By address; the borough is asked of the building found."""
    d = d.where(X.filled(c("house_number")).isNotNull() & X.filled(c("house_street")).isNotNull())
    d = X.with_address(d.drop("bbl"), F.concat_ws(" ", "house_number", "house_street"))
    found = first_bbl(d, crosswalk, zipcode="zip_code")
    found = found.where(ids.in_borough(c("bbl"), borough))
    category = F.when(X.filled(c("complaint_category")).isNotNull(), F.concat(F.lit("category "), "complaint_category"))
    return events(found, "dob_complaints", "dob_complaint", c("bbl"), slashed_date(c("date_entered")), X.join_labels(category, c("status")), c("status"))


@feed("cofo")
def cofo(d: DataFrame) -> DataFrame:
    return events(d, "cofo", "cofo", ids.own_or(c("bbl"), ids.named_bbl(c("borough"), c("block"), c("lot"))), iso_date(c("c_o_issue_date")), X.join_labels(c("issue_type"), c("job_type")))


@feed("evictions")
def evictions(d: DataFrame, crosswalk: DataFrame) -> DataFrame:
    d = X.with_address(d.drop("bbl").where(X.filled(c("eviction_address")).isNotNull()), c("eviction_address"))
    found = first_bbl(d, crosswalk, zipcode="eviction_zip")
    apartment = F.when(X.filled(c("eviction_apt_num")).isNotNull(), F.concat(F.lit("apt "), "eviction_apt_num"))
    return events(found, "evictions", "eviction", c("bbl"), iso_date(c("executed_date")), X.join_labels(c("residential_commercial_ind"), apartment))


@feed("litigation")
def litigation(d: DataFrame) -> DataFrame:
    return events(d, "litigation", "litigation", ids.own_or(c("bbl"), ids.assembled_bbl(c("boroid"), c("block"), c("lot"))), iso_date(c("caseopendate")), X.join_labels(c("casetype"), c("casestatus")), c("casestatus"))


@feed("acris_sales")
def acris_sales(master: DataFrame, legals: DataFrame, borough: int | None = None) -> DataFrame:
    """Sale deeds joined with the lots that each touches; the borough is a column of the lots."""
    m = master.where(c("doc_type").isin(*SALE_DEEDS) & X.filled(c("document_id")).isNotNull())
    m = m.select("document_id", "doc_type", positive(c("document_amt")).alias("amount"), iso_date(X.first_date(c("recorded_datetime"), c("document_date"))).alias("date"))
    where = ids.borough_filter(borough, c("borough"), "code")
    j = m.join(legals.where(where) if where is not None else legals, "document_id")
    return events(j, "acris_sales", "sale", ids.assembled_bbl(c("borough"), c("block"), c("lot")), c("date"), c("doc_type"), amount=c("amount"))


@feed("sr311")
def requests(d: DataFrame, crosswalk: DataFrame, borough: int | None = None) -> DataFrame:
    """The feed's own BBL, else by address."""
    d = d.where(c("bbl").startswith(str(borough))) if borough else d
    d = d.withColumn("own", ids.ten_digits(c("bbl"))).drop("bbl")
    d = X.with_address(d, F.when(c("own").isNull(), c("incident_address")))
    found = first_bbl(d, crosswalk, zipcode="incident_zip").withColumn("path", F.when(c("own").isNotNull(), "bbl").when(c("bbl").isNotNull(), "crosswalk").otherwise("unresolved"))
    return events(found, "sr311", "311", F.coalesce("own", "bbl"), iso_date(c("created_date")), c("complaint_type"), X.filled(X.strip(c("status"))))


@feed("rent_stabilization")
def rent_stabilization(d: DataFrame, borough: int | None = None, limit: int | None = None, year: int = SNAPSHOT_YEAR) -> DataFrame:
    """bbl, rent_stab_units, rent_stab_status, rent_stab_year: a count of units, else a proxy by abatement; rows with neither are left out. ``limit`` counts rows that come out."""
    units = strict_int(c(f"unitsstab{year}"))
    j51, a421 = X.strip(F.coalesce("j51", F.lit(""))), X.strip(F.coalesce("a421", F.lit("")))
    status = F.when(units > 0, "registered").when(j51 != "", F.concat(F.lit("j51-proxy ("), j51, F.lit(")"))).when(a421 != "", F.concat(F.lit("421a-proxy ("), a421, F.lit(")")))
    out = d.select(ids.ten_digits(c("ucbbl")).alias("bbl"), F.when(units > 0, units).alias("rent_stab_units"), status.alias("rent_stab_status"), F.lit(year).alias("rent_stab_year"))
    out = out.where(c("bbl").isNotNull() & c("rent_stab_status").isNotNull()).where(ids.in_borough(c("bbl"), borough))
    return out.orderBy("bbl").limit(limit) if limit is not None else out
