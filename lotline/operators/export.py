"""A checksummed release: CSV files, manifest and quality report."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import tempfile
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.operators.coverage import all_distributions
from lotline.sources import release as parts_of

UNITS = ["unit_id", "bbl", "unit_label", "normalized_unit", "first_seen", "last_seen"]
OBSERVATIONS = ["unit_id", "observation_id", "source", "source_ref", "observed_at", "observation_kind", "address", "unit_label", "bedrooms", "bathrooms", "price", "status", "evidence_grade", "resolution_confidence", "resolution_method", "matched_at"]
SOURCES = ["source", "source_kind", "methodology", "first_seen", "last_seen"]
EXCLUDED = ["payload", "raw_fields"]


def unit_observations(matches: DataFrame, observations: DataFrame) -> DataFrame:
    m = matches.where("entity_type = 'unit' AND status = 'resolved'").select(F.col("entity_id").alias("unit_id"), "observation_id", F.col("confidence").alias("resolution_confidence"), F.col("method").alias("resolution_method"), "matched_at")
    return m.join(observations, "observation_id").select(*OBSERVATIONS)


def rows_in_order(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """What a file holds: the columns as text in their order, null as '', sorted."""
    return df.select(*columns).orderBy(*order).select(*[F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) for n in columns])


def write_csv(df: DataFrame, path: str, columns: Sequence[str], order: Sequence[str]) -> int:
    """One CSV file with a header, in order; null is an empty field. The rows come to the driver partition by partition."""
    rows = 0
    with open(path, "w", encoding="utf-8", newline="") as f:
        import csv

        out = csv.writer(f)
        out.writerow(columns)
        for r in rows_in_order(df, columns, order).toLocalIterator(prefetchPartitions=True):
            out.writerow(r)
            rows += 1
    return rows


def sha256_of(path: str) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            h.update(block)
    return h.hexdigest()


def release(out_dir: str, units: DataFrame, observed: DataFrame, sources: DataFrame, generated_at: str, release_id: str | None = None) -> dict:
    """Writes the three files and manifest.json into a new directory, all or nothing; a directory that has files is refused."""
    if os.path.isdir(out_dir) and os.listdir(out_dir):
        raise FileExistsError(f"{out_dir} is not empty")
    parent = os.path.dirname(os.path.abspath(out_dir))
    os.makedirs(parent, exist_ok=True)
    work = tempfile.mkdtemp(dir=parent)
    try:
        files = {}
        for name, df, columns, order in (("units.csv", units, UNITS, ["bbl", "normalized_unit"]), ("unit_observations.csv", observed, OBSERVATIONS, ["unit_id", "observed_at", "observation_kind", "observation_id"]), ("sources.csv", sources, SOURCES, ["source"])):
            path = os.path.join(work, name)
            files[name] = {"rows": write_csv(df, path, columns, order), "sha256": sha256_of(path)}
        manifest = {"format": 1, "release_id": release_id or os.path.basename(os.path.abspath(out_dir)), "generated_at": generated_at, "files": files, "excluded_fields": EXCLUDED}
        with open(os.path.join(work, "manifest.json"), "w", encoding="utf-8") as f:
            json.dump(manifest, f, indent=2, sort_keys=True)
        if os.path.isdir(out_dir):
            os.rmdir(out_dir)
        os.rename(work, out_dir)
        return manifest
    except BaseException:
        shutil.rmtree(work, ignore_errors=True)
        raise


#: The files of a release: columns, and the order of rows.
FILES = {"units.csv": (UNITS, ["bbl", "normalized_unit"]), "unit_observations.csv": (OBSERVATIONS, ["unit_id", "observed_at", "observation_kind", "observation_id"]), "sources.csv": (SOURCES, ["source"])}


def release_parts(out_dir: str, tables: Mapping[str, DataFrame], generated_at: str, release_id: str | None = None, files: Mapping[str, tuple[Sequence[str], Sequence[str]]] = FILES, parts: int | None = None) -> dict:
    """A release of any size: rows are dealt by ranges of (file, order), each task writes its parts, and one commit makes the release or nothing. ``tables``: file name -> rows; ``out_dir`` is a folder that all executors reach. A folder that has files is refused. Returns the manifest; each file's parts, in their order, are the file that ``write_csv`` would write."""
    fs, target = parts_of.place(out_dir)
    if parts_of.exists(fs, target) and fs.get_file_info(parts_of.pafs.FileSelector(target)):
        raise FileExistsError(f"{out_dir} is not empty")
    one = []
    for name, (columns, order) in files.items():
        df = tables[name]
        text = lambda n: F.col(n).cast("string")
        one.append(df.select(F.lit(name).alias("file"), F.array(*[F.coalesce(text(n), F.lit("")) for n in columns]).alias("fields"), F.struct(*[F.col(n).alias(f"k{i}") for i, n in enumerate(order)], *[F.lit(None).cast("string").alias(f"k{i}") for i in range(len(order), max(len(o) for _, o in files.values()))]).alias("at")))
    rows = reduce(DataFrame.unionByName, one)
    spark = rows.sparkSession
    parts_of.register(spark)
    keys = ["file", *[f"at.k{i}" for i in range(max(len(o) for _, o in files.values()))]]
    dealt = (rows.repartitionByRange(parts, *keys) if parts else rows.repartitionByRange(*keys)).sortWithinPartitions(*keys).select("file", "fields")
    base, _, last = out_dir.rstrip("/").rpartition("/")
    extra = {"format": 1, "release_id": release_id or last, "generated_at": generated_at, "excluded_fields": EXCLUDED}
    staging = f"{base}/.{last}-{uuid.uuid4().hex}"
    dealt.write.format("csv_release").mode("append").option("staging", staging).option("headers", json.dumps({n: list(c) for n, (c, _) in files.items()})).option("manifest", json.dumps(extra)).save(out_dir)
    with fs.open_input_stream(f"{target}/{parts_of.MANIFEST}") as f:
        return json.loads(f.read())


def status_block(feeds: Sequence[tuple[str, int, bool]], day: str, begin: str, end: str) -> str:
    """A table of feeds (name, rows, live) between two marks: live ones first, then by name."""
    lines = [f"| `{n}` | {'live' if live else 'down'} | {rows if live else '-'} |" for n, rows, live in sorted(feeds, key=lambda f: (not f[2], f[0]))]
    return "\n".join([begin, f"{sum(f[2] for f in feeds)} of {len(feeds)} feeds live on {day}", "", "| feed | status | listings |", "|---|---|---|", *lines, end])


def with_block(text: str, block: str, begin: str, end: str) -> str:
    """``text`` with the block in the place of the one between the marks; as it is where a mark lacks."""
    if begin not in text or end not in text:
        return text
    return text[: text.index(begin)] + block + text[text.index(end) + len(end) :]


def quality_report(tables: Mapping[str, DataFrame], release_id: str, commit: str | None = None) -> dict:
    """Counts, distributions and open gaps: one job a table. Only aggregates reach the driver."""
    asked = {"observations": ["source", "evidence_grade"], "entity_matches": ["unit_status"]}
    count, found = {}, {}
    for name, df in tables.items():
        if name == "entity_matches":
            df = df.select(F.when(F.col("entity_type") == "unit", F.coalesce("status", F.lit(""))).alias("unit_status"))
        keys = asked.get(name, [])
        for r in all_distributions(df, keys).collect() if keys else [(None, None, df.count())]:
            if r[0] is None:
                count[name] = r[2]
            else:
                found.setdefault(r[0], []).append((r[1], r[2]))
        count.setdefault(name, 0)
    ordered = lambda k: dict(sorted(found.get(k, []), key=lambda x: (-x[1], x[0] is not None, x[0] or "")))
    by_status = {k: n for k, n in ordered("unit_status").items() if k is not None}  # null: claims of other kinds
    whole = sum(by_status.values())
    counts = count | {"unit_resolution_rate": round(by_status.get("resolved", 0) / whole, 6) if whole else 0.0}
    gaps = [f"{n} unit claims are {s}" for s, n in by_status.items() if s != "resolved"]
    return {"format": 1, "release_id": release_id, "software_commit": commit, "counts": counts, "unit_status": by_status, "sources": ordered("source"), "evidence_grades": ordered("evidence_grade"), "warnings": [] if whole else ["no unit claims"], "open_gaps": gaps}
