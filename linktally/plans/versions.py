"""Runs that readers see whole: new folders first, one small file last.

A run writes only folders of its own, ``<table>/run=<id>/...``, so nothing that is
read is ever changed. Its last step is a version file that says, for each table and month,
which runs hold the rows. Readers take the newest version file: before it is there they
see the earlier run in all tables and exports, after it the new one. A month that
is not redone stays where an earlier run put it.

Folders that neither the newest version nor the one before it names are removed
after the next run has been published, so a reader may stay on a version for the time of a run.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linktally.functions.platforms import YOUTUBE, Platform
from linktally.plans.pipeline import Outputs, write_reports
from linktally.plans.reports import domain_month, platform_link_month
from linktally.schemas import DOMAIN_MONTH_SCHEMA, LINK_MONTH_SCHEMA, SHARES_SCHEMA
from linktally.sources.tables import SHARES_ORDER, file_system, write_by_month

#: The folder name of rows without a month.
UNDATED = "__HIVE_DEFAULT_PARTITION__"

_TABLES = {"shares": SHARES_SCHEMA, "domain_month": DOMAIN_MONTH_SCHEMA, "platform_link_month": LINK_MONTH_SCHEMA}
_EXPORTS = ("platform_links_by_kind", "domains", "platform_links", "video_links", "channel_links", "channels")


@dataclass(frozen=True)
class Version:
    """One consistent state: for each table and month the runs that hold its rows, and the run of the exports."""

    number: int
    run: str
    tables: dict[str, dict[str, list[str]]]

    def months(self) -> list[str]:
        return sorted(month for month in self.tables["shares"] if month != UNDATED)

    def folders(self) -> set[str]:
        """Every folder below the root that this version reads."""
        monthly = {
            f"{table}/run={run}/month={month}" for table, months in self.tables.items() for month, runs in months.items() for run in runs
        }
        return monthly | {f"{export}/run={self.run}" for export in _EXPORTS}


def _names(spark: SparkSession, path: str) -> list[str]:
    files, place = file_system(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(place)) if files.exists(place) else []


def _version(spark: SparkSession, root: str, name: str) -> Version:
    text = spark.read.text(f"{root}/versions/{name}", wholetext=True).first()["value"]
    return Version(**json.loads(text))


def _version_names(spark: SparkSession, root: str) -> list[str]:
    return [name for name in _names(spark, f"{root}/versions") if name.endswith(".json")]


def current_version(spark: SparkSession, root: str) -> Version | None:
    """The newest version, or none before the first run."""
    names = _version_names(spark, root.rstrip("/"))
    return _version(spark, root.rstrip("/"), names[-1]) if names else None


def _publish(spark: SparkSession, root: str, version: Version) -> None:
    """Write the version under another name and rename it: it is there whole or not at all."""
    files, place = file_system(spark, f"{root}/versions/{version.number:012d}.json")
    draft = place.suffix(f".{version.run}.draft")
    stream = files.create(draft)
    stream.writeBytes(json.dumps({"number": version.number, "run": version.run, "tables": version.tables}))
    stream.close()
    if files.exists(place) or not files.rename(draft, place):
        raise RuntimeError(f"another run has published version {version.number} of {root}")


def read_version(spark: SparkSession, root: str, table: str, version: Version | None = None) -> DataFrame:
    """A monthly table (shares, domain_month or platform_link_month) of a version, the newest by default."""
    root = root.rstrip("/")
    version = version or current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no version is published below {root}")
    schema = _TABLES[table]
    paths = [f"{root}/{table}/run={run}/month={month}" for month, runs in version.tables[table].items() for run in runs]
    if not paths:
        return spark.createDataFrame([], schema)
    fields = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    return spark.read.schema(fields).option("basePath", f"{root}/{table}").parquet(*paths).select(*schema.names)


def current_outputs(spark: SparkSession, root: str) -> Outputs:
    """Where the exports of the newest version are."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no version is published below {root}")
    return Outputs(root, version.run)


def run_version(
    spark: SparkSession,
    shares: DataFrame,
    root: str,
    video_metadata: DataFrame | None = None,
    platform: Platform = YOUTUBE,
    refresh_months: Sequence[str] | None = None,
    codec: str = "zstd",
    gather: bool = True,
) -> Version:
    """Store shares, rollups and exports of a new run and publish them together.

    With ``refresh_months`` these months are replaced by the rows of ``shares`` that
    belong to them, all others are taken over from the newest version, and rows
    without a month are added if they are not stored yet. A run that fails publishes
    nothing; the folders it left are removed after the next one.
    """
    root = root.rstrip("/")
    before = current_version(spark, root)
    run = uuid.uuid4().hex
    out = Outputs(root, run)
    tables: dict[str, dict[str, list[str]]] = {table: {} for table in _TABLES}
    if refresh_months is not None and before is not None:
        for table, months in before.tables.items():
            tables[table] = {month: list(runs) for month, runs in months.items() if month not in refresh_months}
        dated = shares.where(F.col("month").isin(*refresh_months))
        undated = shares.where(F.col("month").isNull())
        stored = read_version(spark, root, "shares", before).where(F.col("month").isNull())
        shares = dated.unionByName(undated.select(*SHARES_SCHEMA.names).exceptAll(stored))

    def added(table: str, path: str) -> None:
        for name in _names(spark, path):
            if name.startswith("month="):
                tables[table].setdefault(name.removeprefix("month="), []).append(run)

    write_by_month(shares, out.shares, codec, SHARES_ORDER, gather)
    added("shares", out.shares)
    own = Version(0, run, {"shares": {month: [run] for month, runs in tables["shares"].items() if runs == [run] and month != UNDATED}})
    new = read_version(spark, root, "shares", own)
    write_by_month(domain_month(new), out.domain_month)
    write_by_month(platform_link_month(new, platform), out.link_month)
    added("domain_month", out.domain_month)
    added("platform_link_month", out.link_month)
    version = Version(before.number + 1 if before else 1, run, tables)
    rollups = read_version(spark, root, "domain_month", version), read_version(spark, root, "platform_link_month", version)
    write_reports(spark, out, version.months(), video_metadata, platform, rollups)
    _publish(spark, root, version)
    _tidy(spark, root, version, before)
    return version


def _tidy(spark: SparkSession, root: str, version: Version, before: Version | None) -> None:
    """Remove the folders of runs that neither version reads, and older version files."""
    kept = version.folders() | (before.folders() if before else set())
    for table in (*_TABLES, *_EXPORTS):
        for run in _names(spark, f"{root}/{table}"):
            if table in _EXPORTS:
                unused = [] if f"{table}/{run}" in kept else [run]
            else:
                months = [name for name in _names(spark, f"{root}/{table}/{run}") if name.startswith("month=")]
                unused = [f"{run}/{month}" for month in months if f"{table}/{run}/{month}" not in kept]
                if len(unused) == len(months):
                    unused = [run]
            for name in unused:
                files, place = file_system(spark, f"{root}/{table}/{name}")
                files.delete(place, True)
    for name in _version_names(spark, root)[:-2]:
        files, place = file_system(spark, f"{root}/versions/{name}")
        files.delete(place, False)
