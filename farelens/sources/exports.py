"""Ticket exports by departure date of which single dates are replaced.

A sweep writes its dates into a folder of its own and commits a list of which folder holds which
date. The list appears by a rename, so readers see a sweep whole or not at all; folders of other
dates are not touched. Earlier lists stay readable until :func:`forget` deletes them with the
folders that only they name.
"""

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from farelens.schemas import TICKET
from farelens.sources.tickets import read_tickets, write_tickets
from farelens.workspace import delete, folders, read_text, write_text


def versions(spark: SparkSession, path: str) -> list[int]:
    names = (name.partition(".") for name in folders(spark, f"{path}/_dates"))
    return sorted(int(stem) for stem, _, end in names if end == "json")


def exported_dates(spark: SparkSession, path: str, version: int | None = None) -> dict[str, str]:
    """Date to the folder that holds it, in the newest or a given version."""
    found = versions(spark, path)
    if version is None and not found:
        return {}
    return json.loads(read_text(spark, f"{path}/_dates/{found[-1] if version is None else version}.json"))


def replace_dates(
    tickets: DataFrame, path: str, dates: Iterable[str], date_col: str = "dep_date"
) -> int:
    """Replace ``dates`` (yyyy-MM-dd) by the tickets given; a date without any goes. Tickets of
    other dates are an error. Returns the version that holds the result.

    Of two sweeps at once the later to commit fails, as its version is there already; its dates can
    be replaced again.
    """
    spark, sweep = tickets.sparkSession, f"sweep-{uuid.uuid4().hex}"
    before = exported_dates(spark, path)
    found = versions(spark, path)
    write_tickets(tickets, f"{path}/{sweep}", date_col)
    written = {
        name.partition("=")[2]: f"{sweep}/{name}"
        for name in folders(spark, f"{path}/{sweep}")
        if name.startswith(f"{date_col}=")
    }
    dates = set(dates)
    if unasked := written.keys() - dates:
        raise ValueError(f"tickets of dates that the sweep does not replace: {sorted(unasked)[:5]}")
    after = {d: folder for d, folder in before.items() if d not in dates} | written
    version = (found[-1] if found else 0) + 1
    write_text(spark, f"{path}/_dates/{version}.json", json.dumps(after, sort_keys=True))
    return version


def read_export(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The tickets of a version, by default the newest."""
    parts = sorted(exported_dates(spark, path, version).values())
    if not parts:
        return spark.createDataFrame([], TICKET)
    return read_tickets(spark, [f"{path}/{part}" for part in parts])


def forget(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Delete all but the last ``keep`` versions, and folders that none of those names."""
    found = versions(spark, path)
    needed = {d for v in found[-keep:] for d in exported_dates(spark, path, v).values()}
    for version in found[:-keep]:
        delete(spark, f"{path}/_dates/{version}.json")
    for sweep in folders(spark, path):
        if not sweep.startswith("sweep-"):
            continue
        parts = [f"{sweep}/{n}" for n in folders(spark, f"{path}/{sweep}") if "=" in n]
        for part in parts:
            if part not in needed:
                delete(spark, f"{path}/{part}")
        if not needed.intersection(parts):
            delete(spark, f"{path}/{sweep}")
