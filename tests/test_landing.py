"""Landings with an index of requests, and exports of which single dates are replaced."""

import hashlib
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from samples import DIRECT, airlines, airports, offer

from farelens.plans import tables
from farelens.plans.export import ticket_reexport
from farelens.schemas import OFFER, REQUEST_KEY, TICKET
from farelens.sources import exports
from farelens.sources.landing import (
    in_landing_order,
    land_offers,
    missing_requests,
    read_landed,
    request_index,
)
from farelens.sources.offers import offers_from_rows, request_sweep
from farelens.workspace import delete, folders, scratch_dir

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


def requests(spark, *days, adults=2):
    return spark.createDataFrame(
        [("CDG", "LIS", day, adults) for day in days],
        "origin string, destination string, request_date date, adults int",
    )


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_files_follow_bytes_and_requests_find_their_files(spark, fmt):
    path, offers = scratch_dir(spark, "offers"), tables.offers(spark, SF)
    small = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(small, "false")  # else so few bytes are one file
    try:
        land_offers(offers, path, fmt=fmt)
    finally:
        spark.conf.unset(small)
    assert rows(read_landed(spark, path, fmt=fmt)) == rows(offers)
    asked = offers.select(*REQUEST_KEY).distinct().orderBy(*REQUEST_KEY)
    n_files = request_index(spark, path).select("file").distinct().count()
    assert n_files <= int(spark.conf.get("spark.sql.shuffle.partitions")) < asked.count()
    some = spark.createDataFrame(asked.take(3), asked.schema)
    found = read_landed(spark, path, some, fmt=fmt)
    assert rows(found) == rows(offers.join(some, list(REQUEST_KEY), "left_semi").select(*OFFER.names))
    assert 0 < len(found.inputFiles()) < n_files and n_files > 1


def test_one_request_with_most_offers_is_cut(spark):
    day = date(2023, 1, 14)
    many = [offer(f"{n:05d}", DIRECT, adults=1 if n % 3 else 2, request_date=day) for n in range(3000)]
    path = scratch_dir(spark, "offers")
    land_offers(offers_from_rows(spark, many), path, fmt="parquet")
    files = request_index(spark, path).filter("adults = 1").select("file").distinct().count()
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    assert files >= 1 and read_landed(spark, path, fmt="parquet").count() == 3000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        land_offers(offers_from_rows(spark, many), path, fmt="parquet")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert request_index(spark, path).filter("adults = 1").select("file").distinct().count() > files


def test_line_items_are_ordered_before_documents_are_built(spark):
    path, offers = scratch_dir(spark, "offers"), tables.offers(spark, SF, in_landing_order)
    plan = offers._jdf.queryExecution().executedPlan().toString()
    assert "segments" in plan[: plan.index("rangepartitioning")]
    assert "segments" not in plan[plan.index("rangepartitioning") :]
    small = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(small, "false")
    try:
        land_offers(offers, path, in_order=True)
    finally:
        spark.conf.unset(small)
    landed = read_landed(spark, path)
    assert rows(landed) == rows(tables.offers(spark, SF))
    ends = landed.groupBy(F.input_file_name()).agg(*(f(F.struct(*REQUEST_KEY, "id")) for f in (F.min, F.max)))
    ends = sorted(tuple(r[1:]) for r in ends.collect())
    assert len(ends) > 1 and all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_only_missing_requests_are_asked_for(spark):
    path = scratch_dir(spark, "offers")
    days = [date(2023, 1, n) for n in range(1, 6)]
    sweep = request_sweep(requests(spark, days[0]).drop("request_date"), days[0], days[-1])
    assert missing_requests(sweep, path).count() == 5
    assert read_landed(spark, path).count() == 0
    first = requests(spark, *days[:3])
    land_offers(offers_from_rows(spark, [offer("a", DIRECT, request_date=days[0])]), path, first)
    missing = missing_requests(sweep, path)
    assert sorted(r.request_date for r in missing.collect()) == days[3:]  # two had no answer
    plan = missing._jdf.queryExecution().executedPlan().toString()
    assert "FileScan json" not in plan and "_index" in str(missing.inputFiles())
    land_offers(offers_from_rows(spark, [offer("b", DIRECT, request_date=days[4])]), path, missing)
    assert missing_requests(sweep, path).count() == 0
    assert sorted(r.id for r in read_landed(spark, path).collect()) == ["a", "b"]
    assert read_landed(spark, path, requests(spark, days[1])).count() == 0


def test_a_landing_cut_off_does_not_count(spark):
    path, day = scratch_dir(spark, "offers"), date(2023, 1, 14)
    for name in "ab":
        land_offers(offers_from_rows(spark, [offer(name, DIRECT)]), path, requests(spark, day))
    lost = folders(spark, f"{path}/_index")[0]
    delete(spark, f"{path}/_index/{lost}/_SUCCESS")
    assert read_landed(spark, path).count() == 1
    assert request_index(spark, path).count() == 1


def ticket(spark, *named):
    values = [(day, *(name if f.name == "id" else None for f in TICKET)) for day, name in named]
    schema = "dep_date string, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TICKET)
    return spark.createDataFrame(values, schema)


def contents(path):
    return {
        str(f.relative_to(path)): hashlib.sha256(f.read_bytes()).hexdigest()
        for f in Path(path).rglob("*.csv")
    }


def ids(df):
    return sorted(r.id for r in df.collect())


def test_only_the_dates_of_a_sweep_are_replaced(spark, monkeypatch):
    path = scratch_dir(spark, "export")
    assert ids(exports.read_export(spark, path)) == [] and exports.exported_dates(spark, path) == {}
    first = ticket(spark, ("2023-01-01", "a"), ("2023-01-02", "b"), ("2023-01-03", "c"))
    assert exports.replace_dates(first, path, ["2023-01-01", "2023-01-02", "2023-01-03"]) == 1
    before = contents(path)
    second = ticket(spark, ("2023-01-02", "B"))
    assert exports.replace_dates(second, path, ["2023-01-02", "2023-01-03"]) == 2
    assert ids(exports.read_export(spark, path)) == ["B", "a"]  # the third has no tickets any more
    assert ids(exports.read_export(spark, path, version=1)) == ["a", "b", "c"]
    assert before.items() <= contents(path).items()
    with pytest.raises(ValueError):
        exports.replace_dates(ticket(spark, ("2023-01-09", "x")), path, ["2023-01-08"])
    with monkeypatch.context() as patch:
        def lost(*args):
            raise OSError("lost before the commit")

        patch.setattr(exports, "write_text", lost)
        with pytest.raises(OSError):
            exports.replace_dates(ticket(spark, ("2023-01-01", "z")), path, ["2023-01-01"])
    assert ids(exports.read_export(spark, path)) == ["B", "a"]
    exports.forget(spark, path)
    assert exports.versions(spark, path) == [2] and ids(exports.read_export(spark, path)) == ["B", "a"]
    kept = contents(path)
    assert len(kept) == 2 and kept.items() & before.items()


def test_a_sweep_repeated_replaces_itself(spark):
    path, day = scratch_dir(spark, "export"), date(2023, 1, 14)
    offers = offers_from_rows(spark, [offer("a", DIRECT), offer("b", DIRECT, adults=3)])
    names = airports(spark), airlines(spark)
    for _ in range(2):
        ticket_reexport(requests(spark, day), offers, *names, path, "direct")
    assert ids(exports.read_export(spark, path)) == ["a"]
    ticket_reexport(requests(spark, day, adults=3), offers, *names, path, "direct")
    assert ids(exports.read_export(spark, path)) == ["b"]
