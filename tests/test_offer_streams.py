"""Offers as a stream: the survivor of each offer kept as state."""

import random
from datetime import date

import pytest
from samples import DIRECT, VIA_MADRID, airlines, airports, offer, segment, traveler

from farelens.operators import offers as ops
from farelens.operators import tickets as tix
from farelens.plans import queries, tables
from farelens.sources.offers import offers_from_rows, stream_offers
from farelens.streaming.offers import stream_offer_fares, stream_plane_tickets
from farelens.workspace import folders, scratch_dir


def land(spark, folder, n, *documents):
    offers_from_rows(spark, documents).coalesce(1).write.json(f"{folder}/answer-{n}")


def stream(spark, folder):
    return stream_offers(spark, f"{folder}/*", max_files=1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def documents():
    """Copies of few offers that differ in itinerary, traveller, price or nothing; one offer holds a
    third of all."""
    rng = random.Random(11)
    via_porto = [segment(1, "CDG", "OPO", operating=None), segment(2, "OPO", "LIS", carrier="IB")]
    routes = [(DIRECT,), (VIA_MADRID,), (DIRECT, VIA_MADRID), (via_porto, DIRECT), (VIA_MADRID, DIRECT)]
    made = []
    for n in range(90):
        people = [traveler(i, f"CABIN-{rng.randrange(3)}") for i in rng.sample((1, 2, 10, "x"), 2)]
        price = {"currency": rng.choice(["EUR", None]), "grandTotal": f"{rng.randrange(90, 99)}.10"}
        made.append(
            offer(
                "hot" if n % 3 == 0 else f"id-{n % 5}",
                *rng.choice(routes),
                request_date=date(2023, 1, 14 + n % 2),
                price=price,
                travelerPricings=people,
                lastTicketingDate=rng.choice(["2023-01-10", None]),
            )
        )
    return made


@pytest.mark.parametrize("stops", ["direct", "connecting"])
def test_stream_equals_batch_over_batches_and_restarts(spark, tmp_path, documents, stops):
    folder, table = tmp_path / "in", scratch_dir(spark, "fares")
    for n in range(3):
        land(spark, folder, n, *documents[n::5])
    stream_offer_fares(stream(spark, folder), stops, path=table)
    for n in range(3, 5):
        land(spark, folder, n, *documents[n::5])
    found = stream_offer_fares(stream(spark, folder), stops, path=table, compact_every=5)
    expected = ops.offer_fares(offers_from_rows(spark, documents), stops)
    assert found.columns == expected.columns
    assert rows(found) == rows(expected) and found.count() > 2
    assert folders(spark, f"{table}/snapshots") == ["upto=4"]


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for name in blocks.mkString(" ").split() if name.startswith("shuffle_")}


@pytest.mark.parametrize("stops", ["direct", "connecting"])
def test_the_table_is_all_that_is_kept(spark, tmp_path, documents, stops):
    """Offers are neither in a state beside the table nor in shuffle files of batches that are done."""
    for n in range(5):
        land(spark, tmp_path / "in", n, *documents[n::5])
    table, before = scratch_dir(spark, "fares"), shuffle_files(spark)
    found = stream_offer_fares(stream(spark, tmp_path / "in"), stops, path=table, compact_every=5)
    assert shuffle_files(spark) <= before
    assert not folders(spark, f"{table}/_checkpoint/state")
    assert folders(spark, f"{table}/snapshots") == ["upto=4"] and not folders(spark, f"{table}/changes")
    assert rows(found) == rows(ops.offer_fares(offers_from_rows(spark, documents), stops))


def test_documents_land_without_a_shuffle(spark):
    path, offers = scratch_dir(spark, "staged"), tables.offers(spark, "/root/testdata/sf0.001")
    spark.sparkContext.setJobGroup("landing by segments", "")
    try:
        queries._land_by_segments(offers, path)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(n) for n in tracker.getJobIdsForGroup("landing by segments")]
    assert sum(len(job.stageIds) for job in jobs) == 1
    assert sorted(folders(spark, path)) == ["_SUCCESS", "landing=-1", *(f"landing={n}" for n in range(7))]
    found = spark.read.schema(offers.schema).parquet(path).select(*offers.columns)
    assert found.exceptAll(offers).count() == offers.exceptAll(found).count() == 0


def test_smallest_rows_are_the_survivors(spark, documents):
    for stops in ops.STOPS:
        its = ops.itineraries(ops.bookable_offers(offers_from_rows(spark, documents)))
        fares = ops.add_fare(ops.legs(its, stops))
        kept = ops.smallest_rows(fares).select(*fares.columns)
        assert rows(kept) == rows(ops.dedup_offers(fares))


@pytest.mark.parametrize("stops", ["direct", "connecting"])
def test_tickets_take_the_names_of_the_survivor(spark, tmp_path, stops):
    """A smaller copy that comes later replaces the row, with an airport that nothing names."""
    lost = [segment(1, "CDG", "XXX"), segment(2, "XXX", "LIS")] if stops == "connecting" else [
        segment(1, "CDG", "XXX")
    ]
    known = VIA_MADRID if stops == "connecting" else DIRECT
    land(spark, tmp_path / "in", 0, offer("a", [], known), offer("b", known))
    table, names = scratch_dir(spark, "fares"), (airports(spark), airlines(spark))

    def run():
        return stream_plane_tickets(stream(spark, tmp_path / "in"), *names, stops, path=table)

    assert [r.id for r in run().orderBy("id").collect()] == ["a", "b"]
    land(spark, tmp_path / "in", 1, offer("a", lost))
    assert [r.id for r in run().collect()] == ["b"]
    together = offers_from_rows(spark, [offer("a", [], known), offer("b", known), offer("a", lost)])
    assert rows(run()) == rows(tix.plane_tickets(together, *names, stops))


def test_late_offers_are_left_out_behind_a_watermark(spark, tmp_path):
    days = [date(2023, 3, 1), date(2023, 6, 1), date(2023, 3, 1)]
    for n, day in enumerate(days):
        land(spark, tmp_path / "in", n, offer(f"id-{n}", DIRECT, request_date=day))
    source = stream(spark, tmp_path / "in")
    # Files of one second come in any order; with a watermark of years nothing is late.
    assert stream_offer_fares(source, "direct", watermark="2000 days").count() == 3
    table = scratch_dir(spark, "fares")
    stream_offer_fares(source, "direct", watermark="1 day", path=table, state_partitions=2)
    land(spark, tmp_path / "in", 3, offer("late", DIRECT, request_date=days[0]))
    after = stream_offer_fares(stream(spark, tmp_path / "in"), "direct", watermark="1 day", path=table)
    assert "late" not in {r.id for r in after.collect()}


def test_no_offers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert stream_offer_fares(stream_offers(spark, str(tmp_path / "in")), "direct").count() == 0
