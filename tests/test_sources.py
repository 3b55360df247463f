import glob
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from samples import DIRECT, VIA_MADRID, airlines, airports, offer

from farelens import workspace
from farelens.operators import offers as ops
from farelens.plans.export import ticket_export, tickets_for_requests
from farelens.plans.queries import QUERIES
from farelens.sources import dimensions
from farelens.sources import offers as landing
from farelens.sources import tickets as files


def routes(spark):
    return spark.createDataFrame(
        [("CDG", "LIS", 2)], "origin string, destination string, adults int"
    )


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_landed_offers_read_back_equal(spark, tmp_path, fmt):
    documents = [
        offer("1", DIRECT),
        offer("2", VIA_MADRID, request_date=date(2023, 1, 15), origin="007"),
        offer("3", itineraries=None),
    ]
    offers = landing.offers_from_rows(spark, documents)
    landing.write_offers(offers, str(tmp_path / "offers"), fmt)
    back = landing.read_offers(spark, str(tmp_path / "offers"), fmt)
    assert back.schema == offers.schema
    assert sorted(back.collect(), key=lambda r: r.id) == offers.collect()
    assert glob.glob(f"{tmp_path}/offers/origin=007/destination=LIS/request_date=2023-01-15/*")


def test_landed_requests_are_pruned(spark, tmp_path):
    landing.write_offers(
        landing.offers_from_rows(spark, [offer("1", DIRECT)]), str(tmp_path / "offers")
    )
    offers = landing.read_offers(spark, str(tmp_path / "offers"))
    plan = offers.filter("request_date = date'2023-01-14'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(request_date" in plan


def test_a_line_that_is_not_an_offer_is_not_bookable(spark, tmp_path):
    lines = [json.dumps(offer("1", DIRECT), default=str), "{broken", "[]"]
    (tmp_path / "offers.json").write_text("\n".join(lines))
    offers = landing.read_offers(spark, str(tmp_path / "offers.json"))
    assert [r.id for r in ops.bookable_offers(offers).collect()] == ["1"]


def test_corrupt_lines_can_be_set_aside(spark, tmp_path):
    lines = [json.dumps(offer("1", DIRECT), default=str), "{broken"]
    (tmp_path / "offers.json").write_text("\n".join(lines))
    offers = landing.read_offers(spark, str(tmp_path / "offers.json"), corrupt="bad").cache()
    assert [(r.id, r.bad) for r in offers.orderBy("id").collect()] == [(None, "{broken"), ("1", None)]


def test_a_line_break_in_a_city_stays_in_its_field(spark, tmp_path):
    fields = ["1", "CDG", '"Paris\n""Nord"""', "2023-01-14", "LIS", "Lisbon", "", "A", "3.5"]
    text = ",".join([*fields, "EUR", "true", "", "", "", "", "2023-01-10"])
    header = ",".join(files.TICKET.names)
    (tmp_path / "day.csv").write_text(f"{header}\n{text}\n")
    (row,) = files.read_tickets(spark, str(tmp_path), multi_line=True).collect()
    assert (row.ville_de_depart, row.price) == ('Paris\n"Nord"', 3.5)


def test_text_is_made_in_a_projection_of_its_own(spark):
    rows = spark.range(3).select(F.to_json(F.struct(F.col("id").cast("string").alias("id"))).alias("body"))
    offers = landing.offers_from_text(rows, "body")
    assert [r.id for r in offers.collect()] == ["0", "1", "2"]
    plan = offers._jdf.queryExecution().executedPlan().toString().splitlines()
    parsing = [line for line in plan if "from_json" in line]
    assert len(parsing) == 1 and "StructsToJson" not in parsing[0] and "to_json" not in parsing[0]


def test_offers_from_text(spark):
    text = json.dumps(offer("1", VIA_MADRID), default=str)
    rows = spark.createDataFrame([(text,), ("{broken",), (None,)], "body string")
    offers = landing.offers_from_text(rows, "body")
    (row,) = ops.offer_fares(offers, "connecting").collect()
    assert (row.id, row.layover_airport) == ("1", "MAD")


def test_sweep_and_export_follow_the_data(spark, tmp_path):
    """A line item of a later year is asked for and exported."""
    tables = "/root/testdata/sf0.001"
    lines = spark.read.parquet(f"{tables}/lineitem.parquet")
    later = lines.filter("l_linenumber > 3 and l_orderkey % 4 < 3").limit(50).withColumn(
        "l_shipdate", F.lit("2031-05-07").cast(lines.schema["l_shipdate"].dataType)
    )
    lines.unionByName(later).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("nation", "supplier"):
        spark.read.parquet(f"{tables}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert QUERIES["date_sweep"](spark, str(tmp_path)).agg(F.max("request_date")).first()[0] == "2031-05-05"
    exported = QUERIES["ticket_export_roundtrip"](spark, str(tmp_path))
    assert exported.filter("date_de_depart like '2031-05-07%'").count() > 0


def test_sweep_without_an_end_asks_for_nothing(spark):
    assert landing.request_sweep(routes(spark), None, None).count() == 0


def test_sweep_asks_for_days_1_to_27_of_each_month(spark):
    sweep = landing.request_sweep(routes(spark), date(2023, 1, 1), date(2023, 12, 31))
    days = [r.request_date for r in sweep.collect()]
    assert len(days) == len(set(days)) == 324
    assert max(d.day for d in days) == 27
    whole = landing.request_sweep(routes(spark), date(2023, 1, 1), date(2023, 12, 31), 31)
    assert whole.count() == 365


def test_airports_and_airlines(spark, tmp_path):
    (tmp_path / "airports.csv").write_text(
        '1,"Charles, de Gaulle",Paris,France,CDG,LFPG,49.0,2.5,392,1,E,Europe/Paris,airport\n'
        "2,Nameless,Oslo,Norway,\\N,ENXX,60.0,10.0,1,1,E,Europe/Oslo,airport\n"
        "3,Codeless,Rome,Italy,,,1.0,1.0,1,1,E,Europe/Rome,airport\n"
    )
    (tmp_path / "airlines.csv").write_text(
        "1,Air One,,AF,AFR,AIRONE,France,Y\n2,No Code,,,XXX,NC,France,Y\n"
        "3,,,ZZ,XXX,NN,France,Y\n4,Odd,,\\N,XXX,OD,France,N\n"
    )
    found = dimensions.read_airports(spark, str(tmp_path / "airports.csv"))
    assert [tuple(r) for r in found.collect()] == [
        ("Paris", "CDG"),
        ("Oslo", "\\N"),
        ("Rome", None),
    ]
    found = dimensions.read_airlines(spark, str(tmp_path / "airlines.csv"))
    assert [tuple(r) for r in found.collect()] == [("Air One", "AF"), ("Odd", "\\N")]


HEADER = ",".join(f"column{n}" for n in range(16))


def ticket_line(id, price="10.5"):
    return f"{id},CDG,Paris,2023-01-14T10:00:00,LIS,Lisbon,,A,{price},EUR,true,,,,,2023-01-10"


def test_ticket_files_bind_by_position(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{ticket_line(1)}\n")
    (tmp_path / "b.csv").write_text(f"{HEADER}\n{ticket_line(2)}\n{ticket_line(3, 'x')}\n")
    files.ticket_view(spark, f"{tmp_path}/*.csv", "ticket_sample")
    rows = spark.sql("SELECT id, price, date_darrivee FROM ticket_sample ORDER BY id").collect()
    assert [tuple(r) for r in rows] == [("1", 10.5, None), ("2", 10.5, None), ("3", None, None)]


def test_preview_shows_twenty_rows(spark, capsys):
    df = spark.range(100).orderBy("id")
    assert [r.id for r in files.preview(df).collect()] == list(range(20))
    files.preview(df, 2).show()
    df.printSchema()
    assert "only showing" not in capsys.readouterr().out


def test_export_writes_one_folder_per_requested_date(spark, tmp_path):
    documents = [
        offer("1", VIA_MADRID),
        offer("1", VIA_MADRID, request_date=date(2023, 2, 2)),
        offer("2", VIA_MADRID, request_date=date(2023, 1, 30)),
        offer("3", VIA_MADRID, destination="OPO"),
    ]
    offers = landing.offers_from_rows(spark, documents)
    requests = landing.request_sweep(routes(spark), date(2023, 1, 1), date(2023, 12, 31))
    path = str(tmp_path / "tickets")
    ticket_export(requests, offers, airports(spark), airlines(spark), path)
    folders = sorted(p.rsplit("=", 1)[1] for p in glob.glob(f"{path}/dep_date=*"))
    assert folders == ["2023-01-14", "2023-02-02"]
    rows = files.read_tickets(spark, path).collect()
    assert sorted((r.id, r.price, r.date_de_depart) for r in rows) == [
        ("1", 120.5, "2023-01-14T02:00:00")
    ] * 2
    assert {r.escale for r in rows} == {"true"}

    table = tickets_for_requests(requests, offers, airports(spark), airlines(spark))
    assert table.filter(table.dep_date == date(2023, 2, 2)).first().date_de_depart == datetime(
        2023, 1, 14, 2
    )


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError):
        workspace.scratch_dir(Cluster, "x")
    shared = spark.conf.get("spark.checkpoint.dir")
    assert workspace.scratch_dir(spark, "x").startswith(shared)
