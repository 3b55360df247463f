"""The registered queries. Each takes (spark, sf_dir) and reads its tables whole."""

import uuid
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens import functions as fn
from farelens.operators import metrics
from farelens.operators import offers as ops
from farelens.operators import tickets as tix
from farelens.plans import tables
from farelens.plans.export import ticket_export, ticket_reexport
from farelens.schemas import OFFER, REQUEST_KEY, TICKET
from farelens.sources import dimensions, tickets as files
from farelens.sources import offers as landing
from farelens.sources.exports import read_export
from farelens.sources.landing import (
    in_landing_order,
    land_offers,
    missing_requests,
    read_landed,
    request_index,
)
from farelens.streaming import metrics as streams
from farelens.streaming import offers as offer_streams
from farelens.streaming.runner import newest_rows, run_to_memory, start_table
from farelens.workspace import RELEASE, WRITERS, folders, scratch_dir, session_settings, stored

#: Decimals of prices and of event values, for averages that are exact.
CENTS, MICROS = 2, 6

#: Files a stream takes per micro-batch. The staged files are one or more per line number, year
#: or day, so every stream takes several batches and keys come again in later ones.
FILES_PER_BATCH = 4

#: Micro-batches that a stream takes over what has landed. Files follow bytes, so a landing of more
#: files than these batches hold is taken in larger batches: each costs a commit of every state
#: partition, and their number must not grow with the table.
BATCHES = 12


# --- sources -------------------------------------------------------------------------


def csv_airport_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airports from a header-less CSV, with the number of customers living there."""
    path = scratch_dir(spark, "airports")
    dimensions.write_dimension(tables.airport_file_rows(spark, sf_dir), path)
    airports = dimensions.read_airports(spark, path)
    customers = tables.table(spark, sf_dir, "customer")
    homes = customers.select(tables.code(F.col("c_nationkey")).alias("IATA"))
    per_code = homes.groupBy("IATA").agg(F.count(F.lit(1)).alias("n_customers"))
    return per_code.join(airports, "IATA").select("City", "IATA", "n_customers")


def csv_airline_dim_notnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "airlines")
    dimensions.write_dimension(tables.airline_file_rows(spark, sf_dir), path)
    return dimensions.read_airlines(spark, path)


def csv_glob_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticket files read by a glob, named, and summed up in SQL."""
    path = scratch_dir(spark, "ticket-files")
    orders = tables.table(spark, sf_dir, "orders")
    files.write_ticket_files(_by_year(orders), path, by="year")
    files.ticket_view(spark, f"{path}/*/*.csv", "ticket_files")
    return spark.sql(
        """
        SELECT Company,
               count(*) AS n_rows,
               count(ville_descale) AS n_layovers,
               CAST(sum(CAST(price AS decimal(18,2))) AS double) AS total
        FROM ticket_files
        GROUP BY Company
        """
    )


def json_offer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers landed as JSON files in request order, read back with the fixed schema."""
    path = scratch_dir(spark, "offers")
    land_offers(tables.offers(spark, sf_dir, in_landing_order), path, in_order=True)
    return _offer_facts(read_landed(spark, path))


def text_offer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers parsed from a column of JSON text."""
    text = tables.offers(spark, sf_dir).select(F.to_json(F.struct(*OFFER.names)).alias("json"))
    return _offer_facts(landing.offers_from_text(text, "json"))


def date_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request of the sweep over the routes on offer, with its number of answers."""
    offers = tables.offers(spark, sf_dir)
    routes = offers.select("origin", "destination", "adults").distinct()
    answers = offers.groupBy(*REQUEST_KEY).agg(F.count(F.lit(1)).alias("n"))
    requests = landing.request_sweep(routes, *_sweep_ends(offers))
    return requests.join(answers, list(REQUEST_KEY), "left").select(
        "origin",
        "destination",
        F.col("request_date").cast("string").alias("request_date"),
        F.col("adults").cast("long").alias("adults"),
        F.coalesce("n", F.lit(0)).alias("n_offers"),
    )


def date_sweep_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sweep in two goes: the first lands its earlier half, the second asks for all and
    lands what is missing. The answers are counted from the index of what has landed."""
    path, offers = scratch_dir(spark, "landings"), tables.offers(spark, sf_dir)
    routes = offers.select("origin", "destination", "adults").distinct()
    first, last = _sweep_ends(offers)
    for end in (first + (last - first) / 2, last):
        asked = missing_requests(landing.request_sweep(routes, first, end), path)
        asked = stored(asked.select(*REQUEST_KEY))
        answers = tables.offers(spark, sf_dir, partial(_answers, asked))
        land_offers(answers, path, asked, in_order=True)
    answers = request_index(spark, path).groupBy(*REQUEST_KEY).agg(F.sum("n_offers").alias("n_offers"))
    return answers.select(
        "origin",
        "destination",
        F.col("request_date").cast("string").alias("request_date"),
        F.col("adults").cast("long").alias("adults"),
        "n_offers",
    )


def _answers(asked: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows with the key of an offer that answer one of the requests, in landing order."""
    return in_landing_order(rows.join(asked, list(REQUEST_KEY), "left_semi"))


# --- offers --------------------------------------------------------------------------


def bookable_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    offers = ops.bookable_offers(tables.offers(spark, sf_dir))
    return offers.select(
        "id",
        "origin",
        "destination",
        F.col("request_date").cast("string").alias("request_date"),
        F.col("adults").cast("long").alias("adults"),
        "lastTicketingDate",
        F.coalesce(F.size("itineraries"), F.lit(0)).cast("long").alias("n_itineraries"),
        F.size("travelerPricings").cast("long").alias("n_travelers"),
        F.col("price.grandTotal").alias("prices"),
    )


def explode_itineraries(spark: SparkSession, sf_dir: str) -> DataFrame:
    its = ops.itineraries(ops.bookable_offers(tables.offers(spark, sf_dir)))
    return _plain(
        its,
        "id",
        "request_date",
        "itinerary_pos",
        "n_segments",
        "escale",
        F.get("segments", 0)["departure"]["at"].alias("first_departure"),
        F.get("segments", F.col("n_segments") - 1)["arrival"]["iataCode"].alias("last_arrival"),
    )


def explode_travelers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ops.travelers(ops.bookable_offers(tables.offers(spark, sf_dir)))
    return _plain(rows, "id", "request_date", "travelerId", "Cabin")


def direct_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    its = ops.itineraries(ops.bookable_offers(tables.offers(spark, sf_dir)))
    return _plain(ops.direct_legs(its).drop("price", "travelerPricings"))


def connecting_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    its = ops.itineraries(ops.bookable_offers(tables.offers(spark, sf_dir)))
    return _plain(ops.connecting_legs(its).drop("price", "travelerPricings"))


def offer_fares(spark: SparkSession, sf_dir: str, stops: str) -> DataFrame:
    """One flat fare per offer."""
    fares = ops.offer_fares(tables.offers(spark, sf_dir), stops)
    return _plain(fares)


# --- tickets -------------------------------------------------------------------------


def offer_fares_stream(
    spark: SparkSession, sf_dir: str, stops: str, max_files: int = FILES_PER_BATCH
) -> DataFrame:
    """De-duplication as a stream; copies of an offer come in different batches."""
    stream = _offer_stream(spark, sf_dir, max_files)
    return _plain(offer_streams.stream_offer_fares(stream, stops))


def ticket_table_stream(
    spark: SparkSession, sf_dir: str, stops: str, max_files: int = FILES_PER_BATCH
) -> DataFrame:
    """Landed offers to the ticket table as a stream."""
    names = tables.airports(spark, sf_dir), tables.airlines(spark, sf_dir)
    stream = _offer_stream(spark, sf_dir, max_files)
    return _plain(tix.ticket_table(offer_streams.stream_plane_tickets(stream, *names, stops)))


def join_airline(spark: SparkSession, sf_dir: str) -> DataFrame:
    its = ops.itineraries(ops.bookable_offers(tables.offers(spark, sf_dir)))
    named = tix.with_company(ops.direct_legs(its), tables.airlines(spark, sf_dir))
    return _plain(named, "id", "request_date", "itinerary_pos", "carrier", "Company")


def join_airport_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connecting legs with the airport table joined in its three roles."""
    its = ops.itineraries(ops.bookable_offers(tables.offers(spark, sf_dir)))
    airports = tables.airports(spark, sf_dir)
    named = (
        ops.connecting_legs(its)
        .transform(tix.with_city, airports, "layover_airport", "ville_descale")
        .transform(tix.with_city, airports, "departure_airport", "ville_de_depart")
        .transform(tix.with_city, airports, "arrival_airport", "ville_darrivee")
    )
    return _plain(
        named, "id", "departure_time", "ville_de_depart", "ville_descale", "ville_darrivee"
    )


def connecting_tickets_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connecting tickets whose three cities come from one join with the airports."""
    fares = ops.offer_fares(tables.offers(spark, sf_dir), "connecting")
    names = tables.airports(spark, sf_dir), tables.airlines(spark, sf_dir)
    return _plain(tix.connecting_tickets(fares, *names, one_pass=True))


def airlines_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct fares with the name or names that the airline had on the request date."""
    offers = tables.offers(spark, sf_dir)
    fares = ops.offer_fares(offers, "direct")
    versions = tables.airline_versions(spark, sf_dir).withColumnsRenamed(
        {"IATA": "carrier", "Airline_name": "Company"}
    )
    rows = fares.select("id", "origin", "request_date", "carrier")
    return _plain(tix.as_of(rows, versions, "carrier", "request_date", span=_sweep_ends(offers)))


def plane_tickets(spark: SparkSession, sf_dir: str, stops: str) -> DataFrame:
    return _plain(
        tix.plane_tickets(
            tables.offers(spark, sf_dir),
            tables.airports(spark, sf_dir),
            tables.airlines(spark, sf_dir),
            stops,
        )
    )


def ticket_table(spark: SparkSession, sf_dir: str, stops: str) -> DataFrame:
    return _plain(_ticket_table(spark, sf_dir, stops))


def ticket_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sweep's tickets written as files per date and read back."""
    return _plain(files.read_tickets(spark, _export(spark, sf_dir)))


def ticket_reexport_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export of direct tickets whose later half of dates a second sweep replaces by connecting
    ones; the other dates stay as the first has written them."""
    path, offers = scratch_dir(spark, "export"), tables.offers(spark, sf_dir)
    routes = offers.select("origin", "destination", "adults").distinct()
    first, last = _sweep_ends(offers)
    names = tables.airports(spark, sf_dir), tables.airlines(spark, sf_dir)
    for start, stops in ((first, "direct"), (first + (last - first) / 2, "connecting")):
        requests = stored(landing.request_sweep(routes, start, last))
        ticket_reexport(requests, offers, *names, path, stops)
    return _plain(read_export(spark, path))


def connecting_price_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offer documents to weekday averages in one plan."""
    tickets = _ticket_table(spark, sf_dir, "connecting")
    return _plain(metrics.avg_price_by_weekday(tickets, exact=CENTS))


def export_to_stream(
    spark: SparkSession, sf_dir: str, max_files: int = 32 * FILES_PER_BATCH
) -> DataFrame:
    """The hand-off: exported ticket files, one or more per date, taken up by the weekday stream."""
    stream = files.stream_tickets(spark, _export(spark, sf_dir), max_files=max_files)
    return _plain(streams.stream_avg_price_by_weekday(stream, exact=CENTS))


# --- metrics -------------------------------------------------------------------------


def avg_price_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tables.table(spark, sf_dir, "orders")
    return _plain(metrics.avg_price_by_window(tables.order_tickets(orders), exact=CENTS))


def avg_price_30d_stream(
    spark: SparkSession, sf_dir: str, max_files: int = FILES_PER_BATCH
) -> DataFrame:
    tickets = _ticket_stream(_by_year(tables.table(spark, sf_dir, "orders")), "year", max_files)
    return _plain(streams.stream_avg_price_by_window(tickets, exact=CENTS))


def closed_windows_stream(
    spark: SparkSession, sf_dir: str, max_files: int = FILES_PER_BATCH
) -> DataFrame:
    """Windows that are final once all orders have come, each written once. Years land one after
    the other and the watermark is longer than a year, so no order is late."""
    path = scratch_dir(spark, "staged")
    orders = _by_year(tables.table(spark, sf_dir, "orders"))
    first, last = orders.agg(F.min("year"), F.max("year")).first()
    for year in range(first, last + 1):
        orders.filter(F.col("year") == year).drop("year").write.parquet(f"{path}/year={year}")
    stream = files.stream_files(spark, path, orders.schema, "parquet", max_files=max_files)
    windows, _ = streams.stream_closed_windows(
        stream, scratch_dir(spark, "closed"), watermark="400 days", exact=CENTS
    )
    return _plain(windows)


def avg_price_by_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.table(spark, sf_dir, "lineitem")
    return metrics.avg_price_by_company(tables.line_tickets(lines), exact=CENTS)


def avg_price_by_company_stream(
    spark: SparkSession, sf_dir: str, max_files: int = 1
) -> DataFrame:
    """One file per micro-batch, the finest rate limit, while ``BATCHES`` hold the landing."""
    lines = _by_line(tables.table(spark, sf_dir, "lineitem"))
    tickets = _ticket_stream(lines, "line", max_files)
    return streams.stream_avg_price_by_company(tickets, exact=CENTS)


def avg_price_by_company_live(
    spark: SparkSession, sf_dir: str, max_files: int = FILES_PER_BATCH
) -> DataFrame:
    """The same from a stream that keeps running: started, caught up, stopped, and read."""
    tickets = _ticket_stream(_by_line(tables.table(spark, sf_dir, "lineitem")), "line", max_files)
    averages = metrics.avg_price_by_company(tickets, exact=CENTS)
    path, newest = scratch_dir(spark, "table"), partial(newest_rows, keys=["Company"])
    running = start_table(averages, path, newest, every="0 seconds", compact_every=2)
    try:
        running.catch_up()
    finally:
        running.stop()
    return running.table.read().orderBy("Company")


def company_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the console shows of the company averages: the first 20 rows in order."""
    lines = tables.table(spark, sf_dir, "lineitem")
    return files.preview(
        metrics.avg_price_by_company(tables.line_tickets(lines), exact=CENTS)
    )


def ticket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.table(spark, sf_dir, "lineitem")
    return metrics.ticket_counts(tables.line_tickets(lines), ["id", "Company"])


def price_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tables.table(spark, sf_dir, "orders")
    tickets = tables.order_tickets(orders)
    return _plain(metrics.ticket_counts(tickets, ["date_de_depart", "price", "id"]))


def tickets_by_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.table(spark, sf_dir, "lineitem")
    return metrics.tickets_by_company(tables.line_tickets(lines))


def tickets_by_company_stream(
    spark: SparkSession, sf_dir: str, max_files: int = FILES_PER_BATCH
) -> DataFrame:
    lines = _by_line(tables.table(spark, sf_dir, "lineitem"))
    return streams.stream_tickets_by_company(_ticket_stream(lines, "line", max_files))


def tickets_by_company_bounded(
    spark: SparkSession, sf_dir: str, max_files: int = FILES_PER_BATCH
) -> DataFrame:
    """The same from a state that forgets tickets a day after they arrived."""
    lines = _by_line(tables.table(spark, sf_dir, "lineitem"))
    distinct, _ = streams.stream_distinct_for(
        _ticket_stream(lines, "line", max_files),
        ("id", "Company"),
        keep="1 day",
        path=scratch_dir(spark, "distinct"),
    )
    return metrics.company_totals(distinct)


def avg_price_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tables.table(spark, sf_dir, "orders")
    return _plain(metrics.avg_price_by_weekday(tables.order_tickets(orders), exact=CENTS))


def avg_price_by_weekday_stream(
    spark: SparkSession, sf_dir: str, max_files: int = FILES_PER_BATCH
) -> DataFrame:
    """Orders as ticket files, streamed from there."""
    path = scratch_dir(spark, "ticket-files")
    orders = tables.table(spark, sf_dir, "orders")
    files.write_ticket_files(_by_year(orders), path, by="year")
    stream = files.stream_tickets(spark, path, max_files=max_files)
    return _plain(streams.stream_avg_price_by_weekday(stream, exact=CENTS))


def stream_events_by_type(
    spark: SparkSession, sf_dir: str, max_files: int = 2 * FILES_PER_BATCH
) -> DataFrame:
    """Complete mode into a memory table: its rows are the few types of events."""
    events = tables.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    stats = _staged_stream(events, "day", max_files).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"), metrics.mean("value", MICROS).alias("avg_value")
    )
    name = f"events_by_type_{uuid.uuid4().hex}"
    run_to_memory(stats, name, scratch_dir(spark, "checkpoint"))
    return spark.sql(f"SELECT * FROM {name}")


# --- functions -----------------------------------------------------------------------


def map_filter_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price and currency picked from a map by key, as printed and without brackets."""
    price = F.create_map(
        F.lit("currency"), "price.currency", F.lit("grandTotal"), "price.grandTotal"
    )
    maps = tables.offers(spark, sf_dir).select("id", price.alias("price"))
    return maps.select(
        "id",
        fn.entry_text("price", "grandTotal").alias("prices"),
        fn.as_number(fn.between_ends(fn.entry_text("price", "grandTotal"))).alias("price"),
        fn.between_ends(fn.entry_text("price", "currency")).alias("currency"),
        F.size(fn.entry_values("price", "tax")).cast("long").alias("n_missing"),
    )


def map_filter_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One property of each event, from its properties parsed to a map."""
    events = tables.table(spark, sf_dir, "events")
    maps = events.select("event_id", F.from_json("props", "map<string,string>").alias("props"))
    return maps.select("event_id", F.get(fn.entry_values("props", "k"), 0).alias("k"))


def string_clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    text = F.concat_ws(" ", priority, "o_orderstatus", priority)
    orders = tables.table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        fn.split_item(priority, "-", 0).alias("rank"),
        fn.split_item(priority, "-", 1).alias("label"),
        F.coalesce(fn.split_item(priority, "-", 5), F.lit("none")).alias("absent"),
        fn.tail_from(priority, 3).alias("tail"),
        fn.between_ends(priority).alias("inner"),
        fn.replace_all(priority, "[- ]", "").alias("joined"),
        fn.word_repeats(text, "LOW").cast("string").alias("low_repeats"),
        F.length(priority).cast("long").alias("n_chars"),
    )


def string_clean_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table(spark, sf_dir, "part").select(
        "p_partkey",
        fn.split_item("p_name", " ", 0).alias("color"),
        fn.split_item("p_name", " ", 1).alias("thing"),
        fn.tail_from("p_brand", 7).alias("brand"),
        fn.replace_all("p_type", "[AEIOU]+", "_").alias("type"),
        F.col("p_name").rlike(r"^(red|blue)\b").cast("string").alias("primary_color"),
    )


def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed and malformed prices and dates as text; the malformed become null."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    day = F.col("o_orderdate").cast("date").cast("string")
    status = F.col("o_orderstatus")
    texts = tables.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "F", F.concat(F.lit("EUR"), price)).otherwise(price).alias("price"),
        F.when(status == "P", F.lit("not a day"))
        .when(status == "O", F.concat(day, F.lit("T08:30:00")))
        .otherwise(day)
        .alias("day"),
    )
    return texts.select(
        "o_orderkey",
        fn.as_number("price").alias("price"),
        fn.as_date("day").cast("string").alias("day"),
        fn.as_event_time(texts, "day").cast("string").alias("time"),
    )


# --- shared --------------------------------------------------------------------------


def _by_year(orders: DataFrame) -> DataFrame:
    """Orders as tickets, with the year they are staged by."""
    return tables.order_tickets(orders, year=F.year("o_orderdate"))


def _by_line(lines: DataFrame) -> DataFrame:
    """Line items as tickets, with the line number they are staged by."""
    return tables.line_tickets(lines, line=F.col("l_linenumber"))


def _staged_stream(df: DataFrame, by: str, max_files: int) -> DataFrame:
    """A table landed as one folder per value of a column, large ones in several files, and
    streamed from there."""
    path = scratch_dir(df.sparkSession, "staged")
    with session_settings(df.sparkSession, {RELEASE: "true"}):
        df.hint("rebalance", by).write.partitionBy(by).parquet(path)
    rate = _files_per_batch(df.sparkSession, path, max_files)
    return files.stream_files(df.sparkSession, path, df.schema, "parquet", max_files=rate)


def _files_per_batch(spark: SparkSession, path: str, at_least: int) -> int:
    """``at_least`` files per micro-batch, or so many that ``BATCHES`` take all that has landed."""
    landed = (folders(spark, f"{path}/{folder}") for folder in folders(spark, path) if "=" in folder)
    n_files = sum(not name.startswith(("_", ".")) for names in landed for name in names)
    return max(at_least, -(-n_files // BATCHES))


def _ticket_stream(tickets: DataFrame, by: str, max_files: int) -> DataFrame:
    return _staged_stream(tickets, by, max_files).select(*TICKET.names)


def _offer_stream(spark: SparkSession, sf_dir: str, max_files: int) -> DataFrame:
    path = scratch_dir(spark, "staged")
    _land_by_segments(tables.offers(spark, sf_dir), path)
    rate = _files_per_batch(spark, path, max_files)
    return landing.stream_offers(spark, path, "parquet", max_files=rate)


def _land_by_segments(offers: DataFrame, path: str) -> None:
    """Offers landed by the number of their segments, in which copies of an offer differ. Each task
    writes the documents it builds, side by side into a file per number: to shuffle or sort documents
    takes several times the room of the files. Open files hold a row group each, so these are small."""
    n_segments = F.coalesce(F.size(F.get("itineraries", 0)["segments"]), F.lit(-1))
    with session_settings(offers.sparkSession, {WRITERS: str(2 * tables.MAX_SEGMENTS)}):
        landed = offers.withColumn("landing", n_segments)
        writer = landed.write.partitionBy("landing").option("parquet.block.size", 16 * 2**20)
        writer.parquet(path, compression="zstd")


def _sweep_ends(offers: DataFrame) -> tuple:
    """First and last request date on offer; reads the one column they come from."""
    return tuple(offers.agg(F.min("request_date"), F.max("request_date")).first())


def _ticket_table(spark: SparkSession, sf_dir: str, stops: str) -> DataFrame:
    return tix.ticket_table(
        tix.plane_tickets(
            tables.offers(spark, sf_dir),
            tables.airports(spark, sf_dir),
            tables.airlines(spark, sf_dir),
            stops,
        )
    )


def _export(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "tickets")
    offers = tables.offers(spark, sf_dir)
    routes = offers.select("origin", "destination", "adults").distinct()
    ticket_export(
        stored(landing.request_sweep(routes, *_sweep_ends(offers))),
        offers,
        tables.airports(spark, sf_dir),
        tables.airlines(spark, sf_dir),
        path,
    )
    return path


def _offer_facts(offers: DataFrame) -> DataFrame:
    return _plain(
        offers,
        "origin",
        "destination",
        "request_date",
        "adults",
        "id",
        "lastTicketingDate",
        "numberOfBookableSeats",
        F.coalesce(F.size("itineraries"), F.lit(0)).alias("n_itineraries"),
        F.size(F.get("itineraries", 0)["segments"]).cast("string").alias("n_segments"),
        F.get(F.get("itineraries", 0)["segments"], 0)["departure"]["iataCode"].alias("departure"),
        F.col("price.grandTotal").alias("prices"),
        F.col("price.currency").alias("currency"),
        F.get("travelerPricings", 0)["travelerId"].alias("traveler"),
    )


def _plain(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Columns for the check: times, dates and flags as text, integers as bigint."""
    picked = df.select(*columns) if columns else df
    shown = []
    for name, kind in picked.dtypes:
        column = F.col(name)
        if kind in ("timestamp", "timestamp_ntz", "date", "boolean"):
            column = column.cast("string")
        elif kind == "int":
            column = column.cast("long")
        shown.append(column.alias(name))
    return picked.select(*shown)


QUERIES = {
    "csv_airport_dim": csv_airport_dim,
    "csv_airline_dim_notnull": csv_airline_dim_notnull,
    "csv_glob_scan": csv_glob_scan,
    "json_offer_scan": json_offer_scan,
    "text_offer_scan": text_offer_scan,
    "date_sweep": date_sweep,
    "date_sweep_incremental": date_sweep_incremental,
    "bookable_offers": bookable_offers,
    "explode_itineraries": explode_itineraries,
    "explode_travelers": explode_travelers,
    "direct_legs": direct_legs,
    "connecting_legs": connecting_legs,
    "dedup_by_id_direct": partial(offer_fares, stops="direct"),
    "dedup_by_id_connecting": partial(offer_fares, stops="connecting"),
    "dedup_by_id_direct_stream": partial(offer_fares_stream, stops="direct"),
    "dedup_by_id_connecting_stream": partial(offer_fares_stream, stops="connecting"),
    "ticket_table_connecting_stream": partial(ticket_table_stream, stops="connecting"),
    "join_airline": join_airline,
    "join_airport_roles": join_airport_roles,
    "airlines_as_of": airlines_as_of,
    "connecting_tickets_one_pass": connecting_tickets_one_pass,
    "direct_tickets": partial(plane_tickets, stops="direct"),
    "connecting_tickets": partial(plane_tickets, stops="connecting"),
    "ticket_table_direct": partial(ticket_table, stops="direct"),
    "ticket_table_connecting": partial(ticket_table, stops="connecting"),
    "ticket_export_roundtrip": ticket_export_roundtrip,
    "ticket_reexport_roundtrip": ticket_reexport_roundtrip,
    "connecting_price_by_weekday": connecting_price_by_weekday,
    "export_to_stream": export_to_stream,
    "avg_price_30d": avg_price_30d,
    "avg_price_30d_stream": avg_price_30d_stream,
    "closed_windows_stream": closed_windows_stream,
    "avg_price_by_company": avg_price_by_company,
    "avg_price_by_company_stream": avg_price_by_company_stream,
    "avg_price_by_company_live": avg_price_by_company_live,
    "company_preview": company_preview,
    "ticket_counts": ticket_counts,
    "price_points": price_points,
    "tickets_by_company": tickets_by_company,
    "tickets_by_company_stream": tickets_by_company_stream,
    "tickets_by_company_bounded": tickets_by_company_bounded,
    "avg_price_by_weekday": avg_price_by_weekday,
    "avg_price_by_weekday_stream": avg_price_by_weekday_stream,
    "stream_events_by_type": stream_events_by_type,
    "map_filter_price": map_filter_price,
    "map_filter_events": map_filter_events,
    "string_clean_orders": string_clean_orders,
    "string_clean_parts": string_clean_parts,
    "safe_casts": safe_casts,
}
