"""SQL that gives the rows of each registered query on the same tables.

The offer queries are answered straight from ``lineitem``, without nested documents, so the
SQL shares no step with the operators it checks.
"""


def _stop(i: int) -> str:
    return f"lpad(CAST((l_suppkey + {i} * l_partkey) % 30 AS varchar), 3, '0')"


def _time(hours: int) -> str:
    return f"strftime(l_shipdate + INTERVAL {hours} HOUR, '%Y-%m-%dT%H:%M:%S')"


_DOCS = """
docs AS (
  SELECT *,
         CAST(l_orderkey AS varchar) AS id,
         strftime(date_trunc('week', l_shipdate), '%Y-%m-%d') AS request_date,
         strftime(l_shipdate - INTERVAL 7 DAY, '%Y-%m-%d') AS "lastTicketingDate",
         (l_linenumber - 1) % 7 AS n_main,
         CAST(l_quantity AS bigint) % 2 = 0 AS has_return,
         CAST(CAST(l_extendedprice AS decimal(18,2)) AS varchar) AS prices,
         'EUR' AS currency,
         CASE l_suppkey % 2 WHEN 0 THEN 'AAA' ELSE 'AAB' END AS origin,
         CASE l_orderkey % 3 WHEN 0 THEN 'BBA' WHEN 1 THEN 'BBB' ELSE 'BBC' END AS destination,
         1 + l_orderkey % 4 AS adults,
         1 + l_orderkey % 9 AS seats,
         1 + l_orderkey % 3 AS n_travelers,
         CASE WHEN l_tax > 0 THEN 'CABIN-' || CAST((l_linenumber + 1) % 3 AS varchar) END
           AS "Cabin"
  FROM lineitem
),
bookable AS (SELECT * FROM docs WHERE seats >= adults)"""

_ITINERARIES = f"""{_DOCS},
its AS (
  SELECT *, 0 AS itinerary_pos, n_main AS n_segments FROM bookable
  WHERE has_return OR n_main > 0
  UNION ALL
  SELECT *, 1 AS itinerary_pos, 1 AS n_segments FROM bookable WHERE has_return
)"""

_DIRECT = f"""{_ITINERARIES},
legs AS (
  SELECT id, origin, destination, request_date, adults, "lastTicketingDate",
         itinerary_pos, n_segments,
         'false' AS escale,
         CASE itinerary_pos WHEN 0 THEN {_stop(0)} ELSE {_stop(1)} END AS departure_airport,
         CASE itinerary_pos WHEN 0 THEN {_time(0)} ELSE {_time(12)} END AS departure_time,
         CASE itinerary_pos WHEN 0 THEN {_stop(1)} ELSE {_stop(0)} END AS arrival_airport,
         CASE itinerary_pos WHEN 0 THEN {_time(2)} ELSE {_time(14)} END AS arrival_time,
         CAST(CASE itinerary_pos WHEN 0 THEN l_suppkey ELSE l_suppkey // 2 END AS varchar)
           AS carrier,
         prices, currency, "Cabin"
  FROM its WHERE n_segments = 1
)"""

_CONNECTING = f"""{_ITINERARIES},
legs AS (
  SELECT id, origin, destination, request_date, adults, "lastTicketingDate",
         itinerary_pos, n_segments,
         'true' AS escale,
         {_stop(0)} AS departure_airport,
         {_time(0)} AS departure_time,
         {_stop(1)} AS layover_airport,
         {_time(2)} AS layover_arrival_time,
         {_time(3)} AS layover_departure_time,
         {_stop(2)} AS arrival_airport,
         {_time(5)} AS arrival_time,
         CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN NULL
              WHEN l_returnflag = 'N' THEN CAST(l_suppkey // 2 AS varchar)
              ELSE CAST(l_suppkey AS varchar) END AS carrier,
         prices, currency, "Cabin"
  FROM its WHERE n_segments >= 2
)"""


def _fares(stops: str) -> str:
    if stops == "direct":
        base, layover = _DIRECT, ""
    else:
        base = _CONNECTING
        layover = """layover_airport NULLS FIRST, layover_arrival_time NULLS FIRST,
      layover_departure_time NULLS FIRST,"""
    return f"""{base},
fares AS (
  SELECT * FROM legs
  QUALIFY row_number() OVER (
    PARTITION BY id, origin, destination, request_date, adults
    ORDER BY itinerary_pos, "lastTicketingDate" NULLS FIRST, n_segments, escale,
      departure_airport NULLS FIRST, departure_time NULLS FIRST,
      {layover}
      arrival_airport NULLS FIRST, arrival_time NULLS FIRST, carrier NULLS FIRST,
      prices NULLS FIRST, currency NULLS FIRST, "Cabin" NULLS FIRST
  ) = 1
),
airport AS (
  SELECT n_name AS city, lpad(CAST(n_nationkey AS varchar), 3, '0') AS iata
  FROM nation
),
airline AS (
  SELECT s_name AS name, CAST(s_suppkey AS varchar) AS iata
  FROM supplier WHERE s_acctbal >= 0 AND s_name IS NOT NULL
)"""


_DIRECT_TICKETS = f"""{_fares("direct")},
tickets AS (
  SELECT f.request_date, f.adults, f.id,
         f.departure_airport AS "Aeroport_de_depart",
         d.city AS ville_de_depart,
         f.departure_time AS date_de_depart,
         f.arrival_airport AS "Aeroport_darrive",
         a.city AS "Ville_darrivee",
         f.arrival_time AS date_darrivee,
         f.escale, f.currency, f.prices, f."Cabin",
         c.name AS "Company",
         f."lastTicketingDate"
  FROM fares f
  JOIN airline c ON f.carrier = c.iata
  JOIN airport d ON f.departure_airport = d.iata
  JOIN airport a ON f.arrival_airport = a.iata
)"""

_CONNECTING_TICKETS = f"""{_fares("connecting")},
tickets AS (
  SELECT f.request_date, f.adults, f.id,
         f.departure_airport AS "Aeroport_de_depart",
         d.city AS ville_de_depart,
         f.departure_time AS date_de_depart,
         s.city AS ville_descale,
         f.layover_airport AS aeroport_descale,
         f.layover_arrival_time AS date_darrivee_escale,
         f.layover_departure_time AS date_depart_escale,
         f.arrival_airport AS aeroport_darrivee,
         a.city AS ville_darrivee,
         f.arrival_time AS date_darrivee,
         f.escale, f.currency, f.prices, f."Cabin",
         c.name AS "Company",
         f."lastTicketingDate"
  FROM fares f
  JOIN airline c ON f.carrier = c.iata
  JOIN airport d ON f.departure_airport = d.iata
  JOIN airport s ON f.layover_airport = s.iata
  JOIN airport a ON f.arrival_airport = a.iata
)"""

_CONNECTING_TABLE = """
SELECT id, "Aeroport_de_depart", ville_de_depart,
       replace(date_de_depart, 'T', ' ') AS date_de_depart,
       aeroport_darrivee, ville_darrivee,
       replace(date_darrivee, 'T', ' ') AS date_darrivee,
       "Company", CAST(prices AS double) AS price, currency, escale,
       ville_descale, aeroport_descale,
       replace(date_darrivee_escale, 'T', ' ') AS date_darrivee_escale,
       replace(date_depart_escale, 'T', ' ') AS date_depart_escale,
       "lastTicketingDate"
FROM tickets"""

_WEEKDAY = "CAST(dayofweek(CAST(date_de_depart AS timestamp)) + 1 AS bigint)"

_OFFER_FACTS = f"""
WITH {_DOCS}
SELECT origin, destination, request_date, CAST(adults AS bigint) AS adults, id, "lastTicketingDate",
       CAST(seats AS bigint) AS "numberOfBookableSeats",
       CAST(CASE WHEN has_return THEN 2 WHEN n_main > 0 THEN 1 ELSE 0 END AS bigint)
         AS n_itineraries,
       CASE WHEN has_return OR n_main > 0 THEN CAST(n_main AS varchar) END AS n_segments,
       CASE WHEN n_main > 0 THEN {_stop(0)} END AS departure,
       prices, currency, CAST(n_travelers AS varchar) AS traveler
FROM docs"""

_AVG_30D = """
SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(b + INTERVAL 30 DAY, '%Y-%m-%d %H:%M:%S') AS window_end,
       avg_price
FROM (
  SELECT time_bucket(INTERVAL 30 DAY, o_orderdate, TIMESTAMP '1970-01-01') AS b,
         CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS double) / count(o_totalprice) AS avg_price
  FROM orders GROUP BY b
)
ORDER BY window_start"""

_AVG_BY_COMPANY = """
SELECT CAST(l_suppkey AS varchar) AS "Company", 
       CAST(sum(CAST(l_extendedprice AS decimal(18,2))) AS double) / count(l_extendedprice) AS avg_price
FROM lineitem GROUP BY l_suppkey ORDER BY "Company" """

_TICKETS_BY_COMPANY = """
SELECT CAST(l_suppkey AS varchar) AS "Company",
       CAST(count(DISTINCT l_orderkey) AS bigint) AS n_tickets
FROM lineitem GROUP BY l_suppkey ORDER BY n_tickets DESC, "Company" """

_AVG_BY_WEEKDAY = """
SELECT CAST(dayofweek(o_orderdate) + 1 AS bigint) AS weekday,
       CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS double) / count(o_totalprice) AS avg_price
FROM (SELECT DISTINCT o_orderdate, o_totalprice, o_orderkey FROM orders)
GROUP BY weekday ORDER BY weekday"""

ORACLES = {
    "csv_airport_dim": """
        SELECT n_name AS "City", lpad(CAST(n_nationkey AS varchar), 3, '0') AS "IATA",
               CAST(count(*) AS bigint) AS n_customers
        FROM nation JOIN customer ON c_nationkey = n_nationkey
        GROUP BY n_name, n_nationkey""",
    "csv_airline_dim_notnull": """
        SELECT s_name AS "Airline_name", CAST(s_suppkey AS varchar) AS "IATA"
        FROM supplier WHERE s_acctbal >= 0 AND s_name IS NOT NULL""",
    "csv_glob_scan": """
        SELECT o_orderpriority AS "Company", count(*) AS n_rows,
               CAST(0 AS bigint) AS n_layovers,
               CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS double) AS total
        FROM orders GROUP BY o_orderpriority""",
    "json_offer_scan": _OFFER_FACTS,
    "text_offer_scan": _OFFER_FACTS,
    "date_sweep": f"""
        WITH {_DOCS},
        days AS (
          SELECT strftime(d, '%Y-%m-%d') AS request_date
          FROM (SELECT min(date_trunc('week', l_shipdate)) AS first,
                       max(date_trunc('week', l_shipdate)) AS last FROM lineitem),
               unnest(range(first::timestamp, last::timestamp + INTERVAL 1 DAY, INTERVAL 1 DAY)) t(d)
          WHERE day(d) <= 27
        ),
        requests AS (
          SELECT * FROM (SELECT DISTINCT origin, destination, adults FROM docs), days
        )
        SELECT origin, destination, request_date, CAST(adults AS bigint) AS adults,
               count(docs.id) AS n_offers
        FROM requests LEFT JOIN docs USING (origin, destination, request_date, adults)
        GROUP BY origin, destination, request_date, adults""",
    "bookable_offers": f"""
        WITH {_DOCS}
        SELECT id, origin, destination, request_date, CAST(adults AS bigint) AS adults,
               "lastTicketingDate",
               CAST(CASE WHEN has_return THEN 2 WHEN n_main > 0 THEN 1 ELSE 0 END AS bigint)
                 AS n_itineraries,
               CAST(n_travelers AS bigint) AS n_travelers, prices
        FROM bookable""",
    "explode_itineraries": f"""
        WITH {_ITINERARIES}
        SELECT id, request_date, CAST(itinerary_pos AS bigint) AS itinerary_pos,
               CAST(n_segments AS bigint) AS n_segments,
               CASE WHEN n_segments >= 2 THEN 'true' ELSE 'false' END AS escale,
               CASE WHEN itinerary_pos = 1 THEN {_time(12)}
                    WHEN n_segments > 0 THEN {_time(0)} END AS first_departure,
               CASE WHEN itinerary_pos = 1 THEN {_stop(0)}
                    WHEN n_segments > 0
                    THEN lpad(CAST((l_suppkey + n_segments * l_partkey) % 30 AS varchar), 3, '0')
               END AS last_arrival
        FROM its""",
    "explode_travelers": f"""
        WITH {_DOCS}
        SELECT id, request_date, CAST(number AS varchar) AS "travelerId",
               CASE WHEN l_tax > 0 THEN 'CABIN-' || CAST((l_linenumber + number) % 3 AS varchar)
               END AS "Cabin"
        FROM bookable, unnest(range(1, n_travelers + 1)) t(number)""",
    "direct_legs": f"""
        WITH {_DIRECT}
        SELECT id, origin, destination, request_date, CAST(adults AS bigint) AS adults,
               "lastTicketingDate", CAST(itinerary_pos AS bigint) AS itinerary_pos,
               CAST(n_segments AS bigint) AS n_segments, escale, departure_airport,
               departure_time, arrival_airport, arrival_time, carrier
        FROM legs""",
    "connecting_legs": f"""
        WITH {_CONNECTING}
        SELECT id, origin, destination, request_date, CAST(adults AS bigint) AS adults,
               "lastTicketingDate", CAST(itinerary_pos AS bigint) AS itinerary_pos,
               CAST(n_segments AS bigint) AS n_segments, escale, departure_airport,
               departure_time, layover_airport, layover_arrival_time, layover_departure_time,
               arrival_airport, arrival_time, carrier
        FROM legs""",
    "dedup_by_id_direct": f"""
        WITH {_fares("direct")}
        SELECT * REPLACE (CAST(itinerary_pos AS bigint) AS itinerary_pos,
                          CAST(adults AS bigint) AS adults,
                          CAST(n_segments AS bigint) AS n_segments)
        FROM fares""",
    "dedup_by_id_connecting": f"""
        WITH {_fares("connecting")}
        SELECT * REPLACE (CAST(itinerary_pos AS bigint) AS itinerary_pos,
                          CAST(adults AS bigint) AS adults,
                          CAST(n_segments AS bigint) AS n_segments)
        FROM fares""",
    "join_airline": f"""
        WITH {_DIRECT}
        SELECT id, request_date, CAST(itinerary_pos AS bigint) AS itinerary_pos, carrier,
               s_name AS "Company"
        FROM legs JOIN supplier ON carrier = CAST(s_suppkey AS varchar)
        WHERE s_acctbal >= 0""",
    "join_airport_roles": f"""
        WITH {_CONNECTING},
        airport AS (
          SELECT n_name AS city, lpad(CAST(n_nationkey AS varchar), 3, '0') AS iata
          FROM nation
        )
        SELECT id, departure_time, d.city AS ville_de_depart, s.city AS ville_descale,
               a.city AS ville_darrivee
        FROM legs
        JOIN airport d ON departure_airport = d.iata
        JOIN airport s ON layover_airport = s.iata
        JOIN airport a ON arrival_airport = a.iata""",
    "airlines_as_of": f"""
        WITH {_fares("direct")},
        versions AS (
          SELECT s_suppkey, s_name AS name, DATE '1900-01-01' AS low, DATE '1995-06-17' AS high
          FROM supplier WHERE s_acctbal >= 0
          UNION ALL
          SELECT s_suppkey, s_name || ' Group',
                 CASE WHEN s_suppkey % 2 = 0 THEN DATE '1995-01-01' ELSE DATE '1995-06-18' END,
                 CASE WHEN s_suppkey % 2 = 0 THEN DATE '2900-01-01' ELSE DATE '1997-12-31' END
          FROM supplier WHERE s_acctbal >= 0
        )
        SELECT id, origin, request_date, carrier, name AS "Company"
        FROM fares JOIN versions ON carrier = CAST(s_suppkey AS varchar)
          AND CAST(request_date AS date) BETWEEN low AND high""",
    "direct_tickets": f"WITH {_DIRECT_TICKETS} SELECT * EXCLUDE (request_date, adults) FROM tickets",
    "connecting_tickets": (
        f"WITH {_CONNECTING_TICKETS} SELECT * EXCLUDE (request_date, adults) FROM tickets"
    ),
    "ticket_table_direct": f"""
        WITH {_DIRECT_TICKETS}
        SELECT id, "Aeroport_de_depart", ville_de_depart,
               replace(date_de_depart, 'T', ' ') AS date_de_depart,
               "Aeroport_darrive" AS aeroport_darrivee, "Ville_darrivee" AS ville_darrivee,
               replace(date_darrivee, 'T', ' ') AS date_darrivee,
               "Company", CAST(prices AS double) AS price, currency, escale,
               CAST(NULL AS varchar) AS ville_descale,
               CAST(NULL AS varchar) AS aeroport_descale,
               CAST(NULL AS varchar) AS date_darrivee_escale,
               CAST(NULL AS varchar) AS date_depart_escale,
               "lastTicketingDate"
        FROM tickets""",
    "ticket_table_connecting": f"WITH {_CONNECTING_TICKETS} {_CONNECTING_TABLE}",
    "ticket_export_roundtrip": f"""
        WITH {_CONNECTING_TICKETS}
        SELECT id, "Aeroport_de_depart", ville_de_depart, date_de_depart, aeroport_darrivee,
               ville_darrivee, date_darrivee, "Company", CAST(prices AS double) AS price,
               currency, escale, ville_descale, aeroport_descale, date_darrivee_escale,
               date_depart_escale, "lastTicketingDate"
        FROM tickets WHERE day(CAST(request_date AS date)) <= 27""",
    "ticket_reexport_roundtrip": f"""
        WITH middle AS (
          SELECT min(d) + CAST((max(d) - min(d)) // 2 AS integer) AS day
          FROM (SELECT CAST(date_trunc('week', l_shipdate) AS date) AS d FROM lineitem)
        )
        SELECT * FROM (
          WITH {_DIRECT_TICKETS}
          SELECT id, "Aeroport_de_depart", ville_de_depart, date_de_depart,
                 "Aeroport_darrive" AS aeroport_darrivee, "Ville_darrivee" AS ville_darrivee,
                 date_darrivee, "Company", CAST(prices AS double) AS price, currency, escale,
                 CAST(NULL AS varchar) AS ville_descale,
                 CAST(NULL AS varchar) AS aeroport_descale,
                 CAST(NULL AS varchar) AS date_darrivee_escale,
                 CAST(NULL AS varchar) AS date_depart_escale, "lastTicketingDate"
          FROM tickets, middle
          WHERE CAST(request_date AS date) < middle.day AND day(CAST(request_date AS date)) <= 27
        )
        UNION ALL
        SELECT * FROM (
          WITH {_CONNECTING_TICKETS}
          SELECT id, "Aeroport_de_depart", ville_de_depart, date_de_depart, aeroport_darrivee,
                 ville_darrivee, date_darrivee, "Company", CAST(prices AS double) AS price,
                 currency, escale, ville_descale, aeroport_descale, date_darrivee_escale,
                 date_depart_escale, "lastTicketingDate"
          FROM tickets, middle
          WHERE CAST(request_date AS date) >= middle.day AND day(CAST(request_date AS date)) <= 27
        )""",
    "connecting_price_by_weekday": f"""
        WITH {_CONNECTING_TICKETS}
        SELECT {_WEEKDAY} AS weekday, CAST(sum(CAST(prices AS decimal(18,2))) AS double) / count(prices) AS avg_price
        FROM (SELECT DISTINCT date_de_depart, prices, id FROM tickets)
        GROUP BY weekday ORDER BY weekday""",
    "export_to_stream": f"""
        WITH {_CONNECTING_TICKETS}
        SELECT {_WEEKDAY} AS weekday, CAST(sum(CAST(prices AS decimal(18,2))) AS double) / count(prices) AS avg_price
        FROM (
          SELECT DISTINCT date_de_depart, prices, id
          FROM tickets WHERE day(CAST(request_date AS date)) <= 27
        )
        GROUP BY weekday ORDER BY weekday""",
    "avg_price_30d": _AVG_30D,
    "avg_price_30d_stream": _AVG_30D,
    "closed_windows_stream": f"""
        SELECT * FROM ({_AVG_30D})
        WHERE CAST(window_end AS timestamp) <= (
          SELECT max(o_orderdate) - INTERVAL 400 DAY FROM orders
        )""",
    "avg_price_by_company": _AVG_BY_COMPANY,
    "avg_price_by_company_live": _AVG_BY_COMPANY,
    "avg_price_by_company_stream": _AVG_BY_COMPANY,
    "company_preview": f"{_AVG_BY_COMPANY} LIMIT 20",
    "ticket_counts": """
        SELECT CAST(l_orderkey AS varchar) AS id, CAST(l_suppkey AS varchar) AS "Company",
               count(*) AS n
        FROM lineitem GROUP BY l_orderkey, l_suppkey""",
    "price_points": """
        SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date_de_depart,
               o_totalprice AS price, CAST(o_orderkey AS varchar) AS id, count(*) AS n
        FROM orders GROUP BY o_orderdate, o_totalprice, o_orderkey""",
    "tickets_by_company": _TICKETS_BY_COMPANY,
    "tickets_by_company_stream": _TICKETS_BY_COMPANY,
    "tickets_by_company_bounded": _TICKETS_BY_COMPANY,
    "avg_price_by_weekday": _AVG_BY_WEEKDAY,
    "avg_price_by_weekday_stream": _AVG_BY_WEEKDAY,
    "stream_events_by_type": """
        SELECT event_type, count(*) AS n_events, CAST(sum(CAST(value AS decimal(18,6))) AS double) / count(value) AS avg_value
        FROM events GROUP BY event_type""",
    "map_filter_price": f"""
        WITH {_DOCS}
        SELECT id, '[' || prices || ']' AS prices, CAST(prices AS double) AS price, currency,
               CAST(0 AS bigint) AS n_missing
        FROM docs""",
    "map_filter_events": "SELECT event_id, props->>'k' AS k FROM events",
    "string_clean_orders": """
        SELECT o_orderkey,
               string_split_regex(o_orderpriority, '-')[1] AS rank,
               string_split_regex(o_orderpriority, '-')[2] AS label,
               coalesce(string_split_regex(o_orderpriority, '-')[6], 'none') AS absent,
               substring(o_orderpriority, 3, length(o_orderpriority)) AS tail,
               substring(o_orderpriority, 2, length(o_orderpriority) - 2) AS inner,
               regexp_replace(o_orderpriority, '[- ]', '', 'g') AS joined,
               CAST(o_orderpriority = '5-LOW' AS varchar) AS low_repeats,
               CAST(length(o_orderpriority) AS bigint) AS n_chars
        FROM orders""",
    "string_clean_parts": """
        SELECT p_partkey,
               string_split_regex(p_name, ' ')[1] AS color,
               string_split_regex(p_name, ' ')[2] AS thing,
               substring(p_brand, 7, length(p_brand)) AS brand,
               regexp_replace(p_type, '[AEIOU]+', '_', 'g') AS type,
               CAST(regexp_matches(p_name, '^(red|blue)\\b') AS varchar) AS primary_color
        FROM part""",
    "safe_casts": """
        WITH texts AS (
          SELECT o_orderkey,
                 CASE WHEN o_orderstatus = 'F' THEN 'EUR' ELSE '' END
                   || CAST(CAST(o_totalprice AS decimal(18,2)) AS varchar) AS price,
                 CASE o_orderstatus
                   WHEN 'P' THEN 'not a day'
                   WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%dT08:30:00')
                   ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
          FROM orders
        )
        SELECT o_orderkey,
               TRY_CAST(price AS double) AS price,
               strftime(TRY_CAST(day AS timestamp), '%Y-%m-%d') AS day,
               strftime(TRY_CAST(day AS timestamp), '%Y-%m-%d %H:%M:%S') AS time
        FROM texts""",
}
for _name in ("dedup_by_id_direct", "dedup_by_id_connecting", "ticket_table_connecting"):
    ORACLES[f"{_name}_stream"] = ORACLES[_name]
ORACLES["date_sweep_incremental"] = ORACLES["date_sweep"]
ORACLES["connecting_tickets_one_pass"] = ORACLES["connecting_tickets"]
