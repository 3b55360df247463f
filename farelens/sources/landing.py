"""Offers landed in sorted files of an even size, with an index of requests.

A landing is one set of answers: files in request order, cut by bytes and not by request, so a sweep
of many small requests makes few files and a request with very many offers several. The index lists
per request and file how many offers are there, asked requests without an answer included. It is
written last: a landing without its index does not count, and one cut off is simply landed again.

The index answers what is landed without a look at the offers, and names the files that hold given
requests, so only those are read.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.schemas import OFFER, REQUEST_KEY
from farelens.sources.offers import read_offers
from farelens.workspace import folders

INDEX = T.StructType(
    [*(OFFER[c] for c in REQUEST_KEY), T.StructField("file", T.StringType()), T.StructField("n_offers", T.LongType())]
)


def in_landing_order(rows: DataFrame) -> DataFrame:
    """Rows with the key of an offer, cut into ranges of request and id and sorted within them."""
    order = [*REQUEST_KEY, "id"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def land_offers(
    offers: DataFrame,
    path: str,
    asked: DataFrame | None = None,
    fmt: str = "json",
    in_order: bool = False,
) -> None:
    """Add a landing. ``asked`` are its requests (REQUEST_KEY); those that no offer answers are kept
    in the index, so that they are not asked for again.

    Files are cut from the order of request and id, so a request that holds much of the data is
    spread over several. With ``in_order`` the offers are as :func:`in_landing_order` leaves them. Who
    orders what documents are made from saves a sort of whole documents, and making them all once more
    for the sample that the ranges are cut by.
    """
    spark, name = offers.sparkSession, f"landing-{uuid.uuid4().hex}"
    files = offers.select(*OFFER.names)
    if not in_order:
        files = in_landing_order(files)
    writer = files.write.format(fmt)
    if fmt == "json":
        writer = writer.option("compression", "gzip")
    writer.save(f"{path}/{name}")
    keys = T.StructType([OFFER[c] for c in REQUEST_KEY])
    landed = spark.read.schema(keys).format(fmt).load(f"{path}/{name}")
    file = F.concat(F.lit(f"{name}/"), F.col("_metadata.file_name")).alias("file")
    counts = landed.groupBy(*REQUEST_KEY, file).agg(F.count(F.lit(1)).alias("n_offers"))
    if asked is not None:
        nothing = asked.select(*REQUEST_KEY).distinct().join(counts, list(REQUEST_KEY), "left_anti")
        nothing = nothing.withColumns({"file": F.lit(None).cast("string"), "n_offers": F.lit(0).cast("long")})
        counts = counts.union(nothing)
    counts.write.parquet(f"{path}/_index/{name}")


def request_index(spark: SparkSession, path: str) -> DataFrame:
    """The index of all whole landings: request, file, n_offers; a null file where nothing came."""
    names = [n for n in folders(spark, f"{path}/_index") if "_SUCCESS" in folders(spark, f"{path}/_index/{n}")]
    if not names:
        return spark.createDataFrame([], INDEX)
    return spark.read.schema(INDEX).parquet(*(f"{path}/_index/{n}" for n in names))


def missing_requests(requests: DataFrame, path: str) -> DataFrame:
    """The requests that no landing has asked yet. Reads the index, no offers."""
    landed = request_index(requests.sparkSession, path).select(*REQUEST_KEY).distinct()
    return requests.join(landed, list(REQUEST_KEY), "left_anti")


def read_landed(
    spark: SparkSession, path: str, requests: DataFrame | None = None, fmt: str = "json"
) -> DataFrame:
    """Offers of all whole landings, or of given requests: then only files that hold some of them
    are read. Their names come to the driver, as the names of all files that a scan reads do."""
    index = request_index(spark, path).filter("file IS NOT NULL")
    if requests is not None:
        requests = requests.select(*REQUEST_KEY).distinct()
        index = index.join(requests, list(REQUEST_KEY), "left_semi")
    files = [f"{path}/{r.file}" for r in index.select("file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], OFFER)
    offers = read_offers(spark, files, fmt)
    if requests is None:
        return offers
    return offers.join(requests, list(REQUEST_KEY), "left_semi").select(*OFFER.names)
