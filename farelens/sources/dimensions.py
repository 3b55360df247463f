"""Airport and airline names, cut to the two columns the joins use."""

from pyspark.sql import DataFrame, SparkSession

from farelens.schemas import AIRLINE, AIRPORT


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AIRPORT).option("delimiter", ",").csv(path).select("City", "IATA")


def read_airlines(spark: SparkSession, path: str) -> DataFrame:
    """Airlines that have both a name and a code. The text ``\\N`` is a value, not a null."""
    airlines = spark.read.schema(AIRLINE).option("delimiter", ",").csv(path)
    return airlines.select("Airline_name", "IATA").na.drop("any")


def write_dimension(df: DataFrame, path: str) -> None:
    """A header-less CSV in the layout the readers above expect."""
    df.write.mode("overwrite").csv(path)
