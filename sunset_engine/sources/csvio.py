"""CSV sources and sinks for the raw inputs and the report files.

The large inputs (flights, airports) have a declared schema: no inference pass over them, and bad
values become NULL (``PERMISSIVE``) instead of failing the job. The CSV reader is
quote-aware, so a quoted comma such as ``"A, Inc."`` stays inside its field, and
it accepts CRLF line ends. ``header=True`` drops header lines wherever they stand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sunset_engine.functions.text import strip_quotes
from sunset_engine.functions.timeparse import parse_iso_date

# Column layout of the monthly on-time flight CSVs (first 11 fields).
FLIGHT_COLUMNS = ["FlightDate", "Airline", "Origin", "Dest", "Cancelled", "Diverted", "CRSDepTime", "DepTime",
                  "DepDelayMinutes", "DepDelay", "ArrTime"]
# Column layout of the public airports table.
AIRPORT_COLUMNS = ["id", "ident", "type", "name", "latitude_deg", "longitude_deg", "elevation_ft", "continent",
                   "iso_country", "iso_region", "municipality", "scheduled_service", "gps_code", "iata_code",
                   "local_code", "home_link", "wikipedia_link", "keywords"]
# Positions used from the wildlife-strike export (0-based).
STRIKE_FIELDS = {"incident_date": 1, "incident_month": 2, "incident_year": 3, "time": 4, "airport_id": 6,
                 "airport_latitude": 8, "airport_longitude": 9}


def _strings(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


def header_fields(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> list[str | None] | None:
    """The fields of the first line found at ``path``; None where there is no line. One line is read."""
    line = spark.read.text(path).first()
    if line is None:
        return None
    parsed = F.from_csv(F.lit(line.value), F.lit(_strings(columns).simpleString()[len("struct<"):-1].replace(":", " ")), {"sep": sep, "quote": '"', "escape": '"'})
    return list(spark.range(1).select(parsed.alias("f")).first().f)


def read_csv(spark: SparkSession, path: str, columns: list[str], header: bool = True, sep: str = ",") -> DataFrame:
    """Typed CSV scan with a declared all-string schema.

    With ``header`` every row that equals the header is dropped, wherever it stands: files put together from
    several hold their header lines in the middle. The header is the first line found. The test is a filter on the rows as they are parsed.
    """
    rows = (spark.read.schema(_strings(columns)).option("header", False).option("sep", sep)
            .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE").csv(path))
    names = header_fields(spark, path, columns, sep) if header else None
    if names is None:
        return rows
    is_header = F.lit(True)
    for column, name in zip(columns, names, strict=True):
        is_header = is_header & F.col(column).eqNullSafe(F.lit(name))
    return rows.where(~is_header)


def read_flights(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Flights with the columns the pipeline uses: flight_date, origin, dest, dep_time, arr_time.

    Only the first 11 fields are declared; later fields of wider files are ignored.
    ``event_id`` is a hash of the fields read: the same for a row however the file is split
    (rows that agree in all of them share it).
    """
    raw = read_csv(spark, path, FLIGHT_COLUMNS, header)
    return raw.select(F.xxhash64(*FLIGHT_COLUMNS).alias("event_id"),
                      parse_iso_date("FlightDate").alias("flight_date"),
                      strip_quotes("Origin").alias("origin"), strip_quotes("Dest").alias("dest"),
                      F.coalesce(F.col("DepTime"), F.lit("")).alias("dep_time"),
                      F.coalesce(F.col("ArrTime"), F.lit("")).alias("arr_time"))


def read_airports(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Airports keyed by IATA code (field 13), with coordinates (fields 4, 5) and type."""
    raw = read_csv(spark, path, AIRPORT_COLUMNS, header)
    return raw.select(F.coalesce(strip_quotes("iata_code"), F.lit("")).alias("airport_id"),
                      F.col("latitude_deg"), F.col("longitude_deg"), F.col("type"))


def read_strikes(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Wildlife-strike rows by field position; headerless by default, as the export is used."""
    raw = spark.read.option("header", header).option("quote", '"').option("escape", '"').csv(path)
    cols = raw.columns
    out = raw.select(F.xxhash64(*cols).alias("event_id"),
                     *[F.col(cols[i]).alias(name) for name, i in STRIKE_FIELDS.items()])
    return out.withColumns({
        "incident_month": F.trim(F.col("incident_month")).try_cast("int"),
        "incident_year": F.trim(F.col("incident_year")).try_cast("int"),
    })


def read_code_list(spark: SparkSession, path: str, sep: str = ";", header: bool = True) -> DataFrame:
    """First field of a delimited code list, quotes stripped."""
    raw = spark.read.option("header", header).option("sep", sep).option("quote", '"').csv(path)
    return raw.select(strip_quotes(F.col(raw.columns[0])).alias("code"))


def read_timezones(spark: SparkSession, path: str, sep: str = ",", header: bool = True, code: int = 0, zone: int = 1) -> DataFrame:
    """Airport codes with their IANA zone: fields ``code`` and ``zone`` of a delimited file, quotes stripped."""
    raw = spark.read.option("header", header).option("sep", sep).option("quote", '"').csv(path)
    return raw.select(strip_quotes(F.col(raw.columns[code])).alias("code"), strip_quotes(F.col(raw.columns[zone])).alias("timezone"))


# Declared types of the training table, for columns whose values don't tell (all of them missing).
TRAINING_TYPES = {"airport_id": "string", "bird_population": "double", "bird_strike_count": "double", "flight_count": "double", "bird_flight_ratio": "double"}


def read_inferred(spark: SparkSession, path: str, fallback: dict[str, str] | None = None, header: bool = True, sep: str = ",") -> DataFrame:
    """CSV with inferred types (S3). A column that inference leaves as text is cast to its type in ``fallback``, where it has one; what does not fit is NULL."""
    df = spark.read.option("header", header).option("inferSchema", True).option("sep", sep).option("quote", '"').option("escape", '"').csv(path)
    unclear = {c: t for c, t in (fallback or {}).items() if t != "string" and dict(df.dtypes).get(c) == "string"}
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in unclear.items()})


def column_types(df: DataFrame) -> DataFrame:
    """The columns as rows: (position, name, type, n_values), the last the number that are not NULL, in one pass over the table."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("name"), F.lit(t).alias("type"), F.col(f"c{i}").alias("n_values")) for i, (c, t) in enumerate(df.dtypes)]
    return counts.select(F.inline(F.array(*rows)))


def read_training(spark: SparkSession, path: str) -> DataFrame:
    """The training table CSV with inferred types, as the model stage reads it (S3)."""
    return read_inferred(spark, path, TRAINING_TYPES)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists") -> None:
    """Distributed CSV write, one part file per partition (K2, K4, K5)."""
    df.write.mode(mode).option("header", header).csv(path)


def write_single_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists", sep: str = ",", quote_all: bool = False) -> None:
    """One CSV file for a small report; fails if the path exists unless ``mode`` says otherwise (K1, K3).

    The single partition is taken only at the sink, after every aggregate ran
    with full parallelism.
    """
    df.coalesce(1).write.mode(mode).option("header", header).option("sep", sep).option("quoteAll", quote_all).csv(path)


def write_sorted_report(df: DataFrame, path: str, by: list[str], mode: str = "overwrite") -> None:
    """Fully sorted report table in one file, NULLs last (K8). A report has one row per airport."""
    (df.repartition(1).sortWithinPartitions(*[F.asc_nulls_last(c) for c in by])
     .write.mode(mode).option("header", True).csv(path))


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """Raster cells ``(row, col, value)`` from Parquet (S7); ``tile_row`` too where the table is partitioned by it.

    A filter on ``tile_row`` then reads only those folders.
    """
    t = spark.read.parquet(path)
    extra = ["tile_row"] if "tile_row" in t.columns else []
    return t.select(F.col("row").cast("int"), F.col("col").cast("int"), F.col("value").cast("double"), *extra)


def write_cells(cells: DataFrame, path: str, tile: int = 256, mode: str = "overwrite") -> None:
    """Raster cells as Parquet partitioned by tile row, so that readers of some rows can prune folders (K7)."""
    (cells.withColumn("tile_row", (F.col("row") / tile).cast("int"))
     .write.mode(mode).partitionBy("tile_row").parquet(path))
