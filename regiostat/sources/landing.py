"""Landed files: API responses as JSON (O-01) and legacy-charset CSV (O-04).

The HTTP client itself is not built: responses are landed as files (one JSON
object per slot) and read here with an explicit schema.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from regiostat.functions.exact import q
from regiostat.functions.scalars import lenient_double

# One landed API response: the request key beside the payload; every payload
# field arrives as a string (F1 in FIXTURES.md).
PAYLOAD_ROW = StructType([StructField(n, StringType()) for n in
                          ("year", "month", "metro", "city", "houseCnt", "powerUsage", "bill")])
LANDING_SCHEMA = StructType([
    StructField("year", StringType()),
    StructField("month", StringType()),
    StructField("metroCd", StringType()),
    StructField("data", ArrayType(PAYLOAD_ROW)),
    StructField("_corrupt_record", StringType()),
])


def read_responses(reader, path: str, schema: StructType = LANDING_SCHEMA) -> DataFrame:
    """Landed responses with the file they came in; ``reader`` is ``spark.read`` or ``spark.readStream``."""
    raw = reader.schema(schema).json(path)
    return raw.select("*", F.col("_metadata.file_modification_time").alias("landed_at"),
                      F.col("_metadata.file_path").alias("file"))


def read_landing(spark: SparkSession, path: str, schema: StructType = LANDING_SCHEMA) -> DataFrame:
    """Landed responses -> one row per payload element, request key attached.

    Missing or empty ``data`` yields no rows and is not a failure; a response
    that is no readable JSON yields one row whose ``unreadable`` holds its text.
    """
    return explode_payload(read_responses(spark.read, path, schema))


def explode_payload(raw: DataFrame) -> DataFrame:
    """``response`` names the landed response and orders them: by landing time, file, place."""
    bad = F.col("_corrupt_record")
    nothing = F.array(F.lit(None).cast(PAYLOAD_ROW))
    response = F.struct("landed_at", "file", F.monotonically_increasing_id().alias("place"))
    # named before the explode: within one select the place would be the element's
    named = raw.withColumn("response", response)
    return (named.select(F.col("year").alias("req_year"), F.col("month").alias("req_month"), F.col("metroCd"),
                         "response", bad.alias("unreadable"),
                         F.explode(F.when(bad.isNotNull(), nothing).otherwise(F.col("data"))).alias("d"))
                 .select("req_year", "req_month", "metroCd", "response", "unreadable", "d.*"))


def read_legacy_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
                    encoding: str = "x-windows-949", header: bool = True) -> DataFrame:
    """CSV in a legacy Korean code page (O-04, S25).

    ``x-windows-949`` (CP949) is a superset of EUC-KR; plain EUC-KR turns the
    extended syllables into U+FFFD.  Needs ``spark.sql.legacy.javaCharsets``.
    Without a schema every column is read as a string (bronze stays untyped).
    """
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    reader = spark.read.option("header", header).option("encoding", encoding).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", False)
    return reader.csv(path)


# --------------------------------------------- checked CSV (O-04, O-54, O-23)
CORRUPT = "_corrupt_line"
QUARANTINE = "file string, line string, reason string"


def csv_headers(spark: SparkSession, path: str, encoding: str = "x-windows-949") -> DataFrame:
    """The header line of every file below ``path``: one row a file."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    lines = (spark.read.schema("line string").option("encoding", encoding).option("sep", "\u0001").option("quote", "")
                  .csv(path).select("line", F.col("_metadata.file_path").alias("file"),
                                    F.col("_metadata.file_block_start").alias("start"),
                                    F.monotonically_increasing_id().alias("place")))
    # only the split at the beginning of a file can hold its header, as its first line
    return lines.where("start = 0").groupBy("file").agg(F.min_by("line", "place").alias("header"))


def header_names(header: str, sep: str = ",") -> list[str]:
    """Column names of a header line (quotes as CSV has them)."""
    return next(csv.reader([header], delimiter=sep))


def read_csv_checked(spark: SparkSession, path: str, columns: Sequence[str], encoding: str = "x-windows-949"):
    """CSV whose columns and lines may have drifted -> (rows, quarantine, drift).

    Files are read by the header each of them has, so columns may come in any
    order; ``rows`` has ``columns`` (as strings; NULL where a file lacks one).
    ``quarantine`` has the lines that don't fit their header (too few or too
    many values), with the file; ``drift`` has one row for each file and
    ``missing`` or ``extra`` column.  No line is lost: each is in ``rows`` or in
    ``quarantine``.  Files of one header are one scan; headers are few.
    """
    heads = [(r["file"], r["header"]) for r in csv_headers(spark, path, encoding).collect()]  # one line a file
    by_header: dict[str, list[str]] = {}
    for file, header in sorted(heads):
        by_header.setdefault(header, []).append(file)
    rows = spark.createDataFrame([], StructType([StructField(c, StringType()) for c in columns]))
    bad = spark.createDataFrame([], QUARANTINE)
    drift = []
    for header, files in by_header.items():
        names = header_names(header)
        drift += [(f, kind, c) for f in files for kind, cs in (
            ("missing", [c for c in columns if c not in names]), ("extra", [c for c in names if c not in columns])) for c in cs]
        if len(set(names)) < len(names):
            raise ValueError(f"a header repeats a column: {files[0]}")
        schema = StructType([*(StructField(c, StringType()) for c in names), StructField(CORRUPT, StringType())])
        part = (spark.read.schema(schema).option("header", True).option("encoding", encoding).option("mode", "PERMISSIVE")
                     .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(files))
        part = part.select("*", F.col("_metadata.file_path").alias("_file"))
        held = sum((F.col(q(c)).isNotNull().cast("int") for c in names), F.lit(0))
        # naming every column keeps them all in the scan: a line's width is only
        # checked against the columns that are read
        fits, misfits = F.col(CORRUPT).isNull() & (held >= 0), F.col(CORRUPT).isNotNull() & (held >= 0)
        rows = rows.unionByName(part.where(fits).select(*[
            (F.col(q(c)) if c in names else F.lit(None).cast("string")).alias(c) for c in columns]))
        reason = F.format_string("not a line of %d values (%d read)", F.lit(len(names)), held)
        bad = bad.unionByName(part.where(misfits).select(F.col("_file").alias("file"), F.col(CORRUPT).alias("line"),
                                                       reason.alias("reason")))
    return rows, bad, spark.createDataFrame(drift, "file string, kind string, column string")


def unparsed_values(rows: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """(column, value, rows): what the lenient parse (O-54) turns into missing although it is not blank."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(q(c)).alias("value"), lenient_double(q(c)).alias("number"))
                                for c in numeric]))
    found = rows.select(pairs.alias("p")).select("p.*").where("number IS NULL AND trim(value) <> ''")
    return found.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))


def write_legacy_csv(df: DataFrame, path: str, encoding: str = "x-windows-949") -> None:
    df.sparkSession.conf.set("spark.sql.legacy.javaCharsets", "true")
    df.write.mode("overwrite").option("header", True).option("encoding", encoding).csv(path)
