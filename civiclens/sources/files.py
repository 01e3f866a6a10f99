"""Landing files and CSV exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civiclens.sources.folders import release_after, slices_of

CORRUPT = "_corrupt_record"
"""Column of lines that are no record of the schema."""


def write_landing(requests: DataFrame, folder: str, partition: str = "ingest_month") -> None:
    """Ragged JSON records, one folder per month; NULL fields are left out of a record.

    The REBALANCE hint gathers small months into one file and spreads a large one over many. A large table is written in
    slices of whole months, and files are gzipped: as plain text they take some fifteen times as much.
    """
    for n, part in enumerate(slices_of(requests, partition)):
        spread = part.hint("rebalance", F.col(partition)).write.mode("append" if n else "overwrite")
        spread.option("compression", "gzip").partitionBy(partition).json(folder)
        release_after(part)


LINE = StructType().add("value", "string")


def read_landing(spark: SparkSession, folder: str, partitions: Sequence[str], partition: str) -> DataFrame:
    """Landed lines (``value``) of the given partition folders with their partition; no other folder is listed."""
    reader = spark.read.schema(StructType([*LINE]).add(partition, "string")).option("basePath", folder)
    return reader.text([f"{folder}/{p}" for p in partitions])


def parse_landing(lines: DataFrame, schema: StructType) -> DataFrame:
    """``_row`` (the record), ``_others`` (fields the schema does not name, as text) and ``line`` (if rejected) of each line.

    A line is rejected if it is no JSON object or a field does not have its type; absent fields are NULL, blank lines are
    left out. Columns other than ``value`` are kept. Write the result and read it with ``late_columns`` and ``records``: then
    a line is parsed once however many questions there are.
    """
    others = [c for c in lines.columns if c != "value"]
    known = [name.lower() for name in (*schema.names, *others, CORRUPT)]
    parsed = F.from_json("value", StructType([*schema]).add(CORRUPT, "string"), {"columnNameOfCorruptRecord": CORRUPT})
    rows = lines.where(F.trim("value") != "").withColumn("_row", parsed)
    broken = F.col(f"_row.{CORRUPT}").isNotNull()
    fields = F.from_json("value", "map<string,string>")
    late = F.map_filter(fields, lambda name, _: ~F.lower(name).isin(known))
    return rows.select(
        F.when(~broken, F.col("_row").dropFields(CORRUPT)).alias("_row"),
        F.when(~broken, late).alias("_others"),
        F.when(broken, F.col("value")).alias("line"),
        *others,
    )


def late_columns(parsed: DataFrame) -> list[str]:
    """Names of the fields that the schema does not name, of which there are as many as columns in a table.

    Of names that differ in case only the first is kept.
    """
    fields = parsed.where("line IS NULL").select(F.explode(F.map_keys("_others")).alias("name")).distinct()
    kept: dict[str, str] = {}
    for (name,) in sorted(fields.collect()):
        kept.setdefault(name.lower(), name)
    return list(kept.values())


def records(parsed: DataFrame, late: Sequence[str]) -> DataFrame:
    """The records with their late columns as text."""
    carried = [c for c in parsed.columns if c not in ("_row", "_others", "line")]
    added = [F.try_element_at("_others", F.lit(name)).alias(name) for name in late]
    return parsed.where("line IS NULL").select("_row.*", *added, *carried)


def write_csv(frame: DataFrame, folder: str) -> None:
    """CSV with header, no row index, as spreadsheets and data frames read it: quotes are doubled and
    text may hold line breaks. Blanks at either end of a value are kept. Empty text is
    quoted, NULL is not."""
    (
        frame.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )


def read_csv(spark: SparkSession, folder: str, schema: StructType | None = None) -> DataFrame:
    """CSV with header; without a schema the types are inferred by one more pass. An empty field is
    NULL, quoted or not, so empty text does not survive a round trip."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(folder)
