"""SRC-1..3: readers. Schemas are always declared, never inferred, so a
column drift in the raw files is an error instead of a silent retype."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dealspark.schemas import clean_schema, raw_schema
from dealspark.sources.sinks import published_path

#: Columns that a checked raw read adds: a damaged record as it stands in the file, and its file.
CORRUPT, FILE = "_corrupt_record", "_source_file"


def read_bronze(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """SRC-1: raw CSV directory with a header, every column a string.

    Empty fields read as NULL; blank-only fields stay strings (CSV defaults).
    ``enforceSchema=False`` checks header names against the declared schema.
    """
    return (spark.read.schema(raw_schema(entity)).option("header", True)
            .option("enforceSchema", False).csv(path))


def read_bronze_checked(spark: SparkSession, path: str, entity: str, quoted_breaks: bool = False) -> DataFrame:
    """SRC-1 over files that may be damaged: the raw columns, then ``CORRUPT``
    and ``FILE``. No record vanishes.

    A record with too few or too many fields, or with a quote that never
    closes, keeps its text in ``CORRUPT`` (NULL otherwise); fields that could
    be read stay in their columns. A file whose header differs from the
    declared columns is an error. With ``quoted_breaks`` a quoted field may
    hold line breaks; a file is then one split, so use it only where such
    fields occur (a quote that never closes swallows the lines up to the next
    quote: they all stand in that record's text).
    """
    schema = StructType([*raw_schema(entity).fields, StructField(CORRUPT, StringType(), True)])
    read = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)  # all fields are always parsed
            .option("multiLine", quoted_breaks).csv(path))
    # an empty piece of another column: Spark refuses queries that need the damaged text alone
    beside = F.substring(F.coalesce(F.col(schema[0].name), F.lit("")), 1, 0)
    return read.withColumns({CORRUPT: F.concat(CORRUPT, beside), FILE: F.col("_metadata.file_path")})


def split_corrupt(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound rows with the raw columns alone, damaged records with their text and file)."""
    sound = checked.where(F.col(CORRUPT).isNull()).drop(CORRUPT, FILE)
    return sound, checked.where(F.col(CORRUPT).isNotNull())


def read_typed_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """SRC-3: typed CSV (analysis / training inputs) with a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_clean_csv(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """SRC-3 for an entity whose file is already clean (the analysis script's
    view of the raw files): the clean schema minus derived columns."""
    derived = {"is_contactable", "channel_standardized"}
    schema = StructType([f for f in clean_schema(entity).fields if f.name not in derived])
    return read_typed_csv(spark, path, schema)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2: clean/curated Parquet, the current version where the table is
    published in versions; Catalyst pushes filters and prunes columns."""
    return spark.read.parquet(published_path(spark, path))
