"""Sources (S1-S10). Every reader returns a lazy DataFrame; nothing is scanned until
an action, so later projections and filters are pruned/pushed into the scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One Parquet table ``{directory}/{name}.parquet``."""
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def read_paths(spark: SparkSession, paths: Iterable[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Explicit file/dir list (S2): naming only the wanted files prunes input before
    any task starts."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*list(paths))


def read_months(spark: SparkSession, root: str, months: Iterable[str], column: str = "_pickup_month") -> DataFrame:
    """Months of a ``column=value`` partitioned table (S2/S6) through partition pruning."""
    months = list(months)
    return read_partitioned(spark, root).filter(F.col(column).isin(months))


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header and inferred types (S3). Inference costs one extra pass over
    the files; declare the schema (``load_seed``) for anything recurring."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def load_seed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Small versioned CSV with declared types (S4). Quotes/apostrophes survive; the
    literal text 'N/A' stays a string because no null marker is configured."""
    return (spark.read.schema(schema).option("header", True)
            .option("quote", '"').option("escape", '"').csv(path))


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Newline-delimited JSON (S5); pass the schema to skip the inference pass."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_partitioned(spark: SparkSession, root: str, schema: T.StructType | str | None = None,
                     base_path: str | None = None, evolve: bool = False) -> DataFrame:
    """Hive-style ``col=value`` directory tree (S6); partition columns come from the
    path. Declare ``schema`` when a partition value must stay a string ('1996'). With
    ``evolve`` the columns of all files are merged (an appended column is NULL in older
    files); that reads every footer, so it is off where the schema is known not to change."""
    reader = spark.read.option("basePath", base_path or root).option("mergeSchema", evolve)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(root)


def read_named(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table by name."""
    return spark.table(name)


def read_quarantined(spark: SparkSession, path: str, schema: T.StructType | str, parsed_path: str,
                     fmt: str = "csv", header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of CSV or NDJSON files with declared types.

    A record that does not fit the schema - too few or too many fields, text such as "N/A" in a
    numeric column, a quote that swallows the fields behind it, broken JSON - goes to the quarantine as it stands, with
    its file; every other record is a row. The files are parsed once, into ``parsed_path``: both frames
    read that table, so they add up to the records of the files and a lost executor cannot change the
    split. Records are lines: one bad quote cannot swallow the records behind it."""
    typed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    bad, file = "_record", "_file"
    whole = T.StructType([*typed.fields, T.StructField(bad, T.StringType())])
    reader = spark.read.schema(whole).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad)
    if fmt == "csv":
        parsed = reader.option("header", header).option("quote", '"').option("escape", '"').option("multiLine", False).csv(path)
    elif fmt == "json":
        parsed = reader.json(path)
    else:
        raise ValueError(f"no quarantine for {fmt!r}")
    parsed.withColumn(file, F.col("_metadata.file_name")).write.mode("overwrite").parquet(parsed_path)
    stored = spark.read.parquet(parsed_path)
    return (stored.filter(F.col(bad).isNull()).select(*[F.col(f"`{f.name}`") for f in typed.fields]),
            stored.filter(F.col(bad).isNotNull()).select(F.col(bad).alias("record"), F.col(file).alias("file")))
