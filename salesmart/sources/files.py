"""File sources S1 / S3: order-line CSV files and the source tables at rest.

Every read declares its schema (no inference). ``read_order_lines_csv`` fails
on a malformed record instead of silently turning it into NULLs. An import that
must go on takes ``checked_order_lines``: it keeps every line, types those that
keep the table's rules, and says of the others which rules they break.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.plans.model import Oltp
from salesmart.schema import OLTP_SCHEMAS

# S1: ';'-separated, header line, '.' decimal point.
ORDER_LINES_CSV = T.StructType([
    T.StructField("nocom", T.LongType(), False),
    T.StructField("refprod", T.LongType(), False),
    T.StructField("prixunit", T.DecimalType(10, 2), False),
    T.StructField("qte", T.IntegerType(), False),
    T.StructField("remise", T.DecimalType(3, 2), True),
])
CSV_OPTIONS = {"sep": ";", "header": "true", "mode": "FAILFAST"}


def read_order_lines_csv(spark: SparkSession, path: str) -> DataFrame:
    """Order lines from one CSV file or a folder of them."""
    return spark.read.options(**CSV_OPTIONS).schema(ORDER_LINES_CSV).csv(path)


# A line as it stands in the file; what has too few or too many fields is kept whole in the last column.
BROKEN = "_corrupt_record"
RAW_LINES_CSV = T.StructType([T.StructField(f.name, T.StringType()) for f in ORDER_LINES_CSV.fields] + [T.StructField(BROKEN, T.StringType())])
RAW_OPTIONS = {"sep": ";", "header": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
#: What the table requires beside its types, by the name of the rule.
LINE_CHECKS = {"qte_positive": "qte <= 0", "remise_bornee": "remise < 0 OR remise > 1"}


def read_raw_order_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of CSV files as text, with the file that each comes from."""
    return with_source_file(spark.read.options(**RAW_OPTIONS).schema(RAW_LINES_CSV).csv(path))


def with_source_file(raw: DataFrame) -> DataFrame:
    """``raw`` and its file's path, size and time."""
    return raw.select("*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_size").alias("source_size"),
                      F.col("_metadata.file_modification_time").alias("source_time"))


def _number_rule(field: T.StructField) -> tuple[str, F.Column]:
    """(name of the rule, whether a field's text is no number of the declared type, digits included)."""
    text = F.trim(F.col(field.name))
    exact = r"^[+-]?[0-9]+$" if not isinstance(field.dataType, T.DecimalType) else rf"^[+-]?([0-9]+([.][0-9]{{0,{field.dataType.scale}}})?|[.][0-9]{{1,{field.dataType.scale}}})$"
    return f"{field.name}_lisible", text.isNotNull() & (text != "") & ~(text.rlike(exact) & text.try_cast(field.dataType).isNotNull())


def checked_order_lines(raw: DataFrame, keep: Iterable[str] = ("source_file",)) -> DataFrame:
    """Typed lines with ``ligne`` (the text of the line) and ``regles``, the rules it breaks (empty: the line is good).

    A line whose fields are too few or too many, a field that is no number of its
    column's type (too many decimals or digits included), a missing required field and a
    broken check of the table are rules. Fields that can't be read are NULL.
    """
    fields = ORDER_LINES_CSV.fields
    whole = F.col(BROKEN).isNull()
    readable = dict(_number_rule(f) for f in fields)
    typed = raw.select(
        *[F.when(whole & ~F.coalesce(bad, F.lit(False)), F.trim(F.col(f.name)).try_cast(f.dataType)).alias(f.name) for f, bad in zip(fields, readable.values(), strict=True)],
        F.when(whole, F.concat_ws(";", *[F.coalesce(F.col(f.name), F.lit("")) for f in fields])).otherwise(F.col(BROKEN)).alias("ligne"),
        F.array_compact(F.array(
            F.when(~whole, F.lit("champs")),
            *[F.when(whole & bad, F.lit(name)) for name, bad in readable.items()],
            *[F.when(whole & (F.coalesce(F.trim(F.col(f.name)), F.lit("")) == ""), F.lit(f"{f.name}_presente")) for f in fields if not f.nullable])).alias("_types"),
        *keep)
    checks = F.array_compact(F.array(*[F.when(F.expr(broken), F.lit(name)) for name, broken in LINE_CHECKS.items()]))
    return typed.select(*[f.name for f in fields], "ligne", F.concat("_types", checks).alias("regles"), *keep)


def write_checked_lines(checked: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Good and rejected lines, written apart in one pass: ``<path>/rejet=false`` and ``<path>/rejet=true``."""
    checked.withColumn("rejet", F.size("regles") > 0).write.mode(mode).partitionBy("rejet").parquet(path)


CHECKED = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in ORDER_LINES_CSV.fields), "ligne string, regles array<string>, source_file string, rejet boolean"])


def read_checked_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good lines, rejected lines with their rules and file) as written; each reads its own files only."""
    both = spark.read.schema(CHECKED).parquet(path)
    good = both.where("NOT rejet").select(*[f.name for f in ORDER_LINES_CSV.fields])
    return good, both.where("rejet").select("ligne", "regles", "source_file")


def import_order_lines(spark: SparkSession, csv_path: str, path: str) -> tuple[DataFrame, DataFrame]:
    """S1 into a folder: the good and the rejected lines of CSV files, each file read once."""
    write_checked_lines(checked_order_lines(read_raw_order_lines(spark, csv_path)), path)
    return read_checked_lines(spark, path)


def read_oltp(spark: SparkSession, root: str, fmt: str = "parquet") -> Oltp:
    """S3: the 8 source tables, one folder each under ``root``."""
    return Oltp(**{name: spark.read.schema(schema).format(fmt).load(f"{root.rstrip('/')}/{name}")
                   for name, schema in OLTP_SCHEMAS.items()})


def write_oltp(oltp: Oltp, root: str, mode: str = "overwrite") -> None:
    """Persist source tables (e.g. a snapshot taken before a refresh)."""
    for name, df in oltp.tables().items():
        df.write.mode(mode).parquet(f"{root.rstrip('/')}/{name}")


def from_rows(spark: SparkSession, name: str, rows: list[tuple | dict]) -> DataFrame:
    """A small reference table given as literal rows (categories,
    carriers, employees), typed by the declared schema. Values are cast
    explicitly (e.g. a manager number written as the text '2')."""
    schema = OLTP_SCHEMAS[name]
    as_text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    norm = [tuple(None if (r.get(f.name) if isinstance(r, dict) else r[i]) is None
                  else str(r.get(f.name) if isinstance(r, dict) else r[i])
                  for i, f in enumerate(schema.fields)) for r in rows]
    df = spark.createDataFrame(norm, as_text)
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

