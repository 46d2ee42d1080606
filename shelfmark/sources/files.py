"""CSV and Parquet files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType

from shelfmark.functions.numbers import exact_number, number_fault
from shelfmark.schemas import all_text, required
from shelfmark.session import durable

CORRUPT = "_corrupt_record"
REASONS = "reject_reasons"

# Quotes are doubled inside a quoted value, and leading and trailing blanks belong to it.
CSV_FORMAT = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str, schema: StructType, keep_corrupt: bool = False) -> DataFrame:
    """A CSV file or directory under an explicit schema; no extra pass to guess types.

    Empty values and values that do not fit become NULL. With `keep_corrupt` the text of such a line is kept in
    `_corrupt_record`.
    """
    reader = spark.read.options(**CSV_FORMAT).option("mode", "PERMISSIVE")
    if keep_corrupt:
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def _typed(text: Column, kind: DataType) -> Column:
    """The value of a text, NULL where the type does not hold it exactly."""
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, DecimalType):
        return exact_number(text, kind.precision - kind.scale, kind.scale)
    if isinstance(kind, (IntegerType, LongType)):
        return exact_number(text, 19, 0).try_cast(kind)
    if isinstance(kind, DateType):
        return F.try_to_date(text, "yyyy-MM-dd")
    return F.trim(text).try_cast(kind)


def _fault(text: Column, value: Column, kind: DataType) -> Column:
    if isinstance(kind, (DecimalType, IntegerType, LongType)):
        return number_fault(text, value)
    return F.when(value.isNull(), "malformed")


def scan_checked(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> DataFrame:
    """A CSV file or directory under a declared schema, every line kept: the columns as declared, the line's fields as they
    came in `raw` (a struct of text, with the whole line in `_corrupt_record` where it has too few or too many fields), and
    `reject_reasons`, which is empty for a good row.

    The rules follow from the schema: `missing:<column>` where a NOT NULL column has no value, `<fault>:<column>` where a text is no
    value of the column's type or would have to be rounded to be one, `malformed_line` for a wrong number of fields.
    """
    text = StructType([*all_text(schema).fields, StructField(CORRUPT, StringType())])
    # Without column pruning a line is judged by all its fields, whichever are asked for.
    lines = (spark.read.options(**{**CSV_FORMAT, "header": str(header).lower()}).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", "false").schema(text).csv(path))
    raw = lines.select(F.struct(*text.names).alias("raw"))
    read = raw.select("raw", *(_typed(F.col("raw")[f.name], f.dataType).alias(f.name) for f in schema.fields))
    must = set(required(schema))

    def reason(field: StructField) -> Column:
        came = F.col("raw")[field.name]
        spelled = F.when(came.isNotNull(), F.concat(_fault(came, F.col(field.name), field.dataType), F.lit(f":{field.name}")))
        return F.when(came.isNull(), f"missing:{field.name}").otherwise(spelled) if field.name in must else spelled

    whole = F.col("raw")[CORRUPT].isNotNull()
    reasons = F.when(whole, F.array(F.lit("malformed_line"))).otherwise(F.array_compact(F.array(*map(reason, schema.fields))))
    return read.select(*schema.names, "raw", reasons.alias(REASONS))


def good_rows(checked: DataFrame) -> DataFrame:
    """The rows of a checked scan that keep all rules."""
    return checked.filter(F.size(REASONS) == 0).drop("raw", REASONS)


def rejected_lines(checked: DataFrame) -> DataFrame:
    """The others: their fields as text, `_corrupt_record` and `reject_reasons`."""
    return checked.filter(F.size(REASONS) > 0).select("raw.*", REASONS)


def land_checked(spark: SparkSession, source: str, schema: StructType, good: str, rejected: str, header: bool = True) -> None:
    """Land a CSV dataset as two Parquet directories, good rows and rejected lines, from one scan of the text."""
    checked = durable(scan_checked(spark, source, schema, header))
    write_parquet(good_rows(checked), good)
    write_parquet(rejected_lines(checked), rejected)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_FORMAT).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet directory. Partition by few-valued columns that queries filter on, such
    as the order month, so that they read only the directories they need."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def copy_layer(spark: SparkSession, names: Iterable[str], source: str, target: str,
               schemas: Mapping[str, StructType]) -> None:
    """Land the named CSV datasets as Parquet, value for value (pass text schemas to keep them so)."""
    for name in names:
        write_parquet(read_csv(spark, f"{source}/{name}", schemas[name]), f"{target}/{name}")
