"""Readers and writers: CSV with explicit schemas, Parquet tables, catalogue."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ledgerlight.session import materialise
from ledgerlight.sources.schemas import schema_of

BAD_ROW = "_corrupt_record"
EXPORTED_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


# --- sources ---------------------------------------------------------------

def read_csv(
    spark: SparkSession, path: str, entity: str, keep_bad_rows: bool = False, exported: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """One source file (or folder of files) of a known entity.

    A value that does not fit its type becomes null; with ``keep_bad_rows``
    the raw line is kept in ``_corrupt_record`` so it can be quarantined; such
    rows are written once, because Spark refuses to count that column straight from the file.
    ``exported`` reads what ``export_csv`` wrote, without any loss.  ``multiline`` reads files of others with line breaks
    inside quotes; such a file is read by one task, so large ones come in several files.
    """
    schema = schema_of(entity)
    if keep_bad_rows:
        schema = StructType([*schema.fields, StructField(BAD_ROW, StringType())])
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_ROW)
        .option("multiLine", multiline)
    )
    if not exported:
        rows = reader.csv(path)
        return materialise(rows) if keep_bad_rows else rows
    rows = reader.option("timestampFormat", EXPORTED_TIME).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    rows = materialise(rows) if keep_bad_rows else rows
    return rows.withColumns({f.name: _plain(F.col(f.name)) for f in schema if isinstance(f.dataType, StringType) and f.name != BAD_ROW})


def _plain(text: Column) -> Column:
    """Undo ``_one_line``: a letter after an odd number of backslashes is a line break."""
    for letter, char in (("n", "\n"), ("r", "\r")):
        text = F.regexp_replace(text, rf"(?<!\\)((?:\\\\)*)\\{letter}", f"$1{char}")
    return F.when(text == "\\e", "").otherwise(F.replace(text, F.lit("\\\\"), F.lit("\\")))


def _one_line(text: Column) -> Column:
    """Line breaks as backslash and letter, so files stay splittable; an empty text, which CSV reads as null, as well."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    lines = F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    return F.when(text == "", "\\e").otherwise(lines)


def split_bad_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the raw line, quarantined rows)."""
    return df.filter(F.col(BAD_ROW).isNull()).drop(BAD_ROW), df.filter(F.col(BAD_ROW).isNotNull())


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_catalogued(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Append-only table whose runs may carry different columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_history_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The same, or an empty table before the first row is written."""
    try:
        return read_history(spark, path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


# --- sinks -----------------------------------------------------------------

def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def with_month_partition(df: DataFrame, time_col: str) -> DataFrame:
    return df.withColumn("annee", F.year(time_col)).withColumn("mois", F.month(time_col))


#: Beside the data of a monthly table: its schemas, one row of text each.
SCHEMAS = "_schemas"
#: Types that one column may have in different months, and the type it is read with.
WIDER = {("int", "bigint"): "bigint", ("float", "double"): "double", ("int", "double"): "double"}


def write_monthly(df: DataFrame, path: str, time_col: str, whole: bool = False) -> None:
    """Overwrite only the (annee, mois) partitions present in ``df``; with ``whole`` all, and the schemas as well.

    The rebalance hint gathers each month into few files and lets AQE split a
    month that is far larger than the rest, which a plain repartition on the
    two columns would put into one task.

    Months may differ in columns: the schema of each write is kept beside the data, and ``read_monthly``
    reads all months by all of them.  A column whose type changed to one that does not hold the old values is refused,
    unless the whole table is overwritten.
    """
    spark, schema = df.sparkSession, df.schema
    known = [] if whole else _kept_schemas(spark, path)
    merged_schema([*known, schema])
    if whole:
        with_month_partition(df, time_col).hint("rebalance", "annee", "mois").write.mode("overwrite").partitionBy("annee", "mois").parquet(path)
    # The schema comes before the months that need it; without its months it only adds nulls.
    if schema not in known:
        text = spark.createDataFrame([(len(known), schema.json())], "version int, schema string")
        text.coalesce(1).write.mode("append").parquet(f"{path}/{SCHEMAS}")
    if not whole:
        (
            with_month_partition(df, time_col)
            .hint("rebalance", "annee", "mois")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("annee", "mois")
            .parquet(path)
        )


def _kept_schemas(spark: SparkSession, path: str) -> list[StructType]:
    rows = read_history_or_empty(spark, f"{path}/{SCHEMAS}", "version int, schema string").orderBy("version", "schema").collect()
    return [StructType.fromJson(json.loads(r["schema"])) for r in rows]


def merged_schema(schemas: Sequence[StructType]) -> StructType:
    """All columns of the schemas in the order they came, each with the widest of its types."""
    types: dict[str, StructField] = {}
    for f in (f for s in schemas for f in s.fields):
        seen = types.get(f.name)
        wide = f.dataType
        if seen is not None and seen.dataType != f.dataType:
            pair = (seen.dataType.simpleString(), f.dataType.simpleString())
            name = WIDER.get(pair) or WIDER.get(pair[::-1])
            if name is None:
                raise ValueError(f"column {f.name} was {pair[0]} and is {pair[1]}: overwrite the whole table")
            wide = seen.dataType if name == pair[0] else f.dataType
        types[f.name] = StructField(f.name, wide)
    return StructType(list(types.values()))


def read_monthly(spark: SparkSession, path: str) -> DataFrame:
    """A monthly table with the columns of all its writes; null in months that were written without one."""
    kept = _kept_schemas(spark, path)
    if not kept:
        return spark.read.option("mergeSchema", True).parquet(path)
    return spark.read.schema(merged_schema(kept).add("annee", IntegerType()).add("mois", IntegerType())).parquet(path)


def append_once(df: DataFrame, path: str, lot: str, key: Sequence[str], time_col: str) -> None:
    """Append the events of one lot, each once, in folders by day and lot.

    A lot that comes again replaces its own folders, so a repeated run changes nothing.  Events whose key an
    earlier lot has already delivered are left out; only the days of the new events are read for that, since an event that
    comes twice has the same time.  Of events with one key in the lot one stays.  Null parts of a key are
    equal to each other.
    """
    spark, key = df.sparkSession, list(key)
    rows = materialise(df.dropDuplicates(key).withColumn("jour", F.coalesce(F.date_format(time_col, "yyyy-MM-dd"), F.lit("sans"))))
    days = rows.select("jour").distinct()
    before = read_history_or_empty(spark, path, rows.withColumn("lot", F.lit("")).schema).withColumn("jour", F.col("jour").cast("string"))
    known = before.filter(F.col("lot") != lot).join(F.broadcast(days), "jour", "left_semi")
    known = known.select(*[F.col(c).alias(f"_k_{c}") for c in ["jour", *key]])
    same = reduce(lambda x, y: x & y, [rows[c].eqNullSafe(known[f"_k_{c}"]) for c in ["jour", *key]])
    # Written apart first, because a table cannot be read and overwritten in one go.
    new = materialise(rows.join(known, same, "left_anti").withColumn("lot", F.lit(lot)))
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("jour", "lot").parquet(path)


def read_appended(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The events of all lots; empty before the first."""
    schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    partitioned = StructType([*schema.fields, StructField("jour", StringType()), StructField("lot", StringType())])
    return read_history_or_empty(spark, path, partitioned).select(*schema.names)


def month_range(df: DataFrame, time_col: str, first: str, last: str) -> DataFrame:
    """Rows of ``first <= day <= last``, with the partition filter spelled out.

    The extra condition on (annee, mois) prunes folders of a table written by
    ``write_monthly``; the time column alone would not.
    """
    month_no = F.col("annee") * 12 + F.col("mois")
    lo, hi = F.lit(first).cast("date"), F.lit(last).cast("date")
    return df.filter(
        month_no.between(F.year(lo) * 12 + F.month(lo), F.year(hi) * 12 + F.month(hi))
        & (F.col(time_col) >= lo)
        & (F.col(time_col) < F.date_add(hi, 1))
    )


def append_history(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def register_table(df: DataFrame, database: str, table: str, location: str | None = None) -> str:
    """Create the database when missing (in ``location`` if given) and save ``df`` as its table."""
    place = f" LOCATION '{location}'" if location else ""
    df.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS `{database}`{place}")
    df.write.mode("overwrite").saveAsTable(f"`{database}`.`{table}`")
    return f"{database}.{table}"


def export_csv(df: DataFrame, path: str) -> None:
    """Quoted texts, escaped line breaks, times with microseconds."""
    texts = {f.name: _one_line(F.col(f.name)) for f in df.schema if isinstance(f.dataType, StringType)}
    writer = df.withColumns(texts).write.mode("overwrite").option("header", True).option("escape", '"')
    writer = writer.option("timestampFormat", EXPORTED_TIME).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, in one plan, ordered by name."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("nombre_lignes"))
        .select(F.lit(name).alias("table_name"), "nombre_lignes")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")
