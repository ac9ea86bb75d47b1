"""File sources: delimited files, text lines and tab-separated lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


_RAW = "_raw_record"


def _csv_records(spark: SparkSession, path: str, sep: str, header: bool,
                 fields: list[str] | int | None, multi_line: bool) -> DataFrame:
    """All records, strings only, with the raw record where the width is wrong."""
    reader = (spark.read.option("sep", sep).option("header", str(header).lower())
              .option("multiLine", str(multi_line).lower())
              .option("escape", '"'))
    if fields is None:
        names = reader.csv(path).columns  # the first record
        if not header:
            names = [f"field_{i}" for i in range(len(names))]
    else:
        names = [f"field_{i}" for i in range(fields)] if isinstance(fields, int) else list(fields)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RAW]])
    records = (reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RAW)
               .schema(schema).csv(path))
    # Always true, and needs every column: Spark checks the width of the columns that
    # it reads, so a consumer of some of them must not let the others be pruned.
    return records.where(F.concat_ws("", *[F.col(f"`{n}`") for n in names]) >= "")


def csv_scan(spark: SparkSession, path: str, sep: str = ",", header: bool = False,
             fields: list[str] | int | None = None, multi_line: bool = False,
             rejects: str | None = None) -> DataFrame:
    """All-string delimited scan.

    With a header row the names come from it (and the row is skipped); without one
    the columns are ``field_0 .. field_{n-1}``, as many as the first record has, or
    as ``fields`` says (a number or names). Types are never inferred. A record with
    more or fewer fields is not a row: :func:`csv_rejects` returns them, and with
    ``rejects`` they are written there as Parquet.
    """
    if rejects is not None:
        csv_rejects(spark, path, sep, header, fields, multi_line).write.parquet(rejects)
    records = _csv_records(spark, path, sep, header, fields, multi_line)
    # Spark reads an empty field as NULL, quoted or not; in a record of the right
    # width nothing else is.
    text = {c: F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in records.columns if c != _RAW}
    return records.where(F.col(_RAW).isNull()).select(*[v.alias(c) for c, v in text.items()])


def csv_rejects(spark: SparkSession, path: str, sep: str = ",", header: bool = False,
                fields: list[str] | int | None = None, multi_line: bool = False) -> DataFrame:
    """Records of the wrong width: ``(line, fields)``, the raw record and what it has of
    the expected fields (NULL where empty or missing)."""
    records = _csv_records(spark, path, sep, header, fields, multi_line)
    names = [c for c in records.columns if c != _RAW]
    return records.where(F.col(_RAW).isNotNull()).select(
        F.col(_RAW).alias("line"), F.array(*[F.col(f"`{c}`") for c in names]).alias("fields"))


def line_scan(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``line``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def with_line_order(df: DataFrame) -> DataFrame:
    """Add ``_pos``: a sortable file position for each row of a text scan.

    (file path, block start, id within the task) orders rows as they appear
    in the files, without numbering them through a single task.
    """
    return df.withColumn("_pos", F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, line)`` of the text files at ``path``, counted from 1 in the order of
    the files and of the lines in them. Lines are first numbered within their read
    task; the counts of the file blocks, one row each, give the offsets."""
    lines = (spark.read.text(path)
             .select("value", F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row")))
    # Lines of a block are read by one task, in order: their ids are consecutive.
    blocks = lines.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("file", "block", "first",
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return lines.join(offsets, ["file", "block"]).select(
        (F.col("offset") + F.col("row") - F.col("first") + 1).alias("line_no"),
        F.col("value").alias("line"))


def load_lookup(spark: SparkSession, path: str, key: str = "key",
                value: str = "value") -> DataFrame:
    """Tab-separated ``key<TAB>value`` lines as a table.

    The value is the second field (anything after a further tab is ignored)
    and is trimmed; the last line of a duplicated key wins. Lines without a
    key or a value (blank lines) are skipped instead of failing the load.
    """
    raw = with_line_order(spark.read.text(path))
    parts = F.split(F.col("value"), "\t", -1)
    rows = raw.select(F.get(parts, 0).alias(key),
                      F.trim(F.get(parts, 1)).alias(value), "_pos")
    rows = rows.where((F.col(key) != "") & (F.col(value) != ""))
    return last_wins(rows, [key], value, "_pos")


def last_wins(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Per key, the ``value`` of the row with the greatest ``order``.

    ``max_by`` is a regular aggregate, so it is combined map-side and a hot
    key costs one partial row per task.
    """
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(value))
