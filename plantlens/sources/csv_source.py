"""Text sources: CSV exports and JSON lines, read as strings in file order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import normalize_headers, tokens_to_null
from ..operators.dedup import INGEST_ORDER

# Export file of each raw table.
RAW_FILES = {
    "plant_master": "01_raw/master/plant_master.csv",
    "line_master": "01_raw/master/line_master.csv",
    "machine_master": "01_raw/master/machine_master.csv",
    "product_master": "01_raw/master/product_master.csv",
    "customer_master": "01_raw/master/customer_master.csv",
    "operator_master": "01_raw/hr/operator_master.csv",
    "sales_order": "01_raw/erp/sales_order.csv",
    "work_order": "01_raw/mes/work_order.csv",
    "production_run": "01_raw/mes/production_run.csv",
    "machine_state_event": "01_raw/scada/machine_state_event.csv",
    "downtime_event": "01_raw/scada/downtime_event.csv",
    "quality_inspection": "01_raw/qms/quality_inspection.csv",
    "shipment": "01_raw/logistics/shipment.csv",
    "data_quality_rules": "01_raw/master/data_quality_rules.csv",
    "sensor_reading": "01_raw/scada/sensor_reading.csv",
}

DOCUMENT_SCHEMA = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
])


CSV_OPTIONS = {"quote": '"', "escape": '"'}


def _records_over_lines(spark: SparkSession, path: str) -> DataFrame | None:
    """(_record, position) of CSV records that may go over several lines; none if no line break is quoted.

    Lines are read in splits, so a large file keeps many tasks.  A line with an
    odd number of quotes opens or closes a quoted field; whether a line starts
    inside one is the parity of such lines before it, from sums by split and a
    running sum inside each split.  Only lines of records with line breaks meet
    by record, all others are records as they are.

    Quotes have to be written as RFC 4180 says (fields that hold quotes are
    quoted, quotes in them doubled); a file that ends inside a field fails.
    """
    file, block, row = INGEST_ORDER
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("_line"), F.col("_metadata.file_path").alias(file),
        F.col("_metadata.file_block_start").alias(block), F.monotonically_increasing_id().alias(row),
    ).withColumn("_odd", (F.length("_line") - F.length(F.replace("_line", F.lit('"'), F.lit("")))) % 2)
    splits = lines.groupBy(file, block).agg(F.sum("_odd").alias("_odds"))
    if splits.filter(F.col("_odds") > 0).isEmpty():
        return None
    earlier = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(file)
    unclosed = F.raise_error(F.concat(F.lit("a quoted field is not closed in "), F.col(file))).cast("bigint")
    splits = splits.select(file, block, F.when(F.sum("_odds").over(whole) % 2 == 1, unclosed).otherwise(
        F.coalesce(F.sum("_odds").over(earlier), F.lit(0))).alias("_before"))
    upto = Window.partitionBy(file, block).orderBy(row)
    inside = (F.col("_before") + F.col("_upto")) % 2
    placed = (
        lines.withColumns({"_upto": F.sum("_odd").over(upto), "_nth": F.row_number().over(upto)})
        .join(splits, [file, block])
        .withColumns({
            "_inside_after": inside, "_inside": (inside + F.col("_odd")) % 2,
            "_header": (F.col(block) == 0) & (F.col("_nth") == 1),
        })
    )
    single = placed.filter((F.col("_inside") == 0) & (F.col("_inside_after") == 0)).select(
        F.col("_line").alias("_record"), file, block, row, "_header")
    broken = placed.filter((F.col("_inside") == 1) | (F.col("_inside_after") == 1)).withColumn(
        "_opens", (F.col("_inside") == 0).cast("int"))
    opened = broken.groupBy(file, block).agg(F.sum("_opens").alias("_opened")).select(
        file, block, F.coalesce(F.sum("_opened").over(earlier), F.lit(0)).alias("_opened"))
    numbered = broken.join(opened, [file, block]).withColumn("_number", F.col("_opened") + F.sum("_opens").over(upto))
    held = F.sort_array(F.collect_list(F.struct(block, row, "_line", "_header")))
    joined = numbered.groupBy(file, "_number").agg(held.alias("_lines")).select(
        F.array_join(F.transform("_lines", lambda x: x["_line"]), "\n").alias("_record"), file,
        F.col("_lines")[0][block].alias(block), F.col("_lines")[0][row].alias(row),
        F.col("_lines")[0]["_header"].alias("_header"))
    return single.unionByName(joined).filter(~F.col("_header") & (F.trim(F.rtrim("_record", F.lit("\r"))) != "")).select(
        F.rtrim("_record", F.lit("\r")).alias("_record"), *INGEST_ORDER)


def read_csv(
    spark: SparkSession, path: str, *, required: Sequence[str] = (), nulls: bool = True, line_breaks: bool = False,
) -> DataFrame:
    """All-text frame with normalised headers and the arrival position.

    No type inference, hence no extra pass; a missing file raises at once.
    ``_ingest_file``, ``_ingest_block`` and ``_ingest_row`` order the records as
    they stand in the files: rows of one split keep their sequence, splits
    their offset.  ``line_breaks`` takes line breaks inside quoted fields as
    part of the field, without reading a file by one task; it costs a pass that
    looks for such breaks and, if there are any, a shuffle by split.
    """
    reader = spark.read.option("header", True).option("inferSchema", False).options(**CSV_OPTIONS)
    records = _records_over_lines(spark, path) if line_breaks else None
    if records is None:
        raw = reader.csv(path)
        names = raw.columns
        positioned = raw.select(
            "*",
            F.col("_metadata.file_path").alias("_ingest_file"),
            F.col("_metadata.file_block_start").alias("_ingest_block"),
            F.monotonically_increasing_id().alias("_ingest_row"),
        )
    else:
        names = reader.option("multiLine", True).csv(path).columns  # reads the header alone
        schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
        positioned = records.select(F.from_csv("_record", schema, CSV_OPTIONS).alias("_r"), *INGEST_ORDER).select(
            "_r.*", *INGEST_ORDER)
    frame = normalize_headers(positioned.select(*[F.col(f"`{n}`") for n in names]
                                                + [F.col(c) for c in INGEST_ORDER]))
    missing = [c for c in required if c not in frame.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    if nulls:
        frame = frame.withColumns({
            c: tokens_to_null(c) for c in frame.columns if c not in INGEST_ORDER
        })
    return frame


def first_rows(df: DataFrame, n: int, order: Sequence[str] = INGEST_ORDER) -> DataFrame:
    """The first ``n`` records in file order (a plain limit takes any rows).

    Blocks (file, split) are counted first; only those that reach into the
    first ``n`` rows go on, and only the last of them is cut by rank, so no
    task gets more rows than a block has.
    """
    *block, row = order
    sizes = df.groupBy(*block).agg(F.count(F.lit(1)).alias("_size"))
    earlier = F.sum("_size").over(Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1))
    reached = sizes.withColumn("_before", F.coalesce(earlier, F.lit(0))).filter(F.col("_before") < n)
    placed = df.join(reached, block)
    within = placed.filter(F.col("_before") + F.col("_size") <= n)
    rank = F.row_number().over(Window.partitionBy(*block).orderBy(row))
    last = placed.filter(F.col("_before") + F.col("_size") > n).withColumn("_rank", rank).filter(
        F.col("_rank") <= n - F.col("_before")).drop("_rank")
    return within.unionByName(last).select(*df.columns).orderBy(*order)


def read_documents(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)
