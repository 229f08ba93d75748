"""Incremental landing: each delivered file of comma-separated values enters the raw table once, matched by column name."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.contracts import Contract

# Workers get this module's functions with the task, so they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILES = "path string, modificationTime timestamp, length long, content binary"
MALFORMED = "__malformed"
SCANS = 40  # layouts read by one query; a batch with more is written by several


WHOLE_FILES = {"spark.sql.files.maxPartitionBytes": str(1 << 60), "spark.sql.files.openCostInBytes": str(1 << 60)}  # one file, one task


def opening(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a task; the rows behind the first batch are not asked for."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The first line of each file, read in tasks of one file each; a compressed file is opened by its ending.

    A task stops after its first Arrow batch, so only the beginning of a file is read.  An empty file has no line and is left out.
    The driver gets one line per file of the batch.
    """
    if not paths:
        return {}
    before = {k: spark.conf.get(k) for k in WHOLE_FILES}
    for k, v in WHOLE_FILES.items():
        spark.conf.set(k, v)
    try:
        lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
        found = lines.mapInArrow(opening, "path string, value string").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return {unquote(row["path"]): row["value"].lstrip("\ufeff") for row in found}


def file_layouts(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Header line -> files that have it."""
    layouts: dict[str, list[str]] = {}
    for name, header in sorted(first_lines(spark, paths).items()):
        layouts.setdefault(header, []).append(name)
    return layouts


def header_names(spark: SparkSession, headers: list[str]) -> dict[str, list[str]]:
    """Column names of header lines, read the way Spark reads a row."""
    widest = max(h.count(",") for h in headers) + 1
    wide = ", ".join(f"c{i} string" for i in range(widest))
    parsed = spark.createDataFrame([(h,) for h in headers], "h string").select("h", F.from_csv("h", F.lit(wide)).alias("names"))
    return {
        row["h"]: [name.strip() if name else f"_unnamed{i}" for i, name in enumerate(row["names"]) if i <= row["h"].count(",")]
        for row in parsed.collect()  # a row per layout of the batch
    }


def read_layout(spark: SparkSession, present: list[str], paths: list[str], names: list[str]) -> DataFrame:
    """Files of one layout as raw rows: the wanted columns by name, everything else rescued.

    Columns the files lack are NULL.  Values of columns nobody declared are kept as JSON, and a line
    that does not fit its header is kept whole.
    """
    present = list(present)
    while present and present[-1].startswith("_unnamed"):
        present.pop()
    fields = [T.StructField(n, T.StringType()) for n in (*present, MALFORMED)]
    rows = (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .csv(paths)
    )
    extra = [n for n in present if n not in names]
    rescued = F.col(MALFORMED)
    if extra:
        undeclared = F.when(F.coalesce(*[F.col(f"`{n}`") for n in extra]).isNotNull(), F.to_json(F.struct(*[f"`{n}`" for n in extra])))
        rescued = F.coalesce(rescued, undeclared)
    absent = F.lit(None).cast("string")
    return rows.select(
        *[(F.col(f"`{n}`") if n in present else absent).alias(n) for n in names],
        rescued.alias("_rescued_data"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
    )


def land(spark: SparkSession, landing: str, table: str, checkpoint: str, contract: Contract, max_files: int = 1_000) -> None:
    """Append the files that are new in ``landing`` to the raw table stored at ``table``, then stop.

    Every file of the folder is a delivery, whatever its name; a compressed one is read by its ending.
    The stream follows file names only; file contents are read by ordinary scans, one per header
    layout, of which a batch has at most ``max_files``.  Each batch overwrites its own ``_batch`` partition, so a batch repeated after a failure
    replaces itself instead of adding its rows again.
    """

    def write_batch(files: DataFrame, batch: int) -> None:
        paths = [r["path"] for r in files.select("path").collect()]  # at most ``max_files`` names
        layouts = sorted(file_layouts(spark, paths).items())
        present = header_names(spark, [header for header, _ in layouts]) if layouts else {}
        for k in range(0, len(layouts), SCANS):
            parts = [read_layout(spark, present[header], members, contract.names) for header, members in layouts[k : k + SCANS]]
            reduce(DataFrame.unionByName, parts).write.mode("append" if k else "overwrite").parquet(f"{table}/_batch={batch}")

    (
        spark.readStream.format("binaryFile")
        .schema(FILES)
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
        .select("path")
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


RAW_COLUMNS = ("_rescued_data string", "_source_file string", "_ingested_at timestamp")


def read_raw(spark: SparkSession, table: str, contract: Contract) -> DataFrame:
    """The raw table as landed so far."""
    schema = ", ".join([*(f"`{n}` string" for n in contract.names), *RAW_COLUMNS])
    return spark.read.schema(schema).option("basePath", table).parquet(table)
