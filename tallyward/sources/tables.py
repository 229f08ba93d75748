"""Catalog tables: full refresh, slice replacement, append-only history, documentation."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUARANTINE = """source STRING, record_key STRING, reasons ARRAY<STRING>, record STRING,
  _source_file STRING, _ingested_at TIMESTAMP, _quarantined_at TIMESTAMP"""


SLICE = "run_slice"


def finite_value(value: Column, kind: T.DataType) -> Column:
    """The value with NULL in place of every NaN and infinity, also inside arrays, maps and structs."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)
    if not holds_floats(kind):
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: finite_value(v, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, v: finite_value(v, kind.valueType))
    fields = [finite_value(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def holds_floats(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(holds_floats(f.dataType) for f in kind.fields)
    inner = {T.ArrayType: "elementType", T.MapType: "valueType"}.get(type(kind))
    return holds_floats(getattr(kind, inner)) if inner else isinstance(kind, (T.DoubleType, T.FloatType))


def finite(df: DataFrame) -> DataFrame:
    """What no reader should meet in a table, NaN and infinities, as NULL; columns without floating-point numbers are left as they are."""
    cleaned = {f.name: finite_value(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields if holds_floats(f.dataType)}
    return df.withColumns(cleaned) if cleaned else df


VERSIONS = "__versions"
LISTED = "spark.sql.hive.manageFilesourcePartitions"


def replace_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Full refresh; the new schema replaces the old one.

    Every version of a table is a folder of its own.  The new one is complete before one change of the table's location lets
    readers see it, partitioned or not; a run that dies on the way leaves the old version.  The version before stays, for readers
    that still use it; older ones and what failed runs left are deleted, so a table has one writer at a time.  ``df`` may read
    the table itself.  Only a change of columns or partitioning, which no single statement can make, drops the old entry first.
    Partitions are found by listing the folder, because a catalog's list of them could not change in one step.
    """
    spark, df = df.sparkSession, finite(df)
    order = [c for c in df.columns if c not in partition_by] + list(partition_by)
    folder, version = versions_folder(spark, name), uuid4().hex
    df = df.select(*[f"`{c}`" for c in order])
    if partition_by:
        df = df.hint("rebalance", *partition_by)  # few files per partition; large partitions are split
    df.write.partitionBy(*partition_by).parquet(f"{folder}/{version}")
    old = table_or_none(spark, name)
    before = location(spark, name) if old is not None else ""
    if old is not None and layout(old) == layout(df) and partition_columns(spark, name) == list(partition_by):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{quoted(f'{folder}/{version}')}'")
    else:
        create_listed(spark, name, df, f"{folder}/{version}", partition_by)
    spark.catalog.refreshTable(name)
    keep_versions(spark, folder, {version, before.rstrip("/").rsplit("/", 1)[-1]})
    return spark.table(name)


def quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def layout(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def versions_folder(spark: SparkSession, name: str) -> str:
    """Beside the tables of the database."""
    *database, table = name.split(".")
    found = spark.catalog.getDatabase(".".join(database) or spark.catalog.currentDatabase())
    return f"{found.locationUri.rstrip('/')}/{table}{VERSIONS}"


def location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return next((r["data_type"] for r in described.collect()), "")


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def create_listed(spark: SparkSession, name: str, df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Point a new entry of the catalog at the files of ``path``; all columns may be NULL."""
    columns = spark.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns]).schema.toDDL()
    by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    before = spark.conf.get(LISTED)
    spark.conf.set(LISTED, "false")
    try:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{by} LOCATION '{quoted(path)}'")
    finally:
        spark.conf.set(LISTED, before)


def keep_versions(spark: SparkSession, folder: str, kept: set[str]) -> None:
    """Delete all versions of a table but the ones named."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path):  # a few folders
        if status.getPath().getName() not in kept:
            files.delete(status.getPath(), True)


def append_history(df: DataFrame, name: str, stamp: str, run: str | None = None) -> None:
    """Add rows stamped with the time of this run; rows of other runs are never touched.

    With ``run`` the rows are that run's slice of the table: a run that is repeated after a failure replaces its own rows.
    """
    stamped = finite(df).withColumn(stamp, F.current_timestamp())
    if run is None:
        stamped.write.mode("append").format("parquet").saveAsTable(name)
        return
    if not df.sparkSession.catalog.tableExists(name):
        empty = stamped.where("false").withColumn(SLICE, F.lit(run))
        empty.write.mode("ignore").format("parquet").partitionBy(SLICE).saveAsTable(name)
    replace_slice(stamped, name, SLICE, run)


def create_quarantine(spark: SparkSession, name: str) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({QUARANTINE}) USING parquet PARTITIONED BY (source) "
        "COMMENT 'raw rows that broke their contract, with every reason'"
    )


def replace_slice(df: DataFrame, name: str, column: str, value: str) -> None:
    """Replace the rows of one partition value, also when there are no new rows.

    A dynamic overwrite would leave the old rows in place for an empty frame, so the partition is
    overwritten by name.
    """
    spark = df.sparkSession
    columns = [c for c in spark.table(name).columns if c != column]
    view = f"slice_{uuid4().hex}"
    df.select(*columns).createOrReplaceTempView(view)
    try:
        spark.sql(
            f"INSERT OVERWRITE TABLE {name} PARTITION ({column} = '{quoted(value)}') SELECT {', '.join(columns)} FROM {view}"
        )
    finally:
        spark.catalog.dropTempView(view)


def replace_partitions(df: DataFrame, name: str, column: str, values: list[str]) -> None:
    """Replace the rows of the named partition values by those of ``df``, which holds no others; a value without rows is emptied.

    Other partitions' files are not touched.  ``df`` must not read the table itself.
    """
    spark = df.sparkSession
    held = [r[column] for r in df.select(column).distinct().collect()]  # partition values
    if set(held) - set(values):
        raise ValueError(f"rows outside of the partitions to replace: {sorted(set(held) - set(values))}")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        if held:
            df.select(*spark.table(name).columns).hint("rebalance", column).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)
    for value in sorted(set(values) - set(held)):
        replace_slice(df.where("false"), name, column, value)


def describe_table(spark: SparkSession, name: str, properties: dict[str, str], comments: dict[str, str]) -> None:
    """Set table properties and comment the columns the table has."""
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")
    for column in spark.table(name).columns:
        if column in comments:
            text = comments[column].replace("'", "\\'")
            spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{column}` COMMENT '{text}'")


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None
