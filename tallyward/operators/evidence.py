"""Audit evidence: where a figure came from, and who may read what."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.expressions import month_of

# The watched principals and what they may hold.
ANALYSTS = "finance-analysts"
EVERYONE = ("account users", "users")
CATALOG_PRIVILEGES = ("USE CATALOG", "BROWSE")
GOLD_PRIVILEGES = ("USE SCHEMA", "SELECT")


def lineage_chains(edges: DataFrame, job_id: str | None = None) -> DataFrame:
    """(gold, silver, bronze) chains from edges (target, source, job_ids).

    With ``job_id`` only links into gold written by that job count.  A silver table without a
    bronze source stays, with an empty bronze name.
    """
    into_gold = edges.where("target like '%.gold.%' and source like '%.silver.%'")
    if job_id is not None:
        into_gold = into_gold.where(F.array_contains("job_ids", F.lit(job_id)))
    links = into_gold.select(F.col("target").alias("gold"), F.col("source").alias("silver")).distinct()
    origins = (
        edges.where("target like '%.silver.%' and source like '%.bronze.%'")
        .select(F.col("target").alias("silver"), F.col("source").alias("bronze"))
        .distinct()
    )
    return links.join(origins, "silver", "left").select("gold", "silver", F.coalesce("bronze", F.lit("")).alias("bronze"))


def untraced(required: DataFrame, chains: DataFrame) -> DataFrame:
    """Gold tables of ``required`` (column ``gold``) that no chain reaches."""
    return required.select("gold").distinct().join(chains.select("gold").distinct(), "gold", "left_anti")


def row_trace(recon_daily: DataFrame, pos_sales: DataFrame, bronze_pos: DataFrame) -> DataFrame:
    """Follow the largest reconciliation difference to its sales lines, raw rows and files.

    One row per source file, or one without a file if nothing was sold that day.  Files are counted while
    aggregating; raw dates are text and are compared as text.  Where the sales are partitioned by month only that month is read.
    """
    top = (
        recon_daily.orderBy(F.abs("difference_eur").desc(), "store_id", "business_date")
        .limit(1)
        .select("store_id", "business_date", "pos_net_eur")
    )
    store, day = (top.select(c).scalar() for c in ("store_id", "business_date"))
    here = (F.col("store_id") == store) & (F.col("business_date") == day)
    if "month" in pos_sales.columns:
        here &= F.col("month") == top.select(month_of("business_date")).scalar()
    raw = bronze_pos.where((F.col("store_id") == store) & (F.col("business_date") == day.cast("string"))).agg(F.count("*")).scalar()
    files = pos_sales.where(here).groupBy("store_id", "business_date", F.col("_source_file").alias("source_file")).agg(F.count("*").alias("file_rows"))
    sold = files.agg(F.coalesce(F.sum("file_rows"), F.lit(0))).scalar()
    trace = top.withColumns({"silver_rows": sold, "bronze_rows": raw})
    return trace.join(files, ["store_id", "business_date"], "left").select(*top.columns, "silver_rows", "bronze_rows", "source_file", F.coalesce("file_rows", F.lit(0)).alias("file_rows"))


def grant_problems(grants: DataFrame) -> DataFrame:
    """Grants (principal, privilege, object_type, object_name) outside the allow-list, and missing ones.

    Analysts may use and browse the catalog and read the gold schema; groups everyone belongs to
    may use and browse the catalog.  Other principals are not watched.
    """
    privilege = F.replace("privilege", F.lit("_"), F.lit(" "))
    on_gold = (F.col("object_type") == "SCHEMA") & (F.element_at(F.split("object_name", "[.]"), 2) == "gold")
    catalog_use = (F.col("object_type") == "CATALOG") & privilege.isin(*CATALOG_PRIVILEGES)
    gold_read = (F.col("principal") == ANALYSTS) & F.coalesce(on_gold, F.lit(False)) & privilege.isin(*GOLD_PRIVILEGES)
    extra = grants.where(F.col("principal").isin(ANALYSTS, *EVERYONE) & ~catalog_use & ~gold_read).select(
        F.concat_ws(" ", "principal", F.lit("has"), "privilege", F.lit("on"), F.lower("object_type"), "object_name").alias("problem")
    )
    held = grants.where(
        (F.col("principal") == ANALYSTS) & (F.col("object_type") == "SCHEMA") & F.col("object_name").endswith(".gold")
    ).agg(*[F.count_if(privilege == p).alias(p) for p in GOLD_PRIVILEGES])
    lacking = held.unpivot([], list(GOLD_PRIVILEGES), "privilege", "n").where("n = 0").select(
        F.concat(F.lit(f"{ANALYSTS} lacks "), "privilege", F.lit(" on gold")).alias("problem")
    )
    return extra.unionByName(lacking)


def grants_visible(grants: DataFrame, me: str) -> DataFrame:
    """One row: can ``me`` see grants of others on the catalog or a schema?  Table grants prove nothing."""
    others = (F.col("principal") != me) & F.col("object_type").isin("CATALOG", "SCHEMA")
    return grants.agg((F.count_if(others) > 0).alias("visible"))
