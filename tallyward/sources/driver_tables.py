"""The eight sources of the retail model, derived from the star-schema test tables.

Only row-wise arithmetic is used, and amounts are whole cents before they become decimals,
so an independent SQL engine can repeat every value exactly.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.contracts import CONTRACTS

INGESTED_AT = "2026-01-01 00:00:00"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _eur(cents: str) -> Column:
    """Whole cents as a two-decimal amount."""
    return F.expr(f"cast(cast({cents} as decimal(18,2)) / 100 as decimal(18,2))")


def _text(df: DataFrame, contract: str, file: str) -> DataFrame:
    """Raw layer: every column text, with the columns every ingested row carries."""
    return df.select(
        *[F.col(n).cast("string").alias(n) for n in CONTRACTS[contract].names],
        F.lit(None).cast("string").alias("_rescued_data"),
        F.lit(file).alias("_source_file"),
        F.lit(INGESTED_AT).cast("timestamp").alias("_ingested_at"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_name", (F.col("n_regionkey") == 0).alias("swiss")
    )
    return read(spark, sf_dir, "supplier").join(nation, "s_nationkey", "left").selectExpr(
        "concat('S', lpad(cast(s_suppkey as string), 8, '0')) as store_id",
        "s_name as store_name",
        "if(swiss, 'CH', 'DE') as country",
        "if(swiss, 'CHF', 'EUR') as currency",
        "n_name as region",
        """case s_suppkey % 10 when 0 then 'online' when 1 then 'hypermarket' when 2 then 'express'
           else 'supermarket' end as format""",
        "1 + (s_suppkey % 4) / 4D as size_factor",
        "date'1990-01-01' as open_date",
        "s_suppkey",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read(spark, sf_dir, "part")
        .withColumn("list_cents", F.expr("bigint(round(p_retailprice * 100))"))
        .withColumn("cost_cents", F.expr("(list_cents * (50 + p_partkey % 20)) div 100"))
        .select(
            F.expr("concat('P', lpad(cast(p_partkey as string), 9, '0'))").alias("sku"),
            F.col("p_type").alias("category"),
            F.expr("p_partkey % 2 = 0").alias("reduced_vat"),
            _eur("list_cents").alias("list_price_eur"),
            _eur("cost_cents").alias("unit_cost_eur"),
        )
    )


def cashiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores(spark, sf_dir).select(
        F.explode(F.transform(F.sequence(F.lit(1), F.lit(6)), lambda n: F.concat("store_id", F.lit("-C0"), n))).alias(
            "cashier_id"
        ),
        "store_id",
    )


def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CHF rates on order days that are weekdays, with every eleventh day left out."""
    return (
        read(spark, sf_dir, "orders")
        .select(F.to_date("o_orderdate").alias("rate_date"))
        .distinct()
        .where("weekday(rate_date) < 5 and datediff(rate_date, date'1995-01-01') % 11 <> 0")
        .select(
            "rate_date",
            F.lit("CHF").alias("currency"),
            F.expr("cast((920 + dayofyear(rate_date) % 50) / 1000 as decimal(18,6))").alias("units_per_eur"),
        )
    )


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items; a file of fewer splits than there are cores is dealt out, while its rows are still narrow."""
    lines, cores = read(spark, sf_dir, "lineitem"), spark.sparkContext.defaultParallelism
    few = lines.select("l_orderkey").rdd.getNumPartitions() < cores
    return lines.repartition(cores, "l_orderkey", "l_linenumber") if few else lines


def tills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as till lines, amounts in whole cents."""
    # The Swiss nations are a scalar, not a join, so that the planner knows how few bytes the stores are.
    swiss = read(spark, sf_dir, "nation").where("n_regionkey = 0").agg(F.collect_list("n_nationkey")).scalar()
    store = read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.expr("concat('S', lpad(cast(s_suppkey as string), 8, '0'))").alias("store_id"),
        F.when(F.array_contains(swiss, F.col("s_nationkey")), "CHF").otherwise("EUR").alias("currency"),
    )
    lines = (
        line_items(spark, sf_dir)
        .selectExpr(
            "*",
            "bigint(round(l_extendedprice * 100)) as price_c",
            "bigint(round(l_discount * 100)) as disc_pct",
            "bigint(round(l_tax * 100)) as vat_pct",
        )
        .selectExpr("*", "(price_c * disc_pct + 50) div 100 as discount_c")
        .selectExpr("*", "price_c - discount_c as gross_c")
        .selectExpr("*", "(200 * gross_c + (100 + vat_pct)) div (2 * (100 + vat_pct)) as net_c")
        .selectExpr("*", "gross_c - net_c as vat_c", "to_date(l_shipdate) as day", "int(l_quantity) as qty")
    )
    return lines.join(store, "l_suppkey", "left")


def bronze_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw stores; every 41st supplier carries a currency of the wrong country."""
    wrong = stores(spark, sf_dir).withColumn(
        "currency", F.expr("if(s_suppkey % 41 = 40, 'USD', currency)")
    )
    return _text(wrong, "stores", "stores.csv")


def bronze_pos_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw till lines.  Four order-key residues carry one planted fault each."""
    typed = tills(spark, sf_dir).select(
        F.expr("concat('T', l_orderkey)").alias("transaction_id"),
        F.col("l_linenumber").alias("line_no"),
        F.expr(
            "date_format(timestampadd(MINUTE, int(l_orderkey % 1440), timestamp(day)), 'yyyy-MM-dd HH:mm:ss')"
        ).alias("transaction_ts"),
        F.expr("if(l_orderkey % 991 = 0, '2026-13-45', string(day))").alias("business_date"),
        F.expr("if(l_orderkey % 983 = 0, 'S-UNKNOWN', store_id)").alias("store_id"),
        F.expr("concat(store_id, '-C0', 1 + l_orderkey % 6)").alias("cashier_id"),
        F.expr("if(l_orderkey % 977 = 0, '', concat('P', lpad(string(l_partkey), 9, '0')))").alias("sku"),
        F.expr("if(l_orderkey % 997 = 0, '-1', string(qty))").alias("quantity"),
        _eur("price_c div qty").alias("unit_price"),
        _eur("discount_c").alias("discount_amount"),
        _eur("gross_c").alias("gross_amount"),
        F.expr("cast(cast(vat_pct as decimal(6,4)) / 100 as decimal(6,4))").alias("vat_rate"),
        _eur("net_c").alias("net_amount"),
        _eur("vat_c").alias("vat_amount"),
        "currency",
        F.expr("element_at(array('card', 'cash', 'voucher'), int(1 + l_partkey % 3))").alias("payment_method"),
        F.expr("if(disc_pct > 0, 'True', 'False')").alias("promo_flag"),
    )
    return _text(typed, "pos_sales", "pos_sales.csv")


def bronze_refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw refunds: returned line items, half of them with a receipt."""
    typed = (
        tills(spark, sf_dir)
        .where("l_returnflag = 'R'")
        .withColumn("receipt", F.expr("l_linestatus = 'F'"))
        .select(
            F.expr("concat('R', l_orderkey, '-', l_linenumber)").alias("refund_id"),
            F.expr("string(timestamp(day))").alias("refund_ts"),
            F.col("day").alias("business_date"),
            "store_id",
            F.expr("concat(store_id, '-C0', 1 + l_orderkey % 6)").alias("cashier_id"),
            F.expr(
                "if(receipt and l_orderkey % 967 <> 0, concat(if(l_orderkey % 971 = 0, 'GHOST', 'T'), l_orderkey), null)"
            ).alias("original_transaction_id"),
            F.expr("if(receipt, concat('P', lpad(string(l_partkey), 9, '0')), null)").alias("sku"),
            F.col("qty").alias("quantity"),
            _eur("gross_c").alias("refund_amount"),
            F.expr("cast(cast(vat_pct as decimal(6,4)) / 100 as decimal(6,4))").alias("vat_rate"),
            "currency",
            F.expr("if(receipt, 'True', 'False')").alias("receipt_present"),
            F.expr("if(l_partkey % 2 = 0, 'cash', 'card')").alias("refund_method"),
            F.expr("if(l_partkey % 5 = 0, 'damaged', 'unwanted')").alias("reason"),
        )
    )
    return _text(typed, "refunds", "refunds.csv")


def faulty_ledger(journals: DataFrame) -> DataFrame:
    """Plant ledger faults by a number derived from store and day.

    Multiples of 97: sales not booked; 101: revenue EUR 5 too high; 103: sales booked twice;
    107: an additional manual revenue journal.  The journals are read once: each line names what becomes of it.
    """
    h = F.expr("datediff(posting_date, date'1995-01-01') + bigint(substring(store_id, 2)) * 31")
    sales, revenue = F.col("source") == "POS", F.col("account_code") == "4000"
    booked = ~(sales & (h % 97 == 0))
    roles = {"kept": booked, "twice": booked & sales & (h % 103 == 0), "debit": sales & revenue & (h % 107 == 0), "credit": sales & revenue & (h % 107 == 0)}
    # Every line meets every role and keeps those it has: comparisons are compiled, a list that is filtered would not be.
    taken = reduce(operator.or_, [(F.col("role") == name) & has for name, has in roles.items()])
    lines = journals.withColumn("role", F.explode(F.array(*map(F.lit, roles)))).where(taken).withColumn("h", h)

    money = lambda c: c.cast("decimal(18,2)")
    manual, debit = F.col("role").isin("debit", "credit"), F.col("role") == "debit"
    amount, zero = money(F.expr("3000 + h % 9000")), money(F.lit(0))

    def planted(column: str, on_debit, on_credit) -> Column:
        return F.when(debit, on_debit).when(manual, on_credit).otherwise(F.col(column))

    too_high = F.when(sales & revenue & (F.col("h") % 101 == 0), money(F.col("credit_eur") + 5)).otherwise(F.col("credit_eur"))
    journal_id = F.when(manual, F.regexp_replace("journal_id", "POS$", "MAN1")).when(F.col("role") == "twice", F.concat("journal_id", F.lit("-DUP")))
    changed = {
        "journal_id": journal_id.otherwise(F.col("journal_id")),
        "line_no": planted("line_no", 1, 2),
        "account_code": planted("account_code", "1200", "4000"),
        "account_name": planted("account_name", "Card clearing", "Revenue"),
        "debit_eur": planted("debit_eur", amount, zero),
        "credit_eur": F.when(debit, zero).when(manual, amount).otherwise(too_high),
        "source": F.when(manual, "MANUAL").otherwise(F.col("source")),
        "description": F.when(manual, "Manual revenue adjustment").otherwise(F.col("description")),
    }
    return lines.select(*[changed.get(c, F.col(c)).alias(c) for c in journals.columns])


def planted_journals(ledger: DataFrame) -> DataFrame:
    """Answer key: manual journals and both copies of a journal booked twice."""
    copies = ledger.where("journal_id like '%-DUP'").select(F.regexp_replace("journal_id", "-DUP$", "").alias("entity_id"))
    return (
        ledger.where("source = 'MANUAL' or journal_id like '%-DUP'")
        .select(F.col("journal_id").alias("entity_id"))
        .unionByName(copies)
        .distinct()
    )


def thinned_budget(budget: DataFrame) -> DataFrame:
    """Budgets as planned, but missing for some stores and zero for others."""
    number = F.expr("bigint(substring(store_id, 2))")
    zero = F.expr("cast(0 as decimal(18,2))")
    return budget.where(number % 17 != 5).withColumns(
        {
            c: F.when(number % 19 == 7, zero).otherwise(F.col(c))
            for c in ("revenue_budget_eur", "cogs_budget_eur")
        }
    )
