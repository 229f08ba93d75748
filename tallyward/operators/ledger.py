"""Double-entry postings and budgets derived from till sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.contracts import MONEY, MONEY4
from tallyward.functions.expressions import cents, month_of
from tallyward.operators.rates import with_rate

# Chart of accounts.
ACCOUNT_NAMES = {
    "1000": "Cash",
    "1200": "Card clearing",
    "1300": "Gift vouchers",
    "1400": "Inventory",
    "2200": "VAT payable",
    "4000": "Revenue",
    "4010": "Sales returns",
    "5000": "Cost of goods sold",
}

def _journal(tag: str, source: str, description: str, debits: dict[str, str], credits: dict[str, str], only: tuple[str, ...] = ()) -> Column | None:
    """A journal as a struct: its lines are rounded amount columns by account, debits first.

    Empty lines are marked unused, and what rounding left over goes to the first used debit line.
    Only plain expressions are used, so the whole posting stays in generated code.  With ``only`` the lines of those accounts are
    written, as they are in the whole journal; None if it has none.
    """
    amounts = [(account, F.col(c), True) for account, c in debits.items()]
    amounts += [(account, F.col(c), False) for account, c in credits.items()]
    zero, residual = F.lit(0).cast(MONEY), F.lit(0).cast(MONEY)
    for _, amount, is_debit in amounts:
        residual = residual - amount if is_debit else residual + amount
    lines, number, debit_seen = [], F.lit(0), F.lit(False)
    for account, amount, is_debit in amounts:
        used = amount != 0
        number = number + used.cast("int")
        adjusted = F.when(used & ~debit_seen, amount + residual).otherwise(amount) if is_debit else zero
        debit_seen = debit_seen | used if is_debit else debit_seen
        if only and account not in only:
            continue
        lines.append(
            F.struct(
                used.alias("used"),
                number.alias("line_no"),
                F.lit(account).alias("account_code"),
                F.lit(ACCOUNT_NAMES[account]).alias("account_name"),
                adjusted.cast(MONEY).alias("debit_eur"),
                (zero if is_debit else amount).cast(MONEY).alias("credit_eur"),
            )
        )
    if not lines:
        return None
    day = F.date_format("business_date", "yyyyMMdd")
    return F.struct(
        F.concat(F.lit("J"), day, F.lit("-"), F.col("store_id"), F.lit(f"-{tag}")).alias("journal_id"),
        F.lit(source).alias("source"),
        F.lit(description).alias("description"),
        F.array(*lines).alias("lines"),
    )


def _book(days: DataFrame, *journals: Column | None) -> DataFrame:
    """One row per ledger line from one row per store-day: no shuffle beyond the day totals."""
    asked = [j for j in journals if j is not None]
    return (
        days.select("store_id", F.col("business_date").alias("posting_date"), F.explode(F.array(*asked)).alias("j"))
        .select("store_id", "posting_date", "j.journal_id", "j.source", "j.description", F.explode("j.lines").alias("line"))
        .where("line.used")
        .select(
            "journal_id",
            "line.line_no",
            "posting_date",
            "line.account_code",
            "line.account_name",
            "store_id",
            "line.debit_eur",
            "line.credit_eur",
            "source",
            "description",
        )
    )


def _to_their_days(lines: DataFrame) -> DataFrame:
    """Lines moved once, to their store-day, which opening hours bound: its sums per currency and in total are then both complete in place."""
    return lines.repartition("store_id", "business_date")


def sales_days(pos_sales: DataFrame, products: DataFrame, rates: DataFrame) -> DataFrame:
    """What the sales of each store-day come to, in EUR and rounded: all that its journals need."""

    def paid_by(method: str) -> Column:
        return F.sum(F.when(F.col("payment_method") == method, F.col("gross_amount")).otherwise(0)).alias(method)

    priced = _to_their_days(pos_sales.join(products.select("sku", "unit_cost_eur"), "sku", "left"))
    in_currency = priced.groupBy("store_id", "business_date", "currency").agg(
        paid_by("card"),
        paid_by("cash"),
        paid_by("voucher"),
        F.sum("gross_amount").alias("gross"),
        F.sum("net_amount").alias("net"),
        F.sum(F.col("quantity") * F.col("unit_cost_eur")).alias("cogs"),
    )
    eur = {c: F.try_divide(F.col(c).cast(MONEY), "units_per_eur") for c in ("card", "cash", "voucher", "gross", "net")}
    days = (
        with_rate(in_currency, rates, "business_date", "currency")
        .withColumns(eur)
        .groupBy("store_id", "business_date")
        .agg(*[F.sum(c).alias(c) for c in (*eur, "cogs")])
    )
    rounded = {c: cents(F.col(c)) for c in ("card", "cash", "voucher", "net", "cogs")}
    return days.select("store_id", "business_date", *[c.alias(name) for name, c in rounded.items()], cents(F.col("gross") - F.col("net")).alias("vat"))


def book_sales(days: DataFrame, only: tuple[str, ...] = ()) -> DataFrame:
    """Daily sales and cost-of-goods journals per store, from :func:`sales_days`; of these accounts, where some are named."""
    return _book(
        days,
        _journal(
            "POS", "POS", "Daily sales", {"1200": "card", "1000": "cash", "1300": "voucher"}, {"4000": "net", "2200": "vat"}, only
        ),
        _journal("COGS", "COGS", "Cost of goods sold", {"5000": "cogs"}, {"1400": "cogs"}, only),
    )


def refund_days(refunds: DataFrame, rates: DataFrame) -> DataFrame:
    """What the refunds of each store-day come to, in EUR and rounded, net of the VAT given back."""

    def given_in(method: str) -> Column:
        return F.sum(F.when(F.col("refund_method") == method, F.col("refund_amount")).otherwise(0)).alias(method)

    groups = _to_their_days(refunds).groupBy("store_id", "business_date", "currency", "vat_rate").agg(
        given_in("cash"), given_in("card"), F.sum("refund_amount").alias("gross")
    )
    eur = {c: F.try_divide(F.col(c).cast(MONEY), "units_per_eur") for c in ("cash", "card", "gross")}
    days = (
        with_rate(groups, rates, "business_date", "currency")
        .withColumns(eur)
        .withColumn("net", F.try_divide(F.col("gross").cast("decimal(24,10)"), 1 + F.col("vat_rate")))
        .groupBy("store_id", "business_date")
        .agg(*[F.sum(c).alias(c) for c in (*eur, "net")])
    )
    rounded = {c: cents(F.col(c)) for c in ("cash", "card", "net")}
    vat = (cents(F.col("gross")) - cents(F.col("net"))).alias("vat")
    return days.select("store_id", "business_date", *[c.alias(name) for name, c in rounded.items()], vat)


def book_refunds(days: DataFrame) -> DataFrame:
    """Daily refund journals per store, from :func:`refund_days`."""
    return _book(days, _journal("REF", "REFUND", "Daily refunds", {"4010": "net", "2200": "vat"}, {"1000": "cash", "1200": "card"}))


def post_journals(pos_sales: DataFrame, refunds: DataFrame, products: DataFrame, rates: DataFrame) -> DataFrame:
    """The ledger a store chain books from its tills: one journal per store, day and kind."""
    return book_sales(sales_days(pos_sales, products, rates)).unionByName(book_refunds(refund_days(refunds, rates)))


def budget_from_prior_year(lines: DataFrame, prior_year: int, growth: str = "0.05") -> DataFrame:
    """Next year's budget per store-month: last year's sales grown and rounded to EUR 100, cost in proportion."""
    months = (
        lines.where(F.year("business_date") == prior_year)
        .groupBy("store_id", month_of("business_date").alias("prior_month"))
        .agg(F.sum("net_amount_eur").cast(MONEY4).alias("net"), F.sum("cogs_eur").cast(MONEY).alias("cogs"))
    )
    revenue = F.round(F.col("net") * (1 + F.lit(growth).cast("decimal(6,4)")), -2).cast(MONEY)
    return months.withColumn("revenue_budget_eur", revenue).select(
        "store_id",
        F.concat(F.lit(f"{prior_year + 1}"), F.substring("prior_month", 5, 3)).alias("budget_month"),
        "revenue_budget_eur",
        F.round(F.try_divide(F.col("cogs") * F.col("revenue_budget_eur").cast("decimal(18,0)"), F.col("net")), -2)
        .cast(MONEY)
        .alias("cogs_budget_eur"),
    )
