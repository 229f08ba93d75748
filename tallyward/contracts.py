"""Table contracts: what a row of each source must look like to be trusted.

A contract is plain data.  :func:`tallyward.operators.validation.audit` compiles it
into one DataFrame projection, so adding a source means adding a contract, not code.
"""

from __future__ import annotations

from dataclasses import dataclass

MONEY = "decimal(18,2)"
MONEY4 = "decimal(18,4)"
RATE = "decimal(18,6)"
VAT = "decimal(6,4)"


@dataclass(frozen=True)
class Reference:
    """Values of ``column`` must occur in ``parent_column`` of the ``parent`` table."""

    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Conversion:
    """``target`` = ``amount`` in EUR at the rate of (``currency``, ``day``)."""

    target: str
    amount: str
    currency: str = "currency"
    day: str = "business_date"


@dataclass(frozen=True)
class Contract:
    source: str
    key: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]
    may_be_empty: frozenset[str] = frozenset()
    rules: tuple[tuple[str, str], ...] = ()
    references: tuple[Reference, ...] = ()
    conversions: tuple[Conversion, ...] = ()

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]


def _pairs(text: str, separator: str) -> tuple[tuple[str, str], ...]:
    lines = (line.strip() for line in text.strip().splitlines())
    return tuple(tuple(part.strip() for part in line.split(separator, 1)) for line in lines if line)


def _contract(source, key, columns, rules="", may_be_empty=(), references=(), conversions=()):
    return Contract(
        source=source,
        key=tuple(key.split()),
        columns=_pairs(columns, " "),
        rules=_pairs(rules, ":"),
        may_be_empty=frozenset(may_be_empty),
        references=tuple(Reference(*r) for r in references),
        conversions=tuple(Conversion(*c) for c in conversions),
    )


# Column names, types, keys and rule names of the eight sources.
# A rule whose predicate is NULL passes; absence is reported by the column checks.
STORES = _contract(
    "stores",
    "store_id",
    """
    store_id string
    store_name string
    country string
    currency string
    region string
    format string
    size_factor double
    open_date date
    """,
    rules="""
    country_known: country in ('DE', 'CH')
    currency_matches_country: (country, currency) in (('DE', 'EUR'), ('CH', 'CHF'))
    format_known: format in ('hypermarket', 'supermarket', 'express', 'online')
    size_positive: size_factor > 0
    """,
)

PRODUCTS = _contract(
    "products",
    "sku",
    """
    sku string
    category string
    reduced_vat boolean
    list_price_eur decimal(18,2)
    unit_cost_eur decimal(18,2)
    """,
    rules="""
    price_positive: list_price_eur > 0
    cost_below_price: unit_cost_eur > 0 and unit_cost_eur < list_price_eur
    """,
)

CASHIERS = _contract(
    "cashiers",
    "cashier_id",
    """
    cashier_id string
    store_id string
    """,
    references=[("store_id", "stores", "store_id")],
)

FX_RATES = _contract(
    "fx_rates",
    "rate_date currency",
    """
    rate_date date
    currency string
    units_per_eur decimal(18,6)
    """,
    rules="rate_positive: units_per_eur > 0",
)

POS_SALES = _contract(
    "pos_sales",
    "transaction_id line_no",
    """
    transaction_id string
    line_no int
    transaction_ts timestamp
    business_date date
    store_id string
    cashier_id string
    sku string
    quantity int
    unit_price decimal(18,2)
    discount_amount decimal(18,2)
    gross_amount decimal(18,2)
    vat_rate decimal(6,4)
    net_amount decimal(18,2)
    vat_amount decimal(18,2)
    currency string
    payment_method string
    promo_flag boolean
    """,
    rules="""
    quantity_positive: quantity > 0
    price_positive: unit_price > 0
    discount_not_negative: discount_amount >= 0
    gross_equals_net_plus_vat: gross_amount = net_amount + vat_amount
    date_matches_timestamp: business_date = to_date(transaction_ts)
    payment_known: payment_method in ('card', 'cash', 'voucher')
    currency_known: currency in ('EUR', 'CHF')
    """,
    references=[
        ("store_id", "stores", "store_id"),
        ("cashier_id", "cashiers", "cashier_id"),
        ("sku", "products", "sku"),
    ],
    conversions=[("gross_amount_eur", "gross_amount"), ("net_amount_eur", "net_amount")],
)

REFUNDS = _contract(
    "refunds",
    "refund_id",
    """
    refund_id string
    refund_ts timestamp
    business_date date
    store_id string
    cashier_id string
    original_transaction_id string
    sku string
    quantity int
    refund_amount decimal(18,2)
    vat_rate decimal(6,4)
    currency string
    receipt_present boolean
    refund_method string
    reason string
    """,
    rules="""
    quantity_positive: quantity > 0
    amount_positive: refund_amount > 0
    receipt_means_original: receipt_present = (original_transaction_id is not null)
    method_known: refund_method in ('cash', 'card')
    """,
    may_be_empty=("original_transaction_id", "sku"),
    references=[
        ("store_id", "stores", "store_id"),
        ("cashier_id", "cashiers", "cashier_id"),
        ("sku", "products", "sku"),
        ("original_transaction_id", "pos_sales", "transaction_id"),
    ],
    conversions=[("refund_amount_eur", "refund_amount")],
)

GL_JOURNAL = _contract(
    "gl_journal",
    "journal_id line_no",
    """
    journal_id string
    line_no int
    posting_date date
    account_code string
    account_name string
    store_id string
    debit_eur decimal(18,2)
    credit_eur decimal(18,2)
    source string
    description string
    """,
    rules="""
    amounts_not_negative: debit_eur >= 0 and credit_eur >= 0
    one_side_only: (debit_eur > 0) <> (credit_eur > 0)
    """,
    references=[("store_id", "stores", "store_id")],
)

BUDGET = _contract(
    "budget",
    "store_id budget_month",
    """
    store_id string
    budget_month string
    revenue_budget_eur decimal(18,2)
    cogs_budget_eur decimal(18,2)
    """,
    rules="""
    month_format: budget_month rlike '^[0-9]{4}-(0[1-9]|1[0-2])$'
    amounts_not_negative: revenue_budget_eur >= 0 and cogs_budget_eur >= 0
    """,
    references=[("store_id", "stores", "store_id")],
)

# Master tables: small next to the facts, though their size is still checked before a broadcast.
MASTERS = ("stores", "products", "cashiers")

# Parents come before the tables that refer to them.
CONTRACTS = {
    c.source: c for c in (STORES, PRODUCTS, CASHIERS, FX_RATES, POS_SALES, REFUNDS, GL_JOURNAL, BUDGET)
}
