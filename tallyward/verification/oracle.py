"""Independent SQL for the registered queries, in another engine's dialect.

Money is kept in whole cents or in fixed-point integers, so every rounding is exact:
``m`` is a rate in thousandths, a suffix ``4`` means 1/10,000 EUR and ``16`` means 1e-16 EUR.
"""

from __future__ import annotations

CTE: dict[str, str] = {}
ORACLE: dict[str, str] = {}


def half_up(n: str, d: str) -> str:
    """n / d rounded half away from zero, for integers with d > 0."""
    return f"(CASE WHEN ({n}) < 0 THEN -1 ELSE 1 END * ((2 * abs({n}) + ({d})) // (2 * ({d}))))"


def ratio(n: str, d: str, digits: int = 4) -> str:
    """n / d rounded to ``digits`` as a double; NULL where d is zero (d may be negative)."""
    s = 10**digits
    exact = half_up(f"(CASE WHEN ({d}) < 0 THEN -1 ELSE 1 END) * ({n})::HUGEINT * {s}", f"abs({d})")
    return f"(CASE WHEN ({d}) = 0 THEN NULL ELSE ({exact})::DOUBLE / {s} END)"


def eur(c: str) -> str:
    return f"(({c})::DOUBLE / 100)"


def eur16(c: str, m: str = "m") -> str:
    """Cents at a rate in thousandths, in units of 1e-16 EUR."""
    return half_up(f"({c})::HUGEINT * 100000000000000000", f"({m})")


def cents16(x: str) -> str:
    return half_up(x, "100000000000000")


def money(c: str) -> str:
    """Cents printed with two decimals."""
    return f"(({c}) // 100)::VARCHAR || '.' || lpad((({c}) % 100)::VARCHAR, 2, '0')"


def sql(body: str) -> str:
    """Put the common table expressions a statement needs in front of it."""
    import re

    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTE:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTE[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in needed) + "\n" + body if needed else body


# ------------------------------------------------------------------ sources

CTE["o_stores"] = """
SELECT s_suppkey, 'S' || lpad(s_suppkey::VARCHAR, 8, '0') AS store_id, s_name AS store_name,
  CASE WHEN n_regionkey = 0 THEN 'CH' ELSE 'DE' END AS country,
  CASE WHEN n_regionkey = 0 THEN 'CHF' ELSE 'EUR' END AS currency,
  CASE s_suppkey % 10 WHEN 0 THEN 'online' WHEN 1 THEN 'hypermarket' WHEN 2 THEN 'express' ELSE 'supermarket' END AS format
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

CTE["o_products"] = """
SELECT 'P' || lpad(p_partkey::VARCHAR, 9, '0') AS sku, p_type AS category,
  (round(p_retailprice * 100)::BIGINT * (50 + p_partkey % 20)) // 100 AS cost_c
FROM part"""

CTE["o_published"] = """
SELECT day, (920 + dayofyear(day) % 50)::BIGINT AS m
FROM (SELECT DISTINCT o_orderdate::DATE AS day FROM orders)
WHERE isodow(day) < 6 AND date_diff('day', DATE '1995-01-01', day) % 11 <> 0"""

CTE["o_till"] = """
SELECT *, gross_c - net_c AS vat_c FROM (
  SELECT *, (200 * gross_c + 100 + vat_pct) // (2 * (100 + vat_pct)) AS net_c FROM (
    SELECT *, price_c - discount_c AS gross_c FROM (
      SELECT *, (price_c * disc_pct + 50) // 100 AS discount_c FROM (
        SELECT l.*, store_id, currency, round(l_extendedprice * 100)::BIGINT AS price_c,
          round(l_discount * 100)::BIGINT AS disc_pct, round(l_tax * 100)::BIGINT AS vat_pct,
          l_shipdate::DATE AS day, floor(l_quantity)::BIGINT AS qty
        FROM lineitem l LEFT JOIN o_stores ON l_suppkey = s_suppkey))))"""

CTE["o_bpos"] = f"""
SELECT 'T' || l_orderkey AS transaction_id, l_linenumber::VARCHAR AS line_no,
  strftime(day + INTERVAL (l_orderkey % 1440) MINUTE, '%Y-%m-%d %H:%M:%S') AS transaction_ts,
  CASE WHEN l_orderkey % 991 = 0 THEN '2026-13-45' ELSE day::VARCHAR END AS business_date,
  CASE WHEN l_orderkey % 983 = 0 THEN 'S-UNKNOWN' ELSE store_id END AS store_id,
  store_id || '-C0' || (1 + l_orderkey % 6) AS cashier_id,
  CASE WHEN l_orderkey % 977 <> 0 THEN 'P' || lpad(l_partkey::VARCHAR, 9, '0') END AS sku,
  CASE WHEN l_orderkey % 997 = 0 THEN '-1' ELSE qty::VARCHAR END AS quantity,
  {money("price_c // qty")} AS unit_price, {money("discount_c")} AS discount_amount, {money("gross_c")} AS gross_amount,
  '0.' || lpad(vat_pct::VARCHAR, 2, '0') || '00' AS vat_rate, {money("net_c")} AS net_amount, {money("vat_c")} AS vat_amount,
  currency, ['card', 'cash', 'voucher'][1 + l_partkey % 3] AS payment_method,
  CASE WHEN disc_pct > 0 THEN 'True' ELSE 'False' END AS promo_flag,
  price_c // qty AS price_c, discount_c, gross_c, vat_pct, net_c, vat_c
FROM o_till"""

CTE["o_span"] = """
SELECT min(try_cast(business_date AS DATE)) AS lo, max(try_cast(business_date AS DATE)) AS hi FROM o_bpos"""

CTE["o_rates"] = """
SELECT day, 'CHF' AS currency, coalesce(
    last_value(m IGNORE NULLS) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(m IGNORE NULLS) OVER (ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS m
FROM (SELECT unnest(generate_series(least(lo, (SELECT min(day) FROM o_published)), hi, INTERVAL 1 DAY))::DATE AS day FROM o_span)
LEFT JOIN o_published USING (day)
UNION ALL
SELECT unnest(generate_series(least(lo, (SELECT min(day) FROM o_published)), hi, INTERVAL 1 DAY))::DATE, 'EUR', 1000 FROM o_span"""

POS_TEXT = [
    "transaction_id", "line_no", "transaction_ts", "business_date", "store_id", "cashier_id", "sku", "quantity",
    "unit_price", "discount_amount", "gross_amount", "vat_rate", "net_amount", "vat_amount", "currency",
    "payment_method", "promo_flag",
]
REFUND_TEXT = [
    "refund_id", "refund_ts", "business_date", "store_id", "cashier_id", "original_transaction_id", "sku", "quantity",
    "refund_amount", "vat_rate", "currency", "receipt_present", "refund_method", "reason",
]


def record(columns: list[str]) -> str:
    parts = ", ".join(f"""'"{c}":"' || {c} || '"'""" for c in columns)
    return f"'{{' || concat_ws(',', {parts}) || '}}'"


def reasons(*pairs: tuple[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in pairs)
    return f"concat_ws(',', {cases})"


CTE["o_pos_audit"] = f"""
SELECT *, {reasons(
    *[(f"missing:{c}", f"nullif(trim({c}), '') IS NULL") for c in POS_TEXT[:3]],
    ("missing:business_date", "business_date IS NULL"),
    ("bad_type:business_date", "business_date IS NOT NULL AND d IS NULL"),
    ("missing:store_id", "store_id IS NULL"),
    ("missing:cashier_id", "cashier_id IS NULL"),
    ("missing:sku", "sku IS NULL"),
    ("bad_type:quantity", "NOT regexp_full_match(quantity, '-?[0-9]+')"),
    ("rule:quantity_positive", "quantity::BIGINT <= 0"),
    ("rule:price_positive", "price_c <= 0"),
    ("rule:discount_not_negative", "discount_c < 0"),
    ("rule:gross_equals_net_plus_vat", "gross_c <> net_c + vat_c"),
    ("rule:date_matches_timestamp", "d <> transaction_ts::TIMESTAMP::DATE"),
    ("rule:payment_known", "payment_method NOT IN ('card', 'cash', 'voucher')"),
    ("rule:currency_known", "currency NOT IN ('EUR', 'CHF')"),
    ("ref:store_id", "NOT EXISTS (SELECT 1 FROM o_stores s WHERE s.store_id = b.store_id)"),
    ("ref:cashier_id", "cashier_id IS NULL"),
    ("ref:sku", "NOT EXISTS (SELECT 1 FROM o_products p WHERE p.sku = coalesce(b.sku, ''))"),
    ("no_fx_rate:gross_amount_eur", "m IS NULL"),
    ("no_fx_rate:net_amount_eur", "m IS NULL"),
)} AS reasons
FROM (SELECT b.*, d, m FROM (SELECT *, try_cast(business_date AS DATE) AS d FROM o_bpos) b
      LEFT JOIN o_rates r ON r.day = b.d AND r.currency = b.currency) b"""

CTE["o_pos"] = f"""
SELECT transaction_id, line_no::BIGINT AS line_no, transaction_ts, d AS day, store_id, cashier_id, sku,
  quantity::BIGINT AS quantity, price_c, discount_c, gross_c, vat_pct, net_c, vat_c, currency, payment_method, promo_flag,
  m, {half_up("gross_c * 100000", "m")} AS gross4, {half_up("net_c * 100000", "m")} AS net4, strftime(d, '%Y-%m') AS month
FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id, line_no ORDER BY transaction_ts DESC, business_date DESC,
        store_id DESC, cashier_id DESC, sku DESC, quantity::BIGINT DESC, price_c DESC, discount_c DESC, gross_c DESC, vat_pct DESC,
        net_c DESC, vat_c DESC, currency DESC, payment_method DESC, promo_flag DESC) AS rn
      FROM o_pos_audit WHERE reasons = '')
WHERE rn = 1"""

CTE["o_brefunds"] = f"""
SELECT 'R' || l_orderkey || '-' || l_linenumber AS refund_id, strftime(day, '%Y-%m-%d 00:00:00') AS refund_ts, day::VARCHAR AS business_date,
  store_id, store_id || '-C0' || (1 + l_orderkey % 6) AS cashier_id,
  CASE WHEN l_linestatus = 'F' AND l_orderkey % 967 <> 0
    THEN CASE WHEN l_orderkey % 971 = 0 THEN 'GHOST' ELSE 'T' END || l_orderkey END AS original_transaction_id,
  CASE WHEN l_linestatus = 'F' THEN 'P' || lpad(l_partkey::VARCHAR, 9, '0') END AS sku, qty::VARCHAR AS quantity,
  {money("gross_c")} AS refund_amount, '0.' || lpad(vat_pct::VARCHAR, 2, '0') || '00' AS vat_rate, currency,
  CASE WHEN l_linestatus = 'F' THEN 'True' ELSE 'False' END AS receipt_present,
  CASE WHEN l_partkey % 2 = 0 THEN 'cash' ELSE 'card' END AS refund_method,
  CASE WHEN l_partkey % 5 = 0 THEN 'damaged' ELSE 'unwanted' END AS reason, gross_c, vat_pct, day, qty
FROM o_till WHERE l_returnflag = 'R'"""

CTE["o_refund_audit"] = f"""
SELECT b.*, m, {reasons(
    ("missing:refund_id", "refund_id IS NULL"),
    ("rule:quantity_positive", "qty <= 0"),
    ("rule:amount_positive", "gross_c <= 0"),
    ("rule:receipt_means_original", "(receipt_present = 'True') <> (original_transaction_id IS NOT NULL)"),
    ("ref:store_id", "NOT EXISTS (SELECT 1 FROM o_stores s WHERE s.store_id = b.store_id)"),
    ("ref:sku", "sku IS NOT NULL AND NOT EXISTS (SELECT 1 FROM o_products p WHERE p.sku = b.sku)"),
    ("ref:original_transaction_id", "original_transaction_id IS NOT NULL AND t.transaction_id IS NULL"),
    ("no_fx_rate:refund_amount_eur", "m IS NULL"),
)} AS reasons
FROM o_brefunds b LEFT JOIN o_rates r ON r.day = b.day AND r.currency = b.currency
LEFT JOIN (SELECT DISTINCT transaction_id FROM o_pos) t ON t.transaction_id = b.original_transaction_id"""

CTE["o_refunds"] = f"""
SELECT *, {half_up("gross_c * 100000", "m")} AS amount4, strftime(day, '%Y-%m') AS month, receipt_present = 'True' AS receipt
FROM (SELECT *, row_number() OVER (PARTITION BY refund_id ORDER BY refund_ts DESC, business_date DESC, store_id DESC, cashier_id DESC,
        original_transaction_id DESC NULLS LAST, sku DESC NULLS LAST, qty DESC, gross_c DESC, vat_pct DESC, currency DESC,
        receipt_present DESC, refund_method DESC, reason DESC) AS rn
      FROM o_refund_audit WHERE reasons = '')
WHERE rn = 1"""

ORACLE["fx_daily"] = sql("SELECT day::VARCHAR AS rate_date, currency, m::DOUBLE / 1000 AS units_per_eur FROM o_rates")

ORACLE["silver_pos"] = sql(f"""
SELECT transaction_id, line_no, transaction_ts, day::VARCHAR AS business_date, store_id, cashier_id, sku, quantity,
  {eur("price_c")} AS unit_price, {eur("discount_c")} AS discount_amount, {eur("gross_c")} AS gross_amount,
  {eur("vat_pct")} AS vat_rate, {eur("net_c")} AS net_amount, {eur("vat_c")} AS vat_amount, currency, payment_method,
  promo_flag = 'True' AS promo_flag, gross4::DOUBLE / 10000 AS gross_amount_eur, net4::DOUBLE / 10000 AS net_amount_eur
FROM o_pos""")

ORACLE["silver_refunds"] = sql(f"""
SELECT refund_id, refund_ts, business_date, store_id, cashier_id, original_transaction_id, sku, qty AS quantity,
  {eur("gross_c")} AS refund_amount, {eur("vat_pct")} AS vat_rate, currency, receipt AS receipt_present, refund_method, reason,
  amount4::DOUBLE / 10000 AS refund_amount_eur
FROM o_refunds""")

CTE["o_quarantine"] = f"""
SELECT 'pos_sales' AS source, transaction_id || '|' || line_no AS record_key, reasons, {record(POS_TEXT)} AS record
FROM o_pos_audit WHERE reasons <> ''
UNION ALL
SELECT 'refunds', refund_id, reasons, {record(REFUND_TEXT)} FROM o_refund_audit WHERE reasons <> ''"""

ORACLE["quarantine"] = sql("SELECT * FROM o_quarantine")

CTE["o_reason_rows"] = """
SELECT source, unnest(string_split(reasons, ',')) AS reason FROM o_quarantine
UNION ALL SELECT 'stores', 'rule:currency_matches_country' FROM supplier WHERE s_suppkey % 41 = 40"""
ORACLE["reason_counts"] = sql("SELECT source, reason, count(*) AS n FROM o_reason_rows GROUP BY ALL")

ORACLE["row_accounting"] = sql("""
SELECT source, bronze, silver, quarantined, bronze - silver - quarantined AS duplicates, true AS balanced FROM (
  SELECT 'pos_sales' AS source, (SELECT count(*) FROM lineitem) AS bronze, (SELECT count(*) FROM o_pos) AS silver,
    (SELECT count(*) FROM o_pos_audit WHERE reasons <> '') AS quarantined
  UNION ALL
  SELECT 'refunds', (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R'), (SELECT count(*) FROM o_refunds),
    (SELECT count(*) FROM o_refund_audit WHERE reasons <> ''))""")

# ------------------------------------------------------------------ gold

CTE["o_lines"] = f"""
SELECT p.*, category, CASE WHEN format = 'online' THEN 'online' ELSE 'store' END AS channel,
  {eur16("discount_c")} AS discount16, quantity * cost_c AS cogs_c
FROM o_pos p LEFT JOIN o_products USING (sku) LEFT JOIN (SELECT store_id, format FROM o_stores) USING (store_id)"""

ORACLE["sales_lines"] = sql(f"""
SELECT transaction_id, line_no, channel, category, month,
  ({half_up("discount16", "100000000")})::DOUBLE / 100000000 AS discount_eur, {eur("cogs_c")} AS cogs_eur
FROM o_lines""")

MEASURES = f"""{half_up("sum(gross4)", "100")} AS paid_c, {cents16("sum(discount16)")} AS disc_c,
  {half_up("sum(net4)", "100")} AS net_c, sum(cogs_c) AS cogs_c"""

CTE["o_daily"] = f"""
SELECT store_id, channel, day, count(DISTINCT transaction_id) AS transactions, count(*) AS lines, sum(quantity)::BIGINT AS units, {MEASURES}
FROM o_lines GROUP BY store_id, channel, day"""
ORACLE["daily_revenue"] = sql(f"""
SELECT store_id, channel, day::VARCHAR AS business_date, transactions, lines, units, {eur("paid_c")} AS paid_incl_vat_eur,
  {eur("disc_c")} AS discount_eur, {eur("net_c")} AS net_sales_eur, {eur("cogs_c")} AS cogs_eur
FROM o_daily""")

CTE["o_margin"] = f"SELECT store_id, category, month, {MEASURES} FROM o_lines GROUP BY store_id, category, month"
ORACLE["margin"] = sql(f"""
SELECT store_id, category, month, {eur("net_c")} AS net_sales_eur, {eur("cogs_c")} AS cogs_eur, {eur("disc_c")} AS discount_eur,
  {eur("paid_c")} AS paid_incl_vat_eur, {eur("net_c - cogs_c")} AS gross_margin_eur, {ratio("net_c - cogs_c", "net_c")} AS margin_pct,
  {ratio("disc_c", "paid_c + disc_c")} AS discount_rate
FROM o_margin""")

CTE["o_refunds_month"] = f"""
SELECT store_id, cashier_id, month, count(*) AS refunds, {half_up("sum(amount4)", "100")} AS gross_c,
  {half_up("sum(" + half_up("amount4::HUGEINT * 1000000000000", "10000 + 100 * vat_pct") + ")", "10000000000")} AS net_c,
  count(*) FILTER (NOT receipt) AS no_receipt, {half_up("coalesce(sum(amount4) FILTER (NOT receipt), 0)", "100")} AS no_receipt_c
FROM o_refunds GROUP BY store_id, cashier_id, month"""
REFUNDS_MONTH = f"""
SELECT store_id, cashier_id, month, refunds, {eur("gross_c")} AS refund_gross_eur, {eur("net_c")} AS refund_net_eur,
  no_receipt AS no_receipt_refunds, {eur("no_receipt_c")} AS no_receipt_eur, {ratio("no_receipt_c", "gross_c")} AS no_receipt_share
FROM o_refunds_month"""
ORACLE["refunds_month"] = sql(REFUNDS_MONTH)

# What each planted fault is found as: column by column (* has a type to fail, ? may be empty), then rules, surplus, references and rates.
FAULTS = {
    "stores": ("store_id store_name country currency region format size_factor* open_date*", """
        rule:country_known,rule:currency_matches_country
        rule:currency_matches_country
        rule:format_known
        rule:size_positive"""),
    "products": ("sku category reduced_vat* list_price_eur* unit_cost_eur*", """
        rule:price_positive,rule:cost_below_price
        rule:cost_below_price"""),
    "cashiers": ("cashier_id store_id", "ref:store_id"),
    "fx_rates": ("rate_date* currency units_per_eur*", "rule:rate_positive"),
    "pos_sales": ("""transaction_id line_no* transaction_ts* business_date*! store_id cashier_id sku quantity* unit_price* discount_amount* gross_amount*
        vat_rate* net_amount* vat_amount* currency! payment_method promo_flag*""", """
        rule:quantity_positive
        rule:price_positive
        rule:discount_not_negative
        rule:gross_equals_net_plus_vat
        rule:date_matches_timestamp
        rule:payment_known
        rule:currency_known!
        ref:store_id
        ref:cashier_id
        ref:sku
        rule:date_matches_timestamp!"""),
    "refunds": ("""refund_id refund_ts* business_date*! store_id cashier_id original_transaction_id? sku? quantity* refund_amount* vat_rate* currency!
        receipt_present* refund_method reason""", """
        rule:quantity_positive
        rule:amount_positive
        rule:receipt_means_original
        rule:method_known
        ref:store_id
        ref:cashier_id
        ref:sku
        ref:original_transaction_id
        !"""),
    "gl_journal": ("journal_id line_no* posting_date* account_code account_name store_id debit_eur* credit_eur* source description", """
        rule:amounts_not_negative
        rule:one_side_only
        ref:store_id"""),
    "budget": ("store_id budget_month revenue_budget_eur* cogs_budget_eur*", """
        rule:month_format
        rule:amounts_not_negative
        ref:store_id"""),
}
UNRATED = {"pos_sales": "no_fx_rate:gross_amount_eur,no_fx_rate:net_amount_eur", "refunds": "no_fx_rate:refund_amount_eur"}  # what ! stands for

# Blank text is a value to rules and references, so it fails them beside being missing.
BLANK_TOO = {
    "stores": {"country": "rule:country_known,rule:currency_matches_country", "currency": "rule:currency_matches_country", "format": "rule:format_known"},
    "cashiers": {"store_id": "ref:store_id"},
    "pos_sales": {"store_id": "ref:store_id", "cashier_id": "ref:cashier_id", "sku": "ref:sku", "payment_method": "rule:payment_known", "currency": "rule:currency_known"},
    "refunds": {"store_id": "ref:store_id", "cashier_id": "ref:cashier_id", "refund_method": "rule:method_known"},
    "gl_journal": {"store_id": "ref:store_id"},
    "budget": {"store_id": "ref:store_id", "budget_month": "rule:month_format"},
}


def planted_faults(source: str) -> list[str]:
    """The reasons of each fault in order, comma-joined."""
    columns, wrong = FAULTS[source]
    also = BLANK_TOO.get(source, {})
    found = [",".join(["missing:" + c.replace("*", ""), *filter(None, [also.get(c.strip("*!"))])]) for c in columns.split() if "?" not in c]
    found += ["bad_type:" + c.replace("*", "") for c in columns.split() if "*" in c]
    found += [*wrong.split(), "unexpected_columns"]
    # The mark for rates may stand inside; every fault names its reasons once, in any order.
    return [",".join([*filter(None, f.replace("!", "").split(",")), *([UNRATED[source]] if "!" in f else [])]) for f in found]


def fault_rows(source: str, key: str, table: str) -> str:
    """(source, reasons) of the rows of ``table``: of all faults without a ``key``, else of the fault that its digest picks."""
    found = "[" + ", ".join(f"'{f}'" for f in planted_faults(source)) + "]"
    picked = f"{found}[('0x' || substr(md5({key}), 1, 8))::BIGINT % {len(planted_faults(source)) + 1}]" if key else f"unnest({found})"
    return f"SELECT '{source}' AS source, {picked} AS reasons FROM {table}"


CTE["o_fault_rows"] = " UNION ALL ".join(fault_rows(*f) for f in (
    ("stores", "", "o_stores"), ("products", "", "o_products"), ("cashiers", "", "(SELECT unnest(range(6)) FROM o_stores)"), ("fx_rates", "", "o_published"),
    ("pos_sales", "transaction_id || '|' || line_no", "o_pos"), ("refunds", "refund_id", "o_refunds"),
    ("gl_journal", "journal_id || '|' || line_no", "o_journals"), ("budget", "", "o_budget"),
))
ORACLE["contract_findings"] = """SELECT source, reason, count(*) AS n FROM (SELECT source, unnest(string_split(reasons, ',')) AS reason FROM o_fault_rows) WHERE reason IS NOT NULL GROUP BY ALL"""
CTE["o_budget_plan"] = f"""
SELECT *, {half_up("cogs_c::HUGEINT * revenue_eur * 100", "net4 * 100")} * 100 AS cost_eur FROM (
  SELECT store_id, '2000' || substr(month, 5, 3) AS budget_month, sum(net4) AS net4, sum(cogs_c) AS cogs_c,
    {half_up("sum(net4) * 105", "100000000")} * 100 AS revenue_eur
  FROM o_lines WHERE year(day) = 1999 GROUP BY store_id, month)"""
ORACLE["budget_prior_year"] = sql("""
SELECT store_id, budget_month, revenue_eur::DOUBLE AS revenue_budget_eur, cost_eur::DOUBLE AS cogs_budget_eur FROM o_budget_plan""")

CTE["o_budget"] = """
SELECT store_id, budget_month, CASE WHEN zero THEN 0 ELSE revenue_eur END AS revenue_eur, CASE WHEN zero THEN 0 ELSE cost_eur END AS cost_eur
FROM (SELECT *, substr(store_id, 2)::BIGINT % 19 = 7 AS zero FROM o_budget_plan WHERE substr(store_id, 2)::BIGINT % 17 <> 5)"""


def variance(until: str) -> str:
    share = f"CASE WHEN last_day((month || '-01')::DATE) <= {until} THEN 1 ELSE day({until}) END"
    whole = f"CASE WHEN last_day((month || '-01')::DATE) <= {until} THEN 1 ELSE day(last_day((month || '-01')::DATE)) END"
    return f"""
SELECT *, actual_c - to_date_c AS variance_c FROM (
  SELECT store_id, month, actual_c, actual_cogs_c, revenue_eur, cost_eur, revenue_eur IS NOT NULL AS has_budget,
    last_day((month || '-01')::DATE) <= {until} AS complete,
    {half_up(f"revenue_eur * 100 * {share}", whole)} AS to_date_c, {half_up(f"cost_eur * 100 * {share}", whole)} AS cogs_to_date_c
  FROM (SELECT store_id, month, {half_up("sum(net4)", "100")} AS actual_c, sum(cogs_c) AS actual_cogs_c
        FROM o_lines WHERE year(day) = 2000 GROUP BY store_id, month) a
  LEFT JOIN (SELECT store_id, budget_month AS month, revenue_eur, cost_eur FROM o_budget) b USING (store_id, month))"""


CTE["o_variance_mid"] = variance("DATE '2000-11-20'")
CTE["o_variance"] = variance("(SELECT max(day) FROM o_pos)")
ORACLE["budget_variance"] = sql(f"""
SELECT store_id, month, {eur("actual_c")} AS actual_net_sales_eur, {eur("actual_cogs_c")} AS actual_cogs_eur,
  revenue_eur::DOUBLE AS budget_net_sales_eur, cost_eur::DOUBLE AS budget_cogs_eur, has_budget, complete AS complete_month,
  {eur("to_date_c")} AS budget_to_date_eur, {eur("cogs_to_date_c")} AS budget_cogs_to_date_eur, {eur("variance_c")} AS variance_eur,
  {ratio("variance_c", "to_date_c")} AS variance_pct
FROM o_variance_mid""")

CTE["o_tie"] = f"""
SELECT 'daily_revenue net sales' AS "check", (SELECT {half_up("sum(net4)", "100")} FROM o_pos) AS e, (SELECT sum(net_c) FROM o_daily) AS a, 100 AS scale
UNION ALL SELECT 'margin net sales', (SELECT {half_up("sum(net4)", "100")} FROM o_pos), (SELECT sum(net_c) FROM o_margin), 100
UNION ALL SELECT 'daily_revenue lines', (SELECT count(*) FROM o_pos), (SELECT sum(lines) FROM o_daily), 1
UNION ALL SELECT 'margin cost of goods', (SELECT sum(cogs_c) FROM o_daily), (SELECT sum(cogs_c) FROM o_margin), 100
UNION ALL SELECT 'refunds count', (SELECT count(*) FROM o_refunds), (SELECT sum(refunds) FROM o_refunds_month), 1
UNION ALL SELECT 'refunds amount', (SELECT {half_up("sum(amount4)", "100")} FROM o_refunds), (SELECT sum(gross_c) FROM o_refunds_month), 100
UNION ALL SELECT 'budget_variance store-months', (SELECT count(DISTINCT store_id || month) FROM o_pos WHERE year(day) = 2000), (SELECT count(*) FROM o_variance), 1
UNION ALL SELECT 'budget_variance net sales', (SELECT {half_up("sum(net4)", "100")} FROM o_pos WHERE year(day) = 2000), (SELECT sum(actual_c) FROM o_variance), 100"""
ORACLE["tie_outs"] = sql("""
SELECT "check", e::DOUBLE / scale AS expected, a::DOUBLE / scale AS actual, abs(a - e) <= CASE WHEN scale = 100 THEN 100 ELSE 0 END AS ok FROM o_tie""")

ORACLE["highlights_year"] = sql(f"""
SELECT y AS year, {eur("net")} AS net_sales_eur, round((net - cogs)::DOUBLE / net, 4) AS gross_margin,
  round((SELECT sum(net_c) FROM o_refunds_month WHERE substr(month, 1, 4) = y::VARCHAR)::DOUBLE / net, 4) AS returns_share
FROM (SELECT year(day) AS y, sum(net_c) AS net, sum(cogs_c) AS cogs FROM o_daily
      WHERE year(day) = (SELECT max(year(day)) - 1 FROM o_daily) GROUP BY 1)""")

CTE["o_store_month"] = """
SELECT store_id, month, 1 - sum(cogs_c)::DOUBLE / sum(net_c) AS margin, sum(disc_c)::DOUBLE / (sum(paid_c) + sum(disc_c)) AS discount_rate
FROM o_margin GROUP BY store_id, month"""
ORACLE["highlights_margin"] = sql("""
SELECT store_id, month, round(margin, 4) AS margin, round(base_margin, 4) AS base_margin, round((base_margin - margin) * 100, 1) AS drop_pts
FROM o_store_month m JOIN (
  SELECT store_id, avg(margin) AS base_margin FROM o_store_month
  WHERE month BETWEEN (SELECT substr(max(month), 1, 4) || '-01' FROM o_margin) AND (SELECT substr(max(month), 1, 4) || '-05' FROM o_margin)
  GROUP BY store_id) b USING (store_id)
WHERE month = (SELECT max(month) FROM o_margin) ORDER BY drop_pts DESC, store_id LIMIT 3""")

ORACLE["highlights_cashiers"] = sql(f"""
SELECT store_id, cashier_id, refunds, no_receipt AS no_receipt_refunds, {eur("no_receipt_c")} AS no_receipt_eur,
  {ratio("no_receipt_c", "gross_c")} AS no_receipt_share
FROM o_refunds_month WHERE month = (SELECT max(month) FROM o_refunds_month)
ORDER BY no_receipt_c DESC, store_id, cashier_id LIMIT 3""")

# ------------------------------------------------------------------ ledger and reconciliation

CTE["o_day_totals"] = f"""
SELECT store_id, day, m, {eur16("coalesce(sum(gross_c) FILTER (payment_method = 'card'), 0)")} AS card16,
  {eur16("coalesce(sum(gross_c) FILTER (payment_method = 'cash'), 0)")} AS cash16,
  {eur16("coalesce(sum(gross_c) FILTER (payment_method = 'voucher'), 0)")} AS voucher16,
  {eur16("sum(gross_c)")} AS gross16, {eur16("sum(net_c)")} AS net16, sum(quantity * cost_c) AS cogs_c
FROM o_pos LEFT JOIN o_products USING (sku) GROUP BY store_id, day, m"""

CTE["o_refund_totals"] = f"""
SELECT store_id, day, sum(cash16) AS cash16, sum(card16) AS card16, sum(gross16) AS gross16, sum(net18) AS net18 FROM (
  SELECT store_id, day, {eur16("coalesce(sum(gross_c) FILTER (refund_method = 'cash'), 0)")} AS cash16,
    {eur16("coalesce(sum(gross_c) FILTER (refund_method = 'card'), 0)")} AS card16, {eur16("sum(gross_c)")} AS gross16,
    {half_up(half_up("sum(gross_c)::HUGEINT * 100000000000", "m") + " * 1000000000000", "10000 + 100 * vat_pct")} AS net18
  FROM o_refunds GROUP BY store_id, day, m, vat_pct)
GROUP BY store_id, day"""

CTE["o_entries"] = f"""
SELECT store_id, day, 'POS' AS tag, 'POS' AS source, 'Daily sales' AS description, unnest([
    {{'n': 1, 'code': '1200', 'dr': {cents16("card16")}, 'cr': 0::HUGEINT}}, {{'n': 2, 'code': '1000', 'dr': {cents16("cash16")}, 'cr': 0}},
    {{'n': 3, 'code': '1300', 'dr': {cents16("voucher16")}, 'cr': 0}}, {{'n': 4, 'code': '4000', 'dr': 0, 'cr': {cents16("net16")}}},
    {{'n': 5, 'code': '2200', 'dr': 0, 'cr': {cents16("gross16 - net16")}}}], recursive := true)
FROM o_day_totals
UNION ALL
SELECT store_id, day, 'COGS', 'COGS', 'Cost of goods sold', unnest([
    {{'n': 1, 'code': '5000', 'dr': cogs_c, 'cr': 0::HUGEINT}}, {{'n': 2, 'code': '1400', 'dr': 0, 'cr': cogs_c}}], recursive := true)
FROM o_day_totals
UNION ALL
SELECT store_id, day, 'REF', 'REFUND', 'Daily refunds', unnest([
    {{'n': 1, 'code': '4010', 'dr': {half_up("net18", "10000000000000000")}, 'cr': 0::HUGEINT}},
    {{'n': 2, 'code': '2200', 'dr': {cents16("gross16")} - {half_up("net18", "10000000000000000")}, 'cr': 0}},
    {{'n': 3, 'code': '1000', 'dr': 0, 'cr': {cents16("cash16")}}}, {{'n': 4, 'code': '1200', 'dr': 0, 'cr': {cents16("card16")}}}], recursive := true)
FROM o_refund_totals"""

CTE["o_journals"] = """
SELECT journal_id, row_number() OVER (PARTITION BY journal_id ORDER BY n) AS line_no, day, code, store_id,
  dr + CASE WHEN dr <> 0 AND n = min(CASE WHEN dr <> 0 THEN n END) OVER (PARTITION BY journal_id)
    THEN sum(cr - dr) OVER (PARTITION BY journal_id) ELSE 0 END AS dr_c, cr AS cr_c, source, description
FROM (SELECT *, 'J' || strftime(day, '%Y%m%d') || '-' || store_id || '-' || tag AS journal_id FROM o_entries WHERE dr <> 0 OR cr <> 0)"""

NAMES = """CASE code WHEN '1000' THEN 'Cash' WHEN '1200' THEN 'Card clearing' WHEN '1300' THEN 'Gift vouchers' WHEN '1400' THEN 'Inventory'
  WHEN '2200' THEN 'VAT payable' WHEN '4000' THEN 'Revenue' WHEN '4010' THEN 'Sales returns' ELSE 'Cost of goods sold' END"""
ORACLE["post_journals"] = sql(f"""
SELECT journal_id, line_no, day::VARCHAR AS posting_date, code AS account_code, {NAMES} AS account_name, store_id,
  {eur("dr_c")} AS debit_eur, {eur("cr_c")} AS credit_eur, source, description
FROM o_journals""")

CTE["o_numbered"] = """
SELECT *, date_diff('day', DATE '1995-01-01', day) + substr(store_id, 2)::BIGINT * 31 AS h FROM o_journals"""
CTE["o_kept"] = """
SELECT journal_id, line_no, day, code, store_id, dr_c,
  cr_c + CASE WHEN source = 'POS' AND code = '4000' AND h % 101 = 0 THEN 500 ELSE 0 END AS cr_c, source, description, h
FROM o_numbered WHERE source <> 'POS' OR h % 97 <> 0"""
CTE["o_gl"] = """
SELECT * FROM o_kept
UNION ALL SELECT journal_id || '-DUP', line_no, day, code, store_id, dr_c, cr_c, source, description, h FROM o_kept WHERE source = 'POS' AND h % 103 = 0
UNION ALL SELECT replace(journal_id, 'POS', 'MAN1'), 1, day, '1200', store_id, 100 * (3000 + h % 9000), 0, 'MANUAL', 'Manual revenue adjustment', h
  FROM o_numbered WHERE source = 'POS' AND code = '4000' AND h % 107 = 0
UNION ALL SELECT replace(journal_id, 'POS', 'MAN1'), 2, day, '4000', store_id, 0, 100 * (3000 + h % 9000), 'MANUAL', 'Manual revenue adjustment', h
  FROM o_numbered WHERE source = 'POS' AND code = '4000' AND h % 107 = 0"""

CTE["o_revenue"] = """
SELECT journal_id, store_id, day, source, description, sum(cr_c - dr_c) AS amount_c FROM o_gl WHERE code = '4000' GROUP BY ALL"""
CTE["o_recon"] = f"""
SELECT store_id, day, coalesce(gl_c, 0) AS gl_c, coalesce(pos_c, 0) AS pos_c, coalesce(gl_c, 0) - coalesce(pos_c, 0) AS diff_c
FROM (SELECT store_id, day, sum(amount_c) AS gl_c FROM o_revenue GROUP BY store_id, day)
FULL JOIN (SELECT store_id, day, {cents16("net16")} AS pos_c FROM o_day_totals) USING (store_id, day)"""
ORACLE["recon_daily"] = sql(f"""
SELECT store_id, day::VARCHAR AS business_date, {eur("gl_c")} AS gl_revenue_eur, {eur("pos_c")} AS pos_net_eur, {eur("diff_c")} AS difference_eur,
  CASE WHEN abs(diff_c) <= 1 THEN 'matched' ELSE 'difference' END AS status
FROM o_recon""")
ORACLE["recon_monthly"] = sql(f"""
SELECT store_id, strftime(day, '%Y-%m') AS month, {eur("sum(gl_c)")} AS gl_revenue_eur, {eur("sum(pos_c)")} AS pos_net_eur,
  {eur("sum(diff_c)")} AS difference_eur, count(*) FILTER (abs(diff_c) > 1) AS days_with_difference,
  CASE WHEN count(*) FILTER (abs(diff_c) > 1) = 0 THEN 'matched' ELSE 'difference' END AS status
FROM o_recon GROUP BY 1, 2""")

CTE["o_suspects"] = """
SELECT * FROM (
  SELECT *, CASE WHEN pos_c = 0 OR n_match >= 1 AND NOT hit THEN 'no matching POS sales'
    WHEN n_match > 1 THEN 'duplicate posting: several journals match the POS total' END AS reason
  FROM (SELECT *, abs(amount_c - pos_c) <= 1 AS hit, count(*) FILTER (abs(amount_c - pos_c) <= 1) OVER (PARTITION BY store_id, day) AS n_match
        FROM o_revenue JOIN o_recon USING (store_id, day) WHERE abs(diff_c) > 1))
WHERE reason IS NOT NULL"""
CTE["o_exceptions"] = """
SELECT d.store_id, d.day, journal_id, source, description, amount_c,
  coalesce(reason, 'difference not attributable to a journal') AS reason, d.gl_c, d.pos_c, d.diff_c,
  d.diff_c - coalesce(sum(amount_c) OVER (PARTITION BY d.store_id, d.day), 0) AS unexplained_c
FROM o_recon d LEFT JOIN o_suspects s ON s.store_id = d.store_id AND s.day = d.day WHERE abs(d.diff_c) > 1"""
ORACLE["recon_exceptions"] = sql(f"""
SELECT store_id, day::VARCHAR AS business_date, journal_id, source, description, {eur("amount_c")} AS amount_eur, reason,
  {eur("gl_c")} AS day_gl_revenue_eur, {eur("pos_c")} AS day_pos_net_eur, {eur("diff_c")} AS day_difference_eur,
  {eur("unexplained_c")} AS day_unexplained_eur
FROM o_exceptions""")

ORACLE["detection_score"] = sql("""
SELECT count(*) FILTER (p) AS planted, count(*) FILTER (f AND p) AS found, count(*) FILTER (f IS NULL) AS missed, count(*) FILTER (p IS NULL) AS false_positives
FROM (SELECT DISTINCT journal_id, true AS f FROM o_exceptions WHERE journal_id IS NOT NULL)
FULL JOIN (SELECT DISTINCT journal_id, true AS p FROM (
    SELECT journal_id FROM o_gl WHERE source = 'MANUAL' OR journal_id LIKE '%-DUP'
    UNION ALL SELECT replace(journal_id, '-DUP', '') FROM o_gl WHERE journal_id LIKE '%-DUP')) USING (journal_id)""")

# ------------------------------------------------------------------ calendars

CTE["o_easter"] = """
SELECT y, make_date(y, (h + l - 7 * mm + 114) // 31, (h + l - 7 * mm + 114) % 31 + 1) AS easter FROM (
  SELECT *, (a + 11 * h + 22 * l) // 451 AS mm FROM (
    SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM (
      SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM (
        SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM (
          SELECT unnest(generate_series(1990, 2010)) AS y)))))"""
CTE["o_holidays"] = """
SELECT country, (easter + shift)::DATE AS holiday, y FROM o_easter, (VALUES ('DE'), ('CH')) c(country), (VALUES (-2), (1), (39), (50)) s(shift)
UNION SELECT country, make_date(y, mo, d), y FROM o_easter, (VALUES ('DE', 1, 1), ('DE', 5, 1), ('DE', 10, 3), ('DE', 12, 25), ('DE', 12, 26),
  ('CH', 1, 1), ('CH', 1, 2), ('CH', 8, 1), ('CH', 12, 25), ('CH', 12, 26)) f(country, mo, d)"""
ORACLE["holidays"] = sql("""
SELECT DISTINCT country, holiday::VARCHAR AS holiday FROM o_holidays WHERE y IN (SELECT year(o_orderdate) FROM orders)""")
CTE["o_open"] = """
SELECT store_id, day FROM o_stores s, (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM o_pos) d
WHERE format = 'online' OR (isodow(day) < 7 AND NOT EXISTS (SELECT 1 FROM o_holidays h WHERE h.country = s.country AND h.holiday = d.day))"""
ORACLE["open_days"] = sql("SELECT store_id, day::VARCHAR AS business_date FROM o_open")


# ------------------------------------------------------------------ quality gate


def result(name: str, severity: str, stage: str, body: str) -> str:
    """Wrap a statement giving (n, detail) as a check result."""
    return f"""
SELECT '{name}' AS "check", '{severity}' AS severity, '{stage}' AS stage, n::BIGINT AS violations, n = 0 AS passed, detail FROM ({body})"""


def sampled(rows: str, label: str, order: str, found: str, clean: str) -> str:
    return f"""SELECT count(*) AS n, CASE WHEN count(*) = 0 THEN '{clean}' ELSE '{found}: ' ||
  (SELECT string_agg(lab, ', ' ORDER BY {order}) FROM (SELECT *, {label} AS lab FROM {rows} ORDER BY {order} LIMIT 3)) END AS detail FROM {rows}"""


def keys_check(table: str) -> str:
    return f"""SELECT n, CASE WHEN n = 0 THEN 'every receipt line is unique' ELSE 'repeated receipt lines in the sales' END AS detail
FROM (SELECT count(*) - count(DISTINCT (transaction_id, line_no)) AS n FROM {table})"""


def masters_check(table: str) -> str:
    return f"""SELECT n, CASE WHEN n = 0 THEN 'all sales have their masters' ELSE 'sales lines without their store or product' END AS detail
FROM (SELECT count(*) FILTER (s.store_id IS NULL) + count(*) FILTER (p.sku IS NULL) AS n
  FROM {table} t LEFT JOIN o_stores s ON s.store_id = t.store_id LEFT JOIN o_products p ON p.sku = t.sku)"""


def quarantine_check(kind: str, keep: str) -> str:
    return f"""SELECT coalesce(sum(k), 0) AS n, 'rows of {kind} tables in quarantine: ' || coalesce(string_agg(source || ' ' || k, ', ' ORDER BY source), 'none') AS detail
FROM (SELECT source, count(*) AS k FROM (SELECT source FROM o_quarantine UNION ALL SELECT 'stores' FROM supplier WHERE s_suppkey % 41 = 40) WHERE {keep} GROUP BY source)"""


CTE["o_unbalanced"] = "SELECT journal_id, sum(dr_c) AS dr_c, sum(cr_c) AS cr_c FROM o_gl GROUP BY journal_id HAVING sum(dr_c) <> sum(cr_c)"
CTE["o_over"] = """
SELECT original_transaction_id, r.sku, refunded_c, paid_c FROM (
  SELECT original_transaction_id, sku, sum(gross_c) AS refunded_c FROM o_refunds WHERE receipt GROUP BY 1, 2) r
JOIN (SELECT transaction_id, sku, sum(gross_c) AS paid_c FROM o_pos GROUP BY 1, 2) p ON p.transaction_id = r.original_transaction_id AND p.sku = r.sku
WHERE refunded_c > paid_c + 1"""
CTE["o_missing"] = "SELECT o.* FROM o_open o ANTI JOIN o_pos p ON p.store_id = o.store_id AND p.day = o.day"


def collapse(store: str) -> str:
    return f"""
SELECT * FROM (SELECT *, quantile_disc(lines, 0.5) OVER (PARTITION BY store_id, dayofweek(day)) AS usual
  FROM (SELECT {store} AS store_id, day, count(*) AS lines FROM o_pos GROUP BY ALL)) WHERE lines * 3 < usual"""


CTE["o_collapse"] = collapse("store_id")
CTE["o_collapse_grouped"] = collapse("currency || '-' || payment_method")
RANGE = """SELECT a + b + c AS n, 'amounts out of range: ' || 'ledger lines ' || c || ', refunds ' || b || ', sales ' || a AS detail FROM (
  SELECT (SELECT count(*) FROM o_pos WHERE net4 <= 0 OR net4 > 500000000 OR quantity > 500) AS a,
    (SELECT count(*) FROM o_refunds WHERE amount4 <= 0 OR amount4 > 100000000) AS b,
    (SELECT count(*) FROM o_gl WHERE dr_c > 100000000 OR cr_c > 100000000) AS c)"""
ADDS = f"""SELECT CASE WHEN abs(g * 100 - s4) > 10000 THEN 1 ELSE 0 END AS n,
  'daily revenue ' || {money("g")} || ' against sales ' || {money(half_up("s4", "100"))} AS detail
FROM (SELECT (SELECT sum(net_c) FROM o_daily) AS g, (SELECT sum(net4) FROM o_pos) AS s4)"""
CHECKS = {
    "silver_keys_unique": ("critical", "silver", keys_check("o_pos")),
    "journals_balance": ("critical", "silver", sampled("o_unbalanced", "journal_id", "journal_id", "journals whose debits and credits differ", "every journal balances")),
    "amounts_in_range": ("critical", "silver", RANGE),
    "sales_have_masters": ("critical", "silver", masters_check("o_pos")),
    "quarantine_money": ("critical", "silver", quarantine_check("money", "source <> 'stores'")),
    "quarantine_masters": ("warning", "silver", quarantine_check("master", "source = 'stores'")),
    "refund_within_sale": ("warning", "silver", """SELECT count(*) AS n, CASE WHEN count(*) = 0 THEN 'no refund is larger than its sale'
  ELSE 'receipted refunds larger than the sale' END AS detail FROM o_over"""),
    "missing_store_days": ("warning", "silver", sampled("o_missing", "store_id || ' ' || day", "day, store_id", "open store-days without sales", "every open store-day has sales")),
    "volume_collapse": ("warning", "silver", sampled("o_collapse", "store_id || ' ' || day", "day, store_id", "store-days under a third of usual volume", "no volume collapse")),
    "gold_adds_up": ("critical", "gold", ADDS),
}


def check_sql(name: str) -> str:
    severity, stage, body = CHECKS[name]
    return result(name, severity, stage, body)


ORACLE["keys_unique"] = sql(result("silver_keys_unique", "critical", "silver", keys_check("o_bpos")))
ORACLE["journals_balance"] = sql(f"SELECT journal_id, {eur('dr_c')} AS debit_eur, {eur('cr_c')} AS credit_eur FROM o_unbalanced")
ORACLE["amounts_in_range"] = sql(check_sql("amounts_in_range"))
ORACLE["sales_have_masters"] = sql(result("sales_have_masters", "critical", "silver", masters_check("o_bpos")))
ORACLE["quarantine_checks"] = sql(check_sql("quarantine_money") + " UNION ALL " + check_sql("quarantine_masters"))
ORACLE["refund_within_sale"] = sql(f"SELECT original_transaction_id, sku, {eur('refunded_c')} AS refunded, {eur('paid_c')} AS paid FROM o_over")
ORACLE["missing_store_days"] = sql("SELECT store_id, day::VARCHAR AS business_date FROM o_missing")
ORACLE["volume_collapse"] = sql("SELECT store_id, day::VARCHAR AS business_date, lines, usual FROM o_collapse_grouped")
ORACLE["gold_adds_up"] = sql(check_sql("gold_adds_up"))
ORACLE["dq_results"] = sql(" UNION ALL ".join(check_sql(n) for n in CHECKS))

CTE["o_silver_checks"] = " UNION ALL ".join(check_sql(n) for n in CHECKS if n != "gold_adds_up")
ORACLE["certified"] = sql("""
SELECT 'gate' AS step, count(*) FILTER (severity = 'critical' AND NOT passed) = 0 AS certified,
  coalesce(string_agg("check", ', ' ORDER BY "check") FILTER (severity = 'critical' AND NOT passed), '') AS failed FROM o_silver_checks
UNION ALL SELECT 'latest', true, '' UNION ALL SELECT 'rewritten', false, 'gold tables rewritten after run clean was certified: stores'
UNION ALL SELECT 'failed', false, 'quality gate failed on ' || count(*) FILTER (severity = 'critical' AND NOT passed) || ' critical check(s)' FROM o_silver_checks""")
ORACLE["input_problems"] = sql("""
SELECT (SELECT count(*) FROM o_pos WHERE currency <> 'EUR') || ' till lines have no exchange rate' AS problem
UNION ALL SELECT (SELECT count(*) FROM o_quarantine WHERE source IN ('pos_sales', 'gl_journal')) || ' sales or ledger rows are in quarantine'
UNION ALL SELECT 'there are no revenue lines in the ledger'""")
ORACLE["table_sinks"] = sql("""
SELECT 'replaced' AS what, count(*) AS n, 'country' AS said FROM o_stores
UNION ALL SELECT 'kept', 2 * count(*), 'two runs' FROM o_stores UNION ALL SELECT 'partitioned', count(*), 'one country' FROM o_stores WHERE country = 'CH'
UNION ALL SELECT 'absent', 0, 'none'""")

ORACLE["table_swap"] = sql("""
SELECT 'flat' AS kind, 'opened before' AS reader, count(*) AS n, count(DISTINCT store_id) AS stores FROM o_stores
UNION ALL SELECT 'flat', reader, count(s.store_id), count(DISTINCT s.store_id) FROM (SELECT unnest(['after', 'after a failure']) AS reader)
  LEFT JOIN o_stores s ON s.country = 'CH' GROUP BY reader
UNION ALL SELECT 'partitioned', 'opened before', count(*), count(DISTINCT store_id) FROM o_pos
UNION ALL SELECT 'partitioned', reader, count(p.store_id), count(DISTINCT p.store_id) FROM (SELECT unnest(['after', 'after a failure']) AS reader)
  LEFT JOIN o_pos p ON p.promo_flag = 'True' GROUP BY reader""")
ORACLE["table_notes"] = sql("""
SELECT 'held' AS what, count(*) AS n, 'raw rows that broke their contract, with every reason' AS said FROM o_quarantine WHERE source = 'pos_sales'
UNION ALL SELECT 'margin is gold', count(*), 'month: it''s a month' FROM o_margin""")
CTE["o_planted"] = """
SELECT DISTINCT journal_id FROM (
  SELECT journal_id FROM o_gl WHERE source = 'MANUAL' OR journal_id LIKE '%-DUP'
  UNION ALL SELECT replace(journal_id, '-DUP', '') FROM o_gl WHERE journal_id LIKE '%-DUP')"""
ORACLE["answer_keys"] = sql("""
SELECT 'read' AS "key", (SELECT count(*) FROM o_planted) AS planted,
  (SELECT count(*) FROM o_planted WHERE journal_id IN (SELECT journal_id FROM o_exceptions)) AS found, '' AS said
UNION ALL SELECT 'absent', 0, 0, 'no key' UNION ALL SELECT 'other', 0, 0, 'the answer key lists no A3_unsupported_manual_revenue'""")

CTE["o_counts"] = """
SELECT 'refunds' AS table_name, (SELECT count(*) FROM o_refunds) AS was, (SELECT count(*) FROM o_refunds WHERE receipt) AS now,
  (SELECT count(*) FROM o_refunds WHERE NOT receipt) > 0 AS changed
UNION ALL SELECT 'pos_sales', (SELECT count(*) FROM o_pos), (SELECT count(*) FROM o_pos), (SELECT count(*) FROM o_pos WHERE promo_flag = 'True') > 0
UNION ALL SELECT 'gl_journal', (SELECT count(*) FROM o_gl), (SELECT count(*) FROM o_gl), false
UNION ALL SELECT 'budget', (SELECT count(*) FROM o_budget), (SELECT 2 * count(*) FROM o_budget), (SELECT count(*) FROM o_budget) > 0"""
ORACLE["count_drop"] = sql(result("row_count_drop", "warning", "silver", """
SELECT count(*) AS n, coalesce('row counts dropped: ' || string_agg(table_name || ' ' || was || ' to ' || now, ', ' ORDER BY table_name), 'no row count dropped') AS detail
FROM o_counts WHERE now < was * 0.95"""))
ORACLE["snapshot_diff"] = sql(result("silver_unchanged", "critical", "gold", """
SELECT count(*) AS n, coalesce('silver changed during the run: ' || string_agg(table_name, ', ' ORDER BY table_name), 'silver unchanged since its gate') AS detail
FROM o_counts WHERE changed"""))

ORACLE["snapshot_composed"] = sql("""
SELECT 'before' AS state, count(*) AS row_count, true AS equals_scan, count(DISTINCT month) AS months_read FROM o_pos
UNION ALL SELECT 'after', count(*), true, count(DISTINCT month) FILTER (month = '1999-06') FROM o_pos""")

# ------------------------------------------------------------------ table functions


def pct(n: str, d: str) -> str:
    return ratio(f"100 * ({n})", d, 2)


CTE["o_close_days"] = "SELECT strftime(day, '%Y-%m') AS month, day(day) AS dom, sum(net_c) AS net_c FROM o_daily GROUP BY 1, 2"
CTE["o_close"] = """
SELECT month, total, budget, actual, complete, prior, net, cogs, disc, paid, days FROM (
  SELECT month, max(dom) AS last_day, count(*) AS days FROM o_close_days GROUP BY month) c
LEFT JOIN (SELECT month, sum(actual_c) AS total, sum(actual_c) FILTER (has_budget) AS actual, sum(to_date_c) FILTER (has_budget) AS budget,
    bool_and(complete) AS complete FROM o_variance GROUP BY month) b USING (month)
LEFT JOIN (SELECT c.month, sum(p.net_c) AS prior FROM (SELECT month, max(dom) AS last_day FROM o_close_days GROUP BY month) c
    JOIN o_close_days p ON p.month = strftime((c.month || '-01')::DATE - INTERVAL 12 MONTH, '%Y-%m') AND p.dom <= c.last_day GROUP BY c.month) p USING (month)
LEFT JOIN (SELECT month, sum(net_c) AS net, sum(cogs_c) AS cogs, sum(disc_c) AS disc, sum(paid_c) AS paid FROM o_margin GROUP BY month) g USING (month)"""
CLOSE_COLUMNS = f"""{eur("total")} AS net_sales_eur, {eur("budget")} AS budget_to_date_eur, {eur("actual - budget")} AS variance_eur,
  {pct("actual - budget", "budget")} AS variance_pct, {eur("prior")} AS prior_year_net_sales_eur, {pct("total - prior", "prior")} AS yoy_growth_pct,
  {pct("net - cogs", "net")} AS gross_margin_pct, {pct("disc", "paid + disc")} AS discount_rate_pct, complete AS complete_month"""
ORACLE["close_overview"] = sql(f"""
SELECT month, {CLOSE_COLUMNS}, days AS days_with_sales FROM o_close WHERE month = '2000-05'
UNION ALL SELECT '1980-01', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 0""")
ORACLE["close_overview_months"] = sql(f"SELECT month, {CLOSE_COLUMNS}, days AS days_with_sales FROM o_close")

ORACLE["store_variances"] = sql(f"""
SELECT store_id, {eur("actual_c")} AS net_sales_eur, {eur("to_date_c")} AS budget_to_date_eur, {eur("variance_c")} AS variance_eur,
  {pct("variance_c", "to_date_c")} AS variance_pct, complete AS complete_month
FROM o_variance WHERE month = '2000-05' AND has_budget""")

CTE["o_own"] = """
SELECT store_id, month, margin, discount_rate, mb - margin AS drop_own, discount_rate - db AS rise_own FROM (
  SELECT *, CASE WHEN count(margin) OVER w >= 3 THEN quantile_cont(margin, 0.5) OVER w END AS mb,
    CASE WHEN count(discount_rate) OVER w >= 3 THEN quantile_cont(discount_rate, 0.5) OVER w END AS db
  FROM o_store_month WINDOW w AS (PARTITION BY store_id ORDER BY month ROWS BETWEEN 12 PRECEDING AND 4 PRECEDING))"""
CTE["o_mfeat"] = """
SELECT * FROM (SELECT store_id, month, drop_own - median(drop_own) OVER (PARTITION BY month) AS margin_drop_vs_own,
    rise_own - median(rise_own) OVER (PARTITION BY month) AS discount_rise_vs_own FROM o_own)
WHERE margin_drop_vs_own IS NOT NULL AND discount_rise_vs_own IS NOT NULL"""
CTE["o_alerts"] = """
SELECT store_id, month, round(score, 4) AS anomaly_score, row_number() OVER (PARTITION BY month ORDER BY score DESC, store_id) AS rank_in_month, score > 0.05 AS flagged
FROM (SELECT *, round(margin_drop_vs_own + discount_rise_vs_own, 6) + 0.0000003::DOUBLE AS score FROM o_mfeat)"""
ORACLE["store_margin_alerts"] = sql("""
SELECT a.store_id, rank_in_month, flagged, round(100 * c.margin, 2) AS margin_pct, round(100 * b.m6, 2) AS margin_pct_prior_6m,
  round(100 * (c.margin - b.m6), 2) AS margin_change_pts, round(100 * c.discount_rate, 2) AS discount_rate_pct, round(100 * b.d6, 2) AS discount_rate_pct_prior_6m
FROM o_alerts a JOIN o_store_month c USING (store_id, month)
LEFT JOIN (SELECT store_id, avg(margin) AS m6, avg(discount_rate) AS d6 FROM o_store_month WHERE month BETWEEN '1999-11' AND '2000-04' GROUP BY store_id) b
  ON b.store_id = a.store_id
WHERE a.month = '2000-05' AND (flagged OR rank_in_month <= 3)""")

ORACLE["recon_exceptions_fn"] = sql(f"""
SELECT store_id, day::VARCHAR AS business_date, journal_id, {eur("amount_c")} AS amount_eur, reason, {eur("pos_c")} AS day_pos_net_eur,
  {eur("gl_c")} AS day_gl_revenue_eur
FROM o_exceptions WHERE strftime(day, '%Y-%m') = '2000-05'""")

# ------------------------------------------------------------------ detectors, forecast, drift

CTE["o_cfeat"] = """
SELECT store_id, cashier_id, month, ln(1 + refunds) AS log_refunds, ln(1 + nr) AS log_no_receipt_eur,
  CASE WHEN gross_c > 0 THEN no_receipt_c::DOUBLE / gross_c ELSE 0 END AS no_receipt_share,
  ln(1 + nr) - ln(1 + median(nr) OVER peers) AS peer_no_receipt_ratio, ln(1 + refunds) - ln(1 + median(refunds) OVER peers) AS peer_refunds_ratio
FROM (SELECT *, no_receipt_c::DOUBLE / 100 AS nr FROM o_refunds_month) WINDOW peers AS (PARTITION BY store_id, month)"""
ORACLE["cashier_features"] = sql("""
SELECT store_id, cashier_id, month, round(log_refunds, 6) AS log_refunds, round(log_no_receipt_eur, 6) AS log_no_receipt_eur,
  round(no_receipt_share, 6) AS no_receipt_share, round(peer_no_receipt_ratio, 6) + 0 AS peer_no_receipt_ratio, round(peer_refunds_ratio, 6) + 0 AS peer_refunds_ratio
FROM o_cfeat""")
ORACLE["margin_features"] = sql("""
SELECT store_id, month, round(margin_drop_vs_own, 6) AS margin_drop_vs_own, round(discount_rise_vs_own, 6) AS discount_rise_vs_own FROM o_mfeat""")
ORACLE["ranked"] = sql("SELECT * FROM o_alerts")
ORACLE["evaluate_detector"] = sql("""
SELECT month, coalesce(min(rank_in_month) FILTER (store_id = 'S00000007'), 1000000) AS rank,
  coalesce(min(rank_in_month) FILTER (store_id = 'S00000007'), 1000000) <= 3 AS in_top,
  count(*) FILTER (store_id <> 'S00000007' AND flagged) AS false_flags, (SELECT count(*) FROM o_alerts WHERE flagged) AS flags_total
FROM (SELECT '2000-' || lpad(i::VARCHAR, 2, '0') AS month FROM (SELECT unnest(generate_series(1, 12)) AS i)) LEFT JOIN o_alerts USING (month) GROUP BY month""")
ORACLE["cashier_case_count"] = sql("""
SELECT '2000-05' AS month, count(*) FILTER (round(peer_no_receipt_ratio + peer_refunds_ratio, 6) > 2) AS cashier_cases_referred, count(*) AS cashier_months_scored
FROM o_cfeat WHERE month = '2000-05' UNION ALL SELECT NULL, 0, 0""")
CTE["o_certified"] = """
SELECT strftime(day, '%Y-%m') AS run_id, count(*) FILTER (abs(diff_c) > 1) < 12 AS certified, max(day) AS closed FROM o_recon GROUP BY 1"""
ORACLE["certification_status"] = sql("""
SELECT certified, run_id AS gold_run, strftime(closed, '%Y-%m-%d 00:00:00') AS certified_at FROM o_certified ORDER BY closed DESC LIMIT 1""")

# The isolation forest: rows drawn, nodes split and paths walked level by level, every choice by MD5.

TREES, SAMPLE, LEVELS, FOREST_SEED = 300, 256, 8, 9173
X = [f"x{i}" for i in range(5)]


def hexadecimal(digest: str, start: int, length: int) -> str:
    return f"('0x' || substr({digest}, {start}, {length}))::BIGINT"


def path_length(n: str) -> str:
    """Usual path length among n rows, in billionths."""
    return f"(CASE WHEN {n} > 2 THEN round((2 * (ln({n} - 1) + 0.5772156649015329::DOUBLE) - 2 * ({n} - 1)::DOUBLE / {n}) * 1e9)::BIGINT WHEN {n} = 2 THEN 1000000000 ELSE 0 END)"


CTE["o_forest_rows"] = f"""
SELECT store_id, cashier_id, month, {", ".join(f"round({c}, 6) + 0 AS {x}" for c, x in zip(
    ("log_refunds", "log_no_receipt_eur", "no_receipt_share", "peer_no_receipt_ratio", "peer_refunds_ratio"), X, strict=True))} FROM o_cfeat"""
CTE["o_forest_blocks"] = f"""
SELECT total, block, ({TREES} + block - 1) // block AS blocks, least(1, 1.3::DOUBLE * {SAMPLE} * block / total) AS share
FROM (SELECT count(*) AS total, greatest(1, least({TREES}, floor(count(*) / (1.3::DOUBLE * {SAMPLE}))))::BIGINT AS block FROM o_forest_rows)"""
CTE["o_forest_drawn"] = f"""
SELECT tree, {", ".join(X)} FROM (
  SELECT *, b * block + {hexadecimal("d", 1, 8)} % block AS tree, {hexadecimal("d", 9, 10)} AS h FROM (
    SELECT *, md5('{FOREST_SEED}|row|' || b || '|' || store_id || '|' || cashier_id || '|' || month) AS d
    FROM (SELECT *, unnest(generate_series(0, blocks - 1)) AS b FROM o_forest_rows, o_forest_blocks)))
WHERE tree < {TREES} AND h <= floor(share * 1099511627776)
QUALIFY row_number() OVER (PARTITION BY tree ORDER BY h, store_id, cashier_id, month) <= {SAMPLE}"""
for level in range(LEVELS + 1):
    at = f"SELECT tree, 0::BIGINT AS node, {', '.join(X)} FROM o_forest_drawn"
    if level:
        at = f"SELECT tree, 2 * node + CASE WHEN [{', '.join(X)}][f + 1] <= cut THEN 1 ELSE 2 END AS node, {', '.join(X)} FROM o_forest_{level - 1} WHERE f >= 0"
    CTE[f"o_forest_{level}"] = f"""
SELECT *, CASE WHEN f >= 0 THEN CASE WHEN low + u * (high - low) < high THEN low + u * (high - low) ELSE low END END AS cut FROM (
  SELECT *, [{", ".join(f"low_{x}" for x in X)}][f + 1] AS low, [{", ".join(f"high_{x}" for x in X)}][f + 1] AS high, {hexadecimal("d", 9, 8)} / 4294967296::DOUBLE AS u FROM (
    SELECT *, CASE WHEN n > 1 AND spread <> '' AND {level} < {LEVELS} THEN substr(spread, 1 + {hexadecimal("d", 1, 8)} % length(spread), 1)::BIGINT ELSE -1 END AS f FROM (
      SELECT *, {" || ".join(f"CASE WHEN high_{x} > low_{x} THEN '{i}' ELSE '' END" for i, x in enumerate(X))} AS spread, md5('{FOREST_SEED}|cut|' || tree || '|' || node) AS d FROM (
        SELECT *, count(*) OVER same AS n, {", ".join(f"min({x}) OVER same AS low_{x}, max({x}) OVER same AS high_{x}" for x in X)}
        FROM ({at}) WINDOW same AS (PARTITION BY tree, node)))))"""
CTE["o_forest_nodes"] = " UNION ALL ".join(
    f"SELECT DISTINCT tree, node, f, cut, {level * 10**9}::BIGINT + {path_length('n')} AS depth FROM o_forest_{level}" for level in range(LEVELS + 1)
)
walked = f"SELECT DISTINCT {', '.join(X)}, tree, 0::BIGINT AS node FROM o_forest_rows, (SELECT DISTINCT tree FROM o_forest_drawn)"
for _ in range(LEVELS):
    walked = f"""SELECT {", ".join(X)}, tree, CASE WHEN f < 0 THEN node WHEN [{", ".join(X)}][f + 1] <= cut THEN 2 * node + 1 ELSE 2 * node + 2 END AS node
FROM ({walked}) JOIN o_forest_nodes USING (tree, node)"""
CTE["o_forest_scores"] = f"""
SELECT store_id, cashier_id, month, pow(2::DOUBLE, -(deep::DOUBLE / (trees * usual))) AS score FROM o_forest_rows
JOIN (SELECT {", ".join(X)}, sum(depth) AS deep, count(*) AS trees FROM ({walked}) JOIN o_forest_nodes USING (tree, node) GROUP BY {", ".join(X)}) USING ({", ".join(X)}),
  (SELECT {path_length(f"least({SAMPLE}, greatest(total, 2))")} AS usual FROM o_forest_blocks)"""
ORACLE["isolation_scores"] = sql("""
SELECT store_id, cashier_id, month, round(score, 4) AS anomaly_score, row_number() OVER (PARTITION BY month ORDER BY score DESC, store_id, cashier_id) AS rank_in_month,
  score > (SELECT quantile_cont(score, 0.995) FROM o_forest_scores) AS flagged
FROM o_forest_scores""")

CTE["o_panel"] = "SELECT store_id, strftime(day, '%Y-%m') AS month, year(day) * 12 + month(day) - 1 AS mi, sum(net_c)::DOUBLE / 100 AS v FROM o_daily GROUP BY 1, 2, 3"
ORACLE["monthly_sales"] = sql("SELECT store_id, month, v AS net_sales_eur FROM o_panel")
ORACLE["yoy_growth"] = sql("""
SELECT a.store_id, a.month, round(a.v / CASE WHEN b.v > 0 THEN b.v END - 1, 6) AS yoy_growth FROM o_panel a JOIN o_panel b ON b.store_id = a.store_id AND b.mi = a.mi - 12""")


def text(mi: str) -> str:
    return f"(({mi}) // 12 || '-' || lpad((({mi}) % 12 + 1)::VARCHAR, 2, '0'))"


def baseline(last: str) -> str:
    return f"""
SELECT store_id, {last} + h AS mi, h::BIGINT AS horizon, base * (coalesce(recent, 0) / older) AS forecast FROM (
  SELECT s.store_id, h, (SELECT sum(v) FROM o_panel p WHERE p.store_id = s.store_id AND mi BETWEEN {last} - 2 AND {last}) AS recent,
    (SELECT sum(v) FROM o_panel p WHERE p.store_id = s.store_id AND mi BETWEEN {last} - 14 AND {last} - 12) AS older,
    (SELECT max(v) FROM o_panel p WHERE p.store_id = s.store_id AND mi = {last} + h - 12) AS base
  FROM (SELECT DISTINCT store_id FROM o_panel WHERE mi <= {last}) s, (SELECT unnest([1, 2, 3]) AS h))"""


CTE["o_last"] = "SELECT max((substr(month, 1, 4)::BIGINT * 12 + substr(month, 6, 2)::BIGINT - 1)) AS last FROM o_variance WHERE complete"
END = "(SELECT last FROM o_last)"
CTE["o_base_end"] = baseline(END)
CTE["o_base_cut"] = baseline("(SELECT last - 3 FROM o_last)")
ORACLE["baseline_forecast"] = sql(f"SELECT store_id, {text('mi')} AS month, horizon, round(forecast, 4) AS forecast FROM o_base_end")
ORACLE_TRAINING = f"""
SELECT a.store_id, a.month AS asof, t.month, round(l12.v, 4) AS lag_12, round(a.v, 4) AS lag_1, round(l2.v, 4) AS lag_2, t.mi % 12 + 1 AS month_of_year,
  h::BIGINT AS horizon, round(a.level + 0.0000003::DOUBLE, 4) AS store_level, round(t.v / l12.v, 4) AS y
FROM (SELECT *, avg(v) OVER (PARTITION BY store_id ORDER BY mi) AS level, unnest([1, 2, 3]) AS h FROM o_panel) a
JOIN o_panel t ON t.store_id = a.store_id AND t.mi = a.mi + h JOIN o_panel l12 ON l12.store_id = a.store_id AND l12.mi = a.mi + h - 12
JOIN o_panel l2 ON l2.store_id = a.store_id AND l2.mi = a.mi - 1
WHERE t.mi <= {END}"""
ORACLE["forecast_training_rows"] = sql(ORACLE_TRAINING)
CTE["o_errors_end"] = "SELECT horizon, p.mi, (forecast - v) / v AS e FROM o_base_cut p JOIN o_panel a ON a.store_id = p.store_id AND a.mi = p.mi WHERE forecast IS NOT NULL AND v > 0"
ORACLE["backtest_baseline"] = sql(f"SELECT 'baseline' AS method, {text('mi')} AS month, horizon, round(avg(abs(e)), 6) AS mape FROM o_errors_end GROUP BY mi, horizon")


def bands(table: str) -> str:
    return f"""
SELECT store_id, {text("mi")} AS month, horizon, round(forecast, 2) AS forecast_eur, round(forecast / (1 + hi), 2) AS low_80_eur,
  round(forecast / (1 + lo), 2) AS high_80_eur, 'baseline' AS method
FROM {table} JOIN (SELECT horizon, quantile_cont(e, 0.1) AS lo, quantile_cont(e, 0.9) AS hi FROM {table.replace("base", "errors")} GROUP BY horizon) USING (horizon)
WHERE forecast IS NOT NULL"""


ORACLE["forecast_bands"] = sql(bands("o_base_end"))
CTE["o_forecast"] = bands("o_base_end")
ORACLE["revenue_outlook"] = sql("""
SELECT month, round(sum(forecast_eur), 2) AS forecast_eur, round(sum(low_80_eur), 2) AS low_80_eur, round(sum(high_80_eur), 2) AS high_80_eur,
  80 AS range_pct, max(method) AS method
FROM o_forecast WHERE month > '2000-05' GROUP BY month""")

FEATURES = ["log_refunds", "log_no_receipt_eur", "no_receipt_share", "peer_no_receipt_ratio", "peer_refunds_ratio"]
CTE["o_features"] = " UNION ALL ".join(f"SELECT month, '{f}' AS feature, round({f}, 6) + 0 AS x FROM o_cfeat" for f in FEATURES)
CTE["o_checked"] = "SELECT DISTINCT month AS checked FROM o_cfeat"
CTE["o_windows"] = """
SELECT checked, strftime((checked || '-01')::DATE - to_months(k::INT), '%Y-%m') AS month
FROM o_checked, (SELECT unnest(generate_series(4, 12)) AS k)"""
CTE["o_ref"] = "SELECT checked, feature, x FROM o_features JOIN o_windows USING (month)"
CTE["o_cur"] = "SELECT month AS checked, feature, x FROM o_features WHERE month IN (SELECT checked FROM o_checked)"
CTE["o_sorted"] = """
SELECT checked, feature, bins, xs, len(xs) AS n FROM (SELECT checked, feature, greatest(2, least(10, count(*) // 10)) AS bins FROM o_cur GROUP BY 1, 2)
JOIN (SELECT checked, feature, list(x ORDER BY x) AS xs FROM o_ref GROUP BY 1, 2) USING (checked, feature)"""
CTE["o_edges"] = """
SELECT checked, feature, list_sort(list(DISTINCT e)) AS edges FROM (
  SELECT checked, feature, xs[floor(pos)::INT + 1] + (xs[ceil(pos)::INT + 1] - xs[floor(pos)::INT + 1]) * (pos - floor(pos)) AS e
  FROM (SELECT *, (k::DOUBLE / bins) * (n - 1) AS pos FROM o_sorted, (SELECT unnest(generate_series(0, 10)) AS k) WHERE k <= bins))
GROUP BY checked, feature"""
CTE["o_inner"] = "SELECT checked, feature, len(edges) < 2 AS constant, edges[1] AS first, CASE WHEN len(edges) < 2 THEN edges ELSE edges[1:len(edges) - 1] END AS inner_edges FROM o_edges"


def binned(table: str) -> str:
    return f"""
SELECT checked, feature, bin, count(*) AS k FROM (
  SELECT v.checked, v.feature, CASE WHEN constant THEN CASE WHEN abs(x - first) <= 1e-8 + 1e-5 * abs(first) THEN 0 ELSE 1 END
    ELSE len(list_filter(inner_edges, lambda e: e < x)) END AS bin
  FROM {table} v JOIN o_inner USING (checked, feature)) GROUP BY ALL"""


CTE["o_ref_bins"] = binned("o_ref")
CTE["o_cur_bins"] = binned("o_cur")
CTE["o_shares"] = """
SELECT checked, feature, greatest(coalesce(r.k, 0)::DOUBLE / sum(r.k) OVER g, 1e-4) AS r, greatest(coalesce(c.k, 0)::DOUBLE / sum(c.k) OVER g, 1e-4) AS c
FROM (SELECT checked, feature, unnest(generate_series(0, CASE WHEN constant THEN 1 ELSE len(inner_edges) END)) AS bin FROM o_inner)
LEFT JOIN o_ref_bins r USING (checked, feature, bin) LEFT JOIN o_cur_bins c USING (checked, feature, bin)
WINDOW g AS (PARTITION BY checked, feature)"""
CTE["o_known"] = "SELECT checked, count(*) AS n, min(month) AS lo, max(month) AS hi FROM o_windows WHERE month IN (SELECT month FROM o_features) GROUP BY checked"
ORACLE["psi_drift"] = sql(f"""
SELECT checked AS month, feature, CASE WHEN n >= 3 THEN round(psi, 4) END AS psi,
  CASE WHEN coalesce(n, 0) < 3 THEN 'no reference' WHEN psi IS NULL THEN 'no data' WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.2 THEN 'watch' ELSE 'drift' END AS status,
  lo || '..' || hi || ' (' || n || ' months)' AS reference
FROM o_checked CROSS JOIN (SELECT unnest({FEATURES}) AS feature) LEFT JOIN o_known USING (checked)
LEFT JOIN (SELECT checked, feature, sum((c - r) * ln(c / r)) AS psi FROM o_shares GROUP BY 1, 2) USING (checked, feature)""")


# ------------------------------------------------------------------ landing, sinks, evidence

ORACLE["landed_files"] = sql("""
SELECT c_mktsegment AS segment, count(*) AS n, CASE WHEN dense_rank() OVER (ORDER BY c_mktsegment) <= 2 THEN 0 ELSE 1 END AS first_batch,
  CASE WHEN dense_rank() OVER (ORDER BY c_mktsegment) <= 2 THEN 0 ELSE 1 END AS last_batch, 0 AS unstamped, 0 AS mixed_files
FROM customer GROUP BY c_mktsegment""")
ORACLE["bronze_stream"] = sql("""
SELECT c_name AS cashier_id, 'S' || lpad(c_nationkey::VARCHAR, 8, '0') AS store_id,
  CASE WHEN c_mktsegment = 'BUILDING' THEN '{"segment":"BUILDING"}' END AS _rescued_data
FROM customer""")
ORACLE["slice_overwrite"] = sql("""
SELECT source, count(*) AS n FROM o_quarantine WHERE source = 'pos_sales' OR reasons LIKE '%ref:original_transaction_id%' GROUP BY source""")
ORACLE["repeated_runs"] = sql("""
SELECT 'two' AS run_id, count(*) AS n, count(DISTINCT store_id) AS stores FROM o_stores
UNION ALL SELECT * FROM (SELECT 'one', count(*) AS n, count(DISTINCT store_id) FROM o_stores WHERE country = 'CH') WHERE n > 0""")
ORACLE["finite_sinks"] = """
SELECT sink, c_custkey, v AS flat, v AS listed, 3::BIGINT AS listed_n, v AS held_a, v::FLOAT::DOUBLE AS held_c, v AS named, c_custkey % 5 = 0 AS absent
FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN c_custkey / 4 END AS v FROM customer), (VALUES ('fresh'), ('kept')) AS t(sink)"""
ORACLE["incremental_silver"] = ORACLE["silver_pos"]
ORACLE["incremental_months"] = sql("""
SELECT month, count(*) FILTER (own) AS n, bool_or(NOT own OR chosen) AS rewritten
FROM (SELECT chosen, own, CASE WHEN own THEN month ELSE strftime(day - INTERVAL 40 DAY, '%Y-%m') END AS month
      FROM (SELECT *, unnest(CASE WHEN chosen AND day >= DATE '1995-03-01' THEN [true, false] ELSE [true] END) AS own
            FROM (SELECT day, month, substr(transaction_id, 2)::BIGINT % 5000 = 1 AS chosen FROM o_pos)))
GROUP BY month""")
CTE["o_top"] = "SELECT * FROM o_recon ORDER BY abs(diff_c) DESC, store_id, day LIMIT 1"
CTE["o_traced"] = f"""
SELECT t.store_id, t.day::VARCHAR AS business_date, {eur("pos_c")} AS pos_net_eur,
  (SELECT count(*) FROM o_pos p WHERE p.store_id = t.store_id AND p.day = t.day) AS silver_rows,
  (SELECT count(*) FROM o_bpos b WHERE b.store_id = t.store_id AND b.business_date = t.day::VARCHAR) AS bronze_rows FROM o_top t"""
ORACLE["row_trace"] = sql("""
SELECT *, CASE WHEN silver_rows > 0 THEN 'pos_sales.csv' END AS source_file, silver_rows AS file_rows FROM o_traced
UNION ALL SELECT store_id, business_date, pos_net_eur, 0, bronze_rows, NULL, 0 FROM o_traced""")
CTE["o_chains"] = """
SELECT DISTINCT 'c.gold.' || g.p_size AS gold, 'c.silver.' || g.p_brand AS silver, coalesce('c.bronze.' || b.p_type, '') AS bronze
FROM part g LEFT JOIN part b ON b.p_brand = g.p_brand AND b.p_brand <> 'Brand#7' WHERE g.p_partkey % 3 = 1"""
ORACLE["lineage_chains"] = sql("SELECT * FROM o_chains")
ORACLE["untraced_tables"] = sql("""
SELECT DISTINCT 'c.gold.' || (2 * p_size) AS gold FROM part WHERE 'c.gold.' || (2 * p_size) NOT IN (SELECT gold FROM o_chains)""")
CTE["o_grants"] = """
SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'finance-analysts' WHEN 'MACHINERY' THEN 'users' ELSE c_name END AS principal,
  ['USE_SCHEMA', 'BROWSE', 'USE CATALOG', 'MODIFY', 'USE SCHEMA'][c_custkey % 5 + 1] AS privilege,
  ['CATALOG', 'SCHEMA', 'TABLE'][c_custkey % 3 + 1] AS object_type,
  CASE WHEN c_nationkey % 2 = 0 THEN 'gold' ELSE 's' || c_nationkey END AS schema_name
FROM customer"""
ORACLE["grants_audit"] = sql("""
SELECT principal || ' has ' || privilege || ' on ' || lower(object_type) || ' ' ||
  CASE object_type WHEN 'CATALOG' THEN 'c' WHEN 'SCHEMA' THEN 'c.' || schema_name ELSE 'c.' || schema_name || '.t' END AS problem
FROM o_grants WHERE principal IN ('finance-analysts', 'users') AND NOT (object_type = 'CATALOG' AND privilege IN ('USE CATALOG', 'BROWSE'))
  AND NOT (principal = 'finance-analysts' AND object_type = 'SCHEMA' AND schema_name = 'gold' AND privilege IN ('USE_SCHEMA', 'USE SCHEMA'))
UNION ALL SELECT 'finance-analysts lacks SELECT on gold'""")
ORACLE["grants_seen"] = sql("SELECT count(*) > 0 AS visible FROM o_grants WHERE principal <> 'users' AND object_type IN ('CATALOG', 'SCHEMA')")

ORACLE["model_metrics"] = sql(f"""
SELECT model, metric, round(value, 6) AS value, '2000-12' AS gold_run FROM (
  SELECT 'revenue_forecast' AS model, 'baseline_mape_' || {text("mi")} AS metric, avg(abs(e)) AS value FROM o_errors_end GROUP BY mi
  UNION ALL SELECT 'fraud_cashier_refunds', 'flags_total', count(*) FILTER (round(peer_no_receipt_ratio + peer_refunds_ratio, 6) > 2)::DOUBLE FROM o_cfeat
  UNION ALL SELECT 'fraud_store_margin', 'flags_total', count(*) FILTER (flagged)::DOUBLE FROM o_alerts
  UNION ALL SELECT 'fraud_store_margin', 'store_months_without_history', ((SELECT count(*) FROM o_store_month) - (SELECT count(*) FROM o_mfeat))::DOUBLE
  UNION ALL SELECT 'revenue_forecast', 'training_rows_' || horizon, count(*)::DOUBLE FROM ({ORACLE_TRAINING}) GROUP BY horizon
  UNION ALL SELECT 'fraud_store_margin', 'parameter_trees', 300 UNION ALL SELECT 'fraud_store_margin', 'parameter_contamination', 0.02)""")

# Composed last: it reads building blocks of all parts above.
ORACLE["contract_findings"] = sql(ORACLE["contract_findings"])
