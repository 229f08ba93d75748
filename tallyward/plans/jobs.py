"""The batch jobs: landing files -> raw -> silver -> certified gold -> model tables.

Each job reads and writes tables only; every transformation is an operator that is tested on its
own.  What several steps share is stored once and read back, so a lost executor costs at most one
step and nothing is computed twice.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.contracts import CONTRACTS
from tallyward.functions import table_functions
from tallyward.operators import detectors, drift, evidence, forecasting, forest, incremental, marts, quality, rates, reconcile, run_metrics, validation
from tallyward.sources import tables
from tallyward.streaming import landing

GOLD = ("daily_revenue", "margin", "refunds", "budget_variance")
RECONCILED = ("recon_gl_pos", "recon_gl_pos_monthly", "recon_exceptions")
SNAPSHOT = ("pos_sales", "refunds", "gl_journal", "budget", "stores", "products", "fx_daily")
FACTS = ("pos_sales", "refunds")  # partitioned by month
MASTERS = ("stores", "products", "cashiers")  # what facts refer to
CHECKED_MONTHS = 6
# The planted anomalies of the detectors in an answer key, and the column that names their entity.
PLANTED = {"fraud_scores": ("A1_no_receipt_refunds", "cashier_id"), "margin_alerts": ("A2_discount_creep", "store_id")}

@dataclass(frozen=True)
class Workspace:
    """Where a deployment keeps its files and tables."""

    spark: SparkSession
    root: str
    prefix: str = "retail"
    reads: list[str] = field(default_factory=list, compare=False)  # tables read by the step under way

    def create(self) -> Workspace:
        for layer in ("silver", "gold", "ops"):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}_{layer} LOCATION '{self.root}/{layer}'")
        tables.create_quarantine(self.spark, self.name("silver", "quarantine"))
        return self

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}_{layer}.{table}"

    def table(self, layer: str, table: str) -> DataFrame:
        """A table without the column that tells the slices of a history apart."""
        df = self.spark.table(self.name(layer, table))
        return df.drop(tables.SLICE) if tables.SLICE in df.columns else df

    def full(self, layer: str, table: str) -> str:
        return f"{self.prefix}.{layer}.{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        """A table as input of the step under way."""
        self.reads.append(self.full(layer, table))
        return self.table(layer, table)

    def begin(self) -> None:
        """Start a step: what is published from now on comes from what is read from now on."""
        self.reads.clear()

    def publish(self, df: DataFrame, table: str, job: str, layer: str = "gold", partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Replace a table and record which tables the step has read for it."""
        out = tables.replace_table(df, self.name(layer, table), partition_by)
        self.trace(table, job, layer)
        return out

    def trace(self, table: str, job: str, layer: str = "gold") -> None:
        """Record the tables that the step has read for ``table``."""
        edges = [(self.full(layer, table), source, [job]) for source in dict.fromkeys(self.reads)]
        if edges:
            seen = self.spark.createDataFrame(edges, "target string, source string, job_ids array<string>")
            tables.append_history(seen, self.name("ops", "lineage_edges"), "seen_at")

    def history(self, table: str) -> DataFrame | None:
        return tables.table_or_none(self.spark, self.name("ops", table))

    def raw(self, source: str) -> DataFrame:
        self.reads.append(self.full("bronze", source))
        return landing.read_raw(self.spark, f"{self.root}/bronze/{source}", CONTRACTS[source])

    def store(self, df: DataFrame, step: str) -> DataFrame:
        """Write an intermediate result below the workspace and read it back."""
        path = f"{self.root}/steps/{step}"  # a step never reads its own earlier result
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


def ingest_bronze(ws: Workspace, sources: tuple[str, ...] = tuple(CONTRACTS)) -> None:
    for source in sources:
        base = f"{ws.root}/bronze"
        landing.land(ws.spark, f"{ws.root}/landing/{source}", f"{base}/{source}", f"{base}/_state/{source}", CONTRACTS[source])


def build_silver(ws: Workspace) -> DataFrame:
    """Rebuild silver; returns the row accounting, one row per source.  Raises if rows are unaccounted for."""
    job = f"silver-{uuid4().hex}"
    built: dict[str, DataFrame] = {}
    fx, accounting = None, None
    for source in CONTRACTS:
        row, built[source] = _rebuild(ws, source, built, fx, job)
        accounting = row if accounting is None else accounting.unionByName(row)
        if source == "fx_rates":
            fx = ws.publish(rates.daily_rates(built[source], *_sold_span(ws.raw("pos_sales"))), "fx_daily", job, "silver")
    _mark_built(ws, {source: _landed(ws, source) for source in CONTRACTS}, job)
    return accounting


def _sold_span(sales: DataFrame) -> tuple:
    day = F.expr("try_cast(business_date as date)")  # one impossible date must not end the job
    return tuple(sales.agg(F.min(day), F.max(day)).first())


def _rebuild(ws: Workspace, source: str, built: dict[str, DataFrame], fx: DataFrame | None, job: str) -> tuple[DataFrame, DataFrame]:
    """One silver table and its quarantine from all of its raw rows; returns the accounting and the table."""
    contract = CONTRACTS[source]
    ws.begin()
    bronze = ws.raw(source)
    audited = ws.store(validation.audit(bronze, contract, built, fx).audited, f"audited_{source}")
    parts = validation.split(audited, contract)
    accepted, by = parts.accepted, ()
    if source in FACTS:
        accepted, by = incremental.by_month(accepted), (incremental.MONTH,)
    table = ws.publish(accepted, source, job, "silver", by)
    held = parts.rejected.withColumn("_quarantined_at", F.current_timestamp())
    quarantine = ws.name("silver", "quarantine")
    tables.replace_slice(held, quarantine, "source", source)
    rejected = ws.spark.table(quarantine).where(F.col("source") == source)
    row = validation.account(source, bronze, audited, table, rejected)
    validation.require_balanced(row)
    return row, table


def _landed(ws: Workspace, source: str) -> set[int]:
    """The numbers of the batches landed so far."""
    return {r["_batch"] for r in ws.raw(source).select("_batch").distinct().collect()}


def _mark_built(ws: Workspace, batches: dict[str, set[int]], job: str) -> None:
    """Remember which batches silver holds; written last, so an update that died is done again."""
    rows = [(source, batch, job) for source, held in batches.items() for batch in sorted(held)]
    if rows:
        marks = ws.spark.createDataFrame(rows, "source string, batch int, job string")
        tables.append_history(marks, ws.name("ops", "silver_batches"), "built_at")


def update_silver(ws: Workspace) -> DataFrame:
    """Bring silver up to the batches landed since; returns the accounting of the rows audited, one row per source that was worked on.

    Sales and refunds are merged by the months that new rows touch.  Rows held back for an unknown sale or a missing rate are judged again when sales or rates of
    new days came.  The
    other sources are small and rebuilt where they changed.  Everything is rebuilt if there is nothing to build on, or if what old facts were judged by changed: master
    tables, or a rate of a day that silver covers already.  Running it again after a failure gives the same tables.
    """
    done = ws.history("silver_batches")
    if done is None:
        return build_silver(ws)
    known: dict[str, set[int]] = {}
    for r in done.select("source", "batch").distinct().collect():  # a row per source and batch
        known.setdefault(r["source"], set()).add(r["batch"])
    fresh = {source: _landed(ws, source) - known.get(source, set()) for source in CONTRACTS}
    fresh = {source: batches for source, batches in fresh.items() if batches}
    if any(source in MASTERS for source in fresh):
        return build_silver(ws)
    job = f"silver-{uuid4().hex}"
    built = {source: ws.table("silver", source) for source in CONTRACTS}
    accounting: list[DataFrame] = []
    fx, grew = ws.table("silver", "fx_daily"), False
    if "fx_rates" in fresh or "pos_sales" in fresh:
        if "fx_rates" in fresh:
            row, built["fx_rates"] = _rebuild(ws, "fx_rates", built, None, job)
            accounting.append(row)
        first, until = fx.agg(F.min("rate_date"), F.max("rate_date")).first()
        ws.begin()
        sold = _sold_span(_batches_of(ws, "pos_sales", fresh.get("pos_sales", set())))
        span = min([first, *sold[:1]] if sold[0] else [first]), max([until, *sold[1:]] if sold[1] else [until])
        daily = ws.store(rates.daily_rates(built["fx_rates"], *span), "fx_daily")
        covered = daily.where(F.col("rate_date").between(first, until))
        if not quality.changed_tables(quality.fingerprint(fx, "fx"), quality.fingerprint(covered.select(*fx.columns), "fx")).isEmpty():
            return build_silver(ws)
        grew = covered.count() < daily.count()
        fx = ws.publish(daily, "fx_daily", job, "silver")
    for source in CONTRACTS:
        if source in FACTS and (source in fresh or grew or set(fresh) & _fact_parents(source)):
            accounting.append(_merge(ws, source, fresh.get(source, set()), built, fx, job, grew))
            built[source] = ws.table("silver", source)
        elif source in fresh and source not in FACTS and source != "fx_rates":
            accounting.append(_rebuild(ws, source, built, fx, job)[0])
    _mark_built(ws, fresh, job)
    if not accounting:
        return ws.spark.createDataFrame([], "source string, bronze long, silver long, quarantined long, duplicates long, balanced boolean")
    return reduce(DataFrame.unionByName, accounting)


def _fact_parents(source: str) -> set[str]:
    return {r.parent for r in CONTRACTS[source].references} & set(FACTS)


def _batches_of(ws: Workspace, source: str, batches: set[int]) -> DataFrame:
    return ws.raw(source).where(F.col("_batch").isin(sorted(batches)))


def _merge(ws: Workspace, source: str, batches: set[int], built: dict[str, DataFrame], fx: DataFrame, job: str, rates_grew: bool) -> DataFrame:
    """Audit the new rows of a fact and put them into the months they touch."""
    contract = CONTRACTS[source]
    ws.begin()
    raw, fresh = ws.raw(source), _batches_of(ws, source, batches)
    quarantine = ws.name("silver", "quarantine")
    held = ws.spark.table(quarantine).where(F.col("source") == source)
    waiting = ws.store(incremental.waiting_keys(held, contract, tuple(_fact_parents(source)), rates_grew), f"waiting_{source}")
    rows = fresh
    if not waiting.isEmpty():  # else older raw rows are not read
        older = raw.where(~F.col("_batch").isin(sorted(batches)))
        rows = fresh.unionByName(incremental.held_again(older, waiting, contract))
    rows = ws.store(rows, f"fresh_{source}")
    audited = ws.store(validation.audit(rows, contract, built, fx).audited, f"audited_{source}")
    parts = validation.split(audited, contract)
    row = validation.account(source, rows, audited, parts.accepted, parts.rejected)
    validation.require_balanced(row)
    accepted = ws.store(incremental.by_month(parts.accepted), f"accepted_{source}")
    months, merged = incremental.merged(ws.table("silver", source), accepted, contract)
    tables.replace_partitions(ws.store(merged, f"merged_{source}"), ws.name("silver", source), incremental.MONTH, months)
    kept = incremental.still_held(held, fresh, waiting).drop("source")
    now_held = kept.unionByName(parts.rejected.withColumn("_quarantined_at", F.current_timestamp()))
    tables.replace_slice(ws.store(now_held, f"held_{source}"), quarantine, "source", source)
    ws.trace(source, job, "silver")
    return row


def fingerprinted(ws: Workspace, layer: str, held: dict[str, DataFrame]) -> DataFrame:
    """The snapshot of some tables of a layer; only files written since the last one are read.

    A file counts as unchanged while its name, time and size are the same.
    """
    known = ws.history("file_fingerprints")
    names = [f"{layer}.{t}" for t in held]
    parts = [quality.file_fingerprints(df, f"{layer}.{t}", known) for t, df in held.items()]
    parts = ws.store(reduce(DataFrame.unionByName, parts), f"files_{uuid4().hex}")
    kept = parts if known is None else parts.unionByName(known.where(~F.col("table_name").isin(names)))
    tables.replace_table(kept, ws.name("ops", "file_fingerprints"))
    return quality.composed(parts, names).withColumn("table_name", F.substring_index("table_name", ".", -1))


def silver_tables(ws: Workspace) -> dict[str, DataFrame]:
    return {t: ws.read("silver", t) for t in (*SNAPSHOT, "quarantine")}


def _record(ws: Workspace, results: DataFrame, run_id: str, stage: str) -> DataFrame:
    """Store the results before anyone acts on them."""
    stored = ws.store(results, f"checks_{run_id}_{uuid4().hex}")
    tables.append_history(stored.withColumn("run_id", F.lit(run_id)), ws.name("ops", "dq_results"), "checked_at", f"{run_id}-{stage}")
    return stored


def gate_silver(ws: Workspace, run_id: str) -> DataFrame:
    silver = silver_tables(ws)
    now = ws.store(fingerprinted(ws, "silver", {t: silver[t] for t in SNAPSHOT}), f"snapshot_{run_id}")
    results = quality.run_checks(silver, "silver")
    history = ws.history("silver_snapshot")
    before = now if history is None else quality.latest_snapshot(history)
    results = _record(ws, results.unionByName(quality.row_count_drop(before, now)), run_id, "silver")
    tables.append_history(now.withColumn("run_id", F.lit(run_id)), ws.name("ops", "silver_snapshot"), "taken_at", run_id)
    quality.enforce(results)
    return results


def reconcile_ledger(ws: Workspace, run_id: str, answer_key: str | None = None) -> None:
    ws.begin()
    pos, gl, fx = (ws.read("silver", t) for t in ("pos_sales", "gl_journal", "fx_daily"))
    reconcile.require_complete(pos, gl, fx, ws.read("silver", "quarantine"))
    found = reconcile.reconcile(pos, gl, fx)
    for name, report in zip(RECONCILED, found):
        ws.publish(report, name, run_id)
    planted = reconcile.read_answer_key(ws.spark, answer_key) if answer_key else None
    if planted is not None:
        score = reconcile.detection_score(ws.table("gold", "recon_exceptions"), planted).select(
            F.lit("gl_pos_reconciliation").alias("control"), F.lit(reconcile.PLANTED_ANOMALY).alias("anomaly"), "*"
        )
        tables.append_history(score, ws.name("ops", "detection_scores"), "scored_at", run_id)


def require_access(grants: DataFrame, me: str) -> None:
    """Refuse to publish while grants are visible and wrong; grants nobody shows prove nothing."""
    if evidence.grants_visible(grants, me).first()["visible"]:
        problems = [r["problem"] for r in evidence.grant_problems(grants).orderBy("problem").limit(20).collect()]
        if problems:
            raise RuntimeError("gold refused, wrong grants: " + "; ".join(problems))


def build_marts(ws: Workspace, run_id: str, grants: DataFrame | None = None, me: str = "") -> None:
    """Compute the gold tables aside, prove that they add up to silver and that access is as agreed, then publish them."""
    ws.begin()
    pos, refunds, products, stores, fx, budget = (
        ws.read("silver", t) for t in ("pos_sales", "refunds", "products", "stores", "fx_daily", "budget")
    )
    rolled = ws.store(marts.rollup_lines(marts.sales_lines(pos, products, stores, fx)), "rolled")
    gold = {
        name: ws.store(df, f"gold_{name}")
        for name, df in marts.gold_tables(pos, refunds, products, stores, fx, budget, rolled).items()
    }
    off = marts.tie_outs(gold, pos, refunds, budget).where("not ok").collect()  # eight rows at most
    if off:
        raise RuntimeError("gold refused: " + "; ".join(f"{r['check']}: {r['actual']} against {r['expected']}" for r in off))
    if grants is not None:
        require_access(grants, me)
    for name, df in gold.items():
        ws.publish(df, name, run_id)
        tables.describe_table(ws.spark, ws.name("gold", name), {"quality": "gold"}, marts.MEANING)


def record_lineage(ws: Workspace, run_id: str) -> DataFrame:
    """Write the evidence and return the check that every gold table is traced to its raw tables."""
    edges = ws.history("lineage_edges")
    if edges is None:
        edges = ws.spark.createDataFrame([], "target string, source string, job_ids array<string>")
    chains = evidence.lineage_chains(edges, run_id)
    trace = evidence.row_trace(ws.table("gold", "recon_gl_pos"), ws.table("silver", "pos_sales"), ws.raw("pos_sales"))
    rows = chains.select(F.lit("table").alias("kind"), "gold", "silver", "bronze", F.lit("").alias("source_file")).unionByName(
        trace.select(
            F.lit("row").alias("kind"),
            F.format_string("recon_gl_pos %s %s pos_net_eur=%s", "store_id", F.col("business_date").cast("string"), F.col("pos_net_eur").cast("string")).alias("gold"),
            F.format_string("%d silver rows", "silver_rows").alias("silver"),
            F.format_string("%d bronze rows", "bronze_rows").alias("bronze"),
            F.coalesce("source_file", F.lit("")).alias("source_file"),
        )
    )
    tables.replace_table(rows, ws.name("ops", "lineage_evidence"))
    required = ws.spark.createDataFrame([(ws.full("gold", t),) for t in (*GOLD, *RECONCILED)], "gold string")
    missing = evidence.untraced(required, chains.where("bronze <> ''")).agg(
        F.count("*").alias("violations"), F.array_join(F.sort_array(F.collect_list("gold")), ", ").alias("names")
    )
    detail = F.when(F.col("violations") > 0, F.concat(F.lit("not traced: "), "names")).otherwise("every gold table is traced")
    return quality.as_result(missing.withColumn("detail", detail), "lineage_traced", quality.WARNING, "gold")


def gate_gold(ws: Workspace, run_id: str) -> DataFrame:
    silver = silver_tables(ws)
    now = fingerprinted(ws, "silver", {t: silver[t] for t in SNAPSHOT})
    approved = ws.table("ops", "silver_snapshot").where(F.col("run_id") == run_id)
    results = (
        quality.run_checks({**silver, "daily_revenue": ws.table("gold", "daily_revenue")}, "gold")
        .unionByName(quality.silver_unchanged(approved, now))
        .unionByName(record_lineage(ws, run_id))
    )
    results = _record(ws, results, run_id, "gold")
    published = fingerprinted(ws, "gold", {t: ws.table("gold", t) for t in GOLD})
    tables.append_history(published.withColumn("run_id", F.lit(run_id)), ws.name("ops", "gold_snapshot"), "taken_at", run_id)
    verdict = quality.certification(results, run_id).drop("certified_at")
    tables.append_history(verdict, ws.name("ops", "gold_certification"), "certified_at", run_id)
    quality.enforce(results)
    return results


def build_gold(ws: Workspace, run_id: str | None = None, answer_key: str | None = None, grants: DataFrame | None = None, me: str = "") -> str:
    """Gate silver, reconcile, build the marts, gate gold.  Only a run that reaches the end is certified."""
    run_id = run_id or uuid4().hex
    gate_silver(ws, run_id)
    reconcile_ledger(ws, run_id, answer_key)
    build_marts(ws, run_id, grants, me)
    gate_gold(ws, run_id)
    return run_id


def certified_run(ws: Workspace) -> str:
    """Run id of the certified gold as it is now; raises if it is not certified or was rewritten."""
    history = ws.table("ops", "gold_certification")
    last = quality.latest_certification(history).select("run_id")
    approved = ws.table("ops", "gold_snapshot").join(F.broadcast(last), "run_id", "left_semi")  # a single row
    return quality.require_certified(history, approved, fingerprinted(ws, "gold", {t: ws.table("gold", t) for t in GOLD}))


def score_models(ws: Workspace, rounds: int = forecasting.ROUNDS, trees: int = forest.TREES, answer_key: str | None = None) -> dict:
    """Detectors, forecast and drift on certified gold; returns the backtest summary.

    With an answer key the detectors are scored too: the rank of each planted entity in the months checked, and the flags on others.
    """
    run_id = certified_run(ws)
    gold = {t: ws.table("gold", t) for t in GOLD}
    last = forecasting.last_complete_month(gold["budget_variance"])
    end = forecasting.month_number(last)
    checked = [forecasting.month_name(end - k) for k in range(CHECKED_MONTHS - 1, -1, -1)]

    cashiers = ws.store(detectors.cashier_features(gold["refunds"]), "cashier_features")
    stores = detectors.margin_features(gold["margin"])
    margins = ws.store(stores.rows, "margin_features")
    panel = ws.store(forecasting.monthly_sales(gold["daily_revenue"]), "panel")

    def scores(df: DataFrame, keys: list[str], columns: tuple[str, ...], share: float) -> DataFrame:
        return detectors.ranked(forest.isolation_scores(df, [*keys, "month"], list(columns), share, trees), keys)

    out = {
        "fraud_scores": scores(
            cashiers, ["store_id", "cashier_id"], detectors.CASHIER_FEATURES, detectors.CASHIER_CONTAMINATION
        ),
        "margin_alerts": scores(margins, ["store_id"], detectors.MARGIN_FEATURES, detectors.MARGIN_CONTAMINATION),
    }
    errors = ws.store(forecasting.backtest(panel, last, rounds), "backtest")
    method = forecasting.winner(errors)
    out["revenue_forecast"] = forecasting.forecast(panel, last, method, errors, rounds)

    inputs = (
        ("fraud_cashier_refunds", cashiers, detectors.CASHIER_FEATURES),
        ("fraud_store_margin", margins, detectors.MARGIN_FEATURES),
        ("revenue_forecast", drift.sales_growth(panel), ("yoy_growth",)),
    )
    shifts = None
    for model, df, columns in inputs:
        part = drift.feature_drift(df, list(columns), checked).withColumn("model", F.lit(model))
        shifts = part if shifts is None else shifts.unionByName(part)

    stamp = {"gold_run": F.lit(run_id), "scored_at": F.current_timestamp()}
    for name, df in out.items():
        tables.replace_table(df.withColumns(stamp), ws.name("gold", name))
    tables.append_history(shifts.withColumn("gold_run", F.lit(run_id)), ws.name("ops", "model_drift"), "scored_at", run_id)
    settings = {
        "revenue_forecast": {"rounds": rounds, "tree_depth": forecasting.TREE_DEPTH, "learning_rate": forecasting.LEARNING_RATE, "subsample": forecasting.SUBSAMPLE},
        "fraud_cashier_refunds": {"trees": trees, "contamination": detectors.CASHIER_CONTAMINATION},
        "fraud_store_margin": {"trees": trees, "contamination": detectors.MARGIN_CONTAMINATION},
    }
    scored = {name: ws.table("gold", name) for name in ("fraud_scores", "margin_alerts")}
    metrics = run_metrics.run_metrics(errors, scored, stores.dropped, forecasting.training_rows(panel, last), settings)
    tables.append_history(metrics.withColumn("gold_run", F.lit(run_id)), ws.name("ops", "model_metrics"), "logged_at", run_id)
    key = reconcile.answer_key(ws.spark, answer_key) if answer_key else None
    if key is not None:
        score_detectors(ws, key, checked, run_id)
    return {"run_id": run_id, "winner": method, "last_complete": last}


def score_detectors(ws: Workspace, key: DataFrame, months: list[str], run_id: str) -> None:
    """Append (model, anomaly, entity, month, rank, in_top, false_flags, flags_total) for the key's entities."""
    for model, (anomaly, column) in PLANTED.items():
        entities = [r["entity_id"] for r in key.where(F.col("anomaly") == anomaly).select("entity_id").distinct().collect()]  # planted by hand
        for entity in sorted(entities):
            score = detectors.evaluate_detector(ws.table("gold", model), column, entity, months)
            named = {"model": F.lit(model), "anomaly": F.lit(anomaly), "entity": F.lit(entity), "gold_run": F.lit(run_id)}
            tables.append_history(score.withColumns(named), ws.name("ops", "detector_scores"), "scored_at", f"{run_id}-{model}-{entity}")


def register_functions(ws: Workspace) -> list[str]:
    """Make the month-end table functions available in this session."""
    names = ("daily_revenue", "margin", "budget_variance", "margin_alerts", "recon_exceptions", "revenue_forecast", "fraud_scores")
    return table_functions.register(
        ws.spark, **{n: ws.table("gold", n) for n in names}, gold_certification=ws.table("ops", "gold_certification")
    )
