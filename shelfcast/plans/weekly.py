"""The weekly validation + restock run as one object with lazily built steps.

Order (SURVEY §3.2-3.3): variant map -> daily rollup -> weekly rollup ->
backtest (forecast, metrics, baseline, proof, flags) -> daily demand model ->
60-day forecasts -> stock-outs -> vendor tables -> restock lists -> views.

Steps that later steps read more than once (the rollups, the backtest
forecast, the demand forecasts, the vendor tables) are *materialized*: written
once as Parquet under the cluster's shared ``spark.checkpoint.dir`` and read
back. That cuts the lineage (a lost executor only recomputes the current step,
never the fact scans of earlier ones) and keeps every later plan small.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators import backtest, demand, forecast, holidays, inventory, restock, vendors, views
from shelfcast.params import DEFAULT_PARAMS, Params
from shelfcast.session import checkpoint_dir
from shelfcast.sources import store


def materialize(df: DataFrame, name: str, root: str) -> DataFrame:
    """Write ``df`` once to ``root/name`` (shared folder) and return the re-read table."""
    path = f"{root}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


ROLLUPS = {"sales_daily": "sale_date", "sales_weekly": "week_start"}
CADENCE = "vendor_restock_cadence_one_time"


class WeeklyRun:
    """Inputs: variants, products, sales (raw history), snapshots, vendors, vendor_status.

    ``cadence``: the stored cadence table, which is frozen once and then read;
    None computes it (the one-time set-up run). ``latest_snapshot`` is the
    newest snapshot partition if the caller knows it from the store's listing.
    """

    def __init__(self, spark: SparkSession, variants: DataFrame, products: DataFrame, sales: DataFrame,
                 snapshots: DataFrame, vendors_table: DataFrame, vendor_status: DataFrame,
                 p: Params = DEFAULT_PARAMS, work_dir: str | None = None, materialize_steps: bool = True,
                 cadence: DataFrame | None = None, latest_snapshot: dt.date | None = None):
        self.spark, self.p = spark, p
        self.variants, self.products, self.sales, self.snapshots_in = variants, products, sales, snapshots
        self.vendors_in, self.status_in = vendors_table, vendor_status
        self.work_dir = work_dir or f"{checkpoint_dir(spark)}/shelfcast-run-{uuid.uuid4().hex}"
        self.materialize_steps = materialize_steps
        self.cadence_in, self.latest_snapshot = cadence, latest_snapshot

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name, self.work_dir) if self.materialize_steps else df

    # ---------------- vendor tables
    @cached_property
    def vendors(self) -> DataFrame:
        return self._keep(vendors.maintain_vendors(self.products, self.vendors_in, self.p), "vendors")

    @cached_property
    def vendor_status(self) -> DataFrame:
        return self._keep(vendors.maintain_vendor_status(self.status_in, self.vendors), "vendor_status")

    @cached_property
    def vendor_rank(self) -> DataFrame:
        # the rank reads one row a vendor three times, not the sales behind it
        sold = self._keep(vendors.vendor_sales(self.sales, self.variants, self.products, self.p), "vendor_sales")
        return vendors.rank_vendors(sold, self.p)

    @cached_property
    def cadence(self) -> DataFrame:
        if self.cadence_in is not None:
            return self.cadence_in
        return self._keep(vendors.vendor_cadence(self.vendor_rank, self.p), "vendor_restock_cadence")

    @cached_property
    def variant_lines(self) -> DataFrame:
        # the map with titles, under the maintained status: vendors added by this run count
        return self._keep(vendors.variant_vendor_map(self.variants, self.products,
                                                     vendors.active_vendors(self.vendor_status, self.p), titles=True),
                          "variant_lines")

    @cached_property
    def variant_map(self) -> DataFrame:
        return self.variant_lines.select("variant_id", "sku", "vendor_name")

    # ---------------- rollups
    @cached_property
    def sales_daily(self) -> DataFrame:
        return self._keep(demand.sales_daily_validation(self.sales, self.p), "sales_daily")

    @cached_property
    def sales_weekly(self) -> DataFrame:
        return self._keep(demand.sales_weekly(self.sales_daily, self.variant_map, self.p), "sales_weekly")

    # ---------------- backtest
    @cached_property
    def guard(self):
        return backtest.has_training(self.sales_weekly, self.p)

    @cached_property
    def weekly_model(self) -> DataFrame:
        return backtest.fit_weekly_model(self.sales_weekly, self.p)

    @cached_property
    def backtest_forecast(self) -> DataFrame:
        return self._keep(backtest.backtest_forecast(self.weekly_model, self.p), "backtest_forecast_4w")

    @cached_property
    def holdout(self) -> DataFrame:
        return backtest.holdout_with_baseline(self.sales_weekly, self.p)

    @cached_property
    def joined(self) -> DataFrame:
        return backtest.backtest_joined(self.holdout, self.backtest_forecast)

    @cached_property
    def scores(self) -> DataFrame:
        return backtest.backtest_scores(self.joined, self.guard)

    @cached_property
    def metrics(self) -> DataFrame:
        return backtest.backtest_metrics(self.scores, self.p)

    @cached_property
    def baseline(self) -> DataFrame:
        return backtest.backtest_baseline(self.scores)

    @cached_property
    def proof(self) -> DataFrame:
        return backtest.backtest_proof(self.joined, self.guard, self.p)

    @cached_property
    def flags(self) -> DataFrame:
        return self._keep(backtest.model_quality_flags(self.scores, self.p), "model_quality_flags")

    # ---------------- daily demand model, forecasts, stock-outs
    @cached_property
    def demand_train(self) -> DataFrame:
        # read by the fit, the holiday effects and the ARIMA tier
        return self._keep(forecast.demand_model_input(self.sales_daily, self.p, variant_map=self.variant_map),
                          "demand_train")

    @cached_property
    def demand_model(self) -> DataFrame:
        # read by the forecast and by the holiday effects
        return self._keep(forecast.fit_demand_model(self.demand_train), "demand_model")

    @cached_property
    def calendar(self) -> DataFrame:
        return holidays.run_calendar(self.spark, self.p)

    @cached_property
    def holiday_effects(self) -> DataFrame:
        return holidays.holiday_effects(self.demand_train, self.demand_model, "variant_id", "sale_date", "qty_sold",
                                        self.calendar)

    @cached_property
    def demand_forecasts(self) -> DataFrame:
        return self._keep(forecast.demand_forecasts(self.demand_model, self.p, holiday_effects=self.holiday_effects,
                                                    calendar=self.calendar), "demand_forecasts")

    @cached_property
    def snapshots(self) -> DataFrame:
        return self.snapshots_in

    @cached_property
    def newest_day(self) -> dt.date | None:
        # one value; later steps filter by the literal instead of looking it up again
        if self.latest_snapshot is not None:
            return self.latest_snapshot
        day = inventory.newest_snapshot(self.snapshots, self.p, None, None)
        return self.spark.range(1).select(day.alias("day")).first()["day"]

    @cached_property
    def current(self) -> DataFrame:
        # read by the stock-outs, both restock lists and the views
        return self._keep(inventory.current_inventory(self.snapshots, self.p, latest=self.newest_day), "current_inventory")

    @cached_property
    def current_for_restock(self) -> DataFrame:
        return inventory.restock_stock(self.current, self.p)

    @cached_property
    def stockouts(self) -> DataFrame:
        return restock.stockout_predictions(self.demand_forecasts, self.current_for_restock, self.p)

    # ---------------- restock lists and views
    def restocks(self, cadence_days: int | None = None) -> DataFrame:
        return restock.vendor_restocks(self.variant_lines, self.vendor_status, self.cadence, self.vendors, self.snapshots,
                                       self.demand_forecasts, restock.fallback_from_daily(self.sales_daily, self.p),
                                       self.flags, self.p, cadence_days, self.newest_day, self.current_for_restock)

    def restocks_active_view(self, cadence_days: int | None = None) -> DataFrame:
        return views.v_vendor_restocks_weekly_active(self.restocks(cadence_days), self.vendor_status, self.p)

    # ---------------- catalog views
    def views(self) -> dict[str, DataFrame]:
        current = self.current
        vvm = views.v_variant_vendor_map(self.variants, self.products)
        active_inv = views.v_current_inventory_active(current, vvm, self.vendor_status, self.p)
        return {
            "current_inventory": current,
            "v_active_vendors": views.v_active_vendors(self.vendor_status, self.p),
            "v_variant_vendor_map": vvm,
            "v_current_inventory_active": active_inv,
            "v_vendor_restocks_weekly_active": self.restocks_active_view(7),
            "v_vendor_summary": views.v_vendor_summary(active_inv),
            "v_inventory_exceptions": views.v_inventory_exceptions(current, vvm),
        }

    def register_views(self) -> list[str]:
        """Expose the views as session temp views (the reference's ``CREATE VIEW``s)."""
        out = []
        for name, df in self.views().items():
            df.createOrReplaceTempView(name)
            out.append(name)
        return out

    # ---------------- everything, written out
    def outputs(self) -> dict[str, DataFrame]:
        return {
            "sales_daily": self.sales_daily, "variant_vendor_map": self.variant_map, "sales_weekly": self.sales_weekly,
            "backtest_forecast_4w": self.backtest_forecast, "backtest_metrics_variant_4w": self.metrics,
            "backtest_baseline_4w": self.baseline, "backtest_proof_4w": self.proof,
            "model_quality_flags": self.flags, "demand_forecasts": self.demand_forecasts,
            "stockout_predictions": self.stockouts, "vendors": self.vendors, "vendor_status": self.vendor_status,
            "vendor_restocks_weekly": self.restocks(7), "vendor_restocks_biweekly": self.restocks(14),
            "negative_stock_skus": inventory.negative_stock(self.snapshots, self.variants, self.products, self.p,
                                                            self.newest_day),
            "current_inventory": self.current,
            "latest_snapshot_count": inventory.latest_snapshot_count(self.snapshots, self.p, self.newest_day),
            "sales_daily_freshness": inventory.sales_daily_freshness(self.sales_daily, self.p),
            "model_kpis": views.model_kpis(self.flags), "quality_distribution": views.quality_distribution(self.flags),
            "wape_scatter": views.wape_scatter(self.flags), "proof_series": views.proof_series(self.proof),
        } | ({} if self.cadence_in is not None else {
            "vendor_sales_rank_one_time": self.vendor_rank, "vendor_restock_cadence_one_time": self.cadence})

    def write_all(self, out_dir: str) -> dict[str, str]:
        """Write every output, and the dashboard views under ``views/``; rollups are partitioned by date."""
        paths = {}
        for name, df in (self.outputs() | {f"views/{n}": v for n, v in self.views().items()}).items():
            paths[name] = f"{out_dir}/{name}"
            if name in ROLLUPS:
                store.write_rollup(df, paths[name], ROLLUPS[name], "variant_id")
            else:
                df.write.mode("overwrite").parquet(paths[name])
        return paths

    def save_config(self, store_dir: str) -> None:
        """Keep vendors, their status and (once) the frozen cadence in the store, so ids and cycles stay."""
        store.replace_table(self.vendors, f"{store_dir}/vendors")
        store.replace_table(self.vendor_status, f"{store_dir}/vendor_status")
        if self.cadence_in is None:
            store.replace_table(self.cadence, f"{store_dir}/{CADENCE}")

    def cleanup(self) -> None:
        """Delete this run's materialized steps from the shared folder.

        DataFrames returned by this run read those files, so call it only
        when they are no longer needed.
        """
        store.delete_folder(self.spark, self.work_dir)


class FixtureRun(WeeklyRun):
    """The run over the test mapping, which derives its snapshots from the order lines: done once, when a step needs them."""

    def __init__(self, f, p: Params, materialize_steps: bool = True):
        super().__init__(f.spark, f.variants, f.products, f.sales_table(), f.inventory, f.vendors_existing,
                         f.vendor_status_existing, p, materialize_steps=materialize_steps)
        self.fixture = f

    @cached_property
    def snapshots(self) -> DataFrame:
        # the newest day and the stock of that day both read them
        return self.fixture.kept_inventory(self._keep)


def from_fixture(f, p: Params, materialize_steps: bool = True) -> WeeklyRun:
    return FixtureRun(f, p, materialize_steps)
