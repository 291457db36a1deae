"""All registered queries and SQL oracles (import side effects fill the registry).

Every query runs on the dense ``bt`` fixture grain; the heavy ones are also
registered on the ``part`` grain (``*_part``), whose series count grows with
the part table — the long-tail shape the bench uses.
"""

from __future__ import annotations

import functools

from shelfcast.plans import catalog, catalog_forecast, catalog_ingest, catalog_models, catalog_store, catalog_tables  # noqa: F401

PART_GRAIN = ("c04_flatten_sales", "c08_upsert_sales", "c10_sales_daily", "c11_current_inventory",
              "c22_sales_weekly", "c24_fit_weekly_model", "c29_model_quality_flags", "c31_demand_forecasts",
              "c32_stockout_predictions", "c33_vendor_restocks_weekly", "f05_fit_arima", "f06_forecast_arima")


def queries():
    out = dict(catalog.QUERIES)
    for name in PART_GRAIN:
        out[name + "_part"] = functools.partial(catalog.QUERIES[name], grain="part")
    return out


def close(spark) -> None:
    """Delete the folders that queries run in this process have written; their results end with it."""
    catalog_models.close_runs()
    catalog_tables.drop_databases(spark)
    catalog_store.drop_stores(spark)


def oracle_sql():
    out = {name: sql.render("bt") for name, sql in catalog.ORACLE.items()}
    for name in PART_GRAIN:
        if name in catalog.ORACLE:
            out[name + "_part"] = catalog.ORACLE[name].render("part")
    return out
