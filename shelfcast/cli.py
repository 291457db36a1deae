"""Command line for the two scheduled jobs.

    spark-submit shelfcast/cli.py daily  --landing DIR --store DIR [--since-days 14] [--on-duplicate latest]
                                         [--on-reject quarantine]
    spark-submit shelfcast/cli.py weekly --store DIR --out DIR [--as-of YYYY-MM-DD] [--internal-vendor NAME ...]

``daily`` loads the days that landed since the last load and expires old
partitions. ``weekly`` reads the store written by ``daily`` (plus ``vendors`` /
``vendor_status`` config tables), runs the validation + restock run and writes
every output table under ``--out``; vendors, their status and the cadence
(frozen by the first run) are kept in the store; intermediate steps go to the session's
shared ``spark.checkpoint.dir`` and are removed afterwards.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from shelfcast.params import Params
from shelfcast.session import get_session


def _weekly(spark, args) -> dict:
    from shelfcast.plans.weekly import CADENCE, WeeklyRun
    from shelfcast.sources import store

    p = Params(as_of=dt.date.fromisoformat(args.as_of), internal_vendors=tuple(args.internal_vendor))
    read = lambda name: spark.read.parquet(f"{args.store}/{name}")
    snapshots = f"{args.store}/inventory_snapshots_raw"
    sales = store.read_fact(spark, f"{args.store}/sales_history_raw", "sales_history_raw",
                            p.days_ago(p.sales_lookback_days), p.as_of)
    snaps = store.read_fact(spark, snapshots, "inventory_snapshots_raw", p.days_ago(p.readiness_lookback_days), p.as_of)
    cadence = read(CADENCE) if store.table_exists(spark, f"{args.store}/{CADENCE}") else None
    run = WeeklyRun(spark, read("variants"), read("products"), sales, snaps, read("vendors"), read("vendor_status"), p,
                    cadence=cadence, latest_snapshot=store.latest_partition(spark, snapshots, "snapshot_date", p.as_of))
    try:
        paths = run.write_all(args.out)
        run.save_config(args.store)
    finally:
        run.cleanup()
    return paths


def _daily(spark, args) -> dict:
    from shelfcast.plans.daily import daily_load
    from shelfcast.sources import store

    since = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(days=args.since_days)
    report = daily_load(spark, args.landing, args.store, since=since, on_duplicate=args.on_duplicate, on_reject=args.on_reject)
    for name, column in (("sales_history_raw", "sale_date"), ("inventory_snapshots_raw", "snapshot_date")):
        report[f"expired_{name}"] = store.enforce_retention(spark, f"{args.store}/{name}", column, dt.date.today(),
                                                            Params().retention_days)
    return report


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="shelfcast")
    sub = ap.add_subparsers(dest="job", required=True)
    d = sub.add_parser("daily")
    d.add_argument("--landing", required=True)
    d.add_argument("--store", required=True)
    d.add_argument("--since-days", type=int, default=14)
    d.add_argument("--on-duplicate", choices=("error", "latest"), default="error")
    d.add_argument("--on-reject", choices=("fail", "quarantine"), default="fail")
    w = sub.add_parser("weekly")
    w.add_argument("--store", required=True)
    w.add_argument("--out", required=True)
    w.add_argument("--as-of", default=dt.date.today().isoformat())
    w.add_argument("--internal-vendor", action="append", default=[], help="excluded from forecasts and re-orders; repeatable")
    args = ap.parse_args(argv)
    spark = get_session(app_name=f"shelfcast-{args.job}")
    result = _daily(spark, args) if args.job == "daily" else _weekly(spark, args)
    print(json.dumps(result, default=str))


if __name__ == "__main__":
    main()
