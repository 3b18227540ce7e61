"""Run a month-end close: every stage is written once and read back by the next.

usage:
  python -m settlebook.close --inputs /warehouse/settlement --out /warehouse/close_2018_12 \
      --period dec_2018 [--format parquet|table] [--stages all|balance,...] [--resume]
  python -m settlebook.close --inputs settlement --format table --out close_2019_01 --period-file jan_2019.json
  python -m settlebook.close --driver-tables /root/testdata/sf0.1 --out /shared/close_fixture

A period file (JSON or TOML) holds the fields of ``settlebook.plans.Period``.
The December 2018 close leaves out the payouts voided by hand that month unless
the inputs have a ``manual_voids`` table. With ``--format table`` inputs and
stages are tables of catalog databases. With ``--driver-tables`` the inputs are
derived from the driver's test tables and the fixture period is used.
"""

from __future__ import annotations

import argparse

from settlebook.plans import Period, close_period
from settlebook.plans import rules as R
from settlebook.plans.closing import STAGES
from settlebook.session import build_session
from settlebook.sources import DriverTables, settlement_inputs
from settlebook.sources.keys import verified
from settlebook.sources.stages import StageStore, run_fingerprint
from settlebook.sources.warehouse import load_inputs, write_stage


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--inputs", help="folder or catalog database holding the input tables")
    src.add_argument("--driver-tables", help="folder with the driver's parquet tables")
    ap.add_argument("--format", default="parquet")
    when = ap.add_mutually_exclusive_group()
    when.add_argument("--period", default="dec_2018", choices=["dec_2018", "driver_fixture"])
    when.add_argument("--period-file", help="JSON or TOML file with the period's dates")
    ap.add_argument("--out", required=True, help="folder or catalog database for the stages")
    ap.add_argument("--stages", default="all", help="comma list of stages to write, or 'all'; others are computed in passing")
    ap.add_argument("--resume", action="store_true",
                    help="read leading stages that were made from the same period and inputs")
    ap.add_argument("--buckets", type=int, default=0,
                    help="with --format table: lay stages out in so many buckets by (event, currency), so joins move no rows")
    ap.add_argument("--keys", default="raise", choices=["raise", "quarantine", "off"],
                    help="what to do if events, users, orders or transfers repeat an id: stop, keep one row of each (the others go to "
                         "quarantine below --out), or do not look")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    wanted = None if args.stages == "all" else [s for s in args.stages.split(",") if s]
    if unknown := set(wanted or ()) - set(STAGES):
        ap.error(f"unknown stages: {', '.join(sorted(unknown))}")

    spark = build_session(args.master)
    if args.driver_tables:
        x, period = settlement_inputs(DriverTables(spark, args.driver_tables)), Period.driver_fixture()
    else:
        december = not args.period_file and args.period == "dec_2018"
        period = Period.from_file(args.period_file) if args.period_file else getattr(Period, args.period)()
        voids = R.DEC_2018_MANUAL_VOIDS_BRL + R.DEC_2018_MANUAL_VOIDS_ARS if december else ()
        x = load_inputs(spark, args.inputs, args.format, voids=voids)
    x, aside = verified(x, args.keys)
    for table, rows in aside.items():
        where = f"{args.out}.quarantine_{table}" if args.format == "table" else f"{args.out.rstrip('/')}/quarantine/{table}"
        rows.write.mode("overwrite").saveAsTable(where) if args.format == "table" else write_stage(rows, where)
        print(f"{table}: rows with repeated ids set aside in {where}")
    store = StageStore(spark, args.out, args.format, wanted, args.resume, run_fingerprint(x, period), args.buckets)
    close_period(x, period, store)


if __name__ == "__main__":
    main()
