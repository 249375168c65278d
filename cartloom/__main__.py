"""Command line for the day jobs: ``python -m cartloom <job> ...`` (or the same
module under ``spark-submit``).

Jobs
  orders     landed order responses -> order, product, option, payment day tables,
             reconciled and published, with day markers
  customers  landed customer responses -> customer day table, reconciled, published
  payments   payment instruments of orders created in a closed date range

The run date defaults to yesterday; only this day is judged and published, against the
totals of its landed probe responses (``--probes``). Landed responses are read from
``<landing>`` or, with ``--per-day-folders``, from ``<landing>/<yyyyMMdd>/``
(any Hadoop file system URI).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cartloom")
    sub = p.add_subparsers(dest="job", required=True)
    for job in ("orders", "customers"):
        j = sub.add_parser(job)
        j.add_argument("--landing", required=True, help="folder of landed responses")
        j.add_argument("--out", required=True, help="publish root")
        j.add_argument("--date", help="run date yyyyMMdd (default yesterday)")
        j.add_argument("--probes", required=True,
                       help="folder of landed whole-day probe responses (field=/run_date=)")
        j.add_argument("--multi-line", action="store_true", help="one response per file")
        j.add_argument("--per-day-folders", action="store_true",
                       help="read <landing>/<yyyyMMdd>/ instead of <landing>")
        if job == "orders":
            j.add_argument("--compat", action="store_true", help="hash a missing e-mail as 'nan'")
            j.add_argument("--strict", action="store_true", help="empty arrays drop the order")
            j.add_argument("--mode", default="or", choices=["or", "and"], help="reconcile rule")
    pay = sub.add_parser("payments")
    pay.add_argument("--landing", required=True)
    pay.add_argument("--out", required=True)
    pay.add_argument("--first", required=True, help="first day yyyy-MM-dd")
    pay.add_argument("--last", required=True, help="last day yyyy-MM-dd")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    from cartloom.functions.timefmt import default_run_date
    from cartloom.plans import pipelines as P
    from cartloom.session import build_session
    from cartloom.sinks.publish import write_day
    from cartloom.sources.envelope import (documents, latest_pages, read_customer_envelopes,
                                           read_order_envelopes, read_probe_totals)

    spark = build_session()
    if args.job == "payments":
        docs = documents(read_order_envelopes(spark, args.landing))
        write_day(P.backfill_payments(docs, args.first, args.last),
                  os.path.join(args.out, "payments"))
        return {"job": "payments", "out": os.path.join(args.out, "payments")}
    day = (dt.datetime.strptime(args.date, "%Y%m%d").date() if args.date
           else spark.range(1).select(default_run_date()).first()[0])
    folder = f"{args.landing.rstrip('/')}/{day:%Y%m%d}" if args.per_day_folders else args.landing
    reader = read_order_envelopes if args.job == "orders" else read_customer_envelopes
    envelopes = reader(spark, folder, multi_line=args.multi_line)
    docs, source = documents(latest_pages(envelopes)), read_probe_totals(spark, args.probes)
    if args.job == "orders":
        run = P.run_orders(docs, source, args.out, run_dates=[day], envelopes=envelopes,
                           compat=args.compat, strict=args.strict, mode=args.mode)
    else:
        run = P.run_customers(docs, source, args.out, run_dates=[day], envelopes=envelopes)
    verdict = [r.asDict() for r in run.verdicts.collect()]  # one row: the run date's
    summary = {"job": args.job, "run_date": f"{day:%Y%m%d}",
               "verdict": json.loads(json.dumps(verdict, default=str)), "written": run.written,
               "version": run.version}
    print(json.dumps(summary, default=str))
    return summary


if __name__ == "__main__":
    main(sys.argv[1:])
