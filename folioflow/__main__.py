"""Command line: ``spark-submit folioflow/__main__.py <manifest|extract|transform|all|backfill|publish> --root URI ...``.

Each command runs one job and prints one JSON line with the counts the
driver saw (the data never leaves the cluster).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from folioflow.options import DEFAULT_INDEX, DEFAULT_LANGUAGE, DEFAULT_PAGE_SIZE, INDEX_MODES, NUMBER_MODES, JobOptions
from folioflow.plans import backfill_changed, backfill_transform, extract_job, publish, run_all, transform_job, with_every_key, write_followups, write_manifest
from folioflow.session import build_session
from folioflow.sinks.gate import portfolio_measures, raw_measures


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="folioflow", description=__doc__)
    p.add_argument("command", choices=["manifest", "extract", "transform", "all", "backfill", "publish"])
    p.add_argument("--root", required=True, help="output root URI (file:/..., s3a://bucket/prefix, hdfs://...)")
    p.add_argument("--landing", help="landed response pages (extract, all)")
    p.add_argument("--json-lines", action="store_true", help="landing holds JSON Lines, not one document per file")
    p.add_argument("--all-pages", action="store_true", help="use every landed page, not only page 1")
    p.add_argument("--index", default=DEFAULT_INDEX)
    p.add_argument("--language", default=DEFAULT_LANGUAGE)
    p.add_argument("--page-size", type=int, default=DEFAULT_PAGE_SIZE)
    p.add_argument("--number-mode", choices=NUMBER_MODES, default="auto")
    p.add_argument("--index-mode", choices=INDEX_MODES, default="none")
    p.add_argument("--day", help="day that extract writes, and all extracts and transforms (default: run date)")
    p.add_argument("--base-url", help="request endpoint of the manifest")
    p.add_argument("--total-pages", type=int, default=1, help="pages in the manifest (with --landing: those still missing)")
    p.add_argument("--extra-columns", default="", help="keys of the records beside the fixed ones, by commas; * keeps every key (extract, all)")
    p.add_argument("--source-date", help="raw day read by transform (default: run date)")
    p.add_argument("--target-date", help="portfolio day written by transform (default: run date)")
    p.add_argument("--start", help="first day of a backfill (default: the first there is)")
    p.add_argument("--end", help="last day of a backfill (default: the last there is)")
    p.add_argument("--changed", action="store_true", help="backfill only the days whose raw files are newer than their portfolio")
    p.add_argument("--checks", action="store_true", help="stop the write of a raw or portfolio day that fails its checks (extract, transform, all)")
    p.add_argument("--table", default="portfolio.raw_daily", help="catalog table for publish")
    p.add_argument("--run-timestamp", help="ISO timestamp to bind as the run clock (default: now)")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    run_ts = dt.datetime.fromisoformat(args.run_timestamp) if args.run_timestamp else dt.datetime.now().replace(microsecond=0)
    opts = JobOptions(
        root=args.root,
        page_size=args.page_size,
        index=args.index,
        language=args.language,
        all_pages=args.all_pages,
        number_mode=args.number_mode,
        index_mode=args.index_mode,
        run_timestamp=run_ts,
        extra_columns=tuple(c for c in args.extra_columns.split(",") if c and c != "*"),
    )
    spark = build_session(app_name=f"folioflow-{args.command}")
    out: dict = {"command": args.command, "run_timestamp": run_ts.isoformat()}
    if args.command in ("extract", "all"):
        if not args.landing:
            raise SystemExit("--landing is required for extract")
        if args.extra_columns == "*":
            opts = with_every_key(spark, args.landing, opts, multi_line=not args.json_lines)
            out["extra_columns"] = list(opts.extra_columns)
        if args.command == "all":
            report, written = run_all(spark, args.landing, opts, multi_line=not args.json_lines, day=args.day, checks=args.checks)
            out["portfolio_rows"] = written.record_count
        else:
            report = extract_job(
                spark, args.landing, opts, multi_line=not args.json_lines, partition_day=args.day, measures=raw_measures() if args.checks else ()
            )
        out["raw_records"] = report.write.record_count
        out |= report.losses()
    if args.command == "manifest":
        if not args.base_url:
            raise SystemExit("--base-url is required for manifest")
        if args.landing:
            out["path"], out["requests"] = write_followups(spark, args.landing, opts, args.base_url, multi_line=not args.json_lines)
        else:
            out["path"], out["requests"] = write_manifest(spark, opts, args.base_url, args.total_pages)
    if args.command == "transform":
        written = transform_job(spark, opts, args.source_date, args.target_date, measures=portfolio_measures() if args.checks else ())
        out["portfolio_rows"] = written.record_count
    if args.command == "backfill":
        written = backfill_changed(spark, opts) if args.changed else backfill_transform(spark, opts, args.start, args.end)
        out["portfolio_rows"] = written.record_count if written else 0
        out["days"] = len(written.days) if written else 0
    if args.command == "publish":
        out["table"] = args.table
        out["rows"] = publish(spark, opts, args.table).count()
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
