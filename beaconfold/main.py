"""Command line of the batch jobs, for ``spark-submit``.

    spark-submit beaconfold/main.py day --data-date 2024-01-15 \\
        --raw-database raw --session-root s3a://sessions --mart-root s3a://mart --partners snapchat
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from beaconfold.functions.calendar import day_hours, utc_offset_seconds, utc_windows  # noqa: E402
from beaconfold.plans.mappings import (  # noqa: E402
    NAME_FEEDS,
    extract_campaigns,
    notify_new_files,
    update_campaigns,
    update_names,
)
from beaconfold.plans.viewability import (  # noqa: E402
    Warehouse,
    build_mart,
    build_sessions,
    for_each_partner,
    raw_source,
    run_day,
)
from beaconfold.profiles import PROFILES, PartnerProfile, select_profiles  # noqa: E402
from beaconfold.sinks.tables import write_notices  # noqa: E402


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="beaconfold")
    jobs = parser.add_subparsers(dest="job", required=True)

    dated = argparse.ArgumentParser(add_help=False)
    dated.add_argument("--data-date", required=True, help="local day, yyyy-MM-dd")
    dated.add_argument("--data-date-tz-offset", type=int, help="seconds; by default that of New York at midnight")
    dated.add_argument("--day-mode", choices=("fixed24", "calendar"), default="fixed24")
    dated.add_argument("--partners", nargs="+", choices=sorted(PROFILES), help="default: all")

    raw = argparse.ArgumentParser(add_help=False)
    where = raw.add_mutually_exclusive_group(required=True)
    where.add_argument("--raw-database", help="catalog database with one raw table per partner")
    where.add_argument("--raw-root", help="directory with one raw directory per partner")

    out = argparse.ArgumentParser(add_help=False)
    out.add_argument("--session-root", required=True)
    out.add_argument("--session-format", default="parquet", help="parquet, or avro with its Spark package")

    mart = argparse.ArgumentParser(add_help=False)
    mart.add_argument("--mart-root", required=True)
    mart.add_argument("--site-mart", action="store_true", help="also write the per-site mart")

    day = jobs.add_parser("day", parents=[dated, raw, out, mart], help="check, sessions, mart, partitions, notices")
    day.add_argument("--session-database")
    day.add_argument("--mart-database")
    day.add_argument("--client-id", default=Warehouse.client_id)
    day.add_argument("--notices-root", help="write load notices here, one directory per partner and date")

    jobs.add_parser("sessions", parents=[dated, raw, out], help="fold one day's events to sessions")
    jobs.add_parser("mart", parents=[dated, out, mart], help="roll one stored session day up")

    pairs = jobs.add_parser("campaign-pairs", parents=[dated, raw], help="extract campaign pairs from events")
    pairs.add_argument("--pairs-root", required=True)

    campaigns = jobs.add_parser("campaigns", parents=[dated], help="apply extracted campaign pairs")
    campaigns.add_argument("--pairs-root", required=True)
    campaigns.add_argument("--entity-table", required=True)
    campaigns.add_argument("--campaigns-root", required=True)
    campaigns.add_argument("--exceptions-root", required=True)

    names = jobs.add_parser("names", help="merge new name files of one feed")
    names.add_argument("--table", required=True, choices=sorted(NAME_FEEDS))
    names.add_argument("--source-id", required=True, type=int)
    names.add_argument("--files-dir", required=True)
    names.add_argument("--names-root", required=True)
    names.add_argument("--state-path", required=True)

    files = jobs.add_parser("new-files", help="announce new files of one kind")
    files.add_argument("--files-dir", required=True)
    files.add_argument("--name-prefix", required=True)
    files.add_argument("--files-type", required=True)
    files.add_argument("--state-path", required=True)
    files.add_argument("--notices-root", required=True)
    files.add_argument("--client-id", default=Warehouse.client_id)
    return parser


def _warehouse(args: argparse.Namespace) -> Warehouse:
    given = {f: getattr(args, f) for f in Warehouse.__dataclass_fields__ if getattr(args, f, None) is not None}
    return Warehouse(**{"session_root": "", "mart_root": "", **given})


def execute(spark: SparkSession, args: argparse.Namespace) -> None:
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    version = int(now.timestamp() * 1_000_000)
    if args.job == "names":
        update_names(
            spark,
            table=args.table,
            source_id=args.source_id,
            files_dir=args.files_dir,
            name_prefix=NAME_FEEDS[args.table],
            names_root=args.names_root,
            state_path=args.state_path,
            now=now,
        )
        return
    if args.job == "new-files":
        notify_new_files(
            spark,
            files_dir=args.files_dir,
            name_prefix=args.name_prefix,
            files_type=args.files_type,
            state_path=args.state_path,
            client_id=args.client_id,
            notices_path=f"{args.notices_root}/{version}",
        )
        return

    offset = args.data_date_tz_offset
    if offset is not None and args.day_mode == "calendar":
        raise ValueError("calendar days need the zone, not an offset")
    offset = utc_offset_seconds(args.data_date) if offset is None else offset
    hours = day_hours(args.data_date, args.day_mode)
    warehouse = _warehouse(args)
    profiles = select_profiles(args.partners)
    if args.job == "campaigns":
        without = [p.name for p in profiles if p.measurement_source_id is None]
        if args.partners and without:
            raise ValueError(f"no campaign mappings for {', '.join(without)}: no measurement source id")
        if without:
            print(f"left out, without measurement source id: {', '.join(without)}")
        profiles = [p for p in profiles if p.name not in without]

    def run(profile: PartnerProfile) -> None:
        if args.job == "day":
            notices = run_day(
                spark, profile, warehouse, args.data_date, tz_offset=args.data_date_tz_offset, day_mode=args.day_mode
            )
            if args.notices_root:
                write_notices(notices, f"{args.notices_root}/{profile.name}/date={args.data_date}")
        elif args.job == "sessions":
            build_sessions(spark, profile, warehouse, args.data_date, offset, hours)
        elif args.job == "mart":
            build_mart(spark, profile, warehouse, args.data_date)
        elif args.job == "campaign-pairs":
            raw = raw_source(spark, profile, warehouse, [d for d, _, _ in utc_windows(args.data_date, offset, hours)])
            extract_campaigns(raw, profile, args.data_date, f"{args.pairs_root}/{profile.name}", offset, hours)
        elif args.job == "campaigns":
            update_campaigns(
                spark,
                profile,
                args.data_date,
                pairs_root=f"{args.pairs_root}/{profile.name}",
                entities=spark.table(args.entity_table),
                campaigns_root=args.campaigns_root,
                exceptions_path=f"{args.exceptions_root}/{profile.name}/date={args.data_date}",
            )

    for_each_partner(profiles, run)


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"beaconfold {args.job}").enableHiveSupport().getOrCreate()
    try:
        execute(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
