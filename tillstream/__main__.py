"""Command line: ``spark-submit tillstream/__main__.py bronze|compact|silver|gold --base <path>``."""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence
from pathlib import Path

# spark-submit runs this file by itself; the executors get the package by --py-files.
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillstream import session  # noqa: E402
from tillstream.operators.dedup import ARRIVAL_ORDER, RECORD_ORDER  # noqa: E402
from tillstream.plans.compact import FILE_BYTES, SETTLED_DAYS, compact_bronze  # noqa: E402
from tillstream.plans.gold import expire_kpis, run_gold  # noqa: E402
from tillstream.plans.refresh import refresh_gold  # noqa: E402
from tillstream.plans.silver import run_silver  # noqa: E402
from tillstream.schemas import EVENT_TYPES  # noqa: E402
from tillstream.sources.tables import DEFAULT_FORMAT  # noqa: E402
from tillstream.streaming.bronze import await_all, start_bronze  # noqa: E402

log = logging.getLogger("tillstream")

# A catch-up batch of the bronze job reads so many records per topic at most.
MAX_OFFSETS_PER_TRIGGER = "50000000"


def _pair(text: str) -> tuple[str, str]:
    name, sign, value = text.partition("=")
    if not (name and sign):
        raise argparse.ArgumentTypeError(f"expected name=value, got {text!r}")
    return name, value


def _trigger(text: str) -> dict[str, object]:
    return {"availableNow": True} if text == "available-now" else {"processingTime": text}


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tillstream")
    parser.add_argument("job", choices=["bronze", "compact", "silver", "gold"])
    parser.add_argument("--base", required=True, help="folder of the layer tables")
    parser.add_argument("--format", default=DEFAULT_FORMAT, help="table format (parquet, delta)")
    bronze = parser.add_argument_group("bronze")
    bronze.add_argument("--broker", help="Kafka bootstrap servers")
    bronze.add_argument("--topic-prefix", default="", help="prefix of the topic names")
    bronze.add_argument("--checkpoints", help="shared folder (else spark.checkpoint.dir)")
    bronze.add_argument("--trigger", type=_trigger, help="an interval, or available-now")
    bronze.add_argument(
        "--source-option",
        type=_pair,
        action="append",
        default=[],
        metavar="NAME=VALUE",
        help="option of the source, repeatable (minPartitions, kafka.security.protocol, ...); "
        f"maxOffsetsPerTrigger is {MAX_OFFSETS_PER_TRIGGER} unless set here",
    )
    bronze.add_argument(
        "--fail-on-data-loss",
        action="store_true",
        help="stop where the broker has dropped records that were not read",
    )
    bronze.add_argument("--source-format", default="kafka", help="kafka, or a file format")
    bronze.add_argument("--source-base", help="folder of topics kept as files")
    compact = parser.add_argument_group("compact")
    compact.add_argument(
        "--settled-days",
        type=int,
        default=SETTLED_DAYS,
        help="whole days between a date that is copied and today",
    )
    compact.add_argument(
        "--file-mb", type=int, default=FILE_BYTES // session.MIB, help="size of the copies' files"
    )
    silver = parser.add_argument_group("silver")
    silver.add_argument("--strict", action="store_true", help="refuse blanks and NaN too")
    silver.add_argument("--detail", action="store_true", help="name the rules a row breaks")
    silver.add_argument("--rebuild", action="store_true", help="read all of bronze again")
    silver.add_argument("--pieces", type=int, default=1, help="shuffles a rebuild is cut into")
    silver.add_argument(
        "--order",
        choices=["record", "arrival"],
        default="record",
        help="the latest copy: by offset, or by the broker's time and then offset",
    )
    gold = parser.add_argument_group("gold")
    gold.add_argument("--latest-stock", action="store_true", help="last stock, not highest")
    gold.add_argument(
        "--changed", action="store_true", help="read only the event dates that silver runs changed"
    )
    gold.add_argument("--export", help="folder for a JSON copy of the KPIs")
    gold.add_argument("--keep", type=int, help="delete all but so many versions of the KPIs")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    parser = arguments()
    args = parser.parse_args(argv)
    if args.job == "bronze" and args.source_format == "kafka" and not args.broker:
        parser.error("bronze needs --broker")
    if args.job == "compact" and args.format != DEFAULT_FORMAT:
        parser.error(f"only {DEFAULT_FORMAT} tables are copied; other formats compact themselves")
    spark = session.build(f"tillstream-{args.job}")
    if args.job == "bronze":
        checkpoints = args.checkpoints or spark.conf.get("spark.checkpoint.dir", None)
        if not checkpoints:
            parser.error("bronze needs --checkpoints where spark.checkpoint.dir is not set")
        options = dict(args.source_option)
        if args.source_format == "kafka":
            options = {
                "kafka.bootstrap.servers": args.broker,
                "maxOffsetsPerTrigger": MAX_OFFSETS_PER_TRIGGER,
                "failOnDataLoss": str(args.fail_on_data_loss).lower(),
            } | options
        queries = start_bronze(
            spark,
            args.base,
            checkpoints,
            args.topic_prefix,
            source_fmt=args.source_format,
            source_base=args.source_base,
            source_options=options,
            fmt=args.format,
            trigger=args.trigger,
        )
        await_all(spark, queries)
    elif args.job == "compact":
        for name in EVENT_TYPES:
            size = args.file_mb * session.MIB
            copied = compact_bronze(spark, args.base, name, args.settled_days, size)
            log.info("compact %s: %s", name, {str(day): rows for day, rows in copied.items()})
    elif args.job == "silver":
        order = ARRIVAL_ORDER if args.order == "arrival" else RECORD_ORDER
        reports = run_silver(
            spark,
            args.base,
            args.format,
            strict=args.strict,
            detail=args.detail,
            order=order,
            rebuild=args.rebuild,
            pieces=args.pieces,
        )
        for name, counts in reports.items():
            log.info("silver %s: %s", name, counts)
    elif args.changed:
        if args.latest_stock or args.export:
            parser.error("--changed makes the highest stock and no export")
        refresh_gold(spark, args.base, args.format)
        if args.keep:
            expire_kpis(spark, args.base, args.keep)
    else:
        run_gold(
            spark, args.base, args.format, latest_stock=args.latest_stock, export=args.export
        )
        if args.keep:
            expire_kpis(spark, args.base, args.keep)


if __name__ == "__main__":
    main()
