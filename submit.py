"""Runs one job: ``spark-submit submit.py <job> --root <folder> …``.

The folder must be reachable by all executors. Jobs that read a database or Kafka need the
driver or connector on the class path (``spark-submit --packages``). The password is read
from the environment variable SHOP_DB_PASSWORD.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys

from vendaval.plans import (
    Layout,
    extract_all,
    ingest_all,
    purge_snapshots,
    refresh_batch_views,
    refresh_gold_views,
)
from vendaval.plans.gold_views import purge_speed
from vendaval.session import session
from vendaval.sources import JdbcSource, decode_events, read_kafka
from vendaval.specs import BASE_WATERMARK, OVERLAP_SECONDS, WINDOW
from vendaval.streaming import (
    StreamCounts,
    newer_than,
    read_stored_events,
    start_event_store,
    start_gold_refresh,
    start_speed_views,
    starting_cutoff,
)


def parse(arguments: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name, help=text)
        added.add_argument("--root", required=True)
        return added

    extract = job("extract", "changed rows of every table into snapshots")
    extract.add_argument("--url", required=True)
    extract.add_argument("--driver", required=True)
    extract.add_argument("--user", required=True)
    extract.add_argument("--connections", type=int, default=3)
    extract.add_argument("--overlap-seconds", type=float, default=OVERLAP_SECONDS)
    extract.add_argument("--base", default=BASE_WATERMARK, help="skip rows up to this moment")
    extract.add_argument("--until", help="common upper bound of the run")
    extract.add_argument("--purge", action="store_true", help="delete old ingested snapshots")

    ingest = job("ingest", "pending snapshots into the master datasets")
    ingest.add_argument("--mode", choices=["upsert", "append", "replace"])

    batch = job("batch", "batch views from the sales master")
    batch.add_argument("--salt")
    batch.add_argument("--full", action="store_true", help="from all sales, not just new ones")
    batch.add_argument("--purge", action="store_true", help="delete speed days the views now cover")

    speed = job("speed", "speed views from the event stream, until stopped")
    speed.add_argument("--servers", required=True)
    speed.add_argument("--every", default=WINDOW, help="time between micro-batches")
    speed.add_argument("--fold-every", type=int, default=64, help="micro-batches to a fold")
    speed.add_argument("--salt")

    gold = job("gold", "gold views from batch and speed")
    gold.add_argument("--follow", action="store_true", help="refresh whenever windows or events are stored")
    gold.add_argument("--exact", action="store_true", help="from the stored events, sale by sale")
    gold.add_argument("--salt")
    return parser.parse_args(arguments)


def main(arguments: list[str]) -> int:
    options = parse(arguments)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s - %(levelname)s - %(message)s")
    spark, layout = session(f"vendaval-{options.job}"), Layout(options.root)
    outcomes = []
    if options.job == "extract":
        source = JdbcSource(
            options.url,
            options.driver,
            options.user,
            os.environ["SHOP_DB_PASSWORD"],
            options.connections,
        )
        outcomes = extract_all(
            spark,
            source,
            layout,
            until=options.until,
            overlap_seconds=options.overlap_seconds,
            base=options.base,
        )
        if options.purge:
            purge_snapshots(spark, layout)
    elif options.job == "ingest":
        outcomes = ingest_all(spark, layout, mode=options.mode)
    elif options.job == "batch":
        outcomes = refresh_batch_views(spark, layout, salt=options.salt, full=options.full)
        if options.purge and not any(outcome.error for outcome in outcomes):
            purge_speed(spark, layout)
    elif options.job == "speed":
        records = read_kafka(spark, options.servers)
        spark.streams.addListener(StreamCounts(spark, layout))
        often = {"trigger": {"processingTime": options.every}, "fold_every": options.fold_every}
        start_event_store(records, layout, **often)
        events = newer_than(decode_events(records), starting_cutoff(spark, layout))
        start_speed_views(events, layout, salt=options.salt, **often)
        spark.streams.awaitAnyTermination()
    elif options.follow:
        start_gold_refresh(spark, layout, exact=options.exact, salt=options.salt)
        spark.streams.awaitAnyTermination()
    elif options.exact:
        events = read_stored_events(spark, layout)
        outcomes = refresh_gold_views(spark, layout, recent_sales=events, salt=options.salt)
    else:
        outcomes = refresh_gold_views(spark, layout)
    return 1 if any(outcome.error for outcome in outcomes) else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
