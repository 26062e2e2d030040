"""Command line: ``python -m domus.cli <job> ...``.

  publish         message stream -> keyed published table (broker topic or message folder)
  replay-pages    landed pages -> messages (+ manifest)
  search          one page of search results over the published table
  land-search     every page of a search, landed one envelope per page under a pull date
  pull            marker gate, then land-search under today's date, then advance the marker
  pull-decision   recency bucket from the last-pull marker
  compact         keyed table's change log -> latest rows per key, as its new base (or in a new folder)
  snapshot        keyed table's current rows as a plain table clustered by location
  metrics         what every committed micro-batch decoded, flagged and quarantined
  field-report    per listing field, in how many messages it is present, null, absent or mistyped

Broker secrets go in ``--kafka-option key=value`` and are never printed.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from domus.operators.field_report import field_report
from domus.operators.search import SearchRequest
from domus.session import get_session
from domus.sources.endpoints import KafkaEndpoint, read_message_files
from domus.streaming import jobs


def _kafka(a) -> KafkaEndpoint | None:
    if not a.bootstrap_servers:
        return None
    opts = dict(kv.split("=", 1) for kv in (a.kafka_option or []))
    return KafkaEndpoint(a.bootstrap_servers, a.topic, starting_offsets=a.starting_offsets,
                         max_offsets_per_trigger=a.max_offsets_per_trigger, options=opts)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="domus")
    p.add_argument("--master", default=None)
    p.add_argument("--checkpoint-dir", help="spark.checkpoint.dir: a folder that driver and executors share")
    sub = p.add_subparsers(dest="job", required=True)

    def broker(sp):
        sp.add_argument("--bootstrap-servers")
        sp.add_argument("--topic", default="listings")
        sp.add_argument("--starting-offsets", default="earliest")
        sp.add_argument("--max-offsets-per-trigger", type=int)
        sp.add_argument("--kafka-option", action="append", metavar="KEY=VALUE")

    pub = sub.add_parser("publish")
    broker(pub)
    pub.add_argument("--messages", help="folder of message files (instead of a broker)")
    pub.add_argument("--table", required=True)
    pub.add_argument("--checkpoint", required=True)
    pub.add_argument("--quarantine")
    pub.add_argument("--continuous", action="store_true", help="keep running (default: availableNow)")
    pub.add_argument("--trigger", default=None, help="processing-time trigger, e.g. '10 seconds'")
    pub.add_argument("--inactivity-timeout", type=float)
    pub.add_argument("--poll-interval", type=float, default=10.0)
    pub.add_argument("--max-files-per-trigger", type=int)
    pub.add_argument("--lenient-maps", action="store_true",
                     help="keep parkingspace/typology when another key of the map is malformed")

    rp = sub.add_parser("replay-pages")
    broker(rp)
    rp.add_argument("--landing", required=True)
    rp.add_argument("--layout", choices=["named", "lines"], default="named")
    rp.add_argument("--manifest", required=True)
    rp.add_argument("--checkpoint", required=True)
    rp.add_argument("--messages", help="folder for message files (instead of a broker)")
    rp.add_argument("--max-files-per-trigger", type=int)

    se = sub.add_parser("search")
    se.add_argument("--table", required=True)
    se.add_argument("--country")
    se.add_argument("--operation")
    se.add_argument("--property-type", action="append")
    se.add_argument("--min-price", type=float)
    se.add_argument("--max-price", type=float)
    se.add_argument("--center", help="lat,lon")
    se.add_argument("--distance", type=float)
    se.add_argument("--max-items", type=int, default=50)
    se.add_argument("--num-page", type=int, default=1)
    se.add_argument("--since", choices=["T", "Y", "W", "M", "AllTime"], help="recency of the page date")
    se.add_argument("--as-of", help="yyyy-MM-dd HH:mm:ss (default: now)")
    se.add_argument("--after", help="cursor of the last row seen: its order value (empty: none), then |, then its key")
    se.add_argument("--output", help="write the page as parquet here (default: print JSON lines)")
    se.add_argument("--snapshot", action="store_true", help="--table is a snapshot (see snapshot)")

    def search_filters(sp):
        sp.add_argument("--table", required=True)
        sp.add_argument("--landing", required=True)
        sp.add_argument("--layout", choices=["lines", "named"], default="lines")
        sp.add_argument("--country")
        sp.add_argument("--operation")
        sp.add_argument("--property-type", action="append")
        sp.add_argument("--min-price", type=float)
        sp.add_argument("--max-price", type=float)
        sp.add_argument("--center", help="lat,lon")
        sp.add_argument("--distance", type=float)
        sp.add_argument("--max-items", type=int, default=50)

    ls = sub.add_parser("land-search")
    search_filters(ls)
    ls.add_argument("--pull-date", required=True, help="yyyy-MM-dd")

    pl = sub.add_parser("pull")
    search_filters(pl)
    pl.add_argument("--marker", required=True)
    pl.add_argument("--now", help="yyyy-MM-dd HH:mm:ss (default: now)")

    sn = sub.add_parser("snapshot")
    sn.add_argument("--table", required=True)
    sn.add_argument("--out", required=True, help="new folder (must not exist)")

    cp = sub.add_parser("compact")
    cp.add_argument("--table", required=True)
    cp.add_argument("--out", help="write a compacted copy to this new folder instead of a new base")

    me = sub.add_parser("metrics")
    me.add_argument("--table", required=True)

    fr = sub.add_parser("field-report")
    fr.add_argument("--messages", required=True)

    pd = sub.add_parser("pull-decision")
    pd.add_argument("--marker", required=True)
    pd.add_argument("--now", help="yyyy-MM-dd HH:mm:ss (default: now)")
    pd.add_argument("--advance", action="store_true")
    return p


def _cursor(text: str) -> tuple[str | None, str]:
    value, _, key = text.partition("|")
    return value or None, key


def main(argv: list[str] | None = None) -> int:
    a = build_parser().parse_args(argv)
    shared = {"spark.checkpoint.dir": a.checkpoint_dir} if a.checkpoint_dir else {}
    spark = get_session(a.master, app=f"domus-{a.job}", **shared)
    if a.job == "publish":
        run = jobs.publish_job(
            spark, jobs.PublishPaths(a.table, a.checkpoint, a.quarantine), kafka=_kafka(a),
            files=a.messages, available_now=not a.continuous, processing_time=a.trigger,
            inactivity_timeout=a.inactivity_timeout, poll_interval=a.poll_interval,
            max_files_per_trigger=a.max_files_per_trigger, lenient_maps=a.lenient_maps)
        print(json.dumps({"query_id": run.query_id, "batches": run.batches,
                          "stopped_for_inactivity": run.stopped_for_inactivity}))
    elif a.job == "replay-pages":
        run = jobs.replay_pages_job(spark, a.landing, a.manifest, a.checkpoint, kafka=_kafka(a),
                                    messages=a.messages, layout=a.layout,
                                    max_files_per_trigger=a.max_files_per_trigger)
        print(json.dumps({"query_id": run.query_id, "batches": run.batches}))
    elif a.job == "search":
        center = tuple(float(x) for x in a.center.split(",")) if a.center else None
        req = SearchRequest(country=a.country, operation=a.operation,
                            property_types=tuple(a.property_type) if a.property_type else None,
                            min_price=a.min_price, max_price=a.max_price, center=center,
                            distance_m=a.distance, max_items=a.max_items, num_page=a.num_page, since=a.since,
                            after=_cursor(a.after) if a.after else None,
                            as_of=dt.datetime.strptime(a.as_of, "%Y-%m-%d %H:%M:%S") if a.as_of else dt.datetime.now())
        page = jobs.search_job(spark, a.table, req, snapshot=a.snapshot)
        if a.output:
            page.write.mode("overwrite").parquet(a.output)
        else:
            for line in page.toJSON().collect():  # one bounded page (max_items rows)
                print(line)
    elif a.job in ("land-search", "pull"):
        center = tuple(float(x) for x in a.center.split(",")) if a.center else None
        req = SearchRequest(country=a.country, operation=a.operation,
                            property_types=tuple(a.property_type) if a.property_type else None,
                            min_price=a.min_price, max_price=a.max_price, center=center,
                            distance_m=a.distance, max_items=a.max_items)
        if a.job == "land-search":
            jobs.land_search_job(spark, a.table, req, a.landing, dt.date.fromisoformat(a.pull_date), layout=a.layout)
            print(json.dumps({"landing": a.landing, "page_date": a.pull_date}))
        else:
            now = dt.datetime.strptime(a.now, "%Y-%m-%d %H:%M:%S") if a.now else None
            print(json.dumps(jobs.pull_job(spark, a.table, a.landing, a.marker, req, now, layout=a.layout)))
    elif a.job == "snapshot":
        print(json.dumps({"table": jobs.snapshot_job(spark, a.table, a.out)}))
    elif a.job == "compact":
        print(json.dumps({"table": jobs.compact_job(spark, a.table, a.out)}))
    elif a.job == "metrics":
        for line in jobs.batch_metrics(spark, a.table).orderBy("run", "batch").toJSON().collect():  # one row per batch
            print(line)
    elif a.job == "field-report":
        for line in field_report(read_message_files(spark, a.messages, streaming=False)).toJSON().collect():  # fields x states
            print(line)
    elif a.job == "pull-decision":
        now = dt.datetime.strptime(a.now, "%Y-%m-%d %H:%M:%S") if a.now else None
        print(json.dumps({"bucket": jobs.pull_decision_job(spark, a.marker, now, a.advance)}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
