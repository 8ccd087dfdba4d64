"""Command line: the batch job, the stream job, or one registered query.

    spark-submit shopflow/__main__.py batch  --raw /data/raw --out /shared/out
    spark-submit shopflow/__main__.py batch  --tables /data/sf0.1 --out /shared/out
    spark-submit shopflow/__main__.py stream (--tables /data/sf0.1 | --raw /data/raw) --out /shared/out \\
        --checkpoint /shared/ckpt [--kafka-servers host:9092 --topic ventas | --messages /data/topic] \\
        [--per-trigger 100000] \\
        [--trigger "10 seconds"] [--duration 120] [--dedupe "10 minutes"] [--dim-buckets 64]
    spark-submit shopflow/__main__.py kpis   --wide /shared/out/ventas_enriquecidas \\
        --inventory /shared/out/inventario --out /shared/kpis
    spark-submit shopflow/__main__.py charts --kpis /shared/kpis --out /shared/docs
    spark-submit shopflow/__main__.py query  --tables /data/sf0.1 --name kpi_platforms --out /shared/q

The master and resources come from spark-submit (or --master for local use).
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def parse(argv):
    p = argparse.ArgumentParser(prog="shopflow")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("batch", help="integration, KPIs, documents and run metadata")
    src = b.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder of the test tables (parquet)")
    src.add_argument("--raw", help="folder of the raw shop files")
    b.add_argument("--json-lines", action="store_true", help="raw JSON inputs are JSON Lines")
    b.add_argument("--out", required=True)
    b.add_argument("--salt", type=int, default=0, help="salt the dimension joins N ways (hot keys)")
    s = sub.add_parser("stream", help="the sale-event micro-batch job")
    from_ = s.add_mutually_exclusive_group(required=True)
    from_.add_argument("--tables", help="folder of the tables the customer dimension comes from")
    from_.add_argument("--raw", help="folder of the raw shop files the customer dimension comes from (needs a message source)")
    s.add_argument("--messages", help="folder of Parquet messages (key, value, timestamp) as the source")
    s.add_argument("--per-trigger", type=int, default=None, help="most offsets or files of one micro-batch")
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--run-id", default="run")
    s.add_argument("--kafka-servers")
    s.add_argument("--topic")
    s.add_argument("--trigger", default=None, help='processing-time interval, e.g. "10 seconds"')
    s.add_argument("--duration", type=float, default=None, help="seconds before stopping")
    s.add_argument("--dedupe", default=None, help='event-time window for re-delivered ids, e.g. "10 minutes"')
    s.add_argument("--dim-buckets", type=int, default=None)
    k = sub.add_parser("kpis", help="the KPI step from a written wide table")
    k.add_argument("--wide", required=True)
    k.add_argument("--inventory", required=True)
    k.add_argument("--out", required=True)
    c = sub.add_parser("charts", help="chart series from the exported KPI CSV folders")
    c.add_argument("--kpis", required=True)
    c.add_argument("--out", required=True)
    q = sub.add_parser("query", help="one registered query, written as Parquet")
    q.add_argument("--tables", required=True)
    q.add_argument("--name", required=True)
    q.add_argument("--out", required=True)
    return p.parse_args(argv)


def main(argv=None) -> dict:
    args = parse(argv if argv is not None else sys.argv[1:])
    from shopflow.plans import jobs
    from shopflow.plans.context import RawFiles
    from shopflow.plans.queries import REGISTRY
    from shopflow.session import build_session
    from shopflow.sinks import files as sinks

    spark = build_session(args.master)
    if args.cmd == "batch":
        from shopflow.plans.context import Retail
        source = (RawFiles(spark, args.raw, json_lines=args.json_lines, salt=args.salt) if args.raw
                  else Retail(spark, args.tables, salt=args.salt))
        result = jobs.run_batch(spark, source, args.out)
    elif args.cmd == "stream":
        source = None
        if args.kafka_servers:
            source = {"format": "kafka", "options": {"kafka.bootstrap.servers": args.kafka_servers,
                                                     "subscribe": args.topic}}
        elif args.messages:
            source = {"format": "parquet", "path": args.messages}
        elif args.raw:
            raise SystemExit("--raw needs --kafka-servers or --messages")
        trigger = {"processingTime": args.trigger} if args.trigger else None
        data = RawFiles(spark, args.raw) if args.raw else args.tables
        q = jobs.run_stream(spark, data, args.out, args.checkpoint, args.run_id, source=source,
                            trigger=trigger, seconds=args.duration, dedupe_within=args.dedupe,
                            dim_buckets=args.dim_buckets, per_trigger=args.per_trigger)
        result = {"stream": f"{args.out.rstrip('/')}/stream", "batches": len(q.recentProgress)}
    elif args.cmd == "kpis":
        result = jobs.write_kpis(spark, args.wide, args.inventory, args.out)
    elif args.cmd == "charts":
        from shopflow.operators.documents import charts_from_kpi_files
        result = {"series_graficos": sinks.write_documents(
            charts_from_kpi_files(spark, args.kpis), args.out, "series_graficos")}
    else:
        sinks.write_parquet(REGISTRY[args.name](spark, args.tables), args.out)
        result = {args.name: args.out}
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
