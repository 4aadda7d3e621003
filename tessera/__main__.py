"""Command line for the four flows (what the upstream scheduler triggers).

    python -m tessera daily-build (--sf-dir D | --seeds FOLDER [--stream-root S]) --gold-root G [--api-root R] [--no-stream]
    python -m tessera api-cycle   --sf-dir D --root R --run-id N --stamp "2024-01-31 00:00:00"
    python -m tessera stream      --root R (--topic FOLDER | --kafka KEY=VALUE ...) [--available-now]
    python -m tessera audit       --gold-root G [--api-root R] [--stream-root S] [--history H]

Each command prints one JSON line describing what it wrote or found.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tessera")
    sub = ap.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily-build")
    which = d.add_mutually_exclusive_group(required=True)
    which.add_argument("--sf-dir")
    which.add_argument("--seeds", help="folder of declared CSV seeds")
    d.add_argument("--stream-root", help="stream sink to union with the seeds' telemetry")
    d.add_argument("--gold-root", required=True)
    d.add_argument("--api-root", help="API tables whose silver is gated too")
    d.add_argument("--no-stream", action="store_true")
    a = sub.add_parser("api-cycle")
    a.add_argument("--sf-dir", required=True)
    a.add_argument("--root", required=True)
    a.add_argument("--run-id", required=True)
    a.add_argument("--stamp", required=True)
    a.add_argument("--keep-days", type=int, default=7, help="days that landed files are kept")
    s = sub.add_parser("stream")
    s.add_argument("--root", required=True)
    where = s.add_mutually_exclusive_group(required=True)
    where.add_argument("--topic", help="folder of newline-delimited JSON messages")
    where.add_argument("--kafka", nargs="+", metavar="KEY=VALUE", help="options of the Kafka source")
    s.add_argument("--available-now", action="store_true")
    q = sub.add_parser("audit")
    q.add_argument("--gold-root", required=True)
    q.add_argument("--api-root")
    q.add_argument("--stream-root")
    q.add_argument("--history", help="folder of audit states: only what changed since the last audit is read")
    for p in (d, a, s, q):
        p.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    from tessera.session import build_session, release_scratch
    spark = build_session(args.master)
    if args.cmd == "daily-build":
        from tessera.plans import medallion
        sources = None
        if args.seeds:
            from tessera.streaming import silver as S
            stream = S.read_silver(spark, S.StreamPaths(args.stream_root)) if args.stream_root else None
            sources = medallion.Sources.of_seeds(spark, args.seeds, stream)
        api = None
        if args.api_root:
            from tessera.plans.api_ingest import ApiTables
            api = ApiTables(args.api_root).silver(spark).read()
        out = medallion.daily_build(spark, args.sf_dir, args.gold_root, include_stream=not args.no_stream,
                                    sources=sources, api_silver=api)
    elif args.cmd == "api-cycle":
        from tessera.plans import api_ingest
        from tessera.sources import bindings
        out = api_ingest.run_cycle(spark, bindings.api_log(spark, args.sf_dir),
                                   api_ingest.ApiTables(args.root), api_ingest.STREAMS,
                                   args.stamp, args.run_id, "$.k", keep_days=args.keep_days)
    elif args.cmd == "stream":
        from tessera.sources import bindings
        from tessera.streaming import silver as S
        from tessera.streaming.bronze import topic_source
        paths = S.StreamPaths(args.root)
        kafka = dict(o.split("=", 1) for o in args.kafka) if args.kafka else None
        src = topic_source(spark, args.topic, kafka=kafka)
        if args.available_now:
            S.run_available(spark, src, paths, record=bindings.STREAM_RECORD)
        else:  # long-running: 5-minute trigger until stopped
            S.start_silver(spark, src, paths, record=bindings.STREAM_RECORD,
                           query_name="stream_silver").awaitTermination()
        out = {"silver": paths.silver, "dead_letters": paths.dead_letters}
    else:
        from tessera.plans import audit
        found = audit.stored_audit(spark, args.gold_root, args.api_root, args.stream_root, args.history)
        out = {"checks": [r.asDict() for r in found.collect()]}
    print(json.dumps(out, default=str))
    release_scratch(spark)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
