"""Command line for a manual start (P4): the load with explicit arguments.

    python -m quayside load   --path raw/companies.csv --target /zone/company --key raw/companies.csv
    python -m quayside stream --raw /zone/raw --target /zone/company --checkpoint /zone/_ck
    python -m quayside compact --target /zone/company

Works under ``spark-submit`` too; the session is the one the submitter
configured (master, checkpoint folder), with the load's defaults applied.
Each load prints its result as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict


def _config(args):
    from quayside.plans.load import LoadConfig

    return LoadConfig(target=args.target, profile=args.profile, ts=args.ts,
                      order_by=tuple(args.order_by) if args.order_by else None,
                      multi_line=not args.single_line, same_header=args.same_header,
                      compact_every=args.compact_every)


def _print(result) -> None:
    out = asdict(result)
    print(json.dumps(out, default=str))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quayside")
    sub = parser.add_subparsers(dest="command", required=True)

    def common(p):
        p.add_argument("--target", required=True)
        p.add_argument("--profile", default="content", choices=["content", "as_coded"])
        p.add_argument("--ts", default=None, help="fixed load time (default: now)")
        p.add_argument("--order-by", nargs="*", default=None)
        p.add_argument("--single-line", action="store_true",
                       help="no quoted line breaks: read large files split")
        p.add_argument("--same-header", action="store_true")
        p.add_argument("--compact-every", type=int, default=None)

    load = sub.add_parser("load", help="load one file, folder or glob")
    load.add_argument("--path", required=True, nargs="+")
    load.add_argument("--key", default=None, help="object key recorded as source_file")
    load.add_argument("--root", default=None, help="zone root cut from file paths")
    common(load)

    stream = sub.add_parser("stream", help="load what arrived under a raw folder")
    stream.add_argument("--raw", required=True)
    stream.add_argument("--checkpoint", required=True)
    common(stream)

    compact = sub.add_parser("compact", help="fold loaded batches into the snapshot")
    compact.add_argument("--target", required=True)

    args = parser.parse_args(argv)

    from quayside.session import get_session
    spark = get_session()
    if args.command == "load":
        from quayside.plans.load import run_load
        paths = args.path[0] if len(args.path) == 1 else args.path
        _print(run_load(spark, paths, _config(args), key=args.key, root=args.root))
    elif args.command == "stream":
        from quayside.streaming.files import run_stream
        for result in run_stream(spark, args.raw, _config(args), args.checkpoint):
            _print(result)
    else:
        from quayside.plans.target import compact as do_compact
        print(json.dumps({"snapshot_version": do_compact(spark, args.target)}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
