"""Command line: load marts from a database, parquet exports or the test-data stand-ins into parquet or a database.

    python -m martsmith --sources /exports --targets /marts [--mart bank --mart users]
    python -m martsmith --standins /root/testdata/sf0.1 --targets /tmp/marts
    python -m martsmith --jdbc-url jdbc:mysql://db:3306 --jdbc-database accounts=acc --jdbc-database admin=adm \\
        --jdbc-database wallet=wal --jdbc-property user=... --num-partitions 64 \\
        --target-jdbc-url jdbc:mysql://dw:3306 --target-database reports --target-jdbc-property user=...

One JSON load report per mart is printed. The Spark master and cluster settings
come from ``spark-submit`` / ``spark-defaults.conf``; ``--shuffled-bytes`` sizes the
shuffle partitions for the run (``scale_conf``).
"""

from __future__ import annotations

import argparse
import json

from martsmith.plans import MARTS, load_all
from martsmith.session import build_session, scale_conf
from martsmith.sinks import JdbcTarget, ParquetTarget
from martsmith.sources import SourceRegistry, jdbc_registry, parquet_registry, standin_registry


def _pairs(values: list[str] | None) -> dict[str, str]:
    """``name=value`` options; the value may hold more equals signs."""
    out = {}
    for text in values or []:
        name, sign, value = text.partition("=")
        if not sign or not name:
            raise SystemExit(f"expected name=value, got {text!r}")
        out[name] = value
    return out


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="martsmith", description=__doc__.split("\n\n")[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sources", help="folder with <schema>/<table> parquet exports")
    src.add_argument("--standins", help="test-data folder (stand-in operational tables)")
    src.add_argument("--jdbc-url", help="server with the operational tables")
    ap.add_argument("--jdbc-database", action="append", metavar="SCHEMA=DATABASE", help="database of accounts, admin and wallet")
    ap.add_argument("--jdbc-property", action="append", metavar="NAME=VALUE", help="connection property of the sources")
    ap.add_argument("--num-partitions", type=int, default=0, help="slices per source table, and of target keys")
    to = ap.add_mutually_exclusive_group(required=True)
    to.add_argument("--targets", help="folder receiving one parquet table per mart")
    to.add_argument("--target-jdbc-url", help="server receiving one table per mart")
    ap.add_argument("--target-database", default="", help="database of the target tables")
    ap.add_argument("--target-jdbc-property", action="append", metavar="NAME=VALUE", help="connection property of the targets")
    ap.add_argument("--mart", action="append", choices=sorted(MARTS), help="mart(s) to load (default: all)")
    ap.add_argument("--on-bad-cast", choices=("null", "zero"), default="null")
    ap.add_argument("--shuffled-bytes", type=int, default=0, help="bytes the largest stage shuffles, to size shuffle partitions")
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    return ap


def sources_of(args: argparse.Namespace, spark) -> SourceRegistry:
    if args.sources:
        return parquet_registry(spark, args.sources)
    if args.standins:
        return standin_registry(spark, args.standins)
    databases = {"accounts": "accounts", "admin": "admin", "wallet": "wallet", **_pairs(args.jdbc_database)}
    return jdbc_registry(spark, args.jdbc_url, databases, _pairs(args.jdbc_property), num_partitions=args.num_partitions)


def target_of(args: argparse.Namespace, name: str) -> ParquetTarget | JdbcTarget:
    spec = MARTS[name].target
    if args.targets:
        return ParquetTarget(spec, f"{args.targets.rstrip('/')}/{name}")
    table = f"{args.target_database}.{spec.name}" if args.target_database else spec.name
    return JdbcTarget(spec, args.target_jdbc_url, table, _pairs(args.target_jdbc_property), num_partitions=args.num_partitions or None)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(args.master, extra_conf=scale_conf(args.shuffled_bytes) if args.shuffled_bytes else None)
    names = args.mart or list(MARTS)
    for report in load_all(spark, sources_of(args, spark), {n: target_of(args, n) for n in names}, names, args.on_bad_cast):
        print(json.dumps(report.as_dict()), flush=True)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
