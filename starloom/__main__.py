"""Command line: build the layers and run the check suite.

    python -m starloom build  --sf-dir DIR --base-path PATH
    python -m starloom checks --sf-dir DIR
    python -m starloom query  --sf-dir DIR NAME [--limit N]
"""

from __future__ import annotations

import argparse
import json

from starloom import get_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="starloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="bronze -> silver -> gold under a base path")
    b.add_argument("--sf-dir", help="test tables to derive the sources from")
    b.add_argument("--source-dir", help="folder of raw source files, instead of --sf-dir")
    b.add_argument("--input-bytes", type=int, help="volume to size scans and shuffles for")
    b.add_argument("--base-path", required=True)
    c = sub.add_parser("checks", help="run the integrity check suite (V1-V9)")
    c.add_argument("--sf-dir", required=True)
    q = sub.add_parser("query", help="show a registered query's result")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("name")
    q.add_argument("--limit", type=int, default=20)
    args = ap.parse_args(argv)

    spark = get_session()
    if args.cmd == "build":
        from starloom.sources.layers import build_all
        print(json.dumps(build_all(spark, args.sf_dir, args.base_path, args.source_dir, args.input_bytes), indent=1))
    elif args.cmd == "checks":
        from functools import reduce

        from pyspark.sql import DataFrame

        from starloom.plans.catalog import queries
        qs = queries()
        suite = reduce(DataFrame.unionByName, [qs[n](spark, args.sf_dir) for n in sorted(qs) if n.startswith("v0")])
        suite.orderBy("check_name", "table_name").show(100, truncate=False)
    else:
        from starloom.plans.catalog import queries
        queries()[args.name](spark, args.sf_dir).show(args.limit, truncate=False)


if __name__ == "__main__":
    main()
