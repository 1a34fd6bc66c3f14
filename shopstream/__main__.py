"""Command line: list or run the registered queries.

    python -m shopstream list
    python -m shopstream run <query> [sf_dir] [--rows N] [--explain]
"""

from __future__ import annotations

import argparse

DEFAULT_DIR = "/root/testdata/sf0.01"


def main(argv=None) -> None:
    from shopstream.plans import catalogue, streams, tables  # noqa: F401  (registers queries)

    ap = argparse.ArgumentParser(prog="python -m shopstream", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="registered query names")
    run = sub.add_parser("run", help="run one registered query and show its rows")
    run.add_argument("query", choices=sorted(catalogue.QUERIES))
    run.add_argument("sf_dir", nargs="?", default=DEFAULT_DIR)
    run.add_argument("--rows", type=int, default=20)
    run.add_argument("--explain", action="store_true", help="print the physical plan")
    args = ap.parse_args(argv)

    if args.cmd == "list":
        for name in sorted(catalogue.QUERIES):
            print(name)
        return
    from shopstream.session import build_session

    spark = build_session(app_name=f"shopstream-{args.query}")
    df = catalogue.QUERIES[args.query](spark, args.sf_dir)
    if args.explain:
        df.explain("formatted")
    df.show(args.rows, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
