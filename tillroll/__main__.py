"""Run one named analysis and print it.

    python -m tillroll --list
    python -m tillroll best_sellers --sf-dir /root/testdata/sf0.01 --param k=5
    python -m tillroll customer_ltv --param customer_id=42 --as-of 2001-08-02
    python -m tillroll monthly_revenue --explain
"""

from __future__ import annotations

import argparse
import ast
import datetime as dt
import inspect
import sys

from tillroll import registry
from tillroll.sources.bind import AS_OF, Tables


def _value(text: str):
    try:
        return dt.date.fromisoformat(text)
    except ValueError:
        pass
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return text


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m tillroll", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("query", nargs="?")
    ap.add_argument("--list", action="store_true", help="list the registered analyses")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, default=AS_OF)
    ap.add_argument("--param", action="append", default=[], metavar="NAME=VALUE")
    ap.add_argument("--rows", type=int, default=20)
    ap.add_argument("--explain", action="store_true", help="print the physical plan instead")
    args = ap.parse_args(argv)

    registry.load_all()
    if args.list or not args.query:
        for name, fn in sorted(registry.QUERIES.items()):
            params = [p for p in inspect.signature(fn).parameters.values() if p.name != "t"]
            sig = ", ".join(f"{p.name}={p.default!r}" for p in params)
            print(f"{name:36s} {sig}")
        return 0
    if args.query not in registry.QUERIES:
        print(f"unknown query {args.query!r}; see --list", file=sys.stderr)
        return 2
    from tillroll.session import local_session
    spark = local_session()
    kwargs = dict(p.split("=", 1) for p in args.param)
    df = registry.QUERIES[args.query](Tables(spark, args.sf_dir, as_of=args.as_of),
                                     **{k: _value(v) for k, v in kwargs.items()})
    if args.explain:
        df.explain("formatted")
    else:
        df.show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
