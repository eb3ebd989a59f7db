"""Command line: one pipeline run (the reference's scheduled DAG run).

    spark-submit -m retail_lake --seeds amazon.csv intl.csv stock.csv
    python -m retail_lake --sf-dir /root/testdata/sf0.01 --layers bronze silver

Prints the run log of this run as JSON lines; exits non-zero when a quality
gate fails.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from functools import reduce

from retail_lake.params import USD_TO_INR, RunParams


def parse_args(argv):
    p = argparse.ArgumentParser(prog="retail_lake")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--seeds", nargs=3, metavar=("AMAZON_CSV", "INTERNATIONAL_CSV", "STOCK_CSV"))
    src.add_argument("--sf-dir", help="derive the raw files from the driver's star-schema folder")
    p.add_argument("--layers", nargs="+", default=["bronze", "silver", "gold"],
                   choices=["bronze", "silver", "gold"])
    p.add_argument("--load-ts", type=dt.datetime.fromisoformat, default=None)
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    p.add_argument("--usd-inr", type=float, default=USD_TO_INR)
    p.add_argument("--format", default="parquet")
    p.add_argument("--warehouse", default=None, help="location of the layer databases")
    p.add_argument("--reference-variant", action="store_true",
                   help="keep the reference's product fan-out and customer projection")
    p.add_argument("--resume", action="store_true",
                   help="take over models that an earlier attempt with the same files and parameters built")
    p.add_argument("--no-gate", action="store_true", help="report failed checks without stopping")
    return p.parse_args(argv)


def main(argv=None, spark=None) -> int:
    from pyspark.sql import DataFrame

    from retail_lake.plans.pipeline import RAW_TABLES, QualityGateError, run_pipeline
    from retail_lake.session import build_session
    from retail_lake.sources.seeds import malformed_values, read_seeds

    args = parse_args(argv if argv is not None else sys.argv[1:])
    spark = spark or build_session(master="local[*]")
    defaults = RunParams()
    params = RunParams(load_ts=args.load_ts or defaults.load_ts, as_of=args.as_of or defaults.as_of,
                       usd_inr=args.usd_inr)
    raw = malformed = None
    if args.seeds:
        paths = dict(zip(RAW_TABLES, args.seeds, strict=True))
        raw = read_seeds(spark, paths)
        malformed = reduce(DataFrame.unionByName, [malformed_values(spark, t, p) for t, p in paths.items()])
    try:
        result = run_pipeline(spark, params, raw=raw, sf_dir=args.sf_dir, layers=tuple(args.layers),
                              fmt=args.format, location=args.warehouse, corrected=not args.reference_variant,
                              gate=not args.no_gate, malformed=malformed, resume=args.resume)
    except QualityGateError as err:
        print(json.dumps({"status": "failed", "layer": err.layer,
                          "checks": [r.asDict() for r in err.failures]}, default=str))
        return 2
    for row in result.run_log.where(f"pipeline_id = '{result.pipeline_id}'").collect():
        print(json.dumps(row.asDict(), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
