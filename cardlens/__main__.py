"""Run all stages from the command line.

    python -m cardlens --transactions tx.csv --identity id.csv --root s3a://bucket/fraud
"""

from __future__ import annotations

import argparse
import json

from .plans.etl import run_all_stages
from .session import build_session, size_shuffles


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="cardlens", description=__doc__.splitlines()[0])
    p.add_argument("--transactions", required=True, help="transaction CSV file or folder")
    p.add_argument("--identity", required=True, help="identity CSV file or folder")
    p.add_argument("--root", required=True, help="shared output folder (any Hadoop URI)")
    p.add_argument("--master", default=None, help="Spark master; default: the session's")
    p.add_argument("--sample-size", type=int, default=None, help="keep the first N rows of each source")
    p.add_argument("--buckets", type=int, default=None, help="store raw tables bucketed by TransactionID")
    p.add_argument("--min-rows", type=int, default=500_000)
    p.add_argument("--max-rows", type=int, default=700_000)
    p.add_argument("--no-models", action="store_true")
    a = p.parse_args(argv)
    if a.master:
        spark = build_session(a.master)
    else:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.appName("cardlens").getOrCreate()
    size_shuffles(spark, a.transactions, a.identity)
    result = run_all_stages(spark, a.transactions, a.identity, a.root, a.sample_size, a.buckets,
                          suite_args={"min_rows": a.min_rows, "max_rows": a.max_rows},
                          soft_args={"min_rows": a.min_rows}, train_models=not a.no_models)
    print(json.dumps(result, default=str))


if __name__ == "__main__":
    main()
