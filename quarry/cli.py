"""Command line: run registered queries and write their results (the reference's train/predict CLI).

  spark-submit quarry/cli.py list
  spark-submit quarry/cli.py run <query> --data <sf_dir> --out <path> [--format parquet|csv|blocks]

The session comes from spark-submit (cluster settings, spark.checkpoint.dir);
``--local N`` builds a local session for trying things out.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="quarry")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered queries")
    run = sub.add_parser("run", help="run one query and write the result")
    run.add_argument("query")
    run.add_argument("--data", required=True, help="folder with the input parquet tables")
    run.add_argument("--out", required=True)
    run.add_argument("--format", choices=["parquet", "csv", "blocks"], default="parquet")
    run.add_argument("--local", type=int, default=0, help="use a local session with N cores")
    args = ap.parse_args(argv)

    from quarry.plans.registry import load_all
    reg = load_all()
    if args.cmd == "list":
        for name, e in reg.items():
            print(f"{name}\t{'sql' if e.sql is not None else 'rows'}")
        return 0

    from pyspark.sql import SparkSession

    from quarry.session import ensure_checkpoint_dir, local_session, ship_package
    spark = local_session(args.local) if args.local else SparkSession.builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    df = reg[args.query].build(spark, args.data)
    if args.format == "parquet":
        df.write.mode("overwrite").parquet(args.out)
    elif args.format == "csv":
        from quarry.sources.models import write_csv
        write_csv(df, args.out)
    else:
        from quarry.sources.ratings_text import write_blocks
        cols = {c.lower(): c for c in df.columns}
        score = cols.get("score") or cols.get("pred")
        r = df.select("user_id", "item_id", *( [df[score].alias("score")] if score else []))
        write_blocks(r, args.out, mode="round", with_scores=score is not None)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
