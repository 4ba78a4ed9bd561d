"""Command line: full batch run.

    python -m orderlens --sf-dir /root/testdata/sf0.01 --out /shared/out
    python -m orderlens --raw-csv /landing/orders --out /shared/out --naive
"""

from __future__ import annotations

import argparse


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="orderlens")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="folder of driver tables (<name>.parquet)")
    src.add_argument("--raw-csv", help="CSV landing folder / file of raw orders")
    ap.add_argument("--out", required=True, help="shared output folder")
    ap.add_argument("--completed-status", default=None)
    ap.add_argument("--naive", action="store_true", help="stand-in scorers instead of trained models")
    ap.add_argument("--master", default=None, help="local master for a standalone run, e.g. local[8]")
    ap.add_argument("--processed", action="store_true",
                    help="also write the processed zone (clean orders + order-level features)")
    ap.add_argument("--models-from", default=None, help="score with the saved models of this folder, train nothing")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from orderlens.plans.batch import run_batch
    from orderlens.session import build_session, ensure_checkpoint_dir

    spark = build_session(master=args.master) if args.master else SparkSession.builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    manifest = run_batch(spark, args.out, sf_dir=args.sf_dir, raw_csv=args.raw_csv,
                         completed_status=args.completed_status, learned=not args.naive,
                         write_processed=args.processed, models_from=args.models_from)
    for r in manifest.collect():
        print(f"{'OK' if r.status == 'OK' else 'XX'}  {r.table}  ({r.size_kb} KB, {r.rows} rows)")


if __name__ == "__main__":
    main()
