"""Command line for the two jobs (run with spark-submit or python -m tessera).

    python -m tessera market-basket CONDITIONS.csv[.gz] --out DIR [-s 1000] [-l 0.2]
    python -m tessera near-duplicates NEWS.json[.bz2] --out DIR [-k 9] [-b 13] [-r 11]
        [--seed 1] [--similarity-threshold 0.85] [--similar-to ID]
        [--fpfn-analysis] [--fpfn-analysis-samples 1] [--fpfn-analysis-fraction 0.1]

The session comes from the launcher (``SparkSession.builder.getOrCreate()``);
results are written below ``--out``. ``--reuse DIR`` keeps finished results
there (by parameters and input files) and reads them back when a job is
started again.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.plans.jobs import market_basket_job, near_duplicate_job
from tessera.plans.near_duplicates import LshParams
from tessera.plans.registry import MIN_STD_LIFT
from tessera.sources.readers import read_conditions_csv, read_documents_json
from tessera.sources.store import ResultStore


# The option names of the two command lines. Defaults are those of the library.
_LSH = LshParams()


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tessera")
    sub = ap.add_subparsers(dest="job", required=True)
    mb = sub.add_parser("market-basket", help="frequent itemsets and association rules")
    mb.add_argument("file")
    mb.add_argument("--out", required=True)
    mb.add_argument("-s", "--support", type=float, default=1000,
                    help="absolute support (>= 1) or fraction of baskets (< 1)")
    mb.add_argument("-l", "--standardised-lift", type=float, default=MIN_STD_LIFT)
    nd = sub.add_parser("near-duplicates", help="MinHash LSH near-duplicate detection")
    nd.add_argument("file")
    nd.add_argument("--out", required=True)
    nd.add_argument("-k", type=int, default=_LSH.shingle_size)
    nd.add_argument("-b", "--bands", type=int, default=_LSH.bands)
    nd.add_argument("-r", "--rows", type=int, default=_LSH.rows)
    nd.add_argument("-s", "--seed", type=int, default=_LSH.seed)
    nd.add_argument("--similarity-threshold", type=float, default=_LSH.threshold)
    nd.add_argument("--similar-to", default=None)
    nd.add_argument("--fpfn-analysis", action="store_true")
    nd.add_argument("--fpfn-analysis-samples", type=int, default=1)
    nd.add_argument("--fpfn-analysis-fraction", type=float, default=0.1)
    for one in (mb, nd):
        one.add_argument("--reuse", default=None, help="folder of finished results")
    return ap


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"tessera-{args.job}").getOrCreate()
    reuse = ResultStore(spark, args.reuse) if args.reuse else None
    if args.job == "market-basket":
        support = int(args.support) if args.support >= 1 else float(args.support)
        events = read_conditions_csv(spark, args.file)
        market_basket_job(events, args.out, "PATIENT", "CODE", "DESCRIPTION", support, args.standardised_lift,
                          reuse=reuse)
        return 0
    docs = read_documents_json(spark, args.file)
    params = LshParams(args.k, args.bands, args.rows, args.seed, args.similarity_threshold)
    query = None
    if args.similar_to is not None:
        query = docs.select("tweet_id").filter(F.col("tweet_id").cast("string") == F.lit(args.similar_to))
    near_duplicate_job(docs, args.out, "tweet_id", "text", params, query,
                       args.fpfn_analysis_fraction if args.fpfn_analysis else None,
                       args.fpfn_analysis_samples, reuse)
    return 0


if __name__ == "__main__":
    sys.exit(main())
