"""Jobs for `spark-submit` or `python -m periodica`:

build    one or several departments (default 69), or the whole country, into a warehouse
sample   the periods of one commune, as Parquet
analyse  the business questions, one Parquet result each
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from periodica.functions.territory import DEFAULT_DEPARTEMENT, departement_argument
from periodica.operators.joins import commune_sample
from periodica.plans.analyses import PAST, YEARS, all_questions
from periodica.plans.build import build_warehouse
from periodica.plans.warehouse import Warehouse
from periodica.schemas import STOCK_NAMES, STOCK_SOURCE
from periodica.sources.register import scan_history, short_names


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="periodica")
    jobs = parser.add_subparsers(dest="job", required=True)
    build = jobs.add_parser("build")
    build.add_argument("departements", nargs="*", default=[DEFAULT_DEPARTEMENT])
    build.add_argument("--country", action="store_true", help="all departments")
    build.add_argument("--stock", required=True)
    build.add_argument("--history", required=True)
    build.add_argument("--warehouse", required=True)
    build.add_argument(
        "--rules", choices=["decided", "shipped_a", "shipped_b"], default="decided"
    )
    build.add_argument("--as-of", type=dt.date.fromisoformat)
    build.add_argument("--unique-starts", action="store_true", help="source key (siret, start)")
    build.add_argument("--fail-on-violation", action="store_true")
    sample = jobs.add_parser("sample")
    sample.add_argument("commune")
    sample.add_argument("--stock", required=True)
    sample.add_argument("--history", required=True)
    sample.add_argument("--out", required=True)
    analyse = jobs.add_parser("analyse")
    analyse.add_argument("--warehouse", required=True)
    analyse.add_argument("--out", required=True)
    analyse.add_argument("--siret")
    analyse.add_argument("--past", type=dt.date.fromisoformat, default=PAST)
    analyse.add_argument("--years", type=int, nargs=2, default=YEARS)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"periodica {args.job}").getOrCreate()
    if args.job == "build":
        departements = (
            None if args.country else [departement_argument(d) for d in args.departements]
        )
        build_warehouse(
            spark,
            args.stock,
            args.history,
            args.warehouse,
            departements,
            rules=args.rules,
            as_of=args.as_of,
            unique_starts=args.unique_starts,
            fail_on_violation=args.fail_on_violation,
        ).show(truncate=False)
    elif args.job == "sample":
        stock = short_names(spark.read.schema(STOCK_SOURCE).parquet(args.stock), STOCK_NAMES)
        periods = commune_sample(stock, scan_history(spark, args.history), args.commune)
        periods.write.mode("overwrite").parquet(args.out)
        print(f"{spark.read.parquet(args.out).count()} periods")
    else:
        tables = Warehouse(spark, args.warehouse).tables()
        for name, answer in all_questions(
            tables, args.siret, args.past, tuple(args.years)
        ).items():
            answer.write.mode("overwrite").parquet(f"{args.out}/{name}")


if __name__ == "__main__":
    main()
