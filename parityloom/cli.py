"""Commands: generate, validate, stats, example, resume."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    return SparkSession.builder.appName("parityloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="parityloom", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    g = sub.add_parser("generate", help="draw a population and write it")
    g.add_argument("--count", type=int, default=1000)
    g.add_argument("--output", required=True)
    g.add_argument("--format", nargs="+", default=["parquet"], choices=["parquet", "csv", "json", "jsonl"])
    g.add_argument("--seed", type=int, default=42)
    g.add_argument("--rake", action="store_true")
    g.add_argument("--slice", type=int, help="write resumable slices of so many rows")
    v = sub.add_parser("validate", help="check the rows of a file")
    v.add_argument("input")
    v.add_argument("--mode", default="ADULT_18")
    s = sub.add_parser("stats", help="distributions of a file against the targets")
    s.add_argument("input")
    e = sub.add_parser("example", help="show some drawn rows")
    e.add_argument("--count", type=int, default=3)
    e.add_argument("--seed", type=int, default=42)
    args = top.parse_args(argv)

    from .operators import profile, rules
    from .plans import people, report
    from .sources import readers, writers
    from .streaming.streams import generate_sliced

    spark = _session()
    if args.command == "generate":
        if args.slice:
            generate_sliced(spark, lambda ids: people.population(ids, args.seed), args.count, args.slice, f"{args.output}/slices", args.seed)
        else:
            rows = people.corrected(spark, args.count, args.seed)[0] if args.rake else people.generate(spark, args.count, args.seed)
            print(writers.write_all(rows, args.output, "people", args.format))
    elif args.command == "validate":
        found = rules.summary(readers.read(spark, args.input), rules.person_rules(args.mode)).first()
        print(found.asDict())
        return 1 if found["invalid"] else 0
    elif args.command == "stats":
        rows = readers.read(spark, args.input)
        fields = [f for f in people.MARGINALS if f in rows.columns]
        targets = report.target_table(spark, {f: people.MARGINALS[f] for f in fields}).withColumnRenamed("category", "value")
        print(writers.statistics_markdown(profile.field_shares(rows, fields), targets))
    else:
        people.generate(spark, args.count, args.seed).show(truncate=False, vertical=True)
    return 0


if __name__ == "__main__":
    sys.exit(main())
