"""Command line: run the layers, validate what is published, or show plans.

    python -m cafetal --tables /root/testdata/sf0.01 --root /shared/climate
    python -m cafetal --csv /landing/yearly_csv --root /shared/climate
    python -m cafetal --from gold --root /shared/climate
    python -m cafetal --validate-only --root /shared/climate
    python -m cafetal --explain gold --tables /root/testdata/sf0.01

``--root`` defaults to a folder under the session's ``spark.checkpoint.dir``.
The exit code is 0 on success and 1 when a gate or a critical check fails.
"""

from __future__ import annotations

import argparse
import sys

from cafetal import constants as K
from cafetal.operators import quality as Q
from cafetal.plans import pipeline as P
from cafetal.plans.explain import explain_layer
from cafetal.session import build_session, checkpoint_root
from cafetal.sources import csv_ingest as C
from cafetal.sources.fixture import bronze_fixture


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="python -m cafetal", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    src = p.add_mutually_exclusive_group()
    src.add_argument("--csv", help="folder of yearly grid CSVs (any header order)")
    src.add_argument("--tables", help="folder of the supplied tables (bronze is projected from them)")
    p.add_argument("--root", help="publish root (default: under spark.checkpoint.dir)")
    p.add_argument("--from", dest="start", choices=P.LAYERS, default="bronze",
                   help="layer to start from (default: bronze)")
    p.add_argument("--allow-critical", action="store_true", help="publish although critical checks failed")
    p.add_argument("--validate-only", action="store_true", help="only validate the published tables")
    p.add_argument("--explain", choices=sorted(("silver", "gold")), help="print the plans of a layer")
    p.add_argument("--analyze", action="store_true", help="with --explain: run the queries and show what each operator did")
    return p.parse_args(argv)


def main(argv=None) -> int:
    args = parse(argv)
    spark = build_session()
    root = args.root or f"{checkpoint_root(spark)}/cafetal/published"
    if args.explain:
        if not args.tables:
            print("--explain needs --tables", file=sys.stderr)
            return 2
        for name, plan in explain_layer(spark, args.tables, args.explain, args.analyze).items():
            print(f"== {name} ==\n{plan}")
        return 0
    try:
        if args.validate_only:
            report = P.run_layers(spark, None, root, validate_only=True)
            report.show(100, truncate=False)
            return 0 if Q.verdict(report).first()["aprobado"] else 1
        bronze = None
        if args.start == "bronze":
            if args.csv:
                bronze = C.bronze_typed(C.csv_union_by_name(spark, C.list_files(spark, args.csv)))
                absent = [r["anio"] for r in Q.missing_years(bronze, *K.INGEST_YEARS).orderBy("anio").collect()]
                if absent:
                    print(f"warning: years without data: {', '.join(map(str, absent))}")
            elif args.tables:
                bronze = bronze_fixture(spark, args.tables)
            else:
                print("--from bronze needs --csv or --tables", file=sys.stderr)
                return 2
        result = P.run_layers(spark, bronze, root, args.start, stop_on_critical=not args.allow_critical)
        for table, path in sorted(result.tables.items()):
            print(f"{table:24s} {path}")
        report = P.run_layers(spark, None, root, validate_only=True)
        verdict = Q.verdict(report).first()
        print(f"checks={verdict['checks']} failed={verdict['fallidos']} critical={verdict['criticos']}")
        return 0 if verdict["aprobado"] else 1
    except P.GateError as exc:
        print(f"gate failed, nothing published: {exc}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
