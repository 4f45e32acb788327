"""Publish every output of the cohort fact: ``python -m cohortlens OUT_DIR ...``.

Inputs come from a JSON file mapping the nine input names (cohort, persons,
location, manifest, visits, members, sets, conditions, death) to Parquet
paths, or from the test tables of a scale-factor directory.  Run under
``spark-submit`` on a cluster (the master is taken from there), or locally
with ``--master local[*]``.  Prints the observed row counts as JSON.
"""

from __future__ import annotations

import argparse
import json

from cohortlens.operators.flags import MAX_FLAGS
from cohortlens.plans.fact import FactOptions
from cohortlens.plans.workflow import build_outputs
from cohortlens.session import build_session
from cohortlens.sources.bindings import bound_tables
from cohortlens.sources.io import read_tables


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="python -m cohortlens", description=__doc__.splitlines()[0])
    ap.add_argument("out_dir", help="shared output folder")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--inputs", help="JSON file: input name -> Parquet path")
    src.add_argument("--test-tables", metavar="SF_DIR", help="bind the driver's test tables in SF_DIR")
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    ap.add_argument("--shuffle-partitions", type=int, default=None, help="default: the session's")
    ap.add_argument("--no-er", action="store_true", help="first stays only, no ER visits")
    ap.add_argument("--both", action="store_true", help="require lab and diagnosis dates both near")
    ap.add_argument("--before", type=int, default=1, help="days before the index date")
    ap.add_argument("--after", type=int, default=16, help="days after the index date")
    ap.add_argument("--fraction", type=float, default=1.0, help="cohort sample fraction")
    ap.add_argument("--seed", type=int, default=111, help="cohort sample seed")
    ap.add_argument("--flags-until-index", action="store_true", help="count only conditions up to the index date")
    ap.add_argument("--resume", action="store_true", help="keep stages already written in OUT_DIR")
    ap.add_argument("--max-flags", type=int, default=MAX_FLAGS, help="how many flag columns are allowed")
    ap.add_argument("--stay-id", default=None, help="also list the visits of this stay")
    ap.add_argument("--person-id", type=int, default=None, help="also list the stays of this person")
    args = ap.parse_args(argv)

    spark = build_session(args.master, shuffle_partitions=args.shuffle_partitions)
    if args.inputs:
        with open(args.inputs) as fh:
            tables = read_tables(spark, json.load(fh))
    else:
        tables = bound_tables(spark, args.test_tables)
    opts = FactOptions(
        with_er=not args.no_er,
        require_both=args.both,
        days_before=args.before,
        days_after=args.after,
        fraction=args.fraction,
        seed=args.seed,
        max_flags=args.max_flags,
        flags_until="first_poslab_or_diagnosis_date" if args.flags_until_index else None,
    )
    metrics: dict = {}
    paths = build_outputs(
        tables, args.out_dir, opts, metrics, stay_id=args.stay_id, person_id=args.person_id, resume=args.resume
    )
    report = {name: {"path": paths[name], **metrics.get(name, {})} for name in paths}
    print(json.dumps(report, default=str))
    return report


if __name__ == "__main__":
    main()
