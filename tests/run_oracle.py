"""Run every registered query against its DuckDB oracle: python -m tests.run_oracle SF_DIR [names...]"""

from __future__ import annotations

import json
import sys
import time

from cohortlens.session import build_session
from tests.compare import compare, duck

import __spark_entry__ as entry_mod


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(entry_mod.queries())
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    sql = entry_mod.oracle_sql()
    bad = 0
    for name in names:
        t0 = time.time()
        df = entry_mod.queries()[name](spark, sf_dir)
        if name in sql:
            res = compare(df, con, sql[name])
        else:
            res = {"rows_spark": df.count(), "ok": None}
        res["sec"] = round(time.time() - t0, 2)
        bad += res.get("ok") is False
        print(name, json.dumps(res, default=str), flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
