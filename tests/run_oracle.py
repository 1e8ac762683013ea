"""Run every registered query against its DuckDB oracle: python tests/run_oracle.py [sf_dir] [names...]"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from oracle_harness import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from starweave.session import local_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session()
    # STARWEAVE_CONF="k=v,k=v" forces code paths, e.g. the cluster-scale ones:
    # spark.starweave.broadcastBytes=0,spark.sql.autoBroadcastJoinThreshold=-1,spark.sql.adaptive.advisoryPartitionSizeInBytes=64k
    for item in filter(None, os.environ.get("STARWEAVE_CONF", "").split(",")):
        k, v = item.split("=", 1)
        spark.conf.set(k.strip(), v.strip())
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t = time.time()
        try:
            ok, msg = compare(qs[name](spark, sf_dir), con, sqls[name])
        except Exception as exc:  # report and continue
            ok, msg = False, f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += not ok
        print(json.dumps({"query": name, "ok": ok, "sec": round(time.time() - t, 2), "msg": msg[:1500]}), flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
