"""Print the executed (adaptive, final) physical plans of the key operators.

python tests/show_plans.py [sf_dir] > PLANS.md
Runs each query once (noop sink) and prints its final adaptive plan.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from pyspark.sql import functions as F  # noqa: E402

from starweave.operators import keys  # noqa: E402
from starweave.operators.joins import lookup_join  # noqa: E402
from starweave.plans import scenario as S  # noqa: E402
from starweave.plans.facts import resolve_keys  # noqa: E402
from starweave.session import local_session  # noqa: E402


def final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()  # run this plan itself, so the adaptive plan is final
    text = qe.executedPlan().toString()
    text = text.split("+- == Initial Plan ==")[0]
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r"Location: [^,]*,", "", text)
    text = re.sub(r"file:/[^\]]*", "…", text)
    return "\n".join(line[:220] for line in text.splitlines())


def section(title: str, note: str, df) -> None:
    print(f"## {title}\n\n{note}\n\n```\n{final_plan(df)}\n```\n")


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    S.prepare_sources(spark, d)
    print(f"# Physical plans ({Path(d).name}, local[8], final adaptive plans)\n")
    print("Generated by `python tests/show_plans.py`. Expression ids and file paths are elided.\n")

    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    spark.conf.set("spark.starweave.broadcastBytes", "0")
    section(
        "Surrogate keys by range numbering (dense_number), dimension forced to the range path",
        "The deduplicated members were written first (the dedup plan is shown below), then range-partitioned, sorted "
        "and written with their partition and place. Rows and partition sizes are read from those files; the only "
        "single-partition exchange carries one row per partition; the UNKNOWN member is a one-row Range.",
        S.dim_declaration(spark, d),
    )
    dims = S.written_dims(spark, d)
    staging = S.staging(spark, d, with_row_id=True)
    section(
        "Lookup as a shuffle join (dimension over the broadcast limit)",
        "Planned as a shuffle join on (key, salt): NULL keys and sampled hot keys carry a salt (`_sw_fsalt`), the "
        "dimension side replicates hot keys per salt. At this size AQE then sees the real dimension is small and "
        "switches to a broadcast at run time; the salt stays in the join keys.",
        lookup_join(staging, dims["disaster_dim"].select("disaster_tk", "disaster_number"),
                    [(F.col("disaster_number"), "disaster_number")], broadcast=False),
    )
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.unset("spark.starweave.broadcastBytes")
    S.reset_stored(keep=S.SOURCE_TABLES)
    staging = S.staging(spark, d, with_row_id=True)

    section(
        "Dedup of a natural key (first row by source rank, attributes NULLs last)",
        "WindowGroupLimit Partial runs before the shuffle: each map task ships one row per key.",
        keys.first_by_attributes(S.declaration_sources(spark, d)[1], ["declaration_request_number"]),
    )
    lookups = S.fact_lookups(spark, d)
    section(
        "Fact key resolution with default settings",
        "Written dimensions are small, so each lookup is a BroadcastHashJoin; the flat line table is read "
        "with only the needed columns and the split filter pushed down.",
        resolve_keys(staging, lookups, ["deaths"]),
    )
    section(
        "Fact build (flagship)",
        "The staging rows are counted and the resolved columns have a fixed width, so at this size they are known to fit one range and are sorted without being written; beyond one advisory partition they are written and range-partitioned.",
        S.fact(spark, d),
    )
    from starweave.operators.split import split_flag

    section(
        "Exact split flag",
        "After the threshold search the flag is a comparison with a literal tuple: no exchange over the rows being split.",
        split_flag(S.table(spark, d, "orders"), ["o_orderkey"], S.TEST_FRACTION, S.SEED),
    )
    spark.stop()


if __name__ == "__main__":
    main()
