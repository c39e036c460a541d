"""Write PLANS.md: the physical plans of the headline queries, with a summary
of the operators that matter at scale (exchanges, joins, windows, scans)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from etalage.queries import REGISTRY  # noqa: E402
from etalage.session import build_session  # noqa: E402

NAMES = ["source_scan", "fill_series", "estimate_sales", "global_rank", "dim_product",
         "fact_sales", "bronze_feed_norm_left", "scd2_changed", "dq_relationships"]
KEEP = re.compile(r"(Exchange|Join|Window|Aggregate|Generate|Scan|Union|Sort |Limit|Expand)")


def summary(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"\[[^\]]{70,}\]", "[...]", line)
            line = re.sub(r"#\d+L?", "", line)
            out.append(line[:170])
    return out


def executed(df) -> str:
    """The plan as it ran, after adaptive planning."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def main(sf_dir: str) -> None:
    spark = build_session("local[8]", "etalage-plans", shuffle_partitions=8)
    parts = ["# Physical plans of the headline queries\n",
             f"Generated by `tools/dump_plans.py` on `{sf_dir}` (local[8], AQE on). "
             "Operator lines only; attribute ids and long column lists elided. "
             "These are the executed plans (after AQE re-planning).\n"]
    for name in NAMES:
        df = REGISTRY[name](spark, sf_dir)
        parts.append(f"\n## {name}\n\n```\n" + "\n".join(summary(executed(df))) + "\n```\n")
    # what is shuffled before the rows are stored
    from etalage.operators.rank import global_rank
    from etalage.operators.sales import estimate_sales
    from etalage.plans import dims, facts
    from etalage.queries import _feeds_silver, _product
    from etalage.sources import bindings as B

    silver = _feeds_silver(spark, sf_dir)
    order = ["image_url", "date", "l_orderkey", "l_linenumber"]
    before = {
        "fact_sales, the rows before they are stored": facts.fact_rows(silver, _product(spark, sf_dir, silver)[3], dims.dim_date(silver)),
        "global_rank in 8 ranges": global_rank(B.obs(spark, sf_dir).select(*order, "price"), order, ranges=8),
        "estimate_sales in 16 chunks": estimate_sales(silver, ["feed", "image_url"], chunks=16),
        "fill_series, before its numbering": B.obs_silver(spark, sf_dir),
    }
    for name, df in before.items():
        parts.append(f"\n## {name}\n\n```\n" + "\n".join(summary(executed(df))) + "\n```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("".join(parts))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
