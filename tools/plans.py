"""Write PLANS.md: the physical plans of the queries whose shape matters at
scale, trimmed to the lines that show it (operator tree, pushed filters, read
schema, aggregate keys and functions, join type, exchanges)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakewash.plans import catalog  # noqa: E402
from lakewash.session import local_session  # noqa: E402

NOTES = {
    "job_flat_records": "Flagship. CSV scan of the staged files, one projection with every cleaner inside "
                        "whole-stage codegen; no Python evaluation, no shuffle.",
    "job_nested_users": "Reads only its columns from the Parquet staging of the parsed JSON; rejects filtered "
                        "with a pushed IsNull filter.",
    "job_nested_phones": "Generate (posexplode) is narrow: the array fans out inside the task that read it.",
    "foreign_key_orphans": "Parent filtered and pruned at the scan, reduced to distinct keys by a partial "
                           "aggregate; broadcast only because its measured size is under the threshold "
                           "(else sort-merge with AQE skew splitting).",
    "latest_per_key": "Partial max(struct) before the shuffle: a hot key leaves one row per task. No window.",
    "primary_key_violations": "Partial count per key before the shuffle.",
    "duplicate_keys": "Partial count per key before the shuffle.",
    "null_counts": "One aggregate for every column's nulls and the row count; a single-row exchange.",
    "row_cap": "TakeOrderedAndProject: per-partition top-n merged once, never a full sort.",
    "surrogate_key": "Reads the checkpoint written after range partitioning; the offsets side is one row "
                     "per partition (bounded broadcast).",
    "file_lineage": "Only the key column and the file-name metadata are read.",
    "scan_csv_dialect": "Multi-line CSV: one task per file.",
    "fk_orphans_bucketed": "Planned with broadcast joins off (as for tables too big to broadcast): both tables "
                           "are bucketed on user_id, so the distinct parent keys and the anti-join need no "
                           "exchange - a sort-merge join straight over the bucketed scans.",
}

CONF = {"fk_orphans_bucketed": {"spark.sql.autoBroadcastJoinThreshold": "-1"}}

KEEP = re.compile(r"^(\s*[+:*|-].*|\(\d+\) .*|Output \[|PushedFilters|ReadSchema|Keys|Functions|Join type|"
                  r"Arguments|Condition|Input \[)")


def trimmed(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        if not line.strip():
            continue
        if KEEP.match(line) or line.startswith("==") or line.startswith("AdaptiveSparkPlan"):
            out.append(line if len(line) < 220 else line[:217] + "...")
    return "\n".join(out)


def main():
    spark = local_session()
    sf_dir = os.environ.get("PLANS_SF_DIR", "/root/testdata/sf0.01")
    parts = ["# Physical plans\n",
             f"Generated by `tools/plans.py` on `{sf_dir}` (`local[*]`, AQE on; the plans are shown before "
             "AQE's run-time re-planning). Lines are trimmed to the operator tree and the details that show "
             "pruning, pushdown, partial aggregation and join strategy.\n"]
    for name, note in NOTES.items():
        saved = {k: spark.conf.get(k) for k in CONF.get(name, {})}
        for k, v in CONF.get(name, {}).items():
            spark.conf.set(k, v)
        df = catalog.queries()[name](spark, sf_dir)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        for k, v in saved.items():
            spark.conf.set(k, v)
        parts.append(f"## {name}\n\n{note}\n\n```\n{trimmed(plan)}\n```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
