"""Summarise the executed (final adaptive) physical plan of every registered
batch query: shuffles, join strategies, aggregates, windows, top-k limits
and the columns each scan reads. Writes a markdown table to stdout.

    python tools/plan_report.py [sf_dir] > PLANS-table.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    count = lambda pat: len(re.findall(pat, plan))
    scans = re.findall(r"FileScan (\w+) \[([^\]]*)\].*?Location: \w+\([^)]*\)\[file:[^\]]*/([\w.-]+)\]", plan)
    tables = sorted({f"{t[2].replace('.parquet', '')}({len(t[1].split(','))})" for t in scans})
    return {
        "exchanges": count(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition"),
        "bhj": count(r"BroadcastHashJoin"),
        "smj": count(r"SortMergeJoin"),
        "shj": count(r"ShuffledHashJoin"),
        "aggs": count(r"HashAggregate|SortAggregate|ObjectHashAggregate"),
        "windows": count(r"\bWindow \["),
        "group_limit": "partial" if "WindowGroupLimit" in plan and "Partial" in plan else "",
        "scans": ", ".join(tables),
    }


def main() -> None:
    from colloquy.plans.registry import load_all
    from colloquy.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    reg = load_all()
    print("| query | shuffles | broadcast joins | sort-merge joins | aggregates | windows | top-k cut | scans (table(columns read)) |")
    print("|---|---|---|---|---|---|---|---|")
    for name in sorted(reg):
        if name.startswith("j"):
            continue
        df = reg[name].fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| `{name}` | {s['exchanges']} | {s['bhj']} | {s['smj'] + s['shj']} | {s['aggs']} | {s['windows']} "
              f"| {s['group_limit']} | {s['scans']} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
