"""Compact physical-plan summaries for every registered query.

Usage: python tools/plan_summary.py [sf_dir] > PLANS.md
Lists the operator tree (names only), shuffles, broadcasts and the pushed
filters / read schema of each scan, so plan regressions show up in review.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from papertriage.plans.registry import all_queries  # noqa: E402
from papertriage.session import build_session  # noqa: E402

NODE = re.compile(r"^(?P<indent>[\s:|+\-]*)(?P<star>\*\(\d+\) )?(?P<name>[A-Za-z]+)")


def summarize(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        m = NODE.match(line)
        if not m or not m.group("name"):
            continue
        name = m.group("name")
        indent = len(m.group("indent"))
        extra = ""
        if name == "FileScan" or name == "Scan":
            pf = re.search(r"PushedFilters: (\[[^\]]*\])", line)
            rs = re.search(r"ReadSchema: (\S+)", line)
            loc = re.search(r"/([a-z_]+)\.parquet", line)
            extra = f" {loc.group(1) if loc else ''} pushed={pf.group(1) if pf else '[]'} schema={rs.group(1) if rs else '?'}"
        elif name == "Exchange":
            ex = re.search(r"Exchange (\w+)", line)
            extra = f" {ex.group(1) if ex else ''}"
        elif name in ("BroadcastHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin", "ShuffledHashJoin"):
            jt = re.search(r"(Inner|LeftOuter|LeftAnti|LeftSemi|RightOuter|FullOuter|Cross)", line)
            extra = f" {jt.group(1) if jt else ''}"
        codegen = "*" if m.group("star") else " "
        out.append(" " * indent + codegen + name + extra)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    print("# Physical plans (summary)\n")
    print(f"Generated by `tools/plan_summary.py {sf_dir}`. `*` = inside whole-stage codegen.\n")
    for name, q in all_queries().items():
        df = q.fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = summarize(plan)
        shuffles = sum(1 for x in lines if x.strip().lstrip("*").startswith("Exchange "))
        print(f"## {name}\n\n{q.ops}\n\nshuffles: {shuffles}\n\n```")
        print("\n".join(lines))
        print("```\n")


if __name__ == "__main__":
    main()
