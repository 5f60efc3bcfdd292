"""Write PLANS.md: the physical-plan shape of every registered query.

    python tests/plan_report.py [sf_dir]

For each query: shuffles (hash / range / single-partition exchanges),
broadcasts, join strategies, windows, Python nodes, and the columns and
filters each parquet scan reads. Job queries run their job
first (their returned plan is the published-table read).
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


def shape(plan: str) -> dict[str, int]:
    return {
        "hash exchange": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range exchange": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single-partition exchange": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcast": plan.count("BroadcastExchange"),
        "broadcast join": plan.count("BroadcastHashJoin"),
        "sort-merge join": plan.count("SortMergeJoin"),
        "window": len(re.findall(r"\bWindow \[", plan)),
        "python": sum(plan.count(m) for m in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")),
    }


def scans(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if "FileScan parquet" not in line:
            continue
        loc = re.search(r"Location: \w+\([^)]*\)\[([^\],]*)", line)
        path = loc.group(1) if loc else "?"
        # Spark shortens long locations; the jobs' tables live under sysledger_runs/
        table = "job table" if ("sysledger_runs" in path or ".parquet" not in path) else Path(path).name
        cols = re.search(r"ReadSchema: struct<([^>\]]*)", line)
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        names = ",".join(c.split(":")[0] for c in cols.group(1).split(",") if ":" in c) if cols else ""
        out.append(f"{table}({names})" + (f" pushed[{pushed.group(1)}]" if pushed and pushed.group(1) else ""))
    return out


def tree_line(line: str, width: int = 150) -> str:
    """Keep the tree prefix and the operator with its key arguments."""
    m = re.match(r"^([\s:+\-|]*)(\S+)(.*)$", line)
    if not m:
        return line[:width]
    prefix, op, rest = m.groups()
    if op == "FileScan":
        cols = re.search(r"ReadSchema: struct<([^>\]]*)", rest)
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", rest)
        rest = " parquet" + (f" read=[{cols.group(1)}]" if cols else "") + (f" pushed=[{pushed.group(1)}]" if pushed else "")
    out = f"{prefix}{op}{rest}"
    return out if len(out) <= width else out[: width - 3] + "..."


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E
    from sysledger.session import get_session

    spark = get_session("local[8]")
    lines = [
        "# PLANS",
        "",
        f"Physical plans of the registered queries at `{sf_dir}` (before AQE re-planning;",
        "generated by `tests/plan_report.py`). Broadcasts are behind size checks; hash",
        "exchanges on small sides are the staged-key / per-user reductions.",
        "",
        "| query | hash x | range x | single x | bcast | BHJ | SMJ | window | python | scans (columns read, pushed filters) |",
        "| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |",
    ]
    for name, fn in sorted(E.queries().items()):
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        sc = "; ".join(sorted(set(scans(plan))))
        lines.append(f"| `{name}` | " + " | ".join(str(v) for v in s.values()) + f" | {sc} |")
    lines += ["", "## Plan trees of the headline queries", "",
              "Operator lines of the physical plan (expressions and long argument lists cut).", ""]
    for name in ("list_tables", "table_sizes", "merge_statements", "merge_sessions", "sync_users", "relation_stats"):
        plan = E.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        lines += [f"### {name}", "", "```"] + [tree_line(x) for x in plan.splitlines() if x.strip()] + ["```", ""]
    (ROOT / "PLANS.md").write_text("\n".join(lines) + "\n")
    print(f"wrote {ROOT / 'PLANS.md'}")


if __name__ == "__main__":
    main(sys.argv)
