"""Summarise the physical plan of every registered batch query: shuffles,
broadcasts, pushed filters and read schemas, top-N limits, and any
cartesian / nested-loop join (there should be none).

Usage: ``python tools/plan_report.py [sf_dir] > PLANS.md``. Streaming keys are
skipped: their returned DataFrame only reads the table the stream wrote.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def formatted_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(plan: str) -> dict:
    tree = plan.split("\n\n")[0]
    scans = []
    for block in re.split(r"\n(?=\(\d+\) )", plan):
        if not re.match(r"\(\d+\) Scan parquet", block):
            continue
        table = re.search(r"Location: InMemoryFileIndex \[[^\]]*/([^/\]]+)\]", block)
        pushed = re.search(r"PushedFilters: \[(.*)\]", block)
        read = re.search(r"ReadSchema: struct<(.*)>", block)
        scans.append((table.group(1) if table else "?", read.group(1).count(":") if read else 0,
                      pushed.group(1) if pushed else ""))
    return {
        "shuffles": len(re.findall(r"\bExchange\b", tree)),
        "broadcasts": len(re.findall(r"BroadcastExchange", tree)),
        "scans": scans,
        "top_n": "WindowGroupLimit" in tree,
        "cartesian": bool(re.search(r"CartesianProduct|BroadcastNestedLoopJoin", tree)),
        "tree": tree.strip(),
    }


def main(argv) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    from visitlens.plans.queries import QUERIES
    from visitlens.session import build_session

    spark = build_session("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    print("# Physical plans\n")
    print(f"Generated by `tools/plan_report.py {sf_dir}` (initial adaptive plans; AQE may still "
          "coalesce partitions or switch a shuffle join to broadcast at runtime).\n")
    print("| Query | Shuffles | Broadcasts | Top-N limit | Cartesian | Scans (columns read; pushed filters) |")
    print("|---|---|---|---|---|---|")
    details = []
    for key, fn in QUERIES.items():
        if key.startswith("stream_"):
            continue
        s = summarise(formatted_plan(fn(spark, sf_dir)))
        scans = "; ".join(f"{t} ({n} cols{'; ' + p if p else ''})" for t, n, p in s["scans"])
        print(f"| `{key}` | {s['shuffles']} | {s['broadcasts']} | {'yes' if s['top_n'] else ''} | "
              f"{'YES' if s['cartesian'] else 'no'} | {scans} |")
        details.append((key, s["tree"]))
    print("\n## Plan trees\n")
    for key, tree in details:
        print(f"### {key}\n\n```\n{tree}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
