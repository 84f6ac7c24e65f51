"""Physical-plan summary of every registered query (``python -m
sigflow.plans.report [sf_dir]`` prints a Markdown table).

Read from ``explain`` output: shuffles (Exchange) and their keys, join
strategies, scan pruning and pushdown, top-n versus full sort, and any
Python evaluation (there should be none).
"""

from __future__ import annotations

import re
import sys

from sigflow.plans.inspect import plan_text


def summarize(df) -> dict:
    text = plan_text(df, "simple")
    exchanges = re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|SinglePartition|RoundRobinPartitioning\(\d+\))", text)
    keys = []
    for e in exchanges:
        name = e.split("(")[0]
        cols = re.findall(r"(\w+)#\d+", e)
        keys.append(f"{name.replace('partitioning', '')}({', '.join(dict.fromkeys(cols))})" if cols else name)
    read = re.findall(r"ReadSchema: struct<(.*?)>\s*$", text, flags=re.M)
    return {
        "shuffles": len(exchanges),
        "shuffle_keys": "; ".join(keys) or "-",
        "broadcast_joins": text.count("BroadcastHashJoin"),
        "other_joins": len(re.findall(r"SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct", text)),
        "partition_filters": bool(re.search(r"PartitionFilters: \[[^\]]+\]", text)),
        "pushed_filters": bool(re.search(r"PushedFilters: \[[^\]]+\]", text)),
        "read_columns": "; ".join(sorted({c.split(":")[0] for r in read for c in re.split(r",(?![^<]*>)", r) if c})) or "-",
        "top_n": "TakeOrderedAndProject" in text,
        "python": bool(re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", text)),
    }


def report(spark, sf_dir: str) -> str:
    from sigflow.plans.queries import QUERIES

    head = ("| query | shuffles | shuffle keys | broadcast joins | other joins | partition filter "
            "| pushed filter | columns read | top-n | Python |")
    lines = [head, "|" + "---|" * 10]
    for name, fn in QUERIES.items():
        s = summarize(fn(spark, sf_dir))
        lines.append(
            f"| `{name}` | {s['shuffles']} | {s['shuffle_keys']} | {s['broadcast_joins']} | {s['other_joins']} "
            f"| {'yes' if s['partition_filters'] else '-'} | {'yes' if s['pushed_filters'] else '-'} "
            f"| {s['read_columns']} | {'yes' if s['top_n'] else '-'} | {'yes' if s['python'] else 'no'} |"
        )
    return "\n".join(lines)


def main(argv=None) -> None:
    from sigflow.session import build_session

    argv = sys.argv[1:] if argv is None else argv
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    # Long read schemas are cut short in explain output unless this is raised.
    spark = build_session("local[*]", extra={"spark.sql.maxMetadataStringLength": "10000"})
    print(report(spark, sf_dir))


if __name__ == "__main__":
    main()
