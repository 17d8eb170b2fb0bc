"""Plan audit: read a DataFrame's physical plan (``explain()`` text) and
flag shapes that do not scale."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

_NESTED = re.compile(r"BroadcastNestedLoopJoin|CartesianProduct")
_PYTHON = re.compile(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas")
# a single-partition exchange is fine above partial aggregates, a limit, a
# top-k, or the bucket-count table of a whole-table rank (<= buckets + 1 rows)
_OK_BELOW_SINGLE = re.compile(r"partial_|Limit|TakeOrderedAndProject|HashAggregate\(keys=\[__b#")


def plan_text(df: DataFrame) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def audit(df: DataFrame) -> dict:
    """``{'shuffles', 'broadcasts', 'flags'}`` of the plan that ran: the frame
    itself is executed (nothing reaches the driver) and its final adaptive
    plan is read. Writing the frame would plan anew and show the initial one."""
    df._jdf.queryExecution().toRdd().count()
    plan = plan_text(df)
    flags = []
    if _NESTED.search(plan):
        flags.append("nested_loop")
    if _PYTHON.search(plan):
        flags.append("python")
    lines = plan.splitlines()
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" in ln and i + 1 < len(lines) and not _OK_BELOW_SINGLE.search(lines[i + 1]):
            flags.append("single_partition_over_rows")
            break
    return {"shuffles": len(re.findall(r"Exchange (hash|range)partitioning", plan)),
            "broadcasts": len(re.findall(r"BroadcastExchange", plan)), "flags": flags}
