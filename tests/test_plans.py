"""Scale properties of the executed plans (a regression guard for PLANS.md)."""

import io
import os
import re
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data absent")
COARSE = {"cluster", "stream", "collector", "base", "mirror", "kind", "dest_cluster"}


def _final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return re.sub(r"#\d+L?", "", buf.getvalue())


@pytest.mark.parametrize("key", ["closed_files", "trash_select", "missing_minutes", "out_of_order", "audit_merge",
                                 "audit_mirror", "route_merge", "merge_publish", "checkpoint_advance"])
def test_no_hot_key_shuffles(spark, key):
    plan = _final_plan(E.queries()[key](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    final = plan.split("== Initial Plan ==")[0]
    smj_ids = set(re.findall(r"SortMergeJoin \w* *\((\d+)\)", final))
    for i in smj_ids:
        keys = re.search(r"\n\(" + i + r"\) SortMergeJoin.*?\nLeft keys \[\d+\]: \[(.*?)\]", plan, re.S).group(1)
        cols = {k.strip() for k in keys.split(",")}
        # a shuffle join keyed only by stream/collector-level columns would put a hot group in one task,
        # unless both sides hold one row per key (checkpoints: old vs new per collector)
        assert not cols <= COARSE or key == "checkpoint_advance", (key, cols)
    for spec in re.findall(r"windowspecdefinition\((.*?), specifiedwindowframe", plan):
        if re.search(r"(minute|file_name)\s+(ASC|DESC)", spec):
            assert "__b" in spec or "__salt" in spec, (key, spec)
