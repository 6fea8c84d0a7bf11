"""Plans stay what they should be: one Python step, narrow scans, no all-pairs joins."""

import pathlib
import re

import pytest

from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
LIBRARY = pathlib.Path(__file__).parent.parent / "sitegrain"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["page_title", "links_discovered", "link_report", "media_kinds"])
def test_one_python_step(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert plan.count("MapInArrow") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name", ["url_normalize", "page_classify", "dedupe_final_url"])
def test_url_queries_do_not_read_html(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    schemas = re.findall(r"ReadSchema: (\S+)", plan)
    if "dedupe" not in name:
        assert schemas and all("html" not in s for s in schemas)
    assert "Python" not in plan


@pytest.mark.parametrize("name", ["upsert_merge", "upsert_replace", "resolve_parent", "constraint_audit", "merge_map", "read_existing"])
def test_no_all_pairs_joins(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_unbounded_collect_in_the_library():
    # Bucket numbers: one per bucket. Counts by pivot, and by wave or hash prefix.
    allowed = {"tables.py": 1, "store.py": 1, "percentile.py": 1, "frontier.py": 1}
    for path in LIBRARY.rglob("*.py"):
        if path.parent.name == "llm":  # has a list of its own, beside its tests
            continue
        n = len(re.findall(r"\.(?:collect|toPandas|toLocalIterator)\(\)", path.read_text()))
        assert n <= allowed.get(path.name, 0), path


def test_no_local_checkpoints():
    assert not any("localCheckpoint" in p.read_text() for p in LIBRARY.rglob("*.py"))
