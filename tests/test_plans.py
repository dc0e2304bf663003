"""What reaches the scans, and what no plan may hold."""

import re

import pytest
from conftest import DATA

from tidemark.plans import problems, records, registry, tables


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "4000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(problems.p2_found(spark, DATA))
    assert "EqualTo(window_days,5)" in p and "momentum_score" not in p
    p = plan(tables.scan_partial(spark, DATA))
    assert "EqualTo(predicate,controlled_by)" in p and "EqualTo(subject.market_scope,global)" in p
    assert "struct<entity_id:string,market_scope:string>" in p and "object_ref" not in p
    p = plan(records.announcement_search(spark, DATA))
    assert "GreaterThanOrEqual(publish_date,20250701)" in p and "adjunct_url" not in p
    p = plan(problems.p1_versions(spark, DATA))
    assert "claim" not in p and "tags" not in p


def test_repeats_combine_before_the_shuffle(spark):
    p = plan(problems.p2_found(spark, DATA))
    assert p.count("partial_max") >= 1
    assert plan(tables.pk_dedup_keep_last(spark, DATA)).count("partial_max") == 1


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_plan_pairs_everything_or_runs_python_by_row(spark, name):
    p = plan(registry.queries()[name](spark, DATA))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", p)


def test_large_cross_sections_are_ranked_over_many_tasks(spark, monkeypatch):
    from tidemark.operators import ranks
    from tidemark.plans import features

    small = plan(features.daily_momentum(spark, DATA))
    assert "_r_part" not in small
    monkeypatch.setattr(ranks, "ONE_TASK_BYTES", 0)
    large = plan(features.daily_momentum(spark, DATA))
    assert "_r_part" in large and "rank(" not in large
    got = []
    for most in (0, 10**12):
        monkeypatch.setattr(ranks, "ONE_TASK_BYTES", most)
        got.append(sorted((r.security_id, round(r.momentum_score, 9)) for r in features.daily_momentum(spark, DATA).collect()))
    assert got[0] == got[1] and got[0]
