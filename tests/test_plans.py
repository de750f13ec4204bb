"""What Spark plans: shuffles, pruning, push-down, and what must never appear."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import re

import pytest
from pyspark.sql import functions as F

from leadloom import catalogue
from leadloom.operators import (
    exclude_reversed,
    exists_other,
    latest_per_key,
    left_join,
    not_in,
    precedence_union,
    rank_within,
    semi_join,
    share_of_total,
)
from leadloom.sources import Entities

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def final_plan(df) -> str:
    """The plan as it was run, without the initial one."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_no_python_and_no_pairing_of_all_rows(spark, small, name):
    text = plan(catalogue.queries()[name](spark, small))
    assert not re.search(r"Python|Pandas|CartesianProduct|NestedLoop", text)


def test_queries_hold_no_row_limits(spark, small):
    for name in ["scan", "lead_dashboard", "centre_fill", "order_desc"]:
        assert "Limit " not in plan(catalogue.queries()[name](spark, small)).replace("WindowGroupLimit", "")


def test_anti_join_for_reversals(spark, small, conf):
    conf(NO_BROADCAST)
    e = Entities(spark, small)
    events = e.consult.select(F.col("scheduled_lead").alias("subject"), F.col("scheduled_by").alias("agent"))
    reversals = e.apt_history.select(F.col("lead_id").alias("subject"), F.col("createdbyid").alias("agent"))
    text = plan(exclude_reversed(events, reversals, ["subject", "agent"]))
    assert "LeftAnti" in text and "LeftOuter" not in text


def test_not_in_broadcasts_no_keys(spark, small, conf):
    conf(NO_BROADCAST)
    e = Entities(spark, small)
    text = plan(not_in(e.treatment_plan, e.quote, "account", "accountid"))
    assert re.search(r"SortMergeJoin.*LeftAnti", text) and "Broadcast" not in text
    native = plan(spark.sql("SELECT * FROM {l} WHERE account NOT IN (SELECT accountid FROM {r})", l=e.treatment_plan, r=e.quote))
    assert "Broadcast" in native


def test_null_rule_of_not_in_is_applied_before_the_shuffle(spark, small, conf):
    conf(NO_BROADCAST)
    e = Entities(spark, small)
    text = plan(not_in(e.treatment_plan, e.quote, "account", "accountid"))
    left = text.index("LeftAnti")
    assert text.index("Subquery", left) > text.index("Exchange hashpartitioning(account", left)


def test_newest_row_is_cut_on_the_map_side(spark, small):
    leads = Entities(spark, small).crm_lead
    text = plan(latest_per_key(leads, ["convertedaccountid"], "createddate", "id"))
    partial = re.search(r"WindowGroupLimit .*Partial", text)
    assert partial and partial.start() > text.index("Exchange hashpartitioning")


def test_share_of_total_runs_the_grouping_once(spark, small, conf):
    conf(NO_BROADCAST)
    e = Entities(spark, small)
    df = share_of_total(
        e.revenue.join(e.crm_lead, F.col("leadid") == F.col("id")), ["lead_segment"], {"r": F.sum("revenue_sold"), "n": F.count("id")}
    )
    text = final_plan(df)
    assert "Window" not in text
    assert re.search(r"ReusedExchange \[lead_segment[^\n]*Exchange hashpartitioning\(lead_segment", text)


def test_scans_read_only_what_is_needed(spark, small):
    text = plan(catalogue.queries()["segment_mix"](spark, small))
    schemas = {frozenset(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", text)}
    assert frozenset({"o_orderkey", "o_orderdate"}) in schemas
    assert frozenset({"l_orderkey", "l_linenumber", "l_extendedprice"}) in schemas
    assert "GreaterThanOrEqual(o_orderdate,1996-07-01" in text
    assert "EqualTo(l_linestatus,F)" in text


@pytest.mark.parametrize("name", ["segment_mix", "lead_dashboard"])
def test_activity_is_not_sorted_to_find_that_of_the_chosen_leads(spark, small, conf, name):
    """A task holds the chosen leads of its part, not all activity; the planner still broadcasts few leads."""
    text = plan(catalogue.queries()[name](spark, small))
    assert re.search(r"BroadcastHashJoin.*LeftSemi", text)
    conf(NO_BROADCAST)
    text = plan(catalogue.queries()[name](spark, small))
    assert re.search(r"ShuffledHashJoin.*LeftSemi, BuildRight", text) and not re.search(r"SortMergeJoin.*LeftSemi", text)


def test_semi_join_keeps_rows_of_wanted_keys_once(spark, conf):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (1, "d"), (3, "e")], "k bigint, v string")
    wanted = spark.createDataFrame([(1, 0), (1, 1), (None, 2), (3, 3)], "id bigint, x int")
    for options in ({}, NO_BROADCAST):
        conf(options)
        assert sorted(semi_join(left, wanted, "k", "id").collect()) == [(1, "a"), (1, "d"), (3, "e")]


def test_dashboard_window_start_is_a_constant_in_the_scan(spark, small):
    assert "GreaterThanOrEqual(o_orderdate,1999-08-01" in plan(catalogue.queries()["lead_dashboard"](spark, small))


def test_dashboard_shuffles_once_by_lead(spark, small, conf):
    """The joins with first leads and metrics, and the window over spellings, share one shuffle of the leads."""
    text = plan(catalogue.queries()["lead_dashboard"](spark, small))
    assert len(re.findall(r"Exchange hashpartitioning\(id#", text)) == 1
    conf(NO_BROADCAST)
    text = plan(catalogue.queries()["lead_dashboard"](spark, small))
    assert len(re.findall(r"Exchange hashpartitioning\(id#", text)) == 1
    # The metrics by lead: for the semi join, and again behind the lookup of the market.
    assert len(re.findall(r"Exchange hashpartitioning\(leadid#", text)) == 2


@pytest.mark.parametrize("broadcasts", [True, False])
def test_dashboard_sorts_its_metrics_once_without_the_columns_of_the_leads(spark, small, conf, broadcasts):
    """The window over spellings runs before the join, which takes its order; neither has the metrics shuffled again."""
    conf({} if broadcasts else NO_BROADCAST)
    text = plan(catalogue.queries()["lead_dashboard"](spark, small))
    window = text.index("Window [row_number() windowspecdefinition(leadid#")
    assert len(re.findall(r"Exchange hashpartitioning\(leadid#\d+L, \d+\)", text[window:])) == (1 if broadcasts else 2)
    assert not re.search(r"Sort \[leadid#\d+L ASC NULLS FIRST\], false", text)


def test_duplicates_move_no_identity_in_the_join(spark, small, conf):
    conf(NO_BROADCAST)
    text = plan(catalogue.queries()["has_duplicate"](spark, small))
    by_id = re.findall(r"Exchange hashpartitioning\((?:id|_single_id)#[^)]*\)", text)
    assert len(by_id) == 2 and all(x.count("#") == 1 for x in by_id)


SPLIT_EARLY = {
    **NO_BROADCAST,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}


def with_frequent_key(spark):
    """A third of the rows has key 7."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    return spark.range(0, 300_000, 1, 8).select("id", key.alias("k"))


def test_adaptive_execution_splits_a_frequent_key(spark, conf):
    conf(SPLIT_EARLY)
    names = spark.range(5000).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    df = left_join(with_frequent_key(spark), names, [("k", "key")])
    assert df.count() == 300_000
    assert "skew=true" in final_plan(df)


def test_adaptive_execution_splits_a_frequent_key_of_anti_joins(spark, conf):
    conf(SPLIT_EARLY)
    others = spark.range(0, 20_000, 1, 8).select((F.col("id") % 2500 + 2500).alias("k"))
    anti = not_in(with_frequent_key(spark), others, "k")
    assert anti.count() == 200_000
    assert "skew=true" in final_plan(anti)
    kept = exclude_reversed(with_frequent_key(spark), others, ["k"])
    assert kept.count() == 200_000
    assert "skew=true" in final_plan(kept)


def test_rows_without_key_are_spread(spark, conf):
    conf({**NO_BROADCAST, "spark.sql.adaptive.enabled": "false"})
    left = spark.range(0, 80_000, 1, 8).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"))
    right = spark.range(1000).select(F.col("id").alias("key"), F.lit(1).alias("found"))
    spread = left_join(left, right, [("k", "key")]).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in spread) < 15_000
    plain = left.join(right, F.col("k") == F.col("key"), "left").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in plain) > 70_000


def test_range_bound_of_a_date_is_pushed(spark, small):
    e = Entities(spark, small)
    text = plan(e.consult.where(F.col("apt_date") >= F.lit(dt.date(1997, 1, 1))).select("id"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate,1997-01-01", text)


@pytest.mark.parametrize("broadcasts", [True, False])
def test_precedence_union_computes_its_primary_rows_once(spark, small, conf, broadcasts):
    conf({} if broadcasts else NO_BROADCAST)
    e = Entities(spark, small)
    primary = e.quote.select(F.col("accountid").alias("k"), F.col("price").cast("double").alias("v"))
    fallback = e.treatment_plan.select(F.col("account").alias("k"), F.col("initial_cost").cast("double").alias("v"))
    both = precedence_union(primary.where("v <> 12345678"), fallback, "k")
    text = final_plan(both)
    assert len(re.findall(r"Filter .*1\.2345678E7", text)) == 1, text
    # A null among the primary keys leaves no fallback row, so its side needs not run.
    assert "ReusedExchange" in text or "LeftAnti" not in text


def test_exists_forms_no_pairs(spark, small, conf):
    conf(NO_BROADCAST)
    e = Entities(spark, small)
    text = plan(exists_other(e.mkt_lead, e.mkt_lead, ["email"], "id"))
    assert re.search(r"SortMergeJoin.*LeftSemi", text) and "partial_min" in text


def test_ranking_shuffles_its_rows_once(spark, small, conf):
    """The rows themselves go through the shuffle of the window; all else is counts, a sample and one row per cut."""
    conf(NO_BROADCAST)
    e = Entities(spark, small)
    text = plan(rank_within(e.mkt_lead.select("id", "email", "lead_date", "street"), ["email"], ["lead_date", "id"]))
    assert text.count("Window [row_number()") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(_key_hash[^\n]*_slice", text)) <= 2
