"""Share of leads, schedules, completed consults and revenue per lead segment.

The measures count joined rows: a lead appears once per metric row times once per schedule
times once per completion of that schedule. The pairs are never formed. Each side is
first reduced to one row per lead, and the number of rows the join would have is a product
of the counts. So no join below has a frequent key, and a lead with a million
schedules and a million metric rows costs two rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ci
from ..operators.aggregates import share_of_total
from ..operators.joins import semi_join


def scheduled_actions(history: DataFrame) -> DataFrame:
    """History rows that schedule an appointment for a lead or an account."""
    return history.where(
        (ci("action") == "scheduled") & F.coalesce("lead_id", "account_id").isNotNull()
    )


def visits_per_slot(history: DataFrame, completes: DataFrame) -> DataFrame:
    """Per lead and slot: the number of schedules and of completions.

    Both tables go through one grouping instead of a join. A completion without a slot
    matches nothing; schedules without one stay, and meet no completion.
    """
    keys = ["lead_id", "consultinventory_id"]
    schedules = scheduled_actions(history).where(F.col("lead_id").isNotNull())
    completions = completes.dropna(subset=keys)
    events = schedules.select(*keys, F.lit(1).alias("schedule"), F.lit(0).alias("completion")).unionByName(
        completions.select(*keys, F.lit(0).alias("schedule"), F.lit(1).alias("completion"))
    )
    return events.groupBy(*keys).agg(
        F.sum("schedule").alias("schedules"), F.sum("completion").alias("completions")
    )


def activity_per_lead(metrics: DataFrame, history: DataFrame, completes: DataFrame) -> DataFrame:
    """Per lead: metric rows and revenue; rows of schedules left-joined to completions, and their matches."""
    no_rows, no_revenue = F.lit(0).cast("long"), F.lit(None).cast(metrics.schema["revenue_sold"].dataType)
    visits = visits_per_slot(history, completes).select(
        "lead_id",
        no_rows.alias("metric_rows"),
        no_revenue.alias("revenue"),
        (F.col("schedules") * F.greatest("completions", F.lit(1))).alias("sched_rows"),
        (F.col("schedules") * F.col("completions")).alias("complete_rows"),
    )
    money = metrics.where(F.col("leadid").isNotNull()).select(
        F.col("leadid").alias("lead_id"),
        F.lit(1).cast("long").alias("metric_rows"),
        F.col("revenue_sold").alias("revenue"),
        no_rows.alias("sched_rows"),
        no_rows.alias("complete_rows"),
    )
    sums = ["metric_rows", "revenue", "sched_rows", "complete_rows"]
    return money.unionByName(visits).groupBy("lead_id").agg(*[F.sum(c).alias(c) for c in sums])


def weighted_leads(
    leads: DataFrame, metrics: DataFrame, history: DataFrame, completes: DataFrame
) -> DataFrame:
    """Each lead with the number of joined rows it stands for (``weight``) and its sums."""
    activity = activity_per_lead(metrics, history, completes)
    # An outer join keeps one row where a side has none.
    metric_rows = F.greatest("metric_rows", F.lit(1))
    return leads.join(activity, leads["id"] == activity["lead_id"], "left").select(
        *[leads[c] for c in leads.columns],
        (metric_rows * F.greatest("sched_rows", F.lit(1))).alias("weight"),
        (metric_rows * F.coalesce("sched_rows", F.lit(0))).alias("sched_rows"),
        (metric_rows * F.coalesce("complete_rows", F.lit(0))).alias("complete_rows"),
        (F.col("revenue") * F.greatest("sched_rows", F.lit(1))).alias("revenue"),
    )


def segment_measures() -> dict[str, Column]:
    return {
        "lead_percentage": F.sum("weight"),
        "sched_percentage": F.sum("sched_rows"),
        "complete_percentage": F.sum("complete_rows"),
        "rev_percentage": F.sum("revenue"),
    }


def segment_totals(leads: DataFrame, metrics: DataFrame, history: DataFrame, completes: DataFrame) -> DataFrame:
    """The joined-row counts and revenue behind the shares, per segment."""
    return weighted_leads(leads, metrics, history, completes).groupBy("lead_segment").agg(
        F.sum("weight").alias("lead_rows"),
        F.sum("sched_rows").alias("schedules"),
        F.sum("complete_rows").alias("completes"),
        F.sum("revenue").alias("revenue"),
    )


def segment_mix(
    leads: DataFrame,
    metrics: DataFrame,
    history: DataFrame,
    completes: DataFrame,
    *,
    created_from: dt.date | dt.datetime,
    created_to: dt.date | dt.datetime,
) -> DataFrame:
    """Percentages per lead segment, for leads created in a range.

    Both bounds are included; a date as upper bound means its midnight. No schedules at all
    is a division error, no revenue at all gives null. Activity of other leads is left out
    by a semi join before anything is grouped, so what is grouped follows the range.
    """
    chosen = leads.where(F.col("lead_segment").isNotNull()).where(
        F.col("createddate").between(F.lit(created_from), F.lit(created_to))
    )

    def of_chosen(rows: DataFrame, lead: str) -> DataFrame:
        return semi_join(rows, chosen, lead, "id")

    weighted = weighted_leads(
        chosen.select("id", "lead_segment"),
        of_chosen(metrics, "leadid"),
        of_chosen(scheduled_actions(history), "lead_id"),
        of_chosen(completes, "lead_id"),
    )
    mix = share_of_total(weighted, ["lead_segment"], segment_measures())
    return mix.orderBy(F.col("lead_segment").desc_nulls_last())
