"""Commission points per call-centre agent and month."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import case_map
from ..functions.text import ci
from ..operators.aggregates import merge_spellings, row_count
from ..operators.joins import exclude_reversed, fallback_attribute

# Pre-screen results that earn the full and the reduced rate.
FULL_RATE_PRE_SCREENS = ["green", "yellow"]
REDUCED_RATE_PRE_SCREENS = [
    "red",
    "blue (no hit)",
    "insufficient information",
    "not checked",
    "po box",
    "website down-no prescreen",
]
FULL_RATE_SEGMENTS = (4, 5)
REDUCED_RATE_SEGMENTS = (0, 1)
FULL_POINTS, REDUCED_POINTS, OTHER_POINTS = Decimal("1.00"), Decimal("0.25"), Decimal("0.50")


def commission_rules(pre_screen: Column | str, lead_segment: Column | str) -> Column:
    """Points for one arrived consult; unknown values earn the middle rate."""
    screen = ci(pre_screen)
    segment = F.col(lead_segment) if isinstance(lead_segment, str) else lead_segment
    return case_map(
        [
            (screen.isin(FULL_RATE_PRE_SCREENS) & segment.between(*FULL_RATE_SEGMENTS), FULL_POINTS),
            (screen.isin(REDUCED_RATE_PRE_SCREENS) & segment.between(*REDUCED_RATE_SEGMENTS), REDUCED_POINTS),
        ],
        OTHER_POINTS,
    )


def arrived_consults(consults: DataFrame, rooms: DataFrame, cutoff: dt.date) -> DataFrame:
    """Active consults with an arrival, on or after the cutoff, outside practice rooms."""
    chosen = consults.where(
        F.col("arrival_time").isNotNull() & (F.col("apt_date") >= F.lit(cutoff)) & F.col("active")
    )
    real_rooms = rooms.where(ci("room_type") != "practice").select(F.col("id").alias("_room"))
    return chosen.join(real_rooms, F.col("consult_room") == F.col("_room"), "inner").drop("_room")


def cancellations(history: DataFrame, agents: DataFrame, cutoff: dt.date) -> DataFrame:
    """The (subject, agent) pairs of cancellations made by a known agent."""
    pairs = (
        history.where((ci("action") == "cancel") & (F.col("createddate") >= F.lit(cutoff)))
        .select(F.coalesce("lead_id", "account_id").alias("subject"), F.col("createdbyid").alias("agent"))
        .dropna()
        .distinct()
    )
    known = agents.select(F.col("id").alias("_known"))
    return pairs.join(known, F.col("agent") == F.col("_known"), "left_semi")


def commission_points(
    consults: DataFrame,
    rooms: DataFrame,
    agents: DataFrame,
    leads: DataFrame,
    accounts: DataFrame,
    history: DataFrame,
    *,
    cutoff: dt.date,
    cancelled_from: dt.date | None = None,
    with_year: bool = False,
) -> DataFrame:
    """Points per agent name and month of appointment.

    A consult earns nothing if the scheduling agent ever cancelled an appointment of the
    same lead or account, on or after ``cancelled_from`` (``cutoff`` unless given). Months of
    different years are one row unless ``with_year``.

    Consults that agree on agent, lead, account and month are one weighted row before the
    lookups, so a lead or account with very many consults does not load one task. Names are
    looked up after the points are summed per agent id.
    """
    period = [F.month("apt_date").alias("apt_month")]
    if with_year:
        period.insert(0, F.year("apt_date").alias("apt_year"))
    period_cols = ["apt_year", "apt_month"] if with_year else ["apt_month"]

    booked = (
        arrived_consults(consults, rooms, cutoff)
        .select(F.col("scheduled_by").alias("agent"), "scheduled_lead", "scheduled_account", *period)
        .groupBy("agent", "scheduled_lead", "scheduled_account", *period_cols)
        .agg(row_count().alias("consults"))
        .withColumn("subject", F.coalesce("scheduled_lead", "scheduled_account"))
    )
    kept = exclude_reversed(booked, cancellations(history, agents, cancelled_from or cutoff), ["subject", "agent"])
    rated = fallback_attribute(
        kept,
        [(leads, "scheduled_lead", "id"), (accounts, "scheduled_account", "id")],
        ["pre_screen", "lead_segment"],
    )
    points = commission_rules("pre_screen", "lead_segment") * F.col("consults")
    per_agent = rated.groupBy("agent", *period_cols).agg(F.sum(points).alias("points"))

    named = per_agent.join(
        agents.select("id", F.col("name").alias("sched_agent")), F.col("agent") == F.col("id"), "left"
    )
    per_name = merge_spellings(named, period_cols, ["sched_agent"], ["points"])
    return per_name.select("sched_agent", *period_cols, F.col("points").cast("decimal(22,2)").alias("points"))
