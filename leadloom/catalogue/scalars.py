"""Scalar functions."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import first_value_of, net_amount, null_label, rolling_month_start
from ..operators import row_count
from ..plans import campaign_type_rules, commission_rules
from ..plans.commission_points import (
    FULL_POINTS,
    FULL_RATE_PRE_SCREENS,
    FULL_RATE_SEGMENTS,
    OTHER_POINTS,
    REDUCED_POINTS,
    REDUCED_RATE_PRE_SCREENS,
    REDUCED_RATE_SEGMENTS,
)
from ..plans.lead_dashboard import CAMPAIGN_TYPES, OTHER
from ..sources import Entities
from .registry import double, query, quoted


@query(
    "coalesce_columns",
    "SELECT id, coalesce(scheduled_lead, scheduled_account) AS subject FROM consult",
)
def coalesce_columns(e: Entities) -> DataFrame:
    return e.consult.select("id", first_value_of("scheduled_lead", "scheduled_account").alias("subject"))


@query(
    "null_default",
    """SELECT id, coalesce(last_name, '') AS last_name, coalesce(email, '') AS email, coalesce(center, 'none') AS center
       FROM mkt_lead""",
)
def null_default(e: Entities) -> DataFrame:
    return e.mkt_lead.select(
        "id",
        F.coalesce("last_name", F.lit("")).alias("last_name"),
        F.coalesce("email", F.lit("")).alias("email"),
        F.coalesce("center", F.lit("none")).alias("center"),
    )


def _campaign_type_sql() -> str:
    rules = [
        f"WHEN {' AND '.join(f"lower(rtrim(campaign.{c})) = '{v}'" for c, v in attributes.items())} THEN '{label}'"
        for attributes, label in CAMPAIGN_TYPES
    ]
    return f"CASE {' '.join(rules)} ELSE '{OTHER}' END"


CAMPAIGN_TYPE_SQL = _campaign_type_sql()


@query(
    "case_map",
    f"""SELECT mkt_lead.id, {CAMPAIGN_TYPE_SQL} AS campaign_type
        FROM mkt_lead LEFT JOIN campaign ON first_creative_id = campaign.id""",
)
def case_map_query(e: Entities) -> DataFrame:
    typed = e.campaign.select(
        F.col("id").alias("campaign_id"), campaign_type_rules("media", "agency", "type").alias("campaign_type")
    )
    leads = e.mkt_lead.select("id", "first_creative_id")
    return leads.join(typed, F.col("first_creative_id") == F.col("campaign_id"), "left").select(
        "id", F.coalesce("campaign_type", F.lit("Other")).alias("campaign_type")
    )


@query("null_label", "SELECT id, ifnull(center, 'Partial') AS center_name FROM mkt_lead")
def null_label_query(e: Entities) -> DataFrame:
    return e.mkt_lead.select("id", null_label("center", "Partial").alias("center_name"))


@query("cast_date", "SELECT id, cast(apt_datetime AS date) AS apt_day FROM consult")
def cast_date(e: Entities) -> DataFrame:
    return e.consult.select("id", F.col("apt_datetime").cast("date").alias("apt_day"))


@query("hour_of", "SELECT id, cast(hour(apt_datetime) AS integer) AS apt_hour FROM consult")
def hour_of(e: Entities) -> DataFrame:
    return e.consult.select("id", F.hour("apt_datetime").alias("apt_hour"))


@query("month_of", "SELECT id, cast(month(apt_date) AS integer) AS apt_month FROM consult")
def month_of(e: Entities) -> DataFrame:
    return e.consult.select("id", F.month("apt_date").alias("apt_month"))


@query("year_of", "SELECT id, cast(year(apt_date) AS integer) AS apt_year FROM consult")
def year_of(e: Entities) -> DataFrame:
    return e.consult.select("id", F.year("apt_date").alias("apt_year"))


@query("add_months", "SELECT id, cast(lead_date - interval '24' month AS date) AS two_years_before FROM mkt_lead")
def add_months(e: Entities) -> DataFrame:
    return e.mkt_lead.select("id", F.add_months("lead_date", -24).alias("two_years_before"))


@query(
    "date_from_parts",
    "SELECT id, make_date(year(lead_date), month(lead_date), 1) AS month_start FROM mkt_lead",
)
def date_from_parts(e: Entities) -> DataFrame:
    return e.mkt_lead.select(
        "id", F.make_date(F.year("lead_date"), F.month("lead_date"), F.lit(1)).alias("month_start")
    )


@query(
    "rolling_month_start",
    """SELECT id, lead_date FROM mkt_lead
       WHERE lead_date >= date_trunc('month', date '2001-08-31') - interval '24' month""",
)
def rolling_month_start_query(e: Entities) -> DataFrame:
    start = rolling_month_start(dt.date(2001, 8, 31), 24)
    return e.mkt_lead.where(F.col("lead_date") >= start).select("id", "lead_date")


@query(
    "percent",
    """SELECT action, cast(count(lead_id) AS double) * 100.0 / cast(count(*) AS double) AS lead_percentage
       FROM apt_history GROUP BY action""",
)
def percent(e: Entities) -> DataFrame:
    share = double(F.count("lead_id")) * 100.0 / double(row_count())
    return e.apt_history.groupBy("action").agg(share.alias("lead_percentage"))


def _rate_sql(segments: tuple[int, int], screens: list[str], points: Decimal) -> str:
    return f"WHEN segment BETWEEN {segments[0]} AND {segments[1]} AND screen IN ({quoted(screens)}) THEN {points}"


POINTS_SQL = f"""CASE {_rate_sql(FULL_RATE_SEGMENTS, FULL_RATE_PRE_SCREENS, FULL_POINTS)}
    {_rate_sql(REDUCED_RATE_SEGMENTS, REDUCED_RATE_PRE_SCREENS, REDUCED_POINTS)} ELSE {OTHER_POINTS} END"""


@query(
    "decimal_points",
    f"""SELECT id, cast({POINTS_SQL} AS double) AS points
        FROM (SELECT id, lead_segment AS segment, lower(rtrim(pre_screen)) AS screen FROM crm_lead) rated""",
)
def decimal_points(e: Entities) -> DataFrame:
    return e.crm_lead.select("id", double(commission_rules("pre_screen", "lead_segment")).alias("points"))


@query(
    "net_amount",
    "SELECT leadid, cast(coalesce(collected, 0) - coalesce(refunded, 0) AS double) AS net_collected FROM mkt_info",
)
def net_amount_query(e: Entities) -> DataFrame:
    return e.mkt_info.select("leadid", double(net_amount("collected", "refunded")).alias("net_collected"))
