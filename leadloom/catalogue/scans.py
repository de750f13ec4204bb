"""Scans, projections, filters, unions and sorts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ci, normalise_text
from ..operators import left_join, precedence_union, row_count
from ..plans.segment_mix import scheduled_actions
from ..session import stage
from ..sources import Entities
from .registry import as_doubles, double, query


@query("scan", "SELECT * FROM crm_lead")
def scan(e: Entities) -> DataFrame:
    return e.crm_lead


@query(
    "role_playing_scan",
    """SELECT booking.apt_date, count(*) AS joined_rows, count(own.id) AS lead_matches,
              count(via_account.id) AS account_matches
       FROM consult booking
       LEFT JOIN crm_lead own ON booking.scheduled_lead = own.id
       LEFT JOIN crm_lead via_account ON booking.scheduled_account = via_account.convertedaccountid
       GROUP BY booking.apt_date""",
)
def role_playing_scan(e: Entities) -> DataFrame:
    """Leads by their own id, and again by their account; the copies are counted, not formed."""
    by_id = e.crm_lead.select("id", F.lit(1).alias("is_lead"))
    by_account = e.crm_lead.groupBy("convertedaccountid").agg(row_count().alias("copies"))
    booked = e.consult.groupBy("apt_date", "scheduled_lead", "scheduled_account").agg(
        row_count().alias("consults")
    )
    known = left_join(
        left_join(booked, by_id, [("scheduled_lead", "id")]),
        by_account,
        [("scheduled_account", "convertedaccountid")],
    )
    rows = F.col("consults") * F.coalesce("copies", F.lit(1))
    return known.groupBy("apt_date").agg(
        F.sum(rows).alias("joined_rows"),
        F.sum(F.when(F.col("is_lead") == 1, rows).otherwise(0)).alias("lead_matches"),
        F.sum(F.col("consults") * F.coalesce("copies", F.lit(0))).alias("account_matches"),
    )


@query(
    "derived_table",
    """SELECT crm_lead.id, (SELECT count(*) FROM apt_history
                            WHERE lead_id = crm_lead.id AND lower(rtrim(action)) = 'scheduled') AS schedules
       FROM crm_lead""",
)
def derived_table(e: Entities) -> DataFrame:
    per_lead = scheduled_actions(e.apt_history).groupBy("lead_id").agg(F.count("lead_id").alias("n"))
    return (
        e.crm_lead.select("id")
        .join(per_lead, F.col("id") == F.col("lead_id"), "left")
        .select("id", F.coalesce("n", F.lit(0)).alias("schedules"))
    )


@query(
    "cte_chain",
    """WITH offers AS (SELECT accountid, count(*) AS quotes FROM quote GROUP BY accountid),
            plans AS (SELECT account, count(*) AS plans FROM treatment_plan GROUP BY account)
       SELECT id, quotes, plans FROM crm_account
       LEFT JOIN offers ON id = accountid LEFT JOIN plans ON id = account""",
)
def cte_chain(e: Entities) -> DataFrame:
    offers = e.quote.groupBy("accountid").agg(row_count().alias("quotes"))
    plans = e.treatment_plan.groupBy("account").agg(row_count().alias("plans"))
    accounts = e.crm_account.select("id")
    return (
        accounts.join(offers, F.col("id") == F.col("accountid"), "left")
        .join(plans, F.col("id") == F.col("account"), "left")
        .select("id", "quotes", "plans")
    )


@query(
    "staged_result",
    """SELECT scheduled_by, apt_date, count(*) AS n FROM consult
       WHERE scheduled_by IS NOT NULL AND apt_date IS NOT NULL GROUP BY scheduled_by, apt_date
       QUALIFY rank() OVER (PARTITION BY scheduled_by ORDER BY count(*) DESC) = 1""",
)
def staged_result(e: Entities) -> DataFrame:
    """The busiest dates of each agent; the daily counts are staged and read twice."""
    dated = e.consult.dropna(subset=["scheduled_by", "apt_date"])
    days = stage(dated.groupBy("scheduled_by", "apt_date").agg(row_count().alias("n")))
    busiest = days.groupBy("scheduled_by").agg(F.max("n").alias("n"))
    return days.join(busiest, ["scheduled_by", "n"], "inner").select("scheduled_by", "apt_date", "n")


@query(
    "project_rename",
    "SELECT id AS account_id, createddate AS created_date, warranty_id AS unique_id FROM crm_account",
)
def project_rename(e: Entities) -> DataFrame:
    return e.crm_account.select(
        F.col("id").alias("account_id"),
        F.col("createddate").alias("created_date"),
        F.col("warranty_id").alias("unique_id"),
    )


@query(
    "star_expand",
    """SELECT entry.*, agent.name AS agent_name FROM apt_history entry LEFT JOIN agent ON entry.createdbyid = agent.id""",
)
def star_expand(e: Entities) -> DataFrame:
    entry, agent = e.apt_history.alias("entry"), e.agent.alias("agent")
    return entry.join(agent, F.col("entry.createdbyid") == F.col("agent.id"), "left").select(
        "entry.*", F.col("agent.name").alias("agent_name")
    )


@query("literal_column", "SELECT id, cast(0 AS int) AS start, cast(1 AS int) AS present FROM crm_account")
def literal_column(e: Entities) -> DataFrame:
    return e.crm_account.select("id", F.lit(0).alias("start"), F.lit(1).alias("present"))


@query(
    "arith_project",
    """SELECT leadid, cast(revenue_sold - collected AS double) AS open_amount,
              cast(num_consult_completed AS double) * 100.0 / num_consult_appointments AS completed_percentage
       FROM mkt_info""",
)
def arith_project(e: Entities) -> DataFrame:
    return e.mkt_info.select(
        "leadid",
        double(F.col("revenue_sold") - F.col("collected")).alias("open_amount"),
        (double("num_consult_completed") * 100.0 / F.col("num_consult_appointments")).alias("completed_percentage"),
    )


@query(
    "filter_compare",
    """SELECT id, apt_date, start_hour, color FROM consult
       WHERE apt_date >= date '1997-01-01' AND active AND lower(rtrim(color)) <> 'network purple'""",
)
def filter_compare(e: Entities) -> DataFrame:
    return e.consult.where(
        (F.col("apt_date") >= F.lit(dt.date(1997, 1, 1))) & F.col("active") & (ci("color") != "network purple")
    ).select("id", "apt_date", "start_hour", "color")


@query(
    "filter_between",
    """SELECT id, createddate, lead_segment FROM crm_lead
       WHERE createddate BETWEEN timestamp '1996-07-01' AND timestamp '1998-12-31'
         AND lead_segment BETWEEN 4 AND 5""",
)
def filter_between(e: Entities) -> DataFrame:
    return e.crm_lead.where(
        F.col("createddate").between(F.lit(dt.date(1996, 7, 1)), F.lit(dt.date(1998, 12, 31)))
        & F.col("lead_segment").between(4, 5)
    ).select("id", "createddate", "lead_segment")


@query(
    "filter_in_list",
    "SELECT id, pre_screen FROM crm_lead WHERE lower(rtrim(pre_screen)) IN ('green', 'yellow')",
)
def filter_in_list(e: Entities) -> DataFrame:
    return e.crm_lead.where(ci("pre_screen").isin("green", "yellow")).select("id", "pre_screen")


@query(
    "not_in_list",
    """SELECT id, cast(coalesce(lower(rtrim(pre_screen)) NOT IN ('green', 'yellow', 'red'), false) AS int) AS is_other
       FROM crm_lead""",
)
def not_in_list(e: Entities) -> DataFrame:
    unlisted = ~ci("pre_screen").isin("green", "yellow", "red")
    return e.crm_lead.select("id", F.when(unlisted, 1).otherwise(0).alias("is_other"))


@query(
    "null_tests",
    """SELECT id, scheduled_lead, scheduled_account FROM consult
       WHERE coalesce(scheduled_lead, scheduled_account) IS NOT NULL AND arrival_time IS NOT NULL
         AND scheduled_account IS NULL""",
)
def null_tests(e: Entities) -> DataFrame:
    return e.consult.where(
        F.coalesce("scheduled_lead", "scheduled_account").isNotNull()
        & F.col("arrival_time").isNotNull()
        & F.col("scheduled_account").isNull()
    ).select("id", "scheduled_lead", "scheduled_account")


@query(
    "conjunction",
    """SELECT id, recordtypeid, createddate, warranty_id FROM crm_account
       WHERE lower(rtrim(recordtypeid)) = 'building' AND createddate >= date '2020-01-01'
         AND model_tier IS NULL AND warranty_id IS NOT NULL""",
)
def conjunction(e: Entities) -> DataFrame:
    return e.crm_account.where(
        (ci("recordtypeid") == "building")
        & (F.col("createddate") >= F.lit(dt.date(2020, 1, 1)))
        & F.col("model_tier").isNull()
        & F.col("warranty_id").isNotNull()
    ).select("id", "recordtypeid", "createddate", "warranty_id")


@query(
    "ci_match",
    "SELECT id, pre_screen FROM crm_lead WHERE lower(rtrim(pre_screen)) = lower(rtrim('YELLOW  '))",
)
def ci_match(e: Entities) -> DataFrame:
    return e.crm_lead.where(ci("pre_screen") == ci(F.lit("YELLOW  "))).select("id", "pre_screen")


@query(
    "normalise_text",
    """SELECT id, center, pre_screen, lower(rtrim(center)) AS center_key, lower(rtrim(pre_screen)) AS pre_screen_key
       FROM mkt_lead""",
)
def normalised(e: Entities) -> DataFrame:
    return normalise_text(e.mkt_lead.select("id", "center", "pre_screen"), ["center", "pre_screen"])


@query(
    "union_all",
    """SELECT accountid, cast(price AS double) AS cost FROM quote
       UNION ALL SELECT account AS accountid, cast(initial_cost AS double) AS cost FROM treatment_plan""",
)
def union_all(e: Entities) -> DataFrame:
    return e.quote.select("accountid", double("price").alias("cost")).unionByName(
        e.treatment_plan.select(F.col("account").alias("accountid"), double("initial_cost").alias("cost"))
    )


_COSTS = """
    quotes AS (SELECT accountid, count(*) AS offers, cast(min(price) AS double) AS minimum_cost
               FROM quote{where} GROUP BY accountid),
    plans AS (SELECT account AS accountid, count(*) AS offers, cast(min(initial_cost) AS double) AS minimum_cost
              FROM treatment_plan GROUP BY account)
"""


@query(
    "precedence_union",
    "WITH "
    + _COSTS.format(where=" WHERE accountid IS NOT NULL")
    + """SELECT coalesce(quotes.accountid, plans.accountid) AS accountid, coalesce(quotes.offers, plans.offers) AS offers,
                CASE WHEN quotes.accountid IS NOT NULL THEN quotes.minimum_cost ELSE plans.minimum_cost END AS minimum_cost
         FROM quotes FULL JOIN plans ON quotes.accountid = plans.accountid
         WHERE coalesce(quotes.accountid, plans.accountid) IS NOT NULL""",
)
def precedence(e: Entities) -> DataFrame:
    quotes = (
        e.quote.where(F.col("accountid").isNotNull())
        .groupBy("accountid")
        .agg(row_count().alias("offers"), F.min("price").alias("minimum_cost"))
    )
    plans = e.treatment_plan.groupBy(F.col("account").alias("accountid")).agg(
        row_count().alias("offers"), F.min("initial_cost").alias("minimum_cost")
    )
    return as_doubles(precedence_union(quotes, plans, "accountid"), ["minimum_cost"])


@query(
    "order_desc",
    "SELECT id, createddate, lead_segment FROM crm_lead ORDER BY lead_segment DESC NULLS LAST, id",
)
def order_desc(e: Entities) -> DataFrame:
    """The id ends the sort, so equal segments can go to different tasks."""
    return e.crm_lead.select("id", "createddate", "lead_segment").orderBy(
        F.col("lead_segment").desc_nulls_last(), "id"
    )


@query("order_asc", "SELECT id, center, lead_date FROM mkt_lead ORDER BY center ASC NULLS FIRST, id")
def order_asc(e: Entities) -> DataFrame:
    return e.mkt_lead.select("id", "center", "lead_date").orderBy(F.col("center").asc_nulls_first(), "id")
