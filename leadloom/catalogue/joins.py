"""Joins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ci, identity_key
from ..operators import duplicate_rank, exclude_reversed, fallback_attribute, left_join, not_in, row_count
from ..plans import segment_totals
from ..plans.commission_points import arrived_consults, cancellations
from ..plans.lead_dashboard import IDENTITY, WEB_CREATOR
from ..sources import Entities
from .rankings import OCCURRENCE_SQL, SINCE, identity_list
from .registry import as_doubles, query

CUTOFF = dt.date(1996, 1, 1)


@query(
    "inner_join",
    """SELECT quote_line.quoteid, quote_line.product2id, quote.accountid, treatment_class, treatment_grade
       FROM treatment_option JOIN product ON treatment_option.id = legacytreatmentoption
       JOIN quote_line ON product.id = product2id JOIN quote ON quote.id = quoteid""",
)
def inner_join(e: Entities) -> DataFrame:
    options = e.treatment_option.withColumnRenamed("id", "option_id")
    # The two lookups meet first: they are small, and drop lines before the large join.
    offered = e.product.join(options, F.col("legacytreatmentoption") == F.col("option_id"), "inner").select(
        F.col("id").alias("product2id"), "treatment_class", "treatment_grade"
    )
    quotes = e.quote.select(F.col("id").alias("quoteid"), "accountid")
    return (
        e.quote_line.join(offered, "product2id", "inner")
        .join(quotes, "quoteid", "inner")
        .select("quoteid", "product2id", "accountid", "treatment_class", "treatment_grade")
    )


@query(
    "left_join",
    """SELECT consult.id, scheduled_lead, apt_date, lead_segment
       FROM consult LEFT JOIN crm_lead ON scheduled_lead = crm_lead.id""",
)
def left_join_query(e: Entities) -> DataFrame:
    """Half of the consults have no lead; those rows are spread over the tasks."""
    consults = e.consult.select("id", "scheduled_lead", "apt_date")
    segments = e.crm_lead.select(F.col("id").alias("lead_id"), "lead_segment")
    return left_join(consults, segments, [("scheduled_lead", "lead_id")])


@query(
    "left_join_multikey",
    """SELECT entry.createdbyid, count(*) AS joined_rows, count(completes.lead_id) AS completes
       FROM apt_history entry LEFT JOIN completes USING (lead_id, consultinventory_id)
       WHERE lower(rtrim(entry.action)) = 'scheduled' GROUP BY entry.createdbyid""",
)
def left_join_multikey(e: Entities) -> DataFrame:
    """Both sides are counted per key first; repeated keys multiply as numbers."""
    key = ["lead_id", "consultinventory_id"]
    schedules = (
        e.apt_history.where(ci("action") == "scheduled").groupBy("createdbyid", *key).agg(row_count().alias("schedules"))
    )
    done = e.completes.groupBy(*key).agg(row_count().alias("done"))
    joined = left_join(schedules, done, [(k, k) for k in key])
    return joined.groupBy("createdbyid").agg(
        F.sum(F.col("schedules") * F.coalesce("done", F.lit(1))).alias("joined_rows"),
        F.sum(F.col("schedules") * F.coalesce("done", F.lit(0))).alias("completes"),
    )


@query(
    "join_on_cast",
    """SELECT id, apt_datetime, media_week
       FROM consult LEFT JOIN calendar ON actual_date = cast(apt_datetime AS date)""",
)
def join_on_cast(e: Entities) -> DataFrame:
    consults = e.consult.select("id", "apt_datetime", F.col("apt_datetime").cast("date").alias("apt_day"))
    days = e.calendar.select(F.col("actual_date").cast("date").alias("day"), "media_week")
    return consults.join(days, F.col("apt_day") == F.col("day"), "left").select("id", "apt_datetime", "media_week")


@query(
    "join_filtered_right",
    f"""SELECT mkt_lead.id, mkt_lead.lead_date, ranked.rn FROM mkt_lead LEFT JOIN (
            SELECT id, {OCCURRENCE_SQL} AS rn FROM mkt_lead WHERE lead_date >= date '1999-08-01') ranked USING (id)""",
)
def join_filtered_right(e: Entities) -> DataFrame:
    ranked = duplicate_rank(e.mkt_lead, "id", IDENTITY, "lead_date", SINCE).select(F.col("id").alias("dup_id"), "rn")
    leads = e.mkt_lead.select("id", "lead_date")
    return leads.join(ranked, F.col("id") == F.col("dup_id"), "left").drop("dup_id")


@query(
    "join_coalesced_key",
    """WITH booked AS (SELECT coalesce(scheduled_lead, scheduled_account) AS subject, count(*) AS consults
                       FROM consult GROUP BY 1),
            cancelled AS (SELECT coalesce(lead_id, account_id) AS subject, count(*) AS cancels
                          FROM apt_history WHERE lower(rtrim(action)) = 'cancel' GROUP BY 1)
       SELECT subject, consults, cancels FROM booked JOIN cancelled USING (subject)""",
)
def join_coalesced_key(e: Entities) -> DataFrame:
    booked = e.consult.groupBy(F.coalesce("scheduled_lead", "scheduled_account").alias("subject")).agg(
        row_count().alias("consults")
    )
    cancelled = (
        e.apt_history.where(ci("action") == "cancel")
        .groupBy(F.coalesce("lead_id", "account_id").alias("subject"))
        .agg(row_count().alias("cancels"))
    )
    return booked.join(cancelled, "subject", "inner")


@query(
    "anti_join",
    """SELECT id, createddate FROM crm_lead
       WHERE NOT EXISTS (SELECT 1 FROM revenue WHERE revenue.leadid = crm_lead.id)""",
)
def anti_join(e: Entities) -> DataFrame:
    paying = e.revenue.select("leadid").dropna().distinct()
    return (
        e.crm_lead.select("id", "createddate").join(paying, F.col("id") == F.col("leadid"), "left_anti")
    )


@query(
    "exclude_reversed",
    """SELECT id, coalesce(scheduled_lead, scheduled_account) AS subject, scheduled_by AS agent, apt_date
       FROM consult
       WHERE active AND arrival_time IS NOT NULL AND apt_date >= date '1996-01-01'
         AND consult_room IN (SELECT id FROM consult_room WHERE lower(rtrim(room_type)) <> 'practice')
         AND NOT EXISTS (
             SELECT 1 FROM apt_history gone
             WHERE lower(rtrim(gone.action)) = 'cancel' AND gone.createddate >= timestamp '1996-01-01'
               AND gone.createdbyid IN (SELECT id FROM agent) AND gone.createdbyid = consult.scheduled_by
               AND coalesce(gone.lead_id, gone.account_id)
                   = coalesce(consult.scheduled_lead, consult.scheduled_account))""",
)
def exclude_reversed_query(e: Entities) -> DataFrame:
    consults = arrived_consults(e.consult, e.consult_room, CUTOFF).select(
        "id",
        F.coalesce("scheduled_lead", "scheduled_account").alias("subject"),
        F.col("scheduled_by").alias("agent"),
        "apt_date",
    )
    return exclude_reversed(consults, cancellations(e.apt_history, e.agent, CUTOFF), ["subject", "agent"])


@query(
    "null_aware_anti_join",
    """SELECT account, treatment_option, cast(initial_cost AS double) AS initial_cost FROM treatment_plan
       WHERE account NOT IN (SELECT accountid FROM quote WHERE accountid IS NOT NULL)""",
)
def null_aware_anti_join(e: Entities) -> DataFrame:
    known = e.quote.where(F.col("accountid").isNotNull())
    return as_doubles(not_in(e.treatment_plan, known, "account", "accountid"), ["initial_cost"])


@query(
    "not_in",
    """SELECT 'with null' AS quotes, count(*) AS plans FROM treatment_plan
       WHERE account NOT IN (SELECT accountid FROM quote)
       UNION ALL
       SELECT 'without null' AS quotes, count(*) AS plans FROM treatment_plan
       WHERE account NOT IN (SELECT accountid FROM quote WHERE accountid IS NOT NULL)
       UNION ALL
       SELECT 'none' AS quotes, count(*) AS plans FROM treatment_plan
       WHERE account NOT IN (SELECT accountid FROM quote WHERE price < 0)""",
)
def not_in_query(e: Entities) -> DataFrame:
    """The null rules: a null on the right, none, and an empty right side."""
    sides = {
        "with null": e.quote,
        "without null": e.quote.where(F.col("accountid").isNotNull()),
        "none": e.quote.where(F.col("price") < 0),
    }
    counts = [
        not_in(e.treatment_plan, side, "account", "accountid")
        .agg(row_count().alias("plans"))
        .select(F.lit(name).alias("quotes"), "plans")
        for name, side in sides.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


ADDRESS = ["street", "postal_code"]


@query(
    "null_normalised_key_join",
    f"""WITH addressed AS (
            SELECT {identity_list(["street"])[0]} AS street, {identity_list(["postal_code"])[0]} AS postal_code,
                   ifnull(lower(rtrim(created_by_name)) = 'website api', false) AS is_web FROM mkt_lead)
        SELECT street, postal_code, count(*) FILTER (WHERE is_web) AS web_leads,
               count(*) FILTER (WHERE NOT is_web) AS other_leads
        FROM addressed GROUP BY street, postal_code HAVING web_leads > 0 AND other_leads > 0""",
)
def null_normalised_key_join(e: Entities) -> DataFrame:
    """Web and other leads per address; null and blank address fields are equal, an unknown creator is not the web."""
    keys = [identity_key(c).alias(c) for c in ADDRESS]
    is_web = F.coalesce(ci("created_by_name") == WEB_CREATOR, F.lit(False))
    web = e.mkt_lead.where(is_web).groupBy(*keys).agg(row_count().alias("web_leads"))
    other = e.mkt_lead.where(~is_web).groupBy(*keys).agg(row_count().alias("other_leads"))
    return web.join(other, ADDRESS, "inner")


@query(
    "self_join",
    f"""WITH keyed AS (
            SELECT id, {identity_list(["last_name"])[0]} AS last_name, {identity_list(["email"])[0]} AS email FROM mkt_lead)
        SELECT a.last_name, a.email, count(*) AS ordered_pairs
        FROM keyed a JOIN keyed b ON a.last_name = b.last_name AND a.email = b.email AND a.id <> b.id
        GROUP BY a.last_name, a.email""",
)
def self_join(e: Entities) -> DataFrame:
    """Pairs of leads with the same name and mail, counted from the group sizes."""
    sizes = e.mkt_lead.groupBy(identity_key("last_name").alias("last_name"), identity_key("email").alias("email")).agg(
        row_count().alias("n")
    )
    return sizes.where(F.col("n") > 1).select("last_name", "email", (F.col("n") * (F.col("n") - 1)).alias("ordered_pairs"))


@query(
    "calendar_join",
    """SELECT id, apt_date, media_week, media_month FROM consult LEFT JOIN calendar ON apt_date = actual_date""",
)
def calendar_join(e: Entities) -> DataFrame:
    return (
        e.consult.select("id", "apt_date")
        .join(e.calendar, F.col("apt_date") == F.col("actual_date"), "left")
        .drop("actual_date")
    )


@query(
    "outer_reduced_to_inner",
    """SELECT consult.id, apt_date, consult_room.name AS room
       FROM consult LEFT JOIN consult_room ON consult.consult_room = consult_room.id
       WHERE lower(rtrim(room_type)) <> 'practice'""",
)
def outer_reduced_to_inner(e: Entities) -> DataFrame:
    rooms = e.consult_room.where(ci("room_type") != "practice").select(
        F.col("id").alias("room_id"), F.col("name").alias("room")
    )
    return (
        e.consult.select("id", "apt_date", "consult_room")
        .join(rooms, F.col("consult_room") == F.col("room_id"), "inner")
        .select("id", "apt_date", "room")
    )


@query(
    "dual_lookup_fallback",
    """SELECT lower(rtrim(ifnull(crm_lead.pre_screen, crm_account.pre_screen))) AS pre_screen, count(*) AS consults
       FROM consult LEFT JOIN crm_lead ON scheduled_lead = crm_lead.id
       LEFT JOIN crm_account ON scheduled_account = crm_account.id GROUP BY 1""",
)
def dual_lookup_fallback(e: Entities) -> DataFrame:
    booked = e.consult.groupBy("scheduled_lead", "scheduled_account").agg(row_count().alias("consults"))
    leads = e.crm_lead.select(F.col("id").alias("lead_id"), F.col("pre_screen").alias("lead_screen"))
    accounts = e.crm_account.select(F.col("id").alias("account_id"), F.col("pre_screen").alias("account_screen"))
    known = left_join(
        left_join(booked, leads, [("scheduled_lead", "lead_id")]), accounts, [("scheduled_account", "account_id")]
    )
    return known.groupBy(ci(F.coalesce("lead_screen", "account_screen")).alias("pre_screen")).agg(
        F.sum("consults").alias("consults")
    )


@query(
    "fallback_attribute",
    """SELECT consult.id, apt_date, ifnull(crm_lead.pre_screen, crm_account.pre_screen) AS pre_screen,
              ifnull(crm_lead.lead_segment, crm_account.lead_segment) AS lead_segment
       FROM consult LEFT JOIN crm_lead ON scheduled_lead = crm_lead.id
       LEFT JOIN crm_account ON scheduled_account = crm_account.id""",
)
def fallback_attribute_query(e: Entities) -> DataFrame:
    return fallback_attribute(
        e.consult.select("id", "apt_date", "scheduled_lead", "scheduled_account"),
        [(e.crm_lead, "scheduled_lead", "id"), (e.crm_account, "scheduled_account", "id")],
        ["pre_screen", "lead_segment"],
    ).drop("scheduled_lead", "scheduled_account")


@query(
    "chained_outer",
    """SELECT consult.id, apt_date, consult_room.name AS room, center.name AS center
       FROM consult LEFT JOIN consult_room ON consult.consult_room = consult_room.id
       LEFT JOIN center ON center_information = center.id""",
)
def chained_outer(e: Entities) -> DataFrame:
    rooms = e.consult_room.select(F.col("id").alias("room_id"), F.col("name").alias("room"), "center_information")
    centres = e.center.select(F.col("id").alias("center_id"), F.col("name").alias("center"))
    return (
        e.consult.select("id", "apt_date", "consult_room")
        .join(rooms, F.col("consult_room") == F.col("room_id"), "left")
        .join(centres, F.col("center_information") == F.col("center_id"), "left")
        .select("id", "apt_date", "room", "center")
    )


@query(
    "fanout_join",
    """SELECT crm_lead.lead_segment, count(*) AS lead_rows, count(booked.lead_id) AS schedules,
              count(completes.lead_id) AS completes, cast(sum(revenue_sold) AS double) AS revenue
       FROM crm_lead LEFT JOIN revenue ON crm_lead.id = leadid
       LEFT JOIN apt_history booked ON crm_lead.id = booked.lead_id AND lower(rtrim(booked.action)) = 'scheduled'
       LEFT JOIN completes ON booked.lead_id = completes.lead_id
            AND booked.consultinventory_id = completes.consultinventory_id
       GROUP BY crm_lead.lead_segment""",
)
def fanout_join(e: Entities) -> DataFrame:
    """Rows of a join that multiplies: metrics times schedules times completions per lead."""
    totals = segment_totals(e.crm_lead.select("id", "lead_segment"), e.revenue, e.apt_history, e.completes)
    return as_doubles(totals, ["revenue"])
