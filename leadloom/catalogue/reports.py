"""The five reports on the provided tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import centre_fill, commission_points, lead_dashboard, scoring_features, segment_mix
from ..plans.scoring_features import DEFAULT_ESI
from ..sources import Entities
from .aggregates import FLAGS_SQL, PRE_SCREEN_SQL
from .rankings import OCCURRENCE_SQL
from .registry import as_doubles, query
from .scalars import CAMPAIGN_TYPE_SQL, POINTS_SQL

CHANNELS = {"Website": ["Website API"], "IMC": ["IMC API"]}


@query(
    "segment_mix",
    """WITH joined AS (
           SELECT crm_lead.lead_segment AS segment, booked.lead_id AS schedule, completes.lead_id AS completion, revenue_sold
           FROM crm_lead LEFT JOIN revenue ON crm_lead.id = leadid
           LEFT JOIN apt_history booked ON crm_lead.id = booked.lead_id AND lower(rtrim(booked.action)) = 'scheduled'
           LEFT JOIN completes ON booked.lead_id = completes.lead_id
                AND booked.consultinventory_id = completes.consultinventory_id
           WHERE crm_lead.lead_segment IS NOT NULL AND crm_lead.createddate >= timestamp '1996-07-01'
             AND crm_lead.createddate <= timestamp '1998-12-31'),
         sums AS (
           SELECT segment, cast(count(*) AS double) AS n, cast(count(schedule) AS double) AS s,
                  cast(count(completion) AS double) AS c, sum(revenue_sold) AS r FROM joined GROUP BY segment)
       SELECT segment AS lead_segment, n * 100.0 / (SELECT sum(n) FROM sums) AS lead_percentage,
              s * 100.0 / (SELECT sum(s) FROM sums) AS sched_percentage,
              c * 100.0 / (SELECT sum(c) FROM sums) AS complete_percentage,
              cast(r AS double) * 100.0 / (SELECT cast(sum(r) AS double) FROM sums) AS rev_percentage
       FROM sums""",
)
def segment_mix_query(e: Entities) -> DataFrame:
    return segment_mix(
        e.crm_lead,
        e.revenue,
        e.apt_history,
        e.completes,
        created_from=dt.date(1996, 7, 1),
        created_to=dt.date(1998, 12, 31),
    )


def _scoring_sql(quotes: str) -> str:
    return f"""WITH offers AS (
          SELECT true AS quoted, offer.accountid AS account, offer.id AS item, offer.price AS cost,
                 treatment_class, treatment_grade
          FROM ({quotes}) offer JOIN quote_line ON quoteid = offer.id JOIN product ON product2id = product.id
          JOIN treatment_option ON legacytreatmentoption = treatment_option.id
          UNION ALL
          SELECT false, account, row_number() OVER (), initial_cost, treatment_class, treatment_grade
          FROM treatment_plan LEFT JOIN treatment_option ON treatment_plan.treatment_option = treatment_option.id),
        treated AS (
          SELECT account, count(DISTINCT item) AS treatments_offered,
                 cast(sum(cost) AS double) / nullif(count(cost), 0) AS average_cost,
                 cast(min(cost) AS double) AS minimum_cost, cast(max(cost) AS double) AS maximum_cost, {FLAGS_SQL}
          FROM offers WHERE quoted OR account NOT IN (SELECT account FROM offers WHERE quoted) GROUP BY account),
        newest AS (
          SELECT DISTINCT ON (convertedaccountid) convertedaccountid, id AS lead_id FROM crm_lead
          ORDER BY convertedaccountid, createddate DESC NULLS LAST, id)
       SELECT crm_account.id AS account_id, crm_account.createddate AS created_date, warranty_id AS unique_id,
              financing_result, crm_account.lead_segment AS account_lead_segment,
              dental_condition AS account_dental_condition, distance_to_center AS account_distance_to_center,
              ifnull((SELECT min(esi) FROM esi WHERE lead = lead_id), {DEFAULT_ESI}) AS economic_stability_indicator,
              treated.* EXCLUDE (account), cast(0 AS int) AS start
       FROM crm_account JOIN treated ON account = crm_account.id
       LEFT JOIN newest ON convertedaccountid = crm_account.id
       WHERE recordtypeid IN ('BUILDING', 'MACHINERY') AND crm_account.createddate >= date '2020-01-01'
         AND model_tier IS NULL AND warranty_id IS NOT NULL"""


def _scoring(e: Entities, quotes: DataFrame) -> DataFrame:
    features = scoring_features(
        e.crm_account,
        e.crm_lead,
        quotes,
        e.quote_line,
        e.product,
        e.treatment_option,
        e.treatment_plan,
        e.esi,
        record_types=["BUILDING", "MACHINERY"],
    )
    return as_doubles(features, ["minimum_cost", "maximum_cost"])


@query("scoring_features", _scoring_sql("SELECT * FROM quote"))
def scoring_features_query(e: Entities) -> DataFrame:
    """With a quote that has no account, so plans contribute nothing."""
    return _scoring(e, e.quote)


@query(
    "scoring_features_known_accounts",
    _scoring_sql("SELECT * FROM quote WHERE accountid IS NOT NULL"),
)
def scoring_features_known_accounts(e: Entities) -> DataFrame:
    """Only quotes with an account, so plans fill in for accounts without quotes."""
    return _scoring(e, e.quote.where(F.col("accountid").isNotNull()))


@query(
    "commission_points",
    f"""WITH gone AS (
          SELECT DISTINCT coalesce(lead_id, account_id) AS subject, agent.id AS agent
          FROM apt_history JOIN agent ON agent.id = createdbyid
          WHERE lower(rtrim(action)) = 'cancel' AND createddate >= timestamp '1996-01-01'),
        rated AS (
          SELECT agent.name, month(apt_date) AS apt_month, ifnull(crm_lead.lead_segment, crm_account.lead_segment) AS segment,
                 lower(rtrim(ifnull(crm_lead.pre_screen, crm_account.pre_screen))) AS screen
          FROM consult JOIN consult_room ON consult_room.id = consult.consult_room
          LEFT JOIN agent ON agent.id = scheduled_by
          LEFT JOIN crm_lead ON crm_lead.id = scheduled_lead LEFT JOIN crm_account ON crm_account.id = scheduled_account
          WHERE active AND arrival_time IS NOT NULL AND apt_date >= date '1996-01-01'
            AND lower(rtrim(room_type)) <> 'practice'
            AND NOT EXISTS (SELECT 1 FROM gone WHERE gone.agent = consult.scheduled_by
                            AND gone.subject = ifnull(consult.scheduled_lead, consult.scheduled_account)))
       SELECT min(name) AS sched_agent, cast(apt_month AS integer) AS apt_month,
              cast(sum({POINTS_SQL}) AS double) AS points
       FROM rated GROUP BY lower(rtrim(name)), apt_month""",
)
def commission_points_query(e: Entities) -> DataFrame:
    points = commission_points(
        e.consult, e.consult_room, e.agent, e.crm_lead, e.crm_account, e.apt_history, cutoff=dt.date(1996, 1, 1)
    )
    return as_doubles(points, ["points"])


@query(
    "lead_dashboard",
    f"""WITH recent AS (
          SELECT *, {OCCURRENCE_SQL} AS occurrence FROM mkt_lead WHERE lead_date >= date '1999-08-01'),
        joined AS (
          SELECT recent.id, lead_date AS actual_date, media_week, media_month, ifnull(center, 'Partial') AS center_name,
                 dma.name AS market, in_market, lead_type, {PRE_SCREEN_SQL} AS pre_screen,
                 first_creative_name AS creative, first_media_outlet AS media_outlet, first_campaign_name,
                 last_campaign_name, phone_number,
                 CASE lower(rtrim(created_by_name)) WHEN 'website api' THEN 'Website' WHEN 'imc api' THEN 'IMC'
                     ELSE 'CCMS-Unknown' END AS created_by_channel,
                 {CAMPAIGN_TYPE_SQL} AS campaign_type,
                 lower(rtrim(in_market)) = 'y' AND lower(rtrim(recent.pre_screen)) IN ('green', 'yellow') AS is_good,
                 occurrence, lower(rtrim(created_by_name)) = 'website api' AS from_web, num_consult_appointments,
                 num_consult_completed, net_num_starts, ifnull(collected, 0) - ifnull(refunded, 0) AS net_paid,
                 ifnull(revenue_sold, 0) - ifnull(revenue_cancelled, 0) AS net_revenue
          FROM recent LEFT JOIN mkt_info ON recent.id = leadid LEFT JOIN dma ON dma_id = dma.id
          LEFT JOIN campaign ON first_creative_id = campaign.id)
       SELECT joined.* EXCLUDE (id, is_good, occurrence, from_web, num_consult_appointments, num_consult_completed,
                                net_num_starts, net_paid, net_revenue),
              count(DISTINCT id) AS leads, count(*) FILTER (WHERE is_good) AS gyim_leads,
              cast(sum(num_consult_appointments) AS bigint) AS num_scheds,
              cast(sum(num_consult_completed) AS bigint) AS num_consults,
              cast(sum(net_num_starts) AS bigint) AS net_starts,
              cast(sum(net_paid) AS double) AS net_collected, cast(sum(net_revenue) AS double) AS net_sold,
              count(*) FILTER (WHERE occurrence = 1) AS valid_lead,
              count(*) FILTER (WHERE occurrence > 1) AS duplicate_lead,
              count(*) FILTER (WHERE occurrence > 1 AND from_web) AS duplicate_web_lead
       FROM joined GROUP BY ALL""",
)
def lead_dashboard_query(e: Entities) -> DataFrame:
    report = lead_dashboard(
        e.mkt_lead, e.campaign, e.mkt_info, e.dma, channels=CHANNELS, as_of=dt.date(2001, 8, 1)
    )
    return as_doubles(report, ["net_collected", "net_sold"])


@query(
    "centre_fill",
    """WITH placed AS (
          SELECT center.name AS center_name, lower(rtrim(center.name)) AS center_key,
                 lower(rtrim(consult_room.name)) AS room_key, lower(rtrim(room_type)) AS room_type, consult.*
          FROM consult JOIN consult_room ON consult.consult_room = consult_room.id
          LEFT JOIN center ON center_information = center.id
          WHERE apt_date BETWEEN date '1997-01-01' AND date '1998-12-31'),
        open_slots AS (
          SELECT center_key, min(center_name) AS name, apt_date,
                 count(DISTINCT (room_key, apt_datetime, start_hour)) AS target_consults
          FROM placed WHERE room_type = 'normal' AND active AND lower(rtrim(color)) <> 'network purple'
          GROUP BY center_key, apt_date),
        bookings AS (
          SELECT center_key, apt_date, count(*) AS scheds,
                 count(*) FILTER (WHERE lower(rtrim(ifnull(own.pre_screen, other.pre_screen))) IN ('green', 'yellow'))
                     AS gy_scheds
          FROM placed LEFT JOIN crm_lead own ON scheduled_lead = own.id
          LEFT JOIN crm_lead other ON scheduled_account = other.convertedaccountid
          WHERE room_type <> 'practice' AND ifnull(scheduled_lead, scheduled_account) IS NOT NULL
          GROUP BY center_key, apt_date)
       SELECT name, apt_date, media_week, target_consults, scheds, gy_scheds
       FROM open_slots JOIN calendar ON apt_date = actual_date LEFT JOIN bookings USING (center_key, apt_date)
       WHERE media_week >= date '1997-01-01'""",
)
def centre_fill_query(e: Entities) -> DataFrame:
    return centre_fill(
        e.consult,
        e.consult_room,
        e.center,
        e.crm_lead,
        e.calendar,
        start=dt.date(1997, 1, 1),
        end=dt.date(1998, 12, 31),
    )
