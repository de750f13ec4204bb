"""Window functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import identity_key
from ..operators import duplicate_rank, exists_other, has_duplicate, latest_per_key
from ..plans.lead_dashboard import IDENTITY
from ..sources import Entities
from .registry import query

SINCE = dt.date(1999, 8, 1)


def identity_list(cols: list[str]) -> list[str]:
    """The comparison keys of identity columns, as SQL."""
    return [f"lower(rtrim(ifnull({c}, '')))" for c in cols]


OCCURRENCE_SQL = f"row_number() OVER (PARTITION BY {', '.join(identity_list(IDENTITY))} ORDER BY lead_date NULLS FIRST, id)"


@query(
    "latest_per_key",
    """WITH newest AS (
           SELECT DISTINCT ON (convertedaccountid) convertedaccountid, id AS lead_id, createddate FROM crm_lead
           ORDER BY convertedaccountid, createddate DESC NULLS LAST, id)
       SELECT crm_account.id AS account_id, lead_id, newest.createddate
       FROM crm_account LEFT JOIN newest ON crm_account.id = convertedaccountid""",
)
def latest_per_key_query(e: Entities) -> DataFrame:
    newest = latest_per_key(
        e.crm_lead.select("convertedaccountid", F.col("id").alias("lead_id"), "createddate"),
        ["convertedaccountid"],
        "createddate",
        "lead_id",
    )
    accounts = e.crm_account.select(F.col("id").alias("account_id"))
    return accounts.join(newest, F.col("account_id") == F.col("convertedaccountid"), "left").drop(
        "convertedaccountid"
    )


@query(
    "duplicate_rank",
    f"SELECT id, {OCCURRENCE_SQL} AS rn FROM mkt_lead WHERE lead_date >= date '1999-08-01'",
)
def duplicate_rank_query(e: Entities) -> DataFrame:
    return duplicate_rank(e.mkt_lead, "id", IDENTITY, "lead_date", SINCE).select("id", "rn")


@query(
    "semi_join_exists",
    f"""SELECT id, lead_date FROM mkt_lead SEMI JOIN (
            SELECT {', '.join(f"{k} AS k{i}" for i, k in enumerate(identity_list(IDENTITY)))}
            FROM mkt_lead GROUP BY ALL HAVING count(DISTINCT id) > 1) repeated
        ON {' AND '.join(f"k{i} = {k}" for i, k in enumerate(identity_list(IDENTITY)))}""",
)
def semi_join_exists(e: Entities) -> DataFrame:
    same = [identity_key(c) for c in IDENTITY]
    return exists_other(e.mkt_lead, e.mkt_lead.select("id", *IDENTITY), same, "id").select("id", "lead_date")


CONTACT = ["last_name", "email", "phone"]


@query(
    "has_duplicate",
    f"""SELECT id, lead_date FROM mkt_lead
        QUALIFY count(*) OVER (PARTITION BY {', '.join(identity_list(CONTACT))}) > 1""",
)
def has_duplicate_query(e: Entities) -> DataFrame:
    """Many leads leave all contact fields blank: one identity with a large part of the rows."""
    return has_duplicate(e.mkt_lead, "id", CONTACT).select("id", "lead_date")
