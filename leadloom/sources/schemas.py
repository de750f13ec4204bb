"""Declared column types of each entity. Nothing is ever inferred from text files.

All ids have the same type, ``ID_TYPE`` here; no other column has it.
"""

from __future__ import annotations

ID_TYPE = "bigint"

_DDL = {
    "crm_lead": """id bigint, convertedaccountid bigint, createddate timestamp_ntz,
        lead_segment int, pre_screen string""",
    "crm_account": """id bigint, createddate date, recordtypeid string, model_tier string,
        warranty_id string, financing_result string, lead_segment int, pre_screen string,
        dental_condition string, distance_to_center double""",
    "revenue": "leadid bigint, revenue_sold decimal(18,2)",
    "apt_history": """id bigint, lead_id bigint, account_id bigint, consultinventory_id bigint,
        action string, createdbyid bigint, createddate timestamp_ntz""",
    "completes": "lead_id bigint, consultinventory_id bigint",
    "quote": "id bigint, accountid bigint, price decimal(18,2)",
    "quote_line": "quoteid bigint, product2id bigint",
    "product": "id bigint, legacytreatmentoption bigint",
    "treatment_option": "id bigint, treatment_class string, treatment_grade string",
    "treatment_plan": "account bigint, treatment_option bigint, initial_cost decimal(18,2)",
    "esi": "lead bigint, esi int",
    "consult": """id bigint, scheduled_lead bigint, scheduled_account bigint, scheduled_by bigint,
        apt_date date, apt_datetime timestamp_ntz, start_hour int, arrival_time timestamp_ntz,
        active boolean, consult_room bigint, color string""",
    "consult_room": "id bigint, name string, room_type string, center_information bigint",
    "center": "id bigint, name string, use_ibs boolean",
    "agent": "id bigint, name string",
    "calendar": "actual_date date, media_week date, media_month date",
    "mkt_lead": """id bigint, lead_date date, media_week date, media_month date, center string,
        in_market string, pre_screen string, created_by_name string, lead_type string,
        first_creative_id bigint, first_name string, last_name string, street string,
        phone string, postal_code string, email string""",
    "campaign": "id bigint, phone_number string, media string, agency string, type string",
    "mkt_info": """leadid bigint, first_creative_name string, first_media_outlet string,
        first_campaign_name string, last_campaign_name string, dma_id bigint,
        num_consult_appointments int, num_consult_completed int, net_num_starts int,
        revenue_sold decimal(18,2), revenue_cancelled decimal(18,2), collected decimal(18,2),
        refunded decimal(18,2)""",
    "dma": "id bigint, name string",
}


def _columns(ddl: str) -> dict[str, str]:
    pairs = (column.split() for column in " ".join(ddl.split()).split(", "))
    return dict(pairs)


SCHEMAS: dict[str, dict[str, str]] = {name: _columns(ddl) for name, ddl in _DDL.items()}

# The column that the reports filter by, for entities with a date.
DATE_COLUMNS = {
    "crm_lead": "createddate",
    "crm_account": "createddate",
    "apt_history": "createddate",
    "consult": "apt_date",
    "mkt_lead": "lead_date",
}
