"""Null, tie, spelling and fan-out rules on a few inline rows."""

from __future__ import annotations

import datetime as dt
import itertools
from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from leadloom.functions import ci, net_amount, normalise_text, null_label, rolling_month_start
from leadloom.operators import (
    any_flag,
    count_where,
    distinct_slots,
    duplicate_rank,
    exclude_reversed,
    fallback_attribute,
    flag_any,
    has_duplicate,
    latest_per_key,
    left_join,
    mean,
    merge_spellings,
    not_in,
    precedence_union,
    share_of_total,
)
from leadloom.plans import (
    campaign_type_rules,
    centre_fill,
    commission_points,
    commission_rules,
    lead_dashboard,
    pre_screen_label,
    scoring_features,
    segment_mix,
    segment_totals,
    treatment_flags,
)
from leadloom.plans.lead_dashboard import IDENTITY
from leadloom.sources import SCHEMAS

D = dt.date
T = dt.datetime


def frame(spark, entity: str, *rows: dict):
    """Rows of an entity; columns that are not given are null."""
    schema = SCHEMAS[entity]
    data = [tuple(row.get(c) for c in schema) for row in rows]
    unknown = {c for row in rows for c in row} - set(schema)
    assert not unknown
    return spark.createDataFrame(data, ", ".join(f"{c} {t}" for c, t in schema.items()))


def keyed(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k bigint")


SIDES = [[], [1], [None], [1, None], [2, None, 1]]


@pytest.mark.parametrize("left, right", list(itertools.product(SIDES, SIDES)))
def test_not_in_equals_sql(spark, left, right):
    df, other = keyed(spark, left), keyed(spark, right)
    found = sorted(r.k is None and -1 or r.k for r in not_in(df, other, "k").collect())
    sql = spark.sql("SELECT k FROM {df} WHERE k NOT IN (SELECT k FROM {other})", df=df, other=other)
    assert found == sorted(r.k is None and -1 or r.k for r in sql.collect())


def test_precedence_union(spark):
    def rows(values, source):
        return spark.createDataFrame([(v, source) for v in values], "k bigint, source string")

    both = precedence_union(rows([1, 1, 2], "q"), rows([2, 3, 3, None], "p"), "k")
    assert sorted(both.collect()) == [(1, "q"), (1, "q"), (2, "q"), (3, "p"), (3, "p")]
    trapped = precedence_union(rows([1, None], "q"), rows([2, 3], "p"), "k")
    assert {r.source for r in trapped.collect()} == {"q"} and trapped.count() == 2
    alone = precedence_union(rows([], "q"), rows([2, None], "p"), "k")
    assert alone.count() == 2


def lead(spark, *people):
    return frame(
        spark,
        "mkt_lead",
        *[{"id": i, "lead_date": d, **dict(zip(IDENTITY, fields))} for i, d, *fields in people],
    )


def ranks(df):
    return {r["id"]: r["rn"] for r in df.collect()}


def test_null_and_blank_identity_are_the_same(spark):
    df = lead(spark, (1, D(2020, 1, 1), "a", None), (2, D(2020, 1, 2), "A ", ""), (3, D(2020, 1, 3), "b", ""))
    assert ranks(duplicate_rank(df, "id", IDENTITY, "lead_date")) == {1: 1, 2: 2, 3: 1}
    assert sorted(r["id"] for r in has_duplicate(df, "id", IDENTITY).collect()) == [1, 2]


def test_all_blank_identity_and_ties(spark):
    day = D(2020, 1, 1)
    df = lead(spark, (3, day, None), (1, day, ""), (2, day, None), (9, None, None))
    assert ranks(duplicate_rank(df, "id", IDENTITY, "lead_date")) == {9: 1, 1: 2, 2: 3, 3: 4}


def test_null_id_has_no_duplicate(spark):
    df = lead(spark, (None, D(2020, 1, 1), "a"), (1, D(2020, 1, 1), "a"), (None, D(2020, 1, 1), "a"))
    assert has_duplicate(df, "id", IDENTITY).count() == 0


def test_duplicate_before_the_window_does_not_count(spark):
    df = lead(spark, (1, D(2019, 1, 1), "a"), (2, D(2021, 1, 1), "a"))
    assert ranks(duplicate_rank(df, "id", IDENTITY, "lead_date", D(2020, 1, 1))) == {2: 1}


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, None, 7), (1, D(2020, 1, 1), 6), (1, D(2020, 1, 1), 5), (2, None, 4), (None, D(2020, 1, 1), 3)],
        "account bigint, created date, id bigint",
    )
    found = latest_per_key(df, ["account"], "created", "id")
    assert {r["account"]: r["id"] for r in found.collect()} == {1: 5, 2: 4, None: 3}


def test_exclude_reversed(spark):
    events = spark.createDataFrame(
        [(1, 10, T(2020, 1, 5, 9)), (1, 11, T(2020, 1, 5)), (2, None, T(2020, 1, 5)), (None, 10, T(2020, 1, 5)), (3, 10, T(2020, 1, 5))],
        "subject bigint, agent bigint, at timestamp_ntz",
    )
    gone = spark.createDataFrame(
        [(1, 10, T(2020, 1, 1)), (2, None, T(2020, 1, 5)), (None, 10, T(2020, 1, 5)), (3, 10, T(2020, 1, 5, 18))],
        "subject bigint, agent bigint, at timestamp_ntz",
    )

    def keys(df):
        return {(r.subject, r.agent) for r in df.collect()}

    # An earlier reversal counts; another agent and null keys do not.
    assert keys(exclude_reversed(events, gone, ["subject", "agent"])) == {(1, 11), (2, None), (None, 10)}
    same_day = exclude_reversed(events, gone, ["subject", "agent"], True, "at", "at")
    assert keys(same_day) == {(1, 10), (1, 11), (2, None), (None, 10)}
    assert same_day.columns == events.columns
    with pytest.raises(ValueError):
        exclude_reversed(events, gone, ["subject"], same_day=True)


def test_left_join_keeps_rows_without_key(spark):
    left = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c"), (2, "d")], "k bigint, name string")
    right = spark.createDataFrame([(1, 10), (1, 11), (None, 12)], "k bigint, v int")
    found = left_join(left, right, [("k", "k")])
    assert found.columns == ["k", "name", "v"]
    rows = sorted(found.collect(), key=lambda r: (r.name, r.v or 0))
    assert [(r.k, r.name, r.v) for r in rows] == [
        (None, "a", None), (None, "b", None), (1, "c", 10), (1, "c", 11), (2, "d", None),
    ]
    with pytest.raises(TypeError):
        left_join(left, right.withColumn("k", F.col("k").cast("int")), [("k", "k")])
    with pytest.raises(ValueError):
        left_join(left, right.withColumnRenamed("v", "name"), [("k", "k")])


def test_fallback_is_per_attribute(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (2, None), (None, None)], "a bigint, b bigint")
    first = spark.createDataFrame([(1, None, 4)], "id bigint, x string, y int")
    second = spark.createDataFrame([(5, "s", 9)], "id bigint, x string, y int")
    found = fallback_attribute(df, [(first, "a", "id"), (second, "b", "id")], ["x", "y"])
    assert {(r.a, r.b): (r.x, r.y) for r in found.collect()} == {
        (1, 5): ("s", 4), (None, 5): ("s", 9), (2, None): (None, None), (None, None): (None, None),
    }


def test_merge_spellings(spark):
    df = spark.createDataFrame(
        [(1, "Blue", 2), (1, "BLUE ", 3), (1, None, 1), (2, "blue", None), (1, "Red", 4)], "d int, name string, n bigint"
    )
    found = merge_spellings(df, ["d"], ["name"], ["n"])
    assert {(r.d, r.name): r.n for r in found.collect()} == {
        (1, "BLUE "): 5, (1, None): 1, (2, "blue"): None, (1, "Red"): 4,
    }


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1, Decimal("1.50")), ("b", 1, None), (None, 2, Decimal("4.50"))], "k string, n int, v decimal(18,2)")
    found = share_of_total(df, ["k"], {"n": F.sum("n"), "v": F.sum("v")})
    assert {r.k: (r.n, r.v) for r in found.collect()} == {"a": (25.0, 25.0), "b": (25.0, None), None: (50.0, 75.0)}
    with pytest.raises(ArithmeticException):
        share_of_total(df, ["k"], {"n": F.sum(F.lit(0))}).collect()
    nothing = share_of_total(df, ["k"], {"v": F.sum(F.lit(None).cast("int"))})
    assert {r.v for r in nothing.collect()} == {None}


def test_aggregates(spark):
    df = spark.createDataFrame([(1, None, 3), (1, "Hybrid", 2), (2, None, 1)], "k int, grade string, w bigint")
    flags = flag_any(df, ["k"], {"is_hybrid": ci("grade") == "hybrid", "is_other": ~ci("grade").isin("hybrid")})
    assert {r.k: (r.is_hybrid, r.is_other) for r in flags.collect()} == {1: (1, 0), 2: (0, 0)}
    hybrid = F.col("grade") == "Hybrid"
    row = df.agg(count_where(hybrid), count_where(hybrid, "w"), any_flag(hybrid), mean(F.sum("w"), F.count("grade"))).first()
    assert list(row) == [1, 2, 1, 6.0]
    assert df.where("k = 2").agg(mean(F.sum("w"), F.count("grade"))).first()[0] is None


def test_double_booked_slot_counts_once(spark):
    df = spark.createDataFrame([(1, "9:00"), (1, "9:00"), (1, "10:00"), (None, "9:00")], "room int, at string")
    assert {r.room: r.slots for r in distinct_slots(df, ["room", "at"], ["room"]).collect()} == {1: 2, None: 1}
    with pytest.raises(ValueError):
        distinct_slots(df, ["at"], ["room"])


@pytest.mark.parametrize(
    "as_of, start",
    [(D(2024, 2, 29), D(2022, 2, 1)), (D(2024, 3, 31), D(2022, 3, 1)), (D(2024, 1, 1), D(2022, 1, 1))],
)
def test_rolling_month_start(spark, as_of, start):
    assert spark.range(1).select(rolling_month_start(as_of, 24)).first()[0] == start
    by_parts = spark.sql(f"SELECT make_date(year(add_months(date '{as_of}', -24)), month(add_months(date '{as_of}', -24)), 1)")
    assert by_parts.first()[0] == start


def test_rolling_month_start_defaults_to_today(spark):
    row = spark.range(1).select(rolling_month_start(), F.trunc(F.add_months(F.current_date(), -24), "MM")).first()
    assert row[0] == row[1]


def test_null_helpers(spark):
    df = spark.createDataFrame([(None, None, "A "), (3, 1, None)], "a int, b int, t string")
    rows = normalise_text(df, ["t"]).select(net_amount("a", "b"), null_label("t", "Partial"), "t_key").collect()
    assert [tuple(r) for r in rows] == [(0, "A ", "a"), (2, "Partial", None)]


LOW = ["red", "blue (no hit)", "Insufficient Information", "Not checked", "PO Box", "Website Down-No Prescreen"]


def test_points_table(spark):
    cases = [(p, s) for p in ["green", "Yellow ", *LOW, "purple", None] for s in [0, 1, 2, 3, 4, 5, None]]
    df = spark.createDataFrame(cases, "p string, s int").select("p", "s", commission_rules("p", "s").alias("points"))
    for r in df.collect():
        good, low = r.p in ("green", "Yellow "), r.p in LOW
        expected = 1 if good and r.s in (4, 5) else 0.25 if low and r.s in (0, 1) else 0.5
        assert float(r.points) == expected, r


def test_label_rules(spark):
    df = spark.createDataFrame(
        [("Per Inquiry", "CPM Network", "TV"), ("TV", "CPM Network", "National"), ("TV", None, "national"),
         ("radio", None, "TV "), (None, None, "Web-Display"), (None, None, "WEB-SEM"), ("TV", None, None)],
        "m string, a string, t string",
    )
    assert [r[0] for r in df.select(campaign_type_rules("m", "a", "t")).collect()] == [
        "PI", "BX", "NT", "LT", "DIS", "SEM", "Other",
    ]
    screens = spark.createDataFrame([("GREEN",), ("Red",), ("blue (no hit)",), ("x",), (None,)], "p string")
    assert [r[0] for r in screens.select(pre_screen_label("p")).collect()] == ["GREEN", "Red", "Blue", "Other", "Other"]


def mix_inputs(spark):
    leads = frame(
        spark, "crm_lead",
        {"id": 1, "lead_segment": 1, "createddate": T(2022, 12, 31)},
        {"id": 2, "lead_segment": 2, "createddate": T(2022, 7, 1)},
        {"id": 3, "lead_segment": 2, "createddate": T(2022, 12, 31, 0, 1)},
        {"id": 4, "createddate": T(2022, 8, 1)},
    )
    metrics = frame(
        spark, "revenue",
        {"leadid": 1, "revenue_sold": Decimal(10)}, {"leadid": 1}, {"leadid": 1, "revenue_sold": Decimal(5)},
        {"leadid": 2, "revenue_sold": Decimal(1)}, {"leadid": 3, "revenue_sold": Decimal(99)},
    )
    history = frame(
        spark, "apt_history",
        {"lead_id": 1, "consultinventory_id": 7, "action": "Scheduled"},
        {"lead_id": 1, "consultinventory_id": 7, "action": "SCHEDULED "},
        {"lead_id": 1, "consultinventory_id": None, "action": "scheduled"},
        {"lead_id": 1, "consultinventory_id": 8, "action": "cancel"},
        {"account_id": 1, "consultinventory_id": 7, "action": "Scheduled"},
    )
    completes = frame(
        spark, "completes",
        {"lead_id": 1, "consultinventory_id": 7}, {"lead_id": 1, "consultinventory_id": 7}, {"lead_id": 1},
        {"lead_id": 2, "consultinventory_id": 7},
    )
    return leads, metrics, history, completes


def test_segment_counts_are_joined_rows(spark):
    # Lead 1: 3 metric rows x (2 schedules x 2 completions + 1 schedule) = 15 rows.
    found = {r["lead_segment"]: tuple(r)[1:] for r in segment_totals(*mix_inputs(spark)).collect()}
    assert found == {1: (15, 15, 12, 75), 2: (2, 0, 0, 100), None: (1, 0, 0, None)}


def test_segment_mix_bounds_and_shares(spark):
    bounds = {"created_from": D(2022, 7, 1), "created_to": D(2022, 12, 31)}
    rows = segment_mix(*mix_inputs(spark), **bounds).collect()
    assert [r["lead_segment"] for r in rows] == [2, 1]
    assert [tuple(r)[1:] for r in rows] == [
        (100 / 16, 0.0, 0.0, 100 / 76), (1500 / 16, 100.0, 100.0, 7500 / 76),
    ]
    leads, metrics, history, completes = mix_inputs(spark)
    with pytest.raises(ArithmeticException):
        segment_mix(leads, metrics, history.where("false"), completes, **bounds).collect()
    unsold = segment_mix(leads, metrics.where("false"), history, completes, **bounds)
    assert {r["rev_percentage"] for r in unsold.collect()} == {None}


def test_commission_rules_on_consults(spark):
    day, later = D(2022, 3, 4), T(2022, 3, 4, 9)
    base = {"apt_date": day, "arrival_time": later, "active": True, "consult_room": 1}
    consults = frame(
        spark, "consult",
        {**base, "id": 1, "scheduled_lead": 1, "scheduled_by": 1},
        {**base, "id": 2, "scheduled_lead": 1, "scheduled_by": 2},
        {**base, "id": 3, "scheduled_account": 5, "scheduled_by": 3},
        {**base, "id": 4, "scheduled_lead": 1},
        {**base, "id": 5, "scheduled_by": 1},
        {**base, "id": 6, "scheduled_lead": 1, "scheduled_by": 77},
        {**base, "id": 7, "scheduled_by": 3, "consult_room": 2},
        {**base, "id": 8, "scheduled_by": 3, "consult_room": 3},
        {**base, "id": 9, "scheduled_by": 3, "active": False},
        {**base, "id": 10, "scheduled_by": 3, "arrival_time": None},
        {**base, "id": 11, "scheduled_by": 3, "apt_date": D(2021, 3, 4)},
        {**base, "id": 12, "scheduled_lead": 1, "scheduled_by": 2, "apt_date": D(2023, 3, 9)},
    )
    rooms = frame(spark, "consult_room", {"id": 1, "room_type": "Normal"}, {"id": 2, "room_type": "PRACTICE "}, {"id": 3})
    agents = frame(spark, "agent", {"id": 1, "name": "Ann"}, {"id": 2, "name": "Bo"}, {"id": 3, "name": "bo "})
    leads = frame(spark, "crm_lead", {"id": 1, "pre_screen": "Green", "lead_segment": 5})
    accounts = frame(spark, "crm_account", {"id": 5, "pre_screen": "red", "lead_segment": 1})
    history = frame(
        spark, "apt_history",
        # Agent 1 cancelled lead 1, before the consult; agent 77 is unknown, so that cancel is nobody's.
        {"lead_id": 1, "action": "Cancel", "createdbyid": 1, "createddate": T(2022, 1, 2)},
        {"lead_id": 1, "action": "cancel", "createdbyid": 77, "createddate": T(2022, 5, 2)},
        {"lead_id": 1, "action": "cancel", "createdbyid": 2, "createddate": T(2021, 5, 2)},
        {"account_id": 5, "action": "Scheduled", "createdbyid": 3, "createddate": T(2022, 5, 2)},
    )
    args = (consults, rooms, agents, leads, accounts, history)
    found = commission_points(*args, cutoff=D(2022, 1, 1)).collect()
    # Ann keeps the consult without a subject; Bo and bo are namesakes; March of both years is one month.
    assert {(r.sched_agent, r.apt_month): float(r.points) for r in found} == {
        ("Ann", 3): 0.5, ("Bo", 3): 2.25, (None, 3): 2.0,
    }
    by_year = commission_points(*args, cutoff=D(2022, 1, 1), with_year=True).collect()
    assert {(r.sched_agent, r.apt_year): float(r.points) for r in by_year} == {
        ("Ann", 2022): 0.5, ("Bo", 2022): 1.25, ("Bo", 2023): 1.0, (None, 2022): 2.0,
    }


def test_centre_fill_rules(spark):
    day = D(2022, 3, 7)
    nine = T(2022, 3, 7, 9)
    slot = {"apt_date": day, "apt_datetime": nine, "start_hour": 9, "active": True, "consult_room": 1, "color": "green"}
    consults = frame(
        spark, "consult",
        {**slot, "id": 1, "scheduled_account": 5},
        {**slot, "id": 2},
        {**slot, "id": 3, "color": None, "apt_datetime": T(2022, 3, 7, 10)},
        {**slot, "id": 4, "color": "Network Purple ", "apt_datetime": T(2022, 3, 7, 11)},
        {**slot, "id": 5, "active": False, "scheduled_lead": 1, "scheduled_account": 5},
        {**slot, "id": 6, "consult_room": 2, "scheduled_lead": 1},
        {**slot, "id": 7, "consult_room": 3, "scheduled_lead": 1},
        {**slot, "id": 8, "consult_room": 4, "scheduled_lead": 3, "apt_datetime": T(2022, 3, 7, 12)},
    )
    rooms = frame(
        spark, "consult_room",
        {"id": 1, "name": "R1", "room_type": "Normal", "center_information": 1},
        {"id": 2, "name": "R2", "room_type": "practice", "center_information": 1},
        {"id": 3, "name": "R3", "room_type": None, "center_information": 1},
        {"id": 4, "name": "R4", "room_type": "NORMAL", "center_information": 2},
    )
    centres = frame(spark, "center", {"id": 1, "name": "North", "use_ibs": True}, {"id": 2, "name": "NORTH ", "use_ibs": True})
    leads = frame(
        spark, "crm_lead",
        {"id": 1, "pre_screen": "red"}, {"id": 3, "convertedaccountid": 9},
        {"id": 10, "convertedaccountid": 5, "pre_screen": "Green"}, {"id": 11, "convertedaccountid": 5, "pre_screen": "red"},
    )
    calendar = frame(spark, "calendar", {"actual_date": day, "media_week": day})
    found = centre_fill(consults, rooms, centres, leads, calendar, start=D(2022, 1, 1), end=D(2022, 12, 31)).collect()
    # Slots: room 1 at nine (booked twice) and room 4 at twelve; the two centres share a name.
    # Schedules: consult 1 twice (two leads, one green), consult 5 twice (its own lead is red), consult 8 once.
    assert [tuple(r) for r in found] == [("NORTH ", day, day, 2, 5, 1)]
    unknown_week = frame(spark, "calendar", {"actual_date": day})
    assert centre_fill(consults, rooms, centres, leads, unknown_week, start=D(2022, 1, 1), end=D(2022, 12, 31)).isEmpty()


def test_dashboard_rules(spark):
    base = {"lead_date": D(2023, 5, 1), "in_market": "Y", "pre_screen": "Green", "created_by_name": "Web", "first_name": "a"}
    leads = frame(
        spark, "mkt_lead",
        {**base, "id": 1, "center": "C1"},
        {**base, "id": 2, "center": "c1 ", "created_by_name": "Website API", "first_name": "A"},
        {**base, "id": 3, "lead_date": D(2020, 1, 1)},
        {**base, "id": 4, "first_name": "b", "pre_screen": None},
    )
    amounts = {"num_consult_appointments": 1, "num_consult_completed": 1, "revenue_sold": Decimal(10), "revenue_cancelled": Decimal(4), "dma_id": 1}
    metrics = frame(
        spark, "mkt_info",
        {**amounts, "leadid": 1, "first_creative_name": "Cr"},
        {**amounts, "leadid": 1, "first_creative_name": "CR"},
        {**amounts, "leadid": 2, "first_creative_name": "cr "},
    )
    markets = frame(spark, "dma", {"id": 1, "name": "M"})
    campaigns = frame(spark, "campaign")
    found = lead_dashboard(
        leads, campaigns, metrics, markets, channels={"Website": ["website api", "Web "]}, as_of=D(2024, 2, 29)
    ).collect()
    by_centre = {r.center_name: r for r in found}
    assert len(found) == 2
    merged = by_centre["C1"]
    # Two leads on three joined rows; both spellings of the centre and the three of the creative are one group.
    assert (merged.leads, merged.gyim_leads, merged.num_scheds, merged.net_starts) == (2, 3, 3, None)
    assert (merged.valid_lead, merged.duplicate_lead, merged.duplicate_web_lead) == (2, 1, 1)
    assert (merged.net_sold, merged.net_collected, merged.creative, merged.market) == (18, 0, "CR", "M")
    assert (merged.created_by_channel, merged.campaign_type, merged.pre_screen) == ("Website", "Other", "Green")
    alone = by_centre["Partial"]
    assert (alone.leads, alone.gyim_leads, alone.net_sold, alone.num_scheds, alone.pre_screen) == (1, 0, 0, None, "Other")


def scoring_inputs(spark):
    base = {"recordtypeid": "P", "createddate": D(2021, 1, 1), "warranty_id": "w"}
    accounts = frame(
        spark, "crm_account",
        {**base, "id": 1}, {**base, "id": 2}, {**base, "id": 3}, {**base, "id": 4, "model_tier": "T"},
        {**base, "id": 5, "warranty_id": None}, {**base, "id": 6, "createddate": D(2019, 12, 31)},
        {**base, "id": 7, "recordtypeid": "Q"},
    )
    leads = frame(
        spark, "crm_lead",
        {"id": 10, "convertedaccountid": 1, "createddate": T(2021, 1, 1)},
        {"id": 11, "convertedaccountid": 1, "createddate": T(2021, 2, 1)},
    )
    quotes = frame(
        spark, "quote",
        {"id": 1, "accountid": 1, "price": Decimal(100)},
        {"id": 2, "accountid": 1, "price": Decimal(40)},
        {"id": 3, "price": Decimal(1)},
    )
    lines = frame(spark, "quote_line", *[{"quoteid": q, "product2id": p} for q, p in [(1, 1), (1, 1), (1, 2), (2, 1), (3, 9)]])
    products = frame(spark, "product", *[{"id": i, "legacytreatmentoption": o} for i, o in [(1, 1), (2, 2), (9, 99)]])
    options = frame(
        spark, "treatment_option",
        {"id": 1, "treatment_class": "double arch", "treatment_grade": "Hybrid"}, {"id": 2}, {"id": 3, "treatment_grade": "Sinus"},
    )
    planned = [(1, 1, 7), (2, None, None), (2, 3, None), (4, 1, 1), (5, 1, 1), (6, 1, 1), (7, 1, 1), (None, 1, 1)]
    plans = frame(
        spark, "treatment_plan",
        *[{"account": a, "treatment_option": o, "initial_cost": c and Decimal(c)} for a, o, c in planned],
    )
    esi = frame(spark, "esi", {"lead": 11, "esi": 9}, {"lead": 11, "esi": 3}, {"lead": 10, "esi": 1}, {"esi": 0})
    return accounts, leads, quotes, lines, products, options, plans, esi


def test_scoring_rules(spark):
    rows = {r.account_id: r for r in scoring_features(*scoring_inputs(spark), record_types=["p"]).collect()}
    assert set(rows) == {1, 2}
    quoted, planned = rows[1], rows[2]
    # Quote 1 has three lines, quote 2 one; the third quote has no known product.
    assert (quoted.treatments_offered, quoted.average_cost, quoted.minimum_cost, quoted.maximum_cost) == (2, 85.0, 40, 100)
    assert (quoted.is_double, quoted.is_hybrid, quoted.is_phased, quoted.is_other) == (1, 1, 0, 0)
    assert (quoted.economic_stability_indicator, quoted.start) == (3, 0)
    assert (planned.treatments_offered, planned.average_cost, planned.is_other, planned.is_double) == (2, None, 1, 0)
    assert planned.economic_stability_indicator == 14


def test_quote_without_account_hides_all_plans(spark):
    accounts, leads, quotes, lines, products, options, plans, esi = scoring_inputs(spark)
    lines = lines.unionByName(frame(spark, "quote_line", {"quoteid": 3, "product2id": 1}))
    found = scoring_features(accounts, leads, quotes, lines, products, options, plans, esi, record_types=["P"])
    assert [r.account_id for r in found.collect()] == [1]


def test_further_flags_are_data(spark):
    flags = {**treatment_flags(), "is_sinus": ci("treatment_grade") == "sinus"}
    found = scoring_features(*scoring_inputs(spark), record_types=["P"], flags=flags)
    assert {r.account_id: r.is_sinus for r in found.collect()} == {1: 0, 2: 1}
