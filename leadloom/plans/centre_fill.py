"""How full each centre is per appointment date: bookable slots against schedules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ci
from ..operators.aggregates import count_where, distinct_slots, row_count
from ..operators.joins import left_join

# Pre-screen results of good leads, and the colour of slots that are kept free.
GOOD_PRE_SCREENS = ["green", "yellow"]
RESERVED_COLOR = "network purple"


def room_centres(rooms: DataFrame, centres: DataFrame) -> DataFrame:
    """Each room with its centre, if any."""
    return rooms.select(
        F.col("id").alias("room_id"),
        ci("name").alias("room_key"),
        ci("room_type").alias("room_type_key"),
        "center_information",
    ).join(
        centres.select(
            F.col("id").alias("center_id"), ci("name").alias("center_key"), "use_ibs"
        ),
        F.col("center_information") == F.col("center_id"),
        "left",
    ).drop("center_information")


def slot_targets(
    consults: DataFrame, rooms: DataFrame, centres: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    """Bookable slots per centre and date; a slot that is booked twice counts once."""
    open_slots = consults.where(
        F.col("apt_date").between(F.lit(start), F.lit(end))
        & F.col("active")
        & (ci("color") != RESERVED_COLOR)
    ).select("consult_room", "apt_date", "apt_datetime", "start_hour")
    normal = room_centres(rooms, centres).where(F.col("room_type_key") == "normal")
    located = open_slots.join(normal, F.col("consult_room") == F.col("room_id"), "inner").withColumn(
        "apt_hour", F.hour("apt_datetime")
    )
    slot = ["center_id", "center_key", "room_key", "use_ibs", "apt_date", "apt_datetime", "apt_hour", "start_hour"]
    return distinct_slots(located, slot, ["center_id", "apt_date"], "target")


def schedules_per_centre(
    consults: DataFrame, rooms: DataFrame, centres: DataFrame, leads: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    """Schedules per centre name and date, and those of green or yellow leads.

    An account with several leads counts a schedule once per lead. That multiplicity is a
    count per account here, so the copies are never formed.
    """
    staffed = room_centres(rooms, centres).where(F.col("room_type_key") != "practice")
    booked = (
        consults.where(
            F.col("apt_date").between(F.lit(start), F.lit(end))
            & F.coalesce("scheduled_lead", "scheduled_account").isNotNull()
        )
        .join(staffed, F.col("consult_room") == F.col("room_id"), "inner")
        .groupBy("center_key", "apt_date", "scheduled_lead", "scheduled_account")
        .agg(row_count().alias("consults"))
    )
    is_good = ci("pre_screen").isin(GOOD_PRE_SCREENS)
    by_lead = leads.select("id", is_good.alias("lead_good"))
    by_account = (
        leads.where(F.col("convertedaccountid").isNotNull())
        .groupBy("convertedaccountid")
        .agg(row_count().alias("copies"), count_where(is_good).alias("good_copies"))
    )
    known = left_join(
        left_join(booked, by_lead, [("scheduled_lead", "id")]),
        by_account,
        [("scheduled_account", "convertedaccountid")],
    )
    copies = F.coalesce("copies", F.lit(1))
    good = F.when(
        F.col("lead_good").isNotNull(), F.when(F.col("lead_good"), copies).otherwise(0)
    ).otherwise(F.coalesce("good_copies", F.lit(0)))
    return known.groupBy("center_key", "apt_date").agg(
        F.sum(F.col("consults") * copies).alias("scheds"),
        F.sum(F.col("consults") * good).alias("gy_scheds"),
    )


def centre_fill(
    consults: DataFrame,
    rooms: DataFrame,
    centres: DataFrame,
    leads: DataFrame,
    calendar: DataFrame,
    *,
    start: dt.date,
    end: dt.date,
) -> DataFrame:
    """Target slots and schedules per centre, appointment date and media week.

    Targets come from normal rooms with an active slot of a known, non-reserved colour;
    schedules from any known room type but practice. Dates whose media week is
    unknown or before ``start`` are left out.
    """
    targets = slot_targets(consults, rooms, centres, start, end)
    scheds = schedules_per_centre(consults, rooms, centres, leads, start, end)
    names = centres.select(F.col("id").alias("center_id"), "name", ci("name").alias("center_key"))
    weeks = calendar.where(F.col("media_week") >= F.lit(start)).select(
        F.col("actual_date").alias("apt_date"), "media_week"
    )
    return (
        targets.join(names, "center_id", "left")
        .join(scheds, ["center_key", "apt_date"], "left")
        .join(weeks, "apt_date", "inner")
        .groupBy("center_key", "apt_date", "scheds", "gy_scheds", "media_week")
        .agg(F.min("name").alias("name"), F.sum("target").alias("target_consults"))
        .select("name", "apt_date", "media_week", "target_consults", "scheds", "gy_scheds")
        .orderBy(F.col("name").asc_nulls_first(), "apt_date")
    )
