"""The reports on the views of FIXTURES.md give the checksums recorded there."""

from __future__ import annotations

import datetime as dt
import pathlib
import re

import pytest
from pyspark.sql import functions as F

from leadloom.operators import has_duplicate
from leadloom.plans import centre_fill, commission_points, lead_dashboard, scoring_features, segment_mix
from leadloom.plans.lead_dashboard import IDENTITY
from leadloom.sources import conform

VIEW_ROW = re.compile(r"^\| `(\w+)` \| (\d+) / (\d+) \|.*\| `(SELECT .*)` \|$")
FIXTURES = pathlib.Path(__file__).resolve().parents[1] / "FIXTURES.md"
TABLES = "orders lineitem customer part supplier nation region events".split()


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def views(request, spark):
    for table in TABLES:
        spark.read.parquet(f"/root/testdata/{request.param}/{table}.parquet").createOrReplaceTempView(table)
    found = {}
    for line in FIXTURES.read_text().splitlines():
        match = VIEW_ROW.match(line)
        if match:
            name, small_rows, medium_rows, sql = match.groups()
            df = spark.sql(sql)
            df.createOrReplaceTempView(name)
            if name == "crm_account":
                df = df.withColumn("dental_condition", F.lit(None))
            found[name] = conform(df, name.removesuffix("_nn"))
            assert df.count() == int(small_rows if request.param == "sf0.001" else medium_rows)
    assert len(found) == 21
    yield request.param, found
    for name in [*TABLES, *found]:
        spark.catalog.dropTempView(name)


def pick(scale: str, small, medium):
    return small if scale == "sf0.001" else medium


def test_segment_mix(views):
    scale, v = views
    rows = segment_mix(
        v["crm_lead"], v["revenue"], v["apt_history"], v["completes"],
        created_from=dt.date(1996, 7, 1), created_to=dt.date(1998, 12, 31),
    ).collect()
    assert [r["lead_segment"] for r in rows] == [5, 4, 3, 2, 1, 0]
    expected = pick(scale, [18.0303, 18.3432, 19.9316, 19.8185], [17.2562, 17.2750, 16.9137, 17.5796])
    assert [round(x, 4) for x in rows[0][1:]] == expected
    for i in range(1, 5):
        assert sum(r[i] for r in rows) == pytest.approx(100.0)


@pytest.mark.parametrize(
    "quotes, small, medium",
    [
        ("quote", [15, 9, 10, 6, 9, 9], [133, 84, 69, 78, 80, 47]),
        ("quote_nn", [25, 15, 10, 12, 9, 14], [258, 148, 69, 179, 80, 87]),
    ],
)
def test_scoring_features(views, quotes, small, medium):
    scale, v = views
    df = scoring_features(
        v["crm_account"], v["crm_lead"], v[quotes], v["quote_line"], v["product"], v["treatment_option"],
        v["treatment_plan"], v["esi"], record_types=["building", "MACHINERY "],
    )
    flags = ["is_double", "is_hybrid", "is_phased", "is_other"]
    found = df.agg(F.count("account_id"), *[F.sum(f) for f in flags], F.count_distinct("account_id")).first()
    assert list(found[:5]) == pick(scale, small, medium)[:5]
    assert found[5] == found[0]
    known_esi = v["esi"].dropna().select("lead").distinct()
    newest = v["crm_lead"].groupBy("convertedaccountid").agg(F.max_by("id", F.struct("createddate", -F.col("id"))).alias("lead"))
    with_esi = df.join(newest, F.col("account_id") == F.col("convertedaccountid")).join(known_esi, "lead", "left_semi")
    assert with_esi.count() == pick(scale, small, medium)[5]


def test_commission_points(views):
    scale, v = views
    df = commission_points(
        v["consult"], v["consult_room"], v["agent"], v["crm_lead"], v["crm_account"], v["apt_history"],
        cutoff=dt.date(1996, 1, 1),
    )
    found = df.agg(F.count("apt_month"), F.sum("points").cast("double"), F.count("sched_agent")).first()
    assert list(found) == pick(scale, [84, 450.75, 84], [360, 4372.75, 348])


def test_lead_dashboard(views):
    scale, v = views
    df = lead_dashboard(
        v["mkt_lead"], v["campaign"], v["mkt_info"], v["dma"],
        channels={"Website": ["Website API"], "IMC": ["IMC API"]}, as_of=dt.date(2001, 8, 1),
    )
    names = ["leads", "net_collected", "net_starts", "valid_lead", "duplicate_lead", "duplicate_web_lead"]
    found = df.agg(F.count("*"), *[F.sum(n) for n in names]).first()
    assert [float(x) for x in found] == pick(
        scale,
        [577, 577, 11709748.76, 122, 367, 218, 59],
        [6320, 6322, 109882214.14, 1376, 3862, 2479, 849],
    )


def test_centre_fill(views):
    scale, v = views
    df = centre_fill(
        v["consult"], v["consult_room"], v["center"], v["crm_lead"], v["calendar"],
        start=dt.date(1997, 1, 1), end=dt.date(1998, 12, 31),
    )
    found = df.agg(F.count("*"), F.sum("target_consults"), F.sum("scheds"), F.sum("gy_scheds"), F.count("scheds")).first()
    assert list(found) == pick(scale, [405, 450, 1289, 504, 352], [2002, 3481, 26556, 10591, 1973])


def test_duplicates(views):
    scale, v = views
    assert has_duplicate(v["mkt_lead"], "id", IDENTITY).count() == pick(scale, 999, 9985)
