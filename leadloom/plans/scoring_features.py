"""One feature row per account that is still to be scored."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ci
from ..operators.aggregates import mean, row_count
from ..operators.joins import left_join
from ..operators.windows import latest_per_key

# Treatment names, and the score of a lead about which nothing is known.
LISTED_GRADES = ["non-arch", "zirconia", "hybrid", "phased"]
DEFAULT_ESI = 14


def treatment_flags() -> dict[str, Column]:
    """Predicates on a treatment option; a null grade meets none of them."""
    grade = ci("treatment_grade")
    return {
        "is_double": ci("treatment_class") == "double arch",
        "is_non_arch": grade == "non-arch",
        "is_zirconia": grade == "zirconia",
        "is_hybrid": grade == "hybrid",
        "is_phased": grade == "phased",
        "is_other": ~grade.isin(LISTED_GRADES),
    }


def _flagged_options(options: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    return options.select(
        F.col("id").alias("option_id"), *[F.when(p, 1).otherwise(0).alias(name) for name, p in flags.items()]
    )


def quote_features(
    quotes: DataFrame, lines: DataFrame, products: DataFrame, options: DataFrame, flags: Mapping[str, Column]
) -> DataFrame:
    """Per account: number of quotes, price statistics weighted by quote lines, flags.

    Lines are reduced to one row per quote before they meet the quotes.
    """
    offered = products.join(
        _flagged_options(options, flags), F.col("legacytreatmentoption") == F.col("option_id"), "inner"
    ).select(F.col("id").alias("product_id"), *flags)
    per_quote = (
        lines.join(offered, F.col("product2id") == F.col("product_id"), "inner")
        .groupBy("quoteid")
        .agg(row_count().alias("lines"), *[F.max(f).alias(f) for f in flags])
    )
    total = F.sum(F.col("price") * F.col("lines"))
    priced = F.sum(F.when(F.col("price").isNotNull(), F.col("lines")))
    return (
        quotes.join(per_quote, F.col("id") == F.col("quoteid"), "inner")
        .groupBy("accountid")
        .agg(
            F.count_distinct("id").alias("treatments_offered"),
            mean(total, priced).alias("average_cost"),
            F.min("price").alias("minimum_cost"),
            F.max("price").alias("maximum_cost"),
            *[F.max(f).alias(f) for f in flags],
        )
    )


def plan_features(plans: DataFrame, options: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """The same columns from treatment plans; a plan without a known option counts, unflagged."""
    flagged = left_join(plans, _flagged_options(options, flags), [("treatment_option", "option_id")])
    return (
        flagged.groupBy(F.col("account").alias("accountid"))
        .agg(
            row_count().alias("treatments_offered"),
            mean(F.sum("initial_cost"), F.count("initial_cost")).alias("average_cost"),
            F.min("initial_cost").alias("minimum_cost"),
            F.max("initial_cost").alias("maximum_cost"),
            *[F.max(F.coalesce(f, F.lit(0))).alias(f) for f in flags],
        )
    )


def account_treatments(
    quotes: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    options: DataFrame,
    plans: DataFrame,
    flags: Mapping[str, Column],
) -> DataFrame:
    """The features of each known account from its quotes, else from its plans.

    Both sides have one row per account, so they meet in one outer join on the shuffles of
    their groupings. Plans count only if every quote with a known product has an account
    (``NOT IN`` with a null); only the quotes without one are read for that.
    """
    known = F.col("accountid").isNotNull()
    from_quotes = quote_features(quotes.where(known), lines, products, options, flags)
    no_account = quote_features(quotes.where(~known), lines, products, options, flags)
    allowed = no_account.agg(row_count() == 0).scalar()
    from_plans = plan_features(plans.where(F.col("account").isNotNull()), options, flags).where(allowed)
    columns = [c for c in from_quotes.columns if c != "accountid"]
    quoted = from_quotes.select(F.col("accountid").alias("_quoted"), F.struct(*columns).alias("_from_quotes"))
    planned = from_plans.select(F.col("accountid").alias("_planned"), F.struct(*columns).alias("_from_plans"))
    both = quoted.join(planned, F.col("_quoted") == F.col("_planned"), "full")
    chosen = [
        F.when(F.col("_quoted").isNotNull(), F.col(f"_from_quotes.{c}")).otherwise(F.col(f"_from_plans.{c}")).alias(c)
        for c in columns
    ]
    return both.select(F.coalesce("_quoted", "_planned").alias("accountid"), *chosen)


def esi_per_lead(esi: DataFrame) -> DataFrame:
    """The lowest stability score known of each lead."""
    return esi.where(F.col("lead").isNotNull()).groupBy("lead").agg(F.min("esi").alias("esi"))


def scoring_features(
    accounts: DataFrame,
    leads: DataFrame,
    quotes: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    options: DataFrame,
    plans: DataFrame,
    esi: DataFrame,
    *,
    record_types: Sequence[str],
    created_from: dt.date = dt.date(2020, 1, 1),
    flags: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Features of unscored accounts of the given record types that have treatments.

    Quotes take precedence over plans. If a quote with a known product has no account, no
    account gets its features from plans (``NOT IN`` with a null). Accounts take the
    attributes of their newest lead.
    """
    flags = treatment_flags() if flags is None else flags
    treatments = account_treatments(quotes, lines, products, options, plans, flags)
    chosen = accounts.where(
        ci("recordtypeid").isin([r.rstrip(" ").lower() for r in record_types])
        & (F.col("createddate") >= F.lit(created_from))
        & F.col("model_tier").isNull()
        & F.col("warranty_id").isNotNull()
    )
    # One lead per account before the join, so an account with many leads is one row.
    newest = latest_per_key(
        leads.where(F.col("convertedaccountid").isNotNull()).select("convertedaccountid", "id", "createddate"),
        ["convertedaccountid"],
        "createddate",
        "id",
    ).select("convertedaccountid", F.col("id").alias("lead_id"))
    with_lead = (
        chosen.join(treatments, F.col("id") == F.col("accountid"), "inner")
        .join(newest, F.col("id") == F.col("convertedaccountid"), "left")
        .drop("accountid", "convertedaccountid")
    )
    scored = left_join(with_lead, esi_per_lead(esi), [("lead_id", "lead")])
    return scored.select(
        F.col("id").alias("account_id"),
        F.col("createddate").alias("created_date"),
        F.col("warranty_id").alias("unique_id"),
        "financing_result",
        F.col("lead_segment").alias("account_lead_segment"),
        F.col("dental_condition").alias("account_dental_condition"),
        F.col("distance_to_center").alias("account_distance_to_center"),
        F.coalesce("esi", F.lit(DEFAULT_ESI)).alias("economic_stability_indicator"),
        "treatments_offered",
        "average_cost",
        "minimum_cost",
        "maximum_cost",
        *flags,
        F.lit(0).alias("start"),
    ).orderBy(F.col("created_date").desc_nulls_last(), "account_id")
