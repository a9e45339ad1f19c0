"""Wide marts (A1-A4): joins of a header, its lines and their amounts, then one wide grouping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import month_key
from tidemark.functions.values import number_prefix, quoted
from tidemark.operators.aggregates import sum_by_code
from tidemark.operators.projections import any_column_equals, classify_in_list, filter_last_days


def revenue_mart(
    header: DataFrame,
    revenue: DataFrame,
    amounts: DataFrame,
    tag_set: DataFrame,
    source: DataFrame,
    customer: DataFrame,
    since_year: int,
    on: tuple[str, ...] = ("trans_id", "period"),
    pre_aggregate: bool = False,
) -> DataFrame:
    """Amounts by transaction codes, months, tags and customer.

    Inputs: header (``on``, period, customer_id, type_code, activity_code, fund_code, process_date,
    fiscal_date), revenue (``on``, data_type, revenue_fund_code), amounts (``on``, tag_set_id, offset_code,
    status_code, incur_date, amount), tag_set (tag_set_id, unit, account, location, product),
    source (``on``, source_type, suffix; optional match) and customer (customer_id, customer_name).

    Months are formed before the joins, on the shortest rows, and the joins on ``on`` come first, so
    they share one partitioning. ``pre_aggregate`` sums the amounts by the finer keys before any
    join, looks the customer up after the grouping, and returns the same rows (customers are unique
    by customer_id). Decimal amounts give sums that do not depend on the order of addition.
    """
    keys = list(on)
    # The text bound says the same of four-digit years and, unlike the number, reaches the scan.
    recent = (F.col("period") >= F.lit(f"{since_year:04d}")) & (number_prefix("period", 4) >= since_year)
    wanted = header.filter(recent).select(
        *dict.fromkeys([*keys, "period", "customer_id", "type_code", "activity_code", "fund_code"]),
        month_key("process_date").alias("process_month"),
        month_key("fiscal_date").alias("fiscal_month"),
    )
    nonzero = amounts.filter("amount <> 0").select(
        *keys,
        "tag_set_id",
        "offset_code",
        "status_code",
        month_key("incur_date").alias("incur_month"),
        "amount",
    )
    if pre_aggregate:
        fine = [*keys, "tag_set_id", "offset_code", "status_code", "incur_month"]
        nonzero = nonzero.join(wanted.select(*keys), keys, "left_semi").groupBy(*fine).agg(F.sum("amount").alias("amount"))
    tags = tag_set.withColumn("location", F.substring("location", 1, 5))
    joined = (
        nonzero.join(wanted, keys)
        .join(revenue, keys)
        .join(source, keys, "left")
        .join(tags, "tag_set_id")
        .withColumn("fund_code", F.coalesce("revenue_fund_code", "fund_code"))
    )
    groups = [
        "period",
        "customer_id",
        "type_code",
        "activity_code",
        "fund_code",
        "process_month",
        "fiscal_month",
        "data_type",
        "source_type",
        "suffix",
        "offset_code",
        "status_code",
        "incur_month",
        "unit",
        "account",
        "location",
        "product",
    ]
    total = F.sum("amount").alias("amount")
    if pre_aggregate:
        # A group has few rows by now, so sums before the shuffle would only hold all groups of a task in memory beside the joins.
        return joined.repartition(*groups).groupBy(*groups).agg(total).join(customer, "customer_id", "left")
    return joined.join(customer, "customer_id", "left").groupBy(*groups, "customer_name").agg(total)


def claim_mart(
    header: DataFrame,
    line: DataFrame,
    amounts: DataFrame,
    codes: DataFrame,
    names: dict[object, str],
    as_of: dt.date,
    days: int,
    at_least: Column,
    header_ok: Column,
    line_ok: Column,
    modifier: str,
    modifiers: list[str],
) -> DataFrame:
    """Recent claim lines with their amounts by code, units and group label.

    Inputs: header (claim_id, claim_type, contract, paid_date), line (claim_id, line_no, service_code,
    units_a, units_b, modifier columns), amounts (claim_id, line_no, code, amount). Amounts are
    summed by the join keys first, so no line is multiplied by its amount rows. ``at_least`` filters
    on the summed amounts, only amounts of wanted lines are summed, ``modifier`` must be in one of the ``modifiers`` columns, and the group
    label says whether the contract is in ``codes``.
    """
    recent = filter_last_days(header, "paid_date", days, as_of).filter(header_ok)
    lines = line.filter(line_ok & any_column_equals(modifiers, modifier))
    keys = ["claim_id", "line_no"]
    claimed = recent.join(lines, "claim_id")
    wanted = amounts.join(claimed.select(*keys), keys, "left_semi")
    joined = claimed.join(sum_by_code(wanted, keys, "code", F.col("amount"), names).filter(at_least), keys)
    labelled = classify_in_list(joined, "contract", codes, "listed", "other", "contract_group")
    unit_count = F.coalesce("units_a", "units_b", F.lit(0))
    return labelled.groupBy(
        *keys, "claim_type", "contract", "paid_date", "service_code", "contract_group"
    ).agg(
        *[F.sum(quoted(n)).alias(n) for n in names.values()],
        F.sum(unit_count).alias("units"),
    )
