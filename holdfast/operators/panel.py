"""Customer-month panel from fact tables.

Orders and lines are combined into customer-month counts first, so a customer who
holds a large part of all orders reaches the panel shuffle as at most one row per
month. Customers and counts then travel together in one shuffle by customer; the
month spine is expanded behind it, and every trailing or forward frame reuses that
partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.numeric import cents, clip, flag, index, ratio, round_even, sigmoid, total
from holdfast.operators.summary import totals
from holdfast.schema import CUSTOMER, MONTH, PANEL_COLUMNS, PANEL_SCHEMA, TARGET, require_columns


@dataclass(frozen=True)
class PanelSpec:
    """Month range of a panel.

    ``months`` calendar months start at ``start_month``; the last of them whose facts
    are complete is ``complete_months``. A snapshot is kept when it has ``lookback``
    months behind it (itself included) and ``horizon`` complete months ahead.
    """

    start_month: str = "1995-01"
    months: int = 80
    complete_months: int = 79
    lookback: int = 12
    horizon: int = 3

    @property
    def start(self) -> date:
        year, month = self.start_month.split("-")
        return date(int(year), int(month), 1)

    @property
    def first_snapshot(self) -> int:
        return self.lookback

    @property
    def last_snapshot(self) -> int:
        return self.complete_months - self.horizon

    def label(self, ordinal: int) -> str:
        months = self.start.year * 12 + self.start.month - 1 + ordinal - 1
        return f"{months // 12:04d}-{months % 12 + 1:02d}"

    def snapshot_months(self) -> list[str]:
        return [self.label(m) for m in range(self.first_snapshot, self.last_snapshot + 1)]


# Nested account-balance limits of the past-due bands, worst band last.
PAST_DUE_LIMITS = ((0.0, "current"), (-500.0, "1-30"), (-800.0, "31-60"))
# Upper account-balance limits of the age bands.
AGE_LIMITS = ((0.0, "18-29"), (3000.0, "30-44"), (6500.0, "45-59"))
# Region type by region key, relationship segment by market segment.
REGION_TYPES = {0: "urban", 1: "suburban", 2: "regional", 3: "rural", 4: "urban"}
SEGMENTS = {
    "AUTOMOBILE": "emerging",
    "BUILDING": "core",
    "HOUSEHOLD": "core",
    "FURNITURE": "established",
    "MACHINERY": "high_value",
}
# Intercept and coefficients of the attrition logit.
PROPENSITY_INTERCEPT = -0.80
PROPENSITY_WEIGHTS = (
    ("active_products", -0.020),
    ("tenure_months", -0.010),
    ("relationship_value_index", -0.011),
    ("satisfaction_proxy_score", -0.010),
    ("repayment_behaviour_score", -0.006),
    ("last_digital_activity_days", 0.020),
    ("complaint_count_180d", 0.055),
    ("process_friction_score", 0.012),
    ("digital_engagement_trend_3m", -0.014),
)
PROPENSITY_BAND_WEIGHTS = (("31-60", 0.20), ("61+", 0.42))
PROPENSITY_RANGE = (0.005, 0.65)

# Rows of the dense table, of about 300 bytes, that one task sorts at most on average.
ROWS_PER_TASK = 500_000

_COUNTS = ("orders", "lines", "returned", "quantity_cents", "value_cents", "urgent",
           "urgent_closed", "partial")


def _lookup(key: Column, table: dict) -> Column:
    result = None
    for value, label in table.items():
        result = F.when(key == value, label) if result is None else result.when(key == value, label)
    return result


def month_ordinal(moment: Column, spec: PanelSpec) -> Column:
    """1 for the start month, 2 for the next, and so on."""
    origin = spec.start.year * 12 + spec.start.month - 1
    return F.year(moment) * 12 + F.month(moment) - F.lit(origin)


def month_label(ordinal: Column, spec: PanelSpec) -> Column:
    """yyyy-MM of a month of the range, looked up: no date is formatted row by row."""
    labels = [F.lit(spec.label(m)) for m in range(1, spec.months + 1)]
    return F.get(F.array(*labels), ordinal - 1)


def month_end(ordinal: Column, spec: PanelSpec) -> Column:
    """Last day of a month of the range."""
    starts = [date.fromisoformat(f"{spec.label(m + 1)}-01") for m in range(1, spec.months + 1)]
    return F.get(F.array(*[F.lit(s - timedelta(days=1)) for s in starts]), ordinal - 1)


def monthly_activity(orders: DataFrame, lineitem: DataFrame, spec: PanelSpec) -> DataFrame:
    """Integer activity counts per customer and month with at least one order."""
    lines = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(flag(F.col("l_returnflag") == "R")).alias("returned"),
        F.sum(cents(F.col("l_quantity"))).alias("quantity_cents"),
    )
    urgent = F.col("o_orderpriority") == "1-URGENT"
    keyed = orders.select(
        "o_orderkey",
        F.col("o_custkey").alias(CUSTOMER),
        month_ordinal(F.col("o_orderdate"), spec).alias("m"),
        F.to_date("o_orderdate").alias("order_day"),
        cents(F.col("o_totalprice")).alias("value_cents"),
        flag(urgent).alias("urgent"),
        flag(urgent & (F.col("o_orderstatus") == "F")).alias("urgent_closed"),
        flag(F.col("o_orderstatus") == "P").alias("partial"),
    ).where(F.col("m").between(1, spec.months))
    return (
        keyed.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy(CUSTOMER, "m")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in _COUNTS[1:]],
            F.max("order_day").alias("last_day"),
        )
    )


def customer_attributes(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """One row per customer with the raw attributes the panel spreads over its months."""
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias(CUSTOMER), "c_acctbal", "n_regionkey", "c_mktsegment"
    )


def month_spine(dense: DataFrame, spec: PanelSpec) -> DataFrame:
    """Keys of the dense rows: every customer with every month ``m`` of the range."""
    return dense.select(CUSTOMER, "m", month_label(F.col("m"), spec).alias(MONTH))


def dense_activity(customers: DataFrame, monthly: DataFrame, spec: PanelSpec) -> DataFrame:
    """Spine rows with their counts, zero where idle, hash-partitioned by customer.

    Attributes and active months are combined to one row per customer, each count in a
    list beside that of the months; only then is the spine exploded, and every month looks its counts up. So
    what is sorted to be combined are customers and active months, not all months.

    The partition count is explicit because adaptive execution sizes partitions by
    the rows that enter the shuffle, and the spine multiplies them afterwards. It is the
    session's, or more where a task would get over ``ROWS_PER_TASK`` rows to sort.
    """
    rows = customers.count() * spec.months
    session = int(customers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(session, ceil(rows / ROWS_PER_TASK))
    attributes = ["c_acctbal", "n_regionkey", "c_mktsegment"]
    measures = [*_COUNTS, "last_day"]
    spine = customers.select(CUSTOMER, *attributes, F.lit(1).alias("known"))
    counts = monthly.select(CUSTOMER, "m", *measures, F.lit(0).alias("known"))
    # A list a measure, so that those not asked for are not read; a struct, as nulls are left out.
    active = F.col("m").isNotNull()
    combined = (
        spine.unionByName(counts, allowMissingColumns=True)
        .repartition(partitions, CUSTOMER)
        .groupBy(CUSTOMER)
        .agg(
            *[F.max(c).alias(c) for c in attributes],
            F.collect_list("m").alias("at"),
            *[F.collect_list(F.when(active, F.struct(c))).alias(c) for c in measures],
            F.max("known").alias("known"),
        )
        .where(F.col("known") == 1)
    )
    months = F.explode(F.sequence(F.lit(1), F.lit(spec.months))).alias("m")
    place = F.array_position("at", F.col("m")).cast("int") - 1

    def held(name: str) -> Column:
        return F.get(F.col(name), place)[name]

    return combined.select(CUSTOMER, *attributes, "at", *measures, months).select(
        CUSTOMER, "m", *attributes,
        *[F.coalesce(held(c), F.lit(0)).alias(c) for c in _COUNTS],
        held("last_day").alias("last_day"),
        F.lit(1).alias("known"),
    )


def spread_attributes(dense: DataFrame) -> DataFrame:
    """Replace the raw customer attributes by their bands, types and savings measures.

    Done below the frames, which end a code-generation stage, to keep the generated
    method above them small enough to be compiled to machine code.
    """
    balance = F.col("c_acctbal")
    return dense.withColumns(
        {
            "age_band": age_band(balance),
            "region_type": _lookup(F.col("n_regionkey"), REGION_TYPES),
            "relationship_segment": _lookup(F.col("c_mktsegment"), SEGMENTS),
            "has_savings_product": flag(balance > 0),
            "savings_balance_index": index((balance + 1000.0) / 110.0),
            "credit_band": balance_band(balance),
        }
    ).drop("c_acctbal", "n_regionkey", "c_mktsegment")


def trailing_frames(dense: DataFrame, spec: PanelSpec) -> DataFrame:
    """Trailing 3/6/12-month sums, running first and last activity, forward orders.

    A customer has one row a month, and all sums are of integers. So a sum over some months is
    the difference of two running sums, which costs one addition and one look back a row, where
    a sliding frame copies each row and adds up all rows inside it again.
    """
    over = f"PARTITION BY {CUSTOMER} ORDER BY m"
    running = f"({over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    spans = {
        3: ("orders", "lines", "urgent", "urgent_closed"),
        6: ("lines", "returned", "quantity_cents"),
        12: ("lines", "value_cents", "partial", "urgent"),
    }
    summed = dict.fromkeys(name for names in spans.values() for name in names)
    added = dense.selectExpr(
        "*",
        *[f"sum({name}) OVER {running} AS {name}_sum" for name in summed],
        f"min(CASE WHEN orders > 0 THEN m END) OVER {running} AS first_m",
        f"max(last_day) OVER {running} AS last_seen",
    )

    def back(name: str, months: int) -> str:
        return f"lag({name}_sum, {months}, 0L) OVER ({over})"

    whole = f"({over} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    ahead = f"lead(orders_sum, {spec.horizon}) OVER ({over})"
    return added.selectExpr(
        *[f"`{c}`" for c in dense.columns],
        *[
            f"{name}_sum - {back(name, months)} AS {name}_k{months}"
            for months, names in spans.items() for name in names
        ],
        f"{back('lines', 3)} - {back('lines', 6)} AS lines_before",
        f"coalesce({ahead}, last(orders_sum) OVER {whole}) - orders_sum AS orders_ahead",
        "first_m", "last_seen",
    )


def days_since(last_seen: Column, month_end: Column) -> Column:
    """Days from the last activity to the month end, at most 180; 180 when there is none."""
    return F.coalesce(clip(F.datediff(month_end, last_seen), 0, 180), F.lit(180))


def balance_band(balance: Column) -> Column:
    """Past-due band of a credit holder, by account balance."""
    band = None
    for limit, label in PAST_DUE_LIMITS:
        test = balance >= limit
        band = F.when(test, label) if band is None else band.when(test, label)
    return band.otherwise("61+")


def past_due_band(has_credit: Column, band: Column) -> Column:
    return F.when(has_credit == 0, "no_credit_product").otherwise(band)


def age_band(balance: Column) -> Column:
    band = None
    for limit, label in AGE_LIMITS:
        test = balance < limit
        band = F.when(test, label) if band is None else band.when(test, label)
    return band.otherwise("60+")


def propensity(panel: DataFrame) -> DataFrame:
    """Keys and the attrition probability of the linear logit."""
    band = F.col("days_past_due_band")
    logit = total(
        [F.lit(PROPENSITY_INTERCEPT)]
        + [F.lit(weight) * F.col(name) for name, weight in PROPENSITY_WEIGHTS]
        + [F.lit(weight) * flag(band == label) for label, weight in PROPENSITY_BAND_WEIGHTS]
    )
    return panel.withColumn(
        "attrition_propensity", round_even(clip(sigmoid(logit), *PROPENSITY_RANGE), 6)
    )


def seasonal_effect(month_index: Column) -> Column:
    """Yearly sine term; adding 0.0 turns a negative zero into zero."""
    wave = 0.15 * F.sin((month_index / F.lit(12.0)) * F.lit(2.0) * F.pi())
    return round_even(wave, 6) + F.lit(0.0)


def dense_facts(
    customer: DataFrame, nation: DataFrame, orders: DataFrame, lineitem: DataFrame, spec: PanelSpec
) -> DataFrame:
    """The rows all frames run over: attributes and counts of every customer and month."""
    require_columns(customer, ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"], "customer")
    require_columns(nation, ["n_nationkey", "n_regionkey"], "nation")
    require_columns(
        orders,
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        "orders",
    )
    require_columns(lineitem, ["l_orderkey", "l_quantity", "l_returnflag"], "lineitem")

    return dense_activity(
        customer_attributes(customer, nation), monthly_activity(orders, lineitem, spec), spec
    )


def build_panel(
    customer: DataFrame,
    nation: DataFrame,
    orders: DataFrame,
    lineitem: DataFrame,
    spec: PanelSpec = PanelSpec(),
) -> DataFrame:
    """The 30-column panel: one row per customer and snapshot month."""
    dense = dense_facts(customer, nation, orders, lineitem, spec)
    framed = trailing_frames(spread_attributes(dense), spec).where(
        F.col("m").between(spec.first_snapshot, spec.last_snapshot)
    )
    return panel_columns(framed, spec)


def panel_columns(framed: DataFrame, spec: PanelSpec) -> DataFrame:
    """Bounded indexes, scores, bands and the label from the framed counts."""
    c = F.col
    direct = framed.select(
        CUSTOMER,
        month_label(c("m"), spec).alias(MONTH),
        (c("m") - F.lit(spec.first_snapshot - 1)).alias("customer_month_index"),
        F.coalesce(c("m") - c("first_m"), F.lit(0)).alias("tenure_months"),
        "age_band", "region_type", "relationship_segment",
        "has_savings_product", "savings_balance_index",
        clip(F.floor(c("lines_k12") / 2), 1, 7).cast("int").alias("active_products"),
        flag(c("partial_k12") > 0).alias("has_credit_product"),
        flag(c("urgent_k12") > 0).alias("has_digital_wallet"),
        index(c("value_cents_k12") / 100.0 / 15000.0).alias("credit_balance_index"),
        c("lines").alias("app_logins_30d"),
        c("orders").alias("web_logins_30d"),
        c("lines_k3").alias("digital_transactions_30d"),
        days_since(c("last_seen"), month_end(c("m"), spec)).alias("last_digital_activity_days"),
        index(5 * (c("lines_k3") - c("lines_before")), -50, 50).alias("digital_engagement_trend_3m"),
        c("urgent_k3").alias("contact_attempts_90d"),
        c("urgent_closed_k3").alias("successful_contacts_90d"),
        c("returned_k6").alias("complaint_count_180d"),
        F.when(c("lines_k6") == 0, F.lit(0.0))
        .otherwise(index(c("quantity_cents_k6") / 100.0 / (5.0 * c("lines_k6")), 0, 45))
        .alias("average_resolution_days"),
        flag(c("urgent") > 0).alias("recent_credit_application_flag"),
        flag((c("orders_k3") > 0) & (c("orders_ahead") == 0)).alias(TARGET),
        past_due_band(flag(c("partial_k12") > 0), c("credit_band")).alias("days_past_due_band"),
    )
    valued = direct.withColumns(
        {
            "relationship_value_index": index(
                0.55 * c("savings_balance_index")
                + 0.30 * c("credit_balance_index")
                + 4.0 * c("active_products")
            ),
            "digital_engagement_score": index(
                20.0
                + 2.0 * c("app_logins_30d")
                + 1.2 * c("web_logins_30d")
                + 1.7 * c("digital_transactions_30d")
                - 0.25 * c("last_digital_activity_days")
            ),
        }
    )
    friction = valued.withColumn(
        "process_friction_score",
        index(
            15.0
            + 8.5 * c("complaint_count_180d")
            + 1.2 * c("average_resolution_days")
            + 0.15 * c("last_digital_activity_days")
            - 0.12 * c("digital_engagement_score")
        ),
    )
    satisfied = friction.withColumn(
        "satisfaction_proxy_score",
        index(
            82.0
            - 0.55 * c("process_friction_score")
            - 3.2 * c("complaint_count_180d")
            + 0.12 * c("digital_engagement_score")
            + 0.06 * c("relationship_value_index")
        ),
    )
    repaid = satisfied.withColumn(
        "repayment_behaviour_score",
        index(
            78.0
            + 0.12 * c("relationship_value_index")
            + 0.08 * c("satisfaction_proxy_score")
            - 0.25 * c("process_friction_score")
        ),
    )
    return repaid.select(*[c(f.name).cast(f.dataType).alias(f.name) for f in PANEL_SCHEMA])


def missing_cells(df: DataFrame) -> Column:
    """Number of null cells in a row, over all columns."""
    return total([flag(F.col(name).isNull()) for name in df.columns])


def summarise_panel(panel: DataFrame) -> DataFrame:
    """One row: rows, customers, months, columns, target rate, missing cells."""
    require_columns(panel, PANEL_COLUMNS, "panel")
    counted = totals(
        panel,
        {"positives": F.col(TARGET), "labelled": flag(F.col(TARGET).isNotNull()), "missing_values": missing_cells(panel)},
    )
    return counted.select(
        "rows", "customers", "months",
        F.lit(len(panel.columns)).alias("columns"),
        ratio(F.col("positives"), F.col("labelled")).alias("target_rate"),
        "missing_values",
    )
