"""Exploration tables over the cleaned sale register."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger import schemas
from landledger.functions import dates, numbers, text
from landledger.functions.dates import month_name, quarter_label
from landledger.functions.numbers import float_mean, plain_number, ratio
from landledger.operators.grouped_stats import (
    MEDIAN,
    SPLIT_COUNTS,
    _scale,
    as_float,
    float_stats,
    grouped_stats,
    histogram,
    histogram_rows,
    masked_stats,
    quantile_rows,
    quantile_table,
    ranked,
    split_at_quantile,
)
from landledger.operators.profile import (
    checked,
    drop_exact_duplicates,
    missing_rows,
    missing_summary,
    require_columns,
)
from landledger.operators.series import first_and_last, growth_pct, share_of_total
from landledger.operators.shared_tally import SharedTally
from landledger.plans.cleaning import (
    REGISTER_NAMES,
    TEXT_COLUMNS,
    default_missing_column,
    rename_columns,
    reorder_project,
)
from landledger.storage import materialise, run_together

# Reported price quantiles.
PRICE_QUANTILES = [0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99, 0.995, 0.999]
EXTREME_QUANTILE = 0.999
EXTREME_COLUMNS = [
    "sale_date", "address", "county", "price_eur", "property_description",
    "is_new_property", "is_second_hand_property", "is_not_full_market_price", "is_vat_exclusive",
]


def _stored(df: DataFrame) -> DataFrame:
    return materialise(df, "exploration-transactions")


def load_tx_eda(
    df: DataFrame,
    store: Callable[[DataFrame], DataFrame] = _stored,
    distinct: Callable[[DataFrame], DataFrame] = drop_exact_duplicates,
) -> DataFrame:
    """Analysis table from a cleaned (or source-named) register table, stored by ``store``.

    Removes copies again, by ``distinct``, retypes, and uses the exploration flags and size
    classes; prices are not rounded. Invalid dates, unreadable and non-positive prices raise: the table is stored
    with all its columns here, so no later reading of a few of them can leave the checks out.
    """
    df = rename_columns(distinct(df), REGISTER_NAMES)
    require_columns(df, ["sale_date", "address", "county", "price_eur", "property_description"])
    for c in ("eircode", "not_full_market_price", "vat_exclusive", "property_size_description"):
        df = default_missing_column(df, c)
    df = df.withColumns({c: text.trim_text(F.col(c).cast("string")) for c in TEXT_COLUMNS})
    df = df.withColumns(
        {
            "sale_date": F.col("sale_date").try_cast("date"),
            "price_eur": numbers.as_price(numbers.parse_price(F.col("price_eur").cast("string"))),
        }
    )
    rules = eda_rules()
    dated = {rule: rules.pop(rule) for rule in ["invalid sale dates"]}
    df = df.withColumns({"sale_date": checked("sale_date", dated), "price_eur": checked("price_eur", rules)})
    df = df.withColumns(
        {
            **dates.calendar_parts("sale_date", "sale_"),
            "is_not_full_market_price": text.is_yes_any_case("not_full_market_price"),
            "is_vat_exclusive": text.is_yes_any_case("vat_exclusive"),
            "is_new_property": text.mentions("property_description", text.NEW_PHRASE),
            "is_second_hand_property": text.mentions(
                "property_description", text.SECOND_HAND_PHRASE_EDA
            ),
            "property_size_category": text.size_category_eda("property_size_description"),
        }
    )
    return store(reorder_project(df, schemas.TX_COLUMNS))


def eda_rules() -> dict[str, Column]:
    return {
        "invalid sale dates": F.col("sale_date").isNull(),
        "invalid prices": F.col("price_eur").isNull(),
        "non-positive prices": F.col("price_eur") <= 0,
    }


# ---- from the table itself, or from the shared tally of an exploration job -----------------------
# The grouping sets of the exploration tables.
GROUPINGS = {
    "year": ["sale_year"],
    "year_month": ["sale_year_month"],
    "quarter": ["sale_year", "sale_quarter"],
    "month": ["sale_month"],
    "county": ["county"],
    "county_year": ["county", "sale_year"],
    "description": ["property_description"],
    "size": ["property_size_category"],
}
# those of the flags and of all rows; an unknown flag counts as without it
FLAG_GROUPS = {"all": [], "new": ["is_new_property"], "second": ["is_second_hand_property"], "market": ["is_not_full_market_price"], "vat": ["is_vat_exclusive"]}
FLAGS = ["is_new_property", "is_second_hand_property", "is_not_full_market_price", "is_vat_exclusive"]
HISTOGRAM_QUANTILE = 0.99


@dataclass
class Tallied:
    """What the exploration tables need, rolled up from one tally of the analysis table."""

    columns: list[str]
    scale: int
    groups: dict[str, DataFrame]  # statistics by grouping set
    values: DataFrame  # rows of each price
    facts: DataFrame  # one row: counts, missing cells, first and last date, years
    marks: DataFrame  # one row: quantiles of all prices
    sides: DataFrame  # statistics of all rows, those below the extreme quantile and those from it on

    def masked(self, label: str, masks: list[tuple[str, str, bool]]) -> DataFrame:
        """Statistics of (name, flag, whether the flag is on), with their share of all rows; masks without rows stay."""
        spark = self.facts.sparkSession
        named = spark.createDataFrame(
            [(i, *mask) for i, mask in enumerate(masks)], f"_position int, `{label}` string, _flag string, _on boolean"
        )
        sets = {own[0]: name for name, own in FLAG_GROUPS.items() if own}
        found = None
        for flag in dict.fromkeys(flag for _, flag, _ in masks):
            one = self.groups[sets[flag]].withColumnRenamed(flag, "_on").withColumn("_flag", F.lit(flag))
            found = one if found is None else found.unionByName(one)
        kind = found.schema["total_value"].dataType
        share = F.try_divide(F.col("transactions").cast("double"), F.col("rows").cast("double")) * 100.0
        return (
            named.join(found, ["_flag", "_on"], "left")
            .join(F.broadcast(self.facts.select("rows")))
            .orderBy("_position")
            .select(
                label, F.coalesce("transactions", F.lit(0)).alias("transactions"),
                F.coalesce(share, F.lit(0.0)).alias("transaction_share_pct"), "mean_price", "median_price",
                F.coalesce("total_value", F.lit(0).cast(kind)).alias("total_value"),
            )
        )

    def grouped(self, keys: list[str]) -> DataFrame:
        return self.groups[next(name for name, own in GROUPINGS.items() if own == keys)]


def tally_transactions(tx: DataFrame) -> Tallied:
    """Roll everything up from one scan of ``tx``."""
    dimensions = [*dict.fromkeys(k for keys in GROUPINGS.values() for k in keys), *FLAGS]
    cells = [c for c in tx.columns if c not in dimensions and c != "price_eur"]
    facts = {f"missing_{c}": (F.count_if(F.col(c).isNull()), "sum") for c in cells}
    facts |= {"first": (F.min("sale_date"), "min"), "last": (F.max("sale_date"), "max")}
    facts |= {f"missing_{flag}": (F.count_if(F.col(f"_unknown_{flag}")), "sum") for flag in FLAGS}
    unknown = {f"_unknown_{flag}": F.col(flag).isNull() for flag in FLAGS}
    shared = SharedTally(tx.withColumns(unknown).withColumns({flag: F.coalesce(flag, F.lit(False)) for flag in FLAGS}), "price_eur", dimensions, facts)
    missing = {f"missing_{d}": F.sum(F.when(F.col(d).isNull(), F.col("_rows")).otherwise(0)) for d in dimensions if d not in FLAGS}
    missing["missing_price_eur"] = F.sum(F.when(F.col("_c").isNull(), F.col("_rows")).otherwise(0))
    extra = missing | {flag: F.sum(F.when(F.col(flag), F.col("_rows")).otherwise(0)) for flag in FLAGS}
    extra["years"] = F.count_distinct("sale_year")
    found: dict[str, DataFrame] = {}

    def values_and_marks() -> None:
        found["values"] = shared.by_value()
        points = {**{f"q{i}": q for i, q in enumerate(PRICE_QUANTILES)}, "limit": HISTOGRAM_QUANTILE, "extreme": EXTREME_QUANTILE}
        marks = ranked(found["values"], [], shared.scale, {**points, "median": 0.5}, reread=True)
        found["marks"] = materialise(marks, "tally-marks")
        limit = found["marks"].select(F.col("extreme_0").alias("_limit"))
        found["sides"] = shared.masks(found["values"].join(F.broadcast(limit)), SPLIT_COUNTS)

    groups, totals, _ = run_together([lambda: shared.stats(GROUPINGS | FLAG_GROUPS), lambda: shared.totals(extra), values_and_marks])
    return Tallied(list(tx.columns), shared.scale, groups, found["values"], totals, found["marks"], found["sides"])


def _masked(tx: DataFrame | Tallied, label: str, masks: list[tuple[str, str, bool]]) -> DataFrame:
    """Statistics of masks: (name, flag, whether it is on); an unknown flag is off."""
    if isinstance(tx, Tallied):
        return tx.masked(label, masks)
    on = {flag: F.coalesce(F.col(flag), F.lit(False)) for _, flag, _ in masks}
    return masked_stats(tx, "price_eur", [(name, on[flag] if is_on else ~on[flag]) for name, flag, is_on in masks], label)


def dataset_summary(tx: DataFrame | Tallied) -> DataFrame:
    """Seven (metric, value) rows, values as text, unrounded to twelve decimals; one scan."""
    if isinstance(tx, Tallied):
        facts, median, scale = tx.facts, tx.marks.select("median_0"), tx.scale
    else:
        scale = _scale(tx, "price_eur")
        shared = SharedTally(tx, "price_eur", [], {"first": (F.min("sale_date"), "min"), "last": (F.max("sale_date"), "max")})
        facts, median = shared.totals({}), ranked(shared.tally, [], scale, MEDIAN).select("median_0")
    figures = [
        ("rows", F.col("rows").cast("string")),
        ("columns", F.lit(str(len(tx.columns)))),
        ("start_date", F.col("first").cast("string")),
        ("end_date", F.col("last").cast("string")),
        ("total_transaction_value", plain_number(F.col("total"), scale)),
        ("mean_transaction_price", plain_number(float_mean(F.col("total"), F.col("value_rows")), 12)),
        ("median_transaction_price", plain_number(as_float("median_0", scale), 12)),
    ]
    table = F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in figures])
    return facts.join(F.broadcast(median)).select(F.inline(table))


def missing_values(tx: DataFrame | Tallied) -> DataFrame:
    if isinstance(tx, Tallied):
        return missing_rows(tx.facts, {c: f"missing_{c}" for c in tx.columns}, "rows")
    return missing_summary(tx)


_STATS = ["transactions", "total_value", "mean_price", "median_price"]


def _all_stats(tx: DataFrame | Tallied, keys: list[str]) -> DataFrame:
    return tx.grouped(keys) if isinstance(tx, Tallied) else float_stats(tx, keys, "price_eur")


def _period_stats(tx: DataFrame | Tallied, keys: list[str]) -> DataFrame:
    if isinstance(tx, Tallied):
        return tx.grouped(keys).dropna(subset=keys)
    return float_stats(tx.dropna(subset=keys), keys, "price_eur")


def annual_market_analysis(tx: DataFrame) -> DataFrame:
    growth = {
        "transactions": "transaction_growth_pct",
        "median_price": "median_price_growth_pct",
        "mean_price": "mean_price_growth_pct",
    }
    return growth_pct(_period_stats(tx, ["sale_year"]), growth, ["sale_year"]).orderBy("sale_year")


_TWO_GROWTHS = {
    "transactions": "transaction_growth_pct",
    "median_price": "median_price_growth_pct",
}


def monthly_market_analysis(tx: DataFrame) -> DataFrame:
    stats = _period_stats(tx, ["sale_year_month"])
    return growth_pct(stats, _TWO_GROWTHS, ["sale_year_month"]).orderBy("sale_year_month")


def quarterly_market_analysis(tx: DataFrame) -> DataFrame:
    keys = ["sale_year", "sale_quarter"]
    stats = _period_stats(tx, keys).withColumn(
        "quarter_label", quarter_label("sale_year", "sale_quarter")
    )
    return growth_pct(stats, _TWO_GROWTHS, keys).orderBy(*keys)


def monthly_seasonality(tx: DataFrame | Tallied) -> DataFrame:
    """By calendar month, with the average per distinct year of the table; one scan."""
    if isinstance(tx, Tallied):
        stats, years = _period_stats(tx, ["sale_month"]), tx.facts.select(F.col("years").alias("_years"))
    else:
        shared = SharedTally(tx.select("sale_month", "sale_year", "price_eur"), "price_eur", ["sale_month", "sale_year"])
        stats = shared.stats({"month": ["sale_month"]})["month"].dropna(subset=["sale_month"])
        years = shared.tally.agg(F.count_distinct("sale_year").alias("_years"))
    return (
        stats.join(F.broadcast(years))
        .select(
            "sale_month",
            "transactions",
            "mean_price",
            "median_price",
            month_name("sale_month").alias("month_name"),
            ratio("transactions", "_years").alias("average_transactions_per_year"),
        )
        .orderBy("sale_month")
    )


def county_market_analysis(tx: DataFrame) -> DataFrame:
    """By county; the share's base counts rows without a county too."""
    stats = share_of_total(
        _all_stats(tx, ["county"]), "transactions", "national_transaction_share_pct"
    )
    return (
        stats.filter(F.col("county").isNotNull())
        .select(
            "county", "transactions", "mean_price", "median_price", "total_value",
            "national_transaction_share_pct",
        )
        .orderBy(F.desc("transactions"), "county")
    )


def county_price_growth(tx: DataFrame) -> DataFrame:
    """Median price of each county's first and latest observed year."""
    yearly = _period_stats(tx, ["county", "sale_year"])
    ends = first_and_last(yearly, "county", "sale_year", ["median_price", "transactions"])
    first, last = F.col("first_median_price"), F.col("latest_median_price")
    growth = F.when(first > 0, (last - first) / F.nullif(first, F.lit(0.0)) * F.lit(100.0))
    return ends.select(
        "county",
        F.col("first_sale_year").alias("first_year"),
        first.alias("first_year_median_price"),
        F.col("latest_sale_year").alias("latest_year"),
        last.alias("latest_year_median_price"),
        growth.alias("median_price_growth_pct"),
        F.col("first_transactions").alias("first_year_transactions"),
        F.col("latest_transactions").alias("latest_year_transactions"),
    ).orderBy("county")


def new_vs_second_hand(tx: DataFrame) -> DataFrame:
    """Two masks that may overlap."""
    masks = [("New", "is_new_property", True), ("Second-Hand", "is_second_hand_property", True)]
    return _masked(tx, "property_type", masks)


def property_description_analysis(tx: DataFrame) -> DataFrame:
    return (
        _period_stats(tx, ["property_description"])
        .drop("total_value")
        .orderBy(F.desc("transactions"), "property_description")
    )


def property_size_analysis(tx: DataFrame) -> DataFrame:
    stats = share_of_total(
        _all_stats(tx, ["property_size_category"]),
        "transactions",
        "transaction_share_pct",
    )
    return (
        stats.filter(F.col("property_size_category").isNotNull())
        .drop("total_value")
        .orderBy(F.desc("transactions"), "property_size_category")
    )


def _complement(tx: DataFrame, flag: str, without: str, within: str, label: str) -> DataFrame:
    return _masked(tx, label, [(without, flag, False), (within, flag, True)]).drop("total_value")


def non_full_market_price(tx: DataFrame) -> DataFrame:
    return _complement(
        tx, "is_not_full_market_price", "Full Market Price", "Not Full Market Price",
        "market_price_category",
    )


def vat_exclusive(tx: DataFrame) -> DataFrame:
    return _complement(
        tx, "is_vat_exclusive", "Not VAT Exclusive", "VAT Exclusive", "vat_category"
    )


def price_percentiles(tx: DataFrame | Tallied, with_range: bool = False) -> DataFrame:
    if isinstance(tx, Tallied):
        columns = {dates.quantile_label(q): f"q{i}_0" for i, q in enumerate(PRICE_QUANTILES)}
        return quantile_table(tx.marks, columns, "price_eur", tx.scale)
    return quantile_rows(tx, "price_eur", PRICE_QUANTILES, with_range)


def price_histogram(tx: DataFrame | Tallied, bins: int = 50, upto_quantile: float = HISTOGRAM_QUANTILE) -> DataFrame:
    if isinstance(tx, Tallied):
        return histogram_rows(tx.values, tx.marks.select(F.col("limit_0").alias("_limit")), bins, tx.scale)
    return histogram(tx, "price_eur", bins, upto_quantile)


def _threshold(tx: DataFrame, quantile: float) -> DataFrame:
    return grouped_stats(tx, [], "price_eur", {"_limit": quantile}).select(
        as_float("_limit", _scale(tx, "price_eur")).alias("_limit")
    )


def extreme_rows(tx: DataFrame, quantile: float = EXTREME_QUANTILE, limit: DataFrame | None = None) -> DataFrame:
    """Rows at or above the quantile, or the one row of ``limit``; the threshold is one broadcast row."""
    high = F.col("price_eur").cast("double") >= F.col("_limit")
    limit = _threshold(tx, quantile) if limit is None else limit
    return tx.join(F.broadcast(limit)).filter(high).drop("_limit")


def as_extreme_report(rows: DataFrame) -> DataFrame:
    columns = [c for c in EXTREME_COLUMNS if c in rows.columns]
    return rows.select(*columns).orderBy(
        F.desc("price_eur"), *[c for c in columns if c != "price_eur"]
    )


def extreme_transactions(tx: DataFrame, quantile: float = EXTREME_QUANTILE) -> DataFrame:
    """The extreme rows as reported, dearest first."""
    return as_extreme_report(extreme_rows(tx, quantile))


def extreme_comparison(tx: DataFrame | Tallied, quantile: float = EXTREME_QUANTILE) -> DataFrame:
    label = f"{quantile * 100:.1f}th percentile"
    names = ("All transactions", f"Below {label}", f"At or above {label}")
    if isinstance(tx, Tallied):
        name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_mask"))
        rows = tx.sides.orderBy("_mask").select(name.alias("analytical_view"), *tx.sides.columns[1:])
    else:
        rows = split_at_quantile(tx, "price_eur", quantile, names, "analytical_view")
    return rows.drop("transaction_share_pct", "total_value")


def eda_quality_summary(tx: DataFrame | Tallied) -> DataFrame:
    """Nine (metric, value) counts from one scan."""
    missing = {
        "invalid_dates": "sale_date",
        "invalid_prices": "price_eur",
        "missing_eircode": "eircode",
        "missing_property_size_description": "property_size_description",
    }
    flags = {
        "not_full_market_price_transactions": "is_not_full_market_price",
        "vat_exclusive_transactions": "is_vat_exclusive",
        "new_property_transactions": "is_new_property",
        "second_hand_property_transactions": "is_second_hand_property",
    }
    if isinstance(tx, Tallied):
        counts = {"row_count": F.col("rows")} | {n: F.col(f"missing_{c}") for n, c in missing.items()}
        counts |= {n: F.col(flag) for n, flag in flags.items()}
        counted = tx.facts.select(*[F.coalesce(c, F.lit(0)).alias(n) for n, c in counts.items()])
    else:
        counts = {"row_count": F.count(F.lit(1))} | {n: F.count_if(F.col(c).isNull()) for n, c in missing.items()}
        counts |= {n: F.count_if(F.col(flag)) for n, flag in flags.items()}
        counted = tx.agg(*[c.alias(n) for n, c in counts.items()])
    pairs = [F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in counts]
    return counted.select(F.inline(F.array(*pairs)))


def all_tables(tx: DataFrame) -> dict[str, DataFrame]:
    """The seventeen exploration tables by name, plus the histogram data.

    ``tx`` is scanned once for the shared tally, and once more for the extreme rows themselves.
    """
    found = tally_transactions(tx)
    limit = found.marks.select(as_float("extreme_0", found.scale).alias("_limit"))
    return {
        "dataset_summary": dataset_summary(found),
        "missing_values": missing_values(found),
        "eda_quality_summary": eda_quality_summary(found),
        "annual_market_analysis": annual_market_analysis(found),
        "monthly_market_analysis": monthly_market_analysis(found),
        "quarterly_market_analysis": quarterly_market_analysis(found),
        "monthly_seasonality": monthly_seasonality(found),
        "county_market_analysis": county_market_analysis(found),
        "county_price_growth": county_price_growth(found),
        "new_vs_second_hand": new_vs_second_hand(found),
        "property_description_analysis": property_description_analysis(found),
        "property_size_analysis": property_size_analysis(found),
        "non_full_market_price_analysis": non_full_market_price(found),
        "vat_exclusive_analysis": vat_exclusive(found),
        "price_percentiles": price_percentiles(found),
        "extreme_transactions_99_9th_percentile": as_extreme_report(extreme_rows(tx, limit=limit)),
        "extreme_transaction_comparison": extreme_comparison(found),
        "price_histogram": price_histogram(found),
    }
