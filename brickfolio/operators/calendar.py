"""Session calendar of the panel, exchange calendar and expected runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from brickfolio.functions import columns as X


def session_calendar(panel: DataFrame) -> DataFrame:
    """Distinct trade dates numbered from zero.

    The window has no partition key, but its input is at most one row per
    calendar day however large the panel is: about 37,000 rows per century.
    """
    return panel.select("trade_date").distinct().withColumn(
        "session_index", F.row_number().over(Window.orderBy("trade_date")).cast("bigint") - 1)


def with_session_index(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """Number each row by its session. The calendar is bounded by the number of days, so it is broadcast."""
    if "session_index" in rows.columns:
        return rows
    return rows.join(F.broadcast(calendar), "trade_date", "left")


def days_of(df: DataFrame, column: str) -> DataFrame:
    """Every calendar day from the first to the last value of a date column."""
    day = F.to_date(column)
    return df.agg(F.min(day).alias("a"), F.max(day).alias("b")).select(F.explode(F.sequence("a", "b")).alias("day"))


def trading_calendar(days: DataFrame, holidays: DataFrame, special: DataFrame) -> DataFrame:
    """Each day with its class and the trading day before it.

    ``holidays`` and ``special`` hold one row per exceptional date (``day``).
    """
    marked = (
        days.join(holidays.select("day", F.lit(True).alias("holiday")), "day", "left")
        .join(special.select("day", F.lit(True).alias("special")), "day", "left")
    )
    weekend = F.weekday("day") >= 5
    kind = (
        F.when(weekend, "WEEKEND").when(F.col("holiday"), "B3_HOLIDAY").otherwise("TRADING_DAY")
    )
    trading = F.col("status") == "TRADING_DAY"
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    # one row per calendar day: the unpartitioned window is bounded by the range
    return marked.select("day", kind.alias("status"), X.flag("special").alias("listed_special")).select(
        "day", "status", trading.alias("is_trading_day"), (trading & F.col("listed_special")).alias("special"),
        F.last(F.when(trading, F.col("day")), ignorenulls=True).over(before).alias("previous_trading_day"),
    )


def expected_cycles(days: DataFrame, weekdays: list[int], excluded: DataFrame) -> DataFrame:
    """Expected run dates: the given weekdays (Monday = 0) without the excluded days."""
    runs = days.select(F.col("day").alias("run_date")).filter(F.weekday("run_date").isin(*weekdays))
    return runs.join(excluded.select(F.col("day").alias("run_date")), "run_date", "left_anti")


def missing_cycles(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Expected dates that no run was observed for."""
    return expected.select("run_date").join(observed.select("run_date"), "run_date", "left_anti")


def assess_cycles(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """One row: how complete the observed runs are."""
    seen = observed.select("run_date").distinct().withColumn("observed", F.lit(True))
    both = expected.select("run_date").withColumn("expected", F.lit(True)).join(seen, "run_date", "full_outer")
    e, o = X.flag("expected"), X.flag("observed")
    return both.agg(
        F.count_if(e).alias("expected_count"), F.count_if(e & o).alias("observed_expected_count"),
        F.count_if(e & ~o).alias("missing_count"), F.count_if(~e & o).alias("unexpected_count"),
        F.min(F.when(e & ~o, F.col("run_date"))).alias("first_missing"),
    ).withColumn("status", F.when(F.col("missing_count") == 0, "COMPLETE").otherwise("GAPS_DETECTED"))


def history_audit(calendar: DataFrame, inventory: DataFrame) -> DataFrame:
    """Calendar against inventory (``key`` text holding year=/month=/day= and a dated file name)."""
    path_day = F.make_date(*[
        F.regexp_extract("key", rf"{part}=(\d+)", 1).try_cast("int") for part in ("year", "month", "day")])
    file_day = X.to_day(F.regexp_extract("key", r"(\d{8})\.zip$", 1), "yyyyMMdd")
    parsed = inventory.withColumns({"path_day": F.when(F.col("key").rlike(
        r"year=\d{4}/month=\d{2}/day=\d{2}/"), path_day), "file_day": file_day})
    valid = X.flag(F.col("path_day") == F.col("file_day"))
    per_day = (
        parsed.withColumns({"valid": valid, "day": F.coalesce("path_day", "file_day")})
        .groupBy("day").agg(F.count_if("valid").alias("objects"), F.count_if(~F.col("valid")).alias("invalid_objects"))
    )
    # rows without any readable day keep a null day and are reported as INVALID
    both = calendar.join(per_day, "day", "full_outer")
    present = F.coalesce("objects", F.lit(0)) > 0
    trading = X.flag("is_trading_day")
    status = (
        F.when(~present & (F.coalesce("invalid_objects", F.lit(0)) > 0), "INVALID")
        .when(trading & present, "EXPECTED_AND_PRESENT").when(trading, "EXPECTED_BUT_MISSING")
        .when(present, "UNEXPECTED_PRESENT").otherwise("NON_TRADING_DAY")
    )
    return both.select("day", status.alias("audit_status"), F.coalesce("objects", F.lit(0)).alias("objects"),
                       (F.coalesce("objects", F.lit(0)) > 1).alias("duplicate_day"))
