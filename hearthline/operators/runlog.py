"""Run log, due runs and the summary of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions.time import moment, seconds_between
from hearthline.params import DEFAULT, Params

COUNTS = ("new", "updated", "suspected_sold", "price_changes")


def merge_stats(run_stats: DataFrame, write_stats: DataFrame) -> DataFrame:
    """Per source of the run (source, status, error, raw_count), what was written; 0 where nothing was."""
    w = write_stats.where("source is not null")
    own = [c for c in ("new", "updated", "price_changes", "duplicates_dropped") if c in w.columns]
    return run_stats.join(w.select("source", *own), "source", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in own})


def run_log_rows(stats: DataFrame, *, run_at, duration: float) -> DataFrame:
    """Rows to append to the run log; what is missing counts 0 and FAILED."""
    has = lambda c, default: F.coalesce(F.col(c), F.lit(default)) if c in stats.columns else F.lit(default)
    error = F.substring(F.col("error"), 1, 500) if "error" in stats.columns else F.lit(None).cast("string")
    return stats.select(
        moment(run_at).alias("run_at"), "source", has("new", 0).cast("int").alias("new_listings"), has("updated", 0).cast("int").alias("updated_listings"), has("suspected_sold", 0).cast("int").alias("suspected_sold"),
        has("price_changes", 0).cast("int").alias("price_changes"), has("status", "FAILED").alias("status"), error.alias("error_message"), F.lit(duration).cast("decimal(8,2)").alias("duration_seconds"),
    )


def last_success(runs: DataFrame) -> DataFrame:
    return runs.where("status = 'SUCCESS'").groupBy("source").agg(F.max("run_at").alias("last_run_at"))


def run_due(runs: DataFrame, *, now, params: Params = DEFAULT) -> DataFrame:
    """Per source that ever ran: hours since its last success, and whether it is due (also if it never succeeded)."""
    out = runs.select("source").distinct().join(last_success(runs), "source", "left")
    hours = seconds_between(F.col("last_run_at"), moment(now)) / 3600
    return out.select("source", "last_run_at", hours.alias("hours_since"), F.coalesce(hours >= params.hours_between_checks, F.lit(True)).alias("due"))


def total_listings(listings: DataFrame) -> DataFrame:
    return listings.agg(F.count(F.lit(1)).alias("total_listings"))


def quality(normalised: DataFrame) -> DataFrame:
    """One row: how many rows have coordinates and a price, and the shares in percent (0 of nothing)."""
    pct = lambda c: F.coalesce(F.round(F.try_divide(F.count_if(c) * 100.0, F.count(F.lit(1))), 1), F.lit(0.0))
    parsed = ~F.col("price_parse_failed")
    return normalised.agg(F.count(F.lit(1)).alias("rows"), F.count_if("geocoded").alias("geocoded"), pct(F.col("geocoded")).alias("geocoded_pct"), F.count_if(parsed).alias("prices_parsed"), pct(parsed).alias("prices_parsed_pct"))


def run_summary(runs: DataFrame) -> DataFrame:
    """Per run time: totals, sources that did not succeed, and the time taken as minutes and seconds; and per source a
    line of text. runs: rows of the run log."""
    line = F.when(F.col("status") == "SUCCESS", F.format_string("%s: %d new, %d updated", "source", "new_listings", "updated_listings")).when(
        F.col("status") == "PARTIAL", F.format_string("%s: PARTIAL - %s; %d new written", F.col("source"), F.coalesce("error_message", F.lit("see logs")), F.col("new_listings"))
    ).otherwise(F.format_string("%s: FAILED - %s", F.col("source"), F.coalesce("error_message", F.lit("unknown error"))))
    seconds = F.floor(F.max("duration_seconds")).cast("bigint")
    return runs.withColumn("_line", line).groupBy("run_at").agg(
        F.sum("new_listings").alias("new_listings"), F.sum("updated_listings").alias("updated_listings"), F.sum("price_changes").alias("price_changes"),
        F.count_if(F.col("status") != "SUCCESS").alias("non_success"), F.format_string("%dm %ds", F.floor(seconds / 60).cast("bigint"), F.pmod(seconds, F.lit(60))).alias("duration"),
        F.array_join(F.sort_array(F.collect_list("_line")), "\n").alias("lines"),
    )


def check_summary(stats: DataFrame) -> DataFrame:
    """The counts of a verification run, and the lines of its report; errors have a line only if there are any."""
    line = lambda label, c: F.concat(F.lit(f"{label}: "), F.col(c).cast("string"))
    errors = F.when(F.col("errors") > 0, line("Errors", "errors"))
    lines = F.concat_ws("\n", line("URLs checked", "checked"), line("Still active", "confirmed_active"), line("Price changes", "price_changes"), line("Confirmed removed", "confirmed_removed"), errors)
    return stats.select("checked", "confirmed_active", "price_changes", "confirmed_removed", "errors", lines.alias("lines"))


def crash_text(message: Column) -> Column:
    """A fault's message as reported: its first 1,000 characters."""
    return F.substring(message, 1, 1000)
