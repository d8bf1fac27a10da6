"""Data-quality accounting: per-source report, reject rows, summary statistics, load checks.

Everything is grouped aggregations over one scan of the readings; no reading is
collected. Exact copies are first collapsed into one row with a ``copies``
count (partial aggregation folds a heavily copied row inside each map task),
so a source made mostly of copies never reaches a single task whole.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import rnd, safe_div
from ..rules import BASE_COLUMNS, KEY, MEASURES, RULES, Rules
from ..session import ensure_checkpoint_dir
from .clean import in_range, typed_readings

REASONS = ("null", "out_of_range", "duplicate")


def _any_null(cols=BASE_COLUMNS) -> F.Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def classify(raw: DataFrame, source: str | None = None, rules: Rules = RULES) -> DataFrame:
    """Distinct raw rows with ``copies``, their typed values, ``_raw`` (the values as given) and ``reason`` (NULL =
    valid), per ``source``.

    Copies are copies of what was given: two rows with different unparseable
    text are two rejects, not one and a copy.
    """
    given = F.struct(*[F.col(c) for c in BASE_COLUMNS]).alias("_raw")
    d = raw.groupBy(*([source] if source else []), *BASE_COLUMNS).agg(F.count(F.lit(1)).alias("copies"))
    typed = typed_readings(d.select("*", given), rules)
    reason = F.when(_any_null(), F.lit("null")).when(~in_range(rules), F.lit("out_of_range"))
    return typed.withColumn("reason", reason)


def quality_report(raw: DataFrame, source: str = "source_file", rules: Rules = RULES) -> DataFrame:
    """Per source: rows_in, dupes, nulls, out_of_range, rows_out, meters, min_ts, max_ts.

    Order of the checks as in the batch cleaner: exact copies, then NULL or
    unparseable values, then range, then repeated (meter_id, reading_ts) keys.
    Invariant: rows_in = rows_out + dupes + nulls + out_of_range.

    One scan and one chain of aggregates that carries the counts along: raw row,
    key, meter, source. Rejected rows share the key NULL, as counts that each
    task has summed up already.
    """
    d = classify(raw, source, rules)
    valid = F.col("reason").isNull()
    key = [F.when(valid, F.col(c)).alias(c) for c in KEY]
    keys = d.groupBy(source, *key).agg(
        F.sum("copies").alias("rows_in"), F.sum(F.col("copies") - 1).alias("copied"),
        F.count_if(F.col("reason") == "null").alias("nulls"),
        F.count_if(F.col("reason") == "out_of_range").alias("out_of_range"), F.count_if(valid).alias("variants"))
    per_meter = keys.groupBy(source, "meter_id").agg(
        *(F.sum(c).alias(c) for c in ("rows_in", "copied", "nulls", "out_of_range")),
        F.count_if(F.col("variants") > 0).alias("rows_out"),
        F.sum(F.greatest(F.col("variants") - 1, F.lit(0))).alias("lost"),
        F.min("reading_ts").alias("min_ts"), F.max("reading_ts").alias("max_ts"))
    return (per_meter.groupBy(source).agg(
        F.sum("rows_in").alias("rows_in"), (F.sum("copied") + F.sum("lost")).alias("dupes"), F.sum("nulls").alias("nulls"),
        F.sum("out_of_range").alias("out_of_range"), F.sum("rows_out").alias("rows_out"),
        F.count_if(F.col("rows_out") > 0).alias("meters"), F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"))
        .orderBy(source))


def rejects(raw: DataFrame, rules: Rules = RULES, order=MEASURES) -> DataFrame:
    """Rejected rows as they were given, with ``reject_reason`` and ``copies`` (how many raw rows each line stands for).

    ``duplicate`` covers every copy that loses the (meter_id, reading_ts)
    de-duplication, including extra exact copies of the surviving row. The
    survivor is the lowest row by ``order``, as in ``dedup_key``; of equal
    typed rows it is the one whose given values sort first. Only keys that
    have several variants are joined back to their rows.
    """
    d = classify(raw, None, rules)
    rank = F.struct(*order, "_raw")
    several = (d.filter("reason IS NULL").groupBy(*KEY).agg(F.min(rank).alias("_first"), F.count(F.lit(1)).alias("_n"))
               .filter("_n > 1").select(*[F.col(c).alias(f"_{c}") for c in KEY], "_first"))
    same_key = F.lit(True)
    for c in KEY:
        same_key = same_key & (F.col(c) == F.col(f"_{c}"))
    j = d.join(several, same_key & F.col("reason").isNull(), "left")
    survives = F.col("_first").isNull() | (rank == F.col("_first"))
    lost = F.when(F.col("reason").isNotNull() | ~survives, F.col("copies")).otherwise(F.col("copies") - 1)
    return (j.select("_raw.*", F.coalesce("reason", F.lit("duplicate")).alias("reject_reason"), lost.alias("copies"))
            .filter(F.col("copies") > 0))


NUMERIC_SUMMARY = ("energy_kwh", "avg_voltage", "avg_current", "frequency_hz", "power_kw", "health_score")


def value_counts(df: DataFrame, columns=NUMERIC_SUMMARY) -> DataFrame:
    """(column, value, n): how many rows hold each distinct non-NULL value of each column.

    Readings carry a fixed measurement precision (0.01 V, 0.0001 kW, …), so the
    distinct values of a column are bounded by range / precision, not by the
    number of readings. The columns are stacked into (column, value) and
    counted with partial aggregation, so a value held by most rows is folded
    inside each task.
    """
    stacked = (df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                                              for c in columns])).alias("s"))
                 .select("s.*").filter(F.col("value").isNotNull()))
    return stacked.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def _quantiles_from_counts(counts: DataFrame, probs) -> DataFrame:
    """Quantiles of each column from its value counts, ``column`` and one ``p…`` column for each of ``probs``.

    The counts are range-partitioned by column and value and checkpointed; the
    totals of the partitions (a row for each column and partition) say on the
    driver which partition holds each quantile and at what rank, and a running
    count is taken inside those few partitions only.
    """
    spark = counts.sparkSession
    ensure_checkpoint_dir(spark)
    parts = (counts.repartitionByRange("column", "value").withColumn("part", F.spark_partition_id())
             .checkpoint(eager=True))
    totals: dict[str, list] = {}
    for r in parts.groupBy("column", "part").agg(F.sum("n").alias("n")).orderBy("column", "part").collect():
        totals.setdefault(r["column"], []).append((r["part"], r["n"]))
    wanted = []
    for column, sizes in totals.items():
        total = sum(n for _, n in sizes)
        for p in probs:
            rank, before = max(1, math.ceil(p * total)), 0
            for part, n in sizes:
                if rank <= before + n:
                    wanted.append((column, part, f"p{round(p * 100)}", rank - before))
                    break
                before += n
    ranks = spark.createDataFrame(wanted, "column string, part int, label string, rank bigint")
    near = parts.join(ranks.select("column", "part").distinct(), ["column", "part"], "left_semi")
    run = Window.partitionBy("column", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    found = (near.withColumn("cum", F.sum("n").over(run)).join(ranks, ["column", "part"])
             .filter(F.col("cum") >= F.col("rank")))
    return found.groupBy("column").agg(*(F.min(F.when(F.col("label") == f"p{round(p * 100)}", F.col("value")))
                                         .alias(f"p{round(p * 100)}") for p in probs))


def exact_quantiles(df: DataFrame, columns=NUMERIC_SUMMARY, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Exact discrete quantiles per column: the smallest value v with #(x ≤ v) ≥ ceil(p·n).

    The running count over the sorted distinct values (``value_counts``) is
    split by value ranges, so no column is gathered in one task.
    """
    return _quantiles_from_counts(value_counts(df, columns), probs)


def quantile_value(df: DataFrame, column: str, p: float) -> float | None:
    """The exact discrete ``p`` quantile of ``column`` (see ``exact_quantiles``); None without values."""
    row = exact_quantiles(df, (column,), (p,)).first()
    return None if row is None else row[1]


def summary_stats(df: DataFrame, columns=NUMERIC_SUMMARY, exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 %, max per numeric column, long form.

    ``exact=True`` (default): one scan of the readings builds the distinct
    value counts (``value_counts``), which are checkpointed (bounded by value
    precision) and give everything: count and mean, the sample deviation by a
    second pass over the small table (Σ n·(v − mean)²), min, max and the exact
    quartiles. ``exact=False`` uses one aggregate pass with
    ``percentile_approx`` (relative rank error 1/``accuracy``), for columns of
    unbounded precision.
    """
    if exact:
        ensure_checkpoint_dir(df.sparkSession)
        counts = value_counts(df, columns).checkpoint(eager=True)
        base = counts.groupBy("column").agg(
            F.sum("n").alias("count"), (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("_mean"),
            F.min("value").alias("min"), F.max("value").alias("max"))
        spread = (counts.join(base.select("column", "_mean"), "column")
                  .groupBy("column")
                  .agg(F.sum(F.col("n") * (F.col("value") - F.col("_mean")) * (F.col("value") - F.col("_mean")))
                       .alias("_ss")))
        out = base.join(spread, "column").join(_quantiles_from_counts(counts, (0.25, 0.5, 0.75)), "column")
        std = F.sqrt(safe_div(F.col("_ss"), F.col("count") - F.lit(1)))
        return out.select("column", "count", rnd("_mean", 6).alias("mean"), rnd(std, 6).alias("std"),
                          "min", "p25", "p50", "p75", "max")
    stats = []
    for c in columns:
        q = F.percentile_approx(c, [0.25, 0.5, 0.75], accuracy)
        stats.append(F.struct(F.lit(c).alias("column"), F.count(c).alias("count"),
                              rnd(F.avg(c), 6).alias("mean"), rnd(F.stddev_samp(c), 6).alias("std"),
                              F.min(c).cast("double").alias("min"), q[0].cast("double").alias("p25"),
                              q[1].cast("double").alias("p50"), q[2].cast("double").alias("p75"),
                              F.max(c).cast("double").alias("max")))
    return df.agg(F.array(*stats).alias("_s")).select(F.explode("_s").alias("s")).select("s.*")


def id_summary(df: DataFrame, column: str = "meter_id") -> DataFrame:
    """count, unique, top (most frequent; ties → smallest id) and its freq for an id column."""
    per = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    # ties on n resolve to the smallest id: min over (-n, id)
    top = per.agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
                  F.min(F.struct((-F.col("n")).alias("k"), F.col(column).alias("v"))).alias("_m"))
    return top.select(F.lit(column).alias("column"), "count", "unique", F.col("_m.v").alias("top"),
                      (-F.col("_m.k")).alias("freq"))


def curated_checks(raw: DataFrame, curated: DataFrame, rules: Rules = RULES,
                   voltage_bounds=(230.0, 250.0), frequency_bounds=(49.5, 50.5)) -> DataFrame:
    """One row of post-load checks: row balance, no NULL partitions, plausible mean V / Hz.

    Means exclude outage readings (0 V, 0 Hz). The bounds are parameters; the
    defaults are the nominal supply, which real fleets may well miss.
    """
    report = quality_report(raw.withColumn("_all", F.lit(True)), "_all", rules)
    balance = report.select(F.struct("rows_in", (F.col("dupes") + F.col("nulls") + F.col("out_of_range")).alias("rejected"))).scalar()
    cur = curated.agg(F.count(F.lit(1)).alias("rows_out"),
                      F.count_if(F.col("year").isNull() | F.col("month").isNull()).alias("null_partitions"),
                      F.avg(F.when(F.col("avg_voltage") > 0, F.col("avg_voltage"))).alias("_v"),
                      F.avg(F.when(F.col("frequency_hz") > 0, F.col("frequency_hz"))).alias("_hz"))
    zero = F.lit(0).cast("bigint")  # an empty input has no report
    j = cur.select("*", balance.alias("_b")).select(
        "*", F.coalesce("_b.rows_in", zero).alias("rows_in"), F.coalesce("_b.rejected", zero).alias("rejected"))
    return j.select(
        "rows_in", "rejected", "rows_out",
        (F.col("rows_in") == F.col("rows_out") + F.col("rejected")).alias("balance_ok"),
        "null_partitions", rnd("_v", 3).alias("mean_voltage"), rnd("_hz", 3).alias("mean_frequency_hz"),
        F.col("_v").between(*voltage_bounds).alias("voltage_ok"),
        F.col("_hz").between(*frequency_bounds).alias("frequency_ok"))
