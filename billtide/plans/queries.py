"""Every operator as a query over the given tables.

Results are shown with dates and times as ISO text and money as double, so that they compare equal
with any SQL engine's.
"""

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billtide import schema
from billtide.functions.ordering import sort_columns
from billtide.functions.times import event_date, iso_text, parsed_or_null
from billtide.operators import asof, audit, dedup, incremental, kpi, quality, reconcile, state, upkeep
from billtide.plans import jobs
from billtide.session import fresh_dir, utc, written
from billtide.sources import adapter, control, file_order, files, ids, tables
from billtide.streaming import runs

MARK = "2024-01-20 00:00:00"
SNAPSHOT = "2024-03-01 00:00:00"
RUN = datetime(2024, 3, 1, tzinfo=timezone.utc)


def shown(df: DataFrame) -> DataFrame:
    """Dates, times and money in the form that any SQL engine can match."""
    columns = []
    for field in df.schema:
        column = field.name
        if isinstance(field.dataType, T.TimestampType):
            column = iso_text(column)
        elif isinstance(field.dataType, T.DateType):
            column = f"CAST({column} AS STRING)"
        elif isinstance(field.dataType, T.DecimalType):
            column = f"CAST({column} AS DOUBLE)"
        columns.append(f"{column} AS {field.name}")
    return df.selectExpr(*columns)


# ---- inputs ----


def bronze(spark, sf):
    return adapter.subscription_events(spark, sf)


def bronze_by_date(spark, sf):
    return bronze(spark, sf).withColumn("dt", F.to_date("ingested_at"))


def increment(spark, sf):
    return incremental.newer_than(bronze_by_date(spark, sf), MARK, ingest_date="dt").drop("dt")


def before_mark(spark, sf):
    return bronze(spark, sf).where(F.col("ingested_at") <= F.lit(MARK).cast("timestamp"))


def history(spark, sf):
    return dedup.dedup_events(bronze(spark, sf))


def written_history(spark, sf):
    """The same, stored: for queries that read it more than once."""
    return written(history(spark, sf), "history")


def stored_before(spark, sf):
    """The history as it stood at the mark."""
    return dedup.dedup_events(before_mark(spark, sf))


def dirty_history(spark, sf):
    """The dirty events after a lenient parse: bad times and prices become nulls."""
    text = adapter.dirty_events(spark, sf)
    parsed = text.selectExpr(
        *[
            f"{parsed_or_null(f.name)} AS {f.name}"
            if isinstance(f.dataType, T.TimestampType)
            else f"try_cast({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema.EVENT
        ]
    )
    return dedup.dedup_events(parsed)


def current(spark, sf):
    return state.current_state(history(spark, sf), SNAPSHOT)


def kpis(spark, sf):
    return kpi.kpi_daily(history(spark, sf), SNAPSHOT)


def kpis_from_start(events):
    """KPIs from the earliest date that rows newer than the mark touch."""
    start = incremental.affected_start(incremental.newer_than(events, MARK)).first()["start_date"]
    return kpi.kpi_daily(events, SNAPSHOT, start)


def _without_stamp(df):
    return df.drop("snapshot_time")


# ---- sources and sinks ----


def bronze_json_roundtrip(spark, sf):
    path = fresh_dir(spark, "bronze")
    tables.append_bronze(bronze(spark, sf), path)
    return tables.read_bronze(spark, path)


def bronze_partitions(spark, sf):
    path = fresh_dir(spark, "bronze")
    tables.append_bronze(bronze(spark, sf), path)
    dates = files.partition_dates(spark, path)
    return spark.createDataFrame([(d,) for d in dates], "dt string")


def as_text(events: DataFrame) -> DataFrame:
    """Typed events as a producer would send them."""
    return events.selectExpr(
        *[
            f"{iso_text(f.name)} AS {f.name}"
            if isinstance(f.dataType, T.TimestampType)
            else f"CAST({f.name} AS STRING) AS {f.name}"
            for f in schema.EVENT
        ]
    )


def bronze_append(spark, sf):
    """The ingest job run twice, for the events before and after the mark."""
    lake = tables.Lake(fresh_dir(spark, "lake"))
    jobs.ingest(as_text(before_mark(spark, sf)), lake, RUN)
    jobs.ingest(as_text(increment(spark, sf)), lake, RUN)
    return (
        tables.read_bronze(spark, lake.bronze)
        .groupBy("dt")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("price").alias("price_sum"))
    )


def history_stored_order(spark, sf):
    """How many rows of a written history lie before the row they should follow in their file."""
    path = fresh_dir(spark, "history")
    tables.overwrite_history(history(spark, sf), path)
    return tables.stored_order_violations(spark, path)


FILE_PARTS = 8


def order_in_files(spark, sf):
    """The check of the order on files that are sorted by event id instead: one file per date and part."""
    path = fresh_dir(spark, "history")
    part = f"CAST(substring(event_id, 5) AS BIGINT) % {FILE_PARTS} AS part"
    dated = history(spark, sf).selectExpr("*", "to_date(event_time) AS dt", part).repartition("dt", "part")
    dated.sortWithinPartitions("dt", "part", "event_id").write.partitionBy("dt", "part").parquet(path)
    return _check_rows(quality.check_stored_order(file_order.out_of_place(spark.read.parquet(path))))


def _with_broken_lines(spark, sf):
    """Events as JSON lines; some are cut off, some no JSON at all."""
    n = "CAST(substring(event_id, 5) AS BIGINT)"
    return as_text(bronze(spark, sf)).selectExpr(
        f"""CASE WHEN {n} % 83 = 0 THEN concat('{{"event_id":"', event_id, '"')
            WHEN {n} % 89 = 0 THEN concat('no json: ', event_id)
            ELSE to_json(struct(*)) END AS value"""
    )


def _ingested_lines(spark, sf):
    landing, lake = fresh_dir(spark, "landing"), tables.Lake(fresh_dir(spark, "lake"))
    _with_broken_lines(spark, sf).write.text(landing)
    jobs.ingest_lines(spark.read.text(landing), lake, RUN)
    return lake


def ingest_good_lines(spark, sf):
    """Bronze after an ingest of lines of which some are broken."""
    return tables.read_bronze(spark, _ingested_lines(spark, sf).bronze)


def ingest_rejects(spark, sf):
    """What that ingest has put aside."""
    rejects = tables.read_rejects(spark, _ingested_lines(spark, sf).rejects)
    return rejects.groupBy("line").agg(F.count(F.lit(1)).alias("row_count"))


def history_partition_overwrite(spark, sf):
    """A stored history, then a merge that rewrites only the touched dates, read back whole."""
    path = fresh_dir(spark, "history")
    tables.overwrite_history(stored_before(spark, sf), path)
    stored = tables.read_history(spark, path)
    batch = increment(spark, sf)
    named = dedup.affected_dates(batch).union(dedup.redelivered_dates(stored, batch))
    dates = [r.dt for r in named.distinct().collect()]
    touched = dedup.restrict_to_dates(stored, dates)
    tables.overwrite_history(dedup.merge_events(touched, batch), path, dates)
    return tables.read_history(spark, path).select(*schema.EVENT_COLUMNS, "dt")


def kpi_partition_overwrite(spark, sf):
    """KPIs as of the mark, then the dates from the earliest change on overwritten, read back."""
    path = f"{fresh_dir(spark, 'gold')}/table=kpi_daily"
    stored, batch = written(stored_before(spark, sf), "history"), increment(spark, sf)
    tables.overwrite_kpis(kpi.kpi_daily(stored, SNAPSHOT), path)
    named = dedup.affected_dates(batch).union(dedup.redelivered_dates(stored, batch))
    start = named.agg(F.min("dt")).first()[0]
    tables.overwrite_kpis(kpi.kpi_daily(written_history(spark, sf), SNAPSHOT, start), path)
    return _without_stamp(tables.read_kpis(spark, path))


def kpi_by_differences(spark, sf):
    """The KPIs as of the mark, brought up to date by what the increment changes in the end-of-day states."""
    before, after, batch = written(stored_before(spark, sf), "history"), written_history(spark, sf), increment(spark, sf)
    named = dedup.affected_dates(batch).union(dedup.redelivered_dates(before, batch))
    dates = sorted(r.dt for r in named.distinct().collect())
    stored, states = kpi.kpi_daily(before, SNAPSHOT), written(kpi.day_states(before), "states")
    made = kpi.day_states(dedup.restrict_to_dates(after, dates))
    kept = sorted(r.date for r in after.select(event_date().alias("date")).where("date IS NOT NULL").distinct().collect())
    renewed = upkeep.renewed_kpis(stored, states, made, dates, kept, SNAPSHOT)
    return _without_stamp(stored.where(F.col("date") < F.lit(dates[0])).unionByName(renewed))


def watermark_roundtrip(spark, sf):
    path = fresh_dir(spark, "control")
    at_mark = incremental.next_mark(before_mark(spark, sf)).first()[0]
    at_end = incremental.next_mark(bronze(spark, sf)).first()[0]
    for step, (pipeline, mark) in enumerate(
        [(jobs.SILVER, at_mark), (jobs.GOLD, at_mark), (jobs.SILVER, at_end)]
    ):
        control.save_mark(spark, path, pipeline, mark, committed_at=RUN + timedelta(hours=step))
    return control.read_marks(spark, path).select("pipeline", "last_processed_ingested_at")


# ---- history ----


def parse_event_times(spark, sf):
    text = adapter.dirty_events(spark, sf)
    return text.selectExpr(
        "event_id",
        "event_time AS event_time_text",
        f"{parsed_or_null('event_time')} AS event_time",
        f"to_date({parsed_or_null('event_time')}) AS event_date",
        f"{parsed_or_null('ingested_at')} AS ingested_at",
    )


def history_merge(spark, sf):
    """The merged content of the event dates that the increment touches."""
    batch = increment(spark, sf)
    touched = dedup.restrict_to_affected(stored_before(spark, sf), batch)
    return dedup.merge_events(touched, batch)


def history_full(spark, sf):
    dated = history(spark, sf).withColumn("date", event_date())
    return dated.orderBy(*sort_columns())


def history_affected_scan(spark, sf):
    """The stored event dates that the increment touches; the others are pruned while the query runs."""
    path = fresh_dir(spark, "history")
    tables.overwrite_history(stored_before(spark, sf), path)
    stored = tables.read_history(spark, path)
    return dedup.restrict_to_affected(stored, increment(spark, sf)).select(*schema.EVENT_COLUMNS, "dt")


def redelivered_dates(spark, sf):
    """The dates of the history at the mark that hold events of the increment, by the table of ids."""
    path = fresh_dir(spark, "ids")
    ids.append_ids(stored_before(spark, sf).select("event_id", event_date().alias("dt")), path)
    return ids.dates_of(ids.read_ids(spark, path), increment(spark, sf))


def affected_partitions(spark, sf):
    return dedup.affected_dates(increment(spark, sf)).orderBy("dt")


def state_as_of(spark, sf):
    events = written_history(spark, sf)
    return state.state_as_of(events, events.select(event_date().alias("date")))


def state_at_times(spark, sf):
    """The state of its subscription at the moment each delivery arrived."""
    asks = bronze(spark, sf).selectExpr("event_id AS ask_id", "subscription_id", "ingested_at AS asked_at")
    return asof.state_at(history(spark, sf), asks)


def refresh_current(spark, sf):
    """The snapshot at the mark, advanced by the events in the increment."""
    old = written(state.current_with_order(stored_before(spark, sf), SNAPSHOT), "current")
    events = written_history(spark, sf)
    arrived = dedup.arrived_versions(events, increment(spark, sf))
    return _without_stamp(state.refresh_current(old, arrived, events, SNAPSHOT)).drop(
        "last_ingested_at", "last_event_id"
    )


# ---- checks ----


def recon_current_vs_history(spark, sf, compare=reconcile.current_vs_history):
    """The true snapshot, a tampered one, and one with null columns against their histories."""
    events, dirty = written_history(spark, sf), written(dirty_history(spark, sf), "dirty")
    true = state.current_state(events, SNAPSHOT)
    cases = {
        "true": (true, events),
        "tampered": (adapter.tampered_snapshot(true), events),
        "dirty": (state.current_state(dirty, SNAPSHOT), dirty),
    }
    result = None
    for name, (snapshot, source) in cases.items():
        row = compare(snapshot, source).withColumn("snapshot", F.lit(name))
        result = row if result is None else result.unionByName(row)
    return result


def mismatch_sample(spark, sf):
    events = written_history(spark, sf)
    snapshot = adapter.tampered_snapshot(state.current_state(events, SNAPSHOT))
    return reconcile.mismatch_sample(snapshot, events)


def recon_kpi_vs_current(spark, sf):
    events = written_history(spark, sf)
    true, daily = state.current_state(events, SNAPSHOT), kpi.kpi_daily(events, SNAPSHOT)
    tampered = adapter.tampered_snapshot(true)
    return (
        reconcile.kpi_vs_current(daily, true)
        .withColumn("snapshot", F.lit("true"))
        .unionByName(
            reconcile.kpi_vs_current(daily, tampered).withColumn("snapshot", F.lit("tampered"))
        )
    )


def _check_rows(checks):
    return checks.select("layer", "dataset", "check_name", "passed", "violation_count")


def _with_values(checks):
    return checks.selectExpr(
        "layer", "dataset", "check_name", "passed", "violation_count", "details['offenders'] AS offenders"
    )


def dq_bronze_details(spark, sf):
    """The checks of events with the first values that offend them."""
    events = adapter.dirty_events(spark, sf)
    return _with_values(quality.with_offenders(quality.check_events(events), quality.event_offenders(events)))


def dq_current_details(spark, sf):
    """The comparison of a tampered snapshot with the first subscriptions that differ."""
    events = written_history(spark, sf)
    snapshot = adapter.tampered_snapshot(state.current_state(events, SNAPSHOT))
    checks = reconcile.check_current_vs_history(snapshot, events, by_digests=True)
    return _with_values(quality.with_offenders(checks, reconcile.differing_subscriptions(snapshot, events)))


def dq_current_summary(spark, sf):
    events = written_history(spark, sf)
    snapshot = adapter.tampered_snapshot(state.current_state(events, SNAPSHOT))
    return _check_rows(
        quality.check_current(snapshot).unionByName(
            reconcile.check_current_vs_history(snapshot, events)
        )
    )


def dq_kpi_summary(spark, sf):
    events = written_history(spark, sf)
    daily = kpi.kpi_daily(events, SNAPSHOT)
    snapshot = adapter.tampered_snapshot(state.current_state(events, SNAPSHOT))
    return _check_rows(
        quality.check_kpis(daily).unionByName(reconcile.check_kpi_vs_current(daily, snapshot))
    )


def dq_verdict(spark, sf):
    dirty = quality.check_events(adapter.dirty_events(spark, sf))
    return quality.verdict(dirty.unionByName(quality.check_history(history(spark, sf))))


DOMAINS = {
    "event_type": schema.EVENT_TYPES,
    "billing_cycle": schema.BILLING_CYCLES,
    "currency": schema.CURRENCIES,
    "status": schema.STATUSES,
    "source": schema.SOURCES,
    "schema_version": [schema.EVENT_SCHEMA_VERSION],
}


# ---- jobs ----


def _two_runs(spark, sf, run):
    """Ingests the events before and after the mark and calls ``run(lake, step)`` after each."""
    lake = tables.Lake(fresh_dir(spark, "lake"))
    for step, batch in enumerate([before_mark(spark, sf), increment(spark, sf)]):
        jobs.ingest(as_text(batch), lake, RUN + timedelta(hours=step))
        run(lake, step)
    return lake


def jobs_kpi_daily(spark, sf):
    """Bronze to silver to gold, twice; the second run reopens the dates of late events."""

    def run(lake, step):
        now = RUN + timedelta(hours=step)
        jobs.update_silver(spark, lake, now)
        jobs.update_gold(spark, lake, now)

    lake = _two_runs(spark, sf, run)
    return _without_stamp(tables.read_kpis(spark, lake.kpi))


def jobs_replay(spark, sf):
    """The KPIs after a second run that lost its mark, was repeated by a host whose clock is behind, and was
    delivered once more."""

    def run(lake, step):
        if step == 0:
            jobs.update_silver(spark, lake, RUN)
            jobs.update_gold(spark, lake, RUN)
            return
        # what a run does until it is lost between the history and its mark
        # stored, because it is read five times
        batch = written(increment(spark, sf), "batch")
        history = tables.read_history(spark, lake.history)
        named = dedup.affected_dates(batch).union(dedup.redelivered_dates(history, batch))
        dates = sorted(r.dt for r in named.distinct().collect())
        control.save_intent(
            spark, lake.control, jobs.SILVER, committed_at=RUN, affected_start=dates[0], affected_dates=dates
        )
        merged = dedup.merge_events(dedup.restrict_to_dates(history, dates), batch)
        tables.overwrite_history(merged, lake.history, dates)
        for _ in range(2):
            jobs.update_silver(spark, lake, RUN - timedelta(days=9))
            jobs.update_gold(spark, lake, RUN - timedelta(days=9))
            jobs.apply_to_silver(batch, lake, RUN)
        jobs.update_gold(spark, lake, RUN)

    lake = _two_runs(spark, sf, run)
    return _without_stamp(tables.read_kpis(spark, lake.kpi))


def jobs_checks(spark, sf):
    """What the checks of two runs have left: verdicts, rows in and out and the number of dates touched."""

    def run(lake, step):
        now = RUN + timedelta(hours=step)
        jobs.update_silver(spark, lake, now)
        jobs.update_gold(spark, lake, now)

    lake = _two_runs(spark, sf, run)
    count = lambda key: F.col("details")[key].cast("bigint").alias(key)
    dates = F.size(F.split(F.col("details")["affected_partitions"], ",")).cast("bigint").alias("affected_partitions")
    kept = tables.read_checks(spark, lake.checks).where("check_name = 'run_summary'")
    run = F.hour("run_time").cast("bigint").alias("run")
    return kept.select("job", run, "layer", "dataset", "passed", "violation_count", count("row_count_in"), count("row_count_out"), dates)


def jobs_current_state(spark, sf):
    """The stored snapshot after two runs, the second one advancing it from the batch."""

    def run(lake, step):
        jobs.update_silver(spark, lake, RUN + timedelta(hours=step))

    lake = _two_runs(spark, sf, run)
    return _without_stamp(tables.read_current(spark, lake.current))


def stream_history(spark, sf):
    """The history after two runs of the streams from landed files, the second from their checkpoints."""
    root = fresh_dir(spark, "stream")
    lake = tables.Lake(f"{root}/lake")
    for batch in (before_mark(spark, sf), increment(spark, sf)):
        batch.write.mode("append").option("timestampFormat", tables.ISO_MICROS).json(
            f"{root}/landing"
        )
        runs.stream_ingest(spark, f"{root}/landing", lake, f"{root}/cp-bronze", RUN).awaitTermination()
        runs.stream_silver(spark, lake, f"{root}/cp-silver", RUN).awaitTermination()
    return tables.read_history(spark, lake.history).select(*schema.EVENT_COLUMNS, "dt")


QUERIES = {
    # sources and sinks
    "subscription_events": bronze,
    "bronze_json_roundtrip": bronze_json_roundtrip,
    "bronze_partitions": bronze_partitions,
    "bronze_append": bronze_append,
    "history_partition_overwrite": history_partition_overwrite,
    "history_stored_order": history_stored_order,
    "order_in_files": order_in_files,
    "ingest_good_lines": ingest_good_lines,
    "ingest_rejects": ingest_rejects,
    "kpi_partition_overwrite": kpi_partition_overwrite,
    "watermark_roundtrip": watermark_roundtrip,
    # history and increments
    "parse_event_times": parse_event_times,
    "bronze_incremental": lambda spark, sf: incremental.newer_than(
        bronze_by_date(spark, sf), MARK, ingest_date="dt"
    ),
    "history_dedup": history,
    "history_merge": history_merge,
    "history_full": history_full,
    "history_affected_scan": history_affected_scan,
    "history_incremental": lambda spark, sf: incremental.newer_than(history(spark, sf), MARK),
    "redelivered_dates": redelivered_dates,
    "affected_partitions": affected_partitions,
    "affected_start_date": lambda spark, sf: incremental.affected_start(increment(spark, sf)),
    "next_watermark": lambda spark, sf: incremental.next_mark(increment(spark, sf)),
    "late_events": lambda spark, sf: incremental.late_events(bronze(spark, sf), MARK),
    # state
    "current_state": lambda spark, sf: _without_stamp(current(spark, sf)),
    "refresh_current": refresh_current,
    "state_as_of": state_as_of,
    "state_at_times": state_at_times,
    "state_intervals": lambda spark, sf: state.state_intervals(history(spark, sf)),
    # KPIs
    "kpi_flow_daily": lambda spark, sf: kpi.kpi_flow_daily(history(spark, sf)),
    "kpi_stock_daily": lambda spark, sf: kpi.kpi_stock_daily(history(spark, sf)),
    "kpi_daily": lambda spark, sf: _without_stamp(kpis(spark, sf)).orderBy("date"),
    "kpi_daily_incremental": lambda spark, sf: _without_stamp(
        kpis_from_start(written_history(spark, sf))
    ),
    "kpi_by_differences": kpi_by_differences,
    "latest_kpi": lambda spark, sf: _without_stamp(kpi.latest_kpi(kpis(spark, sf))),
    # reconciliation and checks
    "recon_current_vs_history": recon_current_vs_history,
    "recon_by_digests": lambda spark, sf: recon_current_vs_history(
        spark, sf, reconcile.current_vs_history_by_digests
    ),
    "recon_kpi_vs_current": recon_kpi_vs_current,
    "mismatch_sample": mismatch_sample,
    "dq_bronze_summary": lambda spark, sf: _check_rows(
        quality.check_events(adapter.dirty_events(spark, sf))
    ),
    "dq_history_summary": lambda spark, sf: _check_rows(
        quality.check_history(dirty_history(spark, sf))
    ),
    "dq_current_summary": dq_current_summary,
    "dq_kpi_summary": dq_kpi_summary,
    "dq_bronze_details": dq_bronze_details,
    "dq_current_details": dq_current_details,
    "dq_verdict": dq_verdict,
    "dq_null_counts": lambda spark, sf: quality.null_counts(
        adapter.dirty_events(spark, sf), schema.EVENT_COLUMNS
    ),
    "dq_duplicate_keys": lambda spark, sf: quality.duplicate_keys(
        adapter.dirty_events(spark, sf), ["event_id"]
    ),
    "dq_invalid_values": lambda spark, sf: quality.invalid_values(
        adapter.dirty_events(spark, sf), DOMAINS
    ),
    "dq_unparseable_times": lambda spark, sf: quality.unparseable_times(
        adapter.dirty_events(spark, sf), ["event_time", "ingested_at"]
    ),
    "dq_event_after_ingest": lambda spark, sf: quality.events_after_ingest(
        adapter.dirty_events(spark, sf)
    ).select("event_id", "event_time", "ingested_at"),
    "dq_non_negative": lambda spark, sf: quality.number_problems(
        adapter.dirty_events(spark, sf), ["price"]
    ),
    "dq_unknown_plans": lambda spark, sf: quality.unknown_plans(adapter.dirty_events(spark, sf)),
    "dq_plan_mismatch": lambda spark, sf: quality.plan_mismatches(
        adapter.dirty_events(spark, sf)
    ).select(
        "event_id", "source", "plan_id", "price", "expected_price", "billing_cycle",
        "expected_billing_cycle",
    ),
    "status_mismatch_pairs": lambda spark, sf: quality.status_mismatch_pairs(
        adapter.dirty_events(spark, sf)
    ),
    # audits
    "illegal_transitions": lambda spark, sf: audit.illegal_transitions(
        written_history(spark, sf)
    ),
    "plan_step_mismatches": lambda spark, sf: audit.plan_step_mismatches(
        written_history(spark, sf)
    ),
    "out_of_order_events": lambda spark, sf: audit.out_of_order_events(
        written_history(spark, sf)
    ),
    # jobs and streams
    "jobs_kpi_daily": jobs_kpi_daily,
    "jobs_replay": jobs_replay,
    "jobs_checks": jobs_checks,
    "jobs_current_state": jobs_current_state,
    "stream_history": stream_history,
}


def _query(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(build(utc(spark), sf_dir))

    return run


def all_queries():
    return {name: _query(build) for name, build in QUERIES.items()}
