"""The jobs: ingest, bronze to silver, silver to gold, and the comparison of everything with everything.

A job stages what it has made, checks what it has staged, says what it is about to change, puts it in force
and moves its mark last. A job that dies on the way is repeated from the same mark and ends in the same
tables: the merge keeps one row per event however often it is delivered, tables change in one step, and the
next job learns of changes from what was announced, not only from what was finished. The driver sees only
check rows, dates and marks. ``now`` stamps rows; no order is taken from it.
"""

from contextlib import nullcontext
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from billtide import schema
from billtide.operators import dedup, incremental, kpi, quality, reconcile, state, upkeep
from billtide.session import staged, utc
from billtide.sources import control, files, ids, pointers, tables
from billtide.sources.tables import Lake

SILVER = "subscription_events_silver"
GOLD = "kpi_daily_gold"


def ingest(events: DataFrame, lake: Lake, now) -> list:
    """Checks a batch of events in text form and appends it to bronze.

    Nothing is written to bronze when the batch is empty or any check fails. Returns the check rows.
    """
    spark = utc(events.sparkSession)
    with staged(events, "landed") as landed:
        if landed.isEmpty():
            return []
        results = _judge(
            spark, lake, "ingest", now, quality.check_events(landed), offenders=quality.event_offenders(landed)
        )
        tables.append_bronze(tables.parse_landing(landed), lake.bronze)
    return results


def ingest_lines(lines: DataFrame, lake: Lake, now) -> list:
    """``ingest`` of JSON lines (column ``value``) of which some may be broken: these are kept aside.

    The rejected lines are stored first, also when the others fail their checks; a batch that is repeated leaves
    them once more. Returns the check rows.
    """
    utc(lines.sparkSession)
    with staged(tables.split_lines(lines), "lines") as split:
        rejected = split.where("rejected IS NOT NULL").selectExpr("rejected AS line")
        if not rejected.isEmpty():
            tables.append_rejects(rejected, lake.rejects, now)
        return ingest(split.where("rejected IS NULL").select("event.*"), lake, now)


def update_silver(spark: SparkSession, lake: Lake, now, from_start: bool = False) -> dict | None:
    """Processes the bronze rows that are newer than the silver mark.

    ``from_start`` ignores the mark, takes all of bronze and rebuilds the snapshot from the history.
    """
    utc(spark)
    mark = None if from_start else control.load_mark(spark, lake.control, SILVER)
    bronze = tables.read_bronze(spark, lake.bronze)
    new_events = incremental.newer_than(bronze, mark["mark"] if mark else None, ingest_date="dt")
    return apply_to_silver(new_events, lake, now, rebuild=from_start)


def apply_to_silver(new_events: DataFrame, lake: Lake, now, rebuild: bool = False) -> dict | None:
    """Merges a batch into the history, advances the current snapshot and moves the mark.

    Returns None, with nothing changed, when the batch is empty. The event dates that the batch names, and those
    on which the history holds one of its events, are merged and replaced; the snapshot is advanced
    from the batch (``rebuild`` makes it anew from the history). What the batch has touched is compared with
    the history; ``reconcile_all`` compares everything.
    """
    spark = utc(new_events.sparkSession)
    with staged(new_events.drop("dt"), "batch") as batch:
        row_count, mark = batch.agg(F.count(F.lit(1)), F.unix_micros(F.max("ingested_at"))).first()
        if row_count == 0:
            return None
        history = tables.read_history(spark, lake.history)
        in_force = tables.history_dates(spark, lake.history)
        dates = dedup.affected_dates(batch)
        touched = _dates(dates.union(_stored_dates(spark, lake, history, batch, in_force)))
        merged = dedup.merge_events(dedup.restrict_to_dates(history, touched), batch)
        # counted while they are written, without a pass of their own
        counted = Observation("merged")
        folder = tables.stage_history(merged.observe(counted, F.count(F.lit(1)).alias("rows")), lake.history)
        made = tables.read_staged(spark, lake.history, folder)
        summary = {"row_count_in": row_count, "row_count_out": _rows(counted), "affected_partitions": _listed(touched)}
        try:
            in_order = quality.check_stored_order(tables.stored_order_violations(spark, lake.history, folder))
            _judge(
                spark, lake, SILVER, now, quality.check_history(made).unionByName(in_order),
                ("silver", "subscription_state_history", summary), quality.history_offenders(made),
            )
        except ValueError:
            files.delete(spark, f"{lake.history}/{folder}")
            raise
        changes = {"affected_start": min(touched, default=None), "affected_dates": touched}
        alone = not {d.isoformat() for d in touched} & {*in_force}
        arrived = dedup.arrived_versions(made, batch, row_count, alone)
        arrived = arrived.select("dt", *state.STATE_COLUMNS, *state.TIES)
        # what was merged with nothing has just been stored
        with nullcontext(arrived) if alone else staged(arrived, "arrived") as arrived:
            # before the history, so that no event of it is ever unknown
            ids.append_ids(arrived, lake.ids)
            control.save_intent(spark, lake.control, SILVER, committed_at=now, **changes)
            tables.publish_history(spark, lake.history, folder, touched)
            checks = _renew_current(spark, lake, arrived.drop("dt"), now, rebuild)
    control.save_mark(spark, lake.control, SILVER, mark, committed_at=now, **changes)
    return {"mark": mark, "dates": touched, "checks": checks}


def _stored_dates(spark, lake, history, batch, in_force):
    """The event dates in force on which the history may hold events of the batch."""
    if not ids.exists(spark, lake.ids):
        ids.append_ids(history, lake.ids)
    return ids.dates_of(ids.read_ids(spark, lake.ids), batch).where(F.col("dt").cast("string").isin(in_force))


def _renew_current(spark, lake, arrived, now, rebuild):
    """Makes the snapshot, checks it, compares the touched subscriptions with the history, publishes it."""
    history = tables.read_history(spark, lake.history)
    old = tables.read_current(spark, lake.current, schema.STORED_CURRENT)
    # stored, because of stored tables Spark knows while they are small enough to be sent to the history
    with (
        staged(state.withdrawn(old, arrived), "withdrawn") as withdrawn,
        staged(arrived.select("subscription_id").union(withdrawn).distinct(), "touched") as touched,
    ):
        if rebuild or old.isEmpty():
            current = state.current_with_order(history, now)
        else:
            current = state.refresh_current(old, arrived, history, now, withdrawn)
        folder = tables.stage_current(
            current.select(*schema.STORED_CURRENT.fieldNames()), lake.current
        )
        made = spark.read.schema(schema.STORED_CURRENT).parquet(f"{lake.current}/{folder}")
        try:
            both = [t.join(touched, "subscription_id", "left_semi") for t in (made, history)]
            results = _judge(
                spark, lake, SILVER, now,
                quality.check_current(made).unionByName(reconcile.check_current_vs_history(*both)),
                offenders=reconcile.differing_subscriptions(*both),
            )
        except ValueError:
            files.delete(spark, f"{lake.current}/{folder}")
            raise
        tables.publish_current(spark, lake.current, folder)
    return results


def update_gold(spark: SparkSession, lake: Lake, now) -> dict | None:
    """Renews the KPI rows from the earliest date on that silver has changed, or begun to, since gold last ran.

    Of the history only the dates that silver names are read: their end-of-day states are compared with the stored ones,
    and what the changes amount to is added to the stored KPIs. States and KPIs go into force in one step, so a run that
    is lost in between finds both as they were. Changes that silver has begun and not finished stay due.
    Returns None when there is nothing to do.
    """
    utc(spark)
    mark = control.load_mark(spark, lake.control, GOLD)
    # read before the history: a change seen here is contained there, or will be seen here again
    silver = control.changes_since(
        spark, lake.control, SILVER, mark["upstream_sequence"] if mark else None
    )
    start = silver["affected_start"]
    if start is None:
        return None
    in_force = tables.history_dates(spark, lake.history)
    stored = tables.gold_dates(spark, lake.day_states)
    due = {d.isoformat() for d in silver["affected_dates"]}
    # rows that list no dates, and a table of states that isn't there yet, leave nothing to go by
    unlisted = "" if not stored else silver["unlisted_start"].isoformat() if silver["unlisted_start"] else "~"
    due = sorted(due | {d for d in {*in_force, *stored} if d >= unlisted})
    if not due:
        return None
    folder = pointers.new_folder()
    named = [date.fromisoformat(d) for d in due]
    history = dedup.restrict_to_dates(tables.read_history(spark, lake.history), named)
    counted = Observation("states")
    states = kpi.day_states(history.observe(counted, F.count(F.lit(1)).alias("rows")))
    tables.stage_gold(states, lake.day_states, folder)
    made = tables.staged_gold_dates(spark, lake.day_states, folder)
    kept = sorted(({*stored} - {*due}) | {*made})
    kpis = tables.read_kpis(spark, lake.kpi)
    renewed = upkeep.renewed_kpis(
        # without the states that they were made from, stored KPIs are no base for differences
        kpis if stored else kpis.limit(0), tables.read_day_states(spark, lake.day_states),
        tables.read_staged_gold(spark, lake.day_states, folder, schema.DAY_STATE), named, kept, now,
    )
    tables.stage_gold(renewed, lake.kpi, folder)
    kpis = tables.read_staged_gold(spark, lake.kpi, folder, schema.KPI)
    dates = _dates(kpis.select("date"))
    checks = []
    try:
        if dates:
            current = tables.read_current(spark, lake.current)
            checks = _judge(
                spark, lake, GOLD, now,
                quality.check_kpis(kpis).unionByName(reconcile.check_kpi_vs_current(kpis, current)),
                ("gold", "kpi_daily", {
                    "row_count_in": _rows(counted), "row_count_out": len(dates), "affected_partitions": _listed(dates)
                }),
            )
    except ValueError:
        files.delete(spark, f"{lake.gold}/{folder}")
        raise
    old = [d for d in tables.gold_dates(spark, lake.kpi) if d >= due[0] or not stored]
    tables.publish_gold(spark, folder, {lake.day_states: due, lake.kpi: old})
    control.save_mark(
        spark, lake.control, GOLD, silver["mark"], committed_at=now, affected_start=start,
        upstream_sequence=silver["sequence"],
    )
    return {"mark": silver["mark"], "dates": dates, "checks": checks}


def reconcile_all(spark: SparkSession, lake: Lake, now) -> list:
    """Compares the whole snapshot with the whole history by digests, and looks for event ids that occur twice."""
    utc(spark)
    history, current = tables.read_history(spark, lake.history), tables.read_current(spark, lake.current)
    checks = quality.check_history(history).unionByName(quality.check_current(current))
    return _judge(
        spark, lake, "reconcile", now,
        checks.unionByName(reconcile.check_current_vs_history(current, history, by_digests=True)),
        offenders=reconcile.differing_subscriptions(current, history),
    )


def _judge(spark, lake, job, now, checks, summary=None, offenders=None):
    """Runs checks and keeps their rows, also of those that fail; raises if any did.

    ``summary`` (layer, dataset, values) becomes a row ``run_summary``: rows in and out, dates touched, checks failed.
    ``offenders`` are looked for only when a check has failed, and join its details.
    """
    results = checks.select(*schema.CHECK.fieldNames()).collect()
    if offenders is not None and any(not r["passed"] for r in results):
        found = spark.createDataFrame(offenders.collect(), "check_name string, value string")
        results = quality.with_offenders(spark.createDataFrame(results, schema.CHECK), found).collect()
    kept = list(results)
    if summary:
        layer, dataset, values = summary
        failed = sum(not r["passed"] for r in results)
        details = {k: str(v) for k, v in values.items()} | {"failed_checks": str(failed)}
        kept.append((layer, dataset, "run_summary", not failed, failed, details))
    tables.append_checks(spark, kept, lake.checks, job, now)
    return quality.judged(results)


def _rows(counted):
    """Rows that were observed; none where nothing had to be run."""
    return counted.get.get("rows", 0)


def _listed(dates):
    """Dates as text: all of them, one per calendar day."""
    return ",".join(str(d) for d in dates)


def _dates(df):
    """The distinct dates of a one-column frame, sorted: at most one entry per calendar day."""
    return sorted(r[0] for r in df.distinct().collect() if r[0] is not None)
