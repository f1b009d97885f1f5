"""The same questions in plain SQL over the given tables.

Written without the Spark code's shortcuts: states are ranked per date instead of accumulated, and
merges are restated as a deduplication of everything that has arrived.
"""

from billtide import schema

MARK = "TIMESTAMP '2024-01-20 00:00:00'"
ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"


def iso(column):
    return f"strftime({column}, {ISO}) AS {column}"


def day(column, name=None):
    return f"strftime({column}, '%Y-%m-%d') AS {name or column}"


def quoted(values):
    return ", ".join(f"'{v}'" for v in values)


EVENT_TEXT = f"""event_id, {iso('event_time')}, event_type, schema_version, user_id, subscription_id,
    plan_id, billing_cycle, CAST(price AS DOUBLE) AS price, currency, status, source,
    {iso('ingested_at')}"""

CTES = {
    "numbered": """
    SELECT event_id AS n, ts, user_id AS u,
        CASE event_type WHEN 'signup' THEN 'subscription_created'
            WHEN 'purchase' THEN 'subscription_renewed'
            WHEN 'click' THEN 'subscription_upgraded'
            WHEN 'view' THEN 'subscription_downgraded'
            WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'payment_failed'
                                   ELSE 'subscription_cancelled' END END AS kind,
        ts + to_minutes(CAST((event_id * 37) % 4320 AS BIGINT)) AS arrival
    FROM events""",
    "catalog": "SELECT * FROM (VALUES "
    + ", ".join(f"('{p}', {t}, '{c}', CAST({a} AS DECIMAL(10,2)))" for p, t, c, a in schema.PLANS)
    + ") AS t(plan_id, tier, billing_cycle, price)",
    "statuses": "SELECT * FROM (VALUES "
    + ", ".join(f"('{e}', '{s}')" for e, s in schema.STATUS_AFTER.items())
    + ") AS t(event_type, expected_status)",
    "first_deliveries": """
    SELECT n, printf('evt_%09d', n) AS event_id, ts AS event_time, kind AS event_type,
        '1.0' AS schema_version, printf('user_%05d', u) AS user_id,
        printf('sub_%05d', u) AS subscription_id, c.plan_id, 'monthly' AS billing_cycle, c.price,
        'USD' AS currency, s.expected_status AS status,
        CASE n % 4 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile' ELSE 'system' END AS source,
        arrival AS ingested_at
    FROM numbered JOIN catalog c ON c.tier = n % 3 JOIN statuses s ON s.event_type = kind""",
    "numbered_bronze": """
    SELECT * FROM first_deliveries
    UNION ALL
    SELECT d.* REPLACE ('mobile' AS source, ingested_at + INTERVAL 1 DAY AS ingested_at,
        CASE n % 60 WHEN 0 THEN event_time - INTERVAL 2 DAY
                    WHEN 20 THEN event_time + INTERVAL 20 HOUR ELSE event_time END AS event_time,
        printf('sub_%05d', e.user_id + CASE WHEN n % 100 = 40 THEN 1 ELSE 0 END) AS subscription_id)
    FROM first_deliveries d JOIN events e ON e.event_id = n WHERE n % 20 = 0""",
    "bronze": "SELECT * EXCLUDE (n) FROM numbered_bronze",
    "history": """
    SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (
        PARTITION BY event_id ORDER BY ingested_at DESC, event_time DESC) AS k FROM bronze)
    WHERE k = 1""",
    "stored": f"""
    SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (
        PARTITION BY event_id ORDER BY ingested_at DESC, event_time DESC) AS k
        FROM bronze WHERE ingested_at <= {MARK})
    WHERE k = 1""",
    "batch": f"SELECT * FROM bronze WHERE ingested_at > {MARK}",
    "touched": "SELECT DISTINCT CAST(event_time AS DATE) AS dt FROM batch",
    "state": """
    SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY subscription_id
        ORDER BY event_time DESC, ingested_at DESC, event_id DESC) AS k FROM history)
    WHERE k = 1""",
    "current": """
    SELECT subscription_id, user_id, plan_id AS current_plan_id,
        billing_cycle AS current_billing_cycle, price AS current_price, currency,
        status AS current_status, event_type AS last_event_type, event_time AS last_event_time,
        TIMESTAMP '2024-03-01 00:00:00' AS snapshot_time
    FROM state""",
    "tampered": """
    SELECT * REPLACE (CASE WHEN right(subscription_id, 1) = '1' THEN current_price + 1
                           ELSE current_price END AS current_price)
    FROM current WHERE right(subscription_id, 1) <> '0'
    UNION ALL
    SELECT 'sub_99999', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL""",
    "spine": "SELECT DISTINCT CAST(event_time AS DATE) AS date FROM history",
    "as_of": """
    SELECT * EXCLUDE (k) FROM (SELECT s.date, h.*, row_number() OVER (
            PARTITION BY s.date, h.subscription_id
            ORDER BY h.event_time DESC, h.ingested_at DESC, h.event_id DESC) AS k
        FROM spine s JOIN history h ON CAST(h.event_time AS DATE) <= s.date)
    WHERE k = 1""",
    "flow": """
    SELECT CAST(event_time AS DATE) AS date,
        count(DISTINCT subscription_id) FILTER (event_type = 'subscription_created')
            AS new_subscriptions,
        count(DISTINCT subscription_id) FILTER (event_type = 'subscription_cancelled')
            AS new_cancellations
    FROM history GROUP BY 1""",
    "stock": """
    SELECT date, count(*) FILTER (status = 'active') AS active_subscriptions,
        coalesce(sum(price) FILTER (status = 'active'), 0) AS mrr
    FROM as_of GROUP BY 1""",
    "kpi": """
    SELECT date, new_subscriptions, new_cancellations, active_subscriptions, mrr, 'USD' AS currency
    FROM flow JOIN stock USING (date)""",
    "dirty": f"""
    SELECT event_id,
        CASE WHEN n % 127 = 0 THEN 'not-a-time'
             WHEN n % 149 = 0 THEN '12:30' WHEN n % 151 = 0 THEN 'T12:30'
             WHEN n % 103 = 0 THEN strftime(ingested_at + INTERVAL 1 HOUR, {ISO})
             ELSE strftime(event_time, {ISO}) END AS event_time,
        event_type,
        CASE WHEN n % 113 = 0 THEN '0.9' ELSE schema_version END AS schema_version,
        CASE WHEN n % 107 = 0 THEN NULL ELSE user_id END AS user_id,
        subscription_id,
        CASE WHEN n % 131 = 0 THEN 'gold_monthly' ELSE plan_id END AS plan_id,
        billing_cycle,
        CASE WHEN n % 139 = 0 THEN 'abc' WHEN n % 157 = 0 THEN 'NaN' WHEN n % 137 = 0 THEN '-9.99'
             WHEN n % 101 = 0 THEN '1.00' ELSE CAST(price AS VARCHAR) END AS price,
        CASE WHEN n % 109 = 0 THEN 'EUR' ELSE currency END AS currency,
        CASE WHEN n % 97 = 0 THEN CASE WHEN status = 'active' THEN 'cancelled' ELSE 'active' END
             ELSE status END AS status,
        source, strftime(ingested_at, {ISO}) AS ingested_at
    FROM numbered_bronze""",
    "dirty_parsed": """
    SELECT * REPLACE (CASE WHEN event_time LIKE '____-__-__%'
            THEN try_cast(replace(event_time, 'Z', '') AS TIMESTAMP) END AS event_time,
        try_cast(replace(ingested_at, 'Z', '') AS TIMESTAMP) AS ingested_at,
        try_cast(price AS DECIMAL(10,2)) AS price)
    FROM dirty""",
    "dirty_history": """
    SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY event_id
        ORDER BY ingested_at DESC NULLS LAST, event_time DESC NULLS LAST) AS k FROM dirty_parsed)
    WHERE k = 1""",
    "dirty_state": """
    SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY subscription_id
        ORDER BY event_time DESC NULLS LAST, ingested_at DESC NULLS LAST, event_id DESC) AS k
        FROM dirty_history)
    WHERE k = 1""",
    "steps": """
    SELECT *, lag(event_id) OVER w AS previous_event_id, lag(status) OVER w AS previous_status,
        lag(plan_id) OVER w AS previous_plan_id, lag(price) OVER w AS previous_price,
        lag(billing_cycle) OVER w AS previous_billing_cycle
    FROM history
    WINDOW w AS (PARTITION BY subscription_id ORDER BY event_time, ingested_at, event_id)""",
}

# which tables each one is made from
NEEDS = {
    "first_deliveries": ["numbered", "catalog", "statuses"],
    "numbered_bronze": ["first_deliveries"],
    "bronze": ["numbered_bronze"],
    "history": ["bronze"],
    "stored": ["bronze"],
    "batch": ["bronze"],
    "touched": ["batch"],
    "state": ["history"],
    "current": ["state"],
    "tampered": ["current"],
    "spine": ["history"],
    "as_of": ["spine", "history"],
    "flow": ["history"],
    "stock": ["as_of"],
    "kpi": ["flow", "stock"],
    "dirty": ["numbered_bronze"],
    "dirty_parsed": ["dirty"],
    "dirty_history": ["dirty_parsed"],
    "dirty_state": ["dirty_history"],
    "steps": ["history"],
}


def with_tables(names, select):
    """``select`` preceded by the named tables and everything they are made from."""
    wanted = set()

    def want(name):
        wanted.add(name)
        for below in NEEDS.get(name, []):
            want(below)

    for name in names:
        want(name)
    # the dictionary lists every table after those it is made from
    tables = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items() if name in wanted)
    return f"WITH {tables}\n{select}"


def check(layer, dataset, name, violations, passed=None):
    passed = passed or f"({violations}) = 0"
    return (
        f"SELECT '{layer}' AS layer, '{dataset}' AS dataset, '{name}' AS check_name, "
        f"{passed} AS passed, CAST({violations} AS BIGINT) AS violation_count"
    )


def count(table, where):
    return f"(SELECT count(*) FROM {table} WHERE {where})"


def nulls(table, columns):
    return " + ".join(count(table, f"{c} IS NULL") for c in columns)


def domain(layer, dataset, table, column, allowed):
    return check(
        layer, dataset, f"{column}_allowed_values",
        count(table, f"{column} IS NOT NULL AND {column} NOT IN ({quoted(allowed)})"),
    )


def unique(layer, dataset, table, column, name):
    return check(
        layer, dataset, name,
        f"(SELECT coalesce(sum(k - 1), 0) FROM (SELECT count(*) AS k FROM {table} GROUP BY {column}))",
    )


def numeric(layer, dataset, table, column):
    bad = f"{column} IS NOT NULL AND {as_number(column)} IS NULL"
    return check(
        layer, dataset, f"{column}_non_negative",
        f"{count(table, bad)} + {count(table, f'{as_number(column)} < 0')}",
    )


def as_time(column):
    """Only what begins with a date; engines differ in what else they take for a time."""
    text = f"replace({column}, 'Z', '')"
    return f"CASE WHEN {column} LIKE '____-__-__%' THEN try_cast({text} AS TIMESTAMP) END"


def as_number(column):
    number = f"try_cast({column} AS DOUBLE)"
    return f"CASE WHEN isfinite({number}) THEN {number} END"


def event_checks(table):
    where = ("bronze", "subscription_events")
    late = f"{as_time('event_time')} > {as_time('ingested_at')}"
    bad_times = " + ".join(
        count(table, f"{as_time(c)} IS NULL") for c in ("event_time", "ingested_at")
    )
    bad_version = count(table, "schema_version <> '1.0'")
    return [
        check(*where, "not_empty", "0", f"{count(table, 'true')} > 0"),
        check(*where, "required_columns", "0"),
        check(*where, "non_null_columns", nulls(table, schema.EVENT_COLUMNS)),
        check(*where, "datetime_parseable", bad_times),
        domain(*where, table, "event_type", schema.EVENT_TYPES),
        domain(*where, table, "billing_cycle", schema.BILLING_CYCLES),
        domain(*where, table, "currency", schema.CURRENCIES),
        domain(*where, table, "status", schema.STATUSES),
        domain(*where, table, "source", schema.SOURCES),
        check(*where, "event_time_le_ingested_at", count(table, late)),
        check(
            *where, "schema_version_expected", bad_version,
            f"{bad_version} = 0 AND {count(table, 'schema_version = ' + quoted(['1.0']))} > 0",
        ),
        numeric(*where, table, "price"),
        check(
            *where, "plan_id_exists_in_catalog",
            count(table, "plan_id IS NOT NULL AND plan_id NOT IN (SELECT plan_id FROM catalog)"),
        ),
        check(
            *where, "plan_attributes_match_catalog",
            f"(SELECT count(*) FROM {table} d JOIN catalog c USING (plan_id) WHERE "
            "try_cast(d.price AS DOUBLE) IS DISTINCT FROM CAST(c.price AS DOUBLE) "
            "OR d.billing_cycle IS DISTINCT FROM c.billing_cycle)",
        ),
        check(
            *where, "event_type_status_consistency",
            f"(SELECT count(*) FROM {table} d JOIN statuses s USING (event_type) "
            "WHERE d.status IS DISTINCT FROM s.expected_status)",
        ),
    ]


def history_checks(table):
    where = ("silver", "subscription_state_history")
    bad_times = " + ".join(count(table, f"{c} IS NULL") for c in ("event_time", "ingested_at"))
    return [
        check(*where, "not_empty", "0", f"{count(table, 'true')} > 0"),
        check(*where, "required_columns", "0"),
        check(*where, "non_null_columns", nulls(table, schema.HISTORY_COLUMNS)),
        check(*where, "datetime_parseable", bad_times),
        domain(*where, table, "status", schema.STATUSES),
        check(*where, "event_time_le_ingested_at", count(table, "event_time > ingested_at")),
        unique(*where, table, "event_id", "event_id_unique"),
    ]


def offending(table, check_name, where, *columns):
    """(check_name, value) of the rows that a check counts."""
    text = " || '/' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)
    return f"SELECT '{check_name}' AS check_name, left({text}, 200) AS value FROM {table} d WHERE {where}"


def event_offenders(table):
    looked_up = f"(SELECT d.*, c.price AS listed, c.billing_cycle AS cycle, s.expected_status FROM {table} d " \
        "LEFT JOIN catalog c USING (plan_id) LEFT JOIN statuses s USING (event_type))"  # fmt: skip
    price = as_number("price")
    return [
        offending(table, "datetime_parseable", f"{as_time('event_time')} IS NULL", "event_time"),
        *[
            offending(table, f"{c}_allowed_values", f"{c} NOT IN ({quoted(allowed)})", c)
            for c, allowed in DOMAINS.items()
            if c != "schema_version"
        ],
        offending(table, "schema_version_expected", "schema_version <> '1.0'", "schema_version"),
        offending(table, "price_non_negative", f"price IS NOT NULL AND {price} IS NULL OR {price} < 0", "price"),
        offending(looked_up, "plan_id_exists_in_catalog", "listed IS NULL", "plan_id"),
        offending(
            looked_up, "plan_attributes_match_catalog",
            """listed IS NOT NULL AND (try_cast(price AS DOUBLE) IS DISTINCT FROM CAST(listed AS DOUBLE)
            OR billing_cycle IS DISTINCT FROM cycle)""",
            "plan_id", "price", "billing_cycle",
        ),
        offending(
            looked_up, "event_type_status_consistency",
            "expected_status IS NOT NULL AND status IS DISTINCT FROM expected_status", "event_type", "status",
        ),
    ]


def with_first_values(checks, values):
    """Check rows beside the first ten of their offending values."""
    return f"""SELECT layer, dataset, c.check_name, passed, violation_count, offenders
        FROM ({union(checks)}) c LEFT JOIN (
            SELECT check_name, string_agg(value, ',' ORDER BY value) AS offenders FROM (
                SELECT *, row_number() OVER (PARTITION BY check_name ORDER BY value) AS k
                FROM (SELECT DISTINCT * FROM ({union(values)})))
            WHERE k <= 10 GROUP BY 1) o ON o.check_name = c.check_name"""


def union(selects):
    return "\nUNION ALL\n".join(selects)


SAME = " AND ".join(
    f"coalesce(c.{ours} = s.{source}, false)"
    for ours, source in schema.CURRENT_FROM_HISTORY.items()
)


def reconciled(snapshot, state, name):
    joined = f"FROM {snapshot} c FULL JOIN {state} s ON c.subscription_id = s.subscription_id"
    return f"""
    SELECT count(*) FILTER (c.subscription_id IS NULL) AS missing_in_current,
        count(*) FILTER (s.subscription_id IS NULL) AS missing_in_history,
        count(*) FILTER (c.subscription_id IS NOT NULL AND s.subscription_id IS NOT NULL
            AND NOT ({SAME})) AS mismatched,
        '{name}' AS snapshot {joined}"""


CURRENT_SHOWN = f"""subscription_id, user_id, current_plan_id, current_billing_cycle,
    CAST(current_price AS DOUBLE) AS current_price, currency, current_status, last_event_type,
    {iso('last_event_time')}"""

KPI_SHOWN = f"""{day('date')}, new_subscriptions, new_cancellations, active_subscriptions,
    CAST(mrr AS DOUBLE) AS mrr, currency"""


def kpi_beside(snapshot):
    return f"""
    SELECT true AS checked, {day('k.date', 'date')},
        k.active_subscriptions AS actual_active_subscriptions,
        c.active AS expected_active_subscriptions,
        CAST(k.mrr AS DOUBLE) AS actual_mrr, CAST(c.mrr AS DOUBLE) AS expected_mrr,
        k.active_subscriptions = c.active AS active_subscriptions_match,
        k.mrr = c.mrr AS mrr_match, '{snapshot[0]}' AS snapshot
    FROM (SELECT * FROM kpi ORDER BY date DESC LIMIT 1) k,
        (SELECT count(*) FILTER (current_status = 'active') AS active,
            sum(current_price) FILTER (current_status = 'active') AS mrr FROM {snapshot[1]}) c"""


def current_checks(table):
    where = ("silver", "subscription_state_current")
    found = (
        "(SELECT missing_in_current + missing_in_history + mismatched "
        f"FROM ({reconciled(table, 'state', '')}))"
    )
    bad_times = " + ".join(
        count(table, f"{c} IS NULL") for c in ("last_event_time", "snapshot_time")
    )
    return [
        check(*where, "not_empty", "0", f"{count(table, 'true')} > 0"),
        check(*where, "required_columns", "0"),
        check(*where, "non_null_columns", nulls(table, schema.CURRENT.fieldNames())),
        check(*where, "datetime_parseable", bad_times),
        domain(*where, table, "current_status", schema.STATUSES),
        unique(*where, table, "subscription_id", "subscription_id_unique"),
        check(*where, "current_matches_latest_history", found),
    ]


def kpi_checks(snapshot):
    where = ("gold", "kpi_daily")
    columns = [c for c in schema.KPI.fieldNames() if c != "snapshot_time"]
    found = (
        "(SELECT CAST(NOT active_subscriptions_match AS INT) + CAST(NOT mrr_match AS INT) "
        f"FROM ({kpi_beside(('', snapshot))}))"
    )
    return [
        check(*where, "not_empty", "0", f"{count('kpi', 'true')} > 0"),
        check(*where, "required_columns", "0"),
        check(*where, "non_null_columns", nulls("kpi", columns)),
        check(*where, "datetime_parseable", "0"),
        domain(*where, "kpi", "currency", schema.CURRENCIES),
        *[
            numeric(*where, "kpi", c)
            for c in ("new_subscriptions", "new_cancellations", "active_subscriptions", "mrr")
        ],
        unique(*where, "kpi", "date", "date_unique"),
        check(*where, "latest_kpi_matches_current_snapshot", found),
    ]


DOMAINS = {
    "event_type": schema.EVENT_TYPES,
    "billing_cycle": schema.BILLING_CYCLES,
    "currency": schema.CURRENCIES,
    "status": schema.STATUSES,
    "source": schema.SOURCES,
    "schema_version": [schema.EVENT_SCHEMA_VERSION],
}

ILLEGAL = f"""
    previous_event_id IS NULL AND event_type <> 'subscription_created'
    OR previous_event_id IS NOT NULL AND (
        previous_status = 'cancelled'
        OR event_type = 'subscription_created'
        OR previous_status = 'past_due'
            AND event_type NOT IN ('subscription_renewed', 'subscription_cancelled')
        OR event_type = 'subscription_upgraded' AND previous_plan_id = '{schema.HIGHEST_PLAN}'
        OR event_type = 'subscription_downgraded' AND previous_plan_id = '{schema.LOWEST_PLAN}')"""

KPI_FROM_START = with_tables(
    ["kpi"],
    f"""SELECT {KPI_SHOWN} FROM kpi
    WHERE date >= (SELECT CAST(min(event_time) AS DATE) FROM history WHERE ingested_at > {MARK})""",
)

ALL_HISTORY = with_tables(
    ["history"], f"SELECT {EVENT_TEXT}, {day('event_time', 'dt')} FROM history"
)
ALL_KPIS = with_tables(["kpi"], f"SELECT {KPI_SHOWN} FROM kpi")
ALL_CURRENT = with_tables(["current"], f"SELECT {CURRENT_SHOWN} FROM current")

# dates that the second run of the jobs opens again, the rows on them afterwards, and the KPI rows made anew
REOPENED = """(SELECT CAST(event_time AS DATE) AS dt FROM batch UNION
    SELECT CAST(event_time AS DATE) FROM stored WHERE event_id IN (SELECT event_id FROM batch))"""
IN_REOPENED = f"(SELECT count(*) FROM history WHERE CAST(event_time AS DATE) IN {REOPENED})"
RENEWED = f"""(SELECT count(DISTINCT CAST(event_time AS DATE)) FROM history
    WHERE CAST(event_time AS DATE) >= (SELECT min(dt) FROM {REOPENED} r))"""

RECONCILED = with_tables(
    ["current", "state", "tampered", "dirty_state"],
    union(
        [
            reconciled("current", "state", "true"),
            reconciled("tampered", "state", "tampered"),
            reconciled(
                """(SELECT subscription_id, plan_id AS current_plan_id,
                billing_cycle AS current_billing_cycle, price AS current_price,
                status AS current_status, event_type AS last_event_type,
                event_time AS last_event_time FROM dirty_state)""",
                "dirty_state", "dirty",
            ),
        ]
    ),
)

ORACLES = {
    "subscription_events": with_tables(["bronze"], f"SELECT {EVENT_TEXT} FROM bronze"),
    "bronze_json_roundtrip": with_tables(
        ["bronze"], f"SELECT {EVENT_TEXT}, {day('ingested_at', 'dt')} FROM bronze"
    ),
    "bronze_partitions": with_tables(
        ["bronze"], f"SELECT DISTINCT {day('ingested_at', 'dt')} FROM bronze"
    ),
    "bronze_append": with_tables(
        ["bronze"],
        f"""SELECT {day('ingested_at', 'dt')}, count(*) AS row_count,
        CAST(sum(price) AS DOUBLE) AS price_sum FROM bronze GROUP BY 1""",
    ),
    "history_partition_overwrite": ALL_HISTORY,
    "history_stored_order": "SELECT 0 AS out_of_place",
    "order_in_files": with_tables(
        ["history"],
        check(
            "silver", "subscription_state_history", "sorted_by_event_order",
            """(SELECT count(*) FROM (SELECT event_time, ingested_at, event_id,
                lag((event_time, ingested_at, event_id)) OVER (
                    PARTITION BY CAST(event_time AS DATE), CAST(substr(event_id, 5) AS BIGINT) % 8
                    ORDER BY event_id) AS before FROM history)
            WHERE before > (event_time, ingested_at, event_id))""",
        ),
    ),
    "ingest_good_lines": with_tables(
        ["numbered_bronze"],
        f"""SELECT {EVENT_TEXT}, {day('ingested_at', 'dt')} FROM numbered_bronze
        WHERE n % 83 <> 0 AND n % 89 <> 0""",
    ),
    "ingest_rejects": with_tables(
        ["numbered_bronze"],
        """SELECT CASE WHEN n % 83 = 0 THEN '{"event_id":"' || event_id || '"'
            ELSE 'no json: ' || event_id END AS line, count(*) AS row_count FROM numbered_bronze
        WHERE n % 83 = 0 OR n % 89 = 0 GROUP BY 1""",
    ),
    "kpi_partition_overwrite": with_tables(
        ["kpi"], f"SELECT {KPI_SHOWN}, {day('date', 'dt')} FROM kpi"
    ),
    "watermark_roundtrip": with_tables(
        ["bronze"],
        f"""SELECT 'subscription_events_silver' AS pipeline,
        strftime(max(ingested_at), {ISO}) AS last_processed_ingested_at FROM bronze
        UNION ALL SELECT 'kpi_daily_gold', strftime(max(ingested_at), {ISO}) FROM bronze
        WHERE ingested_at <= {MARK}""",
    ),
    "parse_event_times": with_tables(
        ["dirty"],
        f"""SELECT event_id, event_time AS event_time_text,
        strftime({as_time('event_time')}, {ISO}) AS event_time,
        strftime({as_time('event_time')}, '%Y-%m-%d') AS event_date,
        strftime({as_time('ingested_at')}, {ISO}) AS ingested_at FROM dirty""",
    ),
    "bronze_incremental": with_tables(
        ["batch"], f"SELECT {EVENT_TEXT}, {day('ingested_at', 'dt')} FROM batch"
    ),
    "history_dedup": with_tables(["history"], f"SELECT {EVENT_TEXT} FROM history"),
    "history_merge": with_tables(
        ["history", "touched"],
        f"""SELECT {EVENT_TEXT} FROM history
        WHERE CAST(event_time AS DATE) IN (SELECT dt FROM touched)""",
    ),
    "history_full": with_tables(
        ["history"], f"SELECT {EVENT_TEXT}, {day('event_time', 'date')} FROM history"
    ),
    "history_affected_scan": with_tables(
        ["stored", "touched"],
        f"""SELECT {EVENT_TEXT}, {day('event_time', 'dt')} FROM stored
        WHERE CAST(event_time AS DATE) IN (SELECT dt FROM touched)""",
    ),
    "history_incremental": with_tables(
        ["history"], f"SELECT {EVENT_TEXT} FROM history WHERE ingested_at > {MARK}"
    ),
    "redelivered_dates": with_tables(
        ["stored", "batch"],
        f"""SELECT DISTINCT {day('event_time', 'dt')} FROM stored
        WHERE event_id IN (SELECT event_id FROM batch)""",
    ),
    "affected_partitions": with_tables(["touched"], f"SELECT {day('dt')} FROM touched"),
    "affected_start_date": with_tables(
        ["batch"], f"SELECT {day('min(event_time)', 'start_date')} FROM batch"
    ),
    "next_watermark": with_tables(
        ["batch"],
        f"SELECT strftime(max(ingested_at), {ISO}) AS last_processed_ingested_at FROM batch",
    ),
    "late_events": with_tables(
        ["batch"],
        f"""SELECT {EVENT_TEXT},
        date_diff('day', CAST(batch.event_time AS DATE), CAST(batch.ingested_at AS DATE)) AS days_late
        FROM batch WHERE CAST(batch.event_time AS DATE) < CAST({MARK} AS DATE)""",
    ),
    "current_state": ALL_CURRENT,
    "refresh_current": ALL_CURRENT,
    "state_as_of": with_tables(
        ["as_of"],
        f"""SELECT {day('date')}, subscription_id, status, plan_id, CAST(price AS DOUBLE) AS price,
        event_id AS last_event_id FROM as_of""",
    ),
    "state_at_times": with_tables(
        ["bronze", "history"],
        f"""SELECT b.event_id AS ask_id, b.subscription_id, strftime(b.ingested_at, {ISO}) AS asked_at,
            h.status, h.plan_id, CAST(h.price AS DOUBLE) AS price, h.event_id AS last_event_id
        FROM bronze b ASOF LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY subscription_id, event_time
                ORDER BY ingested_at DESC, event_id DESC) AS k FROM history QUALIFY k = 1) h
            ON b.subscription_id = h.subscription_id AND b.ingested_at >= h.event_time""",
    ),
    "state_intervals": with_tables(
        ["history"],
        f"""SELECT subscription_id, {day('date', 'valid_from')},
        strftime(lead(date) OVER (PARTITION BY subscription_id ORDER BY date), '%Y-%m-%d')
            AS valid_to,
        status, plan_id, CAST(price AS DOUBLE) AS price, event_id AS last_event_id
        FROM (SELECT *, CAST(event_time AS DATE) AS date, row_number() OVER (
            PARTITION BY subscription_id, CAST(event_time AS DATE)
            ORDER BY event_time DESC, ingested_at DESC, event_id DESC) AS k FROM history)
        WHERE k = 1""",
    ),
    "kpi_flow_daily": with_tables(
        ["flow"], f"SELECT {day('date')}, new_subscriptions, new_cancellations FROM flow"
    ),
    "kpi_stock_daily": with_tables(
        ["stock"],
        f"SELECT {day('date')}, active_subscriptions, CAST(mrr AS DOUBLE) AS mrr FROM stock",
    ),
    "kpi_daily": ALL_KPIS,
    "kpi_by_differences": ALL_KPIS,
    "kpi_daily_incremental": KPI_FROM_START,
    "latest_kpi": with_tables(
        ["kpi"], f"SELECT {KPI_SHOWN} FROM kpi WHERE date = (SELECT max(date) FROM kpi)"
    ),
    "recon_current_vs_history": RECONCILED,
    "recon_by_digests": RECONCILED,
    "recon_kpi_vs_current": with_tables(
        ["kpi", "current", "tampered"],
        union([kpi_beside(("true", "current")), kpi_beside(("tampered", "tampered"))]),
    ),
    "mismatch_sample": with_tables(
        ["tampered", "state"],
        f"""SELECT c.subscription_id, c.current_plan_id, s.plan_id AS expected_plan_id,
        c.current_billing_cycle, s.billing_cycle AS expected_billing_cycle,
        CAST(c.current_price AS DOUBLE) AS current_price, CAST(s.price AS DOUBLE) AS expected_price,
        c.current_status, s.status AS expected_status,
        c.last_event_type, s.event_type AS expected_event_type,
        strftime(c.last_event_time, {ISO}) AS last_event_time,
        strftime(s.event_time, {ISO}) AS expected_event_time
        FROM tampered c JOIN state s ON c.subscription_id = s.subscription_id
        WHERE NOT ({SAME}) ORDER BY c.subscription_id LIMIT 10""",
    ),
    "dq_bronze_summary": with_tables(["dirty"], union(event_checks("dirty"))),
    "dq_history_summary": with_tables(["dirty_history"], union(history_checks("dirty_history"))),
    "dq_current_summary": with_tables(["tampered", "state"], union(current_checks("tampered"))),
    "dq_kpi_summary": with_tables(["kpi", "tampered"], union(kpi_checks("tampered"))),
    "dq_bronze_details": with_tables(
        ["dirty", "catalog", "statuses"], with_first_values(event_checks("dirty"), event_offenders("dirty"))
    ),
    "dq_current_details": with_tables(
        ["tampered", "state"],
        with_first_values(
            current_checks("tampered")[-1:],
            [
                f"""SELECT 'current_matches_latest_history' AS check_name,
                coalesce(c.subscription_id, s.subscription_id) AS value
                FROM tampered c FULL JOIN state s ON c.subscription_id = s.subscription_id
                WHERE c.subscription_id IS NULL OR s.subscription_id IS NULL OR NOT ({SAME})"""
            ],
        ),
    ),
    "dq_verdict": with_tables(
        ["dirty", "history"],
        f"""SELECT layer, dataset, bool_and(passed) AS passed, count(*) AS check_count,
        count(*) FILTER (NOT passed) AS failed_check_count,
        coalesce(string_agg(check_name, ',' ORDER BY check_name) FILTER (NOT passed), '')
            AS failed_checks
        FROM ({union(event_checks("dirty") + history_checks("history"))}) GROUP BY 1, 2""",
    ),
    "dq_null_counts": with_tables(
        ["dirty"],
        union(
            [
                f"SELECT '{c}' AS column_name, {count('dirty', f'{c} IS NULL')} AS null_count"
                for c in schema.EVENT_COLUMNS
            ]
        ),
    ),
    "dq_duplicate_keys": with_tables(
        ["dirty"],
        "SELECT event_id, count(*) AS copies FROM dirty GROUP BY 1 HAVING count(*) > 1",
    ),
    "dq_invalid_values": with_tables(
        ["dirty"],
        union(
            [
                f"""SELECT '{c}' AS column_name, {c} AS value, count(*) AS row_count FROM dirty
                WHERE {c} IS NOT NULL AND {c} NOT IN ({quoted(allowed)}) GROUP BY 2"""
                for c, allowed in DOMAINS.items()
            ]
        ),
    ),
    "dq_unparseable_times": with_tables(
        ["dirty"],
        union(
            [
                f"""SELECT '{c}' AS column_name,
                {count('dirty', as_time(c) + ' IS NULL')} AS invalid_count"""
                for c in ("event_time", "ingested_at")
            ]
        ),
    ),
    "dq_event_after_ingest": with_tables(
        ["dirty"],
        f"""SELECT event_id, event_time, ingested_at FROM dirty
        WHERE {as_time('event_time')} > {as_time('ingested_at')}""",
    ),
    "dq_non_negative": with_tables(
        ["dirty"],
        f"""SELECT 'price' AS column_name,
        {count('dirty', f"price IS NOT NULL AND {as_number('price')} IS NULL")} AS not_numeric,
        {count('dirty', f"{as_number('price')} < 0")} AS negative""",
    ),
    "dq_unknown_plans": with_tables(
        ["dirty", "catalog"],
        """SELECT plan_id, count(*) AS row_count FROM dirty
        WHERE plan_id NOT IN (SELECT plan_id FROM catalog) GROUP BY 1""",
    ),
    "dq_plan_mismatch": with_tables(
        ["dirty", "catalog"],
        """SELECT d.event_id, d.source, d.plan_id, d.price,
        CAST(c.price AS DOUBLE) AS expected_price, d.billing_cycle,
        c.billing_cycle AS expected_billing_cycle
        FROM dirty d JOIN catalog c ON d.plan_id = c.plan_id
        WHERE try_cast(d.price AS DOUBLE) IS DISTINCT FROM CAST(c.price AS DOUBLE)
            OR d.billing_cycle IS DISTINCT FROM c.billing_cycle""",
    ),
    "status_mismatch_pairs": with_tables(
        ["dirty", "statuses"],
        """SELECT d.event_type, d.status, count(*) AS row_count
        FROM dirty d JOIN statuses s ON d.event_type = s.event_type
        WHERE d.status IS DISTINCT FROM s.expected_status GROUP BY 1, 2""",
    ),
    "illegal_transitions": with_tables(
        ["steps"],
        f"""SELECT event_id, subscription_id, event_type, previous_status, previous_plan_id
        FROM steps WHERE {ILLEGAL}""",
    ),
    "plan_step_mismatches": with_tables(
        ["steps", "catalog", "statuses"],
        """SELECT * FROM (
            SELECT t.event_id, t.subscription_id, t.event_type, t.previous_plan_id, t.plan_id,
                CASE WHEN moves THEN e.plan_id ELSE t.previous_plan_id END AS expected_plan_id,
                CAST(t.price AS DOUBLE) AS price,
                CAST(CASE WHEN moves THEN e.price ELSE t.previous_price END AS DOUBLE) AS expected_price,
                t.billing_cycle,
                CASE WHEN moves THEN e.billing_cycle ELSE t.previous_billing_cycle END AS expected_billing_cycle,
                t.status, s.expected_status
            FROM (SELECT *, event_type IN ('subscription_upgraded', 'subscription_downgraded') AS moves FROM steps) t
            LEFT JOIN catalog p ON p.plan_id = t.previous_plan_id
            LEFT JOIN catalog e ON p.tier IS NOT NULL AND e.tier = CASE t.event_type
                WHEN 'subscription_upgraded' THEN least(p.tier + 1, 2) ELSE greatest(p.tier - 1, 0) END
            LEFT JOIN statuses s ON s.event_type = t.event_type
            WHERE t.previous_event_id IS NOT NULL)
        WHERE plan_id IS DISTINCT FROM expected_plan_id OR price IS DISTINCT FROM expected_price
            OR billing_cycle IS DISTINCT FROM expected_billing_cycle OR status IS DISTINCT FROM expected_status""",
    ),
    "out_of_order_events": with_tables(
        ["history"],
        """SELECT 'overall' AS scope, count(*) FILTER (event_time < before) AS out_of_order
        FROM (SELECT event_time, max(event_time) OVER (ORDER BY ingested_at, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM history)
        UNION ALL
        SELECT 'within_subscription', count(*) FILTER (event_time < before)
        FROM (SELECT event_time, max(event_time) OVER (PARTITION BY subscription_id
            ORDER BY ingested_at, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM history)""",
    ),
    "jobs_kpi_daily": with_tables(["kpi"], f"SELECT {KPI_SHOWN}, {day('date', 'dt')} FROM kpi"),
    "jobs_replay": with_tables(["kpi"], f"SELECT {KPI_SHOWN}, {day('date', 'dt')} FROM kpi"),
    "jobs_checks": with_tables(
        ["bronze", "stored", "batch", "history"],
        f"""SELECT job, run, layer, dataset, true AS passed, 0 AS violation_count, row_count_in, row_count_out,
            affected_partitions FROM (
        SELECT 'subscription_events_silver' AS job, 0 AS run, 'silver' AS layer,
            'subscription_state_history' AS dataset,
            (SELECT count(*) FROM bronze WHERE ingested_at <= {MARK}) AS row_count_in,
            (SELECT count(*) FROM stored) AS row_count_out,
            (SELECT count(DISTINCT CAST(event_time AS DATE)) FROM bronze WHERE ingested_at <= {MARK})
                AS affected_partitions
        UNION ALL
        SELECT 'subscription_events_silver', 1, 'silver', 'subscription_state_history',
            (SELECT count(*) FROM batch), {IN_REOPENED}, (SELECT count(*) FROM {REOPENED} r)
        UNION ALL
        SELECT 'kpi_daily_gold', 0, 'gold', 'kpi_daily', (SELECT count(*) FROM stored),
            (SELECT count(DISTINCT CAST(event_time AS DATE)) FROM stored),
            (SELECT count(DISTINCT CAST(event_time AS DATE)) FROM stored)
        UNION ALL
        SELECT 'kpi_daily_gold', 1, 'gold', 'kpi_daily', {IN_REOPENED}, {RENEWED}, {RENEWED})""",
    ),
    "jobs_current_state": ALL_CURRENT,
    "stream_history": ALL_HISTORY,
}


def all_oracles():
    return dict(ORACLES)
