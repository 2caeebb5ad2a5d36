"""Plain SQL for the registered queries, written for DuckDB over the same tables.

Each statement states the result on its own terms (windows, correlated means,
ranking), not by repeating the Spark plan.
"""

from __future__ import annotations

import math

from riskmart.specs import SPECS, TableSpec

# Stated here once more, so that a wrong value in the library shows: the modulus of the draws and the rates per table,
# as nulls, copies, bad dates and outliers.
MODULUS = 2**31 - 1
RATES = {
    "activity": (0.05, 0.05, 0.05, 0),
    "clients": (0.07, 0.04, 0, 0),
    "logins": (0.05, 0.05, 0.05, 0),
    "payments": (0.05, 0.05, 0.05, 0),
    "transactions": (0.04, 0.05, 0.05, 0.01),
}

BOUNDS = {
    "activity": ("2024-01-01", "2024-01-25"),
    "logins": ("2024-01-01", "2024-01-25"),
    "payments": ("1996-01-01", "2000-12-01"),
    "transactions": ("1996-01-01", "2000-12-01"),
}

TYPED = {
    "clients": """
        SELECT c_custkey AS client_id, c_name AS client_first_name, c_mktsegment AS client_last_name,
               'c' || c_custkey || '@example.com' AS client_email, '+1-' || c_custkey AS client_phone,
               'nation ' || c_nationkey AS client_address,
               DATE '1910-01-01' + CAST(c_custkey * 37 % 40000 AS INTEGER) AS client_birthday
        FROM customer""",
    "transactions": """
        SELECT o_custkey AS client_id, o_orderkey AS transaction_id, o_orderdate AS transaction_date,
               o_orderstatus AS transaction_type, o_orderpriority AS account_number,
               CASE WHEN o_orderkey % 2 = 0 THEN 'USD' ELSE 'RUB' END AS currency,
               CAST(o_totalprice AS DECIMAL(15,2)) AS amount
        FROM orders""",
    "payments": """
        SELECT l_suppkey AS client_id, l_orderkey AS payment_id, l_shipdate AS payment_date,
               CASE WHEN l_orderkey % 2 = 0 THEN 'USD' ELSE 'RUB' END AS currency,
               CAST(l_extendedprice AS DECIMAL(15,2)) AS amount, l_returnflag AS payment_method
        FROM lineitem""",
    "logins": """
        SELECT user_id AS client_id, ts AS login_date, CAST(event_id AS VARCHAR) AS ip_address,
               CAST(CAST(value AS DECIMAL(15,2)) AS VARCHAR) AS location, props AS device
        FROM events""",
    "activity": """
        SELECT user_id AS client_id, ts AS activity_date, event_type AS activity_type,
               props AS activity_location, CAST(event_id AS VARCHAR) AS ip_address, props AS device
        FROM events""",
}

ROW_ID = {
    "activity": "CAST(ip_address AS BIGINT)",
    "clients": "client_id",
    "logins": "CAST(ip_address AS BIGINT)",
    "payments": "((payment_id * 1000003 + client_id) % 2147483647 * 1000003 + CAST(amount * 100 AS BIGINT))",
    "transactions": "transaction_id",
}


def draw(row_id: str, seed: int) -> str:
    multiplier, offset = (48271 * (seed + 1)) % (2**31 - 2) + 1, ((seed + 1) * 69621 + 12345) % MODULUS
    base = f"((({row_id}) % {MODULUS} + {MODULUS}) % {MODULUS})"
    first = f"(({base} * {multiplier} + {offset}) % {MODULUS})"
    second = f"(({first} * {first} + {base}) % {MODULUS})"
    return f"(({second} * {second} + {offset}) % {MODULUS})"


def hit(row_id: str, seed: int, rate: float) -> str:
    return f"({draw(row_id, seed)} < {math.floor(rate * MODULUS)})"


def rendered(source: str, spec: TableSpec, extra: str = "") -> str:
    """The typed columns as the registered queries show them."""
    kinds = {"amount": "DOUBLE", "timestamp": "VARCHAR", "date": "VARCHAR"}
    columns = ", ".join(
        f"CAST({n} AS {kinds[k]}) AS {n}" if k in kinds else n for n, k in spec.fields
    )
    return f"SELECT {columns}{extra} FROM ({source})"


def as_text(source: str, spec: TableSpec, floats: bool = False) -> str:
    columns = ", ".join(
        f"CAST({n} AS VARCHAR)" + (" || '.0'" if floats and k == "id" else "") + f" AS {n}"
        for n, k in spec.fields
    )
    return f"SELECT {columns} FROM ({source})"


def messages(source: str, spec: TableSpec, floats: bool = False) -> str:
    fields = ", ".join(f"'{n}', {n}" for n in spec.columns)
    text = as_text(source, spec, floats)
    return f"SELECT client_id AS key, CAST(json_object({fields}) AS VARCHAR) AS value FROM ({text})"


def at_seconds(source: str, spec: TableSpec) -> str:
    """Timestamps cut to whole seconds, as the typed layer holds them."""
    columns = ", ".join(
        f"date_trunc('second', {n}) AS {n}" if k == "timestamp" else n for n, k in spec.fields
    )
    return f"SELECT {columns} FROM ({source})"


def complete(source: str, spec: TableSpec) -> str:
    rule = " AND ".join(f"{n} IS NOT NULL" for n in spec.columns)
    return f"SELECT * FROM ({source}) WHERE {rule}"


def cleaned(source: str, spec: TableSpec) -> str:
    if not spec.has_event_time:
        rule = "client_birthday BETWEEN DATE '1920-01-01' AND DATE '2010-01-01'"
    else:
        low, high = BOUNDS[spec.name]
        rule = f"{spec.date_column} >= TIMESTAMP '{low}' AND {spec.date_column} < TIMESTAMP '{high}'"
    if spec.require_client:
        rule += " AND client_id IS NOT NULL"
    return f"SELECT * FROM ({source}) WHERE {rule}"


# Defects


def with_nulls(source: str, spec: TableSpec, row_id: str) -> str:
    columns = ", ".join(
        f"CASE WHEN {hit(row_id, i, RATES[spec.name][0])} THEN NULL ELSE {n} END AS {n}"
        for i, n in enumerate(spec.columns)
    )
    return f"SELECT {columns}, {row_id} AS row_id FROM ({source})"


def bad_date(row_id: str, seed: int) -> str:
    year = f"[1700, 1800, 2100, 2200][{draw(row_id, seed + 1)} % 4 + 1]"
    month, day = f"{draw(row_id, seed + 2)} % 12 + 1", f"{draw(row_id, seed + 3)} % 28 + 1"
    return f"make_timestamp({year}, {month}, {day}, 0, 0, 0)"


def with_bad_dates(source: str, column: str, row_id: str) -> str:
    kept = f"CASE WHEN {hit(row_id, 100, 0.05)} THEN {bad_date(row_id, 100)} ELSE {column} END"
    return f"SELECT * REPLACE ({kept} AS {column}) FROM ({source})"


def at_least(rate: float) -> list[int]:
    """Draws below the k-th value occur k times or more, if the number of copies follows a Poisson law."""
    most = 1
    while rate**most / math.factorial(most) * MODULUS >= 1e-6:
        most += 1
    chances = [math.exp(-rate) * rate**k / math.factorial(k) for k in range(most)]
    limits = [math.floor((1 - math.fsum(chances[: k + 1])) * MODULUS) for k in range(most)]
    return [limit for limit in limits if limit > 0]


def with_copies(source: str, rate: float, row_id: str) -> str:
    times = " + ".join(f"CAST(draw < {t} AS INTEGER)" for t in at_least(rate))
    drawn = f"SELECT *, {draw(row_id, 200)} AS draw FROM ({source})"
    counted = f"""
        SELECT * EXCLUDE (draw), unnest(range(1 + GREATEST({times},
               CAST(draw = MIN(draw) OVER () AS INTEGER)))) AS copy_nr FROM ({drawn})"""
    return f"SELECT * EXCLUDE (copy_nr) FROM ({counted})"


def with_outliers(source: str, row_id: str) -> str:
    kept = f"CASE WHEN {hit(row_id, 300, 0.01)} THEN CAST(amount * 10 AS DECIMAL(15,2)) ELSE amount END"
    return f"SELECT * REPLACE ({kept} AS amount) FROM ({source})"


def dirty(name: str) -> str:
    spec = SPECS[name]
    rows = TYPED[name]
    _, copies, bad_dates, outliers = RATES[name]
    if outliers:
        rows = with_outliers(rows, ROW_ID[name])
    rows = with_nulls(rows, spec, ROW_ID[name])
    if bad_dates:
        rows = with_bad_dates(rows, spec.date_column, "row_id")
    rows = with_copies(rows, copies, "row_id")
    return f"SELECT * EXCLUDE (row_id) FROM ({rows})"


def holey(name: str) -> str:
    nulls = with_nulls(TYPED[name], SPECS[name], ROW_ID[name])
    return complete(f"SELECT * EXCLUDE (row_id) FROM ({nulls})", SPECS[name])


def bursts(rows: str) -> str:
    """Four drawn clients, two instants each, ten rows per instant."""
    instant_id, row_id = "(client_id * 3 + instant)", "((client_id * 3 + instant) * 11 + nr)"
    seconds = 1827 * 86_400
    return f"""
        {rows}
        UNION ALL
        SELECT client_id, {draw(row_id, 402)} % 9000 + 1000,
               TIMESTAMP '1996-01-01' + to_seconds({draw(instant_id, 401)} % {seconds}),
               ['deposit', 'withdrawal', 'transfer'][{draw(row_id, 403)} % 3 + 1],
               'ACC' || {draw(row_id, 405)},
               ['USD', 'RUB'][{draw(row_id, 406)} % 2 + 1],
               CAST(({draw(row_id, 404)} % 990001 + 10000) / 100.0 AS DECIMAL(15,2))
        FROM (SELECT c_custkey AS client_id FROM customer
              ORDER BY {draw("c_custkey", 400)}, c_custkey LIMIT 4),
             range(1, 3) AS i(instant), range(1, 11) AS r(nr)"""


# Profiles and mart


def profile(tx: str) -> str:
    """Means as exact integer arithmetic in cents; the suspicious test row by row."""
    rounded = "CAST((2 * CAST(s * 100 AS HUGEINT) + k) // (2 * k) AS DOUBLE) / 100.0"
    return f"""
        SELECT client_id, COUNT(*) AS total_transactions,
               MIN(CASE WHEN k > 0 THEN {rounded} END) AS avg_transaction_amount,
               MAX(amount) AS max_transaction_amount,
               COUNT(CASE WHEN client_id IS NOT NULL AND amount * k > 3 * s THEN 1 END)
                   AS suspicious_transaction_count,
               MAX(amount) * MAX(k) > 3 * MAX(s) AS financial_risk
        FROM (SELECT client_id, CAST(amount AS DECIMAL(25,2)) AS amount,
                     COUNT(amount) OVER (PARTITION BY client_id) AS k,
                     SUM(CAST(amount AS DECIMAL(25,2))) OVER (PARTITION BY client_id) AS s
              FROM ({tx}))
        GROUP BY client_id"""


def mart(clients: str, tx: str, logins: str) -> str:
    """Each risk that holds has its points; the score is the most points of any."""
    return f"""
        WITH spending AS ({profile(tx)}),
             visits AS (SELECT client_id, COUNT(*) AS login_count FROM ({logins}) GROUP BY client_id),
             rated AS (
                 SELECT people.client_id, client_first_name AS first_name, client_last_name AS last_name,
                        spending.* EXCLUDE (client_id), login_count, login_count > 10 AS activity_risk
                 FROM ({clients}) people
                 LEFT JOIN visits ON visits.client_id = people.client_id
                 LEFT JOIN spending ON spending.client_id = people.client_id)
        SELECT * REPLACE (CAST(max_transaction_amount AS DOUBLE) AS max_transaction_amount),
               GREATEST(3 * COALESCE(CAST(financial_risk AS INTEGER), 0),
                        2 * COALESCE(CAST(activity_risk AS INTEGER), 0)) AS risk_score
        FROM rated"""


def served(source: str) -> str:
    """NULLs of the mart become 0 in the serving store."""
    numbers = ("total_transactions", "avg_transaction_amount", "max_transaction_amount",
               "suspicious_transaction_count", "login_count")
    filled = ", ".join(f"COALESCE({n}, 0) AS {n}" for n in numbers)
    flags = ", ".join(f"COALESCE(CAST({n} AS TINYINT), 0) AS {n}" for n in ("financial_risk", "activity_risk"))
    return f"SELECT client_id, first_name, last_name, {filled}, {flags}, risk_score FROM ({source})"


MART_ALL = mart(TYPED["clients"], TYPED["transactions"], TYPED["logins"])
MART_CLEAN = mart(*(cleaned(TYPED[n], SPECS[n]) for n in ("clients", "transactions", "logins")))


def daily(name: str) -> str:
    """Clean rows of a table after its dirty messages passed ingest and staging."""
    spec = SPECS[name]
    staged = at_seconds(complete(dirty(name), spec), spec)
    if spec.unique_key:
        staged = f"SELECT DISTINCT * FROM ({staged})"
    return cleaned(staged, spec)


def staged(name: str) -> str:
    spec = SPECS[name]
    rows = at_seconds(TYPED[name], spec)
    if spec.unique_key:
        both = f"""
            SELECT * FROM ({rows}) UNION ALL
            SELECT * REPLACE ('+0-' || client_phone AS client_phone) FROM ({rows})"""
        order = ", ".join(f"{n} NULLS FIRST" for n in spec.columns)
        rows = f"""
            SELECT * FROM ({both})
            QUALIFY ROW_NUMBER() OVER (PARTITION BY client_id ORDER BY {order}) = 1"""
    return rendered(rows, spec)


def malformed() -> str:
    """Text that is no id, month or day becomes NULL; a third fraction digit is rounded half up."""
    key = "transaction_id"
    return f"""
        SELECT * REPLACE (
            CASE WHEN {key} % 7 <> 0 THEN client_id END AS client_id,
            CASE {key} % 11 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE transaction_date END AS transaction_date,
            CASE {key} % 5 WHEN 0 THEN amount + CAST(0.01 AS DECIMAL(15,2)) WHEN 1 THEN NULL ELSE amount END AS amount)
        FROM ({TYPED["transactions"]})"""


def narrow(source: str, *columns: str) -> str:
    casts = ", ".join(f"CAST({n} AS INTEGER) AS {n}" for n in columns)
    return f"SELECT * REPLACE ({casts}) FROM ({source})"


def parsed() -> str:
    spec = SPECS["activity"]
    broken = hit(ROW_ID["activity"], 600, 0.2)
    text = as_text(f"SELECT *, {broken} AS broken FROM ({TYPED['activity']})", spec)
    text = text.replace("SELECT ", "SELECT broken, ", 1)
    columns = ", ".join(f"CASE WHEN NOT broken THEN {n} END AS {n}" for n in spec.columns)
    return f"SELECT {columns} FROM ({text})"


def audited() -> str:
    """Activity messages with the reason why they do not land; key and value as sent."""
    spec = SPECS["activity"]
    nulls = f"SELECT * EXCLUDE (row_id) FROM ({with_nulls(TYPED['activity'], spec, ROW_ID['activity'])})"
    text = as_text(nulls, spec)
    odd = f"SELECT * REPLACE (CASE WHEN activity_type = 'error' THEN 'c' || client_id ELSE client_id END AS client_id) FROM ({text})"
    fields = ", ".join(f"'{n}', {n}" for n in spec.columns)
    absent = ", ".join(f"CASE WHEN {n} IS NULL THEN '{n}' END" for n in spec.columns)
    return f"""
        SELECT message_key,
               CASE WHEN cut THEN left(body, 25) ELSE body END AS message_value,
               CASE WHEN cut THEN 'unparsable' WHEN absent <> '' THEN 'missing ' || absent
                    WHEN message_key LIKE 'c%' THEN 'malformed client_id' ELSE '' END AS reject_reason
        FROM (SELECT client_id AS message_key, COALESCE(length(client_id) = 1, false) AS cut,
                     CAST(json_object({fields}) AS VARCHAR) AS body, concat_ws(',', {absent}) AS absent
              FROM ({odd}))"""


def landed_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, CAST(client_id AS VARCHAR) AS client_id, COUNT(*) AS landed_rows "
        f"FROM ({holey(n)}) GROUP BY ALL"
        for n in SPECS
    )


def landed_metrics() -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, (SELECT COUNT(*) FROM ({TYPED[n]})) AS messages_read, "
        f"(SELECT COUNT(*) FROM ({holey(n)})) AS rows_landed"
        for n in SPECS
    )


TX, ACTIVITY, CLIENTS, LOGINS = (SPECS[n] for n in ("transactions", "activity", "clients", "logins"))
IN_RANGE = "payment_date >= TIMESTAMP '1997-03-10' AND payment_date < TIMESTAMP '1997-06-05'"

ORACLES: dict[str, str] = {
    "fraud_dashboard": MART_CLEAN,
    "fraud_dashboard_unfiltered": MART_ALL,
    "colocated_mart": MART_ALL,
    "tx_profile": f"""
        SELECT * REPLACE (CAST(max_transaction_amount AS DOUBLE) AS max_transaction_amount)
        FROM ({profile(TYPED["transactions"])})""",
    "login_profile": f"SELECT client_id, COUNT(*) AS login_count FROM ({TYPED['logins']}) GROUP BY client_id",
    **{
        name: f"SELECT client_id, suspicious_transaction_count FROM ({profile(TYPED['transactions'])})"
        for name in ("suspicious_count", "suspicious_count_join")
    },
    "risk_flags": f"SELECT client_id, financial_risk, activity_risk FROM ({MART_ALL})",
    "risk_score": f"SELECT client_id, risk_score FROM ({MART_ALL})",
    **{f"stage_{n}": staged(n) for n in SPECS},
    **{f"clean_{n}": rendered(cleaned(TYPED[n], s), s) for n, s in SPECS.items()},
    "to_messages": messages(TYPED["transactions"], TX, floats=True),
    "message_log": messages(TYPED["logins"], LOGINS),
    "parse_json": parsed(),
    "drop_incomplete": as_text(holey("transactions"), TX),
    **{f"ingest_{n}": as_text(holey(n), s) for n, s in SPECS.items()},
    "ingest_incremental": as_text(TYPED["activity"], ACTIVITY),
    "ingest_all": landed_counts(),
    "ingest_metrics": landed_metrics(),
    "ingest_rejects": f"SELECT reject_reason, COUNT(*) AS messages FROM ({audited()}) GROUP BY 1",
    "rejected_messages": f"SELECT reject_reason, message_key, message_value FROM ({audited()}) WHERE reject_reason <> ''",
    "arrival_lake": f"""
        SELECT strftime(activity_date, '%Y-%m-%d') AS arrival, COUNT(*) AS landed_rows,
               CAST(SUM(CAST(ip_address AS BIGINT)) AS BIGINT) AS id_sum
        FROM ({holey("activity")}) GROUP BY 1""",
    "raw_scan": as_text(holey("payments"), SPECS["payments"]),
    "refresh_table": rendered(TYPED["transactions"], TX),
    "month_partitions": rendered(
        cleaned(TYPED["transactions"], TX), TX, ", strftime(transaction_date, '%Y-%m') AS ym"
    ),
    "date_range": rendered(
        f"SELECT * FROM ({cleaned(TYPED['payments'], SPECS['payments'])}) WHERE {IN_RANGE}",
        SPECS["payments"],
        ", strftime(payment_date, '%Y-%m') AS ym",
    ),
    "publish_mart": served(MART_ALL),
    "publish_mart_int32": narrow(
        served(MART_ALL), "client_id", "total_transactions", "suspicious_transaction_count", "login_count"
    ),
    "publish_empty": served(MART_ALL),
    "serving_order": """
        SELECT COUNT(*) AS rows_served, CAST(0 AS BIGINT) AS rows_out_of_order, CAST(0 AS BIGINT) AS files_overlapping
        FROM customer""",
    "stage_int32": narrow(staged("transactions"), "client_id", "transaction_id"),
    "stage_malformed": rendered(at_seconds(malformed(), TX), TX),
    "rebuild_table": MART_ALL,
    "bucketed_table": rendered(TYPED["clients"], CLIENTS),
    "layer_statistics": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM ({cleaned(TYPED[n], s)})" for n, s in SPECS.items()
    ),
    "versioned_mart": f"""
        SELECT *, 'after_failure' AS seen FROM ({served(MART_ALL)}) WHERE risk_score = 0
        UNION ALL SELECT *, 'after_success' AS seen FROM ({served(MART_ALL)})""",
    "incremental_layers": rendered(
        cleaned(at_seconds(TYPED["transactions"], TX), TX), TX, ", strftime(transaction_date, '%Y-%m') AS ym"
    ),
    "inject_nulls": rendered(with_nulls(TYPED["clients"], CLIENTS, "client_id"), CLIENTS),
    "inject_bad_dates": rendered(
        with_bad_dates(TYPED["activity"], "activity_date", ROW_ID["activity"]), ACTIVITY
    ),
    "inject_duplicates": rendered(with_copies(TYPED["transactions"], 0.05, "transaction_id"), TX),
    "inject_outliers": rendered(with_outliers(TYPED["transactions"], "transaction_id"), TX),
    "inject_bursts": rendered(bursts(TYPED["transactions"]), TX),
    "inject_defects": rendered(dirty("transactions"), TX),
    "defects_cleaned": rendered(cleaned(dirty("transactions"), TX), TX),
    "shuffle_rows": rendered(TYPED["logins"], LOGINS),
    "daily_run": served(mart(*(daily(n) for n in ("clients", "transactions", "logins")))),
}
