"""Views that stand for snapshot data, derived by Spark from the driver's tables; DuckDB's forms stand beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROSTER_SLOT = 21_600  # seconds

SPARK = {
    "roster": """SELECT date_trunc('DAY', ts) + make_dt_interval(0, (hour(ts) div 6) * 6, 0, 0) AS slot, user_id AS entity,
        CASE WHEN max(value) < 0.5 THEN '' WHEN max(value) > 250 THEN concat('P', CAST(user_id div 2 AS STRING), 'x') ELSE concat('P', CAST(user_id div 2 AS STRING)) END AS owner,
        CASE WHEN max(CASE WHEN event_type = 'purchase' THEN value END) > 60 THEN CAST(max(ts) AS DATE) + CAST(user_id % 3 AS INT) END AS end_date
        FROM (SELECT CAST(ts AS TIMESTAMP) ts, user_id, event_type, value FROM {events}) GROUP BY 1, user_id""",
    "points": """SELECT event_type AS source, window(ts, '15 minutes').start AS slot, min(ts) AS observed_at, count(DISTINCT user_id) AS population
        FROM (SELECT CAST(ts AS TIMESTAMP) ts, user_id, event_type FROM {events}) GROUP BY event_type, 2""",
    "stays": """SELECT o_orderkey AS entity, o_orderpriority AS grp, CAST(datediff(last_ship, o_orderdate) AS INT) AS duration, o_orderstatus = 'F' AS event
        FROM {orders} JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM {lineitem} GROUP BY l_orderkey) x ON o_orderkey = l_orderkey WHERE last_ship >= o_orderdate""",
    "details": """SELECT l_orderkey AS entity, CAST(l_shipdate AS TIMESTAMP) AS seen_at, max(l_extendedprice) AS amount, array_sort(collect_set(l_returnflag)) AS amount_types,
        array_sort(collect_set(l_partkey)) AS cases, min(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT)) AS next_date,
        CASE WHEN min(l_linestatus) = 'F' AND max(l_linestatus) = 'F' THEN 'all' WHEN min(l_linestatus) = 'F' THEN 'some' ELSE 'none' END AS status, count(*) AS n_rows
        FROM {lineitem} GROUP BY l_orderkey, l_shipdate""",
    "second": """SELECT CAST(l_orderkey AS STRING) AS entity, CAST(l_partkey AS STRING) AS case_no, CAST(l_shipdate AS DATE) AS book_date, l_returnflag = 'R' AS hold
        FROM {lineitem} WHERE l_suppkey % 10 <> 0""",
    "reports": """SELECT CASE l_suppkey % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'calendar_a' WHEN 2 THEN 'calendar_b' ELSE 'indictments' END AS family,
        year(l_shipdate) AS version, CAST(l_partkey AS STRING) AS case_no, CASE WHEN l_linenumber % 5 = 0 THEN '' ELSE CAST(l_orderkey AS STRING) END AS entity, CAST(l_shipdate AS DATE) AS event_date
        FROM {lineitem}""",
    "visits": """SELECT o_orderkey AS entity, concat('C', CAST(o_custkey AS STRING)) AS owner, CAST(o_orderdate AS DATE) AS start_date,
        CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INT) END AS end_date FROM {orders}""",
    "bookings": """SELECT *, CASE WHEN end_date <= DATE '1998-08-15' THEN 'released' WHEN on_latest THEN 'held' ELSE 'disappeared' END AS outcome FROM (SELECT o_orderkey AS entity,
        CASE WHEN o_orderkey % 89 = 0 THEN CAST(array() AS ARRAY<STRING>) WHEN o_orderkey % 97 = 0 THEN array(concat('C', o_custkey), concat('C', o_custkey + 1)) ELSE array(concat('C', o_custkey)) END AS owners,
        CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN od - 20 ELSE od + CAST(o_orderkey % 11 - 1 AS INT) END AS start_date, first_seen, first_seen + make_dt_interval(CAST(o_orderkey % 200 AS INT), CAST(o_orderkey % 5 AS INT)) AS last_seen,
        CASE WHEN o_orderstatus <> 'O' THEN od + CAST(o_orderkey % 120 - 2 AS INT) WHEN o_orderkey % 31 = 0 THEN DATE '1998-12-31' END AS end_date,
        CASE WHEN o_orderstatus <> 'O' THEN first_seen + make_dt_interval(CAST(o_orderkey % 4 AS INT)) END AS end_listed_at, first_seen < TIMESTAMP '1992-06-01' AS left_truncated, o_orderstatus = 'O' AND o_orderkey % 7 <> 0 AS on_latest
        FROM (SELECT *, CAST(o_orderdate AS DATE) AS od, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + make_dt_interval(CAST(o_orderkey % 9 AS INT), CAST(o_orderkey % 24 AS INT)) AS first_seen FROM {orders}))""",
    "usage": "SELECT event_type AS item, CAST(ts AS DATE) AS day, sum(value) AS amount FROM {events} GROUP BY event_type, 2",
}

DUCK = {
    "roster": """SELECT date_trunc('day', ts) + (hour(ts) // 6) * INTERVAL 6 HOUR AS slot, user_id AS entity,
        CASE WHEN max(value) < 0.5 THEN '' WHEN max(value) > 250 THEN concat('P', CAST(user_id // 2 AS VARCHAR), 'x') ELSE concat('P', CAST(user_id // 2 AS VARCHAR)) END AS owner,
        CASE WHEN max(CASE WHEN event_type = 'purchase' THEN value END) > 60 THEN CAST(max(ts) AS DATE) + CAST(user_id % 3 AS INT) END AS end_date
        FROM events GROUP BY 1, user_id""",
    "points": """SELECT event_type AS source, time_bucket(INTERVAL 15 MINUTE, ts) AS slot, min(ts) AS observed_at, count(DISTINCT user_id) AS population FROM events GROUP BY event_type, 2""",
    "stays": """SELECT o_orderkey AS entity, o_orderpriority AS grp, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(last_ship AS DATE)) AS INT) AS duration, o_orderstatus = 'F' AS event
        FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) x ON o_orderkey = l_orderkey WHERE last_ship >= o_orderdate""",
    "details": """SELECT l_orderkey AS entity, CAST(l_shipdate AS TIMESTAMP) AS seen_at, max(l_extendedprice) AS amount, list_sort(list(DISTINCT l_returnflag)) AS amount_types,
        list_sort(list(DISTINCT l_partkey)) AS cases, min(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT)) AS next_date,
        CASE WHEN min(l_linestatus) = 'F' AND max(l_linestatus) = 'F' THEN 'all' WHEN min(l_linestatus) = 'F' THEN 'some' ELSE 'none' END AS status, count(*) AS n_rows
        FROM lineitem GROUP BY l_orderkey, l_shipdate""",
    "second": """SELECT CAST(l_orderkey AS VARCHAR) AS entity, CAST(l_partkey AS VARCHAR) AS case_no, CAST(l_shipdate AS DATE) AS book_date, l_returnflag = 'R' AS hold
        FROM lineitem WHERE l_suppkey % 10 <> 0""",
    "reports": """SELECT CASE l_suppkey % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'calendar_a' WHEN 2 THEN 'calendar_b' ELSE 'indictments' END AS family,
        year(l_shipdate) AS version, CAST(l_partkey AS VARCHAR) AS case_no, CASE WHEN l_linenumber % 5 = 0 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END AS entity, CAST(l_shipdate AS DATE) AS event_date
        FROM lineitem""",
    "visits": """SELECT o_orderkey AS entity, concat('C', CAST(o_custkey AS VARCHAR)) AS owner, CAST(o_orderdate AS DATE) AS start_date,
        CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INT) END AS end_date FROM orders""",
    "bookings": """SELECT *, CASE WHEN end_date <= DATE '1998-08-15' THEN 'released' WHEN on_latest THEN 'held' ELSE 'disappeared' END AS outcome FROM (SELECT o_orderkey AS entity,
        CASE WHEN o_orderkey % 89 = 0 THEN CAST([] AS VARCHAR[]) WHEN o_orderkey % 97 = 0 THEN ['C' || o_custkey, 'C' || (o_custkey + 1)] ELSE ['C' || o_custkey] END AS owners,
        CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN od - 20 ELSE od + CAST(o_orderkey % 11 - 1 AS INT) END AS start_date, first_seen, first_seen + (o_orderkey % 200) * INTERVAL 1 DAY + (o_orderkey % 5) * INTERVAL 1 HOUR AS last_seen,
        CASE WHEN o_orderstatus <> 'O' THEN od + CAST(o_orderkey % 120 - 2 AS INT) WHEN o_orderkey % 31 = 0 THEN DATE '1998-12-31' END AS end_date,
        CASE WHEN o_orderstatus <> 'O' THEN first_seen + (o_orderkey % 4) * INTERVAL 1 DAY END AS end_listed_at, first_seen < TIMESTAMP '1992-06-01' AS left_truncated, o_orderstatus = 'O' AND o_orderkey % 7 <> 0 AS on_latest
        FROM (SELECT *, CAST(o_orderdate AS DATE) AS od, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + (o_orderkey % 9) * INTERVAL 1 DAY + (o_orderkey % 24) * INTERVAL 1 HOUR AS first_seen FROM orders))""",
    "usage": "SELECT event_type AS item, CAST(ts AS DATE) AS day, sum(value) AS amount FROM events GROUP BY event_type, 2",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, **tables: DataFrame) -> DataFrame:
    """One of the derived views as a DataFrame; tables are taken instead of those that would be read."""
    used = {t: tables[t] if t in tables else table(spark, sf_dir, t) for t in ("events", "orders", "lineitem") if "{" + t + "}" in SPARK[name]}
    return spark.sql(SPARK[name], **used)


def duck(names: str, body: str, recursive: bool = False) -> str:
    """DuckDB SQL: the named views as common tables before a body (which may go on with `, more AS (...)`)."""
    ctes = ", ".join(f"{n} AS ({DUCK[n]})" for n in names.split())
    return f"WITH {'RECURSIVE ' * recursive}{ctes} {body}"
