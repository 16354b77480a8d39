"""The given tables seen as raw business-review data (see FIXTURES.md).

One SQL text per raw table, valid in Spark SQL and DuckDB alike; `{part}` and the like stand for the given tables. The
projections plant blank and null keys, out-of-range values, negative counts, mixed date layouts and junk dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCES = ("part", "customer", "orders", "lineitem", "events")

RAW_SQL = {
    "business": """
SELECT CASE WHEN p_partkey % 97 = 13 THEN '' WHEN p_partkey % 97 = 29 THEN NULL
            ELSE concat('b', p_partkey) END AS business_id,
       concat('  ', p_name, ' ') AS name, concat(' ', upper(p_brand), ' ') AS city,
       concat(' ', lower(substr(p_type, 1, 2))) AS state,
       CAST((p_partkey * 7) % 211 - 105 AS DOUBLE) AS latitude,
       CAST((p_partkey * 11) % 431 - 215 AS DOUBLE) AS longitude,
       CAST(p_partkey % 13 AS DOUBLE) / 2 AS stars, CAST(p_partkey % 50 - 5 AS INT) AS review_count,
       CASE WHEN p_partkey % 10 = 0 THEN 0 ELSE 1 END AS is_open, concat(p_type, ', ', p_name, ' ') AS categories
FROM {part}""",
    "user": """
SELECT CASE WHEN c_custkey % 89 = 7 THEN '' ELSE concat('u', c_custkey) END AS user_id, concat(' ', c_name) AS name,
       CASE WHEN c_custkey % 71 = 3 THEN 'unknown'
            ELSE CAST(DATE '2010-01-01' + CAST(c_custkey % 4000 AS INT) AS STRING) END AS yelping_since,
       CAST(c_custkey % 40 - 4 AS INT) AS review_count, CAST(c_custkey % 9 - 1 AS INT) AS fans,
       CAST(c_custkey % 12 AS DOUBLE) / 2 AS average_stars, CAST(c_custkey % 8 - 2 AS INT) AS useful,
       CAST(c_custkey % 6 - 1 AS INT) AS funny, CAST(c_custkey % 5 - 1 AS INT) AS cool,
       CASE c_custkey % 5 WHEN 0 THEN 'None' WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN concat('u', c_nationkey)
            ELSE concat('u', c_nationkey, ', u', c_custkey + 1, ', u', c_custkey + 2) END AS friends
FROM {customer}""",
    "review": """
SELECT concat('r', l_orderkey, '-', l_linenumber) AS review_id,
       CASE WHEN l_orderkey % 211 = 0 THEN '' ELSE concat('u', o_custkey) END AS user_id,
       concat('b', l_partkey) AS business_id,
       CASE WHEN (l_orderkey + l_linenumber) % 97 = 0 THEN CAST(9 AS DOUBLE)
            ELSE CAST(1 + CAST(l_quantity AS INT) % 5 AS DOUBLE) END AS stars,
       CAST(l_linenumber - 2 AS INT) AS useful, CAST(l_orderkey % 4 - 1 AS INT) AS funny,
       CAST(l_orderkey % 7 - 1 AS INT) AS cool,
       CASE WHEN l_orderkey % 101 = 1 THEN 'n/a'
            WHEN l_orderkey % 103 = 2 THEN concat('2024-1-', CAST(l_linenumber + 1 AS STRING), ' 9:05:00')
            WHEN l_orderkey % 3 = 0
            THEN CAST(DATE '2023-12-01' + CAST((l_orderkey * 7 + l_linenumber * 3) % 91 AS INT) AS STRING)
            ELSE concat(CAST(DATE '2023-12-01' + CAST((l_orderkey * 7 + l_linenumber * 3) % 91 AS INT) AS STRING),
                        ' 12:30:00') END AS date,
       concat(' ', l_returnflag, l_linestatus, ' ') AS text
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "tip": """
SELECT CASE WHEN event_id % 83 = 5 THEN NULL ELSE concat('u', user_id) END AS user_id,
       concat('b', (event_id * 7) % (SELECT count(*) FROM {part})) AS business_id,
       concat(' ', event_type, ' ') AS text,
       CASE WHEN event_id % 59 = 2 THEN CAST(CAST(ts AS DATE) AS STRING)
            WHEN event_id % 53 = 3 THEN concat('2024-2-', CAST(event_id % 9 + 1 AS STRING), ' 7:05:09')
            ELSE CAST(date_trunc('second', ts) AS STRING) END AS date,
       CAST(CAST(floor(value) AS INT) % 7 - 1 AS INT) AS compliment_count
FROM {events} WHERE coalesce(event_type, '') NOT IN ('view', 'signup')""",
    "checkin": """
SELECT CASE WHEN event_id % 73 = 6 THEN '' ELSE concat('b', (event_id * 3) % (SELECT count(*) FROM {part})) END
           AS business_id,
       CASE WHEN event_id % 67 = 9 THEN 'bad'
            WHEN event_id % 61 = 4 THEN CAST(CAST(ts AS DATE) AS STRING)
            WHEN event_id % 5 = 0 THEN concat(CAST(date_trunc('second', ts) AS STRING), ', ',
                                              CAST(CAST(ts + INTERVAL 1 DAY AS DATE) AS STRING))
            WHEN event_id % 5 = 1 THEN concat(CAST(date_trunc('second', ts) AS STRING), ',,   ',
                                              CAST(date_trunc('second', ts + INTERVAL 2 DAY) AS STRING), ', nope')
            ELSE CAST(date_trunc('second', ts) AS STRING) END AS date
FROM {events} WHERE event_type IN ('view', 'signup')""",
}


def raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The raw table as Spark derives it from the given tables."""
    text = RAW_SQL[table]
    used = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in SOURCES if "{" + n + "}" in text}
    return spark.sql(text, **used)
