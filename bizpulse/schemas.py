"""Table layouts of the raw, silver and gold layers."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw table layouts (dates arrive as strings).
RAW_DDL = {
    "business": (
        "business_id STRING NOT NULL, name STRING, city STRING, state STRING, latitude DOUBLE, longitude DOUBLE, "
        "stars DOUBLE, review_count INT, is_open INT, categories STRING"
    ),
    "user": (
        "user_id STRING NOT NULL, name STRING, yelping_since STRING, review_count INT, fans INT, "
        "average_stars DOUBLE, useful INT, funny INT, cool INT, friends STRING"
    ),
    "review": (
        "review_id STRING NOT NULL, user_id STRING, business_id STRING, stars DOUBLE, useful INT, funny INT, "
        "cool INT, date STRING, text STRING"
    ),
    "checkin": "business_id STRING NOT NULL, date STRING",
    "tip": "user_id STRING, business_id STRING, text STRING, date STRING, compliment_count INT",
}

# Granularity codes of the gold tables.
DAILY = 0
MONTHLY = 2

# Measure codes of the narrow fact table.
REVIEW_COUNT = 1
TIP_COUNT = 2
COMPLIMENT_COUNT_SUM = 3
AVG_STARS = 4
TOTAL_USEFUL = 5
TOTAL_FUNNY = 6
TOTAL_COOL = 7
DISTINCT_USERS_REVIEW = 8
DISTINCT_USERS_TIP = 9

# The measure reference table (measure_id, name, description, unit, category).
MEASURE_CODES = [
    (1, "review_count", "Distinct reviews received", "count", "Review Metrics"),
    (2, "tip_count", "Tips received", "count", "Tip Metrics"),
    (3, "compliment_count_sum", "Sum of compliments on tips", "count", "Tip Metrics"),
    (4, "avg_stars", "Average review stars", "stars (1-5)", "Review Metrics"),
    (5, "total_useful", "Sum of useful votes", "count", "Review Metrics"),
    (6, "total_funny", "Sum of funny votes", "count", "Review Metrics"),
    (7, "total_cool", "Sum of cool votes", "count", "Review Metrics"),
    (8, "distinct_users_review", "Distinct users who reviewed", "count", "Review Metrics"),
    (9, "distinct_users_tip", "Distinct users who left a tip", "count", "Tip Metrics"),
]
MEASURE_CODES_DDL = (
    "measure_id INT, measure_name STRING, measure_description STRING, measure_unit STRING, measure_category STRING"
)

RAW_TABLES = tuple(RAW_DDL)
# Tables whose rows are dated events; the others are whole-table snapshots.
EVENT_TABLES = ("review", "tip")

FACT_KEY = ("business_id", "day", "granularity", "measure")
POPULARITY_KEY = ("business_id", "day", "granularity")
GOLD_PARTITIONS = ("day", "granularity")

FACT_COLUMNS = ("day", "period_month", "granularity", "business_id", "measure", "units")
POPULARITY_COLUMNS = (
    "day", "period_month", "granularity", "business_id", "name", "city", "state", "categories",
    "popularity_score", "city_rank",
)


def raw_schema(table: str) -> T.StructType:
    """Schema of a raw table, looked up without regard to case."""
    ddl = RAW_DDL.get(table.strip().lower())
    if ddl is None:
        raise ValueError(f"unknown raw table {table!r}; known: {', '.join(RAW_TABLES)}")
    return T.StructType.fromDDL(ddl)
