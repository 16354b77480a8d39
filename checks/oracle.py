"""DuckDB SQL for every query in `checks.catalog`, built from shared common table expressions."""

from __future__ import annotations

import re

from checks.projections import RAW_SQL, SOURCES

MONTH_ENDS = "(DATE '2023-12-31', DATE '2024-01-31', DATE '2024-02-29')"

CTE: dict[str, str] = {
    f"raw_{table}": text.format(**{n: n for n in SOURCES}).strip() for table, text in RAW_SQL.items()
}

CTE["silver_business"] = """
SELECT business_id, trim(name) AS name, upper(left(trim(city), 1)) || lower(substr(trim(city), 2)) AS city,
       upper(trim(state)) AS state,
       CASE WHEN latitude BETWEEN -90 AND 90 THEN latitude END AS latitude,
       CASE WHEN longitude BETWEEN -180 AND 180 THEN longitude END AS longitude,
       CAST(trunc(CASE WHEN stars BETWEEN 1 AND 5 THEN stars END) AS INTEGER) AS stars,
       CASE WHEN review_count < 0 THEN 0 ELSE review_count END AS review_count,
       CAST(is_open AS BOOLEAN) AS is_open, trim(categories) AS categories
FROM raw_business WHERE business_id <> ''"""
CTE["silver_user"] = """
SELECT user_id, trim(name) AS name, CAST(try_strptime(regexp_extract(yelping_since, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}'), '%Y-%m-%d') AS DATE) AS yelping_since,
       CASE WHEN review_count < 0 THEN 0 ELSE review_count END AS review_count,
       CASE WHEN fans < 0 THEN 0 ELSE fans END AS fans,
       CASE WHEN average_stars BETWEEN 1 AND 5 THEN average_stars END AS average_stars,
       CASE WHEN useful < 0 THEN 0 ELSE useful END AS useful, CASE WHEN funny < 0 THEN 0 ELSE funny END AS funny,
       CASE WHEN cool < 0 THEN 0 ELSE cool END AS cool,
       CAST(CASE WHEN friends IS NULL OR friends IN ('', 'None') THEN 0
                 ELSE len(string_split(friends, ',')) END AS INTEGER) AS friend_count
FROM raw_user WHERE user_id <> ''"""
CTE["silver_review"] = """
SELECT review_id, user_id, business_id,
       CAST(trunc(CASE WHEN stars BETWEEN 1 AND 5 THEN stars END) AS INTEGER) AS stars,
       CASE WHEN useful < 0 THEN 0 ELSE useful END AS useful, CASE WHEN funny < 0 THEN 0 ELSE funny END AS funny,
       CASE WHEN cool < 0 THEN 0 ELSE cool END AS cool,
       CAST(try_strptime(regexp_extract(date, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}'), '%Y-%m-%d') AS DATE) AS date, trim(text) AS text
FROM raw_review WHERE review_id <> '' AND user_id <> '' AND business_id <> ''"""
CTE["silver_checkin"] = r"""
SELECT business_id, checkin_date
FROM (SELECT business_id,
             try_strptime(left(CASE WHEN contains(one, ' ') THEN one ELSE one || ' 00:00:00' END, 19),
                          '%Y-%m-%d %H:%M:%S') AS checkin_date
      FROM (SELECT business_id, unnest(regexp_split_to_array(date, ',\s*')) AS one
            FROM raw_checkin WHERE business_id <> '')
      WHERE one <> '')
WHERE checkin_date IS NOT NULL"""
CTE["silver_tip"] = """
SELECT user_id, business_id, trim(text) AS text, try_strptime(regexp_extract(date, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}'), '%Y-%m-%d %H:%M:%S') AS date,
       CASE WHEN compliment_count < 0 THEN 0 ELSE compliment_count END AS compliment_count
FROM raw_tip WHERE user_id <> '' AND business_id <> ''"""

CTE["review_periods"] = f"""
SELECT *, date AS day, 0 AS granularity FROM silver_review WHERE date IS NOT NULL
UNION ALL
SELECT *, last_day(date), 2 FROM silver_review WHERE last_day(date) IN {MONTH_ENDS}"""
CTE["tip_periods"] = f"""
SELECT *, CAST(date AS DATE) AS day, 0 AS granularity FROM silver_tip WHERE date IS NOT NULL
UNION ALL
SELECT *, last_day(date), 2 FROM silver_tip WHERE last_day(date) IN {MONTH_ENDS}"""
CTE["review_wide"] = """
SELECT business_id, day, granularity, CAST(count(DISTINCT review_id) AS DOUBLE) AS review_count,
       avg(stars) AS avg_stars, CAST(sum(useful) AS DOUBLE) AS total_useful,
       CAST(sum(funny) AS DOUBLE) AS total_funny, CAST(sum(cool) AS DOUBLE) AS total_cool,
       CAST(count(DISTINCT user_id) AS DOUBLE) AS distinct_users_review
FROM review_periods GROUP BY ALL"""
CTE["tip_wide"] = """
SELECT business_id, day, granularity, CAST(count(*) AS DOUBLE) AS tip_count,
       CAST(sum(coalesce(compliment_count, 0)) AS DOUBLE) AS compliment_count_sum,
       CAST(count(DISTINCT user_id) AS DOUBLE) AS distinct_users_tip
FROM tip_periods GROUP BY ALL"""
_NARROW = [("review_wide", 1, "review_count"), ("review_wide", 4, "avg_stars"), ("review_wide", 5, "total_useful"),
           ("review_wide", 6, "total_funny"), ("review_wide", 7, "total_cool"),
           ("review_wide", 8, "distinct_users_review"), ("tip_wide", 2, "tip_count"),
           ("tip_wide", 3, "compliment_count_sum"), ("tip_wide", 9, "distinct_users_tip")]
CTE["fact"] = "\nUNION ALL\n".join(
    f"SELECT day, strftime(day, '%Y-%m') AS period_month, granularity, business_id, CAST({code} AS INTEGER) AS measure, "
    f"{column} AS units FROM {table}"
    for table, code, column in _NARROW
)

CTE["inputs"] = f"""
SELECT b.business_id, b.day, b.name, b.city, b.state, b.categories,
       coalesce(r.review_count, 0) AS review_count, coalesce(r.avg_review_stars, 0) AS avg_review_stars,
       r.last_review_date, r.first_review_date, coalesce(c.checkin_count, 0) AS checkin_count,
       coalesce(t.tip_compliment_count, 0) AS tip_compliment_count
FROM (SELECT s.*, m.day FROM silver_business s, (SELECT unnest([{MONTH_ENDS[1:-1]}]) AS day) m WHERE is_open) b
LEFT JOIN (SELECT business_id, last_day(date) AS day, count(*) AS review_count, avg(stars) AS avg_review_stars,
                  max(date) AS last_review_date, min(date) AS first_review_date
           FROM silver_review GROUP BY ALL) r USING (business_id, day)
LEFT JOIN (SELECT business_id, last_day(checkin_date) AS day, count(*) AS checkin_count
           FROM silver_checkin GROUP BY ALL) c USING (business_id, day)
LEFT JOIN (SELECT business_id, last_day(date) AS day, CAST(sum(compliment_count) AS BIGINT) AS tip_compliment_count
           FROM silver_tip GROUP BY ALL) t USING (business_id, day)"""


def _scaled(column: str) -> str:
    low, high = f"CAST(min({column}) OVER m AS DOUBLE)", f"CAST(max({column}) OVER m AS DOUBLE)"
    return f"CASE WHEN {high} > {low} THEN (CAST({column} AS DOUBLE) - {low}) / ({high} - {low}) ELSE 0 END"


CTE["normalized"] = f"""
SELECT *, {_scaled("avg_review_stars")} AS norm_stars, {_scaled("review_count")} AS norm_review_count,
       {_scaled("checkin_count")} AS norm_checkin_count, {_scaled("tip_compliment_count")} AS norm_tip_compliments,
       exp(-CAST(coalesce(date_diff('day', last_review_date, day), 3650) AS DOUBLE) / 30E0) AS recency_boost
FROM inputs WINDOW m AS (PARTITION BY day)"""
CTE["scored"] = """
SELECT *, round(norm_stars * 0.5E0 + norm_review_count * 0.25E0 + recency_boost * 0.15E0
                + (norm_checkin_count + norm_tip_compliments) * 0.05E0, 9) AS popularity_score
FROM normalized"""
CTE["popularity"] = """
SELECT day, strftime(day, '%Y-%m') AS period_month, CAST(2 AS INTEGER) AS granularity, business_id, name, city, state,
       categories, popularity_score,
       CAST(rank() OVER (PARTITION BY day, city ORDER BY popularity_score DESC) AS INTEGER) AS city_rank
FROM scored"""
CTE["dirty_popularity"] = """
SELECT day, period_month, CASE WHEN city_rank = 4 THEN 1 ELSE granularity END AS granularity,
       CASE WHEN city_rank = 6 THEN NULL ELSE business_id END AS business_id,
       CASE WHEN city_rank = 2 THEN popularity_score + 1 ELSE popularity_score END AS popularity_score,
       CASE WHEN city_rank = 3 THEN 0 ELSE city_rank END AS city_rank
FROM popularity
UNION ALL
SELECT day, period_month, granularity, business_id, popularity_score, city_rank FROM popularity WHERE city_rank = 1"""
CTE["dirty_fact"] = """
SELECT day, period_month, granularity, business_id, CASE WHEN measure = 7 AND units > 9 THEN 10 ELSE measure END AS measure,
       CASE WHEN measure = 5 AND units > 9 THEN NULL ELSE units END AS units
FROM fact"""


def _with(final: str) -> str:
    """`final` preceded by the expressions it needs, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+([a-z_]+)", text):
            if name in CTE and name not in needed:
                visit(CTE[name])
                if name not in needed:
                    needed.append(name)

    visit(final)
    if not needed:
        return final.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n].strip()})" for n in needed) + "\n" + final.strip()


#: Columns of each raw and each stored silver table, in order.
RAW_COLUMNS = {
    "business": "business_id name city state latitude longitude stars review_count is_open categories",
    "user": "user_id name yelping_since review_count fans average_stars useful funny cool friends",
    "review": "review_id user_id business_id stars useful funny cool date text",
    "checkin": "business_id date",
    "tip": "user_id business_id text date compliment_count",
}
_DATED = "CAST(try_strptime(regexp_extract(date, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}'), '%Y-%m-%d') AS DATE)"
_TIMED = "try_strptime(regexp_extract(date, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}'), '%Y-%m-%d %H:%M:%S')"
for _name in ("business", "user", "checkin"):
    CTE[f"stored_{_name}"] = f"SELECT *, unnest([{MONTH_ENDS[1:-1]}]) AS day FROM silver_{_name}"
CTE["stored_review"] = "SELECT *, date AS day FROM silver_review"
CTE["stored_tip"] = f"""
SELECT user_id, business_id, trim(text) AS text, {_TIMED} AS date,
       CASE WHEN compliment_count < 0 THEN 0 ELSE compliment_count END AS compliment_count, {_DATED} AS day
FROM raw_tip WHERE user_id <> '' AND business_id <> ''"""
STORED_COLUMNS = {
    "business": "business_id name city state latitude longitude stars review_count is_open categories day",
    "user": "user_id name yelping_since review_count fans average_stars useful funny cool friend_count day",
    "review": "review_id user_id business_id stars useful funny cool date text day",
    "checkin": "business_id checkin_date day",
    "tip": "user_id business_id text date compliment_count day",
}


def _listed(table: str, only: tuple[str, ...] = tuple(STORED_COLUMNS)) -> str:
    """All rows of the five tables, or of some, each as one text."""
    columns = RAW_COLUMNS if table.startswith("raw") else STORED_COLUMNS
    columns = {t: own for t, own in columns.items() if t in only}
    texts = {t: ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in own.split()) for t, own in columns.items()}
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, concat_ws('|', {text}) AS row_text FROM {table.format(t)}" for t, text in texts.items()
    )


_KEYS = {"business": ["business_id"], "user": ["user_id"], "review": ["review_id", "user_id", "business_id"],
         "checkin": ["business_id"], "tip": ["user_id", "business_id"]}
_METRICS = "\nUNION ALL\n".join(
    f"SELECT 'bronze' AS layer, '{t}' AS table_name, count(*) AS rows, count(*) FILTER (NOT coalesce("
    + " AND ".join(f"{k} <> ''" for k in keys)
    + f", FALSE)) AS rejected, CAST(NULL AS BIGINT) AS null_dates FROM raw_{t}\nUNION ALL\n"
    f"SELECT 'silver', '{t}', count(*), NULL, "
    + {"business": "NULL", "user": "count(*) FILTER (yelping_since IS NULL)", "checkin": "count(*) FILTER (checkin_date IS NULL)"}.get(t, "count(*) FILTER (date IS NULL)")
    + f" FROM stored_{t}"
    for t, keys in _KEYS.items()
)
_VIEWS = {
    "v_top_businesses_by_city": "SELECT * FROM popularity WHERE city_rank <= 10 AND day = (SELECT max(day) FROM popularity)",
    "v_latest_review_metrics": "SELECT DISTINCT business_id FROM fact WHERE granularity = 0 AND day = (SELECT max(day) FROM fact WHERE granularity = 0)",
    "v_monthly_business_summary": "SELECT DISTINCT business_id, day FROM fact WHERE granularity = 2",
    "v_table_row_counts": "SELECT unnest([1, 2]) FROM (SELECT count(*) FROM fact)",
    "v_dq_duplicate_business_popularity": "SELECT business_id FROM popularity GROUP BY business_id, day, granularity HAVING count(*) > 1",
    "v_dq_missing_fields": "SELECT unnest([1, 2]) FROM (SELECT count(*) FROM fact)",
}

ORACLE: dict[str, str] = {
    # -- flagship and popularity parts
    "business_popularity": "SELECT * FROM popularity WHERE day = DATE '2024-01-31'",
    "business_popularity_all_months": "SELECT * FROM popularity",
    "popularity_inputs": "SELECT * FROM inputs WHERE day = DATE '2024-01-31'",
    "popularity_score": """
SELECT business_id, day, round(norm_stars, 9) AS norm_stars, round(norm_review_count, 9) AS norm_review_count,
       round(norm_checkin_count, 9) AS norm_checkin_count, round(norm_tip_compliments, 9) AS norm_tip_compliments,
       round(recency_boost, 9) AS recency_boost, popularity_score
FROM scored""",
    "recency_boost": """
SELECT business_id, max(date) AS last_review_date,
       round(exp(-CAST(coalesce(date_diff('day', max(date), DATE '2024-02-29'), 3650) AS DOUBLE) / 30E0), 9) AS recency_boost
FROM silver_review GROUP BY business_id""",
    "review_stats": """
SELECT business_id, count(*) AS review_count, avg(stars) AS avg_review_stars, max(date) AS last_review_date,
       min(date) AS first_review_date FROM silver_review GROUP BY business_id""",
    "checkin_counts": "SELECT business_id, count(*) AS checkin_count FROM silver_checkin GROUP BY business_id",
    "compliment_sums": """
SELECT business_id, CAST(sum(compliment_count) AS BIGINT) AS tip_compliment_count FROM silver_tip GROUP BY business_id""",
    "business_activity": """
SELECT business_id, coalesce(review_count, 0) AS review_count, avg_review_stars, last_review_date, first_review_date,
       coalesce(checkin_count, 0) AS checkin_count, tip_compliment_count
FROM (SELECT business_id, count(*) AS review_count, avg(stars) AS avg_review_stars, max(date) AS last_review_date,
             min(date) AS first_review_date FROM silver_review GROUP BY business_id)
FULL JOIN (SELECT business_id, count(*) AS checkin_count FROM silver_checkin GROUP BY business_id) USING (business_id)
FULL JOIN (SELECT business_id, CAST(sum(compliment_count) AS BIGINT) AS tip_compliment_count
           FROM silver_tip GROUP BY business_id) USING (business_id)""",
    "min_max_normalize": """
SELECT user_id, (fans - min(fans) OVER ()) / CAST(max(fans) OVER () - min(fans) OVER () AS DOUBLE) AS norm_fans,
       (average_stars - min(average_stars) OVER ()) / (max(average_stars) OVER () - min(average_stars) OVER ()) AS norm_stars,
       CAST(0 AS DOUBLE) AS norm_constant
FROM silver_user""",
    "city_rank": """
SELECT business_id, city, stars, CAST(rank() OVER (PARTITION BY city ORDER BY stars DESC NULLS LAST) AS INTEGER) AS city_rank
FROM silver_business""",
    # -- sources and cleaning
    "bronze_json_roundtrip": _listed("raw_{}"),
    "json_inferred_schema": _listed("raw_{}"),
    "silver_business": "SELECT * FROM silver_business",
    "silver_user": "SELECT * FROM silver_user",
    "silver_review": "SELECT * FROM silver_review",
    "silver_checkin": "SELECT * FROM silver_checkin",
    "silver_tip": "SELECT * FROM silver_tip",
    "silver_date_slice": "SELECT *, date AS day FROM silver_review WHERE date = DATE '2024-01-05'",
    "silver_full_load": """
SELECT user_id, business_id, trim(text) AS text, try_strptime(regexp_extract(date, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}'), '%Y-%m-%d %H:%M:%S') AS date,
       CASE WHEN compliment_count < 0 THEN 0 ELSE compliment_count END AS compliment_count,
       CAST(try_strptime(regexp_extract(date, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}'), '%Y-%m-%d') AS DATE) AS day
FROM raw_tip WHERE user_id <> '' AND business_id <> ''""",
    "silver_run_days": """
SELECT *, unnest([DATE '2024-01-30', DATE '2024-01-31']) AS day FROM silver_checkin""",
    "silver_job": _listed("stored_{}"),
    "job_metrics": _METRICS
    + "\nUNION ALL\nSELECT 'gold', 'fact_review_tip_metrics', count(*), NULL, NULL FROM fact"
    + "\nUNION ALL\nSELECT 'gold', 'business_popularity', count(*), NULL, NULL FROM popularity",
    "silver_one_day_job": _listed("(SELECT * FROM stored_{} WHERE day = DATE '2024-01-05')", ("review", "tip")),
    "bronze_published": _listed("raw_{}"),
    "latest_per_key": """
SELECT business_id, max(user_id) AS user_id, max(date) AS date FROM (
  SELECT business_id, user_id, date, rank() OVER (PARTITION BY business_id ORDER BY date DESC NULLS LAST) AS r
  FROM silver_tip WHERE date IS NOT NULL) WHERE r = 1 GROUP BY business_id""",
    "range_filter_tip": """
SELECT * FROM silver_tip WHERE date >= TIMESTAMP '2024-01-10 00:00:00' AND date < TIMESTAMP '2024-01-21 00:00:00'""",
    "calendar": """
SELECT day, strftime(day, '%Y-%m') AS period_month, CAST(date_trunc('month', day) AS DATE) AS month_start,
       last_day(day) AS month_end, day = last_day(day) AS is_month_end
FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS day FROM silver_review)""",
    "scan_filter_project": """
SELECT business_id, name, popularity_score FROM popularity WHERE day = DATE '2024-01-31' AND city_rank <= 3""",
    # -- facts
    "review_metrics": """
SELECT business_id, CAST(count(DISTINCT review_id) AS DOUBLE) AS review_count, avg(stars) AS avg_stars,
       CAST(sum(useful) AS DOUBLE) AS total_useful, CAST(sum(funny) AS DOUBLE) AS total_funny,
       CAST(sum(cool) AS DOUBLE) AS total_cool, CAST(count(DISTINCT user_id) AS DOUBLE) AS distinct_users_review
FROM silver_review GROUP BY business_id""",
    "tip_metrics": """
SELECT business_id, CAST(count(*) AS DOUBLE) AS tip_count,
       CAST(sum(coalesce(compliment_count, 0)) AS DOUBLE) AS compliment_count_sum,
       CAST(count(DISTINCT user_id) AS DOUBLE) AS distinct_users_tip
FROM silver_tip GROUP BY business_id""",
    "metrics_narrow": """
SELECT business_id, CAST(2 AS INTEGER) AS measure, CAST(count(*) AS DOUBLE) AS units FROM silver_tip GROUP BY business_id
UNION ALL
SELECT business_id, 3, CAST(sum(coalesce(compliment_count, 0)) AS DOUBLE) FROM silver_tip GROUP BY business_id
UNION ALL
SELECT business_id, 9, CAST(count(DISTINCT user_id) AS DOUBLE) FROM silver_tip GROUP BY business_id""",
    "extra_measures": """
SELECT business_id, stars_sum, positive_pct, negative_pct, avg_tip_compliments
FROM (SELECT business_id, CAST(sum(stars) AS DOUBLE) AS stars_sum,
             round(avg(CASE WHEN stars >= 4 THEN 1E0 WHEN stars < 4 THEN 0E0 END) * 100, 9) AS positive_pct,
             round(avg(CASE WHEN stars <= 2 THEN 1E0 WHEN stars > 2 THEN 0E0 END) * 100, 9) AS negative_pct
      FROM silver_review GROUP BY business_id)
FULL JOIN (SELECT business_id, avg(coalesce(compliment_count, 0)) AS avg_tip_compliments
           FROM silver_tip GROUP BY business_id) USING (business_id)""",
    "fact_review_tip_daily": "SELECT * FROM fact WHERE granularity = 0 AND day = DATE '2024-01-15'",
    "fact_review_tip_monthly": "SELECT * FROM fact WHERE granularity = 2 AND day = DATE '2024-01-31'",
    "fact_all_days": "SELECT * FROM fact",
    "fact_job": "SELECT * FROM fact",
    "popularity_job": "SELECT * FROM popularity",
    "fact_from_state": "SELECT * FROM fact WHERE granularity = 2",
    "bronze_from_dump": _listed("raw_{}"),
    "silver_pass_through": "SELECT *, DATE '2024-01-31' AS day FROM nation",
    "slice_keys": "SELECT DISTINCT day, granularity FROM fact",
    # -- table maintenance
    "partition_overwrite": """
SELECT user_id, business_id, text, date, CAST(CASE WHEN CAST(date AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
       THEN compliment_count + 100 ELSE compliment_count END AS INTEGER) AS compliment_count, CAST(date AS DATE) AS day
FROM silver_tip WHERE date IS NOT NULL""",
    "upsert_by_key": """
SELECT day, period_month, granularity, business_id, measure,
       CASE WHEN day >= DATE '2024-01-31' THEN units + 1000 ELSE units END AS units
FROM fact WHERE NOT (day < DATE '2024-01-31' AND measure = 4)""",
    "upsert_unpartitioned": """
SELECT day, period_month, granularity, business_id, measure,
       CASE WHEN day >= DATE '2024-01-31' THEN units + 1000 ELSE units END AS units
FROM fact WHERE NOT (day < DATE '2024-01-31' AND measure = 4)""",
    "replace_slice": """
SELECT * FROM fact
WHERE granularity = 0 OR day = DATE '2023-12-31' OR (day = DATE '2024-01-31' AND measure = 1)""",
    "replace_slice_by_month": """
SELECT * FROM fact WHERE period_month <> '2024-02' OR measure = 1""",
    "replace_slice_timestamp": """
SELECT user_id, business_id, date, date_trunc('month', date) + INTERVAL 330 MINUTE AS slot FROM silver_tip
WHERE date IS NOT NULL AND month(date) <> 1""",
    "measure_codes_seed": """
SELECT measure AS measure_id, 'kept' AS measure_name FROM fact WHERE measure < 4 GROUP BY measure
UNION ALL
SELECT measure, CASE measure WHEN 4 THEN 'avg_stars' WHEN 5 THEN 'total_useful' WHEN 6 THEN 'total_funny'
       WHEN 7 THEN 'total_cool' WHEN 8 THEN 'distinct_users_review' ELSE 'distinct_users_tip' END
FROM fact WHERE measure >= 4 GROUP BY measure""",
    "add_column_default": """
SELECT business_id, day, popularity_score, CASE WHEN day = DATE '2024-02-29' THEN state ELSE 'Unknown' END AS region
FROM popularity""",
    "add_column_catalog_default": """
SELECT business_id, day, popularity_score, CASE WHEN day = DATE '2024-02-29' THEN state ELSE 'Unknown' END AS region
FROM popularity""",
    "rows_per_file": """
SELECT 5000 AS row_limit, count(*) AS rows, TRUE AS kept FROM fact UNION ALL SELECT NULL, count(*), FALSE FROM fact""",
    "checked_write": """
SELECT business_id, day, granularity, popularity_score, city_rank,
       concat_ws(',', CASE WHEN city_rank <= 0 THEN 'city_rank' END, CASE WHEN granularity NOT IN (0, 2) THEN 'granularity' END,
                 CASE WHEN popularity_score < 0 OR popularity_score > 1 THEN 'popularity_score' END) AS broken_rules
FROM dirty_popularity""",
    "register_table": "SELECT period_month, count(*) AS row_count FROM popularity GROUP BY period_month",
    # -- reports
    "top_businesses_by_city": """
SELECT city, state, business_id, name, categories, popularity_score, city_rank, period_month FROM popularity
WHERE city_rank <= 10 AND period_month = (SELECT max(period_month) FROM popularity)""",
    "top10_city": """
SELECT business_id, name, city_rank, popularity_score, categories FROM popularity
WHERE city = 'Brand#11' AND period_month = '2024-01' ORDER BY city_rank, business_id LIMIT 10""",
    "top5_per_city": """
SELECT city, state, business_id, name, city_rank, popularity_score FROM popularity
WHERE period_month = '2024-01' AND city_rank <= 5""",
    "latest_review_metrics": """
SELECT business_id, day, period_month, max(units) FILTER (measure = 1) AS review_count,
       max(units) FILTER (measure = 4) AS avg_stars, max(units) FILTER (measure = 2) AS tip_count,
       max(units) FILTER (measure = 5) AS total_useful, max(units) FILTER (measure = 8) AS distinct_users_review,
       max(units) FILTER (measure = 9) AS distinct_users_tip
FROM fact WHERE granularity = 0 AND day = (SELECT max(day) FROM fact WHERE granularity = 0) GROUP BY ALL""",
    "monthly_business_summary": """
SELECT f.business_id, f.period_month, f.day, max(units) FILTER (measure = 1) AS total_reviews,
       max(units) FILTER (measure = 4) AS avg_stars, max(units) FILTER (measure = 2) AS total_tips,
       p.popularity_score, p.city_rank, p.name, p.city, p.state
FROM fact f LEFT JOIN popularity p
  ON f.business_id = p.business_id AND f.day = p.day AND f.granularity = p.granularity
WHERE f.granularity = 2
GROUP BY f.business_id, f.period_month, f.day, p.popularity_score, p.city_rank, p.name, p.city, p.state""",
    "monthly_trend": """
SELECT business_id, period_month, max(units) FILTER (measure = 1) AS review_count,
       max(units) FILTER (measure = 4) AS avg_stars, max(units) FILTER (measure = 2) AS tip_count,
       max(units) FILTER (measure = 5) AS total_useful
FROM fact WHERE granularity = 2 GROUP BY business_id, period_month""",
    "review_growth": """
SELECT business_id, period_month, max(units) AS reviews,
       lag(max(units)) OVER (PARTITION BY business_id ORDER BY period_month) AS prev_month
FROM fact WHERE granularity = 2 AND measure = 1 GROUP BY business_id, period_month""",
    "top_cities": """
SELECT city, state, count(DISTINCT business_id) AS business_count, CAST(sum(CAST(popularity_score AS DECIMAL(18, 9))) AS DOUBLE) / count(popularity_score) AS avg_popularity,
       max(period_month) AS latest_period
FROM popularity GROUP BY city, state ORDER BY avg_popularity DESC, city, state LIMIT 5""",
    "city_comparison": """
SELECT b.business_id, b.name, b.city_rank, b.popularity_score, f.units AS review_count
FROM popularity b JOIN fact f ON b.business_id = f.business_id AND b.day = f.day AND b.granularity = f.granularity
WHERE b.city = 'Brand#11' AND f.measure = 1 AND b.period_month = '2024-01' ORDER BY b.city_rank, b.business_id LIMIT 20""",
    "city_dashboard": """
SELECT p.city, count(DISTINCT p.business_id) AS businesses, CAST(sum(CAST(p.popularity_score AS DECIMAL(18, 9))) AS DOUBLE) / count(p.popularity_score) AS avg_popularity,
       CAST(sum(CASE WHEN f.measure = 4 THEN CAST(f.units AS DECIMAL(18, 9)) END) AS DOUBLE)
         / count(CASE WHEN f.measure = 4 THEN f.units END) AS avg_rating
FROM popularity p JOIN fact f ON p.business_id = f.business_id AND p.day = f.day
WHERE p.period_month = (SELECT max(period_month) FROM popularity) AND f.granularity = 2
GROUP BY p.city ORDER BY avg_popularity DESC, p.city LIMIT 20""",
    "city_time_series": """
SELECT city, period_month, count(DISTINCT business_id) AS active_businesses,
       CAST(sum(CAST(popularity_score AS DECIMAL(18, 9))) AS DOUBLE) / count(popularity_score) AS avg_popularity
FROM popularity GROUP BY city, period_month""",
    "city_period_average": """
SELECT city, CAST(sum(CAST(popularity_score AS DECIMAL(18, 9))) AS DOUBLE) / count(popularity_score) AS avg_score, count(*) AS business_count
FROM popularity WHERE period_month = '2024-01' GROUP BY city""",
    "coverage_stats": """
SELECT count(DISTINCT period_month) AS months_available, min(day) AS first_date, max(day) AS last_date FROM popularity""",
    "coverage_of_rows": """
SELECT count(DISTINCT period_month) AS months_available, min(day) AS first_date, max(day) AS last_date FROM popularity""",
    "latest_slice_rows": """
SELECT day, count(*) AS row_count, (SELECT min(measure) FROM fact) AS min_measure, (SELECT max(measure) FROM fact) AS max_measure
FROM fact WHERE granularity = 0 AND day = (SELECT max(day) FROM fact WHERE granularity = 0) GROUP BY day""",
    "reports_as_views": "\nUNION ALL\n".join(
        f"SELECT '{view}' AS view_name, count(*) AS row_count FROM ({text})" for view, text in _VIEWS.items()
    ),
    # -- quality
    "table_row_counts": """
SELECT 'business_popularity' AS table_name, count(*) AS row_count FROM popularity
UNION ALL
SELECT 'fact_review_tip_metrics', count(*) FROM fact""",
    "table_row_counts_scanned": """
SELECT 'business_popularity' AS table_name, count(*) AS row_count FROM popularity
UNION ALL
SELECT 'fact_review_tip_metrics', count(*) FROM fact""",
    "dq_duplicate_keys": """
SELECT business_id, day, granularity, count(*) AS duplicate_count FROM dirty_popularity
GROUP BY business_id, day, granularity HAVING count(*) > 1""",
    "dq_missing_fields": """
SELECT 'business_popularity' AS table_name, count(*) AS null_count, 'business_id' AS column_name
FROM dirty_popularity WHERE business_id IS NULL
UNION ALL
SELECT 'fact_review_tip_metrics', count(*), 'units' FROM dirty_fact WHERE units IS NULL""",
    "dq_constraint_violations": """
SELECT 'business_popularity' AS table_name, 'granularity' AS rule, count(*) AS violations
FROM dirty_popularity WHERE granularity NOT IN (0, 2)
UNION ALL
SELECT 'business_popularity', 'popularity_score', count(*) FROM dirty_popularity
WHERE popularity_score < 0 OR popularity_score > 1
UNION ALL
SELECT 'business_popularity', 'city_rank', count(*) FROM dirty_popularity WHERE city_rank <= 0
UNION ALL
SELECT 'business_popularity', 'unique_key', CAST(coalesce(sum(n - 1), 0) AS BIGINT)
FROM (SELECT count(*) AS n FROM dirty_popularity GROUP BY business_id, day, granularity)
UNION ALL
SELECT 'fact_review_tip_metrics', 'granularity', count(*) FROM dirty_fact WHERE granularity NOT IN (0, 2)
UNION ALL
SELECT 'fact_review_tip_metrics', 'measure', count(*) FROM dirty_fact WHERE measure NOT BETWEEN 1 AND 9
UNION ALL
SELECT 'fact_review_tip_metrics', 'unique_key', CAST(coalesce(sum(n - 1), 0) AS BIGINT)
FROM (SELECT count(*) AS n FROM dirty_fact GROUP BY business_id, day, granularity, measure)""",
    "dq_quarantine": """
SELECT business_id, day, granularity, popularity_score, city_rank FROM dirty_popularity
WHERE granularity NOT IN (0, 2) OR popularity_score < 0 OR popularity_score > 1 OR city_rank <= 0""",
}


# The same reports where January keeps ranks up to 5 and February has no rows.
CTE["kept_popularity"] = """
SELECT * FROM popularity WHERE day = DATE '2023-12-31' OR (day = DATE '2024-01-31' AND city_rank <= 5)"""
for _report in ("top_cities", "city_dashboard", "city_time_series", "city_period_average"):
    ORACLE[f"{_report}_maintained"] = re.sub(r"\bpopularity\b", "kept_popularity", ORACLE[_report])


def oracle_sql() -> dict[str, str]:
    return {name: _with(text) for name, text in ORACLE.items()}
