"""Bronze-shaped postings derived from orders, customers and their nations, in both engines.

The given tables hold no postings. Each order becomes one, by arithmetic and text rules that read
the same in Spark SQL and DuckDB; only the date functions differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vacancia.context import spread

RULES = {
    "k": "o_orderkey",
    "source": "CASE k % 3 WHEN 0 THEN 'Wuzzuf' WHEN 1 THEN 'Sabbar' ELSE 'Tanqeeb' END",
    "raw_job_id": "CAST(k AS STRING)",
    "raw_job_title": "CASE WHEN k % 41 = 0 THEN 'N/A' WHEN k % 43 = 0 THEN NULL "
    "WHEN k % 5 = 0 THEN '<b>' || o_orderpriority || '</b>  ' || c_mktsegment || ' ' "
    "ELSE o_orderpriority || ' ' || c_mktsegment END",
    "raw_company_name": "CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN '' "
    "ELSE 'Company ' || CAST(c % 50 AS STRING) || ' ' || n_name END",
    "raw_job_description": "CASE WHEN k % 47 = 0 THEN 'none' "
    "ELSE '<p>' || c_mktsegment || '&amp;</p><br/> by ' || CAST(c AS STRING) END",
    "raw_job_url": "CASE WHEN k % 53 = 0 THEN ' ' "
    "WHEN k % 59 = 0 THEN 'https://host/jobs-in-egypt/' || CAST(k AS STRING) "
    "ELSE 'https://host/jobs/p/' || CAST(k % 5000 AS STRING) END",
    "raw_country": "CASE k % 11 WHEN 0 THEN 'Saudi Arabia' WHEN 1 THEN 'KSA' "
    "WHEN 2 THEN 'المملكة العربية السعودية' WHEN 3 THEN 'Egypt' WHEN 4 THEN 'US' WHEN 5 THEN NULL "
    "WHEN 6 THEN ' saudi arabia ' WHEN 7 THEN 'السعودية' WHEN 8 THEN 'n/a' "
    "WHEN 9 THEN 'Riyadh, Saudi Arabia' ELSE 'Kingdom of Saudi Arabia' END",
    "raw_city": "CASE c % 12 WHEN 0 THEN 'الرياض' WHEN 1 THEN ' Riyadh ' WHEN 2 THEN 'جدة' "
    "WHEN 3 THEN 'n/a' WHEN 4 THEN NULL WHEN 5 THEN 'al-kharj north' WHEN 6 THEN 'Cairo' "
    "WHEN 7 THEN 'DAMMAM' WHEN 8 THEN 'مكة المكرمة' WHEN 9 THEN 'Al Khobar' WHEN 10 THEN '' "
    "ELSE 'حي al olaya2b' END",
    "raw_work_mode": "CASE k % 5 WHEN 0 THEN 'Fully Remote' WHEN 1 THEN 'Hybrid' WHEN 2 THEN 'On-site' "
    "WHEN 3 THEN 'Field Work' ELSE NULL END",
    "raw_employment_type": "CASE k % 7 WHEN 0 THEN 'Full Time' WHEN 1 THEN 'part-time' "
    "WHEN 2 THEN 'Contract' WHEN 3 THEN 'INTERNSHIP' WHEN 4 THEN 'freelance' WHEN 5 THEN 'Temporary' "
    "ELSE NULL END",
    "raw_experience": "CASE k % 4 WHEN 0 THEN '1 - 3 years' WHEN 1 THEN '<i>5</i> years' "
    "WHEN 2 THEN '' ELSE NULL END",
    "raw_qualification": "CASE k % 6 WHEN 0 THEN 'Bachelor degree' WHEN 1 THEN 'بكالوريوس' "
    "WHEN 2 THEN 'Master' WHEN 3 THEN 'دبلوم' WHEN 4 THEN 'High School' ELSE NULL END",
    "raw_skills": "CASE k % 4 WHEN 0 THEN 'python; sql' WHEN 1 THEN 'sql , spark,sql' "
    "WHEN 2 THEN ' ' ELSE NULL END",
    "raw_salary": "CASE WHEN k % 9 = 0 THEN NULL WHEN k % 2 = 0 THEN "
    "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) || ' SAR' ELSE "
    "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) || ' - ' || "
    "CAST(CAST(floor(o_totalprice) AS BIGINT) + 1000 AS STRING) || ' SAR' END",
    "raw_estimated_salary": "CASE WHEN k % 10 = 0 THEN CAST(k AS STRING) END",
    "raw_posted_date": "CASE k % 8 WHEN 0 THEN {iso} WHEN 1 THEN {text} WHEN 2 THEN {day} "
    "WHEN 3 THEN {slash_time} WHEN 4 THEN {slash_day} WHEN 5 THEN {millis} WHEN 6 THEN {seconds} "
    "ELSE 'soon' END",
    "raw_collected_at": "{text}",
}

SPARK_DATES = {
    "ts": "o_orderdate + INTERVAL '30' YEAR + make_dt_interval(0, 0, 0, o_orderkey % 86400)",
    "iso": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") || '+03:00'",
    "text": "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    "day": "date_format(ts, 'yyyy-MM-dd')",
    "slash_time": "date_format(ts, 'MM/dd/yyyy HH:mm:ss')",
    "slash_day": "date_format(ts, 'dd/MM/yyyy')",
    "seconds": "CAST(unix_seconds(CAST(ts AS TIMESTAMP)) AS STRING)",
    "millis": "CAST(unix_millis(CAST(ts AS TIMESTAMP)) AS STRING)",
}

DUCK_DATES = {
    "ts": "o_orderdate + INTERVAL 30 YEAR + to_seconds(o_orderkey % 86400)",
    "iso": "strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+03:00'",
    "text": "strftime(ts, '%Y-%m-%d %H:%M:%S')",
    "day": "strftime(ts, '%Y-%m-%d')",
    "slash_time": "strftime(ts, '%m/%d/%Y %H:%M:%S')",
    "slash_day": "strftime(ts, '%d/%m/%Y')",
    "seconds": "CAST(CAST(epoch(ts) AS BIGINT) AS STRING)",
    "millis": "CAST(epoch_ms(ts) AS STRING)",
}


def _select(dates: dict[str, str]) -> list[str]:
    return [f"{rule.format(**dates)} AS {name}" for name, rule in RULES.items()]


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Bronze-shaped posting per order, plus the order key `k`."""
    orders = spread(spark.read.parquet(f"{sf_dir}/orders.parquet"))
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    base = joined.selectExpr("*", "o_orderkey AS k", "c_custkey AS c", f"{SPARK_DATES['ts']} AS ts")
    return base.selectExpr(*_select(SPARK_DATES))


RAW_SQL = f"""
postings_base AS (
  SELECT *, o_orderkey AS k, c_custkey AS c, {DUCK_DATES['ts']} AS ts
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
raw AS (SELECT {', '.join(_select(DUCK_DATES))} FROM postings_base)"""
