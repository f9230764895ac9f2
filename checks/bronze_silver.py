"""Sources, Bronze mapping, validation, Silver, upsert and quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import sql as Q
from checks.postings import raw_postings
from checks.registry import check, scratch, table
from vacancia import fixed_values as V
from vacancia import schemas as S
from vacancia.context import RunContext, spread
from vacancia.functions import classify as C
from vacancia.functions import text as X
from vacancia.functions.arrays import join_names
from vacancia.functions.dates import parse_ts
from vacancia.functions.ids import job_id
from vacancia.operators import merge as M
from vacancia.operators import quality as H
from vacancia.operators import unify as U
from vacancia.operators import validate as E
from vacancia.operators.dedup import latest_by
from vacancia.plans import silver as P
from vacancia.sources import json_export as J
from vacancia.sources import landing as L
from vacancia.sources import tables as B

CTX = RunContext("2030-01-02", "batch_1", Q.NOW)
BRONZE_LIST = ", ".join(S.BRONZE_COLUMNS)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_postings(spark, sf_dir).drop("k")


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.split_valid(bronze(spark, sf_dir))[0]


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.silver_batch(bronze(spark, sf_dir), Q.NOW)[0]


# --- sources and sinks --------------------------------------------------------------------------


@check(
    "a2_latest_per_source",
    """SELECT source, name, n_chars AS length FROM (
         SELECT source, source || '_' || lpad(CAST(doc_id AS STRING), 9, '0') || '.json' AS name, n_chars FROM documents)
       QUALIFY row_number() OVER (PARTITION BY source ORDER BY name DESC) = 1""",
)
def _(spark, sf_dir):
    name = F.concat("source", F.lit("_"), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit(".json"))
    files = table(spark, sf_dir, "documents").select("source", name.alias("name"), F.col("n_chars").alias("length"))
    return L.latest_per_source(files)


def array_files(raw: DataFrame, folder: str, per_file: int = 1000, damaged: bool = False) -> None:
    """Landing files written from postings: JSON arrays with an indent of two, a bounded number of
    records each. With `damaged` every 50th key is no JSON, and every fifth file ends too early."""
    record = F.to_json(F.struct("*"))
    end = F.lit("\n  }\n]")
    if damaged:
        record = F.when(F.col("k") % 50 == 7, F.lit("{no JSON}")).otherwise(record)
        end = F.when(F.col("file") % 5 != 1, end).otherwise("")
    body = F.concat(F.lit("{\n    "), F.expr("substring(_json, 2, length(_json) - 2)"))
    packed = (
        raw.select(F.floor(F.col("k") / per_file).alias("file"), record.alias("_json"))
        .select("file", body.alias("_json"))
        .groupBy("file")
        .agg(F.array_join(F.sort_array(F.collect_list("_json")), "\n  },\n  ").alias("_all"))
        .select(F.concat(F.lit("[\n  "), F.col("_all"), end).alias("value"))
    )
    packed.write.mode("append").option("maxRecordsPerFile", 1).text(folder)


FLAT_B_OF_RAW = {
    "id": "raw_job_id", "title": "raw_job_title", "company": "raw_company_name",
    "description": "raw_job_description", "url": "raw_job_url", "country": "raw_country", "city": "raw_city",
    "work_mode": "raw_work_mode", "job_type": "raw_employment_type", "experience": "raw_experience",
    "education": "raw_qualification", "skills": "raw_skills", "salary": "raw_salary",
    "estimated_salary": "raw_estimated_salary", "posted_date": "raw_posted_date",
    "collected_at": "raw_collected_at",
}


def landed(spark: SparkSession, sf_dir: str) -> str:
    """A new landing folder holding the postings as raw records of flat portal B."""
    folder = scratch(spark)
    raw = raw_postings(spark, sf_dir)
    array_files(raw.select("k", *[F.col(v).alias(k) for k, v in FLAT_B_OF_RAW.items()]), folder)
    return folder


@check("a1_landing_files", "SELECT 'part' AS source, count(DISTINCT o_orderkey // 1000) AS files, true AS sized FROM orders")
def _(spark, sf_dir):
    """Inventory of landed files; markers are left out."""
    files = L.landing_files(spark, landed(spark, sf_dir), ["part"], ".txt")
    return files.groupBy("source").agg(
        F.count_distinct("name").alias("files"), (F.min("length") > 0).alias("sized")
    )


@check(
    "a3_read_postings",
    f"{Q.WITH_RAW} SELECT {', '.join(f'{v} AS {k}' for k, v in FLAT_B_OF_RAW.items())}, 0 AS corrupt FROM raw",
)
def _(spark, sf_dir):
    rows = L.read_postings(spark, landed(spark, sf_dir), S.RAW_FLAT_B)
    return rows.select(*FLAT_B_OF_RAW, F.col("_corrupt_record").isNotNull().cast("int").alias("corrupt"))


def one_line_files(raw: DataFrame, folder: str, between: str, per_file: int = 2000) -> None:
    """The same records as arrays of another layout; every 50th key has lost a quote."""
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    record = F.when(F.col("k") % 50 == 7, F.replace(record, F.lit('"url":"'), F.lit('"url":'))).otherwise(record)
    packed = raw.select(F.floor(F.col("k") / per_file).alias("file"), record.alias("_json")).groupBy("file")
    packed = packed.agg(F.array_join(F.sort_array(F.collect_list("_json")), between).alias("_all"))
    lines = packed.select(F.concat(F.lit("["), "_all", F.lit("]")).alias("value"))
    lines.write.mode("append").option("maxRecordsPerFile", 1).text(folder)


@check(
    "a3_any_layout",
    f"{Q.WITH_RAW} SELECT {', '.join(f'CASE WHEN k % 50 <> 7 THEN {v} END AS {k}' for k, v in FLAT_B_OF_RAW.items())}, "
    "CAST(k % 50 = 7 AS INT) AS corrupt FROM raw",
)
def _(spark, sf_dir):
    """Arrays on one line, and with carriage returns; each record that lost a quote costs itself alone."""
    folder = scratch(spark)
    raw = raw_postings(spark, sf_dir).select("k", *[F.col(v).alias(n) for n, v in FLAT_B_OF_RAW.items()])
    one_line_files(raw.filter("k % 3 = 0"), folder, ",")
    one_line_files(raw.filter("k % 3 > 0"), folder, ",\r\n\t")
    rows = L.read_postings(spark, folder, S.RAW_FLAT_B)
    return rows.select(*FLAT_B_OF_RAW, F.col("_corrupt_record").isNotNull().cast("int").alias("corrupt"))


@check(
    "a5_file_record_counts",
    "SELECT records, count(*) AS files FROM (SELECT count(*) AS records FROM orders GROUP BY o_orderkey // 1000) GROUP BY records",
)
def _(spark, sf_dir):
    counts = L.file_record_counts(spark, landed(spark, sf_dir))
    return counts.groupBy("records").agg(F.count(F.lit(1)).alias("files"))


@check("a7_write_batch", f"{Q.WITH_RAW} SELECT source, '2030-01-02' AS day, count(*) AS n FROM raw GROUP BY 1, 2")
def _(spark, sf_dir):
    """The batch is written twice; the second run replaces the first."""
    path, raw = scratch(spark), raw_postings(spark, sf_dir)
    for rows in (raw.filter(F.col("raw_city").isNull()), raw):
        B.write_batch(B.with_ingest_metadata(rows.drop("k"), CTX), path, CTX)
    stored = B.read_table(spark, path, S.BRONZE)
    return stored.groupBy("source", F.col("_load_date").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@check("a8_read_batch", f"{Q.WITH_RAW} SELECT {BRONZE_LIST} FROM raw WHERE left(raw_collected_at, 4) = '2028' AND source = 'Sabbar'")
def _(spark, sf_dir):
    """Batches are the postings of one year and source."""
    raw = raw_postings(spark, sf_dir).withColumns(
        {"_load_date": F.trunc("raw_collected_at", "year"), "_batch_id": F.col("source")}
    )
    return B.read_batch(raw, RunContext("2028-01-01", "Sabbar", Q.NOW)).select(*S.BRONZE_COLUMNS)


@check(
    "a9_append_once",
    f"""{Q.WITH_RAW} SELECT batch_id, count(*) AS n FROM (
      SELECT CASE WHEN source = 'Sabbar' THEN 'batch_1' ELSE 'batch_2' END AS batch_id FROM raw WHERE NOT ({Q.VALID})) GROUP BY 1""",
)
def _(spark, sf_dir):
    """Rejects of two batches, the first one written twice."""
    path, raw = scratch(spark), raw_postings(spark, sf_dir)
    first, second = raw.filter("source = 'Sabbar'"), raw.filter("source <> 'Sabbar'")
    for part, batch in [(first, "batch_1"), (second, "batch_2"), (first, "batch_1")]:
        ctx = RunContext("2030-01-02", batch, Q.NOW)
        rows = B.with_ingest_metadata(part.drop("k"), ctx)
        B.append_once(E.split_valid(rows)[1], path, ctx)
    stored = B.read_table(spark, path, S.REJECTED)
    return stored.groupBy(F.col("_batch_id").alias("batch_id")).agg(F.count(F.lit(1)).alias("n"))


@check("a10_ensure_table", "SELECT 0 AS first_rows, count(*) AS rows FROM orders")
def _(spark, sf_dir):
    """An absent table is created empty, a filled one is left alone."""
    path = scratch(spark)
    B.ensure_table(spark, path, S.SILVER)
    first = B.read_table(spark, path, S.SILVER).count()
    raw = raw_postings(spark, sf_dir)
    raw.select(*[F.col("raw_job_id").alias(c) for c in S.SILVER_COLUMNS]).write.mode("append").parquet(path)
    B.ensure_table(spark, path, S.SILVER)
    return B.read_table(spark, path, S.SILVER).agg(F.lit(first).alias("first_rows"), F.count(F.lit(1)).alias("rows"))


EXPORTED = ["raw_job_id", "raw_job_title", "raw_city", "raw_work_mode"]


@check("a11_export_json_lines", f"{Q.WITH_RAW} SELECT {', '.join(EXPORTED)} FROM raw")
def _(spark, sf_dir):
    path = scratch(spark)
    J.export_json_lines(raw_postings(spark, sf_dir).select(*EXPORTED), path)
    return spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in EXPORTED])).json(path)


@check(
    "a11_export_json_array",
    f"{Q.WITH_RAW} SELECT {', '.join(EXPORTED)}, CASE WHEN row_number() OVER (ORDER BY raw_job_id) = 1 THEN '[' ELSE ',' END AS lead FROM raw "
    "UNION ALL SELECT NULL, NULL, NULL, NULL, ']'",
)
def _(spark, sf_dir):
    path = scratch(spark)
    rows = raw_postings(spark, sf_dir).select(*EXPORTED)
    J.export_json_array(rows, path, [F.col("raw_job_id").asc()])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in EXPORTED])
    lines = spark.read.text(path)
    return lines.select(
        F.from_json(F.expr("substring(value, 2)"), schema).alias("r"), F.substring("value", 1, 1).alias("lead")
    ).select("r.*", "lead")


@check(
    "a12_ingest_metadata",
    f"{Q.WITH_RAW} SELECT k, '2030-01-02' AS load_date, 'batch_1' AS batch_id, true AS stamped FROM raw",
)
def _(spark, sf_dir):
    rows = B.with_ingest_metadata(raw_postings(spark, sf_dir), CTX)
    return rows.select(
        "k",
        F.col("_load_date").cast("string").alias("load_date"),
        F.col("_batch_id").alias("batch_id"),
        F.col("_ingest_ts").isNotNull().alias("stamped"),
    )


# --- unify --------------------------------------------------------------------------------------

D1_SQL = f"""{Q.WITH_RAW} SELECT 'Wuzzuf' AS source, raw_job_id, raw_job_title, raw_company_name, raw_job_description,
  raw_job_url, 'Saudi Arabia' AS raw_country, raw_city,
  CASE WHEN k % 2 = 0 THEN coalesce(nullif(raw_work_mode, ''), 'shown') ELSE 'shown' END AS raw_work_mode,
  CASE WHEN k % 5 > 0 THEN raw_employment_type END AS raw_employment_type,
  CASE k % 4 WHEN 0 THEN '1 - 3 years' WHEN 1 THEN '1 years' WHEN 2 THEN '3 years' END AS raw_experience,
  raw_qualification,
  CASE k % 3 WHEN 0 THEN 'sql; ' || raw_job_id WHEN 1 THEN raw_job_id END AS raw_skills,
  CASE WHEN k % 9 = 0 THEN NULL ELSE raw_job_id || CASE WHEN k % 2 = 0 THEN ' - 9000' ELSE '' END
    || CASE WHEN k % 4 = 0 THEN ' USD' ELSE ' SAR' END END AS raw_salary,
  CAST(NULL AS VARCHAR) AS raw_estimated_salary, raw_posted_date, raw_collected_at FROM raw"""


def nested_raw(raw: DataFrame) -> DataFrame:
    """Postings as raw records of the nested shape."""
    null = F.lit(None).cast("string")

    def named(col):
        return F.struct(col.alias("name"))

    def listed(*items):
        """A JSON list: columns as objects with a name, texts as they are."""
        shown = [F.lit(x) if isinstance(x, str) else F.to_json(named(x)) for x in items]
        return F.concat(F.lit("["), F.concat_ws(",", *shown), F.lit("]"))

    keywords = F.when(F.col("k") % 6 == 0, listed(F.lit("sql"), null, F.col("raw_job_id"))).when(
        F.col("k") % 6 == 3, listed('"plain"', F.lit("sql"), "7", F.col("raw_job_id"), '["x"]')
    ).when(F.col("k") % 3 == 1, listed(F.lit(""), "null", F.col("raw_job_id")))
    low = F.when(F.col("k") % 4 < 2, F.lit("1"))
    high = F.when((F.col("k") % 4 == 0) | (F.col("k") % 4 == 2), F.lit("3"))
    currency = F.when(F.col("k") % 4 == 0, F.struct(F.lit("USD").alias("code")))
    s_low = F.when(F.col("k") % 9 == 0, F.lit("0")).otherwise(F.col("raw_job_id"))
    s_high = F.when(F.col("k") % 2 == 0, F.lit("9000"))
    english = F.when(F.col("k") % 2 == 0, F.col("raw_work_mode"))
    job = F.struct(
        F.col("raw_job_title").alias("title"),
        F.col("raw_job_description").alias("description"),
        F.col("raw_posted_date").alias("postedAt"),
        F.struct(s_low.alias("min"), s_high.alias("max"), currency.alias("currency")).alias("salary"),
        keywords.alias("keywords"),
        F.struct(named(F.col("raw_city")).alias("city")).alias("location"),
        F.struct(
            F.lit("shown").alias("displayedName"),
            F.struct(F.struct(english.alias("en")).alias("displayedName")).alias("translations"),
        ).alias("workplaceArrangement"),
        F.when(F.col("k") % 5 > 1, listed(F.col("raw_employment_type")))
        .when(F.col("k") % 5 == 1, listed(F.col("raw_employment_type"), '"plain"'))
        .when(F.col("k") % 10 == 0, "[]")
        .otherwise(listed('"plain"', F.col("raw_employment_type")))
        .alias("workTypes"),
        F.struct(low.alias("min"), high.alias("max")).alias("workExperienceYears"),
        F.struct(named(F.col("raw_qualification")).alias("educationLevel")).alias("candidatePreferences"),
    )
    return raw.select(
        F.col("raw_job_id").alias("job_id"),
        F.col("raw_job_url").alias("job_url"),
        F.when(F.col("k") % 2 == 0, F.col("raw_collected_at")).alias("collected_at"),
        F.when(F.col("k") % 2 == 1, F.col("raw_collected_at")).alias("scraped_at"),
        job.alias("job_attributes"),
        named(F.col("raw_company_name")).alias("company_attributes"),
    )


@check("d1_unify_nested", D1_SQL)
def _(spark, sf_dir):
    return U.unify_nested(nested_raw(raw_postings(spark, sf_dir)))


D2_SQL = f"""{Q.WITH_RAW} SELECT 'Sabbar' AS source, raw_job_id, raw_job_title, raw_company_name, raw_job_description, raw_job_url,
  coalesce(raw_country, 'Saudi Arabia') AS raw_country, raw_city, raw_work_mode, raw_employment_type, raw_experience,
  CAST(NULL AS VARCHAR) AS raw_qualification, CAST(NULL AS VARCHAR) AS raw_skills,
  CASE WHEN k % 7 > 0 THEN CAST(k % 7 AS STRING) || CASE WHEN k % 3 > 0 THEN ' - ' || CAST(k % 3 AS STRING) ELSE '' END
    || CASE WHEN k % 2 = 0 THEN ' USD' ELSE ' SAR' END END AS raw_salary,
  CAST(NULL AS VARCHAR) AS raw_estimated_salary, raw_posted_date, raw_collected_at FROM raw"""


def flat_a_raw(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("raw_job_id").alias("id"), F.col("raw_job_title").alias("title"),
        F.col("raw_company_name").alias("company"), F.col("raw_job_description").alias("description"),
        F.col("raw_job_url").alias("url"), F.col("raw_country").alias("country"), F.col("raw_city").alias("city"),
        F.col("raw_work_mode").alias("workplace_type"), F.col("raw_employment_type").alias("contract_type"),
        F.col("raw_experience").alias("experience_years"), (F.col("k") % 7).cast("string").alias("salary"),
        (F.col("k") % 3).cast("string").alias("max_salary"),
        F.when(F.col("k") % 2 == 0, F.lit("USD")).otherwise("").alias("currency"),
        F.col("raw_posted_date").alias("created_date"), F.col("raw_collected_at").alias("collected_at"),
    )


@check("d2_unify_flat_a", D2_SQL)
def _(spark, sf_dir):
    return U.unify_flat_a(flat_a_raw(raw_postings(spark, sf_dir)))


D3_SQL = f"""{Q.WITH_RAW} SELECT 'Tanqeeb' AS source, raw_job_id, raw_job_title,
  CASE WHEN k % 2 = 0 AND raw_company_name <> '' THEN raw_company_name ELSE 'Other' END AS raw_company_name,
  raw_job_description, raw_job_url, coalesce(raw_country, 'Saudi Arabia') AS raw_country,
  CASE WHEN k % 2 = 0 AND raw_city <> '' THEN raw_city ELSE 'Jeddah' || CAST(k AS STRING) END AS raw_city,
  raw_work_mode, raw_employment_type, nullif(raw_experience, '') AS raw_experience, raw_qualification, raw_skills, raw_salary,
  raw_estimated_salary, raw_posted_date, raw_collected_at FROM raw"""


def flat_b_raw(raw: DataFrame) -> DataFrame:
    even = F.col("k") % 2 == 0
    columns = {k: F.col(v) for k, v in FLAT_B_OF_RAW.items()}
    columns.update(
        id=F.when(even, F.col("raw_job_id")), job_id=F.when(~even, F.col("raw_job_id")),
        company=F.when(even, F.col("raw_company_name")), company_name=F.lit("Other"),
        city=F.when(even, F.col("raw_city")),
        location=F.concat(
            F.when(F.col("k") % 3 == 0, F.lit("Hamra, x, ")).otherwise(""), F.lit("Jeddah"), F.col("k").cast("string")
        ),
        experience_needed=F.lit(None).cast("string"),
    )
    present = set(columns)
    missing = [n for n in S.RAW_FLAT_B.names if n not in present]
    return raw.select(
        *[c.alias(n) for n, c in columns.items()], *[F.lit(None).cast("string").alias(n) for n in missing]
    )


@check("d3_unify_flat_b", D3_SQL)
def _(spark, sf_dir):
    return U.unify_flat_b(flat_b_raw(raw_postings(spark, sf_dir)))


@check(
    "d4_unify",
    f"""{Q.WITH_RAW} SELECT source, count(*) AS n, count(raw_skills) AS skills, count(raw_country) AS countries FROM (
      SELECT 'Wuzzuf' AS source, CASE k % 3 WHEN 2 THEN NULL ELSE 'x' END AS raw_skills, 'x' AS raw_country FROM raw
      UNION ALL SELECT 'Sabbar', NULL, 'x' FROM raw UNION ALL SELECT 'Tanqeeb', raw_skills, 'x' FROM raw) GROUP BY source""",
)
def _(spark, sf_dir):
    raw = raw_postings(spark, sf_dir)
    merged = U.unify(
        U.unify_nested(nested_raw(raw)), U.unify_flat_a(flat_a_raw(raw)).drop("raw_skills"), U.unify_flat_b(flat_b_raw(raw))
    )
    return merged.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count("raw_skills").alias("skills"), F.count("raw_country").alias("countries")
    )


@check(
    "d5_range_text",
    f"""{Q.WITH_RAW} SELECT k, CASE WHEN k % 7 > 0 THEN CAST(k % 7 AS STRING) || CASE WHEN k % 3 > 0 THEN ' - ' || CAST(k % 3 AS STRING) ELSE '' END
         || CASE WHEN k % 2 = 0 THEN ' USD' ELSE ' SAR' END END AS salary,
       CASE WHEN k % 7 > 0 OR k % 3 > 0 THEN CAST(k % 7 AS STRING) || ' - ' || CAST(k % 3 AS STRING) || ' years' END AS years FROM raw""",
)
def _(spark, sf_dir):
    low, high = (F.col("k") % 7).cast("string"), (F.col("k") % 3).cast("string")
    currency = F.when(F.col("k") % 2 == 0, F.lit("USD"))
    return raw_postings(spark, sf_dir).select(
        "k", X.salary_text(low, high, currency).alias("salary"), X.experience_text(low, high).alias("years")
    )


@check(
    "d6_first_truthy",
    f"{Q.WITH_RAW} SELECT k, coalesce(nullif(raw_company_name, ''), nullif(raw_skills, ''), 'none') AS v FROM raw",
)
def _(spark, sf_dir):
    v = X.first_truthy(F.col("raw_company_name"), F.col("raw_skills"), F.lit("none"))
    return raw_postings(spark, sf_dir).select("k", v.alias("v"))


@check(
    "d8_join_names",
    f"""{Q.WITH_RAW} SELECT k, nullif(array_to_string(list_filter([raw_company_name, raw_skills],
      lambda x: x IS NOT NULL AND x <> ''), '; '), '') AS names FROM raw""",
)
def _(spark, sf_dir):
    items = F.array(
        F.struct(F.col("raw_company_name").alias("name")),
        F.lit(None).cast("struct<name:string>"),
        F.struct(F.col("raw_skills").alias("name")),
    )
    return raw_postings(spark, sf_dir).select("k", join_names(items).alias("names"))


@check(
    "d9_city_from_location",
    f"""{Q.WITH_RAW} SELECT k, CASE WHEN raw_city <> '' THEN raw_city
      WHEN raw_country IS NULL THEN '' ELSE trim(split_part(raw_country, ',', -1)) END AS city FROM raw""",
)
def _(spark, sf_dir):
    city = X.city_from_location(F.col("raw_city"), F.col("raw_country"))
    return raw_postings(spark, sf_dir).select("k", city.alias("city"))


# --- validation ---------------------------------------------------------------------------------


@check(
    "e1_is_present",
    f"""SELECT doc_id, lower(trim(head)) NOT IN {Q.EMPTY} AS present FROM (
      SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN ' N/A ' WHEN 1 THEN 'NaN' WHEN 2 THEN '' ELSE text END AS head FROM documents)""",
)
def _(spark, sf_dir):
    d = F.col("doc_id") % 7
    head = F.when(d == 0, F.lit(" N/A ")).when(d == 1, F.lit("NaN")).when(d == 2, F.lit("")).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", X.is_present(head).alias("present"))


@check("e2_not_blank", f"{Q.WITH_RAW} SELECT k, raw_job_url IS NOT NULL AND trim(raw_job_url) <> '' AS filled FROM raw")
def _(spark, sf_dir):
    return raw_postings(spark, sf_dir).select("k", X.not_blank(F.col("raw_job_url")).alias("filled"))


@check("e3_country_ok", f"{Q.WITH_RAW} SELECT k, {Q.RULES['country']} AS ok FROM raw")
def _(spark, sf_dir):
    return raw_postings(spark, sf_dir).select("k", X.country_ok(F.col("raw_country")).alias("ok"))


@check("e4_valid", f"{Q.WITH_RAW} SELECT k FROM raw WHERE {Q.VALID}")
def _(spark, sf_dir):
    return E.split_valid(raw_postings(spark, sf_dir))[0].select("k")


@check("e4_rejected", f"{Q.WITH_RAW} SELECT k, {Q.REASONS} AS reasons FROM raw WHERE NOT ({Q.VALID})")
def _(spark, sf_dir):
    rejected = E.split_valid(raw_postings(spark, sf_dir))[1]
    return rejected.select("k", F.array_join(E.REASONS, ",").alias("reasons"))


@check(
    "e4_reject_counts",
    f"""{Q.WITH_RAW} SELECT reason, count(*) AS rows FROM (
      SELECT unnest(string_split({Q.REASONS}, ',')) AS reason FROM raw WHERE NOT ({Q.VALID})) GROUP BY reason""",
)
def _(spark, sf_dir):
    return E.reject_counts(E.split_valid(raw_postings(spark, sf_dir))[1])


@check("e5_require_rows", f"{Q.WITH_RAW} SELECT source, count(*) AS n FROM raw WHERE {Q.VALID} GROUP BY source")
def _(spark, sf_dir):
    rows = E.require_rows(valid(spark, sf_dir), "valid postings")
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


# --- Silver columns -----------------------------------------------------------------------------


@check("f1_clean_html", f"SELECT page_id, md5(t) AS digest, length(t) AS n FROM (SELECT page_id, {Q.clean_html('html')} AS t FROM pages)")
def _(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "pages")).select("page_id", X.clean_html(F.col("html")).alias("t"))
    return pages.select("page_id", F.md5("t").alias("digest"), F.length("t").cast("bigint").alias("n"))


@check(
    "f2_map_city",
    f"{Q.WITH_CITY} SELECT k, {Q.map_city('raw_city')} AS city FROM raw LEFT JOIN city_names ON lower(trim(raw_city)) = spelling",
)
def _(spark, sf_dir):
    return raw_postings(spark, sf_dir).select("k", X.map_city(F.col("raw_city")).alias("city"))


@check("f3_title_case", f"SELECT doc_id, md5({Q.title_case('text')}) AS digest FROM documents")
def _(spark, sf_dir):
    return spread(table(spark, sf_dir, "documents")).select("doc_id", F.md5(X.title_case(F.col("text"))).alias("digest"))


@check("f4_parse_ts", f"{Q.WITH_RAW} SELECT k, {Q.parse_ts('raw_posted_date')} AS ts FROM raw")
def _(spark, sf_dir):
    return raw_postings(spark, sf_dir).select("k", parse_ts(F.col("raw_posted_date")).alias("ts"))


@check("f5_work_mode", f"{Q.WITH_RAW} SELECT k, {Q.contains_chain('raw_work_mode', V.WORK_MODES, V.WORK_MODE_DEFAULT)} AS v FROM raw")
def _(spark, sf_dir):
    return raw_postings(spark, sf_dir).select("k", C.work_mode(F.col("raw_work_mode")).alias("v"))


@check("f6_employment_type", f"{Q.WITH_RAW} SELECT k, {Q.contains_chain('raw_employment_type', V.EMPLOYMENT_TYPES, V.UNKNOWN)} AS v FROM raw")
def _(spark, sf_dir):
    return raw_postings(spark, sf_dir).select("k", C.employment_type(F.col("raw_employment_type")).alias("v"))


@check("f7_qualification", f"{Q.WITH_RAW} SELECT k, {Q.match_chain('raw_qualification', V.QUALIFICATIONS, V.UNKNOWN)} AS v FROM raw")
def _(spark, sf_dir):
    return raw_postings(spark, sf_dir).select("k", C.qualification(F.col("raw_qualification")).alias("v"))


@check("f8_clean_or", f"{Q.WITH_RAW} SELECT k, {Q.clean_or('raw_company_name', 'Not Specified')} AS a, {Q.clean_or('raw_experience', 'Unknown')} AS b FROM raw")
def _(spark, sf_dir):
    return raw_postings(spark, sf_dir).select(
        "k",
        X.clean_or(F.col("raw_company_name"), V.NOT_SPECIFIED).alias("a"),
        X.clean_or(F.col("raw_experience"), V.UNKNOWN).alias("b"),
    )


@check(
    "f9_with_dates",
    f"""{Q.WITH_RAW}, partly AS (SELECT k, raw_posted_date, CASE WHEN k % 2 = 0 THEN raw_collected_at END AS raw_collected_at FROM raw)
      SELECT k, coalesce({Q.parse_ts('raw_posted_date')}, {Q.parse_ts('raw_collected_at')}, '{Q.NOW}') AS posted_date,
        coalesce({Q.parse_ts('raw_collected_at')}, '{Q.NOW}') AS collected_at FROM partly""",
)
def _(spark, sf_dir):
    stamp = F.when(F.col("k") % 2 == 0, F.col("raw_collected_at"))
    raw = raw_postings(spark, sf_dir).withColumn("raw_collected_at", stamp)
    return P.with_dates(raw, Q.NOW).select("k", "posted_date", "collected_at")


@check(
    "f10_drop_out_of_scope",
    f"{Q.WITH_RAW} SELECT k FROM raw WHERE NOT (contains(raw_job_url, 'jobs-in-egypt') OR coalesce(raw_city, '') IN {Q.values(V.OUT_OF_SCOPE_CITIES)})",
)
def _(spark, sf_dir):
    raw = raw_postings(spark, sf_dir).select(
        "k", F.col("raw_job_url").alias("job_url"), F.coalesce("raw_city", F.lit("")).alias("city")
    )
    return P.drop_out_of_scope(raw).select("k")


@check(
    "f11_job_id",
    f"{Q.WITH_RAW} SELECT k, substr(md5(concat_ws('_', lower(trim(source)), lower(trim(raw_job_url)), lower(trim(raw_job_title)))), 1, 12) AS id FROM raw",
)
def _(spark, sf_dir):
    ident = job_id(F.col("source"), F.col("raw_job_url"), F.col("raw_job_title"))
    return raw_postings(spark, sf_dir).select("k", ident.alias("id"))


@check(
    "f12_latest_by",
    """SELECT doc_id, lang, source, n_chars FROM documents
       QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY n_chars DESC NULLS LAST, doc_id) = 1""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return latest_by(docs, ["lang", "source"], [F.col("n_chars").desc_nulls_last(), F.col("doc_id").asc()])


@check("f12_business_key", f"{Q.WITH_SILVER} SELECT {Q.SILVER_LIST} FROM silver_by_key")
def _(spark, sf_dir):
    staged = P.standardize(valid(spark, sf_dir), Q.NOW)
    return latest_by(staged, P.DEDUP_KEYS, P.latest_first()).select(*S.SILVER_COLUMNS)


@check("f13_job_id_unique", f"{Q.WITH_SILVER} SELECT job_id, collected_at FROM silver")
def _(spark, sf_dir):
    return P.deduplicate(P.standardize(valid(spark, sf_dir), Q.NOW)).select("job_id", "collected_at")


@check("f14_to_silver", f"{Q.WITH_SILVER} SELECT * FROM silver")
def _(spark, sf_dir):
    return silver(spark, sf_dir)


@check(
    "flagship_city_postings",
    f"{Q.WITH_SILVER} SELECT city, count(*) AS postings, count(DISTINCT company_name) AS companies FROM silver GROUP BY city",
)
def _(spark, sf_dir):
    return silver(spark, sf_dir).groupBy("city").agg(
        F.count(F.lit(1)).alias("postings"), F.count_distinct("company_name").alias("companies")
    )


# --- upsert -------------------------------------------------------------------------------------

# Two Silver batches that overlap in time and together hold all postings; those of the second batch
# replace those of the first where ids meet.
EARLY, LATE = "2029-01-01 00:00:00", "2028-01-01 00:00:00"
WITH_TWO = (
    f"{Q.WITH_CITY}, early AS (SELECT * FROM raw WHERE raw_collected_at <= '{EARLY}'), "
    f"later AS (SELECT * FROM raw WHERE raw_collected_at > '{LATE}'), {Q.silver_from('s1', 'early')}, {Q.silver_from('s2', 'later')}"
)
MERGED = "SELECT * FROM s1 WHERE job_id NOT IN (SELECT job_id FROM s2) UNION ALL SELECT * FROM s2"


def two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    raw = raw_postings(spark, sf_dir)
    parts = (raw.filter(F.col("raw_collected_at") <= EARLY), raw.filter(F.col("raw_collected_at") > LATE))
    return tuple(P.silver_batch(part, Q.NOW)[0] for part in parts)


@check("g1_merge_upsert", f"{WITH_TWO} {MERGED}")
def _(spark, sf_dir):
    target, source = two_batches(spark, sf_dir)
    return M.merge_upsert(target, source, ["job_id"])


@check(
    "g2_merge_insert",
    f"""{WITH_TWO}, t AS (SELECT DISTINCT company_name, nullif(city, 'Unknown') AS city FROM s1),
      s AS (SELECT DISTINCT company_name, nullif(city, 'Unknown') AS city FROM s2)
      SELECT *, 1 AS loaded FROM t UNION ALL SELECT *, NULL FROM s WHERE NOT EXISTS (
        SELECT 1 FROM t WHERE t.company_name = s.company_name AND t.city IS NOT DISTINCT FROM s.city)""",
)
def _(spark, sf_dir):
    keys = ["company_name", "city"]
    t, s = (
        b.select("company_name", F.nullif("city", F.lit("Unknown")).alias("city")).distinct()
        for b in two_batches(spark, sf_dir)
    )
    return M.merge_insert(t.withColumn("loaded", F.lit(1)), s, keys, null_safe=True)


@check(
    "g3_merge_set_cols",
    f"""{WITH_TWO} SELECT coalesce(a.job_id, b.job_id) AS job_id, CASE WHEN a.job_id IS NULL THEN b.salary ELSE a.salary END AS salary,
      CASE WHEN b.job_id IS NULL THEN a.skills ELSE b.skills END AS skills FROM s1 a FULL JOIN s2 b ON a.job_id = b.job_id""",
)
def _(spark, sf_dir):
    target, source = (b.select("job_id", "salary", "skills") for b in two_batches(spark, sf_dir))
    return M.merge_upsert(target, source, ["job_id"], set_cols=["skills"])


@check(
    "g4_merge_metrics",
    f"""{WITH_TWO} SELECT count(*) FILTER (job_id NOT IN (SELECT job_id FROM s1)) AS rows_inserted,
      count(*) FILTER (job_id IN (SELECT job_id FROM s1)) AS rows_updated FROM s2""",
)
def _(spark, sf_dir):
    target, source = two_batches(spark, sf_dir)
    return M.merge_metrics(target, source, ["job_id"])


@check("g5_upsert_table", f"{WITH_TWO} {MERGED}")
def _(spark, sf_dir):
    """First load, a second batch, and the second batch once more, on a stored table."""
    path = scratch(spark)
    first, second = two_batches(spark, sf_dir)
    for batch in (first, second, second):
        B.upsert_table(spark, path, batch, ["job_id"], buckets=4)
    return B.read_keyed(spark, path, S.SILVER)


# --- quality ------------------------------------------------------------------------------------


def _one(check_name: str, violations: str) -> str:
    return f"SELECT '{check_name}' AS check, v = 0 AS passed, CAST(v AS BIGINT) AS violations FROM (SELECT {violations})"


@check("h1_nonempty", f"{Q.WITH_RAW} {_one('nonempty', 'CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS v FROM raw')}")
def _(spark, sf_dir):
    return H.check_nonempty(bronze(spark, sf_dir))


@check("h2_unique", f"{Q.WITH_RAW} {_one('unique:raw_job_url', 'count(*) - count(DISTINCT raw_job_url) AS v FROM raw')}")
def _(spark, sf_dir):
    return H.check_unique(bronze(spark, sf_dir), "raw_job_url")


@check("h3_duplicate_groups", f"{Q.WITH_RAW} SELECT raw_job_url, raw_city, count(*) AS n FROM raw GROUP BY ALL HAVING count(*) > 1")
def _(spark, sf_dir):
    return H.duplicate_groups(bronze(spark, sf_dir), ["raw_job_url", "raw_city"])


HEAL_KEYS = ["job_title", "company_name", "city", "posted_date"]


@check(
    "h4_heal_duplicates",
    f"{Q.WITH_SILVER}, twice AS (SELECT * FROM silver_staged UNION ALL SELECT * REPLACE ("
    f"'3' || substr(collected_at, 2) AS collected_at, job_url || '#later' AS job_url) FROM silver_staged) "
    f"SELECT job_title, company_name, city, posted_date, max(collected_at) AS collected_at, "
    f"true AS later FROM twice GROUP BY ALL",
)
def _(spark, sf_dir):
    """Every posting comes again, collected a thousand years later; the later row is the one that stays."""
    staged = P.standardize(valid(spark, sf_dir), Q.NOW)
    later = {"collected_at": F.concat(F.lit("3"), F.substring("collected_at", 2, 99)), "job_url": F.concat("job_url", F.lit("#later"))}
    twice = staged.unionByName(staged.withColumns(later))
    ones = H.heal_duplicates(twice)
    again = F.col("job_url").endswith("#later").alias("later")
    return ones.select(*HEAL_KEYS, "collected_at", again)


@check(
    "h5_not_blank",
    f"{Q.WITH_RAW} "
    + " UNION ALL ".join(
        _one(f"not_blank:{c}", f"count(*) FILTER ({c} IS NULL OR trim({c}) = '') AS v FROM raw")
        for c in ["source", "raw_job_title", "raw_job_url", "raw_city"]
    ),
)
def _(spark, sf_dir):
    return H.check_not_blank(bronze(spark, sf_dir), ["source", "raw_job_title", "raw_job_url", "raw_city"])


@check(
    "h6_domain",
    f"{Q.WITH_RAW} {_one('domain:raw_country', chr(39).join(['count(*) FILTER (raw_country NOT IN (', 'Saudi Arabia', ', ', 'KSA', ')) AS v FROM raw']))}",
)
def _(spark, sf_dir):
    return H.check_domain(bronze(spark, sf_dir), "raw_country", ["Saudi Arabia", "KSA"])


@check(
    "h7_silver_gate",
    f"{Q.WITH_SILVER} "
    + " UNION ALL ".join(
        [
            _one("nonempty", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS v FROM silver"),
            _one("unique:job_id", "count(*) - count(DISTINCT job_id) AS v FROM silver"),
            *[_one(f"not_blank:{c}", f"count(*) FILTER ({c} IS NULL OR trim({c}) = '') AS v FROM silver") for c in H.MANDATORY],
            _one("domain:country", "count(*) FILTER (country <> 'Saudi Arabia') AS v FROM silver"),
        ]
    ),
)
def _(spark, sf_dir):
    """The whole gate; it would raise before returning if a check failed."""
    checks = H.silver_checks(silver(spark, sf_dir))
    H.enforce(checks)
    return checks


@check("h8_fk", _one("fk:l_suppkey", "count(*) AS v FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)"))
def _(spark, sf_dir):
    held = table(spark, sf_dir, "supplier").filter("s_acctbal > 0")
    return H.check_fk(table(spark, sf_dir, "lineitem"), held, "l_suppkey", "s_suppkey")


@check(
    "h9_pk",
    _one("pk:part_supplier", "count(*) AS v FROM (SELECT l_partkey, l_suppkey FROM lineitem GROUP BY ALL HAVING count(*) > 1 OR l_partkey IS NULL OR l_suppkey IS NULL)"),
)
def _(spark, sf_dir):
    return H.check_pk(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], "part_supplier")
