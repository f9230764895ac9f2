"""Gold, serving and streaming queries."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import sql as Q
from checks.bronze_silver import CTX, FLAT_B_OF_RAW, array_files, landed, silver
from checks.postings import raw_postings
from checks.registry import check, scratch, table
from vacancia import fixed_values as V
from vacancia import schemas as S
from vacancia.context import materialize
from vacancia.functions.dates import date_key
from vacancia.operators import dims as D
from vacancia.operators import serving as J
from vacancia.operators.keys import assign_keys
from vacancia.plans import gold as G
from vacancia.plans.silver import load_pending
from vacancia.sources.tables import read_keyed, read_table
from vacancia.streaming import ingest as K

CUTOFF = "2028-03-01 00:00:00"
# Bronze columns of postings that landed as records of flat portal B.
LANDED_LIST = ", ".join(
    {
        "source": "'Tanqeeb' AS source",
        "raw_company_name": "nullif(raw_company_name, '') AS raw_company_name",
        "raw_country": "coalesce(raw_country, 'Saudi Arabia') AS raw_country",
        "raw_city": "coalesce(raw_city, '') AS raw_city",
        "raw_experience": "nullif(raw_experience, '') AS raw_experience",
    }.get(name, name)
    for name in S.BRONZE_COLUMNS
)


def star(spark: SparkSession, sf_dir: str) -> G.Gold:
    """The star schema after a first load of the whole Silver."""
    return star_and_silver(spark, sf_dir)[0]


def star_and_silver(spark: SparkSession, sf_dir: str) -> tuple[G.Gold, DataFrame]:
    """The star schema and the Silver rows it was loaded from, which are derived once."""
    rows = materialize(silver(spark, sf_dir))
    return G.load_increment(rows, G.empty_gold(spark)), rows


# --- increment ----------------------------------------------------------------------------------


@check("i1_since", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00'")
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return D.since(events, "ts", datetime(2024, 1, 16), timedelta(hours=12)).select("event_id")


@check("i1_since_text", f"{Q.WITH_RAW} SELECT k FROM raw WHERE raw_collected_at > '{CUTOFF}'")
def _(spark, sf_dir):
    raw = raw_postings(spark, sf_dir)
    return D.since(raw, "raw_collected_at", datetime(2028, 3, 1)).select("k")


@check(
    "i2_advance_watermark",
    f"""{Q.WITH_RAW} SELECT 'other' AS pipeline_name, '2020-01-01 00:00:00' AS last_loaded_at
      UNION ALL SELECT '{V.PIPELINE_NAME}', max(raw_collected_at) FROM raw""",
)
def _(spark, sf_dir):
    old = datetime(2020, 1, 1)
    control = spark.createDataFrame([("other", old), (V.PIPELINE_NAME, old)], S.WATERMARK)
    moved = D.advance_watermark(control, raw_postings(spark, sf_dir), "raw_collected_at")
    return moved.select("pipeline_name", F.date_format("last_loaded_at", "yyyy-MM-dd HH:mm:ss").alias("last_loaded_at"))


@check(
    "i3_col_or_default",
    f"{Q.WITH_RAW} SELECT k, coalesce(raw_experience, 'N/A') AS experience, 'N/A' AS category FROM raw",
)
def _(spark, sf_dir):
    raw = raw_postings(spark, sf_dir)
    return raw.select(
        "k",
        D.col_or_default(raw, "raw_experience").alias("experience"),
        D.col_or_default(raw, "job_category").alias("category"),
    )


@check(
    "i14_unified_id",
    f"{Q.WITH_RAW} SELECT k, try_cast(raw_estimated_salary AS INT) AS present, CAST(NULL AS INT) AS absent FROM raw",
)
def _(spark, sf_dir):
    raw = raw_postings(spark, sf_dir)
    return raw.select(
        "k",
        D.col_or_default(raw, "raw_estimated_salary", None, "int").alias("present"),
        D.col_or_default(raw, "unified_job_id", None, "int").alias("absent"),
    )


# --- dimensions ---------------------------------------------------------------------------------

# Two loads: Silver rows up to the cut-off, then the others.
WITH_LOADS = (
    f"{Q.WITH_SILVER}, prepared AS ({Q.PREPARED} silver), "
    f"one AS (SELECT * FROM prepared WHERE collected_at <= '{CUTOFF}'), "
    f"two AS (SELECT * FROM prepared WHERE collected_at > '{CUTOFF}')"
)


def grown(name: str, key: str, natural: list[str], picked: str, keep_null: bool = False) -> str:
    """CTEs of a dimension after both loads."""
    filled = "" if keep_null else f" WHERE {picked.split(' AS ')[0]} IS NOT NULL"
    cols = ", ".join(natural)
    first = f"SELECT DISTINCT {picked} FROM one{filled}"
    fresh = f"SELECT DISTINCT {picked} FROM two{filled} EXCEPT SELECT {cols} FROM {name}_one"
    return (
        f"{name}_one AS ({Q.numbered(key, natural, first)}), "
        f"{name} AS (SELECT {key}, {cols} FROM {name}_one UNION ALL "
        f"{Q.numbered(key, natural, fresh, f'(SELECT count(*) FROM {name}_one)')})"
    )


SOURCE_SQL = grown("dim_source", "source_key", ["source_name"], "source AS source_name")
COMPANY_SQL = grown("dim_company", "company_key", ["company_name"], "company_name")
LOCATION_SQL = grown("dim_location", "location_key", ["country", "city"], "country, city", True)
JOB_SQL = grown("dim_job", "job_key", Q.JOB, Q.JOB_LIST, True)


def loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = materialize(silver(spark, sf_dir))
    return tuple(D.prepare(rows.filter(f"collected_at {op} '{CUTOFF}'")) for op in ("<=", ">"))


def twice(spark, sf_dir, name: str, pick, natural: list[str], key: str, null_safe: bool = False) -> DataFrame:
    dim = spark.createDataFrame([], G.SCHEMAS[name])
    for rows in loads(spark, sf_dir):
        dim = D.extend_dim(dim, pick(rows), natural, key, null_safe)
    return dim


@check("i4_dim_source", f"{WITH_LOADS}, {SOURCE_SQL} SELECT source_key, source_name FROM dim_source")
def _(spark, sf_dir):
    def pick(rows):
        return D.dim_members(rows.select(F.col("source").alias("source_name")), ["source_name"])

    return twice(spark, sf_dir, "source", pick, ["source_name"], "source_key")


@check("i4_dim_company", f"{WITH_LOADS}, {COMPANY_SQL} SELECT company_key, company_name FROM dim_company")
def _(spark, sf_dir):
    dim = twice(spark, sf_dir, "company", D.company_members, ["company_name"], "company_key")
    return dim.select("company_key", "company_name")


@check("i4_dim_skill", f"{Q.WITH_STAR} SELECT skill_key, skill_name FROM dim_skill")
def _(spark, sf_dir):
    names = D.dim_members(D.explode_skills(silver(spark, sf_dir).select("skills")), ["skill_name"])
    dim = spark.createDataFrame([], S.DIM_SKILL)
    return D.extend_dim(dim, names, ["skill_name"], "skill_key").select("skill_key", "skill_name")


@check("i5_dim_location", f"{WITH_LOADS}, {LOCATION_SQL} SELECT location_key, country, city FROM dim_location")
def _(spark, sf_dir):
    cols = ["country", "city"]
    return twice(spark, sf_dir, "location", lambda r: D.dim_members(r, cols, True), cols, "location_key", True)


@check("i5_dim_job", f"{WITH_LOADS}, {JOB_SQL} SELECT job_key, {Q.JOB_LIST} FROM dim_job")
def _(spark, sf_dir):
    cols = S.JOB_ATTRIBUTES
    return twice(spark, sf_dir, "job", lambda r: D.dim_members(r, cols, True), cols, "job_key", True)


@check(
    "i5_null_safe_members",
    f"""{Q.WITH_RAW}, m AS (SELECT DISTINCT raw_city, raw_work_mode FROM raw)
      SELECT row_number() OVER (ORDER BY raw_city NULLS FIRST, raw_work_mode NULLS FIRST) AS key, raw_city, raw_work_mode FROM m""",
)
def _(spark, sf_dir):
    """Nulls are members of their own; loading the same members again adds none."""
    cols = ["raw_city", "raw_work_mode"]
    members = D.dim_members(raw_postings(spark, sf_dir), cols, keep_null=True)
    empty = spark.createDataFrame([], "key bigint, raw_city string, raw_work_mode string")
    dim = D.extend_dim(empty, members, cols, "key", null_safe=True)
    return D.extend_dim(dim, members, cols, "key", null_safe=True)


@check(
    "i6_dim_date",
    """SELECT DISTINCT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, strftime(d, '%Y-%m-%d') AS date, CAST(year(d) AS INT) AS year,
         CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day, CAST(quarter(d) AS INT) AS quarter, dayname(d) AS day_of_week
       FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def _(spark, sf_dir):
    days = D.dim_date(table(spark, sf_dir, "orders"), "o_orderdate")
    return days.withColumn("date", F.col("date").cast("string"))


@check("i7_date_key", f"{Q.WITH_SILVER} SELECT job_id, CAST(strftime(CAST(posted_date AS DATE), '%Y%m%d') AS BIGINT) AS posted_date_key FROM silver")
def _(spark, sf_dir):
    return silver(spark, sf_dir).select("job_id", date_key(F.col("posted_date")).alias("posted_date_key"))


# --- facts and links ----------------------------------------------------------------------------


@check("i8_resolve_keys", f"{Q.WITH_STAR} SELECT * FROM ({Q.candidates()})")
def _(spark, sf_dir):
    gold, rows = star_and_silver(spark, sf_dir)
    return D.resolve_keys(D.prepare(rows), gold.dims)


@check(
    "i9_new_facts",
    f"{Q.WITH_STAR} SELECT source_key, job_id, posted_date_key FROM fact WHERE posted_date_key >= 20280101",
)
def _(spark, sf_dir):
    facts = star(spark, sf_dir).fact
    candidates = facts.select("source_key", "job_id", "posted_date_key")
    return D.new_facts(candidates, facts.filter("posted_date_key < 20280101"))


FACT_LIST = (
    "job_posting_key, job_key, job_id, unified_job_id, company_key, location_key, source_key, posted_date_key, "
    "CAST(NULL AS INT) AS source_job_key, job_url, salary, estimated_salary AS AI_salary"
)


@check("i10_to_fact", f"{Q.WITH_STAR} SELECT {FACT_LIST} FROM fact")
def _(spark, sf_dir):
    return star(spark, sf_dir).fact.select(*S.FACT.names)


@check("i11_explode_skills", f"{Q.WITH_STAR} SELECT job_posting_key, skill_name FROM skill_rows")
def _(spark, sf_dir):
    gold, rows = star_and_silver(spark, sf_dir)
    posted = gold.fact.select("job_posting_key", "job_id").join(rows.select("job_id", "skills"), "job_id")
    return D.explode_skills(posted.select("job_posting_key", "skills"))


@check("i12_bridge", f"{Q.WITH_STAR} SELECT job_posting_key, skill_key FROM links")
def _(spark, sf_dir):
    """The links of one skill exist already; the bridge adds the others."""
    gold, rows = star_and_silver(spark, sf_dir)
    posted = gold.fact.select("job_posting_key", "job_id").join(rows.select("job_id", "skills"), "job_id")
    skills = D.explode_skills(posted.select("job_posting_key", "skills"))
    held = gold.links.filter("skill_key = 1")
    return held.unionByName(D.bridge(skills, gold.dims["skill"], held))


TWO_LOADS = f"""{WITH_LOADS}, {SOURCE_SQL}, {COMPANY_SQL}, {LOCATION_SQL}, {JOB_SQL},
fact_one AS ({Q.numbered('job_posting_key', ['source_key', 'job_id'], Q.candidates('one'))}),
fact_two AS ({Q.numbered('job_posting_key', ['source_key', 'job_id'], Q.candidates('two'), '(SELECT count(*) FROM fact_one)')}),
fact AS (SELECT * FROM fact_one UNION ALL SELECT * FROM fact_two),
skill_rows AS ({Q.skill_rows('fact')})"""


def two_loads(spark: SparkSession, sf_dir: str) -> G.Gold:
    """Stored star schema: rows up to the cut-off, then the whole Silver, then the same again."""
    folder, rows = scratch(spark), materialize(silver(spark, sf_dir))
    G.load_gold(rows.filter(f"collected_at <= '{CUTOFF}'"), folder)
    G.load_gold(rows, folder)
    return G.load_gold(rows, folder)


@check(
    "i13_load_gold",
    f"""{TWO_LOADS} SELECT f.job_posting_key, f.job_id, f.source_key, f.company_key, f.location_key, f.job_key, f.posted_date_key,
      count(s.skill_name) AS skills FROM fact f LEFT JOIN skill_rows s ON f.job_posting_key = s.job_posting_key GROUP BY ALL""",
)
def _(spark, sf_dir):
    gold = two_loads(spark, sf_dir)
    per_posting = gold.links.groupBy("job_posting_key").agg(F.count(F.lit(1)).alias("skills"))
    return gold.fact.join(per_posting, "job_posting_key", "left").select(
        "job_posting_key", "job_id", "source_key", "company_key", "location_key", "job_key", "posted_date_key",
        F.coalesce("skills", F.lit(0)).alias("skills"),
    )


@check(
    "i13_load_gold_tables",
    f"""{TWO_LOADS} SELECT 'source' AS table_name, count(*) AS rows FROM dim_source UNION ALL SELECT 'company', count(*) FROM dim_company
      UNION ALL SELECT 'location', count(*) FROM dim_location UNION ALL SELECT 'job', count(*) FROM dim_job
      UNION ALL SELECT 'date', count(DISTINCT posted_date_key) FROM fact UNION ALL SELECT 'skill', count(DISTINCT skill_name) FROM skill_rows
      UNION ALL SELECT 'fact', count(*) FROM fact UNION ALL SELECT 'links', count(*) FROM skill_rows UNION ALL SELECT 'watermark', 2""",
)
def _(spark, sf_dir):
    gold = two_loads(spark, sf_dir)
    return J.profile({**gold.dims, "fact": gold.fact, "links": gold.links, "watermark": gold.watermark})


@check(
    "i15_assign_keys",
    """SELECT 1000 + row_number() OVER (ORDER BY l_shipdate NULLS FIRST, l_orderkey, l_linenumber) AS key, l_orderkey, l_linenumber FROM lineitem""",
)
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber")
    keyed = assign_keys(lines, ["l_shipdate", "l_orderkey", "l_linenumber"], "key", 1000)
    return keyed.select("key", "l_orderkey", "l_linenumber")


# --- serving ------------------------------------------------------------------------------------

VIEW_SQL = """view_rows AS (SELECT f.job_url, f.job_id, j.job_title, c.company_name, l.city, s.source_name, f.posted_date_key
  FROM fact f LEFT JOIN dim_job j USING (job_key) LEFT JOIN dim_company c USING (company_key)
  LEFT JOIN dim_location l USING (location_key) LEFT JOIN dim_source s USING (source_key) WHERE f.job_url IS NOT NULL)"""


@check("j1_serving_view", f"{Q.WITH_STAR}, {VIEW_SQL} SELECT * FROM view_rows")
def _(spark, sf_dir):
    gold = star(spark, sf_dir)
    return J.serving_view(gold.fact, gold.dims)


def _demand_sql(name: str, dim: str, key: str, extra: str = "") -> str:
    return f"""{Q.WITH_STAR} SELECT coalesce({name}, '(none)') AS {name}, count(*) AS postings, count(DISTINCT company_key) AS companies
      FROM fact f {extra} LEFT JOIN {dim} d USING ({key}) GROUP BY 1"""


@check("j2_demand_city", _demand_sql("city", "dim_location", "location_key"))
def _(spark, sf_dir):
    gold = star(spark, sf_dir)
    return J.demand(gold.fact, gold.dims, "city")


@check("j2_demand_company", _demand_sql("company_name", "dim_company", "company_key"))
def _(spark, sf_dir):
    gold = star(spark, sf_dir)
    return J.demand(gold.fact, gold.dims, "company")


@check("j2_demand_source", _demand_sql("source_name", "dim_source", "source_key"))
def _(spark, sf_dir):
    gold = star(spark, sf_dir)
    return J.demand(gold.fact, gold.dims, "source")


@check("j2_demand_skill", _demand_sql("skill_name", "dim_skill", "skill_key", "LEFT JOIN links USING (job_posting_key)"))
def _(spark, sf_dir):
    gold = star(spark, sf_dir)
    return J.demand(gold.fact, gold.dims, "skill", gold.links)


@check(
    "j3_browse",
    f"{Q.WITH_STAR}, {VIEW_SQL} SELECT * FROM view_rows WHERE city = 'Riyadh' AND source_name ILIKE '%wuz%' "
    "AND (job_title ILIKE '%build%' OR company_name ILIKE '%build%')",
)
def _(spark, sf_dir):
    gold = star(spark, sf_dir)
    view = J.serving_view(gold.fact, gold.dims, ordered=False)
    return J.browse(view, city="Riyadh", source="%wuz%", text="build")


@check(
    "j3_browse_literal",
    f"{Q.WITH_STAR}, {VIEW_SQL}, marked AS (SELECT * REPLACE (CASE length(job_id || job_url) % 3 WHEN 0 THEN job_title || ' 100%_A' "
    "WHEN 1 THEN job_title || ' 1000xA' ELSE job_title END AS job_title) FROM view_rows) "
    "SELECT * FROM marked WHERE contains(lower(job_title), '100%_a') OR contains(lower(company_name), '100%_a')",
)
def _(spark, sf_dir):
    """Per cent signs and underscores of the searched text stand for themselves."""
    gold = star(spark, sf_dir)
    view = J.serving_view(gold.fact, gold.dims, ordered=False)
    kind = F.length(F.concat("job_id", "job_url")) % 3
    title = F.when(kind == 0, F.concat("job_title", F.lit(" 100%_A"))).when(kind == 1, F.concat("job_title", F.lit(" 1000xA")))
    return J.browse(view.withColumn("job_title", F.coalesce(title, "job_title")), text="100%_a")


@check("j4_duplicate_report", f"{Q.WITH_RAW} SELECT raw_job_url, count(*) AS n FROM raw GROUP BY 1 HAVING count(*) > 1")
def _(spark, sf_dir):
    return J.duplicate_report(raw_postings(spark, sf_dir), "raw_job_url")


@check(
    "j5_profile",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in ("orders", "pages", "events", "documents")),
)
def _(spark, sf_dir):
    return J.profile({t: table(spark, sf_dir, t) for t in ("orders", "pages", "events", "documents")})


# --- streaming ----------------------------------------------------------------------------------


@check("k1_ingest_stream", f"{Q.WITH_RAW} SELECT {LANDED_LIST} FROM raw")
def _(spark, sf_dir):
    """Two runs over one landing folder: the second finds nothing new."""
    landing, path, state = landed(spark, sf_dir), scratch(spark), scratch(spark)
    for _run in range(2):
        rows = K.bronze_stream(spark, landing, V.FILE_PREFIXES[2], pattern="*.txt")
        K.bronze_writer(rows, path, state, CTX, "landing").awaitTermination()
    stored = read_table(spark, path, S.BRONZE)
    return stored.select(*S.BRONZE_COLUMNS)


STREAM_SQL = (
    f"{Q.WITH_CITY}, landed AS (SELECT * REPLACE ('Tanqeeb' AS source, coalesce(raw_country, 'Saudi Arabia') AS raw_country, "
    "nullif(raw_experience, '') AS raw_experience, nullif(raw_company_name, '') AS raw_company_name) FROM raw), "
    f"{Q.silver_from('silver', 'landed')}"
)


@check(
    "a4_batch_lifecycle",
    """SELECT unnest(['first run', 'second run', 'records', 'broken', 'cut off']) AS what, unnest([
         count(*) FILTER (o_orderkey // 1000 % 2 = 0 AND o_orderkey % 50 <> 7),
         count(*) FILTER (o_orderkey // 1000 % 2 = 0 AND o_orderkey % 50 <> 7), count(*) FILTER (o_orderkey % 50 <> 7),
         count(*) FILTER (o_orderkey % 50 = 7), count(DISTINCT o_orderkey // 1000) FILTER (o_orderkey // 1000 % 5 = 1)]) AS n
       FROM orders""",
)
def _(spark, sf_dir):
    """Half the files land, a run finds nothing new, the others land; some records and files are damaged."""
    landing, path, bad, state = scratch(spark), scratch(spark), scratch(spark), scratch(spark)
    raw = raw_postings(spark, sf_dir).select("k", *[F.col(v).alias(n) for n, v in FLAT_B_OF_RAW.items()])
    even = F.floor(F.col("k") / 1000) % 2 == 0
    counts = []
    for wave in (raw.filter(even), None, raw.filter(~even)):
        if wave is not None:
            array_files(wave, landing, damaged=True)
        K.load_landing(spark, landing, V.FILE_PREFIXES[2], path, bad, state, CTX, pattern="*.txt").awaitTermination()
        counts.append(read_table(spark, path, S.BRONZE).count())
    rows = spark.createDataFrame(list(zip(("first run", "second run", "records"), counts)), "what string, n long")
    lost = spark.read.parquet(bad).groupBy(F.col("reason").alias("what")).agg(F.count(F.lit(1)).alias("n"))
    return rows.unionByName(lost)


@check("k2_upsert_stream", f"{STREAM_SQL} SELECT * FROM silver")
def _(spark, sf_dir):
    """Landing files to Silver by stream."""
    landing, path, rejected, state = landed(spark, sf_dir), scratch(spark), scratch(spark), scratch(spark)
    rows = K.bronze_stream(spark, landing, V.FILE_PREFIXES[2], pattern="*.txt")
    K.upsert_stream(rows, path, rejected, state, CTX, buckets=4).awaitTermination()
    return read_keyed(spark, path, S.SILVER)


@check("k1_landed_to_silver", f"{STREAM_SQL} SELECT * FROM silver")
def _(spark, sf_dir):
    """Files land on two days and are registered as batches; Silver takes both at once, and nothing the second time."""
    landing, path, bad, state, silver_path, rejected = (scratch(spark) for _ in range(6))
    raw = raw_postings(spark, sf_dir).select("k", *[F.col(v).alias(n) for n, v in FLAT_B_OF_RAW.items()])
    even = F.floor(F.col("k") / 1000) % 2 == 0
    for day, wave in (("2030-01-02", raw.filter(even)), ("2030-01-03", raw.filter(~even))):
        array_files(wave, landing)
        ctx = replace(CTX, load_date=day)
        K.load_landing(spark, landing, V.FILE_PREFIXES[2], path, bad, state, ctx, pattern="*.txt").awaitTermination()
    for _again in range(2):
        load_pending(spark, path, silver_path, rejected, CTX, buckets=4)
    return read_keyed(spark, silver_path, S.SILVER)


@check("k3_dedup_stream", "SELECT DISTINCT CAST(user_id AS STRING) || event_type AS job_id FROM events")
def _(spark, sf_dir):
    path, state = scratch(spark), scratch(spark)
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    keyed = events.select(
        F.concat(F.col("user_id").cast("string"), "event_type").alias("job_id"),
        F.col("ts").cast("timestamp").alias("collected_ts"),
    )
    query = K.dedup_stream(keyed, "60 days").writeStream.format("parquet").option("path", path)
    query.option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    stored = T.StructType([T.StructField("job_id", T.StringType()), T.StructField("collected_ts", T.TimestampType())])
    return spark.read.schema(stored).parquet(path).select("job_id")
