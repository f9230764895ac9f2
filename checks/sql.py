"""DuckDB building blocks of the SQL twins."""

from __future__ import annotations

from checks.postings import RAW_SQL
from vacancia import fixed_values as V
from vacancia import schemas as S

EMPTY = "('', 'n/a', 'nan', 'none', 'null')"
DENIED = "('', 'n/a', 'nan', 'none', 'null', 'egypt', 'cairo', 'us', 'usa')"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def values(items: list[str]) -> str:
    return "(" + ", ".join(text(i) for i in items) + ")"


def clean_html(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace({x}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"


def clean_or(x: str, default: str) -> str:
    return f"coalesce(nullif({clean_html(x)}, ''), '{default}')"


def title_case(x: str) -> str:
    runs = f"regexp_extract_all({x}, '[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+')"
    return (
        f"array_to_string(list_transform({runs}, "
        "lambda r: replace(upper(r[1]), 'ẞ', 'Ss') || lower(r[2:])), '')"
    )


def parse_ts(x: str) -> str:
    c = f"trim({x})"
    time, first = f"left({c}, 19)", f"try_cast(split_part({c}, '/', 1) AS INT)"
    return f"""strftime(coalesce(
      CASE WHEN contains({c}, 'T') THEN try_strptime(replace({time}, 'T', ' '), '%Y-%m-%d %H:%M:%S') END,
      CASE WHEN regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_strptime({time}, '%Y-%m-%d %H:%M:%S') END,
      CASE WHEN regexp_matches({c}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') THEN
        CASE WHEN {first} > 12 THEN try_strptime({time}, '%d/%m/%Y %H:%M:%S')
             ELSE try_strptime({time}, '%m/%d/%Y %H:%M:%S') END END,
      CASE WHEN regexp_matches({c}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN
        CASE WHEN {first} > 12 THEN try_strptime({c}, '%d/%m/%Y') ELSE try_strptime({c}, '%m/%d/%Y') END END,
      CASE WHEN regexp_matches({c}, '^\\d{{13}}$') THEN make_timestamp(CAST({c} AS BIGINT) * 1000) END,
      CASE WHEN regexp_matches({c}, '^\\d{{10}}$') THEN make_timestamp(CAST({c} AS BIGINT) * 1000000) END,
      try_cast({c} AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S')"""


def contains_chain(x: str, rules: list[tuple[str, str]], default: str) -> str:
    whens = " ".join(f"WHEN contains(lower({x}), {text(w)}) THEN {text(v)}" for w, v in rules)
    return f"CASE {whens} ELSE {text(default)} END"


def match_chain(x: str, rules: list[tuple[str, str]], default: str) -> str:
    whens = " ".join(f"WHEN regexp_matches(lower({x}), {text(w)}) THEN {text(v)}" for w, v in rules)
    return f"CASE {whens} ELSE {text(default)} END"


RULES = {
    "title": f"raw_job_title IS NOT NULL AND lower(trim(raw_job_title)) NOT IN {EMPTY}",
    "url": "raw_job_url IS NOT NULL AND trim(raw_job_url) <> ''",
    "source": "source IS NOT NULL AND trim(source) <> ''",
    "description": f"raw_job_description IS NOT NULL AND lower(trim(raw_job_description)) NOT IN {EMPTY}",
    "collected_at": "raw_collected_at IS NOT NULL AND trim(raw_collected_at) <> ''",
    "country": f"raw_country IS NOT NULL AND lower(trim(raw_country)) NOT IN {DENIED} "
    f"AND regexp_matches(lower(trim(raw_country)), '{V.COUNTRY_PATTERN}')",
}
VALID = " AND ".join(f"({r})" for r in RULES.values())
REASONS = (
    "array_to_string(list_filter(["
    + ", ".join(f"CASE WHEN NOT ({r}) THEN '{n}' END" for n, r in RULES.items())
    + "], lambda r: r IS NOT NULL), ',')"
)

CITY_SQL = "city_names(spelling, name) AS (VALUES " + ", ".join(
    f"({text(k)}, {text(v)})" for k, v in V.CITY_NAMES.items()
) + ")"


def map_city(x: str, name: str = "name") -> str:
    """City of a text once `city_names` is left-joined on its lower-cased, trimmed form."""
    return (
        f"CASE WHEN {x} IS NULL OR lower(trim({x})) IN ('n/a', 'unknown', 'none', '', 'nan') "
        f"THEN 'Unknown' ELSE coalesce({name}, {title_case(f'trim({x})')}) END"
    )


NOW = "2031-01-01 00:00:00"


def staged_from(table: str) -> str:
    """Standardized rows, before deduplication."""
    return f"""
      SELECT md5_id AS job_id, * EXCLUDE (md5_id) FROM (
        SELECT *, substr(md5(concat_ws('_', lower(trim(source)), lower(trim(job_url)), lower(trim(job_title)))), 1, 12) AS md5_id
        FROM (
          SELECT source, {clean_html('raw_job_title')} AS job_title,
            {clean_or('raw_company_name', 'Not Specified')} AS company_name,
            {clean_or('raw_job_description', 'Not Specified')} AS job_description,
            trim(raw_job_url) AS job_url, 'Saudi Arabia' AS country,
            {map_city('raw_city')} AS city,
            {contains_chain('raw_work_mode', V.WORK_MODES, V.WORK_MODE_DEFAULT)} AS work_mode,
            {contains_chain('raw_employment_type', V.EMPLOYMENT_TYPES, V.UNKNOWN)} AS employment_type,
            {clean_or('raw_experience', 'Unknown')} AS experience_needed,
            {match_chain('raw_qualification', V.QUALIFICATIONS, V.UNKNOWN)} AS qualification_required,
            {clean_or('raw_skills', 'Not Specified')} AS skills,
            {clean_or('raw_salary', 'Not Specified')} AS salary,
            {clean_or('raw_estimated_salary', 'Not Specified')} AS estimated_salary,
            coalesce({parse_ts('raw_posted_date')}, {parse_ts('raw_collected_at')}, '{NOW}') AS posted_date,
            coalesce({parse_ts('raw_collected_at')}, '{NOW}') AS collected_at
          FROM {table} LEFT JOIN city_names ON lower(trim(raw_city)) = spelling
          WHERE {VALID}
        ) WHERE NOT (contains(job_url, 'jobs-in-egypt') OR city IN {values(V.OUT_OF_SCOPE_CITIES)})
      )"""


STAGED_COLUMNS = [c for c in S.SILVER_COLUMNS if c != "job_id"] + ["job_id"]


def latest(table: str, keys: list[str], columns: list[str]) -> str:
    ties = ", ".join(f"{c} ASC NULLS FIRST" for c in columns if c not in keys)
    return (
        f"SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY "
        f"collected_at DESC NULLS LAST, job_id ASC NULLS FIRST, job_url ASC NULLS FIRST, {ties}) = 1"
    )


# The columns a tie is settled by, in the order Spark holds them.
TIE_COLUMNS = [
    "source", "job_title", "company_name", "job_description", "job_url", "country", "city", "work_mode",
    "employment_type", "experience_needed", "qualification_required", "skills", "salary",
    "estimated_salary", "posted_date", "collected_at", "job_id",
]
SILVER_LIST = ", ".join(S.SILVER_COLUMNS)


def silver_from(name: str, table: str) -> str:
    """CTEs `<name>_staged`, `<name>_by_key` and `<name>` (Silver rows of a raw table)."""
    return f"""
{name}_staged AS ({staged_from(table)}),
{name}_by_key AS ({latest(f'{name}_staged', ['job_title', 'company_name', 'city'], TIE_COLUMNS)}),
{name} AS (SELECT {SILVER_LIST} FROM ({latest(f'{name}_by_key', ['job_id'], TIE_COLUMNS)}))"""


WITH_RAW = f"WITH {RAW_SQL}"
WITH_CITY = f"{WITH_RAW}, {CITY_SQL}"
WITH_SILVER = f"{WITH_CITY}, {silver_from('silver', 'raw')}"

JOB = S.JOB_ATTRIBUTES
JOB_LIST = ", ".join(JOB)


def numbered(key: str, natural: list[str], table: str, start: str = "0") -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in natural)
    return f"SELECT {start} + row_number() OVER (ORDER BY {order}) AS {key}, * FROM ({table})"


PREPARED = "SELECT *, 'N/A' AS job_category, 'N/A' AS career_level FROM"


def star(silver: str = "silver") -> str:
    """CTEs of a first load: prepared rows, dimensions, facts and links."""
    return f"""
prepared AS ({PREPARED} {silver}),
dim_source AS ({numbered('source_key', ['source_name'], 'SELECT DISTINCT source AS source_name FROM prepared WHERE source IS NOT NULL')}),
dim_company AS ({numbered('company_key', ['company_name'], 'SELECT DISTINCT company_name FROM prepared WHERE company_name IS NOT NULL')}),
dim_location AS ({numbered('location_key', ['country', 'city'], 'SELECT DISTINCT country, city FROM prepared')}),
dim_job AS ({numbered('job_key', JOB, f'SELECT DISTINCT {JOB_LIST} FROM prepared')}),
fact AS ({numbered('job_posting_key', ['source_key', 'job_id'], candidates())}),
skill_rows AS ({skill_rows('fact')}),
dim_skill AS ({numbered('skill_key', ['skill_name'], 'SELECT DISTINCT skill_name FROM skill_rows')}),
links AS (SELECT DISTINCT job_posting_key, skill_key FROM skill_rows JOIN dim_skill USING (skill_name))"""


def candidates(prepared: str = "prepared", suffix: str = "") -> str:
    s = suffix
    return f"""SELECT job_key, company_key, location_key, source_key,
      CAST(strftime(CAST(posted_date AS DATE), '%Y%m%d') AS BIGINT) AS posted_date_key,
      p.job_id, CAST(NULL AS INT) AS unified_job_id, p.job_url, p.salary, p.estimated_salary, p.skills
    FROM {prepared} p
    LEFT JOIN dim_source{s} s ON p.source = s.source_name
    LEFT JOIN dim_company{s} c ON p.company_name = c.company_name
    LEFT JOIN dim_location{s} l ON p.country = l.country AND p.city = l.city
    LEFT JOIN dim_job{s} j ON p.job_title = j.job_title AND p.employment_type = j.employment_type
      AND p.work_mode = j.work_mode AND p.qualification_required = j.qualification_required
      AND p.job_category IS NOT DISTINCT FROM j.job_category
      AND p.career_level IS NOT DISTINCT FROM j.career_level
      AND p.experience_needed IS NOT DISTINCT FROM j.experience_needed"""


def skill_rows(fact: str) -> str:
    return f"""SELECT DISTINCT job_posting_key, source_key, job_id, skill_name FROM (
      SELECT job_posting_key, source_key, job_id, trim(unnest(regexp_split_to_array(skills, '[;,]'))) AS skill_name FROM {fact}
    ) WHERE skill_name <> '' AND skill_name <> 'Not Specified'"""


WITH_STAR = f"{WITH_SILVER}, {star()}"
