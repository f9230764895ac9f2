"""Table schemas: raw records of the three source shapes, Bronze, Silver and the Gold star."""

from pyspark.sql import types as T


_S = T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def _strings(names: str) -> T.StructType:
    return _struct(**{n: _S for n in names.split()})


BRONZE_COLUMNS = (
    "source raw_job_id raw_job_title raw_company_name raw_job_description raw_job_url raw_country "
    "raw_city raw_work_mode raw_employment_type raw_experience raw_qualification raw_skills "
    "raw_salary raw_estimated_salary raw_posted_date raw_collected_at"
).split()

BATCH_COLUMNS = ["_load_date", "_batch_id"]

BRONZE = T.StructType(
    [T.StructField(n, T.StringType()) for n in BRONZE_COLUMNS]
    + [
        T.StructField("_ingest_ts", T.TimestampType()),
        T.StructField("_load_date", T.DateType()),
        T.StructField("_batch_id", T.StringType()),
    ]
)

REJECTED = T.StructType(
    [f for f in BRONZE.fields if f.name not in BATCH_COLUMNS]
    + [T.StructField("reject_reasons", T.ArrayType(T.StringType()))]
    + [f for f in BRONZE.fields if f.name in BATCH_COLUMNS]
)

SILVER_COLUMNS = (
    "job_id source job_title company_name job_description job_url country city work_mode "
    "employment_type experience_needed qualification_required skills salary estimated_salary "
    "posted_date collected_at"
).split()
SILVER = _strings(" ".join(SILVER_COLUMNS))

# The nested portal payload: only the fields that are read. Numbers are declared string so that
# their text is kept. So are lists whose elements may be of several kinds.
RAW_NESTED = _struct(
    job_id=_S, job_url=_S, wuzzuf_job_id=_S, collected_at=_S, scraped_at=_S, batch_id=_S,
    job_attributes=_struct(
        title=_S, description=_S, slug=_S, postedAt=_S,
        salary=_struct(min=_S, max=_S, currency=_struct(code=_S)),
        keywords=_S,
        location=_struct(city=_struct(name=_S)),
        workplaceArrangement=_struct(
            displayedName=_S, translations=_struct(displayedName=_struct(en=_S))
        ),
        workTypes=_S,
        workExperienceYears=_struct(min=_S, max=_S),
        candidatePreferences=_struct(educationLevel=_struct(name=_S)),
    ),
    company_attributes=_struct(name=_S),
)

# Page state of the nested portal: entities keyed by id.
PAGE_STATE = _struct(
    entities=_struct(
        job=_struct(
            collection=T.MapType(
                _S,
                _struct(
                    attributes=RAW_NESTED["job_attributes"].dataType,
                    relationships=_struct(company=_struct(data=_struct(id=_S))),
                ),
            )
        ),
        company=_struct(collection=T.MapType(_S, _struct(attributes=_struct(name=_S)))),
    ),
    jobPage=_struct(similarJobs=T.MapType(_S, _S)),
)

RAW_FLAT_A = _strings(
    "url id title company industries salary max_salary currency salary_frequency contract_type "
    "workplace_type experience_years requires_experience requires_english english_proficiency "
    "requires_gosi requires_health_card gender saudis_only females_only_env city district address "
    "country postal_code created_date job_status is_new source description collected_at"
)

RAW_FLAT_B = _strings(
    "id job_id source title job_title company company_name company_url company_logo_url description "
    "job_description url job_url apply_url location city country work_mode job_type employment_type "
    "career_level experience experience_needed education qualification_required gender industry "
    "skills salary estimated_salary posted_date collected_at batch_id"
)

# Gold star schema.
DIM_DATE = _struct(
    date_key=T.LongType(), date=T.DateType(), year=T.IntegerType(), month=T.IntegerType(),
    day=T.IntegerType(), quarter=T.IntegerType(), day_of_week=_S,
)
DIM_SOURCE = _struct(source_key=T.LongType(), source_name=_S)
DIM_COMPANY = _struct(company_key=T.LongType(), company_name=_S, industry=_S)
DIM_LOCATION = _struct(location_key=T.LongType(), country=_S, city=_S)
JOB_ATTRIBUTES = (
    "job_title job_category employment_type work_mode career_level qualification_required "
    "experience_needed"
).split()
DIM_JOB = _struct(job_key=T.LongType(), **{n: _S for n in JOB_ATTRIBUTES})
DIM_SKILL = _struct(skill_key=T.LongType(), skill_name=_S, skill_category=_S)
FACT = _struct(
    job_posting_key=T.LongType(), job_key=T.LongType(), job_id=_S, unified_job_id=T.IntegerType(),
    company_key=T.LongType(), location_key=T.LongType(), source_key=T.LongType(),
    posted_date_key=T.LongType(), source_job_key=T.IntegerType(), job_url=_S, salary=_S,
    AI_salary=_S,
)
BRIDGE = _struct(job_posting_key=T.LongType(), skill_key=T.LongType())
WATERMARK = _struct(pipeline_name=_S, last_loaded_at=T.TimestampType())
