"""Three raw source shapes -> one Bronze shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia import fixed_values as V
from vacancia.functions.arrays import join_names, named_objects
from vacancia.functions.text import city_from_location, experience_text, first_truthy, salary_text
from vacancia.schemas import BRONZE_COLUMNS


def _bronze(df: DataFrame, source: str, **columns: Column) -> DataFrame:
    """All Bronze columns by name; those not given are null."""
    null = F.lit(None)
    values = {"source": F.lit(source), **{f"raw_{name}": c for name, c in columns.items()}}
    return df.select(*[values.get(n, null).cast("string").alias(n) for n in BRONZE_COLUMNS])


def unify_nested(df: DataFrame, source: str = V.SOURCE_NESTED) -> DataFrame:
    job = F.col("job_attributes")
    salary, years = job["salary"], job["workExperienceYears"]
    place = job["workplaceArrangement"]
    return _bronze(
        df,
        source,
        job_id=F.coalesce("job_id", F.lit("")),
        job_title=job["title"],
        company_name=F.col("company_attributes")["name"],
        job_description=job["description"],
        job_url=F.col("job_url"),
        country=F.lit(V.COUNTRY),
        city=job["location"]["city"]["name"],
        work_mode=first_truthy(place["translations"]["displayedName"]["en"], place["displayedName"]),
        employment_type=F.try_element_at(named_objects(job["workTypes"]), F.lit(1))["name"],
        experience=experience_text(years["min"], years["max"]),
        qualification=job["candidatePreferences"]["educationLevel"]["name"],
        skills=join_names(named_objects(job["keywords"])),
        salary=salary_text(salary["min"], salary["max"], salary["currency"]["code"]),
        posted_date=job["postedAt"],
        # The writer names the stamp `collected_at`, older files `scraped_at`.
        collected_at=F.coalesce(*[n for n in ("collected_at", "scraped_at") if n in df.columns]),
    )


def unify_flat_a(df: DataFrame, source: str = V.SOURCE_FLAT_A) -> DataFrame:
    return _bronze(
        df,
        source,
        job_id=F.coalesce("id", F.lit("")),
        job_title=F.col("title"),
        company_name=F.col("company"),
        job_description=F.col("description"),
        job_url=F.col("url"),
        country=first_truthy(F.col("country"), F.lit(V.COUNTRY)),
        city=F.col("city"),
        work_mode=F.col("workplace_type"),
        employment_type=F.col("contract_type"),
        experience=F.col("experience_years"),
        salary=salary_text(F.col("salary"), F.col("max_salary"), F.col("currency")),
        posted_date=F.col("created_date"),
        collected_at=F.col("collected_at"),
    )


def unify_flat_b(df: DataFrame, source: str = V.SOURCE_FLAT_B) -> DataFrame:
    def either(*names: str) -> Column:
        """The first filled alternate; if none is, the last one as it is."""
        return F.coalesce(first_truthy(*[F.col(n) for n in names]), F.col(names[-1]))

    return _bronze(
        df,
        source,
        job_id=F.coalesce(either("id", "job_id"), F.lit("")),
        job_title=either("title", "job_title"),
        company_name=either("company", "company_name"),
        job_description=either("description", "job_description"),
        job_url=either("url", "job_url"),
        country=first_truthy(F.col("country"), F.lit(V.COUNTRY)),
        city=city_from_location(F.col("city"), F.col("location")),
        work_mode=F.col("work_mode"),
        employment_type=either("job_type", "employment_type"),
        experience=either("experience", "experience_needed"),
        qualification=either("education", "qualification_required"),
        skills=F.col("skills"),
        salary=F.col("salary"),
        estimated_salary=F.col("estimated_salary"),
        posted_date=F.col("posted_date"),
        collected_at=F.col("collected_at"),
    )


def unify(*sources: DataFrame) -> DataFrame:
    """Union by name into the Bronze columns; absent ones are null, all are text."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    null = F.lit(None)
    return merged.select(
        *[(F.col(n) if n in merged.columns else null).cast("string").alias(n) for n in BRONZE_COLUMNS]
    )
