"""Posting pages -> records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacancia import fixed_values as V
from vacancia.functions.arrays import join_list, kv_map
from vacancia.functions.classify import classify_tags
from vacancia.functions.dates import lenient_iso
from vacancia.functions.ids import slug_id
from vacancia.functions.tags import (
    Step,
    attribute,
    chosen,
    elements,
    parse_selector,
    tags,
    text_within,
    texts,
    tokens,
)
from vacancia.functions.text import first_truthy, strip
from vacancia.functions.urls import absolute_url
from vacancia.schemas import PAGE_STATE


# --- state embedded in a script -----------------------------------------------------------------


def embedded_text(html: Column, marker: str, opener: str | None = None, escaped: bool = False) -> Column:
    """Page text from the start of the object a marker points at; null if the marker is absent.

    Without `opener` the object is what is first assigned to the marker; a mention of the marker
    without `= {` after it does not count. With `opener` the marker lies inside the object, which starts at the last `opener` (else the last `{`) before the marker.
    `escaped` undoes one level of backslash escaping.
    """
    if opener is None:
        at = F.regexp_instr(html, F.lit(rf"\Q{marker}\E\s*=\s*\{{"))
        rest = F.substr(html, at)
        text = F.substr(rest, F.instr(rest, "{"))
    else:
        at = F.instr(html, marker)
        before = F.substr(html, F.lit(1), at - 1)

        def tail(token: str) -> Column:
            start = F.length(before) - F.length(F.substring_index(before, token, -1)) - len(token) + 1
            return F.when(F.contains(before, F.lit(token)), F.substr(html, start))

        text = F.coalesce(tail(opener), tail("{"))
    text = F.when(at > 0, text)
    return F.regexp_replace(text, r'\\(["\\])', "$1") if escaped else text


def extract_embedded_json(html: Column, marker: str, opener: str | None = None, escaped: bool = False) -> Column:
    """The balanced JSON object a marker points at; null if absent or malformed.

    The JSON functions read one value and stop, so they find the closing brace themselves, strings
    and escapes included.
    """
    return F.get_json_object(embedded_text(html, marker, opener, escaped), "$")


def page_state(html: Column) -> Column:
    """Typed page state of the nested portal."""
    return F.from_json(embedded_text(html, V.STATE_MARKER), PAGE_STATE)


def pick_entity(store: Column, url: Column) -> Column:
    """Entry (`key`, `value`) of the posting: by slug, else the first similar one, else the first."""
    jobs = store["entities"]["job"]["collection"]
    entries = F.map_entries(jobs)
    slug = F.nullif(F.regexp_extract(url, "/p/([^/?]+)", 1), F.lit(""))
    by_slug = F.try_element_at(
        F.filter(entries, lambda e: e["value"]["attributes"]["slug"] == slug), F.lit(1)
    )
    main = F.try_element_at(F.map_keys(store["jobPage"]["similarJobs"]), F.lit(1))
    similar = F.try_element_at(F.filter(entries, lambda e: e["key"] == main), F.lit(1))
    return F.coalesce(by_slug, similar, F.try_element_at(entries, F.lit(1)))


def lookup_entity(entities: Column, entity_id: Column) -> Column:
    """Referenced entity by id; null where either is missing."""
    return F.try_element_at(entities, entity_id)


def nested_records(pages: DataFrame, stamp: str, batch_id: str) -> DataFrame:
    """Fetched posting pages (`url`, `html`) -> raw records of the nested shape."""
    stores = pages.select("url", page_state(F.col("html")).alias("_store"))
    # Exploded, not filtered: a filter would be pushed below and parse each page again.
    job = F.array_compact(F.array(pick_entity(F.col("_store"), F.col("url"))))
    picked = stores.select("url", "_store", F.explode(job).alias("_job"))
    company_id = F.col("_job")["value"]["relationships"]["company"]["data"]["id"]
    company = lookup_entity(F.col("_store")["entities"]["company"]["collection"], company_id)
    return picked.select(
        slug_id(F.col("url")).alias("job_id"),
        F.col("url").alias("job_url"),
        F.col("_job")["key"].alias("wuzzuf_job_id"),
        F.col("_job")["value"]["attributes"].alias("job_attributes"),
        company["attributes"].alias("company_attributes"),
        F.lit(stamp).alias("collected_at"),
        F.lit(batch_id).alias("batch_id"),
    )


# Output field <- field of the embedded object, flat portal A.
FLAT_A_FIELDS = {
    "id": "id",
    "title": "jobPositionValue",
    "company": "partnerName",
    "industries": "industries",
    "salary": "salary",
    "max_salary": "maxSalary",
    "currency": "currency",
    "salary_frequency": "salaryFrequency",
    "contract_type": "contractType",
    "workplace_type": "workplaceType",
    "experience_years": "experienceYears",
    "requires_experience": "requiresExperience",
    "requires_english": "requiresEnglish",
    "english_proficiency": "englishProficiency",
    "requires_gosi": "requiresGosi",
    "requires_health_card": "requiresHealthCard",
    "gender": "gender",
    "saudis_only": "saudisOnly",
    "females_only_env": "isEnvironmentForFemalesOnly",
    "city": "cityValue",
    "district": "district",
    "address": "address",
    "country": "countryValue",
    "postal_code": "postalCode",
    "created_date": "createdDate",
    "job_status": "jobStatus",
    "is_new": "isNew",
    "source": "source",
}
_LISTS = ["industries"]
_TRIMMED = ["company"]


def project_fields(df: DataFrame, record: str, spec: dict[str, str], lists: list[str], trimmed: list[str]) -> DataFrame:
    """Rename the fields of a struct; lists become `a, b` texts, trimmed fields are never null."""

    def field(name: str) -> Column:
        value = F.col(record)[spec[name]]
        if name in lists:
            return F.array_join(F.coalesce(value, F.array().cast("array<string>")), ", ")
        if name in trimmed:
            return strip(F.coalesce(value, F.lit("")))
        return value

    others = [c for c in df.columns if c != record]
    return df.select(*others, *[field(n).alias(n) for n in spec])


def flat_a_records(pages: DataFrame, stamp: str) -> DataFrame:
    """Fetched posting pages (`url`, `html`) -> raw records of flat portal A."""
    schema = T.StructType(
        [
            T.StructField(src, T.ArrayType(T.StringType()) if out in _LISTS else T.StringType())
            for out, src in FLAT_A_FIELDS.items()
        ]
    )
    text = embedded_text(F.col("html"), V.ESCAPED_MARKER, V.ESCAPED_OPENER, escaped=True)
    fields = {"description": FieldSpec(["div.desc"])}
    described = extract_fields(pages, "html", fields).select(
        "url", F.try_element_at("fields.description", F.lit(1)).alias("description"), F.from_json(text, schema).alias("_r")
    )
    records = described.filter(F.col("_r")["jobPositionValue"].isNotNull() | F.col("_r")["id"].isNotNull())
    return project_fields(records, "_r", FLAT_A_FIELDS, _LISTS, _TRIMMED).withColumn("collected_at", F.lit(stamp))


# --- elements by tag, class or id ---------------------------------------------------------------

@dataclass(frozen=True)
class FieldSpec:
    """What to read: elements matching any selector; their text, or one attribute of them.

    A selector is a chain of steps separated by spaces (`.job-tags .job-tag`), each step a tag with
    optional `.class`, `#id` and `[attribute*='value']` (`a.company-link`, `#body`, `h2 a[href*='/jobs/']`).
    With `child` the text of the element's inner tag of that name, counted from 0, is read instead (null
    if there are fewer). With `first_match` the selectors are tried in turn: the first that fits any
    element gives them all.
    """

    selectors: list[str]
    attribute: str | None = None
    child: tuple[str, int] | None = None
    first_match: bool = False


def extract_fields(df: DataFrame, html_col: str, spec: dict[str, FieldSpec]) -> DataFrame:
    """Adds `fields`: per name the matching elements' stripped texts (or attribute), in page order."""
    parsed = {name: [parse_selector(s) for s in field.selectors] for name, field in spec.items()}
    steps = [step for selectors in parsed.values() for selector in selectors for step in selector]
    steps += [Step(field.child[0], (), "", ()) for field in spec.values() if field.child]
    steps.append(Step("template", (), "", ()))

    staged = df.withColumn("_stream", tokens(F.col(html_col)))
    staged = staged.withColumn("_tags", tags(F.col("_stream"), steps))
    staged = staged.withColumn("_elements", elements(F.col("_stream"), F.col("_tags")))
    staged = staged.withColumn("_texts", texts(F.col("_stream"), F.col("_elements")))
    among, written = F.col("_elements"), F.col("_texts")

    def values(field: FieldSpec, selectors: list[list[Step]]) -> Column:
        found = [chosen(among, selector) for selector in selectors]
        if field.first_match:
            hits = F.coalesce(*[F.when(F.size(f) > 0, f) for f in found], found[-1])
        else:
            hits = F.array_sort(F.array_distinct(F.concat(*found)), lambda a, b: a["at"] - b["at"]) if len(found) > 1 else found[0]

        def value(hit: Column) -> Column:
            if field.attribute:
                return attribute(hit, field.attribute)
            if field.child:
                tag, number = field.child
                inner = F.filter(among, lambda e: (hit["at"] < e["at"]) & (e["at"] < hit["end"]) & (e["tag"] == tag))
                nth = F.try_element_at(inner, F.lit(number + 1))
                return F.when(nth.isNotNull(), text_within(nth, written))
            return text_within(hit, written)

        return F.transform(hits, value)

    fields = F.struct(*[values(field, parsed[name]).alias(name) for name, field in spec.items()])
    return staged.withColumn("fields", fields).drop("_stream", "_tags", "_elements", "_texts")


def select_links(df: DataFrame, html_col: str, selectors: list[str], source: str = "href") -> DataFrame:
    """Links of the first selector that fits any element of a page, with their position; empty ones are left out."""
    spec = {"links": FieldSpec(selectors, attribute=source, first_match=True)}
    others = [c for c in df.columns if c != html_col]
    links = extract_fields(df, html_col, spec).select(*others, F.posexplode("fields.links").alias("pos", "href"))
    return links.filter(F.col("href") != "")


_COMPANY = ["a.job-meta-company", ".job-company-name", ".company-name", "a.company-name-link"]

# Where flat portal B keeps its fields.
FLAT_B_FIELDS = {
    "id": FieldSpec([".apply-btn"], attribute="data-job-id"),
    "apply_href": FieldSpec([".apply-btn"], attribute="href"),
    "apply_data": FieldSpec([".apply-btn"], attribute="data-url"),
    "title": FieldSpec(["h3.job-title-text"]),
    "company": FieldSpec(_COMPANY),
    "company_href": FieldSpec(_COMPANY, attribute="href"),
    "logo_src": FieldSpec([".company-logo img", ".job-company-logo img"], attribute="src"),
    "description": FieldSpec(["#jobDescriptionBody"]),
    "location": FieldSpec([".job-meta-item span"]),
    "tags": FieldSpec([".job-tags .job-tag"]),
    "posted": FieldSpec([".job-date"], attribute="data-datetime"),
    "detail_label": FieldSpec([".meta-data .meta"], child=("span", 0)),
    "detail_value": FieldSpec([".meta-data .meta"], child=("span", 1)),
    "skills": FieldSpec([".job-skills .skill", ".skills-list .skill-tag"]),
}

# Record field <- label of a detail row.
FLAT_B_DETAILS = {
    "career_level": "Career Level",
    "experience": "Experience",
    "education": "Education",
    "gender": "Gender",
    "industry": "Industry",
    "salary": "Salary",
}


def flat_b_records(pages: DataFrame, stamp: str, batch_id: str) -> DataFrame:
    """Fetched posting pages (`url`, `html`) -> raw records of flat portal B."""
    read = extract_fields(pages, "html", FLAT_B_FIELDS).select("url", "fields.*")
    pairs = F.filter(
        F.arrays_zip("detail_label", "detail_value"), lambda p: p["detail_value"].isNotNull()
    )
    read = read.withColumn("_details", kv_map(pairs["detail_label"], pairs["detail_value"]))

    def one(name: str) -> Column:
        return F.try_element_at(F.col(name), F.lit(1))

    def detail(label: str) -> Column:
        return F.try_element_at("_details", F.lit(label))

    def link(name: str) -> Column:
        return absolute_url(F.nullif(one(name), F.lit("")), V.FLAT_B_BASE_URL)

    return read.select(
        one("id").alias("id"),
        F.lit(V.SOURCE_FLAT_B).alias("source"),
        one("title").alias("title"),
        one("company").alias("company"),
        link("company_href").alias("company_url"),
        link("logo_src").alias("company_logo_url"),
        one("description").alias("description"),
        "url",
        first_truthy(one("apply_href"), one("apply_data")).alias("apply_url"),
        one("location").alias("location"),
        classify_tags(F.col("tags"), V.TAG_WORK_MODES).alias("work_mode"),
        first_truthy(detail("Employment"), classify_tags(F.col("tags"), V.TAG_JOB_TYPES)).alias("job_type"),
        *[detail(label).alias(name) for name, label in FLAT_B_DETAILS.items()],
        join_list(F.col("skills")).alias("skills"),
        lenient_iso(one("posted")).alias("posted_date"),
        F.lit(stamp).alias("collected_at"),
        F.lit(batch_id).alias("batch_id"),
    )
