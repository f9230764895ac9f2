"""Posting pages of the three shapes."""

import json

from pyspark.sql import functions as F

from vacancia import fixed_values as V
from vacancia import schemas as S
from vacancia.operators import extract as X
from vacancia.operators.unify import unify_flat_a, unify_flat_b, unify_nested


def page(spark, html, url="https://h/jobs/p/x"):
    return spark.createDataFrame([(url, html)], "url string, html string")


def embedded(spark, html, marker, **kwargs):
    return page(spark, html).select(X.extract_embedded_json(F.col("html"), marker, **kwargs).alias("j")).first()["j"]


def test_balanced_object(spark):
    html = 'x = {"n":1}; App.s =\n {"a":"}\\"{","b":{"c":1}};\n</script> } tail'
    assert json.loads(embedded(spark, html, "App.s")) == {"a": '}"{', "b": {"c": 1}}
    assert embedded(spark, "nothing here {}", "App.s") is None
    assert embedded(spark, 'App.s = {"a": ', "App.s") is None
    assert embedded(spark, "App.s = none", "App.s") is None


def test_escaped_object(spark):
    html = '<script>push("{\\"id\\":9,\\"z\\":0},{\\"id\\":1,\\"jobPositionValue\\":\\"x \\\\\\"q\\\\\\" {\\",\\"m\\":{\\"k\\":2}},more")</script>'
    got = embedded(spark, html, V.ESCAPED_MARKER, opener=V.ESCAPED_OPENER, escaped=True)
    assert json.loads(got) == {"id": 1, "jobPositionValue": 'x "q" {', "m": {"k": 2}}
    other = '("{\\"a\\":1,\\"jobPositionValue\\":\\"y\\"}")'
    got = embedded(spark, other, V.ESCAPED_MARKER, opener=V.ESCAPED_OPENER, escaped=True)
    assert json.loads(got) == {"a": 1, "jobPositionValue": "y"}


def test_nested_portal(spark):
    store = {
        "entities": {
            "job": {"collection": {
                "1": {"attributes": {"title": "Other", "slug": "other"}},
                "2": {"attributes": {"title": "Mine", "slug": "mine-2", "salary": {"min": 5, "max": 7, "currency": {"code": "SAR"}}},
                      "relationships": {"company": {"data": {"id": "c1"}}}}}},
            "company": {"collection": {"c1": {"attributes": {"name": "Acme"}}}}},
        "jobPage": {"similarJobs": {"2": {}}},
    }
    html = f"<script>{V.STATE_MARKER} = {json.dumps(store)};\n</script>"
    pages = page(spark, html, "https://h/jobs/p/mine-2?x").union(page(spark, html, "https://h/jobs/p/gone")).union(
        page(spark, "no state", "https://h/jobs/p/mine-2"))
    rows = unify_nested(X.nested_records(pages, "2026-01-01 00:00:00", "b")).collect()
    assert len(rows) == 2
    assert {(r["raw_job_title"], r["raw_company_name"], r["raw_salary"]) for r in rows} == {("Mine", "Acme", "5 - 7 SAR")}


def test_flat_portal_a(spark):
    inner = {"id": 3, "jobPositionValue": "Cook", "partnerName": " Acme ", "industries": ["food", "x"], "salary": 4000,
             "maxSalary": 0, "currency": None, "cityValue": "جدة", "isNew": True}
    escaped = json.dumps(inner, ensure_ascii=False).replace("\\", "\\\\").replace('"', '\\"').replace('{\\"id\\": ', '{\\"id\\":').replace(
        '\\"jobPositionValue\\": ', '\\"jobPositionValue\\":')
    html = f'<div class="desc"> Main <b>duties</b> </div><script>f("{escaped}")</script>'
    got = X.flat_a_records(page(spark, html).union(page(spark, "<div class='desc'>gone</div>")), "2026-01-01")
    rows = got.collect()
    assert len(rows) == 1 and set(got.columns) <= set(S.RAW_FLAT_A.names)
    assert rows[0]["company"] == "Acme" and rows[0]["industries"] == "food, x" and rows[0]["is_new"] == "true"
    assert rows[0]["description"] == "Main duties"
    full = got.select(*[F.col(n) for n in S.RAW_FLAT_A.names])
    assert unify_flat_a(full).first()["raw_salary"] == "4000 SAR"


FLAT_B = """
<h3 class="job-title-text big"> Data <b>Engineer</b> </h3>
<a class="job-meta-company" href="/c/1">Acme <!-- x --> Co</a><span class="company-name">Other</span>
<div class="company-logo"><a><img src="/l.png"></a></div>
<div class="job-meta-item"><i></i><span>Olaya, Riyadh</span><span>2</span></div>
<div class="job-tags"><span class="job-tag">Remote</span><span class="job-tag">Full Time</span><span class="job-tag"> </span></div>
<span class="job-date" data-datetime="2026-09-21 10:11:12">2 days</span>
<div class="meta-data"><div class="meta"><span>Salary</span><span>5000 &amp; up</span></div>
<div class="meta"><span>Education</span></div>
<div class="meta"><span>Career Level</span><div><span>Senior</span></div><span>no</span></div></div>
<div id="jobDescriptionBody"><p>Build</p><script>var x=1;</script><ul><li>pipes</ul>now</div>
<ul class="skills-list"><li class="skill-tag">sql</li><li class="skill-tag"></li></ul><div class="job-skills"><b class="skill">spark</b></div>
<a class="apply-btn" data-job-id="42" data-url="https://a/x">Apply</a>
"""


def test_flat_portal_b(spark):
    got = X.flat_b_records(page(spark, FLAT_B, "https://h/1"), "2026-01-01", "b")
    row = got.first().asDict()
    want = {
        "id": "42", "title": "Data Engineer", "company": "Acme Co", "company_url": f"{V.FLAT_B_BASE_URL}/c/1",
        "company_logo_url": f"{V.FLAT_B_BASE_URL}/l.png", "location": "Olaya, Riyadh", "work_mode": "Remote",
        "job_type": "Full Time", "salary": "5000 & up", "education": None, "career_level": "Senior",
        "description": "Build pipes now", "skills": "sql; spark", "apply_url": "https://a/x", "posted_date": "2026-09-21T10:11:12",
    }
    assert {k: row[k] for k in want} == want
    full = got.select(*[F.col(n) if n in got.columns else F.lit(None).cast("string").alias(n) for n in S.RAW_FLAT_B.names])
    bronze = unify_flat_b(full).first()
    assert (bronze["raw_city"], bronze["raw_job_title"], bronze["raw_employment_type"]) == ("Riyadh", "Data Engineer", "Full Time")


def test_empty_page(spark):
    row = X.flat_b_records(page(spark, None).union(page(spark, "")), "2026-01-01", "b").collect()
    assert [r["title"] for r in row] == [None, None]
