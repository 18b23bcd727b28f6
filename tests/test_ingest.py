"""Snapshot projection and landing: unknown keys dropped, owner flattened,
blank timestamps to null, exact columns, rejects, idempotent landing."""

import json
import os

import pytest

from pulse import schemas
from pulse.sources import ingest, tables

INGESTED_AT = "2026-05-20 12:00:00"

REPO_DOC = {
    "id": 4242, "node_id": "R_own", "name": "gauge", "full_name": "harbor/gauge", "private": True,
    "owner": {"login": "harbor", "id": 77, "type": "User"},
    "description": "Tide tables", "fork": True, "url": "https://api.example.invalid/repos/harbor/gauge",
    "language": "Zig", "stargazers_count": 31, "watchers_count": 12,
    "forks_count": 3, "open_issues_count": 5, "archived": True, "disabled": False,
    "created_at": "2020-02-29T23:59:01Z", "pushed_at": "2024-12-31T01:02:03Z",
    "updated_at": "2025-01-01T00:00:00Z", "license": {"key": "zlib"},
}
USER_DOC = {
    "login": "mira", "id": 901, "node_id": "U_own", "type": "User",
    "site_admin": True, "name": "Mira Q", "company": "Harbor", "location": "Lee Bay",
    "email": "m@example.invalid", "public_repos": 2, "public_gists": 1, "followers": 14, "following": 21,
    "created_at": "2018-06-05T04:03:02Z", "updated_at": "2025-02-02T02:02:02Z",
}
ORG_DOC = dict(USER_DOC, login="harbor", id=77, type="Organization", company=None, following=0)


def write_docs(folder, docs, name="part.json"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(json.dumps(d) for d in docs))
    return folder


def repos(spark, scratch, *docs):
    path = write_docs(os.path.join(scratch, "docs"), docs)
    return ingest.project_repos(ingest.read_documents(spark, path, schemas.REPO_DOCUMENT), INGESTED_AT)


def users(spark, scratch, *docs):
    path = write_docs(os.path.join(scratch, "udocs"), docs)
    return ingest.project_users(ingest.read_documents(spark, path, schemas.USER_DOCUMENT), INGESTED_AT)


def test_repo_projection_exact_columns_and_types(spark, scratch):
    df = repos(spark, scratch, REPO_DOC)
    assert [(f.name, f.dataType) for f in df.schema.fields] == \
        [(f.name, f.dataType) for f in schemas.REPOS.fields]


def test_unknown_keys_dropped_and_owner_flattened(spark, scratch):
    r = repos(spark, scratch, REPO_DOC).collect()[0].asDict()
    for gone in ("private", "url", "disabled", "updated_at", "license", "owner"):
        assert gone not in r
    assert (r["owner_id"], r["owner_login"]) == (77, "harbor")
    assert str(r["ingested_at"]) == INGESTED_AT


def test_blank_pushed_at_becomes_null_and_null_language_kept(spark, scratch):
    doc = dict(REPO_DOC, pushed_at="", language=None)
    r = repos(spark, scratch, doc).collect()[0]
    assert r["pushed_at"] is None and r["language"] is None
    assert str(r["created_at"]) == "2020-02-29 23:59:01"


def test_user_projection_drops_extra_keys(spark, scratch):
    df = users(spark, scratch, USER_DOC, ORG_DOC)
    assert [f.name for f in df.schema.fields] == [f.name for f in schemas.USERS.fields]
    org = [r for r in df.collect() if r["type"] == "Organization"][0]
    assert org["company"] is None and org["following"] == 0


def test_missing_required_key_is_rejected_not_fatal(spark, scratch):
    bad = {k: v for k, v in REPO_DOC.items() if k != "full_name"}
    bad["id"] = 1
    df = repos(spark, scratch, REPO_DOC, bad)
    out, rej = os.path.join(scratch, "repos"), os.path.join(scratch, "rejects")
    assert ingest.land_snapshots(df, out, schemas.REPOS_REQUIRED, "id", rej) == 1
    rejects = spark.read.json(rej).collect()
    assert [(r["identifier"], r["reason"]) for r in rejects] == [("1", "missing required: full_name")]


def test_landing_twice_equals_once_and_other_days_kept(spark, scratch):
    out = os.path.join(scratch, "repos")
    day1 = repos(spark, scratch, REPO_DOC)
    ingest.land_snapshots(day1, out, schemas.REPOS_REQUIRED)
    day2 = ingest.project_repos(
        ingest.read_documents(spark, os.path.join(scratch, "docs"), schemas.REPO_DOCUMENT),
        "2026-05-21 12:00:00")
    assert ingest.land_snapshots(day2, out, schemas.REPOS_REQUIRED) == 1
    assert ingest.land_snapshots(day2, out, schemas.REPOS_REQUIRED) == 1
    t = tables.read(spark, out)
    assert t.count() == 2
    assert tables.partitions(spark, out, "ingested_date") == ["2026-05-20", "2026-05-21"]


def test_empty_batch_refuses_to_land(spark, scratch):
    df = repos(spark, scratch, REPO_DOC).limit(0)
    with pytest.raises(ValueError):
        ingest.land_snapshots(df, os.path.join(scratch, "x"), schemas.REPOS_REQUIRED)


def test_day_with_rejects_only_is_reported(spark, scratch):
    out, rej = os.path.join(scratch, "repos"), os.path.join(scratch, "rejects")
    ingest.land_snapshots(repos(spark, scratch, REPO_DOC), out, schemas.REPOS_REQUIRED, "id", rej)
    good = repos(spark, scratch, REPO_DOC)
    from pyspark.sql import functions as F
    bad = good.withColumn("full_name", F.lit(None).cast("string"))
    later = good.withColumn("ingested_at", F.lit("2026-05-22 01:00:00").cast("timestamp"))
    with pytest.raises(ValueError, match="2026-05-20"):
        ingest.land_snapshots(bad.unionByName(later), out, schemas.REPOS_REQUIRED, "id", rej)
    assert tables.partitions(spark, out, "ingested_date") == ["2026-05-20", "2026-05-22"]
    assert spark.read.json(rej).count() == 1


def test_only_tracked_documents_land(spark, scratch):
    docs = ingest.read_documents(spark, write_docs(os.path.join(scratch, "d"), [
        REPO_DOC, dict(REPO_DOC, id=1, full_name="a/off"), dict(REPO_DOC, id=2, full_name="a/none")]), schemas.REPO_DOCUMENT)
    targets = spark.createDataFrame([("harbor/gauge", None), ("a/off", False)], "full_name string, enabled boolean")
    assert [r["id"] for r in ingest.only_tracked(docs, targets, "full_name").collect()] == [4242]


def test_tracked_missing_flag_means_enabled(spark):
    t = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "full_name string, enabled boolean")
    assert sorted(r["full_name"] for r in ingest.tracked(t).collect()) == ["a", "c"]


def test_seed_csv_reads_declared_timestamps(spark, scratch):
    p = os.path.join(scratch, "seed.csv")
    with open(p, "w") as f:
        f.write("id,login,ingested_at\n1,a,2026-05-20 12:00:00\n2,b,2026-05-20T12:00:00Z\n")
    df = ingest.read_seed_csv(spark, p, "id bigint, login string, ingested_at timestamp")
    assert [str(r["ingested_at"]) for r in df.orderBy("id").collect()] == [INGESTED_AT] * 2


def test_seeds_in_raw_schemas(spark, scratch):
    repos = os.path.join(scratch, "repos.csv")
    users = os.path.join(scratch, "users.csv")
    with open(repos, "w") as f:
        f.write(",".join(f.name for f in schemas.REPOS.fields) + "\n")
        f.write("7,R_7,w,acme/w,3,acme,,false,Rust,12,12,1,0,false,2020-01-01T00:00:00Z,,"
                "2026-05-20T00:00:00Z\n")
    with open(users, "w") as f:
        f.write(",".join(f.name for f in schemas.USERS.fields) + "\n")
        f.write("3,U_3,acme,Organization,false,Acme,,,4,10,0,2019-01-01T00:00:00Z,"
                "2026-05-20T00:00:00Z\n")
    r, u = ingest.read_seeds(spark, repos, users)
    assert r.schema == schemas.REPOS and u.schema == schemas.USERS
    row = r.collect()[0]
    assert row["pushed_at"] is None and row["description"] is None and row["language"] == "Rust"
    from pulse.operators import checks
    assert checks.relationships(r, "owner_id", u.withColumnRenamed("id", "user_id"), "user_id").count() == 0


def test_ndjson_day_sink_roundtrip(spark, scratch):
    from conftest import SF
    from pulse.sources import standins
    docs = standins.repo_documents(spark, SF["0.001"])
    out = os.path.join(scratch, "raw", "repos")
    ingest.write_ndjson(docs.select("value", "dt"), out)
    day = sorted(os.listdir(out))[0]
    assert day.startswith("dt=")
    text = spark.read.text(os.path.join(out, day))
    parsed = ingest.parse_documents(text, schemas.REPO_DOCUMENT)
    projected = ingest.project_repos(parsed, INGESTED_AT)
    n = text.count()
    assert projected.count() == docs.filter(f"dt = date'{day[3:]}'").count() == n
    # Re-writing a day replaces it instead of appending.
    ingest.write_ndjson(docs.select("value", "dt").filter(f"dt = date'{day[3:]}'"), out)
    assert spark.read.text(os.path.join(out, day)).count() == n
