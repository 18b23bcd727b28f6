"""Snapshot ingestion: document projection (M1, M2), partition-scoped landing
with a reject sidecar (M3, S6-S9), seed CSVs (S3) and the tracked list (M24).

Fetching from the REST API is outside the library; its output -- NDJSON
documents per day -- is the input here.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pulse import schemas
from pulse.functions import blank_to_null
from pulse.sources import tables


#: Columns that follow a document which was read with its traces.
TRACES = ("_problem", "_line", "_file")


def read_documents(spark: SparkSession, path: str, schema: StructType, traces: bool = False) -> DataFrame:
    """NDJSON with a fixed schema: undeclared keys (nested too) are dropped,
    missing keys read as null. No inference pass over the files.

    With ``traces`` each document also carries its file, and one that is not as declared its line and what is wrong
    with it: not JSON at all, or the keys whose value has another type. Landing rejects such documents
    with their text instead of taking nulls for what they held.
    """
    if not traces:
        return spark.read.schema(schema).json(path)
    wide = StructType([*schema.fields, StructField("_line", StringType())])
    docs = spark.read.schema(wide).option("columnNameOfCorruptRecord", "_line").json(path)
    wrong = F.concat_ws(",", *[F.when(F.get_json_object("_line", f"$.{name}").isNotNull() & F.col(name).isNull(), F.lit(name))
                               for name in _leaves(schema)])
    problem = F.when(F.col("_line").isNotNull(), F.when(F.get_json_object("_line", "$").isNull(), "not JSON")
                     .otherwise(F.concat(F.lit("wrong type: "), wrong)))
    return docs.withColumn("_problem", problem).withColumn("_file", F.col("_metadata.file_path"))


def _leaves(schema: StructType, prefix: str = "") -> list[str]:
    """Paths of all declared keys, those that hold others too."""
    out = []
    for f in schema.fields:
        out.append(prefix + f.name)
        if isinstance(f.dataType, StructType):
            out += _leaves(f.dataType, f"{prefix}{f.name}.")
    return out


def _traces(docs: DataFrame) -> list[str]:
    return [c for c in TRACES if c in docs.columns]


def parse_documents(df: DataFrame, schema: StructType, text_col: str = "value") -> DataFrame:
    """JSON text column -> the declared document columns (other columns kept)."""
    others = [c for c in df.columns if c != text_col]
    return df.select(F.from_json(F.col(text_col), schema).alias("_doc"), *others) \
        .select("_doc.*", *others)


def _stamp(ingested_at: datetime | str | Column) -> Column:
    if isinstance(ingested_at, Column):
        return ingested_at.cast("timestamp")
    if isinstance(ingested_at, datetime):
        ingested_at = ingested_at.isoformat(sep=" ")
    return F.lit(ingested_at).cast("timestamp")


def _time(c: str) -> Column:
    """API timestamp text ("" or null = unknown) -> TIMESTAMP."""
    return blank_to_null(F.col(c)).try_cast("timestamp")


def project_repos(docs: DataFrame, ingested_at: datetime | str | Column) -> DataFrame:
    """Repo documents -> the 17 raw snapshot columns, owner flattened.

    ``docs`` holds the columns of ``schemas.REPO_DOCUMENT`` (from
    ``read_documents`` or ``parse_documents``); one ``ingested_at`` per run.
    """
    return docs.select(
        F.col("id"), "node_id", "name", "full_name",
        F.col("owner.id").alias("owner_id"), F.col("owner.login").alias("owner_login"),
        "description", "fork", "language", "stargazers_count", "watchers_count",
        "forks_count", "open_issues_count", "archived",
        _time("created_at").alias("created_at"), _time("pushed_at").alias("pushed_at"),
        _stamp(ingested_at).alias("ingested_at"), *_traces(docs),
    )


def project_users(docs: DataFrame, ingested_at: datetime | str | Column) -> DataFrame:
    """User documents -> the 13 raw snapshot columns."""
    return docs.select(
        "id", "node_id", "login", "type", "site_admin", "name", "company", "location",
        "public_repos", "followers", "following",
        _time("created_at").alias("created_at"),
        _stamp(ingested_at).alias("ingested_at"), *_traces(docs),
    )


def _reason(df: DataFrame, required: tuple[str, ...]) -> Column:
    """Why a row cannot land; empty if it can."""
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    reason = F.when(missing == "", "").otherwise(F.concat(F.lit("missing required: "), missing))
    if "_problem" in df.columns:
        reason = F.coalesce(F.concat(F.lit("malformed: "), F.col("_problem")), reason)
    return reason


def _split(flagged: DataFrame, traces: list[str], identifier: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their ``_reason`` -> (rows that can land, rejects)."""
    good = flagged.filter(F.col("_reason") == "").drop("_reason", *TRACES)
    rejects = flagged.filter(F.col("_reason") != "").select(
        F.col(identifier).cast("string").alias("identifier"), F.col("_reason").alias("reason"),
        *[F.col(c).alias(c[1:]) for c in traces if c != "_problem"],
        *( [F.col("ingested_date")] if "ingested_date" in flagged.columns else []))
    return good, rejects


def split_rejects(df: DataFrame, required: tuple[str, ...], identifier: str) -> tuple[DataFrame, DataFrame]:
    """(rows that can land, rejects as (identifier, reason), with line and file where documents were read with
    their traces)."""
    return _split(df.withColumn("_reason", _reason(df, required)), _traces(df), identifier)


def land_snapshots(df: DataFrame, path: str, required: tuple[str, ...], identifier: str = "id",
                   reject_path: str | None = None, partition_col: str = "ingested_date",
                   may_be_empty: bool = False) -> int:
    """Land snapshot rows into their day partitions (by ``ingested_at``).

    Re-landing a day replaces that day only -- dynamic partition overwrite --
    so running twice equals running once. Rows missing a required column, and malformed documents that were
    read with their traces, go to ``reject_path`` (written only when there are any). Returns the number of rows landed.

    The batch is read once for the rows; counts and days are observed during that
    write, and only a batch with rejects is read again for them. Days of which every
    row is a reject keep what they held, and an empty batch changes nothing: both raise after the
    rest has landed, so neither goes unreported. With ``may_be_empty`` a batch without any row is no error.
    """
    dated = df.withColumn(partition_col, F.to_date("ingested_at"))
    flagged = dated.withColumn("_reason", _reason(dated, required))  # once a row, for what is observed and what lands
    lands = F.col("_reason") == ""
    seen = Observation()
    watched = flagged.observe(
        seen, F.count(F.when(lands, 1)).alias("landed"), F.count(F.when(~lands, 1)).alias("rejected"),
        F.collect_set(F.when(lands, F.col(partition_col))).alias("days"),
        F.collect_set(F.when(~lands, F.coalesce(F.col(partition_col).cast("string"), F.lit("no day"))))
        .alias("reject_days"))
    good, _ = _split(watched, _traces(df), identifier)
    tables.replace_partitions(good, path, partition_col)
    got = {"landed": 0, "rejected": 0, "days": [], "reject_days": [], **seen.get}  # nothing is observed of an empty plan
    if got["rejected"] and reject_path is not None:
        _, rejects = _split(flagged, _traces(df), identifier)
        tables.replace_partitions(rejects, reject_path, partition_col, fmt="json")
    if not got["landed"]:
        if may_be_empty and not got["rejected"]:
            return 0
        raise ValueError(f"refusing to land an empty batch into {path}")
    lost = sorted(set(got["reject_days"]) - {d.isoformat() for d in got["days"]})
    if lost:
        raise ValueError(f"only rejected rows for {', '.join(lost)}: these days of {path} keep what they held")
    return got["landed"]


def land_repos(spark: SparkSession, docs: DataFrame, ingested_at, path: str,
               reject_path: str | None = None) -> int:
    return land_snapshots(project_repos(docs, ingested_at), path, schemas.REPOS_REQUIRED,
                          "id", reject_path)


def land_users(spark: SparkSession, docs: DataFrame, ingested_at, path: str,
               reject_path: str | None = None) -> int:
    return land_snapshots(project_users(docs, ingested_at), path, schemas.USERS_REQUIRED,
                          "id", reject_path)


def write_ndjson(df: DataFrame, path: str, partition_col: str = "dt") -> None:
    """Raw documents as NDJSON under ``{path}/{partition_col}=YYYY-MM-DD/``;
    re-writing a day replaces it."""
    tables.replace_partitions(df, path, partition_col, fmt="json")


def read_seed_csv(spark: SparkSession, path: str, schema: StructType | str,
                  timestamp_format: str | None = None) -> DataFrame:
    """Seed CSV with a header and declared column types. Timestamps in ISO 8601
    (``2026-05-20T00:00:00Z``) or ``2026-05-20 00:00:00`` parse by default."""
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    return reader.csv(path)


def read_seeds(spark: SparkSession, repos_csv: str, users_csv: str) -> tuple[DataFrame, DataFrame]:
    """Sample repo and user snapshots from seed CSVs, in the raw snapshot
    schemas, for development runs without landed documents."""
    return (read_seed_csv(spark, repos_csv, schemas.REPOS),
            read_seed_csv(spark, users_csv, schemas.USERS))


def only_tracked(docs: DataFrame, targets: DataFrame, name: str) -> DataFrame:
    """Documents of enabled targets only; the list and the documents share the column ``name``. Malformed documents that
    were read with their traces stay: whose they are is not known, and they have to be reported."""
    names = tracked(targets).select(name).distinct()
    if "_problem" not in docs.columns:
        return docs.join(names, name, "left_semi").select(*docs.columns)
    sound = docs.filter(F.col("_problem").isNull()).join(names, name, "left_semi").select(*docs.columns)
    return sound.unionByName(docs.filter(F.col("_problem").isNotNull()))


def tracked(targets: DataFrame, flag: str = "enabled") -> DataFrame:
    """Entities whose flag is true or missing (missing = enabled)."""
    return targets.filter(F.coalesce(F.col(flag), F.lit(True)))
