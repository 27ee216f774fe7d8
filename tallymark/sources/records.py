"""Stored validation records and the finding tables written beside them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.values import REPORT_STATES, SEVERITIES
from tallymark.operators.rollup import counts_with_zeros

RECORD = (
    "struct<subject:string,state:string,validated_at:string,tool_version:string,catalog:string,"
    "checks_run:array<string>,checks_available:int,inputs:map<string,string>,"
    "data:struct<published:boolean,accession:string,bams:struct<count:bigint,digest:string>>,"
    "findings:array<struct<id:string,severity:string,subject:string,message:string,"
    "detail:string,path:string,line:int>>,"
    "status:struct<state:string,accession:string,declared_accession:string,"
    "missing:array<string>>,stale_reason:string>"
)


def parse_records(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records and their findings from ``content``.

    Unknown fields are dropped. A document that does not parse, or whose
    state is unknown, is no record at all.
    """
    read = documents.select(F.from_json("content", RECORD).alias("r")).filter(
        F.col("r.state").isin(*REPORT_STATES) & F.col("r.subject").isNotNull()
    )
    tally = lambda s: F.size(F.filter(F.coalesce("r.findings", F.array()), lambda f: f["severity"] == s))
    records = read.select(
        "r.*",
        F.struct(*[tally(s).cast("bigint").alias(f"n_{s}") for s in ("error", "warn", "info", "skipped")]).alias("counts"),
    ).drop("findings")
    findings = read.select(F.explode("r.findings").alias("f")).select("f.*")
    return records, findings


DATASET = (
    "struct<subject:string,harvested_at:string,tool_version:string,accession:string,"
    "declared_accession:string,prefix:string,published:boolean,"
    "objects:map<string,struct<size:bigint,etag:string>>,"
    "samples:map<string,map<string,double>>,"
    "sra:map<string,array<struct<run:string,biosample:string,bioproject:string>>>>"
)


class Datasets(NamedTuple):
    """Harvested records and the tables inside them."""

    records: DataFrame
    objects: DataFrame
    samples: DataFrame
    runs: DataFrame


def parse_datasets(documents: DataFrame) -> Datasets:
    """Harvested records from ``content``; unknown fields are dropped."""
    read = documents.select(F.from_json("content", DATASET).alias("r")).filter("r.subject IS NOT NULL")
    whole = read.select("r.*")
    objects = whole.select("subject", F.explode("objects").alias("path", "o")).select("subject", "path", "o.*")
    samples = whole.select("subject", F.explode("samples").alias("sample", "m")).select(
        "subject", "sample", F.explode("m").alias("metric", "value")
    )
    runs = whole.select("subject", F.explode("sra").alias("input", "runs")).select(
        "subject", "input", F.inline("runs")
    )
    return Datasets(whole.drop("objects", "samples", "sra"), objects, samples, runs)


def write_report(findings: DataFrame, statuses: DataFrame, path: str) -> None:
    """Findings, statuses and severity counts as JSON lines below one folder."""
    write_findings(findings, f"{path}/findings")
    statuses.write.mode("overwrite").json(f"{path}/statuses")
    counts_with_zeros(findings, "severity", SEVERITIES).coalesce(1).write.mode("overwrite").json(f"{path}/counts")


def write_findings(findings: DataFrame, path: str) -> None:
    """Findings as JSON lines."""
    findings.write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str, columns: list[str], line_sep: str = "\n") -> None:
    """A comma-separated table with a fixed set of columns.

    Columns the data lacks are written empty, others are left out.
    """
    projected(df, columns).write.mode("overwrite").option("header", True).option(
        "lineSep", line_sep
    ).option("emptyValue", "").csv(path)


def projected(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns as text, absent ones and nulls empty."""
    return df.select(
        *[
            (F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")).alias(c)
            for c in columns
        ]
    )
