"""The review queue (text) and the settled citation record (JSON)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.text import strip
from tallymark.functions.values import CURATION_STATES
from tallymark.operators.curation import decide, undecided_by_silence
from tallymark.operators.ranking import first_per_key, segment_by_marker

# Line formats of the review queue.
HEADING = r"^##\s+(PRJ[A-Z]{2}\d+)\b"
UNREVIEWED = r"^-\s+NOT YET REVIEWED\b"
NOT_FOUND = r"^-\s+NO PUBLICATION FOUND\b"
DOI_LINE = r"^-\s+(★)?\s*(?:\[(10\.[^\]]+)\]|(10\.\S+))"
CONSIDERED = r"^<!--\s*considered:([^>]*?)-->"

ENTRY = (
    "status:string,title:string,submitter:string,rejected:array<string>,"
    "citations:array<struct<doi:string,reference:string,verified:boolean>>"
)


def doi_of(line: Column) -> Column:
    """The DOI of a candidate line, without trailing punctuation."""
    linked = F.regexp_extract(line, DOI_LINE, 2)
    bare = F.regexp_extract(line, DOI_LINE, 3)
    return F.regexp_replace(strip(F.when(linked != "", linked).otherwise(bare)), r"[).,;]+$", "")


def reference_of(line: Column) -> Column:
    """What follows the first dash of a candidate line."""
    at = F.instr(line, "—")
    return F.when(at > 0, strip(F.substr(line, at + 1))).otherwise("")


def queue_blocks(lines: DataFrame) -> DataFrame:
    """Lines of ``(path, line, value)`` with the heading they belong to.

    Adds ``at`` (line of the heading) and ``bioproject``; lines above the
    first heading are dropped.
    """
    clean = lines.withColumn("value", F.regexp_replace("value", r"\s+$", ""))
    blocks = segment_by_marker(
        clean, ["path"], "line", F.col("value").rlike(HEADING), out="at"
    ).filter("at IS NOT NULL")
    heads = blocks.filter("line = at").select(
        "path", "at", F.regexp_extract("value", HEADING, 1).alias("bioproject")
    )
    return blocks.join(heads, ["path", "at"])


def parse_queue(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Projects, candidate rows and issues of a review queue.

    Projects: ``bioproject, at, status, title, submitter, weight,
    n_subjects``. Candidates: ``bioproject, doi, reference, starred, role``
    with role ``kept``, ``considered`` or ``rejected``.
    """
    blocks = queue_blocks(lines)
    # A project named twice keeps its last block.
    last = blocks.groupBy("bioproject").agg(F.max(F.struct("path", "at")).alias("_b"))
    blocks = blocks.join(last, "bioproject").filter(
        (F.col("path") == F.col("_b.path")) & (F.col("at") == F.col("_b.at"))
    ).drop("_b")
    value = F.col("value")
    body = F.col("line") > F.col("at")
    considered_line = value.rlike(CONSIDERED)
    doi_line = value.rlike(DOI_LINE) & ~considered_line
    prose = body & (value != "") & ~value.rlike(r"^(-|#|<!--|\|)")
    kept = (
        blocks.filter(body & doi_line)
        .select(
            "bioproject", "line", doi_of(value).alias("doi"), reference_of(value).alias("reference"),
            (F.regexp_extract(value, DOI_LINE, 1) != "").alias("starred"),
        )
        .groupBy("bioproject", "doi")
        .agg(
            F.max_by("reference", "line").alias("reference"),
            F.bool_or("starred").alias("starred"),
        )
    )
    considered = (
        blocks.filter(body & considered_line)
        .groupBy("bioproject")
        .agg(F.max_by(F.regexp_extract(value, CONSIDERED, 1), "line").alias("_c"))
        .select("bioproject", F.explode(F.split(strip(F.col("_c")), r"\s+")).alias("doi"))
        .filter("doi <> ''")
        .distinct()
    )
    flags = blocks.groupBy("bioproject").agg(
        F.max("at").alias("at"),
        F.bool_or(body & value.rlike(UNREVIEWED)).alias("_marker"),
        F.bool_or(body & value.rlike(NOT_FOUND)).alias("_none"),
        F.count_if(body & doi_line).alias("_kept"),
        F.min_by("value", F.when(F.col("line") == F.col("at"), F.col("line"))).alias("_head"),
        F.min(F.when(prose, F.struct("line", "value"))).alias("_title"),
    )
    # The second prose line names the submitter.
    second = first_per_key(
        blocks.filter(prose)
        .join(flags.select("bioproject", F.col("_title.line").alias("_t")), "bioproject")
        .filter("line > _t")
        .select("bioproject", "line", "value"),
        ["bioproject"],
        ["line"],
    ).select("bioproject", strip(F.substring_index("value", "·", 1)).alias("submitter"))
    subjects = F.array_distinct(
        F.regexp_extract_all("_head", F.lit(r"\b([a-z]+/[a-z0-9-]+)\b"), F.lit(1))
    )
    args = (F.col("_marker"), F.col("_kept"), F.col("_none"))
    projects = flags.join(second, "bioproject", "left").select(
        "bioproject",
        "at",
        decide(*args).alias("status"),
        F.coalesce("_title.value", F.lit("")).alias("title"),
        F.coalesce("submitter", F.lit("")).alias("submitter"),
        F.coalesce(
            F.regexp_extract("_head", r"(\d+)\s+samples?", 1).try_cast("bigint"), F.lit(0)
        ).alias("weight"),
        F.size(subjects).cast("bigint").alias("n_subjects"),
    )
    issues = flags.filter(undecided_by_silence(*args)).select(
        "bioproject",
        F.lit("C010").alias("code"),
        F.concat("bioproject", F.lit(": every line was deleted, so nothing is asserted")).alias("message"),
        F.col("at").alias("line"),
    )
    rejected = considered.join(kept.select("bioproject", "doi"), ["bioproject", "doi"], "left_anti")
    blank = lambda df, role: df.select(
        "bioproject", "doi", F.lit("").alias("reference"), F.lit(False).alias("starred"), F.lit(role).alias("role")
    )
    candidates = (
        kept.select("bioproject", "doi", "reference", "starred", F.lit("kept").alias("role"))
        .unionByName(blank(considered, "considered"))
        .unionByName(blank(rejected, "rejected"))
    )
    return projects, candidates, issues


def parse_record(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Projects and citation rows of a record kept as one mapping per document.

    Entries with an unknown status are skipped.
    """
    return _record_rows(
        documents.select(
            F.explode(F.from_json("content", f"map<string,struct<{ENTRY}>>")).alias("bioproject", "e")
        )
    )


def parse_record_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same from ``json`` lines, one project each, as ``render_record`` writes them."""
    body = F.from_json("json", f"struct<bioproject:string,{ENTRY}>")
    return _record_rows(
        lines.select(body.alias("e")).select("e.bioproject", "e").filter("bioproject IS NOT NULL")
    )


def _record_rows(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    entries = entries.filter(F.col("e.status").isin(*CURATION_STATES))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    projects = entries.select(
        "bioproject", F.col("e.status").alias("status"), text("e.title").alias("title"),
        text("e.submitter").alias("submitter"),
    )
    accepted = entries.select("bioproject", F.explode("e.citations").alias("c")).select(
        "bioproject",
        strip(text("c.doi")).alias("doi"),
        text("c.reference").alias("reference"),
        F.coalesce("c.verified", F.lit(False)).alias("verified"),
        F.lit("kept").alias("role"),
    )
    turned_down = entries.select("bioproject", F.explode("e.rejected").alias("doi")).select(
        "bioproject", "doi", F.lit("").alias("reference"), F.lit(False).alias("verified"),
        F.lit("rejected").alias("role"),
    )
    return projects, accepted.filter("doi <> ''").unionByName(turned_down)


def render_record(projects: DataFrame, citations: DataFrame) -> DataFrame:
    """One JSON line per project, citations sorted; the sink of the record.

    A project's accepted and rejected citations are gathered into its line,
    which the record format requires.
    """
    kept = citations.filter("role = 'kept'").groupBy("bioproject").agg(
        F.array_sort(F.collect_list(F.struct("doi", "reference", "verified"))).alias("citations")
    )
    dropped = citations.filter("role = 'rejected'").groupBy("bioproject").agg(
        F.array_sort(F.collect_set("doi")).alias("rejected")
    )
    return (
        projects.join(kept, "bioproject", "left")
        .join(dropped, "bioproject", "left")
        .select(
            "bioproject",
            F.to_json(
                F.struct(
                    "bioproject", "status", F.nullif("title", F.lit("")).alias("title"),
                    F.nullif("submitter", F.lit("")).alias("submitter"), "citations", "rejected",
                )
            ).alias("json"),
        )
    )


def tool_citations(documents: DataFrame) -> DataFrame:
    """Tool citations (JSON mapping); citable when confirmed with text or DOI."""
    entries = documents.select(
        F.explode(
            F.from_json(
                "content", "map<string,struct<name:string,status:string,doi:string,citation:string,url:string>>"
            )
        ).alias("key", "e")
    )
    text = lambda c: F.coalesce(F.col(f"e.{c}"), F.lit(""))
    return entries.select(
        "key", text("name").alias("name"), F.coalesce(F.nullif("e.status", F.lit("")), F.lit("pending")).alias("status"),
        text("doi").alias("doi"), text("citation").alias("citation"), text("url").alias("url"),
    ).withColumn(
        "citable", (F.col("status") == "confirmed") & ((F.col("citation") != "") | (F.col("doi") != ""))
    )
