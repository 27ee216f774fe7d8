"""Saved answers of external registries.

Every table says whether the lookup worked: an answer that did not parse
has ``error`` set and is not evidence of absence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.text import blank_to_null, first_author, first_of_many, reference_line, strip
from tallymark.sources.lines import cell, comma_fields, headed


ASSEMBLY_REPORT = (
    "struct<reports:array<struct<accession:string,"
    "organism:struct<organism_name:string,tax_id:string>,"
    "assembly_info:struct<assembly_name:string,assembly_level:string,"
    "paired_assembly:struct<accession:string>>>>>"
)
SUMMARY = "struct<uids:array<string>>"
SEARCH = (
    "struct<hitCount:bigint,resultList:struct<result:array<struct<doi:string,title:string,"
    "journalTitle:string,pubYear:string,authorString:string,pmid:string,affiliation:string,"
    "authorList:struct<author:array<struct<affiliation:string,"
    "authorAffiliationDetailsList:struct<authorAffiliation:array<struct<affiliation:string>>>>>>>>>>"
)
DATED = "struct<`date-parts`:array<array<string>>>"
WORK = (
    "struct<author:array<struct<literal:string,family:string,given:string>>,"
    f"issued:{DATED},`published-print`:{DATED},`published-online`:{DATED},created:{DATED}>"
)


def _unreadable() -> Column:
    return F.try_parse_json("content").isNull()


def run_info(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Runs from comma-separated answers, by header name."""
    rows = headed(lines, keys, comma_fields, first_line_only=True)
    names = {
        "Run": "run",
        "Experiment": "experiment",
        "BioSample": "biosample",
        "BioProject": "bioproject",
        "SampleName": "sample_name",
    }
    return rows.select(
        *keys,
        *[
            blank_to_null(cell(F.col("header"), F.col("fields"), source)).alias(name)
            for source, name in names.items()
        ],
    ).filter("run IS NOT NULL")


def assemblies(answers: DataFrame) -> DataFrame:
    """First report of each answer, from ``(accession, content)``."""
    body = F.from_json("content", ASSEMBLY_REPORT)
    first = F.get(body["reports"], F.lit(0))
    tax = first["organism"]["tax_id"]
    return answers.select(
        F.col("accession").alias("queried"),
        first["accession"].alias("accession"),
        first["organism"]["organism_name"].alias("organism_name"),
        F.when(tax.rlike(r"^\d+$"), tax.try_cast("int")).alias("tax_id"),
        first["assembly_info"]["assembly_name"].alias("assembly_name"),
        first["assembly_info"]["assembly_level"].alias("assembly_level"),
        first["assembly_info"]["paired_assembly"]["accession"].alias("paired_accession"),
        F.when(_unreadable(), "unparseable response").alias("error"),
    )


def project_summaries(answers: DataFrame) -> DataFrame:
    """Projects of summary answers, from ``content``."""
    result = F.get_json_object("content", "$.result")
    uids = F.from_json(result, SUMMARY)["uids"]
    entries = F.from_json(result, "map<string,string>")
    field = lambda n: F.coalesce(F.get_json_object("_e", f"$.{n}"), F.lit(""))
    return (
        answers.select(F.explode(uids).alias("_uid"), entries.alias("_all"))
        .select(F.try_element_at("_all", F.col("_uid")).alias("_e"))
        .select(
            field("project_acc").alias("bioproject"),
            strip(field("project_title")).alias("title"),
            strip(field("submitter_organization")).alias("submitter"),
            strip(field("project_description")).alias("description"),
        )
        .filter("bioproject <> ''")
    )


def _affiliations(hit: Column) -> Column:
    people = F.coalesce(hit["authorList"]["author"], F.array())
    own = F.transform(people, lambda a: a["affiliation"])
    listed = F.flatten(
        F.transform(
            people,
            lambda a: F.coalesce(
                F.transform(
                    a["authorAffiliationDetailsList"]["authorAffiliation"], lambda d: d["affiliation"]
                ),
                F.array().cast("array<string>"),
            ),
        )
    )
    return F.filter(
        F.array_distinct(F.concat(F.array(hit["affiliation"]), own, listed)),
        lambda a: a.isNotNull() & (a != ""),
    )


def literature_hits(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All candidates in their order (``pos``) and lookup states, from ``(bioproject, content)``."""
    parsed = answers.select(
        "bioproject", F.from_json("content", SEARCH).alias("body"), _unreadable().alias("_bad")
    )
    results = F.coalesce(F.col("body.resultList.result"), F.array())
    text = lambda c: F.coalesce(c, F.lit(""))
    hits = parsed.select(
        "bioproject", F.posexplode(results).alias("pos", "hit")
    )
    hit = F.col("hit")
    candidates = hits.select(
        "bioproject",
        "pos",
        text(hit["doi"]).alias("doi"),
        F.regexp_replace(text(hit["title"]), r"\.+$", "").alias("title"),
        text(hit["journalTitle"]).alias("journal"),
        text(hit["pubYear"]).alias("year"),
        first_author(hit["authorString"]).alias("authors"),
        text(hit["pmid"]).alias("pmid"),
        _affiliations(hit).alias("affiliations"),
    ).withColumn("reference", reference_line(F.col("authors"), F.col("year"), F.col("title"), F.col("journal")))
    states = parsed.select(
        "bioproject",
        F.coalesce("body.hitCount", F.lit(0)).alias("total"),
        F.when(F.col("_bad"), "unparseable response").alias("error"),
    )
    return candidates, states


def works(answers: DataFrame) -> DataFrame:
    """One-line references from ``(doi, found, content)``; text may be a list."""
    body = F.from_json("content", WORK)

    def scalar(path: str) -> Column:
        listed = F.get_json_object("content", f"$.{path}[0]")
        return strip(F.coalesce(listed, F.get_json_object("content", f"$.{path}"), F.lit("")))

    def year(name: str) -> Column:
        return F.get(F.get(body[name]["date-parts"], F.lit(0)), F.lit(0))

    def person(a: Column) -> Column:
        given = F.split(strip(F.replace(F.coalesce(a["given"], F.lit("")), F.lit("."), F.lit(" "))), r"\s+")
        initials = F.array_join(F.transform(given, lambda g: F.substring(g, 1, 1)), "")
        family = strip(F.coalesce(a["family"], F.lit("")))
        literal = strip(F.coalesce(a["literal"], F.lit("")))
        return F.when(literal != "", literal).otherwise(strip(F.concat_ws(" ", family, initials)))

    authors = F.filter(
        F.transform(F.coalesce(body["author"], F.array()), person), lambda n: n != ""
    )
    years = F.coalesce(
        *[year(n) for n in ("issued", "published-print", "published-online", "created")], F.lit("")
    )
    return answers.select(
        "doi",
        "found",
        F.when(F.col("found") & _unreadable(), "unparseable response").alias("error"),
        reference_line(
            first_of_many(authors),
            years,
            F.regexp_replace(scalar("title"), r"\.+$", ""),
            scalar("container-title"),
        ).alias("reference"),
    )
