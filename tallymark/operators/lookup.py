"""Resolving keys against dimension tables.

Dimension tables are joined without hints: adaptive execution measures
them and broadcasts the ones that are small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.identifiers import counterpart, same_assembly
from tallymark.functions.text import words_within
from tallymark.operators.ranking import first_n


def resolve_unique(
    targets: DataFrame, candidates: DataFrame, key: str, value: str
) -> DataFrame:
    """Each target as ``resolved``, ``ambiguous`` or ``missing``.

    Only a single candidate resolves; the count tells the rest apart.
    """
    found = candidates.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("_one")
    )
    n = F.coalesce(F.col("n"), F.lit(0))
    return (
        targets.join(found, [key], "left")
        .withColumn(
            "outcome",
            F.when(n == 1, "resolved").when(n > 1, "ambiguous").otherwise("missing"),
        )
        .withColumn(value, F.when(n == 1, F.col("_one")))
        .withColumn("n", n)
        .drop("_one")
    )


def resolve_targets(targets: DataFrame, subjects: DataFrame) -> DataFrame:
    """Subjects named as ``clade/slug``, ``species/clade/slug`` or bare slug.

    A bare slug resolves only when exactly one subject has it.
    """
    wanted = targets.select(
        "target", F.regexp_replace("target", r"^species/|/+$", "").alias("_key")
    ).distinct()
    names = subjects.select("subject", F.col("subject").alias("_key")).unionByName(
        subjects.select("subject", F.col("slug").alias("_key"))
    )
    return resolve_unique(wanted, names, "_key", "subject").drop("_key")


def with_fallback(
    wanted: DataFrame,
    exact: DataFrame,
    fallback: DataFrame,
    key: str,
    fallback_key: str,
    values: Sequence[str],
) -> DataFrame:
    """Left lookup on ``key``, then on ``fallback_key`` where that found nothing.

    Both tables have one row per key, under the columns ``key`` and
    ``fallback_key``. ``path`` says which one won.
    """
    first = exact.select(key, F.struct(*values).alias("_a"))
    second = fallback.select(fallback_key, F.struct(*values).alias("_b"))
    path = F.when(F.col("_a").isNotNull(), "exact").when(
        F.col("_b").isNotNull(), "fallback"
    )
    won = F.coalesce("_a", "_b")
    return (
        wanted.join(first, [key], "left")
        .join(second, [fallback_key], "left")
        .withColumn("path", path.otherwise("none"))
        .select("*", *[won[v].alias(v) for v in values])
        .drop("_a", "_b")
    )


def candidates_by_slug(subjects: DataFrame, authority: DataFrame) -> DataFrame:
    """Authority entries of a slug: by full slug, else by two-word slug.

    ``subjects`` has ``subject`` and ``slug``; ``authority`` has ``slug``,
    ``binomial`` and its own columns. One row per candidate.
    """
    exact = subjects.join(authority.drop("binomial"), "slug").withColumn("by", F.lit("exact"))
    rest = subjects.join(authority.select("slug"), "slug", "left_anti")
    loose = rest.join(
        authority.drop("slug").withColumnRenamed("binomial", "slug"), "slug"
    ).withColumn("by", F.lit("binomial"))
    return exact.unionByName(loose)


def authority_entry(subjects: DataFrame, authority: DataFrame) -> DataFrame:
    """The one authority entry of each subject; ambiguous ones are left out."""
    found = candidates_by_slug(subjects, authority)
    rest = [c for c in found.columns if c not in ("subject", "by")]
    return (
        found.groupBy("subject")
        .agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_e"))
        .filter("_n = 1")
        .select("subject", "_e.*")
    )


def resolve_published(declared: DataFrame, published: DataFrame) -> DataFrame:
    """The accession the data sits under: as declared, else the other form.

    ``declared`` has ``subject`` and ``declared``; ``published`` one row per
    ``accession``. Adds ``accession``, null where neither is published.
    """
    known = published.select("accession").distinct()
    as_is = known.select(F.col("accession").alias("declared"), F.lit(1).alias("_d"))
    flipped = known.select(F.col("accession").alias("_other"), F.lit(1).alias("_c"))
    return (
        declared.withColumn("_other", counterpart(F.col("declared")))
        .join(as_is, "declared", "left")
        .join(flipped, "_other", "left")
        .withColumn(
            "accession",
            F.when(F.col("_d") == 1, F.col("declared")).when(F.col("_c") == 1, F.col("_other")),
        )
        .drop("_other", "_d", "_c")
    )


def resolve_runs(
    wanted: DataFrame,
    runs: DataFrame,
    key: str,
    first: str = "run",
    second: str = "experiment",
) -> DataFrame:
    """Rows of ``runs`` each distinct key names; a match on ``first`` wins."""
    keys = wanted.select(key).filter(F.col(key).isNotNull()).distinct()
    by_first = keys.join(runs, F.col(key) == F.col(first)).withColumn("path", F.lit(first))
    rest = keys.join(runs.select(F.col(first).alias(key)), key, "left_anti")
    by_second = rest.join(runs, F.col(key) == F.col(second)).withColumn("path", F.lit(second))
    return by_first.unionByName(by_second)


def named_schemes(
    observed: DataFrame,
    schemes: DataFrame,
    subject: Sequence[str],
    key: str,
    shared: Sequence[str] = (),
) -> DataFrame:
    """Distinct observed keys with ``known``, the schemes that have them.

    ``schemes`` has ``scheme`` and the key, and the ``shared`` columns if its
    names depend on the subject. ``known`` is bounded by the schemes there are.
    """
    known = schemes.groupBy(*shared, key).agg(F.collect_set("scheme").alias("known"))
    none = F.array().cast("array<string>")
    return (
        observed.select(*subject, key)
        .distinct()
        .join(known, [*shared, key], "left")
        .withColumn("known", F.coalesce("known", none))
    )


def best_scheme(named: DataFrame, subject: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The scheme that explains most observed keys of each subject.

    Ties, and subjects no scheme explains, go to the first in ``order``.
    """
    counted = named.groupBy(*subject).agg(
        F.count(F.lit(1)).alias("n_observed"),
        *[F.count_if(F.array_contains("known", s)).alias(f"_{i}") for i, s in enumerate(order)],
    )
    entries = F.array(
        *[
            F.struct(F.col(f"_{i}").alias("n"), F.lit(-i).alias("place"), F.lit(s).alias("scheme"))
            for i, s in enumerate(order)
        ]
    )
    best = F.array_max(entries)
    return counted.select(
        *subject, best["scheme"].alias("scheme"), "n_observed", best["n"].alias("n_matched")
    )


def scheme_strays(
    named: DataFrame, chosen: DataFrame, subject: Sequence[str], key: str, order: Sequence[str]
) -> DataFrame:
    """Observed keys outside the chosen scheme, with the first scheme that has them.

    ``other`` is null for keys no scheme knows.
    """
    other = F.coalesce(*[F.when(F.array_contains("known", s), F.lit(s)) for s in order])
    return (
        named.join(chosen.select(*subject, "scheme"), list(subject))
        .filter(~F.array_contains("known", F.col("scheme")))
        .select(*subject, key, other.alias("other"))
    )


def classify_form(declared: DataFrame, a: str, canonical: str) -> DataFrame:
    """``exact``, ``form`` (same entity, other prefix) or ``different``."""
    return declared.withColumn(
        "outcome",
        F.when(F.col(a) == F.col(canonical), "exact")
        .when(same_assembly(F.col(a), F.col(canonical)), "form")
        .otherwise("different"),
    )


def contained_words(
    passages: DataFrame, texts: DataFrame, passage_id: str, text_id: str, words: str = "words"
) -> DataFrame:
    """Pairs where every word of the passage occurs in the text.

    Both inputs have an id and an array of distinct words. A text holding all
    words of a passage holds any one of them, so pairs are only formed on one
    anchor word per passage, the one fewest passages have, and then verified
    word for word.
    """
    word = passages.select(passage_id, F.explode(words).alias("_word"))
    spread = word.groupBy("_word").agg(F.count(F.lit(1)).alias("_f"))
    anchors = first_n(
        word.join(spread, "_word"), [passage_id], ["_f", F.desc(F.length("_word")), "_word"], 1, "_r"
    ).select(passage_id, "_word")
    pairs = (
        texts.select(text_id, F.explode(words).alias("_word"))
        .join(anchors, "_word")
        .select(passage_id, text_id)
    )
    return (
        pairs.join(passages.select(passage_id, F.col(words).alias("_want")), passage_id)
        .join(texts.select(text_id, F.col(words).alias("_have")), text_id)
        .filter(words_within(F.col("_want"), F.col("_have")))
        .select(passage_id, text_id)
    )
