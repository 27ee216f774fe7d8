"""Text normalisation and one-line rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words too common in institution names to carry a signal.
GENERIC_WORDS = tuple(
    """a an and the of for at de del della di und der des
    university universite universitat universidad universita college school
    faculty department dept division institute institut instituto center
    centre centro laboratory laboratories lab unit group programme program
    research sciences science studies national state federal royal
    academy academia foundation trust hospital museum ltd inc gmbh""".split()
)

# Fixed value: shortest word that counts as distinctive.
MIN_WORD = 4


def strip(c: Column) -> Column:
    """Trim every kind of blank, not only the space character."""
    return F.btrim(c, F.lit(" \t\r\n\v\f"))


def slugify(c: Column) -> Column:
    """Lower-case name with runs of other characters turned into one dash."""
    bare = F.regexp_replace(F.lower(strip(c)), r"[’'.]", "")
    return F.btrim(F.regexp_replace(bare, r"[^a-z0-9]+", "-"), F.lit("-"))


def binomial_slug(c: Column) -> Column:
    """The first two words of the slug."""
    return F.substring_index(slugify(c), "-", 2)


def sanitize_name(c: Column) -> Column:
    """Runs of characters unsafe in a directory name become one underscore."""
    return F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "_")


def normalized_document(c: Column) -> Column:
    """Text without outer blanks and without blanks at line ends."""
    lines = F.regexp_replace(strip(c), r"\r\n?", "\n")
    return F.regexp_replace(lines, r"(?m)[ \t]+$", "")


def base_name(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def without_suffix(c: Column, suffix: str) -> Column:
    """Drop ``suffix`` where it is present."""
    kept = F.substr(c, F.lit(1), F.length(c) - F.lit(len(suffix)))
    return F.when(c.endswith(suffix), kept).otherwise(c)


def sha256_tag(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(c, 256))


def blank_to_null(c: Column, tokens: tuple[str, ...] = ("",)) -> Column:
    """Trim, and turn the tokens that mean "nothing" into null."""
    trimmed = strip(c)
    return F.when(~trimmed.isin(*tokens), trimmed)


def words_of(c: Column) -> Column:
    """Distinct lower-case ASCII words that carry a signal."""
    words = F.regexp_extract_all(F.lower(c), F.lit(f"[a-z]{{{MIN_WORD},}}"), F.lit(0))
    return F.filter(F.array_distinct(words), lambda w: ~w.isin(*GENERIC_WORDS))


def words_within(wanted: Column, available: Column) -> Column:
    """Every wanted word is available; no wanted word never matches."""
    return F.coalesce(
        (F.size(wanted) > 0) & (F.size(F.array_except(wanted, available)) == 0),
        F.lit(False),
    )


def affiliation_matches(submitter: Column, affiliations: Column) -> Column:
    """Some affiliation holds every distinctive word of the submitter."""
    wanted = words_of(submitter)
    return F.coalesce(
        F.exists(affiliations, lambda a: words_within(wanted, words_of(a))), F.lit(False)
    )


def join_nonempty(*parts: Column) -> Column:
    return F.concat_ws(" ", *[F.when(p != "", p) for p in parts])


def reference_line(authors: Column, year: Column, title: Column, journal: Column) -> Column:
    """``authors (year) title journal.`` with absent parts left out."""
    year_part = F.when(year != "", F.concat(F.lit("("), year, F.lit(")")))
    journal_part = F.when(journal != "", F.concat(journal, F.lit(".")))
    return F.trim(join_nonempty(authors, year_part, title, journal_part))


def first_author(author_string: Column) -> Column:
    """First of a comma-separated author list, marked when there are more."""
    first = F.rtrim(F.trim(F.substring_index(author_string, ",", 1)))
    first = F.regexp_replace(first, r"\.+$", "")
    return F.when(F.coalesce(author_string, F.lit("")) == "", F.lit("")).otherwise(
        F.when(author_string.contains(","), F.concat(first, F.lit(" et al."))).otherwise(first)
    )


def first_of_many(authors: Column) -> Column:
    """First of an author array, marked when there are more."""
    return F.when(F.size(authors) > 1, F.concat(F.get(authors, F.lit(0)), F.lit(" et al."))).otherwise(
        F.coalesce(F.get(authors, F.lit(0)), F.lit(""))
    )


def describe(head: Column, total: Column, limit: int = 5) -> Column:
    """The first names, and how many more there are.

    ``head`` holds at most ``limit`` sorted names, so the text stays short
    however large the group is.
    """
    more = F.when(
        total > limit, F.concat(F.lit(" (+"), (total - limit).cast("string"), F.lit(" more)"))
    ).otherwise(F.lit(""))
    return F.coalesce(F.concat(F.array_join(head, ", "), more), F.lit(""))
