"""Tables of checks: what is described, what computes it, what is chosen to run."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.values import SEVERITIES
from tallymark.schemas import FINDING_COLUMNS
from tallymark.session import cut


class Check(NamedTuple):
    """A row of a table of checks; ``build`` turns a corpus into findings.

    One function may report under several ids: its own and those in ``emits``.
    """

    id: str
    tier: str
    severity: str
    summary: str
    needs: tuple[str, ...]
    build: Callable | None
    emits: tuple[str, ...] = ()

    @property
    def ids(self) -> tuple[str, ...]:
        return (self.id, *self.emits)


def table_of_checks(described: Mapping[str, Mapping], builders: Mapping[str, Callable], withdrawn: Iterable[str] = ()) -> tuple[Check, ...]:
    """Descriptions joined to their functions, in the order of their ids.

    The table is looked over as a whole, and everything wrong is told at once.
    """
    rows = tuple(
        Check(key, d["tier"], d["severity"], d["summary"], tuple(d.get("needs", ())), builders.get(key), tuple(d.get("emits", ())))
        for key, d in sorted(described.items())
    )
    uses = Counter(name for row in rows for name in row.ids)
    wrong = [f"{row.id}: no such severity as {row.severity!r}" for row in rows if row.severity not in SEVERITIES]
    wrong += [f"{row.id}: nothing computes it" for row in rows if row.build is None]
    wrong += [f"{name}: computed, but not described" for name in sorted(set(builders) - set(described))]
    wrong += [f"{name}: in use {n} times" for name, n in sorted(uses.items()) if n > 1]
    wrong += [f"{name}: given up earlier, not free for another check" for name in sorted(set(withdrawn) & set(uses))]
    if wrong:
        raise ValueError("; ".join(wrong))
    return rows


def finding(
    df: DataFrame,
    id: str | Column,
    severity: str | Column,
    message: Column,
    detail: Column | str | None = None,
    path: Column | None = None,
    line: Column | None = None,
) -> DataFrame:
    """Rows of ``df`` (with ``subject``) as findings."""
    col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.select(
        col(id).alias("id"),
        col(severity).alias("severity"),
        F.col("subject"),
        message.cast("string").alias("message"),
        col(detail).cast("string").alias("detail"),
        col(path).cast("string").alias("path"),
        col(line).cast("int").alias("line"),
    )


def text(*parts: Column | str) -> Column:
    """Concatenation of columns and literal text; null parts read as empty."""
    return F.concat(
        *[
            F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit(""))
            for p in parts
        ]
    )


def prefixes(values: Sequence[str] | None) -> tuple[str, ...]:
    """The texts ids may begin with; blank ones say nothing."""
    return tuple(filter(None, (v.strip() for v in values or ())))


def wanted_id(id: str, only: tuple[str, ...], skip: tuple[str, ...]) -> bool:
    return (not only or id.startswith(only)) and not (skip and id.startswith(skip))


def pick(checks: Sequence[Check], only: Sequence[str] | None = None, skip: Sequence[str] | None = None, lacking: Sequence[str] = ()) -> list[Check]:
    """The rows with an id that is wanted and no need that is lacking; at least one, or it is a mistake."""
    first, last = prefixes(only), prefixes(skip)
    rows = [c for c in checks if not set(lacking).intersection(c.needs) and any(wanted_id(i, first, last) for i in c.ids)]
    if not rows:
        raise ValueError(f"of {len(checks)} checks none is left by only={first}, skip={last}")
    return rows


def slices_of(checks: Iterable[Check]) -> set[str]:
    """All slices of the corpus that the rows need."""
    return set().union(*(c.needs for c in checks))


def selection_digest(checks: Iterable[Check]) -> str:
    """Tells selections apart by id and severity."""
    lines = sorted(f"{c.id}:{c.severity}" for c in checks)
    return f"sha256:{hashlib.sha256(chr(10).join(lines).encode()).hexdigest()}"


def as_table(spark, checks: Iterable[Check]) -> DataFrame:
    """The rows as a DataFrame."""
    schema = "id string, tier string, severity string, summary string, needs array<string>"
    return spark.createDataFrame([(c.id, c.tier, c.severity, c.summary, list(c.needs)) for c in checks], schema)


def skipped(availability: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """A finding for every subject and check of which the subject lacks a slice.

    ``availability`` has ``subject`` and ``have``, the array of its slices.
    """
    wants = F.array(*[
        F.struct(F.lit(c.id).alias("id"), F.lit(c.summary).alias("summary"), F.array(*map(F.lit, c.needs)).alias("needs"))
        for c in checks if c.needs
    ])
    lacks = availability.select("subject", "have", F.inline(wants)).withColumn("lacks", F.array_except("needs", "have"))
    return finding(
        lacks.filter(F.size("lacks") > 0),
        F.col("id"),
        "skipped",
        text("not checked: ", F.col("summary")),
        text("needs ", F.array_join("lacks", ", ")),
    )


class RowRule:
    """A check of single rows of one table: a finding for each row that meets a condition.

    All rules over a table are evaluated in one pass over it. ``parts`` gives the
    columns ``when`` and ``message``, and ``detail``, ``path``, ``line``, ``id`` and
    ``severity`` where they are not empty or fixed.
    """

    def __init__(self, table: str, id: str, severity: str, parts: Callable[[], dict]):
        self.table, self.id, self.severity, self.parts = table, id, severity, parts

    def found(self) -> Column:
        """The finding as a struct, null where the row is as it should be."""
        given = {"id": F.lit(self.id), "severity": F.lit(self.severity), **self.parts()}
        kinds = {"id": "string", "severity": "string", "message": "string", "detail": "string", "path": "string", "line": "int"}
        columns = {name: given.get(name, F.lit(None)) for name in kinds}
        typed = [(c if isinstance(c, Column) else F.lit(c)).cast(kinds[name]).alias(name) for name, c in columns.items()]
        return F.when(given["when"], F.struct(*typed, F.lit(self.id).alias("_check")))

    def __call__(self, corpus) -> DataFrame:
        return row_findings(corpus, [self])


def row_rule(table: str, id: str, severity: str):
    """Makes a function that gives the parts a rule over the rows of a table."""
    return lambda parts: RowRule(table, id, severity, parts)


def row_findings(corpus, rules: Sequence[RowRule]) -> DataFrame:
    """Findings of rules over one table, which is read once; ``_check`` names the rule."""
    (table,) = {rule.table for rule in rules}
    found = F.array_compact(F.array(*[rule.found() for rule in rules]))
    return getattr(corpus, table).select("subject", F.inline(found))


def passes(checks: Sequence[Check]) -> list[list[Check]]:
    """Checks that are evaluated together: those of the rows of one table, the others alone."""
    together: dict[str, list[Check]] = {}
    for check in checks:
        together.setdefault(check.build.table if isinstance(check.build, RowRule) else f"check {check.id}", []).append(check)
    return list(together.values())


def _unable(subjects: DataFrame, check: Check, problem: Exception) -> DataFrame:
    """That the check gave no result, for every subject."""
    said = str(problem).strip().split("\n")[0]
    return finding(subjects, check.id, "error", text(f"no result, the check ended with {type(problem).__name__}: {said}"), check.summary).withColumn("_check", F.lit(check.id))


def _built(corpus, group: Sequence[Check]) -> DataFrame:
    """Findings of one pass. Where no plan can be made, it is told for the checks to blame."""
    columns = [*FINDING_COLUMNS, "_check"]
    try:
        if all(isinstance(c.build, RowRule) for c in group):
            return row_findings(corpus, [c.build for c in group]).select(*columns)
        return group[0].build(corpus).select(*FINDING_COLUMNS).withColumn("_check", F.lit(group[0].id))
    except Exception as problem:  # noqa: BLE001 - becomes a finding
        if len(group) > 1:
            return reduce(DataFrame.unionByName, [_built(corpus, [c]) for c in group])
        return _unable(corpus.subjects, group[0], problem).select(*columns)


# Parts a set of subjects is split into to find those a check fails on, and how often.
SPLIT = 16
DEEPEST = 6


def _settled(corpus, groups: Sequence[Sequence[Check]]) -> DataFrame:
    """Findings, computed now. What a value makes fail costs its own check and subject only."""
    try:
        return cut(reduce(DataFrame.unionByName, [_built(corpus, g) for g in groups]))
    except Exception as problem:  # noqa: BLE001 - becomes a finding
        if len(groups) > 1:
            return reduce(DataFrame.unionByName, [_settled(corpus, [g]) for g in groups])
        if len(groups[0]) > 1:
            return reduce(DataFrame.unionByName, [_settled(corpus, [[c]]) for c in groups[0]])
        return _by_subject(corpus, groups[0][0], problem)


def _by_subject(corpus, check: Check, problem: Exception, modulus: int = 1, rest: int = 0) -> DataFrame:
    """Findings of a check that fails on some subjects: these are found by splitting them up."""
    finer = modulus * SPLIT
    bucket = lambda n, m: lambda subject: F.pmod(F.xxhash64(subject), F.lit(m)) == n
    numbers = corpus.subjects.filter(bucket(rest, modulus)(F.col("subject"))).select(F.pmod(F.xxhash64("subject"), F.lit(finer)).alias("n"))
    sizes = {r["n"]: r["count"] for r in numbers.groupBy("n").count().collect()}
    done, failed = [], {}
    for n in sorted(sizes):
        try:
            done.append(cut(_built(corpus.where(bucket(n, finer)), [check])))
        except Exception as again:  # noqa: BLE001 - becomes a finding
            failed[n] = again
    # It fails on all parts: nothing to be told apart.
    if len(failed) == len(sizes) > 1 or finer >= SPLIT**DEEPEST:
        told = [_unable(corpus.subjects.filter(bucket(n, finer)(F.col("subject"))), check, failed[n]) for n in failed]
    else:
        told = [
            _unable(corpus.subjects.filter(bucket(n, finer)(F.col("subject"))), check, again) if sizes[n] == 1 else _by_subject(corpus, check, again, finer, n)
            for n, again in failed.items()
        ]
    columns = [*FINDING_COLUMNS, "_check"]
    every = [f.select(*columns) for f in [*done, *told]] or [_unable(corpus.subjects.limit(0), check, problem).select(*columns)]
    return reduce(DataFrame.unionByName, every)


def run_checks(corpus, checks: Sequence[Check], *, only: Sequence[str] | None = None, skip: Sequence[str] | None = None, guarded: bool = False) -> DataFrame:
    """Findings of the checks over all subjects; where a slice is lacking, a skipped row instead.

    ``guarded`` computes them at once, all in one job while nothing fails. A check
    that a value ends is an error of the subjects with such values, and all other
    findings stay.
    """
    groups = passes(checks)
    found = _settled(corpus, groups) if guarded else reduce(DataFrame.unionByName, [_built(corpus, g) for g in groups])
    if slices_of(checks):
        unable = skipped(corpus.availability, checks).withColumn("_check", F.col("id"))
        found = found.join(unable, ["subject", "_check"], "left_anti").unionByName(unable)
    first, last = prefixes(only), prefixes(skip)
    begins = lambda options: reduce(Column.__or__, map(F.col("id").startswith, options))
    if first:
        found = found.filter(begins(first))
    if last:
        found = found.filter(~begins(last))
    return found.select(*FINDING_COLUMNS)


def lookup_findings(lookups: DataFrame) -> DataFrame:
    """X001: a lookup that failed, so some checks could not run."""
    return finding(
        lookups.filter("error IS NOT NULL"),
        "X001",
        "warn",
        text(F.col("lookup"), " failed: ", F.col("error")),
        "checks that needed it were skipped",
    )
