"""License scans with a positional index of rare words.

Each template's INDEXED words that fewest documents contain are indexed with their
positions. A file looks up, for every template, the RARE rarest of them that it
contains. Where one stands, the posting says where the template would begin; a
beginning on which AGREED of all indexed words agree is a candidate. No such beginning
is missed, wherever else the words stand: of INDEXED words too few are left besides
the RARE ones. It counts when the template's key phrase stands at its place there. Its
score is the share of the template's idf found word for word at the right distance.

Document frequencies come from one pass over all texts; they and the templates are
bounded by the number of template words. The second pass stays inside the row.

Defined cases: a null or empty text has no words, no labels (an empty text) and a
score of 0. Repeated rows are scanned one by one. An empty table gives no rows. Other
columns are passed on; one with the name of a result is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import fresh, settled, terms

INDEXED = 6
AGREED = 3
RARE = INDEXED - AGREED + 1
RESULTS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")

# Phrases with their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Label, words of a notice or licence text, key phrase in it.
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute this software"),
)


def _strings(values: list[str]) -> Column:
    return F.split(F.lit(" ".join(values)), " ")


def document_frequencies(docs: DataFrame, text: str = "text", templates=TEMPLATES) -> tuple[int, dict[str, int]]:
    """Documents in all, and with each template word: one pass, a row for each word and task."""
    vocabulary = sorted({w for _, words, _ in templates for w in words.split()})
    found = docs.select(F.array_intersect(_strings(vocabulary), terms(F.col(text))).alias("found"))
    # One marker a document, so that one aggregate counts documents too.
    marked = found.select(F.explode(F.concat("found", F.array(F.lit("")))).alias("word"))
    counts = {r["word"]: r["n"] for r in marked.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return counts.pop("", 0), counts


def _phrase_places(words: Column, phrase: list[str]) -> Column:
    """Where the phrase's words stand one after the other."""
    last = F.size(words) - len(phrase)
    stands = lambda i: _all([F.get(words, i + k) == w for k, w in enumerate(phrase)])
    there = _all([F.array_contains(words, w) for w in phrase]) & (last >= 0)
    return F.when(there, F.filter(F.sequence(F.lit(0), last), stands)).otherwise(F.array().cast("array<int>"))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for one in conditions[1:]:
        out = out & one
    return out


def _index(spelled: list[str], idf: dict[str, float]) -> list[str]:
    """The template's rarest words, rarest first."""
    return sorted(set(spelled), key=lambda w: (-idf[w], w))[:INDEXED]


def _template_score(words: Column, present: Column, template: str, phrase: str, idf: dict[str, float]) -> Column:
    """Best score of the template in the row's words; 0 where it does not stand."""
    spelled, key = template.split(), phrase.split()
    shift = next(i for i in range(len(spelled)) if spelled[i : i + len(key)] == key)
    index = _index(spelled, idf)
    posted = {w: [i for i, x in enumerate(spelled) if x == w] for w in index}
    need = min(AGREED, len(index))
    chosen = F.slice(F.array_intersect(_strings(index), present), F.lit(1), F.lit(RARE))
    stands = lambda off, w: _any([F.get(words, off + i) == w for i in posted[w]])
    total = sum(idf[w] for w in spelled)

    def begins(chosen: Column) -> Column:
        """Beginnings that any looked-up word's postings give."""
        places = F.filter(F.transform(words, lambda x, i: F.when(F.array_contains(chosen, x), i).otherwise(-1)), lambda i: i >= 0)
        moved = F.transform(places, lambda i: F.flatten(F.array(*[
            F.when(F.get(words, i) == w, F.array(*[i - p for p in posted[w]])).otherwise(F.array().cast("array<int>")) for w in index
        ])))
        return F.array_distinct(F.flatten(moved))

    def accepted(off: Column) -> Column:
        votes = F.lit(0)
        for w in index:
            votes = votes + stands(off, w).cast("int")
        return (votes >= need) & _all([F.coalesce(F.get(words, off + shift + k) == w, F.lit(False)) for k, w in enumerate(key)])

    def score(off: Column) -> Column:
        gained = F.lit(0.0)
        for i, w in enumerate(spelled):
            gained = gained + F.when(F.get(words, off + i) == w, idf[w]).otherwise(0.0)
        return F.round(F.least(gained / total, F.lit(1.0)), 6)

    # The looked-up words are bound once a row.
    best = F.transform(F.array(chosen), lambda c: F.array_max(F.transform(F.filter(begins(c), accepted), score)))
    return F.when(F.size(chosen) >= need, F.coalesce(F.get(best, 0), F.lit(0.0))).otherwise(0.0)


def _any(conditions: list[Column]) -> Column:
    out = F.coalesce(conditions[0], F.lit(False))
    for one in conditions[1:]:
        out = out | F.coalesce(one, F.lit(False))
    return out


def scanned(docs: DataFrame, text: str = "text", templates=TEMPLATES, phrases=None) -> DataFrame:
    """The documents with the columns of RESULTS."""
    phrases = PHRASES if phrases is None else phrases
    n_docs, counts = document_frequencies(docs, text, templates)
    idf = {w: math.log((n_docs + 1) / (counts.get(w, 0) + 1)) + 1e-3 for _, words, _ in templates for w in words.split()}
    kept = [c for c in docs.columns if c.lower() not in RESULTS or c == text]
    w, r, p, s = (fresh(docs, name) for name in ("words", "rare", "places", "scores"))
    indexed = sorted({word for _, words, _ in templates for word in _index(words.split(), idf)})
    words = F.col(w)
    rows = docs.select(*kept, terms(F.col(text)).alias(w))
    # Indexed words that the row contains, used by every template.
    rows = rows.select(*kept, w, F.array_intersect(_strings(indexed), words).alias(r))
    rows = rows.select(
        *kept, w,
        F.array(*[_phrase_places(words, phrase.split()) for phrase in phrases]).alias(p),
        F.array(*[_template_score(words, F.col(r), spelled, key, idf) for _, spelled, key in templates]).alias(s),
    )
    every = F.flatten(p)
    base = F.array(*[F.when(F.size(F.get(p, i)) > 0, label) for i, label in enumerate(phrases.values())])
    more = F.array(*[F.when(F.get(s, i) > 0, label) for i, (label, _, _) in enumerate(templates)])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(F.array_compact(labels))), ",")
    return settled(
        rows,
        kept,
        F.size(words).cast("long").alias("n_words"),
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, more)).alias("labels"),
        F.array_max(s).alias("score"),
    )
