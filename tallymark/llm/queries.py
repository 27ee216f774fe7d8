"""The operators over the given tables, and their SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import cover_codes, decontaminate, licenses, lm_score, mixing, quality, repeated_bytes, secrets, simhash, token_counts, token_files, tree_search, url_lists

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKEN_FILE_VOCABULARY = "word_bpe_49k.json"
TOKEN_COUNT_VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
TOKEN_LIMIT = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judged(docs, table(spark, sf_dir, "labels")).drop("text")


@query
def op2_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = secrets.trained(secrets.labelled_samples(docs))
    return secrets.scanned(docs, weights).drop("text", "found")


@query
def op3_token_files(spark, sf_dir):
    blocks = token_files.written(table(spark, sf_dir, "documents"), vocabulary(TOKEN_FILE_VOCABULARY), END_ID)
    return token_files.read_blocks(blocks)


@query
def op4_token_counts(spark, sf_dir):
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary(TOKEN_COUNT_VOCABULARY))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op5_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


ORACLES["op5_decontaminate"] = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
spans AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS span
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
lens AS (SELECT DISTINCT n FROM spans),
place AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS span
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, lens WHERE len(w) >= n)),
met AS (SELECT p.doc_id, p.i, p.n, s.item_id FROM place p JOIN spans s ON p.n = s.n AND p.span = s.span),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM met) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM met) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM doc d LEFT JOIN hit h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""


@query
def op6_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op7_licenses(spark, sf_dir):
    return licenses.scanned(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in row) + ")" for row in rows)


ORACLES["op7_licenses"] = (
    f"""
WITH phrase(label, words) AS (VALUES {_values((label, phrase) for phrase, label in licenses.PHRASES.items())}),
tpl(t, label, text, key) AS (VALUES {_values((i, *one) for i, one in enumerate(licenses.TEMPLATES))}),
""" + r"""doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
dw AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM doc),
pw AS (SELECT label, words, unnest(string_split(words, ' ')) AS word, unnest(range(len(string_split(words, ' ')))) AS k FROM phrase),
place AS (
  SELECT d.doc_id, p.label, d.pos - p.k AS pos FROM dw d JOIN pw p ON d.word = p.word
  GROUP BY d.doc_id, p.label, p.words, d.pos - p.k HAVING count(*) = len(string_split(p.words, ' '))),
base AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word FROM place GROUP BY doc_id),
tw AS (SELECT t, unnest(string_split(text, ' ')) AS word, unnest(range(len(string_split(text, ' ')))) AS pos FROM tpl),
df AS (SELECT word, count(DISTINCT doc_id) AS df FROM dw WHERE word IN (SELECT word FROM tw) GROUP BY word),
idf AS (
  SELECT word, ln(((SELECT count(*) FROM documents) + 1) / (coalesce(df, 0) + 1)) + 1e-3 AS idf
  FROM (SELECT DISTINCT word FROM tw) LEFT JOIN df USING (word)),
ix AS (
  SELECT t, word, idf FROM (SELECT DISTINCT t, word FROM tw) JOIN idf USING (word)
  QUALIFY row_number() OVER (PARTITION BY t ORDER BY idf DESC, word) <= 6),
present AS (SELECT DISTINCT doc_id, word FROM dw WHERE word IN (SELECT word FROM ix)),
vote AS (
  SELECT c.doc_id, c.t, d.pos - tw.pos AS off FROM (SELECT doc_id, t, word FROM present JOIN ix USING (word)) c
  JOIN dw d ON d.doc_id = c.doc_id AND d.word = c.word JOIN tw ON tw.t = c.t AND tw.word = c.word
  GROUP BY c.doc_id, c.t, d.pos - tw.pos HAVING count(DISTINCT c.word) >= 3),
key AS (
  SELECT t, unnest(string_split(key, ' ')) AS word, len(string_split(key, ' ')) AS n,
         unnest(range(len(string_split(key, ' ')))) + len(string_split(trim(split_part(' ' || text || ' ', ' ' || key || ' ', 1)), ' '))
           - CASE WHEN trim(split_part(' ' || text || ' ', ' ' || key || ' ', 1)) = '' THEN 1 ELSE 0 END AS pos
  FROM tpl),
verified AS (
  SELECT v.doc_id, v.t, v.off FROM vote v JOIN key k ON k.t = v.t
  JOIN dw d ON d.doc_id = v.doc_id AND d.pos = v.off + k.pos AND d.word = k.word
  GROUP BY v.doc_id, v.t, v.off, k.n HAVING count(*) = k.n),
total AS (SELECT t, sum(idf) AS total FROM tw JOIN idf USING (word) GROUP BY t),
scored AS (
  SELECT v.doc_id, v.t, v.off, round(least(sum(i.idf) / any_value(total.total), 1.0), 6) AS score
  FROM verified v JOIN tw ON tw.t = v.t JOIN dw d ON d.doc_id = v.doc_id AND d.pos = v.off + tw.pos AND d.word = tw.word
  JOIN idf i ON i.word = tw.word JOIN total ON total.t = v.t GROUP BY v.doc_id, v.t, v.off),
best AS (SELECT doc_id, max(score) AS score FROM scored GROUP BY doc_id),
base_label AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT DISTINCT doc_id, label FROM place) GROUP BY doc_id),
every AS (SELECT doc_id, label FROM place UNION SELECT doc_id, label FROM scored JOIN tpl USING (t)),
label AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM every GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word,
       coalesce(bl.labels, '') AS base_labels, coalesce(l.labels, '') AS labels, coalesce(best.score, 0.0) AS score
FROM doc d LEFT JOIN base b USING (doc_id) LEFT JOIN base_label bl USING (doc_id) LEFT JOIN label l USING (doc_id) LEFT JOIN best USING (doc_id)
"""
)


@query
def op8_lm_score(spark, sf_dir):
    return lm_score.pseudo_likelihood(table(spark, sf_dir, "documents"))


@query
def op9_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


FIRST_DAY = "2024-01-01"


def captures(pages: DataFrame) -> DataFrame:
    """Pages with the day of their capture, spread over a year by their id."""
    return pages.select("page_id", "url", F.expr(f"date_add(date '{FIRST_DAY}', cast(page_id % 365 as int))").alias("day"))


def listed(pages: DataFrame) -> DataFrame:
    """A dated list drawn from the pages themselves: their hosts, parent domains and first path segments."""
    name = url_lists.host(F.col("url"))
    segment = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]+)", 1)
    n = F.col("page_id")
    pattern = (
        F.when(n % 5 < 2, name)
        .when(n % 5 < 4, F.concat(name, segment))
        .otherwise(F.regexp_extract(name, r"[^.]+\.[^.]+\.[^.]+$", 0))
    )
    action = F.when(n % 3 == 0, "block").when(n % 3 == 1, "allow").otherwise("remove")
    return pages.filter(name != "").select(pattern.alias("pattern"), F.expr(f"date_add(date '{FIRST_DAY}', cast((page_id * 7) % 365 as int))").alias("day"), action.alias("action"))


@query
def op10_url_lists(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_lists.judged(captures(pages), listed(pages)).select("page_id", "day", "pattern", "action", "kept")


ORACLES["op10_url_lists"] = r"""
WITH page AS (
  SELECT page_id, url, date_add(DATE '2024-01-01', CAST(page_id % 365 AS INTEGER)) AS day,
         regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.$', '') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]+)', 1) AS segment
  FROM pages),
entry AS (
  SELECT CASE WHEN page_id % 5 < 2 THEN host WHEN page_id % 5 < 4 THEN host || segment
              ELSE regexp_extract(host, '[^.]+\.[^.]+\.[^.]+$', 0) END AS pattern,
         CAST(date_add(DATE '2024-01-01', CAST((page_id * 7) % 365 AS INTEGER)) AS DATE) AS day,
         CASE page_id % 3 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS rank
  FROM page WHERE host <> ''),
daily AS (SELECT pattern, day, min(rank) AS rank FROM entry GROUP BY pattern, day),
valid AS (SELECT pattern, rank, day AS valid_from, lead(day) OVER (PARTITION BY pattern ORDER BY day) AS valid_to FROM daily),
part AS (SELECT page_id, host, string_split(host, '.') AS labels, list_filter(string_split(path, '/'), lambda x: x <> '') AS seg FROM page WHERE host <> ''),
asked AS (
  SELECT page_id, 1000 - i AS place, host || '/' || array_to_string(seg[1:i], '/') AS pattern
  FROM (SELECT *, unnest(range(1, least(len(seg), 16) + 1)) AS i FROM part)
  UNION ALL
  SELECT page_id, 1000 + i, array_to_string(labels[i:], '.') FROM (SELECT *, unnest(range(1, len(labels) + 1)) AS i FROM part)),
met AS (
  SELECT a.page_id, a.place, a.pattern, v.rank
  FROM asked a JOIN page p USING (page_id) JOIN valid v ON a.pattern = v.pattern
  WHERE v.rank > 1 AND v.valid_from <= CAST(p.day AS DATE) AND (v.valid_to IS NULL OR CAST(p.day AS DATE) < v.valid_to)),
best AS (SELECT page_id, arg_min(pattern, place) AS pattern, arg_min(rank, place) AS rank FROM met GROUP BY page_id)
SELECT p.page_id, CAST(p.day AS DATE) AS day, b.pattern, CASE b.rank WHEN 3 THEN 'block' WHEN 2 THEN 'allow' END AS action, coalesce(b.rank <> 3, true) AS kept
FROM page p LEFT JOIN best b USING (page_id)
"""


@query
def op11_vector_codes(spark, sf_dir):
    codes, books = cover_codes.compressed(table(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(cover_codes.digest(books)).alias("codebooks_sha256"))


@query
def op12_repeated_bytes(spark, sf_dir):
    kept = repeated_bytes.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op13_ranked_search(spark, sf_dir):
    found = tree_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


ORACLES["op13_ranked_search"] = r"""
WITH dw AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM dw GROUP BY doc_id, term),
len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
tot AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM len),
norm AS (SELECT doc_id, 100 - 75 + ((75 * n * n_docs) // n_terms) AS m FROM len, tot),
iw AS (
  SELECT item_id, term, count(*) AS c FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)
  GROUP BY item_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, tot GROUP BY term),
score AS (
  SELECT item_id, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM iw JOIN tf USING (term) JOIN w USING (term) JOIN norm USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM score WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
