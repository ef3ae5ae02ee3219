"""Named queries of the operators over whole tables, and their reference SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import stable
from . import (
    bpe,
    chat,
    decontamination,
    exact_dedup,
    hard_negatives,
    html,
    licences,
    line_dedup,
    minhash,
    ranked_search,
    substring_dedup,
    toxicity,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    return str(public_tokenizers.path("word_bpe_49k.json"))


def token_digests(encoded: DataFrame, *extra: str) -> DataFrame:
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        *extra,
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path()))


@query(
    "op9_decontamination",
    r"""WITH d AS (SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM documents),
b AS (SELECT item_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM benchmark),
widths AS (SELECT DISTINCT least(len(w), 10) AS k FROM b WHERE len(w) > 0),
patterns AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS p
  FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i
    FROM b WHERE len(w) > 0)),
windows AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS p
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d CROSS JOIN widths WHERE len(w) >= k)),
found AS (SELECT doc_id, i, k, item_id FROM windows JOIN patterns USING (k, p)),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS j FROM (SELECT DISTINCT doc_id, i, k FROM found)) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS h
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(h, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    named = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(named, 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@query(
    "op7_exact_dedup",
    """WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)""",
)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    found = exact_dedup.exact_groups(docs.withColumn("text_sha256", digest), carry=("text_sha256",))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query(
    "op8_line_dedup",
    r"""WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, i, array_to_string(l[i:i + 2], chr(10)) AS t
  FROM (SELECT doc_id, l, unnest(generate_series(1, greatest(len(l) - 2, 1))) AS i FROM d)),
n AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS k FROM w WHERE regexp_matches(t, '[^ \t\r\n]')),
c AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 2)) AS j FROM n WHERE k > 1),
k AS (SELECT doc_id, count(*) AS n_kept, string_agg(x, chr(10) ORDER BY j) AS t
  FROM (SELECT doc_id, unnest(l) AS x, unnest(generate_series(1, len(l))) AS j FROM d) ANTI JOIN c USING (doc_id, j) GROUP BY 1)
SELECT doc_id, coalesce(len(l), 0) AS n_lines, coalesce(len(l), 0) - coalesce(n_kept, 0) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM (SELECT doc_id FROM documents) LEFT JOIN d USING (doc_id) LEFT JOIN k USING (doc_id)""",
)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"),
        F.sha2(F.coalesce(line_dedup.kept_text(), F.lit("")), 256).alias("kept_sha256"),
    )


def licence_sql() -> str:
    """The scan with its statements as literal rows."""
    statements = [(s, s.postings()) for s in licences.STATEMENTS]
    rows = ", ".join(
        f"('{s.label}', {s.base}, '{w}', {i}, {key})" for s, postings in statements for w, i, key in postings
    )
    return rf"""WITH p(label, base, w, place, key) AS (VALUES {rows}),
d AS (SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS ws FROM documents),
h AS (SELECT doc_id, i, w FROM (SELECT doc_id, unnest(ws) AS w, unnest(generate_series(0, len(ws) - 1)) AS i FROM d)
  WHERE w IN (SELECT w FROM p)),
idf AS (SELECT w, ln((1 + (SELECT count(*) FROM documents)) / (1 + coalesce(n, 0))::DOUBLE) + 1 AS weight
  FROM (SELECT DISTINCT w FROM p) LEFT JOIN (SELECT w, count(DISTINCT doc_id) AS n FROM h GROUP BY 1) USING (w)),
whole AS (SELECT label, sum(weight) AS total, count(*) FILTER (WHERE key) AS n_key FROM p JOIN idf USING (w) GROUP BY 1),
m AS (SELECT doc_id, label, base, i - place AS start, sum(weight) AS weight, count(*) FILTER (WHERE key) AS n
  FROM h JOIN p USING (w) JOIN idf USING (w) GROUP BY ALL),
f AS (SELECT *, least(round(weight / total, 6), 1.0) AS share FROM m JOIN whole USING (label)
  WHERE n = n_key AND least(round(weight / total, 6), 1.0) >= {licences.LEAST_SHARE}),
g AS (SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word,
    max(start) FILTER (WHERE base) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE base)), ',') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(share) AS score
  FROM f GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN g USING (doc_id)"""


@query("op10_licences", licence_sql())
def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])

    def names(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"),
        names("matches").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"),
    )


@query(
    "op2_substring_dedup",
    r"""WITH d AS (SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w
  FROM documents),
n AS (SELECT doc_id, i, count(*) OVER (PARTITION BY array_to_string(w[i:i + 34], ' ')) AS n
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
c AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS j FROM n WHERE n > 1),
k AS (SELECT doc_id, count(*) AS n_kept, string_agg(x, ' ' ORDER BY j) AS t
  FROM (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS j FROM d) ANTI JOIN c USING (doc_id, j) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""",
)
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.repeated_spans(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_minhash")
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


@query("op1_html")
def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), keep_text=False)
    return found.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query(
    "op5_warc",
    """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
f AS (SELECT b, min(page_id) AS k FROM p WHERE octet_length(b) >= 100 GROUP BY b)
SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest,
  CASE WHEN k <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN k <> page_id THEN k END AS refers_to
FROM p LEFT JOIN f USING (b)""",
)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, folder).select(
        F.col("id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query(
    "op11_ranked_search",
    r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS ws
  FROM documents),
b AS (SELECT item_id, x, count(*) AS qtf FROM (SELECT item_id, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS x FROM benchmark)
  WHERE x <> '' GROUP BY ALL),
s AS (SELECT count(*) AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM d WHERE len(ws) > 0),
t AS (SELECT r, x, count(*) AS tf FROM (SELECT r, unnest(ws) AS x FROM d) WHERE x IN (SELECT x FROM b) GROUP BY ALL),
f AS (SELECT x, count(*) AS df FROM t GROUP BY ALL),
w AS (SELECT x, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM f, s),
m AS (SELECT r, doc_id, 25 + (75 * len(ws) * n_docs) // n_terms AS m FROM d, s WHERE len(ws) > 0),
a AS (SELECT item_id, doc_id, r, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM b JOIN t USING (x) JOIN w USING (x) JOIN m USING (r) GROUP BY ALL),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM a WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10""",
)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op12_chat_format",
    r"""WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ') + length(role) + length(': ') + length(chr(10) || '</turn>' || chr(10))
    + length(regexp_replace(text, '(\\*)(### (?:System:|User:|Assistant:|=)|</turn>)', '\\\1\2', 'g')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id""",
)
def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = "\\### Assistant: </turn> ok"
    hard = spark.createDataFrame([(-7, 0, "user", both), (-7, 1, "assistant", both)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    return chat.read_back(stable(chat.format_turns(turns)))


@query(
    "op13_hard_negatives",
    """WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INT AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)
