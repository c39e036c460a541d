"""The registered queries of the training-data operators, and their SQL twins."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etalage.sources.io import read_source

from .chat_format import repair_chats
from .conversation_repair import repair_conversations, turns
from .decontaminate import find_contamination
from .hard_negatives import mine_hard_negatives
from .html_extract import extract_text
from .mixing import mix_sources
from .near_dedup import group_near_duplicates
from .order_minhash import fingerprints
from .quality_forest import COUNTS, judge_quality
from .storage import fresh_path
from .substring_dedup import removal_intervals
from .token_files import tokens_to_files
from .url_filter import judge_urls
from .warc import read_archives, resolve_revisits, write_archives

#: (host, path, verdict)
URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


def word_bpe() -> str:
    """The tokenizer's file; its directory may be given in ETALAGE_TOKENIZERS."""
    name, folder = "word_bpe_49k.json", os.environ.get("ETALAGE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = read_source(spark, sf_dir, "pages", ["page_id", "url"])
    return judge_urls(pages, rules).select("key.page_id", "host", "path", "rule", "verdict")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_source(spark, sf_dir, "pages", ["page_id", "url", "html"])
    path = fresh_path(spark, "warc")
    write_archives(resolve_revisits(pages), path)
    return read_archives(spark, path)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_source(spark, sf_dir, "documents", ["doc_id", "text"])
    return tokens_to_files(docs, word_bpe(), by_word=True)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_source(spark, sf_dir, "documents", ["doc_id", "text"])
    return removal_intervals(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_source(spark, sf_dir, "pages", ["page_id", "url", "html"])
    out, name = extract_text(pages, keep=["page_id", "url"])
    return out.select("page_id", "url", f"{name}.*")


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_near_duplicates(read_source(spark, sf_dir, "documents", ["doc_id", "text"]))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_source(spark, sf_dir, "documents", ["doc_id", "text", "source"])).select("mix.*")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_chats(read_source(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_source(spark, sf_dir, "documents", ["doc_id", "text"])
    out, name = judge_quality(docs, read_source(spark, sf_dir, "labels", ["doc_id", "quality"]), keep=["doc_id"])
    return out.select("doc_id", *[f"{name}.{c}" for c in (*COUNTS, "base_failed", "score", "kept")])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_source(spark, sf_dir, "documents", ["doc_id", "text"])
    out, name = find_contamination(docs, read_source(spark, sf_dir, "benchmark", ["item_id", "text"]), keep=["doc_id"])
    return out.select(
        "doc_id", f"{name}.n_words", f"{name}.n_hit", F.size(f"{name}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(f"{name}.items", ","), 256).alias("items_sha256"), f"{name}.contaminated")


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_source(spark, sf_dir, "documents", ["doc_id", "text"])
    return fingerprints(docs).select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
                                     "near_edited", "near_next")


def damaged(rows: DataFrame) -> DataFrame:
    """The rows of :func:`turns` with faults put in, by crc32(conv_id:turn) % 20."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name.cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    return turns(rows.where(kind != 0).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_source(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    return repair_conversations(damaged(turns(rows)), rows.select("conv_id"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_source(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = mine_hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


QUERIES = {f.__name__: f for f in (
    op1_url_filters, op2_warc, op3_token_files, op4_substring_dedup, op5_html_extraction, op6_minhash_dedup,
    op7_source_mixing, op8_chat_format, op9_quality_rules, op10_decontamination, op11_document_fingerprints,
    op12_conversation_repair, op13_hard_negatives)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"



def _plus(value: str, cost: str | int, letters: str) -> str:
    """SQL: a state's value (its cost in eight digits, then its audit; null: not reached) after one more edit."""
    return f"(lpad((left({value}, 8)::BIGINT + {cost})::VARCHAR, 8, '0') || substr({value}, 9) || '{letters}')"


def _least(*values: str) -> str:
    return f"list_min([{', '.join(values)}])"


def _audit_sql(a: str, y: str) -> str:
    """SQL: the values of the four states (nothing yet, system, user, assistant) ``a`` after the row ``y``."""
    nothing, system = f"{a}.v[1]", f"{a}.v[2]"
    user = _least(f"{a}.v[3]", *[_plus(f"{a}.v[{k}]", 5, "I") for k in (1, 2, 4)])
    assistant = _least(f"{a}.v[4]", _plus(f"{a}.v[3]", 5, "I"), *[_plus(f"{a}.v[{k}]", 10, "II") for k in (1, 2)])

    def when(role: str, value: str) -> str:
        return f"CASE WHEN {y}.r = '{role}' THEN {_plus(value, f'{y}.more', 'K')} END"

    def rerole(value: str) -> str:
        return f"CASE WHEN NOT {y}.gone THEN {_plus(value, f'{y}.more + 1', 'R')} END"

    drop = [_plus(v, 2, "D") for v in (nothing, system, user, assistant)]
    before = (nothing, system, assistant)
    return "[" + ", ".join((
        drop[0], _least(drop[1], when("s", nothing)), _least(drop[2], *map(rerole, before), *[when("u", v) for v in before]),
        _least(drop[3], rerole(user), when("a", user)))) + "]"


ORACLE = {
    "op1_url_filters": r"""
WITH cut AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, """ + _LOWER.format(r"regexp_extract(rest, '^[^/?#]*')") + r""" AS host,
         regexp_replace(regexp_extract(rest, '^[^?#]*'), '^[^/?#]*', '') AS path FROM cut),
rules(host, path, verdict) AS (VALUES """ + ", ".join(map(str, URL_RULES)) + r"""),
fits AS (
  SELECT p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY 1)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM parts p LEFT JOIN fits f USING (page_id)""",
    "op2_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (
  SELECT page_id, payload, strlen(payload)::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31), 1)), '') AS payload_digest
  FROM p),
f AS (SELECT payload, min(page_id) AS first FROM b GROUP BY payload)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to FROM b JOIN f USING (payload)""",
    "op4_substring_dedup": r"""
WITH d AS (SELECT doc_id, """ + _SPACED.format("coalesce(text, '')") + r""" AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
least AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM win JOIN least USING (s) WHERE m < doc_id),
g AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id),
r AS (
  SELECT d.doc_id, len(w) AS n, coalesce(len(ks), 0) AS gone,
    array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: ks IS NULL OR NOT list_contains(ks, i)), lambda i: w[i]), ' ') AS kept
  FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, n::BIGINT AS n_words, gone::BIGINT AS n_removed, sha256(kept) AS kept_sha256 FROM r""",
    "op6_minhash_dedup": r"""
WITH RECURSIVE d AS (SELECT doc_id, """ + _SPACED.format(_LOWER.format("coalesce(text, '')")) + r""" AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 80 * (x.n + y.n - m)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(v, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.c FROM reach r JOIN both_ways e ON e.a = r.v),
c AS (SELECT v, min(c) AS c FROM reach GROUP BY v)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.c AS component_id, d.doc_id = c.c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.v = d.doc_id""",
    "op10_decontamination": r"""
WITH d AS (SELECT doc_id, """ + _ALNUM.format(_LOWER.format("coalesce(text, '')")) + r""" AS w FROM documents),
b AS (SELECT item_id, """ + _ALNUM.format(_LOWER.format("coalesce(text, '')")) + r""" AS w FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM p),
win AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, i, win.n FROM win JOIN p ON p.n = win.n AND p.s = win.s),
covered AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
  sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN items t USING (doc_id)""",
    "op12_conversation_repair": r"""
WITH o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS name FROM conversations),
k AS (
  SELECT * EXCLUDE (name), xor(4294967295, list_reduce(list_transform(name, lambda ch: ascii(ch)::BIGINT), lambda c, b: list_reduce(
    [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda q, z: CASE WHEN q & 1 = 1 THEN xor(q >> 1, 3988292384) ELSE q >> 1 END, xor(c, b)), 4294967295::BIGINT)) % 20 AS kind
  FROM o),
d AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM k WHERE kind <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM d),
f AS (
  SELECT *, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before, CASE
    WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE 'none' END AS fault FROM n),
c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal,
    list({'r': CASE WHEN fault IN ('blank', 'duplicate') THEN '' ELSE r END, 'gone': fault IN ('blank', 'duplicate'),
          'more': CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'v': ['00000000', NULL, NULL, NULL]} ORDER BY i) AS moves,
    list(role ORDER BY i) AS roles, list(text ORDER BY i) AS texts FROM f GROUP BY conv_id),
e AS (
  SELECT *, list_reduce(moves, lambda a, y: {'r': y.r, 'gone': y.gone, 'more': y.more, 'v': """ + _audit_sql("a", "y") + r"""},
    {'r': '', 'gone': false, 'more': 0, 'v': ['00000000', NULL, NULL, NULL]}).v AS v FROM c),
a AS (
  SELECT * EXCLUDE (best), left(best, 8)::BIGINT AS cost, substr(best, 9) AS audit
  FROM (SELECT *, """ + _least("v[1]", _plus("v[2]", 10, "II"), _plus("v[3]", 5, "I"), "v[4]") + r""" AS best FROM e)),
l AS (SELECT conv_id, audit, roles, texts, unnest(range(1, length(audit) + 1)) AS place FROM a),
m AS (
  SELECT conv_id, place, roles, texts, substr(audit, place, 1) AS letter, length(replace(left(audit, place), 'I', '')) AS i, length(replace(left(audit, place), 'D', '')) AS j,
    left(roles[length(regexp_extract(audit, '^D*')) + 1], 1) = 's' AND starts_with(ltrim(audit, 'D'), 'K') AS opened FROM l),
w AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN roles[i] WHEN (j + opened::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN letter = 'I' THEN '' ELSE texts[i] END, chr(10) ORDER BY place) AS repaired FROM m WHERE letter <> 'D' GROUP BY conv_id)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM ids.conv_id""",
    "op13_hard_negatives": r"""
WITH r AS (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
t AS (SELECT n, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM r WHERE label IS NOT NULL),
s AS (
  SELECT a.n, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM t a JOIN t b ON a.n <> b.n WHERE a.vec_id % 50 = 0),
p AS (
  SELECT n, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS k
  FROM s WHERE same QUALIFY k <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.n, k ORDER BY score DESC, vec_id)::INT AS rank, vec_id AS negative_id,
  positive_score, score AS negative_score
FROM p JOIN s ON s.n = p.n AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""",
}
