"""The operators over their whole tables, as registered queries."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.llm import token_rollups
from sluicework.llm.ann import nearest
from sluicework.llm.fill_middle import fill_in_middle, restore
from sluicework.llm.html_template import main_text
from sluicework.llm.lexical import ranked_search
from sluicework.llm.merkle import audit, warc_layout
from sluicework.llm.ngram_join import ngram_jaccard_components
from sluicework.llm.packing import pack_along_curve
from sluicework.llm.poisson_mix import TERMS, poisson_mix
from sluicework.llm.quality import classify, grades_of
from sluicework.llm.sentence_spans import remove_repeated_spans
from sluicework.llm.topk import exact_top_k
from sluicework.llm.url_filter import Rule, filter_urls
from sluicework.registry.common import Query, table
from sluicework.sources.scratch import scratch_dir, written_out

# The rules of the contract.
URL_RULES = (
    Rule("com/", "allow"),
    Rule("example.com/en/", "block"),
    Rule("www.example.com/en/", "allow"),
    Rule("net/es/", "block"),
    Rule("net/fr/", "block"),
)

#: Bytes of a WARC file, about.
WARC_BYTES = 1 << 25


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's URL ends with the number of its document; URLs of documents labelled as of
    low quality are those to block."""
    pages = table(spark, sf_dir, "pages")
    number = F.regexp_extract("url", "/[a-z]{2}/([0-9]{1,18})", 1).try_cast("long")
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("blocked"))
    labelled = pages.select("url", number.alias("doc_id")).join(labels, "doc_id").select("url", "blocked")
    return filter_urls(pages, labelled, URL_RULES).drop("url")


def op2_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_along_curve(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op4_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op5_sentence_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeated_spans(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", "removed_sentences", F.length("text").cast("long").alias("kept_chars"))


def op6_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records in two replicas. The second is damaged where the hash of
    a record says so: of such records half have a byte changed, a quarter are cut, a
    quarter are gone."""
    pages = table(spark, sf_dir, "pages")
    size = F.coalesce(F.octet_length("url"), F.lit(0)) + F.coalesce(F.octet_length("html"), F.lit(0)) + 100
    files = 1 + (pages.agg(F.sum(size.cast("long"))).first()[0] or 0) // WARC_BYTES
    good = written_out(warc_layout(pages, files))
    return audit(good, _damaged(good)).withColumn("file", F.col("file").cast("long"))


def _damaged(records: DataFrame) -> DataFrame:
    digest = F.md5("record")
    kind = F.conv(F.substring(digest, 3, 1), 16, 10).cast("int")
    is_hit = F.substring(digest, 1, 2) < "04"
    cut = F.substring("record", F.lit(1), F.octet_length("record") - 10)
    changed = F.overlay("record", F.lit(b"\x00"), F.lit(20), F.lit(1))
    return records.filter(~(is_hit & (kind >= 12))).withColumn(
        "record", F.when(is_hit & (kind < 8), changed).when(is_hit, cut).otherwise(F.col("record"))
    )


OP6_SQL = f"""
WITH texts AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: '
    || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
    || chr(13) || chr(10) || chr(13) || chr(10) AS record,
    (SELECT 1 + sum(coalesce(strlen(url), 0) + coalesce(strlen(html), 0) + 100) // {WARC_BYTES} FROM pages) AS files
  FROM pages),
sized AS (
  SELECT page_id, record, md5(record) AS digest, strlen(record) AS length,
    ('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), '')), 1, 8))::BIGINT % files AS file FROM texts),
placed AS (
  SELECT *, coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id NULLS FIRST, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
    ('0x' || substr(digest, 3, 1))::INT AS kind FROM sized)
SELECT file::BIGINT AS file, start::BIGINT AS "offset", length::BIGINT AS length_a,
  CASE WHEN kind < 8 THEN length WHEN kind < 12 THEN length - 10 END::BIGINT AS length_b,
  CASE WHEN kind < 12 THEN 'changed' ELSE 'missing' END AS problem
FROM placed WHERE substr(digest, 1, 2) < '04'
"""


def op7_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are added, by words; then those labelled as toxic are deleted and all
    German ones counted anew, by bytes; that batch is committed twice."""
    documents = table(spark, sf_dir, "documents")
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct()
    words = written_out(token_rollups.count_tokens(documents, public_tokenizers.path("word_bpe_49k.json"), "words-1"))
    recounted = token_rollups.count_tokens(
        documents.filter("lang = 'de'"), public_tokenizers.path("byte_bpe_50k.tiktoken"), "bytes-1"
    )
    kept = words.join(toxic, "doc_id", "left_anti")
    changes = written_out(
        token_rollups.signed(words.join(toxic, "doc_id", "left_semi"), -1)
        .unionByName(token_rollups.signed(kept.filter("lang = 'de'"), -1))
        .unionByName(token_rollups.signed(recounted.join(toxic, "doc_id", "left_anti"), 1))
    )
    path = scratch_dir(spark)
    token_rollups.create(spark, path)
    token_rollups.commit(path, "1", token_rollups.signed(words, 1))
    token_rollups.commit(path, "2", changes)
    token_rollups.commit(path, "2", changes)
    return token_rollups.totals(spark, path)


def op8_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix(table(spark, sf_dir, "documents"))


#: The same draw in SQL: sums of the distribution by recursion, rates of at most 16.
OP8_SQL = f"""
WITH RECURSIVE sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, 1.0::DOUBLE / (SELECT count(*)::DOUBLE FROM sizes) * (SELECT sum(n)::DOUBLE FROM sizes) / n AS rate
  FROM sizes),
parts AS (SELECT source, greatest(1, ceil(rate / 16.0))::INT AS parts, rate / greatest(1, ceil(rate / 16.0)) AS rate FROM rates),
sums AS (
  SELECT source, rate, parts, 0 AS k, exp(-rate) AS p, exp(-rate) AS below FROM parts
  UNION ALL
  SELECT source, rate, parts, k + 1, p * rate / (k + 1), below + p * rate / (k + 1) FROM sums WHERE k < {TERMS - 1}),
laws AS (SELECT source, parts, list(below ORDER BY k) AS law FROM sums GROUP BY source, parts),
draws AS (
  SELECT d.*, coalesce(CAST(doc_id AS VARCHAR), md5(text), '') AS name, law, unnest(range(1, parts + 1)) AS part
  FROM documents d JOIN laws l ON d.source IS NOT DISTINCT FROM l.source),
counts AS (
  SELECT doc_id, text, lang, source, n_chars, name,
    sum(len(list_filter(law, lambda x: x <= ('0x' || substr(md5(concat_ws(':', '0', name, CAST(part AS VARCHAR))), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0)))::INT AS n_copies
  FROM draws GROUP BY ALL),
copies AS (SELECT *, unnest(range(1, n_copies + 1))::INT AS copy FROM (SELECT doc_id, text, lang, source, n_chars, name, n_copies FROM counts))
SELECT doc_id, text, lang, source, n_chars, copy, n_copies, md5(concat_ws(':', '0:order', name, CAST(copy AS VARCHAR))) AS order_key
FROM copies
"""


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


OP9_SQL = """
WITH levels AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM levels q JOIN levels c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op10_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = classify(table(spark, sf_dir, "documents"), grades_of(table(spark, sf_dir, "labels")))
    return graded.select("doc_id", "expected_grade", "tail", "keep")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)


OP11_SQL = r"""
WITH found AS (
  SELECT doc_id, row_no, unnest(terms) AS term, len(terms) AS n FROM (
    SELECT doc_id, row_number() OVER () AS row_no, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents)),
postings AS (SELECT doc_id, row_no, term, n::BIGINT AS n, count(*)::BIGINT AS tf FROM found GROUP BY ALL),
corpus AS (SELECT count(DISTINCT row_no)::BIGINT AS docs, count(*)::BIGINT AS all_terms FROM found),
weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * (SELECT docs FROM corpus) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
  FROM postings GROUP BY term),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scores AS (
  SELECT item_id, row_no, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // all_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term), corpus GROUP BY item_id, row_no, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scores WHERE score > 0)
WHERE rank <= 20
"""


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = fill_in_middle(table(spark, sf_dir, "documents")).withColumn("row", F.struct("doc_id", "n", "form", "prefix_chars", "middle_chars"))
    key = F.struct("row.*", F.sha2("output", 256).alias("output_sha256"))
    back = restore(outputs.select(key.alias("row"), "form", "output"), "row")
    return back.select("row.*", F.sha2("text", 256).alias("restored_sha256"))


OP12_SQL = r"""
WITH tokens AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t FROM documents),
drawn AS (
  SELECT *, len(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(t) + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (len(t) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
      WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM tokens),
parts AS (
  SELECT *, coalesce(array_to_string(t[1:least(a, b)], ''), '') AS prefix,
    coalesce(array_to_string(t[least(a, b) + 1:greatest(a, b)], ''), '') AS middle,
    coalesce(array_to_string(t[greatest(a, b) + 1:], ''), '') AS suffix FROM drawn)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""


def op13_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_url_filter": Query(op1_url_filter),
    "op2_curve_packing": Query(op2_curve_packing),
    "op3_ngram_jaccard_join": Query(op3_ngram_jaccard_join),
    "op4_collision_counting": Query(op4_collision_counting),
    "op5_sentence_span_dedup": Query(op5_sentence_span_dedup),
    "op6_merkle_audit": Query(op6_merkle_audit, OP6_SQL),
    "op7_token_rollups": Query(op7_token_rollups),
    "op8_poisson_mix": Query(op8_poisson_mix, OP8_SQL),
    "op9_exact_top_k": Query(op9_exact_top_k, OP9_SQL),
    "op10_ordinal_quality": Query(op10_ordinal_quality),
    "op11_ranked_search": Query(op11_ranked_search, OP11_SQL),
    "op12_fill_middle": Query(op12_fill_middle, OP12_SQL),
    "op13_html_template": Query(op13_html_template),
}
