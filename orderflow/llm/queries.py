"""Registered queries of this subpackage, one for each operator, over whole tables, and their SQL."""

from pyspark.sql import functions as F

from orderflow.llm import byte_bpe, repair
from orderflow.llm.common import remainder_of_id, table
from orderflow.llm.fill_middle import MIDDLE, PREFIX, SUFFIX, infilled, restored
from orderflow.llm.filter_audit import audit as filter_audit
from orderflow.llm.host_rank import url_verdicts
from orderflow.llm.license_scan import PHRASES, TEMPLATES, THRESHOLD, licenses
from orderflow.llm.line_crf import quality
from orderflow.llm.lsh_forest import near_duplicates
from orderflow.llm.merkle_audit import FILE_SPAN, audit, warc_record
from orderflow.llm.qgram_filter import leaks
from orderflow.llm.quality_rules import STOP_WORDS, judged
from orderflow.llm.source_mix import mixture
from orderflow.llm.toxicity import toxicity

QUALITY_LIMIT, TOXIC_LIMIT = 0.7, 0.5


def op1_decontamination(spark, folder):
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_quality_classifier(spark, folder):
    scores = quality(table(spark, folder, "documents"), table(spark, folder, "labels"), split=4, held_out=2)
    return scores.select("doc_id", (remainder_of_id(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= QUALITY_LIMIT).cast("int").alias("predicted"))


def op3_license_scan(spark, folder):
    return licenses(table(spark, folder, "documents"))


def op4_url_filter(spark, folder):
    return url_verdicts(table(spark, folder, "pages"))


def op5_ngram_jaccard(spark, folder):
    return near_duplicates(table(spark, folder, "documents"))


def op6_toxicity(spark, folder):
    scores = toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), split=5, held_out=0)
    return scores.select("doc_id", (remainder_of_id(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= TOXIC_LIMIT).cast("int").alias("predicted"))


def op7_merkle_audit(spark, folder):
    """Audits the pages as archive records against a replica with damage: bytes changed, records lost and
    records written twice, each where the digest of the page's id begins with a certain byte."""
    pages = table(spark, folder, "pages")
    luck = F.substring(F.md5(F.col("page_id").cast("string")), 1, 2)
    body = F.coalesce("html", F.lit(""))
    damaged = F.when(luck == "07", F.concat(F.lit("#"), F.substring(body, 2, 2**31 - 1))).otherwise(body)
    times = F.when(luck == "08", 0).when(luck == "09", 2).otherwise(1)
    copy = pages.select("page_id", "url", damaged.alias("html"), F.explode(F.array_repeat(F.lit(1), times)))
    return audit(pages, copy, "page_id", warc_record(F.col("url"), F.col("html")))


def op8_token_ids(spark, folder):
    import public_tokenizers

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return repair.decoded(repair.stored(table(spark, folder, "documents"), vocabulary))


def op9_quality_rules(spark, folder):
    return judged(table(spark, folder, "documents"))


def op10_source_mix(spark, folder):
    return mixture(table(spark, folder, "documents"))


def op11_fill_middle(spark, folder):
    rows = infilled(table(spark, folder, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_byte_bpe(spark, folder):
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = byte_bpe.encoded(table(spark, folder, "documents"), ranks, pattern)
    data = byte_bpe.decoded(F.col("ids"), ranks, pattern)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(data, 256).alias("decoded_sha256"))


def op13_filter_audit(spark, folder):
    return filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_license_scan": op3_license_scan,
    "op4_url_filter": op4_url_filter,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_toxicity": op6_toxicity,
    "op7_merkle_audit": op7_merkle_audit,
    "op8_token_ids": op8_token_ids,
    "op9_quality_rules": op9_quality_rules,
    "op10_source_mix": op10_source_mix,
    "op11_fill_middle": op11_fill_middle,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_filter_audit": op13_filter_audit,
}


def _texts(values):
    return ", ".join("'" + v + "'" for v in values)


_TEMPLATE_ROWS = ", ".join(
    f"('{label}', [{_texts(sorted(set(text.split())))}])" for label, text in TEMPLATES
)
_PHRASE_ROWS = ", ".join(f"('{label}', [{_texts(p.split())}])" for p, label in PHRASES.items())
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op3_license_scan": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_LOWER} AS t FROM documents),
w AS (SELECT r, doc_id, regexp_extract_all(t, '{_WORD}') AS ws FROM d),
phrases(label, ps) AS (VALUES {_PHRASE_ROWS}),
places AS (
  SELECT r, label, i - 1 AS place FROM
    (SELECT r, ws, unnest(generate_series(1, len(ws))) AS i FROM w), phrases
  WHERE ws[i] = ps[1] AND list_slice(ws, i, i + len(ps) - 1) = ps),
base AS (
  SELECT r, count(*) AS n, min(place) AS f, max(place) AS l, list(DISTINCT label) AS labels FROM places GROUP BY r),
templates(label, ts) AS (VALUES {_TEMPLATE_ROWS}),
blocks AS (
  SELECT r, list_distinct(regexp_extract_all(b, '{_WORD}')) AS bs
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS b FROM d)),
fits AS (
  SELECT r, label, len(list_intersect(bs, ts)) / len(ts) AS c FROM blocks, templates
  WHERE len(list_intersect(bs, ts)) >= greatest(1, ceil({THRESHOLD} * len(ts) - 1e-9))),
more AS (SELECT r, list(DISTINCT label) AS labels, max(c) AS c FROM fits GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, base.f::BIGINT AS first_word,
  base.l::BIGINT AS last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',')
    AS labels,
  CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(more.c, 0)::DOUBLE END AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN more USING (r)""",
    "op7_merkle_audit": f"""
WITH p AS (
  SELECT page_id AS id, page_id // {FILE_SPAN} AS file, left(md5(CAST(page_id AS VARCHAR)), 2) AS luck,
    strlen('WARC/1.1' || 'WARC-Type: response' || 'WARC-Target-URI: ' || coalesce(url, '') || 'Content-Length: '
      || strlen(coalesce(html, '')) || coalesce(html, '')) + 14 AS length
  FROM pages),
placed AS (
  SELECT *, coalesce(sum(length) OVER (
    PARTITION BY file ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset" FROM p)
SELECT id, CASE luck WHEN '07' THEN 'changed' WHEN '08' THEN 'missing' ELSE 'extra' END AS kind, file,
  CAST("offset" AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length
FROM placed WHERE luck IN ('07', '08', '09')""",
    "op9_quality_rules": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
        regexp_replace(t, '[\x20\x09-\x0D]', '', 'g') AS solid,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
windows AS (
  SELECT r, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS win
  FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM w)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(8)) AS k) GROUP BY r),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(solid)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(ws, lambda x: x IN ({_texts(dict.fromkeys(STOP_WORDS))}))) AS n_stop, len(ls) AS n_lines,
    len(list_filter(ls, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…')) AS n_cut,
    len(list_filter(ls, lambda x: ltrim(x, ' ')[1] IN ('-', '*', '•'))) AS n_bullets
  FROM w LEFT JOIN covered c USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 1.5 * n_words AND word_chars <= 15 * n_words AND 5 * n_symbols <= n_words
    AND (n_words < 100 OR 50 * n_stop >= n_words) AND 2 * n_dup_lines <= n_lines AND 2 * n_cut <= n_lines
    AND 10 * n_bullets <= 9 * n_lines AS kept
FROM b""",
    "op11_fill_middle": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
u AS (SELECT r, doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS us,
    [CAST('0x' || substr(digest, 8 * k + 1, 8) AS BIGINT) for k in range(4)] AS h FROM d),
c AS (SELECT *, least(h[1] % (len(us) + 1), h[2] % (len(us) + 1)) AS a,
    greatest(h[1] % (len(us) + 1), h[2] % (len(us) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h[3] % 100 >= 90
      THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(us[:a], ''), '') AS pre, coalesce(array_to_string(us[a + 1:b], ''), '') AS mid,
    coalesce(array_to_string(us[b + 1:], ''), '') AS suf FROM c)
SELECT doc_id, len(us)::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
    ELSE '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p""",
    "op13_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^ 	-
]+') AS ws FROM d),
known AS (SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INT)) AS good, max(CAST(coalesce(toxic = 1, false) AS INT)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    list_filter([CASE WHEN len(ws) < 100 THEN 'A' END,
      CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' END,
      CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
      CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 'E' END], lambda x: x IS NOT NULL) AS fails
  FROM w LEFT JOIN known ON w.doc_id = known.doc_id),
cells AS (SELECT part, fails, good, toxic, count(*) AS n FROM m GROUP BY ALL),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
walked AS (
  SELECT *, filter_order[step] AS f, list_has_any(fails, string_split(filter_order[:step - 1], '')) AS gone
  FROM cells, orders, (SELECT unnest(range(1, 6)) AS step)),
counted AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN NOT gone AND NOT list_contains(fails, f) THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT gone AND list_contains(fails, f) THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND list_contains(fails, f) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = [f] THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND list_contains(fails, f) THEN n * good ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT gone AND list_contains(fails, f) THEN n * toxic ELSE 0 END) AS toxic_lost
  FROM walked GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted""",
}
