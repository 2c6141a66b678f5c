"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

import public_tokenizers

from .common import table
from .fill_in_middle import fill_in_middle
from .html_extract import extract_pages
from .language_id import language_report
from .license_scan import scan_licenses
from .line_dedup import line_dedup_report
from .mih import nearest
from .minhash import near_duplicate_report
from .packing import pack
from .piece_bpe import encode_documents
from .simhash import simhash_components
from .spotsigs import fingerprint_report
from .url_filter import url_filter_report
from .whitening import whiten

PIECE_MODEL, WORD_TOKENIZER = "piece_bpe_32k.model", "word_bpe_49k.json"

QUERIES = {
    "op1_html_extract": lambda spark, d: extract_pages(table(spark, d, "pages")),
    "op2_license_scan": lambda spark, d: scan_licenses(table(spark, d, "documents")),
    "op3_line_dedup": lambda spark, d: line_dedup_report(table(spark, d, "documents")),
    "op4_piece_bpe": lambda spark, d: encode_documents(table(spark, d, "documents"), public_tokenizers.path(PIECE_MODEL)),
    "op5_minhash": lambda spark, d: near_duplicate_report(table(spark, d, "documents")),
    "op6_packing": lambda spark, d: pack(table(spark, d, "documents"), public_tokenizers.path(WORD_TOKENIZER)),
    "op7_url_filter": lambda spark, d: url_filter_report(table(spark, d, "pages")),
    "op8_spotsigs": lambda spark, d: fingerprint_report(table(spark, d, "documents")),
    "op9_language_id": lambda spark, d: language_report(table(spark, d, "documents")),
    "op10_mih": lambda spark, d: nearest(table(spark, d, "embeddings")),
    "op11_whitening": lambda spark, d: whiten(table(spark, d, "embeddings")),
    "op12_simhash": lambda spark, d: simhash_components(table(spark, d, "documents")),
    "op13_fill_in_middle": lambda spark, d: fill_in_middle(table(spark, d, "documents"), with_output=False),
}

ORACLE_SQL: dict[str, str] = {
    "op3_line_dedup": """
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper IS NOT NULL AND keeper <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key) GROUP BY doc_id""",
    "op7_url_filter": """
WITH parts AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
rules AS (SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) r(rh, rp, rv)),
fits AS (SELECT page_id, rh || rp AS rule, rv, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k
  FROM parts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict FROM parts LEFT JOIN (SELECT * FROM fits WHERE k = 1) f USING (page_id)""",
    "op13_fill_in_middle": r"""
WITH drawn AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS mark,
  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units FROM documents),
h AS (SELECT doc_id, t, units, CAST(len(units) AS BIGINT) AS n, CAST('0x' || mark[1:8] AS BIGINT) AS h1, CAST('0x' || mark[9:16] AS BIGINT) AS h2, CAST('0x' || mark[17:24] AS BIGINT) AS h3, CAST('0x' || mark[25:32] AS BIGINT) AS h4 FROM drawn),
cut AS (SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
  coalesce(array_to_string(units[1:least(h1 % (n + 1), h2 % (n + 1))], ''), '') AS p,
  coalesce(array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], ''), '') AS m FROM h),
whole AS (SELECT *, substr(t, length(p) + length(m) + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM whole""",
}
