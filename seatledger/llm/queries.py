"""Registry of the operators of this folder: query name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from . import decontam, langmodel, license, mixture, neardup, quality, spelling, substrings, tokens, toxicity, urlfilter, warc, whitening
from .common import table


def op1_langmodel(spark, sf_dir):
    return langmodel.score(table(spark, sf_dir, "documents"))


def op2_license(spark, sf_dir):
    return license.scan(table(spark, sf_dir, "documents")).drop("detections")


def op3_substrings(spark, sf_dir):
    return substrings.dedup(table(spark, sf_dir, "documents")).drop("kept")


def op4_tokens(spark, sf_dir):
    return tokens.materialised_order(table(spark, sf_dir, "documents")).drop("tokens")


def op5_decontam(spark, sf_dir):
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op7_mixture(spark, sf_dir):
    return mixture.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_neardup(spark, sf_dir):
    return neardup.find(table(spark, sf_dir, "documents")).drop("row_key")


def op9_warc(spark, sf_dir):
    return warc.read_archives(warc.write(table(spark, sf_dir, "pages")))


def op10_quality(spark, sf_dir):
    return quality.report(table(spark, sf_dir, "documents"))


def op11_spelling(spark, sf_dir):
    return spelling.group(table(spark, sf_dir, "documents"))


def op12_urlfilter(spark, sf_dir):
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op13_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_langmodel": op1_langmodel,
    "op2_license": op2_license,
    "op3_substrings": op3_substrings,
    "op4_tokens": op4_tokens,
    "op5_decontam": op5_decontam,
    "op6_toxicity": op6_toxicity,
    "op7_mixture": op7_mixture,
    "op8_neardup": op8_neardup,
    "op9_warc": op9_warc,
    "op10_quality": op10_quality,
    "op11_spelling": op11_spelling,
    "op12_urlfilter": op12_urlfilter,
    "op13_whitening": op13_whitening,
}

#: DuckDB SQL over whole tables, where SQL expresses all columns. What it does not: op1 and op6 learn models whose sums
#: depend on the order of addition, op2 and op5 have rules and a search of their own, op3 works on bytes, op4 on a
#: permutation of token IDs, op7 on a shuffle by hashes, op12 learns models, op13 needs eigenvectors; these are held against brute
#: force in the tests.
ORACLE_SQL: dict[str, str] = {
    # Every pair of sets that share a shingle; components by the least id reached.
    "op8_neardup": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g FROM w, LATERAL (SELECT unnest(range(1, greatest(len(w), 2))) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM k JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS d, doc_id AS m FROM documents UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.d AND r.m < e.b), c AS (SELECT d, min(m) AS component_id FROM r GROUP BY d)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM documents LEFT JOIN n USING (doc_id) JOIN c ON c.d = doc_id""",
    "op9_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages), f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM p LEFT JOIN f USING (d)""",
    # CRC-32 by its rule, a byte at a time; near words meet at what is left when one code point goes.
    "op11_spelling": r"""
WITH RECURSIVE bits AS (SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
u AS (SELECT id, run, count(*) AS n, list_transform(string_split(regexp_replace(hex(encode(id || ':' || run)), '(..)', '\1 ', 'g'), ' ')[:-2], lambda x: CAST('0x' || x AS BIGINT)) AS bytes FROM r GROUP BY id, run),
h AS (SELECT run, n, xor(list_reduce(list_concat([4294967295], bytes), lambda c, b: xor(c // 256, t[1 + xor(c % 256, b)])), 4294967295) AS h, length(run) AS l FROM u, bits),
w AS (SELECT CASE WHEN h % 31 = 0 THEN run[:h % l] || run[h % l + 2:] ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n FROM h GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2),
d AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM w, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
p AS (SELECT a.word, b.word AS other, b.n FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word UNION SELECT d.word, w.word, w.n FROM d JOIN w ON w.word = d.rest UNION SELECT w.word, d.word, d.n FROM d JOIN w ON w.word = d.rest),
m AS (SELECT word, count(*) AS n_near, max(n) AS most FROM p GROUP BY word), b AS (SELECT p.word, min(other) AS best FROM p JOIN m ON m.word = p.word AND p.n = m.most GROUP BY p.word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * w.n THEN best END AS form, CASE WHEN most >= 10 * w.n THEN most END AS form_n FROM w LEFT JOIN m USING (word) LEFT JOIN b USING (word)),
c AS (SELECT word, word AS at FROM f UNION ALL SELECT c.word, f.form FROM c JOIN f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM f JOIN c USING (word) JOIN f e ON e.word = c.at AND e.form IS NULL""",
    # The base metrics, and the rules of the method in any order.
    "op10_quality": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM d, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i) WHERE len(w) > 2),
q AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1), v AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM q, (VALUES (0), (1), (2)) o(j) GROUP BY doc_id),
x AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda y: regexp_matches(y, '[^\x20\x09-\x0D]')) AS l FROM d),
m AS (SELECT doc_id, t, len(w) AS n_words, list_sum(list_transform(w, lambda y: length(y))) AS chars, length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_upper, length(t) - length(regexp_replace(t, '[\p{L}\p{M}]', '', 'g')) AS n_letters,
len(list_filter(l, lambda y: rtrim(y, ' ') LIKE '%...' OR rtrim(y, ' ') LIKE '%…')) AS n_cut, len(list_filter(l, lambda y: ltrim(y, ' ') LIKE '•%' OR ltrim(y, ' ') LIKE '- %' OR ltrim(y, ' ') LIKE '* %')) AS n_bullets FROM d JOIN x USING (doc_id) LEFT JOIN v USING (doc_id)),
b AS (SELECT *, CAST(coalesce(chars, 0) AS BIGINT) AS word_chars, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
NOT (base_failed OR 10 * n_symbols > n_words OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words OR (n_dup_lines > 3 AND 2 * n_dup_lines > n_lines) OR 10 * n_upper > 4 * n_letters OR 10 * n_letters < 6 * word_chars OR (n_cut > 0 AND 10 * n_cut > 3 * n_lines) OR (n_bullets > 3 AND 10 * n_bullets > 9 * n_lines)) AS kept FROM b""",
}
