"""DuckDB SQL of the operators that SQL can express, over the same Parquet tables."""

from __future__ import annotations

#: CRC-32 of a byte string by a table of 256 entries, bytes as a list of whole numbers.
CRC = """crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_concat([b], range(8)), lambda c, i:
             CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS b)))"""


def crc32(text: str) -> str:
    """Of an expression of type VARCHAR; needs the CTE crc_table in the FROM clause as ``crc_table``."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    step = "lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])"
    return f"xor(list_reduce(list_concat([4294967295], {octets}), {step}), 4294967295)"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""WITH {CRC},
texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS row, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
words AS (
  SELECT kind, row, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM texts),
grams AS (
  SELECT kind, row, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS gram
  FROM words),
hashed AS (SELECT gram, {crc32("gram")} % 10000 AS bucket FROM (SELECT DISTINCT gram FROM grams), crc_table),
counted AS (SELECT kind, row, bucket, count(*) AS n FROM grams JOIN hashed USING (gram) GROUP BY 1, 2, 3),
sizes AS (
  SELECT b AS bucket, coalesce(sum(n) FILTER (kind = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (kind = 'b'), 0)::DOUBLE AS t
  FROM range(10000) r(b) LEFT JOIN counted ON bucket = b GROUP BY 1),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000)) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain
  FROM sizes),
weights AS (
  SELECT row, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
  FROM counted JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY 1),
scored AS (
  SELECT doc_id, row, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS eligible,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
           + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM texts JOIN words USING (kind, row) LEFT JOIN weights USING (row) WHERE kind = 'd'),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id NULLS LAST, row) AS place,
         count(*) FILTER (eligible) OVER () * 25 // 100 AS drawn
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND place <= drawn THEN place END AS rank FROM placed"""

OP12 = rf"""WITH rows AS (
  SELECT row_number() OVER () AS row, coalesce(doc_id, 9223372036854775807) AS did, doc_id,
         string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
keyed AS (
  SELECT row, did, doc_id, line, i, {_LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
  FROM (SELECT row, did, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM rows)),
kept AS (SELECT *, length(key) < 10 OR did = min(did) OVER (PARTITION BY key) AS keep FROM keyed)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (NOT keep) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keep), '')) AS kept_sha256
FROM kept GROUP BY row"""

OP13 = rf"""WITH RECURSIVE {CRC},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all({_LOWER.format("text")}, '[a-zA-Z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents WHERE text IS NOT NULL),
hashed AS (
  SELECT run, n, {crc32("d || ':' || run")} AS h FROM (SELECT d, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL), crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
    FROM hashed)
  WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
cut AS (
  SELECT word, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word),
best AS (
  SELECT near.word, count(*) AS n_near, first(other ORDER BY o.n DESC, other) AS other, max(o.n) AS other_n
  FROM near JOIN words o ON o.word = other GROUP BY 1),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form,
         CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
paths AS (
  SELECT word, word AS reached, form AS next FROM forms
  UNION ALL SELECT paths.word, f.word, f.form FROM paths JOIN forms f ON f.word = paths.next)
SELECT word, form, reached AS root, n, n_near, form_n FROM forms JOIN paths USING (word) WHERE paths.next IS NULL"""


OP5 = r"""WITH rows AS (
  SELECT row_number() OVER () AS row, coalesce(doc_id, 9223372036854775807) AS did, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT row, did, i, md5(array_to_string(w[i:i + 12], ' ')) AS name
  FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM rows WHERE len(w) > 12)),
later AS (SELECT row, i FROM windows QUALIFY min(did) OVER (PARTITION BY name) < did),
gone AS (SELECT DISTINCT row, unnest(range(i, i + 13)) AS i FROM later),
words AS (SELECT row, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM rows),
kept AS (
  SELECT words.row, count(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY words.i) FILTER (gone.i IS NULL) AS text
  FROM words LEFT JOIN gone ON words.row = gone.row AND words.i = gone.i GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM rows LEFT JOIN kept USING (row)"""

OP10 = r"""WITH rows AS (
  SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
strings AS (
  SELECT row, i, md5(substr(x, 2 * i + 1, 800)) AS name
  FROM (SELECT *, unnest(range(len(x) // 2 - 399)) AS i FROM rows WHERE len(x) >= 800)),
twice AS (SELECT row, i FROM strings QUALIFY count(*) OVER (PARTITION BY name) > 1),
joined AS (
  SELECT row, i, coalesce(i > lag(i) OVER w + 400, true) AS begins FROM twice WINDOW w AS (PARTITION BY row ORDER BY i)),
spans AS (
  SELECT row, min(i) AS a, max(i) + 400 AS b
  FROM (SELECT *, sum(begins::INT) OVER (PARTITION BY row ORDER BY i) AS run FROM joined) GROUP BY row, run),
gaps AS (
  SELECT row, coalesce(lag(b) OVER w, 0) AS a, spans.a AS b FROM spans WINDOW w AS (PARTITION BY row ORDER BY spans.a)
  UNION ALL SELECT row, max(b), len(any_value(x)) // 2 FROM spans JOIN rows USING (row) GROUP BY row),
kept AS (
  SELECT row, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS rest FROM gaps JOIN rows USING (row) GROUP BY row),
removed AS (SELECT row, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY row)
SELECT doc_id, len(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(rest, x))) AS kept_sha256
FROM rows LEFT JOIN removed USING (row) LEFT JOIN kept USING (row)"""

#: The recursion finds all vectors that links lead to.
OP9 = """WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS row, * FROM embeddings),
usable AS (
  SELECT row, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM vectors
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.row AS a, b.row AS b, b.vec_id AS other FROM usable a JOIN usable b
  ON a.label = b.label AND a.row <> b.row AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.98),
reached AS (SELECT row, row AS other FROM vectors UNION SELECT reached.row, b FROM reached JOIN links ON reached.other = a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vectors.row) AS n_links, component_id,
       coalesce(vec_id = component_id, true) AS kept
FROM vectors JOIN (
  SELECT reached.row, min(o.vec_id) AS component_id FROM reached JOIN vectors o ON o.row = reached.other GROUP BY 1) USING (row)"""


def oracles() -> dict[str, str]:
    return {"op5_phrase_automata": OP5, "op9_itq_codes": OP9, "op10_previous_factors": OP10, "op11_gram_resampling": OP11, "op12_line_bitmaps": OP12, "op13_trie_frontier": OP13}
