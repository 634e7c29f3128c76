"""SQL (DuckDB dialect) for corpus queries that SQL can express; the thresholds and words are written out."""

# Frequent function words of English, German, French and Spanish.
STOP = (
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which "
    "one you were all her she there would their we him been has when who will no more if out so what up into than "
    "der die das und zu den von mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie "
    "nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch "
    "le la les de des et du un une en à que qui dans pour pas au sur ne se ce il sont plus par avec est son sa ou mais "
    "nous vous elle je tout y aux cette ont même "
    "el los las y del que en una con no por su para lo como más pero sus le ya o este sí porque esta entre cuando muy "
    "sin sobre también me hasta hay donde quien desde todo nos durante se al"
)

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
stops AS (SELECT list(DISTINCT f) AS s FROM (
  SELECT unnest([w, upper(w[1]) || w[2:], upper(w)]) AS f FROM (SELECT unnest(string_split('{STOP}', ' ')) AS w))),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
grams AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS g FROM w, unnest(range(1, len(words) - 3)) r(i)),
many AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
cover AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM many, range(5) q(k) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (length(t) - length(regexp_replace(t, '[!?]', '', 'g'))) AS n_marks,
        (length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g'))) AS n_capitals,
        len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(cover.n, 0)::BIGINT AS n_repeat_words,
        len(list_filter(words, lambda x: list_contains(s, x)))::BIGINT AS n_stop_words
      FROM w LEFT JOIN cover USING (doc_id), stops)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  n_words >= 10 AND 100 * n_repeat_words <= 20 * n_words AND n_repeat_words / n_words <= 0.2
    AND word_chars / n_words BETWEEN 1.5 AND 25 AND n_symbols / n_words <= 0.3 AND n_marks / n_words <= 0.5
    AND n_capitals / word_chars <= 0.6 AND (n_words < 50 OR n_stop_words / n_words >= 0.02)
    AND n_dup_lines / n_lines <= 0.5 AS kept,
  n_lines, n_stop_words FROM m
"""

BLANKS = r"""' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"""

LINES = f"""
WITH each AS (SELECT doc_id, i, line, translate(trim(line, {BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
many AS (SELECT k, max(doc_id) AS keeper FROM each WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT doc_id, i, line, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM each LEFT JOIN many USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

VARIANTS = """
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-zÀ-ÿ]+')) AS run FROM documents),
each AS (SELECT doc_id, run, count(*) AS k FROM runs GROUP BY ALL),
hashed AS (SELECT run, k, xor(list_reduce(flatten(list_transform(string_split(doc_id || ':' || run, ''),
    lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [195, unicode(ch)::BIGINT - 64] END)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h FROM each, crc),
spelt AS (SELECT k, CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cuts AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM words, unnest(range(1, length(word) + 1)) r(i)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM pairs GROUP BY word),
known AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form,
    CASE WHEN other_n >= 2 * n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word)),
led AS (
  SELECT word, word AS spot FROM known
  UNION ALL SELECT led.word, known.form FROM led JOIN known ON led.spot = known.word WHERE known.form IS NOT NULL)
SELECT word, form, led.spot AS root, n, n_near, form_n
FROM known JOIN led USING (word) JOIN (SELECT word AS spot FROM known WHERE form IS NULL) ends USING (spot)
"""


def _shingles(source: str, key: str) -> str:
    """Five-word shingles of each row, in order; a shorter text is one shingle."""
    words = rf"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
    return f"""SELECT {key}, CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM (SELECT {key}, {words} AS w FROM {source})"""


LEAKS = f"""
WITH texts AS ({_shingles("documents", "doc_id")}),
items AS (SELECT min(item_id) AS item, g FROM ({_shingles("benchmark", "item_id")}) WHERE len(g) > 0 AND item_id IS NOT NULL GROUP BY g),
own AS (SELECT item, g, count(*) AS n FROM (SELECT item, unnest(g) AS g FROM items) GROUP BY item, g),
weights AS (SELECT g, 1 + ln((SELECT count(*) FROM items)::DOUBLE / count(*)) AS w FROM own GROUP BY g),
weighted AS (SELECT item, g, n, w FROM own JOIN weights USING (g)),
whole AS (SELECT item, len(any_value(items.g)) AS size, sum(n * w) AS total FROM weighted JOIN items USING (item) GROUP BY item),
places AS (SELECT doc_id, len(g) AS length, unnest(g) AS g, generate_subscripts(g, 1) - 1 AS p FROM texts),
hits AS MATERIALIZED (SELECT doc_id, item, p, length, g, n, w FROM places JOIN weighted USING (g)),
starts AS (SELECT DISTINCT doc_id, item, least(p, greatest(0, length - size)) AS s, size, total FROM hits JOIN whole USING (item)),
counted AS (SELECT doc_id, item, s, total, least(any_value(n), count(*)) * any_value(w) AS part
  FROM starts JOIN hits USING (doc_id, item) WHERE p >= s AND p < s + size GROUP BY doc_id, item, s, total, g),
rated AS (SELECT doc_id, item, s, sum(part) / any_value(total) AS similarity FROM counted GROUP BY doc_id, item, s),
leaks AS (SELECT doc_id, item, max(similarity) AS similarity FROM rated GROUP BY doc_id, item HAVING max(similarity) >= 0.8 - 1e-9),
found AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids, max(similarity) AS similarity FROM leaks GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::INT AS n_items, coalesce(ids, '') AS item_ids, round(similarity, 6) AS similarity, n IS NOT NULL AS contaminated
FROM documents LEFT JOIN found USING (doc_id)
"""

ORACLES = {"op1_quality_rules": QUALITY, "op8_decontamination": LEAKS, "op12_line_dedup": LINES, "op13_spelling_variants": VARIANTS}
