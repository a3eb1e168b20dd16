"""The results of the training-data queries in SQL for another engine, where SQL can express them."""

_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 10
"""

_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS r
  FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id
  WHERE NOT alike AND 100 * s.score BETWEEN 80 * positive_score AND 100 * positive_score
)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE r <= 5
"""

_CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *,
    length(role) + length(regexp_replace(role, '[^\\<\[\]]', '', 'g')) AS role_chars,
    length(text) + length(regexp_replace(text, '[^\\<\[\]]', '', 'g')) AS text_chars
  FROM t
), w AS (
  SELECT *,
    sum(4 + role_chars + 2 + text_chars + 4) OVER o AS so_far,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) = 1 AS is_last
  FROM e
  WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(so_far) FILTER (role = 'assistant' OR is_last) AS BIGINT) AS formatted_chars
FROM w GROUP BY conv_id
"""


_QUALITY = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), c AS (
  SELECT doc_id, lang, length(text) AS chars, len(words) AS n_words,
    [length(regexp_replace(text, '[^a-z]', '', 'g')), length(regexp_replace(text, '[^A-Z]', '', 'g')),
     length(regexp_replace(text, '[^0-9]', '', 'g')), length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g')),
     length(regexp_replace(text, '[^.,;:!?''"()-]', '', 'g')), length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))] AS kinds,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines
  FROM t
), classes AS (
  SELECT doc_id, lang, chars, n_words, i, CASE WHEN i <= 6 THEN kinds[i] ELSE chars - list_sum(kinds) END AS n
  FROM c, range(1, 8) r(i)
), class_ref AS (
  SELECT lang, i, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS q FROM classes GROUP BY lang, i
), char_terms AS (
  SELECT d.doc_id, CAST(d.n AS DOUBLE) / nullif(d.chars, 0) AS p, r.q
  FROM classes d JOIN class_ref r ON d.lang = r.lang AND d.i = r.i WHERE d.chars >= 200
), said AS (SELECT doc_id, lang, unnest(words) AS word FROM t
), ranked AS (
  SELECT lang, word, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS place
  FROM said GROUP BY lang, word
), top AS (SELECT lang, word, n FROM ranked WHERE place <= 32
), totals AS (SELECT lang, count(*) AS n FROM said GROUP BY lang
), word_ref AS (
  SELECT t.lang, t.word, CAST(t.n AS DOUBLE) / a.n AS q FROM top t JOIN totals a ON t.lang = a.lang
  UNION ALL
  SELECT a.lang, NULL, CAST(a.n - coalesce((SELECT sum(n) FROM top WHERE top.lang = a.lang), 0) AS DOUBLE) / a.n
  FROM totals a
), seen AS (
  SELECT s.doc_id, t.word, count(*) AS n
  FROM said s LEFT JOIN top t ON s.lang = t.lang AND s.word = t.word GROUP BY s.doc_id, t.word
), word_terms AS (
  SELECT c.doc_id, CAST(coalesce(s.n, 0) AS DOUBLE) / c.n_words AS p, r.q
  FROM c JOIN word_ref r ON c.lang = r.lang
    LEFT JOIN seen s ON s.doc_id = c.doc_id AND s.word IS NOT DISTINCT FROM r.word
  WHERE c.n_words >= 50
), terms AS (
  SELECT doc_id, 'char' AS kind, p, q FROM char_terms UNION ALL SELECT doc_id, 'word', p, q FROM word_terms
), distances AS (
  SELECT doc_id, kind, round(sqrt(greatest(0, sum(
    CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)), 4) AS d
  FROM terms GROUP BY doc_id, kind
), windows AS (
  SELECT doc_id, pos, [words[pos], words[pos + 1], words[pos + 2]] AS w
  FROM t, unnest(range(1, greatest(len(words) - 1, 1))) u(pos) WHERE len(words) >= 3
), twice AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT pos + i) AS n FROM twice, range(0, 3) r(i) GROUP BY doc_id
), base AS (
  SELECT c.doc_id, c.n_words, c.word_chars, c.kinds[6] AS n_symbols, c.n_dup_lines,
    coalesce(v.n, 0) AS n_repeat_words,
    c.n_words < 50 OR 100 * coalesce(v.n, 0) > 50 * c.n_words AS base_failed,
    x.d AS char_distance, y.d AS word_distance
  FROM c LEFT JOIN covered v ON c.doc_id = v.doc_id
    LEFT JOIN distances x ON x.doc_id = c.doc_id AND x.kind = 'char'
    LEFT JOIN distances y ON y.doc_id = c.doc_id AND y.kind = 'word'
)
SELECT *, NOT base_failed AND coalesce(char_distance, 0) <= 0.30 AND coalesce(word_distance, 0) <=
  least(0.43::DOUBLE, sqrt(0.04::DOUBLE + 8.0::DOUBLE / greatest(n_words, 1))) AS kept FROM base
"""

_JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, words[pos : pos + 3] AS shingle
  FROM w, unnest(range(1, greatest(len(words) - 2, 2))) u(pos) WHERE len(words) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
"""


def _orders():
    """Smoothed probabilities of grams, from contexts of no symbol to three, for accepted and rejected URLs."""
    steps = []
    for order in range(4):
        size = 32 ** (order + 1)
        sums = ", ".join(f"sum({side}) OVER e AS {side}_n, sum({side}) OVER x AS {side}_all" for side in ("good", "bad"))
        ps = ", ".join(
            f"CASE WHEN {side}_all >= 4 THEN ({side}_n + 8.0::DOUBLE * {side}_p) / ({side}_all + 8.0::DOUBLE)"
            f" ELSE {side}_p END AS {side}_p"
            for side in ("good", "bad")
        )
        steps.append(f"""m{order} AS (
  SELECT gram, good, bad, {ps} FROM (
    SELECT gram, good, bad, good_p, bad_p, {sums} FROM {f'm{order - 1}' if order else 'm'}
    WINDOW e AS (PARTITION BY gram % {size}), x AS (PARTITION BY (gram % {size}) // 32)))""")
    return ",\n".join(steps)


_URLS = rf"""
WITH h AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    row_number() OVER () AS no
  FROM pages
), u AS (
  SELECT *, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS decided
  FROM (SELECT *, CASE
      WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM h)
), said AS (
  SELECT *, substr(md5(url), 1, 1) IN ('0', '1', '2') AS held_out,
    CASE WHEN contains(url, '://') THEN
      regexp_replace(host, '(^|\.)(com|example|net|org)(\.(com|example|net|org))*$', '')
      || regexp_replace(path, '^(/de/|/en/|/fr/)', '/') || regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*(.*)$', 1)
    ELSE url END AS said
  FROM u
), plain AS (
  SELECT no, CASE WHEN NOT held_out THEN decided END AS decided, regexp_replace(translate(said, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789',
    'abcdefghijklmnopqrstuvwxyz000000000'), '[^a-z0./-]', '~', 'g') AS chars
  FROM said
), symbols AS (
  SELECT no, decided, pos, strpos('abcdefghijklmnopqrstuvwxyz0./-~', chars[pos]) AS x
  FROM plain, unnest(range(1, length(chars) + 1)) r(pos)
), grams AS (
  SELECT no, decided, x + 32 * coalesce(lag(x, 1) OVER o, 0) + 1024 * coalesce(lag(x, 2) OVER o, 0)
    + 32768 * coalesce(lag(x, 3) OVER o, 0) AS gram
  FROM symbols WINDOW o AS (PARTITION BY no ORDER BY pos)
), m AS (
  SELECT gram, count(*) FILTER (decided = 'allow') AS good, count(*) FILTER (decided = 'block') AS bad,
    1.0::DOUBLE / 32 AS good_p, 1.0::DOUBLE / 32 AS bad_p
  FROM grams GROUP BY gram
), {_orders()},
ratios AS (SELECT gram, CAST(round(1000000 * (ln(good_p) - ln(bad_p))) AS BIGINT) AS ratio FROM m3
), scores AS (
  SELECT u.*, coalesce(s.difference, 0) AS difference
  FROM said u LEFT JOIN (
    SELECT no, CAST((sum(ratio) - ((sum(ratio) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS difference
    FROM grams JOIN ratios USING (gram) GROUP BY no) s ON s.no = u.no
), bins AS (
  SELECT greatest(-2000, least(2000, CAST(floor(difference / 10000.0::DOUBLE) AS BIGINT))) AS bin,
    count(*) FILTER (decided = 'allow') AS good, count(*) FILTER (decided = 'block') AS bad
  FROM scores WHERE decided IS NOT NULL AND held_out GROUP BY 1
), errors AS (
  SELECT bin, coalesce(sum(good) OVER o, 0)::DOUBLE / sum(good) OVER ()::DOUBLE
    + (sum(bad) OVER () - coalesce(sum(bad) OVER o, 0))::DOUBLE / sum(bad) OVER ()::DOUBLE AS error
  FROM bins WINDOW o AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), bound AS (
  SELECT arg_min(bin, (error, bin)) * 10000 AS bound FROM errors WHERE isfinite(error)
)
SELECT page_id, host, path, rule, difference,
  coalesce(decided, CASE WHEN difference >= coalesce((SELECT bound FROM bound), -4611686018427387904) THEN 'allow'
    ELSE 'block' END) AS verdict
FROM scores
"""


def oracle_sql():
    return {
        "op1_quality_rules": _QUALITY,
        "op2_topk_search": _TOPK,
        "op7_url_filter": _URLS,
        "op8_ngram_jaccard_join": _JACCARD,
        "op10_chat_formatting": _CHAT,
        "op13_hard_negatives": _NEGATIVES,
    }
