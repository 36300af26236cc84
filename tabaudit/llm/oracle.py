"""SQL for the queries that SQL can express, over the tables as views."""

# Steps shared by the query and the pipeline: ``{docs}`` is the table that is judged.
QUALITY_STEPS = r"""
q_docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM {docs}),
q_tok AS (
  SELECT rid, doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos
  FROM (SELECT rid, doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM q_docs)
),
q_seq AS (
  SELECT rid, doc_id, pos, w, ('0x' || md5(w)[1:8])::BIGINT AS h,
    lead(w) OVER s AS w2, lead(w, 2) OVER s AS w3
  FROM q_tok WINDOW s AS (PARTITION BY rid ORDER BY pos)
),
q_gram AS (
  SELECT rid, doc_id, h % 2147483647 % 65536 AS bucket FROM q_seq
  UNION ALL
  SELECT rid, doc_id, (h * 1000003 + ('0x' || md5(w2)[1:8])::BIGINT) % 2147483647 % 65536
  FROM q_seq WHERE w2 IS NOT NULL
),
q_trusted AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
q_count AS (
  SELECT bucket, count(*) AS c, count(*) FILTER (
    WHERE doc_id IN (SELECT doc_id FROM q_trusted WHERE md5(doc_id::VARCHAR) >= '4')) AS t
  FROM q_gram GROUP BY bucket
),
q_weight AS (
  SELECT bucket, CASE WHEN sum(t) OVER () = 0 THEN 0 ELSE round(ln(
    ((t + 1.0::DOUBLE) / (sum(t) OVER () + 65536.0::DOUBLE))
    / ((c + 1.0::DOUBLE) / (sum(c) OVER () + 65536.0::DOUBLE))) * 1048576)::BIGINT END AS weight
  FROM q_count
),
q_sum AS (
  SELECT rid, sum(weight)::DOUBLE / count(*) / 1048576 AS score
  FROM q_gram JOIN q_weight USING (bucket) GROUP BY rid
),
q_words AS (
  SELECT rid, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars FROM q_tok GROUP BY rid
),
q_window AS (
  SELECT rid, pos FROM q_seq WHERE w3 IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY rid, w, w2, w3) > 1
),
q_repeat AS (
  SELECT rid, count(DISTINCT pos + k)::BIGINT AS n_repeat_words
  FROM q_window, (VALUES (0), (1), (2)) AS shift(k) GROUP BY rid
),
q_line AS (
  SELECT rid, line, count(*) - 1 AS again
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM q_docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid, line
),
q_dup AS (SELECT rid, sum(again)::BIGINT AS n_dup_lines FROM q_line GROUP BY rid),
q_base AS (
  SELECT d.rid, d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, score
  FROM q_docs d LEFT JOIN q_words USING (rid) LEFT JOIN q_dup USING (rid)
    LEFT JOIN q_repeat USING (rid) LEFT JOIN q_sum USING (rid)
),
q_score AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM q_base
),
q_bin AS (
  SELECT floor(score / 0.001)::BIGINT AS bin, count(*) AS n FROM q_score
  WHERE NOT base_failed
    AND doc_id IN (SELECT doc_id FROM q_trusted WHERE md5(doc_id::VARCHAR) < '4')
  GROUP BY bin
),
q_rank AS (SELECT bin, sum(n) OVER (ORDER BY bin) AS upto, sum(n) OVER () AS total FROM q_bin),
q_verdict AS (
  SELECT *, NOT base_failed AND coalesce(score, 0) >= coalesce(
    (SELECT min(bin) * 0.001::DOUBLE - 0.05::DOUBLE FROM q_rank WHERE upto >= 0.005 * total),
    '-infinity'::DOUBLE) AS kept
  FROM q_score
)
"""

QUALITY_RULES = (
    "WITH "
    + QUALITY_STEPS.format(docs="documents")
    + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
  round(score, 9) AS score
FROM q_verdict
"""
)

URL_FILTERS = r"""
WITH rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
page AS (
  SELECT row_number() OVER () AS rid, page_id,
    CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest
  FROM pages
),
split AS (
  SELECT rid, page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM page
),
best AS (
  SELECT s.rid, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
    arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM split s JOIN rules r
    ON ends_with('.' || s.host, '.' || r.host) AND starts_with(s.path, r.path)
  GROUP BY s.rid
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM split LEFT JOIN best USING (rid)
"""

# ``{docs}`` has the columns of documents.
LINE_STEPS = r"""
l_docs AS (SELECT row_number() OVER () AS rid, * FROM {docs}),
l_line AS (
  SELECT rid, coalesce(source, '') AS site, unnest(lines) AS line,
    generate_subscripts(lines, 1) AS pos
  FROM (SELECT rid, source, string_split(text, chr(10)) AS lines FROM l_docs)
),
l_key AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k FROM l_line
),
l_spread AS (SELECT k FROM l_key WHERE k <> '' GROUP BY k HAVING count(DISTINCT site) >= 10),
l_kept AS (
  SELECT rid, count(*) FILTER (hit) AS n,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT hit), '') AS kept
  FROM (SELECT *, k IN (SELECT k FROM l_spread) AS hit FROM l_key) GROUP BY rid
),
l_done AS (
  SELECT d.*, n, kept, n > 0 AND length(kept) >= length(text) * 0.5 AS takes_effect
  FROM l_docs d LEFT JOIN l_kept USING (rid)
)
"""

LINE_SPREAD = (
    "WITH "
    + LINE_STEPS.format(docs="documents")
    + """
SELECT doc_id, CASE WHEN takes_effect THEN kept ELSE text END AS text,
  CASE WHEN takes_effect THEN n ELSE 0 END AS n_removed
FROM l_done
"""
)

# Lists of one row, raked by a recursive query; one step per dimension and sweep.
MIX_STEPS = r"""
m_docs AS (
  SELECT row_number() OVER () AS rid, *,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS m_tokens,
    CASE WHEN source IN ('src0', 'src1', 'src2', 'src3', 'src4', 'src5', 'src6', 'src7', 'src8',
      'src9', 'src10', 'src11', 'src12', 'src13', 'src14', 'src15', 'src16', 'src17', 'src18',
      'src19') THEN source ELSE '*' END AS m_source,
    CASE WHEN lang IN ('en', 'fr', 'de', 'es') THEN lang ELSE '*' END AS m_lang,
    CASE WHEN regexp_matches(coalesce(text, ''), '[Ll]icen[sc]e|Copyright') THEN 'licence'
      WHEN regexp_matches(coalesce(text, ''), ' \| ') THEN 'table'
      WHEN regexp_matches(coalesce(text, ''), '[0-9]') THEN 'figures' ELSE 'prose' END AS m_topic
  FROM {docs}
),
m_cell AS (
  SELECT m_source AS s, m_lang AS l, m_topic AS t, sum(m_tokens)::DOUBLE AS tokens
  FROM m_docs GROUP BY ALL
),
m_target(d, k, share) AS (
  SELECT 0, 'src' || i, 0.05::DOUBLE FROM range(20) r(i) UNION ALL SELECT 0, '*', 0.05
  UNION ALL VALUES (1, 'en', 0.45), (1, 'fr', 0.2), (1, 'de', 0.2), (1, 'es', 0.13), (1, '*', 0.02),
    (2, 'prose', 0.8), (2, 'figures', 0.1), (2, 'licence', 0.07), (2, 'table', 0.03)
),
m_present AS (
  SELECT c.*, ts.share AS ps, tl.share AS pl, tt.share AS pt
  FROM (SELECT *, sum(tokens) OVER () AS total FROM m_cell) c
    JOIN m_target ts ON ts.d = 0 AND ts.k = s JOIN m_target tl ON tl.d = 1 AND tl.k = l
    JOIN m_target tt ON tt.d = 2 AND tt.k = t
),
m_goal AS (
  SELECT *,
    ps / (SELECT sum(share) FROM m_target WHERE d = 0
      AND k IN (SELECT s FROM m_cell WHERE tokens > 0)) AS gs,
    pl / (SELECT sum(share) FROM m_target WHERE d = 1
      AND k IN (SELECT l FROM m_cell WHERE tokens > 0)) AS gl,
    pt / (SELECT sum(share) FROM m_target WHERE d = 2
      AND k IN (SELECT t FROM m_cell WHERE tokens > 0)) AS gt
  FROM m_present WHERE tokens > 0
),
m_rake AS (
  SELECT 0 AS step, s, l, t, gs, gl, gt, tokens, total, tokens / total AS w FROM m_goal
  UNION ALL
  SELECT step + 1, s, l, t, gs, gl, gt, tokens, total, w * CASE step % 3
    WHEN 0 THEN gs / sum(w) OVER (PARTITION BY s) WHEN 1 THEN gl / sum(w) OVER (PARTITION BY l)
    ELSE gt / sum(w) OVER (PARTITION BY t) END
  FROM m_rake WHERE step < 150
),
m_ratio AS (SELECT s, l, t, tokens, total, w / (tokens / total) AS r FROM m_rake WHERE step = 150),
m_cap AS (
  SELECT *, coalesce(sum(tokens) OVER above, 0) AS capped,
    sum(tokens * r) OVER () - coalesce(sum(tokens * r) OVER above, 0) AS open_
  FROM m_ratio WINDOW above AS (ORDER BY r DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
m_level AS (SELECT arg_max((0.9 * total - capped) / open_, r) FILTER (
  WHERE r * (0.9 * total - capped) / open_ < 1) AS level FROM m_cap),
m_chance AS (
  SELECT s, l, t, CASE WHEN tokens > 0 THEN least(1.0, r * level) ELSE 0.9 END AS p
  FROM m_cell LEFT JOIN m_ratio USING (s, l, t, tokens), m_level
),
m_done AS (
  SELECT d.*, p, ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT / 4294967296.0::DOUBLE < p
    AS m_kept
  FROM m_docs d JOIN m_chance ON s = m_source AND l = m_lang AND t = m_topic
)
"""

MIXING = (
    "WITH RECURSIVE "
    + MIX_STEPS.format(docs="documents")
    + """
SELECT doc_id, m_source AS source, m_lang AS lang, m_topic AS topic, m_tokens AS n_tokens,
  round(p, 9) AS probability, m_kept AS kept
FROM m_done
"""
)

# The checksum of a decimal id is computed byte by byte and bit by bit; prefixes are lists of hashed turns.
CONVERSATION_TRIE = r"""
WITH c_turns AS (
  SELECT conv_id AS c, role || chr(1) || text AS content, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
  WHERE conv_id IS NOT NULL
),
c_lists AS (
  SELECT c, list({'h': md5(content), 'w': len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))} ORDER BY pos) AS s
  FROM c_turns GROUP BY c
),
c_forks AS (
  SELECT c, s, c - c % 20 AS base, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, byte: list_reduce(
      list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda v, step: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)))) % 4 AS h
  FROM c_lists
),
c_rebuilt AS (
  SELECT f.c, list_concat(coalesce(b.s[1:f.h], []), f.s[f.h + 1:]) AS s
  FROM c_forks f LEFT JOIN c_lists b ON b.c = f.base
),
c_prefixes AS (
  SELECT c, unnest(range(0, len(s) + 1)) AS depth, s, len(s) AS n FROM c_rebuilt
),
c_nodes AS (
  SELECT depth, list_transform(s[1:depth], lambda t: t.h) AS path, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(any_value(s[depth].w), 0) AS words,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = depth), '') AS ends
  FROM c_prefixes GROUP BY ALL
),
c_children AS (
  SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children
  FROM c_nodes WHERE depth > 0 GROUP BY ALL
),
c_valued AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
    (n_children IS NULL)::BIGINT AS leaf, (n_convs - 1) * words AS saved
  FROM c_nodes n LEFT JOIN c_children c USING (depth, path)
),
c_totals AS (
  SELECT k AS depth, path[1:k] AS path, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT path, leaf, saved, unnest(range(0, depth + 1)) AS k FROM c_valued) GROUP BY ALL
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens,
  sha256(v.ends) AS ends_sha256
FROM c_valued v JOIN c_totals t USING (depth, path)
LEFT JOIN c_nodes p ON v.depth > 0 AND p.depth = v.depth - 1 AND p.path = v.path[1:v.depth - 1]
"""

PHRASES = r"""
WITH p_pieces AS (
  SELECT lang, row_number() OVER () AS piece, w
  FROM (
    SELECT lang, regexp_extract_all(unnest(string_split_regex(
      translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang, coalesce(text, '') AS t FROM documents)
  ) WHERE len(w) > 0
),
p_grams AS (
  SELECT lang, unnest(flatten(list_transform([1, 2, 3, 4], lambda k:
    list_transform(range(1, greatest(len(w) - k + 2, 1)), lambda i: {'k': k, 'g': array_to_string(w[i:i + k - 1], ' ')})
  )), recursive := true)
  FROM p_pieces
),
p_total AS (SELECT lang, count(*) AS n FROM p_grams WHERE k = 1 GROUP BY lang),
p_count AS (SELECT lang, k, g, count(*)::HUGEINT AS f FROM p_grams GROUP BY ALL HAVING count(*) >= 30),
p_candidate AS (SELECT lang, k AS m, g AS phrase, f AS a, string_split(g, ' ') AS w FROM p_count WHERE k > 1),
p_cut AS (
  SELECT lang, phrase, m, a, w, unnest(range(1, m)) AS cut FROM p_candidate
),
p_score AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, 2000000::HUGEINT * c.a // (x.f + y.f) AS score
  FROM p_cut c
  JOIN p_count x ON x.lang = c.lang AND x.g = array_to_string(c.w[1:c.cut], ' ')
  JOIN p_count y ON y.lang = c.lang AND y.g = array_to_string(c.w[c.cut + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.cut) = 1
),
p_part AS (
  SELECT lang, a, unnest(flatten(list_transform(range(2, m), lambda size:
    list_transform(range(1, m - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))))) AS phrase
  FROM p_candidate WHERE m > 2
),
p_longer AS (SELECT lang, phrase, max(a) AS longer FROM p_part GROUP BY ALL),
p_left AS (
  SELECT s.* FROM p_score s LEFT JOIN p_longer USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer < 80 * a
)
SELECT lang, row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
  phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM p_left JOIN p_total USING (lang)
QUALIFY rank <= 2000
"""
