r"""The queries as DuckDB SQL over the raw tables. Constants are written out here on purpose."""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '')) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place FROM per_source
), weighed AS (
  SELECT *, (CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::BIGINT AS w,
         3 * source_size AS cap FROM ranked
), levels AS (
  SELECT *, cap / w AS ratio,
         ((sum(source_size) OVER ())
           - coalesce(sum(cap) OVER (ORDER BY cap / w, place
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT
         / (sum(w) OVER (ORDER BY cap / w, place
                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
  FROM weighed
), chosen AS (
  SELECT ratio AS at_ratio, level AS common FROM levels WHERE level * w <= cap ORDER BY ratio, place LIMIT 1
), targets AS (
  SELECT source, source_size,
         CASE WHEN ratio < at_ratio THEN cap::DOUBLE ELSE least(common * w, cap::DOUBLE) END AS target
  FROM levels, chosen
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
         floor(t.target)::BIGINT AS budget,
         CASE WHEN t.source_size > 0 THEN floor(t.target)::BIGINT // t.source_size ELSE 0 END AS epochs
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (epochs * size + least(greatest(budget - epochs * source_size - before, 0), size))::BIGINT AS taken
FROM placed
"""

QUALITY = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, text,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words
  FROM documents
), windows AS (
  SELECT rid, n_words, i, array_to_string(words[i : i + 7], ' ') AS win
  FROM (SELECT rid, words, len(words) AS n_words, unnest(range(1, len(words) - 6)) AS i FROM docs
        WHERE len(words) >= 8)
), repeated AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT rid, sum(least(coalesce(next - i, 8), 8))::BIGINT AS n_repeat_words
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS next FROM repeated) GROUP BY rid
), lines AS (
  SELECT rid, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), base AS (
  SELECT d.rid, doc_id, lang, source, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         coalesce(len(regexp_extract_all(text, '[#*$%&|<>]')), 0)::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM docs d LEFT JOIN covered c ON d.rid = c.rid LEFT JOIN lines l ON d.rid = l.rid
), ruled AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base
), ratios AS (
  SELECT rid, lang, source, ratio, value, tail FROM (
    SELECT rid, lang, source, unnest([
      {'ratio': 'symbols', 'tail': 900,
       'value': 1000 * floor(greatest(n_symbols - 2 * sqrt(n_symbols), 0))::BIGINT // greatest(word_chars, 1)},
      {'ratio': 'dup_lines', 'tail': 990, 'value': 1000 * n_dup_lines // greatest(n_words, 1)},
      {'ratio': 'repeat_words', 'tail': 990, 'value': 1000 * n_repeat_words // greatest(n_words, 1)},
      {'ratio': 'word_length', 'tail': 900, 'value': 100 * word_chars // greatest(n_words, 1)}
    ], recursive := true) FROM ruled WHERE NOT base_failed)
), bucketed AS (
  SELECT *, (value >> greatest(length(bin(value)) - 6, 0)) << greatest(length(bin(value)) - 6, 0) AS bucket
  FROM ratios
), fine AS (
  SELECT lang, source, ratio, tail, bucket, count(*) AS n FROM bucketed GROUP BY ALL
), own_below AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, ratio ORDER BY bucket) AS below,
         sum(n) OVER (PARTITION BY lang, source, ratio) AS total FROM fine
), own AS (
  SELECT lang, source, ratio, sum(n) AS n, min(bucket) FILTER (1000 * below >= 500 * total) AS middle,
         min(bucket) FILTER (1000 * below >= (1000 - tail) * total) AS bottom,
         min(bucket) FILTER (1000 * below >= tail * total) AS top FROM own_below GROUP BY ALL
), whole_below AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, ratio ORDER BY bucket) AS below,
         sum(n) OVER (PARTITION BY lang, ratio) AS total
  FROM (SELECT lang, ratio, tail, bucket, sum(n) AS n FROM fine GROUP BY ALL)
), whole AS (
  SELECT lang, ratio, min(bucket) FILTER (1000 * below >= 500 * total) AS middle,
         min(bucket) FILTER (1000 * below >= (1000 - tail) * total) AS bottom,
         min(bucket) FILTER (1000 * below >= tail * total) AS top FROM whole_below GROUP BY ALL
), limits AS (
  SELECT o.lang, o.source, o.ratio,
         floor((o.n * (o.middle - 4 * (o.middle - o.bottom)) + 100 * (w.middle - 4 * (w.middle - w.bottom)))
               / (o.n + 100)) AS low,
         least(floor((o.n * (o.middle + 4 * (o.top - o.middle)) + 100 * (w.middle + 4 * (w.top - w.middle)))
                     / (o.n + 100)),
               3 * (w.middle + 4 * (w.top - w.middle))) AS high
  FROM own o JOIN whole w ON o.lang IS NOT DISTINCT FROM w.lang AND o.ratio = w.ratio
), verdicts AS (
  SELECT r.rid, bool_and(r.bucket BETWEEN l.low AND l.high) AS within
  FROM bucketed r JOIN limits l ON r.lang IS NOT DISTINCT FROM l.lang
                             AND r.source IS NOT DISTINCT FROM l.source AND r.ratio = l.ratio
  GROUP BY r.rid
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(within, false) AS kept
FROM ruled LEFT JOIN verdicts USING (rid)
"""

TOP_K = r"""
WITH vectors AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
  GROUP BY vec_id
), terms AS (
  SELECT vec_id, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM vectors
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM terms q JOIN terms c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0 GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, * FROM (VALUES (0, 'user', '<|im_end|><|im_start|>assistant ok'),
                            (1, 'assistant', '<|im_end|><|im_start|>assistant ok'))
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), ''
              ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
              ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       sum(12 + length(replace(replace(replace(role, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|'),
                               chr(10), '<' || chr(92) || 'n')) + 1
           + length(replace(replace(text, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|'))
           + 10 + 1)::BIGINT AS formatted_chars,
       regexp_full_match(string_agg(role || ',', '' ORDER BY turn NULLS FIRST, role, text),
                         '(system,)?user,(assistant,user,)*(assistant,)?') AS valid_order
FROM turns GROUP BY conv_id
"""

ORACLE: dict[str, str] = {
    "op1_maxscore": TOP_K,
    "op2_mixing": MIXING,
    "op3_quality_rules": QUALITY,
    "op5_chat_formatting": CHAT,
}
