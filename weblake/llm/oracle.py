"""DuckDB SQL for the queries of this folder that SQL can express."""

_WS = r"[\x20\x09-\x0D]+"

OP2 = rf"""
WITH d AS (SELECT doc_id, source, text AS raw, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{_WS}'), lambda x: x <> '') AS words,
             string_split(text, chr(10)) AS lines FROM d),
norm AS (SELECT doc_id, source, raw, unnest(lines) AS line FROM w),
keyed AS (SELECT doc_id, source, raw, line, trim(regexp_replace(lower(line), '{_WS}', ' ', 'g')) AS k FROM norm),
hosts AS (SELECT source, count(DISTINCT raw) AS docs FROM d GROUP BY source),
freq AS (SELECT k.source, k.k FROM keyed k JOIN hosts h ON k.source IS NOT DISTINCT FROM h.source WHERE k.k <> ''
         GROUP BY k.source, k.k, h.docs HAVING count(DISTINCT k.raw) > greatest(10, floor(h.docs * 0.05))),
gone AS (SELECT k.doc_id, count(*) AS n_lines, sum(len(list_filter(regexp_split_to_array(k.line, '{_WS}'), lambda x: x <> ''))) AS n_words
         FROM keyed k JOIN freq f ON k.source IS NOT DISTINCT FROM f.source AND k.k = f.k GROUP BY k.doc_id),
grams AS (SELECT doc_id, i, words[i:i+4] AS g FROM w, range(1, greatest(len(words) - 3, 1)) t(i) WHERE len(words) >= 5),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM rep, range(0, 5) t(j) GROUP BY doc_id),
c AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
             CAST(list_sum(list_transform(words, lambda x: length(x))) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
                  - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(gone.n_lines, 0) AS BIGINT) AS n_frequent_lines,
             CAST(coalesce(gone.n_words, 0) AS BIGINT) AS n_gone
      FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id LEFT JOIN gone ON w.doc_id = gone.doc_id)
SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
           AND NOT (n_gone > 0 AND (n_words - n_gone < 10 OR n_words - n_gone < 0.2 * n_words)) AS kept,
       n_frequent_lines, n_words - n_gone AS n_left
FROM c"""

OP10 = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS after,
             replace(replace(replace(replace(replace(replace(replace(replace(text, '\', '\0'), '<|im_start|>', '<\1|im_start|>'),
               '<|im_end|>', '<\1|im_end|>'), '<|endoftext|>', '<\1|endoftext|>'), '<s>', '<\1s>'), '</s>', '<\1/s>'),
               '[INST]', '[\1INST]'), '[/INST]', '[\1/INST]') AS escaped FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn), '')) AS loss_sha256,
       CAST(sum(length(escaped) + length(role) + 12 + 1 + 11) AS BIGINT) AS formatted_chars,
       bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user'
                     WHEN before = 'user' THEN role = 'assistant' ELSE false END AND (after IS NOT NULL OR role = 'assistant')) AS valid
FROM e GROUP BY conv_id"""

_CRC_TABLE = "list_transform(range(256), lambda b: list_reduce(list_prepend(CAST(b AS BIGINT), range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"

OP11 = rf"""
WITH crc_table AS (SELECT {_CRC_TABLE} AS x),
own AS (SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS own
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
taken AS (SELECT c, own, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))),
                 lambda r, b: xor(r // 256, crc_table.x[CAST(xor(r % 256, b) AS INTEGER) + 1])), 4294967295) % 4 AS h
          FROM own, crc_table),
built AS (SELECT t.c, list_concat(coalesce(b.own[1:t.h], []), t.own[t.h + 1:]) AS path FROM taken t LEFT JOIN own b ON b.c = t.c - t.c % 20),
prefixes AS (SELECT c, path, unnest(range(0, len(path) + 1)) AS depth FROM built),
node AS (SELECT path[1:depth] AS prefix, depth, min(c) AS conv_id, count(*) AS n_convs,
                sha256(coalesce(string_agg(CASE WHEN len(path) = depth THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends_sha256
         FROM prefixes GROUP BY path[1:depth], depth),
kids AS (SELECT prefix[1:depth - 1] AS above, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
own_values AS (SELECT node.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE
                 (n_convs - 1) * len(regexp_extract_all(prefix[depth].text, '[^\x20\x09-\x0D]+')) END AS saved FROM node LEFT JOIN kids ON prefix = above),
lifted AS (SELECT prefix, n_children, saved, unnest(range(0, depth + 1)) AS up FROM own_values),
subtree AS (SELECT prefix[1:up] AS top, count_if(n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM lifted GROUP BY ALL)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, saved_tokens, o.ends_sha256
FROM own_values o JOIN subtree ON o.prefix = top LEFT JOIN node p ON o.depth > 0 AND p.prefix = o.prefix[1:o.depth - 1]"""

OP12 = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS len FROM v
      WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) / (a.len * b.len) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT v.vec_id, coalesce(n_links, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN least ON v.vec_id = least.a LEFT JOIN n ON v.vec_id = n.a"""

ORACLE_SQL = {"op11_prefix_trie": OP11, "op12_pstable_hashing": OP12, "op2_quality_lines": OP2, "op10_chat_format": OP10}
