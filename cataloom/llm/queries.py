"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from .ann import op4_learned_partitions
from .byte_bpe import op6_byte_bpe
from .collocations import op12_phrase_collocations
from .packing import op2_best_fit_packing
from .pseudo_likelihood import op8_pseudo_likelihood
from .quality import op3_quality_cotraining
from .recompression import op7_substring_recompression
from .secrets import op5_secret_scans
from .simhash import op1_simhash_vptree
from .topk import op10_exact_topk
from .toxicity import op9_toxicity_ftrl
from .trie import op11_conversation_trie
from .warc import op13_warc_zstd

QUERIES = {
    "op1_simhash_vptree": op1_simhash_vptree,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_quality_cotraining": op3_quality_cotraining,
    "op4_learned_partitions": op4_learned_partitions,
    "op5_secret_scans": op5_secret_scans,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_substring_recompression": op7_substring_recompression,
    "op8_pseudo_likelihood": op8_pseudo_likelihood,
    "op9_toxicity_ftrl": op9_toxicity_ftrl,
    "op10_exact_topk": op10_exact_topk,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_warc_zstd": op13_warc_zstd,
}

ORACLE_SQL: dict[str, str] = {
    "op7_substring_recompression": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
starts AS (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
windows AS (SELECT rid, i, array_to_string(w[i:i + 34], ' ') AS s FROM starts),
twice AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
covered AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM windows JOIN twice USING (s)),
placed AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM placed ANTI JOIN covered USING (rid, p) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)""",
    "op10_exact_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings),
q AS (SELECT DISTINCT vec_id, v FROM v WHERE vec_id % 50 = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM q JOIN v c ON q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_conversation_trie": """
WITH bits AS (SELECT conv_id, list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))) AS b
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
take AS (SELECT conv_id, xor(list_reduce(list_transform(b, lambda x: CAST(x AS BIGINT)), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 9 AS h FROM bits),
own AS (SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, '')) AS t FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
made AS (SELECT o.conv_id, list_concat(coalesce(p.t, [])[1:h], o.t[h + 1:]) AS t FROM own o JOIN take USING (conv_id) LEFT JOIN own p ON p.conv_id = o.conv_id - o.conv_id % 5),
held AS (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS depth FROM made),
nodes AS (SELECT t[1:depth] AS k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = len(t)), '')) AS ends_sha256 FROM held GROUP BY ALL),
linked AS (SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.k = n.k[1:n.depth - 1]),
kids AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL),
own_sums AS (SELECT l.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(k[depth].text) END AS saved FROM linked l LEFT JOIN kids USING (conv_id, depth)),
up AS (SELECT k[1:e] AS k, e AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM (SELECT *, unnest(range(0, depth + 1)) AS e FROM own_sums) GROUP BY ALL)
SELECT conv_id, o.depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256 FROM own_sums o JOIN up USING (k, depth)""",
    "op12_phrase_collocations": r"""
WITH t AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
grams AS (SELECT lang, w, i, unnest([1, 2, 3]) AS k FROM places),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM grams WHERE i + k - 1 <= len(w) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS v FROM f WHERE k > 1 AND f >= 10),
parts AS (SELECT c.*, unnest(range(1, size)) AS k FROM c),
split AS (SELECT *, array_to_string(v[1:k], ' ') AS lp, array_to_string(v[k + 1:], ' ') AS rp FROM parts),
cuts AS (SELECT s.*, l.f AS l, r.f AS r, CAST(1000000 AS HUGEINT) * a * a // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM split s JOIN f l ON l.lang = s.lang AND l.phrase = s.lp JOIN f r ON r.lang = s.lang AND r.phrase = s.rp),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner2 AS (SELECT lang, a, v, unnest([1, 2]) AS j FROM c WHERE size = 3),
three AS (SELECT lang, array_to_string(v[j:j + 1], ' ') AS phrase, max(a) AS longer FROM inner2 GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN three USING (lang, phrase) WHERE size = 3 OR longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000""",
    "op13_warc_zstd": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (SELECT *, list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  (((strpos('0123456789abcdef', hex[5 * j // 4 + 1]) - 1) * 16 + strpos('0123456789abcdef', hex[5 * j // 4 + 2]) - 1) >> CAST(3 - 5 * j % 4 AS INTEGER)) % 32 + 1, 1)) AS letters, max(page_id) OVER (PARTITION BY html) AS newest FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, array_to_string(letters, '') AS payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> newest THEN newest END AS refers_to FROM b""",
}
