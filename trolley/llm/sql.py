"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from trolley.llm.licenses import RULES, SENTENCES

OP1_DECONTAMINATE = r"""
WITH d AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
),
b AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
windows AS (
    SELECT DISTINCT item_id, w[i + 1 : i + 13] AS win
    FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)
),
widths AS (SELECT DISTINCT len(win) AS n FROM windows),
grams AS (
    SELECT doc_id, i, n, w[i + 1 : i + n] AS win
    FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM d, widths WHERE len(w) >= n)
),
hits AS (SELECT g.doc_id, g.i, g.n, x.item_id FROM grams g JOIN windows x USING (win)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
              FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

_SENTENCE_ROWS = ", ".join(f"({i}, '{text}')" for i, text in SENTENCES.items())
_RULE_ROWS = ", ".join(f"('{name}', ',{','.join(map(str, ids))},')" for name, ids in RULES)

OP4_LICENSES = rf"""
WITH sentences(id, sentence) AS (VALUES {_SENTENCE_ROWS}),
rules(license, ids) AS (VALUES {_RULE_ROWS}),
pieces AS (
    SELECT doc_id, unnest(p) AS piece, unnest(range(len(p))) AS i
    FROM (SELECT doc_id, regexp_split_to_array(text, '[.!?;:]+[ \t\r\f]+|[ \t\r\f]*\n\s*') AS p FROM documents)
),
found AS (
    SELECT doc_id, string_agg(id::VARCHAR, ',' ORDER BY i) AS ids
    FROM pieces JOIN sentences
      ON trim(regexp_replace(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[^a-z0-9]+', ' ', 'g')) = sentence
    GROUP BY doc_id
)
SELECT d.doc_id, coalesce(f.ids, '') AS sentence_ids,
       coalesce((SELECT string_agg(DISTINCT license, ',' ORDER BY license) FROM rules
                 WHERE contains(',' || f.ids || ',', rules.ids)), '') AS licenses
FROM documents d LEFT JOIN found f USING (doc_id)
"""

# Targets without iteration: with sources ordered by cap / weight, the level that the uncapped share is fixed by the
# first source that stays below its cap.
OP5_MIX = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           md5('5:' || coalesce(doc_id::VARCHAR, '')) AS k
    FROM documents
),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           1 + (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 AS weight
    FROM sized GROUP BY source
),
levels AS (
    SELECT *, (SELECT sum(source_size) FROM sources)
            - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS share,
           sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
    FROM sources WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST)
),
level AS (
    SELECT share, open FROM levels WHERE 3 * source_size / weight >= share / open
    ORDER BY 3 * source_size / weight, source NULLS LAST LIMIT 1
),
targets AS (
    SELECT source, source_size,
           CASE WHEN 3 * source_size <= weight * (share::DOUBLE / open::DOUBLE) THEN (3 * source_size)::DOUBLE
                ELSE weight * share::DOUBLE / open::DOUBLE END AS target
    FROM sources, level
),
placed AS (
    SELECT s.doc_id, s.size, t.source_size, t.target, round(t.target)::BIGINT AS budget,
           coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0
             ELSE budget // source_size * size + greatest(0, least(size, budget % source_size - earlier)) END)::BIGINT
           AS taken
FROM placed
"""

OP11_COLLOCATIONS = r"""
WITH pieces AS (
    SELECT row_number() OVER () AS piece, lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text,
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
          FROM starts, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, count(*) AS n FROM starts GROUP BY lang),
candidates AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (
    SELECT c.lang, c.phrase, c.a, c.j, l.a AS l, r.a AS r, n,
           ((1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c JOIN totals USING (lang)
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1 : j], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[j + 1 :], ' ')
),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
    SELECT DISTINCT c.lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, c.a
    FROM candidates c, (SELECT unnest([2, 3, 4]) AS m), (SELECT unnest([1, 2, 3, 4]) AS i)
    WHERE m < k AND i + m - 1 <= k
),
kept AS (SELECT * FROM scored s WHERE NOT EXISTS
         (SELECT 1 FROM inside x WHERE x.lang = s.lang AND x.phrase = s.phrase AND 100 * x.a >= 100 * s.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "C") AS rank,
       phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""

OP12_INFILL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
    FROM documents
),
numbers AS (
    SELECT doc_id, t, u, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
           ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
    FROM d
),
cut AS (
    SELECT doc_id, t, n,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50
                THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(u[1 : least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
           array_to_string(u[least(h1 % (n + 1), h2 % (n + 1)) + 1 : greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
           array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1 :], '') AS s
    FROM numbers
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""

ORACLE_SQL = {
    "op1_decontaminate": OP1_DECONTAMINATE,
    "op4_licenses": OP4_LICENSES,
    "op5_mix": OP5_MIX,
    "op11_collocations": OP11_COLLOCATIONS,
    "op12_infill": OP12_INFILL,
}
