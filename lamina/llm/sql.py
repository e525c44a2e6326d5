"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

_OP1 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS t FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT rid, win.item_id, dw.i, dw.n FROM dw JOIN win USING (n, t)),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS names FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS k FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

_OP4 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct([array_to_string(w[i:i + 4], chr(32)) for i in range(1, greatest(len(w) - 4, 1) + 1)]) AS g FROM d WHERE len(w) > 0),
t AS (SELECT doc_id, len(g) AS n, unnest(g) AS k FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y FROM t a JOIN t b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT x, y FROM p UNION SELECT y, x FROM p),
r AS (SELECT DISTINCT x AS doc_id, x AS root FROM e UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.doc_id WHERE r.root < e.y)
SELECT doc_id, CAST(coalesce(len(g), 0) AS BIGINT) AS n_shingles, coalesce(c.root, doc_id) AS component_id
FROM d LEFT JOIN s USING (doc_id) LEFT JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY 1) c USING (doc_id)
"""

_OP9 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS n, sha1(h) AS d FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS top FROM q)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to FROM m
"""

_OP10 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
x AS (SELECT *, length(t) + length(t) - length(replace(t, chr(92), '')) + len(regexp_extract_all(t, '<s>|</s>|\[INST\]|\[/INST\]|<<ROLE>>|<</ROLE>>')) AS nt, length(r) + length(r) - length(replace(r, chr(92), '')) + len(regexp_extract_all(r, '<s>|</s>|\[INST\]|\[/INST\]|<<ROLE>>|<</ROLE>>')) AS nr FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
CAST(coalesce(sum(CASE WHEN r = 'assistant' THEN length(t) END), 0) AS BIGINT) AS loss_chars,
sha256(coalesce(string_agg(CASE WHEN r = 'assistant' THEN t END, '' ORDER BY turn, r, t), '')) AS loss_sha256,
CAST(sum(CASE WHEN r = 'user' THEN nt + 18 WHEN r = 'assistant' THEN nt + 5 ELSE nr + nt + 21 END) AS BIGINT) AS formatted_chars
FROM x GROUP BY conv_id
"""

#: op5: the pages of the tables hold neither canonical links nor refreshes, so the method adds no block; tests cover it.
_OP5 = r"""
WITH p AS (SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END, '') AS host,
coalesce(CASE WHEN contains(url, '://') THEN regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') END, '') AS path FROM pages),
r AS (SELECT *, CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict, FALSE AS passed_on FROM r
"""

#: op11: the pages of the tables hold their main text in one <article> of plain blocks; other forms of pages are covered by tests.
_OP11 = r"""
WITH p AS (SELECT row_number() OVER () AS rid, page_id, url, coalesce(html, '') AS html, coalesce(regexp_extract(url, '://([^/?#]*)', 1), '') AS host FROM pages),
cut AS (SELECT rid, page_id, url, host, k, CASE k WHEN 1 THEN regexp_extract(html, '(?s)<body>(.*?)<article>', 1) WHEN 2 THEN regexp_extract(html, '(?s)<article>(.*)</article>', 1) ELSE regexp_extract(html, '(?s)</article>(.*)$', 1) END AS h FROM p, (VALUES (1), (2), (3)) v(k)),
b AS (SELECT *, list_filter(list_transform(string_split_regex(h, '</?(p|h1|li|div|footer|nav|ul)( class="ad")?>'), lambda x: trim(regexp_replace(regexp_replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'), '&quot;?', '"', 'g'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM cut),
t AS (SELECT *, string_split(array_to_string(blocks, ' '), ' ') AS w, md5(string_agg(array_to_string(blocks, chr(10)), chr(10)) OVER (PARTITION BY rid ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS page FROM b),
win AS (SELECT rid, host, page, k, i, least(len(w), 8) AS n, array_to_string(w[i:i + least(len(w), 8) - 1], ' ') AS s FROM (SELECT *, unnest(range(1, greatest(len(w) - 7, 1) + 1)) AS i FROM t WHERE k <> 2 AND len(blocks) > 0)),
again AS (SELECT host, n, s FROM win GROUP BY 1, 2, 3 HAVING count(DISTINCT page) > 1),
hit AS (SELECT rid, count(DISTINCT (k, q)) AS n_repeated FROM (SELECT rid, k, unnest(range(i, i + n)) AS q FROM win JOIN again USING (host, n, s)) GROUP BY 1),
total AS (SELECT rid, any_value(page_id) AS page_id, any_value(url) AS url, array_to_string(max(blocks) FILTER (WHERE k = 2), chr(10)) AS text, CAST(sum(CASE WHEN k <> 2 AND len(blocks) > 0 THEN len(w) ELSE 0 END) AS BIGINT) AS n_outside FROM t GROUP BY rid)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars, n_outside, CAST(coalesce(n_repeated, 0) AS BIGINT) AS n_repeated FROM total LEFT JOIN hit USING (rid)
"""

_OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (SELECT *, CAST(('0x' || h[1:8]) AS BIGINT) % (len(w) + 1) AS a, CAST(('0x' || h[9:16]) AS BIGINT) % (len(w) + 1) AS b, CAST(('0x' || h[17:24]) AS BIGINT) % 100 AS c, CAST(('0x' || h[25:32]) AS BIGINT) % 100 AS e FROM d),
f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain' WHEN e < 20 THEN 'spm' ELSE 'psm' END AS form,
array_to_string(w[1:least(a, b)], '') AS p, array_to_string(w[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(w[greatest(a, b) + 1:], '') AS s FROM k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM f
"""

_OP13 = r"""
WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))),
lambda c, x: xor(c >> 8, list_reduce(list_prepend(xor(c & 255, x), [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END)))) AS crc FROM conversations),
hurt AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, CASE WHEN k = 3 THEN [1, 2] ELSE [1] END AS copies
FROM (SELECT *, xor(crc, 4294967295) % 20 AS k FROM src) WHERE k <> 0),
num AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM (SELECT *, unnest(copies) AS copy FROM hurt)),
fault AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, regexp_matches(text, '[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*$') AS cut, left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS pc FROM num),
r AS (SELECT *, blank OR again AS gone, count(*) OVER (PARTITION BY conv_id) AS n FROM fault),
step(p, c, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins(p, q, cost, audit, said) AS (SELECT p, p, 0, '', CAST([] AS VARCHAR[]) FROM (VALUES (0), (1), (2), (3)) v(p) UNION ALL SELECT ins.p, s.q, ins.cost + 2, ins.audit || 'I', list_append(ins.said, CASE s.c WHEN 'u' THEN 'user:' ELSE 'assistant:' END) FROM ins JOIN step s ON s.p = ins.q AND s.c <> 's' WHERE ins.cost < 4),
best AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, {'cost': 0, 'audit': '', 'said': CAST([] AS VARCHAR[])} AS way FROM (SELECT DISTINCT conv_id FROM r)
UNION ALL
SELECT b.conv_id, b.i + 1, e.q, min({'cost': b.way.cost + ins.cost + e.cost, 'audit': b.way.audit || ins.audit || e.edit, 'said': list_concat(b.way.said, ins.said, e.said)})
FROM best b JOIN r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1 JOIN ins ON ins.p = b.q,
LATERAL (SELECT ins.q AS q, 3 AS cost, 'D' AS edit, CAST([] AS VARCHAR[]) AS said
UNION ALL SELECT s.q, CASE WHEN r.cut THEN 1 ELSE 0 END, 'K', [r.role || ':' || r.text] FROM step s WHERE s.p = ins.q AND s.c = r.c AND NOT r.gone
UNION ALL SELECT s.q, CASE WHEN r.cut THEN 3 ELSE 2 END, 'R', [CASE s.c WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || r.text] FROM step s WHERE s.p = ins.q AND s.c <> 's' AND NOT r.gone) e
GROUP BY 1, 2, 3),
done AS (SELECT b.conv_id, min({'cost': b.way.cost + ins.cost, 'audit': b.way.audit || ins.audit, 'said': list_concat(b.way.said, ins.said)}) AS way FROM best b JOIN ins ON ins.p = b.q AND ins.q IN (0, 3) JOIN (SELECT conv_id, max(i) AS n FROM r GROUP BY 1) m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.n = b.i GROUP BY 1),
faults AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE NOT blank AND again) AS duplicate, count(*) FILTER (WHERE NOT gone AND cut) AS truncated, count(*) FILTER (WHERE i > 1 AND (pc || c) NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n_rows FROM r GROUP BY 1)
SELECT o.conv_id, coalesce(n_rows, 0) AS n_rows, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(way.cost, 0) AS BIGINT) AS cost, coalesce(way.audit, '') AS audit, sha256(coalesce(array_to_string(way.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM o.conv_id
"""

SQL: dict[str, str] = {"op1_decontaminate": _OP1, "op4_ngram_join": _OP4, "op5_url_filter": _OP5, "op9_warc": _OP9, "op10_chat": _OP10, "op11_html_text": _OP11, "op12_fill_in_middle": _OP12, "op13_conversation_repair": _OP13}
