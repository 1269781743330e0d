"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WS = "'[ \\t\\n\\x0b\\x0c\\r]'"

# an upper bound: FANOUT ** LEVELS rows of one group
FANOUT, LEVELS = 16, 6


def _tree(name: str, source: str, group: str, order: str) -> str:
    """CTEs of a hash tree over ``source`` (group, order, h): each level as
    ``name``_k, and ``name``_way with every leaf's siblings and its folding steps."""
    parts = [f"""{name}_0 AS (
  SELECT {group} AS g, {order} AS o, h, row_number() OVER (PARTITION BY {group} ORDER BY {order}) - 1 AS pos,
         count(*) OVER (PARTITION BY {group}) AS n FROM {source})"""]
    for k in range(1, LEVELS + 1):
        parts.append(f"""{name}_{k} AS (
  SELECT g, pos // {FANOUT} AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h,
         (n + {FANOUT - 1}) // {FANOUT} AS n FROM {name}_{k - 1} WHERE n > 1 GROUP BY g, n, pos // {FANOUT})""")
    for k in range(LEVELS):
        parts.append(f"""{name}_s{k} AS (
  SELECT g, pos, n, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}_{k} WHERE n > 1 WINDOW w AS (PARTITION BY g, pos // {FANOUT} ORDER BY pos))""")
    joins = "".join(f"\n  LEFT JOIN {name}_s{k} s{k} ON s{k}.g IS NOT DISTINCT FROM a.g AND s{k}.pos = a.pos // {FANOUT ** k}"
                    for k in range(LEVELS))
    listed = ", ".join(f"CASE WHEN s{k}.l IS NOT NULL THEN [s{k}.l, s{k}.r] END" for k in range(LEVELS))
    parts.append(f"""{name}_way AS (
  SELECT a.g, a.o, a.pos, a.h, list_filter([{listed}], lambda x: x IS NOT NULL) AS way FROM {name}_0 a{joins})""")
    top = " UNION ALL ".join(f"SELECT g, h FROM {name}_{k} WHERE n = 1" for k in range(LEVELS + 1))
    parts.append(f"{name}_top AS ({top})")
    return ",\n".join(parts)


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


CRC32 = """xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
           lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)),
                                      lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))))"""
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op3_mixing": """
WITH r AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('mix' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
  FROM r GROUP BY source),
u AS (
  SELECT *, ((sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0))::DOUBLE
             / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE) AS unit
  FROM s WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT *, least((3 * source_size)::DOUBLE, max(unit) OVER () * weight) AS target FROM u),
p AS (
  SELECT r.*, source_size, target, floor(target + 0.5)::BIGINT AS budget, greatest(source_size, 1) AS own,
         coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY key, doc_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       ((budget // own) * size + greatest(0, least(size, budget % own - before)))::BIGINT AS taken
FROM p""",
    "op4_exact_dedup": f"""
WITH r AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), {WS}, '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM r
WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "op6_chat": r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT conv_id, turn, role, text,
         length(regexp_replace(replace(text, '\', '\\'),
           '(<\|(?:start|text|turn|end|im_start|im_end|endoftext|system|user|assistant)\|>|</?s>|\[/?INST\]|<</?SYS>>)',
           '\1+', 'g')) AS chars,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars + CASE WHEN before = role THEN length('<|turn|>')
                        ELSE length('<|start|><|text|><|end|>') + 1 + length(role) END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op7_warc": """
WITH r AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM r)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f""",
    "op8_line_dedup": r"""
WITH l AS (
  SELECT doc_id, md5(text) AS body, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
         unnest(string_split(text, chr(10))) AS line
  FROM documents),
m AS (
  SELECT *, trim(regexp_replace(regexp_replace(line, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'),
                                '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS masked FROM l),
t AS (SELECT *, string_split(masked, ' ') AS tokens, len(string_split(masked, ' ')) AS n FROM m),
s AS (SELECT DISTINCT masked, body, n, tokens FROM t WHERE masked <> ''),
c AS (SELECT masked, n, tokens, count(*) AS docs FROM s GROUP BY ALL),
f AS (SELECT n, tokens[1:3] AS head, sum(docs) AS total FROM c WHERE n >= 8 GROUP BY ALL HAVING count(*) > 1),
w AS (
  SELECT c.masked, c.n, f.head, f.total, c.docs, unnest(c.tokens[4:]) AS token,
         generate_subscripts(c.tokens[4:], 1) AS place
  FROM c JOIN f ON c.n = f.n AND c.tokens[1:3] = f.head),
x AS (
  SELECT n, head, place, token FROM w GROUP BY n, head, total, place, token
  HAVING sum(docs) >= 5 AND sum(docs) * 100 >= total * 10),
g AS (
  SELECT masked, n, head, list((place, token) ORDER BY place) AS same FROM w JOIN x USING (n, head, place, token)
  GROUP BY masked, n, head HAVING (count(*) + 3) * 100 >= n * 60),
h AS (
  SELECT n, head, same FROM g JOIN (SELECT masked, body FROM s) AS b USING (masked)
  GROUP BY n, head, same HAVING count(DISTINCT body) >= 5),
o AS (SELECT body, count(*) AS own FROM s JOIN c USING (masked) WHERE docs < 5 GROUP BY body),
p AS (
  SELECT a.masked, a.n, a.body AS a, b.body AS b FROM s AS a JOIN s AS b ON a.masked = b.masked AND a.body < b.body
  JOIN c ON c.masked = a.masked WHERE c.docs < 5),
q AS (
  SELECT a, b FROM p JOIN o AS x ON x.body = a JOIN o AS y ON y.body = b
  GROUP BY a, b HAVING 2 * count(*) <= greatest(any_value(x.own), any_value(y.own))),
z AS (
  SELECT masked FROM c WHERE docs >= 5 UNION
  SELECT masked FROM g JOIN h USING (n, head, same) UNION
  SELECT masked FROM p JOIN q USING (a, b) WHERE n >= 50),
d AS (SELECT doc_id, pos, line, masked IN (SELECT masked FROM z) AS drop FROM m)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT drop), '') AS text,
       count(*) AS n_lines, count(*) FILTER (drop) AS n_dropped
FROM d GROUP BY doc_id""",
    "op11_merkle": f"""
WITH d AS (
  SELECT doc_id, source, {_leaf("text")} AS h,
         CASE WHEN {CRC32} % 5 = 0 THEN {_leaf(LOWERED)} ELSE {_leaf("text")} END AS now
  FROM documents),
{_tree("t", "d", "source", "(doc_id, h, now)")},
{_tree("u", "(SELECT 0 AS one, (coalesce(length(g), -1) >= 0, encode(coalesce(g, ''))) AS k, h, g FROM t_top)",
       "one", "(k, g)")}
SELECT t.o[1] AS doc_id, t.h AS leaf, u.h AS subroot, r.h AS root,
       sha256(array_to_string(list_transform(list_concat(t.way, u.way), lambda x: x[1] || x[2]), '')) AS proof_sha256,
       list_reduce(list_concat([[t.o[3]]], t.way, u.way),
                   lambda a, x: [sha256(x[1] || a[1] || x[2])])[1] AS folded_root,
       folded_root = root AS verified
FROM t_way t JOIN u_way u ON u.o[2] IS NOT DISTINCT FROM t.g CROSS JOIN u_top r""",
}
