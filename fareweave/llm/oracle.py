"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op7_exact_dedup": """
WITH t AS (SELECT doc_id, coalesce(text, '') AS body, row_number() OVER () AS r FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST, r) = 1 AS kept,
       sha256(body) AS text_sha256
FROM t
""",
    # Shards take turns: one step of the recursion is one look at a slot.
    "op1_sharding": """
WITH RECURSIVE
shards AS (SELECT i::INTEGER AS i, printf('shard-%05d', i) AS shard FROM range(32) r(i)),
walks AS (
  SELECT i, shard,
         ('0x' || substr(md5('offset:' || shard), 1, 13))::BIGINT % 4093 AS start,
         ('0x' || substr(md5('skip:' || shard), 1, 13))::BIGINT % 4092 + 1 AS skip
  FROM shards),
look(k, turn, next, skip, owner, open) USING KEY (k) AS (
  SELECT 0, 0, list(start ORDER BY i), list(skip ORDER BY i), list_resize([]::INTEGER[], 4093, -1), 4093 FROM walks
  UNION
  SELECT 0, CASE WHEN free THEN (turn + 1) % 32 ELSE turn END,
         next[:turn] || [(slot + skip[turn + 1]) % 4093] || next[turn + 2:], skip,
         CASE WHEN free THEN owner[:slot] || [turn] || owner[slot + 2:] ELSE owner END, open - free::INTEGER
  FROM (SELECT *, next[turn + 1] AS slot, owner[next[turn + 1] + 1] < 0 AS free FROM look)
  WHERE open > 0),
owners AS (
  SELECT slot, shard
  FROM (SELECT unnest(owner) AS i, generate_subscripts(owner, 1) - 1 AS slot FROM look) JOIN shards USING (i)),
keyed AS (
  SELECT doc_id, ('0x' || substr(md5('key:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT % 4093 AS slot
  FROM documents)
SELECT doc_id, slot, shard FROM keyed LEFT JOIN owners USING (slot)
""",
    "op3_mixing": r"""
WITH RECURSIVE
sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0 * sum(size)::DOUBLE AS most,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source),
total AS (SELECT sum(source_size)::DOUBLE * 1.5 AS all_words, sum(weight) AS all_weight FROM sources),
-- the share of a unit of weight, until no source is above its limit
fill(n, per_weight) AS (
  SELECT 0, all_words / all_weight FROM total
  UNION ALL
  SELECT n, next FROM (
    SELECT f.n + 1 AS n, f.per_weight,
           ((SELECT all_words FROM total) - sum(CASE WHEN s.most <= s.weight * f.per_weight THEN s.most ELSE 0.0 END))
           / sum(CASE WHEN s.most <= s.weight * f.per_weight THEN 0.0 ELSE s.weight END) AS next
    FROM fill f, sources s GROUP BY f.n, f.per_weight)
  WHERE next <> per_weight),
shares AS (
  SELECT source, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS e
  FROM (SELECT source, source_size,
               least(most, weight * (SELECT per_weight FROM fill ORDER BY n DESC LIMIT 1)) AS target FROM sources)),
drawn AS (
  SELECT d.doc_id, d.source, d.size, s.source_size, s.target, floor(s.e)::BIGINT AS whole, s.e - floor(s.e) AS p,
         s.target - floor(s.e)::BIGINT * s.source_size AS rest,
         ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM sized d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source),
ranked AS (
  SELECT *, u * (1 - p) / (u * (1 - p) + (1 - u) * p) AS place FROM drawn),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) AS words FROM ranked),
gaps AS (
  SELECT *, p > 0 AND words <= rest AS chosen,
         rest - coalesce(max(CASE WHEN p > 0 AND words <= rest THEN words END) OVER (PARTITION BY source), 0) AS gap,
         max(words) OVER (PARTITION BY source) <= rest AS takes_all
  FROM summed),
fillers AS (
  SELECT *, row_number() OVER (
    PARTITION BY source
    ORDER BY (p > 0 AND NOT chosen AND abs(size - gap) < gap) DESC, abs(size - gap), place, doc_id) = 1
    AND p > 0 AND NOT chosen AND NOT takes_all AND abs(size - gap) < gap AS filler
  FROM gaps)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       whole + (chosen OR filler)::BIGINT AS copies,
       ((whole + (chosen OR filler)::BIGINT) * size)::BIGINT AS taken
FROM fillers
""",
}


# A written line joins what stands before it; no line is empty.
def _edit(x: str, cost: str, letter: str, line: str | None) -> str:
    """The SQL of a state after an edit; null stays null."""
    out = f"{x}.\"out\"" if line is None else f"CASE WHEN {x}.\"out\" = '' THEN {line} ELSE {x}.\"out\" || chr(10) || {line} END"
    return f"CASE WHEN {x} IS NOT NULL THEN {{'cost': {x}.cost + {cost}, 'audit': {x}.audit || '{letter}', 'out': {out}}} END"


def _delete(x: str) -> str:
    return _edit(x, "4", "D", None)


def _keep(*xs: str) -> str:
    return ", ".join(_edit(x, "extra", "K", "(role || ':' || text)") for x in xs)


def _rerole(role: str, *xs: str) -> str:
    return ", ".join(_edit(x, "3 + extra", "R", f"('{role}:' || text)") for x in xs)


def _insert(role: str, *xs: str) -> str:
    return ", ".join(_edit(x, "3", "I", f"'{role}:'") for x in xs)


STATE = 'STRUCT("cost" BIGINT, audit VARCHAR, "out" VARCHAR)'

def _walk(sql: str) -> str:
    parts = {
        "@STATE": STATE, "@DN": _delete("n"), "@DS": _delete("s"), "@DU": _delete("u1"), "@DA": _delete("a1"),
        "@KN": _keep("n"), "@KU": _keep("n", "s", "a1"), "@KA": _keep("u1"), "@RU": _rerole("user", "n", "s", "a1"),
        "@RA": _rerole("assistant", "u1"), "@IU": _insert("user", "n", "s", "a"), "@IA": _insert("assistant", "u1"),
        "@IS": _insert("user", "s"),
    }
    for name, part in parts.items():
        sql = sql.replace(name, part)
    return sql


# Rows one after the other, all conversations at once; states as a finite automaton, no stacks.
ORACLES["op13_conversations"] = _walk(r"""
WITH RECURSIVE
-- CRC-32 by table
steps(i, k, c) AS (
  SELECT i::BIGINT, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                                        lambda ch: ord(ch)::BIGINT),
                         lambda c, b: xor(t[(xor(c, b) & 255) + 1], c // 256), 4294967295::BIGINT), 4294967295) % 20 AS kind
  FROM conversations, crc),
hurt AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hit, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copies(n)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), sha256(text)) AS pos,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM hurt),
seen AS (
  SELECT *, trimmed = '' AS blank,
         trimmed <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
         left(role, 1) AS letter, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed),
judged AS (
  SELECT *, NOT blank AND NOT again AND right(trimmed, 1) NOT IN ('.', '!', '?') AS cut, blank OR again AS must_go FROM seen),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || letter NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
ids AS (SELECT row_number() OVER () AS id, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
rows_of AS (
  SELECT id, pos, letter, role, text, must_go, CASE WHEN cut THEN 3 ELSE 0 END AS extra
  FROM judged j JOIN ids i ON i.conv_id IS NOT DISTINCT FROM j.conv_id),
-- the best way to have written nothing (n), a system row (s), up to a user's row (u), up to an assistant's (a)
walk(id, pos, n, s, u, a) USING KEY (id) AS (
  SELECT id, 0::BIGINT, {'cost': 0::BIGINT, 'audit': '', 'out': ''}, NULL::@STATE, NULL::@STATE, NULL::@STATE FROM ids
  UNION
  SELECT id, pos, @DN,
         list_min([@DS, CASE WHEN NOT must_go AND letter = 's' THEN @KN END]),
         list_min([@DU, CASE WHEN NOT must_go AND letter = 'u' THEN list_min([@KU]) END,
                   CASE WHEN NOT must_go THEN list_min([@RU]) END]),
         list_min([@DA, CASE WHEN NOT must_go AND letter = 'a' THEN @KA END, CASE WHEN NOT must_go THEN @RA END])
  FROM (
    SELECT *, list_min([a, @IA]) AS a1
    FROM (SELECT w.id, r.pos, n, s, u, a, letter, role, text, must_go, extra, list_min([u, @IU]) AS u1
          FROM walk w JOIN rows_of r ON r.id = w.id AND r.pos = w.pos + 1))),
ends AS (
  SELECT id, list_min([n, a, @IA]) AS best FROM (SELECT id, n, a, list_min([u, @IS]) AS u1 FROM walk))
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
       sha256(best."out") AS repaired_sha256
FROM ids i JOIN ends e ON e.id = i.id LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
""")
