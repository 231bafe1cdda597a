"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

EXACT_DEDUP = rf"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '{WS}', ' ', 'g') AS t FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(t) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY t ORDER BY doc_id NULLS LAST)
"""


def mix_sources(documents: str = "documents", seed: int = 42, max_epochs: int = 3) -> str:
    """Capped water-filling in closed form: sources in order of cap over weight."""
    return rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM {documents}
), h AS (
  SELECT *, ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || size), 1, 15))::BIGINT AS u FROM d
), s AS (
  SELECT source, sum(size)::HUGEINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::HUGEINT AS weight
  FROM d GROUP BY source
), a AS (
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum({max_epochs} * source_size) OVER (ORDER BY {max_epochs} * source_size / weight::DOUBLE, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(weight) OVER (ORDER BY {max_epochs} * source_size / weight::DOUBLE, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM s
), c AS (
  SELECT *, source_size = 0 OR {max_epochs} * source_size * free < weight * (total - held) AS capped FROM a
), l AS (
  SELECT max(total) - coalesce(sum({max_epochs} * source_size) FILTER (capped), 0) AS rest, sum(weight) FILTER (NOT capped) AS free FROM c
), t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN ({max_epochs} * source_size)::DOUBLE ELSE (weight * rest)::DOUBLE / l.free::DOUBLE END AS target
  FROM c, l
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), {max_epochs})::BIGINT ELSE 0 END AS whole FROM t
), q AS (
  SELECT *, round(target - whole * source_size)::BIGINT AS rest FROM p
), r AS (
  SELECT h.doc_id, h.size, q.source_size::BIGINT AS source_size, q.target, q.whole, q.rest,
         sum(h.size) OVER (PARTITION BY h.source ORDER BY h.u, h.doc_id NULLS LAST, h.size) AS upto,
         sum(h.size) OVER (PARTITION BY h.source, h.u, h.doc_id, h.size) AS same,
         count(*) OVER (PARTITION BY h.source, h.u, h.doc_id, h.size) AS n
  FROM h JOIN q ON h.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, size, source_size, target,
       (whole * size + floor(least(greatest(rest - (upto - same), 0), same) / n))::BIGINT AS taken
FROM r
"""


MIX_SOURCES = mix_sources()


def _positions(source: str, kind: str, order: int, regex: str, group: int, least: int) -> str:
    """Places of a regex's matches: lengths of the pieces and matches before."""
    rx = regex.replace("'", "''")
    return rf"""
  SELECT rn, {order} AS ord, '{kind}' AS kind,
         coalesce(list_sum([length(x) FOR x IN ps[1:i]]), 0) + coalesce(list_sum([length(x) FOR x IN ms[1:i-1]]), 0) AS s,
         length(ms[i]) AS len
  FROM (
    SELECT rn, ms, ps, gs, unnest(range(1, len(ms) + 1)) AS i FROM (
      SELECT rn, regexp_extract_all(t, '{rx}', 0) AS ms, regexp_extract_all(t, '{rx}', {group}) AS gs,
             string_split_regex(t, '{rx}') AS ps
      FROM {source} WHERE regexp_matches(t, '{rx}')
    )
  ) WHERE length(gs[i]) >= {least}"""


def secret_scan(rules, base_kinds, documents: str = "documents") -> str:
    parts = " UNION ALL ".join(_positions("d", r.kind, n, r.regex, r.group, r.least) for n, r in enumerate(rules))
    base = ", ".join(f"'{k}'" for k in base_kinds)
    counts = ",\n       ".join(f"count(kind) FILTER (kind = '{k}') AS n_{k}" for k in base_kinds)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM {documents}
), p AS MATERIALIZED ({parts}
), q AS (
  SELECT *, kind || ':' || s::BIGINT || ':' || (s + len)::BIGINT AS span FROM p
)
SELECT any_value(doc_id) AS doc_id,
       {counts},
       sha256(coalesce(string_agg(span, ',' ORDER BY s, ord) FILTER (kind IN ({base})), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY s, ord), '') AS spans
FROM d LEFT JOIN q USING (rn)
GROUP BY rn
"""


def top_k(k: int = 5, every: int = 50, scale: int = 256, embeddings: str = "embeddings") -> str:
    return rf"""
WITH v AS (
  SELECT DISTINCT vec_id, [floor({scale} * x::DOUBLE) FOR x IN embedding] AS v FROM {embeddings}
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, q.v AS qv, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON len(c.v) = len(q.v) AND c.vec_id <> q.vec_id WHERE q.vec_id % {every} = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, qv ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {k}
"""


def license_scan(texts, notices, equivalents, punctuation, documents: str = "documents") -> str:
    """Lines are split and judged one by one; nothing of the operator's rule is used."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def low(t: str) -> str:
        return f"translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def is_copyright(line: str) -> str:
        x = f"ltrim({line}, ' ' || chr(9))"
        year = "SIMILAR TO '[0-9][0-9][0-9][0-9]'"

        def after(n: int, also: str = "") -> str:
            return f"ltrim(substr({x}, {n}), ' ' || chr(9) || '{also}')"

        word, sign = after(10, ":"), after(4)
        return (
            f"(starts_with({x}, '©') OR starts_with({x}, 'all rights reserved')"
            f" OR (starts_with({x}, 'copyright') AND (starts_with({word}, '(c)') OR starts_with({word}, '©') OR left({word}, 4) {year}))"
            f" OR (starts_with({x}, '(c)') AND (starts_with({sign}, 'copyright') OR starts_with({sign}, '©') OR left({sign}, 4) {year})))"
        )

    def dropped(t: str) -> str:
        return f"array_to_string(list_filter(string_split({low(t)}, chr(10)), lambda x: NOT {is_copyright('x')}), chr(10))"

    def form(lowered: str) -> str:
        e = f"' ' || regexp_replace({lowered}, {quoted(punctuation)}, '  ', 'g') || ' '"
        for a, b in equivalents:
            e = f"replace({e}, ' {a.replace(' ', '  ')} ', ' {b.replace(' ', '  ')} ')"
        return f"trim(regexp_replace({e}, ' +', ' ', 'g'), ' ')"

    def known(rows) -> str:
        values = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in rows)
        both = f"unnest([sha256({form(dropped('t'))}), sha256({form(low('t'))})])"
        return f"SELECT known, min(l) AS license FROM (SELECT {both} AS known, l FROM (VALUES {values}) x(l, t)) GROUP BY 1"

    return f"""
WITH w AS MATERIALIZED ({known(texts)}), n AS MATERIALIZED ({known(notices)}),
d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM {documents}),
f AS (SELECT rn, doc_id, {form(dropped('t'))} AS f, {form(low('t'))} AS g FROM d),
l AS (SELECT rn, {form(dropped('line'))} AS f FROM (SELECT rn, unnest(string_split(t, chr(10))) AS line FROM d)),
m AS (SELECT rn, string_agg(DISTINCT n.license, ',' ORDER BY n.license) AS found FROM l JOIN n ON sha256(l.f) = n.known GROUP BY rn)
SELECT f.doc_id, CASE WHEN f <> '' THEN sha256(f) END AS text_digest, coalesce(w.license, e.license) AS license, coalesce(m.found, '') AS line_licenses
FROM f LEFT JOIN w ON f <> '' AND w.known = sha256(f) LEFT JOIN w e ON e.known = sha256(g) LEFT JOIN m ON m.rn = f.rn
"""


def conversation_repair(conversations: str = "conversations") -> str:
    """CRC-32 bit by bit, then a forward program over (cost, letters) of four states."""
    none = "{'c': 1000000000::BIGINT, 's': '', 'o': []::VARCHAR[]}"

    def made(x: str, cost: str, letter: str, line: str | None) -> str:
        lines = f"list_append({x}.o, {line})" if line else f"{x}.o"
        return f"{{'c': {x}.c + {cost}, 's': {x}.s || '{letter}', 'o': {lines}}}"

    def least(*x: str) -> str:
        return f"list_sort([{', '.join(x)}])[1]"

    def dropped(x: str) -> str:
        return made(x, "2", "D", None)

    def kept(x: str, who: str) -> str:
        return f"CASE WHEN fault IN ('', 'truncated') AND who = '{who}' THEN {made(x, 'extra', 'K', line)} ELSE {none} END"

    def changed(x: str, role: str) -> str:
        return f"CASE WHEN fault IN ('', 'truncated') THEN {made(x, 'extra + 1', 'R', f'{chr(39)}{role}:{chr(39)} || t')} ELSE {none} END"

    def added(x: str, role: str) -> str:
        return made(x, "5", "I", f"'{role}:'")

    line = "role || ':' || t"
    as_u = [f(x, w) for x in ("x0", "xs", "xa") for f, w in ((kept, "u"), (changed, "user"))]
    return rf"""
WITH RECURSIVE tab AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM tab WHERE k < 8
), raw AS (
  SELECT row_number() OVER () AS rn, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS cn, conv_id, turn,
         coalesce(role, ' ') AS role, coalesce(text, ' ') AS t,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM {conversations}
), crc AS (
  SELECT rn, key, 0 AS p, 4294967295::BIGINT AS c FROM raw
  UNION ALL
  SELECT rn, key, p + 1, xor(crc.c >> 8, tab.c) FROM crc JOIN tab ON tab.k = 8 AND tab.i = xor(crc.c, ascii(key[p + 1])::BIGINT) & 255
  WHERE p < length(key)
), what AS (
  SELECT raw.*, xor(crc.c, 4294967295) % 20 AS what FROM raw JOIN crc USING (rn) WHERE p = length(raw.key)
), damaged AS (
  SELECT rn, cn, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN what = 1 THEN '' WHEN what = 2 THEN regexp_replace(t, '[.!?]', '', 'g') ELSE t END AS t,
         unnest(range(CASE WHEN what = 3 THEN 2 ELSE 1 END)) AS copy
  FROM what WHERE what <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY cn ORDER BY turn NULLS FIRST, role, sha256(t), rn, copy) AS pos,
         row_number() OVER (PARTITION BY cn, role, t ORDER BY turn NULLS FIRST, rn, copy) AS nth,
         right(regexp_replace(t, '[\x20\x09-\x0D]+$', ''), 1) AS last
  FROM damaged
), f AS (
  SELECT *, role[1] AS who, coalesce(lag(role[1]) OVER (PARTITION BY cn ORDER BY pos) || role[1] NOT IN ('su', 'ua', 'au'), false) AS odd,
         CASE WHEN last = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN last IN ('.', '!', '?') THEN '' ELSE 'truncated' END AS fault
  FROM placed
), counts AS (
  SELECT cn, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (odd) AS illegal
  FROM f GROUP BY cn
), dp AS (
  SELECT cn, 0::BIGINT AS pos, z AS x0, {none} AS xs, {added('z', 'user')} AS xu, {{'c': z.c + 10, 's': 'II', 'o': ['user:', 'assistant:']}} AS xa
  FROM (SELECT cn, {{'c': 0::BIGINT, 's': '', 'o': []::VARCHAR[]}} AS z FROM counts)
  UNION ALL
  SELECT cn, pos, y0, ys, zu, {least('ya', added('zu', 'assistant'))} FROM (
    SELECT *, {least('yu', added('y0', 'user'), added('ys', 'user'), added('ya', 'user'))} AS zu FROM (
      SELECT f.cn, f.pos, {dropped('x0')} AS y0, {least(dropped('xs'), kept('x0', 's'))} AS ys,
             {least(dropped('xu'), *as_u, changed('xs', 'user'))} AS yu,
             {least(dropped('xa'), kept('xu', 'a'), changed('xu', 'assistant'))} AS ya
      FROM dp JOIN (SELECT *, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM f) f ON f.cn = dp.cn AND f.pos = dp.pos + 1
    )
  )
), best AS (
  SELECT cn, {least('x0', 'xa')} AS b FROM dp JOIN counts USING (cn) WHERE pos = n
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost,
       coalesce(b.s, '') AS audit, sha256(coalesce(array_to_string(b.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT cn, conv_id FROM raw) LEFT JOIN counts USING (cn) LEFT JOIN best USING (cn)
"""


def collocations(least: int = 100, top: int = 2000, longest: int = 5, documents: str = "documents") -> str:
    """All phrases of up to five words, counted one length at a time."""
    lengths = range(1, longest + 1)
    grams = " UNION ALL ".join(f"SELECT lang, ws[i:i+{d - 1}] AS p FROM spots WHERE i + {d - 1} <= len(ws)" for d in lengths)
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM {documents}
), ws AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), spots AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM ws
), c AS MATERIALIZED (
  SELECT lang, p, count(*) AS f FROM ({grams}) GROUP BY lang, p HAVING count(*) >= {least}
), n AS (
  SELECT lang, sum(len(ws))::HUGEINT AS n FROM ws GROUP BY lang
), longer AS (
  SELECT lang, p, max(f) AS f FROM (
    SELECT lang, f, unnest([p[1:len(p)-1], p[2:len(p)]]) AS p FROM c WHERE len(p) > 2
  ) GROUP BY lang, p
), kept AS (
  SELECT c.lang, c.p, c.f AS a, unnest(range(1, len(c.p))) AS k
  FROM c LEFT JOIN longer g ON g.lang = c.lang AND g.p = c.p WHERE len(c.p) > 1 AND (g.f IS NULL OR g.f < c.f)
), cut AS (
  SELECT kept.*, l.f AS l, r.f AS r, n.n, (1000 * a::HUGEINT * n.n) // (l.f::HUGEINT * r.f::HUGEINT) AS score
  FROM kept JOIN n USING (lang) JOIN c l ON l.lang = kept.lang AND l.p = kept.p[1:k] JOIN c r ON r.lang = kept.lang AND r.p = kept.p[k+1:len(kept.p)]
), low AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM low
)
SELECT lang, rank, array_to_string(p, ' ') AS phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= {top}
"""
