"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY content) AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       row_number() OVER (PARTITION BY content ORDER BY doc_id) = 1 AS kept,
       sha256(content) AS text_sha256
FROM texts
"""

# Five hexadecimal digits are four base32 letters.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha, {at}, 5))::INT >> {shift}) & 31) + 1, 1)"
    for at in range(1, 41, 5)
    for shift in (15, 10, 5, 0)
)
WARC = f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS sha FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM payloads
)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""

# Whole sets and all pairs that share a shingle; components by a recursive walk along the links.
JACCARD = r"""
WITH RECURSIVE words AS (
  SELECT doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda v: v <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
), tokens AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, r.component_id, c.class_id
FROM sets s
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
JOIN (SELECT doc_id, CASE WHEN len(s) = 0 THEN doc_id
             ELSE min(doc_id) OVER (PARTITION BY list_sort(s)) END AS class_id FROM sets) c USING (doc_id)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = rf"list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda v: v <> '')"

# Every 400-byte string, by its hexadecimal digits.
REPEATS = """
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), starts AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS s
  FROM (SELECT doc_id, h, unnest(range(0, n - 399)) AS i FROM texts WHERE n >= 400)
), repeated AS (
  SELECT doc_id, i FROM starts WHERE s IN (SELECT s FROM starts GROUP BY s HAVING count(*) > 1)
), marked AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400, true)::INT AS new FROM repeated
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 400 AS b
  FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked)
  GROUP BY doc_id, run
), lists AS (
  SELECT doc_id, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b FROM spans GROUP BY doc_id
), pieces AS (
  -- What is kept lies between the end of a span and the start of the next one.
  SELECT t.doc_id, t.n, t.h, coalesce(len(l.a), 0) AS spans,
         list_prepend(0, coalesce(l.b, [])) AS begins, list_append(coalesce(l.a, []), t.n) AS ends
  FROM texts t LEFT JOIN lists l USING (doc_id)
), kept AS (
  SELECT doc_id, n, spans,
         array_to_string(list_transform(range(1, len(begins) + 1),
           lambda k: substr(h, 2 * begins[k] + 1, 2 * (ends[k] - begins[k]))), '') AS k
  FROM pieces
)
SELECT doc_id, n::BIGINT AS n_bytes, (n - length(k) // 2)::BIGINT AS n_removed, spans::BIGINT AS n_spans,
       sha256(unhex(k)) AS kept_sha256
FROM kept
"""

DECONTAMINATION = f"""
WITH items AS (
  SELECT item_id, {_SPLIT} AS w FROM benchmark WHERE text IS NOT NULL
), whole AS (
  SELECT item_id, w, list_filter(range(1, len(w)), lambda i: right(w[i], 1) IN ('.', '?', '!')) AS ends
  FROM items WHERE len(w) > 0
), parts AS (
  SELECT item_id, w, CASE WHEN len(ends) = 0 THEN w ELSE w[1:ends[-1]] END AS q,
         CASE WHEN len(ends) = 0 THEN w ELSE w[ends[-1] + 1:] END AS a
  FROM whole
), grams AS (
  SELECT item_id, least(5, len(q)) AS nq, least(5, len(a)) AS na,
         list_distinct(list_transform(range(1, len(q) - least(5, len(q)) + 2), lambda i: array_to_string(q[i:i + least(5, len(q)) - 1], ' '))) AS gq,
         list_distinct(list_transform(range(1, len(a) - least(5, len(a)) + 2), lambda i: array_to_string(a[i:i + least(5, len(a)) - 1], ' '))) AS ga
  FROM parts
), totals AS (
  SELECT count(*) AS items, avg(len(w)) AS mean, max(len(w)) AS longest FROM whole
), counts AS (
  SELECT item_id, len, word, count(*) AS n FROM (SELECT item_id, len(w) AS len, unnest(w) AS word FROM whole) GROUP BY ALL
), weights AS (
  SELECT item_id, word,
         ln(1 + (items - df + 0.5) / (df + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len / mean)) AS x
  FROM (SELECT *, count(*) OVER (PARTITION BY word) AS df FROM counts), totals
), impacts AS (
  SELECT item_id, word, x / sum(x) OVER (PARTITION BY item_id) AS x FROM weights
), docs AS (
  SELECT doc_id, {_SPLIT} AS w FROM documents
), passages AS (
  SELECT doc_id, j, w[j * longest + 1:(j + 2) * longest] AS p
  FROM (SELECT doc_id, w, longest, unnest(range(0, greatest(1, ceil(len(w) / longest)::INT - 1))) AS j
        FROM docs, totals WHERE len(w) > 0)
), found AS (
  SELECT doc_id, j, item_id
  FROM (SELECT doc_id, j, unnest(list_distinct(p)) AS word FROM passages) JOIN impacts USING (word)
  GROUP BY ALL HAVING sum(x) >= 0.5
), checked AS (
  SELECT doc_id, item_id, gq, ga,
         len(list_intersect(gq, list_transform(range(1, len(p) - nq + 2), lambda i: array_to_string(p[i:i + nq - 1], ' ')))) AS hq,
         len(list_intersect(ga, list_transform(range(1, len(p) - na + 2), lambda i: array_to_string(p[i:i + na - 1], ' ')))) AS ha
  FROM found JOIN passages USING (doc_id, j) JOIN grams USING (item_id)
)
SELECT doc_id, item_id, count(*)::BIGINT AS passages, max(hq)::BIGINT AS question_hits, max(ha)::BIGINT AS answer_hits
FROM checked WHERE 100 * hq >= 75 * len(gq) AND 100 * ha >= 75 * len(ga)
GROUP BY doc_id, item_id
"""

LINE_WINDOWS = """
WITH lines AS (
  SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text <> ''
), windows AS (
  SELECT doc_id, i, l[i + 1:i + 3] AS w FROM (SELECT doc_id, l, unnest(range(0, len(l) - 2)) AS i FROM lines)
), later AS (
  SELECT doc_id, i FROM windows WHERE len(list_filter(w, lambda v: regexp_matches(v, '[^\\x20\\x09-\\x0D]'))) > 0
  QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, i + k AS spot FROM later, (SELECT unnest(range(3)) AS k)
), spans AS (
  SELECT doc_id, count(*) AS n, sum(new) AS spans, list(spot) AS spots
  FROM (SELECT doc_id, spot, coalesce(spot > lag(spot) OVER (PARTITION BY doc_id ORDER BY spot) + 1, true)::INT AS new FROM gone)
  GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(l.l), 0)::BIGINT AS n_lines, coalesce(s.n, 0)::BIGINT AS n_removed,
       coalesce(s.spans, 0)::BIGINT AS n_spans,
       sha256(array_to_string(list_filter(coalesce(l.l, []), lambda v, k: NOT list_contains(coalesce(s.spots, []), k - 1)), chr(10))) AS kept_sha256
FROM documents d LEFT JOIN lines l USING (doc_id) LEFT JOIN spans s USING (doc_id)
"""

UNITS = """
WITH units AS (
  SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text <> '')
), words AS (
  SELECT doc_id, i, list_filter(regexp_split_to_array(lower(l[i]), '[\\x20\\x09-\\x0D]+'), lambda v: v <> '') AS w,
         (list_sum(list_transform(l[1:i - 1], lambda v: octet_length(encode(v)) + 1)))::BIGINT AS before,
         octet_length(encode(l[i])) AS size
  FROM units
), later AS (
  SELECT doc_id, i, coalesce(before, 0) AS a, coalesce(before, 0) + size AS b FROM words WHERE len(w) >= 1
  QUALIFY row_number() OVER (PARTITION BY array_to_string(w, ' ') ORDER BY doc_id, i) > 1
), lists AS (
  SELECT doc_id, list(i) AS gone, string_agg(a || '-' || b, ',' ORDER BY i) AS removed FROM later GROUP BY doc_id
), texts AS (
  SELECT doc_id, coalesce(text, '') AS text, CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS l FROM documents
)
SELECT t.doc_id, octet_length(encode(t.text))::BIGINT AS n_bytes, len(t.l)::BIGINT AS n_units,
       coalesce(len(s.gone), 0)::BIGINT AS n_removed, coalesce(s.removed, '') AS removed,
       sha256(array_to_string(list_filter(t.l, lambda v, k: NOT list_contains(coalesce(s.gone, []), k)), chr(10))) AS kept_sha256
FROM texts t LEFT JOIN lists s USING (doc_id)
"""

def _least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _way(cost: str, letter: str, state: int, allowed: str = "true") -> str:
    """One edit as (cost to go, its letters): lists of such structs sort by cost, then letters."""
    return f"{{'c': CASE WHEN {allowed} THEN v[{state + 1}].c + {cost} ELSE 1000000000 END, 'a': '{letter}' || v[{state + 1}].a}}"


# The state after a row: by state (nothing yet, after s, after u, after a), for the initials allowed
# there and for the role wanted there.
_AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_WANTED = (2, 2, 3, 2)
_STAYS, _EXTRA = "fault IN ('', 'truncated')", "(CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END)"
_EDITED = ", ".join(
    _least(
        _way("2", "D", k),
        _way(f"1 + {_EXTRA}", "R", _WANTED[k], _STAYS),
        *[_way(_EXTRA, "K", to, f"{_STAYS} AND initial = '{i}'") for i, to in _AFTER[k].items()],
    )
    for k in range(4)
)
_INSERTED = ", ".join(
    _least(f"v[{k + 1}]", f"{{'c': v[{_WANTED[k] + 1}].c + 5, 'a': 'I' || v[{_WANTED[k] + 1}].a}}") for k in range(4)
)
_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# crc32 bit by bit; the cost to go from the last row back, with the letters of the least path; then the rows replayed.
CONVERSATIONS = rf"""
WITH RECURSIVE named AS (
  SELECT dense_rank() OVER (ORDER BY conv_id) AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations
), hashed AS (
  SELECT *, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
           list_transform(range(1, length(key) + 1), lambda i: unicode(substr(key, i, 1))::BIGINT)),
           lambda h, b: list_reduce(list_concat([xor(h, b)], range(8)),
             lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 20 AS f
  FROM named
), rows AS (
  SELECT c, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE f <> 0
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         rtrim(text, {_WHITE}) AS body, left(role, 1) AS initial
  FROM rows
), judged AS (
  SELECT *, CASE WHEN body = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY c ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM ordered
), totals AS (
  SELECT c, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) AS n,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
  FROM judged GROUP BY c
), togo AS (
  SELECT c, n AS i, [{{'c': 0, 'a': ''}}, {{'c': 10, 'a': 'II'}}, {{'c': 5, 'a': 'I'}}, {{'c': 0, 'a': ''}}] AS v FROM totals
  UNION ALL
  SELECT c, i - 1, [{_INSERTED}] FROM (
    SELECT c, i, [{_INSERTED}] AS v FROM (SELECT g.c, g.i, [{_EDITED}] AS v FROM togo g JOIN judged j ON j.c = g.c AND j.i = g.i))
), audits AS (
  SELECT c, v[1].c AS cost, v[1].a AS audit FROM togo WHERE i = 0
), replayed AS (
  -- spot: letters read; i: rows read; s: the last initial; t: the repaired text.
  SELECT c, audit, 0 AS spot, 0::BIGINT AS i, '' AS s, NULL::VARCHAR AS t FROM audits
  UNION ALL
  SELECT r.c, r.audit, r.spot + 1, r.i + (l <> 'I')::INT, CASE WHEN l = 'D' THEN r.s ELSE left(role, 1) END,
         CASE WHEN l = 'D' THEN r.t ELSE coalesce(r.t || chr(10), '') || role || ':' || (CASE WHEN l = 'I' THEN '' ELSE text END) END
  FROM (
    SELECT r.*, substr(r.audit, r.spot + 1, 1) AS l, j.text,
           CASE WHEN substr(r.audit, r.spot + 1, 1) IN ('K', 'D') THEN j.role WHEN r.s = 'u' THEN 'assistant' ELSE 'user' END AS role
    FROM replayed r LEFT JOIN judged j ON j.c = r.c AND j.i = r.i + 1 WHERE r.spot < length(r.audit)
  ) r
), texts AS (
  SELECT c, t FROM replayed WHERE spot = length(audit)
)
SELECT d.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM named) d LEFT JOIN totals USING (c) LEFT JOIN audits USING (c) LEFT JOIN texts USING (c)
"""


def _vector_codes(parts: int = 4, size: int = 256, rounds: int = 4) -> str:
    """Rounds of assignment and floored means, unrolled. Sums stay exact in doubles on the shared tables."""
    steps = [f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT row, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x FROM kept, (SELECT unnest(range({parts})) AS p)
), squares AS (
  SELECT *, list_inner_product(x, x) AS xx FROM parts
), book0 AS (
  SELECT p, row - 1 AS e, x AS y FROM parts WHERE row <= {size}
)"""]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS (
  SELECT row, p, x, min({{'d': xx - 2 * list_inner_product(x, y) + list_inner_product(y, y), 'e': e}}) AS best
  FROM squares JOIN book{k} USING (p) GROUP BY row, p, x
)""")
        if k < rounds:
            steps.append(f"""means{k} AS (
  SELECT p, e, list(floor(total / n) ORDER BY pos) AS y
  FROM (SELECT p, best.e AS e, pos, sum(x[pos]) AS total, count(*) AS n
        FROM near{k}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS pos) GROUP BY ALL)
  GROUP BY p, e
), book{k + 1} AS (
  SELECT p, e, coalesce(m.y, b.y) AS y FROM book{k} b LEFT JOIN means{k} m USING (p, e)
)""")
    return ", ".join(steps) + f""", codes AS (
  SELECT row, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY row
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(y, lambda t: t::BIGINT), ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM codes JOIN kept USING (row)
"""


VECTOR_CODES = _vector_codes()
