"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from itertools import pairwise

from viewstar.llm import mixing, quality_rules as rules

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_STOP = ", ".join(f"'{w}'" for w in sorted(
    {w for words in rules.STOP_WORDS.values() for w in words.split()}))


def _verdict() -> str:
    parts = []
    for rule in rules.RULES:
        share = f"{rule.measure}::DOUBLE"
        if rule.per:
            share += f" / greatest({rule.per}, 1)::DOUBLE"
        if rule.lower is not None:
            parts.append(f"{share} >= {rule.lower}::DOUBLE")
        if rule.upper is not None:
            parts.append(f"{share} <= {rule.upper}::DOUBLE")
    return " AND ".join(parts)


QUALITY_RULES = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
                     {_WORDS} AS w FROM documents),
words AS (SELECT r, unnest(w) AS word FROM docs),
counted AS (SELECT r, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars,
                   count(*) FILTER (WHERE lower(word) IN ({_STOP})) AS n_stop_words
            FROM words GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
line_counts AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
                FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
windows AS (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM docs WHERE len(w) > 3),
repeats AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n
            FROM windows),
covered AS (SELECT r, count(DISTINCT p) AS n_repeat_words
            FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM repeats WHERE n > 1) GROUP BY r),
measured AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_stop_words, 0) AS n_stop_words, coalesce(n_lines, 0) AS n_lines
  FROM docs LEFT JOIN counted USING (r) LEFT JOIN line_counts USING (r)
            LEFT JOIN covered USING (r)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
          FROM measured)
SELECT *, NOT base_failed AND {_verdict()} AS kept FROM based
"""


def _position() -> str:
    """The inverse of the integrated schedules, as a CASE over place and piece."""
    branches = []
    for index, knots in enumerate(mixing.SCHEDULES):
        pieces = [(t0, m0, (m1 - m0) / (t1 - t0), (m0 + m1) / 2 * (t1 - t0))
                  for (t0, m0), (t1, m1) in pairwise(knots)]
        used = f"(share * {sum(p[3] for p in pieces)!r}::DOUBLE)"
        before, cases = 0.0, []
        for t0, m0, slope, area in pieces:
            rest = f"({used} - {before!r}::DOUBLE)"
            root = f"sqrt({m0 * m0!r}::DOUBLE + {2 * slope!r}::DOUBLE * {rest})"
            cases.append(f"WHEN {used} < {before + area!r}::DOUBLE THEN {t0!r}::DOUBLE + "
                         f"2.0::DOUBLE * {rest} / ({m0!r}::DOUBLE + {root})")
            before += area
        branches.append(f"WHEN place = {index} THEN CASE {' '.join(cases)} "
                        f"ELSE {knots[-1][0]!r}::DOUBLE END")
    return f"CASE {' '.join(branches)} END"


SOURCE_MIX = f"""
WITH docs AS (SELECT doc_id, source, len({_WORDS}) AS size,
                     md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS place
           FROM sizes),
weighed AS (SELECT *, (place + 1)::DOUBLE AS weight, 3.0::DOUBLE * source_size AS lim
            FROM ranked),
rates AS (SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(lim) OVER (
             ORDER BY lim / weight, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) / sum(weight) OVER (
             ORDER BY lim / weight, source NULLS LAST
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM weighed),
targets AS (SELECT *, CASE WHEN lim / weight < rate THEN lim ELSE weight * (
             SELECT rate FROM rates WHERE NOT (lim / weight < rate)
             ORDER BY lim / weight, rate LIMIT 1) END AS target FROM rates),
placed AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.place,
             floor(t.target + 0.5)::BIGINT AS demand,
             (coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS off
           FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
passed AS (SELECT *, CASE WHEN source_size > 0 THEN demand // source_size ELSE 0 END AS passes,
             off::DOUBLE / nullif(demand, 0)::DOUBLE AS share FROM placed),
took AS (SELECT *, (passes * size + greatest(0, least(
             demand - passes * source_size - off, size)))::BIGINT AS taken FROM passed)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN {_position()} END AS position FROM took
"""


# CRC-32 of the decimal id, byte by byte and bit by bit.
_CRC = """xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''),
                                                     lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(
        [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda bits, step: CASE WHEN bits & 1 = 1 THEN xor(bits >> 1, 3988292384::BIGINT)
                                ELSE bits >> 1 END)))"""

PREFIX_TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, {_CRC} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (
  SELECT i.conv_id, t.pos AS d, role, text
  FROM ids i JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 5 AND t.pos <= i.h),
taken AS (SELECT conv_id, count(*) AS n FROM heads GROUP BY conv_id),
rebuilt AS (
  SELECT * FROM heads
  UNION ALL
  SELECT i.conv_id, coalesce(k.n, 0) + t.pos - i.h, role, text
  FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.pos > i.h
  LEFT JOIN taken k ON k.conv_id = i.conv_id),
members AS (
  SELECT conv_id, d, strlen(text) AS bytes,
         list(struct_pack(r := role, t := text)) OVER (PARTITION BY conv_id ORDER BY d) AS path
  FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, [] FROM ids),
lengths AS (SELECT conv_id, max(d) AS n FROM members GROUP BY conv_id),
nodes AS (
  SELECT path, d, min(m.conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
         coalesce(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id)
                  FILTER (WHERE n = d), '') AS ends
  FROM members m JOIN lengths USING (conv_id) GROUP BY path, d),
named AS (
  SELECT m.conv_id AS member, m.d, n.conv_id
  FROM members m JOIN nodes n ON n.path = m.path AND n.d = m.d),
linked AS (
  SELECT n.conv_id, n.d, n.n_convs, n.bytes, n.ends, p.conv_id AS parent
  FROM nodes n LEFT JOIN named p ON p.member = n.conv_id AND p.d = n.d - 1),
children AS (SELECT parent, d - 1 AS d, count(*) AS n FROM linked GROUP BY ALL),
counted AS (
  SELECT l.*, coalesce(c.n, 0) AS n_children
  FROM linked l LEFT JOIN children c ON c.parent = l.conv_id AND c.d = l.d),
below AS (
  SELECT a.conv_id, a.d, sum((c.n_convs - 1) * c.bytes) AS saved,
         count(*) FILTER (WHERE c.n_children = 0) AS n_leaves
  FROM counted c JOIN named a ON a.member = c.conv_id AND a.d <= c.d
  GROUP BY a.conv_id, a.d)
SELECT c.conv_id::BIGINT AS conv_id, c.d::BIGINT AS depth, c.parent::BIGINT AS parent_conv_id,
       c.n_convs::BIGINT AS n_convs, c.n_children::BIGINT AS n_children,
       b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens,
       sha256(c.ends) AS ends_sha256
FROM counted c JOIN below b USING (conv_id, d)
"""
