"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

_SPACES = r"[\x20\x09-\x0D]+"

OP6 = rf"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACES}', ' ', 'g') AS t FROM documents),
     g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""

_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
          r" 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP5 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
     win AS (
       SELECT DISTINCT item_id, array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS p, least(len(w), 10) AS size
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
     sizes AS (SELECT DISTINCT size FROM win),
     pos AS (
       SELECT doc_id, size, s, array_to_string(list_slice(w, s, s + size - 1), ' ') AS p
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)),
     m AS (SELECT pos.doc_id, pos.s, pos.size, win.item_id FROM pos JOIN win ON pos.p = win.p AND pos.size = win.size),
     hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit
             FROM (SELECT doc_id, unnest(range(s, s + size)) AS place FROM m) GROUP BY doc_id),
     it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
            FROM m GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""



# Water-filling in closed form: sources by cap over weight; the first one that is not above its cap sets the level.
OP11 = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
     s AS (SELECT source, sum(size)::BIGINT AS n, ([3, 1, 2])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS w
           FROM d GROUP BY source),
     r AS (SELECT *, row_number() OVER (ORDER BY 2 * n / w, source NULLS LAST) AS k, sum(n) OVER () AS total FROM s),
     c AS (SELECT *, (3 * total - 2 * coalesce(sum(2 * n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS num,
                  (2 * sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS den FROM r),
     l AS (SELECT num / den AS level, k AS first_open FROM c WHERE num * w <= 2 * n * den ORDER BY k LIMIT 1),
     t AS (SELECT source, n AS source_size, CASE WHEN k < coalesce(first_open, k + 1) THEN (2 * n)::DOUBLE ELSE level * w::DOUBLE END AS target
           FROM c LEFT JOIN l ON true),
     u AS (SELECT *, floor(target + 0.5)::BIGINT AS goal,
                  CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS whole FROM t),
     o AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(concat('mix:', coalesce(doc_id::VARCHAR, 'null'), ':', size)), doc_id, size
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
     x AS (SELECT doc_id, size, source_size, target, whole,
                  greatest(0, least(size, goal - whole * source_size - before))::BIGINT AS extra
           FROM o JOIN u ON o.source IS NOT DISTINCT FROM u.source)
SELECT doc_id, size, source_size, target, (whole * size + extra)::BIGINT AS taken,
       (whole + CASE WHEN extra = size AND size > 0 THEN 1 ELSE 0 END)::BIGINT AS n_whole,
       CASE WHEN extra = size AND size > 0 THEN 0 ELSE extra END::BIGINT AS n_part
FROM x
"""


def _then(best: str, cost: str, letter: str) -> str:
    """A search state, nine digits of cost and the audit so far, after one more edit."""
    return f"(lpad((substr({best}, 1, 9)::INT + {cost})::VARCHAR, 9, '0') || substr({best}, 10) || '{letter}')"


def _if(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


def _enter(place: int, sources: tuple[str, ...], initial: str) -> str:
    """Least state in ``place`` after one row: deleted, kept or reroled."""
    options = [_then(f"b{place}", "3", "D")]
    for b in sources:
        options.append(_if(f"alive AND c = '{initial}'", _then(b, "cut", "K")))
        if initial != "s":
            options.append(_if("alive", _then(b, "2 + cut", "R")))
    return f"least({', '.join(options)}, NULL)"


# A left-to-right search over the places of the pattern, one row of each conversation at a time.
OP12 = rf"""
WITH RECURSIVE
tab AS (SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x:
               CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
        FROM (SELECT unnest(range(256)) AS i)),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS name FROM conversations),
fated AS (SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
                   list_prepend(4294967295, list_transform(range(1, len(name) + 1), lambda i: ord(substr(name, i, 1))::BIGINT)),
                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS fate
          FROM named, tab),
turns AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
                 CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                 unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
          FROM fated),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                  substr(role, 1, 1) AS c FROM turns),
judged AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
                  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                  NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS short,
                  lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c NOT IN ('su', 'ua', 'au') AS bad FROM placed),
items AS (SELECT conv_id, i, c, role, text, NOT (blank OR again) AS alive,
                 CASE WHEN NOT blank AND NOT again AND short THEN 1 ELSE 0 END AS cut FROM judged),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
                  count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
                  count(*) FILTER (short AND NOT again AND NOT blank) AS truncated,
                  count(*) FILTER (bad) AS illegal, count(*) AS n FROM judged GROUP BY conv_id),
search(conv_id, i, b0, b1, b2, b3) AS (
  SELECT conv_id, 0::BIGINT, '000000000', NULL::VARCHAR, '000000002I', '000000004II' FROM counts
  UNION ALL
  SELECT conv_id, i, n0, n1, least(n2, {_then("n0", "2", "I")}, {_then("n1", "2", "I")}, {_then("n3", "2", "I")}),
         least(n3, {_then("n2", "2", "I")}, {_then("n0", "4", "II")}, {_then("n1", "4", "II")})
  FROM (SELECT s.conv_id, r.i, {_enter(0, (), "")} AS n0, {_enter(1, ("b0",), "s")} AS n1,
               {_enter(2, ("b0", "b1", "b3"), "u")} AS n2, {_enter(3, ("b2",), "a")} AS n3
        FROM search s JOIN items r ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = s.i + 1)),
ended AS (SELECT s.conv_id, substr(least(b0, b3), 1, 9)::BIGINT AS cost, substr(least(b0, b3), 10) AS audit
          FROM search s JOIN counts k ON s.conv_id IS NOT DISTINCT FROM k.conv_id AND s.i = k.n),
letters AS (SELECT conv_id, k, substr(audit, k, 1) AS letter, len(replace(substr(audit, 1, k), 'I', '')) AS row,
                   len(replace(substr(audit, 1, k), 'D', '')) - 1 - len(replace(audit, 'D', '')) % 2 AS made
            FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS k FROM ended)),
lines AS (SELECT l.conv_id, string_agg(concat(CASE WHEN letter = 'K' THEN r.role WHEN made % 2 = 0 THEN 'user' ELSE 'assistant' END, ':',
                                              CASE WHEN letter = 'I' THEN '' ELSE r.text END), chr(10) ORDER BY k) AS body
          FROM letters l LEFT JOIN items r ON l.conv_id IS NOT DISTINCT FROM r.conv_id AND l.row = r.i AND letter <> 'I'
          WHERE letter <> 'D' GROUP BY l.conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN lines b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
"""

OP13 = """
WITH e AS (SELECT DISTINCT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
                  list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS z
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS id, b.label AS other,
                  list_dot_product(a.z, b.z)::BIGINT AS score
           FROM e a, e b WHERE a.vec_id % 100 = 0),
     p AS (SELECT anchor_id, own, id AS positive_id, score AS positive_score FROM s WHERE own = other AND id <> anchor_id
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE s.other <> p.own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def oracles() -> dict[str, str]:
    return {"op5_decontaminate": OP5, "op6_exact_recipes": OP6, "op11_mixing": OP11, "op12_repair": OP12,
            "op13_hard_negatives": OP13}
