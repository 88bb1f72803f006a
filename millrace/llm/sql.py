"""The SQL that queries of this package must agree with, where SQL can express them."""

from __future__ import annotations

from millrace.llm.common import SPACE  # noqa: F401  the same blanks as in Spark
from millrace.llm.mix import GOLDEN
from millrace.llm.shard import BASE, DIGITS, Tree, tree

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = rf"""
WITH item AS (
  SELECT item_id, regexp_extract_all({FOLDED}, '{WORD}') AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, len(list_slice(w, i, i + 9)) AS width, array_to_string(list_slice(w, i, i + 9), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, regexp_extract_all({FOLDED}, '{WORD}') AS w FROM documents),
place AS (
  SELECT doc_id, width, i, array_to_string(list_slice(w, i, i + width - 1), ' ') AS win
  FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i
        FROM doc, (SELECT DISTINCT width FROM win))),
hit AS (SELECT doc_id, i, place.width, item_id FROM place JOIN win USING (win)),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM hit) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN named USING (doc_id)
"""

NGRAM_JOIN = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all({FOLDED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM shingle x JOIN shingle y USING (s)
                    WHERE x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 100 * o >= 75 * (na.n + nb.n - o)),
reach AS (SELECT a AS doc_id, a AS other FROM link UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other)
SELECT doc.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.least, doc.doc_id) AS component_id
FROM doc LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id) c USING (doc_id)
"""

MIX = rf"""
WITH row AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS mark FROM documents),
numbered AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0::DOUBLE, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         (2 * sum(size))::DOUBLE AS room,
         row_number() OVER (ORDER BY source NULLS LAST) AS no
  FROM row GROUP BY source),
level AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE - coalesce(sum(room) OVER (
              ORDER BY room / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY room / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM numbered),
target AS (
  SELECT source, no, source_size, least(weight * (
    SELECT level FROM level WHERE level * weight <= room ORDER BY room / weight, no LIMIT 1), room) AS target FROM level),
placed AS (
  SELECT row.*, no, row_number() OVER () AS r, source_size, target, floor(target)::BIGINT // greatest(source_size, 1) AS rounds,
         floor(target)::BIGINT % greatest(source_size, 1) AS rest,
         sum(size) OVER (PARTITION BY row.source ORDER BY mark, doc_id NULLS FIRST, size
                         ROWS UNBOUNDED PRECEDING) - size AS start
  FROM row JOIN target ON row.source IS NOT DISTINCT FROM target.source),
need AS (
  SELECT no, source_size, floor(target)::BIGINT AS words, (source_size + 1023) // 1024 AS blocks,
         CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size * ((source_size + 1023) // 1024)
                                        + (floor(target)::BIGINT % source_size + 1023) // 1024 ELSE 0 END AS slots FROM target),
total AS (SELECT sum(slots)::BIGINT AS total FROM need),
share AS (SELECT need.*, total, sum(slots) OVER (ORDER BY no)::DOUBLE / total::DOUBLE AS high FROM need, total WHERE slots > 0),
point AS (
  SELECT s, ((s // 1048576)::DOUBLE * {float(GOLDEN * (1 << 20) % 1)!r}::DOUBLE + (s % 1048576)::DOUBLE * {float(GOLDEN)!r}::DOUBLE + 0.5::DOUBLE) % 1.0::DOUBLE AS x
  FROM (SELECT unnest(range(total)) AS s FROM total)),
drawn AS (
  SELECT no, s AS slot, row_number() OVER (PARTITION BY no ORDER BY s) - 1 AS rank FROM point
  JOIN share ON x >= high - slots::DOUBLE / total::DOUBLE AND x < high),
slot AS (
  SELECT no, rank, slot FROM drawn JOIN need USING (no) WHERE rank < slots
  UNION ALL SELECT no, rank, rank + total FROM (
    SELECT no, unnest(range((SELECT count(*) FROM drawn WHERE drawn.no = need.no), slots)) AS rank FROM need), total),
part AS (
  SELECT no, slot, rank % blocks * 1024 AS low, rank % blocks * 1024 + least(1024, source_size - rank % blocks * 1024,
         words - (rank // blocks * source_size + rank % blocks * 1024)) AS high FROM slot JOIN need USING (no)),
early AS (SELECT r, min(slot) AS slot FROM placed JOIN part ON placed.no = part.no AND start < high AND start + size > low WHERE size > 0 GROUP BY r)
SELECT doc_id, size, source_size, target,
       (rounds * size + greatest(0, least(start + size, rest) - start))::BIGINT AS taken, slot::BIGINT AS slot
FROM placed LEFT JOIN early USING (r)
"""


def _draw(name: str, weight: int) -> str:
    return (f"-ln((('0x' || substr(md5(key || '{name}'), 1, {DIGITS}))::BIGINT::DOUBLE + 0.5) / {float(16**DIGITS)!r}::DOUBLE)"
            f" / {float(weight)!r}::DOUBLE")


def _least(name: str, weights: list[int]) -> str:
    if len(weights) == 1:
        return "0"
    draws = ", ".join(_draw(f"{name}.{k}", w) for k, w in enumerate(weights))
    return f"(list_position([{draws}], list_min([{draws}])) - 1)"


def _descent(layout: Tree) -> str:
    """The shard of ``key``: region, rack in it, shard in that."""
    regions = "CASE " + _least("t", [sum(r) for r in layout])
    first = 0
    for i, racks in enumerate(layout):
        inner = f"CASE {_least(f't.{i}', racks)}"
        for j, n in enumerate(racks):
            inner += f" WHEN {j} THEN {first} + {_least(f't.{i}.{j}', [1] * n)}"
            first += n
        regions += f" WHEN {i} THEN {inner} END"
    return f"({regions} END)::INT"


SHARD = f"""
WITH bits AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS steps),
row AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS key, strlen(coalesce(text, ''))::BIGINT + 8 AS size,
         xor(list_reduce(list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda h: ('0x' || h)::BIGINT),
             lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295)::BIGINT AS text_crc32
  FROM documents, bits),
put AS (SELECT *, {_descent(tree(24, BASE))} AS shard, {_descent(tree(25, BASE))} AS grown_shard FROM row)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY substr(md5(key), 1, 3), doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       grown_shard
FROM put
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RANKED = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({FOLDED}, '{TERM}') AS t FROM documents),
held AS (SELECT r, doc_id, t, len(t)::BIGINT AS n FROM doc WHERE len(t) > 0),
facts AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM held),
posting AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM held) GROUP BY ALL),
frequency AS (SELECT term, count(*)::BIGINT AS df FROM posting GROUP BY term),
item AS (SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all({FOLDED}, '{TERM}')) AS t FROM benchmark),
scored AS (
  SELECT q, item_id, r, doc_id, sum(
           floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
           * ((1000000000 * tf)::BIGINT // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
  FROM (SELECT q, item_id, unnest(t) AS term FROM item) JOIN frequency USING (term) JOIN posting USING (term) JOIN held USING (r), facts
  GROUP BY q, item_id, r, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
