"""DuckDB SQL for the registered queries that SQL can express; it shares no code with the operators."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

#: Slots and shards of the registered sharding query.
SLOTS, SHARDS = 16381, 64


def _filled(shards: int) -> str:
    """The table of the turn-taking rule, as a SQL list: a list of preferences per shard, walked with iterators."""

    def number(text: str) -> int:
        return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)

    def preferences(name: str) -> Iterator[int]:
        first, step = number(f"offset {name}"), number(f"step {name}") % (SLOTS - 1) + 1
        return ((first + turn * step) % SLOTS for turn in itertools.count())

    wishes = [preferences(f"shard-{k}") for k in range(shards)]
    owner: dict[int, int] = {}
    for k in itertools.cycle(range(shards)):
        if len(owner) == SLOTS:
            break
        owner[next(slot for slot in wishes[k] if slot not in owner)] = k
    return "[" + ",".join(str(owner[slot]) for slot in range(SLOTS)) + "]"


_OP9 = f"""
WITH placed AS (
  SELECT doc_id, CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15)) AS BIGINT) % {SLOTS} AS slot FROM documents
), tables AS (
  SELECT {_filled(SHARDS)} AS now, {_filled(SHARDS + 1)} AS grown
)
SELECT doc_id, CAST(slot AS INTEGER) AS slot, CAST(now[slot + 1] AS INTEGER) AS shard, CAST(grown[slot + 1] AS INTEGER) AS grown_shard
FROM placed, tables
"""

_OP11 = """
WITH rows AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) AS place FROM rows
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, place = 1 AS kept, sha256(body) AS text_sha256
FROM numbered WINDOW same AS (PARTITION BY body)
"""

_OP12 = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM sound a JOIN sound r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), windows AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM windows WHERE place <= 3
"""


def _part(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR) END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_part(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(leaves: str) -> str:
    """All nodes (grp, level, pos, h) over leaves (grp, pos, h); a level is made while a group has several nodes."""
    return f"""
  SELECT grp, 0 AS level, pos, h FROM {leaves}
  UNION ALL
  SELECT grp, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {{name}}) WHERE n > 1 GROUP BY grp, level, pos // 3"""


_SIDES = """
  SELECT grp, level, pos,
         coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM (SELECT *, max(level) OVER (PARTITION BY grp) AS top FROM {name}) WHERE level < top
  WINDOW run AS (PARTITION BY grp, level, pos // 3 ORDER BY pos)"""

_OP13 = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 1, 2, 3, 4, 5, 6, 7, 8],
         lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab
), rows AS (
  SELECT doc_id, coalesce('=' || source, '') AS grp, {_leaf("text")} AS leaf,
         xor(list_reduce([4294967295] || list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: ascii(substr(CAST(doc_id AS VARCHAR), i, 1))),
         lambda c, b: xor(c >> 8, crc.tab[(xor(c, b) & 255) + 1])), 4294967295) AS mark,
         {_leaf("replace(text, chr(10), '')")} AS bare
  FROM documents, crc
), leaves AS (
  SELECT doc_id, grp, leaf AS h, CASE WHEN mark % 2 = 0 THEN bare ELSE leaf END AS changed,
         row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM rows
), tree AS ({_tree("leaves").format(name="tree")}
), subroots AS (
  SELECT name, h AS subroot, 0 AS grp, h, row_number() OVER (ORDER BY name) - 1 AS pos
  FROM (SELECT grp AS name, h FROM tree QUALIFY level = max(level) OVER (PARTITION BY grp))
), over AS ({_tree("subroots").format(name="over")}
), root AS (
  SELECT h AS root FROM over QUALIFY level = max(level) OVER ()
), low AS ({_SIDES.format(name="tree")}
), high AS ({_SIDES.format(name="over")}
), steps AS (
  SELECT leaves.doc_id, leaves.grp, leaves.pos, low.level AS step, l, r
  FROM leaves JOIN low ON low.grp = leaves.grp AND low.pos = leaves.pos // CAST(pow(3, low.level) AS BIGINT)
  UNION ALL
  SELECT leaves.doc_id, leaves.grp, leaves.pos, 100 + high.level, l, r
  FROM leaves JOIN subroots ON subroots.name = leaves.grp JOIN high ON high.pos = subroots.pos // CAST(pow(3, high.level) AS BIGINT)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY grp, pos ORDER BY step) AS turn FROM steps
), fold AS (
  SELECT grp, pos, 0 AS turn, changed AS h FROM leaves
  UNION ALL
  SELECT fold.grp, fold.pos, fold.turn + 1, sha256(n.l || fold.h || n.r)
  FROM fold JOIN numbered n ON n.grp = fold.grp AND n.pos = fold.pos AND n.turn = fold.turn + 1
), folded AS (
  SELECT grp, pos, h FROM fold QUALIFY turn = max(turn) OVER (PARTITION BY grp, pos)
), proofs AS (
  SELECT grp, pos, string_agg(l || r, '' ORDER BY step) AS proof FROM steps GROUP BY grp, pos
)
SELECT leaves.doc_id, leaves.h AS leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded.h AS folded_root, folded.h = root AS verified
FROM leaves JOIN subroots ON subroots.name = leaves.grp CROSS JOIN root
JOIN folded ON folded.grp = leaves.grp AND folded.pos = leaves.pos
LEFT JOIN proofs ON proofs.grp = leaves.grp AND proofs.pos = leaves.pos
"""

ORACLES = {"op9_sharding": _OP9, "op11_owners": _OP11, "op12_hard_negatives": _OP12, "op13_merkle": _OP13}
