"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

#: Unsigned CRC-32 (reflected, polynomial 0xEDB88320) of the decimal doc_id.
_CRC32 = """xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: unicode(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda v, step: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295)"""


def _leaf(n_chars: str) -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(concat(" + ", ".join(
        f"coalesce(strlen(({f})::VARCHAR)::VARCHAR || ':' || ({f})::VARCHAR, '-')" for f in fields) + "))"


#: Subtrees by language, then the tree over their roots; every level pairs the
#: nodes of the one below.
MERKLE = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf('n_chars')} AS leaf,
           CASE WHEN {_CRC32} % 7 = 0 THEN {_leaf('n_chars + 1')} END AS changed
    FROM documents),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
nodes AS (
    SELECT tree, 0 AS level, place, leaf AS node, count(*) OVER (PARTITION BY tree) AS width FROM placed
    UNION ALL
    SELECT tree, level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)),
           any_value((width + 1) // 2) FROM nodes WHERE width > 1 GROUP BY tree, level, place // 2),
subroots AS (
    SELECT tree, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM nodes WHERE width = 1),
tops AS (
    SELECT 0 AS level, place, subroot AS node, (SELECT count(*) FROM subroots) AS width FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), any_value((width + 1) // 2)
    FROM tops WHERE width > 1 GROUP BY level, place // 2),
folds AS (
    SELECT tree, place AS leaf_place, 0 AS level, place, coalesce(changed, leaf) AS node, '' AS proof FROM placed
    UNION ALL
    SELECT f.tree, f.leaf_place, f.level + 1, f.place // 2,
           sha256(CASE WHEN s.node IS NULL THEN f.node WHEN f.place % 2 = 0 THEN f.node || s.node ELSE s.node || f.node END),
           f.proof || coalesce(s.node, '')
    FROM folds f JOIN nodes n ON n.tree = f.tree AND n.level = f.level AND n.place = f.place AND n.width > 1
    LEFT JOIN nodes s ON s.tree = f.tree AND s.level = f.level AND s.place = xor(f.place, 1)),
sub_folds AS (
    SELECT f.* FROM folds f JOIN nodes n ON n.tree = f.tree AND n.level = f.level AND n.place = f.place AND n.width = 1),
top_folds AS (
    SELECT f.tree, f.leaf_place, 0 AS level, s.place, f.node, f.proof FROM sub_folds f JOIN subroots s ON s.tree = f.tree
    UNION ALL
    SELECT f.tree, f.leaf_place, f.level + 1, f.place // 2,
           sha256(CASE WHEN s.node IS NULL THEN f.node WHEN f.place % 2 = 0 THEN f.node || s.node ELSE s.node || f.node END),
           f.proof || coalesce(s.node, '')
    FROM top_folds f JOIN tops n ON n.level = f.level AND n.place = f.place AND n.width > 1
    LEFT JOIN tops s ON s.level = f.level AND s.place = xor(f.place, 1)),
ends AS (
    SELECT f.tree, f.leaf_place, f.node, f.proof, n.node AS root
    FROM top_folds f JOIN tops t ON t.level = f.level AND t.place = f.place AND t.width = 1
    CROSS JOIN (SELECT node FROM tops WHERE width = 1) n)
SELECT p.doc_id, p.leaf, s.subroot, e.root, sha256(e.proof) AS proof_sha256, e.node AS folded_root,
       e.node = e.root AS verified
FROM placed p JOIN subroots s USING (tree) JOIN ends e ON e.tree = p.tree AND e.leaf_place = p.place
"""

#: Windows of 13 words; ``longest`` tries the lengths 13, 26, ... in turn.
WINDOWS = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
    SELECT doc_id, unnest(range(1, len(words) - 11)) AS place, 13 AS length,
           unnest(list_transform(range(1, len(words) - 11), lambda i: sha256(array_to_string(words[i:i + 12], ' ')))) AS w
    FROM texts),
shared AS (SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w HAVING min(doc_id) <> max(doc_id)),
lost AS (
    SELECT DISTINCT doc_id, unnest(range(place, place + 13)) AS place
    FROM windows JOIN shared USING (w) WHERE first_id < doc_id),
numbered AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS place, unnest(words) AS word FROM texts),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
    FROM numbered ANTI JOIN lost USING (doc_id, place) GROUP BY doc_id),
longer AS (
    SELECT doc_id, place, length, w FROM (SELECT * FROM windows JOIN shared USING (w))
    UNION ALL
    SELECT doc_id, place, length, w FROM (
        SELECT a.doc_id, a.place, 2 * a.length AS length, sha256(a.w || b.w) AS w,
               min(a.doc_id) OVER (PARTITION BY a.w, b.w) AS low, max(a.doc_id) OVER (PARTITION BY a.w, b.w) AS high
        FROM longer a JOIN longer b ON b.doc_id = a.doc_id AND b.length = a.length AND b.place = a.place + a.length)
    WHERE low <> high),
longest AS (SELECT doc_id, max(length) AS longest FROM longer GROUP BY doc_id)
SELECT t.doc_id, len(t.words)::BIGINT AS n_words, (len(t.words) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256, coalesce(l.longest, 0)::BIGINT AS longest
FROM texts t LEFT JOIN kept k USING (doc_id) LEFT JOIN longest l USING (doc_id)
"""

#: Base32 of the SHA-1: five hexadecimal digits are four letters.
ARCHIVE = """
WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages),
fives AS (
    SELECT *, list_transform(range(8), lambda k: list_reduce(
        list_concat([0::BIGINT], list_transform(string_split(substr(digest, 5 * k + 1, 5), ''),
                                                lambda c: strpos('0123456789abcdef', c)::BIGINT - 1)),
        lambda v, d: 16 * v + d)) AS parts FROM hashed),
first AS (SELECT digest, min(page_id) AS first_id FROM hashed GROUP BY digest)
SELECT f.page_id, strlen(f.payload)::BIGINT AS payload_bytes,
       array_to_string(list_transform(f.parts, lambda v: array_to_string(list_transform([15, 10, 5, 0],
           lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((v >> s) & 31) + 1)::INT, 1)), '')), '') AS payload_digest,
       CASE WHEN f.page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.page_id <> first_id THEN first_id END AS refers_to
FROM fives f JOIN first USING (digest)
"""

#: All pairs that share a shingle, then everything that links reach.
LINKED = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
            ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS s
        FROM texts)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reached AS (
    SELECT doc_id, doc_id AS other FROM texts
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT t.doc_id, coalesce(any_value(z.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM texts t JOIN reached r USING (doc_id) LEFT JOIN sizes z USING (doc_id) GROUP BY t.doc_id
"""

SQL: dict[str, str] = {"op5_warc_dictionary": ARCHIVE, "op10_signature_trees": LINKED,
                       "op12_merkle_versions": MERKLE, "op13_window_doubling": WINDOWS}
