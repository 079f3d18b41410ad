"""DuckDB SQL of the text queries that SQL can express, written from the definitions."""

from __future__ import annotations

WORDS = r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {WORDS.format("text")} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[p : p + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS p FROM items WHERE len(w) > 0)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, {WORDS.format("text")} AS w FROM documents
), places AS (
  SELECT r, n, p, array_to_string(w[p : p + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS (
  SELECT r, places.n, p, item FROM places JOIN windows ON places.win = windows.win AND places.n = windows.n
), hit AS (
  SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS k FROM found) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
  count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

# A run of three lines that stands earlier too is deleted, whichever its length.
LINE_DEDUP = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(text, chr(10)) AS l FROM documents
), places AS (
  SELECT r, doc_id, p, l[p], l[p + 1], l[p + 2], row_number() OVER (PARTITION BY l[p], l[p + 1], l[p + 2] ORDER BY doc_id NULLS LAST, r, p) AS nth
  FROM (SELECT r, doc_id, l, unnest(range(1, len(l) - 1)) AS p FROM docs WHERE len(l) >= 3)
), gone AS (
  SELECT DISTINCT r, unnest([p - 1, p, p + 1]) AS k FROM places WHERE nth > 1
), per AS (
  SELECT r, count(*) AS n, string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) AS ks FROM gone GROUP BY r
)
SELECT doc_id, coalesce(len(l), 0) AS n_lines, coalesce(n, 0) AS n_deleted, coalesce(ks, '') AS deleted_lines
FROM docs LEFT JOIN per USING (r)
"""

# As above; shorter runs too if they have twenty words.
UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
LINE_DEDUP_WORDS = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(text, chr(10)) AS l FROM documents
), runs AS (
  SELECT r, doc_id, p, n, l[p : p + n - 1] AS run
  FROM (SELECT r, doc_id, l, n, unnest(range(1, len(l) - n + 2)) AS p FROM docs, (SELECT unnest([1, 2, 3]) AS n) WHERE len(l) >= n)
), places AS (
  SELECT r, p, n, run, row_number() OVER (PARTITION BY run ORDER BY doc_id NULLS LAST, r, p) AS nth FROM runs
), gone AS (
  SELECT DISTINCT r, unnest(range(p - 1, p + n - 1)) AS k FROM places
  WHERE nth > 1 AND (n = 3 OR len(regexp_extract_all(array_to_string(run, chr(10)), '[{UNSPACED}]{{1,2}}|[^\x09-\x0D\x20{UNSPACED}]{{1,16}}')) >= 20)
), per AS (
  SELECT r, count(*) AS n, string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) AS ks FROM gone GROUP BY r
)
SELECT doc_id, coalesce(len(l), 0) AS n_lines, coalesce(n, 0) AS n_deleted, coalesce(ks, '') AS deleted_lines
FROM docs LEFT JOIN per USING (r)
"""


# Unsigned CRC-32, byte by byte: reflected polynomial 0xEDB88320.
CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
)"""
CRC = """xor(list_reduce(list_transform(range(length({0}) // 2), lambda p: CAST('0x' || substr({0}, 2 * p + 1, 2) AS BIGINT)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"""

ENCODED = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(ENCODED.format(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _levels(name: str, tree: str, start: str) -> str:
    """All rows climb together, with the node above each, the proof so far and the fold so far, until a tree has one node."""
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT r, {tree}, q // 2, (n + 1) // 2, sha256(l || coalesce(g, '')),
    CASE WHEN q % 2 = 0 THEN sha256(fold || coalesce(g, '')) ELSE sha256(l || fold) END, proof || CASE WHEN q % 2 = 0 THEN coalesce(g, '') ELSE l END
  FROM (SELECT *, max(CASE WHEN q % 2 = 0 THEN h END) OVER w AS l, max(CASE WHEN q % 2 = 1 THEN h END) OVER w AS g
    FROM {name} WHERE n > 1 WINDOW w AS (PARTITION BY {tree}, q // 2))
)"""


LANG_LEAVES = """SELECT r, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS q,
    count(*) OVER (PARTITION BY lang) AS n, leaf AS h, checked AS fold, '' AS proof FROM leaves"""
SUBROOTS = """SELECT r, 0 AS one, langs.q, langs.n, h, fold, proof FROM lower_tree JOIN langs ON langs.lang IS NOT DISTINCT FROM lower_tree.lang
    WHERE lower_tree.n = 1"""
MERKLE = f"""
WITH RECURSIVE {CRC_TABLE}, hexed AS (
  SELECT *, hex(encode(CAST(doc_id AS VARCHAR))) AS hx FROM documents
), leaves AS (
  SELECT row_number() OVER () AS r, doc_id, lang, {_leaf("n_chars")} AS leaf,
    CASE WHEN {CRC.format("hx")} % 7 = 0 THEN {_leaf("(CAST(n_chars AS HUGEINT) + 1)")} ELSE {_leaf("n_chars")} END AS checked
  FROM hexed, crc
), {_levels("lower_tree", "lang", LANG_LEAVES)}, langs AS (
  SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS q, count(*) OVER () AS n FROM (SELECT DISTINCT lang FROM leaves)
), {_levels("upper_tree", "one", SUBROOTS)}
SELECT doc_id, leaf, s.h AS subroot, u.h AS root, sha256(u.proof) AS proof_sha256, u.fold AS folded_root, u.fold = u.h AS verified
FROM leaves JOIN lower_tree s ON s.r = leaves.r AND s.n = 1 JOIN upper_tree u ON u.r = leaves.r AND u.n = 1
"""


IMPORTANCE = f"""
WITH {CRC_TABLE}, docs AS (
  SELECT row_number() OVER () AS r, doc_id, {WORDS.format("text")} AS w FROM documents
), raw AS (
  SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM docs) GROUP BY word
), target AS (
  SELECT word, count(*) AS n FROM (SELECT unnest({WORDS.format("text")}) AS word FROM benchmark) GROUP BY word
), hashed AS (
  SELECT word, {CRC.format("hx")} % 10000 AS bucket
  FROM (SELECT word, hex(encode(word)) AS hx FROM (SELECT word FROM raw UNION SELECT word FROM target)), crc
), counts AS (
  SELECT bucket, coalesce(sum(raw.n), 0) AS s, coalesce(sum(target.n), 0) AS t
  FROM hashed LEFT JOIN raw USING (word) LEFT JOIN target USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * ((SELECT sum(s) FROM counts) + 10000.0::DOUBLE)
    / ((s + 1.0::DOUBLE) * ((SELECT sum(t) FROM counts) + 10000.0::DOUBLE)))) AS BIGINT) AS gain FROM counts
), weights AS (
  SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM (SELECT r, unnest(w) AS word FROM docs) JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r
), scored AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (r)
), ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, r) AS rank, 10 * count(*) OVER () // 100 AS drawn FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= drawn THEN rank END AS rank FROM scored LEFT JOIN ranked USING (r)
"""


VECTORS = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
), usable AS (
  SELECT * FROM v WHERE len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0
), links AS (
  SELECT a.r AS a, b.r AS b FROM usable a JOIN usable b ON a.r <> b.r AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95
), reached AS (
  SELECT r AS a, r AS b FROM v
  UNION
  SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), least AS (
  SELECT reached.a AS r, min(v.vec_id) AS component_id FROM reached JOIN v ON v.r = reached.b GROUP BY reached.a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = v.r) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN least USING (r)
"""


def build() -> dict[str, str]:
    return {
        "op1_decontamination": DECONTAMINATION,
        "op2_exact_dedup": EXACT_DEDUP,
        "op3_line_dedup": LINE_DEDUP,
        "op3_line_dedup_words": LINE_DEDUP_WORDS,
        "op11_embedding_dedup": VECTORS,
        "op12_importance_resampling": IMPORTANCE,
        "op13_merkle_manifest": MERKLE,
    }
