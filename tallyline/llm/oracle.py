"""Independent SQL for the queries that SQL can express: plain joins over whole tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return (f"list_filter(string_split_regex(translate({text}, '{_UPPER}', '{_LOWER}'), "
            r"'[\x20\x09-\x0D]+'), lambda w: w <> '')")


_NGRAM_JOIN = f"""
    WITH RECURSIVE split AS (SELECT doc_id, {_words("COALESCE(text, '')")} AS w FROM documents),
    sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM split),
    sized AS (SELECT doc_id, len(s) AS n FROM sets),
    shingle AS (SELECT doc_id, unnest(s) AS h FROM sets),
    both_have AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS k FROM shingle a JOIN shingle b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
    link AS (SELECT p.a, p.b FROM both_have p JOIN sized x ON x.doc_id = p.a JOIN sized y ON y.doc_id = p.b
             WHERE 100 * p.k >= 75 * (x.n + y.n - p.k)),
    edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a)
    SELECT s.doc_id, s.n AS n_shingles, MIN(r.b) AS component_id FROM sized s JOIN reach r ON r.a = s.doc_id GROUP BY ALL"""

_LINE_DEDUP = f"""
    WITH line AS (SELECT doc_id, i AS line_no, {_words("l")} AS w FROM (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents) x),
    filled AS (SELECT doc_id * 1000000 + line_no AS place, len(w) AS n, array_to_string(w, ' ') AS l, w FROM line WHERE len(w) > 0),
    variant AS (SELECT place, i, array_to_string(list_concat(w[:i - 1], w[i + 1:]), ' ') AS v FROM (
            SELECT place, w, unnest(range(1, n + 1)) AS i FROM filled WHERE n >= 8) y),
    gone AS (
        SELECT place FROM (SELECT place, MIN(place) OVER (PARTITION BY l) AS first FROM filled) a WHERE first < place
        UNION SELECT place FROM (SELECT place, MIN(place) OVER (PARTITION BY i, v) AS first FROM variant) b WHERE first < place
        UNION SELECT v.place FROM variant v JOIN (SELECT l, MIN(place) AS first FROM filled WHERE n >= 8 GROUP BY 1) f ON f.l = v.v WHERE f.first < v.place
        UNION SELECT f.place FROM filled f JOIN (SELECT v, MIN(place) AS first FROM variant GROUP BY 1) v ON f.l = v.v WHERE f.n >= 8 AND v.first < f.place)
    SELECT d.doc_id, CAST(COALESCE(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines, COUNT(g.place) AS n_repeated,
           COALESCE(string_agg(CAST(g.place % 1000000 AS VARCHAR), ',' ORDER BY g.place), '') AS repeated
    FROM documents d LEFT JOIN gone g ON g.place // 1000000 = d.doc_id GROUP BY ALL"""

_TOP_K = """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
               FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
    ranked AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""



def _clustering(k: int = 16, rounds: int = 3) -> str:
    square = "list_sum(list_transform(range(1, 65), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i])))"

    def nearest(name: str, centroids: str) -> str:
        return f"""
    {name} AS MATERIALIZED (SELECT place, vec_id, e, n, CAST(d AS BIGINT) AS d FROM (
        SELECT v.place, v.vec_id, v.e, c.n, {square} AS d, ROW_NUMBER() OVER (PARTITION BY v.place ORDER BY {square}, c.n) AS r
        FROM v, {centroids} c) x WHERE r = 1)"""

    parts = [f"""
    WITH v AS MATERIALIZED (SELECT ROW_NUMBER() OVER () AS place, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
        FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    c0 AS MATERIALIZED (SELECT CAST(ROW_NUMBER() OVER (ORDER BY h, e) - 1 AS INTEGER) AS n, e FROM (
        SELECT sha256('1:' || vec_id) AS h, e FROM v WHERE vec_id IS NOT NULL ORDER BY h, e LIMIT {k}) x)"""]
    for i in range(rounds):
        parts.append(nearest(f"a{i}", f"c{i}"))
        parts.append(f"""
    c{i + 1} AS MATERIALIZED (SELECT c.n, COALESCE(m.e, c.e) AS e FROM c{i} c LEFT JOIN (
        SELECT n, list(CAST(floor(s / k) AS BIGINT) ORDER BY i) AS e FROM (
            SELECT n, i, CAST(SUM(x) AS DOUBLE) AS s, COUNT(*) AS k FROM (SELECT n, unnest(e) AS x, unnest(range(64)) AS i FROM a{i}) y GROUP BY n, i) z
        GROUP BY n) m ON m.n = c.n)""")
    parts.append(nearest("last", f"c{rounds}"))
    return ",".join(parts) + f"""
    SELECT l.vec_id, l.n AS cluster, l.d AS distance, CAST(SUM(l.d) OVER (PARTITION BY l.n) AS BIGINT) AS cluster_inertia,
           CAST(SUM(l.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
    FROM last l JOIN c{rounds} c ON c.n = l.n"""


# Latin-1 letters as two UTF-8 bytes; CRC-32 by its table; near words by letters left out.
_SPELLING = f"""
    WITH RECURSIVE crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(
            range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS t),
    run AS (SELECT doc_id, w, COUNT(*) AS n FROM (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[A-Za-zÀ-ÿ]+')) AS w FROM documents) x GROUP BY ALL),
    hashed AS (SELECT w, n, xor(list_reduce(flatten(list_transform(string_split(doc_id || ':' || w, ''), lambda c:
                CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [195, ord(c) - 64] END)),
                lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h FROM run, crc_table),
    word AS MATERIALIZED (SELECT w, CAST(SUM(n) AS BIGINT) AS n FROM (
            SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2) ELSE w END AS w, n FROM hashed) x
        WHERE length(w) >= 7 GROUP BY w HAVING SUM(n) >= 2),
    shorter AS MATERIALIZED (SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS s FROM (
            SELECT w, n, CAST(unnest(range(1, length(w) + 1)) AS INTEGER) AS i FROM word) x),
    pair AS MATERIALIZED (
        SELECT a.w, b.w AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.s = b.s AND a.i = b.i AND a.w <> b.w
        UNION SELECT a.w, b.w, b.n FROM shorter a JOIN word b ON a.s = b.w
        UNION SELECT b.w, a.w, a.n FROM shorter a JOIN word b ON a.s = b.w),
    best AS (SELECT w, near, near_n, CAST(COUNT(*) OVER (PARTITION BY w) AS BIGINT) AS n_near,
                    ROW_NUMBER() OVER (PARTITION BY w ORDER BY near_n DESC, near) AS r FROM pair),
    formed AS MATERIALIZED (SELECT word.w, word.n, COALESCE(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * word.n THEN near END AS form,
                                   CASE WHEN near_n >= 10 * word.n THEN near_n END AS form_n
                            FROM word LEFT JOIN best ON best.w = word.w AND r = 1),
    way AS (SELECT w, w AS at FROM word UNION SELECT way.w, formed.form FROM way JOIN formed ON formed.w = way.at WHERE formed.form IS NOT NULL)
    SELECT formed.w AS word, formed.n, formed.n_near, formed.form, formed.form_n, way.at AS root
    FROM formed JOIN way ON way.w = formed.w JOIN formed e ON e.w = way.at AND e.form IS NULL"""

ORACLE = {
    "op3_ngram_join": _NGRAM_JOIN,
    "op5_line_dedup": _LINE_DEDUP,
    "op10_top_k": _TOP_K,
    "op11_clustering": _clustering(),
    "op12_spelling": _SPELLING,
}
