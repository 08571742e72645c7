"""The queries of this package, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import bpe, centroids, decontaminate, jaccard, langid, lexical, linededup, packing, quality, substring, suffixes, topk, urlfilter

QUERIES = {
    f.__name__: f
    for f in (
        linededup.op1_line_dedup,
        decontaminate.op2_benchmark_decontamination,
        bpe.op3_bpe_codec,
        substring.op4_substring_dedup,
        topk.op5_top_k_search,
        quality.op6_quality_classifier,
        urlfilter.op7_url_filters,
        jaccard.op8_ngram_jaccard_join,
        suffixes.op9_suffix_array_dedup,
        langid.op10_language_id,
        lexical.op11_ranked_search,
        centroids.op12_centroid_clustering,
        packing.op13_packing,
    )
}

ORACLE_SQL = {
    "op1_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS no, unnest(string_split(text, chr(10))) AS line
            FROM documents
        ), f AS (
            SELECT line, min((doc_id, no)) AS place, length(line) AS chars
            FROM l WHERE regexp_matches(line, '\S') GROUP BY line
        ), long AS (
            SELECT *, chars // 3 AS third FROM f WHERE chars >= 24
        ), near AS (
            -- two edits leave one third of a line as it was
            SELECT DISTINCT CASE WHEN a.place < b.place THEN b.line ELSE a.line END AS line
            FROM (SELECT *, unnest([0, 1, 2]) + chars AS other FROM long) a JOIN long b ON b.chars = a.other
            WHERE a.line <> b.line
              AND (contains(b.line, a.line[1:a.third]) OR contains(b.line, a.line[a.third + 1:2 * a.third]) OR contains(b.line, a.line[2 * a.third + 1:]))
              AND levenshtein(a.line, b.line) <= 2
        ), gone AS (
            SELECT l.doc_id, l.no FROM l JOIN f USING (line)
            WHERE (l.doc_id, l.no) <> f.place OR l.line IN (SELECT line FROM near)
        ), g AS (
            SELECT doc_id, count(*) AS n_removed, string_agg(CAST(no AS VARCHAR), ',' ORDER BY no) AS removed_lines FROM gone GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
               CAST(coalesce(g.n_removed, 0) AS BIGINT) AS n_removed, coalesce(g.removed_lines, '') AS removed_lines
        FROM documents d LEFT JOIN g USING (doc_id)
    """,
    "op4_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), win AS (
            SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM d, unnest(range(1, len(w) - 48)) AS u(i)
        ), firsts AS (
            SELECT h, min(doc_id) AS low FROM win GROUP BY h
        ), gone AS (
            SELECT DISTINCT win.doc_id, win.i + o.k AS i FROM win JOIN firsts USING (h), range(50) AS o(k) WHERE win.doc_id > low
        ), words AS (
            SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d
        ), kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
            FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op5_top_k_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 100 = 0
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
    """,
    "op8_ngram_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
        ), k AS (
            SELECT doc_id, array_to_string(w, ' ') AS k, w FROM w
        ), t AS (
            SELECT k, min(doc_id) AS node, count(*) AS n_copies, any_value(w) AS w FROM k GROUP BY k
        ), s AS (
            SELECT DISTINCT node, array_to_string(w[i:i + 4], ' ') AS g
            FROM t, unnest(range(1, greatest(len(w) - 3, 2))) AS u(i) WHERE len(w) > 0
        ), c AS (
            SELECT node, count(*) AS n FROM s GROUP BY node
        ), p AS (
            SELECT a.node AS a, b.node AS b, count(*) AS x FROM s a JOIN s b ON a.g = b.g AND a.node <> b.node GROUP BY ALL
        ), l AS (
            SELECT p.a, p.b FROM p JOIN c ca ON ca.node = p.a JOIN c cb ON cb.node = p.b WHERE x >= 0.8 * (ca.n + cb.n - x)
        ), reach AS (
            SELECT node, node AS other FROM t
            UNION
            SELECT reach.node, l.b FROM reach JOIN l ON l.a = reach.other
        ), class AS (
            SELECT node, min(other) AS class_id FROM reach GROUP BY node
        ), links AS (
            SELECT a AS node, count(*) AS n_links FROM l GROUP BY a
        )
        SELECT k.doc_id, class.class_id, CAST(coalesce(links.n_links, 0) AS BIGINT) AS n_links, CAST(t.n_copies AS BIGINT) AS n_copies
        FROM k JOIN t USING (k) JOIN class USING (node) LEFT JOIN links USING (node)
    """,
    "op11_ranked_search": lexical.OP11_SQL,
    "op12_centroid_clustering": centroids.OP12_SQL,
}
