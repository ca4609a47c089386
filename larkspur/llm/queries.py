"""The registered queries of this subpackage and their SQL."""

from larkspur.llm import alignment, jaccard, licences, lm, mixing, neighbours, packing, pii, quality, substring, suffix, trie, warc


def quoted(text):
    return "'" + text.replace("'", "''") + "'"


def any_of(column, parts):
    return "(" + " OR ".join(f"contains({column}, {quoted(x)})" for x in parts) + ")"


def bare(column, characters):
    return f"translate({column}, {quoted(characters)}, '')"


WORDS = r"'[^\x20\x09-\x0D]+'"
Q = quality
#: Lines with their words and the rule they fail, and documents with the windows that repeat.
QUALITY_SQL = f"""
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents),
    lines AS (
        SELECT doc_id, line, len(regexp_extract_all(line, {WORDS})) AS n, len(array_to_string(regexp_extract_all(line, {WORDS}), '')) AS chars
        FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs)),
    judged AS (
        SELECT *, len(list_filter(string_split(line, ' '), lambda x: x IN ({", ".join(map(quoted, Q.SEPARATORS))}))) AS separators,
            len(line) - len({bare("line", Q.SYMBOLS)}) AS symbols, len(line) - len(replace(line, '!!', '!')) AS shouts
        FROM lines),
    ruled AS (
        SELECT *, CASE WHEN n = 0 THEN NULL
            WHEN separators > 0 AND separators >= CAST({Q.MAX_SEPARATOR_RATE} AS DOUBLE) * n THEN 'navigation'
            WHEN n <= 4 AND regexp_matches(line, {quoted(Q.NAVIGATION)}) THEN 'navigation'
            WHEN symbols > CAST({Q.MAX_SYMBOL_RATE} AS DOUBLE) * n THEN 'boilerplate'
            WHEN shouts > CAST({Q.MAX_SHOUT_RATE} AS DOUBLE) * n THEN 'boilerplate'
            WHEN {any_of("lower(line)", Q.BOILERPLATE)} THEN 'boilerplate'
            WHEN n >= {Q.SENTENCE_WORDS} AND NOT (instr({quoted(Q.ENDS)}, right(rtrim(line, ' '), 1)) > 0
                OR regexp_matches(line, {quoted(Q.INNER_END)})) THEN 'punctuation' END AS rule FROM judged),
    by_lines AS (
        SELECT doc_id, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines,
            coalesce(sum(chars) FILTER (rule IS NOT NULL), 0) AS lost_chars,
            {", ".join(f"count(*) FILTER (rule = '{r}') AS lost_{r}" for r in ("punctuation", "navigation", "boilerplate"))}
        FROM ruled GROUP BY doc_id),
    windows AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS g FROM docs, unnest(range(1, len(w) - 1)) AS x(i)),
    again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, unnest([0, 1, 2]) AS x(k) GROUP BY doc_id),
    counted AS (
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
            CAST(len(t) - len({bare("t", Q.SYMBOLS)}) AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
            CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, CAST(lost_punctuation AS BIGINT) AS lost_punctuation,
            CAST(lost_navigation AS BIGINT) AS lost_navigation, CAST(lost_boilerplate AS BIGINT) AS lost_boilerplate,
            CAST(lost_chars AS BIGINT) AS lost_chars
        FROM docs JOIN by_lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
    failed AS (SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted)
    SELECT *, NOT base_failed AND lost_chars <= CAST({Q.MAX_LOST} AS DOUBLE) * word_chars AS kept FROM failed"""
SUBSTRING_SQL = f"""
    WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents),
    windows AS (
        SELECT doc_id, i, array_to_string(w[i:i + {substring.WORDS - 1}], ' ') AS g
        FROM docs, unnest(range(1, len(w) - {substring.WORDS - 2})) AS x(i)),
    later AS (SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY g) < doc_id),
    gone AS (SELECT DISTINCT doc_id, i + k AS p FROM later, unnest(range({substring.WORDS})) AS x(k)),
    places AS (
        SELECT doc_id, p, w[p] AS word, gone.p IS NOT NULL AS is_gone FROM
            (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM docs) LEFT JOIN gone USING (doc_id, p)),
    marked AS (SELECT *, coalesce(lag(is_gone) OVER (PARTITION BY doc_id ORDER BY p), FALSE) AS before FROM places),
    summed AS (
        SELECT doc_id, count(*) FILTER (is_gone) AS n_removed, count(*) FILTER (is_gone AND NOT before) AS n_spans,
            string_agg(word, ' ' ORDER BY p) FILTER (NOT is_gone) AS kept FROM marked GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256, CAST(coalesce(n_spans, 0) AS INTEGER) AS n_spans
    FROM docs LEFT JOIN summed USING (doc_id)"""

JACCARD_SQL = f"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            {WORDS}) AS w FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + {jaccard.SHINGLE - 1}], ' ') AS s
        FROM docs, unnest(range(1, greatest(len(w) - {jaccard.SHINGLE - 2}, 2))) AS x(i) WHERE len(w) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b USING (s)
        WHERE a.doc_id < b.doc_id GROUP BY ALL),
    links AS (
        SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
        WHERE 100 * pairs.n >= {jaccard.PERCENT} * (a.n + b.n - pairs.n)),
    edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reached(v, r) AS (SELECT doc_id, doc_id FROM docs UNION SELECT v, y FROM reached JOIN edges ON r = x)
    SELECT docs.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id
    FROM docs JOIN reached ON v = docs.doc_id LEFT JOIN sizes ON sizes.doc_id = docs.doc_id GROUP BY docs.doc_id"""

#: CRC-32 of the decimal id, bit by bit.
CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
            string_split(CAST(conv_id AS VARCHAR), ''), lambda z: CAST(ascii(z) AS BIGINT))), lambda a, z: list_reduce(
            list_prepend(xor(a, z), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
            lambda s, u: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END)), 4294967295)"""
TRIE_SQL = f"""
    WITH t AS (
        SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS i
        FROM conversations WHERE conv_id IS NOT NULL),
    c AS (
        SELECT conv_id, n, conv_id - conv_id % {trie.FAMILY} AS base, {CRC} % {trie.SHARED} AS h
        FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id)),
    rebuilt AS (
        SELECT c.conv_id, t.i AS d, r, x FROM c JOIN t ON t.conv_id = c.base AND t.i <= h
        UNION ALL
        SELECT c.conv_id, t.i - c.h + least(c.h, coalesce(b.n, 0)), r, x
        FROM c JOIN t ON t.conv_id = c.conv_id LEFT JOIN c b ON b.conv_id = c.base WHERE t.i > c.h),
    steps AS (
        SELECT conv_id, d, x, list([r, x]) OVER (PARTITION BY conv_id ORDER BY d) AS p FROM rebuilt
        UNION ALL SELECT conv_id, 0, '', [] FROM c),
    nodes AS (SELECT p, len(p) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(len(x)) AS chars FROM steps GROUP BY p),
    children AS (SELECT p[:depth - 1] AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
    valued AS (
        SELECT nodes.*, coalesce(n_children, 0) AS n_children, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf
        FROM nodes LEFT JOIN children USING (p)),
    sums AS (
        SELECT p[:i] AS p, sum(leaf) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
        FROM (SELECT *, unnest(range(depth + 1)) AS i FROM valued) GROUP BY ALL),
    lasts AS (SELECT conv_id, max(d) AS d FROM steps GROUP BY conv_id),
    ends AS (
        SELECT p, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
        FROM steps JOIN lasts USING (conv_id, d) GROUP BY p)
    SELECT v.conv_id, v.depth, up.conv_id AS parent_conv_id, v.n_convs, v.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
        CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
    FROM valued v JOIN sums USING (p) LEFT JOIN ends USING (p)
    LEFT JOIN nodes up ON v.depth > 0 AND up.p = v.p[:v.depth - 1]"""

QUERIES = {f.__name__: f for f in (
    quality.op1_quality_rules, substring.op2_substring_dedup, packing.op3_best_fit_packing, licences.op4_licence_scan, warc.op5_warc,
    suffix.op6_suffix_array_dedup, jaccard.op7_ngram_jaccard_join,
    pii.op8_pii, neighbours.op9_nearest_neighbours, mixing.op10_temperature_mixing, trie.op11_prefix_trie,
    lm.op12_lm_scoring, alignment.op13_tokenizer_alignment,
)}
ORACLES = {
    "op11_prefix_trie": TRIE_SQL,
    "op7_ngram_jaccard_join": JACCARD_SQL,
    "op1_quality_rules": QUALITY_SQL,
    "op2_substring_dedup": SUBSTRING_SQL,
    "op5_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
        ), f AS (SELECT d, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY d)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
               CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM p LEFT JOIN f ON p.d = f.d AND n >= 100""",
}
