"""DuckDB SQL that gives the rows of a query, where SQL can express it."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: A step of crc32 for a byte: eight shifts, each with the polynomial if the lowest bit is set.
_STEP = "x"
for _ in range(8):
    _STEP = f"list_transform([{_STEP}], lambda y: xor(y >> 1, (y & 1) * 3988292384))[1]"
_CRC_TABLE = f"(SELECT list({_STEP} ORDER BY x) FROM range(256) t(x))"
#: Runs of ASCII letters and digits and of all that is not ASCII; and with A-Z lower-cased.
_TERMS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = {
    "op1_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_LOWER} AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm)""",
    "op7_mix_sources": f"""
        WITH d AS (SELECT doc_id, source, md5('mix|' || coalesce(doc_id::VARCHAR, 'null')) AS digest, len({_WORDS})::BIGINT AS size FROM documents),
        per AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight FROM per),
        r AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - 2 * coalesce(sum(source_size) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS rate,
                     source_size / weight AS ratio
              FROM w WINDOW b AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        t AS (SELECT source, source_size, CASE WHEN 2 * source_size <= weight * rate THEN (2 * source_size)::DOUBLE ELSE least((2 * source_size)::DOUBLE, weight *
                     (SELECT rate FROM r WHERE NOT 2 * source_size <= weight * rate ORDER BY ratio, source NULLS LAST LIMIT 1)) END AS target FROM r),
        q AS (SELECT d.*, t.source_size, t.target, sum(size) OVER (PARTITION BY d.source ORDER BY digest, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        c AS (SELECT *, (upto + pass * source_size) / nullif(target, 0) AS finish FROM q, (VALUES (0), (1)) p(pass)),
        s AS (SELECT *, sum(size) OVER (ORDER BY finish NULLS LAST, source NULLS LAST, digest, doc_id, size, pass ROWS UNBOUNDED PRECEDING) <= (SELECT sum(target) FROM t) AND target > 0 AS served FROM c)
        SELECT doc_id, size, source_size, target, sum(CASE WHEN served THEN size ELSE 0 END)::BIGINT AS taken
        FROM s GROUP BY doc_id, size, source_size, target""",
    "op9_quality_rules": rf"""
        WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
        g AS (SELECT doc_id, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS gram FROM d, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i)),
        m AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g),
        r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, i + unnest([0, 1, 2]) AS p FROM m WHERE n >= 2) GROUP BY doc_id),
        c AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                     length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                     (len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
                     coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
              FROM d LEFT JOIN r USING (doc_id)),
        j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
        h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM j GROUP BY source),
        p AS (SELECT avg(f / n) AS m, greatest(coalesce(var_samp(f / n), 0) - avg(f / n) * (1 - avg(f / n)) * avg(1 / n), 1e-6) AS own FROM h),
        q AS (SELECT m, least(greatest(m * (1 - m) / own - 1, 1.0), 1e4) AS k FROM p)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND (f + m * k) / (n + m * k + (1 - m) * k) <= 0.5 AS kept
        FROM j JOIN h ON j.source IS NOT DISTINCT FROM h.source, q""",
    "op11_spelling_variants": rf"""
        WITH RECURSIVE r AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
        u AS (SELECT id, w, count(*) AS k FROM r GROUP BY ALL), table_ AS (SELECT {_CRC_TABLE} AS crc),
        h AS (SELECT w, k, xor(list_reduce(list_transform(range(1, strlen(id || ':' || w) + 1), lambda i: ('0x' || hex(encode(id || ':' || w))[2 * i - 1:2 * i])::BIGINT),
                     lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) AS crc32 FROM u, table_),
        c AS (SELECT CASE WHEN crc32 % 97 = 0 THEN w[:crc32 % length(w)] || w[crc32 % length(w) + 2:] ELSE w END AS word, k FROM h),
        v AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n FROM c WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
        x AS (SELECT word, n, i, word[:i] || word[i + 2:] AS less, length(word) AS l FROM v, LATERAL (SELECT unnest(range(length(word))) AS i)),
        p AS (SELECT a.word, b.word AS near, b.n AS m FROM x a JOIN x b ON a.less = b.less AND a.i = b.i AND a.l = b.l AND a.word <> b.word
              UNION SELECT x.word, v.word, v.n FROM x JOIN v ON less = v.word UNION SELECT v.word, x.word, x.n FROM x JOIN v ON less = v.word),
        q AS (SELECT word, count(*) AS n_near, max(m) AS best_n, min(near) FILTER (m = (SELECT max(m) FROM p o WHERE o.word = p.word)) AS best FROM p GROUP BY word),
        f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * v.n THEN best END AS form, CASE WHEN best_n >= 2 * v.n THEN best_n END AS form_n FROM v LEFT JOIN q USING (word)),
        t AS (SELECT word, form AS last FROM f WHERE form IS NOT NULL UNION ALL SELECT t.word, f.form FROM t JOIN f ON f.word = t.last WHERE f.form IS NOT NULL),
        e AS (SELECT t.word, t.last FROM t JOIN f ON f.word = t.last WHERE f.form IS NULL)
        SELECT f.word, f.n, n_near, form, form_n, coalesce(e.last, f.word) AS root FROM f LEFT JOIN e USING (word)""",
    "op12_ranked_search": rf"""
        WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS t FROM documents), s AS (SELECT count(*) AS nd, sum(len(t))::BIGINT AS nt FROM d WHERE len(t) > 0),
        i AS (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS t FROM benchmark), q AS (SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(t) AS term FROM i) GROUP BY ALL),
        p AS (SELECT row, doc_id, len(t) AS n, unnest(t) AS term FROM d), tf AS (SELECT row, doc_id, n, term, count(*) AS tf FROM p WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY term, nd),
        g AS (SELECT item, item_id, row, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // nt))))::BIGINT AS score FROM q JOIN tf USING (term) JOIN w USING (term), s GROUP BY ALL)
        SELECT item_id, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST))::INT AS rank, doc_id, score FROM g WHERE score > 0 QUALIFY rank <= 10""",
    "op13_decontamination": rf"""
        WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS t FROM documents), i AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {_TERMS} AS t FROM benchmark),
        w AS (SELECT DISTINCT item, least(len(t), 10) AS k, array_to_string(t[p:p + least(len(t), 10) - 1], ' ') AS gram FROM i, LATERAL (SELECT unnest(range(1, len(t) - least(len(t), 10) + 2)) AS p) WHERE len(t) > 0),
        g AS (SELECT row, p, k, array_to_string(t[p:p + k - 1], ' ') AS gram FROM d, (SELECT DISTINCT k FROM w), LATERAL (SELECT unnest(range(1, len(t) - k + 2)) AS p)),
        h AS (SELECT row, p, k, item FROM g JOIN w USING (k, gram)),
        n AS (SELECT row, count(DISTINCT x) AS n_hit FROM (SELECT row, unnest(range(p, p + k)) AS x FROM h) GROUP BY row),
        m AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, item FROM h) GROUP BY row)
        SELECT doc_id, len(t)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN n USING (row) LEFT JOIN m USING (row)""",
}
