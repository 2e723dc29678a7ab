"""DuckDB SQL twins of the ``opN_<name>`` queries, where SQL can express the operator.

None for op1 (a trained model: held-out accuracy is tested), op2 (several hundred regexes with look-ahead), op5 (LSH) and
op11 (merges by rank): these are tested against brute force.
"""

from __future__ import annotations

from edgegraph.llm import mixing, ns_clusters, quality, url_filter, vector_codes

WORD = r"[^\x20\x09-\x0D]+"
ASCII_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _quality() -> str:
    names = list(quality.METRICS)
    b = quality.SKETCH_BITS
    expr = {"symbol_rate": "n_symbols * 1000 // greatest(word_chars, 1)", "word_length": "word_chars * 100 // greatest(n_words, 1)",
            "mark_rate": "n_marks * 1000 // greatest(word_chars, 1)", "upper_rate": "n_upper * 1000 // greatest(word_chars, 1)"}
    r = float(quality.RESOLUTION)

    def fence(keys: str) -> str:
        lead = f"{keys}, " if keys else ""
        return f"""SELECT {lead}metric, max(nn) AS n_docs, coalesce(arg_max((bucket + nx) // 2, {{'r': ratio, 'low': -bucket}})
            FILTER (c * 4 >= nn * 3 AND ratio >= {quality.FACTOR}), {quality.NO_CUT}) AS cut
          FROM (SELECT *, (nx + {r}::DOUBLE) / (bucket + {r}::DOUBLE) AS ratio FROM (
            SELECT {lead}metric, bucket, sum(sum(n)) OVER (PARTITION BY {lead}metric ORDER BY bucket) AS c,
                   sum(sum(n)) OVER (PARTITION BY {lead}metric) AS nn, lead(bucket) OVER (PARTITION BY {lead}metric ORDER BY bucket) AS nx
            FROM sk GROUP BY {lead}metric, bucket))
          GROUP BY {lead}metric"""

    return f"""
    WITH t AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, regexp_extract_all(text, '{WORD}') AS w,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM t),
    g AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
    h AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n FROM g),
    r AS (SELECT rid, sum(least(3, nx - i)) AS n_repeat FROM
            (SELECT rid, i, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i), i + 3) AS nx FROM h WHERE n > 1) GROUP BY rid),
    c AS (SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, length(translate(text, {BLANKS}, ''))::BIGINT AS word_chars,
                 (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
                 (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words,
                 len(regexp_extract_all(text, '[A-Z]')) AS n_upper,
                 len(regexp_extract_all(text, '[!-/:-@\\[-`{{-~]')) AS n_marks FROM w LEFT JOIN r USING (rid)),
    m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                 {", ".join(f"{expr[k]} AS {k}" for k in names)} FROM c),
    v AS (SELECT lang, source, metric, value FROM (UNPIVOT (SELECT lang, source, {", ".join(f"({k})::BIGINT AS {k}" for k in names)}
            FROM m WHERE NOT base_failed) ON {", ".join(names)} INTO NAME metric VALUE value)),
    sk AS (SELECT lang, source, metric, CASE WHEN value < {1 << b} THEN value ELSE
             (value >> (length(bin(value)) - {b})::BIGINT) << (length(bin(value)) - {b})::BIGINT END AS bucket, count(*) AS n
           FROM v GROUP BY ALL),
    fs AS ({fence("lang, source")}), fl AS ({fence("lang")}), fa AS ({fence("")}),
    cuts AS (SELECT k.lang, k.source, fa.metric, coalesce(fs.cut, fl.cut, fa.cut) AS cut
             FROM (SELECT DISTINCT lang, source FROM sk) k CROSS JOIN fa
             LEFT JOIN fs ON fs.lang IS NOT DISTINCT FROM k.lang AND fs.source IS NOT DISTINCT FROM k.source
                          AND fs.metric = fa.metric AND fs.n_docs >= 30
             LEFT JOIN fl ON fl.lang IS NOT DISTINCT FROM k.lang AND fl.metric = fa.metric AND fl.n_docs >= 30),
    wide AS (SELECT lang, source, {", ".join(f"max(cut) FILTER (metric = '{k}') AS t_{k}" for k in names)} FROM cuts GROUP BY ALL)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT coalesce({" OR ".join(f"{k} > t_{k}" for k in names)}, false) AS kept
    FROM m LEFT JOIN wide ON wide.lang IS NOT DISTINCT FROM m.lang AND wide.source IS NOT DISTINCT FROM m.source"""


_WARC = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    d AS (SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, sha256(body) AS payload_digest FROM p),
    f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN first <> page_id THEN first END AS refers_to FROM f"""


def _urls() -> str:
    rules = ", ".join(f"('{r}', '{v}')" for r, v in url_filter.RULES)
    terms = ", ".join(f"'{t}'" for t in url_filter.BLOCKED_TERMS)
    return rf"""
    WITH r AS (SELECT rule, verdict, split_part(rule, '/', 1) AS rh, substr(rule, instr(rule, '/')) AS rp FROM (VALUES {rules}) v(rule, verdict)),
    u AS (SELECT row_number() OVER () AS rid, page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                 coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    m AS (SELECT rid, rule, verdict, row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC, length(rh) DESC) AS k
          FROM u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
    SELECT page_id, host, path, m.rule, coalesce(m.verdict, CASE WHEN list_has_any(regexp_split_to_array(host, '[.-]'), [{terms}])
           THEN 'block' ELSE 'allow' END) AS verdict
    FROM u LEFT JOIN m ON m.rid = u.rid AND m.k = 1"""


_LINES = f"""
    WITH t AS (SELECT DISTINCT doc_id, text FROM documents),
    x AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no FROM t),
    l AS (SELECT doc_id, text, trim(line, {BLANKS}) AS line, no, row_number() OVER (PARTITION BY doc_id, text ORDER BY no) - 1 AS seq,
                 len(regexp_extract_all(line, '{WORD}')) AS w FROM x WHERE regexp_matches(line, '{WORD}')),
    a AS (SELECT doc_id, text, list(line ORDER BY seq) AS ls, list(no ORDER BY seq) AS nos, list(w ORDER BY seq) AS ws FROM l GROUP BY ALL),
    c AS (SELECT *, list_transform(range(0, len(ws) + 1), lambda i: coalesce(list_sum(ws[1:i]), 0)) AS cw FROM a),
    e AS (SELECT doc_id, text, ls, nos, cw, unnest(range(0, len(ls))) AS s FROM c),
    runs AS (
      SELECT doc_id, text, ls, s AS b, list_min(list_filter(range(s, len(ls)), lambda j: cw[j + 2] - cw[s + 1] >= 50)) AS z FROM e
      UNION
      SELECT doc_id, text, ls, list_max(list_filter(range(0, s + 1), lambda j: cw[s + 2] - cw[j + 1] >= 50)) AS b, s AS z FROM e),
    keyed AS (SELECT doc_id, text, b, z, array_to_string(ls[b + 1:z + 1], chr(10)) AS run FROM runs WHERE b IS NOT NULL AND z IS NOT NULL),
    hits AS (SELECT doc_id, text, b, z FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, b) AS k FROM keyed) WHERE k > 1),
    gone AS (SELECT doc_id, text, list(DISTINCT s ORDER BY s) AS ss FROM (SELECT doc_id, text, unnest(range(b, z + 1)) AS s FROM hits) GROUP BY ALL)
    SELECT d.doc_id, coalesce(len(a.ls), 0)::BIGINT AS n_lines, coalesce(len(ss), 0)::BIGINT AS n_removed,
           coalesce(array_to_string(list_transform(ss, lambda s: a.nos[s + 1]), ','), '') AS removed_lines
    FROM documents d LEFT JOIN a ON a.doc_id = d.doc_id AND a.text = d.text LEFT JOIN gone g ON g.doc_id = d.doc_id AND g.text = d.text"""

_CRC32 = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
             lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295)"""

_LM = f"""
    WITH t AS (SELECT doc_id, coalesce({_CRC32} % 7 = 2, false) AS held_out,
                 list_concat(list_transform(regexp_extract_all(coalesce({ASCII_LOWER}, ''), '{WORD}'), lambda x: 'w' || x), ['end']) AS w FROM documents),
    k AS (SELECT doc_id, held_out, unnest(w) AS w, unnest(list_concat(['begin'], w[1:len(w) - 1])) AS v FROM t),
    c1 AS (SELECT w, count(*) AS c FROM k WHERE NOT held_out GROUP BY w),
    cv AS (SELECT v, count(*) AS c FROM k WHERE NOT held_out GROUP BY v),
    c2 AS (SELECT v, w, count(*) AS c FROM k WHERE NOT held_out GROUP BY v, w),
    tot AS (SELECT sum(c)::BIGINT AS n, count(*) AS nv FROM c1),
    h2 AS (SELECT count(*)::DOUBLE AS types, count(*) FILTER (c = 1)::DOUBLE AS n1, count(*) FILTER (c = 2)::DOUBLE AS n2,
                  count(*) FILTER (c = 3)::DOUBLE AS n3, count(*) FILTER (c = 4)::DOUBLE AS n4 FROM c2),
    cont AS (SELECT w, count(*) AS c FROM c2 GROUP BY w),
    h1 AS (SELECT count(*)::DOUBLE AS types, count(*) FILTER (c = 1)::DOUBLE AS n1, count(*) FILTER (c = 2)::DOUBLE AS n2,
                  count(*) FILTER (c = 3)::DOUBLE AS n3, count(*) FILTER (c = 4)::DOUBLE AS n4 FROM cont),
    d AS (SELECT lvl, types, n1, n2, CASE WHEN ok THEN least(greatest(1 - 2 * y * n2 / n1, 0), 1) ELSE 0.5 END AS d1,
                 CASE WHEN ok THEN least(greatest(2 - 3 * y * n3 / n2, 0), 2) ELSE 1.0 END AS d2,
                 CASE WHEN ok THEN least(greatest(3 - 4 * y * n4 / n3, 0), 3) ELSE 1.5 END AS d3
          FROM (SELECT *, least(n1, n2, n3, n4) > 0 AS ok, n1 / (n1 + 2 * n2) AS y FROM (SELECT 2 AS lvl, * FROM h2 UNION ALL SELECT 1, * FROM h1))),
    g AS (SELECT d2.d1, d2.d2, d2.d3, d1.d1 AS e1, d1.d2 AS e2, d1.d3 AS e3, d2.types AS pairs, n, nv,
                 (d1.d1 * d1.n1 + d1.d2 * d1.n2 + d1.d3 * (d1.types - d1.n1 - d1.n2)) / d2.types / (nv + 1) AS floor
          FROM (SELECT * FROM d WHERE lvl = 2) d2, (SELECT * FROM d WHERE lvl = 1) d1, tot),
    give AS (SELECT c2.v, sum(CASE c WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END) AS b FROM c2, g GROUP BY c2.v),
    s AS (SELECT k.doc_id, k.held_out, c1.c AS c, log10((coalesce(c1.c, 0) + 1) / (n + nv + 1)) AS base,
                 floor + greatest(coalesce(cont.c, 0) - CASE WHEN cont.c IS NULL THEN 0 WHEN cont.c = 1 THEN e1 WHEN cont.c = 2 THEN e2 ELSE e3 END, 0) / pairs AS low,
                 greatest(coalesce(c2.c, 0) - CASE WHEN c2.c IS NULL THEN 0 WHEN c2.c = 1 THEN d1 WHEN c2.c = 2 THEN d2 ELSE d3 END, 0) AS high,
                 give.b AS b, cv.c AS tv
          FROM k LEFT JOIN c1 ON c1.w = k.w LEFT JOIN cont ON cont.w = k.w LEFT JOIN c2 ON c2.v = k.v AND c2.w = k.w
          LEFT JOIN give ON give.v = k.v LEFT JOIN cv ON cv.v = k.v, g)
    SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, (SELECT n FROM tot) AS train_tokens, sum(base) AS base_score,
           sum(log10(CASE WHEN tv IS NULL THEN low ELSE (high + b * low) / tv END)) AS score
    FROM s GROUP BY doc_id, held_out"""


def _mix() -> str:
    weights = "[" + ", ".join(f"{w}.0" for w in mixing.WEIGHTS) + "]"

    def md5(*parts: str) -> str:
        text = " || ':' || ".join(parts)
        return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"

    return f"""
    WITH z AS (SELECT row_number() OVER () AS rid, doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
                 coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
                 {md5("'mix'", "coalesce(doc_id::VARCHAR, 'null')", "coalesce(md5(text), 'null')")} AS h FROM documents),
    s0 AS (SELECT key, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM z GROUP BY key),
    s1 AS (SELECT *, ({weights})[(row_number() OVER (ORDER BY key) - 1) % {len(mixing.WEIGHTS)} + 1]::DOUBLE AS w,
                 source_size::DOUBLE * {mixing.MAX_REPEATS} AS cap FROM s0),
    s2 AS (SELECT *, ((SELECT sum(source_size) FROM s0)::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(w) OVER (ORDER BY cap / w, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
                 row_number() OVER (ORDER BY cap / w, key) AS rk FROM s1),
    s3 AS (SELECT *, CASE WHEN level * w >= cap THEN cap ELSE w * (SELECT arg_min(level, rk) FROM s2 WHERE level * w < cap) END AS target FROM s2),
    s AS (SELECT key, source_size, target, greatest(1, (source_size + 19999) // 20000, (n_docs + 1999) // 2000) AS n_blocks,
                 CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::BIGINT END AS passes FROM s3),
    b0 AS (SELECT z.*, source_size, target, passes, target - (passes * source_size)::DOUBLE AS rest, h % n_blocks AS block FROM z JOIN s USING (key)),
    b1 AS (SELECT key, block, any_value(rest) AS rest, sum(size) AS words, {md5("'mix'", "key", "block::VARCHAR")} AS p FROM b0 GROUP BY key, block),
    b AS (SELECT key, block, words, sum(words) OVER (PARTITION BY key ORDER BY p, block) AS cum FROM b1),
    d AS (SELECT b0.*, cum, words, sum(size) OVER (PARTITION BY b0.key, b0.block ORDER BY h, doc_id, rid) - size / 2 AS mid
          FROM b0 JOIN b USING (key, block))
    SELECT doc_id, size, source_size, target, size * (passes + CASE WHEN cum <= rest THEN 1 WHEN cum - words < rest AND mid <= rest - (cum - words)
           THEN 1 ELSE 0 END) AS taken FROM d"""


_NEAR = f"""
    WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all({ASCII_LOWER}, '{WORD}') AS w FROM documents),
    s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM t),
    n AS (SELECT doc_id, coalesce(len(s), 0)::BIGINT AS n, md5(array_to_string(s, chr(10))) AS k FROM s),
    r AS (SELECT k, min(doc_id) AS rep, any_value(n) AS n FROM n WHERE n > 0 GROUP BY k),
    x AS (SELECT rep, r.n, unnest(s.s) AS g FROM r JOIN s ON s.doc_id = r.rep),
    links AS MATERIALIZED (SELECT a.rep AS a, b.rep AS b FROM x a JOIN x b ON a.g = b.g AND a.rep < b.rep
            AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
          GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    pairs AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT rep AS v, rep AS m FROM r WHERE rep IN (SELECT a FROM pairs)
              UNION SELECT pairs.b, reach.m FROM reach JOIN pairs ON pairs.a = reach.v WHERE reach.m < pairs.b),
    lab AS (SELECT v, min(m) AS m FROM reach GROUP BY v)
    SELECT n.doc_id, n.n AS n_shingles, coalesce(lab.m, r.rep, n.doc_id) AS component_id, n.doc_id = coalesce(lab.m, r.rep, n.doc_id) AS kept
    FROM n LEFT JOIN r ON r.k = n.k AND n.n > 0 LEFT JOIN lab ON lab.v = r.rep"""


def _assign(name: str, centers: str, key: str, entries: int) -> str:
    """Nearest centre of every row (rid, ``key``, y): m // entries is the squared distance, m % entries the entry."""
    return f"""{name} AS MATERIALIZED (SELECT rid, p.{key}, min(list_sum([(y[i] - c[i]) * (y[i] - c[i]) for i in range(1, len(y) + 1)])::BIGINT
            * {entries} + entry) AS m FROM p JOIN {centers} USING ({key}) GROUP BY rid, p.{key})"""


def _update(name: str, centers: str, assigned: str, key: str, entries: int) -> str:
    """Centres replaced by the componentwise floor of their rows' mean."""
    return f"""{name} AS MATERIALIZED (
      SELECT o.{key}, o.entry, coalesce(n.c, o.c) AS c FROM {centers} o LEFT JOIN (
        SELECT {key}, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
          SELECT {key}, m % {entries} AS entry, i, sum(v)::BIGINT AS s, count(*) AS n FROM (
            SELECT {key}, m, unnest(y) AS v, generate_subscripts(y, 1) AS i FROM p JOIN {assigned} USING (rid, {key})) GROUP BY ALL)
        GROUP BY ALL) n USING ({key}, entry))"""


def _rounds(key: str, entries: int, rounds: int) -> str:
    steps = []
    for i in range(rounds):
        steps += [_assign(f"a{i}", f"c{i}", key, entries), _update(f"c{i + 1}", f"c{i}", f"a{i}", key, entries)]
    return ", ".join([*steps, _assign("last", f"c{rounds}", key, entries)])


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _codes() -> str:
    n, e = vector_codes.PARTS, vector_codes.ENTRIES
    return f"""
    WITH v AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
                      list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS x FROM embeddings WHERE {_FINITE}),
    p AS MATERIALIZED (SELECT rid, part, x[part * (len(x) // {n}) + 1:(part + 1) * (len(x) // {n})] AS y
                       FROM (SELECT rid, x, unnest(range({n})) AS part FROM v)),
    c0 AS (SELECT part, rid - 1 AS entry, y AS c FROM p WHERE rid <= {e}),
    {_rounds("part", e, vector_codes.ROUNDS)},
    r AS (SELECT rid, string_agg(printf('%02x', m % {e}), '' ORDER BY part) AS code, sum(m // {e})::BIGINT AS error FROM last GROUP BY rid),
    h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{vector_codes.ROUNDS})
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM v JOIN r USING (rid), h"""


def _clusters() -> str:
    k = ns_clusters.CLUSTERS
    return f"""
    WITH v AS (SELECT row_number() OVER (ORDER BY sha256('{ns_clusters.SEED}:' || vec_id), embedding) AS rid, vec_id, 0 AS part,
                      list_transform(embedding, lambda x: floor({ns_clusters.SCALE} * x::DOUBLE)::BIGINT) AS y FROM embeddings
               WHERE len(embedding) = {ns_clusters.DIMS} AND {_FINITE}),
    p AS MATERIALIZED (SELECT rid, part, y FROM v),
    c0 AS (SELECT part, rid - 1 AS entry, y AS c FROM p WHERE rid <= {k}),
    {_rounds("part", k, ns_clusters.ROUNDS)},
    r AS (SELECT rid, (m % {k})::INTEGER AS cluster, m // {k} AS distance FROM last)
    SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
           (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM v JOIN r USING (rid) JOIN c{ns_clusters.ROUNDS} ON entry = cluster"""


def oracle_sql() -> dict[str, str]:
    return {"op3_quality_rules": _quality(), "op4_warc": _WARC, "op6_url_filters": _urls(), "op7_line_dedup": _LINES,
            "op8_lm_scoring": _LM, "op9_mixing": _mix(), "op10_minhash_neardup": _NEAR,
            "op12_vector_codes": _codes(), "op13_centroid_clusters": _clusters()}
