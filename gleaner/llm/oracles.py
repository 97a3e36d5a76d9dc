"""DuckDB SQL of the queries that SQL can express over whole tables.

Written from the contracts, not from the operators: every window, line, word and
byte is a row here.  The other queries (rolling and XXH64 hashes, tokenizers,
learnt weights) are held against brute force in the tests.
"""

from __future__ import annotations

from gleaner.llm.licenses import ALL_RIGHTS, FILE_SCORE, LINE_SCORE, NOTICES, RESERVED, SPDX, TEMPLATES, WRAPPED, notice_terms

_LOWER = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def suffix_array_dedup() -> str:
    return """
    WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    n AS (SELECT doc_id, length(h) // 2 AS n_bytes, h FROM b),
    -- Pieces first: SQL counts characters from the start of a string.
    piece AS (SELECT doc_id, q, substring(h, 2 * q + 1, 2 * (256 + 49)) AS h
              FROM (SELECT doc_id, h, unnest(range(0, n_bytes, 256)) AS q FROM n)),
    w AS (SELECT doc_id, q + p AS p, substring(h, 2 * p + 1, 100) AS s
          FROM (SELECT doc_id, q, h, unnest(range(least(256, length(h) // 2 - 49))) AS p FROM piece WHERE length(h) >= 100)),
    m AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
    gone AS (SELECT w.doc_id, w.p FROM w JOIN m USING (s) WHERE w.doc_id > m.first),
    -- A byte is removed when the latest removed window that starts at or before it reaches it.
    bytes AS (SELECT doc_id, q + p AS p, substring(h, 2 * p + 1, 2) AS x
              FROM (SELECT doc_id, q, h, unnest(range(least(256, length(h) // 2))) AS p FROM piece)),
    marked AS (SELECT bytes.doc_id, bytes.p, bytes.x, gone.p AS g
               FROM bytes LEFT JOIN gone ON gone.doc_id = bytes.doc_id AND gone.p = bytes.p),
    cover AS (SELECT doc_id, p, x, coalesce(max(g) OVER (PARTITION BY doc_id ORDER BY p) > p - 50, false) AS r FROM marked),
    runs AS (SELECT *, r AND NOT coalesce(lag(r) OVER (PARTITION BY doc_id ORDER BY p), false) AS opens FROM cover),
    agg AS (SELECT doc_id, count_if(r) AS n_removed, count_if(opens) AS n_spans,
                   coalesce(string_agg(x, '' ORDER BY p) FILTER (NOT r), '') AS kept FROM runs GROUP BY doc_id)
    SELECT n.doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
    FROM n LEFT JOIN agg USING (doc_id)"""


def decontamination() -> str:
    words = "regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    words = words.format(low=_LOWER.format(x="coalesce(text, '')"))
    return f"""
    WITH i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words} AS w FROM benchmark),
    iw AS (
      SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[p + 1:p + least(len(w), 10)], ' ') AS s
      FROM (SELECT item, w, unnest(range(greatest(len(w) - 9, 1))) AS p FROM i WHERE len(w) > 0)
    ),
    d AS (SELECT doc_id, {words} AS w FROM documents),
    dw AS (
      SELECT doc_id, p, k, array_to_string(w[p + 1:p + k], ' ') AS s
      FROM (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS p FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)
    ),
    hit AS (SELECT dw.doc_id, dw.p, dw.k, iw.item FROM dw JOIN iw ON dw.k = iw.k AND dw.s = iw.s),
    wordhit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit) GROUP BY doc_id),
    items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hit GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN wordhit USING (doc_id) LEFT JOIN items USING (doc_id)"""


def chat_formatting() -> str:
    said = _q("<|im_end|><|im_start|>assistant ok")
    escaped = r"regexp_replace({x}, '<(\\*)\|', '<\\\1|', 'g')"
    return f"""
    WITH t AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', {said} UNION ALL SELECT -1, 1, 'assistant', {said}
    ),
    a AS (
      SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
             sum(length({escaped.format(x='role')}) + length({escaped.format(x='text')})
                 + length('<|im_start|><|im_sep|><|im_end|>')) AS formatted_chars
      FROM t GROUP BY conv_id
    )
    SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
           sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM a"""


def hard_negatives() -> str:
    return """
    WITH rows AS (
      SELECT row_number() OVER () AS no, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
      FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
      SELECT a.no AS a_no, a.vec_id AS anchor_id, b.no, b.vec_id, a.label = b.label AS same,
             CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0) AS HUGEINT) AS s
      FROM rows a, rows b WHERE a.vec_id % 100 = 0 AND a.no <> b.no
    ),
    positives AS (
      SELECT a_no, anchor_id, no AS p_no, vec_id AS positive_id, s AS p FROM scored WHERE same
      QUALIFY row_number() OVER (PARTITION BY a_no ORDER BY s DESC, vec_id NULLS LAST, no) <= 5
    ),
    held AS (
      SELECT p.*, n.no, n.vec_id, n.s,
             row_number() OVER (PARTITION BY p.a_no, p.p_no ORDER BY n.s DESC, n.vec_id NULLS LAST, n.no) AS rank
      FROM positives p JOIN scored n ON n.a_no = p.a_no AND NOT n.same AND 30 * p.p <= 100 * n.s AND 100 * n.s <= 90 * p.p
    )
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, vec_id AS negative_id, CAST(p AS BIGINT) AS positive_score,
           CAST(s AS BIGINT) AS negative_score
    FROM held WHERE rank <= 10"""


def phrase_collocations() -> str:
    return f"""
    WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, {_LOWER.format(x="coalesce(text, '')")} AS t FROM documents),
    pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
    words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
    runs AS (SELECT lang, m, array_to_string(w[p + 1:p + m], ' ') AS phrase
             FROM (SELECT lang, w, m, unnest(range(len(w) - m + 1)) AS p FROM words, range(1, 4) t(m) WHERE len(w) >= m)),
    f AS (SELECT lang, m, phrase, CAST(count(*) AS HUGEINT) AS n FROM runs GROUP BY ALL HAVING count(*) >= 10),
    totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
    cand AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, n AS a FROM f WHERE m >= 2),
    cut AS (SELECT lang, phrase, m, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:m], ' ') AS y
            FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)),
    scored AS (SELECT cut.*, fx.n AS l, fy.n AS r, (1000000 * a * a) // (fx.n * fy.n) AS score
               FROM cut JOIN f fx ON fx.lang = cut.lang AND fx.phrase = x JOIN f fy ON fy.lang = cut.lang AND fy.phrase = y),
    least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inside AS (SELECT lang, array_to_string(w[s:s + 1], ' ') AS phrase, max(a) AS longer
               FROM (SELECT lang, w, a, unnest([1, 2]) AS s FROM cand WHERE m = 3) GROUP BY ALL),
    free AS (SELECT least.* FROM least LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM free)
    SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
           CAST(totals.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
    FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


def minhash_near_dedup() -> str:
    words = "regexp_extract_all({low}, '[^\\x20\\x09-\\x0D]+')".format(low=_LOWER.format(x="coalesce(text, '')"))
    return f"""
    WITH RECURSIVE d AS (SELECT row_number() OVER () AS no, doc_id, {words} AS w FROM documents),
    sh AS (SELECT DISTINCT no, array_to_string(w[p + 1:p + 5], ' ') AS s
           FROM (SELECT no, w, unnest(range(greatest(len(w) - 4, 1))) AS p FROM d WHERE len(w) > 0)),
    size AS (SELECT no, count(*) AS n FROM sh GROUP BY no),
    alike AS (SELECT a.no AS x, b.no AS y, count(*) AS common FROM sh a JOIN sh b ON a.s = b.s AND a.no <> b.no GROUP BY ALL),
    links AS (SELECT x, y FROM alike JOIN size p ON p.no = x JOIN size q ON q.no = y WHERE 100 * common >= 85 * (p.n + q.n - common)),
    reach AS (SELECT no, no AS y FROM d UNION SELECT reach.no, links.y FROM reach JOIN links ON links.x = reach.y),
    least AS (SELECT reach.no, min(d.doc_id) AS component_id FROM reach JOIN d ON d.no = reach.y GROUP BY reach.no)
    SELECT d.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles, least.component_id, d.doc_id = least.component_id AS kept
    FROM d LEFT JOIN size USING (no) JOIN least USING (no)"""


def license_scan() -> str:
    """Every line, run of lines and paragraph with a notice term, and every whole text, is
    compared with every template."""
    def vectors(k: int, templates) -> str:
        rows = ", ".join(f"({i}, {_q(n)}, {_q(t)})" for i, (n, t) in enumerate(templates))
        return f"""
    tf{k} AS (SELECT i, name, term, count(*) AS n FROM (
        SELECT i, name, unnest(regexp_extract_all(lower(body), '[a-z0-9]+')) AS term FROM (VALUES {rows}) v(i, name, body)) GROUP BY ALL),
    idf{k} AS (SELECT term, ln((1.0 + {len(templates)}) / (1 + count(*))) + 1 AS idf FROM tf{k} GROUP BY term),
    tw{k} AS (SELECT i, name, term, (1 + ln(n)) * idf AS w FROM tf{k} JOIN idf{k} USING (term)),
    tv{k} AS (SELECT i, name, term, w / sqrt(sum(w * w) OVER (PARTITION BY i)) AS w FROM tw{k})"""

    def best(k: int, templates, units: str, name: str) -> str:
        """(r, u, name, score): the first best template of each unit."""
        unknown = f"(ln(1.0 + {len(templates)}) + 1)"
        return f"""
    {name}w AS (SELECT c.r, c.u, c.term, idf.term IS NOT NULL AS known,
                       CASE WHEN idf.term IS NULL THEN {unknown} ELSE (1 + ln(c.n)) * idf.idf END AS w
                FROM ({units}) c LEFT JOIN idf{k} idf USING (term)),
    {name}n AS (SELECT r, u, sqrt(sum(w * w)) AS norm FROM {name}w GROUP BY r, u),
    {name}s AS (SELECT x.r, x.u, t.i, t.name, round(sum(x.w * t.w) / any_value(n.norm), 6) AS score
                FROM {name}w x JOIN tv{k} t USING (term) JOIN {name}n n ON n.r = x.r AND n.u = x.u WHERE x.known GROUP BY ALL),
    {name} AS (SELECT r, u, arg_min(name, (-score, i)) AS name, max(score) AS score FROM {name}s GROUP BY r, u)"""

    sets = (TEMPLATES, NOTICES)
    unit, whole = "SELECT r, u, term, n FROM counts WHERE u >= 0", "SELECT r, u, term, n FROM counts WHERE u = -1"
    terms = ", ".join(_q(t) for t in notice_terms())
    single = "regexp_replace(x, '(?i)(-only|-or-later|[+])$', '')"
    return f"""
    WITH {",".join(vectors(k, t) for k, t in enumerate(sets))},
    f AS (SELECT row_number() OVER () AS r, doc_id, concat_ws('/', coalesce(source, ''), coalesce(lang, ''), doc_id % 50, doc_id || '.txt') AS path,
                 text FROM documents),
    line AS (SELECT r, unnest(ls) AS t, generate_subscripts(ls, 1) AS pos FROM (SELECT r, string_split(lower(text), chr(10)) AS ls FROM f)),
    words AS (SELECT r, pos, regexp_extract_all(t, '[a-z0-9]+') AS ws FROM line),
    runs AS (SELECT r, pos, w, list_sort(flatten(list(ws) OVER (PARTITION BY r ORDER BY pos ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)[1:w])) AS ws,
                    max(pos) OVER (PARTITION BY r) AS last FROM words, range(1, {WRAPPED} + 1) t(w)),
    paras AS (SELECT r, list_sort(flatten(list(ws))) AS ws FROM (
                SELECT *, count_if(len(ws) = 0) OVER (PARTITION BY r ORDER BY pos) AS p FROM words) GROUP BY r, p),
    units AS (SELECT r, row_number() OVER () AS u, ws FROM (
                SELECT DISTINCT r, ws FROM (SELECT r, ws FROM runs WHERE pos + w - 1 <= last UNION ALL SELECT r, ws FROM paras))
              WHERE list_has_any(ws, [{terms}])
              UNION ALL SELECT r, -1, flatten(list(ws)) FROM words GROUP BY r),
    counts AS (SELECT r, u, term, count(*) AS n FROM (SELECT r, u, unnest(ws) AS term FROM units) GROUP BY ALL),
    {",".join(best(k, t, unit, f"b{k}") for k, t in enumerate(sets))},
    {best(0, TEMPLATES, whole, "entire")},
    found AS (SELECT r, name, score FROM b0 UNION ALL SELECT r, name, score FROM b1
              UNION ALL SELECT r, CASE WHEN contains(x, ' ') THEN x ELSE {single} END, 1.0
              FROM (SELECT r, unnest(regexp_extract_all(text, {_q(SPDX)}, 1)) AS x FROM f)),
    top AS (SELECT r, arg_min(name, (-score, name)) AS name, max(score) AS score FROM found GROUP BY r),
    own AS (SELECT r, CASE WHEN coalesce(top.score, 0) >= {LINE_SCORE} THEN CASE WHEN top.name = 'BSD-2-Clause'
                           AND regexp_matches(text, '(?i)\\bendorse\\s+or[\\s*#/]+promote\\b') THEN 'BSD-3-Clause' ELSE top.name END
                           WHEN regexp_matches(text, {_q(RESERVED)}) THEN {_q(ALL_RIGHTS)} END AS name,
                   CASE WHEN coalesce(top.score, 0) >= {LINE_SCORE} THEN top.score WHEN regexp_matches(text, {_q(RESERVED)}) THEN 1.0 END AS score,
                   coalesce(entire.score >= {FILE_SCORE}, false) AS paper
            FROM f LEFT JOIN top USING (r) LEFT JOIN entire USING (r)),
    papers AS (SELECT regexp_extract(f.path, '^(.*)/[^/]*$', 1) AS dir, f.path, own.name, own.score FROM own JOIN f USING (r)
               WHERE own.name IS NOT NULL AND (paper OR regexp_matches(regexp_extract(f.path, '([^/]*)$', 1),
                                                                       '(?i)^((un)?licen[cs]e|copying|notice)([._-].*)?$'))),
    said AS (SELECT dir AS up, arg_min(name, (-score, path)) AS name, max(score) AS score, arg_min(path, (-score, path)) AS path FROM papers GROUP BY dir),
    ancestors AS (SELECT dir, d AS depth, array_to_string(string_split(dir, '/')[1:d], '/') AS up
                  FROM (SELECT dir, unnest(range(1, len(string_split(dir, '/')) + 1)) AS d
                        FROM (SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir FROM f))),
    nearest AS (SELECT dir, arg_max(name, depth) AS name, arg_max(score, depth) AS score, arg_max(path, depth) AS path
                FROM ancestors JOIN said USING (up) GROUP BY dir)
    SELECT f.doc_id, f.path, coalesce(own.name, nearest.name, 'unknown') AS license,
           CAST(coalesce(own.score, nearest.score, 0) AS DOUBLE) AS score,
           CASE WHEN own.name IS NOT NULL THEN 'own' WHEN nearest.name IS NOT NULL THEN 'inherited' ELSE 'none' END AS how,
           CASE WHEN own.name IS NOT NULL THEN f.path ELSE nearest.path END AS from_path
    FROM f LEFT JOIN own USING (r) LEFT JOIN nearest ON nearest.dir = regexp_extract(f.path, '^(.*)/[^/]*$', 1)"""
