"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from ledgerlens.llm import license_scan, quality_rules, url_filter

# Windows of three lines over all documents; the text hash of a document is replaced by the text itself.
OP9 = r"""
WITH docs AS (
    SELECT doc_id, text, row_number() OVER () AS r,
           CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS lines
    FROM documents),
windows AS (
    SELECT r, doc_id, p, trim(lines[p], ' ') || chr(10) || trim(lines[p + 1], ' ') || chr(10) || trim(lines[p + 2], ' ') AS w
    FROM docs, LATERAL (SELECT unnest(range(1, len(lines) - 1)) AS p) AS t),
worded AS (SELECT * FROM windows WHERE length(w) > 2),
ordered AS (
    SELECT r, p, first_value(r) OVER win AS fr, first_value(p) OVER win AS fp
    FROM worded WINDOW win AS (PARTITION BY w ORDER BY doc_id NULLS LAST, r, p)),
spans AS (
    SELECT r, CASE WHEN r = fr THEN greatest(p, fp + 3) ELSE p END AS a, p + 2 AS b
    FROM ordered WHERE r <> fr OR p <> fp),
gone AS (
    SELECT r, list_sort(list(DISTINCT i)) AS gone
    FROM (SELECT r, unnest(range(a, b + 1)) AS i FROM spans WHERE a <= b) GROUP BY r)
SELECT d.doc_id, CAST(len(d.lines) AS BIGINT) AS n_lines, CAST(coalesce(len(g.gone), 0) AS BIGINT) AS n_removed,
       CASE WHEN g.gone IS NULL THEN d.text
            ELSE coalesce(array_to_string([d.lines[i] FOR i IN range(1, len(d.lines) + 1)
                                           IF NOT list_contains(g.gone, i)], chr(10)), '') END AS text
FROM docs d LEFT JOIN gone g USING (r)
"""


_UPPER = "".join(map(chr, range(65, 91)))
_WORD = r"[^\x20\x09-\x0D]+"


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


# Conversations read as tool traffic, as the query reads them: links are one turn away.
OP1 = """
WITH m AS (
    SELECT conv_id, turn, text,
           CASE role WHEN 'user' THEN 'tool' ELSE role END AS role,
           CASE role WHEN 'assistant' THEN 'call' WHEN 'user' THEN 'result' ELSE 'message' END AS kind,
           CASE role WHEN 'assistant' THEN 'c' || turn WHEN 'user' THEN 'c' || (turn - 1) END AS call_id
    FROM conversations)
SELECT m.conv_id, row_number() OVER (PARTITION BY m.conv_id ORDER BY m.turn) - 1 AS position, m.turn, m.role, m.kind,
       m.call_id, o.call_id IS NOT NULL AS linked,
       m.call_id IS NOT NULL AND row_number() OVER (PARTITION BY m.conv_id, m.kind, m.call_id ORDER BY m.turn) > 1 AS duplicate,
       CASE WHEN m.kind = 'call' THEN m.text IS NOT NULL END AS valid,
       CASE m.kind
           WHEN 'call' THEN '{"arguments":{"text":' || to_json(m.text) || ',"turn":' || m.turn || '},"call_id":"'
               || m.call_id || '","name":"answer","role":"assistant","turn":' || m.turn || '}'
           WHEN 'result' THEN '{"call_id":"' || m.call_id || '","content":' || to_json(m.text)
               || ',"role":"tool","turn":' || m.turn || '}'
           ELSE '{"content":' || to_json(m.text) || ',"role":"' || m.role || '","turn":' || m.turn || '}'
       END AS json
FROM m LEFT JOIN m o ON o.conv_id = m.conv_id AND o.call_id = m.call_id AND o.kind <> m.kind
"""


def _op4() -> str:
    rows = []
    templates = [(label, phrase, True) for phrase, label in license_scan.BASE]
    templates += [(label, text, False) for label, text in license_scan.NOTICES]
    for number, (label, phrase, base) in enumerate(templates):
        ws = phrase.split()
        k = min(license_scan.GRAM, len(ws))
        rows += [f"({number}, '{label}', {base}, {len(ws)}, {k}, {q}, {_text(ws[q])}, {_text(ws[q + 1])}, "
                 f"{_text(ws[q + 2] if k > 2 else None)})" for q in range(len(ws) - k + 1)]
    return f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
    FROM documents),
grams(tid, label, base, len, k, q, w0, w1, w2) AS (VALUES {", ".join(rows)}),
places AS (
    SELECT r, p, ws[p + 1] AS a0, ws[p + 2] AS a1, ws[p + 3] AS a2
    FROM docs, LATERAL (SELECT unnest(range(len(ws) - 1)) AS p) AS t),
diagonals AS (
    SELECT r, tid, label, base, len, k, p - q AS d, list(DISTINCT q) AS qs
    FROM places JOIN grams ON a0 = w0 AND a1 = w1 AND (w2 IS NULL OR a2 = w2)
    GROUP BY ALL HAVING NOT base OR count(DISTINCT q) = len - k + 1),
far AS (
    SELECT *, CASE WHEN base OR d - coalesce(lag(d) OVER (PARTITION BY r, tid ORDER BY d), -1000000)
                             > {license_scan.SLACK} THEN 1 ELSE 0 END AS new
    FROM diagonals),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY r, tid ORDER BY d) AS span FROM far),
spans AS (
    SELECT r, label, base, len, min(d + list_min(qs)) AS first,
           len(list_distinct(flatten(list(flatten([range(q, q + k) FOR q IN qs]))))) AS covered
    FROM numbered GROUP BY r, tid, label, base, len, k, span),
found AS (
    SELECT r, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word,
           max(first) FILTER (base) AS last_word, max(covered / len) AS score,
           array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
           array_to_string(list_sort(list(DISTINCT label) FILTER (base OR 100 * covered >= {license_scan.COVERED} * len)),
                           ',') AS labels
    FROM spans GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN found USING (r)
"""


def _op10() -> str:
    q = quality_rules
    lower = f"translate(bare, '{_UPPER}', '{_UPPER.lower()}')"
    return f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS lines,
           regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws
    FROM documents),
lines AS (
    SELECT r, i, lines[i] AS line, trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
    FROM docs, LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i) AS u),
judged AS (
    SELECT r, row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS again,
           length(array_to_string(regexp_extract_all(bare, '{_WORD}'), '')) AS chars,
           100 * len(regexp_extract_all(bare, {_text(q.LINE_SYMBOLS)})) > {q.LINE_SYMBOL_SHARE} * length(bare)
           OR (len(regexp_extract_all(bare, '{_WORD}')) < {q.SHORT_LINE}
               AND (NOT regexp_matches(bare, {_text(q.ENDS)}) OR regexp_matches({lower}, {_text(q.NAVIGATION)})
                    OR regexp_matches({lower}, {_text(q.BARS)})))
           OR regexp_matches({lower}, {_text(q.BOILERPLATE)}) AS fails
    FROM lines WHERE bare <> ''),
per_line AS (
    SELECT r, count(*) FILTER (again) AS n_dup_lines, count(*) FILTER (fails) AS n_failed_lines,
           coalesce(sum(chars) FILTER (fails), 0)::BIGINT AS lost_chars
    FROM judged GROUP BY r),
windows AS (
    SELECT r, p, ws[p:p + {q.WINDOW - 1}] AS w
    FROM docs, LATERAL (SELECT unnest(range(1, len(ws) - {q.WINDOW - 2})) AS p) AS u),
repeated AS (SELECT r, p FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1),
covered AS (
    SELECT r, count(DISTINCT x) AS n_repeat_words
    FROM (SELECT r, unnest(range(p, p + {q.WINDOW})) AS x FROM repeated) GROUP BY r),
base AS (
    SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
           len(regexp_extract_all(t, '[{q.SYMBOLS}]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_failed_lines, 0) AS n_failed_lines,
           coalesce(lost_chars, 0) AS lost_chars
    FROM docs LEFT JOIN per_line USING (r) LEFT JOIN covered USING (r))
SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.REPEATED_SHARE} * n_words AS base_failed,
       NOT (n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.REPEATED_SHARE} * n_words)
       AND 100 * lost_chars <= {q.LOST_SHARE} * word_chars AS kept
FROM base
"""


# crc32 of a list of bytes, as a table of 256 values (CTE ``crc``) and an expression over it.
_CRC_TABLE = """crc AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) AS r(i)))"""


def _crc32(text: str) -> str:
    points = (f"flatten(list_transform(string_split({text}, ''), lambda x: CASE WHEN unicode(x) < 128 "
              "THEN [unicode(x)::BIGINT] ELSE [(192 + (unicode(x) >> 6))::BIGINT, (128 + (unicode(x) & 63))::BIGINT] END))")
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {points}), "
            "lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)")


def _longer(path: str, cost: str, letter: str) -> str:
    return f"printf('%09d', left({path}, 9)::INT + {cost}) || substr({path}, 10) || '{letter}'"


# A path is its cost in nine digits and its audit, so the least text is the cheapest path with the least
# audit.  Inserting (5) is never part of it: deleting a message beside the inserted one costs 2, and the pattern holds.
OP11 = rf"""
WITH RECURSIVE {_CRC_TABLE},
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32("k")} % 20 AS h
    FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations), crc),
damaged AS (
    SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
           CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM keyed, LATERAL (SELECT unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END))) AS copies
    WHERE h <> 0),
ordered AS (
    SELECT *, left(role, 1) AS c,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
    FROM damaged),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM ordered),
judged AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                   WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
    FROM numbered),
coded AS (
    SELECT *, fault IN ('', 'truncated') AS may_stay, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more,
           lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS step
    FROM judged),
conv AS (SELECT DISTINCT conv_id FROM conversations),
path AS (
    SELECT conv_id, 0::BIGINT AS i, '000000000' AS p0, NULL::VARCHAR AS p1, NULL::VARCHAR AS p2, NULL::VARCHAR AS p3
    FROM conv
    UNION ALL
    SELECT p.conv_id, r.i, {_longer("p0", "2", "D")},
           least({_longer("p1", "2", "D")}, CASE WHEN may_stay AND c = 's' THEN {_longer("p0", "more", "K")} END),
           least({_longer("p2", "2", "D")},
                 CASE WHEN may_stay AND c = 'u' THEN {_longer("least(p0, p1, p3)", "more", "K")} END,
                 CASE WHEN may_stay THEN {_longer("least(p0, p1, p3)", "1 + more", "R")} END),
           least({_longer("p3", "2", "D")}, CASE WHEN may_stay AND c = 'a' THEN {_longer("p2", "more", "K")} END,
                 CASE WHEN may_stay THEN {_longer("p2", "1 + more", "R")} END)
    FROM path p JOIN coded r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1),
best AS (
    SELECT conv_id, left(arg_max(least(p0, p3), i), 9)::BIGINT AS cost, substr(arg_max(least(p0, p3), i), 10) AS audit
    FROM path GROUP BY conv_id),
stay AS (
    SELECT r.*, substr(b.audit, r.i::INT, 1) AS edit,
           row_number() OVER (PARTITION BY r.conv_id ORDER BY r.i) AS k,
           first_value(c = 's' AND substr(b.audit, r.i::INT, 1) = 'K') OVER (PARTITION BY r.conv_id ORDER BY r.i) AS headed
    FROM coded r JOIN best b ON r.conv_id IS NOT DISTINCT FROM b.conv_id
    WHERE substr(b.audit, r.i::INT, 1) <> 'D'),
repaired AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (k - headed::INT) % 2 = 1 THEN 'user'
                                    ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i) AS lines
    FROM stay GROUP BY conv_id),
counts AS (
    SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count_if(fault = 'blank') AS blank,
           count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
           count_if(step IS NOT NULL AND step NOT IN ('su', 'ua', 'au')) AS illegal
    FROM coded GROUP BY conv_id)
SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, cost, audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM best b LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN repaired l ON l.conv_id IS NOT DISTINCT FROM b.conv_id
"""


def _op12() -> str:
    rules = ", ".join(f"('{action}', '{rule}')" for action, rule in url_filter.RULES)
    labels = ", ".join(f"'{label}'" for label in url_filter.LABELS)
    return rf"""
WITH rules AS (
    SELECT action, rule, split_part(rule, '/', 1) AS rh, substr(rule, strpos(rule, '/')) AS rp
    FROM (VALUES {rules}) AS v(action, rule)),
parsed AS (
    SELECT page_id, row_number() OVER () AS r,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_UPPER.lower()}') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
best AS (
    SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
    FROM parsed JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
    GROUP BY r)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN list_has_any(string_split(host, '.'), [{labels}]) THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed LEFT JOIN best USING (r)
"""


# Two words of one length are near if they are equal without the characters of one place.
OP13 = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
           unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[A-Za-zÀ-ÿ]{{7,}}')) AS run
    FROM documents),
hashed AS (
    SELECT run, m, {_crc32("k")} AS h
    FROM (SELECT run, id || ':' || run AS k, count(*) AS m FROM runs GROUP BY ALL), crc),
damaged AS (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, m
    FROM hashed),
words AS (SELECT word, sum(m)::BIGINT AS n FROM damaged WHERE length(word) >= 7 GROUP BY word HAVING sum(m) >= 2),
cuts AS (
    SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
    FROM words, LATERAL (SELECT unnest(range(length(word))) AS i) AS places),
near AS (
    SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b USING (i, rest) WHERE a.word <> b.word
    UNION SELECT w.word, c.word, c.n FROM words w JOIN cuts c ON c.rest = w.word
    UNION SELECT c.word, w.word, w.n FROM words w JOIN cuts c ON c.rest = w.word),
best AS (
    SELECT word, count(*) AS n_near, max(n) AS other_n FROM near GROUP BY word),
least_best AS (
    SELECT b.word, min(x.other) AS other FROM best b JOIN near x ON x.word = b.word AND x.n = b.other_n GROUP BY b.word),
formed AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 10 * w.n THEN l.other END AS form,
           CASE WHEN b.other_n >= 10 * w.n THEN b.other_n END AS form_n
    FROM words w LEFT JOIN best b USING (word) LEFT JOIN least_best l USING (word)),
chain AS (
    SELECT word, word AS last_word, 0 AS steps FROM formed
    UNION ALL SELECT c.word, f.form, steps + 1 FROM chain c JOIN formed f ON f.word = c.last_word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near::BIGINT AS n_near, f.form_n
FROM formed f JOIN (SELECT word, arg_max(last_word, steps) AS root FROM chain GROUP BY word) r USING (word)
"""


def oracle_sql() -> dict[str, str]:
    """Name of a query to its SQL."""
    return {"op1_chat_formatting": OP1, "op4_license_scan": _op4(), "op9_line_dedup": OP9,
            "op10_quality_rules": _op10(), "op11_conversation_repair": OP11, "op12_url_filter": _op12(),
            "op13_spelling_variants": OP13}
