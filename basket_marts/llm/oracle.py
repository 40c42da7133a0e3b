"""DuckDB SQL for the numbered operators that SQL can express, by query name.

Written from the operators' definitions, not from their plans: no digests stand for texts,
no candidate search precedes a comparison.
"""

from __future__ import annotations

import string

from basket_marts.llm import licenses, line_dedup, minhash_join, ngram_join

ORACLE: dict[str, str] = {}


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_NEEDED = (
    f"CASE WHEN len(tokens) >= {line_dedup.LONG_TOKENS} THEN {line_dedup.LONG_MIN_DOCS} "
    f"ELSE {line_dedup.MIN_DOCS} END"
)


def _run_start(i: str) -> str:
    n_runs = f"(len(tokens) - ceil({line_dedup.SIMILARITY} * len(tokens)) + 1)"
    lead = line_dedup.LEADING_TOKENS
    return f"CAST({lead} + 1 + floor({i} * (len(tokens) - {lead}) / {n_runs}) AS BIGINT)"


def _with_runs(source: str) -> str:
    """Each row of `source` once for every run of its tokens behind the leading ones."""
    n_runs = f"CAST(len(tokens) - ceil({line_dedup.SIMILARITY} * len(tokens)) + 1 AS BIGINT)"
    run = f"array_to_string(tokens[{_run_start('nth')} : {_run_start('(nth + 1)')} - 1], ' ')"
    return f"(SELECT *, {run} AS run FROM (SELECT *, unnest(range({n_runs})) AS nth FROM {source}))"


def _alike(tokens: str, shown: str) -> str:
    same = f"list_transform(list_zip({tokens}, {shown}), lambda x: CAST(x[1] = x[2] AS INT))"
    return f"list_sum({same}) >= {line_dedup.SIMILARITY} * len({tokens})"


ORACLE["op1_line_dedup"] = rf"""
    WITH masked AS (
        SELECT doc_id, coalesce(text, '') AS text,
               string_split(regexp_replace(trim(regexp_replace(regexp_replace(
                   coalesce(text, ''), '[^\S\n]+', ' ', 'g'), ' ?\n ?', chr(10), 'g')),
                   '\S*[0-9]\S*', '<*>', 'g'), chr(10)) AS masked
        FROM documents),
    lines AS (
        SELECT line, string_split(line, ' ') AS tokens, count(*) AS n_docs,
               min(doc_id) AS first_doc, max(doc_id) AS last_doc
        FROM (SELECT DISTINCT doc_id, unnest(masked) AS line FROM masked)
        WHERE line <> '' GROUP BY line),
    leaved AS (
        SELECT *, {_NEEDED} AS needed,
               len(tokens) || ' ' || array_to_string(tokens[1:{line_dedup.LEADING_TOKENS}], ' ') AS leaf
        FROM lines WHERE len(tokens) >= {line_dedup.MIN_TOKENS}),
    placed AS (
        SELECT leaf, line, n_docs, needed, unnest(tokens) AS token,
               unnest(range(1, len(tokens) + 1)) AS place
        FROM leaved),
    fixed AS (
        SELECT leaf, place, token FROM placed GROUP BY leaf, place, token, needed
        HAVING sum(n_docs) >= needed),
    templates AS (
        SELECT p.leaf, p.line,
               string_agg(coalesce(f.token, '{line_dedup.FIELD}'), ' ' ORDER BY p.place) AS template
        FROM placed p LEFT JOIN fixed f USING (leaf, place, token)
        GROUP BY p.leaf, p.line
        HAVING count(f.token) >= {line_dedup.SIMILARITY} * count(*)),
    recurring AS (
        SELECT leaf, template, string_split(template, ' ') AS tokens, sum(n_docs) AS n_docs,
               min(first_doc) AS keeper
        FROM templates JOIN leaved USING (leaf, line) GROUP BY leaf, template, needed
        HAVING sum(n_docs) >= needed AND max(last_doc) > min(first_doc)),
    same AS (SELECT line, keeper FROM templates JOIN recurring USING (leaf, template)),
    rare AS (SELECT * FROM leaved WHERE line NOT IN (SELECT line FROM same)),
    centres AS (
        SELECT leaf, nth, run, template, keeper FROM {_with_runs("recurring")}
        QUALIFY row_number() OVER (PARTITION BY leaf, nth, run ORDER BY n_docs DESC, template) = 1),
    variants AS (
        SELECT line, keeper FROM {_with_runs("rare")} JOIN centres USING (leaf, nth, run)
        WHERE {_alike("tokens", "string_split(template, ' ')")}),
    most AS (
        SELECT leaf, place, CASE WHEN sum(n_docs) >= needed THEN token ELSE '{line_dedup.FIELD}' END AS shown
        FROM placed WHERE line IN (SELECT line FROM rare) GROUP BY leaf, place, token, needed
        QUALIFY row_number() OVER (PARTITION BY leaf, place ORDER BY sum(n_docs) DESC, token DESC) = 1),
    consensus AS (SELECT leaf, list(shown ORDER BY place) AS shown FROM most GROUP BY leaf),
    gathered AS (SELECT * FROM rare JOIN consensus USING (leaf) WHERE {_alike("tokens", "shown")}),
    together AS (
        SELECT leaf, min(first_doc) AS keeper FROM gathered GROUP BY leaf, needed
        HAVING sum(n_docs) >= needed AND max(last_doc) > min(first_doc)),
    dropped AS (
        SELECT line, min(keeper) AS keeper FROM (
            SELECT line, first_doc AS keeper FROM lines WHERE n_docs >= {_NEEDED}
            UNION ALL SELECT * FROM same
            UNION ALL SELECT * FROM variants
            UNION ALL SELECT line, keeper FROM gathered JOIN together USING (leaf))
        GROUP BY line),
    gone AS (
        SELECT doc_id, list(line) AS gone
        FROM (SELECT DISTINCT doc_id, unnest(masked) AS line FROM masked)
        JOIN dropped USING (line) WHERE doc_id <> keeper GROUP BY doc_id),
    kept AS (
        SELECT doc_id, string_split(text, chr(10)) AS line,
               list_filter(range(1, len(masked) + 1),
                   lambda i: NOT list_contains(coalesce(gone, []), masked[i])) AS places
        FROM masked LEFT JOIN gone USING (doc_id)),
    texts AS (
        SELECT doc_id, len(line) AS n_lines, len(line) - len(places) AS n_dropped,
               coalesce(array_to_string(list_transform(places, lambda i: line[i]), chr(10)), '') AS kept
        FROM kept)
    SELECT doc_id, n_lines, n_dropped, CAST(length(kept) AS BIGINT) AS kept_chars,
           sha256(kept) AS kept_sha256
    FROM texts"""

ORACLE["op2_warc"] = """
    WITH hashed AS (
        SELECT page_id, sha1(coalesce(html, '')) AS payload_digest,
               CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes
        FROM pages),
    originals AS (
        SELECT payload_digest, payload_bytes, max(page_id) AS original
        FROM hashed WHERE payload_bytes >= 1000 GROUP BY ALL)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN refers THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN refers THEN original END AS refers_to
    FROM (SELECT *, original IS NOT NULL AND (page_id IS NULL OR page_id < original) AS refers
          FROM hashed LEFT JOIN originals USING (payload_digest, payload_bytes))"""


# Shingles as text; of each text and item that share any, windows at every start in full.
ORACLE["op6_decontaminate"] = rf"""
    WITH texts AS (
        SELECT 'd' AS kind, doc_id AS id, text FROM documents
        UNION ALL SELECT 'b', item_id, text FROM benchmark),
    worded AS (
        SELECT kind, id, string_split(trim(regexp_replace(lower(coalesce(text, '')),
                   '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS words
        FROM texts),
    items AS (
        SELECT id AS item_id, words, len(words) AS length, least(len(words), 5) AS width
        FROM worded WHERE kind = 'b' AND words <> ['']),
    item_shingles AS (
        SELECT item_id, length, width, place,
               array_to_string(words[place + 1 : place + width], ' ') AS shingle
        FROM (SELECT *, unnest(range(0, length - width + 1)) AS place FROM items)),
    doc_shingles AS (
        SELECT id AS doc_id, n_words, width, place,
               array_to_string(words[place + 1 : place + width], ' ') AS shingle
        FROM (SELECT id, words, len(words) AS n_words, width,
                     unnest(range(0, len(words) - width + 1)) AS place
              FROM worded, (SELECT DISTINCT width FROM items)
              WHERE kind = 'd' AND words <> [''])),
    windows AS (
        SELECT *, unnest(range(greatest(n_words - length, 0) + 1)) AS start FROM (
            SELECT DISTINCT d.doc_id, d.n_words, i.item_id, i.length, d.width
            FROM doc_shingles d JOIN item_shingles i USING (width, shingle))),
    window_weights AS (
        SELECT w.doc_id, w.item_id, w.start, w.width, d.shingle, count(*) AS weight
        FROM windows w JOIN doc_shingles d ON d.doc_id = w.doc_id AND d.width = w.width
            AND d.place >= w.start AND d.place <= w.start + w.length - w.width
        GROUP BY ALL),
    item_weights AS (
        SELECT item_id, shingle, count(*) AS weight FROM item_shingles GROUP BY ALL),
    sizes AS (
        SELECT doc_id, item_id, start, sum(weight) AS size FROM window_weights GROUP BY ALL),
    shared AS (
        SELECT w.doc_id, w.item_id, w.start, sum(least(w.weight, i.weight)) AS overlap
        FROM window_weights w JOIN item_weights i USING (item_id, shingle) GROUP BY ALL),
    item_sizes AS (SELECT item_id, count(*) AS item_size FROM item_shingles GROUP BY item_id),
    compared AS (
        SELECT doc_id, item_id, CAST(start AS INT) AS start,
               CAST(overlap AS DOUBLE) / CAST(size + item_size - overlap AS DOUBLE) AS similarity
        FROM shared JOIN sizes USING (doc_id, item_id, start) JOIN item_sizes USING (item_id))
    SELECT doc_id, item_id, similarity, start FROM compared WHERE similarity >= 0.75
    QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1"""


def _canonical(text: str) -> str:
    found = f"regexp_replace(lower(coalesce({text}, '')), {_literal(licenses.COPYRIGHT_LINE)}, '', 'g')"
    found = rf"regexp_replace({found}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
    for one, other in licenses.SPELLINGS:
        found = f"replace({found}, {_literal(one)}, {_literal(other)})"
    return f"regexp_replace({found}, '(?m)^ +| +$', '', 'g')"


def _one_line(lines: str) -> str:
    return rf"trim(regexp_replace({lines}, '\s+', ' ', 'g'))"


ORACLE["op9_licenses"] = rf"""
    WITH texts(license_id, text) AS (VALUES
        {", ".join(f"({_literal(i)}, {_literal(t)})" for i, t in licenses.known_licences())}),
    known AS (
        SELECT {_one_line(_canonical("text"))} AS unit, min(license_id) AS license_id
        FROM texts GROUP BY unit),
    canonical AS (SELECT doc_id, {_canonical("text")} AS lines FROM documents),
    units AS (
        SELECT doc_id, {_one_line("lines")} AS whole, {_one_line("lines")} AS unit FROM canonical
        UNION
        SELECT doc_id, {_one_line("lines")}, unnest(string_split(lines, chr(10))) FROM canonical
        UNION
        SELECT doc_id, {_one_line("lines")}, trim(regexp_replace(
            unnest(string_split_regex(lines, '\n{{2,}}')), '\s+', ' ', 'g'))
        FROM canonical)
    SELECT doc_id, license_id, CASE WHEN unit = whole THEN 'text' ELSE 'part' END AS scope,
           count(DISTINCT unit) AS n_units
    FROM units JOIN known USING (unit) GROUP BY ALL"""


def _near_copies(percent: int, columns: str) -> str:
    """Shingles as text, every pair of texts that shares any, and all that links reach."""
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    return rf"""
    WITH RECURSIVE worded AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                   '[^\x20\x09-\x0D]+') AS words
        FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, unnest(CASE
                   WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3),
                       lambda i: array_to_string(words[i:i + 4], ' '))
                   WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle
        FROM worded),
    sizes AS (SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id),
    pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS overlap
        FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        GROUP BY ALL),
    links AS (
        SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * overlap >= {percent} * (x.size + y.size - overlap)),
    reach AS (
        SELECT doc_id, doc_id AS other FROM documents
        UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
    components AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, coalesce(size, 0) AS n_shingles, component_id{columns}
    FROM components LEFT JOIN sizes USING (doc_id)"""


ORACLE["op7_ngram_join"] = _near_copies(ngram_join.PERCENT, "")
ORACLE["op12_minhash_join"] = _near_copies(
    minhash_join.PERCENT, ", doc_id = component_id AS kept"
)


# Prefixes as lists of turns, every node joined to all its ancestors. CRC-32 bit by bit.
_CRC_STEP = "(CASE WHEN i % 8 = 0 THEN xor(crc, ascii(digits[i // 8 + 1])) ELSE crc END)"
ORACLE["op11_prefix_trie"] = f"""
    WITH own AS (
        SELECT conv_id, CAST(conv_id AS VARCHAR) AS digits,
               list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                    ORDER BY turn NULLS FIRST) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    drawn AS (
        SELECT *, xor(4294967295, list_reduce(
                   list_prepend(CAST(4294967295 AS BIGINT), range(8 * length(digits))),
                   lambda crc, i: xor({_CRC_STEP} >> 1, ({_CRC_STEP} & 1) * 3988292384))) % 6 AS h
        FROM own),
    rebuilt AS (
        SELECT c.conv_id, list_concat(coalesce(b.turns[1:h], []), c.turns[h + 1:]) AS path
        FROM drawn c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
    nodes AS (
        SELECT depth, path[1:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
               list(conv_id ORDER BY conv_id) FILTER (len(path) = depth) AS ends
        FROM (SELECT *, unnest(range(len(path) + 1)) AS depth FROM rebuilt)
        GROUP BY depth, prefix),
    children AS (
        SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n_children
        FROM nodes WHERE depth > 0 GROUP BY ALL),
    counted AS (
        SELECT n.*, coalesce(n_children, 0) AS n_children
        FROM nodes n LEFT JOIN children USING (depth, prefix)),
    subtrees AS (
        SELECT above AS depth, prefix[1:above] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves,
               sum((n_convs - 1) * coalesce(length(prefix[depth].text), 0)) AS saved
        FROM (SELECT *, unnest(range(depth + 1)) AS above FROM counted) GROUP BY ALL)
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
           CAST(saved AS BIGINT) AS saved_tokens,
           sha256(coalesce(array_to_string(n.ends, ','), '')) AS ends_sha256
    FROM counted n JOIN subtrees USING (depth, prefix)
    LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]"""


# Lists of lines, cut and joined; nothing is rotated, and the text itself is what must come back.
ORACLE["op13_fill_in_middle"] = r"""
    WITH drawn AS (
        SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS digest,
               regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
        FROM documents),
    cut AS (
        SELECT *, len(units) AS n,
               CAST('0x' || digest[1:8] AS UBIGINT) % (len(units) + 1) AS a,
               CAST('0x' || digest[9:16] AS UBIGINT) % (len(units) + 1) AS b,
               CAST('0x' || digest[25:32] AS UBIGINT) % 100 AS which,
               text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                   OR contains(text, '<M>') AS plain
        FROM drawn),
    parts AS (
        SELECT *, coalesce(array_to_string(units[1:least(a, b)], ''), '') AS prefix,
               coalesce(array_to_string(units[least(a, b) + 1:greatest(a, b)], ''), '') AS middle,
               coalesce(array_to_string(units[greatest(a, b) + 1:], ''), '') AS suffix
        FROM cut)
    SELECT doc_id, CAST(n AS BIGINT) AS n,
           CASE WHEN plain THEN 'plain' WHEN which < 50 THEN 'spm' ELSE 'psm' END AS form,
           CASE WHEN NOT plain THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
           CASE WHEN NOT plain THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
           sha256(CASE WHEN plain THEN text
                  WHEN which < 50 THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                  ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM parts"""
