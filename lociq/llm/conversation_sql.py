"""SQL of op11 to op13 for DuckDB, written from their contracts and not from the operators."""

from __future__ import annotations

#: A table of one row: the 256 remainders by which crc32 takes a byte at a time.
_REMAINDERS = "remainders AS (SELECT list(r ORDER BY b) AS tab FROM (SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS r FROM range(256) bytes(b)))"


def _crc32(text: str) -> str:
    """crc32 of ASCII text, where ``tab`` is in reach."""
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_NONE = "{'c': 1000000000::BIGINT, 's': '', 'o': []::VARCHAR[]}"


def _add(w: str, cost: str, label: str, *lines: str) -> str:
    said = f"list_concat({w}.o, [{', '.join(lines)}])" if lines else f"{w}.o"
    return f"{{'c': {w}.c + {cost}, 's': {w}.s || '{label}', 'o': {said}}}"


def _least(*weights: str) -> str:
    return f"list_sort([{', '.join(weights)}])[1]"


def _inserts(w: str) -> str:
    """The four best weights after any inserts: nothing said yet (0), after the system (1), the user (2), the assistant (3)."""
    u, a = "'user:'", "'assistant:'"
    return (
        f"{w}0 AS c0, {w}1 AS c1, {_least(f'{w}2', *(_add(f'{w}{i}', '3', 'I', u) for i in (0, 1, 3)))} AS c2, "
        f"{_least(f'{w}3', _add(f'{w}2', '3', 'I', a), *(_add(f'{w}{i}', '6', 'II', u, a) for i in (0, 1)))} AS c3"
    )


def _arc(when: str, weight: str) -> str:
    return f"CASE WHEN {when} THEN {weight} ELSE {_NONE} END"


_KEPT, _U, _A = "role || ':' || text", "'user:' || text", "'assistant:' || text"
_TURN = ", ".join(
    [
        f"{_add('c0', '4', 'D')} AS w0",
        _least(_add("c1", "4", "D"), _arc("NOT gone AND initial = 's'", _add("c0", "extra", "K", _KEPT))) + " AS w1",
        _least(_add("c2", "4", "D"), *(_arc("NOT gone AND initial = 'u'", _add(f"c{i}", "extra", "K", _KEPT)) for i in (0, 1, 3)), *(_arc("NOT gone", _add(f"c{i}", "extra + 3", "R", _U)) for i in (0, 1, 3))) + " AS w2",
        _least(_add("c3", "4", "D"), _arc("NOT gone AND initial = 'a'", _add("c2", "extra", "K", _KEPT)), _arc("NOT gone", _add("c2", "extra + 3", "R", _A))) + " AS w3",
    ]
)

REPAIR = f"""
WITH RECURSIVE {_REMAINDERS},
fates AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fate FROM conversations, remainders),
damaged AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy FROM fates WHERE fate <> 0),
placed AS (SELECT conv_id, turn, role, text, left(role, 1) AS initial, trim(text, {_WHITE}) AS bare, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(role || ':' || text)) AS k FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS repeated FROM placed),
judged AS (SELECT *, bare = '' AS blank, bare <> '' AND repeated AS duplicate, bare <> '' AND NOT repeated AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated, lag(initial) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM seen),
said AS (SELECT *, blank OR duplicate AS gone, CASE WHEN truncated THEN 3 ELSE 0 END AS extra FROM judged),
counted AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated,
                   count(*) FILTER (WHERE k > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM said GROUP BY conv_id),
started AS (SELECT conv_id, {{'c': 0::BIGINT, 's': '', 'o': []::VARCHAR[]}} AS w0, {_NONE} AS w1, {_NONE} AS w2, {_NONE} AS w3 FROM counted),
paths AS (SELECT conv_id, 0::BIGINT AS k, {_inserts("w")} FROM started
          UNION ALL
          SELECT conv_id, k, {_inserts("w")} FROM (SELECT s.conv_id, s.k, {_TURN} FROM paths p JOIN said s ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.k = p.k + 1) t),
best AS (SELECT p.conv_id, {_least("c0", "c3")} AS w FROM paths p JOIN counted n ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.n = p.k)
SELECT o.conv_id, coalesce(n.gaps, 0) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate, coalesce(n.truncated, 0) AS truncated, coalesce(n.illegal, 0) AS illegal,
       coalesce(b.w.c, 0) AS cost, coalesce(b.w.s, '') AS audit, sha256(coalesce(array_to_string(b.w.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id"""

TRIE = f"""
WITH RECURSIVE {_REMAINDERS},
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
coded AS (SELECT *, sha256(length(role) || ':' || role || text) AS code FROM t),
own AS (SELECT conv_id, code, length(text) AS chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, code) AS k FROM coded),
convs AS (SELECT conv_id, conv_id - ((conv_id % 100) + 100) % 100 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h, n FROM (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id), remainders),
takes AS (SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS taken FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
turns AS (SELECT c.conv_id, o.k AS d, o.code, o.chars FROM takes c JOIN own o ON o.conv_id = c.base AND o.k <= c.h
          UNION ALL SELECT c.conv_id, c.taken + o.k - c.h, o.code, o.chars FROM takes c JOIN own o ON o.conv_id = c.conv_id AND o.k > c.h),
members AS (SELECT conv_id, d, '/' || string_agg(code, '/') OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS path, chars FROM turns UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
lengths AS (SELECT conv_id, max(d) AS last FROM members GROUP BY conv_id),
nodes AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = last), '') AS ends FROM members JOIN lengths USING (conv_id) GROUP BY path, d),
fans AS (SELECT left(path, length(path) - 65) AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
whole AS (SELECT n.*, coalesce(f.n_children, 0) AS n_children FROM nodes n LEFT JOIN fans f ON f.path = n.path),
up AS (SELECT left(path, 65 * i) AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum((n - 1) * chars) AS BIGINT) AS saved_tokens FROM (SELECT *, unnest(range(0, d + 1)) AS i FROM whole) GROUP BY 1)
SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n AS n_convs, w.n_children, u.n_leaves, u.saved_tokens, sha256(w.ends) AS ends_sha256
FROM whole w JOIN up u ON u.path = w.path LEFT JOIN whole p ON w.d > 0 AND p.path = left(w.path, greatest(length(w.path) - 65, 0))"""

#: For pages that mark their article, as all of these tables do, hold headings and paragraphs in it, and use the named references of XML alone there.
MAIN_TEXT = """
WITH marked AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS inner_html FROM pages),
parts AS (SELECT page_id, url, list_transform(regexp_split_to_array(inner_html, '</?(p|h1)>'), lambda x: regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g')) AS parts FROM marked),
plain AS (SELECT page_id, url, list_transform(parts, lambda x: replace(replace(replace(replace(regexp_replace(x, '&quot;?', '"', 'g'), '&apos;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS parts FROM parts),
trimmed AS (SELECT page_id, url, list_filter(list_transform(plain.parts, lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '') AS parts FROM plain)
SELECT page_id, url, array_to_string(parts, chr(10) || chr(10)) AS text, CAST(length(array_to_string(parts, chr(10) || chr(10))) AS BIGINT) AS n_chars FROM trimmed"""
