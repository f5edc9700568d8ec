"""DuckDB statements for the queries of this subpackage that SQL can express.

Each restates the query's contract over the given tables, whose doc_ids and page_ids are distinct and
whose conversations hold a turn once.
"""
from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _low(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


_WORD = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

SUBSTRING = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM rep),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN cov USING (doc_id, p) GROUP BY doc_id),
gone AS (SELECT doc_id, count(*) AS n FROM cov GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)"""

NEAR_DEDUP = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_low('text')}, {_WORD}) AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
meet AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM meet JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
reach AS (SELECT DISTINCT x AS a, x AS b FROM link UNION SELECT r.a, l.y FROM reach r JOIN link l ON r.b = l.x),
comp AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id, coalesce(c, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)"""

DECONTAMINATION = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_low('text')}, {_ALNUM}) AS w FROM benchmark),
win AS (SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS k FROM (
  SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT item, w, least(13, len(w)) AS m FROM item WHERE len(w) > 0))),
d AS (SELECT doc_id, regexp_extract_all({_low('text')}, {_ALNUM}) AS w FROM documents),
spot AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS k FROM (
  SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM win))),
hit AS (SELECT doc_id, spot.m, i, item FROM spot JOIN win ON spot.m = win.m AND spot.k = win.k),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM hit WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)"""

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _put(cost: str, edit: str, rest: str, row: str | None = None) -> str:
    """An edit before the best way ``rest``; ``row`` is the repaired row that it makes."""
    made = f"list_prepend({row}, {rest}.r)" if row else f"{rest}.r"
    return f"{{'c': {rest}.c + {cost}, 's': '{edit}' || {rest}.s, 'r': {made}}}"


def _row_step(q: int) -> str:
    """The best way from state q that edits the row at hand (see ``conversations.step``)."""
    forced, name = ((3, "assistant") if q == 2 else (2, "user"))
    kept = {0: [("s", 1), ("u", 2)], 1: [("u", 2)], 2: [("a", 3)], 3: [("u", 2)]}[q]
    stays = "fault IN (0, 3)"
    extra = "CASE WHEN fault = 3 THEN 3 ELSE 0 END"
    options = [_put("4", "D", f"b{q}"),
               f"CASE WHEN {stays} THEN {_put(f'3 + {extra}', 'R', f'b{forced}', f''''{name}:' || text''')} END"]
    options += [f"CASE WHEN {stays} AND left(role, 1) = '{i}' THEN {_put(extra, 'K', f'b{to}', '''role || ':' || text''')} END" for i, to in kept]
    return _least(*options)


def _insert(q: int, to: str) -> str:
    return _put("3", "I", to, "'assistant:'" if q == 2 else "'user:'")


CONVERSATIONS = f"""
WITH RECURSIVE bits AS (SELECT i AS n, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                                 lambda x: CAST(ascii(x) AS BIGINT)),
                  lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS k
  FROM conversations, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy FROM raw WHERE k <> 0),
placed AS (SELECT conv_id, turn, role, text, rtrim(text, {_SPACES}) AS body,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM damaged),
rows AS (SELECT conv_id, turn, role, text, i,
    CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
         WHEN right(body, 1) IN ('.', '!', '?') THEN 0 ELSE 3 END AS fault,
    left(role, 1) || left(lead(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS pair FROM placed),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
    count(*) FILTER (WHERE fault = 3) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM rows GROUP BY conv_id),
dp AS (SELECT conv_id, n + 1 AS i, {{'c': 0, 's': '', 'r': CAST([] AS VARCHAR[])}} AS b0, {{'c': 6, 's': 'II', 'r': ['user:', 'assistant:']}} AS b1,
    {{'c': 3, 's': 'I', 'r': ['assistant:']}} AS b2, {{'c': 0, 's': '', 'r': CAST([] AS VARCHAR[])}} AS b3 FROM counts
  UNION ALL
  SELECT conv_id, i, {_least('e0', _insert(0, 'x2'))}, {_least('e1', _insert(1, 'x2'))}, x2, x3 FROM (
    SELECT conv_id, i, e0, e1, {_least('e2', _insert(2, 'e3'))} AS x2, {_least('e3', _insert(3, 'e2'))} AS x3 FROM (
      SELECT dp.conv_id, rows.i, {', '.join(f'{_row_step(q)} AS e{q}' for q in range(4))}
      FROM dp JOIN rows ON dp.conv_id IS NOT DISTINCT FROM rows.conv_id AND dp.i = rows.i + 1))),
best AS (SELECT conv_id, b0 FROM dp WHERE i = 1)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(b0.c, 0) AS BIGINT) AS cost, coalesce(b0.s, '') AS audit,
       sha256(coalesce(array_to_string(b0.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id"""

PHRASES = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_low('text')}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, g, count(*) AS f FROM (
  SELECT lang, k, w[i:i + k - 1] AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k)))
  GROUP BY ALL),
c AS (SELECT * FROM g WHERE k > 1 AND f >= 30),
inner_parts AS (SELECT lang, g[i:i + m - 1] AS g, f FROM (
  SELECT lang, g, f, k, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c))),
closed AS (SELECT DISTINCT c.lang, c.g FROM c JOIN inner_parts p ON c.lang = p.lang AND c.g = p.g WHERE 100 * p.f >= 80 * c.f),
cuts AS (SELECT lang, g, k, f, unnest(range(1, k)) AS cut FROM c ANTI JOIN closed USING (lang, g)),
scored AS (SELECT cuts.lang, cuts.g, cuts.f AS a, cut, l.f AS l, r.f AS r,
    CAST((CAST(2000000 AS HUGEINT) * cuts.f) // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
  FROM cuts JOIN g l ON l.lang = cuts.lang AND l.g = cuts.g[1:cut] JOIN g r ON r.lang = cuts.lang AND r.g = cuts.g[cut + 1:cuts.k]),
low AS (SELECT *, array_to_string(g, ' ') AS phrase FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score, CAST(cut AS INTEGER) AS cut
FROM low JOIN n USING (lang) QUALIFY rank <= 2000"""

_LETTERS = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> {s}) & 31 AS INTEGER) + 1, 1)"
WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT page_id, html, list_transform(range(8), lambda i: CAST('0x' || substr(h, CAST(i * 5 + 1 AS INTEGER), 5) AS INTEGER)) AS five FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(five, lambda v: {' || '.join(_LETTERS.format(s=s) for s in (15, 10, 5, 0))}), '') AS payload_digest,
       CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
FROM b WINDOW same AS (PARTITION BY html)"""

SQL = {
    "op2_substring_dedup": SUBSTRING,
    "op3_near_dedup": NEAR_DEDUP,
    "op8_decontamination": DECONTAMINATION,
    "op11_conversation_repair": CONVERSATIONS,
    "op12_phrases": PHRASES,
    "op13_warc": WARC,
}
