"""DuckDB SQL for the queries that SQL can express; the others are tested by brute force."""

from __future__ import annotations

from .urls import RULES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP1 = f"""
WITH items AS (SELECT cast(item_id AS varchar) AS item, {_WORDS} AS w FROM benchmark),
sized AS (SELECT *, least(13, len(w)) AS n FROM items WHERE len(w) > 0),
places AS (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized),
windows AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM places),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
spots AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
  FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (SELECT doc_id, i, spots.n, item FROM spots JOIN windows ON windows.n = spots.n
  AND s = array_to_string(list_slice(w, i, i + spots.n - 1), ' ')),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
bits AS (SELECT *, array_to_string(list_transform(range(1, 41),
  lambda i: format('{:04b}', strpos('0123456789abcdef', x[i]) - 1)), '') AS b FROM p),
named AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first,
  array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
    1 + 16 * cast(b[5 * i + 1] AS int) + 8 * cast(b[5 * i + 2] AS int)
    + 4 * cast(b[5 * i + 3] AS int) + 2 * cast(b[5 * i + 4] AS int)
    + cast(b[5 * i + 5] AS int)]), '') AS d FROM bits)
SELECT page_id, strlen(h) AS payload_bytes, d AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM named
"""

OP3 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n
  FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS p FROM d)),
hits AS (SELECT doc_id, p FROM w JOIN (SELECT s, min(doc_id) AS first FROM w GROUP BY s) USING (s)
  WHERE first < doc_id),
marked AS (SELECT *, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 50, true) AS new
  FROM hits),
numbered AS (SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END)
  OVER (PARTITION BY doc_id ORDER BY p) AS k FROM marked),
runs AS (SELECT doc_id, k, min(p) AS a, max(p) + 50 AS b FROM numbered GROUP BY doc_id, k),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before
  FROM runs),
kept AS (SELECT doc_id, count(*) AS n_spans, cast(sum(b - a) AS bigint) AS n_removed,
  string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head, max(b) AS rest
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(rest, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
_ATTRIBUTE = r"""\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""


def _attribute(name: str) -> str:
    return " || ".join(f"regexp_extract(tag, '(?is)[\\s\"'']{name}{_ATTRIBUTE}', {k})"
                       for k in (1, 2, 3))


def _split(url: str) -> str:
    return (f"translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}')"
            f" AS host, regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path")


_TAG_END = r"""(?:[^>"'']|"[^"]*"|''[^'']*'')*>"""
_RAW = "|".join(rf"<{t}\b{_TAG_END}.*?(?:</{t}\b[^>]*>|\z)" for t in (
    "script", "style", "textarea", "title", "noscript", "iframe", "template"))
_SCHEME = "[A-Za-z][A-Za-z0-9+.-]*:"
_ROOT = f"(?s)^({_SCHEME})(//[^/?]*)([^?]*)"
_URL = f"(?s)^({_SCHEME}//)((?:[^/?]*@)?)([^/?]*)([^?]*)(.*)$"


def _decoded(value: str) -> str:
    """Character references that the pages may hold, `&` last."""
    for name, letter in (("&eacute;", "é"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"),
                         ("&#38;", "&"), ("&#x26;", "&"), ("&amp;", "&")):
        value = f"replace({value}, '{name}', '{letter}')"
    return rf"regexp_replace({value}, '^[ \t\n\f\r]+|[ \t\n\f\r]+$', '', 'g')"


def _resolved(target: str, base: str) -> str:
    """RFC 3986, without dot segments."""
    part = {k: f"regexp_extract({base}, '{_ROOT}', {k})" for k in (1, 2, 3)}
    return f"""CASE WHEN regexp_matches({target}, '^{_SCHEME}//') THEN {target}
  WHEN regexp_matches({target}, '^{_SCHEME}') OR NOT regexp_matches({base}, '{_ROOT}') THEN NULL
  WHEN starts_with({target}, '//') THEN {part[1]} || {target}
  WHEN starts_with({target}, '/') THEN {part[1]} || {part[2]} || {target}
  WHEN starts_with({target}, '?') THEN {part[1]} || {part[2]} || {part[3]} || {target}
  WHEN starts_with({target}, '#') THEN {base}
  ELSE {part[1]} || {part[2]} || coalesce(nullif(regexp_extract({part[3]}, '(?s)^(.*/)', 1), ''),
    '/') || {target} END"""


def _alias(url: str) -> str:
    """Without fragment; scheme and host in lower case, dot segments resolved."""
    bare = f"regexp_replace({url}, '(?s)#.*$', '')"
    part = {k: f"regexp_extract({bare}, '{_URL}', {k})" for k in range(1, 6)}
    path = rf"regexp_replace({part[4]}, '/(\.\.?)$', '/\1/')"
    dots = f"""list_reduce(string_split({path}, '/'), lambda x, y: CASE y WHEN '.' THEN x
    WHEN '..' THEN regexp_replace(x, '/[^/]*$', '') ELSE x || '/' || y END)"""
    return f"""CASE WHEN regexp_matches({bare}, '{_URL}') THEN
  translate({part[1]}, '{_UPPER}', '{_LOWER}') || {part[2]}
  || translate({part[3]}, '{_UPPER}', '{_LOWER}') || {dots} || {part[5]} ELSE {bare} END"""


OP9 = f"""
WITH RECURSIVE rules AS (SELECT * FROM (VALUES {_RULES}) t(h, s, v)),
clean AS (SELECT DISTINCT url AS a, regexp_replace(html, '(?is)<!--.*?(?:-->|\\z)|{_RAW}', ' ', 'g')
  AS page FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
every AS (SELECT a, list_filter(regexp_extract_all(page, '(?is)</?[a-z]{_TAG_END}'),
  lambda tag: regexp_matches(tag, '(?i)^<(link|meta|base)[\\s/>]')) AS tags FROM clean),
based AS (SELECT a, tags, regexp_replace(a, '(?s)#.*$', '') AS own, list_filter(list_transform(
  list_filter(tags, lambda tag: regexp_matches(tag, '(?i)^<base')), lambda tag:
  {_decoded(_attribute("href"))}), lambda x: x <> '')[1] AS given FROM every),
rooted AS (SELECT a, tags, coalesce(regexp_replace({_resolved("given", "own")}, '(?s)#.*$', ''),
  own) AS root FROM based),
tags AS (SELECT a, root, unnest(tags) AS tag FROM rooted),
targets AS (SELECT a, root, CASE
  WHEN regexp_matches(tag, '(?i)^<link')
    AND regexp_matches(lower({_decoded(_attribute("rel"))}), '(^|\\s)canonical(\\s|$)')
    THEN {_decoded(_attribute("href"))}
  WHEN regexp_matches(tag, '(?i)^<meta')
    AND lower({_decoded(_attribute("http-equiv"))}) = 'refresh'
    THEN {_decoded(" || ".join(
        "regexp_extract(" + _decoded(_attribute("content")) + ", '(?is)^\\s*[\\d.]+\\s*[;,\\s]\\s*"
        "(?:url\\s*=\\s*)?(?:\"([^\"]*)|''([^'']*)|(.*))', " + str(k) + ")" for k in (1, 2, 3)))}
  END AS t FROM tags),
named AS (SELECT a, {_resolved("t", "root")} AS b FROM targets WHERE t <> ''),
links AS (SELECT {_alias("a")} AS a, {_alias("b")} AS b FROM named WHERE b <> ''),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION
  SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
judged AS (SELECT b, arg_max(v, length(h || s)) AS v FROM (
    SELECT DISTINCT b, {_split("b")} FROM reach) JOIN rules
  ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) GROUP BY b),
spread AS (SELECT a, CASE WHEN bool_or(v = 'allow') THEN 'allow' ELSE 'block' END AS v
  FROM reach JOIN judged USING (b) GROUP BY a),
own AS (SELECT page_id, url, coalesce(host, '') AS host, coalesce(path, '') AS path
  FROM (SELECT page_id, url, {_split("url")} FROM pages)),
best AS (SELECT page_id, arg_max(h || s, length(h || s)) AS rule, arg_max(v, length(h || s)) AS v
  FROM own JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s)
  GROUP BY page_id)
SELECT own.page_id, host, path, rule, coalesce(best.v, spread.v, 'allow') AS verdict
FROM own LEFT JOIN best USING (page_id)
  LEFT JOIN spread ON spread.a = {_alias("url")}
"""

OP10 = """
WITH RECURSIVE u AS (SELECT vec_id, list_transform(embedding, lambda x: cast(x AS double)) AS v
  FROM embeddings WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS (SELECT *, sqrt(list_dot_product(v, v)) AS size FROM u WHERE list_dot_product(v, v) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / a.size / b.size >= 0.9),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(counts.n, 0) AS n_links,
  coalesce(least(vec_id, least.b), vec_id) AS component_id,
  coalesce(least.b >= vec_id, true) AS kept
FROM embeddings LEFT JOIN counts ON counts.a = vec_id LEFT JOIN least ON least.a = vec_id
"""

OP11 = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * cast(x AS double))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same,
  cast(list_dot_product(a.v, r.v) AS bigint) AS score
  FROM r a JOIN r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id, cast(row_number() OVER (PARTITION BY p.anchor_id, positive_id
  ORDER BY score DESC, other) AS integer) AS rank, other AS negative_id, positive_score,
  score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) <= 3
"""

# CRC-32 of a decimal number, bit by bit
_BYTE = ("list_reduce(list_prepend(xor(c, b), list_transform(range(0, 8), lambda z: z)), "
         "lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))")
_CRC = ("xor(4294967295, list_reduce(list_prepend(cast(4294967295 AS bigint), list_transform("
        "range(1, len(cast(conv_id AS varchar)) + 1), lambda i: "
        "cast(ord(cast(conv_id AS varchar)[i]) AS bigint))), "
        f"lambda c, b: {_BYTE}))")
OP13 = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
b AS (SELECT c.conv_id, 0 AS part, p, role, text FROM c JOIN t ON t.conv_id = base AND p <= h
  UNION ALL SELECT conv_id, 1, p, role, text FROM c JOIN t USING (conv_id) WHERE p > h),
q AS (SELECT conv_id, list([role, text] ORDER BY part, p) AS s FROM b GROUP BY conv_id),
w AS (SELECT conv_id, coalesce(s, []) AS s FROM c LEFT JOIN q USING (conv_id)),
m AS (SELECT conv_id, d AS depth, list_slice(s, 1, d) AS k, len(s) = d AS ends
  FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM w)),
n AS (SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
  coalesce(string_agg(cast(conv_id AS varchar), ',' ORDER BY conv_id) FILTER (ends), '') AS e,
  (count(*) - 1) * CASE WHEN depth > 0 THEN length(k[depth][2]) ELSE 0 END AS v
  FROM m GROUP BY k, depth),
kids AS (SELECT list_slice(k, 1, depth - 1) AS k, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1),
full_n AS (SELECT n.*, coalesce(kids.n, 0) AS n_children FROM n LEFT JOIN kids USING (k)),
sums AS (SELECT a.k, sum(b.v) AS saved, count(*) FILTER (b.n_children = 0) AS leaves
  FROM full_n a JOIN full_n b ON b.depth >= a.depth AND list_slice(b.k, 1, a.depth) = a.k
  GROUP BY a.k)
SELECT x.conv_id, x.depth, p.conv_id AS parent_conv_id, x.n_convs, x.n_children,
  cast(leaves AS bigint) AS n_leaves, cast(saved AS bigint) AS saved_tokens,
  sha256(x.e) AS ends_sha256
FROM full_n x JOIN sums USING (k)
LEFT JOIN full_n p ON x.depth > 0 AND p.depth = x.depth - 1
  AND p.k = list_slice(x.k, 1, x.depth - 1)
"""

ORACLE_SQL = {
    "op1_decontaminate": OP1, "op2_warc": OP2, "op3_suffixes": OP3, "op9_urls": OP9,
    "op10_pivots": OP10, "op11_negatives": OP11, "op13_prefixes": OP13,
}
