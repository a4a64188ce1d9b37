"""The queries of the training-data problems in SQL, where a second engine can express them."""

from __future__ import annotations

#: Punycode labels decoded digit by digit (RFC 3492), for the hosts of ``p1_found``: one step of the recursion is one digit.
_DECODED = """
labels AS (SELECT DISTINCT l FROM (SELECT unnest(parts) AS l FROM hosts) WHERE l LIKE 'xn--%'),
puny AS (
    SELECT l, substr(l, 5) AS rest, CASE WHEN strpos(substr(l, 5), '-') > 0 THEN regexp_extract(substr(l, 5), '^(.*)-', 1) ELSE '' END AS base,
    regexp_extract(substr(l, 5), '[^-]*$') AS digits FROM labels
),
steps(l, digits, out, nth, n, i, oldi, w, k, bias) AS (
    SELECT l, digits, base, 1, 128::BIGINT, 0::BIGINT, 0::BIGINT, 1::BIGINT, 36, 72::BIGINT FROM puny
    UNION ALL
    SELECT l, digits,
        CASE WHEN ends THEN substr(out, 1, (ni % (length(out) + 1))::INT) || chr((n + ni // (length(out) + 1))::INT) || substr(out, (ni % (length(out) + 1))::INT + 1) ELSE out END,
        nth + 1,
        CASE WHEN ends THEN n + ni // (length(out) + 1) ELSE n END,
        CASE WHEN ends THEN ni % (length(out) + 1) + 1 ELSE ni END,
        CASE WHEN ends THEN ni % (length(out) + 1) + 1 ELSE oldi END,
        CASE WHEN ends THEN 1 ELSE w * (36 - t) END,
        CASE WHEN ends THEN 36 ELSE k + 36 END,
        CASE WHEN ends THEN (
            CASE WHEN scaled > 455 * 35 THEN 72 + 36 * (scaled // 1225) // (scaled // 1225 + 38)
                 WHEN scaled > 455 THEN 36 + 36 * (scaled // 35) // (scaled // 35 + 38) ELSE 36 * scaled // (scaled + 38) END) ELSE bias END
    FROM (SELECT *, d < t AS ends, delta + delta // (length(out) + 1) AS scaled FROM (
        SELECT *, i + d * w AS ni, CASE WHEN oldi = 0 THEN (i + d * w - oldi) // 700 ELSE (i + d * w - oldi) // 2 END AS delta FROM (
            SELECT *, CASE WHEN c BETWEEN 97 AND 122 THEN c - 97 ELSE c - 22 END AS d, CASE WHEN k <= bias THEN 1 WHEN k >= bias + 26 THEN 26 ELSE k - bias END AS t
            FROM (SELECT *, ascii(substr(digits, nth, 1)) AS c FROM steps WHERE nth <= length(digits)))))
),
decoded AS (SELECT l, out FROM steps WHERE nth = length(digits) + 1)
"""

P1 = f"""
WITH RECURSIVE linked AS (
    SELECT row_id, quality_score, regexp_replace(url, '^[\\s\\x{{00a0}}]+|[\\s\\x{{00a0}}]+$', '', 'g') AS u FROM fefe_training_data
),
hosts AS (
    SELECT row_id, quality_score, string_split(regexp_replace(lower(regexp_replace(regexp_replace(regexp_extract(
        regexp_replace(u, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?[/\\\\]*', ''), '^[^/\\\\?#]*'), '^.*@', ''), ':[0-9]*$', '')), '^\\.+|\\.+$', '', 'g'), '.')[-2:] AS parts
    FROM linked WHERE u <> ''
),
{_DECODED},
sites AS (
    SELECT row_id, any_value(quality_score) AS q, string_agg(coalesce(d.out, p.label), '.' ORDER BY pos) AS site
    FROM (SELECT row_id, quality_score, unnest(parts) AS label, generate_subscripts(parts, 1) AS pos FROM hosts) p LEFT JOIN decoded d ON p.label = d.l GROUP BY row_id
)
SELECT row_id FROM (
    SELECT row_id, row_number() OVER (PARTITION BY site ORDER BY q DESC NULLS LAST, row_id) AS place, (SELECT count(*) FROM hosts) // 50 AS places FROM sites WHERE site <> ''
) WHERE place > places
"""

# The readings of a text for ``p7_found``: markup out, line-end hyphens joined or not, marks inside words out. Every word folds
# umlauts, their two-letter spellings and the bare vowels into one.
_INVISIBLE = "regexp_replace({}, '[\\x{{00ad}}\\x{{200b}}-\\x{{200f}}\\x{{2060}}\\x{{feff}}]', '', 'g')"
_JOINED = "regexp_replace({}, '(\\p{{L}})[-\\x{{2010}}\\x{{2011}}][ \\t]*\\r?\\n\\s*(\\p{{L}})', '\\1\\2', 'g')"


def _plain(c: str) -> str:
    for entity, sign in (("auml", "ä"), ("ouml", "ö"), ("uuml", "ü"), ("Auml", "Ä"), ("Ouml", "Ö"), ("Uuml", "Ü"), ("szlig", "ß"), ("nbsp", " "), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        c = f"replace({c}, '&{entity};', '{sign}')"
    for pattern, new in (
        ("</?(?:p|br|li|ul|ol|div|h[1-6]|tr|td|th|table|blockquote|pre|hr|dd|dt|dl|section|article)\\b[^<>]*>", " "), ("<(?:/?[a-zA-Z][^<>]*)>", ""), ("<!--.*?-->", ""),
        ("\\]\\s?(?:\\([^()\\s]*(?:\\s+\"[^\"]*\")?\\)|\\[\\w*\\])", "]"), ("\\[\\[[^\\[\\]|]*\\|([^\\[\\]]*)\\]\\]", "\\1"), ("\\[https?://\\S+\\s+([^\\[\\]]*)\\]", "\\1"),
        ("\\\\[\"''`^~=.]\\s?\\{?([a-zA-Z])\\}?", "\\1"), ("\\\\ss\\b\\{?\\}?", "ss"), ("\\\\(?:href|url)\\{[^{}]*\\}", ""), ("\\\\[a-zA-Z]+\\*?(?:\\[[^\\[\\]]*\\])?", ""),
    ):
        c = f"regexp_replace({c}, '(?i){pattern}', '{new}', 'g')"
    return c


def _folded(c: str) -> str:
    c = f"strip_accents(replace(lower({c}), 'ß', 'ss'))"
    for a, b in (("ae", "a"), ("oe", "o"), ("ue", "u"), ("sz", "s"), ("ss", "s")):
        c = f"replace({c}, '{a}', '{b}')"
    return f"regexp_extract_all({c}, '[\\p{{L}}\\p{{N}}]+')"


def _grams(table: str, key: str, text: str) -> str:
    inword = "regexp_replace(p, '([\\p{L}\\p{N}])(?:\\*{1,3}|_{2,3}|''{2,5}|`)([\\p{L}\\p{N}])', '\\1\\2', 'g')"
    readings = f"[{_JOINED.format('p')}, p, {_JOINED.format('t')}, {_JOINED.format(inword)}]"
    return f"""SELECT DISTINCT k, array_to_string(w[i:i + 11], ' ') AS gram FROM (
        SELECT k, w, unnest(range(1, len(w) - 10)) AS i FROM (
            SELECT DISTINCT k, {_folded('r')} AS w FROM (SELECT k, unnest({readings}) AS r FROM (SELECT k, t, {_plain('t')} AS p FROM (
                SELECT {key} AS k, {_INVISIBLE.format(text)} AS t FROM {table} WHERE {text} IS NOT NULL)))))"""


P7 = f"WITH a AS ({_grams('documents', 'doc_id', 'text')}), b AS ({_grams('benchmark_set', 'item_id', 'target_comment')}) SELECT DISTINCT a.k AS doc_id, b.k AS item_id FROM a JOIN b ON a.gram = b.gram"
