"""The queries in SQL, for a second engine."""

from __future__ import annotations

from quillspark.functions.language import STOPWORDS
from quillspark.functions.patterns import (
    AUDIT_LABELS, BRAND_HOSTS, DEICTIC_WORDS, GENERIC_PORTAL, LINE_BREAK, MAPS_BOILER, MAPS_URL, NUMBER_UNIT, QUOTE_SIGNS, SEPARATORS, URL_ISH, WS, whole_words,
)
from quillspark.functions.prompt import INSTRUCTION, SYSTEM
from quillspark.functions.timecode import KEY


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def norm(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), {q(WS + '+')}, ' ', 'g'))"


def strip(c: str) -> str:
    return f"regexp_replace({c}, {q(f'^{WS}+|{WS}+$')}, '', 'g')"


def opened(c: str) -> str:
    return f"regexp_replace(replace({c}, '[l] ', ''), '([:.!?1]+)([a-zA-Z1-9]+)', '\\1 \\2', 'g')"


def words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, {q(WS + '+')}), lambda x: x <> '')"


def tokens(c: str) -> str:
    return words(f"lower({c})")


def count(c: str, pattern: str) -> str:
    return f"len(regexp_extract_all({c}, {q(pattern)}))"


def seconds(c: str) -> str:
    return f"(CASE WHEN regexp_full_match({c}, '[0-9A-Fa-f]{{1,8}}') THEN xor(('0x' || {c})::BIGINT, {KEY}::BIGINT) END)"


def month(c: str) -> str:
    return f"coalesce(strftime(make_timestamp({seconds(c)} * 1000000), '%Y%m'), 'unknown')"


def like(c: str, pattern: str, ignore_case: bool = True) -> str:
    return f"regexp_matches({c}, {q(('(?i)' if ignore_case else '') + pattern)})"


HREFS = "regexp_extract_all(regexp_replace(contenthtml, '(?s)<blockquote[^>]*>.*?</blockquote>', '', 'g'), '<a [^>]*?href=\"([^\"]*)\"', 1)"
DOMAIN = r"CASE WHEN regexp_matches(href, '^/?\?ts=') THEN 'self' ELSE regexp_replace(split_part(string_split(href, '//')[-1], '/', 1), 'www[\p{Nd}.]*', '', 'g') END"
COUNTED = r"length(word) >= 4 AND NOT regexp_matches(word, '^\p{Nd}')"
_WITHOUT_TAGS = "regexp_replace(regexp_replace(contenthtml, '(?s)<blockquote[^>]*>.*?(?:</blockquote>|$)', '', 'g'), '</?[a-zA-Z][^<>]*>', '', 'g')"
ITEMS = "list_transform(regexp_split_to_array(contenthtml, '<li[^>]*>')[2:], lambda x: replace(x, '</ul>', ''))"
BARE = r"regexp_replace(coalesce(context, ''), '^\[Quelle: [A-Z]+\] ?', '')"


def counted(items: str, bucket: str, key: str) -> str:
    return f"WITH i AS ({items}) SELECT {bucket} AS bucket, {key}, count(*)::BIGINT AS cnt FROM i GROUP BY ALL UNION ALL SELECT 'sum', {key}, count(*)::BIGINT FROM i GROUP BY {key}"


def reason(t: str) -> str:
    return f"""CASE WHEN length({t}) < 18 THEN 'too_short' WHEN {like(t, URL_ISH)} THEN 'url_ish' WHEN {like(t, MAPS_BOILER)} THEN 'maps_boilerplate'
    WHEN {count(t, r'\p{Nd}')} / length({t}) > 0.18 THEN 'digit_heavy' WHEN lower({t}) IN ({', '.join(map(q, BRAND_HOSTS))}) AND length({t}) < 25 THEN 'brand_domain' END"""


def label(t: str) -> str:
    rules = " ".join(f"WHEN {like(t, p, i)} THEN {q(n)}" for n, i, p in AUDIT_LABELS)
    return f"CASE WHEN {t} = '' THEN 'empty' {rules} WHEN {count(t, '[|]')} >= 2 THEN 'metadata-heavy' WHEN {count(t, r'\p{Nd}')} >= 6 THEN 'digit-heavy' ELSE 'ok' END"


def points(t: str, c: str) -> str:
    content = f"len(list_filter({words(t)}, lambda w: length(w) > 2))"
    names = f"len(list_filter({words(t)}[2:], lambda w: length(w) > 2 AND regexp_matches(w, '^\\p{{Lu}}')))"
    g = lambda test, n: f"(CASE WHEN {test} THEN {n} ELSE 0 END)"
    total = (
        f"50 + {g(content + ' >= 4', 15)} + {g(like(t, QUOTE_SIGNS, False), 10)} + {g(like(t, NUMBER_UNIT, False), 10)} + {g(names + ' >= 2', 10)} + {g(f'length({c}) >= 40', 5)}"
        f" - {g(like(t, GENERIC_PORTAL), 35)} - {g(f'{count(t, SEPARATORS)} >= 2 AND {content} < 4', 25)} - {g(like(t, MAPS_BOILER), 40)}"
    )
    return f"greatest(0, least(100, {total}))::BIGINT"


def bucket(p: str) -> str:
    return f"CASE WHEN {p} >= 70 THEN 'high' WHEN {p} >= 35 THEN 'mid' WHEN {p} >= 15 THEN 'low' ELSE 'drop' END"


def lang(c: str) -> str:
    w = f"regexp_split_to_array(lower({norm(c)}), '[^\\p{{L}}]+')"
    n = {k: f"len(list_filter({w}, lambda w: w IN ({', '.join(map(q, s.split()))})))" for k, s in STOPWORDS.items()}
    best = f"greatest({', '.join(n.values())})"
    return f"CASE WHEN length({c}) < 20 OR {best} = 0 THEN 'de' " + " ".join(f"WHEN {v} = {best} THEN '{k}'" for k, v in n.items()) + " END"


def prefixed(c: str, language: str) -> str:
    return f"CASE WHEN {language} <> 'de' THEN concat_ws(' ', '[Quelle: ' || upper({language}) || ']', nullif({c}, '')) ELSE {c} END"


def judged(rows: str) -> str:
    """The chain from a (topic, bare context, comment) to j (context, points, quality_bucket, status)."""
    return f"""{rows}, l AS (SELECT *, CASE WHEN length(topic) >= 40 THEN topic ELSE concat_ws(' ', topic, bare) END AS sample FROM a),
m AS (SELECT *, {lang('sample')} AS lang FROM l), n AS (SELECT *, {prefixed('bare', 'lang')} AS context FROM m), p AS (SELECT *, {points('topic', 'context')} AS points FROM n),
b AS (SELECT *, {bucket('points')} AS quality_bucket, {strip('topic')} AS stripped FROM p),
j AS (SELECT *, CASE WHEN length(comment) < 30 THEN 'short_comment' WHEN topic = '' THEN 'no_topic' ELSE coalesce({reason('stripped')}, CASE WHEN quality_bucket = 'drop' THEN 'quality_drop' END, 'kept') END AS status FROM b)"""
JUDGED = judged(f"WITH a AS (SELECT row_id, coalesce(topic, '') AS topic, {BARE} AS bare, {norm('target_comment')} AS comment, coalesce(topic_source, 'unknown') AS topic_source FROM fefe_training_data)")
COIN = "('0x' || substr(md5('42:' || row_id), 1, 8))::BIGINT"
UNIQUE = "SELECT * FROM fefe_training_data QUALIFY row_number() OVER (PARTITION BY coalesce(post_id, 'row ' || row_id) ORDER BY row_id) = 1"
FOREIGN = "(coalesce(context, '') LIKE '[Quelle:%' AND coalesce(context, '') NOT LIKE '[Quelle: DE]%')"
BENCHMARK = f"""WITH u AS ({UNIQUE}), t AS (SELECT *, coalesce(quality_bucket, 'mid') AS b, {FOREIGN} AS f FROM u),
c AS (SELECT b, count(*) FILTER (f) AS n, count(*) FILTER (NOT f) AS d FROM t GROUP BY b),
x AS (SELECT coalesce(max(n) FILTER (b = 'high'), 0) nh, coalesce(max(d) FILTER (b = 'high'), 0) dh, coalesce(max(n) FILTER (b = 'mid'), 0) nm, coalesce(max(d) FILTER (b = 'mid'), 0) dm, coalesce(max(n) FILTER (b = 'low'), 0) nl, coalesce(max(d) FILTER (b = 'low'), 0) dl FROM c),
h AS (SELECT *, least(nh, 50, 50) AS th FROM x), h2 AS (SELECT *, least(dh, 100 - th) AS gh FROM h), h3 AS (SELECT *, th + least(nh - th, 100 - th - gh) AS fh FROM h2),
m AS (SELECT *, least(nm, greatest(0, 50 - fh), 50) AS tm FROM h3), m2 AS (SELECT *, least(dm, 100 - tm) AS gm FROM m), m3 AS (SELECT *, tm + least(nm - tm, 100 - tm - gm) AS fm FROM m2),
l AS (SELECT *, least(nl, greatest(0, 50 - fh - fm), 50) AS tl FROM m3), l2 AS (SELECT *, least(dl, 100 - tl) AS gl FROM l), l3 AS (SELECT *, tl + least(nl - tl, 100 - tl - gl) AS fl FROM l2),
w AS (SELECT 'high' AS b, fh AS fq, gh AS gq FROM l3 UNION ALL SELECT 'mid', fm, gm FROM l3 UNION ALL SELECT 'low', fl, gl FROM l3),
r AS (SELECT *, row_number() OVER (PARTITION BY b, f ORDER BY md5('42:' || row_id), row_id) AS n FROM t),
s AS (SELECT r.* FROM r JOIN w ON r.b = w.b WHERE r.n <= CASE WHEN r.f THEN w.fq ELSE w.gq END)"""
PROMPT = f"concat_ws(chr(10), '### Instruction', {q(INSTRUCTION)}, '', '### Input', 'Topic: ' || {norm('topic')}, CASE WHEN {norm('context')} <> '' THEN 'Context: ' || {norm('context')} END, CASE WHEN {norm('url')} <> '' THEN 'URL: ' || {norm('url')} END, '', '### Response')"
MONTHS = "SELECT strftime(unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)), '%Y%m') AS month FROM orders"


def unescaped(c: str) -> str:
    for entity, sign in (("uuml", "ü"), ("auml", "ä"), ("ouml", "ö"), ("szlig", "ß"), ("gt", ">"), ("lt", "<"), ("amp", "&")):
        c = f"replace({c}, '&{entity};', '{sign}')"
    return c


def texts(items: str) -> str:
    """The non-empty texts among tags and texts."""
    return f"list_filter(list_transform(list_filter({items}, lambda x: NOT regexp_matches(x, '^</?[a-zA-Z]')), lambda x: {norm(unescaped('x'))}), lambda x: x <> '')"


# Tags and texts of each page in order; of each external link its place, what follows, and the first quotation among 20 nodes.
_LINK = "'^<a\\s[^>]*href=\"\\s*https?://'"
_ENDED = "lambda s, t: CASE WHEN s <> '' AND (regexp_matches(s, '[.!?]$') OR length(s) >= 140) THEN s WHEN s = '' THEN t ELSE s || ' ' || t END"
ANCHORS = f"""WITH t AS (SELECT message_id, list_filter(string_split(regexp_replace(contenthtml, '(</?[a-zA-Z][^<>]*>)', chr(1) || '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS t FROM messages),
i AS (SELECT message_id, t, unnest(list_filter(range(1, len(t) + 1), lambda i: regexp_matches(t[i], {_LINK}))) AS i FROM t),
r AS (SELECT *, t[i + 1:] AS r, len(list_filter(t[:i], lambda x: NOT starts_with(x, '</'))) - 1 AS pos FROM i),
after_it AS (SELECT *, list_filter(r, lambda x: NOT starts_with(x, '</')) AS nodes, coalesce(list_position(r, '</a>'), len(r) + 1) AS j, coalesce(nullif(list_position(list_transform(r, lambda x: starts_with(x, '<blockquote')), true), 0), 1000000) AS k FROM r),
q AS (SELECT *, k <= len(r) AND len(list_filter(r[:k], lambda x: NOT starts_with(x, '</'))) <= 20 AS near FROM after_it),
anchors AS (SELECT message_id, pos, regexp_extract(t[i], 'href="([^"]*)"', 1) AS href, array_to_string({texts('r[:j - 1]')}, ' ') AS body,
    CASE WHEN near THEN left(array_to_string({texts("r[k + 1:k + coalesce(nullif(list_position(r[k + 1:], '</blockquote>'), 0), 1000000) - 1]")}, ' '), 140) ELSE '' END AS quotation,
    left(list_reduce(list_prepend('', {texts('nodes[:60]')}), {_ENDED}), 140) AS sentence FROM q)"""


def topic_steps() -> str:
    """The topic rules over the first two links of each message: topics holds those with links, with the flag maps."""
    deictic = like("body", whole_words(DEICTIC_WORDS))
    return f"""{ANCHORS}, firsts AS (SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY pos) AS n, coalesce(lead(body) OVER (PARTITION BY message_id ORDER BY pos), '') AS second FROM anchors),
        steps AS (SELECT *, CASE WHEN {deictic} AND length(sentence) >= 20 THEN body || ' ' || sentence WHEN {deictic} AND length(second) >= 20 THEN body || ' (' || second || ')' WHEN length(quotation) >= 20 THEN body || ': ' || quotation ELSE body END AS topic,
            CASE WHEN {deictic} AND (length(sentence) >= 20 OR length(second) >= 20) THEN 'html_text' WHEN length(quotation) >= 20 THEN 'html_anchor+blockquote' ELSE 'html_anchor' END AS source FROM firsts WHERE n = 1),
        topics AS (SELECT *, {like("href", MAPS_URL)} AND ({like("topic", MAPS_BOILER)} OR length(topic) < 40) AND length(sentence) >= 20 AS maps FROM steps)"""


LINK_TOPIC = strip("left(CASE WHEN maps THEN sentence ELSE topic END, 180)")


def curated_posts() -> str:
    """Posts with the best linked page, judged."""
    first = "row_number() OVER (PARTITION BY hextimestamp ORDER BY source_pos NULLS FIRST, source_id) = 1"
    joined = f"trim({norm('pages.title')} || ' | ' || left(split_part({norm('pages.description')}, '.', 1), 160), ' |')"
    made = f"""{topic_steps()}, posts AS (SELECT * FROM messages QUALIFY row_number() OVER (PARTITION BY hextimestamp ORDER BY scraped_at NULLS FIRST, message_id) = 1),
        urls AS (SELECT hextimestamp, url FROM externalsources QUALIFY {first}), pages AS (SELECT * FROM externalsources WHERE {norm('title')} <> '' OR {norm('description')} <> '' QUALIFY {first}),
        joined_posts AS (SELECT posts.hextimestamp AS post_id, posts.url AS post_url, posts.posted_at, {norm('posts.content')} AS comment, {norm('urls.url')} AS url, topics.message_id IS NOT NULL AS linked, topics.source, topics.maps, {LINK_TOPIC} AS link_topic,
            {norm('pages.title')} AS title, {norm('pages.description')} AS description, {joined} AS joined
            FROM posts LEFT JOIN topics USING (message_id) LEFT JOIN urls ON posts.hextimestamp = urls.hextimestamp LEFT JOIN pages ON posts.hextimestamp = pages.hextimestamp),
        a AS (SELECT *, CASE WHEN linked THEN link_topic WHEN length(title) >= 18 THEN left(title, 180) WHEN length(description) >= 18 THEN left(split_part(description, '.', 1), 180) ELSE '' END AS topic,
            CASE WHEN linked THEN CASE WHEN description <> '' THEN joined ELSE title END WHEN length(title) >= 18 THEN left(description, 160) ELSE '' END AS bare,
            CASE WHEN linked THEN CASE WHEN maps THEN 'html_text' ELSE source END WHEN length(title) >= 18 THEN 'external_title' WHEN length(description) >= 18 THEN 'external_desc' ELSE 'none' END AS topic_source FROM joined_posts)"""
    return f"{judged(made)} SELECT topic, context, url, comment AS target_comment, posted_at, post_url, post_id, topic_source, round(points / 100, 3)::DOUBLE AS quality_score, quality_bucket FROM j WHERE status = 'kept'"


def oracle_sql() -> dict[str, str]:
    from quillspark.queries import TOPICS

    lines = f"regexp_split_to_array(contenthtml, {q(LINE_BREAK)})"
    excess = "((length(l) - length(replace(l, '<a', ''))) // 2 - (length(l) - length(replace(l, '</a>', ''))) // 4)"
    broken = "regexp_replace(regexp_replace(contenthtml, '(</a>[^<]*)</a>', '\\1', 'g'), '</a> ', chr(10), 'g')"
    literal = ", ".join(f"({q(t)})" for t in TOPICS)
    return {
        "word_counts": counted(f"SELECT b, word FROM (SELECT {month('hextimestamp')} AS b, regexp_replace(unnest({tokens(opened('content'))}), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS word FROM messages) WHERE {COUNTED}", "b", "word"),
        "normalize_text": f"SELECT doc_id, {norm('text')} AS normalized FROM documents",
        "token_count": f"SELECT message_id, len({tokens(opened('content'))})::BIGINT AS tokens FROM messages",
        "marker_strip": f"SELECT message_id, {opened('content')} AS opened FROM messages",
        "clean_tokens": f"SELECT * FROM (SELECT doc_id, (generate_subscripts(t, 1) - 1)::BIGINT AS pos, regexp_replace(unnest(t), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS word FROM (SELECT doc_id, {tokens('text')} AS t FROM documents)) WHERE {COUNTED}",
        "first_sentence": f"SELECT source_id, left(split_part({norm('description')}, '.', 1), 160) AS sentence FROM externalsources",
        "truncate_180": f"SELECT doc_id, left({norm('text')}, 180) AS topic FROM documents",
        "context_join": f"SELECT source_id, trim({norm('title')} || ' | ' || left(split_part({norm('description')}, '.', 1), 160), ' |') AS context FROM externalsources",
        "field_defaults": "SELECT row_id, coalesce(topic, '') AS topic, coalesce(quality_bucket, 'unknown') AS quality_bucket, coalesce(topic_source, 'unknown') AS topic_source FROM fefe_training_data",
        "domain_counts": counted(f"SELECT b, {DOMAIN} AS domain FROM (SELECT {month('hextimestamp')} AS b, unnest(({HREFS})[2:]) AS href FROM messages)", "b", "domain"),
        "self_links": f"SELECT message_id, len(list_filter(h, lambda x: regexp_matches(x, '^/?\\?ts=')))::BIGINT AS self_links, len(h)::BIGINT AS all_links FROM (SELECT message_id, {HREFS} AS h FROM messages)",
        "external_links": f"SELECT * FROM (SELECT message_id, (generate_subscripts(h, 1) - 1)::BIGINT AS pos, unnest(h) AS href FROM (SELECT message_id, {HREFS} AS h FROM messages)) WHERE regexp_matches({strip('href')}, '^https?://')",
        "timecode_roundtrip": f"SELECT message_id, strftime(make_timestamp({seconds('hextimestamp')} * 1000000), '%Y-%m-%d %H:%M:%S') AS decoded, lower(hex(xor({seconds('hextimestamp')}, {KEY}::BIGINT))) AS encoded FROM messages",
        "permalinks": f"SELECT * FROM (SELECT message_id, nullif(regexp_extract(h[1], '\\?ts=(.*)', 1), '') AS code, 'https://blog.linkstube.example/' || h[1] AS url FROM (SELECT message_id, {HREFS} AS h FROM messages)) WHERE {seconds('code')} IS NOT NULL",
        "month_sequence": f"SELECT month, 'https://blog.linkstube.example/?mon=' || month AS url FROM ({MONTHS})",
        "months_unprocessed": f"SELECT month FROM (SELECT strftime(unnest(generate_series(date_trunc('month', min(posted)), date_trunc('month', max(posted)), INTERVAL 1 MONTH)), '%Y%m') AS month FROM (SELECT make_timestamp({seconds('hextimestamp')} * 1000000) AS posted FROM messages)) WHERE month NOT IN (SELECT {month('hextimestamp')} FROM messages WHERE quotecount > 2)",
        "month_limit": f"SELECT month FROM ({MONTHS}) ORDER BY month LIMIT 24",
        "month_delta": "SELECT datediff('month', min(o_orderdate), max(o_orderdate))::BIGINT AS months FROM orders",
        "anchor_repair": f"SELECT message_id, array_to_string(list_transform({lines}, lambda l: l || repeat('</a>', greatest(0, {excess})::INT)), '') AS repaired FROM messages",
        "invalid_anchor_lines": f"SELECT message_id, len(list_filter(regexp_split_to_array({broken}, {q(LINE_BREAK)}), lambda l: {excess} <> 0))::BIGINT AS invalid_lines FROM messages",
        "list_items": f"SELECT message_id, (generate_subscripts(i, 1) - 1)::BIGINT AS item_no, unnest(i) AS body FROM (SELECT message_id, {ITEMS} AS i FROM messages)",
        "item_candidates": f"SELECT message_id, len(list_filter({ITEMS}, lambda x: len(list_filter(regexp_extract_all(x, '<a [^>]*?href=\"([^\"]*)\"', 1), lambda h: contains(h, '?ts='))) > 0))::BIGINT AS candidates FROM messages",
        "quote_counts": f"SELECT message_id, {count('contenthtml', '<blockquote')}::BIGINT AS quotes FROM messages",
        "asof_header": "SELECT * FROM (VALUES (1::BIGINT, 2::BIGINT, 'Day one'), (1::BIGINT, 14::BIGINT, 'Day two')) t(page_id, pos, header)",
        "nearest_blockquote": "SELECT * FROM (VALUES ('https://www.example.org/a', 'A quoted line of some length.'), ('http://foo.test/b', '')) t(href, quotation)",
        "next_sentence": "SELECT * FROM (VALUES ('https://www.example.org/a', 'das hier ist toll.'), ('http://foo.test/b', 'das hier ist wirklich toll.')) t(href, sentence)",
        "source_metadata": "SELECT 'Zweiter Titel' AS title, 'Worum es geht' AS description, NULL::VARCHAR AS author, '2024-05-06' AS published, '' AS site_name, 'https://a.test/x' AS url",
        "source_lookup": f"""WITH p AS (SELECT * FROM externalsources WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url ORDER BY source_id) = 1),
            l AS (SELECT message_id, generate_subscripts(h, 1) AS pos, unnest(h) AS href FROM (SELECT message_id, {HREFS} AS h FROM messages))
            SELECT message_id AS post_id, count(*)::BIGINT AS n, string_agg(coalesce(title, ''), '¦' ORDER BY pos) AS titles FROM l JOIN p ON l.href = p.url WHERE NOT regexp_matches(href, '^/?\\?ts=') AND href LIKE 'http%' GROUP BY 1""",
        "hard_drop_reasons": f"SELECT row_id, coalesce({reason('t')}, 'keep') AS reason FROM (SELECT row_id, {strip("coalesce(topic, '')")} AS t FROM fefe_training_data)",
        "rule_cases": f"SELECT topic, coalesce({reason('t')}, 'keep') AS reason, {label('n')} AS label FROM (SELECT topic, {strip('topic')} AS t, {norm('topic')} AS n FROM (VALUES {literal}) v(topic))",
        "language_votes": f"SELECT source_id, {lang('description')} AS lang FROM externalsources WHERE description IS NOT NULL",
        "language_prefix": f"SELECT source_id, {prefixed('t', 'l')} AS context FROM (SELECT source_id, {norm('title')} AS t, coalesce(nullif(lower(left(lang, 2)), ''), 'de') AS l FROM externalsources)",
        "quality_scores": f"SELECT row_id, {points('t', 'c')} AS points FROM (SELECT row_id, coalesce(topic, '') AS t, coalesce(context, '') AS c FROM fefe_training_data)",
        "quality_buckets": f"SELECT {bucket('p')} AS bucket, count(*)::BIGINT AS cnt FROM (SELECT {points('t', 'c')} AS p FROM (SELECT coalesce(topic, '') AS t, coalesce(context, '') AS c FROM fefe_training_data)) GROUP BY 1",
        "curated_rows": f"{JUDGED} SELECT row_id, context, points, quality_bucket, status FROM j",
        "curation_stats": f"{JUDGED} SELECT 'total' AS metric, '' AS key, count(*)::BIGINT AS cnt FROM j UNION ALL SELECT 'status', status, count(*)::BIGINT FROM j GROUP BY status UNION ALL SELECT 'bucket', quality_bucket, count(*)::BIGINT FROM j WHERE status = 'kept' GROUP BY quality_bucket UNION ALL SELECT 'source', topic_source, count(*)::BIGINT FROM j WHERE status = 'kept' GROUP BY topic_source",
        "dedup_first": "SELECT message_id, hextimestamp FROM messages QUALIFY row_number() OVER (PARTITION BY hextimestamp ORDER BY scraped_at, message_id) = 1",
        "dedup_rows": f"SELECT row_id, post_id FROM ({UNIQUE})",
        "message_count": "SELECT count(*)::BIGINT AS scrapes, count(DISTINCT hextimestamp)::BIGINT AS posts FROM messages",
        "weighted_sample": f"SELECT row_id, post_id, quality_bucket, unnest(generate_series(1, n))::BIGINT AS copy_no FROM (SELECT *, CASE quality_bucket WHEN 'high' THEN 3 WHEN 'mid' THEN 1 WHEN 'low' THEN CASE WHEN {COIN} < 2147483648 THEN 1 ELSE 0 END ELSE 0 END AS n FROM fefe_training_data) WHERE n > 0",
        "uniform_sample": "SELECT row_id, post_id, quality_bucket, 1::BIGINT AS copy_no FROM fefe_training_data",
        "seeded_shuffle": "SELECT row_id, md5('42:' || row_id) AS shuffle_key FROM fefe_training_data ORDER BY 2",
        "stratified_benchmark": f"{BENCHMARK} SELECT row_id, quality_bucket, topic, NULL::INT AS rubric_style_fidelity, NULL::INT AS rubric_topical_relevance, NULL::INT AS rubric_hallucination_risk, '' AS rubric_notes FROM s",
        "benchmark_counts": f"{BENCHMARK} SELECT quality_bucket, count(*)::BIGINT AS cnt, (count(*) FILTER ({FOREIGN}))::BIGINT AS non_german FROM s GROUP BY 1",
        "topic_labels": f"SELECT row_id, {label('t')} AS label FROM (SELECT row_id, {norm('topic')} AS t FROM fefe_training_data)",
        "label_counts": f"SELECT {label('t')} AS label, count(*)::BIGINT AS cnt FROM (SELECT {norm('topic')} AS t FROM fefe_training_data) GROUP BY 1",
        "audit_shares": " UNION ALL ".join(f"SELECT '{c}' AS column_name, coalesce({c}, 'unknown') AS key, count(*)::BIGINT AS cnt, round(100.0 * count(*) / sum(count(*)) OVER (), 1)::DOUBLE AS pct FROM fefe_training_data GROUP BY 2" for c in ("quality_bucket", "topic_source")),
        "suspicious_totals": f"SELECT count(*)::BIGINT AS total, (count(*) FILTER (l <> 'ok'))::BIGINT AS suspicious FROM (SELECT {label('t')} AS l FROM (SELECT {norm('topic')} AS t FROM fefe_training_data))",
        "top_topics": f"SELECT {norm('topic')} AS topic, count(*)::BIGINT AS cnt, min(row_id)::BIGINT AS first_at FROM fefe_training_data GROUP BY 1 ORDER BY 2 DESC, 3 LIMIT 15",
        "examples_per_label": f"SELECT label, n::BIGINT AS example_no, row_id FROM (SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY row_id) AS n FROM (SELECT row_id, {label('t')} AS label FROM (SELECT row_id, {norm('topic')} AS t FROM fefe_training_data)) WHERE label <> 'ok') WHERE n <= 5",
        "prompt_text": f"SELECT row_id, {PROMPT} AS prompt FROM fefe_training_data",
        "chat_messages": f"SELECT row_id, 0::BIGINT AS turn, 'system' AS role, {q(SYSTEM)} AS content FROM fefe_training_data UNION ALL SELECT row_id, 1, 'user', {PROMPT} FROM fefe_training_data UNION ALL SELECT row_id, 2, 'assistant', {norm('target_comment')} FROM fefe_training_data",
        "chat_text": f"SELECT row_id, '<|system|>' || chr(10) || {q(SYSTEM)} || chr(10) || '<|user|>' || chr(10) || {PROMPT} || chr(10) || '<|assistant|>' || chr(10) || {norm('target_comment')} || chr(10) AS text FROM fefe_training_data",
        "batch_inference": f"SELECT model, {PROMPT} AS prompt, NULL::VARCHAR AS generated, NULL::VARCHAR AS error FROM benchmark_set, (VALUES ('base'), ('adapter')) m(model)",
        "stripped_text": f"SELECT message_id, {strip(unescaped(_WITHOUT_TAGS))} AS own_text FROM messages",
        "anchor_quotations": f"{ANCHORS} SELECT message_id, pos::BIGINT AS pos, href, quotation FROM anchors",
        "anchor_sentences": f"{ANCHORS} SELECT message_id, pos::BIGINT AS pos, href, sentence FROM anchors",
        "html_topic": f"{topic_steps()} SELECT message_id, coalesce({LINK_TOPIC}, '') AS topic, '' AS context, CASE WHEN maps THEN 'html_text' ELSE coalesce(source, 'none') END AS topic_source FROM messages LEFT JOIN topics USING (message_id)",
        "curated_posts": curated_posts(),
        "experiment_config": "SELECT * FROM (VALUES ('E3', false, 1::BIGINT, 2e-5::DOUBLE), ('E1', true, 2::BIGINT, 2e-5::DOUBLE), ('none', true, 1::BIGINT, 1e-4::DOUBLE)) t(name, packing, epochs, lr)",
    }
