"""The queries of this package in DuckDB SQL, where SQL expresses them. Built from the operators' own parameters."""

from __future__ import annotations

from zoneflow.llm.collocations import UNKNOWN_LANG, PhraseParams
from zoneflow.llm.common import LOWER, UPPER
from zoneflow.llm.mixing import BUCKETS, MixParams
from zoneflow.llm.quality import BOILERPLATE, SEPARATORS, SYMBOLS, QualityRules
from zoneflow.llm.url_filter import RULES, UrlVocabulary

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def quality_sql(source: str = "documents", rules: QualityRules = QualityRules()) -> str:
    """Common table expressions up to ``judged``: one row per row of ``source`` with all measures and ``cleaned``."""

    def count(text: str, chars: str) -> str:
        return f"(length({text}) - length(translate({text}, '{chars}', '')))"

    return f"""
    numbered AS (SELECT row_number() OVER () AS rid, doc_id, text, coalesce(text, '') AS full_text FROM {source}),
    words AS (SELECT rid, regexp_extract_all(full_text, '{WORD}') AS ws FROM numbered),
    placed AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM words),
    windows AS (
        SELECT rid, i, {" || ' ' || ".join(["w"] + [f"lead(w, {k}) OVER (PARTITION BY rid ORDER BY i)" for k in range(1, rules.window)])} AS span
        FROM placed QUALIFY span IS NOT NULL),
    twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, span) > 1 AS again FROM windows),
    ends AS (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS following FROM twice WHERE again),
    repeated AS (
        SELECT rid, sum(least({rules.window}, coalesce(following - i, {rules.window})))::BIGINT AS n FROM ends GROUP BY rid),
    lines AS (
        SELECT rid, unnest(string_split(full_text, chr(10))) AS line, generate_subscripts(string_split(full_text, chr(10)), 1) AS place
        FROM numbered),
    counted AS (SELECT *, len(regexp_extract_all(line, '{WORD}')) AS n FROM lines),
    ruled AS (
        SELECT *, n = 0 OR NOT (
            {count('line', SYMBOLS)} * 100 > n * {rules.line_symbol_percent}
            OR {count('line', '!')} * 100 > n * {rules.line_bang_percent}
            OR ({count('line', SEPARATORS)} >= {rules.min_separators}
                AND {count('line', SEPARATORS)} * 100 > n * {rules.line_separator_percent})
            OR (n <= {rules.boilerplate_max_words} AND regexp_matches(lower(line), '{BOILERPLATE}'))) AS passes
        FROM counted),
    line_sums AS (
        SELECT rid, (count(*) FILTER (WHERE n > 0) - count(DISTINCT line) FILTER (WHERE n > 0))::BIGINT AS n_dup_lines,
            coalesce(sum(n) FILTER (WHERE NOT passes), 0)::BIGINT AS n_lost_words,
            coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE passes), '') AS stay
        FROM ruled GROUP BY rid),
    measured AS (
        SELECT rid, doc_id, text, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
            {count('full_text', SYMBOLS)}::BIGINT AS n_symbols, n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
            n_lost_words, CASE WHEN text IS NOT NULL THEN stay END AS cleaned
        FROM numbered JOIN words USING (rid) JOIN line_sums USING (rid) LEFT JOIN repeated USING (rid)),
    based AS (
        SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed
        FROM measured),
    judged AS (
        SELECT *, NOT base_failed AND n_lost_words * 100 <= n_words * {rules.max_lost_percent} AS kept FROM based)"""


def url_sql(
    source: str = "pages", rules: tuple[tuple[str, str, str], ...] = RULES, vocabulary: UrlVocabulary = UrlVocabulary()
) -> str:
    upper = f"translate(coalesce(url, ''), '{UPPER}', '{LOWER}')"

    def hit(term: str) -> str:
        return f"regexp_matches(lowered, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')::INTEGER"

    longest = sorted(rules, key=lambda r: -len(r[0] + r[1]))

    def by_rule(value: int | None) -> str:
        return " ".join(
            f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p) if value is None else v}'"
            for h, p, v in longest)

    return f"""
    WITH rests AS (
        SELECT page_id, {upper} AS lowered,
            CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM {source}),
    parts AS (
        SELECT page_id, lowered, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
    hits AS (
        SELECT *, {' + '.join(map(hit, vocabulary.strict))} AS strict_hits,
            {' + '.join(hit(t) for t, _ in vocabulary.soft)} AS soft_hits,
            {' + '.join(f'{w} * {hit(t)}' for t, w in vocabulary.soft)} AS soft_weight FROM parts)
    SELECT page_id, host, path, CASE {by_rule(None)} END AS rule,
        CASE {by_rule(1)} WHEN strict_hits > 0 OR (soft_hits >= {vocabulary.min_soft_terms}
            AND soft_weight >= {vocabulary.soft_limit}) THEN 'block' ELSE 'allow' END AS verdict,
        strict_hits, soft_hits, soft_weight FROM hits"""


def mixing_sql(source: str = "documents", params: MixParams = MixParams()) -> str:
    """Quotas by largest remainder, one period played slot by slot, and every row's place in it."""
    period, rows, most = params.period, params.block_rows, params.max_groups - 1
    return f"""
    WITH RECURSIVE ranked AS (
        SELECT source, count(*) AS n, least(row_number() OVER (ORDER BY count(*) DESC, source ASC NULLS LAST) - 1, {most}) AS g
        FROM {source} GROUP BY source),
    weighted AS (SELECT g, sum(n)::BIGINT AS n, pow(sum(n)::DOUBLE, {params.exponent}::DOUBLE) AS w FROM ranked GROUP BY g),
    above AS (SELECT *, greatest(0, w / sum(w) OVER () * {period} - 1) AS x, {period} - count(*) OVER () AS spare FROM weighted),
    scaled AS (SELECT *, x * (spare / sum(x) OVER ()) AS y FROM above),
    quotas AS (
        SELECT g, n, 1 + floor(y)::BIGINT
            + (row_number() OVER (ORDER BY y - floor(y) DESC, g) <= spare - sum(floor(y)::BIGINT) OVER ())::BIGINT AS p
        FROM scaled),
    listed AS (SELECT list(p ORDER BY g) AS ps, list(n ORDER BY g) AS ns, count(*) AS groups FROM quotas),
    played(t, done, before, pick) AS (
        SELECT 0, list_transform(range(groups), lambda i: 0::BIGINT), NULL::BIGINT[], NULL::BIGINT FROM listed WHERE groups > 0
        UNION ALL
        SELECT t + 1, list_transform(range(len(done)), lambda i: done[i + 1] + (i = picked)::BIGINT), done, picked FROM (
            SELECT t, done, list_min(list_transform(
                list_filter(range(len(done)), lambda i: done[i + 1] < ps[i + 1] AND done[i + 1] * {period} // ps[i + 1] <= t),
                lambda i: ((done[i + 1] + 1) * {period} + ps[i + 1] - 1) // ps[i + 1] * 1000 + i)) % 1000 AS picked
            FROM played, listed WHERE t < {period})),
    turns AS (SELECT pick AS g, before[pick + 1] AS nth, t - 1 AS place, before FROM played WHERE t > 0),
    numbered AS (
        SELECT doc_id, d.source, g, row_number() OVER (
            PARTITION BY g ORDER BY coalesce((doc_id % {BUCKETS} + {BUCKETS}) % {BUCKETS}, {BUCKETS}), doc_id) - 1 AS i
        FROM {source} AS d JOIN ranked AS r ON d.source IS NOT DISTINCT FROM r.source),
    blocks AS (SELECT *, i // {rows} AS block, i // {rows} // p AS turn, i // {rows} % p AS nth FROM numbered JOIN quotas USING (g))
    SELECT doc_id, source, g::INTEGER AS source_group, block, turn * {period} + place AS slot,
        block * {period} // p AS release, ((block + 1) * {period} + p - 1) // p AS deadline,
        list_sum(list_transform(range(groups), lambda j: least(ns[j + 1], (turn * ps[j + 1] + before[j + 1]) * {rows})))::BIGINT
            + i % {rows} AS position
    FROM blocks JOIN turns USING (g, nth), listed"""


def collocation_sql(source: str = "documents", params: PhraseParams = PhraseParams()) -> str:
    """All phrases of all pieces counted at once, cut at every place, ranked by language; for up to three words."""
    part = r"[.,;:!?\x0A-\x0D]"
    return f"""
    WITH pieces AS (
        SELECT coalesce(lang, '{UNKNOWN_LANG}') AS lang,
            unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{part}')) AS piece FROM {source}),
    worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
    grams AS (
        SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
        FROM worded, (SELECT unnest(range(1, {params.max_words + 1})) AS size) WHERE len(w) >= size),
    counts AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL),
    totals AS (SELECT lang, sum(a)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
    frequent AS (SELECT * FROM counts WHERE a >= {params.min_count}),
    candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM frequent WHERE size > 1),
    cuts AS (
        SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
        FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)),
    scored AS (
        SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, (1000000::HUGEINT * c.a * c.a // (x.a::HUGEINT * y.a))::BIGINT AS score
        FROM cuts AS c JOIN frequent AS x ON c.lang = x.lang AND c.first = x.phrase
            JOIN frequent AS y ON c.lang = y.lang AND c.rest = y.phrase),
    weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    around AS (
        SELECT lang, inside AS phrase, max(a) AS around
        FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS inside
            FROM candidates WHERE size = 3) GROUP BY ALL),
    ranked AS (
        SELECT w.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
        FROM weakest AS w LEFT JOIN around USING (lang, phrase)
        WHERE around IS NULL OR 100 * around < {params.inside_percent} * a)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {params.top}"""


ORACLE = {
    "op1_quality_rules": f"""WITH {quality_sql()}
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lost_words,
            sha256(coalesce(cleaned, '')) AS cleaned_sha256 FROM judged""",
    "op3_url_filter": url_sql(),
    "op9_source_mixing": mixing_sql(),
    "op11_phrase_collocations": collocation_sql(),
}
