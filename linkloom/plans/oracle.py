"""DuckDB SQL for the queries of :mod:`linkloom.plans.queries`."""

from __future__ import annotations

from collections.abc import Mapping

from linkloom.functions.text import (
    ADDRESS_WORDS,
    GENERIC_WORDS,
    LEGAL_FORMS,
    TRAILING_FORMS,
)

_LIST = "list_filter(string_split({}, ' '), lambda w: w <> '')"


def normalise(x: str) -> str:
    lowered = f"lower(replace(strip_accents(coalesce({x}, '')), '&', ' and '))"
    return f"trim(regexp_replace({lowered}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def words(x: str) -> str:
    return _LIST.format(x)


def mapped(x: str, table: Mapping[str, str]) -> str:
    entries = ", ".join(f"'{k}': '{v}'" for k, v in table.items())
    return f"array_to_string(list_transform({words(x)}, lambda w: coalesce(MAP {{{entries}}}[w], w)), ' ')"


def legal(x: str) -> str:
    spaced = f"'  ' || replace({x}, ' ', '  ') || '  '"
    for a, b in (("l  l  c", "llc"), ("p  l  c", "plc"), ("l  l  p", "llp"), ("p  c", "pc")):
        spaced = f"replace({spaced}, ' {a} ', ' {b} ')"
    return mapped(f"trim(regexp_replace({spaced}, ' +', ' ', 'g'))", LEGAL_FORMS)


def country(x: str) -> str:
    return f"lower(trim(coalesce({x}, '')))"


_GENERIC = "[" + ", ".join(f"'{w}'" for w in GENERIC_WORDS) + "]"


def first_word(x: str) -> str:
    return f"coalesce(list_filter({words(x)}, lambda w: length(w) >= 3 AND NOT list_contains({_GENERIC}, w))[1], '')"


def prefix(x: str) -> str:
    joined = f"replace({x}, ' ', '')"
    return f"CASE WHEN length({joined}) >= 4 THEN substr({joined}, 1, 4) ELSE '' END"


def study(x: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', ' ', 'g'))"


def exact(x: str) -> str:
    """The exact matcher's rules, on texts that are in composed form."""
    padded = f"regexp_replace(lower(coalesce({x}, '')), '(^|[^\\p{{L}}\\p{{N}}_])(null|nan|none)($|[^\\p{{L}}\\p{{N}}_])', '\\1 \\3', 'g')"
    return f"trim(regexp_replace(regexp_replace({padded}, '\\p{{P}}', ' ', 'g'), '\\s+', ' ', 'g'))"


def exact_name(x: str) -> str:
    forms = "|".join((*TRAILING_FORMS, "s a s"))
    return f"regexp_replace({exact(x)}, '(?:^|\\s+)(?:{forms})(?:\\s+(?:{forms}))*$', '')"


def profile_clean(x: str) -> str:
    return f"lower(trim(regexp_replace(coalesce({x}, ''), '\\s+', ' ', 'g')))"


def shared(a: str, b: str) -> str:
    return f"length(list_intersect({words(a)}, {words(b)}))"


def _distinct(a: str) -> str:
    return f"length(list_distinct({words(a)}))"


def jaccard(a: str, b: str) -> str:
    both = f"({_distinct(a)} + {_distinct(b)} - {shared(a, b)})"
    return f"CASE WHEN {both} = 0 THEN 0.0 ELSE {shared(a, b)}::DOUBLE / {both} END"


def dice(a: str, b: str) -> str:
    both = f"({_distinct(a)} + {_distinct(b)})"
    return f"CASE WHEN {both} = 0 THEN 0.0 ELSE 2.0 * {shared(a, b)} / {both} END"


def overlap(a: str, b: str) -> str:
    least = f"least({_distinct(a)}, {_distinct(b)})"
    return f"CASE WHEN {least} = 0 THEN 0.0 ELSE {shared(a, b)}::DOUBLE / {least} END"


def edit(a: str, b: str) -> str:
    return (f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 WHEN {a} = {b} THEN 1.0 ELSE "
            f"1.0 - levenshtein({a}, {b})::DOUBLE / greatest(length({a}), length({b})) END")


def common_prefix(a: str, b: str) -> str:
    same = f"length(list_filter(range(1, least(length({a}), length({b})) + 1), lambda i: substr({a}, 1, i::INT) = substr({b}, 1, i::INT)))"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE {same}::DOUBLE / greatest(length({a}), length({b})) END"


# -- common table expressions ----------------------------------------------

def _records(source: str, truth: str) -> str:
    """The tables that queries share, from ``source``: source, entity_id,
    business_name, business_address, country; ``truth`` joins ``a`` and ``b``."""
    return f"""
rec AS ({source}), base AS (
    SELECT *, {normalise('business_name')} AS name, {normalise('business_address')} AS plain_address,
           {country('country')} AS ckey FROM rec
), norm AS MATERIALIZED (
    SELECT source, entity_id, ckey AS country, name, {legal('name')} AS legal,
           {mapped('plain_address', ADDRESS_WORDS)} AS address FROM base
), spread AS (
    SELECT entity_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM (SELECT entity_id, {words('address')} AS w FROM norm)
), distinct_words AS MATERIALIZED (
    SELECT entity_id, word, min(place) AS place FROM spread WHERE length(word) >= 3 GROUP BY ALL
), lists AS (SELECT entity_id, list(word ORDER BY place) AS awords FROM distinct_words GROUP BY 1),
words AS MATERIALIZED (
    SELECT source, entity_id, country, name, legal, address, {first_word('legal')} AS word,
           {prefix('name')} AS prefix, coalesce(awords, []) AS awords FROM norm LEFT JOIN lists USING (entity_id)
), keys AS MATERIALIZED (
    SELECT source, entity_id, country, 'name_word' AS kind, word AS key, 0 AS pos FROM words
    UNION ALL SELECT source, entity_id, country, 'exact_name', name, 0 FROM words
    UNION ALL SELECT source, entity_id, country, 'exact_address', address, 0 FROM words
    UNION ALL SELECT source, entity_id, country, 'legal_name', legal, 0 FROM words
    UNION ALL SELECT source, entity_id, country, 'name_word_legal', word, 0 FROM words
    UNION ALL SELECT source, entity_id, country, 'name_prefix', prefix, 0 FROM words
    UNION ALL SELECT source, entity_id, country, 'address_word', d.word, place FROM norm JOIN distinct_words d USING (entity_id)
), truth AS MATERIALIZED (
    SELECT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id
    FROM ({truth} AND source = 1) a JOIN ({truth} AND source > 1) b ON a.n = b.n
), ids AS (SELECT entity_id AS source1_entity_id FROM rec WHERE source = 1)"""


_PARTS = "string_split_regex(coalesce(text, ''), '[ \\t\\n\\r]+')"
RECORDS = _records(f"""
    SELECT 1 + doc_id % 3 AS source, 'S' || (1 + doc_id % 3) || '-' || doc_id AS entity_id,
           array_to_string({_PARTS}[1:4], ' ') AS business_name, array_to_string({_PARTS}[5:], ' ') AS business_address,
           lang AS country, text
    FROM documents""", f"SELECT entity_id, {normalise('text')} AS n FROM rec WHERE true")
PART_RECORDS = _records("""
    SELECT 1 + p_partkey % 3 AS source, 'S' || (1 + p_partkey % 3) || '-' || p_partkey AS entity_id,
           p_name AS business_name, p_size || ' ' || p_type || ' St.' AS business_address, p_brand AS country
    FROM part""", "SELECT entity_id, name || '|' || address || '|' || country AS n FROM norm WHERE true")


def ratios(pairs: str, a: str, b: str, name: str) -> str:
    """``name``: ``x, y, ratio`` of the distinct pairs of strings ``a, b`` of
    relation ``pairs``, neither empty nor of 200 characters or more, by the
    longest matching block first.  For ``WITH RECURSIVE``."""
    return f"""
{name}_s AS MATERIALIZED (SELECT DISTINCT {a} AS x, {b} AS y FROM {pairs} WHERE {a} <> '' AND {b} <> ''),
{name}_c AS (
    SELECT x, y, i, j FROM (
        SELECT x, y, string_split(x, '') AS xs, string_split(y, '') AS ys, unnest(range(length(x))) AS i FROM {name}_s
    ), LATERAL (SELECT unnest(range(length(y))) AS j) WHERE xs[i + 1] = ys[j + 1]
), {name}_p AS MATERIALIZED (
    SELECT x, y, i, j, max(i) OVER (PARTITION BY x, y, j - i, island) - i + 1 AS run
    FROM (SELECT *, i - row_number() OVER (PARTITION BY x, y, j - i ORDER BY i) AS island FROM {name}_c)
), {name}_r AS (
    SELECT x, y, 0::BIGINT AS alo, length(x)::BIGINT AS ahi, 0::BIGINT AS blo, length(y)::BIGINT AS bhi, 0::BIGINT AS hit FROM {name}_s
    UNION ALL
    SELECT x, y, CASE side WHEN 0 THEN alo ELSE m.i + m.k END, CASE side WHEN 0 THEN m.i ELSE ahi END,
           CASE side WHEN 0 THEN blo ELSE m.j + m.k END, CASE side WHEN 0 THEN m.j ELSE bhi END, CASE side WHEN 0 THEN m.k ELSE 0 END
    FROM (
        SELECT r.x, r.y, alo, ahi, blo, bhi,
               arg_max({{'i': p.i, 'j': p.j, 'k': least(run, ahi - p.i, bhi - p.j)}},
                       least(run, ahi - p.i, bhi - p.j) * 1000000 - p.i * 1000 - p.j) AS m
        FROM {name}_r r JOIN {name}_p p ON r.x = p.x AND r.y = p.y AND p.i >= alo AND p.i < ahi AND p.j >= blo AND p.j < bhi
        GROUP BY ALL
    ), (SELECT unnest([0, 1]) AS side)
), {name} AS MATERIALIZED (SELECT x, y, 2.0::DOUBLE * sum(hit) / (length(x) + length(y)) AS ratio FROM {name}_r GROUP BY x, y)"""


def blocks(cap: int, per_entity: int) -> str:
    """``cand``: distinct candidate pairs of all four blocks."""
    return f"""
freq AS (SELECT country, key, count(*) AS freq FROM keys WHERE source > 1 AND kind = 'address_word' GROUP BY ALL),
rare AS (
    SELECT entity_id, country, key, freq, pos,
           row_number() OVER (PARTITION BY entity_id ORDER BY freq, pos) AS rank
    FROM keys JOIN freq USING (country, key) WHERE source = 1 AND kind = 'address_word' AND freq <= {cap}
), probe AS (
    SELECT entity_id, kind, country, key FROM keys
    WHERE source = 1 AND kind IN ('name_word', 'exact_name', 'exact_address') AND key <> ''
    UNION ALL SELECT entity_id, 'address_word', country, key FROM rare WHERE rank <= {max(per_entity, 1)}
), cand AS MATERIALIZED (
    SELECT DISTINCT p.entity_id AS source1_entity_id, k.entity_id AS candidate_entity_id
    FROM probe p JOIN keys k USING (kind, country, key) WHERE k.source > 1
)"""


def block_pairs(kind: str) -> str:
    return f"""SELECT DISTINCT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id
        FROM keys a JOIN keys b USING (kind, country, key)
        WHERE a.source = 1 AND b.source > 1 AND kind = '{kind}' AND key <> ''"""


def macro(of: str, by: str = "") -> str:
    """Macro measures of relation ``of`` (pairs, and column ``by``) against truth."""
    each = f"{by}, " if by else ""
    ids = f"(SELECT * FROM ids, (SELECT DISTINCT {by} FROM grid))" if by else "ids"
    return f"""
counted AS (
    SELECT {each}i.source1_entity_id, coalesce(any_value(t.n), 0) AS n_true,
           count(p.candidate_entity_id) AS n_pred, count(h.candidate_entity_id) AS n_hit
    FROM {ids} i
    LEFT JOIN (SELECT source1_entity_id, count(*) AS n FROM truth GROUP BY 1) t USING (source1_entity_id)
    LEFT JOIN {of} p USING ({each}source1_entity_id)
    LEFT JOIN truth h ON h.source1_entity_id = p.source1_entity_id AND h.candidate_entity_id = p.candidate_entity_id
    GROUP BY ALL
), rated AS (
    SELECT *, CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0 WHEN n_true = 0 OR n_pred = 0 THEN 0.0
                   ELSE n_hit::DOUBLE / n_pred END AS p,
              CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0 WHEN n_true = 0 OR n_pred = 0 THEN 0.0
                   ELSE n_hit::DOUBLE / n_true END AS r
    FROM counted
), measured AS (
    SELECT {each}avg(p) AS macro_precision, avg(r) AS macro_recall,
           avg(CASE WHEN p + r > 0 THEN 1.25 * p * r / (0.25 * p + r) ELSE 0.0 END) AS macro_f05
    FROM rated {f"GROUP BY {by}" if by else ""}
)"""
