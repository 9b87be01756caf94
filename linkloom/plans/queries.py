"""The engine's queries over the driver's tables, and their DuckDB SQL.

Records come from ``documents`` as :mod:`linkloom.plans.records` describes; all
queries run over all of them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions import similarity as S
from linkloom.functions import text
from linkloom.operators import blocking, evaluation, learning, matching, profiling, validation
from linkloom.plans import oracle as O
from linkloom.plans import records as R
from linkloom.sources import tables

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its name, with its SQL if SQL can express it."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _with(*parts: str, then: str) -> str:
    return f"WITH {', '.join(p.strip() for p in (O.RECORDS, *parts))} {then}"


def _all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.records(spark, sf_dir).drop("source")


def _norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.normalised(_all(spark, sf_dir))


def _ids(s1: DataFrame) -> DataFrame:
    return s1.select(F.col("entity_id").alias("source1_entity_id"))


# -- blocks ----------------------------------------------------------------


def _block(kind: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s23 = R.sides(spark, sf_dir)
    return blocking.candidates(s1, s23, kinds=[kind])


@query(_with(then=O.block_pairs("exact_name")))
def exact_name_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _block("exact_name", spark, sf_dir)


@query(_with(then=O.block_pairs("exact_address")))
def exact_address_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _block("exact_address", spark, sf_dir)


@query(_with(then=O.block_pairs("name_word")))
def name_word_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _block("name_word", spark, sf_dir)


_RARE_PAIRS = """SELECT DISTINCT r.entity_id AS source1_entity_id, k.entity_id AS candidate_entity_id
    FROM rare r JOIN keys k USING (country, key) WHERE r.rank <= 2 AND k.source > 1 AND k.kind = 'address_word'"""


@query(_with(O.blocks(5000, 2), then=_RARE_PAIRS))
def address_word_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _block("address_word", spark, sf_dir)


@query(_with(O.blocks(5000, 2), then="SELECT * FROM cand"))
def candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.candidates(*R.sides(spark, sf_dir))


_LISTS = """SELECT source1_entity_id, coalesce(string_agg(candidate_entity_id, ',' ORDER BY candidate_entity_id), '')
    AS candidate_entity_ids FROM ids LEFT JOIN cand USING (source1_entity_id) GROUP BY 1"""


@query(_with(O.blocks(5000, 2), then=_LISTS))
def candidate_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s23 = R.sides(spark, sf_dir)
    return blocking.listed(s1, blocking.candidates(s1, s23))


_ALL_WORDS = """SELECT DISTINCT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id
    FROM keys a JOIN keys b USING (kind, country, key)
    WHERE a.source = 1 AND b.source > 1 AND kind IN ('name_word', 'address_word') AND key <> ''"""


@query(_with(then=_ALL_WORDS))
def all_word_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.all_word_candidates(*R.sides(spark, sf_dir))


_STRATEGIES = ", ".join(f"'{k}'" for k in blocking.NAME_STRATEGIES)
_BY_STRATEGY = f"""SELECT DISTINCT kind, a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id
    FROM keys a JOIN keys b USING (kind, country, key)
    WHERE a.source = 1 AND b.source > 1 AND kind IN ({_STRATEGIES}) AND key <> ''"""


@query(_with(then=_BY_STRATEGY))
def strategy_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.by_strategy(*R.sides(spark, sf_dir))


@query(_with(then="""SELECT kind, country, key, count(*) AS freq FROM keys
    WHERE source > 1 AND kind = 'address_word' GROUP BY ALL"""))
def address_word_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, s23 = R.sides(spark, sf_dir)
    return blocking.frequencies(blocking.keys(blocking.normalised(s23), ["address_word"]))


@query(_with(O.blocks(5000, 2), then="SELECT entity_id, key, freq, rank FROM rare WHERE rank <= 2"))
def rare_address_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s23 = R.sides(spark, sf_dir)
    own, other = (blocking.keys(blocking.normalised(r), ["address_word"]) for r in (s1, s23))
    found = blocking.rare_words(own, blocking.frequencies(other), blocking.MAX_BUCKET, blocking.ADDRESS_KEYS)
    return found.select("entity_id", "key", "freq", F.col("rank").cast("long").alias("rank"))


@query(_with(O.blocks(5000, 2), then="""SELECT DISTINCT r.entity_id, r.business_name, r.business_address, r.country
    FROM rec r JOIN cand c ON r.entity_id = c.candidate_entity_id"""))
def needed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s23 = R.sides(spark, sf_dir)
    return blocking.needed_records(s23, blocking.candidate_ids(s1, s23))


# -- normal forms ----------------------------------------------------------


@query(f"SELECT doc_id, {O.normalise('text')} AS normal FROM documents")
def normalise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.documents(spark, sf_dir).select("doc_id", text.normalise(F.col("text")).alias("normal"))


@query(_with(then="SELECT entity_id, legal AS business_name, address AS business_address, name AS plain_name, country FROM norm"))
def normalise_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _all(spark, sf_dir)
    whole = text.normalised_record(F.col("business_name"), F.col("business_address"), F.col("country"))
    return rows.select("entity_id", whole.alias("r"), text.normalise(F.col("business_name")).alias("plain_name")).select(
        "entity_id", "r.*", "plain_name")


@query(_with(then="SELECT entity_id, word, prefix, legal, array_to_string(awords, ',') AS address_words FROM words"))
def blocking_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _norm(spark, sf_dir).select(
        "entity_id", text.first_word_of(F.col("legal")).alias("word"), text.prefix_of(F.col("name")).alias("prefix"),
        "legal", F.array_join(text.address_words_of(F.col("address")), ",").alias("address_words"))


@query(f"""SELECT doc_id, length({O.words(O.normalise('text'))}) AS n_words,
    length(list_distinct({O.words(O.normalise('text'))})) AS n_distinct FROM documents""")
def text_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = text.tokens(F.col("text"))
    return R.documents(spark, sf_dir).select(
        "doc_id", F.size(found).cast("long").alias("n_words"), F.size(F.array_distinct(found)).cast("long").alias("n_distinct"))


@query(_with(then=f"""SELECT entity_id, {O.exact_name('business_name')} AS name, {O.exact('business_address')} AS address,
    {O.country('country')} AS country FROM rec"""))
def exact_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.exact_forms(_all(spark, sf_dir))


@query(_with(then=f"""SELECT entity_id, {O.study('business_name')} AS name,
    length(list_distinct({O.words(O.study('business_address'))})) AS n_address_words,
    {O.profile_clean('business_name')} AS cleaned, trim(coalesce(business_address, '')) = '' AS no_address FROM rec"""))
def study_and_profile_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, address = F.col("business_name"), F.col("business_address")
    return _all(spark, sf_dir).select(
        "entity_id", text.study_normalise(name).alias("name"),
        F.size(text.study_tokens(address)).cast("long").alias("n_address_words"),
        text.profile_clean(name).alias("cleaned"), text.is_missing(address).alias("no_address"))


# -- pair features ---------------------------------------------------------

_SIDED = """
sided AS MATERIALIZED (
    SELECT p.*, a.name AS n1, b.name AS n2, a.address AS a1, b.address AS a2, a.country AS c1, b.country AS c2
    FROM cand p JOIN norm a ON p.source1_entity_id = a.entity_id JOIN norm b ON p.candidate_entity_id = b.entity_id
)"""
_FEATURED = f"""
featured AS MATERIALIZED (
    SELECT source1_entity_id, candidate_entity_id, n1, n2, a1, a2,
        ({O.jaccard('n1', 'n2')})::FLOAT AS name_token_jaccard, ({O.dice('n1', 'n2')})::FLOAT AS name_token_overlap,
        (n1 <> '' AND n1 = n2)::INT::FLOAT AS name_exact_match, ({O.common_prefix('n1', 'n2')})::FLOAT AS name_prefix_sim,
        ({O.jaccard('a1', 'a2')})::FLOAT AS addr_token_jaccard, ({O.dice('a1', 'a2')})::FLOAT AS addr_token_overlap,
        (a1 <> '' AND a1 = a2)::INT::FLOAT AS addr_exact_match, (c1 <> '' AND c1 = c2)::INT::FLOAT AS same_country,
        abs(length(n1) - length(n2))::FLOAT AS name_len_diff, abs(length(a1) - length(a2))::FLOAT AS addr_len_diff,
        {O.shared('n1', 'n2')}::FLOAT AS name_shared_tokens, {O.shared('a1', 'a2')}::FLOAT AS addr_shared_tokens,
        ({O.shared('n1', 'n2')} + {O.shared('a1', 'a2')})::FLOAT AS total_shared_tokens
    FROM sided
)"""
_PAIRED = ", ".join(x.strip() for x in (O.blocks(5000, 2), _SIDED, _FEATURED))


def _blocked(spark: SparkSession, sf_dir: str, of=R.records):
    """The candidates' blocks, and the stored normal forms of both sides."""
    s1, s23 = R.sides(spark, sf_dir, of)
    forms = blocking.normal_forms(s1, s23)
    found = blocking.blocks(s1, s23, forms=forms)
    return found._replace(rest=tables.stored(found.rest, "rest")), forms


def _five_places(found: DataFrame) -> DataFrame:
    """No feature is negative, and a float has no tie that a product would hide."""
    return found.select(*evaluation.PAIR, *(
        (F.floor(F.col(c).cast("double") * 1e5 + 0.5) / 1e5).alias(c) for c in found.columns if c not in evaluation.PAIR))


_FIVE = "round(COLUMNS(* EXCLUDE (source1_entity_id, candidate_entity_id, n1, n2, a1, a2))::DOUBLE, 5)"


@query(_with(_PAIRED, then=f"SELECT source1_entity_id, candidate_entity_id, {_FIVE} FROM featured"))
def pair_word_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _five_places(matching.word_features(*_blocked(spark, sf_dir)))


def _recursive(*parts: str, then: str) -> str:
    return f"WITH RECURSIVE {', '.join(p.strip() for p in parts)} {then}"


@query(_recursive(O.RECORDS, O.blocks(5000, 2), _SIDED, O.ratios("sided", "n1", "n2", "rn"), then="""
SELECT source1_entity_id, candidate_entity_id, round(coalesce(ratio, 0), 6) AS name_ratio
FROM sided LEFT JOIN rn ON n1 = x AND n2 = y"""))
def name_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matching ratio of the names of all candidate pairs."""
    rows = matching.name_ratios(*_blocked(spark, sf_dir))
    return rows.select(*evaluation.PAIR, (F.floor(F.col("name_ratio") * 1e6 + 0.5) / 1e6).alias("name_ratio"))


_STUDIED = f"""
forms AS (
    SELECT entity_id, {O.study('business_name')} AS n, {O.study('business_address')} AS a, {O.study('country')} AS c FROM rec
), faced AS MATERIALIZED (
    SELECT p.*, x.n AS n1, y.n AS n2, x.a AS a1, y.a AS a2, x.c AS c1, y.c AS c2
    FROM studied_pairs p JOIN forms x ON p.source1_entity_id = x.entity_id JOIN forms y ON p.candidate_entity_id = y.entity_id
), studied AS MATERIALIZED (
    SELECT source1_entity_id, candidate_entity_id,
        (n1 <> '' AND n1 = n2)::INT AS name_exact, {O.jaccard('n1', 'n2')} AS name_jaccard,
        {O.edit('n1', 'n2')} AS name_edit_similarity, {O.overlap('n1', 'n2')} AS name_token_overlap,
        (a1 <> '' AND a1 = a2)::INT AS address_exact, {O.jaccard('a1', 'a2')} AS address_jaccard,
        {O.edit('a1', 'a2')} AS address_edit_similarity, {O.overlap('a1', 'a2')} AS address_token_overlap,
        (c1 <> '' AND c1 = c2)::INT AS country_match, (n1 = '' OR n2 = '')::INT AS name_missing,
        (a1 = '' OR a2 = '')::INT AS address_missing, (c1 = '' OR c2 = '')::INT AS country_missing, label
    FROM faced
)"""
_FLOATS = ("name_jaccard", "name_edit_similarity", "name_token_overlap", "address_jaccard", "address_edit_similarity", "address_token_overlap")


@query(_with(O.blocks(5000, 2), """studied_pairs AS (SELECT c.*, (t.source1_entity_id IS NOT NULL)::INT AS label
    FROM cand c LEFT JOIN truth t USING (source1_entity_id, candidate_entity_id))""", _STUDIED,
             then=f"SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in _FLOATS)}) FROM studied"))
def study_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = _blocked(spark, sf_dir)
    rows = matching.labelled(matching.study_blocks(found, *R.sides(spark, sf_dir)), R.truth(spark, sf_dir), wide=True)
    return rows.select(*evaluation.PAIR, "label", *(
        F.round(c, 6).alias(c) if c in _FLOATS else F.col(c) for c in S.STUDY_FEATURES))


_STUDY = learning.STUDY_PAIRS
_SAMPLED = f"""
salted AS (SELECT entity_id, source, md5('{learning.SEED}:' || entity_id) AS salt FROM rec),
own AS (SELECT entity_id AS source1_entity_id, row_number() OVER (ORDER BY salt, entity_id) AS place FROM salted WHERE source = 1),
ring AS (SELECT entity_id AS candidate_entity_id, row_number() OVER (ORDER BY salt, entity_id) AS slot FROM salted WHERE source > 1),
tries AS (SELECT least(greatest(coalesce(max(n), 0) + 1, 3), (SELECT count(*) FROM ring)) AS tries FROM (
    SELECT count(*) AS n FROM (SELECT DISTINCT * FROM truth) SEMI JOIN (SELECT * FROM own WHERE place <= {_STUDY}) o USING (source1_entity_id)
    GROUP BY source1_entity_id)),
sizes AS (SELECT tries, least(greatest(3 * {_STUDY}, tries), (SELECT count(*) FROM ring)) AS size FROM tries),
tried AS (SELECT source1_entity_id, place, unnest(range(tries)) AS step, size FROM own, sizes WHERE place <= {_STUDY}),
negative AS (
    SELECT source1_entity_id, candidate_entity_id FROM (
        SELECT t.*, candidate_entity_id, row_number() OVER (PARTITION BY t.source1_entity_id ORDER BY step) AS rank
        FROM tried t JOIN ring ON slot = (place * 3 + step) % size + 1
        ANTI JOIN truth u ON u.source1_entity_id = t.source1_entity_id AND u.candidate_entity_id = ring.candidate_entity_id
    ) WHERE rank = 1 ORDER BY place LIMIT {_STUDY}
), positive AS (SELECT DISTINCT * FROM truth ORDER BY ALL LIMIT {_STUDY}),
studied_pairs AS (SELECT *, 1 AS label FROM positive UNION ALL SELECT *, 0 FROM negative)"""


def _studied(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s23 = R.sides(spark, sf_dir)
    return matching.study_features(learning.study_sample(s1, s23, R.truth(spark, sf_dir)), s1, s23)


@query(_with(_SAMPLED, then="SELECT * FROM studied_pairs"))
def study_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The study's pairs, as many positives as its cap allows and as many negatives."""
    return learning.study_sample(*R.sides(spark, sf_dir), R.truth(spark, sf_dir))


@query(_with(_SAMPLED, _STUDIED, then=" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(avg({c}) FILTER (label = 0), 3) AS negative,
    round(avg({c}) FILTER (label = 1), 3) AS positive FROM studied""" for c in S.STUDY_FEATURES)))
def feature_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.label_means(_studied(spark, sf_dir), S.STUDY_FEATURES)


@query(_with(_SAMPLED, _STUDIED, then=" UNION ALL ".join(
    f"""SELECT '{a}' AS a, '{b}' AS b, round(CASE WHEN stddev_pop({a}) * stddev_pop({b}) = 0 THEN NULL
    ELSE covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END, 2) AS corr FROM studied"""
    for a in S.STUDY_FEATURES for b in S.STUDY_FEATURES)))
def feature_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.correlations(_studied(spark, sf_dir), S.STUDY_FEATURES)


# -- the same on parts, whose short fields SQL can compare letter by letter --

_PARTED = (O.PART_RECORDS, O.blocks(5000, 2), _SIDED, O.ratios("sided", "n1", "n2", "rn"), O.ratios("sided", "a1", "a2", "ra"))
_PART_SCORED = f"""
scored AS (SELECT source1_entity_id, candidate_entity_id, name_score, address_score, 0.6::DOUBLE * name_score + 0.4::DOUBLE * address_score AS final_score
FROM (
    SELECT sided.*, greatest(coalesce(rn.ratio, 0), {O.jaccard('n1', 'n2')}) AS name_score,
           greatest(coalesce(ra.ratio, 0), {O.jaccard('a1', 'a2')}) AS address_score
    FROM sided LEFT JOIN rn ON n1 = rn.x AND n2 = rn.y LEFT JOIN ra ON a1 = ra.x AND a2 = ra.y
))"""
_SCORES = ("name_score", "address_score", "final_score")
_SIX = ", ".join(f"round({c}, 6) AS {c}" for c in _SCORES)


@query(_recursive(*_PARTED, _PART_SCORED, then=f"SELECT source1_entity_id, candidate_entity_id, {_SIX} FROM scored"))
def part_scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.scored_blocks(*_blocked(spark, sf_dir, R.part_records)).withColumns({c: F.round(c, 6) for c in _SCORES})


@query(_recursive(*_PARTED, _PART_SCORED, then=f"""SELECT source1_entity_id, candidate_entity_id, {_SIX} FROM scored
    WHERE final_score >= {matching.THRESHOLD}"""))
def part_match_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match_blocks(*_blocked(spark, sf_dir, R.part_records)).withColumns({c: F.round(c, 6) for c in _SCORES})


@query(_recursive(*_PARTED, _FEATURED, then=f"""SELECT source1_entity_id, candidate_entity_id,
    round(coalesce(rn.ratio, 0)::FLOAT::DOUBLE, 5) AS name_char_sim, round(coalesce(rn.ratio, 0)::FLOAT::DOUBLE, 5) AS name_seq_ratio,
    round(coalesce(ra.ratio, 0)::FLOAT::DOUBLE, 5) AS addr_char_sim, {", ".join(
        f"round({c}::DOUBLE, 5) AS {c}" for c in S.FEATURES if c not in ("name_char_sim", "name_seq_ratio", "addr_char_sim"))}
    FROM featured LEFT JOIN rn ON n1 = rn.x AND n2 = rn.y LEFT JOIN ra ON a1 = ra.x AND a2 = ra.y"""))
def part_pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _five_places(matching.block_features(*_blocked(spark, sf_dir, R.part_records)))


# -- decisions -------------------------------------------------------------

_EXACT = f"""
efo AS MATERIALIZED (SELECT source, entity_id, {O.country('country')} AS country, {O.exact_name('business_name')} AS name,
    {O.exact('business_address')} AS address FROM rec), by_name AS (
    SELECT DISTINCT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id
    FROM efo a JOIN efo b USING (country, name) WHERE a.source = 1 AND b.source > 1 AND name <> ''
), by_address AS (
    SELECT DISTINCT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id
    FROM efo a JOIN efo b USING (country, address) WHERE a.source = 1 AND b.source > 1 AND address <> ''
)"""


@query(_with(_EXACT, then="""SELECT * FROM by_name UNION ALL SELECT * FROM by_address
    WHERE source1_entity_id NOT IN (SELECT source1_entity_id FROM by_name)"""))
def match_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match_exact(*R.sides(spark, sf_dir))


def _unambiguous(stored: str) -> str:
    hits = lambda c: f"""SELECT DISTINCT a.entity_id AS i, b.entity_id AS j FROM norm a JOIN {stored} b  # noqa: E731
        ON a.country = b.country AND a.{c} = b.{c} WHERE a.source = 1 AND b.source > 1 AND a.{c} <> ''""".replace("  # noqa: E731", "")
    return _with(_EXACT, f"hn AS ({hits('name')}), ha AS ({hits('address')})", """
hits AS (SELECT i, j, max(n) AS n, max(a) AS a FROM (
    SELECT i, j, 1 AS n, 0 AS a FROM hn UNION ALL SELECT i, j, 0, 1 FROM ha) GROUP BY i, j)""", then="""
SELECT source1_entity_id, coalesce(string_agg(j, ',' ORDER BY j), '') AS candidate_entity_ids,
    CASE WHEN sum(n * a) = 1 THEN max(j) FILTER (n * a = 1) WHEN sum(n) = 1 THEN max(j) FILTER (n = 1)
         WHEN sum(a) = 1 THEN max(j) FILTER (a = 1) ELSE '' END AS matched_entity_ids
FROM ids LEFT JOIN hits ON source1_entity_id = i GROUP BY 1""")


@query(_unambiguous("efo"))
def match_unambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match_exact_unambiguous(*R.sides(spark, sf_dir))


@query(_unambiguous("norm"))
def match_unambiguous_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match_exact_unambiguous(*R.sides(spark, sf_dir), faithful=False)


@query()
def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.scored_blocks(*_blocked(spark, sf_dir))


@query()
def match_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match_blocks(*_blocked(spark, sf_dir))


@query()
def pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.block_features(*_blocked(spark, sf_dir))


@query(_with(O.blocks(5000, 2), then="""SELECT c.*, (t.source1_entity_id IS NOT NULL)::INT AS label
    FROM cand c LEFT JOIN truth t USING (source1_entity_id, candidate_entity_id)"""))
def labelled_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.labelled(blocking.candidates(*R.sides(spark, sf_dir)), R.truth(spark, sf_dir))


# -- measures --------------------------------------------------------------

_ROUNDED = "round(macro_precision, 6) AS macro_precision, round(macro_recall, 6) AS macro_recall, round(macro_f05, 6) AS macro_f05"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c, kind in df.dtypes if kind == "double" and c != "threshold"})


@query(_with(f"pred AS ({O.block_pairs('exact_address')})", O.macro("pred"), then=f"SELECT {_ROUNDED} FROM measured"))
def macro_f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s23 = R.sides(spark, sf_dir)
    found = blocking.candidates(s1, s23, kinds=["exact_address"])
    return _rounded(evaluation.macro_f05(_ids(s1), R.truth(spark, sf_dir), found))


def _word_scores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, blocking.Blocks]:
    """Candidates with a score to six places, and their blocks."""
    found, forms = _blocked(spark, sf_dir)
    rows = matching.word_features(found, forms, ("name_token_jaccard", "addr_token_jaccard"))
    score = S.weighted(F.col("name_token_jaccard").cast("double"), F.col("addr_token_jaccard").cast("double"))
    return rows.select(*evaluation.PAIR, (F.floor(score * 1e6 + 0.5) / 1e6).alias("score")), found


_SCORED = """
scores AS (SELECT source1_entity_id, candidate_entity_id,
    round(0.6::DOUBLE * name_token_jaccard::DOUBLE + 0.4::DOUBLE * addr_token_jaccard::DOUBLE, 6) AS score FROM featured)"""


def _grid(values) -> str:
    return f"grid AS (SELECT unnest([{', '.join(f'{v}::DOUBLE' for v in values)}]) AS threshold)"


@query(_with(_PAIRED, _SCORED, _grid(evaluation.GRID),
             "kept AS (SELECT threshold, source1_entity_id, candidate_entity_id FROM scores, grid WHERE score >= threshold)",
             O.macro("kept", "threshold"), then="""
SELECT threshold, round(macro_precision, 6) AS precision, round(macro_recall, 6) AS recall, round(macro_f05, 6) AS macro_f05,
       (SELECT count(*) FROM scores) AS num_candidate_pairs,
       (SELECT count(*) FROM kept k WHERE k.threshold = m.threshold) AS num_predicted_matches
FROM measured m"""))
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, _ = R.sides(spark, sf_dir)
    scores, found = _word_scores(spark, sf_dir)
    return _rounded(evaluation.sweep(_ids(s1), R.truth(spark, sf_dir), scores, "score", once=found.once))


@query(_with(_PAIRED, _SCORED, _grid(evaluation.GRID),
             "kept AS (SELECT threshold, source1_entity_id, candidate_entity_id FROM scores, grid WHERE score >= threshold)",
             O.macro("kept", "threshold"), then="SELECT threshold FROM measured ORDER BY round(macro_f05, 6) DESC, threshold LIMIT 1"))
def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lowest threshold of the highest macro F0.5."""
    found = evaluation.best_threshold(threshold_sweep(spark, sf_dir))
    return spark.createDataFrame([(found,)], "threshold double")


@query(_with(_PAIRED, _SCORED, _grid(evaluation.SWEEP), """
lab AS (SELECT score, (t.source1_entity_id IS NOT NULL) AS y FROM scores LEFT JOIN truth t USING (source1_entity_id, candidate_entity_id)),
lost AS (SELECT count(*) AS blocked_out FROM truth t ANTI JOIN scores s USING (source1_entity_id, candidate_entity_id)),
cm AS (SELECT threshold, count(*) FILTER (score >= threshold AND y) AS tp, count(*) FILTER (score >= threshold AND NOT y) AS fp,
    count(*) FILTER (score < threshold AND y) AS fn FROM lab, grid GROUP BY 1),
pr AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp) END AS p,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fn) END AS r FROM cm, lost)""", then="""
SELECT threshold, tp, fp, fn, blocked_out, round(p, 6) AS precision, round(r, 6) AS recall,
    round(CASE WHEN p + r > 0 THEN 1.25 * p * r / (0.25 * p + r) ELSE 0.0 END, 6) AS f05,
    round(CASE WHEN tp + fn + blocked_out = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fn + blocked_out) END, 6) AS full_recall FROM pr"""))
def pair_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores, found = _word_scores(spark, sf_dir)
    return _rounded(evaluation.pair_measures(R.truth(spark, sf_dir), scores, "score", found=found))


@query(_with(O.blocks(5000, 2), O.macro("cand"), then="""
SELECT count(*) AS n_ids, sum(n_true)::BIGINT AS true_pairs, sum(n_hit)::BIGINT AS recovered_pairs,
    sum(n_pred)::BIGINT AS candidate_pairs, count(*) FILTER (n_true = 0) AS singletons,
    round(CASE WHEN sum(n_true) = 0 THEN 0.0 ELSE sum(n_hit)::DOUBLE / sum(n_true) END, 6) AS recall,
    round(sum(n_pred)::DOUBLE / count(*), 6) AS average_candidates FROM counted"""))
def blocking_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s23 = R.sides(spark, sf_dir)
    return _rounded(evaluation.blocking_recall(_ids(s1), R.truth(spark, sf_dir), blocking.blocks(s1, s23)))


@query(_with(f"found AS ({_BY_STRATEGY}), grid AS (SELECT unnest([{_STRATEGIES}]) AS kind)", O.macro("found", "kind"), then="""
SELECT kind AS strategy, sum(n_true)::BIGINT AS true_matches, sum(n_hit)::BIGINT AS recovered_matches,
    count(*) FILTER (n_true > 0) AS s1_with_true_matches, count(*) FILTER (n_true > 0 AND n_hit > 0) AS s1_with_at_least_one_recovered,
    count(*) FILTER (n_true > 0 AND n_hit = n_true) AS s1_with_all_recovered, sum(n_pred)::BIGINT AS total_candidates,
    max(n_pred) AS maximum_candidates_per_s1, round(coalesce(sum(n_hit)::DOUBLE / nullif(sum(n_true), 0), 0), 6) AS recall,
    round(coalesce(count(*) FILTER (n_true > 0 AND n_hit > 0)::DOUBLE / nullif(count(*) FILTER (n_true > 0), 0), 0), 6) AS s1_level_recall,
    round(coalesce(count(*) FILTER (n_true > 0 AND n_hit = n_true)::DOUBLE / nullif(count(*) FILTER (n_true > 0), 0), 0), 6) AS all_match_recall,
    round(sum(n_pred)::DOUBLE / count(*), 6) AS average_candidates_per_s1 FROM counted GROUP BY kind"""))
def strategy_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s23 = R.sides(spark, sf_dir)
    found = blocking.strategy_blocks(s1, s23)
    return _rounded(evaluation.strategy_recall(_ids(s1), R.truth(spark, sf_dir), found, blocking.NAME_STRATEGIES))


@query(_with("""hit AS (SELECT a.word <> '' AND a.word = b.word AS n, list_has_any(a.awords, b.awords) AS a
    FROM truth t JOIN words a ON t.source1_entity_id = a.entity_id JOIN words b ON t.candidate_entity_id = b.entity_id
    WHERE a.country = b.country)""", then="""
SELECT count(*) AS true_matches, count(*) FILTER (n) AS name_hits, count(*) FILTER (a) AS address_hits,
    count(*) FILTER (n OR a) AS either_hits, round(coalesce(count(*) FILTER (n)::DOUBLE / nullif(count(*), 0), 0), 6) AS name_rate,
    round(coalesce(count(*) FILTER (a)::DOUBLE / nullif(count(*), 0), 0), 6) AS address_rate,
    round(coalesce(count(*) FILTER (n OR a)::DOUBLE / nullif(count(*), 0), 0), 6) AS either_rate FROM hit"""))
def key_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluation.key_hits(*R.sides(spark, sf_dir), R.truth(spark, sf_dir)))


@query(_with(O.blocks(5000, 2), then=f"""SELECT (SELECT count(*) FROM ids) AS processed, (SELECT count(*) FROM cand) AS candidates,
    (SELECT count(*) FROM ({O.block_pairs('exact_address')})) AS matches"""))
def processing_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s23 = R.sides(spark, sf_dir)
    forms = blocking.normal_forms(s1, s23)
    return evaluation.totals(s1, blocking.blocks(s1, s23, forms=forms), blocking.blocks(s1, s23, kinds=["exact_address"], forms=forms))


# -- profiles --------------------------------------------------------------

_COLUMNS = ("entity_id", "business_name", "business_address", "country")


@query(_with(then=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) FILTER (trim(coalesce({c}, '')) = '') AS missing FROM rec" for c in _COLUMNS)))
def missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.missing_values(_all(spark, sf_dir))


_VALUES = "vals AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {O.profile_clean(c) if c != 'entity_id' else c} AS value FROM rec" for c in _COLUMNS) + ")"


@query(_with(_VALUES, then="""SELECT column_name, count(DISTINCT value) AS distinct_values,
    count(*) - count(DISTINCT value) AS repeated_values FROM vals WHERE value <> '' GROUP BY 1"""))
def repeated_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.repeats(_all(spark, sf_dir))


@query("SELECT coalesce(sum(n - 1), 0)::BIGINT AS duplicate_rows FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, n_chars)")
def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.duplicate_rows(R.documents(spark, sf_dir).select("text", "lang", "n_chars"))


@query("SELECT coalesce(sum(n - 1), 0)::BIGINT AS duplicate_rows FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, n_chars, doc_id // 100)")
def duplicate_rows_by_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats within chunks of a hundred ids only."""
    rows = R.documents(spark, sf_dir).withColumn("chunk", F.expr("doc_id div 100"))
    return profiling.duplicate_rows(rows.select("text", "lang", "n_chars", "chunk"))


@query(_with(_VALUES, then="SELECT value AS country, count(*) AS n FROM vals WHERE column_name = 'country' AND value <> '' GROUP BY 1"))
def country_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.country_counts(_all(spark, sf_dir))


@query(_with(_VALUES, then="""SELECT value, count(*) AS n FROM vals WHERE column_name = 'business_name' AND value <> ''
    GROUP BY 1 ORDER BY n DESC, value LIMIT 20"""))
def top_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.top_values(_all(spark, sf_dir), "business_name")


@query(_with(_VALUES, then="""SELECT value, count(*) AS n FROM vals WHERE column_name = 'business_address' AND value <> ''
    GROUP BY 1 ORDER BY n DESC, value LIMIT 20"""))
def top_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.top_values(_all(spark, sf_dir), "business_address")


_SIZES = """
tl AS (SELECT source1_entity_id, count(candidate_entity_id) AS total,
    count(*) FILTER (candidate_entity_id LIKE 'S2-%') AS s2, count(*) FILTER (candidate_entity_id LIKE 'S3-%') AS s3
    FROM ids LEFT JOIN truth USING (source1_entity_id) GROUP BY 1)"""


@query(_with(_SIZES, then=" UNION ALL ".join(
    f"SELECT '{k}' AS kind, {k}::INT AS matches, count(*) AS n FROM tl GROUP BY ALL" for k in ("total", "s2", "s3"))))
def match_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.match_histogram(R.truth_lists(spark, sf_dir))


@query(_with(_SIZES, then="""SELECT count(*) AS rows, count(*) FILTER (s2 > 0) AS with_s2, count(*) FILTER (s3 > 0) AS with_s3,
    count(*) FILTER (s2 > 0 AND s3 > 0) AS with_both, count(*) FILTER (s2 = 0 AND s3 = 0) AS with_neither FROM tl"""))
def match_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.match_presence(R.truth_lists(spark, sf_dir))


@query(_with(then="SELECT candidate_entity_id AS entity_id, count(*) AS n FROM truth GROUP BY 1"))
def matched_id_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.matched_id_counts(R.truth_lists(spark, sf_dir))


# -- learning --------------------------------------------------------------


@query(_with(then="""SELECT source1_entity_id, ('0x' || substr(md5(source1_entity_id), 1, 8))::BIGINT % 10 < 8 AS in_train FROM ids"""))
def split_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _ids(R.sides(spark, sf_dir)[0])
    return ids.withColumn("in_train", learning.in_train(F.col("source1_entity_id")))


@query(_with(then="SELECT DISTINCT split_part(candidate_entity_id, '-', 1) AS source, candidate_entity_id AS entity_id FROM truth"))
def ids_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learning.ids_by_source(R.truth(spark, sf_dir))


@query(_with(then="SELECT DISTINCT * FROM truth"))
def positive_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learning.positive_pairs(profiling.truth_pairs(R.truth_lists(spark, sf_dir)))


@query(_with(then=f"SELECT DISTINCT * FROM truth ORDER BY ALL LIMIT {_STUDY}"))
def first_positive_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The study's sample of true pairs."""
    return learning.positive_pairs(profiling.truth_pairs(R.truth_lists(spark, sf_dir)), _STUDY)


@query(_with(_SAMPLED, then="SELECT * FROM negative"))
def negative_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The study's sample: as many negatives as its cap on positives."""
    s1, s23 = R.sides(spark, sf_dir)
    return learning.negative_pairs(s1, s23, R.truth(spark, sf_dir), _STUDY)


@query()
def supervised_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on files of the records and their truth, decide all S1 records of
    the files to be tested, and read the matches back."""
    training, test, out = _training(spark, sf_dir), _test(spark, sf_dir), tables.shared_path(spark, "results")
    learning.link_files(spark, training, test, out)
    return tables.read_tsv(spark, f"{out}/matching_results.tsv", tables.TRUTH)


# -- files -----------------------------------------------------------------


def _written(spark: SparkSession, sf_dir: str, name: str) -> str:
    folder, rows = tables.shared_path(spark, name), R.records(spark, sf_dir)
    for k in (1, 2, 3):
        tables.write_tsv(rows.filter(F.col("source") == k).drop("source"), f"{folder}/{name}_source{k}.tsv")
    return folder


def _training(spark: SparkSession, sf_dir: str) -> str:
    folder = _written(spark, sf_dir, "train")
    tables.write_tsv(R.truth_lists(spark, sf_dir), f"{folder}/train_ground_truth.tsv")
    return folder


def _test(spark: SparkSession, sf_dir: str) -> str:
    return _written(spark, sf_dir, "test")


def _numbered(files) -> DataFrame:
    return blocking.unioned([f.withColumn("file", F.lit(k)) for k, f in enumerate(files, 1)])


_FIELDS = "entity_id, business_name, business_address, coalesce(country, '') AS country"


@query(_with(_SIZES, then=f"""SELECT {_FIELDS}, source::INT AS file FROM rec UNION ALL
    SELECT source1_entity_id, '', string_agg(candidate_entity_id, ',' ORDER BY candidate_entity_id), '', 4
    FROM ids LEFT JOIN (SELECT DISTINCT * FROM truth) USING (source1_entity_id) GROUP BY 1""".replace(
        "string_agg(candidate_entity_id, ',' ORDER BY candidate_entity_id)",
        "coalesce(string_agg(candidate_entity_id, ',' ORDER BY candidate_entity_id), '')")))
def training_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources and the truth, written to files and read back."""
    s1, s2, s3, truth = tables.read_training(spark, _training(spark, sf_dir))
    lists = truth.select(F.col("source1_entity_id").alias("entity_id"), F.lit("").alias("business_name"),
                         F.col("matched_entity_ids").alias("business_address"), F.lit("").alias("country"))
    return _numbered([s1, s2, s3, lists])


@query(_with(then=f"SELECT {_FIELDS}, source::INT AS file FROM rec"))
def test_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(tables.read_test(spark, _test(spark, sf_dir)))


_MISSING = ", ".join(f"'{t}'" for t in text.MISSING_TEXTS)


@query(_with(then="SELECT " + ", ".join(f"CASE WHEN {c} NOT IN ({_MISSING}) THEN {c} END AS {c}" for c in tables.RECORD) + " FROM rec"))
def files_with_missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts for missing values read as null."""
    return blocking.unioned(tables.read_test(spark, _test(spark, sf_dir), na_mode="pandas"))


@query(_with(then=f"SELECT {_FIELDS} FROM rec WHERE NOT contains(business_name, '!')"))
def files_with_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose name has an exclamation mark get a field too many; their
    lines are skipped."""
    folder, rows = tables.shared_path(spark, "lines"), _all(spark, sf_dir)
    loud = F.contains("business_name", F.lit("!"))
    tables.write_tsv(rows.filter(~loud), f"{folder}/good")
    tables.write_tsv(rows.filter(loud).withColumn("more", F.lit("x")), f"{folder}/bad")
    return tables.read_tsv(spark, [f"{folder}/good", f"{folder}/bad"], bad_lines="skip")


@query(_with(then="""SELECT source1_entity_id, unnest(string_split(string_agg(candidate_entity_id, ', ' ORDER BY candidate_entity_id), ',')) AS
    candidate_entity_id FROM (SELECT DISTINCT * FROM truth) GROUP BY 1"""))
def truth_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth from a file whose lists have blanks: only whole lists are trimmed."""
    path = f"{tables.shared_path(spark, 'truth')}/train_ground_truth.tsv"
    spaced = F.concat(F.lit(" "), F.replace("matched_entity_ids", F.lit(","), F.lit(", ")), F.lit(" "))
    tables.write_tsv(R.truth_lists(spark, sf_dir).withColumn("matched_entity_ids", spaced), path)
    return profiling.truth_pairs(tables.read_truth(spark, path), trim_each=False)


@query(_with(then=f"SELECT {_FIELDS} FROM rec WHERE source = 1 ORDER BY entity_id LIMIT 1000"))
def first_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample of the first thousand S1 records, by id."""
    s1, _, _ = tables.read_test(spark, _test(spark, sf_dir))
    return tables.first_rows(s1, 1000)


@query(_with(then="""SELECT entity_id, business_name FROM (SELECT coalesce(country, '') AS entity_id, business_name,
    row_number() OVER (PARTITION BY coalesce(country, '') ORDER BY entity_id) AS rank FROM rec) WHERE rank = 1"""))
def first_per_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the records of each country, taken as an id that repeats, the first."""
    rows = _all(spark, sf_dir).select(F.coalesce("country", F.lit("")).alias("entity_id"), "business_name", F.col("entity_id").alias("place"))
    return tables.first_per_id(rows, ["place"]).select("entity_id", "business_name")


@query(_with(O.blocks(5000, 2), then=_LISTS))
def candidate_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate lists, written and read back."""
    path = tables.shared_path(spark, "candidate_pairs")
    tables.write_lists(candidate_lists(spark, sf_dir), path)
    return tables.read_tsv(spark, path, ("source1_entity_id", "candidate_entity_ids"))


@query(_unambiguous("efo"))
def unambiguous_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches against a stored index of S2 and S3, written to two files and read back."""
    s1, s23 = R.sides(spark, sf_dir)
    folder = tables.shared_path(spark, "unambiguous")
    tables.save_exact_index(matching.exact_forms(tables.first_per_id(s23, ["entity_id"])), f"{folder}/index")
    found = matching.match_exact_unambiguous(s1, None, index=tables.read_exact_index(spark, f"{folder}/index"))
    both = []
    for c in ("candidate_entity_ids", "matched_entity_ids"):
        tables.write_lists(found.select("source1_entity_id", c), f"{folder}/{c}")
        both.append(tables.read_tsv(spark, f"{folder}/{c}", ("source1_entity_id", c)))
    return both[0].join(both[1], "source1_entity_id")


@query(_with(_EXACT, """exact_hits AS (SELECT * FROM by_name UNION ALL SELECT * FROM by_address
    WHERE source1_entity_id NOT IN (SELECT source1_entity_id FROM by_name))""", then="""
SELECT source1_entity_id, coalesce(string_agg(candidate_entity_id, ',' ORDER BY candidate_entity_id), '') AS matched_entity_ids
FROM ids LEFT JOIN exact_hits USING (source1_entity_id) GROUP BY 1"""))
def exact_match_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact matches in lines that end as spreadsheets end them, read back."""
    s1, s23 = R.sides(spark, sf_dir)
    path = tables.shared_path(spark, "exact")
    tables.write_lists(blocking.listed(s1, matching.match_exact(s1, s23), "matched_entity_ids"), path, "\r\n")
    return tables.read_tsv(spark, path, tables.TRUTH)


def _items(report: dict) -> dict[str, int]:
    one, truth = report["sources"]["records"], report["truth"]
    counts = {k: one[k] for k in ("rows", "duplicate_rows", "duplicate_entity_ids", "repeated_business_names", "repeated_addresses",
                                  "unique_business_names", "unique_addresses")}
    counts |= {f"missing {c}": n for c, n in one["missing_values"].items()}
    counts |= {f"country {c}": n for c, n in one["country_distribution"].items()}
    return counts | {f"truth {k}": truth[k] for k in ("rows", "with_both", "with_neither", "matched_ids", "matched_more_than_once")}


@query(_with(_VALUES, _SIZES, "mc AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM truth) GROUP BY candidate_entity_id)", then="""
SELECT 'rows' AS item, count(*) AS n FROM rec
UNION ALL SELECT 'duplicate_rows', 0 UNION ALL SELECT 'duplicate_entity_ids', count(*) - count(DISTINCT entity_id) FROM rec
""" + "".join(f"""UNION ALL SELECT 'repeated_{p}', count(*) - count(DISTINCT value) FROM vals WHERE column_name = '{c}' AND value <> ''
UNION ALL SELECT 'unique_{p}', count(DISTINCT value) FROM vals WHERE column_name = '{c}' AND value <> ''
""" for p, c in (("business_names", "business_name"), ("addresses", "business_address"))) + "".join(
    f"UNION ALL SELECT 'missing {c}', count(*) FILTER (trim(coalesce({c}, '')) = '') FROM rec\n" for c in _COLUMNS) + """
UNION ALL SELECT 'country ' || value, count(*) FROM vals WHERE column_name = 'country' AND value <> '' GROUP BY value
UNION ALL SELECT 'truth rows', count(*) FROM tl UNION ALL SELECT 'truth with_both', count(*) FILTER (s2 > 0 AND s3 > 0) FROM tl
UNION ALL SELECT 'truth with_neither', count(*) FILTER (s2 = 0 AND s3 = 0) FROM tl
UNION ALL SELECT 'truth matched_ids', count(*) FROM mc UNION ALL SELECT 'truth matched_more_than_once', count(*) FILTER (n > 1) FROM mc"""))
def profile_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile as a JSON file, read back."""
    path = f"{tables.shared_path(spark, 'profile')}/report.json"
    tables.write_report(profiling.report({"records": _all(spark, sf_dir)}, R.truth_lists(spark, sf_dir)), path, spark)
    whole = spark.read.text(path, wholetext=True).first()[0]
    return spark.createDataFrame(list(_items(json.loads(whole)).items()), "item string, n long")


_BROKEN = ("s1_ids_unique", "s23_ids_unique", "every_s1_has_candidates_row", "every_s1_has_matches_row", "one_candidates_row",
           "one_matches_row", "candidates_from_s2_s3", "matches_unique", "matches_are_candidates")


_UNIQUE = "SELECT count(*) FROM (SELECT 1 FROM {} GROUP BY {} HAVING count(*) > 1)"
_RULES = dict(zip(_BROKEN, (
    _UNIQUE.format("(SELECT * FROM rec WHERE source = 1)", "entity_id"),
    _UNIQUE.format("(SELECT * FROM rec WHERE source > 1)", "entity_id"),
    *["SELECT count(*) FROM ids ANTI JOIN decided USING (source1_entity_id)"] * 2,
    *[_UNIQUE.format("decided", "source1_entity_id")] * 2,
    "SELECT count(*) FROM cids WHERE NOT regexp_matches(id, '^S[23]-')",
    _UNIQUE.format("mids", "source1_entity_id, id"),
    "SELECT count(*) FROM mids ANTI JOIN cids USING (source1_entity_id, id)"), strict=True))


@query(_unambiguous("norm").replace("SELECT source1_entity_id, coalesce(string_agg(j", ", decided AS (SELECT source1_entity_id, coalesce(string_agg(j", 1)
       + """), cids AS (SELECT source1_entity_id, unnest(string_split(candidate_entity_ids, ',')) AS id FROM decided WHERE candidate_entity_ids <> ''),
mids AS (SELECT source1_entity_id, unnest(string_split(matched_entity_ids, ',')) AS id FROM decided WHERE matched_entity_ids <> '')
""" + " UNION ALL ".join(f"SELECT '{r}' AS rule, ({sql}) AS violations" for r, sql in _RULES.items()))
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s23 = R.sides(spark, sf_dir)
    lists = matching.match_exact_unambiguous(s1, s23, faithful=False)
    return validation.violations(
        s1, s23, lists.select("source1_entity_id", "candidate_entity_ids"), lists.select("source1_entity_id", "matched_entity_ids"))
