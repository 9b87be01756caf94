"""Decisions on candidate pairs: two exact matchers and a scored one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions import similarity as S
from linkloom.functions import text
from linkloom.operators import blocking, pairwise
from linkloom.sources.tables import stored

THRESHOLD = 0.85


# -- exact matchers --------------------------------------------------------


def exact_forms(records: DataFrame) -> DataFrame:
    """``entity_id, country, name, address`` by the exact matcher's rules."""
    whole = text.composed(
        records.select("entity_id", "business_name", "business_address", "country"),
        ["business_name", "business_address"],
    )
    return whole.select(
        "entity_id",
        text.country_key(F.col("country")).alias("country"),
        text.strip_trailing_forms(text.exact_rules(F.col("business_name"))).alias("name"),
        text.exact_rules(F.col("business_address")).alias("address"),
    )


def _hits(left: DataFrame, right: DataFrame, column: str, once: bool) -> DataFrame:
    """Pairs that agree on country and ``column``, where that is not empty, dealt
    out as blocks are; ``once``: no id repeats, so no pair does."""
    side = lambda rows, c: rows.filter(F.col(column) != "").select(
        F.col("entity_id").alias(c), F.lit(column).alias("kind"), "country", blocking.short_key(F.col(column)).alias("key"))
    pairs = blocking.met(side(left, "source1_entity_id"), side(right, "candidate_entity_id")).select(*blocking.PAIR)
    return pairs if once else pairs.distinct()


def _once(left: DataFrame, right: DataFrame) -> bool:
    return not (blocking.repeats(left) or blocking.repeats(right))


def match_exact(s1: DataFrame, s23: DataFrame) -> DataFrame:
    """Name hits; for records without any, address hits."""
    left, right = stored(exact_forms(s1), "exact"), stored(exact_forms(s23), "exact")
    once = _once(left, right)
    # Whether a record has name hits is known without listing them.
    matched = left.filter("name <> ''").join(right.select("country", "name").distinct(), ["country", "name"], "left_semi")
    unmatched = left.join(matched.select("entity_id"), "entity_id", "left_anti")
    return _hits(left, right, "name", once).unionByName(_hits(unmatched, right, "address", once))


def match_exact_unambiguous(
    s1: DataFrame, s23: DataFrame | None, faithful: bool = True, index: DataFrame | None = None
) -> DataFrame:
    """Per S1 record the candidates (name or address hits) and the match: the
    one hit by both, else the only name hit, else the only address hit, else none.

    ``faithful`` probes the exact matcher's forms of S2 and S3 with forms by the
    general rules, as the reference engine does; otherwise both sides are
    normalised by the general rules.  ``index`` is a stored table of the right
    side's forms (:func:`linkloom.sources.tables.read_exact_index`).
    """
    general = lambda r: blocking.normalised(r).select("entity_id", "country", "name", "address")
    left = stored(general(s1), "exact")
    right = index if index is not None else stored(exact_forms(s23) if faithful else general(s23), "exact")
    once = _once(left, right)
    by_name = _hits(left, right, "name", once).withColumn("by", F.lit("name"))
    by_address = _hits(left, right, "address", once).withColumn("by", F.lit("address"))
    hits = (
        by_name.unionByName(by_address)
        .groupBy("source1_entity_id", "candidate_entity_id")
        .agg(F.max((F.col("by") == "name").cast("int")).alias("n"), F.max((F.col("by") == "address").cast("int")).alias("a"))
    )
    only = lambda condition: F.when(F.sum(condition) == 1, F.max(F.when(condition == 1, F.col("candidate_entity_id"))))
    decided = hits.groupBy("source1_entity_id").agg(
        F.array_join(F.array_sort(F.collect_list("candidate_entity_id")), ",").alias("candidate_entity_ids"),
        F.coalesce(only(F.col("n") * F.col("a")), only(F.col("n")), only(F.col("a")), F.lit("")).alias("matched_entity_ids"),
    )
    ids = s1.select(F.col("entity_id").alias("source1_entity_id"))
    return ids.join(decided, "source1_entity_id", "left").select(
        "source1_entity_id",
        F.coalesce("candidate_entity_ids", F.lit("")).alias("candidate_entity_ids"),
        F.coalesce("matched_entity_ids", F.lit("")).alias("matched_entity_ids"),
    )


# -- pairs with their records ----------------------------------------------


def first_records(records: DataFrame) -> DataFrame:
    """One record per id: the smallest, so that repeated ids are decided the
    same way in every run.  Ids are counted first; where none repeats, as should
    be, the records are not touched."""
    repeated = records.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("entity_id")
    if repeated.isEmpty():
        return records
    rest = [c for c in records.columns if c != "entity_id"]
    several = records.join(repeated, "entity_id", "left_semi").groupBy("entity_id").agg(F.min(F.struct(*rest)).alias("r"))
    return records.join(repeated, "entity_id", "left_anti").unionByName(
        several.select("entity_id", *(F.col("r")[c].alias(c) for c in rest)))


def with_records(pairs: DataFrame, s1: DataFrame, s23: DataFrame, how: str = "inner") -> DataFrame:
    """Pairs with both records' columns as ``l_*`` and ``r_*``; ``inner`` skips
    unknown ids, ``left`` gives them empty fields."""
    side = lambda r, id_col, p: r.select(
        F.col("entity_id").alias(id_col), *(F.col(c).alias(p + c) for c in r.columns if c != "entity_id"))
    left, right = side(s1, "source1_entity_id", "l_"), side(s23, "candidate_entity_id", "r_")
    joined = pairs.join(left, "source1_entity_id", how).join(right, "candidate_entity_id", how)
    if how == "left":
        joined = joined.fillna("", [c for c in joined.columns if c[:2] in ("l_", "r_")])
    return joined


def _forms(s1: DataFrame, s23: DataFrame, forms: tuple[DataFrame, DataFrame] | None) -> tuple[DataFrame, DataFrame]:
    left, right = forms or (blocking.normalised(first_records(s1)), blocking.normalised(first_records(s23)))
    return tuple(f.select("entity_id", "name", "address", "country") for f in (left, right))


def scored(
    pairs: DataFrame, s1: DataFrame, s23: DataFrame, threshold: float | None = None,
    forms: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Pairs with name, address and final score; ``forms`` are normal forms with
    one record per id.

    The matching ratio is the only Python here.  With a threshold, a pair goes on
    only while it can reach it: a bound from shared words, lengths and letters
    first, then the name's ratio, and the address's ratio for what is left.
    """
    left, right = _forms(s1, s23, forms)
    rows = with_records(pairs, left.drop("country"), right.drop("country"))
    n, a = (F.col("l_name"), F.col("r_name")), (F.col("l_address"), F.col("r_address"))
    rows = rows.withColumn("name_words", S.word_jaccard(*n)).withColumn("address_words", S.word_jaccard(*a))
    address_most = F.greatest(S.ratio_bound(*a), "address_words")
    reaches = lambda name: S.weighted(name, address_most) >= (threshold or 0.0) - 1e-9
    if threshold is not None:
        rows = rows.filter(reaches(F.greatest(S.ratio_bound(*n), "name_words"))).filter(
            reaches(F.greatest(S.letter_bound(*n), "name_words")))
    rows = rows.withColumn("name_score", F.greatest(S.matching_ratio(*n), F.col("name_words")))
    if threshold is not None:
        rows = rows.filter(reaches(F.col("name_score")))
    return rows.withColumn("address_score", F.greatest(S.matching_ratio(*a), F.col("address_words"))).select(
        "source1_entity_id", "candidate_entity_id", "name_score", "address_score",
        S.weighted(F.col("name_score"), F.col("address_score")).alias("final_score"),
    )


def match_candidates(
    s1: DataFrame, s23: DataFrame, pairs: DataFrame, threshold: float = THRESHOLD,
    forms: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """The scored pairs that reach the threshold."""
    return scored(pairs, s1, s23, threshold, forms).filter(F.col("final_score") >= threshold)


def match_blocks(found: blocking.Blocks, forms: tuple[DataFrame, DataFrame], threshold: float = THRESHOLD) -> DataFrame:
    """:func:`match_candidates` of all pairs of the default blocks of ``forms``;
    pairs of first name words are scored where their records meet, and of the
    others only those that a bound leaves are listed with their records."""
    if not found.once:
        return match_candidates(*forms, found.pairs(), threshold, forms)
    made, rest = pairwise.matches(found, forms, threshold)
    return made.unionByName(match_candidates(*forms, stored(rest, "reaching"), threshold, forms))


def pair_features(
    pairs: DataFrame, s1: DataFrame, s23: DataFrame, with_ratio: bool = True,
    forms: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Pairs with the model's features as floats; unknown ids have empty records."""
    rows = with_records(pairs, *_forms(s1, s23, forms), "left")
    c = F.col
    found = S.pair_features(c("l_name"), c("r_name"), c("l_address"), c("r_address"), c("l_country"), c("r_country"), with_ratio)
    return rows.select(*pairs.columns, *(v.cast("float").alias(k) for k, v in found.items()))


def word_features(
    found: blocking.Blocks, forms: tuple[DataFrame, DataFrame], wanted: Sequence[str] = S.WORD_FEATURES
) -> DataFrame:
    """:func:`pair_features` without the matching ratios, for all pairs of the
    default blocks of ``forms``, which need not be listed with their records."""
    if found.once:
        return pairwise.word_features(found, forms, wanted)
    return pair_features(found.pairs(), *forms, False, forms).select(*blocking.PAIR, *wanted)


def scored_blocks(found: blocking.Blocks, forms: tuple[DataFrame, DataFrame]) -> DataFrame:
    """:func:`scored` of all pairs of the default blocks of ``forms``, which need
    not be listed with their records."""
    if found.once:
        known = tuple(f.filter("entity_id is not null") for f in forms)
        return pairwise.rated(found, known, pairwise.Scored, pairwise.SCORES)
    return scored(found.pairs(), *forms, forms=forms)


def block_features(found: blocking.Blocks, forms: tuple[DataFrame, DataFrame]) -> DataFrame:
    """:func:`pair_features` of all pairs of the default blocks of ``forms``, which
    need not be listed with their records."""
    if found.once:
        return pairwise.rated(found, forms, pairwise.Rated, S.FEATURES)
    return pair_features(found.pairs(), *forms, True, forms)


def name_ratios(found: blocking.Blocks, forms: tuple[DataFrame, DataFrame]) -> DataFrame:
    """``name_ratio`` of all pairs of the default blocks of ``forms``."""
    if found.once:
        return pairwise.name_ratios(found, forms)
    rows = with_records(found.pairs(), *(f.select("entity_id", "name") for f in forms))
    return rows.select(*blocking.PAIR, S.brief_ratio("l_name", "r_name").alias("name_ratio"))


def all_word_candidates(s1: DataFrame, s23: DataFrame, na_mode: str = "text") -> DataFrame:
    """As :func:`linkloom.operators.blocking.all_word_candidates`; where no id
    repeats, without listing a pair for every word it shares."""
    forms = blocking.normal_forms(s1, s23, na_mode)
    if any(map(blocking.repeats, forms)):
        return blocking.all_word_candidates(s1, s23, na_mode)
    return pairwise.sharing_words(forms)


STUDIED = ("business_name", "business_address", "country")


def study_features(pairs: DataFrame, s1: DataFrame, s23: DataFrame) -> DataFrame:
    """Pairs with the feature study's features."""
    norm = lambda r: first_records(r).select(
        "entity_id", *(text.study_normalise(F.col(x)).alias(x) for x in STUDIED))
    rows = with_records(pairs, norm(s1), norm(s23))
    sides = [F.col(p + x) for x in STUDIED for p in ("l_", "r_")]
    return rows.select(*pairs.columns, *(v.alias(k) for k, v in S.study_features(*sides).items()))


def study_blocks(found: blocking.Blocks, s1: DataFrame, s23: DataFrame, na_mode: str = "text") -> DataFrame:
    """:func:`study_features` of all pairs of the default blocks of ``s1`` and
    ``s23``, whose records meet in tiles and are not listed for every pair."""
    if not found.once:
        return study_features(found.pairs(), s1, s23)
    first = blocking.short_key(text.first_word_of(text.expand_legal_words(text.normalise(F.col("business_name")))))
    forms = [r.filter("entity_id is not null").select(
        "entity_id", F.lit("name_word").alias("kind"), text.country_key(F.col("country"), na_mode).alias("country"), first.alias("key"),
        *(text.study_normalise(F.col(x)).alias(c) for x, c in zip(STUDIED, ("name", "address", "own"), strict=True)),
    ) for r in (s1, s23)]
    return pairwise.study(found, (stored(forms[0], "studied"), stored(forms[1], "studied")))


#: True pairs that are sent to all tasks, at most, in place of shuffling wide rows.
SENT = 100_000


def labelled(pairs: DataFrame, truth: DataFrame, wide: bool = False) -> DataFrame:
    """Pairs with ``label`` 1 where they are true; ``wide`` ones are not shuffled
    if the true pairs are few (``SENT``)."""
    marked = truth.select("source1_entity_id", "candidate_entity_id").distinct().withColumn("true", F.lit(1))
    if wide:
        marked = stored(marked, "true")
        marked = F.broadcast(marked) if marked.count() <= SENT else marked
    return pairs.join(marked, ["source1_entity_id", "candidate_entity_id"], "left").withColumn(
        "label", F.coalesce("true", F.lit(0)).cast("int")).drop("true")
