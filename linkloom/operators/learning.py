"""The supervised matcher: split, train, tune, predict."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkloom.functions.similarity import FEATURES
from linkloom.operators import blocking, evaluation, matching, profiling
from linkloom.sources.tables import read_test, read_training, stored, write_lists

SEED = 42
#: Positive and negative pairs of the feature study.
STUDY_PAIRS = 1000


def in_train(id_col: Column, tenths: int = 8) -> Column:
    """A split that any engine can repeat: by the first 32 bits of the id's MD5."""
    return F.conv(F.substring(F.md5(id_col.cast("binary")), 1, 8), 16, 10).cast("long") % 10 < tenths


def exact_split(ids: DataFrame, share: float = 0.8, seed: int = SEED) -> tuple[set, set]:
    """numpy's seeded shuffle of the sorted ids on the driver, for id lists that
    fit there."""
    found = np.array(sorted({r[0] for r in ids.distinct().collect()}), dtype=object)
    np.random.RandomState(seed).shuffle(found)
    cut = int(len(found) * share)
    return set(found[:cut]), set(found[cut:])


def classifier(kind: str = "boosted", rounds: int | None = None):
    """``boosted`` trees, ``forest``, or else logistic regression."""
    if kind == "boosted":
        return GBTClassifier(featuresCol="x", labelCol="label", maxIter=rounds or 150, stepSize=0.1, seed=SEED)
    if kind == "forest":
        return RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=rounds or 100, maxDepth=12, seed=SEED)
    return LogisticRegression(featuresCol="x", labelCol="label", maxIter=rounds or 1000)


@dataclass
class Matcher:
    """A fitted classifier and the probability from which a pair matches."""

    model: PipelineModel
    threshold: float = evaluation.DEFAULT_THRESHOLD

    def probabilities(self, features: DataFrame) -> DataFrame:
        scored = self.model.transform(features)
        return scored.withColumn("probability_1", vector_to_array("probability")[1]).drop("x", "rawPrediction", "probability", "prediction")

    def matches(self, features: DataFrame) -> DataFrame:
        return self.probabilities(features).filter(F.col("probability_1") >= self.threshold)


def train(features: DataFrame, kind: str = "boosted", rounds: int | None = None, columns: Sequence[str] = FEATURES) -> Matcher:
    stages = [VectorAssembler(inputCols=list(columns), outputCol="x"), classifier(kind, rounds)]
    return Matcher(Pipeline(stages=stages).fit(features))


def tune(matcher: Matcher, features: DataFrame, ids: DataFrame, truth: DataFrame, thresholds: Sequence[float] = evaluation.GRID) -> tuple[float, DataFrame]:
    """The best threshold on validation pairs, and the sweep."""
    swept = evaluation.sweep(ids, truth, matcher.probabilities(features), "probability_1", thresholds)
    return evaluation.best_threshold(swept), swept


def fit_matcher(
    s1: DataFrame, s23: DataFrame, truth: DataFrame, kind: str = "boosted", rounds: int | None = None, **blocks
) -> tuple[Matcher, DataFrame]:
    """Block, label, train on four fifths of the S1 ids, tune on the rest, then
    train on all with that threshold."""
    forms = blocking.normal_forms(matching.first_records(s1), matching.first_records(s23))
    pairs = matching.labelled(blocking.candidates(s1, s23, forms=forms, **blocks), truth)
    # A stored table keeps the tables of the normal forms out of every iteration's tasks.
    features = stored(matching.pair_features(pairs, s1, s23, forms=forms), "features")
    ids = s1.select(F.col("entity_id").alias("source1_entity_id")).distinct()
    own = in_train(F.col("source1_entity_id"))
    first = train(features.filter(own), kind, rounds)
    threshold, swept = tune(first, features.filter(~own), ids.filter(~own), truth)
    final = train(features, kind, rounds)
    final.threshold = threshold
    return final, swept


def predict(matcher: Matcher, s1: DataFrame, s23: DataFrame, **blocks) -> tuple[DataFrame, DataFrame]:
    """Candidate and match lists, one row per S1 record each."""
    forms = blocking.normal_forms(matching.first_records(s1), matching.first_records(s23))
    pairs = stored(blocking.candidates(s1, s23, forms=forms, **blocks), "pairs")
    matches = matcher.matches(matching.pair_features(pairs, s1, s23, forms=forms))
    return blocking.listed(s1, pairs), blocking.listed(s1, matches, "matched_entity_ids")


def positive_pairs(truth_pairs: DataFrame, cap: int | None = None) -> DataFrame:
    """True pairs, the first ``cap`` in order of ids (the study's sample size)."""
    ordered = truth_pairs.select(*evaluation.PAIR).distinct()
    return ordered.orderBy(*evaluation.PAIR).limit(cap) if cap else ordered


def ids_by_source(pairs: DataFrame) -> DataFrame:
    """``source, entity_id`` of every candidate id."""
    return pairs.select(
        F.substring_index("candidate_entity_id", "-", 1).alias("source"), F.col("candidate_entity_id").alias("entity_id")
    ).distinct()


def negative_pairs(s1: DataFrame, s23: DataFrame, truth_pairs: DataFrame, count: int, seed: int = SEED) -> DataFrame:
    """``count`` S1 ids in order of a seeded hash, each with a candidate that is
    not true: the next one of a hashed ring of the candidates.  Fewer only where
    fewer S1 ids have such a candidate."""
    salt = lambda c: F.md5(F.concat(F.lit(f"{seed}:"), F.col(c)).cast("binary"))
    true = truth_pairs.select(*evaluation.PAIR).distinct()
    own = s1.select(F.col("entity_id").alias("source1_entity_id")).distinct()
    others = s23.select(F.col("entity_id").alias("candidate_entity_id")).distinct()
    n_own, n_others = own.count(), others.count()
    drawn = min(count, n_own)
    while True:
        left = own.orderBy(salt("source1_entity_id"), "source1_entity_id").limit(drawn)
        most = true.join(left, "source1_entity_id", "left_semi").groupBy("source1_entity_id").count().agg(F.max("count")).first()[0]
        tries = min(max((most or 0) + 1, 3), max(n_others, 1))
        size = min(max(3 * count, tries), n_others)
        right = others.orderBy(salt("candidate_entity_id"), "candidate_entity_id").limit(size)
        # Both sides are bounded by the sample size asked for.
        a = left.withColumn("at", F.row_number().over(W.orderBy(salt("source1_entity_id"), "source1_entity_id")))
        b = right.withColumn("slot", F.row_number().over(W.orderBy(salt("candidate_entity_id"), "candidate_entity_id")))
        each = a.withColumn("try", F.explode(F.sequence(F.lit(0), F.lit(tries - 1)))).withColumn(
            "slot", (F.col("at") * 3 + F.col("try")) % max(size, 1) + 1)
        pairs = each.join(b, "slot").join(true, evaluation.PAIR, "left_anti")
        found = pairs.withColumn("rank", F.row_number().over(W.partitionBy("source1_entity_id").orderBy("try"))).filter(
            "rank = 1").select("at", *evaluation.PAIR).orderBy("at").limit(count).select(*evaluation.PAIR)
        if drawn >= n_own or found.count() >= count:
            return found
        drawn = min(2 * drawn, n_own)


def study_sample(s1: DataFrame, s23: DataFrame, truth_pairs: DataFrame, cap: int = STUDY_PAIRS) -> DataFrame:
    """The study's pairs with their label: the first true ones, and as many
    that are not true."""
    positive = positive_pairs(truth_pairs, cap).withColumn("label", F.lit(1))
    return positive.unionByName(negative_pairs(s1, s23, truth_pairs, cap).withColumn("label", F.lit(0)))


def link_files(spark: SparkSession, training: str, test: str, out: str, kind: str = "boosted", rounds: int | None = None, **blocks) -> Matcher:
    """The whole run on files: learn from the folder ``training``, decide the
    records of ``test``, and write ``candidate_pairs.tsv`` and
    ``matching_results.tsv`` to ``out``, a row per S1 record each."""
    s1, s2, s3, truth = read_training(spark, training)
    matcher, _ = fit_matcher(s1, blocking.unioned([s2, s3]), profiling.truth_pairs(truth), kind, rounds, **blocks)
    s1, s2, s3 = read_test(spark, test)
    candidates, matches = predict(matcher, s1, blocking.unioned([s2, s3]), **blocks)
    write_lists(candidates, f"{out}/candidate_pairs.tsv")
    write_lists(matches, f"{out}/matching_results.tsv")
    return matcher
