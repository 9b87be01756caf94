"""Measures of candidates and matches against the truth, as aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import text
from linkloom.operators import blocking, matching

PAIR = ["source1_entity_id", "candidate_entity_id"]
GRID = tuple(round(0.50 + 0.05 * k, 2) for k in range(10))
SWEEP = (0.80, 0.85, 0.90, 0.95)
DEFAULT_THRESHOLD = 0.80


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _f05(p: Column, r: Column) -> Column:
    return F.coalesce(F.try_divide(1.25 * p * r, 0.25 * p + r), F.lit(0.0))


def _counts(ids: DataFrame, truth: DataFrame, predicted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per listed id (and ``by``, columns of ``ids`` and ``predicted``): true,
    predicted and hit pairs."""
    marked = predicted.select(*by, *PAIR).distinct().withColumn("p", F.lit(1))
    true = truth.select(*PAIR).distinct().withColumn("t", F.lit(1))
    hits = marked.join(true, PAIR, "left").groupBy(*by, "source1_entity_id").agg(
        F.count(F.lit(1)).alias("n_predicted"), F.count("t").alias("n_hit"))
    return _with_true(ids, truth, hits, by)


def _with_true(ids: DataFrame, truth: DataFrame, hits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    n_true = truth.select(*PAIR).distinct().groupBy("source1_entity_id").agg(F.count(F.lit(1)).alias("n_true"))
    return (
        ids.join(n_true, "source1_entity_id", "left")
        .join(hits, [*by, "source1_entity_id"], "left")
        .fillna(0, ["n_true", "n_predicted", "n_hit"])
    )


def macro_f05(ids: DataFrame, truth: DataFrame, predicted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Means over the listed ids of precision, recall and F0.5; an id without
    true and predicted pairs counts 1, with only one of them 0."""
    t, p, hit = F.col("n_true"), F.col("n_predicted"), F.col("n_hit")
    both_empty = (t == 0) & (p == 0)
    precision = F.when(both_empty, 1.0).when((t == 0) | (p == 0), 0.0).otherwise(_share(hit, p))
    recall = F.when(both_empty, 1.0).when((t == 0) | (p == 0), 0.0).otherwise(_share(hit, t))
    rows = _counts(ids, truth, predicted, by).withColumn("precision", precision).withColumn("recall", recall)
    rows = rows.withColumn("f05", _f05(F.col("precision"), F.col("recall")))
    means = [F.coalesce(F.avg(c), F.lit(0.0)).alias(f"macro_{c}") for c in ("precision", "recall", "f05")]
    return rows.groupBy(*by).agg(*means) if by else rows.agg(*means)


def _each(values: Sequence[float]) -> Column:
    return F.explode(F.array(*(F.lit(float(v)) for v in values)) if values else F.array().cast("array<double>"))


def _upper(scored: DataFrame, score: str, thresholds: Sequence[float], once: bool) -> DataFrame:
    """Scored pairs with their number ``n``: one row for each pair that reaches a
    threshold and, without candidate, one per id for all others, which are counted
    where they are made and not shuffled.  ``once``: no pair repeats."""
    pairs = scored.select(*PAIR, F.col(score).alias("score")) if once else scored.groupBy(*PAIR).agg(F.max(score).alias("score"))
    up = F.coalesce(F.col("score") >= float(min(thresholds)), F.lit(False)) if thresholds else F.lit(False)
    one, other = PAIR
    return pairs.groupBy(one, up.alias("up"), F.when(up, F.col(other)).alias(other)).agg(
        F.max("score").alias("score"), F.count(F.lit(1)).alias("n"))


def _reached(thresholds: Sequence[float]) -> list[Column]:
    """``p0, p1, ..``: pairs that reach each threshold, ``h0, h1, ..``: true ones."""
    up = [F.col("score") >= float(v) for v in thresholds]
    return [*(F.coalesce(F.sum(F.when(u, F.col("n"))), F.lit(0)).alias(f"p{k}") for k, u in enumerate(up)),
            *(F.count_if(u & F.col("t").isNotNull()).alias(f"h{k}") for k, u in enumerate(up))]


def sweep(
    ids: DataFrame, truth: DataFrame, scored: DataFrame, score: str, thresholds: Sequence[float] = GRID, once: bool = False
) -> DataFrame:
    """Macro measures, pairs and matches per threshold: pairs that reach one are
    labelled once and counted per id for all thresholds in one aggregation.
    ``once``: no pair of ``scored`` repeats."""
    true = truth.select(*PAIR).distinct().withColumn("t", F.lit(1))
    n_true = true.groupBy("source1_entity_id").agg(F.count(F.lit(1)).alias("n_true"))
    per_id = _upper(scored, score, thresholds, once).join(true, PAIR, "left").groupBy("source1_entity_id").agg(
        F.sum("n").alias("n_pairs"), *_reached(thresholds))
    counts = [F.struct(F.lit(float(v)).alias("threshold"), F.col(f"p{k}").alias("p"), F.col(f"h{k}").alias("h")) for k, v in enumerate(thresholds)]
    each = F.explode(F.array(*counts) if counts else F.array().cast("array<struct<threshold:double,p:bigint,h:bigint>>"))
    listed = ids.select("source1_entity_id").withColumn("listed", F.lit(1))
    rows = (
        listed.join(n_true, "source1_entity_id", "left")
        .join(per_id, "source1_entity_id", "full")
        .fillna(0)
        .select("listed", "n_true", "n_pairs", each.alias("c"))
        .select("listed", "n_true", "n_pairs", "c.*")
    )
    t, p, hit, own = F.col("n_true"), F.col("p"), F.col("h"), F.col("listed") == 1
    none, one = (t == 0) & (p == 0), (t == 0) | (p == 0)
    precision = F.when(none, 1.0).when(one, 0.0).otherwise(_share(hit, p))
    recall = F.when(none, 1.0).when(one, 0.0).otherwise(_share(hit, t))
    mean = lambda c, n: F.coalesce(F.avg(F.when(own, c)), F.lit(0.0)).alias(n)
    return rows.groupBy("threshold").agg(
        mean(precision, "precision"), mean(recall, "recall"), mean(_f05(precision, recall), "macro_f05"),
        F.sum("n_pairs").alias("num_candidate_pairs"), F.sum("p").alias("num_predicted_matches"))


def best_threshold(swept: DataFrame) -> float:
    """The lowest threshold of the highest macro F0.5; the default without any."""
    row = swept.orderBy(F.desc("macro_f05"), "threshold").limit(1).first()
    return DEFAULT_THRESHOLD if row is None else float(row["threshold"])


def pair_measures(
    truth: DataFrame, scored: DataFrame, score: str, thresholds: Sequence[float] = SWEEP, found: blocking.Blocks | None = None
) -> DataFrame:
    """True and false positives and negatives per threshold.  False negatives
    count scored pairs only; ``blocked_out`` adds those that blocking lost.

    ``found`` are blocks without repeated ids whose pairs are those of
    ``scored``: what they have of the truth is counted without listing them."""
    if found is None or not found.once:
        marked = matching.labelled(scored.select(*PAIR, F.col(score).alias("score")), truth).select("score", "label")
        lost = truth.select(*PAIR).distinct().join(scored.select(*PAIR), PAIR, "left_anti").select(
            F.lit(None).cast("double").alias("score"), F.lit(1).alias("label"))
        rows = marked.unionByName(lost).select("*", _each(thresholds).alias("threshold"))
        up, true, seen = F.col("score") >= F.col("threshold"), F.col("label") == 1, F.col("score").isNotNull()
        sums = rows.groupBy("threshold").agg(
            F.count_if(up & true).alias("tp"), F.count_if(up & ~true).alias("fp"),
            F.count_if(~up & true).alias("fn"), F.count_if(~seen).alias("blocked_out"))
    else:
        sums = _block_sums(truth.select(*PAIR).distinct(), scored, score, thresholds, found)
    p, r = _share(F.col("tp"), F.col("tp") + F.col("fp")), _share(F.col("tp"), F.col("tp") + F.col("fn"))
    return sums.withColumn("precision", p).withColumn("recall", r).withColumn(
        "f05", _f05(F.col("precision"), F.col("recall"))).withColumn(
        "full_recall", _share(F.col("tp"), F.col("tp") + F.col("fn") + F.col("blocked_out")))


def _block_sums(true: DataFrame, scored: DataFrame, score: str, thresholds: Sequence[float], found: blocking.Blocks) -> DataFrame:
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    reached = _upper(scored, score, thresholds, True).join(true.withColumn("t", F.lit(1)), PAIR, "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"), *_reached(thresholds))
    row = reached.crossJoin(n(true, "n_true")).crossJoin(n(found.hits(true), "n_seen")).filter("n_pairs + n_true > 0")
    sums = [F.struct(
        F.lit(float(v)).alias("threshold"), F.col(f"h{k}").alias("tp"), (F.col(f"p{k}") - F.col(f"h{k}")).alias("fp"),
        (F.col("n_seen") - F.col(f"h{k}")).alias("fn"), (F.col("n_true") - F.col("n_seen")).alias("blocked_out"))
        for k, v in enumerate(thresholds)]
    none = F.array().cast("array<struct<threshold:double,tp:bigint,fp:bigint,fn:bigint,blocked_out:bigint>>")
    return row.select(F.explode(F.array(*sums) if sums else none).alias("c")).select("c.*")


def _predicted(ids: DataFrame, truth: DataFrame, pairs: DataFrame | blocking.Blocks, by: Sequence[str] = ()) -> DataFrame:
    """As :func:`_counts`; blocks are counted without listing their pairs."""
    if isinstance(pairs, blocking.Blocks):
        return _with_true(ids, truth, pairs.counted(truth.select(*PAIR).distinct()), by)
    return _counts(ids, truth, pairs, by)


def blocking_recall(ids: DataFrame, truth: DataFrame, pairs: DataFrame | blocking.Blocks) -> DataFrame:
    """One row: true pairs, those among the candidates, candidates per id."""
    return _predicted(ids, truth, pairs).agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.coalesce(F.sum("n_true"), F.lit(0)).alias("true_pairs"),
        F.coalesce(F.sum("n_hit"), F.lit(0)).alias("recovered_pairs"),
        F.coalesce(F.sum("n_predicted"), F.lit(0)).alias("candidate_pairs"),
        F.count_if(F.col("n_true") == 0).alias("singletons"),
    ).withColumn("recall", _share(F.col("recovered_pairs"), F.col("true_pairs"))).withColumn(
        "average_candidates", _share(F.col("candidate_pairs"), F.col("n_ids")))


def strategy_recall(ids: DataFrame, truth: DataFrame, pairs: DataFrame | blocking.Blocks, kinds: Sequence[str]) -> DataFrame:
    """Per strategy: pair recall, id recall, whole-id recall, candidate sizes."""
    each = F.explode(F.array(*(F.lit(k) for k in kinds)))
    has, some = F.col("n_true") > 0, F.col("n_hit") > 0
    out = _predicted(ids.withColumn("kind", each), truth, pairs, ["kind"]).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.sum("n_true").alias("true_matches"),
        F.sum("n_hit").alias("recovered_matches"),
        F.count_if(has).alias("s1_with_true_matches"),
        F.count_if(has & some).alias("s1_with_at_least_one_recovered"),
        F.count_if(has & (F.col("n_hit") == F.col("n_true"))).alias("s1_with_all_recovered"),
        F.sum("n_predicted").alias("total_candidates"),
        F.max("n_predicted").alias("maximum_candidates_per_s1"),
    )
    c = F.col
    return (
        out.withColumn("recall", _share(c("recovered_matches"), c("true_matches")))
        .withColumn("s1_level_recall", _share(c("s1_with_at_least_one_recovered"), c("s1_with_true_matches")))
        .withColumn("all_match_recall", _share(c("s1_with_all_recovered"), c("s1_with_true_matches")))
        .withColumn("average_candidates_per_s1", _share(c("total_candidates"), c("n_ids")))
        .drop("n_ids")
        .withColumnRenamed("kind", "strategy")
    )


def key_hits(s1: DataFrame, s23: DataFrame, truth: DataFrame) -> DataFrame:
    """Of the true pairs within a country: shared first name word, shared address
    word, either."""
    forms = lambda r: blocking.normalised(matching.first_records(r)).select(
        "entity_id", "country", text.first_word_of(F.col("legal")).alias("word"),
        text.address_words_of(F.col("address")).alias("words"))
    rows = matching.with_records(truth.select(*PAIR).distinct(), forms(s1), forms(s23)).filter("l_country = r_country")
    name = (F.col("l_word") != "") & (F.col("l_word") == F.col("r_word"))
    address = F.arrays_overlap("l_words", "r_words")
    out = rows.agg(
        F.count(F.lit(1)).alias("true_matches"), F.count_if(name).alias("name_hits"),
        F.count_if(address).alias("address_hits"), F.count_if(name | address).alias("either_hits"))
    for c in ("name", "address", "either"):
        out = out.withColumn(f"{c}_rate", _share(F.col(f"{c}_hits"), F.col("true_matches")))
    return out


def totals(s1: DataFrame, pairs: DataFrame | blocking.Blocks, matches: DataFrame | blocking.Blocks) -> DataFrame:
    """Processed records, candidate pairs and matches, in one row."""
    names = ("processed", "candidates", "matches")
    each = [df.count() if isinstance(df, blocking.Blocks) else df.agg(F.count(F.lit(1)).alias("n")) for df in (s1, pairs, matches)]
    rows = blocking.unioned([df.withColumn("of", F.lit(n)) for n, df in zip(names, each, strict=True)])
    return rows.agg(*(F.sum(F.when(F.col("of") == n, F.col("n"))).alias(n) for n in names))
