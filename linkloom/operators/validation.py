"""What every result must satisfy, as rows that break a rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ids(lists: DataFrame, column: str) -> DataFrame:
    ids = F.filter(F.split(F.coalesce(F.col(column), F.lit("")), ","), lambda i: i != "")
    return lists.select("source1_entity_id", F.explode(ids).alias("entity_id"))


def violations(s1: DataFrame, s23: DataFrame, candidates: DataFrame, matches: DataFrame) -> DataFrame:
    """``rule, violations``: repeated ids, lists that are missing or repeated,
    unknown candidates, repeated matches, matches that are no candidates."""
    cand, match = _ids(candidates, "candidate_entity_ids"), _ids(matches, "matched_entity_ids")
    own = s1.select(F.col("entity_id").alias("source1_entity_id"))
    repeated = lambda df, c: df.groupBy(*c).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.lit(1).alias("x"))
    broken = {
        "s1_ids_unique": repeated(s1, ["entity_id"]),
        "s23_ids_unique": repeated(s23, ["entity_id"]),
        "every_s1_has_candidates_row": own.join(candidates, "source1_entity_id", "left_anti").select(F.lit(1).alias("x")),
        "every_s1_has_matches_row": own.join(matches, "source1_entity_id", "left_anti").select(F.lit(1).alias("x")),
        "one_candidates_row": repeated(candidates, ["source1_entity_id"]),
        "one_matches_row": repeated(matches, ["source1_entity_id"]),
        "candidates_from_s2_s3": cand.filter(~F.col("entity_id").rlike("^S[23]-")).select(F.lit(1).alias("x")),
        "matches_unique": repeated(match, ["source1_entity_id", "entity_id"]),
        "matches_are_candidates": match.join(cand, ["source1_entity_id", "entity_id"], "left_anti").select(F.lit(1).alias("x")),
    }
    rules = list(broken)
    rows = broken[rules[0]].select(F.lit(rules[0]).alias("rule"))
    for name in rules[1:]:
        rows = rows.unionByName(broken[name].select(F.lit(name).alias("rule")))
    counts = rows.agg(*(F.count_if(F.col("rule") == r).alias(r) for r in rules))
    each = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("violations")) for r in rules)))
    return counts.select(each.alias("r")).select("r.*")
