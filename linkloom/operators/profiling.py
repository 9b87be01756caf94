"""Profiles of record sources and of the truth, as aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import text

COLUMNS = ("entity_id", "business_name", "business_address", "country")


def missing_values(records: DataFrame, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """``column_name, rows, missing``: null or blank values per column."""
    counted = records.agg(
        F.count(F.lit(1)).alias("rows"), *(F.count_if(text.is_missing(F.col(c))).alias(c) for c in columns))
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing")) for c in columns)))
    return counted.select("rows", pairs.alias("p")).select("p.column_name", "rows", "p.missing")


def _cleaned(records: DataFrame) -> DataFrame:
    """One row per value that is not blank: which column, and the value."""
    forms = {
        "entity_id": text.trim_space(text.text_of(F.col("entity_id"))),
        "business_name": text.profile_clean(F.col("business_name")),
        "business_address": text.profile_clean(F.col("business_address")),
        "country": text.profile_clean(F.col("country")),
    }
    values = F.explode(F.array(*(F.struct(F.lit(k).alias("column_name"), v.alias("value")) for k, v in forms.items())))
    return records.select(values.alias("v")).select("v.*").filter("value <> ''")


def value_counts(records: DataFrame) -> DataFrame:
    return _cleaned(records).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def repeats(records: DataFrame) -> DataFrame:
    """Per column: distinct values, and rows beyond the first of each value."""
    return value_counts(records).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("distinct_values"), (F.sum("n") - F.count(F.lit(1))).alias("repeated_values"))


#: Rows of a chunk in which the profile counts repeated rows.
CHUNK = 100_000


def duplicate_rows(records: DataFrame, chunk: Column | None = None) -> DataFrame:
    """Rows equal to an earlier one; ``chunk`` counts within chunks only."""
    by = [F.col(c) for c in records.columns]
    if chunk is not None:
        by.append(chunk.alias("__chunk"))
    return records.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def chunk_of_rows(rows: int = CHUNK) -> Column:
    """A chunk of ``rows`` rows of a partition, in the order they are read: what
    reading a file in chunks is to a scan in parts."""
    number = F.monotonically_increasing_id()
    return F.struct(F.shiftright(number, 33), F.floor(number.bitwiseAND(F.lit((1 << 33) - 1)) / rows))


def country_counts(records: DataFrame) -> DataFrame:
    return _counts_of(records, "country").withColumnRenamed("value", "country").orderBy(F.desc("n"), "country")


def _counts_of(records: DataFrame, column: str) -> DataFrame:
    return value_counts(records).filter(F.col("column_name") == column).select("value", "n")


def top_values(records: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The ``k`` commonest values; equal counts in order of value."""
    return _counts_of(records, column).orderBy(F.desc("n"), "value").limit(k)


# -- truth -----------------------------------------------------------------


def truth_ids(truth: DataFrame, trim_each: bool = True) -> DataFrame:
    """``source1_entity_id`` and its ids as an array, from comma lists; ids are
    trimmed each, or only the list is."""
    whole = F.split(text.trim_space(text.text_of(F.col("matched_entity_ids"))), ",")
    ids = F.filter(F.transform(whole, text.trim_space) if trim_each else whole, lambda i: i != "")
    return truth.select("source1_entity_id", ids.alias("ids"))


def truth_pairs(truth: DataFrame, trim_each: bool = True) -> DataFrame:
    return truth_ids(truth, trim_each).select("source1_entity_id", F.explode("ids").alias("candidate_entity_id")).distinct()


def _sizes(truth: DataFrame) -> DataFrame:
    of = lambda p: F.size(F.filter("ids", lambda i: i.startswith(p)))
    return truth_ids(truth).select(F.size("ids").alias("total"), of("S2-").alias("s2"), of("S3-").alias("s3"))


def match_histogram(truth: DataFrame) -> DataFrame:
    """``kind`` (total, s2, s3), number of matches, rows; ordered."""
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("matches")) for k in ("total", "s2", "s3"))))
    return _sizes(truth).select(kinds.alias("k")).groupBy("k.kind", "k.matches").agg(
        F.count(F.lit(1)).alias("n")).orderBy("kind", "matches")


def match_presence(truth: DataFrame) -> DataFrame:
    """Rows with a match in S2, in S3, in both, in neither."""
    a, b = F.col("s2") > 0, F.col("s3") > 0
    return _sizes(truth).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(a).alias("with_s2"), F.count_if(b).alias("with_s3"),
        F.count_if(a & b).alias("with_both"), F.count_if(~a & ~b).alias("with_neither"))


def matched_id_counts(truth: DataFrame) -> DataFrame:
    return truth_ids(truth).select(F.explode("ids").alias("entity_id")).groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))


# -- features --------------------------------------------------------------


def label_means(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, negative, positive``: means per label, to three places."""
    mean = lambda c, y: F.round(F.avg(F.when(F.col("label") == y, F.col(c))), 3)
    one = features.agg(*(F.struct(mean(c, 0).alias("negative"), mean(c, 1).alias("positive")).alias(c) for c in columns))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).alias("m")) for c in columns)))
    return one.select(rows.alias("r")).select("r.feature", "r.m.negative", "r.m.positive")


def correlations(features: DataFrame, columns: Sequence[str], places: int = 2) -> DataFrame:
    """``a, b, corr`` for every pair of features; null for a constant one."""
    pairs = [(a, b) for a in columns for b in columns]

    def corr(a: str, b: str) -> Column:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        return F.round(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)), places)

    one = features.agg(*(corr(a, b).alias(f"c{k}") for k, (a, b) in enumerate(pairs)))
    rows = F.explode(F.array(*(
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{k}").alias("corr")) for k, (a, b) in enumerate(pairs))))
    return one.select(rows.alias("r")).select("r.*")


def report(sources: dict[str, DataFrame], truth: DataFrame, top: int = 20) -> dict:
    """The whole profile as a nested dict: bounded lists and counts only, but
    for the distributions of countries and of numbers of matches."""
    as_dict = lambda df, k, v: {r[k]: r[v] for r in df.collect()}
    out: dict = {"sources": {}}
    for name, records in sources.items():
        stats = {r["column_name"]: r for r in repeats(records).collect()}
        get = lambda c, f: int(stats[c][f]) if c in stats else 0  # noqa: B023, E731
        missing = missing_values(records)
        out["sources"][name] = {
            "rows": records.count(),
            "columns": records.columns,
            "missing_values": as_dict(missing, "column_name", "missing"),
            "duplicate_rows": duplicate_rows(records).first()[0],
            "duplicate_entity_ids": get("entity_id", "repeated_values"),
            "repeated_business_names": get("business_name", "repeated_values"),
            "repeated_addresses": get("business_address", "repeated_values"),
            "unique_entity_ids": get("entity_id", "distinct_values"),
            "unique_business_names": get("business_name", "distinct_values"),
            "unique_addresses": get("business_address", "distinct_values"),
            "country_distribution": as_dict(country_counts(records), "country", "n"),
            "top_business_names": [[r["value"], r["n"]] for r in top_values(records, "business_name", top).collect()],
            "top_addresses": [[r["value"], r["n"]] for r in top_values(records, "business_address", top).collect()],
        }
    histogram: dict = {}
    for r in match_histogram(truth).collect():
        histogram.setdefault(r["kind"], {})[r["matches"]] = r["n"]
    counts = matched_id_counts(truth).agg(
        F.count(F.lit(1)).alias("ids"), F.count_if(F.col("n") > 1).alias("repeated")).first()
    out["truth"] = match_presence(truth).first().asDict() | {
        "match_counts": histogram, "matched_ids": counts["ids"], "matched_more_than_once": counts["repeated"]}
    return out
