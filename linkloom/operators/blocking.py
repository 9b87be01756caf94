"""Candidate generation: keys, their frequencies, and one join over all of them.

Records have ``entity_id, business_name, business_address, country``.  Every key
is a row ``(kind, country, key)``, so four kinds of blocks are one shuffle join.
Frequent keys are dealt out as tiles, as the pairs of a key grow with the square
of its rows.  Where no id repeats, a record has one first name word, and pairs
that agree on it are distinct as they come; only the others need a distinct.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkloom.functions import text
from linkloom.sources.tables import stored

MAX_BUCKET, ADDRESS_KEYS = 5000, 2
KEY = ["kind", "country", "key"]
PAIR = ["source1_entity_id", "candidate_entity_id"]
#: Pairs that a key makes in one task; a key with more is dealt out as tiles.
TILE = 1 << 20


def normalised(records: DataFrame, na_mode: str = "text") -> DataFrame:
    """``entity_id, country`` key, ``name``, ``legal`` name and ``address``."""
    name = text.normalise(F.col("business_name"))
    return (
        records.select(
            "entity_id",
            text.country_key(F.col("country"), na_mode).alias("country"),
            name.alias("name"),
            text.normalise_address(F.col("business_address")).alias("address"),
        )
        .withColumn("legal", text.expand_legal_words(F.col("name")))
    )


def normal_forms(s1: DataFrame, s23: DataFrame, na_mode: str = "text") -> tuple[DataFrame, DataFrame]:
    """:func:`normalised` of both sides as stored tables: blocks, scores and
    features read them, and no record is normalised twice."""
    return stored(normalised(s1, na_mode), "forms"), stored(normalised(s23, na_mode), "forms")


def _single(kind: str, key: Column) -> Column:
    return F.array(F.struct(F.lit(kind).alias("kind"), key.alias("key"), F.lit(0).alias("pos")))


def _many(kind: str, keys: Column) -> Column:
    return F.transform(keys, lambda k, i: F.struct(F.lit(kind).alias("kind"), k.alias("key"), i.alias("pos")))


def _kinds() -> dict[str, Column]:
    return {
        "name_word": _single("name_word", text.first_word_of(F.col("legal"))),
        "exact_name": _single("exact_name", F.col("name")),
        "exact_address": _single("exact_address", F.col("address")),
        "legal_name": _single("legal_name", F.col("legal")),
        "name_word_legal": _single("name_word_legal", text.first_word_of(F.col("legal"))),
        "name_prefix": _single("name_prefix", text.prefix_of(F.col("name"))),
        "address_word": _many("address_word", text.address_words_of(F.col("address"))),
    }


BLOCKS = ("name_word", "address_word", "exact_name", "exact_address")
NAME_STRATEGIES = ("name_word", "name_word_legal", "name_prefix", "exact_name", "legal_name")


def keys(norm: DataFrame, kinds: Sequence[str] = BLOCKS, more: Sequence[str] = ()) -> DataFrame:
    """``entity_id, country, kind, key, pos`` (and columns ``more``) for every key
    that is not empty."""
    found = _kinds()
    return (
        norm.select("entity_id", "country", *more, F.explode(F.concat(*(found[k] for k in kinds))).alias("k"))
        .select("entity_id", "country", "k.kind", "k.key", "k.pos", *more)
        .filter("key <> ''")
    )


def frequencies(key_rows: DataFrame) -> DataFrame:
    """Records per key; address words are distinct within a record."""
    return key_rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("freq"))


def rare_words(own: DataFrame, freq: DataFrame, max_bucket: int, per_entity: int) -> DataFrame:
    """Of each record's address words the rarest ``per_entity`` (one at least)
    that occur on the other side, at most ``max_bucket`` times; ties keep the
    order of the address."""
    order = W.partitionBy("entity_id").orderBy("freq", "pos", "key")
    return (
        own.join(freq.filter(F.col("freq") <= max_bucket), KEY)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= max(per_entity, 1))
    )


class Blocks(NamedTuple):
    """Candidate pairs before they are listed: rows ``source1_entity_id``,
    ``candidate_entity_id`` with the keys of a kind of which a record has one,
    and all other pairs, distinct."""

    probes: DataFrame
    index: DataFrame
    rest: DataFrame
    once: bool = True  #: whether no id repeats

    def pairs(self) -> DataFrame:
        return met(self.probes, self.index).select(*PAIR).unionByName(self.rest)

    def hits(self, true: DataFrame) -> DataFrame:
        """The pairs of ``true``, which are distinct, that are among the pairs."""
        main = true.join(self.probes, PAIR[0]).join(self.index, [PAIR[1], *KEY]).select(*PAIR)
        return main.unionByName(true.join(self.rest, PAIR, "left_semi"))

    def counted(self, true: DataFrame) -> DataFrame:
        """Per S1 id (and kind) with candidates the number of them, and of those
        in ``true``, which are distinct pairs, without listing the pairs."""
        freq = self.index.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
        own = ["kind", "source1_entity_id"]
        met_ = self.probes.join(freq, KEY).select(*own, "n", F.lit(0).cast("long").alias("hit"))
        hits = true.join(self.probes, "source1_entity_id").join(self.index, ["candidate_entity_id", *KEY])
        rest = self.rest.join(true.withColumn("t", F.lit(1)), PAIR, "left")
        kind = F.col("kind") if "kind" in self.rest.columns else F.lit(None).cast("string").alias("kind")
        rows = met_.unionByName(hits.select(*own, F.lit(0).cast("long").alias("n"), F.lit(1).cast("long").alias("hit"))).unionByName(
            rest.select(kind, "source1_entity_id", F.lit(1).cast("long").alias("n"), F.when(F.col("t") == 1, 1).otherwise(0).cast("long").alias("hit")))
        by = own if "kind" in self.rest.columns else own[1:]
        return rows.groupBy(*by).agg(F.sum("n").alias("n_predicted"), F.sum("hit").alias("n_hit"))

    def count(self) -> DataFrame:
        """The number of pairs, ``n``, in one row."""
        sizes = (self.probes.groupBy(*KEY).agg(F.count(F.lit(1)).alias("a"))
                 .join(self.index.groupBy(*KEY).agg(F.count(F.lit(1)).alias("b")), KEY).select((F.col("a") * F.col("b")).alias("n")))
        rest = self.rest.agg(F.count(F.lit(1)).alias("n"))
        return sizes.unionByName(rest).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def dealt(probes: DataFrame, index: DataFrame, tile: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with the tiles ``__i, __j`` of a key in which a row is.

    The rows of a frequent key are dealt out, on either side by a hash of the id,
    and meet as tiles of about ``tile`` (``TILE``) pairs, so that no task has all pairs of a
    key and every row is copied no more than the root of their number.
    """
    n = lambda df, name: df.groupBy(*KEY).agg(F.count(F.lit(1)).alias(name))
    tiles = F.ceil(F.sqrt(F.col("__l").cast("double") * F.col("__r") / (tile or TILE))).cast("int")
    large = n(probes, "__l").join(n(index, "__r"), KEY).select(*KEY, tiles.alias("__n")).filter("__n > 1")

    def side(rows: DataFrame, id_col: str, own: str, other: str) -> DataFrame:
        # At most a row for every ``tile`` pairs.
        marked = rows.join(F.broadcast(large), KEY, "left").withColumn("__n", F.coalesce("__n", F.lit(1)))
        return (
            marked.withColumn(own, F.pmod(F.xxhash64(id_col), F.col("__n")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
            .drop("__n")
        )

    return side(probes, PAIR[0], "__i", "__j"), side(index, PAIR[1], "__j", "__i")


def _parts(df: DataFrame) -> int:
    """An explicit number keeps partitions apart that are small before a join and large after it."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def met(probes: DataFrame, index: DataFrame) -> DataFrame:
    """All rows of both sides that agree on a key, with the columns of both."""
    left, right = (df.repartition(_parts(df), *KEY, "__i", "__j") for df in dealt(probes, index))
    return left.join(right, [*KEY, "__i", "__j"]).drop("__i", "__j")


def gathered(probes: DataFrame, index: DataFrame, tile: int | None = None, tasks: int = 1) -> DataFrame:
    """Rows of both sides tile by tile, for tasks that pair them, ``tasks`` for every
    shuffle partition: ``id`` for either id, ``side`` 0 for the left, whose rows come
    first, and 1 for the right."""
    left, right = dealt(probes, index, tile)
    rows = left.withColumnRenamed(PAIR[0], "id").withColumn("side", F.lit(0)).unionByName(
        right.withColumnRenamed(PAIR[1], "id").withColumn("side", F.lit(1)))
    return rows.repartition(tasks * _parts(rows), *KEY, "__i", "__j").sortWithinPartitions(*KEY, "__i", "__j", "side")


def repeats(records: DataFrame) -> bool:
    """Whether an id occurs twice."""
    return not records.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def short_key(key: Column) -> Column:
    """Whole addresses are shuffled and compared as digests; no short key is as long."""
    return F.when(F.length(key) > 64, F.concat(F.lit("#"), F.sha2(key, 256))).otherwise(key)


def _sides(left: DataFrame, right: DataFrame, more: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    side = lambda rows, p, c: rows.select(
        F.col("entity_id").alias(c), "kind", "country", short_key(F.col("key")).alias("key"), *(F.col(m).alias(p + m) for m in more))
    return side(left, "l_", PAIR[0]), side(right, "r_", PAIR[1])


def _probes(left: DataFrame, right: DataFrame, kinds: Sequence[str], max_bucket: int, per_entity: int) -> DataFrame:
    is_word = F.col("kind") == "address_word"
    probes = left.filter(~is_word).drop("pos")
    if "address_word" in kinds:
        freq = frequencies(right.filter(is_word))
        probes = probes.unionByName(rare_words(left.filter(is_word), freq, max_bucket, per_entity).select(*probes.columns))
    return probes


def blocks(
    s1: DataFrame,
    s23: DataFrame,
    max_bucket: int = MAX_BUCKET,
    per_entity: int = ADDRESS_KEYS,
    kinds: Sequence[str] = BLOCKS,
    na_mode: str = "text",
    forms: tuple[DataFrame, DataFrame] | None = None,
) -> Blocks:
    """The candidates of :func:`candidates`, not yet listed."""
    forms = forms or normal_forms(s1, s23, na_mode)
    forms, kinds = [f.withColumn("word", text.first_word_of(F.col("legal"))) for f in forms], list(kinds)
    if len(kinds) > 1 and "name_word" not in kinds or any(map(repeats, forms)):
        left, right = (keys(f, kinds) for f in forms)
        rest = paired(_probes(left, right, kinds, max_bucket, per_entity), right)
        return Blocks(*(df.filter(F.lit(False)) for df in _sides(left, right)), rest, False)
    first = "name_word" if "name_word" in kinds else kinds[0]
    main = [keys(f, [first], ["word"]) for f in forms]
    if first == "address_word":
        main = [df.filter(F.lit(False)) for df in main]
    new = (F.col("l_word") == "") | (F.col("l_word") != F.col("r_word"))
    if len(kinds) == 1:
        new = F.lit(True)
    found = []
    if "address_word" in kinds:
        # No key has more than ``max_bucket`` rows on the right: nothing to deal out.
        left, right = (keys(f, ["address_word"], ["word"]) for f in forms)
        rare = _sides(_probes(left, right, kinds, max_bucket, per_entity), right, ["word"])
        rare = [df.repartition(_parts(df), *KEY) for df in rare]
        found.append(rare[0].join(rare[1], KEY).filter(new).select(*PAIR))
    whole = [k for k in kinds if k not in (first, "address_word")]
    if whole:
        # Equal names have the same first word: pairs of them are new only without one.
        left, right = (keys(f, whole, ["word"]).filter((F.col("kind") != "exact_name") | (F.col("word") == "")) for f in forms)
        found.append(met(*_sides(left, right, ["word"])).filter(new).select(*PAIR))
    none = keys(forms[0], [first]).filter(F.lit(False)).select(*(F.col("entity_id").alias(c) for c in PAIR))
    rest = unioned(found).distinct() if found else none
    return Blocks(*_sides(*main), rest)


def candidates(
    s1: DataFrame,
    s23: DataFrame,
    max_bucket: int = MAX_BUCKET,
    per_entity: int = ADDRESS_KEYS,
    kinds: Sequence[str] = BLOCKS,
    na_mode: str = "text",
    forms: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Distinct ``source1_entity_id, candidate_entity_id`` that share a block;
    ``forms`` from :func:`normal_forms` saves computing them."""
    return blocks(s1, s23, max_bucket, per_entity, kinds, na_mode, forms).pairs()


def candidate_ids(
    s1: DataFrame,
    s23: DataFrame,
    max_bucket: int = MAX_BUCKET,
    per_entity: int = ADDRESS_KEYS,
    kinds: Sequence[str] = BLOCKS,
    na_mode: str = "text",
) -> DataFrame:
    """The distinct ``candidate_entity_id`` of :func:`candidates`: records with a
    key that is probed, found without listing pairs."""
    left, right = (keys(f, kinds) for f in normal_forms(s1, s23, na_mode))
    probed = _probes(left, right, kinds, max_bucket, per_entity).select(*KEY).distinct()
    return right.join(probed, KEY, "left_semi").select(F.col("entity_id").alias("candidate_entity_id")).distinct()


def paired(probes: DataFrame, index: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """The pairs that agree on a key, each once (per value of ``more``)."""
    return met(*_sides(probes, index)).select(*more, *PAIR).distinct()


def all_word_candidates(s1: DataFrame, s23: DataFrame, na_mode: str = "text") -> DataFrame:
    """Blocks on the first name word and on every address word, without a cap."""
    kinds = ("name_word", "address_word")
    left, right = (keys(f, kinds) for f in normal_forms(s1, s23, na_mode))
    return paired(left, right)


def strategy_blocks(s1: DataFrame, s23: DataFrame, na_mode: str = "text") -> Blocks:
    """The pairs of :func:`by_strategy`, not yet listed."""
    rows = [stored(keys(normalised(r, na_mode), NAME_STRATEGIES).drop("pos"), "keys") for r in (s1, s23)]
    if repeats(s1) or repeats(s23):
        return Blocks(*(df.filter(F.lit(False)) for df in _sides(*rows)), paired(*rows, ["kind"]))
    return Blocks(*_sides(*rows), rows[0].filter(F.lit(False)).select(
        "kind", F.col("entity_id").alias(PAIR[0]), F.col("entity_id").alias(PAIR[1])))


def by_strategy(s1: DataFrame, s23: DataFrame, na_mode: str = "text") -> DataFrame:
    """Name blocks of each strategy: ``kind`` and the pair."""
    found = strategy_blocks(s1, s23, na_mode)
    return met(found.probes, found.index).select("kind", *PAIR).unionByName(found.rest)


def unioned(chunks: Sequence[DataFrame]) -> DataFrame:
    """Chunks of records as one frame."""
    return reduce(DataFrame.unionByName, chunks)


def listed(ids: DataFrame, pairs: DataFrame, name: str = "candidate_entity_ids") -> DataFrame:
    """One row per id of ``ids``, with its pairs as a sorted comma list."""
    lists = pairs.groupBy("source1_entity_id").agg(
        F.array_join(F.array_sort(F.collect_set("candidate_entity_id")), ",").alias(name)
    )
    own = ids.select(F.col("entity_id").alias("source1_entity_id"))
    return own.join(lists, "source1_entity_id", "left").select(
        "source1_entity_id", F.coalesce(name, F.lit("")).alias(name)
    )


def needed_records(records: DataFrame, ids: DataFrame, id_col: str = "candidate_entity_id") -> DataFrame:
    """The records whose id occurs in ``ids``."""
    return records.join(ids.select(F.col(id_col).alias("entity_id")), "entity_id", "left_semi")
