"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words: its weight's share of the whole mix,
at most ``most`` times what it has; what is over goes to the other sources by
weight.  A document's expected number of copies is its source's ratio of target
to size.  The whole part are certain copies; the rest is an inclusion chance.
Documents are ranked by random odds over inclusion odds, and taken in that order
until the source's words are as near to the target as the order allows: a sample
of fixed size with unequal chances.  So a source misses its target by less than
half of one document.

Random numbers are functions of seed and doc_id.  Sums along the order are taken
over 1024 classes of ranks, then inside the one class the cut falls into, twice;
no task ever sorts a source.  What is joined back is one row per source.

Rows that share id, source and size share a rank too.  Where the cut falls among
such rows, they are counted per split of the table, and taken in the order of the
table until the target is reached.  The table is read twice and has to come in the
same order both times: stored tables do, others are written first by the caller.

* A null text has no words; null sources are one source, the last.  Documents
  without words are taken or not like others and add nothing.
* Rows that share id, source and size, null ids among them, are told apart by
  their place alone: as many of them are taken as the target needs.
* An empty table gives an empty result.
"""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm.common import WORD_RUN
from turnloom.session import cut_lineage

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # the mix has 3/2 of all words
MOST = 2
SEED = "mix-1"
CLASSES = 1024
SMALL_SOURCES = 20_000


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RUN)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """Adds weight and target to (source, source_size): water filling in closed form.

    With sources in ascending order of cap over weight, the level that the first
    k - 1 capped sources leave to the others is highest at the right k.
    """
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1, F.lit(len(weights)))
    weighed = sources.withColumn("weight", F.get(F.array(*map(F.lit, weights)), turn).cast("bigint"))
    weighed = weighed.withColumn("_cap", F.col("source_size") * most)
    by_cap = Window.orderBy(F.col("_cap") * lcm(*weights) / F.col("weight"), F.col("source").isNull(), "source")
    before, onward = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * share[0] / share[1]
    level = (total - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    filled = weighed.withColumn("_level", level)
    target = F.least(F.col("_cap").cast("double"), F.max("_level").over(everything) * F.col("weight"))
    return filled.withColumn("target", target).select("source", "source_size", "target")


def _by_source(rows: DataFrame, per_source: DataFrame, n_sources: int) -> DataFrame:
    """Joins one row per source; it is broadcast only when the sources were counted to be few."""
    right = per_source.withColumnRenamed("source", "_source")
    if n_sources <= SMALL_SOURCES:
        right = F.broadcast(right)
    return rows.join(right, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def _draws(seed: str, most: int) -> dict[str, Column]:
    """Certain copies and the place in the order of a row that has its source's figures."""
    hexed = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 13)
    u = (F.conv(hexed, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(2**52))
    expected = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(F.lit(0.0))
    chance = expected - F.floor(expected)
    odds = u * (F.lit(1.0) - chance) / ((F.lit(1.0) - u) * chance)
    return {
        "_certain": F.floor(expected).cast("bigint"),
        "_rank": F.when(chance > 0, odds / (F.lit(1.0) + odds)),
    }


def _place() -> Column:
    return F.struct(F.col("_rank").alias("r"), F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("d"), F.col("size").alias("s"))


def _cuts(rows: DataFrame, n_sources: int, classes: int) -> DataFrame:
    """Per source the last place that is taken; no row where none is."""
    rows = rows.where(F.col("_rank").isNotNull()).withColumn("_want", F.col("target") - F.col("_certain") * F.col("source_size"))
    rows = rows.withColumns({"_before": F.lit(0).cast("bigint"), "_low": F.lit(0.0)})
    width = 1.0
    for _ in range(2):
        width /= classes  # powers of two: places in classes are exact
        rows = rows.withColumn("_class", F.floor((F.col("_rank") - F.col("_low")) / F.lit(width)))
        sums = rows.groupBy("source", "_class").agg(F.sum("size").alias("_words"), F.first("_want").alias("_want"), F.first("_before").alias("_before"))
        earlier = Window.partitionBy("source").orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("_sofar", F.col("_before") + F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
        cut = sums.where(F.col("_sofar") < F.col("_want")).groupBy("source").agg(F.max(F.struct("_class", "_sofar")).alias("_cut"))
        rows = _by_source(rows, cut, n_sources).where(F.col("_class") == F.col("_cut._class"))
        rows = rows.withColumns({"_before": F.col("_cut._sofar"), "_low": F.col("_low") + F.col("_class") * F.lit(width)}).drop("_cut")
    # Rows of one place are one row here, so a window holds what differs inside one class.
    ties = rows.withColumn("_at", _place()).groupBy("source", "_at").agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in ("_want", "_before", "_low")])
    size = F.col("_at.s")
    order = Window.partitionBy("source").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    ties = ties.withColumn("_sofar", F.col("_before") + F.coalesce(F.sum(size * F.col("_n")).over(order), F.lit(0)))
    short = 2 * F.col("_want") - 2 * F.col("_sofar") - size
    number = F.when(size == 0, F.col("_n")).otherwise(F.least("_n", F.greatest(F.lit(1), F.ceil(short / (2 * size)))))
    taken = ties.where(2 * F.col("_sofar") + size < 2 * F.col("_want")).withColumn("_take", number)
    # A class before the cut is taken whole, so a source without a row here still needs its cut.
    whole = rows.groupBy("source").agg(F.min("_low").alias("_from"))
    last = taken.groupBy("source").agg(F.max(F.struct("_at", "_take", "_n")).alias("_last"))
    edge = _by_source(rows, last.where("_last._take < _last._n"), n_sources).where(_place() == F.col("_last._at"))
    return _beside(_beside(whole, last), _last_numbers(edge)).select("source", "_from", F.col("_last._at").alias("_last"), "_last_no")


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join of two tables with one row per source."""
    right = right.withColumnRenamed("source", "_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def _last_numbers(edge: DataFrame) -> DataFrame:
    """(source, _last_no): the number of the last row taken among equal ones.

    Counted per split of the table; only the split the cut falls into is ranked.
    """
    part = F.shiftright("_no", 33)  # the split's part of a row's number
    counts = edge.groupBy("source", part.alias("_part")).agg(F.count("*").alias("_c"), F.first("_last._take").alias("_take"))
    earlier = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_ahead", F.coalesce(F.sum("_c").over(earlier), F.lit(0)))
    at = counts.where((F.col("_ahead") < F.col("_take")) & (F.col("_take") <= F.col("_ahead") + F.col("_c")))
    at = at.select(F.col("source").alias("_source"), "_part", (F.col("_take") - F.col("_ahead")).alias("_nth"))
    inside = edge.join(at, F.col("source").eqNullSafe(F.col("_source")) & (part == F.col("_part")))
    place = F.row_number().over(Window.partitionBy("source").orderBy("_no"))
    return inside.withColumn("_place", place).where(F.col("_place") == F.col("_nth")).select("source", F.col("_no").alias("_last_no"))


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """Adds ``_mix``: size, source_size, target and the number of copies the mix takes."""
    number = F.monotonically_increasing_id().alias("_no")
    small = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), number)
    small, _ = cut_lineage(small, "mix-sizes")
    sums = small.groupBy("source").agg(F.sum("size").alias("source_size"))
    per_source, _ = cut_lineage(targets(sums, weights, share, most), "mix-targets")
    n_sources = per_source.count()
    drawn = _by_source(small, per_source, n_sources).withColumns(_draws(seed, most))
    cuts, _ = cut_lineage(_cuts(drawn, n_sources, CLASSES), "mix-cuts")
    figures = _beside(per_source, cuts)

    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "source", size_of(F.col("text")).alias("size"), number)
    full = _by_source(row, figures, n_sources).withColumns(_draws(seed, most))
    below = F.col("_rank") < F.col("_from")
    at_cut = (_place() == F.col("_last")) & (F.col("_last_no").isNull() | (F.col("_no") <= F.col("_last_no")))
    extra = F.coalesce(below | (_place() < F.col("_last")) | at_cut, below, F.lit(False)).cast("bigint")
    mix = F.struct("size", "source_size", "target", (F.col("_certain") + extra).alias("copies"))
    return full.select("_row.*", mix.alias("_mix"))


def mixed(docs: DataFrame, **rules) -> DataFrame:
    """The mix: every row as often as it is taken, with its own columns only."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    repeats = F.explode(F.array_repeat(F.lit(0), F.col("_mix.copies").cast("int")))
    return copies(docs, **rules).select(*names, repeats.alias("_copy")).select(*names)


def report(docs: DataFrame) -> DataFrame:
    """What the mix takes of every document."""
    named = copies(docs.select("doc_id", "source", "text"))
    return named.select("doc_id", "_mix.size", "_mix.source_size", "_mix.target", (F.col("_mix.copies") * F.col("_mix.size")).alias("taken"))


SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD_RUN}')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2 * source_size AS cap, [3, 1, 2][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight FROM s),
l AS (SELECT *, (((SELECT sum(source_size) FROM s)::DOUBLE * 3 / 2)
      - coalesce(sum(cap) OVER (ORDER BY cap * 6.0::DOUBLE / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / sum(weight) OVER (ORDER BY cap * 6.0::DOUBLE / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS lev FROM w),
t AS (SELECT source, source_size, least(cap::DOUBLE, max(lev) OVER () * weight) AS target FROM l),
e AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN least(2.0::DOUBLE, target / source_size) ELSE 0 END AS x,
      ((('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
o AS (SELECT *, floor(x) AS certain, x - floor(x) AS p FROM e),
q AS (SELECT *, CASE WHEN p > 0 THEN u * (1 - p) / ((1 - u) * p) END AS odds FROM o),
c AS (SELECT *, coalesce(sum(CASE WHEN p > 0 THEN size ELSE 0 END) OVER (PARTITION BY source
      ORDER BY odds / (1 + odds) NULLS LAST, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sofar FROM q)
SELECT doc_id, size, source_size, target,
    (size * (certain + CASE WHEN p > 0 AND 2 * sofar + size < 2 * (target - certain * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken FROM c
"""
