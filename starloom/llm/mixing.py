"""Mixing sources to target weights by Pareto order sampling (DataFrame only).

Targets.  The sources, by code point with null last, weigh 5, 2, 1 in turn and
share ``share`` times the words of all documents; a target stops at
``most_copies`` times its source's words and the excess is shared again by
weight.  That fixed point is target = min(cap, weight * level) with one level
for all, found in one pass over the sources sorted by cap / weight.  There may be
any number of sources: they are ranked and summed by range, and only one row a
range meets in one task.

Sampling.  A document's expected copies grow with its number of words: they are
min(most_copies, level * weight), the weight being the number of binary digits of
its size, and the level that at which a source's documents make up its target.
It is found over the classes of size of a source, at most 64.  The whole part is
allocated as certain copies; what is left is an inclusion probability p in [0, 1),
which differs by document.  Documents are ranked by random odds over inclusion
odds, Q = (u / (1 - u)) / (p / (1 - p)), with u from a digest of seed, id and text,
so reruns agree.  The sample's size is fixed in words: the smallest Q are taken
until the source's remaining words are met, to the nearest document.

Scale.  A source may hold most rows, so no window runs over a source's rows:
Q is dealt into ``BINS`` bins by Q / (1 + Q), words are summed by (source, bin),
and the bin of each source in which the target is met is found among groups of
bins, then among the bins of one group: a window sees sqrt(BINS) sums of a source.
Only rows of that bin are ordered exactly.  The table of sources is read back from
Parquet, so Spark broadcasts it by its file size or shuffles.

Defined cases: null text has size 0; a null source is a source of its own; size
0 takes 0; a null id is ordered last; rows repeated as a whole tie and any of
them may be taken; extra columns are not read.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import row_number_global
from .common import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
SEED = "mix-1"
BINS = 1 << 16

_SOURCE = ["no_source", "source"]
#: Binary digits of a document's words: its weight among its source's documents.
_DIGITS = "digits"


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Narrow rows, written once: id, source, words and the random number u."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                               F.md5(F.coalesce(F.col("text"), F.lit("")))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
    return materialize(docs.select(
        "doc_id", F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
        u.alias("u")).withColumn(_DIGITS, F.length(F.bin("size")).cast("long")), "mix-sizes")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            most_copies: int = MOST_COPIES) -> DataFrame:
    """One row per source: its words (source_size) and target."""
    by_source = sizes.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size"))
    ranked = row_number_global(by_source, _SOURCE, "rank")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    caps = ranked.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * most_copies)
    caps = caps.withColumn("ratio", F.col("cap") / F.col("weight"))
    ranges = materialize(caps.repartitionByRange("ratio", *_SOURCE).withColumn("part", F.spark_partition_id()), "mix-ranges")
    sums = ranges.groupBy("part").agg(F.sum("cap").alias("cap"), F.sum("weight").alias("weight"), F.sum("source_size").alias("size"))
    # one row a range
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(sums.select("part", "size", F.col("weight").alias("part_weight"),
                                     F.coalesce(F.sum("cap").over(ahead), F.lit(0)).alias("cap_ahead"),
                                     F.coalesce(F.sum("weight").over(ahead), F.lit(0)).alias("weight_ahead")), "mix-starts")
    total = starts.agg(F.sum("size").alias("size"), F.sum("part_weight").alias("weight")).first()
    before = Window.partitionBy("part").orderBy("ratio", *_SOURCE).rowsBetween(Window.unboundedPreceding, -1)
    caps = ranges.join(starts.drop("size", "part_weight"), "part")
    left = F.lit(share * (total["size"] or 0)) - (F.col("cap_ahead") + F.coalesce(F.sum("cap").over(before), F.lit(0)))
    level = left / (F.lit(total["weight"] or 0) - (F.col("weight_ahead") + F.coalesce(F.sum("weight").over(before), F.lit(0))))
    # the first source that the level of those not yet capped doesn't cap; levels rise until it, so it is the least
    least = caps.withColumn("level", level).filter("level <= ratio").agg(F.min(F.struct("ratio", *_SOURCE, "level"))).first()[0]
    found = F.lit(None if least is None else least["level"]).cast("double")
    return ranges.select(*_SOURCE, "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * found).alias("target"))


def copies_by_size(sizes: DataFrame, targets: DataFrame, most_copies: int = MOST_COPIES) -> DataFrame:
    """One row per source and class of size: source_size, target, the certain copies
    of a document (whole), the inclusion probability of one more (p), and the words
    that the source's extra copies should bring (rest)."""
    classes = sizes.groupBy(*_SOURCE, _DIGITS).agg(F.sum("size").alias("words"))
    classes = classes.withColumn("cap", F.col("words") * most_copies).withColumn("weight", F.col("words") * F.col(_DIGITS))
    classes = classes.join(targets, _SOURCE)
    # the longest documents reach the most copies first; at most 64 rows a source
    source = Window.partitionBy(*_SOURCE)
    before = source.orderBy(F.desc(_DIGITS)).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("target") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = left / (F.sum("weight").over(source) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    ratio = F.lit(float(most_copies)) / F.col(_DIGITS)
    classes = classes.withColumn("level", F.when(F.col("words") > 0, level)).withColumn("ratio", ratio)
    # the first class that the level of those not yet capped doesn't cap; if rounding leaves none, all are
    found = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(source)["level"]
    copies = F.least(F.lit(float(most_copies)), F.coalesce(found, F.lit(float(most_copies))) * F.col(_DIGITS))
    classes = classes.withColumn("copies", copies).withColumn("whole", F.floor("copies")).withColumn("p", F.col("copies") - F.col("whole"))
    rest = F.col("target") - F.sum(F.col("whole") * F.col("words")).over(source)
    return classes.select(*_SOURCE, _DIGITS, "source_size", "target", "whole", "p", rest.alias("rest"))


def _met(sums: DataFrame, part: str) -> DataFrame:
    """The part of each source in which its words, with those ``ahead`` of all, pass
    ``rest``: source, part, and the words before it (start).  Few parts a source."""
    upto = F.sum("words").over(Window.partitionBy(*_SOURCE).orderBy(part).rowsBetween(Window.unboundedPreceding, 0))
    return (sums.withColumn("end", F.col("ahead") + upto).filter(F.col("end") > F.col("rest"))
            .groupBy(*_SOURCE).agg(F.min(F.struct(part, (F.col("end") - F.col("words")).alias("start"))).alias("first"))
            .select(*_SOURCE, f"first.{part}", "first.start"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most_copies: int = MOST_COPIES,
        seed: str = SEED, bins: int = BINS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    sizes = sized(docs, seed)
    aims = materialize(targets(sizes, weights, share, most_copies), "mix-targets")
    plan = materialize(copies_by_size(sizes, aims, most_copies), "mix-copies")
    odds = (F.col("u") / (F.lit(1.0) - F.col("u"))) / (F.col("p") / (F.lit(1.0) - F.col("p")))
    of_bin = F.when(F.col("q").isNotNull(), F.least(
        F.floor(F.col("q") / (F.lit(1.0) + F.col("q")) * bins), F.lit(bins - 1)).cast("int"))

    def ranked(classes: DataFrame) -> DataFrame:
        return (sizes.join(classes, [*_SOURCE, _DIGITS]).withColumn("q", F.when(F.col("p") > 0, odds))
                .withColumn("bin", of_bin))

    sums = materialize(ranked(plan).filter("q is not null").groupBy(*_SOURCE, "bin").agg(
        F.sum("size").alias("words"), F.first("rest").alias("rest")), "mix-bins")
    # the bin in which a source's remaining words are met: among groups of bins, then among the bins of that group
    step = max(1, isqrt(bins))
    group = F.floor(F.col("bin") / step).cast("int")
    groups = sums.groupBy(*_SOURCE, group.alias("group")).agg(F.sum("words").alias("words"), F.first("rest").alias("rest"))
    groups = _met(groups.withColumn("ahead", F.lit(0).cast("long")), "group")
    inside = sums.join(materialize(groups.withColumnRenamed("start", "ahead"), "mix-groups"), _SOURCE).filter(group == F.col("group"))
    cut = _met(inside, "bin").select(*_SOURCE, F.col("bin").alias("cut_bin"), F.col("start").alias("cut_start"))
    plan = materialize(plan.join(cut, _SOURCE, "left"), "mix-plan")

    rows = ranked(plan)
    at_cut = F.coalesce(F.col("bin") == F.col("cut_bin"), F.lit(False))
    sure = rows.filter(~at_cut).withColumn("extra", F.coalesce(
        (F.col("bin") < F.coalesce("cut_bin", F.lit(bins))), F.lit(False)).cast("int"))
    upto = Window.partitionBy(*_SOURCE).orderBy("q", F.col("doc_id").isNull(), "doc_id").rowsBetween(
        Window.unboundedPreceding, 0)
    close = rows.filter(at_cut).withColumn("extra", (
        F.col("cut_start") + F.sum("size").over(upto) - F.col("size") / F.lit(2.0) <= F.col("rest")).cast("int"))
    copies = F.col("whole") + F.col("extra")
    return sure.unionByName(close).select(
        "doc_id", F.when(~F.col("no_source"), F.col("source")).alias("source"), "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"))


#: The same mix as DuckDB SQL over ``documents`` (for the default parameters).
SQL = f"""
WITH d AS (
  SELECT doc_id, source IS NULL AS no_source, coalesce(source, '') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 13))::BIGINT + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u
  FROM documents),
s AS (SELECT no_source, source, sum(size)::BIGINT AS source_size FROM d GROUP BY ALL),
w AS (SELECT *, 2 * source_size AS cap, [5, 2, 1][((row_number() OVER (ORDER BY no_source, source) - 1) % 3 + 1)::INT] AS weight FROM s),
r AS (SELECT *, cap::DOUBLE / weight AS ratio FROM w),
l AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size)::BIGINT FROM s) - coalesce(sum(cap) OVER before, 0)::BIGINT)
               / ((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
      FROM r WINDOW before AS (ORDER BY ratio, no_source, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, least(cap::DOUBLE, weight * (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, no_source, source LIMIT 1)) AS target FROM l),
g AS (SELECT no_source, source, length(bin(size))::BIGINT AS digits, sum(size)::BIGINT AS words FROM d GROUP BY ALL),
h AS (SELECT g.*, t.source_size, t.target, 2::DOUBLE / digits AS ratio,
             CASE WHEN words > 0 THEN (t.target - coalesce(sum(2 * words) OVER ahead, 0)::BIGINT)
                    / (sum(words * digits) OVER own - coalesce(sum(words * digits) OVER ahead, 0))::DOUBLE END AS level
      FROM g JOIN t ON g.source = t.source AND g.no_source = t.no_source
      WINDOW own AS (PARTITION BY g.no_source, g.source),
             ahead AS (PARTITION BY g.no_source, g.source ORDER BY digits DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT *, least(2::DOUBLE, coalesce(arg_min(level, ratio) FILTER (WHERE level <= ratio) OVER own, 2::DOUBLE) * digits) AS copies
      FROM h WINDOW own AS (PARTITION BY no_source, source)),
q AS (SELECT *, floor(copies)::BIGINT AS whole, copies - floor(copies) AS p,
             target - sum(floor(copies)::BIGINT * words) OVER (PARTITION BY no_source, source)::BIGINT AS rest FROM o),
k AS (SELECT d.doc_id, d.size, d.source, d.no_source, q.source_size, q.target, q.whole, q.p, q.rest,
             CASE WHEN q.p > 0 THEN (d.u / (1.0::DOUBLE - d.u)) / (q.p / (1.0::DOUBLE - q.p)) END AS rank_q
      FROM d JOIN q ON d.source = q.source AND d.no_source = q.no_source AND length(bin(d.size)) = q.digits),
c AS (SELECT *, sum(CASE WHEN p > 0 THEN size END) OVER (PARTITION BY no_source, source ORDER BY rank_q NULLS LAST, doc_id NULLS LAST ROWS UNBOUNDED PRECEDING) AS upto FROM k)
SELECT doc_id, size, source_size, target,
       ((whole + CASE WHEN p > 0 AND upto::DOUBLE - size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM c
"""
