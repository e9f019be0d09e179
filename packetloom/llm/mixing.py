"""Mixing sources to target weights by a time-varying curriculum.

Every source has a weight schedule over training time 0..1, piecewise linear between
knots. Its integral, scaled to the source's target, is the cumulative token demand.
The documents of a source stand in a fixed pseudo-random order (MD5 of the id); the
token offset of a document in that order, inverted through the demand, is its
training position, and the mix is sorted by position in ranges. A source whose target
exceeds its size is passed several times, the last pass in part.

Offsets are running sums over a whole source. They are cut into ranges of the MD5, more
with the documents, so no task holds a source: sums per range first, then offsets of ranges.
"""

from __future__ import annotations

import math
from itertools import pairwise

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from packetloom.llm.common import WORD, saved, text_of

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
RANGE_ROWS = 4096
# (time, weight) knots for the sources, repeating in source order: early, level, late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.6, 1.2), (1.0, 1.2)))


def word_count(name):
    return F.size(F.regexp_extract_all(text_of(name), F.lit(WORD), F.lit(0))).cast("long")


def source_targets(sizes, weights=WEIGHTS, most=MOST_PASSES):
    """(src, source, source_size), one row per source -> with ``nth`` and ``target``.

    Targets share the sum of all sizes by weight. None exceeds ``most`` times its size;
    what is cut off goes to the others by weight, so that in the end every target is
    min(most * size, level * weight) for one common level. There may be any number of
    sources: they are numbered, and filled in the order of their room, by ranges.
    """
    nth = _in_ranges(sizes.withColumn("unknown", F.col("source").isNull()), ["unknown", "source"], {"one": F.lit(1).cast("long")}, "mix-sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("nth") % len(weights) + 1).cast("int"))
    t = (
        nth.withColumn("nth", F.col("one_ahead"))
        .withColumn("weight", weight.cast("long"))
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("room", F.col("cap").cast("double") / F.col("weight").cast("double"))
        .select("src", "source_size", "nth", "weight", "cap", "room")
    )
    t = _in_ranges(t, ["room", "nth"], {"cap": F.col("cap"), "weight": F.col("weight"), "size": F.col("source_size")}, "mix-targets")
    here = (F.col("size_sum") - F.col("cap_ahead")).cast("double") / (F.col("weight_sum") - F.col("weight_ahead")).cast("double")
    level = t.withColumn("here", here).filter("room >= here").agg(F.min(F.struct("room", "nth", "here")).alias("level")).select("level.here").first()[0]
    target = F.least(F.col("cap").cast("double"), F.lit(level).cast("double") * F.col("weight").cast("double"))
    return t.select("src", "source_size", "nth", target.alias("target"))


def _in_ranges(rows, order, sums, label):
    """``rows`` with, for each of ``sums`` (name -> column), the sum over all rows that come
    before in ``order`` (``name_ahead``) and over all rows (``name_sum``).

    The rows are written in ranges of the order; sums run inside a range, and one row for
    each range carries what lies before it.
    """
    part = F.spark_partition_id().alias("part")
    placed = saved(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("*", part), label)
    every = W.partitionBy().orderBy("part")
    ranges = placed.groupBy("part").agg(*(F.sum(c).alias(f"{n}_all") for n, c in sums.items()))
    ranges = ranges.select(
        "part",
        *((F.sum(f"{n}_all").over(every) - F.col(f"{n}_all")).alias(f"{n}_before") for n in sums),
        *(F.sum(f"{n}_all").over(W.partitionBy()).alias(f"{n}_sum") for n in sums),
    )
    inside = W.partitionBy("part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    out = placed.join(ranges, "part")
    return out.withColumns(
        {f"{n}_ahead": F.col(f"{n}_before") + F.sum(c).over(inside) - c for n, c in sums.items()}
    ).drop("part", *(f"{n}_before" for n in sums))


def demand_time(part, knots):
    """The time by which a schedule has asked for ``part`` (0..1) of its tokens."""
    pieces, done = [], 0.0
    for (t0, w0), (t1, w1) in pairwise(knots):
        pieces.append((done, t0, t1, w0, w1))
        done += (t1 - t0) * (w0 + w1) / 2
    out = F.lit(float(knots[-1][0]))
    for begin, t0, t1, w0, w1 in reversed(pieces):
        y = part * done - begin
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + y * (2 * (w1 - w0) / (t1 - t0))))
        x = F.when(y > 0, 2 * y / (F.lit(w0) + root)).otherwise(F.lit(0.0))
        here = F.least(F.lit(float(t1)), F.lit(float(t0)) + x)
        end = begin + (t1 - t0) * (w0 + w1) / 2
        out = F.when(part * done < end, here).otherwise(out)
    return out


def schedule(
    docs, weights=WEIGHTS, most=MOST_PASSES, schedules=SCHEDULES,
    id_col="doc_id", text_col="text", source_col="source", carry=False,
):
    """One row per document: how often the mix takes it, and when.

    Columns: id, ``size`` (words; null text 0), ``source_size``, ``target``, ``copies``,
    ``taken`` (copies * size) and ``positions`` (one training time per copy). With
    ``carry`` the whole input row goes along as the struct ``row``. Documents are taken
    whole: in the last pass those whose middle lies before the rest of the target, so a
    source misses its target by half a document at most. Null sources form one source,
    last in order; documents without words have size 0; repeated rows count each;
    an empty table gives no rows.
    """
    source = F.col(source_col).cast("string")
    # digits of the MD5 that make ranges of ``RANGE_ROWS`` rows of one source, were it the only one
    digits = max(3, math.ceil(math.log(max(1, docs.count() / RANGE_ROWS), 16)))
    kept = [F.struct(*docs.columns).alias("row")] if carry else []
    md5 = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    rows = saved(
        docs.select(
            F.col(id_col).alias("id"), source.alias("source"),
            F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source)).alias("src"),
            word_count(text_col).alias("size"), md5.alias("md5"),
            F.crc32(text_of(text_col).cast("binary")).alias("crc"),
            F.conv(F.substring(md5, 1, digits), 16, 10).cast("long").alias("bucket"),
            *kept,
        ),
        "mix-rows",
    )
    ranges = rows.groupBy("src", "source", "bucket").agg(F.sum("size").alias("words"))
    targets = source_targets(
        ranges.groupBy("src", "source").agg(F.sum("words").alias("source_size")), weights, most
    )
    before = F.sum("words").over(W.partitionBy("src").orderBy("bucket")) - F.col("words")
    plan = ranges.withColumn("ahead", before).drop("words", "source").join(targets, "src")
    inside = W.partitionBy("src", "bucket").orderBy("md5", "id", "size", "crc").rowsBetween(W.unboundedPreceding, 0)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    placed = (
        rows.withColumn("offset", F.sum("size").over(inside) - F.col("size"))
        .join(plan, ["src", "bucket"])
        .withColumn("offset", F.col("offset") + F.col("ahead"))
        .withColumn("passes", passes.cast("long"))
        .withColumn("rest", F.col("target") - (F.col("passes") * F.col("source_size")).cast("double"))
        .withColumn("extra", (F.col("offset") * 2 + F.col("size")).cast("double") <= F.col("rest") * 2)
        .withColumn("copies", F.least(F.lit(most), F.col("passes") + F.col("extra").cast("long")).cast("int"))
    )

    def position(nth_pass):
        at = (nth_pass * F.col("source_size") + F.col("offset")).cast("double")
        part = F.when(F.col("target") > 0, F.least(F.lit(1.0), at / F.col("target"))).otherwise(F.lit(0.0))
        times = [demand_time(part, k) for k in schedules]
        kind = F.col("nth") % len(schedules)
        out = times[-1]
        for j, t in enumerate(times[:-1]):
            out = F.when(kind == j, t).otherwise(out)
        return out

    every = F.array(*(F.when(F.col("copies") > p, position(F.lit(p))) for p in range(most)))
    return placed.select(
        F.col("id").alias(id_col), "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
        F.filter(every, lambda x: x.isNotNull()).alias("positions"),
        *(["row"] if carry else []),
    )


def mixed(docs, **options):
    """The mix itself: the rows of ``docs`` with all their columns, a row per copy, in
    training order (ranges of the position, sorted inside)."""
    plan = schedule(docs, carry=True, **options)
    copies = plan.select("row", F.explode("positions").alias("position"))
    order = [F.col("position"), F.col(f"row.{options.get('id_col', 'doc_id')}")]
    ordered = copies.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


ORACLE = r"""
WITH rows AS (
  SELECT doc_id, source, text,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth
  FROM rows GROUP BY source),
weighed AS (
  SELECT *, CASE nth % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS cap
  FROM sources),
levels AS (
  SELECT *, CAST(cap AS DOUBLE) / weight AS room,
         CAST(sum(source_size) OVER () - (sum(cap) OVER o - cap) AS DOUBLE)
           / CAST(sum(weight) OVER () - sum(weight) OVER o + weight AS DOUBLE) AS here
  FROM weighed WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, nth)),
targets AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE),
               (SELECT here FROM levels WHERE room >= here ORDER BY room, nth LIMIT 1) * weight) AS target
  FROM levels),
placed AS (
  SELECT r.doc_id, r.size, t.source_size, t.target,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY h, doc_id, size, text
                           ROWS UNBOUNDED PRECEDING) - r.size AS ahead,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS passes
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, CAST(least(3, passes + CASE WHEN CAST(ahead * 2 + size AS DOUBLE)
                   <= (target - passes * source_size) * 2 THEN 1 ELSE 0 END) AS INTEGER) AS copies
  FROM placed)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, copies
FROM counted
"""
