"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order (by a hash of the id).  An entry's
virtual finish time is the source's words up to and including it, divided by the source's target;
sorted by that time over all sources, any prefix of the mix holds the sources in the ratio of
their targets, and at time 1 every source has reached its target and the mix its total budget.
There it is truncated: the entry that stands across the end is cut.  A source whose target is
above its size starts over, up to ``repeats`` passes.

Targets: the budget is shared by weight; a target stops at ``repeats`` times its source's size and
the excess is reshared by weight until none is above.  That fixed point is
``target = min(repeats * size, level * weight)`` with one level for all, found from the sources
sorted by ``repeats * size / weight``; it is computed on one row for each source.

A hot source is never gathered: its queue is split by the first three hex digits of the hash
into 4096 runs; running sums inside each run, offset by the sums of the runs before it, give every
document's place.  Shuffles carry ids and sizes, and texts only
on demand.

Defined cases: a null text has size 0 and is taken 0 times; a null source is a source of its own,
last in order; sources without words have target 0; repeated rows are entries of their own; rows
that tie in the hash are ordered by size; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import aside, text_key

REPEATS = 3
RUN_DIGITS = 3
WEIGHTS = (1, 2, 3)


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """source_no, source, source_size, weight, target; the sources by code point, null last."""
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    src = (src.withColumn("source_no", F.row_number().over(by_name))
           .withColumn("weight", F.element_at(cycle, F.pmod(F.col("source_no") - 1, F.lit(len(weights))) + 1))
           .withColumn("cap", F.col("source_size") * float(repeats)))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(0, Window.unboundedFollowing)
    everything = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    src = (src.withColumn("at", F.row_number().over(filling))
           .withColumn("level", (F.sum("source_size").over(everything)
                                 - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                       / F.sum("weight").over(after)))
    # the first source that the level does not lift above its cap sets the level for all after it
    level = F.first(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level")),
                    ignorenulls=True).over(everything)
    return src.select("source_no", "source", "source_size", "weight",
                      F.least("cap", level * F.col("weight")).alias("target"))


def schedule(docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS, texts: bool = False) -> DataFrame:
    """Each document's place: all columns of ``docs`` (``text`` on demand only), plus size, source_size,
    target, start (words of its source before it) and taken (words the mix takes of it); these replace user columns
    of their names.  With ``texts``, documents that tie in id and size stand in the order of a hash of their text."""
    made = ["size", "source_no", "source_size", "target", "start", "taken"]
    order = [c for c in docs.columns if (texts or c != "text") and c not in made]
    docs, names = aside(docs, ("doc_id", "source", "text"), made)
    kept = [c for c in docs.columns if texts or c != "text"]
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = docs.select(*kept, F.coalesce(words(F.col("text")), F.lit(0)).alias("size"), key.alias("place"))
    src = source_targets(sized.select("source", "size"), weights, repeats).withColumnRenamed("source", "name")
    sized = (sized.withColumn("run", F.substring("place", 1, RUN_DIGITS)))
    runs = sized.groupBy("source", "run").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    runs = (runs.join(src, F.col("source").eqNullSafe(F.col("name")))
            .select(F.col("source").alias("run_source"), F.col("run").alias("run_no"), "offset",
                    "source_no", "source_size", "weight", "target"))
    inside = (Window.partitionBy("source", "run").orderBy("place", "size", *([F.xxhash64("text")] if texts else []))
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = sized.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(runs, F.col("source").eqNullSafe(F.col("run_source")) & (F.col("run") == F.col("run_no")))
    start = F.col("offset") + F.col("before")
    end = F.floor("target")
    taken = sum((F.greatest(F.lit(0), F.least(F.col("size"), end - k * F.col("source_size") - start))
                 for k in range(repeats)), F.lit(0))
    back = {c: n for n, c in names.items()}
    return placed.select(*(F.col(back.get(c, c)).alias(c) for c in order), "size", "source_no", "source_size", "target",
                         start.cast("long").alias("start"), taken.cast("long").alias("taken"))


def mix(placed: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """The mix itself: one row for each pass over a document, in the order of virtual finish time
    (``finish``, at most 1 within the budget), with the words taken in that pass."""
    entries = placed.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    begin = F.col("start") + F.col("pass") * F.col("source_size")
    words_taken = F.greatest(F.lit(0), F.least(F.col("size"), F.floor("target") - begin))
    return (entries.withColumn("pass_words", words_taken.cast("long")).where("pass_words > 0")
            .withColumn("finish", (begin + F.col("pass_words")) / F.col("target"))
            .orderBy("finish", "source_no", "doc_id", "pass"))


def digest(placed: DataFrame) -> DataFrame:
    """One row per document, in the order of its first virtual finish time."""
    finish = F.when(F.col("target") > 0, (F.col("start") + F.col("size")) / F.col("target"))
    return (placed.select("doc_id", "size", "source_size", "target", "taken", finish.alias("finish"))
            .orderBy(F.col("finish").asc_nulls_last(), "doc_id"))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
                  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             row_number() OVER (ORDER BY source ASC NULLS LAST) AS no FROM d GROUP BY source),
w AS (SELECT *, ((no - 1) % 3 + 1)::DOUBLE AS weight, source_size * 3.0::DOUBLE AS cap FROM s),
f AS (SELECT a.no, (SELECT sum(source_size) FROM w)
             - coalesce((SELECT sum(b.cap) FROM w b WHERE (b.cap / b.weight, b.no) < (a.cap / a.weight, a.no)), 0) AS budget_left,
             (SELECT sum(b.weight) FROM w b WHERE (b.cap / b.weight, b.no) >= (a.cap / a.weight, a.no)) AS weight_left,
             a.cap / a.weight AS ratio FROM w a),
l AS (SELECT budget_left / weight_left AS level FROM f WHERE budget_left / weight_left <= ratio
      ORDER BY ratio, no LIMIT 1),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT level FROM l), 0) * weight) AS target FROM w),
p AS (SELECT d.*, t.source_size, t.target,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (greatest(0, least(size, floor(target)::BIGINT - start))
        + greatest(0, least(size, floor(target)::BIGINT - source_size - start))
        + greatest(0, least(size, floor(target)::BIGINT - 2 * source_size - start)))::BIGINT AS taken,
       CASE WHEN target > 0 THEN (start + size) / target END AS finish
FROM p
"""
