"""Source divergence audit: how far the word use of each source lies from that of the other sources of its
language, exactly, from count-level bitmaps.

Within a language and a block of terms, each group (source) stores one bitset of term places for every count
that many terms share.  For two groups, AND and popcount of their bitsets give the number of terms of each pair
of counts, which is multiplied by the distance of the two probabilities; the terms of count zero are the
complement of a group's other bitsets.  Counts that few terms of the block share (fewer than ``DENSE``) are kept
as a list of places, as a bitmap of nearly no bits costs as much as a full one; the terms on either group's
list are compared one by one, and are in no bitset of that group, so each term counts once.

Plan.  Tasks count the terms of their documents by (lang, source, term); the sums are dealt by (lang, term), so
document frequency, total and kept terms need no further shuffle.  The kept counts are written once.  Blocks
are hash ranges of the terms, so term numbers need no global order; all groups of the language meet in a block
as bitsets, and the partial sums of pairs are added up over blocks.  A task holds one block: at most
``BLOCK_TERMS`` expected terms for each source.  The result itself has one row for each pair of sources of a
language; no other pairs are made.

Arithmetic is exact: probabilities are integers, from Python integers per count or decimals of 38 digits.

Defined cases: null text, lang and source are empty strings; an empty text still makes its group occur; rows
that repeat are documents of their own; a language without kept terms gives pairs of value 0 and no terms; a
language of one source gives no pairs; equal values are ranked by the item's UTF-8 bytes; an empty table gives
no row; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import batch_of, materialize, texts

MIN_DOCUMENTS, SMOOTHING, SCALE, TOP = 30, 5, 1_000_000_000, 50
BLOCK_TERMS, DENSE = 2048, 8
FLUSH = 1 << 18                 # distinct terms a task counts before it gives them on
#: A-Z lower-cased; all other bytes but a-z and those of non-ASCII characters a space.
TERM = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


# -- counts --------------------------------------------------------------------------------
def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group, counted by task; one
    row of a null term for each group a task has met."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def task(batches):
        n: dict[tuple, Counter] = {}
        d: dict[tuple, Counter] = {}
        size = 0

        def rows():
            for key, c in n.items():
                terms = list(c)
                own = d[key]
                yield batch_of(schema, [[key[0]] * (len(c) + 1), [key[1]] * (len(c) + 1), [None, *(t.decode() for t in terms)],
                                        [0, *c.values()], [0, *map(own.__getitem__, terms)]])

        for b in batches:
            for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), texts(b.column("text"))):
                key = lang, source
                if key not in n:
                    n[key], d[key] = Counter(), Counter()
                own, before = Counter(text.translate(TERM).split()), len(n[key])
                n[key].update(own)
                d[key].update(own.keys())
                size += len(n[key]) - before
                if size >= FLUSH:
                    yield from rows()
                    n, d, size = {}, {}, 0
        yield from rows()

    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(empty("lang"), empty("source"), empty("text")).mapInArrow(
        task, "lang string, source string, term string, n long, docs long")


def probability(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * terms)), exactly."""
    wide = lambda c: c.cast("decimal(20,0)")
    over = F.lit(SCALE).cast("decimal(10,0)") * wide(n + SMOOTHING)
    return F.call_function("div", over, wide(total + SMOOTHING * terms)) + 1


# -- bitsets -------------------------------------------------------------------------------
class Levels:
    """A group's counts over the terms of one block: bitsets for counts that many terms share, places for others."""

    def __init__(self, counts: np.ndarray, denominator: int, dense: int = DENSE):
        n = len(counts)
        self.counts = counts
        levels, inverse, size = np.unique(counts, return_inverse=True, return_counts=True)
        keep = (size >= dense) & (levels > 0)
        self.probability = {int(c): 1 + SCALE * (int(c) + SMOOTHING) // denominator for c in levels}
        self.zero = 1 + SCALE * SMOOTHING // denominator
        self.few = np.flatnonzero(~keep[inverse] & (counts > 0))
        bits = np.zeros((int(keep.sum()) + 1, -(-n // 64) * 64), bool)
        row = np.cumsum(keep) - 1
        at = np.flatnonzero(keep[inverse])
        bits[row[inverse[at]], at] = True
        bits[-1, :n] = ~(bits[:-1, :n].any(axis=0))     # count zero, by complement
        bits[-1, self.few] = False
        self.bits = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        self.p = np.array([*(self.probability[int(c)] for c in levels[keep]), self.zero], np.int64)
        # the probability of each term, for the terms that stand in no bitset of the other group
        self.each = np.array([self.probability.get(int(c), self.zero) for c in levels], np.int64)[inverse] if n else np.zeros(0, np.int64)


def distance(a: Levels, b: Levels) -> int:
    """Sum over the block's terms of the distance between two groups' probabilities."""
    total = 0
    far = np.abs(a.p[:, None] - b.p[None, :])
    for i in range(len(a.p)):
        joint = np.bitwise_count(a.bits[i][None, :] & b.bits).sum(axis=1, dtype=np.int64)
        total += int((joint * far[i]).sum())
    few = np.union1d(a.few, b.few)
    return total + int(np.abs(a.each[few] - b.each[few]).sum())


def _block_pairs(counts: DataFrame, blocks: DataFrame, groups: DataFrame, dense: int) -> DataFrame:
    """(lang, a, b, value) of each pair of sources a < b in each block of terms."""
    schema = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])
    # every group of the language stands in every block, also with no term of it
    present = groups.join(blocks, "lang").select("lang", "block", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"),
                                                (F.col("total") + SMOOTHING * F.col("terms")).alias("denominator"))
    rows = counts.select("lang", "block", "source", "term", "n", F.lit(None).cast("long").alias("denominator")).unionByName(present)

    def block(held: list) -> pa.RecordBatch:
        lang = held[0][0]
        names = sorted({t for *_, t, _, _ in held if t is not None})
        place = {t: i for i, t in enumerate(names)}
        by: dict[str, np.ndarray] = {}
        denominators: dict[str, int] = {}
        for _, _, source, term, n, denominator in held:
            if source not in by:
                by[source] = np.zeros(len(names), np.int64)
            if term is None:
                denominators[source] = denominator
            else:
                by[source][place[term]] = n
        sources = sorted(by)
        levels = [Levels(by[s], denominators[s], dense) for s in sources]
        pairs = [(i, j) for i in range(len(sources)) for j in range(i + 1, len(sources))]
        return batch_of(schema, [[lang] * len(pairs), [sources[i] for i, _ in pairs], [sources[j] for _, j in pairs],
                                 [distance(levels[i], levels[j]) for i, j in pairs]])

    def task(batches):
        held: list = []
        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in ("lang", "block", "source", "term", "n", "denominator"))):
                if held and r[:2] != held[0][:2]:
                    yield block(held)
                    held = []
                held.append(r)
        if held:
            yield block(held)

    return rows.repartition("lang", "block").sortWithinPartitions("lang", "block").mapInArrow(
        task, "lang string, a string, b string, value long")


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP, block_terms: int = BLOCK_TERMS, dense: int = DENSE) -> DataFrame:
    """(lang, source, part, item, value, rank): the distance of each source to every other source of its language
    (part ``pair``), and the terms it uses most beyond its language (part ``term``)."""
    found = term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = Window.partitionBy("lang", "term")
    # a window over the rows of one term: as many as it has sources
    counts = found.withColumns({"in_docs": F.sum("docs").over(by_term), "in_lang": F.sum("n").over(by_term)})
    counts = materialize(counts.where(F.col("term").isNull() | (F.col("in_docs") >= min_documents)).select("lang", "term", "source", "n", "in_lang"), "counts")
    kept = counts.where("term IS NOT NULL")
    langs = counts.groupBy("lang").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("lang_total"))
    terms = kept.select("lang", "term").groupBy("lang", "term").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.count("*").alias("terms"))
    groups = counts.groupBy("lang", "source").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    groups = materialize(groups.join(langs, "lang").join(terms, "lang", "left").withColumn("terms", F.coalesce("terms", F.lit(0))), "groups")

    # pairs
    number = F.pmod(F.xxhash64("term"), F.greatest(F.lit(1), F.ceil(F.col("terms") / block_terms)))
    size = groups.groupBy("lang").agg(F.max("terms").alias("terms"))
    placed = kept.join(size, "lang").withColumn("block", number)
    blocks = placed.select("lang", "block").distinct()
    parts = _block_pairs(placed, blocks, groups, dense).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = parts.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        parts.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    other = groups.where("terms = 0").select("lang", "source")
    none = other.join(other.withColumnRenamed("source", "item"), "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = both.unionByName(none).withColumn("rank", F.row_number().over(order))

    # terms
    used = kept.join(groups, ["lang", "source"]).where("n > 0")
    p, q = probability(F.col("n"), F.col("total"), F.col("terms")), probability(F.col("in_lang"), F.col("lang_total"), F.col("terms"))
    far = used.select("lang", "source", F.col("term").alias("item"), (p - q).cast("long").alias("value")).where("value > 0")
    words = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(words.withColumn("part", F.lit("term")).select(*columns))


#: DuckDB SQL of the query, for tables whose pairs of (source, source, term) it can hold.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
w AS (SELECT doc, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
pg AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.n, 0)::HUGEINT + 5 * s.v) AS p
  FROM groups g JOIN kept k USING (lang) JOIN size s USING (lang) LEFT JOIN total t USING (lang, source)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pl AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // (sum(sum(n)) OVER (PARTITION BY lang)::HUGEINT + 5 * any_value(v)) AS q
  FROM c JOIN size USING (lang) GROUP BY lang, term),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM pg a JOIN pg b USING (lang, term) GROUP BY ALL) x
    ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM pg JOIN pl USING (lang, term) WHERE n > 0 AND p > q),
both_parts AS (SELECT * FROM pair UNION ALL SELECT * FROM term)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM both_parts)
WHERE part = 'pair' OR rank <= 50
"""
