"""Line dedup: content-defined chunks of lines, DataFrame functions only.

A text is split at line feeds.  A rolling hash over the hashes of ``window`` consecutive lines
ends a chunk after a line when it is divisible by ``divisor``, so boundaries depend on nearby
lines only and shift with them.  A chunk of two or more lines that also stands elsewhere in the
corpus is removed there; it stays at its first place in the document of the smallest id.
Chunks miss most short passages, whose first and last lines share chunks with the text around them.
With ``passages`` the pieces are therefore all pairs of consecutive lines instead: a line goes if a
pair that holds it stands earlier, so every run of two or more lines that stands elsewhere goes
whole.  A pair that overlaps its own first place leaves that place alone, and every line stays
somewhere: a line that goes has its copy at an earlier place.

Plan: (1) a 64-bit hash of each multi-line chunk is counted over the corpus (longs are
shuffled); (2) the texts are joined once with the places whose hash repeats; (3) only those
chunks are grouped by their bytes, which is the byte comparison, and each place learns whether
its document is the keeper; (4) the same shuffled texts (one exchange, used twice) are rebuilt
from the kept chunks.  A hot chunk is combined before each shuffle, and the joins may be split by
adaptive execution.

Defined cases: a null text stays null with no lines; an empty text is one empty line and never
changes; rows that are equal in doc_id and text are one document; a chunk whose documents all
have a null id stays at its first place in each of them; a null id is otherwise larger than any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import aside

WINDOW = 2
DIVISOR = 2


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def row_key() -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("text")))


def chunks(text: Column, window: int, divisor: int) -> Column:
    """The text's chunks: array of (chunk, n_lines); the chunks join with line feeds to the text."""
    def ends(lines: Column, hashes: Column) -> Column:
        def end(h: Column, i: Column) -> Column:
            rolled = sum((F.get(hashes, i - k) * (31 ** k) for k in range(1, window)), h)
            return F.when((i >= window - 1) & (i + 1 < F.size(lines)) & (rolled % divisor == 0), i + 1)
        return F.concat(F.filter(F.transform(hashes, end), lambda e: e.isNotNull()), F.array(F.size(lines)))

    def cut(lines: Column, at: Column) -> Column:
        def chunk(e: Column, i: Column) -> Column:
            start = F.when(i == 0, 0).otherwise(F.get(at, i - 1))
            return F.struct(F.array_join(F.slice(lines, start + 1, e - start), "\n").alias("chunk"),
                            (e - start).alias("n"))
        return F.transform(at, chunk)

    line_hash = lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long")
    return let(F.split(text, "\n", -1), lambda lines: let(
        F.transform(lines, line_hash), lambda hashes: let(
            ends(lines, hashes), lambda at: cut(lines, at))))


def pairs(text: Column) -> Column:
    """All pairs of consecutive lines, as (chunk, n_lines); a single line has none."""
    return let(F.split(text, "\n", -1), lambda lines: F.transform(
        F.slice(lines, 1, F.size(lines) - 1),
        lambda x, i: F.struct(F.concat(x, F.lit("\n"), F.get(lines, i + 1)).alias("chunk"), F.lit(2).alias("n"))))


def line_dedup(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR, passages: bool = False) -> DataFrame:
    """All columns of ``docs`` with the kept text, plus n_lines, n_chunks, removed_lines and
    removed_chunks (with ``passages`` the chunks counted are the pairs of lines); these four replace user columns
    of their names."""
    counts = ("n_lines", "n_chunks", "removed_lines", "removed_chunks")
    order = [c for c in docs.columns if c != "text" and c not in counts]
    docs, names = aside(docs, ("doc_id", "text"), counts)
    keyed = docs.withColumn("row_key", row_key())
    own = pairs(F.col("text")) if passages else chunks(F.col("text"), window, divisor)
    places = (docs.select("doc_id", "text").withColumn("row_key", row_key())
              .select("row_key", F.posexplode(own).alias("pos", "c")).where("c.n > 1")
              .select("row_key", "pos", F.xxhash64("c.chunk").alias("h")))
    repeated = places.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    by_doc = (places.join(repeated, "h", "left_semi").groupBy("row_key")
              .agg(F.collect_set("pos").alias("repeated")).withColumnRenamed("row_key", "rep_key"))
    places = (keyed.join(by_doc, F.col("row_key") == F.col("rep_key"))
              .select("row_key", "doc_id", "repeated", F.posexplode(own).alias("pos", "c"))
              .where(F.array_contains("repeated", F.col("pos")))
              .select("row_key", "doc_id", "pos", F.col("c.chunk").alias("chunk")))
    # grouped by the bytes themselves; rows equal in doc_id and text count once
    classes = (places.distinct().groupBy("chunk").agg(F.count("*").alias("n"), F.min("doc_id").alias("keeper"))
               .where("n > 1").withColumnRenamed("chunk", "class"))
    mark = F.struct("pos", F.col("doc_id").eqNullSafe(F.col("keeper")).alias("keeper"))
    marks = (places.join(classes, F.col("chunk") == F.col("class")).groupBy("row_key")
             .agg(F.collect_set(mark).alias("marks")).withColumnRenamed("row_key", "mark_key"))
    whole = keyed.join(marks, F.col("row_key") == F.col("mark_key"), "left")

    def gone(all_: Column) -> Column:
        """the marks that go; in the keeper's document the first of equal chunks stays"""
        return F.filter(
            F.coalesce("marks", F.array().cast("array<struct<pos:int,keeper:boolean>>")),
            lambda m: ~m["keeper"] | (F.array_position(all_, F.get(all_, m["pos"])) <= m["pos"]))

    def without_pairs(c: Column) -> Column:
        """kept text and counts by lines; a pair right after its equal first place shares a line with it"""
        def lines_of(all_: Column):
            return lambda m: F.when(
                m["keeper"] & (F.array_position(all_, F.get(all_, m["pos"])) == m["pos"]),
                F.array(m["pos"] + 1)).otherwise(F.array(m["pos"], m["pos"] + 1))

        return let(F.split("text", "\n", -1), lambda lines: let(F.transform(c, lambda x: x["chunk"]), lambda all_: let(
            gone(all_), lambda away: let(F.array_except(
                F.sequence(F.lit(0), F.size(lines) - 1), F.flatten(F.transform(away, lines_of(all_)))),
                lambda stay: F.struct(
                    F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n").alias("text"),
                    F.size(lines).cast("long").alias("n_lines"),
                    F.size(c).cast("long").alias("n_chunks"),
                    (F.size(lines) - F.size(stay)).cast("long").alias("removed_lines"),
                    F.size(away).cast("long").alias("removed_chunks"))))))

    def rebuilt(c: Column) -> Column:
        """kept text and counts"""
        texts = F.transform(c, lambda x: x["chunk"])
        return let(texts, lambda all_: let(F.transform(gone(all_), lambda m: m["pos"]), lambda away: F.struct(
                F.array_join(F.filter(all_, lambda x, i: ~F.array_contains(away, i)), "\n").alias("text"),
                F.aggregate(c, F.lit(0), lambda a, x: a + x["n"]).cast("long").alias("n_lines"),
                F.size(c).cast("long").alias("n_chunks"),
                F.aggregate(away, F.lit(0), lambda a, i: a + F.get(c, i)["n"]).cast("long").alias("removed_lines"),
                F.size(away).cast("long").alias("removed_chunks"))))

    others = [c for c in docs.columns if c != "text"]
    made = whole.select(*others, F.explode(F.array(F.when(F.col("text").isNotNull(), let(
        own, without_pairs if passages else rebuilt)))).alias("made"))
    back = {c: n for n, c in names.items()}
    return made.select(*(F.col(back.get(c, c)).alias(c) for c in order), F.col("made.text").alias("text"),
                       *(F.coalesce(f"made.{c}", F.lit(0).cast("long")).alias(c) for c in counts))


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_lines", "n_chunks", "removed_lines", "removed_chunks",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = """
WITH d AS (SELECT DISTINCT doc_id, text, md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || coalesce('|' || text, '')) AS k
           FROM documents),
l AS (SELECT doc_id, k, generate_subscripts(string_split(text, chr(10)), 1) AS i,
             unnest(string_split(text, chr(10))) AS line FROM d WHERE text IS NOT NULL),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM l),
r AS (SELECT *, coalesce((h + 31 * lag(h) OVER w) % 2 = 0, false) AS cut FROM h WINDOW w AS (PARTITION BY k ORDER BY i)),
g AS (SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS c FROM r),
c AS (SELECT doc_id, k, c, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk FROM g GROUP BY doc_id, k, c),
x AS (SELECT *, n > 1 AND count(*) OVER (PARTITION BY chunk) > 1 AND NOT (
             doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY chunk)
             AND c = min(c) OVER (PARTITION BY chunk, k)) AS away FROM c),
o AS (SELECT k, sum(n)::BIGINT AS n_lines, count(*) AS n_chunks,
             coalesce(sum(n) FILTER (away), 0)::BIGINT AS removed_lines, count(*) FILTER (away) AS removed_chunks,
             coalesce(string_agg(chunk, chr(10) ORDER BY c) FILTER (NOT away), '') AS kept FROM x GROUP BY k)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_chunks, 0) AS n_chunks,
       coalesce(removed_lines, 0) AS removed_lines, coalesce(removed_chunks, 0) AS removed_chunks,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN o
  ON o.k = md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || coalesce('|' || text, ''))
"""
