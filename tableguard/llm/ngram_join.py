"""N-gram Jaccard join with set-relation skipping: documents whose sets of distinct 5-word shingles
have a Jaccard similarity of at least 0.8, exactly.

Sets are ordered by (frequency class, hash), rarest first, and two similar sets share one of their
first ``n - ceil(0.8 n) + 1`` shingles, so only those are indexed.  The order needs frequencies of
common shingles only: they are counted over all documents, block by block (a shingle that stands
once in a block is left out there, so every shingle in more documents than there are blocks is
counted); the ``HEAD`` most frequent ones get their count, all others are rarer.  Any order gives
the same result; ``HEAD`` bounds the broadcast.

Relations between sets save comparisons:

* equal sets are one set (their answers are the same);
* each index list is first compared with one leader only (a long list with several, if asked), and the size of
  each overlap is kept.  Sets already joined through verified links share a component, and their pairs are
  skipped from then on.  While the lists hold many more open pairs than rows, further leaders take turns, so a
  large group of near copies needs a logarithmic number of turns and not all its pairs;
* the answers of two sets of a list follow from those of its leader, as far as they do (``derived``): with
  ``o`` shingles in the leader, sets x and y share at least ``ox + oy - |leader|`` and at most
  ``min(ox, oy) + min(|x| - ox, |y| - oy)``.  Pairs that this decides are never compared;
* what is left, pairs of different components in one list, is joined by blocks of the list: a set meets only
  the size blocks, and within each only the place blocks, in which the overlap can still be reached; all
  other blocks are skipped, as they are not in its join keys.  256 parity bits of each set skip further pairs.

Surviving candidates are verified on the whole sets.  A list's leader comes from a partial aggregation
and is joined back, so a hot list is never gathered.  Set ids are 64-bit hashes.

Defined cases: a null text, or one without words, has no shingles and is linked with nothing; a text
of 1 to 4 words has its whole sequence as the only shingle; rows that repeat are equal sets; a null
doc_id never names a component that has another id; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import batch_of, materialize, mix, pieces, space_words, text_key, utf8
from .components import components

WORDS, SIMILAR = 5, 80          # shingle size; similarity in percent
HEAD, BLOCK = 1 << 17, 4 << 20  # frequent shingles kept; shingles counted at a time
BITMAP = 1 << 23                # bits of the filter for wanted sets
LEADERS = 8                     # leaders a turn
LONG = 2 * LEADERS              # rows of a long list
PLACES = 2                      # place blocks of a size block
OPEN = 8                        # open pairs for each index row that are joined without another leader
_STEPS = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1) for k in range(64)]


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    words, row = space_words(data, off)
    count = np.bincount(row, minlength=len(off) - 1)
    start = np.concatenate(([0], np.cumsum(count)))
    rolled = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for j in range(k):
        rolled += words[j:len(words) - k + 1 + j] * _STEPS[j]
    rolled = mix(rolled)
    sets = []
    for a, n in zip(start.tolist(), count.tolist()):
        if n >= k:
            s = np.sort(rolled[a:a + n - k + 1])
            sets.append(s[np.append(True, s[1:] != s[:-1])])
        elif n:
            short = sum((words[a + j:a + j + 1] * _STEPS[j] for j in range(n)), np.full(1, n, np.uint64))
            sets.append(mix(short))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_id(s: np.ndarray) -> int | None:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "big", signed=True) if len(s) else None


def parity(sets: list[np.ndarray]) -> list[list[int]]:
    """256 bits of each set: whether the number of shingles with that hash is odd.  The bits in which two
    sets differ are at most the shingles in which they differ."""
    size = np.array([len(s) for s in sets])
    at = (np.concatenate(sets) >> np.uint64(56)).astype(np.int64) + 256 * np.repeat(np.arange(len(sets)), size)
    odd = (np.bincount(at, minlength=256 * len(sets)) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(len(sets), 4).tolist()


def batches_of_sets(batches, k: int):
    """(batch, first row, sets) of blocks of text that fit into a core's cache."""
    for b in batches:
        data, off = utf8(b.column("text"))
        for lo, hi in pieces(off, 1 << 18):
            yield b, lo, shingle_sets(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], k)


def prefix_size(n: int, similar: int) -> int:
    return n - -(-similar * n // 100) + 1


# -- passes over the texts -----------------------------------------------------------------
def set_ids(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """(doc_id, n, k, x): size, id and parity bits of each document's set."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("k", pa.int64()), ("x", pa.list_(pa.int64()))])

    def task(batches):
        for b, lo, sets in batches_of_sets(batches, k):
            yield batch_of(schema, [b.column("doc_id").slice(lo, len(sets)), [len(s) for s in sets],
                                    [set_id(s) for s in sets], parity(sets)])
    return (docs.select(F.col("doc_id").cast("long"), text_key().alias("text"))
            .mapInArrow(task, "doc_id long, n long, k long, x array<long>"))


def frequent(docs: DataFrame, k: int = WORDS, head: int = HEAD, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """The ``head`` most frequent shingles (sorted) and their counts."""
    schema = pa.schema([("t", pa.int64()), ("f", pa.int64())])

    def counted(sets: list[np.ndarray]) -> pa.RecordBatch:
        t, f = np.unique(np.concatenate(sets), return_counts=True)
        return batch_of(schema, [pa.array(t[f > 1].view(np.int64)), pa.array(f[f > 1])])

    def task(batches):
        held, size = [], 0
        for _, _, sets in batches_of_sets(batches, k):
            held += sets
            size += sum(map(len, sets))
            if size >= block:
                yield counted(held)
                held, size = [], 0
        if held:
            yield counted(held)

    rows = (docs.select(text_key().alias("text")).mapInArrow(task, "t long, f long")
            .groupBy("t").agg(F.sum("f").alias("f")).orderBy(F.desc("f"), "t").limit(head).toPandas())
    t, f = rows["t"].to_numpy(np.int64).view(np.uint64), rows["f"].to_numpy(np.int64)
    order = np.argsort(t)
    return t[order], f[order]


def ordered(s: np.ndarray, head: np.ndarray, freq: np.ndarray) -> np.ndarray:
    """The set by (frequency, hash); shingles outside the head count as rarest."""
    if not len(head):
        return s
    at = np.minimum(np.searchsorted(head, s), len(head) - 1)
    f = np.where(head[at] == s, freq[at], 0)
    return s[np.argsort(f, kind="stable")]


def postings(docs: DataFrame, head, freq, k: int = WORDS, similar: int = SIMILAR) -> DataFrame:
    """(t, k, n, pos): the indexed shingles of each set; a set that repeats in a task is given once."""
    schema = pa.schema([("t", pa.int64()), ("k", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])
    shared = docs.sparkSession.sparkContext.broadcast((head, freq))

    def task(batches):
        seen: set[int | None] = {None}
        for _, _, sets in batches_of_sets(batches, k):
            own = [(i, s) for i, s in zip(map(set_id, sets), sets) if i not in seen and not seen.add(i)]
            if own:
                t = [ordered(s, *shared.value)[:prefix_size(len(s), similar)] for _, s in own]
                size = np.array([len(x) for x in t])
                yield batch_of(schema, [
                    pa.array(np.concatenate(t).view(np.int64)), pa.array(np.repeat([i for i, _ in own], size)),
                    pa.array(np.repeat([len(s) for _, s in own], size).astype(np.int32)),
                    pa.array(np.concatenate([np.arange(m, dtype=np.int32) for m in size]))])
    return docs.select(text_key().alias("text")).mapInArrow(task, "t long, k long, n int, pos int")


def bitmap(ids: DataFrame, bits: int = BITMAP) -> np.ndarray:
    """A bit for each of the ids k, by their lowest bits.  Of fixed size: with very many ids it only lets
    more sets through, which the joins then drop."""
    at = F.col("k").bitwiseAND(bits - 1)
    words = (ids.groupBy(F.shiftright(at, 6).alias("word"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast((k & {bits - 1}) & 63 as int))")).alias("bits")).toPandas())
    made = np.zeros(bits // 64, np.int64)
    made[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return made


def whole_sets(docs: DataFrame, wanted: DataFrame, k: int = WORDS) -> DataFrame:
    """(k, n, s): the whole sets of at least the wanted ids.  The ids reach the tasks as a bitmap, so no
    text is shuffled."""
    schema = pa.schema([("k", pa.int64()), ("n", pa.int64()), ("s", pa.list_(pa.int64()))])
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(wanted))

    def task(batches):
        seen: set[int | None] = {None}
        of = shared.value
        for _, _, sets in batches_of_sets(batches, k):
            own = [(i, s) for i, s in zip(map(set_id, sets), sets) if i not in seen and not seen.add(i)
                   and of[(i & (64 * len(of) - 1)) >> 6] >> (i & 63) & 1]
            yield batch_of(schema, [[i for i, _ in own], [len(s) for _, s in own],
                                    pa.array([s.view(np.int64) for _, s in own], pa.list_(pa.int64()))])

    rows = docs.select(text_key().alias("text")).mapInArrow(task, "k long, n long, s array<long>")
    return rows.dropDuplicates(["k"])


# -- joins ---------------------------------------------------------------------------------
def reachable(similar: int) -> Column:
    """Length and place filter on sizes na, nb and zero-based places pa, pb of a shared shingle."""
    need = F.ceil(F.lit(similar) * (F.col("na") + F.col("nb")) / (100 + similar) - 1e-9)
    return ((F.least("na", "nb") * 100 >= similar * F.greatest("na", "nb"))
            & (F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= need))


def size_bounds(similar: int) -> list[int]:
    """First sizes of the size blocks, the powers of 100 / similar rounded up: sizes that may be similar are in the
    same or in neighbouring blocks."""
    bounds = [1]
    while bounds[-1] < 1 << 31:
        i = len(bounds)
        bounds.append(-(-100 ** i // similar ** i))
    return bounds


def size_block(n: Column, similar: int) -> Column:
    """struct(size, largest, next): number of the size block of n from 0, its largest size and the next block's."""
    bounds = F.array(*(F.lit(b).cast("long") for b in [*size_bounds(similar), 1 << 62, 1 << 62, 1 << 62]))
    guess = F.floor(F.log(n.cast("double")) / math.log(100 / similar)).cast("int")     # off by one at most
    number = guess + F.when(n < F.get(bounds, guess), -1).when(n >= F.get(bounds, guess + 1), 1).otherwise(0)
    made = F.transform(F.array(number), lambda i: F.struct(
        i.alias("size"), (F.get(bounds, i + 1) - 1).alias("largest"), (F.get(bounds, i + 2) - 1).alias("next")))
    return F.element_at(made, 1)


def place_width(largest: Column, similar: int) -> Column:
    """Width of the place blocks of a size block whose largest size is given."""
    return F.greatest(F.lit(1), F.ceil(largest * (100 - similar) / (100 * PLACES)))


def own_block(of: Column, pos: Column, similar: int) -> Column:
    """The key of the block that an index row stands in, struct(size, place); ``of``: the size_block of its set."""
    return F.struct(of["size"].alias("size"), F.floor(pos / place_width(of["largest"], similar)).cast("long").alias("place"))


def met_blocks(of: Column, n: Column, pos: Column, similar: int) -> Column:
    """The keys of all blocks with rows that a row of size ``n`` at ``pos`` may meet, sizes of at least ``n``.

    A size block is skipped when even its smallest size asks for more shingles than stand from ``pos`` on;
    within it, place blocks are skipped that begin behind the last place from which its largest size still
    reaches the overlap."""
    n = n.cast("long")

    def met(size: Column, smallest: Column, largest: Column) -> Column:
        sizes = F.least(largest, F.floor(n * 100 / similar))                  # the largest size that may be similar
        last = F.floor((sizes * 100 - n * similar) / (100 + similar))         # the last place in a set of that size
        open_ = (smallest <= sizes) & (last >= 0) & ((n - pos) * (100 + similar) >= (n + smallest) * similar)
        places = F.sequence(F.lit(0).cast("long"), F.floor(last / place_width(largest, similar)).cast("long"))
        return F.when(open_, F.transform(places, lambda p: F.struct(size.alias("size"), p.alias("place"))))
    none = F.array().cast("array<struct<size:int,place:bigint>>")
    return F.concat(F.coalesce(met(of["size"], n, of["largest"]), none),
                    F.coalesce(met(of["size"] + 1, of["largest"] + 1, of["next"]), none))


def derived(similar: int, na="na", nb="nb", oa="oa", ob="ob", leader="ln") -> tuple[Column, Column]:
    """(surely similar, surely not) from the overlaps oa, ob of two sets with a third one of size ``leader``;
    both false where an overlap is not known."""
    na, nb, oa, ob, leader = map(F.col, (na, nb, oa, ob, leader))
    need = (na + nb) * similar
    least, most = oa + ob - leader, F.least(oa, ob) + F.least(na - oa, nb - ob)
    known = oa.isNotNull() & ob.isNotNull() & leader.isNotNull()
    return known & (least * (100 + similar) >= need), known & (most * (100 + similar) < need)


def overlaps(docs: DataFrame, pairs: DataFrame, k: int, similar: int) -> DataFrame:
    """(a, b, o, similar): the pairs with the overlap of their whole sets and whether it is enough."""
    wanted = pairs.select(F.col("a").alias("k")).unionByName(pairs.select(F.col("b").alias("k"))).distinct()
    sets = whole_sets(docs, wanted, k)
    side = lambda x: sets.select(F.col("k").alias(x), F.col("n").alias(f"n{x}"), F.col("s").alias(f"s{x}"))
    both = F.size(F.array_intersect("sa", "sb"))
    enough = 100 * F.col("o") >= similar * (F.col("na") + F.col("nb") - F.col("o"))
    return (pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a").select("a", "b", "na", "nb", both.cast("long").alias("o"))
            .select("a", "b", "o", enough.alias("similar")))


def verified(docs: DataFrame, pairs: DataFrame, k: int, similar: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    return overlaps(docs, pairs, k, similar).where("similar").select("a", "b")


def mixed_lists(lists: DataFrame, comp: DataFrame) -> DataFrame:
    """The lists that still hold several components, with each set's component; all other columns stay."""
    kept = [c for c in lists.columns if c not in ("t", "component")]
    lists = (lists.select("t", *kept).join(comp.withColumnRenamed("node", "k"), "k", "left")
             .select("t", *kept, F.coalesce("component", "k").alias("component")))
    mixed = lists.groupBy("t").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    return materialize(lists.join(materialize(mixed.select("t"), "mixed"), "t", "left_semi"), "mixed")


def answered(mixed: DataFrame, answers: DataFrame, similar: int) -> DataFrame:
    """The lists with ln, the size of their leader, and o, each set's overlap with it where it was computed,
    and ``of``, the block of its size."""
    leader = mixed.where("k = lead").select("t", F.col("n").cast("long").alias("ln"))
    known = answers.select(F.col("a").alias("lead"), F.col("b").alias("k"), "o").dropDuplicates(["lead", "k"])
    rows = mixed.join(known, ["lead", "k"], "left").join(leader, "t", "left")
    own = F.when(F.col("k") == F.col("lead"), F.col("n").cast("long")).otherwise(F.col("o"))
    return materialize(rows.select("t", "k", "n", "pos", "component", own.alias("o"), "ln",
                                   size_block(F.col("n"), similar).alias("of")), "answered")


def open_pairs(mixed: DataFrame) -> tuple[int, int]:
    """(bound of the pairs of different components, rows) of the lists."""
    of = mixed.groupBy("t", "component").agg(F.count("*").cast("double").alias("m"))
    of = of.groupBy("t").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("same"))
    pairs, rows = of.agg(F.sum((F.col("m") * F.col("m") - F.col("same")) / 2), F.sum("m")).first()
    return pairs or 0, rows or 0


def cross_pairs(mixed: DataFrame, ids: DataFrame, similar: int) -> DataFrame:
    """(a, b, sure): pairs of different components that share an indexed shingle and pass the filters by size,
    place and parity bits and by their leader's answers, each pair once; sure: those answers make it a link."""
    bits = ids.where("k is not null").select("k", *(F.get("x", i).alias(f"x{i}") for i in range(4))).dropDuplicates(["k"])
    mixed = mixed.join(bits, "k")
    side = lambda x, block: mixed.select(
        "t", F.col("k").alias(x), *(F.col(c).alias(s) for c, s in (("n", f"n{x}"), ("pos", f"p{x}"), ("component", f"c{x}"), ("o", f"o{x}"))),
        *(F.col(f"x{i}").alias(f"x{x}{i}") for i in range(4)), *([F.col("ln")] if x == "a" else []), block.alias("block"))
    a = side("a", F.explode(met_blocks(F.col("of"), F.col("n"), F.col("pos"), similar)))
    b = side("b", own_block(F.col("of"), F.col("pos"), similar))
    differ = sum((F.bit_count(F.col(f"xa{i}").bitwiseXOR(F.col(f"xb{i}"))) for i in range(4)), F.lit(0))
    # similar sets differ in at most (100 - similar) / (100 + similar) of their shingles
    near = differ * (100 + similar) <= (100 - similar) * (F.col("na") + F.col("nb"))
    sure, never = derived(similar)
    flat = lambda d: d.select("*", "block.size", "block.place").drop("block")
    return (flat(a).join(flat(b), ["t", "size", "place"]).where("ca <> cb AND (na < nb OR na = nb AND a < b)").where(near)
            .where(reachable(similar)).where(~never).select("a", "b", sure.alias("sure"))
            .groupBy("a", "b").agg(F.max("sure").alias("sure")))


def new_star_pairs(mixed: DataFrame, turn: int, similar: int) -> DataFrame:
    """(a, b, sure): more leaders for each list, by hashes that change with the turn, with the sets of other
    components that may be similar to them; what the first leader's answers rule out is left out."""
    orders = [F.min(F.struct(F.xxhash64("k", F.lit(turn * LEADERS + i)).alias("order"), "k", "n", "pos", "component", "o"))
              for i in range(LEADERS)]
    leader = mixed.groupBy("t").agg(F.array(*orders).alias("x")).select("t", F.explode("x").alias("x")).select(
        "t", F.col("x.k").alias("a"), F.col("x.n").alias("na"), F.col("x.pos").alias("pa"),
        F.col("x.component").alias("ca"), F.col("x.o").alias("oa"))
    rows = mixed.select("t", F.col("k").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), "component", F.col("o").alias("ob"), "ln")
    sure, never = derived(similar)
    return (rows.join(leader, "t").where("component <> ca").where(reachable(similar)).where(~never)
            .groupBy("a", "b").agg(F.max(sure).alias("sure")))


def star_pairs(lists: DataFrame, similar: int) -> DataFrame:
    """Each list's leader with every other set that may be similar to it: (a, b), once each."""
    leader = (lists.where("k = lead").groupBy("t").agg(F.first("n").alias("na"), F.first("pos").alias("pa")))
    rows = lists.where("k <> lead").select("t", F.col("lead").alias("a"), F.col("k").alias("b"),
                                           F.col("n").alias("nb"), F.col("pos").alias("pb"))
    return rows.join(leader, "t").where(reachable(similar)).select("a", "b").distinct()


def long_lists(lists: DataFrame, long: int) -> DataFrame:
    """The rows of lists of more than ``long`` sets, each its own component."""
    many = lists.groupBy("t").count().where(F.col("count") > long).select("t")
    nothing = F.lit(None).cast("long")
    return (lists.select("t", "k", "n", "pos", F.col("k").alias("component"), nothing.alias("o"), nothing.alias("ln"))
            .join(many, "t", "left_semi"))


def decided(docs: DataFrame, pairs: DataFrame, k: int, similar: int) -> DataFrame:
    """The links among pairs (a, b, sure): the sure ones, and the others after a comparison of whole sets."""
    compared = verified(docs, pairs.where("NOT sure"), k, similar)
    return materialize(compared.unionByName(pairs.where("sure").select("a", "b")), "links")


def near_groups(docs: DataFrame, k: int = WORDS, similar: int = SIMILAR, head: int = HEAD,
                block: int = BLOCK, long: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id): component_id is the smallest doc_id that links reach.

    With ``long``, lists of more sets than that have ``LEADERS`` leaders from the start: fewer pairs are left
    to join, more are verified.  The result is the same.
    """
    ids = materialize(set_ids(docs, k), "sets")
    index = postings(docs, *frequent(docs, k, head, block), k, similar)
    leads = index.groupBy("t").agg(F.min("k").alias("lead"), F.max("k").alias("other")).where("lead <> other")
    lists = index.join(materialize(leads.select("t", "lead"), "leads"), "t")
    lists = materialize(lists.dropDuplicates(["t", "k"]), "lists")     # equal sets of several tasks
    pairs = star_pairs(lists, similar)
    if long is not None:
        pairs = pairs.unionByName(new_star_pairs(long_lists(lists, long), 0, similar).select("a", "b"))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = materialize(pairs, "pairs")
    answers = materialize(overlaps(docs, pairs, k, similar), "answers")
    comp = components(answers.where("similar").select("a", "b"))
    turn, mixed = 0, answered(mixed_lists(lists, comp), answers, similar)
    while True:     # a large group of near copies: more leaders, until few open pairs are left
        open_, rows = open_pairs(mixed)
        if open_ <= OPEN * rows:
            break
        turn += 1
        found = materialize(new_star_pairs(mixed, turn, similar), "pairs")
        links = decided(docs, found, k, similar)
        n = links.count()
        if n:
            comp = components(links.unionByName(comp.select(F.col("node").alias("a"), F.col("component").alias("b"))))
            mixed = mixed_lists(mixed, comp)
        if 64 * n <= found.count():     # leaders no longer find much, or nothing; the rest is joined
            break
    rest = cross_pairs(mixed, ids, similar).join(
        pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), ["a", "b"], "left_anti")
    links = decided(docs, materialize(rest, "pairs"), k, similar)
    if links.limit(1).count():
        comp = components(links.unionByName(comp.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    named = ids.join(comp.withColumnRenamed("node", "k"), "k", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "k", F.coalesce("component", "k").alias("component"))
    first = named.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(first, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
