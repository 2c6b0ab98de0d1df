"""Block skipping and derived answers of the similarity join, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableguard.llm import ngram_join as J


@pytest.mark.parametrize("similar", [80, 50, 95])
def test_blocks_lose_no_reachable_pair(spark, similar):
    """Every pair of index rows that passes the size and place filter meets in exactly one block."""
    rng = np.random.default_rng(similar)
    sizes = [*range(1, 40), 125, 15625, 9765625, 1 << 30, *map(int, rng.integers(1, 4000, 160))]
    rows = [(i, n, int(rng.integers(0, J.prefix_size(n, similar)))) for i, n in enumerate(sizes)]
    at = spark.createDataFrame(rows, "i int, n int, pos int").withColumn("of", J.size_block(F.col("n"), similar))
    bounds = J.size_bounds(similar)
    assert all(bounds[r.of.size] <= r.n <= r.of.largest == bounds[r.of.size + 1] - 1 for r in at.collect())
    a = at.select(F.col("i").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"),
                  F.explode(J.met_blocks(F.col("of"), F.col("n"), F.col("pos"), similar)).alias("block"))
    b = at.select(F.col("i").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"),
                  J.own_block(F.col("of"), F.col("pos"), similar).alias("block"))
    met = [(r.a, r.b) for r in a.join(b, "block").where("na < nb OR na = nb AND a < b").select("a", "b").collect()]

    def reach(x, y):
        (_, nx, px), (_, ny, py) = rows[x], rows[y]
        need = -(-similar * (nx + ny) // (100 + similar))
        return 100 * min(nx, ny) >= similar * max(nx, ny) and min(nx - px, ny - py) >= need

    ordered = [(x, y) for x in range(len(rows)) for y in range(len(rows)) if (rows[x][1], x) < (rows[y][1], y)]
    wanted = {p for p in ordered if reach(*p)}
    assert len(met) == len(set(met)) and wanted and wanted <= set(met)
    by_size = [p for p in ordered if 100 * rows[p[0]][1] >= similar * rows[p[1]][1]]
    if similar == 80:       # blocks skip by place too, not by size alone
        assert len(set(met) & set(by_size)) < len(by_size)


def test_derived_answers_hold(spark):
    """Whatever the leader's answers decide is so; where an overlap is missing nothing is decided."""
    rng, rows = np.random.default_rng(3), []
    for _ in range(3000):
        lead = set(range(int(rng.integers(3, 40))))
        x, y = ({v for v in lead if rng.random() < rate} | set(map(int, rng.integers(100, 110, int(rng.integers(0, 6)))))
                for rate in rng.choice([0.5, 0.8, 0.95, 1.0], 2))
        rows.append((len(x), len(y), len(x & lead), len(y & lead), len(lead), len(x & y)))
    rows.append((5, 5, None, 5, 5, 5))
    sure, never = J.derived(80)
    got = spark.createDataFrame(rows, "na long, nb long, oa long, ob long, ln long, o long").select(
        "*", sure.alias("sure"), never.alias("never")).collect()
    link = lambda r: 100 * r.o >= 80 * (r.na + r.nb - r.o)
    assert all(link(r) for r in got if r.sure) and not any(link(r) for r in got if r.never)
    assert sum(r.sure for r in got) > 100 and sum(r.never for r in got) > 100
    assert not any(r.sure or r.never for r in got if r.oa is None)


def sets_linked(rows):
    sets = {i: {tuple(w[j:j + 5]) for j in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in rows)}
    parent = {i: i for i in sets}

    def root(x):
        return x if parent[x] == x else root(parent[x])
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("open_, long", [(0, None), (10 ** 9, None), (0, 3)])
def test_variants_around_the_threshold(spark, monkeypatch, open_, long):
    """Families of texts whose members are a little above and a little below the threshold to each other, so that
    lists stay mixed; with no further leader, with some, and with several from the start."""
    monkeypatch.setattr(J, "OPEN", open_)
    rng, rows = np.random.default_rng(11), []
    for family in range(12):
        base = [f"f{family}w{i}" for i in range(int(rng.integers(30, 120)))]
        for member in range(14):
            w = list(base)
            for _ in range(int(rng.integers(0, 5))):
                w[int(rng.integers(len(w)))] = f"x{rng.integers(1 << 30)}"
            rows.append((100 * family + member, " ".join(w[:int(len(w) * rng.uniform(0.8, 1))])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in J.near_groups(docs, long=long).collect()}
    assert got == sets_linked(rows) and len(set(got.values())) > 20
