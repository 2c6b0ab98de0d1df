"""Source divergence against plain counting in Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tableguard.llm import source_divergence as D


def brute(rows, least=30, top=50):
    """rows (lang, source, text) -> set of result rows."""
    documents, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        documents[lang].update(set(terms))
        counts[lang, source].update(terms)
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in documents[lang].items() if n >= least]
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def p(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}
        q, of = p(whole), {s: p(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(of[s][t] - of[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            out |= {(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(sorted(pairs))}
            used = [(q[t] - of[s][t], t.encode(), t) for t in kept if counts[lang, s][t] > 0 and of[s][t] > q[t]]
            out |= {(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(sorted(used)[:top])}
    return out


def got(df, **options):
    found = [tuple(r) for r in D.audit(df, **options).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(found) == len(set(found))
    return set(found)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 3, 4) for r in rows],
                                 "lang string, source string, text string, term string, n int, total int")


def corpus(seed, n):
    rng = np.random.default_rng(seed)
    words = np.array([*(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)), "Émile", "x1y", "ÉCOLE", "naïve", "日本"])
    rows = [("en" if i % 3 else "fr", f"s{min(9, int(rng.geometric(0.4)))}", " ".join(words[np.minimum(rng.zipf(1.3, 40) - 1, 304)])) for i in range(n)]
    return rows + [(None, None, None), (None, "a", "alone"), ("", "b", ""), ("de", "only", "ein wort"), ("fr", "empty", None), ("fr", "empty", "")]


@pytest.mark.parametrize("options", [{}, {"block_terms": 7, "dense": 1}, {"block_terms": 50, "dense": 3}, {"dense": 10_000}])
def test_against_brute_force(spark, options):
    rows = corpus(3, 400)
    assert got(frame(spark, rows), min_documents=4, top=9, **options) == brute(rows, 4, 9)


def test_flushes_of_counts(spark, monkeypatch):
    rows = corpus(4, 200)
    df = frame(spark, rows).repartition(3)
    assert got(df, min_documents=1) == brute(rows, 1)
    found = D.term_counts(df)
    assert found.where("term IS NULL").count() > 0


def test_ties_no_terms_and_empty_table(spark):
    rows = [("x", s, "same words") for s in ("b", "a", "é", "Z")] * 30
    assert got(frame(spark, rows)) == brute(rows)
    few = [("x", s, f"{s} rare") for s in "abc"]
    assert {(r[3], r[4]) for r in got(frame(spark, few))} == {("a", 0), ("b", 0), ("c", 0)}
    assert got(frame(spark, rows).limit(0)) == set()


def test_large_counts_are_exact():
    """Numerators beyond 64 bits."""
    rng = np.random.default_rng(0)
    a, b = (rng.integers(0, 1 << 40, 100) * (rng.random(100) < 0.7) for _ in range(2))
    na, nb = int(a.sum()) + 500, int(b.sum()) + 500
    p = lambda c, n: 1 + 1_000_000_000 * (int(c) + 5) // n
    want = sum(abs(p(x, na) - p(y, nb)) for x, y in zip(a, b))
    for dense in (1, 2, 200):
        assert D.distance(D.Levels(a, na, dense), D.Levels(b, nb, dense)) == want


def test_probability_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    row = spark.range(1).select(D.probability(F.lit(2 ** 61), F.lit(2 ** 62), F.lit(1000)).alias("p")).first()
    assert row.p == 1 + 1_000_000_000 * (2 ** 61 + 5) // (2 ** 62 + 5000)
