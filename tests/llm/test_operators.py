"""Every operator against a brute-force version on a small corpus with awkward rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tableguard.llm import (decontaminate, fingerprints, kneser_ney, license_scan, line_dedup, mixing, ngram_join,
                            quality_cnn, repeats, url_filter)

DATA = "/root/testdata/sf0.001"
UPPER = {c: c + 32 for c in range(65, 91)}
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE = r"[^\x20\x09-\x0D]+"
LONG = "alpha beta gamma delta epsilon zeta eta theta " * 6000
EXTRA = [(9001, None), (9002, ""), (9003, "one two"), (9004, LONG), (9005, LONG + "!"), (9006, "\n\n \n"),
         (9007, "a\nb"), (9008, "Ünder the MIT License; under the mit license, CC-BY-NC 4.0"), (9009, "é" * 500),
         (9010, "Line one is here\nLine two is here\nLine three is here\nLine four is here")]
EXTRA += [(9100 + i, EXTRA[-1][1]) for i in range(5)]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").where("doc_id < 150")
    more = spark.createDataFrame(EXTRA, "doc_id long, text string")
    # extra columns whose names the operators use themselves
    names = ["source", "n_words", "size", "score", "k", "part", "n", "c", "h", "row_key", "chunks", "words", "lead", "component"]
    return (real.unionByName(more).select("doc_id", "text", *(F.lit("x").alias(c) for c in names)).repartition(3).cache())


@pytest.fixture(scope="module")
def rows(docs):
    return sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())


def low_words(text, pattern):
    return re.findall(pattern, text.translate(UPPER))


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_license_scan(docs, rows):
    got = by_id(license_scan.digest(license_scan.license_scan(docs)))
    for i, t in rows:
        w = low_words(t, WORD)
        places = [(k, label) for p, label in license_scan.PHRASES.items() for k in range(len(w))
                  if w[k:k + len(p.split())] == p.split()]
        base = sorted({x for _, x in places})
        assert (got[i].n_words, got[i].n_base, got[i].base_labels) == (len(w), len(places), ",".join(base))
        assert got[i].first_word == min((k for k, _ in places), default=None)
        found = set(base)
        for label, template in license_scan.TEMPLATES:
            own = set(low_words(template, WORD))
            if any(len(own & set(low_words(x, WORD))) / len(own) >= 0.8 for x in t.split("\n")):
                found.add(label)
        assert got[i].labels == ",".join(sorted(found)) and 0 <= got[i].score <= 1


def test_license_scan_wrapped(spark):
    """Notices wrapped over several lines, against every run of words; words far apart are no notice."""
    import textwrap
    rnd, texts, want = np.random.default_rng(2), [], []
    for label, template in license_scan.TEMPLATES:
        if len(template.split()) > 9:
            for width, mark in ((70, ""), (80, " * "), (40, "# ")):
                body = "\n".join(mark + x for x in textwrap.wrap(template, width))
                texts.append(f"/* Copyright 2020 Somebody Else\n{body}\nint main() {{ return 0; }}")
                want.append(label)
    texts.append(texts[0].replace("documentation files", 'documentation files (the "Software")'))
    want.append("mit")
    for _, template in license_scan.TEMPLATES[:8]:
        texts.append("\n".join(w + " filler" * 60 for w in template.split()))
        want.append(None)
    vocabulary = sorted({w for _, t in license_scan.TEMPLATES[1:7:2] for w in low_words(t, WORD)}) + ["x"] * 8
    texts += ["\n".join(" ".join(rnd.choice(vocabulary, 5)) for _ in range(12)) for _ in range(80)]
    texts += ["\n".join(rnd.permutation(t.split())) for _, t in license_scan.TEMPLATES for _ in range(2)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(license_scan.digest(license_scan.license_scan(df)))
    for i, t in enumerate(texts):
        w, found, best = low_words(t, WORD), set(got[i].base_labels.split(",")) - {""}, 0
        for label, template in license_scan.TEMPLATES:
            seq = low_words(template, WORD)
            most = -(-len(seq) * 10 // 8)
            blocks = [low_words(x, WORD) for x in t.split("\n")] + [w[k:k + most] for k in range(len(w))]
            names = set(low_words(license_scan.REQUIRED.get(template, ""), WORD))
            c = max(names <= set(b) and len(set(seq) & set(b)) for b in blocks) / len(set(seq))
            if c >= 0.8:
                found.add(label)
                best = max(best, c)
        assert got[i].labels == ",".join(sorted(found)), t
        assert got[i].score == (1.0 if got[i].n_base else best)
        if i < len(want):
            assert (want[i] or "") in got[i].labels.split(","), t   # a one-line CC BY-NC notice is CC BY too


def test_license_scan_needs_the_name(spark):
    lines = {"Released under the BSD License": "", "Licensed under CC BY 4.0": "", "Licensed under CC BY-SA 4.0": "",
             "SPDX-License-Identifier: GPL-2.0": "", "SPDX-License-Identifier: BSD-2-Clause": "",
             "Licensed under the Apache License, Version 1.1": "", "Released under MIT License": "mit",
             "Apache License, Version 2.0, licensed under": "apache-2", "SPDX-License-Identifier: Apache-2": "apache-2",
             "under CC BY-NC 4.0": "cc-by-nc", "SPDX-License-Identifier: BSD 3": "bsd-3", "SPDX-License-Identifier: MIT": "mit",
             "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by"}
    texts = [(x, y) for x, y in lines.items()] + [(x.replace(" ", "\n", 1), y) for x, y in lines.items()]
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(texts)], "doc_id long, text string")
    got = by_id(license_scan.digest(license_scan.license_scan(df)))
    for i, (x, y) in enumerate(texts):
        assert got[i].labels == y, x


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://a.EXAMPLE.com", "https://www.example.com/en/1", "http://example.com/en/x?y#z",
            "http://notexample.com/en/", "http://b.net/es/1", "http://b.net/ES/1", "http://x.org/a?utm_source=feed",
            "http://x.org/setup.exe", "ftp://q.net/fr/"]
    urls += [r.url for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit(1))
    got = {r.page_id: r for r in url_filter.filter_urls(pages).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path, rest = url_filter.split_url(u)
        fits = [(len(r), r, v) for v, r in url_filter.SITES
                if ("." + host).endswith("." + r.split("/")[0]) and path.startswith(r[r.index("/"):])]
        if fits:
            want = max(fits)[1:]
        else:
            hits = [(v != "block", -len(p), p, v) for v, p, _ in url_filter.PATTERNS if re.search(p, rest)]
            want = (None, min(hits)[3] if hits else "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, *want), u
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_kneser_ney_sums_to_one_and_counts(docs, rows):
    got = by_id(kneser_ney.score_documents(docs, shards=8))
    tokens = {i: low_words(t, SPACE) + ["</s>"] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    c, bi = collections.Counter(), collections.Counter()
    for i, t in tokens.items():
        if not held[i]:
            c.update(t)
            bi.update(zip(["<s>", *t], t))
    ctx, kinds, cont = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0]), collections.Counter()
    for (u, w), n in bi.items():
        ctx[u] += n
        kinds[u][min(n, 3) - 1] += 1
        cont[w] += 1
    d2 = kneser_ney.discounts([sum(n == i for n in bi.values()) for i in (1, 2, 3, 4)])
    d1 = kneser_ney.discounts([sum(n == i for n in cont.values()) for i in (1, 2, 3, 4)])
    left = sum(d1[min(n, 3)] for n in cont.values()) / len(bi)

    def lower(w):
        return max(0, cont[w] - d1[min(cont[w], 3)]) / len(bi) + left / (len(c) + 1)

    def p(u, w):
        if not ctx[u]:
            return lower(w)
        n = bi.get((u, w), 0)
        return (max(0, n - d2[min(n, 3)]) + sum(a * b for a, b in zip(d2[1:], kinds[u])) * lower(w)) / ctx[u]

    from math import log10
    assert abs(sum(lower(w) for w in c) + left / (len(c) + 1) - 1) < 1e-9
    total = sum(c.values())
    for i, t in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(x in c for x in t), total)
        assert r.base_score == pytest.approx(sum(log10((c[x] + 1) / (total + len(c) + 1)) for x in t), rel=1e-6)
        assert r.score == pytest.approx(sum(log10(p(u, w)) for u, w in zip(["<s>", *t], t)), rel=1e-6)


@pytest.mark.parametrize("max_bucket", [2000, 1])
def test_repeats(docs, rows, max_bucket):
    got = by_id(repeats.remove_repeats(docs, max_bucket=max_bucket))
    texts = [(i, t.encode()) for i, t in rows if len(t) < 50_000]
    seen = collections.Counter()
    for _, b in rows:
        b = b.encode()
        for s in range(len(b) - 199):
            seen[b[s:s + 200]] += 1
    for i, b in texts:
        covered = bytearray(len(b))
        for s in range(len(b) - 199):
            if seen[b[s:s + 200]] > 1:
                covered[s:s + 200] = b"\1" * 200
        kept = bytes(x for x, y in zip(b, covered) if not y)
        runs = sum(1 for x in bytes(covered).split(b"\0") if x)
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (len(b), sum(covered), runs)
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert got[9004].n_removed == len(LONG)


def test_repeat_groups_have_all_occurrences():
    texts = ["xxABCDEFGHyy", "zzABCDEFGHyy", "qqABCDEFGHww"]
    left, right = [t[:4][::-1].encode() for t in texts], [t[4:].encode() for t in texts]
    found = {(left[m[0]][:n][::-1] + right[m[0]][:r], tuple(sorted(m))) for n, r, m in repeats.repeat_groups(left, right, 6)}
    assert found == {(b"ABCDEFGH", (0, 1, 2)), (b"ABCDEFGHyy", (0, 1))}


def test_quality_separates_junk(spark):
    junk = [(i, f"w{i} %%% x{i} $$$ y{i} ### " * (3 + i % 4), 0) for i in range(60)]
    good = [(100 + i, f"the plain words of text {i} go on and on in lines of prose " * (1 + i % 4), 1) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in junk + good] + [(900, None), (901, "")], "doc_id long, text string")
    docs = docs.withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in junk + good] + [(5000, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = by_id(quality_cnn.digest(quality_cnn.classify(docs, labels)))
    held = [(i, q) for i, _, q in junk + good if got[i].held_out]
    assert held and all(got[i].predicted == q for i, q in held)
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == 122
    assert {r.score for r in quality_cnn.classify(docs, labels.limit(0)).collect()} == {0.5}


@pytest.mark.parametrize("options", [{}, {"head": 20, "block": 5000}])
def test_ngram_join(docs, rows, options, monkeypatch):
    if options:
        monkeypatch.setattr(ngram_join, "OPEN", 0)
    got = by_id(ngram_join.near_groups(docs, **options))
    sets = {}
    for i, t in rows:
        w = low_words(t, SPACE)
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    parent = {i: i for i in sets}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("most", [1 << 24, 300])
def test_decontaminate(docs, rows, spark, most):
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet").unionByName(spark.createDataFrame(
        [(7001, "One, TWO"), (7002, None), (7003, " .. "), (None, "line three")], "item_id long, text string"))
    got = by_id(decontaminate.digest(decontaminate.decontaminate(docs.select("doc_id", "text", "n_words"), bench, max_block_bytes=most)))
    windows = []
    for r in bench.collect():
        w = low_words(r.text or "", WORD)
        windows += [(r.item_id, w[j:j + 10]) for j in range(max(1, len(w) - 9))] if w else []
    for i, t in rows:
        if len(t) > 50_000:
            continue
        w, hit, items = low_words(t, WORD), set(), set()
        at = collections.defaultdict(list)
        for k, x in enumerate(w):
            at[x].append(k)
        for item, win in windows:
            for k in at[win[0]]:
                if w[k:k + len(win)] == win:
                    hit.update(range(k, k + len(win)))
                    items.add(item)
        names = sorted(str(x) for x in items if x is not None)
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].contaminated) == (len(w), len(hit), len(names), bool(hit))
        assert got[i].items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()


def test_decontaminate_takes_patterns_from_written_blocks(spark):
    bench = spark.createDataFrame([(i, f"w{i} x{i} y{i}") for i in range(400)] + [(3, "w3 x3 y3"), (900, "w3 x3 y3")], "item_id long, text string")
    files = decontaminate.pattern_files(bench, 10, 1000)
    assert 10 < len(files) < 60 and len(set(files)) == len(files)
    docs = spark.createDataFrame([(1, "a w3 x3 y3 b W399 x399, y399"), (2, "w3 x4 y3"), (3, None)], "doc_id long, text string")
    got = by_id(decontaminate.decontaminate(docs, bench, max_block_bytes=1000))
    assert got[1].words == [1, 2, 3, 5, 6, 7] and got[1].items == ["3", "399", "900"]
    assert [got[i].items for i in (2, 3)] == [[], []]


def test_decontaminate_offsets(spark):
    docs = spark.createDataFrame([(1, "Ünder, ONE   two. x")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert decontaminate.decontaminate(docs, bench).first().spans == [[7, 16]]


def test_line_dedup(docs, rows):
    got = {r.doc_id: r for r in line_dedup.line_dedup(docs).collect()}
    five = [got[i] for i in [9010, *range(9100, 9105)]]
    assert five[0].text == EXTRA[9][1] and five[0].removed_lines == 0
    assert len({(r.text, r.removed_lines, r.removed_chunks) for r in five[1:]}) == 1 and five[1].removed_lines >= 2
    assert got[9001].text is None and got[9002].text == "" and got[9001].n_lines == 0
    for i, t in rows:
        kept = (got[i].text or "").split("\n")
        lines = iter(t.split("\n"))
        assert all(any(x == y for y in lines) for x in kept) or got[i].text in ("", None)   # a subsequence of lines


def test_line_passages(spark):
    """Planted passages of 2, 3, 4 and 8 lines go whole, and every line stays somewhere."""
    rnd, made, planted = np.random.default_rng(3), [], {}

    def some(n):
        return [f"line {rnd.integers(1 << 60)}" for _ in range(n)]

    for k in range(200):
        passage = some((2, 3, 4, 8)[k % 4])
        planted[2 * k + 1] = before, after = some(rnd.integers(1, 6)), some(rnd.integers(1, 6))
        made += [(2 * k, "\n".join(some(rnd.integers(0, 4)) + passage + some(rnd.integers(0, 4)))),
                 (2 * k + 1, "\n".join(before + passage + after))]
    awkward = [(500, "x\nx\nx\nx"), (501, "x\nx\nx"), (502, "u\nv"), (503, "u\nv\nw"), (504, "u\nv\nw\nz"), (505, "u"),
               (506, None), (507, "")]
    df = spark.createDataFrame(made + awkward, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in line_dedup.line_dedup(df, passages=True).collect()}
    for i, t in made:
        assert got[i].text == ("\n".join(sum(planted[i], [])) if i in planted else t)
    assert [got[i].text for i, _ in awkward] == ["x\nx", "", "u\nv", "w", "z", "u", None, ""]
    assert [got[i].removed_lines for i, _ in awkward] == [2, 3, 0, 2, 3, 0, 0, 0]
    lines = {x for _, t in made + awkward if t for x in t.split("\n")}
    assert lines <= {x for r in got.values() if r.text for x in r.text.split("\n")}
    staged = {r.doc_id: r.text for r in P.lines(spark, df.withColumn("n_chars", F.length("text").cast("long")), "").collect()}
    assert all(staged[i] == got[i].text for i in planted)


def test_fingerprints(docs, rows):
    got = by_id(fingerprints.fingerprints(docs))
    order = sorted(rows, reverse=True)
    for n, (i, t) in enumerate(order):
        after, half = order[(n + 1) % len(order)][1], len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        s = fingerprints.sketch([t.encode(), edited.encode(), after.encode()])
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (fingerprints.hexed(s[0]), fingerprints.hexed(s[1]))
        assert got[i].near_next == pytest.approx(fingerprints.likeness(s[0], s[2]))
    one = docs.where("doc_id = 9003")
    assert fingerprints.fingerprints(one).first().near_next == 1.0


def test_parse_is_locally_consistent():
    import random
    pick = random.Random(3)
    inner = bytes(pick.choice(b"abcdefgh ") for _ in range(600))
    first = np.zeros(1, np.int64)
    a, b = (fingerprints.parse(np.frombuffer(x, np.uint8), first)[0] for x in (inner, b"other start " + inner))
    assert len(set(a.tolist()) & set(b.tolist())) >= 0.9 * len(set(a.tolist()))


def test_mixing(spark):
    rows = [(i, f"s{i % 3}" if i % 7 else None, "w " * (i % 11)) for i in range(300)] + [(500, "empty", None), (7, "s1", "w " * 7)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("target", F.lit(1))
    placed = mixing.schedule(docs)
    got = placed.collect()
    total = sum(len(t.split()) for _, _, t in rows if t)
    by = collections.defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert 0 <= r.taken <= 3 * r.size
    assert sum(by[s][0].target for s in by) == pytest.approx(total)
    for s, own in by.items():
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1 and own[0].target <= 3 * own[0].source_size
    entries = mixing.mix(placed).collect()
    assert [e.finish for e in entries] == sorted(e.finish for e in entries) and entries[-1].finish <= 1 + 1e-9
    assert sum(e.pass_words for e in entries) == sum(r.taken for r in got)


def test_bigram_counts_beyond_32_bits(tmp_path):
    keys = np.array([5, 7, 1 << 40], np.uint64)
    for most in ((1 << 32) - 1, (1 << 32) + 7):
        counts = np.array([1, most, 3], np.int64)
        batch = pa.RecordBatch.from_pydict({"k": pa.array(keys.view(np.int64)), "c": pa.array(counts), "shard": pa.array([0, 0, 0])})
        row = next(kneser_ney._writer(str(tmp_path), 1)([batch])).to_pylist()[0]
        assert kneser_ney.load_counts(row["counts"], 3).tolist() == counts.tolist()
        assert (row["n1"], row["n3"]) == (1, 1)


def test_quality_training_rows_are_settled(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)] + [(3, "a text")] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(8, 1), (9, 0), (3, 1), (3, 1), (None, 1)], "doc_id long, quality int")
    used = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 and i not in (8, 9)]
    want = [((b"a text" if i == 3 else b"text %d" % i), i % 2) for i in used]
    assert quality_cnn.training_rows(docs, labels) == want
    assert len(quality_cnn.training_rows(docs, labels.repartition(7), rows_per_class=4)) == 8


def test_empty_tables(docs, spark):
    none = docs.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    for df in (license_scan.license_scan(none), kneser_ney.score_documents(none, shards=2), repeats.remove_repeats(none),
               quality_cnn.classify(none, labels), ngram_join.near_groups(none), decontaminate.decontaminate(none, items),
               line_dedup.line_dedup(none), fingerprints.fingerprints(none), mixing.schedule(none)):
        assert df.count() == 0
    assert decontaminate.decontaminate(docs.select("doc_id", "text"), items).where(F.size("words") > 0).count() == 0


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "p q r s t u v w"), (None, None), (4, "p q r s t u v w"), (4, "p q r s t u v w"), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit(None).cast("string"))
    for df in (license_scan.license_scan(docs), kneser_ney.score_documents(docs, shards=2), repeats.remove_repeats(docs),
               ngram_join.near_groups(docs), line_dedup.line_dedup(docs), fingerprints.fingerprints(docs), mixing.schedule(docs)):
        assert df.count() == len(rows)
    groups = ngram_join.near_groups(docs).collect()
    assert sorted(r.component_id for r in groups if r.n_shingles) == [4, 4, 4]
