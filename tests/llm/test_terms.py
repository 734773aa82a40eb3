"""Ranked search, source divergence and license scans against brute force."""

import itertools
import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from care_analytics.llm import divergence, licenses, ranked
from care_analytics.llm.common import prepare
from tests.llm.conftest import ODD

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def found(pattern, text):
    return pattern.findall((text or "").translate(ASCII_LOWER))


# ranked search -----------------------------------------------------------
def searched(docs, items, k):
    words = [(i, found(ALNUM, t)) for i, t in docs]
    n_docs, total = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    out = []
    for item, text in set(items):
        hits = []
        for i, own in words:
            tf, m = Counter(own), 50 + 50 * len(own) * n_docs // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m))
                        for t in set(found(ALNUM, text)) if tf[t])
            if score > 0:
                hits.append((-score, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(hits)[:k], 1)]
    return Counter(out)


ITEMS = [(1, "a b zebra"), (1, "a b zebra"), (1, "one TWO"), (2, None), (3, ""), (None, "日本語 é"), (4, "x" * 30_000 + " don't"), (5, "absent"), (6, "½ Ⅷ 😀 stop the"), (7, " ".join(f"w{k}" for k in range(60)))]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_ranked_search_odd_rows(odd, spark, none, k):
    items = spark.createDataFrame([(i, t, 7) for i, t in ITEMS], "item_id long, text string, rank int")
    got = ranked.ranked_search(odd, items, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == searched(ODD, ITEMS, k)
    assert ranked.ranked_search(none, items, k).count() == 0 and ranked.ranked_search(odd, items.where("item_id > 99"), k).count() == 0


@pytest.fixture(scope="module")
def skewed():
    """Frequent and rare words, many equal texts, in an order that mixes long and short ones."""
    r = random.Random(3)
    texts = [" ".join(r.choices([f"w{k}" for k in range(60)], [1 / (k + 1) for k in range(60)], k=r.choice([1, 4, 30, 200]))) for _ in range(500)]
    texts[100:260] = ["w0 w1 w50"] * 160
    return [(i if i % 7 else None, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("k", [1, 10, 200])
def test_search_blocks_and_ties(spark, skewed, monkeypatch, k):
    # many document blocks a task and an item block for each item
    monkeypatch.setattr(ranked, "QUERY_BYTES", 8)
    monkeypatch.setattr(ranked, "BLOCK_BYTES", 3000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    items = [(9, "w0 w59 w58"), (8, "w50"), (7, " ".join(f"w{j}" for j in range(60)))]
    docs = spark.createDataFrame(skewed, "doc_id long, text string").repartition(3)
    got = ranked.ranked_search(docs, spark.createDataFrame(items, "item_id long, text string"), k).collect()
    prepare(spark)
    assert Counter(map(tuple, got)) == searched(skewed, items, k)


def test_limited_accumulators_lose_no_document():
    r, limited = np.random.default_rng(4), 0
    for trial in range(200):
        n, k = int(r.integers(1, 80)), int(r.integers(1, 12))
        found_terms = []
        for _ in range(int(r.integers(1, 9))):
            at = np.sort(r.choice(n, int(r.integers(1, n + 1)), replace=False))
            found_terms.append((at, r.integers(0, r.choice([2, 20, 1000]), len(at))))
        total = np.zeros(n, np.int64)
        for at, add in found_terms:
            total[at] += add
        docs, scores = ranked.accumulate(found_terms, n, k, 0)
        assert (scores == total[docs]).all()
        limited += len(docs) < (total > 0).sum()
        best = sorted(((-s, d) for d, s in enumerate(total.tolist()) if s > 0))[:k]
        assert sorted(((-s, d) for d, s in zip(docs.tolist(), scores.tolist())))[:k] == best
    assert limited > 20  # the limit was reached


# source divergence ---------------------------------------------------------
def diverged(rows, least=3, top=200):
    rows = [(a or "", b or "", found(LETTERS, t)) for a, b, t in rows]
    out = []
    for lang in {a for a, _, _ in rows}:
        own = [(b, w) for a, b, w in rows if a == lang]
        df = Counter(t for _, w in own for t in set(w))
        kept = sorted(t for t in df if df[t] >= least)
        count = defaultdict(Counter)
        for b, w in own:
            count[b].update(t for t in w if df[t] >= least)

        def shares(c):
            total = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        def f(p, q):
            return (p - q) ** 2 // q

        q = shares(sum(count.values(), Counter()))
        p = {b: shares(count[b]) for b in {b for b, _ in own}}
        for b in p:
            pairs = [(-sum(f(p[b][t], p[x][t]) for t in kept), x) for x in p if x != b]
            words = [(-f(p[b][t], q[t]), t) for t in kept if count[b][t] and p[b][t] > q[t]]
            out += [(lang, b, "pair", x, -v, r) for r, (v, x) in enumerate(sorted(pairs, key=lambda y: (y[0], y[1].encode())), 1)]
            out += [(lang, b, "term", x, -v, r) for r, (v, x) in enumerate(sorted(words, key=lambda y: (y[0], y[1].encode()))[:top], 1)]
    return Counter(out)


def source_rows():
    r = random.Random(6)
    # up to eight, sixteen and more bytes; shared beginnings; letters beyond ASCII
    words = ["a", "A", "ab", "abcdefgh", "abcdefghi", "abcdefghijklmnop", "abcdefghijklmnopq", "abcdefghijklmnopr", "é" * 4, "é" * 8, "é" * 9, "日本" * 40, "日本" * 40 + "z", "x" * 5000, "Zeé", "ﬀ"]
    rows = [(r.choice(["en", "fr", None]), r.choice(["s1", "s2", "s2", "s3", "", None]), " ".join(r.choices(words, k=r.randrange(30))) + r.choice(["", "1", "\n", "'s"])) for _ in range(120)]
    return rows + [("en", "void", None), ("en", "blank", " 12 "), ("xx", "only", "rare words"), ("xx", "other", ""), ("yy", "alone", "z z z")] + [("en", "s1", "a ab")] * 3


@pytest.mark.parametrize("least,top", [(3, 200), (1, 2)])
def test_source_divergence(spark, monkeypatch, least, top):
    rows = source_rows()
    frame = spark.createDataFrame([(*x, 5, "c") for x in rows], "lang string, source string, text string, rank int, item string")
    expected = diverged(rows, least, top)
    for chunk, pair_rows in ((16 << 20, 1 << 18), (2000, 7)):
        monkeypatch.setattr(divergence, "CHUNK_BYTES", chunk)
        monkeypatch.setattr(divergence, "PAIR_ROWS", pair_rows)
        got = divergence.source_divergence(frame.repartition(3), least, top)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert Counter(map(tuple, got.collect())) == expected
    assert divergence.source_divergence(frame.where("rank > 5")).count() == 0


def test_runs_of_terms():
    r = random.Random(2)
    words = ["".join(r.choices("ab", k=r.choice([1, 7, 8, 9, 15, 16, 17, 33]))) for _ in range(3000)] + ["a" * 100, "a" * 128, "a" * 129] * 2
    group = np.sort(np.random.default_rng(1).integers(0, 4, len(words)))
    doc = np.arange(len(words)) // 3
    data = np.frombuffer("".join(words).encode(), np.uint8)
    bounds = np.cumsum([0, *map(len, words)])
    group = np.maximum.accumulate(group)[doc * 3]  # a document has one group
    index, n, docs = divergence.term_runs(data, bounds, group, doc)
    expected = {(w, g): (len(x), len({d for _, _, d in x})) for (w, g), x in (
        (key, list(rows)) for key, rows in itertools.groupby(sorted(zip(words, group.tolist(), doc.tolist())), key=lambda y: y[:2]))}
    assert len(index) == len(expected)
    assert {(words[i], int(group[i])): (a, b) for i, a, b in zip(index.tolist(), n.tolist(), docs.tolist())} == expected


def test_chunks_are_sorted_in_small_parts(monkeypatch):
    r = random.Random(9)
    words = ["".join(r.choices("abcdefgh", k=r.randrange(1, 20))) for _ in range(4000)]

    def batch(n):
        rows = [(r.choice(["en", "fr"]), r.choice(["s1", "s2", "s3", ""]), " ".join(r.choices(words, k=r.randrange(200)))) for _ in range(n)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["lang", "source", "text"])

    def summed(batches):
        n, docs = Counter(), Counter()
        for out in divergence.count_terms(iter(batches)):
            for row in out.to_pylist():
                key = row["lang"], row["source"], row["term"]
                n[key] += row["n"]
                docs[key] += row["docs"]
        return n, docs

    batches = [batch(300), batch(1), batch(200)]
    n, docs = Counter(), Counter()
    for b in batches:
        for row in b.to_pylist():
            own = Counter(row["text"].split())
            n.update({(row["lang"], row["source"], w): k for w, k in own.items()})
            docs.update((row["lang"], row["source"], w) for w in own)
    assert summed(batches) == (n, docs)
    for chunk, part, out_rows in ((50_000, 3000, 7), (1, 1, 1), (1 << 20, 20_000, 1000)):
        for name, value in (("CHUNK_BYTES", chunk), ("PART_BYTES", part), ("OUT_ROWS", out_rows)):
            monkeypatch.setattr(divergence, name, value)
        assert summed(batches) == (n, docs)
    monkeypatch.undo()

    # the sort takes room for a part, not for the chunk
    batches = [batch(1000) for _ in range(20)]
    tracemalloc.start()
    for out in divergence.count_terms(iter(batches)):
        assert out.num_rows <= 1 << 15
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(b.nbytes for b in batches) > 18 << 20
    assert peak < 64 << 20


def test_shares_beyond_64_bits(spark):
    rows = spark.createDataFrame([(10**13, 3 * 10**13), (0, 7), (0, 0)], "n long, total long")
    from pyspark.sql import functions as F
    got = [r[0] for r in rows.select(divergence.share(F.col("n"), F.col("total"))).collect()]
    assert got == [1 + 10**9 * (10**13 + 1) // (3 * 10**13), 1 + 10**9 // 7, None]


# license scans -------------------------------------------------------------
def scanned(text, templates, phrases, percent):
    words = found(ALNUM, text)
    places = sorted((label, k) for label, p in phrases for q in [found(ALNUM, p)] for k in range(len(words)) if words[k:k + len(q)] == q)
    blocks = []
    for label, template in templates:
        own = found(ALNUM, template)
        for k in range(0, len(words), len(own)):
            same = len(set(words[k:k + 2 * len(own)]) & set(own))
            if 100 * same >= percent * len(set(own)):
                blocks.append((label, k, same, len(set(own))))
    return len(words), places, sorted(blocks)


@pytest.mark.parametrize("percent", [100, 80, 30, 1])
def test_license_blocks(spark, percent):
    r = random.Random(9)
    templates = [("x", "one two three four five six seven"), ("y", "five six"), ("x", "one one one"), ("z", "é ß TWO two ten")]
    phrases = [("p", "one two"), ("q", "two two one"), ("p", "seven")]
    words = ["one", "two", "Three", "four", "five", "six", "SEVEN", "é", "ß", "ten", "other", "words", "in", "between"]
    texts = [" ".join(r.choices(words, k=r.choice([0, 1, 2, 6, 15, 90]))) for _ in range(150)]
    rows = [*ODD, *((100 + i, t) for i, t in enumerate(texts)), (400, templates[0][1]), (401, "x " * 13 + templates[0][1] + " x" * 9), (402, "one\ntwo,three-four_five 'six' seven.")]
    frame = spark.createDataFrame([(i, t, "l") for i, t in rows], "doc_id long, text string, labels string").repartition(3)
    got = Counter((x["doc_id"], x["n_words"], *(tuple(sorted(map(tuple, x[c]))) for c in ("places", "blocks")))
                  for x in licenses.license_scan(frame, templates, phrases, percent).collect())
    expected = Counter((i, n, tuple(p), tuple(b)) for i, t in rows for n, p, b in [scanned(t, templates, phrases, percent)])
    assert got == expected and any(b for *_, b in got)


def test_license_digest(spark, none):
    text = "Intro. Released under the  MIT License! " + "and so on " * 40 + "it is licensed under the GNU-General public LICENSE; version 3. CC BY"
    rows = [(1, text), (2, None), (3, ""), (None, "mit license"), (5, "Licensed under C.C. BY NC 4.0"), (6, "released under the license of MIT"), (7, "gnu general public licenses")]
    got = {r["doc_id"]: r for r in licenses.license_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["base_labels"] == "cc-by,gpl,mit" and got[1]["labels"] == "cc-by,gpl,gpl-3,mit" and (got[1]["n_base"], got[1]["first_word"], got[1]["score"]) == (3, 4, 1.0)
    assert all((got[i]["n_words"], got[i]["n_base"], got[i]["first_word"], got[i]["base_labels"], got[i]["labels"], got[i]["score"]) == (0, 0, None, "", "", 0.0) for i in (2, 3))
    assert got[None]["labels"] == "mit" and got[6]["base_labels"] == "" and got[6]["labels"] == "mit" and got[6]["score"] == 1.0
    assert got[7]["labels"] == "" and got[7]["score"] == 0.0
    assert licenses.license_digest(none).count() == 0
    with pytest.raises(ValueError):
        licenses.license_scan(none, [("empty", " .. ")])


def test_a_template_is_found_at_every_offset():
    words = [f"t{k}" for k in range(9)]
    template = np.arange(9)
    for at in range(40):
        number = np.full(60, -1)
        number[at:at + 9] = template
        first = np.array([0, 5, 5, 60]) if at >= 5 else np.array([0, 60])
        assert any(o == 9 for _, _, o in licenses.block_matches(number, first, template, len(words), 8)), at


def test_word_spans_merge_text_ends_without_a_pass_over_all_words(monkeypatch):
    from care_analytics.llm import words
    rng = np.random.default_rng(5)
    seen = []
    for name in ("unique", "union1d"):
        def counted(*arrays, _of=getattr(np, name), **more):
            seen.append(max(len(a) for a in arrays))
            return _of(*arrays, **more)
        monkeypatch.setattr(words.np, name, counted)
    for size, texts in ((0, 3), (1, 1), (50, 30), (4000, 60), (4000, 1)):
        data = rng.choice(np.frombuffer(b"abc  ", np.uint8), size)
        offsets = np.concatenate([[0], np.sort(rng.integers(0, size + 1, texts - 1)), [size]]).astype(np.int64)
        starts, ends, first = words.spans(data, offsets)
        found = [[(a + m.start(), a + m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", data[a:b].tobytes())]
                 for a, b in itertools.pairwise(offsets.tolist())]
        assert list(zip(starts.tolist(), ends.tolist())) == [x for f in found for x in f]
        assert first.tolist() == [0, *itertools.accumulate(map(len, found))]
        assert all(n <= texts for n in seen)
