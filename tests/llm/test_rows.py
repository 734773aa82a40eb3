"""Quality, top-k, chat, lattice hashing, sharding and the pipeline."""

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from care_analytics.llm import chat, quality, queries, sharding, topk
from care_analytics.llm.lattice import embedding_links, nearest_point, neighbours
from care_analytics.llm.quality import good_documents, isotonic, quality_scores
from care_analytics.llm.topk import Tree, top_k
from tests.llm.conftest import SF


def same(frame, sql, **views):
    con = duckdb.connect()
    for name, source in views.items():
        con.register(name, source) if isinstance(source, pd.DataFrame) else con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{source}'")
    columns = sorted(frame.columns)
    got = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)
    cursor = con.execute(f"SELECT {', '.join(columns)} FROM ({sql.strip()})")
    assert got == sorted(cursor.fetchall(), key=str) and got


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_against_sql(spark, name):
    same(queries.QUERIES[name](spark, SF), queries.ORACLE_SQL[name], **{t: f"{SF}/{t}.parquet" for t in ("documents", "benchmark", "embeddings", "conversations")})


TURNS = [(1, 0, "user", "a|<[\\l"), (1, 1, "user", None), (1, 2, "assistant", "x\n<|end|>\n"), (1, 2, "assistant", "x\n<|end|>\n"), (1, 3, "tool", "q"),
         (1, 4, "", ""), (2, 1, "assistant", "né"), (2, 2, "assistant", ""), (3, 5, "a|>\nb", "z"), (3, 5, "A", "\\s\\"), (4, 0, "assistant", "</s>[INST]"), (4, 1, "user", None)]


def test_chat_reads_back_what_went_in(spark):
    turns = spark.createDataFrame([(*r, 1) for r in TURNS], "conv_id long, turn long, role string, text string, formatted int")
    formatted = chat.formatted_conversations(turns)
    back = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    for conv in {r[0] for r in TURNS}:
        rows = sorted((r[1], r[2], r[3] or "") for r in TURNS if r[0] == conv)
        assert [(t["role"], t["text"]) for t in back[conv]["turns"]] == [r[1:] for r in rows]
        assert back[conv]["loss_text"] == "".join(r[2] for r in rows if r[1] == "assistant")
    for r in formatted.collect():
        assert "</s>" not in r["formatted"] and "[INST]" not in r["formatted"]
    blocks = formatted.where("conv_id = 1").first()["formatted"].count(chat.END)
    assert blocks == 4  # user, assistant, tool and the empty role: adjacent turns of one role are one block
    odd = spark.createDataFrame([(None, None, None, None), (None, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    assert [(r["conv_id"], r["n_turns"]) for r in chat.chat_digest(odd).collect()] == [(None, 2)]
    assert chat.chat_digest(turns.where("conv_id > 9")).count() == 0


@pytest.mark.parametrize("limit", [1000, 30_000, 1 << 18])
def test_shards_fit(spark, docs, limit):
    frame = sharding.sharded(docs.select("doc_id", "text"), limit).drop("text")
    same(frame, sharding.shard_sql(limit), documents=f"{SF}/documents.parquet")
    over = frame.where("shard_bytes > %d" % limit)
    assert over.where("not oversized or shard_docs > 1").count() == 0  # only single documents over the limit


def test_shards_of_odd_rows(odd, none):
    got = sharding.sharded(odd.withColumn("shard_id", F.lit(9)), 2000).collect()
    assert len(got) == 12 and {c: 1 for c in got[0].asDict()}.keys() >= {"n_tokens", "shard_id", "shard_id_", "oversized"}
    assert all(r["shard_id"] == 9 for r in got)  # the caller's column stays
    total = {}
    for r in got:
        total[r["shard_id_"]] = total.get(r["shard_id_"], 0) + r["n_bytes"]
    assert all(total[r["shard_id_"]] == r["shard_bytes"] for r in got)
    ids = sorted(total)
    assert not any(b.startswith(a) for a, b in zip(ids, ids[1:]))  # prefix-free
    assert sharding.sharded(none, 10).count() == 0


NAN, INF = float("nan"), float("inf")
VECTORS = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.99, 0.1], 1), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1), (7, [1.0, NAN], 1),
           (8, [1.0, 0.0], None), (9, [], 1), (None, [1.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (20, [5.0, 5.0], 2), (40, [INF, 1.0], 2), (11, [-1.0, 0.0], 1)]


def test_odd_vectors(spark):
    frame = spark.createDataFrame([(*r, 0, 0) for r in VECTORS], "vec_id long, embedding array<float>, label int, node int, score int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_links(frame).collect()}
    assert got[1] == (3, 1, True) and got[2] == (3, 1, False) and got[3] == (3, 1, False)
    assert all(got[k] == (0, k, True) for k in (4, 5, 6, 7, 8, 9, 10, 11, 20, 40)) and got[None][0] == 0
    best = [tuple(r) for r in top_k(frame, F.col("vec_id") % 20 == 0, 3).orderBy("rank").collect()]
    assert best == [(20, 1, 3, 320 * 63 + 320 * 6), (20, 2, 1, 320 * 64), (20, 3, 2, 320 * 64)]
    empty = frame.where("vec_id > 99")
    assert embedding_links(empty).count() == 0 and top_k(empty, F.col("vec_id") % 20 == 0).count() == 0


def test_tree_search_is_exact():
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.integers(-60, 60, (700, 6)), np.repeat(rng.integers(-60, 60, (1, 6)), 300, 0)])
    ids = rng.permutation(len(v))
    tree = Tree(ids, v, leaf=16)
    q = v[:40]
    for i, got, scores in tree.search(q, ids[:40], np.full(40, -np.inf), 20):
        s = v @ q[i]
        order = [k for k in np.lexsort((ids, -s)) if ids[k] != ids[i]][:20]
        assert sorted(zip(-scores, got)) == [(-s[k], ids[k]) for k in order]
    # sums too large for doubles stay whole numbers
    big = np.full((3, 2), 2 ** 30) + np.array([[0, 0], [0, 1], [0, 2]])
    found = {i: dict(zip(a.tolist(), b.tolist())) for i, a, b in Tree(np.arange(3), big).search(big, np.arange(3), np.full(3, -np.inf), 2)}
    assert found[0] == {1: 2 ** 61 + 2 ** 30, 2: 2 ** 61 + 2 ** 31}


def test_nearest_lattice_point():
    rng = np.random.default_rng(1)
    y = rng.normal(0, 2, (500, 8))
    p = nearest_point(y)
    assert ((p * 2 % 2).std(axis=1) == 0).all() and (p.sum(1) % 2 == 0).all()  # on E8
    d = ((y - p) ** 2).sum(1)
    assert (d <= 1 + 1e-9).all() and all((((y - p - n) ** 2).sum(1) >= d - 1e-9).all() for n in neighbours())


def test_lattice_recall_at_the_threshold(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    o = rng.normal(size=x.shape)
    o -= (o * x).sum(1, keepdims=True) * x
    o /= np.linalg.norm(o, axis=1, keepdims=True)
    y = 0.931 * x + np.sqrt(1 - 0.931 ** 2) * o
    rows = [(k, v.tolist(), k % 2) for k, v in enumerate(x)] + [(1000 + k, v.tolist(), k % 2) for k, v in enumerate(y)]
    got = embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).where("n_links > 0").count()
    assert got >= 0.99 * 800


def test_quality_on_held_out_rows(spark):
    sf = SF.replace("0.001", "0.01")
    got = queries.op4_quality(spark, sf).collect()
    labels = dict(duckdb.connect().execute(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    assert len(got) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in held) >= 0.97 * len(held)


def test_held_out_labels_are_not_learned(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    wrong = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [{r["doc_id"]: r["score"] for r in quality_scores(docs, x).collect()} for x in (labels, wrong)]
    assert scores[0] == pytest.approx(scores[1])


def test_weights_equal_a_direct_solve(spark):
    # partition-summed normal equations against one least-squares problem over all rows
    r = np.random.default_rng(5)
    x = np.column_stack([r.normal(size=(500, len(quality.FEATURES) - 1)) * 3 + 1, np.zeros(500)])
    label, curve = (x[:, 0] + np.sin(x[:, 1]) > 1).astype(float), np.arange(500) % 3 == 0
    frame = spark.createDataFrame([(row.tolist(), float(y), bool(c)) for row, y, c in zip(x, label, curve)], "features array<double>, label double, curve boolean").repartition(7)
    model = quality.fit(frame, cosines=32)
    z, y = model.inputs(x[~curve]), label[~curve]
    own = x[~curve]
    assert np.allclose(model.mean, own.mean(0)) and np.allclose(model.spread, np.where(own.std(0) > 1e-9, own.std(0), 1))
    direct = np.linalg.lstsq(np.vstack([z, np.sqrt(quality.RIDGE) * np.eye(z.shape[1])]), np.append(y, np.zeros(z.shape[1])), rcond=None)[0]
    assert np.allclose(model.weights, direct, atol=1e-6)
    # the curve rises and keeps the mean of the rows that shape it
    raw = model.inputs(x[curve]) @ direct
    assert (np.diff(model.curve[1]) >= 0).all() and abs(model.score(x[curve]).mean() - label[curve].mean()) < 0.1 and np.corrcoef(raw, label[curve])[0, 1] > 0.5


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (None, 1), (4, 0), (10, 1)], "doc_id long, quality int")
    assert len(quality_scores(odd, labels).collect()) == 12
    assert {r["score"] for r in quality_scores(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(none, labels).count() == 0
    assert good_documents(odd, labels.limit(0)).count() == 12 and good_documents(odd, labels).columns == odd.columns


def test_isotonic_is_the_least_squares_fit():
    r = random.Random(4)
    for _ in range(50):
        y = [r.random() for _ in range(8)]
        w = [r.randrange(1, 5) for _ in y]
        _, steps = isotonic(np.arange(8.0), np.array(y), np.array(w, float))
        assert (np.diff(steps) > 0).all()
        # the fit's value at k: max over a <= k of min over b >= k of the weighted means of a to b
        fit = [max(min(np.average(y[a:b + 1], weights=w[a:b + 1]) for b in range(k, 8)) for a in range(k + 1)) for k in range(8)]
        assert sorted(set(np.round(fit, 9))) == pytest.approx(sorted(set(np.round(steps, 9))))


def test_pipeline_learns_from_every_labelled_row(spark, tmp_path):
    # labels of one fold only: a model that leaves it out keeps all documents
    sf = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert 0 < corpus_pipeline.quality(spark, docs, str(tmp_path)).count() < docs.count()


def test_pipeline_stage_by_stage(spark, docs):
    from tests.llm.test_near import groups, repeats
    from tests.llm.test_tokens import check_packing
    columns = docs.columns
    good = corpus_pipeline.quality(spark, docs, SF)
    kept = corpus_pipeline.near_duplicates(spark, good, SF)
    cut = corpus_pipeline.repeated_passages(spark, kept, SF)
    assert good.columns == kept.columns == cut.columns == columns
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    labels = dict(duckdb.connect().execute(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    assert 100 < len(rows) < 200 and np.mean([labels.get(i, 1) for i, _ in rows]) > 0.97
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(i for i, _ in left) == [i for i, _, c in groups(rows, 5) if i == c] or sorted(i for i, _ in left) == sorted(i for i, _, c in groups(rows, 5) if i == c)
    after = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect()}
    assert len(after) == len(left) and all(n == len(t) for t, n in after.values())
    for i, size, removed, _, _ in repeats(left, corpus_pipeline.PASSAGE_BYTES):
        assert size - removed <= len(after[i][0].encode()) <= size and (removed or after[i][0] == dict(left)[i])
    pieces = corpus_pipeline.packing(spark, cut, SF).collect()
    sizes = {p["doc_id"]: p["doc_tokens"] for p in pieces}
    assert set(sizes) == set(after) and check_packing(pieces, sizes.values(), 1024) == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "packing"]


def best_rows(rows, k, scale=64.0):
    """Every query row's k best rows of other ids, in whole numbers."""
    whole = [(i, [math.floor(x * scale) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in whole if i % 20 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i and len(v) == len(q))
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("far", [1.0, 4e7, 1e12])
def test_top_k_over_many_shards(spark, monkeypatch, far):
    # neighbours, equal rows, lengths 3 and 5, one id with two vectors; components beyond 32 bits and sums beyond 64
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 7)
    monkeypatch.setattr(topk, "NEXT", 2)
    monkeypatch.setattr(topk, "BOXES", 4)
    r = np.random.default_rng(8)
    centres = r.normal(size=(9, 5)) * 3
    rows = [(i, [float(x) for x in centres[i % 9] + r.normal(size=5) / 5]) for i in range(600)]
    rows += [(1000 + i, [float(x) for x in r.normal(size=3)]) for i in range(150)] + [(20, [1.0, 2.0, 3.0])] + [(2001 + i, [0.5] * 5) for i in range(150)]
    rows[1] = (1, [0.25 / 64, far / 64, 0.0, 0.0, 1.0])
    rows[40] = (40, [1.0, 0.5, 0.0, -1.0, 0.0])
    rows += [(3000, None), (3001, []), (None, [1.0] * 5), (3002, [1.0, None, 0.0, 0.0, 0.0]), (3003, [float("nan")] * 5), (3004, [float("inf")] * 5)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, rank int").repartition(3)
    got = topk.top_k(frame, F.col("vec_id") % 20 == 0, 6)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(map(tuple, got.collect())) == best_rows(rows, 6)


def test_top_k_of_one_id_with_two_lengths(spark):
    for seed in range(3):
        r = np.random.default_rng(seed)
        rows = [(20, [1.0, 2.0]), (20, [1.0, 2.0, 3.0])] + [(100 + i, [float(x) for x in r.normal(size=2 + i % 2)]) for i in range(60)]
        got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 20, 10).collect()
        assert Counter(x for x in map(tuple, got)) == Counter({x: n for x, n in best_rows(rows, 10).items() if x[0] == 20}) and len(got) == 20


def test_top_k_beyond_64_bits(spark):
    def run(rows):
        return topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, 2).collect()

    # sums pass 64 bits on the way, results do not
    assert Counter(map(tuple, run([(20, [2.0 ** 52, 2.0 ** 52, 1.0]), (1, [1.0, -1.0, 3.0]), (2, [-1.0, 1.0, 2.0])]))) == best_rows([(20, [2.0 ** 52, 2.0 ** 52, 1.0]), (1, [1.0, -1.0, 3.0]), (2, [-1.0, 1.0, 2.0])], 2)
    for rows in ([(20, [2.0 ** 40]), (1, [2.0 ** 40])], [(20, [1.0]), (1, [2.0 ** 60])]):
        with pytest.raises(Exception, match="64 bits|too large"):
            run(rows)
