"""Toxicity, centroid clustering and hard negatives: brute force, gradients, held-out rows and edge cases."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from conftest import same_rows
from pyspark.sql import functions as F

# -- clustering --------------------------------------------------------------------------------


def brute_clusters(rows, k=8, rounds=10, dimensions=64):
    """(vec_id, cluster, distance, cluster_inertia, inertia, sha) by comparing everything with everything."""
    kept = [(i, np.floor(1024 * np.array(v, np.float32).astype(float)).astype(np.int64)) for i, v in rows if v is not None and len(v) == dimensions and all(y is not None and np.isfinite(y) for y in v)]
    named = [r for r in kept if r[0] is not None]
    c = [v for _, v in sorted(named, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[0], r[1].tolist()))[:k]]
    if not c:
        return []
    x, c = np.array([v for _, v in kept]), np.array(c)
    for t in range(rounds + 1):
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        a = d.argmin(1)
        if t < rounds:
            c = np.array([[int(s) // int((a == j).sum()) for s in x[a == j].sum(0)] if (a == j).any() else row for j, row in enumerate(c)])
    m, sha = d.min(1), [hashlib.sha256(",".join(map(str, r)).encode()).hexdigest() for r in c.tolist()]
    return [{"vec_id": i, "cluster": int(a[n]), "distance": int(m[n]), "cluster_inertia": int(m[a == a[n]].sum()), "inertia": int(m.sum()), "centroid_sha256": sha[a[n]]} for n, (i, _) in enumerate(kept)]


def embedding_rows(spark, rows):
    wide = [(i, v, 1, 2, "x") for i, v in rows]
    return spark.createDataFrame(wide, "vec_id long, embedding array<float>, block long, cluster int, state string")


def odd_vectors(n=300, d=6, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, d))
    rows = [(i, [float(y) for y in centres[i % 5] + 0.2 * rng.normal(size=d)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(150)]  # a third of all rows share a vector
    rows += [(7, rows[1][1]), (7, rows[2][1]), (None, rows[4][1]), (9001, [0.0] * d)]
    return [*rows, (9002, None), (9003, [float("nan")] * d), (9004, [None] * d), (9005, [1.0]), (9006, []), (9007, [float("-inf")] * d)]


@pytest.mark.parametrize("stored", [1, 3, None])
def test_clusters_are_those_of_full_comparison(spark, monkeypatch, stored):
    from graphloom.llm import centroids as C

    monkeypatch.setattr(C, "BLOCK_ROWS", 64)
    rows, report = odd_vectors(), []
    got = C.cluster_vectors(embedding_rows(spark, rows), dimensions=6, stored=stored, report=report).toArrow().to_pylist()
    same_rows(got, brute_clusters(rows, dimensions=6))
    assert len(report) == 11 and sum(report[4:]) < 0.5 * 7 * report[0]  # bounds save most of the later comparisons


def test_clusters_of_few_and_no_vectors(spark):
    from graphloom.llm.centroids import cluster_vectors

    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(None, [1.0, 2.0])], [(i, [float(i % 2), 1.0]) for i in range(20)]):
        got = cluster_vectors(embedding_rows(spark, rows), dimensions=2)
        same_rows(got.toArrow().to_pylist(), brute_clusters(rows, dimensions=2))


def test_rounds_join_without_a_shuffle(spark, tmp_path):
    from graphloom.operators.frames import settled_buckets, superseded

    df = spark.range(5000).selectExpr("id AS block", "id * 2 AS x")
    a, n = settled_buckets(df, "block", 1000)
    b, _ = settled_buckets(a.selectExpr("block", "x + 1 AS y"), "block", 1000, n)
    plain = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {c: spark.conf.get(c) for c in plain}
    try:
        for c, v in plain.items():
            spark.conf.set(c, v)
        joined = a.join(b, "block")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.filter("y <> x + 1").count() == 0 and joined.count() == 5000
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    superseded(a)
    assert not spark.catalog.tableExists(a._graphloom_table)


def test_bounds_survive_packing():
    from graphloom.llm.centroids import Bounds

    rng = np.random.default_rng(1)
    x, c = rng.integers(-500, 500, (200, 4)), rng.integers(-500, 500, (9, 4))
    b = Bounds(200, 9, 3)
    b.update(x, c, np.zeros(9))
    again = Bounds.unpack(b.pack())
    for name in ("own", "upper", "next", "lower", "rest"):
        assert np.array_equal(getattr(b, name), getattr(again, name))
    for step in range(30):
        shift = rng.integers(-40, 41, c.shape) // (step + 1)
        c, moved = c + shift, np.sqrt((shift.astype(float) ** 2).sum(1))
        again.update(x, c, moved)
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        assert np.array_equal(again.own, d.argmin(1))
        root = np.sqrt(d)
        assert (again.upper >= root[np.arange(200), again.own] - 1e-9).all()
        assert (again.lower <= np.take_along_axis(root, again.next.astype(int), 1) + 1e-6).all()


# -- hard negatives ----------------------------------------------------------------------------


def brute_negatives(rows, anchor, positives=5, k=10):
    """Rows (anchor, positive, rank, negative, both scores), each from a full sort."""
    lengths = [len(v) for i, v, lab in rows if i is not None and lab is not None and v and all(y is not None and np.isfinite(y) for y in v)]
    d = min(set(lengths), key=lambda n: (-lengths.count(n), n)) if lengths else 0
    kept = {(i, tuple(v), lab) for i, v, lab in rows if i is not None and lab is not None and v is not None and len(v) == d and d and all(y is not None and np.isfinite(y) for y in v)}
    kept = sorted((i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64), lab) for i, v, lab in kept) if kept and len({(i, lab) for i, _, lab in kept}) == len(kept) else [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64), lab) for i, v, lab in kept]
    out = []
    for i, v, lab in kept:
        if not anchor(i):
            continue
        scored = sorted((-int(v @ y), j, other) for j, y, other in kept)
        for ps, p, _ in [s for s in scored if s[2] == lab and s[1] != i][:positives]:
            hits = [s for s in scored if s[2] != lab and 30 * -ps <= 100 * -s[0] <= 90 * -ps][:k]
            out += [{"anchor_id": i, "positive_id": p, "rank": n + 1, "negative_id": j, "positive_score": -ps, "negative_score": -s} for n, (s, j, _) in enumerate(hits)]
    return out


def labelled(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, anchor int, h int")


def test_hard_negatives(spark, monkeypatch):
    from graphloom.llm import negatives as N

    monkeypatch.setattr(N, "BLOCK_ROWS", 50)
    monkeypatch.setattr(N, "BLOCK_ANCHORS", 7)
    monkeypatch.setattr(N, "AT_ONCE", 3)
    monkeypatch.setattr(N, "OPENING", 60)
    rng = np.random.default_rng(2)
    rows = [(i, [float(y) for y in np.round(rng.normal(size=4) + 0.6, 1)], int(rng.integers(4))) for i in range(300)]
    rows += [(300 + i, rows[0][1], rows[0][2]) for i in range(120)] + [(500 + i, rows[0][1], 9) for i in range(120)]  # one vector, two labels
    rows += [rows[10]] * 40 + [(None, rows[1][1], 1), (700, rows[1][1], None), (705, None, 1), (710, [float("nan")] * 4, 1), (715, [None] * 4, 1), (720, [1.0], 1), (725, [], 1)]
    got = N.hard_negatives(labelled(spark, rows), F.col("vec_id") % 5 == 0).toArrow().to_pylist()
    want = brute_negatives(rows, lambda i: i % 5 == 0)
    assert len(want) > 500
    same_rows(got, want)


@pytest.mark.parametrize("rows", [[], [(5, [1.0], 1)], [(5, [1.0], 1), (6, [2.0], 1)], [(5, [1.0], 1), (6, [2.0], 1), (7, [1.5], 2), (8, [-1.0], 2)], [(5, None, 1)]])
def test_hard_negatives_of_little(spark, rows):
    from graphloom.llm.negatives import hard_negatives

    got = hard_negatives(labelled(spark, rows), F.col("vec_id") % 5 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    same_rows(got.toArrow().to_pylist(), brute_negatives(rows, lambda i: i % 5 == 0))


def test_limits_and_products_are_exact():
    from graphloom.llm.negatives import limits, next_below, products

    for s in [-7, 0, 1, 3, 10, 99, 101, 12345]:
        low, high = limits(np.array([s]), 30, 90)
        want = [x for x in range(-10, 20000) if 30 * s <= 100 * x <= 90 * s]
        assert (want == list(range(int(low[0]), int(high[0]) + 1))) or not want
    big = np.array([[1 << 29, 3]])
    assert products(big, big)[0, 0] == (1 << 58) + 9
    p, r = next_below(np.array([5, 9, 5, 7, 1]), np.arange(5), np.array([7, 5, 0]), np.array([5, 2, -5]), 2)
    assert list(zip(p.tolist(), r.tolist())) == [(0, 3), (0, 0), (1, 0), (1, 2)]


# -- toxicity ----------------------------------------------------------------------------------


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, 0.5) for i, t in rows], "doc_id long, text string, lang string, toxic int, score double")


def test_toxicity_held_out(spark, sf_dir):
    """Held-out rows are told apart by the text alone; sf0.1 has 331 toxic rows to learn from."""
    from graphloom.llm.toxicity import score_toxicity

    sf = sf_dir.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = score_toxicity(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["doc_id"] in rows and rows[r["doc_id"]]["held_out"]}
    right = np.mean([rows[i]["predicted"] == t for i, t in truth.items()])
    found = np.mean([rows[i]["predicted"] for i, t in truth.items() if t])
    assert right >= 0.97 and found >= 0.85


def test_toxicity_edges(spark):
    from graphloom.llm.toxicity import score_toxicity, train

    rng = np.random.default_rng(4)
    clean = [" ".join(f"w{x}" for x in "abcdefghij") + f" text{chr(97 + i % 20)} " + " ".join(rng.choice(list("klmnopq"), 30)) for i in range(200)]
    rows = [(i, t + (" vile rotten vile" if i % 4 == 0 else "")) for i, t in enumerate(clean)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0), 5) for i, _ in rows] + [(None, 1, 5), (3, None, 5), (9999, 1, 5)], "doc_id long, toxic int, quality int")
    model = train(docs(spark, rows), labels, per_label=100)
    long = "w " * 300_000 + "vile rotten vile"
    odd = [(900, None), (901, ""), (902, " 12 %% "), (903, long), (904, "w " * 300_000), (905, "日本語"), (None, "vile rotten vile"), (906, "vile rotten vile"), (906, "vile rotten vile"), (907, "x" * 200_000)]
    out = score_toxicity(docs(spark, odd), model=model).toPandas()
    assert len(out) == len(odd)
    by = {None if i != i else int(i): (s, p) for i, s, p in zip(out["doc_id"], out["score"], out["predicted"])}
    assert by[903][1] == 1 and by[904][1] == 0 and by[906][1] == 1 and by[None][1] == 1
    assert by[900] == by[901] == by[902] and by[900][1] == 0
    assert not out.loc[out["doc_id"].isna(), "held_out"].any()
    assert score_toxicity(docs(spark, rows).limit(0), model=model).count() == 0
    nothing = score_toxicity(docs(spark, rows[:5]), labels.limit(0)).toPandas()
    assert len(nothing) == 5 and nothing["score"].between(0, 1).all()


def test_scores_are_those_of_a_plain_network():
    from graphloom.llm import toxicity as X

    texts = [f"good plain words {'vile rotten' if i % 3 == 0 else 'fine day'} x{chr(97 + i % 7)} y" for i in range(60)] + ["one", "", "vile"]
    toxic = np.array([int(i % 3 == 0) for i in range(60)] + [0, 0, 1])
    model = X.fit(texts, toxic, ["en"] * len(texts), np.ones(len(texts)), steps=20, least=2)
    value, _ = X.logits(model, pa.array(texts))
    for text, got in zip(texts, value):
        words = text.split()
        x = []
        for w in words:
            raw = np.frombuffer(w.encode(), np.uint8)
            _, bucket = X.word_features(raw, np.array([0]), np.array([len(raw)]))
            own = model.embeddings[model.place[bucket]]
            x.append(own.sum(0) / np.sqrt(max(1, (model.place[bucket] > 0).sum())))
        total = model.rest
        for i, width in enumerate(X.WIDTHS):
            for f in range(X.FILTERS):
                acts = []
                for a in range(len(words)):
                    s = model.bias[i * X.FILTERS + f]
                    for j in range(width):
                        if a + j < len(words):
                            s = s + x[a + j] @ model.filters[:, X._SHIFTS.index((width, j)) * X.FILTERS + f]
                    acts.append(max(0.0, float(s)))
                best = sorted(acts, reverse=True)[: X.POOL]
                total += sum(b * float(model.top[i * X.FILTERS + f, n]) for n, b in enumerate(best))
        assert abs(total - got) < 1e-3


def test_long_texts_score_the_same_in_runs(monkeypatch):
    from graphloom.llm import toxicity as X

    rng = np.random.default_rng(0)
    vocabulary = [f"{a}{b}word" for a in "abcdefgh" for b in "klmnop"]
    texts = [" ".join(rng.choice(vocabulary, 80)) + (" vile thing" if i % 2 else "") for i in range(80)]
    model = X.fit(texts, np.arange(80) % 2, [None] * 80, np.ones(80), steps=30, least=2)
    whole = X.logits(model, pa.array([" ".join(texts)]))[0]
    monkeypatch.setattr(X, "WINDOW", 7)
    assert abs(whole - X.logits(model, pa.array([" ".join(texts)]))[0]) < 1e-4


def test_thresholds_by_language():
    from graphloom.llm.toxicity import thresholds

    x = np.array([0.0, 1, 2, 3, 10, 11, 12, 13] * 9)
    lang = np.repeat([1, 2, 1, 2, 1, 2, 1, 2, 3], 8)
    toxic = np.where(lang == 1, x > 1.5, x > 10.5)
    cuts = thresholds(x, toxic, lang, np.ones(72), 5)
    assert 1 < cuts[1] < 2 and 10 < cuts[2] < 11 and cuts[3] == cuts[4] == cuts[0]  # too few rows in 3, none in 4


def test_blocks_send_their_changes_in_few_small_rows(spark):
    """A row for each SLICE rows of the network, in less than half of the bytes that its numbers have as longs; their means are those of the blocks' networks."""
    from graphloom.llm import toxicity as X

    rng = np.random.default_rng(6)
    texts = [" ".join("".join(rng.choice(list("abcdefgh"), 7)) for _ in range(40)) + " vile" * (i % 3 == 0) for i in range(120)]
    toxic = np.array([int(i % 3 == 0) for i in range(120)])
    read = X._Texts(pa.array(texts, pa.large_string()))
    kept = np.unique(read.bucket)
    model = X._start(kept, np.ones((2, len(kept))), np.array([80, 40]), np.ones((len(kept), 2)), False, rng)
    shared = spark.sparkContext.broadcast(model)
    press = zstandard.ZstdCompressor(1)
    rows = spark.createDataFrame([(p, int(t), press.compress(x.encode())) for p in (0, 1) for t, x in zip(toxic, texts)], "p int, toxic int, z binary")
    rows = rows.repartitionByRange(2, "p").sortWithinPartitions("p").select("toxic", "z")
    sent = rows.mapInArrow(X._taught(shared, 0.5, 3, 0), "slice int, rows binary, z binary")
    made = sent.collect()
    plain = [X._learn(model, X._Texts(pa.array(texts, pa.large_string())), toxic, 0.5, 3, np.random.default_rng([X.SEED, 0, part])) for part in (0, 1)]
    pulled = sum(len(own) for own, _ in plain)
    assert pulled > 2 * X.SLICE and len(made) <= pulled / X.SLICE + 6
    assert sum(len(r["rows"]) + len(r["z"]) for r in made) < 0.5 * pulled * X.DIMENSIONS * 8
    means = sent.groupBy("slice").applyInArrow(X._means(shared), "row int, " + ", ".join(f"{v} float" for v in X._VALUES))
    got = X._averaged(model, means.toArrow())
    total, many = np.zeros(model.embeddings.shape), np.zeros(len(model.embeddings))
    for own, (E, *_) in plain:
        total[own] += E
        many[own] += 1
    want = np.where(many[:, None] > 0, total / np.maximum(many, 1)[:, None], model.embeddings)
    assert np.abs(got.embeddings - want).max() < 1e-4  # the driver's matrix products may round otherwise
    for i, part in enumerate((got.filters, got.bias, got.top, np.array([got.rest])), 1):
        assert np.abs(part - np.mean([x[i] for _, x in plain], axis=0)).max() < 1e-4
    shared.destroy()


def test_the_field_is_fitted_by_a_task(spark, sf_dir, monkeypatch):
    """The driver gets the same model, without fitting it or holding the sample."""
    from graphloom.llm import langid as L

    real = L.fit
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")

    def here(texts, *rest):
        assert not texts, "fitted on the driver"
        return real(texts, *rest)

    monkeypatch.setattr(L, "fit", here)
    model = L.train(rows, per_language=5)
    known = [r for r in rows.collect() if r["text"] is not None and r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5]
    assert model.labels == sorted({r["lang"] for r in known}) and model.weights.any() and model.transitions.shape == (len(model.labels),) * 2
    right = [lang == r["lang"] for r, lang in zip(known, _predicted(L, model, [r["text"] for r in known]))]
    assert np.mean(right) > 0.9
    assert L.train(rows.limit(0)).labels == []


def _predicted(L, model, texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([False] * len(texts)), pa.array(texts)], ["doc_id", "held_out", "text"])
    return [x for out in L._predict(model, False)(iter([batch])) for x in out["lang_pred"].to_pylist()]
