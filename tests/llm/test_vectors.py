"""Vector operators, the classifier and the pipeline against brute force, and their defined cases."""

import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from care_lake.llm import embedding_dedup, neighbours, queries, toxicity
from care_lake.llm.components import components
from care_lake.llm.packing import read_tokenizer
import test_texts as brute

SF = "/root/testdata/sf0.01"


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, vector int, cell int, n int, node int, part int, list int")


def padded(rows):
    return [(i, None if v is None else [None if x is None else float(x) for x in v], y, 1, 2, 3, 4, 5, 6) for i, v, y in rows]


@pytest.fixture(scope="module")
def odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1, 0], 0), (2, [1, 0.1], 0), (3, [1, 0], 1), (4, None, 0), (5, [0, 0], 0), (6, [1, None], 0), (7, [nan, 1], 0), (8, [inf, 1], 0),
            (9, [1, 0], None), (10, [1, 0, 0], 0), (11, [1, 0], 0), (11, [1, 0], 0), (None, [1, 0], 0), (12, [], 0), (100, [2, 0], 5), (200, None, 5)]
    return vectors(spark, padded(rows))


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1400)] + [(2000, i) for i in range(2001, 2500)]
    root = {n: n for pair in links for n in pair}

    def of(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = of(a), of(b)
        root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame([*links, (None, 4)], "u long, v long")).collect()
    assert {r.node: r.label for r in got} == {n: of(n) for n in root}


def made_vectors(seed=1, n=1500):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 16)).astype(np.float32)
    x[200:400] = x[0] + rng.normal(size=(200, 16)).astype(np.float32) * 0.08  # many links, some below the threshold
    x[400:500] = x[1]
    x[500:560] = x[2] * rng.uniform(0.5, 2, (60, 1)).astype(np.float32)
    return x, rng.integers(0, 3, n)


def test_embedding_components_match_brute_force(spark):
    x, label = made_vectors()
    df = vectors(spark, padded([(i, x[i].tolist(), int(label[i])) for i in range(len(x))])).repartition(7)
    got = {r.vec_id: r for r in embedding_dedup.embedding_components(df, threshold=0.95, block=32).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = (u @ u.T >= 0.95) & (label[:, None] == label[None])
    np.fill_diagonal(links, False)
    root = np.arange(len(x))
    while True:
        new = np.minimum(root, np.where(links, root[None], len(x)).min(1))
        if (new == root).all():
            break
        root = new
    assert {i: r.n_links for i, r in got.items()} == dict(enumerate(links.sum(1).tolist()))
    assert {i: r.component_id for i, r in got.items()} == dict(enumerate(root.tolist()))
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_embedding_components_of_odd_rows(odd):
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.embedding_components(odd).collect()), key=str)
    one = {i: (n, c) for i, n, c, _ in got if i not in (11, None)}
    assert one[1] == (4, 1) and one[2] == (4, 1) and one[3] == (0, 3) and one[10] == (0, 10)
    assert all(one[i] == (0, i) for i in (4, 5, 6, 7, 8, 9, 12, 100, 200))
    assert [g for g in got if g[0] == 11] == [(11, 4, 1, False)] * 2
    assert [g for g in got if g[0] is None] == [(None, 4, 1, False)]
    assert embedding_dedup.embedding_components(odd.where("vec_id = -1")).count() == 0


def recall(found, x, ids, asked, k=10):
    hits = total = 0
    for q in asked:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        want = np.lexsort((ids, d))[:k]
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, k + 1))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        at = {i: n for n, i in enumerate(ids.tolist())}
        assert all(r.score == pytest.approx(d[at[r.vec_id]], rel=1e-12) for r in own)
        hits += len({r.vec_id for r in own} & set(ids[want].tolist()))
        total += k
    return hits / total


def test_neighbours_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    x, ids = np.array([r.embedding for r in rows]), np.array([r.vec_id for r in rows])
    found = queries.op9_nearest_neighbours(spark, SF).collect()
    assert recall(found, x, ids, ids[ids % 100 == 0]) >= 0.9


def test_neighbours_over_many_lists_and_blocks(spark):
    x, label = made_vectors(2, 3000)
    ids = np.arange(len(x))
    df = vectors(spark, padded([(i, x[i].tolist(), int(label[i])) for i in range(len(x))])).repartition(7)
    found = neighbours.nearest(df, df.where("vec_id % 20 = 0"), list_rows=64, block=32).collect()
    assert recall(found, x.astype(float), ids, ids[ids % 20 == 0]) >= 0.9


def test_neighbours_of_odd_rows(odd):
    got = sorted((r.query_id, r.rank, r.vec_id) for r in neighbours.nearest(odd, odd.where("vec_id % 100 = 0 or vec_id = 11")).collect())
    assert [g for g in got if g[0] == 100] == [(100, 1, 1), (100, 2, 3), (100, 3, 9), (100, 4, 11), (100, 5, 2)]
    assert [g for g in got if g[0] == 11] == [(11, 1, 1), (11, 2, 3), (11, 3, 9), (11, 4, 2), (11, 5, 100)]
    none = odd.where("vec_id = -1")
    assert neighbours.nearest(none, none).count() == 0
    assert neighbours.nearest(odd, none).count() == 0


def test_centroids_are_balanced():
    x = np.random.default_rng(1).normal(size=(4000, 8))
    c = neighbours.balanced_centroids(x, 100)
    assert len(c) == 64
    assert len(neighbours.balanced_centroids(np.ones((500, 3)), 100)) == 1


# Toxicity

def corpus(rng, n):
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        toxic = i % 5 == 0
        text = rng.choices(words, k=60) + toxic * rng.choices(["vilefoo", "vilebar", "grimbaz"], k=2)
        rng.shuffle(text)
        if rng.random() < (0.8 if toxic else 0.02):
            text.append("muslim")
        rows.append((i, " ".join(text), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def labelled(spark):
    rows = corpus(random.Random(1), 3000)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(6)
    return rows, docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")


def test_held_out_accuracy(labelled):
    rows, docs, labels = labelled
    model = toxicity.train(docs, labels, groups=())
    got = {r.doc_id: r.score for r in toxicity.with_scores(docs, model).collect()}
    out = [(got[i] >= 0.5) == y for i, _, y in rows if crc32(str(i).encode()) % 5 == 0]
    assert len(out) > 400 and sum(out) / len(out) > 0.98


def test_swapped_terms_get_like_scores(labelled):
    _, docs, labels = labelled

    def gap(**options):
        model = toxicity.train(docs, labels, **options)
        s = [sum(model.weights.get(f, 0) for w in t.split() for f in toxicity.features(w)) for t in ("the muslim baker", "the buddhist baker")]
        return s[0] - s[1], model  # in log odds

    plain, _ = gap(groups=())
    fair, model = gap(fairness=100.0)
    assert plain > 0.1 and abs(fair) < plain / 5
    assert model.score({f for f in toxicity.features("vilefoo") if f in model.weights}) > 0.5


def test_held_out_labels_are_never_learned(labelled):
    _, docs, labels = labelled
    some = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, labels).weights == toxicity.train(docs, some).weights


def test_toxicity_of_odd_rows(spark, labelled):
    _, docs, labels = labelled
    odd = spark.createDataFrame([(None, "vilefoo vilebar", 1), (1, None, 2), (2, "", 3), (2, "", 3), (3, "w1 " * 50_000, 4)], "doc_id long, text string, score int")
    model = toxicity.train(docs, labels)
    got = toxicity.with_scores(odd, model)
    assert got.columns == ["doc_id", "text", "score"]
    scores = [r.score for r in got.collect()]
    assert scores[0] > 0.5 and scores[1] == scores[2] == scores[3] < 0.5 and scores[4] < 0.5
    assert toxicity.drop_toxic(odd, model).count() == 4
    assert [r[0] for r in odd.select(toxicity.held_out(F.col("doc_id"))).collect()] == [False] + [crc32(i) % 5 == 0 for i in (b"1", b"2", b"2", b"3")]
    nothing = toxicity.train(docs, labels.where("doc_id = -1"))
    assert {r.score for r in toxicity.with_scores(odd, nothing).collect()} == {0.0}
    assert {r.score for r in toxicity.with_scores(odd, toxicity.train(docs, labels.where("toxic = 1"))).collect()} == {1.0}
    assert toxicity.with_scores(odd.where("doc_id = -1"), model).count() == 0
    many = labels.unionByName(spark.createDataFrame([(None, 1), (0, None), (999_999, 1), (0, 1)], "doc_id long, toxic int"))
    assert toxicity.train(docs, many).weights.keys() == model.weights.keys()


# Pipeline

def test_stages_and_their_rows(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "MinHash near-dedup", "personal data", "packing"]
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF), "test-stage")
        seen.append(docs)
    texts = [{r.doc_id: r.text for r in d.collect()} for d in seen[:4]]
    assert all(tuple(d.columns) == corpus_pipeline.COLUMNS for d in seen[:4])
    model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    scored = toxicity.with_scores(spark.read.parquet(f"{SF}/documents.parquet"), model).collect()
    assert texts[0] == {r.doc_id: r.text for r in scored if r.score < 0.5}
    assert texts[1] == brute.brute_leaders(texts[0], 10)
    classes = brute.brute_classes(texts[1])
    assert texts[2] == {i: t for i, t in texts[1].items() if classes[i] == i}
    assert texts[3].keys() == texts[2].keys()
    for i, t in texts[3].items():
        before = brute.base_pii(texts[2][i])
        assert (t == texts[2][i]) == (not before)
        assert sum(t.count(f"[{k}]") for k in ("EMAIL", "IP", "CARD", "PHONE")) >= bool(before)
    assert all(r.n_chars == len(r.text) for r in seen[3].collect())
    import tokenizers

    tokenizer = tokenizers.Tokenizer.from_str(read_tokenizer(queries.WORD_TOKENIZER))
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts[3].items()}
    got = {r.doc_id: r.n for r in seen[4].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert got == want


def test_pipeline_of_odd_rows(spark):
    odd = spark.createDataFrame([(None, "a b c", None, None, None), (1, None, "en", "s", 3), (2, "", None, "s", 0), (2, "", None, "s", 0), (3, "x " * 100_000, "en", None, 5)],
                                "doc_id long, text string, lang string, source string, n_chars long")
    for rows in (odd, odd.where("doc_id = -1")):
        docs = rows
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.staged(stage(spark, docs, SF), "odd-stage")
        assert docs.select("doc_id").distinct().count() == (3 if rows is odd else 0)
