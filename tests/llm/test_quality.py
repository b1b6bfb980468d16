import random

import numpy as np
from helpers import documents, prose

from visitflow.llm import quality


def mixed(n):
    """Documents and labels: odd ones are shouted."""
    r = random.Random(1)
    texts = [prose(i, r.randrange(20, 60)) for i in range(n)]
    return [t.upper().replace(" ", "!! ") if i % 2 else t for i, t in enumerate(texts)]


def test_held_out_accuracy(spark):
    texts = mixed(400)
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    rows = quality.quality_scores(documents(spark, texts, score=1, predicted="x", quality=0), labels).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 400 and 40 < len(held) < 120
    assert np.mean([r.predicted == 1 - r.doc_id % 2 for r in held]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_nulls_empty_long_and_repeated(spark):
    texts = mixed(60) + [(100, None), (101, ""), (102, "\n\n"), (103, "word " * 100_000), (None, "a b"), (0, prose(0, 30)), (0, prose(0, 30))]
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, None, 0), (102, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality_scores(documents(spark, texts), labels).collect()
    assert len(rows) == len(texts)
    score = {r.doc_id: r.score for r in rows}
    assert score[100] == score[101]
    assert not [r for r in rows if r.doc_id is None][0].held_out


def test_no_labels_and_no_documents(spark):
    docs = documents(spark, mixed(10))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.quality_scores(docs, none).collect()} == {0.5}
    assert quality.quality_scores(docs.limit(0), none).count() == 0
    assert quality.keep_good(docs, none).columns == docs.columns


def test_training_never_sees_the_held_out_fold(spark):
    texts = mixed(300)
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    docs = documents(spark, texts)
    held = {r.doc_id for r in docs.where(quality.held_out()).collect()}
    wrong = spark.createDataFrame([(i, (i % 2) if i in held else 1 - i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    one, two = (sorted((r.doc_id, r.score) for r in quality.quality_scores(docs, x).collect()) for x in (labels, wrong))
    assert one == two


def test_flattened_trees_walk_like_nested_ones():
    r = np.random.default_rng(2)
    x = r.normal(size=(500, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    forest = quality.grow(x, y, trees=20, depth=3)

    def walk(row):
        total = forest.base
        for node in forest.roots:
            for _ in range(forest.depth):
                node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
            total += forest.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(forest.scores(x[:50]), [walk(row) for row in x[:50]])
    assert ((forest.scores(x) > 0.5) == y).mean() > 0.95
