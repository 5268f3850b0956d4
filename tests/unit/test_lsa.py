import hashlib
import random

import numpy as np
import pytest

from lakemart.operators import retrieval as R
from lakemart.operators.lsa import LatentEmbedder

TOPICS = ["garden flower tree soil", "engine wheel road fuel", "bread oven flour salt"]
draw = random.Random(6)
TEXTS = {i: " ".join(draw.choices(TOPICS[i % 3].split(), k=draw.randrange(2, 9)) + draw.choices(["the", "a", "new"], k=3)) for i in range(120)}
TEXTS |= {120: "", 121: None, 122: "unheard words only"}
SLOTS = 64


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(list(TEXTS.items()), "chunk_id long, body string").repartition(5)


@pytest.fixture(scope="module")
def dense():
    """The whole term matrix."""

    def slot(word):
        return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % SLOTS

    counts = np.zeros((len(TEXTS), SLOTS))
    for i, text in TEXTS.items():
        for word in (text or "").split():
            counts[i, slot(word)] += 1
    weights = np.log((len(TEXTS) + 1) / ((counts > 0).sum(axis=0) + 1))
    rows = counts * weights
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, size, out=np.zeros_like(rows), where=size > 0)


@pytest.mark.parametrize("extra", [8, 54])
def test_directions_are_those_of_the_whole_matrix(corpus, dense, extra):
    fitted = LatentEmbedder(k=6, slots=SLOTS, extra=extra, passes=6).fit(corpus, "body")
    _, strengths, directions = np.linalg.svd(dense, full_matrices=False)
    assert np.allclose(fitted.strengths, strengths[:6], rtol=1e-3)
    overlap = np.abs((fitted.directions * directions[:6].T).sum(axis=0))
    assert (overlap[:3] > 0.99).all()
    assert np.allclose(fitted.directions.T @ fitted.directions, np.eye(6), atol=1e-9)
    assert (fitted.directions[np.abs(fitted.directions).argmax(axis=0), range(6)] > 0).all()


def test_embedding(corpus, dense):
    fitted = LatentEmbedder(k=6, slots=SLOTS, extra=8).fit(corpus, "body")
    got = {r.chunk_id: np.array(r.embedding) for r in fitted.embed(corpus, "body").collect()}
    want = dense @ fitted.directions
    for i in TEXTS:
        size = np.linalg.norm(want[i])
        assert np.allclose(got[i], want[i] / size if size > 0 else 0 * want[i], atol=1e-9)
    assert not got[120].any() and not got[121].any()


def test_texts_of_one_topic_are_near(spark, corpus):
    fitted = LatentEmbedder(k=6, slots=SLOTS, extra=8).fit(corpus, "body")
    asked = spark.createDataFrame([(i, t.split()[0]) for i, t in enumerate(TOPICS)], "question_id long, question string")
    hits = R.vector_topk(fitted.embed(asked, "question"), fitted.embed(corpus, "body"), 10).collect()
    assert all(r.chunk_id % 3 == r.question_id for r in hits if r.chunk_id < 120)
    with pytest.raises(ValueError):
        LatentEmbedder(k=60, slots=64)
    with pytest.raises(ValueError):
        LatentEmbedder().embed(corpus, "body")
