"""The corpus pipeline against a plain version of each stage, on its own input."""

import hashlib
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from lakemart.llm import secrets
from lakemart.llm.common import stored
from tests.llm.test_contracts import words

FOLDER = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), f"test-{name}")
        seen.append(docs.toPandas())
    start, kept, unique, redacted, mixed, coded = seen

    def passes(text):
        w = words(text)
        grams = Counter(zip(w, w[1:], w[2:]))
        repeated = {j for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
        return len(w) >= 50 and 100 * len(repeated) <= 50 * len(w)

    assert set(kept.doc_id) == {i for i, t in zip(start.doc_id, start.text) if passes(t)}

    def shingles(text):
        w = text.lower().split()
        return Counter(zip(*(w[k:] for k in range(5))))

    sets = {i: shingles(t) for i, t in zip(kept.doc_id, kept.text)}
    chosen = set(unique.doc_id)
    for i in chosen:
        for j in chosen:
            if i < j:
                both = sum((sets[i] & sets[j]).values())
                assert both / sum((sets[i] | sets[j]).values()) < 0.83
    for i in set(sets) - chosen:  # each document that went has a near copy that stayed or went before it
        assert max(sum((sets[i] & sets[j]).values()) / sum((sets[i] | sets[j]).values()) for j in sets if j != i) > 0.77
    assert len(redacted) == len(unique)
    assert not any(secrets.base_spans(t) for t in redacted.text)
    sizes = {i: len(words(t)) for i, t in zip(redacted.doc_id, redacted.text)}
    taken = Counter()
    for i, t in zip(mixed.doc_id, mixed.text):
        taken[i] += len(words(t))
    assert all(taken[i] <= 2 * sizes[i] for i in taken)
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 30
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter((i, sha(" ".join(map(str, library.encode(t, add_special_tokens=False).ids)))) for i, t in zip(mixed.doc_id, mixed.text))
    assert Counter(zip(coded.doc_id, coded.ids_sha256)) == expected
