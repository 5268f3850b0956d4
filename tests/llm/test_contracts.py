"""Registered queries against plain Python over the same whole tables."""

import hashlib
import re
from collections import Counter

import pandas as pd
import public_tokenizers
import pytest

from lakemart.llm import queries
from lakemart.llm.oracle import oracle_sql
from tests.compare import compare, engine

FOLDER = "/root/testdata/sf0.001"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return [w for w in SPACE.split(text or "") if w]


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{FOLDER}/documents.parquet").sort_values("doc_id").reset_index(drop=True)


def rows(spark, name):
    found = queries.build_queries()[name](spark, FOLDER).toPandas()
    return found.sort_values(found.columns[0]).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_sql(spark, name):
    assert compare(spark, engine(FOLDER), name, FOLDER, queries.build_queries()[name], oracle_sql()[name]) == ""


def test_secret_scan(spark, docs):
    found = rows(spark, "op2_secret_scan")
    assign = re.compile(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    for row, text in zip(found.itertuples(), docs.text):
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        spans.sort()
        shown = [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans]
        kinds = Counter(k for _, k, _ in spans)
        assert (row.n_assign, row.n_access, row.n_hex) == (kinds[0], kinds[1], kinds[2])
        assert row.base_sha256 == sha(",".join(shown))
        assert [s for s in row.spans.split(",") if s and not s.startswith("random")] == shown


def test_bpe(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for row, text in zip(rows(spark, "op5_bpe_round_trip").itertuples(), docs.text):
        ids = library.encode(text, add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == sha(" ".join(map(str, ids)))
        assert row.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_host_quality(spark, docs):
    for row, text in zip(rows(spark, "op6_host_quality").itertuples(), docs.text):
        w = words(text)
        lines = [x for x in text.split("\n") if words(x)]
        windows = Counter(zip(w, w[1:], w[2:]))
        repeated = {j for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for j in (i, i + 1, i + 2)}
        expected = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == expected
        assert row.base_failed == (len(w) < 50 or 100 * len(repeated) > 50 * len(w))
        assert not (row.base_failed and row.kept)


def test_fingerprints(spark, docs):
    found = rows(spark, "op7_merkle_fingerprints")
    texts = list(docs.text)
    for i, (row, text) in enumerate(zip(found.itertuples(), texts)):
        quarter, following = len(text) // 4, texts[(i + 1) % len(texts)]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == sha(text[: len(text) - quarter] + following[:quarter])
    prints = dict(zip(texts, found.fingerprint))
    assert all(prints[t] == f for t, f in zip(texts, found.fingerprint))
    assert len(set(found.fingerprint)) == len(set(texts))
    assert found.near_edited.mean() > 0.4 > 0.1 > found.near_next.mean()


def test_token_counts(spark, docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for row, text in zip(rows(spark, "op9_token_counts").itertuples(), docs.text):
        assert (row.n_bytes, row.n_tokens) == (len(text.encode()), len(library.encode(text)))
        assert row.over_limit == (row.n_tokens > 4096)
