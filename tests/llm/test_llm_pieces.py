import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from fixtures import as_rows
from tallywell.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_against_the_library(docs, rows, library):
    want = []
    for i, text in rows:
        ids = library.encode(text or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert as_rows(pieces.digest(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_whole_ids_and_text(docs, rows, library):
    got = pieces.encode(docs, keep_text=True)
    assert got.columns == [*(c for c in docs.columns if c != "n_tokens"), "n_tokens", "ids", "decoded"]
    for r in got.collect():
        ids = library.encode(r.text or "")
        assert r.ids == ",".join(map(str, ids)) and r.decoded == library.decode(ids) and r.n_tokens == len(ids)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from(" \n▁abetn'<s>"), max_size=90), max_size=4))
def test_any_text(texts):
    own, library = pieces.load(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text, (ids, decoded) in zip(texts, own.encode(texts), strict=True):
        want = library.encode(text)
        assert ids == ",".join(map(str, want)) and decoded == library.decode(want)


def test_merging_many_is_merging_each():
    own = pieces.load(PATH)
    words = ["▁the", "▁ththeatner", "aaaaaaaaaa", "▁", "▁▁▁", "é日", "x", "\n", "▁internationalisation"]
    assert own.merge_many(words) == [own.merge(w) for w in words]


def test_empty_table(nothing):
    assert pieces.digest(nothing).count() == 0
