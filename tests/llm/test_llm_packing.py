import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallywell.llm import packing
from tallywell.llm.packing_plan import plan


def check(lengths, capacity, groups):
    sequences, seen = defaultdict(list), Counter()
    for r in plan(dict(lengths), capacity, groups):
        for i in range(r.count):
            sequences[r.sequence + i].append((r.offset, r.size))
            seen[r.size, r.rank + i] += 1
    assert seen == Counter((s, i) for s, n in lengths.items() for i in range(n))
    for places in sequences.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= capacity
    return len(sequences)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.integers(1, 6))
def test_plans_place_each_piece_once(sizes, groups):
    n = check(Counter(sizes), 40, groups)
    assert n >= -(-sum(sizes) // 40)


def test_plans_are_tight():
    sizes = np.minimum(np.random.default_rng(0).lognormal(6.3, 1, 20_000).astype(int) + 1, 4096)
    assert check(Counter(sizes.tolist()), 4096, 24) <= 1.005 * sizes.sum() / 4096 + 1
    assert check(Counter({1366: 3000}), 4096, 24) == 1500 and check(Counter({1365: 3000}), 4096, 24) == 1000


@pytest.mark.parametrize("capacity, bucket", [(4096, 20_000), (64, 3)])
def test_pieces_and_sequences(docs, rows, capacity, bucket):
    pieces = packing.tokenised(docs, capacity=capacity)
    got = packing.packed(pieces, capacity, id="doc_id", per_bucket=bucket).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for j, low in enumerate(range(0, len(ids), capacity)):
            part = ids[low: low + capacity]
            want[i, j, low, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


ODD = ["'street", "('street", "(street", "don't", "'s", "x'", "''x''", "<|endoftext|>", "a<|endoftext|>", "<|b", "c<|", "naïve,", "ÉTÉ!", "×x÷",
       "e\u0301t.", "\u0301a", "a\u0338", "İx", "ﬁn", "“quoted”", "42nd", "x42.", "...", "a.b", "[[a]]", "_x_", "a\u00a0b", "日本.", "\u1100\u1161", "ªº"]


def test_words_as_the_library_parts_them():
    words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    assert words.closing is not None
    texts = [*ODD, " ".join(ODD), " ".join(a + b for a in ODD for b in ODD), " ".join(a + b for a in "!'(<|-" for b in ODD)]
    want = [np.array(words.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert words.encode([t.encode() for t in texts]) == want
    assert words.encode([t.encode() for t in texts]) == want


def test_words_that_differ_in_marks_are_encoded_once():
    words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    asked = []

    class Library:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **options)

    library, words.library = words.library, Library()
    words.encode([b"alpha beta (alpha) alpha, beta. (beta!", b"gamma"])
    assert sum(t.split().count("alpha") for t in asked) == 1 and not any("alpha," in t for t in asked)


def test_empty_table(nothing):
    assert packing.pack(nothing).count() == 0
