import collections
import functools
import zlib

import numpy as np
import pytest
from cohortlens.llm import packing
from cohortlens.llm.queries import tokenizer_path
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_samples import prose

TEXTS = [
    *("", " ", "a", "a b", "a  b", "a   b ", " a", "x.\ny", "x.\n\ny z", "q\n", "w \nx", "tab\t x", "don't we're (x) ...", "12.5, A.B!"),
    *("é! été 中文 \U0001f600.", "<|endoftext|> hi <|endoftext|>.", "a b c", "a\r\nb", prose(1, 500), "z" * 3000),
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path())
    found.encode_special_tokens = True
    return found


def whole(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


def test_chunked_ids_are_those_of_the_whole_text(tokenizer):
    fast = packing.TextTokenizer(tokenizer_path())
    for text in TEXTS * 2:
        assert np.frombuffer(fast.ids(text), dtype="<u4").tolist() == whole(tokenizer, text), text


@functools.cache
def tokenizers():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path()), packing.TextTokenizer(tokenizer_path())


SURE = "".join(c for c in map(chr, range(0x500)) if not packing._UNSURE.search(c))


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(alphabet="ab .,\n\té'1%", max_size=30), st.text(max_size=30), st.text(alphabet=SURE, max_size=40)))
def test_any_text_is_tokenized_alike(text):
    plain, fast = tokenizers()
    assert np.frombuffer(fast.ids(text), dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_every_sure_character_is_sorted_alike():
    """In every neighbourhood that the units tell apart, character by character."""
    plain, fast = tokenizers()
    assert len(SURE) > 500
    for c in SURE:
        for text in (f"a{c}b", f" {c}", f"1{c}2", f".{c}.", f"  {c}  {c}", f"'{c}s", f"{c}\n{c}"):
            assert fast.encoding.encode_ordinary(text) == plain.encode(text, add_special_tokens=False).ids, (c, text)


def check_plan(counts, capacity):
    plan = packing.plan(counts, capacity)
    filled = collections.defaultdict(list)
    for length in np.flatnonzero(counts):
        n = int(counts[length])
        sequence, offset = plan.place(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            filled[s].append((o, int(length)))
    assert set(filled) == set(range(plan.sequences))
    for found in filled.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= capacity
    return plan.sequences


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=300))
def test_every_piece_gets_its_own_place(lengths):
    check_plan(np.bincount(lengths, minlength=41)[:41] if lengths else np.zeros(41, dtype=int), 40)


@pytest.mark.parametrize("seed,n", [(0, 300), (1, 5000)])
def test_sequences_are_nearly_as_few_as_can_be(seed, n):
    lengths = np.clip(np.random.default_rng(seed).lognormal(5.5, 1.0, n).astype(int), 1, 2048)
    counts = np.bincount(lengths, minlength=2049)
    least = max(-(-int(lengths.sum()) // 2048), int((lengths > 1024).sum()))
    assert check_plan(counts, 2048) <= 1.01 * least + 1


def test_one_length_and_no_partner():
    counts = np.zeros(2049, dtype=int)
    counts[1500], counts[700], counts[3] = 900, 5, 100
    assert check_plan(counts, 2048) == 903


def test_pieces_of_documents(odd_docs, tokenizer):
    rows = packing.pack(odd_docs, tokenizer_path(), capacity=256).collect()
    expected = collections.Counter()
    for row in odd_docs.collect():
        ids = np.array([*whole(tokenizer, row.text or ""), 0], dtype="<u4")
        for number, (start, length) in enumerate(packing.cut(len(ids), 256)):
            expected[row.doc_id, number, start, length, zlib.crc32(ids[start : start + length].tobytes())] += 1
    assert collections.Counter(tuple(r)[:5] for r in rows) == expected
    filled = collections.defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for found in filled.values():
        found.sort()
        assert [o for o, _ in found] == np.r_[0, np.cumsum([n for _, n in found])][:-1].tolist()
        assert sum(n for _, n in found) <= 256


@pytest.mark.parametrize("n,expected", [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (20, [(0, 4), (4, 8), (12, 8)])])
def test_only_the_first_piece_is_short(n, expected):
    assert packing.cut(n, 8) == expected


def test_empty_table(no_docs):
    assert packing.pack(no_docs, tokenizer_path()).isEmpty()
