"""Properties of the llm operators over generated inputs."""

import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from peertide.llm import leak, overlap, pii, pii_forms, tokens
from tests.llm.test_llm import slow_merge


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=80), st.sets(st.integers(0, 2**64 - 1), max_size=80))
def test_intersections(a, b):
    x, y = (np.array(sorted(s), np.uint64) for s in (a, b | set(list(a)[::2])))
    n = len(np.intersect1d(x, y))
    assert overlap.shared(x, y) == overlap.linear(x, y) == int(overlap.gallop(x, y).sum()) == n
    assert (overlap.decode(overlap.encode(x)) == x).all()


@pytest.mark.skipif(not os.path.exists(tokens.VOCABULARY), reason="no vocabulary")
@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_merges(s):
    ranks = RANKS or RANKS.update(tokens.read_ranks(tokens.VOCABULARY)) or RANKS
    assert "".join(tokens.splitter()(s)) == s
    for w in tokens.splitter()(s):
        assert tokens.merge_word(w.encode(), ranks) == slow_merge(w.encode(), ranks)


RANKS: dict[bytes, int] = {}


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 9), min_size=1, max_size=3), max_size=40), st.binary(max_size=7))
def test_lexicon(words, other):
    lex = tokens.Lexicon.build(words)
    assert [lex.output(i) for i in lex.find(list(words)).tolist()] == list(words.values())
    if other not in words:
        assert lex.find([other])[0] == -1


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=200))
def test_words_ignore_marks(s):
    w = leak.words(s)
    assert all(x and x.isalnum() for x in w) and leak.words(None) == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB1 .@-(){}[]\n,+ß日🧲", max_size=300))
def test_forms_never_crash(s):
    spans = pii_forms.labelled_spans(s)
    assert all(0 <= a < b <= len(s) for a, b, _ in spans)
    for a, b, k in pii.checked(s, [(0, min(5, len(s)), k) for k in range(5) if s]):
        assert 0 <= a < b <= len(s) and 0 <= k < 5
