"""Frequent keys and large groups: the ways that split them give the results of the plain versions."""

import random

import pytest

from offerloom.llm import jaccard, suffix
from tests.llm import corpus
from tests.llm.test_llm import docs, repeats, values  # noqa: F401


def bordered(seed=6):
    r = random.Random(seed)
    passage = "".join(r.choices("abc ", k=260))
    own = lambda n: "".join(r.choices("defgh ", k=n))
    near = [passage[: r.randrange(90, 130)] + r.choice("xyz") + passage[r.randrange(100, 140) :] for _ in range(25)]
    return [own(5) + passage + own(9), *[own(r.randrange(40)) + x + own(r.randrange(40)) for x in near], passage[50:150], passage * 3, "éa" * 300, "ab" * 400, passage[30:] + own(70), own(70) + passage[:140]]


@pytest.mark.parametrize("piece", [700, 1 << 17])
def test_contexts_of_frequent_anchors_are_split(spark, monkeypatch, piece):
    out = bordered()
    monkeypatch.setattr(suffix, "HOT", 0)
    monkeypatch.setattr(suffix, "PIECE", piece)
    monkeypatch.setattr(suffix, "ROWS", 3)
    found = corpus.by_id(suffix.remove_repeats(corpus.docs(spark, out, clash=False)))
    assert {k: (v["n_bytes"], v["n_removed"], v["n_spans"], bytes(v["kept"])) for k, v in found.items()} == repeats(dict(enumerate(out)))


def test_split_contexts_on_awkward_rows(spark, docs, values, monkeypatch):  # noqa: F811
    monkeypatch.setattr(suffix, "HOT", 2)
    found = corpus.by_id(suffix.remove_repeats(docs))
    assert {k: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for k, r in found.items()} == repeats(dict(enumerate(values)))


def families(seed=5):
    """Texts with few to many edits of a few originals: trees of near copies among texts that nearly link with them."""
    r = random.Random(seed)
    out = []
    for n, copies in ((150, 70), (60, 40), (12, 20)):
        base = corpus.words(r, n, 10**6)
        for k in range(copies):
            w = list(base)
            for _ in range(r.randrange(max(2, n // 12))):
                w[r.randrange(n)] = "e" + str(r.randrange(10**6))
            out += [" ".join(w)] * (1 + (k % 9 == 0))
    return out


@pytest.mark.parametrize("rounds", [0, 3])
def test_families_are_split_by_rare_shingles(spark, monkeypatch, rounds):
    out = families()
    monkeypatch.setattr(jaccard, "SMALL", 1)
    monkeypatch.setattr(jaccard, "HEAVY", 4)
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    found = corpus.by_id(jaccard.similar_groups(corpus.docs(spark, out, clash=False)))
    assert {k: (v["n_shingles"], v["component_id"]) for k, v in found.items()} == corpus.components(dict(enumerate(out)))
