"""Removal of repeated passages, against brute force in plain Python."""

from __future__ import annotations

import hashlib
import random

import pytest

from shelfmark.llm import queries, substrings
from tests.llm.conftest import DATA


def brute(docs, window):
    """docs: (doc_id, text), ids unique. doc_id -> (words, removed, digest)."""
    seen, found = {}, {}
    for doc, text in sorted(docs):
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            if w in seen:
                gone.update(range(i, i + window))
            seen.setdefault(w, doc)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        found[doc] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return found


def as_found(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


def test_repeats_match_brute_force(spark, documents):
    got, want = as_found(queries.op8_suffix_tree_repeats(spark, DATA)), brute(documents, 20)
    assert got == want and sum(n > 0 for _, n, _ in want.values()) > 50


@pytest.mark.parametrize("group, block", [(40, 3), (1_000_000, 2048)])
def test_small_groups_and_hot_prefixes(spark, monkeypatch, group, block):
    """Frequent prefixes are lengthened; overlapping and nested repeats come out right whatever the groups."""
    monkeypatch.setattr(substrings, "GROUP_SUFFIXES", group)
    monkeypatch.setattr(substrings, "BLOCK_ROWS", block)
    rng = random.Random(3)
    line = " ".join(rng.choice("ab") for _ in range(30))
    docs = [(d, " ".join([line[:2 * rng.randrange(1, 31) - 1], *(rng.choice("abc") for _ in range(rng.randrange(40))), line])) for d in range(60)]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert as_found(substrings.remove_repeats(df, 6)) == brute(docs, 6)


def test_repeats_of_awkward_rows(spark, awkward, nothing):
    rows = substrings.remove_repeats(awkward, 3).collect()
    assert len(rows) == awkward.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [(r.n_words, r.n_removed, r.kept_text) for d in (1, 2, 4) for r in by[d]] == [(0, 0, "")] * 3
    assert by[3][0] == by[3][1]
    assert by[None][0].kept_text == "one two three" and by[7][0].n_removed == 0
    assert (by[5][0].n_words, by[5][0].kept_text) == (9, "a b c")
    assert substrings.remove_repeats(nothing).count() == 0
