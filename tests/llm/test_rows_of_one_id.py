"""Stages over rows that repeat an id or have none."""

from collections import Counter

import corpus_pipeline
import pytest

from hearthline.llm import minhash
from tests.llm.tables import rows
from tests.llm.test_models import waterfill
from tests.llm.test_texts import DOCS


def test_the_mix_is_taken_row_by_row(spark):
    docs = [(None, f"a{i}" + " w" * 9, "en", "a", 1) for i in range(90)] + [(i, f"{s}{i}" + " w" * 9, "en", s, 1) for s in "bc" for i in range(90)]
    docs += [(500 + i // 2, "same" + " w" * 9, "en", "b", 1) for i in range(60)]
    df = rows(spark, docs, DOCS)
    want = waterfill({"a": 900, "b": 1500, "c": 900}, (3, 1, 2), 1.5, 2)
    out = corpus_pipeline.mixture(spark, df, "")
    assert out.columns == df.columns
    taken = Counter(r.source for r in out.collect())
    assert all(10 * taken[s] == pytest.approx(want[s], abs=10) for s in "abc")


def test_one_row_of_each_group_stays(spark):
    a, b = "the quick brown fox jumps over the lazy dog again", "some other words that are not like the first at all"
    docs = rows(spark, [(None, a, "en", "s", 1), (5, a, "en", "t", 1), (5, a, "en", "t", 1), (5, b, "en", "s", 1), (7, b, "en", "s", 1), (None, "quite alone here", "en", "s", 1), (None, "quite alone here", "en", "s", 1)], DOCS)
    out = minhash.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [(0, "quite alone here"), (5, b), (5, a)]
