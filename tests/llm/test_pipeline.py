"""The pipeline stage by stage against plain Python."""

import random

import corpus_pipeline as P
import pytest

from hearthline.llm import decontaminate, mixing
from tests.llm.tables import rows
from tests.llm.test_texts import DOCS, brute_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    item = " ".join(word() for _ in range(20))
    docs = []
    for i in range(80):
        text = " ".join(word() for _ in range(rng.randint(10, 60)))
        if i % 10 == 3:
            text = docs[i - 1][1] + " tail"
        if i % 20 == 7:
            text += " " + item
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
    docs += [(200, None, "en", None, 0), (201, "12 34", None, "s1", 5), (202, "", "en", "s0", 0)]
    d = tmp_path_factory.mktemp("sf")
    rows(spark, docs, DOCS).write.parquet(f"{d}/documents.parquet")
    rows(spark, [(1, item), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), docs, item


def test_stages(spark, folder):
    d, docs, item = folder
    assert [n for n, _ in P.STAGES] == ["language_id", "near_dedup", "decontamination", "source_mix", "token_ids"]
    df = spark.read.parquet(f"{d}/documents.parquet")
    one = P.language(spark, df, d)
    assert one.columns == COLUMNS and {r.doc_id for r in one.collect()} == {i for i, t, *_ in docs if t and any(c.isalpha() for c in t)}
    two = P.near_dedup(spark, one, d)
    kept = {(i, t) for i, t, *_ in docs if t and any(c.isalpha() for c in t)}
    root = brute_components(sorted(kept))
    assert two.columns == COLUMNS and {r.doc_id for r in two.collect()} == {i for i, r in root.items() if i == r}
    three = P.decontamination(spark, two, d)
    assert three.columns == COLUMNS and {r.doc_id for r in three.collect()} == {r.doc_id for r in two.collect() if decontaminate.plain(item) not in decontaminate.plain(r.text)}
    four = P.mixture(spark, three, d)
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(three).collect()}
    assert four.columns == COLUMNS and {r[0]: r[1] for r in four.groupBy("doc_id").count().collect()} == {i: c for i, c in copies.items() if c}


def test_whole_run(spark, folder):
    out = P.run(spark, folder[0]).collect()
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert len(out) > 40
