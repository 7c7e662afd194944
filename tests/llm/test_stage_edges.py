"""Odd rows through each pipeline stage, clashing names, and two models against plain versions."""

import gc
import math
import random
import time

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest

from hearthline.llm import langid, sharding, staging, urls
from tests.llm.tables import rows
from hearthline.llm.textbytes import utf8
from tests.llm.test_texts import DOCS, language_docs

EXTRA = ", _copies int, _row string, _copy int, row int, n int, id string, node int, langs string, lang_pred int, size int, _text string"


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    long_ = " ".join(f"wort{k % 977}" for k in range(200_000))  # 1.5 MB
    texts = [(1, "the quick brown fox jumps over the dog"), (1, "the quick brown fox jumps over the dog"), (None, "the quick brown fox jumps over the dog"), (2, None), (3, ""), (4, " \n "), (5, long_), (6, long_ + " end"), (7, "12 34"), (None, "eine andere Zeile"), (8, "a benchmark item that must not be here, ever")]
    docs = [(i, t, "en" if k % 2 else None, None if k % 3 else "s", None, 5, "r", 3, 1, 2, "x", 3, "l", 4, 5, "t") for k, (i, t) in enumerate(texts)]
    d = str(tmp_path_factory.mktemp("odd"))
    rows(spark, [(1, "A benchmark item that must NOT be here"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return rows(spark, docs, DOCS + EXTRA), d, long_


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_with_odd_rows(spark, odd, name, tmp_path):
    df, d, long_ = odd
    stage = dict(corpus_pipeline.STAGES)[name]
    stage(spark, df, d).write.parquet(str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out"))
    got = sorted((r.doc_id or 0, r.n_tokens if name == "token_ids" else len(r.text or "")) for r in out.collect())
    size = {(r.doc_id or 0, len(r.text or "")) for r in df.collect()}
    if name == "token_ids":
        assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and len(got) == df.count() and got.count((2, 1)) == 1
    else:
        assert out.columns == df.columns and set(got) <= size
    fox, n = len("the quick brown fox jumps over the dog"), len(long_)
    if name == "language_id":
        assert [i for i, _ in got] == [0, 0, 1, 1, 5, 6, 8]
    if name == "near_dedup":  # one of the three, and of the two long ones the smaller id
        assert got == sorted([(1, fox), (2, 0), (3, 0), (4, 3), (5, n), (7, 5), (0, 17), (8, 44)])
    if name == "decontamination":
        assert len(got) == df.count() - 1 and 8 not in [i for i, _ in got]
    if name == "source_mix":
        assert {(2, 0), (3, 0), (4, 3)} <= set(got) and all(got.count(x) <= 4 for x in got)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_with_no_rows(spark, odd, name):
    df, d, _ = odd
    out = dict(corpus_pipeline.STAGES)[name](spark, df.where("false"), d)
    assert out.count() == 0 and (name == "token_ids" or out.columns == df.columns)


def test_interleaved_runs_leave_each_other_alone(spark, odd, tmp_path):
    """Two runs stage by stage in turn: both results stand, token files too, whatever the other one does."""
    df, d, _ = odd
    settings = spark.conf.get(corpus_pipeline.BATCH_SETTING)
    one, two = df, df.where("doc_id < 5")
    for _, stage_of in corpus_pipeline.STAGES:
        one, two = stage_of(spark, one, d), stage_of(spark, two, d)
    seen = [sorted(map(str, x.collect())) for x in (one, two)]
    corpus_pipeline.token_ids(spark, df.where("doc_id = 8"), d).collect()
    spark._jvm.System.gc()
    staging.sweep(spark)
    assert [sorted(map(str, x.collect())) for x in (one, two)] == seen and len(seen[0]) > len(seen[1]) > 0
    assert spark.conf.get(corpus_pipeline.BATCH_SETTING) == settings


def test_staged_tables_go_when_nobody_reads_them(spark):
    held = staging.stage(spark.range(10).toDF("x"), "held")
    derived, path = held.where("x > 3"), held._hearthline_path
    gone = staging.stage(spark.range(10).toDF("x"), "gone")
    gone_path = gone._hearthline_path
    assert gone.count() == 10
    del gone, held
    for _ in range(20):
        gc.collect()
        spark._jvm.System.gc()
        staging.sweep(spark)
        if gone_path not in staging._standing:
            break
        time.sleep(0.2)
    assert gone_path not in staging._standing and path in staging._standing and derived.count() == 6


def test_clashing_names_of_shards(spark, tmp_path):
    docs = rows(spark, [(1, "a", 2, "b"), (None, "c", 3, "d")], "doc_id long, slot string, _slot int, shard string")
    out = sharding.place(docs)
    assert out.columns == ["doc_id", "slot", "_slot", "shard", "slot_", "shard_"]
    assert {(r.slot, r._slot, r.shard) for r in out.collect()} == {("a", 2, "b"), ("c", 3, "d")}
    sharding.write_sharded(docs, str(tmp_path / "out"))
    assert {r._slot for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {2, 3}


def test_more_labels_than_one_table_had_room_for(spark):
    docs = [(i, f"wort{i} text{i % 7} und so weiter", f"l{i:03d}") for i in range(600)]
    out = langid.detect_languages(rows(spark, docs, "doc_id long, text string, lang string")).collect()
    assert len(out) == 600 and {r.lang_pred for r in out} <= {x for _, _, x in docs}


def plain_mixture(text, table):
    """The proportions of one text, trigram by trigram."""
    data = b" " + bytes(langid._CLASS[b] for b in text.encode()) + b" "
    counts = {}
    for k in range(len(data) - 2):
        a, b, c = data[k : k + 3]
        if (a, b) != (32, 32) or c != 32:
            if not (b == 32 and a == 32 and c == 32):
                bucket = ((((a << 16) | (b << 8) | c) * 0x9E3779B1) & 0xFFFFFFFF) >> 18
                counts[bucket] = counts.get(bucket, 0) + 1
    languages, total = table.shape[1], sum(counts.values())

    def em(allowed):
        share = [1 / len(allowed) if x in allowed else 0.0 for x in range(languages)]
        for _ in range(langid.ROUNDS):
            new = [0.0] * languages
            for b, n in counts.items():
                joint = [share[x] * math.exp(table[b, x]) for x in range(languages)]
                for x in range(languages):
                    new[x] += n * joint[x] / sum(joint)
            share = [x / total for x in new]
        return share, sum(n * math.log(sum(share[x] * math.exp(table[b, x]) for x in range(languages))) for b, n in counts.items())

    full, _ = em(range(languages))
    order = sorted(range(languages), key=lambda x: (-full[x], x))
    cost = langid.PENALTY * math.log(total + 1)
    single = [sum(n * float(table[b, x]) for b, n in counts.items()) for x in range(languages)]
    best = max(range(languages), key=lambda x: (single[x], -x))
    score, chosen = single[best], [float(x == best) for x in range(languages)]
    for size in range(2, languages + 1):
        share, reached = em(order[:size])
        if reached - (size - 1) * cost > score:
            score, chosen = reached - (size - 1) * cost, share
    return chosen


def test_mixtures_match_a_plain_version(spark):
    docs, make = language_docs(60)
    names, table = langid.train(rows(spark, docs, "doc_id long, text string, lang string"))
    assert names == ["de", "en", "fr"]
    texts = [make("en", 80), make("de", 3), make("en", 60) + " " + make("fr", 90), make("de", 70) + make("fr", 70) + make("en", 70), "x", "12 ab 34", make("fr", 40) + " " + make("de", 8)]
    data, offsets = utf8(pa.array(texts))
    got = langid.mixtures(data, offsets, table)
    for text, share in zip(texts, got, strict=True):
        assert share.tolist() == pytest.approx(plain_mixture(text, table), abs=2e-3), text
    assert (got > 0).sum(1).tolist()[2:4] == [2, 3]


def plain_grams(host, path):
    out = []
    for kind, text in enumerate((host, path)):
        for size in urls.SIZES:
            for k in range(len(text) + 2 - size + 1):
                key = 10 * size + kind
                for c in f" {text} "[k : k + size]:
                    key = (key * 0x9E3779B97F4A7C15 + ord(c)) % (1 << 64)
                for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                    key = ((key ^ (key >> shift)) * times) % (1 << 64)
                out.append((key ^ (key >> 31)) % urls.BUCKETS)
    return out


def test_the_regression_matches_a_plain_version(spark):
    rng = random.Random(4)
    table = [(rng.choice(["shop.example.net", "né.example.org", "news.test", ""]), rng.choice(["/en/a", "/fr/ü", "/", ""]) + rng.choice(["", "x", "yz"])) for _ in range(40)]
    table = sorted({(h, p, "net" in h or "fr" in p) for h, p in table})
    weights, bias = urls.train(rows(spark, table, "host string, path string, blocks boolean"))
    grams = [plain_grams(h, p) for h, p, _ in table]
    w, c = {}, 0.0
    score = lambda g: sum(w.get(x, 0.0) for x in g) / math.sqrt(max(1, len(g))) + c
    for step in range(200):
        slope = [(1 / (1 + math.exp(-score(g))) - y) / len(table) for g, (*_, y) in zip(grams, table, strict=True)]
        now, change = 20 / (1 + step / 50), {}
        for g, s in zip(grams, slope, strict=True):
            for x in g:
                change[x] = change.get(x, 0.0) + s / math.sqrt(max(1, len(g)))
        w = {x: w.get(x, 0.0) - now * (change.get(x, 0.0) + 1e-4 * w.get(x, 0.0)) for x in set(w) | set(change)}
        c -= now * sum(slope)
    assert bias == pytest.approx(c, rel=1e-6)
    assert all(weights[x] == pytest.approx(w[x], rel=1e-6, abs=1e-9) for x in w) and np.count_nonzero(weights) <= len(w)
