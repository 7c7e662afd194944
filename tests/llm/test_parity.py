"""The parity-sketch join: its bounds, and its components against all pairs."""

import random

import numpy as np
import pytest

from hearthline.llm import minhash, parity
from hearthline.llm.textbytes import U64
from tests.llm.tables import rows
from tests.llm.test_texts import brute_components


def sets(rng, n, differ):
    x = rng.integers(1, 1 << 62, n + differ, dtype=np.uint64)
    return np.sort(x[:n]), np.sort(x[differ:])


def plain_hamming(a, b):
    size = min(len(a), len(b))
    fold = lambda x: x if len(x) == size else x[:size] ^ x[size:]
    return int(np.bitwise_count(fold(a) ^ fold(b)).sum())


@pytest.mark.parametrize("percent", [60, 85, 95])
def test_bounds_hold(percent):
    rng, bands = np.random.default_rng(4), parity.Bands(percent)
    met = 0
    for _ in range(1200):
        n = int(rng.integers(2, 400))
        a, b = sets(rng, n, int(rng.integers(0, 1 + n // 4)))
        b = b[: len(b) - int(rng.integers(0, 1 + n // 9))]
        both = len(np.intersect1d(a, b))
        differ = len(a) + len(b) - 2 * both
        assert plain_hamming(parity.dense_sketch(a), parity.dense_sketch(b)) <= differ
        if 100 * both < percent * (len(a) + len(b) - both) or not differ:
            continue
        assert differ <= parity.difference(len(a), len(b), percent)
        # in the smaller one's band, all but so many pieces are shared
        k = int(np.searchsorted(bands.last, min(len(a), len(b))))
        (m, d), (_, e) = ({j: (m, d) for j, m, d in bands.of(len(x))}[k] for x in (a, b))
        equal = int((parity.piece_digests(a, k, m) == parity.piece_digests(b, k, m)).sum())
        assert equal >= m - min(d, e) and equal >= m - differ
        met += 1
    assert met > 20


def documents():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 5)))
    passage, docs = [word() for _ in range(60)], []
    for _ in range(30):
        base = [word() for _ in range(rng.choice((3, 4, 6, 9, 20, 45, 120, 300)))]
        docs.append(base)
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 2)] = [word() for _ in range(rng.randint(0, 2))]
            docs.append(copy)
        if rng.random() < 0.4:
            docs.append(passage + base)
    near = [word() for _ in range(80)]
    docs += [near[:k] + [word()] + near[k + 1 :] for k in range(60)]  # one large group of near copies
    texts = [" ".join(d).upper() if k % 7 == 0 else "\t".join(d) for k, d in enumerate(docs)]
    return [*texts, None, "", " \n ", texts[3], "one two three"]


def test_components_equal_those_of_all_pairs(spark):
    texts = documents()
    out = parity.similar_documents(rows(spark, [(k, t, k, "x") for k, t in enumerate(texts)], "doc_id long, text string, node int, sketch string")).collect()
    expected = brute_components([(k, t) for k, t in enumerate(texts)], width=4)
    assert {r.doc_id: r.component_id for r in out} == expected and len(set(expected.values())) < len(texts) - 90


def test_odd_rows(spark):
    long_ = " ".join(f"wort{k % 977}" for k in range(100_000))
    same = "the quick brown fox jumps over the dog"
    docs = [(1, same), (1, same), (1, long_), (None, same), (None, None), (2, same), (3, long_ + " end"), (4, ""), (5, "a b"), (6, "A  b")]
    out = parity.similar_documents(rows(spark, docs, "doc_id long, text string")).collect()
    got = sorted((r.doc_id or 0, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in out)
    n = len({tuple(f"wort{(k + j) % 977}" for j in range(4)) for k in range(977)}) + len({tuple(f"wort{k % 977}" for k in range(99_996, 100_000))}) * 0
    many = sorted(x for _, x, _ in got)[-1]
    assert got == sorted([(1, 5, 1), (1, 5, 1), (1, many - 1, 1), (0, 5, -1), (0, 0, -1), (2, 5, 1), (3, many, 1), (4, 0, 4), (5, 1, 5), (6, 1, 5)]) and many >= n
    assert parity.similar_documents(rows(spark, [], "doc_id long, text string")).collect() == []


def test_sketches_are_of_sets():
    x = np.arange(1, 60, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)
    assert (parity.piece_digests(x, 3, 9) == parity.piece_digests(x[::-1].copy(), 3, 9)).all() and minhash.digests(x, x) == minhash.digests(x[::-1].copy(), x)
