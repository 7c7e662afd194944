"""Alignment of two tokenizers against whole-text encoding and a plain scan."""

import collections
import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from hearthline.llm import align
from tests.llm.tables import rows

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(docs):
    """Per row: n_a, n_b, groups as text, links."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte = align.byte_level_decoder()
    out = []
    for text in docs:
        if not text:
            out.append((0, 0, "", []))
            continue
        e = a.encode(" " + text, add_special_tokens=False)
        x = [(i, bytes(byte[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
        y = [(i, bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        if not all(b"".join(t for _, t in z) == (" " + text).encode() for z in (x, y)):
            out.append((0, 0, "", []))
            continue
        ends = []
        for z in (x, y):
            at, e_ = 0, []
            for _, t in z:
                at += len(t)
                e_.append(at)
            ends.append(e_)
        first, second = ({end: k + 1 for k, end in enumerate(e_)} for e_ in ends)
        groups, links, p, q = [], [], 0, 0
        for end in sorted(set(first) & set(second)):
            i, j = first[end], second[end]
            groups.append(",".join(str(k) for k, _ in x[p:i]) + "|" + ",".join(str(k) for k, _ in y[q:j]))
            links.append((x[i - 1][0], y[j - 1][0]))
            p, q = i, j
        out.append((len(x), len(y), ";".join(groups), links))
    counts = collections.Counter(pair for *_, links in out for pair in links)
    best = collections.defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return [(n, m, len(links), len(links), g, sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links)) for n, m, g, links in out]


def odd_texts():
    rng = random.Random(3)
    parts = [" ", "  ", "   ", "\n", "\t", "\r\n", "\n\n ", " \n", " ", "　", " ", "\x1c", "\x85", "​", "▁", "<s>", "</s>", "<unk>", "<|endoftext|>", "<0x0A>", "'s", "'ll", "I'm", "the", "The", "über", "naïve", "é", "日本語", "ﬁ", "\x00", "🙂", "👩‍👩‍👧", "12345", "3.14", "...", "?!", "--", "İ", "ß", "a", "b", "antidisestablishmentarianism", "x" * 40]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(1500)] + [p for p in parts] + [p + p for p in parts]


@pytest.mark.parametrize("most_pairs", [align.MOST_PAIRS, 10])
def test_alignment_equals_whole_encoding(spark, most_pairs):
    texts = [None, "", *odd_texts(), "same words again", "same words again", " ".join(f"word{k % 70} und" for k in range(20_000))]
    docs = rows(spark, [(k if k % 9 else None, t, k) for k, t in enumerate(texts)], "doc_id long, text string, pairs int")
    out = align.align_documents(docs, A, B, most_pairs=most_pairs).collect()
    expected = brute(texts)
    got = sorted(((r.doc_id or 0), r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) for r in out)
    assert got == sorted((k if k % 9 else 0, *e) for k, e in enumerate(expected)) and sum(e[0] > 0 for e in expected) > 1000 and sum(e[0] == 0 for e in expected) > 100
    digests = align.align_documents(docs.where("doc_id < 40"), A, B, digest=True).collect()
    assert {(r.doc_id, r.groups) for r in digests} == {(k, hashlib.sha256(e[4].encode()).hexdigest() if e[4] else "") for k, e in enumerate(expected[:40]) if k % 9}


def test_nothing_to_align(spark):
    assert align.align_documents(rows(spark, [], "doc_id long, text string"), A, B).collect() == []
    out = align.align_documents(rows(spark, [(1, None), (None, "")], "doc_id long, text string"), A, B, digest=True).collect()
    assert sorted((r.doc_id or 0, r.n_a, r.n_b, r.n_links, r.n_best, r.count_sum, r.groups) for r in out) == [(0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, "")]
