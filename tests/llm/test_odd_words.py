"""Ids of odd words: such as lower-casing or composing turns into more than letters, and such as simple hashes confuse."""

import random

import numpy as np
import pytest

from hearthline.llm import tokens
from hearthline.llm.textbytes import WordNumbers, utf8, word_hashes, words

tokenizer = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_ids_are_those_of_the_whole_text():
    import pyarrow as pa
    from tokenizers import Tokenizer

    texts = ["ŞİMDİ.", "DENİZCİ, geldi", "İ İ. İ., .İ", "plain words. more, end.", "ŞİMDİ ve İSTANBUL", "क़क. क़, x", "été. ΣΑΣ. ǅ, ŉ. ß.", None, ""]
    data, offsets = utf8(pa.array(texts))
    whole, coder = Tokenizer.from_file(tokenizer), tokens.Encoder(tokenizer)
    for _ in range(2):  # as they are learned, and as they are remembered
        ids, n = coder.encode(data, offsets)
        for text, own in zip(texts, np.split(ids, np.cumsum(n)[:-1]), strict=True):
            assert own.tolist() == whole.encode(text or "", add_special_tokens=False).ids, text


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_words_that_polynomial_hashes_confuse_are_told_apart():
    import pyarrow as pa
    from tokenizers import Tokenizer

    texts = [f"{thue_morse(1024, x)} {thue_morse(1024, x[::-1])}" for x in ("ab", "xy")] + ["a" * 300 + " " + "a" * 299 + "b", "\x00 \x00\x00", "abcdefgh abcdefgh\x00"]
    data, offsets = utf8(pa.array(texts))
    whole = Tokenizer.from_file(tokenizer)
    ids, n = tokens.Encoder(tokenizer).encode(data, offsets)
    for text, own in zip(texts, np.split(ids, np.cumsum(n)[:-1]), strict=True):
        assert own.tolist() == whole.encode(text, add_special_tokens=False).ids
    starts, ends, _ = words(data, offsets)
    one, two = word_hashes(data, starts, ends, 1), word_hashes(data, starts, ends, 2)
    assert len(set(one.tolist())) == len(set(two.tolist())) == len(starts) and not set(one.tolist()) & set(two.tolist())


def test_word_numbers_are_those_of_a_dict():
    import pyarrow as pa

    rng, numbers, known = random.Random(3), WordNumbers(), {}
    for _ in range(30):
        batch = list(dict.fromkeys(bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(1, 24))) for _ in range(400)))
        column = pa.array([b"unused", *batch], pa.binary()).slice(1)
        assert numbers.find(column).tolist() == [known.get(w, -1) for w in batch]
        new = [w for w in batch if w not in known]
        known |= dict(zip(new, numbers.add(pa.array(new, pa.binary())).tolist(), strict=True))
    assert len(numbers) == len(known) and sorted(known.values()) == list(range(len(known)))
