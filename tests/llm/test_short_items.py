"""Benchmark items of less than 40 characters."""

import random

from hearthline.llm import decontaminate
from tests.llm.tables import rows
from tests.llm.test_texts import DOCS, edit_distance


def test_short_items_are_found(spark):
    items = [(1, "What is 7 times 6?"), (2, "forty-two"), (3, "Paris"), (4, "北京"), (5, ""), (6, None), (7, "c"), (8, "-5%")]
    docs = [(1, "ask: what  IS 7 times 6? now"), (2, "is it Forty-Two."), (3, "comparison"), (4, "(paris)"), (5, "我在北京市"), (6, "what is 7 timos 6?"), (7, "forty-twos"), (8, None), (9, "vitamin C, say"), (10, "at -5%"), (11, "cafe pariś")]
    d, b = rows(spark, [(i, t, "en", "s", 1) for i, t in docs], DOCS), rows(spark, items, "item_id long, text string")
    got = {(r.id, r.item): (r.edits, r.end) for r in decontaminate.find_leaks(d, b).collect()}
    assert got == {(1, 1): (0, 23), (2, 2): (0, 15), (4, 3): (0, 6), (5, 4): (0, 4), (6, 1): (1, 18), (9, 7): (0, 9), (10, 8): (0, 6)}
    assert {r.doc_id for r in decontaminate.drop_leaks(d, b).collect()} == {3, 7, 8, 11}


def test_items_of_13_to_60_characters_match_brute_force():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 5)))
    items = [(k, " ".join(word() for _ in range(30))[: 13 + k].strip() + "x") for k in range(48)]
    matcher, found = decontaminate.Matcher(items, decontaminate.ERROR_RATE), 0
    for _ in range(60):
        own = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 3)):
            p = rng.randrange(len(own))
            own[p : p + 1] = rng.choice(["", "y", own[p] + "z"])
        text = decontaminate.plain(" ".join([word(), "".join(own), word()]))
        want = {k: e for k, item in items if (e := edit_distance(item, text)) <= int(len(item) * decontaminate.ERROR_RATE)}
        assert {k: e for k, e, _ in matcher.find(text)} == want
        found += len(want)
    assert found > 20
