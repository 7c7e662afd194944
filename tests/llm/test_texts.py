"""Near duplicates, components, decontamination and languages against brute force, and their edge cases."""

import random
import re

import pytest

from hearthline.llm import components, decontaminate, langid, minhash, textbytes
from tests.llm.tables import rows

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, width=5):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def brute_components(docs, percent=85, width=5):
    sets = {i: [shingles(t, width) for j, t in docs if j == i] for i, _ in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def near_corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passage = [word() for _ in range(60)]
    docs, n = [], 0
    for _ in range(25):
        docs.append((n := n + 1, " ".join(word() for _ in range(rng.randint(1, 150)))))
    for _ in range(60):  # mostly one passage, else unlike
        docs.append((n := n + 1, " ".join([*passage, *(word() for _ in range(rng.randint(5, 60)))])))
    for _ in range(4):  # groups of near copies, some at the border
        base = [word() for _ in range(rng.randint(40, 300))]
        for _ in range(45):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = word()
            docs.append((n := n + 1, "\n ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy)))
    docs += [(n + 1, None), (n + 2, ""), (n + 3, "one two"), (n + 4, "ONE\ttwo"), (n + 5, " \n"), (n + 6, "x " * 30_000)]
    rng.shuffle(docs)
    return docs


def test_near_duplicates_match_brute_force(spark):
    docs = near_corpus()
    out = {r.doc_id: r for r in minhash.near_duplicates(rows(spark, docs, "doc_id long, text string")).collect()}
    want = brute_components(docs)
    assert {i: r.component_id for i, r in out.items()} == want
    assert all(out[i].n_shingles == len(shingles(t)) and out[i].kept == (want[i] == i) for i, t in docs)


def test_near_duplicates_edge_rows(spark):
    a, b = "the quick brown fox jumps over the lazy dog again", "some other words that are not like the first at all"
    docs = rows(spark, [(None, a), (5, a), (5, a), (5, b), (7, b), (2, a), (9, None)], "doc_id long, text string")
    out = minhash.near_duplicates(docs.selectExpr("doc_id", "text", "1 as node", "2 as sketch", "'x' as id", "3 as n")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in out) == [(0, 0, True), (2, 2, True), (5, 2, False), (5, 2, False), (5, 2, False), (7, 2, False), (9, 9, True)]
    assert minhash.near_duplicates(rows(spark, [], "doc_id long, text string")).count() == 0


def test_texts_that_polynomial_hashes_confuse_are_told_apart(spark):
    a, b = ("".join("ab"[(bin(i).count("1") + k) % 2] for i in range(1024)) for k in (0, 1))
    out = minhash.near_duplicates(rows(spark, [(1, a), (2, b), (3, b + " " + a)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id, r.set_id, r.kept) for r in out) == [(1, 1, 1, True), (2, 2, 2, True), (3, 3, 3, True)]


def test_one_id_with_several_sets_of_one_size(spark):
    a, b, c = "a b c d e f", "g h i j k l", "m n o p q r"
    docs = [(1, a), (1, b), (2, a), (3, b), (4, c), (1, a), (4, c)]
    out = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(rows(spark, docs, "doc_id long, text string")).collect()}
    assert out == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_drop_near_duplicates_keeps_columns(spark):
    docs = rows(spark, [(1, "a b c d e f", "en", "s", 11), (2, "A b c d e f", None, None, None), (3, "", "en", "s", 0)], DOCS)
    out = minhash.drop_near_duplicates(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_union_find(spark, seed, monkeypatch):
    monkeypatch.setattr(components, "CHUNK", 7)
    rng = random.Random(seed)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(80)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components.connected_components(rows(spark, edges, "a long, b long").repartition(9)).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}
    assert components.connected_components(rows(spark, [], "a long, b long")).count() == 0


def test_words_and_slices():
    import pyarrow as pa

    texts = ["Ab  c d\x0b e", "", None, "x", "ÄB äb\n"]
    data, offsets = textbytes.utf8(pa.array(["zzz", *texts]).slice(1))
    for i, j in textbytes.slices(offsets, 4):
        part, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = textbytes.words(part, own)
        for k in range(j - i):
            got = [part[a:b].tobytes().decode() for a, b in zip(starts[first[k] : first[k + 1]], ends[first[k] : first[k + 1]], strict=True)]
            assert got == re.findall(r"[^\x20\x09-\x0D]+", texts[i + k] or "")


def test_word_hashes_tell_words():
    import pyarrow as pa

    data, offsets = textbytes.utf8(pa.array(["Same same SAME", "eams same", "a b ab ba"]))
    starts, ends, _ = textbytes.words(data, offsets)
    h = textbytes.word_hashes(data, starts, ends).tolist()
    assert h[0] == h[1] == h[2] == h[4] and len(set(h)) == 6


def edit_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != t)))
        row = new
    return min(row)


def test_leaks_match_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(2, 6)))
    items = [(k, " ".join(word() for _ in range(rng.randint(10, 20)))) for k in range(12)] + [(50, None), (51, "short"), (52, "")]
    docs = []
    for n in range(60):
        text = [word() for _ in range(rng.randint(0, 40))]
        if n % 2:
            own = list(rng.choice(items[:12])[1])
            for _ in range(rng.randint(0, len(own) // 8)):
                p = rng.randrange(len(own))
                own[p : p + 1] = rng.choice(["", "x", own[p] + "y"])
            text.insert(rng.randint(0, len(text)), "".join(own).upper() if n % 3 else "".join(own).replace(" ", " \n"))
        docs.append((n, " ".join(text)))
    docs.append((99, None))
    got = {(r.id, r.item): r.edits for r in decontaminate.find_leaks(rows(spark, docs, "doc_id long, text string"), rows(spark, items, "item_id long, text string")).collect()}
    want = {}
    for i, t in docs:
        for k, item in items:
            p = decontaminate.plain(item)
            if len(p) >= decontaminate.MIN_CHARS and (e := edit_distance(p, decontaminate.plain(t))) <= int(len(p) * decontaminate.ERROR_RATE):
                want[i, k] = e
    assert got == want and len(want) > 10
    kept = decontaminate.drop_leaks(rows(spark, docs, "doc_id long, text string"), rows(spark, items, "item_id long, text string")).collect()
    assert {r.doc_id for r in kept} == {i for i, _ in docs} - {i for i, _ in want}


def test_leaks_in_blocks_and_empty(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 60)
    a, b = "a sentence that is long enough to be an item of a benchmark", "another sentence of a length that lets it be found as well"
    docs, items = rows(spark, [(1, "x " + a), (2, b + " y"), (3, "z")], "doc_id long, text string"), rows(spark, [(1, a), (2, b), (3, a)], "item_id long, text string")
    assert sorted((r.id, r.item) for r in decontaminate.find_leaks(docs, items).collect()) == [(1, 1), (1, 3), (2, 2)]
    assert [r.doc_id for r in decontaminate.drop_leaks(docs, items).collect()] == [3]
    none = rows(spark, [], "item_id long, text string")
    assert decontaminate.find_leaks(docs, none).count() == 0 and decontaminate.drop_leaks(docs, none).count() == 3
    assert decontaminate.find_leaks(rows(spark, [], "doc_id long, text string"), items).count() == 0


def language_docs(n=160):
    rng = random.Random(9)
    parts = {"de": "sch ung der und ein keit zu auf", "en": "the ing tion and of wh ly ed", "fr": "eau oi ment que les è des aux"}
    make = lambda lang, k: " ".join("".join(rng.choice(parts[lang].split()) for _ in range(rng.randint(1, 3))) for _ in range(k))
    return [(i, make(lang := rng.choice(list(parts)), rng.randint(20, 200)), lang) for i in range(n)], make


def test_languages_on_held_out_text(spark):
    docs, make = language_docs()
    docs += [(1000, None, "en"), (1001, "", None), (1002, "123 456 --", "de"), (1003, make("en", 300) + " " + make("fr", 300), None), (None, make("de", 90), None)]
    out = {r.doc_id: r for r in langid.detect_languages(rows(spark, docs, "doc_id long, text string, lang string")).collect()}
    held = [(i, lang) for i, _, lang in docs[:160] if out[i].held_out]
    assert len(held) > 20 and sum(out[i].lang_pred == lang for i, lang in held) >= 0.95 * len(held)
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (1000, 1001, 1002))
    assert sorted(out[1003].langs) == ["en", "fr"] and 0.3 < out[1003].score < 0.7
    assert out[None].lang_pred == "de" and all(0 <= r.score <= 1 for r in out.values())


def test_languages_without_labels_and_filter(spark):
    docs = rows(spark, [(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.detect_languages(docs).collect()] == [("und", 0.0)]
    assert langid.detect_languages(docs.where("false")).count() == 0
    known = rows(spark, [(k, t, "en", "s", 1) for k, t in enumerate(["the thing", "and so on", "12", None, "we are here"])], DOCS)
    out = langid.keep_identified(known)
    assert out.columns == known.columns and sorted(r.doc_id for r in out.collect()) == [0, 1, 4]
