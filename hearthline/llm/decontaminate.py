"""Benchmark decontamination by pigeonhole edit matching.

Texts are lower-cased and their white space is made single blanks. An item of n characters allows e = n * rate edits,
so if it occurs in a document with at most e edits, one of its e + 1 pieces occurs unchanged: exact piece hits (one
automaton over all items' pieces) give the places, and Myers' bit-parallel distance verifies each. An item too short
for an edit is one whole piece; it must not stand within a longer word (scripts that write words without blanks have
no such borders).

Edge cases: null or empty texts and items match nothing; equal items are reported each; ids may repeat (one row per
document row and item) or be null; of several places with the fewest edits the first is told; a very long text is
searched whole, with memory in proportion to it; an empty table of either kind gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import re
import unicodedata

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.textbytes import tidy

ERROR_RATE = 0.08
#: Items with fewer characters, which are the empty ones, match nothing.
MIN_CHARS = 1
#: Letters of scripts that set no blanks between words: Thai, Lao, Tibetan, Burmese, Khmer, kana, Han.
UNSPACED = re.compile("[\u0e00-\u109f\u1780-\u17ff\u2e80-\ua4cf\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
#: Characters of items held by one automaton; more items are matched block by block.
BLOCK_CHARS = 4_000_000


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def _in_word(c: str) -> bool:
    return (c.isalnum() or c == "_" or unicodedata.category(c)[0] == "M") and not UNSPACED.match(c)


def bordered(text: str, a: int, b: int) -> bool:
    """Whether text[a:b] begins and ends where words do."""
    return not (a > 0 and _in_word(text[a - 1]) and _in_word(text[a])) and not (b < len(text) and _in_word(text[b - 1]) and _in_word(text[b]))


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """The item cut into ``errors`` + 1 parts of nearly equal length, with their places."""
    cuts = [len(item) * k // (errors + 1) for k in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def nearest(peq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any substring of ``text``, and where the first such ends (Myers 1999)."""
    ones, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = ones, 0, m, m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | (~(xh | pv) & ones), pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph, mh = (ph << 1) & ones, (mh << 1) & ones
        pv, mv = mh | (~(xv | ph) & ones), ph & xv
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """Finds all items of one block in a text."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items, where = [], {}
        for item_id, raw in items:
            text = plain(raw)
            if len(text) < MIN_CHARS:
                continue
            errors = int(len(text) * rate)
            for at, piece in pieces(text, errors):
                where.setdefault(piece, []).append((len(self.items), at))
            self.items.append((item_id, text, errors, masks(text)))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, edits, end in the plain text) for each item that occurs."""
        if not self.items:
            return []
        text, windows = plain(text), {}
        for end, (length, places) in self.automaton.iter(text):
            for k, at in places:
                windows.setdefault(k, set()).add(end + 1 - length - at)
        out = []
        for k, starts in windows.items():
            item_id, item, errors, peq = self.items[k]
            if not errors:  # one whole piece: its hits are exact
                ends = [s + len(item) for s in starts if bordered(text, s, s + len(item))]
                if ends:
                    out.append((item_id, 0, min(ends)))
                continue
            found, upto, run = None, -1, None
            merged = []
            for s in sorted(starts):  # places whose windows overlap are verified in one go
                a, b = max(0, s - errors), s + len(item) + errors
                if run and a <= run[1]:
                    run[1] = b
                else:
                    run = [a, b]
                    merged.append(run)
            for a, b in merged:
                edits, end = nearest(peq, len(item), text[a:b])
                if edits <= errors and (found is None or edits < found):
                    found, upto = edits, a + end
            if found is not None:
                out.append((item_id, found, upto))
        return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> list[DataFrame]:
    chars = benchmark.agg(F.sum(F.length(text_col))).first()[0] or 0
    n = 1 + int(chars // BLOCK_CHARS)
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    return [items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k) for k in range(n)] if n > 1 else [items]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rate: float = ERROR_RATE) -> DataFrame:
    """One row per document and item found in it: id, item, edits, end (in the plain text)."""
    out = None
    for block in _blocks(benchmark, item_col, item_text):
        items = block.toArrow()  # at most about BLOCK_CHARS
        shared = docs.sparkSession.sparkContext.broadcast(list(zip(items["item"].to_pylist(), items["text"].to_pylist(), strict=True)))

        @tidy
        def run(batches, shared=shared):
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                rows = [(d, *hit) for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for hit in matcher.find(t.as_py())]
                if rows:
                    ids, item, edits, end = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(item, pa.int64()), pa.array(edits, pa.int32()), pa.array(end, pa.int64())], ["id", "item", "edits", "end"])

        found = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, item long, edits int, end long")
        out = found if out is None else out.unionByName(found)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rate: float = ERROR_RATE) -> DataFrame:
    """The documents, all columns as they are, in which no item occurs. One pass per block of items."""
    at = docs.columns.index(text_col)
    for block in _blocks(benchmark, item_col, item_text):
        items = block.toArrow()
        shared = docs.sparkSession.sparkContext.broadcast(list(zip(items["item"].to_pylist(), items["text"].to_pylist(), strict=True)))

        @tidy
        def run(batches, shared=shared):
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                yield batch.filter(pa.array([not matcher.find(t.as_py()) for t in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
