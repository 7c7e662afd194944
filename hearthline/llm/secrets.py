"""Secret scans with a trigram inverted index.

From each rule's regex a Boolean trigram query is derived: alternatives of sets of trigrams that every match holds. One
pass posts the queries' trigrams with the documents that hold them; the postings are intersected per alternative, and
only candidates are searched with the regex. A rule without mandatory trigrams scans all texts. Trigrams are of
lower-cased bytes, which can only add candidates.

Spans are in code points, end exclusive. Edge cases: null text is empty; without spans both digests are of / are the
empty text; rows that repeat an id are scanned each; rows with a null id are candidates of every rule; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from re import _constants as C
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.staging import keyed_join, stage
from hearthline.llm.textbytes import LOWER, slices, utf8


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 0  # characters of ``group``; shorter matches are dropped, but have been passed
    group: int = 0
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]+", 16),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("map_key", r"AIza[0-9A-Za-z_-]+", 39),
)
#: Sets of literal texts larger than this are not multiplied out.
MOST_TEXTS = 64

Query = frozenset  # of alternatives; an alternative is a frozenset of trigrams; an empty alternative holds always


def _grams(text: str) -> frozenset:
    raw = text.lower().encode()
    return frozenset(raw[i : i + 3] for i in range(len(raw) - 2))


def _exact(items) -> set[str] | None:
    """All texts that a run of regex items can be, if they are few."""
    texts = {""}
    for op, value in items:
        if op is C.LITERAL:
            own = {chr(value)}
        elif op is C.IN and all(o is C.LITERAL for o, _ in value):
            own = {chr(v) for _, v in value}
        elif op is C.SUBPATTERN:
            own = _exact(value[3])
        elif op is C.BRANCH:
            parts = [_exact(p) for p in value[1]]
            own = None if None in parts else set().union(*parts)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and tuple(value[:2]) == (0, 1):
            own = _exact(value[2])
            own = None if own is None else own | {""}
        else:
            own = None
        if own is None or len(own) * len(texts) > MOST_TEXTS:
            return None
        texts = {a + b for a in texts for b in own}
    return texts


def _both(x: Query, y: Query) -> Query:
    joined = Query(a | b for a in x for b in y)
    return joined if len(joined) <= MOST_TEXTS else min(x, y, key=len)


def _required(items) -> Query:
    """The longest literal stretches, each a set of texts, joined by AND; alternatives by OR."""
    needed, texts = Query([frozenset()]), {""}
    for item in items:
        op, value = item
        own = _exact([item])
        if own is not None and len(own) * len(texts) <= MOST_TEXTS:
            texts = {a + b for a in texts for b in own}
            continue
        needed, texts = _both(needed, Query(_grams(t) for t in texts)), own or {""}
        if own is not None:
            continue
        if op is C.SUBPATTERN:
            needed = _both(needed, _required(value[3]))
        elif op is C.BRANCH:
            needed = _both(needed, Query().union(*[_required(p) for p in value[1]]))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and value[0] >= 1:
            needed = _both(needed, _required(value[2]))
    return _both(needed, Query(_grams(t) for t in texts))


def trigram_query(pattern: str) -> Query:
    """Alternatives of trigrams, one of which every match holds whole."""
    query = _required(list(parser.parse(pattern)))
    # an alternative that holds another's trigrams and more says nothing new
    return Query(a for a in query if not any(b < a for b in query))


def scans_fully(rule: Rule) -> bool:
    return frozenset() in trigram_query(rule.pattern)


def postings(docs: DataFrame, grams: list[bytes]) -> DataFrame:
    """(gram, id): from (id, text), where each of the given trigrams occurs; gram is its place in the list."""
    mark = np.zeros(1 << 24, np.uint16)
    for k, g in enumerate(grams, 1):
        mark[g[0] << 16 | g[1] << 8 | g[2]] = k

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in slices(offsets):
                low = LOWER[data[offsets[i] : offsets[j]]].astype(np.uint32)
                if len(low) < 3:
                    continue
                hit = mark[(low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]]
                at = np.flatnonzero(hit)
                row = np.searchsorted(offsets[i : j + 1] - offsets[i], at, "right") - 1
                pair = np.unique(row * 65536 + hit[at])
                yield pa.RecordBatch.from_arrays([pa.array((pair % 65536 - 1).astype(np.int32)), batch.column(0).slice(i, j - i).take(pa.array(pair // 65536))], ["gram", "id"])

    if len(grams) > 65_535:
        raise ValueError("more than 65,535 trigrams in the rules")
    return docs.mapInArrow(run, "gram int, id long")


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(id, rules): from (id, text), the documents and the places of the rules whose queries their postings meet."""
    queries = {k: trigram_query(r.pattern) for k, r in enumerate(rules) if not scans_fully(r)}
    grams = sorted({g for q in queries.values() for a in q for g in a})
    place = {g: k for k, g in enumerate(grams)}
    held = postings(docs, grams).groupBy("id").agg(F.collect_set("gram").alias("held"))  # at most as many as trigrams

    def meets(query: Query) -> Column:
        out = F.lit(False)
        for alternative in sorted(query, key=sorted):
            want = F.array(*[F.lit(place[g]) for g in sorted(alternative)])
            out = out | (F.size(F.array_intersect("held", want)) == len(alternative))
        return out

    met = F.filter(F.array(*[F.when(meets(q), F.lit(k)) for k, q in queries.items()]), lambda x: x.isNotNull())
    return held.select("id", met.alias("rules")).where(F.size("rules") > 0)


def spans(text: str, rule: Rule, regex: re.Pattern) -> list[tuple[int, int]]:
    return [m.span() for m in regex.finditer(text) if len(m[rule.group]) >= rule.least]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED, base: int = len(BASE), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, counts (a number for each rule), base_sha256 (of the first ``base`` rules), spans."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = stage(candidates(d, rules), "secret-candidates")
    always = [k for k, r in enumerate(rules) if scans_fully(r)]
    everything = list(range(len(rules)))

    def run(batches):
        regexes = [r.compiled() for r in rules]
        for batch in batches:
            counts, digests, listed = [], [], []
            for doc_id, text, own in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                text = text.as_py() or ""
                hits = []
                for k in everything if doc_id is None else sorted({*always, *(own or ())}):
                    hits += [(a, k, b) for a, b in spans(text, rules[k], regexes[k])]
                hits.sort()
                line = [f"{rules[k].kind}:{a}:{b}" for a, k, b in hits]
                counts.append(np.bincount([k for _, k, _ in hits], minlength=len(rules)).tolist())
                digests.append(hashlib.sha256(",".join(x for x, (_, k, _) in zip(line, hits, strict=True) if k < base).encode()).hexdigest())
                listed.append(",".join(line))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.list_(pa.int64())), pa.array(digests, pa.string()), pa.array(listed, pa.string())], ["id", "counts", "base_sha256", "spans"])

    met = keyed_join(d, found, "id", "left")
    return met.select("id", "text", "rules").mapInArrow(run, "id long, counts array<long>, base_sha256 string, spans string").withColumnRenamed("id", id_col)
