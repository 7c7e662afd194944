"""Alignment of two tokenizers' ids over the same texts, a byte-level one (A) and one of pieces (B).

1. Both tokenize each text whole, A with the space before it that B adds itself. Neither joins what stands before a space
   with the space, so a text falls into chunks, each a space and what follows up to the next, whose ids a worker
   remembers; texts with other than ASCII white space are one chunk, for A's pattern may join such with spaces.
2. A chunk counts if the bytes of its tokens are its own under both. The bytes at which a token that begins with a space
   starts under both tokenizers, where the tokens before it thus end together, are anchors. They split a document's
   tokens into windows of a few ids.
3. The alignment of a window depends on its ids alone, so it is remembered by the two tuples of ids: groups cut where
   tokens of both end together, and the links, which are the pairs of tokens that end together.
4. Links are counted over all documents, and each document sums up what its own links count. The table of counts is
   broadcast up to MOST_PAIRS pairs; a larger one meets the documents' distinct pairs in a shuffle.

Edge cases: null and empty texts, and those that a tokenizer does not give back byte for byte, have no tokens and no
links; strings of special tokens in texts are plain text; very long texts are worked on alone; null or repeated ids stand
for rows of their own; ties among a B id's most frequent partners all count as best; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.staging import stage, unstage
from hearthline.llm.textbytes import IS_SPACE, WordNumbers, dealt, slices, texts, tidy, utf8

#: Bytes of text whose chunks are looked up together, and of chunks that a worker remembers before it starts anew.
LOOK_UP_BYTES, CACHE_BYTES = 1 << 20, 3 << 20
#: Windows whose alignments a worker remembers, and the ids of the longest.
CACHE_WINDOWS, WINDOW_IDS = 400_000, 256
#: Linked pairs up to which their counts are broadcast (24 bytes each).
MOST_PAIRS = 2_000_000
SPACE_MARK = "▁"
#: Bytes of white space that is not ASCII's, of control characters that some count as such, and of the mark itself.
ODD = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a|\xe1\xa0|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe2\x96\x81|\xe3\x80|[\x1c-\x1f]")


def byte_level_decoder() -> dict[str, int]:
    """The byte of each character that byte-level vocabularies write: printable ones of Latin-1 stand for themselves, the
    others, in order, for the characters from U+0100 on."""
    own = [b for b in range(256) if chr(b).isprintable() and b != 0x20]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokens:
    """A vocabulary: each id's bytes, how many they are, whether they begin with a space, and the id as text."""

    def __init__(self, tokens: list[bytes]):
        self.bytes, self.size = np.frombuffer(b"".join(tokens), np.uint8), np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.spaced = np.array([t[:1] == b" " for t in tokens], bool)
        self.text = np.array([str(k) for k in range(len(tokens))], object)

    def give_back(self, ids: np.ndarray, n: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of texts with so many ids each, whether the ids' bytes are the texts', which stand in ``data`` behind each other."""
        own = np.diff(np.concatenate(([0], np.cumsum(self.size[ids])))[np.concatenate(([0], np.cumsum(n)))])
        good = own == sizes
        ids, text = ids[np.repeat(good, n)], data[np.repeat(good, sizes)]
        wrong = dealt(self.bytes, self.at[ids], self.size[ids]) != text
        good[np.repeat(np.flatnonzero(good), sizes[good])[wrong]] = False
        return good


class Tokenizers:
    """Both tokenizers, their tokens' bytes, and the ids of the chunks known so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        byte, vocabulary = byte_level_decoder(), self.a.get_vocab(with_added_tokens=True)
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            a_bytes[i] = t.encode() if t in special else bytes(byte[c] for c in t)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
        # a piece with a space behind something else would reach from chunk to chunk
        self.parts = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
        self.space = self.b.piece_to_id(SPACE_MARK)
        self.tokens = Tokens(a_bytes), Tokens(b_bytes)
        self.forget()

    def forget(self) -> None:
        self.known, self.held, self.good = WordNumbers(), 0, np.zeros(0, bool)
        #: Of each tokenizer, all chunks' ids one behind the other, and where each chunk's end.
        self.pools, self.upto = [np.zeros(0, np.int64)] * 2, [np.zeros(1, np.int64)] * 2

    def _in_one_go(self, text: str, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids of chunks of these sizes that stand one behind the other, by each tokenizer: all ids, and how many each has.
        None if ids do not end where chunks do."""
        out, ends = [], np.cumsum(sizes)
        made = self.a.encode(text, add_special_tokens=False).ids, self.b.encode(text[1:], num_threads=1)  # B adds the first space
        for ids, own in zip(made, self.tokens, strict=True):
            ids = np.array(ids, np.int64)
            upto = np.cumsum(own.size[ids])
            last = np.searchsorted(upto, ends)
            if not len(upto) or upto[-1] != ends[-1] or (upto[last] != ends).any():
                return None
            out.append((ids, np.diff(last, prepend=-1)))
        return out

    def _singly(self, text: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        a = [e.ids for i in range(0, len(text), 5000) for e in self.a.encode_batch_fast(text[i : i + 5000], add_special_tokens=False)]
        b = [ids if t != " " else [self.space] for t, ids in zip(text, self.b.encode([t[1:] for t in text], num_threads=1), strict=True)]
        return [(np.array([x for i in made for x in i], np.int64), np.array([len(i) for i in made], np.int64)) for made in (a, b)]

    def _learn(self, chunks: pa.Array) -> np.ndarray:
        """Chunks that white space ends, or that hold other white space, are no neighbours for others; these are encoded many
        at a time."""
        raw, text = chunks.to_pylist(), texts(chunks)
        plain = np.array([len(r) <= 256 and not r[-1:].isspace() and not ODD.search(r) for r in raw], bool)
        parts = []
        for k in range(0, len(raw), 20_000):
            for at, joined in ((np.flatnonzero(plain[k : k + 20_000]) + k, True), (np.flatnonzero(~plain[k : k + 20_000]) + k, False)):
                if len(at):
                    own = [text[x] for x in at.tolist()]
                    made = self._in_one_go("".join(own), np.array([len(raw[x]) for x in at.tolist()])) if joined else None
                    parts.append((at, made or self._singly(own)))
        order = np.concatenate([at for at, _ in parts])
        number = np.empty(len(raw), np.int64)
        number[order] = self.known.add(chunks.take(pa.array(order)))
        for k in range(2):
            ids, n = (np.concatenate([made[k][x] for _, made in parts]) for x in range(2))
            self.pools[k] = np.concatenate((self.pools[k], ids))
            self.upto[k] = np.concatenate((self.upto[k], self.upto[k][-1] + np.cumsum(n)))
        data, sizes, good = np.frombuffer(b"".join([raw[x] for x in order.tolist()]), np.uint8), np.array([len(raw[x]) for x in order.tolist()], np.int64), np.ones(len(raw), bool)
        for k, own in enumerate(self.tokens):
            ids, n = (np.concatenate([made[k][x] for _, made in parts]) for x in range(2))
            good &= own.give_back(ids, n, data, sizes)
        self.good = np.concatenate((self.good, good))
        self.held += sum(map(len, raw))
        return number

    def numbers(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The numbers of the chunks that start there; new ones are learned."""
        offsets = np.append(starts, len(data)).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary())
        number = self.known.find(distinct)
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = self._learn(distinct.take(pa.array(new)))
        return number[coded.indices.to_numpy()]


def _other_spaces(data: np.ndarray) -> np.ndarray:
    """Where white space other than ASCII's begins, and the control characters that some count as such."""
    x = np.concatenate((data, np.zeros(2, np.uint8)))
    a, b, c = x[:-2], x[1:-1], x[2:]
    three = (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
    return three | ((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0xE1) & ((b == 0x9A) | (b == 0xA0))) | ((a == 0xE3) & (b == 0x80)) | ((a >= 0x1C) & (a <= 0x1F))


def group_ends(ends: list[np.ndarray]) -> list[np.ndarray]:
    """From the bytes at which the tokens of both sequences end: the places of the tokens that end together."""
    mark = np.zeros(int(ends[0][-1]) + 1 if len(ends[0]) else 1, bool)
    mark[ends[0]] = True
    second = np.flatnonzero(mark[ends[1]])
    return [np.searchsorted(ends[0], ends[1][second]), second]


class Aligner:
    """Windows' alignments by their ids: the groups as text, and the linked pairs."""

    def __init__(self, tokenizers: Tokenizers):
        self.t, self.width = tokenizers, len(tokenizers.tokens[1].size)
        self._forget()

    def _forget(self) -> None:
        self.t.forget()
        self.memo: dict[bytes, int] = {}
        self.groups: list[str] = []
        #: All windows' linked pairs one behind the other, and where each window's end.
        self.pairs, self.upto = np.zeros(0, np.int64), np.zeros(1, np.int64)
        #: The window of each known chunk that is one.
        self.of_chunk = np.zeros(0, np.int64)

    def _align(self, ids: list[np.ndarray], starts: list[np.ndarray], sizes: list[np.ndarray]) -> None:
        """Aligns windows, given by where their ids start in both sequences and how many they are."""
        own = [dealt(x, s, n) for x, s, n in zip(ids, starts, sizes, strict=True)]
        last = group_ends([np.cumsum(t.size[x]) for t, x in zip(self.t.tokens, own, strict=True)])
        texts_ = []
        for t, x, at in zip(self.t.tokens, own, last, strict=True):
            text, cut = t.text[x].tolist(), [0, *(at + 1).tolist()]
            texts_.append([text[p] if q == p + 1 else ",".join(text[p:q]) for p, q in zip(cut, cut[1:], strict=False)])
        groups = [f"{x}|{y}" for x, y in zip(*texts_, strict=True)]
        # windows end where groups do
        upto = np.searchsorted(last[0], np.cumsum(sizes[0]) - 1) + 1
        cut = [0, *upto.tolist()]
        self.groups += [groups[p] if q == p + 1 else ";".join(groups[p:q]) for p, q in zip(cut, cut[1:], strict=False)]
        self.pairs = np.concatenate((self.pairs, own[0][last[0]] * self.width + own[1][last[1]]))
        self.upto = np.concatenate((self.upto, self.upto[-1] + upto))

    def _windows(self, ids: list[np.ndarray], starts: list[np.ndarray], sizes: list[np.ndarray]) -> np.ndarray:
        """The numbers of the windows; those whose ids are not known are aligned."""
        raw, memo, out, new = [x.astype("<u4").tobytes() for x in ids], self.memo, [], []
        places = [[(4 * s).tolist(), (4 * (s + n)).tolist()] for s, n in zip(starts, sizes, strict=True)]
        for k, (p, q, r, s) in enumerate(zip(*places[0], *places[1], strict=True)):
            key = raw[0][p:q] + b"\xff\xff\xff\xff" + raw[1][r:s]  # no id
            number = memo.get(key)
            if number is None:
                number = len(self.groups) + len(new)
                new.append(k)
                if len(key) <= 4 * WINDOW_IDS:
                    memo[key] = number
            out.append(number)
        if new:
            self._align(ids, [x[new] for x in starts], [x[new] for x in sizes])
        return np.array(out, np.int64)

    def documents(self, data: np.ndarray, offsets: np.ndarray):
        """For each text: n_a, n_b, the groups as text, and its linked pairs (a * width + b) one by one."""
        if len(self.groups) > CACHE_WINDOWS or self.t.held > CACHE_BYTES:
            self._forget()
        rows, size = len(offsets) - 1, np.diff(offsets)
        full = np.flatnonzero(size)
        begin = offsets[:-1][full] + np.arange(len(full))  # each text that is not empty gets a space before it
        data = np.insert(data, offsets[:-1][full], 0x20)
        space = IS_SPACE[data]
        cut = (data == 0x20) & ~np.concatenate(([True], space[:-1]))
        odd = np.zeros(len(full), bool)
        odd[np.searchsorted(begin, np.flatnonzero(_other_spaces(data)), "right") - 1] = True
        if not self.t.parts:
            odd[:] = True
        cut[np.repeat(odd, size[full] + 1)] = False
        cut[begin] = True
        starts = np.flatnonzero(cut)
        number = self.t.numbers(data, starts) if len(starts) else np.zeros(0, np.int64)
        doc = np.searchsorted(begin, starts, "right") - 1
        bad = np.zeros(len(full), bool)
        bad[doc[~self.t.good[number]]] = True
        number, doc = number[~bad[doc]], doc[~bad[doc]]
        ids, counts = [], []
        for pool, upto in zip(self.t.pools, self.t.upto, strict=True):
            n = upto[number + 1] - upto[number]
            ids.append(dealt(pool, upto[number], n))
            counts.append(np.bincount(doc, n, len(full)).astype(np.int64))
        ends = [np.cumsum(t.size[x]) for t, x in zip(self.t.tokens, ids, strict=True)]
        begins = [e - t.size[x] for e, t, x in zip(ends, self.t.tokens, ids, strict=True)]
        # anchors: where a token of both starts with a space
        mark = np.zeros(int(ends[0][-1]) + 1 if len(ends[0]) else 1, bool)
        mark[begins[0][self.t.tokens[0].spaced[ids[0]]]] = True
        anchors = begins[1][self.t.tokens[1].spaced[ids[1]]]
        anchors = anchors[mark[anchors]]
        cuts = [np.append(np.searchsorted(b, anchors), len(b)) for b in begins]
        i = cuts[0]
        # most windows are one chunk, whose window is known by its number
        heads = np.concatenate(([0], np.cumsum(self.t.upto[0][number + 1] - self.t.upto[0][number])))
        at = np.minimum(np.searchsorted(heads[:-1], i[:-1]), max(0, len(number) - 1))
        whole = (heads[at] == i[:-1]) & (heads[at + 1] == i[1:]) if len(at) else np.zeros(0, bool)
        self.of_chunk = np.concatenate((self.of_chunk, np.full(len(self.t.known) - len(self.of_chunk), -1)))
        made = np.full(len(i) - 1, -1)
        made[whole] = self.of_chunk[number[at[whole]]]
        # of chunks met for the first time here, one place each
        first = np.flatnonzero(made < 0)
        chunk = np.where(whole[first], number[at[first]], -1 - np.arange(len(first)))
        _, some, again = np.unique(chunk, return_index=True, return_inverse=True)
        window = self._windows(ids, [c[:-1][first[some]] for c in cuts], [np.diff(c)[first[some]] for c in cuts])
        made[first] = window[again]
        self.of_chunk[number[at[whole]]] = made[whole]
        # each text's first token starts with its space, so a window starts with it
        good = np.flatnonzero(~bad)
        upto = np.searchsorted(i[:-1], np.concatenate(([0], np.cumsum(counts[0][good]))))
        out = [(0, 0, "", np.zeros(0, np.int64))] * rows
        for k, row in enumerate(good.tolist()):
            own = made[upto[k] : upto[k + 1]]
            groups = ";".join([self.groups[w] for w in own.tolist()])
            out[full[row]] = int(counts[0][row]), int(counts[1][row]), groups, dealt(self.pairs, self.upto[own], self.upto[own + 1] - self.upto[own])
        return out


#: One per pair of tokenizer files and worker: later tasks find earlier tasks' chunks and windows.
_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(Tokenizers(a_path, b_path))
    return _aligners[a_path, b_path]


def groups_of(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, groups (`a1,a2|b1;a3|b2,b3`; with ``digest`` the SHA-256 of that, '' without
    tokens), pairs (the distinct linked pairs as a * B's vocabulary + b) and times (how often each is linked here)."""
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]

    @tidy
    def run(batches):
        own = aligner(a_path, b_path)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = utf8(batch.column(1))
            for i, j in slices(offsets, LOOK_UP_BYTES):
                made = own.documents(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                links = [len(p) for *_, p in made]
                distinct = [np.unique(p, return_counts=True) for *_, p in made]
                upto = pa.array(np.concatenate(([0], np.cumsum([len(x) for x, _ in distinct]))).astype(np.int32))
                groups = [g for _, _, g, _ in made]
                if digest:
                    groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                flat, times = (np.concatenate(x) for x in zip(*distinct, strict=True))
                columns = [pa.array(ids[i:j], pa.int64()), *(pa.array(c, pa.int64()) for c in ([m[0] for m in made], [m[1] for m in made], links, links)), pa.array(groups, pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(upto, pa.array(flat)), pa.ListArray.from_arrays(upto, pa.array(times.astype(np.int32)))], names)

    schema = "id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>"
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): how many links hold the pair, and whether no other pair of its B id has more."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    counts = stage(each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n")), "align-counts")
    most = counts.groupBy((F.col("pair") % width).alias("b")).agg(F.max("n").alias("most"))
    out = stage(counts.join(most, F.col("pair") % width == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "align-best")
    unstage(counts)
    return out


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups."""
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    aligned = stage(groups_of(docs, a_path, b_path, id_col, text_col, digest).withColumn("row", F.monotonically_increasing_id()), "align-documents")
    counts, spark = pair_counts(aligned, width), docs.sparkSession
    kept = ["id", "n_a", "n_b", "n_groups", "n_links"]
    if counts.limit(most_pairs + 1).count() <= most_pairs:
        table = counts.orderBy("pair").toArrow()
        shared = spark.sparkContext.broadcast([table[c].to_numpy() for c in ("pair", "n", "best")])

        def run(batches):
            pair, n, best = shared.value
            for batch in batches:
                lists = batch.column(batch.num_columns - 2)
                at, times = np.searchsorted(pair, lists.flatten().to_numpy()), batch.column(batch.num_columns - 1).flatten().to_numpy().astype(np.int64)
                upto = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
                sums = [np.diff(np.concatenate(([0], np.cumsum(x)))[upto]) for x in (times * best[at], times * n[at])]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *map(pa.array, sums)], [*kept, "groups", "n_best", "count_sum"])

        out = aligned.select(*kept, "groups", "pairs", "times").mapInArrow(run, ", ".join(f"{c} long" for c in kept) + ", groups string, n_best long, count_sum long")
    else:
        each = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
        sums = each.join(counts, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
        out = aligned.join(sums, "row", "left").withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_best", "count_sum")})
    return out.select(F.col("id").alias(id_col), *kept[1:], "n_best", "count_sum", "groups")
