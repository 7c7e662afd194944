"""Language-model scoring by context-tree weighting, beside a unigram base.

Text is modelled as its lower-cased UTF-8 bytes and an end byte (0xFF, which no text has; it also fills the context
before a text). Each byte is eight binary decisions; every decision has a tree of the DEPTH preceding bytes, whose
nodes hold Krichevsky-Trofimov estimates of all training text, and context-tree weighting mixes the nodes on the path
by their weighted probabilities. The tree is learned from counts of (DEPTH + 1)-byte strings over all training
documents and then stays as it is; a text's score sums the log10 probabilities of its bytes and its end.

The tree has DEPTH bytes of context at all sizes. Strings, of all documents, are grouped by the nearest CUT bytes of
their context: what lies below such a context is summed and mixed in its group alone, and what the groups add up to is
the top of the tree, which has fixed bounds and is broadcast. So each distinct string gets its prediction once. Those
of the most frequent strings are broadcast; the other strings of a document meet theirs in a shuffle.

Edge cases: null text is empty (one end token); with no training text each binary decision is even and the base is
log10(0.5 / 0.5) a token; rows that repeat an id are scored each; null ids train (crc32 of the
empty text); a very long text is worked on alone; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.staging import stage, unstage
from hearthline.llm.textbytes import LOWER, U64, WordNumbers, distinct_words, slices, utf8, words

DEPTH = 5
#: Bytes of the context by which strings are grouped; the tree above has contexts of fewer bytes.
CUT = 3
#: Strings of whole groups that are mixed in one go.
GROUP_STRINGS = 200_000
#: Strings whose predictions are broadcast, the most frequent ones; the others meet theirs in a shuffle.
MAX_STRINGS = 2_500_000
#: Words whose counts are broadcast, the most frequent ones; the others meet their counts in a shuffle.
HOT_WORDS = 500_000
END = 0xFF


def byte_strings(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text, and its end, the string of the byte and the ``depth`` bytes before it as a number;
    and where each row's strings start."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    pad = depth + 1
    stream = np.full(len(data) + pad * rows, END, np.uint8)
    row = np.repeat(np.arange(rows), size)
    stream[np.arange(len(data)) + pad * row + depth] = LOWER[data]
    key = np.zeros(max(0, len(stream) - depth), U64)
    for j in range(depth + 1):
        key = (key << U64(8)) | stream[j : len(stream) - depth + j].astype(U64)
    good = np.ones(len(key), bool)
    for j in range(depth):  # windows that start in one text and end in the next
        good[(offsets[1:-1] + pad * np.arange(1, rows) - depth + j)] = False
    first = np.concatenate(([0], np.cumsum(size + 1)))
    return key[good], first


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(n, first)


def _totals(depth: int):
    """Per task, how often each word (kind 0) and each byte string (kind 1) occurs: n in training texts, m in all. Words
    are those of training texts alone, told apart by their bytes."""
    names = ["kind", "key", "word", "n", "m"]

    def run(batches):
        # strings of training texts, of held-out texts
        kept, held = {1: ([], []), 2: ([], [])}, {1: 0, 2: 0}
        known, seen, counts = WordNumbers(), [], np.zeros(0, np.int64)

        def out(kind):
            key, n = _merged(*kept[kind])
            kept[kind] = ([], [])
            held[kind] = 0
            for i in range(0, len(key), 100_000):
                part, m = key[i : i + 100_000], n[i : i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(part), np.int32)), pa.array(part.view(np.int64)), pa.nulls(len(part), pa.binary()), pa.array(m * (kind < 2)), pa.array(m)], names)

        def out_words():
            nonlocal known, seen, counts
            words_ = pa.concat_arrays(seen) if seen else pa.array([], pa.binary())
            for i in range(0, len(words_), 100_000):
                part, n = words_.slice(i, 100_000), pa.array(counts[i : i + 100_000])
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(part), np.int32)), pa.nulls(len(part), pa.int64()), part, n, n], names)
            known, seen, counts = WordNumbers(), [], np.zeros(0, np.int64)

        for batch in batches:
            data, offsets = utf8(batch.column(0))
            held_out = np.array(batch.column(1).to_pylist(), bool)
            for i, j in slices(offsets):
                part, own = LOWER[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
                starts, ends, first = words(part, own)
                if len(starts):
                    distinct, place = distinct_words(part, starts, ends)
                    n = np.bincount(place[~np.repeat(held_out[i:j], np.diff(first))], minlength=len(distinct))
                    distinct, n = distinct.take(pa.array(np.flatnonzero(n))), n[n > 0]
                    at = known.find(distinct)
                    new = np.flatnonzero(at < 0)
                    if len(new):
                        seen.append(distinct.take(pa.array(new)))
                        at[new] = known.add(seen[-1])
                        counts = np.concatenate((counts, np.zeros(len(new), np.int64)))
                    counts[at] += n
                    if len(known) > 500_000:
                        yield from out_words()
                out_byte = np.repeat(held_out[i:j], np.diff(own) + 1)
                strings = byte_strings(part, own, depth)[0]
                for kind, values in ((1, strings[~out_byte]), (2, strings[out_byte])):
                    if len(values):
                        key, n = np.unique(values, return_counts=True)
                        kept[kind][0].append(key)
                        kept[kind][1].append(n)
                        held[kind] += len(key)
                        if held[kind] > 1_500_000:
                            key, n = _merged(*kept[kind])
                            kept[kind] = ([key], [n])
                            held[kind] = len(key)
                            if len(key) > 750_000:
                                yield from out(kind)
        yield from out_words()
        for kind in kept:
            if kept[kind][0]:
                yield from out(kind)

    return run


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x >= 0.5, by Stirling's series after eight steps of the recurrence."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def _estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1.0) + (_log_gamma(np.ones(1)) - 2 * _log_gamma(np.full(1, 0.5)))[0]


def _mixed(own: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A node's weighted probability (ln) and the weight of its own estimate in it."""
    return np.logaddexp(own, children) - np.log(2), 1 / (1 + np.exp(np.clip(children - own, -700, 700)))


class Tree:
    """The nodes with at least ``base`` context bytes, of strings whose groups by these bytes are whole."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int, base: int):
        """keys: distinct strings of depth + 1 bytes, the current byte lowest; counts of each."""
        self.depth, self.base = depth, base
        order = np.argsort(keys)
        strings, n = keys[order], counts[order].astype(np.float64)
        by_depth = {}
        for d in range(base, depth + 1):
            by_depth[d] = _merged([strings & U64((1 << 8 * (d + 1)) - 1)], [n]) if len(strings) else (strings, n)
        # nodes[d, j]: context of d bytes and the j bits decided so far -> P(1) by the node's own estimate, its weight
        self.nodes: dict[tuple[int, int], tuple] = {}
        #: Per bit, what the nodes of base - 1 context bytes get from these: node, zeros, ones, ln of the children's product.
        self.above: list[tuple] = []
        for j in range(8):
            below = None
            for d in range(depth, base - 1, -1):
                node, zeros, ones = self._decisions(*by_depth[d], j)
                own = _estimate(zeros, ones)
                if below is None:
                    weighted = own
                else:
                    children = np.bincount(np.searchsorted(node, self._parent(below[0], d)), below[1], len(node)) if len(node) else own
                    weighted, weight = _mixed(own, children)
                below = node, weighted
                if d < depth:  # the deepest, which are most, are summed from the strings when asked for
                    self.nodes[d, j] = node, (ones + 0.5) / (zeros + ones + 1), weight
            parents, back = np.unique(self._parent(node, base - 1), return_inverse=True)
            self.above.append((parents, *(np.bincount(back, x, len(parents)) for x in (zeros, ones, weighted))))
        self.upto = np.concatenate(([0.0], np.cumsum(n)))
        self.strings = strings

    @staticmethod
    def _decisions(strings: np.ndarray, n: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nodes that decide bit j (context, a leading one and the bits before it), with their zeros and ones."""
        byte = (strings & U64(255)).astype(np.int64)
        node = (strings & ~U64(255)) | ((1 << j) | (byte >> (8 - j))).astype(U64)
        if not len(node):
            return node, n, n
        first = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
        ones = np.add.reduceat(n * ((byte >> (7 - j)) & 1), first)
        return node[first], np.add.reduceat(n, first) - ones, ones

    @staticmethod
    def _parent(node: np.ndarray, d: int) -> np.ndarray:
        """The node of d context bytes above one of d + 1: the oldest byte goes."""
        return node & U64((1 << 8 * (d + 1)) - 1)

    def walk(self, strings: np.ndarray) -> np.ndarray:
        """For each string and bit, the probability of the bit as mixed by these nodes; an unseen node predicts one half."""
        byte = (strings & U64(255)).astype(np.int64)
        out = np.empty((len(strings), 8), np.float32)
        for j in range(8):
            node = _node(strings, byte, j)
            # strings that share the node share the work
            seen, back = np.unique(node, return_inverse=True)
            # at the deepest node a string's own counts are those of a range of bytes under its context
            context, prefix, width = seen & ~U64(255), (seen & U64(255)) - U64(1 << j), U64(1 << (8 - j))
            low = context | (prefix * width)
            a, b, c = (self.upto[np.searchsorted(self.strings, x)] for x in (low, low + (width >> U64(1)), low + width))
            zero, one = (b - a + 0.5) / (c - a + 1), (c - b + 0.5) / (c - a + 1)
            for d in range(self.depth - 1, self.base - 1, -1):
                zero, one = _step(self.nodes[d, j], self._parent(seen, d), zero, one)
            out[:, j] = np.where((byte >> (7 - j)) & 1 == 1, one[back], zero[back])
        return out


def _node(strings: np.ndarray, byte: np.ndarray, j: int) -> np.ndarray:
    return (strings & ~U64(255)) | ((1 << j) | (byte >> (8 - j))).astype(U64)


def _step(nodes: tuple, wanted: np.ndarray, zero: np.ndarray, one: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixes P(0) and P(1) of the deeper nodes with the own estimates of the wanted nodes, where these were seen."""
    known, own, weight = nodes
    if not len(known):
        return zero, one
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    w = np.where(known[at] == wanted, weight[at], 0.0)
    return w * (1 - own[at]) + (1 - w) * zero, w * own[at] + (1 - w) * one


class Top:
    """The nodes with less than ``base`` context bytes, from what the groups below add up to."""

    def __init__(self, node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray, base: int):
        """Nodes of base - 1 context bytes, of all bits: zeros, ones, ln of the children's product."""
        self.nodes = []
        for d in range(base - 1, -1, -1):
            node, back = np.unique(node & U64((1 << 8 * (d + 1)) - 1), return_inverse=True)
            zeros, ones, children = (np.bincount(back, x, len(node)) for x in (zeros, ones, children))
            weighted, weight = _mixed(_estimate(zeros, ones), children)
            self.nodes.append((d, (node, (ones + 0.5) / (zeros + ones + 1), weight)))
            children = weighted

    def finish(self, strings: np.ndarray, p: np.ndarray) -> np.ndarray:
        """log10 P(byte | context) of each string from what ``Tree.walk`` made of it."""
        byte = (strings & U64(255)).astype(np.int64)
        out = np.zeros(len(strings))
        for j in range(8):
            node, bit = _node(strings, byte, j), (byte >> (7 - j)) & 1 == 1
            mixed = p[:, j].astype(np.float64)
            for d, nodes in self.nodes:
                zero, one = _step(nodes, node & U64((1 << 8 * (d + 1)) - 1), mixed, mixed)
                mixed = np.where(bit, one, zero)
            out += np.log10(mixed)
        return out


class Predictions:
    """log10 P(byte | context) of given strings, in hash tables: what meets another string's slot goes to the next table."""

    def __init__(self, strings: np.ndarray, logs: np.ndarray):
        self.strings, self.logs = strings, logs
        self.tables, left, salt = [], np.arange(len(strings)), 0x9E3779B97F4A7C15
        while len(left):
            bits = max(4, int(len(left) * 2).bit_length())
            slot = ((self.strings[left] * U64(salt)) >> U64(64 - bits)).astype(np.int64)
            table = np.zeros(1 << bits, np.int32)
            table[slot] = left
            self.tables.append((table, U64(salt), U64(64 - bits)))
            left = left[table[slot] != left]
            salt = (salt * 0x2545F4914F6CDD1D + 2) % (1 << 64) | 1

    def look_up(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strings' logs (0 for others), and the places of the strings that are not here."""
        out, open_ = np.zeros(len(strings)), np.arange(len(strings))
        for table, salt, shift in self.tables:
            own = strings[open_]
            at = table[((own * salt) >> shift).astype(np.int64)]
            hit = self.strings[at] == own
            out[open_[hit]] = self.logs[at[hit]]
            open_ = open_[~hit]
            if not len(open_):
                break
        return out, open_


def _below(depth: int, base: int):
    """From (key, n, m) with groups side by side: a row per string (kind 1) with its bits' probabilities as mixed below
    ``base``, and rows of what the nodes above get (kind 0)."""
    near = U64((1 << 8 * (base + 1)) - (1 << 8))
    names = ["kind", "key", "m", "p", "zeros", "ones", "children"]

    def made(key, n, m):
        tree = Tree(key[n > 0], n[n > 0], depth, base)
        p = tree.walk(key)
        for i in range(0, len(key), 50_000):
            k = len(part := key[i : i + 50_000])
            raw = pa.Array.from_buffers(pa.binary(), k, [None, pa.py_buffer(np.arange(k + 1, dtype=np.int32) * 32), pa.py_buffer(p[i : i + k].tobytes())])
            none = pa.nulls(k, pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(k, np.int32)), pa.array(part.view(np.int64)), pa.array(m[i : i + k]), raw, none, none, none], names)
        node, zeros, ones, children = (np.concatenate(x) for x in zip(*tree.above, strict=True))
        k = len(node)
        if k:
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(k, np.int32)), pa.array(node.view(np.int64)), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.array(zeros), pa.array(ones), pa.array(children)], names)

    def run(batches):
        kept, size, enough = [], 0, GROUP_STRINGS
        for batch in batches:
            kept.append((batch.column(0).to_numpy().view(U64), batch.column(1).to_numpy(), batch.column(2).to_numpy()))
            size += batch.num_rows
            if size >= enough:
                columns = [np.concatenate(x) for x in zip(*kept, strict=True)]
                other = np.flatnonzero((columns[0] & near) != (columns[0][-1] & near))
                cut = int(other[-1]) + 1 if len(other) else 0
                if cut:
                    yield from made(*(x[:cut] for x in columns))
                kept, size = [tuple(x[cut:] for x in columns)], size - cut
                enough = max(GROUP_STRINGS, 2 * size)
        if size:
            yield from made(*(np.concatenate(x) for x in zip(*kept, strict=True)))

    return run


def predictions(totals: DataFrame, depth: int) -> DataFrame:
    """From (key, n, m) of all strings: key, m, log (log10 of P(byte | context) by the tree of all n)."""
    base = min(CUT, depth)
    near = F.col("key").bitwiseAND(F.lit((1 << 8 * (base + 1)) - (1 << 8)).cast("long"))
    grouped = totals.select("key", "n", "m").repartition(near).sortWithinPartitions(near)
    mixed = stage(grouped.mapInArrow(_below(depth, base), "kind int, key long, m long, p binary, zeros double, ones double, children double"), "lm-below")
    got = mixed.where("kind = 0").groupBy("key").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("children").alias("children")).toArrow()
    top = Top(got["key"].to_numpy().view(U64), *(got[c].to_numpy() for c in ("zeros", "ones", "children")), base)
    shared = totals.sparkSession.sparkContext.broadcast(top)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                strings = batch.column(0).to_numpy().view(U64)
                p = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float32).reshape(-1, 8)
                logs = shared.value.finish(strings, p).astype(np.float32)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(logs)], ["key", "m", "log"])

    out = stage(mixed.where("kind = 1").select("key", "m", "p").mapInArrow(run, "key long, m long, log float"), "lm-predictions")
    unstage(mixed)
    return out


def _reached(steps: list, most: int) -> int:
    """From falling values ``c`` with a count each: the least that at most ``most`` reach."""
    least, so_far = 1 << 62, 0
    for step in steps:
        so_far += step["count"]
        if so_far > most:
            break
        least = step["c"]
    return least


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), values)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = 5, held: int = 1, depth: int = DEPTH, max_strings: int = MAX_STRINGS, hot_words: int = HOT_WORDS) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("id"), (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts == held).alias("held_out"), F.col(text_col).alias("text"))
    training = d.where("not held_out")
    each = d.select("text", "held_out").mapInArrow(_totals(depth), "kind int, key long, word binary, n long, m long")
    totals = stage(each.groupBy("kind", "key", "word").agg(F.sum("n").alias("n"), F.sum("m").alias("m")), "lm-totals")
    strings = predictions(totals.where("kind = 1"), depth)
    # frequencies in steps of a sixteenth of an octave: the least that at most max_strings strings reach
    step = F.floor(16 * F.log2("m"))
    often = _reached(strings.groupBy(step.alias("c")).count().orderBy(F.desc("c")).collect(), max_strings)
    frequent = strings.where(step >= often).select("key", "log").toArrow()
    counts = totals.where("kind = 0").select("word", F.col("n").alias("c"))
    texts = training.count()
    w = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    total, distinct = (w[0] or 0) + texts, w[1] + (texts > 0)
    # the least count that at most hot_words words reach
    steps = counts.groupBy(F.least("c", F.lit(1 << 16)).alias("c")).count().orderBy(F.desc("c")).collect()
    least = _reached(steps, hot_words)
    hot = counts.where(F.col("c") >= least).toArrow()
    hot_table = WordNumbers()
    hot_table.add(pa.array(hot["word"].combine_chunks(), pa.binary()) if hot.num_rows else pa.array([], pa.binary()))
    table = Predictions(frequent["key"].to_numpy().view(U64), frequent["log"].to_numpy())
    model = spark.sparkContext.broadcast((table, hot_table, hot["c"].to_numpy(), total, distinct, texts))

    def run(batches):
        table, hot_table, hot_count, total, distinct, texts = model.value
        bottom = np.log10(total + 0.5 * (distinct + 1))
        end = np.log10(texts + 0.5) - bottom
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for i, j in slices(offsets):
                part, own = LOWER[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
                starts, ends, first = words(part, own)
                distinct_, place = distinct_words(part, starts, ends)
                row = np.repeat(np.arange(j - i), np.diff(first))
                at = hot_table.find(distinct_)[place]
                there = at >= 0
                logs = np.log10(hot_count[at[there]] + 0.5) - bottom
                base = np.bincount(row[there], logs, j - i) + end
                known = np.bincount(row[there], minlength=j - i) + (texts > 0)
                strings, at_string = byte_strings(part, own, depth)
                logs, open_ = table.look_up(strings)
                bytes_ = np.add.reduceat(logs, at_string[:-1])
                rare = _lists(np.bincount(row[~there], minlength=j - i), distinct_.take(pa.array(place[~there])))
                open_row = np.searchsorted(at_string, open_, "right") - 1
                rare_strings = _lists(np.bincount(open_row, minlength=j - i), pa.array(strings[open_].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(np.diff(first) + 1), pa.array(known.astype(np.int64)), pa.array(base), pa.array(bytes_), pa.array(np.diff(own)), rare, rare_strings],
                    ["id", "held_out", "n_tokens", "known", "base", "score", "n_bytes", "rare", "rare_strings"],
                )

    scored = d.mapInArrow(run, "id long, held_out boolean, n_tokens long, known long, base double, score double, n_bytes long, rare array<binary>, rare_strings array<long>")
    scored = stage(scored.withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    each = scored.where(F.size("rare") > 0).select("row", F.explode("rare").alias("word")).groupBy("row", "word").count()
    bottom = F.log10(F.lit(float(total + 0.5 * (distinct + 1))))
    c = F.coalesce("c", F.lit(0))
    rare = each.join(counts.where(F.col("c") < least), "word", "left").groupBy("row").agg(
        F.sum(F.col("count") * (F.log10(c + 0.5) - bottom)).alias("rare_base"), F.sum(F.when(c > 0, F.col("count")).otherwise(0)).alias("rare_known")
    )
    rare = stage(rare, "lm-rare")
    unstage(totals)
    open_ = scored.where(F.size("rare_strings") > 0).select("row", F.explode("rare_strings").alias("key"))
    open_ = open_.join(strings.where(step < often).select("key", "log"), "key").groupBy("row").agg(F.sum(F.col("log").cast("double")).alias("rare_score"))
    open_ = stage(open_, "lm-rare-strings")
    unstage(strings)
    out = scored.drop("rare", "rare_strings").join(rare, "row", "left").join(open_, "row", "left")
    out = out.withColumn("score", F.col("score") + F.coalesce("rare_score", F.lit(0.0)))
    return out.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"), "score", "n_bytes", (-F.col("score") / F.log10(F.lit(2.0)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
