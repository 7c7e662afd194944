"""Language identification as multilingual mixture inference.

Per language, smoothed frequencies of hashed byte trigrams are counted over all labelled documents. A document is a
mixture of languages: expectation-maximisation estimates the proportions from its trigrams' likelihoods, and among
the nested sets of its most likely languages the one with the best penalised likelihood is kept.

Edge cases: null, empty or letterless text is ``und`` with score 0; without any labelled document every text is
``und``; equal proportions go to the language that sorts first; ids may be null or repeat; a very long text is worked on
alone; an empty table gives an empty result; other columns of the table are not read. The model, which is broadcast,
has 64 KB a label; texts are worked on in slices that are the smaller the more labels there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.textbytes import LOWER, SLICE_BYTES, slices, tidy, utf8

BUCKETS = 1 << 14
#: Labels up to which slices of text have their full size.
FEW_LANGUAGES = 16
ROUNDS = 12
#: Log-likelihood that each further language must bring, times the log of the document's trigrams.
PENALTY = 8.0
UNKNOWN = "und"

_CLASS = LOWER.copy()
_CLASS[:128][~np.array([chr(c).isalpha() for c in range(128)])] = 0x20  # whatever is no letter parts words


def split_bucket(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row * BUCKETS + bucket) and their counts. Each text is read with a blank before and after it."""
    rows = len(offsets) - 1
    text = np.full(len(data) + 2 * rows, 0x20, np.uint8)
    row = np.repeat(np.arange(rows), np.diff(offsets))
    text[np.arange(len(data)) + 2 * row + 1] = _CLASS[data]
    wide = text.astype(np.uint32)
    gram = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
    at = np.repeat(np.arange(rows), np.diff(offsets) + 2)[:-2]
    bucket = (gram * np.uint32(0x9E3779B1)) >> np.uint32(18)
    # no trigram runs over two texts, and blanks alone say nothing
    ends = (offsets[1:-1] + 2 * np.arange(1, rows)) if rows > 1 else np.zeros(0, np.int64)
    good = (gram & np.uint32(0xFF00)) != 0x2000
    good |= ((gram >> np.uint32(16)) != 0x20) | ((gram & np.uint32(0xFF)) != 0x20)
    good[ends - 2] = False
    good[ends - 1] = False
    key = np.sort(at[good].astype(np.uint64) * np.uint64(BUCKETS) + bucket[good])
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[first], np.diff(np.append(first, len(key)))


#: Languages whose table of log frequencies (64 KB each) is sent to every task: 128 MB at most. More labels stop training
#: with an error, for they are no languages.
MOST_LANGUAGES = 2048


@tidy
def _count(batches):
    """Per partition, the trigram counts of each label."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        label = np.array(batch.column(1).to_pylist(), object)
        for i, j in slices(offsets):
            key, n = trigrams(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            row, bucket = (key // BUCKETS).astype(np.int64), (key % BUCKETS).astype(np.int64)
            for x in set(label[i:j]):
                own = (label[i:j] == x)[row]
                totals.setdefault(x, np.zeros(BUCKETS, np.int64))
                totals[x] += np.bincount(bucket[own], n[own], BUCKETS).astype(np.int64)
    for x, t in totals.items():
        at = np.flatnonzero(t)
        yield pa.RecordBatch.from_arrays([pa.array([x] * len(at)), pa.array(at.astype(np.int32)), pa.array(t[at])], ["lang", "bucket", "n"])


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and log frequencies [bucket, language]. Counts cover all rows; what comes to the driver is
    at most BUCKETS numbers a language."""
    labelled = labelled.where(F.col(lang_col).isNotNull() & has_letter(F.col(text_col))).select(text_col, F.col(lang_col).cast("string"))
    names = sorted(r[0] for r in labelled.select(lang_col).distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: the mixture weighs all of them for each trigram, and its table would not fit into a task")
    counts = labelled.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((BUCKETS, max(1, len(names))))
    if counts.num_rows:
        at = {x: k for k, x in enumerate(names)}
        table[counts["bucket"].to_numpy(), [at[x] for x in counts["lang"].to_pylist()]] = counts["n"].to_numpy()
    table += 0.1
    return names, np.log(table / table.sum(0)).astype(np.float32)


def _mixture(like: np.ndarray, n: np.ndarray, first: np.ndarray, row: np.ndarray, start: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """EM over all documents at once: proportions and, of the last round, the log-likelihood above the scale of ``like``."""
    share, total = start, np.add.reduceat(n, first)[:, None]
    for _ in range(rounds):
        joint = like * share[row]
        whole = joint.sum(1)
        share = np.add.reduceat(joint * (n / whole)[:, None], first, axis=0) / total
    return share, np.add.reduceat(n * np.log((like * share[row]).sum(1)), first)


def mixtures(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Proportions [row, language] of the chosen sets; zeros for a row without trigrams."""
    out = np.zeros((len(offsets) - 1, table.shape[1]))
    key, n = trigrams(data, offsets)
    if not len(key):
        return out
    rows, bucket = (key // BUCKETS).astype(np.int64), (key % BUCKETS).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    at = rows[first]
    row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(rows))))
    logs = table[bucket]
    top = logs.max(1)
    like, n = np.exp(logs - top[:, None]), n.astype(np.float32)
    languages = like.shape[1]
    single = np.add.reduceat(logs * n[:, None], first, axis=0) - np.add.reduceat(top * n, first)[:, None]
    share, best = _mixture(like, n, first, row, np.full((len(first), languages), 1 / languages, np.float32), ROUNDS)
    cost = PENALTY * np.log(np.add.reduceat(n, first) + 1)
    score, chosen = single.max(1), np.eye(languages)[single.argmax(1)]
    order = np.argsort(-share, axis=1, kind="stable")
    for size in range(2, languages + 1):
        # a set of this size gains no more than the full mixture does
        open_ = best - (size - 1) * cost > score
        if not open_.any():
            break
        kept = open_[row]
        own = np.zeros((open_.sum(), languages), np.float32)
        np.put_along_axis(own, order[open_, :size], 1 / size, 1)
        renumber = np.cumsum(open_) - 1
        own_row = renumber[row[kept]]
        own_first = np.flatnonzero(np.concatenate(([True], own_row[1:] != own_row[:-1])))
        own, reached = _mixture(like[kept] + np.float32(1e-12), n[kept], own_first, own_row, own, ROUNDS)
        better = reached - (size - 1) * cost[open_] > score[open_]
        where = np.flatnonzero(open_)[better]
        score[where], chosen[where] = (reached - (size - 1) * cost[open_])[better], own[better]
    out[at] = chosen
    return out


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str, keep: list[str]) -> DataFrame:
    """Columns ``keep``, then lang_pred, score (its share of the document) and langs (all chosen, largest first)."""
    names, table = model
    shared = docs.sparkSession.sparkContext.broadcast((names, table))
    kept = docs.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", lang_pred string, score double, langs array<string>"

    @tidy
    def run(batches):
        names, table = shared.value
        for batch in batches:
            n = batch.num_columns
            data, offsets = utf8(batch.column(n - 2))
            some = np.array(batch.column(n - 1).to_pylist(), bool)
            share = np.zeros((batch.num_rows, table.shape[1]))
            for i, j in slices(offsets, SLICE_BYTES * FEW_LANGUAGES // max(FEW_LANGUAGES, table.shape[1])):
                share[i:j] = mixtures(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], table)
            known = some & (share.max(1) > 0) & bool(names)
            best = share.argmax(1)
            sets = [[names[k] for k in np.argsort(-s, kind="stable") if s[k] > 0] if ok else [] for s, ok in zip(share, known, strict=True)]
            made = [pa.array([names[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]), pa.array(np.where(known, np.minimum(share.max(1), 1.0), 0.0)), pa.array(sets, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(batch.columns[: n - 2] + made, [*keep, "lang_pred", "score", "langs"])

    return docs.select(*keep, F.col(text_col).alias("_text"), has_letter(F.col(text_col)).alias("_letter")).mapInArrow(run, schema)


def detect_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", parts: int = 4, held: int = 2) -> DataFrame:
    """Learns from the labelled documents outside the held-out part and judges all: id, held_out, lang_pred, score, langs."""
    part = docs.select(F.col(id_col), F.col(text_col), F.col(lang_col), split_bucket(id_col, parts).alias("_part"))
    model = train(part.where(F.col("_part") != held).select(text_col, lang_col), text_col, lang_col)
    out = identify(part.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"), (F.col("_part") == held).alias("held_out")), model, "_t", ["_id", "held_out"])
    return out.withColumnRenamed("_id", id_col)


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents, all columns as they are, less those that no learned language fits (``und``)."""
    model = train(docs.where(split_bucket(id_col, 4) != 2).select(text_col, lang_col), text_col, lang_col)
    renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = f"c{docs.columns.index(text_col)}"
    judged = identify(renamed, model, text, renamed.columns)
    return judged.where(F.col("lang_pred") != UNKNOWN).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
