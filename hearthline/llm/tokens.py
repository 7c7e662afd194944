"""Token ids of all documents, in id order, as wavelet matrix files of bounded size in the shared folder.

Documents are dealt by ranges of ids; each task tokenizes its range in order and closes a file after ``SHARD_TOKENS``
tokens (a single longer document fills one file alone). Files are written under a name of the attempt's own and are
known only by what the attempt reports, so a lost or repeated task leaves no double entry. The result is read from
the files.

Edge cases: null or empty text is the end id alone; null ids come first; rows that repeat an id are kept and stand
side by side, shorter texts first (equal rows in one task); a very long text is
encoded alone and may fill a file of its own; an empty table makes no file and an empty result; other columns are not read.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.staging import new_folder, stage
from hearthline.llm.textbytes import WordNumbers, dealt, distinct_words, slices, texts, tidy, utf8, words
from hearthline.llm.wavelet import WaveletMatrix, encode

SHARD_TOKENS = 2_000_000
#: Bytes of text at most, about, that a task sorts and encodes.
RANGE_BYTES = 128 << 20
#: Words (or their parts) whose ids a worker remembers; beyond that it starts anew.
CACHE_WORDS = 1_000_000
#: Bytes of text whose words are looked up together.
LOOK_UP_BYTES = 3 << 20


#: Words of these letters alone (of which all but U+0130 are one letter when lower-cased) are one piece to the tokenizer.
LETTERS = "^[A-Za-zÀ-ÖØ-öø-įı-ſ]+$"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class Encoder:
    """Ids of texts under a tokenizer that never joins what white space parts: each distinct word is encoded once while
    a worker remembers it. Words are told apart by their bytes.

    If the vocabulary marks the ends of words, a word of Latin letters, and points behind it, is its two parts; parts of
    letters are lower-cased, as the tokenizer does first, and encoded in one go, told apart by the marks. All other words
    are encoded singly and whole, among them those with U+0130, which becomes i and a mark that joins the point behind.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = None
        if mark:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(mark)]] = True
        self._forget()

    def _forget(self) -> None:
        #: The ids of piece number k are pool[upto[k] : upto[k + 1]].
        self.known, self.upto, self.pool = WordNumbers(), np.zeros(1, np.int64), np.zeros(0, "<u4")

    def _singly(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = [e.ids for i in range(0, len(batch), 10_000) for e in self.tokenizer.encode_batch_fast(batch[i : i + 10_000], add_special_tokens=False)]
        return np.array([x for ids in made for x in ids], "<u4"), np.array([len(x) for x in made], np.int64)

    def _together(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = []
        for i in range(0, len(batch), 10_000):
            part = batch[i : i + 10_000]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            marked = len(ends) == len(part) and ends[-1] == len(ids)
            made.append((ids, np.diff(ends, prepend=0)) if marked else self._singly(part))
        return np.concatenate([x for x, _ in made]), np.concatenate([n for _, n in made])

    def _places(self, pieces: pa.Array, joined: bool) -> np.ndarray:
        """The pieces' numbers; new ones are learned."""
        at = self.known.find(pieces)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = pieces.take(pa.array(missing))
            ids, sizes = (self._together if joined else self._singly)(texts(new))
            at[missing] = self.known.add(new)
            self.pool, self.upto = np.concatenate((self.pool, ids)), np.concatenate((self.upto, self.upto[-1] + np.cumsum(sizes)))
        return at

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one behind the other, and how many each has. Each distinct word is looked up once, and
        its ids are dealt out to all its places."""
        starts, ends, first = words(data, offsets)
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(len(offsets) - 1, np.int64)
        if len(self.known) > CACHE_WORDS:
            self._forget()
        distinct, place = distinct_words(data, starts, ends)
        if self.ends is None:
            number = self._places(distinct, False)
            parts = np.stack((number, number), axis=1)
            second = np.zeros(len(number), bool)
        else:
            text = distinct.cast(pa.string())
            core = pc.ascii_rtrim(text, characters=PUNCTUATION)
            plain = pc.match_substring_regex(core, LETTERS).to_numpy(zero_copy_only=False)
            parts = np.zeros((len(text), 2), np.int64)
            letters = pc.utf8_lower(core.filter(pa.array(plain))).dictionary_encode()
            parts[plain, 0] = self._places(letters.dictionary.cast(pa.binary()), True)[letters.indices.to_numpy()]
            parts[~plain, 0] = self._places(distinct.filter(pa.array(~plain)), False)
            second = plain & (pc.binary_length(core).to_numpy() < pc.binary_length(text).to_numpy())
            tails = [x[n:] for x, n in zip(texts(distinct.filter(pa.array(second))), pc.utf8_length(core).to_numpy()[second].tolist(), strict=True)]
            tails = pa.array(tails, pa.string()).dictionary_encode()
            parts[second, 1] = self._places(tails.dictionary.cast(pa.binary()), False)[tails.indices.to_numpy()]
        sizes = self.upto[parts + 1] - self.upto[parts]
        sizes[~second, 1] = 0
        # the ids of the distinct words, then those of all words
        pool, n = dealt(self.pool, self.upto[parts].ravel(), sizes.ravel()), sizes.sum(1)
        upto = np.concatenate(([0], np.cumsum(n[place])))[first]
        return dealt(pool, (np.cumsum(n) - n)[place], n[place]), np.diff(upto)


#: One per tokenizer file and worker: later tasks find earlier tasks' words.
_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files and returns one row each: path, part, place (its order within the part), tokens."""

    @tidy
    def run(batches):
        from pyspark import TaskContext

        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        coder, place = encoder(tokenizer), 0
        fs, root = _filesystem(folder)
        ids: list = []
        lengths: list[np.ndarray] = []
        chunks: list[np.ndarray] = []
        held = 0

        def close():
            nonlocal ids, lengths, chunks, held, place
            flat = np.concatenate(chunks)
            raw = encode(flat, ids, np.concatenate(lengths))
            name = f"part-{part:06d}-{place:05d}-{attempt}.wm"
            with fs.open_output_stream(f"{root}/{name}") as f:
                f.write(raw)
            row = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([part]), pa.array([place]), pa.array([len(flat)])], ["name", "part", "place", "tokens"])
            ids, lengths, chunks, held, place = [], [], [], 0, place + 1
            return row

        for batch in batches:
            data, offsets = utf8(batch.column(1))
            doc_ids = batch.column(0).to_pylist()
            for i, j in slices(offsets, LOOK_UP_BYTES):
                flat, n = coder.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                flat, n = np.insert(flat, np.cumsum(n), end_id), n + 1
                upto, k = np.concatenate(([0], np.cumsum(n))), 0
                while k < j - i:
                    # the documents that still fit into the file; one alone always does
                    to = max(k + (not held), int(np.searchsorted(upto, upto[k] + SHARD_TOKENS - held, "right")) - 1)
                    if to > k:
                        ids += doc_ids[i + k : i + to]
                        lengths.append(n[k:to])
                        chunks.append(flat[upto[k] : upto[to]])
                        held += int(upto[to] - upto[k])
                    if to < j - i:
                        yield close()
                    k = to
        if ids:
            yield close()

    fs, root = _filesystem(folder)
    fs.create_dir(root, recursive=True)
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.length(text_col).alias("n"), F.xxhash64(text_col).alias("h"))
    held = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-held // RANGE_BYTES))
    order = [F.col("id").asc_nulls_first(), F.col("n").asc_nulls_first(), "h"]  # ranges part the rows of one id, too
    ordered = d.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text")
    return stage(ordered.select("id", "text").mapInArrow(run, "name string, part long, place long, tokens long"), "token-files")


def read_shards(files: DataFrame, folder: str) -> DataFrame:
    """One row per document, from the files: id, start, n_tokens, ids_crc32."""
    spark = files.sparkSession

    @tidy
    def run(batches):
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                matrix = WaveletMatrix(raw.as_py())
                ids, ends = matrix.decode().astype("<u4"), np.cumsum(matrix.counts)
                starts = ends - matrix.counts
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(starts)), pa.array(matrix.doc_ids, pa.int64()), pa.array(starts), pa.array(matrix.counts), pa.array(sums, pa.int64())],
                    ["name", "id", "at", "n_tokens", "ids_crc32"],
                )

    # Files of one part come in order, parts too; sums of earlier parts first, then of earlier files of the part.
    parts = files.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before"))
    base = files.join(base, "part").select("name", (F.col("before") + F.coalesce(F.sum("tokens").over(within), F.lit(0))).alias("base"))
    raw = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    docs = raw.join(F.broadcast(files.select("name")) if files.limit(100_001).count() <= 100_000 else files.select("name"), "name", "left_semi").mapInArrow(run, "name string, id long, at long, n_tokens long, ids_crc32 long")
    small = stage(base, "token-bases")
    return docs.join(F.broadcast(small) if small.limit(100_001).count() <= 100_000 else small, "name").select("id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the ids of all documents to ``folder`` (a new one in the shared folder by default; the files are the product
    and stay until somebody deletes them) and returns per document what the files hold: id, start, n_tokens, ids_crc32."""
    folder = folder or new_folder(docs.sparkSession, "token-ids")
    files = write_shards(docs, tokenizer, end_id, folder, id_col, text_col)
    if files.limit(1).count() == 0:
        return docs.sparkSession.createDataFrame([], f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")
    return read_shards(files, folder).withColumnRenamed("id", id_col)
