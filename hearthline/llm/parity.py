"""N-gram Jaccard join with parity sketches.

1. A document's set is its distinct 4-word shingles; copies of a set are one node. A shingle is hashed to one place of a
   bit sketch, and the sketch holds each place's parity: shingles that two sets share cancel out, so the Hamming distance
   of two sketches is at most the size of the sets' symmetric difference.
2. Two sets of n and m shingles with the asked similarity differ in at most (1 - p) / (1 + p) * (n + m) of them. Sizes fall
   into bands; the sketches of a band have the same number of pieces, PIECES times as many as its sets may differ
   in, each WIDE bits long. All but so many pieces of two similar sets are equal, so they meet in one of the rarest of
   each that may differ, plus one (pieces that hold no parity bit, or those of common passages alone, are frequent and
   hardly ever among these). A set that is similar to smaller ones of the band below has a sketch for that, too.
3. Sets that meet in a short list are paired; lists that hold more are met by pivots, as in ``minhash``: no link between
   components is lost, and none of the rounds makes all pairs of a large group. A pair goes on only if the Hamming
   distance of two further sketches, of four bits a shingle, allows the link; larger ones are folded to the smaller.
4. What is left is verified on the exact sets, under two independent hashes of each shingle.

Edge cases: null or wordless text has an empty set and is its own component; with fewer words than a shingle has, the
whole sequence is the one; a very long text has a long sketch of its own and is worked on alone; rows that repeat an id
are one document (their texts' sets are linked); rows with a null id stand alone, with a null component; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm import minhash
from hearthline.llm.staging import keyed_join, stage, unstage
from hearthline.llm.textbytes import U64, long_lists, mix, tidy

WIDTH = 4
PERCENT = 85
#: Bits of a piece, of which the parity bits are known by a digest.
WIDE = 1 << 16
#: Pieces for each shingle in which sets of a band may differ.
PIECES = 1.25
#: Sizes from one band to the next.
BAND = 1.5
#: Bits a shingle of the sketches whose Hamming distances are taken, and the fewest.
DENSE, LEAST_BITS = 4, 256


def difference(n: int, m: int, percent: int) -> int:
    """In how many shingles sets of these sizes and the asked similarity may differ."""
    return (100 - percent) * (n + m) // (100 + percent)


class Bands:
    """For each band, sizes up to ``last`` and the number of pieces."""

    def __init__(self, percent: int):
        self.percent, self.last, size = percent, [], 1.0
        while size < 1e13:
            size *= BAND
            edge = int(np.ceil(size)) - 1
            if edge >= 1 and (not self.last or edge > self.last[-1]):
                self.last.append(edge)
        self.pieces = [1 + int(np.ceil(PIECES * (1 + difference(e, e * 100 // percent, percent)))) for e in self.last]

    def of(self, n: int) -> list[tuple[int, int, int]]:
        """(band, pieces, how many of them similar sets may not share) where a set of n shingles is to be found."""
        k = int(np.searchsorted(self.last, n))
        own = difference(n, n * 100 // self.percent, self.percent)
        if not own:  # similar sets are equal
            return []
        out = [(k, self.pieces[k], own)]
        if k and 100 * self.last[k - 1] >= self.percent * n:
            out.append((k - 1, self.pieces[k - 1], difference(n, self.last[k - 1], self.percent)))
        return out


def piece_digests(x: np.ndarray, band: int, pieces: int) -> np.ndarray:
    """One digest for each piece of the sketch of the distinct hashes ``x``: that of the places whose parity is odd."""
    y = mix(x ^ mix(np.array([band + 0x51ED], U64))[0])
    piece = ((y >> U64(32)) * U64(pieces)) >> U64(32)
    place = mix((piece << U64(16)) | (y & U64(WIDE - 1)))  # a place's code; those of even parity cancel out
    order = np.argsort(piece, kind="stable")
    piece, place = piece[order], place[order]
    first = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1])))
    digest = np.zeros(pieces, U64)
    digest[piece[first].astype(np.int64)] = np.bitwise_xor.reduceat(place, first)
    return mix(digest ^ mix((U64(band) << U64(32)) | np.arange(pieces, dtype=U64)))


def dense_sketch(x: np.ndarray) -> np.ndarray:
    """Parities at the places of a sketch whose bits are a power of two; folding its halves gives that of half the bits."""
    bits = max(LEAST_BITS, 1 << (DENSE * len(x) - 1).bit_length())
    place = mix(x ^ U64(0x2545F4914F6CDD1D)) & U64(bits - 1)
    return np.packbits((np.bincount(place.astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").view("<u8")


def parity_sketches(docs: DataFrame, id_col: str, text_col: str, percent: int, width: int) -> DataFrame:
    """id, n, two digests of the whole set, the sketch, and for each of up to two bands what of the pieces is needed (the
    number that similar sets share) and their digests."""
    bands = Bands(percent)
    names = ["id", "n", "d1", "d2", "sketch", "needed", "values", "needed_below", "values_below"]
    none = np.zeros(0, U64)

    @tidy
    def run(batches):
        for batch in batches:
            rows, ids, size = [], [], 0

            def made():
                n, d1, d2, sketch, need, values, need_, values_ = zip(*rows, strict=True)
                arrays = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), long_lists(sketch), pa.array(need, pa.int32()), long_lists(values), pa.array(need_, pa.int32()), long_lists(values_)]
                return pa.RecordBatch.from_arrays(arrays, names)

            for i, (x, y) in zip(batch.column(0).to_pylist(), minhash.set_hashes(batch.column(1), width), strict=True):
                found = bands.of(len(x)) if len(x) else []
                pieces = [(m - d, piece_digests(x, k, m)) for k, m, d in found] + [(0, none)] * (2 - len(found))
                sketch = dense_sketch(x) if found else none
                rows.append((max(len(x), len(y)), *minhash.digests(x, y), sketch, *pieces[0], *pieces[1]))
                ids.append(i)
                size += len(sketch) + sum(len(v) for _, v in pieces)
                if size > 1 << 19:
                    yield made()
                    rows, ids, size = [], [], 0
            if rows:
                yield made()

    schema = "id long, n long, d1 long, d2 long, sketch array<long>, needed int, values array<long>, needed_below int, values_below array<long>"
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _folded(x: Column, to: Column) -> Column:
    """The sketch folded to so many numbers: of similar sets, the larger one's has at most twice as many."""
    return F.when(F.size(x) == to, x).otherwise(F.zip_with(F.slice(x, F.lit(1), to), F.slice(x, to + 1, to), lambda a, b: a.bitwiseXOR(b)))


def hamming(a: Column, b: Column) -> Column:
    to = F.least(F.size(a), F.size(b))
    return F.aggregate(F.zip_with(_folded(a, to), _folded(b, to), lambda x, y: x.bitwiseXOR(y)), F.lit(0), lambda s, x: s + F.bit_count(x).cast("int"))


def near_links(docs: DataFrame, nodes: DataFrame, wide: DataFrame, percent: int, id_col: str, text_col: str, width: int) -> DataFrame:
    """(a, b): links that make the same components as all pairs of nodes with similarity of at least ``percent``."""
    own = keyed_join(wide.where("needed > 0"), nodes.select("node", "id", "n", "d1", "d2"), ["id", "n", "d1", "d2"], "inner").select("node", *wide.columns)
    own = stage(own.dropDuplicates(["node"]) if nodes._repeats else own, "parity-nodes")
    unstage(wide)
    # a node has a slot for each of its bands
    slots = [own.select((2 * F.col("node") + k).alias("node"), "n", F.col(f"needed{x}").alias("needed"), F.col(f"values{x}").alias("values")) for k, x in enumerate(("", "_below"))]
    slots = slots[0].unionByName(slots[1].where("needed > 0"))
    met = minhash.inverted_lists(slots, "values", F.col("needed"))
    lists = stage(met.select("value", F.shiftright("node", 1).alias("node"), "n"), "parity-lists")
    unstage(met)
    sketch = own.select("node", "n", "sketch")
    # sizes as of similar sets first: only these fold to one another
    close = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    allowed = (100 + percent) * hamming(F.col("sketch_a"), F.col("sketch_b")) <= (100 - percent) * (F.col("n_a") + F.col("n_b"))
    links = minhash.near_links(docs, nodes, percent, id_col, text_col, width, lists, lambda pairs: minhash.pairs_that(pairs, sketch, F.when(close, allowed).otherwise(False)))
    unstage(own)
    return links


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept (whether it is the component's smallest id), set_id (the
    smallest id with the same set)."""
    wide = stage(parity_sketches(docs, id_col, text_col, percent, width), "parity-all")
    known = stage(wide.select("id", "n", "d1", "d2"), "parity-known")
    return minhash.labelled(known, lambda nodes: near_links(docs, nodes, wide, percent, id_col, text_col, width), id_col)
