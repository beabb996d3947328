"""Ranked lexical search: all documents are ranked for each item of a query set, by dense matrix products.

Items go in blocks of at most `BLOCK_TERMS` terms (an item with more is a block of its own). Per
block, one pass over the texts counts the block's terms in each document; the counts are written
once. From them come the sizes of the collection and the weights of the terms, and a second pass
multiplies tiles: the rows are documents with the impacts of a compact tile of the block's terms,
the columns are items with their weights. Impacts are below 10**6 and a tile is cut so that no
partial sum reaches 2**53, so every product in float64 is an exact integer, and partial sums are
added as 64-bit integers. Each task keeps the `k` best documents per item, ties by id, and the
lists of the tasks are merged in two steps.

Defined results: a null text, or one without terms, has no rank and does not count; an item
without terms has no rows; documents with the same id, and items with the same id, are ranked each
on its own; a null document id comes after all others of equal score; an empty table gives an
empty table; columns other than the four named are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

BLOCK_TERMS = 1 << 18  # terms of a block of items: bounds the vocabulary that tasks receive
TILE_TERMS = 4096  # columns of a tile of documents, at most
TILE_ITEMS = 256  # items of a tile
TILE_DOCS = 512  # documents of a tile
MERGED_TILES = 8  # tiles of documents between two merges of the best lists
MERGED_PARTS = 64  # partitions whose lists meet in the first merge
EXACT = 1 << 53
IMPACT = 1_000_000_000  # over 1000 in the divisor, impacts stay below 10**6

#: Bytes outside terms become blanks, A-Z become lower case; bytes of other code points stay.
_BYTES = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(raw: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return raw.translate(_BYTES).split()


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text of an Arrow column; a null is empty."""
    column = column.cast(pa.large_binary())
    places = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1].tolist()
    data = memoryview(column.buffers()[2] or b"")
    missing = column.is_null().to_pylist() if column.null_count else None
    for i in range(len(column)):
        yield b"" if missing and missing[i] else bytes(data[places[i]:places[i + 1]])


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Items with their distinct terms, a block at a time on the driver."""
    block, terms = [], set()
    for row in items.select(F.col(item_id), F.col(text)).toLocalIterator():
        own = sorted(set(terms_of((row[1] or "").encode())))
        if block and len(terms) + len(own) > BLOCK_TERMS:
            yield block
            block, terms = [], set()
        block.append((row[0], own))
        terms.update(own)
    if block:
        yield block


def count_terms(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document with a term: its id, `n` (its terms with repeats), and the places in `vocabulary` and counts of its known terms."""
    place = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = place.value
        for batch in batches:
            rows, totals, places, counts, ends = [], [], [], [], [0]
            for i, raw in enumerate(texts_of(batch.column(1))):
                found = terms_of(raw)
                if not found:
                    continue
                tally = Counter(found)
                hits = tally.keys() & known.keys()
                rows.append(i)
                totals.append(len(found))
                places.extend(map(known.__getitem__, hits))
                counts.extend(map(tally.__getitem__, hits))
                ends.append(len(places))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows, pa.int64())), pa.array(totals, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places, pa.int32())),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(counts, pa.int32())),
            ], ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(
        count, "doc_id long, n long, terms array<int>, counts array<int>")


def collection_sizes(counted: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms with repeats, and the documents that hold each term of the block."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holders, sizes = np.zeros(n_terms, np.int64), np.zeros(2, np.int64)
        for batch in batches:
            holders += np.bincount(batch.column(1).flatten().to_numpy(), minlength=n_terms)
            sizes += (len(batch), batch.column(0).to_numpy().sum())
        all_sums = np.concatenate([sizes, holders])
        used = np.flatnonzero(all_sums)
        yield pa.RecordBatch.from_arrays([pa.array(used - 2), pa.array(all_sums[used])], ["term", "sum"])

    sums = counted.select("n", "terms").mapInArrow(fold, "term long, sum long").groupBy("term").agg(F.sum("sum").alias("sum"))
    found = dict(map(tuple, sums.collect()))  # a row per term of the block, at most
    holders = np.array([found.get(i, 0) for i in range(n_terms)], np.int64)
    return found.get(-2, 0), found.get(-1, 0), holders


def weight(n_docs: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders + 1)))


def impacts(counts: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """`counts` of terms in documents of `lengths` terms, damped by count and length; whole numbers below 10**6."""
    if 50 * n_docs * int(lengths.max(initial=0)) < 2**63:
        m = 50 + (50 * lengths * n_docs) // n_terms
    else:
        m = np.array([50 + 50 * int(x) * n_docs // n_terms for x in lengths], np.int64)
    return (IMPACT * counts) // (1000 * counts + 20 * m)


def _tiles(items: list[np.ndarray], weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(items, terms) of each tile: few items with few terms together, the terms cut where a sum could get inexact."""
    tiles, now, terms = [], [], set()
    for i, own in enumerate(items):
        if now and (len(now) == TILE_ITEMS or len(terms.union(own.tolist())) > TILE_TERMS):
            tiles.append((now, terms))
            now, terms = [], set()
        now.append(i)
        terms.update(own.tolist())
    if now:
        tiles.append((now, terms))
    most = max(1, min(TILE_TERMS, EXACT // (10**6 * max(1, int(weights.max(initial=0)))) - 1))
    return [(np.array(own), np.array(sorted(terms)[a:a + most], np.int64))
            for own, terms in tiles for a in range(0, len(terms), most)]


class _Best:
    """The best documents of each item so far: score from high to low, then null ids last, then id."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.items, self.scores, self.ids, self.nameless = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))
        self.least = np.zeros(n_items, np.int64)  # a document needs this score to enter

    def add(self, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        """Scores of documents (rows) for all items (columns)."""
        doc, item = np.nonzero((scores >= self.least) & (scores > 0))
        items = np.concatenate([self.items, item])
        points = np.concatenate([self.scores, scores[doc, item]])
        names, blank = np.concatenate([self.ids, ids[doc]]), np.concatenate([self.nameless, nameless[doc]])
        order = np.lexsort((names, blank, -points, items))
        first = np.searchsorted(items[order], np.arange(len(self.least)))
        place = np.arange(len(order)) - first[items[order]]
        kept = order[place < self.k]
        self.items, self.scores, self.ids, self.nameless = items[kept], points[kept], names[kept], blank[kept]
        full = order[place == self.k - 1]
        self.least[items[full]] = points[full]


def _rank_block(counted: DataFrame, block: list, vocabulary: list[bytes], k: int) -> DataFrame:
    n_docs, n_terms, holders = collection_sizes(counted, len(vocabulary))
    weights = np.array([weight(n_docs, int(x)) for x in holders], np.int64)
    place = {t: i for i, t in enumerate(vocabulary)}
    own = [np.array([place[t] for t in terms], np.int64) for _, terms in block]
    query = counted.sparkSession.sparkContext.broadcast((own, weights, _tiles(own, weights)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, weights, tiles = query.value
        best = _Best(len(own), k)
        column, row_of = np.full(len(weights), -1), {}
        for batch in batches:
            nameless = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy()
            lengths = batch.column(1).to_numpy()
            for a in range(0, len(batch), TILE_DOCS * MERGED_TILES):
                b = min(a + TILE_DOCS * MERGED_TILES, len(batch))
                terms, counts = batch.column(2).slice(a, b - a), batch.column(3).slice(a, b - a)
                doc = np.repeat(np.arange(b - a), terms.value_lengths().to_numpy())
                terms, counts = terms.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64)
                impact = impacts(counts, lengths[a:b][doc], n_docs, n_terms).astype(np.float64)
                sums = np.zeros((b - a, len(own)), np.int64)
                for items, part in tiles:
                    column[part] = np.arange(len(part))
                    right = np.zeros((len(part), len(items)))
                    for j, i in enumerate(items):
                        mine = own[i][column[own[i]] >= 0]
                        right[column[mine], j] = weights[mine]
                    inside = column[terms] >= 0
                    d, t, x = doc[inside], column[terms[inside]], impact[inside]
                    starts = np.searchsorted(d, np.arange(0, b - a + TILE_DOCS, TILE_DOCS))
                    for s in range(len(starts) - 1):
                        at, to = starts[s], starts[s + 1]
                        if at == to:
                            continue
                        low = s * TILE_DOCS
                        left = np.zeros((min(TILE_DOCS, b - a - low), len(part)))
                        left[d[at:to] - low, t[at:to]] = x[at:to]
                        sums[low:low + len(left), items] += (left @ right).astype(np.int64)
                    column[part] = -1
                best.add(sums, ids[a:b], nameless[a:b])
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.items), pa.array(best.ids, mask=best.nameless), pa.array(best.scores)], ["item", "doc_id", "score"])

    lists = counted.mapInArrow(score, "item long, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = W.partitionBy("item", "__some").orderBy(*order)
    ranked = lists.withColumn("__some", F.floor(F.spark_partition_id() / MERGED_PARTS)).withColumn(
        "rank", F.row_number().over(some)).where(F.col("rank") <= k)
    return ranked.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).where(
        F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per item, its `k` documents of highest score above 0: `item_id`, `rank` (from 1), `doc_id`, `score`.

    A document with tf occurrences of a term that df of N documents hold scores
    floor(1000 ln((2N+2)/(2df+1))) times tf/(tf + length norm) in millionths, summed over the
    distinct terms of the item.
    """
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in _blocks(items, item_id, item_text):
        vocabulary = sorted(set().union(*[terms for _, terms in block]))
        if not vocabulary:
            continue
        counted = materialize(count_terms(docs, vocabulary, id_col, text_col))
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)], f"item long, item_id {kind}")
        ranked = _rank_block(counted, block, vocabulary, k).join(names, "item")
        out = out.unionByName(ranked.select("item_id", "rank", "doc_id", "score"))
    return out
