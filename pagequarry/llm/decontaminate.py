"""Benchmark decontamination by spaced-seed hashes.

Fixed masks pick some words out of a span and ignore the rest, so a hash survives substitutions at ignored places. The
hashes of test items and training documents are joined; around each hit the words of both are compared along the
diagonal, and overlaps that are long and alike enough count. The masks are chosen so that wherever substitutions lie, one
of them fits between those of any stretch with ``MIN_MATCH`` equal words that are ``MIN_SHARE`` of it: none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm.tokens import plain_words, rolling, word_hashes
from pagequarry.operators.membership import split_members, without_members
from pagequarry.session import materialize

MASKS = ("111111", "1101111", "1110111", "110100000111")  # 1: the word counts, 0: it is ignored
MIN_MATCH = 13  # equal words of an overlap; of a shorter item, all its words
MIN_SHARE = 0.8  # equal words of an overlap's length
FILTER_BITS = 23  # of the bitmap that holds documents' hashes back which no item can have: 8 MB in each task
SHORTEST_ITEM = 5  # default of the parameter: shorter items are phrases that clean documents have too


def _offsets(mask: str) -> tuple[int, ...]:
    return tuple(i for i, c in enumerate(mask) if c == "1")


def _seeds(hashes: np.ndarray, masks: tuple[str, ...], runs: tuple[int, ...]) -> Iterator[tuple[np.ndarray, int]]:
    """Seed hashes at every place, by mask and then for runs of whole items that are shorter than a mask."""
    for k, offsets in enumerate(map(_offsets, masks)):
        yield rolling(hashes, offsets) + np.uint64(k + 1), 0
    for n in runs:
        yield rolling(hashes, range(n)) + np.uint64(n + 100), n


_ITEM = "seed bigint, item_id bigint, item_at int, run int"
_DOC = "seed bigint, doc_id bigint, _text bigint, doc_at int"


def _item_seeds(batches: Iterator[pa.RecordBatch], masks: tuple[str, ...], shortest: int) -> Iterator[pa.RecordBatch]:
    longest = max(map(len, masks))
    for batch in batches:
        for item, text in zip(batch.column(0), batch.column(1)):
            hashes = word_hashes(plain_words(text.as_py()))
            n = len(hashes)
            if n < max(shortest, 1):
                continue
            for seed, run in _seeds(hashes, masks, (n,) if n < longest else ()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seed.view(np.int64)), pa.array(np.full(len(seed), item.as_py(), np.int64)),
                     pa.array(np.arange(len(seed), dtype=np.int32)), pa.array(np.full(len(seed), run, np.int32))],
                    ["seed", "item_id", "item_at", "run"])


def _doc_seeds(batches: Iterator[pa.RecordBatch], masks: tuple[str, ...], runs: tuple[int, ...],
               bitmap: np.ndarray) -> Iterator[pa.RecordBatch]:
    low = np.uint64((1 << FILTER_BITS) - 1)
    for batch in batches:
        seeds, places, rows = [], [], []
        for row, text in enumerate(batch.column(2)):
            for seed, _ in _seeds(word_hashes(plain_words(text.as_py())), masks, runs):
                at = np.flatnonzero(bitmap[seed & low])
                if len(at):
                    seeds.append(seed[at])
                    places.append(at)
                    rows.append(np.full(len(at), row))
        if seeds:
            of = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(seeds).view(np.int64)), batch.column(0).take(of), batch.column(1).take(of),
                 pa.array(np.concatenate(places).astype(np.int32))], ["seed", "doc_id", "_text", "doc_at"])


def best_overlap(doc: np.ndarray, item: np.ndarray, diagonal: int, min_share: float = MIN_SHARE) -> tuple[int, int, int]:
    """(start, end, equal words) in the document of the stretch along a diagonal (document minus item place) with the
    most equal words of those that are equal to ``min_share``; of several the shortest, then the first."""
    lo, hi = max(0, diagonal), min(len(doc), len(item) + diagonal)
    same = doc[lo:hi] == item[lo - diagonal:hi - diagonal]
    starts = np.flatnonzero(same)
    if not len(starts):
        return lo, lo, 0
    share = Fraction(str(min_share))
    # a stretch has the share if the sum does not fall over it; whole numbers, so that the share itself counts
    total = np.r_[0, np.cumsum(np.where(same, share.denominator - share.numerator, -share.numerator))]
    ahead = np.maximum.accumulate(total[::-1])  # the highest sum from a place on, from the last place to the first
    ends = len(same) - np.searchsorted(ahead, total[starts])  # the farthest that is as high as the start
    last = np.r_[0, np.maximum.accumulate(np.where(same, np.arange(1, len(same) + 1), 0))][ends]  # ends on an equal word
    equal = np.r_[0, np.cumsum(same)]
    found = equal[last] - equal[starts]
    best = np.lexsort((last - starts, -found))[0]
    return lo + int(starts[best]), lo + int(last[best]), int(found[best])


def _verify(batches: Iterator[pa.RecordBatch], min_match: int, min_share: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, last = [], (None, None)
        for doc, key, text, item, item_text, diagonals in zip(*(batch.column(i) for i in range(6))):
            if last[0] != (doc.as_py(), key.as_py()):
                last = (doc.as_py(), key.as_py()), word_hashes(plain_words(text.as_py()))
            hashes, words = last[1], word_hashes(plain_words(item_text.as_py()))
            found = [best_overlap(hashes, words, d, min_share) for d in diagonals.as_py() if -len(words) < d < len(hashes)]
            need = min(min_match, len(words))
            found = [f for f in found if f[2] >= need]
            if found:
                start, end, same = max(found, key=lambda f: (f[2], -f[0]))
                out.append((doc.as_py(), key.as_py(), item.as_py(), start, end, same, len(words)))
        if out:
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
            names = ["doc_id", "_text", "item_id", "start_word", "end_word", "equal_words", "item_words"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def _overlaps(docs: DataFrame, benchmark: DataFrame, min_match: int, min_share: float, shortest_item: int) -> DataFrame:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item_text")) \
        .where("item_id is not null and item_text is not null")
    item_seeds = materialize(items.mapInArrow(partial(_item_seeds, masks=MASKS, shortest=shortest_item), _ITEM), "item-seeds")
    # at most 2^FILTER_BITS numbers, and fewer lengths than the longest mask has places, come to the driver
    bits = item_seeds.select(F.expr(f"cast(seed & {(1 << FILTER_BITS) - 1} as int)").alias("b")).distinct().toArrow().column(0)
    bitmap = np.zeros(1 << FILTER_BITS, bool)
    bitmap[bits.to_numpy()] = True
    runs = tuple(sorted(r["run"] for r in item_seeds.select("run").where("run > 0").distinct().collect()))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _doc_seeds(batches, MASKS, runs, shared.value)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_text"), "text").where("text is not null")
    hits = texts.select("doc_id", "_text", "text").mapInArrow(seeds, _DOC).join(item_seeds, "seed")
    met = (hits.groupBy("doc_id", "_text", "item_id").agg(F.collect_set(F.expr("doc_at - item_at")).alias("diagonals"))
           .join(items, "item_id").select(F.col("doc_id").alias("_id"), F.col("_text").alias("_key"), "item_id", "item_text", "diagonals"))
    met = materialize(met, "met")
    hit, _ = split_members(texts, [F.col("doc_id"), F.col("_text")], met.select("_id", "_key"))  # only texts with a hit move
    joined = hit.join(met, F.expr("doc_id <=> _id and _text = _key"))
    return joined.select("doc_id", "_text", "text", "item_id", "item_text", "diagonals").mapInArrow(
        partial(_verify, min_match=min_match, min_share=min_share),
        "doc_id bigint, _text bigint, item_id bigint, start_word int, end_word int, equal_words int, item_words int")


def contamination(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, min_share: float = MIN_SHARE,
                  shortest_item: int = SHORTEST_ITEM) -> DataFrame:
    """A row for each document of ``docs`` (doc_id, text) and item of ``benchmark`` (item_id, text) that overlap.

    doc_id, item_id, the best overlap's place in the document's plain words (end exclusive), its equal words and the
    item's length. An overlap needs ``min_match`` equal words, or all of a shorter item, and ``min_share`` of its
    length equal; of several the one with the most equal words counts. None is missed unless less is asked for than
    ``MIN_MATCH`` and ``MIN_SHARE``. Items of fewer than ``shortest_item`` words are not looked for; of items of fewer than ``min_match`` only whole copies.

    Null and empty texts and null item ids meet nothing; long texts are compared whole. Rows with a null doc_id are judged like others. Equal rows give
    equal results; rows that repeat a doc_id with other texts each give theirs. Of equal overlaps the first counts. Other columns are ignored, whatever
    their names. Empty ``docs`` or an empty ``benchmark`` give no rows.
    """
    return _overlaps(docs, benchmark, min_match, min_share, shortest_item).drop("_text")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, shortest_item: int = SHORTEST_ITEM) -> DataFrame:
    """``docs`` without the rows that overlap an item; all columns, whatever their names. No text is shuffled but those with a hit.

    Null and empty texts stay, as does everything against an empty benchmark. Rows with a null doc_id and rows that repeat one go by their own text; equal rows go together.
    Long texts are compared whole. An empty table gives no rows.
    """
    gone = _overlaps(docs, benchmark, MIN_MATCH, MIN_SHARE, shortest_item).select("doc_id", "_text")
    return without_members(docs, [F.col("doc_id").cast("long"), F.xxhash64("text")], gone)
