"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark.

1. A task hashes all windows of its documents, slice by slice. Of equal windows in a slice only the first goes on, so
   a window that a third of the corpus shares reaches the counting once per slice.
2. Windows are dealt by the leading bits of their hash into buckets, as many as the counted text needs. A bucket finds
   the hashes that several slices have; all but the earliest place are repeats. Hashes travel packed, without keys.
3. Repeats return to their documents, packed by the documents' partition, merge into maximal removal intervals, and the words outside stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm.tokens import mix, rolling, word_hashes, words

WINDOW = 20
SLICE_WORDS = 1_000_000  # windows hashed at once in a task: bounds its memory
BUCKET_BYTES = 16 << 20  # of text whose windows a bucket gets on average: bounds what a task sorts, whatever the corpus
LAST = 2**63 - 1

_PLACED = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary()), ("starts", pa.binary()),
                     ("hashes", pa.binary())])
_FOUND = pa.schema([("home", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary()), ("starts", pa.binary())])


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of equal neighbours."""
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, np.int64)
    return first, np.diff(np.r_[first, len(values)])


def _planes(values: np.ndarray) -> bytes:
    """Steps between neighbours, byte by byte: the low bytes of all, then the next, so that compression finds the zeros."""
    steps = np.diff(values.astype(np.int64), prepend=0)
    zigzag = ((steps << 1) ^ (steps >> 63)).view(np.uint64)
    planes = (int(zigzag.max()).bit_length() + 7) // 8 or 1
    return bytes([planes]) + zigzag.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    n = (len(raw) - 1) // raw[0]
    zigzag = np.zeros((n, 8), np.uint8)
    zigzag[:, :raw[0]] = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], n).T
    zigzag = zigzag.reshape(-1).view(np.uint64)
    return np.cumsum((zigzag >> np.uint64(1)).view(np.int64) ^ -(zigzag & np.uint64(1)).view(np.int64))


def _pack(bucket: int, docs: np.ndarray, starts: np.ndarray, hashes: np.ndarray | None) -> tuple:
    first, count = _runs(docs)
    return bucket, _planes(docs[first]), _planes(count), _planes(starts), None if hashes is None else hashes.tobytes()


def _place_slice(held: list[tuple[int, np.ndarray]], buckets: int) -> Iterator[tuple]:
    """Packed rows of a slice: its distinct windows by bucket, and its own repeats without hashes."""
    held.sort(key=lambda x: x[0])
    hashes = np.concatenate([h for _, h in held])
    docs = np.repeat(np.array([d for d, _ in held], np.int64), [len(h) for _, h in held])
    starts = np.concatenate([np.arange(len(h), dtype=np.uint32) for _, h in held])
    order = np.argsort(hashes, kind="stable")  # equal hashes stay in the order of places
    ranked = hashes[order]
    same = np.r_[False, ranked[1:] == ranked[:-1]]
    first = order[~same]
    if same.any():
        # a repeat at the very place of the first (a row given twice) is no earlier window
        head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
        moved = same & ((docs[order] != docs[head]) | (starts[order] != starts[head]))
        again = np.sort(order[moved])
        for part in np.array_split(again, max(1, len(again) // 50_000)) if len(again) else []:
            yield _pack(int(docs[part[0]] % buckets), docs[part], starts[part], None)
    first.sort()
    bucket = ((hashes[first] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    by = np.argsort(bucket, kind="stable")
    begin, count = _runs(bucket[by])
    for b, n in zip(begin, count):
        rows = first[by[b:b + n]]
        yield _pack(int(bucket[by[b]]), docs[rows], starts[rows], hashes[rows])


def _placed(batches: Iterator[pa.RecordBatch], window: int, buckets: int, slice_words: int) -> Iterator[pa.RecordBatch]:
    held, n = [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        rows = list(_place_slice(held, buckets))
        for i in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + 64]), _PLACED.types)],
                                             schema=_PLACED)

    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            h = rolling(word_hashes(words(text.as_py())), range(window))
            if len(h):
                held.append((doc.as_py(), h))
                n += len(h)
            if n >= slice_words:
                yield from flush()
                held, n = [], 0
    if held:
        yield from flush()


def _unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    docs, starts = [], []
    for d, c, s in zip(*(table.column(i).to_pylist() for i in ("docs", "counts", "starts"))):
        docs.append(np.repeat(_from_planes(d), _from_planes(c)))
        starts.append(_from_planes(s).astype(np.uint32))
    return (np.concatenate(docs), np.concatenate(starts)) if docs else (np.empty(0, np.int64), np.empty(0, np.uint32))


def _repeats(table: pa.Table, homes: int) -> pa.Table:
    """Places of the windows of a bucket that also start earlier."""
    local = pa.compute.is_null(table.column("hashes"))
    placed = table.filter(pa.compute.invert(local))
    hashes = np.frombuffer(b"".join(placed.column("hashes").to_pylist()), np.uint64)
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    equal = ranked[1:] == ranked[:-1]
    shared = order[np.r_[False, equal] | np.r_[equal, False]] if len(ranked) else order
    docs, starts = _unpack(placed)
    docs, starts, hashes = docs[shared], starts[shared], hashes[shared]
    order = np.lexsort((starts, docs, hashes))
    docs, starts, hashes = docs[order], starts[order], hashes[order]
    first, count = _runs(hashes)
    head = np.repeat(first, count)
    late = (docs != docs[head]) | (starts != starts[head])
    own_docs, own_starts = _unpack(table.filter(local))
    docs, starts = np.r_[docs[late], own_docs], np.r_[starts[late], own_starts].astype(np.uint32)
    home = (mix(docs.view(np.uint64)) % np.uint64(homes)).astype(np.int32)
    order = np.lexsort((docs, home))
    home, docs, starts = home[order], docs[order], starts[order]
    first, count = _runs(home)
    rows = [_pack(int(home[f]), docs[f:f + n], starts[f:f + n], None)[:4] for f, n in zip(first, count)]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, _FOUND.types)], schema=_FOUND)


def _gathered(table: pa.Table) -> pa.Table:
    """All repeats of each document of a home."""
    docs, starts = _unpack(table)
    order = np.argsort(docs, kind="stable")
    docs, starts = docs[order], starts[order]
    first, count = _runs(docs)
    return pa.table({"place": pa.array(docs[first]), "starts": pa.array([starts[f:f + n].tobytes() for f, n in zip(first, count)], pa.binary())})


def _removed(texts: list, repeats: list, window: int) -> Iterator[tuple]:
    """Words, the removed ones, maximal removal intervals and the kept text of each document."""
    for text, starts in zip(texts, repeats):
        items = words(text)
        n = len(items)
        edge = np.zeros(n + 1, np.int32)
        if starts:
            at = np.unique(np.frombuffer(starts, np.uint32)).astype(np.int64)
            at = at[at <= n - window]
            edge[at] += 1
            edge[at + window] -= 1
        gone = np.cumsum(edge[:n]) > 0
        change = np.flatnonzero(np.diff(np.r_[False, gone, False]))
        kept = b" ".join([w for w, g in zip(items, gone.tolist()) if not g] if len(change) else items)
        yield n, int(gone.sum()), change.reshape(-1, 2).tolist(), kept


_RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, removed array<array<bigint>>, kept_text string"


def _cut(batches: Iterator[pa.RecordBatch], window: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, repeats = (batch.column(i).to_pylist() for i in range(3))
        out = [(d, n, g, hashlib.sha256(k).hexdigest(), spans, k.decode("utf-8", "surrogatepass") if with_text else None)
               for d, (n, g, spans, k) in zip(ids, _removed(texts, repeats, window))]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                         ["doc_id", "n_words", "n_removed", "kept_sha256", "removed", "kept_text"])


def substring_dedup(docs: DataFrame, window: int = WINDOW, slice_words: int = SLICE_WORDS,
                    with_text: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): words, removed words, hash of the kept ones, removal intervals
    (word positions, end exclusive) and, ``with_text``, the kept words joined by a space.

    A word goes if a window of ``window`` words that covers it also starts earlier: in a smaller doc_id, or earlier
    in the same document. Windows are judged on the input.

    Null and empty texts have no words. A null doc_id counts as the largest. Rows with one doc_id are one document
    given several times: equal places are no repeats of each other, and what is removed at a place is removed in
    each. Other columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # one number
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def late(table: pa.Table) -> pa.Table:
        return _repeats(table, buckets)

    repeats = (
        slim.select(place.alias("place"), "text")
        .mapInArrow(partial(_placed, window=window, buckets=buckets, slice_words=slice_words),
                    "bucket int, docs binary, counts binary, starts binary, hashes binary")
        .repartition(buckets, "bucket").groupBy("bucket").applyInArrow(late, "home int, docs binary, counts binary, starts binary")
        .groupBy("home").applyInArrow(_gathered, "place bigint, starts binary")
    )
    return (slim.withColumn("place", place).join(repeats, "place", "left").select("doc_id", "text", "starts")
            .mapInArrow(partial(_cut, window=window, with_text=with_text), _RESULT))
