"""MinHash near-dedup by a multi-index Hamming join.

1. Documents with one shingle set become a class. Each class gets a signature of ``PLACES`` minima, ``BITS`` bits each.
2. A signature is split into ``CHUNKS`` chunks. Signatures that differ in at most ``DISTANCE`` places differ in at most
   ``DISTANCE // CHUNKS`` = 1 place of some chunk, so a chunk is entered once for each place left out. Two signatures
   within the distance meet under at least one of these keys.
3. Tasks walk over the sorted keys and join signatures within the distance. Of the meeting classes of a key they give
   out a spanning forest, never the pairs. The components of all forests hold every pair within the distance.
4. Inside a component links are confirmed on full shingle sets: in blocks of bounded size, every block against every
   other, each giving out a spanning forest of its links. The components of those are the result.

A pair with Jaccard similarity 0.85 differs in 4.8 of 32 places on average and in more than 15 with probability 4e-6; one
with 0.80, from which the pipeline takes near copies, in 6.4 and with probability 1.5e-4.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm.components import components
from pagequarry.llm.tokens import lower_ascii, mix, rolling, word_hashes, words
from pagequarry.operators.membership import split_members, without_members
from pagequarry.session import materialize

SHINGLE = 5
PERCENT = 85  # of the query op4
COPY_PERCENT = 80  # of near copies that a pipeline drops
PLACES, BITS, CHUNKS, DISTANCE = 32, 16, 8, 15
BLOCK_DOCS, BLOCK_SHINGLES = 512, 1_000_000  # of a block in the confirmation: bounds a task's memory
HELD = 65_536  # signatures of one key that a task compares with each other; beyond, parts are joined unseen
_SEED = np.random.default_rng(20).integers(1, 2**63, (2, PLACES), dtype=np.uint64) | np.uint64(1)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle; no words, none."""
    items = words(lower_ascii(text))
    if not items:
        return np.empty(0, np.uint64)
    hashes = word_hashes(items)
    return np.unique(rolling(hashes, range(min(size, len(items)))))


def _signature(values: np.ndarray) -> np.ndarray:
    return np.array([mix(values * _SEED[0, k] + _SEED[1, k]).min() for k in range(PLACES)], np.uint64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, out = batch.column(0), []
        for text in batch.column(1):
            s = shingles(text.as_py())
            out.append((len(s), xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None,
                        _signature(s).astype(np.uint16).tobytes() if len(s) else None))
        n, digest, sig = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                                          pa.array(sig, pa.binary())], ["doc_id", "n_shingles", "digest", "sig"])


def _keys(batches: Iterator[pa.RecordBatch], chunks: int) -> Iterator[pa.RecordBatch]:
    """Every signature under each chunk with one place left out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
        keys = []
        for c, chunk in enumerate(np.array_split(np.arange(sig.shape[1]), chunks)):
            for left_out in chunk:
                h = np.full(len(sig), c * 64 + int(left_out), np.uint64)
                for p in chunk[chunk != left_out]:
                    h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, p])
                keys.append(h)
        for h in keys:
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column(0), batch.column(1)],
                                             ["key", "id", "sig"])


def _forest(near, n: int) -> Iterator[tuple[int, int]]:
    """(smallest, other) index pairs that connect what ``near(i, others)`` connects; each reach leaves fewer to reach."""
    left = np.arange(n)
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            hit = near(front.pop(), left)
            found, left = left[hit], left[~hit]
            front.extend(found.tolist())
            for f in found.tolist():
                yield int(root), f


def _meet(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Spanning forests of the signatures within the distance, key by key, from rows sorted by key and id."""
    held: list[tuple[np.ndarray, np.ndarray]] = []  # the rows so far of the key that may go on
    held_key, chained = None, None

    def links() -> list[tuple[int, int]]:
        nonlocal held, chained
        ids = np.concatenate([i for i, _ in held]) if held else np.empty(0, np.int64)
        if chained is not None:
            out = [(chained, i) for i in ids.tolist()]
        elif len(ids) < 2:
            out = []
        else:
            sig = np.concatenate([s for _, s in held])
            out = [(int(ids[a]), int(ids[b])) for a, b in
                   _forest(lambda i, o: (sig[o] != sig[i]).sum(axis=1) <= distance, len(ids))]
        held, chained = [], None
        return out

    def batch_of(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = zip(*pairs)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        out: list[tuple[int, int]] = []
        keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(len(keys), -1)
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        end = np.r_[first[1:], len(keys)]
        if keys[0] != held_key:
            out += links()
        shared = (end - first > 1) | (first == 0) | (end == len(keys))
        for b, e in zip(first[shared].tolist(), end[shared].tolist()):
            held.append((ids[b:e], sig[b:e]))
            if e < len(keys):
                out += links()
        held_key = keys[-1]
        if sum(len(i) for i, _ in held) > HELD:
            # joining more than is near only widens the component in which full sets decide
            head = int(held[0][0][0]) if chained is None else chained
            out += [(head, i) for part, _ in held for i in part.tolist()]
            held, chained = [], head
        if out:
            yield batch_of(out)
    if out := links():
        yield batch_of(out)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [shingles(t.as_py()).tobytes() for t in batch.column(3)]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(made, pa.binary())],
                                         ["id", "root", "blocks", "shingles"])


def _confirm(table: pa.Table, percent: int) -> pa.Table:
    """A spanning forest of the links among the documents of a pair of blocks."""
    table = table.sort_by("id")
    ids = table.column("id").to_numpy()
    raw = table.column("shingles").to_pylist()
    size = np.array([len(r) // 8 for r in raw], np.int64)
    flat = np.frombuffer(b"".join(raw), np.uint64)
    _, code = np.unique(flat, return_inverse=True)
    begin = np.r_[0, np.cumsum(size)]
    mark = np.zeros(int(code.max()) + 1 if len(code) else 1, np.int64)

    def near(i: int, others: np.ndarray) -> np.ndarray:
        mine = code[begin[i]:begin[i + 1]]
        mark[mine] = 1
        if len(others) * 2 > len(ids):
            inter = np.add.reduceat(mark[code], begin[:-1])[others]
        else:
            inter = np.array([mark[code[begin[o]:begin[o + 1]]].sum() for o in others])
        mark[mine] = 0
        return 100 * inter >= percent * (size[i] + size[others] - inter)

    pairs = list(_forest(near, len(ids)))
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.table({"a": pa.array([int(ids[i]) for i in a], pa.int64()), "b": pa.array([int(ids[i]) for i in b], pa.int64())})


def near_dedup(docs: DataFrame, percent: int = PERCENT, distance: int = DISTANCE,
               chunks: int = CHUNKS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_shingles, component_id and kept.

    Two documents are linked if 100 * shared >= ``percent`` * united shingles; component_id is the smallest doc_id
    reachable over links, itself included, and the document with that id is kept.

    Null and empty texts, and texts without words, have no shingles and are linked with nothing. Rows with a null
    doc_id are linked with nothing, have a null component and are kept. Rows that repeat a doc_id share its component
    and are all kept or all not; if their texts differ, the id has the links of each of them. Other columns are ignored. An empty table gives no rows.
    """
    if distance // chunks != 1:
        raise ValueError("keys leave out one place of a chunk: distance must be one to two times the number of chunks")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sketch = materialize(slim.mapInArrow(_sketch, "doc_id bigint, n_shingles bigint, digest binary, sig binary"), "sketch")
    linked = sketch.where("doc_id is not null and digest is not null")
    # equal sets are one class, named by its smallest document
    classes = materialize(linked.groupBy("digest", "sig", "n_shingles").agg(F.min("doc_id").alias("id")), "classes")
    near = (classes.select("id", "sig")
            .mapInArrow(partial(_keys, chunks=chunks), "key bigint, id bigint, sig binary")
            .repartition(width, "key").sortWithinPartitions("key", "id")
            .mapInArrow(partial(_meet, distance=distance), "a bigint, b bigint"))
    groups = components(near)
    need = F.greatest(F.count(F.lit(1)) / BLOCK_DOCS, F.sum("n_shingles") / BLOCK_SHINGLES)
    sizes = (groups.join(classes.select("id", "n_shingles"), "id").groupBy("root")
             .agg(F.ceil(need).cast("int").alias("blocks")))
    members = materialize(groups.join(sizes, "root").select("id", "root", "blocks"), "members")
    near_texts, _ = split_members(slim, [F.col("doc_id")], members.select("id"))  # only texts that may have a link move
    sets = (near_texts.join(members, F.col("doc_id") == F.col("id")).select("id", "root", "blocks", "text")
            .mapInArrow(_sets, "id bigint, root bigint, blocks int, shingles binary"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks").cast("long")).cast("int")
    paired = (sets.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
              .where("own <> other or blocks = 1")
              .select("id", "root", "shingles", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))

    def confirm(table: pa.Table) -> pa.Table:
        return _confirm(table, percent)

    links = paired.groupBy("root", "i", "j").applyInArrow(confirm, "a bigint, b bigint")
    named = materialize(linked.join(classes.select("digest", "id"), "digest").select("doc_id", "id").distinct(), "named")
    # an id that comes with different texts ties their classes together
    several = named.groupBy("doc_id").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    tied = named.join(several, "doc_id").select("a", F.col("id").alias("b"))
    roots = components(links.union(tied))
    placed = (named.join(roots, "id", "left").groupBy("doc_id")
              .agg(F.min(F.coalesce("root", "id")).alias("component")))
    return (sketch.select("doc_id", "n_shingles").join(placed, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_copies(docs: DataFrame, percent: int = COPY_PERCENT) -> DataFrame:
    """``docs`` without the documents that near_dedup does not keep at ``percent``; all columns, whatever their names. Of each group the smallest doc_id stays.

    Null and empty texts stay, as do rows with a null doc_id; rows that repeat a doc_id stay or go together. Long texts count whole. An empty table gives no rows.
    """
    gone = near_dedup(docs, percent).where("not kept").select("doc_id")
    return without_members(docs, [F.col("doc_id").cast("long")], gone)
