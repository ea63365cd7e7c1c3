"""Language ID with word-first backoff.

A known word scores by its log frequency in each language. A word that training has not seen falls back to its
character n-grams: the longest order with a known one decides, by the mean over the known ones.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.session import materialize

TRAIN_DOCS = 4000  # about so many documents of each language are learned from, picked by hash: bounds what is broadcast
ORDERS = (4, 3, 2, 1)
SMOOTH = 0.5
UNKNOWN = "und"
_LETTERS = regex.compile(r"\p{L}+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def grams(word: str, order: int) -> list[str]:
    """Character n-grams of a word with its edges marked."""
    marked = f"^{word}$" if order > 1 else word
    return [marked[i:i + order] for i in range(len(marked) - order + 1)]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of the documents by language, summed within a batch."""
    for batch in batches:
        by: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            by.setdefault(lang, Counter()).update(_LETTERS.findall((text.as_py() or "").lower()))
        rows = [(lang, w, n) for lang, c in by.items() for w, n in c.items()]
        if rows:
            lang, word, n = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(word), pa.array(n, pa.int64())], ["lang", "word", "n"])


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by: dict[tuple[str, str], int] = {}
        for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
            for order in ORDERS:
                for g in grams(word, order):
                    by[lang, g] = by.get((lang, g), 0) + n
        if by:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in by]), pa.array([k[1] for k in by]), pa.array(list(by.values()), pa.int64())],
                                             ["lang", "gram", "n"])


class Table:
    """Items and, by language that has them, how much more frequent they are than where they are unseen (logs).

    What an unseen item has is the same in every language, so it tells none apart and takes no room.
    """

    def __init__(self, langs: list[str], rows: list[tuple[str, str, int]], part: Callable[[str], int]):
        """Each part (all words, or the n-grams of an order) by itself."""
        lang_at = {x: i for i, x in enumerate(langs)}
        self.at: dict[str, int] = {}
        item = np.fromiter((self.at.setdefault(x, len(self.at)) for _, x, _ in rows), np.int64, len(rows))
        lang = np.fromiter((lang_at[x] for x, _, _ in rows), np.int64, len(rows))
        n = np.fromiter((n for _, _, n in rows), np.float64, len(rows))
        parts = np.fromiter((part(x) for _, x, _ in rows), np.int64, len(rows))
        logs = np.zeros(len(rows))
        for p in np.unique(parts):
            own = parts == p
            sums = np.maximum(np.bincount(lang[own], n[own], len(langs)), 1)
            # an item unseen in a language is as rare in a language of little text as in one of much
            logs[own] = np.log1p(n[own] / sums[lang[own]] * (sums.max() / SMOOTH))
        order = np.argsort(item, kind="stable")
        self.langs, self.logs = lang[order].astype(np.int32), logs[order].astype(np.float32)
        self.begin = np.r_[0, np.cumsum(np.bincount(item, minlength=len(self.at)))]

    def sums(self, places: list[int], times: np.ndarray, size: int) -> np.ndarray:
        """Logs by language of the items at ``places``, each so many times."""
        at = np.array(places, np.int64)
        n = self.begin[at + 1] - self.begin[at]
        rows = np.repeat(self.begin[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(self.langs[rows], self.logs[rows] * np.repeat(times, n), size)


class Model:
    """Log frequencies by language of known words and n-grams."""

    def __init__(self, langs: list[str], words: list[tuple[str, str, int]], n_grams: list[tuple[str, str, int]]):
        self.langs = langs
        self.words, self.grams = Table(langs, words, lambda _: 0), Table(langs, n_grams, len)

    def _unseen(self, w: str) -> list[int]:
        """Places of the known n-grams of a word, of the longest order that has one."""
        for order in ORDERS:
            seen = [self.grams.at[g] for g in grams(w, order) if g in self.grams.at]
            if seen:
                return seen
        return []

    def predict(self, text: str | None) -> tuple[str, float]:
        items = Counter(_LETTERS.findall(text.lower())) if text else None
        if not items or not self.langs:
            return UNKNOWN, 0.0
        known, times = [], []
        parts, sizes, unseen_times = [], [], []
        for w, n in items.items():
            if (at := self.words.at.get(w)) is not None:
                known.append(at)
                times.append(n)
            elif seen := self._unseen(w):
                parts += seen
                sizes.append(len(seen))
                unseen_times.append(n)
        total = self.words.sums(known, np.array(times, np.float64), len(self.langs)) if known else np.zeros(len(self.langs))
        if parts:  # each unseen word has the mean of its n-grams
            total = total + self.grams.sums(parts, np.repeat(np.array(unseen_times) / np.array(sizes), sizes), len(self.langs))
        p = np.exp(total - total.max())
        p /= p.sum()
        best = int(p.argmax())  # a tie goes to the first by code point
        return self.langs[best], float(p[best])


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Learn from the texts and languages of rows that are not held out, about ``train_docs`` of each language.

    The rows of a language with the smallest hashes are taken. Counting is done in Spark; only the model comes to the
    driver: all words and n-grams of the sample, which bounds them for each language by itself.
    """
    own = docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    sizes = own.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    # a row a language, of which the model has a column each: broadcast, so that no text is shuffled
    sample = own.join(F.broadcast(sizes), "lang").where(pick < F.lit(train_docs) / F.col("_n"))
    counts = materialize(sample.select("lang", "text").mapInArrow(_counts, "lang string, word string, n bigint")
                         .groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")  # texts are read once
    n_grams = counts.mapInArrow(_gram_counts, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))

    def rows(table: DataFrame) -> list[tuple[str, str, int]]:
        found = table.toArrow()
        return list(zip(*(found.column(i).to_pylist() for i in range(3))))

    words = rows(counts)
    return Model(sorted({r[0] for r in words}), words, rows(n_grams))


def predicted(text: Column, model: Model) -> Column:
    """Struct of lang_pred and score for a text column."""
    shared = _broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = shared.value
        return pd.DataFrame([found.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(text)


def _broadcast(model: Model):
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession().sparkContext.broadcast(model)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score for each row of ``docs`` (doc_id, text; lang to learn from).

    The score is the predicted language's share of the likelihood. Null texts and texts without a letter are ``und``
    with score 0, as is everything where nothing could be learned. Ties go to the first language by code point. A text
    of which no word or n-gram is known has equal shares. A null doc_id counts as empty text in the split. Repeated
    rows give equal results; other columns are ignored. An empty table gives no rows.
    """
    model = model or train(docs)
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predicted(F.col("text"), model).alias("_p"))
            .select("doc_id", "held_out", "_p.lang_pred", "_p.score"))


def keep_known_language(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose language the model cannot tell; all columns, whatever their names.

    Rejected are ``und``, so null and empty texts and texts without a letter, and texts of which the model knows no word and no n-gram, which leaves all languages
    with equal shares: text in a script or of letters that no language was learned with. A tie of known words stays. Long texts are judged whole,
    repeated rows alike, null ids like others; rows learn the model only if they have a lang. Where nothing could be learned every row goes; with one
    language every row with a letter stays. An empty table gives no rows.
    """
    model = train(docs)
    told = predicted(F.col("text"), model)
    shares = F.lit((1 + 1e-9) / len(model.langs) if len(model.langs) > 1 else 0.0)
    return docs.where((told["lang_pred"] != UNKNOWN) & (told["score"] > shares))
