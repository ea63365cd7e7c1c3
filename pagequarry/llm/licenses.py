"""Licence scan: TF-IDF cosine of whole files to licence texts and of lines to notices, then inheritance from the nearest
directory with a licence file."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from importlib.resources import files as resources

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.session import materialize

LEAST_COSINE = 0.5
TEXT_COSINE = 0.8  # of a whole file to the text of a licence
FILE_SHARE = 0.1  # a licence file that holds no such text and has no such name consists of its statement to this share of its words
FILE_NAME = r"(?i)(^|/)((un)?licen[cs]e|copying)([._-][^/]*)?$"
# Notices of well-known licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal, public domain dedication."),
)
_TERM = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
_SPLIT = re.compile(r"\n|(?<=[.!?]) ")


def terms(text: str | None) -> list[str]:
    return _TERM.findall(text.lower()) if text else []


TEXTS = tuple(sorted((p.name.removesuffix(".txt"), p.read_text(encoding="utf-8"))
                     for p in resources(__package__).joinpath("license_texts").iterdir() if p.name.endswith(".txt")))
NOTICE_TERMS = frozenset(t for _, text in TEMPLATES for t in terms(text))
VOCABULARY = NOTICE_TERMS.union(t for _, text in TEXTS for t in terms(text))


def _frequencies(docs: DataFrame) -> tuple[dict[str, int], int]:
    """In how many documents each template term is, and the number of documents: a row a term, and one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(VOCABULARY.intersection(terms(text.as_py())))
                seen[""] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["term", "n"])

    found = dict(map(tuple, docs.select("text").mapInArrow(count, "term string, n bigint").groupBy("term").agg(F.sum("n")).collect()))
    return found, found.pop("", 0)


# Words that the Affero licence has, in its title and its own section, and the GPL, which names it too, has not.
AFFERO = ("gnu affero general public license version 3", "interacting with it remotely through a computer network")


class Matcher:
    def __init__(self, frequencies: dict[str, int], documents: int):
        self.top = math.log(documents + 1) + 1
        self.idf = {t: math.log((documents + 1) / (frequencies.get(t, 0) + 1)) + 1 for t in VOCABULARY}
        self.templates, self.texts = self._unit(TEMPLATES), self._unit(TEXTS)

    def _unit(self, templates: tuple[tuple[str, str], ...]) -> list[tuple[str, dict[str, float]]]:
        out = []
        for name, text in templates:
            weights = {t: n * self.idf[t] for t, n in Counter(terms(text)).items()}
            norm = math.sqrt(sum(w * w for w in weights.values()))
            out.append((name, {t: w / norm for t, w in weights.items()}))
        return out

    def _best(self, own: Counter, known: frozenset[str], templates: list[tuple[str, dict[str, float]]], least: float) -> tuple[float, str]:
        shared = known.intersection(own)
        if not shared:
            return 0.0, ""
        mine = {t: own[t] * self.idf[t] for t in shared}
        inside = sum(w * w for w in mine.values())
        norm = math.sqrt(inside + self.top ** 2 * sum(n * n for t, n in own.items() if t not in shared))
        if math.sqrt(inside) < (least - 1e-9) * norm:
            return 0.0, ""
        return max((sum(w * weights[t] for t, w in mine.items() if t in weights) / norm, name) for name, weights in templates)

    def line(self, found: list[str], least: float = 0.0) -> tuple[float, str]:
        """The best cosine to a template; terms that no template has are taken for rare.

        Lines that cannot reach ``least``, even if all their template terms met in one template, give nothing.
        """
        return self._best(Counter(found), NOTICE_TERMS, self.templates, least)

    def whole(self, own: Counter, flat: str) -> tuple[float, str]:
        """The best cosine to the text of a licence, of a file with these terms, if it reaches ``TEXT_COSINE``."""
        cosine, name = self._best(own, VOCABULARY, self.texts, TEXT_COSINE)
        if cosine < TEXT_COSINE:
            return 0.0, ""
        # the Affero text is the GPL's but for its title and a section
        return cosine, "AGPL-3.0" if name == "GPL-3.0" and any(p in flat for p in AFFERO) else name

    def text(self, text: str | None) -> tuple[str | None, float, float]:
        """The licence whose text this is, or the best of any sentence or line; its cosine, and the share of the text's
        terms that state it."""
        best, size, total = (0.0, ""), 0, 0
        own: Counter = Counter()
        flat: list[str] = []
        for part in _SPLIT.split(text or ""):
            found = terms(part)
            total += len(found)
            own.update(found)
            flat += found
            if (c := self.line(found, best[0])) > best:
                best, size = c, len(found)
        cosine, name = self.whole(own, " ".join(flat))
        if name:
            return name, cosine, 1.0
        return (best[1] if best[0] >= LEAST_COSINE else None), best[0], size / max(total, 1)


def license_scan(files: DataFrame, path: Column) -> DataFrame:
    """doc_id, path, own_license, cosine, license, license_dir of each row of ``files`` (doc_id, text).

    A file's own licence is the one whose text it is, or else the notice nearest to one of its sentences or lines. A file
    without one has that of the nearest directory above it with a licence file: one that is a licence's text, has the name
    of a licence file and an own licence, or that its statement makes up to ``FILE_SHARE``. Of several in a directory the nearest to its template
    counts, then the smallest path. Null and empty texts have no own licence; a null path inherits nothing and leaves nothing.
    Repeated rows give equal results; other columns are ignored. An empty table gives no rows.
    """
    matcher = files.sparkSession.sparkContext.broadcast(Matcher(*_frequencies(files)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [matcher.value.text(t.as_py()) for t in batch.column(2)]
            name, cosine, share = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(name, pa.string()), pa.array(cosine, pa.float64()),
                                              pa.array(share, pa.float64())], ["doc_id", "path", "own_license", "cosine", "share"])

    own = materialize(files.select(F.col("doc_id").cast("long").alias("doc_id"), path.cast("string").alias("path"), "text").mapInArrow(
        scan, "doc_id bigint, path string, own_license string, cosine double, share double")
        .withColumn("dir", F.regexp_replace("path", "/?[^/]*$", "")), "licences")
    # one row a directory, combined before it is shuffled; ancestors are those of directories, not of files
    given = (own.where(F.col("own_license").isNotNull() & ((F.col("share") >= FILE_SHARE) | F.col("path").rlike(FILE_NAME)) & F.col("path").isNotNull())
             .groupBy("dir").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "path", F.col("own_license").alias("given"))).alias("best"))
             .select(F.col("dir").alias("above"), "best.given"))
    steps = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/"))
    nearest = (own.where("own_license is null and path is not null").select("dir").distinct()
               .select("dir", F.explode(F.array_distinct(ancestors)).alias("above")).join(given, "above")
               .groupBy("dir").agg(F.max(F.struct(F.length("above").alias("n"), "above", "given")).alias("near")))
    lacks = F.col("own_license").isNull()
    return (own.join(nearest, "dir", "left")
            .select("doc_id", "path", "own_license", "cosine", F.coalesce("own_license", "near.given").alias("license"),
                    F.when(lacks, F.col("near.above")).alias("license_dir")))
