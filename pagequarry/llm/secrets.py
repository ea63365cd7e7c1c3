"""Secret scan with corpus-wide ownership frequency, in built-in functions only.

Candidate values are found in each text, reduced to hashes and counted by distinct repositories and owners. A value
that many owners have is a copied example; one that stays with an owner looks live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.operators.membership import split_members
from pagequarry.session import materialize

# Fixed values of the scan: kind, pattern, group that holds the value, shortest value.
KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),  # a shorter run fails and holds no longer one
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # as above
)
MIXED = ("mixed", r"[A-Za-z0-9+/_-]{32,}", 0, 32)  # with a digit, an upper and a lower case letter; only while live
COPIED_OWNERS = 3  # owners from which on a value is a copied example
PLAIN_CHARACTERS = 6  # a value of fewer distinct characters is a placeholder
MASK = "[SECRET]"
_SPAN = "struct<kind:string,place:int,s:int,e:int,v:string>"
_STEP = 512


def _spans(text: Column, kind: str, pattern: str, group: int, least: int, place: int) -> Column:
    """Matches of a pattern, leftmost and apart, with positions in code points.

    Positions are running sums over what lies between the matches, in steps, so that many matches in one text cost
    little more than their number.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    sizes = F.transform(parts, lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), x["value"].alias("value")))
    steps = F.transform(F.array(sizes), lambda z: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(z) - 1) / _STEP).cast("int")),
        lambda i: F.slice(z, i * _STEP + 1, F.lit(_STEP))))[0]

    def one(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        span = F.struct(F.lit(kind).alias("kind"), F.lit(place).alias("place"), start.alias("s"), (start + x["hit"]).alias("e"), x["value"].alias("v"))
        return F.struct((start + x["hit"]).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    none = F.array().cast(f"array<{_SPAN}>")

    def many(acc: Column, step: Column) -> Column:
        inner = F.aggregate(step, F.struct(acc["at"].alias("at"), none.alias("out")), one)
        return F.transform(F.array(inner), lambda x: F.struct(x["at"].alias("at"), F.concat(acc["out"], F.array(x["out"])).alias("out")))[0]

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{_SPAN}>>").alias("out"))
    found = F.flatten(F.aggregate(steps, start, many)["out"])
    return F.when(text.rlike(pattern), F.filter(found, lambda x: F.length(x["v"]) >= least)).otherwise(none)


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["place"].alias("place"), x["e"].alias("e"), x["kind"].alias("kind"))))
    return F.array_join(F.transform(order, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` with all candidate spans; texts do not go on."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.concat(*(_spans(text, *k, place=i) for i, k in enumerate(KINDS)))
    return (docs.select(F.col("doc_id"), F.xxhash64("text").alias("_text"), F.col(owner).alias("_owner"),
                        F.col(repository).cast("string").alias("_repository"), base.alias("_base"),
                        _spans(text, *MIXED, place=len(KINDS)).alias("_mixed"))
            .withColumn("_more", F.filter("_mixed", lambda m: m["v"].rlike("[0-9]") & m["v"].rlike("[A-Z]") & m["v"].rlike("[a-z]")))
            .drop("_mixed"))


def ownership(spans: DataFrame) -> DataFrame:
    """(_value, n_owners, n_repositories) of (_value, _owner, _repository): distinct owners, and repositories as owners have them.

    Each step is combined before its shuffle: a value that a third of the corpus has is a row a task and owner.
    """
    return (spans.select("_value", "_owner", "_repository").distinct()
            .groupBy("_value", "_owner").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("_value").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories")))


def owned_values(found: DataFrame, copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """(doc_id, _text, live, copied and the most owners and repositories of a value): spans of each document whose value
    stays with an owner, and of the copied ones."""
    spans = (found.where("size(_base) + size(_more) > 0")
             .select("doc_id", "_text", "_owner", "_repository", F.explode(F.concat("_base", "_more")).alias("span"))
             .withColumn("_value", F.sha2(F.col("span.v"), 256)))
    plain = F.size(F.array_distinct(F.split(F.col("span.v"), ""))) < PLAIN_CHARACTERS
    live = (F.col("n_owners") < copied_owners) & ~plain
    judged = spans.join(ownership(spans), "_value").withColumn("live", live)
    return (judged.groupBy("doc_id", "_text", "_repository")
            .agg(F.collect_set(F.when(F.col("live"), F.col("span"))).alias("_live"),
                 F.collect_set(F.when(F.col("n_owners") >= copied_owners, F.col("span"))).alias("_copied"),
                 F.max("n_owners").alias("_owners"), F.max("n_repositories").alias("_repositories")))


def secret_scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """Secrets in every row of ``docs`` (doc_id, text and the owner's and repository's columns).

    doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end in code points, end exclusive), live_spans,
    copied_spans, most_owners and most_repositories (of any of its values; 0 without one). Base kinds are always listed. A mixed-case token without an assignment is added while its value looks
    live: fewer than ``COPIED_OWNERS`` owners have it.

    Null and empty texts have no spans. A null owner is one owner, a null repository one repository. Rows that repeat
    a doc_id and a text each get the row's result. Other columns are ignored. An empty table gives no rows.
    """
    found = materialize(scan(docs, owner, repository), "secrets")  # texts are scanned once
    kinds = F.col("_base")
    count = lambda i: F.size(F.filter(kinds, lambda x: x["place"] == i)).cast("long")
    base = found.select("doc_id", "_text", "_repository", "_base", *(count(i).alias(f"n_{k[0]}") for i, k in enumerate(KINDS)),
                        F.sha2(_listed(kinds), 256).alias("base_sha256"))
    owned = owned_values(found)
    none = F.array().cast(f"array<{_SPAN}>")
    live, copied = F.coalesce("o._live", none), F.coalesce("o._copied", none)
    added = F.filter(live, lambda m: (m["place"] == len(KINDS)) & ~F.exists("_base", lambda b: (b["s"] <= m["s"]) & (m["e"] <= b["e"])))
    return (base.alias("b").join(owned.alias("o"), F.expr("b.doc_id <=> o.doc_id and b._text = o._text and b._repository <=> o._repository"), "left")
            .select("b.doc_id", "n_assign", "n_access", "n_hex", "base_sha256", _listed(F.concat("_base", added)).alias("spans"),
                    _listed(live).alias("live_spans"), _listed(copied).alias("copied_spans"),
                    F.coalesce("o._owners", F.lit(0)).alias("most_owners"), F.coalesce("o._repositories", F.lit(0)).alias("most_repositories")))


def mask_live(docs: DataFrame) -> DataFrame:
    """``docs`` (columns kept, whatever their names) with live-looking values' spans masked in the text; n_chars, if there, follows it.

    No text moves but those with a live value. Null and empty texts are left alone. Rows with a null doc_id, and rows that repeat one, are masked by their own
    text; equal rows alike. Overlapping spans are masked once. Long texts are scanned whole. An empty table gives no rows.
    """
    live = materialize(owned_values(materialize(scan(docs).where("size(_base) + size(_more) > 0"), "secrets")).where("size(_live) > 0")
                       .groupBy("doc_id", "_text").agg(F.array_distinct(F.flatten(F.collect_list("_live"))).alias("_live")), "live")
    key = [F.col("doc_id"), F.xxhash64("text")]
    hit, clean = split_members(docs, key, live.select("doc_id", "_text"))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")  # the row's own names stay out of the join
    joined = hit.select(row, key[0].alias("id"), key[1].alias("key")).join(
        live.select(F.col("doc_id").alias("of"), "_text", "_live"), F.expr("id <=> of and key = _text"))
    text = F.col("row")["text"]
    spans = F.array_sort(F.transform("_live", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))))

    def cut(acc: Column, x: Column) -> Column:
        fresh = x["s"] >= acc["at"]  # a span inside an earlier one is masked already
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.lit(MASK))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.when(fresh, piece).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), cut)
    masked = F.transform(F.array(done), lambda x: F.concat(x["out"], F.substring(text, x["at"] + 1, F.length(text))))[0]
    told = joined.select("row", masked.alias("masked"))
    types = dict(docs.dtypes)
    value = {"text": F.col("masked"), "n_chars": F.length("masked").cast(types.get("n_chars", "long"))}
    return told.select(*(value.get(c, F.col("row")[c]).alias(c) for c in docs.columns)).unionByName(clean)
