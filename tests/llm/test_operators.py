"""Small brute-force comparisons and odd inputs for every operator; rows of nulls, ties, repeats and clashing columns."""

import hashlib
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from pagequarry.llm import decontaminate, language_id, licenses, maxscore, minhash_dedup, mixing, pii, secrets, toxicity
from pagequarry.llm.tokens import words
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept int, root string, place int"


def table(spark, rows):
    """Documents from (doc_id, text, lang, source), with columns whose names operators use inside."""
    return spark.createDataFrame([(*r, len(r[1]) if r[1] else None, 1, "x", 2) for r in rows], DOCS)


def prose(seed, n=60, lang="en"):
    rng = np.random.default_rng(seed)
    parts = {"en": ["the", "and", "ing", "with", "th"], "fr": ["le", "que", "eau", "é", "ou"]}[lang]
    return " ".join("".join(rng.choice(parts, rng.integers(1, 5))) + str(rng.integers(50)) * 0 for _ in range(n))


ODD = [(None, prose(900), "en", None), (None, None, None, None), (70, "", None, "s1"), (71, " \t\n", "en", ""), (72, "one two", "en", "s1"),
       (73, "x" * 200_000, "en", "s2"), (74, "a b " * 30_000, "en", "s2"), (75, prose(901), None, "s1"), (75, prose(901), None, "s1")]


def near_rows():
    rows = []
    for g in range(6):
        base = [f"w{g}-{i}" for i in range(100)]
        for c in range(5):
            w = list(base)
            for k in range(c):
                w[(7 + 29 * k) % 100] = f"x{g}-{c}-{k}"
            rows.append((100 * g + c, " ".join(w).upper() if c == 1 else " ".join(w), "en", f"s{g % 3}"))
        rows.append((100 * g + 50, " ".join(base), "en", "s9"))
    return rows


def brute_components(rows):
    def of(t):
        w = [x.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")) for x in words(t)]
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [(d, of(t)) for d, t, *_ in rows]
    root = {d: d for d, _ in sets if d is not None}
    for _ in range(len(rows)):
        for a, sa in sets:
            for b, sb in sets:
                if a is not None and b is not None and sa and sb and 100 * len(sa & sb) >= 85 * len(sa | sb):
                    root[a] = root[b] = min(root[a], root[b])
    return sorted(((d, len(s), None if d is None else root[d], d is None or root[d] == d) for d, s in sets), key=repr)


@pytest.mark.parametrize("block", [512, 4])
def test_near_dedup_against_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK_DOCS", block)
    rows = near_rows() + [r for r in ODD if r[0] not in (73, 74)] + [(76, "ONE two", "en", "s1"), (77, "three", "en", None)]
    found = minhash_dedup.near_dedup(table(spark, rows)).collect()
    assert sorted((tuple(r)[:4] for r in found), key=repr) == brute_components(rows)
    assert minhash_dedup.drop_near_copies(table(spark, rows)).columns == table(spark, rows).columns


def test_pipeline_drops_near_copies_from_four_fifths_on(spark):
    base = [f"w{i}" for i in range(100)]
    near = [f"x{i}" if i in (30, 60) else w for i, w in enumerate(base)]  # 86 of 106 shingles
    far = [f"y{i}" if i in (20, 50, 80) else w for i, w in enumerate(base)]  # 81 of 111
    docs = table(spark, [(i, " ".join(w), "en", "s") for i, w in enumerate((base, near, far), 1)])
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()) == [1, 3]
    assert all(r.kept for r in minhash_dedup.near_dedup(docs).collect())


def test_pigeonhole_keys_meet_every_pair_within_the_distance():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**16, 32).astype(np.uint16)
    for _ in range(50):
        other = base.copy()
        other[rng.choice(32, 15, replace=False)] ^= np.uint16(1)
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([base.tobytes(), other.tobytes()])], ["id", "sig"])
        keys = [b.column(0).to_pylist() for b in minhash_dedup._keys(iter([batch]), 8)]
        assert any(a == b for a, b in keys)


def test_meeting_in_batches_and_chained(spark, monkeypatch):
    import pyarrow as pa

    sig = np.arange(32, dtype=np.uint16).tobytes()
    batches = [pa.RecordBatch.from_arrays([pa.array(k), pa.array(i), pa.array([sig] * len(k))], ["key", "id", "sig"])
               for k, i in (([1, 2, 2], [1, 2, 3]), ([2, 2], [4, 5]), ([2, 3], [6, 7]))]
    for held in (65_536, 2):
        monkeypatch.setattr(minhash_dedup, "HELD", held)
        pairs = {tuple(r.values()) for b in minhash_dedup._meet(iter(batches), 15) for r in b.to_pylist()}
        assert {p for p in pairs if p[0] != p[1]} == {(2, 3), (2, 4), (2, 5), (2, 6)}


def test_language(spark):
    rows = [(i, prose(i, 40, ("en", "fr")[i % 2]), ("en", "fr")[i % 2], "s") for i in range(60)] + ODD
    found = language_id.identify(table(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0) and 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id < 60:
            assert r.lang_pred == ("en", "fr")[r.doc_id % 2]
    assert {r.lang_pred for r in found if r.doc_id in (70, 71)} == {"und"}
    kept = language_id.keep_known_language(table(spark, rows))
    assert kept.columns == table(spark, rows).columns and kept.count() == len(rows) - 3
    empty = table(spark, rows).where("false")
    assert language_id.identify(empty).count() == 0
    assert {r.lang_pred for r in language_id.identify(table(spark, rows).withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_backoff_goes_to_shorter_grams():
    model = language_id.Model(["en", "fr"], [("en", "thing", 5), ("fr", "chose", 5)],
                              [("en", "^thi", 3), ("fr", "ose$", 3), ("fr", "o", 9), ("en", "t", 9)])
    assert model.predict("thing")[0] == "en" and model.predict("thick")[0] == "en" and model.predict("rose")[0] == "fr"
    assert model.predict("zoz")[0] == "fr" and model.predict("123") == ("und", 0.0) and model.predict("qqq")[1] == 0.5


def test_language_with_a_handful_of_documents_beside_big_ones(spark):
    def text(lang, i):  # many words, most of them once, made of letters of the language only
        rng = np.random.default_rng([lang, i])
        return " ".join("".join(rng.choice(list(("abcdef", "ghijkl", "mnopqr")[lang]), 10)) for _ in range((6000, 6000, 30)[lang]))

    rows = [(i, text(i % 2, i), ("aa", "bb")[i % 2], "s") for i in range(30)] + [(i, text(2, i), "zz", "s") for i in range(100, 106)]
    model = language_id.train(table(spark, rows))
    assert model.langs == ["aa", "bb", "zz"]
    learned = [t for i, t, lang, _ in rows if zlib.crc32(str(i).encode()) % 5 and lang]
    assert len(model.words.at) == len({w for t in learned for w in t.split()}) > 120_000
    assert {model.predict(text(2, i))[0] for i in (500, 501)} == {"zz"} and model.predict(text(0, 502))[0] == "aa"


def test_maxscore_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 16)]) for i in range(400)]
    rows += [(400 + i, rows[i % 7][1]) for i in range(60)]
    rows += [(None, rows[0][1]), (500, None), (501, []), (502, [1.0, None]), (503, [float("nan")]), (504, [float("inf")]), (550, [0.5, 0.25])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, score int, label int")
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in maxscore.top_k(df.repartition(3)).collect())
    q = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in rows
         if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for a in (i for i in q if i % 50 == 0):
        best = sorted((-sum(x * y for x, y in zip(q[a], q[b])), b) for b in q if b != a)[:5]
        want += [(a, n + 1, b, -s) for n, (s, b) in enumerate(best)]
    assert found == sorted(want)
    assert maxscore.top_k(df.where("false")).count() == 0


def test_toxicity_held_out(spark):
    bad = ["clodpate", "numskull", "mooncalf"]
    odd = [r for r in ODD if r[0] != 74]  # one text of 60,000 words would outweigh all of this corpus
    rows, labels = [], []
    for i in range(100, 1700):
        w = prose(i, 50).split()
        if i % 8 == 0:
            for at in (5, 20, 40):
                w[at] = bad[(i // 8 + at) % 3]
        rows.append((i, " ".join(w), "en", "s"))
        labels.append((i, int(i % 8 == 0), None))
    df = table(spark, rows + odd)
    y = spark.createDataFrame([*labels, (None, 1, None), (105, None, None), (9999, 1, None), (103, 7, None)], "doc_id long, toxic int, text string")
    found = toxicity.score_toxicity(df, y).collect()
    assert len(found) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    own = [r for r in found if r.doc_id is not None and r.doc_id >= 100 and r.held_out]
    assert np.mean([r.predicted == int(r.doc_id % 8 == 0) for r in own]) > 0.95
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2) for r in found)
    assert toxicity.score_toxicity(df, y.where("toxic = 0")).where("score > 0.3").isEmpty()
    assert toxicity.score_toxicity(df.where("false"), y.where("false")).count() == 0


def test_decontamination_with_substitutions(spark):
    item = [f"bench{i}" for i in range(30)]
    changed = [("swap" if i in (8, 19) else w) for i, w in enumerate(item)]
    rows = [(1, prose(1) + " " + " ".join(item) + ", " + prose(2), "en", "s"), (2, prose(3) + " " + " ".join(changed).upper(), "en", "s"),
            (3, " ".join(item[:10]) + " " + prose(4), "en", "s"), (4, prose(5) + " tiny six word item is here", "en", "s"), (5, prose(6), "en", "s"), *ODD]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "Tiny six word item is here."), (3, None), (None, prose(5)), (4, ""), (5, "a b")], "item_id long, text string")
    found = sorted((r.doc_id, r.item_id, r.equal_words) for r in decontaminate.contamination(table(spark, rows), bench).collect())
    assert found == [(1, 1, 30), (2, 1, 28), (4, 2, 6)]
    kept = decontaminate.drop_contaminated(table(spark, rows), bench)
    assert kept.count() == len(rows) - 3 and kept.columns == table(spark, rows).columns
    assert decontaminate.contamination(table(spark, rows), bench.where("false")).count() == 0


def plain_overlap(same, share):
    """Most equal words of any stretch with ``share`` tenths of them equal."""
    return max((sum(same[i:j]) for i in range(len(same)) for j in range(i + 1, len(same) + 1) if 10 * sum(same[i:j]) >= share * (j - i)), default=0)


def test_best_overlap_against_every_stretch():
    rng = np.random.default_rng(8)
    for n in [*range(1, 40)] * 3:
        item = np.arange(n).astype(np.uint64)
        same = rng.random(n) < rng.choice([0.2, 0.5, 0.8, 0.9])
        doc = np.r_[[990, 991], np.where(same, item, 999)].astype(np.uint64)
        start, end, equal = decontaminate.best_overlap(doc, item, 2)
        assert equal == plain_overlap(same.tolist(), 8) == same[max(start - 2, 0):max(end - 2, 0)].sum() and 10 * equal >= 8 * (end - start)


def test_masks_fit_every_overlap_by_the_rule():
    masks = [int(m, 2) for m in decontaminate.MASKS]
    span = max(map(len, decontaminate.MASKS))
    state = np.arange(1 << span)
    hit = np.any([(state & m) == m for m in masks], axis=0)
    least = np.where(state == 0, 0, 10_000)  # substitutions, by which of the last words are equal, if no mask has fitted
    for n in range(1, 200):
        before = np.minimum(least[:1 << span - 1], least[1 << span - 1:])
        least = np.where(hit, 10_000, np.stack([before + 1, before], axis=1).ravel())
        assert n - least.min() < 13 or 10 * (n - least.min()) < 8 * n, n


def test_decontamination_of_short_passages_at_the_threshold(spark):
    rng = np.random.default_rng(12)
    rows, items, want = [], [], set()
    for i in range(120):
        n, k = [(15, 2), (16, 3), (20, 3), (20, 4), (25, 5), (30, 6), (16, 4), (30, 20)][i % 8]
        words = [f"b{i}x{j}" for j in range(n)]
        gone = set(rng.choice(n, k, replace=False).tolist())
        items.append((i, " ".join(words)))
        rows.append((i, prose(i, 10) + " " + " ".join("swap" if j in gone else w for j, w in enumerate(words)) + " " + prose(900 + i, 10), "en", "s"))
        if (equal := plain_overlap([j not in gone for j in range(n)], 8)) >= 13:
            want.add((i, i, equal))
    assert len(want) > 80
    found = decontaminate.contamination(table(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.equal_words) for r in found} == want


def test_mixing(spark):
    rows = near_rows() + ODD
    found = mixing.mix_sources(table(spark, rows)).collect()
    size = sorted((len(words(t)) for _, t, *_ in rows))
    assert sorted(r["size"] for r in found) == size and all(0 <= r.taken <= 3 * r["size"] for r in found)
    by = {}
    for r in found:
        by.setdefault(r.source, [r.target, r.source_size, 0])[2] += r.taken
    assert all(int(t) == taken and t <= 3 * s for t, s, taken in by.values())
    assert sum(t for t, *_ in by.values()) == pytest.approx(sum(size))
    assert sorted(map(repr, found)) == sorted(map(repr, mixing.mix_sources(table(spark, rows).repartition(7)).collect()))
    assert mixing.mix_sources(table(spark, rows).where("false")).count() == 0


def test_sharing_excess_again_and_again(spark):
    sizes = {"a": 1000, "b": 10, "c": 20, "d": 5, "e": 300, None: 7}
    found = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    weight = dict(zip(sizes, [1, 2, 3, 1, 2, 3]))
    target, free, left = {}, set(sizes), sum(sizes.values())
    while True:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > 3 * sizes[s]}
        if not over:
            target |= {s: unit * weight[s] for s in free}
            break
        target |= {s: 3 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        free -= over
    assert found == pytest.approx(target)


SECRET = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_secrets(text):
    out = [(m.start(), 0, m.end(), "assign") for m in SECRET.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_secrets(spark):
    live, copied = "Zx9" + "kQ7wB2" * 6, "Ab3" + "Cd4Ef5" * 6
    texts = ["é😀 password = 'hunter22' and token=abc TOKEN: x token=token: abcdef", f"AKIA{'Q7' * 8} AKIAAKIA {'0a' * 20}", f"bare {live} end", None, "",
             *[f"say {copied} here" for _ in range(4)], "api_key=" + "9f" * 16, "token = aaaaaaaa", "apikey:secret=12345678;passwd==x1y2z3", "token=abcdefg " * 1500]
    rows = [(i, t, "en", f"s{i}" if i != 2 else None) for i, t in enumerate(texts)] + ODD + [(2, texts[2], "en", None)]
    found = secrets.secret_scan(table(spark, rows)).collect()
    assert len(found) == len(rows)
    byte = {}
    for d, t, *_ in rows:
        byte.setdefault(d, []).append(base_secrets(t or ""))
    for r in found:
        want = [",".join(f"{k}:{s}:{e}" for s, _, e, k in b) for b in byte[r.doc_id]]
        assert r.base_sha256 in [hashlib.sha256(w.encode()).hexdigest() for w in want]
        assert (r.n_assign, r.n_access, r.n_hex) in [tuple(sum(x[3] == k for x in b) for k in ("assign", "access", "hex")) for b in byte[r.doc_id]]
    by = {r.doc_id: r for r in found}
    assert by[2].spans == "mixed:5:44" and by[5].spans == "" and by[5].copied_spans == "mixed:4:43"
    assert [(by[i].most_owners, by[i].most_repositories) for i in (2, 4, 5)] == [(1, 1), (0, 0), (4, 4)]
    masked = {r.doc_id: r for r in secrets.mask_live(table(spark, rows)).collect()}
    assert masked[2].text == "bare [SECRET] end" and masked[2].n_chars == 17 and masked[5].text == texts[5] and masked[3].text is None


BASE_PII = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def base_pii(text):
    def fine(kind, s):
        digits = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and pii.luhn(digits)
        return kind == "email" or 8 <= len(digits) <= 15

    return [[(m.start(), m.end()) for m in re.finditer(p, text) if fine(k, m[0])] for k, p in BASE_PII]


def test_pii_against_plain_patterns(spark):
    rng = np.random.default_rng(4)
    pieces = ["@", "a@b.co", ".", "12", "1.2.3.4", "255.0.0.256", "4539 5787 6362 1486", "+1 (555) 010-9999", "-", " ", "x", "é😀", "+", "0", "a.b", "%", "4111111111111111", "(", "\n"]
    texts = ["".join(rng.choice(pieces, rng.integers(1, 40))) for _ in range(3000)]
    for t in texts:
        assert pii.find(t)[:4] == base_pii(t), t
    rows = [(i, t, "en", "s") for i, t in enumerate(texts[:20])] + ODD + [(90, "IBAN: DE89 3704 0044 0532 0130 00, ftp://me:pw12@host.example/x", "en", "s")]
    found = pii.personal_data(table(spark, rows)).collect()
    assert len(found) == len(rows)
    last = next(r for r in found if r.doc_id == 90)
    assert (last.n_iban, last.n_login) == (1, 1) and "iban:6:33" in last.spans
    assert pii.personal_data(table(spark, rows).where("false")).count() == 0


def test_licenses_inherit_from_the_nearest_directory(spark):
    rows = [(1, "Released under the MIT License.", "en", "a/LICENSE"), (2, prose(1), "en", "a/b/c/x"), (3, "Licensed under the Apache License, Version 2.0.", "en", "a/b/LICENSE"),
            (4, prose(2), "en", "a/y"), (5, prose(3) + "\nLicensed under CC BY-NC 4.0.\n" + prose(4), "en", "a/z"), (6, prose(5), "en", "other/z"), *ODD]
    found = {r.doc_id: r for r in licenses.license_scan(table(spark, rows), F.col("source")).collect()}
    assert [found[i].license for i in (1, 2, 3, 4, 5, 6)] == ["MIT", "Apache-2.0", "Apache-2.0", "MIT", "CC-BY-NC-4.0", None]
    assert found[2].license_dir == "a/b" and found[4].license_dir == "a" and found[5].license_dir is None
    assert licenses.license_scan(table(spark, rows).where("false"), F.col("source")).count() == 0


def test_licenses_inherit_from_whole_texts(spark):
    import textwrap

    text = {n: t.replace("<year> <copyright holders>", "2031 Someone Else") for n, t in licenses.TEXTS}
    assert {"MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "CC0-1.0"} == set(text)
    affero = text["GPL-3.0"].replace("GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE")
    rows = [(1, "Released under the MIT License.", "en", "LICENSE")]
    for i, (name, t) in enumerate([*text.items(), ("AGPL-3.0", affero)]):
        rows += [(10 + i, textwrap.fill(t, 60) if i % 2 else t, "en", f"{name}/{'terms' if i % 3 else 'LICENSE.txt'}"), (50 + i, prose(i), "en", f"{name}/src/x")]
    rows += [(90, prose(90, 400) + "\nLicensed under CC BY 4.0.\n" + prose(91, 400), "en", "named/COPYING.md"), (91, prose(92), "en", "named/x"),
             (92, prose(93, 400) + "\nLicensed under CC BY 4.0.\n" + prose(94, 400), "en", "other/license_list/notes"), (93, prose(95), "en", "other/license_list/x")]
    found = {r.doc_id: r for r in licenses.license_scan(table(spark, rows), F.col("source")).collect()}
    for i, name in enumerate([*text, "AGPL-3.0"]):
        assert (found[10 + i].own_license, found[50 + i].license, found[50 + i].license_dir) == (name, name, name)
    assert (found[91].license, found[92].license, found[93].license) == ("CC-BY-4.0", "CC-BY-4.0", "MIT")


def test_pipeline_stages_follow_the_operators(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, sf)
        assert out.columns == docs.columns
        kept = spark.createDataFrame(out.collect(), docs.schema)
    last = {(r.doc_id, r.taken) for r in corpus_pipeline.STAGES[-1][1](spark, kept, sf).collect()}
    assert last and last == {(r.doc_id, r.taken) for r in corpus_pipeline.run(spark, sf).collect()}


def test_toxicity_learns_from_every_labelled_row(spark):
    """Each row is in a block, and pairs are counted in all of them, each row as often as it is in a block."""
    rows = [(i, f"{'rotten egg ' * 40}{prose(i, 30)}" if i % 2 else prose(i, 100), "en", "s") for i in range(600)]
    df, y = table(spark, rows), spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, toxic int")
    placed, blocks = toxicity._in_blocks(toxicity._labelled(df, y).where("part in (0, 1)"), {0: 30000.0, 1: 30000.0}, 8000.0)
    placed = placed.cache()
    assert blocks == {0: 4, 1: 4} and {n for r in placed.collect() for n in r.blocks} == {0, 1, 2, 3}
    assert placed.count() == toxicity._labelled(df, y).where("part in (0, 1)").count()
    h, w = toxicity.word_hashes([b"rotten"]), toxicity.word_hashes([b"egg"])
    plain, toxic = toxicity._count_frequent(toxicity._texts(df, placed), h, w)
    assert plain.tolist() == [0] and toxic.tolist() == [40 * sum(len(r.blocks) for r in placed.collect() if r.label == 1)]


def test_toxicity_counts_pairs_over_all_blocks(spark):
    """A pair that no block has more often than its discount, but all of them together: its words are as frequent in both classes."""
    rows = [(i, f"{'rotten egg ' if i % 2 else 'egg then rotten '}{prose(i, 40)}", "en", "s") for i in range(1200)]
    df, y = table(spark, rows), spark.createDataFrame([(i, i % 2) for i in range(1200)], "doc_id long, toxic int")
    models = toxicity.train(df, y, block_words=1500)
    pair = toxicity.mix(toxicity.word_hashes([b"rotten"]) * toxicity._STEP + toxicity.word_hashes([b"egg"]))
    at = np.flatnonzero(models.pairs == pair[0])
    assert len(at) == 1 and models.seen[0, at[0]] > 0 == models.seen[1, at[0]]
    assert models.score("so the rotten egg") > models.score("so the egg then rotten")
