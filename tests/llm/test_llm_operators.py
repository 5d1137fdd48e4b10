"""The ten operators against brute force and on edge cases."""

import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import support
from pyspark.sql import functions as F

from gridflux.llm import catalog, common, decontam, jaccard, langid, media, packing, quality, suffix_lm, token_count, url_filter, warc
from gridflux.llm.components import components
from gridflux.llm.tokens import encoder, read_vocabulary

SF = "/root/testdata/sf0.001"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i % 977} thing{i % 13}" for i in range(60_000))
TEXTS = [
    None, "", "   \n\t ", "one", "Two words", "a b c d e", "The quick brown fox jumps over the lazy dog near the river bank today",
    "the quick brown fox jumps over the lazy dog near the river bank today", "the quick brown fox jumps over the lazy dog near the river bank now",
    LONG, LONG + " more", "ünïcode Ünicode ß ñ é 漢字 \u00a0 x", "nul \x00 byte", "<|endoftext|> is text",
]


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(UP)) if w]


@pytest.fixture(scope="module")
def edge(spark):
    """Edge texts, repeated rows, a null id, and extra columns with clashing names."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 == 0 else "src", 5, 1.5, i, "x") for i, t in enumerate(TEXTS)]
    rows += [rows[6], (None, TEXTS[6], "en", "src", 1, 0.0, 0, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, n int, bucket string").repartition(3)


@pytest.fixture(scope="module")
def empty(edge):
    return edge.where("false")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_words_and_hashes():
    texts = [t or "" for t in TEXTS] + ["x", "", "y z"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    bounds = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    found = common.find_words(data, bounds)
    names = {}
    for k, t in enumerate(texts):
        want = words(t)
        got = found.hash[found.first[k] : found.first[k + 1]]
        assert len(got) == len(want)
        for h, w in zip(got, want, strict=True):
            assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_oracle(spark, name):
    assert support.same(catalog.QUERIES[name](spark, SF).toPandas(), support.oracle(catalog.ORACLE_SQL[name], SF)) == ""


# 1 decontamination


def edit_distance_to_part(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
        row = new
        best = min(best, row[-1])
    return best


def test_fit_distance():
    rng = random.Random(4)
    for _ in range(200):
        a = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 15)))
        b = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 25)))
        assert decontam.fit_distance(a, b) == edit_distance_to_part(a, b)


def test_decontamination(spark, documents):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r.item_id: decontam.plain(r.text) for r in bench.collect()}
    rng = random.Random(2)
    planted, rows = {}, []
    for k, (item, text) in enumerate(sorted(items.items())):
        w = text.split()
        if len(w) < 14:
            continue
        for edits in (0, 1, len(w) // 12):
            v = list(w)
            for _ in range(edits):
                v[rng.randrange(len(v))] = "zq" + str(rng.randrange(99))
            doc = 10**6 + len(rows)
            planted[doc] = item
            noise = [f"n{rng.randrange(10**6)}" for _ in range(50)]
            cut = rng.randrange(50)
            rows.append((doc, " ".join(noise[:cut] + v + noise[cut:])))
    docs = documents.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    hits = decontam.search(docs, bench).collect()
    got = {(h.doc_id, h.item_id) for h in hits}
    assert len([d for d, i in planted.items() if (d, i) not in got]) <= 0.05 * len(planted)
    text = {r.doc_id: decontam.plain(r.text or "") for r in docs.collect()}
    exact = {(d, i) for d, t in text.items() for i, p in items.items() if len(p.split()) >= 4 and p in t}
    assert exact <= got
    assert all(decontam.fit_distance(items[h.item_id], text[h.doc_id]) <= h.edit_distance <= 0.2 * h.item_chars for h in hits)
    kept = {r.doc_id for r in decontam.drop_contaminated(docs, bench).collect()}
    assert kept == set(text) - {d for d, _ in got}


def test_decontamination_of_clustered_edits():
    """One run of edited words anywhere in an item: within a fifth of its characters, found."""
    rng = random.Random(6)
    lengths = [12, 20, 24, 40, 59, 59, 100, 100, 100, 160]
    items = [[f"w{rng.randrange(10**5, 10**6)}" for _ in range(n)] for n in lengths]
    index = decontam.Index(list(range(len(items))), [" ".join(x) for x in items])
    assert set(index.recall) == set(index.sizes) and min(index.recall.values()) >= 0.95
    texts, wanted = [], []
    for k, item in enumerate(items):
        run = len(item) * 16 // 100
        for at in range(0, len(item) - run + 1, max(1, len(item) // 25)):
            new = [f"z{rng.randrange(10**5, 10**6)}" for _ in range(run)]
            before = [f"n{rng.randrange(10**6)}" for _ in range(rng.randrange(40))]
            texts.append(" ".join([*before, *item[:at], *new, *item[at + run :], "end"]).encode())
            wanted.append(k)
    hits = index.hits(np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))))
    got = {(row, item) for row, item, *_ in hits}
    for k in range(len(items)):
        mine = [r for r, x in enumerate(wanted) if x == k]
        assert sum((r, k) in got for r in mine) >= 0.9 * len(mine), lengths[k]


def test_decontamination_of_items_of_few_words(spark):
    """Items that repeat one, two or four words: exact and with an edit, alone and inside text."""
    items = {1: "yes no yes no yes no yes no yes no", 2: " ".join("ab"[i % 2] for i in range(32)), 3: "x x x x x x x x", 4: "to be or not"}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    noise = " ".join(f"n{i}" for i in range(40))
    rows = [(i, text) for i, text in items.items()] + [(10 + i, f"{noise} {text} {noise}") for i, text in items.items()]
    rows += [(21, noise + " yes no yes no nope no yes no yes no " + noise), (23, noise + " x x x x y x x x " + noise)]
    rows += [(31, noise), (32, "yes no " + noise + " x x " + noise + " a b a b"), (33, "yes")]
    got = {(h.doc_id, h.item_id): h.edit_distance for h in decontam.search(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    exact = {(k + i, i) for i in items for k in (0, 10)}
    assert {k for k, d in got.items() if d == 0} == exact and set(got) - exact == {(21, 1), (23, 3)}


def test_decontamination_recall_of_short_items():
    """Each size class reports the recall that its walks reach, short ones too."""
    rng = random.Random(8)
    for n in (4, 5, 7, 9, 14):
        words_of = [[f"w{rng.randrange(10**6)}" for _ in range(n)] for _ in range(60)]
        index = decontam.Index(list(range(60)), [" ".join(x) for x in words_of])
        (recall,) = index.recall.values()
        assert recall >= (0.85 if n == 4 else 0.95)
        exact = [" ".join(["n1", "n2", "n3", *x, "n4"]).encode() for x in words_of]
        hits = index.hits(np.frombuffer(b"".join(exact), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in exact]))))
        assert {(r, i) for r, i, *_ in hits} >= {(i, i) for i in range(60)}


def plain_edits(text, kind, rng):
    """Written apart from the operator's own simulation."""
    w = text.split()
    if kind.startswith("typo"):
        for i in range(0, len(w), int(kind[-1])):
            at = rng.randrange(len(w[i]))
            w[i] = w[i][:at] + rng.choice("qxz") + w[i][at + 1 :]
    elif kind == "glued":
        w = [("" if j % 3 == 0 else " ").join(w[i : i + 2]) for j, i in enumerate(range(0, len(w), 2))]
    elif kind == "all glued":
        w = ["".join(w)]
    elif kind == "torn":
        w = [v[:2] + " " + v[2:] if i % 3 == 0 and len(v) > 3 else v for i, v in enumerate(w)]
    return " ".join(w)


@pytest.mark.parametrize("kind", ["typo2", "typo3", "glued", "all glued", "torn"])
def test_decontamination_of_edited_characters(kind, recwarn):
    """Copies of benchmark items, and of random ones of each size, after edits of characters."""
    rng = random.Random(kind)
    import pyarrow.parquet as pq

    real = pq.read_table("/root/testdata/sf0.01/benchmark.parquet").to_pydict()["text"]
    groups = [real] + [[" ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) for _ in range(40)] for n in (4, 7, 9, 16, 32, 60)]
    for group in groups:
        index = decontam.Index(list(range(len(group))), group)
        texts, wanted = [], []
        for k, item in enumerate(group):
            new = plain_edits(item, kind, rng)
            if decontam.fit_distance(decontam.plain(item), decontam.plain(new)) <= 0.2 * len(decontam.plain(item)):
                lead = " ".join(f"n{rng.randrange(10**5)}" for _ in range(rng.randrange(30)))
                texts.append(f"{lead} {new} the end".encode())
                wanted.append(k)
        hits = index.hits(np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))))
        got = {(row, item) for row, item, *_ in hits}
        assert len(wanted) >= 20 and sum((r, k) in got for r, k in enumerate(wanted)) >= 0.95 * len(wanted), (kind, len(group[0].split()))
    assert not [w for w in recwarn if "walks" in str(w.message)]


def test_decontamination_of_glued_items_of_few_words():
    index = decontam.Index([1, 2], ["yes no yes no yes no yes no yes no", " ".join("ab"[i % 2] for i in range(32))])
    for text, item in (("so yesno yesno yesno yesno yesno there", 0), ("so " + "ab" * 16 + " there", 1)):
        raw = text.encode()
        found = index.hits(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        accepted = decontam.fit_distance(index.plain[item], decontam.plain(text)) <= 0.2 * len(index.plain[item])
        assert (item in {i for _, i, *_ in found}) == accepted


def test_decontamination_equals_all_pairs(spark):
    """All documents against all items by edit distance, edited passages among them."""
    rng = random.Random(12)
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").limit(12)
    items = {r.item_id: decontam.plain(r.text) for r in bench.collect()}
    for k, text in enumerate(items.values()):
        v = text.split()
        v[rng.randrange(len(v))] = "zzz"
        docs.append((10**6 + k, "before " * 9 + " ".join(v) + " after" * 9))
    want = {(d, i) for d, t in docs for i, p in items.items() if len(p.split()) >= 4 and decontam.fit_distance(p, decontam.plain(t)) <= 0.2 * len(p)}
    got = {(h.doc_id, h.item_id) for h in decontam.search(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got <= want and len(got) >= 0.95 * len(want) and len(want) >= 12


def test_decontamination_edges(spark, edge, empty):
    bench = spark.createDataFrame([(1, TEXTS[6]), (2, None), (3, "one"), (1, TEXTS[6])], "item_id long, text string")
    hits = decontam.search(edge, bench).collect()
    assert {h.doc_id for h in hits} == {6, 7, 8, None} and min(h.edit_distance for h in hits) == 0
    assert decontam.search(empty, bench).count() == 0
    assert decontam.search(edge, bench.where("false")).count() == 0
    assert decontam.drop_contaminated(edge, bench).columns == edge.columns


# 2 token counts


def test_segment_trees():
    enc = encoder(read_vocabulary())
    rng = random.Random(5)
    parts = ["a", "b ", " c", "  ", "\n", "x y z ", "'s", "12", "é", "!? ", " ", "漢字", "。", "<|endoftext|>", "|>"]
    for k in range(150):
        some = parts if k % 3 else [p for p in parts if not re.search(r"\s", p)]  # nor white space in each third text
        text = "".join(rng.choice(some) for _ in range(rng.randrange(0, 900)))
        tree = token_count.build(text, enc)
        assert tree.total == len(enc.slow_ids(text))
        for _ in range(3):
            t = tree.text()
            a = rng.randrange(len(t) + 1)
            b = min(len(t), a + rng.randrange(0, 600))
            new = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 6)))
            token_count.apply_edit(tree, a, b, new, enc)
            assert tree.text() == t[:a] + new + t[b:] and tree.total == len(enc.ids(tree.text()))


def test_token_counts(spark, documents, edge, empty):
    enc = encoder(read_vocabulary())
    text = {r.doc_id: r.text for r in documents.collect()}
    for r in token_count.count_tokens(documents).collect():
        after = token_count.PERSONAL.sub("<REDACTED>", text[r.doc_id])
        assert r.n_tokens == len(enc.ids(text[r.doc_id])) and r.n_tokens_after == len(enc.ids(after)) == sum(r.tree_tokens)
    got = token_count.count_tokens(edge).collect()
    assert len(got) == edge.count() and {r.n_tokens for r in got if r.doc_id in (0, 1)} == {0}
    assert token_count.count_tokens(empty).count() == 0


# 3 packing


def check_packing(rows, texts):
    enc = encoder(read_vocabulary())
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id,), []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    for (doc,), text in texts.items():
        ids = np.append(enc.slow_ids(text or ""), 0).astype("<u4")
        own = sorted(by_doc[doc,], key=lambda r: r.piece)
        assert sum(r.length for r in own) == len(ids) and all(r.length == packing.CAPACITY for r in own[1:])
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in own)
    return len(by_seq)


def test_packing(spark, documents, edge, empty):
    rows = packing.pack_documents(documents).collect()
    n = check_packing(rows, {(r.doc_id,): r.text for r in documents.collect()})
    assert n <= 1.01 * math.ceil(sum(r.length for r in rows) / packing.CAPACITY) + 1
    once = edge.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    check_packing(packing.pack_documents(once).collect(), {(r.doc_id,): r.text for r in once.collect()})
    assert packing.pack_documents(edge).agg(F.countDistinct("sequence_id", "offset"), F.count("*")).first()[0] == packing.pack_documents(edge).count()
    assert packing.pack_documents(empty).count() == 0


def least_bins(sizes, cap):
    """Exact number of bins of a few pieces."""
    best = len(sizes)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + sizes[k] <= cap:
                bins[i] += sizes[k]
                go(k + 1, bins)
                bins[i] -= sizes[k]
        go(k + 1, [*bins, sizes[k]])

    go(0, [])
    return best


def unpacked(plan, cap):
    back = {}
    for f, k in plan:
        assert sum(f) <= cap and k > 0
        for n in f:
            back[n] = back.get(n, 0) + k
    return back


def test_bin_completion_is_exact_on_small_cases():
    rng = random.Random(3)
    for _ in range(200):
        sizes = sorted((rng.randrange(1, 31) for _ in range(rng.randrange(1, 11))), reverse=True)
        h = {n: sizes.count(n) for n in sizes}
        plan = packing.complete_bins(h, 30)
        assert unpacked(plan, 30) == h and sum(k for _, k in plan) == least_bins(sizes, 30)
        counts = np.bincount(sizes, minlength=31)
        assert packing.lower_bound(counts, 30) <= least_bins(sizes, 30)


def test_bin_completion_beats_best_fit():
    cases = [({684: 1500, 683: 3000, 682: 3000}, 2625), ({1025: 1000, 400: 500, 256: 3000, 255: 1000}, 1100)]
    for seed in range(6):  # full sequences cut at random: no waste is needed
        rng, h = random.Random(seed), {}
        for _ in range(400):
            marks = sorted({0, 2048, *(rng.randrange(1, 2048) for _ in range(rng.randrange(1, 6)))})
            for a, b in zip(marks[:-1], marks[1:], strict=True):
                h[b - a] = h.get(b - a, 0) + 1
        cases.append((h, 400))
    for h, want in cases:
        plan = packing.complete_bins(h)
        assert unpacked(plan, 2048) == h and sum(k for _, k in plan) <= want


def test_fillings_are_undominated():
    counts = np.bincount([5, 5, 4, 3, 3, 2, 9], minlength=12)
    got = packing.fillings(counts, 10, 10, 50)
    assert got[0] == (5, 5) and all(sum(f) <= 10 for f in got)
    assert not any(packing.dominates(a, b) for i, a in enumerate(got) for b in got[i + 1 :])
    assert packing.fillings(counts, 9, 9, 50) == [(9,)] and packing.fillings(counts, 1, 9, 50) == [()]


def test_tokens_equal_the_tokenizers_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(read_vocabulary())
    enc = encoder(read_vocabulary())
    for t in [*(t or "" for t in TEXTS if t is not LONG), "don't  stop\n\n\n 12345 ½ \u200b", "a" * 3000, " " * 700, "x<|endoftext|><|endoftext|> y"]:
        assert enc.ids(t).tolist() == library.encode(t, add_special_tokens=False).ids


# 4 quality


def test_quality(spark, documents, edge, empty):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = {r.doc_id for r in quality.keep_good(big, labels).select("doc_id").collect()}
    good = {r.doc_id for r in labels.where("quality = 1 AND toxic = 0").collect()}
    poor = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert len(good & kept) >= 0.97 * len(good) and len(poor & kept) <= 0.05 * len(poor)
    assert quality.keep_good(big, labels).columns == big.columns
    some = spark.createDataFrame([(6, 1, 0), (6, 0, 0), (8, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    kept = [r.doc_id for r in quality.keep_good(edge, some).collect()]
    assert sorted(x for x in kept if x is not None) == sorted([3, 4, 5, 6, 6, 7, 8, 9, 10, 11, 12, 13]) and kept.count(None) == 1
    assert quality.keep_good(empty, some).count() == 0


def test_sparse_sites_shrink(spark):
    """A path with one bad document stays nearer to its host than one with many."""
    rows = [(i, "h", "big", -3.0) for i in range(200)] + [(1000, "h", "small", -3.0)] + [(2000 + i, "h", "fine", 3.0) for i in range(600)]
    scored = spark.createDataFrame(rows, "doc_id long, source string, lang string, evidence double")
    labels = spark.createDataFrame([(0, 0, 0), (2000, 1, 0)], "doc_id long, quality int, toxic int")
    means = {r.lang: r.path_mean for r in quality.site_posteriors(scored, labels).collect()}
    assert means["big"] < means["small"] < means["fine"]


def test_quality_equals_its_definition(spark):
    """Posteriors and verdicts recomputed with numpy from the evidence alone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.op4_quality(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == docs.count()
    mark = {r.doc_id: int(r.quality == 1 and r.toxic == 0) for r in labels.collect()}
    share = min(0.99, max(0.01, np.mean(list(mark.values()))))
    value = {r.doc_id: mark.get(r.doc_id, 1 / (1 + math.exp(-max(-30, min(30, r.evidence + math.log(share / (1 - share))))))) for r in rows}
    paths = {}
    for r in rows:
        paths.setdefault((r.source, r.lang), []).append(value[r.doc_id])
    hosts = {}
    for (source, _), v in paths.items():
        hosts.setdefault(source, []).extend(v)

    def weight(spread, mean, n, groups):
        return max(1.0, min(1e4, mean * (1 - mean) / max(spread - mean * (1 - mean) * groups / n, 1e-4) - 1))

    n = len(rows)
    mean = (sum(value.values()) + 1) / (n + 2)
    s = weight(np.mean([(np.mean(v) - mean) ** 2 for v in hosts.values()]), mean, n, len(hosts))
    of_host = {h: (sum(v) + s * mean) / (len(v) + s) for h, v in hosts.items()}
    s = weight(np.mean([(np.mean(v) - of_host[h]) ** 2 for (h, _), v in paths.items()]), np.mean([of_host[h] for h, _ in paths]), n, len(paths))
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        v = paths[r.source, r.lang]
        site = max(0.01, min(0.99, (sum(v) + s * of_host[r.source]) / (len(v) + s)))
        total = max(-30, min(30, r.evidence + math.log(site / (1 - site))))
        p = 1 / (1 + math.exp(-total)) if words(text[r.doc_id]) else 0.0
        assert math.isclose(r.site_mean, site, rel_tol=1e-6) and math.isclose(r.quality_score, p, rel_tol=1e-6, abs_tol=1e-9)
        assert r.accepted == (p >= 0.5)


def test_quality_of_repeated_label_ids(spark):
    """One labelled id with many rows and texts is one example."""
    rows = [(1, f"some words of text {i}", "s", "en") for i in range(300)] + [(i, "other words here", "s", "en") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 40)] + [(1, 1, 0)] * 5, "doc_id long, quality int, toxic int")
    assert quality.keep_good(docs, labels).count() <= docs.count()
    assert quality.fit_evidence(docs, labels, sample=10**6) is not None


def test_quality_evidence_is_of_all_labelled_documents(spark):
    """Word counts and the regression over 9,500 labelled documents, held against numpy."""
    rng = random.Random(4)
    rows, marks = [], []
    for i in range(9500):
        good = rng.random() < 0.7
        picked = [rng.choice(["river", "stone", "meadow", "winter"] if rng.random() < (0.6 if good else 0.4) else ["casino", "bonus", "click", "prize"]) for _ in range(8)]
        rows.append((i, " ".join(picked + [f"w{rng.randrange(3000)}"]), "s", "en"))
        marks.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    model = quality.fit_evidence(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    raw = [r[1].encode() for r in rows]
    x = quality.features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), model.vocabulary)
    y = np.array([m[1] for m in marks], float)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    mean = weight @ x
    scale = np.sqrt(weight @ (x - mean) ** 2)
    live = scale > 1e-9
    z = np.column_stack(((x - mean)[:, live] / scale[live], np.ones(len(y))))
    w = np.append(model.weights[live] * scale[live], model.bias + model.weights @ mean)
    # At the minimum over all rows the gradient is 0; a sample's minimum leaves some.
    slope = z.T @ (weight * (1 / (1 + np.exp(-z @ w)) - y)) + 1e-3 * np.append(w[:-1], 0)
    assert len(model.vocabulary) >= 8 and np.abs(slope).max() < 1e-4
    counts = {}
    for text, good in zip(raw, y, strict=True):
        for word in set(text.split()):
            counts.setdefault(word, np.zeros(2))[int(good)] += 1
    n0, n1 = len(y) - y.sum(), y.sum()
    want = set()
    for word, (b, a) in counts.items():
        p1, p0 = (a + 0.5) / (n1 + 1), (b + 0.5) / (n0 + 1)
        if a + b >= 5 and abs(p1 - p0) / math.sqrt(p1 * (1 - p1) / n1 + p0 * (1 - p0) / n0) > 3:
            want |= set(common.find_words(np.frombuffer(word, np.uint8), np.array([0, len(word)])).hash.tolist())
    assert want <= set(model.vocabulary.tolist())


# 5 language ID


def test_presence_kernel():
    texts = [b"abcd", b"ABce", b"", b"zz"]
    data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    p = langid.presence(data, bounds).astype(int)
    grams = [{t.lower()[i : i + n] for n in langid.NGRAMS for i in range(len(t) - n + 1)} for t in texts]
    assert [row.sum() for row in p] == [len(g) for g in grams]
    assert (p @ p.T).tolist() == [[len(a & b) for b in grams] for a in grams]


def test_langid(spark, edge, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.op5_langid(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held) and all(0 <= r.score <= 1 for r in got)
    scored = {r.doc_id: r for r in langid.predict(edge, langid.learn(edge)).collect()}
    assert [scored[i].lang_pred for i in (0, 1, 2, 3)] == ["und", "und", "und", "en"] and len(scored) == len(TEXTS) + 1
    assert {r.lang_pred for r in langid.predict(edge, langid.learn(empty)).collect()} == {"und"}
    kept = langid.keep_known(edge)
    assert langid.keep_known(empty).count() == 0 and kept.columns == edge.columns
    assert {r.score for r in kept.collect()} == {0.0, 1.5}  # the table's own column


def test_langid_is_kernel_ridge():
    """With each learning text a landmark the map is exact: scores of kernel ridge
    regression in its dual form on n-gram sets."""
    rng = random.Random(9)
    syllables = {"aa": ["ba", "co", "di"], "bb": ["ze", "xu", "di"], "cc": ["mo", "li", "ba"]}
    texts = [(lang, " ".join(rng.choice(s) + rng.choice(s) for _ in range(12))) for lang, s in syllables.items() for _ in range(15)]
    new = ["baco dico", "zexu", "moli bali mo", "qqqq", "Baba XUZE"]

    def cells(some):
        return langid.presence(np.frombuffer("".join(some).encode(), np.uint8), np.cumsum([0, *(len(t.encode()) for t in some)])).astype(float)

    def kernel(a, b):
        x, y = cells(a), cells(b)
        return x @ y.T / np.sqrt(np.outer(x.sum(axis=1), y.sum(axis=1)))

    own = [t for _, t in texts]
    langs = sorted(syllables)
    y = np.array([[lang == k for k in langs] for lang, _ in texts], float)
    n = len(own)
    centre = np.eye(n) - 1 / n
    k = kernel(own, own)
    dual = np.linalg.solve(centre @ k @ centre + 1e-3 * n * np.eye(n), y - y.mean(axis=0))
    want = (kernel(new, own) - k.mean(axis=0)) @ centre @ dual + y.mean(axis=0)
    model = langid.fit(cells(own), [lang for lang, _ in texts], landmarks_per_lang=99, ridge=1e-3)
    assert model.langs == langs and np.allclose(model.score(cells(new)), want, atol=2e-3)


def test_langid_letters_and_unknown_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(3)
    junk = ["²", "½ ①", "_ 12 _", "漢字" * 200, *("".join(rng.choice("bcdfgjkqvwxzBCDFGQXZ0123456789+/") for _ in range(600)) for _ in range(20))]
    junk += [" ".join("".join(rng.choice("qzxwkvj") for _ in range(rng.randrange(2, 9))) for _ in range(90)) for _ in range(20)]
    more = spark.createDataFrame([(10**7 + i, t, None) for i, t in enumerate(junk)], docs.schema)
    scored = {r.doc_id: r.lang_pred for r in langid.predict(more, langid.learn(docs)).collect()}
    assert [scored[10**7 + i] for i in range(3)] == ["und"] * 3 and scored[10**7 + 3] != "und"
    kept = {r.doc_id for r in langid.keep_known(docs.union(more)).collect()}
    assert len([d for d in kept if d >= 10**7]) <= 0.1 * len(junk) and len(kept) >= 0.97 * docs.count()
    rows = docs.limit(1).select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit("en").alias("lang"))
    assert langid.learning_rows(rows.crossJoin(spark.range(500).select()), 10**6).count() <= 1  # repeats are one row


UNKNOWN = {
    "turkish": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler. ",
    "greek": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. Είναι προικισμένοι με λογική και συνείδηση. ",
}


@pytest.mark.parametrize("size", [40, 160, 1600])
def test_language_stage_rejects_unknown_languages_of_any_length(spark, size):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(size)
    junk = [(text * 20)[i * 7 : i * 7 + size] for text in UNKNOWN.values() for i in range(10)]
    junk += [base64.b64encode(rng.randbytes(size)).decode()[:size] for _ in range(10)]
    junk += [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(size))[:size] for _ in range(10)]
    known = [(r.doc_id, r.text[len(r.text) // 3 :][:size]) for r in docs.where(F.length("text") > 3000).orderBy("doc_id").limit(60).collect()]
    more = [(10**7 + i, t, None) for i, t in enumerate(junk)] + [(10**8 + d, t, None) for d, t in known]
    kept = {r.doc_id for r in langid.keep_known(docs.union(spark.createDataFrame(more, docs.schema))).collect()}
    assert len([d for d in kept if 10**7 <= d < 10**8]) <= 0.05 * len(junk)
    assert len([d for d in kept if d >= 10**8]) >= 0.95 * len(known)
    assert len([d for d in kept if d < 10**7]) >= 0.98 * docs.where("text IS NOT NULL").count()


def test_language_counts_and_thresholds_are_of_all_learning_rows(spark):
    """Usual n-grams and thresholds recounted over every learning row, of which there are
    many times more than landmarks; what is usual for a passage, other texts say."""
    rng = random.Random(12)
    syllables = {"aa": ["ba", "co", "di", "fu", "le", "my"], "bb": ["ze", "xu", "di", "po", "le", "qa"]}
    rows = []
    for i in range(9000):
        lang = rng.choice(["aa", "aa", "bb"])
        rare = [f"{rng.choice('bcdfghjkl')}{rng.choice('aeiou')}{rng.choice('mnpqrstvwz')}" for _ in range(rng.randrange(3))]
        rows.append((i, " ".join(rng.choice(syllables[lang]) + rng.choice(syllables[lang]) for _ in range(rng.randrange(4, 30))) + " " + " ".join(rare), lang))
    docs = spark.createDataFrame(rows + rows[:500], "doc_id long, text string, lang string").repartition(5)
    own = [(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1]

    def cells(some):
        return langid.presence(np.frombuffer("".join(some).encode(), np.uint8), np.cumsum([0, *(len(t.encode()) for t in some)]))

    learned = langid.stage(langid.learning_rows(docs), "test-language")
    assert learned.count() == len(own)
    model = langid.learn(docs)
    held, texts = np.zeros((2, langid.WIDTH), int), np.zeros(2, int)
    for k, lang in enumerate(model.langs):
        mine = [t for t, x in own if x == lang]
        texts[k], held[k] = len(mine), sum(cells(mine[i : i + 500]).sum(axis=0) for i in range(0, len(mine), 500))
    assert (model.usual.T == (held >= langid.COMMON * texts[:, None])).all()
    again = langid.learn_rows(learned.repartition(3))  # sums don't depend on the table's parts
    assert (again.weights == model.weights).all() and (again.bias == model.bias).all() and (again.usual == model.usual).all()

    start = {r.text: r.h for r in learned.select("text", F.xxhash64("text").alias("h")).collect()}
    least = langid.least_known(learned, model)
    assert set(least) == {5, 6, 7}
    for size, got in least.items():
        known, n = [], 1 << size
        for t, lang in own:
            if len(t) >= n:
                at = start[t] % (len(t) - n + 1)
                c = cells([t[at : at + n]])
                best = int(model.score(c).argmax())
                less = int(model.langs[best] == lang)
                known.append(math.floor(langid.STEPS * ((held[best] - less >= langid.COMMON * (texts[best] - less)) & (held[best] > less))[c[0]].mean() + 1e-9))
        assert len(known) > 1000 and math.isclose(got, 0.88 * np.quantile(known, 0.01) / langid.STEPS, abs_tol=2e-4)


# 6 media


def test_jpeg_round_trip():
    rng = np.random.default_rng(1)
    for text in [b"", b"a", b"x" * 64, b"ab\0\0c" + bytes(200), rng.bytes(5000), bytes(1000), b"\xff" * 640, b"q" * 64 * 65, rng.bytes(64 * 300)]:
        payload = media.pad_payload(text)
        image = media.decode_jpeg(media.encode_jpeg(payload))
        assert media.read_payload(image) == payload
        assert media.thumbnail(image).shape == (image.height // 8, image.width // 8)
    with pytest.raises(ValueError):
        media.decode_jpeg(b"no image")


def slow_decode(data):
    """Coefficients of a one-component baseline JPEG, bit by bit."""
    at, tables, interval = 2, {}, 0
    while True:
        marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xC0:
            height, width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
        elif marker == 0xC4:
            code, k, book = 0, 17, {}
            for length in range(1, 17):
                for _ in range(body[length]):
                    book[length, code] = body[k]
                    code, k = code + 1, k + 1
                code *= 2
            tables[body[0]] = book
        elif marker == 0xDD:
            interval = int.from_bytes(body, "big")
        elif marker == 0xDA:
            break
    segments, part = [], bytearray()
    while data[at : at + 2] != b"\xff\xd9":
        if data[at] == 255 and 0xD0 <= data[at + 1] <= 0xD7:
            segments.append(bytes(part))
            part = bytearray()
            at += 2
        elif data[at] == 255:
            assert data[at + 1] == 0
            part.append(255)
            at += 2
        else:
            part.append(data[at])
            at += 1
    segments.append(bytes(part))
    total = -(-width // 8) * -(-height // 8)
    out = []
    for s, segment in enumerate(segments):
        bits = "".join(f"{b:08b}" for b in segment)
        pos = previous = 0

        def symbol(book):
            nonlocal pos
            for n in range(1, 17):
                if (n, int(bits[pos : pos + n], 2)) in book:
                    pos += n
                    return book[n, int(bits[pos - n : pos], 2)]

        def number(n):
            nonlocal pos
            v = int(bits[pos : pos + n], 2) if n else 0
            pos += n
            return v if not n or v >> (n - 1) else v - (1 << n) + 1

        for _ in range(min(interval or total, total - s * interval)):
            block = [0] * 64
            previous += number(symbol(tables[0]))
            block[0], k = previous, 1
            while k < 64:
                rs = symbol(tables[16])
                if rs == 0:
                    break
                k += rs >> 4
                if rs & 15:
                    block[k] = number(rs & 15)
                k += 1
            out += block
    return out


def test_jpeg_by_another_decoder():
    rng = np.random.default_rng(2)
    for text in [b"", b"plain words of a text " * 9, b"\xff" * 130, b"a" + bytes(300) + b"z", rng.bytes(700)]:
        payload = media.pad_payload(text)
        stored = media.encode_jpeg(payload)
        assert bytes(slow_decode(stored)[: len(payload)]) == payload
        assert slow_decode(stored) == media.decode_jpeg(stored).blocks.reshape(-1).tolist()
        pixels = media.thumbnail(media.decode_jpeg(stored)).reshape(-1)
        assert pixels.tolist() == [max(0, min(255, v // 8 + 128)) for v in slow_decode(stored)[::64]]


def test_media(spark, edge, empty):
    rows = media.media_features(media.store_media(edge), ["doc_id", "n_bytes"]).collect()
    assert len(rows) == edge.count()
    for r in rows:
        text = (TEXTS[r.doc_id] if r.doc_id is not None else TEXTS[6]) or ""
        payload = media.pad_payload(text.encode())
        stored = media.encode_jpeg(payload)
        assert (r.n_bytes, r.payload_bytes, r.media_bytes) == (len(text.encode()), len(payload), len(stored))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.media_sha256 == hashlib.sha256(stored).hexdigest()
        assert r.tail_crc32 == zlib.crc32(payload[-64:]) and r.feature
    assert media.store_media(empty).count() == 0


# 7 suffix tree


def brute_base(texts, held):
    counts = {}
    for k, t in texts.items():
        if not held[k]:
            for w in [*words(t), None]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    out = {}
    for k, t in texts.items():
        c = [counts.get(w, 0) for w in [*words(t), None]]
        out[k] = (len(c), sum(x > 0 for x in c), n, sum(math.log10((x + 1) / (n + v + 1)) for x in c))
    return out


def brute_tree(texts, held, least_divergence=suffix_lm.LEAST_DIVERGENCE):
    """Scores by the definition, over dictionaries of the whole corpus; the byte model
    sees the distinct words of one block."""
    rows = {k: [*words(t), None] for k, t in texts.items()}
    learn = [r for k, r in rows.items() if not held[k]]
    c1, c2, c3, nexts = {}, {}, {}, {}
    for r in learn:
        for i, w in enumerate(r):
            c1[w] = c1.get(w, 0) + 1
            if i:
                c2[r[i - 1], w] = c2.get((r[i - 1], w), 0) + 1
            if i > 1:
                c3[r[i - 2], r[i - 1], w] = c3.get((r[i - 2], r[i - 1], w), 0) + 1
                nexts.setdefault((r[i - 2], r[i - 1]), set()).add(w)
    n = sum(c1.values())
    unseen = min(0.5, (sum(c == 1 for c in c1.values()) + 1) / (n + 2))
    b2, b1, two, one, zero = {}, {}, {}, {}, {}
    grams = lambda w: [((*[256] * 2, *w.encode(), 256)[i : i + 3]) for i in range(len(w.encode()) + 1)]
    for w in c1:
        for x, y, z in grams(w) if w is not None else ():
            for table, key in ((b2, (x, y, z)), (two, (x, y)), (b1, (y, z)), (one, y), (zero, z)):
                table[key] = table.get(key, 0) + 1
    total = sum(zero.values())
    frequent = {k for k, v in two.items() if v >= 1e-5 * total}
    mu = suffix_lm.MU_BYTE

    def spell(w):
        out = 0.0
        for x, y, z in grams(w):
            p = (zero.get(z, 0) + 1) / (total + 257)
            p = (b1.get((y, z), 0) + mu * p) / (one.get(y, 0) + mu)
            good = (x, y) in frequent
            out += math.log10(((b2.get((x, y, z), 0) if good else 0) + mu * p) / ((two[x, y] if good else 0) + mu))
        return out

    def root(w):
        return math.log10(1 - unseen) + math.log10(c1[w] / n) if w in c1 else math.log10(unseen) + spell(w)

    def short(v, w):
        if c1.get(v, 0) < suffix_lm.LEAST:
            return root(w)
        return math.log10((c2.get((v, w), 0) + suffix_lm.MU_ONE * 10 ** root(w)) / (c1[v] + suffix_lm.MU_ONE))

    mu2, kept = suffix_lm.MU_TWO, set()
    for (u, v), ws in nexts.items():
        m = c2[u, v]
        if m >= suffix_lm.LEAST:
            gain = sum(c3[u, v, w] * math.log((c3[u, v, w] - 1 + mu2 * 10 ** short(v, w)) / ((m - 1 + mu2) * 10 ** short(v, w))) for w in ws)
            if gain >= least_divergence * m:
                kept.add((u, v))
    out = {}
    for k, r in rows.items():
        score, states = 0.0, 0
        for i, w in enumerate(r):
            lower = short(r[i - 1], w) if i else root(w)
            if i > 1 and (r[i - 2], r[i - 1]) in kept:
                m, states = c2[r[i - 2], r[i - 1]], states + 1
                lower = math.log10((c3.get((r[i - 2], r[i - 1], w), 0) + mu2 * 10**lower) / (m + mu2))
            score += lower
        out[k] = (score, states)
    return out, kept


def test_suffix_lm(spark, documents, edge, empty):
    rows = suffix_lm.score_texts(documents.coalesce(1)).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in texts}
    want = brute_base(texts, held)
    tree, kept = brute_tree(texts, held)
    assert kept
    off = 0
    for r in rows:
        assert r.held_out == held[r.doc_id] and (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert math.isclose(r.base_score, want[r.doc_id][3], rel_tol=1e-9)
        score, states = tree[r.doc_id]
        off += r.n_long != states  # a context at the threshold, by the steps of the probabilities
        assert math.isclose(r.score, score, abs_tol=1e-6 + 5e-4 * r.n_long + 0.3 * (r.n_long != states))
    assert off <= 0.02 * len(rows) + 1 and sum(r.n_long for r in rows) > 100
    got = suffix_lm.score_texts(edge).collect()
    assert len(got) == edge.count() and {r.n_tokens for r in got if r.doc_id in (0, 1, 2)} == {1}
    assert all(math.isfinite(r.score) for r in got)
    assert suffix_lm.score_texts(empty).count() == 0
    none = suffix_lm.score_texts(spark.createDataFrame([(i, "some words") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")).collect()
    assert none and all(r.held_out and r.n_known == 0 and r.score < -5 for r in none)


def test_suffix_lm_beats_words_alone(spark):
    """On held-out documents of a larger corpus, though it spells each unseen word."""
    out = suffix_lm.op7_suffix_lm(spark, "/root/testdata/sf0.1").where("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert out.score > out.base


def test_suffix_lm_of_hot_contexts_and_blocks(spark, documents, monkeypatch):
    """Hot contexts dealt by their next words, and other blocks, change nothing (but the
    byte model, which sees the distinct words of blocks)."""
    plain = {r.doc_id: r for r in suffix_lm.score_texts(documents.coalesce(1), least_divergence=-1e9).collect()}
    for docs, hot in ((documents.coalesce(1), 5), (documents.repartition(5), suffix_lm.HOT)):
        got = [r for r in suffix_lm.score_texts(docs, least_divergence=-1e9, hot=hot).collect() if hot == 5 or r.n_known == r.n_tokens]
        assert got and all(math.isclose(r.score, plain[r.doc_id].score, abs_tol=1e-6 + 5e-4 * r.n_long) and r.n_long == plain[r.doc_id].n_long for r in got)


def test_suffix_lm_is_a_function_of_the_table(spark, documents):
    """Whatever the blocks, and whether contexts are dealt by their next words, every text,
    those with unseen words too, has the same score in the same states."""
    want = {r.doc_id: r for r in suffix_lm.score_texts(documents.coalesce(1)).collect()}
    assert any(r.n_known < r.n_tokens for r in want.values()) and any(r.n_long for r in want.values())
    for docs, hot in ((documents.repartition(9), suffix_lm.HOT), (documents.repartition(3), 8), (documents.coalesce(1), 4)):
        got = suffix_lm.score_texts(docs, hot=hot).collect()
        assert len(got) == len(want)
        for r in got:
            assert r.n_long == want[r.doc_id].n_long and math.isclose(r.score, want[r.doc_id].score, rel_tol=1e-9, abs_tol=1e-6), (r, want[r.doc_id])


def test_spelling_is_a_distribution():
    """Probabilities of the next byte sum to 1 in each context; blobs come back."""
    data = np.frombuffer(b"ab abc b", np.uint8)
    codes, first = suffix_lm.spelled(data, np.array([0, 3, 7]), np.array([2, 6, 8]))
    assert first.tolist() == [0, 3, 7, 9] and codes[0] == (256 * 257 + 256) * 257 + 97 and codes[2] == (97 * 257 + 98) * 257 + 256
    one = np.full((257, 257), 1 / 257)
    model = suffix_lm.Spelling(np.array([1000, 1001]), np.array([3, 2]), np.array([1000 // 257]), np.array([5]), one)
    for context in (3, 7, 40):
        assert math.isclose(np.exp(model.log(context * 257 + np.arange(257))).sum(), 1)
    arrays = [np.array([1, 2**40], np.uint64), np.zeros(0, np.uint32), np.array([-5], np.int16), np.array([0.5, -1.25])]
    assert all(np.array_equal(a, b) and a.dtype == b.dtype for a, b in zip(arrays, suffix_lm.unpack(suffix_lm.pack(*arrays)), strict=True))


def test_url_and_warc_columns_that_clash(spark):
    """Columns named as working ones are no obstacle, and are kept where rows are."""
    pages = spark.createDataFrame([(1, "http://a.example.com/en/x", "<p>", "mine", 7, "h"), (2, None, None, None, 8, None)], "page_id long, url string, html string, rule_verdict string, keep int, host string")
    pages = pages.withColumns({c: F.lit(c) for c in ("digest", "short", "expression", "rule_digest", "copies", "word", "bit", "bits", "sha1", "a.b")})
    judged = url_filter.filter_urls(pages, url_filter.rules_frame(spark))
    got = {r.page_id: r for r in judged.collect()}
    assert judged.columns == [c for c in pages.columns if c != "host"] + ["host", "path", "rule", "verdict"]
    assert (got[1].rule_verdict, got[1].verdict, got[1].host, got[1].digest) == ("mine", "block", "a.example.com", "digest") and got[2].verdict == "allow"
    marked = warc.mark_revisits(pages)
    assert marked.columns == ["page_id", "url", "payload", "sha1", "record_type", "refers_to"] and marked.count() == 2


def test_packing_says_when_fillings_were_left_out():
    counts = np.zeros(2049, np.int64)
    counts[list(range(300, 420))] = 3
    few, more = packing.some_fillings(counts, 1500, 600, 3)
    assert len(few) == 3 and more
    counts[:] = 0
    counts[[700, 500]] = 1
    assert packing.some_fillings(counts, 1300, 2048, 12) == ([(700, 500)], False)


# 8 Jaccard join


def brute_components(texts):
    sets = {}
    for k, t in texts.items():
        w = words(t)
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    top = {k: k for k in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in sets}


def test_jaccard(spark, documents, edge, empty):
    rng = random.Random(7)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    more = []
    for k in range(25):  # near copies around the threshold
        v = list(base)
        for _ in range(rng.randrange(0, 6)):
            v[rng.randrange(len(v))] = f"e{rng.randrange(10**6)}"
        more.append((10**6 + k, " ".join(v)))
    docs = documents.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_similar(docs).collect()} == brute_components(texts)
    ids = {i: t for i, t in enumerate(TEXTS)}
    got = jaccard.join_similar(edge).collect()
    assert len(got) == edge.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == brute_components(ids)
    assert next(r.component_id for r in got if r.doc_id is None) == 6
    kept = [r.doc_id for r in jaccard.keep_one(edge).collect()]
    assert 7 not in kept and kept.count(6) == 2 and 0 in kept and None not in kept
    assert jaccard.keep_one(edge).columns == edge.columns
    assert jaccard.join_similar(empty).count() == 0 and jaccard.keep_one(empty).count() == 0
    # Hot lists dealt by class give the same.
    spread = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join_similar(docs, hot=2).collect()}
    assert spread == {(k, *v) for k, v in brute_components(texts).items()}


def test_parity_filter_is_a_bound():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n, m, both = (int(rng.integers(1, 400)) for _ in range(3))
        common = rng.integers(0, 1 << 56, both, dtype=np.uint64)
        x, y = (np.unique(np.concatenate((common, rng.integers(0, 1 << 56, k, dtype=np.uint64)))) for k in (n, m))
        assert jaccard.least_difference(jaccard.parity(x), jaccard.parity(y)) <= len(np.setxor1d(x, y))
    x, y = (np.unique(rng.integers(0, 1 << 56, 500, dtype=np.uint64)) for _ in range(2))
    assert jaccard.least_difference(jaccard.parity(x), jaccard.parity(y)) > 200


def test_sketch_is_added_up_in_levels(spark, documents, monkeypatch):
    first = jaccard.first_pass(documents.repartition(9), 5)
    whole = jaccard.rarity(first)
    monkeypatch.setattr(jaccard, "FAN_IN", 2)
    assert np.array_equal(jaccard.rarity(first), whole) and whole.any()


def test_repeated_rows_are_verified_once(spark, monkeypatch):
    """Repeats of two near copies, with and without ids, are one pair; a pair that
    failed with a hub isn't tried again."""
    a = " ".join(f"w{i}" for i in range(100))
    rows = [(i % 2 or None, a) for i in range(60)] + [(5, a + " end") for _ in range(60)]
    tried = []
    verify = jaccard.verify
    monkeypatch.setattr(jaccard, "verify", lambda d, c, pairs, *x: (tried.append(pairs.collect()), verify(d, c, pairs, *x))[1])
    got = jaccard.join_similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert len(got) == 120 and {r.component_id for r in got} == {1}
    assert [len(t) for t in tried] == [1]
    tried.clear()
    jaccard.join_similar(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).count()
    pairs = [(r.a, r.b) for t in tried for r in t]
    assert pairs and len(set(pairs)) == len(pairs) and all(a < b for a, b in pairs)


def test_one_of_a_group_stays_though_ids_clash(spark):
    a = " ".join(f"w{i}" for i in range(100))
    other = " ".join(f"v{i}" for i in range(50))
    docs = spark.createDataFrame([(5, a, "x"), (5, other, "y"), (3, a + " end", "z"), (None, a, "n"), (None, "lone one", "m")], "doc_id long, text string, class string")
    assert sorted(r["class"] for r in jaccard.keep_one(docs).collect()) == ["m", "y", "z"]


def test_jaccard_containment(spark):
    """A set and the same with more shingles at one or both sides, with copies:
    the longer set's own rare shingles push the common ones out of its prefix."""
    rng = random.Random(11)
    texts, fresh = {}, iter(range(10**9))
    for k in range(10, 29):
        for before in (0, k // 2, k):
            base = [f"b{next(fresh)}" for _ in range(84)]
            more = [f"m{next(fresh)}" for _ in range(k)]
            both = [" ".join(base), " ".join([*more[:before], *base, *more[before:]])]
            for t in both + both[: rng.randrange(3)]:
                texts[len(texts)] = t
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_similar(docs).collect()}
    assert got == brute_components(texts)


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(50)] + [(5, 5), (0, 1)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in list(top)}


# 9 URL filter


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://", "http://com", "http://COM/", "https://a.b.Example.com/en/x?y#z", "http://www.example.com/en/", "http://xexample.com/en/", "ftp://n.net/es/1", "http://net/fr", "http://a/b://c", "http://u@example.com:80/en/"]
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate([*urls, urls[6]])], "page_id long, url string, verdict string, rule string")
    rules = url_filter.RULES

    def judge(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0].translate(UP)
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, max(fit)[1], max(fit)[2]) if fit else (host, path, None, "allow")

    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, url_filter.rules_frame(spark)).collect()}
    assert got == {i: judge(u) for i, u in enumerate([*urls, urls[6]])}
    assert url_filter.filter_urls(pages.where("false"), url_filter.rules_frame(spark)).count() == 0
    none = url_filter.filter_urls(pages, url_filter.rules_frame(spark).where("false"))
    assert {r.verdict for r in none.collect()} == {"allow"}


# 10 WARC


def test_warc(spark):
    rows = [(1, "http://a/\r\nx", "body"), (2, None, "body"), (3, "http://b", None), (4, "http://c", ""), (5, "u", "é" * 9000), (5, "u", "é" * 9000), (None, "n", "body"), (None, "m", "alone")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string").repartition(2)
    folder = f"{common.shared_dir(spark)}/warc-test-{random.randrange(10**9)}"
    index = warc.write_archives(warc.mark_revisits(pages), folder)
    got = warc.resolve_revisits(warc.read_records(index, folder)).collect()
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    want = sorted([
        (1, 4, sha("body"), "revisit", 2), (2, 4, sha("body"), "response", None), (3, 0, sha(""), "revisit", 4), (4, 0, sha(""), "response", None),
        (5, 18000, sha("é" * 9000), "response", None), (5, 18000, sha("é" * 9000), "response", None), (None, 4, sha("body"), "revisit", 2), (None, 5, sha("alone"), "response", None),
    ], key=str)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == want
    none = warc.write_archives(warc.mark_revisits(pages.where("false")), folder + "-empty")
    assert none.count() == 0 and warc.resolve_revisits(warc.read_records(none, folder + "-empty")).count() == 0
    part = index.where("page_id = 5")
    assert warc.read_records(part, folder).count() == 2
    assert warc.read_records(index.where("false"), folder).count() == 0


def test_ranges():
    assert list(warc.ranges([0, 10, 30, 1000], [10, 10, 5, 5], 10, 100)) == [(0, 3), (3, 4)]
    assert list(warc.ranges([0, 10, 20], [10, 10, 10], 0, 15)) == [(0, 1), (1, 2), (2, 3)]


def test_pipeline(spark, tmp_path):
    """Stage by stage against plain definitions of what must go and stay."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.stage(stage(spark, docs, SF), f"test-{name}")
        assert out.columns == docs.columns
        now = {r.doc_id: r.text for r in out.collect()}
        assert now.items() <= seen.items()
        if name == "near_copies":
            groups = brute_components(seen)
            assert set(now) == {k for k, (n, c) in groups.items() if c == k or not n}
        if name == "decontamination":
            items = [decontam.plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            held = {k for k, t in seen.items() if any(p in decontam.plain(t) for p in items if len(p.split()) >= 4)}
            assert not held & set(now) and len(now) >= len(seen) - len(held) - 2
        docs, seen = out, now
    check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect(), {(k,): t for k, t in seen.items()})
    assert corpus_pipeline.run(spark, SF).select("doc_id").distinct().count() == len(seen)
