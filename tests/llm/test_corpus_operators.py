"""Operators 3 and 10, components and the pipeline."""

from __future__ import annotations

import collections
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from cardlens.llm import cotrain, jaccard
from cardlens.llm.common import ship_package
from cardlens.llm.graph import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def token_set(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    """(doc_id, text) -> {doc_id: (set size, component)} by comparing all pairs."""
    sets = {i: token_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies(seed, groups=12, copies=9):
    """Chains of edited copies around the threshold, exact copies, a passage
    that all documents share, and short texts."""
    rng = np.random.default_rng(seed)
    words = np.array([f"w{k}" for k in range(5000)])
    passage = " ".join(rng.choice(words, 40))
    rows, i = [], 0
    for g in range(groups):
        text = list(rng.choice(words, int(rng.integers(5, 120))))
        for _ in range(copies):
            for _ in range(int(rng.integers(0, 4))):  # the next copy is an edit of this one
                text = list(text)
                text[int(rng.integers(len(text)))] = f"e{rng.integers(10**6)}"
            body = " ".join(text)
            rows.append((i * 3 + 1, body + ("" if g % 3 else ".\n" + passage)))
            i += 1
        rows.append((i * 3 + 1, rows[-1][1].upper()))
        i += 1
    return rows + [(90_000 + k, t) for k, t in enumerate(["a b", "A  b", "b a", "", None, " ", "c", "a b c d e", "a b c d e f"])]


@pytest.mark.parametrize("seed,block", [(0, 1024), (1, 4)])
def test_components_equal_all_pairs(spark, odd_docs, seed, block):
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).selectExpr("*", "7 as n", "'x' as node")
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard.join_components(docs, block_docs=block).collect()}
    assert got == brute_components(rows)


def test_blocks_without_documents(spark, odd_docs):
    """Few long documents in more blocks than documents: some blocks are empty."""
    rng = np.random.default_rng(6)
    rows = []
    for g in range(4):
        text = [f"g{g}w{k}" for k in range(int(rng.integers(150, 200)))]
        for c in range(3):
            text = [*text[:-2], f"e{c}", f"f{c}"]
            rows.append((10 * g + c, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_components(docs, block_tokens=40).collect()}
    assert got == brute_components(rows)


def test_low_threshold_links_distant_sizes(spark, odd_docs):
    """Texts and extensions of them to nearly twice their size, in small blocks."""
    rows = []
    for g in range(10):
        words = [f"g{g}w{k}" for k in range(60 + 5 * g)]
        rows += [(10 * g, " ".join(words[:40 + 3 * g])), (10 * g + 1, " ".join(words[:24 + 2 * g])), (10 * g + 2, " ".join(words))]
    passage = " ".join(f"p{k}" for k in range(6))
    rows = [(i, f"{t} {passage}") for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: token_set(t) for i, t in rows}
    parent = {i: i for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and 2 * both >= len(sets[a]) + len(sets[b]) - both:
                low, high = sorted((parent[a], parent[b]))
                parent = {i: low if c == high else c for i, c in parent.items()}
    got = {r.doc_id: r.component_id for r in jaccard.join_components(docs, Fraction(1, 2), block_docs=1).collect()}
    assert got == parent and len(set(parent.values())) < len(rows)


def test_odd_documents(spark, odd_docs, no_docs):
    got = sorted(tuple(r) for r in jaccard.op10(odd_docs).collect())
    assert got == sorted((i, *v) for i, v in brute_components(
        [(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id is not None]).items())
    assert jaccard.op10(no_docs).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_tree_search_connects_what_all_pairs_connect(seed):
    rng = np.random.default_rng(seed)
    entries = []
    for g in range(6):
        base = rng.integers(0, 2**63, int(rng.integers(1, 80))).astype(np.uint64)
        for _ in range(15):
            keep = base[rng.random(len(base)) < 0.93]
            extra = rng.integers(0, 2**63, int(rng.integers(0, 3))).astype(np.uint64)
            s = np.unique(np.concatenate((keep, extra)))
            if len(s):
                entries.append((len(entries), s))
    t = Fraction(3, 4)

    def joined(pairs, n):
        label = np.arange(n)
        for a, b in pairs:
            label[label == max(label[a], label[b])] = min(label[a], label[b])
        return label.tolist()

    def link(a, b):
        both = len(np.intersect1d(a, b))
        return 100 * both >= 75 * (len(a) + len(b) - both)

    n = len(entries)
    all_pairs = [(i, j) for i, a in entries for j, b in entries if i < j and link(a, b)]
    found = jaccard.linked_pairs(entries, None, t)
    assert set(map(frozenset, found)) <= set(map(frozenset, all_pairs))
    assert joined(found, n) == joined(all_pairs, n)
    left, right = entries[: n // 3], entries[n // 3:]
    parts = (jaccard.linked_pairs(left, None, t) + jaccard.linked_pairs(right, None, t)
             + jaccard.linked_pairs(left, right, t))
    assert joined(parts, n) == joined(all_pairs, n)


def test_bounds_never_drop_a_link():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 2**63, 40).astype(np.uint64)) for _ in range(30)]
    sets += [np.sort(s[: 36 + k % 4]) for k, s in enumerate(sets)]
    tree = jaccard.SignatureTree(sets, 64)  # very full bitmaps
    i, j = (x.ravel() for x in np.indices((len(sets), len(sets))))
    ok = jaccard.can_link(tree.levels[0], tree.levels[0], i, j, Fraction(3, 4))
    for a, b, k in zip(i, j, ok):
        both = len(np.intersect1d(sets[a], sets[b]))
        assert k or 100 * both < 75 * (len(sets[a]) + len(sets[b]) - both)


def test_graph_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (220, 2))]
    edges += [(1000 + k, 1001 + k) for k in range(40)] + [(5000, 6000 + k) for k in range(50)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    sizes = collections.Counter(find(x) for x in parent)
    assert got == {x: find(x) for x in parent if sizes[find(x)] > 1}


@pytest.fixture(scope="module")
def labelled(spark):
    return (spark.read.parquet("/root/testdata/sf0.01/documents.parquet"),
            spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))


def test_quality_on_held_out_rows(spark, labelled, odd_docs):
    docs, labels = labelled
    model = cotrain.train(docs, labels.where("doc_id % 4 != 2"))
    got = {r.doc_id: r for r in cotrain.score(docs, model).collect()}
    assert len(got) == docs.count()
    held = [r for r in labels.where("doc_id % 4 = 2").collect()]
    good = [got[r.doc_id].accepted for r in held if r.quality == 1 and r.toxic == 0]
    junk = [got[r.doc_id].accepted for r in held if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(junk) < 0.2
    odd = cotrain.score(odd_docs, model)
    rows = odd.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.quality_score <= 1 for r in rows)
    assert set(odd_docs.columns) < set(odd.columns)


def test_quality_without_labels(spark, labelled, odd_docs, no_docs):
    docs, labels = labelled
    some = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, None), (None, 0, 0), (4, None, 1)],
                                 "doc_id long, quality int, toxic int")
    rows = cotrain.op3(odd_docs, some).collect()
    assert {(r.quality_score, r.accepted) for r in rows} == {(0.5, True)} and len(rows) == odd_docs.count()
    assert cotrain.accepted(odd_docs, some.where("false")).columns == odd_docs.columns
    assert cotrain.op3(no_docs, some).collect() == []


def test_labels_of_one_document(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, 1, None), (None, 1, 0), (4, None, 0)],
                                   "doc_id long, quality int, toxic int")
    assert {tuple(r) for r in cotrain.labelled_rows(labels).collect()} == {(1, 0), (2, 0), (3, 1)}


def accuracy(docs, labels, held, rounds):
    """(share of held-out labels met, share of held-out toxic documents accepted)."""
    model = cotrain.train(docs, labels.where(f"NOT ({held})"), rounds=rounds)
    got = cotrain.score(docs.select("doc_id", "text", "lang", "source"), model).select("doc_id", "accepted")
    rows = got.join(labels.where(held), "doc_id").collect()
    return (np.mean([r.accepted == (r.quality == 1 and r.toxic == 0) for r in rows]),
            np.mean([r.accepted for r in rows if r.toxic == 1]))


def test_exchange_does_not_harm(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"
    one, _ = accuracy(docs, labels, held, 1)
    three, toxic = accuracy(docs, labels, held, 3)
    assert three >= one > 0.98 and toxic < 0.05


def test_documents_of_classes_that_a_view_is_sure_of_are_handed_over(spark, labelled):
    docs, _ = labelled
    rows = docs.select("doc_id", "text", "lang", "source").where("doc_id < 300")
    views = cotrain.View({"s:x%": -3.0, "f:x.": 1.0}), cotrain.View({"lang=de": 2.0, "lang=fr": -2.0})
    model = cotrain.Model(*views, np.zeros(3))
    sure = {("text", 0): (0.9, 0.98), ("text", 1): None, ("meta", 0): (0.8, 0.97), ("meta", 1): (0.85, 0.99)}
    wanted = {"text": ["w:de", "s:x,", "absent"], "meta": ["lang=en", "source=src1"]}
    sample = set(range(0, 300, 7))
    got = cotrain.handed_counts(rows.repartition(3), model, sure, sample, wanted)
    want = {v: (np.zeros((len(wanted[v]), 2)), np.zeros(2)) for v in wanted}
    import pyarrow as pa
    for r in rows.collect():
        if r.doc_id in sample:
            continue
        batch = pa.RecordBatch.from_pylist([r.asDict()])
        have = {v: {names[k] for k in f} for v, (names, _, f) in cotrain.features_of(batch).items()}
        p = {v: 1 / (1 + np.exp(-sum(w for f, w in getattr(model, v).weights.items() if f in have[v]))) for v in have}
        told = {v: 1 if sure[v, 1] and p[v] >= sure[v, 1][0] else 0 if sure[v, 0] and 1 - p[v] >= sure[v, 0][0] else None
                for v in have}
        if None not in told.values() and told["text"] != told["meta"]:
            continue
        for v, giver in (("text", "meta"), ("meta", "text")):
            if told[giver] is not None:
                want[v][1][told[giver]] += 1
                for k, f in enumerate(wanted[v]):
                    want[v][0][k, told[giver]] += f in have[v]
    for v in want:
        assert (got[v][0] == want[v][0]).all() and (got[v][1] == want[v][1]).all()
    assert want["text"][1].sum() > 20


def test_thresholds_follow_measured_precision():
    p, right = np.array([0.9, 0.8, 0.8, 0.7, 0.6]), np.array([True, True, False, True, True])
    assert cotrain.sure_from(p, right, 0.8, 3) == (0.6, 0.8)  # whole ties only
    assert cotrain.sure_from(p, right, 0.9, 1) == (0.9, 1.0)
    assert cotrain.sure_from(p, right, 0.9, 2) is None and cotrain.sure_from(p[:0], right[:0], 0.5, 0) is None


def test_a_fully_labelled_table_has_nothing_to_hand_over(spark, labelled):
    docs, _ = labelled
    rows = docs.where("doc_id < 400")
    labels = rows.selectExpr("doc_id", "cast(source <> 'src1' as int) as quality", "0 as toxic")
    model = cotrain.train(rows, labels, rounds=3)
    assert model is not None and cotrain.score(rows, model).count() == rows.count()


def test_memory_of_the_quality_stage(spark, labelled, monkeypatch):
    """Driver lists reach the executors without Python workers of their own,
    and a task has the features of a bounded part of the texts at a time."""
    from pyspark.sql import SparkSession
    from cardlens.llm import common, language
    docs, labels = labelled
    given = []
    create = SparkSession.createDataFrame
    monkeypatch.setattr(SparkSession, "createDataFrame", lambda self, data, *a, **b: given.append(type(data)) or create(self, data, *a, **b))
    assert cotrain.train(docs, labels) is not None
    codes = docs.selectExpr("lang", "crc32(cast(text as binary)) as code")
    assert language.low_values(codes, 0.01)
    assert given and set(given) == {pa.Table}
    monkeypatch.undo()
    texts = pa.RecordBatch.from_pydict({"text": ["some words " * 20_000] * 30})
    sizes = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: list(run(iter([texts]))))
    monkeypatch.setattr(cotrain, "probabilities", lambda batch, m: sizes.append(batch.nbytes) or [np.ones(batch.num_rows)] * 3)
    monkeypatch.setattr(cotrain, "train", lambda *_: None)
    out = cotrain.accepted(spark.range(1).selectExpr("'x' as text"), None)
    assert sum(b.num_rows for b in out) == 30 and max(sizes) < 3 << 20
    x = np.random.default_rng(1).integers(-50, 50, 999)
    assert common.distinct(x).tolist() == np.unique(x).tolist() and not len(common.distinct(x[:0]))


def test_memory_of_the_near_copies_stage(spark, monkeypatch):
    """A task of the join takes a bounded multiple of its text, and gives its
    memory back at the end."""
    import tracemalloc

    from cardlens.llm import common
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.integers(10**5, size=3000)) for _ in range(350)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(350), pa.int64()), "text": texts})
    runs, ended, peaks = [], [], []
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow",
                        lambda self, run, schema: runs.append(run) or spark.createDataFrame([], schema))
    monkeypatch.setattr(jaccard, "chunk_id", lambda k: k)
    monkeypatch.setattr(common, "release", lambda: ended.append(1))
    jaccard.root_candidates(spark.createDataFrame([], "doc_id long, text string"), Fraction(3, 4))
    for run, given in ((runs[0], [batch]), (runs[1], None)):
        given = given or [b.select(["chunk", "a", "b", "c", "d"]) for b in out]
        tracemalloc.start()
        out = list(run(iter(given)))
        peaks.append(tracemalloc.get_traced_memory()[1] / 2**20)
        tracemalloc.stop()
    assert peaks[0] < 30 and peaks[1] < 40, peaks
    assert sum(b.num_rows for b in out) > 0 and len(ended) == 2


def test_pipeline(spark):
    sf = "/root/testdata/sf0.01"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_copies", "packing"]
    import random

    from cardlens.llm.common import materialize
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    noise = [" ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(rng.choice([8, 30, 200])))
             for _ in range(30)]
    noise += ["Быстрая коричневая лиса прыгает через ленивую собаку и бежит дальше в лес " * k for k in range(1, 11)]
    docs = before = spark.read.parquet(f"{sf}/documents.parquet")
    clean = docs.count()
    planted = [(10**6 + k, t, None, None, len(t)) for k, t in enumerate(noise)]
    docs = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs, before = materialize(stage(spark, docs, sf), f"test-{name}"), docs
        sizes.append(docs.count())
        if name != "packing":
            assert docs.columns == before.columns
        if name == "language":
            assert docs.where("doc_id >= 1000000").count() == 0 and docs.count() >= 0.99 * clean
        if name == "near_copies":
            found = brute_components([(r.doc_id, r.text) for r in before.collect()])
            assert {r.doc_id for r in docs.collect()} == {i for i, (_, c) in found.items() if i == c}
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4]


def test_dictionary_survives_long_pages(spark):
    from cardlens.llm import warc
    from cardlens.session import scratch_path
    ship_package(spark)
    body = "<html><head><title>{0}</title></head><body><p class='entry'>common words of page {0}</p></body></html>"
    rows = [(k, f"http://host/{k}", body.format(k)) for k in range(400)]
    rows += [(1000 + k, f"http://long/{k}", "z" * (9 << 20)) for k in range(3)] + [(2000, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    sample = warc.dictionary_sample(pages, len(rows), 2000, 8 << 20, 16 << 10, "2026-01-01T00:00:00Z")
    assert len(sample) == len(rows) and max(map(len, sample)) < 17 << 10
    assert sample == warc.dictionary_sample(pages.repartition(7), len(rows), 2000, 8 << 20, 16 << 10, "2026-01-01T00:00:00Z")
    assert len(warc.train_dictionary(sample)) > 1000
    files = warc.write_archives(pages, scratch_path(spark, "archives"))
    got = {r.page_id: (r.payload_bytes, r.record_type) for r in warc.read_archives(spark, files).collect()}
    assert got[2000] == (0, "response") and got[1002] == (9 << 20, "revisit") and len(got) == len(rows)
