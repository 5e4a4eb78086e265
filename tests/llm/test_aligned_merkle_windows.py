"""Operators 11 to 13 against brute force, SQL and odd input."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from cardlens.llm import align, doubling, merkle, queries
from cardlens.llm.common import ship_package
from cardlens.llm.oracle import SQL
from cardlens.llm.queries import BYTE_BPE, PIECES, vocabulary

WORDS = re.compile("[^\x20\x09-\x0d]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def paths():
    return vocabulary(BYTE_BPE), vocabulary(PIECES)


# --- 11: alignment ------------------------------------------------------------

def aligned_by_hand(rows, paths):
    """Whole texts, encoded by the libraries without chunks."""
    (tokenizer, bytes_a), (model, bytes_b) = align.load_a(paths[0]), align.load_b(paths[1])
    found, count = [], Counter()
    for doc_id, text in rows:
        groups, links, a, b = [], [], [], []
        if text:
            a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
            data = (" " + text).encode()
            if b"".join(bytes_a[k] for k in a) != data or b"".join(bytes_b[k] for k in b) != data:
                a, b = [], []
            ends_a, ends_b, at = {}, {}, 0
            for i, k in enumerate(a):
                at += len(bytes_a[k])
                ends_a[at] = i
            at = 0
            for i, k in enumerate(b):
                at += len(bytes_b[k])
                ends_b[at] = i
            i = j = 0
            for end in sorted(ends_a.keys() & ends_b.keys()):
                x, y = a[i:ends_a[end] + 1], b[j:ends_b[end] + 1]
                i, j = ends_a[end] + 1, ends_b[end] + 1
                groups.append(f"{','.join(map(str, x))}|{','.join(map(str, y))}")
                links.append((x[-1], y[-1]))
        count.update(links)
        found.append((doc_id, len(a), len(b), groups, links))
    best = defaultdict(int)
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return sorted(((d, na, nb, len(g), len(k), sum(count[p] == best[p[1]] for p in k), sum(count[p] for p in k),
                    sha(";".join(g)) if g else "") for d, na, nb, g, k in found), key=repr)


def test_alignment_equals_whole_texts(small_docs, paths):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    assert rows_of(align.op11(small_docs, *paths)) == aligned_by_hand(rows, paths)


def test_alignment_of_odd_texts(spark, odd_docs, no_docs, paths):
    more = [(50, "a  b   c \n d\t e "), (51, " "), (52, "   "), (53, " lead"), (54, "x▁y z"), (55, "\x00 nul"),
            (56, "<s> </s> <unk> <0x41> <|endoftext|>x"), (57, "a \xa0 b  c　 d\x85 e\x1c f"),
            (58, "é ﬁ ½ Ａ ​ z"), (59, "\U0001f600 \U0001f468‍\U0001f469 ok")]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    assert rows_of(align.op11(docs, *paths)) == aligned_by_hand([tuple(r) for r in docs.collect()], paths)
    assert rows_of(align.op11(odd_docs, *paths)) == aligned_by_hand(
        [(r.doc_id, r.text) for r in odd_docs.collect()], paths)
    assert align.op11(no_docs, *paths).collect() == []


def test_identity_map_names_equal_bytes(paths):
    bytes_a, bytes_b = align.load_a(paths[0])[1], align.load_b(paths[1])[1]
    same = align.Aligner(*paths).same
    assert (same >= 0).sum() > 10_000
    assert all(bytes_a[k] == bytes_b[b] for k, b in enumerate(same) if b >= 0)


def test_aligner_forgets_and_stays_right(paths):
    small = align.Aligner(*paths, limit=3)
    texts = ["one two three four", "five six seven", None, "one two", "x" * 50_000]
    assert [small.block([t]) for t in texts] == [align.Aligner(*paths).block([t]) for t in texts]


# --- 12: Merkle manifest -----------------------------------------------------

def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def merkle_by_hand(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    def leaf(r):
        return sha("".join(map(field, r)))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
        return out

    def fold(node, place, tree):
        proof = ""
        for nodes in tree[:-1]:
            pair = nodes[place & ~1:(place & ~1) + 2]
            proof += "".join(n for i, n in enumerate(pair) if i != place & 1)
            pair[place & 1] = node
            node, place = sha("".join(pair)), place >> 1
        return node, proof

    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = levels([leaf(r) for r in by_lang[lang]])
    top = levels([trees[x][-1][0] for x in langs])
    out = []
    for at, lang in enumerate(langs):
        for place, r in enumerate(by_lang[lang]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            node = leaf((*r[:3], r[3] + 1, r[4])) if hit else leaf(r)
            sub, low = fold(node, place, trees[lang])
            folded, high = fold(sub, at, top)
            out.append((r[0], leaf(r), trees[lang][-1][0], top[-1][0], sha(low + high), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [2, 8, merkle.BLOCK])
def test_manifest_equals_whole_trees(small_docs, size):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in small_docs.collect()]
    got = rows_of(merkle.proofs(merkle.build(small_docs, size)))
    assert got == merkle_by_hand(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_manifest_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in odd_docs.collect()]
    rows += [(k, "s", lang, n, "t") for k, lang, n in
             [(20, None, 3), (21, "é", 2**63 - 1), (22, "z", -1), (7, "z", 0), (12, "a", 1), (3, "en", 5), (3, "en", 5)]]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for size in (2, 4, merkle.BLOCK):
        assert rows_of(merkle.proofs(merkle.build(docs, size))) == merkle_by_hand(rows)
    assert merkle.op12(odd_docs).count() == odd_docs.count()
    assert merkle.op12(no_docs).collect() == []


def test_versions_copy_only_ancestors(small_docs):
    manifest = merkle.build(small_docs, 4)
    verdict = {r.doc_id: r for r in merkle.proofs(manifest).collect()}
    sizes = {r.tree: r.total for r in manifest.blocks.select("tree", "total").distinct().collect()}
    versions = defaultdict(list)
    for r in merkle.version_nodes(manifest).collect():
        versions[r.tree, r.rank, r.doc_id].append((r.level, r.digest))
    assert versions and all(zlib.crc32(str(d).encode()) % 7 == 0 for _, _, d in versions)
    langs = len(sizes)
    for (tree, _, doc_id), nodes in versions.items():
        nodes.sort()
        assert [k for k, _ in nodes] == list(range(len(nodes)))
        assert len(nodes) == 1 + (sizes[tree] - 1).bit_length() + (langs - 1).bit_length()
        assert nodes[-1][1] == verdict[doc_id].folded_root and nodes[0][1] != verdict[doc_id].leaf


def test_block_size_is_a_power_of_two(no_docs):
    with pytest.raises(ValueError):
        merkle.build(no_docs, 6)


# --- 13: windows -----------------------------------------------------------------

def dedup_by_hand(rows, n):
    first, holders = {}, defaultdict(set)
    texts = [(d, WORDS.findall(t or "")) for d, t in rows]
    known = [(d, w) for d, w in texts if d is not None]
    length, longest = n, defaultdict(int)
    for d, w in known:
        for i in range(len(w) - n + 1):
            first[tuple(w[i:i + n])] = min(d, first.get(tuple(w[i:i + n]), d))
    while True:
        holders.clear()
        for d, w in known:
            for i in range(len(w) - length + 1):
                holders[tuple(w[i:i + length])].add(d)
        more = {d for ids in holders.values() if len(ids) > 1 for d in ids}
        if not more:
            break
        for d in more:
            longest[d] = length
        length *= 2
    out = []
    for d, w in texts:
        lost = set()
        if d is not None:
            for i in range(len(w) - n + 1):
                if first[tuple(w[i:i + n])] < d:
                    lost.update(range(i, i + n))
        spans = []
        for i in sorted(lost):
            if spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        kept = " ".join(x for i, x in enumerate(w) if i not in lost)
        longest_here = 0
        if d is not None:  # by row: rows of one doc_id have their own texts
            length = n
            while length <= longest[d] and any(
                    _shared(known, d, tuple(w[i:i + length])) for i in range(len(w) - length + 1)):
                longest_here, length = length, 2 * length
        out.append((d, len(w), len(lost), [tuple(s) for s in spans], sha(kept), kept, longest_here))
    return sorted(out, key=repr)


def _shared(known, doc_id, window):
    key = f" {' '.join(window)} "
    return any(d != doc_id and key in f" {' '.join(w)} " for d, w in known)


def dedup_rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, [tuple(s) for s in r.spans], r.kept_sha256, r.kept, r.longest)
                   for r in df.collect()), key=repr)


@pytest.mark.parametrize("n", [2, 5, 13])
def test_windows_equal_brute_force(spark, n):
    import random
    ship_package(spark)
    rng = random.Random(n)
    words = [f"w{k}" for k in range(12 if n < 10 else 40)]
    passage = [rng.choice(words) for _ in range(70)]
    rows = []
    for d in range(60):
        a, b = sorted(rng.sample(range(70), 2))
        text = [rng.choice(words) for _ in range(rng.randint(0, 30))] + passage[a:b] * rng.choice([0, 1, 1, 2])
        text += [rng.choice(words) for _ in range(rng.randint(0, 30))]
        rows.append((d // 2 * 3 if d % 7 == 0 else 200 - d, " ".join(text)))
    rows += [(None, " ".join(passage)), (300, " ".join(passage)), (301, " ".join(passage)), (301, " ".join(passage)),
             (302, " ".join(passage).replace(" ", " \n\t")), (303, None), (304, ""), (305, " \n"), (306, "é ü " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert dedup_rows(doubling.deduplicate(docs, n)) == dedup_by_hand(rows, n)


def test_windows_of_odd_texts(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    found = doubling.deduplicate(odd_docs).collect()
    assert len(found) == len(rows)
    got = {(r.doc_id, r.n_words, r.n_removed): r for r in found}
    long = {d: sum(1 for _ in WORDS.findall(t or "")) for d, t in rows if d is not None}
    assert {d for d, n, lost in got if lost} == {8} and got[8, long[8], long[8]].kept == ""
    assert got[7, long[7], 0].longest >= 13 * 2 ** 9
    assert doubling.deduplicate(no_docs).collect() == []


def test_window_needs_two_words(no_docs):
    with pytest.raises(ValueError):
        doubling.deduplicate(no_docs, 1)


# --- queries against SQL --------------------------------------------------------

@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got = queries.QUERIES[name](spark, folder)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({SQL[name]})").fetchall()
    assert [tuple(r) for r in sorted(want, key=repr)] == rows_of(got)
