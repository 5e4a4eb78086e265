"""Operators 2, 5, 6, 7 and 8 against brute force, round trips and held-out rows."""

from __future__ import annotations

import base64
import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from cardlens.llm import chat, language, linerules, minhash, warc
from cardlens.llm.common import shingle_sets
from cardlens.llm.queries import BYTE_RANKS, PIECES, vocabulary

RANKS, PIECE_FILE = vocabulary(BYTE_RANKS), vocabulary(PIECES)
WORD = re.compile("[^\x20\x09-\x0d]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 2: chat -----------------------------------------------------------------

@pytest.mark.parametrize("text", ["", "\\", "\\\\#", "####", "</turn>", "<\\/turn>", "### User: </turn>\n", "a\\\nb: c"])
def test_escape_is_reversible_and_hides_control(text):
    shown = chat.escape(text)
    assert chat.unescape(shown) == text
    assert "</turn>" not in shown and "##" not in shown


def test_conversations_read_back(spark, odd_docs):
    turns = [(1, 0, "system", "be kind"), (1, 1, "user", "### Assistant: </turn>\n"), (1, 2, "assistant", "ok <|endoftext|>"),
             (1, 2, "assistant", "ok <|endoftext|>"), (2, 5, None, None), (2, 1, "tool: x", "#\\#"), (None, None, "user", "hm"),
             (3, 0, "assistant", "")] + [(4, k, "assistant" if k % 2 else "user", f"turn {k} é日") for k in range(300)]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows = rows.selectExpr("*", "1 as part", "'x' as input_ids")
    parts = chat.format_conversations(rows, RANKS, part_tokens=200)
    assert parts.where("conv_id = 4").count() > 5  # long conversations are cut
    got = {r.conv_id: r for r in chat.read_back(parts, RANKS).collect()}
    low = lambda x: (x is not None, x)  # noqa: E731  nulls first
    by_conv = collections.defaultdict(list)
    for t in sorted(turns, key=lambda t: tuple(map(low, t))):
        by_conv[t[0]].append((t[2] or "", t[3] or ""))
    assert got.keys() == by_conv.keys()
    for conv, ts in by_conv.items():
        loss = "".join(x for r, x in ts if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(ts), sha("".join(f"{a}\n{b}\n" for a, b in ts)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
    assert chat.read_back(chat.format_conversations(rows.where("false"), RANKS), RANKS).collect() == []


def test_loss_mask_covers_only_trained_texts():
    ids, mask, per_turn = chat.assemble([("user", "hi there"), ("assistant", "yes")], RANKS, ("assistant",))
    enc, base = chat.encoding(RANKS)
    assert enc.decode(ids[mask == 1].tolist()) == "yes"
    assert per_turn.sum() == len(ids) and ids.max() == base + chat.TURN_END


# --- 5: WARC -----------------------------------------------------------------

def test_archives(spark, odd_docs, tmp_path):
    pages = [(5, "http://a/x y\n", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (9, None, "<p>é</p>"), (2, "http://b", "<p>é</p>"),
             (7, "u", None), (8, "u", ""), (None, "u", ""), (None, "v", "only"), (1, "w", "z" * 300_000)]
    pages += [(100 + k, f"http://c/{k}", f"<html><body>page {k} of many pages</body></html>" * 5) for k in range(300)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4).selectExpr(
        "*", "'clash' as refers_to", "1 as payload")
    files = warc.write_archives(df, f"file://{tmp_path}", file_bytes=4000)
    assert files.count() > 2 and sum(r.records for r in files.collect()) == len(pages)
    got = sorted((tuple(r) for r in warc.read_archives(spark, files).drop("url").collect()), key=str)
    low: dict = {}
    for i, _, html in pages:
        if i is not None:
            low[html or ""] = min(low.get(html or "", i), i)
    want = []
    for i, _, html in pages:
        data = (html or "").encode()
        first = low.get(html or "")
        other = first if first is not None and first != i else None
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                     "response" if other is None else "revisit", other))
    assert got == sorted(want, key=str)
    path = next(iter(files.collect())).path.removeprefix("file://")
    raw = open(path, "rb").read()
    assert raw[:4] == (warc.DICTIONARY_MAGIC).to_bytes(4, "little")
    assert warc.read_archives(spark, warc.write_archives(df.where("false"), f"file://{tmp_path}/e")).collect() == []
    big = warc.plan_revisits(df, min_revisit=5).where("page_id in (7, 8)").collect()
    assert [r.refers_to for r in big] == [None, None]


# --- 6: MinHash --------------------------------------------------------------

def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_shingle_sets():
    texts = [None, "", "A b", "a B", "a b c d e", "A B C D E f", "a b c d e a b c d e", "x " * 50]
    values, n = shingle_sets(pa.array(texts, pa.string()))
    sets = [set(x.tolist()) for x in np.split(values, np.cumsum(n)[:-1])]
    plain = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in plain] == n.tolist()
    assert all(len(a & b) == len(c & d) for a, c in zip(sets, plain) for b, d in zip(sets, plain))


def check_edited(rows, got):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or "") if r[1] is not None else (r[0] is None, -(r[0] or 0), ""))
    want = collections.Counter()
    for k, (i, t) in enumerate(rows):
        t, n = t or "", rows[(k + 1) % len(rows)][1] or ""
        want[(i, len(t), sha(t[:len(t) - len(t) // 2] + n[:len(t) // 2]))] += 1
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want


def test_edited_texts(spark, small_docs, odd_docs):
    for docs in (small_docs, odd_docs, odd_docs.where("doc_id = 4")):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        check_edited(rows, minhash.op6(docs).collect())
    assert minhash.op6(odd_docs.where("false")).collect() == []
    prints = {r.doc_id: r.fingerprint for r in minhash.fingerprint(odd_docs).collect()}
    assert prints[0] == prints[1] == prints[2] and prints[7] == prints[8] != prints[0]


def test_likeness_estimates_jaccard(spark, small_docs):
    rows = sorted(((r.doc_id, r.text) for r in small_docs.collect()), reverse=True)
    got = {r.doc_id: r for r in minhash.op6(small_docs).collect()}
    errors = []
    for (i, t), (_, n) in zip(rows, [*rows[1:], rows[0]]):
        edited = t[:len(t) - len(t) // 2] + n[:len(t) // 2]
        errors.append(abs(got[i].near_edited - jaccard(shingles(t), shingles(edited))))
        assert abs(got[i].near_next - jaccard(shingles(t), shingles(n))) < 0.2
    assert np.mean(errors) < 0.05 and max(errors) < 0.25


def test_near_duplicates_link_groups(spark, odd_docs):
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(3000)]
    base = [list(rng.choice(words, 200)) for _ in range(6)]
    rows = []
    for g, b in enumerate(base):
        for c in range(4):
            t = list(b)
            if c > 1:
                t[10 * c] = "changed"
            rows.append((10 * g + c, " ".join(t)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    links = [tuple(r) for r in minhash.near_duplicates(docs).collect()]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    texts = dict(rows)
    for a, b, j in links:
        assert j == jaccard(shingles(texts[a]), shingles(texts[b])) >= 0.75
        parent[max(find(a), find(b))] = min(find(a), find(b))
    assert {find(i) for i, _ in rows} == {10 * g for g in range(6)}


def template_group(seed, pairs=60, slots=30, length=400):
    """Fillings of one template, about 0.6 alike, whose slots take one of three
    words; all but the first come in pairs that differ in six slots only."""
    rng = np.random.default_rng(seed)
    at = 6 + np.arange(slots) * 13
    fills = [rng.integers(0, 3, slots)]
    for _ in range(pairs):
        own = rng.integers(0, 3, slots)
        other = own.copy()
        other[rng.choice(slots, 6, replace=False)] += 1
        fills += [own, other % 3]
    rows = []
    for i, fill in enumerate(fills):
        words = [f"w{k}" for k in range(length)]
        for k, v in zip(at.tolist(), fill.tolist()):
            words[k] = f"slot{k}is{v}"
        rows.append((i, " ".join(words)))
    return rows


def groups(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("block_docs", [1024, 16])
def test_near_duplicates_compares_whole_buckets(spark, odd_docs, block_docs):
    rows = template_group(11)
    sets = {i: shingles(t) for i, t in rows}
    want = groups(sets, [(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.75])
    assert list(want.values()).count(0) == 1 and len(set(want.values())) < 62  # the first links to nobody
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block_docs=block_docs).collect()
    assert groups(sets, [(r.doc_id, r.other_id) for r in got]) == want
    assert all(r.jaccard == jaccard(sets[r.doc_id], sets[r.other_id]) >= 0.75 for r in got)


# --- 7: line rules -----------------------------------------------------------

def base_rules(t):
    w = WORD.findall(t or "")
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if n[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(covered)


def test_base_rules(small_docs, odd_docs, no_docs):
    for docs in (small_docs, odd_docs):
        want = collections.Counter()
        for r in docs.collect():
            b = base_rules(r.text)
            want[(r.doc_id, *b, b[0] < 50 or 100 * b[4] > 50 * b[0])] += 1
        got = linerules.assess(docs).collect()
        assert collections.Counter(tuple(r)[:6] + (r.base_failed,) for r in got) == want
        assert not any(r.kept and r.base_failed for r in got)
    assert linerules.assess(no_docs).collect() == []


def test_lines_that_fail_are_removed(spark, odd_docs):
    good = "This line holds a whole sentence and ends as one."
    bad = ["Home | About | Contact | Login", "NOBODY SHOULTS LIKE THIS EVER!", "no end of a sentence here",
           "All rights reserved by the owner of this page.", "a% b% c$ d& e# f* g%.", good,
           "go go go go go go go go go go go go."]
    text = "\n".join([good, *bad, "", "Another good line."])
    docs = spark.createDataFrame([(1, text), (2, None), (3, "x")], "doc_id long, text string")
    cleaned = {r.doc_id: r.text for r in linerules.clean(docs).collect()}
    assert cleaned[1] == f"{good}\n\nAnother good line." and not cleaned[2] and cleaned[3] == ""


def test_clean_documents_are_kept(spark, small_docs):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r for r in linerules.assess(docs).collect() if not r.base_failed]
    good = [r.kept for r in got if labels.get(r.doc_id) == 1]
    junk = [r.kept for r in got if labels.get(r.doc_id) == 0]
    assert np.mean(good) > 0.99 and np.mean(junk) < 0.05


def test_scripts_without_case_are_not_shouting(spark, odd_docs):
    kept = ["هذا سطر كامل من النص العربي.", "هل هذا سطر كامل من النص؟", "यह हिन्दी का एक पूरा वाक्य है।", "זהו משפט שלם בעברית.",
            "我们 使用 API 服务。"]
    text = "\n".join([*kept, "THIS IS SHOUTING.", "ЭТО ОЧЕНЬ ГРОМКО.", "BUY 日 NOW NOW."])
    docs = spark.createDataFrame([(1, text), (2, "\n".join(f"{kept[0][:-1]} {k} {kept[3]}" for k in range(20)))],
                                 "doc_id long, text string")
    cleaned = {r.doc_id: r.text for r in linerules.clean(docs).collect()}
    assert cleaned[1] == "\n".join(kept)
    assert {r.doc_id: r.kept for r in linerules.assess(docs, max_repeat=100).collect()}[2]


# --- 8: language -------------------------------------------------------------

def segmentations(word, pieces):
    """All ways to cut a marked word, by recursion."""
    if not word:
        yield ()
    for n in range(1, len(word) + 1):
        if word[:n] in pieces or (n == 1 and word[0] not in pieces):
            for rest in segmentations(word[n:], pieces):
                yield (word[:n], *rest)


def test_forward_sums_all_segmentations():
    path = PIECE_FILE
    trie = language.trie(path)
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
             if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    import regex
    names = [p for p in names if regex.fullmatch(r"▁?\p{Ll}*", p) and p]
    number = {p: k for k, p in enumerate(names)}
    p = np.random.default_rng(3).dirichlet(np.ones(trie.unknown + 1), 2).T
    words = ["the", "a", "straße", "日本", "abcab", "ǅx"]
    got = language.log_likelihood(words, path, p)
    for w, row in zip(words, got):
        total = sum(np.prod([p[number.get(x, trie.unknown)] for x in s], axis=0)
                    for s in segmentations("▁" + w, number))
        assert np.allclose(row, np.log(total))
    long = language.log_likelihood(["ab" * 400], path, p)  # rescaled, no underflow
    assert np.isfinite(long).all() and (long < -500).all()


def test_expected_counts_add_up():
    path = PIECE_FILE
    trie = language.trie(path)
    p = np.full((trie.unknown + 1, 1), 1e-3)
    counts = language.expected_counts(["hat"], np.array([[2.0]]), path, p)
    import sentencepiece  # noqa: F401
    assert counts.sum() >= 2 and (counts >= 0).all()


def test_languages(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = language.op8(docs, PIECE_FILE).collect()
    held = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert len(got) == len(truth) and np.mean(held) > 0.99
    assert all(0 <= r.score <= 1 for r in got)
    model = language.train(docs, PIECE_FILE)
    odd = {r.doc_id: r for r in language.predict(odd_docs, model, PIECE_FILE).collect()}
    assert [odd[k].lang_pred for k in (0, 1, 2)] == ["und"] * 3 and odd[0].score == 0
    assert odd[7].lang_pred == "en" and odd[7].part == 7  # other columns stay
    assert language.op8(no_docs, PIECE_FILE).collect() == []
    nothing = language.op8(odd_docs.drop("lang").selectExpr("*", "cast(null as string) lang"), PIECE_FILE).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    kept = language.identified(odd_docs, PIECE_FILE)
    assert kept.columns == odd_docs.columns and {0, 1, 2}.isdisjoint({r.doc_id for r in kept.collect()})


def test_every_script_keeps_its_pieces():
    trie = language.trie(PIECE_FILE, language.ANY_SCRIPT)
    uniform = np.full((trie.unknown + 1, 1), 0.5 / trie.unknown)
    uniform[trie.unknown] = 1e-12
    known = language.log_likelihood(["的", "ال", "数据"], PIECE_FILE, uniform, language.ANY_SCRIPT)
    assert (known > 2.5 * np.log(1e-12)).all() and trie.unknown > language.trie(PIECE_FILE).unknown
    assert language.doc_words(pa.array(["हिन्दी e\u0301t\u0301 \u0301"]))[2] == ["हिन्दी", "e\u0301t\u0301"]


def plain_counts(word, trie, p):
    """Expected piece uses of one word by forward and backward sums in logs."""
    x = np.array([[ord(c) for c in language.START + word]], np.int64)
    edges, n = trie.edges(x), x.shape[1]
    steps = [(i, j, int(k[0])) for i, here in enumerate(edges) for r, j, k in here if len(r)]
    a, b = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    a[0] = b[n] = 0.0
    for i, j, k in sorted(steps):
        a[j] = np.logaddexp(a[j], a[i] + np.log(p[k]))
    for i, j, k in sorted(steps, reverse=True):
        b[i] = np.logaddexp(b[i], b[j] + np.log(p[k]))
    out = np.zeros(len(p))
    for i, j, k in steps:
        out[k] += np.exp(a[i] + np.log(p[k]) + b[j] - a[n])
    return out


@pytest.mark.parametrize("letters", [language.LOWER, language.ANY_SCRIPT])
def test_long_words_are_trained_on(letters):
    trie = language.trie(PIECE_FILE, letters)
    p = np.random.default_rng(8).dirichlet(np.full(trie.unknown + 1, 0.3), 2).T
    p = np.maximum(p, 1e-9)
    words = ["hat", "straßenbahn" * 3, "international" * 50, "数据获取的" * 40, "ab" * 8, "xy" * 16]
    for w in words:
        got = language.expected_counts([w], np.array([[1.0, 3.0]]), PIECE_FILE, p, letters)
        for k, times in enumerate((1.0, 3.0)):
            assert np.allclose(got[:, k], times * plain_counts(w, trie, p[:, k]), rtol=1e-6, atol=1e-9)


def test_counts_by_word_and_language(monkeypatch):
    """Words of several languages at once add up to the words alone, and a
    vector of the vocabulary's length is made by block of words only."""
    trie = language.trie(PIECE_FILE, language.ANY_SCRIPT)
    p = np.maximum(np.random.default_rng(9).dirichlet(np.full(trie.unknown + 1, 0.3), 3).T, 1e-9)
    pairs = [("hat", 0, 2.0), ("hat", 2, 5.0), ("tah", 1, 1.0), ("straßenbahn" * 3, 1, 3.0), ("数据获取的", 2, 4.0)]
    words, lang, n = (list(x) for x in zip(*pairs))
    made = []
    count = np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, *a, **b: made.append(len(x)) or count(x, *a, **b))
    got = language.pair_counts(words, np.array(lang), np.array(n), PIECE_FILE, p, language.ANY_SCRIPT)
    assert len(made) == len({len(w) for w in words})
    monkeypatch.undo()
    want = np.zeros(p.shape)
    for w, k, times in pairs:
        want[:, k] += times * plain_counts(w, trie, p[:, k])
    assert np.allclose(got, want, rtol=1e-6, atol=1e-9)
    table = np.array([[2.0, 0, 5], [0, 1, 0], [0, 3, 0], [0, 0, 4]])
    once = language.expected_counts(list(dict.fromkeys(words)), table, PIECE_FILE, p, language.ANY_SCRIPT)
    assert np.allclose(once, got, rtol=1e-12)
    assert not language.pair_counts([], np.zeros(0, int), np.zeros(0), PIECE_FILE, p).any()


def test_batches_of_words_are_joined():
    batches = [pa.RecordBatch.from_pydict({"n": list(range(k, k + 3))}) for k in range(0, 15, 3)]
    got = [t.column("n").to_pylist() for t in language.joined(iter(batches), rows=6)]
    assert got == [list(range(6)), list(range(6, 12)), [12, 13, 14]]
    assert len(list(language.joined(iter(batches), limit=1))) == 5 and list(language.joined(iter([]))) == []


def test_likelihoods_hold_one_column_of_words_at_a_time():
    """Memory per word of the texts does not follow the number of languages,
    and equal texts get equal results wherever they stand."""
    import tracemalloc
    langs, words = 24, 100_000
    pieces = np.random.default_rng(3).random((language.trie(PIECE_FILE, language.ANY_SCRIPT).unknown + 1, langs))
    model = language.Model([str(k) for k in range(langs)], np.zeros(langs), pieces / pieces.sum(axis=0))
    texts = pa.array(["ab cde fghi " * (words // 30), "xyz ab", None, "", *["xyz ab", "cde " * (words // 10)] * 9])
    tracemalloc.start()
    total, letters = language.likelihoods(texts, model, PIECE_FILE)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * words * langs  # one value a word and language would be more
    assert (total[1] == total[4::2]).all() and not total[2:4].any() and letters[:4].tolist() == [words // 30 * 9, 5, 0, 0]


def test_floors_and_models_come_from_all_documents(spark):
    common, rare = "the cat sat on the mat", "zq xj kv wq"
    rows = [(k, common if k % 50 else rare, "en") for k in range(3000)] + [(5000, common, None), (5001, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    model = language.train(docs, PIECE_FILE)
    total, letters = language.likelihoods(pa.array([common, rare]), model, PIECE_FILE)
    at = model.langs.index("en")
    assert np.exp(model.prior[at]) == pytest.approx(3000 / 3001)
    # the expected uses of all pieces add up to all words, so that those of a
    # sample of the rows would be smaller
    unseen = model.pieces[:, at].min()
    assert 0.05 / unseen > 6 * 2940 + 4 * 60
    density = [t / n for t, n in zip(total[:, at], letters)]
    values = np.array([density[0] if k % 50 else density[1] for k in range(3000)])
    codes = spark.createDataFrame([("en", int(c)) for c in language.order_code(values)] + [(None, 3), ("de", None)],
                                  "lang string, code long")
    assert language.low_values(codes, 0.01) == {"en": pytest.approx(density[1], rel=1e-12)}
    kept = language.identified(docs, PIECE_FILE, 0.0)
    assert kept.columns == docs.columns and kept.count() == 3001


def test_low_values_are_exact(spark):
    rng = np.random.default_rng(5)
    values = {"a": rng.normal(-3, 1, 2501), "b": np.repeat([-2.0, -1.5, 0.0, 7.5], 101), "c": np.array([-4.25])}
    rows = [(x, int(c)) for x, v in values.items() for c in language.order_code(v)]
    codes = spark.createDataFrame(rows + [(None, 1), ("d", None)], "lang string, code long").repartition(3)
    for share in (0.0, 0.01, 0.25, 0.5, 1.0):
        got = language.low_values(codes, share)
        assert got.keys() == values.keys()
        for x, v in values.items():
            assert got[x] == pytest.approx(np.quantile(v, share), rel=1e-12, abs=1e-12)
    assert language.low_values(codes.where("false"), 0.01) == {}


def test_languages_without_case(spark, odd_docs):
    """Two scripts without case, in words of one length over 64 letters."""
    rng = np.random.default_rng(2)
    rows = []
    for name, letters in (("ar", "المرنوتديبهس"), ("zh", "的数据获取一个用不中有为时在件")):
        for _ in range(60):
            rows.append((len(rows), " ".join("".join(rng.choice(list(letters), 70)) for _ in range(3)), name))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.op8(docs, PIECE_FILE).collect()}
    assert all(got[i] == name for i, _, name in rows)
