"""Operators 1, 4 and 9 against the tokenizers library."""

from __future__ import annotations

import hashlib
import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cardlens.llm import bitpack, bpe, packing
from cardlens.llm.queries import WORD_BPE, vocabulary
from cardlens.llm.tokens import ChunkEncoder

PATH = vocabulary(WORD_BPE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chunk_encoder_equals_the_library(library, odd_docs):
    odd = [r.text for r in odd_docs.collect()]
    encoder = ChunkEncoder(PATH, limit=3)  # starts anew all the time
    for texts in (odd, odd[::-1]):
        ids, n = encoder.encode(pa.array(texts, pa.string()))
        parts = np.split(ids, np.cumsum(n)[:-1])
        assert [p.tolist() for p in parts] == [ids_of(library, t) for t in texts]
        assert encoder.counts(pa.array(texts, pa.string())).tolist() == n.tolist()


def test_lexicon_holds_its_words_and_no_others():
    words = sorted({bytes(w) for n in range(1, 5) for w in itertools.product(b"abc", repeat=n) if sum(w) % 3})
    ids = [np.arange(k % 5 + 1) + k for k in range(len(words))]
    lexicon = bpe.Lexicon.mapped(bpe.compile_lexicon(words, ids))
    others = [b"", b"d", b"aaaaa", b"cab" * 9]
    others += [w for n in range(1, 5) for w in map(bytes, itertools.product(b"abc", repeat=n)) if not sum(w) % 3]
    number = lexicon.numbers(words + others)
    assert number[:len(words)].tolist() == list(range(len(words)))
    assert set(number[len(words):].tolist()) == {-1}
    assert all(lexicon.output(k).tolist() == ids[k].tolist() for k in range(len(words)))
    assert len(lexicon.finals) < sum(map(len, words)) / 2  # suffixes are shared
    empty = bpe.Lexicon.mapped(bpe.compile_lexicon([], []))
    assert empty.numbers([b"a", b""]).tolist() == [-1, -1]


def test_merges_equal_the_library(library):
    words = ["hello", "the", "a", "zzzzzzzzzz", "straße", "antidisestablishmentarianism", "日本", "x" * 300]
    got = bpe.merges(PATH).merge([w.encode() for w in words])
    assert [g.tolist() for g in got] == [ids_of(library, w) for w in words]


@pytest.mark.parametrize("size", [0, 50])
def test_encode_and_decode_whole_texts(spark, odd_docs, library, size):
    lexicon = bpe.build_lexicon(odd_docs, PATH, size, min_count=1) if size else bpe.compile_lexicon([], [])
    tokens = bpe.encode(odd_docs, PATH, lexicon)
    decoded = {(r.doc_id, r.decoded) for r in bpe.decode(tokens, PATH).collect()}
    digests = [tuple(r) for r in bpe.digests(tokens, PATH).collect()]
    want = []
    for r in odd_docs.collect():
        ids = ids_of(library, r.text)
        text = library.decode(ids, skip_special_tokens=False)
        assert (r.doc_id, text) in decoded
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(text)))
    assert sorted(digests, key=str) == sorted(want, key=str)


def test_no_documents(spark, no_docs):
    assert bpe.digests(bpe.encode(no_docs, PATH, bpe.build_lexicon(no_docs, PATH)), PATH).collect() == []
    assert bitpack.op9(spark, no_docs, PATH).collect() == []
    assert packing.op1(no_docs, PATH).collect() == []


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 31, 32])
def test_bit_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    data = bitpack.pack(ids, bits)
    assert len(data) == -(-1001 * bits // 8)
    assert (bitpack.unpack(data, 1001, bits) == ids).all()
    if bits < 32:
        with pytest.raises(ValueError):
            bitpack.pack(np.array([1 << bits]), bits)


def test_width():
    assert [bitpack.bit_width(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


@pytest.mark.parametrize("bits", [11, 16])
def test_random_access(tmp_path, bits):
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 1 << bits, n).astype(np.uint32) for n in (0, 5, 1000, 1, 0, 77, 64, 129)]
    with bitpack.new_file(f"file://{tmp_path}", "t", ".bits") as (out, uri):
        w = bitpack.BlockWriter(out, bits, 64)
        for k, d in enumerate(docs):
            w.add(k if k != 3 else None, d)
        w.close()
    with bitpack.random_access(uri) as f:
        r = bitpack.BlockReader(f)
        assert all((r.document(k) == d).all() for k, d in enumerate(docs))
        assert r.nulls.tolist() == [k == 3 for k in range(len(docs))]
        everything = np.concatenate(docs)
        for a, b in [(0, 0), (63, 65), (100, 1200), (0, len(everything))]:
            assert (r.tokens(a, b) == everything[a:b]).all()


def test_token_files_in_order(spark, odd_docs, library):
    got = sorted(map(tuple, bitpack.op9(spark, odd_docs, PATH).collect()), key=lambda r: r[1])
    start, seen = 0, []
    for doc_id, at, n, crc in got:
        assert at == start
        start += n
        seen.append((doc_id, n, crc))
    ids = [r[0] for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    want = []
    for r in odd_docs.collect():
        a = np.array([*ids_of(library, r.text), 1], "<u4")
        want.append((r.doc_id, len(a), zlib.crc32(a.tobytes())))
    assert sorted(seen, key=str) == sorted(want, key=str)


def padding(bounds, lengths, counts):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in zip(lengths, counts))


def test_boundaries_are_optimal():
    rng = np.random.default_rng(1)
    for _ in range(100):
        n, k = int(rng.integers(1, 9)), int(rng.integers(1, 6))
        lengths = np.sort(rng.choice(np.arange(1, 60), n, replace=False))
        counts = rng.integers(1, 20, n)
        bounds = packing.optimal_boundaries(lengths, counts, k)
        best = min(padding([*s, lengths[-1]], lengths, counts)
                   for m in range(k) for s in itertools.combinations(lengths[:-1], min(m, n - 1)))
        assert len(bounds) <= k and padding(bounds, lengths, counts) == best


def test_batches(spark, odd_docs, library):
    lengths = [int(x) for x in np.random.default_rng(2).geometric(0.05, 500)] + [0, 0, 5000]
    table = spark.createDataFrame([(k // 2, n) for k, n in enumerate(lengths)], "doc_id long, n_tokens long")
    rows = packing.pack(table, buckets=4, token_budget=256, rows_per_shard=40).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(lengths)
    batches = {}
    for r in rows:
        if r.n_tokens == 0:
            assert (r.bucket_len, r.batch_id, r.position) == (0, None, None)
        else:
            assert r.n_tokens <= r.bucket_len
            batches.setdefault((r.bucket_len, r.batch_id), []).append(r.position)
    assert len({b for _, b in batches}) == len(batches)
    short = {}
    for (length, _), places in batches.items():
        size = max(1, 256 // length)
        assert sorted(places) == list(range(len(places))) and len(places) <= size
        short[length] = short.get(length, 0) + (len(places) < size)
    assert max(short.values()) <= 1  # only the last batch of a bucket
    found = {(r.doc_id, r.n_tokens) for r in packing.op1(odd_docs, PATH).collect()}
    assert found == {(r.doc_id, len(ids_of(library, r.text))) for r in odd_docs.collect()}


def test_word_counts_add_up_over_flushes(spark, odd_docs):
    whole = {tuple(r) for r in bpe.word_counts(odd_docs, PATH).collect()}
    assert {tuple(r) for r in bpe.word_counts(odd_docs, PATH, flush=0).collect()} == whole
    assert dict(whole)["cat"] == 8000


def test_long_words_merge_like_the_library():
    import random
    import time

    from cardlens.llm.bpe import LONG_WORD, Merges
    from tokenizers import Tokenizer
    library, own = Tokenizer.from_file(PATH), Merges(PATH)
    rng = random.Random(0)
    words = ["a" * 300, "the" * 200, "ab" * 400 + "a"]
    words += ["".join(rng.choice("etaoinshr") for _ in range(n)) for n in (LONG_WORD, LONG_WORD + 1, 900, 4000)]
    for word, ids in zip(words, own.merge([w.encode() for w in words])):
        assert ids.tolist() == library.encode(word, add_special_tokens=False).ids
    began = time.process_time()
    assert len(own.merge([b"a" * 1_000_000])[0]) == 125_001
    assert time.process_time() - began < 15  # one pass over the word per merge would take many minutes


def test_tokens_are_counted_by_slices(spark, monkeypatch):
    texts = pa.RecordBatch.from_pydict({"doc_id": list(range(30)), "text": ["some words " * 20_000] * 30})
    sizes = []

    class Counter:
        def counts(self, column):
            sizes.append(column.nbytes)
            return np.full(len(column), 7)

    docs = spark.range(1).selectExpr("id as doc_id", "'x' as text")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: list(run(iter([texts]))))
    monkeypatch.setattr(packing, "chunk_encoder", lambda path: Counter())
    out = packing.token_lengths(docs, "")
    assert [i for b in out for i in b.column("doc_id").to_pylist()] == list(range(30)) and max(sizes) < 2 << 20
