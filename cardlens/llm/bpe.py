"""BPE encoding and decoding over a transducer lexicon (operator 4).

Frequent words are compiled with their ids into a minimal acyclic transducer:
an automaton whose states share suffixes, whose transitions carry partial
word numbers that add up to the number of the accepted word, and whose output
table gives the ids of that number.  Workers memory-map it.  A word that it
does not hold is merged exactly, by rank, together with the other unseen
words of the slice.

Encoding equals the ``tokenizers`` library on the same file (no added special
tokens, no truncation or padding), decoding its ``decode`` without skipping
special tokens.  Null or empty texts give no ids and decode to ''; repeated
rows give repeated results; an empty table gives no rows; other columns are
ignored, whatever their names.  Texts and words of any length are encoded
whole; words of more than ``LONG_WORD`` bytes are merged one at a time.  The
lexicon holds words of plain characters (``tokens.PLAIN``) of fewer than 64
bytes; all others are merged when they are met, with equal ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import tempfile
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import AT_END, SLICE_BYTES, IntTable, arrow_map, materialize, slices, split_words
from .tokens import ChunkEncoder, byte_alphabet, load

#: Longer words (in bytes) are merged one at a time, in n log n steps.
LONG_WORD = 256


class Merges:
    """The merge rules of a tokenizers JSON file, applied to many words at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.size = max(vocab.values()) + 1
        letters = byte_alphabet()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + end] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.ranks = IntTable(keys, np.arange(len(keys)))
        self.parts = [(vocab[a], vocab[b]) for a, b in pairs]
        self.rank_of: dict[int, int] = {}
        born: dict[int, int] = {}  # token -> the first rule that makes it
        for r, (key, made) in enumerate(zip(keys.tolist(), self.made.tolist())):
            self.rank_of.setdefault(key, r)
            born.setdefault(made, r)
        self.ordered = all(born.get(t, -1) < r for r, p in enumerate(self.parts) for t in p)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each (non-empty) word: the pair of lowest rank, leftmost
        first, is merged until no rule applies."""
        out: list = [None] * len(words)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lens, kind="stable")
        ends = np.searchsorted(lens[order], np.unique(lens), "right").tolist()
        start = 0
        for end in ends:  # words of one length at a time
            rows = order[start:end]
            start = end
            size = int(lens[rows[0]])
            if size > LONG_WORD and self.ordered:
                for i in rows.tolist():
                    out[i] = self.run_long(words[i])
                continue
            step = max(1, (1 << 20) // size)
            for k in range(0, len(rows), step):
                part = rows[k:k + step]
                raw = np.frombuffer(b"".join([words[i] for i in part.tolist()]), np.uint8).reshape(-1, size)
                x = self.inner[raw]
                x[:, -1] = self.final[raw[:, -1]]
                self.run(x, part, out)
        return out

    def run_long(self, word: bytes) -> np.ndarray:
        """One long word: rules are applied in order of rank, each at all its
        places from left to right, over a linked list of what is left.

        A rule's product takes part in later rules only (``ordered``), so no
        place of an earlier rule turns up once its turn is over."""
        x = self.inner[np.frombuffer(word, np.uint8)]
        x[-1] = self.final[word[-1]]
        ranks = self.ranks.get(x[:-1] * self.size + x[1:])
        order = np.argsort(ranks, kind="stable")
        found, first = np.unique(ranks[order], return_index=True)
        places = {r: at.tolist() for r, at in zip(found.tolist(), np.split(order, first[1:]))}
        places.pop(int(IntTable.MISSING), None)
        n, size, rank_of, x = len(x), self.size, self.rank_of, x.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = list(places)
        heapq.heapify(queue)
        while queue:
            r = heapq.heappop(queue)
            a, b, new = *self.parts[r], int(self.made[r])
            for i in sorted(places.pop(r)):
                j = after[i]
                if x[i] != a or j >= n or x[j] != b:
                    continue  # one of the two is part of another token by now
                x[i], x[j] = new, -1
                after[i] = k = after[j]
                h = before[i]
                if k < n:
                    before[k] = i
                for at, key in ((h, x[h] * size + new if h >= 0 else -1), (i, new * size + x[k] if k < n else -1)):
                    q = rank_of.get(key)
                    if q is not None:
                        if q not in places:
                            places[q] = []
                            heapq.heappush(queue, q)
                        places[q].append(at)
        return np.array([t for t in x if t >= 0], np.int64)

    def run(self, x: np.ndarray, rows: np.ndarray, out: list) -> None:
        while len(rows):
            if x.shape[1] > 1:
                ranks = self.ranks.get((x[:, :-1] * self.size + x[:, 1:]).ravel()).reshape(len(x), -1)
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(x)), at]
                done = best == IntTable.MISSING
            else:
                done = np.ones(len(x), bool)
            if done.any():
                for i, ids in zip(rows[done].tolist(), x[done]):
                    out[i] = ids
                keep = ~done
                if not keep.any():
                    return
                x, rows, at, best = x[keep], rows[keep], at[keep], best[keep]
            here = np.arange(len(x))
            x[here, at] = self.made[best]
            left = np.ones(x.shape, bool)
            left[here, at + 1] = False
            x = x[left].reshape(len(x), -1)


def compile_lexicon(words: list[bytes], ids: list) -> bytes:
    """The minimal acyclic transducer of ``words`` (sorted, distinct) with
    ``ids[k]`` as the output of word k, as one block of bytes.

    Words are added in order; whatever cannot change any more is replaced by
    an equal registered state, so the automaton is minimal at every step."""
    register: dict = {}
    frozen: list = []  # (final, ((byte, state), ...)) by state number

    def freeze(final: bool, edges: list) -> int:
        key = (final, tuple(edges))
        if key not in register:
            register[key] = len(frozen)
            frozen.append(key)
        return register[key]

    path: list = [[False, []]]  # open states of the last word: [final, edges]

    def close(depth: int, last: bytes) -> None:
        while len(path) - 1 > depth:
            final, edges = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(final, edges)))

    last = b""
    for w in words:
        common = len(os.path.commonprefix([w, last]))
        close(common, last)
        path.extend([False, []] for _ in w[common:])
        path[-1][0] = True
        last = w
    close(0, last)
    root = freeze(*path[0])

    below = np.zeros(len(frozen), np.int64)  # words accepted from each state
    keys, targets, adds = [], [], []
    for s, (final, edges) in enumerate(frozen):  # targets have smaller numbers
        n = int(final)
        for byte, t in edges:
            keys.append(s * 256 + byte)
            targets.append(t)
            adds.append(n)
            n += int(below[t])
        below[s] = n
    lens = np.fromiter(map(len, ids), np.int64, len(ids))
    parts = [np.array([root, len(frozen), len(keys), len(words), int(lens.sum())], "<i8"),
             np.array(keys, "<i8"), np.array(targets, "<i8"), np.array(adds, "<i8"),
             np.array([f for f, _ in frozen], "<i8"), np.concatenate(([0], np.cumsum(lens))).astype("<i8"),
             np.concatenate([np.asarray(i, "<i8") for i in ids]) if len(ids) else np.empty(0, "<i8")]
    return b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled lexicon over a buffer of 64-bit integers (a memory map)."""

    def __init__(self, data: np.ndarray):
        self.root, states, edges, words, total = data[:5].tolist()
        at = 5
        for name, n in (("keys", edges), ("targets", edges), ("adds", edges), ("finals", states),
                        ("offsets", words + 1), ("ids", total)):
            setattr(self, name, data[at:at + n])
            at += n

    @classmethod
    def mapped(cls, data: bytes) -> Lexicon:
        """Memory-map a private file that is unlinked at once: the pages are
        shared with the page cache and nothing is left on the disk."""
        with tempfile.NamedTemporaryFile(suffix=".lexicon") as f:
            f.write(data)
            f.flush()
            return cls(np.memmap(f.name, "<i8", "r"))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 if the lexicon does not hold it; all words
        walk the automaton together, one byte a step."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        first = np.cumsum(lens) - lens
        state, number = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        live = np.arange(len(words)) if len(self.keys) else np.empty(0, np.int64)
        dead = np.ones(len(words), bool)
        dead[live] = False
        step = 0
        while len(live):
            live = live[lens[live] > step]
            key = state[live] * 256 + raw[first[live] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            dead[live[~hit]] = True
            live, at = live[hit], at[hit]
            state[live] = self.targets[at]
            number[live] += self.adds[at]
            step += 1
        ok = ~dead
        ok[ok] = self.finals[state[ok]] == 1
        return np.where(ok, number, -1)

    def output(self, number: int) -> np.ndarray:
        return self.ids[self.offsets[number]:self.offsets[number + 1]]


class LexiconEncoder(ChunkEncoder):
    """Chunks to ids by the lexicon, unseen words by exact merging."""

    def __init__(self, path: str, lexicon: Lexicon, limit: int = 150_000):
        super().__init__(path, limit)
        self.lexicon, self.merges = lexicon, merges(path)
        self.bytes_of = {c: b for b, c in enumerate(byte_alphabet())}
        special = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in special.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")

    def pieces(self, chunk: bytes) -> list:
        """An odd chunk as words (bytes) and ids of special tokens, normalised
        and split by the file's own rules."""
        out: list = []
        for k, part in enumerate(self.cut.split(chunk.decode("utf-8"))):
            if k % 2:
                out.append(self.special[part])
            elif part:
                text = self.tokenizer.normalizer.normalize_str(part)
                out += [bytes(map(self.bytes_of.__getitem__, p))
                        for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return out

    def resolve(self, words: list) -> list:
        split = [self.pieces(w) if isinstance(w, bytes) else (w.encode("utf-8"),) for w in words]
        plain = [p for parts in split for p in parts if isinstance(p, bytes)]
        number = self.lexicon.numbers(plain)
        unseen = np.flatnonzero(number < 0)
        merged = iter(self.merges.merge([plain[i] for i in unseen.tolist()]))
        ids = iter([next(merged) if k < 0 else self.lexicon.output(k) for k in number.tolist()])
        return [[i for p in parts for i in ((p,) if isinstance(p, int) else next(ids).tolist())]
                for parts in split]


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


_ENCODERS: dict = {}


def lexicon_encoder(path: str, lexicon) -> LexiconEncoder:
    """This worker's encoder over a broadcast lexicon."""
    key = (path, lexicon.id if hasattr(lexicon, "id") else id(lexicon))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = LexiconEncoder(path, Lexicon.mapped(lexicon.value))
        AT_END.append(_ENCODERS[key].clear)
    return _ENCODERS[key]


def word_counts(docs: DataFrame, tokenizer: str, text: str = "text", flush: int = 150_000) -> DataFrame:
    """(word, n): how often each word of the tokenizer's pre-tokenisation
    occurs in all texts.  Tasks add up what they read before the shuffle."""

    def run(batches):
        encoder, counts = ChunkEncoder(tokenizer), Counter()

        def rows():
            got = {"word": pa.array(counts, pa.string()), "n": pa.array(counts.values(), pa.int64())}
            counts.clear()
            return pa.RecordBatch.from_pydict(got)

        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                _, number, distinct = split_words(part.column(text))
                for chunk, n in zip(distinct, np.bincount(number, minlength=len(distinct)).tolist()):
                    for w in encoder.parts(chunk):
                        if isinstance(w, str):
                            counts[w] += n
                if len(counts) > flush:
                    yield rows()
        yield rows()

    return (docs.select(text).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def build_lexicon(docs: DataFrame, tokenizer: str, size: int = 65_536, min_count: int = 2,
                  text: str = "text") -> bytes:
    """The most frequent words of ``docs`` with their ids, compiled: all words
    above the smallest count that leaves at most ``size`` of them.  ``size``
    bounds the lexicon and what reaches the driver, not the result: other
    words are merged."""
    counted = materialize(word_counts(docs, tokenizer, text)
                          .where((F.length("word") < 64) & (F.col("n") >= min_count)), "word-counts")
    # counts are few: k different ones need k * (k + 1) / 2 words
    held, least = 0, None
    for r in counted.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).toLocalIterator():
        held += r.words
        if held > size:
            break
        least = r.n
    top = counted.where(F.col("n") >= least).collect() if least else []
    words = sorted(r.word.encode("utf-8") for r in top)
    return compile_lexicon(words, merges(tokenizer).merge(words))


def encode(docs: DataFrame, tokenizer: str, lexicon: bytes, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian uint32 in a binary column."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batch: pa.RecordBatch) -> dict:
        ids, counts = lexicon_encoder(tokenizer, shared).encode(batch.column(text))
        offs = np.concatenate(([0], np.cumsum(counts) * 4)).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), len(counts),
                                       [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(ids.tobytes())])
        return {"doc_id": batch.column("doc_id"), "n_tokens": counts, "ids": packed}

    return arrow_map(docs.select(F.col("doc_id").cast("long"), text), run,
                     "doc_id long, n_tokens long, ids binary", text)


@lru_cache(maxsize=2)
def token_texts(path: str) -> list[str]:
    t = load(path)[0]
    return [t.id_to_token(i) or "" for i in range(t.get_vocab_size(with_added_tokens=True))]


def decode(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, decoded): the file names no decoder, so token strings are
    joined by single spaces."""

    def run(batch: pa.RecordBatch) -> dict:
        table = token_texts(tokenizer)
        return {"doc_id": batch.column("doc_id"),
                "decoded": [" ".join([table[i] for i in np.frombuffer(x, "<u4").tolist()])
                            for x in batch.column("ids").to_pylist()]}

    return arrow_map(tokens.select("doc_id", "ids"), run, "doc_id long, decoded string", "ids")


def digests(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded documents."""

    def run(batch: pa.RecordBatch) -> dict:
        table, numerals = token_texts(tokenizer), decimals(tokenizer)
        ids_hash, text_hash = [], []
        for x in batch.column("ids").to_pylist():
            ids = np.frombuffer(x, "<u4").tolist()
            ids_hash.append(hashlib.sha256(" ".join([numerals[i] for i in ids]).encode()).hexdigest())
            text_hash.append(hashlib.sha256(" ".join([table[i] for i in ids]).encode()).hexdigest())
        return {"doc_id": batch.column("doc_id"), "n_tokens": batch.column("n_tokens"),
                "ids_sha256": ids_hash, "decoded_sha256": text_hash}

    return arrow_map(tokens, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", "ids")


@lru_cache(maxsize=2)
def decimals(path: str) -> list[str]:
    return list(map(str, range(len(token_texts(path)))))
