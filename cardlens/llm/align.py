"""Alignment of two tokenizers' ids over the same texts (operator 11).

A is a byte-level BPE (``tokenizers`` file) over space + text, B a piece BPE
(``sentencepiece`` file) that puts the space there itself.  Both spell the
text's bytes; the offsets where a token of each ends cut them into groups, and
the two tokens that end a group are linked.

``same_ids`` is the identity map: A id -> the B id of the same bytes.  A group
of one A token and the B token that the map names needs no pair: it is counted
in a vector as long as A's vocabulary.  Only the links of the other groups are
shuffled as pairs, once per block of documents and pair.

No token of either kind reaches across a place where a space follows something
that is no white space, so texts are cut there and each distinct chunk is
encoded and aligned once (``Aligner``; its memory is bounded and lasts for a
task).  A text with a chunk whose tokens do not spell it is encoded whole.

A null or empty text, or one that its tokens do not spell, has no tokens: all
its counts are 0 and its digest is ''.  Very long texts and words are aligned
whole, a document is never split between blocks.  Rows without doc_id and
repeated rows are rows like others and count like others; an empty table gives
no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import AT_END, arrow_map, materialize, ragged, release
from .tokens import PLAIN, byte_alphabet, row_sums

#: A space after something that is no white space.
CUT = re.compile(r"(?<=\S)(?= )")
# The pre-tokenizer of byte-level BPE files.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Chunks of characters that are the same in every Unicode version.
PLAIN_CHUNK = re.compile(f"(?:{PLAIN.pattern}|[ \n\r\t])+")
BLOCK_SCHEMA = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
                "groups_sha256 array<string>, same binary, same_n binary, same_docs binary, "
                "pairs binary, pairs_n binary, pairs_docs binary")


@lru_cache(maxsize=2)
def load_a(path: str):
    """(tokenizer, bytes of each id) of a byte-level BPE file."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    value = {c: b for b, c in enumerate(byte_alphabet())}
    spelled = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for piece, k in tokenizer.get_vocab(with_added_tokens=False).items():
        spelled[k] = bytes(map(value.__getitem__, piece))
    return tokenizer, spelled


@lru_cache(maxsize=2)
def load_b(path: str):
    """(processor, bytes of each id) of a sentencepiece file; control pieces spell nothing."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled = []
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            spelled.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(k) or model.is_unknown(k):
            spelled.append(b"")
        else:
            spelled.append(piece.replace("▁", " ").encode())
    return model, spelled


def same_ids(spelled_a: list[bytes], spelled_b: list[bytes], byte_ids: set[int] = frozenset()) -> np.ndarray:
    """A id -> the B id of the same bytes, -1 for none; of several the one
    that is not a byte's fallback, then the smallest."""
    found: dict[bytes, int] = {}
    for k in sorted(range(len(spelled_b)), key=lambda k: (k in byte_ids, k)):
        if spelled_b[k]:
            found.setdefault(spelled_b[k], k)
    return np.array([found.get(s, -1) if s else -1 for s in spelled_a], np.int32)


class Aligner:
    """Texts -> their tokens' numbers, groups and links.

    A plain chunk is cut by the pre-tokenizer's pattern and its words, each
    distinct one once, go to the library's model; any other chunk goes to the
    whole tokenizer.  ``limit`` chunks or ``limit_chars`` characters of chunks are remembered."""

    def __init__(self, path_a: str, path_b: str, limit: int = 500_000, limit_chars: int = 32 << 20):
        self.tokenizer, self.spelled_a = load_a(path_a)
        self.model, self.spelled_b = load_b(path_b)
        self.size_a, self.size_b = list(map(len, self.spelled_a)), list(map(len, self.spelled_b))
        self.same = same_ids(self.spelled_a, self.spelled_b,
                             {k for k in range(len(self.spelled_b)) if self.model.is_byte(k)})
        self.known = self.same.tolist()
        self.width = len(self.spelled_b)
        self.space = self.model.piece_to_id("▁")
        self.alphabet = dict(enumerate(byte_alphabet()))
        self.pattern = regex.compile(WORDS)
        self.limit, self.limit_chars = limit, limit_chars
        self.clear()

    def clear(self) -> None:
        self.chunks: dict[str, int] = {}
        self.words: dict[str, list[int]] = {}
        self.chars = 0
        self.unspelled = False  # is there a chunk that its tokens do not spell?
        self.text: list[bytes | None] = []  # groups of each chunk as text, None where it is not spelled
        self.a, self.b, self.groups = array("i"), array("i"), array("i")
        self.same_n, self.pairs_n = array("i"), array("i")
        self.same_ids, self.pairs = array("i"), array("q")

    def word(self, word: str) -> list[int]:
        """A ids of a word of the pre-tokenizer."""
        ids = self.words.get(word)
        if ids is None:
            spelled = word.encode().decode("latin-1").translate(self.alphabet)
            ids = self.words[word] = [t.id for t in self.tokenizer.model.tokenize(spelled)]
        return ids

    def ids_a(self, chunk: str) -> list[int]:
        if not PLAIN_CHUNK.fullmatch(chunk):
            return self.tokenizer.encode(chunk, add_special_tokens=False).ids
        words = self.pattern.findall(chunk)
        return self.word(words[0]) if len(words) == 1 else [k for w in words for k in self.word(w)]

    def spelled(self, chunk: str, a: list[int], b: list[int]) -> bool:
        data = chunk.encode()
        return (b"".join(map(self.spelled_a.__getitem__, a)) == data
                and b"".join(map(self.spelled_b.__getitem__, b)) == data)

    def add(self, chunk: str, a: list[int], b: list[int]) -> int:
        """A new entry: the runs of A and of B between the offsets where both
        have a token's end.  Returns its number."""
        # both vocabularies spell printable ASCII as it is
        if not (chunk.isascii() and chunk.isprintable()) and not self.spelled(chunk, a, b):
            a, b, self.unspelled = [], [], True
        size_a, size_b, known = self.size_a, self.size_b, self.known
        parts, same = [], 0
        first_a = first_b = j = at_a = at_b = 0
        for i, k in enumerate(a, 1):
            at_a += size_a[k]
            while at_b < at_a:
                at_b += size_b[b[j]]
                j += 1
            if at_a == at_b:
                if i - first_a == 1 == j - first_b:
                    y = b[first_b]
                    parts.append(f"{k}|{y}")
                    if known[k] == y:
                        self.same_ids.append(k)
                        same += 1
                        first_a, first_b = i, j
                        continue
                else:
                    parts.append(",".join(map(str, a[first_a:i])) + "|" + ",".join(map(str, b[first_b:j])))
                self.pairs.append(k * self.width + b[j - 1])
                first_a, first_b = i, j
        self.text.append(";".join(parts).encode() if a else None)
        self.a.append(len(a))
        self.b.append(len(b))
        self.groups.append(len(parts))
        self.same_n.append(same)
        self.pairs_n.append(len(parts) - same)
        self.chars += len(chunk)
        return len(self.text) - 1

    def learn(self, chunks: list[str]) -> None:
        """Entries of new chunks."""
        wanted = self.model.encode([c[1:] for c in chunks], num_threads=1) if chunks else []
        for chunk, b in zip(chunks, wanted):
            self.chunks[chunk] = self.add(chunk, self.ids_a(chunk), [self.space] if chunk == " " else b)

    def whole(self, text: str) -> list[int]:
        """The entry of a text that holds a chunk which its tokens do not spell."""
        chunk = " " + text
        return [self.add(chunk, self.tokenizer.encode(chunk, add_special_tokens=False).ids, self.model.encode(text))]

    def picks(self, texts: list[str | None]) -> list[list[int]]:
        """Numbers of the chunks of space + text, by text."""
        cut = [CUT.split(" " + t) if t else [] for t in texts]
        found = self.chunks
        self.learn(list({c for chunks in cut for c in chunks if c not in found}))
        out = [[found[c] for c in chunks] for chunks in cut]
        if self.unspelled:
            out = [self.whole(t) if any(self.text[k] is None for k in p) else p for t, p in zip(texts, out)]
        return out

    def block(self, texts: list[str | None]) -> dict:
        """The columns of a block of documents, but for its number and ids."""
        if len(self.chunks) > self.limit or self.chars > self.limit_chars:
            self.clear()
        picks = self.picks(texts)
        counts = np.array([len(p) for p in picks], np.int64)
        pick = np.fromiter(chain.from_iterable(picks), np.int64, int(counts.sum()))
        digests = []
        for p in picks:
            whole = b";".join([self.text[k] or b"" for k in p])  # None: a whole text that is not spelled
            digests.append(hashlib.sha256(whole).hexdigest() if whole else "")
        out = {"groups_sha256": digests}
        for name, column in (("n_a", self.a), ("n_b", self.b), ("n_groups", self.groups)):
            out[name] = row_sums(np.array(column, np.int64)[pick], counts) if len(pick) else counts
        doc = np.repeat(np.arange(len(counts), dtype=np.int64), counts)
        for name, flat, number in (("same", self.same_ids, self.same_n), ("pairs", self.pairs, self.pairs_n)):
            number = np.array(number, np.int64)
            first = np.cumsum(number) - number
            links = np.array(flat, np.int64)[ragged(first[pick], number[pick])] if len(pick) else np.empty(0, np.int64)
            keys, docs, n = distinct_by_doc(links, np.repeat(doc, number[pick]))
            out[name] = keys.astype("<i8" if name == "pairs" else "<u4").tobytes()
            out[f"{name}_n"] = n.astype("<u4").tobytes()
            out[f"{name}_docs"] = np.bincount(docs, minlength=len(counts)).astype("<u4").tobytes()
        return out


def distinct_by_doc(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, key) in order of both: keys, docs, number of each."""
    order = np.lexsort((keys, docs))
    keys, docs = keys[order], docs[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    at = np.flatnonzero(new)
    return keys[at], docs[at], np.diff(at, append=len(keys))


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    found = Aligner(path_a, path_b)
    AT_END.append(found.clear)
    return found


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Encode and align ``docs`` (doc_id, text): one row per block of documents
    (a few MB of text) with the documents' results as arrays and their distinct
    links with counts, packed; stored."""
    number = [0]

    def run(batch: pa.RecordBatch) -> dict:
        from pyspark import TaskContext
        got = aligner(path_a, path_b).block(batch.column("text").to_pylist())
        row = {name: [value] for name, value in got.items()}
        row["block"] = [(TaskContext.get().partitionId() << 32) + number[0]]
        row["doc_id"] = [batch.column("doc_id").to_pylist()]
        number[0] += 1
        return row

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(arrow_map(rows, run, BLOCK_SCHEMA, "text"), "aligned")


def identity_counts(blocks: DataFrame, size: int) -> np.ndarray:
    """Links of the identity map by A id: a vector of the vocabulary's length
    is filled in every task, and their entries are added up."""

    def fill(batches):
        vector = np.zeros(size, np.int64)
        for batch in batches:
            for ids, n in zip(batch.column("same").to_pylist(), batch.column("same_n").to_pylist()):
                vector += np.bincount(np.frombuffer(ids, "<u4"), np.frombuffer(n, "<u4"), size).astype(np.int64)
        used = np.flatnonzero(vector)
        yield pa.RecordBatch.from_pydict({"a": pa.array(used, pa.int64()), "n": pa.array(vector[used], pa.int64())})
        release()

    out = np.zeros(size, np.int64)
    found = blocks.select("same", "same_n").mapInArrow(fill, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))
    for a, n in found.collect():  # at most one row per A id
        out[a] = n
    return out


def irregular_pairs(blocks: DataFrame) -> DataFrame:
    """(block, pair, n): the links beside the identity map, one row per block
    and pair."""

    def run(batches):
        for batch in batches:
            for block, keys, n in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "pairs_n"))):
                pair, place = np.unique(np.frombuffer(keys, "<i8"), return_inverse=True)
                total = np.bincount(place, np.frombuffer(n, "<u4"), len(pair)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"block": pa.array(np.full(len(pair), block), pa.int64()),
                                                  "pair": pa.array(pair, pa.int64()), "n": pa.array(total)})
        release()

    return blocks.select("block", "pairs", "pairs_n").mapInArrow(run, "block long, pair long, n long")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count) of the links beside the identity map; ``pair`` is A id *
    (number of B ids) + B id.  Stored."""
    return materialize(irregular_pairs(blocks).groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")


def best_counts(pairs: DataFrame, identity: np.ndarray, same: np.ndarray, width: int) -> np.ndarray:
    """The highest count of a link by B id (one number per B id)."""
    best = np.zeros(width, np.int64)
    known = np.flatnonzero(same >= 0)
    np.maximum.at(best, same[known], identity[known])
    for b, n in pairs.groupBy(F.pmod("pair", F.lit(width)).alias("b")).agg(F.max("count")).collect():
        best[b] = max(best[b], n)
    return best


def op11(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The alignment of every document, with its links' counts."""
    same = aligner(path_a, path_b).same
    width = len(load_b(path_b)[1])
    blocks = align(docs, path_a, path_b)
    identity = identity_counts(blocks, len(same))
    pairs = pair_counts(blocks)
    best = best_counts(pairs, identity, same, width)
    is_best = (same >= 0) & (identity == best[np.maximum(same, 0)])

    # a pair has one row per block that holds it, however frequent it is
    found = (irregular_pairs(blocks).join(pairs, "pair").groupBy("block")
             .agg(F.collect_list(F.struct("pair", "count")).alias("found")))

    def finish(batches):
        for batch in batches:
            for r in batch.to_pylist():
                docs_n = len(r["doc_id"])
                same_docs = np.repeat(np.arange(docs_n), np.frombuffer(r["same_docs"], "<u4"))
                ids, n = np.frombuffer(r["same"], "<u4"), np.frombuffer(r["same_n"], "<u4").astype(np.int64)
                total = np.zeros(docs_n, np.int64)
                top = np.zeros(docs_n, np.int64)
                np.add.at(total, same_docs, n * identity[ids])
                np.add.at(top, same_docs, n * is_best[ids])
                if r["found"]:
                    table = np.array([(f["pair"], f["count"]) for f in r["found"]], np.int64)
                    table = table[np.argsort(table[:, 0])]
                    keys = np.frombuffer(r["pairs"], "<i8")
                    n = np.frombuffer(r["pairs_n"], "<u4").astype(np.int64)
                    count = table[np.searchsorted(table[:, 0], keys), 1]
                    pair_docs = np.repeat(np.arange(docs_n), np.frombuffer(r["pairs_docs"], "<u4"))
                    np.add.at(total, pair_docs, n * count)
                    np.add.at(top, pair_docs, n * (count == best[keys % width]))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(r["doc_id"], pa.int64()), "n_a": pa.array(r["n_a"], pa.int64()),
                    "n_b": pa.array(r["n_b"], pa.int64()), "n_groups": pa.array(r["n_groups"], pa.int64()),
                    "n_links": pa.array(r["n_groups"], pa.int64()), "n_best": pa.array(top),
                    "count_sum": pa.array(total), "groups_sha256": pa.array(r["groups_sha256"], pa.string())})
        release()

    return blocks.join(found, "block", "left").mapInArrow(
        finish, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                "groups_sha256 string")
