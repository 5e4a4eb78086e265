"""Token ids of whole texts with a public word BPE vocabulary.

``ChunkEncoder`` gives exactly the ids of the ``tokenizers`` library for the
``word_bpe`` file.  That tokenizer never looks across white space, so a text
is cut at ASCII white space and every distinct chunk is encoded once per
worker and remembered (bounded).  A chunk of common Latin characters is
lower-cased and cut into words by the file's own pattern, and each new word
goes to the library's BPE model; any other chunk (combining marks, other
scripts, control characters, special-token strings) goes to the library whole.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .common import AT_END, ragged, split_words

#: Characters for which lower-casing and NFC are plain in every Unicode
#: version: printable ASCII, Latin-1, Latin Extended A and B (without the
#: dotted capital I) and common punctuation.
PLAIN = re.compile("[\x21-\x7e\xa1-įı-ɏ‐-‧‰-⁞]+")


def byte_alphabet() -> list[str]:
    """Byte -> printable character: visible Latin-1 characters stand for
    themselves, the other bytes get the code points from 256 on in order."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


@lru_cache(maxsize=4)
def load(path: str):
    """(tokenizer, word pattern) of a tokenizers JSON file."""
    import json

    import regex
    from tokenizers import Tokenizer
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    return Tokenizer.from_file(path), regex.compile(split["pattern"]["Regex"])


class ChunkEncoder:
    """Texts -> flat ids and ids per text.

    Two tables grow as new chunks and words are met: a chunk is a run of word
    numbers, a word a run of ids.  New words are resolved together at the end
    of a call by ``resolve``; the tables start anew past ``limit`` chunks."""

    def __init__(self, path: str, limit: int = 250_000):
        self.tokenizer, self.pattern = load(path)
        self.model = self.tokenizer.model
        self.alphabet = dict(enumerate(byte_alphabet()))
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.word_lens, self.word_ids = array("i"), array("i")
        self.ids, self.first, self.number = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.new_lens, self.new_words = array("i"), array("i")  # of chunks not yet in the table
        self.fresh: list = []  # words (str) or odd chunks (bytes) to resolve, in order of number
        encoder, fresh = self, self.fresh

        class Words(dict):
            def __missing__(self, word):
                k = self[word] = len(self)
                fresh.append(word)
                return k

        words = self.words = Words()
        lens, flat = self.new_lens, self.new_words

        class Chunks(dict):
            def __missing__(self, chunk):
                k = self[chunk] = len(self)
                if chunk.isalpha():  # ASCII letters: the usual case
                    lens.append(1)
                    flat.append(words[chunk.lower().decode()])
                    return k
                parts = encoder.parts(chunk)
                lens.append(len(parts))
                flat.extend([words[p] for p in parts])
                return k

        self.chunks = Chunks()

    def parts(self, chunk: bytes):
        """The lower-cased words (str) of a plain chunk, or the odd chunk itself (bytes)."""
        text = chunk.decode("utf-8")
        if not PLAIN.fullmatch(text) or "<|" in text:
            return (chunk,)
        text = text.lower()
        if text.isalpha():
            return (text,)
        if text[:-1].isalpha() and text[-1] in ".,":
            return text[:-1], text[-1]
        return self.pattern.findall(text)

    def picks(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Chunk numbers of all texts, chunks per text."""
        if len(self.chunks) > self.limit:
            self.clear()
        counts, number, distinct = split_words(column)
        index = self.chunks
        got = list(map(index.get, distinct))
        if None in got:
            got = [index[c] if k is None else k for c, k in zip(distinct, got)]
        self.grow()
        return np.array(got, np.int32)[number], counts

    def resolve(self, words: list) -> list:
        """Ids of each word: by the library's model, odd chunks by the whole tokenizer."""
        model, out = self.model.tokenize, []
        for w in words:
            if isinstance(w, bytes):
                out.append(self.tokenizer.encode(w.decode("utf-8"), add_special_tokens=False).ids)
                continue
            if not w.isascii():
                w = self.to_alphabet(w)
            out.append([t.id for t in model(w)])
        return out

    def to_alphabet(self, word: str) -> str:
        return word.encode("utf-8").decode("latin-1").translate(self.alphabet)

    def grow(self) -> None:
        """Resolve the new words and append the new chunks' ids to the table."""
        if self.fresh:
            for ids in self.resolve(self.fresh):
                self.word_lens.append(len(ids))
                self.word_ids.extend(ids)
            self.fresh.clear()
        if not self.new_lens:
            return
        wl = np.array(self.word_lens, np.int64)
        words = np.array(self.new_words, np.int64)
        per_word = wl[words]
        ids = np.array(self.word_ids, np.uint32)[ragged((np.cumsum(wl) - wl)[words], per_word)]
        number = row_sums(per_word, np.array(self.new_lens, np.int64))
        first = np.cumsum(number) - number + len(self.ids)
        self.ids = np.concatenate((self.ids, ids))
        self.first = np.concatenate((self.first, first))
        self.number = np.concatenate((self.number, number))
        del self.new_lens[:], self.new_words[:]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order as uint32, number of ids per text); a
        null text counts as empty."""
        pick, counts = self.picks(column)
        if not len(pick):
            return np.empty(0, np.uint32), np.zeros(len(counts), np.int64)
        lens = self.number[pick]
        return self.ids[ragged(self.first[pick], lens)], row_sums(lens, counts)

    def counts(self, column: pa.Array) -> np.ndarray:
        """Number of ids per text."""
        pick, counts = self.picks(column)
        return row_sums(self.number[pick], counts) if len(pick) else np.zeros(len(counts), np.int64)


def row_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.concatenate(([0], np.cumsum(values)))
    return np.diff(ends[np.concatenate(([0], np.cumsum(counts)))])


@lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    """The encoder of this Python worker; its memory of chunks lasts for a task."""
    encoder = ChunkEncoder(path)
    AT_END.append(encoder.clear)
    return encoder


def vocabulary_size(path: str) -> int:
    return load(path)[0].get_vocab_size(with_added_tokens=True)
