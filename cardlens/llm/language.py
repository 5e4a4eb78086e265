"""Language ID by segmentation-marginalised unigrams (operator 8).

Each language has a probability for every piece of a fixed public vocabulary
(the pieces of a sentencepiece file).  The probability of a word is the sum
over all ways to cut it into pieces, by the forward algorithm; the score of a
text is the product over its words and the language's prior.  The piece
probabilities are learned by expectation-maximisation over all segmentations
(forward-backward) of the words of training documents.

Words are lower-cased runs of letters and the combining marks after them,
marked at their start; they may be in any script and of any length.  All pieces
of letters and marks that lower-casing keeps are used.  A character that is no
piece counts as the unknown piece.  A text without a letter (null
and empty ones too) is ``und`` with score 0; repeated rows get equal results;
without any labelled training row all texts with letters are ``und`` too.

Training covers all labelled documents: their words are counted once, and the
rounds run over the distinct words by language.  Very long texts are read whole, an empty table gives no rows, and columns of
the names of the results are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IntTable, arrow_extend, arrow_map, materialize, release, split_words

LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Pieces that lower-cased words can hold: of lower-case letters, and in any script.
LOWER = r"▁?\p{Ll}*"
ANY_SCRIPT = r"▁?(?:(?![\p{Lu}\p{Lt}])[\p{L}\p{M}])*"
START = "▁"
CODES = 0x110000
#: Positions between two rescalings of the forward values.
RESCALE = 16


class Trie:
    """The vocabulary as a character trie walked for many words at once."""

    def __init__(self, pieces: list[str]):
        nodes: dict[tuple[int, str], int] = {}
        ends: dict[int, int] = {}
        for k, piece in enumerate(pieces):
            at = 0
            for c in piece:
                at = nodes.setdefault((at, c), len(nodes) + 1)
            ends[at] = k
        self.unknown = len(pieces)
        self.piece = np.full(len(nodes) + 1, -1, np.int32)
        self.piece[list(ends)] = list(ends.values())
        self.next = IntTable(np.array([n * CODES + ord(c) for n, c in nodes], np.int64),
                             np.array(list(nodes.values())))

    def edges(self, x: np.ndarray) -> list[list[tuple]]:
        """Of words of one length (rows of code points): by start position,
        (rows, end position, pieces) for each piece length that occurs."""
        out = []
        for i in range(x.shape[1]):
            here, live, node = [], np.arange(len(x)), np.zeros(len(x), np.int64)
            covered = np.zeros(len(x), bool)  # the character alone is a piece
            for j in range(i, x.shape[1]):
                got = self.next.get(node * CODES + x[live, j])
                ok = got != IntTable.MISSING
                live, node = live[ok], got[ok].astype(np.int64)
                if not len(live):
                    break
                piece = self.piece[node]
                is_piece = piece >= 0
                if j == i:
                    covered[live[is_piece]] = True
                if is_piece.any():
                    here.append((live[is_piece], j + 1, piece[is_piece]))
            rest = np.flatnonzero(~covered)
            if len(rest):
                here.append((rest, i + 1, np.full(len(rest), self.unknown, np.int32)))
            out.append(here)
        return out


@lru_cache(maxsize=2)
def trie(path: str, letters: str = LOWER) -> Trie:
    """Pieces of ``letters`` (with or without the word mark) of a sentencepiece file."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return Trie([p for p in pieces if regex.fullmatch(letters, p) and p])


def by_length(words: list[str], limit: int):
    """(rows, code points of marked words) for words of equal length."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lens, kind="stable")
    bounds = np.flatnonzero(np.diff(lens[order], prepend=-1, append=-1))
    for a, b in zip(bounds, bounds[1:]):
        size = int(lens[order[a]]) + 1
        step = max(1, limit // size)
        for k in range(a, b, step):
            rows = order[k:min(k + step, b)]
            text = "".join([START + words[i] for i in rows.tolist()])
            yield rows, np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(-1, size).astype(np.int64)


def forward(edges: list, n: int, rows: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(forward values by position, log scale by block of ``RESCALE`` positions)
    for each row and, if ``p`` has them, language.  The last position has the
    last block's scale."""
    alpha = np.zeros((n + 1, rows, *p.shape[1:]))
    scale = np.zeros(((n - 1) // RESCALE + 1, rows, *p.shape[1:]))
    alpha[0] = 1.0
    far = 0  # the positions after it are zero
    for i, here in enumerate(edges):
        if i and i % RESCALE == 0:  # the recurrence is linear: all values of a row share a factor
            top = alpha[i:far + 1].max(axis=0)
            top[top == 0] = 1.0
            alpha[i:far + 1] /= top
            scale[i // RESCALE] = scale[i // RESCALE - 1] + np.log(top)
        for r, j, piece in here:
            alpha[j, r] += alpha[i, r] * p[piece]
            far = max(far, j)
    return alpha, scale


def log_likelihood(words: list[str], path: str, p: np.ndarray, letters: str = LOWER) -> np.ndarray:
    """log of the summed probability of all segmentations, by word and language."""
    out = np.zeros((len(words), p.shape[1]))
    for rows, x in by_length(words, 1 << 17):
        alpha, scale = forward(trie(path, letters).edges(x), x.shape[1], len(rows), p)
        out[rows] = np.log(alpha[-1]) + scale[-1]
    return out


def expected_counts(words: list[str], counts: np.ndarray, path: str, p: np.ndarray,
                    letters: str = LOWER) -> np.ndarray:
    """Expected uses of each piece by language over all segmentations of the
    words, each weighted by its count in the language."""
    at, lang = np.nonzero(counts)
    return pair_counts([words[i] for i in at.tolist()], lang, counts[at, lang], path, p, letters)


def pair_counts(words: list[str], lang: np.ndarray, counts: np.ndarray, path: str, p: np.ndarray,
                letters: str = LOWER) -> np.ndarray:
    """``expected_counts`` of words that each count in one language, ``lang``.

    Goes back from the end of a word: ``share`` is the probability that a
    segmentation cuts at a position, which its last piece passes on to the
    piece's start.  Only quotients of forward values occur, so words may be
    long."""
    flat, langs = p.ravel(), p.shape[1]
    total = np.zeros(p.size)
    for rows, x in by_length(words, 1 << 18):
        own, n = lang[rows], x.shape[1]
        edges = [[(r, j, piece * langs + own[r]) for r, j, piece in here] for here in trie(path, letters).edges(x)]
        alpha, scale = forward(edges, n, len(rows), flat)
        share, places, uses = np.zeros_like(alpha), [], []
        share[n] = counts[rows]
        share[n] /= np.maximum(alpha[n], 1e-300)
        for i in reversed(range(n)):
            for r, j, place in edges[i]:
                use = flat[place] * share[j, r]
                use *= alpha[i, r]
                block, end = i // RESCALE, min(j, n - 1) // RESCALE
                if block != end:
                    use *= np.exp(scale[block, r] - scale[end, r])
                share[i, r] += use
                places.append(place)
                uses.append(use)
            share[i] /= np.maximum(alpha[i], 1e-300)
        # once for all positions: a count by place is as long as the vocabulary times the languages
        total += np.bincount(np.concatenate(places), np.concatenate(uses), p.size)
    return total.reshape(p.shape)


@dataclass
class Model:
    langs: list[str]
    prior: np.ndarray  # log, by language
    pieces: np.ndarray  # probability by piece and language


def doc_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Chunks of texts and their letter runs: (chunks per text, chunk numbers,
    distinct words, word numbers of all distinct chunks in order, words per chunk)."""
    counts, number, distinct = split_words(column, lower=True)
    index: dict[str, int] = {}
    flat, per_chunk = [], np.zeros(len(distinct), np.int64)
    for k, chunk in enumerate(distinct):
        if chunk.isalpha():
            flat.append(index.setdefault(chunk.decode(), len(index)))
            per_chunk[k] = 1
        else:
            found = LETTERS.findall(chunk.decode("utf-8").lower())
            flat += [index.setdefault(w, len(index)) for w in found]
            per_chunk[k] = len(found)
    return counts, number, list(index), np.array(flat, np.int64), per_chunk


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of ``values``, ``counts`` values each."""
    return np.bincount(np.repeat(np.arange(len(counts)), counts), values, len(counts))


def joined(batches: Iterator[pa.RecordBatch], rows: int = 40_000, limit: int = 1 << 20) -> Iterator[pa.Table]:
    """Runs of whole batches, each as one table: the last batch of a run is the
    one that reaches ``rows`` rows or ``limit`` bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows or sum(b.nbytes for b in held) >= limit:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def train(labelled: DataFrame, path: str, rounds: int = 3, smoothing: float = 0.05,
          lang: str = "lang", text: str = "text") -> Model:
    """Fit on all rows with a language (null ones are ignored).  The driver
    holds piece counts by language, bounded by the vocabulary."""
    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros(0), np.zeros((trie(path, ANY_SCRIPT).unknown + 1, 0)))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, texts = batch.column("lang"), batch.column("text")
        out: dict = {"lang": [], "word": [], "n": []}
        for name in set(names.to_pylist()):
            own = texts.filter(pa.array([x == name for x in names.to_pylist()]))
            _, number, words, flat, per_chunk = doc_words(own)
            uses = np.bincount(number, minlength=len(per_chunk))
            n = np.bincount(flat, np.repeat(uses, per_chunk), len(words))
            out["lang"] += [name] * len(words)
            out["word"] += words
            out["n"] += n.tolist()
        return out

    words = materialize(arrow_map(rows, count, "lang string, word string, n double", "text")
                        .groupBy("word", "lang").agg(F.sum("n").alias("n")), "language-words")
    pieces = trie(path, ANY_SCRIPT).unknown + 1
    p = np.full((pieces, len(langs)), 1.0 / pieces)
    for _ in range(rounds):
        shared = p

        def expect(batches):
            import pyarrow as pa
            total = np.zeros(shared.shape)
            for part in joined(batches):
                lang = pc.index_in(part.column("lang"), pa.array(langs, part.schema.field("lang").type))
                total += pair_counts(part.column("word").to_pylist(), lang.to_numpy().astype(np.int64),
                                     part.column("n").to_numpy(), path, shared, ANY_SCRIPT)
            piece, at = np.nonzero(total)
            yield pa.RecordBatch.from_pydict({"piece": pa.array(piece, pa.int32()), "at": pa.array(at, pa.int32()),
                                              "n": pa.array(total[piece, at], pa.float64())})
            release()

        got = (words.mapInArrow(expect, "piece int, at int, n double").groupBy("piece", "at")
               .agg(F.sum("n").alias("n")).toPandas())
        n = np.full((pieces, len(langs)), smoothing)
        n[got["piece"], got["at"]] += got["n"]
        p = n / n.sum(axis=0)
    prior = np.array([sizes[x] for x in langs], float)
    return Model(langs, np.log(prior / prior.sum()), p)


def likelihoods(column: pa.Array, m: Model, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(log likelihood by text and language, letters by text)."""
    counts, number, words, flat, per_chunk = doc_words(column)
    if not m.langs or not words:
        return np.zeros((len(counts), len(m.langs))), np.zeros(len(counts))
    # a column at a time: there is a value for every word of the texts
    text = lambda own: sums(sums(own[flat], per_chunk)[number], counts)
    own = log_likelihood(words, path, m.pieces, ANY_SCRIPT)
    return (np.column_stack([text(own[:, k]) for k in range(own.shape[1])]),
            text(np.fromiter(map(len, words), float, len(words))))


def judge(column: pa.Array, m: Model, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(number of the most probable language or -1, its posterior) by text."""
    best, score, _ = weigh(column, m, path)
    return best, score


def weigh(column: pa.Array, m: Model, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like ``judge``, and the mean log likelihood of a letter in that language."""
    return best_of(*likelihoods(column, m, path), m)


def best_of(total: np.ndarray, letters: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``weigh`` from the ``likelihoods`` of the texts."""
    if not m.langs:
        return np.full(len(letters), -1), np.zeros(len(letters)), np.zeros(len(letters))
    joint = total + m.prior
    best = joint.argmax(axis=1)
    score = 1.0 / np.exp(joint - joint.max(axis=1, keepdims=True)).sum(axis=1)
    density = total[np.arange(len(best)), best] / np.maximum(letters, 1)
    return np.where(letters > 0, best, -1), np.where(letters > 0, score, 0.0), density


def order_code(x: np.ndarray) -> np.ndarray:
    """Doubles as longs in the same order; ``order_value`` is its inverse."""
    bits = (np.asarray(x, float) + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits)


def order_value(code: int) -> float:
    bits = np.array([code], np.int64)
    return float(np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits).view(float)[0])


def low_values(codes: DataFrame, share: float) -> dict[str, float]:
    """By language, the exact ``share`` percentile (linear between two ranks) of
    (lang, code) with ``order_code`` as code; null ones are ignored.

    A radix search for all languages at once: counts of the next 16 bits narrow
    the codes down, four times; the driver sees at most 2^16 counts a rank."""
    rows = codes.where("lang is not null and code is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranks = {(x, r(share * (n - 1))) for x, n in sizes.items() for r in (math.floor, math.ceil)}
    found = {key: (None, key[1]) for key in ranks}  # leading bits and rank among the codes that have them
    for shift in (48, 32, 16, 0):
        tops = sorted({(x, top) for (x, _), (top, _) in found.items()}, key=str)
        listed = pa.table({"lang": pa.array([x for x, _ in tops], pa.string()), "top": pa.array([t for _, t in tops], pa.int64())})
        inside = rows
        if shift < 48 and tops:
            inside = rows.withColumn("top", F.shiftright("code", shift + 16)).join(
                F.broadcast(codes.sparkSession.createDataFrame(listed)), ["lang", "top"])
        counts: dict = {}
        for r in inside.groupBy("lang", F.shiftright("code", shift).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect():
            counts.setdefault((r["lang"], None if shift == 48 else r["part"] >> 16), []).append((r["part"], r["n"]))
        for key, (top, rank) in found.items():
            for part, n in sorted(counts[key[0], top]):
                if rank < n:
                    found[key] = (part, rank)
                    break
                rank -= n
    out = {}
    for x, n in sizes.items():
        at = share * (n - 1)
        low, high = (order_value(found[x, r(at)][0]) for r in (math.floor, math.ceil))
        out[x] = low if low == high else (math.ceil(at) - at) * low + (at - math.floor(at)) * high
    return out


def density_floors(told: DataFrame, langs: list[str], share: float = 0.01, slack: float = 1.5) -> np.ndarray:
    """By language, the least mean log likelihood of a letter that a text of
    the language may have: what all but ``share`` of its documents reach, less
    ``slack`` (natural logarithms).  Other languages and noise lie several
    units lower, as most of their pieces were hardly seen in training.

    ``told`` has the language and the mean (as ``own``, an ``order_code``) of
    all documents; null ones have no language or no letters."""
    low = low_values(told.select("lang", F.col(OWN).alias("code")), share)
    return np.array([low[x] - slack if x in low else -np.inf for x in langs])


def predict(docs: DataFrame, model: Model, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``: the most probable language
    and its posterior probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        best, score = judge(batch.column(text), shared.value, path)
        return {"lang_pred": ["und" if k < 0 else shared.value.langs[k] for k in best], "score": score}

    return arrow_extend(docs, run, "lang_pred string, score double", text)


#: Columns of ``identified`` while it runs.
BEST, SCORE, DENSITY, OWN = "__best", "__score", "__density", "__own"


def identified(docs: DataFrame, path: str, min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is told with at least ``min_score``
    and whose text is as likely in it as its texts are (``density_floors``):
    texts of other languages and noise go.

    Every text is weighed once: the rows are stored with what is known of them,
    the floors follow from all of them, and the stored rows are filtered."""
    model = train(docs, path)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        m = shared.value
        total, letters = likelihoods(batch.column("text"), m, path)
        best, score, density = best_of(total, letters, m)
        number = {x: k for k, x in enumerate(m.langs)}
        at = np.array([number.get(x, -1) for x in batch.column("lang").to_pylist()], np.int64)
        used = np.flatnonzero((letters > 0) & (at >= 0))
        own, known = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
        own[used], known[used] = order_code(total[used, at[used]] / letters[used]), True
        return {BEST: best, SCORE: score, DENSITY: density, OWN: pa.array(own, mask=~known)}

    told = materialize(arrow_extend(docs, run, f"{BEST} int, {SCORE} double, {DENSITY} double, {OWN} long", "text"),
                       "language-told")
    floors = F.array(*[F.lit(float(x)) for x in density_floors(told, model.langs)]).cast("array<double>")
    return told.where((F.col(BEST) >= 0) & (F.col(SCORE) >= min_score)
                      & (F.col(DENSITY) >= F.get(floors, F.col(BEST)))).drop(BEST, SCORE, DENSITY, OWN)


def is_held_out():
    """Rows of the test fold; a row without doc_id is in neither fold."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def op8(docs: DataFrame, path: str) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), "text", "lang")
    model = train(rows.where(~is_held_out()), path)
    return predict(rows.select("doc_id", "text"), model, path).select(
        "doc_id", is_held_out().alias("held_out"), "lang_pred", "score")
