"""Quality classifier by co-training two views (operator 3).

The *text* view sees the words of a document, their shapes and how varied they
are; the *metadata* view sees lang, source, length and layout.  Each view
starts as a logistic regression over the presence of features whose shares in
the classes differ significantly, fitted on labelled rows, and is calibrated
on a fold of them that training never sees.

In every further round both views score all documents that are not in the
labelled sample, and each hands the other the documents of the classes it is
sure of: per view and class the threshold is the lowest one at which the fold
shows ``precision`` (with ``support`` rows at least), so a view that cannot
tell a class hands over none of it; where both are sure and disagree, none
does.  What is handed over enters as counts of the features that tell the
classes apart (summed in Spark, weighed by the measured precision), and the
receiving view adds the log odds of these counts to its score.  A round is
kept only if the combined score's loss on the fold falls (cross-validated).
At the end the calibrated views are combined (logistic stacking on the same
fold) and score all documents.

A labelled row is acceptable if its quality is 1 and it isn't toxic; rows with
a null doc_id or quality are ignored, a null toxic counts as 0, and a document
with several labels must be acceptable in all.  Null or empty texts have the
features of an empty text; texts of any length are read whole; repeated rows
get equal scores.  Without labels of both classes every document has the score
0.5 and is accepted; where all documents are in the labelled sample there is
nothing to hand over.  An empty table gives no rows.  Columns of the names of
the results are replaced, others kept.

``max_labelled`` bounds the labelled documents that the models are fitted on
(chosen by a hash); exchange and scoring cover all documents.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_extend, arrow_filter, arrow_map, distinct, materialize, release, slices, split_words

VIEWS = ("text", "meta")
WORD = re.compile(r"\w+")
RUNS = re.compile(r"(\W)\1+")
WORD_EDGES = re.compile(r"^\W+|\W+$")
#: Bytes of text whose features a task has at a time: there are several numbers a word.
SLICE = 2 << 20
#: Letters of a word's beginning (inflected and compound words share theirs).
BEGINNING = 4


def core_and_shape(word: str) -> tuple[str, str]:
    """``Hello,`` -> hello, ``x,``; ``THE!!`` -> the, ``X!``; ``de%%%`` -> de, ``x%``."""
    if word.isalnum():
        core, out = word, "x"
    elif word[-1:] in ".,:;!?" and word[:-1].isalnum():
        core, out = word[:-1], "x" + word[-1]
    else:
        core, out = WORD_EDGES.sub("", word), RUNS.sub(r"\1", WORD.sub("x", word))
    return core.lower(), out.upper() if len(word) > 1 and word.isupper() else out


def text_features(split: tuple) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(features, document numbers, feature numbers): words without the marks
    around them, their beginnings, shapes, shapes of a fifth of the words or
    more, and the variety of the words."""
    counts, number, chunks = split
    names: dict[str, int] = {}
    add = lambda f: names.setdefault(f, len(names))
    words = [core_and_shape(w.decode("utf-8")) for w in chunks]
    of_word = np.array([add("w:" + c) for c, _ in words], np.int64)
    of_start = np.array([add("p:" + c[:BEGINNING]) if len(c) > BEGINNING else -1 for c, _ in words], np.int64)
    shapes: dict[str, int] = {}
    of_shape = np.array([shapes.setdefault(s, len(shapes)) for _, s in words], np.int64)
    present = np.array([add("s:" + s) for s in shapes], np.int64)
    frequent = np.array([add("f:" + s) for s in shapes], np.int64)
    doc = np.repeat(np.arange(len(counts)), counts)
    docs, features = [doc], [of_word[number] if len(number) else number.astype(np.int64)]
    if len(number):
        starts = of_start[number]
        docs.append(doc[starts >= 0])
        features.append(starts[starts >= 0])
        pair, n = np.unique(doc * len(shapes) + of_shape[number], return_counts=True)
        at, s = pair // len(shapes), pair % len(shapes)
        docs += [at, at[5 * n >= counts[at]]]
        features += [present[s], frequent[s[5 * n >= counts[at]]]]
        unique = np.bincount(distinct(doc * len(words) + number) // len(words), minlength=len(counts))
        long = np.flatnonzero(counts >= 20)
        share = np.floor(8 * unique[long] / counts[long]).astype(int)
        docs.append(long)
        features.append(np.array([add(f"v:{k}") for k in share], np.int64))
    return list(names), np.concatenate(docs), np.concatenate(features)


def log_bin(x: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(x, 1e-6))).astype(int)


def meta_features(batch: pa.RecordBatch, split: tuple) -> tuple[list[str], np.ndarray, np.ndarray]:
    """lang, source, length, lines, words a line, characters a word, share of
    capitals, of symbols and of digits, in bins."""
    text = pc.fill_null(batch.column("text").cast(pa.string()), "")
    n = len(text)
    number = lambda a: a.to_numpy(zero_copy_only=False).astype(float)
    chars = number(pc.utf8_length(text))
    lines = number(pc.count_substring(text, "\n")) + 1
    words = np.maximum(split[0], 1).astype(float)
    count = lambda p: number(pc.count_substring_regex(text, p)) / np.maximum(chars, 1)
    columns = [
        [f"lang={x}" for x in batch.column("lang").to_pylist()],
        [f"source={x}" for x in batch.column("source").to_pylist()],
        [f"chars={k}" for k in log_bin(chars)], [f"lines={k}" for k in log_bin(lines)],
        [f"words/line={k}" for k in log_bin(words / lines)], [f"chars/word={int(2 * k)}" for k in chars / words],
        [f"capitals={k}" for k in log_bin(count("[A-Z]"))], [f"symbols={k}" for k in log_bin(count(r"[#*$%&|<>!]"))],
        [f"digits={k}" for k in log_bin(count("[0-9]"))]]
    names: dict[str, int] = {}
    features = np.array([names.setdefault(f, len(names)) for c in columns for f in c], np.int64)
    return list(names), np.tile(np.arange(n), len(columns)), features


def features_of(batch: pa.RecordBatch) -> dict[str, tuple[list[str], np.ndarray, np.ndarray]]:
    """The features of both views; the texts are cut into words once."""
    split = split_words(batch.column("text"))
    return {"text": text_features(split), "meta": meta_features(batch, split)}


@dataclass
class View:
    """Weights of features, fitted and counted, and the calibration of their sums."""

    weights: dict[str, float] = field(default_factory=dict)
    counted: dict[str, float] = field(default_factory=dict)
    beta: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0, 0.0]))  # intercept, fitted, counted

    def raw(self, names: list[str], docs: np.ndarray, features: np.ndarray, n: int) -> np.ndarray:
        """Sums of the fitted and of the counted weights by document."""
        out = np.zeros((n, 2))
        size = max(1, len(names))
        for k, weights in enumerate((self.weights, self.counted)):
            if not weights or not len(features):
                continue
            w = np.array([weights.get(f, 0.0) for f in names])
            used = w[features] != 0
            pair = distinct(docs[used] * size + features[used])
            out[:, k] = np.bincount(pair // size, w[pair % size], n)
        return out

    def logit(self, raw: np.ndarray) -> np.ndarray:
        return self.beta[0] + raw @ self.beta[1:]


@dataclass
class Model:
    text: View
    meta: View
    stack: np.ndarray  # intercept, text, meta


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton's method with a small ridge; x has an intercept column first."""
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (y - p) - ridge * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def hash_share(*salt):
    return F.shiftrightunsigned(F.xxhash64(*[F.lit(s) for s in salt], "doc_id"), 33) / F.lit(float(2**31))


def labelled_rows(labels: DataFrame) -> DataFrame:
    """(doc_id, y) with one row per labelled document."""
    ok = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    return (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
            .agg(F.min(ok.cast("int")).alias("y")))


def training_table(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """(doc_id, y, text, meta): features of the sampled labelled rows."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", "lang", "source").where("doc_id is not null")
    known = labelled_rows(labels)
    sample = known.where(hash_share(3) < max_labelled / max(known.count(), 1))

    def run(batch: pa.RecordBatch) -> dict:
        out = {"doc_id": batch.column("doc_id"), "y": batch.column("y")}
        for view, (names, doc, feature) in features_of(batch).items():
            pair = distinct(doc * max(1, len(names)) + feature)
            cut = np.searchsorted(pair // max(1, len(names)), np.arange(batch.num_rows + 1))
            flat = pa.array(names, pa.string()).take(pa.array(pair % max(1, len(names))))
            out[view] = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), flat)
        return out

    # the sample's size is bounded, so its side is broadcast
    own = rows.join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text", "lang", "source")
    return materialize(arrow_map(own, run, "doc_id long, y int, text array<string>, meta array<string>", "text", SLICE),
                       "cotrain-features")


def telling_features(table: DataFrame, view: str, total: dict[int, int], min_z: float, size: int
                     ) -> dict[str, tuple[int, int, float]]:
    """The features whose share differs most between the classes: rows of
    class 0 and 1 that have them, and the z of the difference."""

    def run(batches):
        n: tuple = (Counter(), Counter())
        for batch in batches:
            for y, features in zip(batch.column("label").to_pylist(), batch.column(view).to_pylist()):
                n[int(y)].update(features)
        names = list({**n[0], **n[1]})
        yield pa.RecordBatch.from_pydict({"feature": pa.array(names, pa.string()),
                                          "n0": pa.array([n[0][f] for f in names], pa.int64()),
                                          "n1": pa.array([n[1][f] for f in names], pa.int64())})
        release()

    n0, n1, rows = F.col("n0"), F.col("n1"), float(total[0] + total[1])
    p = (n0 + n1) / F.lit(rows)
    z = (n1 / total[1] - n0 / total[0]) / F.sqrt(p * (1 - p) * (1 / total[0] + 1 / total[1]))
    top = (table.select("label", view).mapInArrow(run, "feature string, n0 long, n1 long")
           .groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
           .where(n0 + n1 < rows).withColumn("z", F.abs(z)).where(F.col("z") >= min_z)
           .orderBy(F.desc("z"), "feature").limit(size).collect())
    return {r.feature: (r.n0, r.n1, r.z) for r in top}


def fit_view(rows: DataFrame, view: str, names: list[str], ridge: float) -> View:
    """Logistic regression over the presence of ``names`` on (label, view)."""
    if not names:
        return View()
    vectors = CountVectorizerModel.from_vocabulary(names, inputCol=view, outputCol="features").setBinary(True)
    fitted = LogisticRegression(maxIter=40, regParam=ridge, standardization=False).fit(
        vectors.transform(rows).select("label", "features").coalesce(8))
    return View(dict(zip(names, fitted.coefficients.toArray().tolist())))


def fold_loss(x: np.ndarray, y: np.ndarray, parts: int = 5) -> float:
    """Cross-validated log loss of a logistic fit on the fold."""
    part, loss = np.arange(len(y)) % parts, 0.0
    for k in range(parts):
        p = sigmoid(x[part == k] @ fit_logistic(x[part != k], y[part != k]))
        loss -= np.log(np.clip(np.where(y[part == k] == 1, p, 1 - p), 1e-6, 1)).sum()
    return loss / max(1, len(y))


def with_one(x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), x])


def calibrate(model: Model, raw: dict[str, np.ndarray], y: np.ndarray) -> float:
    """Fit the views' and the stack's coefficients on the fold; returns the
    combined score's cross-validated loss."""
    for v in VIEWS:
        view = getattr(model, v)
        used = [k for k in (0, 1) if raw[v][:, k].any()]
        beta = fit_logistic(with_one(raw[v][:, used]), y)
        view.beta = np.zeros(3)
        view.beta[[0, *(k + 1 for k in used)]] = beta
    logits = with_one(np.column_stack([getattr(model, v).logit(raw[v]) for v in VIEWS]))
    model.stack = fit_logistic(logits, y)
    return fold_loss(logits, y)


def sure_from(p: np.ndarray, right: np.ndarray, precision: float, support: int) -> tuple[float, float] | None:
    """The lowest probability from which on at least ``precision`` of the
    fold's rows (``support`` at least) are right, and that share."""
    order = np.argsort(-p, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(p) + 1)
    last = np.append(p[order][1:] != p[order][:-1], True) if len(p) else np.zeros(0, bool)
    ok = np.flatnonzero((share >= precision) & last & (np.arange(1, len(p) + 1) >= support))
    return (float(p[order][ok[-1]]), float(share[ok[-1]])) if len(ok) else None


def handed_counts(docs: DataFrame, model: Model, sure: dict, sample: set[int], wanted: dict[str, list[str]]
                  ) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """By receiving view: how many of the documents handed to it have each of
    its ``wanted`` features, by class, and how many there are.  All documents
    outside the labelled sample are scored."""
    shared = docs.sparkSession.sparkContext.broadcast((model, sure, sample, wanted))

    def run(batches):
        model, sure, sample, wanted = shared.value
        place = {v: {f: k for k, f in enumerate(wanted[v])} for v in VIEWS}
        total = {v: np.zeros((len(wanted[v]) + 1, 2), np.int64) for v in VIEWS}
        for batch in (part for b in batches for part in slices(b, "text", SLICE)):
            n = batch.num_rows
            own = features_of(batch)
            free = np.array([i is not None and i not in sample for i in batch.column("doc_id").to_pylist()], bool)
            told = {}
            for v in VIEWS:
                p = sigmoid(getattr(model, v).logit(getattr(model, v).raw(*own[v], n)))
                told[v] = np.full(n, -1)
                for c, q in ((0, 1 - p), (1, p)):
                    if sure[v, c] is not None:
                        told[v][q >= sure[v, c][0]] = c
            clash = (told["text"] >= 0) & (told["meta"] >= 0) & (told["text"] != told["meta"])
            for v, giver in (VIEWS, VIEWS[::-1]):
                names, doc, feature = own[v]
                index = np.array([place[v].get(f, -1) for f in names], np.int64)
                label = np.where(free & ~clash, told[giver], -1)
                total[v][-1] += np.bincount(label[label >= 0], minlength=2)
                if len(feature):
                    at = index[feature]
                    use = (at >= 0) & (label[doc] >= 0)
                    pair = distinct(doc[use] * len(index) + feature[use])
                    np.add.at(total[v], (index[pair % len(index)], label[pair // len(index)]), 1)
        for v in VIEWS:
            at, c = np.nonzero(total[v])
            yield pa.RecordBatch.from_pydict({"view": pa.array([v] * len(at), pa.string()), "at": pa.array(at, pa.int32()),
                                              "label": pa.array(c, pa.int32()), "n": pa.array(total[v][at, c])})
        release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source")
    out = {v: np.zeros((len(wanted[v]) + 1, 2)) for v in VIEWS}
    for r in (rows.mapInArrow(run, "view string, at int, label int, n long")
              .groupBy("view", "at", "label").agg(F.sum("n").alias("n")).collect()):  # bounded by ``wanted``
        out[r.view][r["at"], r.label] = r.n
    return {v: (out[v][:-1], out[v][-1]) for v in VIEWS}


def log_odds(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    share = (counts + 0.5) / (total + 1.0)
    return np.log(share[:, 1]) - np.log(share[:, 0])


def fold_scores(table: DataFrame, model: Model, fold: set[int]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Sums of the weights by view and the classes of the fold's documents, in
    order of doc_id; a few numbers a document reach the driver."""
    shared = table.sparkSession.sparkContext.broadcast((model, fold))

    def run(batch: pa.RecordBatch) -> dict:
        model, fold = shared.value
        part = batch.filter(pa.array([i in fold for i in batch.column("doc_id").to_pylist()], pa.bool_()))
        out = {"doc_id": part.column("doc_id"), "y": part.column("y")}
        for v in VIEWS:
            rows = part.column(v).to_pylist()
            for k, w in enumerate((getattr(model, v).weights, getattr(model, v).counted)):
                out[f"{v}{k}"] = [sum(w.get(f, 0.0) for f in set(x)) for x in rows]
        return out

    names = [f"{v}{k}" for v in VIEWS for k in (0, 1)]
    held = arrow_map(table, run, "doc_id long, y int, " + ", ".join(f"{c} double" for c in names)).toPandas()
    held = held.drop_duplicates("doc_id").sort_values("doc_id")
    return {v: held[[f"{v}0", f"{v}1"]].to_numpy(float) for v in VIEWS}, held.y.to_numpy(float)


def train(docs: DataFrame, labels: DataFrame, rounds: int = 2, max_labelled: int = 12_000,
          precision: float = 0.97, support: int = 30, min_z: float = 4.0, size: int = 4_000,
          ridge: float = 1e-4, counted_z: float = 2.0, counted_size: int = 20_000) -> Model | None:
    table = training_table(docs, labels, max_labelled)
    known = {r.doc_id: r.y for r in table.select("doc_id", "y").collect()}
    fold = {i for i in known if (i * 2654435761) % 2**32 % 3 == 0}  # calibration rows
    if len({known[i] for i in fold}) < 2 or len({known[i] for i in known if i not in fold}) < 2:
        return None

    def marked(ids: set[int]) -> tuple[DataFrame, Counter]:
        """(doc_id, text, meta, label) of labelled rows, and rows by class; as many as the sample's bound allows."""
        mark = table.sparkSession.createDataFrame(pa.table({"doc_id": pa.array(ids, pa.int64()),
                                                            "label": pa.array([known[i] for i in ids], pa.float64())}))
        return table.select("doc_id", *VIEWS).join(F.broadcast(mark), "doc_id"), Counter(known[i] for i in ids)

    rows, total = marked(set(known) - fold)
    telling = {v: telling_features(rows, v, total, counted_z, counted_size) for v in VIEWS}
    model = Model(*(fit_view(rows, v, [f for f, t in telling[v].items() if t[2] >= min_z][:size], ridge)
                    for v in VIEWS), np.zeros(3))
    raw, y = fold_scores(table, model, fold)
    loss = calibrate(model, raw, y)
    for _ in range(rounds - 1):
        sure = {}
        for v in VIEWS:
            p = sigmoid(getattr(model, v).logit(raw[v]))
            sure[v, 0] = sure_from(1 - p, y == 0, precision, support)
            sure[v, 1] = sure_from(p, y == 1, precision, support)
        if not any(sure.values()):
            break
        handed = handed_counts(docs, model, sure, set(known), {v: list(telling[v]) for v in VIEWS})
        after = Model(*(View(dict(getattr(model, v).weights)) for v in VIEWS), np.zeros(3))
        for v, giver in (VIEWS, VIEWS[::-1]):
            weight = np.array([sure[giver, c][1] if sure[giver, c] else 0.0 for c in (0, 1)])
            counts = np.array([t[:2] for t in telling[v].values()], float).reshape(-1, 2) + weight * handed[v][0]
            odds = log_odds(counts, np.array([total[0], total[1]]) + weight * handed[v][1])
            fitted = getattr(after, v).weights  # what the fit has already is not counted twice
            getattr(after, v).counted = {f: o for f, o in zip(telling[v], odds.tolist()) if not fitted.get(f)}
        new_raw, _ = fold_scores(table, after, fold)
        new_loss = calibrate(after, new_raw, y)
        if new_loss >= loss:
            break
        model, loss, raw = after, new_loss, new_raw
    # the calibration stands; the fitted weights are taken from all labelled rows
    rows, total = marked(set(known))
    for v in VIEWS:
        names = list(telling_features(rows, v, total, min_z, size))
        getattr(model, v).weights = fit_view(rows, v, names, ridge).weights
    return model


def probabilities(batch: pa.RecordBatch, m: Model | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Calibrated probabilities of the text view, the metadata view and both."""
    n = batch.num_rows
    if m is None:
        return (np.full(n, 0.5),) * 3
    own = features_of(batch)
    logits = [getattr(m, v).logit(getattr(m, v).raw(*own[v], n)) for v in VIEWS]
    both = m.stack[0] + m.stack[1] * logits[0] + m.stack[2] * logits[1]
    return sigmoid(logits[0]), sigmoid(logits[1]), sigmoid(both)


def score(docs: DataFrame, model: Model | None, threshold: float = 0.5) -> DataFrame:
    """``docs`` (text, lang, source) with the calibrated probabilities of both
    views, the combined one, and ``accepted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        text, meta, both = probabilities(batch, shared.value)
        return {"text_score": text, "meta_score": meta, "quality_score": both, "accepted": both >= threshold}

    return arrow_extend(docs, run, "text_score double, meta_score double, quality_score double, accepted boolean", "text",
                        SLICE)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    return arrow_filter(docs, lambda batch: probabilities(batch, shared.value)[2] >= threshold, "text", SLICE)


def op3(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents; labels of a quarter of them (crc32 of the id
    modulo 4 is 2) are kept out of training to measure accuracy."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = train(docs, labels.where(~held))
    rows = docs.select(F.col("doc_id").cast("long"), "text", "lang", "source")
    return score(rows, model).select("doc_id", held.alias("held_out"), "text_score", "meta_score", "quality_score",
                                     "accepted")
