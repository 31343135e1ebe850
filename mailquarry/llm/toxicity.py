"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, learned from document labels."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailquarry.llm._words import chunks, mixed, run_hashes
from mailquarry.llm.quality import held_out

#: At most so many labelled documents train the model: those of the smallest hashes of their ids.
MAX_TRAINING_ROWS = 8_000
#: Bytes that one training text may have; a longer one is not learned (it is scored like any other).
MAX_TRAINING_BYTES = 1 << 15
#: Features that the model may weigh: those whose share of toxic documents is so far from the average that a likelihood ratio test gives LEAST_EVIDENCE.
MAX_FEATURES, LEAST_EVIDENCE = 1 << 16, 24.0
#: Share of clean documents, at most, that carry the label all the same.
LABEL_NOISE = 0.05
EPOCHS, RATE, L2, BIAS = 300, 0.3, 0.02, -6.0
THRESHOLD = 0.5
#: Bytes at the beginning of a word that are features, beside the word as a whole: they tell inflected and compound words.
STEMS = (3, 4, 5, 6, 7, 8)
#: Bytes of words, and those that end a sentence.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
ENDS = np.zeros(256, bool)
ENDS[[0x21, 0x2E, 0x3F, 0x0A]] = True  # ! . ? and a line break


class Model(NamedTuple):
    """Sorted hashes of features, their weights, and the bias of every sentence."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


class Sentences(NamedTuple):
    """The sentences with words of many texts: hash and sentence (numbered over all texts) of each word and of each feature; text and byte borders of each sentence."""

    words: np.ndarray
    word_sentence: np.ndarray
    hashes: np.ndarray
    sentence: np.ndarray
    text: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def lowered(raw: bytes) -> bytes:
    """Letters of ASCII and of Latin-1 in lower case, byte by byte, so that places stay."""
    data = np.frombuffer(raw, np.uint8).copy()
    ascii_up = (data >= 0x41) & (data <= 0x5A)
    data[1:] += 0x20 * ((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)).astype(np.uint8)
    return (data + 0x20 * ascii_up.astype(np.uint8)).tobytes()


def split(raws: list[bytes]) -> Sentences:
    """Sentences end after ``. ! ?`` or a line break; words are runs of ASCII letters, digits and all characters beyond ASCII, in lower case (Latin-1 letters).

    Features are a word as a whole, and its first 3 to 8 bytes where it has so many.
    """
    found = run_hashes(list(map(lowered, raws)), LETTERS, STEMS)
    text = np.repeat(np.arange(len(raws)), found.counts)
    breaks = np.flatnonzero(ENDS[found.data])
    piece = np.searchsorted(breaks, found.starts)
    _, first, sentence = np.unique(piece, return_index=True, return_inverse=True)
    last = np.append(first[1:], len(piece)) - 1 if len(piece) else first
    base = np.cumsum([0, *[len(r) + 1 for r in raws]])[text[first]]
    at = [np.arange(len(text)), *[np.flatnonzero(found.ends - found.starts >= k) for k in STEMS]]
    hashes = np.concatenate([found.hashes, *[h[i] for h, i in zip(found.heads, at[1:], strict=True)]])
    return Sentences(found.hashes, sentence, hashes, sentence[np.concatenate(at)], text[first], found.starts[first] - base, found.ends[last] - base)


def _distinct(found: Sentences, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sentence, number of the feature) of every known feature, once per sentence."""
    if not len(features) or not len(found.hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(features, found.hashes), len(features) - 1)
    known = features[at] == found.hashes
    pairs = np.unique(found.sentence[known].astype(np.int64) * len(features) + at[known])
    return pairs // len(features), pairs % len(features)


def _log_rest(logits: np.ndarray) -> np.ndarray:
    """Logarithm of one minus each sentence's probability."""
    return -np.logaddexp(0, logits)


def sentence_logits(found: Sentences, model: Model) -> np.ndarray:
    sentence, feature = _distinct(found, model.features)
    return model.bias + np.bincount(sentence, model.weights[feature], len(found.text))


def noisy_or(log_rest: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """A text's probability that not all of its sentences are clean."""
    return -np.expm1(np.bincount(text, log_rest, n)) if len(text) else np.zeros(n)


def telling(found: Sentences, labels: np.ndarray, least: float) -> np.ndarray:
    """Hashes of the features that stand in toxic documents more or less often than chance has it, sorted; of too many those of most evidence.

    A sentence counts for the first document that has it only, so that many copies of one mislabelled document say no more than one.
    """
    if not len(found.words):
        return np.zeros(0, np.uint64)
    content = np.add.reduceat(mixed(found.words + np.uint64(1)), np.searchsorted(found.word_sentence, np.arange(len(found.text))))
    own = np.zeros(len(found.text), bool)
    own[np.unique(content, return_index=True)[1]] = True
    counted = own[found.sentence]
    doc, h = found.text[found.sentence[counted]], found.hashes[counted]
    order = np.argsort(doc, kind="stable")
    borders = np.searchsorted(doc[order], np.arange(len(labels) + 1))
    sets = [np.unique(h[order[a:b]]) for a, b in zip(borders[:-1], borders[1:], strict=True)]
    features, number = np.unique(np.concatenate(sets), return_inverse=True)
    n, k = np.bincount(number), np.bincount(number, np.repeat(labels, list(map(len, sets))))
    share = labels.mean()
    with np.errstate(divide="ignore", invalid="ignore"):
        evidence = 2 * (np.where(k > 0, k * np.log(k / (n * share)), 0) + np.where(n > k, (n - k) * np.log((n - k) / (n * (1 - share))), 0))
    enough = np.flatnonzero(evidence >= least)
    return np.sort(features[enough[np.argsort(-evidence[enough], kind="stable")[:MAX_FEATURES]]])


def fit(texts: Sequence[str], labels: Sequence[int], least: float = LEAST_EVIDENCE, noise: float = LABEL_NOISE, epochs: int = EPOCHS, rate: float = RATE, l2: float = L2) -> Model:
    """Weights that make the document labels likely, by full gradients with adapted steps.

    A document is toxic unless each of its sentences is clean (noisy-or); its label is 1 for sure then, and with probability
    ``noise`` otherwise, so that a mislabelled document hardly pulls. No sentence has a label.
    """
    found = split([t.encode("utf-8", "surrogatepass") for t in texts])
    y = np.asarray(labels, float)
    features = telling(found, y, least) if len(y) and 0 < y.sum() < len(y) else np.zeros(0, np.uint64)
    sentence, feature = _distinct(found, features)
    weights, bias = np.zeros(len(features)), BIAS
    squares, bias_squares = np.full(len(features), 1e-8), 1e-8
    for _ in range(epochs if len(features) else 0):
        logits = bias + np.bincount(sentence, weights[feature], len(found.text))
        p = 1 / (1 + np.exp(-np.clip(logits, -40, 40)))
        toxic = np.clip(noisy_or(_log_rest(logits), found.text, len(y)), 1e-12, 1 - 1e-12)
        # Slope of the loss along a sentence's logit: its probability times what its document's label says of it.
        pull = np.where(y > 0, -(1 - noise) * (1 - toxic) / (noise + (1 - noise) * toxic), 1.0)
        slope = p * pull[found.text]
        grad = np.bincount(feature, slope[sentence], len(features)) + l2 * weights
        squares += grad * grad
        weights -= rate * grad / np.sqrt(squares)
        g = slope.sum()
        bias_squares += g * g
        bias -= rate * g / np.sqrt(bias_squares)
    return Model(features, weights, float(bias))


def _fitted(batches: Iterator[pa.RecordBatch], **options) -> Iterator[pa.RecordBatch]:
    rows = [x for b in batches for x in b.to_pylist()]
    rows.sort(key=lambda x: (x["h"], x["text"]))
    model = fit([x["text"] for x in rows], [x["label"] for x in rows], **options)
    yield pa.RecordBatch.from_arrays([pa.array([model.features.tobytes()]), pa.array([model.weights.tobytes()]), pa.array([model.bias])], ["features", "weights", "bias"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_TRAINING_ROWS, **options) -> Model:
    """A model learned from at most ``max_rows`` labelled documents that are not held out.

    Documents that have both labels are left out, as are texts over MAX_TRAINING_BYTES; of rows of one id the least text is learned.
    The sample is bounded, so its ids are broadcast and one task fits the model; the model, of MAX_FEATURES features at most, comes to the driver.
    Without usable labels every sentence has the initial bias.
    """
    usable = labels.where(~held_out(F.col(id_col)) & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    usable = usable.groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).cast("int").alias("label"), F.max(label_col).alias("most")).where("label = most")
    sample = usable.select("doc_id", "label", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(max_rows)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.octet_length("text") <= MAX_TRAINING_BYTES)
    rows = rows.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "h", "label").agg(F.min("text").alias("text"))
    found = rows.select("h", "label", "text").repartition(1).mapInArrow(lambda batches: _fitted(batches, **options), "features binary, weights binary, bias double").head()
    if found is None:
        return fit([], [])
    return Model(np.frombuffer(found.features, np.uint64), np.frombuffer(found.weights, float), found.bias)


def _characters(raw: bytes, at: int) -> int:
    """The number of characters before a byte."""
    head = np.frombuffer(raw, np.uint8, at)
    return int(np.count_nonzero((head & 0xC0) != 0x80))


def scored(texts: Sequence[str | None], model: Model, threshold: float = THRESHOLD) -> Iterator[tuple[float, int, list[dict]]]:
    """(score, sentences, offending sentences) of each text. Offending are sentences that reach the threshold by themselves, or, in a toxic text without one, the likeliest."""
    for raws in chunks(list(texts)):
        found = split(raws)
        logits = sentence_logits(found, model)
        scores = noisy_or(_log_rest(logits), found.text, len(raws))
        counts = np.bincount(found.text, minlength=len(raws))
        after = np.cumsum(counts)
        floor = np.log(threshold / (1 - threshold))
        for k, raw in enumerate(raws):
            spans = []
            if scores[k] >= threshold:
                own = np.arange(after[k] - counts[k], after[k])
                bad = own[logits[own] >= floor]
                if not len(bad):
                    bad = own[[int(np.argmax(logits[own]))]]
                for s in bad.tolist():
                    spans.append({"start": _characters(raw, int(found.begin[s])), "end": _characters(raw, int(found.end[s])), "score": float(1 / (1 + np.exp(-logits[s])))})
            yield float(min(1.0, max(0.0, scores[k]))), int(counts[k]), spans


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row per document: doc_id, score, predicted (1 if score >= threshold), n_sentences, spans: start, end (code points, end exclusive) and score of each offending sentence.

    A sentence's score is a logistic function of its distinct words and their beginnings; a document's is the noisy-or of its sentences', so one
    offending sentence in a very long text is enough. Whole texts are scored, many at once in numpy; there is no shuffle, and the
    model, of bounded size, goes with the tasks.

    Null and empty texts and texts without words: score 0, no sentences. Repeated rows and null ids are kept, each scored by its text; other columns are not
    looked at. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(scored(batch.column(1).to_pylist(), model, threshold))
            spans = pa.array([r[2] for r in rows], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.int64()), spans], ["doc_id", "score", "n_sentences", "spans"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, score double, n_sentences long, spans array<struct<start:long,end:long,score:double>>")
    return rows.select("doc_id", "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "n_sentences", "spans")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, held_out, score, predicted, n_sentences, spans. The text alone decides the score."""
    found = find(docs, train(docs, labels, id_col, text_col), id_col, text_col)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_sentences", "spans")
