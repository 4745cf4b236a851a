"""Toxicity by multiple-instance learning.

Labels are of documents, toxicity is of sentences: a document is toxic if any
sentence is. Sentence probabilities are logistic in the words of the sentence,
a document's is their noisy-or, and the weights are fitted through it.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.common import id_field, map_texts, texts_of

_SPLIT = re.compile(r"[.!?\n]+").split
_SENTENCES = re.compile(r"[^.!?\n]+").finditer
_WORDS = re.compile(r"[^\W_]+").findall

# Words of which a task remembers the features: bounds memory, not results.
WORDS_KEPT = 200_000

# Beginnings of a word that count as features beside the word itself: stems
# carry over to inflected and compound forms.
STEMS = (4, 5, 6, 7)

#: Probability from which a document is predicted toxic, and a sentence reported.
THRESHOLD = 0.3


@dataclass(frozen=True)
class Training:
    """Bounds and settings of the fit.

    The classifier is fitted on at most ``rows_per_label`` documents of each
    label (those with the smallest hashes of their id), weighted to the counts
    of all labelled documents. Words in fewer than ``min_docs`` of them are no
    features. ``ridge`` pulls weights to zero.
    """

    rows_per_label: int = 2500
    min_docs: int = 4
    rounds: int = 150
    step: float = 0.2
    ridge: float = 2e-5


def features(token: str) -> list[str]:
    """The words of what stands between white space, and with a mark their beginnings."""
    return [name for word in _WORDS(token) for name in (word, *(f"{word[:n]}*" for n in STEMS if len(word) >= n))]


class WordWeights(dict):
    """Weights of whole words, summed over their features when first met."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= WORDS_KEPT:
            self.clear()
        total = self[word] = sum(self.weights.get(feature, 0.0) for feature in features(word))
        return total


class Model:
    def __init__(self, bias: float, weights: dict[str, float] | None = None):
        self.bias, self.weights = bias, weights or {}
        self.words = WordWeights(self.weights)

    def __reduce__(self):
        return Model, (self.bias, self.weights)

    def logits(self, sentences: list[str]) -> np.ndarray:
        weight = self.words.__getitem__
        return np.array([sum(map(weight, set(sentence.split()))) for sentence in sentences], float) + self.bias

    def score(self, text: str) -> float:
        """The noisy-or of the sentences; 0 without one."""
        logits = self.logits([s for s in _SPLIT(text.lower()) if s and not s.isspace()])
        return float(-np.expm1(-np.logaddexp(0, logits).sum()))

    def locate(self, text: str) -> list[dict]:
        """The sentences that are toxic themselves."""
        found = [m for m in _SENTENCES(text) if not m[0].isspace()]
        logits = self.logits([m[0].lower() for m in found])
        return [
            {"start": found[at].start(), "end": found[at].end(), "score": float(1 / (1 + np.exp(-logits[at])))}
            for at in np.flatnonzero(logits >= np.log(THRESHOLD / (1 - THRESHOLD)))
        ]


def fit(texts: list[str], labels: list[int], row_weights: dict[int, float], settings: Training) -> Model:
    """Maximum likelihood of the document labels under the noisy-or."""
    toxic = np.array(labels, float)
    if not 0 < toxic.sum() < len(toxic):  # nothing to tell apart: the share is the score of a sentence
        share = min(max(toxic.mean() if len(toxic) else 0.0, 1e-6), 0.5)
        return Model(float(np.log(share / (1 - share))))
    known: dict[str, int] = {}
    of_token: dict[str, list[int]] = {}
    columns, row_of, document_of = array("i"), array("i"), array("i")
    for document, text in enumerate(texts):
        for sentence in _SPLIT(text.lower()):
            tokens = set(sentence.split())
            if tokens:
                before = len(columns)
                for token in tokens:
                    if (ids := of_token.get(token)) is None:
                        ids = of_token[token] = [known.setdefault(name, len(known)) for name in features(token)]
                    columns.extend(ids)
                row_of.extend([len(document_of)] * (len(columns) - before))
                document_of.append(document)
    columns, rows, documents = (np.array(x, np.int64) for x in (columns, row_of, document_of))
    pairs = np.unique(columns * len(texts) + documents[rows]) if len(rows) else np.empty(0, np.int64)
    in_docs = np.bincount(pairs // max(len(texts), 1), minlength=len(known))
    common = in_docs >= settings.min_docs
    number = np.cumsum(common) - 1
    keep = common[columns]
    columns, rows, size = number[columns[keep]], rows[keep], int(common.sum())
    weight = np.array([row_weights[label] for label in labels], float)
    weight /= weight.sum()

    params = np.append(np.zeros(size), -5.0)
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for turn in range(1, settings.rounds + 1):
        logits = np.bincount(rows, params[columns], len(documents)) + params[-1]
        sentence = 1 / (1 + np.exp(-logits))
        none = np.exp(-np.bincount(documents, np.logaddexp(0, logits), len(texts)))
        # d(-log likelihood)/d(logit): p for a clean document, -p * none / (1 - none) for a toxic one.
        factor = np.where(toxic == 1, -none / np.maximum(1 - none, 1e-9), 1.0) * weight
        slope = sentence * factor[documents]
        gradient = np.append(np.bincount(columns, slope[rows], size), slope.sum())
        gradient[:-1] += settings.ridge * params[:-1]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        params -= settings.step * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-9)
    words = np.array(list(known), object)[common] if size else []
    return Model(float(params[-1]), {w: float(p) for w, p in zip(words, params[:-1], strict=True) if abs(p) > 1e-3})


def held_out(doc_id) -> F.Column:
    """Documents whose label no fit may see."""
    return F.crc32(doc_id.cast("string")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, settings: Training = Training()) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic. Labels that are
    NULL, or of a NULL id, are left out; of repeated ones the highest counts.
    """
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    counts = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    drawn = [
        known.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.rows_per_label)
        for label in (0, 1)
    ]
    row_weights = {label: n / min(n, settings.rows_per_label) for label, n in counts.items()}
    # At most two times rows_per_label ids.
    sample = docs.join(F.broadcast(drawn[0].union(drawn[1])), "doc_id").select("doc_id", "text", "label")
    schema = "word string, weight double"

    def run(batches):
        import pyarrow as pa

        rows = sorted((r["doc_id"], r["text"] or "", r["label"]) for batch in batches for r in batch.to_pylist())
        model = fit([r[1] for r in rows], [r[2] for r in rows], row_weights, settings)
        words = [None, *model.weights]
        yield pa.RecordBatch.from_pydict({"word": words, "weight": [model.bias, *model.weights.values()]})

    fitted = {row["word"]: row["weight"] for row in sample.repartition(1).mapInArrow(run, schema).collect()}
    return Model(fitted.pop(None, -20.0), fitted)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    settings: Training = Training(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Scores of whole texts, and where the toxic sentences stand.

    One row for each row of ``docs``: doc_id, held_out (a NULL id is not),
    score (0 to 1), predicted (1 from ``THRESHOLD`` on) and sentences, an array of
    (start, end, score) in code points, for documents predicted toxic. Nothing but the text enters the score.
    A NULL or empty text has no sentence and scores 0. Without labels of both
    kinds all sentences score the same. Scoring is one pass without a shuffle;
    the weights it carries are bounded by the words of the sample.
    """
    texts = texts_of(docs, id_col, text_col)
    model = train(texts, labels, settings)
    sentence = T.StructType(
        [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]
    )
    schema = T.StructType(
        [id_field(docs, id_col), T.StructField("score", T.DoubleType()), T.StructField("sentences", T.ArrayType(sentence))]
    )
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(model)

    def start():
        model = shared.value

        def step(ids, texts):
            scores = [model.score(text or "") for text in texts]
            found = [model.locate(text) if score >= THRESHOLD else [] for text, score in zip(texts, scores, strict=True)]
            return ids, scores, found

        return step

    return map_texts(texts, start, schema, "text").select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "sentences",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, settings: Training = Training()) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) that are not predicted toxic; a NULL text is kept."""
    model = train(texts_of(docs, "doc_id", "text"), labels, settings)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        score = shared.value.score
        for batch in batches:
            texts = batch.column(batch.schema.names.index("text")).to_pylist()
            yield batch.filter(pa.array([score(text or "") < THRESHOLD for text in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
