"""Language identification: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

Character n-grams of the lower-cased words hash into buckets; a text is the mean of its buckets' embeddings. Embeddings
and softmax are trained together by stochastic gradient descent in numpy, on counts that Spark tasks have made.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from siltgate.llm.common import squeezed, unsqueezed

BUCKETS = 1 << 14
GRAMS = (1, 2, 3)
WIDTH = 16
#: The classifier is fitted on at most this many labelled rows of each language, those with the smallest id hashes.
TRAIN_ROWS = 600
#: So many times more rows are drawn by hash before the smallest hashes are picked.
THIN = 4
#: Besides its whole text, a training row gives this many short runs of its words.
SHORT_RUNS = 3
EPOCHS, BATCH, RATE, SEED = 12, 64, 0.5, 11
#: Part of the sample that calibrates temperature and rejection instead of training.
CALIBRATION = 0.25
#: Rejection may cost at most this part of the calibration texts, and never needs a score above MAX_THRESHOLD.
LOST, MAX_THRESHOLD = 0.002, 0.5
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def subwords(text: str, buckets: int = BUCKETS) -> np.ndarray | None:
    """Bucket counts of all n-grams of the text's words; None if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[codes]
    if not letter.any():
        return None
    # Runs of other characters become one boundary.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    marked = np.where(letter, codes, 0)[keep]
    marked = np.concatenate([np.zeros(1, marked.dtype), marked, np.zeros(1, marked.dtype)]).astype(np.uint32)
    counts = np.zeros(buckets, dtype=np.int64)
    for n in GRAMS:
        hashed = np.full(len(marked) - n + 1, 0x9E3779B9 + n, dtype=np.uint32)
        for k in range(n):
            hashed ^= marked[k:len(marked) - n + 1 + k]
            hashed *= np.uint32(0x85EBCA6B)
            hashed ^= hashed >> np.uint32(15)
        counts += np.bincount(hashed & np.uint32(buckets - 1), minlength=buckets)
    return counts


@dataclass
class LangModel:
    """weights: buckets x languages, the product of embeddings and softmax; a score is divided by the temperature."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def score(self, counts: np.ndarray) -> np.ndarray:
        logits = (counts @ self.weights / counts.sum() + self.bias) / self.temperature
        p = np.exp(logits - logits.max())
        return p / p.sum()


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for key, lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words, draw = text.split(), random.Random(f"{key}")
            texts = [text]
            for _ in range(SHORT_RUNS if len(words) > 3 else 0):
                size = draw.randint(2, 30)
                at = draw.randrange(max(1, len(words) - size))
                texts.append(" ".join(words[at:at + size]))
            for part, own in enumerate(texts):
                counts = subwords(own)
                if counts is not None:
                    full = np.flatnonzero(counts)
                    out.append((key, part, lang, squeezed(full), squeezed(counts[full])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int32()),
             pa.array([x[2] for x in out], pa.string()), pa.array([x[3] for x in out], pa.binary()),
             pa.array([x[4] for x in out], pa.binary())], ["id", "part", "lang", "bucket", "n"])


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang",
        rows: int = TRAIN_ROWS) -> LangModel | None:
    """Train on a bounded sample of rows with text and label; None if there is none.

    The driver gets bucket counts only: at most rows x (1 + SHORT_RUNS) sparse vectors of BUCKETS for each language.
    """
    known = labelled.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.col(label).alias("lang"),
        F.col(text).alias("text"))
    # A thin draw first, so that the exact choice below sees a bounded number of rows of each language.
    order = F.xxhash64("id", "text")
    per_lang = known.groupBy("lang").agg((F.lit(THIN * rows) / F.count("*")).alias("part"))
    # One row per language, each a class of the model on the driver anyway: texts stay where they are.
    drawn = known.join(F.broadcast(per_lang), "lang").where(F.pmod(order, F.lit(1 << 30)) < F.col("part") * (1 << 30))
    first = Window.partitionBy("lang").orderBy(order, "id", "text")
    sample = drawn.withColumn("n", F.row_number().over(first)).where(F.col("n") <= rows).select("id", "lang", "text")
    table = sample.mapInArrow(_examples, "id string, part int, lang string, bucket binary, n binary").toArrow()
    if not table.num_rows:
        return None
    table = table.sort_by([("lang", "ascending"), ("id", "ascending"), ("part", "ascending")])
    return _train(table["id"].to_pylist(), table["part"].to_numpy(), table["lang"].to_pylist(),
                  *([unsqueezed(x.as_py()).astype(np.int32) for x in table[c]] for c in ("bucket", "n")))


def _train(ids: list[str], part: np.ndarray, langs: list[str], bucket: list[np.ndarray],
           n: list[np.ndarray]) -> LangModel:
    languages = sorted(set(langs))
    y = np.array([languages.index(x) for x in langs])
    draw = np.array([random.Random(f"split {x}").random() for x in ids])
    held = draw < CALIBRATION
    if not held.any() or len(set(y[~held])) < len(languages):
        held = np.zeros(len(y), dtype=bool)
    rng = np.random.default_rng(SEED)
    embed = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    soft = rng.normal(0, 0.1, (WIDTH, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)

    def dense(rows: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), BUCKETS), dtype=np.float32)
        for i, r in enumerate(rows):
            x[i, bucket[r]] = n[r] / n[r].sum()
        return x

    # Rare languages weigh as much as common ones.
    per_class = np.bincount(y[~held], minlength=len(languages))
    weight = (len(y[~held]) / len(languages) / np.maximum(1, per_class)).astype(np.float32)
    train = np.flatnonzero(~held)
    steps, done = EPOCHS * -(-len(train) // BATCH), 0
    for _ in range(EPOCHS):
        rng.shuffle(train)
        for at in range(0, len(train), BATCH):
            rows = train[at:at + BATCH]
            x = dense(rows)
            hidden = x @ embed
            logits = hidden @ soft + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= weight[y[rows]][:, None] / len(rows)
            rate = np.float32(RATE * (1 - done / steps) * 40)
            grad = p @ soft.T
            soft -= np.float32(rate / 40) * (hidden.T @ p)
            bias -= np.float32(rate / 40) * p.sum(axis=0)
            embed -= rate * (x.T @ grad)
            done += 1
    model = LangModel(languages, (embed @ soft).astype(np.float64), bias.astype(np.float64))
    check = np.flatnonzero(held) if held.any() else train
    logits = np.array([(n[r] / n[r].sum()) @ model.weights[bucket[r]] + model.bias for r in check])
    best = (np.inf, 1.0)
    for temperature in np.geomspace(0.25, 8, 41):
        z = logits / temperature
        z = z - z.max(axis=1, keepdims=True)
        loss = float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(check)), y[check]]).mean())
        best = min(best, (loss, float(temperature)))
    model.temperature = best[1]
    z = np.exp((logits - logits.max(axis=1, keepdims=True)) / model.temperature)
    top = (z.max(axis=1) / z.sum(axis=1))[part[check] == 0]
    model.threshold = float(min(MAX_THRESHOLD, np.quantile(top, LOST))) if len(top) else 0.0
    return model


def predict(docs: DataFrame, model: LangModel | None, text: str = "text") -> DataFrame:
    """All columns of docs and lang_pred, lang_score, lang_rejected.

    A null text or one without a letter is `und` with score 0 and rejected, as is everything without a model; other
    texts get a learned language and its calibrated probability, and are rejected below the model's threshold.
    Whole texts are read. docs must have no columns of these names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            lang, score, rejected = [], [], []
            for value in batch.column(at).to_pylist():
                counts = subwords(value) if value and fitted else None
                if counts is None:
                    lang.append(UNKNOWN), score.append(0.0), rejected.append(True)
                    continue
                p = fitted.score(counts)
                best = int(p.argmax())
                lang.append(fitted.languages[best]), score.append(float(p[best]))
                rejected.append(bool(p[best] < fitted.threshold))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_())], [*columns, "lang_pred", "lang_score", "lang_rejected"])

    columns = docs.columns
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()),
                         StructField("lang_score", DoubleType()), StructField("lang_rejected", BooleanType())])
    return docs.mapInArrow(run, schema)


def fold(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """held_out: the crc32 of the id as text leaves 2 on division by 4; false for a null id."""
    return docs.withColumn("held_out", F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False)))
