"""Quality classifier: hashed word n-grams, logistic regression by FTRL.

A text is the sequence of its lower-cased words and punctuation runs; a word
that repeats the one before it becomes a repeat mark. Its one- and two-grams are
hashed into ``2 ** BITS`` slots; the features are their counts, scaled to length
one, and a constant. Training follows the regularised leader (FTRL-proximal) on
a bounded sample of labelled ids (of each its least text), dealt by a hash of the id
into ``SHARDS`` shards that Spark trains side by side; the shards' weights are averaged
by the rows they learned from, at most ``2 ** BITS`` of them reach the driver. Scores
are sparse dot products. The repeat mark makes one feature of all immediately repeated
words: which word repeats says nothing about quality, that words repeat does.

Defined cases: null and empty texts have only the constant feature; a label is 1
if the mean of the id's non-null labels is at least 0.5; rows without label or
id are scored and never learned from; without labelled rows every score is 0.5;
repeated rows are scored each; texts are read whole; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lokum.llm.common import by_bytes, col, give_back
from lokum.llm.langid import held_out

BITS = 18
SAMPLE_ROWS = 16_000   # labelled rows that are learned from (expected number)
SHARDS = 4
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.5
KNOWN_CHUNKS = 300_000
TOKEN = re.compile(r"\w+|[^\w\s]+")
REPEAT = 1             # hash of the repeat mark
CONSTANT = 0           # slot of the constant feature


class Features:
    """Hashed n-gram counts of whole texts; chunks met before are looked up."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, ...]] = {}

    def hashes(self, text: str) -> np.ndarray:
        chunks = text.lower().split()
        if len(self.known) > KNOWN_CHUNKS:
            self.known = {}
        known = self.known
        for c in chunks:
            if c not in known:
                known[c] = tuple(zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in TOKEN.findall(c))
        return np.fromiter(chain.from_iterable(map(known.__getitem__, chunks)), np.int64)

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(slots, values)"""
        h = self.hashes(text or "")
        if not len(h):
            return np.array([CONSTANT]), np.array([1.0])
        h[1:][h[1:] == h[:-1]] = REPEAT
        grams = np.concatenate((h, (h[:-1] * 1_000_003 + h[1:]) * 2_654_435_761 >> 11))
        slots, n = np.unique(grams % ((1 << BITS) - 1) + 1, return_counts=True)
        values = n / np.sqrt((n.astype(float) ** 2).sum())
        return np.concatenate(([CONSTANT], slots)), np.concatenate(([1.0], values))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights after per-coordinate FTRL-proximal updates in the order given."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(zs, ns):
        return np.where(np.abs(zs) <= L1, 0.0, (np.sign(zs) * L1 - zs) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    for _ in range(epochs):
        for slots, values, label in rows:
            zs, ns = z[slots], n[slots]
            w = weights(zs, ns)
            g = (sigmoid(w @ values) - label) * values
            more = ns + g * g
            z[slots] = zs + g - (np.sqrt(more) - np.sqrt(ns)) / ALPHA * w
            n[slots] = more
    return weights(z, n)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", learn_from: Column | None = None, sample_rows: int = SAMPLE_ROWS,
          shards: int = SHARDS) -> np.ndarray:
    """Weights. ``learn_from`` is a condition on the label table's id column."""
    lab = labels.where(col(id_col).isNotNull() & col(label_col).isNotNull())
    if learn_from is not None:
        lab = lab.where(learn_from)
    lab = (lab.groupBy(col(id_col).alias("id")).agg(F.avg(col(label_col)).alias("label"))
           .select("id", (F.col("label") >= 0.5).cast("double").alias("label")))
    rows = lab.count()
    unit = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30))
    sample = lab.where(unit < int(min(1.0, sample_rows / max(rows, 1)) * (1 << 30)))
    # about sample_rows rows of two numbers: bounded by the parameter. An id that many
    # rows share is learned from once
    learn = (docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
             .join(F.broadcast(sample), "id")
             .groupBy("id", "label").agg(F.min("text").alias("text"))
             .withColumn("turn", F.xxhash64(F.lit("turn"), F.col("id").cast("string")))
             .repartition(shards, F.pmod("turn", F.lit(shards))).sortWithinPartitions("turn", "text")
             .select("text", "label"))

    def run(batches):
        features, own = Features(), []
        for b in (part for whole in batches for part in by_bytes(whole, 0)):
            own += [(*features.of(t), y) for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        w = ftrl(own) if own else np.zeros(1 << BITS)
        at = np.flatnonzero(w)
        # slot -1 carries the shard's rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(([-1], at)).astype(np.int32)),
             pa.array(np.concatenate(([1.0], w[at])) * len(own))], ["slot", "w"])
        features = own = w = None
        give_back()

    got = learn.mapInArrow(run, "slot int, w double").groupBy("slot").agg(F.sum("w").alias("w")).toPandas()
    out = np.zeros(1 << BITS)
    learned = got["w"][got["slot"] == -1].sum()
    if learned:
        got = got[got["slot"] >= 0]
        out[got["slot"]] = got["w"] / learned
    return out


def score(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """rows(..., text last) with the text replaced by ``score``."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + ["score double"])

    def run(batches):
        w, features = shared.value, Features()
        for b in (part for whole in batches for part in by_bytes(whole, whole.num_columns - 1)):
            out = np.empty(b.num_rows)
            for r, t in enumerate(b.column(b.num_columns - 1)):
                slots, values = features.of(t.as_py())
                out[r] = w[slots] @ values
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sigmoid(out))],
                                             [*b.schema.names[:-1], "score"])
        features = None
        give_back()

    return rows.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", threshold: float = 0.5, **options) -> DataFrame:
    """doc_id, held_out, score, predicted. Learns from the labels that are not held out."""
    weights = train(docs, labels, id_col, text_col, label_col, learn_from=~held_out(col(id_col), 3, 1), **options)
    out = F.coalesce(held_out(col(id_col), 3, 1), F.lit(False))
    rows = docs.select(col(id_col).alias("doc_id"), out.alias("held_out"), col(text_col).alias("text"))
    return score(rows, weights).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
