"""Quality classifier: hashed word n-grams, logistic regression, FTRL updates.

Tokens are runs of letters/digits and runs of other signs; every token gives
a lower-case form and a shape form (letter case, sign class, "again" for a
repeat of the token before it).  Uni- and bigrams of both forms are hashed
into ``DIM`` weights with counts damped by a logarithm and scaled to length 1.  The
weights are learned by follow-the-regularised-leader (per-coordinate, L1 and L2) in
``SHARDS`` shards whose states are averaged after every round.  The state has a
fixed size (``DIM`` weights), whatever the corpus.

The fit takes at most ``max_rows`` labelled rows, those of the lowest hash, and
reads them whole, as scoring reads every text.

Defined results: null and empty texts get the score of the bias alone; rows
without a label are not learned from; a document with several labels counts
with their mean rounded; without labelled rows every score is 0.5; repeated rows are scored each.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import stored

DIM = 1 << 18
SHARDS = 6
ROUNDS = 3
MAX_ROWS = 12_000
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.5
THRESHOLD = 0.7
#: Words whose hashes a worker remembers, at most.
CACHE = 200_000

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


def _token_hashes(token: str) -> tuple[int, int]:
    """Hashes of a token's lower-case form and of its shape."""
    if token[0].isalnum() or token[0] == "_":
        kind = "U" if len(token) > 1 and token.isupper() else "C" if token[0].isupper() else "d" if token.isdigit() else "l"
        shape = kind + str(min(len(token), 15) // 4)
    else:
        shape = "s" + token[0] + str(min(len(token), 4))
    low = token.lower().encode("utf-8", "surrogatepass")
    return zlib.crc32(low) << 1 | 1, zlib.crc32(b"\x00" + shape.encode("utf-8", "surrogatepass")) << 1 | 1


def features(text: str | None, cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct feature numbers of a whole text and their values (length 1)."""
    tokens = _TOKEN.findall(text) if text else []
    if not tokens:
        return np.zeros(0, np.int64), np.zeros(0)
    pairs = []
    for t in tokens:
        h = cache.get(t)
        if h is None:
            h = _token_hashes(t)
            if len(cache) < CACHE:
                cache[t] = h
        pairs.append(h)
    h = np.array(pairs, dtype=np.uint64)
    words, shapes = h[:, 0], h[:, 1].copy()
    shapes[1:][words[1:] == words[:-1]] = np.uint64(7)  # the shape "again"
    grams = np.concatenate([words * _MIX, shapes * _MIX, words[:-1] * _PAIR + words[1:] * _MIX, shapes[:-1] * _PAIR + shapes[1:] * _MIX])
    grams = (grams ^ (grams >> np.uint64(29))) * _MIX
    counts = np.bincount((grams >> np.uint64(64 - 18)).astype(np.int64), minlength=1) if len(grams) > DIM else None
    if counts is None:
        index, n = np.unique((grams >> np.uint64(64 - 18)).astype(np.int64), return_counts=True)
    else:
        index = np.flatnonzero(counts)
        n = counts[index]
    value = np.log1p(n)
    return index, value / np.sqrt(value @ value)


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The leader's weights for the state (z, n)."""
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def ftrl_pass(rows, z: np.ndarray, n: np.ndarray) -> None:
    """One pass of updates over ``(index, value, label)`` rows, in place.  Slot ``DIM`` is the bias."""
    for index, value, label in rows:
        at, x = np.append(index, DIM), np.append(value, 1.0)
        w = weights_of(z[at], n[at])
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * x
        step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
        z[at] += g - step * w
        n[at] += g * g


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, max_rows: int) -> DataFrame:
    """``_shard, _text, _label``: the labelled rows to learn from, in a fixed order."""
    fit = F.crc32(F.col("_id").cast("string")) % 4 != 2
    known = (labels.select(F.col(doc_id).alias("_id"), F.col(label).alias("_l")).where(F.col("_l").isNotNull() & F.col("_id").isNotNull())
             .where(fit).groupBy("_id").agg(F.round(F.avg("_l")).cast("int").alias("_label"))
             .withColumn("_h", F.xxhash64("_id")).orderBy("_h", "_id").limit(max_rows))
    # at most max_rows ids of one number each: a bounded broadcast
    return (docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(known), "_id")
            .groupBy("_id", "_h", "_label").agg(F.min("_text").alias("_text"))
            .withColumn("_shard", (F.pmod(F.col("_h"), F.lit(SHARDS))).cast("int")))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        max_rows: int = MAX_ROWS) -> np.ndarray:
    """``DIM + 1`` weights.  Each round's shards run as Spark tasks from the averaged state."""
    spark = docs.sparkSession
    rows = stored(training_rows(docs, labels, doc_id, text, label, max_rows), "quality-fit")
    z, n = np.zeros(DIM + 1), np.zeros(DIM + 1)
    for turn in range(ROUNDS):
        state = spark.sparkContext.broadcast((z, n))

        def learn(pdf: pd.DataFrame) -> pd.DataFrame:
            zs, ns = (a.copy() for a in state.value)
            cache: dict = {}
            pdf = pdf.sort_values(["_h", "_id"]).sample(frac=1, random_state=turn)
            ftrl_pass(((*features(t, cache), y) for t, y in zip(pdf["_text"], pdf["_label"])), zs, ns)
            return pd.DataFrame({"rows": [len(pdf)], "z": [zs.astype("<f8").tobytes()], "n": [ns.astype("<f8").tobytes()]})

        # SHARDS rows of fixed size come back
        found = rows.groupBy("_shard").applyInPandas(learn, "rows long, z binary, n binary").collect()
        state.unpersist()
        if not found:
            break
        total = sum(r["rows"] for r in found)
        z = sum(np.frombuffer(r["z"]) * (r["rows"] / total) for r in found)
        n = sum(np.frombuffer(r["n"]) * (r["rows"] / total) for r in found)
    return weights_of(z, n)


def score(docs: DataFrame, weights: np.ndarray, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``score`` of every whole text, a sparse dot product."""
    names = [f"_k{i}" for i in range(len(keep))]
    src = docs.select(*[docs[c].alias(a) for c, a in zip(keep, names)], docs[text].cast("string").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))  # fixed size

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, cache = shared.value, {}
        for b in batches:
            margins = np.empty(len(b))
            for i, t in enumerate(b.pop("_text")):
                index, value = features(t, cache)
                margins[i] = w[index] @ value + w[DIM]
            yield b.assign(score=1 / (1 + np.exp(-np.clip(margins, -35, 35))))

    types = dict(src.dtypes)
    out = src.mapInPandas(predict, ", ".join(f"{a} {types[a]}" for a in names) + ", score double")
    return out.withColumnsRenamed(dict(zip(names, keep)))


__all__ = ["features", "ftrl_pass", "weights_of", "fit", "score", "DIM", "MAX_ROWS", "THRESHOLD"]
