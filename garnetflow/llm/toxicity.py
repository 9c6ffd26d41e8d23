"""Toxicity by a factorization machine over hashed terms.

A text's terms are its words and their beginnings of 4, 5 and 6 bytes (so that inflected forms of a word share
a term), hashed to 2**BITS places; a term counts once. The score is the logistic of a bias, a weight for each
term and, for each pair of terms, the product of their factors: what two terms mean together, such as an
insult beside a mention of a group, is learned though each alone may mean little. Weights are
learned with a proximal step that leaves most at zero, factors with a penalty; terms that keep neither are
dropped, so a scoring task holds a table of bits and a few thousand rows.

Learning takes labelled rows in the order of a hash of doc_id: at most TRAIN_ROWS, and no more than hold PLACES pairs of row and
term. Terms are counted where they are, and the driver gets the pairs of all terms that LEAST_DOCS of these rows share, so
both its rows and its bytes are bounded, however long the texts are, and no term that may tell something is left out. Two models of half of the rows each score the other half, and the cut that parts the labels best
in these scores becomes 0.5, the nearer the more toxic rows there are (TRUST). Every document is scored, whole.

Cases: null counts as empty text and gets the score of the bias; labels that are null are no labels; of
repeated labels of a doc_id the largest counts; without labels of both classes each score is the
share of toxic ones (0 without any); each row of docs gives one row; other columns pass through
reject() as they are and are ignored by the query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, give_back, slices, tidy, written
from .decontaminate import Words, _B, _buffer, _runs

BITS = 20
TRAIN_ROWS = 16_000
#: Pairs of row and term of the labelled rows that are learned from: the driver holds 4 bytes for each whose term several rows share.
PLACES = 12_000_000
FACTORS = 4
EPOCHS = 6
BATCH = 256
LEAST_DOCS = 3
SURE = 3.0
#: Toxic rows from which the calibrated cut counts half.
TRUST = 100
REFITS = 200
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def terms_of(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """The text and the place of each term, with repeats."""
    raw = w.bytes.astype(np.uint64)
    docs, places = [w.doc], [w.hashes >> np.uint64(64 - BITS)]
    long = w.ends - w.starts
    for n in (4, 5, 6):
        at = np.flatnonzero(long >= n)
        h = _runs(raw, _B, w.starts[at], w.starts[at] + n) * np.uint64(0x9E3779B97F4A7C15 + 2 * n)
        h ^= h >> np.uint64(32)
        docs.append(w.doc[at])
        places.append((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS))
    return np.concatenate(docs), np.concatenate(places).astype(np.int64)


def distinct(docs: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(docs.astype(np.int64) << BITS | places)
    return keys >> BITS, keys & ((1 << BITS) - 1)


@dataclass
class Model:
    """places, weights and factors of the terms that count, in ascending order of place."""

    bias: float
    places: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def __post_init__(self):
        self.active = np.zeros(1 << BITS, bool)
        self.active[self.places] = True

    def scores(self, column: pa.Array) -> np.ndarray:
        docs, places = terms_of(Words(*_buffer(column)))
        keep = self.active[places]
        return self.scored(*distinct(docs[keep], places[keep]), len(column))

    def scored(self, docs: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
        """The scores of n texts from their distinct active places."""
        at = np.searchsorted(self.places, places)
        z = self.bias + np.bincount(docs, self.weights[at], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f]
            z += 0.5 * (np.bincount(docs, v, n) ** 2 - np.bincount(docs, v * v, n))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Learns from the distinct places of each text. Same rows, same model."""
    none = Model(0.0, np.empty(0, np.int64), np.empty(0), np.empty((0, FACTORS)))
    if len(labels) == 0 or labels.min() == labels.max():
        none.bias = 35.0 if len(labels) and labels[0] else -35.0
        return none
    seen = np.zeros(1 << BITS, np.int64)
    for t in texts:
        seen[t] += 1  # the places of a text are distinct
    kept = np.flatnonzero(seen >= LEAST_DOCS)
    m, of = len(kept), np.full(1 << BITS, -1, np.int32)
    of[kept] = np.arange(m)
    texts = [t[t >= 0] for t in (of[t] for t in texts)]
    random = np.random.default_rng(seed)
    v = random.normal(0, 0.01, (m, FACTORS))
    gv = np.full((m, FACTORS), 1e-2)
    z, nn, w = np.zeros(m), np.zeros(m), np.zeros(m)
    share = labels.mean()
    bias = float(np.log(share / (1 - share)))
    # over one pass a term's summed gradient strays by about the root of its documents: SURE times that is no evidence
    l1, l2, alpha, passes = SURE * np.sqrt(seen[kept] * share * (1 - share)), 1.0, 0.3, 0.0
    for _ in range(EPOCHS):
        order = random.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            n, passes = len(rows), passes + len(rows) / len(order)
            ids, doc = np.concatenate([texts[r] for r in rows]), np.repeat(np.arange(n), [len(texts[r]) for r in rows])
            vi = v[ids]
            s = np.stack([np.bincount(doc, vi[:, f], n) for f in range(FACTORS)], axis=1)
            out = bias + np.bincount(doc, w[ids], n) + 0.5 * ((s**2).sum(1) - np.bincount(doc, (vi**2).sum(1), n))
            p = 1 / (1 + np.exp(-np.clip(out, -35, 35)))
            g = p - labels[rows]
            gi = np.bincount(ids, g[doc], m)
            # weights: FTRL-proximal, with a threshold that grows as the sums do
            sigma = (np.sqrt(nn + gi**2) - np.sqrt(nn)) / alpha
            z += gi - sigma * w
            nn += gi**2
            least = l1 * max(passes, passes**0.5)
            w = np.where(np.abs(z) <= least, 0.0, -(z - np.sign(z) * least) / ((1.0 + np.sqrt(nn)) / alpha + l2))
            # factors: AdaGrad on the mean gradient, with a penalty
            scale = g[doc] / n
            for f in range(FACTORS):
                d = np.bincount(ids, scale * (s[doc, f] - vi[:, f]), m) + 2e-4 * v[:, f]
                gv[:, f] += d**2
                v[:, f] -= 0.02 * d / np.sqrt(gv[:, f])
            bias -= 0.5 * g.sum() / ((p * (1 - p)).sum() + 1)
    strong = np.abs(v).max(1) >= 0.05
    counts = np.flatnonzero((w != 0) | strong)
    v[~strong] = 0
    return _refit(bias, kept[counts], w[counts], v[counts], counts, m, texts, labels)


def _refit(bias: float, places: np.ndarray, w: np.ndarray, v: np.ndarray, counts: np.ndarray, m: int, texts: list[np.ndarray], labels: np.ndarray) -> Model:
    """The chosen terms again, without the threshold that held their weights back: AdaGrad over all rows at once."""
    of = np.full(m, -1, np.int32)
    of[counts] = np.arange(len(counts))
    texts = [t[t >= 0] for t in (of[t] for t in texts)]
    n, m = len(texts), len(counts)
    ids, doc = np.concatenate(texts), np.repeat(np.arange(n), [len(t) for t in texts])
    cost = np.where(labels > 0, np.sqrt((labels == 0).sum() / labels.sum()), 1.0)  # a miss weighs more than a false alarm
    cost *= n / cost.sum()
    gw, gv = np.full(m, 1e-4), np.full(v.shape, 1e-4)
    for _ in range(REFITS):
        vi = v[ids]
        s = np.stack([np.bincount(doc, vi[:, f], n) for f in range(FACTORS)], axis=1)
        out = bias + np.bincount(doc, w[ids], n) + 0.5 * ((s**2).sum(1) - np.bincount(doc, (vi**2).sum(1), n))
        p = 1 / (1 + np.exp(-np.clip(out, -35, 35)))
        g = cost * (p - labels)
        d = (np.bincount(ids, g[doc], m) + w) / n
        gw += d**2
        w = w - 0.3 * d / np.sqrt(gw)
        for f in range(FACTORS):
            d = (np.bincount(ids, g[doc] * (s[doc, f] - vi[:, f]), m) + v[:, f]) / n
            gv[:, f] += d**2
            v[:, f] -= 0.05 * d / np.sqrt(gv[:, f])
        bias -= 0.5 * g.sum() / ((cost * p * (1 - p)).sum() + 1)
    return Model(bias, places, w, v)


def within(sizes: np.ndarray, most: int) -> int:
    """How many rows are learned from: as many as hold `most` pairs, one at least."""
    return max(1, int(np.searchsorted(np.cumsum(sizes), most, side="right")))


def calibrated(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """A model of all rows whose 0.5 is the cut that parts the labels best when each half is scored by a model of the other."""
    model = fit(texts, labels, seed)
    half = np.random.default_rng(seed).permutation(len(labels)) % 2 == 0
    if any(len(np.unique(labels[h])) < 2 for h in (half, ~half)):
        return model
    out = np.empty(len(labels))
    for h in (half, ~half):
        other = fit([texts[k] for k in np.flatnonzero(~h)], labels[~h], seed)
        rows = [t[other.active[t]] for t in (texts[k] for k in np.flatnonzero(h))]
        out[h] = other.scored(np.repeat(np.arange(len(rows)), [len(t) for t in rows]), np.concatenate(rows).astype(np.int64), len(rows))
    # F2 for a cut after each row: a miss weighs more than a false alarm
    order = np.argsort(-out, kind="stable")
    toxic = labels[order] > 0
    k = int(np.argmax(5 * np.cumsum(toxic) / (np.arange(1, len(order) + 1) + 4 * toxic.sum())))
    low = out[order[k + 1]] if k + 1 < len(order) else 0.0
    cut = np.clip((out[order[k]] + low) / 2, 0.02, 0.98)
    # few toxic rows say little of where the cut is: the step towards it grows with them
    model.bias -= float(np.log(cut / (1 - cut)) * toxic.sum() / (toxic.sum() + TRUST))
    return model


def held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS, places: int = PLACES, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model:
    """A model from at most `most` labelled rows that are not held out, and no more than hold `places` pairs of row and term."""
    spark = docs.sparkSession
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(toxic).cast("int").alias("toxic")).dropna()
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()  # `most` rows at most
    if not rows:
        return fit([], np.empty(0))
    known = spark.createDataFrame(rows, "doc_id long, toxic int")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            d, p = distinct(*terms_of(Words(*_buffer(batch.column(2)))))
            cuts = np.searchsorted(d, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([p[a:b].astype("<i4").tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())], ["doc_id", "toxic", "places"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                seen[np.frombuffer(blob, "<i4")] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], ["place", "seen"])

    found = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(known), "doc_id").select("doc_id", F.col("toxic").alias("toxic"), "text")
    found = found.mapInArrow(tidy(terms), "doc_id long, toxic int, places binary")
    # repeated rows of a document would lift the bound: the first of equal ids is taken
    table = found = written(found.groupBy("doc_id", "toxic").agg(F.min("places").alias("places")), "terms")
    sizes = found.orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id", (F.length("places") / 4).cast("long").alias("n")).toArrow()  # `most` rows
    last = sizes["doc_id"][within(np.asarray(sizes["n"]), places) - 1].as_py() if sizes.num_rows else 0
    rank = F.struct(F.xxhash64("doc_id").alias("h"), F.col("doc_id").alias("d"))
    found = found.where(rank <= F.struct(F.xxhash64(F.lit(last).cast("long")).alias("h"), F.lit(last).cast("long").alias("d")))
    counts = found.select("places").mapInArrow(tidy(count), "place int, seen long").groupBy("place").agg(F.sum("seen").alias("seen"))
    take = np.zeros(1 << BITS, bool)
    take[np.asarray(counts.where(F.col("seen") >= LEAST_DOCS).toArrow()["place"])] = True  # 2**BITS rows at most
    shared = spark.sparkContext.broadcast(np.packbits(take))

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            blobs = [at[own[at]].tobytes() for at in (np.frombuffer(b, "<i4") for b in batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], batch.schema.names)

    got = found.mapInArrow(tidy(narrow), found.schema).toArrow().sort_by("doc_id")  # `most` rows and `places` pairs at most
    discard(table)
    texts, toxic = [np.frombuffer(b, "<i4") for b in got["places"].to_pylist()], (np.asarray(got["toxic"]) > 0).astype(float)
    del got
    model = calibrated(texts, toxic)
    del texts
    give_back()  # the driver goes on to other stages
    return model


def _scored(docs: DataFrame, model: Model, text: str, keep: bool, schema) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            names = batch.schema.names
            score = shared.value.scores(batch.column(names.index(text)))
            if keep:
                yield batch.filter(pa.array(score < 0.5))
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], [c.split()[0] for c in SCHEMA.split(", ")])

    return docs.mapInArrow(tidy(run), schema)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, whether the row was held out from learning, the score and the predicted label."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out(F.col(doc_id).cast("long")), F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    return _scored(rows, model, "text", False, SCHEMA)


def reject(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs without the rows that are predicted toxic."""
    return _scored(docs, model, text, True, docs.schema)
