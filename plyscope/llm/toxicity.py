"""Toxicity by compression distance: how well text packs with a toxic and with an ordinary zstandard dictionary.

A window is one word, set into a carrier phrase that both dictionaries know, so that it is long enough to be
compressed; its two compressed lengths (one for each dictionary) are its coordinates. The thresholds
on them are calibrated on labelled texts that the dictionaries have not seen: every pair of lengths gets the log of
how much likelier toxic texts have such a window. A text's strongest windows go into a logistic regression.

The fit uses a bounded sample of labelled rows: at most ``toxic_rows`` toxic and ``ordinary_rows`` ordinary texts,
those with the smallest hash of their id. Half of them train the dictionaries, half the calibration. All rows are
scored, over their whole text. NULL text counts as empty; a text without words gets the score of no evidence.
Without any toxic or any ordinary training row all scores are 0. Rows are kept as they are, repeated ones too; other
columns are carried along and a column called ``score`` is replaced. Ids with several labels count as toxic if one
of them does.
"""

from __future__ import annotations

import functools
import math
import pickle
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard as zs
from pyspark.sql import Column, DataFrame, functions as F, types as T

TOXIC_ROWS = 1000
ORDINARY_ROWS = 2000
TOXIC_BYTES, ORDINARY_BYTES = 8_192, 12_288
LEVEL = 19
STRONGEST = 8
LONGEST = 64
#: Ordinary rows weigh so many times as much as toxic ones in the regression, all together.
ORDINARY_WEIGHT = 4.5
#: Weights of the regression are held to a normal distribution of variance 1, which matters where labels are few.
RIDGE = 1.0
CACHED_WORDS = 400_000
THRESHOLD = 0.7
CARRIERS = (b"it is said that  %b  %b ",)

_PLAIN = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?|\"'()[]{}<>*_#", bytes(range(97, 123)) + b" " * 20)


def windows(data: bytes) -> set[bytes]:
    """The distinct words of a text in UTF-8."""
    return set(data.translate(_PLAIN).split())


def _framed(word: bytes, carrier: bytes) -> bytes:
    return carrier.replace(b"%b", word)


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; where there is too little to train on, the samples themselves."""
    try:
        return zs.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zs.ZstdError:
        return b"".join(samples)[-size:] or b" " * 8


def _packer(content: bytes) -> zs.ZstdCompressor:
    trained = content[:4] == b"\x37\xa4\x30\xec"  # the mark of a trained dictionary
    data = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_FULLDICT if trained else zs.DICT_TYPE_RAWCONTENT)
    how = zs.ZstdCompressionParameters(
        window_log=14, chain_log=13, hash_log=10, search_log=5, min_match=3, target_length=128, strategy=zs.STRATEGY_BTULTRA,
        write_content_size=0, write_dict_id=0, write_checksum=0,
    )
    data.precompute_compress(compression_params=how)
    return zs.ZstdCompressor(dict_data=data, compression_params=how)


class Scorer:
    """A fitted model inside a task."""

    def __init__(self, model: dict):
        self.model = model
        self.pairs = [tuple(map(_packer, p)) for p in model["dictionaries"]]
        self.known: dict[bytes, float] = {}

    def cells(self, word: bytes) -> list[int]:
        out = []
        for carrier, (toxic, ordinary) in zip(CARRIERS, self.pairs, strict=True):
            framed = _framed(word, carrier)
            a, b = len(toxic.compress(framed)), len(ordinary.compress(framed))
            out.append(min(b, LONGEST - 1) * LONGEST + min(a, LONGEST - 1))
        return out

    def evidence(self, word: bytes) -> float:
        found = self.known.get(word)
        if found is None:
            found = float(sum(t[c] for t, c in zip(self.model["tables"], self.cells(word), strict=True)))
            if len(self.known) < CACHED_WORDS:
                self.known[word] = found
        return found

    def features(self, data: bytes) -> np.ndarray:
        words = windows(data)
        known = self.known
        try:
            e = np.fromiter(map(known.__getitem__, words), float, len(words))
        except KeyError:
            e = np.fromiter(map(self.evidence, words), float, len(words))
        return summary(e)

    def score(self, data: bytes) -> float:
        x = (self.features(data) - self.model["mean"]) / self.model["spread"]
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, float(x @ self.model["weights"][:-1] + self.model["weights"][-1])))))


def summary(e: np.ndarray) -> np.ndarray:
    top = np.zeros(STRONGEST)
    best = np.sort(e[np.argpartition(-e, STRONGEST)[:STRONGEST]] if len(e) > STRONGEST else e)[::-1]
    top[: len(best)] = best
    return np.array([top[0], top[1], top[2], top[:5].mean(), math.log1p(len(e))])


def train(texts: list[bytes], toxic: np.ndarray) -> dict | None:
    """The model of a sample of texts with labels."""
    toxic = toxic.astype(bool)
    if not toxic.any() or toxic.all():
        return None
    where = [np.flatnonzero(toxic), np.flatnonzero(~toxic)]
    build = [w[::2] if len(w) > 1 else w for w in where]
    tune = [w[1::2] if len(w) > 1 else w for w in where]
    sets = {int(i): windows(texts[i]) for w in where for i in w}
    counts = [Counter(w for i in side for w in texts[i].translate(_PLAIN).split()) for side in build]
    having = [Counter(w for i in side for w in sets[int(i)]) for side in build]
    lean = {w: math.log((n + 0.5) / (having[1][w] + 0.5) * len(build[1]) / len(build[0])) for w, n in sorted(having[0].items())}  # sorted: sets have no fixed order
    marked = [w for w, x in lean.items() if x > 2.5 and having[0][w] >= 5] or sorted(lean, key=lean.get, reverse=True)[:200]
    rng = np.random.default_rng(0)
    dictionaries = []
    for carrier in CARRIERS:
        own = [_framed(w, carrier) for w in marked for _ in range(min(counts[0][w], 30))]
        plain = [_framed(w, carrier) for w, n in counts[1].most_common(30_000) for _ in range(min(n, 10))]
        own, plain = ([side[i] for i in rng.permutation(len(side))] for side in (own, plain))
        dictionaries.append((_dictionary(own, TOXIC_BYTES), _dictionary(plain[:150_000], ORDINARY_BYTES)))
    model = {"dictionaries": dictionaries, "tables": [np.zeros(LONGEST * LONGEST)] * len(CARRIERS)}
    scorer, cells = Scorer(model), {}
    for side in tune:
        for i in side:
            for w in sets[int(i)]:
                if w not in cells:
                    cells[w] = scorer.cells(w)
    tables = []
    for j in range(len(CARRIERS)):
        seen = [np.zeros(LONGEST * LONGEST) for _ in tune]
        for side, hist in zip(tune, seen, strict=True):
            for i in side:
                hist[list({cells[w][j] for w in sets[int(i)]})] += 1
        tables.append(np.log((seen[0] + 0.5) / (len(tune[0]) + 1) / ((seen[1] + 0.5) / (len(tune[1]) + 1))))
    model["tables"] = tables
    strength = {w: sum(t[c] for t, c in zip(tables, found, strict=True)) for w, found in cells.items()}
    x = np.array([summary(np.array([strength[w] for w in sets[int(i)]])) for side in tune for i in side])
    y = np.repeat([1.0, 0.0], [len(side) for side in tune])
    weight = np.where(y == 1, 1.0, ORDINARY_WEIGHT * len(tune[0]) / len(tune[1]))
    model["mean"], model["spread"] = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.c_[(x - model["mean"]) / model["spread"], np.ones(len(x))]
    w = np.zeros(x.shape[1])
    prior = RIDGE * np.r_[np.ones(len(w) - 1), 1e-6]  # on all but the constant
    for _ in range(50):  # Newton steps
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(prior)
        w = w - np.linalg.solve(curve, x.T @ (weight * (p - y)) + prior * w)
    model["weights"] = w
    return model


def is_held_out(key: Column) -> Column:
    """Rows without an id are not held out."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS) -> bytes | None:
    """The pickled model of the training rows, or None where a class has none. It is made in one task from the bounded sample."""
    known = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("toxic")).where("key is not null and toxic is not null")
    known = known.groupBy("key").agg(F.max("toxic").alias("toxic")).where(~is_held_out(F.col("key")))
    chosen = [
        known.where(which).orderBy(F.xxhash64("key"), "key").limit(n) for which, n in (("toxic = 1", toxic_rows), ("toxic <> 1", ordinary_rows))
    ]
    sample = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    # the ids are at most toxic_rows + ordinary_rows
    sample = sample.join(F.broadcast(chosen[0].unionByName(chosen[1])), "key").groupBy("key", "toxic").agg(F.min("text").alias("text"))

    def learn(frames):
        rows = pd.concat(list(frames), ignore_index=True).sort_values("key")
        model = train([t.encode() for t in rows["text"]], rows["toxic"].to_numpy() == 1)
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    made = sample.coalesce(1).mapInPandas(lambda frames: learn(frames), "model binary") if not sample.isEmpty() else None
    data = bytes(made.first()["model"]) if made is not None else None
    return data if data is not None and pickle.loads(data) is not None else None


@functools.lru_cache(maxsize=1)
def _scorer(model: bytes) -> Scorer:
    return Scorer(pickle.loads(model))


def score(docs: DataFrame, model: bytes | None, text: str = "text") -> DataFrame:
    """The rows with ``score`` between 0 and 1."""
    carried = [f.name for f in docs.schema.fields if f.name.lower() != "score"]
    if model is None:
        return docs.select(*[F.col(f"`{c}`") for c in carried], F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two pairs of dictionaries and tables: a fixed size
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("_text"))
    out = T.StructType([*rows.schema.fields[:-1], T.StructField("score", T.DoubleType())])

    def mark(batches):
        scorer = _scorer(shared.value)
        for batch in batches:
            found = [scorer.score(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, type=pa.float64())], names=out.names)

    return rows.mapInArrow(mark, out).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], "score")
