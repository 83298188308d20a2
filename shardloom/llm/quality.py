"""Quality classifier by compression.

One Zstandard dictionary is built from good labelled text and one from bad. A text is cut into blocks, each
block is compressed with either dictionary, and the difference of the two sizes, divided by their sum, tells
which kind of text it resembles. A logistic fit on labelled rows that the dictionaries have not seen turns it
into a probability; the compressed share of the text and its length, which say how far the difference can be
trusted, are the other two inputs of the fit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import by_batch, column_of
from shardloom.session import as_written

BLOCK = 2048
LEVEL = 3
DICT_BYTES = 262_144
#: Bound of the fit: labelled rows of either class, one half for the dictionaries, the other for the calibration.
FIT_ROWS = 4_000
#: Blocks of either class that a dictionary is built from. Sizes and builder settings were chosen on training folds.
DICT_BLOCKS = 4_000
THRESHOLD = 0.3


def blocks_of(text: bytes, size: int = BLOCK) -> list[bytes]:
    """The whole text in blocks of ``size`` bytes; a last piece below half a block joins the one before."""
    ends = list(range(size, max(size, len(text) - size // 2), size))
    return [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)])]


def _coder(content: bytes):
    kind = zstandard.DICT_TYPE_AUTO if content[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    words = zstandard.ZstdCompressionDict(content, dict_type=kind)
    words.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=False, write_dict_id=False,
                                    write_checksum=False)


class Features:
    """Size difference, compressed share and length of texts under two dictionaries."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.good, self.bad = _coder(good), _coder(bad)

    def of(self, text: bytes) -> tuple[float, float, float]:
        g = b = 0
        for block in blocks_of(text):
            g += len(self.good.compress(block))
            b += len(self.bad.compress(block))
        return (b - g) / (b + g), float(np.log((g + b) / (2 * len(text) + 16))), float(np.log1p(len(text)))


def build_dictionary(blocks: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A Zstandard dictionary from sample blocks; their bare bytes where they are too few to train on."""
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, blocks)) // 8)), blocks, k=128, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-size:]


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the calibration; ``weights`` belong to 1 and the standardised features."""

    good: bytes
    bad: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]

    def scores(self, features: np.ndarray) -> np.ndarray:
        x = expanded((features - np.array(self.mean)) / np.array(self.scale))
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights), -40, 40)))


def expanded(x: np.ndarray) -> np.ndarray:
    """1, the standardised features within five deviations, and the squares of the first two."""
    x = np.clip(x, -5, 5)
    return np.column_stack([np.ones(len(x)), x, x[:, 0] ** 2, x[:, 1] ** 2])


def calibrate(features: np.ndarray, good: np.ndarray, weight: np.ndarray, penalty: float = 1.0, rounds: int = 30):
    """Mean, scale and weights of a ridge logistic fit."""
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = expanded((features - mean) / scale)
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [penalty] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (good - p)) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(mean.tolist()), tuple(scale.tolist()), tuple(w.tolist())


def _feature_frame(texts: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    """``(label, d, share, size)`` of labelled texts, computed where they are."""
    state: list[Features] = []

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        if not state:
            state.append(Features(good, bad))
        f = np.array([state[0].of((t.as_py() or "").encode()) for t in column_of(batch, "text")])
        return {"label": column_of(batch, "label"), "d": pa.array(f[:, 0]), "share": pa.array(f[:, 1]), "size": pa.array(f[:, 2])}

    return texts.select("label", "text").mapInArrow(
        by_batch(make, ["label", "d", "share", "size"]), "label int, d double, share double, size double")


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_id: str = "doc_id", label_col: str = "quality", fit_rows: int = FIT_ROWS,
                dict_blocks: int = DICT_BLOCKS) -> QualityModel:
    """Learn from at most ``fit_rows`` labelled rows of either class, drawn by a hash of the id.

    Whole texts are used; of one class's blocks ``dict_blocks`` enter the dictionary. Where a document has
    several labels the least counts; labels other than 0 and 1 are ignored. Without labels of both classes all
    texts score the smoothed share of label 1.
    """
    known = labels.select(F.col(label_id).alias("__id"), F.col(label_col).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("__id").isNotNull()).groupBy("__id").agg(F.min("label").alias("label"))
    known = as_written(known.withColumn("h", F.xxhash64(F.lit("quality"), "__id")), "labels")
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
    base = float(np.log(prior / (1 - prior)))
    flat = QualityModel(b"a" * 16, b"b" * 16, (0.0,) * 3, (1.0,) * 3, (base, 0.0, 0.0, 0.0, 0.0, 0.0))
    if len(totals) < 2:
        return flat
    drawn = known.filter("label = 0").orderBy("h", "__id").limit(fit_rows).union(
        known.filter("label = 1").orderBy("h", "__id").limit(fit_rows))
    texts = as_written(
        docs.select(F.col(id_col).alias("__doc"), F.col(text_col).cast("string").alias("text"))
        .join(F.broadcast(drawn), F.col("__doc") == F.col("__id"))
        .select("label", "text", "h", (F.pmod(F.col("h"), F.lit(2)) == 0).alias("for_dict")), "labelled-texts")
    size = F.lit(BLOCK)
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.length("text") - 1, F.lit(0)), size))
    pieces = texts.filter("for_dict and text != ''").select("label", "h", "text", starts.alias("at")).select(
        "label", F.substring(F.col("text"), F.col("at") + 1, size).alias("piece"), F.xxhash64("h", "at").alias("o"))
    pieces = as_written(pieces, "blocks")
    dicts = {}
    for label in (0, 1):
        rows = pieces.filter(F.col("label") == label).orderBy("o", "piece").limit(dict_blocks).collect()
        dicts[label] = build_dictionary([r["piece"].encode() for r in rows]) if rows else b"a" * 16
    rows = _feature_frame(texts.filter("not for_dict"), dicts[1], dicts[0]).toArrow()
    y = rows.column("label").to_numpy()
    if len(set(y.tolist())) < 2:
        return flat
    f = np.column_stack([rows.column(c).to_numpy() for c in ("d", "share", "size")])
    weight = np.where(y == 1, totals[1] / (y == 1).sum(), totals[0] / (y == 0).sum())
    order = np.lexsort((f[:, 2], f[:, 1], f[:, 0], y))
    fit = calibrate(f[order], y[order].astype(float), weight[order] * len(y) / weight.sum())
    return QualityModel(dicts[1], dicts[0], *fit)


def quality_scores(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, score`` (0 to 1, higher: label 1 likelier), ``size_difference``.

    Every whole text is scored where it lies, by its text alone; null and empty texts score like a text of no
    bytes. Repeated rows repeat; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    state: list[Features] = []

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        if not state:
            state.append(Features(sent.value.good, sent.value.bad))
        f = np.array([state[0].of((t.as_py() or "").encode()) for t in column_of(batch, "text")])
        return {"doc_id": column_of(batch, "doc_id"), "score": pa.array(sent.value.scores(f)), "size_difference": pa.array(f[:, 0])}

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        by_batch(make, ["doc_id", "score", "size_difference"]),
        f"doc_id {dict(docs.dtypes)[id_col]}, score double, size_difference double")
