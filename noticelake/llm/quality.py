"""Quality classifier by compression.

Two zstandard dictionaries are built, one from texts labelled good and one from texts labelled
bad. A text is compressed with both. How much larger the bad dictionary leaves it, as a share
of the larger size, is its evidence, and a logistic curve, fitted to labelled texts that no
dictionary has seen, turns that into a score from 0 to 1.

Fitting takes a bounded sample: of at most ``dictionary_docs`` texts per class each gives one
piece, equal pieces add up to ``sample_chars`` characters, and from them a dictionary of
``dictionary_bytes`` is built; ``calibration_docs`` texts shape the curve. Scoring reads every
text whole. Label, language, source and id are never inputs of a score.

A null text counts as empty, and an empty text has evidence 0. Null ids and null or other
labels teach nothing; an id labelled twice teaches twice. Without labels of both classes
every score is 0.5. Repeated rows are scored alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.llm.common import packed, settled

DICTIONARY_DOCS = 600
SAMPLE_CHARS = 600_000
DICTIONARY_BYTES = 112_000
CALIBRATION_DOCS = 20_000
LEVEL = 3
# Pieces are cut into samples of this many bytes for the builder.
_SAMPLE_BYTES = 2000


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float

    def evidence(self):
        """A function of UTF-8 texts; its two compressors are made where it is called."""

        def compressor(content: bytes):
            data = zstandard.ZstdCompressionDict(content)
            return zstandard.ZstdCompressor(LEVEL, data, write_content_size=False, write_dict_id=False)

        good, bad = compressor(self.good), compressor(self.bad)

        def of(raw: bytes) -> float:
            if not raw:
                return 0.0
            with_good, with_bad = len(good.compress(raw)), len(bad.compress(raw))
            return (with_bad - with_good) / max(with_bad, with_good)

        return of


def _evidence(model: Model) -> callable:
    @F.arrow_udf("double")
    def evidence(texts: pa.Array) -> pa.Array:
        of = model.evidence()
        return pa.array([of(t.as_py() or b"") for t in texts.cast(pa.binary())], pa.float64())

    return evidence


def build_dictionary(pieces: list[bytes], size: int) -> bytes:
    """A dictionary of the pieces; where they are too few to build one, the pieces themselves."""
    samples = [p[i : i + _SAMPLE_BYTES] for p in pieces for i in range(0, len(p), _SAMPLE_BYTES)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        whole = b"\n".join(pieces)[-size:]
        return whole if len(whole) >= 8 else b""


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset by Newton steps, with a faint pull to zero that keeps them finite."""
    scale = float(np.std(x)) or 1.0
    design, beta, ridge = np.column_stack([x / scale, np.ones_like(x)]), np.zeros(2), 1e-3 * np.eye(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (y - p) - ridge @ beta
        curve = (design * (p * (1 - p))[:, None]).T @ design + ridge
        beta = beta + np.clip(np.linalg.solve(curve, slope), -5, 5)
    return float(beta[0] / scale), float(beta[1])


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 3."""
    return F.crc32(id_col.cast("string")) % 3


def fit(
    docs: DataFrame,
    labels: DataFrame,
    dictionary_docs: int = DICTIONARY_DOCS,
    sample_chars: int = SAMPLE_CHARS,
    dictionary_bytes: int = DICTIONARY_BYTES,
    calibration_docs: int = CALIBRATION_DOCS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model | None:
    """Folds 0 and 2 of the labelled ids teach: the first fills dictionaries, the other the curve."""
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).where(
        "_id IS NOT NULL AND _label IN (0, 1)"
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    order = F.xxhash64("_id")

    def sample(which: int, rows: int, label: int | None = None) -> DataFrame:
        chosen = marked.where(fold(F.col("_id")) == which)
        if label is not None:
            chosen = chosen.where(F.col("_label") == label)
        # At most ``rows`` ids and labels.
        return texts.join(F.broadcast(chosen.orderBy(order, "_label").limit(rows)), "_id")

    def dictionary(label: int) -> bytes:
        length, rows = F.length("_text"), settled(sample(0, dictionary_docs, label).select("_id", "_text"))
        piece_chars = sample_chars // max(1, rows.count())
        start = F.pmod(order, F.greatest(length - piece_chars, F.lit(0)) + 1) + 1
        piece = F.substring(F.col("_text"), start.cast("int"), F.lit(piece_chars))
        cut = rows.select("_id", piece.alias("piece")).collect()
        return build_dictionary([r.piece.encode() for r in sorted(cut, key=lambda r: (r["_id"], r.piece))], dictionary_bytes)

    good, bad = dictionary(1), dictionary(0)
    if not good or not bad:
        return None
    draft = Model(good, bad, 1.0, 0.0)
    seen = sample(2, calibration_docs).select(_evidence(draft)("_text").alias("x"), "_label").toArrow()
    y = np.array(seen["_label"], np.float64)
    if not 0 < y.sum() < len(y):
        return None
    return Model(good, bad, *logistic(np.array(seen["x"], np.float64), y))


def score(model: Model | None, text: Column) -> Column:
    """From 0 to 1; higher means likelier good."""
    if model is None:
        return F.lit(0.5)
    x = _evidence(model)(F.coalesce(text, F.lit("")))
    return 1 / (1 + F.exp(-(x * model.slope + model.offset)))


def scored(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``row`` with the input columns and ``score``."""
    row = packed(docs).alias("row")
    return docs.select(row, score(model, F.col(text_col)).alias("score"))


def keep_good(docs: DataFrame, model: Model | None, least: float = 0.5, text_col: str = "text") -> DataFrame:
    return scored(docs, model, text_col).where(F.col("score") >= least).select("row.*")
