"""Quality classifier by compression: zstandard dictionaries of good and of bad text.

A text is cut into pieces of about 512 bytes, so that a dictionary tells as much
at the end of a long text as at its start, and each piece is compressed with both
dictionaries.  The difference of the two sums of sizes, as a share of the text's
bytes, says which kind the text is like.  A logistic calibration of this one
number, fitted on labelled texts that went into neither dictionary, makes it a
score.
"""

from __future__ import annotations

import math
import pickle

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, in_fold, sampled, small_batches, spool, spread

#: Bound of what is learnt from: labelled texts of each class, half for the dictionaries, half for the calibration.
PER_CLASS = 1500
#: Of a text longer than that, so many pieces of so many characters, spread over all of it, go into a dictionary.
DICT_PIECES, DICT_CHARS = 8, 2048
PIECE, DICT_BYTES, LEVEL, THRESHOLD = 512, 112 << 10, 3, 0.7


class Compressors:
    """Both dictionaries, ready for use in a worker."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard as z

        self.one, self.two = (z.ZstdCompressor(level=LEVEL, dict_data=z.ZstdCompressionDict(d), write_checksum=False, write_content_size=False, write_dict_id=False) for d in (good, bad))

    def difference(self, text: str | None) -> float:
        """Bytes by which good text's dictionary compresses better, for each byte of the text; 0 for an empty text."""
        raw = (text or "").encode()
        n = max(1, round(len(raw) / PIECE))
        gap = 0
        for i in range(n if raw else 0):
            piece = raw[len(raw) * i // n : len(raw) * (i + 1) // n]
            gap += len(self.two.compress(piece)) - len(self.one.compress(piece))
        return gap / len(raw) if raw else 0.0


def dictionary_of(texts: list[str]) -> bytes:
    """A dictionary trained on the texts; with too little to train on, the text itself."""
    import zstandard as z

    pieces = [raw[i : i + 4 * PIECE] for t in texts for raw in [t.encode()] for i in range(0, len(raw), 4 * PIECE)]
    try:
        return z.train_dictionary(DICT_BYTES, pieces).as_bytes()
    except z.ZstdError:
        return b"".join(pieces)[-DICT_BYTES:] or b"\n" * 8


def calibrated(x: list[float], y: list[int], prior: float, ridge: float = 1e-2, rounds: int = 60) -> tuple[float, float]:
    """Intercept and slope of a ridge-penalised logistic regression on standardised ``x``, by Newton's method, moved to the prior."""
    import numpy as np

    x, y = np.asarray(x, float), np.asarray(y, float)
    mean, std = x.mean(), x.std() or 1.0
    z, w = np.stack([np.ones_like(x), (x - mean) / std], 1), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(2), z.T @ (p - y) + ridge * w)
        w -= step
        if abs(step).max() < 1e-8:
            break
    slope = w[1] / std
    shift = math.log(prior / (1 - prior)) - math.log(y.mean() / (1 - y.mean()))
    return float(w[0] - slope * mean + shift), float(slope)


def score_of(difference: float, model: dict) -> float:
    a, b = model["line"]
    return 1 / (1 + math.exp(-min(30.0, max(-30.0, a + b * difference))))


def sample_of(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, folds: int = 4, held: int = 2, label: str = "quality") -> tuple[DataFrame, float | None]:
    """(doc_id, y, half, text): about ``per_class`` labelled texts of each class outside the held-out fold, chosen by a hash of the id, as a table; and the share of label 1 among all such labels.

    The labels alone are counted and sampled first; then documents are read
    once, against ids whose number is bounded by the parameter.  A document
    with both labels, a null label or no text teaches nothing; of rows that repeat
    an id, the text that sorts first teaches.
    """
    known = labels.where(~in_fold("doc_id", folds, held) & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("most")).where("y = most")
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for y, n in counts.items():
        share = F.when(F.col("y") == y, per_class / n).otherwise(share)
    half = (F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(2))).cast("int")
    chosen = spool(known.where(sampled(share, "doc_id")).select("doc_id", F.col("y").cast("int").alias("y"), half.alias("half")), "chosen")
    few = chosen.count() <= 1 << 20
    text = docs.where("text is not null and doc_id is not null").select("doc_id", "text")
    rows = text.join(F.broadcast(chosen) if few else chosen, "doc_id").groupBy("doc_id", "y", "half").agg(F.min("text").alias("text"))
    return spool(rows, "sample"), counts.get(1, 0) / sum(counts.values()) if counts else None


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, folds: int = 4, held: int = 2, label: str = "quality") -> dict:
    """The model: both dictionaries from pieces of the sample's one half, the calibration from whole texts of the other.

    Where a half lacks a class, all of the sample serves for both.  With a class
    missing altogether, the model is a constant: the share of label 1 among the
    labels (1/2 without labels).
    """
    sample, prior = sample_of(docs, labels, per_class, folds, held, label)
    sizes = {(r["y"], r["half"]) for r in sample.select("y", "half").distinct().collect()}
    if {y for y, _ in sizes} != {0, 1}:
        return {"prior": 0.5 if prior is None else prior}
    split = len(sizes) == 4
    taught = sample.where("half = 0") if split else sample
    rows = taught.select("doc_id", "y", spread(F.col("text"), DICT_PIECES, DICT_CHARS).alias("x")).collect()  # at most per_class texts of 16 K characters
    texts = {k: [t for r in sorted(rows, key=lambda r: r["doc_id"]) if r["y"] == k for t in r["x"]] for k in (0, 1)}
    model = {"prior": prior, "good": dictionary_of(texts[1]), "bad": dictionary_of(texts[0])}
    held_out = differences(sample.where("half = 1") if split else sample, model, ("y",)).collect()  # two numbers a text
    return model | {"line": calibrated([r["difference"] for r in held_out], [r["y"] for r in held_out], prior)}


def differences(docs: DataFrame, model: dict, keep: tuple[str, ...], name: str = "difference") -> DataFrame:
    """The columns ``keep`` of ``docs`` and the difference of every row's whole text."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(pickle.dumps(model, 5))
    keys = [f"k{i}" for i in range(len(keep))]
    narrow = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, keys, strict=True)], F.col("text").alias("t"))

    def run(batches):
        import pyarrow as pa

        m = pickle.loads(sent.value)
        pair = Compressors(m["good"], m["bad"])
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([pair.difference(t.as_py()) for t in b.column(b.num_columns - 1)], pa.float64())], [*b.schema.names[:-1], "x"])

    kinds = dict(narrow.dtypes)
    out = narrow.mapInArrow(run, ", ".join([*(f"{k} {kinds[k]}" for k in keys), "x double"]))
    return out.select(*[F.col(k).alias(c) for c, k in zip(keep, keys, strict=True)], F.col("x").alias(name))


def _scored(docs: DataFrame, model: dict, keep: tuple[str, ...], name: str) -> DataFrame:
    if "line" not in model:
        return docs.select(*keep, F.lit(float(model["prior"])).alias(name))
    a, b = model["line"]
    found = differences(docs, model, keep, name)
    return found.withColumn(name, 1 / (1 + F.exp(-F.least(F.lit(30.0), F.greatest(F.lit(-30.0), a + b * F.col(name))))))


def scores(docs: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` and a score in 0..1 (higher: label 1 likelier) for every row, whatever its text.

    Whole texts are scored, when this is called; the result is a table.  Null and
    empty texts get the calibration's value for a difference of 0.  Repeated rows
    get equal scores.  If ``keep`` has a column ``score``, the new one takes an
    underscore more.
    """
    with small_batches(docs.sparkSession):
        return spool(_scored(docs, model, keep, fresh(docs.select(*keep), "score")), "scores")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with all their columns, as a table."""
    model, name = learn(docs, labels), fresh(docs, "score")
    with small_batches(docs.sparkSession):
        return spool(_scored(docs, model, tuple(docs.columns), name).where(F.col(name) >= threshold).select(*docs.columns), "good")
