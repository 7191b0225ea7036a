"""Language identification with a string kernel.

The kernel of two texts is the number of byte n-grams, n = 1 to 4, that are
present in both (a blended spectrum of presence bits), divided by the geometric
mean of what each has.  Landmark texts span a Nyström feature space, in which
one ridge regression per language is solved.  A batch of texts is scored by two
matrix products: presence bits by landmarks, then kernel rows by weights.

Everything that is learnt comes from a sample bounded in rows: ``per_lang`` whole
texts of each language, of which ``landmarks`` in all serve as landmarks.  Texts stay
in the executors, which send the landmarks' bits and a row of kernel values a text.  A softmax over
the regressions' outputs is the score; its sharpness is the one under which the
sample's languages are likeliest, each text predicted by all others.
"""

from __future__ import annotations

import pickle
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_fold, sampled, small_batches, spool

#: Bounds of what is learnt from, in rows alone: texts of each language, and of all; a language has one at least.
PER_LANG, ROWS = 300, 20_000
#: Languages whose shares are broadcast, at most.
MOST_SENT = 100_000
#: A landmark is 25 KB of bits, and 0.8 MB of a worker's matrix, whatever the number of languages.
LANDMARKS, RIDGE = 64, 1e-3
SLOTS, CHUNK = 256 + 3 * 65536, 1 << 20

#: Letters as they are (A-Z as a-z), bytes of other scripts too, all else a space.
TO_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORDLIKE = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    if not text:
        return False
    m = WORDLIKE.search(text)
    return m is not None and (m[0].isalpha() or any(map(str.isalpha, text[m.start() :])))


def presence(text: str, seen) -> int:
    """Marks the n-grams of the text in ``seen`` (cleared first) and returns how many there are; the text is read in chunks that overlap."""
    import numpy as np

    seen[:] = False
    raw = text.encode().translate(TO_LETTERS)
    for i in range(0, max(1, len(raw) - 3), CHUNK):
        one = np.frombuffer(raw, np.uint8, min(CHUNK + 3, len(raw) - i), i).astype(np.uint32)
        seen[one] = True
        two = (one[:-1] << np.uint32(8)) | one[1:]
        seen[two + np.uint32(256)] = True
        three = (two[:-1] << np.uint32(8)) | one[2:]
        seen[((three * np.uint32(2654435761)) >> np.uint32(16)) + np.uint32(65792)] = True
        four = (three[:-1] << np.uint32(8)) | one[3:]
        seen[((four * np.uint32(2246822519)) >> np.uint32(16)) + np.uint32(131328)] = True
    return int(np.count_nonzero(seen))


def kernel_rows(texts: list[str], slots, marks, norms):
    """Kernel of each text with each landmark; ``slots`` are the n-grams that any landmark has, ``marks`` their 0/1 matrix."""
    import numpy as np

    seen = np.zeros(SLOTS, bool)
    bits, sizes = np.empty((len(texts), len(slots)), np.float32), np.empty(len(texts))
    for i, t in enumerate(texts):
        sizes[i] = presence(t, seen)
        bits[i] = seen[slots]
    return (bits @ marks) / np.sqrt(np.maximum(sizes, 1)[:, None] * norms)


def spanned(found, norms) -> dict:
    """The part of a model that landmarks make, from their presence bits (rows) and sizes."""
    import numpy as np

    slots = np.flatnonzero(found.any(0))
    marks = np.ascontiguousarray(found[:, slots].T.astype(np.float32))
    own = (marks.T @ marks) / np.sqrt(np.outer(norms, norms))
    values, vectors = np.linalg.eigh(own.astype(float))
    good = values > 1e-6 * values.max()
    return {"slots": slots.astype(np.int32), "marks": np.packbits(marks.astype(bool)), "shape": marks.shape, "norms": norms, "root": vectors[:, good] / np.sqrt(values[good])}


def solved(part: dict, kernel, names: list[str], ridge: float = RIDGE) -> dict:
    """The model, from the landmarks' part, kernel rows of the sample's texts, and their languages."""
    import numpy as np

    langs, label = np.unique(np.array(names, object).astype(str), return_inverse=True)
    phi = np.hstack([kernel @ part["root"], np.ones((len(kernel), 1))])
    share = 1 / np.bincount(label)[label]  # languages weigh alike
    inverse = np.linalg.inv((phi * share[:, None]).T @ phi + ridge * np.eye(phi.shape[1]))
    sums = np.zeros((phi.shape[1], len(langs)))
    np.add.at(sums.T, label, phi * share[:, None])
    w = inverse @ (2 * sums - sums.sum(1, keepdims=True))  # targets are 1 for a text's language and -1 for all others
    return {k: v for k, v in part.items() if k != "root"} | {"sharpness": sharpness(phi, label, share, inverse, w), "langs": langs.tolist(), "weights": part["root"] @ w[:-1], "bias": w[-1]}


def fit(rows: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> dict:
    """A model from (text, language) rows at hand; rows without a letter teach nothing.  Without rows, the model knows no language."""
    import numpy as np

    rows = [r for r in rows if r[1] is not None and has_letter(r[0])]
    langs = sorted({y for _, y in rows})
    if not langs:
        return {"langs": []}
    by = {y: [t for t, k in rows if k == y] for y in langs}
    most = max(1, landmarks // len(langs))
    picked = [t for y in langs for t in by[y][:: max(1, len(by[y]) // most)][:most]][:landmarks]
    bits = [bits_of(t) for t in picked]
    part = spanned(np.array([b for b, _ in bits]), np.array([float(n) for _, n in bits]))
    m = unpacked(part)
    kernel = np.concatenate([kernel_rows([t for t, _ in rows[i : i + 64]], m["slots"], m["marks"], m["norms"]) for i in range(0, len(rows), 64)])
    return solved(part, kernel, [y for _, y in rows], ridge)


def bits_of(text: str):
    """Presence bits of a text, and how many there are."""
    import numpy as np

    seen = np.zeros(SLOTS, bool)
    return seen, presence(text, seen)


def sharpness(phi, label, share, inverse, w, chunk: int = 1024) -> float:
    """The factor in the softmax under which the texts' languages are likeliest, each text's outputs taken from a fit without it."""
    import numpy as np

    own = share * ((phi @ inverse) * phi).sum(1)
    tried = 2.0 ** np.arange(-1, 6.01, 0.25)
    loss = np.zeros(len(tried))
    for i in range(0, len(phi), chunk):
        at, o = label[i : i + chunk], own[i : i + chunk]
        row = np.arange(len(at))
        out = phi[i : i + chunk] @ w + o[:, None]
        out[row, at] -= 2 * o
        out /= np.maximum(1e-9, 1 - o)[:, None]
        for k, s in enumerate(tried):
            z = s * (out - out.max(1, keepdims=True))
            loss[k] += (share[i : i + chunk] * (np.log(np.exp(z).sum(1)) - z[row, at])).sum()
    return float(tried[loss.argmin()])


def unpacked(model: dict) -> dict:
    """The model with the landmarks' bits as a matrix, once per worker."""
    import numpy as np

    if "shape" not in model:
        return model
    n, m = model["shape"]
    return model | {"marks": np.unpackbits(model["marks"], count=n * m).reshape(n, m).astype(np.float32)}


def predict(texts: list[str | None], model: dict) -> list[tuple[str, float]]:
    """(language, share of a softmax over the languages' outputs); ``und`` and 0 for a text without a letter, or if no language was learnt."""
    import numpy as np

    out = [("und", 0.0)] * len(texts)
    at = [i for i, t in enumerate(texts) if model["langs"] and has_letter(t)]
    if at:
        f = kernel_rows([texts[i] for i in at], model["slots"], model["marks"], model["norms"]) @ model["weights"] + model["bias"]
        p = np.exp(model["sharpness"] * (f - f.max(1, keepdims=True)))
        p /= p.sum(1, keepdims=True)
        for i, k, s in zip(at, p.argmax(1), p.max(1), strict=True):
            out[i] = (model["langs"][k], float(s))
    return out


def sample(docs: DataFrame, per_lang: int = PER_LANG, rows: int = ROWS, folds: int = 3, held: int = 1) -> DataFrame:
    """doc_id, lang, text, place: ``per_lang`` whole texts of each language outside the held-out fold, numbered from 1 by a hash of the id.

    Where that is more than ``rows`` in all, languages share these evenly, with one text each at
    least: no language is left out.  Ids are chosen on the narrow columns; then documents are read once.
    Of rows that repeat an id, the text that sorts first teaches; rows without an
    id, language or text teach nothing.
    """
    known = docs.where(~in_fold("doc_id", folds, held) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = spool(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    langs = counts.count()
    each = max(1, min(per_lang, rows // max(1, langs)))
    # Some four times as many as are numbered, by a hash: the chance that a language has too few of them is below 1e-18.
    shares = counts.select("lang", (F.lit(4 * each + 40) / F.col("n")).alias("share"))
    some = known.select("doc_id", "lang").join(F.broadcast(shares) if langs <= MOST_SENT else shares, "lang").where(sampled(F.col("share"), "doc_id", F.lit(6)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(6)), "doc_id"))
    chosen = spool(some.select("doc_id", "lang").distinct().withColumn("place", place).where(F.col("place") <= each), "chosen")
    texts = known.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])  # at most ``rows`` ids, or one a language
    return spool(texts.groupBy("doc_id", "lang", "place").agg(F.min("text").alias("text")), "sample")


def learn(docs: DataFrame, per_lang: int = PER_LANG, rows: int = ROWS, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> dict:
    """A model from the sample of a table.

    Landmarks are the first texts of each language, then the second, and so on.  What comes to the driver is ``landmarks``
    times 25 KB, and ``landmarks`` numbers for each text of the sample.
    """
    import numpy as np

    taught = sample(docs, per_lang, rows)
    first = taught.select("doc_id", "lang", "place").orderBy("place", "lang", "doc_id").limit(landmarks)

    def bits(batches):
        import pyarrow as pa

        for b in batches:
            got = [(place, lang, doc, *bits_of(t)) for doc, lang, place, t in zip(*(c.to_pylist() for c in b.columns), strict=True) if has_letter(t)]
            cols = list(zip(*got, strict=True)) if got else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()), pa.array([np.packbits(x).tobytes() for x in cols[3]], pa.binary()), pa.array(cols[4], pa.int64())], ["place", "lang", "doc_id", "bits", "n"])

    marked = taught.join(F.broadcast(first), ["doc_id", "lang", "place"]).select("doc_id", "lang", "place", "text")
    with small_batches(docs.sparkSession, 64):
        got = sorted(marked.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(bits, "place int, lang string, doc_id long, bits binary, n long").collect(), key=lambda r: (r["place"], r["lang"], r["doc_id"]))
        if not got:
            return {"langs": []}
        part = spanned(np.unpackbits(np.array([np.frombuffer(r["bits"], np.uint8) for r in got]), axis=1, count=SLOTS).astype(bool), np.array([float(r["n"]) for r in got]))
        sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps({k: v for k, v in part.items() if k != "root"}, 5))

        def rows_of(batches):
            import pyarrow as pa

            m = unpacked(pickle.loads(sent.value))
            for b in batches:
                some = [(lang, doc, t) for doc, lang, t in zip(*(c.to_pylist() for c in b.columns), strict=True) if has_letter(t)]
                k = kernel_rows([t for _, _, t in some], m["slots"], m["marks"], m["norms"]).astype(np.float64) if some else []
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _, _ in some], pa.string()), pa.array([x for _, x, _ in some], pa.int64()), pa.array([x.tobytes() for x in k], pa.binary())], ["lang", "doc_id", "k"])

        known = sorted(taught.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").mapInArrow(rows_of, "lang string, doc_id long, k binary").collect(), key=lambda r: (r["lang"], r["doc_id"]))
    sent.destroy()
    return solved(part, np.array([np.frombuffer(r["k"]) for r in known]), [r["lang"] for r in known], ridge)


def classify(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred and score for every row of ``docs``, from its text alone.

    Null texts and texts without a letter are ``und`` with score 0.  Repeated
    rows get equal results; extra columns don't matter; an empty table gives an
    empty result.  Whole texts are read, when this is called; the result is a table.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(pickle.dumps(model, 5))
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        import pyarrow as pa

        m = unpacked(pickle.loads(sent.value))
        for b in batches:
            got = [x for i in range(0, b.num_rows, 64) for x in predict(b.column(1)[i : i + 64].to_pylist(), m)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    with small_batches(spark):
        return spool(narrow.mapInArrow(run, f"doc_id {dict(narrow.dtypes)['doc_id']}, lang_pred string, score double"), "languages")
