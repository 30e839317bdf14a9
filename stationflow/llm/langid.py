"""Language identification by error-correcting output codes.

Each language has a codeword. For each bit, a logistic classifier over hashed byte n-grams (n = 1, 2, 3) of the lower-cased text
predicts whether the text's language has a 1 there. A text's language is that of the codeword with the least total loss, each
bit's loss weighted by how well its classifier did on that language in training. A text whose two best codewords are close is flagged as ambiguous.

For up to 6 languages all splits are used (2^(K-1) - 1 bits), for more, 3 log2(K) + 12 random ones of greatest separation.

The classifiers are fitted on labelled documents, `sample` // languages of each language (20 where that is less: with over sample / 20 languages they
are 20 times as many as languages, and no language is left out), chosen by a hash of id and text. Their n-gram shares are computed on the executors
from whole texts; the n-gram shares of every text are of its whole text.

Defined results: `und` with score 0 and not ambiguous if the text is null or has no letter, or nothing could be learned. One
language: it alone is predicted, score 1. Ties go to the language first in order. Null languages are not learned. Repeated rows each
give a row. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, bounded_batches, chunks

DIMENSIONS = 2048
ROWS = 128


def counts(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Hashed n-gram counts, documents by DIMENSIONS."""
    n = len(offs) - 1
    buf = LOWER[buf].astype(np.uint32)
    doc = np.repeat(np.arange(n), np.diff(offs))
    out = np.zeros(n * DIMENSIONS)
    gram = buf + 1
    for k in (1, 2, 3):
        if k > 1:
            gram = gram[:-1] * np.uint32(257) + buf[k - 1 :] + np.uint32(1)
        if not len(gram):
            break
        slot = (gram * np.uint32(2654435761)) >> np.uint32(21)
        own, same = doc[: len(gram)], None
        at = own * DIMENSIONS + slot
        if k > 1:
            same = own == doc[k - 1 :]
            at = at[same]
        out += np.bincount(at, minlength=n * DIMENSIONS)
    return out.reshape(n, DIMENSIONS)


def shares(x: np.ndarray) -> np.ndarray:
    """Square roots of shares: rows of unit length, so long and short texts compare."""
    return np.sqrt(x / np.maximum(x.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def codewords(k: int, seed: int = 5) -> np.ndarray:
    """A row of bits (-1 or 1) for each language."""
    if k <= 6:
        return np.array([[1 if i == 0 or (b >> (i - 1)) & 1 else -1 for b in range(2 ** (k - 1) - 1)] for i in range(k)])
    rng = np.random.Generator(np.random.PCG64(seed))
    length = int(np.ceil(3 * np.log2(k))) + 12

    def apart(code):
        d = (code[:, None] != code[None]).sum(axis=2)
        return d[np.triu_indices(k, 1)].min()

    tried = (np.where(rng.random((k, length)) < 0.5, -1, 1) for _ in range(50))
    return max(tried, key=apart)


class Model:
    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray, bias: np.ndarray, trust: np.ndarray):
        self.languages, self.code, self.weights, self.bias, self.trust = languages, code, weights, bias, trust

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Loss of each language's codeword, weighted by the bits' trust; texts by languages."""
        margin = (x @ self.weights + self.bias)[:, None, :] * self.code[None]
        return (np.logaddexp(0, -margin) * self.trust[None]).sum(axis=2)

    def decode(self, x: np.ndarray, sharpness: float, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and ambiguity of each text."""
        loss = self.losses(x) * self.code.shape[1]
        p = np.exp(-sharpness * (loss - loss.min(axis=1, keepdims=True)))
        p /= p.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        order = np.sort(p, axis=1)
        close = order[:, -1] - order[:, -2] < margin if p.shape[1] > 1 else np.zeros(len(p), bool)
        return best, p[np.arange(len(p)), best], close


def train(x: np.ndarray, y: np.ndarray, languages: list[str], steps: int = 150, rate: float = 4.0, decay: float = 1e-5) -> Model:
    """All bits' logistic regressions at once, by accelerated full gradients; languages weigh alike."""
    code = codewords(len(languages)).astype(np.float32)
    if len(languages) == 1:
        return Model(languages, np.ones((1, 1), np.float32), np.zeros((x.shape[1], 1), np.float32), np.zeros(1, np.float32), np.ones((1, 1), np.float32))
    target = code[y]
    weight = (1 / np.bincount(y, minlength=len(languages)))[y].astype(np.float32)[:, None] / len(languages)
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    ahead, last = w.copy(), w.copy()
    for step in range(steps):
        z = np.clip((x @ ahead + b) * target, -30, 30)
        g = -target / (1 + np.exp(z)) * weight
        last, w = w, ahead - rate * (x.T @ g + decay * ahead)
        b -= rate * g.sum(axis=0)
        ahead = w + step / (step + 3) * (w - last)
    right = ((x @ w + b) * target > 0).astype(np.float32)
    trust = np.stack([right[y == i].mean(axis=0) for i in range(len(languages))]) + 1e-3
    return Model(languages, code, w, b, (trust / trust.sum(axis=1, keepdims=True)).astype(np.float32))


def fit(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", id: str = "doc_id", sample: int = 4000) -> Model | None:
    """learn: which rows may be learned from."""
    bounded_batches(docs.sparkSession)
    own = docs.where(learn & F.col(lang).isNotNull() & F.col(text).cast("string").rlike(r"\p{L}")).select(F.col(lang).cast("string").alias("lang"), F.xxhash64(id, text).alias("h"), F.col(text).cast("string").alias("x"))
    # Repeated rows are one example: what is counted, ranked and learned from are distinct hashes.
    keys = own.select("lang", "h").distinct()
    found = keys.groupBy("lang").count().orderBy("lang").collect()  # a row for each language
    if not found:
        return None
    languages = [r["lang"] for r in found]
    each = max(20, sample // len(languages))
    # A language's share that holds `each` rows all but surely comes from the hash alone, so only few rows are ranked, however frequent the language.
    share = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, (2 * each + 50) / r["count"])) for r in found], "lang string, share double")
    shared = lambda df: df.join(F.broadcast(share), "lang").where(F.pmod("h", F.lit(1 << 31)) < F.col("share") * (1 << 31)).drop("share")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    few = shared(keys).withColumn("r", rank).where(F.col("r") <= each).groupBy("lang").agg(F.max("h").alias("most"))
    chosen = shared(own).join(F.broadcast(few), "lang").where("h <= most").groupBy("lang", "h").agg(F.first("x").alias("x"))  # few: a row for each of the languages

    def run(batches):
        for rows, buf, offs in chunks(batches, "x", 1 << 18):
            x = counts(buf, offs)
            data = [r.tobytes() for r in shares(x)]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(data, pa.binary())], names=["lang", "h", "x"])

    got = chosen.mapInArrow(run, "lang string, h long, x binary").orderBy("lang", "h").collect()  # rows of 8 KB
    if not got:
        return None
    languages = sorted({r["lang"] for r in got})
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in got])
    number = {l: i for i, l in enumerate(languages)}
    return train(x, np.array([number[r["lang"]] for r in got]), languages)


def predict(docs: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",), sharpness: float = 1.0, margin: float = 0.2) -> DataFrame:
    """The columns of `keep`, lang_pred, score and ambiguous of every row."""
    bounded_batches(docs.sparkSession)
    x = F.col(text).cast("string")
    own = docs.select(*keep, F.coalesce(x.rlike(r"\p{L}"), F.lit(False)).alias("__some"), x.alias("__x"))
    names = [*keep, "lang_pred", "score", "ambiguous"]
    languages = np.array([*(model.languages if model else []), "und"], dtype=object)

    def run(batches):
        for rows, buf, offs in chunks(batches, "__x"):
            n = rows.num_rows
            best, score, close = np.full(n, len(languages) - 1), np.zeros(n), np.zeros(n, bool)
            some = rows.column(rows.num_columns - 2).to_numpy(zero_copy_only=False)
            if model is not None:
                for at in range(0, n, ROWS):
                    to = min(n, at + ROWS)
                    got = model.decode(shares(counts(buf[offs[at] : offs[to]], offs[at : to + 1] - offs[at])), sharpness, margin)
                    for into, values, none in zip((best, score, close), got, (len(languages) - 1, 0, False)):
                        into[at:to] = np.where(some[at:to], values, none)
            yield pa.RecordBatch.from_arrays([*rows.columns[:-2], pa.array(languages[best], pa.string()), pa.array(score), pa.array(close)], names=names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-2])
    return own.mapInArrow(run, f"{kinds}, lang_pred string, score double, ambiguous boolean")


def held_out(id: Column, remainder: int) -> Column:
    """crc32 of the id as text, modulo 5, is the remainder; never for a null id."""
    return F.coalesce(F.crc32(id.cast("string")) % 5 == remainder, F.lit(False))
