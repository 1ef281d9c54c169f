"""Language identification (op 2): sparse multinomial logistic regression on TF-IDF character n-grams, trained with
follow-the-regularised-leader and elastic-net penalties, then calibrated by a temperature."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.llm.common import materialise, tidy

BITS = 16
BUCKETS = 1 << BITS
ORDERS = (1, 2, 3)
#: Labelled documents used for fitting at most, or MIN_EACH for each language where that is more; a fifth of them sets the
#: temperature.
MAX_TRAIN, MIN_EACH = 4000, 8
#: FTRL-proximal: learning rate and smoothing of the per-coordinate steps, L1 and L2 penalties, passes.
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.002, 0.01, 3
_SLICE = 1 << 20


@lru_cache(maxsize=1)
def _fold_table() -> np.ndarray:
    """Code point -> lower-case letter, or a space for all that is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            table[c] = ord(ch.lower()[0])
    return table


def grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text, slice by slice: letters in lower case, anything between them as one space."""
    table = _fold_table()
    carry = np.array([32], np.uint32)
    for at in range(0, len(text), _SLICE):
        raw = np.frombuffer(text[at : at + _SLICE].encode("utf-32-le", "surrogatepass"), np.uint32)
        new = np.concatenate([carry[-1:], table[raw], [32] if at + _SLICE >= len(text) else []]).astype(np.uint32)
        keep = (new[1:] != 32) | (new[:-1] != 32)
        x = np.concatenate([carry[:-1], new[:1], new[1:][keep]])
        old = len(carry)
        for n in ORDERS:
            # windows that end in this slice; those within the carried letters were counted before
            first = max(0, old - n + 1)
            width = len(x) - n + 1 - first
            if width <= 0:
                continue
            h = np.full(width, 0x9E3779B1 * n & 0xFFFFFFFF, np.uint32)
            for k in range(n):
                h ^= x[first + k : first + k + width]
                h *= np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(15)
            yield (h >> np.uint32(32 - BITS)).astype(np.int64)
        carry = x[-max(ORDERS) :]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # weight times idf per bucket and language
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, text: str) -> np.ndarray:
        total = np.zeros(len(self.langs))
        n = 0
        for h in grams(text):
            total += self.table.take(h, axis=0).sum(axis=0, dtype=np.float64)
            n += len(h)
        return total / max(n, 1) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return "und", 0.0
        p = _softmax(self.logits(text)[None, :] / self.temperature)[0]
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def held_out(id_col: str):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per bucket, and their number under bucket -1."""
    counts = np.zeros(BUCKETS, np.int64)
    seen = np.zeros(BUCKETS, np.uint8)
    n = 0
    for batch in batches:
        col = batch.column("text")
        for i in range(len(col)):
            seen[:] = 0
            for h in grams(col[i].as_py() or ""):
                seen[h] = 1
            counts += seen
            n += 1
    met = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(met, -1)), pa.array(np.append(counts[met], n))], ["bucket", "n"])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Relative n-gram frequencies of each text, as packed buckets and values."""
    for batch in batches:
        at, tf = [], []
        for text in batch.column("text").to_pylist():
            total = np.zeros(BUCKETS, np.int64)
            for h in grams(text or ""):
                total += np.bincount(h, minlength=BUCKETS)
            met = np.flatnonzero(total)
            at.append(met.astype(np.uint16).tobytes())
            tf.append((total[met] / max(1, total.sum())).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(at, pa.binary()), pa.array(tf, pa.binary())], ["lang", "at", "tf"])


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], n_langs: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with elastic net over (language, buckets, values); returns weights (BUCKETS + 1, n_langs), the last
    row being the bias, and the number of non-zero weights per language."""
    z = np.zeros((BUCKETS + 1, n_langs))
    n = np.zeros((BUCKETS + 1, n_langs))
    weigh = lambda z, n: np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for r in rng.permutation(len(rows)):
            lang, at, x = rows[r]
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)
            w = weigh(z[at], n[at])
            p = _softmax((x @ w)[None, :])[0]
            p[lang] -= 1.0
            g = x[:, None] * p[None, :]
            squares = g * g
            z[at] += g - (np.sqrt(n[at] + squares) - np.sqrt(n[at])) * ALPHA**-1 * w
            n[at] += squares
    w = weigh(z, n)
    return w, (w[:-1] != 0).sum(axis=0)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", most: int = MAX_TRAIN) -> Model:
    """Learn from documents with a language whose id's CRC-32 leaves a remainder of 0 or 2 by three. Document frequencies
    are counted over all of them; the weights come from at most `most` of them (MIN_EACH for each language where that is
    more), drawn evenly over the languages by hash. Every language is learned; one takes about 2 MB of the driver in training
    and a quarter of a MB in the model. Null texts are left out and copies of a row count once in the sample; other columns
    are not read, whatever their names. Without usable documents the model knows no language."""
    usable = docs.where(F.col(lang).isNotNull() & F.coalesce(~held_out(id_col), F.lit(True))).select(F.xxhash64(F.col(id_col), F.col(text), F.lit(17)).alias("h"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    usable = usable.where("text is not null")
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    counts = np.ones(BUCKETS)
    n_docs = 0
    for r in usable.select("text").mapInArrow(tidy(_document_counts), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        if r["bucket"] < 0:
            n_docs = r["n"]
        else:
            counts[r["bucket"]] += r["n"]
    idf = np.log((n_docs + 1) / counts) + 1.0
    most = max(most, MIN_EACH * len(langs))
    quota = most / len(langs)
    shares = docs.sparkSession.createDataFrame([(k, min(1.0, quota / n)) for k, n in sizes.items()], "lang string, share double")
    drawn = usable.join(shares, "lang").where(F.pmod(F.col("h"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
    # hashes are chosen before texts move; a copied row counts once
    chosen = materialise(drawn.select("h").distinct().orderBy("h").limit(most + most // 4), "language-sample")
    sample = usable.join(F.broadcast(chosen), "h", "left_semi").dropDuplicates(["h", "lang"]).select("lang", "text")
    rows = []
    for r in sample.mapInArrow(tidy(_sparse), "lang string, at binary, tf binary").collect():
        at = np.frombuffer(r["at"], np.uint16).astype(np.int64)
        rows.append((langs.index(r["lang"]), at, np.frombuffer(r["tf"], np.float32) * idf[at] * 10.0))
    rows.sort(key=lambda r: (r[1].tobytes(), r[0], r[2].tobytes()))
    order = np.random.default_rng(3).permutation(len(rows))
    cut = len(rows) // 5 if len(rows) >= 50 else 0
    w, _ = train([rows[i] for i in order[cut:]], len(langs))
    model = Model(langs, (w[:-1] * idf[:, None] * 10.0).astype(np.float32), w[-1])
    if cut:
        z = np.array([rows[i][2] @ w[rows[i][1]] + w[-1] for i in order[:cut]])
        y = np.array([rows[i][0] for i in order[:cut]])
        loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean()
        model.temperature = float(min(np.geomspace(0.02, 5, 200), key=loss))
    return model


def predict_language(docs: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, held_out, lang_pred, score) for every document. `und` with score 0 if the text is null or has no letter, or if
    nothing could be learned. Nothing but the text enters the prediction; whole texts are read. Repeated rows and null ids give
    rows of their own; other columns are not read, whatever their names; an empty table gives an empty table."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^16 weights per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            col = batch.column("_text")
            found = [m.predict(col[i].as_py()) for i in range(len(col))]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["_id", "held_out", "lang_pred", "score"])

    slim = docs.select(F.col(id_col).alias("_id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), F.col(text).alias("_text"))
    return slim.mapInArrow(tidy(run), f"_id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("_id", id_col)
