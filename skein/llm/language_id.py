"""Language identification with a blended-spectrum string kernel and one-versus-rest kernel ridge regression.

A text is the set of its letter n-grams of 1 to `longest` code points (lower-cased; other ASCII characters count as
blanks), hashed to `BITS` bits. The kernel of two texts is the size of the sets' intersection over the geometric mean of
their sizes. Nyström: m landmark texts; features K(x, landmarks) K(landmarks, landmarks)^(-1/2); ridge regression of
+1/-1 for every language on those features. Both are linear in x's indicator vector, so scoring is one matrix product
of a batch of indicator rows with an n-grams x languages matrix, and one division by the root of each row's sum.

Whether a text belongs to its language: the share of the language's training texts that have an n-gram, averaged over
the n-grams of the text (its resemblance), is at least `FLOOR` times the least that a training text of about as many
n-grams had. One-versus-rest machines must name a language even for a script or a jumble of letters that none of them
has met; this tells such texts. predict() reports it; op7 does not look at it, the pipeline rejects what does not belong.

Fitted on about `per_language` rows of each language, chosen by hash (fewer of each beyond `max_rows` in all, and at
most `max_landmarks` landmarks); of each only its bit set goes to the driver. Null text, or text without a letter, is
`und` with score 0; null languages teach nothing; without any labelled row all are `und`; a very long text is read whole,
a block at a time; repeated rows and null ids keep a row each; an empty table gives none; other columns are not looked
at, but the results' columns take the place of those of their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.common import chunks, id_bucket, small_batches, table, with_results

#: log2 of the number of hashed n-grams.
LOG_BITS = 15
BITS = 1 << LOG_BITS

#: Texts of one matrix product.
ROWS = 128

UNKNOWN = "und"

#: The part of the least resemblance in training that a text must reach.
FLOOR = 0.6


def code_points(text: str) -> np.ndarray:
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    blank = (cp < 97) | ((cp > 122) & (cp < 128))
    return np.where(blank, np.uint32(32), cp)


def buckets(text: str, longest: int, block: int = 1 << 20) -> Iterator[np.ndarray]:
    """Hashed n-grams of a text, a block of code points at a time."""
    cp = code_points(text).astype(np.uint64)
    for at in range(0, len(cp), block):
        part = cp[at : at + block + longest - 1]
        h = np.zeros(len(part), dtype=np.uint64)
        for n in range(1, longest + 1):
            if len(part) < n:
                break
            h = (h[: len(part) - n + 1] + part[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
            yield ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - LOG_BITS)


def indicator(text: str, longest: int, row: np.ndarray) -> None:
    for b in buckets(text, longest):
        row[b] = 1


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class LanguageModel:
    """`weights` and `shares` are n-grams x languages; `floors[k]` is for texts of 2^k and more n-grams."""

    def __init__(self, languages: list[str], weights: np.ndarray, longest: int, shares: np.ndarray | None = None, floors: np.ndarray | None = None):
        self.languages, self.longest = languages, longest
        self.shares = np.zeros_like(weights) if shares is None else shares
        self.both = np.concatenate([weights, self.shares], axis=1)
        self.floors = np.zeros(LOG_BITS + 2) if floors is None else floors

    def measures(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Regression outputs and resemblances, texts x languages, and the number of each text's n-grams."""
        out = np.zeros((len(texts), self.both.shape[1]), dtype=np.float32)
        sizes = np.zeros(len(texts), dtype=np.int64)
        x = np.zeros((min(ROWS, len(texts)), BITS), dtype=np.float32)
        for at in range(0, len(texts), ROWS):
            part = texts[at : at + ROWS]
            x[:] = 0
            for i, t in enumerate(part):
                indicator(t, self.longest, x[i])
            sizes[at : at + len(part)] = x[: len(part)].sum(axis=1)
            out[at : at + len(part)] = x[: len(part)] @ self.both
        size, n = np.maximum(sizes, 1)[:, None], len(self.languages)
        return out[:, :n] / np.sqrt(size), out[:, n:] / size, sizes

    def scores(self, texts: list[str]) -> np.ndarray:
        """Regression outputs, texts x languages."""
        return self.measures(texts)[0]

    def predict(self, df: DataFrame, *, text_col: str = "text", keep: list[str] | None = None, names: tuple[str, str, str] = ("lang_pred", "score", "belongs")) -> DataFrame:
        """`keep` columns (all, if not given), the predicted language, its score (0 to 1) and whether the text belongs to
        it, of every row."""
        sent = df.sparkSession.sparkContext.broadcast(self)  # bounded by max_landmarks' languages

        def start():
            model = sent.value

            def of(batch: list) -> list[pa.Array]:
                at = [i for i, t in enumerate(batch) if has_letter(t) and model.languages]
                lang, score, belongs = np.full(len(batch), UNKNOWN, dtype=object), np.zeros(len(batch)), np.zeros(len(batch), dtype=bool)
                if at:
                    s, near, sizes = model.measures([batch[i] for i in at])
                    best, row = s.argmax(axis=1), np.arange(len(s))
                    lang[at] = np.array(model.languages, dtype=object)[best]
                    score[at] = np.clip((s[row, best] + 1) / 2, 0, 1)
                    belongs[at] = near[row, best] >= model.floors[size_class(sizes)]
                return [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(belongs, pa.bool_())]

            return of

        fields = T.StructType().add(names[0], "string").add(names[1], "double").add(names[2], "boolean")
        return with_results(df, text_col, df.columns if keep is None else keep, fields, start)


def size_class(sizes: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(sizes, 1)).astype(np.int64)


def resemblance(sets: np.ndarray, labels: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The share of each language's texts that have an n-gram (n-grams x languages), and the floors by size, from packed
    bit sets and the languages' numbers. A size that no text has takes the floor of the next greater one, else the next smaller."""
    shares = np.zeros((BITS, n), dtype=np.float32)
    for c in range(n):
        own = np.flatnonzero(labels == c)
        for at in range(0, len(own), 256):
            shares[:, c] += np.unpackbits(sets[own[at : at + 256]], axis=1).sum(axis=0, dtype=np.float32)
        shares[:, c] /= max(len(own), 1)
    floors = np.full(LOG_BITS + 2, np.inf)
    for at in range(0, len(sets), 256):
        x = np.unpackbits(sets[at : at + 256], axis=1)
        sizes = x.sum(axis=1, dtype=np.int64)
        near = (x.astype(np.float32) @ shares)[np.arange(len(x)), labels[at : at + 256]] / np.maximum(sizes, 1)
        np.minimum.at(floors, size_class(sizes), near)
    for k in [*range(len(floors) - 2, -1, -1), *range(1, len(floors))]:
        if not np.isfinite(floors[k]):
            floors[k] = floors[min(k + 1, len(floors) - 1)] if np.isfinite(floors[min(k + 1, len(floors) - 1)]) else floors[max(k - 1, 0)]
    return shares, FLOOR * np.where(np.isfinite(floors), floors, 0.0)


def solve(sets: np.ndarray, y: np.ndarray, landmarks: np.ndarray, ridge: float) -> np.ndarray:
    """The n-grams x languages matrix from packed bit sets, the +1/-1 matrix and the landmarks' positions."""

    def rows(at: np.ndarray) -> np.ndarray:
        x = np.unpackbits(sets[at], axis=1).astype(np.float32)
        return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))

    marks = rows(landmarks)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = values > 1e-6 * max(values.max(), 1e-12)
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = np.concatenate([rows(np.arange(at, min(at + 256, len(sets)))) @ marks.T @ root for at in range(0, len(sets), 256)])
    inner = features.T @ features + ridge * len(sets) * np.eye(features.shape[1])
    return (marks.T.astype(np.float64) @ (root @ np.linalg.solve(inner, features.T @ y))).astype(np.float32)


def limits(spark: SparkSession, counts: dict[str, int], per_language: int) -> DataFrame:
    """(label, most): rows whose hash is at most `most` are about `per_language` of the label's."""
    return spark.createDataFrame([(name, hash_limit(per_language / n)) for name, n in counts.items()], "label string, most long")


def hash_limit(share: float) -> int:
    """A signed 64-bit hash below this is one of the first `share` (0 to 1) of all; exact to 2^-53 of the share."""
    return min(int(share * 2.0**64), 2**64 - 1) - 2**63


def fit(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", longest: int = 4, per_language: int = 600, landmarks_each: int = 80, ridge: float = 1e-4, max_rows: int = 30_000, max_landmarks: int = 4_000) -> LanguageModel:
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("label")).filter("text is not null and label is not null")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # one row a language
    languages = sorted(counts)
    none = LanguageModel([], np.zeros((BITS, 0), dtype=np.float32), longest)
    if not languages:
        return none
    per_language = max(1, min(per_language, max_rows // len(languages)))
    landmarks_each = max(1, min(landmarks_each, max_landmarks // len(languages)))
    chosen = rows.join(F.broadcast(limits(df.sparkSession, counts, per_language)), "label").filter(F.xxhash64("id", "text") <= F.col("most"))
    chosen = chosen.select("text", "label").dropDuplicates(["text", "label"])

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, 0):
            packed = []
            for t in chunk.column(0).to_pylist():
                row = np.zeros(BITS, dtype=np.uint8)
                indicator(t, longest, row)
                packed.append(np.packbits(row).tobytes())
            yield pa.RecordBatch.from_arrays([chunk.column(1), pa.array(packed, pa.binary())], names=["label", "bits"])

    found = small_batches(chosen).mapInArrow(bits, "label string, bits binary").distinct().toArrow().to_pydict()
    if not found["label"]:
        return none
    order = sorted(range(len(found["label"])), key=lambda i: (found["bits"][i], found["label"][i]))
    languages = sorted(set(found["label"]))
    labels = np.array([languages.index(found["label"][i]) for i in order])
    sets = np.frombuffer(b"".join(found["bits"][i] for i in order), dtype=np.uint8).reshape(len(order), -1)
    marks = []
    for c in range(len(languages)):
        own = np.flatnonzero(labels == c)
        marks.append(own[:: max(1, len(own) // landmarks_each)][:landmarks_each])
    y = np.where(labels[:, None] == np.arange(len(languages)), 1.0, -1.0)
    return LanguageModel(languages, solve(sets, y, np.concatenate(marks), ridge), longest, *resemblance(sets, labels, len(languages)))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fit(documents.filter(id_bucket("doc_id", 5) != 0))
    found = model.predict(documents, keep=["doc_id"])
    return found.select("doc_id", (id_bucket("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
