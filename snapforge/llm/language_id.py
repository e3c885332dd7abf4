"""Language identification with error-correcting output codes.

Each language has a codeword of bits; one linear classifier on hashed letter n-grams predicts each bit. A text is decoded
to the language whose codeword has the smallest loss, bits weighted by how well they were learned. The two smallest
losses being close marks a text as ambiguous.

Rules: learning sees ``text`` and non-null ``lang`` of the learning rows only, at most ``sample`` rows of a language,
those with the smallest hash of the id, of each the whole text or four pieces spread over it; prediction reads whole texts. A text
that is null or has no letter is ``und`` with score 0. Without any row to learn from all are ``und``. With one language
only, all texts with a letter have it. Ties go to the language that comes first.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from snapforge.llm.common import first_by_hash, table
from snapforge.llm.vocabulary import slices

FEATURES = 1 << 13
ORDERS = (1, 2, 3)
SAMPLE, SAMPLE_CHARS, PIECES = 1000, 4000, 4
EXHAUSTIVE = 7  # languages up to which the code has every split
CHUNK = 1 << 15
AMBIGUOUS = 0.05
UNDETERMINED = "und"


def _hashes(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Feature numbers of the n-grams of each order."""
    c = codes.astype(np.uint64)
    for n in ORDERS:
        if len(c) < n:
            return
        h = np.full(len(c) - n + 1, n, np.uint64)
        for k in range(n):
            h = (h ^ c[k:len(c) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        yield (h & np.uint64(FEATURES - 1)).astype(np.int64)


def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text."""
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def features(text: str) -> np.ndarray:
    """Share of each hashed n-gram, each order summing to one, the root taken; texts are read in overlapping chunks."""
    out = np.zeros((len(ORDERS), FEATURES))
    for begin in range(0, len(text), CHUNK):
        for k, hashed in enumerate(_hashes(_codes(text[begin:begin + CHUNK + max(ORDERS) - 1]))):
            over = max(0, len(hashed) - CHUNK)
            out[k] += np.bincount(hashed[:len(hashed) - over], minlength=FEATURES)
    total = out.sum(1, keepdims=True)
    return np.sqrt(np.divide(out, total, where=total > 0, out=out)).sum(0).astype(np.float32)


def codewords(n: int) -> np.ndarray:
    """A row of +1 and -1 for each of ``n`` languages: every split of few languages, else splits far from each other."""
    if n <= EXHAUSTIVE:
        splits = [s for size in range(1, n) for s in combinations(range(1, n), size)]
        code = np.full((n, max(len(splits), 1)), -1, np.int8)
        for bit, members in enumerate(splits):
            code[list(members), bit] = 1
        return code
    width, random = int(np.ceil(10 * np.log2(n))), np.random.default_rng(7)
    tries = [random.choice(np.array([-1, 1], np.int8), (n, width)) for _ in range(50)]

    def nearest(c: np.ndarray) -> int:
        """Least number of bits in which two rows differ."""
        alike = c.astype(np.int32) @ c.T.astype(np.int32)
        np.fill_diagonal(alike, -width)
        return (width - int(alike.max())) // 2

    return max(tries, key=nearest)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Model:
    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray, bias: np.ndarray,
                 trust: np.ndarray) -> None:
        self.languages, self.code, self.weights, self.bias, self.trust = languages, code, weights, bias, trust

    def margins(self, text: str) -> np.ndarray:
        return features(text) @ self.weights + self.bias

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Logistic loss of each codeword, bits weighted by trust; the sum of the weights is 1."""
        return np.logaddexp(0, -self.code * np.clip(margins, -30, 30)) @ self.trust

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        losses = self.losses(self.margins(text))
        best = int(losses.argmin())
        share = np.exp(-(losses - losses[best]) * len(self.trust))
        nearest, second = np.partition(losses, 1)[:2]
        return self.languages[best], float(1 / share.sum()), bool(second - nearest < AMBIGUOUS)


def fit(rows: list[tuple[str, str]], rounds: int = 60, penalty: float = 1e-4) -> Model:
    """From (text, language) pairs; the order of the pairs makes no difference to which model is meant."""
    rows = sorted((t, lang) for t, lang in rows if has_letter(t))
    languages = sorted({lang for _, lang in rows})
    code = codewords(max(len(languages), 1))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((FEATURES, 1), np.float32), np.zeros(1), np.ones(1))
    x = np.stack([features(t) for t, _ in rows])
    row_code = code[[languages.index(lang) for _, lang in rows]].astype(np.float32)
    share = 1 / np.maximum((row_code[:, None, :] == np.array([-1, 1])[None, :, None]).sum(0), 1)
    balance = np.where(row_code > 0, share[1], share[0]) / 2  # both sides of a bit weigh the same
    weights, bias = np.zeros((FEATURES, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    seen_w, seen_b = np.full_like(weights, 1e-8), np.full_like(bias, 1e-8)
    for _ in range(rounds):
        margin = x @ weights + bias
        pull = (-row_code / (1 + np.exp(np.clip(row_code * margin, -30, 30))) * balance).astype(np.float32)
        slope_w, slope_b = x.T @ pull + penalty * weights, pull.sum(0)
        seen_w += slope_w ** 2
        seen_b += slope_b ** 2
        weights -= 0.5 * slope_w / np.sqrt(seen_w)
        bias -= 0.5 * slope_b / np.sqrt(seen_b)
    right = (((x @ weights + bias) * row_code > 0) * balance).sum(0)
    trust = np.maximum(right - 0.5, 1e-3)
    return Model(languages, code.astype(np.float64), weights, bias, trust / trust.sum())


def learn(documents: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model:
    """A model from the learning rows given: of each language the ``sample`` ids that come first by hash.

    They are chosen from the narrow columns. What comes to the driver is at most languages * sample texts of about
    SAMPLE_CHARS characters.
    """
    rows = documents.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        "id is not null and lang is not null")
    labelled = rows.select("lang", F.xxhash64(F.col("id").cast("string")).alias("h"), "id").distinct()
    chosen = first_by_hash(labelled, "lang", "h", sample).select("id", "lang")
    taken = rows.join(F.broadcast(chosen), ["id", "lang"]).groupBy("id", "lang").agg(F.min(spread(F.col("text"))).alias("piece"))
    return fit([(r["piece"], r["lang"]) for r in taken.collect()])


def spread(text: Column) -> Column:
    """A text of SAMPLE_CHARS characters as it is, of a longer one as many in PIECES that lie evenly over it."""
    length, size = F.char_length(text), SAMPLE_CHARS // PIECES
    begins = [F.floor((length - size) * k / (PIECES - 1)).cast("int") + 1 for k in range(PIECES)]
    return F.when(length > SAMPLE_CHARS, F.concat_ws(" ", *(F.substring(text, b, F.lit(size)) for b in begins))).otherwise(text)


def is_held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def predict(rows: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``rows`` with ``lang_pred, score, ambiguous``, which replace columns of these names."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    new = [StructField("lang_pred", StringType()), StructField("score", DoubleType()),
           StructField("ambiguous", BooleanType())]
    kept = rows.drop(*(f.name for f in new))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text_col):
                found = [shared.value.predict(t.as_py()) for t in piece.column(text_col)]
                columns = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([*piece.columns, *columns], [*piece.schema.names, *(f.name for f in new)])

    return kept.mapInArrow(run, StructType([*kept.schema.fields, *new]))


def lettered(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text is neither null nor without a letter, so that are not ``und`` once a language was learned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text_col):
                yield piece.filter(pa.array([has_letter(t.as_py()) for t in piece.column(text_col)], pa.bool_()))

    return rows.mapInArrow(run, rows.schema)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = learn(documents.where(~is_held_out()))
    return predict(documents.select("doc_id", "text"), model).select(
        "doc_id", is_held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


QUERIES = {"op3_language_id": op3_language_id}
SQL: dict[str, str] = {}
