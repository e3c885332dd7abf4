"""Token counts by byte-pair merging over a heap and a linked list; identifiers are never made.

Rules: a null or empty text has no tokens; special strings inside a text count one each, as the library has it. The
count of a word is its symbols less its merges. Repeated rows are counted alike, no text is cut.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from snapforge.llm.common import table
from snapforge.llm.vocabulary import Bounded, Vocabulary, parsed, pieces, read_content, slices

LIMIT = 2048
LONG_WORD = 64  # longer words are counted without being remembered


def count_after_merges(symbols: list[int], vocabulary: Vocabulary) -> int:
    """Symbols left when no adjacent pair has a rank: the lowest rank goes first, the leftmost of equals."""
    n, rank, product, size = len(symbols), vocabulary.rank, vocabulary.product, vocabulary.size
    if n < 2:
        return n
    at = symbols if n <= LONG_WORD else array("i", symbols)
    following = list(range(1, n + 1)) if n <= LONG_WORD else array("q", range(1, n + 1))
    previous = list(range(-1, n - 1)) if n <= LONG_WORD else array("q", range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        r = rank.get(at[i] * size + at[i + 1])
        if r is not None:
            heap.append(r * n + i)
    heapify(heap)
    left = n
    while heap:
        r, i = divmod(heappop(heap), n)
        j = following[i]
        if at[i] < 0 or j >= n or rank.get(at[i] * size + at[j]) != r:
            continue  # one of the two was merged meanwhile
        made = at[i] = product[r]
        at[j] = -1
        k = following[i] = following[j]
        left -= 1
        if k < n:
            previous[k] = i
            r = rank.get(made * size + at[k])
            if r is not None:
                heappush(heap, r * n + i)
        h = previous[i]
        if h >= 0:
            r = rank.get(at[h] * size + made)
            if r is not None:
                heappush(heap, r * n + h)
    return left


class Counter:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.known = Bounded(lambda word: count_after_merges(vocabulary.symbols(word), vocabulary))

    def count(self, text: str) -> int:
        total, parts = 0, []
        for kind, found in pieces(text, self.vocabulary):
            if kind == "words":
                long_words = [w for w in found if len(w) > LONG_WORD]
                if long_words:
                    total += sum(count_after_merges(self.vocabulary.symbols(w), self.vocabulary) for w in long_words)
                    found = [w for w in found if len(w) <= LONG_WORD]
                total += sum(map(self.known.__getitem__, found))
            elif kind == "part":
                parts.append(found)
            elif kind == "end":
                total += count_after_merges(self.vocabulary.symbols("".join(parts)), self.vocabulary)
                parts = []
            else:
                total += 1
        return total


_counters: dict[int, Counter] = {}


def _counter(content: str) -> Counter:
    vocabulary = parsed(content)
    return _counters.setdefault(id(vocabulary), Counter(vocabulary))


def with_token_counts(rows: DataFrame, path: str, text_col: str = "text", out: str = "n_tokens") -> DataFrame:
    """``rows`` with the number of tokens of ``text_col`` by the vocabulary at ``path``, a file the driver reads."""
    content = rows.sparkSession.sparkContext.broadcast(read_content(path))
    kept = rows.drop(out)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(content.value)
        for batch in batches:
            for piece in slices(batch, text_col):
                counts = [counter.count(t.as_py() or "") for t in piece.column(text_col)]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(counts, pa.int64())], [*piece.schema.names, out])

    return kept.mapInArrow(counted, StructType([*kept.schema.fields, StructField(out, LongType())]))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    documents = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return with_token_counts(documents, public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"))


QUERIES = {"op5_token_counts": op5_token_counts}
SQL: dict[str, str] = {}
