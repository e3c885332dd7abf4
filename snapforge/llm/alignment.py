"""Alignment of two tokenizers by an associative fragment monoid.

Both tokenizers cut the same bytes. Offsets where tokens of both end are cuts; between two cuts lies a group, and the
tokens of a group are linked, each of A with each of B. A fragment holds the tokens of a byte range: those up to its first cut
are an open prefix, those between cuts closed groups, those behind the last cut an open suffix. To compose two fragments only
the suffix of the left and the prefix of the right are looked at, and the operation is associative, so a long text is
tokenized in chunks by several tasks and composed by a tree of groups. A chunk ends, for each tokenizer apart, at the
first place behind a whole number of chunk bytes where that tokenizer always begins a token. So chunks of A and B end at
different bytes, and tokens are those of the whole text.

How many documents hold a pair linked is counted over all. Documents are taken in slices: a slice numbers its groups and
pairs, sends each pair once with its number of documents, and gets its counts back once, so that neither links
nor groups of a document are shuffled by pair.

Rules: a null or empty text, or one whose token bytes do not join to a space and the text, has no tokens. Every row is a
document of its own. Special strings are plain text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce
from hashlib import sha256
from itertools import chain
from pathlib import Path
from random import SystemRandom
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapforge.llm.common import table, written
from snapforge.llm.vocabulary import byte_alphabet, slices

CHUNK = 1 << 16  # bytes of a chunk, or up to the next place where a token begins
SLICE_TOKENS = 6_000_000  # tokens of A in a slice
FAN = 8  # fragments composed by one group of a round
# Fixed value: how byte-level vocabularies of this kind cut a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = 0x20
_SIGNS = np.zeros(256, bool)
_SIGNS[list(b"!\"#$%&()*+,-./:;<=>?@[]^_`{|}~")] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_PRINTED = np.zeros(256, bool)
_PRINTED[0x21:0x7F] = True


class ByteTokenizer:
    """A byte-level vocabulary; ``entries`` are the bytes of each token."""

    def __init__(self, content: str) -> None:
        data = json.loads(content)
        special = {t["content"] for t in data["added_tokens"]}
        back = {c: b for b, c in enumerate(byte_alphabet())}
        ranks = {bytes(back[c] for c in token): k for token, k in data["model"]["vocab"].items() if token not in special}
        self.encoding = tiktoken.Encoding("bytes", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.entries = [b""] * (1 + max(ranks.values()))
        for token, k in ranks.items():
            self.entries[k] = token
        self.lengths = np.array([len(e) for e in self.entries])

    def encode(self, parts: list[bytes]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(p.decode("utf-8", "replace")) for p in parts]

    @staticmethod
    def begins(data: np.ndarray) -> np.ndarray:
        """Places where a token always begins: a space after a printed character, a sign after a letter or digit."""
        space = (data[1:] == SPACE) & _PRINTED[data[:-1]]
        return np.flatnonzero(space | (_SIGNS[data[1:]] & _ALNUM[data[:-1]])) + 1


class PieceTokenizer:
    """A piece vocabulary with byte fallback that puts a space before a text."""

    def __init__(self, content: bytes) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        names = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.entries = [bytes([int(name[1:-1], 16)]) if self.model.is_byte(k) else name.replace("▁", " ").encode()
                        for k, name in enumerate(names)]
        self.lengths = np.array([len(e) for e in self.entries])
        self.inner_space = any(" " in e.lstrip(b" ").decode("utf-8", "replace") for e in self.entries)

    def encode(self, parts: list[bytes]) -> list[list[int]]:
        """Every part begins with the space that the model adds."""
        return self.model.encode([p[1:].decode("utf-8", "replace") for p in parts], num_threads=1)

    def begins(self, data: np.ndarray) -> np.ndarray:
        """A space after another character, as no piece has one inside."""
        if self.inner_space:
            return np.zeros(0, np.int64)
        return np.flatnonzero((data[1:] == SPACE) & (data[:-1] != SPACE)) + 1


class Fragment(NamedTuple):
    """Token numbers and their ends as offsets in the whole text, and the ends that both have."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray
    cuts: np.ndarray

    @staticmethod
    def of(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> Fragment:
        return Fragment(a, a_ends, b, b_ends, np.intersect1d(a_ends, b_ends, assume_unique=True))


def compose(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of both ranges: cuts between the open suffix and the open prefix are found, all others stay."""
    behind = left.cuts[-1] if len(left.cuts) else -1
    upto = right.cuts[0] if len(right.cuts) else np.iinfo(np.int64).max
    inner = [np.concatenate([s[np.searchsorted(s, behind, "right"):], p[:np.searchsorted(p, upto, "left")]])
             for s, p in ((left.a_ends, right.a_ends), (left.b_ends, right.b_ends))]
    cuts = np.concatenate([left.cuts, np.intersect1d(*inner, assume_unique=True), right.cuts])
    return Fragment(*(np.concatenate(pair) for pair in zip(left[:4], right[:4], strict=True)), cuts)


@lru_cache(maxsize=2)
def _tokenizers(content_a: str, content_b: bytes) -> tuple[ByteTokenizer, PieceTokenizer]:
    """One pair per Python worker."""
    return ByteTokenizer(content_a), PieceTokenizer(content_b)


def chunk_edges(data: bytes, begins: Callable[[np.ndarray], np.ndarray], chunk: int) -> list[int]:
    """Where the chunks of one tokenizer begin, and the end. A chunk without a place to begin is empty."""
    places = begins(np.frombuffer(data, np.uint8))
    out = [0]
    for target in range(chunk, len(data), chunk):
        at = np.searchsorted(places, max(target, out[-1]))
        out.append(int(places[at]) if at < len(places) else len(data))
    return [*out, len(data)]


def _encoded(tokenizer: ByteTokenizer | PieceTokenizer, parts: list[bytes]) -> tuple[list[np.ndarray], list[bool]]:
    """Numbers of each part, and whether their bytes join to it."""
    found = iter(tokenizer.encode([p for p in parts if p]))
    ids = [next(found) if p else [] for p in parts]
    whole = [b"".join(map(tokenizer.entries.__getitem__, own)) == p for own, p in zip(ids, parts, strict=True)]
    return [np.array(own, np.int64) for own in ids], whole


def _counted(groups: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, token and how often it stands there, sorted, from the tokens of each group."""
    tokens = np.fromiter(chain.from_iterable(groups), np.int64)
    group = np.repeat(np.arange(len(groups)), np.array([len(g) for g in groups], np.int64))
    held, times = np.unique((group << 32) | tokens, return_counts=True)
    return held >> 32, held & 0xFFFFFFFF, times


class Slice:
    """Documents with their groups, and what the groups have in common."""

    def __init__(self) -> None:
        self.number = SystemRandom().getrandbits(62)  # a task that runs again writes another slice
        self.groups: dict[tuple[tuple[int, ...], tuple[int, ...]], int] = {}
        self.texts: list[str] = []
        self.documents: list[tuple] = []
        self.tokens = 0

    def _number(self, a: tuple[int, ...], b: tuple[int, ...]) -> int:
        number = self.groups.get((a, b))
        if number is None:
            number = self.groups[a, b] = len(self.groups)
            self.texts.append("|".join(",".join(map(str, ids)) for ids in (a, b)))
        return number

    def add(self, key, whole: Fragment | None) -> None:
        """A document by the fragment of all of it, or by None if it has no tokens."""
        if whole is None or not len(whole.a):
            self.documents.append((key, 0, 0, 0, 0, "", b"", b""))
            return
        a_at = np.searchsorted(whole.a_ends, whole.cuts, "right")
        b_at = np.searchsorted(whole.b_ends, whole.cuts, "right")
        n_a, n_b = np.diff(a_at, prepend=0), np.diff(b_at, prepend=0)
        links = int((n_a * n_b).sum())
        numbers = np.empty(len(a_at), np.int64)
        single = (n_a == 1) & (n_b == 1)  # most groups: looked up once for all places in the document
        found, place = np.unique((whole.a[a_at[single] - 1] << 32) | whole.b[b_at[single] - 1], return_inverse=True)
        numbers[single] = np.array([self._number((int(p >> 32),), (int(p & 0xFFFFFFFF),)) for p in found], np.int64)[place]
        for k in np.flatnonzero(~single).tolist():
            p, q = a_at[k], b_at[k]
            numbers[k] = self._number(tuple(whole.a[p - n_a[k]:p].tolist()), tuple(whole.b[q - n_b[k]:q].tolist()))
        numbers = numbers.tolist()
        digest = sha256(";".join(map(self.texts.__getitem__, numbers)).encode()).hexdigest()
        held, times = np.unique(np.array(numbers, "<i4"), return_counts=True)
        self.tokens += len(whole.a)
        self.documents.append((key, len(whole.a), len(whole.b), len(numbers), links, digest, held.tobytes(),
                               times.astype("<i4").tobytes()))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all groups one after the other: where a group begins, numbers of its distinct pairs, how often each is
        linked there; and the pairs."""
        (of_a, a, n_a), (of_b, b, n_b) = (_counted([group[side] for group in self.groups]) for side in (0, 1))
        begin, size = np.searchsorted(of_b, of_a), np.bincount(of_b, minlength=len(self.groups))[of_a]
        row = np.repeat(np.arange(len(a)), size)  # each token of A meets the distinct tokens of B in its group
        other = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + begin[row]
        distinct, numbers = np.unique((a[row] << 32) | b[other], return_inverse=True)
        starts = np.searchsorted(of_a[row], np.arange(len(self.groups) + 1))
        return starts, numbers, n_a[row] * n_b[other], distinct

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        starts, pairs, times, distinct = self.pairs()
        held = [np.frombuffer(d[6], "<i4").astype(np.int64) for d in self.documents]
        groups = np.concatenate(held) if held else np.zeros(0, np.int64)
        document = np.repeat(np.arange(len(held)), [len(h) for h in held])
        sizes = starts[groups + 1] - starts[groups]
        entry = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts[groups], sizes)
        once = np.unique(np.repeat(document, sizes) * max(len(distinct), 1) + pairs[entry])
        documents = np.bincount(once % max(len(distinct), 1), minlength=len(distinct))
        columns = dict(zip(("id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "times"),
                           map(list, zip(*self.documents, strict=True)), strict=True))
        yield _batch(schema, len(self.documents), kind="document", slice=self.number, **columns)
        yield _batch(schema, 1, kind="groups", slice=self.number, starts=[starts.astype("<i8").tobytes()],
                     groups=[pairs.astype("<i4").tobytes()], times=[times.astype("<i8").tobytes()])
        yield _batch(schema, len(distinct), kind="pair", slice=self.number, pair=np.arange(len(distinct)),
                     a=distinct >> 32, b=distinct & 0xFFFFFFFF, documents=documents)


def _batch(schema: pa.Schema, rows: int, kind: str, slice: int, **columns) -> pa.RecordBatch:  # noqa: A002
    """Rows of one kind; columns of other kinds are null."""
    columns = {"kind": [kind] * rows, "slice": [slice] * rows, **columns}
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


# kinds of rows: documents and groups of a slice, pairs of a slice, chunks of a long text, fragments
_COLUMNS = [("kind", pa.string(), "string"), ("slice", pa.int64(), "long"), ("n_a", pa.int64(), "long"),
            ("n_b", pa.int64(), "long"), ("n_groups", pa.int64(), "long"), ("n_links", pa.int64(), "long"),
            ("groups_sha256", pa.string(), "string"), ("starts", pa.binary(), "binary"), ("groups", pa.binary(), "binary"),
            ("times", pa.binary(), "binary"), ("pair", pa.int32(), "int"), ("a", pa.int64(), "long"),
            ("b", pa.int64(), "long"), ("documents", pa.int64(), "long"), ("k", pa.int64(), "long"),
            ("part_a", pa.binary(), "binary"), ("part_b", pa.binary(), "binary"), ("begin_a", pa.int64(), "long"),
            ("begin_b", pa.int64(), "long")]


def _ends(tokenizer: ByteTokenizer | PieceTokenizer, ids: np.ndarray, begin: int) -> np.ndarray:
    return begin + np.cumsum(tokenizer.lengths[ids])


def _sliced(first: Iterator[tuple[object, Fragment | None] | pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Slices of the documents that come, and whatever batch comes between."""
    held = Slice()
    for item in first:
        if isinstance(item, pa.RecordBatch):
            yield item
            continue
        held.add(*item)
        if held.tokens >= SLICE_TOKENS or len(held.documents) >= SLICE_TOKENS:
            yield from held.batches(schema)
            held = Slice()
    if held.documents:
        yield from held.batches(schema)


def _first_pass(rows: DataFrame, contents, id_type: pa.DataType, kind: str, chunk: int) -> DataFrame:
    """Slices of the texts of one chunk, and the chunks of the others."""
    schema = pa.schema([("id", id_type), *((n, t) for n, t, _ in _COLUMNS)])

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator:
        first, second = _tokenizers(*(c.value for c in contents))
        for batch in batches:
            for piece in slices(batch, "text"):
                keys, texts = piece.column("id").to_pylist(), piece.column("text").to_pylist()
                short = [k for k, t in enumerate(texts) if t and len(t) < chunk]
                parts = [b" " + texts[k] for k in short]
                (ids_a, whole_a), (ids_b, whole_b) = _encoded(first, parts), _encoded(second, parts)
                for n, k in enumerate(short):
                    yield keys[k], Fragment.of(ids_a[n], _ends(first, ids_a[n], 0), ids_b[n], _ends(second, ids_b[n], 0)) if (
                        whole_a[n] and whole_b[n]) else None
                for k, text in enumerate(texts):
                    if not text:
                        yield keys[k], None
                    elif len(text) >= chunk:
                        yield from chunks(keys[k], b" " + text, first, second)

    def chunks(key, data: bytes, first: ByteTokenizer, second: PieceTokenizer) -> Iterator[pa.RecordBatch]:
        number = SystemRandom().getrandbits(62)
        edges = [chunk_edges(data, t.begins, chunk) for t in (first, second)]
        for k in range(len(edges[0]) - 1):
            (a, a_end), (b, b_end) = (own[k:k + 2] for own in edges)
            yield _batch(schema, 1, kind="chunk", slice=number, id=[key], k=[k], part_a=[data[a:a_end]],
                         part_b=[data[b:b_end]], begin_a=[a], begin_b=[b])

    return rows.mapInArrow(lambda batches: _sliced(items(batches), schema), kind)


_FRAGMENT = pa.schema([("text", pa.int64()), ("k", pa.int64()), ("whole", pa.bool_()), *((c, pa.binary()) for c in Fragment._fields)])


def _fragment_row(text: int, k: int, whole: bool, fragment: Fragment | None) -> pa.Table:
    blobs = [f.astype("<i8").tobytes() for f in fragment] if fragment else [b""] * len(Fragment._fields)
    return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip((text, k, whole, *blobs), _FRAGMENT, strict=True)],
                                schema=_FRAGMENT)


def _read_fragment(row: dict) -> Fragment:
    return Fragment(*(np.frombuffer(row[c], "<i8") for c in Fragment._fields))


def _fragments(chunks: DataFrame, contents) -> DataFrame:
    """One fragment a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _tokenizers(*(c.value for c in contents))
        for batch in batches:
            for row in batch.to_pylist():
                (ids_a,), (whole_a,) = _encoded(first, [row["part_a"]])
                (ids_b,), (whole_b,) = _encoded(second, [row["part_b"]])
                whole = whole_a and whole_b
                fragment = Fragment.of(ids_a, _ends(first, ids_a, row["begin_a"]), ids_b, _ends(second, ids_b, row["begin_b"]))
                yield from _fragment_row(row["slice"], row["k"], whole, fragment if whole else None).to_batches()

    names = ", ".join(f"{c} binary" for c in Fragment._fields)
    return chunks.select("slice", "k", "part_a", "part_b", "begin_a", "begin_b").mapInArrow(
        run, f"text long, k long, whole boolean, {names}")


def _composed(fragments: DataFrame, most: int) -> DataFrame:
    """One fragment a text, by rounds of groups of ``FAN`` neighbours."""

    def run(rows: pa.Table) -> pa.Table:
        own = sorted(rows.to_pylist(), key=lambda r: r["k"])
        whole = all(r["whole"] for r in own)
        return _fragment_row(own[0]["text"], own[0]["k"] // FAN, whole,
                             reduce(compose, map(_read_fragment, own)) if whole else None)

    while most > 1:
        by_group = fragments.groupBy("text", F.floor(F.col("k") / FAN).alias("of"))
        fragments = written(by_group.applyInArrow(run, fragments.schema), "fragments")
        most = -(-most // FAN)
    return fragments


def _second_pass(composed: DataFrame, keys: DataFrame, id_type: pa.DataType, kind: str) -> DataFrame:
    """Slices of the long texts."""
    schema = pa.schema([("id", id_type), *((n, t) for n, t, _ in _COLUMNS)])

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator:
        for batch in batches:
            for row in batch.to_pylist():
                yield row["id"], _read_fragment(row) if row["whole"] else None

    return composed.join(keys, "text").mapInArrow(lambda batches: _sliced(items(batches), schema), kind)


def _with_counts(sliced: DataFrame, answers: DataFrame, id_kind: str, id_type: pa.DataType) -> DataFrame:
    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    empty = pa.schema([("id", id_type), *((n, pa.string() if n == "groups_sha256" else pa.int64()) for n in names),
                       ("n_best", pa.int64()), ("count_sum", pa.int64())])

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        kinds = np.array(rows.column("kind").to_pylist(), object)
        documents = rows.filter(pa.array(kinds == "document"))
        held = rows.filter(pa.array(kinds == "groups")).to_pylist()
        if not held:
            return empty.empty_table()
        starts, pairs, times = (np.frombuffer(held[0][c], t) for c, t in (("starts", "<i8"), ("groups", "<i4"), ("times", "<i8")))
        counts, best = np.zeros(found.num_rows, np.int64), np.zeros(found.num_rows, np.int64)
        number = np.asarray(found.column("pair"))
        counts[number], best[number] = np.asarray(found.column("n")), np.asarray(found.column("best"))
        of_group = [np.add.reduceat(times * values[pairs], starts[:-1]) if len(pairs) else values for values in (best, counts)]
        sums = [[], []]
        for groups, often in zip(*(documents.column(c).to_pylist() for c in ("groups", "times")), strict=True):
            groups, often = np.frombuffer(groups, "<i4"), np.frombuffer(often, "<i4").astype(np.int64)
            for out, values in zip(sums, of_group, strict=True):
                out.append(int((often * values[groups]).sum()) if len(groups) else 0)
        return pa.Table.from_arrays([*documents.select(["id", *names]).columns, *(pa.array(s, pa.int64()) for s in sums)],
                                    schema=empty)

    own = sliced.where(F.col("kind").isin("document", "groups")).select(
        "slice", "kind", "id", *names, "starts", "groups", "times")
    return own.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(
        run, f"id {id_kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")


def aligned(documents: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
            chunk: int = CHUNK) -> DataFrame:
    """``id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum`` of each row, for the byte vocabulary at
    ``path_a`` and the piece model at ``path_b``, files that the driver reads."""
    spark = documents.sparkSession
    contents = [spark.sparkContext.broadcast(c) for c in (Path(path_a).read_text(encoding="utf-8"), Path(path_b).read_bytes())]
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    id_kind = rows.schema["id"].dataType.simpleString()
    id_type = rows.limit(0).select("id").toArrow().schema.field("id").type
    kind = ", ".join([f"id {id_kind}", *(f"{n} {t}" for n, _, t in _COLUMNS)])
    first = written(_first_pass(rows, contents, id_type, kind, chunk), "aligned")
    chunks = first.where("kind = 'chunk'")
    most = chunks.agg(F.max("k")).first()[0]
    sliced = first
    if most is not None:
        fragments = written(_fragments(chunks.repartition("slice", "k"), contents), "fragments")
        keys = chunks.where("k = 0").select(F.col("slice").alias("text"), "id")
        composed = _composed(fragments, most + 1)
        sliced = first.unionByName(written(_second_pass(composed, keys, id_type, kind), "aligned-long"))
    pairs = sliced.where("kind = 'pair'").select("slice", "pair", "a", "b", "documents")
    totals = pairs.groupBy("a", "b").agg(F.sum("documents").alias("n"))
    best = F.max("n").over(Window.partitionBy("a")) == F.col("n")
    totals = written(totals.withColumn("best", best.cast("long")), "totals")
    answers = written(pairs.drop("documents").join(totals, ["a", "b"]).select("slice", "pair", "n", "best"), "answers")
    return _with_counts(sliced, answers, id_kind, id_type)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return aligned(table(spark, sf_dir, "documents"), *paths).select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {"op13_alignment": op13_alignment}
SQL: dict[str, str] = {}
