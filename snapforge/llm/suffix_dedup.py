"""Repeated passages by bucket-pointer refinement of suffixes, without a shuffle of every suffix.

A window is ``depth`` bytes. Its anchor is the smallest q-gram inside (the leftmost of equals; q is a third of the depth),
so equal windows have equal anchors at equal places, and neighbouring windows share one. The anchors are the suffixes
that are sorted, about one in seventeen bytes:

1. Initial buckets: the q-grams of the anchors. A bucket with one document only is finished; its windows are unique. Each
   member has a context, the bytes of all windows it anchors. Members with equal contexts are one: all but the smallest
   document are repeated there, and a bucket with one context is finished.
2. What is left is refined, for the smallest document of each context: bytes are numbered by their 8-gram, then by the pair
   (number here, number 8 further on), and so on until the numbers stand for ``depth`` bytes, each round using the
   numbers of the round before. Windows are sorted by their numbers, equal ones are confirmed on their bytes (where two
   differ, the numbers are made anew as exact ranks, by a sort in each round), and the smallest document of each is known.
3. A bucket with too many members for one task is not refined there: its windows themselves become keys that Spark groups.

Buckets and contexts are named by 64 bits each, so two contexts are taken for one with a chance of 2 to the power of -64
for each pair inside a bucket; windows are compared by exact numbers or as bytes. Documents are dealt to slices of
bounded size that are stored once, bucketed by slice; each step reads them in place, and a slice sends every context or
window once, whatever number of its documents hold it. So a passage of all documents costs a row per slice.

Rules: a byte goes if a window over it also starts in a document with a smaller id, judged on the input. Texts are bytes;
matches stay inside a document. A null text is empty. A null id is neither smaller nor larger: its row is kept whole
and takes nothing from others. Rows with one id do not take from each other, whether their texts are equal or not, and
each row gives a row. A text shorter than a window is kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapforge.llm.common import table, written
from snapforge.session import new_run_dir

DEPTH, CROWD = 50, 20_000
CONTEXTS = 32  # contexts of one bucket that a slice sends before it calls the bucket crowded
SLICE_BYTES = 8 << 20
REPEATED, OPEN, CROWDED = range(3)
PIECE = 1 << 16  # bytes looked at in one go, so that what is made of them stays in the caches
PLACE_BITS = 20
SPANS = "array<struct<begin:long,end:long>>"


def _mixed(x: np.ndarray) -> np.ndarray:
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x ^= x >> np.uint64(33)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(33)
    return x


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)


def _eight(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every place on as one number, in the order of the bytes."""
    out, width = data.astype(np.uint64), 1
    while width < 8:
        out = (out[:-width] << np.uint64(8 * width)) | out[width:]
        width *= 2
    return out


def gram_length(depth: int) -> int:
    if depth < 16:
        raise ValueError("a window has 16 bytes at least")
    return max(8, depth // 3)


def _longer(numbers: np.ndarray, width: int, length: int) -> np.ndarray:
    """Numbers of ``length`` bytes from those of ``width`` bytes, here and further on."""
    while width < length:
        step = min(width, length - width)
        numbers = _pair(numbers[:-step], numbers[step:])
        width += step
    return numbers


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def refined(data: np.ndarray, depth: int) -> np.ndarray:
    """A number for the ``depth`` bytes from every place on: equal bytes, equal number, in the order of the bytes."""
    numbers, width = np.unique(_eight(data), return_inverse=True)[1].astype(np.uint64), 8
    while width < depth:
        step = min(width, depth - width)
        pairs = numbers[:-step] * np.uint64(len(numbers)) + numbers[step:]
        numbers = np.unique(pairs, return_inverse=True)[1].astype(np.uint64)
        width += step
    return numbers


class Anchors:
    """The anchors of some texts: text, first window, number of windows, place of the gram behind the first window, gram,
    and a number of the context."""

    NAMES = ("doc", "begin", "count", "lead", "gram", "context")

    def __init__(self, texts: list[bytes], depth: int) -> None:
        self.texts, self.depth, self.length = texts, depth, gram_length(depth)
        found: list[tuple] = []
        held, windows = [], 0
        for k, text in enumerate(texts):
            for begin in range(0, max(len(text) - depth + 1, 0), PIECE):
                end = min(begin + PIECE, len(text) - depth + 1)
                if held and windows + end - begin > PIECE:
                    found.append(self._piece(held))
                    held, windows = [], 0
                held.append((k, begin, end))
                windows += end - begin + depth - 1
        if held:
            found.append(self._piece(held))
        columns = [np.concatenate(parts) for parts in zip(*found, strict=True)] if found else [
            np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64)]
        self.doc, self.begin, self.count, self.lead, self.gram, self.context = columns

    def _piece(self, held: list[tuple[int, int, int]]) -> tuple:
        tail = self.depth - 1
        data = np.frombuffer(b"".join(self.texts[k][begin:end + tail] for k, begin, end in held), np.uint8)
        grams = _longer(_eight(data), 8, self.length) if self.length > 8 else _mixed(_eight(data))
        mask = np.uint64((1 << PLACE_BITS) - 1)
        marked = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
        owner = (_sliding_least(marked, self.depth - self.length + 1) & mask).astype(np.int64)
        sizes = np.array([end - begin for _, begin, end in held])
        offsets = np.cumsum(sizes + tail) - (sizes + tail)  # place of each part in the data
        part = np.repeat(np.arange(len(held)), sizes)
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + offsets[part]
        owner = owner[place]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (part[1:] != part[:-1])
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(owner)))
        first, part, anchor = place[at], part[at], owner[at]
        lead = anchor - first
        shape = (lead * self.depth + count).astype(np.uint64)
        steps = [*range(0, self.depth - self.length, self.length), self.depth - self.length]
        context = _mixed(shape)
        for at in (first, first + count - 1):  # these two windows cover all of it
            for step in steps:
                context = _pair(context, grams[at + step])
        docs, begins = np.array([k for k, _, _ in held]), np.array([begin for _, begin, _ in held])
        return docs[part], first - offsets[part] + begins[part], count, lead, grams[anchor], context

    def bytes_of(self, k: int) -> bytes:
        begin = int(self.begin[k])
        return self.texts[self.doc[k]][begin:begin + int(self.count[k]) + self.depth - 1]


def _taking_part(texts: pa.Table, depth: int) -> tuple[Anchors, np.ndarray]:
    """Anchors of the rows with an id, and the id of each anchor's document."""
    ids = texts.column("id")
    valid = np.array(ids.is_valid())
    rows = [t if ok else b"" for t, ok in zip(texts.column("text").to_pylist(), valid, strict=True)]
    anchors = Anchors(rows, depth)
    return anchors, np.array(ids.fill_null(0), np.int64)[anchors.doc]


def _slice_of(texts: pa.Table) -> int:
    return texts.column("slice")[0].as_py()


def _signed(numbers: np.ndarray) -> pa.Array:
    return pa.array(numbers.view(np.int64))


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys, and the places in it where a group begins."""
    order = np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.any([key[order][1:] != key[order][:-1] for key in keys], axis=0)
    return order, np.flatnonzero(new)


def _initial_buckets(texts: DataFrame, depth: int) -> DataFrame:
    """Per slice, gram and context: smallest and largest document, the latter null if it is the same, and rows of one
    document together, which makes the shuffle smaller. A gram with many contexts in a slice gives one row without any."""

    def run(rows: pa.Table) -> pa.Table:
        anchors, ids = _taking_part(rows, depth)
        order, at = _groups(anchors.gram, anchors.context)
        if not len(order):
            return pa.table({c: pa.array([], pa.int64()) for c in ("gram", "context", "slice", "low", "high")})
        low, high = np.minimum.reduceat(ids[order], at), np.maximum.reduceat(ids[order], at)
        gram, context = anchors.gram[order][at], anchors.context[order][at]
        begin = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        sizes = np.diff(np.append(begin, len(gram)))
        many = np.repeat(sizes > CONTEXTS, sizes)
        first = np.zeros(len(gram), bool)
        first[begin] = True
        low = np.where(many, np.repeat(np.minimum.reduceat(low, begin), sizes), low)
        high = np.where(many, np.repeat(np.maximum.reduceat(high, begin), sizes), high)
        kept = np.flatnonzero(~many | first)
        kept = kept[np.argsort(low[kept], kind="stable")]
        return pa.table({
            "gram": _signed(gram[kept]), "context": pa.array(context[kept].view(np.int64), mask=many[kept]),
            "slice": pa.array(np.full(len(kept), _slice_of(rows))), "low": pa.array(low[kept]),
            "high": pa.array(high[kept], mask=(high == low)[kept])})

    return texts.groupBy("slice").applyInArrow(run, "gram long, context long, slice long, low long, high long")


def _read_all(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held) if held else None


def _per_group(values: np.ndarray, at: np.ndarray, total: int) -> np.ndarray:
    """One value a group, given to all members."""
    return np.repeat(values, np.diff(np.append(at, total)))


def _shared_buckets(buckets: DataFrame, parts: int, crowd: int) -> DataFrame:
    """``slice, gram, context, lowest, state`` of buckets with several documents: ``lowest`` is the smallest document
    with the context. REPEATED: it is smaller than one of the slice. OPEN: the slice has that document, and the bucket
    has other contexts, so its windows are to be looked at. CROWDED: the bucket is too large for one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _read_all(batches)
        if rows is None:
            return
        order, at = _groups(np.asarray(rows.column("gram")), np.asarray(pc.fill_null(rows.column("context"), 0)))
        rows, total = rows.take(pa.array(order)), len(order)
        gram, owner, low = (np.asarray(rows.column(c)) for c in ("gram", "slice", "low"))
        context, high = rows.column("context"), np.asarray(pc.coalesce(rows.column("high"), rows.column("low")))
        lowest = _per_group(np.minimum.reduceat(low, at), at, total)
        by_gram = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        several = _per_group(np.minimum.reduceat(low, by_gram) < np.maximum.reduceat(high, by_gram), by_gram, total)
        sizes = np.diff(np.append(by_gram, total))
        unnamed = np.logical_or.reduceat(~np.asarray(context.is_valid()), by_gram)
        crowded = several & _per_group(unnamed | (sizes > crowd), by_gram, total)
        new = np.zeros(total, np.int64)
        new[at] = 1
        several_contexts = _per_group(np.add.reduceat(new, by_gram) > 1, by_gram, total)
        repeated, opened = several & ~crowded & (lowest < high), several & ~crowded & several_contexts & (low == lowest)
        out = [(crowded, CROWDED), (repeated, REPEATED), (opened, OPEN)]
        for rows_of, state in out:
            n = int(rows_of.sum())
            chosen = [pa.array(owner[rows_of]), pa.array(gram[rows_of]), context.filter(pa.array(rows_of)).combine_chunks(),
                      pa.array(lowest[rows_of]), pa.array(np.full(n, state, np.int32))]
            yield pa.RecordBatch.from_arrays(chosen, ["slice", "gram", "context", "lowest", "state"])

    kind = "slice long, gram long, context long, lowest long, state int"
    return buckets.repartition(parts, "gram").mapInArrow(run, kind)


def _members(texts: DataFrame, shared: DataFrame, depth: int) -> DataFrame:
    """The bytes of open contexts, and all windows of crowded buckets, once a slice."""
    names = ("slice", "gram", "context", "bytes", "low", "high")
    empty = pa.schema([(c, pa.binary() if c == "bytes" else pa.int64()) for c in names])

    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        if not rows.num_rows or not known.num_rows:
            return empty.empty_table()
        anchors, ids = _taking_part(rows, depth)
        own = pd.DataFrame({"gram": anchors.gram.view(np.int64), "context": anchors.context.view(np.int64), "id": ids,
                            "k": np.arange(len(ids))})
        asked = known.filter(pc.equal(known.column("state"), OPEN)).select(["gram", "context"]).to_pandas()
        opened = own.merge(asked, on=["gram", "context"]).groupby(["gram", "context"], as_index=False).agg(
            low=("id", "min"), high=("id", "max"), k=("k", "min"))
        n = len(opened)
        out = [pa.Table.from_arrays([
            pa.array(np.full(n, _slice_of(rows))), *(pa.array(opened[c].to_numpy(np.int64)) for c in ("gram", "context")),
            pa.array([anchors.bytes_of(k) for k in opened["k"]], pa.binary()),
            *(pa.array(opened[c].to_numpy(np.int64)) for c in ("low", "high"))], schema=empty)]
        crowded = np.asarray(known.filter(pc.equal(known.column("state"), CROWDED)).column("gram"))
        windows: dict[bytes, list[int]] = {}
        for k in np.flatnonzero(np.isin(own["gram"], crowded)):
            text, doc, gram = anchors.bytes_of(k), int(ids[k]), int(own["gram"][k])
            for w in range(int(anchors.count[k])):
                found = windows.setdefault(text[w:w + depth], [gram, doc, doc])
                found[1], found[2] = min(found[1], doc), max(found[2], doc)
        gram, low, high = zip(*windows.values(), strict=True) if windows else ((), (), ())
        n = len(windows)
        out.append(pa.Table.from_arrays([
            pa.array(np.full(n, _slice_of(rows))), pa.array(gram, pa.int64()), pa.nulls(n, pa.int64()),
            pa.array(windows, pa.binary()), pa.array(low, pa.int64()), pa.array(high, pa.int64())], schema=empty))
        return pa.concat_tables(out)

    asking = shared.where(F.col("state") != REPEATED)
    return texts.groupBy("slice").cogroup(asking.groupBy("slice")).applyInArrow(
        run, "slice long, gram long, context long, bytes binary, low long, high long")


def _lowest_of_windows(contexts: list[bytes], lowest: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, place and smallest document of all windows of these contexts."""
    sizes = np.array([len(c) - depth + 1 for c in contexts])
    starts = np.cumsum(sizes + depth - 1) - (sizes + depth - 1)
    which = np.repeat(np.arange(len(contexts)), sizes)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    at = starts[which] + place
    eight = _eight(data)
    numbers = _longer(_mixed(eight.copy()), 8, depth)[at]
    order, begin = _groups(numbers)
    one = np.repeat(at[order[begin]], np.diff(np.append(begin, len(order))))
    if any((eight[at[order] + step] != eight[one + step]).any() for step in [*range(0, depth - 8, 8), depth - 8]):
        order, begin = _groups(refined(data, depth)[at])  # two different windows met in one number
    out = np.empty(len(order), np.int64)
    out[order] = _per_group(np.minimum.reduceat(lowest[which][order], begin), begin, len(order))
    return which, place, out


def _refined_buckets(members: DataFrame, depth: int, parts: int) -> DataFrame:
    """``slice, gram, context, first, last, lowest``: windows ``first`` to ``last`` of a context also are in document
    ``lowest``; only where it is smaller than a document of the slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _read_all(batches)
        if rows is None:
            return
        gram, sizes = np.asarray(rows.column("gram")), np.asarray(pc.binary_length(rows.column("bytes")))
        order, begin = _groups(gram)
        total = np.add.reduceat(sizes[order], begin)
        part = (np.cumsum(total) - total) // PIECE  # whole buckets, about a piece of bytes together
        edges = np.append(begin[np.append(True, part[1:] != part[:-1])], len(order))
        for start, end in pairwise(edges.tolist()):
            yield answered(rows.take(pa.array(order[start:end])))

    def answered(rows: pa.Table) -> pa.RecordBatch:
        owner, gram, context, low, high = (np.asarray(rows.column(c)) for c in ("slice", "gram", "context", "low", "high"))
        coded = rows.column("bytes").combine_chunks().dictionary_encode()
        code, texts = np.asarray(coded.indices), coded.dictionary.to_pylist()
        order, at = _groups(code)
        which, place, least = _lowest_of_windows(texts, np.minimum.reduceat(low[order], at), depth)
        new = np.ones(len(which), bool)
        new[1:] = (which[1:] != which[:-1]) | (least[1:] != least[:-1])
        begin = np.flatnonzero(new)
        of, first, until, least = which[begin], place[begin], place[np.append(begin[1:], len(which)) - 1], least[begin]
        begin = np.searchsorted(of, code)
        n = np.searchsorted(of, code, "right") - begin
        row = np.repeat(np.arange(len(code)), n)
        run_at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + begin[row]
        taken = least[run_at] < high[row]
        row, run_at = row[taken], run_at[taken]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (owner[row], gram[row], context[row], first[run_at], until[run_at], least[run_at])],
            ["slice", "gram", "context", "first", "last", "lowest"])

    return members.where("context is not null").repartition(parts, "gram").mapInArrow(
        run, "slice long, gram long, context long, first long, last long, lowest long")


def _crowded_windows(members: DataFrame) -> DataFrame:
    """``slice, gram, bytes, lowest`` of windows in crowded buckets; a window is one row a slice."""
    lowest = F.min("low").over(Window.partitionBy("bytes"))
    crowded = members.where("context is null").withColumn("lowest", lowest)
    return crowded.where("lowest < high").select("slice", "gram", "bytes", "lowest")


def _joined(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of intervals."""
    out: list[tuple[int, int]] = []
    for b, e in sorted(zip(begin.tolist(), end.tolist(), strict=True)):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


def _spans(anchors: Anchors, ids: np.ndarray, answers: pa.Table, depth: int) -> pd.DataFrame:
    """``doc, begin, end`` of repeated bytes, some of them more than once."""
    crowded = pc.is_valid(answers.column("bytes"))
    # apart before they become pandas columns: numbers beside nulls would be rounded
    runs = answers.filter(pc.invert(crowded)).select(["gram", "context", "first", "last", "lowest"]).to_pandas()
    windows = answers.filter(crowded).select(["gram", "bytes", "lowest"]).to_pandas()
    found = pd.DataFrame({"gram": anchors.gram.view(np.int64), "context": anchors.context.view(np.int64), "doc": anchors.doc,
                          "id": ids, "start": anchors.begin, "count": anchors.count})
    met = found.merge(runs, on=["gram", "context"])
    met = met[met["lowest"] < met["id"]]
    until = met["last"].where(met["last"] >= 0, met["count"] - 1)  # -1: all windows of the context
    parts = [pd.DataFrame({"doc": met["doc"], "begin": met["start"] + met["first"], "end": met["start"] + until + depth})]
    lowest = dict(zip(windows["bytes"], windows["lowest"], strict=True))
    single = []
    for k in np.flatnonzero(found["gram"].isin(windows["gram"].unique())):
        text, begin = anchors.bytes_of(k), int(anchors.begin[k])
        single += [(anchors.doc[k], begin + w, begin + w + depth) for w in range(int(anchors.count[k]))
                   if lowest.get(text[w:w + depth], ids[k]) < ids[k]]
    return pd.concat([*parts, pd.DataFrame(single, columns=["doc", "begin", "end"])])


def _without_spans(texts: DataFrame, answers: DataFrame, depth: int) -> DataFrame:
    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        spans: list[list[tuple[int, int]]] = [[] for _ in range(rows.num_rows)]
        if rows.num_rows and known.num_rows:
            anchors, ids = _taking_part(rows, depth)
            for doc, own in _spans(anchors, ids, known, depth).groupby("doc"):
                spans[int(doc)] = _joined(own["begin"].to_numpy(np.int64), own["end"].to_numpy(np.int64))
        kept = []
        for text, gone in zip(rows.column("text").to_pylist(), spans, strict=True):
            edges = [0, *(p for span in gone for p in span), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if gone else text)
        pairs = [[{"begin": b, "end": e} for b, e in gone] for gone in spans]
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        return pa.table({"id": rows.column("id"), "kept": pa.array(kept, pa.binary()), "spans": pa.array(pairs, kind)})

    return texts.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(
        run, f"id long, kept binary, spans {SPANS}")


def _stored_by_slice(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` and ``slice`` as a table bucketed by it, read in place by all that is grouped by slice, and the number of
    slices. A slice is rows of one input partition, so nothing is shuffled and repeated rows do not share a slice."""
    spark, name = rows.sparkSession, f"slices_{uuid.uuid4().hex}"
    sizes = rows.select(F.octet_length("text").alias("size"), F.spark_partition_id().alias("partition"))
    total, last = sizes.agg(F.sum("size"), F.max("partition")).first()
    partitions = (last or 0) + 1
    each = (total or 0) // (partitions * SLICE_BYTES) + 1
    part = F.pmod(F.xxhash64("id", "text"), F.lit(each))
    dealt = rows.withColumn("slice", F.spark_partition_id().cast("long") * each + part)
    slices = partitions * each
    dealt.write.bucketBy(slices // 2 + 1, "slice").option("compression", "zstd").option(
        "path", new_run_dir(spark, "slices")).saveAsTable(name)
    return spark.table(name), slices


def without_repeats(documents: DataFrame, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text",
                    crowd: int = CROWD) -> DataFrame:
    """``id, kept, spans`` for each row: the bytes that are left, and the places of the removed runs."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = documents.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    texts, slices = _stored_by_slice(rows)
    parts = 2 * slices
    shared = written(_shared_buckets(_initial_buckets(texts, depth), parts, crowd), "shared")
    members = written(_members(texts, shared, depth), "members")
    whole = shared.where(F.col("state") == REPEATED).select(
        "slice", "gram", "context", F.lit(0).cast("long").alias("first"), F.lit(-1).cast("long").alias("last"), "lowest",
        F.lit(None).cast("binary").alias("bytes"))
    refined_runs = written(_refined_buckets(members, depth, parts), "refined")
    answers = whole.unionByName(refined_runs, allowMissingColumns=True).unionByName(
        written(_crowded_windows(members), "windows"), allowMissingColumns=True)
    return _without_spans(texts, answers, depth)


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select(
        F.col("id").alias("doc_id"), (F.octet_length("kept") + removed).cast("long").alias("n_bytes"),
        removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op11_suffix_dedup": op11_suffix_dedup}
SQL: dict[str, str] = {}
