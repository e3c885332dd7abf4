"""Secrets by fixed patterns, and by a linear-chain conditional random field over the tokens of a text.

A token (text between blanks) is the begin of a secret, inside one, or outside. Features are its shape, its neighbours'
shapes and what else the text holds; the best labels are found by Viterbi. Spans of the field are added where no pattern
has a span; spans of patterns always stay.

The field is fitted to labels that the patterns give on a bounded sample: ``sample`` texts with a pattern's span and as
many without, those with the smallest hash, and of each whole text at most SAMPLE_WINDOWS windows with a span and as many
without, by hash as well. Most tokens of a
text are plain words after plain words, without a digit of any script and not of the letters a-f only. If such a token's
score for "outside" leads by more than two transitions can make up, the best path is outside there, so the text falls into
short chains that are decoded one by one; that is exact, and where the fitted weights give no such lead, the whole text is
one chain.

Rules: a null or empty text has no spans. Offsets count code points, ends are exclusive. Repeated rows are alike.
"""

from __future__ import annotations

import json
import re
import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from snapforge.llm.common import first_by_hash, table, written
from snapforge.llm.vocabulary import slices

# The patterns of the contract, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # as [0-9a-f]+ that is long enough, since a run is taken whole
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "field")
NAMES = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)

SAMPLE, SAMPLE_WINDOWS, WINDOW_CHARS = 600, 25, 20_000
OUT, BEGIN, IN = 0, 1, 2
TOKEN = re.compile(r"\S+")
#: Tokens that are not plain words: a digit, an operator of assignments or of encoded text, a name, or long.
ODD = re.compile(r"(?<!\S)(?:(?=\S*[0-9=_+/:])\S+|\S{20,}|(?=\S*(?:[Pp][Aa][Ss][Ss][Ww]|[Ss][Ee][Cc][Rr][Ee][Tt]"
                 r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))\S+)")
#: Digits other than 0-9: words with one are plain, but have features of digits.
DIGITS = frozenset(c for c in map(chr, range(128, sys.maxunicode + 1)) if c.isdigit())
#: What the field looks at in texts that may have such words, or words of nothing but letters a-f: odd tokens and these.
_DIGIT, _MARKS, HEX_LETTERS = re.escape("".join(sorted(DIGITS))), r"""["'`,;.()\[\]{}<>]*+""", re.compile("[a-f]{8}")
WATCHED = re.compile(rf"{ODD.pattern[:-1]}|[^\s{_DIGIT}]*+[{_DIGIT}]\S*+|{_MARKS}[a-f]{{8,}}+{_MARKS}(?!\S))")


def _watched(text: str) -> re.Pattern[str]:
    rare = HEX_LETTERS.search(text) or not text.isascii() and not DIGITS.isdisjoint(text)
    return WATCHED if rare else ODD


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(begin, end, kind number)`` of the patterns, by begin and kind."""
    found, lower = [], None
    if ":" in text or "=" in text:
        lower = text.lower()
        if any(name in lower for name in ("passw", "secret", "token", "api")):
            found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted((b, e, k) for b, e, k in found)


FEATURES = (
    "bias", "plain", "digit", "upper and lower", "letters and digits", "only hexadecimal", "access shape", "encoded shape",
    "operator", "name", "name and operator", "ends in operator", "quoted", "length 8", "length 16", "length 32",
    "length 64", "many kinds of characters", "after name", "after operator", "after odd", "before odd", "before plain",
    "text with names", "text with assignments", "long value after operator", "long value")
PLACE = {name: k for k, name in enumerate(FEATURES)}
_OPERATOR, _ENCODED = re.compile("[:=]"), re.compile(r"[A-Za-z0-9+/_.=-]+")


def _shape(token: str) -> tuple[list[int], bool, bool, bool]:
    """Feature numbers of one token; whether it is odd, holds a name, ends in an operator."""
    core = token.strip("\"'`,;.()[]{}<>")
    odd, named, ends = bool(ODD.match(token)), bool(NAMES.search(token)), token.rstrip("\"'").endswith((":", "="))
    digit, letter = any(map(str.isdigit, core)), any(map(str.isalpha, core))
    value = _OPERATOR.split(core)[-1].strip("\"'")
    tests = {
        "plain": not odd, "digit": digit, "upper and lower": core != core.lower() and core != core.upper(),
        "letters and digits": digit and letter, "only hexadecimal": len(core) >= 8 and not core.strip("0123456789abcdef"),
        "access shape": core.isupper() and digit and core.isalnum() and len(core) >= 12,
        "encoded shape": bool(_ENCODED.fullmatch(core)) and digit, "operator": bool(_OPERATOR.search(token)), "name": named,
        "name and operator": named and bool(_OPERATOR.search(token)), "ends in operator": ends,
        "quoted": odd and token[:1] in "\"'", "length 8": odd and len(core) >= 8, "length 16": odd and len(core) >= 16,
        "length 32": odd and len(core) >= 32, "length 64": odd and len(core) >= 64,
        "many kinds of characters": odd and len(set(core)) >= 10,
        "long value": odd and len(value) >= 8 and any(map(str.isdigit, value)),
        "long value after operator": value != core and len(value) >= 8 and any(map(str.isdigit, value))}
    return [0, *(PLACE[k] for k, v in tests.items() if v)], odd, named, ends


def features(tokens: list[str], names: bool, assignments: bool, before: str | None = None,
             after: str | None = None) -> np.ndarray:
    """A row of 0 and 1 for each token; ``before`` and ``after`` are the neighbours of the first and the last one."""
    shapes = [_shape(t) if t is not None else None for t in (before, *tokens, after)]
    out = np.zeros((len(tokens), len(FEATURES)), np.float64)
    for k in range(len(tokens)):
        left, own, right = shapes[k:k + 3]
        out[k, own[0]] = 1
        if left:
            out[k, [PLACE["after odd"]] * left[1] + [PLACE["after name"]] * left[2] + [PLACE["after operator"]] * left[3]] = 1
        if right:
            out[k, PLACE["before odd" if right[1] else "before plain"]] = 1
    out[:, PLACE["text with names"]], out[:, PLACE["text with assignments"]] = names, assignments
    return out


def viterbi(emission: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Labels of the best path; a chain begins and ends outside, ties go to the smaller label."""
    score, back = emission[0] + transition[OUT], []
    for row in emission[1:]:
        ways = score[:, None] + transition
        back.append(ways.argmax(0))
        score = ways.max(0) + row
    path = [int((score + transition[:, OUT]).argmax())]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return np.array(path[::-1])


class Field:
    def __init__(self, weights: np.ndarray, transition: np.ndarray) -> None:
        self.weights, self.transition = weights, transition
        # an unwatched word after an unwatched word, whatever else it and its text may be; all other features of a word need
        # a token that is watched, here or before
        sure = [PLACE["bias"], PLACE["plain"]]
        free = [PLACE[n] for n in ("upper and lower", "before odd", "before plain", "text with names",
                                   "text with assignments")]
        lead = weights[:, [OUT]] - weights
        self.cuts = bool((lead[sure].sum(0) + np.minimum(lead[free], 0).sum(0))[1:].min() > 2 * np.ptp(transition))

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Begin and end of each secret: a begin token with the inside tokens that follow it."""
        names = bool(NAMES.search(text))
        assignments = "=" in text
        out: list[tuple[int, int]] = []
        for chain, before, after in self._chains(text):
            rows = features([t for t, _ in chain], names, assignments, before, after)
            labels = viterbi(rows @ self.weights, self.transition)
            for (token, at), label in zip(chain, labels, strict=True):
                if label == BEGIN or label == IN and not out:
                    out.append((at, at + len(token)))
                elif label == IN:
                    out[-1] = (out[-1][0], at + len(token))
        return out

    def _chains(self, text: str) -> Iterator[tuple[list[tuple[str, int]], str | None, str | None]]:
        """Runs of tokens that may be other than outside, with the sure tokens around them."""
        if not self.cuts:
            chain = [(m[0], m.start()) for m in TOKEN.finditer(text)]
            if chain:
                yield chain, None, None
            return
        chain, end = [], 0
        for m in _watched(text).finditer(text):
            if chain and text[end:m.start()].strip():  # a word between: it belongs to the chain before
                follower = TOKEN.search(text, end)
                chain.append((follower[0], follower.start()))
                rest = TOKEN.search(text, follower.end())
                if rest.start() < m.start():
                    yield chain, self._before(text, chain[0][1]), rest[0]
                    chain = []
            chain.append((m[0], m.start()))
            end = m.end()
        if chain:
            follower = TOKEN.search(text, end)
            if follower:
                chain.append((follower[0], follower.start()))
            rest = TOKEN.search(text, follower.end()) if follower else None
            yield chain, self._before(text, chain[0][1]), rest and rest[0]

    @staticmethod
    def _before(text: str, at: int) -> str | None:
        end = at
        while end and text[end - 1].isspace():
            end -= 1
        begin = end
        while begin and not text[begin - 1].isspace():
            begin -= 1
        return text[begin:end] or None


def windows(text: str) -> list[str]:
    """The windows of six tokens that a text gives the sample, each as JSON: tokens, labels by the patterns, the tokens
    before and after, and whether the text holds names and assignments. Windows hold an odd token or begin the text;
    one of more than WINDOW_CHARS characters is not taken."""
    tokens = [(m[0], m.start(), m.end()) for m in TOKEN.finditer(text)]
    names, assignments, labels = bool(NAMES.search(text)), "=" in text, [OUT] * len(tokens)
    ends = [e for _, _, e in tokens]
    for begin, end, _ in base_spans(text):
        first = bisect_right(ends, begin)
        for k in range(first, len(tokens)):
            if tokens[k][1] >= end:
                break
            labels[k] = BEGIN if k == first else IN
    found: tuple[list[tuple[int, str]], ...] = ([], [])
    for begin in sorted({k // 6 for k, (t, _, _) in enumerate(tokens) if ODD.match(t)} | {0}) if tokens else []:
        part = slice(6 * begin, 6 * begin + 6)
        words = [t for t, _, _ in tokens[part]]
        before = tokens[6 * begin - 1][0] if begin else None
        after = tokens[6 * begin + 6][0] if len(tokens) > 6 * begin + 6 else None
        if sum(map(len, [*words, before or "", after or ""])) <= WINDOW_CHARS:
            window = json.dumps([words, labels[part], before, after, names, assignments])
            found[any(labels[part])].append((crc32(f"{begin}{window}".encode()), window))
    return [window for some in found for _, window in sorted(some)[:SAMPLE_WINDOWS]]


def fit(texts: list[str], rounds: int = 80, penalty: float = 0.05) -> Field:
    """A field from the windows of the texts."""
    return fit_windows([w for text in texts if text for w in windows(text)], rounds, penalty)


def fit_windows(sample: list[str], rounds: int = 80, penalty: float = 0.05) -> Field:
    """By the gradient of the likelihood of the labels; the order of the windows makes no difference."""
    chains = []
    for words, labels, before, after, names, assignments in map(json.loads, sorted(sample)):
        chains.append((features(words, names, assignments, before, after), np.array(labels)))
    weights, transition = np.zeros((len(FEATURES), 3)), np.zeros((3, 3))
    weights[PLACE["plain"], OUT] = 1.0
    if not chains:
        return Field(weights, transition)
    length = max(len(y) for _, y in chains)
    x, y = np.zeros((len(chains), length, len(FEATURES))), np.full((len(chains), length), -1)
    for k, (rows, labels) in enumerate(chains):
        x[k, :len(labels)], y[k, :len(labels)] = rows, labels
    held = y >= 0
    gold = np.eye(3)[np.where(held, y, 0)] * held[..., None]
    pairs = np.einsum("nta,ntb->ab", gold[:, :-1], gold[:, 1:])
    flat, n = x.reshape(-1, len(FEATURES)), len(chains)
    step_w, step_t = np.full_like(weights, 1e-8), np.full_like(transition, 1e-8)
    for _ in range(rounds):
        single, double = _marginals(x @ weights, transition, held)
        slope_w = flat.T @ (single - gold).reshape(-1, 3) / n + penalty * weights / 50
        slope_t = (double - pairs) / n + penalty * transition
        step_w += slope_w ** 2
        step_t += slope_t ** 2
        weights -= 0.5 * slope_w / np.sqrt(step_w)
        transition -= 0.1 * slope_t / np.sqrt(step_t)
    return Field(weights, transition)


def _marginals(emission: np.ndarray, transition: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward over all chains at once: chances of each label, and summed chances of each pair."""
    n, length, _ = emission.shape

    def total(v: np.ndarray, axis: int) -> np.ndarray:
        top = v.max(axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(v - top).sum(axis))

    forward, backward = np.empty_like(emission), np.zeros_like(emission)
    forward[:, 0] = emission[:, 0]
    for t in range(1, length):
        moved = total(forward[:, t - 1, :, None] + transition, 1) + emission[:, t]
        forward[:, t] = np.where(held[:, t, None], moved, forward[:, t - 1])
    for t in range(length - 2, -1, -1):
        moved = total(transition + (emission[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(held[:, t + 1, None], moved, 0)
    norm = total(forward[:, -1], 1)
    single = np.exp(forward + backward - norm[:, None, None]) * held[..., None]
    double = np.zeros((3, 3))
    for t in range(1, length):
        joint = (forward[:, t - 1, :, None] + transition + (emission[:, t] + backward[:, t])[:, None, :]
                 - norm[:, None, None])
        double += (np.exp(joint) * held[:, t, None, None]).sum(0)
    return single, double


def find(text: str | None, field: Field) -> list[tuple[int, int, int]]:
    """All spans by begin and kind: the patterns', and the field's where it meets none of those."""
    if not text:
        return []
    base = base_spans(text)
    begins, upto = [b for b, _, _ in base], list(accumulate((e for _, e, _ in base), max))

    def free(begin: int, end: int) -> bool:
        before = bisect_left(begins, end)
        return not before or upto[before - 1] <= begin

    added = [(b, e, 3) for b, e in field.spans(text) if free(b, e)]
    return sorted(base + added, key=lambda s: (s[0], s[2]))


def masked(text: str | None, spans: list[tuple[int, int, int]], mark: str = "<secret>") -> str | None:
    """``text`` with each run of overlapping spans replaced by ``mark``."""
    if not spans:
        return text
    parts, upto = [], 0
    for begin, end, _ in spans:
        if begin >= upto:
            parts += [text[upto:begin], mark]
        upto = max(upto, end)
    return "".join([*parts, text[upto:]])


SPAN = StructType([StructField("kind", StringType()), StructField("begin", IntegerType()), StructField("end", IntegerType())])
PATTERN_IN_TEXT = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{8}"
                   r"|(?-i:AKIA[A-Z0-9]{12}|[0-9a-f]{32})")


def learn(documents: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """A field from at most ``2 * sample`` texts: the first by hash of those with and of those without a pattern's span.
    Whole texts are judged, and their windows cut, by the tasks that read them."""
    rows = documents.where(F.col(text_col).isNotNull()).select(
        F.xxhash64(F.col(id_col).cast("string"), text_col).alias("h"), F.col(text_col).alias("text"))
    marked = written(rows.select("h", F.col("text").rlike(PATTERN_IN_TEXT).alias("shown")).distinct(), "marked")
    chosen = first_by_hash(marked, "shown", "h", sample).select("h")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                found = [windows(t) for t in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column("h"), pa.array(found, pa.list_(pa.string()))], ["h", "windows"])

    taken = rows.join(F.broadcast(chosen), "h").mapInArrow(cut, "h long, windows array<string>")
    once = taken.groupBy("h").agg(F.min("windows").alias("windows"))
    return fit_windows([w for r in once.collect() for w in r["windows"]])


def scan(rows: DataFrame, field: Field, text_col: str = "text", out: str = "spans", masked_col: str | None = None) -> DataFrame:
    """``rows`` with an array of ``kind, begin, end`` for the secrets of ``text_col``, and with ``masked_col`` the text
    without them; both replace columns of these names."""
    shared = rows.sparkSession.sparkContext.broadcast(field)
    kept = rows.drop(out, masked_col or out)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text_col):
                texts = piece.column(text_col).to_pylist()
                found = [find(t, shared.value) for t in texts]
                rows_of = [[{"kind": KINDS[k], "begin": b, "end": e} for b, e, k in spans] for spans in found]
                columns, names = [*piece.columns, pa.array(rows_of, kind)], [*piece.schema.names, out]
                if masked_col:
                    columns.append(pa.array(map(masked, texts, found), pa.string()))
                    names.append(masked_col)
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = StructType([*kept.schema.fields, StructField(out, ArrayType(SPAN))])
    return kept.mapInArrow(run, schema.add(masked_col, StringType()) if masked_col else schema)


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(documents, learn(documents)).drop("text")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = found.withColumn("base", F.filter("spans", lambda s: s["kind"] != KINDS[3]))
    return base.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


QUERIES = {"op8_secret_scan": op8_secret_scan}
SQL: dict[str, str] = {}
