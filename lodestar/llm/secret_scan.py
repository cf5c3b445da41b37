"""Secret scans: fixed patterns, and a linear-chain conditional random field
over token shapes, neighbouring words and file features that adds spans the
patterns do not spell out."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, mix64, text_bytes

# The kinds and their patterns.
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")  # a failing run of AKIA[A-Z0-9]+ holds no passing one
HEX = re.compile("[0-9a-f]{24,}")
LEAST_VALUE = 6

OUT, BEGIN, IN = 0, 1, 2
PIECE = 1 << 20   # code points decoded at once
SIDE = 200        # code points of a training window on each side of its middle

# Feature blocks: (name, size).  A token has one feature of each block.
WORDS = 1 << 13
BLOCKS = (("length", 16), ("kinds", 32), ("hex", 16), ("turns", 48), ("sign", 130), ("before", 131), ("before2", 131),
          ("after", 131), ("word1", WORDS + 1), ("word2", WORDS + 1), ("word_next", WORDS + 1), ("glued", 4),
          ("file_size", 16), ("file_signs", 12), ("file_name", 256))
FIRST = dict(zip((b[0] for b in BLOCKS), np.cumsum([0] + [b[1] for b in BLOCKS]).tolist()))
FEATURES = sum(b[1] for b in BLOCKS)
NEAR = ("word1", "word2", "word_next")
_SPACES = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, by start, then kind."""
    found = []
    low = text.lower()
    if any(w in low for w in ("passw", "secret", "token", "api")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def secret_ranges(text: str) -> list[tuple[int, int]]:
    """The parts of the matches that are secret: of an assignment its value."""
    out = [m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    return out + [m.span() for p in (ACCESS, HEX) for m in p.finditer(text)]


# ------------------------------------------------------------ tokens and features
def _classes() -> np.ndarray:
    """By code point below 128: 0 blank, 1 lower, 2 upper, 3 digit, 4 joiner
    (part of a token), 5 sign (a token of its own); 6 stands for the rest."""
    out = np.full(129, 5, np.uint8)
    out[:33] = 0
    out[127] = 0
    out[ord("a"):ord("z") + 1], out[ord("A"):ord("Z") + 1], out[ord("0"):ord("9") + 1] = 1, 2, 3
    out[[ord(c) for c in "_+/-"]] = 4
    out[128] = 6
    return out


_CLASS = _classes()
_IS_HEX = np.array([chr(c) in "0123456789abcdefABCDEF" for c in range(129)])


@dataclass
class Tokens:
    """Tokens of some texts: range in the joined code points, text number,
    and features (tokens x blocks, as rows of the weights)."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    features: np.ndarray


def _bucket(n: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.array([1, 2, 3, 4, 6, 8, 12, 16, 20, 21, 24, 32, 40, 64]), n, side="right")


def tokenize(codes: np.ndarray, cuts: np.ndarray, sizes: np.ndarray, names: np.ndarray) -> Tokens:
    """Tokens of texts that stand one after the other in ``codes``; ``sizes``
    and ``names`` (numbers) are the file features that texts bring along."""
    small = np.minimum(codes, 128)
    kind = _CLASS[small]
    if (codes > 127).any():
        kind[np.isin(codes, _SPACES)] = 0
    n = len(codes)
    head = np.zeros(n + 1, bool)
    head[cuts] = True
    word = (kind != 0) & (kind != 5)
    begin = (kind == 5) | (word & (head[:-1] | np.append(True, ~word[:-1])))
    start = np.flatnonzero(begin)
    last = (kind == 5) | (word & (head[1:] | np.append(~word[1:], True)))
    end = np.flatnonzero(last) + 1
    text = np.searchsorted(cuts, start, side="right") - 1
    m = len(start)
    if not m:
        none = np.zeros(0, np.int64)
        return Tokens(none, none, none, np.zeros((0, len(BLOCKS)), np.int32))
    length = end - start

    def count(mask: np.ndarray) -> np.ndarray:
        through = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return through[end] - through[start]

    kinds = sum((count(kind == k) > 0).astype(np.int32) << i for i, k in enumerate((1, 2, 3, 4, 6)))
    hexes = count(_IS_HEX[small]) == length
    turn = np.append(False, kind[1:] != kind[:-1])
    turn[start] = False
    turns = np.minimum(count(turn), 7)
    digits = (count(kind == 3) * 5 // length).astype(np.int64)
    sign = np.where(kind[start] == 5, small[start], 129)
    # words: a hash of the lower-cased letters; signs are skipped as neighbours
    lower = np.where(kind == 2, codes + 32, codes).astype(np.uint64)
    with np.errstate(over="ignore"):
        owner = np.cumsum(begin) - 1
        nth = np.arange(n) - start[np.maximum(owner, 0)]
        through = np.concatenate([[np.uint64(0)], np.cumsum(mix64(lower | nth.astype(np.uint64) << np.uint64(32)))])
        mark = ((through[end] - through[start]) % np.uint64(WORDS)).astype(np.int64) + 1
    is_word = sign == 129
    at = np.flatnonzero(is_word)
    before = np.cumsum(is_word) - is_word  # number of words before the token

    def word_at(number: np.ndarray) -> np.ndarray:
        ok = (number >= 0) & (number < len(at))
        there = at[np.clip(number, 0, max(len(at) - 1, 0))] if len(at) else np.zeros(m, np.int64)
        return np.where(ok & (text[there] == text), mark[there], 0)

    def sign_at(shift: int) -> np.ndarray:
        there = np.arange(m) + shift
        ok = (there >= 0) & (there < m)
        there = np.clip(there, 0, m - 1)
        return np.where(ok & (text[there] == text), sign[there], 130)

    glued_left = np.append(False, (start[1:] == end[:-1]) & (text[1:] == text[:-1]))
    per_text = np.maximum(np.bincount(text, minlength=len(cuts) - 1), 1)
    signs = np.bincount(text, sign != 129, len(cuts) - 1)
    columns = {"length": _bucket(length), "kinds": kinds, "hex": np.where(hexes, _bucket(length), 0),
               "turns": turns * 6 + digits, "sign": sign, "before": sign_at(-1), "before2": sign_at(-2), "after": sign_at(1),
               "word1": word_at(before - 1), "word2": word_at(before - 2), "word_next": word_at(before + is_word),
               "glued": glued_left + 2 * np.append(glued_left[1:], False),
               "file_size": np.minimum(np.log2(np.maximum(sizes, 1)).astype(np.int64), 15)[text],
               "file_signs": np.minimum(signs * 20 // per_text, 11).astype(np.int64)[text], "file_name": names[text]}
    features = np.stack([(FIRST[name] + columns[name]).astype(np.int32) for name, _ in BLOCKS], 1)
    return Tokens(start, end, text, features)


# ------------------------------------------------------------ the random field
@dataclass(frozen=True)
class SecretField:
    """Weights of features by tag, and of transitions (from, to)."""

    weights: np.ndarray
    steps: np.ndarray

    def slack(self) -> float:
        """The most that two transitions around a token can gain by a tag
        other than outside; with one neighbour, or none, by one or none."""
        to = np.append(self.steps, np.zeros((1, 3)), 0)    # rows: the tag before, or none
        back = np.append(self.steps, np.zeros((3, 1)), 1)  # columns: the tag after, or none
        return max(float((to[:, y] - to[:, OUT]).max() + (back[y] - back[OUT]).max()) for y in (BEGIN, IN))


def emissions(field: SecretField, features: np.ndarray) -> np.ndarray:
    out = np.zeros((len(features), 3))
    for column in features.T:
        out += field.weights[column]
    return out


def viterbi(field: SecretField, emission: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Best tags of every text's tokens.  A token that is outside by more
    than transitions can make good is outside on every best path, so only the
    runs between such tokens are searched, all of them together."""
    m = len(emission)
    tags = np.zeros(m, np.int8)
    open_ = emission[:, OUT] - emission[:, 1:].max(1, initial=-np.inf) <= field.slack() + 1e-9
    at = np.flatnonzero(open_)
    if not len(at):
        return tags
    new = np.append(True, (np.diff(at) != 1) | (text[at[1:]] != text[at[:-1]]))
    first = at[new]
    size = np.diff(np.append(np.flatnonzero(new), len(at)))
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    left = (first > 0) & (text[np.maximum(first - 1, 0)] == text[first])  # an outside token stands before
    final = first + size
    right = (final < m) & (text[np.minimum(final, m - 1)] == text[first])
    back = np.zeros((m, 3), np.int8)
    score = emission[first] + np.where(left[:, None], field.steps[OUT], 0.0)
    live = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")  # runs of at least so many tokens
    for step in range(1, int(size[0])):
        n = live[step]
        way = score[:n, :, None] + field.steps
        back[first[:n] + step] = way.argmax(1)
        score[:n] = way.max(1) + emission[first[:n] + step]
    tag = (score + np.where(right[:, None], field.steps[:, OUT], 0.0)).argmax(1)
    for step in range(int(size[0]) - 1, -1, -1):
        n = live[step]
        tags[first[:n] + step] = tag[:n]
        if step:
            tag[:n] = back[first[:n] + step, tag[:n]]
    return tags


def log_likelihood(weights: np.ndarray, steps: np.ndarray, features: np.ndarray, tags: np.ndarray, cuts: np.ndarray
                   ) -> tuple[float, np.ndarray, np.ndarray]:
    """Log likelihood of the tags of some chains (``cuts`` into the tokens),
    and its gradients, by forward and backward sums over all chains."""
    size = np.diff(cuts)
    order = np.argsort(-size, kind="stable")
    first, size = cuts[:-1][order], size[order]
    first, size = first[size > 0], size[size > 0]
    emission = emissions(SecretField(weights, steps), features)
    m = len(emission)
    ahead, behind = np.zeros((m, 3)), np.zeros((m, 3))
    live = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")

    def total(x: np.ndarray, axis: int) -> np.ndarray:
        most = x.max(axis, keepdims=True)
        return np.squeeze(most, axis) + np.log(np.exp(x - most).sum(axis))

    ahead[first] = emission[first]
    for step in range(1, int(size[0])):
        at = first[:live[step]] + step
        ahead[at] = total(ahead[at - 1][:, :, None] + steps, 1) + emission[at]
    for step in range(int(size[0]) - 1, 0, -1):
        at = first[:live[step]] + step
        behind[at - 1] = total(steps + (emission[at] + behind[at])[:, None, :], 2)
    norm = total(ahead[first + size - 1], 1)
    by_token = np.empty(m)
    by_token[np.concatenate([np.arange(f, f + s) for f, s in zip(first, size)])] = np.repeat(norm, size)
    share = np.exp(ahead + behind - by_token[:, None])
    head = np.zeros(m, bool)
    head[first] = True
    later = np.flatnonzero(~head)
    pairs = np.exp(ahead[later - 1][:, :, None] + steps + (emission[later] + behind[later])[:, None, :]
                   - by_token[later][:, None, None])
    value = emission[np.arange(m), tags].sum() + steps[tags[later - 1], tags[later]].sum() - norm.sum()
    gap = np.eye(3)[tags] - share
    slope = np.zeros_like(weights)
    for column in features.T:
        for tag in range(3):
            slope[:, tag] += np.bincount(column, gap[:, tag], len(weights))
    seen = np.zeros((3, 3))
    np.add.at(seen, (tags[later - 1], tags[later]), 1.0)
    return float(value), slope, seen - pairs.sum(0)


def fit_field(features: np.ndarray, tags: np.ndarray, cuts: np.ndarray, *, penalty: float = 0.005, rounds: int = 60,
              hide: float = 0.7, seed: int = 0) -> SecretField:
    """Penalised likelihood by Adam steps over all chains.  In each round a
    ``hide`` share of the chains is read without neighbouring words, so that
    shapes alone must tell, too."""
    weights, steps = np.zeros((FEATURES, 3)), np.zeros((3, 3))
    steps[OUT, IN] = -4.0  # a span starts with its begin tag
    if not len(tags) or not (tags != OUT).any():
        weights[FIRST["length"]:FIRST["length"] + 16, OUT] = 20.0
        return SecretField(weights, steps)
    rng = np.random.default_rng(seed)
    names = [b[0] for b in BLOCKS]
    blank = features.copy()
    for name in NEAR:
        blank[:, names.index(name)] = FIRST[name]
    chain = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    first, second = [np.zeros((FEATURES, 3)), np.zeros((3, 3))], [np.zeros((FEATURES, 3)), np.zeros((3, 3))]
    n = len(cuts) - 1
    for t in range(1, rounds + 1):
        hidden = rng.random(n) < hide
        _, slope, step_slope = log_likelihood(weights, steps, np.where(hidden[chain][:, None], blank, features), tags, cuts)
        for i, (value, grad) in enumerate(((weights, slope), (steps, step_slope))):
            grad = -grad / n + penalty * value / np.sqrt(n)
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.99 * second[i] + 0.01 * grad * grad
            value -= 0.2 * (first[i] / (1 - 0.9 ** t)) / (np.sqrt(second[i] / (1 - 0.99 ** t)) + 1e-8)
    return SecretField(weights, steps)


# ------------------------------------------------------------ Spark
def _texts(column: pa.Array) -> list[str]:
    raw, offsets = text_bytes(column)
    whole = raw.tobytes()
    return [whole[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def _codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return codes, np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])


def _name(column: pa.Array) -> np.ndarray:
    """File name feature: a bucket of the value's hash (a long)."""
    return (mix64(column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) % np.uint64(256)).astype(np.int64)


def training_windows(docs: DataFrame, *, id_col: str, text_col: str, file_col: str | None, windows: int) -> DataFrame:
    """(text, size, name) of at most ``windows`` stretches of ``2 * SIDE`` code
    points: half around matches of the patterns, half anywhere in texts without
    one, each chosen by a hash of the row over all rows.  ``size`` and
    ``name`` are the file features of the whole text."""
    rows = docs.select(F.xxhash64(id_col, text_col).alias("h"), F.col(text_col).alias("text"),
                       F.xxhash64(*([file_col] if file_col else [F.lit(0)])).alias("name"))
    keep = min(1.0, 4.0 * windows / max(1, docs.count()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = mix64(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            out = []
            for i, text in enumerate(_texts(batch.column(1))):
                spans = base_spans(text)
                mark = int(marks[i])
                if spans:
                    start, _, end = spans[mark % len(spans)]
                    middle = (start + end) // 2
                elif text and mark / 2.0 ** 64 < keep:
                    middle = mark // 7 % len(text)
                else:
                    continue
                a = max(0, middle - SIDE)
                out.append((bool(spans), mark >> 1, text[a:middle + SIDE], len(text), batch.column(2)[i].as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out) if out else [[]] * 5, (pa.bool_(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                names=["found", "mark", "text", "size", "name"])

    found = materialize(rows.mapInArrow(cut, "found boolean, mark long, text string, size long, name long"), "windows")
    halves = [found.filter(F.col("found") == side).orderBy("mark", "text").limit(windows // 2) for side in (True, False)]
    return halves[0].unionByName(halves[1]).select("text", "size", "name")


def tagged(texts: Sequence[str], tokens: Tokens, cuts: np.ndarray) -> np.ndarray:
    """Tags of the tokens by the patterns: what a secret's range touches."""
    tags = np.zeros(len(tokens.start), np.int64)
    for i, text in enumerate(texts):
        for a, b in sorted(secret_ranges(text)):
            at = np.arange(np.searchsorted(tokens.end, cuts[i] + a, side="right"),
                           np.searchsorted(tokens.start, cuts[i] + b, side="left"))
            at = at[tags[at] == OUT]
            tags[at], tags[at[:1]] = IN, BEGIN
    return tags


def fit_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", file_col: str | None = None,
                windows: int = 800) -> SecretField:
    """Fit the field on at most ``windows`` stretches of text (a documented
    bound; every row may be chosen, and scanning reads them all), tagged by
    the patterns.  Without a match anywhere every token is outside."""
    rows = training_windows(docs, id_col=id_col, text_col=text_col, file_col=file_col, windows=windows).toArrow()
    texts = rows["text"].to_pylist()
    codes, cuts = _codes(texts)
    sizes = rows["size"].to_numpy().astype(np.int64)
    tokens = tokenize(codes, cuts, sizes, _name(rows["name"].combine_chunks()))
    at = np.searchsorted(tokens.text, np.arange(len(texts) + 1))
    return fit_field(tokens.features, tagged(texts, tokens, cuts), at)


def _pieces(text: str) -> list[tuple[int, str]]:
    """A text in pieces of at most ``PIECE`` code points, cut behind a blank
    where the piece has one."""
    out, start = [], 0
    while len(text) - start > PIECE:
        end = max(text.rfind(" ", start, start + PIECE), text.rfind("\n", start, start + PIECE)) + 1
        end = end if end > start else start + PIECE
        out.append((start, text[start:end]))
        start = end
    return out + [(start, text[start:])]


def added_spans(field: SecretField, texts: Sequence[str], base: Sequence[list[tuple[int, int, int]]], sizes: np.ndarray,
                names: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of the runs of tokens that the field tags as secret
    and that no pattern's match touches."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    work: list[tuple[int, int, str]] = []
    held = 0

    def decode() -> None:
        codes, cuts = _codes([w[2] for w in work])
        owner = np.array([w[0] for w in work])
        tokens = tokenize(codes, cuts, sizes[owner], names[owner])
        tags = viterbi(field, emissions(field, tokens.features), tokens.text)
        at = np.flatnonzero(tags != OUT)
        for i, p, start, end, tag in zip(at.tolist(), tokens.text[at].tolist(), tokens.start[at].tolist(),
                                         tokens.end[at].tolist(), tags[at].tolist()):
            row, shift, _ = work[p]
            a, b = start - int(cuts[p]) + shift, end - int(cuts[p]) + shift
            if any(s < b and a < e for s, _, e in base[row]):
                last[row] = -2
            elif tag == IN and last.get(row) == i - 1:
                out[row][-1] = (out[row][-1][0], 3, b)
                last[row] = i
            else:
                out[row].append((a, 3, b))
                last[row] = i

    last: dict[int, int] = {}
    for i, text in enumerate(texts):
        for shift, piece in _pieces(text):
            if work and held + len(piece) > PIECE:
                decode()
                work, held = [], 0
                last.clear()
            work.append((i, shift, piece))
            held += len(piece)
    if work:
        decode()
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))


def _span_column(rows: Sequence[list[tuple[int, int, int]]]) -> pa.Array:
    ends = np.append(0, np.cumsum([len(r) for r in rows]))
    flat = [s for r in rows for s in r]
    cells = [pa.array([KINDS[k] for _, k, _ in flat], pa.string()), pa.array([a for a, _, _ in flat], pa.int64()),
             pa.array([b for _, _, b in flat], pa.int64())]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(cells, ["kind", "start", "end"]))


def scan_secrets(docs: DataFrame, field: SecretField, *, id_col: str = "doc_id", text_col: str = "text",
                 file_col: str | None = None) -> DataFrame:
    """(``id_col``, base, spans) for every row: the patterns' matches, and
    these with the field's own finds (kind ``crf``), each as (kind, start,
    end) in code points, end exclusive, by start and then kind as listed.

    Null texts are empty and have no spans; null and repeated ids stay rows;
    further columns of ``docs`` are left alone.  ``file_col`` names a column
    (the source, say) whose value is a file feature.  Patterns read whole
    texts.  The field reads a text in pieces of at most 2 ** 20 code points
    cut behind a blank, so one very long text stays bounded; no span of its
    own crosses such a cut."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("base", SPANS),
                           T.StructField("spans", SPANS)])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(*([file_col] if file_col else [F.lit(0)])).alias("name"))
    known = docs.sparkSession.sparkContext.broadcast(field)  # FEATURES x 3 weights, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch.column(1))
            base = [base_spans(t) for t in texts]
            sizes = np.array([len(t) for t in texts], np.int64)
            more = added_spans(known.value, texts, base, sizes, _name(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _span_column(base), _span_column([sorted(b + m) for b, m in zip(base, more)])],
                names=schema.names)

    return rows.mapInArrow(run, schema)


def span_text(spans: Column | str) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, spans: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", mark: str = "*") -> DataFrame:
    """``docs`` with the code points of every span replaced by ``mark``; rows
    meet their spans by id, so ids must not repeat."""
    held = spans.select(F.col(id_col).alias("__id"), "spans")

    def cover(text, s):
        return F.concat(F.substr(text, F.lit(1), s["start"].cast("int")),
                        F.repeat(F.lit(mark), (s["end"] - s["start"]).cast("int")),
                        F.substr(text, (s["end"] + 1).cast("int")))

    joined = docs.join(held, docs[id_col].eqNullSafe(F.col("__id")), "left")
    hidden = F.aggregate(F.coalesce("spans", F.array().cast(SPANS)), F.col(text_col), cover)
    return joined.withColumn(text_col, hidden).drop("__id", "spans")
