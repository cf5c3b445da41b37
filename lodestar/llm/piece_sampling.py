"""Sampled SentencePiece segmentations: Gumbel top-k without replacement by a
perturbed best-first search over the piece lattice, and exact decoding."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix64, row_slices, text_bytes, unit

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE, LITERAL = 0x2581, 0x110000  # the piece alphabet's blank; a text's own U+2581
FALLBACK = 1 << 22  # ids from here stand for one code point in byte pieces
SLICE = 1 << 20  # bytes of text, and code points, that are in work at once
PARTS = 2.0 ** 36
UNIT = 256  # code points; longer runs without a blank are cut
MIX = np.uint64(0x9E3779B97F4A7C15)


class Lattice:
    """A vocabulary as an array trie: (state, code point) -> state by open
    addressing, the piece that ends in a state, and the pieces' log weights.

    The model's scores are merge ranks, not probabilities.  A piece of rank r
    weighs 1 / (1 + r); byte pieces and pieces without a rank weigh as the
    last one.  ``alpha`` sharpens (> 1) or flattens (< 1) the weights."""

    def __init__(self, model: str, alpha: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.vocab_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        rank = np.full(n, float(n))
        score = np.array([sp.get_score(i) for i in plain])
        rank[plain] = np.where(score < -n, n, -score)
        self.bytes = np.zeros(256, np.int64)
        for i in range(n):
            if sp.is_byte(i):
                self.bytes[int(pieces[i][3:5], 16)] = i
        self.size = n
        spelled = [bytes([int(pieces[i][3:5], 16)]) if sp.is_byte(i) else pieces[i].replace(chr(SPACE), " ").encode()
                   for i in range(n)]
        self.letters = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled = np.append(0, np.cumsum([len(x) for x in spelled]))
        self.log_weight = -alpha * np.log1p(rank)
        self.log_fallback = -alpha * np.log1p(n)
        self.longest = max(len(pieces[i]) for i in plain)
        states: dict[tuple[int, int], int] = {}
        ends = [-1]
        for i in plain:
            at = 0
            for ch in pieces[i]:
                at = states.setdefault((at, ord(ch)), len(ends))
                if at == len(ends):
                    ends.append(-1)
            ends[at] = i
        self.ends = np.array(ends, np.int32)
        bits = max(4, (4 * len(states)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.next = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        self.probes = 1
        for (state, ch), to in states.items():
            key = state << 22 | ch
            slot, tries = (key * int(MIX) % 2 ** 64) >> int(self.shift), 1
            while self.keys[slot] >= 0:
                slot, tries = (slot + 1) & self.mask, tries + 1
            self.keys[slot], self.next[slot] = key, to
            self.probes = max(self.probes, tries)

    def step(self, state: np.ndarray, ch: np.ndarray) -> np.ndarray:
        """Next states, -1 where there is none."""
        key = state << 22 | ch
        with np.errstate(over="ignore"):
            slot = ((key.view(np.uint64) * MIX) >> self.shift).astype(np.int64)
        out = np.full(len(key), -1, np.int64)
        live = np.arange(len(key))
        for _ in range(self.probes):
            there = self.keys[slot]
            hit = there == key[live]
            out[live[hit]] = self.next[slot[hit]]
            go = ~hit & (there >= 0)
            if not go.any():
                break
            live, slot = live[go], (slot[go] + 1) & self.mask
        return out

    def edges(self, chars: np.ndarray, at: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces that begin at places of ``chars``: the place's number, the
        piece's length - 1 and its id, by length and then by place; ``left``
        code points remain in the place's unit.  A character that is no piece
        of its own gets one edge of byte pieces."""
        place, state = np.arange(len(at)), np.zeros(len(at), np.int64)
        found = []
        for n in range(self.longest):
            if n:
                inside = left[place] > n
                place, state = place[inside], state[inside]
            state = self.step(state, chars[at[place] + n])
            go = state >= 0
            piece = np.where(go, self.ends[state], -1).astype(np.int64)
            if n == 0:
                bare = piece < 0
                piece[bare] = FALLBACK + chars[at[bare]]
            some = piece >= 0
            found.append((place[some], np.full(some.sum(), n, np.int8), piece[some]))
            place, state = place[go], state[go]
            if not len(place):
                break
        return tuple(np.concatenate(x) for x in zip(*found))

    def weights(self, ids: np.ndarray) -> np.ndarray:
        return np.append(self.log_weight, self.log_fallback)[np.minimum(ids, self.size)]


@lru_cache(maxsize=4)
def lattice(model: str, alpha: float) -> Lattice:
    return Lattice(model, alpha)


def _units(chars: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Begins of the units that pieces stay within: blanks and what follows
    up to the next blank, cut every ``UNIT`` code points; a line feed stands
    alone."""
    begin = np.zeros(len(chars), bool)
    begin[heads] = True
    blank, feed = chars == SPACE, chars == 10
    begin[1:] |= (blank[1:] & ~blank[:-1]) | feed[1:] | feed[:-1]
    at = np.flatnonzero(begin)
    sizes = np.diff(np.append(at, len(chars)))
    if len(at) and sizes.max() > UNIT:
        parts = -(-sizes // UNIT)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        at = np.repeat(at, parts) + nth * UNIT
    return at


def _distinct(chars: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One index for each distinct unit, and every unit's number among them."""
    sizes = np.diff(np.append(begins, len(chars)))
    with np.errstate(over="ignore"):
        power = np.ones(int(sizes.max()), np.uint64)
        power[1:] = MIX | np.uint64(1)
        power = np.multiply.accumulate(power)
        place = np.arange(len(chars)) - np.repeat(begins, sizes)
        mark = mix64(np.add.reduceat(mix64(chars.astype(np.uint64)) * power[place], begins) ^ sizes.astype(np.uint64))
    _, first, number = np.unique(mark, return_index=True, return_inverse=True)
    # equal marks must be equal units; should two collide, no unit is shared
    if (sizes != sizes[first][number]).any() or (
            chars != chars[np.repeat(begins[first][number], sizes) + place]).any():
        return np.arange(len(begins)), np.arange(len(begins))
    return first, number


class Sampler:
    """The lattice of a window of texts: for every place of every distinct
    unit the pieces that begin there, with their conditional probabilities.
    Places stand in the order of what is left of their unit, and a place's
    edges (``first`` to ``last``) in the order of their lengths."""

    def __init__(self, lat: Lattice, chars: np.ndarray, begins: np.ndarray):
        first, number = _distinct(chars, begins)
        sizes = np.diff(np.append(begins, len(chars)))
        size = sizes[first]
        base = np.concatenate([[0], np.cumsum(size)])
        own = np.repeat(begins[first] - base[:-1], size) + np.arange(base[-1])
        left = np.repeat(base[1:], size) - np.arange(base[-1])
        order = np.argsort(left.astype(np.int16), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        place, length, ids = lat.edges(chars, own[order], left[order])
        count = np.bincount(place, minlength=len(order))
        self.first = np.cumsum(count) - count
        self.last = self.first + count - 1
        slot = np.argsort(place, kind="stable")
        self.length, self.ids = length[slot], ids[slot]
        place = place[slot]
        after = order[place] + self.length + 1
        self.ends = self.length + 1 == left[order][place]
        to = np.where(self.ends, len(order), rank[np.minimum(after, len(order) - 1)])
        value = lat.weights(self.ids)
        # sums of weights to the unit's end, from the last place on
        total = np.zeros(len(order) + 1)
        cuts = np.searchsorted(left[order], np.arange(1, int(size.max()) + 2))
        edge = np.append(self.first, len(place))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            e0, e1, many = edge[a], edge[b], count[a:b]
            w = value[e0:e1] + total[to[e0:e1]]
            starts = self.first[a:b] - e0
            most = np.maximum.reduceat(w, starts)
            w = np.exp(w - np.repeat(most, many))
            share = np.add.reduceat(w, starts)
            total[a:b] = most + np.log(share)
            value[e0:e1] = w / np.repeat(share, many)
        self.p, self.sums = value, value.copy()
        nth = np.arange(len(place)) - self.first[place]
        for n in range(1, int(count.max())):
            e = np.flatnonzero(nth == n)
            self.sums[e] += self.sums[e - 1]
        self.most = int(count.max())
        self.where = rank[np.repeat(base[:-1][number] - begins, sizes) + np.arange(len(chars))]

    def choose(self, at: np.ndarray, draw: np.ndarray) -> np.ndarray:
        """The edge taken at each place."""
        state = self.where[at]
        edge, last = self.first[state], self.last[state]
        live = np.flatnonzero((draw >= self.sums[edge]) & (edge < last))
        while len(live):
            edge[live] += 1
            e = edge[live]
            live = live[(draw[live] >= self.sums[e]) & (e < last[live])]
        return edge

    def unused(self, at: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges of some places as rows, and their probabilities, 0 for those
        whose length is in the bit set ``used``."""
        state = self.where[at]
        edge = np.minimum(self.first[state][:, None] + np.arange(self.most), self.last[state][:, None])
        real = np.arange(self.most) <= (self.last - self.first)[state][:, None]
        out = real & (used[:, None] >> self.length[edge].astype(np.int64) & 1 == 0)
        return edge, np.where(out, self.p[edge], 0.0)

    def choose_unused(self, at: np.ndarray, draw: np.ndarray, used: np.ndarray) -> np.ndarray:
        edge, p = self.unused(at, used)
        sums = np.cumsum(p, 1)
        pick = np.minimum((sums <= (draw * sums[:, -1])[:, None]).sum(1), self.most - 1)
        row = np.arange(len(at))
        pick = np.where(p[row, pick] > 0, pick, p.argmax(1))
        return edge[row, pick]


class Paths:
    """Draws whole segmentations of the texts of a slice.  Lattices are built
    for windows of whole units, ``SLICE`` code points at most, so a long text
    costs no more memory for them than a short one; what stays for each code
    point is the piece taken and the log probability so far."""

    def __init__(self, lat: Lattice, chars: np.ndarray, offsets: np.ndarray, seeds: np.ndarray):
        self.lat, self.chars, self.offsets, self.seeds = lat, chars, offsets, seeds
        sizes = np.diff(offsets)
        self.text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.begins = _units(chars, offsets[:-1][sizes > 0])
        self.cuts = [0]
        while self.cuts[-1] < len(chars):
            ends = np.append(self.begins[1:], len(chars))
            last = np.searchsorted(ends, self.cuts[-1] + SLICE, side="right") - 1
            self.cuts.append(int(ends[max(last, np.searchsorted(ends, self.cuts[-1], side="right"))]))
        self._held: tuple[int, Sampler | None] = (-1, None)

    def lattices(self, w: int) -> Sampler:
        if self._held[0] != w:
            a, b = self.cuts[w], self.cuts[w + 1]
            self._held = (w, Sampler(self.lat, self.chars[a:b], self.begins[slice(*np.searchsorted(self.begins, (a, b)))] - a))
        return self._held[1]

    def draws(self, at: np.ndarray, sample: int, kind: int) -> np.ndarray:
        """Uniform numbers of places: they hash the text's seed and the place
        within the text, so neither slices nor windows matter."""
        text = self.text[at]
        key = mix64(self.seeds[text] ^ ((at - self.offsets[text]).astype(np.uint64) << np.uint64(20)))
        return unit(mix64(key ^ np.uint64(sample << 3 | kind)))

    def walk(self, sample: int, branch: np.ndarray | None = None, base: "Path | None" = None,
             used: np.ndarray | None = None) -> "Path":
        """A path through every text; with ``branch`` (a place per text, -1:
        none), a path that keeps ``base`` up to there, takes a piece out of
        the unused there, and goes on anew."""
        size = len(self.chars)
        taken, log_p, ids = np.full(size, -1, np.int8), np.zeros(size), np.full(size, -1, np.int32)
        branching = np.zeros(0, np.int64)
        if branch is not None:
            branching, bits = branch[branch >= 0], used[branch >= 0]
            spans = _ranges(self.offsets[:-1], np.maximum(branch, self.offsets[:-1]))
            taken[spans], log_p[spans], ids[spans] = base.taken[spans], base.log_p[spans], base.ids[spans]
        for w, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:])):
            at = self.begins[slice(*np.searchsorted(self.begins, (a, b)))]
            if branch is not None:
                owner = branch[self.text[at]]
                at = at[(owner >= 0) & (at > owner)]
            some = (branching >= a) & (branching < b)
            mine = branching[some]
            if not len(at) and not len(mine):
                continue
            lats = self.lattices(w)
            edges = np.full(b - a, -1, np.int64)
            if len(mine):
                e = lats.choose_unused(mine - a, self.draws(mine, sample, 1), bits[some])
                edges[mine - a] = e
                at = np.concatenate([(mine + lats.length[e] + 1)[~lats.ends[e]], at])
            while len(at):
                e = lats.choose(at - a, self.draws(at, sample, 0))
                edges[at - a] = e
                at = (at + lats.length[e] + 1)[~lats.ends[e]]
            here = np.flatnonzero(edges >= 0)
            e = edges[here]
            taken[here + a], log_p[here + a], ids[here + a] = lats.length[e], np.log(lats.p[e]), lats.ids[e]
        return Path(taken, log_p, ids)

    def rest(self, at: np.ndarray, used: np.ndarray, alive: np.ndarray) -> np.ndarray:
        """Probability of the unused pieces at one place of each text."""
        out = np.zeros(len(at))
        for w, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:])):
            mine = np.flatnonzero(alive & (at >= a) & (at < b))
            if len(mine):
                out[mine] = self.lattices(w).unused(at[mine] - a, used[mine])[1].sum(1)
        return out


class Path:
    """One segmentation of every text: by place the piece taken (its length
    less one, or -1), its log probability, its id."""

    def __init__(self, taken: np.ndarray, log_p: np.ndarray, ids: np.ndarray):
        self.taken, self.log_p, self.ids = taken, log_p, ids
        # sums of -log_p in whole parts of 1 / PARTS, so that the texts before in a slice change nothing
        self.through = np.concatenate([[0], np.cumsum(np.rint(log_p * -PARTS).astype(np.int64))])

    def minus_log(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """-log probability of what the path takes between places."""
        return (self.through[high] - self.through[low]) / PARTS


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All integers of the ranges, one after the other."""
    sizes = np.maximum(ends - starts, 0)
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def sample_texts(lat: Lattice, chars: np.ndarray, offsets: np.ndarray, seeds: np.ndarray, k: int
                 ) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``k`` distinct segmentations of each text in the order of their
    perturbed scores: per sample (ids by place or -1, log probability,
    perturbed score, log inclusion probability); a text with fewer
    segmentations has score -inf in the rest.

    Best-first search over perturbed maxima: a node is a set of segmentations
    not drawn yet, and its score the maximum of their perturbed scores.  The
    first sample is an ordinary draw with score Gumbel(0).  All segmentations
    that leave its path within a range of places are one node: their mass is
    the difference of two prefix probabilities, their maximum a Gumbel of that
    mass truncated at the path's own score.  The frontier's best node is the
    next sample, and only then is it split: the place where it leaves the path
    comes by the inverse of the cumulative mass, its piece is drawn among the
    unused, its rest anew; what remains are the ranges on both sides, the
    other pieces at the place, and what leaves the new path later.  All texts
    of the slice take their step together."""
    n = len(offsets) - 1
    start, end = offsets[:-1], offsets[1:]
    score = -np.log(-np.log(unit(mix64(seeds ^ np.uint64(1)))))
    if not len(chars):  # nothing but empty texts: one empty segmentation each
        gone = np.full(n, -np.inf)
        return [(np.full(0, -1, np.int32), np.zeros(n), gone if j else score, np.zeros(n)) for j in range(k)]
    paths = Paths(lat, chars, offsets, seeds)
    drawn: list[Path] = []
    totals, scores = [], []
    # nodes by text: (path, first place, end of places, used pieces or 0 for a range, log mass, score)
    nodes: list[tuple[np.ndarray, ...]] = []

    def add(path: np.ndarray, low: np.ndarray, high: np.ndarray, used: np.ndarray, mass: np.ndarray, top: np.ndarray,
            alive: np.ndarray, step: int) -> None:
        """A node per text, its score a Gumbel of its mass truncated at ``top``."""
        draw = unit(mix64(mix64(seeds ^ np.uint64(2)) ^ np.uint64(step << 8 | len(nodes))))
        with np.errstate(all="ignore"):
            value = mass - np.log(np.exp(np.minimum(mass - top, 700.0)) - np.log(draw))
        nodes.append((path, low, high, used, mass, np.where(alive & (mass > -np.inf), np.minimum(value, top), -np.inf)))

    def leaving(path: Path, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Log mass of what leaves ``path`` between two places of each text."""
        with np.errstate(divide="ignore"):
            share = np.log(-np.expm1(-path.minus_log(low, np.maximum(high, low))))
        return share - path.minus_log(start, low)

    none = np.zeros(n, np.int64)
    for j in range(k + 1):
        if j == 0:
            drawn.append(paths.walk(0))
            add(none, start, end, none, leaving(drawn[0], start, end), score, np.diff(offsets) > 0, 0)
        else:
            every = np.stack([x[5] for x in nodes])
            best, score = every.argmax(0), every.max(0)
            if j == k:
                break
            path, low, high, used, mass, _ = (np.stack([x[f] for x in nodes])[best, np.arange(n)] for f in range(6))
            alive = np.isfinite(score)
            branch, bits = np.full(n, -1, np.int64), used.copy()
            base = _mixed(drawn, path, offsets)
            ranged = np.flatnonzero(alive & (used == 0))
            if len(ranged):
                a, b = low[ranged], high[ranged]
                u = unit(mix64(mix64(seeds[ranged] ^ np.uint64(3)) ^ np.uint64(j)))
                goal = base.through[a] + np.rint(-np.log1p(u * np.expm1(-base.minus_log(a, b))) * PARTS).astype(np.int64)
                goal = np.minimum(np.maximum(goal, base.through[a] + 1), base.through[b])
                at = np.searchsorted(base.through, goal, side="left") - 1
                branch[ranged], bits[ranged] = at, 1 << base.taken[at].astype(np.int64)
            pointed = np.flatnonzero(alive & (used != 0))
            branch[pointed] = low[pointed]
            drawn.append(paths.walk(j, branch, base, bits))
            new = drawn[j]
            for place, node in enumerate(nodes):  # the node drawn from is split
                node[5][best == place] = -np.inf
            there = np.where(alive, branch, start)
            more = bits | 1 << np.maximum(new.taken[np.minimum(there, len(chars) - 1)], 0).astype(np.int64)
            left = paths.rest(there, more, alive)
            with np.errstate(divide="ignore"):
                point = np.where(left > 1e-12, np.log(left) - base.minus_log(start, there), -np.inf)
            is_range = alive & (used == 0)
            add(path, low, there, none, leaving(base, low, np.where(is_range, there, low)), score, is_range, j)
            add(path, there + 1, high, none, leaving(base, np.minimum(there + 1, high), high), score, is_range, j)
            add(path, there, there + 1, more, point, score, alive, j)
            add(np.full(n, j), there + 1, end, none, leaving(new, np.minimum(there + 1, end), end), score, alive, j)
        totals.append(-drawn[j].minus_log(start, end))
        scores.append(score)
    out = []
    for path, total, value in zip(drawn, totals, scores):
        gap = np.where(np.isfinite(score), total - score, np.inf)
        with np.errstate(over="ignore", divide="ignore"):
            inclusion = np.where(gap < -30, gap, np.log(-np.expm1(-np.exp(np.minimum(gap, 700.0)))))
        out.append((path.ids, total, value, inclusion))
    return out


def _mixed(drawn: list[Path], which: np.ndarray, offsets: np.ndarray) -> Path:
    """For each text the one of the paths drawn that ``which`` names."""
    if len(drawn) == 1 or not which.any():
        return drawn[0]
    of = np.repeat(which, np.diff(offsets))
    return Path(*(np.choose(of, [getattr(p, f) for p in drawn]) for f in ("taken", "log_p", "ids")))


def _spell(lat: Lattice, ids: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of single code points written as byte pieces."""
    wide = ids >= FALLBACK
    code = np.where(wide, ids - FALLBACK, 0)
    code = np.where(code == LITERAL, SPACE, code)
    length = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
    reps = np.where(wide, length, 1)
    out, rows, code, wide, length = (np.repeat(x, reps) for x in (ids, row, code, wide, length))
    nth = np.arange(len(out)) - np.repeat(np.cumsum(reps) - reps, reps)
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[length]
    tail = code >> 6 * (length - 1 - nth)
    byte = np.where(nth == 0, lead | tail, 0x80 | (tail & 0x3F))
    return np.where(wide, lat.bytes[np.minimum(byte, 255)], out), rows


def sample_segmentations(docs: DataFrame, *, key_col: str = "doc_id", text_col: str = "text", model: str = MODEL,
                         samples: int = 2, alpha: float = 1.0, seed: int = 0, prefix_blank: bool = True) -> DataFrame:
    """(key, ``sample`` from 0, ``pieces`` array of ids, ``log_prob``,
    ``score``, ``log_inclusion``, ``exact``): up to ``samples`` distinct segmentations of
    every whole text, drawn without replacement.

    ``log_prob`` is the segmentation's log probability in the lattice,
    ``score`` the perturbed one that orders samples, ``log_inclusion`` the
    log of the probability that its score passes the first score left out
    (0 if nothing is left out), ``exact`` whether the pieces were decoded to
    the very text again.  Draws hash the row's key with ``seed``, so
    they do not depend on partitions; rows that repeat a key and a text get
    the same samples.  Null and empty texts have one empty segmentation of
    probability 1.  A text has fewer samples only if it has fewer
    segmentations.  No piece crosses a blank, a line feed or the end of 256
    code points without one.  ``model`` is a path that every executor can open."""
    key_type = docs.schema[key_col].dataType
    schema = T.StructType([
        T.StructField(key_col, key_type), T.StructField("sample", T.IntegerType()),
        T.StructField("pieces", T.ArrayType(T.IntegerType())), T.StructField("log_prob", T.DoubleType()),
        T.StructField("score", T.DoubleType()), T.StructField("log_inclusion", T.DoubleType()),
        T.StructField("exact", T.BooleanType())])
    source = docs.select(F.col(key_col).alias("key"), F.xxhash64(F.col(key_col), F.lit(seed)).alias("seed"),
                         F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = lattice(model, alpha)
        for batch in batches:
            raw, offsets = text_bytes(batch.column(2))
            seeds = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for a, b in row_slices(offsets, SLICE):
                chars, cuts = _codes(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], prefix_blank)
                for j, (ids, log_p, value, inclusion) in enumerate(sample_texts(lat, chars, cuts, mix64(seeds[a:b]), samples)):
                    there = np.isfinite(value) & ((np.diff(cuts) > 0) | (j == 0))
                    at = np.flatnonzero(ids >= 0)
                    row = np.searchsorted(cuts, at, side="right") - 1
                    pieces, row = _spell(lat, ids[at], row)
                    pieces, row = pieces[there[row]], row[there[row]]
                    sizes = np.bincount(row, minlength=b - a)[there]
                    some = np.flatnonzero(there)
                    ends = np.append(0, np.cumsum(sizes))
                    exact = _same_text(lat, pieces, ends, raw, offsets, a + some, prefix_blank)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(a + some)), pa.array(np.full(len(some), j, np.int32)),
                         pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                  pa.array(pieces, pa.int32())),
                         pa.array(log_p[some]), pa.array(value[some]), pa.array(inclusion[some]), pa.array(exact)],
                        names=schema.names)

    return source.mapInArrow(run, schema)


def _same_text(lat: Lattice, pieces: np.ndarray, cuts: np.ndarray, raw: np.ndarray, offsets: np.ndarray,
               rows: np.ndarray, prefix_blank: bool) -> np.ndarray:
    """Whether each row of pieces decodes to the bytes of its text."""
    out, ends = decode_many(lat, pieces, cuts, prefix_blank)
    sizes = np.diff(offsets)[rows]
    same = np.diff(ends) == sizes
    if same.all():
        place = np.arange(len(out)) + np.repeat(offsets[rows] - ends[:-1], sizes)
        wrong = np.flatnonzero(out != raw[place])
        same[np.searchsorted(ends, wrong, side="right") - 1] = False
        return same
    return np.array([out[ends[i]:ends[i + 1]].tobytes() == raw[offsets[r]:offsets[r + 1]].tobytes()
                     for i, r in enumerate(rows)], bool)


def _codes(raw: np.ndarray, offsets: np.ndarray, prefix_blank: bool) -> tuple[np.ndarray, np.ndarray]:
    """Code points in the piece alphabet, a blank before every non-empty
    text, and each text's range."""
    codes = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offsets]
    codes = np.where(codes == SPACE, LITERAL, np.where(codes == 32, SPACE, codes))
    if prefix_blank:
        some = np.diff(starts) > 0
        codes = np.insert(codes, starts[:-1][some], SPACE)
        starts = starts + np.append(0, np.cumsum(some))
    return codes, starts


def decode_many(lat: Lattice, ids: np.ndarray, cuts: np.ndarray, prefix_blank: bool) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and ranges of rows of piece ids: byte pieces are bytes, the
    piece alphabet's blank is a space, the blank in front of a row goes."""
    sizes = lat.spelled[ids + 1] - lat.spelled[ids]
    ends = np.append(0, np.cumsum(sizes))
    out = lat.letters[np.arange(ends[-1]) + np.repeat(lat.spelled[ids] - ends[:-1], sizes)]
    rows = ends[cuts]
    if prefix_blank and len(out):
        first = rows[:-1][np.diff(rows) > 0]
        first = first[out[first] == 32]
        keep = np.ones(len(out), bool)
        keep[first] = False
        out, rows = out[keep], rows - np.searchsorted(first, rows, side="left")
    return out, rows


def decode_pieces(ids: list[int], model: str = MODEL, prefix_blank: bool = True) -> str:
    """The text of one list of piece ids."""
    out, _ = decode_many(lattice(model, 1.0), np.array(ids, np.int64), np.array([0, len(ids)]), prefix_blank)
    return out.tobytes().decode("utf-8", "replace")


def decode_column(pieces: DataFrame, pieces_col: str = "pieces", model: str = MODEL, prefix_blank: bool = True
                  ) -> DataFrame:
    """Adds ``decoded`` to rows with a column of piece ids; null stays null,
    bytes that are no UTF-8 become replacement characters, and an input
    column ``decoded`` is replaced."""
    base = pieces.select(*[c for c in pieces.columns if c != "decoded"])
    schema = T.StructType([*base.schema.fields, T.StructField("decoded", T.StringType())])
    at = base.columns.index(pieces_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = lattice(model, 1.0)
        for batch in batches:
            column = batch.column(at)
            sizes = np.array([len(x) if x.is_valid else 0 for x in column], np.int64)
            out, rows = decode_many(lat, column.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                                    np.append(0, np.cumsum(sizes)), prefix_blank)
            texts = [out[a:b].tobytes().decode("utf-8", "replace") if x.is_valid else None
                     for a, b, x in zip(rows[:-1], rows[1:], column)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return base.mapInArrow(run, schema)
