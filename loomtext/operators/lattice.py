"""Segmentation of text without spaces: a lattice of known pieces, cheapest path, costs learned from the text itself.

All pieces of a lexicon that begin at a place are edges of the lattice; a double-array trie finds those of all places of
a batch at once. A path's cost is the sum of its pieces' costs (negative logarithms of their shares). Costs are learned by
expectation maximisation: Spark counts the candidates, tasks add up in how many segmentations each piece is expected, given
the costs so far, and Spark sums that up. A lexicon has at most as many pieces as it was asked for, so it travels with the
tasks; texts stay where they are. Costs count by millionths: sums of a path are whole numbers, and of equally cheap paths the one
whose last piece is shortest is taken, wherever it stands in a run.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.batches import slices
from ..sources.scratch import removed, union, written

#: Scripts that are written without spaces, or with some inside of which words are to be found.
SCRIPTS = r"々-〇ぁ-ゖ゙-ゟァ-ヺー-ヿ㐀-䶿一-鿿가-힣豈-﫿"
RUN = f"[{SCRIPTS}]+"
#: Scripts whose runs are one word where nothing better is known: (first, last) code points.
WHOLE = ((0x3041, 0x309F), (0x30A1, 0x30FF), (0xAC00, 0xD7A3))
WORDLIKE = re.compile("[" + "".join(f"{chr(a)}-{chr(z)}" for a, z in WHOLE) + "]{2}")
OTHER = re.compile(rf"([{SCRIPTS}]+)|[^\W{SCRIPTS}]+(?:[.'-][^\W{SCRIPTS}]+)*|[^\w\s]")
#: Characters of a batch that are worked on at once.
AT_ONCE = 400_000
#: Characters whose substrings are counted at once, and those whose runs are cut from one buffer.
COUNTED = 2_000_000
CUT = 8_000_000
#: Runs longer than this are taken apart where no piece crosses; of what is longer still so many places are worked on at once, as a
#: step along few runs costs as much as one along many.
LONG, LONG_AT_ONCE = 192, 1_000_000
#: Entries up to which a trie is one table of states and labels.
TABLE = 1 << 22
#: Substrings up to this length are all counted; of longer ones those whose parts are frequent enough.
SHORT = 4
#: Places after which sums of products are scaled.
SCALED = 16
#: Bits of a character in a packed substring, and how many a long has.
BITS, PACKED = 21, 3


class DoubleArray:
    """A trie of strings of numbers from 1 on, as two arrays: the child of state s by c is base[s] + c if check has s there."""

    def __init__(self, keys: list[tuple[int, ...]]) -> None:
        """keys: distinct and in order; a key's value is its place."""
        size = 1024 + 2 * sum(map(len, keys))
        self.base, self.check, self.value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        used, first_free = bytearray(size), 1
        used[0] = 1
        work = [(0, 0, len(keys), 0)]
        while work:
            state, low, high, depth = work.pop()
            if low < high and len(keys[low]) == depth:
                self.value[state] = low
                low += 1
            if low == high:
                continue
            starts = [low, *(i for i in range(low + 1, high) if keys[i][depth] != keys[i - 1][depth]), high]
            labels = [keys[i][depth] for i in starts[:-1]]
            while first_free < len(used) and used[first_free]:
                first_free += 1
            base, tries = max(0, first_free - labels[0]), 0
            while True:
                if base + labels[-1] >= len(used):
                    more = base + labels[-1] + 1024
                    self.base, self.check, self.value = (np.concatenate([a, np.full(more, v, np.int32)]) for a, v in ((self.base, 0), (self.check, -1), (self.value, -1)))
                    used += bytes(more)
                if not any(used[base + c] for c in labels):
                    break
                base, tries = base + 1, tries + 1
                if tries % 64 == 0:  # a crowded stretch: go on behind it
                    first_free += 16
            self.base[state] = base
            for c, a, z in zip(labels, starts, starts[1:], strict=False):
                used[base + c] = 1
                self.check[base + c] = state
                work.append((base + c, a, z, depth + 1))

    def walk(self, labels: np.ndarray, ends: np.ndarray, longest: int) -> np.ndarray:
        """[length - 1, place]: the value of the key of that length that begins there, or -1. ends: where the stretch of
        each place ends."""
        n = len(labels)
        found, state, at = np.full((longest, n), -1, np.int32), np.zeros(n, np.int64), np.arange(n)
        alive = at
        for d in range(longest):
            alive = alive[alive + d < ends[alive]]
            there = self.base[state[alive]] + labels[alive + d]
            ok = (labels[alive + d] > 0) & (there < len(self.check))
            ok[ok] = self.check[there[ok]] == state[alive][ok]
            alive, there = alive[ok], there[ok]
            state[alive] = there
            found[d, alive] = self.value[there]
        return found


@dataclass
class Lattice:
    """Runs of one batch: nodes between characters, `pad` dead ones before each run; edges by length and first character."""

    starts: np.ndarray  # of each run among the characters
    sizes: np.ndarray
    piece: np.ndarray  # [length - 1, place], -1 if unknown
    weight: np.ndarray  # its logarithm of share, -inf where there is no edge
    onward: np.ndarray  # length of the run of one script that begins at each character and is an edge, 0 if there is none
    back: np.ndarray  # the same of the run that ends with each character
    node: np.ndarray  # of each character, the one before it
    first: np.ndarray  # of each run
    unknown: float

    def run_weight(self, size: np.ndarray) -> np.ndarray:
        return self.unknown * (1 + 0.5 * (size - 1))

    def forward(self, best: bool) -> tuple[np.ndarray, np.ndarray]:
        """Of each node the weight of the best path to it, or of all; and with which length the best one ends."""
        longest = len(self.weight)
        total = np.full(int(self.first[-1] + self.sizes[-1] + 1) if len(self.sizes) else 0, -np.inf)
        last = np.zeros(len(total), np.int32)
        order = np.argsort(-self.sizes, kind="stable")
        long_first, most = self.sizes[order], int(self.sizes.max(initial=0))
        total[self.first] = 0.0
        lengths = np.arange(1, longest + 1)[:, None]
        flat, n = self.weight.ravel(), self.weight.shape[1]
        for t in range(1, most + 1):
            runs = order[: np.searchsorted(-long_first, -t, "right")]
            here, char = self.first[runs] + t, self.starts[runs] + t
            way = total[np.maximum(here - lengths, 0)] + flat[(lengths - 1) * n + np.maximum(char - lengths, 0)]
            whole = self.back[char - 1]
            way = np.concatenate([way, np.where(whole > 0, total[here - whole] + self.run_weight(whole), -np.inf)[None]])
            top = way.max(axis=0)
            if best:
                pick = way.argmax(axis=0)
                last[here] = np.where(pick == longest, whole, pick + 1)
                total[here] = top
            else:
                total[here] = top + np.log(np.exp(way - top).sum(axis=0))
        return total, last


@dataclass
class Grid:
    """A lattice without runs of one script, laid out by place and run, so that a step is a few products of whole rows."""

    weight: np.ndarray  # [length - 1, place, run]
    piece: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, x: Lattice) -> Grid:
        places = np.arange(int(x.sizes.max(initial=0)))[:, None]
        inside = places < x.sizes
        at = np.where(inside, x.starts + places, 0)
        return cls(np.where(inside, x.weight[:, at], -np.inf), np.where(inside, x.piece[:, at], -1), x.sizes)

    def best(self) -> np.ndarray:
        """[place, run]: with which length the best path to each place ends."""
        longest, most, n = self.weight.shape
        total, last = np.full((most + 1, n), -np.inf), np.zeros((most + 1, n), np.int32)
        total[0] = 0.0
        for t in range(1, most + 1):
            way = np.stack([total[t - k] + self.weight[k - 1, t - k] for k in range(1, min(longest, t) + 1)])
            last[t] = way.argmax(axis=0) + 1
            total[t] = way.max(axis=0)
        return last

    def marginals(self, weights: np.ndarray, n_pieces: int) -> tuple[np.ndarray, float]:
        """As marginals(), by products; rows are scaled before they run out of a double's range."""
        longest, most, n = self.weight.shape
        share, run = np.exp(self.weight), np.arange(n)
        ahead, behind = np.zeros((most + 1, n)), np.zeros((most + 1, n))
        ahead_log, behind_log = np.zeros((most + 1, n)), np.zeros((most + 1, n))
        ahead[0], behind[self.sizes, run] = 1.0, 1.0

        def scale(rows: slice, table: np.ndarray, logs: np.ndarray, now: np.ndarray) -> np.ndarray:
            top = table[rows].max(axis=0)
            top[top == 0] = 1.0
            table[rows] /= top
            now = now + np.log(top)
            logs[rows] = now
            return now

        now = np.zeros(n)
        for t in range(1, most + 1):
            for k in range(1, min(longest, t) + 1):
                ahead[t] += ahead[t - k] * share[k - 1, t - k]
            ahead_log[t] = now
            if t % 8 == 0:
                now = scale(slice(max(0, t - longest + 1), t + 1), ahead, ahead_log, now)
        now = np.zeros(n)
        for t in range(most - 1, -1, -1):
            for k in range(1, min(longest, most - t) + 1):
                behind[t] += share[k - 1, t] * behind[t + k]
            behind_log[t] = now
            if t % 8 == 0:
                now = scale(slice(t, t + longest), behind, behind_log, now)
        whole = np.log(ahead[self.sizes, run]) + ahead_log[self.sizes, run]
        counts = np.zeros(n_pieces)
        for k in range(1, min(longest, most) + 1):
            at, of = np.nonzero(self.piece[k - 1] >= 0)
            p = ahead[at, of] * share[k - 1, at, of] * behind[at + k, of] * np.exp(ahead_log[at, of] + behind_log[at + k, of] - whole[of])
            counts += np.bincount(self.piece[k - 1, at, of], p * weights[of], n_pieces)
        return counts, float((whole * weights).sum())


def marginals(lattice: Lattice, weights: np.ndarray, n_pieces: int) -> tuple[np.ndarray, float]:
    """In how many segmentations, each counted by its probability and its run's weight, each piece stands; and the
    sum of the runs' log likelihoods."""
    if not lattice.onward.any():
        return Grid.of(lattice).marginals(weights, n_pieces)
    total, _ = lattice.forward(best=False)
    longest, (n_nodes, n) = len(lattice.weight), (len(total), lattice.weight.shape[1])
    rest = np.full(n_nodes + longest + 1, -np.inf)
    ends = lattice.first + lattice.sizes
    rest[ends] = 0.0
    order = np.argsort(-lattice.sizes, kind="stable")
    long_first, most = lattice.sizes[order], int(lattice.sizes.max(initial=0))
    lengths = np.arange(1, longest + 1)[:, None]
    for t in range(1, most + 1):  # from each run's end
        runs = order[: np.searchsorted(-long_first, -t, "right")]
        here, char = ends[runs] - t, lattice.starts[runs] + lattice.sizes[runs] - t
        script = lattice.onward[char]
        run = np.where(script > 0, rest[here + script] + lattice.run_weight(script), -np.inf)
        way = np.concatenate([rest[here + lengths] + lattice.weight[:, char], run[None]])
        top = way.max(axis=0)
        rest[here] = top + np.log(np.exp(way - top).sum(axis=0))
    whole = total[ends]
    run_of = np.repeat(np.arange(len(lattice.sizes)), lattice.sizes)
    counts = np.zeros(n_pieces)
    for d in range(longest):
        at = np.flatnonzero(lattice.piece[d] >= 0)
        p = np.exp(total[lattice.node[at]] + lattice.weight[d, at] + rest[lattice.node[at] + d + 1] - whole[run_of[at]])
        counts += np.bincount(lattice.piece[d, at], p * weights[run_of[at]], n_pieces)
    return counts, float((whole * weights).sum())


class Table:
    """The trie of a lexicon as one table: child by state and label. Labels are 0 for a strange character, then those of the
    alphabet, and the last one behind a run. State 0 is the root, 1 is no piece, 2 is a strange character."""

    def __init__(self, pieces: list[str], costs: list[float], alphabet: np.ndarray, strange: float) -> None:
        self.alphabet, self.longest, self.width = alphabet, max(map(len, pieces), default=1), len(alphabet) + 2
        top = int(alphabet[-1]) if len(alphabet) else 0
        self.label = np.zeros(top + 2, np.intp)
        self.label[alphabet] = np.arange(1, len(alphabet) + 1)
        number, state_of, child = {chr(c): i for i, c in enumerate(alphabet.tolist(), 1)}, [], {}
        for piece in pieces:
            state = 0
            for c in piece:
                state = child.setdefault((state, number[c]), len(child) + 3)
            state_of.append(state)
        self.n = len(child) + 3
        self.child = np.ones(self.n * self.width, np.intp)
        self.child[0] = 2
        self.child[[a * self.width + c for a, c in child]] = list(child.values())
        self.state_of = np.array(state_of, np.intp)
        # millionths are whole numbers, so that sums and ties don't depend on the order of additions
        whole = np.rint(np.array(costs) * 1e6)
        self.weight = np.full(self.n, -np.inf)
        self.weight[[2, *(v for (a, _), v in child.items() if a == 0)]] = -(whole.max(initial=0.0) + round(strange * 1e6))
        self.weight[self.state_of] = -whole
        self.many = np.zeros(self.n, bool)
        self.many[self.state_of] = True
        share = np.exp(-np.array(costs))
        each = np.array([len(p) for p in pieces])
        self.tilt = float((share * costs).sum() / (share * each).sum()) if pieces else 0.0  # a character's usual cost

    def labels(self, codes: np.ndarray) -> np.ndarray:
        """Labels of all characters, and of one place behind them."""
        out = np.full(len(codes) + 1, self.width - 1, np.intp)
        self.label.take(codes, out=out[:-1], mode="clip")  # the last one is no character of the alphabet
        return out

    def parts(self, label: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Beginnings, sizes and run of the parts, long runs taken apart where no piece crosses."""
        run, long = np.arange(len(sizes)), np.flatnonzero(sizes > LONG)
        starts = np.cumsum(sizes) - sizes
        if not len(long):
            return starts, sizes, run
        begins, lengths, of = [np.delete(starts, long)], [np.delete(sizes, long)], [np.delete(run, long)]
        for r in long.tolist():
            here = np.append(label[starts[r] : starts[r] + sizes[r]], np.full(self.longest, self.width - 1))
            n, state = int(sizes[r]), np.zeros(int(sizes[r]), np.intp)
            reach = np.arange(1, n + 1)
            for k in range(1, self.longest + 1):
                state = self.child.take(state * self.width + here[k - 1 : k - 1 + n])
                if k > 1:
                    reach = np.where(self.many.take(state), np.arange(k, n + k), reach)
            cut = np.flatnonzero(np.maximum.accumulate(reach) == np.arange(1, n + 1)) + 1  # ends of parts
            begin = np.append(0, cut[:-1])
            begins.append(starts[r] + begin)
            lengths.append(cut - begin)
            of.append(np.full(len(cut), r))
        return np.concatenate(begins), np.concatenate(lengths), np.concatenate(of)

    def grids(self, label: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(parts, their sizes, state by [length - 1, place, part]) of parts of like length."""
        order = np.argsort(sizes, kind="stable")
        ordered, low = sizes[order], 0
        while low < len(order):
            near, far = np.searchsorted(ordered, [int(ordered[low] * 1.2) + 3, 3 * ordered[low]], "right").tolist()
            high = max(near, min(low + 128, far))  # a few long ones cost more by their steps than by their empty places
            most = int(ordered[high - 1])
            high = min(high, low + max(1, (LONG_AT_ONCE if most > LONG else AT_ONCE) // most))
            some, size = order[low:high], ordered[low:high]
            most, low = int(size[-1]), high
            place = np.arange(most + self.longest)[:, None]
            here = label.take(np.where(place < size, starts[some] + place, len(label) - 1))
            state = np.empty((self.longest, most, len(some)), np.intp)
            before = self.child.take(here[:most], out=state[0], mode="clip")
            step = np.empty((most, len(some)), np.intp)
            for k in range(1, self.longest):
                np.multiply(before, self.width, out=step)
                step += here[k : k + most]
                before = self.child.take(step, out=state[k], mode="clip")
            yield some, size, state

    def expected(self, codes: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
        """By state, in how many segmentations it is expected; and (beginning, size, weight) of parts that are left out, as
        their sums left a double's range. codes: of all runs, one behind the other."""
        label = self.labels(codes)
        begins, lengths, of = self.parts(label, sizes)
        counts, left = np.zeros(self.n), []
        share = [np.exp(self.weight / 1e6 + self.tilt * k) for k in range(1, self.longest + 1)]
        for some, size, state in self.grids(label, begins, lengths):
            with np.errstate(all="ignore"):
                p = self.posterior(share, state, size, weights[of[some]])
                sure = np.abs(p[:, 0].sum(axis=0) / weights[of[some]] - 1.0) < 1e-9  # what was found backward is what was found forward
            if not sure.all():
                p[:, :, ~sure] = 0.0
                left += [(int(begins[i]), int(lengths[i]), float(weights[of[i]])) for i in some[~sure]]
            counts += np.bincount(state.ravel(), p.ravel(), self.n)
        return counts, left

    def posterior(self, share: list[np.ndarray], state: np.ndarray, size: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """[length - 1, place, part]: how often an edge is used. Sums are scaled by blocks of places."""
        longest, most, n = state.shape
        p, part, step = np.empty(state.shape), np.arange(n), np.empty((longest, n))
        for k in range(longest):
            share[k].take(state[k], out=p[k], mode="clip")
        ahead, behind = np.zeros((most + longest, n)), np.zeros((most + longest, n))
        ahead[0], behind[size, part] = 1.0, 1.0
        logs = np.zeros((-(-most // SCALED), n))

        def scale(rows: np.ndarray) -> np.ndarray:
            top = rows.max(axis=0)
            top[top == 0] = 1.0
            rows /= top
            return np.log(top)

        for t in range(most):
            if t and t % SCALED == 0:
                logs[t // SCALED] = logs[t // SCALED - 1] + scale(ahead[t : t + longest])
            np.multiply(p[:, t], ahead[t], out=step)
            ahead[t + 1 : t + 1 + longest] += step
        whole = np.log(ahead[size, part]) + logs[np.minimum(size, most - 1) // SCALED, part]
        now, factor = np.zeros(n), None
        for t in range(most - 1, -1, -1):
            if factor is None or (t + 1) % SCALED == 0:
                now += scale(behind[t + 1 : t + 1 + longest])
                factor = np.exp(logs[t // SCALED] + now - whole) * weights
            np.multiply(p[:, t], behind[t + 1 : t + 1 + longest], out=step)
            behind[t] += step.sum(axis=0)
            np.multiply(step, ahead[t] * factor, out=p[:, t])
        return p

    def marks(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of each character of all runs, whether a piece of the cheapest path begins with it; of equal ones the last piece is the
        shortest."""
        label = self.labels(codes)
        begins, lengths, _ = self.parts(label, sizes)
        out = np.zeros(len(codes), bool)
        for some, size, state in self.grids(label, begins, lengths):
            (longest, most, n), unit = state.shape, 2.0 ** self.longest.bit_length()
            # the lowest bits of a sum say with which length it ends, a shorter one having the greater number
            weight = np.stack([(self.weight * unit + (longest - k)).take(state[k - 1]) for k in range(1, longest + 1)])
            total, last = np.full((most + longest, n), -np.inf), np.zeros((most + 1, n), np.intp)
            step, bare = np.empty((longest, n)), np.zeros(n)
            with np.errstate(invalid="ignore"):
                for t in range(most):
                    there = total[t + 1 : t + 1 + longest]
                    np.maximum(there, np.add(weight[:, t], bare, out=step), out=there)
                    bare = np.floor(there[0] / unit) * unit
                    last[t + 1] = longest - (there[0] - bare)
            at, part, begin = size.copy(), np.arange(n), begins[some]
            while len(at):
                at = at - last[at, part]
                out[begin + at] = True
                more = at > 0
                at, part, begin = at[more], part[more], begin[more]
        return out


@dataclass
class Lexicon:
    """Pieces and their costs. Without pieces only the scripts cut: runs of kana and of Hangul are words, Han characters
    are single. A character that no piece has costs what the rarest piece does and `strange` more; a whole run
    of one script half of that for each further character."""

    pieces: list[str] = field(default_factory=list)
    costs: list[float] = field(default_factory=list)
    strange: float = 2.0

    def __post_init__(self) -> None:
        pairs = sorted(zip(self.pieces, self.costs, strict=True))
        self.pieces, self.costs = [p for p, _ in pairs], [c for _, c in pairs]
        self.alphabet = np.array(sorted({ord(c) for p in self.pieces for c in p}), np.uint32)
        number = {int(c): i + 1 for i, c in enumerate(self.alphabet)}
        self.trie = DoubleArray([tuple(number[ord(c)] for c in p) for p in self.pieces])
        self.longest = max(map(len, self.pieces), default=1)
        self.gain = -np.array([*self.costs, 0.0])
        self.unknown = -(max(self.costs, default=0.0) + self.strange)

    def lattice(self, runs: list[str]) -> Lattice:
        """runs: none of them empty."""
        codes = np.frombuffer("".join(runs).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(r) for r in runs], np.int64)
        starts = np.cumsum(sizes) - sizes
        n = len(codes)
        ends = np.repeat(starts + sizes, sizes)
        at = np.searchsorted(self.alphabet, codes)
        known = at < len(self.alphabet)
        known[known] = self.alphabet[at[known]] == codes[known]
        piece = self.trie.walk(np.where(known, at + 1, 0), ends, self.longest)
        weight = np.where(piece >= 0, self.gain[piece], -np.inf)
        weight[0] = np.where(piece[0] >= 0, weight[0], self.unknown)
        script = np.zeros(n, np.int64)
        for i, (low, high) in enumerate(WHOLE, 1):
            script[(codes >= low) & (codes <= high)] = i
        edge = np.ones(n + 1, bool)
        edge[1:-1] = script[1:] != script[:-1]
        edge[starts] = True
        heads = np.flatnonzero(edge)
        length = np.diff(heads)
        some = np.flatnonzero((length > 1) & (script[heads[:-1]] > 0))
        onward, back = np.zeros(n, np.int64), np.zeros(n, np.int64)
        onward[heads[some]] = back[heads[some + 1] - 1] = length[some]
        pad = self.longest
        first = np.cumsum(sizes + 1 + pad) - sizes - 1
        node = np.repeat(first - starts, sizes) + np.arange(n)
        return Lattice(starts, sizes, piece, weight, onward, back, node, first, self.unknown)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "table"}  # made anew where it is needed

    @cached_property
    def table(self) -> Table | None:
        """The trie as a table, if it isn't too large for one."""
        states = len({p[:k] for p in self.pieces for k in range(1, len(p) + 1)}) + 3
        return Table(self.pieces, self.costs, self.alphabet, self.strange) if states * (len(self.alphabet) + 2) <= TABLE else None

    def plain(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which runs the table can do: those without a script whose runs are words."""
        if self.table is None:
            return np.zeros(len(sizes), bool)
        if codes.max(initial=0) < WHOLE[0][0]:
            return np.ones(len(sizes), bool)
        return np.array([not WORDLIKE.search(r) for r in strings(codes, sizes)], bool)

    def marks(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of each character of all runs, whether a piece of the run's cheapest path begins with it."""
        plain = self.plain(codes, sizes)
        if plain.all():
            return self.table.marks(codes, sizes) if self.table else np.zeros(0, bool)
        out, of = np.zeros(len(codes), bool), np.repeat(plain, sizes)
        if plain.any():
            out[of] = self.table.marks(codes[of], sizes[plain])
        others = strings(codes[~of], sizes[~plain])
        known = dict.fromkeys(others)  # equal runs once, those of like length together
        for some in batches_of(sorted(known, key=len, reverse=True)):
            known.update(zip(some, self._cut(some), strict=True))
        each = np.array([len(w) for r in others for w in known[r]], np.intp)
        here = np.zeros(int(each.sum()), bool)
        here[np.cumsum(each) - each] = True
        out[~of] = here
        return out

    def expected(self, codes: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """In how many segmentations each piece stands, each counted by its probability and its run's weight."""
        n, plain = len(self.pieces), self.plain(codes, sizes)
        of = np.repeat(plain, sizes) if not plain.all() else slice(None)
        total, others = np.zeros(n), []
        if plain.any():
            here = codes[of]
            counts, left = self.table.expected(here, sizes[plain], weights[plain])
            total += counts[self.table.state_of]
            others += [(strings(here[a : a + size], np.array([size]))[0], w) for a, size, w in left]
        if not plain.all():
            others += zip(strings(codes[~of], sizes[~plain]), weights[~plain].tolist(), strict=True)
        others.sort(key=lambda x: len(x[0]))
        at = 0
        for some in batches_of([r for r, _ in others]):
            total += marginals(self.lattice(some), np.array([w for _, w in others[at : at + len(some)]]), n)[0]
            at += len(some)
        return total

    def cut(self, runs: list[str]) -> list[list[str]]:
        """The cheapest pieces of each run."""
        begins = iter(np.flatnonzero(self.marks(*flat(runs))).tolist())
        out, at, head = [], 0, next(begins, -1)
        for run in runs:
            found, first, at = [], at, at + len(run)
            while 0 <= head < at:
                found.append(head - first)
                head = next(begins, -1)
            out.append([run[a:z] for a, z in zip(found, [*found[1:], len(run)], strict=True)])
        return out

    def _cut(self, some: list[str]) -> list[list[str]]:
        out: list[list[str]] = []
        x = self.lattice(some)
        if not x.onward.any():
            last = Grid.of(x).best()
            for i, run in enumerate(some):
                at, found, ends = len(run), [], last[: len(run) + 1, i].tolist()
                while at:
                    found.append(run[at - ends[at] : at])
                    at -= ends[at]
                out.append(found[::-1])
        else:
            _, last = x.forward(best=True)
            for run, first in zip(some, x.first.tolist(), strict=True):
                at, found = len(run), []
                while at:
                    found.append(run[at - last[first + at] : at])
                    at -= int(last[first + at])
                out.append(found[::-1])
        return out

    def bonds(self) -> np.ndarray:
        """How much more the cheapest other cut of each piece costs than the piece itself; infinite for single characters."""
        out = np.full(len(self.pieces), np.inf)
        many = [i for i, p in enumerate(self.pieces) if len(p) > 1]
        at = iter(many)
        for some in batches_of([self.pieces[i] for i in many]):
            x = self.lattice(some)
            x.weight[x.sizes - 1, x.starts] = -np.inf
            total, _ = x.forward(best=True)
            for t in total[x.first + x.sizes].tolist():
                i = next(at)
                out[i] = -t - self.costs[i]
        return out

    def words(self, texts: list[str]) -> list[list[str]]:
        """Tokens of each text: runs of the scripts by the lattice, words of others whole, marks single."""
        found = [[(m[0], m[1] is not None) for m in OTHER.finditer(t)] for t in texts]
        cuts = iter(self.cut([w for f in found for w, inside in f if inside]))
        return [[w for token, inside in f for w in (next(cuts) if inside else [token])] for f in found]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(zip(self.pieces, self.costs, strict=True)), "piece string, cost double")

    @classmethod
    def read(cls, table: DataFrame) -> Lexicon:
        """Of a table with piece and cost; it has as many rows as the lexicon was asked for."""
        rows = table.select("piece", "cost").collect()
        return cls([r[0] for r in rows], [r[1] for r in rows])


def flat(runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all runs, one behind the other, and their sizes."""
    return np.frombuffer("".join(runs).encode("utf-32-le", "surrogatepass"), np.uint32), np.fromiter(map(len, runs), np.intp, len(runs))


def strings(codes: np.ndarray, sizes: np.ndarray) -> list[str]:
    joined, ends = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"), np.cumsum(sizes)
    return [joined[a:z] for a, z in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]


def flat_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """flat() of a column of strings."""
    column = column.cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or bounds[0] == bounds[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column), np.intp)
    data = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    if data.max() < 0x80:
        return data, np.diff(bounds).astype(np.intp)
    before = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), np.diff(before[bounds - bounds[0]]).astype(np.intp)


def batches_of(runs: list[str]) -> Iterator[list[str]]:
    """Consecutive runs; of a batch none is twice as long as the others but for short ones, as its grid has their longest size."""
    some, size, low, high = [], 0, 0, 0
    for r in runs:
        low, high = (min(low, len(r)), max(high, len(r))) if some else (len(r), len(r))
        if some and (size + len(r) > AT_ONCE or (high > 64 and high > 2 * low)):
            yield some
            some, size, low, high = [], 0, len(r), len(r)
        some.append(r)
        size += len(r)
    if some:
        yield some


def packed(codes: np.ndarray, sizes: np.ndarray, weights: np.ndarray, longest: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Substrings of each length of some runs, and how often they stand there: those of a length are numbered, and these numbers and
    the next characters are the substrings of the next length. A substring is as many longs as `longest` needs, three
    characters each, so that their order is that of the strings."""
    ends = np.cumsum(sizes)
    present = np.zeros(int(codes.max(initial=0)) + 1, np.intp)
    present[codes] = 1
    alphabet = np.flatnonzero(present)
    present[alphabet] = np.arange(len(alphabet))
    char, times = present.take(codes), np.repeat(weights.astype(np.float64), sizes)
    number, inside = np.zeros(len(codes), np.intp), np.ones(len(codes), bool)
    keys = [np.zeros(1, np.int64) for _ in range(-(-longest // PACKED))]
    for k in range(1, longest + 1):
        if k > 1:  # the last place of each run that is left goes
            inside[ends[sizes >= k - 1] - (k - 1)] = False
        if not inside.any():
            return
        bins = len(keys[0]) * len(alphabet)
        here = number[: len(codes) - k + 1] * len(alphabet) + char[k - 1 :]
        here, n = here[inside[: len(here)]], times[: len(here)][inside[: len(here)]]
        if bins <= 4 * COUNTED:  # few enough to be counted in place
            n = np.bincount(here, n, bins)
            distinct = np.flatnonzero(n)
            rank = np.zeros(bins, np.intp)
            rank[distinct] = np.arange(len(distinct))
            here, n = rank.take(here), n[distinct]
        else:
            here, distinct = pd.factorize(here)
            n = np.bincount(here, n, len(distinct))
        number[inside] = here
        before, last = np.divmod(distinct, len(alphabet))
        keys = [key.take(before) for key in keys]
        keys[(k - 1) // PACKED] += (alphabet.take(last) + 1) << (BITS * (PACKED - 1 - (k - 1) % PACKED))
        yield keys, n.astype(np.int64)


def unpacked(keys: tuple[int, ...]) -> str:
    codes = [key >> (BITS * i) & ((1 << BITS) - 1) for key in keys for i in range(PACKED - 1, -1, -1)]
    return "".join(chr(c - 1) for c in codes if c)


def substrings(runs: list[str], weights: list[int], longest: int) -> Iterator[pa.RecordBatch]:
    """piece and n of the substrings of each length of some runs."""
    for keys, n in packed(*flat(runs), np.array(weights), longest):
        yield pa.RecordBatch.from_arrays([pa.array([unpacked(k) for k in zip(*(key.tolist() for key in keys), strict=True)], pa.string()), pa.array(n)], ["piece", "n"])


def gathered(batches: Iterator[pa.RecordBatch], chars: int = COUNTED) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Codes and sizes of runs and their numbers, about so many characters at a time."""
    some: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for b in batches:
        codes, sizes = flat_column(b.column(0))
        some.append((codes, sizes, b.column(1).to_numpy()))
        if sum(len(c) for c, _, _ in some) > chars:
            yield tuple(map(np.concatenate, zip(*some, strict=True)))
            some = []
    if some:
        yield tuple(map(np.concatenate, zip(*some, strict=True)))


def candidates(runs: DataFrame, longest: int, least: int, most: int) -> DataFrame:
    """piece and n (occurrences) of the `most` substrings of up to `longest` characters that cover most, all those that
    occur `least` times at least, single characters first. runs: run and n. Substrings are counted as numbers and become
    strings when they are chosen. A substring is no more frequent than its parts, and the `most` best of the shorter ones
    say how frequent a longer one has to be: what can't be chosen isn't counted. removed() takes the result."""
    names = [f"k{i}" for i in range(-(-longest // PACKED))]
    schema = ", ".join(f"{k} long" for k in [*names, "n"])
    place = [F.shiftright(F.col(k), BITS * i).bitwiseAND(F.lit((1 << BITS) - 1)) for k in names for i in range(PACKED - 1, -1, -1)]
    size = sum(((p > 0).cast("int") for p in place[1:]), F.lit(1))
    runs = runs.where("run <> ''").select("run", "n")

    def record(keys: list[np.ndarray], n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (*keys, n)], [*names, "n"])

    def counted(low: int, high: int) -> DataFrame:
        """All substrings of low to high characters."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for codes, sizes, weights in gathered(batches):
                for k, (keys, n) in enumerate(packed(codes, sizes, weights, high), 1):
                    if k >= low:
                        yield record([*keys, *[np.zeros(len(n), np.int64)] * (len(names) - len(keys))], n)

        return kept(count)

    def longer(parts: list[tuple[int, ...]]) -> DataFrame:
        """Substrings whose first and last parts of one character less are among these."""
        pieces = sorted(unpacked(p) for p in parts)
        k = len(pieces[0]) + 1

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = Table(pieces, [0.0] * len(pieces), np.array(sorted({ord(c) for p in pieces for c in p}), np.uint32), 0.0)
            rank, total = np.full(table.n, -1, np.intp), np.zeros(len(pieces) * table.width)
            rank[table.state_of] = np.arange(len(pieces))
            for codes, sizes, weights in gathered(batches):
                label, ends, state = table.labels(codes), np.cumsum(sizes), np.zeros(max(0, len(codes) - k + 2), np.intp)
                for d in range(k - 1):
                    state *= table.width
                    state += label[d : d + len(state)]
                    state = table.child.take(state)
                found = rank.take(state) >= 0
                found = found[:-1] & found[1:]
                for d in range(1, k):  # a run's last places
                    found[(at := ends[sizes >= d] - d)[at < len(found)]] = False
                at = np.flatnonzero(found)
                total += np.bincount(rank.take(state[at]) * table.width + label[at + k - 1], np.repeat(weights.astype(np.float64), sizes)[at], len(total))
            there = np.flatnonzero(total)
            first, last = np.divmod(there, table.width)
            codes = np.array([[ord(c) + 1 for c in p] for p in pieces], np.int64).reshape(len(pieces), k - 1).take(first, axis=0)
            codes = np.column_stack([codes, table.alphabet.take(last - 1).astype(np.int64) + 1])
            keys = [np.zeros(len(there), np.int64) for _ in names]
            for i in range(k):
                keys[i // PACKED] += codes[:, i] << (BITS * (PACKED - 1 - i % PACKED))
            yield record(keys, total[there].astype(np.int64))

        return kept(count)

    def kept(count) -> DataFrame:
        return written(runs.mapInArrow(count, schema).groupBy(*names).agg(F.sum("n").alias("n")), "lattice-pieces")

    def best() -> DataFrame:
        return union(tables).select("*", size.alias("size"), (F.col("n") * size).alias("score")).where((F.col("size") == 1) | (F.col("n") >= least)).orderBy(F.desc(F.col("size") == 1), F.desc("score"), *names).limit(most)

    tables = [counted(1, min(SHORT, longest))]
    for k in range(SHORT + 1, longest + 1):
        held = best().agg(F.count("*").alias("n"), F.min(F.when(F.col("size") > 1, F.col("score"))).alias("score")).first()
        if held["n"] == most and held["score"] is None:
            break  # single characters are all there is room for
        needed = max(least, -(-held["score"] // longest) if held["n"] == most else 0)
        frequent = tables[-1].where((size == k - 1) & (F.col("n") >= needed)).select(*names)
        n = frequent.count()
        if not n:
            break
        if n * k * len(names) > TABLE:
            tables.append(counted(k, longest))
            break
        parts = [tuple(r) for r in frequent.collect()]
        if len({c for p in parts for c in unpacked(p)}) * n * k > TABLE:
            tables.append(counted(k, longest))
            break
        tables.append(longer(parts))
    string = F.pandas_udf(lambda *keys: pd.Series([unpacked(k) for k in zip(*keys, strict=True)], dtype=object), "string")
    out = best().select(string(*names).alias("piece"), "n")
    out.__dict__["parts"] = tables
    return out


def learn(texts: DataFrame, text_col: str = "text", pattern: str = RUN, longest: int = 6, least: int = 5, most: int = 50_000, rounds: int = 6, floor: float = 1.0, bond: float = 1.0) -> Lexicon:
    """A lexicon of the runs that match `pattern` (without spaces inside) in a column of texts.

    Equal runs are counted first, by Spark, and worked on once. Each of the `rounds` finds in how many segmentations each
    piece is expected; pieces of two characters or more go if they are expected less than `floor` times, or if their best
    other cut costs less than `bond` more (words that only stand side by side are no word). Null and empty
    texts have no runs; without any run the lexicon is empty. Costs are rounded to six places, so that the order of
    additions doesn't show."""
    found = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"({pattern})"), F.lit(1)))
    counted = texts.select(found.alias("run")).where("run <> ''").groupBy("run").agg(F.count("*").alias("n"))
    # dealt anew, as each character is much work: adaptive execution would put small tables in one task
    runs = written(counted.repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "run").sortWithinPartitions(F.length("run")), "lattice-runs")
    chosen = candidates(runs, longest, least, most)
    rows = chosen.collect()
    removed(chosen)
    counts = {r[0]: float(r[1]) for r in rows}
    lexicon = _costs(counts)
    for _ in range(rounds if counts else 0):
        expected = _expected(runs, lexicon)
        bonds = _costs(dict(zip(lexicon.pieces, expected, strict=True))).bonds()
        counts = {p: c for p, c, b in zip(lexicon.pieces, expected, bonds, strict=True) if len(p) == 1 or (c >= floor and b >= bond)}
        lexicon = _costs(counts)
    removed(runs)
    return lexicon


def _costs(counts: dict[str, float]) -> Lexicon:
    total = sum(max(c, 0.5) for c in counts.values())
    return Lexicon(list(counts), [round(math.log(total / max(c, 0.5)), 6) for c in counts.values()])


def _expected(runs: DataFrame, lexicon: Lexicon) -> list[float]:
    n = len(lexicon.pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n)
        for codes, sizes, weights in gathered(batches):
            total += lexicon.expected(codes, sizes, weights.astype(np.float64))
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["piece", "expected"])

    sums = runs.select("run", "n").mapInArrow(run, "piece long, expected double").groupBy("piece").agg(F.sum("expected").alias("expected"))
    out = [0.0] * n
    for piece, expected in sums.collect():
        out[piece] = expected
    return out


def segmented(lexicon: Lexicon, text_col: str = "text", pattern: str | None = None) -> Column:
    """Column of the tokens of a text: of all its words and marks, or of the runs that match a pattern only."""
    if pattern is None:
        return F.pandas_udf(lambda column: pd.Series(lexicon.words([x or "" for x in column]), dtype=object), "array<string>")(text_col)
    finder = re.compile(pattern)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch), 0).to_numpy(zero_copy_only=False)
            parts = [_pieces(lexicon, finder, batch.slice(a, b - a).to_pylist()) for a, b in slices(sizes.tolist(), len(batch) or 1, CUT)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))

    return F.arrow_udf(run, "array<string>")(text_col)


def _pieces(lexicon: Lexicon, finder: re.Pattern, texts: list[str | None]) -> pa.Array:
    """The pieces of the runs of each text, cut from one buffer."""
    found = [finder.findall(x or "") for x in texts]
    runs = [r for f in found for r in f if r]
    joined, (codes, sizes) = "".join(runs), flat(runs)
    begins = np.flatnonzero(lexicon.marks(codes, sizes))
    ends = np.cumsum([sum(map(len, f)) for f in found])
    rows = np.append(0, np.searchsorted(begins, ends, "left")).astype(np.int32)
    data = joined.encode()
    offsets = np.append(begins, len(joined))
    if len(data) != len(joined):
        width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        offsets = np.append(0, np.cumsum(width)).take(offsets)
    words = pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
    return pa.ListArray.from_arrays(pa.array(rows), words)
