"""SentencePiece encoding and decoding with Gumbel top-k segmentations drawn without replacement.

A text (with the model's leading blank) is cut into units that no vocabulary piece crosses; each unit
is a lattice whose edges are pieces, weighted by a Zipf law over piece ranks, with byte pieces where a
character has no piece of its own. Backward sums over the lattice give exact conditional edge
probabilities, so a subtree of segmentations has a known mass and its best perturbed score is a
truncated Gumbel variable. A best-first (A-star) search pops the subtree of highest perturbed score,
follows it down to one segmentation and pushes its siblings: the first ``k`` pops are a sample without
replacement. The next score on the agenda is the threshold of the inclusion probabilities
``1 - exp(-exp(log_prob - threshold))``. All random numbers derive from the row key, the round and the
position, so results do not depend on partitions, batches or retries.

Defined results: null text has one sample with no ids (decoded to null); an empty text one sample with
no ids; a text with fewer than ``k`` segmentations gives all of them, with inclusion 1; repeated rows
give the same samples; decoding any sample gives back the text exactly.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuslens.llm.common import return_memory, small_batches, with_fields

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNIT = re.compile(r"\n| *[^ \n]+| +")
BLANK, OFFSET = "▁", 2.7
#: Steps of a path whose branches are on the agenda one by one; those of later steps share one entry.
STEPS = 48
#: Nodes above which a worker thins out its lattice cache (memory only, not results).
CACHE_NODES = 250_000
#: Characters that are looked up at once, and characters of the texts that are searched together.
PART, GROUP = 100_000, 100_000
MASK = 0xFFFFFFFFFFFFFFFF


class Vocabulary:
    """Piece texts with ``BLANK`` as a space, their ids and log-weights, and the byte pieces."""

    def __init__(self, path: str, temperature: float) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.ids, self.weight, self.longest = {}, {}, 1
        self.bytes_of: list[bytes] = [b""] * size
        self.byte_id = [0] * 256
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i)):
                text = piece.replace(BLANK, " ")
                inner = text.lstrip(" ")
                if "\n" in text or " " in inner:
                    raise ValueError(f"piece {piece!r} crosses units")
                self.ids[text] = i
                self.weight[text] = -temperature * math.log(i + OFFSET)
                self.longest = max(self.longest, len(text))
                self.bytes_of[i] = text.encode()
        self.byte_weight = -temperature * math.log(size + OFFSET)
        codes = np.array([self.hash(t) for t in self.ids], np.uint64)
        if len(np.unique(codes)) != len(codes):
            raise ValueError("two pieces share a hash")
        order = np.argsort(codes)
        self.codes = codes[order]
        self.code_ids = np.array(list(self.ids.values()), np.int32)[order]
        self.code_weights = np.array(list(self.weight.values()))[order]
        # places of the codes by their top bits; of codes that share these, the later ones are searched for
        top = (self.codes >> SIEVE_SHIFT).astype(np.int64)
        self.place = np.full(1 << 20, -1, np.int32)
        self.place[top[::-1]] = np.arange(len(top) - 1, -1, -1, dtype=np.int32)
        self.doubled = np.append(top[1:] == top[:-1], False)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``codes`` are pieces, and their places."""
        at = self.place[(codes >> SIEVE_SHIFT).astype(np.int64)]
        maybe = np.flatnonzero(at >= 0)
        at = at[maybe]
        wrong = np.flatnonzero(self.codes[at] != codes[maybe])
        again = wrong[self.doubled[at[wrong]]]
        at[again] = np.minimum(np.searchsorted(self.codes, codes[maybe[again]]), len(self.codes) - 1)
        hit = self.codes[at] == codes[maybe]
        return maybe[hit], at[hit]

    @staticmethod
    def hash(text: str) -> int:
        """64-bit polynomial of mixed code points, as ``Lattices.add`` builds it for all substrings at once."""
        value = np.zeros(1, np.uint64)
        for c in text:
            value = value * MULTIPLIER + spread(np.array([ord(c)], np.uint64))
        return int(value[0])


MULTIPLIER, SIEVE_SHIFT, CHAIN_SHIFT = np.uint64(0x9FB21C651E98DF25), np.uint64(44), np.uint64(46)


def spread(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


class Lattices:
    """Lattices of the units that a worker met, as flat arrays: ``first`` edge of a node (one entry more than
    nodes) and its ``char``; ``upto`` (cumulative chance within the node), ``logs``, ``pieces`` (or -1 - code
    point: bytes), ``after`` (next node, -1: end) and ``node`` of an edge.

    Units are found by a 64-bit hash and compared by their characters. When the cache is full it keeps the
    units that were met most often (memory only, not results).
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.power = np.ones(1, np.uint64)
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.starts, self.sizes, self.hits = (np.zeros(0, np.int64) for _ in range(3))
        self.next, self.chains = np.zeros(0, np.int32), np.full(1 << 18, -1, np.int32)
        self.first, self.char = np.zeros(1, np.int32), np.zeros(0, np.uint32)
        self.upto, self.logs = np.zeros(0), np.zeros(0)
        self.pieces, self.after, self.node = (np.zeros(0, np.int32) for _ in range(3))
        self._room = {}

    def _extend(self, name: str, values: np.ndarray, keep: int | None = None) -> None:
        """Append to an array whose room doubles; ``keep`` entries of the old one stay."""
        old = getattr(self, name)
        used = len(old) if keep is None else keep
        size = used + len(values)
        room = self._room.get(name)
        if room is None or len(room) < size:
            room = np.empty(max(1 << 16, size + size // 2), old.dtype)
            room[:used] = old[:used]
            self._room[name] = room
        room[used:size] = values
        setattr(self, name, room[:size])

    def starts_of(self, chars: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """First node of every unit of ``chars``; ``begins`` are the places where units begin."""
        if len(self.char) > CACHE_NODES:
            self._evict()
        ends = np.append(begins[1:], len(chars))
        out = np.empty(len(begins), np.int64)
        at = 0
        while at < len(begins):  # a bounded number of characters at a time
            to = max(at + 1, int(np.searchsorted(ends, begins[at] + PART, side="right")))
            lo, hi = begins[at], ends[to - 1]
            out[at:to] = self._find(chars[lo:hi], begins[at:to] - lo)
            at = to
        return out

    def _find(self, chars: np.ndarray, begins: np.ndarray) -> np.ndarray:
        sizes = np.diff(np.append(begins, len(chars)))
        longest = int(sizes.max())
        while len(self.power) < longest:
            self.power = np.concatenate([self.power, self.power * (self.power[-1:] * MULTIPLIER)])
        inside = np.arange(len(chars)) - np.repeat(begins, sizes)
        codes = np.add.reduceat(spread(chars.astype(np.uint64)) * self.power[inside], begins)
        codes = (codes ^ (codes >> np.uint64(32))) * MULTIPLIER + sizes.astype(np.uint64)
        at = self._places(codes)
        new = np.flatnonzero(at < 0)
        if len(new):
            once = new[np.unique(codes[new], return_index=True)[1]]
            started = self._add(chars, begins[once], sizes[once])
            for name, values in (("keys", codes[once]), ("starts", started), ("sizes", sizes[once]), ("hits", np.zeros(len(once), np.int64))):
                self._extend(name, values)
            self._link(len(self.keys) - len(once))
            at[new] = self._places(codes[new])
        self.hits += np.bincount(at, minlength=len(self.hits))
        starts = self.starts[at]
        # a hash may be shared: units whose characters differ from the cached ones get lattices of their own
        same = self.sizes[at] == sizes
        spot = np.where(np.repeat(same, sizes), np.repeat(starts, sizes) + inside, 0)
        same &= np.logical_and.reduceat(self.char[spot] == chars, begins)
        other = np.flatnonzero(~same)
        if len(other):
            starts[other] = self._add(chars, begins[other], sizes[other])
        return starts

    def _places(self, codes: np.ndarray) -> np.ndarray:
        """Place of each code among the keys, -1 where it is none."""
        at = self.chains[(codes >> CHAIN_SHIFT).astype(np.int64)]
        going = np.flatnonzero(at >= 0)
        while len(going):
            going = going[self.keys[at[going]] != codes[going]]
            at[going] = self.next[at[going]]
            going = going[at[going] >= 0]
        return at

    def _link(self, begin: int) -> None:
        """Put the keys from ``begin`` on in front of the chains of their top bits."""
        top = (self.keys[begin:] >> CHAIN_SHIFT).astype(np.int64)
        order = np.argsort(top, kind="stable")
        top, place = top[order], (order + begin).astype(np.int32)
        linked = np.empty(len(top), np.int32)
        again = np.append(False, top[1:] == top[:-1])
        linked[order] = np.where(again, np.append(np.int32(-1), place[:-1]), self.chains[top])
        self._extend("next", linked)
        self.chains[top] = place  # of equal ones the last stays

    def _evict(self) -> None:
        """Keep the units met most often, up to half of the room; lattices without a key go."""
        order = np.lexsort((self.starts, -self.hits))
        kept = np.sort(order[: int(np.searchsorted(np.cumsum(self.sizes[order]), CACHE_NODES // 2))])
        kept = kept[self.hits[kept] > 1]
        keys, starts, sizes, hits = self.keys[kept], self.starts[kept], self.sizes[kept], self.hits[kept] // 2
        nodes = ragged(starts, sizes)
        moved = np.repeat(np.cumsum(sizes) - sizes - starts, sizes)
        degrees = np.diff(self.first)[nodes]
        edges, shift = ragged(self.first[nodes].astype(np.int64), degrees), np.repeat(moved, degrees)
        after = self.after[edges]
        old = {n: getattr(self, n)[edges] for n in ("upto", "logs", "pieces")} | {"after": np.where(after < 0, -1, after + shift), "node": self.node[edges] + shift, "char": self.char[nodes]}
        self._reset()
        self.keys, self.starts, self.sizes, self.hits = keys, np.cumsum(sizes) - sizes, sizes, hits
        self._link(0)
        for name, values in old.items():
            self._extend(name, values)
        self._extend("first", np.concatenate([[0], np.cumsum(degrees)]), 0)

    def _add(self, chars: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """First nodes of new lattices, one for each of the given units."""
        own = chars[ragged(begins, sizes)]
        started = len(self.char) + np.cumsum(sizes) - sizes
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            lo = int(ends[at] - sizes[at])
            to = max(at + 1, int(np.searchsorted(ends, lo + PART // 4, side="right")))
            self._build(own[lo : int(ends[to - 1])], sizes[at:to])
            at = to
        return started

    def _build(self, chars: np.ndarray, sizes: np.ndarray) -> None:
        """Backward sums of many lattices at once, by distance to the unit's end."""
        v = self.vocabulary
        n, longest, nodes = len(chars), v.longest, len(self.char)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)
        mixed_chars = spread(chars.astype(np.uint64))
        value, idx = np.zeros(n, np.uint64), np.arange(n)
        found_by_width, count = [], np.zeros(n, np.int64)
        for w in range(1, min(longest, int(sizes.max())) + 1):
            idx = idx[left[idx] >= w]
            value[idx] = code = value[idx] * MULTIPLIER + mixed_chars[idx + w - 1]
            hit, at = v.find(code)
            found, ids, weights = idx[hit], v.code_ids[at], v.code_weights[at]
            if w == 1:  # characters without a piece are spelled in bytes
                bare = np.ones(n, bool)
                bare[found] = False
                bare = np.flatnonzero(bare)
                c = chars[bare].astype(np.int64)
                found, ids = np.concatenate([found, bare]), np.concatenate([ids, -1 - c])
                weights = np.concatenate([weights, v.byte_weight * (1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF))])
            count[found] += 1
            found_by_width.append((w, found, ids, weights))
        # edges in order of node and width, placed by counts
        first = np.concatenate([[0], np.cumsum(count)])
        fill, total_edges = first[:-1].copy(), int(first[-1])
        node, width, piece, gain = np.repeat(np.arange(n), count), np.zeros(total_edges, np.int64), np.zeros(total_edges, np.int32), np.zeros(total_edges)
        for w, found, ids, weights in found_by_width:
            spot = fill[found]
            fill[found] += 1
            width[spot], piece[spot], gain[spot] = w, ids, weights
        # backward sums, by distance of the node to the unit's end
        reach = left[node]
        order = np.argsort(reach.astype(np.uint16) if reach.max() < 65536 else reach, kind="stable")
        to = np.where(width == reach, n, node + width)[order]
        fresh, gain_in, node_in = (order == first[node[order]]), gain[order], node[order]
        below, logs_in = np.zeros(n + 1), np.zeros(total_edges)
        limits = np.concatenate([[0], np.cumsum(np.bincount(reach)[1:])])
        for lo, hi in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
            total = gain_in[lo:hi] + below[to[lo:hi]]
            starts = np.flatnonzero(fresh[lo:hi])
            times = np.diff(np.append(starts, hi - lo))
            top = np.maximum.reduceat(total, starts)
            whole = top + np.log(np.add.reduceat(np.exp(total - np.repeat(top, times)), starts))
            below[node_in[lo:hi][starts]] = whole
            logs_in[lo:hi] = total - np.repeat(whole, times)
        logs = np.zeros(total_edges)
        logs[order] = np.minimum(logs_in, 0.0)
        # cumulative chances node by node, so that they do not depend on what else is built
        upto, rank = np.exp(logs), 1
        some = np.flatnonzero(count > 1)
        while len(some):
            spot = first[some] + rank
            upto[spot] += upto[spot - 1]
            rank += 1
            some = some[count[some] > rank]
        upto[first[1:] - 1] = 1.0
        after = np.where(width == reach, -1, nodes + node + width)
        edges = len(self.logs)
        self._extend("first", edges + first, nodes)
        for name, values in (("char", chars), ("upto", upto), ("logs", logs), ("pieces", piece), ("after", after), ("node", nodes + node)):
            self._extend(name, values)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: uniform numbers in (0, 1) from counters."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def descend(lattices: Lattices, nodes: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ancestral samples of many units at once: (unit number, edge), in order of unit and piece."""
    owner, edges = [], []
    who = np.flatnonzero(nodes >= 0)
    at, seed = nodes[who], seeds[who]
    turn = 0
    while len(who):
        turn += 1
        e, u = lattices.first[at], mixed(seed + np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        on = np.flatnonzero(u > lattices.upto[e])
        while len(on):
            e[on] += 1
            on = on[u[on] > lattices.upto[e[on]]]
        owner.append(who)
        edges.append(e)
        at = lattices.after[e]
        going = at >= 0
        who, at, seed = who[going], at[going], seed[going]
    if not owner:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner, edges = np.concatenate(owner), np.concatenate(edges)
    order = np.argsort(owner, kind="stable")
    return owner[order], edges[order]


@dataclass
class Turn:
    """One segmentation of every text that still has one: ``edges`` and ``units`` from ``offsets[i]`` on,
    perturbed scores of the subtrees beside its steps (from the step ``first`` on, the last column for all
    later ones), the step where it left an earlier path and the edges ``barred`` there."""

    live: np.ndarray
    offsets: np.ndarray
    edges: np.ndarray
    units: np.ndarray
    first: np.ndarray
    split: np.ndarray
    barred: np.ndarray
    log_prob: np.ndarray
    score: np.ndarray
    beside: np.ndarray


class Search:
    """Perturbed best-first search of many texts at once; row ``i`` of every array is text ``i``."""

    def __init__(self, nodes: np.ndarray, offsets: np.ndarray, seeds: np.ndarray, lattices: Lattices) -> None:
        self.nodes, self.offsets, self.seeds, self.lattices = nodes, offsets, seeds, lattices
        n = len(seeds)
        self.turns: list[Turn] = []
        #: Scores of later steps that were split up, by text: turn, step of the first, scores.
        self.later: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        self.live, self.score = np.ones(n, bool), -np.log(-np.log(mixed(seeds)))
        self.head, self.head_units, self.head_size = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n, np.int64)
        self.barred = np.zeros((n, 0), np.int64)

    def push(self) -> None:
        """Finish the segmentation of each live text and put the subtrees beside its path on the agenda."""
        lattices, turn, n = self.lattices, len(self.turns), len(self.seeds)
        from_unit, count = np.zeros(n, np.int64), np.where(self.live, np.diff(self.offsets), 0)
        ends = np.cumsum(self.head_size)
        if turn:
            from_unit[self.live] = self.head_units[ends[self.live] - 1]
            count = np.where(self.live, count - from_unit, 0)
        nodes = self.nodes[ragged(self.offsets[:-1] + from_unit, count)]
        if turn:
            nodes[(np.cumsum(count) - count)[self.live]] = lattices.after[self.head[ends[self.live] - 1]]
        place = ragged(from_unit, count)
        salt = self.seeds ^ np.uint64((turn + 1) * 0x8CB92BA72F3D8DD7 & MASK)
        owner, drawn = descend(lattices, nodes, (place + 1).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB) + np.repeat(salt, count))
        added = np.bincount(np.repeat(np.arange(n), count)[owner], minlength=n)
        size = self.head_size + added
        offsets = np.concatenate([[0], np.cumsum(size)])
        edges, units = np.empty(offsets[-1], np.int64), np.empty(offsets[-1], np.int64)
        old, new = ragged(offsets[:-1], self.head_size), ragged(offsets[:-1] + self.head_size, added)
        edges[old], units[old], edges[new], units[new] = self.head, self.head_units, drawn, place[owner]

        logs = lattices.logs[edges]
        split = self.head_size - 1
        first = np.maximum(split, 0)
        log_prob, base = sums(logs, offsets[:-1], size), sums(logs, offsets[:-1], first)
        steps = np.arange(STEPS)
        within = first[:, None] + steps < size[:, None]
        own = np.zeros((n, STEPS))
        own[within] = logs[((offsets[:-1] + first)[:, None] + steps)[within]]
        run = base[:, None] + np.cumsum(own, 1)
        mass = np.full((n, STEPS + 1), -np.inf)
        with np.errstate(divide="ignore"):
            mass[:, :STEPS][within] = ((run - own) + np.log(-np.expm1(own)))[within]
            if turn:  # where the path left an earlier one, the edges taken there before are no branches
                row = np.flatnonzero(self.live)
                edge, barred = edges[offsets[row] + split[row]], self.barred[row]
                gone = np.where(barred >= 0, np.exp(lattices.logs[barred]), 0.0).sum(1)
                others = np.maximum(0.0, -np.expm1(lattices.logs[edge]) - gone)
                others[self._degree(edge) <= (barred >= 0).sum(1) + 1] = 0.0
                mass[row, 0] = base[row] + np.log(others)
            far = size > first + STEPS  # one subtree for all later branches, split up only if it is popped
            mass[far, STEPS] = (run[:, -1] + np.log(-np.expm1(np.minimum(0.0, log_prob - run[:, -1]))))[far]
        self.turns.append(Turn(self.live, offsets, edges, units, first, split, self.barred, log_prob, self.score, perturbed(mass, self.score[:, None], self.seeds[:, None], turn + 1)))

    def pop(self) -> None:
        """Take the best subtree of each text; its first edge is drawn among those not barred. Texts without any end."""
        lattices, n, done = self.lattices, len(self.seeds), len(self.turns)
        agenda = np.concatenate([t.beside for t in self.turns], 1)
        where = agenda.argmax(1)
        best = agenda[np.arange(n), where]
        source, step = where // (STEPS + 1), where % (STEPS + 1)
        at = np.zeros(n, np.int64)
        for p, t in enumerate(self.turns):
            mine = np.flatnonzero((source == p) & (best > -np.inf))
            at[mine] = t.first[mine] + step[mine]
        for i, parts in self.later.items():
            for p, begin, scores in parts:
                j = int(scores.argmax())
                if scores[j] > best[i]:
                    best[i], source[i], step[i], at[i] = scores[j], p, -1, begin + j
        for i in np.flatnonzero((step == STEPS) & (best > -np.inf)).tolist():  # later branches: the best one inherits the score
            t = self.turns[source[i]]
            begin = int(t.first[i]) + STEPS
            logs = lattices.logs[t.edges[t.offsets[i] : t.offsets[i + 1]]]
            with np.errstate(divide="ignore"):
                mass = (np.cumsum(logs) - logs + np.log(-np.expm1(logs)))[begin:]
            shares = np.cumsum(np.exp(mass - mass.max()))
            j = int(np.searchsorted(shares / shares[-1], self._uniform(done, 3)[i]))
            self.later.setdefault(i, []).append((int(source[i]), begin, perturbed(mass, best[i], self.seeds[i : i + 1], done + 1_000_003)))
            at[i] = begin + j
        self.live = best > -np.inf
        row = np.flatnonzero(self.live)
        edge, barred = np.zeros(n, np.int64), np.full((n, done), -1)
        sizes = np.where(self.live, at + 1, 0)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        head, head_units = np.empty(offsets[-1], np.int64), np.empty(offsets[-1], np.int64)
        for p, t in enumerate(self.turns):
            mine = row[source[row] == p]
            near = mine[(step[mine] >= 0)]
            t.beside[near, step[near]] = -np.inf
            edge[mine] = t.edges[t.offsets[mine] + at[mine]]
            again = mine[at[mine] == t.split[mine]]
            barred[again, 1 : 1 + t.barred.shape[1]] = t.barred[again]
            spot, old = ragged(offsets[mine], sizes[mine]), ragged(t.offsets[mine], sizes[mine])
            head[spot], head_units[spot] = t.edges[old], t.units[old]
        for i, parts in self.later.items():
            for p, begin, scores in parts:
                if self.live[i] and source[i] == p and at[i] >= begin:
                    scores[at[i] - begin] = -np.inf
        barred[:, 0] = edge
        if len(row):
            begin, degree = lattices.first[lattices.node[edge[row]]].astype(np.int64), self._degree(edge[row])
            wide = np.arange(int(degree.max()))
            options = begin[:, None] + wide
            open_ = wide < degree[:, None]
            for c in range(done):
                open_ &= options != barred[row, c][:, None]
            chance = np.where(open_, np.exp(lattices.logs[np.where(open_, options, 0)]), 0.0).cumsum(1)
            pick = (chance < (self._uniform(done, 1)[row] * chance[:, -1])[:, None]).sum(1)
            pick = np.minimum(pick, len(wide) - 1 - open_[:, ::-1].argmax(1))
            head[offsets[row + 1] - 1] = begin + pick
        self.head, self.head_units, self.head_size, self.score, self.barred = head, head_units, sizes, best, barred

    def _uniform(self, turn: int, salt: int) -> np.ndarray:
        return mixed(self.seeds ^ np.uint64((turn + salt * 977) * 0xD1342543DE82EF95 & MASK))

    def _degree(self, edge: np.ndarray) -> np.ndarray:
        node = self.lattices.node[edge]
        return self.lattices.first[node + 1] - self.lattices.first[node]

    def log_inclusion(self) -> list[np.ndarray]:
        """Per turn the log chance that a segmentation is among the sample, given the next score on the agenda."""
        limit = np.concatenate([t.beside for t in self.turns], 1).max(1)
        for i, parts in self.later.items():
            limit[i] = max(limit[i], *(s.max() for _, _, s in parts))
        out = []
        for t in self.turns:
            x = t.log_prob - limit
            # log(1 - exp(-exp(x))): x itself where the chance is tiny
            out.append(np.where(x > 4, 0.0, np.where(x < -30, x, np.log(-np.expm1(-np.exp(np.clip(x, -30, 4)))))))
        return out


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0] + 1, ...`` for ``sizes[0]`` numbers, then those of the next start, and so on."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def sums(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each stretch of ``values``; 0 for empty ones."""
    out, some = np.zeros(len(sizes)), np.flatnonzero(sizes > 0)
    if len(some):
        own = values[ragged(starts[some], sizes[some])]
        out[some] = np.add.reduceat(own, np.cumsum(sizes[some]) - sizes[some])
    return out


def perturbed(mass: np.ndarray, top: np.ndarray | float, seeds: np.ndarray, salt: int) -> np.ndarray:
    """Gumbel variables at the masses, truncated at ``top``; empty branches get minus infinity."""
    seed = seeds + np.uint64(salt * 0xA0761D6478BD642F & MASK)
    u = mixed(seed + np.arange(mass.shape[-1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    with np.errstate(over="ignore", invalid="ignore"):
        scores = mass - np.log(np.exp(mass - top) - np.log(u))
    return np.where(np.isfinite(mass), scores, -np.inf)


def units_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all texts (each with a leading blank), the places where units begin, and units before each text."""
    sizes = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
    chars = np.frombuffer("".join(" " + t for t in texts if t).encode("utf-32-le", "surrogatepass"), np.uint32)
    line, blank = chars == 10, chars == 32
    begin = line.copy()
    begin[1:] |= line[:-1] | (blank[1:] & ~blank[:-1])
    ends = np.cumsum(sizes)
    begin[(ends - sizes)[sizes > 0]] = True
    begins = np.flatnonzero(begin)
    return chars, begins, np.concatenate([[0], np.searchsorted(begins, ends)])


def search_texts(texts: list[str | None], seeds: list[int], k: int, lattices: Lattices) -> Search:
    """The finished search for up to ``k`` segmentations of each text."""
    chars, begins, offsets = units_of(texts)
    nodes = lattices.starts_of(chars, begins) if len(begins) else np.zeros(0, np.int64)
    search = Search(nodes, offsets, np.array(seeds, np.uint64), lattices)
    for turn in range(k):
        if turn:
            search.pop()
        search.push()
    return search


def sample_texts(texts: list[str | None], seeds: list[int], k: int, lattices: Lattices) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """Per text its samples in order of perturbed score: ids, log probability, score, log inclusion."""
    search, out = search_texts(texts, seeds, k, lattices), [[] for _ in texts]
    for t, log_in in zip(search.turns, search.log_inclusion(), strict=True):
        ids, ends = ids_of(lattices, t)
        for i in np.flatnonzero(t.live).tolist():
            out[i].append((ids[ends[i] : ends[i + 1]], float(t.log_prob[i]), float(t.score[i]), float(log_in[i])))
    return out


def ids_of(lattices: Lattices, turn: Turn) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all paths of a turn, characters without a piece as their bytes, and where each text's begin."""
    pieces = lattices.pieces[turn.edges]
    bare = np.flatnonzero(pieces < 0)
    if not len(bare):
        return pieces, turn.offsets
    spelled = [[lattices.vocabulary.byte_id[b] for b in chr(-1 - p).encode("utf-8", "replace")] for p in pieces[bare].tolist()]
    times = np.ones(len(pieces), np.int64)
    times[bare] = [len(x) for x in spelled]
    out = np.repeat(pieces, times)
    out[out < 0] = np.concatenate(spelled)
    return out, np.concatenate([[0], np.cumsum(times)])[turn.offsets]


def text_groups(texts: list[str | None], most: int) -> Iterator[tuple[int, int]]:
    """Stretches of texts of at most ``most`` characters together, or of one longer text."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t or "") > most:
            yield begin, i
            begin, size = i, 0
        size += len(t or "")
    if begin < len(texts):
        yield begin, len(texts)


@lru_cache(maxsize=2)
def worker_lattices(path: str, temperature: float) -> Lattices:
    return Lattices(Vocabulary(path, temperature))


@lru_cache(maxsize=2)
def worker_bytes(path: str) -> pa.Array:
    """Bytes of every piece by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        plain = not (model.is_control(i) or model.is_unknown(i))
        spelled.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(BLANK, " ").encode() if plain else b"")
    return pa.array(spelled, pa.binary())


def spell(lists: pa.Array, table: pa.Array) -> list[str | None]:
    """Texts of lists of ids, the model's leading blank removed; null for null."""
    flat = table.take(lists.flatten())
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    joined = pc.binary_join(pa.ListArray.from_arrays(ends, flat), b"").to_pylist()
    return [x.decode("utf-8", "replace")[1:] if valid else None for x, valid in zip(joined, lists.is_valid().to_pylist(), strict=True)]


def encode_samples(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 2, temperature: float = 1.0, seed: int = 17, model: str = MODEL, carry: tuple[str, ...] = ()) -> DataFrame:
    """Up to ``k`` rows per row of ``docs``: ``key``, ``carry``, ``sample`` (1 is best), ``ids``, ``log_prob``, ``perturbed``, ``log_inclusion``, ``round_trip`` (decoding ``ids`` gives the text)."""
    keep = (key, *carry)
    schema = with_fields(docs.select(*keep).schema, "sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double, round_trip boolean")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return_memory()
        lattices, table = worker_lattices(model, temperature), worker_bytes(model)
        for batch in small_batches(batches, 1024):
            seeds = [xxhash.xxh3_64_intdigest(repr(x), seed) for x in batch.column(0).to_pylist()]
            texts = batch.column(len(keep)).to_pylist()
            for a, b in text_groups(texts, GROUP):
                search = search_texts(texts[a:b], seeds[a:b], k, lattices)
                for number, (t, log_in) in enumerate(zip(search.turns, search.log_inclusion(), strict=True)):
                    rows = np.flatnonzero(t.live)
                    flat, ends = ids_of(lattices, t)
                    ids = pa.ListArray.from_arrays(pa.array(np.append(ends[rows], ends[-1]).astype(np.int32)), pa.array(flat.astype(np.int32)))
                    same = pa.array([own == (texts[a + i] or "") for own, i in zip(spell(ids, table), rows.tolist(), strict=True)], pa.bool_())
                    kept = batch.select(list(range(len(keep)))).take(pa.array(a + rows))
                    columns = [pa.array(np.full(len(rows), number + 1, np.int32)), ids, *(pa.array(x[rows]) for x in (t.log_prob, t.score, log_in)), same]
                    yield pa.RecordBatch.from_arrays([*kept.columns, *columns], names=schema.fieldNames())
        return_memory()

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(work, schema)


def decode_ids(df: DataFrame, ids: str = "ids", out: str = "decoded", model: str = MODEL) -> DataFrame:
    """``df`` with ``out``: the text whose segmentation ``ids`` is, the model's leading blank removed."""
    schema = with_fields(df.schema, f"`{out}` string")
    at, names = df.columns.index(ids), [*df.columns, out]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_bytes(model)
        for batch in small_batches(batches):
            texts = spell(batch.column(at), table)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=names)

    return df.mapInArrow(work, schema)
