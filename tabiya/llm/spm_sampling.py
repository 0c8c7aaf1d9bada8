"""SentencePiece encoding with sampled segmentations, and decoding.

A public SentencePiece model gives the pieces. A text's segmentations are the
paths of a lattice: character positions are nodes, pieces are edges, a
character without a piece is an edge of byte pieces. Pieces never hold a space
mark behind another character, so the lattice falls into chunks (a run of
marks and what follows) that can be solved once per distinct chunk.

Edge weights are Zipf's law over the model's piece order,
``log p = -exponent * log(rank + shift)``, so that ranks of a BPE model and
log probabilities of a unigram model are handled alike.

``k`` distinct segmentations are drawn without replacement: the forward
filter gives every node the total mass before it, and an A* search from the
text's end expands partial paths in the order of their Gumbel-perturbed
mass, where the best child of a node keeps its parent's value and the other
children, held together until one of them is needed, get the largest of
their Gumbels truncated at that value. The order of complete paths is an
exact sample without replacement; the perturbed value of the (k+1)-th is the
threshold that turns path probabilities into inclusion scores. All numbers
come from a hash of (seed, row key, sample, position): a row gives the same
segmentations in any batch, task or attempt.

Defined cases: a null or empty text has one segmentation, the empty one; a
text with fewer than ``k`` segmentations returns all of them with inclusion
score 0 (certain); repeated rows sample alike (same key); a null key is its
own key.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from .common import lean, ship

SPACE = "▁"
#: What is solved together: marks and what follows them.
CHUNK = re.compile(SPACE + "+[^" + SPACE + "]*|[^" + SPACE + "]+")
_U = np.uint64
#: Log probabilities are multiples of 1 / _UNIT.
_UNIT = float(1 << 32)
_CP_BASE = 0xC2B2AE3D27D4EB4F | 1
#: Characters of text handled together: some 400 bytes of arrays each.
BATCH_CHARS = 1 << 19
#: Edges of solved chunks that a worker keeps (42 bytes each).
KEPT_EDGES = 5_000_000
#: Steps of a path whose sibling groups bound the others, and more than the largest Gumbel that a draw can give.
EARLY, MOST = 32, 40.0
#: First bits of a piece's hash that lead to its place.
SLOT_BITS = 20


class Pieces:
    """Piece strings, weights and bytes of a SentencePiece model file."""

    def __init__(self, path: str, exponent: float = 1.0, shift: float = 2.7):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.names = [sp.id_to_piece(i) for i in range(n)]
        usable = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.byte = np.full(256, -1, np.int64)
        for i in range(n):
            if sp.is_byte(i):
                self.byte[int(self.names[i][3:-1], 16)] = i
        # the model's scores order the pieces: rank 0 is the best score
        order = sorted(usable, key=lambda i: (-sp.get_score(i), i))
        weight = -exponent * np.log(np.arange(len(order)) + shift)
        self.weight = dict(zip((self.names[i] for i in order), weight))
        self.id = {self.names[i]: i for i in usable}
        #: a byte piece weighs as much as the rarest piece
        self.byte_weight = float(weight[-1]) if len(order) else -10.0
        self.longest = max((len(self.names[i]) for i in usable), default=1)
        names = [self.names[i] for i in usable]
        h = np.array([_substring(*_prefix_hash(np.frombuffer(c.encode("utf-32-le"), np.uint32).astype(np.int64)), np.zeros(1, np.int64), len(c))[0]
                      for c in names], _U)
        sort = np.argsort(h)
        self.hashes, self.hash_id = h[sort], np.array(usable, np.int64)[sort]
        self.hash_weight = np.array([self.weight[names[i]] for i in sort])
        #: first place in ``hashes`` of the hashes that begin with these bits, or -1; and how many begin alike at most
        begin = (self.hashes >> _U(64 - SLOT_BITS)).astype(np.int64)
        self.slot = np.full(1 << SLOT_BITS, -1, np.int32)
        self.slot[begin[::-1]] = np.arange(len(begin), dtype=np.int32)[::-1]
        self.alike = int(np.unique(begin, return_counts=True)[1].max(initial=1))
        raw = [b"" if sp.is_control(i) or sp.is_unknown(i) else self.names[i].encode() for i in range(n)]
        for b, i in enumerate(self.byte):
            if i >= 0:
                raw[i] = bytes([b])
        self.sizes = np.array([len(r) for r in raw], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.solved = Solved(self)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are pieces', and their places in ``hashes``."""
        k = self.slot[(h >> _U(64 - SLOT_BITS)).astype(np.int64)]
        at = np.flatnonzero(k >= 0)
        k, h = k[at], h[at]
        hit, place = [], []
        for step in range(self.alike):
            here = np.minimum(k + step, len(self.hashes) - 1)
            same = self.hashes[here] == h
            hit.append(at[same])
            place.append(here[same])
        return np.concatenate(hit), np.concatenate(place)

    def decode(self, ids: np.ndarray) -> str:
        """The text of a piece sequence."""
        sizes = self.sizes[ids]
        begin = np.cumsum(sizes) - sizes
        at = np.repeat(self.first[ids] - begin, sizes) + np.arange(int(sizes.sum()))
        text = self.raw[at].tobytes().decode("utf-8", errors="replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


class Chunks:
    """Solved lattices of distinct chunks in flat arrays; nodes of a chunk are its character positions 1..n.

    All chunks advance together: substrings of one length are looked up by
    their rolling hash, and the forward filter runs over positions.
    """

    def __init__(self, pieces: Pieces, cps: np.ndarray, length: np.ndarray):
        self.pieces = pieces
        self.node0 = np.concatenate(([0], np.cumsum(length)))
        place = np.arange(len(cps)) - np.repeat(self.node0[:-1], length)
        left = np.repeat(length, length) - place
        start, size, piece, weight = self._edges(cps, left)
        node = start + size - 1  # global node a piece ends in
        order = np.lexsort((-size, node))
        start, size, piece, weight, node = (x[order] for x in (start, size, piece, weight, node))
        self.edge0 = np.searchsorted(node, np.arange(len(cps) + 1))
        alpha = np.zeros(len(cps) + 1)  # the last one serves starts at a chunk's beginning
        origin = np.where(place[start] == 0, len(cps), start - 1) if len(start) else start
        prob, upto, logs = np.empty(len(start)), np.empty(len(start)), np.empty(len(start))
        by_place = np.argsort(place.astype(np.uint16) if place.max(initial=0) < 1 << 16 else place, kind="stable")
        for nodes in np.split(by_place, np.flatnonzero(np.diff(place[by_place])) + 1):
            if not len(nodes):
                continue
            count = self.edge0[nodes + 1] - self.edge0[nodes]
            at = np.repeat(self.edge0[nodes], count) + _ranges(count)
            first = np.cumsum(count) - count
            v = weight[at] + alpha[origin[at]]
            top = np.maximum.reduceat(v, first)
            total = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, count)), first))
            alpha[nodes] = total
            logs[at] = v - np.repeat(total, count)
            p = np.exp(logs[at])
            running = np.cumsum(p)
            running -= np.repeat(running[first] - p[first], count)
            running = np.minimum(running, 1.0)
            running[first + count - 1] = 1.0
            prob[at], upto[at] = p, running
        self.size, self.piece, self.prob, self.upto = size.astype(np.int32), piece.astype(np.int32), prob, upto
        # sums of whole numbers are exact, so a text's sums do not depend on the texts beside it
        self.units = np.rint(logs * _UNIT).astype(np.int64)
        #: edges that are not their node's only one
        self.choice = np.repeat(np.diff(self.edge0) > 1, np.diff(self.edge0))

    def log_rest(self, edge: np.ndarray) -> np.ndarray:
        """Log probability of a node's other edges; minus infinity where there is none."""
        out = np.full(len(edge), -np.inf)
        some = np.flatnonzero(self.choice[edge])
        rest = 1.0 - self.prob[edge[some]]
        some, rest = some[rest > 1e-15], rest[rest > 1e-15]
        out[some] = np.log(rest)
        return out

    def _edges(self, cps: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, ...]:
        p = self.pieces
        prefix, down = _prefix_hash(cps)
        out = []
        for n in range(1, p.longest + 1):
            at = np.flatnonzero(left >= n)
            if not len(at):
                break
            hit, k = p.find(_substring(prefix, down, at, n))
            at = at[hit]
            out.append((at, np.full(len(at), n), p.hash_id[k], p.hash_weight[k]))
            if n == 1:
                bare = np.setdiff1d(np.arange(len(cps)), at, assume_unique=True)
                width = 1 + (cps[bare] > 0x7F) + (cps[bare] > 0x7FF) + (cps[bare] > 0xFFFF)
                out.append((bare, np.ones(len(bare), np.int64), -1 - cps[bare], p.byte_weight * width))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 4

    def arrays(self) -> tuple[np.ndarray, ...]:
        """First nodes, first edges, and the edges' characters, pieces, probabilities and running sums."""
        return self.node0, self.edge0, self.size, self.piece, self.prob, self.upto

    EDGES = ("size", "piece", "prob", "upto", "units", "choice")

    def join(self, more: "Chunks") -> None:
        """Put the chunks of ``more`` behind the own ones."""
        self.node0 = _appended(self.node0[:-1], more.node0 + self.node0[-1])
        self.edge0 = _appended(self.edge0[:-1], more.edge0 + self.edge0[-1])
        for c in self.EDGES:
            setattr(self, c, _appended(getattr(self, c), getattr(more, c)))

    def only(self, which: np.ndarray) -> None:
        """Drop all chunks but ``which`` (ascending numbers)."""
        nodes, first = np.diff(self.node0)[which], self.node0[which]
        at = np.repeat(first, nodes) + _ranges(nodes)
        edges = np.diff(self.edge0)[at]
        to = np.repeat(self.edge0[at], edges) + _ranges(edges)
        self.node0, self.edge0 = np.concatenate(([0], np.cumsum(nodes))), np.concatenate(([0], np.cumsum(edges)))
        for c in self.EDGES:
            setattr(self, c, getattr(self, c)[to])


def _appended(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``b`` behind ``a``, in the room behind ``a`` where there is some: a growing array is seldom copied."""
    n, room = len(a) + len(b), a.base
    if room is None or not isinstance(room, np.ndarray) or room.dtype != a.dtype or len(room) < n:
        room = np.empty(n + n // 2 + 1024, a.dtype)
        room[:len(a)] = a
    room[len(a):n] = b
    return room[:n]


class Solved:
    """Chunks solved so far by a worker, found by 64-bit hash.

    When they hold more than ``KEPT_EDGES`` edges, or half of that between tasks, those met in one batch only are
    dropped (all, where that is not enough); a text's samples do not depend on what is kept.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.forget()

    def forget(self) -> None:
        self.chunks = Chunks(self.pieces, np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.hashes, self.number, self.met = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def thin(self, most: int) -> None:
        """With more than ``most`` edges, keep what was met again, if that is no more than half of ``KEPT_EDGES``."""
        if len(self.chunks.size) <= most:
            return
        often = np.flatnonzero(self.met[np.argsort(self.number)] > 1)
        if np.diff(self.chunks.edge0[self.chunks.node0])[often].sum() > KEPT_EDGES // 2:
            self.forget()
        else:
            keep = np.isin(self.number, often)
            self.chunks.only(often)
            self.hashes, self.number, self.met = self.hashes[keep], np.searchsorted(often, self.number[keep]), self.met[keep] * 0 + 1

    def find(self, h: np.ndarray, cps: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers of the chunks with ascending hashes ``h`` at ``at`` in ``cps``; new ones are solved."""
        self.thin(KEPT_EDGES)
        k = np.searchsorted(self.hashes, h)
        new = np.flatnonzero(self.hashes[np.minimum(k, len(self.hashes) - 1)] != h) if len(self.hashes) else np.arange(len(h))
        if len(new):
            begin, length = at[new], size[new]
            self.chunks.join(Chunks(self.pieces, cps[np.repeat(begin, length) + _ranges(length)], length))
            count = len(self.number)
            self.hashes, self.number = np.insert(self.hashes, k[new], h[new]), np.insert(self.number, k[new], count + np.arange(len(new)))
            self.met = np.insert(self.met, k[new], 0)
            k = np.searchsorted(self.hashes, h)
        self.met[k] += 1
        return self.number[k]


def _prefix_hash(cps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = B.powers(_CP_BASE, len(cps) + 1)
    out = np.zeros(len(cps) + 1, _U)
    np.cumsum(B.mix(cps.astype(_U) + _U(77)) * up[:len(cps)], out=out[1:])
    return out, down


def _substring(prefix: np.ndarray, down: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    return B.mix((prefix[at + n] - prefix[at]) * down[at] + _U(n))


def _gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


def _source(key: np.ndarray, sample: int, what: int) -> np.ndarray:
    """A text's source of noise for one purpose."""
    return B.mix(key + _U(sample * 4 + what))


def _draw(source: np.ndarray, place: np.ndarray) -> np.ndarray:
    return B.uniform(B.mix(source + place.astype(_U) * _U(0x9E3779B97F4A7C15)))


def _noise(key: np.ndarray, sample: int, place: np.ndarray, what: int) -> np.ndarray:
    return _draw(_source(key, sample, what), place)


def _truncated(loc: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """A Gumbel at ``loc`` given that it is below ``bound``."""
    return -np.logaddexp(-bound, -(loc + _gumbel(u)))


class Search:
    """The k-best perturbed paths of a batch of texts, all texts advancing together.

    A path is a run of (chunk occurrence, node, edge) from a text's end to its
    beginning; the arrays of one round hold the paths' steps text by text.
    """

    def __init__(self, chunks: Chunks, occurrence: np.ndarray, first: np.ndarray, key: np.ndarray):
        self.node0, self.edge0, self.size, _, self.prob, self.cumulative = chunks.arrays()
        self.units, self.log_rest = chunks.units, chunks.log_rest
        self.occurrence, self.first, self.key = occurrence, first, key
        self.branched: dict[tuple[int, int, int], set[int]] = {}  # edges taken later out of (text, path, step)
        length = np.diff(self.node0)[occurrence]
        self.length = length
        self.position = np.cumsum(length) - length  # characters before each occurrence

    def descend(self, sample: int, text: np.ndarray, last: np.ndarray, node: np.ndarray):
        """Best children all the way: for each row, from ``node`` of occurrence ``last`` to the text's beginning.

        Returns (row, occurrence, node, edge) of every step, ordered by row and then from end to beginning.
        """
        rows, occ, at = [], [], []
        counts = last - self.first[text] + 1
        rows = np.repeat(np.arange(len(text)), counts)
        begin = np.cumsum(counts) - counts
        occ = np.repeat(last, counts) - (np.arange(int(counts.sum())) - np.repeat(begin, counts))
        at = self.length[occ].copy()
        at[begin[counts > 0]] = node[counts > 0]
        out = []
        turn = 0
        steps = np.zeros(len(at), np.int64)
        live = np.flatnonzero(at > 0)
        source, begins = _source(self.key[text], sample, 0), self.position[np.minimum(self.first[text], len(self.position) - 1)]
        while len(live):
            o, n = occ[live], at[live]
            graph = self.node0[self.occurrence[o]] + n - 1
            mine = rows[live]
            draw = _draw(source[mine], self.position[o] + n - begins[mine])
            # the first edge whose running sum reaches the draw; long pieces come first and are the likely ones
            edge = self.edge0[graph]
            behind = np.flatnonzero(self.cumulative[edge] < draw)
            while len(behind):
                edge[behind] += 1
                behind = behind[self.cumulative[edge[behind]] < draw[behind]]
            out.append((live, n, edge))
            steps[live] = turn + 1
            at[live] = n - self.size[edge]
            live = live[at[live] > 0]
            turn += 1
        if not out:
            z = np.zeros(0, np.int64)
            return z, z, z, z
        # the steps of a chunk stand together, in the order of the turns
        place = np.cumsum(steps) - steps
        node, edge = np.empty(int(steps.sum()), np.int64), np.empty(int(steps.sum()), np.int64)
        for turn, (live, n, e) in enumerate(out):
            node[place[live] + turn], edge[place[live] + turn] = n, e
        return np.repeat(rows, steps), np.repeat(occ, steps), node, edge

    def run(self, k: int):
        """Per sample: (texts, perturbed values, log probabilities, step offsets, edges); and the threshold per text."""
        self.k = k
        n_texts = len(self.first) - 1
        have = np.flatnonzero(np.diff(self.first) > 0)
        found, threshold = [], np.full(n_texts, -np.inf)
        # open groups of siblings: value, text, path number, step in the path
        opened = {c: [] for c in ("value", "text", "round", "step")}
        paths = []
        text = have
        value = _gumbel(B.uniform(B.mix(self.key[text] ^ _U(0x5851F42D4C957F2D))))
        last = self.first[text + 1] - 1
        row, occ, node, edge = self.descend(0, text, last, self.length[last])
        found.append(self._settle(0, text, value, np.zeros(len(text)), row, occ, node, edge, np.zeros(len(text), np.int64), None, opened, paths))
        for sample in range(1, k + 1):
            best = self._best(opened, n_texts)
            got = np.flatnonzero(best >= 0)
            if not len(got):
                break
            pick = best[got]
            flat = {c: np.concatenate(opened[c]) for c in opened}
            value = flat["value"][pick]
            if sample == k:
                threshold[got] = value
                break
            found.append(self._branch(sample, got, pick, flat, value, opened, paths))
        return found, threshold

    def _best(self, opened, n_texts):
        value, text = np.concatenate(opened["value"]), np.concatenate(opened["text"])
        best = np.full(n_texts, -1, np.int64)
        order = np.lexsort((value, text))
        order = order[value[order] > -np.inf]
        if len(order):
            t = text[order]
            end = np.flatnonzero(np.append(t[1:] != t[:-1], True))
            best[t[end]] = order[end]
        return best

    def _settle(self, sample, text, value, mass, row, occ, node, edge, kept, old, opened, paths):
        """Store complete paths (kept steps of an older path and the new steps) and open the new steps' siblings."""
        count = np.bincount(row, minlength=len(text))
        begin = np.cumsum(count) - count
        total = np.concatenate(([0], np.cumsum(self.units[edge])))
        # mass of the node a step starts from: what was fixed before it
        before = mass[row] + (total[:-1] - total[begin[row]]) / _UNIT
        # only the k largest sibling groups of a text can be among its next paths; the early steps bound them, and
        # a later group whose mass is too far below the bound for any Gumbel is not drawn
        step = np.arange(len(row)) - begin[row]
        source = _source(self.key[text], sample, 1)

        def drawn(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            loc = before[at] + self.log_rest(edge[at])
            at, loc = at[loc > -np.inf], loc[loc > -np.inf]
            mine = row[at]
            place = self.position[occ[at]] + node[at] - self.position[self.first[text]][mine]
            return at, _truncated(loc, value[mine], _draw(source[mine], place))
        at, g = drawn(np.flatnonzero(step < EARLY))
        top = _largest(g, row[at], self.k)
        bound = np.full(len(text), np.inf)
        np.minimum.at(bound, row[at[top]], g[top])
        bound[np.bincount(row[at[top]], minlength=len(text)) < self.k] = -np.inf
        late, more = drawn(np.flatnonzero((step >= EARLY) & (before + MOST > bound[row])))
        at, g = np.concatenate((at, late)), np.concatenate((g, more))
        top = _largest(g, row[at], self.k)
        pick, g = at[top], g[top]
        number = len(paths)
        steps = {"occ": occ, "node": node, "edge": edge, "before": before}
        if old is not None:  # the older path's steps up to the branch, then the new ones
            merged = {}
            new_count = count + kept
            offset = np.cumsum(new_count) - new_count
            for c in steps:
                whole = np.empty(int(new_count.sum()), steps[c].dtype)
                whole[np.repeat(offset, kept) + _ranges(kept)] = old[c]
                whole[np.repeat(offset + kept, count) + _ranges(count)] = steps[c]
                merged[c] = whole
            steps = merged
        else:
            new_count, offset = count, begin
        index = np.full(len(self.first) - 1, -1, np.int64)
        index[text] = np.arange(len(text))
        paths.append({"index": index, "offset": np.append(offset, new_count.sum()), **steps})
        opened["value"].append(g)
        opened["text"].append(text[row[pick]])
        opened["round"].append(np.full(len(pick), number))
        opened["step"].append(kept[row[pick]] + step[pick])
        final = mass + (total[begin + count] - total[begin]) / _UNIT
        return {"text": text, "value": value, "logp": final, "offset": paths[-1]["offset"], "occ": steps["occ"], "edge": steps["edge"], "node": steps["node"]}

    def _branch(self, sample, text, pick, flat, value, opened, paths):
        """Take one edge out of each picked sibling group, and go down from it."""
        kept = flat["step"][pick]
        which = flat["round"][pick]
        occ, node, before = (np.empty(len(text), t) for t in (np.int64, np.int64, np.float64))
        old = {c: [None] * len(text) for c in ("occ", "node", "edge", "before")}
        for number in np.unique(which):
            path = paths[number]
            mine = np.flatnonzero(which == number)
            at = path["offset"][path["index"][text[mine]]]
            occ[mine], node[mine], before[mine] = (path[c][at + kept[mine]] for c in ("occ", "node", "before"))
            for c in old:
                for r, a in zip(mine, at):
                    old[c][r] = path[c][a:a + kept[r]]
        old = {c: np.concatenate(v) if v else np.zeros(0) for c, v in old.items()}
        graph = self.node0[self.occurrence[occ]] + node - 1
        # the group's edges are those not taken from this node by an earlier path with the same steps before it
        chosen, rest = np.empty(len(text), np.int64), np.zeros(len(text))
        place = self.position[occ] + node - self.position[self.first[text]]
        u = _noise(self.key[text], sample, place, 2)
        for r in range(len(text)):
            a, b = self.edge0[graph[r]], self.edge0[graph[r] + 1]
            p = self.prob[a:b].copy()
            p[list(self.taken(paths, text[r], which[r], kept[r]))] = 0.0
            c = np.cumsum(p)
            e = min(int(np.searchsorted(c, u[r] * c[-1], side="right")), b - a - 1)
            while p[e] <= 0:
                e -= 1
            chosen[r] = a + e
            left = c[-1] - p[e]
            rest[r] = left if left > 1e-15 and (p > 0).sum() > 1 else 0.0
        for r in range(len(text)):
            self.branched.setdefault((text[r], which[r], kept[r]), set()).add(int(chosen[r] - self.edge0[graph[r]]))
        # the rest of the group stays open below the value just used
        with np.errstate(divide="ignore"):
            g = _truncated(before + np.log(rest), value, _noise(self.key[text], sample, place, 3))
        flat["value"][pick] = np.where(rest > 0, g, -np.inf)
        for c in opened:
            opened[c] = [flat[c]]
        # the chosen edge, then best children to the beginning
        logp = self.units[chosen] / _UNIT
        stop = node - self.size[chosen]
        last = np.where(stop > 0, occ, occ - 1)
        start = np.where(stop > 0, stop, np.where(last >= self.first[text], self.length[np.maximum(last, 0)], 0))
        row2, occ2, node2, edge2 = self.descend(sample, text, last, start)
        kept_all = kept + 1
        old_all = {}
        for c, extra in (("occ", occ), ("node", node), ("edge", chosen), ("before", before)):
            offset = np.cumsum(kept_all) - kept_all
            whole = np.empty(int(kept_all.sum()), old[c].dtype if len(old[c]) else np.asarray(extra).dtype)
            whole[np.repeat(offset, kept) + _ranges(kept)] = old[c]
            whole[offset + kept] = extra
            old_all[c] = whole
        return self._settle(sample, text, value, before + logp, row2, occ2, node2, edge2, kept_all, old_all, opened, paths)

    def taken(self, paths, text, number, step):
        """Edges of a sibling group that paths have taken: the group's own path's, and later ones."""
        first = paths[number]
        at = first["offset"][first["index"][text]] + step
        graph = self.node0[self.occurrence[first["occ"][at]]] + first["node"][at] - 1
        return {int(first["edge"][at] - self.edge0[graph])} | self.branched.get((text, number, step), set())


def _largest(value: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of each row's ``k`` largest values."""
    at = np.lexsort((-value, row))
    new = np.flatnonzero(np.append(True, row[at][1:] != row[at][:-1])) if len(at) else at
    return at[np.arange(len(at)) - np.repeat(new, np.diff(np.append(new, len(at)))) < k]


def _ranges(counts: np.ndarray) -> np.ndarray:
    begin = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - np.repeat(begin, counts)


def _ids(chunks: Chunks, found: dict) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of complete paths in reading order, and their offsets per text."""
    pieces = chunks.pieces
    edge = found["edge"]
    piece = chunks.arrays()[3][edge]
    count = np.diff(found["offset"])
    row = np.repeat(np.arange(len(count)), count)
    # steps run from end to beginning
    back = np.repeat(found["offset"][1:] - 1, count) - _ranges(count)
    piece = piece[back]
    raw = piece < 0
    if raw.any():
        width = np.ones(len(piece), np.int64)
        encoded = [chr(-1 - p).encode("utf-8", "replace") for p in piece[raw]]
        width[raw] = [len(e) for e in encoded]
        out = np.repeat(piece, width)
        out[np.repeat(raw, width)] = pieces.byte[np.frombuffer(b"".join(encoded), np.uint8)]
        total = np.bincount(row, width, len(count)).astype(np.int64)
        return out, np.concatenate(([0], np.cumsum(total)))
    return piece, found["offset"]


def sample_segmentations(pieces: Pieces, texts: list[str], keys: np.ndarray, k: int):
    """For every text its samples in the order drawn: (ids, log probability, perturbed value, log inclusion score)."""
    # every text that is not empty gets a mark in front; a chunk begins at a mark behind another character
    marked = [SPACE + t for t in texts if t]
    cps = np.frombuffer("".join(marked).replace(" ", SPACE).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    begins = np.concatenate(([0], np.cumsum([len(t) for t in marked]))).astype(np.int64)
    edge = np.zeros(len(cps) + 1, bool)
    edge[1:-1] = (cps[1:] == ord(SPACE)) & (cps[:-1] != ord(SPACE))
    edge[begins] = True
    edge = np.flatnonzero(edge)
    at, size = edge[:-1], np.diff(edge)
    prefix, down = _prefix_hash(cps)
    h, pick, back = np.unique(B.mix((prefix[edge[1:]] - prefix[at]) * down[at] + size.astype(_U)), return_index=True, return_inverse=True)
    first = np.zeros(len(texts) + 1, np.int64)
    first[1:][[bool(t) for t in texts]] = np.diff(np.searchsorted(at, begins))
    solved = pieces.solved
    occurrence = solved.find(h, cps, at[pick], size[pick])[back]
    chunks = solved.chunks
    out: list[list] = [[] for _ in texts]
    search = Search(chunks, occurrence, np.cumsum(first), keys)
    found, threshold = search.run(k)
    for f in found:
        ids, offset = _ids(chunks, f)
        for r, t in enumerate(f["text"]):
            logp, bound = f["logp"][r], threshold[t]
            # inclusion: the chance that this path's own Gumbel passes the threshold
            inclusion = 0.0 if bound == -np.inf else float(np.log(-np.expm1(-np.exp(logp - bound)))) if logp - bound > -30 else float(logp - bound)
            out[t].append((ids[offset[r]:offset[r + 1]], float(logp), float(f["value"][r]), min(inclusion, 0.0)))
    empty = np.zeros(0, np.int64)
    return [samples or [(empty, 0.0, 0.0, 0.0)] for samples in out]


@functools.lru_cache(4)
def load(path: str, exponent: float = 1.0, shift: float = 2.7) -> Pieces:
    """The model of a file, read once per worker."""
    return Pieces(path, exponent, shift)


def encode_samples(docs: DataFrame, model_path: str, k: int = 2, id_col: str = "doc_id", text_col: str = "text",
                   exponent: float = 1.0, shift: float = 2.7, seed: int = 0) -> DataFrame:
    """``k`` distinct sampled segmentations per row: id, sample, ids (little-endian uint32 pieces), n_pieces,
    log_prob, perturbed, log_inclusion, and whether decoding gives the text back."""
    ship(docs.sparkSession)

    def encode(batches):
        pieces = None
        for batch in batches:
            ids_in, key_in = batch.column("id"), batch.column("key").to_numpy().view(_U)
            texts = batch.column("text").to_pylist()
            i = 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (j == i or size + len(texts[j] or "") <= BATCH_CHARS):
                    size += len(texts[j] or "")
                    j += 1
                pieces = load(model_path, exponent, shift)
                rows = sample_segmentations(pieces, texts[i:j], key_in[i:j], k)
                take = np.repeat(np.arange(i, j), [len(r) for r in rows])
                flat = [(n, *s) for r in rows for n, s in enumerate(r)]
                good = [pieces.decode(s[1]) == (texts[t] or "") for t, s in zip(take, flat)]
                yield pa.RecordBatch.from_arrays([
                    ids_in.take(pa.array(take)), pa.array([s[0] for s in flat], pa.int32()), pa.array([s[1].astype("<u4").tobytes() for s in flat], pa.binary()),
                    pa.array([len(s[1]) for s in flat], pa.int64()), pa.array([s[2] for s in flat]), pa.array([s[3] for s in flat]),
                    pa.array([s[4] for s in flat]), pa.array(good)],
                    names=["id", "sample", "ids", "n_pieces", "log_prob", "perturbed", "log_inclusion", "round_trip"])
                i = j
        if pieces is not None:
            pieces.solved.thin(KEPT_EDGES // 2)

    kind = docs.schema[id_col].dataType.simpleString()
    df = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.lit(seed), F.col(id_col).cast("string")).alias("key"), F.col(text_col).cast("string").alias("text"))
    return df.mapInArrow(lean(encode), f"id {kind}, sample int, ids binary, n_pieces bigint, log_prob double, perturbed double, log_inclusion double, round_trip boolean") \
        .withColumnRenamed("id", id_col)


def decode_ids(df: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of its packed piece ids (null ids give null)."""
    ship(df.sparkSession)

    def decode(batches):
        for batch in batches:
            pieces = load(model_path)
            texts = [None if v is None else pieces.decode(np.frombuffer(v, "<u4").astype(np.int64)) for v in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text_col])

    return df.mapInArrow(decode, df.withColumn(text_col, F.lit("")).schema)
