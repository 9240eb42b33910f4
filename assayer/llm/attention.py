"""A small causal self-attention model of token ids, trained and applied in numpy.

One block: token and place embeddings, one attention head with a causal mask, a feed-forward layer, both
with residual connections. The output has two levels: a softmax over ``CLASSES`` classes of ids and one over the
``MEMBERS`` ids of the class. Ids too rare for a class of their own share the last class, within which an id has
its share of the corpus counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np

WIDTH = 16
HIDDEN = 32
WINDOW = 16
OVERLAP = 3
CLASSES = 64
MEMBERS = 40
BATCH = 128
ROWS = 2048  # positions whose classes are weighed at once, to stay in a core's cache
STEPS = 2500
ROUNDS = 10  # after each, the weights of all shards are averaged
RATE = 1e-2
SEED = 5
OWN = (CLASSES - 1) * MEMBERS  # ids that are members of a class
SCALE = np.repeat(np.array([WIDTH**-0.5, 1, 1], np.float32), WIDTH)  # of queries, keys and values
LINE = 64  # bytes of a line of the cache


def id_ranks(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of every id by corpus count, and its log share among the ids of the last class (0 for others)."""
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    weight = np.where(rank >= OWN, counts + 0.5, 0)
    shares = np.log(np.where(weight > 0, weight / max(weight.sum(), 0.5), 1.0))
    return rank, shares


def by_class(classes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order that puts positions of one class together, and each class's part of it but the last's."""
    order = np.argsort(classes.astype(np.uint8), kind="stable")
    edges = np.searchsorted(classes[order], np.arange(CLASSES))
    return order, [(c, slice(edges[c], edges[c + 1])) for c in range(CLASSES - 1) if edges[c] < edges[c + 1]]


def pieces(start: int, stop: int) -> Iterator[slice]:
    return (slice(i, min(i + ROWS, stop)) for i in range(start, stop, ROWS))


def log_softmax_at(logits: np.ndarray, pick: np.ndarray) -> np.ndarray:
    if len(logits) and logits.max() > 60:
        logits -= logits.max(axis=1, keepdims=True)
    own = logits[np.arange(len(logits)), pick]
    np.exp(logits, out=logits)
    return own - np.log(logits @ np.ones(logits.shape[1], logits.dtype))


class Room:
    """Arrays by name that are used again: new ones of a step's size would each be taken from the system, page by page."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, shape: tuple[int, ...], dtype=np.float32) -> np.ndarray:
        size, kept = math.prod(shape), self.held.get(name)
        if kept is None or kept.size < size or kept.dtype != dtype:
            room = np.empty(size + 2 * LINE, dtype)
            skip = -room.ctypes.data % LINE // room.itemsize
            kept = self.held[name] = room[skip : skip + size]
        return kept[:size].reshape(shape)


def summed_rows(place: np.ndarray, rows: np.ndarray, size: int, room: Room | None = None) -> np.ndarray:
    """``size`` rows, of which each is the sum of those ``rows`` that have its number as their place."""
    room = room or Room()
    out, order = room("summed", (size, rows.shape[1]), rows.dtype), np.argsort(place.astype(np.uint16), kind="stable")
    out.fill(0)
    placed = place[order]
    first = np.flatnonzero(np.r_[True, placed[1:] != placed[:-1]][: len(placed)])
    if len(first):
        near = np.take(rows, order, axis=0, out=room("near", rows.shape, rows.dtype), mode="clip")
        out[placed[first]] = np.add.reduceat(near, first, axis=0)
    return out


def softmax_errors(logits: np.ndarray, pick: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Gradient by the logits, which it overwrites, of each row's negative log softmax at its ``pick``, times its weight."""
    if len(logits) and max(logits.max(), -logits.min()) > 60:
        logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits, out=logits)
    p *= (weight / (p @ np.ones(p.shape[1], p.dtype)))[:, None]
    p[np.arange(len(p)), pick] -= weight
    return p


class Attention:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        shapes = {
            "tokens": (2 + OWN, WIDTH), "places": (WINDOW, WIDTH), "qkv": (WIDTH, 3 * WIDTH), "mix": (WIDTH, WIDTH),
            "up": (WIDTH, HIDDEN), "down": (HIDDEN, WIDTH), "out": (WIDTH, CLASSES), "within": (CLASSES, WIDTH, MEMBERS),
        }
        self.w = {name: rng.standard_normal(s).astype(np.float32) / np.float32(np.sqrt(WIDTH)) for name, s in shapes.items()}
        self.w["within"] *= np.float32(0.1)
        self.w["bias"] = np.zeros(CLASSES, np.float32)
        self.w["inner"] = np.zeros((CLASSES, MEMBERS), np.float32)
        self.first, self.second = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        self.room = Room()
        self.most = np.where(np.tri(WINDOW, dtype=bool), np.float32(30), np.float32(-30))  # later places get no weight

    def hidden(self, inputs: np.ndarray, top: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """What the block makes of each position; all but ``top`` (into the array given, if any) is overwritten by the next call."""
        w, n, size, kind = self.w, len(inputs), inputs.size, self.w["tokens"].dtype
        room = lambda name, *shape: self.room(name, shape, kind)
        x = np.take(w["tokens"], inputs, axis=0, out=room("x", n, WINDOW, WIDTH), mode="clip")
        x += w["places"]
        qkv = np.matmul(x.reshape(-1, WIDTH), w["qkv"] * SCALE, out=room("qkv", size, 3 * WIDTH))
        q, k, v = np.split(qkv.reshape(n, WINDOW, 3 * WIDTH), 3, axis=2)
        a = np.matmul(q, k.transpose(0, 2, 1), out=room("a", n, WINDOW, WINDOW))
        np.minimum(a, self.most, out=a)
        np.exp(a, out=a)
        a /= (a.reshape(-1, WINDOW) @ np.ones(WINDOW, a.dtype)).reshape(n, WINDOW, 1)
        seen = np.matmul(a, v, out=room("seen", n, WINDOW, WIDTH))
        h = np.matmul(seen.reshape(-1, WIDTH), w["mix"], out=room("h", size, WIDTH))
        h += x.reshape(-1, WIDTH)
        up = np.matmul(h, w["up"], out=room("up", size, HIDDEN))
        np.maximum(up, 0, out=up)
        top = np.matmul(up, w["down"], out=top)
        top += h
        return {"x": x, "q": q, "k": k, "v": v, "a": a, "seen": seen, "h": h, "up": up, "top": top}

    def log_shares(self, top: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Natural log probability of the id of each rank; of the whole last class for rarer ids."""
        w, kind, classes = self.w, top.dtype, np.minimum(rank // MEMBERS, CLASSES - 1)
        out = np.empty(len(top), kind)
        for part in pieces(0, len(top)):
            logits = np.matmul(top[part], w["out"], out=self.room("logits", (part.stop - part.start, CLASSES), kind))
            logits += w["bias"]
            out[part] = log_softmax_at(logits, classes[part])
        order, groups = by_class(classes)
        top, member = np.take(top, order, axis=0, out=self.room("sorted", top.shape, kind), mode="clip"), rank[order] % MEMBERS
        inner = np.zeros(len(order), np.float32)
        for c, part in ((c, part) for c, all_of in groups for part in pieces(all_of.start, all_of.stop)):
            logits = np.matmul(top[part], w["within"][c], out=self.room("logits", (part.stop - part.start, MEMBERS), kind))
            logits += w["inner"][c]
            inner[part] = log_softmax_at(logits, member[part])
        out[order] += inner
        return out

    def gradients(self, inputs: np.ndarray, rank: np.ndarray, counted: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean negative log probability; the next call overwrites them."""
        w, n, size, kind = self.w, len(inputs), inputs.size, self.w["tokens"].dtype
        room = lambda name, *shape: self.room(name, shape, kind)
        s = self.hidden(inputs, room("top", size, WIDTH))
        rank, weight = rank.ravel(), (counted.ravel() / max(1, counted.sum())).astype(np.float32)
        classes = np.minimum(rank // MEMBERS, CLASSES - 1)
        g = {"out": np.zeros_like(w["out"]), "bias": np.zeros_like(w["bias"])}
        d_top = room("d_top", size, WIDTH)
        for part in pieces(0, size):
            top = s["top"][part]
            logits = np.matmul(top, w["out"], out=room("logits", len(top), CLASSES))
            logits += w["bias"]
            p = softmax_errors(logits, classes[part], weight[part])
            g["out"] += top.T @ p
            g["bias"] += np.ones(len(top), kind) @ p
            np.matmul(p, w["out"].T, out=d_top[part])
        g["within"], g["inner"] = room("d_within", *w["within"].shape), np.zeros_like(w["inner"])
        g["within"].fill(0)
        # Positions lie by class, so that all but the products is done for all classes at once; the last class stays 0.
        order, groups = by_class(classes)
        order = order[: groups[-1][1].stop if groups else 0]
        top = np.take(s["top"], order, axis=0, out=room("sorted", len(order), WIDTH), mode="clip")
        q = room("members", len(order), MEMBERS)
        for c, part in groups:
            np.add(np.dot(top[part], w["within"][c], out=q[part]), w["inner"][c], out=q[part])
        q = softmax_errors(q, rank[order] % MEMBERS, weight[order])
        d_inside = room("d_inside", len(order), WIDTH)
        for c, part in groups:
            np.dot(top[part].T, q[part], out=g["within"][c])
            np.dot(q[part], w["within"][c].T, out=d_inside[part])
        if groups:
            g["inner"][[c for c, _ in groups]] = np.add.reduceat(q, [part.start for _, part in groups], axis=0)
        d_inside += np.take(d_top, order, axis=0, out=top, mode="clip")
        d_top[order] = d_inside
        g["down"] = s["up"].T @ d_top
        d_up = np.matmul(d_top, w["down"].T, out=room("d_up", size, HIDDEN))
        d_up *= s["up"] > 0
        g["up"] = s["h"].T @ d_up
        d_h = np.matmul(d_up, w["up"].T, out=room("d_h", size, WIDTH))
        d_h += d_top
        g["mix"] = s["seen"].reshape(-1, WIDTH).T @ d_h
        d_seen = np.matmul(d_h, w["mix"].T, out=room("d_seen", size, WIDTH)).reshape(n, WINDOW, WIDTH)
        d_qkv = room("d_qkv", size, 3 * WIDTH)
        d_q, d_k, d_v = np.split(d_qkv.reshape(n, WINDOW, 3 * WIDTH), 3, axis=2)
        np.matmul(s["a"].transpose(0, 2, 1), d_seen, out=d_v)
        d_s = np.matmul(d_seen, s["v"].transpose(0, 2, 1), out=room("d_s", n, WINDOW, WINDOW))
        d_s *= s["a"]
        s["a"] *= (d_s.reshape(-1, WINDOW) @ np.ones(WINDOW, kind)).reshape(n, WINDOW, 1)
        d_s -= s["a"]
        np.matmul(d_s, s["k"], out=d_q)
        np.matmul(d_s.transpose(0, 2, 1), s["q"], out=d_k)
        g["qkv"] = (s["x"].reshape(-1, WIDTH).T @ d_qkv) * SCALE
        d_x = np.matmul(d_qkv, (w["qkv"] * SCALE).T, out=room("d_x", size, WIDTH))
        d_x += d_h
        g["places"] = d_x.reshape(n, WINDOW, WIDTH).sum(axis=0)
        g["tokens"] = summed_rows(inputs.ravel(), d_x, 2 + OWN, self.room)
        return g

    def begin(self, counts: np.ndarray) -> Attention:
        """Start from the ids' shares of the corpus; ``counts`` are those of the ids by rank."""
        share = np.r_[counts, np.zeros(OWN)][:OWN] + 0.3
        inside = share.reshape(-1, MEMBERS)
        total = np.r_[inside.sum(axis=1), counts[OWN:].sum() + 0.3]
        self.w["bias"] = np.log(total / total.sum()).astype(np.float32)
        self.w["inner"][:-1] = np.log(inside / inside.sum(axis=1, keepdims=True))
        return self

    def state(self) -> np.ndarray:
        """Weights and the moments of their gradients, laid end to end."""
        return np.concatenate([part[k].ravel() for part in (self.w, self.first, self.second) for k in sorted(part)])

    def load(self, state: np.ndarray) -> Attention:
        at = 0
        for part in (self.w, self.first, self.second):
            for k in sorted(part):
                part[k] = state[at : at + part[k].size].reshape(part[k].shape).astype(np.float32)
                at += part[k].size
        return self

    def fit(self, inputs, rank, counted, done: int = 0, steps: int = STEPS, seed: int = SEED, over: int = STEPS) -> Attention:
        """``steps`` further steps of Adam, after ``done`` of ``STEPS``, on batches of windows; the rate falls linearly.

        The moments are kept as sums, 10 and 100 times Adam's means, which takes fewer passes over them.

        In every ``over`` steps each window is visited once at least: batches follow shuffled passes over all windows and
        are larger than ``BATCH`` where so many steps of it would not reach them all.
        """
        if not len(inputs):
            return self
        size = max(BATCH, -(-len(inputs) // over))
        batches = visited(len(inputs), size, done % over * size, (seed, done // over))
        for step, rows in zip(range(done + 1, done + steps + 1), batches):
            rate = RATE * (1 - (step - 1) / STEPS) * min(1.0, step / 50)
            near, far = 1 - 0.9**step, 1 - 0.99**step
            damp, pace = np.float32(1e-7 * far**0.5), np.float32(rate * far**0.5 / near)
            for name, g in self.gradients(inputs[rows], rank[rows], counted[rows]).items():
                first, second = self.first[name], self.second[name]
                first *= np.float32(0.9)
                first += g
                g *= g
                second *= np.float32(0.99)
                second += g
                np.sqrt(second, out=g)
                g += damp
                np.divide(first, g, out=g)
                g *= pace
                self.w[name] -= g
        return self


def visited(n: int, size: int, at: int, seed: tuple[int, int]) -> Iterator[np.ndarray]:
    """Batches of ``size`` numbers below ``n`` from place ``at`` of an endless row of shuffled passes over all."""
    nth, order = -1, None
    while True:
        rows, lacking = [], size
        while lacking:
            if at // n != nth:
                nth = at // n
                order = np.random.default_rng((*seed, nth)).permutation(n)
            rows.append(order[at % n : at % n + lacking])
            at += len(rows[-1])
            lacking -= len(rows[-1])
        yield np.concatenate(rows)


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, owner, fresh`` of the windows over texts of these lengths, laid end to end.

    A text's windows follow each other by ``WINDOW - OVERLAP``; of each, the positions from ``fresh`` on are
    counted, so each position is counted once and, but for a text's first ones, with ``OVERLAP`` before it.
    """
    step = WINDOW - OVERLAP
    counts = 1 + np.maximum(0, -(-(lengths - WINDOW) // step))
    counts[lengths == 0] = 0
    owner = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = (np.cumsum(lengths) - lengths)[owner] + nth * step
    return start, owner, np.where(nth > 0, OVERLAP, 0)
