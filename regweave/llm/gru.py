"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation.

Word ids 0 to ``CLASSES * MEMBERS - 1`` are dealt to classes of ``MEMBERS`` neighbours; the probability of a word is that of
its class times that of the word in its class.  Training and scoring run over lanes: each lane is a queue of whole
documents, the state goes on from window to window and starts afresh with each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Classes, words of a class, width of embeddings and state.
CLASSES, MEMBERS, WIDTH = 32, 64, 16
#: Ids with a fixed meaning: end of a document, any word outside the model's vocabulary.
END, RARE = 0, 1
#: Lanes and steps of a training window; lanes and steps of a scoring window; rate of learning.
LANES, STEPS, WIDE, LONG, RATE = 512, 16, 512, 24, 0.01

Model = dict[str, np.ndarray]


def fresh(logs: np.ndarray) -> Model:
    """A model that starts at the given natural log probabilities of the ids (the rest of the ids: never used)."""
    rng = np.random.default_rng(13)
    words = np.full(CLASSES * MEMBERS, -30.0)
    words[: len(logs)] = np.maximum(logs, -30.0)
    by = words.reshape(CLASSES, MEMBERS)
    top = by.max(axis=1)
    total = top + np.log(np.exp(by - top[:, None]).sum(axis=1))
    near = lambda *shape: rng.normal(0, WIDTH**-0.5, shape).astype(np.float32)
    return {
        "emb": near(CLASSES * MEMBERS, WIDTH), "wx": near(WIDTH, 3 * WIDTH), "wh": near(WIDTH, 3 * WIDTH), "b": np.zeros(3 * WIDTH, np.float32),
        "wc": np.zeros((WIDTH, CLASSES), np.float32), "bc": total.astype(np.float32),
        "ww": np.zeros((CLASSES, MEMBERS, WIDTH), np.float32), "bw": (by - total[:, None]).astype(np.float32),
    }


def flat(model: Model) -> np.ndarray:
    """All weights on one line, in the order of their names."""
    return np.concatenate([model[k].ravel() for k in sorted(model)])


def unflat(line: np.ndarray, like: Model) -> Model:
    """The weights of a line, in the shapes of ``like``."""
    out, at = {}, 0
    for k in sorted(like):
        out[k] = line[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _gate(x: np.ndarray) -> np.ndarray:
    """The logistic function, in place."""
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x += np.float32(1)
    x *= np.float32(0.5)
    return x


def _steps(model: Model, x: np.ndarray, fresh_at: np.ndarray, h: np.ndarray):
    """States after each step of a window, with what the way back needs: states before, gates, new parts, pulls.

    ``x``: steps x lanes x 3 width inputs; ``fresh_at``: steps x lanes, True where a document starts.
    """
    w, wh, (size, lanes, _) = WIDTH, model["wh"], x.shape
    states, before, new, pull = (np.empty((size, lanes, w), np.float32) for _ in range(4))
    gates = np.empty((size, lanes, 2 * w), np.float32)
    for t in range(size):
        np.multiply(h, ~fresh_at[t][:, None], out=before[t])
        u = before[t] @ wh
        pull[t] = u[:, 2 * w :]
        np.add(x[t][:, : 2 * w], u[:, : 2 * w], out=gates[t])
        zr = _gate(gates[t])
        n = new[t]
        np.multiply(zr[:, w:], pull[t], out=n)
        n += x[t][:, 2 * w :]
        np.tanh(n, out=n)
        h = states[t]
        np.subtract(before[t], n, out=h)
        h *= zr[:, :w]
        h += n
    return states, before, gates, new, pull


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Probabilities of each row, in place; logits above 60 count as 60 (they start below 0 and states stay within 1)."""
    np.exp(np.minimum(logits, np.float32(60), out=logits), out=logits)
    logits /= (logits @ np.ones((logits.shape[1], 1), np.float32) + np.float32(1e-30))
    return logits


def _picked(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log probability of one entry of each row."""
    np.minimum(logits, np.float32(60), out=logits)
    got = logits[np.arange(len(at)), at]
    np.exp(logits, out=logits)
    return got - np.log(logits @ np.ones(logits.shape[1], np.float32) + np.float32(1e-30))


def _by_class(ids: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Positions in order of their class, and (class, first, end) of each class that occurs."""
    kind = (ids // MEMBERS).astype(np.uint8)
    ends = np.cumsum(np.bincount(kind, minlength=CLASSES)).tolist()
    return np.argsort(kind, kind="stable"), [(c, lo, hi) for c, (lo, hi) in enumerate(zip([0, *ends], ends)) if hi > lo]


def _windows(line: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, ids to predict, in use) of each training window: the line of documents in equal lanes, side by side.

    A document that a lane's start cuts goes on there with a fresh state; a line shorter than a window has fewer lanes.
    """
    lanes = max(1, min(LANES, len(line) // STEPS))
    length = -(-len(line) // lanes)
    goal = np.zeros(lanes * length, np.int64)
    goal[: len(line)] = line
    used = np.arange(len(goal)).reshape(lanes, length).T < len(line)
    goal = goal.reshape(lanes, length).T
    given = np.concatenate([np.full((1, lanes), END), goal[:-1]])
    for at in range(0, length, STEPS):
        yield given[at : at + STEPS], goal[at : at + STEPS], used[at : at + STEPS]


def train(model: Model, line: np.ndarray, rate: float = RATE) -> Model:
    """The model after one pass over a line of documents, each ended by END.

    Adam; gradients are cut at the ends of windows, the state is carried on.
    """
    if not len(line):
        return model
    model = {k: v.copy() for k, v in model.items()}
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    w, h = WIDTH, None
    every, ones = np.arange(LANES * STEPS), np.ones(LANES * STEPS, np.float32)
    for turn, (given, goal, used) in enumerate(_windows(line), 1):
        shape, words = given.shape, given.ravel()
        h = np.zeros((shape[1], w), np.float32) if h is None else h
        e = model["emb"][words]
        x = (e @ model["wx"] + model["b"]).reshape(*shape, 3 * w)
        # END as the word before is the start of a document.
        starts = given == END
        states, before, gates, new, pull = _steps(model, x, starts, h)
        h = states[-1]
        live = np.flatnonzero(used.ravel())
        hs, ids = states.reshape(-1, w)[live], goal.ravel()[live]
        scale = np.float32(1 / len(live))
        grad = {k: np.zeros_like(v) for k, v in model.items()}
        p = _softmax(hs @ model["wc"] + model["bc"])
        p[np.arange(len(ids)), ids // MEMBERS] -= 1
        p *= scale
        grad["wc"], grad["bc"] = hs.T @ p, p.sum(axis=0)
        dl = p @ model["wc"].T
        rows, spans = _by_class(ids)
        ranked, own_id, pulls = hs[rows], ids[rows] % MEMBERS, np.empty_like(hs)
        for c, lo, hi in spans:
            own = ranked[lo:hi]
            q = own @ model["ww"][c].T
            q += model["bw"][c]
            _softmax(q)
            q[every[: hi - lo], own_id[lo:hi]] -= 1
            q *= scale
            np.matmul(q.T, own, out=grad["ww"][c])
            np.matmul(ones[: hi - lo], q, out=grad["bw"][c])
            np.matmul(q, model["ww"][c], out=pulls[lo:hi])
        dl[rows] += pulls
        dh = np.zeros((len(words), w), np.float32)
        dh[live] = dl
        dh = dh.reshape(*shape, w)
        z, r = gates[..., :w], gates[..., w:]
        by_new, by_z, by_r = (1 - z) * (1 - new * new), (before - new) * z * (1 - z), pull * r * (1 - r)
        dx, du = np.empty((*shape, 3 * w), np.float32), np.empty((*shape, 3 * w), np.float32)
        back, on, wht = np.zeros((shape[1], w), np.float32), ~starts[..., None], model["wh"].T.copy()
        for t in range(shape[0] - 1, -1, -1):
            back += dh[t]
            dn = back * by_new[t]
            np.multiply(back, by_z[t], out=du[t, :, :w])
            np.multiply(dn, by_r[t], out=du[t, :, w : 2 * w])
            np.multiply(dn, r[t], out=du[t, :, 2 * w :])
            dx[t, :, 2 * w :] = dn
            back *= z[t]
            back += du[t] @ wht
            back *= on[t]
        dx[..., : 2 * w] = du[..., : 2 * w]
        grad["wh"] = before.reshape(-1, w).T @ du.reshape(-1, 3 * w)
        dx = dx.reshape(-1, 3 * w)
        grad["wx"], grad["b"] = e.T @ dx, dx.sum(axis=0)
        de = dx @ model["wx"].T
        for k in range(w):
            grad["emb"][:, k] = np.bincount(words, weights=de[:, k], minlength=CLASSES * MEMBERS)
        size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        cut = np.float32(min(1.0, 1.0 / max(size, 1e-9)))
        step = np.float32(rate * np.sqrt(1 - 0.99**turn) / (1 - 0.9**turn))
        for k, g in grad.items():
            g *= cut
            first[k] += np.float32(0.1) * (g - first[k])
            g *= g
            second[k] += np.float32(0.01) * (g - second[k])
            np.sqrt(second[k], out=g)
            g += np.float32(1e-6)
            np.divide(first[k], g, out=g)
            g *= step
            model[k] -= g
    return model


def deal(texts: list[np.ndarray], lanes: int) -> list[list[int]]:
    """Documents of each lane: the longest first, each to the lane with the least so far."""
    from heapq import heapify, heapreplace

    lanes = max(1, min(lanes, len(texts)))
    loads, out = [(0, i) for i in range(lanes)], [[] for _ in range(lanes)]
    heapify(loads)
    for i in sorted(range(len(texts)), key=lambda i: (-len(texts[i]), i)):
        load, lane = loads[0]
        out[lane].append(i)
        heapreplace(loads, (load + len(texts[i]), lane))
    return out


class Scorer:
    """Natural log probabilities of whole documents."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.inputs = model["emb"] @ model["wx"] + model["b"]

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Log probability of each document's ids (END last)."""
        if not texts:
            return np.zeros(0)
        # The longest lanes first: those that have ended are left out of the later windows.
        dealt = sorted(deal(texts, WIDE), key=lambda lane: -sum(len(texts[i]) for i in lane))
        ordered = [i for lane in dealt for i in lane]
        line = np.concatenate([texts[i] for i in ordered])
        owner = np.repeat(ordered, [len(texts[i]) for i in ordered])
        sizes = np.array([sum(len(texts[i]) for i in lane) for lane in dealt])
        first = np.cumsum(sizes) - sizes
        out = np.zeros(len(texts))
        model, h = self.model, np.zeros((len(sizes), WIDTH), np.float32)
        before = np.full(len(sizes), END)
        for at in range(0, int(sizes[0]), LONG):
            n = int((sizes > at).sum())
            step = np.arange(at, min(at + LONG, int(sizes[0])))[:, None]
            here = np.minimum(first[:n] + step, len(line) - 1)
            goal, on = line[here], step < sizes[:n]
            given = np.concatenate([before[None, :n], goal[:-1]])
            before = goal[-1]
            states = _steps(model, self.inputs[given], given == END, h[:n])[0]
            h = states[-1]
            live = np.flatnonzero(on.ravel())
            hs, ids = states.reshape(-1, WIDTH)[live], goal.ravel()[live]
            logs = _picked(hs @ model["wc"] + model["bc"], ids // MEMBERS).astype(np.float64)
            rows, spans = _by_class(ids)
            ranked, own_id, inside = hs[rows], ids[rows] % MEMBERS, np.empty(len(rows))
            for c, lo, hi in spans:
                inside[lo:hi] = _picked(ranked[lo:hi] @ model["ww"][c].T + model["bw"][c], own_id[lo:hi])
            logs[rows] += inside
            out += np.bincount(owner[here.ravel()[live]], weights=logs, minlength=len(texts))
        return out
