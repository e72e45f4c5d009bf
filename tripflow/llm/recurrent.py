"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation, state carried from window to window."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN = 16
#: The most frequent words have weights of their own, in classes of CLASS_WORDS; the next ones share classes by rank, and the rest is one class.
FINE_WORDS = 2048
CLASS_WORDS = 64
BINS = 15
WINDOW = 32
LANES = 512
TRAIN_LANES = 256
RATE = 0.05
END = b"\n"  # no word has white space


@dataclass
class Vocabulary:
    """Known frequent words. ``counts`` falls; all other words are the last class, known by their total count and number alone."""

    words: list[bytes]
    counts: np.ndarray
    rest_tokens: int
    rest_words: int

    def __post_init__(self) -> None:
        n = len(self.words)
        self.fine = min(FINE_WORDS, n)
        self.fine_classes = -(-self.fine // CLASS_WORDS)
        rank = np.arange(n)
        edges = np.geomspace(max(self.fine, 1), max(n, self.fine + 1) + 1, BINS + 1)[1:-1]
        coarse = self.fine_classes + np.searchsorted(edges, rank, side="right")
        self.classes = self.fine_classes + BINS + 1
        self.cls = np.append(np.where(rank < self.fine, rank // CLASS_WORDS, coarse), self.classes - 1)
        self.slot = np.append(np.where(rank < self.fine, rank % CLASS_WORDS, -1), -1)
        self.inputs = self.fine + self.classes
        self.input = np.append(np.where(rank < self.fine, rank, self.fine + self.cls[:-1]), self.inputs - 1)
        weight = self.counts + 0.5
        mass = np.bincount(self.cls[:-1], weight, minlength=self.classes)
        # Within a coarse class a word has its smoothed share; the last class shares its own mass with one unknown word.
        self.share = np.append(np.where(rank < self.fine, 0.0, np.log(weight / mass[self.cls[:-1]])), 0.0)
        self.rest_mass = self.rest_tokens + 0.5 * (self.rest_words + 1)
        mass[-1] = self.rest_mass
        self.class_mass, self.weight = mass, weight
        self.number = {word: k for k, word in enumerate(self.words)}
        self.rest = n
        self.end = self.number.get(END, n)


def initial(vocabulary: Vocabulary, seed: int = 1) -> dict[str, np.ndarray]:
    """Small random weights; the biases make the untrained model the smoothed unigram model."""
    v, draw = vocabulary, np.random.default_rng(seed)
    inside = np.full((v.fine_classes, CLASS_WORDS), -30.0)
    fine = np.arange(v.fine)
    inside[fine // CLASS_WORDS, fine % CLASS_WORDS] = np.log(v.weight[: v.fine])
    mass = np.where(v.class_mass > 0, np.log(np.maximum(v.class_mass, 1e-9)), -30.0)
    shapes = {
        "x": (v.inputs, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "wc": (HIDDEN, v.classes), "wi": (v.fine_classes, HIDDEN, CLASS_WORDS),
    }
    made = {name: draw.normal(0, 0.1, shape).astype(np.float32) for name, shape in shapes.items()}
    made["wc"] *= 0.1
    made["wi"] *= 0.1
    made["x"][:, HIDDEN : 2 * HIDDEN] -= 1.0  # update gates start nearly closed: the state remembers
    return made | {"bc": mass.astype(np.float32), "bi": inside.astype(np.float32)}


def _lowered(w: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Biases less a bound of all logits, and whether every row of logits then has one above -60. States lie between -1 and 1."""
    reach = np.abs(w).sum(axis=-2)
    return b - (b + reach).max(axis=-1, keepdims=True), 2 * reach.max(axis=-1) <= 60


def _logits(states: np.ndarray, w: np.ndarray, b: np.ndarray, bounded: bool) -> np.ndarray:
    """Logits whose exponentials neither overflow nor vanish all; ``b`` and ``bounded`` are those of ``_lowered``."""
    a = states @ w
    a += b
    if not bounded:
        a -= a.max(axis=-1, keepdims=True)
    return a


def _sums(a: np.ndarray) -> np.ndarray:
    """Sums of short rows: a product is faster than a reduction."""
    return a @ np.ones(a.shape[-1], a.dtype)


def _softmax(a: np.ndarray) -> np.ndarray:
    np.exp(a, out=a)
    a *= (1 / _sums(a))[:, None]
    return a


def _log_chosen(a: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The log softmax at one place of each row."""
    at = a[np.arange(len(a)), chosen]
    np.exp(a, out=a)
    return at - np.log(_sums(a))


class Lanes:
    """Documents laid end to end in lanes, the longest first, so that all lanes advance together. ``tokens`` end with the end token each."""

    def __init__(self, vocabulary: Vocabulary, documents: list[np.ndarray], lanes: int = LANES) -> None:
        sizes = np.array([len(d) for d in documents], np.int64)
        order = np.argsort(-sizes, kind="stable")
        loads = np.zeros(min(lanes, len(documents)), np.int64)
        lane = np.empty(len(documents), np.int64)
        for k in order:
            lane[k] = loads.argmin()
            loads[lane[k]] += sizes[k]
        rank = np.empty(len(loads), np.int64)
        rank[np.argsort(-loads, kind="stable")] = np.arange(len(loads))
        placed = np.lexsort((np.arange(len(documents)), rank[lane]))
        self.tokens = np.concatenate([documents[k] for k in placed])
        self.document = np.repeat(placed, sizes[placed])
        self.first = np.zeros(len(self.tokens), bool)
        self.first[np.cumsum(sizes[placed]) - sizes[placed]] = True
        previous = np.where(self.first, vocabulary.end, np.roll(self.tokens, 1))
        self.input = vocabulary.input[previous]
        self.length = -np.sort(-loads)
        self.start = np.cumsum(self.length) - self.length

    def windows(self, steps: int):
        """Flat places (step, lane) of each window's tokens, and which of them exist. Lanes that have ended are left out."""
        for at in range(0, int(self.length[0]), steps):
            n = int(np.searchsorted(-self.length, -at, side="left"))
            step = at + np.arange(steps)[:, None]
            there = step < self.length[None, :n]
            yield np.where(there, self.start[None, :n] + step, 0), there


def _states(p: dict[str, np.ndarray], h: np.ndarray, inputs: np.ndarray, first: np.ndarray, keep: bool) -> tuple[np.ndarray, tuple]:
    """Hidden states before each token's prediction, window long, from the state carried in. Inside, and in what is kept, lanes come last, so that gates are
    whole blocks of memory."""
    steps, lanes = inputs.shape
    out = np.empty((steps, HIDDEN, lanes), p["u"].dtype)
    x = np.ascontiguousarray(p["x"][inputs].transpose(0, 2, 1))  # becomes the gates and the candidate
    u, going = np.ascontiguousarray(p["u"].T), (~first).astype(out.dtype)
    before, inner = (np.empty_like(out), np.empty_like(out)) if keep else (out, out)
    h = np.ascontiguousarray(h.T)
    for t in range(steps):
        h = h * going[t]
        g = u @ h
        gates, c = x[t, : 2 * HIDDEN], x[t, 2 * HIDDEN :]
        gates += g[: 2 * HIDDEN]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        c += gates[:HIDDEN] * g[2 * HIDDEN :]
        np.tanh(c, out=c)
        if keep:
            before[t], inner[t] = h, g[2 * HIDDEN :]
        h = np.add(h, gates[HIDDEN:] * (c - h), out=out[t])
    return out.transpose(0, 2, 1), (before, inner, x, going)


def _by_class(cls: np.ndarray, fine_classes: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(cls.astype(np.int16), kind="stable")  # short integers are sorted by their digits; there are few classes
    return order, np.searchsorted(cls[order], np.arange(fine_classes + 1))


def window_score(p: dict[str, np.ndarray], v: Vocabulary, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Natural log probabilities of tokens given their states; of words of the last class, that of the class."""
    cls = v.cls[tokens]
    score = _log_chosen(_logits(states, p["wc"], *_lowered(p["wc"], p["bc"])), cls).astype(np.float64) + v.share[tokens]
    order, edges = _by_class(cls, v.fine_classes)
    order = order[: edges[-1]]
    states, slot, inside = states[order], v.slot[tokens[order]], np.empty(len(order))
    biases, bounded = _lowered(p["wi"], p["bi"])
    for k in range(v.fine_classes):
        rows = slice(edges[k], edges[k + 1])
        if edges[k] < edges[k + 1]:
            inside[rows] = _log_chosen(_logits(states[rows], p["wi"][k], biases[k], bounded[k]), slot[rows])
    score[order] += inside
    return score


def score(p: dict[str, np.ndarray], v: Vocabulary, documents: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each whole document; the state runs on through all of its windows."""
    lanes, sums = Lanes(v, documents), np.zeros(len(documents))
    h = np.zeros((len(lanes.length), HIDDEN), np.float32)
    for places, there in lanes.windows(WINDOW):
        h = h[: places.shape[1]]
        states, _ = _states(p, h, lanes.input[places], lanes.first[places], keep=False)
        h = states[-1]
        flat = places[there]
        sums += np.bincount(lanes.document[flat], window_score(p, v, states[there], lanes.tokens[flat]), minlength=len(sums))
    return sums


def gradients(
    p: dict[str, np.ndarray], v: Vocabulary, h: np.ndarray, inputs: np.ndarray, first: np.ndarray, tokens: np.ndarray, there: np.ndarray
) -> tuple[float, dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Loss and gradients, per token, of one window (backpropagation ends at its first step), the inputs with gradients, and the last state."""
    states, (before, inner, x, going) = _states(p, h, inputs, first, keep=True)
    flat, target = states[there], tokens[there]
    cls, n = v.cls[target], len(target)
    soft = _softmax(_logits(flat, p["wc"], *_lowered(p["wc"], p["bc"])))
    loss = -float(np.log(soft[np.arange(n), cls]).sum())
    soft[np.arange(n), cls] -= 1
    grads = {"wc": flat.T @ soft, "bc": soft.sum(axis=0), "wi": np.zeros_like(p["wi"]), "bi": np.zeros_like(p["bi"])}
    back = soft @ p["wc"].T
    order, edges = _by_class(cls, v.fine_classes)
    order = order[: edges[-1]]
    inside, slot, more = flat[order], v.slot[target[order]], np.empty((len(order), HIDDEN), flat.dtype)
    biases, bounded = _lowered(p["wi"], p["bi"])
    for k in range(v.fine_classes):
        rows = slice(edges[k], edges[k + 1])
        if edges[k] < edges[k + 1]:
            soft = _softmax(_logits(inside[rows], p["wi"][k], biases[k], bounded[k]))
            at = np.arange(len(soft)), slot[rows]
            loss -= float(np.log(soft[at]).sum())
            soft[at] -= 1
            grads["wi"][k], grads["bi"][k] = inside[rows].T @ soft, soft.sum(axis=0)
            more[rows] = soft @ p["wi"][k].T
    back[order] += more
    outer = np.zeros((*inputs.shape, HIDDEN), flat.dtype)
    outer[there] = back
    outer = np.ascontiguousarray(outer.transpose(0, 2, 1))
    # What the loss's derivative by a state is multiplied by on its way to the candidate, the update gate and the reset gate.
    r, z, c = x[:, :HIDDEN], x[:, HIDDEN : 2 * HIDDEN], x[:, 2 * HIDDEN :]
    held = 1 - z
    to_c, to_z, to_r = z * (1 - c * c), (c - before) * z * held, inner * r * (1 - r)
    dx, dg = np.empty_like(x), np.empty_like(x)
    dh = np.zeros_like(outer[0])
    for t in reversed(range(len(inputs))):
        dh = dh + outer[t]
        da = np.multiply(dh, to_c[t], out=dx[t, 2 * HIDDEN :])
        np.multiply(da, to_r[t], out=dx[t, :HIDDEN])
        np.multiply(dh, to_z[t], out=dx[t, HIDDEN : 2 * HIDDEN])
        dg[t, : 2 * HIDDEN] = dx[t, : 2 * HIDDEN]
        np.multiply(da, r[t], out=dg[t, 2 * HIDDEN :])
        dh *= held[t]
        dh += p["u"] @ dg[t]
        dh *= going[t]
    grads["u"] = before.transpose(1, 0, 2).reshape(HIDDEN, -1) @ dg.transpose(0, 2, 1).reshape(-1, 3 * HIDDEN)
    # Sums of the gradients of equal inputs.
    ids = inputs.ravel()
    order = np.argsort(ids.astype(np.int16), kind="stable")  # at most FINE_WORDS and the classes
    ids = ids[order]
    at = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    seen = ids[at]
    grads["x"] = np.add.reduceat(dx.transpose(0, 2, 1).reshape(-1, 3 * HIDDEN)[order], at, axis=0)
    return loss / n, {k: a / n for k, a in grads.items()}, seen, states[-1]


class Trainer:
    """Adagrad over windows."""

    def __init__(self, p: dict[str, np.ndarray], v: Vocabulary) -> None:
        self.p, self.v = {k: a.copy() for k, a in p.items()}, v
        self.squares = {k: np.full_like(a, 1e-8) for k, a in p.items()}
        self.tokens = 0

    def learn(self, documents: list[np.ndarray]) -> None:
        lanes = Lanes(self.v, documents, TRAIN_LANES)
        h = np.zeros((len(lanes.length), HIDDEN), np.float32)
        for places, there in lanes.windows(WINDOW):
            h = h[: places.shape[1]]
            _, grads, seen, h = gradients(
                self.p, self.v, h, lanes.input[places], lanes.first[places], lanes.tokens[places], there
            )
            rate = RATE * min(1.0, there.sum() / (WINDOW * TRAIN_LANES)) ** 0.5  # few tokens are a noisy sample: a shorter step
            for name, g in grads.items():
                where = seen if name == "x" else slice(None)
                self.squares[name][where] += g * g
                self.p[name][where] -= rate * g / np.sqrt(self.squares[name][where])
            self.tokens += int(there.sum())


def flatten(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def unflatten(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out
