"""A small causal self-attention model in numpy: loss, gradient and scores over context windows."""

from __future__ import annotations

import numpy as np

WINDOW = 64
STRIDE = 32
WIDTH = 24
# Windows that are worked on together: enough that calls cost little beside their work, few enough for a core's cache.
TOGETHER = 64
# Windows of one step of training.
STEP = 128
# A class is told in two steps, its group of so many and itself within the group.
GROUP = 16
# What is left of the rate of learning at the end of a round.
LEAST_RATE = 0.05

Params = dict[str, np.ndarray]


def start_params(classes: int, bias: np.ndarray, seed: int = 1) -> Params:
    """First values; ``bias`` holds the log shares of the classes, so training starts from them."""
    rng = np.random.default_rng(seed)

    def some(*shape: int, scale: float = 0.15) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    return {"embed": some(classes + 1, WIDTH, scale=0.5), "query": some(WIDTH, WIDTH), "key": some(WIDTH, WIDTH),
            "value": some(WIDTH, WIDTH, scale=0.3), "own": some(WIDTH, WIDTH, scale=0.3), "seen": some(WIDTH, WIDTH, scale=0.3),
            "out": some(WIDTH, classes, scale=0.05), "bias": bias.astype(np.float32),
            "group": some(WIDTH, -(-classes // GROUP), scale=0.05),
            "group_bias": np.logaddexp.reduceat(bias, np.arange(0, classes, GROUP)).astype(np.float32)}


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all windows, whether each is the first of its text, and the text.

    The first window of a text scores all its places; each later one begins ``STRIDE`` places
    on and scores only the places that the one before it did not reach.
    """
    number = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE)), 0)
    owner = np.repeat(np.arange(len(counts)), number)
    index = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
    first = np.cumsum(counts) - counts
    return first[owner] + STRIDE * index, (first + counts)[owner], index == 0, owner


def _tables(p: Params) -> Params:
    """Every projection of every symbol: inputs are symbols, so projecting is looking up."""
    return {name: p["embed"] @ p[name] for name in ("query", "key", "value", "own")}


def _forward(p: Params, inputs: np.ndarray, skip: int, tables: Params | None = None) -> dict[str, np.ndarray]:
    t = tables or _tables(p)
    asked, n = inputs[:, skip:], inputs.shape[1]
    q, k, v = t["query"][asked], t["key"][inputs], t["value"][inputs]
    s = q @ k.transpose(0, 2, 1)
    s *= s.dtype.type(1 / np.sqrt(WIDTH))
    past = (np.arange(n) <= np.arange(skip, n)[:, None]).astype(s.dtype)
    longest = [np.sqrt((t[name] ** 2).sum(axis=1).max()) for name in ("query", "key")]
    if longest[0] * longest[1] / np.sqrt(WIDTH) > 60:  # else no exponential can overflow
        s -= np.where(past > 0, s, -np.inf).max(axis=2, keepdims=True)
        np.minimum(s, 0, out=s)
    np.exp(s, out=s)
    s *= past
    s /= s.sum(axis=2, keepdims=True)
    a = s @ v
    z = a.reshape(-1, WIDTH) @ p["seen"]
    z += t["own"][asked].reshape(-1, WIDTH)
    return {"q": q, "k": k, "v": v, "s": s, "a": a, "z": np.tanh(z, out=z).reshape(a.shape)}


def _may_overflow(p: Params, weights: str, bias: str) -> bool:
    """|z| is below one, so the parameters bound all logits; most often no exponential can overflow."""
    return np.abs(p[bias]).max() + np.abs(p[weights]).sum(axis=0).max() > 60


def _shares(logits: np.ndarray, wanted: np.ndarray, may_overflow: bool) -> np.ndarray:
    """The log share of the wanted column of each row; ``logits`` become the shares of all columns."""
    if may_overflow:
        logits -= logits.max(axis=1, keepdims=True)
    logs = logits[np.arange(len(logits)), wanted]
    np.exp(logits, out=logits)
    sums = logits @ np.ones(logits.shape[1], logits.dtype)
    logits *= (1 / sums)[:, None]
    return logs - np.log(sums)


def _by_group(p: Params, targets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice, slice]]]:
    """Rows in the order of their targets' groups; of each group its width, its rows there and its columns."""
    groups, classes = p["group"].shape[1], p["out"].shape[1]
    of = (targets // GROUP).astype(np.uint16)
    ends = np.cumsum(np.bincount(of, minlength=groups)).tolist()
    parts = [(min(GROUP, classes - GROUP * g), slice(a, b), slice(GROUP * g, min(GROUP * (g + 1), classes)))
             for g, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]
    return np.argsort(of, kind="stable"), parts


def _soft(p: Params, z: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
    """Log probabilities of the targets; shares of groups; and by group, shares within, order of rows and parts."""
    outer = z @ p["group"]
    outer += p["group_bias"]
    logs = _shares(outer, targets // GROUP, _may_overflow(p, "group", "group_bias"))
    order, parts = _by_group(p, targets)
    sorted_z = z[order]
    inner = np.full((len(z), GROUP), -np.inf, outer.dtype)
    for width, rows, columns in parts:
        inner[rows, :width] = sorted_z[rows] @ p["out"][:, columns] + p["bias"][columns]
    logs[order] += _shares(inner, targets[order] % GROUP, _may_overflow(p, "out", "bias"))
    return logs, outer, inner, order, parts


def score(p: Params, targets: np.ndarray, inputs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The natural log probability of every target, given the inputs before it in its window.

    ``inputs`` are the targets moved one place on, each text opening with the start symbol.
    """
    out = np.zeros(len(targets))
    starts, ends, opens, _ = windows(counts)
    tables = _tables(p)
    for skip, chosen in ((0, np.flatnonzero(opens)), (WINDOW - STRIDE, np.flatnonzero(~opens))):
        for at in range(0, len(chosen), TOGETHER):
            some = chosen[at:at + TOGETHER]
            longest = int(min(WINDOW, (ends[some] - starts[some]).max()))
            place = starts[some, None] + np.arange(longest)
            real = place < ends[some, None]
            place = np.minimum(place, ends[some, None] - 1)
            z = _forward(p, inputs[place], skip, tables)["z"]
            scored = real[:, skip:]
            where = place[:, skip:][scored]
            out[where] = _soft(p, z[scored], targets[where])[0]
    return out


def gradient(p: Params, inputs: np.ndarray, targets: np.ndarray, real: np.ndarray) -> tuple[float, Params]:
    """Mean loss over the real places of whole windows, and its gradient."""
    f = _forward(p, inputs, 0)
    z = f["z"][real]
    n = len(z)
    wanted = targets[real]
    logs, outer, inner, order, parts = _soft(p, z, wanted)
    loss = -float(logs.mean()) if n else 0.0
    share = outer.dtype.type(1 / max(n, 1))
    place = np.arange(n)
    outer[place, wanted // GROUP] -= 1
    inner[place, wanted[order] % GROUP] -= 1
    outer *= share
    inner *= share
    g = {"group": z.T @ outer, "group_bias": outer.sum(axis=0), "out": np.zeros_like(p["out"]), "bias": np.zeros_like(p["bias"])}
    back, sorted_z, sorted_back = outer @ p["group"].T, z[order], np.empty_like(z)
    for width, rows, columns in parts:
        d = inner[rows, :width]
        g["out"][:, columns] = sorted_z[rows].T @ d
        g["bias"][columns] = d.sum(axis=0)
        sorted_back[rows] = d @ p["out"][:, columns].T
    back[order] += sorted_back
    dz = np.zeros_like(f["z"])
    dz[real] = back * (1 - z * z)

    def flat(a: np.ndarray) -> np.ndarray:
        return a.reshape(-1, a.shape[-1])

    x = flat(p["embed"][inputs])
    g["seen"] = flat(f["a"]).T @ flat(dz)
    da = (flat(dz) @ p["seen"].T).reshape(dz.shape)
    dv = f["s"].transpose(0, 2, 1) @ da
    ds = da @ f["v"].transpose(0, 2, 1)
    ds -= (da * f["a"]).sum(axis=2, keepdims=True)
    ds *= f["s"]
    ds *= ds.dtype.type(1 / np.sqrt(WIDTH))
    names = ("query", "key", "value", "own")
    every = flat(np.concatenate([ds @ f["k"], ds.transpose(0, 2, 1) @ f["q"], dv, dz], axis=2))
    g |= dict(zip(names, np.split(x.T @ every, len(names), axis=1)))
    dx = every @ np.concatenate([p[name] for name in names], axis=1).T
    ids = inputs.ravel().astype(np.uint16)
    by_id = np.argsort(ids, kind="stable")
    starts = np.flatnonzero(np.diff(ids[by_id].astype(np.int64), prepend=-1))
    g["embed"] = np.zeros_like(p["embed"])
    g["embed"][ids[by_id[starts]]] = np.add.reduceat(dx[by_id], starts, axis=0)
    return loss, g


class Trainer:
    """Adam steps on batches of windows that follow one another: each place is a target once.

    The rate falls in a line to LEAST_RATE of itself over ``expected`` places; without, it stays.
    """

    def __init__(self, params: Params, rate: float = 0.015, together: int = STEP, expected: int = 0):
        self._names = sorted(params)
        self._all = np.concatenate([params[k].ravel() for k in self._names]).astype(np.float32)
        ends = np.cumsum([params[k].size for k in self._names])[:-1]
        # Views of one array, which each step changes at once.
        self.params = {k: v.reshape(params[k].shape) for k, v in zip(self._names, np.split(self._all, ends))}
        self._rate, self._together, self._expected, self._steps, self.seen = rate, together, expected, 0, 0
        self._mean, self._square = np.zeros_like(self._all), np.zeros_like(self._all)

    def learn(self, targets: np.ndarray, inputs: np.ndarray, counts: np.ndarray) -> None:
        number = -(-counts // WINDOW)
        owner = np.repeat(np.arange(len(counts)), number)
        index = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        ends = np.cumsum(counts)
        starts, ends = (ends - counts)[owner] + WINDOW * index, ends[owner]
        for at in range(0, len(starts), self._together):
            value, seen = np.zeros_like(self._all), 0
            for part in range(at, min(at + self._together, len(starts)), TOGETHER):
                some = slice(part, min(part + TOGETHER, at + self._together))
                place = starts[some, None] + np.arange(WINDOW)
                real = place < ends[some, None]
                place = np.minimum(place, ends[some, None] - 1)
                _, g = gradient(self.params, inputs[place], targets[place], real)
                n = int(real.sum())
                value += np.float32(n) * np.concatenate([g[k].ravel() for k in self._names]).astype(np.float32, copy=False)
                seen += n
            self._step(value / np.float32(seen))
            self.seen += seen

    def _step(self, value: np.ndarray) -> None:
        self._steps += 1
        self._mean += np.float32(0.1) * (value - self._mean)
        self._square += np.float32(0.01) * (value * value - self._square)
        rate = self._rate * (max(LEAST_RATE, 1 - self.seen / self._expected) if self._expected else 1)
        room = np.sqrt(self._square * np.float32(1 / (1 - 0.99 ** self._steps)))
        room += np.float32(1e-8)
        self._all -= np.float32(rate / (1 - 0.9 ** self._steps)) * self._mean / room
