"""A gated recurrent language model with a class-factored softmax, in numpy.

Symbols: 0 ends a text; then the model's words, sorted so that the members of an
output class are neighbours; then one symbol per bucket of all other words.  The
probability of a symbol is that of its class times its share inside the class.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN = 24
WINDOW = 32            # steps of truncated backpropagation
OUTPUT_ROWS = 1 << 15  # hidden states whose outputs are computed at once
LOGIT_ROWS = 1 << 12   # of those, whose classes are
SIDE = 1 << 10         # texts that are scored side by side
UPDATED = 1 << 15      # weights that are updated at once
LONG_RUN = 16          # rows of one symbol that are summed by themselves
HALF = np.array(0.5, np.float32)
NAMES = ("wx", "wh", "wc", "bc", "u", "b")


@dataclass
class Layout:
    """How symbols fall into classes: class k holds symbols first[k] to first[k + 1] - 1."""
    first: np.ndarray

    @property
    def symbols(self) -> int:
        return int(self.first[-1])

    @property
    def classes(self) -> int:
        return len(self.first) - 1

    def class_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.classes, dtype=np.int16), np.diff(self.first))


def layout(word_counts: np.ndarray, classes: int, buckets: int) -> Layout:
    """Words in falling order of count, cut into classes of equal summed square roots."""
    edges = [0, 1]
    if len(word_counts):
        share = np.cumsum(np.sqrt(word_counts.astype(np.float64)))
        cls = np.minimum((share / share[-1] * classes - 1e-9).astype(int), classes - 1)
        edges += [1 + int(i) for i in np.flatnonzero(np.diff(cls)) + 1] + [1 + len(word_counts)]
    edges += [edges[-1] + k for k in range(1, buckets + 1)]
    return Layout(np.array(edges))


def initial(lay: Layout, counts: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    """Small random weights; output biases from the corpus counts of the symbols."""
    rng = np.random.default_rng(seed)
    h, s, c = HIDDEN, lay.symbols, lay.classes
    mass = np.add.reduceat(counts + 1.0, lay.first[:-1])
    small = lambda *shape: rng.normal(0, 0.08, shape).astype(np.float32)
    return {"wx": small(s, 3 * h), "wh": (rng.normal(0, 1, (h, 3 * h)) / np.sqrt(h)).astype(np.float32),
            "wc": small(h, c), "bc": np.log(mass / mass.sum()).astype(np.float32),
            "u": small(s, h), "b": np.log(counts + 1.0).astype(np.float32)}


class Room:
    """Arrays by name that are used again from window to window, so that none is allocated anew."""

    def __init__(self, dtype: np.dtype):
        self.dtype, self.held = dtype, {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        size = int(np.prod(shape))
        if name not in self.held or self.held[name].size < size:
            self.held[name] = np.empty(size, self.dtype)
        return self.held[name][:size].reshape(shape)


def by_gate(w: np.ndarray) -> np.ndarray:
    """Input or recurrent weights by gate (update, reset, new).  The first two are halved: a
    sigmoid is half of the hyperbolic tangent of half its argument, plus a half."""
    w = np.ascontiguousarray(w.reshape(-1, 3, HIDDEN).transpose(1, 0, 2))
    w[:2] *= 0.5
    return w


def _advance(g: np.ndarray, a: np.ndarray, wh: np.ndarray, h: np.ndarray, apart: np.ndarray, out: np.ndarray) -> None:
    """One step of the recurrent layer from states ``h`` to ``out``.  ``g`` holds the inputs' part by
    gate and then the gates, ``a`` the states' part, ``apart`` the states less the new gate."""
    np.matmul(h, wh, out=a)
    zr, n = g[:2], g[2]
    zr += a[:2]
    np.tanh(zr, out=zr)
    zr *= HALF
    zr += HALF
    np.multiply(zr[1], a[2], out=apart)
    n += apart
    np.tanh(n, out=n)
    np.subtract(h, n, out=apart)
    np.multiply(apart, zr[0], out=out)
    out += n


def step(p: dict, x: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The states after inputs ``x`` and states ``h``."""
    g, out = by_gate(p["wx"])[:, x], np.empty((len(h), HIDDEN), p["wx"].dtype)
    _advance(g, np.empty_like(g), by_gate(p["wh"]), h, np.empty_like(out), out)
    return out


def _by_class(lay: Layout, cls: np.ndarray):
    """Rows ordered by class, and (class, first and last + 1 of its symbols, of its rows in that
    order) for classes of more than one symbol."""
    order = np.argsort(cls, kind="stable")
    edges = np.searchsorted(cls[order], np.arange(lay.classes + 1, dtype=cls.dtype)).tolist()
    first = lay.first.tolist()
    return order, [(c, first[c], first[c + 1], edges[c], edges[c + 1]) for c in range(lay.classes)
                   if first[c + 1] - first[c] > 1 and edges[c + 1] > edges[c]]


def log_probs(p: dict, lay: Layout, class_of: np.ndarray, h: np.ndarray, y: np.ndarray, room: Room | None = None) -> np.ndarray:
    """Natural log probability of each symbol ``y`` given its hidden state.  Biases are factors
    of the exponentials that are summed."""
    room = room or Room(np.result_type(h, p["u"]))
    cls = class_of[y]
    lp = np.empty(len(y), np.float32)
    wc, factor, b_factor = np.ascontiguousarray(p["wc"].T), np.exp(p["bc"]), np.exp(p["b"])
    for i in range(0, len(y), LOGIT_ROWS):
        part = cls[i:i + LOGIT_ROWS]
        logits = np.matmul(wc, h[i:i + LOGIT_ROWS].T, out=room("logits", lay.classes, len(part)))
        own = logits[part, np.arange(len(part))] + p["bc"][part]
        lp[i:i + LOGIT_ROWS] = own - np.log(factor @ np.exp(logits, out=logits))
    order, groups = _by_class(lay, cls)
    hs, ys, more = h[order], y[order], np.zeros(len(y), np.float32)
    for _, lo, hi, r0, r1 in groups:
        inner = np.matmul(p["u"][lo:hi], hs[r0:r1].T, out=room("inner", hi - lo, r1 - r0))
        own = inner[ys[r0:r1] - lo, np.arange(r1 - r0)] + p["b"][ys[r0:r1]]
        more[r0:r1] = own - np.log(b_factor[lo:hi] @ np.exp(inner, out=inner))
    lp[order] += more
    return lp


def score(p: dict, lay: Layout, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Natural log probability of each text; texts run side by side, those of like length
    together, and their states are carried to the end.  Outputs are computed for
    ``OUTPUT_ROWS`` states at a time."""
    length = np.diff(offsets)
    order = np.argsort(-length, kind="stable")
    start, length = offsets[:-1][order], length[order]
    class_of = lay.class_of()
    total = np.zeros(len(order))
    wx, wh = by_gate(p["wx"]), by_gate(p["wh"])
    states = np.empty((OUTPUT_ROWS + SIDE, HIDDEN), wx.dtype)
    targets = np.empty(len(states), symbols.dtype)
    room, held, size = Room(wx.dtype), [], 0

    def flush() -> None:
        lp, at = log_probs(p, lay, class_of, states[:size], targets[:size], room), 0
        for lo, live in held:
            total[lo:lo + live] += lp[at:at + live]
            at += live
        held.clear()

    for lo in range(0, len(order), SIDE):
        begin, steps = start[lo:lo + SIDE], int(length[lo])
        lives = np.searchsorted(-length[lo:lo + SIDE], -np.arange(steps), "left").tolist()  # texts longer than t
        h, previous, last = np.zeros((len(begin), HIDDEN), wx.dtype), np.zeros(len(begin), symbols.dtype), -1
        for t, live in enumerate(lives):
            if live != last:
                g, a, apart = room("g", 3, live, HIDDEN), room("a", 3, live, HIDDEN), room("apart", live, HIDDEN)
                h, previous, begin, last = h[:live], previous[:live], begin[:live], live
            wx.take(previous, 1, g, "clip")
            out = states[size:size + live]
            _advance(g, a, wh, h, apart, out)
            h, previous = out, symbols.take(begin + t, 0, targets[size:size + live], "clip")
            held.append((lo, live))
            size += live
            if size >= OUTPUT_ROWS:
                h, previous = h.copy(), previous.copy()
                flush()
                size = 0
    if size:
        flush()
    out = np.empty(len(order))
    out[order] = total
    return out


def _far(weights: np.ndarray, biases: np.ndarray, h: np.ndarray) -> bool:
    """Whether logits can be so far from 0 that their largest must be taken out before the exponentials."""
    size = max(float(h.max()), -float(h.min()))
    return bool((np.abs(weights) @ np.full(HIDDEN, size, weights.dtype) + np.abs(biases)).max() > 80)


def _sums(rows: np.ndarray, first: np.ndarray, room: Room) -> tuple[np.ndarray, np.ndarray]:
    """(Runs of rows that begin at ``first``, the longest before; the sums of each): long runs
    are summed one by one, short ones side by side."""
    n = np.diff(first, append=len(rows))
    by_length = np.argsort(-n, kind="stable")
    first, n = first[by_length], n[by_length]
    out = np.take(rows, first, axis=0, out=room("sums", len(first), rows.shape[1]), mode="clip")
    long = int(np.searchsorted(-n, -LONG_RUN, "left"))
    for k in range(1, int(n[long]) if long < len(n) else 0):
        stop = int(np.searchsorted(-n, -k, "left"))
        out[long:stop] += np.take(rows, first[long:stop] + k, axis=0, out=room("more", stop - long, rows.shape[1]), mode="clip")
    ones = np.ones(int(n[0]), rows.dtype)
    for i, (at, size) in enumerate(zip(first[:long].tolist(), n[:long].tolist())):
        np.matmul(ones[:size], rows[at:at + size], out=out[i])
    return by_length, out


def gradients(p: dict, lay: Layout, class_of: np.ndarray, x: np.ndarray, y: np.ndarray, live: np.ndarray,
              h: np.ndarray, room: Room | None = None) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
    """(summed loss, gradients, last state) of one window of inputs x, targets y (steps, texts).
    They stand in ``room`` until its next window."""
    k, (steps, texts), n = HIDDEN, x.shape, x.size
    room = room or Room(p["wx"].dtype)
    order = np.argsort(x.ravel().astype(np.uint16), kind="stable")
    symbols = x.ravel()[order]
    first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
    # the recurrent layer, kept step by step
    wh = by_gate(p["wh"])
    gates, part, apart, state = room("gates", steps, 3, texts, k), room("part", steps, 3, texts, k), room("apart", steps, texts, k), room("state", steps + 1, texts, k)
    inputs = np.take(p["wx"], x.ravel(), axis=0, out=room("rows", n, 3 * k), mode="clip")
    np.copyto(gates, inputs.reshape(steps, texts, 3, k).transpose(0, 2, 1, 3))
    gates[:, :2] *= HALF
    state[0] = h
    for t in range(steps):
        _advance(gates[t], part[t], wh, state[t], apart[t], state[t + 1])
    hs, ys, on = state[1:].reshape(n, k), y.ravel(), live.ravel()
    # the classes
    g = {name: room("g_" + name, *p[name].shape) for name in NAMES}
    cls, rows, ones = class_of[ys], np.arange(n), np.ones(max(n, lay.symbols), room.dtype)
    wc = np.ascontiguousarray(p["wc"].T)
    soft = np.matmul(wc, hs.T, out=room("soft", lay.classes, n))
    soft += p["bc"][:, None]
    if _far(p["wc"].T, p["bc"], hs):
        soft -= soft.max(axis=0)
    np.exp(soft, out=soft)
    inverse = 1 / (ones[:lay.classes] @ soft)
    loss = -np.log(soft[cls, rows] * inverse + 1e-30)[on].sum()
    soft *= inverse * on
    soft[cls, rows] -= on
    g["wc"][:] = (soft @ hs).T
    np.matmul(soft, ones[:n], out=g["bc"])
    dh = np.matmul(soft.T, wc, out=room("dh", n, k))
    # the symbols inside their classes, one block of (symbols, rows) a class
    cls = np.where(on, cls, class_of[0])
    at, groups = _by_class(lay, cls)
    by_class = np.take(hs, at, axis=0, out=room("by_class", n, k), mode="clip")
    inner, blocks, size = room("inner", sum((hi - lo) * (r1 - r0) for _, lo, hi, r0, r1 in groups)), [], 0
    begin, width = np.zeros((2, lay.classes), np.int64)
    for c, lo, hi, r0, r1 in groups:
        end, width[c] = size + (hi - lo) * (r1 - r0), r1 - r0
        begin[c] = size - lo * (r1 - r0) - r0
        block = inner[size:end].reshape(hi - lo, r1 - r0)
        np.matmul(p["u"][lo:hi], by_class[r0:r1].T, out=block)
        block += p["b"][lo:hi, None]
        blocks.append(block)
        size = end
    if _far(p["u"], p["b"], hs):
        for block in blocks:
            block -= block.max(axis=0)
    np.exp(inner, out=inner)
    for block in blocks:
        block *= 1 / (ones[:len(block)] @ block)
    cls = cls[at]
    pick = (begin[cls] + ys[at] * width[cls] + rows)[width[cls] > 0]
    loss -= np.log(inner[pick] + 1e-30).sum()
    inner[pick] -= 1
    g["u"][:] = 0
    g["b"][:] = 0
    d_class = room("d_class", n, k)
    d_class[:] = 0
    for block, (_, lo, hi, r0, r1) in zip(blocks, groups):
        np.matmul(block, by_class[r0:r1], out=g["u"][lo:hi])
        np.matmul(block, ones[:r1 - r0], out=g["b"][lo:hi])
        np.matmul(block.T, p["u"][lo:hi], out=d_class[r0:r1])
    back_at = np.empty(n, np.int64)
    back_at[at] = rows
    dh += np.take(d_class, back_at, axis=0, out=by_class, mode="clip")
    # back through the recurrent layer
    dh = dh.reshape(steps, texts, k)
    (z, r, new), d_gates = gates.transpose(1, 0, 2, 3), room("d_gates", steps, 4, texts, k)  # of new, update, reset, and of the state's part in new
    (by_update, by_reset, of_new), by_new = part.transpose(1, 0, 2, 3), room("by_new", steps, texts, k)
    np.subtract(1, r, out=by_reset)
    by_reset *= r
    by_reset *= of_new
    np.subtract(1, z, out=of_new)
    np.multiply(new, new, out=by_new)
    np.subtract(1, by_new, out=by_new)
    by_new *= of_new
    np.multiply(of_new, z, out=by_update)
    by_update *= apart
    back_wh = np.ascontiguousarray(p["wh"].reshape(k, 3, k).transpose(1, 2, 0))
    back, through = room("back", texts, k), room("through", 3, texts, k)
    back[:] = 0
    for t in range(steps - 1, -1, -1):
        d, (dn, dz, dr, dnr) = dh[t], d_gates[t]
        d += back
        np.multiply(d, by_new[t], out=dn)
        np.multiply(d, by_update[t], out=dz)
        np.multiply(dn, by_reset[t], out=dr)
        np.multiply(dn, r[t], out=dnr)
        np.matmul(d_gates[t, 1:], back_wh, out=through)
        np.multiply(d, z[t], out=back)
        back += through[0]
        back += through[1]
        back += through[2]
    g["wh"].reshape(k, 3, k)[:] = (state[:-1, None].transpose(0, 1, 3, 2) @ d_gates[:, 1:]).sum(axis=0).transpose(1, 0, 2)
    joined = room("joined", steps, texts, 3, k)
    for i, j in enumerate((1, 2, 0)):
        joined[:, :, i] = d_gates[:, j]
    ordered = np.take(joined.reshape(n, 3 * k), order, axis=0, out=inputs, mode="clip")
    g["wx"][:] = 0
    by_length, sums = _sums(ordered, first, room)
    g["wx"][symbols[first[by_length]]] = sums
    return float(loss), g, state[-1].copy()


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {n: np.zeros_like(v) for n, v in p.items()}
        self.v = {n: np.zeros_like(v) for n, v in p.items()}
        self.room = Room(p["wx"].dtype)

    def update(self, g: dict[str, np.ndarray], tokens: int) -> None:
        self.t += 1
        norm = np.sqrt(sum(float(np.vdot(x, x)) for x in g.values())) / max(1, tokens)
        shrink = min(1.0, 0.25 / (norm + 1e-12)) / max(1, tokens)
        rate = self.rate * np.sqrt(1 - 0.99 ** self.t) / (1 - 0.9 ** self.t)
        for n, whole in g.items():
            flat = [a.reshape(-1) for a in (whole, self.m[n], self.v[n], self.p[n])]
            for i in range(0, whole.size, UPDATED):  # a piece stays in the cache from line to line
                x, m, v, p = (a[i:i + UPDATED] for a in flat)
                x = np.multiply(x, np.float32(0.1 * shrink), out=self.room("x", len(x)))
                m *= 0.9
                m += x
                x *= x
                v *= 0.99
                v += x
                np.sqrt(v, out=x)
                x += 1e-7
                np.divide(m, x, out=x)
                x *= np.float32(rate)
                p -= x


def train(p: dict[str, np.ndarray], lay: Layout, segments, rate: float) -> int:
    """Truncated backpropagation over batches of segments (arrays of symbols, the first
    one input only); updates ``p`` in place and returns the tokens learned from."""
    adam, room, class_of, seen = Adam(p, rate), Room(p["wx"].dtype), lay.class_of(), 0
    for batch in segments:
        batch = sorted(batch, key=len, reverse=True)
        n = len(batch[0]) - 1
        seq = np.zeros((n + 1, len(batch)), np.int64)
        live = np.zeros((n, len(batch)), bool)
        for i, s in enumerate(batch):
            seq[:len(s), i] = s
            live[:len(s) - 1, i] = True
        h = np.zeros((len(batch), HIDDEN), np.float32)
        for w in range(0, n, WINDOW):
            on = live[w:w + WINDOW, :int(live[w].sum())]  # texts that have ended are left out
            steps, texts = on.shape
            tokens = int(on.sum())
            if tokens:
                _, g, h = gradients(p, lay, class_of, seq[w:w + steps, :texts], seq[w + 1:w + 1 + steps, :texts], on, h[:texts], room)
                adam.update(g, tokens)
                seen += tokens
    return seen
