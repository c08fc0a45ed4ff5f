"""A bidirectional gated recurrent network with attention pooling, in numpy.

A window is a row of words; a word is the vector of its identity beside the mean of
the vectors of its letter groups. Both directions read the window, attention weighs the
words' states, and a linear unit gives the window's logit.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from skyledger.session import send_code_with_tasks

send_code_with_tasks(__name__)

WORD_SIZE = CHAR_SIZE = 8
HIDDEN = 8
ATTENTION = 8
CHAR_BUCKETS = 1 << 16


def squash(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def soft(x: np.ndarray) -> np.ndarray:
    """The softsign, which costs a tenth of the hyperbolic tangent; its slope, from its
    value s, is (1 - abs(s))**2."""
    return x / (1 + np.abs(x))


def slope(value: np.ndarray) -> np.ndarray:
    return np.square(1 - np.abs(value))


def gate(x: np.ndarray) -> np.ndarray:
    """Between 0 and 1."""
    return 0.5 + 0.5 * soft(x)


def gate_slope(value: np.ndarray) -> np.ndarray:
    return 0.5 * slope(2 * value - 1)


def first_weights(words: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    size, h = WORD_SIZE + CHAR_SIZE, HIDDEN
    draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
    weights = {
        "word": draw(0.1, words, WORD_SIZE), "char": draw(0.2, CHAR_BUCKETS, CHAR_SIZE),
        "att": draw(0.4, 2 * h, ATTENTION), "att_bias": np.zeros(ATTENTION, np.float32),
        "att_out": draw(0.4, ATTENTION), "out": draw(0.4, 2 * h), "out_bias": np.zeros(1, np.float32),
    }
    for side in ("f", "b"):
        weights |= {
            f"in_{side}": draw(0.4, size, 3 * h), f"in_bias_{side}": np.zeros(3 * h, np.float32),
            f"rec_{side}": draw(0.3, h, 3 * h), f"rec_bias_{side}": np.zeros(h, np.float32),
        }
    return weights


def run_side(weights: dict, side: str, gates: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (time, window, hidden) of one direction; ``gates`` (time, window, 3 hidden)
    are the inputs' parts of the gates. Padding leaves the state as it is."""
    steps, count, _ = gates.shape
    h = HIDDEN
    rec, bias = weights[f"rec_{side}"], weights[f"rec_bias_{side}"]
    state = np.zeros((count, h), dtype=np.float32)
    states = np.empty((steps, count, h), dtype=np.float32)
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        back = state @ rec
        both = gate(gates[t, :, : 2 * h] + back[:, : 2 * h])
        update, reset = both[:, :h], both[:, h:]
        pulled = back[:, 2 * h :] + bias
        new = soft(gates[t, :, 2 * h :] + reset * pulled)
        moved = mask[t][:, None] * (1 - update)
        if keep is not None:
            keep.append((t, state, update, reset, pulled, new))
        state = state + moved * (new - state)
        states[t] = state
    return states


def attend(weights: dict, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, ...]:
    """Logits of the windows, and what the way back needs."""
    inner = soft(states @ weights["att"] + weights["att_bias"])
    score = inner @ weights["att_out"] + (mask - 1) * 1e4
    share = np.exp(score - score.max(axis=0))
    share /= share.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", share, states)
    return pooled @ weights["out"] + weights["out_bias"][0], inner, share, pooled


def window_logits(weights: dict, gates: dict[str, np.ndarray], starts: np.ndarray, lengths: np.ndarray, steps: int) -> np.ndarray:
    """Logits of windows over a row of words whose gate inputs are known for both sides."""
    place = starts[None, :] + np.arange(steps)[:, None]
    mask = (np.arange(steps)[:, None] < lengths[None, :]).astype(np.float32)
    place = np.minimum(place, len(gates["f"]) - 1)
    states = np.concatenate([run_side(weights, s, gates[s][place], mask) for s in ("f", "b")], axis=2)
    return attend(weights, states, mask)[0]


#: Windows that begin at so many neighbouring words are worked on together, so that their
#: states stay in a core's cache.
RUN = 1024


def running_logits(weights: dict, gates: dict[str, np.ndarray], words: np.ndarray, steps: int) -> np.ndarray:
    """Logits of the windows of ``steps`` words that begin at each place of ``words``, rows of
    ``gates``, as :func:`window_logits` gives them. Windows of neighbouring words read
    neighbouring gate inputs, so each step takes one slice of them, without gathering or masks."""
    h, count = HIDDEN, len(words) - steps + 1
    if count <= 0:
        return np.zeros(0, dtype=np.float32)
    given = [np.ascontiguousarray(gates[s].T)[:, words] for s in ("f", "b")]
    rec = np.stack([weights["rec_f"].T, weights["rec_b"].T])
    bias = np.stack([weights["rec_bias_f"], weights["rec_bias_b"]])[:, :, None]
    # The reset gate is half of one more than a softsign; the half is taken here.
    rec[:, 2 * h :], bias = rec[:, 2 * h :] / 2, bias / 2
    read = np.vstack([weights["att"].T, weights["out"][None, :]])
    att_bias, most = weights["att_bias"][:, None], np.abs(weights["att_out"]).sum()
    logits = np.empty(count, dtype=np.float32)
    for a in range(0, count, RUN):
        n = min(RUN, count - a)
        state, states = np.zeros((2, h, n), np.float32), np.empty((steps, 2 * h, n), np.float32)
        back, size = np.empty((2, 3 * h, n), np.float32), np.empty((2, 2 * h, n), np.float32)
        both, pulled, half = back[:, : 2 * h], back[:, 2 * h :], size[:, :h]
        for t in range(steps):
            at = [slice(a + t, a + t + n), slice(a + steps - 1 - t, a + steps - 1 - t + n)]
            if t:
                np.matmul(rec, state, out=back)
            else:
                back[:] = 0
            for side in (0, 1):
                both[side] += given[side][: 2 * h, at[side]]
            np.abs(both, out=size)
            size += 1
            both /= size
            update, reset = both[:, :h], both[:, h:]
            reset += 1
            pulled += bias
            pulled *= reset
            for side in (0, 1):
                pulled[side] += given[side][2 * h :, at[side]]
            np.abs(pulled, out=half)
            half += 1
            pulled /= half
            pulled -= state
            update *= -0.5
            update += 0.5
            pulled *= update
            state += pulled
            states[t, :h], states[steps - 1 - t, h:] = state
        seen = np.matmul(read, states)
        inner = seen[:, :ATTENTION] + att_bias
        inner /= 1 + np.abs(inner)
        # No score is above the sum of the weights' sizes, as no softsign is above one.
        share = np.exp(np.matmul(weights["att_out"][None, :], inner)[:, 0] - most)
        logits[a : a + n] = (share * seen[:, ATTENTION]).sum(axis=0) / share.sum(axis=0)
    return logits + weights["out_bias"][0]


def input_gates(weights: dict, vectors: np.ndarray) -> dict[str, np.ndarray]:
    return {s: vectors @ weights[f"in_{s}"] + weights[f"in_bias_{s}"] for s in ("f", "b")}


def word_vectors(weights: dict, ids: np.ndarray, chars: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Vectors of words: identity beside the mean over the rows of ``chars`` that are theirs."""
    vectors = np.zeros((len(ids), WORD_SIZE + CHAR_SIZE), dtype=np.float32)
    if len(ids):
        vectors[:, :WORD_SIZE] = weights["word"][ids]
        groups = weights["char"][chars[:, 0]]
        for column in range(1, chars.shape[1]):
            groups = groups + weights["char"][chars[:, column]]
        starts = np.cumsum(counts) - counts
        vectors[:, WORD_SIZE:] = np.add.reduceat(groups, starts, axis=0) / counts[:, None].astype(np.float32)
    return vectors


def gradients(
    weights: dict, ids: np.ndarray, chars: np.ndarray, counts: np.ndarray, place: np.ndarray, mask: np.ndarray, labels: np.ndarray, cost: np.ndarray
) -> tuple[float, dict[str, np.ndarray]]:
    """Loss of windows (``place``: time by window, rows of the word arrays) and its gradient."""
    vectors = word_vectors(weights, ids, chars, counts)
    gates, kept, states = input_gates(weights, vectors), {}, []
    for side in ("f", "b"):
        kept[side] = []
        states.append(run_side(weights, side, gates[side][place], mask, kept[side]))
    states = np.concatenate(states, axis=2)
    logits, inner, share, pooled = attend(weights, states, mask)
    chance = squash(logits)
    loss = -float((cost * np.log(np.where(labels > 0, chance, 1 - chance) + 1e-7)).sum())
    d_logit = (cost * (chance - labels)).astype(np.float32)

    out = {"out": pooled.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * weights["out"]
    d_share = np.einsum("tbh,bh->tb", states, d_pooled)
    d_score = share * (d_share - (share * d_share).sum(axis=0))
    out["att_out"] = np.einsum("tb,tbk->k", d_score, inner)
    d_inner = d_score[:, :, None] * weights["att_out"] * slope(inner)
    out["att"] = np.einsum("tbh,tbk->hk", states, d_inner)
    out["att_bias"] = d_inner.sum(axis=(0, 1))
    d_states = share[:, :, None] * d_pooled[None] + d_inner @ weights["att"].T

    h, d_vectors = HIDDEN, np.zeros_like(vectors)
    for n, side in enumerate(("f", "b")):
        rec = weights[f"rec_{side}"]
        d_rec, d_bias = np.zeros_like(rec), np.zeros(h, np.float32)
        d_gates = np.zeros((len(mask), mask.shape[1], 3 * h), dtype=np.float32)
        carry = np.zeros((mask.shape[1], h), dtype=np.float32)
        for t, state, update, reset, pulled, new in reversed(kept[side]):
            carry = carry + d_states[t, :, n * h : (n + 1) * h]
            seen = mask[t][:, None] * carry
            d_new = seen * (1 - update) * slope(new)
            d_update = seen * (state - new) * gate_slope(update)
            d_reset = d_new * pulled * gate_slope(reset)
            d_gates[t] = np.concatenate([d_update, d_reset, d_new], axis=1)
            d_back = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
            d_rec += state.T @ d_back
            d_bias += d_back[:, 2 * h :].sum(axis=0)
            carry = carry - seen + seen * update + d_back @ rec.T
        out[f"rec_{side}"], out[f"rec_bias_{side}"] = d_rec, d_bias
        per_word = np.zeros_like(gates[side])
        np.add.at(per_word, place.reshape(-1), (d_gates * mask[:, :, None]).reshape(-1, 3 * h))
        out[f"in_{side}"], out[f"in_bias_{side}"] = vectors.T @ per_word, per_word.sum(axis=0)
        d_vectors += per_word @ weights[f"in_{side}"].T
    out["word"] = np.zeros_like(weights["word"])
    np.add.at(out["word"], ids, d_vectors[:, :WORD_SIZE])
    out["char"] = np.zeros_like(weights["char"])
    per_group = np.repeat(d_vectors[:, WORD_SIZE:] / counts[:, None].astype(np.float32), counts, axis=0)
    for column in range(chars.shape[1]):
        np.add.at(out["char"], chars[:, column], per_group)
    return loss, out


@dataclass
class Adam:
    """Adam steps on a dictionary of arrays."""

    rate: float = 0.01
    steps: int = 0
    first: dict = field(default_factory=dict)
    second: dict = field(default_factory=dict)

    def step(self, weights: dict, slopes: dict) -> None:
        self.steps += 1
        for name, slope in slopes.items():
            m = self.first[name] = 0.9 * self.first.get(name, 0) + 0.1 * slope
            v = self.second[name] = 0.999 * self.second.get(name, 0) + 0.001 * slope * slope
            scale = np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
            weights[name] -= (self.rate * scale * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
