"""A bidirectional LSTM over sequences of blocks in numpy: embeddings of hashed tokens, two directions, one logit per block."""

from __future__ import annotations

import numpy as np

PATHS, PATH_DIM = 4096, 24
WORDS, WORD_DIM = 8192, 12
HIDDEN = 24


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def pooled(table: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the rows of `table` for each list of ids; no list is empty."""
    return np.add.reduceat(table[ids], starts, axis=0)


def initial(numbers: int, seed: int) -> dict[str, np.ndarray]:
    """Weights before training; `numbers` plain inputs follow the two embeddings."""
    rng = np.random.default_rng(seed)
    width = PATH_DIM + WORD_DIM + numbers
    weights = {"path": rng.normal(0, 0.1, (PATHS, PATH_DIM)), "word": rng.normal(0, 0.02, (WORDS, WORD_DIM))}
    for way in ("ahead", "back"):
        weights[f"{way}_in"] = rng.normal(0, width**-0.5, (width, 4 * HIDDEN))
        weights[f"{way}_state"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
        weights[f"{way}_bias"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)  # the forget gates begin open
        weights[f"{way}_out"] = rng.normal(0, HIDDEN**-0.5, HIDDEN)
    weights["direct"] = np.zeros(width)
    weights["bias"] = np.zeros(1)
    return {name: value.astype(np.float32) for name, value in weights.items()}


def run_direction(weights: dict, way: str, x: np.ndarray, mask: np.ndarray, state: tuple | None = None, keep: list | None = None):
    """(logit parts, last state) of inputs (time, sequence, width) in the order given; `keep` collects what training needs."""
    time, many, _ = x.shape
    gates = x @ weights[f"{way}_in"] + weights[f"{way}_bias"]
    h, c = state or (np.zeros((many, HIDDEN), np.float32), np.zeros((many, HIDDEN), np.float32))
    recurrent, out = weights[f"{way}_state"], weights[f"{way}_out"]
    logits = np.empty((time, many), np.float32)
    for t in range(time):
        z = gates[t] + h @ recurrent
        i, f, o = np.split(_sigmoid(z[:, : 3 * HIDDEN]), 3, axis=1)
        g = np.tanh(z[:, 3 * HIDDEN :])
        m = mask[t][:, None]
        new_c = np.where(m, f * c + i * g, c)
        tanh_c = np.tanh(new_c)
        new_h = np.where(m, o * tanh_c, h)
        if keep is not None:
            keep.append((h, c, i, f, o, g, tanh_c))
        h, c = new_h, new_c
        logits[t] = h @ out
    return logits, (h, c)


def _direction_gradients(weights: dict, way: str, x: np.ndarray, mask: np.ndarray, kept: list, error: np.ndarray, grads: dict) -> np.ndarray:
    """Gradients of one direction from the errors of its logits; returns that of its inputs."""
    recurrent, out = weights[f"{way}_state"], weights[f"{way}_out"]
    dz_all = np.zeros((*error.shape, 4 * HIDDEN), np.float32)
    dh, dc = np.zeros_like(kept[0][0]), np.zeros_like(kept[0][0])
    d_state, d_out = np.zeros_like(recurrent), np.zeros_like(out)
    for t in range(len(kept) - 1, -1, -1):
        h, c, i, f, o, g, tanh_c = kept[t]
        m = mask[t][:, None]
        d_out += error[t] @ np.where(m, o * tanh_c, h)
        dh = dh + error[t][:, None] * out
        dc_here = np.where(m, dc + dh * o * (1 - tanh_c**2), 0)
        dz = np.concatenate([dc_here * g * i * (1 - i), dc_here * c * f * (1 - f), np.where(m, dh * tanh_c, 0) * o * (1 - o), dc_here * i * (1 - g**2)], axis=1)
        dz_all[t] = dz
        d_state += h.T @ dz
        dh = np.where(m, 0, dh) + dz @ recurrent.T
        dc = np.where(m, dc_here * f, dc)
    grads[f"{way}_state"], grads[f"{way}_out"] = d_state, d_out
    grads[f"{way}_in"] = np.tensordot(x, dz_all, ((0, 1), (0, 1)))
    grads[f"{way}_bias"] = dz_all.sum((0, 1))
    return dz_all @ weights[f"{way}_in"].T


class Sequences:
    """Training sequences, padded to one length: ids of path tokens and words per block, plain numbers, labels."""

    def __init__(self, pages: list[tuple[list[list[int]], list[list[int]], np.ndarray, np.ndarray]]):
        self.time, self.many = max(len(page[0]) for page in pages), len(pages)
        self.place = np.concatenate([t * self.many + b for b, t in enumerate(np.arange(len(page[0])) for page in pages)])
        flat = [[ids for page in pages for ids in page[k]] for k in (0, 1)]
        self.ids = [np.concatenate([np.asarray(ids) for ids in lists]) for lists in flat]
        self.starts = [np.cumsum([0] + [len(ids) for ids in lists[:-1]]) for lists in flat]
        self.sizes = [np.array([len(ids) for ids in lists], np.float32)[:, None] for lists in flat]
        self.numbers = np.concatenate([page[2] for page in pages])
        self.labels = np.concatenate([page[3] for page in pages]).astype(np.float32)

    def gradients(self, weights: dict, deaf: float = 0.0, rng: np.random.Generator | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients; the words of a share `deaf` of the blocks are not heard, so that no label hangs on words alone."""
        path = np.tanh(pooled(weights["path"], self.ids[0], self.starts[0]))
        word = pooled(weights["word"], self.ids[1], self.starts[1]) / self.sizes[1]
        heard = (rng.random((len(word), 1)) >= deaf).astype(np.float32) if deaf else 1.0
        word = word * heard
        rows = np.concatenate([path, word, self.numbers], axis=1)
        x = np.zeros((self.time * self.many, rows.shape[1]), np.float32)
        x[self.place] = rows
        x = x.reshape(self.time, self.many, -1)
        mask = np.zeros(self.time * self.many, bool)
        mask[self.place] = True
        mask = mask.reshape(self.time, self.many)
        kept: dict[str, list] = {"ahead": [], "back": []}
        ahead, _ = run_direction(weights, "ahead", x, mask, keep=kept["ahead"])
        back, _ = run_direction(weights, "back", x[::-1], mask[::-1], keep=kept["back"])
        logits = (ahead + back[::-1]).reshape(-1)[self.place] + rows @ weights["direct"] + weights["bias"]
        share = _sigmoid(logits)
        loss = float(-np.mean(self.labels * np.log(share + 1e-7) + (1 - self.labels) * np.log(1 - share + 1e-7)))
        error = (share - self.labels) / len(share)
        placed = np.zeros(self.time * self.many, np.float32)
        placed[self.place] = error
        placed = placed.reshape(self.time, self.many)
        grads: dict[str, np.ndarray] = {"direct": error @ rows, "bias": np.array([error.sum()], np.float32)}
        dx = _direction_gradients(weights, "ahead", x, mask, kept["ahead"], placed, grads)
        dx = dx + _direction_gradients(weights, "back", x[::-1], mask[::-1], kept["back"], placed[::-1], grads)[::-1]
        d_rows = dx.reshape(self.time * self.many, -1)[self.place] + error[:, None] * weights["direct"]
        d_path, d_word = d_rows[:, :PATH_DIM] * (1 - path**2), d_rows[:, PATH_DIM : PATH_DIM + WORD_DIM] * heard / self.sizes[1]
        for name, d, k in (("path", d_path, 0), ("word", d_word, 1)):
            grads[name] = np.zeros_like(weights[name])
            np.add.at(grads[name], self.ids[k], np.repeat(d, self.sizes[k][:, 0].astype(int), axis=0))
        return loss, grads


def train(weights: dict, batches: list[Sequences], epochs: int, rate: float = 0.02, deaf: float = 0.5, seed: int = 0) -> list[float]:
    """Adam over the batches with a falling rate; the weights become their mean over the last steps. Returns the loss of each epoch."""
    mean, taken = {name: np.zeros_like(value) for name, value in weights.items()}, 0
    late, rng = 0.8 * epochs * len(batches), np.random.default_rng(seed)
    first = {name: np.zeros_like(value) for name, value in weights.items()}
    second = {name: np.zeros_like(value) for name, value in weights.items()}
    step, losses = 0, []
    for epoch in range(epochs):
        total = 0.0
        for batch in batches:
            loss, grads = batch.gradients(weights, deaf, rng)
            total += loss
            step += 1
            speed = rate * (1 - step / (epochs * len(batches) + 1))
            for name, grad in grads.items():
                grad = np.clip(grad, -1, 1)
                first[name] += 0.1 * (grad - first[name])
                second[name] += 0.01 * (grad**2 - second[name])
                size = np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8
                weights[name] -= (speed * first[name] / (1 - 0.9**step) / size).astype(np.float32)
            if step > late:
                taken += 1
                for name, value in weights.items():
                    mean[name] += (value - mean[name]) / taken
        losses.append(total / len(batches))
    weights.update(mean)
    return losses
