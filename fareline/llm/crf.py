"""A linear-chain conditional random field over word shapes, in numpy.

A token's features are its shape (digit count, letters, marks; one code for each
combination) with that shape's single attributes, and the coarse class of its left and
right neighbours. Training maximises the penalised likelihood of short labelled
sequences; decoding runs Viterbi over a batch of sequences at once, step by step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from fareline.llm.common import byte_table

LABELS = ("O", "email", "ip", "card", "phone")
K = len(LABELS)

# shape attributes and their numbers of values; a shape code has them in mixed radix
ATTRIBUTES = {"digits": 6, "letters": 2, "at": 2, "dots": 4, "hyphens": 4, "plus": 2, "parens": 2, "other": 2}
RADIX = tuple(ATTRIBUTES.values())
SHAPES = int(np.prod(RADIX))
CLASSES = 4

_DIGIT = byte_table(range(0x30, 0x3A))
_LETTER = byte_table([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
_MARKS = {"at": 0x40, "dots": 0x2E, "hyphens": 0x2D}
_PARENS = byte_table(b"()")
_TRAILING = byte_table(b".,;:!?")


def shapes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Shape codes of tokens; one mark that ends a token isn't part of its shape."""
    if not len(starts):
        return np.zeros(0, np.int64)
    stop = ends - (_TRAILING[buf[ends - 1]] & (ends - starts > 1))
    odd = np.flatnonzero(_token_has(~_LETTER, buf, starts, stop))
    code = np.full(len(starts), _code(np.zeros(1, np.int64), letters=1)[0])
    if len(odd):
        size = stop[odd] - starts[odd]
        last = np.cumsum(size)
        at = np.arange(last[-1]) + np.repeat(starts[odd] - (last - size), size)
        b, first = buf[at], last - size

        def count(mask):
            return np.add.reduceat(mask.astype(np.int64), first)

        digits = count(_DIGIT[b])
        letters = count(_LETTER[b])
        marks = {k: count(b == v) for k, v in _MARKS.items()}
        parens = count(_PARENS[b])
        plus = (buf[starts[odd]] == 0x2B).astype(np.int64)
        rest = size - digits - letters - sum(marks.values()) - parens - plus
        code[odd] = _code(
            np.searchsorted([1, 4, 5, 10, 16], digits, side="right"),
            letters=letters > 0, at=marks["at"] > 0, dots=np.minimum(marks["dots"], 3), hyphens=np.minimum(marks["hyphens"], 3), plus=plus, parens=parens > 0, other=rest > 0,
        )
    return code


def _token_has(table, buf, starts, stop) -> np.ndarray:
    seen = np.concatenate([[0], np.cumsum(table[buf], dtype=np.int64)])
    return seen[stop] > seen[starts]


def _code(digits, **values) -> np.ndarray:
    out = np.zeros(len(digits), np.int64)
    for name, n in ATTRIBUTES.items():
        v = digits if name == "digits" else np.asarray(values.get(name, 0), np.int64)
        out = out * n + v
    return out


def attribute_table() -> np.ndarray:
    """One-hot attribute rows of every shape code."""
    values = np.stack(np.unravel_index(np.arange(SHAPES), RADIX), axis=1)
    out = np.zeros((SHAPES, sum(RADIX)), np.float32)
    start = np.concatenate([[0], np.cumsum(RADIX)[:-1]])
    out[np.arange(SHAPES)[:, None], values + start] = 1
    return out


PLAIN = int(_code(np.zeros(1, np.int64), letters=1)[0])


def coarse(code: np.ndarray) -> np.ndarray:
    """0 outside, 1 a plain word, 2 with digits, 3 other."""
    digits = code // (SHAPES // RADIX[0])
    return np.where(code == PLAIN, 1, np.where(digits > 0, 2, 3))


@dataclass
class Crf:
    emit: np.ndarray  # [shape, label]
    left: np.ndarray  # [class, label]
    right: np.ndarray
    start: np.ndarray  # [label]
    step: np.ndarray  # [from, to]

    def scores(self, code: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Emission scores; ``starts`` are the sequences' first tokens."""
        c = coarse(code)
        before = np.concatenate([[0], c[:-1]])
        before[starts] = 0
        after = np.concatenate([c[1:], [0]])
        after[starts[1:] - 1] = 0
        return self.emit[code] + self.left[before] + self.right[after]

    def decode(self, code: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Best labels of all tokens (Viterbi); longer sequences first, so the running ones are a prefix."""
        n = len(code)
        if n == 0:
            return np.zeros(0, np.int8)
        score = np.ascontiguousarray(self.scores(code, starts).astype(np.float32).T)
        length = np.diff(np.append(starts, n))
        order = np.argsort(-length, kind="stable")
        first, length = starts[order], length[order]
        running = np.searchsorted(-length, -np.arange(length[0]), side="left")
        back = np.zeros((K, n), np.int8)
        alpha = score[:, first] + self.start[:, None].astype(np.float32)
        step = self.step.astype(np.float32)
        final = np.zeros((K, len(first)), np.float32)
        for t in range(1, int(length[0])):
            m = int(running[t])
            final[:, m : alpha.shape[1]] = alpha[:, m:]
            alpha = alpha[:, :m]
            best = alpha[0] + step[0][:, None]
            came = np.zeros((K, m), np.int8)
            for i in range(1, K):
                c = alpha[i] + step[i][:, None]
                better = c > best
                np.copyto(best, c, where=better)
                came[better] = i
            at = first[:m] + t
            back[:, at] = came
            alpha = best + score[:, at]
        final[:, : alpha.shape[1]] = alpha
        label = np.zeros(n, np.int8)
        now = final.argmax(axis=0).astype(np.int8)
        for t in range(int(length[0]) - 1, -1, -1):
            m = int(running[t])
            at = first[:m] + t
            label[at] = now[:m]
            if t:
                now[:m] = back[now[:m], at]
        return label


def train(sequences: list[tuple[np.ndarray, np.ndarray]], rounds: int = 150, penalty: float = 0.02, rate: float = 0.15) -> Crf:
    """Fit on (shape codes, labels) sequences by Adam on the exact gradient; none give a field of all O."""
    attrs = attribute_table()
    p = {
        "shape": np.zeros((SHAPES, K)), "attr": np.zeros((attrs.shape[1], K)), "left": np.zeros((CLASSES, K)),
        "right": np.zeros((CLASSES, K)), "start": np.zeros(K), "step": np.zeros((K, K)),
    }
    if not sequences:
        p["start"][0] = 1.0
        p["step"][:, 0] = 1.0
        return Crf(attrs @ p["attr"] + p["shape"], p["left"], p["right"], p["start"], p["step"])
    width = max(len(c) for c, _ in sequences)
    size = len(sequences)
    code, label, mask = np.zeros((size, width), np.int64), np.zeros((size, width), np.int64), np.zeros((size, width), bool)
    for i, (c, y) in enumerate(sequences):
        code[i, : len(c)], label[i, : len(c)], mask[i, : len(c)] = c, y, True
    cls = np.where(mask, coarse(code), 0)
    before = np.concatenate([np.zeros((size, 1), np.int64), cls[:, :-1]], axis=1)
    after = np.concatenate([cls[:, 1:], np.zeros((size, 1), np.int64)], axis=1)
    gold = np.eye(K)[label] * mask[..., None]
    gold_step = np.zeros((K, K))
    both = mask[:, 1:]
    np.add.at(gold_step, (label[:, :-1][both], label[:, 1:][both]), 1)
    m1 = {k: np.zeros_like(v) for k, v in p.items()}
    m2 = {k: np.zeros_like(v) for k, v in p.items()}
    used, inverse = np.unique(code[mask], return_inverse=True)
    for r in range(1, rounds + 1):
        emit = attrs @ p["attr"] + p["shape"]
        e = emit[code] + p["left"][before] + p["right"][after]
        alpha = np.zeros((size, width, K))
        beta = np.zeros((size, width, K))
        alpha[:, 0] = e[:, 0] + p["start"]
        for t in range(1, width):
            a = np.logaddexp.reduce(alpha[:, t - 1, :, None] + p["step"], axis=1) + e[:, t]
            alpha[:, t] = np.where(mask[:, t, None], a, alpha[:, t - 1])
        total = np.logaddexp.reduce(alpha[:, -1], axis=1)
        expected_step = np.zeros((K, K))
        for t in range(width - 2, -1, -1):
            on = mask[:, t + 1]
            follow = p["step"] + (e[:, t + 1] + beta[:, t + 1])[:, None, :]
            beta[:, t] = np.where(on[:, None], np.logaddexp.reduce(follow, axis=2), 0.0)
            expected_step += np.exp(alpha[on, t, :, None] + follow[on] - total[on, None, None]).sum(axis=0)
        post = np.exp(alpha + beta - total[:, None, None]) * mask[..., None]
        diff = gold - post
        flat = diff[mask]
        by_shape = np.zeros((SHAPES, K))
        by_used = np.zeros((len(used), K))
        np.add.at(by_used, inverse, flat)
        by_shape[used] = by_used
        g = {"shape": by_shape, "attr": attrs.T @ by_shape, "start": diff[:, 0].sum(axis=0), "step": gold_step - expected_step}
        for name, context in (("left", before), ("right", after)):
            g[name] = np.zeros((CLASSES, K))
            np.add.at(g[name], context[mask], flat)
        for k, v in p.items():
            d = g[k] - penalty * v * size / 100
            m1[k] = 0.9 * m1[k] + 0.1 * d
            m2[k] = 0.999 * m2[k] + 0.001 * d * d
            v += rate * (m1[k] / (1 - 0.9**r)) / (np.sqrt(m2[k] / (1 - 0.999**r)) + 1e-8)
    return Crf(attrs @ p["attr"] + p["shape"], p["left"], p["right"], p["start"], p["step"])
