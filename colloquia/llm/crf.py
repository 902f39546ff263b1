"""Linear-chain conditional random field over word shapes, in numpy.

Tokens are runs without white space, described by character classes, digit and dot counts and
length, their own and their neighbours'. Training is full-batch gradient ascent by forward and
backward passes over the padded labelled table; decoding is Viterbi over batches of sequences.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LABELS = ("O", "email", "ip", "card", "phone")
K = len(LABELS)

#: Character classes of a byte, a bit each.
DIGIT, UPPER, LOWER, AT, DOT, DASH, PLUS, PAREN, OTHER, WIDE = (1 << i for i in range(10))
N_CLASSES = 10
N_DIGITS, N_DOTS, N_LENGTHS = 8, 4, 4
N_SHAPES = (1 << N_CLASSES) * N_DIGITS * N_DOTS * N_LENGTHS
#: Parts of a shape that own a weight: each class bit, absent or present, and the three counts.
N_PARTS = 2 * N_CLASSES + N_DIGITS + N_DOTS + N_LENGTHS


def byte_classes() -> np.ndarray:
    table = np.full(256, OTHER, np.uint16)
    table[128:] = WIDE
    for chars, bit in ((b"0123456789", DIGIT), (bytes(range(65, 91)), UPPER), (bytes(range(97, 123)), LOWER), (b"@", AT), (b".", DOT), (b"-", DASH), (b"+", PLUS), (b"()", PAREN)):
        table[list(chars)] = bit
    table[[9, 10, 11, 12, 13, 32]] = 0
    return table


CLASSES = byte_classes()
DIGIT_BUCKET = np.array([0, 1, 2, 3, 4, 5, 5, 5, 5, 5, 6, 6, 6, 6, 7], np.int64)  # 5 for 5-9, 6 for 10-13, 7 for 14 or more


def tokenize(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, shapes) of the tokens of utf-8 bytes."""
    classes = CLASSES[data]
    solid = np.concatenate([[False], classes > 0, [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, ends, starts
    bits = np.bitwise_or.reduceat(classes, starts).astype(np.int64)
    shapes = bits
    marked = bits & (DIGIT | DOT) != 0
    digits, dots = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    if marked.any():
        digits = np.diff(np.concatenate([np.zeros(1, np.int32), np.cumsum(classes == DIGIT, dtype=np.int32)])[np.stack([starts, ends])], axis=0)[0]
        dots = np.diff(np.concatenate([np.zeros(1, np.int32), np.cumsum(classes == DOT, dtype=np.int32)])[np.stack([starts, ends])], axis=0)[0]
    lengths = np.searchsorted([3, 8, 16], ends - starts, side="right")
    shapes = ((bits * N_DIGITS + DIGIT_BUCKET[np.minimum(digits, 14)]) * N_DOTS + np.minimum(dots, 3)) * N_LENGTHS + lengths
    return starts, ends, shapes


def shape_parts(shapes: np.ndarray) -> np.ndarray:
    """Indices of the weight of each part of each shape: (n, parts of a shape)."""
    lengths, rest = shapes % N_LENGTHS, shapes // N_LENGTHS
    dots, rest = rest % N_DOTS, rest // N_DOTS
    digits, bits = rest % N_DIGITS, rest // N_DIGITS
    flags = np.stack([2 * i + (bits >> i & 1) for i in range(N_CLASSES)], axis=-1)
    at = 2 * N_CLASSES
    return np.concatenate([flags, (at + digits)[..., None], (at + N_DIGITS + dots)[..., None], (at + N_DIGITS + N_DOTS + lengths)[..., None]], axis=-1)


@dataclass
class Crf:
    own: np.ndarray  # (N_SHAPES, K)
    before: np.ndarray  # weights of the previous token's shape
    after: np.ndarray
    moves: np.ndarray  # (K, K)
    first: np.ndarray  # (K,)

    def emissions(self, shapes: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Score of each label for each token; heads marks the first tokens of sequences."""
        e = self.own[shapes]
        inner = ~heads[1:]
        e[1:] += self.before[shapes[:-1]] * inner[:, None]
        e[:-1] += self.after[shapes[1:]] * inner[:, None]
        return e

    def decode(self, shapes: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Viterbi labels of all tokens.

        Where O leads every other label by more than any two moves can repay, the best path
        takes O; such tokens cut sequences into short independent ones, which run as batches of
        equal length.
        """
        n = len(shapes)
        labels = np.zeros(n, np.int8)
        if not n:
            return labels
        e = self.emissions(shapes, heads)
        lows = min(self.moves.min(), self.first.min())
        span = 2 * (max(self.moves.max(), self.first.max()) - lows)
        sure = e[:, 0] - e[:, 1:].max(axis=1) > span
        open_at = np.flatnonzero(~sure)
        if not len(open_at):
            return labels
        cut = np.concatenate([[True], (np.diff(open_at) > 1) | heads[open_at[1:]]])
        begin = np.flatnonzero(cut)
        size = np.diff(np.append(begin, len(open_at)))
        at = open_at[begin]
        left = np.where(heads[at], self.first[None].T, self.moves[0][:, None]).T  # from the sequence's start or from O
        follow = at + size
        has_next = (follow < n) & ~heads[np.minimum(follow, n - 1)]
        right = np.where(has_next[:, None], self.moves[:, 0], 0.0)
        for length in np.unique(size):
            which = np.flatnonzero(size == length)
            for some in np.array_split(which, max(1, len(which) * int(length) // 200_000)):
                labels[at[some][:, None] + np.arange(length)] = self._paths(e[at[some][:, None] + np.arange(length)], left[some], right[some])
        return labels

    def _paths(self, e: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        batch, length, _ = e.shape
        back = np.zeros((length, batch, K), np.int8)
        score = e[:, 0] + left
        for t in range(1, length):
            step = score[:, :, None] + self.moves
            back[t] = step.argmax(axis=1)
            score = step.max(axis=1) + e[:, t]
        out = np.zeros((batch, length), np.int8)
        best = (score + right).argmax(axis=1)
        for t in range(length - 1, -1, -1):
            out[:, t] = best
            best = back[t][np.arange(batch), best]
        return out


def logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def fit(sentences: list[tuple[np.ndarray, np.ndarray]], rounds: int = 150, rate: float = 0.5, l2: float = 0.002) -> Crf:
    """Train on (shapes, labels) pairs."""
    width, count = max(len(s) for s, _ in sentences), len(sentences)
    shapes, gold, live = np.zeros((count, width), np.int64), np.zeros((count, width), np.int64), np.zeros((count, width), bool)
    for i, (s, y) in enumerate(sentences):
        shapes[i, : len(s)], gold[i, : len(s)], live[i, : len(s)] = s, y, True
    parts = shape_parts(shapes)
    w = {"own": np.zeros((N_PARTS, K)), "before": np.zeros((N_PARTS, K)), "after": np.zeros((N_PARTS, K)), "moves": np.zeros((K, K)), "first": np.zeros(K)}
    speed = {k: np.zeros_like(v) for k, v in w.items()}
    eye = np.eye(K)
    target = eye[gold] * live[..., None]
    for _ in range(rounds):
        e = w["own"][parts].sum(axis=2)
        e[:, 1:] += w["before"][parts[:, :-1]].sum(axis=2)
        e[:, :-1] += w["after"][parts[:, 1:]].sum(axis=2) * live[:, 1:, None]
        forward = [e[:, 0] + w["first"]]
        for t in range(1, width):
            step = logsumexp(forward[-1][:, :, None] + w["moves"], 1) + e[:, t]
            forward.append(np.where(live[:, t, None], step, forward[-1]))
        total = logsumexp(forward[-1], 1)
        backward = [np.zeros((count, K))]
        pair = np.zeros((K, K))
        for t in range(width - 1, 0, -1):
            ahead = e[:, t] + backward[-1]
            joint = np.exp(forward[t - 1][:, :, None] + w["moves"] + ahead[:, None, :] - total[:, None, None]) * live[:, t, None, None]
            pair += joint.sum(axis=0)
            backward.append(np.where(live[:, t, None], logsumexp(w["moves"][None] + ahead[:, None, :], 2), backward[-1]))
        marginal = np.exp(np.stack(forward, 1) + np.stack(backward[::-1], 1) - total[:, None, None]) * live[..., None]
        rest = target - marginal
        grad = {k: np.zeros_like(v) for k, v in w.items()}
        for j in range(parts.shape[2]):
            np.add.at(grad["own"], parts[..., j], rest)
            np.add.at(grad["before"], parts[:, :-1, j], rest[:, 1:])
            np.add.at(grad["after"], parts[:, 1:, j], rest[:, :-1] * live[:, 1:, None])
        both = live[:, 1:]
        grad["moves"] = np.einsum("nti,ntj->ij", target[:, :-1] * both[..., None], target[:, 1:]) - pair
        grad["first"] = rest[:, 0].sum(axis=0)
        for k in w:
            g = grad[k] / count - l2 * w[k]
            speed[k] = 0.9 * speed[k] + g
            w[k] = w[k] + rate * speed[k]
    every = shape_parts(np.arange(N_SHAPES))
    tables = [w[k][every].sum(axis=1).astype(np.float32) for k in ("own", "before", "after")]
    return Crf(*tables, w["moves"].astype(np.float32), w["first"].astype(np.float32))
