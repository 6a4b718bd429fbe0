"""Marginal likelihood of words over all segmentations into pieces of a fixed public vocabulary.

A word is a path through a lattice whose arcs are vocabulary pieces. The forward recursion sums the
probability of every path in log space. Words of equal length are worked through together with numpy:
a substring is found in the vocabulary by its polynomial hash, so no Python loop runs over the words.
Several models (languages) share one pass.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import numpy as np

BASE, MIX = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xD6E8FEB86659FD93)
SLOT_BITS = 18


def public_pieces(path: str) -> tuple[list[str], np.ndarray]:
    """The pieces of a SentencePiece vocabulary file and their published scores.

    Byte pieces become ``<0x..>``; control pieces and unused ones (score below -1e8) are left out.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) and (sp.is_byte(i) or sp.get_score(i) > -1e8)]
    return [sp.id_to_piece(i) for i in kept], np.array([sp.get_score(i) for i in kept])


class Lattice:
    """Finds pieces in words. ``pieces``: the vocabulary; byte pieces ``<0x00>`` ... take part only where a
    character is no piece by itself (their log probabilities add up over its UTF-8 bytes)."""

    def __init__(self, pieces: Sequence[str]):
        self.pieces = list(pieces)
        self.byte_piece = np.full(256, -1, np.int64)
        ordinary = []
        for i, p in enumerate(self.pieces):
            if len(p) == 6 and p.startswith("<0x"):
                self.byte_piece[int(p[3:5], 16)] = i
            else:
                ordinary.append(i)
        self.longest = max((len(self.pieces[i]) for i in ordinary), default=1)
        self.power = np.multiply.accumulate(np.array([1] + [BASE] * self.longest, np.uint64))
        self.size = 1 << SLOT_BITS
        self.slot_key = np.zeros(self.size, np.uint64)
        self.slot_piece = np.full(self.size, -1, np.int32)
        for i in ordinary:
            h = 0
            for c in self.pieces[i]:
                h = (h * int(BASE) + ord(c) + 1) % (1 << 64)
            s = (h * int(MIX)) % (1 << 64) >> (64 - SLOT_BITS)
            while self.slot_piece[s] >= 0:
                s = (s + 1) % self.size
            self.slot_key[s], self.slot_piece[s] = h, i
        # an empty slot that holds key 0 must never be a hit: its piece is -1

    def find(self, h: np.ndarray) -> np.ndarray:
        slot = (h * MIX) >> np.uint64(64 - SLOT_BITS)
        slot = slot.astype(np.int64)
        got = self.slot_piece[slot]
        wrong = np.flatnonzero((self.slot_key[slot] != h) & (got >= 0))
        got[self.slot_key[slot] != h] = -1
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) % self.size
            s = slot[wrong]
            piece, hit = self.slot_piece[s], self.slot_key[s] == h[wrong]
            got[wrong] = np.where(hit, piece, -1)
            wrong = wrong[~hit & (piece >= 0)]
        return got

    def arcs(self, codes: np.ndarray) -> np.ndarray:
        """piece[j, k-1, word]: the piece that covers characters j-k to j, or -1."""
        n, length = codes.shape
        most = min(self.longest, length)
        prefix = np.zeros((length + 1, n), np.uint64)
        for j in range(length):
            prefix[j + 1] = prefix[j] * BASE + (codes[:, j].astype(np.uint64) + np.uint64(1))
        found = np.full((length + 1, most, n), -1, np.int32)
        for j in range(1, length + 1):
            k = min(most, j)
            starts = prefix[j - k:j][::-1]  # of lengths 1, 2, ... k
            h = prefix[j] - starts * self.power[1:k + 1, None]
            found[j, :k] = self.find(h.ravel()).reshape(k, n)
        return found

    def single(self, codes: np.ndarray, found: np.ndarray, logp: np.ndarray) -> dict[int, np.ndarray]:
        """Log probability of the characters that are no piece, spelt in bytes."""
        missing = codes.T[found[1:, 0] < 0]
        return {int(c): logp[self.byte_piece[np.frombuffer(chr(c).encode("utf-8", "surrogatepass"), np.uint8)]].sum(0) for c in np.unique(missing)} if len(missing) else {}

    def _arc_logp(self, codes, found, logp):
        """For each end j: log probabilities (k, n, models) of the arcs that end there."""
        padded = np.vstack([logp, np.full((1, logp.shape[1]), -np.inf)])
        spelt = self.single(codes, found, logp)
        for j in range(1, found.shape[0]):
            k = min(found.shape[1], j)
            lp = padded[found[j, :k]]
            if spelt:
                for w in np.flatnonzero(found[j, 0] < 0):
                    lp[0, w] = spelt[int(codes[w, j - 1])]
            yield j, k, lp

    def _buckets(self, words: Sequence[str], models: int, most: int = 1 << 21):
        """Words of equal length, few enough that their arcs in all models are about ``most`` numbers."""
        by_length = defaultdict(list)
        for i, w in enumerate(words):
            by_length[len(w)].append(i)
        for length, ids in by_length.items():
            if length:
                step = max(1, most // (length * min(length, self.longest) * models))
                for a in range(0, len(ids), step):
                    part = ids[a:a + step]
                    codes = np.frombuffer("".join([words[i] for i in part]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), length)
                    yield np.array(part), codes

    def score(self, words: Sequence[str], logp: np.ndarray) -> np.ndarray:
        """log P(word) (natural), one column per model; the empty word scores 0."""
        out = np.zeros((len(words), logp.shape[1]))
        for ids, codes in self._buckets(words, logp.shape[1]):
            found = self.arcs(codes)
            alpha = np.full((codes.shape[1] + 1, len(ids), logp.shape[1]), -np.inf)
            alpha[0] = 0
            for j, k, lp in self._arc_logp(codes, found, logp):
                lp = lp + alpha[j - k:j][::-1]
                top = lp.max(0)
                alpha[j] = top + np.log(np.exp(lp - top).sum(0))
            out[ids] = alpha[-1]
        return out

    def expected(self, words: Sequence[str], weight: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations, weighted. weight: (words, models)."""
        total = np.zeros(logp.shape)
        for ids, codes in self._buckets(words, logp.shape[1]):
            found, length, n, models = self.arcs(codes), codes.shape[1], len(ids), logp.shape[1]
            alpha = np.full((length + 1, n, models), -np.inf)
            alpha[0] = 0
            arcs = {}
            for j, k, lp in self._arc_logp(codes, found, logp):
                arcs[j] = lp
                reach = lp + alpha[j - k:j][::-1]
                top = reach.max(0)
                alpha[j] = top + np.log(np.exp(reach - top).sum(0))
            beta = np.zeros((length + 1, n, models))
            for i in range(length - 1, -1, -1):  # arcs that start at i, by where they end
                steps = range(min(found.shape[1], length - i))
                reach = np.stack([arcs[i + 1 + k][k] + beta[i + 1 + k] for k in steps])
                arcs.pop(i + 1 + found.shape[1], None)
                top = reach.max(0)
                use = np.exp(reach - top)
                beta[i] = top + np.log(use.sum(0))
                use *= np.exp(top + alpha[i] - alpha[length]) * weight[ids]
                piece = np.stack([found[i + 1 + k, k] for k in steps])
                hit = piece >= 0
                for m in range(models):
                    total[:, m] += np.bincount(piece[hit], use[..., m][hit], minlength=len(logp))
                spelt = np.flatnonzero(~hit[0])  # characters spelt in bytes
                for c, of in zip(*_groups(codes[spelt, i])):
                    for byte in chr(c).encode("utf-8", "surrogatepass"):
                        total[self.byte_piece[byte]] += use[0, spelt[of]].sum(0)
        return total


def _groups(codes: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Distinct codes, and the places of each."""
    order = np.argsort(codes, kind="stable")
    value, first = np.unique(codes[order], return_index=True)
    return value.tolist(), np.split(order, first[1:]) if len(value) else []


def normalised(counts: np.ndarray, smooth: float) -> np.ndarray:
    """Natural log probabilities of pieces from (expected) counts, each model by itself."""
    c = counts + smooth
    return np.log(c) - np.log(c.sum(0))
