"""Byte-pair pieces of a SentencePiece model, found through a suffix array.

The distinct words of a batch are concatenated and indexed by a suffix array. A
binary search gives each piece its range of suffixes, which is all its occurrences:
edges that say which piece any stretch of text is. The words are then relaxed: as long as two neighbouring stretches of a word make a
piece, the pair of the best score (the leftmost of equal ones) becomes one stretch.
What is no piece at the end falls back to bytes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np

SPACE = "▁"
PACK = 4  # characters in one 64-bit key
SUB_BATCH_CHARS = 1 << 20
#: Longer words are relaxed one by one with a queue.
LONG_WORD = 256
_NONE = np.int32(-1)


def _suffix_order(keys: np.ndarray, width: int) -> np.ndarray:
    """The order of all suffixes by their first ``width`` keys of ``PACK`` characters, by
    doubling: the ranks of a suffix and of the one where its known part ends are one key.
    Keys beyond the text are 0, as is the last one."""
    known = 1
    while True:
        order = np.argsort(keys)
        if known >= width:
            return order
        ordered = keys[order]
        ranks = np.empty(len(keys), np.uint64)
        ranks[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        keys = ranks << np.uint64(32)
        keys[: -PACK * known] |= ranks[PACK * known :]
        known *= 2


class PieceModel:
    """Pieces, scores and byte pieces; plain data that is shipped to the tasks."""

    def __init__(self, pieces: list[tuple[int, str, float]], byte_ids: list[int], token_bytes: list[bytes]):
        bad = [p for _, p, _ in pieces if SPACE in p[1:] and set(p) != {SPACE}]
        if bad:
            raise ValueError(f"pieces span words: {bad[:3]}")
        self.ids = np.array([i for i, _, _ in pieces], np.int32)
        self.byte_ids = np.array(byte_ids, np.int32)
        self.token_bytes = token_bytes
        order = np.unique([-s for _, _, s in pieces], return_inverse=True)[1]
        self.ranks = order.astype(np.int32)
        self.longest = max(len(p) for _, p, _ in pieces)
        self.alphabet = np.array(sorted({ord(c) for _, p, _ in pieces for c in p}), np.uint32)
        if len(self.alphabet) > 65_000:
            raise ValueError("the pieces have too many different characters")
        self.lengths = np.array([len(p) for _, p, _ in pieces])
        self.keys = -(-self.longest // PACK)
        codes = np.zeros((len(pieces), self.keys * PACK), np.uint64)
        for k, (_, p, _) in enumerate(pieces):
            codes[k, : len(p)] = self.codes(p)
        beyond = np.arange(self.keys * PACK)[None, :] >= self.lengths[:, None]
        self.low = self._pack(codes)
        self.high = self._pack(np.where(beyond, np.uint64(0xFFFF), codes))

    @classmethod
    def load(cls, path: str) -> PieceModel:
        import sentencepiece

        source = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids, token_bytes = [], [0] * 256, []
        for i in range(source.get_piece_size()):
            piece = source.id_to_piece(i)
            if source.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                token_bytes.append(bytes([int(piece[3:5], 16)]))
            elif source.is_control(i) or source.is_unknown(i):
                token_bytes.append(b"")
            else:
                pieces.append((i, piece, source.get_score(i)))
                token_bytes.append(piece.replace(SPACE, " ").encode())
        return cls(pieces, byte_ids, token_bytes)

    @staticmethod
    def _pack(codes: np.ndarray) -> list[np.ndarray]:
        """Keys that sort like the codes, most significant first."""
        groups = codes.reshape(len(codes), -1, PACK)
        return [
            sum(groups[:, k, j] << np.uint64(16 * (PACK - 1 - j)) for j in range(PACK)) for k in range(groups.shape[1])
        ]

    def codes(self, text: str) -> np.ndarray:
        """A number from 1 for each character of the pieces, one beyond them for others."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        found = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[found] == points, found + 1, len(self.alphabet) + 1).astype(np.uint64)

    def _edges(self, codes: np.ndarray) -> np.ndarray:
        """For each position and length less one, the piece there, or -1."""
        n = len(codes)
        padded = np.concatenate([codes, np.zeros(self.keys * PACK, np.uint64)])
        packed = sum(padded[j : len(padded) - PACK + 1 + j] << np.uint64(16 * (PACK - 1 - j)) for j in range(PACK))
        suffixes = [packed[PACK * k : PACK * k + n] for k in range(self.keys)]
        order = _suffix_order(suffixes[0], self.keys)
        ordered = [s[order] for s in suffixes]

        def search(wanted: list[np.ndarray], right: bool) -> np.ndarray:
            lo, hi = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), n, np.int64)
            while (lo < hi).any():
                middle = (lo + hi) // 2
                at = np.minimum(middle, n - 1)
                less, same = np.zeros(len(at), bool), np.ones(len(at), bool)
                for have, want in zip(ordered, wanted, strict=True):
                    value = have[at]
                    less |= same & (value < want)
                    same &= value == want
                before = (less | same if right else less) & (lo < hi)
                lo, hi = np.where(before, middle + 1, lo), np.where(before | (lo >= hi), hi, middle)
            return lo

        first, last = search(self.low, False), search(self.high, True)
        sizes = last - first
        piece = np.repeat(np.arange(len(sizes)), sizes)
        rank = np.repeat(first, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = order[rank]
        table = np.full((n + 1, self.longest), _NONE, np.int32)
        table[place, self.lengths[piece] - 1] = piece
        return table

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has. A word is what stands between
        spaces, its own spaces (all in front) written as ``SPACE``."""
        out = [(np.zeros(0, np.int32), np.zeros(0, np.int64))]
        first = 0
        while first < len(words):
            last, held = first, 0
            while last < len(words) and (last == first or held + len(words[last]) <= SUB_BATCH_CHARS):
                held += len(words[last]) + 1
                last += 1
            out.append(self._encode(words[first:last]))
            first = last
        ids, counts = (np.concatenate(p) for p in zip(*out, strict=True))
        return ids, counts

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(w) for w in words])
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        text = "".join(words)
        codes = np.zeros(int((sizes + 1).sum()), np.uint64)
        within = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        places = np.repeat(starts, sizes) + within
        codes[places] = self.codes(text)
        table = self._edges(codes)
        short = sizes <= LONG_WORD
        owner = np.repeat(np.arange(len(words)), sizes)
        chosen = short[owner]
        parts = [self._relax(table, owner[chosen], places[chosen])]
        for k in np.flatnonzero(~short):
            stretches = np.array(self._relax_long(table, int(starts[k]), int(sizes[k])))
            parts.append((np.full(len(stretches), k), stretches[:, 0], stretches[:, 1]))
        owner, begin, end = (np.concatenate(p) for p in zip(*parts, strict=True))
        by_place = np.argsort(begin)
        owner, begin, end = owner[by_place], begin[by_place], end[by_place]
        piece = table[begin, end - begin - 1]
        ids, sizes = self.ids[piece], np.ones(len(piece), np.int64)
        missing = np.flatnonzero(piece < 0)
        if len(missing):
            # characters that are no piece: as bytes
            char_at = np.zeros(len(codes), np.int64)
            char_at[places] = np.arange(len(text))
            spelt = [text[k].encode("utf-8", "replace") for k in char_at[begin[missing]].tolist()]
            sizes[missing] = [len(b) for b in spelt]
            ids = np.repeat(ids, sizes)
            ids[np.repeat(piece < 0, sizes)] = self.byte_ids[np.frombuffer(b"".join(spelt), np.uint8)]
        return ids, np.bincount(np.repeat(owner, sizes), minlength=len(words))

    def _rank(self, table: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The rank of the piece there; a very large number if there is none."""
        fits = length <= self.longest
        piece = table[begin, np.where(fits, length, 1) - 1]
        return np.where(fits & (piece >= 0), self.ranks[piece], np.iinfo(np.int32).max)

    def _relax(self, table: np.ndarray, owner: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Joins the best pair of every word at once until no word has one."""
        end = begin + 1
        done = []
        while len(owner):
            same = owner[1:] == owner[:-1]
            rank = np.full(len(owner), np.iinfo(np.int32).max)
            rank[:-1] = np.where(same, self._rank(table, begin[:-1], end[1:] - begin[:-1]), rank[:-1])
            firsts = np.flatnonzero(np.concatenate([[True], ~same]))
            best = np.minimum.reduceat(rank, firsts)
            counts = np.diff(np.append(firsts, len(owner)))
            going = np.repeat(best < np.iinfo(np.int32).max, counts)
            done.append((owner[~going], begin[~going], end[~going]))
            hit = np.flatnonzero((rank == np.repeat(best, counts)) & going)
            leftmost = hit[np.concatenate([[True], owner[hit][1:] != owner[hit][:-1]])] if len(hit) else hit
            end = end.copy()
            end[leftmost] = end[leftmost + 1]
            going[leftmost + 1] = False
            owner, begin, end = owner[going], begin[going], end[going]
        if not done:
            done = [(owner, begin, end)]
        return tuple(np.concatenate(p) for p in zip(*done, strict=True))

    def _relax_long(self, table: np.ndarray, start: int, size: int) -> list[tuple[int, int]]:
        """The same for one long word, with a queue of pairs."""
        end = {p: p + 1 for p in range(start, start + size)}
        before = {p: p - 1 for p in range(start + 1, start + size)}
        stop, queue = start + size, []

        def offer(p: int) -> None:
            middle = end[p]
            if middle < stop and (length := end[middle] - p) <= self.longest and (piece := table[p, length - 1]) >= 0:
                heapq.heappush(queue, (int(self.ranks[piece]), p, middle, end[middle]))

        for p in range(start, stop):
            offer(p)
        while queue:
            _, p, middle, last = heapq.heappop(queue)
            if end.get(p) != middle or end.get(middle) != last:
                continue
            end[p] = last
            del end[middle]
            if last < stop:
                before[last] = p
            offer(p)
            if p > start:
                offer(before[p])
        return sorted(end.items())


class Encoder:
    """Encodes texts; remembers words up to a bound."""

    def __init__(self, model: PieceModel, remember: int = 1 << 19):
        self.model, self.remember = model, remember
        sizes = np.array([len(b) for b in model.token_bytes])
        self.byte_starts = np.concatenate([[0], np.cumsum(sizes)])
        self.bytes = np.frombuffer(b"".join(model.token_bytes) + b"\0", np.uint8)
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, words: Iterable[str]) -> None:
        new = list(words)
        found, counts = self.model.encode_words([self._written(w) for w in new])
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
        self.flat = np.concatenate([self.flat, found])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])

    @staticmethod
    def _written(word: str) -> str:
        return SPACE + word.replace(" ", SPACE)

    @staticmethod
    def _words(text: str) -> list[str]:
        """The text cut before each run of spaces, less one space each; a space in
        front of the text is supplied."""
        text = text.replace(SPACE, " ")
        if not text:
            return []
        parts = text.split(" ")
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return parts
        out, spaces = [], 0
        for k, part in enumerate(parts):
            if part or k + 1 == len(parts):
                out.append(" " * spaces + part)
                spaces = 0
            else:
                spaces += 1
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offsets of the texts in them."""
        parts = [self._words(t) for t in texts]
        flat = [w for p in parts for w in p]
        missing = [w for w in dict.fromkeys(flat) if w not in self.number]
        if missing and len(self.number) + len(missing) > self.remember:
            self._clear()
            missing = list(dict.fromkeys(flat))
        if missing:
            self._learn(missing)
        index = np.fromiter(map(self.number.__getitem__, flat), np.int64, len(flat))
        sizes = self.starts[index + 1] - self.starts[index]
        totals = np.concatenate([[0], np.cumsum(sizes)])
        places = np.repeat(self.starts[index] - totals[:-1], sizes) + np.arange(totals[-1])
        ids = self.flat[places]
        return ids, totals[np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts again: pieces joined, without the space supplied in front."""
        begin = self.byte_starts[ids]
        sizes = self.byte_starts[ids + 1] - begin
        totals = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.bytes[np.repeat(begin - totals[:-1], sizes) + np.arange(totals[-1])].tobytes()
        edges = totals[offsets].tolist()
        return [flat[a:b].removeprefix(b" ").decode("utf-8", "replace") for a, b in zip(edges, edges[1:], strict=False)]
