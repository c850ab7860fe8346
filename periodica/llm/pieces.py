"""Merge-type pieces of a SentencePiece vocabulary: seeded merge-dropout and lossless decoding.

A text becomes one symbol per code point, blanks as the piece for a blank, one more blank in front.
An agenda holds the candidates, neighbouring symbols whose union is a piece; the best score goes
first, the leftmost of equals. When a candidate comes up, a keyed hash of its place decides, with
probability `dropout`, that it is skipped for good; else its symbols merge and new candidates with
the neighbours enter the agenda. As the decision depends on the place alone, it is taken when a
candidate enters: one that will be skipped is left out, which gives the same segmentation.

No piece has a blank behind another character, so texts fall into chunks, blanks and what follows,
that don't affect each other. Short chunks of many texts go through the agenda side by side, one
merge of each chunk per round, in numpy; a long chunk uses a heap.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import sentencepiece

from periodica.llm.setsketch import GOLDEN, mixed

U = np.uint64
BLANK = "▁"
NONE = np.iinfo(np.int32).max
LONG_CHUNK = 128
GROUP = 200_000


@dataclass
class Vocabulary:
    """Tables of a merge-type model; made from the bytes of its file."""

    model: bytes

    def __post_init__(self) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        own = [i for i in range(n) if not special[i] and not sp.is_byte(i)]
        ids = {names[i]: i for i in own}
        if any(BLANK in names[i].lstrip(BLANK) for i in own):
            raise ValueError("pieces with a blank inside are not supported")
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        if any(not sp.is_byte(int(i)) for i in self.byte_ids):
            raise ValueError("the vocabulary has no piece for some byte")
        self.content = [b""] * n
        for i in own:
            self.content[i] = names[i].replace(BLANK, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.content[i] = bytes([b])
        # symbols of single code points; a blank's own sign in a text is no blank
        single = {ord(p): i for p, i in ids.items() if len(p) == 1 and p != BLANK}
        single[0x20] = ids[BLANK]
        self.low = np.full(0x10000, -1, np.int32)
        for point, i in single.items():
            if point < 0x10000:
                self.low[point] = i
        high = sorted((point, i) for point, i in single.items() if point >= 0x10000)
        self.high = np.array([x[0] for x in high], np.int64)
        self.high_ids = np.array([x[1] for x in high], np.int32)
        self._merges(names, own, ids, [sp.get_score(i) for i in range(n)])

    def _merges(self, names: list[str], own: list[int], ids: dict, scores: list[float]) -> None:
        """A hash table from (left, right) to the union, and the rank of each piece by its score."""
        long = [i for i in own if len(names[i]) > 1]
        order = {x: r for r, x in enumerate(sorted({scores[i] for i in long}, reverse=True))}
        self.rank_of = np.full(len(names) + 1, NONE, np.int32)
        pairs = {}
        for i in long:
            self.rank_of[i] = order[scores[i]]
            name = names[i]
            for cut in range(1, len(name)):
                left, right = ids.get(name[:cut]), ids.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        self.bits = max(4, int(np.ceil(np.log2(8 * max(1, len(pairs))))))
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.unions = np.full(size, -1, np.int32)
        for key, value in pairs.items():
            at = key * GOLDEN % (1 << 64) >> (64 - self.bits)
            while self.keys[at] != -1:
                at = (at + 1) % size
            self.keys[at], self.unions[at] = key, value

    def union(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes; -1 where it makes none."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        at = (key.view(U) * U(GOLDEN) >> U(64 - self.bits)).astype(np.int64)
        found = self.keys[at]
        out = np.where(found == key, self.unions[at], -1)
        open_ = np.flatnonzero((found != key) & (found != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            found = self.keys[at[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.unions[at[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's union; NONE where it is no piece."""
        return self.rank_of[self.union(left, right)]

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """The piece of each code point; -1 where there is none."""
        out = self.low[np.minimum(points, 0xFFFF)]
        beyond = np.flatnonzero(points > 0xFFFF)
        if len(beyond):
            out[beyond] = -1
            if len(self.high):
                at = np.searchsorted(self.high, points[beyond]).clip(max=len(self.high) - 1)
                hit = self.high[at] == points[beyond]
                out[beyond[hit]] = self.high_ids[at[hit]]
        return out


def skipped(key, start, middle, end, dropout: float):
    """The keyed decision on the candidate that joins [start, middle) and [middle, end)."""
    place = (start.astype(U) << U(40)) ^ (middle.astype(U) << U(20)) ^ end.astype(U)
    place = mixed(mixed(place ^ key) + middle.astype(U) * U(GOLDEN))
    return (place >> U(11)).astype(float) * 2.0**-53 < dropout


class Segmenter:
    def __init__(self, vocabulary: Vocabulary, dropout: float) -> None:
        self.v, self.dropout = vocabulary, dropout

    def ranks(self, key, left, right, start, middle, end) -> np.ndarray:
        out = self.v.rank(left, right)
        out[(left < 0) | (right < 0)] = NONE
        if self.dropout > 0:
            on = np.flatnonzero(out != NONE)
            off = skipped(key[on], start[on], middle[on], end[on], self.dropout)
            out[on[off]] = NONE
        return out

    def agenda(self, key: np.uint64, sym: np.ndarray, first: int) -> list[tuple[int, int]]:
        """(start, piece) of one long chunk whose first symbol stands at `first`, by a heap."""
        n = len(sym)
        ids, end = sym.tolist(), list(range(first + 1, first + n + 1))
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        at = np.arange(first, first + n)
        rank = self.ranks(
            np.full(n - 1, key, U), sym[:-1], sym[1:], at[:-1], at[1:], at[1:] + 1
        ).tolist()
        heap = [(r, i, first + i + 2) for i, r in enumerate(rank) if r != NONE]
        heapq.heapify(heap)
        gone = [False] * n
        one = np.full(1, key, U)
        while heap:
            _, i, until = heapq.heappop(heap)
            j = after[i] if not gone[i] else n
            # a neighbour that has grown or gone makes a candidate stale
            if j >= n or end[j] != until:
                continue
            union = int(self.v.union(np.array([ids[i]]), np.array([ids[j]]))[0])
            ids[i], end[i], gone[j], after[i] = union, end[j], True, after[j]
            if after[i] < n:
                before[after[i]] = i
            for x in (before[i], i):
                if x < 0 or after[x] >= n:
                    continue
                y = after[x]
                place = (np.array([first + x]), np.array([end[x]]), np.array([end[y]]))
                [new] = self.ranks(one, np.array([ids[x]]), np.array([ids[y]]), *place).tolist()
                if new != NONE:
                    heapq.heappush(heap, (new, x, end[y]))
        return [(first + i, ids[i]) for i in range(n) if not gone[i]]

    def side_by_side(self, key, chunk, sym, start) -> tuple[np.ndarray, np.ndarray]:
        """(kept, piece) of all symbols after merging; `chunk` numbers the chunks in order, `key`
        has the key of each."""
        n = len(sym)
        kept, piece = np.ones(n, bool), sym.copy()
        begin, end = start.copy(), start + 1
        at = np.arange(n)
        rank = np.full(n, NONE, np.int32)
        inner = np.flatnonzero(chunk[1:] == chunk[:-1])
        rank[inner] = self.ranks(
            key[chunk[inner]], sym[inner], sym[inner + 1], begin[inner], end[inner], end[inner + 1]
        )
        while len(at):
            edge = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1])))
            length = np.diff(np.append(edge, len(at)))
            best = np.minimum.reduceat(rank.astype(np.int64) << 32 | np.arange(len(at)), edge)
            merging = best >> 32 != NONE
            p = best[merging] & 0xFFFFFFFF
            union = self.v.union(sym[p], sym[p + 1])
            piece[at[p]] = sym[p] = union
            kept[at[p + 1]] = False
            end[p] = end[p + 1]
            rank[p] = rank[p + 1]
            # finished chunks leave, as do the second halves of what merged
            stay = np.repeat(merging & (length > 2), length)
            mine = stay[p]
            stay[p + 1] = False
            p = p[mine]
            new = np.cumsum(stay)[p] - 1
            at, sym, begin, end, rank, chunk = (
                x[stay] for x in (at, sym, begin, end, rank, chunk)
            )
            if not len(at):
                break
            left = new - 1
            left = left[(left >= 0) & (chunk[left] == chunk[new])]
            right = new[(new + 1 < len(at))]
            right = right[chunk[right] == chunk[right + 1]]
            again = np.concatenate((left, right))
            if len(again):
                rank[again] = self.ranks(
                    key[chunk[again]], sym[again], sym[again + 1],
                    begin[again], end[again], end[again + 1],
                )
        return kept, piece

    def encode(self, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
        """The pieces of each text, with the key of each."""
        out: list[np.ndarray] = []
        first = size = 0
        for i, text in enumerate(texts):
            size += len(text) + 1
            if size >= GROUP or i == len(texts) - 1:
                out += self._group(texts[first : i + 1], keys[first : i + 1])
                first, size = i + 1, 0
        return out

    def _group(self, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
        joined = "".join(" " + t for t in texts if t)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.array([len(t) + 1 if t else 0 for t in texts])
        if not len(points):
            return [np.zeros(0, np.int32) for _ in texts]
        text_at = np.repeat(np.arange(len(texts)), sizes)
        first = np.cumsum(sizes) - sizes
        start = np.arange(len(points)) - first[text_at]
        sym = self.v.symbols(points)
        blank = points == 0x20
        opens = np.concatenate(([True], blank[1:] & ~blank[:-1])) | (start == 0)
        chunk = np.cumsum(opens) - 1
        edge = np.flatnonzero(opens)
        length = np.diff(np.append(edge, len(points)))
        key = keys[text_at[edge]]

        kept, piece = np.ones(len(points), bool), sym.copy()
        short = np.repeat(length <= LONG_CHUNK, length)
        kept[short], piece[short] = self.side_by_side(key, chunk[short], sym[short], start[short])
        for c in np.flatnonzero(length > LONG_CHUNK):
            at = slice(edge[c], edge[c] + length[c])
            kept[at] = False
            for place, own in self.agenda(key[c], sym[at], int(start[edge[c]])):
                i = edge[c] + place - int(start[edge[c]])
                kept[i], piece[i] = True, own

        alone = np.flatnonzero(kept & (piece < 0))
        if len(alone):
            # code points without a piece become the pieces of their bytes
            raw = [chr(points[i]).encode() for i in alone]
            times = kept.astype(np.int64)
            times[alone] = [len(x) for x in raw]
            flat, where = np.repeat(piece, times), np.repeat(text_at, times)
            at = np.repeat(np.cumsum(times)[alone] - times[alone], times[alone])
            step = np.concatenate([np.arange(len(x)) for x in raw])
            flat[at + step] = self.v.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        else:
            flat, where = piece[kept], text_at[kept]
        ends = np.searchsorted(where, np.arange(len(texts)), side="right")
        return [x.astype(np.int32) for x in np.split(flat, ends[:-1])]


def decode(vocabulary: Vocabulary, pieces) -> str:
    content = vocabulary.content
    raw = b"".join([content[i] for i in pieces])
    return raw.decode("utf-8", "replace")[1:]
