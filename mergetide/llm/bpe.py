"""Byte-level BPE with a queue of merge ranks: a bucket of positions for each rank, and a three-level bitmap that gives the next rank.

Positions are those of a linked list of pieces. A merge only puts new pairs into buckets; pairs that a merge has made void stay where they
are and are skipped when their bucket comes up. So n bytes take O(n) queue steps of constant cost, which suits very long pre-tokens.
"""

from __future__ import annotations

import base64

import regex

#: Splits a text into pre-tokens; the fixed pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_ENTRIES, CACHE_BYTES = 1 << 17, 48


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Lines of base64 and rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


class RankQueue:
    """Buckets of positions by rank. push() and pop() take constant time whatever the number of ranks (up to 64 ** 3)."""

    def __init__(self, ranks: int):
        self.low, self.mid, self.top = [0] * (ranks // 64 + 1), [0] * (ranks // 4096 + 1), 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        if (at := self.buckets.get(rank)) is not None:
            at.append(position)
            return
        self.buckets[rank] = [position]
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def pop(self) -> tuple[int, list[int]]:
        """The least rank and its positions in order; rank -1 if there is none."""
        if not self.top:
            return -1, []
        a = (self.top & -self.top).bit_length() - 1
        b = a << 6 | (self.mid[a] & -self.mid[a]).bit_length() - 1
        rank = b << 6 | (self.low[b] & -self.low[b]).bit_length() - 1
        self.low[b] &= ~(1 << (rank & 63))
        if not self.low[b]:
            self.mid[a] &= ~(1 << (b & 63))
            if not self.mid[a]:
                self.top &= ~(1 << a)
        positions = self.buckets.pop(rank)
        positions.sort()
        return rank, positions


class Encoder:
    """Ids of texts. Short pre-tokens are kept with their ids, up to CACHE_ENTRIES of them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks, self.split, self.queue = ranks, regex.compile(pattern).findall, RankQueue(max(ranks.values(), default=0) + 1)
        self.cache: dict[str, list[int]] = {}

    def piece(self, raw: bytes) -> list[int]:
        get, q, n = self.ranks.get, self.queue, len(raw)
        if (whole := get(raw)) is not None:
            return [whole]
        parts: list[bytes | None] = [raw[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for i in range(n - 1):
            if (r := get(raw[i : i + 2])) is not None:
                q.push(r, i)
        while True:
            rank, positions = q.pop()
            if rank < 0:
                break
            for i in positions:
                j = after[i]
                if parts[i] is None or j >= n or get(parts[i] + parts[j]) != rank:
                    continue
                parts[i] += parts[j]
                parts[j] = None
                k = after[i] = after[j]
                if k < n:
                    before[k] = i
                    if (r := get(parts[i] + parts[k])) is not None:
                        q.push(r, i)
                if (h := before[i]) >= 0 and (r := get(parts[h] + parts[i])) is not None:
                    q.push(r, h)
        ids, i = [], 0
        while i < n:
            ids.append(get(parts[i]))
            i = after[i]
        return ids

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text, without special tokens; [] for an empty or null one."""
        if not text:
            return []
        out: list[int] = []
        cache, add = self.cache, out.extend
        for p in self.split(text):
            ids = cache.get(p)
            if ids is None:
                raw = p.encode("utf-8", "surrogatepass")
                ids = self.piece(raw)
                if len(raw) <= CACHE_BYTES:
                    if len(cache) >= CACHE_ENTRIES:
                        cache.clear()
                    cache[p] = ids
            add(ids)
        return out
