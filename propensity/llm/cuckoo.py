"""A cuckoo filter over 64-bit key hashes in numpy: bulk insert, delete and lookup.

A bucket holds four 16-bit fingerprints; a key may lie in either of two buckets, the second found from
the first and the fingerprint alone, so entries can be moved and deleted without their keys.  A lookup
has no false negatives as long as only keys that were inserted are deleted; about one absent key in
8,000 is reported per segment.  A filter that fills up gets a further, larger segment.
"""

from __future__ import annotations

import struct

import numpy as np

from propensity.llm.common import splits
from propensity.llm.textnp import U64, mix

SLOTS = 4
LOAD = 0.8
KICKS = 400


def _place(table: np.ndarray, bucket: np.ndarray, mark: np.ndarray, seed: int) -> bool:
    """Puts every mark into its bucket or the other one, moving others out if need be; False if some found no room."""
    rng = np.random.default_rng(seed)
    mask = len(table) - 1
    for attempt in range(KICKS):
        if not len(bucket):
            return True
        order = np.argsort(bucket, kind="stable")
        bucket, mark = bucket[order], mark[order]
        starts = splits(bucket)
        rank = np.arange(len(bucket)) - np.repeat(starts[:-1], np.diff(starts))
        free = table[bucket] == 0
        fit = free & (free.cumsum(axis=1) == (rank + 1)[:, None])
        placed = fit.any(axis=1)
        table[bucket[placed], fit[placed].argmax(axis=1)] = mark[placed]
        bucket, mark = bucket[~placed], mark[~placed]
        if attempt and len(bucket):
            # one entry of each full bucket makes room; it goes on to its other bucket
            one = splits(bucket)[:-1]
            slot = rng.integers(0, SLOTS, len(one))
            b = bucket[one]
            table[b, slot], mark[one] = mark[one], table[b, slot].copy()
        bucket = bucket ^ _other(mark, mask)
    return not len(bucket)


def _other(mark: np.ndarray, mask: int) -> np.ndarray:
    return (mix(mark.astype(U64)) & U64(mask)).astype(np.int64)


class CuckooFilter:
    def __init__(self, segments: list[np.ndarray] | None = None):
        self.segments = segments or []

    @staticmethod
    def _at(hashes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = np.maximum((hashes >> U64(48)).astype(np.uint16), 1)
        first = (hashes & U64(len(table) - 1)).astype(np.int64)
        return mark, first, first ^ _other(mark, len(table) - 1)

    def insert(self, hashes: np.ndarray) -> None:
        if not len(hashes):
            return
        if self.segments:
            last = self.segments[-1]
            if np.count_nonzero(last) + len(hashes) <= LOAD * last.size:
                trial = last.copy()
                mark, first, _ = self._at(hashes, trial)
                if _place(trial, first, mark, len(hashes)):
                    self.segments[-1] = trial
                    return
        room = max(len(hashes), self.segments[-1].size if self.segments else 0)
        buckets = 1 << max(1, int(np.ceil(np.log2(room / (LOAD * SLOTS)))))
        while True:
            trial = np.zeros((buckets, SLOTS), np.uint16)
            mark, first, _ = self._at(hashes, trial)
            if _place(trial, first, mark, len(hashes)):
                self.segments.append(trial)
                return
            if buckets > 64 * room:
                raise ValueError("more than eight keys share both buckets and the fingerprint; keys must be distinct")
            buckets *= 2

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        found = np.zeros(len(hashes), bool)
        for table in self.segments:
            mark, first, second = self._at(hashes, table)
            found |= (table[first] == mark[:, None]).any(axis=1) | (table[second] == mark[:, None]).any(axis=1)
        return found

    def delete(self, hashes: np.ndarray) -> None:
        """Removes one entry for each hash; the keys must have been inserted."""
        left = hashes
        for k in range(len(self.segments) - 1, -1, -1):
            table = self.segments[k] = self.segments[k].copy()
            side, waiting = 0, left
            missed = []
            while len(waiting):
                mark, *buckets = self._at(waiting, table)
                bucket = buckets[side]
                # entries of one bucket go one after the other, as two may have one fingerprint
                _, now = np.unique(bucket, return_index=True)
                hit = table[bucket[now]] == mark[now][:, None]
                there = hit.any(axis=1)
                table[bucket[now[there]], hit[there].argmax(axis=1)] = 0
                missed.append(waiting[now[~there]])
                waiting = np.delete(waiting, now)
                if not len(waiting) and side == 0:
                    side, waiting, missed = 1, np.concatenate(missed), []
            left = np.concatenate(missed) if missed else left[:0]
            if not len(left):
                return
        if len(left):
            raise KeyError(f"{len(left)} keys to delete are not in the filter")

    def __len__(self) -> int:
        return sum(int(np.count_nonzero(t)) for t in self.segments)

    def dump(self) -> bytes:
        return b"".join(struct.pack("<I", len(t)) + t.astype("<u2").tobytes() for t in self.segments)

    @classmethod
    def load(cls, blob: bytes | None) -> CuckooFilter:
        segments, at = [], 0
        while blob and at < len(blob):
            n, = struct.unpack_from("<I", blob, at)
            segments.append(np.frombuffer(blob, "<u2", n * SLOTS, at + 4).reshape(n, SLOTS))
            at += 4 + 2 * SLOTS * n
        return cls(segments)
