"""A cuckoo filter whose slots also point at the stored keys."""

from __future__ import annotations

from array import array


class CuckooIndex:
    """Live digests with a value each.

    Every bucket has four slots of a 16-bit fingerprint. A key lives in one of
    two buckets; a fingerprint hit is verified against the key stored for that
    slot, so a false hit never counts. When an insertion finds no place after
    ``kicks`` moves, the table is doubled and rebuilt from the stored keys.
    Keys are digests of at least 12 uniformly distributed bytes.
    """

    SLOTS = 4

    def __init__(self, capacity: int = 4096, kicks: int = 200):
        self.kicks = kicks
        self.keys: list = []
        self.values: list = []
        self.free: list[int] = []
        buckets = 1
        while buckets * self.SLOTS * 0.9 < capacity:
            buckets *= 2
        self._allocate(buckets)

    def __len__(self) -> int:
        return len(self.keys) - len(self.free)

    def _allocate(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints = array("H", bytes(2 * buckets * self.SLOTS))
        self.stored = array("q", bytes(8 * buckets * self.SLOTS))

    def _home(self, key: bytes) -> tuple[int, int]:
        return int.from_bytes(key[:2], "little") or 1, int.from_bytes(key[4:12], "little") & self.mask

    def _other(self, bucket: int, fingerprint: int) -> int:
        return bucket ^ (fingerprint * 0x5BD1E995 & self.mask)

    def _slot(self, key: bytes) -> int:
        """The slot that holds ``key``, or -1."""
        fingerprint, first = self._home(key)
        prints, stored, keys = self.prints, self.stored, self.keys
        for bucket in (first, self._other(first, fingerprint)):
            base = bucket * 4
            for slot in (base, base + 1, base + 2, base + 3):
                if prints[slot] == fingerprint and keys[stored[slot]] == key:
                    return slot
        return -1

    def find(self, key: bytes):
        """The value of a live key, else None."""
        slot = self._slot(key)
        return None if slot < 0 else self.values[self.stored[slot]]

    def insert(self, key: bytes, value) -> None:
        """Adds a key or replaces its value."""
        slot = self._slot(key)
        if slot >= 0:
            self.values[self.stored[slot]] = value
            return
        if self.free:
            at = self.free.pop()
            self.keys[at], self.values[at] = key, value
        else:
            at = len(self.keys)
            self.keys.append(key)
            self.values.append(value)
        if not self._place(key, at):
            self._grow()

    def _place(self, key: bytes, at: int) -> bool:
        fingerprint, bucket = self._home(key)
        prints, stored = self.prints, self.stored
        for b in (bucket, self._other(bucket, fingerprint)):
            for slot in range(b * 4, b * 4 + 4):
                if not prints[slot]:
                    prints[slot], stored[slot] = fingerprint, at
                    return True
        for kick in range(self.kicks):
            slot = bucket * 4 + (kick + fingerprint) % 4
            fingerprint, prints[slot] = prints[slot], fingerprint
            at, stored[slot] = stored[slot], at
            bucket = self._other(bucket, fingerprint)
            for free in range(bucket * 4, bucket * 4 + 4):
                if not prints[free]:
                    prints[free], stored[free] = fingerprint, at
                    return True
        return False

    def _grow(self) -> None:
        """Doubles the table until every stored key has a place."""
        gone = set(self.free)
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self._allocate(buckets)
            if all(self._place(k, i) for i, k in enumerate(self.keys) if i not in gone):
                return

    def delete(self, key: bytes) -> bool:
        """Removes a live key; False if it was not there."""
        slot = self._slot(key)
        if slot < 0:
            return False
        at = self.stored[slot]
        self.prints[slot] = 0
        self.keys[at] = self.values[at] = None
        self.free.append(at)
        return True

    def items(self):
        gone = set(self.free)
        for i, key in enumerate(self.keys):
            if i not in gone:
                yield key, self.values[i]
