"""What a Python worker remembers about words it has met: bounded, whatever the input."""

from __future__ import annotations

from collections.abc import Callable

#: Bytes that an entry takes besides its word and value, roughly.
ENTRY = 160


class Recent:
    """Bytes of recent words, in two generations of about ``budget`` bytes and one batch each.

    A word that is met again moves to the new generation; when that is full it becomes the old
    one, so frequent words stay and rare ones go.
    """

    def __init__(self, budget: int, make: Callable[[list[str]], list[bytes]]):
        self.budget, self.make, self.held = budget, make, 0
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def table(self, words: set[str]) -> dict[str, bytes]:
        """A table that has each of the words."""
        if self.held >= self.budget:
            self.old, self.new, self.held = self.new, {}, 0
        missing = list(words.difference(self.new))
        found = list(map(self.old.get, missing))
        unknown = [w for w, known in zip(missing, found, strict=True) if known is None]
        self.new.update((w, known) for w, known in zip(missing, found, strict=True) if known is not None)
        made = self.make(unknown)
        self.new.update(zip(unknown, made, strict=True))
        self.held += ENTRY * len(missing) + sum(map(len, missing)) + sum(map(len, made))
        return self.new

    def joined(self, texts: list[list[str]]) -> list[bytes]:
        """The joined bytes of each text's words."""
        known = self.table(set().union(*texts)).__getitem__
        return [b"".join(map(known, words)) for words in texts]
