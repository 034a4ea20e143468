"""Results kept for strings that recur, as most words of a text do."""

from __future__ import annotations

from collections.abc import Callable, Iterable

LONG = 64  # longer strings seldom recur


class Memo(dict):
    """Values of ``make`` by string. About ``most`` are kept; beyond that, strings that were asked for
    only once go first. Strings longer than ``LONG`` stay only until the next ones are asked for, so
    what is kept takes at most ``most`` times a small size, whatever the texts."""

    def __init__(self, make: Callable[[list], Iterable], most: int = 250_000):
        super().__init__()
        self.make, self.most, self.again, self.long = make, most, set(), []

    def fill(self, lists: Iterable[list]) -> None:
        """Make sure that every string in ``lists`` has its value."""
        for key in self.long:
            self.pop(key, None)
        wanted = set().union(*lists)
        known = wanted & self.keys()
        missing = list(wanted - known)
        self.again |= known
        if len(self) + len(missing) > self.most:
            stay = self.again if len(self.again) < self.most // 2 else known
            kept = {key: self[key] for key in stay}
            self.clear()
            self.update(kept)
            self.again = known
        self.update(zip(missing, self.make(missing), strict=True))
        self.long = [key for key in missing if len(key) > LONG]
