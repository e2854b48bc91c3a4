"""A bounded memory of what strings encode to."""

from __future__ import annotations

from collections.abc import Iterable


class Remembered(dict):
    """A dict that forgets what has not been asked for of late.

    Two generations of up to ``most`` entries: what is asked for stays or comes back
    into the newer one, which becomes the older one when it is full.
    """

    def __init__(self, most: int):
        super().__init__()
        self.most = most
        self.older: dict = {}

    def missing(self, keys: Iterable) -> list:
        """Those of the keys that neither generation has; the others are at hand afterwards."""
        absent = [key for key in keys if key not in self]
        older = self.older
        self.update((key, older[key]) for key in absent if key in older)
        return [key for key in absent if key not in older]

    def trim(self) -> None:
        """Drop the older generation if the newer one is full."""
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()
