"""A bounded memory of strings already worked out, in two generations."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable
from typing import Any


class Memo:
    """Values of ``work`` by string; holds ``most`` strings of up to ``longest`` characters at most.

    New strings enter the young half. When it is full it becomes the old half,
    so strings that come up again and again stay and rare ones go.
    """

    def __init__(self, work: Callable[[list[str]], Iterable[Any]], most: int = 400_000, longest: int = 64):
        self.work, self.half, self.longest = work, most // 2, longest
        self.young: dict[str, Any] = {}
        self.old: dict[str, Any] = {}

    def of(self, wanted: set[str]) -> dict[str, Any]:
        """A mapping that has every wanted string; valid until the next call."""
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        fresh = []
        for key in wanted.difference(young):
            if key in old:
                young[key] = old[key]
            else:
                fresh.append(key)
        if not fresh:
            return young
        gc.disable()  # it would walk over all that is remembered, time and again
        try:
            found = dict(zip(fresh, self.work(fresh), strict=True))
        finally:
            gc.enable()
        long = [key for key in fresh if len(key) > self.longest]
        if not long:
            young.update(found)
            return young
        young.update((key, value) for key, value in found.items() if len(key) <= self.longest)
        return young | {key: found[key] for key in long}
