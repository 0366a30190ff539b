"""Signed feature hashing of tokens: vectors that need no model server."""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np

# Letter and digit runs; the same tokens as `text.analyze` gives on columns.
_TOKEN = re.compile(r"[^\W_]+")
# Tokens held at most twice: many of a large corpus come once, and a task that held them all would grow with its input.
_CACHE_LIMIT = 50_000


class HashEmbedder:
    """Callable from texts to L2-normed vectors; each token adds +1 or -1 to one place."""

    def __init__(self, dim: int):
        self.dim = dim
        self._places: dict[str, tuple[int, int]] = {}
        # the tokens before those; one that is asked for again moves back, so frequent tokens stay
        self._earlier: dict[str, tuple[int, int]] = {}

    def _place(self, token: str) -> tuple[int, int]:
        place = self._places.get(token)
        if place is None:
            if len(self._places) >= _CACHE_LIMIT:
                self._places, self._earlier = {}, self._places
            place = self._earlier.get(token)
            if place is None:
                digest = hashlib.md5(token.encode(), usedforsecurity=False).hexdigest()
                place = int(digest[:8], 16) % self.dim, 1 if int(digest[8], 16) < 8 else -1
            self._places[token] = place
        return place

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [self._vector(text) for text in texts]

    def _vector(self, text: str) -> np.ndarray:
        counts, places = [0] * self.dim, self._places
        for token in _TOKEN.findall(text.lower()):
            place, sign = places.get(token) or self._place(token)
            counts[place] += sign
        sums = np.array(counts, float)
        norm = math.sqrt(float(sums @ sums))
        return (sums / norm if norm else sums).astype(np.float32)


class HashEmbedderFactory:
    """Picklable maker of one embedder per task."""

    def __init__(self, dim: int):
        self.dim = dim

    def __call__(self) -> HashEmbedder:
        return HashEmbedder(self.dim)
