"""What runs around an embedding model inside a task: batches, tries, order and count of vectors."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

# A call gives the vectors in the order of the texts, or items {"index": i, "embedding": [...]} in any order.
Embedder = Callable[[list[str]], Sequence[Sequence[float]] | Sequence[dict]]


class TransportError(Exception):
    """A status or connection error of the model; worth another try. Any other error is not."""


@dataclass(frozen=True)
class RetryPolicy:
    # Three tries, waits of 2 s and 4 s.
    tries: int = 3
    delay: float = 2.0
    sleep: Callable[[float], None] = time.sleep

    def call(self, embed: Embedder, texts: list[str]) -> Sequence[Sequence[float]]:
        for attempt in range(1, self.tries + 1):
            try:
                return embed(texts)
            except TransportError:
                if attempt == self.tries:
                    raise
                self.sleep(self.delay * attempt)
        raise ValueError("a retry policy needs at least one try")


def in_index_order(items: Sequence) -> Sequence[Sequence[float]]:
    """Vectors of a model response: items are ordered by their index, bare vectors are in order already."""
    if len(items) and isinstance(items[0], dict):
        return [item["embedding"] for item in sorted(items, key=lambda item: item["index"])]
    return items


def embed_document(texts: list[str], embed: Embedder, batch: int, retry: RetryPolicy) -> list[Sequence[float]]:
    """Vectors of all texts of one document, or an error: a document is embedded whole or not at all."""
    vectors: list[Sequence[float]] = []
    for at in range(0, len(texts), batch):
        vectors.extend(in_index_order(retry.call(embed, texts[at : at + batch])))
    if len(vectors) != len(texts):
        raise ValueError(f"{len(vectors)} vectors for {len(texts)} texts")
    return vectors
