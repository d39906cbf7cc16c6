"""Operator 1: token counts by heap-and-linked-list byte pair merging.

The symbols of a word are a doubly linked list, the ranked adjacent pairs a heap. The lowest rank is popped
and merged again and again; the count is the number of first symbols less the merges. No id leaves a word.

Rows are independent, so there is no shuffle. A task holds one Arrow batch and two bounded memos.
Null and empty texts have 0 tokens; repeated rows are counted each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from claimwright.llm.common import PAIR, Memo, map_batches, whole_texts
from claimwright.llm.vocabulary import vocabulary

_PLACE = 40  # bits of a place within a word, below the rank


def merged_length(symbols: list[int], ranks: dict[int, int], result: list[int]) -> int:
    """Symbols left when no adjacent pair has a rank. ranks: left << PAIR | right to rank; result: by rank."""
    n = len(symbols)
    heap = [rank << _PLACE | i for i in range(n - 1) if (rank := ranks.get(symbols[i] << PAIR | symbols[i + 1])) is not None]
    if not heap:
        return n
    heapify(heap)
    after, before, merges, places = list(range(1, n + 1)), list(range(-1, n)), 0, (1 << _PLACE) - 1
    while heap:
        least = heappop(heap)
        i, rank = least & places, least >> _PLACE
        j = after[i]
        # An entry is stale if its left symbol was merged away or the pair has changed since.
        if j >= n or symbols[i] < 0 or ranks.get(symbols[i] << PAIR | symbols[j]) != rank:
            continue
        symbols[i], symbols[j] = result[rank], -1
        after[i] = k = after[j]
        merges += 1
        if k < n:
            before[k] = i
            if (rank := ranks.get(symbols[i] << PAIR | symbols[k])) is not None:
                heappush(heap, rank << _PLACE | i)
        if (h := before[i]) >= 0 and (rank := ranks.get(symbols[h] << PAIR | symbols[i])) is not None:
            heappush(heap, rank << _PLACE | h)
    return n - merges


@cache
def counter(path: str) -> Callable[[str], int]:
    """Number of tokens of a text. Equal words and equal chunks are merged once while the memo holds them."""
    v = vocabulary(path)
    ranks = {a << PAIR | b: rank for rank, (a, b, _) in enumerate(v.merges)}
    result = [c for _, _, c in v.merges]
    of_word = Memo(lambda word: merged_length(v.symbols(word), ranks, result))
    of_chunk = Memo(lambda chunk: sum(map(of_word.__getitem__, v.words(chunk))))

    def count(text: str) -> int:
        parts = v.parts(text)
        return len(parts) // 2 + sum(sum(map(of_chunk.__getitem__, v.chunks(part))) for part in parts[::2])

    return count


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit of every whole text."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        count, texts = counter(path), rows.column("text").to_pylist()
        tokens = [count(t) for t in texts]
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(tokens, pa.int64()),
             pa.array([n > limit for n in tokens], pa.bool_())],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    return map_batches(whole_texts(docs), batch, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
