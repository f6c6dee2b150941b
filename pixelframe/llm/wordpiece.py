"""Token counts with a linear longest-match automaton.

The vocabulary is a trie. A node whose text is not itself a piece has a failure link: the
node that is left after the longest pieces at its front have been popped, with how many were
popped precomputed. Matching a word follows trie edges; where there is none it adds the
popped count and follows the failure link, so every byte is looked at once and no piece is
ever built. The count equals that of greedy longest-match-first pieces.

Words are the tokenizer's pre-tokens; all distinct new words of a batch walk through the
automaton together. A word with a character that no piece covers counts as one (unknown).

Defined results. Null and empty texts have no words and no pieces. Repeated rows get equal
results. Carried columns travel in a struct, so names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import CACHED_WORDS, Vocabulary, default_path
from .common import carried, column, fields, map_batches, prepare, table


class Automaton:
    """Trie edges (state * 256 + byte, ascending), failure links and popped counts."""

    def __init__(self, pieces: list[bytes]):
        edges: dict[tuple[int, int], int] = {}
        parent, byte, depth, final = [-1], [0], [0], [False]
        for piece in pieces:
            s = 0
            for c in piece:
                t = edges.get((s, c))
                if t is None:
                    t = edges[s, c] = len(parent)
                    parent.append(s)
                    byte.append(c)
                    depth.append(depth[s] + 1)
                    final.append(False)
                s = t
            final[s] = s > 0
        n = len(parent)
        fail, pops = [-1] * n, [0] * n
        for s in sorted(range(1, n), key=depth.__getitem__):
            if final[s]:
                fail[s], pops[s] = 0, 1
                continue
            u, c = parent[s], byte[s]
            z, count = fail[u], pops[u]
            while z >= 0 and (z, c) not in edges:
                count += pops[z]
                z = fail[z]
            if z >= 0:
                fail[s], pops[s] = edges[z, c], count
        key = np.array([s * 256 + c for s, c in edges], np.int64)
        order = np.argsort(key)
        self.key, self.target = key[order], np.fromiter(edges.values(), np.int64, len(edges))[order]
        self.fail, self.pops = np.array(fail, np.int64), np.array(pops, np.int64)

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        want = state * 256 + byte
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where(self.key[at] == want, self.target[at], -1)

    def counts(self, words: list[bytes]) -> np.ndarray:
        n = len(words)
        if not n or not len(self.key):
            return np.array([min(1, len(w)) for w in words], np.int64)
        sizes = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        first = np.cumsum(sizes) - sizes
        state, count, unknown = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        for j in range(int(sizes.max(initial=0))):
            todo = np.flatnonzero((sizes > j) & ~unknown)
            while len(todo):
                to = self.step(state[todo], flat[first[todo] + j])
                state[todo[to >= 0]] = to[to >= 0]
                todo = todo[to < 0]
                lost = self.fail[state[todo]] < 0
                unknown[todo[lost]] = True
                todo = todo[~lost]
                count[todo] += self.pops[state[todo]]
                state[todo] = self.fail[state[todo]]
        todo = np.flatnonzero((state > 0) & ~unknown)
        while len(todo):
            lost = self.fail[state[todo]] < 0
            unknown[todo[lost]] = True
            todo = todo[~lost]
            count[todo] += self.pops[state[todo]]
            state[todo] = self.fail[state[todo]]
            todo = todo[state[todo] > 0]
        return np.where(unknown, 1, count)


def stretches(texts: list[str | None], limit: int = 1 << 21) -> Iterator[list[str | None]]:
    """Runs of texts of about `limit` characters."""
    held, size = [], 0
    for x in texts:
        held.append(x)
        size += len(x or "")
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def token_counts(docs: DataFrame, text_col: str = "text", path: str | None = None, pattern: str | None = None, carry: list[str] | None = None) -> DataFrame:
    """row (struct of `carry`, all columns unless given), n_words and n_pieces."""
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(Automaton(sorted(Vocabulary(path or default_path()).ids)))  # bounded by the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        automaton, find = shared.value, regex.compile(pattern).findall
        known: dict[str, int] = {}
        for b in batches:
            words, pieces = [], []
            for texts in stretches(b.column("text").to_pylist()):
                found = [find(x) if x else [] for x in texts]
                new = list(set(chain.from_iterable(found)).difference(known))
                if new:  # the words that these texts add walk through the automaton together
                    if len(known) > CACHED_WORDS:
                        known.clear()
                        new = list(set(chain.from_iterable(found)))
                    known.update(zip(new, automaton.counts([w.encode() for w in new]).tolist()))
                words += map(len, found)
                pieces += [sum(map(known.__getitem__, x)) for x in found]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(words, pa.int64()), pa.array(pieces, pa.int64())], ["row", "n_words", "n_pieces"])

    row = carried(docs, carry)
    return map_batches(docs.select(row, column(text_col).cast("string").alias("text")), run, fields(docs.select(row), ["row"], "n_words bigint, n_pieces bigint"))


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    out = token_counts(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("row.doc_id", "n_words", "n_pieces")
