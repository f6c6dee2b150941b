"""Language identification with language-bitmask n-gram filters.

N-grams are four bytes of the text (letters folded to lower case, everything else a space).
They are counted by language over all training rows; each language's most frequent ones,
unless they are far more frequent in another language, go into one Bloom filter whose cells
are bit slices: bit l of a cell belongs to language l. A look-up ANDs HASHES cells and so
returns all languages that have the n-gram at once. A text's count for a language is the
popcount of its bit over all n-grams, corrected for the filter's false positives:
(hits - f * n) / (1 - f), f being the language's share of set bits to the power HASHES. The
largest corrected count decides; ties go to the first language by name.

Bounds: PER_LANGUAGE n-grams of each language, and for every SLICE languages a filter of its
own cells, are collected, whatever the corpus size.

Defined results. `und` with score 0 for null texts and texts without a letter. Texts whose
n-grams no language has get the most frequent language and 1 / number of languages. Training
rows need text and language; without any, all texts are `und`. Repeated rows are judged
alike. Carried columns travel in a struct, so names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .common import carried, column, cut, fields, map_batches, table

SLICE = 64  # languages a cell
PER_LANGUAGE = 20_000
CELL_BITS = 18
HASHES = 2
RIVAL = 0.2  # an n-gram is a language's own if at least this share of the largest frequency
ODD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


def held_out(id_col: Column, fold: int = 2, folds: int = 4) -> Column:
    return F.crc32(id_col.cast("string")) % folds == fold


def folded() -> np.ndarray:
    out = np.full(256, 0x20, np.uint8)
    out[0x61:0x7B] = np.arange(0x61, 0x7B)
    out[0x41:0x5B] = np.arange(0x61, 0x7B)
    out[0x80:] = np.arange(0x80, 0x100)
    return out


def grams(buf: np.ndarray, offsets: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams with at most one leading or trailing space, as 32-bit numbers, and where
    those of each text begin (n + 1 values)."""
    if len(buf) < 4:
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    b = fold[buf]
    wide = b.astype(np.uint32)
    g = (wide[:-3] << np.uint32(24)) | (wide[1:-2] << np.uint32(16)) | (wide[2:-1] << np.uint32(8)) | wide[3:]
    space = b == 0x20
    keep = ~(space[1:-2] | space[2:-1])
    for j in (1, 2, 3):  # no n-gram spans two texts
        at = offsets[1:-1] - j
        keep[at[(at >= 0) & (at < len(keep))]] = False
    at = np.flatnonzero(keep)
    return g[at], np.searchsorted(at, offsets)


def slices(batch: pa.RecordBatch, limit: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray, slice]]:
    """Runs of whole texts of about `limit` bytes: what is worked on at once."""
    buf, offsets = K.text_buffer(batch.column("text"))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], slice(i, j)
        i = j


def count_grams(languages: list[str]):
    place = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = folded()
        held: list[np.ndarray] = []

        def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            key, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return key, np.bincount(inverse, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)

        so_far: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            lang = np.array([place.get(x, -1) for x in b.column("lang").to_pylist()], np.int64)
            for buf, offsets, rows in slices(b):
                g, first = grams(buf, offsets, fold)
                of = np.repeat(lang[rows], np.diff(first))
                key, n = np.unique((of[of >= 0] << 32) | g[of >= 0], return_counts=True)
                so_far.append((key, n))
            if len(so_far) >= 16:
                so_far = [merge(so_far)]
            if so_far and len(so_far[0][0]) > 2_000_000:
                key, n = merge(so_far)
                yield pa.RecordBatch.from_arrays([pa.array((key >> 32).astype(np.int32)), pa.array(key & 0xFFFFFFFF), pa.array(n)], ["l", "g", "n"])
                so_far = []
        if so_far:
            key, n = merge(so_far)
            yield pa.RecordBatch.from_arrays([pa.array((key >> 32).astype(np.int32)), pa.array(key & 0xFFFFFFFF), pa.array(n)], ["l", "g", "n"])

    return run


class Filters:
    """A bit-sliced Bloom filter: cells of one bit a language, SLICE languages a cell; more
    languages go to further filters."""

    def __init__(self, languages: list[str], members: list[np.ndarray]):
        self.languages = languages
        self.more = Filters(languages[SLICE:], members[SLICE:]) if len(languages) > SLICE else None
        languages, members = languages[:SLICE], members[:SLICE]
        kind = next(k for k, bits in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 64)) if len(languages) <= bits)
        self.cells = np.zeros(1 << CELL_BITS, kind)
        for l, g in enumerate(members):
            for k in range(HASHES):
                at = np.unique(self.place(g, k))
                self.cells[at] |= kind(1 << l)
        fill = [float(((self.cells >> kind(l)) & kind(1)).mean()) for l in range(len(languages))]
        self.false = np.array(fill) ** HASHES

    @staticmethod
    def place(g: np.ndarray, k: int) -> np.ndarray:
        x = (g.astype(np.uint32) * np.uint32(ODD[k])) ^ (g.astype(np.uint32) >> np.uint32(15 + k))
        return (x * np.uint32(ODD[k + 2])) >> np.uint32(32 - CELL_BITS)

    def masks(self, g: np.ndarray) -> np.ndarray:
        out = self.cells[self.place(g, 0)]
        for k in range(1, HASHES):
            out &= self.cells[self.place(g, k)]
        return out

    def counts(self, g: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Corrected counts, one row a text and one column a language."""
        n = np.diff(first)
        mask = self.masks(g)
        own = min(len(self.languages), SLICE)
        out = np.zeros((len(n), own))
        for l in range(own):
            bit = ((mask >> mask.dtype.type(l)) & mask.dtype.type(1)).astype(np.uint8)
            sums = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
            out[:, l] = (sums[first[1:]] - sums[first[:-1]] - self.false[l] * n) / (1.0 - self.false[l])
        out = np.maximum(out, 0.0)
        return out if self.more is None else np.hstack([out, self.more.counts(g, first)])


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Filters:
    """The filters from all rows with a text and a language."""
    t = rows.select(column(text_col).cast("string").alias("text"), column(lang_col).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    names = [r["lang"] for r in t.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()]
    if not names:
        return Filters([], [])
    counted = cut(map_batches(t, count_grams(names), "l int, g bigint, n bigint").groupBy("l", "g").agg(F.sum("n").alias("n")))
    shares = counted.join(F.broadcast(counted.groupBy("l").agg(F.sum("n").alias("all"))), "l").withColumn("share", F.col("n") / F.col("all"))
    best = shares.groupBy("g").agg(F.max("share").alias("top"))
    own = shares.join(best, "g").where((F.col("share") >= RIVAL * F.col("top")) & (F.col("n") >= 3))
    w = Window.partitionBy("l").orderBy(F.desc("n"), "g")
    top = own.withColumn("r", F.row_number().over(w)).where(F.col("r") <= PER_LANGUAGE).select("l", "g").collect()
    members = [np.array([r["g"] for r in top if r["l"] == l], np.uint32) for l in range(len(names))]
    return Filters(names, members)


def identify(docs: DataFrame, filters: Filters, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """row (struct of `carry`, all columns unless given), lang_pred and score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = folded()
        letters = np.zeros(256, bool)
        letters[0x41:0x5B] = letters[0x61:0x7B] = True
        rank = {x: i for i, x in enumerate(sorted(filters.languages))}
        by_name = np.array([filters.languages.index(x) for x in rank], np.int64)
        for b in batches:
            pred, score = ["und"] * b.num_rows, np.zeros(b.num_rows)
            for buf, offsets, rows in slices(b):
                if not filters.languages:
                    continue
                some = np.concatenate([[0], np.cumsum(letters[buf])])
                has = (some[offsets[1:]] - some[offsets[:-1]]) > 0
                for i in np.flatnonzero(~has & (np.diff(offsets) > 0)).tolist():
                    has[i] = any(map(str.isalpha, buf[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")))
                counts = filters.counts(*grams(buf, offsets, fold))
                total = counts.sum(axis=1)
                best = by_name[np.argmax(counts[:, by_name], axis=1)]
                for i in np.flatnonzero(has).tolist():
                    if total[i] > 0:
                        pred[rows.start + i], score[rows.start + i] = filters.languages[best[i]], counts[i, best[i]] / total[i]
                    else:
                        pred[rows.start + i], score[rows.start + i] = filters.languages[0], 1.0 / len(filters.languages)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(pred, pa.string()), pa.array(score)], ["row", "lang_pred", "score"])

    row = carried(docs, carry)
    return map_batches(docs.select(row, column(text_col).cast("string").alias("text")), run, fields(docs.select(row), ["row"], "lang_pred string, score double"))


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = train(docs.where(~held_out(F.col("doc_id"))))
    out = identify(docs, filters, carry=["doc_id"])
    return out.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")
