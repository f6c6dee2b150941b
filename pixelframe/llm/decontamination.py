"""Benchmark decontamination by a prefix-filtered set join of word shingles.

Items are cut into windows of `window` consecutive words (a shorter item is one window). A
document contains a window if it has the window's words in a row, so all shingles of the
window must occur: by the prefix principle, one of them is enough to find every candidate.
The shingle chosen is the window's rarest one in the corpus (counted over all documents);
windows with a shingle that no document has are dropped at once. A document position with
a chosen shingle is a candidate if the words before and after it leave room for the window
(length and positional bounds), and it is verified by comparing the words themselves.

The benchmark is the small side, but its size is checked: its texts are cut into pieces of
PIECE_WORDS words (which overlap by a window less one word, so they have the same windows),
and pieces are dealt by hash into slices of about SLICE_WINDOWS windows, one pass over the
documents a slice. So what is collected and broadcast is bounded whatever the benchmark's
size, its longest item, or how often a text repeats in it.

Defined results. Null and empty texts have no words; items without words match nothing; a
null item id is reported as "null"; items that repeat an id share it. Repeated document
rows each get a row. An empty benchmark or table leaves nothing hit. Carried columns travel
in a struct, so names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import carried, column, cut, fields, map_batches, prepare

SHINGLE = 4
SLICE_WINDOWS = 1_000_000
PIECE_WORDS = 4096
BITS = 20  # of the hash, for the first look-up


def pieces(window: int, longest: int):
    """(item, text) rows cut into pieces of at most `longest` words that overlap by window - 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = K.alnum_words()
        for b in batches:
            names, texts, n = [], [], []
            buf, offsets = K.text_buffer(b.column("text"))
            starts, ends, first = K.word_spans(buf, offsets, table)
            for name, lo, hi in zip(b.column("item").to_pylist(), first[:-1].tolist(), first[1:].tolist()):
                for i in range(lo, max(lo + 1, hi - window + 1) if hi > lo else lo, longest - window + 1):
                    j = min(hi, i + longest)
                    names.append(name)
                    texts.append(buf[starts[i] : ends[j - 1]].tobytes().decode("utf-8", "replace"))
                    n.append(max(1, j - i - window + 1))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string()), pa.array(n, pa.int64())], ["item", "text", "n"])

    return run


class Windows:
    """The distinct windows of some items, with their shingles: word places in one buffer of
    lower-case words joined by spaces."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        buf, offsets = K.text_buffer(pa.array([t for _, t in items], pa.large_string()))
        starts, ends, first = K.word_spans(buf, offsets, K.alnum_words())
        words = K.word_hashes(buf, starts, ends, True)
        self.text = K.kept_bytes(K.lower_table()[buf], starts, ends, np.ones(len(starts), bool))
        place = np.concatenate([[0], np.cumsum(ends - starts + 1)])
        n = np.diff(first)
        size = np.minimum(n, window)
        many = np.where(n > 0, n - size + 1, 0)
        owner = np.repeat(np.arange(len(items)), many)
        at = first[:-1][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        sizes = size[owner]
        low, high = place[at], place[at + sizes] - 1
        h = np.zeros(len(at), np.uint64)
        for k in np.unique(sizes).tolist():
            mine = sizes == k
            h[mine] = K.window_hashes(words, k)[at[mine]]
        order = np.lexsort((at, h))
        one = np.empty(len(at), np.int64)  # the first window of the same words
        head = -1
        for i in order.tolist():  # equal hashes are not trusted: the words are compared
            if head < 0 or h[head] != h[i] or self.text[low[head] : high[head]] != self.text[low[i] : high[i]]:
                head = i
            one[i] = head
        kept, number = np.unique(one, return_inverse=True)
        self.names = sorted({name for name, _ in items})
        index = {x: i for i, x in enumerate(self.names)}
        of = np.array([index[name] for name, _ in items], np.int64)[owner] if len(owner) else owner
        pairs = np.unique(number * max(1, len(self.names)) + of)
        self.items = pairs % max(1, len(self.names))  # of window w: items[edge[w] : edge[w + 1]]
        self.edge = np.searchsorted(pairs // max(1, len(self.names)), np.arange(len(kept) + 1))
        self.low, self.high, self.sizes = low[kept], high[kept], sizes[kept]
        self.shingles: dict[int, np.ndarray] = {}  # by shingle size: sorted distinct hashes
        self.grams: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}  # windows of a size, and their shingles in rows
        for k in np.unique(self.sizes).tolist():
            g = min(k, SHINGLE)
            w = np.flatnonzero(self.sizes == k)
            rows = K.window_hashes(words, g)[at[kept][w][:, None] + np.arange(k - g + 1)]
            self.grams.setdefault(g, []).append((w, rows))
        for g, parts in self.grams.items():
            self.shingles[g] = np.unique(np.concatenate([r.ravel() for _, r in parts]))

    def chosen(self, counts: dict[int, np.ndarray]) -> dict[int, list[np.ndarray]]:
        """By shingle size: each window's rarest shingle (hash, window, offset), by hash. counts:
        of the sorted shingles of that size."""
        out = {}
        for g, parts in self.grams.items():
            found = []
            for w, rows in parts:
                n = counts[g][np.searchsorted(self.shingles[g], rows)]
                least = n == n.min(axis=1, keepdims=True)
                offset = np.argmin(np.where(least, rows, np.uint64(2**64 - 1)), axis=1)
                some = n.min(axis=1) > 0
                found.append((rows[np.arange(len(w)), offset][some], w[some], offset[some]))
            h, w, o = map(np.concatenate, zip(*found))
            order = np.lexsort((o, w, h))
            if len(order):
                out[g] = [h[order], w[order], o[order]]
        return out


def first_look(hashes: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << BITS, bool)
    table[(hashes >> np.uint64(64 - BITS)).astype(np.int64)] = True
    return table


def seen(words: np.ndarray, first: np.ndarray, k: int, hashes: np.ndarray, look: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat positions of shingles that are among the sorted hashes, and their hashes."""
    h = K.window_hashes(words, k)
    at = np.flatnonzero(look[(h >> np.uint64(64 - BITS)).astype(np.int64)])
    at = at[np.isin(h[at], hashes)]
    if len(at):
        doc = K.owner(first, at)
        at = at[at + k <= first[doc + 1]]
    return at, h[at]


def count_shingles(shingles: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = K.alnum_words()
        looks = {k: first_look(h) for k, h in shingles.items()}
        n = {k: np.zeros(len(h), np.int64) for k, h in shingles.items()}
        for b in batches:
            buf, offsets = K.text_buffer(b.column("text"))
            starts, ends, first = K.word_spans(buf, offsets, table)
            words = K.word_hashes(buf, starts, ends, True)
            for k, h in shingles.items():
                _, found = seen(words, first, k, h, looks[k])
                n[k] += np.bincount(np.searchsorted(h, found), minlength=len(h))
        for k, c in n.items():
            some = np.flatnonzero(c)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k, np.int32)), pa.array(shingles[k][some].view(np.int64)), pa.array(c[some])], ["k", "h", "n"])

    return run


def match(shared):
    """shared: broadcast windows and their chosen shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, chosen = shared.value
        sizes, table, lower = known.sizes, K.alnum_words(), K.lower_table()
        looks = {k: first_look(c[0]) for k, c in chosen.items()}
        for b in batches:
            buf, offsets = K.text_buffer(b.column("text"))
            starts, ends, first = K.word_spans(buf, offsets, table)
            words = K.word_hashes(buf, starts, ends, True)
            hits: dict[int, list[tuple[int, int]]] = {}
            for k, (hashes, windows, shifts) in chosen.items():
                at, h = seen(words, first, k, hashes, looks[k])
                if not len(at):
                    continue
                lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
                n = hi - lo
                pick = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
                begin, w = np.repeat(at, n) - shifts[pick], windows[pick]
                doc = K.owner(first, np.repeat(at, n))
                fits = (begin >= first[doc]) & (begin + sizes[w] <= first[doc + 1])
                for d, s, x in zip(doc[fits].tolist(), begin[fits].tolist(), w[fits].tolist()):
                    hits.setdefault(d, []).append((s, x))
            n_hit, found, runs = np.zeros(b.num_rows, np.int64), [[] for _ in range(b.num_rows)], [[] for _ in range(b.num_rows)]
            for d, pairs in hits.items():
                a, z = first[d], first[d + 1]
                s, e = starts[a:z], ends[a:z]
                o = offsets[d]
                text = K.kept_bytes(lower[buf[o : offsets[d + 1]]], s - o, e - o, np.ones(z - a, bool))
                place = np.concatenate([[0], np.cumsum(e - s + 1)])
                ok = [(p - a, x) for p, x in pairs if text[place[p - a] : place[p - a + sizes[x]] - 1] == known.text[known.low[x] : known.high[x]]]
                if ok:
                    p, x = np.array(ok, np.int64).T
                    mask = K.covered(p, sizes[x], z - a)
                    n_hit[d] = mask.sum()
                    runs[d] = [{"start": int(i), "end": int(j)} for i, j in zip(*K.runs(mask))]
                    found[d] = sorted({known.names[j] for i in set(x.tolist()) for j in known.items[known.edge[i] : known.edge[i + 1]].tolist()})
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("th"), pa.array(np.diff(first)), pa.array(n_hit), pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(found, pa.list_(pa.string()))],
                ["row", "th", "n_words", "n_hit", "runs", "items"],
            )

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, carry: list[str] | None = None) -> DataFrame:
    """One row a document: row (struct of `carry`, all columns unless given), n_words, n_hit,
    runs (word positions [start, end) that windows cover) and items (their ids as strings)."""
    spark = docs.sparkSession
    prepare(spark)
    items = benchmark.select(F.coalesce(column(item_col).cast("string"), F.lit("null")).alias("item"), column(item_text_col).cast("string").alias("text")).where("text IS NOT NULL")
    items = cut(map_batches(items, pieces(window, max(PIECE_WORDS, 2 * window)), "item string, text string, n bigint").distinct())
    size = items.agg(F.sum("n").alias("n")).first()["n"] or 0
    slices = max(1, -(-size // SLICE_WINDOWS))
    t = column(text_col).cast("string").alias("text")
    row = carried(docs, carry)
    schema = fields(docs.select(row), ["row"], "th bigint, n_words bigint, n_hit bigint, runs array<struct<start:bigint,end:bigint>>, items array<string>")
    found = None
    for i in range(slices):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == i) if slices > 1 else items
        windows = Windows([(r["item"], r["text"]) for r in part.orderBy("item", "text").collect()], window)
        counts = {k: np.zeros(len(h), np.int64) for k, h in windows.shingles.items()}
        if counts:
            seen_ = map_batches(docs.select(t), count_shingles(windows.shingles), "k int, h bigint, n bigint").groupBy("k", "h").agg(F.sum("n").alias("n")).toArrow()
            k, h, n = (seen_.column(c).to_numpy() for c in ("k", "h", "n"))
            for g, all_ in windows.shingles.items():
                counts[g][np.searchsorted(all_, h[k == g].view(np.uint64))] = n[k == g]
        chosen = windows.chosen(counts)
        windows.grams = windows.shingles = None  # not needed any more
        shared = spark.sparkContext.broadcast((windows, chosen))  # bounded by SLICE_WINDOWS
        hit = map_batches(docs.select(row, t, F.xxhash64(column(text_col).cast("string")).alias("th")), match(shared), schema)
        found = hit if found is None else found.unionAll(hit)
    if slices == 1:
        return found.drop("th")
    return merge_slices(cut(found.withColumn("key", F.struct(F.to_json("row"), "th"))), slices)


def merge_slices(found: DataFrame, slices: int) -> DataFrame:
    """Joins the rows that a document has, one from each slice; repeated rows stay as many."""
    empty = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")

    def add(acc, r):
        last = F.get(acc, F.size(acc) - 1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], r["end"]).alias("end"))
        return F.when(last["end"] >= r["start"], F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(longer))).otherwise(F.concat(acc, F.array(r)))

    one = found.groupBy("key").agg(
        F.first("row").alias("row"), F.first("n_words").alias("n_words"), F.sort_array(F.flatten(F.collect_list("runs"))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.count("*").alias("rows"),
    )
    one = one.withColumn("runs", F.aggregate("runs", empty, add)).withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("rows") / slices).cast("int"))))
    return one.select("row", "n_words", F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"]).alias("n_hit"), "runs", "items")


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return out.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
