"""Toxicity: a convolutional text classifier, trained in numpy.

Words (lower-cased) are hashed to BUCKETS embeddings; a word's vector is the sum of its own
and that of its first STEM bytes, so inflected forms share one. Filters of widths 1, 2 and
3 slide over the words, each filter's largest response over the whole text (max pooling) passes a
rectifier, and a logistic layer gives the score. As a filter is linear, the product of all
embeddings with each of its columns is one table, and a response is a sum of table rows:
scoring gathers, it never multiplies per word.

Training takes all labelled rows. They are dealt by hash to shards of about SHARD_ROWS; in
each of EPOCHS rounds every shard continues from the same parameters with its own rows, and
parameters and moments become the mean over the shards, weighted by rows (with one shard
that is plain Adam). One part in five of all texts, by hash, is kept for calibration: a shift
moves the best cut to 0.3, and thresholds by language, taken where a language has enough rows
of both kinds, are returned beside it. Cuts are exact: running sums over all scores in order.

Defined results. Null and empty texts, and texts without a word, score 0.
Labels other than 0 and 1 are ignored; without rows of both labels all scores are 0. Rows
with equal texts get equal scores. Long texts are scored in overlapping pieces whose
maxima are joined. Carried columns travel in a struct, so names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from . import kernels as K
from .common import batch, carried, column, cut, fields, map_batches, release, table
from .language import held_out, slices
from .sketches import bit_count, bitmap

SHARD_ROWS = 16_000
BLOCK = 1 << 14  # parameters that are averaged together
BUCKETS = 1 << 15
STEM = 4
DIM, FILTERS, WIDTHS = 16, 6, (1, 2, 3)
EPOCHS, BATCH, RATE, BLANK = 8, 64, 0.01, 0.4
CUT = 0.3
PIECE = 1 << 18


def bucket_ids(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket ids of each text's words and of their stems (two rows), followed by padding (0)
    so that every filter fits, and where each text begins (n + 1 values)."""
    starts, ends, first = K.word_spans(buf, offsets, K.alnum_words())
    h = K.word_hashes(buf, starts, ends, True)
    pad = max(WIDTHS)
    n = np.diff(first) + pad
    at = np.concatenate([[0], np.cumsum(n)])
    stem = K.word_hashes(buf, starts, np.minimum(ends, starts + STEM), True) ^ K.KEYS[20]
    ids = np.zeros((2, int(at[-1])), np.int32)
    to = np.arange(len(h)) + np.repeat(np.arange(len(n)) * pad, np.diff(first))
    for row, x in enumerate((h, stem)):
        ids[row, to] = (x % np.uint64(BUCKETS - 1)).astype(np.int32) + 1
    return ids, at


@dataclass
class Model:
    embed: np.ndarray
    conv: list[np.ndarray]  # by width: (width, DIM, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    shift: float = 0.0
    prior: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def tables(self) -> list[list[np.ndarray]]:
        return [[self.embed @ w[j] for j in range(len(w))] for w in self.conv]


def responses(tables: list[list[np.ndarray]], ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Largest response of each filter in each text, and all responses by width."""
    pooled, every = [], []
    for parts in tables:
        n = ids.shape[1] - len(parts) + 1
        r = parts[0][ids[0, :n]]
        r += parts[0][ids[1, :n]]
        for j in range(1, len(parts)):
            r += parts[j][ids[0, j : j + n]]
            r += parts[j][ids[1, j : j + n]]
        for j in range(1, len(parts)):  # windows that reach into the next text
            cut = at[1:] - j
            r[cut[cut < n]] = -np.inf
        pooled.append(np.maximum.reduceat(r, np.minimum(at[:-1], n - 1), axis=0))
        every.append(r)
    return np.concatenate(pooled, axis=1), every


def logits(model: Model, tables, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Scores of texts before the logistic function; long texts go piece by piece."""
    out = np.empty(len(at) - 1)
    i = 0
    while i < len(out):
        j = max(i + 1, int(np.searchsorted(at, at[i] + PIECE, "right")) - 1)
        if at[j] - at[i] <= PIECE:
            top, _ = responses(tables, ids[:, at[i] : at[j]], at[i : j + 1] - at[i])
        else:
            own, top = ids[:, at[i] : at[j]], None
            for a in range(0, own.shape[1], PIECE):
                piece = own[:, a : a + PIECE + max(WIDTHS) - 1]
                if piece.shape[1] >= max(WIDTHS):
                    some, _ = responses(tables, piece, np.array([0, piece.shape[1]]))
                    top = some if top is None else np.maximum(top, some)
        out[i:j] = np.maximum(top + model.bias, 0) @ model.out[:-1] + model.out[-1]
        i = j
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def gradients(m: Model, x: np.ndarray, where: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Of the weighted logistic loss, by parameter: embeddings, filters by width, bias, output.
    Max pooling passes each filter's gradient to one window of a text."""
    top, every = responses(m.tables(), x, where)
    hidden = np.maximum(top + m.bias, 0)
    error = (sigmoid(hidden @ m.out[:-1] + m.out[-1]) - y) * weight / len(y)
    grads = [np.zeros_like(p) for p in params(m)]
    grads[-1][:-1], grads[-1][-1] = hidden.T @ error, error.sum()
    back = (error[:, None] * m.out[None, :-1]) * (hidden > 0)
    grads[-2] += back.sum(axis=0)
    for w, width in enumerate(WIDTHS):
        cols = slice(w * FILTERS, (w + 1) * FILTERS)
        doc, f = np.nonzero(back[:, cols])
        if not len(doc):
            continue
        g = back[:, cols][doc, f]
        r = every[w]
        pos = np.array([where[d] + int(np.argmax(r[where[d] : min(where[d + 1], len(r)), c])) for d, c in zip(doc.tolist(), f.tolist())])
        for j in range(width):
            for word in x[:, pos + j]:
                np.add.at(grads[0], word, m.conv[w][j][:, f].T * g[:, None])
                np.add.at(grads[1 + w][j].T, f, m.embed[word] * g[:, None])
    return grads


@dataclass
class Fit:
    """A model in training: its parameters, Adam's two moments of each, and steps so far."""

    model: Model
    first: list[np.ndarray]
    second: list[np.ndarray]
    step: int = 0

    @property
    def arrays(self) -> list[np.ndarray]:
        return [*params(self.model), *self.first, *self.second]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.arrays])

    def add(self, change: np.ndarray) -> None:
        at = 0
        for x in self.arrays:
            x += change[at : at + x.size].reshape(x.shape)
            at += x.size
        for x in self.second:  # rounding could leave less than nothing
            np.maximum(x, 0, out=x)


def params(m: Model) -> list[np.ndarray]:
    return [m.embed, *m.conv, m.bias, m.out]


def begin(seed: int = 0) -> Fit:
    rng = np.random.default_rng(seed)
    m = Model(
        rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32), [rng.normal(0, 0.4 / w**0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(FILTERS * len(WIDTHS), np.float32), np.append(rng.normal(0, 0.3, FILTERS * len(WIDTHS)), -1.0).astype(np.float32),
    )
    return Fit(m, [np.zeros_like(p) for p in params(m)], [np.zeros_like(p) for p in params(m)])


def learn(fit: Fit, ids: np.ndarray, at: np.ndarray, y: np.ndarray, positive: float, rng: np.random.Generator) -> None:
    """Adam on the logistic loss, once over the rows: positives weighted up, words blanked at random."""
    m = fit.model
    weight = np.where(y == 1, positive, 1.0)
    order = rng.permutation(len(y))
    for k in range(0, len(order), BATCH):
        rows = order[k : k + BATCH]
        sizes = at[rows + 1] - at[rows]
        where = np.concatenate([[0], np.cumsum(sizes)])
        x = ids[:, np.arange(where[-1]) + np.repeat(at[rows] - where[:-1], sizes)]
        x[0, rng.random(x.shape[1]) < BLANK] = 0  # now and then a stem must do alone
        grads = gradients(m, x, where, y[rows], weight[rows])
        fit.step += 1
        for p, g, a, b in zip(params(m), grads, fit.first, fit.second):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= RATE * (a / (1 - 0.9**fit.step)) / (np.sqrt(b / (1 - 0.999**fit.step)) + 1e-7)


TOKENS = "k bigint, y int, lang string, held boolean, n int, ids binary"


def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket ids instead of texts (n pairs, compressed): made once for all rounds."""
    for b in batches:
        for buf, offsets, rows in slices(b, 1 << 20):
            ids, at = bucket_ids(buf, offsets)
            ids = ids.astype(np.uint16)
            packed = [pa.compress(ids[:, i:j].tobytes(), "zstd", asbytes=True) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            own = [b.column(c)[rows] for c in ("k", "y", "lang", "held")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(np.diff(at).astype(np.int32)), pa.array(packed, pa.binary())], [x.split()[0] for x in TOKENS.split(", ")])


def unpacked(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """What bucket_ids gave for the rows of a batch."""
    n = np.asarray(b.column("n"), np.int64)
    parts = [np.frombuffer(pa.decompress(x, 4 * k, "zstd", asbytes=True), np.uint16).reshape(2, k) for x, k in zip(b.column("ids").to_pylist(), n.tolist())]
    return np.concatenate(parts, axis=1).astype(np.int32), np.concatenate([[0], np.cumsum(n)])


CHANGES = "block int, shard bigint, n bigint, step bigint, change binary"


def shard_round(fit: Fit, positive: float, turn: int):
    """A round of one shard: what its rows change, by blocks of parameters and moments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Fit(Model(fit.model.embed.copy(), [w.copy() for w in fit.model.conv], fit.model.bias.copy(), fit.model.out.copy()), [x.copy() for x in fit.first], [x.copy() for x in fit.second], fit.step)
        shard, rng, n = 0, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            if rng is None:
                shard = b.column("k")[0].as_py()
                rng = np.random.default_rng([turn, shard & 0xFFFFFFFF, (shard >> 32) & 0xFFFFFFFF])
            learn(own, *unpacked(b), np.asarray(b.column("y"), np.float64), positive, rng)
            n += b.num_rows
        if n:
            change = own.flat() - fit.flat()
            parts = [pa.compress(change[i : i + BLOCK].tobytes(), "zstd", asbytes=True) for i in range(0, len(change), BLOCK)]
            k = len(parts)
            yield batch(block=np.arange(k, dtype=np.int32), shard=np.full(k, shard), n=np.full(k, n), step=np.full(k, own.step), change=pa.array(parts, pa.binary()))

    return run


def mean_change(size: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("shard")  # sums of one order, whatever the order of arrival
        block = t.column("block")[0].as_py()
        count = min(BLOCK, size - block * BLOCK)
        total, n = np.zeros(count), t.column("n").to_pylist()
        for x, k in zip(t.column("change"), n):
            total += k * np.frombuffer(pa.decompress(x.as_buffer(), 4 * count, "zstd", asbytes=True), np.float32).astype(np.float64)
        mean = (total / sum(n)).astype(np.float32)
        return pa.table({"block": pa.array([block], pa.int32()), "step": pa.array([max(t.column("step").to_pylist())], pa.int64()), "change": pa.array([mean.tobytes()], pa.binary())})

    return run


def fitted(rows: DataFrame, positive: float) -> Model:
    """The model after EPOCHS rounds over all rows; a partition is a shard."""
    fit = begin()
    size = len(fit.flat())
    for turn in range(EPOCHS):
        made = map_batches(rows, shard_round(fit, positive, turn), CHANGES)
        made = made.groupBy("block").applyInArrow(mean_change(size), "block int, step bigint, change binary").toArrow().sort_by("block")
        fit.add(np.frombuffer(b"".join(made.column("change").to_pylist()), np.float32))
        fit.step = made.column("step")[0].as_py()
        del made
        release(rows.sparkSession)
    return fit.model


def best_cuts(scored: DataFrame, parts: int) -> dict[str, tuple[float, int, int]]:
    """Of all rows (lang, y, z), under "", and of each language: the cut of z with the largest F1,
    half way to the next lower z; rows of label 1; rows."""
    every = scored.select(F.lit("").alias("g"), "y", "z").unionAll(scored.where("lang <> ''").select(F.col("lang").alias("g"), "y", "z"))
    by = every.groupBy("g", "z").agg(F.count("*").alias("n"), F.sum("y").alias("hits"))
    by = cut(by.repartitionByRange(parts, "g", F.desc("z"))).withColumn("p", F.spark_partition_id())
    # running sums within the parts, which are in order, and before them
    own = by.groupBy("g", "p").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    before = Window.partitionBy("g").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("g")
    own = own.select("g", "p", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in ("n", "hits")], F.sum("n").over(whole).alias("rows"), F.sum("hits").over(whole).alias("ones"))
    so_far = Window.partitionBy("g", "p").orderBy(F.desc("z")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = by.select("g", "p", "z", F.sum("n").over(so_far).alias("n"), F.sum("hits").over(so_far).alias("hits")).join(F.broadcast(own), ["g", "p"])
    f1 = 2 * (F.col("hits") + F.col("hits0")) / (F.col("n") + F.col("n0") + F.col("ones"))
    best = run.groupBy("g").agg(F.max_by("z", F.struct(f1, "z")).alias("top"), F.max("rows").alias("rows"), F.max("ones").alias("ones"))
    below = by.join(F.broadcast(best), "g").where("z < top").groupBy("g").agg(F.max("z").alias("below"))
    return {r["g"]: ((r["top"] + (r["top"] - 1 if r["below"] is None else r["below"])) / 2, r["ones"], r["rows"]) for r in best.join(below, "g", "left").collect()}


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", lang_col: str = "lang") -> Model | None:
    """The model from all rows with a text and a 0 or 1 label; None without both labels."""
    spark = labelled.sparkSession
    text, y, lang = column(text_col).cast("string"), column(label_col).cast("int"), column(lang_col).cast("string")
    known = labelled.where(text.isNotNull() & y.isin(0, 1))
    # shards by whole rows, so that copies of a text are dealt out; the split by texts, so that they stay together
    key = F.xxhash64(text, y, lang, *[column(f.name) for f in labelled.schema if isinstance(f.dataType, (IntegralType, StringType))])
    t = known.select(key.alias("k"), y.alias("y"), lang.alias("lang"), (F.pmod(F.xxhash64(text), F.lit(5)) == 0).alias("held"), text.alias("text"))
    t = cut(map_batches(t, tokenised, TOKENS))
    release(spark)
    n = {(r["held"], r["y"]): r["count"] for r in t.groupBy("held", "y").count().collect()}
    shards = max(1, -(-sum(n.values()) // SHARD_ROWS))
    if any((True, x) not in n and (False, x) not in n for x in (0, 1)):
        return None
    split = (False, 0) in n and (False, 1) in n and any(h for h, _ in n)
    learnt, sizes = (t.where("NOT held"), [n[False, x] for x in (0, 1)]) if split else (t, [n.get((True, x), 0) + n.get((False, x), 0) for x in (0, 1)])
    dealt = F.pmod("k", F.lit(shards)).cast("int")
    m = fitted(cut(learnt.repartitionById(shards, dealt).sortWithinPartitions("k", "y", "ids")), min(5.0, sizes[0] / sizes[1]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = m.tables()
        for b in batches:
            if b.num_rows:
                yield batch(lang=b.column("lang"), y=b.column("y"), z=logits(m, tables, *unpacked(b)))

    cuts = best_cuts(cut(map_batches(t.where("held") if split and (True, 1) in n else learnt, scored, "lang string, y int, z double")), shards)
    m.shift = float(np.log(CUT / (1 - CUT))) - cuts.pop("")[0]
    for name, (z, ones, count) in sorted(cuts.items()):
        if 10 <= ones < count:
            m.thresholds[name] = float(sigmoid(np.array([z + m.shift]))[0])
    return m


def score(docs: DataFrame, model: Model | None, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """row (struct of `carry`, all columns unless given) and score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.tables() if model else None
        for b in batches:
            out = np.zeros(b.num_rows)
            for buf, offsets, rows in slices(b, 1 << 20):
                if model:
                    ids, at = bucket_ids(buf, offsets)
                    out[rows] = np.where(np.diff(at) > max(WIDTHS), sigmoid(logits(model, tables, ids, at) + model.shift), 0.0)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out)], ["row", "score"])

    row = carried(docs, carry)
    return map_batches(docs.select(row, column(text_col).cast("string").alias("text")), run, fields(docs.select(row), ["row"], "score double"))


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = labels.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # a bitmap of the labelled ids first, so that texts without a label are not sent
    h = F.xxhash64("doc_id").alias("h")
    marks = bitmap(known.select(h), lambda b: np.asarray(b.column("h"), np.int64).view(np.uint64), bit_count(known.count()))
    own = docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang", h)
    own = map_batches(own, lambda batches: (b.filter(pa.array(marks.marked(np.asarray(b.column("h"), np.int64).view(np.uint64)))) for b in batches), own.schema)
    model = train(own.drop("h").join(known.hint("merge"), "doc_id"))
    out = score(docs, model, carry=["doc_id", "lang"])
    own = F.lit(CUT)
    for name, cut in sorted((model.thresholds if model else {}).items()):
        own = F.when(F.col("row.lang") == name, cut).otherwise(own)
    return out.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), (F.col("score") >= own).cast("int").alias("flagged"))
