"""Suffix-array dedup: bytes covered by a `length`-byte string that also starts elsewhere.

Every window of `length` bytes has an anchor: of its substrings of gram_of(length) bytes that
follow white space (of all, if none does) the one with the smallest hash, the leftmost of
equal ones.
Equal windows have equal anchors, so a window can only repeat if its anchor does.
Consecutive windows with one anchor form a segment. Segments are dealt by their anchor's
hash, mixed once more (a smallest hash is itself always low), hence equal windows of any two
documents meet in one shard.

First only anchor hashes travel, each once a batch with the number of its contents, and tell
which anchors repeat and which are hot: of more than hot_contents contents. Segments of hot anchors
are cut into single windows that are dealt by their own hash, after a second count has told
which of those repeat, so a passage that very many documents hold in different contexts is
spread over all shards. Then the texts of what repeats follow, each distinct one once a
batch. A shard writes them to a file and sorts all their suffixes by external induced sorting
(induced.py), whose common-prefix values tell which windows occur elsewhere (a segment whose anchor has
no other content is sorted with nothing: it is repeated if it came twice); of what grows
with the shard's bytes only `limit` bytes are in memory, the rest in mapped files. Answers
travel back as bits by document group, as in substring_dedup.

Segments that occur twice in a batch are settled there, so what a third of all documents
share is sent once a batch. Shard and group counts follow the input size.

Defined results. Null texts are empty; texts shorter than a window keep all bytes. Rows that
repeat a document count as elsewhere for each other; ids may be null, repeated or of any
type. Empty tables give empty results. The kept text of the operator is decoded with
replacement, as a cut may split a character; the digest is over the bytes. Carried columns
travel in a struct. Equality of segments within an anchor rests on a 64-bit hash more, of
windows on the sorted bytes.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from . import kernels as K
from .common import carried, column, cut, fields, map_batches, release, text_bytes
from .induced import LIMIT, Scratch, repeated
from .sketches import Bitmap, bit_count, bitmap, key_hash, longs
from .substring_dedup import REPLY, bits, decide, group_of, packed_by_group, part, rows, spans, unbits, unpacked

PIECE = 1 << 19
PLACE = np.uint64((1 << 20) - 1)
HOT = 4096
FLUSH_SEGMENTS = 300_000
FLUSH_TEXT = 8 << 20
FLUSH_WINDOWS = 4_000_000
RANGE_BYTES = 20 << 20
GROUP_BYTES = 2 << 20
I8, U8 = np.int64, np.uint64
COUNTS = "dest int, keys binary, contents binary, many binary"
FOUND = "repeated binary, hot binary"
BLOCK = "dest int, ids binary, ths binary, fs binary, counts binary, segs binary, keys binary, ds binary, sizes binary, twice binary, texts binary, bits binary"
WHITE = ~K.space_words()


def stretches(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Byte ranges to work on, with the text bounds inside: runs of whole texts, or parts of a
    long one that overlap by a window less one byte."""
    i, n = 0, len(offsets) - 1
    while i < n:
        lo = int(offsets[i])
        j = int(np.searchsorted(offsets, lo + PIECE, "right")) - 1
        if j > i:
            yield lo, int(offsets[j]), offsets[i : j + 1] - lo
            i = j
            continue
        hi = int(offsets[i + 1])
        for a in range(lo, hi - length + 1, PIECE):
            b = min(hi, a + PIECE + length - 1)
            yield a, b, np.array([0, b - a])
        i += 1


def gram_of(length: int) -> int:
    return length // 2


def candidates(x: np.ndarray, first: np.ndarray, down: np.ndarray, gram: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places at which an anchor can start, their hashes, and what orders them: after white
    space, and everywhere in stretches where none of those is within reach of a window."""
    last = len(x) - gram + 1
    white = WHITE[x[:last]]
    p = np.flatnonzero(white[:-1] & ~white[1:]) + 1
    edges = np.concatenate([[0], p, [last]])
    wide = np.diff(edges) > reach
    extra = spans(edges[:-1][wide] + 1, np.diff(edges)[wide] - 1)
    pos = np.concatenate([p, extra])
    late = np.zeros(len(pos), bool)
    late[len(p) :] = True
    order = np.argsort(pos, kind="stable")
    pos, late = pos[order], late[order]
    h = K.mix((first[pos + gram] - first[pos]) * down[pos])
    return pos, h, (((h >> U8(1)) | (late.astype(U8) << U8(63))) & ~PLACE) | np.arange(len(pos), dtype=U8)


def least_of(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low .. high - 1]."""
    out, rows_, k = np.empty(len(low), values.dtype), values, 0
    level = np.frexp((high - low).astype(np.float64))[1] - 1
    for k in range(int(level.max(initial=-1)) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(rows_[low[at]], rows_[high[at] - (1 << k)])
        rows_ = np.minimum(rows_[: -(1 << k)], rows_[1 << k :]) if len(rows_) > 1 << k else rows_
    return out


def segments(buf: np.ndarray, offsets: np.ndarray, length: int, hot: Bitmap | None = None) -> tuple[np.ndarray, ...]:
    """In order: each segment's text, first byte, windows, key, content hash and whether it is
    a single window cut from a segment with a hot anchor."""
    out: list[tuple] = []
    gram = gram_of(length)
    reach = length - gram
    for lo, hi, bounds in stretches(offsets, length):
        x = buf[lo:hi]
        n = len(x)
        if n < length:
            continue
        up, down = K.powers(PIECE + length)
        first = np.empty(n + 1, U8)
        first[0] = 0
        np.cumsum(K.BYTE_VALUES[x] * up[:n], out=first[1:])
        pos, h, value = candidates(x, first, down, gram, reach)
        edge = np.zeros(n + 1, bool)
        for x_ in (bounds[:-1], bounds[1:] - length + 1, pos, pos - reach):
            edge[x_[x_ >= 0]] = True
        cuts = np.flatnonzero(edge[: n - length + 1])
        upto = np.zeros(n + 1, np.int32)
        upto[pos] = 1
        np.cumsum(upto, out=upto)  # candidates at or before each place
        text = np.searchsorted(bounds, cuts, "right") - 1
        fits = cuts + length <= bounds[text + 1]
        cuts, text = cuts[fits], text[fits]
        # every window that fits into its text has a candidate; runs of windows between two
        # cuts have the same ones
        a = (least_of(value, upto[cuts], upto[cuts + reach]) & PLACE).astype(I8)
        end = np.minimum(np.append(cuts[1:], n), bounds[text + 1] - length + 1)
        at = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, I8)
        if not len(at):
            continue
        s = cuts[at]
        c = end[np.append(at[1:], len(a)) - 1] - s
        g = K.mix(h[a[at]] * K.KEYS[34])
        split = np.zeros(len(s), bool) if hot is None else hot.marked(g)
        if split.any():
            many = np.where(split, c, 1)
            g, split = np.repeat(g, many), np.repeat(split, many)
            s, c = spans(s, many), np.where(split, 1, np.repeat(c, many))
        e = s + c + length - 1
        mid = (s + e) >> 1
        whole, half = (first[e] - first[s]) * down[s], (first[mid] - first[s]) * down[s]
        d = K.mix(whole * K.KEYS[30] + K.mix(half * K.KEYS[32]) + c.astype(U8))
        out.append((lo + s, c, np.where(split, K.mix(whole * K.KEYS[33]), g), d, split))
    if not out:
        return (np.zeros(0, I8),) * 3 + (np.zeros(0, U8),) * 2 + (np.zeros(0, bool),)
    s, c, k, d, split = map(np.concatenate, zip(*out))
    return np.searchsorted(offsets, s, "right") - 1, s, c, k, d, split


def key_counts(length: int, ranges: int, hot: Bitmap | None):
    """Keys of a batch's segments: in how many contents each is, and whether it occurs twice.
    With hot anchors, those of their windows only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            k, d = map(np.concatenate, zip(*held))
            order = np.lexsort((d, k))
            k, d = k[order], d[order]
            new = np.concatenate([[True], k[1:] != k[:-1]])
            at = np.flatnonzero(new)
            contents = np.add.reduceat(np.concatenate([[True], (d[1:] != d[:-1])]) | new, at).astype(np.int32)
            many = np.diff(np.append(at, len(k))) > 1
            k = k[at]
            edges = np.searchsorted(part(k, ranges), np.arange(ranges + 1))
            return rows(COUNTS, [(p, k[i:j].tobytes(), contents[i:j].tobytes(), bits(many[i:j])) for p, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if i < j])

        for b in batches:
            buf, offsets = K.text_buffer(b.column("text"))
            _, _, _, k, d, single = segments(buf, offsets, length, hot)
            if hot is not None:
                k, d = k[single], d[single]
            held.append((k, d))
            size += len(k)
            if size >= FLUSH_SEGMENTS * 2:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return run


def repeats(hot_contents: int):
    """The keys that occur twice or more, and those of more contents than hot_contents."""

    def run(t: pa.Table) -> pa.Table:
        k = np.frombuffer(b"".join(t.column("keys").to_pylist()), U8)
        contents = np.frombuffer(b"".join(t.column("contents").to_pylist()), np.int32).astype(I8)
        many = np.concatenate([unbits(m, len(x) // 8) for m, x in zip(t.column("many").to_pylist(), t.column("keys").to_pylist())])
        order = np.argsort(k, kind="stable")
        at = np.flatnonzero(np.concatenate([[True], k[order][1:] != k[order][:-1]]))
        again = np.add.reduceat(1 + many[order].astype(I8), at) > 1
        hot = np.add.reduceat(contents[order], at) > hot_contents
        k = k[order][at]
        return pa.table({"repeated": pa.array([k[again].tobytes()], pa.binary()), "hot": pa.array([k[hot].tobytes()], pa.binary())})

    return run


def flush(ids, ths, doc, c, k, d, s, buf, length: int, ranges: int, groups: int) -> pa.RecordBatch:
    """Blocks of a batch: its segments in document order, texts of the distinct ones."""
    n_docs = len(ids)
    with np.errstate(over="ignore"):
        f = (ids.view(U8) * K.KEYS[2] + ths.view(U8) * K.KEYS[3]).sum(dtype=U8).astype(U8).view(I8)
    order = np.lexsort((d, k))
    head = np.concatenate([[True], (k[order][1:] != k[order][:-1]) | (d[order][1:] != d[order][:-1])])
    at = np.flatnonzero(head)
    number = np.empty(len(d), I8)
    number[order] = np.cumsum(head) - 1
    times = np.diff(np.append(at, len(d)))
    settled = times[number] > 1
    one = order[at]  # a segment of each distinct content, by key
    out = []
    dest, own = part(k, ranges), part(k[one], ranges)
    edges = np.searchsorted(own, np.arange(ranges + 1))
    sent = np.flatnonzero(~settled)
    sent = sent[np.argsort(dest[sent], kind="stable")]
    cuts = np.searchsorted(dest[sent], np.arange(ranges + 1))
    for p in np.flatnonzero(np.diff(edges)).tolist():
        u = one[edges[p] : edges[p + 1]]
        x = sent[cuts[p] : cuts[p + 1]]
        per = np.bincount(doc[x], weights=c[x], minlength=n_docs).astype(I8)
        has = np.flatnonzero(per)
        sizes = c[u] + length - 1
        text = buf[spans(s[u], sizes)].tobytes()
        out.append((p, ids[has].tobytes(), ths[has].tobytes(), np.full(len(has), f).tobytes(), per[has].astype(np.int32).tobytes(), (number[x] - edges[p]).astype(np.int32).tobytes(), k[u].tobytes(), d[u].tobytes(), sizes.astype(np.int32).tobytes(), bits(times[edges[p] : edges[p + 1]] > 1), pa.compress(text, "zstd", asbytes=True), b""))
    total = np.bincount(doc, weights=c, minlength=n_docs).astype(I8)
    have = np.flatnonzero(np.bincount(doc[settled], minlength=n_docs))
    q = group_of(ids[have], ths[have], groups)
    late = np.repeat(settled, c)
    first = np.cumsum(total) - total
    for w in np.unique(q).tolist():
        has = have[q == w]
        out.append((ranges + w, ids[has].tobytes(), ths[has].tobytes(), np.full(len(has), f).tobytes(), total[has].astype(np.int32).tobytes(), b"", b"", b"", b"", b"", b"", bits(late[spans(first[has], total[has])])))
    return rows(BLOCK, out)


def segment_blocks(length: int, ranges: int, groups: int, found: Bitmap, hot: Bitmap | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        docs = size = text = 0

        def join() -> pa.RecordBatch:
            ids, ths, doc, c, k, d, s, data = map(np.concatenate, zip(*held))
            return flush(ids, ths, doc, c, k, d, s, data, length, ranges, groups)

        for b in batches:
            buf, offsets = K.text_buffer(b.column("text"))
            doc, s, c, k, d, _ = segments(buf, offsets, length, hot)
            keep = found.marked(k)
            doc, s, c, k, d = (x[keep] for x in (doc, s, c, k, d))
            if not len(d):
                continue
            some = np.unique(doc)
            part_of = spans(offsets[some], offsets[some + 1] - offsets[some])
            base = np.cumsum(np.diff(offsets)[some]) - np.diff(offsets)[some]
            at = np.searchsorted(some, doc)
            ids, ths = (np.asarray(b.column(x), I8)[some] for x in ("id", "th"))
            held.append((ids, ths, at + docs, c, k, d, s - offsets[doc] + base[at] + text, buf[part_of]))
            docs, size, text = docs + len(some), size + len(d), text + len(part_of)
            if size >= FLUSH_SEGMENTS or text >= FLUSH_TEXT:
                yield join()
                held, docs, size, text = [], 0, 0, 0
        if size:
            yield join()

    return run


def sort_shard(length: int, ranges: int, groups: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spool, blocks, dest = tempfile.TemporaryFile(), [], 0
        for b in batches:
            dest = b.column("dest")[0].as_py()
            for i in range(b.num_rows):
                r = {n: b.column(n)[i].as_py() for n in b.schema.names}
                if dest >= ranges:
                    yield rows(REPLY, [(dest - ranges, -1, r["ids"], r["ths"], r["fs"], r["counts"], r["bits"], r["bits"])])
                    continue
                sizes = np.frombuffer(r["sizes"], np.int32).astype(I8)
                spool.write(pa.decompress(r.pop("texts"), int(sizes.sum()), "zstd", asbytes=True))
                blocks.append((r, np.frombuffer(r["keys"], U8), np.frombuffer(r["ds"], U8), sizes, unbits(r["twice"], len(sizes))))
        if not blocks:
            return
        spool.flush()
        _, k, d, sizes, twice = (x if i == 0 else np.concatenate(x) for i, x in enumerate(zip(*blocks)))
        order = np.lexsort((d, k))
        new_k = np.concatenate([[True], k[order][1:] != k[order][:-1]])
        new = new_k | np.concatenate([[True], d[order][1:] != d[order][:-1]])
        content = np.empty(len(k), I8)  # the distinct content of each entry
        content[order] = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        one, weight = order[at], np.add.reduceat((1 + twice[order].astype(I8)), at)
        # an anchor of one content: its windows are repeated if it is; the others are sorted
        key_at = np.flatnonzero(new_k[at])
        contents = np.repeat(np.diff(np.append(key_at, len(at))), np.diff(np.append(key_at, len(at))))
        chosen = np.flatnonzero(contents > 1)
        chosen = chosen[np.argsort(one[chosen])]  # in the order of the file
        scratch = Scratch(limit, 1 << 16)
        sizes_of = sizes[one[chosen]]
        data = scratch.empty(int(sizes_of.sum()), np.uint8)
        from_, to = (np.cumsum(sizes) - sizes)[one[chosen]], np.cumsum(sizes_of) - sizes_of
        raw = np.memmap(spool, np.uint8, "r") if len(chosen) else data
        for a, b_ in scratch.chunks(len(chosen)):
            data[to[a] : to[b_ - 1] + sizes_of[b_ - 1]] = raw[spans(from_[a:b_], sizes_of[a:b_])]
        hit = repeated(data, sizes_of, weight[chosen], length, limit)
        start = np.where(weight > 1, -2, -1)  # not sorted: -2 if repeated as a whole
        start[chosen] = to + np.arange(len(chosen))  # a separator follows each string
        base, held, windows = 0, [], 0

        def replies() -> pa.RecordBatch:
            ids, ths, fs, counts, rep = map(np.concatenate, zip(*held))
            first = np.cumsum(counts) - counts
            some = np.flatnonzero(np.add.reduceat(rep, first) > 0)
            q = group_of(ids[some], ths[some], groups)
            out = []
            for w in np.unique(q).tolist():
                x = some[q == w]
                got = bits(rep[spans(first[x], counts[x])])
                out.append((w, dest, ids[x].tobytes(), ths[x].tobytes(), fs[x].tobytes(), counts[x].astype(np.int32).tobytes(), got, got))
            return rows(REPLY, out)

        for r, keys, *_ in blocks:
            entry = content[base + np.frombuffer(r["segs"], np.int32)]
            n = sizes[one[entry]] - length + 1
            rep = np.repeat(start[entry] == -2, n)
            of = np.flatnonzero(start[entry] >= 0)
            rep[np.repeat(start[entry] >= 0, n)] = hit[spans(start[entry[of]], n[of])]
            base += len(keys)
            if len(rep):
                held.append((*(np.frombuffer(r[c], I8) for c in ("ids", "ths", "fs")), np.frombuffer(r["counts"], np.int32).astype(I8), rep))
                windows += len(rep)
            if windows >= FLUSH_WINDOWS:
                yield replies()
                held, windows = [], 0
        if held:
            yield replies()

    return run


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, keep_text: bool = True, carry: list[str] | None = None, limit: int = LIMIT, hot_contents: int = HOT) -> DataFrame:
    """One row a document: row (struct of `carry`, all columns unless given), n_bytes,
    n_removed, n_spans (maximal removed runs) and kept (the text left, or the sha256 of its
    bytes unless keep_text). length: 16 to 254. limit: bytes that a shard's arrays may take
    in memory. hot_contents: contents of an anchor from which its windows are dealt one by one."""
    if not 16 <= length <= 254:
        raise ValueError(f"length must be 16 to 254, not {length}")
    spark = docs.sparkSession
    size = text_bytes(docs, text_col)
    ranges, groups, n_bits = max(16, -(-size // RANGE_BYTES)), max(64, -(-size // GROUP_BYTES)), bit_count(size // 64)
    t = column(text_col).cast("string")
    # rows that agree in the hashes of id and text have equal results
    key = docs.select(F.xxhash64(column(id_col).cast("string")).alias("id"), F.xxhash64(t).alias("th"), t.alias("text"), carried(docs, carry))
    base = key.select("id", "th", "text")

    def counted(hot: Bitmap | None) -> DataFrame:
        blocks = map_batches(base.select("text"), key_counts(length, ranges, hot), COUNTS)
        return cut(blocks.repartition(ranges, "dest").groupBy("dest").applyInArrow(repeats(hot_contents), FOUND))

    keys = counted(None)
    found = bitmap(keys.select("repeated"), lambda b: longs(b, "repeated").view(U8), n_bits)
    hot = bitmap(keys.select("hot"), lambda b: longs(b, "hot").view(U8), n_bits) if keys.where("octet_length(hot) > 0").take(1) else None
    if hot is not None:
        found = found | bitmap(counted(hot).select("repeated"), lambda b: longs(b, "repeated").view(U8), n_bits)
    release(spark)
    blocks = map_batches(base, segment_blocks(length, ranges, groups, found, hot), BLOCK)
    replies = cut(blocks.repartition(ranges + groups, "dest").groupBy("dest").applyInArrow(sort_shard(length, ranges, groups, limit), REPLY))
    release(spark)
    answered = bitmap(replies.select("ids", "ths"), lambda b: key_hash(longs(b, "ids"), longs(b, "ths")), n_bits)
    left = map_batches(key, packed_by_group(groups, answered), "q int, pack binary")
    schema = fields(key, ["row"], "n_bytes bigint, n_removed bigint, n_spans bigint, kept string")
    empty = to_arrow_schema(schema)

    def ended(x: bytes) -> str:
        return x.decode("utf-8", "replace") if keep_text else hashlib.sha256(x).hexdigest()

    def settle(docs_t: pa.Table, replies_t: pa.Table) -> pa.Table:
        if not docs_t.num_rows:
            return pa.Table.from_batches([], empty)
        docs_t = unpacked(docs_t.column("pack"))
        ids, ths = (docs_t.column(c).to_numpy().astype(I8) for c in ("id", "th"))
        order = np.lexsort((ths, ids))
        new = np.concatenate([[True], (ids[order][1:] != ids[order][:-1]) | (ths[order][1:] != ths[order][:-1])])
        one = order[new]
        key_of = np.empty(len(ids), I8)
        key_of[order] = np.cumsum(new) - 1
        buf, offsets = K.text_buffer(docs_t.column("text").take(pa.array(one)))
        doc, s, c, k, d, _ = segments(buf, offsets, length, hot)
        keep = found.marked(k)
        doc, s, c, k = (x[keep] for x in (doc, s, c, k))
        total = np.bincount(doc, weights=c, minlength=len(one)).astype(I8)
        rep, _ = decide(ids[one], ths[one], total, np.repeat(k, c), replies_t, ranges)
        gone = K.covered(spans(s, c)[rep], length, len(buf)) if rep.any() else np.zeros(len(buf), bool)
        made = []
        for i in range(len(one)):
            x, mask = buf[offsets[i] : offsets[i + 1]], gone[offsets[i] : offsets[i + 1]]
            made.append((len(x), int(mask.sum()), len(K.runs(mask)[0]), ended(x[~mask].tobytes())))
        cols = list(zip(*[made[k] for k in key_of.tolist()]))
        return pa.Table.from_arrays([docs_t.column("row"), *(pa.array(v, k) for v, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string())))], empty.names)

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(~answered.marked(key_hash(np.asarray(b.column("id"), I8), np.asarray(b.column("th"), I8)))))
            buf, offsets = K.text_buffer(b.column("text"))
            texts = (buf[i:j].tobytes() for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist()))
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(np.diff(offsets), pa.int64()), *(pa.array(np.zeros(n, I8)) for _ in range(2)), pa.array([ended(x) for x in texts], pa.string())], empty.names)

    touched = left.repartition(groups, "q").groupBy("q").cogroup(replies.repartition(groups, "q").groupBy("q")).applyInArrow(settle, schema)
    return touched.unionAll(map_batches(key, untouched, schema))


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = suffix_dedup(table(spark, sf_dir, "documents"), keep_text=False, carry=["doc_id"])
    return out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept").alias("kept_sha256"))
