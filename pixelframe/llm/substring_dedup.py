"""Substring dedup by level-wise doubling of repeated word windows.

The first level takes windows of half the window (7 words of 13). A window of the wanted
length is a candidate only if the two halves that make it up (the first 7 and the last 7
words) are repeated: another document has them too. Candidates are compared over the whole
corpus, and a word is removed if a repeated window that covers it also starts in a document
with a smaller id. From then on two adjacent repeated windows are joined to one of twice the
length, which again is compared over the whole corpus, until no candidate survives.

Data flow. Windows never travel as rows. A mapper gathers some million windows, settles
those that an earlier document of the same batch has (so a passage that a third of all
documents share is sent once a batch, not once a document), and sends the other hashes in
packed blocks, dealt by hash range. Reducers sort a range in numpy and answer with two
bits a window, packed by document group; the order of a document's windows within a range
tells which is which, so no positions travel. Documents meet the answers of the first level
in a cogroup that yields candidates only; candidates meet their answers without the texts;
at the end the texts of documents with a repeated window are cut in one more cogroup.
Block counts follow the input size, so that a range and a group fit one Python worker.

Defined results. Null and empty texts have no words. A null id orders after all others; ids
may be of any type that has an order. Rows with equal ids never remove words from one
another; repeated rows get equal results. Texts shorter than a window keep all words. Empty
tables give empty results. Other columns travel in a struct, so their names can't clash.
Candidates count as equal if two independent 64-bit hashes of their words agree; the hashes
of the first level only choose candidates, so FIRST_BYTES of each are sent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from . import kernels as K
from .common import cut, fields, keyed, map_batches, release, text_bytes
from .sketches import Bitmap, bit_count, bitmap, key_hash, longs

FLUSH_WINDOWS = 1_000_000
RANGE_BYTES = 12 << 20  # of text: about 2 million windows for a reducer
PACK_BYTES = 24 << 20
#: Of a hash of the first level, sent. The range is told by its high half, and a range has some 2 million windows
#: whatever the corpus size, so about two in a million windows become candidates by chance and are found out later.
FIRST_BYTES = 5
GROUP_BYTES = 4 << 20  # of text for a cogroup
PER_TASK = 4  # ranges or groups of candidates that a task settles in turn: they hold little, and a task costs more than most of them
KEYS_PER_TASK = 32  # groups whose keys a task marks or hands on together
BLOCK = "dest int, ids binary, ths binary, fs binary, counts binary, hashes binary, checks binary, bits binary"
REPLY = "q int, p int, ids binary, ths binary, fs binary, counts binary, rep binary, flag binary"
DONE = "q int, id bigint, th bigint, length bigint, flagged binary"
STATE = "q int, ids binary, ths binary, counts binary, positions binary, hashes binary, checks binary"
I8, U8 = np.int64, np.uint64


def part(h: np.ndarray, n: int) -> np.ndarray:
    """The equal range of 64-bit values that each hash lies in."""
    return (((h >> U8(32)) * U8(n)) >> U8(32)).astype(I8)


def group_of(ids: np.ndarray, ths: np.ndarray, n: int) -> np.ndarray:
    return part(K.mix(ids.view(U8) * K.KEYS[0] + ths.view(U8) * K.KEYS[1]), n)


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenated ranges start, start + 1, ... of the given lengths."""
    if not len(starts):
        return np.zeros(0, I8)
    ends = np.cumsum(counts)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - counts), counts)


def runs(positions: np.ndarray) -> bytes:
    """Ascending positions as starts, then lengths, of runs of neighbours."""
    at = np.flatnonzero(np.diff(positions, prepend=-2) != 1)
    return np.concatenate([positions[at], np.diff(np.append(at, len(positions)))]).astype(np.int32).tobytes()


def from_runs(data: bytes) -> np.ndarray:
    return spans(*np.frombuffer(data, np.int32).astype(I8).reshape(2, -1))


def bits(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def unbits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def rows(schema: str, out: list[tuple]) -> pa.RecordBatch:
    names = [x.split() for x in schema.split(", ")]
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*out) if out else [[]] * len(names), names)], [n for n, _ in names])


def by_value(h: np.ndarray, check: np.ndarray) -> np.ndarray:
    """Stable order of hashes, with their checks if there are any."""
    return np.lexsort((check, h)) if len(check) else np.argsort(h, kind="stable")


def heads(h: np.ndarray, check: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin in that order."""
    new = np.ones(len(h), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    if len(check):
        new[1:] |= check[order][1:] != check[order][:-1]
    return np.flatnonzero(new)


def low_bytes(h: np.ndarray, width: int) -> bytes:
    """The low bytes of each hash."""
    return np.ascontiguousarray(h, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def from_low(data: bytes, width: int) -> np.ndarray:
    if width == 8:
        return np.frombuffer(data, U8)
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8")[:, 0].astype(U8, copy=False)


def flush(ids: np.ndarray, ths: np.ndarray, counts: np.ndarray, h: np.ndarray, check: np.ndarray, ranges: int, groups: int, width: int = 8) -> pa.RecordBatch:
    """Blocks of a batch of documents: their windows' hashes, and what the batch itself settles.

    ids, ths and counts have one value a document; h and check (a second hash, or empty) have
    their windows in that order. width: bytes of a hash that are sent.
    """
    order = np.lexsort((ths, ids))
    new = np.ones(len(order), bool)
    new[1:] = (ids[order][1:] != ids[order][:-1]) | (ths[order][1:] != ths[order][:-1])
    order = order[new]
    of = spans((np.cumsum(counts) - counts)[order], counts[order])
    h, check = h[of], check[of] if len(check) else check
    ids, ths, counts = ids[order], ths[order], counts[order]
    with np.errstate(over="ignore"):
        f = (ids.view(U8) * K.KEYS[2] + ths.view(U8) * K.KEYS[3]).sum(dtype=U8).astype(U8).view(I8)
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
    order = by_value(h, check)
    at = heads(h, check, order)
    sizes = np.diff(np.append(at, len(h)))
    who = ids[doc[order]]
    later_sorted = who != np.repeat(who[at], sizes) if len(h) else np.zeros(0, bool)
    later, again = np.zeros(len(h), bool), np.zeros(len(h), bool)
    later[order] = later_sorted
    if len(h):
        again[order] = np.repeat(np.add.reduceat(later_sorted, at) > 0, sizes)
    sent = np.flatnonzero(~later)
    dest = part(h[sent], ranges)
    sent = sent[np.argsort(dest.astype(np.uint16 if ranges < 65536 else I8), kind="stable")]
    dest.sort()
    out = []
    edges = np.searchsorted(dest, np.arange(ranges + 1))
    for p in np.flatnonzero(np.diff(edges)):
        x = sent[edges[p] : edges[p + 1]]
        n = np.bincount(doc[x], minlength=len(ids))
        d = np.flatnonzero(n)
        out.append((int(p), ids[d].tobytes(), ths[d].tobytes(), np.full(len(d), f).tobytes(), n[d].astype(np.int32).tobytes(), low_bytes(h[x], width), check[x].tobytes() if len(check) else b"", bits(again[x])))
    own = np.flatnonzero(np.bincount(doc[later], minlength=len(ids)))
    q = group_of(ids[own], ths[own], groups)
    first = np.cumsum(counts) - counts
    for g in np.unique(q):
        d = own[q == g]
        x = spans(first[d], counts[d])
        out.append((ranges + int(g), ids[d].tobytes(), ths[d].tobytes(), np.full(len(d), f).tobytes(), counts[d].astype(np.int32).tobytes(), b"", b"", bits(later[x])))
    return rows(BLOCK, out)


def text_windows(text: pa.Array, window: int, table: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Windows a text, and all their hashes in order."""
    buf, offsets = K.text_buffer(text)
    starts, ends, first = K.word_spans(buf, offsets, table)
    words = K.word_hashes(buf, starts, ends, lower)
    h = K.window_hashes(words, window)
    at = K.window_starts(first, window)
    return np.maximum(np.diff(first) - window + 1, 0), h[at]


def from_text(window: int, ranges: int, groups: int, width: int):
    table = K.space_words()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for b in batches:
            counts, h = text_windows(b.column("text"), window, table, False)
            held.append((np.asarray(b.column("id"), I8), np.asarray(b.column("th"), I8), counts, h, np.zeros(0, U8)))
            size += len(h)
            if size >= FLUSH_WINDOWS:
                yield flush(*map(np.concatenate, zip(*held)), ranges, groups, width)
                held, size = [], 0
        if size:
            yield flush(*map(np.concatenate, zip(*held)), ranges, groups, width)

    return run


def from_state(ranges: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for b in batches:
            for ids, ths, counts, h, check in zip(*(b.column(c).to_pylist() for c in ("ids", "ths", "counts", "hashes", "checks"))):
                held.append((np.frombuffer(ids, I8), np.frombuffer(ths, I8), np.frombuffer(counts, np.int32).astype(I8), np.frombuffer(h, U8), np.frombuffer(check, U8)))
                size += len(held[-1][3])
                if size >= FLUSH_WINDOWS:
                    yield flush(*map(np.concatenate, zip(*held)), ranges, groups)
                    held, size = [], 0
        if size:
            yield flush(*map(np.concatenate, zip(*held)), ranges, groups)

    return run


def join_column(t: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(t.column(name).to_pylist()), kind)


def answer(ranges: int, groups: int, width: int = 8):
    def run(t: pa.Table) -> pa.Table:
        dest = t.column("dest")[0].as_py()
        out = []
        if dest >= ranges:
            c = {n: t.column(n).to_pylist() for n in ("ids", "ths", "fs", "counts", "bits")}
            out = [(dest - ranges, -1, *x[:4], x[4], x[4]) for x in zip(*c.values())]
            return pa.Table.from_batches([rows(REPLY, out)])
        ids, ths, fs = (join_column(t, n, I8) for n in ("ids", "ths", "fs"))
        counts, h = join_column(t, "counts", np.int32).astype(I8), from_low(b"".join(t.column("hashes").to_pylist()), width)
        again = np.concatenate([unbits(b, len(x) // width) for b, x in zip(t.column("bits").to_pylist(), t.column("hashes").to_pylist())])
        check = join_column(t, "checks", U8)
        del t
        order = by_value(h, check)
        at = heads(h, check, order)
        del h, check
        sizes = np.diff(np.append(at, len(order)))
        who = np.repeat(ids, counts)[order]
        low = np.minimum.reduceat(who, at)
        many = (np.maximum.reduceat(who, at) != low) | (np.add.reduceat(again[order], at) > 0)
        rep, flag = np.zeros(len(order), bool), np.zeros(len(order), bool)
        rep[order] = np.repeat(many, sizes)
        flag[order] = who > np.repeat(low, sizes)
        first = np.cumsum(counts) - counts
        some = np.flatnonzero(np.add.reduceat(rep, first) > 0)
        q = group_of(ids[some], ths[some], groups)
        order = np.argsort(q, kind="stable")
        some, q = some[order], q[order]
        for g, i, j in zip(*(lambda u, s: (u, s, np.append(s[1:], len(q))))(*np.unique(q, return_index=True))):
            d = some[i:j]
            x = spans(first[d], counts[d])
            out.append((int(g), dest, ids[d].tobytes(), ths[d].tobytes(), fs[d].tobytes(), counts[d].astype(np.int32).tobytes(), bits(rep[x]), bits(flag[x])))
        return pa.Table.from_batches([rows(REPLY, out)])

    return run


def decide(ids: np.ndarray, ths: np.ndarray, counts: np.ndarray, h: np.ndarray, replies: pa.Table, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a group's windows: those that are repeated, and those that an earlier document has.

    ids, ths: distinct keys. A key that came in several batches (a repeated row) has
    answers for each of them, which are joined.
    """
    rep, flag = np.zeros(len(h), bool), np.zeros(len(h), bool)
    index = {k: i for i, k in enumerate(zip(ids.tolist(), ths.tolist()))}
    first = np.cumsum(counts) - counts
    settled: dict[tuple[int, int], np.ndarray] = {}  # of (document, batch), by the batch itself
    rounds: dict[int, list] = {}  # batch ids of a document, to keep the answers of repeated rows apart
    packed = [{n: x for n, x in zip(replies.column_names, v)} for v in zip(*(c.to_pylist() for c in replies.columns))] if replies.num_rows else []
    for r in packed:
        docs = [index.get(k, -1) for k in zip(np.frombuffer(r["ids"], I8).tolist(), np.frombuffer(r["ths"], I8).tolist())]
        r["docs"], r["fs"], r["counts"] = np.array(docs, I8), np.frombuffer(r["fs"], I8), np.frombuffer(r["counts"], np.int32).astype(I8)
        if r["p"] < 0:
            later, at = unbits(r["rep"], int(r["counts"].sum())), 0
            for d, f, n in zip(docs, r["fs"].tolist(), r["counts"].tolist()):
                if d >= 0:
                    settled[d, f] = later[at : at + n]
                at += n
        for d, f in zip(docs, r["fs"].tolist()):
            if f not in rounds.setdefault(d, []):
                rounds[d].append(f)
    most = max(map(len, rounds.values()), default=0)
    dest = part(h, ranges)
    for k in range(most):
        sent = np.ones(len(h), bool)
        turn = np.zeros(len(ids), I8)
        has = np.zeros(len(ids), bool)
        for d, fs in rounds.items():
            if d >= 0 and k < len(fs):
                turn[d], has[d] = fs[k], True
                if (late := settled.get((d, fs[k]))) is not None:
                    x = slice(first[d], first[d] + counts[d])
                    sent[x] = ~late
                    rep[x] |= late
                    flag[x] |= late
        by = np.flatnonzero(sent)
        by = by[np.argsort(dest[by].astype(np.uint16 if ranges < 65536 else I8), kind="stable")]
        edges = np.searchsorted(dest[by], np.arange(ranges + 1))
        for r in packed:
            if r["p"] < 0:
                continue
            mine = (r["docs"] >= 0) & has[r["docs"]] & (turn[r["docs"]] == r["fs"])
            x = by[edges[r["p"]] : edges[r["p"] + 1]]
            d, n = r["docs"][mine], r["counts"][mine]
            to = x[spans(np.searchsorted(x, first[d]), n)]
            total = int(r["counts"].sum())
            of = spans((np.cumsum(r["counts"]) - r["counts"])[mine], n)
            rep[to] |= unbits(r["rep"], total)[of]
            flag[to] |= unbits(r["flag"], total)[of]
    return rep, flag


def doubled(length: int, counts: np.ndarray, positions: np.ndarray, h: np.ndarray, check: np.ndarray, rep: np.ndarray) -> tuple[np.ndarray, ...]:
    """Candidates of twice the length: counts a document, positions, hashes and checks."""
    doc = np.repeat(np.arange(len(counts)), counts)
    wide = int(positions.max(initial=0)) + 2 * length + 1
    flat = doc[rep] * wide + positions[rep]
    at = np.searchsorted(flat, flat + length)
    ok = np.flatnonzero((at < len(flat)) & (flat[np.minimum(at, len(flat) - 1)] == flat + length)) if len(flat) else np.zeros(0, I8)
    made = [K.mix(x[rep][ok] * K.KEYS[a] + x[rep][at[ok]] * K.KEYS[b] + U8(length)) for x, a, b in ((h, 4, 5), (check, 8, 9))]
    return np.bincount(flat[ok] // wide, minlength=len(counts)), flat[ok] % wide, *made


def state_columns(q: int, ids, ths, counts, positions, h, check) -> tuple:
    d = np.flatnonzero(counts)
    return (q, ids[d].tobytes(), ths[d].tobytes(), counts[d].astype(np.int32).tobytes(), pa.compress(np.diff(positions, prepend=0).astype(np.int32).tobytes(), "zstd", asbytes=True), h.tobytes(), check.tobytes())


def packed_by_group(groups: int, answered: Bitmap):
    """Rows whose (id, th) is marked as answered, dealt by group and packed: compressed columns shuffle at about a
    third of the size of plain rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def packs() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks()
            q = group_of(t.column("id").to_numpy().astype(I8), t.column("th").to_numpy().astype(I8), groups)
            order = np.argsort(q, kind="stable")
            found, at = np.unique(q[order], return_index=True)
            for g, i, j in zip(found.tolist(), at.tolist(), [*at[1:].tolist(), len(q)]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_table(t.take(pa.array(order[i:j])))
                yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["q", "pack"])

        size = 0
        for b in batches:
            b = b.filter(pa.array(answered.marked(key_hash(np.asarray(b.column("id"), I8), np.asarray(b.column("th"), I8)))))
            held.append(b)
            size += b.nbytes
            if size >= PACK_BYTES:
                yield from packs()
                held, size = [], 0
        if size:
            yield from packs()

    return run


def unpacked(column: pa.ChunkedArray) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in column]).combine_chunks()


def exchange(blocks: DataFrame, ranges: int, groups: int, width: int = 8, per_task: int = 1) -> DataFrame:
    return blocks.repartition(-(-(ranges + groups) // per_task), "dest").groupBy("dest").applyInArrow(answer(ranges, groups, width), REPLY)


def distinct_keys(docs_t: pa.Table) -> tuple[np.ndarray, ...]:
    """Of a group's rows: ids and text hashes, a row of each distinct key, and each row's key."""
    ids, ths = (docs_t.column(c).to_numpy().astype(I8) for c in ("id", "th"))
    order = np.lexsort((ths, ids))
    new = np.ones(len(order), bool)
    new[1:] = (ids[order][1:] != ids[order][:-1]) | (ths[order][1:] != ths[order][:-1])
    key_of = np.empty(len(order), I8)
    key_of[order] = np.cumsum(new) - 1
    return ids, ths, order[new], key_of


def candidates(key: DataFrame, window: int, ranges: int, groups: int, n_bits: int) -> DataFrame:
    """The candidates of `window` words: both halves are repeated in another document."""
    half = (window + 1) // 2
    table = K.space_words()
    replies = cut(exchange(map_batches(key.select("id", "th", "text"), from_text(half, ranges, groups, FIRST_BYTES), BLOCK), ranges, groups, FIRST_BYTES))
    release(key.sparkSession, 4)
    marks = replies.select("ids", "ths").coalesce(-(-(ranges + groups) // KEYS_PER_TASK))  # a bitmap a task, whatever it marks
    answered = bitmap(marks, lambda b: key_hash(longs(b, "ids"), longs(b, "ths")), n_bits)
    left = map_batches(key.select("id", "th", "text"), packed_by_group(groups, answered), "q int, pack binary")

    def settle(docs_t: pa.Table, replies_t: pa.Table) -> pa.Table:
        if not docs_t.num_rows or not replies_t.num_rows:  # a mark that another key has too
            return pa.Table.from_batches([rows(STATE, [])])
        q = docs_t.column("q")[0].as_py()
        docs_t = unpacked(docs_t.column("pack"))
        ids, ths, one, _ = distinct_keys(docs_t)
        buf, offsets = K.text_buffer(docs_t.column("text").take(pa.array(one)))
        starts, ends, first = K.word_spans(buf, offsets, table)
        words = K.word_hashes(buf, starts, ends, False)
        n = np.diff(first)
        counts = np.maximum(n - half + 1, 0)
        pos = spans(first[:-1], counts)
        rep, _ = decide(ids[one], ths[one], counts, K.window_hashes(words, half)[pos], replies_t, ranges)
        known = np.zeros(len(words) + window, bool)
        known[pos[rep]] = True
        wide = np.maximum(n - window + 1, 0)
        at = spans(first[:-1], wide)
        at = at[known[at] & known[at + window - half]]
        doc = K.owner(first, at)
        if not len(at):
            return pa.Table.from_batches([rows(STATE, [])])
        check = K.window_hashes(K.word_hashes(buf, starts, ends, False, other=True), window, 1)[at]
        state = state_columns(q, ids[one], ths[one], np.bincount(doc, minlength=len(one)), at - first[doc], K.window_hashes(words, window)[at], check)
        return pa.Table.from_batches([rows(STATE, [state])])

    return cut(left.repartition(groups, "q").groupBy("q").cogroup(replies.repartition(groups, "q").groupBy("q")).applyInArrow(settle, STATE))


def next_level(state: DataFrame, length: int, ranges: int, groups: int, flags: bool = False) -> DataFrame:
    """Rows (q, id, th, length, and with flags the windows that an earlier document has) of
    documents with a repeated window of this length, and the candidates of twice the length."""
    n = -(-groups // PER_TASK)
    replies = cut(exchange(map_batches(state.coalesce(n), from_state(ranges, groups), BLOCK), ranges, groups, per_task=PER_TASK))
    release(state.sparkSession, 4)  # the hashes are sent again, with their positions, when the blocks are gone
    names = [x.split()[0] for x in f"{DONE}, {STATE}".replace("q int, ids", "to int, ids").split(", ")]

    def settle(state_t: pa.Table, replies_t: pa.Table) -> pa.Table:
        done: list[tuple] = []
        out: list[tuple] = []
        for q, *r in zip(*(state_t.column(c).to_pylist() for c in ("q", "ids", "ths", "counts", "positions", "hashes", "checks"))):
            ids, ths, counts, h, check = (np.frombuffer(x, k) for x, k in zip((r[0], r[1], r[2], r[4], r[5]), (I8, I8, np.int32, U8, U8)))
            counts = counts.astype(I8)
            positions = np.cumsum(np.frombuffer(pa.decompress(r[3], 4 * len(h), "zstd", asbytes=True), np.int32), dtype=I8)
            rep, flag = decide(ids, ths, counts, h, replies_t, ranges)
            if rep.any():
                first = np.cumsum(counts) - counts
                for d in np.flatnonzero(np.add.reduceat(rep, first)).tolist():
                    x = slice(first[d], first[d] + counts[d])
                    done.append((q, int(ids[d]), int(ths[d]), length, runs(positions[x][flag[x]]) if flags else None))
                n2, p2, *more = doubled(length, counts, positions, h, check, rep)
                if len(p2):
                    out.append(state_columns(q, ids, ths, n2, p2, *more))
        a, b = rows(DONE, done), rows(STATE, out)
        columns = [pa.concat_arrays([c, pa.nulls(len(out), c.type)]) for c in a.columns] + [pa.concat_arrays([pa.nulls(len(done), c.type), c]) for c in b.columns]
        return pa.Table.from_arrays(columns, names)

    schema = f"{DONE}, {STATE}".replace("q int, ids", "to int, ids")
    return cut(state.repartition(n, "q").groupBy("q").cogroup(replies.repartition(n, "q").groupBy("q")).applyInArrow(settle, schema))


def cut_texts(key: DataFrame, done: DataFrame, window: int, keep_text: bool, groups: int, n_bits: int) -> DataFrame:
    """One row a document: row, n_words, n_removed, kept (or its sha256) and longest_repeat."""
    touched = bitmap(done.select("id", "th"), lambda b: key_hash(np.asarray(b.column("id"), I8), np.asarray(b.column("th"), I8)), n_bits)
    left = map_batches(key, packed_by_group(groups, touched), "q int, pack binary")
    schema = fields(key, ["row"], "n_words bigint, n_removed bigint, kept string, longest_repeat bigint")
    empty, table = to_arrow_schema(schema), K.space_words()

    def left_over(buf, offsets, starts, ends, first, i: int, gone) -> str:
        a, z, o = first[i], first[i + 1], offsets[i]
        data = K.kept_bytes(buf[o : offsets[i + 1]], starts[a:z] - o, ends[a:z] - o, np.ones(z - a, bool) if gone is None else ~gone)
        return data.decode("utf-8", "replace") if keep_text else hashlib.sha256(data).hexdigest()

    def out(row, *columns) -> list:
        return [row, *(pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.int64())))]

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents without a repeated window keep all words."""
        for b in batches:
            b = b.filter(pa.array(~touched.marked(key_hash(np.asarray(b.column("id"), I8), np.asarray(b.column("th"), I8)))))
            buf, offsets = K.text_buffer(b.column("text"))
            starts, ends, first = K.word_spans(buf, offsets, table)
            kept = [left_over(buf, offsets, starts, ends, first, i, None) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays(out(b.column("row"), np.diff(first), np.zeros(b.num_rows, I8), kept, np.zeros(b.num_rows, I8)), empty.names)

    def settle(docs_t: pa.Table, done_t: pa.Table) -> pa.Table:
        if not docs_t.num_rows:
            return pa.Table.from_batches([], empty)
        docs_t = unpacked(docs_t.column("pack"))
        ids, ths, one, key_of = distinct_keys(docs_t)
        found: dict[tuple[int, int], tuple[int, bytes]] = {}
        for i, t, n, x in zip(*(done_t.column(c).to_pylist() for c in ("id", "th", "length", "flagged"))):
            old = found.get((i, t), (0, b""))
            found[i, t] = (max(n, old[0]), x or old[1])
        buf, offsets = K.text_buffer(docs_t.column("text").take(pa.array(one)))
        starts, ends, first = K.word_spans(buf, offsets, table)
        made = []
        for u, k in enumerate(one.tolist()):
            n = int(first[u + 1] - first[u])
            longest, at = found.get((int(ids[k]), int(ths[k])), (0, b""))
            gone = K.covered(from_runs(at), window, n) if at else None
            made.append((n, 0 if gone is None else int(gone.sum()), left_over(buf, offsets, starts, ends, first, u, gone), longest))
        return pa.Table.from_arrays(out(docs_t.column("row"), *zip(*[made[u] for u in key_of.tolist()])), empty.names)

    cogrouped = left.repartition(groups, "q").groupBy("q").cogroup(done.repartition(groups, "q").groupBy("q"))
    return cogrouped.applyInArrow(settle, schema).unionAll(map_batches(key, untouched, schema))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, keep_text: bool = True, carry: list[str] | None = None) -> DataFrame:
    """One row a document: row (struct of `carry`, all columns unless given), n_words,
    n_removed, kept (the words left, or their sha256 unless keep_text) and longest_repeat:
    the longest of the doubled window lengths at which a window of the document also occurs
    in another one (0: none). window: 2 words at least."""
    if window < 2:
        raise ValueError(f"window must be 2 or more words, not {window}")
    size = text_bytes(docs, text_col)
    ranges, groups, n_bits = max(16, -(-size // RANGE_BYTES)), max(64, -(-size // GROUP_BYTES)), bit_count(size // 512)
    key = keyed(docs, id_col, text_col, carry)
    state, length, found = candidates(key, window, ranges, groups, n_bits), window, []
    names = [x.split()[0] for x in STATE.split(", ")]
    release(docs.sparkSession, 4)  # texts and answers of the first level
    while not state.isEmpty():
        level = next_level(state, length, ranges, groups, length == window)
        # the few rows by themselves: kept with the level they would keep the candidates on disk to the end
        short = level.where("ids IS NULL").select([x.split()[0] for x in DONE.split(", ")])
        found.append(cut(short.coalesce(-(-groups // KEYS_PER_TASK))))
        state, length = level.where("ids IS NOT NULL").select(F.col("to").alias("q"), *names[1:]), 2 * length
        release(docs.sparkSession, 4)
    done = docs.sparkSession.createDataFrame([], DONE) if not found else found[0]
    for x in found[1:]:
        done = done.unionAll(x)
    return cut_texts(key, done, window, keep_text, groups, n_bits)


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table as read

    out = substring_dedup(read(spark, sf_dir, "documents"), keep_text=False, carry=["doc_id"])
    return out.select("row.doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"), "longest_repeat")
