"""External induced sorting of suffixes, with common-prefix values.

Suffixes are of type S if they sort before their right neighbour, else L. The order of the
leftmost S suffixes of each run (LMS) is found by recursion, whatever the alphabet, on the
string of their named substrings; from it one ascending scan induces all L suffixes and one
descending scan all S suffixes. Tuples (first symbol, position, common prefix) go through a
monotone priority queue: as the number of tuples of each symbol is known, the queue is one
region a symbol, filled in the order of arrival and read in the order of symbols. A scan
takes as many symbols at once as get no further tuples from one another, in waves of
bounded size.

Common prefixes, in bytes and capped, are carried through the recursion: each name has the
bytes it stands for and a common prefix with the name before it, so that the prefix of two
induced suffixes is their first symbol's bytes plus the least value between their sources
in the scan. From the recursion they are lower bounds (a substring that is the beginning of
another one can share more than is seen there); in the text itself they are made exact by
comparing on from the bound.

All arrays that grow with the shard are held in memory only while they fit into `limit`
bytes; the others are files mapped into memory, so a shard can be far larger than memory.

Strings end in separators, the smallest symbols, all different, so no match spans two
strings. Only `cap` bytes of order matter: suffixes that agree in as many stay in any order.
"""

from __future__ import annotations

import tempfile

import numpy as np

LIMIT = 192 << 20
STEP = 1 << 17
I8 = np.int64


class Scratch:
    """Arrays in memory up to a limit in bytes, then in unlinked files mapped into memory."""

    def __init__(self, limit: int, step: int):
        self.left, self.step, self.mapped = limit, step, 0

    def empty(self, n: int, kind) -> np.ndarray:
        size = n * np.dtype(kind).itemsize
        if size <= self.left:
            self.left -= size
            return np.empty(n, kind)
        self.mapped += size
        with tempfile.TemporaryFile() as f:
            f.truncate(size)
            return np.memmap(f, kind, "r+", shape=(n,))

    def full(self, n: int, value, kind) -> np.ndarray:
        out = self.empty(n, kind)
        out[:] = value
        return out

    def drop(self, *arrays: np.ndarray) -> None:
        """The caller no longer uses these arrays."""
        self.left += sum(a.nbytes for a in arrays if not isinstance(a, np.memmap))

    def chunks(self, n: int):
        return ((a, min(n, a + self.step)) for a in range(0, n, self.step))


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenated ranges start, start + 1, ... of the given lengths."""
    if not len(starts):
        return np.zeros(0, I8)
    ends = np.cumsum(counts)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - counts), counts)


class Minima:
    """Range minima of a small-valued array."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while (1 << len(self.rows)) <= len(values):
            last, half = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def over(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum of values[low .. high], both included, low <= high."""
        out = np.empty(len(low), np.uint8)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.flatnonzero(np.bincount(level)).tolist() if len(level) else []:
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.rows[k][low[at]], self.rows[k][high[at] - (1 << k) + 1])
        return out


def least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low .. high] of each pair of bounds, both included."""
    if not len(low):
        return np.zeros(0, np.uint8)
    if int((high - low).sum()) > 24 * len(values):
        return Minima(values).over(low, high)
    bounds = np.empty(2 * len(low), I8)
    bounds[::2], bounds[1::2] = low, high + 1
    if int(high.max()) + 1 == len(values):  # no bound may be the end
        values = np.append(values, np.uint8(255))
    return np.minimum.reduceat(values, bounds)[::2]


class Level:
    """A string of one level of the recursion.

    t: symbols; the first `uniq` symbols occur once each, in ascending order, and the last
    symbol is one of them. weight: bytes of each symbol and edge: common prefix of each
    symbol with the one before it, or both None in the text itself. origin: where in the
    text each symbol starts (None: the text itself).
    """

    def __init__(self, t, uniq: int, size: int, weight, edge, origin, cap: int, scratch: Scratch):
        self.t, self.uniq, self.size, self.weight, self.edge, self.origin = t, uniq, size, weight, edge, origin
        self.cap, self.scratch, self.n = cap, scratch, len(t)
        self.place = np.int32 if self.n < 2**31 else I8
        self.ranges = Minima(edge) if edge is not None and len(edge) * 20 <= max(scratch.left, 1 << 20) else None
        self.run = self.runs() if edge is not None else None
        self.is_s = self.types()
        self.counts()

    def types(self) -> np.ndarray:
        """True for S; the last symbol, a separator, is S."""
        t, n, out = self.t, self.n, self.scratch.empty(self.n, bool)
        out[n - 1] = True
        for b in range(n - 1, 0, -self.scratch.step):
            a = max(0, b - self.scratch.step)
            x = np.asarray(t[a : b + 1])
            # the next place where symbols differ decides for those before it
            place = np.where(x[:-1] == x[1:], b - a, np.arange(b - a))
            place = np.minimum.accumulate(place[::-1])[::-1]
            out[a:b] = np.append(x[:-1] < x[1:], out[b])[place]
        return out

    def runs(self) -> np.ndarray:
        """How many symbols like its own directly precede each symbol."""
        out, before = self.scratch.empty(self.n, self.place), 0
        for a, b in self.scratch.chunks(self.n):
            at = np.arange(a, b)
            new = np.ones(b - a, bool)
            new[1:] = self.t[a + 1 : b] != self.t[a : b - 1]
            if a:
                new[0] = self.t[a] != self.t[a - 1]
            start = np.maximum.accumulate(np.where(new, at, before))
            out[a:b] = at - start
            before = int(start[-1])
        return out

    def counts(self) -> None:
        """Where the bucket of each symbol starts, and how many L suffixes it has."""
        self.large, total = (self.scratch.full(self.size, 0, I8) for _ in range(2))
        for a, b in self.scratch.chunks(self.n):
            x = np.asarray(self.t[a:b])
            for to, of in ((total, x), (self.large, x[~self.is_s[a:b]])):
                if self.size <= 4 * self.scratch.step:
                    to += np.bincount(of, minlength=self.size)
                else:
                    u, c = np.unique(of, return_counts=True)
                    to[u] += c
        self.starts = self.scratch.empty(self.size + 1, I8)
        self.starts[0] = 0
        np.cumsum(total, out=self.starts[1:])
        self.scratch.drop(total)

    def between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Common prefix of two different symbols, low < high, by the names between them."""
        if self.edge is None or self.ranges is None:
            return np.zeros(len(low), np.uint8)
        return self.ranges.over(low + 1, high)

    def shared(self, a: np.ndarray, b: np.ndarray, most: np.ndarray | None = None, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Common prefixes in bytes of suffix pairs, from `start` bytes that are known in the
        text on; and which pairs agree in `most` symbols."""
        out = np.zeros(len(a), np.int16) if start is None else start.astype(np.int16)
        whole = np.zeros(len(a), bool)
        live, k = np.flatnonzero(out < self.cap), 0
        x, y = (z[live].astype(I8) + (0 if start is None else start[live]) for z in (a, b))
        while len(live):
            if most is not None:
                full = most[live] <= k
                whole[live[full]] = True
                live, x, y = live[~full], x[~full], y[~full]
            p, q = self.t[x], self.t[y]
            same = p == q
            if self.edge is not None:
                d = ~same
                out[live[d]] += self.between(np.minimum(p[d], q[d]).astype(I8), np.maximum(p[d], q[d]).astype(I8))
            live, x, y = live[same], x[same] + 1, y[same] + 1
            out[live] += 1 if self.weight is None else self.weight[p[same]]
            k += 1
            short = out[live] < self.cap
            whole[live[~short]] = True  # equal as far as it matters
            live, x, y = live[short], x[short], y[short]
        return np.minimum(out, self.cap).astype(np.uint8), whole


class Scan:
    """One direction of induction: pushes predecessors, with their common prefixes."""

    def __init__(self, level: Level, queue: np.ndarray, lcp: np.ndarray | None, want_s: bool):
        self.v, self.queue, self.lcp, self.want_s = level, queue, lcp, want_s
        own = level.scratch
        self.next = own.empty(level.size, I8)  # the next free place of each region
        self.next[:] = level.starts[1:] if want_s else level.starts[:-1]
        self.stamp = own.full(level.size if lcp is not None else 0, -1, np.int32)  # wave of the last push
        self.rest = own.full(level.size if lcp is not None else 0, 0, np.uint8)  # least value in that wave since
        self.turn, self.at, self.low = 0, [], []  # least values of later waves: a stack that ascends

    def close(self) -> None:
        self.v.scratch.drop(self.next, self.stamp, self.rest)

    def predecessors(self, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which entries push their left neighbour; that neighbour, and its symbol."""
        src = np.flatnonzero(pos > 0)
        before = pos[src] - 1
        key = self.v.t[before]
        ok = (self.v.is_s[before] == self.want_s) & (key >= self.v.uniq)
        return src[ok], before[ok], key[ok]

    def wave(self, pos: np.ndarray, lcp: np.ndarray | None, pushed=None) -> None:
        if not len(pos):
            return
        src, before, key = pushed or self.predecessors(pos)
        if len(src):
            k = key - self.v.uniq
            order = np.argsort(k.astype(np.uint8 if self.v.size - self.v.uniq <= 256 else np.uint16) if self.v.size - self.v.uniq <= 65536 else k, kind="stable")
            src, before, key = src[order], before[order], key[order].astype(I8)
            new = np.empty(len(key), bool)
            new[0] = True
            np.not_equal(key[1:], key[:-1], out=new[1:])
            low = np.flatnonzero(new)
            if len(low) == len(key):  # one a region
                buckets, last, at = key, src, self.next[key]
                self.next[key] = at - 1 if self.want_s else at + 1
                at = at - 1 if self.want_s else at
            else:
                sizes = np.diff(low, append=len(key))
                buckets, last = key[low], src[low + sizes - 1]
                rank = np.arange(len(key)) - np.repeat(low, sizes)
                at = np.repeat(self.next[buckets], sizes)
                at = at - 1 - rank if self.want_s else at + rank
                self.next[buckets] += -sizes if self.want_s else sizes
            self.queue[at] = before
        if lcp is None:
            return
        prefix = np.minimum.accumulate(lcp)
        if len(src):
            values = np.empty(len(src), np.uint8)
            stamp = self.stamp[buckets]
            stack = np.append(np.array(self.low, np.uint8), np.uint8(255))
            since = stack[np.searchsorted(np.array(self.at, I8), stamp, "right")]
            values[low] = np.minimum(np.minimum(prefix[src[low]], since), self.rest[buckets])
            if len(low) < len(key):
                more = np.flatnonzero(~new)
                values[more] = least_between(lcp, src[more - 1] + 1, src[more])
            weight = 1 if self.v.weight is None else self.v.weight[key].astype(np.int16)
            values = np.minimum(values.astype(np.int16) + weight, self.v.cap).astype(np.uint8)
            self.lcp[at] = values
            suffix = np.append(np.minimum.accumulate(lcp[::-1])[::-1], np.uint8(255))
            self.stamp[buckets] = self.turn
            self.rest[buckets] = suffix[last + 1]
        m = int(prefix[-1])
        while self.low and self.low[-1] >= m:
            self.low.pop()
            self.at.pop()
        self.at.append(self.turn)
        self.low.append(m)
        self.turn += 1


def induce(v: Level, seeds: np.ndarray, seed_lcp: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """All suffixes in order, and their common prefixes with the ones before them.

    seeds: the suffixes with unique symbols, then the LMS suffixes, in order. Without
    seed_lcp common prefixes are not kept.
    """
    own, starts, large, keep = v.scratch, v.starts, v.large, seed_lcp is not None
    order = own.empty(v.n, v.place)
    lcp = own.full(v.n, 0, np.uint8) if keep else None
    order[: v.uniq] = seeds[: v.uniq]
    first = own.empty(v.size + 1, I8)  # where the seeds of each symbol start
    symbols = own.empty(len(seeds), np.int32)
    for a, b in own.chunks(len(seeds)):
        symbols[a:b] = v.t[seeds[a:b]]
    for a, b in own.chunks(v.size + 1):
        first[a:b] = np.searchsorted(symbols, np.arange(a, b))
    own.drop(symbols)

    def crossing(symbols: np.ndarray, last: int) -> np.ndarray:
        """Common prefix of the first entries of scanned symbols with the symbols scanned before."""
        out = np.zeros(len(symbols), np.uint8)
        if v.edge is not None and len(symbols):
            before = np.concatenate([[last if last >= 0 else symbols[0]], symbols[:-1]])
            ok = before != symbols
            out[ok] = v.between(np.minimum(before, symbols)[ok], np.maximum(before, symbols)[ok])
        return out

    def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return v.shared(a.astype(I8), b.astype(I8))[0]

    def with_runs(pos: np.ndarray, values: np.ndarray | None, symbol: np.ndarray, down: bool) -> tuple:
        """The entries of some buckets with those that they push into their own bucket: runs of
        one symbol. Prefixes across the ends of runs are lower bounds."""
        many = v.run[pos] + 1
        if len(pos) == 0 or many.max() == 1:
            return pos, values, symbol
        src = np.repeat(np.arange(len(pos)), many)
        turn = np.arange(len(src)) - np.repeat(np.cumsum(many) - many, many)
        symbol = symbol[src]
        order_ = np.lexsort((turn, -symbol if down else symbol))
        src, turn, symbol = src[order_], turn[order_], symbol[order_]
        if keep:  # a neighbour in the run's turn shares one symbol more than turns, the last one of the turn before as many
            first = np.concatenate([[True], (turn[1:] != turn[:-1]) | (symbol[1:] != symbol[:-1])])
            values = np.where(turn == 0, values[src], np.minimum((turn + 1 - first) * v.weight[symbol].astype(I8), v.cap)).astype(np.uint8)
        return pos[src] - turn, values, symbol

    # L suffixes, ascending
    scan = Scan(v, order, lcp, False)
    for a in range(0, v.uniq, own.step):
        pos = np.asarray(seeds[a : min(v.uniq, a + own.step)], I8)
        scan.wave(pos, np.zeros(len(pos), np.uint8) if keep else None)
    c, last, target = v.uniq, -1, 1024
    while c < v.size:
        hi = max(c + 1, int(np.searchsorted(starts, starts[c] + target, "right")) - 1)
        if hi > c + 1 or (v.edge is not None and starts[hi] - starts[c] <= own.step):
            n_l, n_s = scan.next[c:hi] - starts[c:hi], np.diff(first[c : hi + 1])
            from_l = spans(starts[c:hi], n_l)
            large_, values_ = order[from_l].astype(I8), lcp[from_l] if keep else None
            if v.edge is not None:
                large_, values_, symbol = with_runs(large_, values_, np.repeat(np.arange(c, hi), n_l), False)
                n_l = np.bincount(symbol - c, minlength=hi - c)
            total = n_l + n_s
            o = np.cumsum(total) - total
            pos = np.empty(int(total.sum()), I8)
            to_l, to_s = spans(o, n_l), spans(o + n_l, n_s)
            pos[to_l], pos[to_s] = large_, seeds[first[c] : first[hi]]
            pushed = scan.predecessors(pos)
            if v.edge is not None:  # runs are there already
                other = pushed[2] != np.repeat(np.arange(c, hi), total)[pushed[0]]
                pushed = tuple(x[other] for x in pushed)
            least = int(pushed[2].min()) if len(pushed[0]) else hi
            if least > c:
                if least < hi:
                    n = int(o[least - c])
                    keep_src = int(np.searchsorted(pushed[0], n))
                    pushed = tuple(x[:keep_src] for x in pushed)
                    hi, pos, n_l, n_s, total, o = least, pos[:n], *(x[: least - c] for x in (n_l, n_s, total, o))
                    to_l, to_s = spans(o, n_l), spans(o + n_l, n_s)
                    target = max(256, 2 * n)
                else:
                    target = min(2 * target, own.step)
                if v.edge is not None:
                    from_l = spans(starts[c:hi], n_l)
                    order[from_l] = large_[: len(from_l)]
                    scan.next[c:hi] = starts[c:hi] + n_l
                    if keep:
                        lcp[from_l] = values_[: len(from_l)]
                values = None
                some = np.flatnonzero(total)
                if keep:
                    values = np.empty(len(pos), np.uint8)
                    values[to_l], values[to_s] = values_[: len(to_l)], seed_lcp[first[c] : first[hi]]
                    meet = np.flatnonzero((n_l > 0) & (n_s > 0))
                    edge = o[meet] + n_l[meet]
                    values[edge] = both(pos[edge - 1], pos[edge])
                    values[o[some]] = crossing(some + c, last)
                scan.wave(pos, values, pushed)
                last = int(some[-1]) + c if len(some) else last
                c = hi
                continue
            hi, target = c + 1, 256
        done, at, any_l = int(starts[c]), int(starts[c]), False
        while done < scan.next[c]:
            end = min(int(scan.next[c]), done + own.step)
            pos = order[done:end].astype(I8)
            values = np.array(lcp[done:end]) if keep else None
            if keep and done == at:
                values[0] = crossing(np.array([c]), last)[0]
            scan.wave(pos, values)
            done, any_l = end, True
        for a in range(int(first[c]), int(first[c + 1]), own.step):
            b = min(int(first[c + 1]), a + own.step)
            pos = np.asarray(seeds[a:b], I8)
            values = np.array(seed_lcp[a:b]) if keep else None
            if keep and a == first[c]:
                values[0] = both(order[done - 1 : done], pos[:1])[0] if any_l else crossing(np.array([c]), last)[0]
            scan.wave(pos, values)
        if any_l or first[c + 1] > first[c]:
            last = c
        c += 1
    scan.close()
    own.drop(first)
    # S suffixes, descending
    scan = Scan(v, order, lcp, True)
    hi, last, target = v.size, -1, 1024
    while hi > v.uniq:
        lo = min(hi - 1, max(v.uniq, int(np.searchsorted(starts, starts[hi] - target, "left"))))
        if lo < hi - 1 or (v.edge is not None and starts[hi] - starts[lo] <= own.step):
            sym = np.arange(hi - 1, lo - 1, -1)
            ends, mids, begins = starts[sym + 1], starts[sym] + large[sym], starts[sym]
            n_s, n_l = ends - scan.next[sym], mids - begins
            so = np.cumsum(n_s) - n_s
            from_s = np.repeat(ends - 1 + so, n_s) - np.arange(int(n_s.sum()))
            small, values_ = order[from_s].astype(I8), lcp[from_s] if keep else None
            if v.edge is not None:
                small, values_, symbol = with_runs(small, values_, np.repeat(sym, n_s), True)
                n_s = np.bincount(hi - 1 - symbol, minlength=len(sym))
            total = n_s + n_l
            o = np.cumsum(total) - total
            at = np.empty(int(total.sum()), I8)  # places in the order, descending in each symbol
            to_s, to_l = spans(o, n_s), spans(o + n_s, n_l)
            at[to_s] = np.repeat(ends - 1 + o, n_s) - to_s
            at[to_l] = np.repeat(mids - 1 + o + n_s, n_l) - to_l
            pos = np.empty(len(at), I8)
            pos[to_s], pos[to_l] = small, order[at[to_l]]
            pushed = scan.predecessors(pos)
            if v.edge is not None:
                other = pushed[2] != np.repeat(sym, total)[pushed[0]]
                pushed = tuple(x[other] for x in pushed)
            most = int(pushed[2].max()) if len(pushed[0]) else lo - 1
            if most < hi - 1:
                if most >= lo:  # only the symbols above it are complete
                    m = hi - 1 - most
                    n = int(o[m])
                    keep_src = int(np.searchsorted(pushed[0], n))
                    pushed = tuple(x[:keep_src] for x in pushed)
                    lo, at, pos = most + 1, at[:n], pos[:n]
                    sym, ends, mids, begins, n_s, n_l, total, o = (x[:m] for x in (sym, ends, mids, begins, n_s, n_l, total, o))
                    to_s, to_l = spans(o, n_s), spans(o + n_s, n_l)
                    target = max(256, 2 * n)
                else:
                    target = min(2 * target, own.step)
                tails = ends - n_s
                if v.edge is not None:
                    order[at[to_s]] = pos[to_s]
                    scan.next[sym] = tails
                    if keep:
                        lcp[at[to_s]] = values_[: len(to_s)]
                values = None
                some = np.flatnonzero(total)
                if keep:
                    values = np.empty(len(pos), np.uint8)
                    values[to_s] = values_[: len(to_s)]
                    values[to_l] = lcp[np.minimum(at[to_l] + 1, v.n - 1)]
                    meet = np.flatnonzero((n_s > 0) & (n_l > 0))
                    edge = o[meet] + n_s[meet]
                    joint = both(pos[edge], pos[edge - 1])
                    values[edge] = joint
                    values[o[some]] = crossing(sym[some], last)
                    # S entries hold the prefix with their larger neighbour: shift it to the larger one
                    up = np.flatnonzero(n_s > 1)
                    to = spans(tails[up] + 1, n_s[up] - 1)
                    lcp[to] = lcp[to - 1]
                    lcp[tails[meet]] = joint
                    lcp[begins[some]] = 0 if v.edge is None else v.edge[sym[some]]
                scan.wave(pos, values, pushed)
                last = int(sym[some[-1]]) if len(some) else last
                hi = lo
                continue
            lo, target = hi - 1, 256
        c = hi - 1
        begin, mid, end = int(starts[c]), int(starts[c] + large[c]), int(starts[c + 1])
        done = end
        while done > scan.next[c]:
            a = max(int(scan.next[c]), done - own.step)
            pos = order[a:done][::-1].astype(I8)
            values = np.array(lcp[a:done][::-1]) if keep else None
            if keep and done == end:
                values[0] = crossing(np.array([c]), last)[0]
            scan.wave(pos, values)
            done = a
        joint = 0
        if keep and mid > begin:
            joint = both(order[mid - 1 : mid], order[mid : mid + 1])[0] if end > mid else crossing(np.array([c]), last)[0]
        for b in range(mid, begin, -own.step):
            a = max(begin, b - own.step)
            pos = order[a:b][::-1].astype(I8)
            values = None
            if keep:
                values = np.empty(b - a, np.uint8)
                values[1:] = lcp[a + 1 : b][::-1]
                values[0] = joint if b == mid else lcp[b]
            scan.wave(pos, values)
        if keep and end > begin:
            for b in range(end, mid, -own.step):
                a = max(mid + 1, b - own.step)
                if a < b:
                    lcp[a:b] = np.array(lcp[a - 1 : b - 1])
            if begin < mid < end:
                lcp[mid] = joint
            lcp[begin] = 0 if v.edge is None else v.edge[c]
        if end > begin:
            last = c
        hi = c
    scan.close()
    return order, lcp


def collect(own: Scratch, n: int, chosen, kind) -> np.ndarray:
    """The concatenated results of chosen(a, b) over the chunks of n positions."""
    total = sum(len(chosen(a, b)) for a, b in own.chunks(n))
    out, k = own.empty(total, kind), 0
    for a, b in own.chunks(n):
        x = chosen(a, b)
        out[k : k + len(x)] = x
        k += len(x)
    return out


def sorted_suffixes(v: Level) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order (by cap bytes) and their common prefixes with the ones before."""
    own = v.scratch
    star = own.empty(v.n, bool)
    star[0] = False
    for a, b in own.chunks(v.n - 1):
        star[a + 1 : b + 1] = v.is_s[a + 1 : b + 1] & ~v.is_s[a:b]
    lms = collect(own, v.n, lambda a, b: np.flatnonzero(star[a:b]) + a, v.place)
    heads = collect(own, v.n, lambda a, b: np.flatnonzero(v.t[a:b] < v.uniq) + a, v.place)
    seeds, seed_lcp = order_of_lms(v, star, lms, heads)
    own.drop(star, lms, heads)
    if v.origin is None:  # exact from here on
        for a, b in own.chunks(len(seeds) - 1):
            seed_lcp[a + 1 : b + 1] = v.shared(seeds[a:b], seeds[a + 1 : b + 1], start=seed_lcp[a + 1 : b + 1])[0]
    out = induce(v, seeds, seed_lcp)
    own.drop(seeds, seed_lcp, v.is_s, v.large, v.starts)
    if v.run is not None:
        own.drop(v.run)
    return out


def order_of_lms(v: Level, star: np.ndarray, lms: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes with unique symbols, then the other LMS suffixes in order; prefixes."""
    own, n = v.scratch, len(lms)
    # by first symbol: a counting sort through the regions of the symbols
    by_first = own.empty(v.uniq + n, v.place)
    by_first[: v.uniq] = heads
    number = own.full(v.size, 0, I8)
    for a, b in own.chunks(n):
        np.add.at(number, v.t[lms[a:b]], 1)
    number[: v.uniq] = 0
    place = own.empty(v.size, I8)
    np.cumsum(number, out=place)
    place[:] = place - number + v.uniq
    for a, b in own.chunks(n):
        x = np.asarray(lms[a:b])
        s = v.t[x]
        order = np.argsort(s, kind="stable")
        order = order[s[order] >= v.uniq]
        s = s[order].astype(I8)
        if len(s):
            low = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            sizes = np.diff(np.append(low, len(s)))
            by_first[np.repeat(place[s[low]] - low, sizes) + np.arange(len(s))] = x[order]
            place[s[low]] += sizes
    used = v.uniq + int(number.sum())
    own.drop(number, place)
    rough, _ = induce(v, by_first[:used], None)
    own.drop(by_first)
    singles = heads[star[heads]]
    subs = own.empty(n, v.place)
    subs[: len(singles)] = singles
    rest = collect(own, v.n - v.uniq, lambda a, b: (lambda x: x[star[x]])(rough[a + v.uniq : b + v.uniq]), v.place)
    subs[len(singles) :] = rest
    own.drop(rough, rest)
    # names: LMS substrings in order, equal ones alike
    r, fresh, near = own.empty(n, np.int32 if n < 2**31 else I8), own.full(n, True, bool), own.full(n, 0, np.uint8)

    rank, stop = own.empty(n, np.int32 if n < 2**31 else I8), own.empty(n, v.place)
    for a, b in own.chunks(n):
        rank[a:b] = at = np.searchsorted(lms, subs[a:b])
        stop[a:b] = np.where(at + 1 < n, lms[np.minimum(at + 1, n - 1)], v.n - 1)
    for a, b in own.chunks(n - 1):
        x, y = (np.asarray(subs[i:j], I8) for i, j in ((a, b), (a + 1, b + 1)))
        m, k = stop[a:b] - x + 1, stop[a + 1 : b + 1] - y + 1
        near[a + 1 : b + 1], whole = v.shared(x, y, np.minimum(m, k))
        fresh[a + 1 : b + 1] = ~(whole & ((m == k) | (near[a + 1 : b + 1] >= v.cap)))
    names = 0
    total = int(fresh.sum())
    weight, edge = own.empty(total, np.uint8), own.empty(total, np.uint8)
    for a, b in own.chunks(n):
        x, new, ends = np.asarray(subs[a:b], I8), fresh[a:b], stop[a:b]
        name = names + np.cumsum(new)
        r[rank[a:b]] = name - 1
        span = ends - x if v.origin is None else v.origin[ends] - v.origin[x]
        weight[name[new] - 1] = np.clip(span[new], 1, v.cap)
        edge[name[new] - 1] = near[a:b][new]
        names = int(name[-1])
    edge[0] = 0
    own.drop(fresh, rank, stop)
    if names == n:
        order, lcp = subs, near
    else:
        origin = own.empty(n, v.place)
        for a, b in own.chunks(n):
            origin[a:b] = lms[a:b] if v.origin is None else v.origin[lms[a:b]]
        order, lcp = sorted_suffixes(Level(r, len(singles), names, weight, edge, origin, v.cap, own))
        for a, b in own.chunks(n):
            order[a:b] = lms[order[a:b]]
        own.drop(origin, subs, near)
    own.drop(r, weight, edge)
    seeds, seed_lcp = own.empty(v.uniq + n - len(singles), v.place), own.full(v.uniq + n - len(singles), 0, np.uint8)
    seeds[: v.uniq] = heads
    seeds[v.uniq :], seed_lcp[v.uniq :] = order[len(singles) :], lcp[len(singles) :]
    if len(seeds) > v.uniq:
        seed_lcp[v.uniq] = 0
    own.drop(order, lcp)
    return seeds, seed_lcp


def repeated(data: np.ndarray, sizes: np.ndarray, weights: np.ndarray, length: int, limit: int = LIMIT, step: int = STEP) -> np.ndarray:
    """For each string the positions at which a substring of `length` bytes starts that occurs
    elsewhere in the strings: one value a byte (and one more a string, its end).

    data: the bytes of all strings; sizes: of each, 1 at least; weights: how often each string
    occurs; length at most 254. Strings are taken as different places even if equal.
    """
    m = len(sizes)
    if not m:
        return np.zeros(0, bool)
    own = Scratch(limit, step)
    ends = np.cumsum(sizes + 1) - 1
    n = int(ends[-1]) + 1
    t = own.empty(n, np.int32)
    for a, b in own.chunks(n):
        i, j = np.searchsorted(ends, [a, b])  # separators inside
        inside = np.ones(b - a, bool)
        inside[ends[i:j] - a] = False
        x = np.empty(b - a, np.int32)
        x[inside] = data[a - i : b - j].astype(np.int32) + m
        x[~inside] = np.arange(i, j)
        t[a:b] = x
    order, lcp = sorted_suffixes(Level(t, m, m + 256, None, None, None, length, own))
    own.drop(t)
    hit = own.empty(n, bool)
    hit[:] = False
    # classes of suffixes that agree in `length` bytes; one may go on in the next chunk
    total, waiting = 0, []
    for a, b in own.chunks(n):
        pos, head = np.asarray(order[a:b], I8), np.flatnonzero(lcp[a:b] < length)
        w = weights[np.searchsorted(ends, pos)]
        first = int(head[0]) if len(head) else len(pos)
        total += int(w[:first].sum())
        waiting.append(pos[:first])
        if total > 1:
            for x in waiting:
                hit[x] = True
            waiting = []
        if len(head):
            sums = np.add.reduceat(w, head)
            hit[pos[first:][np.repeat(sums > 1, np.diff(np.append(head, len(pos))))]] = True
            total, waiting = int(sums[-1]), [pos[head[-1] :]]
    return hit
