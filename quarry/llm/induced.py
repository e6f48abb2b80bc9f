"""External suffix sorting by recursive induction, in bulk.

Suffixes are L or S by the order of their first two symbols; S suffixes after an L one (LMS) are sorted first
(their substrings by induction, then by recursion on the string of their names, with the same queues and any number
of names), and all others are induced: L suffixes from left to right, S suffixes from right to left. The priority
queue that carries suffix tuples is monotone, so it is one first-in first-out run for each symbol. The runs lie
side by side in one array, since it is known how many tuples a symbol gets, and popped runs stay there as the order.
Tuples of successive symbols are popped together as long as nothing that they induce belongs between them, so that
an alphabet of a million names takes some thousands of array operations.

An array of more than `held` bytes (types, queues, order, names, common prefixes, bounds of runs) is an unlinked temporary
file that is mapped, and is worked on `chunk` places at a time: memory follows the bounds, disk (about 55 bytes a symbol) the
shard. Of rows of names that occur once the recursion keeps the first only, which settles all comparisons that get there.
The file is a task's own spill, gone with it: a task that starts again elsewhere makes it anew, and nobody else reads it.
Tuples of the last pass carry the length of the prefix they share with their neighbour (up to a cap): a range minimum
over the popped values, plus one. Common prefixes of LMS suffixes, and where a symbol's L suffixes meet its S suffixes, are
compared in the text. A symbol that is repeated k times in a row takes k turns in the last pass.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: Bytes of one array that are held in memory; longer arrays are files.
HELD = 32_000_000
#: Places that are worked on at once.
CHUNK = 1 << 18


class Store:
    """Makes arrays, in memory up to a bound of bytes each and mapped from unlinked files beyond it."""

    def __init__(self, held: int = HELD, chunk: int = CHUNK):
        self.held, self.chunk, self.spilled = held, chunk, 0

    def array(self, n: int, dtype, value: int = 0) -> np.ndarray:
        size = n * np.dtype(dtype).itemsize
        if size <= self.held:
            return np.full(n, value, dtype)
        self.spilled += size
        with tempfile.TemporaryFile() as file:
            file.truncate(size)
            out = np.memmap(file, dtype, "r+", shape=(n,)).view(np.ndarray)
        if value:
            for a, b in self.parts(n):
                out[a:b] = value
        return out

    def tally(self, counts: np.ndarray, values: np.ndarray) -> None:
        """Adds the number of each value to its count."""
        if len(counts) <= self.chunk:
            counts += np.bincount(values, minlength=len(counts))
        else:
            some, n = np.unique(values, return_counts=True)
            counts[some] += n

    def sums(self, counts: np.ndarray) -> np.ndarray:
        """Zero, and the sums up to each count."""
        out = self.array(len(counts) + 1, np.int64)
        for a, b in self.parts(len(counts)):
            out[a + 1 : b + 1] = out[a] + np.cumsum(counts[a:b])
        return out

    def copy(self, v: np.ndarray) -> np.ndarray:
        out = self.array(len(v), v.dtype)
        out[:] = v
        return out

    def parts(self, n: int):
        return ((a, min(a + self.chunk, n)) for a in range(0, n, self.chunk))


def suffix_types(t: np.ndarray, store: Store) -> np.ndarray:
    """True for S; the end counts as smaller than any symbol."""
    n = len(t)
    s = store.array(n, bool)
    after = False  # type of the place after the part
    for a, b in reversed(list(store.parts(n - 1))):
        here, following = t[a:b], t[a + 1 : b + 1]
        m = b - a
        nxt = np.where(here == following, m, np.arange(m))
        nxt = np.minimum.accumulate(nxt[::-1])[::-1]
        s[a:b] = np.append(here < following, after)[nxt]
        after = bool(s[a])
    return s


def _range_min(v: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of v[lo..hi], ends included, by doubled windows."""
    width = hi - lo + 1
    level = np.frexp(width.astype(np.float64))[1] - 1
    out = np.empty(len(lo), v.dtype)
    table, k = v, 0
    while True:
        at = level == k
        if at.any():
            out[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << k) + 1])
        k += 1
        if k > level.max(initial=0):
            return out
        half = 1 << (k - 1)
        table = np.minimum(table[: len(table) - half], table[half:])


class _Words:
    """For every place the next symbols, plus one each, as one number; zeros stand beyond the end."""

    def __init__(self, t: np.ndarray, symbols: int, store: Store):
        n = len(t)
        self.bits = int(symbols).bit_length()
        self.step = max(1, 63 // self.bits)
        self.n = n
        self.word = store.array(n + 1, np.int64)
        for a, b in store.parts(n):
            padded = np.zeros(b - a + self.step, np.int64)
            some = t[a : min(b + self.step, n)]
            padded[: len(some)] = some
            padded[: len(some)] += 1
            word = np.zeros(b - a, np.int64)
            for k in range(self.step):
                word <<= self.bits
                word |= padded[k : k + len(word)]
            self.word[a:b] = word

    def common(self, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
        """Common prefixes, up to cap, of suffixes at a and at b."""
        out = np.zeros(len(a), np.int64)
        live, done = np.arange(len(a)), 0
        while len(live) and done < cap:
            x = self.word[np.minimum(a + done, self.n)] ^ self.word[np.minimum(b + done, self.n)]
            apart = x != 0
            y = x[apart]
            lead = np.frexp(y.astype(np.float64))[1] - 1  # highest differing bit, rounding may lift it by one
            lead = np.where((y >> np.minimum(lead, 62)) == 0, lead - 1, lead)
            out[live[apart]] = done + (self.step - 1 - lead // self.bits)
            same = ~apart
            live, a, b = live[same], a[same], b[same]
            done += self.step
            out[live] = done
        return np.minimum(out, cap).astype(np.uint8)

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the symbols (length of them) at a are those at b."""
        same = np.zeros(len(a), bool)
        live, done = np.arange(len(a)), 0
        whole = self.bits * self.step
        masks = np.array([(1 << whole) - (1 << (whole - self.bits * r)) for r in range(self.step + 1)], np.int64)
        while len(live):
            left = length - done
            near = (self.word[np.minimum(a + done, self.n)] ^ self.word[np.minimum(b + done, self.n)]) & masks[np.minimum(left, self.step)] == 0
            same[live[near & (left <= self.step)]] = True
            near &= left > self.step
            live, a, b, length = live[near], a[near], b[near], length[near]
            done += self.step
        return same


class _Queue:
    """Runs of suffix tuples by symbol, and the pass over them in one direction."""

    def __init__(self, t, code, begin, split, order, lcp, words, cap, store):
        self.t, self.code, self.begin, self.split = t, code, begin, split
        self.order, self.lcp, self.words, self.cap, self.store = order, lcp, words, cap, store
        self.symbols = len(begin) - 1
        self.runs, self.whole = None, -1  # where a place's repeated symbol begins; the symbol whose run has all its turns

    def start(self, up: bool) -> None:
        self.up = up
        self.head = self.store.copy(self.begin[:-1] if up else self.begin[1:])  # next free place (up), last used one (down)
        if self.cap:
            self.least = np.full(self.symbols, 255, np.uint8)  # of common prefixes popped since a symbol's last push
            self.begun = np.zeros(self.symbols, bool)

    def before(self, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the popped suffixes induce one in this pass, where, and its symbol."""
        j = pos - 1
        code = self.code.take(j, mode="wrap")  # symbol, then 1 for S
        use = (code & 1) != self.up
        use &= j >= 0
        if self.whole >= 0:  # what stays in this symbol's run is there already
            use &= code >> 1 != self.whole
        at = np.flatnonzero(use)
        return at, j[at], code[at] >> 1

    def induce(self, at: np.ndarray, j: np.ndarray, sym: np.ndarray, lcp: np.ndarray | None) -> None:
        if len(at):
            if len(at) == 1:
                by = np.zeros(1, np.int64)
            elif self.symbols <= 1 << 15:
                by = np.argsort(sym, kind="stable")
            else:
                shift = len(sym).bit_length()
                by = np.sort((sym.astype(np.int64) << shift) | np.arange(len(sym))) & ((1 << shift) - 1)
            j, sym = j[by], sym[by]
            new = np.empty(len(sym), bool)
            new[0] = True
            np.not_equal(sym[1:], sym[:-1], out=new[1:])
            edges = np.flatnonzero(new)
            some = sym[edges]
            free = self.head[some]
            if len(edges) == len(sym):
                dest = free if self.up else free - 1
                self.head[some] = free + 1 if self.up else dest
            else:
                counts = np.diff(edges, append=len(sym))
                rank = np.arange(len(sym)) - np.repeat(edges, counts)
                dest = np.repeat(free, counts) + rank if self.up else np.repeat(free - 1, counts) - rank
                self.head[some] = free + counts if self.up else free - counts
            self.order[dest] = j
        if self.cap:
            if len(at):
                at = at[by]
                prev = np.empty(len(at), np.int64)
                prev[1:] = at[:-1] + 1
                prev[edges] = 0
                low = _range_min(lcp, prev, at)
                low[edges] = np.minimum(low[edges], self.least[some])
                carried = np.minimum(low, self.cap - 1) + np.uint8(1)
                carried[edges[~self.begun[some]]] = 0
                self.begun[some] = True
                self.lcp[dest if self.up else dest + 1] = carried
            np.minimum(self.least, lcp.min(), out=self.least)
            if len(at):
                tail = np.minimum.accumulate(np.append(lcp, np.uint8(255))[::-1])[::-1]
                self.least[some] = tail[at[np.append(edges[1:], len(at)) - 1] + 1]

    def repeat(self, c: int, lo: int, hi: int) -> None:
        """Adds to a symbol's run all that its tuples induce there in turn: suffixes that begin with one symbol more, with
        two more and so on, where it is repeated. Common prefixes take these turns one by one."""
        if self.cap or not 0 < hi - lo <= self.store.chunk // 8:
            return
        pos = self.order[lo:hi].astype(np.int64)
        if not self.up:
            pos = pos[::-1]
        if (self.t[np.maximum(pos - 1, 0)] != c).all():
            return
        if self.runs is None:
            self.runs = self.store.array(len(self.t), self.order.dtype)
            start = 0
            for a, b in self.store.parts(len(self.t)):
                here = self.t[a:b]
                new = np.append(self.t[a - 1] != here[0] if a else True, here[1:] != here[:-1])
                self.runs[a:b] = np.maximum.accumulate(np.where(new, np.arange(a, b), start))
                start = int(self.runs[b - 1])
        times = pos - self.runs[pos]
        if times.sum() > self.store.chunk:
            return
        turn = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        by = np.argsort(turn, kind="stable")
        added = (np.repeat(pos, times) - turn - 1)[by]
        if self.up:
            self.order[hi : hi + len(added)] = added
            self.head[c] = hi + len(added)
        else:
            self.order[lo - len(added) : lo] = added[::-1]
            self.head[c] = lo - len(added)
        self.whole = c

    def pop(self, lo: int, hi: int) -> None:
        """Pops the places lo to hi and induces, in the direction of the pass."""
        step = self.store.chunk
        for a in range(lo, hi, step) if self.up else range(hi, lo, -step):
            x, y = (a, min(a + step, hi)) if self.up else (max(a - step, lo), a)
            pos = self.order[x:y].astype(np.int64)
            lcp = None
            if self.cap:
                lcp = np.array(self.lcp[x:y] if self.up else self.lcp[x + 1 : y + 1])
            if not self.up:
                pos, lcp = pos[::-1], lcp[::-1] if self.cap else None
            self.induce(*self.before(pos), lcp)

    def one(self, c: int) -> None:
        """All of a symbol: what is in its run, what that adds to the run, and the other type after it."""
        lo, mid, hi = int(self.begin[c]), int(self.split[c]), int(self.begin[c + 1])
        if self.up:
            self.repeat(c, lo, int(self.head[c]))
            while lo < (end := int(self.head[c])):
                self.pop(lo, end)
                lo = end
            free = int(self.other[c])
            self.whole = -1
            self.edge(lo, free, int(self.begin[c]), hi)
            self.pop(free, hi)
        else:
            self.repeat(c, int(self.head[c]), hi)
            while hi > (end := int(self.head[c])):
                self.pop(end, hi)
                hi = end
            self.whole = -1
            self.edge(mid, mid, lo, int(self.begin[c + 1]))
            self.pop(lo, mid)

    def edge(self, large_end: int, small: int, lo: int, hi: int) -> None:
        if self.cap and large_end > lo and small < hi:
            self.lcp[small] = self.words.common(np.array([self.order[large_end - 1]], np.int64), np.array([self.order[small]], np.int64), self.cap)[0]

    def run(self, other: np.ndarray) -> None:
        """The whole pass; `other` says where, in an upward one, a symbol's LMS suffixes begin."""
        self.other = other
        c, width = (0, 4096) if self.up else (self.symbols, 4096)
        while c < self.symbols if self.up else c > 0:
            # As many symbols as have about `width` places; common prefixes go symbol by symbol.
            if self.up:
                d = c + 1 if self.cap else max(c + 1, int(np.searchsorted(self.begin, self.begin[c] + width, "right")) - 1)
                lo, hi = int(self.begin[c]), int(self.begin[d])
            else:
                d = c - 1 if self.cap else min(c - 1, int(np.searchsorted(self.begin, self.begin[c] - width, "left")))
                lo, hi = int(self.begin[d]), int(self.begin[c])
            if abs(d - c) == 1:
                self.one(c if self.up else d)
                c = d
                continue
            pos = self.order[lo:hi].astype(np.int64)
            if not self.up:
                pos = pos[::-1]
            pos = pos[pos >= 0]
            if not len(pos):
                c = d
                continue
            at, j, sym = self.before(pos)
            if len(at):
                own = self.t[pos[at]]
                if self.up:
                    reach = np.minimum.accumulate(sym)
                    bad = np.flatnonzero(reach <= own)
                    end = min(int(reach[bad[0]] if len(bad) else reach[-1]), d)
                    k = int(np.searchsorted(own, end, "left"))
                    if end == c:
                        self.one(c)
                        c += 1
                        continue
                else:
                    reach = np.maximum.accumulate(sym)
                    bad = np.flatnonzero(reach >= own)
                    end = max(int(reach[bad[0]] if len(bad) else reach[-1]) + 1, d)
                    k = int(np.searchsorted(-own.astype(np.int64), -end, "right"))
                    if end == c:
                        self.one(c - 1)
                        c -= 1
                        continue
                self.induce(at[:k], j[:k], sym[:k], None)
                width = min(max(256, 2 * abs(int(self.begin[end]) - int(self.begin[c]))), self.store.chunk)
                c = end
            else:
                c, width = d, min(2 * width, self.store.chunk)


def _order_repeated(by, lms, number, names, same, count: int, store: Store) -> None:
    """Puts in order those LMS suffixes of `by` whose names are repeated, by recursion on the string of names.

    A name that occurs once settles all comparisons that reach it, so that of a row of such names only the first is needed."""
    m = len(by)
    often = store.array(m, bool)  # by number
    for a, b in store.parts(m):
        often[number[by[a:b] >> 1]] = same[a:b] | same[a + 1 : b + 1]
    kept, used = store.array(m, names.dtype), store.array(count, bool)
    k = 0
    for a, b in store.parts(m):
        left = often[a - 1 : b - 1] if a else np.append(False, often[: b - 1])
        at = np.flatnonzero(often[a:b] | left) + a
        kept[k : k + len(at)] = at
        used[names[at]] = True
        k += len(at)
    new, found = store.array(count, names.dtype), 0
    for a, b in store.parts(count):
        new[a:b] = found + np.cumsum(used[a:b]) - 1
        found += int(used[a:b].sum())
    text = store.array(k, names.dtype)
    for a, b in store.parts(k):
        text[a:b] = new[names[kept[a:b]]]
    del new, used
    order, _ = _sort(text, found, 0, store)
    del text
    todo = 0  # places of `by` whose suffixes come from the order
    for a, b in store.parts(k):
        at = kept[order[a:b]]
        at = at[often[at]]
        pos = lms[at]
        while len(pos):
            part = same[todo : min(todo + store.chunk, m) + 1]
            free = np.flatnonzero(part[:-1] | part[1:])
            free = free[: len(pos)] + todo
            by[free] = pos[: len(free)]
            pos = pos[len(free) :]
            todo = todo + len(part) - 1 if len(pos) else int(free[-1]) + 1


def _sort(t: np.ndarray, symbols: int, cap: int, store: Store) -> tuple[np.ndarray, np.ndarray | None]:
    n = len(t)
    place = np.int32 if n < 2**30 else np.int64
    s = suffix_types(t, store)
    code = store.array(n, np.uint16 if symbols <= 1 << 15 else place)
    for a, b in store.parts(n):
        code[a:b] = t[a:b]
        code[a:b] <<= 1
        code[a:b] |= s[a:b]
    counts, large, m = store.array(symbols, np.int64), store.array(symbols, np.int64), 0

    def starts(a: int, b: int) -> np.ndarray:
        left = s[a - 1 : b - 1] if a else np.append(True, s[: b - 1])
        return np.flatnonzero(s[a:b] & ~left) + a

    for a, b in store.parts(n):
        store.tally(counts, t[a:b])
        store.tally(large, t[a:b][~s[a:b]])
        m += len(starts(a, b))
    lms, k = store.array(m, place), 0
    for a, b in store.parts(n):
        some = starts(a, b)
        lms[k : k + len(some)] = some
        k += len(some)
    begin = store.sums(counts)
    split = large  # where a symbol's S suffixes begin
    split += begin[:-1]
    del counts
    words = _Words(t, symbols, store)
    last = int(t[n - 1])

    def induced(first, by_symbol: bool, cap: int):
        """Order of all suffixes from LMS ones that are in order, or only among those with equal first symbols."""
        order = store.array(n, place, -1)
        lcp = store.array(n + 1, np.uint8) if cap else None
        queue = _Queue(t, code, begin, split, order, lcp, words, cap, store)
        free = store.copy(begin[1:])
        for a, b in reversed(list(store.parts(m))):
            pos = np.array(first[a:b])
            sym = t[pos]
            if by_symbol:
                by = np.argsort(sym, kind="stable")
                pos, sym = pos[by], sym[by]
            edges = np.flatnonzero(np.append(True, sym[1:] != sym[:-1]))
            width = np.diff(np.append(edges, len(sym)))
            free[sym[edges]] -= width
            dest = np.repeat(free[sym[edges]], width) + np.arange(len(sym)) - np.repeat(edges, width)
            order[dest] = pos
            if cap:
                before = np.append(first[a - 1] if a else pos[0], pos[:-1])
                lcp[dest] = np.where(t[before] == sym, words.common(before.astype(np.int64), pos.astype(np.int64), cap), 0)
                if not a:
                    lcp[dest[0]] = 0
        queue.start(True)
        order[queue.head[last]] = n - 1
        queue.head[last] += 1
        if cap:
            queue.begun[last], queue.least[last] = True, 0
        queue.run(free)
        if cap:
            lcp[split] = 0
        queue.start(False)
        queue.run(free)
        return order, lcp

    if m > 1:
        order, _ = induced(lms, True, 0)
        by = store.array(m, place)
        k = 0
        for a, b in store.parts(n):
            pos = np.array(order[a:b])
            pos = pos[s[pos] & (pos > 0)]
            pos = pos[~s[pos - 1]]
            by[k : k + len(pos)] = pos
            k += len(pos)
        del order
        number = store.array(n // 2 + 1, place)  # of an LMS place among them; no two are neighbours
        for a, b in store.parts(m):
            number[lms[a:b] >> 1] = np.arange(a, b)
        names, same = store.array(m, place), store.array(m + 1, bool)
        name = -1
        for a, b in store.parts(m):
            pos = by[max(a - 1, 0) : b].astype(np.int64)
            at = number[pos >> 1]
            length = lms[np.minimum(at + 1, m - 1)] - pos + 1
            length[at == m - 1] = 0  # runs to the end: equal to none
            alike = np.flatnonzero((length[1:] == length[:-1]) & (length[1:] > 0)) + 1
            equal = np.zeros(len(pos), bool)
            equal[alike] = words.equal(pos[alike], pos[alike - 1], length[alike])
            if a:
                at, equal = at[1:], equal[1:]
            same[a:b] = equal
            called = name + np.cumsum(~equal)
            names[at] = called
            name = int(called[-1])
        if not cap:
            words = None
        if name + 1 < m:
            _order_repeated(by, lms, number, names, same, name + 1, store)
        del number, names, same
        lms = by
    return induced(lms, False, cap)


def suffix_array(t: np.ndarray, symbols: int, cap: int = 100, held: int = HELD, chunk: int = CHUNK, store: Store | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of t (numbers below symbols) in order, and the prefix, up to cap (1 to 255), each shares with the one before."""
    if len(t) == 0:
        return np.zeros(0, np.int32), np.zeros(0, np.uint8)
    order, lcp = _sort(t, symbols, cap, store or Store(held, chunk))
    return order, lcp[:-1]
