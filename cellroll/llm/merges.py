"""Byte-pair merges as tables, and exact last tokens for every prefix of many words at once.

A BPE encoding is fixed by its last token at every prefix: a token sequence is an encoding exactly if all
its neighbouring pairs are *compatible* (encoding the two joined gives the two back).  So the last token of
a prefix is the one vocabulary suffix that is compatible with the last token of what stands before it.

``Merges`` holds the vocabulary over integer symbols: a suffix automaton for the vocabulary suffixes of a
prefix, and each token's last merge for the compatibility test.  ``last_tokens`` walks a trie of sorted
words: consecutive sorted words are the trie in depth-first order, and a prefix that a word shares with the
one before it is not computed again.
"""

from __future__ import annotations

import numpy as np

from .arrays import ramp

_MUL = np.uint64(0x9E3779B97F4A7C15)
CELLS = 1 << 20  # symbols of a slab of words in the trie walk


class IntMap:
    """int64 keys to int32 values, looked up for whole arrays (-1: absent)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.full(1 << bits, -1, dtype=np.int32)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[left[free]]
            own = self.keys[slot] == keys[left]
            self.values[slot[own]] = values[left[own]]
            left, slot = left[~own], (slot[~own] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MUL) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        found = self.keys[slot]
        out = self.values[slot]
        miss = np.flatnonzero((found != keys) & (found != -1))
        out[found == -1] = -1
        slot = slot[miss]
        while len(miss):
            slot = (slot + 1) & self.mask
            found = self.keys[slot]
            out[miss] = np.where(found == keys[miss], self.values[slot], -1)
            on = (found != keys[miss]) & (found != -1)
            miss, slot = miss[on], slot[on]
        return out


def encode_by_merging(symbols: list[int], rank: dict[tuple[int, int], tuple[int, int]]) -> tuple[list[int], tuple]:
    """Plain BPE: merge the lowest rank, leftmost first.  Also gives the last pair that was merged."""
    parts, last = list(symbols), None
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = rank.get((parts[i], parts[i + 1]))
            if r is not None and (best is None or r[0] < best[0]):
                best, at = r, i
        if best is None:
            break
        last = (parts[at], parts[at + 1])
        parts[at:at + 2] = [best[1]]
    return parts, last


class Merges:
    """tokens: symbol tuples by token number; single symbols are tokens of their own.

    ranks: (left token, right token) to (rank, merged token).  The symbol of a single-symbol token t is
    symbol_of[t]; symbols are small ints, 0 standing for one that no token holds.
    """

    def __init__(self, tokens: dict[int, tuple[int, ...]], ranks: dict[tuple[int, int], tuple[int, int]]):
        n = max(tokens) + 1
        single = {t[0]: k for k, t in tokens.items() if len(t) == 1}
        self.n_symbols = max(x for t in tokens.values() for x in t) + 1
        self.length = np.zeros(n + 1, dtype=np.int32)
        self.birth = np.full(n + 1, -1, dtype=np.int64)  # rank of the token's own last merge
        self.left = np.full(n + 1, -1, dtype=np.int32)
        self.right = np.full(n + 1, -1, dtype=np.int32)
        real = []
        for k, t in tokens.items():
            self.length[k] = len(t)
            if len(t) > 1:
                parts, last = encode_by_merging([single[x] for x in t], ranks)
                if parts != [k]:
                    continue  # no text is ever encoded as this token
                self.left[k], self.right[k] = last
                self.birth[k] = ranks[last][0]
            real.append(k)
        self.unknown = n  # stands for a symbol that no token holds; never merges
        self.length[n] = 1
        pair = np.array([(a << 32) | b for a, b in ranks], dtype=np.int64)
        self.pair = IntMap(pair, np.array([r for r, _ in ranks.values()], dtype=np.int32))
        self._automaton({k: tokens[k] for k in real})
        self._memo_key = np.full(1 << 21, -1, dtype=np.int64)
        self._memo = np.zeros(1 << 21, dtype=bool)

    def _automaton(self, tokens: dict[int, tuple[int, ...]]) -> None:
        child: dict[tuple[int, int], int] = {}
        own = [-1]
        for k, t in tokens.items():
            at = 0
            for x in t:
                nxt = child.get((at, x))
                if nxt is None:
                    nxt = child[at, x] = len(own)
                    own.append(-1)
                at = nxt
            own[at] = k
        fail, longest = [0] * len(own), list(own)
        shorter = np.full(len(self.length), -1, dtype=np.int32)
        # states are numbered so that children come after parents of every smaller depth only within one
        # token; breadth first order is needed for the failure links
        by_parent: dict[int, list[tuple[int, int]]] = {}
        for (at, x), nxt in child.items():
            by_parent.setdefault(at, []).append((x, nxt))
        queue = [0]
        for at in queue:
            for x, nxt in by_parent.get(at, ()):
                queue.append(nxt)
                if at:
                    f = fail[at]
                    while f and (f, x) not in child:
                        f = fail[f]
                    fail[nxt] = child.get((f, x), 0)
                if own[nxt] >= 0:
                    shorter[own[nxt]] = longest[fail[nxt]]
                else:
                    longest[nxt] = longest[fail[nxt]]
        self.fail = np.array(fail, dtype=np.int64)
        self.longest, self.shorter = np.array(longest, dtype=np.int32), shorter
        keys = np.array([at * self.n_symbols + x for at, x in child], dtype=np.int64)
        self.step = IntMap(keys, np.array(list(child.values()), dtype=np.int32))

    def advance(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        out = np.zeros(len(state), dtype=np.int64)
        todo = np.flatnonzero(symbol > 0)
        cur = state[todo]
        while len(todo):
            nxt = self.step.get(cur * self.n_symbols + symbol[todo])
            hit = nxt >= 0
            out[todo[hit]] = nxt[hit]
            on = ~hit & (cur > 0)
            todo, cur = todo[on], self.fail[cur[on]]
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether encoding token a followed by token b gives just these two."""
        key = (a.astype(np.int64) << 32) | b
        slot = ((key.astype(np.uint64) * _MUL) >> np.uint64(43)).astype(np.int64)
        out = self._memo[slot]
        miss = np.flatnonzero(self._memo_key[slot] != key)
        if len(miss):
            some, back = np.unique(key[miss], return_inverse=True)
            ok = self._compatible(some >> 32, some & 0xFFFFFFFF)[back]
            out[miss] = ok
            self._memo_key[slot[miss]] = key[miss]
            # two keys of this call may share a slot: keep the value of the key that stands there
            same = self._memo_key[slot[miss]] == key[miss]
            self._memo[slot[miss][same]] = ok[same]
        return out

    def _compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Go back in time along a's right edge and b's left edge; no pair that ever stood side by side may
        have merged before one of its two was merged into its own token (equal ranks: the left one first)."""
        good = np.ones(len(a), dtype=bool)
        at = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        forever = np.int64(2**62)
        end_x, end_y = np.full(len(a), forever), np.full(len(a), forever)
        while len(at):
            r = self.pair.get((x << 32) | y).astype(np.int64)
            bad = (r >= 0) & (r < end_x) & (r <= end_y)
            good[at[bad]] = False
            bx, by = self.birth[x], self.birth[y]
            on = ~bad & ((bx >= 0) | (by >= 0))
            at, x, y, end_x, end_y, bx, by = (v[on] for v in (at, x, y, end_x, end_y, bx, by))
            back = bx > by  # the younger of the two is undone first; of equal ages the right one is younger
            x, end_x = np.where(back, self.right[x], x), np.where(back, bx, end_x)
            y, end_y = np.where(back, y, self.left[y]), np.where(back, end_y, by)
        return good

    def last_tokens(self, words: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last token, token count) of every prefix of sorted words.

        words: symbols, one padded row a word, rows in lexicographic order; size: symbols of each.  Column d
        of the results is for the first d + 1 symbols.
        """
        n, most = words.shape
        token = np.full((n, most), -1, dtype=np.int32)
        count = np.zeros((n, most), dtype=np.int32)
        state = np.zeros(n, dtype=np.int64)
        differs = words[1:] != words[:-1]
        shared = np.where(differs.any(axis=1), differs.argmax(axis=1), most) if n > 1 else np.zeros(0, np.int64)
        shared = np.concatenate([[0], np.minimum(shared, size[:-1])])  # symbols in common with the row before
        for d in range(most):
            new = (shared <= d) & (size > d)
            rows = np.flatnonzero(new)
            if not len(rows):
                continue
            # the node's owner row carries its state; later rows with the same prefix copy it below
            state[rows] = self.advance(state[rows], words[rows, d])
            pick = self.longest[state[rows]]
            pick[words[rows, d] == 0] = self.unknown
            todo = np.arange(len(rows))
            while len(todo):
                r, t = rows[todo], pick[todo]
                before = d - self.length[t]
                prev = np.where(before >= 0, token[r, np.maximum(before, 0)], -1)
                ok = (prev < 0) | (t == self.unknown) | (prev == self.unknown)
                test = np.flatnonzero(~ok)
                ok[test] = self.compatible(prev[test], t[test])
                done = todo[ok]
                token[r[ok], d] = t[ok]
                count[r[ok], d] = 1 + np.where(before[ok] >= 0, count[r[ok], np.maximum(before[ok], 0)], 0)
                todo = todo[~ok]
                pick[todo] = self.shorter[pick[todo]]
                if len(todo) and (pick[todo] < 0).any():
                    raise AssertionError(f"no vocabulary suffix fits a prefix: {words[rows[todo[0]], :d + 1]}, {done}")
            owner = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            copy = np.flatnonzero(~new & (size > d) & (shared > d))
            state[copy] = state[owner[copy]]
            token[copy, d], count[copy, d] = token[owner[copy], d], count[owner[copy], d]
        return token, count

    def slabs(self, size: np.ndarray):
        """Index runs of sorted words for ``last_tokens``, of like length and at most CELLS symbols."""
        if not len(size):
            return
        kind = np.ceil(np.log2(np.maximum(size, 8))).astype(int)
        for k in np.unique(kind):
            at = np.flatnonzero(kind == k)
            step = max(1, CELLS >> int(k))
            for i in range(0, len(at), step):
                yield at[i:i + step]

    def spell(self, token: np.ndarray, count: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All tokens of each word, end to end, and each word's bounds, by walking back from the last one."""
        rows = np.arange(len(size))
        bounds = np.concatenate([[0], np.cumsum(count[rows, size - 1])])
        flat = np.empty(bounds[-1], dtype=np.int32)
        at, where = size - 1, bounds[1:] - 1
        while len(rows):
            t = token[rows, at]
            flat[where] = t
            at = at - self.length[t]
            on = at >= 0
            rows, at, where = rows[on], at[on], where[on] - 1
        return flat, bounds


def padded(symbols: np.ndarray, bounds: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """The picked words as rows of one array, 0 past each word's end."""
    size = (bounds[1:] - bounds[:-1])[pick]
    out = np.zeros((len(pick), int(size.max())), dtype=np.int64)
    inside = np.arange(out.shape[1]) < size[:, None]
    start = np.repeat(bounds[:-1][pick], size)
    out[inside] = symbols[start + ramp(size)]
    return out


