"""SentencePiece encoding and decoding by batched numpy Viterbi.

A model's pieces are kept as sorted 64-bit hashes. Words of equal length
advance together as one matrix of characters: the hash of every substring
that may be a piece comes from prefix hashes and is probed in the sorted
keys (behind a small filter), which gives a table of piece ids (word, start,
length). Position by position, vectorised maxima over the pieces that end
there store backpointers; walked back, they are the segmentation.

Unigram models take the path of the best sum of scores. In a BPE model (the
installed one) that path isn't the library's result, which is defined by
merges; but a segmentation is the result of the merges exactly if each of its
pieces is the result for its own text, and so is each pair of neighbours: the
first merge across a bound would also be made in the pair alone. The same
Viterbi therefore runs over the lattice of such neighbours only. Each prefix
of a word has one valid path, so its last piece is all the state there is, and
whether a pair is valid follows from the order in which both pieces are
merged, kept per piece. Characters that no piece covers fall back to byte
pieces, or to the unknown piece.

Words are found once per slice of a column, by hash; a worker keeps the ids of
at most ``WORDS_MOST`` words between slices.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import textkit as tk

SPACE = "▁"
#: Words whose ids a worker keeps, cells of a table that are made at a time, bytes of text in a slice, and words of a length from which they advance together.
WORDS_MOST, CELLS, SLICE, TOGETHER = 1 << 18, 1 << 20, 1 << 21, 48
#: Bits of the filter before the keys, and pairs of neighbours that a worker remembers for words on their own.
FILTER, PAIRS_MOST = 1 << 20, 1 << 17
_models: dict[str, "PieceModel"] = {}

def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a serialised message: integers, or bytes."""
    i = 0

    def varint():
        nonlocal i
        x = s = 0
        while True:
            b = data[i]
            i += 1
            x |= (b & 127) << s
            s += 7
            if b < 128:
                return x

    while i < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = varint() if key & 7 == 2 else 4 if key & 7 == 5 else 8
            yield key >> 3, data[i : i + n]
            i += n


class PieceModel:
    """One model file: its pieces, scores and kinds."""

    NORMAL, UNKNOWN, BYTE = 1, 2, 6  # kinds of the format

    def __init__(self, data: bytes):
        pieces, self.bpe, prefix, tidy, self.charsmap = [], False, True, True, b""
        for k, v in _fields(data):
            if k == 1:
                f = dict(_fields(v))
                pieces.append((f.get(1, b"").decode(), float(np.frombuffer(f.get(2, b"\0\0\0\0"), "<f4")[0]), f.get(3, 1)))
            elif k == 2:
                self.bpe = dict(_fields(v)).get(3, 1) == 2
            elif k == 3:
                f = dict(_fields(v))
                self.charsmap, prefix, tidy = f.get(2, b""), bool(f.get(3, 1)), bool(f.get(4, 1))
        if self.charsmap or tidy or not prefix or {k for _, _, k in pieces} - {1, 2, 3, 6}:
            raise ValueError("only models with a blank put before the text and no other normalising are read")
        self.kinds = [k for _, _, k in pieces]
        self.unknown = self.kinds.index(self.UNKNOWN)
        self.byte_ids = np.full(256, self.unknown, "<u4")
        for i, (p, _, k) in enumerate(pieces):
            if k == self.BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
        self.fallback = self.BYTE in self.kinds
        self.scores = np.array([s for _, s, _ in pieces])
        own = [(i, p) for i, (p, _, k) in enumerate(pieces) if k == self.NORMAL and p]
        self.ids = {p: i for i, p in own}
        self.longest = max(len(p) for _, p in own)
        if any(SPACE in p.lstrip(SPACE) for _, p in own):
            raise ValueError("pieces over word bounds")
        h = np.empty(len(own), np.uint64)
        for n, at in _by_length([p for _, p in own]).items():
            h[at] = self.substrings(_matrix([own[i][1] for i in at], n))[1][:, 0, n - 1]
        order = np.argsort(h)
        self.keys, self.key_ids = h[order], np.array([i for i, _ in own], np.int64)[order]
        if len(np.unique(self.keys)) < len(self.keys):
            raise ValueError("hashes of two pieces are equal")
        self.filter = np.zeros(FILTER, bool)
        self.filter[(self.keys & np.uint64(FILTER - 1)).astype(np.int64)] = True
        out = [b"" if k in (2, 3) else bytes([int(p[3:5], 16)]) if k == self.BYTE else p.replace(SPACE, " ").encode() for p, _, k in pieces]
        out[self.unknown] = " ⁇ ".encode()
        self.out = np.frombuffer(b"".join(out), np.uint8)
        self.out_off = np.concatenate([[0], np.cumsum([len(x) for x in out])])
        self.worst = min(self.scores[i] for i in self.key_ids) - 10
        self.pairs: dict[tuple[int, int], bool] = {}
        self.forget()
        if self.bpe:
            self._orders([p for p, _, _ in pieces])

    def forget(self) -> None:
        self.known, self.known_off, self.known_ids = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def substrings(self, chars: np.ndarray) -> tuple[int, np.ndarray]:
        """Hashes (word, start, length - 1) of substrings of up to the longest piece; 0 past the end."""
        n, size = chars.shape
        most = min(size, self.longest)
        out = np.zeros((n, size, most), np.uint64)
        acc = np.zeros((n, size), np.uint64)
        c = tk.mix(chars.astype(np.uint64) + np.uint64(77))
        for k in range(most):
            acc[:, : size - k] = acc[:, : size - k] * np.uint64(tk._BASE) + c[:, k:]
            out[:, : size - k, k] = tk.mix(acc[:, : size - k] + np.uint64(k + 1))
        return most, out

    def table(self, chars: np.ndarray) -> np.ndarray:
        """Piece ids (word, start, length - 1), -1 where no piece is."""
        _, h = self.substrings(chars)
        flat = h.ravel()
        maybe = np.flatnonzero(self.filter[(flat & np.uint64(FILTER - 1)).astype(np.int64)] & (flat != 0))
        probe = flat[maybe]
        at = np.searchsorted(self.keys, probe)
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == probe
        out = np.full(len(flat), -1, np.int32)
        out[maybe[hit]] = self.key_ids[at[hit]]
        return out.reshape(h.shape)

    def spell(self, char: str) -> np.ndarray:
        if not self.fallback:
            return np.array([self.unknown], "<u4")
        return self.byte_ids[list(char.encode("utf-8", "surrogatepass"))]

    def _orders(self, pieces: list[str]) -> None:
        """How the merges of each piece change its symbols at either end.

        ``right[i, k]`` is the length of the last symbol of piece i after k
        changes of it and ``right_next[i, k]`` the score of the merge that
        makes the next one; likewise ``left``. Where the scores of a piece's
        merges don't go down throughout, merges elsewhere in it count as
        changes too, as they may hold one at the end back. Row ``none`` stands
        for an uncovered character, row ``begin`` for the start of a word. A
        piece that its own merges don't give is not ``whole``.
        """
        count, most = len(pieces), self.longest + 1
        self.none, self.begin = count, count + 1
        self.whole = np.zeros(count + 2, bool)
        self.right, self.left = np.zeros((count + 2, most), np.int32), np.zeros((count + 2, most), np.int32)
        self.right_next, self.left_next = np.full((count + 2, most), -np.inf), np.full((count + 2, most), -np.inf)
        self.right[self.none, 0] = self.left[self.none, 0] = 1
        self.score = np.concatenate([self.scores, [self.worst, 0.0]])
        own = self.key_ids.tolist()
        for size, at in _by_length([pieces[i] for i in own]).items():
            ids = np.array([own[i] for i in at])
            table = self.table(_matrix([pieces[i] for i in ids.tolist()], size))
            nxt = np.tile(np.arange(1, size + 1), (len(ids), 1))  # end of the symbol that starts here; 0 where none starts
            live = np.arange(len(ids))
            merges: list[list[tuple[float, int, int]]] = [[] for _ in ids]  # score, lengths of the last and first symbol then
            self.right[ids, 0] = self.left[ids, 0] = 1
            while len(live):
                end = nxt[live]
                after = np.where((end > 0) & (end < size), np.take_along_axis(end, np.minimum(end, size - 1), 1), 0)
                cand = np.where(after > 0, np.take_along_axis(table[live], np.clip(after - np.arange(size) - 1, 0, None)[:, :, None], 2)[:, :, 0], -1)
                score = np.where(cand >= 0, self.scores[cand], -np.inf)
                pick = np.argmax(score, 1)
                top = score[np.arange(len(live)), pick]
                good = top > -np.inf
                live, pick, top, after = live[good], pick[good], top[good], after[good, pick[good]]
                middle = nxt[live, pick]
                nxt[live, pick] = after
                nxt[live, middle] = 0
                last = size - 1 - np.argmax(nxt[live, ::-1] > 0, axis=1)
                for k, *m in zip(live.tolist(), top.tolist(), (size - last).tolist(), nxt[live, 0].tolist(), strict=True):
                    merges[k].append(tuple(m))
            for i, found in zip(ids.tolist(), merges, strict=True):
                down = all(x[0] > y[0] for x, y in zip(found, found[1:], strict=False))
                for side, length, follow in ((1, self.right, self.right_next), (2, self.left, self.left_next)):
                    k = 0
                    for m in found:
                        if not down or m[side] != length[i, k]:
                            follow[i, k] = m[0]
                            k += 1
                            length[i, k] = m[side]
            self.whole[ids] = (nxt > 0).sum(1) == 1

    def _neighbours(self, table: np.ndarray, w: np.ndarray, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges keep the bound between piece ``a`` and piece ``b`` that starts at ``at``."""
        ok, live = np.ones(len(w), bool), np.flatnonzero(a != self.begin)
        i, j = np.zeros(len(w), np.int64), np.zeros(len(w), np.int64)
        most = table.shape[2]
        while len(live):
            x, y, p, q = a[live], b[live], i[live], j[live]
            r, n = self.right[x, p], self.left[y, q]
            next_a, next_b = self.right_next[x, p], self.left_next[y, q]
            fits = r + n <= most
            got = table[w[live], at[live] - r, np.where(fits, r + n - 1, 0)]
            cross = np.where(fits & (got >= 0), self.scores[got], -np.inf)
            # among equal scores the leftmost pair is merged first
            merged = (cross > next_a) & (cross >= next_b) & (cross > -np.inf)
            ok[live[merged]] = False
            left = next_a >= next_b
            i[live[left]] += 1
            j[live[~left]] += 1
            live = live[~merged & (np.maximum(next_a, next_b) > -np.inf)]
        return ok

    def viterbi(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word, start, end, id or -1) of the best paths of words of one length, in order."""
        table = self.table(chars)
        n, size = chars.shape
        most = table.shape[2]
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        back, last = np.zeros((n, size + 1), np.int64), np.zeros((n, size + 1), np.int32)
        if self.bpe:
            use = np.where((table >= 0) & self.whole[table], table, -1)
            use[:, :, 0] = np.where(table[:, :, 0] < 0, self.none, use[:, :, 0])
            last[:, 0] = self.begin
        else:
            score = np.where(table >= 0, self.scores[table], -np.inf)
            score[:, :, 0] = np.where(table[:, :, 0] >= 0, score[:, :, 0], self.worst)
        rows = np.arange(n)
        for e in range(1, size + 1):
            k = np.arange(min(most, e), 0, -1)
            if self.bpe:
                t = use[:, e - k, k - 1]
                w, c = np.nonzero(t >= 0)
                t, start = t[w, c], e - k[c]
                good = self._neighbours(table, w, start, last[w, start], t)
                w, c, t, start = w[good], c[good], t[good], start[good]
                total = np.full((n, len(k)), -np.inf)
                total[w, c] = best[w, start] + self.score[t]
            else:
                total = best[:, e - k] + score[:, e - k, k - 1]
            pick = np.argmax(total, 1)
            best[:, e], back[:, e] = total[rows, pick], e - k[pick]
            if self.bpe:
                last[:, e] = use[rows, e - k[pick], k[pick] - 1]
        cut = np.zeros((n, size + 1), bool)
        at = np.full(n, size)
        while (at > 0).any():
            cut[rows, at] = True
            at = np.where(at > 0, back[rows, at], 0)
        w, b = np.nonzero(cut[:, 1:])
        b = b + 1
        a = back[w, b]
        return w, a, b, table[w, a, b - a - 1]

    def _pair(self, a: int, b: int, x: str, y: str) -> bool:
        """The same as ``_neighbours`` for one pair of pieces with texts x and y."""
        if a == self.begin:
            return True
        key = (a, b)
        if a != self.none and b != self.none and (have := self.pairs.get(key)) is not None:
            return have
        i = j = 0
        while True:
            next_a, next_b = self.right_next[a, i], self.left_next[b, j]
            got = self.ids.get(x[len(x) - self.right[a, i] :] + y[: self.left[b, j]])
            if got is not None and self.scores[got] > next_a and self.scores[got] >= next_b:
                ok = False
                break
            if max(next_a, next_b) == -np.inf:
                ok = True
                break
            if next_a >= next_b:
                i += 1
            else:
                j += 1
        if a != self.none and b != self.none:
            if len(self.pairs) >= PAIRS_MOST:
                self.pairs.clear()
            self.pairs[key] = ok
        return ok

    def viterbi_one(self, word: str) -> list[tuple[int, int, int]]:
        """(start, end, id or -1) of the best path of one word, for lengths that few words have."""
        n = len(word)
        best, back, last = [0.0] + [-np.inf] * n, [0] * (n + 1), [self.begin if self.bpe else -1] + [-1] * n
        get, scores = self.ids.get, self.scores
        for e in range(1, n + 1):
            for s in range(max(0, e - self.longest), e):
                t = get(word[s:e], -1)
                if t < 0 and s < e - 1:
                    continue
                if self.bpe:
                    if t < 0:
                        t = self.none
                    elif not self.whole[t]:
                        continue
                    if not self._pair(last[s], t, word[back[s] : s], word[s:e]):
                        continue
                total = best[s] + (scores[t] if 0 <= t < len(scores) else self.worst)
                if total > best[e]:
                    best[e], back[e], last[e] = total, s, t
        cuts, e = [], n
        while e:
            cuts.append((back[e], e, last[e] if 0 <= last[e] < len(scores) else -1))
            e = back[e]
        return cuts[::-1]

    def _spelled(self, word: str, cuts: list[tuple[int, int, int]]) -> np.ndarray:
        """Ids from (start, end, id); neighbouring unknown characters are one piece unless bytes spell them."""
        out, before = [], False
        for a, b, i in cuts:
            if i >= 0:
                out.append(np.array([i], "<u4"))
            elif self.fallback or not before:
                out += [self.spell(c) for c in word[a:b]] if self.fallback else [self.spell(word[a])]
            before = i < 0
        return np.concatenate(out) if out else np.zeros(0, "<u4")

    def learn(self, codes: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of distinct words given as code points."""
        size, count = np.diff(off), len(off) - 1
        word = lambda i: codes[off[i] : off[i + 1]].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * count
        owner, place, found = [], [], []
        for n in np.unique(size).tolist():
            at = np.flatnonzero(size == n)
            if len(at) < TOGETHER or n * min(n, self.longest) > CELLS:
                for i in at.tolist():
                    out[i] = self._spelled(w := word(i), self.viterbi_one(w))
                continue
            step = max(1, CELLS // (n * min(n, self.longest)))
            for lo in range(0, len(at), step):
                part = at[lo : lo + step]
                w, a, b, got = self.viterbi(codes[off[part][:, None] + np.arange(n)])
                odd = np.unique(w[got < 0])  # with characters that bytes spell
                plain = np.ones(len(w), bool)
                for k, lo_, hi in zip(odd.tolist(), np.searchsorted(w, odd).tolist(), np.searchsorted(w, odd, side="right").tolist(), strict=True):
                    plain[lo_:hi] = False
                    out[part[k]] = self._spelled(word(part[k]), list(zip(a[lo_:hi].tolist(), b[lo_:hi].tolist(), got[lo_:hi].tolist(), strict=True)))
                owner.append(part[w[plain]])
                place.append(a[plain])
                found.append(got[plain])
        single = np.flatnonzero([len(x) > 0 for x in out])
        owner += [np.repeat(single, [len(out[i]) for i in single.tolist()])]
        place += [np.concatenate([np.arange(len(out[i])) for i in single.tolist()] or [np.zeros(0, np.int64)])]
        found += [np.concatenate([out[i] for i in single.tolist()] or [np.zeros(0, np.uint32)])]
        owner, place, found = np.concatenate(owner), np.concatenate(place), np.concatenate(found)
        order = np.lexsort((place, owner))
        return np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=count))]), found[order].astype(np.uint32)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of all texts of a column; null and empty texts have none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring(texts, SPACE)
        if pc.any(odd).as_py():
            texts = pc.replace_substring(texts, SPACE, " ")
        blank = pa.scalar(" ", pa.large_string())
        texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), pa.scalar("", pa.large_string()), pc.binary_join_element_wise(blank, texts, pa.scalar("", pa.large_string())))
        ids, many = [], []
        for _, data, off in tk.slices(texts, SLICE):
            got, per = self._encode_slice(data, off)
            ids.append(got)
            many.append(per)
        many = np.concatenate(many) if many else np.zeros(0, np.int64)
        return np.concatenate([[0], np.cumsum(many)]), np.concatenate(ids) if ids else np.zeros(0, np.uint32)

    def _encode_slice(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(off) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(rows, np.int64)
        space = data == 32
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[off[:-1][off[:-1] < len(data)]] = True
        start = np.flatnonzero(first)
        end = np.append(start[1:], len(data))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * tk._power(tk._BASE, len(data)), out=total[1:])
        h = tk.mix((total[end] - total[start]) * tk._power(tk._BASE_INV, len(data))[start] + (end - start).astype(np.uint64))
        key, lead, own = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, key)
        at[at == len(self.known)] = 0
        have = self.known[at] == key if len(self.known) else np.zeros(len(key), bool)
        new = lead[~have]
        if len(new):
            size = end[new] - start[new]
            begin = np.concatenate([[0], np.cumsum(size)])
            raw = data[np.repeat(start[new] - begin[:-1], size) + np.arange(begin[-1])]
            heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            codes = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4").copy()
            codes[codes == 32] = ord(SPACE)
            new_off, new_ids = self.learn(codes, heads[begin])
            if len(self.known) + len(new) > WORDS_MOST:  # what this slice has is all that is kept
                keep = at[have]
                self._keep(self.known[keep], *_taken(self.known_off, self.known_ids, keep))
            both = np.concatenate([self.known, key[~have]])
            order = np.argsort(both)
            self._keep(both[order], *_taken(np.concatenate([self.known_off, self.known_off[-1] + new_off[1:]]), np.concatenate([self.known_ids, new_ids]), order))
        at = np.searchsorted(self.known, key)[own.ravel()]
        many = np.diff(self.known_off)[at]
        begin = np.concatenate([[0], np.cumsum(many)])
        ids = self.known_ids[np.repeat(self.known_off[at] - begin[:-1], many) + np.arange(begin[-1])]
        return ids, np.diff(begin[np.searchsorted(start, off)])

    def _keep(self, key: np.ndarray, off: np.ndarray, ids: np.ndarray) -> None:
        self.known, self.known_off, self.known_ids = key, off, ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        off, ids = self.encode_column(pa.array(texts, pa.large_string()))
        return [ids[a:b].astype("<u4").tobytes() for a, b in zip(off[:-1], off[1:], strict=True)]

    def decode_column(self, off: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The texts of rows of ids; bytes that are no character become U+FFFD, and the blank put before goes."""
        size = self.out_off[ids + 1] - self.out_off[ids]
        begin = np.concatenate([[0], np.cumsum(size)])
        data = self.out[np.repeat(self.out_off[ids] - begin[:-1], size) + np.arange(begin[-1])]
        off = begin[off]
        lead = off[:-1][(off[1:] > off[:-1])]
        lead = lead[data[lead] == 32]
        data = np.delete(data, lead)
        off = off - np.searchsorted(lead, off)
        made = pa.Array.from_buffers(pa.large_string(), len(off) - 1, [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data)])
        try:
            made.validate(full=True)
        except pa.ArrowInvalid:
            made = pa.array([data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:], strict=True)], pa.large_string())
        return made

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_column(np.array([0, len(ids)]), np.asarray(ids, np.int64))[0].as_py()


def _taken(off: np.ndarray, values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``rows`` of values, as offsets and values."""
    many = np.diff(off)[rows]
    out = np.concatenate([[0], np.cumsum(many)])
    return out, values[np.repeat(off[rows] - out[:-1], many) + np.arange(out[-1])]


def _by_length(words: list[str]) -> dict[int, list[int]]:
    out = defaultdict(list)
    for i, w in enumerate(words):
        out[len(w)].append(i)
    return out


def _matrix(words: list[str], size: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), size)


def model(path: str) -> PieceModel:
    if path not in _models:
        with open(path, "rb") as f:
            _models[path] = PieceModel(f.read())
    return _models[path]


def encode(docs: DataFrame, model_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), out: str = "ids", decoded: str | None = None) -> DataFrame:
    """``keep`` columns and the ids of every whole text; ``decoded`` names a column of the texts that the ids decode to, made in the same worker.

    Null and empty texts have no ids. Repeated rows are encoded each, equal
    texts alike; an empty table gives no rows. ``keep`` columns are passed on
    whatever their names; one named as ``out`` is an error of Spark's.
    """
    return _apply(docs, text, keep, "string", [(out, "array<int>")] + ([(decoded, "string")] if decoded else []), model_path)


def decode(docs: DataFrame, model_path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",), out: str = "decoded") -> DataFrame:
    """``keep`` columns and the text of every list of ids; a null or empty list gives an empty text. Other rows as in ``encode``."""
    return _apply(docs, ids, keep, "array<int>", [(out, "string")], model_path)


def _apply(docs: DataFrame, source: str, keep: tuple[str, ...], taken: str, made: list[tuple[str, str]], path: str) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    inner = docs.select(quoted(source).cast(taken).alias("_x"), *(quoted(c).alias(f"_{i}") for i, c in enumerate(keep)))
    names = [*(f"_o{i}" for i in range(len(made))), *(f"_{i}" for i in range(len(keep)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            x, out = b.column(0), []
            if taken == "string":
                off, ids = m.encode_column(x)
                out.append(pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids.astype(np.int32))))
            else:
                many = pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False)
                off, ids = np.concatenate([[0], np.cumsum(many)]), x.flatten().to_numpy(zero_copy_only=False)
            if made[-1][1] == "string":
                out.append(m.decode_column(off, ids.astype(np.int64)).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*out, *(b.column(i) for i in range(1, b.num_columns))], names)
        m.forget()

    schema = ", ".join([*(f"_o{i} {kind}" for i, (_, kind) in enumerate(made)), *(f"_{i} {kinds[c]}" for i, c in enumerate(keep))])
    return inner.mapInArrow(run, schema).select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), *(F.col(f"_o{i}").alias(c) for i, (c, _) in enumerate(made)))
