"""Benchmark decontamination by CGK embeddings, bit sampling and edit distance.

A CGK random walk reads a window word by word and repeats or advances by a
random bit of the word and the step, so that windows at a small edit distance
become sequences at a small Hamming distance.  Tables sample a few steps of a
walk as keys (bit-sampling LSH).  Windows of benchmark items (sized 4 to 32 words
by the item's length, at each word from which one fits) are the keys that are
looked up; documents give one window for each stride of words.

Words carry no key where many of them are mistyped, or where spaces are lost or
added.  Items are therefore sought by their characters as well, white space
left out: grams of 8, 6 or 5 bytes at each place of an item are looked up at each
place of a document, and an item is a candidate where enough of its grams stand
within the shift that ``max_edit`` allows.  How many, and how long the grams, is
chosen for items of about one length from simulated edits.

Both are tuned together: for each size, edited items are drawn (mistyped words, lost
and added spaces, scattered characters, changed words, one changed run, up to
``max_edit`` of the item's characters), and walks with new random bits are added until
each kind is found with the target recall; the reached recall is kept by size.  A hit is
then verified: the edit distance (characters, case and white space aside) of the
whole item to the best fitting part of the document around it must be at most
``max_edit`` of the item's length.

Items of few different words (``poor``) have no keys that tell much.  They are
sought without keys: by the lemma of q-grams, a part within ``max_edit`` holds so many
of the item's 3-grams, and all places that do are verified.

The benchmark is worked through in blocks of a bounded number of words, which with
``MOST_WALKS`` bounds what is broadcast (80 MB or so), each block held against all
documents in one map-only pass.

Defined cases: null and empty texts hit nothing; items of fewer than 4 words
are no evidence and are ignored; items of few or one word again and again are
found by their own path; repeated documents and items give their rows
each; of several places of one item in a document the best and then first is
reported; an empty benchmark or document table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.llm.common import LOWER, SPACE, byte_slices, find_words, mix64, table, text_buffers

#: Words of a window and the stride of windows in documents; steps sampled by a
#: table, and tables of a walk.
SIZES, SAMPLES, TABLES = {32: 16, 16: 8, 8: 2, 4: 1}, 4, 5
LONGEST, MOST_WALKS = max(SIZES), 6
#: Lengths of character grams, the longest first, with the fewest of them that may count.
GRAMS, TRIALS = {8: 3, 6: 2, 5: 2}, 40
HITS = "doc_id long, item_id long, edit_distance int, item_chars int, similarity double, word_start int"


def window_size(n_words: int) -> int:
    """Words of the window by which an item is sought; 0: too short."""
    long = next((w for w, stride in SIZES.items() if 2 * n_words >= 5 * (w + stride - 1)), 0)
    return long or (min(SIZES) if n_words >= min(SIZES) else 0)


def window_starts(n_words: int) -> np.ndarray:
    """Words of an item at which its windows start."""
    return np.arange(n_words - window_size(n_words) + 1)


def _steps(size: int) -> int:
    return 7 * size // 4


@dataclass
class Walks:
    """Random bits of the walks and sampled steps of the tables, from a seed."""

    repeats: int
    seed: int = 7
    turn: np.ndarray = field(init=False)
    picks: dict = field(init=False)
    blend: np.ndarray = field(init=False)

    def __post_init__(self):
        rng = np.random.default_rng(self.seed)
        shape = (16, _steps(LONGEST))  # the same for each number of repeats
        self.turn = rng.integers(0, 1 << 63, shape, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.blend = rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.picks = {(r, w): [np.sort(rng.choice(_steps(w), SAMPLES, replace=False)) for _ in range(TABLES)] for r in range(16) for w in SIZES}

    def keys(self, words: np.ndarray, starts: np.ndarray, sizes: list[int]) -> Iterator[tuple[tuple[int, int, int], np.ndarray, list[np.ndarray]]]:
        """((repeat, size, table), keys, sampled words) of the windows at ``starts``."""
        for r in range(self.repeats):
            wanted = {int(s) for w in sizes for p in self.picks[r, w] for s in p}
            at, seen = starts.copy(), {}
            for step in range(max(wanted, default=-1) + 1):
                symbol = words[at]
                if step in wanted:
                    seen[step] = symbol
                at += ((symbol * self.turn[r, step]) >> np.uint64(63)).astype(np.int64)
            for w in sizes:
                for t, pick in enumerate(self.picks[r, w]):
                    key = seen[int(pick[0])] * self.blend[0]
                    for s, b in zip(pick[1:], self.blend[1:], strict=True):
                        key = (key ^ (key >> np.uint64(29))) * b + seen[int(s)]
                    yield (r, w, t), mix64(key), [seen[int(x)] for x in pick]


def telling(samples: list[np.ndarray], least: int = 3) -> np.ndarray:
    """Keys that hold at least so many different words; a walk that stands still
    samples one word again and again, which says little."""
    s = np.sort(np.stack(samples), axis=0)
    return 1 + (s[1:] != s[:-1]).sum(axis=0) >= least


def poor(words: np.ndarray) -> bool:
    """Whether fewer than half of an item's windows hold words enough for telling
    keys: a third of their size and three at least."""
    size = window_size(len(words))
    least = max(3, size // 3)
    windows = np.sort(np.lib.stride_tricks.sliding_window_view(words, size), axis=1)
    distinct = 1 + (windows[:, 1:] != windows[:, :-1]).sum(axis=1)
    return bool((distinct >= least).mean() < 0.5)


def _padded(words: np.ndarray) -> np.ndarray:
    return np.concatenate((words, np.zeros(_steps(LONGEST) + 1, np.uint64)))


def compact(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, places): lower-cased bytes that aren't white space, and where they stood."""
    at = np.flatnonzero(~SPACE[data])
    return LOWER[data[at]], at


def gram_keys(c: np.ndarray, q: int) -> np.ndarray:
    """The q bytes from each place as one number, q at most 8."""
    n = max(0, len(c) - q + 1)
    out = np.zeros(n, np.uint64)
    for j in range(q):
        out |= c[j : j + n].astype(np.uint64) << np.uint64(8 * j)
    return out


class Grams:
    """Places of all grams of some items: ``need[i]`` of item i's grams within a shift of
    ``slack[i]`` make a candidate."""

    def __init__(self, q: int, items: list[int], texts: list[np.ndarray], need: list[int], slack: list[int]):
        self.q, self.need, self.slack = q, np.array(need, np.int64), np.array(slack, np.int64)
        self.items, self.size = np.array(items, np.int64), np.array([len(t) for t in texts], np.int64)
        keys = [gram_keys(t, q) for t in texts]
        key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        own = np.repeat(np.arange(len(texts), dtype=np.int32), [len(k) for k in keys])
        place = np.concatenate([np.arange(len(k), dtype=np.int32) for k in keys]) if keys else np.zeros(0, np.int32)
        order = np.argsort(key, kind="stable")
        self.key, first = np.unique(key[order], return_index=True)
        self.first = np.append(first, len(order))
        self.own, self.place = own[order], place[order]
        self.some = np.zeros(1 << 20, bool)
        self.some[mix64(self.key) >> np.uint64(44)] = True

    def pairs(self, c: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, shift) of all grams that a text and an item share."""
        keys = gram_keys(c, self.q)
        near = np.flatnonzero(self.some[mix64(keys) >> np.uint64(44)]) if len(self.key) else np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.key, keys[near]), max(len(self.key) - 1, 0))
        hit = (self.key[at] == keys[near]) & (row[near] == row[near + self.q - 1]) if len(near) else np.zeros(0, bool)
        near, at = near[hit], at[hit]
        n = self.first[at + 1] - self.first[at]
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[at], n)
        where = np.repeat(near, n)
        return row[where], self.own[inner].astype(np.int64), where - self.place[inner]

    def counts(self, c: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, shift, grams from this shift up to the slack), in order."""
        row, own, shift = self.pairs(c, row)
        low = int(shift.min(initial=0))
        key = (row * len(self.items) + own) << np.int64(32) | (shift - low)
        order = np.argsort(key, kind="stable")
        key, row, own, shift = key[order], row[order], own[order], shift[order]
        return row, own, shift, np.searchsorted(key, key + self.slack[own], side="right") - np.arange(len(key))

    def candidates(self, c: np.ndarray, row: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, item, first and last shift) where enough grams stand together."""
        row, own, shift, n = self.counts(c, row)
        good = np.flatnonzero(n >= self.need[own])
        if not len(good):
            return []
        row, own, shift = row[good], own[good], shift[good]
        new = np.ones(len(good), bool)
        new[1:] = (row[1:] != row[:-1]) | (own[1:] != own[:-1]) | (np.diff(shift) > self.slack[own[1:]])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(good)) - 1
        return [(int(row[a]), int(self.items[own[a]]), int(shift[a]), int(shift[b] + self.slack[own[b]])) for a, b in zip(first, last, strict=True)]


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def edited(text: str, most: int, kind: str, rng: np.random.Generator) -> str:
    """``text`` after edits of one kind, at most ``most`` characters' worth."""
    letter = lambda: LETTERS[int(rng.integers(26))]
    words, left = text.split(), int(rng.integers(1, most + 1)) if most else 0

    def typo(w: str) -> str:
        at, how = int(rng.integers(len(w))), int(rng.integers(3))
        return w[:at] + ("" if how == 0 and len(w) > 1 else letter() + (w[at:] if how == 1 else w[at + 1 :])) if how else w[:at] + w[at + 1 :] or letter()

    if kind == "typos":  # one in each second or third word
        step = int(rng.integers(2, 4))
        for i in range(int(rng.integers(step)), len(words), step)[:most]:
            words[i] = typo(words[i])
        return " ".join(words)
    if kind == "spaces":
        lost = rng.random(len(words)) < rng.random()
        out, left = words[0], most
        for w, gone in zip(words[1:], lost[1:], strict=True):
            if left and gone:
                left -= 1
                out += w
            elif left and rng.random() < 0.2 and len(w) > 1:
                left -= 1
                cut = int(rng.integers(1, len(w)))
                out += f" {w[:cut]} {w[cut:]}"
            else:
                out += " " + w
        return out
    if kind == "scattered":
        c = list(text)
        for at in rng.integers(len(c), size=left):
            how = int(rng.integers(3))
            c[at] = "" if how == 0 else letter() if how == 1 else c[at] + letter()
        return "".join(c)
    if kind == "run":
        size = 0
        i = j = int(rng.integers(len(words)))
        while j < len(words) and size + len(words[j]) <= most:
            size += len(words[j])
            words[j] = "".join(letter() for _ in words[j])
            j += 1
        return " ".join(words)
    for i in rng.permutation(len(words)):  # changed words
        if len(words[i]) + 1 <= left:
            left -= len(words[i]) + 1
            words[i] = "" if rng.random() < 0.5 else "".join(letter() for _ in words[i])
    return " ".join(w for w in words if w)


KINDS = ("typos", "spaces", "scattered", "words", "run")


def _hashes(text: str) -> np.ndarray:
    raw = text.encode()
    return find_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])).hash


def _bytes(text: str) -> np.ndarray:
    return compact(np.frombuffer(text.encode(), np.uint8))[0]


def walks_to_find(item: np.ndarray, text: str, walks: Walks, lead: int) -> int:
    """How many walks find an item in its edited text behind ``lead`` other words;
    MOST_WALKS + 1: none does."""
    w = window_size(len(item))
    words = np.concatenate((np.zeros(lead, np.uint64), _hashes(text)))
    theirs = walks.keys(_padded(words), np.arange(0, max(1, len(words)), SIZES[w]), [w])
    for (k, keys, samples), (_, there, _) in zip(walks.keys(_padded(item), window_starts(len(item)), [w]), theirs, strict=True):
        if np.isin(there, keys[telling(samples)]).any():
            return k[0] + 1
    return MOST_WALKS + 1


class Index:
    """Keys of a block of benchmark items, and the items for verification."""

    def __init__(self, ids: list[int], texts: list[str], target_recall: float = 0.99, max_edit: float = 0.2):
        self.max_edit = max_edit
        hashes = [_hashes(t) for t in texts]
        keep = [i for i, w in enumerate(hashes) if window_size(len(w))]
        self.ids, self.words = [ids[i] for i in keep], [hashes[i] for i in keep]
        self.plain = [plain(texts[i]) for i in keep]
        self.raw = [_bytes(texts[i]) for i in keep]
        self.most = [int(max_edit * len(p)) for p in self.plain]
        self.bags: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.poor = [i for i, w in enumerate(self.words) if poor(w)]
        keyed = sorted(set(range(len(self.words))) - set(self.poor))
        self.sizes = sorted({window_size(len(self.words[i])) for i in keyed}, reverse=True)
        self.walks: dict[int, Walks] = {}
        self.recall: dict[int, float] = {}  # as simulated, of the worst kind of edits
        self.need: dict[int, tuple[int, int]] = {}  # length and least number of grams, by class of length
        self._tune(keyed, target_recall)
        by_gram: dict[int, list[int]] = {}
        for i in keyed:
            by_gram.setdefault(self.need[self._length_class(i)][0], []).append(i)
        self.grams = [Grams(q, own, [self.raw[i] for i in own], [self.need[self._length_class(i)][1] for i in own], [self.most[i] for i in own]) for q, own in sorted(by_gram.items())]
        self.tables: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        if not self.words:
            return
        lengths = [len(w) + _steps(LONGEST) + 1 for w in self.words]
        joined = np.concatenate([_padded(w) for w in self.words])
        begins = np.cumsum([0, *lengths[:-1]])
        for w in self.sizes:
            own = [i for i in keyed if window_size(len(self.words[i])) == w]
            starts = [window_starts(len(self.words[i])) for i in own]
            entry = np.stack((np.repeat(own, [len(x) for x in starts]), np.concatenate(starts)), axis=1).astype(np.int32)
            for k, keys, samples in self.walks[w].keys(joined, begins[entry[:, 0]] + entry[:, 1], [w]):
                good = np.flatnonzero(telling(samples))
                good = good[np.argsort(keys[good], kind="stable")]
                some = np.zeros(1 << 18, bool)
                some[keys[good] >> np.uint64(46)] = True
                self.tables[k] = (keys[good], entry[good], some)

    def _length_class(self, i: int) -> int:
        """Items whose lengths differ by a quarter or so."""
        return int(3 * np.log2(max(len(self.raw[i]), 1)))

    def _tune(self, keyed: list[int], target: float) -> None:
        """Grams of each class of length, then walks of each size, by simulated edits."""
        rng, every = np.random.default_rng(3), Walks(MOST_WALKS)
        classes: dict[int, list[int]] = {}
        for i in keyed:
            classes.setdefault(self._length_class(i), []).append(i)
        trials: dict[int, list[tuple[str, int, str, bool]]] = {w: [] for w in self.sizes}  # kind, item, edited text, found by grams
        for name, own in classes.items():
            drawn = [(kind, i, edited(self.plain[i], self.most[i], kind, rng)) for kind in KINDS for i in rng.choice(own, TRIALS)]
            for q, least in GRAMS.items():
                counts = []
                for _, i, text in drawn:
                    c = _bytes(text)
                    n = Grams(q, [i], [self.raw[i]], [1], [self.most[i]]).counts(c, np.zeros(len(c), np.int64))[3] if len(c) >= q else np.zeros(0)
                    counts.append(int(n.max(initial=0)))
                by_kind = np.array(counts).reshape(len(KINDS), TRIALS)
                # The count that all but a hundredth of the worst kind's edits leave.
                need = int(np.quantile(by_kind, 1 - target, axis=1, method="lower").min())
                self.need[name] = (q, max(need, least))
                if need >= least:
                    break
            for (kind, i, text), n in zip(drawn, counts, strict=True):
                trials[window_size(len(self.words[i]))].append((kind, i, text, n >= self.need[name][1]))
        for w, drawn in trials.items():
            needed = {kind: [] for kind in KINDS}
            for kind, i, text, found in drawn:
                needed[kind].append(0 if found else walks_to_find(self.words[i], text, every, int(rng.integers(SIZES[w]))))
            shares = [min(float((np.array(v) <= r).mean()) for v in needed.values()) for r in range(1, MOST_WALKS + 1)]
            repeats = next((r for r, x in enumerate(shares, 1) if x >= target), MOST_WALKS)
            self.walks[w], self.recall[w] = Walks(repeats), shares[repeats - 1]

    def hits(self, data: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, item, edit distance, word) for rows of UTF-8 texts."""
        words = find_words(data, bounds)
        if not len(words.hash):
            return []
        of_row = np.repeat(words.first[:-1], np.diff(words.first))
        index = np.arange(len(words.hash))
        padded = _padded(words.hash)
        firsts = words.first.tolist()
        found: set[tuple[int, int, int]] = set()
        for size in self.sizes:
            starts = index[(index - of_row) % SIZES[size] == 0]
            for k, keys, _ in self.walks[size].keys(padded, starts, [size]):
                sorted_keys, entry, some = self.tables[k]
                near = np.flatnonzero(some[keys >> np.uint64(46)])
                mine = keys[near]
                first = np.searchsorted(sorted_keys, mine, side="left")
                last = np.searchsorted(sorted_keys, mine, side="right")
                for at in np.flatnonzero(last > first):
                    for item, offset in entry[first[at] : last[at]]:
                        window = int(starts[near[at]])
                        found.add((bisect_right(firsts, window) - 1, window - int(offset), int(item)))
        lo = int(bounds[0])
        best: dict[tuple[int, int], tuple[int, int]] = {}

        def note(row: int, item: int, distance: int, word: int) -> None:
            if distance <= self.max_edit * len(self.plain[item]):
                value = (distance, word)
                best[row, item] = min(best.get((row, item), value), value)

        for row, start, item in sorted(found):
            a0, b0 = int(words.first[row]), int(words.first[row + 1])
            n = len(self.words[item])
            if start >= a0 and start + n <= b0 and np.array_equal(words.hash[start : start + n], self.words[item]):
                distance = 0
            else:
                slack = int(self.max_edit * max(n, len(self.plain[item]) / 2)) + 2  # a word more or less is two edits at least
                a, b = max(a0, start - slack), min(b0, start + n + slack)
                if a >= b:
                    continue
                part = data[lo + int(words.start[a]) : lo + int(words.end[b - 1])].tobytes()
                distance = self._distance(item, plain(part.decode()))
            note(row, item, distance, max(start, a0) - a0)
        c, at = compact(data[lo : int(bounds[-1])])
        rel = bounds - lo
        row_of = np.searchsorted(rel, at, side="right") - 1
        begins = np.searchsorted(at, rel)
        places = [x for grams in self.grams for x in grams.candidates(c, row_of)] + self._dense(c, row_of, begins)
        for row, item, first, last in places:
            if best.get((row, item), (1,))[0] == 0:
                continue
            slack = self.most[item] + 1
            a = max(int(begins[row]), first - slack)
            b = min(int(begins[row + 1]), last + len(self.raw[item]) + slack)
            if a >= b:
                continue
            part = data[lo + int(at[a]) : lo + int(at[b - 1]) + 1].tobytes()
            distance = self._distance(item, plain(part.decode(errors="ignore")))
            word = int(np.searchsorted(words.start, at[max(first, int(begins[row]))], side="right")) - 1
            note(row, item, distance, max(word - int(words.first[row]), 0))
        return [(row, item, d, w) for (row, item), (d, w) in sorted(best.items())]

    def _dense(self, c: np.ndarray, row_of: np.ndarray, begins: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Candidates of poor items: (row, item, first and last place) where ``n + most``
        bytes hold the 3-grams that a part within ``most`` edits must share."""
        out, q = [], 3
        keys = gram_keys(c, q) if self.poor else np.zeros(0, np.uint64)
        for item in self.poor:
            own, n, most = np.unique(gram_keys(self.raw[item], q)), len(self.raw[item]), self.most[item]
            there = np.isin(keys, own) & (row_of[: len(keys)] == row_of[q - 1 :][: len(keys)])
            total = np.concatenate(([0], np.cumsum(there)))
            for row in np.unique(row_of[np.flatnonzero(there)]):
                a0, b0 = int(begins[row]), min(int(begins[row + 1]), len(keys))
                starts = np.arange(a0, max(a0, b0 - n) + 1)
                dense = starts[total[np.minimum(starts + n + most, b0)] - total[starts] >= max(1, n - q + 1 - q * most)]
                for run in np.split(dense, np.flatnonzero(np.diff(dense) > n + 2 * most) + 1) if len(dense) else ():
                    out.append((int(row), item, int(run[0]), int(run[-1])))
        return out

    def _distance(self, item: int, text: str) -> int:
        """Edit distance, or the pattern's length if too few 3-grams or 2-grams are
        shared: an edit destroys at most q of them, so this loses nothing."""
        m = len(self.plain[item])
        there = _codes(text)
        for q in (3, 2):
            if (item, q) not in self.bags:
                self.bags[item, q] = np.unique(_bag(_codes(self.plain[item]), q), return_counts=True)
            own, n = self.bags[item, q]
            keys = _bag(there, q)
            at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
            seen = np.bincount(at[own[at] == keys], minlength=len(own))
            if int(np.minimum(seen, n).sum()) < m - q + 1 - q * self.most[item]:
                return m
        return fit_distance(self.plain[item], text)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)


def _bag(codes: np.ndarray, q: int) -> np.ndarray:
    """The q characters from each place as one number, q at most 3."""
    n = max(0, len(codes) - q + 1)
    return sum((codes[j : j + n] << np.uint64(21 * j) for j in range(1, q)), codes[:n])


def plain(text: str) -> str:
    """Lower case, each run of white space one space."""
    return " ".join(text.lower().split())


def fit_distance(pattern: str, text: str) -> int:
    """Least edit distance of ``pattern`` to any part of ``text`` (bit-parallel)."""
    m = len(pattern)
    if not m:
        return 0
    has: dict[str, int] = {}
    for i, c in enumerate(pattern):
        has[c] = has.get(c, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, least = full, 0, m, m
    for c in text:
        eq = has.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        horizontal_up = down | ~(diagonal | up) & full
        horizontal_down = up & diagonal
        if horizontal_up & top:
            score += 1
        elif horizontal_down & top:
            score -= 1
        horizontal_up = (horizontal_up << 1) & full  # a free start: no carry-in
        horizontal_down = (horizontal_down << 1) & full
        up = horizontal_down | ~(diagonal | horizontal_up) & full
        down = horizontal_up & diagonal
        least = min(least, score)
    return least


def index_blocks(benchmark: DataFrame, block: int = 150_000, **params) -> Iterator[Index]:
    """Indexes of blocks of items with at most about ``block`` words, each of which
    can start a window."""
    items = benchmark.where("text IS NOT NULL").select("item_id", "text")
    total = items.agg(F.sum(F.size(F.split("text", "\\s+")))).first()[0] or 0
    blocks = max(1, -(-total // block))
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        rows = sorted(part.collect(), key=lambda r: (r["item_id"] or 0, r["text"]))
        yield Index([r["item_id"] for r in rows], [r["text"] for r in rows], **params)


def search(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """A row for each document and benchmark item that it contains."""
    out = None
    for index in index_blocks(benchmark, **params):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ix = shared.value
            for batch in batches:
                data, bounds = text_buffers(batch.column(1))
                ids = batch.column(0)
                rows = []
                for i, j in byte_slices(bounds):
                    for row, item, d, w in ix.hits(data, bounds[i : j + 1]):
                        n = len(ix.plain[item])
                        rows.append((ids[i + row].as_py(), ix.ids[item], d, n, 1 - d / n, w))
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32()]
                cols = list(zip(*rows, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[x.split()[0] for x in HITS.split(", ")])

        part = docs.select("doc_id", "text").mapInArrow(run, HITS)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """Rows that contain no benchmark item; their own columns."""
    at = docs.columns.index("text")
    for index in index_blocks(benchmark, **params):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, bounds = text_buffers(batch.column(at))
                keep = np.ones(batch.num_rows, bool)
                for i, j in byte_slices(bounds):
                    for row, *_ in shared.value.hits(data, bounds[i : j + 1]):
                        keep[i + row] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op1_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
