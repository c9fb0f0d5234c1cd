"""External suffix sorting by induction, for integer texts far larger than memory.

A suffix is of type S if it is smaller than the one after it, else of type L; S suffixes right of an L suffix are the
star suffixes. The order of the stars induces that of all others: scanning upwards, each suffix passes the one before it
to the bucket of its first character if that one is of type L; scanning downwards, if it is of type S. The buckets are
one priority queue of (character, arrival, position, common prefix) tuples whose runs lie on disk beyond a fixed number
of tuples. The stars themselves are put in order by inducing once from their first characters, naming the substrings
between stars, and sorting the text of names in the same way, recursively; texts of names below ``IN_MEMORY`` are sorted
by doubling.

A common prefix of two neighbours is one more than the least common prefix between the suffixes that induced
them. The values are cut at ``cap``, so that the last place of each value answers every such minimum.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

IN_MEMORY = 1 << 22
HELD = 1 << 20
SLICE = 1 << 18
FEW = 1 << 9

Batch = tuple[np.ndarray, np.ndarray]


class DiskList:
    """Numbers appended to a file and read back as a memory-mapped array."""

    def __init__(self, folder: str, dtype: type = np.int64):
        self.file = tempfile.NamedTemporaryFile(dir=folder, delete=False)
        self.dtype, self.size = np.dtype(dtype), 0

    def append(self, values: np.ndarray) -> None:
        np.asarray(values, self.dtype).tofile(self.file)
        self.size += len(values)

    def array(self) -> np.ndarray:
        self.file.flush()
        return np.asarray(np.memmap(self.file.name, self.dtype, "r", shape=(self.size,))) if self.size else np.zeros(0, self.dtype)

    def close(self) -> None:
        self.file.close()
        os.unlink(self.file.name)


class DiskQueue:
    """A priority queue of (key, arrival, position, prefix) tuples; what it holds beyond ``held`` tuples lies on disk.

    Every push is a run sorted by key, and runs stand in the order of their arrival. A few runs in memory become one;
    when memory is full they become one run on disk.
    """

    RUNS = 16

    def __init__(self, folder: str, held: int):
        self.folder, self.held = folder, held
        self.stored: list[list] = []  # columns, begin, files
        self.inside: list[list] = []

    def push(self, keys: np.ndarray, *columns: np.ndarray) -> None:
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        self.inside.append([[keys[order], *(c[order] for c in columns)], 0, []])
        size = sum(len(c[0]) - at for c, at, _ in self.inside)
        if size > self.held or len(self.inside) > self.RUNS:
            self._merge(size > self.held)

    def _merge(self, to_disk: bool) -> None:
        columns = [np.concatenate(c) for c in zip(*([c[at:] for c in columns] for columns, at, _ in self.inside))]
        order = np.argsort(columns[0], kind="stable")
        columns = [c[order] for c in columns]
        if not to_disk:
            self.inside = [[columns, 0, []]]
            return
        files = [DiskList(self.folder, c.dtype) for c in columns]
        for file, column in zip(files, columns):
            file.append(column)
        self.stored.append([[f.array() for f in files], 0, files])
        self.inside = []

    def peek(self, limit: int) -> list[np.ndarray]:
        """The next tuples, at most ``limit``, by (key, arrival): key, position, prefix, and the run each lies in."""
        runs = self.stored + self.inside
        if not runs:
            return [np.zeros(0, np.int16)] + [np.zeros(0, np.int64)] * 3
        parts = [[c[at : at + limit] for c in columns] for columns, at, _ in runs]
        owner = np.repeat(np.arange(len(runs)), [len(p[0]) for p in parts])
        columns = [*(np.concatenate(c) for c in zip(*parts)), owner]
        order = np.argsort(columns[0], kind="stable")[:limit]
        return [c[order] for c in columns]

    def least(self) -> int | None:
        """The smallest key, if there is one."""
        return min((int(columns[0][at]) for columns, at, _ in self.stored + self.inside), default=None)

    def take(self, key: int, limit: int) -> list[np.ndarray]:
        """Take out position and prefix of the next tuples of ``key``, the smallest one; at most ``limit``.

        In one key, the order of arrival is that of the runs.
        """
        counts, parts, room = [], [], limit
        for columns, at, _ in self.stored + self.inside:
            same = columns[0][at : at + room]
            counts.append(len(same) if len(same) and same[-1] == key else int(np.searchsorted(same, same.dtype.type(key), "right")))
            room -= counts[-1]
            if counts[-1]:
                parts.append([c[at : at + counts[-1]] for c in columns[1:]])
        taken = [np.concatenate(c) for c in zip(*parts)]
        self._pass_over(counts)
        return taken

    def drop(self, owners: np.ndarray) -> None:
        """Take out the tuples that ``peek`` gave, from the first on."""
        self._pass_over(np.bincount(owners, minlength=len(self.stored) + len(self.inside)).tolist())

    def _pass_over(self, counts: list[int]) -> None:
        runs = self.stored + self.inside
        for run, count in zip(runs, counts):
            run[1] += count
            if run[1] == len(run[0][0]):
                for f in run[2]:
                    f.close()
        self.stored, self.inside = ([r for r in rs if r[1] < len(r[0][0])] for rs in (self.stored, self.inside))


class Prefixes:
    """Common prefixes of induced suffixes, from those of the suffixes that induce them."""

    def __init__(self, characters: int, cap: int):
        self.cap, self.now = cap, 0
        self.pushed = np.full(characters, -1, np.int64)
        self.seen = np.full(cap + 1, -1, np.int64)

    def induced(self, prefixes: np.ndarray, at: np.ndarray, characters: np.ndarray) -> np.ndarray:
        """``prefixes``: of each scanned suffix with the one scanned before it; ``at``: those that induce one."""
        order = np.argsort(characters, kind="stable")
        place, char = at[order], characters[order]
        begins = np.ones(len(place), bool)
        begins[1:] = char[1:] != char[:-1]
        out = np.zeros(len(place), np.int64)
        # Pairs inside the batch: the least value of (earlier place, place], by a table over powers of two.
        later = np.flatnonzero(~begins)
        if len(later):
            left, right = place[later - 1] + 1, place[later]
            level = np.frexp((right - left + 1).astype(np.float64))[1] - 1
            row = prefixes
            for k in range(int(level.max()) + 1):
                if k:
                    row = np.minimum(row[: -(1 << (k - 1))], row[1 << (k - 1) :])
                mine = level == k
                out[later[mine]] = 1 + np.minimum(row[left[mine]], row[right[mine] - (1 << k) + 1])
        # The first of a character goes back to that character's last one before the batch.
        first = np.flatnonzero(begins)
        before = self.pushed[char[first]]
        least = np.searchsorted(np.maximum.accumulate(self.seen), before, "right")
        here = np.minimum.accumulate(prefixes)[place[first]] if len(first) else least
        out[first] = np.where(before < 0, 0, 1 + np.minimum(least, here))
        self.pushed[char] = self.now + place
        self.seen[prefixes] = self.now + np.arange(len(prefixes))
        self.now += len(prefixes)
        result = np.empty(len(place), np.int64)
        result[order] = np.minimum(out, self.cap)
        return result


class SuffixSorter:
    """Sorts the suffixes of ``text`` (integers, the last one 0 and the only 0) below ``folder``."""

    def __init__(self, text: np.ndarray, characters: int, folder: str, cap: int = 0, held: int | None = None, in_memory: int | None = None):
        self.text, self.characters, self.folder, self.cap = text, characters, folder, cap
        self.held = HELD if held is None else held
        self.in_memory = IN_MEMORY if in_memory is None else in_memory
        # Twice a key fits: two bytes are sorted in linear time.
        self.narrow = np.int16 if characters < 1 << 13 else np.int64

    def descending(self) -> Iterator[Batch]:
        """(positions, common prefix with the suffix before in this order) from the largest suffix down.

        The suffix of the last character is left out. Without ``cap`` the prefixes are zero.
        """
        stars = self._sorted_stars()
        lists = [stars]
        if self.cap:
            lists.append(self._star_prefixes(stars.array()))
        for at, prefix, _ in self._scan([f.array() for f in lists], bool(self.cap)):
            yield at, prefix
        for f in lists:
            f.close()

    def _stars_downwards(self) -> DiskList:
        """Positions of the star suffixes, the last one first."""
        text, n, out = self.text, len(self.text), DiskList(self.folder)
        out.append(np.array([n - 1]))
        smaller_next, end = False, n - 1  # the type of the last but one follows from the 0 behind it
        while end > 0:
            begin = max(0, end - SLICE)
            part = np.array(text[begin : end + 1], np.int64)
            step = np.sign(part[1:] - part[:-1])
            # The type is the sign of the next step that is not level; beyond the slice, the type found there.
            known = np.flatnonzero(step)
            place = np.searchsorted(known, np.arange(len(step)))
            kinds = np.append(step[known], 1 if smaller_next else -1)
            is_small = kinds[place] > 0
            before = np.empty(len(step), bool)
            before[1:] = step[:-1] < 0
            before[0] = begin > 0 and text[begin - 1] > text[begin]
            out.append(begin + np.flatnonzero(is_small & before)[::-1])
            smaller_next, end = bool(is_small[0]), begin
        return out

    def _sorted_stars(self) -> DiskList:
        """All star suffixes in ascending order."""
        down, up = self._stars_downwards(), DiskList(self.folder)
        m = down.size
        for hi in range(m, 0, -SLICE):
            up.append(down.array()[max(0, hi - SLICE) : hi][::-1])
        places = up.array()
        by_char = DiskList(self.folder)
        queue = DiskQueue(self.folder, self.held)
        for lo in range(0, m, SLICE):
            part = np.array(places[lo : lo + SLICE])
            queue.push(self.text[part].astype(self.narrow), part, np.zeros(len(part), np.uint16))
        while len((part := queue.peek(SLICE))[0]):
            by_char.append(part[1])
            queue.drop(part[3])
        # Induced from first characters alone, the stars come out in the order of the substrings up to the next star.
        found = DiskList(self.folder)
        for at, _, small in self._scan([by_char.array()], False):
            inner = at[small & (at > 0)]
            found.append(inner[self.text[inner - 1] > self.text[inner]])
        found.append(places[-1:])
        by_char.close()
        ordered = found.array()[::-1]
        names, distinct = self._named(ordered, places)
        if distinct == m:
            out = DiskList(self.folder)
            for lo in range(0, m, SLICE):
                out.append(ordered[lo : lo + SLICE])
        else:
            out = self._by_names(names.array(), distinct, places)
        for f in (down, up, found, names):
            f.close()
        return out

    def _named(self, ordered: np.ndarray, places: np.ndarray) -> tuple[DiskList, int]:
        """The text of names: for each star in text order the rank of its substring; and how many ranks there are."""
        m, name = len(ordered), -1
        file = DiskList(self.folder)
        for lo in range(0, m, SLICE):
            file.append(np.zeros(min(SLICE, m - lo), np.int64))
        file.file.flush()
        names = np.memmap(file.file.name, np.int64, "r+", shape=(m,))
        for lo in range(0, m, SLICE):
            part = np.array(ordered[max(0, lo - 1) : lo + SLICE])
            ordinal = np.searchsorted(places, part)
            length = np.array(places[np.minimum(ordinal + 1, m - 1)]) - part
            same = self._equal(part[:-1], part[1:], length[:-1], length[1:])
            if not lo:
                same = np.append(False, same)
            else:
                ordinal = ordinal[1:]
            rank = name + np.cumsum(~same)
            names[ordinal] = rank
            name = int(rank[-1])
        names.flush()
        return file, name + 1

    def _equal(self, a: np.ndarray, b: np.ndarray, length_a: np.ndarray, length_b: np.ndarray) -> np.ndarray:
        """Whether two substrings, both ends included, are equal."""
        equal = length_a == length_b
        open_ = np.flatnonzero(equal)
        step = 0
        while len(open_):
            differs = self.text[a[open_] + step] != self.text[b[open_] + step]
            equal[open_[differs]] = False
            open_ = open_[~differs]
            open_ = open_[length_a[open_] > step]
            step += 1
        return equal

    def _by_names(self, names: np.ndarray, distinct: int, places: np.ndarray) -> DiskList:
        out = DiskList(self.folder)
        if len(names) <= self.in_memory:
            order = doubled(np.array(names))
            for lo in range(0, len(order), SLICE):
                out.append(places[order[lo : lo + SLICE]])
            return out
        down = DiskList(self.folder)
        for at, _ in SuffixSorter(names, distinct, self.folder, 0, self.held, self.in_memory).descending():
            down.append(at)
        down.append(np.array([len(names) - 1]))
        order = down.array()[::-1]
        for lo in range(0, len(order), SLICE):
            out.append(places[np.array(order[lo : lo + SLICE])])
        down.close()
        return out

    def _star_prefixes(self, stars: np.ndarray) -> DiskList:
        """Common prefix of each star with the one before it, up to the cap."""
        out = DiskList(self.folder)
        for lo in range(0, len(stars), SLICE):
            part = np.array(stars[max(0, lo - 1) : lo + SLICE])
            prefix = np.zeros(len(part) - 1, np.int64)
            open_ = np.arange(len(prefix))
            for step in range(self.cap):
                open_ = open_[self.text[part[open_] + step] == self.text[part[open_ + 1] + step]]
                if not len(open_):
                    break
                prefix[open_] = step + 1
            out.append(prefix if lo else np.append(0, prefix))
        return out

    def _level(self, at: int, char: int) -> int:
        """How often ``char`` stands in a row from ``at`` on, up to the cap."""
        part = np.array(self.text[at : at + self.cap])
        other = np.flatnonzero(part != char)
        return int(other[0]) if len(other) else len(part)

    def _scan(self, stars: list[np.ndarray], with_prefixes: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Induce all suffixes from the stars in the given order; yields them from the largest down, and which are S."""
        larger = [DiskList(self.folder), DiskList(self.folder, np.uint16)]
        given = Given(stars[0], stars[1] if with_prefixes else None, False)
        for at, prefix, is_star in self._pass(given, 1, with_prefixes):
            larger[0].append(at[~is_star])
            larger[1].append(prefix[~is_star])
        given = Given(larger[0].array(), larger[1].array() if with_prefixes else None, True)
        for at, prefix, is_larger in self._pass(given, -1, with_prefixes):
            yield at, prefix, ~is_larger
        for f in larger:
            f.close()

    def _pass(self, given: Given, sign: int, with_prefixes: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """One scan over the buckets, upwards (sign 1) or downwards (-1): position, prefix, and which are given.

        In a bucket the induced suffixes come before the given ones.
        """
        queue = DiskQueue(self.folder, self.held)
        track = Prefixes(self.characters, self.cap) if with_prefixes else None
        last = (-1, np.iinfo(np.int64).min, False)
        for at, prefix, key, is_given, child in self._buckets(queue, given, sign) if self.characters <= FEW else self._stretches(queue, given, sign):
            if track is not None:
                self._join_sides(at, prefix, key, is_given, last, sign)
            last = (int(at[-1]), int(key[-1]), bool(is_given[-1]))
            yield at, prefix, is_given
            mine = np.flatnonzero(child < np.iinfo(np.int64).max)
            char = child[mine]
            made = np.zeros(len(mine), np.int64) if track is None else track.induced(prefix, mine, sign * char)
            queue.push(char.astype(self.narrow), at[mine] - 1, made.astype(np.uint16))

    def _children(self, at: np.ndarray, sign: int, least: np.ndarray | int) -> np.ndarray:
        """The key that each suffix induces; the largest number where it is below ``least``, hence of the other type."""
        none = np.iinfo(np.int64).max
        child = sign * self.text[at - 1].astype(np.int64)  # the last character stands before the first place: made none
        child[(child < least) | (at == 0)] = none
        return child

    def _buckets(self, queue: DiskQueue, given: Given, sign: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Position, prefix, key, which are given, and key induced: a bucket's induced suffixes as they are, then its given ones.

        An induced suffix induces nothing before the next of its bucket, a given one nothing in it.
        """
        while True:
            induced, known = queue.least(), given.bucket(self.text, sign)
            if induced is not None and (known is None or induced <= known):
                key, is_given = induced, False
                at, prefix = queue.take(key, SLICE)
                prefix = prefix.astype(np.int64)
            elif known is not None:
                key, is_given = known, True
                at, prefix = given.take()
            else:
                return
            yield at, prefix, np.full(len(at), key, np.int64), np.full(len(at), is_given), self._children(at, sign, key + is_given)

    def _stretches(self, queue: DiskQueue, given: Given, sign: int) -> Iterator[tuple[np.ndarray, ...]]:
        """The same for many small buckets: as many tuples at once as come before the first one that they induce themselves."""
        room = 256
        while True:
            keys, at, prefix, owner = queue.peek(room)
            more_at, more_prefix = given.peek(room)
            if not len(at) + len(more_at):
                return
            full = [len(at) == room, len(more_at) == room]
            is_given = np.arange(len(at) + len(more_at)) >= len(at)
            key = np.concatenate([keys, (sign * self.text[more_at].astype(np.int64)).astype(self.narrow)])
            order = np.argsort(2 * key + is_given, kind="stable")
            # Behind the last tuple of a side that was cut off, the order is not known yet.
            for side in (0, 1):
                known = np.flatnonzero(is_given[order] == side)
                if full[side] and len(known):
                    order = order[: known[-1] + 1]
            at = np.concatenate([at, more_at])[order]
            prefix = np.concatenate([prefix.astype(np.int64), more_prefix])[order]
            key, is_given = key[order].astype(np.int64), is_given[order]
            child = self._children(at, sign, key + is_given)
            floor = np.append(np.iinfo(np.int64).max, np.minimum.accumulate(child)[:-1])
            late = np.flatnonzero((key > floor) | ((key == floor) & is_given))
            n = int(late[0]) if len(late) else len(at)
            taken = n - int(is_given[:n].sum())
            queue.drop(owner[:taken])
            given.done += n - taken
            room = min(SLICE, 2 * room) if n == len(order) else max(256, 2 * n)
            yield at[:n], prefix[:n], key[:n], is_given[:n], child[:n]

    def _join_sides(self, at, prefix, key, is_given, last: tuple[int, int, bool], sign: int) -> None:
        """Set the prefix of each first given suffix of a bucket: it follows an induced one, or another bucket."""
        before = np.append(last[1], key[:-1])
        begins = is_given & ((before != key) | ~np.append(last[2], is_given[:-1]))
        for i in np.flatnonzero(begins).tolist():
            char = int(sign * key[i])
            other = int(at[i - 1]) if i else last[0]
            prefix[i] = min(self._level(other, char), self._level(int(at[i]), char)) if before[i] == key[i] else 0


class Given:
    """The suffixes that a scan starts from, in its order: a list, or a list with the prefixes of its pairs from the end."""

    def __init__(self, places: np.ndarray, prefixes: np.ndarray | None, backwards: bool):
        self.places, self.prefixes, self.backwards, self.done = places, prefixes, backwards, 0
        self.ahead: Batch = (places[:0], places[:0])
        self.begin, self.ends, self.keys = 0, [0], []

    def bucket(self, text: np.ndarray, sign: int) -> int | None:
        """The key of the next suffixes, if there are any."""
        if self.begin == len(self.ahead[0]):
            self.ahead, self.begin = self.peek(SLICE), 0
            key = sign * text[self.ahead[0]].astype(np.int64)
            last = np.flatnonzero(np.append(key[1:] != key[:-1], True)) if len(key) else np.zeros(0, np.int64)
            self.ends, self.keys = (last[::-1] + 1).tolist(), key[last[::-1]].tolist()
        return self.keys[-1] if self.keys else None

    def take(self) -> Batch:
        """Take out the suffixes of the key that ``bucket`` gave."""
        lo, self.begin = self.begin, self.ends.pop()
        self.keys.pop()
        self.done += self.begin - lo
        return self.ahead[0][lo : self.begin], self.ahead[1][lo : self.begin]

    def peek(self, limit: int) -> Batch:
        n = len(self.places)
        if not self.backwards:
            part = np.array(self.places[self.done : self.done + limit])
            prefix = np.zeros(len(part)) if self.prefixes is None else self.prefixes[self.done : self.done + limit]
            return part, np.array(prefix, np.int64)
        hi = n - self.done
        lo = max(0, hi - limit)
        part, prefix = np.array(self.places[lo:hi][::-1]), np.zeros(hi - lo, np.int64)
        if self.prefixes is not None and hi > lo:
            # A prefix belongs to a suffix and the one below it; seen downwards, to the lower one.
            behind = np.array(self.prefixes[lo + 1 : min(n, hi + 1)], np.int64)
            prefix[:] = np.append(behind, 0)[: hi - lo][::-1] if hi == n else behind[::-1]
        return part, prefix


def doubled(text: np.ndarray) -> np.ndarray:
    """Suffix array of a text of ranks in memory, by doubling the compared length.

    A rank is the first place of the suffixes that are equal so far; only where there are several are sorted again.
    """
    n, step = len(text), 1
    order = np.argsort(text, kind="stable")
    rank, open_ = np.empty(n, np.int64), np.arange(n)
    key = text[order]
    while True:
        new = np.append(True, key[1:] != key[:-1])
        rank[order[open_]] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        open_ = open_[~(new & np.append(new[1:], True))]
        if not len(open_):
            return order
        items = order[open_]
        follow = items + step
        key = rank[items] * (n + 1) + np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        within = np.argsort(key)
        order[open_], key = items[within], key[within]
        step *= 2
