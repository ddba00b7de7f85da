"""N-gram Jaccard join: all groups of documents whose word-shingle sets overlap by a threshold, by T-occurrence search.

A document that links with any other shares at least `least` percent of its own shingles with it. So:

1. Every document's shingle hashes are dealt by hash range, packed with the document's place in its block. Each range counts
   the documents of each hash and answers, per document, how many of its shingles occur elsewhere. A document with too few
   can have no link and is done; most are. Copies with equal sets are one class from here on. Counting repeats among the
   classes that remain while it removes a tenth of them; it only prunes, so where it stops doesn't change the result.
   Partitions are those of the session; one that holds more than RANGE_BYTES of text is cut into finer ranges, which the task
   writes to a temporary file of its own and counts one by one.
2. First search: classes that agree in one of ROUNDS least hashes are searched together, in blocks of at most GROUP_SHINGLES that
   share the group's first class. This is linear, finds nearly all links of large groups of near copies, and leaves components.
3. Second search, which makes the result exact: of each class, shingles in order of frequency; two linked sets share one among the
   first n - ceil(least * n) + 1 of each. A shingle whose classes are all in one component is done with. Classes under a
   shingle of at most SHORT classes are candidates of each other if they are in different components, their sizes are near
   enough and enough shingles come after the one they share; each candidate is probed by bisection. Classes under longer lists
   are searched by connected groups of them, large ones in pairs of blocks, in which components known so far count.

A search of a group is DivideSkip: the longest inverted lists of a query's shingles are set aside, the rest are heap-merged, and
documents that reach the overlap that could still suffice are probed in the long lists by bisection. A pair already
connected isn't searched again.

Every step is exact but for 64-bit hashes of shingles (48 bits in counting, where a collision only keeps a document longer)
and 128-bit hashes of sets and texts. No pairs of a group are listed: the result is each document's component.

Defined results: words are `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased; fewer than `width` words are one shingle; null, empty and
blank texts have none and link with nothing; repeated rows link as copies; a null id never names a component unless
all its members' are null; other columns are left out, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import tempfile
from bisect import bisect_left
from heapq import merge
from math import log2

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.llm.common import materialise, parts_for, small, text_batches, tidy
from linkmill.llm.components import Groups, components

WIDTH, LEAST = 5, 75
#: Bytes of text hashed at a time, shingles of a block, text bytes of a counting range, shingles searched in one group.
CHUNK, BLOCK_SHINGLES, RANGE_BYTES, GROUP_SHINGLES = 1 << 19, 500_000, 5_000_000, 1_000_000
#: Shingles written to finer ranges together, answers put together, least hashes of the first search, classes of a short list.
REGROUP, ANSWERS, ROUNDS, SHORT = 1_000_000, 500_000, 3, 64
_M = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15
_Q = pow(_P, -1, 1 << 64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_VALUE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_P))
_VALUE[65:91] = _VALUE[97:123]
_TABLES: list[np.ndarray] = [np.zeros(0, np.uint64)] * 2


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of UTF-8 bytes."""
    data = np.frombuffer(raw, np.uint8)
    if len(_TABLES[0]) <= len(data):
        _TABLES[:] = _powers(_P, 2 * len(data) + 1), _powers(_Q, 2 * len(data) + 1)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    upto = np.concatenate([[np.uint64(0)], np.cumsum(_VALUE[data] * _TABLES[0][: len(data)], dtype=np.uint64)])
    return start, _mix((upto[end] - upto[start]) * _TABLES[1][start] + (end - start).astype(np.uint64))


def _chunks(raw: bytes):
    """Parts of about CHUNK bytes, cut at white space; a longer word stays whole."""
    at = 0
    while len(raw) - at > CHUNK:
        cut = max(raw.rfind(b, at, at + CHUNK) for b in (b" ", b"\n"))
        if cut <= at:
            found = [p for b in (b" ", b"\n") if (p := raw.find(b, at + CHUNK)) >= 0]
            if not found:
                break
            cut = min(found)
        yield raw[at : cut + 1]
        at = cut + 1
    yield raw[at:]


def shingle_sets(texts: list[str], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes (uint64) of each text."""
    out, held, size = [], [], 0

    def sets(hashes: np.ndarray, counts: list[int]) -> None:
        if len(hashes) >= width:
            run = np.zeros(len(hashes) - width + 1, np.uint64)
            for k in range(width):
                run = run * np.uint64(_P) + hashes[k : len(run) + k]
            run = _mix(run)
        at = 0
        for n in counts:
            if n >= width:
                out.append(np.unique(run[at : at + n - width + 1]))
            elif n:
                h = n
                for w in hashes[at : at + n].tolist():
                    h = (h * _Q + w) & _M
                out.append(_mix(np.array([h], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
            at += n

    def flush() -> None:
        if held:
            raw = b" ".join(held)
            start, hashes = word_hashes(raw)
            ends = np.cumsum([len(h) + 1 for h in held])
            sets(hashes, np.diff(np.concatenate([[0], np.searchsorted(start, ends)])).tolist())
            held.clear()

    for text in texts:
        raw = text.encode()
        if len(raw) > CHUNK:
            flush()
            size = 0
            hashes = np.concatenate([word_hashes(c)[1] for c in _chunks(raw)])
            sets(hashes, [len(hashes)])
            continue
        if size + len(raw) > CHUNK:
            flush()
            size = 0
        held.append(raw)
        size += len(raw) + 1
    flush()
    return out


def _sums(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    a, b = _mix(s + np.uint64(1)).sum(dtype=np.uint64), np.bitwise_xor.reduce(_mix(s ^ np.uint64(_P))) if len(s) else np.uint64(0)
    return int(np.uint64(a).astype(np.int64)), int(np.uint64(b).astype(np.int64))


# ---------------------------------------------------------------- counting

#: Rows of shingles (part >= 0) of a block, and rows that name a block's documents (part < 0).
_PACKED = "to long, part long, block long, lows binary, highs binary, places binary, ids binary, nulls binary, sizes binary, s1 binary, s2 binary, k1 binary, k2 binary"


def _columns(schema: str) -> tuple[list[str], list[pa.DataType]]:
    pairs = [c.split() for c in schema.split(", ")]
    return [n for n, _ in pairs], [pa.int64() if t == "long" else pa.binary() for _, t in pairs]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = _columns(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _rows(batches, schema: str):
    names, _ = _columns(schema)
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Which of so many equal ranges 48-bit hashes are in."""
    return ((hashes >> np.uint64(16)) * np.uint64(ranges)) >> np.uint64(32)


def _split(hashes: np.ndarray) -> tuple[bytes, bytes]:
    return hashes.astype("<u4").tobytes(), (hashes >> np.uint64(32)).astype("<u2").tobytes()


def _joined(lows: bytes, highs: bytes) -> np.ndarray:
    return np.frombuffer(highs, "<u2").astype(np.uint64) << np.uint64(32) | np.frombuffer(lows, "<u4")


def _codes(block: int, places: bytes) -> np.ndarray:
    """Documents as one number each: their block and their place in it."""
    return np.frombuffer(places, "<u2").astype(np.uint64) | np.uint64(block << 16)


def _routes(spark, parts: int) -> list[int]:
    """A number for each partition that the shuffle deals to it alone, so that ranges don't meet in one task by chance."""
    tried = spark.range(parts * 40).groupBy(F.pmod(F.hash("id"), F.lit(parts)).alias("at")).agg(F.min("id").alias("id")).collect()  # a row per partition
    found = {r.at: r.id for r in tried}
    return [found.get(p, p) for p in range(parts)]


def _pack(sets, routes: list[int]):
    """From (id or None, text keys, shingles) rows: a row for each hash range of a block, and one that names the block's documents."""
    n_blocks, parts = TaskContext.get().partitionId() << 24, len(routes)
    names, arrays, held = [], [], 0

    def block():
        nonlocal n_blocks
        uid, n_blocks = n_blocks, n_blocks + 1
        every = np.concatenate(arrays) >> np.uint64(16)
        places = np.repeat(np.arange(len(arrays), dtype=np.uint32), [len(a) for a in arrays])
        order = np.argsort(every, kind="stable")
        every, places = every[order], places[order].astype("<u2")
        cuts = np.searchsorted(_range_of(every, parts), np.arange(parts + 1, dtype=np.uint64)).tolist()
        rows = [(routes[p], p, uid, *_split(every[a:b]), places[a:b].tobytes(), *[None] * 7) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
        sums = [_sums(a) for a in arrays]
        long = lambda v: np.array(v, "<i8").tobytes()
        ids, k1, k2 = zip(*names, strict=True)
        told = (long([i or 0 for i in ids]), bytes(i is None for i in ids), long([len(a) for a in arrays]), long([a for a, _ in sums]), long([b for _, b in sums]), long(k1), long(k2))
        rows.append((routes[uid % parts], -1 - uid % parts, uid, None, None, None, *told))
        return _batch(rows, _PACKED)

    for name, s in sets:
        if names and (held + len(s) > BLOCK_SHINGLES or len(names) == 60_000):
            yield block()
            names, arrays, held = [], [], 0
        names.append(name)
        arrays.append(s)
        held += len(s)
    if names:
        yield block()
    names, arrays = [], []
    tidy()


class _Ranges:
    """Shingles of a task's hash ranges, each cut into so many finer ones, in a temporary file; `most` of them are put there at a time."""

    def __init__(self, file, parts: int, subs: int, most: int):
        self.file, self.parts, self.subs, self.most = file, parts, subs, most
        self.lies: dict[tuple[int, int], list[tuple[int, int]]] = {}  # of each finer range: offset and number of shingles
        self.held: dict[int, list[tuple]] = {}
        self.n = 0

    def add(self, part: int, block: int, lows: bytes, highs: bytes, places: bytes) -> None:
        self.held.setdefault(part, []).append((block, lows, highs, places))
        self.n += len(places) // 2
        if self.n >= self.most:
            self.write()

    def write(self) -> None:
        for part, some in self.held.items():
            every, codes = np.concatenate([_joined(r[1], r[2]) for r in some]), np.concatenate([_codes(r[0], r[3]) for r in some])
            sub = _range_of(every, self.parts * self.subs) - np.uint64(part * self.subs)
            order = np.argsort(sub, kind="stable")
            every, codes = every[order], codes[order]
            cuts = np.searchsorted(sub[order], np.arange(self.subs + 1, dtype=np.uint64)).tolist()
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if b > a:
                    self.lies.setdefault((part, k), []).append((self.file.tell(), b - a))
                    self.file.writelines((*_split(every[a:b]), codes[a:b].astype("<u8").tobytes()))
        self.held.clear()
        self.n = 0

    def read(self):
        """Yields (hashes, documents) of each finer range."""
        self.write()
        for key in sorted(self.lies):
            every, codes = [], []
            for offset, n in self.lies[key]:
                self.file.seek(offset)
                every.append(_joined(self.file.read(4 * n), self.file.read(2 * n)))
                codes.append(np.frombuffer(self.file.read(8 * n), "<u8"))
            yield np.concatenate(every), np.concatenate(codes)


#: Answers (kind 1) for the documents of some blocks, which share `dest`, and rows that name a block's documents (kind 0).
_ANSWER = "to long, dest long, kind long, codes binary, counts binary, tokens binary, block long, ids binary, nulls binary, sizes binary, s1 binary, s2 binary, k1 binary, k2 binary"


def _answer(routes: list[int], subs: int, tokens: bool):
    """Of each hash range: how many shingles of which document occur elsewhere; with tokens, which and how often.

    Cutting and counting are one step of one worker: two in a task would keep twice the workers for the rest of the session.
    """

    parts = len(routes)

    def run(batches):
        acc: list[tuple] = []
        n_acc = 0

        def told():
            codes, counts, names = (np.concatenate(x) for x in zip(*acc, strict=True))
            acc.clear()
            if not tokens:
                codes, at = np.unique(codes, return_inverse=True)
                counts = np.bincount(at, counts, len(codes)).astype(np.int64)
            dest = (codes >> np.uint64(16)) % np.uint64(parts)
            order = np.argsort(dest, kind="stable")
            codes, counts, dest = codes[order], np.minimum(counts[order], 0xFFFFFFFF).astype("<u4"), dest[order]
            names = names[order] if tokens else names
            heads = np.flatnonzero(np.concatenate([[True], dest[1:] != dest[:-1]])).tolist()
            rows = [(routes[int(dest[a])], int(dest[a]), 1, codes[a:b].astype("<u8").tobytes(), counts[a:b].tobytes(), names[a:b].astype("<u8").tobytes() if tokens else None, *[None] * 8) for a, b in zip(heads, [*heads[1:], len(dest)], strict=True)]
            return _batch(rows, _ANSWER)

        def count(every: np.ndarray, codes: np.ndarray) -> None:
            nonlocal n_acc
            values, at, n = np.unique(every, return_inverse=True, return_counts=True)
            n = n[at]
            shared = n > 1
            if shared.any():
                acc.append((codes[shared], n[shared] if tokens else np.ones(int(shared.sum()), np.int64), every[shared] if tokens else np.zeros(0, np.uint64)))
                n_acc += len(acc[-1][0])

        with tempfile.TemporaryFile() as file:
            ranges = _Ranges(file, parts, subs, REGROUP)
            for row in _rows(batches, _PACKED):
                if row[1] < 0:
                    dest = -1 - row[1]
                    yield _batch([(routes[dest], dest, 0, None, None, None, row[2], *row[6:])], _ANSWER)
                else:
                    ranges.add(*row[1:6])
            for every, codes in ranges.read():
                count(every, codes)
                if n_acc >= ANSWERS:
                    yield told()
                    n_acc = 0
        if acc:
            yield told()
        ranges = every = codes = None
        tidy()

    return run


def _by_dest(batches):
    """Of each dest, from rows sorted by (dest, kind): names of its documents by code, [(codes, counts, tokens)]."""

    def names_of(rows: list[tuple]):
        rows.sort(key=lambda r: r[0])
        long = lambda i: np.concatenate([np.frombuffer(r[i], "<i8") for r in rows])
        codes = np.concatenate([np.arange(len(r[2]), dtype=np.uint64) | np.uint64(r[0] << 16) for r in rows])
        return codes, long(1), np.concatenate([np.frombuffer(r[2], bool) for r in rows]), *(long(i) for i in range(3, 8))

    dest, named, answers = None, [], []
    for _, *row in _rows(batches, _ANSWER):
        if row[0] != dest:
            if named:
                yield names_of(named), answers
            dest, named, answers = row[0], [], []
        if row[1] == 0:
            named.append(row[5:])
        else:
            answers.append((np.frombuffer(row[2], "<u8"), np.frombuffer(row[3], "<u4"), row[4] and np.frombuffer(row[4], "<u8")))
    if named:
        yield names_of(named), answers


_TOLD = "id long, n long, s1 long, s2 long, k1 long, k2 long, shared long"


def _told(batches):
    for (codes, ids, nulls, sizes, s1, s2, k1, k2), answers in _by_dest(batches):
        shared = np.zeros(len(ids), np.int64)
        for at, counts, _ in answers:
            np.add.at(shared, np.searchsorted(codes, at), counts)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=nulls), *map(pa.array, (sizes, s1, s2, k1, k2, shared))], _columns(_TOLD)[0])
    tidy()


_RARE = "token long, id long, n long, later long"


def _rare(least: int):
    """The shingles, in order of frequency, of which two linked documents share one; later: the document's shingles after it."""

    def run(batches):
        for (codes, ids, _, sizes, *_), answers in _by_dest(batches):
            if not answers:
                continue
            at, counts, tokens = (np.concatenate(x) for x in zip(*answers, strict=True))
            at = np.searchsorted(codes, at)
            order = np.lexsort((tokens, counts, at))
            at, tokens = at[order], tokens[order]
            heads = np.searchsorted(at, np.arange(len(ids)))
            shared = np.searchsorted(at, np.arange(len(ids)), side="right") - heads
            # those found nowhere else come first and are left out
            place = np.arange(len(at)) - heads[at] + (sizes - shared)[at]
            kept = place < (sizes - -(-sizes * least // 100) + 1)[at]
            of = at[kept]
            yield pa.RecordBatch.from_arrays([pa.array(tokens[kept].astype(np.int64)), pa.array(ids[of]), pa.array(sizes[of]), pa.array(sizes[of] - place[kept] - 1)], _columns(_RARE)[0])
        tidy()

    return run


def _counted(packed: DataFrame, routes: list[int], subs: int, last, schema: str, tokens: bool) -> DataFrame:
    parts = len(routes)
    answers = packed.repartition(parts, "to").mapInArrow(_answer(routes, subs, tokens), _ANSWER)
    return answers.repartition(parts, "to").sortWithinPartitions("dest", "kind").mapInArrow(last, schema)


def _stored(batches):
    for batch in batches:
        for doc, s in zip(batch.column("id").to_pylist(), batch.column("shingles"), strict=True):
            yield (doc, 0, 0), np.frombuffer(s.as_buffer(), "<u8")


# ---------------------------------------------------------------- search


def search(ids: np.ndarray, sets: list[np.ndarray], least: int, known: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(id, centre) of the groups that links connect among sets, by DivideSkip; sets of one known component are taken as connected."""
    n = len(sets)
    sizes = [len(s) for s in sets]
    groups = Groups(n)
    first: dict[int, int] = {}
    for i, k in enumerate(known or ()):
        groups.join(first.setdefault(k, i), i)
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    docs = np.repeat(np.arange(n), sizes)
    order = np.argsort(at, kind="stable")
    cuts = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(values)))])
    listed = docs[order]
    length = np.diff(cuts)
    starts = np.concatenate([[0], np.cumsum(sizes)])

    def query(x: int) -> None:
        need = -(-sizes[x] * least // 100)  # of x's own shingles
        mine = at[starts[x] : starts[x + 1]]
        mine = mine[length[mine] > 1]
        if len(mine) < need:
            return
        mine = mine[np.argsort(-length[mine], kind="stable")]
        aside = min(need - 1, int(need / (0.0085 * log2(length[mine[0]]) + 1)))
        short = [listed[cuts[t] : cuts[t + 1]].tolist() for t in mine[aside:].tolist()]
        probed = [listed[cuts[t] : cuts[t + 1]] for t in mine[:aside].tolist()]
        found, last, count = [], -1, 0
        for y in merge(*short):
            if y != last:
                if count >= need - aside and last != x:
                    found.append((last, count))
                last, count = y, 0
            count += 1
        if count >= need - aside and last != x:
            found.append((last, count))
        for y, overlap in found:
            if groups.find(x) == groups.find(y):
                continue
            wanted = -(-least * (sizes[x] + sizes[y]) // (100 + least))
            for k, held in enumerate(probed):
                if overlap >= wanted or overlap + len(probed) - k < wanted:
                    break
                i = bisect_left(held, y)
                overlap += i < len(held) and held[i] == y
            if overlap >= wanted:
                groups.join(x, y)

    # members of the largest group need no query of their own, as long as all others have theirs
    done = [False] * n
    largest = max(range(n), key=lambda i: groups.size[groups.find(i)])
    while True:
        top = groups.find(largest)
        waiting = [i for i in range(n) if not done[i] and groups.find(i) != top]
        if not waiting:
            break
        for i in waiting:
            root, top = groups.find(i), groups.find(largest)
            if groups.size[root] > groups.size[top]:
                largest = top = root
            if root != top:
                query(i)
                done[i] = True
    roots = np.array([groups.find(i) for i in range(n)])
    rest = np.flatnonzero(roots != np.arange(n))
    return ids[rest], ids[roots[rest]]


def _search_groups(least: int):
    def run(batches):
        key, ids, sets, known = None, [], [], []

        def done():
            a, b = search(np.array(ids), sets, least, known)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["node", "centre"])

        for batch in batches:
            for group, i, j, doc, part, s in zip(*(batch.column(c).to_pylist() for c in ("group", "i", "j", "id", "part", "shingles")), strict=True):
                if (group, i, j) != key:
                    if len(ids) > 1:
                        yield done()
                    key, ids, sets, known = (group, i, j), [], [], []
                if ids and ids[-1] == doc:
                    continue  # a group's first class is in its own block already
                ids.append(doc)
                sets.append(np.frombuffer(s, "<u8"))
                known.append(part)
        if len(ids) > 1:
            yield done()
        ids, sets = [], []
        tidy()

    return run


def _least_hashes(batches):
    """(id, n, group): each class under the least of its shingles' hashes, by ROUNDS ways to hash them."""
    for batch in batches:
        ids, sizes = batch.column("id").to_numpy(), batch.column("n").to_numpy()
        out = np.zeros((len(ids), ROUNDS), np.uint64)
        for i, s in enumerate(batch.column("shingles")):
            values = np.frombuffer(s.as_buffer(), "<u8")
            for k in range(ROUNDS):
                out[i, k] = (_mix(values + np.uint64(k * _Q & _M)).min() << np.uint64(2) | np.uint64(k)) if len(values) else 0
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, ROUNDS)), pa.array(np.repeat(sizes, ROUNDS)), pa.array(out.ravel().astype(np.int64))], ["id", "n", "group"])
    tidy()


def _candidates(least: int):
    """(x, y) of each short list, from rows sorted by token: classes of different components that could still overlap enough."""

    def run(batches):
        token, held = None, []

        def pairs():
            ids, sizes, later, part = (np.array(c, np.int64) for c in zip(*held, strict=True))
            i, j = np.triu_indices(len(ids), 1)
            wanted = -(-least * (sizes[i] + sizes[j]) // (100 + least))
            kept = (part[i] != part[j]) & (np.minimum(sizes[i], sizes[j]) >= wanted) & (1 + np.minimum(later[i], later[j]) >= wanted)
            a, b = ids[i[kept]], ids[j[kept]]
            return np.minimum(a, b), np.maximum(a, b)

        out, n = [], 0
        for batch in batches:
            for t, *row in zip(*(batch.column(c).to_pylist() for c in ("token", "id", "n", "later", "part")), strict=True):
                if t != token:
                    if len(held) > 1:
                        out.append(pairs())
                        n += len(out[-1][0])
                    if n > 100_000:
                        x, y = (np.concatenate(c) for c in zip(*out, strict=True))
                        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])
                        out, n = [], 0
                    token, held = t, []
                held.append(row)
        if len(held) > 1:
            out.append(pairs())
        if out:
            x, y = (np.concatenate(c) for c in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])
        tidy()

    return run


def _probe(least: int):
    """Links (node, centre) of each x, whose set comes first, with the sets that follow it: y's shingles are probed by bisection."""

    def run(batches):
        own, mine = None, None
        for batch in batches:
            a, b = [], []
            for x, y, s in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), batch.column("shingles"), strict=True):
                values = np.frombuffer(s.as_buffer(), "<u8")
                if y is None:
                    own, mine = x, values.copy()
                    continue
                assert own == x
                few, many = (mine, values) if len(mine) <= len(values) else (values, mine)
                at = np.minimum(np.searchsorted(many, few), len(many) - 1)
                overlap = int((many[at] == few).sum())
                if 100 * overlap >= least * (len(mine) + len(values) - overlap):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["node", "centre"])
        tidy()

    return run


def _first_search(held: DataFrame, parts: int, least: int) -> DataFrame:
    """Links (node, centre) among classes that agree in a least hash."""
    hashed = materialise(held.mapInArrow(_least_hashes, "id long, n long, group long"), "least-hashes")
    sizes = hashed.groupBy("group").agg(F.count("*").alias("members"), F.sum("n").alias("total"), F.min("id").alias("first")).where("members > 1")
    sizes = small(materialise(sizes.select("group", "first", F.ceil(F.col("total") / GROUP_SHINGLES).alias("blocks")), "hash-groups"))
    member = hashed.join(sizes, "group")
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    places = F.when(F.col("id") == F.col("first"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(own))
    placed = member.select("group", "id", F.explode(places).alias("i")).join(held, "id").select("group", "i", F.lit(0).cast("long").alias("j"), "id", F.col("id").alias("part"), "shingles")
    dealt = placed.repartition(parts, "group", "i").sortWithinPartitions("group", "i", "j", "id")
    return dealt.mapInArrow(_search_groups(least), "node long, centre long")


def _second_search(held: DataFrame, rare: DataFrame, settled: DataFrame, parts: int, least: int) -> DataFrame:
    """Links (node, centre) between components of (id, part) that share a rare shingle."""
    lists = rare.join(settled, "id", "left").withColumn("part", F.coalesce("part", "id"))
    lists = materialise(lists, "rare-lists")
    open_ = lists.groupBy("token").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("members"), F.min("id").alias("first")).where("low < high")
    open_ = small(materialise(open_.select("token", "members", "first"), "open-lists"))
    lists = lists.join(open_, "token")
    short = lists.where(F.col("members") <= SHORT).select("token", "id", "n", "later", "part").repartition(parts, "token").sortWithinPartitions("token")
    pairs = materialise(short.mapInArrow(_candidates(least), "x long, y long").distinct(), "candidates")
    sets = held.select("id", "shingles")
    queries = pairs.select("x").distinct().join(sets, F.col("x") == F.col("id")).select("x", F.lit(None).cast("long").alias("y"), "shingles")
    others = pairs.join(sets, F.col("y") == F.col("id")).select("x", "y", "shingles")
    probed = queries.unionByName(others).repartition(parts, "x").sortWithinPartitions("x", F.col("y").asc_nulls_first())
    found = probed.mapInArrow(_probe(least), "node long, centre long")
    # longer lists: connected groups of their classes, in pairs of blocks where they are large
    long = materialise(lists.where(F.col("members") > SHORT).select("id", "first", "part").distinct(), "long-lists")
    if not long.limit(1).count():
        return found
    near = components(long.select("id", "first"), "id", "first").select(F.col("node").alias("id"), F.col("centre").alias("group"))
    near = materialise(near.unionByName(near.select(F.col("group").alias("id"), "group").distinct()), "near")
    part = long.select("id", "part").distinct()
    grouped = materialise(near.join(part, "id").join(held, "id"), "grouped")
    sizes = grouped.groupBy("group").agg(F.sum("n").alias("total"))
    cut = small(materialise(sizes.where(F.col("total") > GROUP_SHINGLES).select("group", F.ceil(F.col("total") * 2 / GROUP_SHINGLES).alias("blocks")), "large"))
    zero = F.lit(0).cast("long")
    whole = grouped.join(cut, "group", "left_anti").select("group", zero.alias("i"), zero.alias("j"), "id", "part", "shingles")
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    split = grouped.join(cut, "group").withColumn("b", block).withColumn("k", F.explode(F.sequence(zero, F.col("blocks") - 1))).where("k <> b")
    split = split.select("group", F.least("b", "k").alias("i"), F.greatest("b", "k").alias("j"), "id", "part", "shingles")
    dealt = whole.unionByName(split).repartition(parts, "group", "i", "j").sortWithinPartitions("group", "i", "j", "id")
    return found.unionByName(dealt.mapInArrow(_search_groups(least), "node long, centre long"))


def text_keys(text_col: str = "text") -> tuple[Column, Column]:
    """The two hashes by which texts are told apart."""
    return F.xxhash64(F.col(text_col)), F.xxhash64(F.lit(1), F.col(text_col))


def _searched(docs: DataFrame, id_col: str, text_col: str, width: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(id, n, s1, s2, k1, k2) of each row, and (s1, s2, centre, least_id) of each distinct set, with the class that stands for its component."""
    spark = docs.sparkSession
    text_batches(spark)
    k1, k2 = text_keys(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), k1.alias("k1"), k2.alias("k2"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = parts_for(spark)
    routes = _routes(spark, parts)
    subs = max(1, -(-total // (RANGE_BYTES * parts)))

    def texts(batches):
        for batch in batches:
            names, column = list(zip(*(batch.column(c).to_pylist() for c in ("id", "k1", "k2")), strict=True)), batch.column("text")
            for k in range(0, len(names), 256):
                yield from zip(names[k : k + 256], shingle_sets([t or "" for t in column.slice(k, 256).to_pylist()], width), strict=True)

    told = materialise(_counted(rows.mapInArrow(lambda b: _pack(texts(b), routes), _PACKED), routes, subs, _told, _TOLD, False), "told")
    classes = told.where("n > 0").groupBy("s1", "s2").agg(F.min("id").alias("least_id"), F.max("n").alias("n"), F.max("shared").alias("shared"), F.min(F.struct("k1", "k2")).alias("k"))
    classes = materialise(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    able = small(materialise(classes.where(F.col("shared") * 100 >= F.col("n") * least).select("class", F.col("k.k1").alias("k1"), F.col("k.k2").alias("k2")), "able"))

    def stored(batches):
        for batch in batches:
            ids = batch.column("class").to_pylist()
            for k in range(0, len(ids), 256):
                sets = shingle_sets([t or "" for t in batch.column("text").slice(k, 256).to_pylist()], width)
                yield pa.RecordBatch.from_arrays([pa.array(ids[k : k + 256], pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64())], ["id", "shingles", "n"])
        tidy()

    # one text of each class; copies are put together before the shuffle
    texts_of = rows.join(able, ["k1", "k2"]).groupBy("class").agg(F.first("text").alias("text"))
    held = materialise(texts_of.mapInArrow(stored, "id long, shingles binary, n long"), "shingles")
    n_held = held.count()

    def recounted(last, schema: str, tokens: bool) -> DataFrame:
        bytes_of = (held.agg(F.sum("n")).first()[0] or 0) * 6  # of text, about
        return _counted(held.mapInArrow(lambda b: _pack(_stored(b), routes), _PACKED), routes, max(1, -(-bytes_of // (RANGE_BYTES * parts))), last, schema, tokens)

    while n_held:
        left = materialise(recounted(_told, _TOLD, False).where(F.col("shared") * 100 >= F.col("n") * least).select("id"), "left")
        n_left = left.count()
        if n_left < n_held:
            held = materialise(held.join(left, "id", "left_semi"), "shingles")
        if n_left >= 0.9 * n_held:
            break
        n_held = n_left
    first = materialise(_first_search(held, parts, least), "first-links")
    settled = components(first, "node", "centre")
    settled = materialise(settled.select(F.col("node").alias("id"), F.col("centre").alias("part")).unionByName(settled.select(F.col("centre").alias("id"), F.col("centre").alias("part")).distinct()), "settled")
    second = _second_search(held, recounted(_rare(least), _RARE, True), settled, parts, least)
    links = materialise(settled.select(F.col("id").alias("node"), F.col("part").alias("centre")).where("node <> centre").unionByName(second), "links")
    joined = components(links, "node", "centre")
    named = classes.select("class", "s1", "s2", "least_id").join(joined.select(F.col("node").alias("class"), "centre"), "class", "left")
    return told, materialise(named.select("s1", "s2", "least_id", F.coalesce("centre", "class").alias("centre")), "named")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """(id, n_shingles, component_id) for each row of docs: components of links of least percent Jaccard overlap."""
    told, named = _searched(docs, id_col, text_col, width, least)
    # smallest document id of each component, then of each row
    least_of = named.groupBy("centre").agg(F.min("least_id").alias("component_id"))
    of_set = materialise(named.join(least_of, "centre").select("s1", "s2", "component_id"), "components")
    alone = told.where("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return told.where("n > 0").join(of_set, ["s1", "s2"]).select("id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


def shared_components(docs: DataFrame, text_col: str = "text", width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """(k1, k2, component) of the distinct texts, by text_keys, whose component has more than one text."""
    told, named = _searched(docs.select(F.lit(0).alias("id"), text_col), "id", text_col, width, least)
    texts = told.where("n > 0").select("s1", "s2", "k1", "k2").distinct().join(named.select("s1", "s2", F.col("centre").alias("component")), ["s1", "s2"])
    texts = materialise(texts.select("k1", "k2", "component"), "text-components")
    several = small(materialise(texts.groupBy("component").count().where("count > 1").select("component"), "several"))
    return texts.join(several, "component", "left_semi").select("k1", "k2", "component")


def op8_ngram_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_groups(docs).withColumnRenamed("id", "doc_id")


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, md5_number(array_to_string(list_slice(w, i, i + 4), ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (
  SELECT a, min(b) AS component_id FROM r GROUP BY a
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component_id, w.doc_id) AS component_id FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.a = w.doc_id
"""
