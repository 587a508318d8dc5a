"""Near-duplicate groups by a parity-sketch join on word n-gram sets.

A document's set holds its distinct n-grams of words (``n`` of them; fewer words make one n-gram). Texts with equal sets form one
class. A class's sketch is a sparse bit vector: each n-gram flips one bit, so two sketches differ in at most as many bits as
the sets differ in elements. Sets with Jaccard similarity of at least t differ in at most T = (1-t)/(1+t) * (|A|+|B|) elements.

Size bands grow by BAND; a pair belongs to the band of its larger set, so a class joins in its own band and, if a partner may be
that large, in the next. In a band with threshold T the sketch is cut into K = T+1+E blocks; a linked pair agrees in E+1 blocks at
least. A block is joined by a 64-bit code of its bits (the XOR of a code for each set bit). Codes are dealt out packed, by range.

1. Every class's codes are met with all others'. A class with fewer than E+1 blocks that any other class has is linked with none and leaves.
2. The classes left are joined again. A bucket (classes that share a block) isn't expanded to pairs: its members are paired with one pivot,
   the one with the fewest rare n-grams, which in a family of edited copies is near the original. Pairs that agree in E+1 blocks are verified
   on their texts.
3. Two members of a pivot's buckets may still be linked where one lies outside the pivot's component. Such pairs are kept only where they lie in different components
   and their dense parity sketches' Hamming distance leaves a link possible, and are verified too. A pivot's members are dealt into squares of ``SIDE`` by
   ``SIDE`` members, so no task compares those of a whole family.

Codes are dealt to as many partitions as the session has; a partition of more than ``BIN_BYTES`` of codes is split further and goes through memory bin by bin.

Links, components and sets stay on the executors; what is broadcast is the table of n-gram frequencies, of fixed size, and tables of checked size.

Defined results: a null or empty text has no n-grams, is linked with nothing and is its own component; repeated rows each
get a row and link with each other by their text; rows with a null id get a row and make no links of their own; an empty table gives no rows; other columns aren't read,
whatever their names. ``representatives`` keeps all columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .shared import free, looked_up, quoted, row_digest, staged, tidy, width
from .words import SPACED, buffers, grams, mix, slices, word_hashes

SHINGLE, PERCENT, BAND = 5, 80, 1.6
#: Counters of n-gram frequencies, and in how many parts they travel.
COUNTERS, PARTS = 1 << 18, 16
_SHIFT = np.uint64(64 - 18)
#: Text whose codes are packed together, and bytes of codes that are sorted together.
PACK_BYTES, BIN_BYTES = 8 << 20, 10 << 20
#: Bins at least, so small tables are dealt out too.
FEWEST_BINS = 12
#: Members verified against one text by one task at most; members of a family whose sketches one task compares with as many others.
FAN, SIDE = 256, 256
#: Ids in a broadcast semi-join; more are joined by a shuffle.
SEMI_IDS = 1_000_000


def shingles(raw: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct n-grams of each text, one text after another, and where each text's begin."""
    words, ptr = word_hashes(raw, at, SPACED)
    g = grams(words, n)
    count = np.diff(ptr)
    size = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    out_ptr = np.concatenate([[0], np.cumsum(size)])
    take = np.arange(out_ptr[-1]) + np.repeat(ptr[:-1] - out_ptr[:-1], size)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(g):
        out = g[np.minimum(take, len(g) - 1)]
    else:
        out = np.zeros(len(take), np.uint64)
    for r in short.tolist():
        out[out_ptr[r]] = grams(words[ptr[r] : ptr[r + 1]], int(count[r]))[0] ^ np.uint64(count[r])
    keep = np.ones(len(out), bool)
    for a, b in zip(out_ptr[:-1].tolist(), out_ptr[1:].tolist(), strict=True):
        out[a:b].sort()
    if len(out):
        keep[1:] = out[1:] != out[:-1]
        keep[out_ptr[:-1][size > 0]] = True
    return out[keep], np.concatenate([[0], np.cumsum(keep)])[out_ptr]


def _sum(x: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
    return c[ptr[1:]] - c[ptr[:-1]]


def _identity(tok: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of each set."""
    return mix(_sum(mix(tok), ptr) ^ np.diff(ptr).astype(np.uint64)).view(np.int64), mix(_sum(mix(tok ^ np.uint64(0xA5A5A5A5A5A5A5A5)), ptr)).view(np.int64)


def band_table(percent: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the bands begin, and the greatest difference of two sets that lie below each band's end."""
    starts = [1]
    while starts[-1] <= most:
        starts.append(max(starts[-1] + 1, int(starts[-1] * BAND)))
    top = np.array(starts[1:] + [int(starts[-1] * BAND) + 1]) - 1
    return np.array(starts), (2 * top * (100 - percent)) // (100 + percent)


def spare(differ: np.ndarray) -> np.ndarray:
    """E of each band: how many blocks more than T + 1 there are."""
    return (differ + 1) // 2


def sketch_keys(tok: np.ndarray, ptr: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, band, least, key) of every block of every class, in its own band and where needed in the next.

    Blocks without bits would meet in all classes, so a class leaves them out: of E+1 blocks that it shares with a linked one, as many as it has
    empty ones may be missing, and at least ``least`` are met. A class with more than E empty blocks keeps them.
    """
    n = np.diff(ptr)
    starts, differ = band_table(percent, int(n.max(initial=1)) * 100 // percent + 1)
    own = np.searchsorted(starts, n, "right") - 1
    reach = np.searchsorted(starts, n * 100 // percent, "right") - 1
    rows, bands, leasts, keys = [], [], [], []
    for step in (0, 1):
        use = (n > 0) & (own + step <= reach)
        if not use.any():
            continue
        row = np.repeat(np.flatnonzero(use), n[use])
        x = tok[np.repeat(use, n)]
        band = own + step
        t = differ[np.maximum(band, 0)]
        blocks = np.where(use, t + 1 + spare(t), 0)
        base = np.concatenate([[0], np.cumsum(blocks)])
        deal = mix(x + np.uint64(0x51ED270B) * (band[row] + 1).astype(np.uint64))
        block = base[row] + (((deal >> np.uint64(32)) * blocks[row].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        block = block[order]
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        code = np.zeros(base[-1], np.uint64)
        code[block[first]] = np.bitwise_xor.reduceat(deal[order], first)
        of = np.repeat(np.arange(len(n)), blocks)
        number = np.arange(base[-1]) - base[of]
        empty = np.ones(base[-1], bool)
        empty[block[first]] = False
        gone = np.bincount(of[empty], minlength=len(n))
        keep = ~empty | (gone > spare(t))[of]
        of, number = of[keep], number[keep]
        rows.append(of)
        bands.append(band[of])
        leasts.append(np.maximum(1, spare(t) + 1 - gone)[of])
        keys.append(mix(code[keep] + mix((number * 64 + band[of]).astype(np.uint64))))
    if not rows:
        return *[np.zeros(0, np.int64)] * 3, np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(bands), np.concatenate(leasts), np.concatenate(keys)


def dense_sketch(tok: np.ndarray, ptr: np.ndarray) -> list[bytes]:
    """Each set's parity sketch, of a width by its size: 1,024 bits, 8,192 or 65,536."""
    out = []
    for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True):
        width_ = 1024 if b - a <= 1500 else 8192 if b - a <= 12_000 else 65_536
        odd = np.bincount((mix(tok[a:b]) % np.uint64(width_)).astype(np.int64), minlength=width_) & 1
        out.append(np.packbits(odd.astype(np.uint8)).tobytes())
    return out


def _profile(docs: DataFrame, n: int) -> DataFrame:
    """(id, n, s1, s2) of each row, and rows (part, counts) with the frequencies of its task's n-grams."""
    kind = dict(docs.dtypes)["i"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["i", "n", "s1", "s2", "part", "counts"]
        freq, type_i = np.zeros(COUNTERS, np.uint32), None
        for b in batches:
            raw, at = buffers(b.column("t"))
            type_i, done = b.column("i").type, []
            for lo, hi in slices(at):
                tok, ptr = shingles(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], n)
                freq += np.bincount((tok >> _SHIFT).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
                done.append((np.diff(ptr), *_identity(tok, ptr)))
            m = b.num_rows
            cols = [np.concatenate(x) for x in zip(*done, strict=True)] if done else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([b.column("i"), *(pa.array(x, pa.int64()) for x in cols), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
        if type_i is not None:
            parts = [x.tobytes() for x in np.split(freq, PARTS)]
            yield pa.RecordBatch.from_arrays([pa.nulls(PARTS, type_i), *[pa.nulls(PARTS, pa.int64())] * 3, pa.array(range(PARTS), pa.int32()), pa.array(parts, pa.binary())], names)

    return docs.mapInArrow(tidy(run), f"i {kind}, n bigint, s1 bigint, s2 bigint, part int, counts binary")


def _frequencies(parts: DataFrame) -> np.ndarray:
    """The sums of all tasks' counters as small classes of frequency: powers of two beyond what chance collisions give."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for p, c in zip(b.column("part").to_pylist(), b.column("counts").to_pylist(), strict=True):
                x = np.frombuffer(c, np.uint32).astype(np.int64) if len(c) == 4 * COUNTERS // PARTS else np.frombuffer(c, np.int64)
                sums[p] = sums[p] + x if p in sums else x.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "counts"])

    kind = "part int, counts binary"
    total = np.zeros(COUNTERS, np.int64)
    for r in parts.select("part", "counts").coalesce(max(1, width(parts.sparkSession))).mapInArrow(tidy(add), kind).repartition(PARTS, "part").mapInArrow(tidy(add), kind).collect():
        total[r.part * COUNTERS // PARTS : (r.part + 1) * COUNTERS // PARTS] = np.frombuffer(r.counts, np.int64)
    usual = float(np.median(total))
    above = np.maximum(total - usual, np.sqrt(usual + 1) * 2 + 2)
    return np.log2(above).astype(np.uint64)


def _keys(docs: DataFrame, freq: np.ndarray, n: int, percent: int, bins: int) -> DataFrame:
    """Join codes, packed by range: for each class of a batch its digest, rareness, band and number of codes, then the codes (40 bits beside the range)."""
    sent = docs.sparkSession.sparkContext.broadcast(freq.astype(np.uint8).tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(sent.value, np.uint8)
        rare = int(table.min())
        seen: np.ndarray = np.zeros(0, np.int64)

        def packed(raw: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal seen
            parts: list[list[np.ndarray]] = [[] for _ in range(6)]
            base = 0
            for lo, hi in slices(at):
                tok, ptr = shingles(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], n)
                sid = _identity(tok, ptr)[0]
                size = np.diff(ptr)
                new = np.zeros(len(sid), bool)
                new[np.unique(sid, return_index=True)[1]] = True
                new &= ~np.isin(sid, seen) & (size > 0)
                seen = np.concatenate([seen, sid[new]])[-20_000:]  # copies met lately need no second set of codes
                tok = tok[np.repeat(new, size)]
                size = size[new]
                ptr = np.concatenate([[0], np.cumsum(size)])
                odd = np.concatenate([[0], np.cumsum(table[(tok >> _SHIFT).astype(np.int64)] == rare)])[ptr]
                row, band, least, key = sketch_keys(tok, ptr, percent)
                for p, x in zip(parts, (sid[new], np.diff(odd) * 255 // np.maximum(size, 1), row + base, band, least, key), strict=True):
                    p.append(x)
                base += len(size)
            if not base:
                return
            sid, odd, row, band, least, key = map(np.concatenate, parts)
            bin_ = ((key >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
            order = np.lexsort((band, row, bin_))
            bin_, row, band, least, key = bin_[order], row[order], band[order], least[order], key[order]
            new_bin = np.concatenate([[True], bin_[1:] != bin_[:-1]])
            new_run = new_bin | np.concatenate([[True], (row[1:] != row[:-1]) | (band[1:] != band[:-1])])
            cut, run_ = np.flatnonzero(new_bin), np.flatnonzero(new_run)
            many = np.diff(np.append(run_, len(row)))
            of = np.searchsorted(run_, np.append(cut, len(row)))
            out: list[list] = [[] for _ in range(7)]
            for j, c in enumerate(cut.tolist()):
                a, z = of[j], of[j + 1]
                end = cut[j + 1] if j + 1 < len(cut) else len(row)
                who = row[run_[a:z]]
                packed = (sid[who], odd[who].astype(np.uint8), band[run_[a:z]].astype(np.uint8), least[run_[a:z]].astype(np.uint32), many[a:z].astype(np.uint32), key[c:end].view(np.uint8).reshape(-1, 8)[:, :5])
                for x, y in zip(out, (int(bin_[c]), *(v.tobytes() for v in packed)), strict=True):
                    x.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])], ["bin", "sid", "odd", "band", "least", "many", "keys"])

        for whole in batches:
            raw, at = buffers(whole.column("t"))
            for part_lo, part_hi in slices(at, PACK_BYTES):
                yield from packed(raw[at[part_lo] : at[part_hi]], at[part_lo : part_hi + 1] - at[part_lo])

    return docs.mapInArrow(tidy(run), _PACKED)


_PACKED = "bin int, sid binary, odd binary, band binary, least binary, many binary, keys binary"
_TYPES = (np.int64, np.uint8, np.uint8, np.uint32, np.uint32, np.uint8)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, sid, band, least) of the blocks that two or more classes share, sorted by key and then by the pivot's order. Rows come bin by bin."""
    number, held = None, []
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if r[0] != number:
                if held:
                    yield from _met_in(held)
                number, held = r[0], []
            held.append(r[1:])
    if held:
        yield from _met_in(held)


def _met_in(rows: list[tuple]) -> Iterator[tuple[np.ndarray, ...]]:
    sid, odd, band, least, many, five = (np.frombuffer(b"".join(x), t) for x, t in zip(zip(*rows, strict=True), _TYPES, strict=True))
    rows.clear()
    wide = np.zeros((len(five) // 5, 8), np.uint8)
    wide[:, :5] = five.reshape(-1, 5)
    key = wide.view(np.uint64).ravel()
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = key[1:] == key[:-1]
    held = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(key) else np.zeros(0, bool)
    order, key = order[held], key[held]
    if not len(key):
        return
    who = np.repeat(np.arange(len(sid)), many)[order]
    order = np.lexsort((sid[who], odd[who], key))
    key, who = key[order], who[order]
    once = np.concatenate([[True], (key[1:] != key[:-1]) | (sid[who][1:] != sid[who][:-1])])
    key, who = key[once], who[once]
    same = key[1:] == key[:-1]
    held = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    key, who = key[held], who[held]
    if len(key):
        yield key, sid[who], band[who].astype(np.int64), least[who].astype(np.int64)


def _split(batches: Iterator[pa.RecordBatch], subs: int) -> Iterator[pa.RecordBatch]:
    """Packed rows of a partition as rows of ``subs`` bins, by the codes themselves."""
    names = [x.split()[0] for x in _PACKED.split(", ")]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        sid, odd, band, least, many, five = (np.frombuffer(b"".join(x), t) for x, t in zip(zip(*rows, strict=True), _TYPES, strict=True))
        five = five.reshape(-1, 5)
        low = np.ascontiguousarray(five[:, :4]).view(np.uint32).ravel().astype(np.uint64)
        sub = (low * np.uint64(subs) >> np.uint64(32)).astype(np.int64)
        who = np.repeat(np.arange(len(sid)), many)
        order = np.lexsort((who, sub))
        sub, who, five = sub[order], who[order], five[order]
        run = np.flatnonzero(np.concatenate([[True], (sub[1:] != sub[:-1]) | (who[1:] != who[:-1])]))
        each = np.diff(np.append(run, len(sub))).astype(np.uint32)
        bins, first = np.unique(sub[run], return_index=True)
        cut = np.append(first, len(run))
        ends = np.append(run, len(sub))
        cols: list[list] = [[] for _ in names]
        for n, a, z in zip(bins.tolist(), cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            own = who[run[a:z]]
            for c, x in zip(cols, (n, *(v.tobytes() for v in (sid[own], odd[own], band[own], least[own], each[a:z], five[ends[a] : ends[z]]))), strict=True):
                c.append(x)
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names)

    rows, size = [], 0
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
            rows.append(r[1:])
            size += len(r[6])
            if size >= 2 * BIN_BYTES:
                yield out(rows)
                rows, size = [], 0
    if rows:
        yield out(rows)


def _tallied(cols: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """Distinct rows of the columns, and how often each occurs."""
    order = np.lexsort(cols[::-1])
    cols = [c[order] for c in cols]
    first = np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in cols], axis=0)]))
    return pa.RecordBatch.from_arrays([*(pa.array(c[first], pa.int64()) for c in cols), pa.array(np.diff(np.append(first, len(cols[0]))), pa.int64())], [*names, "n"])


def _dealt(packed: DataFrame, bins: tuple[int, int]) -> DataFrame:
    """Packed codes, a partition for each bin; where a partition holds several bins' worth, its rows are split and sorted by bin (which spills, if need be)."""
    parts, subs = bins
    out = packed.repartitionById(parts, F.col("bin"))
    return out if subs == 1 else out.mapInArrow(lambda batches: _split(batches, subs), _PACKED).sortWithinPartitions("bin")


def _shared_blocks(packed: DataFrame, bins: tuple[int, int]) -> DataFrame:
    """(sid): classes that share enough blocks with others to be linked with one."""

    parts = bins[0]
    kinds = (np.int64, np.uint8, np.uint32, np.uint32)

    def tally(cols: tuple[np.ndarray, ...], n: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.lexsort(cols[::-1])
        cols = tuple(c[order] for c in cols)
        first = np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in cols], axis=0)]))
        return *(c[first] for c in cols), np.add.reduceat(n[order], first)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sid, band, least in _met(batches):
            to = (mix(sid.view(np.uint64).copy()) % np.uint64(parts)).astype(np.int64)
            to, *cols = tally((to, sid, band, least), np.ones(len(sid), np.int64))
            cut = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            rows = [[c[x:y].astype(k).tobytes() for x, y in zip(cut, [*cut[1:], len(to)], strict=True)] for c, k in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(to[cut], pa.int32()), *(pa.array(r, pa.binary()) for r in rows)], ["bin", "sid", "band", "least", "n"])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[] for _ in kinds]
        for b in batches:
            for h, c in zip(held, b.columns[1:], strict=True):
                h += c.to_pylist()
        sid, band, least, n = (np.frombuffer(b"".join(h), k) for h, k in zip(held, kinds, strict=True))
        if len(sid):
            sid, _, least, n = tally((sid, band, least), n.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(sid[n >= least]), pa.int64())], ["sid"])

    # a task's tallies travel packed, by the class's hash
    met = _dealt(packed, bins).mapInArrow(tidy(count), "bin int, sid binary, band binary, least binary, n binary")
    return met.repartitionById(parts, F.col("bin")).mapInArrow(tidy(pick), "sid bigint")


def _pivot_edges(packed: DataFrame, bins: tuple[int, int]) -> DataFrame:
    """(a, b, maybe): members b of buckets with pivot a, and whether they share enough blocks to be linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, sid, band, least in _met(batches):
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            head = np.repeat(first, np.diff(np.append(first, len(key))))
            rest = np.arange(len(key)) != head
            yield _tallied([sid[head][rest], sid[rest], band[rest], np.maximum(least[head], least)[rest]], ["a", "b", "band", "least"])

    met = _dealt(packed, bins).mapInArrow(tidy(run), "a bigint, b bigint, band bigint, least bigint, n bigint")
    pairs = met.groupBy("a", "b", "band", "least").agg(F.sum("n").alias("n"))
    return pairs.groupBy("a", "b").agg(F.max(F.col("n") >= F.col("least")).alias("maybe"))


def _sketched(rows: DataFrame, n: int) -> DataFrame:
    """(sid, size, bits) of each row's class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, at = buffers(b.column("t"))
            for lo, hi in slices(at):
                tok, ptr = shingles(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], n)
                bits = [np.frombuffer(x, ">i8").tolist() for x in dense_sketch(tok, ptr)]
                yield pa.RecordBatch.from_arrays([pa.array(_identity(tok, ptr)[0], pa.int64()), pa.array(np.diff(ptr), pa.int64()), pa.array(bits, pa.list_(pa.int64()))], ["sid", "size", "bits"])

    return rows.mapInArrow(tidy(run), "sid bigint, size bigint, bits array<bigint>")


def _texts(docs: DataFrame, classes: DataFrame, used: DataFrame, n: int) -> DataFrame:
    """(s1, t): the text of one document of each class in ``used`` (s1). Other texts with that document's id are left out by their own digest."""
    wanted = staged(used.join(classes, "s1").select("s1", "rep"))
    few = wanted.count() <= SEMI_IDS

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, at = buffers(b.column("t"))
            s1 = b.column("s1").to_numpy(zero_copy_only=False)
            keep = [_identity(*shingles(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], n))[0] == s1[lo:hi] for lo, hi in slices(at)]
            yield b.filter(pa.array(np.concatenate(keep) if keep else np.zeros(0, bool)))

    return docs.join(F.broadcast(wanted) if few else wanted, docs["i"] == wanted["rep"]).select("s1", "t").mapInArrow(tidy(own), "s1 bigint, t string")


def _verified(edges: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """(a, b, shared, n_a, n_b) of each edge, counted on the classes' texts (s1, t)."""
    load = edges.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / FAN).cast("int").alias("salts"))
    centre = texts.withColumnRenamed("s1", "a").join(load, "a").select("a", F.explode(F.expr("sequence(0, salts - 1)")).alias("salt"), F.lit(None).cast("bigint").alias("b"), "t")
    dealt = edges.join(load, "a").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), "b")
    member = dealt.join(texts.withColumnRenamed("s1", "b"), "b").select("a", "salt", "b", "t")
    parts = width(edges.sparkSession)
    both = centre.unionByName(member).repartition(parts, "a", "salt").sortWithinPartitions("a", "salt", F.col("b").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, mine, last = None, None, None
        for rows in batches:
            raw, at = buffers(rows.column("t"))
            a, salt, b = (rows.column(c).to_pylist() for c in ("a", "salt", "b"))
            out: list[tuple] = []
            for lo, hi in slices(at):
                tok, ptr = shingles(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], n)
                for r in range(lo, hi):
                    x = tok[ptr[r - lo] : ptr[r - lo + 1]]
                    if b[r] is None:
                        key, mine, last = (a[r], salt[r]), x.copy(), None
                    elif key == (a[r], salt[r]) and last != b[r]:
                        last = b[r]
                        at_ = np.minimum(np.searchsorted(mine, x), len(mine) - 1) if len(mine) else np.zeros(0, np.int64)
                        out.append((a[r], b[r], int((mine[at_] == x).sum()) if len(mine) else 0, len(mine), len(x)))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", "shared", "n_a", "n_b"])

    return both.mapInArrow(tidy(run), "a bigint, b bigint, shared bigint, n_a bigint, n_b bigint")


def _linked(percent: int):
    return F.expr(f"100 * shared >= {percent} * (n_a + n_b - shared)")


def _residual(edges: DataFrame, links: DataFrame, sketches: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of members of one pivot that lie in different components and whose sketches leave a link possible.

    Members in the pivot's own component need no pairs among each other, so each pair has a member (x) outside it. For each pivot x and all members (y)
    are dealt into squares: a member is repeated once for each ``SIDE`` of the others.
    """
    rows = staged(edges.select("a", "b").join(links.withColumn("on", F.lit(True)), ["a", "b"], "left").join(sketches.toDF("b", "size", "bits"), "b").join(label.toDF("b", "label"), "b"))
    # the pivot's label is known without a join on it: a member that it is linked with has it, and otherwise the pivot is alone
    of = rows.select("a").distinct().join(label.toDF("a", "own"), "a")
    told = staged(looked_up(rows, of, ["a"]).withColumn("out", F.col("label") != F.col("own")))
    load = told.groupBy("a").agg(F.sum(F.col("out").cast("long")).alias("n_x"), F.count(F.lit(1)).alias("n_y")).where("n_x > 0")
    load = staged(load.selectExpr("a", f"cast(ceil(n_x / {SIDE}) as int) as by_x", f"cast(ceil(n_y / {SIDE}) as int) as by_y"))
    told = staged(looked_up(told, load, ["a"]))
    deal_x, deal_y = F.pmod(F.xxhash64("b"), F.col("by_x")).cast("int"), F.pmod(F.xxhash64("b", F.lit(1)), F.col("by_y")).cast("int")
    x = told.where("out").select("a", deal_x.alias("at_x"), F.explode(F.expr("sequence(0, by_y - 1)")).alias("at_y"), *(F.col(c).alias(f"{c}_x") for c in ("b", "size", "bits", "label")))
    y = told.select("a", F.explode(F.expr("sequence(0, by_x - 1)")).alias("at_x"), deal_y.alias("at_y"), *(F.col(c).alias(f"{c}_y") for c in ("b", "size", "bits", "label", "out")))
    apart = F.aggregate(F.zip_with("bits_x", "bits_y", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)
    most = F.expr(f"(size_x + size_y) * {100 - percent} div {100 + percent}")
    # the first 1,024 bits bound the distance too, in compiled code; the rest only of large sets
    begun = F.expr(" + ".join(f"bit_count(element_at(bits_x, {k}) ^ element_at(bits_y, {k}))" for k in range(1, 17)))
    near = F.expr(f"100 * least(size_x, size_y) >= {percent} * greatest(size_x, size_y)") & ((F.size("bits_x") != F.size("bits_y")) | ((begun <= most) & ((F.size("bits_x") == 16) | (apart <= most))))
    other = (F.col("label_x") != F.col("label_y")) & (~F.col("out_y") | (F.col("b_x") < F.col("b_y")))
    same = (x["a"] == y["a"]) & (x["at_x"] == y["at_x"]) & (x["at_y"] == y["at_y"])
    return x.join(y, same & other & near).select(F.least("b_x", "b_y").alias("a"), F.greatest("b_x", "b_y").alias("b")).distinct()


def bins_for(grams: int | None, spark: SparkSession) -> tuple[int, int]:
    """(partitions, bins in each) for the codes of classes with so many n-grams in all: about 0.7 codes an n-gram, of 6 bytes or more."""
    need = max(FEWEST_BINS, (grams or 0) * 4 // BIN_BYTES)
    parts = min(need, max(4, width(spark)))
    return parts, -(-need // parts)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) of each row: the least id that links of at least ``percent`` reach from it."""
    spark = docs.sparkSession
    rows = docs.select(F.col(quoted(id_col)).alias("i"), F.col(quoted(text_col)).alias("t"))
    noted = staged(_profile(rows, n))
    profile = noted.where("part is null").select("i", "n", "s1", "s2")
    freq = _frequencies(noted.where("part is not null"))
    classes = staged(profile.where("n > 0 and i is not null").groupBy("s1", "s2", "n").agg(F.min("i").alias("rep")))
    bins = bins_for(profile.agg(F.sum("n")).first()[0], spark)
    alive = staged(_shared_blocks(_keys(rows, freq, n, percent, bins[0]), bins).toDF("s1"))
    # few classes are left, and a pair's tallies go into fewer rows where its blocks lie in fewer bins
    bins = bins_for(classes.join(F.broadcast(alive) if alive.count() <= SEMI_IDS else alive, "s1", "left_semi").agg(F.sum("n")).first()[0], spark)
    some = staged(_texts(rows, classes, alive, n).withColumnRenamed("s1", "i"))
    # without the classes that left, others have fewer shared blocks
    alive = _shared_blocks(_keys(some, freq, n, percent, bins[0]), bins).toDF("i")
    some = staged(some.join(alive, "i", "left_semi"))
    edges = staged(_pivot_edges(_keys(some, freq, n, percent, bins[0]), bins))
    likely = edges.where("maybe").select("a", "b")
    used = staged(likely.select("a").union(likely.select("b")).distinct().toDF("s1"))
    checked = staged(_verified(likely, some.withColumnRenamed("i", "s1").join(F.broadcast(used) if used.count() <= SEMI_IDS else used, "s1", "left_semi"), n))
    member = classes.select("s1", "rep")

    def grown(links: DataFrame) -> DataFrame:
        named = links.join(member.toDF("a", "ra"), "a").join(member.toDF("b", "rb"), "b")
        return components(named.select(F.col("ra").alias("a"), F.col("rb").alias("b")))

    links = checked.where(_linked(percent)).select("a", "b")
    groups = grown(links)
    label = member.join(groups.toDF("rep", "label"), "rep", "left").select("s1", F.coalesce("label", "rep").alias("label"))
    left = _residual(edges, links, _sketched(some, n), label, percent)
    done = edges.where("maybe").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = staged(left.join(done, ["a", "b"], "left_anti"))
    if left.limit(1).count():
        more = staged(_verified(left, _texts(rows, classes, left.select("a").union(left.select("b")).distinct().toDF("s1"), n), n))
        links = links.union(more.where(_linked(percent)).select("a", "b"))
        groups = grown(links)
    ids = staged(classes.join(groups.toDF("rep", "label"), "rep", "left").select("s1", "s2", "n", F.coalesce("label", "rep").alias("component_id")))
    some_words = looked_up(profile.where("n > 0"), ids, ["s1", "s2", "n"], "left")
    out = some_words.select("i", "n", "component_id").unionByName(profile.where("n = 0").select("i", "n", F.col("i").alias("component_id")))
    return out.select(F.col("i").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "i").alias("component_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the least id; ids that aren't null come first.

    Rows are told apart by id and text, so rows that share an id, or have none, are judged by their own texts. Of rows with the same id and
    text one stays (any; their other columns may differ). Rows without words are no copies and all stay.
    """
    (key,) = free(docs.columns, "key")
    id_, text = F.col(quoted(id_col)), F.col(quoted(text_col))
    keyed = docs.withColumn(key, F.struct(id_.isNull().alias("none"), id_.alias("id"), row_digest(id_, text).alias("digest")))
    found = near_duplicates(keyed.select(F.col(key).alias("k"), text.alias("t")), "k", "t", n, percent)
    groups = staged(found.where("n_shingles > 0").groupBy("k", "component_id").agg(F.count(F.lit(1)).alias("rows")).withColumnRenamed("k", key))
    # tables of keys only
    gone = groups.where(F.col(key) != F.col("component_id")).select(key)
    repeated = groups.where((F.col(key) == F.col("component_id")) & (F.col("rows") > 1)).select(key)

    def met(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return rows.join(F.broadcast(keys) if keys.count() <= SEMI_IDS else keys, key, how)

    kept = met(keyed, gone, "left_anti")
    if repeated.limit(1).count():
        kept = met(kept, repeated, "left_anti").unionByName(met(kept, repeated, "left_semi").dropDuplicates([key]))
    return kept.select(*map(quoted, docs.columns))
