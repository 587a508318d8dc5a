"""Benchmark decontamination by winnowing.

Words are the lower-cased runs of digits, letters and characters beyond ASCII. A window is ``window`` consecutive
words of a benchmark item; an item of fewer words is one window as a whole. Winnowing keeps, of each ``window``
consecutive words, the k-gram with the least hash: a passage of that length has the same least k-gram in a document and
in an item, so the join of the kept fingerprints misses none. Each joined fingerprint is then extended to every window
that contains it, and a window counts where its words are those of an item's window: hashes propose, words decide.

A benchmark of at most ``block_bytes`` of text is broadcast as one index, and documents are read once, unshuffled. A larger one stays on the executors: a table of
bits of fixed size (``FILTER_BITS``) with the benchmark's fingerprints and windows is broadcast instead, documents are read once against it, and only the windows
that it lets through are joined with the benchmark's, by their words. Neither way copies the documents.

Defined results: a null or empty text has no words, no hits and no items; items without words and null items
never match; items with a null id hit words as others do, and count together as one item without a name; repeated items count by their id once; repeated documents give a row each,
also where they share an id; empty tables give no rows and no hits; other columns of either table aren't read, whatever their names, and ``clean`` keeps those of documents.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import filtered, free, looked_up, quoted, row_digest, staged, tidy
from .words import ALNUM, buffers, gram_rows, grams, mix, place_hashes, slices, word_places

WINDOW, KGRAM, BLOCK_BYTES, FILTER_BITS = 10, 5, 16 << 20, 1 << 28
#: Rows of a broadcast anti-join; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _named(items: set[str | None]) -> list[str | None]:
    """In order, the item without an id first."""
    return sorted(items, key=lambda i: (i is not None, i or ""))


def _winnow(h: np.ndarray, inside: np.ndarray, span: int) -> np.ndarray:
    """Which k-grams are the least of some ``span`` consecutive ones of one text."""
    n = len(h) - span + 1
    keep = np.zeros(len(h), bool)
    if n <= 0:
        return keep
    low = h[:n].copy()
    for j in range(1, span):
        np.minimum(low, h[j : j + n], out=low)
    for j in range(span):
        keep[j : j + n] |= (h[j : j + n] == low) & inside
    return keep


class Words:
    """The words of some texts: hashes, and their lower-cased bytes for comparing."""

    def __init__(self, raw: np.ndarray, at: np.ndarray):
        self.first, self.end, self.ptr = word_places(raw, at, ALNUM)
        self.hashes = place_hashes(raw, self.first, self.end, ALNUM) if len(self.first) else np.zeros(0, np.uint64)
        self.row = np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))
        self._raw, self._low = raw, None

    def phrase(self, start: int, n: int) -> bytes:
        """``n`` words from one on, with blanks between."""
        if self._low is None:
            self._low = _LOWER[self._raw].tobytes()
        return b" ".join([self._low[a:z] for a, z in zip(self.first[start : start + n].tolist(), self.end[start : start + n].tolist(), strict=True)])

    def windows(self, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes of the windows from each word on, which of these lie in one text, which k-grams winnowing keeps)."""
        g = grams(self.hashes, window)
        ok = gram_rows(self.ptr, window, len(g))[1]
        return g, ok, _winnow(grams(self.hashes, k), ok, window - k + 1)

    def near(self, kept: np.ndarray, ok: np.ndarray, window: int, k: int) -> np.ndarray:
        """The windows that contain some of the kept k-grams."""
        at = (kept[:, None] - np.arange(window - k + 1)[None, :]).ravel()
        at = np.unique(at[(at >= 0) & (at < len(ok))])
        return at[ok[at]]


class Index:
    """Windows of one length by their hash: for each hash the phrases that have it, with their items."""

    def __init__(self, words: Words, starts: np.ndarray, hashes: np.ndarray, n: int, owner: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.n, (self.keys, first) = n, np.unique(hashes[order], return_index=True)
        self.found = [{} for _ in range(len(self.keys))]
        for at, group in enumerate(np.split(order, first[1:]) if len(first) else []):
            for j in group.tolist():
                self.found[at].setdefault(words.phrase(int(starts[j]), n), set()).add(int(owner[j]))

    def __getstate__(self):
        # few large objects: phrases in one piece, items as arrays
        phrases = [p for f in self.found for p in f]
        owners = [o for f in self.found for o in f.values()]
        return self.n, self.keys, np.array([len(f) for f in self.found], np.int32), b"\0".join(phrases), np.array([len(o) for o in owners], np.int32), np.array([i for o in owners for i in sorted(o)], np.int32)

    def __setstate__(self, state):
        self.n, self.keys, self._each, self._phrases, self._many, self._owners = state
        self.found = None

    def of(self, at: int, phrase: bytes) -> list[int]:
        """The items whose window is the phrase, of those with the hash at this place."""
        if self.found is not None:
            return sorted(self.found[at].get(phrase, ()))
        if isinstance(self._phrases, bytes):
            self._phrases = self._phrases.split(b"\0") if len(self._many) else []
            self._from, self._owned = np.concatenate([[0], np.cumsum(self._each)]), np.concatenate([[0], np.cumsum(self._many)])
        for j in range(int(self._from[at]), int(self._from[at + 1])):
            if self._phrases[j] == phrase:
                return self._owners[self._owned[j] : self._owned[j + 1]].tolist()
        return []


class Prints:
    """A benchmark as sorted arrays: kept fingerprints, and windows and short items with the items that have them."""

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW, k: int = KGRAM):
        self.window, self.k = window, k
        self.names = _named({i for i, _ in items})
        number = {i: n for n, i in enumerate(self.names)}
        owner = np.array([number[i] for i, _ in items], np.int64)
        words = Words(*buffers(pa.array([t for _, t in items], pa.large_string())))
        g, ok, kept = words.windows(window, k)
        self.prints = np.unique(grams(words.hashes, k)[kept])
        at = np.flatnonzero(ok)
        self.long = Index(words, at, g[at], window, owner[words.row[at]])
        count = np.diff(words.ptr)
        self.short = []
        for n in np.unique(count[(count > 0) & (count < window)]).tolist():
            rows = np.flatnonzero(count == n)
            self.short.append(Index(words, words.ptr[rows], grams(words.hashes, n)[words.ptr[rows]], n, owner[rows]))


def _find(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of h are among the sorted keys, and where there."""
    if not len(keys) or not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    hit = np.flatnonzero(keys[at] == h)
    return hit, at[hit]


def _scan(p: Prints, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[list, set]]]:
    """Words of each text, and for texts with hits the word intervals and numbers of items."""
    words = Words(raw, at)
    hits: dict[int, tuple[list, set]] = {}

    def note(starts: np.ndarray, found: np.ndarray, index: Index) -> None:
        for s, f in zip(starts.tolist(), found.tolist(), strict=True):
            if who := index.of(f, words.phrase(s, index.n)):
                r = int(words.row[s])
                spans, items = hits.setdefault(r, ([], set()))
                spans.append((s - int(words.ptr[r]), s - int(words.ptr[r]) + index.n))
                items.update(who)

    if len(p.prints) and len(words.hashes) >= p.window:
        g, ok, keep = words.windows(p.window, p.k)
        kept = np.flatnonzero(keep)
        joined, _ = _find(p.prints, grams(words.hashes, p.k)[kept])
        near = words.near(kept[joined], ok, p.window, p.k)
        hit, found = _find(p.long.keys, g[near])
        note(near[hit], found, p.long)
    for index in p.short:
        hit, found = _find(index.keys, grams(words.hashes, index.n))
        inside = words.row[hit] == words.row[hit + index.n - 1]
        note(hit[inside], found[inside], index)
    return np.diff(words.ptr), hits


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _flat(spans: list[tuple[int, int]]) -> list[int]:
    return [x for pair in merged(spans) for x in pair]


def _items(items: DataFrame, item_col: str, item_text: str) -> DataFrame:
    return items.select(F.col(quoted(item_col)).cast("string").alias("i"), F.col(quoted(item_text)).alias("t")).where("t is not null").distinct()


def _whole(items: DataFrame, window: int, k: int, block_bytes: int):
    """The benchmark as one broadcast index, or None if it is larger than that."""
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    if total > block_bytes:
        return None
    return items.sparkSession.sparkContext.broadcast(pickle.dumps(Prints([(r.i, r.t) for r in items.collect()], window, k)))


def _scanned(prints: Prints, column: pa.Array) -> tuple[np.ndarray, list[list[int]], list[list[str | None]]]:
    """(words, spans, items) of each text of a column."""
    raw, at = buffers(column)
    counts, spans, items = [np.zeros(0, np.int64)], [[] for _ in column], [[] for _ in column]
    for lo, hi in slices(at):
        n, hits = _scan(prints, raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
        counts.append(n)
        for r, (s, who) in hits.items():
            spans[lo + r], items[lo + r] = _flat(s), [prints.names[i] for i in sorted(who)]
    return np.concatenate(counts), spans, items


_SALT = np.uint64(0x5851F42D4C957F2D)


def _bits(h: np.ndarray, salt: int) -> np.ndarray:
    return mix(h + np.uint64(salt) * _SALT) % np.uint64(FILTER_BITS)


def _phrases(items: DataFrame, window: int, k: int) -> tuple[DataFrame, list[int], np.ndarray]:
    """The benchmark's windows as (phrase, items), the lengths of windows, and the table of bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, at = buffers(b.column("t"))
            names = b.column("i").to_pylist()
            for lo, hi in slices(at):
                words = Words(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
                g, ok, kept = words.windows(window, k)
                starts = np.flatnonzero(ok)
                out = [(names[lo + r], words.phrase(s, window), window) for s, r in zip(starts.tolist(), words.row[starts].tolist(), strict=True)]
                bits = [_bits(g[starts], window), _bits(grams(words.hashes, k)[kept], 0)]
                for r, n in enumerate(np.diff(words.ptr).tolist()):
                    if 0 < n < window:
                        s = int(words.ptr[r])
                        out.append((names[lo + r], words.phrase(s, n), n))
                        bits.append(_bits(grams(words.hashes[s : s + n], n), n))
                i, phrase, n = zip(*out, strict=True) if out else ((), (), ())
                m, all_ = len(out), np.unique(np.concatenate(bits)).astype(np.int64)
                cols = [pa.concat_arrays([pa.array(x, kind), pa.nulls(len(all_), kind)]) for x, kind in ((i, pa.string()), ([p.decode() for p in phrase], pa.string()), (n, pa.int32()))]
                yield pa.RecordBatch.from_arrays([*cols, pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(all_)])], ["i", "phrase", "n", "bit"])

    rows = staged(items.mapInArrow(tidy(run), "i string, phrase string, n int, bit bigint"))
    lengths = sorted(r.n for r in rows.where("phrase is not null").select("n").distinct().collect())  # as many as there are lengths of windows
    # one 64-bit word of the table for each 64 bits, put together on the executors
    table = np.zeros(FILTER_BITS // 64, np.uint64)
    packed = rows.where("bit is not null").groupBy(F.expr("bit div 64").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("word"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.column("at").to_numpy().astype("<i4").tobytes()]), pa.array([b.column("word").to_numpy().tobytes()])], ["at", "word"])

    for r in packed.mapInArrow(pack, "at binary, word binary").toLocalIterator():
        table[np.frombuffer(r.at, "<i4")] = np.frombuffer(r.word, np.uint64)
    phrases = rows.where("phrase is not null").groupBy("phrase").agg(F.collect_set("i").alias("items"), F.max(F.col("i").isNull()).alias("unnamed"))
    return staged(phrases), lengths, table


def _proposed(docs: DataFrame, lengths: list[int], table: np.ndarray, window: int, k: int) -> DataFrame:
    """(row, words, start, n, phrase): the number of words of each document (i, t), and rows with the windows that the table of bits lets through."""
    sent = docs.sparkSession.sparkContext.broadcast(table.tobytes())
    kind = dict(docs.dtypes)["i"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sent.value, np.uint8)

        def held(h: np.ndarray, salt: int) -> np.ndarray:
            at = _bits(h, salt)
            return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

        for b in batches:
            raw, at = buffers(b.column("t"))
            for lo, hi in slices(at):
                words = Words(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
                out: list[tuple[int, int, str]] = []
                if window in lengths and len(words.hashes) >= window:
                    g, ok, keep = words.windows(window, k)
                    kept = np.flatnonzero(keep)
                    near = words.near(kept[held(grams(words.hashes, k)[kept], 0)], ok, window, k)
                    out += [(s, window, words.phrase(s, window).decode()) for s in near[held(g[near], window)].tolist()]
                for n in lengths:
                    if n < window and len(words.hashes) >= n:
                        hit = np.flatnonzero(held(grams(words.hashes, n), n))
                        hit = hit[words.row[hit] == words.row[hit + n - 1]]
                        out += [(s, n, words.phrase(s, n).decode()) for s in hit.tolist()]
                start, length, phrase = zip(*out, strict=True) if out else ((), (), ())
                at_ = np.array(start, np.int64)
                of = words.row[at_] if out else at_
                m = hi - lo
                cols = [
                    pa.concat_arrays([b.column("i").slice(lo, m), b.column("i").slice(lo, m).take(pa.array(of))]), pa.concat_arrays([b.column("row").slice(lo, m), b.column("row").slice(lo, m).take(pa.array(of))]),
                    pa.concat_arrays([pa.array(np.diff(words.ptr)), pa.nulls(len(out), pa.int64())]), pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(at_ - words.ptr[of] if out else at_)]),
                    pa.concat_arrays([pa.nulls(m, pa.int32()), pa.array(length, pa.int32())]), pa.concat_arrays([pa.nulls(m, pa.string()), pa.array(phrase, pa.string())]),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["i", "row", "words", "start", "n", "phrase"])

    return docs.mapInArrow(tidy(run), f"i {kind}, row string, words bigint, start bigint, n int, phrase string")


def _joined(docs: DataFrame, items: DataFrame, window: int, k: int) -> DataFrame:
    """(i, row, n_words, spans, items) of documents (i, t) against a benchmark of any size."""
    phrases, lengths, table = _phrases(items, window, k)
    rows = staged(_proposed(docs.withColumn("row", F.hex(row_digest(F.col("i"), F.col("t")))), lengths, table, window, k))
    found = looked_up(rows.where("phrase is not null").select("row", "start", "n", "phrase"), phrases, ["phrase"])
    per = found.groupBy("row").agg(F.collect_set(F.struct("start", "n")).alias("at"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("named"), F.max("unnamed").alias("unnamed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [_flat([(x["start"], x["start"] + x["n"]) for x in at]) for at in b.column("at").to_pylist()]
            who = [_named({*named, None} if unnamed else set(named)) for named, unnamed in zip(b.column("named").to_pylist(), b.column("unnamed").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(spans, pa.list_(pa.int64())), pa.array(who, pa.list_(pa.string()))], ["row", "spans", "items"])

    hit = staged(per.mapInArrow(tidy(run), "row string, spans array<bigint>, items array<string>"))
    return looked_up(rows.where("words is not null").select("i", "row", F.col("words").alias("n_words")), hit, ["row"], "left").select(
        "i", "row", "n_words", F.coalesce("spans", F.array().cast("array<bigint>")).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, k: int = KGRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: its id, ``n_words``, merged word intervals ``spans`` (start, end, start, end ...), ``items`` (null for those without an id)."""
    benchmark = _items(items, item_col, item_text)
    sent = _whole(benchmark, window, k, block_bytes)
    rows = docs.select(F.col(quoted(id_col)).alias("i"), F.col(quoted(text_col)).alias("t"))
    if sent is None:
        out = _joined(rows, benchmark, window, k)
    else:
        kind = dict(rows.dtypes)["i"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            prints = pickle.loads(sent.value)
            for b in batches:
                counts, spans, who = _scanned(prints, b.column("t"))
                yield pa.RecordBatch.from_arrays([b.column("i"), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(who, pa.list_(pa.string()))], ["i", "n_words", "spans", "items"])

        out = rows.mapInArrow(tidy(run), f"i {kind}, n_words bigint, spans array<bigint>, items array<string>")
    return out.select(F.col("i").alias("_id"), "n_words", "spans", "items")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per document with counts of words, hit words and items, a digest of the items, and the verdict."""
    even = F.expr("aggregate(transform(spans, (x, i) -> IF(i % 2 = 1, x, -x)), 0L, (a, x) -> a + x)")
    return hits(docs, items, id_col, text_col, **how).select(
        F.col("_id").alias(id_col), "n_words", even.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (even > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, k: int = KGRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without rows that hold a window of an item, each judged by its own text; all columns stay."""
    benchmark = _items(items, item_col, item_text)
    sent = _whole(benchmark, window, k, block_bytes)
    if sent is None:
        (key,) = free(docs.columns, "key")
        named = docs.withColumn(key, F.md5(F.coalesce(F.col(quoted(text_col)), F.lit(""))))
        hit = staged(_joined(named.select(F.col(key).alias("i"), F.col(quoted(text_col)).alias("t")), benchmark, window, k).where("size(spans) > 0").select(F.col("i").alias(key)).distinct())
        return named.join(F.broadcast(hit) if hit.count() <= BROADCAST_ROWS else hit, key, "left_anti").select(*map(quoted, docs.columns))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = pickle.loads(sent.value)
        for b in batches:
            spans = _scanned(prints, b.column(at))[1]
            yield b.filter(pa.array([not s for s in spans], pa.bool_()))

    return filtered(docs, run)
