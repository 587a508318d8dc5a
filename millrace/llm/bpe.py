"""Byte-level BPE: texts to ids by ranked merges, ids to bytes by concatenating pieces.

A text is cut into words by the vocabulary's pattern; a word's bytes are merged pair by pair, least rank first, leftmost first; a word that is itself a
piece has that id at once. All distinct words are folded, each once, however rare or long:

* ``encode_words`` folds a table of distinct words with higher-order functions of Spark: an array of the bytes' ids, merged step by step by a table
  that says which id a pair of ids makes (its rank is that id). Spark searches an array or map by scanning it, so that table is a perfect hash: two
  elements of arrays decide a pair. The array of a word over ``LONG`` bytes is cut into blocks of about the square root of its length, so a merge changes three blocks at most.
* Tables of the vocabulary lie in a file of one row below the shared folder and are a scalar subquery: as literals they were in every plan's text, of which the driver keeps many.
* Rows are dealt into groups of about ``GROUP_BYTES`` of text by their place in the input's files, whatever tasks read them. ``cut`` gives each group's distinct units (a word,
  or a run between blanks, which may be several words), packed by the words' hash; ``folded`` has every distinct word of a bucket once, with its ids, and behind them the bucket's
  packed units, so one shuffle serves both; ``returned`` brings the ids back, as tables of each group's units.
* ``encode`` cuts whole texts again in Arrow batches and looks up each unit in its group's tables; nothing is merged there, and a unit without ids is an error.

Rows must come from files to have a place, so a table that is no plain scan of Parquet files is staged first.

``decoded`` turns ids into bytes in DataFrame functions: an array of pieces in hex is indexed by id, joined, and made binary.

Defined results: a null text is empty and has no ids; empty ids decode to empty bytes; repeated rows are encoded alike; a word of n bytes takes time in proportion
to n ** 1.5 at most; an empty table gives no rows; an id without a piece raises an error; ``encode`` keeps all other columns, but a column that already has the new
one's name is replaced.
"""

from __future__ import annotations

import base64
import bisect
import heapq
import random
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import files
from .shared import free, quoted, shared_dir, staged, tidy

#: Text whose words share a table, and bytes from which on a word is folded in blocks.
GROUP_BYTES, LONG = 24 << 20, 100
#: Text for each bucket of units, about: a task folds a bucket.
BUCKET_BYTES = 24 << 20
#: White space as the tokenizer libraries know it.
_SPACE = r"\t-\r\x20\x85\xa0  -     　"
#: What a text that is cut without the pattern has nowhere: its white space is only single blanks or line ends between other characters.
_OTHER = ("  ", "\n\n", " \n", "\n ", *(c for c in map(chr, range(0x3001)) if c not in " \n" and re.match(f"[{_SPACE}]", c)))
_OTHER_ASCII = tuple(x for x in _OTHER if x.isascii())
_SIGNS = bytes(c for c in range(128) if not chr(c).isalnum())


def uneven(text: str) -> bool:
    """Whether a text, not empty, must be cut by the pattern."""
    return text[0] in " \n" or text[-1] in " \n" or any(x in text for x in (_OTHER_ASCII if text.isascii() else _OTHER))


def explicit(pattern: str) -> str:
    """The pattern with its white space spelled out, so every regex library agrees on it."""
    return pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]")


def finder(pattern: str):
    """The function that lists the words of a text."""
    import regex

    return regex.compile(explicit(pattern)).findall


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Words:
    """The pattern, and the same merges in plain Python, for comparison: no operator folds with it."""

    def __init__(self, path: str, pattern: str):
        self.ranks = ranks_of(path)
        self.find = finder(pattern)

    def fold(self, word: bytes) -> list[int]:
        ranks = self.ranks
        whole = ranks.get(word)
        if whole is not None:
            return [whole]
        if len(word) > 100:
            return self._fold_long(word)
        parts = [word[i : i + 1] for i in range(len(word))]
        worst = 1 << 60
        pairs = [ranks.get(a + b, worst) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (low := min(pairs)) < worst:
            k = pairs.index(low)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k:
                pairs[k - 1] = ranks.get(parts[k - 1] + parts[k], worst)
            if k < len(pairs):
                pairs[k] = ranks.get(parts[k] + parts[k + 1], worst)
        return [ranks[p] for p in parts]

    def _fold_long(self, word: bytes) -> list[int]:
        """The same merges with a heap of pairs over a linked list of pieces."""
        n, ranks = len(word), self.ranks
        end, after, before = list(range(1, n + 1)), [*range(1, n), -1], list(range(-1, n - 1))

        def pair(i: int) -> int | None:
            return ranks.get(word[i : end[after[i]]]) if after[i] >= 0 else None

        heap = [(r, i, end[after[i]]) for i in range(n - 1) if (r := pair(i)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, until = heapq.heappop(heap)
            j = after[i]
            if j < 0 or end[i] < 0 or end[j] != until:
                continue  # one of the two was merged meanwhile
            end[i], after[i], end[j] = until, after[j], -1
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (r := pair(k)) is not None:
                    heapq.heappush(heap, (r, k, end[after[k]]))
        out, i = [], 0
        while i >= 0:
            out.append(ranks[word[i : end[i]]])
            i = after[i]
        return out


def _packed(items: list[bytes], kind: str = "u1") -> bytes:
    """Byte strings, compressed; of 32-bit integers the two halves apart, since ids are mostly small."""
    raw = b"".join(items)
    if kind != "u1":
        raw = np.frombuffer(raw, "<u2").reshape(-1, 2).T.tobytes()
    body = np.array([len(x) for x in items], "<u4").tobytes() + raw
    return struct.pack("<QQ", len(items), len(body)) + pa.compress(body, "zstd", asbytes=True)


def _unpacked(packed: bytes, kind: str = "u1") -> list[bytes]:
    n, size = struct.unpack_from("<QQ", packed)
    body = pa.decompress(packed[16:], size, "zstd", asbytes=True)
    at = [0, *np.cumsum(np.frombuffer(body, "<u4", n), dtype=np.int64).tolist()]
    raw = body[4 * n :]
    if kind != "u1":
        raw = np.frombuffer(raw, "<u2").reshape(2, -1).T.tobytes()
    return [raw[a:z] for a, z in zip(at, at[1:], strict=False)]


def units_of(texts: list[str | None], find, first: set[str], after: set[str]) -> None:
    """Adds what texts are cut into: the runs between blanks, at a line's start and after a blank; words where white space isn't that plain."""
    for t in texts:
        if not t:
            continue
        if uneven(t):
            for w in find(t):
                after.add(w[1:]) if w[0] == " " else first.add(w)
        elif "\n" in t:
            first.add("\n")
            for line in t.split("\n"):
                head, *rest = line.split(" ")
                first.add(head)
                after.update(rest)
        else:
            head, *rest = t.split(" ")
            first.add(head)
            after.update(rest)


class Texts:
    """Ids of texts through tables of all their units: those that begin with a blank (without it), and the others."""

    def __init__(self, find, first: dict[str, bytes], after: dict[str, bytes]):
        self.find, self.first, self.after = find, first, after

    def text(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        first, after = self.first, self.after
        if uneven(text):
            return b"".join([after[w[1:]] if w[0] == " " else first[w] for w in self.find(text)])
        out = []
        for n, line in enumerate(text.split("\n")):
            if n:
                out.append(first["\n"])
            head, *rest = line.split(" ")
            out.append(first[head])
            out += map(after.__getitem__, rest)
        return b"".join(out)


def scans(docs: DataFrame) -> bool:
    """Whether the rows are read from files as they are, so that a row has the same place and text in every run."""
    plan = docs._jdf.queryExecution().optimizedPlan()
    steady = plan.deterministic()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().head()
    return steady and plan.nodeName() == "LogicalRelation" and "_metadata" not in map(str.lower, docs.columns)


def placed(docs: DataFrame, text_col: str, group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, int]:
    """``docs`` with columns c0, c1, ... and the group of each row by its place in the input's files (``g``); and bytes of text."""

    def located(rows: DataFrame) -> DataFrame:
        return rows.select(*(F.col(quoted(c)).alias(f"c{k}") for k, c in enumerate(rows.columns)), F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row"))

    try:
        out = located(docs) if scans(docs) else None
    except AnalysisException:  # files of a kind that doesn't number rows
        out = None
    out = out or located(staged(docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))))
    rows, size = out.agg(F.count(F.lit(1)), F.sum(F.octet_length(f"c{docs.columns.index(text_col)}"))).first()
    each = max(1, int(group_bytes * rows // max(1, size or 0)))
    # groups whose hashes are equal only share a table
    return out.withColumn("g", F.xxhash64("path", F.floor(F.col("row") / each))).drop("path", "row"), size or 0


def cut(rows: DataFrame, pattern: str, parts: int) -> DataFrame:
    """(bucket, g, packed): the distinct units of each group (g, t), by a hash of their words. A group that several tasks read has several rows a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finder(pattern)
        number, first, after = None, set(), set()

        def found() -> pa.RecordBatch:
            dealt: list[list[bytes]] = [[] for _ in range(parts)]
            # those with a blank come last; signs at the ends are words of their own: without them the same word is in one bucket
            for blank, units in ((b"", first), (b" ", after)):
                while units:  # freed one by one
                    raw = units.pop().encode()
                    dealt[zlib.crc32(raw.strip(_SIGNS)) % parts].append(blank + raw)
                units.clear()
            buckets = [k for k, units in enumerate(dealt) if units]
            packed = [_packed(dealt[k]) for k in buckets]
            return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array([number] * len(buckets), pa.int64()), pa.array(packed, pa.binary())], ["bucket", "g", "packed"])

        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                b = whole.slice(lo, 1000)
                g = b.column(0).to_numpy()
                texts = b.column(1).to_pylist()
                runs = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])).tolist()
                for a, z in zip(runs, [*runs[1:], len(g)], strict=True):
                    if g[a] != number:
                        if first or after:
                            yield found()
                        number = int(g[a])
                    units_of(texts[a:z], find, first, after)
        if first or after:
            yield found()

    return rows.mapInArrow(tidy(run), "bucket int, g bigint, packed binary")


def folded(packed: DataFrame, path: str, pattern: str, parts: int, carried: bool = False) -> DataFrame:
    """(bucket, word, ids): every distinct word of the units of a bucket, once, in UTF-8. With ``carried`` (bucket, g, packed, word, ids): behind the words
    of a bucket also its rows of ``packed``, without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[set[bytes], list]] = {}
        for b in batches:
            for k, g, p in zip(*(c.to_pylist() for c in b.columns), strict=True):
                units, rows = held.setdefault(k, (set(), []))
                units.update(_unpacked(p))
                if carried:
                    rows.append((g, p))

        def batch(k: int, n: int, g, p, word) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in (([k] * n, pa.int32()), (g, pa.int64()), (p, pa.binary()), (word, pa.binary()))], ["bucket", "g", "packed", "word"])

        find = finder(pattern)
        for k, (units, rows) in held.items():
            some = [w.encode() for w in {w for u in units for w in find(u.decode())}]
            units.clear()
            while some:
                part = some[-10_000:]
                del some[-10_000:]
                none = [None] * len(part)
                yield batch(k, len(part), none, none, part)
            for lo in range(0, len(rows), 100):
                part = rows[lo : lo + 100]
                yield batch(k, len(part), *zip(*part, strict=True), [None] * len(part))
            rows.clear()

    kind = "bucket int, g bigint, packed binary, word binary"
    out = encode_words(packed.select("bucket", "g", "packed").repartitionById(parts, F.col("bucket")).mapInArrow(tidy(run), kind), path)
    return out if carried else out.select("bucket", "word", "ids")


def returned(both: DataFrame, pattern: str, parts: int, folder: str) -> DataFrame:
    """(g, path, begin, size): where in files below the folder each group's units lie, with their ids. ``both`` are words and packed units as ``folded`` carries them."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, known, whole, find = None, {}, {}, finder(pattern)
        for b in batches:
            lists = b.column(4)
            at, raw = (4 * lists.offsets.to_numpy()).tolist(), np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4").tobytes()
            out: list[tuple] = []
            for k, (n, g, p, w) in enumerate(zip(*(b.column(c).to_pylist() for c in range(4)), strict=True)):
                if n != bucket:
                    bucket, known, whole = n, {}, {}
                if p is None:
                    known[w] = raw[at[k] : at[k + 1]]
                else:
                    units = _unpacked(p)
                    for u in units:
                        if u not in whole:
                            whole[u] = known.get(u) or b"".join([known[x.encode()] for x in find(u.decode())])
                    out.append((g, p, _packed([whole[u] for u in units], "<i4")))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["g", "words", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, at, rows = None, None, 0, []
        for b in batches:
            for g, w, i in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    name, out = files.create(folder, ".words")
                if not rows or rows[-1][0] != g:
                    rows.append([g, name, at, 0])
                at += out.write(struct.pack("<QQ", len(w), len(i)) + w + i)
                rows[-1][3] = at - rows[-1][2]
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["g", "path", "begin", "size"])

    tables = both.mapInArrow(tidy(answer), "g bigint, words binary, ids binary")
    return tables.repartition(parts, "g").sortWithinPartitions("g").mapInArrow(tidy(write), "g bigint, path string, begin bigint, size bigint")


def _tables(path: str, begin: int, size: int) -> tuple[dict[str, bytes], dict[str, bytes]]:
    store, name = files.open_store(path)
    with store.open_input_file(name) as f:
        f.seek(begin)
        raw = f.read(size)
    first, after, at = {}, {}, 0
    while at < size:
        w, i = struct.unpack_from("<QQ", raw, at)
        at += 16
        units, ids = _unpacked(raw[at : at + w]), _unpacked(raw[at + w : at + w + i], "<i4")
        blank = bisect.bisect_left(units, True, key=lambda u: u[:1] == b" ")  # those that begin with a blank come last
        first.update(zip(map(bytes.decode, units[:blank]), ids[:blank], strict=True))
        after.update(zip([u[1:].decode() for u in units[blank:]], ids[blank:], strict=True))
        at += w + i
    return first, after


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", keep_text: bool = True) -> DataFrame:
    """``docs`` with the ids of the whole text in a further column, array<int>; without the text unless it is kept."""
    spark = docs.sparkSession
    docs = docs.select(*(quoted(c) for c in docs.columns if c.lower() != ids_col.lower()))
    at = docs.columns.index(text_col)
    left = [k for k in range(len(docs.columns)) if keep_text or k != at]
    own = [f"c{k}" for k in range(len(docs.columns) + 1)]  # named by place, so the documents' own names may be any
    names = [own[k] for k in (*left, -1)]
    rows, size = placed(docs, text_col)
    parts = max(4, spark.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES))
    both = folded(cut(rows.select("g", F.col(own[at]).alias("t")), pattern, parts), path, pattern, parts, carried=True)
    tables = {r.g: (r.path, r.begin, r.size) for r in returned(both, pattern, parts, shared_dir(spark)).collect()}  # a row per GROUP_BYTES of text
    sent = spark.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, number, table = finder(pattern), None, None
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                b = whole.slice(lo, 1000)
                found: list[bytes] = []
                for g, t in zip(b.column(b.num_columns - 1).to_pylist(), b.column(at).to_pylist(), strict=True):
                    if t and g != number:
                        table = None  # one table at a time
                        number, table = g, Texts(find, *_tables(*sent.value[g]))
                    found.append(table.text(t) if t else b"")
                ends = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
                values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(found))])
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in left), pa.ListArray.from_arrays(pa.array(ends), values)], names)

    return rows.mapInArrow(tidy(run), rows.select(*names[:-1], F.array().cast("array<int>").alias(own[-1])).schema).toDF(*(docs.columns[k] for k in left), ids_col)


def let(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def looking_up(rows: DataFrame, name: str, columns: dict, use) -> DataFrame:
    """``rows`` with a further column: what ``use`` makes of a struct of whole tables of the vocabulary, by (value, type).

    They are a row of a file below the shared folder and a scalar subquery, so no plan's text has them. A subquery can't stand inside a
    higher-order function, so it is a column first, which the optimizer puts in the one place that uses it.
    """
    import pyarrow.parquet as pq

    spark = rows.sparkSession
    at, out = files.create(shared_dir(spark), ".parquet")
    with out:
        pq.write_table(pa.table({c: pa.array([v], t) for c, (v, t) in columns.items()}), out)
    (own,) = free([*rows.columns, name], "tables")
    kinds = {pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}

    def kind(t: pa.DataType) -> str:
        return f"array<{kind(t.value_type)}>" if pa.types.is_list(t) else kinds[t]

    table = spark.read.schema(", ".join(f"{c} {kind(t)}" for c, (_, t) in columns.items())).parquet(at)
    return rows.withColumn(own, table.select(F.struct(*columns)).scalar()).withColumn(name, let(F.col(own), use)).drop(own)


def decoded(rows: DataFrame, path: str, ids_col: str, bytes_col: str) -> DataFrame:
    """``rows`` with the bytes of the ids in a further column."""
    ranks = ranks_of(path)
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    ids = F.col(quoted(ids_col))

    def joined(pieces: Column) -> Column:
        return F.unhex(F.array_join(F.transform(ids, lambda i: pieces[i]), ""))

    return looking_up(rows, bytes_col, {"pieces": (pieces, pa.list_(pa.string()))}, lambda t: let(t["pieces"], joined))


def merges(ranks: dict[bytes, int]) -> tuple[dict, int, int]:
    """Tables of what pairs of ids make, with their two sizes, powers of 2.

    The pair (a, b) is in the bucket (31 a + b) modulo the first size, in which a names it; a bucket is moved so that no two pairs share one of the slots
    (a + moved[bucket]) modulo the second size. The pair makes the slot's id if the bucket owns the slot.
    """
    top = max(ranks.values())
    if top >= 1 << 23:
        raise ValueError("ids over 23 bits")
    buckets = 1 << max(8, top.bit_length())
    pairs: list[list[tuple[int, int]]] = [[] for _ in range(buckets)]
    names: list[list[bytes]] = [[] for _ in range(buckets)]
    of_names: list[list[int]] = [[] for _ in range(buckets)]
    for piece, rank in ranks.items():
        names[zlib.crc32(piece) % buckets].append(piece)
        of_names[zlib.crc32(piece) % buckets].append(rank)
        for k in range(1, len(piece)):
            a, b = ranks.get(piece[:k]), ranks.get(piece[k:])
            if a is not None and b is not None:
                pairs[(31 * a + b) % buckets].append((a, rank))
    slots = max(buckets, 1 << (2 * sum(map(len, pairs))).bit_length())
    moved, owner, makes, rng = [0] * buckets, [-1] * slots, [0] * slots, random.Random(0)
    for k in sorted(range(buckets), key=lambda k: -len(pairs[k])):
        while any(owner[(a + moved[k]) % slots] >= 0 for a, _ in pairs[k]):
            moved[k] = rng.randrange(slots)
        for a, rank in pairs[k]:
            owner[(a + moved[k]) % slots], makes[(a + moved[k]) % slots] = k, rank
    ints = pa.list_(pa.int32())
    tables = {
        "moved": (moved, ints), "owner": (owner, ints), "makes": (makes, ints), "bytes": ([ranks[bytes([k])] for k in range(256)], ints),
        "two": ([ranks.get(bytes([a, b])) for a in range(256) for b in range(256)], ints), "names": (names, pa.list_(pa.list_(pa.binary()))), "of_names": (of_names, pa.list_(ints)),
    }
    return tables, buckets, slots


def encode_words(distinct: DataFrame, path: str, word_col: str = "word", ids_col: str = "ids") -> DataFrame:
    """``distinct`` with the ids of each word, by higher-order functions: ranked merges folded over the array of the word's bytes. A null word has none.

    The state is an array of ids and one of what each id makes with the next (null: nothing); a pair's rank is the id that it makes. Both begin with a null and end with what makes nothing.
    """
    tables, buckets, slots = merges(ranks_of(path))
    none = F.array().cast("array<int>")
    word = F.col(quoted(word_col)).cast("binary")
    length = F.octet_length(word)

    def fold(t: Column) -> Column:
        def made(a: Column, b: Column) -> Column:
            bucket = (a * 31 + b).bitwiseAND(buckets - 1)
            slot = (F.get(t["moved"], bucket) + a).bitwiseAND(slots - 1)
            return F.when(F.get(t["owner"], slot) == bucket, F.get(t["makes"], slot))

        def step(acc: Column) -> Column:
            parts, pair = acc["parts"], acc["pair"]

            def at(least: Column) -> Column:
                k, new = least.bitwiseAND(255), F.shiftright(least, 8)
                left, right = made(F.get(parts, k - 1), new), made(new, F.get(parts, k + 2))
                merged = F.filter(F.transform(parts, lambda x, i: F.when(i == k, new).otherwise(x)), lambda x, i: i != k + 1)
                pairs = F.filter(F.transform(pair, lambda x, i: F.when(i == k, right).when(i == k - 1, left).otherwise(x)), lambda x, i: i != k + 1)
                return F.when(least.isNull(), F.struct(parts.alias("parts"), none.alias("pair"))).otherwise(F.struct(merged.alias("parts"), pairs.alias("pair")))

            # the leftmost of the least, without array_position, which throws what it finds
            return F.when(F.size(pair) == 0, acc).otherwise(let(F.array_min(F.transform(pair, lambda x, i: x * 256 + i)), at))

        def folded(codes: Column) -> Column:
            head = F.array(F.lit(None).cast("int"))
            parts = F.concat(head, F.transform(codes, lambda c: F.get(t["bytes"], c)))
            pair = F.concat(head, F.zip_with(codes, F.slice(codes, F.lit(2), length), lambda a, b: F.get(t["two"], a * 256 + b)))
            return F.aggregate(F.sequence(F.lit(1), length), F.struct(parts.alias("parts"), pair.alias("pair")), lambda acc, _: step(acc), lambda acc: F.slice(acc["parts"], F.lit(2), length))

        def step_in_blocks(acc: Column) -> Column:
            parts, pairs, least, m = acc["parts"], acc["pairs"], acc["least"], F.size(acc["least"])

            def merged(c: Column) -> Column:
                k, low, p, q, i = c["k"], c["low"], c["p"], c["q"], c["i"]
                inner, right, right_pairs = i < F.size(p), F.get(parts, k), F.get(pairs, k)
                then = F.coalesce(F.get(p, i + 1), F.when(inner, F.get(right, F.lit(0))).otherwise(F.coalesce(F.get(right, F.lit(1)), F.get(F.get(parts, k + 1), F.lit(0)))))
                before = F.when(i > 1, F.concat(F.slice(q, F.lit(1), i - 2), F.array(made(F.get(p, i - 2), low)))).otherwise(none)
                own = F.concat(before, F.array(made(low, then)), F.slice(q, i + 2, F.size(q)))

                def around(of: Column, left: Column, new: Column, rest: Column) -> Column:
                    """An outer array with what stands for the block before, the block, and the block after, which goes if it gets empty."""
                    ahead = F.when((i > 1) | (k < 2), F.slice(of, F.lit(1), k - 1)).otherwise(F.concat(F.slice(of, F.lit(1), k - 2), F.array(left)))
                    behind = F.when(inner, F.slice(of, k + 1, m)).when(F.size(right) > 1, F.concat(F.array(rest), F.slice(of, k + 2, m))).otherwise(F.slice(of, k + 2, m))
                    return F.concat(ahead, F.array(new), behind)

                left = F.get(parts, k - 2)
                left_pairs = F.concat(F.slice(F.get(pairs, k - 2), F.lit(1), F.size(left) - 1), F.array(made(F.element_at(left, -1), low)))
                rest, rest_pairs = F.slice(right, F.lit(2), F.size(right)), F.slice(right_pairs, F.lit(2), F.size(right))
                new = F.concat(F.slice(p, F.lit(1), i - 1), F.array(low), F.slice(p, i + 2, F.size(p)))
                return F.struct(
                    around(parts, left, new, rest).alias("parts"), around(pairs, left_pairs, own, rest_pairs).alias("pairs"),
                    around(least, F.array_min(left_pairs), F.array_min(own), F.array_min(rest_pairs)).alias("least"),
                )

            def block(k: Column) -> Column:
                low, q = F.get(least, k - 1), F.get(pairs, k - 1)
                return let(F.struct(k.alias("k"), low.alias("low"), F.get(parts, k - 1).alias("p"), q.alias("q"), F.array_position(q, low).cast("int").alias("i")), merged)

            return F.when(F.array_min(least).isNull(), acc).otherwise(let(F.array_position(least, F.array_min(least)).cast("int"), block))

        def folded_in_blocks(parts: Column) -> Column:
            n = F.size(parts)
            side = F.ceil(F.sqrt(n)).cast("int")
            pair = F.transform(F.sequence(F.lit(1), n), lambda i: made(F.get(parts, i - 1), F.get(parts, i)))

            def blocks(of: Column) -> Column:
                return F.transform(F.sequence(F.lit(1), n, side), lambda i: F.slice(of, i, side))

            def all_(pair: Column) -> Column:
                begun = F.struct(blocks(parts).alias("parts"), blocks(pair).alias("pairs"), F.transform(blocks(pair), F.array_min).alias("least"))
                return F.aggregate(F.sequence(F.lit(1), n), begun, lambda acc, _: step_in_blocks(acc), lambda acc: F.flatten(acc["parts"]))

            return let(pair, all_)

        # a byte is a letter of ISO 8859-1
        codes = F.transform(F.split(F.decode(word, "ISO-8859-1"), ""), F.ascii)
        alone_at = F.crc32(word).bitwiseAND(F.lit(buckets - 1).cast("bigint")).cast("int")
        alone = F.get(F.get(t["of_names"], alone_at), (F.array_position(F.get(t["names"], alone_at), word) - 1).cast("int"))

        def all_(own: Column) -> Column:
            of_long = let(F.transform(codes, lambda c: F.get(t["bytes"], c)), folded_in_blocks)
            return F.when(own.isNotNull(), F.array(own)).when(length > LONG, of_long).when(length > 0, let(codes, folded)).otherwise(none)

        return let(alone, all_)

    return looking_up(distinct, ids_col, tables, fold)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: how many ids, and digests of the ids and of the bytes that they decode to."""
    rows = encode(docs.select(F.col(quoted(id_col)).alias("_id"), F.col(quoted(text_col)).alias("_text")), path, pattern, "_text", "_ids", keep_text=False)
    ids = F.col("_ids")
    listed = F.to_json(ids).cast("binary")  # in brackets; much quicker than joining strings
    return decoded(rows, path, "_ids", "_bytes").select(
        F.col("_id").alias(id_col), F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.substring(listed, F.lit(2), F.octet_length(listed) - 2), 256).alias("ids_sha256"), F.sha2("_bytes", 256).alias("decoded_sha256"),
    )
