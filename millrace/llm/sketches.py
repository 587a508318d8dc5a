"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

Paragraphs are a text's lines, cut further after words whose hash says so (about every ``CUT`` words), so a text of one long line
has several too. Each paragraph's 64-bit digest (with its number of occurrences so far, so repeats count) is put in ``HASHES`` cells of a sketch; a cell
holds how many it got, and the XOR of the digests and of check codes. Sketches of two versions subtract cell by cell; what they share cancels, and
peeling cells that hold one digest recovers the differing digests. Where peeling stops short, both are sketched again with
twice the cells, until it succeeds (or, should check codes collide, until there are ``MOST`` cells a digest; then the digests themselves are compared). The likeness is shared / all paragraphs.

The fingerprint written is the sketch of ``CELLS`` cells with the number of paragraphs and a digest of the whole text, in hex; equal texts have equal ones.

The next document is the row after in order of id: rows are dealt by ranges of ids, whose bounds are quantiles, as many as the texts' bytes need, one to a partition; each range
also gets the first row of the next one, and is read as a sorted stream. No window over all rows, and no range is held in memory.

Defined results: a null text is empty; two texts without paragraphs are alike by 1.0; rows with null ids come first; equal ids come in order of their texts;
a single row is its own next one; an empty table gives no rows; ids must be integers (any other type is a TypeError); other columns aren't read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import quoted, range_of, width
from .words import SPACED, mix, word_hashes

CELLS, HASHES, CUT, MOST, RANGE_BYTES = 24, 3, 8, 64, 128 << 20
_SALTS = [np.uint64(x) for x in (0x9AE16A3B2F90404F, 0xC949C7DEFEED5EED, 0xB492B66FBE98F273)]


def paragraphs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the paragraphs of UTF-8 texts, repeats numbered apart, and where each text's begin."""
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    words, ptr = word_hashes(raw, at, SPACED)
    row = np.repeat(np.arange(len(texts)), np.diff(ptr))
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    last = (words % np.uint64(CUT)) == 0
    line = np.flatnonzero(raw == 10)
    if len(line):
        word = SPACED.is_word[raw]
        begin = word.copy()
        begin[1:] &= ~word[:-1]
        edge = at[:-1][at[:-1] < len(raw)]
        begin[edge] = word[edge]
        before = np.searchsorted(np.flatnonzero(begin), line) - 1
        last[before[before >= 0]] = True
    last[ptr[1:][np.diff(ptr) > 0] - 1] = True
    ends = np.flatnonzero(last)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = (np.arange(n) - np.repeat(starts, ends - starts + 1)).astype(np.uint64)
    digest = mix(np.add.reduceat(mix(words + place * np.uint64(0x9E3779B97F4A7C15)), starts))
    of = row[starts]
    order = np.lexsort((digest, of))
    d, o = digest[order], of[order]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (o[1:] != o[:-1])])
    first = np.flatnonzero(new)
    again = np.arange(len(d)) - np.repeat(first, np.diff(np.append(first, len(d))))
    return mix(d + again.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), np.searchsorted(o, np.arange(len(texts) + 1))


def cells_of(digest: np.ndarray, cells: int) -> np.ndarray:
    """The cells of each digest, one in each of HASHES equal parts of the sketch."""
    part = cells // HASHES
    return np.stack([((mix(digest ^ s) >> np.uint64(32)) * np.uint64(part) >> np.uint64(32)).astype(np.int64) + j * part for j, s in enumerate(_SALTS)], 1)


def check_of(digest: np.ndarray) -> np.ndarray:
    return mix(digest * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1))


def sketch(digest: np.ndarray, ptr: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts, digest XORs, check XORs), each texts x cells."""
    rows = len(ptr) - 1
    where = (np.repeat(np.arange(rows), np.diff(ptr))[:, None] * cells + cells_of(digest, cells)).ravel()
    order = np.argsort(where, kind="stable")
    spot = where[order]
    count = np.bincount(where, minlength=rows * cells)
    keys, checks = np.zeros(rows * cells, np.uint64), np.zeros(rows * cells, np.uint64)
    if len(spot):
        first = np.flatnonzero(np.concatenate([[True], spot[1:] != spot[:-1]]))
        item = order // HASHES
        keys[spot[first]] = np.bitwise_xor.reduceat(digest[item], first)
        checks[spot[first]] = np.bitwise_xor.reduceat(check_of(digest)[item], first)
    return count.reshape(rows, cells), keys.reshape(rows, cells), checks.reshape(rows, cells)


def peel(count: np.ndarray, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of subtracted sketches: how many digests only the first and only the second has, and whether peeling ended."""
    rows, cells = count.shape
    count, keys, checks = count.copy(), keys.copy(), checks.copy()
    only = np.zeros((2, rows), np.int64)
    todo = np.arange(rows)
    while len(todo):
        r, c = np.nonzero(np.abs(count[todo]) == 1)
        r = todo[r]
        pure = checks[r, c] == check_of(keys[r, c])
        r, c = r[pure], c[pure]
        if not len(r):
            break
        one = np.unique(np.stack([r.astype(np.uint64), keys[r, c]], 1), axis=0, return_index=True)[1]
        r, key, sign = r[one], keys[r[one], c[one]], count[r[one], c[one]]
        np.add.at(only, ((sign < 0).astype(np.int64), r), 1)
        check, spots = check_of(key), cells_of(key, cells)
        for j in range(HASHES):
            np.subtract.at(count, (r, spots[:, j]), sign)
            np.bitwise_xor.at(keys, (r, spots[:, j]), key)
            np.bitwise_xor.at(checks, (r, spots[:, j]), check)
        todo = np.unique(r)
    return only[0], only[1], ~(count.any(1) | keys.any(1) | checks.any(1))


def likeness(a: np.ndarray, pa_: np.ndarray, b: np.ndarray, pb: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """Shared / all paragraphs of pairs of texts, from their subtracted sketches."""
    rows = len(pa_) - 1
    na, nb = np.diff(pa_), np.diff(pb)
    out, todo = np.ones(rows), np.flatnonzero((na > 0) | (nb > 0))
    while len(todo):
        if cells > CELLS + MOST * int((na + nb)[todo].max()):
            for r in todo.tolist():
                shared = len(np.intersect1d(a[pa_[r] : pa_[r + 1]], b[pb[r] : pb[r + 1]], assume_unique=True))
                out[r] = shared / (na[r] + nb[r] - shared)
            break
        sub = [_rows(d, p, todo) for d, p in ((a, pa_), (b, pb))]
        one, two = (sketch(d, p, cells) for d, p in sub)
        only_a, only_b, ended = peel(one[0] - two[0], one[1] ^ two[1], one[2] ^ two[2])
        shared = na[todo] - only_a
        ended &= shared == nb[todo] - only_b
        out[todo[ended]] = shared[ended] / (na[todo] + nb[todo] - shared)[ended]
        todo = todo[~ended]
        cells *= 2
    return out


def _rows(d: np.ndarray, p: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(p)[rows]
    q = np.concatenate([[0], np.cumsum(n)])
    return d[np.arange(q[-1]) + np.repeat(p[rows] - q[:-1], n)], q


def fingerprints(texts: list[bytes], digest: np.ndarray, ptr: np.ndarray) -> list[str]:
    count, keys, checks = sketch(digest, ptr, CELLS)
    packed = np.concatenate([count.astype("<u4").view(np.uint8), keys.astype("<u8").view(np.uint8), (checks & np.uint64(0xFFFFFFFF)).astype("<u4").view(np.uint8)], 1)
    return [f"{n:08x}{hashlib.sha256(t).hexdigest()[:32]}{row.tobytes().hex()}" for t, n, row in zip(texts, np.diff(ptr).tolist(), packed, strict=True)]


def by_ranges(docs: DataFrame, id_col: str, text_col: str, ranges: int) -> DataFrame:
    """(bucket, i, t, tail): rows dealt by ranges of ids and sorted in them; each range ends with the next range's first row (tail).

    The last range ends with the first row of all. What the driver gets is one bound and one first id per range.
    """
    rows = docs.select(F.col(quoted(id_col)).alias("i"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("t"))
    dealt = rows.withColumn("bucket", range_of(rows, "i", ranges))
    firsts = sorted((r.bucket, r.nulls, r.low) for r in dealt.groupBy("bucket").agg(F.min("i").alias("low"), F.max(F.col("i").isNull()).alias("nulls")).collect())
    table = [(bucket, None if nulls else low, firsts[k - 1][0]) for k, (bucket, nulls, low) in enumerate(firsts)]
    first = docs.sparkSession.createDataFrame(table, f"bucket int, low {dict(rows.dtypes)['i']}, before int")
    tails = dealt.join(F.broadcast(first), "bucket").where(F.col("i").eqNullSafe(F.col("low"))).select("i", "t", F.col("before").alias("bucket"), F.lit(True).alias("tail"))
    both = dealt.withColumn("tail", F.lit(False)).unionByName(tails)
    return both.repartitionById(ranges, F.col("bucket")).sortWithinPartitions("bucket", "tail", "i", "t").select("bucket", "i", "t", "tail")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", at_once: int = 2 << 20) -> DataFrame:
    """A row per document: fingerprints of it and its edited text, and its likeness to that and to the next document."""
    kind = dict(docs.dtypes)[id_col]
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    size = docs.agg(F.sum(F.octet_length(F.col(quoted(text_col))))).first()[0] or 0
    dealt = by_ranges(docs, id_col, text_col, max(2 * width(docs.sparkSession), -(-size // RANGE_BYTES)))

    def made(ids: list, texts: list[str], type_) -> pa.RecordBatch:
        own = [t.encode() for t in texts]
        new = [edited(t, f).encode() for t, f in zip(texts, texts[1:], strict=False)]
        d, p = paragraphs(own)
        e, q = paragraphs(new)
        n = len(new)
        one, ptr = d[: p[n]], p[: n + 1]
        prints = fingerprints(own[:n], one, ptr)
        shift, sptr = d[p[1] :], p[1:] - p[1]
        cols = [pa.array(ids[:n], type_), pa.array([len(t) for t in texts[:n]], pa.int64()), [hashlib.sha256(t).hexdigest() for t in new], prints, fingerprints(new, e, q), likeness(one, ptr, e, q), likeness(one, ptr, shift, sptr)]
        return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, list) else (c if isinstance(c, pa.Array) else pa.array(c, pa.float64())) for c in cols], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, ids, texts, size, done = None, [], [], 0, False
        for b in batches:
            type_ = b.column("i").type
            for k, i, t, tail in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if k != bucket:
                    bucket, ids, texts, size, done = k, [], [], 0, False
                if done:
                    continue  # of equal first rows only the first one follows
                ids.append(i)
                texts.append(t)
                size += len(t)
                done = tail
                if len(texts) > 1 and (tail or size > at_once):
                    yield made(ids, texts, type_)
                    ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])

    return dealt.mapInArrow(run, f"{id_col} {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
