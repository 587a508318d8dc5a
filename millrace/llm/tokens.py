"""Token-id files with Re-Pair grammar compression and random access.

Texts are encoded with a tokenizer file of the tokenizers library, one document after another, each closed by an end id, dealt by ranges of
document ids into one file per range, in ascending order. A file is a row of shards; a shard holds about ``SHARD_TOKENS`` ids:

    magic, document and rule counts, lengths;  document ids;  where each document begins in the packed sequence;  ids per document;
    rules (left, right);  expansion length of each rule;  the packed sequence

Re-Pair replaces the most frequent pairs of neighbours by new symbols, round by round; a round takes up to ``ROUND_PAIRS`` pairs that share no
symbol order (greedily, most frequent first), until no pair occurs often enough to pay for its rule: a rule costs two symbols and an expansion length in the
file, an occurrence saves one symbol, and rules that need a wider symbol must save more than the wider sequence costs. Pairs never cross the
end of a document, so a document's symbols are a contiguous piece: reading one needs its piece and the rules only. Symbols have as many bits as they need (16 or more).

Words are encoded once per worker: white space separates the tokenizer's words, so texts are cut there by Arrow, a batch of texts at once, and every distinct piece goes
through the library once; a bounded table keeps them. The file's reserved strings inside a text get their ids, as the library gives them.

Defined results: a null text is empty and gives the end id alone; rows with null ids come first; equal ids come in order of their ids' bytes; no rows, no files;
other columns aren't read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files
from .shared import filled, kept, range_of, shared_dir, staged, tidy, width
from .words import buffers

END_ID, SHARD_TOKENS, ROUND_PAIRS, KEPT_WORDS = 1, 1 << 20, 3072, 800_000
#: Words that go through the library in one call.
JOINED = 64
#: Bytes of texts that are encoded at once.
GATHERED_BYTES = 16 << 20
_MAGIC = b"RPG2"
#: Bits of an expansion length in the reckoning of a rule's cost.
_LENGTH_BITS = 16
_NULL = -(1 << 63)
_FACTOR = 0x9E3779B97F4A7C15


class WordEncoder:
    """Ids of whole texts as the tokenizers library gives them, through a table of encoded pieces.

    The file's normaliser and splitter must treat each run between ASCII white space alone (it lower-cases, drops white space and splits there).
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        #: Ids are kept as narrow as the vocabulary lets them be.
        self.kind = "<u2" if max(vocabulary.values()) < 1 << 16 else "<u4"
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}
        names = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.reserved = re.compile(b"|".join(map(re.escape, names)) if names else rb"(?!)").search

    def _encode(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _words(self, need: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of words of letters, many in one text: a word's last id is one that closes words."""
        groups = [need[i : i + JOINED] for i in range(0, len(need), JOINED)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, self.kind)
            cut = np.flatnonzero(self.closes[ids]) + 1
            if len(cut) == len(group) and cut[-1] == len(ids):
                raw, ends = ids.tobytes(), [0, *(ids.itemsize * cut).tolist()]
                yield from ((p, raw[a:z]) for p, a, z in zip(group, ends, ends[1:], strict=False))
            else:  # a word that lower case takes apart
                yield from zip(group, self._encode(group), strict=True)

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, from the table or put there."""
        if len(self.known) > KEPT_WORDS:
            self.known = {"": b""}
        known = self.known
        out = list(map(known.get, pieces))
        new = [k for k, ids in enumerate(out) if ids is None]
        self._learn([pieces[k] for k in new])
        for k in new:
            out[k] = known[pieces[k]]
        return out

    def _learn(self, new: list[str]) -> None:
        known = self.known
        ends, cores = {}, {}
        for piece in new:
            if piece.isalpha():
                cores[piece] = None
            elif (core := piece.rstrip(".,")) != piece and core.isalpha():  # letters and signs are separate words to the splitter
                ends[piece] = core, piece[len(core) :]
                cores[core] = cores[ends[piece][1]] = None
            else:
                cores[piece] = None
        need = [p for p in cores if p not in known]
        known.update(self._words([p for p in need if p.isalpha()]))
        other = [p for p in need if not p.isalpha()]
        known.update(zip(other, self._encode(other), strict=True))
        known.update((p, known[a] + known[b]) for p, (a, b) in ends.items())

    def encode(self, texts: pa.Array, end_id: int) -> pa.Array:
        """Ids of texts as little-endian integers of ``kind``, each text's followed by the end id. Words are told apart by Arrow, so the table is asked once for each distinct one."""
        texts = filled(texts)
        lower = pc.ascii_lower(texts)  # touches A-Z only, as the normaliser does again
        if self.reserved(buffers(lower)[0]):  # pieces that are or would become reserved strings keep their own case
            cut = ([(p, p.lower()) for p in t.encode().split()] for t in texts.to_pylist())
            lower = pa.array([b" ".join([p if self.reserved(q) else q for p, q in pieces]).decode() for pieces in cut], texts.type)
        lists = pc.ascii_split_whitespace(lower)
        words = lists.values.dictionary_encode()
        found = pa.array(self.pieces(words.dictionary.to_pylist()), pa.large_binary()).take(words.indices)
        _, offsets, data = found.buffers()
        size = np.dtype(self.kind).itemsize
        at = np.frombuffer(offsets, np.int64, len(found) + 1)[lists.offsets.to_numpy()] // size
        ids = np.insert(np.frombuffer(data, self.kind, at[-1]) if at[-1] else np.zeros(0, self.kind), at[1:], end_id)
        begins = size * (at + np.arange(len(at)))
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())


def encoder(path: str) -> WordEncoder:
    return kept(("tokens", path), lambda: WordEncoder(path))


def symbol_bits(symbols: int) -> int:
    """Bits of a symbol in a file where so many are in use."""
    return max(16, (symbols - 1).bit_length())


def repair(seq: np.ndarray, vocabulary: int, ends: np.ndarray, round_pairs: int = ROUND_PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed sequence, rules, where each document ends in it). ``ends`` are the documents' ends in ``seq``."""
    rules: list[np.ndarray] = []
    top = vocabulary
    last = np.zeros(len(seq), bool)
    last[ends - 1] = True
    while len(seq) >= 2:
        # while symbols fit in 16 bits a pair fits in 32, which sort faster
        kind, shift = (np.uint32, 16) if top + round_pairs <= 1 << 16 else (np.uint64, 32)
        mask, never = (1 << shift) - 1, (1 << 2 * shift) - 1  # the greatest code is no pair: symbols don't reach it
        seq = seq.astype(kind, copy=not rules)
        pair = (seq[:-1] << kind(shift)) | seq[1:]
        pair[last[:-1]] = never
        ordered = np.sort(pair)
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        count = np.diff(np.append(first, len(ordered)))
        bits = symbol_bits(top)
        often = np.flatnonzero(count > 2 + _LENGTH_BITS // bits)  # (count - 2) * bits > _LENGTH_BITS
        often = often[ordered[first[often]] != never]
        if not len(often):
            break
        best = often[np.argsort(-count[often], kind="stable")[: 4 * round_pairs]]
        # a symbol that ends one chosen pair begins no other, so occurrences of different pairs never overlap
        begins, finishes, chosen, saved = set(), set(), [], 0
        for p, n in zip(ordered[first[best]].tolist(), count[best].tolist(), strict=True):
            a, b = p >> shift, p & mask
            if a not in finishes and b not in begins and (a != b or (a not in begins and b not in finishes)):
                begins.add(a)
                finishes.add(b)
                chosen.append(p)
                saved += (n - 2) * bits - _LENGTH_BITS
                if len(chosen) == round_pairs:
                    break
        if top + len(chosen) > 1 << bits and saved <= len(seq) + 2 * (top - vocabulary):  # one more bit a symbol costs more
            chosen = chosen[: (1 << bits) - top]
            if not chosen:
                break
        chosen_ = np.sort(np.array(chosen, kind))
        left, right = chosen_ >> kind(shift), chosen_ & kind(mask)
        # where a pair may be a chosen one: one look into a table of bits that fits in a cache
        factor, drop = (np.uint32(0x9E3779B1), np.uint32(14)) if kind is np.uint32 else (np.uint64(_FACTOR), np.uint64(46))
        maybe = np.zeros(1 << 18, bool)
        maybe[(chosen_ * factor) >> drop] = True
        at = np.flatnonzero(maybe[(pair * factor) >> drop])
        code = pair[at]
        spot = np.minimum(np.searchsorted(chosen_, code), len(chosen_) - 1)
        hit = chosen_[spot] == code
        at, spot = at[hit], spot[hit]
        same = left[spot] == right[spot]
        if same.any():  # runs of one symbol (a, a): every second occurrence
            run = np.concatenate([[True], (np.diff(at) != 1) | ~same[1:]])
            begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            even = (np.arange(len(at)) - begin) % 2 == 0
            at, spot = at[even], spot[even]
        seq[at] = (top + spot).astype(kind)
        last[at] |= last[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, last = seq[keep], last[keep]
        rules.append(np.stack([left, right], 1).astype(np.int64))
        top += len(chosen_)
    return seq, (np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)), np.flatnonzero(last) + 1


def lengths(rules: np.ndarray, vocabulary: int) -> np.ndarray:
    """How many ids each rule expands to; rules refer to earlier ones only."""
    size = np.ones(vocabulary + len(rules), np.int64)
    done = 0
    while done < len(rules):  # a level of rules at once
        below = (rules[done:] < vocabulary + done).all(1)
        n = len(below) if below.all() else int(below.argmin())
        size[vocabulary + done : vocabulary + done + n] = size[rules[done : done + n]].sum(1)
        done += n
    return size[vocabulary:]


def expand(packed: np.ndarray, rules: np.ndarray, vocabulary: int) -> np.ndarray:
    """The ids of a piece of the packed sequence."""
    seq, rules = packed.astype(np.int32), rules.astype(np.int32)
    while len(at := np.flatnonzero(seq >= vocabulary)):
        pair = rules[seq[at] - vocabulary]
        out = np.repeat(seq, 1 + (seq >= vocabulary))
        to = at + np.arange(len(at))
        out[to], out[to + 1] = pair[:, 0], pair[:, 1]
        seq = out
    return seq


def _spelled(x: np.ndarray, bits: int) -> bytes:
    """Symbols: their low 16 bits, then a plane for each higher bit."""
    x = x.astype(np.uint64)
    return b"".join([x.astype("<u2").tobytes(), *(np.packbits((x >> np.uint64(k)).astype(np.uint8) & 1).tobytes() for k in range(16, bits))])


def shard_bytes(ids: list[int | None], docs: list[np.ndarray], vocabulary: int) -> bytes:
    """A shard of documents."""
    count = np.array([len(d) for d in docs], np.int64)
    packed, rules, ends = repair(np.concatenate(docs), vocabulary, np.cumsum(count))
    bits, long_ = symbol_bits(vocabulary + len(rules)), lengths(rules, vocabulary)
    wide = "<u2" if not len(long_) or long_.max() < 1 << 16 else "<u4"
    head = struct.pack("<4sIIIIBB", _MAGIC, len(docs), len(rules), len(packed), vocabulary, bits, int(wide[-1]))
    return b"".join([head, np.array([_NULL if i is None else i for i in ids], "<i8").tobytes(), ends.astype("<u4").tobytes(), count.astype("<u4").tobytes(), _spelled(rules.ravel(), bits), long_.astype(wide).tobytes(), _spelled(packed, bits)])


class Shard:
    """A shard as read; ``document(k)`` decodes one document from its own piece."""

    def __init__(self, stream):
        head = stream.read(22)
        self.empty = not head
        if self.empty:
            return
        magic, n, n_rules, n_packed, self.vocabulary, bits, wide = struct.unpack("<4sIIIIBB", head)
        if magic != _MAGIC:
            raise ValueError("not a token file")

        def array(count: int, kind: str) -> np.ndarray:
            return np.frombuffer(stream.read(count * np.dtype(kind).itemsize), kind, count)

        def symbols(count: int) -> np.ndarray:
            out = array(count, "<u2").astype(np.int64)
            for k in range(16, bits):
                out |= np.unpackbits(array(-(-count // 8), "u1"), count=count).astype(np.int64) << k
            return out

        self.ids, self.ends, self.counts = array(n, "<i8"), array(n, "<u4").astype(np.int64), array(n, "<u4").astype(np.int64)
        self.rules = symbols(2 * n_rules).reshape(-1, 2)
        self.lengths = array(n_rules, f"<u{wide}")
        self.packed = symbols(n_packed)

    def document(self, k: int) -> np.ndarray:
        return expand(self.packed[self.ends[k - 1] if k else 0 : self.ends[k]], self.rules, self.vocabulary)

    def all(self) -> np.ndarray:
        return expand(self.packed, self.rules, self.vocabulary)

    def token(self, k: int, at: int) -> int:
        """One id of a document by the rules' expansion lengths, without decoding the rest."""
        size = np.concatenate([np.ones(self.vocabulary, np.int64), self.lengths.astype(np.int64)])
        piece = self.packed[self.ends[k - 1] if k else 0 : self.ends[k]].astype(np.int64)
        reach = np.cumsum(size[piece])
        j = int(np.searchsorted(reach, at, "right"))
        symbol, at = int(piece[j]), at - (int(reach[j - 1]) if j else 0)
        while symbol >= self.vocabulary:
            left, right = self.rules[symbol - self.vocabulary].tolist()
            symbol, at = (left, at) if at < size[left] else (right, at - int(size[left]))
        return symbol


def gathered(batches: Iterator[pa.RecordBatch], least: int = GATHERED_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of so many bytes or a little more: a word is asked for once a batch."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.nbytes for x in held) >= least:
            whole, held = pa.concat_batches(held), []
            yield whole
    if held:
        yield pa.concat_batches(held)


def encoded(docs: DataFrame, path: str, id_col: str, text_col: str, end_id: int = END_ID) -> DataFrame:
    """(i, ids) with ids as little-endian integers of ``wide`` bytes, the end id last."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        size = int(enc.kind[-1])
        for b in gathered(batches):
            yield pa.RecordBatch.from_arrays([b.column("i"), enc.encode(b.column("t"), end_id), pa.array([size] * b.num_rows, pa.int32())], ["i", "ids", "wide"])

    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(tidy(run), f"i {kind}, ids binary, wide int")


def write(docs: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Token files below the folder: (bucket, path, n_tokens), a row per range of document ids, in their order."""
    ranges = ranges or 2 * width(docs.sparkSession)
    vocabulary = WordEncoder(path).tokenizer.get_vocab_size()  # writers need no tokenizer of their own
    rows = encoded(docs.select(F.col(id_col).cast("long").alias(id_col), text_col), path, id_col, text_col)
    dealt = rows.withColumn("bucket", range_of(docs.select(F.col(id_col).cast("long").alias("i")), "i", ranges)).repartitionById(ranges, F.col("bucket")).sortWithinPartitions("bucket", "i", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, name, out, ids, seqs, held, total = None, None, None, [], [], 0, 0

        def flush() -> None:
            nonlocal ids, seqs, held
            if ids:
                out.write(shard_bytes(ids, seqs, vocabulary))
                ids, seqs, held = [], [], 0

        def close() -> pa.RecordBatch:
            flush()
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([name]), pa.array([total], pa.int64())], ["bucket", "path", "n_tokens"])

        for b in batches:
            for i, raw, wide, k in zip(*(b.column(c).to_pylist() for c in ("i", "ids", "wide", "bucket")), strict=True):
                if k != bucket or out is None:
                    if out is not None:
                        yield close()
                    bucket, total = k, 0
                    name, out = files.create(folder, ".rpg")
                seq = np.frombuffer(raw, f"<u{wide}")
                ids.append(i)
                seqs.append(seq)
                held += len(seq)
                total += len(seq)
                if held >= shard_tokens:
                    flush()
        if out is not None:
            yield close()

    return staged(dealt.mapInArrow(tidy(run), "bucket int, path string, n_tokens bigint"))


def read(written: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    spark = written.sparkSession
    base, rows = 0, []
    for r in sorted(written.collect(), key=lambda r: r.bucket):  # a row per file
        rows.append((r.path, base))
        base += r.n_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("base").to_pylist(), strict=True):
                with files.read(path) as stream:
                    while not (shard := Shard(stream)).empty:
                        ids = shard.all().astype("<u4")
                        ends = np.cumsum(shard.counts)
                        begins = ends - shard.counts
                        if len(ids) != ends[-1]:
                            raise ValueError("a shard's ids don't add up")
                        crc = [zlib.crc32(ids[a:z].tobytes()) for a, z in zip(begins.tolist(), ends.tolist(), strict=True)]
                        names = pa.array(shard.ids, pa.int64(), mask=shard.ids == _NULL)
                        yield pa.RecordBatch.from_arrays([names, pa.array(begins + start, pa.int64()), pa.array(shard.counts, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += len(ids)

    kind = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    if not rows:
        return spark.createDataFrame([], kind)
    return spark.createDataFrame(rows, "path string, base bigint").repartition(min(len(rows), 4 * width(spark))).mapInArrow(tidy(run), kind)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    out = read(write(docs, shared_dir(docs.sparkSession), path, id_col, text_col))
    return out.withColumnRenamed("doc_id", id_col)
