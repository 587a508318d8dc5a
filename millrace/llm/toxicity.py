"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text.

Folding: NFKC, lower case, homoglyphs and digit substitutions as Latin letters (digits only inside words that
hold letters), and one blank between words. Accents tell words of other languages apart and stay; whole words are also looked
up without them. The lexicon is learned from labelled rows: whole words, and stems (the
first 3 to 8 letters of words), weighted by the log odds of their document frequencies in toxic and clean rows. A neighbour
that takes a lexicon word into clean rows makes an exception phrase, as do the phrases given; an exception phrase takes
back the weight of the words inside it. The weights found are summed and divided by a slowly growing function of
the length; a logistic curve gives the score. Its middle is learned too: where 0.7 tells toxic and clean learning rows apart best, as near to ``HALF`` as
that allows.

The lexicon comes from a bounded sample of labelled rows (SAMPLE_TOXIC, SAMPLE_CLEAN), without near copies, counted on the executors. It holds every term of
the sample that passes the thresholds, each in MIN_TOXIC_DOCS toxic rows of the sample at least. Rows of which ``held_out`` holds never enter.

Defined results: a null or empty text scores the curve's value at zero evidence, below 0.7; with no toxic labelled row the
lexicon is empty and the score below 0.5; an id with both labels counts as toxic; of near copies with the same label the one with the least id (then text)
teaches; repeated rows score alike; other columns aren't read, and ``kept`` keeps them whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import filtered, quoted, staged, tidy

MIN_TOXIC_DOCS, MIN_LOG_ODDS, MIN_G, STEMS = 3, 2.5, 15.0, (3, 4, 5, 6, 7, 8)
#: A score from which on a text is called toxic, and the length that doubles what counts as little.
THRESHOLD, LENGTH = 0.7, 200
#: Labelled rows of either class that the lexicon is learned from, by the least hashes of their ids; scoring reads all rows.
SAMPLE_TOXIC, SAMPLE_CLEAN = 4000, 8000
#: Phrases in which a lexicon word is harmless.
EXCEPTIONS = ("trash can", "trash cans", "trash bin", "trash bag", "trash collection", "clown fish", "circus clown")
#: Evidence at which the score is one half: what speaks for a clean text beforehand.
HALF = 3.0

_GLYPHS = dict(
    zip(
        map(ord, "абвгеёзиіїјкмнорсԁѕтухһԛԝαβεζηικνορτυχıɡ"),
        "abbreesuiijkmhopcdstyxhqwabeznikvoptuxig",
        strict=True,
    )
)
_SIGNS = dict(zip(map(ord, "0134578@$"), "oleastbas", strict=True))
_MIXED = re.compile(r"[^\W\d_]+[0134578@$][^\W_@$]*[\w@$]*|[0134578@$]+[^\W\d_][\w@$]*")
_SIGNED = re.compile(r"[0134578@$]")
_MARKS, _FOREIGN, _GAPS = re.compile("[\u0300-\u036f]+"), re.compile("[\u0131\u0261\u0370-\u052f]"), re.compile(r"[\W_]+")
_ASCII = {c: " " for c in range(128) if not chr(c).isalnum()}


def fold(text: str) -> list[str]:
    """The words of a text, folded."""
    plain = text.isascii()
    if plain:
        text = text.lower()
    else:
        for _ in range(2):  # what has no lower case may have one once it is composed, and the other way round
            if not unicodedata.is_normalized("NFKC", text):
                text = unicodedata.normalize("NFKC", text)
            text = text.lower()
        if _FOREIGN.search(text):
            text = text.translate(_GLYPHS)
    if _SIGNED.search(text):
        text = _MIXED.sub(lambda m: m[0].translate(_SIGNS), text)
    return (text.translate(_ASCII) if plain else _GAPS.sub(" ", text)).split()


def variants(words: list[str]) -> set[str]:
    """Terms of a text for learning: its words and their stems."""
    once = set(words)
    return {f" {w} " for w in once} | {f" {w[:n]}" for w in once for n in STEMS if len(w) > n}


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept for testing: the CRC-32 of the id as text leaves 1 on division by 3."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1


def _terms(df: DataFrame, pairs: bool = False, words: frozenset[str] = frozenset()) -> DataFrame:
    """(term, toxic rows, clean rows) of labelled texts, counted on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), *(pa.array([v[i] for v in found.values()], pa.int64()) for i in (1, 0))], ["term", "toxic", "clean"])

        for b in batches:
            for text, toxic in zip(b.column("t").to_pylist(), b.column("y").to_pylist(), strict=True):
                seq = fold(text or "")
                if pairs:
                    got = {f"{a} {c}" for a, c in zip(seq, seq[1:], strict=False) if a in words or c in words}
                else:
                    got = variants(seq)
                for term in got:
                    found.setdefault(term, [0, 0])[toxic] += 1
            if len(found) > 100_000:
                yield out()
                found.clear()
        if found:
            yield out()

    return df.mapInArrow(tidy(run), "term string, toxic bigint, clean bigint").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _weight(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))


class Lexicon:
    """Terms with weights, and exception phrases; ``score`` rates a text."""

    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS, half: float = HALF):
        self.half = half
        self.weights, self.exceptions = weights, tuple(" ".join(fold(x)) for x in exceptions)
        self._machine = self._words = None

    def __getstate__(self):
        return {"half": self.half, "weights": self.weights, "exceptions": self.exceptions, "_machine": None, "_words": None}

    def _built(self):
        import ahocorasick

        if self._machine is None:
            self._machine = ahocorasick.Automaton()
            for term, w in self.weights.items():
                self._machine.add_word(term, (len(term), w))
            for phrase in self.exceptions:
                self._machine.add_word(f" {phrase} ", (len(phrase) + 2, None))
            self._machine.make_automaton()
        return self._machine

    def _single(self) -> frozenset[str]:
        if self._words is None:
            self._words = frozenset(t.strip() for t in self.weights if t.endswith(" "))
        return self._words

    def evidence(self, text: str | None) -> tuple[float, int]:
        words = fold(text or "")
        line = f" {' '.join(words)} "
        best: dict[int, float] = {}  # a word counts once, by its strongest term
        spared: list[tuple[int, int]] = []
        if self.weights or self.exceptions:
            for end, (n, w) in self._built().iter(line):
                if w is None:
                    spared.append((end - n + 1, end))
                elif line[end] == " " or line[end + 1] != " ":  # a stem is the beginning of a longer word
                    best[end - n + 1] = max(w, best.get(end - n + 1, 0.0))
        total, reach, spans = 0.0, -1, iter([*sorted(spared), (len(line) + 1, 0)])
        start, end = next(spans)
        for at in sorted(best):  # one walk over words and phrases
            while start <= at:
                reach = max(reach, end)
                start, end = next(spans)
            if at >= reach:
                total += best[at]
        if self.weights and not line.isascii():
            bare = set(_MARKS.sub("", unicodedata.normalize("NFD", line)).split()) - set(words)
            total += sum(self.weights[f" {w} "] for w in bare & self._single())
        return total, len(words)

    def strength(self, text: str | None) -> float:
        """The evidence for the text's length."""
        total, n = self.evidence(text)
        return total / (1 + math.log1p(n / LENGTH))

    def score(self, text: str | None) -> float:
        x = self.strength(text) - self.half
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def middle(rows: list[tuple[float, int]]) -> float:
    """Where the curve's middle lies best for (strength, label) of learning rows: at THRESHOLD the F1 is greatest, and it is as near to HALF as may be."""
    step = math.log(THRESHOLD / (1 - THRESHOLD))
    ordered = sorted(rows, reverse=True)
    toxic, hit, best, spans = sum(y for _, y in rows), 0, 0.0, []
    for n, (x, y) in enumerate(ordered, 1):
        hit += y
        below = ordered[n][0] if n < len(ordered) else 0.0
        if below < x:
            f1 = 2 * hit / (n + toxic) if toxic else 0.0
            if f1 > best:
                best, spans = f1, []
            if f1 == best and f1 > 0:
                spans.append((below, x))
    if not spans:
        return HALF
    # a quarter of the gap stays free on either side
    return min((min(max(HALF + step, low + (high - low) / 4), high - (high - low) / 4) - step for low, high in spans), key=lambda h: (abs(h - HALF), h))


def _once(rows: DataFrame) -> DataFrame:
    """Labelled texts (t, y) without near copies, which would pass their chance words off as evidence: one text of each least word-triple hash."""
    kind = dict(rows.dtypes)["i"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("t").to_pylist()
            seqs = [fold(t or "") for t in texts]
            least = [min((zlib.crc32(" ".join(s[i : i + 3]).encode()) for i in range(max(1, len(s) - 2))), default=0) for s in seqs]
            yield pa.RecordBatch.from_arrays([b.column("i"), b.column("t"), b.column("y"), pa.array(least, pa.int64())], ["i", "t", "y", "m"])

    least = F.min(F.struct("i", "t")).alias("r")
    return rows.mapInArrow(tidy(run), f"i {kind}, t string, y int, m bigint").groupBy("m", "y").agg(least).select("r.t", "y")


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """The lexicon, from at most SAMPLE_TOXIC and SAMPLE_CLEAN labelled rows that aren't held out."""
    known = labels.select(F.col(quoted(id_col)).alias("i"), F.col("toxic").cast("int").alias("y")).where(F.col("y").isin(0, 1) & ~held_out("i")).groupBy("i").agg(F.max("y").alias("y"))
    some = [known.where(F.col("y") == y).orderBy(F.xxhash64("i"), "i").limit(n) for y, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))]
    picked = some[0].unionByName(some[1])  # at most 12,000 ids
    rows = staged(_once(docs.select(F.col(quoted(id_col)).alias("i"), F.col(quoted(text_col)).alias("t")).join(F.broadcast(picked), "i")))
    n = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    share = F.lit(n_toxic / max(1, n_toxic + n_clean))
    seen = F.col("toxic") + F.col("clean")
    odds = F.log((F.col("toxic") + 0.5) / F.lit(n_toxic + 1)) - F.log((F.col("clean") + 0.5) / F.lit(n_clean + 1))
    # twice the log likelihood ratio of the term's share of toxic rows against their share of all rows
    g = 2 * (F.col("toxic") * F.log(F.col("toxic") / seen / share) + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / seen / (1 - share))).otherwise(0.0))
    strong = _terms(rows).where((F.col("toxic") >= MIN_TOXIC_DOCS) & (odds >= MIN_LOG_ODDS) & (g >= MIN_G)).collect()
    weights = {r.term: _weight(r.toxic, r.clean, n_toxic, n_clean) for r in sorted(strong, key=lambda r: r.term)}
    mild = frozenset(r.term.strip() for r in strong if r.term.endswith(" ") and r.clean >= MIN_TOXIC_DOCS)
    spared: list[str] = []
    if mild:
        spared = sorted(r.term for r in _terms(rows, True, mild).where((F.col("clean") >= MIN_TOXIC_DOCS) & (odds < 0)).collect())
    lexicon = Lexicon(weights, (*exceptions, *spared))
    if weights:  # a number for each row of the sample
        strengths = rows.mapInArrow(tidy(_rated(lexicon.strength, 0)), "x double, y int").collect()
        lexicon.half = middle([(r.x, r.y) for r in strengths])
    return lexicon


def _rated(rate, text_at: int):
    """A batch function: the column at ``text_at`` rated (x), and the one after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([rate(t) for t in b.column(text_at).to_pylist()], pa.float64()), b.column(text_at + 1)], ["x", "y"])

    return run


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, score, predicted) of each document."""
    kind = dict(docs.dtypes)[id_col]
    out = docs.select(F.col(quoted(text_col)).alias("t"), F.col(quoted(id_col)).alias("i")).mapInArrow(tidy(_rated(lexicon.score, 0)), f"x double, y {kind}")
    return out.select(F.col("y").alias(id_col), F.col("x").alias("score"), (F.col("x") >= threshold).cast("int").alias("predicted"))


def kept(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([lexicon.score(t) < threshold for t in b.column(at).to_pylist()], pa.bool_()))

    return filtered(docs, run)
