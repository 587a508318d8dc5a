"""URL verdicts: rules by host and path, and gradient-boosted trees on lexical features for the rest.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end. A rule ``host/path``
fits its host and every subdomain if the url's path starts with the rule's; the longest rule wins. Urls that a rule decides
are the labelled ones: trees are fitted on a bounded sample of them (about ``SAMPLE`` urls, by the least hashes of their text) and judge all
others. Beside lengths, counts and entropy, the features are the smoothed shares of blocked urls in that sample by suffixes of the host (one label and two), by
the path's first part, by both, by the beginning of the second part, and by the file's extension. A sample url's own shares come from the other folds of the sample, so trees never
see a url's own label in them. Each sample url is learned from with all of its shares and with some of them as of keys never seen, so that an unknown
host or path is judged by what is known of the url, not as the nearest share. The score from which on a url is blocked is where the F1 of scores made the same way, by trees fitted on the other folds, is greatest.

Defined results: a null url or one without ``://`` has an empty host and path, fits no rule and gets the trees' verdict on its
features; with labels of one kind only the trees say that kind, with none they allow; repeated rows each get a row; an empty table gives no rows; other
columns aren't read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import quoted

#: (host/path, verdict).
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
SAMPLE, TREES, DEPTH, RATE, BINS, LEAF, FOLDS, PRIOR = 20_000, 40, 4, 0.2, 32, 5, 3, 2.0


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """(rule, verdict) of the longest fitting rule, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0], r[1])):
        at, _, under = rule.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(f"/{under}")
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digits", "digit_ratio", "hyphens", "host_hyphens", "entropy", "parameters", "query_length", "longest_part", "upper", "fragment", "secure")
#: What shares of blocked urls are kept by.
KEYS = ("label", "labels", "head", "label+head", "labels+head", "labels+head+next", "extension")


def keys_of(url: str) -> tuple[str, ...]:
    """A url's values of KEYS."""
    rest = url.partition("://")[2].partition("#")[0].partition("?")[0]
    host, _, path = rest.partition("/")
    names, parts_ = host.lower().split("."), path.split("/")
    one, two, head, next_ = names[-1], ".".join(names[-2:]), parts_[0], parts_[1][:1] if len(parts_) > 1 else ""
    return one, two, head, f"{one}/{head}", f"{two}/{head}", f"{two}/{head}/{next_}", parts_[-1].rpartition(".")[2] if "." in parts_[-1] else ""


#: Which of KEYS a sample url is learned from with: all; those of one thing; those of the path; none.
KNOWN = np.array([[1, 1, 1, 1, 1, 1, 1], [1, 0, 1, 0, 0, 0, 1], [0, 0, 1, 0, 0, 0, 1], [1, 1, 0, 0, 0, 0, 0], [0, 0, 0, 0, 0, 0, 0]], bool)


class Shares:
    """Smoothed shares of blocked urls by each of KEYS."""

    def __init__(self, keys: list[tuple[str, ...]], y: np.ndarray, usual: float):
        self.usual = usual
        self.shares: list[dict[str, float]] = []
        for column in zip(*keys, strict=True) if keys else [()] * len(KEYS):
            seen: dict[str, list[float]] = {}
            for k, b in zip(column, y.tolist(), strict=True):
                s = seen.setdefault(k, [0.0, 0.0])
                s[0] += b
                s[1] += 1
            self.shares.append({k: (a + PRIOR * usual) / (n + PRIOR) for k, (a, n) in seen.items()})

    def of(self, keys: list[tuple[str, ...]]) -> np.ndarray:
        return np.array([[s.get(k, self.usual) for s, k in zip(self.shares, row, strict=True)] for row in keys]).reshape(len(keys), len(KEYS))


def features(urls: list[str]) -> np.ndarray:
    """Lexical features, a row for each url."""
    out = np.zeros((len(urls), len(FEATURES)))
    for n, url in enumerate(urls):
        rest = url.partition("://")[2]
        place, _, fragment = rest.partition("#")
        place, _, query = place.partition("?")
        host, _, path = place.partition("/")
        raw = np.frombuffer(url.encode(), np.uint8)
        share = np.bincount(raw, minlength=256)
        share = share[share > 0] / max(1, len(raw))
        digits = sum(map(url.count, "0123456789"))
        out[n] = (
            len(url), len(host), len(path), path.count("/"), host.count("."), digits, digits / max(1, len(url)), url.count("-"), host.count("-"), -(share * np.log2(share)).sum(),
            query.count("=") + query.count("&"), len(query), max(map(len, host.split("."))), sum(map(str.isupper, url)), len(fragment), url.startswith("https"),
        )
    return out


class Trees:
    """Gradient-boosted trees of fixed depth for the logistic loss, on binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE):
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = self._bin(x)
        mean = min(max(y.mean(), 1e-6), 1 - 1e-6)
        self.base, self.trees, self.depth = float(np.log(mean / (1 - mean))), [], depth
        f = np.full(len(y), self.base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-f))
            grad, hess = y - p, p * (1 - p)
            feature, cut, node = np.zeros(2**depth, int), np.full(2**depth, BINS), np.ones(len(y), int)
            for level in range(depth):
                for m in range(2**level, 2 ** (level + 1)):
                    at = node == m
                    feature[m], cut[m] = self._split(binned[at], grad[at], hess[at])
                node = 2 * node + (binned[np.arange(len(y)), feature[node]] > cut[node])
            leaf = node - 2**depth
            value = rate * np.bincount(leaf, grad, 2**depth) / (np.bincount(leaf, hess, 2**depth) + 1)
            self.trees.append((feature, cut, value))
            f += value[leaf]

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x.T, strict=True)], 1) if len(x) else np.zeros(x.shape, int)

    @staticmethod
    def _split(b: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[int, int]:
        best, out = 1e-9, (0, BINS)
        if len(b) < 2 * LEAF:
            return out
        g_all, h_all = grad.sum(), hess.sum()
        for j in range(b.shape[1]):
            g, h, n = (np.cumsum(np.bincount(b[:, j], w, BINS))[:-1] for w in (grad, hess, np.ones(len(b))))
            gain = g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
            gain[(n < LEAF) | (len(b) - n < LEAF)] = 0
            k = int(gain.argmax())
            if gain[k] > best:
                best, out = gain[k], (j, k)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        binned, f = self._bin(x), np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.ones(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + (binned[np.arange(len(x)), feature[node]] > cut[node])
            f += value[node - 2**self.depth]
        return 1 / (1 + np.exp(-f))


class UrlModel:
    """Shares, trees and the score from which on a url is blocked, from labelled urls. Folds go by the urls' CRC-32, so they don't hang on the order."""

    def __init__(self, urls: list[str], blocked: list[int]):
        y = np.array(blocked, float)
        self.usual = float(y.mean()) if len(y) else 0.0
        self.trees, self.cut, keys = None, 0.5, [keys_of(u) for u in urls]
        self.shares = Shares(keys, y, self.usual)
        fold = np.array([zlib.crc32(u.encode()) % FOLDS for u in urls], int)
        if not 0 < self.usual < 1:
            return
        plain = features(urls)

        def inside(rows: np.ndarray) -> np.ndarray:
            """Shares of the rows, each from the other folds of these rows."""
            out = np.full((len(rows), len(KEYS)), self.usual)
            for f in range(FOLDS):
                own, other = fold[rows] == f, rows[fold[rows] != f]
                out[own] = Shares([keys[k] for k in other], y[other], self.usual).of([keys[k] for k in rows[own]])
            return out

        def trees(rows: np.ndarray) -> Trees:
            own = inside(rows)
            masked = [np.hstack([plain[rows], np.where(known, own, self.usual)]) for known in KNOWN]
            return Trees(np.concatenate(masked), np.tile(y[rows], len(KNOWN)))

        scores = np.full(len(y), self.usual)
        for f in range(FOLDS):
            rest, own = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if len(own) and 0 < y[rest].mean() < 1:
                seen = Shares([keys[k] for k in rest], y[rest], self.usual).of([keys[k] for k in own])
                scores[own] = trees(rest).score(np.hstack([plain[own], seen]))
        self.cut = best_cut(scores, y)
        self.trees = trees(np.arange(len(y)))

    def score(self, urls: list[str]) -> np.ndarray:
        if self.trees is None or not urls:
            return np.full(len(urls), self.usual)
        return self.trees.score(np.hstack([features(urls), self.shares.of([keys_of(u) for u in urls])]))


def best_cut(scores: np.ndarray, y: np.ndarray) -> float:
    """The score from which on urls are blocked with the greatest F1: the middle of the gap there, of equal ones the gap nearest to a half."""
    order = np.argsort(-scores, kind="stable")
    s, hit = scores[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(s) + 1) + y.sum())
    low = np.append(s[1:], 0.0)
    f1[low == s] = 0
    return min((abs(c - 0.5), c) for c in ((s + low) / 2)[f1 >= f1.max() - 1e-12].tolist())[1]


def fit(pages: DataFrame, url_col: str = "url", rules: tuple[tuple[str, str], ...] = RULES, sample: int = SAMPLE) -> UrlModel:
    """The trees, from about ``sample`` distinct urls that a rule decides, at most: what reaches the driver is of that size, however many rows and tasks there are."""
    host, path = parts(F.col("u"))
    known = pages.select(F.col(quoted(url_col)).alias("u")).select("u", rule_of(host, path, rules).alias("rule")).where("rule is not null").select("u", (F.col("rule.verdict") == "block").cast("int").alias("y"))
    # urls whose hash lies below a bound that lets a few more than needed through, by an estimate of how many different ones there are
    n = known.agg(F.approx_count_distinct("u", 0.01)).first()[0]
    bound = int(2**62 * min(1.0, 1.1 * (sample + 500) / max(1, n)))
    rows = known.where(F.pmod(F.xxhash64("u"), F.lit(2**62)) < F.lit(bound)).distinct().orderBy(F.pmod(F.xxhash64("u"), F.lit(2**62)), "u").limit(sample).collect()
    return UrlModel([r.u for r in rows], [r.y for r in rows])


def verdicts(pages: DataFrame, model: UrlModel, id_col: str = "page_id", url_col: str = "url", rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """(id, host, path, rule, verdict, score) of each page."""
    kind = dict(pages.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            urls = b.column("u").to_pylist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score([u or "" for u in urls]), pa.float64())], ["i", "u", "score"])

    rated = pages.select(F.col(quoted(id_col)).alias("i"), F.col(quoted(url_col)).alias("u")).mapInArrow(run, f"i {kind}, u string, score double")
    own = F.when(F.col("score") >= model.cut, "block").otherwise("allow")
    host, path = parts(F.col("u"))
    ruled = rated.select("i", "score", host.alias("host"), path.alias("path"), rule_of(host, path, rules).alias("rule"))
    return ruled.select(F.col("i").alias(id_col), "host", "path", F.col("rule.rule").alias("rule"), F.coalesce("rule.verdict", own).alias("verdict"), "score")
