"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Base kinds (``KINDS``) are found leftmost and non-overlapping in each whole text; a match whose secret is too short is dropped. ``EXTRA`` kinds are
the method's own candidates. Every candidate's secret is hashed; over the whole corpus a hash gets the number of distinct
repositories and owners that hold it. A secret of at least ``owners`` owners and ``repositories`` repositories is a widely copied example; all
others are specific to an owner and look live. A private key is judged by its body and its span is the whole block, so a header alone is no secret. Base spans always stay; an extra span is reported if it looks live.

Spans are in code points, end exclusive: texts are cut at the matches, and lengths summed up. Texts stay in their partitions; what
is shuffled is one row per (secret, owner, repository), pre-aggregated.

Defined results: a null or empty text has no spans; a null owner counts as one owner, a null id as one repository; repeated rows each get
a row and count once; rows that share an id are told apart by their texts (128-bit digests); an empty table gives no rows; other columns aren't read, whatever
their names, and are kept by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free, looked_up, quoted, row_digest, staged


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
#: A private key's block: what lies between its header and its footer, or the base64 lines that follow a header without a footer. Repetitions are
#: possessive, so that long keys need no stack.
_FOOTER = r"-----END [A-Z ]{0,30}PRIVATE KEY-----"
_GAP = r"(?:[\s\"'>|,]|\\[nrt])"
_FIELDS = rf"(?:{_GAP}*+(?:Proc-Type|DEK-Info):\x20*[A-Za-z0-9,-]+)*+"
_LINES = rf"(?:{_GAP}*+[A-Za-z0-9+/]{{16,}}={{0,2}})*+(?:{_GAP}*+[A-Za-z0-9+/]{{1,15}}={{1,2}})?+"
_PEM = rf"-----BEGIN [A-Z ]{{0,30}}PRIVATE KEY-----([^-]*+(?:-(?!----)[^-]*+)*+(?={_FOOTER})|{_FIELDS}{_LINES})(?:{_FOOTER})?+"
#: (kind, pattern, group of the secret, its least length). A run's least length is in the pattern where no shorter match can hide a longer one.
KINDS = (
    ("assign", rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
EXTRA = (
    ("bearer", r"[Bb]earer\x20+([A-Za-z0-9._~+/=-]{20,})", 1, 20),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 32),
    ("vendor", r"(?:gh[pousr]_|glpat-|xox[abprs]-|sk_live_|sk-)[A-Za-z0-9_-]{16,}", 0, 19),
    ("pem", _PEM, 1, 16),
)
OWNERS, REPOSITORIES, BROADCAST_ROWS = 3, 3, 200_000
_SPAN = "array<struct<start:bigint,number:int,end:bigint,kind:string,secret:string>>"


def _secret(kind: str, secret: Column) -> Column:
    """What is hashed: of a private key its body only, however its lines are broken."""
    return F.regexp_replace(secret, r"\\[nrt]|[^A-Za-z0-9+/=]", "") if kind == "pem" else secret


def found(text: Column, number: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of one kind in a text."""
    p = F.lit(pattern)
    whole = F.regexp_extract_all(text, p, F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    zipped = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"))
    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc: Column, z: Column) -> Column:
        start = acc["at"] + F.char_length(z["gap"])
        end = start + F.char_length(z["whole"])
        secret = _secret(kind, F.regexp_extract(z["whole"], pattern, group) if group else z["whole"])
        span = F.struct(start.alias("start"), F.lit(number).alias("number"), end.alias("end"), F.lit(kind).alias("kind"), F.md5(secret).alias("secret"))
        out = F.when(F.char_length(secret) >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(zipped, first, step, lambda acc: acc["out"])).otherwise(F.array().cast(_SPAN))


def candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str) -> DataFrame:
    """(row key, id, owner, base spans, extra spans) of each document, without its text."""
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    base = [found(text, n, *k) for n, k in enumerate(KINDS)]
    extra = [found(text, n, *k) for n, k in enumerate(EXTRA, len(KINDS))]
    rows = docs.select(row_digest(F.col(quoted(id_col)), F.col(quoted(text_col))).alias("row"), F.col(quoted(id_col)).alias("i"), F.col(quoted(owner_col)).cast("string").alias("owner"), F.array_sort(F.concat(*base)).alias("base"), F.array_sort(F.concat(*extra)).alias("extra"))
    return staged(rows)


def ownership(rows: DataFrame) -> DataFrame:
    """(secret, repositories, owners) over the corpus."""
    held = rows.select(F.explode(F.array_distinct(F.transform(F.concat("base", "extra"), lambda s: s["secret"]))).alias("secret"), "owner", "i")
    per_owner = held.distinct().groupBy("secret", "owner").agg(F.count(F.lit(1)).alias("n"))
    return per_owner.groupBy("secret").agg(F.sum("n").alias("repositories"), F.count(F.lit(1)).alias("owners"))


def _judged(rows: DataFrame, owners: int, repositories: int) -> DataFrame:
    """(row, shared) of rows with candidates: the secrets of theirs that are widely copied."""
    wide = staged(ownership(rows).where((F.col("owners") >= owners) & (F.col("repositories") >= repositories)).select("secret"))
    held = rows.select("row", F.explode(F.array_distinct(F.transform(F.concat("base", "extra"), lambda s: s["secret"]))).alias("secret")).distinct()
    found = held.join(F.broadcast(wide), "secret") if wide.count() <= BROADCAST_ROWS else looked_up(staged(held), wide, ["secret"])
    return staged(found.groupBy("row").agg(F.collect_set("secret").alias("shared")))


def _classified(docs: DataFrame, id_col: str, text_col: str, owner_col: str, owners: int, repositories: int) -> DataFrame:
    rows = candidates(docs, id_col, text_col, owner_col)
    none = F.array().cast("array<string>")
    some = looked_up(rows.where("size(base) + size(extra) > 0"), _judged(rows, owners, repositories), ["row"], "left").withColumn("shared", F.coalesce("shared", none))
    return some.unionByName(rows.where("size(base) + size(extra) = 0").withColumn("shared", none))


def _spelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _live(spans: Column) -> Column:
    return F.filter(spans, lambda s: ~F.array_contains(F.col("shared"), s["secret"]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", owners: int = OWNERS, repositories: int = REPOSITORIES) -> DataFrame:
    """A row per document: counts and digest of the base spans, all spans, and how many secrets look live or are examples."""
    rows = _classified(docs, id_col, text_col, owner_col, owners, repositories)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    spans = F.array_sort(F.concat("base", _live(F.col("extra"))))
    return rows.select(
        F.col("i").alias(id_col), *(count(k[0]) for k in KINDS), F.sha2(_spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"), _spelled(spans).alias("spans"),
        F.size(_live(F.concat("base", "extra"))).cast("long").alias("n_live"), (F.size("base") + F.size("extra") - F.size(_live(F.concat("base", "extra")))).cast("long").alias("n_example"),
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", owners: int = OWNERS, repositories: int = REPOSITORIES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every live-looking secret's span replaced by ``mask``; widely copied examples stay."""
    rows = _classified(docs, id_col, text_col, owner_col, owners, repositories)
    row, spans = free(docs.columns, "row", "cut")
    cut = rows.where("size(base) + size(extra) > 0").select(F.col("row").alias(row), F.array_sort(_live(F.concat("base", "extra"))).alias(spans)).where(F.size(spans) > 0).dropDuplicates([row])
    cut = staged(cut)
    text = F.col(quoted(text_col))
    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        more = F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int")), F.when(s["start"] >= acc["at"], mask).otherwise(""))
        return F.struct(F.greatest(s["end"], acc["at"]).alias("at"), more.alias("out"))

    new = F.aggregate(spans, first, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    joined = docs.withColumn(row, row_digest(F.col(quoted(id_col)), text)).join(F.broadcast(cut) if cut.count() <= BROADCAST_ROWS else cut, row, "left")
    return joined.select(*(F.coalesce(new, text).alias(c) if c == text_col else F.col(quoted(c)) for c in docs.columns))
