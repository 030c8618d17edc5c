"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Base kinds are fixed patterns.  Beside them every long token that mixes letters
and digits is a candidate.  The values of both are hashed, and for each hash the distinct
repositories and owners that hold it are counted over the whole corpus.  A value
that many owners hold is a copied example; a value that few hold looks live.
Every base span gets that verdict and stays; live-looking
candidates outside the base spans are added as kind `owned`.

Offsets come from two extractions with one pattern, `gap` and `match`: running
sums of their lengths give start and end in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: The base kinds with their patterns; group 1 of the pattern is what is measured.
ASSIGN = (
    "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "(AKIA[A-Z0-9]+)"
HEX = "([0-9a-f]+)"
KINDS = {"assign": (ASSIGN, 8), "access": (ACCESS, 16), "hex": (HEX, 32)}
#: A candidate token: 20 characters or more, with a letter and a digit.
TOKEN = "([A-Za-z0-9+/_=-]+)"
MIN_TOKEN = 20
#: What at most so many owners and repositories hold looks live.
MAX_OWNERS, MAX_REPOSITORIES = 2, 3
MASK = "[SECRET]"
#: Patterns whose matches are one run of characters, and the characters of the fixed start.
ONE_RUN = {ACCESS: 4, HEX: 0, TOKEN: 0}

_SPAN = "array<struct<start:bigint,end:bigint,value:string>>"


def quick(pattern: str, least: int) -> str:
    """The pattern with the least length of its last part built in."""
    return pattern[:-2] + f"{{{least},}})"


def found(kind: str, pattern: str, least: int) -> Column:
    """Array of (start, end, value) of the matches whose group 1 is long enough, leftmost, not overlapping.

    Where a match is one run of characters, the least length can be part of the pattern, so
    that shorter runs aren't listed first: a run that is too short holds no match that is long enough.
    """
    once = pattern in ONE_RUN
    if once:
        pattern = quick(pattern, least - ONE_RUN[pattern])
    whole = F.lit(f"(?s)(.*?)(?:({pattern})|\\z)")
    parts = F.arrays_zip(F.regexp_extract_all("_text", whole, F.lit(1)).alias("g"), F.regexp_extract_all("_text", whole, F.lit(2)).alias("m"), F.regexp_extract_all("_text", whole, F.lit(3)).alias("v"))
    none = F.array().cast(_SPAN)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["g"])
        end = start + F.length(x["m"])
        hit = F.when(F.length(x["v"]) >= least, F.array(F.struct(start.alias("start"), end.alias("end"), x["v"].alias("value")))).otherwise(none)
        return F.struct(end.alias("at"), F.concat(acc["out"], hit).alias("out"))

    spans = F.aggregate(parts, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(F.col("_text").rlike(pattern if once else quick(pattern, least)), spans).otherwise(none).alias(kind)


def _tagged(spans: str, kind: str, number: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(number).alias("k"), x["end"].alias("end"), F.lit(kind).alias("kind"), F.sha2(x["value"], 256).alias("hash")))


def _joined(spans: Column, *fields: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"], *(x[f] for f in fields))), ",")


def candidates(docs: DataFrame, owner: Column, repository: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Row key, owner, repository, base spans and candidate tokens of each text."""
    data = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"), F.coalesce(owner.cast("string"), F.lit("")).alias("_owner"), F.coalesce(repository.cast("string"), F.lit("")).alias("_repository"))
    base = data.select("*", *(found(k, p, n) for k, (p, n) in KINDS.items()))
    some = "[A-Za-z0-9+/_=-]{20,}"
    tokens = F.when(F.col("_text").rlike(some), found("t", TOKEN, MIN_TOKEN)).otherwise(F.array().cast(_SPAN))
    mixed = F.filter(tokens, lambda x: x["value"].rlike("[0-9]") & x["value"].rlike("[A-Za-z]"))
    return base.withColumn("tokens", mixed).withColumn("_row", F.monotonically_increasing_id())


def scan(docs: DataFrame, owner: Column | None = None, repository: Column | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, n_assign, n_access, n_hex, n_owned, n_live, n_example, base_sha256, spans, verdicts and found (the spans as structs).

    docs: text, source, lang and `keep`; further columns are ignored.  By default the
    owner is the source, the repository a source's part in one language.  n_live and n_example count
    the base spans whose value at most MAX_OWNERS owners and MAX_REPOSITORIES repositories hold, and the others.
    verdicts lists all spans with owners, repositories and live or example.  Null text
    counts as empty; a null owner or repository as the empty one.  One row per
    input row, repeated rows included (they don't raise the ownership count).  Texts of any length
    are searched whole.  Spans that start together are listed base kinds first.
    An empty table gives no rows.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", "source", "lang") if repository is None else repository
    rows = cut(candidates(docs, owner, repository, keep).drop("_text"))
    return owned(rows, keep)


def owned(rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """What `scan` returns, from the rows of `candidates`: counts the holders of every value, and judges each span by them."""
    base = F.concat(*(_tagged(k, k, n) for n, k in enumerate(KINDS)))
    free = F.filter(_tagged("tokens", "owned", len(KINDS)), lambda t: ~F.exists("_base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    rows = rows.withColumn("_base", base)
    each = rows.select("_row", "_owner", "_repository", F.explode(F.concat("_base", free)).alias("t")).select("_row", "_owner", "_repository", "t.*")
    holders = each.select("hash", "_owner", "_repository").distinct().groupBy("hash", "_owner").agg(F.count(F.lit(1)).alias("r")).groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("r").alias("repositories"))
    judged = each.join(holders, "hash").withColumn("live", (F.col("owners") <= MAX_OWNERS) & (F.col("repositories") <= MAX_REPOSITORIES)).where(f"live or k < {len(KINDS)}")
    verdict = F.when(F.col("live"), "live").otherwise("example").alias("verdict")
    per = judged.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "k", "end", "kind", "owners", "repositories", verdict))).alias("found"))
    out = rows.select("_row", *keep).join(per, "_row", "left")
    out = out.withColumn("found", F.coalesce("found", F.array().cast(per.schema["found"].dataType))).withColumn("_base", F.filter("found", lambda x: x["k"] < len(KINDS)))

    def count(field: str, value, spans: str = "found") -> Column:
        return F.size(F.filter(spans, lambda x: x[field] == value)).cast("long")

    return out.select(
        *keep,
        *(count("k", n).alias(f"n_{k}") for n, k in enumerate((*KINDS, "owned"))),
        *(count("verdict", v, "_base").alias(f"n_{v}") for v in ("live", "example")),
        F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        _joined(F.col("found"), "owners", "repositories", "verdict").alias("verdicts"),
        "found",
    )


def masked(text: Column, spans: Column) -> Column:
    """`text` with every span (merged where they overlap) replaced by MASK."""

    def step(acc: Column, x: Column) -> Column:
        fresh = x["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, (x["start"] - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], x["end"].cast("int")).alias("at"), F.when(fresh, F.concat(acc["out"], gap, F.lit(MASK))).otherwise(acc["out"]).alias("out"))

    end = F.length(text)
    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, end)))
