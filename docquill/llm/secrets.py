"""Secrets in texts, judged by who owns their copies; DataFrame functions only.

Candidates are found in every whole text, leftmost and non-overlapping per kind. Base kinds: assign
(value of six characters or more), access and hex; they always count. Wider kinds: vendor (keys with
a maker's prefix, private key headers) and opaque (long strings of many different characters); they are
added only where they are live-looking: the hash of the value occurs with few owners over the whole corpus.
A value that many owners have is an example that was copied. Only 128-bit hashes of values are shuffled.

Frequencies are counted by (hash, owner, document) first, then by (hash, owner), then by hash, with partial
sums before each shuffle, so one value in a third of all documents is some rows per task.

Places: the text is split at the matches, and a fold over the lengths of the pieces and matches gives the
character at which each match starts.

Cases: null and empty text have no spans; a null owner is an owner of its own; rows with the same id,
owner and text are one document that is listed as often as it occurs; an empty table stays
empty; of further columns only the named ones are read, so they never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled, text_of

# The base kinds in the order in which they are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
VENDOR = (
    r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_(?:live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35,}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|-----BEGIN [A-Z ]*PRIVATE KEY-----"
)
OPAQUE = r"[A-Za-z0-9+/_=-]{32,}"
KINDS = ("assign", "access", "hex", "vendor", "opaque")
BASE = KINDS[:3]
#: Kind: pattern, group of the value, least characters of the value, least different characters of it.
PATTERNS = {"assign": (ASSIGN, 2, 6, 1), "access": (ACCESS, 0, 20, 1), "hex": (HEX, 0, 24, 1), "vendor": (VENDOR, 0, 1, 1), "opaque": (OPAQUE, 0, 32, 12)}

_SPANS = "array<struct<start:int,end:int>>"
_CANDIDATES = "array<struct<start:int,rank:int,end:int,kind:string,hash:binary>>"


def _places(found: Column, between: Column) -> Column:
    """Start and end of each match, from the matches and the pieces between them."""
    lengths = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("own")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        return F.struct(
            (start + x["own"]).alias("at"),
            F.concat(acc["spans"], F.array(F.struct(start.alias("start"), (start + x["own"]).alias("end")))).alias("spans"),
        )

    return F.aggregate(lengths, zero, step, lambda acc: acc["spans"])


def _candidates(kind: str, places: Column, values: Column) -> Column:
    """Those matches of a kind whose value is long and varied enough, with the value's hash."""
    _, _, least, variety = PATTERNS[kind]
    pairs = F.zip_with(places, values, lambda p, v: F.struct(p["start"].alias("start"), p["end"].alias("end"), v.alias("value")))
    pairs = F.filter(pairs, lambda c: F.length(c["value"]) >= least)
    if variety > 1:
        pairs = F.filter(pairs, lambda c: F.size(F.array_distinct(F.split(c["value"], ""))) >= variety)
    return F.transform(
        pairs,
        lambda c: F.struct(
            c["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            c["end"].alias("end"),
            F.lit(kind).alias("kind"),
            F.unhex(F.md5(c["value"].cast("binary"))).alias("hash"),
        ),
    )


def find_candidates(df: DataFrame, text: str) -> DataFrame:
    """All columns but the text, with array columns base and wide of candidates, by start, then kind as listed."""
    rest = [c for c in df.columns if c != text]
    for kind, (pattern, group, _, _) in PATTERNS.items():
        some = F.col(text).rlike(pattern)
        df = df.withColumn("_found", F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
        some = F.col("_found").isNotNull()
        value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else F.col("_found")
        df = df.withColumn("_places", F.when(some, _places(F.col("_found"), F.split(text, pattern, -1))))
        df = df.withColumn(f"_{kind}", F.when(some, _candidates(kind, F.col("_places"), value)))
    none = F.array().cast(_CANDIDATES)
    base = F.array_sort(F.concat(*[F.coalesce(f"_{k}", none) for k in BASE]))
    wide = F.concat(*[F.coalesce(f"_{k}", none) for k in KINDS if k not in BASE])
    df = df.select(*rest, base.alias("base"), wide.alias("wide"))
    # A wider candidate that overlaps a base span, or a vendor's that overlaps an opaque one, is the same text.
    free = F.filter("wide", lambda w: ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    df = df.withColumn("wide", free)
    vendor = F.filter("wide", lambda w: w["kind"] == "vendor")
    apart = F.filter("wide", lambda w: (w["kind"] == "vendor") | ~F.exists(vendor, lambda v: (v["start"] < w["end"]) & (w["start"] < v["end"])))
    return df.withColumn("wide", F.array_sort(apart))


def ownership(candidates: DataFrame, document: list[str], owner: str) -> DataFrame:
    """For each hash: n_documents and n_owners that have it."""
    each = candidates.select("hash", F.col(owner).alias("_owner"), *[F.col(c).alias(f"_d{i}") for i, c in enumerate(document)])
    by_owner = each.distinct().groupBy("hash", "_owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("n_documents"), F.count("*").alias("n_owners"))


def scan(df: DataFrame, text: str = "text", key: str = "doc_id", owner: str = "source", max_owners: int = 1) -> DataFrame:
    """Per row the key and owner with arrays base and added of struct<start, rank, end, kind, hash>, and n_live and n_example.

    added: wider candidates whose value has at most max_owners owners. n_live and n_example count the values of all
    candidates with as few owners, and with more.
    """
    rows = df.select(F.col(key).alias("_key"), F.col(owner).alias("_owner"), F.xxhash64(text_of(text)).alias("_hash"), text_of(text).alias("_text"))
    # One pass over the texts; everything after it is narrow.
    rows = settled(find_candidates(rows, "_text"), "secrets")
    own = ["_key", "_owner", "_hash"]
    each = rows.where((F.size("base") > 0) | (F.size("wide") > 0)).groupBy(*own).agg(F.first("base").alias("base"), F.first("wide").alias("wide"))
    flat = each.select(*own, F.explode(F.concat("base", "wide")).alias("c")).select(*own, "c", F.col("c.hash").alias("hash"))
    owners = settled(ownership(flat, own, "_owner"), "owners")
    live = F.col("n_owners") <= max_owners
    judged = (
        flat.join(owners, "hash")
        .groupBy(*own)
        .agg(
            F.sort_array(F.collect_list(F.when(live & (F.col("c.rank") >= len(BASE)), F.col("c")))).alias("added"),
            F.count_if(live).alias("n_live"),
            F.count_if(~live).alias("n_example"),
        )
    )
    left, right = rows.alias("l"), judged.alias("r")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in own]
    return left.join(right, same, "left").select(
        F.col("l._key").alias(key),
        F.col("l._owner").alias(owner),
        F.col("l.base").alias("base"),
        F.coalesce("r.added", F.array().cast(_CANDIDATES)).alias("added"),
        F.coalesce("r.n_live", F.lit(0)).alias("n_live"),
        F.coalesce("r.n_example", F.lit(0)).alias("n_example"),
    )
