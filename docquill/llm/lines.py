"""Lines that earlier documents hold too, as one compressed keep bitmap per document; DataFrame functions only.

A line's key is the line without white space [\\x20\\x09-\\x0D] at both ends, A-Z lower-cased. A key of min_chars code points or
more stays with the document of the smallest id that holds it, all its lines there included; every other document loses its
lines of that key. Only 128-bit hashes of keys with document and position are written and shuffled: dealt by ranges of the hash,
sorted by document and position, and streamed for first occurrences (module firsts), keys that hold a great share of all
lines apart. Lines that go are set bits of words of 64 lines; words are put together per document and those that keep all
their lines are left out. Texts aren't moved before the bitmaps are applied to them.

Cases: null and empty text are one empty line; null ids are one document that comes last; rows with one id are one document,
each with the bitmap of its own text, repeated rows included; lines of any number and length are whole; an empty table gives
no rows; only the id and the text are read, so further columns never clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled, small, text_of
from .firsts import with_first

SPACE = " \t\n\x0b\x0c\r"
WORD = 64
KEEP = "array<struct<word:int,bits:bigint>>"


def line_key(line: str | Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), string.ascii_uppercase, string.ascii_lowercase)


def _own(key: str, text: str) -> list[Column]:
    """The document's id, and a hash of its text, which tells rows with one id apart."""
    return [F.col(key).alias("id"), F.xxhash64(text_of(text)).alias("body")]


def keep_bitmaps(docs: DataFrame, text: str = "text", key: str = "doc_id", min_chars: int = 10) -> DataFrame:
    """One row for each id and text that loses lines: id, body, n_dropped, keep.

    keep: words of 64 lines in order, a set bit for a line that stays; words without a lost line are left out.
    """
    lines = docs.select(*_own(key, text), F.posexplode(F.split(text_of(text), "\n", -1)).alias("pos", "line"))
    keys = lines.select("id", "body", "pos", line_key("line").alias("key")).where(F.length("key") >= min_chars)
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("pos").alias("pos"))
    hashes = settled(keys.select("body", place.alias("place"), F.unhex(F.md5(F.col("key").cast("binary"))).alias("hash")), "lines")
    lost = with_first(hashes).where(~F.col("place.id").eqNullSafe(F.col("first.id")))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("place.pos", F.lit(WORD)).cast("int"))
    words = lost.groupBy(F.col("place.id").alias("id"), "body", F.floor(F.col("place.pos") / WORD).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("id", "body").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).cast(KEEP).alias("keep"),
    )


def kept_lines(lines: Column, keep: Column) -> Column:
    """The lines that the bitmap keeps: those between its words, and those of each word whose bit is set."""
    n = F.size(keep)

    def part(k: Column) -> Column:
        begin = F.when(k == 0, F.lit(0)).otherwise((F.get(keep, k - 1)["word"] + 1) * WORD)
        end = F.when(k == n, F.size(lines)).otherwise(F.get(keep, k)["word"] * WORD)
        between = F.slice(lines, begin + 1, F.greatest(end - begin, F.lit(0)))
        bits = F.get(keep, k)["bits"]
        own = F.filter(F.slice(lines, end + 1, F.lit(WORD)), lambda _, i: F.getbit(bits, i) == 1)
        return F.when(k == n, between).otherwise(F.concat(between, own))

    return F.flatten(F.transform(F.sequence(F.lit(0), n), part))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every row's id, n_lines before dropping, n_dropped and kept, the text of the lines that stay."""
    rows = docs.select(*_own(key, text), text_of(text).alias("text"))
    same = F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.body") == F.col("r.body"))
    met = rows.alias("l").join(bitmaps.alias("r"), same, "left").select("l.id", "l.text", "r.n_dropped", "r.keep", F.split("l.text", "\n", -1).alias("lines"))
    kept = F.array_join(kept_lines(F.col("lines"), F.col("keep")), "\n")
    return met.select(
        "id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.when(F.col("keep").isNull(), F.col("text")).otherwise(kept).alias("kept"),
    )


def drop_repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", min_chars: int = 10) -> DataFrame:
    """`apply_bitmaps` with the bitmaps of the documents themselves, written once."""
    return apply_bitmaps(docs, small(settled(keep_bitmaps(docs, text, key, min_chars), "bitmaps")), text, key)
