"""Phrases whose words belong together, mined by Toivonen's sampling: exact counts of all frequent phrases of two and three words.

Texts are read once: A-Z lower-cased, split at [.,;:!?\\x0A-\\x0D] into pieces and those into words [^\\x20\\x09]+. They are written
as numbers of a block's own dictionary, with the dictionary's words, counts and 64-bit hashes (of language and word). All later
passes read numbers and hashes only.

1. Words are counted exactly from the blocks' dictionaries. A sample of runs of words (share = sample_words / all words, so its
   size is bounded) proposes pairs at a lowered support.
2. A full pass counts the proposed pairs and the negative border, i.e. phrases not proposed all of whose parts are proposed
   or known: the other pairs of frequent words, and the triples of proposed pairs.
3. Where a border pair turns out frequent, a further pass counts the triples of all pairs that are frequent so far, without those
   that earlier passes have counted. Passes end when none finds a frequent phrase outside the set that its border was
   drawn from; with phrases of three words that is the second at the latest.

A set of proposed or frequent phrases reaches the tasks as a bit array over hashes, 16 bits to a member and 16 MB at most. A false
member only means that a phrase too many is counted, so counts are exact whatever fits. Phrases are known by
the hashes of their words; two words with one hash are detected and the run is repeated with another seed.

Blocks are some MB each, so they are written and read one at a time, and a task has those of whole files: what it counts together
isn't shuffled apart.

A pass counts short keys of phrases first and then, by their words, only the phrases whose key is frequent. Both are counted within
blocks, then within tasks, then after the shuffle; tables with each phrase's parts are joined on their
words with hot words salted; the first ranks are taken per share of a language, then per language. So neither a common
word or phrase nor a language with most documents meets in one task.

Cases: null and empty text have no phrases; a null language is `und`; repeated rows count each; very long texts are
cut into blocks that overlap by two words, so no phrase is lost or counted twice; an empty table gives no rows; only language
and text are read, so further columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_bytes, mixed, pieces, settled, size_of, small, whole_files

#: Words of a block, and bits of a member in a bit array and of the whole array at most (as powers of two).
BLOCK, MEMBER_BITS, MOST_BITS = 1 << 20, 4, 27
#: Text bytes that a block is made of at most, if it has but one language; blocks that a task writes or reads at a time.
TEXT_BYTES, GROUP = 4 << 20, 1
#: Bits of the keys that phrases are first counted by.
KEY_BITS = 40
#: A word that more phrases than this have is salted into parts of so many; parts of a language for ranking.
HOT, PARTS = 100_000, 64

ENCODED = "lang string, codes binary, starts long, hashes array<long>, words array<string>, counts array<long>"
_COUNTS = "a long, b long, c long, n long"

_CLASS = np.zeros(256, np.uint8)
_CLASS[list(b" \t")] = 1
_CLASS[list(b".,;:!?\n\x0b\x0c\r")] = 2


def _words(texts: pa.Array) -> tuple[pa.StringArray, np.ndarray]:
    """All words of lower-cased texts, and whether each goes on in the piece of the word before."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    edges = (offsets - offsets[0])[:-1]
    kind = _CLASS[data]
    inside = kind == 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = edges[edges < len(data)]
    begins[first] = inside[first]
    at = np.flatnonzero(begins)
    # The piece of a word: separators and texts begun up to its place.
    piece = np.cumsum(kind == 2, dtype=np.int32)[at] + np.searchsorted(edges, at, side="right")
    before = np.cumsum(inside, dtype=np.int32)[at] - 1
    ends = np.append(before, inside.sum()).astype(np.int32)
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(data[inside]))
    goes_on = np.zeros(len(at), bool)
    goes_on[1:] = piece[1:] == piece[:-1]
    return words, goes_on


def _hashes(lang: str, words: list[str], seed: int) -> np.ndarray:
    start = lang.encode() + b"\0"
    return np.fromiter((xxhash.xxh3_64_intdigest(start + w.encode(), seed) for w in words), np.uint64, len(words))


def _blocks(words: pa.StringArray, goes_on: np.ndarray, lang: str, seed: int, most: int) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(words), most):
        b = min(a + most, len(words))
        end = b
        while end < min(b + 2, len(words)) and goes_on[end]:
            end += 1
        coded = words.slice(a, end - a).dictionary_encode()
        codes = coded.indices.to_numpy()
        cut = np.flatnonzero(~goes_on[a:end])
        cut = cut[cut > 0]
        own = np.bincount(codes[: b - a], minlength=len(coded.dictionary))
        starts = b - a + int((cut < b - a).sum())
        distinct = coded.dictionary.to_pylist()
        yield pa.RecordBatch.from_pydict(
            {
                "lang": [lang],
                "codes": pa.array([np.insert(codes, cut, -1).astype(np.int32).tobytes()], pa.binary()),
                "starts": pa.array([starts], pa.int64()),
                "hashes": pa.array([_hashes(lang, distinct, seed).view(np.int64)], pa.list_(pa.int64())),
                "words": pa.array([distinct], pa.list_(pa.string())),
                "counts": pa.array([own], pa.list_(pa.int64())),
            }
        )


def encode(docs: DataFrame, text: str = "text", lang: str = "lang", seed: int = 0, block: int = BLOCK) -> DataFrame:
    """Blocks of words of one language; a code of -1 ends a piece, phrases begin among the first `starts` codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", TEXT_BYTES):
            texts = pc.ascii_lower(batch.column("text"))
            for name in batch.column("lang").unique():
                words, goes_on = _words(texts.filter(pc.equal(batch.column("lang"), name)))
                yield from _blocks(words, goes_on, name.as_py(), seed, block)

    rows = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    return settled(rows.mapInArrow(run, ENCODED), "words", group=GROUP)


class Members:
    """A set of 64-bit hashes as bits: never misses a member, and may take a stranger for one."""

    def __init__(self, bits: np.ndarray, power: int):
        self.bits, self.power = bits, power

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.power)
        return (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    @classmethod
    def of(cls, keys: DataFrame, hashed: Column) -> Members:
        """Set up by Spark as words of 64 bits; at most 2^MOST_BITS bits come to the driver."""
        power = min(MOST_BITS, max(10, (keys.count() << MEMBER_BITS).bit_length()))
        at = F.shiftrightunsigned(hashed, 64 - power)
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(64)).cast("int"))
        words = keys.select(F.shiftright(at, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        bits = np.zeros(1 << (power - 6), np.uint64)
        bits[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
        return cls(bits, power)


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a ^ (b << np.uint64(1) | b >> np.uint64(63))


def _pair_key() -> Column:
    return F.col("a").bitwiseXOR(F.shiftleft("b", 1).bitwiseOR(F.shiftrightunsigned("b", 63)))


def _distinct(codes: np.ndarray, hashes: np.ndarray, width: int, here: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct phrases that begin at the places, by the hashes of their words, with their counts."""
    n = np.int64(len(hashes))
    key = codes[here].astype(np.int64)
    for k in range(1, width):
        key = key * n + codes[here + k]
    found, count = np.unique(key, return_counts=True)
    columns = []
    for _ in range(width):
        found, last = np.divmod(found, n)
        columns.insert(0, hashes[last])
    return columns, count


def _rows(columns: list[np.ndarray], count: np.ndarray) -> pa.RecordBatch:
    none = [pa.nulls(len(count), pa.int64())] * (3 - len(columns))
    return pa.RecordBatch.from_arrays([*(pa.array(c.view(np.int64)) for c in columns), *none, pa.array(count)], ["a", "b", "c", "n"])


def _key(columns: list[np.ndarray]) -> np.ndarray:
    """The first KEY_BITS bits of a hash of the phrase, last bits empty."""
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = mixed(out + c)
    return out >> np.uint64(64 - KEY_BITS) << np.uint64(64 - KEY_BITS)


def _each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            codes = np.frombuffer(batch.column("codes")[i].as_buffer(), np.int32)
            yield codes, batch.column("starts")[i].as_py(), batch.column("hashes")[i].values.to_numpy().view(np.uint64)


def propose(encoded: DataFrame, share: float, support: int, run_length: int = 1000) -> DataFrame:
    """Pairs that have the support in a sample of that share of all runs of words."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, starts, hashes in _each_block(batches):
            runs = -(-starts // run_length)
            drawn = np.random.default_rng(xxhash.xxh3_64_intdigest(codes.tobytes())).random(runs) < share
            taken = np.repeat(drawn, run_length)[:starts]
            two = np.flatnonzero((codes[:starts] >= 0) & taken)
            two = two[two < len(codes) - 1]
            yield _rows(*_distinct(codes, hashes, 2, two[codes[two + 1] >= 0]))

    counts = encoded.select("codes", "starts", "hashes").mapInArrow(draw, _COUNTS)
    return settled(counts.groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") >= support), "proposed")


Border = tuple[Members, Members]


def _within(border: Border, codes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place but the last: whether both words are members, and whether the pair is."""
    words, pairs = border
    known = words.has(hashes)
    a, b = codes[:-1], codes[1:]
    return known[a] & known[b], pairs.has(_pair_hash(hashes[a], hashes[b]))


def count_border(encoded: DataFrame, border: Border, before: list[Border], least: int) -> DataFrame:
    """Exact counts of those pairs of member words and triples of member pairs that occur `least` times, but for what a
    border before covers.

    Most phrases are rare, and a row that names three words is large. So short keys are counted first. A key that phrases share
    counts for all of them, so no frequent phrase is missed; phrases of frequent keys are then counted by their words.
    """

    def phrases(codes: np.ndarray, starts: int, hashes: np.ndarray) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        if len(codes) < 2:
            return
        valid = (codes[:-1] >= 0) & (codes[1:] >= 0)
        two, pair = _within(border, codes, hashes)
        three = (pair & valid)[:-1] & (pair & valid)[1:]
        for old in before:
            seen, seen_pair = _within(old, codes, hashes)
            two &= ~seen
            three &= ~(seen_pair[:-1] & seen_pair[1:])
        for width, here in ((2, two & valid), (3, three)):
            yield _distinct(codes, hashes, width, np.flatnonzero(here[:starts]))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _each_block(batches):
            for columns, count in phrases(*block):
                yield pa.RecordBatch.from_arrays([pa.array((_key(columns) >> np.uint64(64 - KEY_BITS)).view(np.int64)), pa.array(count)], ["key", "n"])

    blocks = encoded.select("codes", "starts", "hashes")
    keys = blocks.mapInArrow(short, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    often = Members.of(settled(keys, "keys"), F.shiftleft("key", 64 - KEY_BITS))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _each_block(batches):
            for columns, count in phrases(*block):
                kept = often.has(_key(columns))
                yield _rows([c[kept] for c in columns], count[kept])

    counts = blocks.mapInArrow(whole, _COUNTS).groupBy("a", "b", "c").agg(F.sum("n").alias("n"))
    return settled(counts.where(F.col("n") >= least), "counted")


def _dictionary(encoded: DataFrame) -> DataFrame:
    each = encoded.select("lang", F.explode(F.arrays_zip("hashes", "words", "counts")).alias("w"))
    return each.select("lang", F.col("w.hashes").alias("a"), F.col("w.words").alias("word"), F.col("w.counts").alias("n"))


def frequent(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, sample_words: int = 1_000_000, block: int = BLOCK, seeds: int = 8
) -> tuple[DataFrame, DataFrame, DataFrame, list[int]]:
    """The blocks; the frequent words (a, n, lang, word); the frequent pairs and triples (a, b, c, n; c null for pairs); and how
    many pairs each pass found frequent outside the set that its border was drawn from."""
    with batch_bytes(docs.sparkSession):
        for seed in range(seeds):
            encoded = encode(docs, text, lang, seed, block)
            with whole_files(docs.sparkSession):
                each = _dictionary(encoded)
                often = settled(each.groupBy("a").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "often")
                words = _told(each.select("lang", "a", "word"), often, ["a"]).groupBy("a", "n", "lang", "word").count().drop("count")
                words = settled(words, "frequent")
            if words.count() == often.count():
                break
        else:
            raise ValueError("different words had one hash under every seed")
        known = Members.of(often, F.col("a"))
        total = encoded.agg(F.coalesce(F.sum("starts"), F.lit(0))).first()[0]
        share = min(1.0, sample_words / max(total, 1))
        found, borders, failures = None, [], []
        with whole_files(docs.sparkSession):
            base = propose(encoded, share, max(1, int(0.8 * least * share)) if share < 1 else least)
            while True:
                border = (known, Members.of(base, _pair_key()))
                more = count_border(encoded, border, borders, least)
                found = more if found is None else found.unionByName(more)
                borders.append(border)
                pairs = found.where("c is null").select("a", "b")
                failures.append(pairs.join(base, ["a", "b"], "left_anti").count())
                if not failures[-1]:
                    return encoded, words, found, failures
                base = pairs


def _told(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows joined with their key's row: by broadcast where the keys' files are small, else with hot keys salted."""
    if size_of(keys) <= 8 << 20:
        return rows.join(F.broadcast(keys), on)
    hot = small(settled(rows.groupBy(*on).count().where(F.col("count") > HOT).select(*on, F.ceil(F.col("count") / HOT).cast("int").alias("parts")), "hot"))
    salt = F.pmod(F.xxhash64(*rows.columns), F.coalesce("parts", F.lit(1))).cast("int")
    salted = rows.join(hot, on, "left").withColumn("salt", salt).drop("parts")
    copies = keys.join(hot, on, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    return salted.join(copies, [*on, "salt"]).drop("salt")


def _named(keys: DataFrame, **to: str) -> DataFrame:
    """The keys' columns under other names."""
    return keys.select(*[F.col(c).alias(to.get(c, c)) for c in keys.columns])


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)) in whole numbers of up to 38 digits."""
    million = F.lit(1_000_000).cast("decimal(7,0)")
    number = (a.cast("decimal(15,0)") * a.cast("decimal(15,0)") * million).cast("decimal(38,0)")
    product = (left.cast("decimal(18,0)") * right.cast("decimal(18,0)")).cast("decimal(38,0)")
    return F.call_function("div", number, product)


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, top: int = 2000, sample_words: int = 1_000_000, block: int = BLOCK
) -> DataFrame:
    """Each language's first phrases: lang, rank, phrase, a, l, r, n, score.

    l and r are counts of the parts of the lowest-scoring cut, score is floor(1000000 a a / (l r)); phrases inside a
    longer one with at least half their count are left out.
    """
    encoded, words, found, _ = frequent(docs, text, lang, least, sample_words, block)
    pairs = found.where("c is null").select("a", "b", F.col("n").alias("f"))
    first = _named(words, n="f1", word="w1")
    last = words.select(F.col("a").alias("b"), F.col("n").alias("f2"), F.col("word").alias("w2"))
    pairs = settled(_told(_told(pairs, first, ["a"]), last, ["b"]), "pairs")
    triples = found.where("c is not null").select("a", "b", "c", F.col("n").alias("f"))
    head = pairs.select("a", "b", "lang", F.col("f").alias("f12"), "f1", "w1", "w2")
    tail = pairs.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("f").alias("f23"), F.col("f2").alias("f3"), F.col("w2").alias("w3"))
    triples = settled(_told(_told(triples, settled(head, "heads"), ["a", "b"]), settled(tail, "tails"), ["b", "c"]), "triples")
    # Pairs inside a triple that has at least half their count.
    inner = triples.select("a", "b", "f").unionByName(triples.select(F.col("b").alias("a"), F.col("c").alias("b"), "f"))
    longest = inner.groupBy("a", "b").agg(F.max("f").alias("longer"))
    pairs = pairs.join(longest, ["a", "b"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < 50 * F.col("f")))
    one = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"))
    cuts = [("f1", "f23"), ("f12", "f3")]
    best = F.array_min(F.array(*[F.struct(score(F.col("f"), F.col(x), F.col(y)).alias("s"), F.lit(k).alias("k"), F.col(x).alias("l"), F.col(y).alias("r")) for k, (x, y) in enumerate(cuts)]))
    two = triples.withColumn("best", best).select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("f").alias("a"), F.col("best.l").alias("l"), F.col("best.r").alias("r"))
    rows = one.unionByName(two).withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top).drop("part")
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = encoded.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
