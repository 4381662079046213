"""Names found in texts by an automaton: one walk over a text, whatever the number of names.

The names make a trie, each of whose nodes knows where to go on when a letter doesn't fit (Aho-Corasick). A text is walked once and tells
every name that ends at any of its places. Names are taken in blocks of bounded size, each block one automaton and one pass
over the texts; a block's distinct names are what a task sends on, once each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names of an automaton, and characters of them, at most.
BLOCK_NAMES, BLOCK_CHARS = 200_000, 8_000_000


def _blocks(names: Iterator[str]) -> Iterator[list[str]]:
    block, size = [], 0
    for name in names:
        block.append(name)
        size += len(name)
        if len(block) >= BLOCK_NAMES or size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def names_in(df: DataFrame, text: str, names: DataFrame, name: str = "name") -> DataFrame:
    """The distinct names (lower case) that occur anywhere in a lower-cased text. Empty and null names occur nowhere."""
    listed = names.select(F.lower(F.col(name)).alias("name")).where("name <> ''").distinct()
    rows = df.where(F.col(text).isNotNull()).select(F.lower(F.col(text)).alias("body"))
    out = None
    for block in _blocks(r["name"] for r in listed.toLocalIterator()):
        shared = df.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            import ahocorasick

            walker = ahocorasick.Automaton()
            for word in shared.value:
                walker.add_word(word, word)
            walker.make_automaton()
            found: set[str] = set()
            for batch in batches:
                for body in batch.column("body"):
                    found.update(word for _, word in walker.iter(body.as_py()))
            yield pa.RecordBatch.from_pydict({"name": pa.array(sorted(found), pa.string())})

        part = rows.mapInArrow(run, "name string")
        out = part if out is None else out.unionByName(part)
    return out.distinct() if out is not None else listed.limit(0)
