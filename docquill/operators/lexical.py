"""A written index of texts: postings in blocks of documents, with bounds by which blocks are skipped.

A document belongs to a block by the hash of its id. A row of the postings has a term, a block and the packed ids, counts and
lengths of the block's documents that have the term, with the largest count and the smallest length, which bound the term's
weight there. A term of every document is many rows, one per block; a file has all rows of some blocks. A batch of questions
reads the postings once and keeps those of its terms; all further steps read these. Texts are neither read nor split again.

The k best: bounds of all blocks come from the narrow columns; each question's most promising block is scored first, its k-th
score is a floor, and only blocks whose bound reaches it are scored then. Nothing that could be among the k best is left out.

Fused rankings need whole rankings: one pass over the blocks scores texts and vectors side by side and gives the candidates with
both scores, a second one counts the documents before each of them.

Questions are taken in groups of bounded size, which tasks hold in memory. Blocks are scored by numpy, one (block, group) a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..session import work_path
from .sizes import settle

# BM25 constants.
BM25_K1 = 1.2
BM25_B = 0.75
DECIMALS = 9
#: Documents of a block and bytes of their texts on average, and blocks that a task packs and writes, on average.
BLOCK_ROWS, BLOCK_BYTES, PACK_BLOCKS = 1024, 8 << 20, 4
#: Questions of a group, and bytes of their terms and vectors.
GROUP_ROWS, GROUP_BYTES = 2048, 16 << 20
MERGE_GROUPS = 64
_SLACK = 1e-8


def term_weight(tf: Column, length: Column, mean: float) -> Column:
    return tf * (BM25_K1 + 1) / (tf + BM25_K1 * (1 - BM25_B + BM25_B * length / mean))


@dataclass(frozen=True)
class TextIndex:
    """The folder of an index, with the number and mean length of its texts and its number of blocks."""

    spark: SparkSession
    path: str
    cid: str
    id_type: str
    texts: int
    mean: float
    blocks: int
    vectors: bool

    @property
    def postings(self) -> DataFrame:
        lists = f"ids array<{self.id_type}>, tfs array<int>, dls array<int>"
        return self.spark.read.schema(f"term string, block int, {lists}, n int, words long, top_tf int, least_dl int").parquet(f"{self.path}/postings")

    @property
    def packed_vectors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors")


def _packer(schema: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    def pack(table: pa.Table) -> pa.Table:
        """A block's documents (id, toks) as one row per term with the documents that have it, by id."""
        table = table.sort_by("id").combine_chunks()
        if not table.num_rows:
            return schema.empty_table()
        lists = table.column("toks").chunk(0)
        coded = lists.flatten().dictionary_encode()
        lengths = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(len(lists)), lengths)
        # Distinct (term, document), terms first, with their numbers.
        pair, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * len(lists) + doc, return_counts=True)
        term, doc = np.divmod(pair, len(lists))
        edges = np.concatenate([np.flatnonzero(np.diff(term, prepend=-1)), [len(term)]])
        starts = edges[:-1]
        offsets, dl, tf = pa.array(edges, pa.int32()), lengths[doc].astype(np.int32), tf.astype(np.int32)
        if not len(starts):
            return schema.empty_table()
        columns = [
            coded.dictionary.take(pa.array(term[starts])),
            pa.array(np.full(len(starts), table.column("block")[0].as_py(), np.int32)),
            pa.ListArray.from_arrays(offsets, table.column("id").chunk(0).take(pa.array(doc))),
            pa.ListArray.from_arrays(offsets, pa.array(tf)),
            pa.ListArray.from_arrays(offsets, pa.array(dl)),
            pa.array(np.diff(edges).astype(np.int32)),
            pa.array(np.add.reduceat(tf.astype(np.int64), starts)),
            pa.array(np.maximum.reduceat(tf, starts)),
            pa.array(np.minimum.reduceat(dl, starts)),
        ]
        return pa.Table.from_arrays(columns, names=schema.names).cast(schema)

    return pack


def build_text_index(corpus: DataFrame, cid: str = "chunk_id", ctext: str = "text", vector: str | None = None, block_rows: int | None = None) -> TextIndex:
    """Write the index of all texts that aren't null; with `vector` also the packed vectors of the blocks."""
    spark = corpus.sparkSession
    path = work_path(spark, "text-index")
    sizes = [F.count(F.lit(1)).alias("rows"), F.count(ctext).alias("texts"), F.coalesce(F.sum(F.octet_length(ctext)), F.lit(0)).alias("bytes")]
    size = corpus.agg(*sizes).first()
    blocks = max(1, -(-size.rows // (block_rows or BLOCK_ROWS)), -(-size.bytes // BLOCK_BYTES))
    id_type = corpus.schema[cid].dataType.simpleString()
    block = F.pmod(F.xxhash64(cid), F.lit(blocks)).cast("int").alias("block")
    # Texts are dealt out, not their tokens, which take several times the room; the more blocks, the more tasks.
    texts = corpus.where(F.col(ctext).isNotNull()).select(F.col(cid).alias("id"), block, F.col(ctext).alias("text"))
    toks = texts.repartition(-(-blocks // PACK_BLOCKS), "block").select("id", "block", tokens(F.col("text")).alias("toks"))
    schema = f"term string, block int, ids array<{id_type}>, tfs array<int>, dls array<int>, n int, words long, top_tf int, least_dl int"
    # Postings are written by the tasks that pack them: a block's lie in one file, and their words are counted on the way.
    told = Observation()
    packed = toks.groupBy("block").applyInArrow(_packer(arrow_schema(schema)), schema).observe(told, F.sum("words").alias("words"))
    packed.write.parquet(f"{path}/postings")
    if vector:
        rows = corpus.where(F.col(vector).isNotNull()).select(block, F.struct(F.col(cid).alias("id"), F.col(vector).cast("array<double>").alias("v")).alias("x"))
        rows = rows.groupBy("block").agg(F.collect_list("x").alias("x"))
        rows.select("block", F.col("x.id").alias("ids"), F.flatten("x.v").alias("flat")).write.parquet(f"{path}/vectors")
    return TextIndex(spark, path, cid, id_type, size.texts, (told.get["words"] or 0) / max(size.texts, 1), blocks, vector is not None)


@dataclass(frozen=True)
class Asked:
    """A group of questions as arrays: ids, and the terms with idf and the vector of each."""

    ids: list
    terms: list[list[str]]
    idfs: list[list[float]]
    vectors: list[Any]
    mean: float


def question_groups(queries: DataFrame, qid: str, row_bytes: Column) -> Iterator[DataFrame]:
    """Parts of the questions of bounded number and bytes, none without questions."""
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes.cast("long")), F.lit(0)).alias("bytes")).first()
    parts = max(1, -(-size.n // GROUP_ROWS), -(-size.bytes // GROUP_BYTES))
    for part in range(parts if size.n else 0):
        yield queries.where(F.pmod(F.xxhash64(qid), F.lit(parts)) == part) if parts > 1 else queries


def no_hits(queries: DataFrame, qid: str, cid: str, id_type: str) -> DataFrame:
    """What a search returns that nobody asks for."""
    return queries.sparkSession.createDataFrame([], f"{qid} {queries.schema[qid].dataType.simpleString()}, {cid} {id_type}, score double, rank int")


def _asked_terms(queries: DataFrame, qid: str, qtext: str) -> DataFrame:
    """(qid, term): the distinct terms of every question."""
    return queries.select(qid, F.explode(F.array_distinct(tokens(F.col(qtext)))).alias("term"))


def _asked_postings(index: TextIndex, queries: DataFrame, qid: str, qtext: str) -> DataFrame:
    """The postings of all questions' terms, written once: every group counts, bounds and scores from them."""
    terms = settle(_asked_terms(queries, qid, qtext).select("term").distinct())
    rows = index.postings.drop("words")
    path = work_path(index.spark, "asked-postings")
    rows.join(terms, "term", "left_semi").select(rows.columns).write.parquet(path)
    return index.spark.read.schema(rows.schema).parquet(path)


def _known_terms(index: TextIndex, postings: DataFrame, queries: DataFrame, qid: str, qtext: str) -> DataFrame:
    """(qid, term, idf) of the questions' distinct terms that the index has, computed once. Questions are of bounded size."""
    asked = _asked_terms(queries, qid, qtext)
    df = postings.join(F.broadcast(asked.select("term").distinct()), "term").groupBy("term").agg(F.sum("n").alias("df"))
    idf = F.ln(1 + (F.lit(index.texts) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return asked.join(df, "term").select(qid, "term", idf.alias("idf")).checkpoint()


def _asked(index: TextIndex, queries: DataFrame, terms: DataFrame, qid: str, vector: str | None) -> Asked:
    lists = terms.groupBy(qid).agg(F.collect_list(F.struct("term", "idf")).alias("t"))
    rows = queries.select(qid, *([F.col(vector).cast("array<double>").alias("v")] if vector else [])).join(lists, qid, "left").collect()
    return Asked(
        [r[qid] for r in rows],
        [[t.term for t in r.t or []] for r in rows],
        [[t.idf for t in r.t or []] for r in rows],
        [r.v if vector else None for r in rows],
        index.mean or 1.0,
    )


def _lexical_matrix(asked: Asked, mine: list[int], postings: pa.Table, ids: np.ndarray) -> np.ndarray:
    """Scores of the block's documents (columns) for some of the questions (rows); -inf is no hit."""
    by_term: dict[str, list[tuple[int, float]]] = {}
    for row, q in enumerate(mine):
        for term, idf in zip(asked.terms[q], asked.idfs[q], strict=True):
            by_term.setdefault(term, []).append((row, idf))
    out = np.zeros(len(mine) * len(ids))
    for i, term in enumerate(postings.column("term").to_pylist()):
        users = by_term.get(term)
        if not users:
            continue
        at = np.searchsorted(ids, _numpy(postings.column("ids")[i].values))
        tf = postings.column("tfs")[i].values.to_numpy().astype(float)
        norm = BM25_K1 * (1 - BM25_B + BM25_B * postings.column("dls")[i].values.to_numpy() / asked.mean)
        weight = tf * (BM25_K1 + 1) / (tf + norm)
        for row, idf in users:
            out[row * len(ids) + at] += idf * weight
    out = out.reshape(len(mine), len(ids))
    return np.where(out > 0, np.round(out, DECIMALS), -np.inf)


def dense_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """1 / (1 + squared distance) for all pairs of rows."""
    d2 = (q * q).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2.0 * (q @ c.T)
    return np.round(1.0 / (1.0 + np.maximum(d2, 0.0)), DECIMALS)


def _dense_matrix(asked: Asked, mine: list[int], packed: pa.Table, ids: np.ndarray) -> np.ndarray:
    out = np.full((len(mine), len(ids)), -np.inf)
    known = [row for row, q in enumerate(mine) if asked.vectors[q] is not None]
    if known and packed.num_rows:
        q = np.array([asked.vectors[mine[row]] for row in known], float)
        for i in range(packed.num_rows):
            own = _numpy(packed.column("ids")[i].values)
            c = packed.column("flat")[i].values.to_numpy().reshape(len(own), -1)
            out[np.ix_(known, np.searchsorted(ids, own))] = dense_scores(q, c)
    return out


def _numpy(ids: pa.Array) -> np.ndarray:
    return np.asarray(ids.to_pylist(), dtype=str) if pa.types.is_string(ids.type) else ids.to_numpy()


def _all_ids(table: pa.Table) -> np.ndarray:
    parts = [_numpy(x.values) for x in table.column("ids")]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


def best_columns(values: np.ndarray, k: int) -> np.ndarray:
    """Per row the places of the k largest values, the first of equal ones first."""
    if k < values.shape[1]:
        kth = -np.partition(-values, k - 1, axis=1)[:, k - 1 : k]
        rest = np.where(values >= kth, values, -np.inf)
        return np.argsort(-rest, axis=1, kind="stable")[:, :k]
    return np.argsort(-values, axis=1, kind="stable")


def _wanted_rows(index: TextIndex, postings: DataFrame, terms: DataFrame, vectors: bool) -> DataFrame:
    """Postings of the terms, and packed vectors, as rows of one table."""
    rows = postings.join(F.broadcast(terms.select("term").distinct()), "term", "left_semi")
    rows = rows.select("block", "term", "ids", "tfs", "dls", F.array().cast("array<double>").alias("flat"))
    if not vectors:
        return rows
    none = F.array().cast("array<int>")
    return rows.unionByName(index.packed_vectors.select("block", F.lit(None).cast("string").alias("term"), "ids", none.alias("tfs"), none.alias("dls"), "flat"))


def _over_blocks(left: DataFrame, right: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(work, schema)


def merged(hits: DataFrame, k: int, qid: str, cid: str, score: str = "score") -> DataFrame:
    """The k best of each question with rank, merged in groups of blocks first."""
    some = Window.partitionBy(qid, F.pmod("block", F.lit(MERGE_GROUPS))).orderBy(F.desc(score), cid)
    hits = hits.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k).drop("rank")
    order = Window.partitionBy(qid).orderBy(F.desc(score), cid)
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _score(index: TextIndex, asked: Asked, rows: DataFrame, pairs: DataFrame, k: int, schema: str, names: list[str]) -> DataFrame:
    def work(postings: pa.Table, who: pa.Table) -> pa.Table:
        mine, ids = who.column("number").to_pylist(), _all_ids(postings)
        if not mine or not len(ids):
            return pa.table({n: [] for n in names})
        values = _lexical_matrix(asked, mine, postings, ids)
        best = best_columns(values, k)
        found = np.take_along_axis(values, best, 1)
        row, col = np.nonzero(np.isfinite(found))
        block = postings.column("block")[0].as_py()
        who_ids = [asked.ids[mine[r]] for r in row]
        return pa.table({names[0]: who_ids, names[1]: ids[best[row, col]], "score": found[row, col], "block": np.full(len(row), block, np.int32)})

    # Only blocks that a question asks for are sent.
    rows = rows.join(pairs.select("block").distinct(), "block", "left_semi")
    return _over_blocks(rows, pairs, _cast(work, schema), schema)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def _cast(work: Callable[[pa.Table, pa.Table], pa.Table], ddl: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The same with the columns' types of the schema, also where there are no rows."""
    schema = arrow_schema(ddl)
    return lambda left, right: work(left, right).select(schema.names).cast(schema)


def lexical_topk(index: TextIndex, queries: DataFrame, k: int, qid: str = "query_id", qtext: str = "question") -> DataFrame:
    """(qid, cid, score, rank): the k best texts per question by BM25; texts without any of its terms are no hits."""
    out = None
    groups = list(question_groups(queries, qid, F.octet_length(qtext) * 4))
    if not groups:
        return no_hits(queries, qid, index.cid, index.id_type)
    postings = _asked_postings(index, queries, qid, qtext)
    for group in groups:
        hits = _lexical_group(index, postings, group, k, qid, qtext)
        out = hits if out is None else out.unionByName(hits)
    return out


def _lexical_group(index: TextIndex, postings: DataFrame, queries: DataFrame, k: int, qid: str, qtext: str) -> DataFrame:
    terms = _known_terms(index, postings, queries, qid, qtext)
    asked = _asked(index, queries, terms, qid, None)
    q_type = queries.schema[qid].dataType.simpleString()
    schema = f"{qid} {q_type}, {index.cid} {index.id_type}, score double, block int"
    numbers = index.spark.createDataFrame(list(zip(asked.ids, range(len(asked.ids)), strict=True)), f"{qid} {q_type}, number int")
    bound = F.sum(F.col("idf") * term_weight(F.col("top_tf"), F.col("least_dl"), index.mean or 1.0))
    bounds = postings.select("term", "block", "top_tf", "least_dl").join(F.broadcast(terms), "term").groupBy(qid, "block").agg(bound.alias("bound"))
    bounds = bounds.join(F.broadcast(numbers), qid).checkpoint()
    first = bounds.groupBy(qid).agg(F.max_by(F.struct("block", "number"), F.struct("bound", -F.col("block"))).alias("b")).select(qid, "b.block", "b.number")
    rows = _wanted_rows(index, postings, terms, False)
    names = [qid, index.cid]
    top = _score(index, asked, rows, first, k, schema, names).checkpoint()
    floor = top.groupBy(qid).agg(F.min("score").alias("floor"), F.count("*").alias("n")).where(F.col("n") >= k).select(qid, "floor")
    rest = bounds.join(F.broadcast(first.select(qid, "block")), [qid, "block"], "left_anti").join(F.broadcast(floor), qid, "left")
    rest = rest.where(F.col("floor").isNull() | (F.col("bound") >= F.col("floor") - _SLACK)).select("block", "number").checkpoint()
    more = _score(index, asked, rows, rest, k, schema, names)
    return merged(top.unionByName(more), k, qid, index.cid).select(qid, index.cid, "score", "rank")


def fused_topk(index: TextIndex, queries: DataFrame, k: int, offset: int, qid: str = "query_id", qtext: str = "question", vector: str = "embedding") -> DataFrame:
    """(qid, cid, score, rank): the k best by the places in the whole dense and lexical rankings.

    A row behind place 2 k + offset in both rankings scores less than the k-th of one of them scores by that place alone, so
    the rows up to there in either are all that can come first.
    """
    out = None
    groups = list(question_groups(queries, qid, F.octet_length(qtext) * 4 + F.coalesce(F.size(vector), F.lit(0)) * 8))
    if not groups:
        return no_hits(queries, qid, index.cid, index.id_type)
    postings = _asked_postings(index, queries, qid, qtext)
    for group in groups:
        hits = _fused_group(index, postings, group, k, offset, qid, qtext, vector)
        out = hits if out is None else out.unionByName(hits)
    return out


def _fused_group(index: TextIndex, postings: DataFrame, queries: DataFrame, k: int, offset: int, qid: str, qtext: str, vector: str) -> DataFrame:
    depth = 2 * k + offset
    terms = _known_terms(index, postings, queries, qid, qtext)
    asked = _asked(index, queries, terms, qid, vector)
    cid, q_type = index.cid, queries.schema[qid].dataType.simpleString()
    rows = _wanted_rows(index, postings, terms, True)
    everyone = list(range(len(asked.ids)))

    def matrices(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
        lexical, packed = table.filter(pa.compute.is_valid(table.column("term"))), table.filter(pa.compute.is_null(table.column("term")))
        ids = _all_ids(table)
        return ids, [_dense_matrix(asked, everyone, packed, ids), _lexical_matrix(asked, everyone, lexical, ids)]

    schema = f"{qid} {q_type}, {cid} {index.id_type}, dense double, lexical double, block int"

    def candidates(table: pa.Table, _: pa.Table) -> pa.Table:
        names = [qid, cid, "dense", "lexical", "block"]
        if not table.num_rows or not everyone:
            return pa.table({n: [] for n in names})
        ids, both = matrices(table)
        chosen = np.zeros(both[0].shape, bool)
        for values in both:
            best = best_columns(values, depth)
            np.put_along_axis(chosen, best, np.isfinite(np.take_along_axis(values, best, 1)) | np.take_along_axis(chosen, best, 1), 1)
        row, col = np.nonzero(chosen)
        scores = [pa.array(v[row, col], mask=~np.isfinite(v[row, col])) for v in both]
        block = np.full(len(row), table.column("block")[0].as_py(), np.int32)
        return pa.table(dict(zip(names, [[asked.ids[r] for r in row], ids[col], *scores, block], strict=True)))

    nobody = index.spark.createDataFrame([], "block int")
    found = _over_blocks(rows, nobody, _cast(candidates, schema), schema).checkpoint()
    tops = [merged(found.where(f"{side} is not null"), depth, qid, cid, side).select(qid, cid, F.col("rank").alias(f"{side}_rank")) for side in ("dense", "lexical")]
    wanted = tops[0].join(tops[1], [qid, cid], "full").join(found.select(qid, cid, "dense", "lexical"), [qid, cid]).checkpoint()

    # Places that aren't known yet are counted over all blocks.
    open_ = wanted.where("(dense is not null and dense_rank is null) or (lexical is not null and lexical_rank is null)").collect()
    place = {q: i for i, q in enumerate(asked.ids)}
    asks: list[list[tuple[Any, float | None, float | None]]] = [[] for _ in everyone]
    for r in open_:
        asks[place[r[qid]]].append((r[cid], r.dense if r.dense_rank is None else None, r.lexical if r.lexical_rank is None else None))
    count_schema = f"{qid} {q_type}, {cid} {index.id_type}, dense_before long, lexical_before long"

    def before(table: pa.Table, _: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if table.num_rows and everyone:
            ids, both = matrices(table)
            for q, mine in enumerate(asks):
                if not mine:
                    continue
                their = np.array([m[0] for m in mine])
                at = np.searchsorted(ids, their)
                counts = []
                for side, values in enumerate(both):
                    own = np.array([np.nan if m[side + 1] is None else m[side + 1] for m in mine])
                    row = values[q]
                    ordered = np.sort(row)
                    n = len(row) - np.searchsorted(ordered, own, side="right")
                    # Of equal scores, those with a smaller id come before.
                    for tied in np.flatnonzero((np.searchsorted(ordered, own, side="right") - np.searchsorted(ordered, own, side="left")) > 0):
                        n[tied] += int((row[: at[tied]] == own[tied]).sum())
                    counts.append(np.where(np.isnan(own), 0, n))
                out += [(asked.ids[q], m[0], int(a), int(b)) for m, a, b in zip(mine, *counts, strict=True)]
        names = [qid, cid, "dense_before", "lexical_before"]
        return pa.table(dict(zip(names, zip(*out, strict=True), strict=True))) if out else pa.table({n: [] for n in names})

    if open_:
        counted = _over_blocks(rows, nobody, _cast(before, count_schema), count_schema)
        counted = counted.groupBy(qid, cid).agg(F.sum("dense_before").alias("d"), F.sum("lexical_before").alias("l"))
        wanted = wanted.join(counted, [qid, cid], "left")
    else:
        wanted = wanted.withColumns({"d": F.lit(None).cast("long"), "l": F.lit(None).cast("long")})
    ranks = [F.when(F.col(side).isNotNull(), F.coalesce(f"{side}_rank", F.col(n) + 1)) for side, n in (("dense", "d"), ("lexical", "l"))]
    shares = [F.coalesce(F.lit(1.0) / (r + offset), F.lit(0.0)) for r in ranks]
    fused = wanted.select(qid, cid, F.round((shares[0] + shares[1]) * ((offset + 1) / 2.0), DECIMALS).alias("score"))
    order = Window.partitionBy(qid).orderBy(F.desc("score"), cid)
    return fused.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
