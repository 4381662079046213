import hashlib
import tracemalloc

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from docquill.llm import bpe, catalog
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PLAIN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
ODD = ["", " ", "\n\n  x", "naïve café 北京 😀👩‍👩‍👧", "a" * 3000, "<|endoftext|>", "it's  we'll\t ", "\u0000\u0001", "é" * 50, "1234567 ١٢٣"]


def ids_of(texts):
    return [np.frombuffer(b, np.int32).tolist() for b in bpe.Encoder(PATH, public_tokenizers.PATTERN).encode(texts)]


def test_odd_texts_as_tiktoken():
    assert ids_of(ODD) == [PLAIN.encode_ordinary(t) for t in ODD]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_any_text_as_tiktoken_and_back(texts):
    got = ids_of(texts)
    assert got == [PLAIN.encode_ordinary(t) for t in texts]
    table = bpe.token_bytes(PATH)
    assert [b"".join(table[i] for i in ids).decode() for ids in got] == texts


def test_offsets_cover_split_characters(spark):
    df = spark.createDataFrame([(1, "é😀 ok"), (2, None), (3, "")], "doc_id long, text string").selectExpr("*", "7 as ids", "8 as decoded")
    rows = {r.doc_id: r for r in bpe.encode(df, PATH, public_tokenizers.PATTERN, keep=["doc_id"], offsets=True).collect()}
    assert rows[2].ids == rows[3].ids == rows[2].starts == []
    one, table = rows[1], bpe.token_bytes(PATH)
    for i, a, b in zip(one.ids, one.starts, one.ends, strict=True):
        assert table[i] in "é😀 ok"[a:b].encode()
    assert one.starts[0] == 0 and one.ends[-1] == 5


def test_split_character_decodes_whole(spark):
    ids = PLAIN.encode_ordinary("😀")
    assert len(ids) > 1
    df = spark.createDataFrame([(1, ids), (2, ids[:1]), (3, None)], "doc_id int, ids array<int>")
    back = bpe.decode(df, PATH, keep=["doc_id"]).select("doc_id", bpe.decode_text("decoded").alias("t")).collect()
    got = {r.doc_id: r.t for r in back}
    assert got[1] == "😀" and got[3] == "" and "�" in got[2]


def test_query_and_empty_table(spark):
    rows = catalog.QUERIES["op10_byte_bpe"](spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids = PLAIN.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(texts[r.doc_id] or ""))
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(none, PATH, public_tokenizers.PATTERN), PATH).count() == 0


def test_memory_is_not_copied_for_long_pieces():
    encoder = bpe.Encoder(PATH, public_tokenizers.PATTERN)
    encoder.seen = {str(i): b"" for i in range(200_000)}
    long = "a" * (bpe.LONGEST + 1)
    tracemalloc.start()
    got = [np.frombuffer(b, np.int32).tolist() for b in encoder.encode(["short words", long])]
    assert tracemalloc.get_traced_memory()[1] < 1 << 20
    tracemalloc.stop()
    assert got == [PLAIN.encode_ordinary("short words"), PLAIN.encode_ordinary(long)]
    assert long not in encoder.seen and "short" in encoder.seen
