import pytest

from docquill.llm import firsts, lines

SPACE = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=10):
    """id, n_lines, n_dropped, kept of (id, text) rows."""
    held = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            k = line.strip(SPACE).translate(LOWER)
            held.setdefault(k, []).append((i is None, i))
    out = []
    for i, text in rows:
        all_lines = (text or "").split("\n")
        keys = [x.strip(SPACE).translate(LOWER) for x in all_lines]
        kept = [x for x, k in zip(all_lines, keys, strict=True) if len(k) < least or min(held[k], key=str) == (i is None, i) or min(h[1] for h in held[k] if h[1] is not None) == i]
        out.append((i, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


ROWS = [
    (5, "A common line here\nown line of five\n\tA COMMON line here \r\nshort\nshort"),
    (2, "a common line here\na common line here\nshort"),
    (9, "own line of five\n\n\n"),
    (7, None),
    (1, ""),
    (3, "é common line\nÉ common line\n123456789\n 1234567890 \n" + "x" * 50_000),
    (4, "É common line\n123456789\n1234567890\x85\n1234567890\n" + "x" * 50_000),
    (6, "\n".join(f"line number {i % 150}" if i % 3 else "twice told line" for i in range(700))),
    (8, "\n".join(f"line number {i}" for i in range(400)) + "\ntwice told line"),
    (8, "\n".join(f"line number {i}" for i in range(400)) + "\ntwice told line"),
    (8, "another text with the id 8\ntwice told line"),
    (None, "another text with the id 8\nfor no id at all"),
    (None, "for no id at all"),
]


def shown(df):
    return sorted(((r.id, r.n_lines, r.n_dropped, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("least", [1000, 3])
def test_against_brute_force_with_and_without_hot_keys(spark, monkeypatch, least):
    monkeypatch.setattr(firsts, "LEAST", least)
    df = spark.createDataFrame([(i, t, "x") for i, t in ROWS], "doc_id long, text string, body string")
    assert shown(lines.drop_repeated_lines(df)) == brute(ROWS)


def test_ids_may_be_text_and_tables_empty(spark):
    df = spark.createDataFrame([("b", "one line of some length"), ("a", "one line of some length")], "doc_id string, text string")
    assert shown(lines.drop_repeated_lines(df)) == [("a", 1, 0, "one line of some length"), ("b", 1, 1, "")]
    assert lines.drop_repeated_lines(df.limit(0)).count() == 0


def test_bitmaps_leave_whole_words_out(spark):
    text = "\n".join(f"a line of its own {i}" for i in range(1000))
    df = spark.createDataFrame([(1, "the line they share"), (2, text + "\nthe line they share")], "doc_id long, text string")
    [row] = lines.keep_bitmaps(df).collect()
    assert (row.id, row.n_dropped) == (2, 1)
    assert [(w.word, w.bits) for w in row.keep] == [(15, ~(1 << 40))]


def test_no_python_runs(spark):
    df = spark.createDataFrame([(1, "the line they share"), (2, "the line they share")], "doc_id long, text string")
    plan = lines.drop_repeated_lines(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    plan = lines.keep_bitmaps(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "rangepartitioning(hash" in plan
