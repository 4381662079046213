import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from docquill.llm import catalog, pii
from tests.conftest import SF_SMALL


def plain(text):
    """The base as the definition reads."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return out


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["1", "25", "4111111111111111", "@", ".", "-", " ", "+", "a", "(", "x.y", "é", "\n", "+12 345 678 90"]), max_size=25))
def test_scanners_find_what_the_definition_says(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == plain(text)


HIDDEN = [
    ("mail john (at) example (dot) com now", "email", "john (at) example (dot) com"),
    ("or john dot doe at example dot com.", "email", "john dot doe at example dot com"),
    ("jоhn＠exаmple．com", "email", "jоhn＠exаmple．com"),
    ("x jo​hn@exa­mple.com!", "email", "jo​hn@exa­mple.com"),
    ("call plus four four two zero seven nine four six zero one two three end", "phone", "plus four four two zero seven nine four six zero one two three"),
    ("é ４１１１ 1111 1111 1111 é", "card", "４１１１ 1111 1111 1111"),
    ("card 4lll 1111 1111 1111 x", "card", "4lll 1111 1111 1111"),
    ("eins neun zwei punkt eins sechs acht punkt eins punkt zwei", "ip", "eins neun zwei punkt eins sechs acht punkt eins punkt zwei"),
    ("ip １９２.１６８.１.１ ok", "ip", "１９２.１６８.１.１"),
    ("write to jo.34 at mail7.example.com today", "email", "jo.34 at mail7.example.com"),
    ("defanged jo[@]example[.]com", "email", "jo[@]example[.]com"),
    ("host 192[.]168[.]1[.]1 up", "ip", "192[.]168[.]1[.]1"),
    ("host 192 dot 168 dot 1 dot 20 up", "ip", "192 dot 168 dot 1 dot 20"),
    ("host l92.168.O.1 up", "ip", "l92.168.O.1"),
    ("tel +1 (2l3) 555-O123.", "phone", "+1 (2l3) 555-O123"),
]


def test_disguises_are_found_at_their_place_in_the_source():
    for text, kind, want in HIDDEN:
        assert [(k, text[a:b]) for k, a, b, added in pii.find_spans(text) if added] == [(kind, want)], text


def test_clean_texts_stay_clean():
    for text in ["look at example.com please", "we met at noon dot", "one two three", "I was at home. Two of us", "ended at noon.The rest", "v1.2.3 dot", "1.5 dot 2", "+Ill Ollie (of) Ill", "É at ö dot ü", "un deux", "a @ b", "m² 10²"]:
        assert pii.find_spans(text) == [], text


def test_base_spans_stay_and_mask_covers_all():
    text = "a@b.co, " + HIDDEN[0][0] + " 1.2.3.4"
    spans = pii.find_spans(text)
    assert [s[:3] for s in spans if not s[3]] == plain(text)
    assert pii.mask(text, spans) == "[EMAIL], mail [EMAIL] now [IP]"


def test_long_texts_are_linear():
    for text in ("1" * 200_000, "a" * 200_000, "1.2." * 50_000, "+1 " * 60_000, "a@" * 60_000, "one " * 30_000, "O" * 99_999):
        pii.find_spans(text)


def test_query(spark):
    rows = catalog.QUERIES["op3_deobfuscated_pii"](spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == s[0] for s in base) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()


def test_nulls_repeats_and_clashing_names(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "a@b.co", 5), (3, "a@b.co", 5), (None, "x", 5)], "doc_id int, text string, found int")
    rows = pii.find_pii(df, keep=["doc_id"], masked=True).collect()
    assert sorted((r.doc_id or 0, len(r.found), r.masked) for r in rows) == [(0, 0, "x"), (1, 0, ""), (2, 0, ""), (3, 1, "[EMAIL]"), (3, 1, "[EMAIL]")]
    assert pii.find_pii(df.limit(0)).count() == 0


def test_very_long_numbers_with_leading_zeros():
    for text in ("0" * 5000 + "1.1.1.1", "1.1.1." + "0" * 9000, "9" * 5000 + ".1.1.1"):
        ips = [s for s in pii.find_spans(text) if s[0] == "ip" and not s[3]]
        assert ips == ([] if text[0] == "9" else [("ip", 0, len(text), False)])


def test_disguises_planted_in_texts_are_found():
    """Recall on disguised addresses and numbers that no pattern was written after: every kind, in the middle of words."""
    import random

    rng = random.Random(11)
    words = "the of report and house with river many often und nicht avec para".split()
    spelled = dict(zip("0123456789", "zero one two three four five six seven eight nine".split(), strict=True))
    caught = total = 0
    for _ in range(300):
        name, host = ("".join(rng.choices("bcdfgklmnprstuvw", k=rng.randint(4, 8))) for _ in range(2))
        kind = rng.choice(["email", "ip", "phone"])
        if kind == "email":
            at, dot = rng.choice([(" at ", " dot "), ("[at]", "[dot]"), (" (at) ", " (dot) "), ("@", "[.]")])
            planted = f"{name}{at}{host}{dot}com"
        elif kind == "ip":
            planted = rng.choice([" dot ", "[.]", "(.)"]).join(str(rng.randrange(10, 255)) for _ in range(4))
        else:
            planted = "plus " + " ".join(spelled[rng.choice("0123456789")] for _ in range(11))
        before, after = (" ".join(rng.choices(words, k=12)) for _ in range(2))
        text = f"{before}, {planted}, {after}"
        spans = [s for s in pii.find_spans(text) if s[3] and s[0] == kind]
        total += 1
        caught += any(a < len(before) + 2 + len(planted) and b > len(before) + 2 for _, a, b, _ in spans)
    assert caught >= 0.9 * total, (caught, total)
