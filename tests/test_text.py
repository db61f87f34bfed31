import random

import pytest
from pyspark.sql import functions as F

from corpusforge.functions import text as tx


def values(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["v"] for r in df.select("i", expr.alias("v")).orderBy("i").collect()]


def packed(text, size):
    """The packing rule in plain words: first separator present, greedy, parts never cut."""
    if len(text) <= size:
        return [text]
    sep = next((s for s, _ in tx.SEPARATORS if s in text), None)
    if sep is None:
        return [text[i : i + size] for i in range(0, len(text), size)]
    done, current = [], ""
    for part in text.split(sep):
        if not current:
            current = part
            continue
        grown = (current + sep + part).strip()
        if len(grown) <= size:
            current = grown
        else:
            done.append(current)
            current = part
    return done + [current] if current else done


def test_whitespace_is_what_python_strips():
    assert set(tx.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_chunks_on_edge_cases(spark):
    texts = [
        "", "short", "0123456789", "01234567890", "a. b. c. d. e. f", "aaaa\n\nbbbb\n\ncccc. dd",
        "a very long partwithoutblank here", "tail. ends. with. sep. ", "x" * 35, " lead. and. more. x",
        ". . . . . . .", "a  b  c  d  e  f", "\n\n\n\n\n\n\n\n\n\n\n\n", "äöü. ßßß. éé. 🤦🤦🤦. zz",
        "a \n. b\t. c .d. e", "ab\n\n \n\ncd\n\n\x1c\n\nef",
    ]
    got = values(spark, texts, tx.chunks("t", 10))
    assert got == [packed(t, 10) for t in texts]


def test_chunks_on_random_texts(spark):
    rng = random.Random(7)
    alphabet = ["a", "bb", "ccc", " ", " ", ". ", ".", "\n", "\n\n", " ", "é", "🤦"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 80))) for _ in range(1500)]
    texts += ["".join(rng.choices(alphabet[:8], k=60)) for _ in range(500)]
    for size in (10, 25):
        assert values(spark, texts, tx.chunks("t", size)) == [packed(t, size) for t in texts]


def test_strict_chunks_respect_the_size(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices("ab .\n", weights=[9, 9, 1, 1, 1], k=200)) for _ in range(100)]
    assert all(len(c) <= 10 for v in values(spark, texts, tx.chunks("t", 10, True)) for c in v)


def test_null_text_has_no_chunks(spark):
    assert values(spark, [None], tx.chunks("t")) == [None]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("docu-\nments", "documents"),
        ("café-\nété", "caféété"),
        ("a-\nb-\nc", "ab- c"),
        ("a  b", "a b"),
        ("\x1ca \n b\x1c", "a b"),
        (" \t　 ", ""),
        ("snake_-\n_case", "snake__case"),
        ("x \n\n y", "x y"),
    ],
)
def test_clean(spark, raw, clean):
    assert values(spark, [raw], tx.clean("t")) == [clean]


def test_clean_is_stable(spark):
    rng = random.Random(5)
    raw = ["".join(rng.choices("ab -\n é_", k=40)) for _ in range(300)]
    once = values(spark, raw, tx.clean("t"))
    calm = [t for t in once if "-" not in t]
    assert values(spark, calm, tx.clean("t")) == calm


def test_slugs(spark):
    assert values(spark, ["United Kingdom"], tx.slug("t")) == ["united_kingdom"]
    assert values(spark, ["  United Kingdom\n"], tx.request_slug("t")) == ["united_kingdom"]


def test_concat_forms(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    row = df.select(
        tx.strict_concat("_", "x", "y").alias("strict"), F.concat_ws("_", "x", "y").alias("loose")
    ).first()
    assert (row["strict"], row["loose"]) == (None, "a")


def test_ids_from_paths(spark):
    paths = ["/a/b/x.pdf", "x.pdf.pdf", "plain", "/a.pdf/y.pdf"]
    assert values(spark, paths, tx.path_id("t")) == ["x", "x", "plain", "y"]
    assert values(spark, ["http://h/abs/123v1"], tx.url_id("t")) == ["123v1"]
    assert values(spark, ["math/0301"], tx.file_safe_id("t")) == ["math_0301"]


def test_words_and_tokens(spark):
    texts = ["", "  ", "one", " two words ", "a\tb\nc", "Über-Weg, 2x!", "!?"]
    assert values(spark, texts, tx.word_count("t")) == [len(t.split()) for t in texts]
    counts = values(spark, texts, tx.token_count(tx.tokens("t")))
    assert counts == [0, 0, 1, 2, 3, 3, 0]


def test_contains_any(spark):
    texts = ["Ukulele", "the UK.", "none"]
    assert values(spark, texts, tx.contains_any("t", ["uk", "norway"])) == [True, True, False]
    whole = tx.contains_any("t", ["uk", "norway"], whole_word=True)
    assert values(spark, texts, whole) == [False, True, False]
