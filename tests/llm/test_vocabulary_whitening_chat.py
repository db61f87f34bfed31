"""Spelling variants, whitening and chat formatting against brute force and round trips."""

from __future__ import annotations

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.llm import chat, queries, spelling, whitening

# --- spelling -----------------------------------------------------------------------------------


def one_edit(u: str, v: str) -> bool:
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    short, long = sorted((u, v), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def counted(rows: list[tuple], change: bool) -> Counter:
    words: Counter = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if change and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                words[run] += 1
    return Counter({w: n for w, n in words.items() if n >= 5})


def expected_variants(words: dict[str, int]) -> set[tuple]:
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def random_texts(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    base = ["".join(rng.choice("abéÀz") for _ in range(rng.randint(6, 9))) for _ in range(25)]
    rows = []
    for doc in range(40):
        said = []
        for _ in range(120):
            word = rng.choice(base[: rng.randint(1, 25)])
            if rng.random() < 0.2:
                at = rng.randrange(len(word))
                word = word[:at] + rng.choice(["", "a", "b" + word[at]]) + word[at + 1 :]
            said.append(rng.choice([word, word, word.upper()]))
        rows.append((doc, rng.choice([" ", ", ", "\n", "7"]).join(said)))
    rows += [(None, "Straßen " * 9), (100, None), (101, ""), (102, "×÷×÷×÷ " * 5), (103, "x" * 5000 + " "), rows[0], rows[0]]
    rows += [(200 + i, "y" * 3000 + " " + "y" * 3001) for i in range(5)]
    return rows


def test_the_index_finds_exactly_the_words_one_edit_away():
    rng = random.Random(5)
    for _ in range(60):
        words = list({"".join(rng.choice("abà") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(1, 150))})
        left, right = spelling.one_edit_pairs(words)
        found = list(zip(left.tolist(), right.tolist(), strict=True))
        assert len(found) == len(set(found))
        assert set(found) == {(i, j) for i, u in enumerate(words) for j, v in enumerate(words) if u != v and one_edit(u, v)}


def test_variants_equal_brute_force(spark, monkeypatch):
    rows = random_texts(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("word", "n", "run", "id", "form", "root", "n_near"):
        docs = docs.withColumn(name, F.lit("clash"))
    words = spelling.count_words(docs, queries.misprint)
    want = counted(rows, True)
    assert {(r["word"], r["n"]) for r in words.collect()} == set(want.items())
    assert {tuple(r) for r in spelling.variants(words).collect()} == expected_variants(want)
    # halves that are split into cells give the same
    monkeypatch.setattr(spelling, "CELL_WORDS", 2)
    assert {tuple(r) for r in spelling.variants(words).collect()} == expected_variants(want)


def test_small_blocks_give_the_same_pairs(monkeypatch):
    import pyarrow as pa

    rng = random.Random(8)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(5, 8))) for _ in range(200)})
    rows = [(m, t, (w[-(m // 2) :] if t else w[: m // 2]), 0, 0, 0, w, 1) for w in words for m in (len(w) - 1, len(w)) for t in (False, True)]
    rows.sort(key=lambda r: r[:3])
    names = ["shorter", "tail", "half", "low", "high", "part", "word", "n"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows[i : i + 70]]) for i in range(0, len(rows), 70)]
    want = sorted((u, v) for u in words for v in words if u != v and one_edit(u, v))
    for size in (1, 30, 5000):
        monkeypatch.setattr(spelling, "BLOCK_WORDS", size)
        found = [(r["word"], r["near"]) for b in spelling._search(iter(batches)) for r in b.to_pylist()]
        assert sorted(found) == want


def test_no_words_give_no_variants(spark):
    docs = spark.createDataFrame([(1, None), (2, "a b c")], "doc_id long, text string")
    assert spelling.variants(spelling.count_words(docs)).collect() == []
    assert spelling.variants(spelling.count_words(docs.limit(0))).collect() == []
    with pytest.raises(ValueError):
        spelling.variants(spelling.count_words(docs), ratio=1)


def test_roots_follow_long_chains(spark):
    chain = spark.createDataFrame([(f"w{i:02}", f"w{i + 1:02}" if i < 40 else None) for i in range(41)], "word string, form string")
    assert {tuple(r) for r in spelling.roots(chain).collect()} == {(f"w{i:02}", "w40") for i in range(40)}


# --- whitening ----------------------------------------------------------------------------------


def spectra(seed: int):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    yield np.cov(rng.standard_normal((300, 30)).T)
    yield np.cov((rng.standard_normal((300, 30)) * np.logspace(0, -6, 30)).T)
    yield q @ np.diag([3.0] * 5 + [1.0] * 25) @ q.T
    yield q @ np.diag(np.r_[1 + 1e-10 * np.arange(8), np.linspace(0.1, 0.9, 22)]) @ q.T
    yield np.eye(30) * 2
    yield np.diag(np.r_[5.0, np.zeros(29)])
    yield np.zeros((4, 4))
    yield np.array([[7.0]])


def test_inertia_counts_eigenvalues():
    for a in spectra(1):
        a = (a + a.T) / 2
        values = np.linalg.eigvalsh(a)
        for shift in [-1.0, *(values[:-1] + values[1:]) / 2, values[-1] + 1]:
            if np.abs(values - shift).min() > 1e-12:
                assert whitening.above(a, shift) == (values > shift).sum()


def test_spectrum_slicing_equals_a_full_decomposition():
    for a in spectra(2):
        a = (a + a.T) / 2
        values, vectors = whitening.leading(a, 16)
        k, scale = len(values), max(np.abs(a).max(), 1e-300)
        np.testing.assert_allclose(values, np.linalg.eigvalsh(a)[::-1][:k], atol=1e-13 * scale)
        kept = values > 1e-12 * scale
        v = vectors[:, kept]
        assert np.abs(a @ v - v * values[kept]).max(initial=0) <= 1e-13 * scale
        assert np.abs(v.T @ v - np.eye(v.shape[1])).max(initial=0) <= 1e-9


def test_products_are_exact_at_any_size():
    rng = np.random.default_rng(3)
    for top, rows in ((1 << 8, 1000), (1 << 24, 3000), (1 << 31, 50), (1 << 62, 7)):
        x, y = rng.integers(-top, top, (rows, 3)), rng.integers(-top, top, (rows, 2))
        assert (whitening.exact_product(x, y) == x.astype(object).T @ y.astype(object)).all()


def vectors_table(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.2 + j / 10) for j in range(20)]) for i in range(150)]
    rows += [(500 + i, rows[i][1]) for i in range(30)] + [rows[0], (None, rows[3][1])]
    rows += [(900, None), (901, [None] + [0.5] * 19), (902, [float("nan")] + [0.5] * 19), (903, [float("inf")] + [0.5] * 19)]
    rows += [(904, []), (905, [1e30] * 20)] + [(910 + i, [rng.random(), 2.0, rng.random()]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for name in ("x", "n", "component", "dim", "row", "label"):
        df = df.withColumn(name, F.lit("clash"))
    return rows, df


def test_whitening_equals_exact_arithmetic(spark):
    rows, df = vectors_table(spark)
    found = whitening.whiten(df).collect()
    whole = lambda c: math.floor(Fraction(float(np.float32(c))) * 64) + 1_000_000
    sound = [(i, tuple(whole(c) for c in v)) for i, v in rows if v and all(c is not None and math.isfinite(c) and abs(c) < 1e17 for c in v)]
    for dim, k in ((20, 16), (3, 2)):
        own = [(i, x) for i, x in sound if len(x) == dim]
        fit = sorted({x for _, x in own})
        n, sums = len(fit), [sum(column) for column in zip(*fit, strict=True)]
        wide = np.array([[Fraction(n * e - s, n) for e, s in zip(x, sums, strict=True)] for x in fit], object)
        cov = (wide.T @ wide / n).astype(float)
        values, basis = np.linalg.eigh(cov)
        values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
        by_id: dict = {}
        for r in found:
            if (r["vec_id"] in {i for i, _ in own}) and r["n"] == n:
                by_id.setdefault(r["vec_id"], []).append(r)
        assert sum(len(v) for v in by_id.values()) == len(own) * k
        signs = None
        for i, x in own:
            mine = sorted(by_id[i], key=lambda r: r["component"])[:: len(by_id[i]) // k]
            assert [r["component"] for r in mine] == list(range(1, k + 1))
            assert {int(r["deviation"]) for r in by_id[i]} == {sum((n * e - s) ** 2 for e, s in zip(x, sums, strict=True))}
            want = np.array([float(Fraction(n * e - s, n)) for e, s in zip(x, sums, strict=True)]) @ basis / np.sqrt(values)
            got = np.array([r["whitened"] for r in mine])
            signs = np.sign(want * got) if signs is None else signs
            np.testing.assert_allclose(got * signs, want, atol=1e-9)
            np.testing.assert_allclose([r["explained"] for r in mine], values / np.trace(cov), rtol=1e-9)
            assert max(r["identity_error"] for r in mine) < 1e-9
    assert {r["vec_id"] for r in found} == {i for i, x in sound}


def test_whitening_of_nothing_and_of_equal_vectors(spark):
    none = spark.createDataFrame([(1, None), (2, [])], "vec_id long, embedding array<float>")
    assert whitening.whiten(none).collect() == []
    assert whitening.whiten(none.limit(0)).collect() == []
    same = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(9)], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).collect() == []  # no variance, no component


# --- chat ---------------------------------------------------------------------------------------

RECORDS = [
    ({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "q"}]}, [("system", "s"), ("user", "q")]),
    ({"id": 3, "messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]}, [("user", "ab")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [("user", "q"), ("assistant", "a")]),
    ({"instruction": "do", "input": "it", "output": "done"}, [("user", "do\n\nit"), ("assistant", "done")]),
    ({"instruction": "do", "output": "done", "system": "be"}, [("system", "be"), ("user", "do"), ("assistant", "done")]),
    ({"prompt": "p", "response": None}, [("user", "p"), ("assistant", "")]),
    ({"prompt": "p", "completion": "c", "score": 1.5}, [("user", "p"), ("assistant", "c")]),
    ({"question": "p", "answer": "c"}, [("user", "p"), ("assistant", "c")]),
    ({"prompt": "p", "chosen": "c", "rejected": "r"}, [("user", "p"), ("assistant", "c")]),
    (
        {"prompt": "p", "chosen": [{"role": "user", "content": "p"}, {"role": "assistant", "content": "c"}], "rejected": [{"role": "user", "content": "p"}]},
        [("user", "p"), ("assistant", "c")],
    ),
    ({"dialog": ["a", "b", "c"]}, [("user", "a"), ("assistant", "b"), ("user", "c")]),
    ({"role": "tool", "text": "x", "turn": 4}, [("tool", "x")]),
    ({"unknown": 1}, None),
]


def test_layouts_are_chosen_by_their_paths(spark):
    rows = [(i, 0, json.dumps(r)) for i, (r, _) in enumerate(RECORDS)] + [(90, 0, "no json"), (91, 0, None), (92, 0, "[1]"), (93, 0, "{}")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, record string").withColumn("part", F.lit("clash"))
    found: dict = {}
    for r in sorted(chat.canonical_turns(df).collect(), key=lambda r: (r["conv_id"], r["part"])):
        found.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert found == {i: turns for i, (_, turns) in enumerate(RECORDS) if turns is not None}
    assert {r["conv_id"] for r in chat.unmapped(df).collect()} == {len(RECORDS) - 1, 90, 91, 92, 93}
    report = chat.schema_report(df).collect()
    assert sum(r["n"] for r in report) == len(rows)
    assert {r["layout"] for r in report} == {layout.name for layout in chat.LAYOUTS} | {None}
    assert chat.canonical_turns(df.limit(0)).collect() == []


def test_fingerprints_depend_on_paths_only():
    one = frozenset(chat.paths_of({"b": [{"x": 1}, {"y": None}], "a": "t"}))
    other = frozenset(chat.paths_of({"a": 5, "b": [{"y": [], "x": {}}]}))
    assert one == other == {"a", "b", "b[]", "b[].x", "b[].y"}
    assert chat.fingerprint(one) == chat.fingerprint(other) != chat.fingerprint(one - {"a"})


def odd_turns() -> list[tuple]:
    rng = random.Random(6)
    parts = [*chat.CHATML.controls, "\\", "\\\\", "<", "</s", "s>", "\n", "é", "日本", "😀", "", " ", "[INST", "|im_end|>", "$1", "%0A"]
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))) for c in range(12) for t in range(6)]
    rows += [(20, 0, "user", None), (20, 1, None, "x"), (20, 2, "a\nb <s>% ü", "y"), (None, 0, "assistant", "z"), (None, 0, "assistant", "z")]
    rows += [(21, None, "user", "first"), (21, 1, "assistant", "b"), (21, 1, "assistant", "a"), (22, 0, "assistant", "<s>\\" * 40_000)]
    rows += [(23, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(300)]
    return rows


def test_formatting_reads_back_and_masks(spark):
    rows = odd_turns()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(0).cast("long"))
    pieces = chat.format_turns(df.withColumn("piece", F.lit("clash")).withColumn("mask", F.lit("clash")))
    for r in pieces.collect():
        inner = r["piece"][len(chat.CHATML.begin) : -len(chat.CHATML.end)]
        assert not any(c in inner for c in chat.CHATML.controls)
    back = chat.read_back(pieces).select("conv_id", "turn", "role", "text").collect()
    plain = [(c, t, r or "", x or "") for c, t, r, x in rows]
    assert Counter(map(tuple, back)) == Counter(plain)
    want = set()
    for conv in {r[0] for r in plain}:
        own = sorted((r for r in plain if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        said, loss = "".join(f"{r}\n{x}\n" for _, _, r, x in own), "".join(x for _, _, r, x in own if r == "assistant")
        chars = sum(len(r["piece"]) for r in pieces.filter(F.col("conv_id").eqNullSafe(F.lit(conv))).collect())
        want.add((conv, len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
    assert {tuple(r) for r in chat.digests(chat.read_back(pieces)).collect()} == want
    # whole conversations in one piece are read alike
    joined = pieces.filter("conv_id < 12").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "piece", "mask"))).alias("p"))
    starts = F.aggregate("p", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("m")), lambda a, p: F.struct(
        (a["at"] + F.char_length(p["piece"])).alias("at"),
        F.concat(a["m"], F.transform(p["mask"], lambda m: F.struct((m["start"] + a["at"]).alias("start"), m["length"].alias("length")))).alias("m")))
    whole = joined.select("conv_id", F.lit(0).alias("turn"), F.lit(0).alias("part"), F.array_join("p.piece", "").alias("piece"), starts["m"].alias("mask"))
    assert {tuple(r) for r in chat.digests(chat.read_back(whole)).collect()} == {w for w in want if w[0] in range(12)}


def test_templates_that_cannot_be_told_apart_are_refused():
    with pytest.raises(ValueError):
        chat.Template("<a>", "<b>", ("<a>",))
    with pytest.raises(ValueError):
        chat.Template("aba", "aXb", ("aba", "aXb"))


def test_no_turns_give_no_conversation(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, part long, role string, text string")
    assert chat.digests(chat.read_back(chat.format_turns(none))).collect() == []
