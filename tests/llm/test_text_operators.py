import collections
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusforge.llm import fingerprints, mixing, neardup, packing, quality, substrings, toxicity
from corpusforge.llm import wordarrays as wa
from tests.llm.helpers import SCHEMA, documents, edge_rows, ids_and_texts, words

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_words_follow_the_contract():
    import pyarrow as pa

    texts = [r[1] for r in edge_rows()]
    for _, _, data, offsets in wa.slices(pa.array(texts)):
        found = wa.words_of(data, offsets)
        raw = data.tobytes()
        spoken = [raw[a:b].decode() for a, b in zip(found.starts, found.ends, strict=True)]
        assert spoken == [w for t in texts for w in words(t)]
        assert found.counts.tolist() == [len(words(t)) for t in texts]
        assert len(set(found.hashes.tolist())) == len(set(spoken))


def folded(text):
    return [w.translate({i: i + 32 for i in range(65, 91)}) for w in words(text)]


def shingles(text, k):
    w = folded(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows, k):
    sets = [(i, shingles(t, k)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i, _ in sets}


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_match_brute_force(spark, width):
    rows = edge_rows()
    got = neardup.near_duplicates(documents(spark, rows), width).collect()
    want = brute_components(ids_and_texts(rows), width)
    sizes = {i: len(shingles(t, width)) for i, t in ids_and_texts(rows)}
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
        else:
            assert (r.component_id, r.n_shingles) == (want[r.doc_id], sizes[r.doc_id])
            assert r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_in_a_large_bucket(spark):
    """Near copies whose links to the smallest member are missing are linked block by block."""
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(60):
        text = list(base)
        for p in rng.choice(100, 1 + i % 4, replace=False):
            text[p] = f"n{i}x{p}"
        rows.append((i, " ".join(text), "en", "a", 1))
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(documents(spark, rows), 4).collect()}
    assert got == brute_components(ids_and_texts(rows), 4)


def test_pruning_keeps_pairs_at_the_threshold():
    cut = neardup.prune_table(80, 1e-6)
    rng = np.random.default_rng(1)
    left = rng.integers(0, 256, (2000, neardup.FINE), dtype=np.uint8)
    right = np.where(rng.random(left.shape) < 0.8, left, rng.integers(0, 256, left.shape, dtype=np.uint8))
    far = np.where(rng.random(left.shape) < 0.5, left, rng.integers(0, 256, left.shape, dtype=np.uint8))
    every = np.arange(2000)
    assert len(neardup.survivors(left, right, every, every, cut)) == 2000
    assert len(neardup.survivors(left, far, every, every, cut)) == 0


def test_repeats_match_brute_force(spark):
    rows = [r for r in edge_rows() if r[0] is not None]
    first = {}
    for i, t in ids_and_texts(rows):
        w = words(t)
        for p in range(len(w) - 19):
            first.setdefault(tuple(w[p : p + 20]), (i, p))
    want = {}
    for i, t in ids_and_texts(rows):
        w = words(t)
        gone = set()
        for p in range(len(w) - 19):
            if first[tuple(w[p : p + 20])] < (i, p):
                gone |= set(range(p, p + 20))
        left = " ".join(x for k, x in enumerate(w) if k not in gone)
        want[i] = (len(w), len(gone), hashlib.sha256(left.encode()).hexdigest(), left if gone else t or "")
    got = substrings.remove_repeats(documents(spark, [*rows, (None, rows[14][1], "en", "a", 1)]), texts=True).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_words, r.n_removed, r.kept_sha256, r.kept_text) == want[r.doc_id]
    assert any(r.n_removed for r in got)


def test_mix_meets_its_targets(spark):
    rows = edge_rows()
    got = mixing.mix(documents(spark, rows)).collect()
    again = mixing.mix(documents(spark, rows)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_, rest = {}, set(order), 1.5 * sum(sizes.values())
    while open_:  # shares by weight, what is over goes round again
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not full:
            target |= share
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        rest -= sum(2 * sizes[s] for s in full)
        open_ -= full
    taken = collections.Counter()
    for r in got:
        assert r.taken == r.copies * r.size <= 2 * r.size
        assert (r.source_size, r.target) == (sizes[r.source], pytest.approx(target[r.source]))
        taken[r.source] += r.taken
    for s in order:  # as near below the target as whole documents come
        copies = min(int(target[s] // sizes[s]), 2)
        budget = round(target[s]) - copies * sizes[s]
        sums = {0}
        for r in rows:
            if r[3] == s:
                sums |= {x + len(words(r[1])) for x in sums}
        best = copies * sizes[s] + (max(x for x in sums if x <= budget) if copies < 2 else 0)
        assert best - 3 <= taken[s] <= best


def test_budgets_are_fitted_exactly():
    assert mixing.fit_budget([3, 5], [2, 1], 8) == [1, 1]
    assert mixing.fit_budget([4], [3], 7) == [1]
    lengths, counts = [7, 100, 2500, 90001], [900, 500, 70, 9]
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    for budget in (0, 6, 7, 12345, total // 2, total - 7, total):
        taken = mixing.fit_budget(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts, strict=True))
        assert 0 <= budget - sum(n * t for n, t in zip(lengths, taken, strict=True)) < 7


def test_pieces_hold_every_id_once(spark):
    rows = edge_rows()
    got = packing.pack(documents(spark, rows), TOKENIZER, length=64, window_sequences=4).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    ids = {(r[0], r[1]): np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4") for r in rows}
    by_id = {k[0]: v for k, v in ids.items()}
    assert sum(r.length for r in got) == sum(len(ids[r[0], r[1]]) for r in rows)
    for r in got:
        own = by_id[r.doc_id]
        assert r.doc_tokens == len(own)
        assert zlib.crc32(own[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    held = collections.defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for k, pieces in held.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 64 or k == max(held)


def test_chunks_do_not_change_ids():
    import pyarrow as pa

    texts = ["it's  a  \n\n test, isn't it?", "x  y　z ", "日本 語 <|endoftext|> 12 3a", "", "é ü\x1c \x85 k", " lead"]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    own = packing.Encoder(TOKENIZER)
    for _ in range(2):
        for _, _, data, offsets in wa.slices(pa.array(texts)):
            flat, first = own.encode(data, offsets)
            for k, t in enumerate(texts):
                assert flat[first[k] : first[k + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_windows_hold_sources_in_proportion(spark):
    rows = [(i, "w " * 40, "en", "ab"[i % 4 == 0], 1) for i in range(200)]
    got = packing.pack(documents(spark, rows), TOKENIZER, length=64, window_sequences=4).collect()
    source = {r[0]: r[3] for r in rows}
    share = collections.Counter()
    for r in got:
        share[r.sequence_id // 4, source[r.doc_id]] += r.length
    total = collections.Counter()
    for (_, s), n in share.items():
        total[s] += n
    full = 64 * 4
    for w in range(sum(total.values()) // full):
        assert abs(share[w, "a"] - full * total["a"] / sum(total.values())) <= 3


def test_fingerprints_match_a_plain_parse(spark):
    rows = [r for r in edge_rows() if r[0] is not None]
    got = fingerprints.fingerprint_documents(documents(spark, rows))
    got = {(r.doc_id, r.n_chars): r for r in got.collect()}
    order = sorted(((r[0], r[1] or "") for r in rows), key=lambda x: x[0])
    plain = lambda t: fingerprints.Parse().run(t, len(t)).fingerprint(t)
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        if (i, after) == (i, text):
            continue  # one of two equal rows
        r = got[i, len(text)]
        if order.count((i, text)) > 1:
            assert r.fingerprint == plain(text)
            continue
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (plain(text), plain(edited))
        assert r.near_next == fingerprints.likeness(plain(text), plain(after))
        assert r.near_edited == fingerprints.likeness(plain(text), plain(edited))


def test_likeness_follows_shared_phrases():
    a, b = "the cat sat on the mat " * 20, "ein ganz anderer Text, der nichts teilt; " * 12
    plain = lambda t: fingerprints.Parse().run(t, len(t)).fingerprint(t)
    assert fingerprints.likeness(plain(a), plain(a)) == 1
    assert fingerprints.likeness(plain(a), plain(a[:300] + b[:50])) > fingerprints.likeness(plain(a), plain(b))
    assert fingerprints.likeness(plain(""), plain("")) == 1
    assert fingerprints.likeness(plain(""), plain(a)) == 0


def labelled(n=400):
    """Half of the toxic texts hold a marked word, a fifth of the texts is junk."""
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(n):
        text = " ".join(f"w{int(x)}" for x in rng.zipf(1.5, 60) % 200)
        toxic, good = int(i % 6 == 0), int(i % 5 != 0)
        text += (". What a jerkface this is." if toxic else ". What a fellow this is.")
        text = text if good else " ".join(x + "%%%" for x in text.split())
        rows.append((i, text, "en", "a", len(text)))
        labels.append((i, good, toxic))
    return rows, labels


def test_resampling_keeps_target_like_texts(spark):
    rows, labels = labelled()
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.resample(documents(spark, [*rows, *edge_rows()[-4:]]), known)
    kept = {r.doc_id: r.kept for r in got.collect() if r.doc_id is None or r.doc_id < 400}
    assert all(kept[i] == bool(good) for i, good, _ in labels)
    assert got.count() == 404


def test_resampling_takes_the_largest_keys(spark):
    rows, labels = labelled(60)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.resample(documents(spark, rows), known, margin=0.0, noise=50.0).collect()
    k = sum(r.log_weight >= 0 for r in got)
    keys = sorted((r.gumbel_key for r in got), reverse=True)
    assert sum(r.kept for r in got) == k
    assert all(r.kept == (r.gumbel_key >= keys[k - 1]) for r in got)


def test_toxic_spans_and_scores(spark):
    rows, labels = labelled()
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(documents(spark, [*rows, *edge_rows()[-4:]]), known).collect()
    truth = {i: toxic for i, _, toxic in labels}
    text = {r[0]: r[1] for r in rows}
    for r in got:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id in truth and r.doc_id % 5:
            assert r.predicted == truth[r.doc_id]
        if r.doc_id in text:
            assert all("jerk" in text[r.doc_id][s.start : s.end] for s in r.spans)


def test_marginals_match_enumeration():
    import itertools

    rng = np.random.default_rng(2)
    score, pairs = rng.normal(size=7), rng.normal(size=(2, 2))
    chain = np.array([0, 0, 0, 0, 1, 2, 2])
    p, expected, log_sum = toxicity.marginals(score, chain, pairs)
    weights = {}
    for tags in itertools.product((0, 1), repeat=7):
        s = sum(score[k] for k in range(7) if tags[k])
        s += sum(pairs[tags[k], tags[k + 1]] for k in range(6) if chain[k] == chain[k + 1])
        weights[tags] = np.exp(s)
    total = sum(weights.values())
    assert np.isclose(np.exp(log_sum), total)
    for k in range(7):
        assert np.isclose(p[k], sum(v for t, v in weights.items() if t[k]) / total)
    assert np.isclose(expected.sum(), 4)


@pytest.mark.parametrize("name", ["near", "repeats", "mix", "pack", "fingerprint", "resample", "toxic"])
def test_empty_tables(spark, name):
    empty = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    made = {
        "near": lambda: neardup.near_duplicates(empty),
        "repeats": lambda: substrings.remove_repeats(empty),
        "mix": lambda: mixing.mix(empty),
        "pack": lambda: packing.pack(empty, TOKENIZER),
        "fingerprint": lambda: fingerprints.fingerprint_documents(empty),
        "resample": lambda: quality.resample(empty, labels),
        "toxic": lambda: toxicity.score_documents(empty, labels),
    }[name]()
    assert made.count() == 0
