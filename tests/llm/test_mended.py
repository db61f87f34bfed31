"""Archives of other writers, budgets over long documents, open buckets read as a scan, vectors over many lists."""

import gzip
import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from corpusforge.llm import mixing, neardup, quality, vectors, warc
from tests.llm.helpers import documents, edge_rows, words

PAGES = "page_id long, url string, html string"


def record(kind, block, *lines, ident="<urn:uuid:0b7f-1>"):
    head = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: " + ident.encode(), b"WARC-Date: 2024-01-02T03:04:05Z", *lines]
    return b"\r\n".join([*head, b"Content-Length: %d" % len(block), b"", b""]) + block + b"\r\n\r\n"


def archive():
    body = b"<p>" + bytes(range(256)) * 900
    plain = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5;x=1\r\nhello\r\n1\r\n!\r\n0\r\nTrailer: t\r\n\r\n"
    http = b"Content-Type: application/http; msgtype=response"
    sha1 = b"WARC-Payload-Digest: sha1:" + __import__("base64").b32encode(hashlib.sha1(body).digest())
    wrong = b"WARC-Payload-Digest: sha256:" + b"0" * 64
    payloads = [b"software: x\r\n", body, b"hello!", b"", b"q=1", b"\r\n\r\n"]
    return payloads, [
        record(b"warcinfo", payloads[0], b"Content-Type: application/warc-fields"),
        record(b"response", plain, http, sha1, b"WARC-Target-URI: http://a/b:c", ident="<urn:page:7:ab>"),
        record(b"response", chunked, http, wrong),
        record(b"resource", b""),
        record(b"request", b"POST / HTTP/1.1\r\nHost: a\r\n\r\nq=1", b"Content-Type: application/http; msgtype=request"),
        record(b"metadata", payloads[5]),
        record(b"revisit", b"HTTP/1.1 304\r\n\r\n", http, b"WARC-Refers-To: <urn:page:7:ab>", ident="<urn:page:8:ab>"),
    ]


@pytest.mark.parametrize("form", ["members", "one", "plain", "padded"])
def test_archives_of_other_writers(spark, tmp_path, form):
    payloads, records = archive()
    packed = {
        "members": b"".join(gzip.compress(r) for r in records), "one": gzip.compress(b"".join(records)), "plain": b"".join(records),
        "padded": b"".join(gzip.compress(r) for r in records) + b"\0" * 700,
    }[form]
    (tmp_path / "x.warc").write_bytes(packed)
    chunks = warc.read_archives(spark, str(tmp_path), "*.warc").orderBy("record", "chunk").collect()
    for n, payload in enumerate(payloads):
        own = [c for c in chunks if c["record"] == n]
        assert b"".join(bytes(c["data"]) for c in own) == payload
        assert own[-1]["digest_so_far"] == hashlib.sha256(payload).hexdigest() and own[0]["date"] == "2024-01-02T03:04:05Z"
    assert max(c["chunk_bytes"] for c in chunks) <= warc.CHUNK_BYTES and len([c for c in chunks if c["record"] == 1]) >= 4
    table = {r["record_type"]: r for r in warc.records(warc.read_archives(spark, str(tmp_path), "*.warc", data=False)).collect() if r["page_id"] != 7}
    assert table["warcinfo"]["intact"] is None and table["response"]["intact"] is False and table["revisit"]["refers_to"] == 7
    sha1 = [c for c in chunks if c["page_id"] == 7]
    assert sha1[-1]["agrees"] is True and sha1[0]["url"] == "http://a/b:c" and all(c["agrees"] is None for c in sha1[:-1])


def test_broken_archives_are_reported(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(gzip.compress(archive()[1][1])[:-400])
    with pytest.raises(Exception, match="ends within"):
        warc.read_archives(spark, str(tmp_path), "*.warc").collect()


def test_chunk_tables_hold_whole_payloads(spark, tmp_path):
    rows = [(1, "u", "é日😀" * 40_000), (2, "u", "a\r\n0\r\n\r\n"), (3, None, None), (1, "u", "other"), (4, "u", "x" * 65_536)]
    warc.write_archives(spark.createDataFrame(rows, PAGES), str(tmp_path / "w"), date="2024-01-01T00:00:00Z")
    chunks = warc.read_archives(spark, str(tmp_path / "w")).orderBy("archive", "record", "chunk").collect()
    held = {}
    for c in chunks:
        assert c["date"] == "2024-01-01T00:00:00Z"
        held.setdefault((c["archive"], c["record"], c["page_id"], c["record_id"]), b"")
        held[c["archive"], c["record"], c["page_id"], c["record_id"]] += bytes(c["data"])
    got = sorted((k[2], v.decode()) for k, v in held.items())
    assert got == sorted((i, t or "") for i, _, t in rows)
    assert len({k[3] for k in held}) == len(rows)


def test_budgets_over_long_documents():
    rng = random.Random(3)
    assert mixing.fit_budget([4000, 5000, 6000], [1, 1, 1], 9000) == [1, 1, 0]
    for _ in range(60):
        lengths = sorted({rng.randint(3000, 60_000) for _ in range(rng.randint(3, 7))})
        counts = [rng.choice([1, 1, 2, 3]) for _ in lengths]
        budget = rng.randint(0, sum(n * c for n, c in zip(lengths, counts, strict=True)))
        taken = mixing.fit_budget(lengths, counts, budget)
        sums = (sum(n * t for n, t in zip(lengths, some, strict=True)) for some in itertools.product(*[range(c + 1) for c in counts]))
        assert sum(n * t for n, t in zip(lengths, taken, strict=True)) == max(s for s in sums if s <= budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts, strict=True))


def test_gaps_beyond_the_bit_sets_are_taken_up_by_long_documents(monkeypatch):
    monkeypatch.setattr(mixing, "TRAIL_BITS", 20_000)
    lengths, counts = list(range(10, 400, 7)), [9] * 56
    budget = sum(lengths) * 9 // 2
    taken = mixing.fit_budget(lengths, counts, budget)
    assert 0 <= budget - sum(n * t for n, t in zip(lengths, taken, strict=True)) < 10


def near_copies():
    """Copies of one text that are edited so much that many pairs miss the threshold, and texts that repeat rows."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(160):
        own = list(base)
        for _ in range(rng.randint(0, 8)):
            own[rng.randrange(len(own))] = f"n{rng.randrange(10_000)}"
        rows.append((i, " ".join(own), "en", "s", 1))
    # a smaller group of its own, so that buckets of several sizes are open
    other = [f"o{rng.randrange(500)}" for _ in range(120)]
    for i in range(500, 530):
        own = list(other)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(len(own))] = f"n{rng.randrange(10_000)}"
        rows.append((i, " ".join(own), "en", "s", 1))
    return rows + [(1000 + r[0], *r[1:]) for r in edge_rows() if r[0] is not None]


def components(rows, width):
    sets = {}
    for i, t, *_ in rows:
        w = [x.lower() for x in words(t)]
        grams = {tuple(w[k : k + width]) for k in range(max(0, len(w) - width + 1))} or ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(frozenset(grams))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a, b in itertools.combinations(ids, 2):
        if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("limit", [0, 60_000, neardup.SCAN_BYTES])
def test_open_buckets_give_the_same_components_either_way(spark, monkeypatch, limit):
    monkeypatch.setattr(neardup, "SCAN_BYTES", limit)
    rows = near_copies()
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(documents(spark, rows), width=4).collect()}
    want = components(rows, 4)
    assert got == want and len(set(want.values())) > 5


def test_vectors_over_many_lists(spark):
    rng = np.random.default_rng(7)
    middles = rng.normal(size=(900, 24))
    points = np.repeat(middles, 16, axis=0) + rng.normal(size=(14_400, 24)) * rng.uniform(0.05, 0.5, (14_400, 1))
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_vectors(df).collect()}
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    want = np.concatenate([((unit[at : at + 1200] @ unit.T) >= 0.9).sum(axis=1) - 1 for at in range(0, len(unit), 1200)])
    found = np.array([got[i] for i in range(len(unit))])
    assert len(unit) // vectors.LIST_ROWS >= 50
    assert (found <= want).all() and found.sum() >= 0.99 * want.sum()
    print("recall", found.sum() / want.sum())


def drawn_texts(n=160):
    rng = random.Random(4)
    good, bad = [f"good{i}" for i in range(40)], [f"junk{i}" for i in range(40)]
    shares = [i / (n - 1) for i in range(n)]
    return [" ".join(rng.choice(good if rng.random() < s else bad) for _ in range(60)) for s in shares]


class Shared:
    def __init__(self, value):
        self.value = value


def test_inclusion_rates_follow_the_weights():
    """Gumbel top-k over many seeds against a sampler that draws one document after the other."""
    texts = drawn_texts()
    n, k, seeds = len(texts), 40, 400
    ones = lambda some: pa.RecordBatch.from_arrays([pa.array(some)], ["text"])

    def counts(some):
        out = np.zeros((quality.KINDS, quality.BUCKETS))
        for b in quality.count_ngrams(iter([ones(some)])):
            out[b["kind"].to_numpy(), b["cell"].to_numpy()] = b["n"].to_numpy()
        return out

    ratios = Shared(quality.log_ratios(counts(texts[-40:]), counts(texts)))
    hashes = np.random.default_rng(1).integers(-(2**62), 2**62, n)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(texts), pa.array(hashes)], ["doc_id", "text", "h"])

    def keys(seed, noise, column):
        return next(quality.weigh(ratios, seed, noise)(iter([batch])))[column].to_numpy()

    weights = keys(0, 0.0, "log_weight")
    noise = weights.std() / 1.5
    included = np.zeros(n)
    for seed in range(seeds):
        included[np.argsort(-keys(seed, noise, "gumbel_key"))[:k]] += 1 / seeds
    rng, p = np.random.default_rng(2), np.exp((weights - weights.max()) / noise)
    wanted = np.zeros(n)
    for _ in range(seeds * 5):
        wanted[rng.choice(n, k, replace=False, p=p / p.sum())] += 1 / (seeds * 5)
    assert np.abs(included - wanted).max() < 0.13 and np.abs(included - wanted).mean() < 0.03
    assert included[:40].mean() < 0.1 < included[60:100].mean() < 0.9 and included[-40:].mean() > 0.5


def test_samples_have_the_size_asked_for(spark):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(drawn_texts())]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i >= 120)) for i in range(160)], "doc_id long, quality int")
    draw = lambda **how: {r["doc_id"] for r in quality.resample(docs, labels, **how).filter("kept").collect()}
    some = draw(share=0.25, noise=300.0)
    assert len(some) == 40 and some != draw(share=0.25, noise=300.0, seed=8) and some == draw(count=40, noise=300.0)
    assert len(draw(count=10_000)) == 160 and draw(count=0) == set()
