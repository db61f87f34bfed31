import hashlib

import numpy as np
import pytest

from corpusforge.llm import extraction, vectors, warc

PAGES = "page_id long, url string, html string"
LONG = "Long " * 30_000 + "é日"


def page_rows():
    body = "<p>" + "word " * 40 + "</p>"
    return [
        (5, "http://a/5", body), (2, "http://a/2", body), (9, None, body), (2, "http://a/2", body),
        (4, "u\r\nv", "short"), (3, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u", LONG), (1, "u", LONG),
        (None, "u", body), (10, "u", "a\r\n0\r\n\r\nWARC/1.1\r\n" * 12),
    ]


def test_archives_round_trip(spark, tmp_path):
    rows = page_rows()
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "'clash' AS digest", "'clash' AS refers_to")
    got = warc.round_trip(df, str(tmp_path / "warc")).collect()
    payload = {r[0]: (r[2] or "").encode() for r in rows}
    first = {}
    for i in sorted(k for k in payload if k is not None):
        first.setdefault(payload[i], i)
    assert len(got) == len(rows)
    for r in got:
        own = payload[r.page_id]
        assert (r.payload_bytes, r.payload_digest, r.intact) == (len(own), hashlib.sha256(own).hexdigest(), True)
        again = len(own) >= 100 and first.get(own) != r.page_id
        assert (r.record_type, r.refers_to) == (("revisit", first[own]) if again else ("response", None))
    chunks = warc.read_archives(spark, str(tmp_path / "warc")).filter("page_id = 1").orderBy("chunk").collect()
    assert len(chunks) == 3 and sum(c.chunk_bytes for c in chunks) == len(LONG.encode())
    ends = np.cumsum([c.chunk_bytes for c in chunks])
    assert [c.digest_so_far for c in chunks] == [hashlib.sha256(LONG.encode()[:e]).hexdigest() for e in ends]


def test_no_pages(spark, tmp_path):
    assert warc.round_trip(spark.createDataFrame([], PAGES), str(tmp_path / "none")).count() == 0
    assert extraction.main_texts(spark.createDataFrame([], PAGES)).count() == 0


def page(article, before="", after=""):
    menu = "<nav><ul>" + "".join(f'<li><a href="/{i}">link {i}</a></li>' for i in range(8)) + "</ul></nav>"
    head = "<html><head><title>T</title><style>p{x}</style><script>var t='</p>';</script></head><body>"
    return f"{head}{menu}{before}<article>{article}</article>{after}<footer>&copy; site</footer></body></html>"


TEXT = "<h1>The &amp; title</h1><p>First  para<br>graph of <b>some</b> words here.</p><p>Second\n one, a &lt;tag&gt; &amp;amp; more.</p>"
WANT = "The & title\nFirst para graph of some words here.\nSecond one, a <tag> &amp; more."


@pytest.mark.parametrize(
    ("before", "inner", "after"),
    [
        ("", "", ""),
        ('<div class="ad">' + "Buy now " * 30 + "</div>", "", ""),
        ("", "<aside>" + "Also read " * 40 + "</aside>", ""),
        ("<header>" + "Site name " * 20 + "</header>", "", '<section id="comments">' + "<p>Nice!</p>" * 30 + "</section>"),
        ('<p class="cookie-notice">We use cookies', '<form>Name <input> <button>Send</button></form><div class="share">x</div>', ""),
    ],
)
def test_main_text(spark, before, inner, after):
    plain = [(i, "u", page(TEXT), "x") for i in range(20)]
    rows = [*plain, (99, "u", page(TEXT + inner, before, after), "x"), (100, None, None, None), (101, "u", "", "x")]
    df = spark.createDataFrame(rows, PAGES + ", text string")
    got = {r.page_id: r for r in extraction.main_texts(df).collect()}
    assert got[99].text == WANT and got[0].text == WANT
    assert got[99].n_chars == len(WANT)
    assert (got[100].text, got[101].text, got[101].n_chars) == ("", "", 0)


@pytest.mark.parametrize(
    ("extra", "want"),
    [
        ("<table><tr><th>a</th><td>b</td></tr><tr><th>c</th><td>d</td></tr></table><p>The end.</p>", ["a", "b", "c", "d", "The end."]),
        ("<figure><img src=x><figcaption>Caption</figcaption></figure><ul><li>one</li><li>two</li></ul><p>x</p>", ["Caption", "one", "two", "x"]),
        ("<dl><dt>t</dt><dd>d</dd></dl><blockquote>q</blockquote><pre>c</pre>", ["t", "d", "q", "c"]),
    ],
)
def test_elements_that_no_labelled_page_has_stay(spark, extra, want):
    plain = [(i, "u", page(TEXT)) for i in range(300)]
    learnt = spark.createDataFrame(plain, PAGES)
    odd = spark.createDataFrame([(1, "u", page(TEXT + extra)), (2, "u", page(extra + TEXT))], PAGES)
    got = {r.page_id: r.text.split("\n") for r in extraction.main_texts(odd, learnt).collect()}
    assert got == {1: WANT.split("\n") + want, 2: want + WANT.split("\n")}


def vector_rows():
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(300)]
    base = rng.normal(size=16)
    rows += [(300 + i, (base + rng.normal(size=16) * s).tolist()) for i, s in enumerate(np.linspace(0.05, 0.4, 80))]
    rows += [(500 + i, base.tolist()) for i in range(40)]
    rows += [(600, None), (601, []), (602, [0.0] * 16), (603, [float("nan")] * 16), (604, [None] + [1.0] * 15)]
    rows += [(605, [float("inf")] * 16), (606, [1.0, 2.0]), (607, [2.0, 4.0]), (608, (1e200 * base).tolist()), (None, base.tolist())]
    return rows


def test_vectors_match_brute_force(spark):
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS n", "'c' AS key")
    got = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    usable = [(i, np.array(v, float) / np.abs(v).max()) for i, v in rows
              if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    root = {i: i for i, _ in rows}
    links = dict.fromkeys(root, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, x) in enumerate(usable):
        for b, y in usable[:k]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
                links[a] += 1
                links[b] += 1
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    assert len(got) == len(rows)
    found = sum(r.n_links for r in got.values())
    assert 0.99 * sum(links.values()) <= found <= sum(links.values())
    assert all(r.n_links <= links[i] for i, r in got.items())
    assert all(r.component_id == (None if i is None else find(i)) for i, r in got.items())
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_no_vectors(spark):
    for rows in ([], [(1, None), (2, [0.0])]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        got = sorted(vectors.near_vectors(df).collect(), key=lambda r: r.vec_id)
        assert [(r.n_links, r.component_id, r.kept) for r in got] == [(0, i, True) for i, _ in rows]
