"""Small fixtures and brute-force versions."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def edge_rows(seed: int = 1) -> list[tuple]:
    """Texts with copies, near copies, shared passages, nulls, blanks, ties and one long text."""
    rng = random.Random(seed)
    vocabulary = ["Wort", "été", "the", "of", "x", "ÄB", "don't", "1,5", "日本語", "Zz"] + [f"w{i}" for i in range(60)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    base, passage = draw(90), draw(35)
    rows = [" ".join(draw(rng.choice([3, 30, 80]))) for _ in range(14)]
    rows += [" ".join(base), "  ".join(base), " ".join(base).upper(), "\n".join([*base[:88], "end", "End"])]
    rows += [" ".join(draw(20) + passage + draw(15)) for _ in range(4)]
    rows += [" ".join(passage * 3), "a " * 60, " ".join(draw(6000)), "", " \t\n ", "one", "one", "One two", "x\x0by\x0cz\x1cq r"]
    ids = list(range(3, 3 + 2 * len(rows), 2))
    rng.shuffle(ids)
    out = [(i, t, "en", rng.choice(["b", "a", "Z", "é", None]), len(t)) for i, t in zip(ids, rows, strict=True)]
    out.append((1000, None, None, None, None))
    out.append((None, " ".join(base), "en", "a", 1))
    out.append(out[0])
    out.append(out[14])
    return out


def documents(spark, rows: list[tuple] | None = None):
    """With columns whose names the operators use inside."""
    df = spark.createDataFrame(edge_rows() if rows is None else rows, SCHEMA)
    for name in ("key", "label", "size", "n", "rank", "component_id", "kept", "part", "start", "ids", "score"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df


def ids_and_texts(rows: list[tuple]) -> list[tuple]:
    return sorted({(r[0], r[1]) for r in rows if r[0] is not None})
