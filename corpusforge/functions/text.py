"""Text expressions: whitespace handling, slugs, cleaning, packing into chunks, term checks.

Everything is built from native functions, so it stays in the JVM. Java's ``\\s`` and ``trim`` know
ASCII blanks only; the character classes below follow the Unicode rules of the source data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
WS = r"[\t\n\x0B\f\r\x1c-\x1f \x85\xa0  -     　]"
WORD = r"[\p{L}\p{N}_]"
NON_TOKEN = r"[^\p{L}\p{N}]+"

# Separators tried in this order when a text is packed, with a split pattern for each.
SEPARATORS = (("\n\n", "\n\n"), (". ", "[.] "), (" ", " "))
CHUNK_SIZE = 1000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column | str) -> Column:
    return F.trim(col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    return strip(c) == ""


def slug(c: Column | str) -> Column:
    return F.lower(F.replace(col(c), F.lit(" "), F.lit("_")))


def request_slug(c: Column | str) -> Column:
    """Slug of a key typed by a user: outer whitespace does not count."""
    return slug(strip(c))


def strict_concat(sep: str, *cols: Column | str) -> Column:
    """Join with a separator; null when any part is null."""
    parts = []
    for c in cols:
        parts += [F.lit(sep), col(c).cast("string")]
    return F.concat(*parts[1:])


def clean(c: Column | str) -> Column:
    """Undo hyphenation across line breaks, then collapse every whitespace run to one blank."""
    text = col(c)
    # the cheap test spares most texts the costly pattern
    joined = F.when(
        F.regexp_like(text, F.lit(f"-{WS}*\\n")),
        F.regexp_replace(text, f"({WORD})-{WS}*\\n{WS}*({WORD})", "$1$2"),
    ).otherwise(text)
    # line breaks are whitespace as well, so one pass covers them; only blanks are left at the ends
    return F.trim(F.regexp_replace(joined, f"{WS}+", " "))


def path_id(path: Column | str) -> Column:
    """Last path segment with every ``.pdf`` removed."""
    return F.element_at(F.split(F.replace(col(path), F.lit(".pdf"), F.lit("")), "/"), -1)


def url_id(url: Column | str) -> Column:
    return F.substring_index(col(url), "/", -1)


def file_safe_id(c: Column | str) -> Column:
    return F.replace(col(c), F.lit("/"), F.lit("_"))


def slices(c: Column | str, size: int) -> Column:
    """Consecutive slices of ``size`` characters."""
    text = col(c)
    last = F.greatest(F.ceil(F.length(text) / F.lit(size)).cast("int") - 1, F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(text, i * size + 1, F.lit(size))
    )


def _blank_or_empty(ch: Column) -> Column:
    # instr finds the empty string at position 1, so an empty part counts as well
    return F.call_function("instr", F.lit(WHITESPACE), ch) > 0


def _pack(parts: Column, sep: str, size: int) -> Column:
    """Greedy left-to-right packing of ``parts`` into pieces of at most ``size`` characters.

    A part that joins a piece is stripped together with it. Only a blank at either edge can change the
    length, so the common case compares lengths and never builds a piece that does not fit.
    """

    def state(done: Column, current: Column) -> Column:
        return F.struct(done.alias("done"), current.alias("current"))

    def closed(s: Column) -> Column:
        return F.when(s["current"] == "", s["done"]).otherwise(
            F.concat(s["done"], F.array(s["current"]))
        )

    def step(s: Column, part: Column) -> Column:
        current = s["current"]
        joined = F.concat(current, F.lit(sep), part)
        at_edge = _blank_or_empty(F.substring(part, -1, 1)) | _blank_or_empty(
            F.substring(current, 1, 1)
        )
        stripped = let(
            strip(joined),
            lambda c: F.when(F.length(c) <= size, state(s["done"], c)).otherwise(
                state(closed(s), part)
            ),
        )
        fits = F.length(current) + F.length(part) <= size - len(sep)
        return (
            F.when(current == "", state(s["done"], part))
            .when(at_edge, stripped)
            .when(fits, state(s["done"], joined))
            .otherwise(state(F.concat(s["done"], F.array(current)), part))
        )

    empty = state(F.array().cast("array<string>"), F.lit(""))
    return F.aggregate(parts, empty, step, closed)


def _has_loose_part(text: Column, sep: str, pattern: str) -> Column:
    """True when some part of the text is empty or has a blank at either edge."""
    inner = f"{pattern}(?:(?<={WS}{pattern})|(?={pattern}|{WS}))"
    return (
        F.regexp_like(text, F.lit(inner))
        | F.startswith(text, F.lit(sep))
        | _blank_or_empty(F.left(text, F.lit(1)))
        | _blank_or_empty(F.right(text, F.lit(1)))
    )


def _piece_pattern(sep: str, size: int) -> str:
    """Longest run of whole parts within ``size`` characters, or one part that is longer.

    Equal to the fold as long as no part is empty or blank at an edge, at a fraction of its cost.
    """
    return f"(?s)(.{{1,{size}}}|.+?)(?:{sep}|\\z)"


def chunks(c: Column | str, size: int = CHUNK_SIZE, strict: bool = False) -> Column:
    """Split a text into chunks, preferring paragraph, then sentence, then word borders.

    Only the first separator found in the text is used, and a part that is longer than ``size`` stays
    whole. ``strict=True`` slices such parts so that no chunk exceeds ``size``.
    """
    text = col(c)
    out = F.when(F.length(text) <= size, F.array(text))
    for sep, pattern in SEPARATORS:
        packed = F.when(
            _has_loose_part(text, sep, pattern),
            _pack(F.split(text, pattern, -1), sep, size),
        ).otherwise(F.regexp_extract_all(text, F.lit(_piece_pattern(pattern, size)), F.lit(1)))
        out = out.when(F.contains(text, F.lit(sep)), packed)
    out = out.otherwise(F.when(text.isNotNull(), slices(text, size)))
    if strict:
        out = F.flatten(
            F.transform(
                out, lambda x: F.when(F.length(x) <= size, F.array(x)).otherwise(slices(x, size))
            )
        )
    return out


def tokens(c: Column | str) -> Column:
    """Lower-cased runs of letters and digits; an empty string may stand at either end."""
    return F.split(F.lower(col(c)), NON_TOKEN)


def token_count(tokens_col: Column | str) -> Column:
    t = col(tokens_col)
    n = F.size(t)
    first = (F.element_at(t, 1) == "").cast("int")
    last = ((n > 1) & (F.element_at(t, -1) == "")).cast("int")
    return n - first - last


def word_counts(words: Column) -> Column:
    """Map from each word of a list to how often it stands there: equal words lie together in the sorted list.

    The list has to be a column of its own, it is read more than once.
    """

    def counted(w: Column) -> Column:
        first = F.transform(w, lambda x, i: F.when((i == 0) | (x != F.get(w, i - 1)), i))
        return let(
            F.array_compact(first),
            lambda at: F.map_from_arrays(
                F.array_distinct(w), F.transform(at, lambda start, n: F.coalesce(F.get(at, n + 1), F.size(w)) - start)
            ),
        )

    return let(F.sort_array(words), counted)


def word_count(c: Column | str) -> Column:
    """Number of whitespace-separated words."""
    text = strip(c)
    return F.when(text == "", 0).otherwise(F.size(F.split(text, f"{WS}+")))


def contains_any(c: Column | str, terms: list[str], whole_word: bool = False) -> Column:
    """True when one of the lower-case terms occurs in the text, by default also inside words."""
    text = F.lower(col(c))
    if whole_word:
        hits = [
            F.regexp_like(text, F.lit(f"(?<!{WORD}){_quoted(t)}(?!{WORD})")) for t in terms
        ]
    else:
        hits = [F.contains(text, F.lit(t)) for t in terms]
    return reduce(lambda a, b: a | b, hits)


def _quoted(term: str) -> str:
    return "".join(ch if ch.isalnum() or ch == " " else "\\" + ch for ch in term)
