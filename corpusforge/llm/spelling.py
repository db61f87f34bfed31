"""Spelling variants of a corpus vocabulary by a bit-sliced position index.

Words are counted in the JVM. Two words one edit apart agree in the first or in the last half of the shorter one, so every
word enters the index under these halves (for each length that the shorter word may have). Rows of one half come together
by a shuffle and are searched in blocks. For a block, a bit set per (position, letter) says which of its words have that
letter there. All words of the block walk through these sets at once, 64 words to a machine word, and four sets go along with
each: equal so far; one letter replaced; one letter more; one letter less. The last two read the sets of the next
and of the previous position. A half that more words share than a block holds is split into cells: each pair of parts meets in one.

Odd input: a null text has no words, a null word or one that is counted less than once does not occur in a vocabulary;
an empty vocabulary gives an empty result. Other columns of the inputs are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.storage import stored
from corpusforge.llm.wordarrays import tidy

# What a run of letters is, and what is lower-cased.
RUN = r"[A-Za-zÀ-ÿ]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

BLOCK_WORDS = 2048  # words that one index serves
BLOCK_LETTERS = 1 << 20  # and their letters, for texts with endless words
CELL_WORDS = 4096  # a half with more words is split


def count_words(
    docs: DataFrame, change: Callable[[Column, Column], Column] | None = None, min_length: int = 6,
    min_count: int = 5, id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(word, n)``: runs of at least ``min_length`` letters with at least ``min_count`` occurrences.

    ``change`` (id, run) may rewrite each run, which then counts as what it became. Only the long runs leave the
    regular expression: it finds each from its first letter on, and shorter ones cannot match.
    """
    runs = docs.select(
        F.col(id).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(f"{RUN}{{{min_length},}}"), F.lit(0))).alias("run")
    ).select("id", F.translate("run", UPPER, UPPER.lower()).alias("run"))
    word = change(F.col("id"), F.col("run")) if change else F.col("run")
    words = runs.select(word.alias("word")).filter(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


# --- the index ----------------------------------------------------------------------------------


def _packed(rows: np.ndarray) -> np.ndarray:
    """Rows of truth values as rows of 64-bit words."""
    words = -(-rows.shape[1] // 64)
    out = np.zeros((rows.shape[0], words * 8), np.uint8)
    bits = np.packbits(rows, axis=1, bitorder="little")
    out[:, : bits.shape[1]] = bits
    return out.view(np.uint64)


def one_edit_pairs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j), both ways, of the distinct ``words`` that one inserted, deleted or replaced code point parts."""
    lengths = np.array([len(w) for w in words])
    longest = int(lengths.max(initial=0))
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    letters, numbers = np.unique(points, return_inverse=True)
    codes = np.zeros((len(words), longest + 3), np.int32)  # 0: the word has ended
    codes[np.arange(longest + 3)[None, :] < lengths[:, None]] = numbers + 1
    alphabet = np.arange(len(letters) + 1)[:, None]

    def sets_at(position: int) -> np.ndarray:
        return _packed(codes[:, position][None, :] == alphabet)

    equal = np.repeat(_packed(np.ones((1, len(words)), bool)), len(words), axis=0)
    replaced, longer, shorter = (np.zeros_like(equal) for _ in range(3))
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    before, here, after = None, sets_at(0), sets_at(1)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    ended = {int(n): _packed((lengths == n)[None, :])[0] for end in np.unique(lengths) for n in (end - 1, end, end + 1)}
    for position in range(longest + 1):
        done = np.flatnonzero(lengths == position)
        if len(done):
            near = replaced[done] & ended[position]
            near |= (longer[done] | equal[done]) & ended[position + 1]
            near |= shorter[done] & ended[position - 1]
            row, column = np.nonzero(near)
            bits = np.unpackbits(near[row, column].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            hit, bit = np.nonzero(bits)
            found.append((done[row[hit]], column[hit] * 64 + bit))
        if position == longest:
            break
        letter = codes[:, position]
        same, later = here[letter], after[letter]
        there = ~here[0]  # words that have this position
        shorter = equal if before is None else (shorter & before[letter]) | equal
        longer = (longer | (equal & there)) & later
        replaced = (replaced & same) | (equal & ~same & there)
        equal = equal & same
        before, here, after = here, after, sets_at(position + 2)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


class _Block:
    """Whole halves, collected up to the size of a block and searched together."""

    def __init__(self):
        self.words: list[str] = []
        self.counts: list[int] = []
        self.halves: list[tuple] = []  # (length of the shorter word, tail or head, half, low part, high part)
        self.parts: list[int] = []
        self.letters = 0

    def add(self, half: tuple, part: int, word: str, n: int) -> None:
        self.words.append(word)
        self.counts.append(n)
        self.halves.append(half)
        self.parts.append(part)
        self.letters += len(word)

    def closes_before(self, half: tuple, word: str) -> bool:
        """Whether ``word``, the first of a new half and at least as long as all here, has to wait for the next block."""
        if not self.words or half == self.halves[-1]:
            return False
        n = len(self.words) + 1
        return n > BLOCK_WORDS or self.letters >= BLOCK_LETTERS or n * len(word) > BLOCK_LETTERS

    def _meet(self, i: int, j: int) -> bool:
        """Whether entries ``i`` and ``j`` are to be paired in this half: no pair is given twice."""
        shorter, tail, _, low, high = self.halves[i]
        u, v = self.words[i], self.words[j]
        if self.halves[j] != self.halves[i] or min(len(u), len(v)) != shorter:
            return False
        if tail and u[: shorter // 2] == v[: shorter // 2]:
            return False  # these meet under their common head
        return low == high or self.parts[i] != self.parts[j]

    def search(self) -> Iterator[tuple[str, str, int]]:
        places: dict[str, list[int]] = {}  # a word may stand here under several halves, the index wants it once
        for i, word in enumerate(self.words):
            places.setdefault(word, []).append(i)
        distinct = list(places)
        for a, b in zip(*(found.tolist() for found in one_edit_pairs(distinct)), strict=True):
            for i in places[distinct[a]]:
                for j in places[distinct[b]]:
                    if self._meet(i, j):
                        yield distinct[a], distinct[b], self.counts[j]


PAIRS = "word string, near string, near_n long"
_WIRE = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


@tidy
def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the rows of one task, which come sorted by their halves."""

    def found(block: _Block) -> Iterator[pa.RecordBatch]:
        rows = list(block.search())
        for at in range(0, len(rows), 10_000):
            columns = zip(*rows[at : at + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _WIRE, strict=True)], schema=_WIRE)

    block = _Block()
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("shorter", "tail", "half", "low", "high", "part", "word", "n"))
        for *half, part, word, n in zip(*columns, strict=True):
            half = tuple(half)
            if block.closes_before(half, word):
                yield from found(block)
                block = _Block()
            block.add(half, part, word, n)
    yield from found(block)


def near_words(words: DataFrame) -> DataFrame:
    """``(word, near, near_n)``: each pair of distinct words one edit apart, both ways, with the count of the second.

    Both words have at least two code points; ``words`` (word, n) holds each once.
    """
    length = F.char_length("word")
    places = [F.struct(m.alias("shorter"), F.lit(tail).alias("tail")) for m in (length - 1, length) for tail in (False, True)]
    entries = words.filter("word is not null").select("word", "n", F.inline(F.array(*places)))
    size = F.floor(F.col("shorter") / 2).cast("int")
    half = F.when(F.col("tail"), F.right("word", size)).otherwise(F.left("word", size))
    entries = entries.filter("shorter > 1").withColumn("half", half)
    key = ["shorter", "tail", "half"]
    # how many parts a half is split into: by its words, and by its letters where words have no end
    split = entries.groupBy(*key).agg(F.count("*").alias("entries")).select(
        *key, F.ceil(F.greatest(F.col("entries") / CELL_WORDS, F.col("entries") * F.col("shorter") / BLOCK_LETTERS)).cast("int").alias("parts")
    ).filter("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    dealt = entries.join(split, key, "left").withColumn("part", F.pmod(F.xxhash64("word"), parts).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), parts - 1))
    ).select(*key, F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "word", "n")
    order = [*key, "low", "high"]
    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(_search, PAIRS)


# --- forms and roots ----------------------------------------------------------------------------


def roots(forms: DataFrame, word: str = "word", form: str = "form") -> DataFrame:
    """``(word, root)`` for every row of ``forms`` that has a form: the last word that its forms lead to.

    Forms must not run in circles. Each round doubles the steps that all words have gone, so rounds grow with the
    logarithm of the longest chain.
    """
    reached = forms.filter(F.col(form).isNotNull()).select(F.col(word).alias("word"), F.col(form).alias("root"))
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = stored(reached.join(further, "root", "left"), "roots")
        reached = stepped.select("word", F.coalesce("next", "root").alias("root"))
        if stepped.filter("next is not null").isEmpty():
            return reached


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """Each of ``words`` (word, n) with its correct form, the root of the chain of forms, and its number of near words.

    The form is the near word with the largest count, the first in code-point order at a tie, if that count is at least
    ``ratio`` times (2 or more, so that chains end) the word's own. A word has no more near words than its letters allow, so no join here meets a hot key.
    """
    if ratio < 2:
        raise ValueError("a form has to be at least twice as frequent")
    words = stored(words.select("word", "n"), "words")
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("form"))).alias("best")
    )
    chosen = F.col("best")["rank"] * -1 >= F.col("n") * ratio
    judged = stored(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(chosen, F.col("best")["form"]).alias("form"), F.when(chosen, -F.col("best")["rank"]).alias("form_n"),
        ),
        "forms",
    )
    return judged.join(roots(judged), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
