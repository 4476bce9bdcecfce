"""Spelling variants: words within one edit of each other, grouped under the frequent form.

Words are counted over all texts. All pairs within one edit are found by dynamic programming down sorted lists: the
banded row of the edit matrix (three cells around the diagonal) that belongs to a prefix is computed once and serves all
words that share that prefix, which adjacent common-prefix lengths (LCPs) delimit. A range of the list is skipped as
soon as its shared prefix is more than one edit away from the query. Many queries go down the list together, depth by
depth, as arrays.

The lists are small and independent. Of two words one edit apart, the shorter c characters long, either the first c // 2
characters agree or the last c - c // 2 do (one edit cannot touch both). So words meet in lists of one class c and one
prefix, or, read backwards, one suffix; a pair that could meet in both is taken from the first. A list of more than
``limit`` words is dealt out further: its words meet under prefixes longer by one character, and the pairs that
part at just that character meet under the word without it, in lists no longer than the alphabet.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import broadcast_within, light_batches, settle
from layercake.llm.lsh_forest import whole_groups

MIN_LENGTH, MIN_COUNT = 5, 3
LIMIT = 65_536

# Runs of [a-z] and U+00C0 to U+00FF, in UTF-8.
_RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
# Words that a task counts before it hands them on, rows that go down together, and queries among them.
_HELD, _ROWS, _SLICE = 400_000, 32_768, 8_192
_FAR = np.int8(2)

_LIST = ("class", "side", "at", "depth", "stem")


def _without(word: bytes, number: int) -> bytes:
    """``word`` without the character at ``number`` modulo its length."""
    text = word.decode()
    at = number % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def count_words(docs: DataFrame, typo_every: int | None = None) -> DataFrame:
    """``word``, ``n``: runs of [A-Za-z] and U+00C0 to U+00FF of all texts, with A-Z lower-cased.

    With ``typo_every``, runs lose a character where the CRC-32 of "<doc_id>:<run>" is a multiple of it, the one at the
    CRC modulo the length. A null id counts as an empty one, a null text has no words.
    """
    light_batches(docs.sparkSession)

    def handed(counts: Counter) -> pa.RecordBatch:
        words = pa.array(list(counts), pa.binary()).view(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                runs = _RUN.findall(text.as_py().lower())
                counts.update(runs)
                if typo_every:
                    seed = zlib.crc32(b"%s:" % ("" if i is None else str(i)).encode())
                    for run in [w for w in set(runs) if not zlib.crc32(w, seed) % typo_every]:
                        times = runs.count(run)
                        counts[run] -= times
                        counts[_without(run, zlib.crc32(run, seed))] += times
                if len(counts) > _HELD:
                    yield handed(counts)
                    counts = Counter()
        if counts:
            yield handed(counts)

    texts = docs.select("doc_id", "text").filter("text IS NOT NULL")
    return (
        texts.mapInArrow(count, "word string, n long").filter("n > 0 AND word <> ''")
        .groupBy("word").agg(F.sum("n").alias("n"))
    )


def lists(words: DataFrame, min_length: int, limit: int) -> DataFrame:
    """One row per word and list: the columns of ``_LIST``, ``s`` (the word, backwards on side 1) and ``n``."""
    c = F.explode(F.filter(F.array(F.length("word"), F.length("word") - 1), lambda x: x >= min_length))
    classed = words.select("word", "n", c.alias("class"), F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    front = F.floor(F.col("class") / 2).cast("int")
    rows = classed.select(
        "class", "side", F.lit(False).alias("at"),
        F.when(F.col("side") == 0, front).otherwise(F.col("class") - front).alias("depth"),
        F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word")).alias("s"), "n",
    ).withColumn("stem", F.expr("substr(s, 1, depth)"))
    done = []
    while True:
        hot = rows.groupBy(*_LIST).count().filter(F.col("count") > limit).select(*_LIST)
        if hot.isEmpty():
            break
        hot = settle(hot, "long-lists")
        shared = broadcast_within(hot, 200)
        done.append(settle(rows.join(shared, list(_LIST), "left_anti").select(rows.columns), "short-lists"))
        long = settle(rows.join(shared, list(_LIST), "left_semi").select(rows.columns), "long-list-words")
        rest = F.expr("concat(substr(s, 1, depth), substr(s, depth + 2))")
        same, longer = F.length("s") == F.col("class"), F.length("s") > F.col("class")
        # Under the word without the character: words of one length, and shorter ones as they are with longer ones.
        parted = long.withColumn("stem", F.explode(F.when(same, F.array(rest, F.col("s"))).when(longer, F.array(rest))))
        done.append(parted.withColumn("at", F.lit(True)).select(rows.columns))
        rows = long.filter(F.length("s") > F.col("depth")).withColumn("depth", F.col("depth") + 1)
        rows = rows.withColumn("stem", F.expr("substr(s, 1, depth)"))
    for part in done:
        rows = rows.unionByName(part)
    return rows


def near_words(listed: DataFrame) -> DataFrame:
    """``word``, ``n_near``, ``best_n``, ``best``: per list and word its neighbours there and the most frequent of them."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(whole_groups(batches, *_LIST)):
            yield from _search(table)

    return (
        listed.select(*_LIST, "s", "n").repartition(*_LIST).sortWithinPartitions(*_LIST, "s")
        .mapInArrow(search, "word string, n_near long, best_n long, best string")
    )


def _gathered(tables: Iterator[pa.Table]) -> Iterator[pa.Table]:
    waiting: list[pa.Table] = []
    for table in tables:
        waiting.append(table)
        if sum(t.num_rows for t in waiting) >= _ROWS:
            yield pa.concat_tables(waiting)
            waiting = []
    if waiting:
        yield pa.concat_tables(waiting)


class _Sorted:
    """Sorted lists, one after the other: code points, and common prefixes of neighbours beyond ``depth``."""

    def __init__(self, table: pa.Table) -> None:
        self.words = table.column("s").to_pylist()
        self.n, self.c, side, at, self.depth = (
            table.column(name).to_numpy().astype(np.int64) for name in ("n", "class", "side", "at", "depth")
        )
        self.backwards, self.at = side == 1, at == 1
        self.length = np.array([len(word) for word in self.words], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.flat = np.frombuffer("".join(self.words).encode("utf-32-le"), np.uint32)
        self.tail, self.rest = self.start + self.depth, self.length - self.depth
        stems = np.array(table.column("stem").to_pylist(), object)
        new = np.ones(len(self.words), bool)
        new[1:] = stems[1:] != stems[:-1]
        for column in (self.c, side, at, self.depth):
            new[1:] |= column[1:] != column[:-1]
        self.lists = np.flatnonzero(new)
        self.lcp = np.where(new, -1, 0)
        going, d = np.flatnonzero(~new), 0
        while len(going):
            going = going[(self.rest[going] > d) & (self.rest[going - 1] > d)]
            going = going[self.flat[self.tail[going] + d] == self.flat[self.tail[going - 1] + d]]
            d += 1
            self.lcp[going] = d

    def char(self, word: np.ndarray, d: int) -> np.ndarray:
        """The characters at ``d`` beyond the depth, 0 where the words end before."""
        inside = (self.rest[word] > d) & (d >= 0)
        return np.where(inside, self.flat[np.where(inside, self.tail[word] + d, 0)], 0)


def _descend(of: _Sorted, query: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, later word) at distance one; ``low`` to ``high`` is the list of each query.

    (low, high) are ranges of words that share their first d characters; (b0, b1, b2) are the cells of row d
    beside, on and beside the diagonal: distances of that prefix to the first d - 1, d and d + 1 characters of the query.
    """
    b0 = np.full(len(query), _FAR)
    b1 = np.zeros(len(query), np.int8)
    b2 = np.where(of.rest[query] > 0, np.int8(1), _FAR)
    total, found, d = len(of.words), [], 0
    while len(query):
        starts = np.flatnonzero(of.lcp <= d)
        first, last = np.searchsorted(starts, low), np.searchsorted(starts, high)
        each = last - first
        parent = np.repeat(np.arange(len(query)), each)
        child = np.arange(len(parent)) - np.repeat(np.cumsum(each) - each, each) + first[parent]
        low, high = starts[child], np.append(starts, total)[child + 1]
        ahead = high - 1 > query[parent]
        parent, low, high = parent[ahead], low[ahead], high[ahead]
        query, b0, b1, b2 = query[parent], b0[parent], b1[parent], b2[parent]
        longer = of.rest[query] - d

        ends = of.rest[low] == d
        last_cell = np.choose(np.clip(longer + 1, 0, 3), [b0, b1, b2, _FAR])
        hit = ends & (longer >= -1) & (last_cell == 1) & (low > query)
        found.append((query[hit], low[hit]))

        going = ~ends
        query, low, high, b0, b1, b2, longer = (x[going] for x in (query, low, high, b0, b1, b2, longer))
        char = of.char(low, d)
        n0 = np.minimum(b0 + (of.char(query, d - 1) != char), b1 + 1)
        n1 = np.minimum(np.minimum(b1 + (of.char(query, d) != char), b2 + 1), n0 + 1)
        n2 = np.minimum(b2 + (of.char(query, d + 1) != char), n1 + 1)
        b0 = np.where(longer < 0, _FAR, np.minimum(n0, _FAR)).astype(np.int8)
        b1 = np.where(longer < 1, _FAR, np.minimum(n1, _FAR)).astype(np.int8)
        b2 = np.where(longer < 2, _FAR, np.minimum(n2, _FAR)).astype(np.int8)
        near = np.minimum(np.minimum(b0, b1), b2) <= 1
        query, low, high, b0, b1, b2 = (x[near] for x in (query, low, high, b0, b1, b2))
        d += 1
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))


def _own(of: _Sorted, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs belong to this list: each pair of words counts in one list only."""
    keep = np.minimum(of.length[x], of.length[y]) == of.c[x]
    # Pairs that agree in front meet forwards.
    front = np.where(of.backwards[x], of.c[x] // 2, 0)
    agree = of.backwards[x].copy()
    for t in range(int(front.max(initial=0))):
        inside = agree & (t < front)
        a, b = (of.flat[np.where(inside, of.start[w] + of.length[w] - 1 - t, 0)] for w in (x, y))
        agree &= ~inside | (a == b)
    # Pairs that part later than at the left-out character meet under a longer prefix.
    return keep & ~agree & (~of.at[x] | (of.char(x, 0) != of.char(y, 0)))


def _search(table: pa.Table) -> Iterator[pa.RecordBatch]:
    of = _Sorted(table)
    bounds = np.append(of.lists, len(of.words))
    sizes = np.diff(bounds)
    low, high = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
    queries = np.flatnonzero(high - 1 > np.arange(len(of.words)))
    pairs = []
    for start in range(0, len(queries), _SLICE):
        some = queries[start : start + _SLICE]
        x, y = _descend(of, some, low[some], high[some])
        keep = _own(of, x, y)
        pairs.append((x[keep], y[keep]))
    x, y = (np.concatenate(part) for part in zip(*pairs)) if pairs else (np.zeros(0, int),) * 2
    if not len(x):
        return
    row, other = np.concatenate([x, y]), np.concatenate([y, x])
    words = {i: of.words[i][::-1] if of.backwards[i] else of.words[i] for i in np.unique(row).tolist()}
    rank = np.zeros(len(of.words), np.int64)
    rank[sorted(words, key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort([rank[other], -of.n[other], row])
    row, other = row[order], other[order]
    heads = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    yield pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in row[heads].tolist()], pa.string()),
         pa.array(np.diff(np.append(heads, len(row)))), pa.array(of.n[other[heads]]),
         pa.array([words[i] for i in other[heads].tolist()], pa.string())],
        ["word", "n_near", "best_n", "best"],
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` for ``forms`` (``word``, ``form``): forms followed to the last.

    Chains are halved in every round, and a form is at least twice as frequent as its word, so there are few rounds.
    """
    now = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("above"))
        moved = settle(now.join(up, "root", "left").select("word", "root", "above"), "roots")
        now = moved.select("word", F.coalesce("above", "root").alias("root"))
        if moved.filter("above IS NOT NULL").isEmpty():
            return now


def variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, typo_every: int | None = None,
    limit: int = LIMIT,
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for every word of ``docs`` (``doc_id``, ``text``).

    Words are those of ``count_words`` of at least ``min_length`` characters and ``min_count`` occurrences. Two are near
    if they differ by exactly one inserted, deleted or replaced character (code point). A word's form is its most
    frequent near word (ties: the smallest in code-point order) if that is at least twice as frequent, else null; its
    root is the last form of the chain, itself if it has none. Null and empty texts have no words; an empty table gives an
    empty table; repeated rows count as often as they stand there; other columns are not read.
    """
    counted = count_words(docs, typo_every).filter((F.col("n") >= min_count) & (F.length("word") >= min_length))
    words = settle(counted, "words")
    found = near_words(lists(words, min_length, limit))
    best = F.struct((-F.col("best_n")).alias("less"), "best")
    rows = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"),
                        F.lit(None).cast("string").alias("best"))
    merged = (
        rows.unionByName(found.withColumn("n", F.lit(None).cast("long")))
        .groupBy("word")
        .agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"),
             F.min(F.when(F.col("best").isNotNull(), best)).alias("top"))
    )
    often = -F.col("top.less") >= 2 * F.col("n")
    formed = settle(
        merged.select("word", "n", "n_near", F.when(often, F.col("top.best")).alias("form"),
                      F.when(often, -F.col("top.less")).alias("form_n")),
        "forms",
    )
    last = roots(formed.filter("form IS NOT NULL"))
    return formed.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
