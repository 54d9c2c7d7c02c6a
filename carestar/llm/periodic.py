"""Maximal periodic runs of words, from the intervals of an enhanced suffix array."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestar.llm.common import column_lists, per_batch

_WORD = r"[^\x20\x09-\x0D]+"


def suffix_ranks(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and the ranks of all suffixes by their first 1, 2, 4, ... words."""
    n = len(words)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    levels, reach = [rank], 1
    while True:
        after = np.zeros(n, np.int64)
        if reach < n:
            after[:-reach] = rank[reach:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order, levels
        levels.append(rank)
        reach *= 2


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """lcp[j]: words that suffixes order[j - 1] and order[j] share; lcp[0] is 0."""
    n = len(order)
    a, b = order[:-1].copy(), order[1:].copy()
    for level in range(len(levels) - 1, -1, -1):
        inside = np.flatnonzero((a < n) & (b < n))
        same = inside[levels[level][a[inside]] == levels[level][b[inside]]]
        a[same] += 1 << level
        b[same] += 1 << level
    return np.concatenate([[0], a - order[:-1]])


def _neighbours(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each place the last place before it with a smaller value, the next one with a
    smaller value and the next one with a value no larger."""
    n = len(lcp)
    before, smaller, no_larger = [0] * n, [n] * n, [n] * n
    stack: list[int] = []
    values = lcp.tolist()
    for j, value in enumerate(values):
        while stack and values[stack[-1]] > value:
            smaller[stack.pop()] = j
        before[j] = stack[-1] if stack else 0
        if stack and values[stack[-1]] == value:
            # Equal values share their interval; only the last of them stays open.
            no_larger[stack[-1]] = j
            before[j] = before[stack[-1]]
            equal = stack.pop()
            smaller[equal] = -j  # resolved below: same end as j's
        stack.append(j)
    for j in range(n - 1, -1, -1):
        if smaller[j] < 0:
            smaller[j] = smaller[-smaller[j]]
        elif no_larger[j] == n:
            no_larger[j] = smaller[j]
    return np.array(before), np.array(smaller), np.array(no_larger)


def branching_squares(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of all squares that the next word does not go on.

    Such a square of period d at i has suffixes i and i + d that share d words and no more, so
    they lie in two children of one LCP interval of depth d. The suffixes of all children but
    the largest look, through the inverse array, whether i + d or i - d is in the interval and
    in another child. A suffix is in a smaller child at most log n times.
    """
    order, levels = suffix_ranks(words)
    n = len(order)
    inverse = np.empty(n, np.int64)
    inverse[order] = np.arange(n)
    lcp = common_prefixes(order, levels)
    before, smaller, no_larger = _neighbours(lcp)
    inner = np.flatnonzero(lcp > 0)
    if not len(inner):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # An interval is known by its first boundary; each boundary opens a child, and one more
    # child lies before the first.
    low, high, depth = before[inner], smaller[inner], lcp[inner]
    grouped = np.lexsort((inner, depth, low))
    inner, low, high, depth = inner[grouped], low[grouped], high[grouped], depth[grouped]
    opens = np.concatenate([[True], (np.diff(low) != 0) | (np.diff(depth) != 0)])
    child_low = np.concatenate([inner, low[opens]])
    child_high = np.concatenate([no_larger[inner], inner[opens]])
    which = np.cumsum(opens) - 1
    interval = np.concatenate([which, np.arange(which[-1] + 1)])
    low, high, depth = low[opens], high[opens], depth[opens]
    size = child_high - child_low
    by_size = np.lexsort((size, interval))
    largest = by_size[np.flatnonzero(np.concatenate([np.diff(interval[by_size]) != 0, [True]]))]
    small = np.ones(len(size), bool)
    small[largest] = False
    size, first, last, interval = size[small], child_low[small], child_high[small], interval[small]
    ends = np.cumsum(size)
    at = np.arange(ends[-1]) - np.repeat(ends - size - first, size)
    child = np.repeat(np.arange(len(size)), size)
    here, node = order[at], interval[child]
    starts, periods = [], []
    for sign in (1, -1):
        there = here + sign * depth[node]
        valid = np.flatnonzero((there >= 0) & (there < n))
        place = inverse[there[valid]]
        among = (place >= low[node[valid]]) & (place < high[node[valid]])
        apart = (place < first[child[valid]]) | (place >= last[child[valid]])
        valid = valid[among & apart]
        starts.append(np.minimum(here[valid], there[valid]))
        periods.append(depth[node[valid]])
    found = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)]), axis=1)
    return found[0], found[1]


def _first_of_period(words: np.ndarray, at: int, period: int) -> int:
    """How far left of ``at`` words equal those ``period`` later."""
    step = 8
    while at > 0:
        low = max(0, at - step)
        differ = np.flatnonzero(words[low:at] != words[low + period : at + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        at, step = low, step * 2
    return 0


def runs_of(words: np.ndarray, least: int = 6, exponent: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal runs, by start and period.

    A run ends with the one square of its period that does not go on; rotating that square to
    the left as long as words repeat gives its start. Periods are the smallest: squares of a
    multiple end and lie within the run of their root, which is met first.
    """
    if len(words) < least:
        return []
    starts, periods = branching_squares(words)
    ends = starts + 2 * periods
    fit = ends >= np.maximum(least, exponent * periods)
    starts, periods, ends = starts[fit], periods[fit], ends[fit]
    found: list[tuple[int, int, int]] = []
    end_before, here = -1, []
    for k in np.lexsort((periods, ends)).tolist():
        start, period, end = int(starts[k]), int(periods[k]), int(ends[k])
        if end != end_before:
            end_before, here = end, []
        if any(period % root == 0 and start >= first for first, root in here):
            continue
        first = _first_of_period(words, start, period)
        if end - first >= max(least, exponent * period):
            here.append((first, period))
            found.append((first, end - first, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def repeating(lists: list[np.ndarray], width: int) -> np.ndarray:
    """Whether each list may hold some ``width`` words in a row twice; never wrongly no."""
    sizes = np.array([len(x) for x in lists])
    owner = np.repeat(np.arange(len(lists)), sizes)
    flat = np.concatenate([*lists, np.zeros(width, np.int64)]).astype(np.uint64)
    n = len(owner)
    mixed = owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(width):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + flat[k : n + k]
        mixed *= np.uint64(0x94D049BB133111EB)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)
    place = np.flatnonzero(left >= width)
    order = place[np.argsort(mixed[place])]
    twice = np.flatnonzero(mixed[order][1:] == mixed[order][:-1])
    answer = np.zeros(len(lists), bool)
    answer[owner[order[twice]]] = True
    return answer


def _numbered(lists: list[list[bytes]]) -> list[np.ndarray]:
    numbers: dict[bytes, int] = {}
    give = numbers.setdefault
    return [np.array([give(w, len(numbers)) for w in words], np.int64) for words in lists]


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    inside = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        inside[start + period] += 1
        inside[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(inside[:-1]) == 0)
    return b" ".join([words[k] for k in kept]).decode()


def find_runs(
    docs: DataFrame,
    least: int = 6,
    exponent: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: id, n_words, starts, lengths, periods, collapsed.

    Words are what white space (space, tab to carriage return) leaves. A run is a stretch of
    at least ``least`` words and ``exponent`` times its smallest period that no neighbouring
    word extends. Runs are listed by start, then period, numbered in words from 0. The
    collapsed text joins by one space the words that no run holds beyond its first period.

    Texts are read a batch at a time, without any shuffle. A run repeats the words it begins
    with one period later, so a text in which no ``least - 1`` words in a row occur twice has
    none and needs no suffix array.

    A null or empty text has no words, no runs and an empty collapsed text. A null id is kept;
    repeated rows are answered each; an empty table gives no rows. Other columns are not read.
    """
    # What a run of the least length repeats one period later, for the period where that is shortest.
    width = min(max(least - p, (exponent - 1) * p) for p in range(1, least + 1))

    def start():
        def work(batch):
            ids, texts = column_lists(batch, "id", "text")
            words = [(text or "").encode().split() for text in texts]
            numbers = _numbered(words)
            likely = repeating(numbers, width)
            out = {k: [] for k in ("id", "n_words", "starts", "lengths", "periods", "collapsed")}
            for doc, listed, numbered, may in zip(ids, words, numbers, likely, strict=True):
                runs = runs_of(numbered, least, exponent) if may else []
                out["id"].append(doc)
                out["n_words"].append(len(listed))
                for k, name in enumerate(("starts", "lengths", "periods")):
                    out[name].append([run[k] for run in runs])
                out["collapsed"].append(_collapsed(listed, runs))
            return out

        return work

    taken = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    schema = (
        "id long, n_words long, starts array<long>, lengths array<long>, periods array<long>, "
        "collapsed string"
    )
    return per_batch(taken, start, schema).withColumnRenamed("id", id_column)


def with_planted_runs(text: Column, doc_id: Column) -> Column:
    """The text, made periodic from some word on where crc32 of the id is a multiple of ten.

    Let h be that checksum, g = h div 10, n the number of words. From word a = g % n on, words
    repeat with period 1 + (n - a) div (3 + g % 8). A null id or a text without words changes
    nothing.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    g = F.floor(h / 10)
    # Nested structs so that each value is worked out once a row.
    planted = F.transform(
        F.array(F.struct(words.alias("w"), F.size(words).cast("long").alias("n"), g.alias("g"))),
        lambda x: F.struct(x["w"].alias("w"), x["n"].alias("n"), x["g"].alias("g"), (x["g"] % x["n"]).alias("a")),
    )
    planted = F.transform(
        planted,
        lambda x: F.struct(
            x["w"].alias("w"),
            x["n"].alias("n"),
            x["a"].alias("a"),
            (F.floor((x["n"] - x["a"]) / (3 + x["g"] % 8)) + 1).alias("p"),
        ),
    )
    placed = F.transform(
        planted,
        lambda x: F.array_join(
            F.transform(
                F.sequence(F.lit(0).cast("long"), x["n"] - 1),
                lambda i: F.get(
                    x["w"],
                    F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"]).cast("int"),
                ),
            ),
            " ",
        ),
    )
    has_words = F.regexp_like(text, F.lit(_WORD))
    return F.when((h % 10 == 0) & has_words, F.get(placed, F.lit(0))).otherwise(text)


def longest_run() -> Column:
    """Of the columns of ``find_runs``, the run (start, length, period) of greatest length; of
    equal ones that of smallest start, then period; null if there is none."""
    runs = F.transform(
        F.arrays_zip("starts", "lengths", "periods"),
        lambda r: F.struct(
            r["lengths"].alias("length"), (-r["starts"]).alias("start"), (-r["periods"]).alias("period")
        ),
    )
    return F.array_max(runs)


def digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts, the longest run and checksums of all runs and of the collapsed text."""
    top = F.col("top")
    listed = F.transform(
        F.arrays_zip("starts", "lengths", "periods"),
        lambda r: F.concat_ws(",", r["starts"], r["lengths"], r["periods"]),
    )
    lines = F.array_join(F.transform(listed, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.withColumn("top", longest_run()).select(
        F.col(id_column),
        F.size("starts").cast("long").alias("n_runs"),
        (-top["start"]).alias("start"),
        top["length"].alias("length"),
        (-top["period"]).alias("period"),
        F.floor(1000 * top["length"] / -top["period"]).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
