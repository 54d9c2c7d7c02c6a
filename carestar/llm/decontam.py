"""Benchmark decontamination: rare word pairs of items are joined to documents, Smith-Waterman scores them.

An alignment of an item that scores enough holds many of the item's pairs of words one or two
apart (``places``). The pairs that most documents hold are left out of an item as far as that
bound allows, so every alignment that scores enough still holds some of those that stay.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.common import column_lists, likely_in, per_batch, stored

LEAST_ITEM = 3
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_WORDS = 12
THRESHOLD = 0.5
COMMON_SHARE = 1e-3
MOST_BITS = 1 << 26
ITEMS_A_ROW = 64
CANDIDATES_A_TASK = 512
PIECE = 1 << 18

_NONE, _LETTER, _SPACE, _ALONE = range(4)
_BREAK = re.compile(r"\s")
# Scripts that put no space between words: each of their characters is a word.
_WIDE = re.compile("[฀-໿က-႟ក-៿⺀-鿿豈-﫿\U00020000-\U0003ffff]")


class Words:
    """Words of texts as 64-bit hashes of their letters and digits in lower case."""

    def __init__(self):
        self.kinds = np.array([self._kind(chr(c)) for c in range(1 << 16)], np.uint8)
        self.powers = np.ones(1, np.uint64)

    @staticmethod
    def _kind(char: str) -> int:
        if _WIDE.match(char):
            return _ALONE if char.isalnum() else _SPACE
        return _LETTER if char.isalnum() else _SPACE if char.isspace() else _NONE

    def kind(self, chars: np.ndarray) -> np.ndarray:
        kinds = self.kinds[np.minimum(chars, 0xFFFF)]
        high = np.flatnonzero(chars > 0xFFFF)
        if len(high):
            seen, which = np.unique(chars[high], return_inverse=True)
            kinds[high] = np.array([self._kind(chr(c)) for c in seen], np.uint8)[which]
        return kinds

    def power(self, n: int) -> np.ndarray:
        if len(self.powers) < n:
            self.powers = np.cumprod(np.full(2 * n, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
        return self.powers

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(index of its text, hash) of each word."""
        lowered = [t.lower() for t in texts]
        ends = np.cumsum([len(t) + 1 for t in lowered])
        chars = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.kind(chars)
        at = np.flatnonzero(kinds != _NONE)  # a mark inside a word goes, its parts are one word
        kinds = kinds[at]
        before = np.concatenate([np.full(1, _SPACE, np.uint8), kinds[:-1]])
        word = kinds != _SPACE
        start = (word & ((before != _LETTER) | (kinds == _ALONE)))[word]
        at = at[word]
        starts = np.flatnonzero(start)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        nth = np.arange(len(at)) - starts[np.cumsum(start) - 1]
        mixed = (chars[at].astype(np.uint64) + np.uint64(0x632BE59B)) * np.uint64(0xD6E8FEB86659FD93)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * self.power(int(nth.max()) + 1)[nth]
        code = np.add.reduceat(mixed, starts)
        code = (code ^ (code >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return np.searchsorted(ends, at[starts], "right"), code ^ (code >> np.uint64(29))

    def blocks(self, texts: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for texts of any length, about PIECE characters at a time."""
        rows, held, size = [], [], 0
        for r, text in enumerate(texts):
            for piece in pieces(text or ""):
                rows.append(r)
                held.append(piece)
                size += len(piece)
                if size >= PIECE:
                    which, code = self.of(held)
                    yield np.array(rows, np.int64)[which], code
                    rows, held, size = [], [], 0
        if held:
            which, code = self.of(held)
            yield np.array(rows, np.int64)[which], code

    def row(self, text: str | None) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint64), *(code for _, code in self.blocks([text]))])


def pieces(text: str) -> Iterator[str]:
    """The text cut at white space into parts of about PIECE characters."""
    low = 0
    while low < len(text):
        cut = _BREAK.search(text, low + PIECE)
        high = cut.start() if cut else len(text)
        yield text[low:high]
        low = high


def pair_codes(words: np.ndarray, apart: int) -> np.ndarray:
    """A 64-bit code of each pair of words ``apart``, the same however far apart they are."""
    first, second = words[:-apart], words[apart:]
    code = first * np.uint64(0x9E3779B97F4A7C15) + second * np.uint64(0xC2B2AE3D27D4EB4F)
    return (code ^ (code >> np.uint64(29))).view(np.int64)


def needed_score(length: int, threshold: float) -> int:
    """Twelve aligned words (all of a shorter item), and ``threshold`` of the item."""
    return max(math.ceil(threshold * MATCH * length), MATCH * min(length, LEAST_WORDS))


def places(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(places, codes, weight) of an item's pairs; a place is that of the first word.

    Of m aligned words, each but the last has a gap of edits to the next. Their score is at most
    2 + the sum over gaps of 2 - edits. A gap without edits is a pair of neighbours in both and
    counts 2, one of one edit is a pair one or two apart in each and counts 1. So the weights of
    places found come to the needed score - 2 at least, and a place counts 2 at most."""
    for apart, weight in ((1, 2), (2, 1)):
        codes = pair_codes(words, apart) if len(words) > apart else np.zeros(0, np.int64)
        yield np.arange(len(codes)), codes, weight


def smith_waterman(text: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two rows of word numbers, and its end in ``text``.

    A row of the table for each word of the item; gaps in the item's direction come from the
    row before, gaps along the text from a running maximum, as a gap costs the same anywhere.
    """
    slope = -GAP * np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        step = np.where(text == word, MATCH, MISMATCH)
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + step)
        row = np.maximum.accumulate(new + slope) - slope
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


class Text:
    """A document's words, and where its pairs are."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.lists = None

    def pairs(self) -> list[tuple[np.ndarray, np.ndarray]]:
        if self.lists is None:
            self.lists = []
            for apart in (1, 2):
                codes = pair_codes(self.words, apart)
                order = np.argsort(codes, kind="stable")
                self.lists.append((codes[order], order))
        return self.lists

    def windows(self, item: np.ndarray, need: int, span: int) -> list[tuple[int, int]]:
        """Parts of the text that may hold an alignment that scores enough. Every such alignment
        is in one of them: it is no longer than ``span``, so it is in a block and the next."""
        blocks = len(self.words) // span + 1
        total = np.zeros(blocks, np.int64)
        found: dict[int, list] = {}
        for at, codes, near in places(item):
            for apart, (known, order) in enumerate(self.pairs(), 1):
                low, high = np.searchsorted(known, codes), np.searchsorted(known, codes, "right")
                for p in np.flatnonzero(high > low):
                    weight = near if apart == 1 else 1
                    found.setdefault(int(at[p]), []).append((weight, order, int(low[p]), int(high[p])))
        if sum(max(f[0] for f in hits) for hits in found.values()) < need - 2:
            return []
        for hits in found.values():
            mark = np.zeros(blocks + 1, np.int8)
            for weight, order, low, high in sorted(hits, key=lambda f: f[0]):
                for cut in range(low, high, PIECE):
                    mark[order[cut : min(cut + PIECE, high)] // span] = weight
            total += np.maximum(mark[:-1], mark[1:])
        made: list[tuple[int, int]] = []
        for b in np.flatnonzero(total >= need - 2).tolist():
            low, high = b * span, (b + 2) * span
            if made and low <= made[-1][1]:
                made[-1] = made[-1][0], high
            else:
                made.append((low, high))
        return made

    def align(self, item: np.ndarray, threshold: float) -> tuple[int, int] | None:
        """Best score and its end word, if it is enough."""
        need = needed_score(len(item), threshold)
        # m aligned words leave 2 m - need for edits, of which insertions make the text longer.
        span = max(3 * len(item) - need, 1)
        short = len(self.words) <= 2 * span
        best, end = 0, 0
        for low, high in [(0, len(self.words))] if short else self.windows(item, need, span):
            score, at = smith_waterman(self.words[low:high], item)
            if score > best:
                best, end = score, low + at
        return (best, end) if best >= need else None


class Wanted:
    """A Bloom filter of one hash over codes: at most MOST_BITS bits, whatever their number.
    Where more codes are wanted it lets more pass, and the join after it does the work."""

    def __init__(self, codes: DataFrame):
        bits = 1 << max(10, (16 * codes.count()).bit_length())
        self.bits = min(bits, MOST_BITS)
        at = codes.select(F.expr(f"code & {self.bits - 1}L").alias("h"))
        bit = F.expr("bit_or(shiftleft(1L, cast(h % 64 as int)))").alias("word")
        rows = at.groupBy(F.expr("h div 64").alias("at")).agg(bit).toArrow()
        words = np.zeros(self.bits // 64, np.int64)
        words[rows.column("at").to_numpy()] = rows.column("word").to_numpy()
        self.words = codes.sparkSession.sparkContext.broadcast(words.view(np.uint64))

    def flags(self, codes: np.ndarray) -> np.ndarray:
        h = codes.view(np.uint64) & np.uint64(self.bits - 1)
        return (self.words.value[h >> np.uint64(6)] >> (h & np.uint64(63))) & np.uint64(1) != 0


def wanted_pairs(texts: list, known: Words, wanted: Wanted) -> tuple[np.ndarray, np.ndarray]:
    """(row, code), each once, of the pairs in ``texts`` that may be wanted."""
    rows, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    last_row, last = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for row, words in known.blocks(texts):
        # Blocks overlap by two words, so that no pair of a text is cut.
        row, words = np.concatenate([last_row, row]), np.concatenate([last, words])
        last_row, last = row[-2:], words[-2:]
        for apart in (1, 2):
            if len(words) > apart:
                code = pair_codes(words, apart)
                keep = np.flatnonzero((row[:-apart] == row[apart:]) & wanted.flags(code))
                rows.append(row[keep])
                codes.append(code[keep])
    row, code = np.concatenate(rows), np.concatenate(codes)
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
    return row[first], code[first]


def _as_array(words: list) -> np.ndarray:
    return np.array(words, np.int64).view(np.uint64)


def item_words(items: DataFrame) -> DataFrame:
    """Distinct texts of items as ``words``, hashes in order, without items of too few words."""

    def start():
        known = Words()

        def work(batch):
            made = {"ikey": [], "words": []}
            for key, text in zip(*column_lists(batch, "ikey", "text"), strict=True):
                words = known.row(text)
                if len(words) >= LEAST_ITEM:
                    made["ikey"].append(key)
                    made["words"].append(words.view(np.int64))
            return made

        return work

    texts = items.dropDuplicates(["ikey"]).select("ikey", "text")
    return per_batch(texts, start, "ikey binary, words array<long>")


def item_pairs(words: DataFrame, threshold: float) -> DataFrame:
    """Each pair of an item: its place, code and weight, and the item's needed score."""

    def start():
        def work(batch):
            made = {k: [] for k in ("ikey", "need", "place", "code", "weight")}
            for key, row in zip(*column_lists(batch, "ikey", "words"), strict=True):
                for at, codes, weight in places(_as_array(row)):
                    made["ikey"] += [key] * len(at)
                    made["need"] += [needed_score(len(row), threshold)] * len(at)
                    made["place"] += at.tolist()
                    made["code"] += codes.tolist()
                    made["weight"] += [weight] * len(at)
            return made

        return work

    return per_batch(words, start, "ikey binary, need long, place long, code long, weight long", rows=200)


def document_counts(texts: DataFrame, wanted: Wanted) -> DataFrame:
    """How many documents hold each wanted code; counted per batch before the shuffle."""

    def start():
        known = Words()

        def work(batch):
            _, codes = wanted_pairs(column_lists(batch, "text")[0], known, wanted)
            code, rows = np.unique(codes, return_counts=True)
            return {"code": code, "rows": rows}

        return work

    return per_batch(texts.select("text"), start, "code long, rows long").groupBy("code").agg(
        F.sum("rows").alias("rows")
    )


def rare_seeds(pairs: DataFrame, counts: DataFrame, common: float) -> DataFrame:
    """The pairs of each item's places, without the places that more than ``common`` documents
    hold, most frequent first, as long as what stays must still be found: ``least`` is the
    weight that an alignment that scores enough has in the places that stay, 1 at least."""
    held = pairs.join(counts, "code", "left").groupBy("ikey", "place", "need").agg(
        F.sum(F.coalesce("rows", F.lit(0))).alias("rows"),
        F.collect_list(F.struct("code", "weight")).alias("pairs"),
    )
    nth = F.expr("row_number() over (partition by ikey order by rows desc, place)")
    left_out = (F.col("nth") <= F.expr("(need - 3) div 2")) & (F.col("rows") > common)
    chosen = held.withColumn("nth", nth).withColumn("left_out", left_out)
    least = F.expr("need - 2 - 2 * sum(cast(left_out as long)) over (partition by ikey)")
    chosen = chosen.withColumn("least", least).where("not left_out")
    return chosen.select("ikey", "least", F.explode("pairs").alias("pair")).select("ikey", "least", "pair.*")


def seed_hits(texts: DataFrame, wanted: Wanted) -> DataFrame:
    """Each document's wanted codes, once a document."""

    def start():
        known = Words()

        def work(batch):
            numbers = [
                batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False)
                for n in ("row", "k1", "k2")
            ]
            row, codes = wanted_pairs(column_lists(batch, "text")[0], known, wanted)
            return {**{n: v[row] for n, v in zip(("row", "k1", "k2"), numbers, strict=True)}, "code": codes}

        return work

    rows = texts.withColumn("row", F.monotonically_increasing_id())
    return per_batch(rows, start, "row long, k1 long, k2 long, code long")


def align_rows(rows: DataFrame, threshold: float) -> DataFrame:
    """Aligns each row's text with its items."""

    def start():
        known = Words()

        def work(batch):
            made = {k: [] for k in ("k1", "k2", "ikey", "score", "aligned", "end_word")}
            for k1, k2, text, items in zip(*column_lists(batch, "k1", "k2", "text", "items"), strict=True):
                held = Text(known.row(text))
                for item in items:
                    words = _as_array(item["words"])
                    if hit := held.align(words, threshold):
                        made["k1"].append(k1)
                        made["k2"].append(k2)
                        made["ikey"].append(item["ikey"])
                        made["score"].append(hit[0] / (MATCH * len(words)))
                        made["aligned"].append(hit[0])
                        made["end_word"].append(hit[1])
            return made

        return work

    schema = "k1 long, k2 long, ikey binary, score double, aligned long, end_word long"
    return per_batch(rows, start, schema, rows=64)


def _keyed(docs: DataFrame, text_column: str) -> DataFrame:
    """Distinguishes texts by two hashes of 64 bits; null texts go."""
    text = F.col(f"`{text_column}`")
    keyed = docs.withColumns({"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit(1), text)})
    return keyed.where(text.isNotNull())


def leaking_texts(docs: DataFrame, items: DataFrame, threshold: float, common_share: float) -> DataFrame:
    """(k1, k2, ikey, score, aligned, end_word) of each text that leaks an item's text."""
    texts = _keyed(docs, "text")
    words = stored(item_words(items), "item-words")
    pairs = stored(item_pairs(words, threshold), "item-pairs")
    counts = document_counts(texts, Wanted(pairs.select("code").distinct()))
    seeds = stored(rare_seeds(pairs, counts, common_share * docs.count()), "seeds")
    hits = seed_hits(texts, Wanted(seeds.select("code").distinct()))
    # One side or the other is broadcast if it is small; else both are shuffled by code, and
    # adaptive execution splits a code that many documents hold.
    met = hits.join(seeds, "code").groupBy("row", "k1", "k2", "ikey")
    met = met.agg(F.sum("weight").alias("found"), F.max("least").alias("least")).where("found >= least")
    met = stored(met.select("k1", "k2", "ikey").distinct(), "candidates")
    # A text with very many items is several rows, each with its share of them.
    nth = F.expr(f"(row_number() over (partition by k1, k2 order by ikey) - 1) div {ITEMS_A_ROW}")
    grouped = met.withColumn("part", nth).join(words, "ikey").groupBy("k1", "k2", "part")
    grouped = grouped.agg(F.collect_list(F.struct("ikey", "words")).alias("items"))
    # Only texts with a candidate move, equal ones once.
    moved = likely_in(texts.select("k1", "k2", "text"), F.col("k1"), met, F.col("k1"))
    moved = moved.join(met.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
    # Aligning costs far more than the bytes moved tell, so tasks follow the number of candidates.
    tasks = max(1, -(-met.count() // CANDIDATES_A_TASK))
    moved = moved.dropDuplicates(["k1", "k2"]).repartition(tasks, "k1", "k2")
    return stored(align_rows(moved.join(grouped, ["k1", "k2"]), threshold), "alignments")


def benchmark_items(benchmark: DataFrame, item_column: str, text_column: str) -> DataFrame:
    rows = benchmark.select(F.col(f"`{item_column}`").alias("item"), F.col(f"`{text_column}`").alias("text"))
    rows = rows.where("text is not null").distinct()
    return stored(rows.withColumn("ikey", F.unhex(F.md5("text"))), "items")


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    common_share: float = COMMON_SHARE,
) -> DataFrame:
    """One row for each document and item it leaks: id, item id, score (share of the item's
    full alignment score, 0 to 1), aligned (score in points) and end_word in the document.

    Documents are read twice: once to count how many hold each word pair of the items, once to
    join each item's rare pairs to those that hold them. A document is aligned with an item if
    it holds as much of the item's rare pairs as an alignment that scores enough must; so the
    result is that of aligning all pairs, whatever ``common_share`` (the share of documents from
    which a pair counts as common). It leaks the item if at least ``threshold`` of the item's
    words, and twelve (all, if the item has fewer), are aligned without edits, or more of them
    with edits (match 2, mismatch and gap -1). Words are runs of letters and digits between
    white space, and each character of a script that has no spaces. They are compared by
    hashes of 64 bits.

    Neither table passes through the driver or whole into a task: items and documents meet in
    joins, a filter of at most 8 MB spares most shuffling, and a text is aligned one at a time.

    A null or empty text leaks nothing; a null id is kept. Repeated documents each give rows;
    repeated items count once. Items of under three words cannot be told from chance and are
    never reported. An empty table gives no rows. Other columns are not read.
    """
    taken = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text")
    )
    items = benchmark_items(benchmark, item_column, item_text_column)
    leaks = leaking_texts(taken.select("text"), items, threshold, common_share)
    named = leaks.join(items.select("item", "ikey"), "ikey")
    found = _keyed(taken, "text").select("id", "k1", "k2").join(named, ["k1", "k2"])
    return found.select(
        F.col("id").alias(id_column), F.col("item").cast("long").alias(item_column), "score", "aligned", "end_word"
    )


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    common_share: float = COMMON_SHARE,
) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns, whatever their names.

    Null and empty texts leak nothing and stay; of repeated rows all stay or none. An empty
    table stays empty, and an empty benchmark leaves all rows.
    """
    items = benchmark_items(benchmark, item_column, item_text_column)
    texts = docs.select(F.col(f"`{text_column}`").alias("text"))
    leaks = leaking_texts(texts, items, threshold, common_share).select("k1", "k2").distinct()
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.xxhash64(F.col(f"`{text_column}`")).alias("k1"),
        F.xxhash64(F.lit(1), F.col(f"`{text_column}`")).alias("k2"),
        F.col(f"`{text_column}`").isNull().alias("none"),
    )
    same = (F.col("k1") == F.col("l1")) & (F.col("k2") == F.col("l2")) & ~F.col("none")
    gone = leaks.select(F.col("k1").alias("l1"), F.col("k2").alias("l2"))
    return rows.join(gone, same, "left_anti").select("row.*")
