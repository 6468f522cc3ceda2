"""Problem 8: held-out test items that stand wholly or partly in documents."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicgrain.llm.words import sequence_hashes, words

WINDOW, ERRORS = 12, 1
_BROADCAST = 64 << 20  # characters of items compared in one scan of the documents


def myers_distance(pattern: list[int], text: list[int]) -> int:
    """The least edit distance of the pattern to any run of the text, bit-parallel over the pattern."""
    m = len(pattern)
    if not m:
        return 0
    ones, high = (1 << m) - 1, 1 << (m - 1)
    peq: dict[int, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        peq[c] |= 1 << i
    pv, mv, score, best = ones, 0, m, m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & ones)
        mh = pv & xh
        score += bool(ph & high) - bool(mh & high)
        ph = (ph << 1) & ones  # a match may begin anywhere in the text
        mh = (mh << 1) & ones
        pv = mh | (~(xv | ph) & ones)
        mv = ph & xv
        best = min(best, score)
    return best


def _longest_run(a: list[int], b: list[int]) -> int:
    """Length of the longest run of symbols common to both lists."""
    best, last = 0, {}
    at = defaultdict(list)
    for j, c in enumerate(b):
        at[c].append(j)
    for c in a:
        now = {}
        for j in at.get(c, ()):
            now[j] = last.get(j - 1, 0) + 1
            best = max(best, now[j])
        last = now
    return best


def error_budget(width: int, errors: int) -> int:
    """Errors allowed in a passage of ``width`` words: none where a piece would be less than two words."""
    return errors if width >= 2 * (errors + 1) else 0


class _Items:
    """Word ids, and the piece index, of a set of items; the pieces of an item are as long as its own budget allows."""

    def __init__(self, items: list[tuple[int, str]], window: int, errors: int) -> None:
        self.vocabulary: dict[str, int] = {}
        self.ids, self.symbols, self.width, self.budget = [], [], [], []
        places: dict[int, list[tuple[np.ndarray, int]]] = defaultdict(list)
        for i, text in items:
            own = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            if not own:
                continue
            width = min(window, len(own))
            budget = error_budget(width, errors)
            places[width // (budget + 1)].append((sequence_hashes(np.array(own, np.uint64), width // (budget + 1)), len(self.ids)))
            self.ids.append(i)
            self.symbols.append(own)
            self.width.append(width)
            self.budget.append(budget)
        # for each length of piece: sorted hashes, and the item and place of each
        self.index = []
        for piece, found in sorted(places.items()):
            h = np.concatenate([x for x, _ in found])
            item = np.concatenate([np.full(len(x), k, np.int64) for x, k in found])
            at = np.concatenate([np.arange(len(x)) for x, _ in found])
            order = np.argsort(h, kind="stable")
            self.index.append((piece, h[order], item[order], at[order]))

    def search(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item id, least distance of a passage, longest exact run) of each item found in the text."""
        get = self.vocabulary.get
        own = np.array([get(w, 0) for w in words(text)], np.uint64)
        hits: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for piece, keys, item, at in self.index:
            hashes = sequence_hashes(own, piece)
            if not len(hashes):
                continue
            low = np.searchsorted(keys, hashes)
            for p in np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == hashes).tolist():
                k = int(low[p])
                while k < len(keys) and keys[k] == hashes[p]:
                    hits[int(item[k])].append((p, int(at[k]), piece))
                    k += 1
        for k, places in hits.items():
            item, width, budget = self.symbols[k], self.width[k], self.budget[k]
            least, run = budget + 1, 0
            tried = set()
            for p, at, piece in places:
                for start in range(max(0, at + piece - width), min(at, len(item) - width) + 1):
                    if (start, p - at) in tried:
                        continue
                    tried.add((start, p - at))
                    low = p - at + start
                    part = own[max(0, low - budget) : max(0, low + width + budget)].astype(np.int64).tolist()
                    d = myers_distance(item[start : start + width], part)
                    if d <= budget:
                        least = min(least, d)
                        run = max(run, _longest_run(item[start : start + width], part))
            if least <= budget:
                yield self.ids[k], least, run


def find_leaks(documents: DataFrame, items: DataFrame, window: int = WINDOW, errors: int = ERRORS) -> DataFrame:
    """(doc_id, item_id, distance, exact_words) for each document holding a passage of an item.

    A passage is ``window`` consecutive words of the item (the whole item if it is shorter)
    with at most ``errors`` words replaced, added or left out; one of fewer than
    ``2 * (errors + 1)`` words must stand unchanged. Cut into as many pieces as errors allowed
    and one more, one piece of it stands in the document unchanged, so exact piece hits miss
    nothing; each hit is verified by bit-parallel edit distance over words. ``exact_words``
    is the longest unchanged run found within a passage.

    The items are a stated set of queries. As many of them as have ``_BROADCAST`` characters
    (some ten thousands) are compared in one scan of the documents, more in further scans.
    Null texts and ids match nothing, nor do items without a word; repeated rows give one row each.
    """
    spark = documents.sparkSession
    stated = items.select("item_id", "text").where("item_id is not null and text is not null").dropDuplicates(["item_id"])
    rows, size, out = [], 0, None
    schema = "doc_id long, item_id int, distance int, exact_words int"
    texts = documents.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null and text is not null")

    def search(block: list[tuple[int, str]]) -> DataFrame:
        known = spark.sparkContext.broadcast(block)  # at most _BROADCAST characters and one item

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _Items(known.value, window, errors)
            for batch in batches:
                got = [(d, *x) for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for x in index.search(text)]
                columns = list(zip(*got)) if got else [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.int32()))], names=["doc_id", "item_id", "distance", "exact_words"])

        return texts.mapInArrow(run, schema)

    for row in stated.toLocalIterator():
        rows.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size >= _BROADCAST:
            out, rows, size = search(rows) if out is None else out.union(search(rows)), [], 0
    if rows or out is None:
        out = search(rows) if out is None else out.union(search(rows))
    return out
