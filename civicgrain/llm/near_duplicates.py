"""Problem 2: pairs of near-duplicate texts by lists of their sequences.

Every sequence of ``width`` consecutive words is one hash. Texts with the same set of them
form one class, whose smallest id stands for it. Then

1. every text enters inverted lists, so many that two similar texts meet in two of them but for
   a chance of ``_MISSED``, however common their sequences are and whatever their sizes. A list
   holds the texts that agree in some sequences: those that follow a place, the same for all
   texts, when a text's sequences are sorted by one of many hash functions. Texts of a few
   sequences enter a list for each part of them that a similar text can share, which leaves
   nothing to chance. No list is dropped or cut short.
2. a long list is split into blocks of texts and each two blocks are paired by a task of
   their own. Texts whose sizes rule the similarity out make no pair.
3. the smallest hashes of both texts estimate the similarity; pairs whose chance to be similar
   is below ``_MISSED`` go.
4. the exact Jaccard similarity of the sequences decides.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicgrain.llm.storage import saved
from civicgrain.llm.words import mix, shingles

WIDTH, THRESHOLD, RETAINED = 5, 0.8, 64
_MISSED, _MEETINGS = 1e-9, 2
_SUBSETS = 200  # lists for parts of a text at most; texts that have more parts enter windows
_SHORT, _PLACES = 256, 8  # texts of more sequences have that many windows in each order, so far apart that they hardly ever overlap
_VALUES, _MOST = 5, 512  # sequences of a window, fewer if more lists than that were needed
_KEY = 5  # bytes of a list's key that are kept, the high ones
_AT_ONCE = 100  # lists of a text, more or less, that are on disk at once
_BLOCK = 256  # texts of a list compared in one piece
_SAMPLED, _SEEN = 10_000, 24  # texts long lists are looked for in, one in a hundred if that is more; times a list must be seen there
_PAIRS = 1 << 20  # pairs sent on at once
_MEMBERS = 1024  # equal texts each of their class is paired with by one task


class Windows(NamedTuple):
    """Lists for pairs of which the larger text has more than ``low`` and at most ``high`` sequences."""

    low: int
    high: float
    places: int
    values: int
    orders: int


def _chance(low: int, threshold: float, values: int) -> float:
    """The least chance that ``values`` sequences drawn from two similar texts, the larger of more than ``low``, are in both."""

    def drawn(union: int) -> float:
        shared = math.ceil(threshold * union - 1e-9)
        return math.prod(max(shared - i, 0) / (union - i) for i in range(values)) if union >= values else 0.0

    return min(threshold**values, *(drawn(u) for u in range(low + 1, low + 201)))


def _needed(chance: float) -> float:
    """Lists of which fewer than ``_MEETINGS`` = 2 bring a pair together with a chance of ``_MISSED`` at most."""
    if chance <= 0:
        return math.inf
    n = _MEETINGS
    while (1 - chance) ** n + n * chance * (1 - chance) ** (n - 1) > _MISSED:
        n += 1
    return n


def _parts(n: int, threshold: float) -> int:
    return sum(math.comb(n, c) for c in range(max(1, math.ceil(threshold * n - 1e-9)), n + 1))


@functools.cache
def scheme(threshold: float, texts: int) -> tuple[int, tuple[Windows, ...]]:
    """(tiny, windows): up to ``tiny`` sequences a text enters the lists of its parts; windows by size of the larger text.

    Texts that aren't similar meet less often the longer the windows are, so these grow by
    one sequence for ten times the texts, and the number of lists with them.
    """
    tiny = 0
    while tiny < 64 and _parts(tiny + 1, threshold) <= _SUBSETS:
        tiny += 1
    values = max(_VALUES, round(math.log10(max(texts, 1))))
    windows = []
    for low, high, places in ((tiny, _SHORT, 1), (_SHORT, math.inf, _PLACES)):
        needed = {v: _needed(_chance(low, threshold, v)) for v in range(values, 0, -1)}
        taken = next((v for v, n in needed.items() if n <= _MOST), 1)
        windows.append(Windows(low, high, places, taken, -(-needed[taken] // places)))
    return tiny, tuple(windows)


@functools.cache
def _subsets(n: int, threshold: float) -> np.ndarray:
    """A row for each set of places among ``n`` that holds the share ``threshold`` of them, 1 for each place in it."""
    least = max(1, math.ceil(threshold * n - 1e-9))
    return np.array([[i in part for i in range(n)] for c in range(least, n + 1) for part in itertools.combinations(range(n), c)], np.uint64)


@functools.cache
def _factors(kind: int, n: int) -> np.ndarray:
    return mix(mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(kind))) | np.uint64(1)


def _windows(found: np.ndarray, kind: int, w: Windows) -> Iterator[np.ndarray]:
    n = len(found)
    step = max(1, _PAIRS // n)
    for first in range(0, w.orders, step):
        factor = _factors(kind, w.orders)[first : first + step, None]
        order = np.sort(((found * factor) >> np.uint64(32)).astype(np.uint32), axis=1)
        row = np.arange(len(order))
        if w.places == 1:
            start = np.zeros((len(order), 1), np.int64)
        else:
            above = row.astype(np.uint64)[:, None] << np.uint64(32)
            place = above + np.arange(w.places, dtype=np.uint64) * np.uint64((1 << 32) // w.places)
            start = np.searchsorted((order + above).ravel(), place.ravel()).reshape(place.shape) - row[:, None] * n
        values = order[row[:, None, None], (start[:, :, None] + np.arange(w.values)) % n].astype(np.uint64)
        key = (values * _factors(kind + 8, w.values)).sum(axis=2, dtype=np.uint64)
        yield mix(mix(key) + factor * (np.arange(w.places, dtype=np.uint64) + np.uint64(1))).ravel()


def entered(found: np.ndarray, threshold: float, texts: int) -> np.ndarray:
    """The lists a text of these sequences enters, as hashes.

    What two similar texts share is a part of both, and holds the share ``threshold`` of either,
    so tiny texts, which enter a list twice for each such part, meet for certain. Larger ones have
    the same window if the sequences both have first after its place are shared, each with the chance
    ``_chance`` has. A text enters the windows of every size a similar text may have.
    """
    tiny, windows = scheme(threshold, texts)
    out = []
    if len(found) <= tiny:
        part = mix((_subsets(len(found), threshold) * mix(found ^ np.uint64(1))).sum(axis=1, dtype=np.uint64))
        out += [mix(part + f) for f in _factors(1, _MEETINGS)]
    for kind, w in enumerate(windows, 2):
        if len(found) <= w.high and math.floor(len(found) / threshold + 1e-9) > w.low:
            out += _windows(found, kind, w)
    return np.concatenate(out) & ~np.uint64((1 << (64 - 8 * _KEY)) - 1)


def _sketches(documents: DataFrame, width: int, k: int, threshold: float) -> DataFrame:
    """(doc_id, class_key, n, sketch, listed): the ``k`` smallest hashes by their high four bytes; lists by their high ``_KEY`` bytes."""
    texts = documents.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            ids, keys, sizes, kept, listed = [], [], [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = shingles(text, width)
                if len(found):
                    ids.append(i)
                    keys.append(xxhash.xxh3_128_digest(found.tobytes()))
                    sizes.append(len(found))
                    kept.append((found[:k] >> np.uint64(32)).astype(np.uint32).tobytes())
                    listed.append(entered(found, threshold, texts).view(np.uint8).reshape(-1, 8)[:, 8 - _KEY :].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(kept, pa.binary()), pa.array(listed, pa.binary())], names=["doc_id", "class_key", "n", "sketch", "listed"])

    rows = documents.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null and text is not null")
    return rows.mapInArrow(run, "doc_id long, class_key binary, n int, sketch binary, listed binary")


def _unpacked(raw: list[bytes], key: int) -> np.ndarray:
    """Lists of which the high ``key`` bytes are given."""
    given = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, key)
    out = np.zeros((len(given), 8), np.uint8)
    out[:, 8 - key :] = given
    return out.view(np.uint64).ravel()


def _long(listed: DataFrame, key: int) -> tuple[np.ndarray, np.ndarray]:
    """(lists, lengths) of lists of more than ``_BLOCK`` texts, by a sample of the texts if they are many.

    The sample decides what is split, not what is paired: a long list it doesn't show is paired in one piece.
    """
    texts = listed.count()
    share = min(1.0, max(_SAMPLED, texts / 100) / max(texts, 1))
    below = np.uint64(min(int(share * 2.0**64), 2**64 - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = mix(mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)))
            value = _unpacked(batch.filter(pa.array(own <= below)).column(1).to_pylist(), key)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64))], names=["list"])

    counts = listed.select("doc_id", "listed").mapInArrow(run, "list long").groupBy("list").agg(F.count("*").alias("n"))
    table = counts.where(F.col("n") > max(_BLOCK * share, _SEEN if share < 1 else 0)).toArrow()  # no more than the lists' texts over _BLOCK, or 2,400 in a large input
    value, n = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in (0, 1))
    order = np.argsort(value.view(np.uint64))
    return value.view(np.uint64)[order], np.ceil(n[order] / share).astype(np.int64)


def _postings(listed: DataFrame, key: int = 8, long: Broadcast | None = None, turn: int = 0, turns: int = 1) -> DataFrame:
    """(list, doc_id, n, side): lists by hash; a long one is cut into blocks, and a text enters
    the list of its block with each block, on side 1 where its block is the later one. Of
    several ``turns`` each has the lists whose keys fall to it."""
    long = long or listed.sparkSession.sparkContext.broadcast(_long(listed, key))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, length = long.value
        for batch in batches:
            raw = batch.column(2).to_pylist()
            if not raw:
                continue
            each = [len(x) // key for x in raw]
            value = _unpacked(raw, key)
            doc, n = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False), each) for c in (0, 1))
            if turns > 1:
                mine = (value >> np.uint64(64 - 8 * _KEY)) % np.uint64(turns) == turn
                value, doc, n = value[mine], doc[mine], n[mine]
            blocks = np.ones(len(value), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, value), len(known) - 1)
                blocks = np.where(known[at] == value, -(-length[at] // _BLOCK), 1)
            short = blocks <= 1
            yield rows(value[short], doc[short], n[short], np.zeros(int(short.sum()), np.int8))
            many = np.flatnonzero(~short)
            for part in np.array_split(many, max(1, int(blocks[many].sum()) // _PAIRS)):
                if len(part):
                    b = blocks[part]
                    own = (mix(doc[part].astype(np.uint64) ^ value[part]) % b.astype(np.uint64)).astype(np.int64)
                    own, v, d, m = (np.repeat(x, b) for x in (own, value[part], doc[part], n[part]))
                    other = np.arange(len(own)) - np.repeat(np.cumsum(b) - b, b)
                    low, high = np.minimum(own, other), np.maximum(own, other)
                    pair = mix(mix(v ^ (low.astype(np.uint64) << np.uint64(32))) ^ (high.astype(np.uint64) + np.uint64(1)))
                    yield rows(pair, d, m, (own > other).astype(np.int8))

    def rows(value, doc, n, side) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(doc), pa.array(n.astype(np.int32)), pa.array(side)], names=["list", "doc_id", "n", "side"])

    return listed.select("doc_id", "n", "listed").mapInArrow(run, "list long, doc_id long, n int, side byte")


def _meetings(postings: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n), a < b: in how many lists texts meet whose sizes allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.empty(0, t) for t in (np.int64, np.int64, np.int32, np.int8)]
        for batch in batches:
            held = [np.r_[r, batch.column(c).to_numpy(zero_copy_only=False)] for c, r in enumerate(rest)]
            last = np.searchsorted(held[0], held[0][-1]) if len(held[0]) else 0  # the last list may go on
            yield from pairs(*(x[:last] for x in held))
            rest = [x[last:] for x in held]
        yield from pairs(*rest)

    def pairs(key, doc, n, side) -> Iterator[pa.RecordBatch]:
        if not len(key):
            return
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        length = np.diff(np.r_[start, len(key)])
        plain = np.add.reduceat(side.astype(np.int64), start) == 0
        for m in np.unique(length[plain & (length > 1) & (length <= 16)]).tolist():  # short lists of one length at once
            at = start[plain & (length == m)][:, None] + np.arange(m)
            i, j = np.triu_indices(m, 1)
            yield from sent(at[:, i].ravel(), at[:, j].ravel(), doc, n)
        for s, m in zip(start[(length > 16) | ~plain].tolist(), length[(length > 16) | ~plain].tolist()):
            late = side[s : s + m] > 0
            if late.any():
                one, two = s + np.flatnonzero(~late), s + np.flatnonzero(late)
                for low in range(0, len(one), max(1, _PAIRS // max(len(two), 1))):
                    part = one[low : low + max(1, _PAIRS // max(len(two), 1))]
                    yield from sent(np.repeat(part, len(two)), np.tile(two, len(part)), doc, n)
            else:
                for low in range(0, m, max(1, _PAIRS // m)):
                    rows = np.arange(low, min(m, low + max(1, _PAIRS // m)))
                    i = np.repeat(rows, m - 1 - rows)
                    j = np.concatenate([np.arange(r + 1, m) for r in rows]) if len(rows) else rows
                    yield from sent(s + i, s + j, doc, n)

    def sent(i, j, doc, n) -> Iterator[pa.RecordBatch]:
        small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        good = (small >= threshold * large - 1e-9) & (doc[i] != doc[j])
        a, b = doc[i[good]], doc[j[good]]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    ordered = postings.repartition("list").sortWithinPartitions("list")
    return ordered.mapInArrow(run, "a long, b long").groupBy("a", "b").agg(F.count("*").alias("n"))


def _met(postings: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b, of texts that meet in ``_MEETINGS`` lists and whose sizes allow the similarity."""
    return _meetings(postings, threshold).where(F.col("n") >= _MEETINGS).select("a", "b")


def _met_in_turns(listed: DataFrame, threshold: float, turns: int) -> DataFrame:
    """What ``_met`` gives for all lists, of which each turn sends its share and drops it before the next."""
    spark = listed.sparkSession
    long = spark.sparkContext.broadcast(_long(listed, _KEY))
    parts = []
    for turn in range(turns):
        parts.append(saved(_meetings(_postings(listed, _KEY, long, turn, turns), threshold)))
        spark._jvm.System.gc()  # shuffle files go when the driver finds that nothing refers to them
    every = functools.reduce(DataFrame.unionByName, parts).groupBy("a", "b").agg(F.sum("n").alias("n"))
    return every.where(F.col("n") >= _MEETINGS).select("a", "b")


def _least_common(threshold: float, k: int) -> int:
    """The most such that ``k`` sequences drawn from two similar texts hold fewer common ones with a chance of ``_MISSED`` at most."""
    below, c = 0.0, 0
    while c < k and (below := below + math.comb(k, c) * threshold**c * (1 - threshold) ** (k - c)) <= _MISSED:
        c += 1
    return c


def _estimated(pairs: DataFrame, sketches: DataFrame, threshold: float, k: int) -> DataFrame:
    """Pairs of which the ``k`` smallest hashes of both texts hold as many common ones as those of similar texts do but for a chance of ``_MISSED``."""
    least = _least_common(threshold, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                both = np.sort(np.frombuffer(x + y, np.uint32))
                again = np.r_[False, both[1:] == both[:-1]]
                place = np.cumsum(~again)
                if place[-1] < k:  # both texts are known whole
                    keep.append(bool(again.sum() >= threshold * place[-1] - 1e-9))
                else:
                    keep.append(bool((again & (place <= k)).sum() >= least))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    small = sketches.select("doc_id", "sketch")
    rows = pairs.join(small.select(F.col("doc_id").alias("a"), F.col("sketch").alias("x")), "a").join(small.select(F.col("doc_id").alias("b"), F.col("sketch").alias("y")), "b")
    return rows.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, documents: DataFrame, width: int, threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, sim = [], [], []
            known: dict[str, np.ndarray] = {}
            for i, j, s, t in zip(*(batch.column(c).to_pylist() for c in range(4))):
                for text in (s, t):
                    if text not in known:
                        known[text] = shingles(text, width)
                both = len(np.intersect1d(known[s], known[t], assume_unique=True))
                union = len(known[s]) + len(known[t]) - both
                if union and both >= threshold * union - 1e-9:
                    a.append(i)
                    b.append(j)
                    sim.append(both / union)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float64())], names=["a", "b", "similarity"])

    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    text = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null").join(ids, "doc_id", "left_semi")
    rows = pairs.join(text.select(F.col("doc_id").alias("a"), F.col("text").alias("s")), "a").join(text.select(F.col("doc_id").alias("b"), F.col("text").alias("t")), "b")
    return rows.select("a", "b", "s", "t").mapInArrow(run, "a long, b long, similarity double").distinct()


def _classes(sketches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(copies, members): (doc_id, class_id) of texts that aren't the first of their class, and
    (class_id, size) of classes of several. Counted before the shuffle, so a class with a third
    of all texts costs one row a task; the join back meets a hot key with one row of the other side."""
    several = sketches.select("doc_id", "class_key").groupBy("class_key").agg(F.min("doc_id").alias("class_id"), F.countDistinct("doc_id").alias("size")).where("size > 1")
    several = saved(several)
    held = sketches.select("doc_id", "class_key").join(several, "class_key").where("doc_id <> class_id")
    return saved(held.select("doc_id", "class_id").distinct()), several.select("class_id", "size")


def near_duplicate_classes(documents: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, retained: int = RETAINED) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): members (doc_id, class_id, size) of every text with at least one sequence;
    pairs (a, b, similarity), a < b, of class ids whose texts are similar and differ.

    Null ids and texts, and texts of fewer words than ``width``, are in no class. Ids are
    expected to be unique; repeated rows with one id and one text count once.
    """
    sketches = saved(_sketches(documents, width, retained, threshold))
    copies, sizes = _classes(sketches)
    # copies are the few; the sketches of all others stay where they are if the planner can broadcast them
    first = sketches.join(copies.select("doc_id"), "doc_id", "left_anti")
    alone = first.select("doc_id", F.col("doc_id").alias("class_id")).distinct()
    members = alone.unionByName(copies).join(sizes, "class_id", "left").select("doc_id", "class_id", F.coalesce("size", F.lit(1)).alias("size"))
    most = max(w.places * w.orders for w in scheme(threshold, documents.count())[1])
    met = _met_in_turns(first.select("doc_id", "n", "listed"), threshold, -(-most // _AT_ONCE))
    close = saved(_estimated(met, first, threshold, retained))
    return members, _verified(close, documents, width, threshold)


def near_duplicate_pairs(documents: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, expand: int | None = 100) -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b: all pairs of similar texts.

    Classes of equal texts with up to ``expand`` members appear as all their pairs, every class if it
    is None. A larger class appears as its first member with each other one, and stands for its members in
    pairs with other classes, so that no link is lost and no group is squared.
    """
    members, pairs = near_duplicate_classes(documents, width, threshold)
    multiple = saved(members.where("size > 1"))
    small = multiple if expand is None else multiple.where(F.col("size") <= expand)
    pieces = F.ceil(F.col("size") / _MEMBERS).cast("int")  # of a large class, each paired by a task of its own
    left = small.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    right = small.withColumn("piece", F.pmod(F.xxhash64("doc_id"), pieces).cast("int"))
    same = (F.col("l.class_id") == F.col("r.class_id")) & (F.col("l.piece") == F.col("r.piece"))
    within = left.alias("l").join(right.alias("r"), same & (F.col("l.doc_id") < F.col("r.doc_id"))).select(F.col("l.doc_id").alias("doc_a"), F.col("r.doc_id").alias("doc_b"))
    # a class without copies stands for itself
    stand = lambda c: small.select(F.col("class_id").alias(c), F.col("doc_id").alias(f"{c}_doc"))
    across = (
        pairs.join(stand("a"), "a", "left").join(stand("b"), "b", "left")
        .select(F.coalesce("a_doc", "a").alias("x"), F.coalesce("b_doc", "b").alias("y"))
        .select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b"))
    )
    if expand is not None:
        within = within.union(multiple.where((F.col("size") > expand) & (F.col("doc_id") != F.col("class_id"))).select(F.col("class_id").alias("doc_a"), F.col("doc_id").alias("doc_b")))
    return within.union(across).distinct()
