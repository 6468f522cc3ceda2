import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicgrain.llm import components, entity_match, leaks, mixing, name_variants, near_duplicates, personal_information, repeated_lines, scan_noise
from civicgrain.llm.words import words

DOCS = "doc_id long, text string, body_id string, a string, b string, key string, n int"  # names that clash with inner ones


def frame(spark, rows, schema=DOCS):
    width = len(schema.split(","))
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)


def random_text(rng, n=80, vocabulary=400):
    return " ".join(f"w{rng.randint(0, vocabulary)}" for _ in range(n))


def jaccard(s, t, width):
    grams = lambda x: {tuple(x[i : i + width]) for i in range(len(x) - width + 1)}
    a, b = grams(words(s)), grams(words(t))
    return len(a & b) / len(a | b) if a | b else 0


@pytest.mark.parametrize("width,threshold", [(3, 0.7), (5, 0.8)])
def test_near_duplicates_against_brute_force(spark, width, threshold):
    rng = random.Random(width)
    texts = [random_text(rng) for _ in range(60)]
    for t in texts[:40]:
        parts = t.split()
        for _ in range(rng.randint(0, 6)):
            parts[rng.randrange(len(parts))] = f"x{rng.randint(0, 99999)}"
        texts.append(" ".join(parts))
    texts += [texts[0].upper(), texts[0] + " !!", None, "", "two words"]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {(r.doc_a, r.doc_b) for r in near_duplicates.near_duplicate_pairs(frame(spark, rows), width, threshold).collect()}
    want = {(i, j) for i, s in rows for j, t in rows if i < j and s and t and jaccard(s, t, width) >= threshold}
    assert got == want and len(want) > 10


def test_near_duplicates_of_common_phrases(spark):
    """Texts all of whose sequences are common still meet."""
    rng = random.Random(9)
    parts = [random_text(rng, 30) for _ in range(12)]
    combos = [rng.sample(range(12), 9) for _ in range(120)]
    texts = [" ".join(parts[k] for k in sorted(c)) for c in combos]
    rows = list(enumerate(texts))
    got = {(r.doc_a, r.doc_b) for r in near_duplicates.near_duplicate_pairs(frame(spark, rows), 3, 0.7).collect()}
    want = {(i, j) for i, s in rows for j, t in rows if i < j and jaccard(s, t, 3) >= 0.7}
    assert got <= want and len(got) >= 0.99 * len(want)


def test_near_duplicates_of_a_large_family(spark):
    """200 versions that share their edits in groups of ten: nearly all they have in common is on long lists."""
    rng = random.Random(21)
    base, passages = random_text(rng, 500, 10**6).split(), [random_text(rng, 41, 10**6).split() for _ in range(20)]
    texts = []
    for i in range(200):
        at = rng.randrange(300, 440)
        own = [f"own{i}x{k}" for k in range(5)]
        texts.append(" ".join(base[:100] + passages[i // 10] + base[141:at] + own + base[at + 5 :]))
    grams = [{tuple(w[k : k + 3]) for k in range(len(w) - 2)} for w in map(words, texts)]
    want = {(i, j) for j in range(200) for i in range(j) if len(grams[i] & grams[j]) >= 0.7 * len(grams[i] | grams[j])}
    got = {(r.doc_a, r.doc_b) for r in near_duplicates.near_duplicate_pairs(frame(spark, list(enumerate(texts))), 3, 0.7).collect()}
    assert len(want) == 19900 and got <= want and len(got) >= 0.999 * len(want)


def test_near_duplicates_contained_in_longer_texts(spark):
    """The bound on shared values holds for a text that is part of the other one at a similarity just above the threshold."""
    rng = random.Random(22)
    texts = [random_text(rng, 502, 10**6) for _ in range(400)]
    rows = [(2 * i, t) for i, t in enumerate(texts)] + [(2 * i + 1, " ".join(t.split()[:354])) for i, t in enumerate(texts)]
    _, pairs = near_duplicates.near_duplicate_classes(frame(spark, rows), 3, 0.7)
    got = {(r.a, r.b) for r in pairs.collect()}
    assert got <= {(2 * i, 2 * i + 1) for i in range(400)} and len(got) >= 0.99 * 400


@pytest.mark.parametrize("revisions,copies", [(4, 10), (5, 5), (1, 200)])
def test_near_duplicates_of_revised_templates(spark, revisions, copies):
    """Revisions of one template, each filled in many times: pairs within and across revisions are found, and no list is dropped."""
    rng = random.Random(revisions)
    base = random_text(rng, 400, 10**6).split()
    changed = [base[:50] + random_text(rng, 30, 10**6).split() + base[80:] for _ in range(revisions)]
    texts = []
    for w in changed:
        for _ in range(copies):
            at = rng.randrange(100, 390)
            texts.append(" ".join(w[:at] + random_text(rng, 6, 10**6).split() + w[at + 6 :]))
    grams = [{tuple(w[k : k + 3]) for k in range(len(w) - 2)} for w in map(words, texts)]
    want = {(i, j) for j in range(len(texts)) for i in range(j) if len(grams[i] & grams[j]) >= 0.7 * len(grams[i] | grams[j])}
    rows = list(enumerate(texts)) + [(1000 + i, random_text(rng, 100, 10**6)) for i in range(20)]
    got = {(r.doc_a, r.doc_b) for r in near_duplicates.near_duplicate_pairs(frame(spark, rows), 3, 0.7).collect()}
    assert got == want and len(want) > 250


def test_long_lists_are_split(spark, monkeypatch):
    """A list of a third of all texts is paired block by block, and gives the pairs it gives in one piece."""
    lists = [np.array([7, 8, i + 100], np.uint64) for i in range(60)] + [np.array([1000 + i], np.uint64) for i in range(120)]
    rows = spark.createDataFrame([(i, 10, bytearray(x.tobytes())) for i, x in enumerate(lists)], "doc_id long, n int, listed binary")
    postings = near_duplicates._postings(rows.selectExpr("doc_id", "n", "unhex(repeat(hex(listed), if(doc_id < 60, 10, 1))) as listed"))  # counts of 1,200, so five blocks
    assert postings.groupBy("list").count().agg(F.max("count")).first()[0] < 900 and postings.where("side = 1").count() > 0
    assert {(r.a, r.b) for r in near_duplicates._met(postings, 0.7).collect()} == {(i, j) for j in range(60) for i in range(j)}


def test_lists_that_share_a_counter_are_not_split(spark):
    """What a list is split by is its own length, so a text has one row for each short list however many lists there are."""
    lists = [np.array([(i + 1) << 24], np.uint64) for i in range(600)]
    rows = spark.createDataFrame([(i, 10, bytearray(x.tobytes())) for i, x in enumerate(lists)], "doc_id long, n int, listed binary")
    assert near_duplicates._postings(rows).count() == 600


def test_sampled_lengths_split_only_long_lists(spark, monkeypatch):
    """Of more texts than are sampled, a long list is seen, and all its pairs come out with it."""
    monkeypatch.setattr(near_duplicates, "_SAMPLED", 500)
    lists = [np.array([7 << 24, 8 << 24, (i + 100) << 24], np.uint64) for i in range(1000)]
    rows = spark.createDataFrame([(i, 10, bytearray(x.tobytes())) for i, x in enumerate(lists)], "doc_id long, n int, listed binary")
    known, length = near_duplicates._long(rows, 8)
    assert known.tolist() == [7 << 24, 8 << 24] and (abs(length - 1000) < 300).all()
    assert near_duplicates._met(near_duplicates._postings(rows), 0.7).count() == 1000 * 999 // 2


def test_meetings_are_added_over_turns(spark):
    """Texts that meet once in each of two turns have met twice."""
    pack = lambda keys: bytearray(b"".join(int(k).to_bytes(near_duplicates._KEY, "little") for k in keys))
    rows = spark.createDataFrame([(1, 9, pack([10, 11])), (2, 9, pack([10, 11])), (3, 9, pack([10, 20])), (4, 9, pack([30, 33]))], "doc_id long, n int, listed binary")
    for turns in (1, 2, 3):
        assert [tuple(r) for r in near_duplicates._met_in_turns(rows, 0.7, turns).collect()] == [(1, 2)]
    sent = [near_duplicates._postings(rows, near_duplicates._KEY, None, t, 2).count() for t in (0, 1)]
    assert sent == [5, 3]


def test_large_class_of_copies_is_a_star(spark):
    rows = [(i, "one two three four five six") for i in range(30)]
    got = {(r.doc_a, r.doc_b) for r in near_duplicates.near_duplicate_pairs(frame(spark, rows), 3, 0.7, expand=10).collect()}
    assert got == {(0, i) for i in range(1, 30)}


def similar(rows, width, threshold):
    grams = [(i, {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}) for i, w in ((i, words(t)) for i, t in rows)]
    return {(i, j) for n, (j, y) in enumerate(grams) for i, x in grams[:n] if x | y and len(x & y) >= threshold * len(x | y) - 1e-9}


def test_short_texts_of_common_phrases_are_all_paired(spark):
    """Notices of a few words, each with one word of its own: all they share is common to all of them."""
    phrases = ["call to order and roll", "the board will meet today at noon", "minutes of the last meeting were read aloud by the clerk"]
    texts = phrases + [f"{p} own{k}x{i}" for k, p in enumerate(phrases) for i in range(300)]
    rows = list(enumerate(texts))
    got = {(r.doc_a, r.doc_b) for r in near_duplicates.near_duplicate_pairs(frame(spark, rows), 3, 0.7).collect()}
    assert got == similar(rows, 3, 0.7) and len(got) > 45_000


def test_texts_that_share_one_sequence_are_paired(spark):
    rows = [(0, "a b c"), (1, "a b c d"), (2, "x b c d"), (3, "e f g h")]
    got = {(r.doc_a, r.doc_b) for r in near_duplicates.near_duplicate_pairs(frame(spark, rows), 3, 0.5).collect()}
    assert got == similar(rows, 3, 0.5) == {(0, 1)}


@pytest.mark.parametrize("threshold", [0.5, 0.7, 0.95, 1.0])
def test_pieces_of_common_texts_are_all_paired(spark, threshold):
    """Texts of every length that are pieces of few others: not one of their sequences is rare."""
    rng = random.Random(31)
    bases = [random_text(rng, 60, 10**6).split() for _ in range(2)]
    texts = set()
    for _ in range(700):
        base, n = rng.choice(bases), rng.randint(3, 45)
        at = rng.randint(0, len(base) - n)
        texts.add(" ".join(base[at : at + n]))
    rows = list(enumerate(sorted(texts)))
    got = {(r.doc_a, r.doc_b) for r in near_duplicates.near_duplicate_pairs(frame(spark, rows), 3, threshold).collect()}
    assert got == similar(rows, 3, threshold) and (len(got) > 200 or threshold == 1)


@pytest.mark.parametrize("union", [11, 14, 40, 257, 400, 1500])
@pytest.mark.parametrize("contained", [True, False])
def test_similar_texts_meet_whatever_their_sizes(union, contained):
    """At the threshold pairs meet as often as is reckoned: the fewest meetings of 300 pairs are far from one."""
    rng = np.random.default_rng(union)
    shared = -(-union * 7 // 10)
    met = []
    for _ in range(300):
        found = rng.integers(0, 1 << 63, union, dtype=np.uint64)
        half = shared + (0 if contained else (union - shared) // 2)
        x, y = (found, found[:shared]) if contained else (found[:half], np.r_[found[:shared], found[half:]])
        met.append(len(np.intersect1d(*(near_duplicates.entered(np.sort(t), 0.7, 100_000) for t in (x, y)))))
    assert min(met) >= 2 and (np.mean(met) > 20 or max(len(x), len(y)) <= near_duplicates.scheme(0.7, 100_000)[0])


def test_registered_query_pairs_all_copies(spark, tmp_path):
    """The query's SQL gives every pair of equal texts, in a class of any size."""
    from civicgrain.llm import queries

    rows = [(i, "one two three four five six") for i in range(130)] + [(200 + i, "one two three four five six seven") for i in range(3)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r.doc_a, r.doc_b) for r in queries.QUERIES["p2_found"](spark, str(tmp_path)).collect()}
    assert got == similar(rows, 3, 0.7) and len(got) == 133 * 132 // 2


def union_find(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("kind", ["random", "chain", "star", "long"])
def test_components(spark, kind):
    rng = random.Random(1)
    order = list(range(300))
    rng.shuffle(order)
    links = {
        "random": [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)],
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(1000, i) for i in range(50)] + [(i, i + 500) for i in range(0, 50, 7)] + [(2000, 2001)],
        "long": list(zip(order, order[1:])) + [(order[150], 5000 + i) for i in range(9)],
    }[kind]
    got = {r.id: r.group_id for r in components.connected_components(spark.createDataFrame(links, "x int, y int")).collect()}
    assert got == {k: v for k, v in union_find([(a, b) for a, b in links if a != b]).items()}


def test_valid_links(spark):
    m = spark.createDataFrame([(1, 1, 2, 0.9, "2024-01-01"), (2, 2, 1, 0.1, "2024-01-02"), (3, 3, 4, 0.5, "2024-01-01"), (4, 5, 5, 0.9, "2024-01-01"), (5, 6, 99, 0.9, "2024-01-01"), (6, 7, 8, None, "2024-01-01"), (7, None, 3, 0.9, None)], "match_id int, left_id int, right_id int, score double, matched_at string")
    records = spark.createDataFrame([(i,) for i in range(1, 10)], "signal_id int")
    assert [tuple(r) for r in components.valid_links(m, records).collect()] == [(3, 4)]
    assert components.group_records(m.limit(0), records).count() == 0


def test_repeated_lines_against_brute_force(spark):
    rng = random.Random(4)
    notice = "Copyright 20%d Town of Example. All rights reserved."
    rows = []
    for i in range(60):
        lines = [random_text(rng, 8) for _ in range(rng.randint(0, 5))]
        if i % 3 == 0:
            lines.insert(0, notice % rng.randint(10, 24))
        rows.append((i, "\n".join(lines), f"body{i % 2}"))
    rows += [(100, None, "body0"), (101, notice % 9, None), (102, "", "body1")]
    got = {(r.doc_id, r.line_no) for r in repeated_lines.recurring_lines(frame(spark, rows)).collect()}
    docs, size = defaultdict(set), defaultdict(int)
    key = lambda x: "".join(c for c in x.lower() if c.isalpha())
    for i, t, b in rows:
        if t is not None and b is not None:
            size[b] += 1
            for x in t.split("\n"):
                if len(x.strip()) >= 25:
                    docs[b, key(x)].add(i)
    want = {(i, k) for i, t, b in rows if t is not None and b is not None for k, x in enumerate(t.split("\n")) if len(x.strip()) >= 25 and len(docs[b, key(x)]) >= max(6, 0.15 * size[b])}
    assert got == want and want
    clean = {r.doc_id: r.text for r in repeated_lines.without_recurring_lines(frame(spark, rows)).collect()}
    assert clean[100] is None and clean[101] == notice % 9 and "All rights" not in clean[0] and len(clean) == len(rows)


def test_summaries_lose_nothing_when_cut(spark, monkeypatch):
    monkeypatch.setattr(repeated_lines, "_COUNTERS", 3)
    rows = [(i, "\n".join([f"this is a filler line number {'abcdefghij'[i % 10] * (j + 1)} x{chr(97 + i % 26)}" for j in range(6)] + ["a notice that stands in all of these texts"]), "b") for i in range(40)]
    got = {(r.doc_id, r.line_no) for r in repeated_lines.recurring_lines(frame(spark, rows).coalesce(2)).collect()}
    assert {(i, 6) for i in range(40)} <= got


def edit_distance(p, t):
    row = [0] * (len(t) + 1)
    for i, x in enumerate(p, 1):
        new = [i]
        for j, y in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_myers():
    rng = random.Random(2)
    for _ in range(300):
        p = [rng.randint(1, 4) for _ in range(rng.randint(1, 12))]
        t = [rng.randint(1, 4) for _ in range(rng.randint(0, 25))]
        assert leaks.myers_distance(p, t) == edit_distance(p, t)


def test_leaks_against_brute_force(spark):
    rng = random.Random(8)
    items = [(i, random_text(rng, 40, 50)) for i in range(12)] + [(50, "short item"), (51, None), (52, "")]
    docs = []
    for i in range(60):
        n, start, body = rng.randint(8, 20), rng.randint(0, 20), random_text(rng, 60, 50).split()
        piece = items[i % 12][1].split()[start : start + n]
        docs.append((i, " ".join(body[:30]) + " " + " -- ".join(piece).upper() + " " + " ".join(body[30:])))
    docs += [(100, None), (101, ""), (0, docs[0][1])]
    want = set()
    for i, t in docs:
        w = words(t or "")
        grams = {tuple(w[k : k + 12]) for k in range(len(w) - 11)}
        for j, x in items:
            v = words(x or "")
            if any(tuple(v[k : k + 12]) in grams for k in range(len(v) - 11)):
                want.add((i, j))
    got = leaks.find_leaks(frame(spark, docs), spark.createDataFrame(items, "item_id int, text string"))
    assert {(r.doc_id, r.item_id) for r in got.where("exact_words >= 12").collect()} == want
    assert leaks.find_leaks(frame(spark, docs), spark.createDataFrame([], "item_id int, text string")).count() == 0


@pytest.mark.parametrize("errors", [0, 1, 2])
def test_leaks_of_items_of_all_lengths(spark, errors):
    """Items of 1 to 20 words with one word replaced, added or left out, against edit distance over all passages."""
    rng = random.Random(errors)
    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in range(1, 21)]
    docs = []
    for n, text in items:
        for change in range(n):
            w = text.split()
            kind = rng.choice(["replace", "add", "leave", "none", "two"])
            if kind in ("replace", "two"):
                w[change] = "other"
            if kind == "two":
                w[rng.randrange(n)] = "another"
            if kind == "add":
                w.insert(change, "other")
            if kind == "leave":
                del w[change]
            docs.append((len(docs), " ".join(["x"] * rng.randint(0, 5) + w + ["y"] * rng.randint(0, 5))))
    want = {}
    for d, t in docs:
        for i, x in items:
            v, w = x.split(), t.split()
            width = min(12, len(v))
            least = min(edit_distance(v[s : s + width], w) for s in range(len(v) - width + 1))
            if least <= (errors if width >= 2 * (errors + 1) else 0):
                want[d, i] = least
    got = leaks.find_leaks(frame(spark, docs), spark.createDataFrame(items, "item_id int, text string"), errors=errors)
    assert {(r.doc_id, r.item_id): r.distance for r in got.collect()} == want


def test_many_leak_items_take_one_scan(spark):
    items = spark.range(10_000).selectExpr("cast(id as int) as item_id", "concat_ws(' ', transform(sequence(1, 15), k -> concat('w', id, 'x', k))) as text")
    docs = frame(spark, [(1, " ".join(f"w77x{k}" for k in range(1, 16))), (2, "nothing of it")])
    got = leaks.find_leaks(docs, items)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert [tuple(r) for r in got.collect()] == [(1, 77, 0, 12)]


def test_leak_with_an_error(spark):
    item = " ".join(f"w{i}" for i in range(20))
    doc = item.replace("w9 ", "zzz ")
    (row,) = leaks.find_leaks(frame(spark, [(1, doc)]), spark.createDataFrame([(7, item)], "item_id int, text string")).collect()
    assert row.distance == 0 or row.distance == 1


def test_mixing(spark):
    rng = random.Random(5)
    sizes = {"Big ": 300, "small": 20}
    rows = [(k * 1000 + i, random_text(rng, 30), None, s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    rows += [(9001, rows[0][1], None, "small"), (9002, None, None, "small"), (9003, "x", None, None)]
    docs = frame(spark, rows, "doc_id long, text string, body_id string, source string, tokens int, copies int")
    targets = spark.createDataFrame([("big", 0.5, 1), ("SMALL", 0.3, 3), ("none", 0.2, 2), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    mix, report = mixing.mix_sources(docs, targets, mixing.tokenizer())
    used, shares = mix.collect(), {r.source: r for r in report.collect()}
    assert max(r.copies for r in used if r.source == "small") <= 3 and max(r.copies for r in used if r.source == "big") == 1
    assert {r.doc_id for r in used}.isdisjoint({9001, 9002, 9003})
    assert abs(shares["big"].share / shares["small"].share - 5 / 3) < 0.1 and shares["none"].used_tokens == 0
    epochs = [r.copies for r in used if r.source == "small"]
    assert max(epochs) - min(epochs) <= 1 and len(epochs) == 20  # complete epochs come before a part of one
    assert sorted(map(tuple, used)) == sorted(map(tuple, mixing.mix_sources(docs.repartition(3), targets, mixing.tokenizer())[0].collect()))
    assert mixing.mix_sources(docs.limit(0), targets, mixing.tokenizer())[0].count() == 0


@pytest.mark.parametrize("weight", [1.0, 0.25, 0.01])
def test_slices_of_a_source_are_even_at_any_weight(spark, weight):
    """A source of texts of one quality: no slice of its keys holds more than a hundredth of it."""
    u = (F.col("id") + 0.5) / 20_000
    rows = spark.range(20_000).select(F.floor(F.log2(-F.log(u) / weight) * mixing._SLICES).alias("slice"))
    assert rows.groupBy("slice").count().agg(F.max("count")).first()[0] <= 200


def test_mixing_of_a_text_shared_with_a_source_without_target(spark):
    rows = [(1, "one two three four", "other"), (2, "one two three four", "big"), (3, "five six seven", "big"), (4, "five six seven", "big")]
    docs = frame(spark, rows, "doc_id long, text string, source string")
    mix, _ = mixing.mix_sources(docs, spark.createDataFrame([("big", 1.0, 1)], "source string, target_share double, max_repeats int"), mixing.tokenizer())
    assert {(r.doc_id, r.copies) for r in mix.collect()} == {(2, 1), (3, 1)}


PII = "Motion by %s, seconded by %s, to accept it; carried. The clerk attached the claim of Mr. Quillrel, SSN 901-22-3344, residing at 12 Oak St, Apt 4, Riverton, NY 00123. Call (516) 555-0100 ext. 3 or write to A.b+c@mail.example. Sheet 202.188.6642 shows it. Purchase order 435-46-6629 was closed. The drawings for %s Elementary School are on file."


def test_personal_information(spark):
    given = "James Robert Mary Linda Susan David Zorba Ximena".split()
    rng = random.Random(6)
    rows = [(i, PII % (f"{rng.choice(given)} Brenwick", f"{rng.choice(given)} Q. Talrow", "Zorba Ruddale")) for i in range(60)] + [(100, None), (101, "")]
    found = {(r.doc_id, r.pii_kind, r.found) for r in personal_information.find_personal_information(frame(spark, rows)).collect()}
    kinds = defaultdict(set)
    for _, k, f in found:
        kinds[k].add(f)
    assert kinds["email"] == {"A.b+c@mail.example"} and kinds["phone"] == {"(516) 555-0100"} and kinds["id_number"] == {"901-22-3344"}
    assert kinds["address"] == {"12 Oak St, Apt 4, Riverton, NY 00123"}
    assert {"Zorba Brenwick", "Ximena Q. Talrow", "Quillrel"} <= kinds["name"] and not any("Ruddale" in n for n in kinds["name"])
    text = {r.doc_id: r.text for r in personal_information.redact(frame(spark, rows)).collect()}
    assert "[EMAIL]" in text[0] and "[SSN" not in text[0] and "901-22" not in text[0] and text[100] is None and text[101] == ""


def test_mail_of_any_length_and_other_states(spark):
    rows = [(1, "Write to " + "a" * 300 + "@" + "b" * 200 + ".example now."), (2, "He lives at 12 Oak St, Dover, NJ 07801 and at 4 Elm Avenue, Salem, Oregon.")]
    found = {(r.doc_id, r.pii_kind, r.found) for r in personal_information.find_personal_information(frame(spark, rows)).collect()}
    assert (1, "email", "a" * 300 + "@" + "b" * 200 + ".example") in found and (2, "address", "12 Oak St, Dover, NJ 07801") in found and (2, "address", "4 Elm Avenue") in found


def test_words_that_make_a_name_something_else_are_learned(spark):
    """No list holds the word after the name: names before it never stand in confident contexts."""
    given = "James Robert Mary Linda Susan David".split()
    rng = random.Random(9)
    body = "Motion by %s Brenwick, seconded by %s Talrow, to accept it. The drawings for %s Ruddale Zoological Pavilion are on file. Moved by %s Vennar Zoological."
    rows = [(i, body % tuple(rng.choice(given) for _ in range(4))) for i in range(60)]
    # a few of many end here by misreading, and by their number alone would make the context a sure one
    rows += [(100 + i, f"The drawings for {g} Ruddale zoological pavilion are on file.") for i, g in enumerate(given[:4])]
    names = {r.found for r in personal_information.find_personal_information(frame(spark, rows)).collect()}
    assert any("Brenwick" in n for n in names) and any("Talrow" in n for n in names) and sum("Ruddale" in n for n in names) <= 4


def test_loose_forms_need_confident_contexts(spark):
    rows = [(i, f"The clerk, residing at {i + 1} Oak Street, was present. Write to the clerk at box{i}@mail.example for a copy.") for i in range(40)]
    rows += [(100, "The clerk, residing at 7 Broadmoor, was present. Room 7 Broadmoor is closed."), (101, "Write to the clerk at office (at) mail (dot) example for a copy. Meet at noon dot com.")]
    found = [(r.doc_id, r.pii_kind, r.found) for r in personal_information.find_personal_information(frame(spark, rows)).where("doc_id >= 100").collect()]
    assert found.count((100, "address", "7 Broadmoor")) == 1 and (101, "email", "office (at) mail (dot) example") in found and len(found) == 2


def noisy(rng, word):
    i = rng.randrange(1, len(word) - 1)
    return rng.choice([word[:i] + "|" + word[i:], " ".join(word), word.replace("e", "c", 1) if "e" in word else word[:i] + "~" + word[i:]])


def test_scan_noise(spark):
    rng = random.Random(11)
    vocabulary = "committee superintendent elevator modernization approved maintenance agreement treasurer reserve balance library entrance questioned department warranty schedule".split()
    rows, noise, broken = [], set(), set()
    for d in range(120):
        lines = []
        for p in range(3):
            lines.append(f"Village of Example Minutes of June {d % 28 + 1}, 2024")
            for i in range(12):
                ws = [rng.choice(vocabulary) for _ in range(9)]
                if rng.random() < 0.08:
                    ws[4] = noisy(rng, ws[4])
                    noise.add((d, len(lines)))
                lines.append(" ".join(ws))
            w = "modernization"
            lines[-1] += " moder-"
            broken.add((d, len(lines) - 1))
            lines.append("nization of the library")
            lines.append(f"Page {p + 1}")
        rows.append((d, "\n".join(lines)))
    rows += [(900, None), (901, "")]
    docs = frame(spark, rows)
    got = {(r.doc_id, r.line_no, r.noise_kind) for r in scan_noise.read_pages(docs, repair=False).select("doc_id", F.inline("noise")).collect()}
    kind = lambda k: {(d, i) for d, i, x in got if x == k}
    furniture = {(d, i) for d, t in rows if t for i, x in enumerate(t.split("\n")) if re.match(r"Village of|Page \d", x)}
    assert kind("furniture") == furniture and kind("hyphen") == broken
    hit = kind("chars")
    assert len(hit & noise) >= 0.9 * len(noise) and len(hit - noise) <= 0.02 * len(hit)
    text = {r.doc_id: r.text for r in scan_noise.read_pages(docs).collect()}
    assert "Page" not in text[0] and "modernization of the library" in text[0] and text[901] == "" and 900 not in text


def test_split_words_whose_halves_recur(spark):
    """Halves that stand often enough to be in the dictionary are still halves of a far commoner word."""
    rows = [(i, "the superintendent spoke of transportation to the school\nand the superintendent left the meeting") for i in range(100)]
    rows += [(200 + i, "the superinten dent spoke of a schedule\nat the school") for i in range(4)]
    rows += [(300 + i, "the committee spoke of transp-\nortation to the school") for i in range(10)] + [(400, "the school has transp ortation to the meeting")]
    got = {tuple(r) for r in scan_noise.read_pages(frame(spark, rows), repair=False).select("doc_id", F.inline("noise")).collect()}
    assert {(d, i) for d, i, k in got if k == "chars"} == {(200 + i, 0) for i in range(4)} | {(400, 0)}
    assert {(d, i) for d, i, k in got if k == "hyphen"} == {(300 + i, 0) for i in range(10)}


def test_line_joins_are_learned():
    """The join perceptron keeps compounds the corpus writes, and joins words it knows and words it doesn't."""
    letters = "abcdefghiklmnoprstu"
    rng = random.Random(13)
    made = lambda n: "".join(rng.choice(letters) for _ in range(n))
    counts = {made(rng.randint(6, 12)): rng.randint(3, 300) for _ in range(600)}
    halves = {made(5): 50 for _ in range(40)}
    names = list(halves)
    compounds = {f"{a}-{b}": 10 for a, b in zip(names[::2], names[1::2])}
    model = scan_noise.Model(counts | halves | compounds, set(compounds), scan_noise.Editor(["=", ""], np.zeros((scan_noise._HASH, 2), np.float32)), np.zeros(1), {})
    model.joins = scan_noise._train_joins(model, list(counts))
    for c in compounds:
        a, b = c.split("-")
        assert model.broken(f"the {a}-", f"{b} of") is None
    word = next(iter(counts))
    assert model.broken(f"the {word[:3]}-", f"{word[3:]} of") == word
    assert model.broken("the zzyzzq-", "quxzzum of") == "zzyzzqquxzzum"  # neither part is a word
    assert model.broken("the zzy-", "Quxzzum") is None and model.broken("no hyphen", "below") is None


def test_capitalised_split_words(spark):
    """A split word is looked for at a capital too, in ``prepare`` as in ``line``."""
    rows = [(i, "The board recommended the library and was recommended\nto the school") for i in range(40)] + [(99, "Recom mended by the board")]
    got = {tuple(r) for r in scan_noise.read_pages(frame(spark, rows), repair=False).select("doc_id", F.inline("noise")).collect()}
    assert (99, 0, "chars") in got


def test_dictionary_is_whole_or_an_error(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    made = [letters[i // 17576] + letters[i // 676 % 26] + letters[i // 26 % 26] + letters[i % 26] for i in range(81_000)]
    docs = frame(spark, [(i, " ".join(made)) for i in range(3)])
    assert len(scan_noise.train(docs).counts) == 81_000
    with pytest.raises(ValueError, match="more than 80999 words"):
        scan_noise.train(docs, lexicon=80_999)


def test_name_variants(spark):
    vendors = ['[{"name": "Kellostock & Duntuman Roofing Inc.", "role": "x"}]'] * 5 + ['["THE DUNTUMAN AND KELLOSTOCK ROOFG. LLC"]', '["Kelostock-Duntuman Rfg Corp."]', '["Kellostock Roofing Inc."]', '["Kellostock & Duntuman Plumbing Inc."]', '[{"vendor": "William Thaxloard"}]', '["Thaxloard, Bill P.E."]', '["W. Thaxloard"]', "null", "bad json", None]
    rows = [(i, 1, v, b) for i, (v, b) in enumerate(zip(vendors, ["Lorster High School"] * 5 + ["Lorster H.S.", "High Sch, Lorstr", "Lorster Library", "", None, "Districtwide", "X", "X", "X", "X"]))]
    signals = spark.createDataFrame(rows, "signal_id int, document_id int, vendors_named string, building string")
    docs = spark.createDataFrame([(1, "b1"), (2, None)], "doc_id long, body_id string")
    got = {(r.field, r.body_id, r.spelling_a, r.spelling_b) for r in name_variants.spelling_pairs(signals, docs).collect()}
    linked = {frozenset(x[2:]) for x in got}
    assert frozenset(["Kellostock & Duntuman Roofing Inc.", "THE DUNTUMAN AND KELLOSTOCK ROOFG. LLC"]) in linked
    assert frozenset(["Kellostock & Duntuman Roofing Inc.", "Kelostock-Duntuman Rfg Corp."]) in linked
    assert frozenset(["William Thaxloard", "Thaxloard, Bill P.E."]) in linked and frozenset(["William Thaxloard", "W. Thaxloard"]) in linked
    assert frozenset(["Lorster High School", "Lorster H.S."]) in linked and frozenset(["Lorster High School", "High Sch, Lorstr"]) in linked
    assert not any("Plumbing" in s or s == "Kellostock Roofing Inc." or s == "Lorster Library" for pair in linked for s in pair)
    assert name_variants.spelling_pairs(signals.limit(0), docs).count() == 0


def test_assignment_against_all_permutations():
    from itertools import permutations

    rng = random.Random(7)
    for _ in range(300):
        n = rng.randint(1, 5)
        costs = [[rng.choice([0.0, 0.1, 0.3, 0.4, 1000.0]) for _ in range(n)] for _ in range(n)]
        assert abs(name_variants.least_assignment(costs) - min(sum(costs[i][j] for i, j in enumerate(p)) for p in permutations(range(n)))) < 1e-9
    assert name_variants.assign(["thaxloard", "william"], ["william", "thaxloard", "q"], {}, True) == 0 and name_variants.assign(["a"], ["a", "bcd"], {}, True) is None
    eight = "one two three four five six seven eight".split()
    assert name_variants.assign(eight, eight[::-1], {}, False) == 0


def test_abbreviated_names(spark):
    assert name_variants._cost("assoc", "associates", {}) == name_variants._cost("brothers", "bros", {}) == 0.2 and name_variants._cost("dun", "kell", {}) is None
    vendors = ["Kellostock Associates Roofing Inc.", "Kellostock Assoc. Roofing", "Duntuman Brothers Plumbing", "Duntuman Bros Plumbing LLC", "Duntuman Brewster Plumbing", "Tellorqua Associates Roofing"]
    signals = spark.createDataFrame([(1, f'["{v}"]', None) for v in vendors], "document_id int, vendors_named string, building string")
    got = {(r.spelling_a, r.spelling_b) for r in name_variants.spelling_pairs(signals, spark.createDataFrame([(1, "b1")], "doc_id long, body_id string")).collect()}
    assert got == {("Kellostock Assoc. Roofing", "Kellostock Associates Roofing Inc."), ("Duntuman Bros Plumbing LLC", "Duntuman Brothers Plumbing")}


def test_name_variants_that_are_common(spark):
    """A misspelling is linked however many rows it has, a tie too, if all else in the spelling agrees."""
    counts = {"Kramtuini Middle School": 110, "Kratmuini Mid. School": 49, "Kramtuini Library": 20, "Kratmuini Pool": 20, "Brenwick High School": 8, "Brenwikc H.S.": 8, "Ward 1234 School": 5, "Ward 1235 School": 5}
    rows = [(1, '["Tellorqua Roofing Inc.", "Thaxloard, Bill", "Ann Thaxlord"]', b) if k % 2 else (1, '["Telorqua Rfg", "William Q. Thaxlaord", "Tellorqa Plumbing"]', b) for b, n in counts.items() for k in range(n)]
    signals = spark.createDataFrame(rows, "document_id int, vendors_named string, building string")
    got = {(r.spelling_a, r.spelling_b) for r in name_variants.spelling_pairs(signals, spark.createDataFrame([(1, "b1")], "doc_id long, body_id string")).collect()}
    assert got == {("Kramtuini Middle School", "Kratmuini Mid. School"), ("Brenwick High School", "Brenwikc H.S."), ("Tellorqua Roofing Inc.", "Telorqua Rfg"), ("Thaxloard, Bill", "William Q. Thaxlaord")}


def test_entities(spark):
    bodies = [("b1", "Upper Tamdwindale Union Free School District", "Ulmstead", "http://www.uppertamdwindaleufsd.example"), ("b2", "Tamdwindale Union Free School District", "Ulmstead", None), ("b3", "Zellermoor Fire District", "Wynholt", None), ("b4", "Zellermoor Fire District", "Corvane", None), ("b5", None, None, None)]
    units = [(1, "UP. TAMDWINDALE U F S D", "County of Ulmstead", None), (2, "Tamdwindlae Union Free Schools", "ULMSTEAD", "n/a"), (3, "Fire Dist. of Zellermoor", "Wynh.", None), (4, "Zellermoor Village", "Wynholt", None), (5, "Zellermoor FD", None, None), (6, None, None, None)]
    left = spark.createDataFrame(bodies, "body_id string, name string, county string, website string").withColumn("host", F.lit("clash"))
    right = spark.createDataFrame(units, "unit_id int, unit_name string, area string, homepage string")
    rows = entity_match.match_bodies(left, right).collect()
    assert {(r.body_id, r.unit_id) for r in rows} == {("b1", 1), ("b2", 2), ("b3", 3)} and all(0 < r.confidence <= 1 for r in rows)
    assert entity_match.match_bodies(left.limit(0), right).count() == 0


def test_entities_with_swapped_letters(spark):
    """A swap of neighbours is one error: one in a short place, one on each side of a long one, and one more where host and area agree."""
    bodies = [("b1", "Port Pellcobegr Public Library", "Vostrand", "http://portpellcoberg-library.example"), ("b2", "Orlin Fire District", "Wynholt", None), ("b3", "Zellermoor Fire District", "Wynholt", "zellermoorfd.example"), ("b4", "Harstwick Fire District", "Wynholt", None)]
    units = [(1, "Pt. Plelcoberg Public Library", "County of Vostrand", "portpellcoberg-library.example"), (2, "Olrin Fire Dist.", "Wynholt", None), (3, "Zlelremoro Fire Dist.", "Wynholt", "www.zellermoorfd.example"), (4, "Hratswikc Fire Dist.", "Wynholt", None)]
    left = spark.createDataFrame(bodies, "body_id string, name string, county string, website string")
    right = spark.createDataFrame(units, "unit_id int, unit_name string, area string, homepage string")
    assert {(r.body_id, r.unit_id) for r in entity_match.match_bodies(left, right).collect()} == {("b1", 1), ("b2", 2), ("b3", 3)}


def test_unlisted_kinds_match_each_other(spark):
    left = spark.createDataFrame([("b1", "Nassau BOCES", "Nassau", None), ("b2", "City of Glen Cove", "Nassau", None), ("b3", "Plainview Sanitary District", None, None)], "body_id string, name string, county string, website string")
    right = spark.createDataFrame([(1, "BOCES of Nassau", "Nassau", None), (2, "Glen Cove City", "Nassau", None), (3, "Plainview Sanitary Dist.", "Nassau", None), (4, "Glen Cove Village", "Nassau", None)], "unit_id int, unit_name string, area string, homepage string")
    assert {(r.body_id, r.unit_id) for r in entity_match.match_bodies(left, right).collect()} == {("b1", 1), ("b2", 2), ("b3", 3)}


def typing_error(rng, word):
    i = rng.randrange(len(word) - 1)
    c = rng.choice("abcdefgh")
    return rng.choice([word[:i] + c + word[i:], word[:i] + word[i + 1 :], word[:i] + c + word[i + 1 :], word[:i] + word[i + 1] + word[i] + word[i + 2 :]])


def test_hamming_index_is_exact():
    """Places within the allowed errors share a key; a key is never made of zeros, and unlike places hardly ever share one."""
    rng = random.Random(3)
    letters = "abcdefghijklmnoprstuvwyz"
    places = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 14))) for _ in range(400)]
    counts = [0] * entity_match.BITS
    for p in places:
        for b in entity_match.set_bits(entity_match.gram_bits(p)):
            counts[b] += 1

    def keys(p):
        held = entity_match.set_bits(entity_match.gram_bits(p))
        return entity_match.errors_allowed(p, len(held)), set(entity_match.index_keys(p, held, counts))

    for p in places:
        for errors in (0, 1, 2):
            q = p
            for _ in range(errors):
                q = typing_error(rng, q) if len(q) > 2 else q
            (e, x), (f, y) = keys(p), keys(q)
            if entity_match.edit_count(p, q) <= min(e, f):
                assert x & y, (p, q)
    index = [keys(p)[1] for p in places]
    assert all(index) and sum(bool(index[i] & index[j]) for j in range(400) for i in range(j)) < 0.05 * 400 * 399 / 2


def test_confidence_is_calibrated(spark):
    """Of planted pairs the shares that match are close to the confidences, and one county apart nothing matches."""
    rng = random.Random(12)
    letters, left, right, same = "abcdefghiklmnoprstuvw", [], [], set()
    for i in range(400):
        place, county = "".join(rng.choice(letters) for _ in range(rng.randint(6, 11))).title(), rng.choice(["Ulm", "Wyn", "Cor", "Ost"])
        left.append((f"b{i}", f"{place} Fire District", county if rng.random() < 0.9 else None, f"{place.lower()}fd.example"))
        other = typing_error(rng, place.lower()).title() if rng.random() < 0.3 else place
        twin = rng.random() < 0.3  # a body of the same name in another county
        right.append((i, f"{other} Fire Dist.", ("Far" if twin else county) if rng.random() < 0.9 else None, None if rng.random() < 0.5 else f"{place.lower()}{'far' if twin else ''}fd.example"))
        if not twin:
            same.add((f"b{i}", i))
    got = entity_match.match_bodies(spark.createDataFrame(left, "body_id string, name string, county string, website string"), spark.createDataFrame(right, "unit_id int, unit_name string, area string, homepage string")).collect()
    right_ones = [(r.body_id, r.unit_id) in same for r in got]
    assert sum(right_ones) >= 0.95 * len(got) and sum(right_ones) >= 0.9 * len(same)
    assert abs(sum(r.confidence for r in got) - sum(right_ones)) < 0.08 * len(got)


CLASHING = "class_key n sketch next counter list side a b value kind found left right instance certain start end after spans out slice digest key tokens copies noise item_id distance line_no line docs slack word pieces h c chunk keys known part_of x y".split()


def awkward(spark, rows):
    """Rows (doc_id, text, body_id, source) with nulls, an empty text, a very long one and repeated rows, among columns with names operators use."""
    long = " ".join(f"w{i % 5000} alpha{i}" for i in range(60_000))
    rows = rows + [(None, None, None, None), (901, None, "b", "s"), (902, "", "b", "s"), (903, long, "b", "s"), (903, long, "b", "s"), (None, "text without an id", "b", None)]
    made = spark.createDataFrame(rows, "doc_id long, text string, body_id string, source string")
    return made.select("*", *(F.lit("clash").alias(c) for c in CLASHING))


def operators(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve"), (None, None), (2, "")], "item_id int, text string")
    targets = spark.createDataFrame([("s", 1.0, 2), (None, None, None), ("none", 0.5, 1)], "source string, target_share double, max_repeats int")
    return {
        "near duplicates": lambda d: near_duplicates.near_duplicate_pairs(d, 3, 0.7),
        "repeated lines": repeated_lines.recurring_lines,
        "lines removed": repeated_lines.without_recurring_lines,
        "leaks": lambda d: leaks.find_leaks(d, items),
        "mix": lambda d: mixing.mix_sources(d, targets, mixing.tokenizer())[0],
        "report": lambda d: mixing.mix_sources(d, targets, mixing.tokenizer())[1],
        "noise": scan_noise.read_pages,
        "personal information": personal_information.find_personal_information,
        "redacted": personal_information.redact,
    }


@pytest.mark.parametrize("name", ["near duplicates", "repeated lines", "lines removed", "leaks", "mix", "report", "noise", "personal information", "redacted"])
def test_awkward_and_empty_documents(spark, name):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text, "b", "s"), (2, text + " thirteen", None, "s"), (3, text, "b", None)]
    run = operators(spark)[name]
    got = [tuple(r) for r in run(awkward(spark, rows)).collect()]
    want = {
        "near duplicates": {(1, 2), (1, 3), (2, 3)}, "repeated lines": set(), "leaks": {(i, 1, 0, 12) for i in (1, 2, 3)}, "personal information": set(),
    }
    if name in want:
        assert set(got) == want[name]
    if name in ("lines removed", "redacted"):
        assert len(got) == 9 and (1, text) in got and (901, None) in got and (902, "") in got  # every row stays
    if name == "noise":
        assert sorted(r[0] for r in got) == [1, 2, 3, 902, 903, 903]
    if name == "mix":
        assert {r[0] for r in got} == {1, 2, 903} and len(got) == 3  # copies and rows without id, text or source are left out
    if name == "report":
        assert {r[0] for r in got} == {"s", "none"}
    empty = run(awkward(spark, rows).limit(0))
    assert empty.count() == (2 if name == "report" else 0)


def test_awkward_and_empty_records(spark):
    clash = [F.lit("clash").alias(c) for c in ("x", "y", "typed", "odds", "confidence", "holders", "own_host", "canon", "entity", "group_id", "id", "a", "b", "n")]
    signals = spark.createDataFrame([(None, None, None, None), (1, 7, "[]", ""), (2, 7, None, None), (3, 7, '["A. B."]', "X" * 5000), (3, 7, '["A. B."]', "X" * 5000)], "signal_id int, document_id int, vendors_named string, building string").select("*", *clash)
    documents = spark.createDataFrame([(7, "b1"), (None, None), (8, None)], "doc_id long, body_id string").select("*", *clash)
    assert name_variants.spelling_pairs(signals, documents).count() == 0 and name_variants.spelling_pairs(signals, documents.limit(0)).count() == 0
    matches = spark.createDataFrame([(None, None, None, None, None), (1, 1, 2, 0.9, None), (1, 1, 2, 0.9, None), (2, 3, 1, 0.5, "2024-01-01")], "match_id int, left_id int, right_id int, score double, matched_at string").select("*", *clash)
    assert {tuple(r) for r in components.group_records(matches, signals).collect()} == {(1, 1), (2, 1), (3, 1)}
    assert components.group_records(matches, signals.limit(0)).count() == 0
    bodies = spark.createDataFrame([(None, None, None, None), ("b", "", "", ""), ("c", "X" * 3000 + " Fire District", None, None), ("d", "Elm Fire District", None, "h.example"), ("d", "Elm Fire District", None, "h.example")], "body_id string, name string, county string, website string").select("*", *clash)
    units = spark.createDataFrame([(None, None, None, None), (1, "", None, ""), (2, "Elm FD", None, None), (2, "Elm FD", None, None)], "unit_id int, unit_name string, area string, homepage string").select("*", *clash)
    assert {(r.body_id, r.unit_id) for r in entity_match.match_bodies(bodies, units).collect()} == {("d", 2)}
    assert entity_match.match_bodies(bodies, units.limit(0)).count() == 0
