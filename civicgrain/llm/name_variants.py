"""Problem 4: spellings of one vendor, or of one building of a body.

A spelling is read into proper names and the words that say what it is (trade and legal
form, kind of building), abbreviations resolved. A symmetric-delete index over all proper
names finds those one typing error apart; the rarer one of two is a variant of the commoner.
Spellings that share a name and a kind are candidates. Their tokens are aligned by an
optimal assignment that permits initials, nicknames, abbreviations and typing errors. However often they
stand, spellings one typing error apart in one name are linked if all else in them agrees, and
so are those in which one name is an abbreviation of the other and another name is the same.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicgrain.llm.components import connected_components
from civicgrain.llm.storage import saved

# Trades and kinds of buildings with their abbreviations.
TRADES = {
    "plumbing": ("plumb", "plbg", "plmbg"), "roofing": ("roofg", "rfg", "roof"), "electrical": ("electric", "electr", "elec", "el"), "construction": ("constr", "const", "constn"),
    "engineers": ("engineering", "engrs", "engr", "eng", "engs"), "architects": ("architect", "architecture", "archs", "arch"), "environmental": ("environ", "env", "envir"),
    "mechanical": ("mech",), "masonry": ("mason", "mas"), "paving": ("pav", "pvg"), "consultants": ("consulting", "consult", "cons", "cnslt"), "glazing": ("glazg", "glz", "glass"), "contracting": ("contractors", "contr"),
}
LEGAL = frozenset("inc incorporated llc corp corporation co company ltd limited pc llp lp pllc".split())
CREDENTIALS = frozenset("pe aia ra phd esq cpa jr sr".split())
BUILDINGS = (
    ("high school", ("high school", "high sch", "hs", "high")), ("middle school", ("middle school", "middle sch", "mid school", "mid sch", "ms", "middle", "mid")), ("elementary school", ("elementary school", "elementary", "elem school", "elem sch", "elem", "es")),
    ("firehouse", ("firehouse", "fire house", "fire hse", "fire station")), ("town hall", ("town hall", "twn hall", "t hall", "town hl")), ("bus garage", ("bus garage", "bus gar", "garage bus", "bus gge")),
    ("administration building", ("administration building", "admin bldg", "administration bldg", "admin building", "adm bldg", "admin")), ("library", ("library", "libr", "lib")),
    ("village hall", ("village hall", "vlg hall", "v hall")), ("gymnasium", ("gymnasium", "gym")), ("pool", ("pool",)), ("stadium", ("stadium",)), ("auditorium", ("auditorium", "aud")), ("school", ("school", "sch")),
)
# Given names and their short forms.
NICKNAMES = {
    "william": "bill will billy liam", "robert": "bob rob bobby bert", "richard": "dick rick rich", "james": "jim jimmy jamie", "john": "jack johnny", "charles": "charlie chuck", "thomas": "tom tommy", "michael": "mike mick",
    "joseph": "joe joey", "edward": "ed eddie ted ned", "anthony": "tony", "christopher": "chris kit", "daniel": "dan danny", "matthew": "matt", "steven": "steve", "stephen": "steve", "andrew": "andy drew", "kenneth": "ken", "gregory": "greg",
    "ronald": "ron", "timothy": "tim", "nicholas": "nick", "benjamin": "ben", "samuel": "sam", "frederick": "fred freddy", "lawrence": "larry", "gerald": "jerry gerry", "harold": "harry hal", "walter": "walt wally", "oliver": "ollie", "philip": "phil pip", "zachary": "zach zack",
    "elizabeth": "liz beth betty eliza", "margaret": "peggy maggie meg", "katherine": "kate kathy katie kay", "jennifer": "jen jenny", "susan": "sue susie", "deborah": "deb debbie", "victoria": "vicky vicki tori", "patricia": "pat patty trish", "rebecca": "becky",
    "barbara": "barb", "dorothy": "dot dottie", "theodore": "ted theo", "yolanda": "yoli", "ignacio": "nacho", "francisco": "paco pancho", "jose": "pepe", "alexander": "alex", "alexandra": "alex sandra", "abigail": "abby", "quentin": "quent", "uriah": "uri",
}
_SHORT = {s: full for full, short in NICKNAMES.items() for s in short.split()}
_TRADE_OF = {form: t for t, forms in TRADES.items() for form in (t, *forms)}
# hashes of a name and of what is left without each of its letters, equal ones once; pairs that meet are compared letter by letter
_DELETES = "array_distinct(concat(array(xxhash64(token)), transform(sequence(1, length(token)), i -> xxhash64(concat(substring(token, 1, i - 1), substring(token, i + 1))))))"
_SWAP = "length(a.token) = length(b.token) and levenshtein(a.token, b.token) = 2 and array_sort(split(a.token, '')) = array_sort(split(b.token, ''))"
_NEAR = f"(levenshtein(a.token, b.token) <= 1 or ({_SWAP}))"
# a name cut short keeps its beginning, or its first and last letter with some of those between
_ABBREVIATED = "length(s.token) > 1 and length(l.token) >= length(s.token) + 2 and (length(s.token) > 2 and startswith(l.token, s.token) or right(s.token, 1) = right(l.token, 1) and l.token rlike concat('^', array_join(split(s.token, ''), '.*'), '$'))"
_ROLES = frozenset("role type kind status note notes".split())


def names_in(text: str) -> list[str]:
    """The vendor names of a JSON text, whatever its shape."""
    try:
        value = json.loads(text)
    except (ValueError, RecursionError):
        return []
    out: list[str] = []

    def walk(v) -> None:
        if isinstance(v, str):
            out.append(v)
        elif isinstance(v, list):
            for x in v:
                walk(x)
        elif isinstance(v, dict):
            for k, x in v.items():
                if k.lower() not in _ROLES:
                    walk(x)

    walk(value)
    return [x for x in out if x.strip()]


def _tokens(spelling: str) -> list[str]:
    low = spelling.lower().replace("’", "'")
    low = re.sub(r"\b((?:[^\W\d_]\.){2,}[^\W\d_]?)\.?", lambda m: m[1].replace(".", "") + " ", low)
    return re.findall(r"[^\W_]+(?:'[^\W_]+)?", low.replace("&", " "))


def _close(a: str, b: str) -> bool:
    """At most one insertion, deletion, replacement or swap of neighbours apart."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    x, y = a[k:], b[k:]
    return x[1:] == y or x == y[1:] or x[1:] == y[1:] or (len(x) > 1 and len(y) > 1 and x[0] == y[1] and x[1] == y[0] and x[2:] == y[2:])


def _trade(token: str) -> str:
    """The trade a word names: written out, a known short form, a typing error, or letters left out of it."""
    if token in _TRADE_OF:
        return _TRADE_OF[token]
    if len(token) > 5:
        for t in TRADES:
            if _close(token, t):
                return t
    if len(token) > 2:
        for t in TRADES:
            rest = iter(t)
            if token[0] == t[0] and all(c in rest for c in token):
                return t
    return ""


def read_vendor(spelling: str) -> tuple[str, str, list[str]]:
    """(class, trade, proper tokens); class is firm or person. A person's surname stands first."""
    tokens = [t for t in _tokens(spelling) if t not in ("the", "and", "of")]
    trade, proper, legal = "", [], False
    for t in tokens:
        if t in LEGAL:
            legal = True
        elif not trade and (found := _trade(t.replace("'", ""))):
            trade = found
        else:
            proper.append(t)
    if trade or legal:
        return "firm", trade, sorted(proper)
    proper = [t for t in proper if t not in CREDENTIALS]
    first = spelling.split(",")[0]
    head = [t for t in _tokens(first) if t in proper]
    # "Surname, Given" has one word before the comma; otherwise the surname stands last
    turned = "," in spelling and len(head) == 1 and len(proper) > 1
    if len(proper) < 2:
        return "person", "", proper
    surname, rest = (proper[0], proper[1:]) if turned else (proper[-1], proper[:-1])
    return "person", "", [surname, *rest]


def read_building(spelling: str) -> tuple[str, str, list[str]]:
    tokens = [t for t in _tokens(spelling) if t not in ("the", "of", "and")]
    best = None
    for kind, forms in BUILDINGS:
        for form in forms:
            words = form.split()
            n = len(words)
            for i in range(len(tokens) - n + 1):
                got = tokens[i : i + n]
                if all(x == y or (len(y) > 4 and _close(x, y)) for x, y in zip(got, words)) and len(tokens) > n:
                    score = (sum(map(len, words)), sum(x == y for x, y in zip(got, words)))
                    if best is None or score > best[0]:
                        best = (score, kind, tokens[:i] + tokens[i + n :])
    if best is None:
        return "building", "", tokens
    rest = best[2]
    return "building", best[1], [rest[-1], *rest[:-1]] if len(rest) > 1 else rest


def abbreviates(short: str, long: str) -> bool:
    """Whether a name is the other one cut short: its beginning, or its first and last letter with some of those between."""
    if len(short) < 2 or len(long) < len(short) + 2:
        return False
    rest = iter(long)
    return (len(short) > 2 and long.startswith(short)) or (short[0] == long[0] and short[-1] == long[-1] and all(c in rest for c in short))


def _cost(a: str, b: str, known: dict[str, str]) -> float | None:
    a, b = known.get(a, a), known.get(b, b)
    if a == b:
        return 0.0
    if len(a) == 1 or len(b) == 1:
        return 0.3 if a[0] == b[0] or _SHORT.get(a, a)[0] == _SHORT.get(b, b)[0] else None
    x, y = _SHORT.get(a, a), _SHORT.get(b, b)
    if x == y or b in NICKNAMES.get(a, "").split() or a in NICKNAMES.get(b, "").split():
        return 0.1
    if len(a) > 3 and _close(a, b):
        return 0.4
    return 0.2 if abbreviates(a, b) or abbreviates(b, a) else None


def assign(a: list[str], b: list[str], known: dict[str, str], person: bool) -> float | None:
    """The least cost of pairing all tokens of the shorter list with tokens of the other one.

    Tokens left over must be middle initials of persons. None if no assignment is allowed.
    """
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return None
    never = 1000.0
    left_over = [0.0 if person and len(t) == 1 else never for t in b]
    costs = [[never if (c := _cost(x, y, known)) is None else c for y in b] for x in a] + [left_over] * (len(b) - len(a))
    total = least_assignment(costs)
    return total if total < never else None


def least_assignment(costs: list[list[float]]) -> float:
    """The least total of a square matrix with one place a row and column, by shortest augmenting paths."""
    n = len(costs)
    rows, columns, owner = [0.0] * (n + 1), [0.0] * (n + 1), [n] * (n + 1)
    for i in range(n):
        owner[n], at = i, n
        slack, seen, came = [float("inf")] * n, [False] * (n + 1), [n] * n
        while True:
            seen[at] = True
            row, step, to = owner[at], float("inf"), n
            for j in range(n):
                if not seen[j]:
                    value = costs[row][j] - rows[row] - columns[j]
                    if value < slack[j]:
                        slack[j], came[j] = value, at
                    if slack[j] < step:
                        step, to = slack[j], j
            for j in range(n + 1):
                if seen[j]:
                    rows[owner[j]] += step
                    columns[j] -= step
                elif j < n:
                    slack[j] -= step
            at = to
            if owner[at] == n:
                break
        while at != n:  # turn the path round
            owner[at] = owner[came[at]]
            at = came[at]
    return sum(costs[owner[j]][j] for j in range(n))


def _spellings(signals: DataFrame, documents: DataFrame) -> DataFrame:
    """(field, body_id, spelling, n) as written, n counting rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(x, n) for text, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for x in names_in(text)]
            columns = list(zip(*rows)) if rows else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64())], names=["spelling", "n"])

    texts = signals.where("vendors_named is not null").groupBy("vendors_named").agg(F.count("*").alias("n"))
    vendors = texts.mapInArrow(run, "spelling string, n long").groupBy("spelling").agg(F.sum("n").alias("n")).select(F.lit("vendor").alias("field"), F.lit("").alias("body_id"), "spelling", "n")
    # counted before the join: a building with a tenth of all rows is one row a document
    held = signals.where("building is not null and trim(building) <> ''").groupBy(F.col("document_id").cast("long").alias("doc_id"), "building").agg(F.count("*").alias("n"))
    owner = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "body_id").where("body_id is not null")
    buildings = held.join(owner, "doc_id").groupBy("body_id", F.col("building").alias("spelling")).agg(F.sum("n").alias("n"))
    return vendors.unionByName(buildings.select(F.lit("building").alias("field"), "body_id", "spelling", "n"))


def _token_variants(read: DataFrame) -> DataFrame:
    """(token, canon): each proper name and the commoner one it is a typing error of, itself if there is none."""
    counts = saved(read.select(F.explode("tokens").alias("token"), "n").groupBy("token").agg(F.sum("n").alias("n")))
    index = counts.where("length(token) > 3").select("token", "n", F.explode(F.expr(_DELETES)).alias("key")).distinct()
    near = index.alias("a").join(index.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.token") != F.col("b.token")))
    near = near.where(f"{_NEAR} and b.n > a.n and (b.n >= 3 * a.n or a.n <= 3)")
    best = near.groupBy(F.col("a.token").alias("token")).agg(F.max_by("b.token", F.struct("b.n", "b.token")).alias("canon"))
    once = saved(counts.select("token").join(best, "token", "left").select("token", F.coalesce("canon", "token").alias("canon")))
    return once.join(once.select(F.col("token").alias("canon"), F.col("canon").alias("next")), "canon").select("token", F.col("next").alias("canon"))


def _misspelt(whole: DataFrame, linked: DataFrame) -> DataFrame:
    """(field, body_id, entity, lead) of entities linked to others by spellings that agree in all
    but one name, and there but for one typing error. The lead is the entity of most rows."""
    known = F.create_map(*[F.lit(x) for pair in _SHORT.items() for x in pair])
    full = lambda c: F.coalesce(F.try_element_at(known, c), c)
    person = F.col("class") == "person"
    others = F.filter("t", lambda x: x.place != F.col("own.place"))
    names = F.array_join(F.array_sort(F.transform(F.filter(others, lambda x: ~person | (F.length(x.canon) > 1)), lambda x: full(x.canon))), " ")
    # middle initials of persons don't matter; an initial instead of a given name does
    rest = F.when((names == "") & (F.size(others) > 0), F.concat(F.lit("."), F.get(others, F.lit(0)).canon)).otherwise(names)
    group = ["field", "body_id", "class", "kind", "rest"]
    each = whole.join(linked, ["field", "body_id", "spelling"]).withColumn("own", F.explode("t")).withColumn("rest", rest).withColumn("token", F.col("own.token"))
    index = each.where("length(token) > 3 and token rlike '^[^0-9]+$'").select(*group, "token", "entity").distinct().withColumn("key", F.explode(F.expr(_DELETES)))
    same = lambda l, r, *more: [F.col(f"{l}.{c}") == F.col(f"{r}.{c}") for c in (*group, *more)]
    near = index.alias("a").join(index.alias("b"), [*same("a", "b", "key"), F.col("a.token") < F.col("b.token"), F.col("a.entity") != F.col("b.entity")]).where(_NEAR)
    # only few spellings have a name, kind and first letter in common
    cut = each.where("rest <> '' and rest not like '.%' and length(token) > 1 and token rlike '^[^0-9]+$'").select(*group, "token", "entity", F.substring("token", 1, 1).alias("letter")).distinct()
    short = cut.alias("s").join(cut.alias("l"), [*same("s", "l", "letter"), F.col("s.entity") != F.col("l.entity")]).where(_ABBREVIATED)
    links = near.select("a.field", "a.body_id", F.col("a.entity").alias("x"), F.col("b.entity").alias("y")).union(short.select("s.field", "s.body_id", "s.entity", "l.entity"))
    links = saved(links.distinct())
    held = whole.join(linked, ["field", "body_id", "spelling"]).groupBy("field", "body_id", "entity").agg(F.sum("n").alias("n"))
    ends = links.select("field", "body_id", F.col("x").alias("entity")).union(links.select("field", "body_id", "y")).distinct()
    ids = saved(held.join(ends, ["field", "body_id", "entity"]).withColumn("id", F.monotonically_increasing_id()))
    of = lambda c: ids.select("field", "body_id", F.col("entity").alias(c), F.col("id").alias(f"{c}_id"))
    numbered = links.join(of("x"), ["field", "body_id", "x"]).join(of("y"), ["field", "body_id", "y"]).select(F.col("x_id").alias("x"), F.col("y_id").alias("y"))
    grouped = ids.join(connected_components(numbered), "id")
    return grouped.withColumn("lead", F.max_by("entity", F.struct("n", "entity")).over(Window.partitionBy("group_id"))).select("field", "body_id", "entity", "lead")


def link_spellings(signals: DataFrame, documents: DataFrame) -> DataFrame:
    """(field, body_id, spelling, entity) of every spelling; equal entities are one vendor or building.

    Firms need the same proper names and trade, whatever the legal form; persons the same
    surname and given names that fit each other. A given name shortened to an initial joins
    the one full name it fits and stays alone if several fit. Buildings are compared within
    their body and need the same kind. One typing error in one name is allowed whatever the
    counts of both spellings, which only choose the lead. Null, empty and undecodable values have no spelling.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = [read_vendor(x) if f == "vendor" else read_building(x) for f, x in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            columns = list(zip(*read)) if read else [[], [], []]
            extra = [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), *extra], names=["field", "body_id", "spelling", "n", "class", "kind", "tokens"])

    read = saved(_spellings(signals, documents).mapInArrow(run, "field string, body_id string, spelling string, n long, class string, kind string, tokens array<string>"))
    variants = _token_variants(read)
    each = read.select("field", "body_id", "spelling", "n", "class", "kind", F.posexplode("tokens").alias("place", "token")).join(variants, "token")
    whole = each.groupBy("field", "body_id", "spelling", "n", "class", "kind").agg(F.array_sort(F.collect_list(F.struct("place", "token", "canon"))).alias("t")).withColumn("canon", F.col("t.canon"))
    known = F.create_map(*[F.lit(x) for pair in _SHORT.items() for x in pair])
    full = lambda c: F.coalesce(F.try_element_at(known, c), c)
    firm = F.col("class") == "firm"
    after = F.slice("canon", F.lit(2), F.greatest(F.size("canon") - 1, F.lit(0)))
    given = F.filter(after, lambda t: F.length(t) > 1)
    initials = F.filter(after, lambda t: F.length(t) == 1)
    base = whole.withColumn("surname", F.when(firm, F.array_join(F.array_sort("canon"), " ")).otherwise(F.get("canon", F.lit(0))))
    base = base.withColumn("given", F.when(firm, F.lit("")).otherwise(F.array_join(F.transform(given, full), " "))).withColumn("initial", F.when(firm | (F.size(given) > 0), F.lit(None)).otherwise(F.get(initials, F.lit(0))))
    group = ["field", "body_id", "class", "kind", "surname"]
    base = saved(base)
    named = base.where("initial is null").select(*group, "given").distinct().withColumn("first", F.substring("given", 1, 1))
    of_initial = named.where("given <> ''").groupBy(*group, "first").agg(F.count("*").alias("fits"), F.min("given").alias("only"))
    resolved = base.join(of_initial.withColumnRenamed("first", "initial"), [*group, "initial"], "left").withColumn("given", F.when(F.col("initial").isNull(), F.col("given")).when(F.col("fits") == 1, F.col("only")).otherwise(F.concat(F.lit("."), "initial")))
    entity = Window.partitionBy(*group, "given")
    lead = resolved.withColumn("lead", F.max_by(F.col("canon"), F.struct(F.col("initial").isNull(), "n", "spelling")).over(entity)).withColumn("entity", F.max_by("spelling", F.struct(F.col("initial").isNull(), "n", "spelling")).over(entity))

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [assign(a, b, {}, c != "firm") is not None for a, b, c in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist())]
            out = batch.select(["field", "body_id", "spelling"])
            entity = [e if ok else s for e, s, ok in zip(batch.column(6).to_pylist(), batch.column(2).to_pylist(), keep)]
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(entity, pa.string())], names=["field", "body_id", "spelling", "entity"])

    linked = saved(lead.select("field", "body_id", "spelling", "canon", "lead", "class", "entity").mapInArrow(aligned, "field string, body_id string, spelling string, entity string"))
    other = saved(_misspelt(base.select("field", "body_id", "spelling", "n", "class", "kind", "t"), linked))
    return linked.join(other, ["field", "body_id", "entity"], "left").select("field", "body_id", "spelling", F.coalesce("lead", "entity").alias("entity"))


def spelling_pairs(signals: DataFrame, documents: DataFrame) -> DataFrame:
    """(field, body_id, spelling_a, spelling_b), spelling_a < spelling_b, of one entity."""
    linked = saved(link_spellings(signals, documents))
    a, b = linked.alias("a"), linked.alias("b")
    same = (F.col("a.field") == F.col("b.field")) & (F.col("a.body_id") == F.col("b.body_id")) & (F.col("a.entity") == F.col("b.entity")) & (F.col("a.spelling") < F.col("b.spelling"))
    return a.join(b, same).select("a.field", "a.body_id", F.col("a.spelling").alias("spelling_a"), F.col("b.spelling").alias("spelling_b"))
