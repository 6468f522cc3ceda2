"""Problem 6: bodies and units of an outside register that are the same, without a common key.

Names are read into a place, a leading qualifier (north, upper, lake) and a kind of body.
The place's 2-grams are encoded as a fixed vector of ``BITS`` bits. Places a few typing
errors apart are found exactly by multi-index Hamming hashing: an error takes at most three
set bits from a vector, so of the ``3 * errors + 2`` rarest bits of either vector two at
least stand in the other, and every two of them are a key of the index. A piece of zeros is
never a key. Rows of one exclusive host and one area are candidates too.

Dice scores become confidences field by field, each weighed on labels that are no part of
what it scores. A logistic curve over place Dice, typing errors and the number of rival
candidates is fitted on pairs whose known areas agree or differ. The weight of an equal area
comes from pairs that share an exclusive host, that of equal, similar (by Dice) and other hosts from pairs
whose areas agree or differ. Candidates for one unit, and units of different areas for one
body, exclude each other, so their odds are shared out. A confidence of a half and more is a match.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from civicgrain.llm.storage import saved

BITS, SAMPLE = 512, 20_000
_KEY_BITS = 2
SHARED_HOST = 3  # a host of more bodies or units than this belongs to a platform
# How kinds of bodies are written, blanks left out.
KINDS = (
    ("ufsd", ("unionfreeschooldistrict", "unionfreeschooldist", "unionfreeschools", "unionfreeschool", "ufsd", "ufschooldistrict")),
    ("csd", ("centralschooldistrict", "centralschooldist", "centschdist", "centralschools", "centralschool", "csd", "centralsd")),
    ("charter", ("academycharterschool", "academychartersch", "charterschool", "charteracademy", "acadcs", "academycs", "charter")),
    ("fire", ("firedistrict", "firedist", "firedepartment", "fd")),
    ("water", ("waterauthority", "waterauth", "wtrauth", "waterdistrict", "wa")),
    ("library", ("publiclibrary", "publib", "library", "lib", "pl")),
    ("village", ("incvillageof", "incorporatedvillageof", "villageof", "vlgof", "village", "vlg")),
    ("town", ("townshipof", "townof", "township", "town", "twp")),
)
# Leading qualifiers of place names and how they are cut short.
QUALIFIERS = {
    "north": "north", "n": "north", "no": "north", "nth": "north", "south": "south", "s": "south", "so": "south", "east": "east", "e": "east", "west": "west", "w": "west",
    "upper": "upper", "up": "upper", "upr": "upper", "lower": "lower", "lwr": "lower", "lake": "lake", "lk": "lake", "port": "port", "pt": "port", "mount": "mount", "mt": "mount", "new": "new", "old": "old", "great": "great", "little": "little",
}
_SPELLED = sorted({q for q in QUALIFIERS.values()})


def edit_count(a: str, b: str) -> int:
    """Typing errors between two places, a swap of neighbours being one; 4 stands for more than 3."""
    return next((n for n in range(4) if _edits(a, b, n)), 4)


def _edits(a: str, b: str, most: int) -> bool:
    """Whether at most ``most`` insertions, deletions, replacements or swaps of neighbours lead from a to b."""
    if abs(len(a) - len(b)) > most:
        return False
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            cost = min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            new.append(cost)
        before, row = row, new
        if min(row) > most:
            return False
    return row[-1] <= most


def read_name(name: str) -> tuple[str, str, str]:
    """(kind, qualifier, place) of a body's name. An unlisted kind is a kind of its own, the empty one, and its words stay in the place."""
    text = re.sub(r"\b(?:no\.?|#)\s*\d+|#\s*\d+|\d+", " ", name.lower())
    text = re.sub(r"\b(?:[a-z]\.){2,}[a-z]?\b\.?|\b[a-z](?: [a-z]){2,}\b", lambda m: re.sub(r"[. ]", "", m[0]) + " ", text)
    text = re.sub(r"[^a-zà-ÿ]+", " ", text.replace("(", " ").replace(")", " "))
    tokens = [t for t in text.split() if t not in ("the", "inc", "incorporated")]
    kind, tokens = _take_kind(tokens)
    tokens = [t for t in tokens if t not in ("of", "dist", "district")]
    qualifier = ""
    if len(tokens) > 1:
        qualifier = QUALIFIERS.get(tokens[0], "") or next((q for q in _SPELLED if len(q) > 3 and _edits(tokens[0], q, 1)), "")
        if qualifier:
            tokens = tokens[1:]
    return kind, qualifier, "".join(tokens if kind else sorted(tokens))


def _take_kind(tokens: list[str]) -> tuple[str, list[str]]:
    n = len(tokens)
    spans = [(i, j, "".join(tokens[i:j])) for i in range(n) for j in range(n, i, -1) if not (i == 0 and j == n)]
    exact = [(len(form), kind, i, j) for kind, forms in KINDS for form in forms for i, j, s in spans if s == form]
    # "village of X" and "X (village)" both leave the place; the longest form is the kind
    near = exact or [(len(form), kind, i, j) for kind, forms in KINDS for form in forms if len(form) > 4 for i, j, s in spans if _edits(s, form, 1 if len(form) < 10 else 2)]
    if not near:  # a short form with one letter wrong
        near = [(len(form), kind, i, j) for kind, forms in KINDS for form in forms if len(form) == 4 for i, j, s in spans if j == i + 1 and s[0] == form[0] and 2 < len(s) < 6 and _edits(s, form, 1)]
    if near:
        _, kind, i, j = max(near, key=lambda x: x[0])
        return kind, tokens[:i] + tokens[j:]
    # blanks gone astray: look within the name written together
    whole = "".join(tokens)
    best = max(((len(form), kind, whole.replace(form, "")) for kind, forms in KINDS for form in forms if len(form) > 3 and (whole.endswith(form) or whole.startswith(form))), default=None)
    if best is None:
        return "", tokens
    rest = best[2]
    q = next((q for q in _SPELLED if rest.startswith(q) and len(rest) > len(q) + 3), None)
    return best[1], [q, rest[len(q) :]] if q else [rest]


def gram_bits(text: str) -> list[int]:
    """Signed 64-bit words, ``BITS`` in all, with a bit set for each 2-gram of the padded text."""
    import xxhash

    words = [0] * (BITS // 64)
    padded = f"^{text}$"
    for a in range(len(padded) - 1):
        k = xxhash.xxh64_intdigest(padded[a : a + 2]) % BITS
        words[k // 64] |= 1 << (k % 64)
    return [w - (1 << 64) if w >> 63 else w for w in words]


def read_area(area: str | None) -> str:
    low = re.sub(r"[^a-z. -]", "", (area or "").lower())
    low = re.sub(r"\bcounty\b|\bco\.?$|\bco\b\.?|\bof\b", " ", low)
    return re.sub(r"[ -]+", "", low).strip()


def read_host(site: str | None) -> str:
    low = re.sub(r"^[a-z]+://", "", (site or "").lower().strip())
    host = re.split(r"[/?#:]", low)[0]
    if "." not in host:
        return ""
    host = re.sub(r"^(?:www\d?|portal|web|sites?)\.", "", host) if not host.startswith("sites.") else host
    return re.sub(r"[^a-z0-9]", "", host.rsplit(".", 1)[0])


def _read(frame: DataFrame, key: str, name: str, area: str, site: str) -> DataFrame:
    schema = "id string, kind string, qualifier string, place string, bits array<long>, area string, host string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, n, a, s in zip(*(batch.column(c).to_pylist() for c in range(4))):
                kind, qualifier, place = read_name(n)
                rows.append((i, kind, qualifier, place, gram_bits(place), read_area(a), read_host(s)))
            columns = list(zip(*rows)) if rows else [[]] * 7
            types = (pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["id", "kind", "qualifier", "place", "bits", "area", "host"])

    rows = frame.select(F.col(key).cast("string"), name, area, site).where(F.col(key).isNotNull() & F.col(name).isNotNull()).distinct()
    read = rows.mapInArrow(run, schema)
    shared = read.where("host <> ''").groupBy("host").agg(F.countDistinct("id").alias("holders"))
    return saved(read.join(shared, "host", "left").withColumn("own_host", (F.col("host") != "") & (F.col("holders") <= SHARED_HOST)).drop("holders"))


def set_bits(words: list[int]) -> list[int]:
    return [64 * k + b for k, w in enumerate(words) for b in range(64) if w >> b & 1]


def errors_allowed(place: str, bits: int) -> int:
    """Typing errors forgiven in a place: two in more than seven letters, none in less than four, and no more than its set bits can index."""
    return min(2 if len(place) > 7 else 1 if len(place) > 3 else 0, max(0, (bits - _KEY_BITS) // 3))


def index_keys(place: str, held: list[int], rank: list[int]) -> list[int]:
    """Every two of the rarest set bits, as one number."""
    first = sorted(held, key=lambda b: (rank[b], b))[: 3 * errors_allowed(place, len(held)) + _KEY_BITS]
    return [x * BITS + y for x, y in combinations(sorted(first), _KEY_BITS)] or [x * BITS + x for x in first]


def _index(rows: DataFrame, rank: list[int], side: str) -> DataFrame:
    """(id, kind, qualifier, key) of the rows' places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [index_keys(p, set_bits(w), rank) for p, w in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(keys, pa.list_(pa.int64()))], names=["id", "kind", "qualifier", "keys"])

    keyed = rows.where("place <> ''").select("id", "kind", "qualifier", "place", "bits").mapInArrow(run, "id string, kind string, qualifier string, keys array<long>")
    return keyed.select(F.col("id").alias(f"{side}_id"), "kind", "qualifier", F.explode("keys").alias("key"))


def _rarity(places: DataFrame) -> list[int]:
    """How many places have each bit: ``BITS`` numbers, whatever the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BITS, np.int64)
        for batch in batches:
            for words in batch.column(0).to_pylist():
                counts[set_bits(words)] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS, dtype=np.int32)), pa.array(counts)], names=["bit", "n"])

    got = places.select("bits").mapInArrow(run, "bit int, n long").groupBy("bit").agg(F.sum("n").alias("n")).collect()
    held = {r["bit"]: r["n"] for r in got}
    return [held.get(b, 0) for b in range(BITS)]


def _sum(expr) -> Column:
    return sum((expr(F.get("x_bits", F.lit(k)), F.get("y_bits", F.lit(k))) for k in range(BITS // 64)), F.lit(0))


def _area_score() -> Column:
    """1 the same or cut short, 0 different, null unknown."""
    x, y = F.regexp_replace("x_area", r"\.", ""), F.regexp_replace("y_area", r"\.", "")
    cut = F.col("x_area").endswith(".") & y.startswith(x) | F.col("y_area").endswith(".") & x.startswith(y)
    return F.when((x == "") | (y == ""), F.lit(None).cast("double")).when((x == y) | cut, 1.0).when((F.levenshtein(x, y) <= 2) & (F.length(x) > 4), 0.9).otherwise(0.0)


def dice(a: str, b: str) -> float:
    """Dice score of the sets of 2-grams."""
    x, y = ({t[k : k + 2] for k in range(len(t) - 1)} for t in (a, b))
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else float(a == b)


def _with_edits(rows: DataFrame) -> DataFrame:
    """The rows with ``typed``, the typing errors between ``x_place`` and ``y_place``, and ``host_dice`` of exclusive hosts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, g, h, own = (batch.column(batch.schema.names.index(c)).to_pylist() for c in ("x_place", "y_place", "x_host", "y_host", "exclusive"))
            typed = pa.array([edit_count(a, b) for a, b in zip(x, y)], pa.int32())
            score = pa.array([dice(a, b) if o else None for a, b, o in zip(g, h, own)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, typed, score], names=[*batch.schema.names, "typed", "host_dice"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("typed", IntegerType()), StructField("host_dice", DoubleType())]))


def candidate_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(x_id, y_id) of rows of one kind and qualifier that share a key, or an exclusive host and an area."""
    rank = _rarity(left.select("bits").union(right.select("bits")))
    near = _index(left, rank, "x").join(_index(right, rank, "y"), ["kind", "qualifier", "key"]).select("x_id", "y_id")
    # a host is exclusive to few rows, so this join is small
    hosted = lambda d, p: d.where("own_host and area <> '' and place <> ''").select(F.col("id").alias(f"{p}_id"), "kind", "qualifier", "host", F.regexp_replace("area", r"\.", "").alias("area"))
    return near.union(hosted(left, "x").join(hosted(right, "y"), ["kind", "qualifier", "host", "area"]).select("x_id", "y_id")).distinct()


def match_bodies(bodies: DataFrame, units: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(body_id, unit_id, confidence) of matching rows; a body may have several.

    Place, qualifier and kind must agree (the place within ``errors_allowed`` of the shorter
    one, one more if the area and an exclusive host of
    both agree; a swap of neighbours is one error), and known areas mustn't differ: bodies of another kind or area
    are different. Of the pairs left those with a confidence of at least a half are kept.
    Rows with a null id or name match nothing; nulls elsewhere are unknown values; a row
    entered twice matches twice. The curves are fitted on at most ``sample`` candidate pairs.
    """
    left = _read(bodies, "body_id", "name", "county", "website")
    right = _read(units, "unit_id", "unit_name", "area", "homepage")
    side = lambda d, p: d.select(*(F.col(c).alias(f"{p}_{c}") for c in d.columns))
    rows = candidate_pairs(left, right).join(side(left, "x"), "x_id").join(side(right, "y"), "y_id")
    both, one = _sum(lambda a, b: F.bit_count(a.bitwiseAND(b))), _sum(lambda a, b: F.bit_count(a) + F.bit_count(b))
    rows = rows.withColumn("place_score", 2 * both / one).withColumn("area_score", _area_score())
    rows = _with_edits(rows.withColumn("exclusive", F.col("x_own_host") & F.col("y_own_host")))
    agreed = (F.coalesce("host_dice", F.lit(0.0)) == 1) & (F.coalesce("area_score", F.lit(0.0)) == 1)
    allowed = F.least(*(F.when(F.length(c) > 7, 2).when(F.length(c) > 3, 1).otherwise(0) for c in ("x_place", "y_place"))) + agreed.cast("int")
    rows = rows.where(F.col("typed") <= allowed).withColumn("x_rivals", F.count("*").over(Window.partitionBy("y_id"))).withColumn("y_rivals", F.count("*").over(Window.partitionBy("x_id")))
    rows = saved(rows.select("x_id", "y_id", "x_area", "y_area", "place_score", "area_score", "host_dice", "typed", "x_rivals", "y_rivals"))
    areas = right.where("area <> ''").groupBy("area").agg(F.count("*").alias("n"))
    at_large = areas.agg(F.try_divide(F.sum(F.col("n") * F.col("n")).cast("double"), F.sum("n") * F.sum("n")).alias("p")).first()["p"]  # one number
    model = fit_confidence(rows, sample, at_large)
    z = sum((F.lit(w) * c for w, c in zip(model.place, _features())), F.lit(0.0)) + F.when(F.col("area_score") > 0, model.area).otherwise(0.0)
    z = z + F.coalesce(F.get(F.array(*map(F.lit, model.host)), _host_bin()), F.lit(0.0))
    odds = F.exp(F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0)))
    good = rows.where(F.coalesce("area_score", F.lit(1.0)) > 0).withColumn("odds", odds).withColumn("where", F.when(F.col("y_area") != "", F.substring("y_area", 1, 4)))
    # one unit is one body; a body of unknown area isn't in the areas of different units at once
    total = lambda c, *by: F.coalesce(F.sum(c).over(Window.partitionBy(*by)), F.lit(0.0))
    known = F.when(F.col("where").isNotNull(), F.col("odds"))
    elsewhere = F.when((F.col("x_area") != "") | F.col("where").isNull(), 0.0).otherwise(total(known, "x_id") - total(known, "x_id", "where"))
    confidence = F.col("odds") / (1 + F.greatest(total("odds", "y_id"), F.col("odds") + elsewhere))
    return good.withColumn("confidence", confidence).where("confidence >= 0.5").select(F.col("x_id").alias("body_id"), F.col("y_id").cast("int").alias("unit_id"), "confidence")


def _features() -> list[Column]:
    # one of k candidates is the right one: odds of one to the k - 1 others
    return [F.lit(1.0), F.col("place_score"), F.col("typed").cast("double"), F.log(F.col("x_rivals") - 0.9), F.log(F.col("y_rivals") - 0.9)]


def _host_bin() -> Column:
    """0 other hosts, 1 similar ones, 2 equal ones, null where one isn't exclusive."""
    return F.when(F.col("host_dice") == 1, 2).when(F.col("host_dice") >= 0.6, 1).when(F.col("host_dice").isNotNull(), 0)


@dataclass(frozen=True)
class Confidence:
    """In log odds: the curve over ``_features``, and what an equal area and other, similar or equal hosts add."""

    place: tuple[float, ...] = (-6.0, 8.0, -0.5, -1.0, -0.3)
    area: float = 3.0
    host: tuple[float, float, float] = (-2.0, 0.0, 3.0)


def fit_confidence(rows: DataFrame, sample: int = SAMPLE, at_large: float | None = None) -> Confidence:
    """Fitted on at most ``sample`` of the candidate pairs, those of smallest hash.

    The curve is ridge-penalised towards the defaults, and rates have the defaults as
    twenty pairs, so few or one-sided pairs leave the defaults nearly as they are.
    """
    known = rows.where("area_score is not null or host_dice is not null")
    got = known.select(*(c.cast("double").alias(f"f{k}") for k, c in enumerate(_features())), "area_score", _host_bin().alias("bin"), F.xxhash64("x_id", "y_id").alias("h")).orderBy("h").limit(sample).collect()
    default = Confidence()
    prior = np.array(default.place)
    told = [r for r in got if r["area_score"] is not None]
    beta = prior.copy()
    if told:
        x, y = np.array([[r[f"f{k}"] for k in range(len(prior))] for r in told]), np.array([float(r["area_score"] > 0) for r in told])
        for _ in range(200):
            p = 1 / (1 + np.exp(-(x @ beta)))
            slope = x.T @ (p - y) + 0.5 * (beta - prior)
            curve = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(beta))
            step = np.linalg.solve(curve, slope)
            beta = beta - step / max(1.0, float(np.abs(step).max()))
            if np.abs(step).max() < 1e-8:
                break
    # an equal area: among pairs of one host, against pairs at large
    hosted = [r["area_score"] > 0 for r in told if r["bin"] == 2]
    at_large = np.exp(-default.area) if at_large is None else min(max(at_large, 1e-6), np.exp(-default.area))  # how often two areas agree by chance
    area = np.log((sum(hosted) + 19) / (len(hosted) + 20) / at_large)
    host = []
    for k, d in enumerate(default.host):
        yes, no = ([r["bin"] == k for r in told if r["bin"] is not None and (r["area_score"] > 0) is label] for label in (True, False))
        host.append(float(np.log((sum(yes) + 20 / 3) / (len(yes) + 20)) - np.log((sum(no) + 20 / 3 * np.exp(-d)) / (len(no) + 20 / 3 * sum(np.exp(-e) for e in default.host)))))
    return Confidence(tuple(beta.tolist()), float(area), tuple(host))
