"""Problem 9: a blend of sources with target shares of the tokens.

Every text gets an exponential key scaled by its quality weight (Efraimidis and Spirakis):
``-ln(u) / w`` with ``u`` from a hash of seed and id, so the order within a source is a
weighted sample without replacement and the same on every run. A source first goes in whole
as often as its budget allows (complete epochs); the rest of the budget is a prefix of its
order, found from prefix sums of tokens.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicgrain.llm.storage import saved

# Prefix sums run over slices of the keys first, then within each. Keys are exponential, so however they are weighted
# no stretch between two powers of two holds more than a few tenths of a source, and none of these slices more than a few thousandths.
_SLICES = 256  # between a key and its double


def tokenizer(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Path of a public tokenizer's vocabulary; the folder is ``$TOKENIZERS`` or /opt/tokenizers. The driver reads it and sends it on."""
    return os.path.join(os.environ.get("TOKENIZERS", "/opt/tokenizers"), name)


# Fixed value: the split pattern that belongs to the vocabulary of the default tokenizer.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def count_tokens(texts: DataFrame, path: str) -> DataFrame:
    """The rows with a column ``tokens``, the length of ``text`` in tokens of a byte-level vocabulary."""
    schema = texts.drop("text").schema.add("tokens", "long")
    with open(path, "rb") as f:
        vocabulary = texts.sparkSession.sparkContext.broadcast(f.read())  # a fixed file of about a megabyte

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.value.splitlines())}
        encoder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            sizes = [len(encoder.encode_ordinary(t)) for t in batch.column("text").to_pylist()]
            out = batch.select([c for c in batch.schema.names if c != "text"])
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(sizes, pa.int64())], names=[*out.schema.names, "tokens"])

    return texts.mapInArrow(run, schema)


def quality(text: Column) -> Column:
    """Weight in (0, 1]: the share of letters, digits and plain blanks, squared."""
    plain = F.length(F.regexp_replace(text, r"[^\p{L}\p{N} \n]", "")) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(plain * plain, F.lit(0.01))


def mix_sources(documents: DataFrame, targets: DataFrame, tokenizer_path: str, total_tokens: int | None = None, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(mix, report). mix: (doc_id, source, tokens, copies) of the texts used; report: (source,
    target_share, max_repeats, available_tokens, budget_tokens, used_tokens, share) of each target.

    Without ``total_tokens`` the blend is the largest in which every source that has any text
    reaches its share within its repeats. With it, a source that can't fill its budget gives
    all it may. A source of the targets without documents stays in the report with no tokens;
    a source without a target isn't used. ``share`` is of the tokens used.

    Sources are compared trimmed and in lower case. Equal texts of sources with a target count
    once, as the one of smallest id, so that none is used oftener than ``max_repeats``. Null or empty texts, null
    ids and null sources are left out; a null or negative target is no target.
    """
    clean = lambda c: F.lower(F.trim(c))
    wanted = targets.where("source is not null and target_share > 0 and max_repeats > 0").groupBy(clean(F.col("source")).alias("source")).agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").cast("long").alias("max_repeats"))
    texts = documents.where("doc_id is not null and text is not null and text <> '' and source is not null").select(F.col("doc_id").cast("long").alias("doc_id"), clean(F.col("source")).alias("source"), "text")
    texts = texts.join(wanted.select("source"), "source", "left_semi")
    # equal texts meet by their digest only, and only those there are several of; where the planner can broadcast
    # the copies, texts aren't shuffled. A text with a third of all rows is one row a task in the count.
    digest = texts.select("doc_id", F.sha2("text", 256).alias("digest"))
    several = digest.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = saved(digest.join(several, "digest").where("doc_id <> first").select("doc_id"))
    texts = texts.join(copies, "doc_id", "left_anti")
    u = (F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    sized = count_tokens(texts.withColumn("key", -F.log(u) / quality(F.col("text"))), tokenizer_path)
    sized = saved(sized.where("tokens > 0").dropDuplicates(["doc_id"]))
    held = saved(wanted.join(sized.groupBy("source").agg(F.sum("tokens").alias("available_tokens")), "source", "left").withColumn("available_tokens", F.coalesce("available_tokens", F.lit(0).cast("long"))))
    most = F.col("available_tokens") * F.col("max_repeats")
    if total_tokens is None:
        total = held.where("available_tokens > 0").agg(F.min(most / F.col("target_share"))).first()[0] or 0.0  # one number
    else:
        total = float(total_tokens)
    plan = held.withColumn("budget_tokens", F.least(most, F.floor(F.lit(total) * F.col("target_share") + 1e-6).cast("long")))
    plan = plan.withColumn("epochs", F.when(F.col("available_tokens") > 0, F.floor(F.col("budget_tokens") / F.col("available_tokens"))).otherwise(0)).withColumn("rest", F.col("budget_tokens") - F.col("epochs") * F.col("available_tokens"))
    sliced = sized.withColumn("slice", F.floor(F.log2("key") * _SLICES).cast("int"))
    sums = sliced.groupBy("source", "slice").agg(F.sum("tokens").alias("held"))
    before = sums.withColumn("before", F.coalesce(F.sum("held").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("source", "slice", "before")
    inside = F.sum("tokens").over(Window.partitionBy("source", "slice").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    placed = sliced.withColumn("inside", inside).join(before, ["source", "slice"]).join(plan.select("source", "epochs", "rest"), "source")
    copies = F.col("epochs") + F.when(F.col("before") + F.col("inside") <= F.col("rest"), 1).otherwise(0)
    mix = placed.select("doc_id", "source", "tokens", copies.cast("int").alias("copies")).where("copies > 0")
    used = mix.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("used_tokens"))
    report = plan.join(used, "source", "left").withColumn("used_tokens", F.coalesce("used_tokens", F.lit(0).cast("long")))
    share = F.col("used_tokens") / F.sum("used_tokens").over(Window.partitionBy())  # one row a target
    return mix, report.select("source", "target_share", "max_repeats", "available_tokens", "budget_tokens", "used_tokens", F.coalesce(F.round(share, 6), F.lit(0.0)).alias("share"))
