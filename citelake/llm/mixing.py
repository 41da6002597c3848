"""Mixing sources to target weights: complete epochs, then a weighted sample without replacement by exponential keys.

A document's size is its number of tokens. Each source gets a budget of tokens in proportion to its target share; it is used
in complete epochs while they fit, and the rest is filled by documents in the order of their keys, an exponential variate
divided by a quality weight, up to the budget. The order is never materialised whole: a histogram of the keys gives the
prefix sums by bucket, buckets below the one where the budget ends are taken as they are, and only that bucket is sorted.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citelake.session import materialise

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the byte-level vocabulary cuts a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAST_WEIGHT = 0.05
ROWS_PER_BUCKET = 50_000
WORD = re.compile(r"[^\W_]+")
SIZED = "doc_id bigint, source string, n_tokens bigint, weight double"


def quality(text: str) -> float:
    """A weight from `LEAST_WEIGHT` to 1: the share of letters and digits among the visible characters, times half plus half the share of different words."""
    found = WORD.findall(text.lower())
    visible = sum(map(len, text.split()))
    if not found or not visible:
        return LEAST_WEIGHT
    return max(LEAST_WEIGHT, sum(map(len, found)) / visible * (0.5 + 0.5 * len(set(found)) / len(found)))


def _counter(vocabulary: str) -> Callable[[list[str]], list[int]]:
    """Counts the tokens of texts by a public vocabulary: `.tiktoken` ranks or a `.json` tokenizer. Special tokens in a text are ordinary text."""
    if vocabulary.endswith(".tiktoken"):
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        encode = tiktoken.Encoding("vocabulary", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda texts: [len(encode(t)) for t in texts]
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True
    return lambda texts: [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def _measure(vocabulary: str, texts_at_a_time: int = 256):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(vocabulary)
        for batch in batches:
            for start in range(0, batch.num_rows, texts_at_a_time):
                part = batch.slice(start, texts_at_a_time)
                texts = [t or "" for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(count(texts), pa.int64()), pa.array([quality(t) for t in texts], pa.float64())],
                    names=["doc_id", "source", "n_tokens", "weight"],
                )

    return run


def sized_documents(documents: DataFrame, *, doc_id: str = "doc_id", source: str = "source", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """`(doc_id, source, n_tokens, weight)` of every document; a null text has no tokens."""
    return documents.select(F.col(f"`{doc_id}`").cast("bigint"), F.col(f"`{source}`"), F.col(f"`{text}`")).mapInArrow(_measure(vocabulary), SIZED)


def _uniform(seed: int, *columns: str) -> Column:
    """A number in (0, 1) from a hash of the columns."""
    return (F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def exponential_key(seed: int) -> Column:
    """Exponential by weight; a weight that is null or below `LEAST_WEIGHT` counts as that."""
    return -F.log(_uniform(seed, "doc_id", "source", "n_tokens")) / F.greatest(F.col("weight"), F.lit(LEAST_WEIGHT))


def source_targets(targets: DataFrame) -> list[tuple[str, float, int]]:
    """(source, share, most uses) per source; shares of a source named twice add up, null or negative ones count as none, null caps as 1."""
    rows = targets.where("source is not null").groupBy("source").agg(F.sum(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("share"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))).alias("cap"))
    return [(r["source"], float(r["share"]), int(r["cap"])) for r in rows.orderBy("source").collect()]


def budgets(targets: list[tuple[str, float, int]], available: dict[str, int], total: int | None) -> list[tuple[str, float, int, int, int, int]]:
    """(source, share, cap, available, epochs, rest) of each target.

    Targets without documents have nothing; the others' shares are scaled up to sum to 1. Without a `total` the mix is the
    largest that meets every share within its cap. A source never gives more than its cap allows.
    """
    usable = {s: share for s, share, cap in targets if share > 0 and cap > 0 and available.get(s, 0) > 0}
    scale = sum(usable.values())
    caps = {s: cap for s, _, cap in targets}
    if total is None:
        total = int(min((available[s] * caps[s] * scale / share for s, share in usable.items()), default=0))
    out = []
    for s, share, cap in targets:
        have = available.get(s, 0)
        budget = min(have * cap, int(total * usable[s] / scale)) if s in usable else 0
        epochs = budget // have if have else 0
        out.append((s, share, cap, have, epochs, budget - epochs * have))
    return out


def mix(sized: DataFrame, targets: DataFrame, *, total: int | None = None, seed: int = 20_190_806) -> tuple[DataFrame, DataFrame]:
    """The chosen documents `(doc_id, source, n_tokens, n_rows, times)` and the shares reached.

    `sized` is read several times, so store it first. Rows alike in id, source and size count as `n_rows` copies of one
    document, and `times` is how often they are used together; no copy is used more than the source's cap. Documents without
    tokens, without a source, or of a source without a target are not chosen. The sample depends on the seed and the
    documents alone, not on how they are partitioned. A source ends within half a document of its
    budget. Shares: `(source, target_share, max_repeats, available_tokens, budget_tokens, epochs, chosen_tokens, n_documents,
    actual_share)` for every target, zeros where nothing could be chosen.
    """
    spark = sized.sparkSession
    wanted = source_targets(targets)
    names = spark.createDataFrame([(s,) for s, _, _ in wanted], "source string")
    docs = sized.where("n_tokens > 0").join(F.broadcast(names), "source")  # one row per target
    docs = docs.groupBy("doc_id", "source", "n_tokens").agg(F.count("*").alias("n_rows"), F.max("weight").alias("weight"))
    docs = materialise(docs.withColumn("key", exponential_key(seed)), "weighed")
    stats = docs.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("n_rows")).alias("tokens"), F.count("*").alias("docs")).collect()
    available = {r["source"]: r["tokens"] for r in stats}
    plan = budgets(wanted, available, total)
    plan_df = spark.createDataFrame(plan, "source string, target_share double, max_repeats int, available_tokens bigint, epochs bigint, rest bigint")

    # Buckets part every doubling of the key alike, so whatever the weights, none holds more than about 0.4 / `parts` of a source.
    parts = max(256, sum(r["docs"] for r in stats) // ROWS_PER_BUCKET)
    docs = docs.withColumn("bucket", F.floor(F.log2("key") * parts)).withColumn("size", F.col("n_tokens") * F.col("n_rows"))
    by_bucket = docs.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
    running = F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))  # one row per bucket
    prefix = by_bucket.withColumn("upto", running).join(F.broadcast(plan_df.select("source", "rest")), "source")
    edge = prefix.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("size") <= F.col("rest")))
    edge = edge.select("source", F.col("bucket").alias("edge"), (F.col("upto") - F.col("size")).alias("before"))
    edge = spark.createDataFrame([tuple(r) for r in edge.collect()], "source string, edge bigint, before bigint")  # one row per source

    base = docs.join(F.broadcast(plan_df.select("source", "epochs", "rest")), "source").join(F.broadcast(edge), "source", "left")
    clear = base.where("edge is null or bucket <> edge").withColumn("extra", F.when(F.col("edge").isNull() | (F.col("bucket") > F.col("edge")), 0).otherwise(F.col("n_rows")))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("size").over(order), F.lit(0))
    room = F.col("rest") - F.col("before") - ahead
    at_edge = base.where("bucket = edge").withColumn("room", room)
    fits = F.least(F.col("n_rows"), F.floor(F.greatest(F.col("room"), F.lit(0)) / F.col("n_tokens")))
    # The prefix ends at the first document that does not fit whole; it is used once more if that comes nearer to the budget.
    blocked = F.max(F.when(fits < F.col("n_rows"), 1).otherwise(0)).over(order)
    left = F.col("room") - fits * F.col("n_tokens")
    last = F.when((fits < F.col("n_rows")) & (2 * left > F.col("n_tokens")), 1).otherwise(0)
    at_edge = at_edge.withColumn("extra", F.when(F.coalesce(blocked, F.lit(0)) == 1, 0).otherwise(fits + last)).drop("room")
    used = clear.unionByName(at_edge).withColumn("times", F.col("epochs") * F.col("n_rows") + F.col("extra"))
    chosen = used.where("times > 0").select("doc_id", "source", "n_tokens", "n_rows", F.col("times").cast("bigint").alias("times"))

    got = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("times")).alias("chosen_tokens"), F.count("*").alias("n_documents"))
    whole = Window.partitionBy(F.lit(1))  # one row per target
    shares = plan_df.join(F.broadcast(got), "source", "left").fillna(0, ["chosen_tokens", "n_documents"])
    shares = shares.withColumn("all_tokens", F.sum("chosen_tokens").over(whole))
    shares = shares.select(
        "source", "target_share", "max_repeats", "available_tokens", (F.col("epochs") * F.col("available_tokens") + F.col("rest")).alias("budget_tokens"), "epochs", "chosen_tokens", "n_documents",
        F.round(F.when(F.col("all_tokens") > 0, F.col("chosen_tokens") / F.nullif(F.col("all_tokens"), F.lit(0))).otherwise(0.0), 6).alias("actual_share"),
    )
    return chosen, shares
