"""Mixes of sources with target shares, by entropy balancing.

Every document gets a rate, the expected number of its copies. Among all rates that give each source its tokens, those
nearest to one copy each (in relative entropy) are exponentially tilted: rate = exp(lambda of its source * its tokens
over the source's mean). The lambdas solve the convex dual; Newton's iterations for all sources run together, each as one
distributed aggregation over the histogram (source, tokens, documents), which is all the solver needs. Rates are cut at
the source's repeat cap, and a bracket around each lambda keeps the iterations safe where the cap makes the dual flat. A
source whose documents are all at the cap while its target is still missed has a dual without a maximum: it can't reach its
share, and that is how :func:`unreachable` knows.
Rates are then rounded to copies systematically, in an order that reruns and any partitioning agree on.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.plans.lineage import broadcast_checked, cut

#: The public tokenizer whose tokens are the sizes, and its splitting pattern (fixed values).
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Rounds of Newton's iteration, and how near a source's tokens come to its target, from above and from below.
ROUNDS, CLOSE, CLOSEST = 200, 1e-9, 1e-13
#: Documents of one source and length that one task numbers.
PART_DOCS = 50_000


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str | None, path: str = TOKENIZER, pattern: str = PATTERN) -> int:
    if not text:
        return 0
    encode = encoding(path, pattern).encode_ordinary
    return len(encode(text))


def source_name(column: Column | str) -> Column:
    """Sources are compared trimmed (of any blanks) and in lower case; blank ones are null."""
    plain = F.lower(F.regexp_replace(F.col(column) if isinstance(column, str) else column, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    return F.when(plain != "", plain)


def sized(documents: DataFrame, path: str = TOKENIZER, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, source, n_tokens) of every document with a source; null texts have no tokens. One pass, no shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, int] = {}
            counts = []
            for text in batch.column(2).to_pylist():
                n = known.get(text) if text else 0
                if n is None:
                    n = known[text] = count_tokens(text, path, pattern)
                counts.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "source", "n_tokens"])

    own = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), source_name("source").alias("source"), F.col("text").cast("string").alias("text"))
    return own.where(F.col("source").isNotNull()).mapInArrow(run, "doc_id bigint, source string, n_tokens bigint")


@dataclass
class Balance:
    """A solved mix: its tokens, and one row per source of the targets (``state``): source, weight, cap, tokens, docs, mean,
    target, lam (the dual variable) and status, 'solved' or 'saturated'. A saturated source has every document at its cap and
    still misses its target: its dual has no maximum, it can't reach its share."""

    total: int
    state: DataFrame

    def rated(self, sizes: DataFrame) -> DataFrame:
        """``sizes`` with the rate of each document; documents of other sources than the mix's are left out."""
        own = broadcast_checked(self.state.select("source", "mean", "lam", "status", F.col("cap").cast("double").alias("cap"), "target"))
        tilted = F.least(F.col("cap"), _tilted())
        rate = F.when(F.col("target") <= 0, 0.0).when(F.col("status") == SATURATED, F.col("cap")).otherwise(tilted)
        return sizes.join(own, "source").select(*sizes.columns, rate.alias("rate"))


OPEN, SOLVED, SATURATED = "open", "solved", "saturated"


def _tilted() -> Column:
    return F.exp(F.least(F.lit(700.0), F.col("n_tokens") * F.col("lam") / F.col("mean")))


def _newton(histogram: DataFrame, state: DataFrame) -> DataFrame:
    """Solves sum(n * count * min(cap, exp(lam * n / mean))) = target for every open source of ``state``.

    One round is one aggregation of the histogram and one update of the state, both distributed; the state is written to
    the checkpoint folder, and the driver learns how many sources are still open. ``room`` is what isn't at its cap yet:
    where there is none and the target is still missed, the dual has no maximum.
    """
    inf = F.lit(math.inf)
    for _ in range(ROUNDS):
        left = state.where(F.col("status") == OPEN).select("source", "lam", "mean", F.col("cap").cast("double").alias("cap"))
        asked = broadcast_checked(left)
        weight = F.col("n_tokens") * F.col("n_docs")
        below = _tilted() < F.col("cap")
        sums = histogram.join(asked, "source").groupBy("source").agg(F.sum(weight * F.least(F.col("cap"), _tilted())).alias("g"), F.sum(F.when(below, weight * F.col("n_tokens") * _tilted())).alias("h"), F.sum(F.when(below, weight)).alias("room"))
        gap, slope = F.col("target") - F.coalesce("g", F.lit(0.0)), F.coalesce("h", F.lit(0.0)) / F.col("mean")
        met = state.join(sums, "source", "left").withColumn("gap", gap).withColumn("newton", F.when(slope > 0, F.col("lam") + gap / slope))
        met = met.withColumn("low", F.when(F.col("gap") > 0, F.col("lam")).otherwise(F.col("low"))).withColumn("high", F.when(F.col("gap") < 0, F.col("lam")).otherwise(F.col("high")))
        upwards = F.greatest(F.col("newton"), 2 * F.col("lam"), F.when(F.col("newton").isNull(), 1.0))
        downwards = F.coalesce(F.col("newton"), F.when(F.col("high") > 0, F.col("high") / 2).otherwise(F.least(F.lit(-1.0), 2 * F.col("high"))))
        between = F.when((F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high")), F.col("newton")).otherwise((F.col("low") + F.col("high")) / 2)
        step = F.when(F.col("high") == inf, upwards).when(F.col("low") == -inf, downwards).otherwise(between)
        saturated = (F.coalesce("room", F.lit(0)) == 0) & (F.col("gap") > 0)
        done = ((F.col("gap") <= 0) & (F.col("gap") >= -CLOSE * F.col("target"))) | ((F.col("gap") > 0) & (F.col("gap") <= CLOSEST * F.col("target"))) | (step == F.col("lam"))
        is_open = F.col("status") == OPEN
        status = F.when(~is_open, F.col("status")).when(saturated, SATURATED).when(done, SOLVED).otherwise(OPEN)
        met = met.withColumn("now", status)
        state = cut(met.select("source", "weight", "cap", "tokens", "docs", "mean", "target", F.when(F.col("now") == OPEN, step).otherwise(F.col("lam")).alias("lam"), "low", "high", F.col("now").alias("status")))
        if state.where(F.col("status") == OPEN).isEmpty():
            break
    return state.withColumn("status", F.when(F.col("status") == OPEN, SOLVED).otherwise(F.col("status")))


def _sums(histogram: DataFrame) -> DataFrame:
    return histogram.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("n_docs")).alias("tokens"), F.sum("n_docs").alias("docs"))


def _plan(histogram: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, weight, cap, tokens, docs) of every source with a target."""
    asked = targets.select(source_name("source").alias("source"), F.col("target_weight").cast("double").alias("w"), F.coalesce(F.col("max_repeats").cast("int"), F.lit(1)).alias("cap")).where(F.col("source").isNotNull() & F.col("w").isNotNull())
    first = asked.groupBy("source").agg(F.min(F.struct("w", "cap")).alias("t")).select("source", F.col("t.w").alias("weight"), F.greatest(F.lit(0), F.col("t.cap")).alias("cap"))
    return first.join(_sums(histogram), "source", "left").select("source", "weight", "cap", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("docs", F.lit(0)).alias("docs"))


def balance(histogram: DataFrame, targets: DataFrame, total: int | None = None) -> Balance:
    """Solves for a mix of ``total`` tokens, by default as many as all sources together. ``histogram``: (source, n_tokens,
    n_docs), as :func:`lengths` gives it.

    ``targets`` (source, target_weight, max_repeats): rows with a null source or weight are left out, of repeated sources
    the one with the least weight, then cap, counts, a null cap means 1. A source that can't reach its share comes out
    saturated; its rate is its cap. Any number of sources: nothing but totals returns to the driver.
    """
    whole = total if total is not None else int(histogram.agg(F.sum(F.col("n_tokens") * F.col("n_docs"))).first()[0] or 0)
    plan = _plan(histogram, targets).withColumn("mean", F.greatest(F.lit(1e-9), F.coalesce(F.col("tokens") / F.when(F.col("docs") > 0, F.col("docs")), F.lit(1.0)))).withColumn("target", F.col("weight") * F.lit(float(whole)))
    start = plan.withColumn("lam", F.lit(0.0)).withColumn("low", F.lit(-math.inf)).withColumn("high", F.lit(math.inf)).withColumn("status", F.when(F.col("target") <= 0, SOLVED).otherwise(OPEN))
    return Balance(whole, _newton(histogram, cut(start)))


def lengths(sizes: DataFrame) -> DataFrame:
    """(source, n_tokens, n_docs): all that the solver needs of the documents."""
    return cut(sizes.groupBy("source", "n_tokens").agg(F.count("*").alias("n_docs")))


def mix(sizes: DataFrame, solved: Balance, seed: int = 0) -> DataFrame:
    """(doc_id, source, n_tokens, rate, copies) of every document of the mix's sources.

    Rounding is systematic: a source's documents stand in order of their tokens (a document's rate depends on nothing
    else), and each gets as many copies as whole numbers lie between the running sums of rates before and after it. Copies
    are the rate rounded up or down, never above the cap, and a source's tokens miss their target by about one document.
    The running sums come from the histogram; documents of one length are numbered in parts of bounded size.
    """
    rated = solved.rated(sizes)
    by_length = cut(rated.groupBy("source", "n_tokens").agg(F.count("*").alias("n"), F.first("rate").alias("r")).withColumn("parts", F.ceil(F.col("n") / PART_DOCS)))
    parted = rated.join(by_length.select("source", "n_tokens", "parts"), ["source", "n_tokens"]).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("parts")))
    by_part = parted.groupBy("source", "n_tokens", "part").agg(F.count("*").alias("n"), F.first("rate").alias("r"))
    before = Window.partitionBy("source").orderBy("n_tokens", "part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.pmod(F.xxhash64(F.col("source"), F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    begins = by_part.select("source", "n_tokens", "part", (F.coalesce(F.sum(F.col("n") * F.col("r")).over(before), F.lit(0.0)) + start).alias("begin"))
    numbered = parted.withColumn("no", F.row_number().over(Window.partitionBy("source", "n_tokens", "part").orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id")))
    placed = numbered.join(begins, ["source", "n_tokens", "part"])
    # The tiny shift keeps a rate that is a whole number whole whatever the running sum's last bits are.
    upto = lambda k: F.floor(F.col("begin") + F.col("rate") * k + 1e-6)
    exact = F.col("rate") == F.floor("rate")
    copies = F.when(exact, F.floor("rate")).otherwise(F.least(F.ceil("rate"), F.greatest(F.floor("rate"), upto(F.col("no")) - upto(F.col("no") - 1))))
    return placed.select("doc_id", "source", "n_tokens", "rate", copies.cast("int").alias("copies"))


def shares(mixed: DataFrame, solved: Balance) -> DataFrame:
    """The report: (source, target_weight, max_repeats, n_docs, size_tokens, mix_tokens, actual_share, reachable)."""
    actual = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mix_tokens"))
    whole = actual.agg(F.sum("mix_tokens").alias("_all"))
    joined = solved.state.join(actual, "source", "left").withColumn("mix_tokens", F.coalesce("mix_tokens", F.lit(0)))
    share = F.col("mix_tokens") / F.when(F.col("_all") > 0, F.col("_all"))
    return joined.crossJoin(F.broadcast(whole)).select("source", F.col("weight").alias("target_weight"), F.col("cap").alias("max_repeats"), F.col("docs").alias("n_docs"), F.col("tokens").alias("size_tokens"), "mix_tokens", share.alias("actual_share"), (F.col("status") != SATURATED).alias("reachable"))


def solve(documents: DataFrame, targets: DataFrame, path: str = TOKENIZER, pattern: str = PATTERN) -> tuple[DataFrame, Balance]:
    """Sizes and the balance of a mix as large as the whole corpus."""
    sizes = cut(sized(documents, path, pattern))
    return sizes, balance(lengths(sizes), targets)


def solve_exact(documents: DataFrame, targets: DataFrame, path: str = TOKENIZER, pattern: str = PATTERN) -> tuple[DataFrame, Balance]:
    """Sizes and the balance of the largest mix, up to the whole corpus, in which every source can have its share."""
    sizes = cut(sized(documents, path, pattern))
    histogram = lengths(sizes)
    whole = int(histogram.agg(F.sum(F.col("n_tokens") * F.col("n_docs"))).first()[0] or 0)
    most = _plan(histogram, targets).where("weight > 0 and tokens > 0").agg(F.min(F.col("cap") * F.col("tokens") / F.col("weight"))).first()[0]
    return sizes, balance(histogram, targets, whole if most is None else min(whole, math.floor(most)))


def unreachable(documents: DataFrame, targets: DataFrame, path: str = TOKENIZER, pattern: str = PATTERN) -> DataFrame:
    """(source): the sources whose share stays out of reach in a mix as large as the whole corpus: those whose dual runs
    into the cap of every document and still misses the target."""
    histogram = lengths(sized(documents, path, pattern))
    return balance(histogram, targets).state.where(F.col("status") == SATURATED).select("source")
