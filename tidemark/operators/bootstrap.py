"""Bootstrap intervals of ranking metrics over resamples of exactly as many rows.

Each replicate draws as many rows with replacement as the table has. Counts are drafted as Poisson
draws at a rate a little below one, from the position of a row, and the rows still missing are
drawn one by one; together they are a multinomial draw. The known metrics are sums over buckets of
positions, all replicates of a bucket in one task; an aggregate of one's own gets the sweep of all
replicates as rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.durable import written
from tidemark.errors import ContractError
from tidemark.functions.draws import (
    DRAWS_PER_DIGEST,
    digest_draw,
    draw_digest,
    poisson_count,
    poisson_cuts,
    uniform,
)
from tidemark.operators import replicates
from tidemark.operators.combine import side_by_side
from tidemark.operators.metrics import BRIER, average_precision_sum, roc_auc_sum
from tidemark.operators.scores import ScoreProfile, profile_scores, threshold_sweep
from tidemark.llm.shipping import ship


def brier_sum() -> Column:
    return F.expr(BRIER)


# A metric is an aggregate over sweep rows (score, pos, n, cum_pos, cum_n, all_pos, all_n).
METRICS = {
    "average_precision": average_precision_sum,
    "roc_auc": roc_auc_sum,
    "brier_score": brier_sum,
}


#: Positions that a task holds at a time.
SIZE = 20_000
LEAST_BUCKETS = 32
#: Deviations by which a draft stays below the size of the table.
SPARE = 8


def draft_rate(rows: int) -> float:
    """Rate of the drafted Poisson counts; their sum exceeds ``rows`` less than once in 10^14."""
    return max(0.0, 1.0 - SPARE / math.sqrt(rows))


def _drafts(frame: DataFrame, position: Column, rate: float, seed: int) -> DataFrame:
    """``frame`` with the drafted counts w0.. of its block of replicates at ``position``.

    Each draw is a column of its own before it is compared: the methods generated for this step
    are small enough to be compiled.
    """
    draws = [digest_draw(F.col("digest"), i).alias(f"d{i}") for i in range(DRAWS_PER_DIGEST)]
    counts = [poisson_count(F.col(f"d{i}"), rate).alias(f"w{i}") for i in range(DRAWS_PER_DIGEST)]
    digest = draw_digest(position, F.col("block"), seed).alias("digest")
    return frame.select("*", digest).select(*frame.columns, *draws).select(*frame.columns, *counts)


def missing_draws(spark: SparkSession, rows: int, *, samples: int, seed: int) -> DataFrame:
    """(replicate, position): the draws that bring each replicate's draft to exactly ``rows``.

    The draft of a position is a Poisson count. Given their sum, such counts are a multinomial
    draw of that many rows; as many further rows as are missing, drawn one by one, make it a
    multinomial draw of ``rows``, as drawing with replacement does.
    """
    blocks = math.ceil(samples / DRAWS_PER_DIGEST)
    single = spark.range(rows).select("id", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    sums = _drafts(single, F.col("id"), draft_rate(rows), seed).groupBy("block").agg(
        *[F.sum(f"w{i}").alias(f"w{i}") for i in range(DRAWS_PER_DIGEST)]
    )
    each = sums.select(
        "block", F.posexplode(F.array(*[f"w{i}" for i in range(DRAWS_PER_DIGEST)])).alias("i", "w")
    ).select((F.col("block") * DRAWS_PER_DIGEST + F.col("i")).alias("replicate"), "w")
    return _single_draws(each, rows, samples=samples, seed=seed)


def _single_draws(drafted: DataFrame, rows: int, *, samples: int, seed: int) -> DataFrame:
    """(replicate, position) of as many draws as the sums ``replicate, w`` are short of ``rows``."""
    each = drafted.select("replicate", (F.lit(rows) - F.col("w")).alias("short"))
    over = F.raise_error(F.lit("a draft exceeds the table; use another seed")).cast("bigint")
    short = F.when(F.col("short") < 0, over).otherwise(F.col("short"))
    drawn = each.where(F.col("replicate") < samples).select(
        "replicate", F.explode(F.sequence(F.lit(0).cast("bigint"), short)).alias("t")
    ).where("t > 0")
    share = uniform(F.concat_ws("-", "replicate", "t"), "more", seed)
    return drawn.select("replicate", F.floor(share * F.lit(float(rows))).cast("bigint").alias("position"))


def _bucket_size(rows: int) -> int:
    return min(SIZE, math.ceil(rows / LEAST_BUCKETS))


def _parts(cells: DataFrame, size: int) -> DataFrame:
    """(bucket, at, until, score, ones, continues, ends): a line per cell and bucket it lies in."""
    edge = F.col("bucket") * size
    start = F.col("cum_n") - F.col("n")
    return cells.select(
        "score", start.alias("start"), (start + F.col("pos")).alias("ones"), F.col("cum_n").alias("end"),
        F.explode(F.sequence(F.expr(f"(cum_n - n) div {size}"), F.expr(f"(cum_n - 1) div {size}"))).alias("bucket"),
    ).select(
        "bucket", F.greatest("start", edge).alias("at"), F.least("end", edge + size).alias("until"),
        "score", "ones", (F.col("start") < edge).alias("continues"), (F.col("end") <= edge + size).alias("ends"),
    )


def resampled_cells(cells: DataFrame, rows: int, *, samples: int, seed: int) -> DataFrame:
    """(bucket, score, continues, ends, block, n0.., pos0..): weights of blocks of replicates.

    ``cells`` is the sweep. Rows of equal score and label are alike, so a row is its position in
    the order of falling scores, positives first. Positions are dealt to even buckets, in one
    shuffle before they multiply; a cell that lies in several has a part in each, which
    ``continues`` one in an earlier bucket or ``ends`` the cell.
    """
    size = _bucket_size(rows)
    blocks = math.ceil(samples / DRAWS_PER_DIGEST)
    nothing = F.lit(None).cast("bigint")
    parts = _parts(cells, size).select(
        "bucket", "at", "until", nothing.alias("replicate"),
        F.struct("score", "ones", "continues", "ends").alias("cell"),
    )
    drawn = missing_draws(cells.sparkSession, rows, samples=samples, seed=seed).select(
        F.expr(f"position div {size}").alias("bucket"), F.col("position").alias("at"),
        (F.col("position") + 1).alias("until"), "replicate",
        F.lit(None).cast(parts.schema["cell"].dataType).alias("cell"),
    )
    upto = Window.partitionBy("bucket").orderBy("at", F.col("replicate").isNotNull())
    placed = parts.unionByName(drawn).repartition("bucket").withColumn(
        "cell", F.last("cell", ignorenulls=True).over(upto)
    )
    own = F.when(F.col("replicate").isNull(), F.sequence(F.lit(0), F.lit(blocks - 1))).otherwise(
        F.array(F.expr(f"cast(replicate div {DRAWS_PER_DIGEST} as int)"))
    )
    single = placed.select(
        "bucket", "cell", "replicate", F.explode(F.sequence("at", F.col("until") - 1)).alias("position")
    ).select("*", F.explode(own).alias("block"))
    # A row of a part has the drafted counts, a missing draw counts one for its own replicate.
    weights = [
        (F.col(f"w{i}") * F.col("drafted") + (F.col("own") == i).cast("bigint")).alias(f"w{i}")
        for i in range(DRAWS_PER_DIGEST)
    ]
    cell = ["bucket", "score", "continues", "ends", "block"]
    labelled = single.select(
        "bucket", "cell.score", "cell.continues", "cell.ends", "block", "position",
        F.col("replicate").isNull().cast("bigint").alias("drafted"),
        F.coalesce(F.col("replicate") % DRAWS_PER_DIGEST, F.lit(-1)).alias("own"),
        F.coalesce(F.col("position") < F.col("cell.ones"), F.lit(False)).cast("bigint").alias("positive"),
    )
    return (
        _drafts(labelled, F.col("position"), draft_rate(rows), seed).select(*cell, "positive", *weights)
        .groupBy(*cell)
        .agg(
            *[F.sum(f"w{i}").alias(f"n{i}") for i in range(DRAWS_PER_DIGEST)],
            *[F.sum(F.col(f"w{i}") * F.col("positive")).alias(f"pos{i}") for i in range(DRAWS_PER_DIGEST)],
        )
    )


def _per_replicate(frame: DataFrame, samples: int, *columns: str) -> DataFrame:
    """One line per replicate of a block."""
    lines = F.array(*[
        F.struct(
            (F.col("block") * DRAWS_PER_DIGEST + i).alias("replicate"),
            *[F.col(f"{m}{i}").alias(m) for m in ("n", "pos")],
            *[F.col(f"{m}{i}").alias(m) for m in columns],
        )
        for i in range(DRAWS_PER_DIGEST)
    ])
    rest = [c for c in frame.columns if not c[-1].isdigit() and c != "block"]
    return frame.select(*rest, F.inline(lines)).where(F.col("replicate") < samples)


def _offsets(sums: DataFrame, samples: int) -> DataFrame:
    """(_of, _sums): what a bucket needs of the others, as an array over the replicates.

    Besides the sums before the bucket and of all, the sums of its first cell so far.
    """
    edge = F.when(F.col("continues") | ~F.col("ends"), F.col("score"))
    measures = [f"{m}{i}" for m in ("n", "pos") for i in range(DRAWS_PER_DIGEST)]
    totals = sums.groupBy("bucket", "block", edge.alias("edge"), "continues").agg(
        *[F.sum(m).alias(m) for m in measures]
    )
    return _offsets_of(_per_replicate(totals, samples), samples)


def _offsets_of(totals: DataFrame, samples: int) -> DataFrame:
    """``_offsets`` of the sums (bucket, edge, continues, replicate, n, pos)."""
    before = [Window.unboundedPreceding, -1]
    cell = Window.partitionBy("replicate", "edge").orderBy("bucket").rowsBetween(*before)
    whole = Window.partitionBy("replicate")
    above = whole.orderBy("bucket").rowsBetween(*before)
    each = totals.select(
        "bucket", "replicate", "n", "pos",
        *[F.when(F.col("continues"), F.sum(m).over(cell)).alias(f"carry_{m}") for m in ("n", "pos")],
    ).groupBy("bucket", "replicate").agg(
        *[F.sum(m).alias(m) for m in ("n", "pos")],
        *[F.coalesce(F.max(f"carry_{m}"), F.lit(0)).alias(f"carry_{m}") for m in ("n", "pos")],
    )
    line = F.struct(
        *[F.coalesce(F.sum(m).over(above), F.lit(0)).alias(f"before_{m}") for m in ("n", "pos")],
        *[F.sum(m).over(whole).alias(f"all_{m}") for m in ("n", "pos")], "carry_n", "carry_pos",
    )
    # As many entries per bucket as replicates.
    return each.select(F.col("bucket").alias("_of"), "replicate", line.alias("s")).groupBy("_of").agg(
        F.map_from_entries(F.collect_list(F.struct("replicate", "s"))).alias("by")
    ).select(
        "_of", F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), lambda i: F.col("by")[i]).alias("_sums")
    )


def replicate_sweep(sums: DataFrame, samples: int) -> DataFrame:
    """(replicate, score, pos, n, cum_pos, cum_n, all_pos, all_n) of all replicates.

    A bucket is sorted once for each block of replicates, and only bucket totals move.
    """
    upto = Window.partitionBy("bucket", "block").orderBy(F.col("score").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = sums.select(
        "*", *[F.sum(f"{m}{i}").over(upto).alias(f"cum_{m}{i}") for m in ("n", "pos") for i in range(DRAWS_PER_DIGEST)]
    )
    joined = running.join(_offsets(sums, samples).hint("shuffle_hash"), F.col("bucket") == F.col("_of"))
    own = F.get("_sums", F.col("replicate"))
    # A cell counts where it ends, with its parts before.
    return _per_replicate(joined.where("ends"), samples, "cum_n", "cum_pos").select(
        "replicate", "score",
        *[(F.col(m) + F.when(F.col("continues"), own[f"carry_{m}"]).otherwise(0)).alias(m) for m in ("pos", "n")],
        *[(own[f"before_{m}"] + F.col(f"cum_{m}")).alias(f"cum_{m}") for m in ("pos", "n")],
        *[own[f"all_{m}"].alias(f"all_{m}") for m in ("pos", "n")],
    ).where("n > 0")


def known_sums(cells: DataFrame, rows: int, *, samples: int, seed: int) -> DataFrame:
    """(replicate, all_pos, all_n, and the sum of each known metric) over the buckets.

    The draws are those of ``resampled_cells``. A task holds the positions of a bucket and counts
    them for a block of replicates at a time. Each draft is hashed twice: once for how many rows a
    replicate is short of, once for the sums with these.
    """
    spark = cells.sparkSession
    ship(spark)
    size, blocks = _bucket_size(rows), math.ceil(samples / DRAWS_PER_DIGEST)
    buckets = math.ceil(rows / size)
    cuts = [int(c, 16) for c in poisson_cuts(draft_rate(rows))]
    draw = replicates.Draw(rows, size, samples, seed, DRAWS_PER_DIGEST, cuts)

    parts = written(_parts(cells, size))
    first = parts.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(
        lambda key, own: replicates.drafted(draw, own), replicates.TOTALS
    )
    # As many lines per bucket as replicates, or twice or thrice that where a cell goes on.
    drafted = written(first)
    drawn = written(
        _single_draws(
            drafted.groupBy("replicate").agg(F.sum("n").alias("w")), rows, samples=samples, seed=seed
        ).select(F.expr(f"position div {size}").alias("bucket"), "position", "replicate")
    )
    dealt = drawn.repartition(buckets, "bucket").groupBy("bucket")
    more = parts.repartition(buckets, "bucket").groupBy("bucket").cogroup(dealt).applyInPandas(
        lambda key, own, single: replicates.single_totals(own, single), replicates.TOTALS
    )
    totals = drafted.unionByName(more).groupBy("bucket", "edge", "continues", "replicate").agg(
        F.sum("n").alias("n"), F.sum("pos").alias("pos")
    )
    offsets = _offsets_of(totals, samples).select(F.col("_of").alias("bucket"), F.posexplode("_sums").alias("replicate", "s"))
    # One table for a bucket: its parts, its single draws, and a line for each replicate.
    lines = [
        parts.withColumn("kind", F.lit(replicates.PART)),
        drawn.withColumn("kind", F.lit(replicates.SINGLE)),
        offsets.select("bucket", "replicate", "s.*").withColumn("kind", F.lit(replicates.OFFSET)),
    ]
    whole = lines[0]
    for more_lines in lines[1:]:
        whole = whole.unionByName(more_lines, allowMissingColumns=True)
    sums = whole.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(
        lambda key, own: replicates.metric_sums(draw, own), replicates.SUMS
    )
    return sums.groupBy("replicate").agg(
        F.max("all_pos").alias("all_pos"), F.max("all_n").alias("all_n"),
        *[F.sum(m).alias(m) for m in METRICS],
    )


#: A known metric from its sum over the sweep of a replicate.
_FROM_SUMS = {
    "average_precision": "coalesce(average_precision / nullif(cast(all_pos as double), 0D), 0D)",
    "roc_auc": "roc_auc / nullif(cast(all_pos as double) * cast(all_n - all_pos as double), 0D)",
    "brier_score": "brier_score / all_n",
}


def bootstrap_interval(
    frame: DataFrame,
    metrics: Sequence[str] | Mapping[str, Callable[[], Column]] = ("average_precision",),
    *,
    samples: int = 200,
    seed: int = 42,
    profile: ScoreProfile | None = None,
) -> DataFrame:
    """(metric, estimate, lower_95, upper_95, resamples, method), one row per metric.

    ``metrics`` are names, or a mapping from a name to an aggregate over sweep rows.
    Replicates with one label only are left out; at least nine in ten must remain.
    """
    if samples < 20:
        raise ContractError("samples must be at least 20")
    known = metrics if isinstance(metrics, Mapping) else METRICS
    if not metrics or any(m not in known for m in metrics):
        raise ContractError(f"metrics must be among {sorted(METRICS)}")
    profile = profile or profile_scores(frame)

    named = [known[m]().alias(m) for m in metrics]
    cells = threshold_sweep(frame, profile=profile)
    estimate = cells.agg(*named)
    both = "all_pos > 0 and all_pos < all_n"
    if isinstance(metrics, Mapping):
        sums = resampled_cells(cells, profile.rows, samples=samples, seed=seed)
        judged = replicate_sweep(sums, samples).where(both).groupBy("replicate").agg(*named)
    else:
        sums = known_sums(cells, profile.rows, samples=samples, seed=seed)
        judged = sums.where(both).select("replicate", *[F.expr(_FROM_SUMS[m]).alias(m) for m in metrics])
    # One row per replicate from here on.
    summary = judged.agg(
        F.count(F.lit(1)).alias("resamples"),
        *[F.percentile(m, F.array(F.lit(0.025), F.lit(0.975))).alias(f"{m}_range")
          for m in metrics],
    )
    row = side_by_side([estimate, summary])
    enough = F.when(
        F.col("resamples") < samples * 0.9,
        F.raise_error(F.lit("too few valid bootstrap samples")).cast("bigint"),
    ).otherwise(F.col("resamples"))
    lines = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(m).alias("estimate"),
                F.col(f"{m}_range")[0].alias("lower_95"),
                F.col(f"{m}_range")[1].alias("upper_95"),
                enough.alias("resamples"),
                F.lit("multinomial_row_bootstrap").alias("method"),
            )
            for m in metrics
        ]
    )
    return row.select(F.inline(lines))
