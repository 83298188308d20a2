"""Training-run metrics over step records and evaluation batches.

Step records have ``run_id, rank, step, step_time, data_wait, tokens, loss, grad_norm, gpu_mem``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.operators.prefix import MIN, exclusive_fold, row_position, trailing_mean

LOSS_CAP = 20.0
INF = float("inf")

# Peak dense bf16 TFLOPS by device name, matched in this order, and the fallback.
PEAK_TFLOPS = [
    ("h100", 989.0),
    ("a100", 312.0),
    ("4090", 82.6),
    ("4080", 48.7),
    ("3090", 35.6),
    ("a6000", 38.7),
]
DEFAULT_PEAK_TFLOPS = 82.6


def weighted_loss(loss: str = "loss", tokens: str = "tokens") -> Column:
    """Aggregate: token-weighted mean loss, infinite without tokens."""
    n = F.sum(tokens)
    return F.when(n > 0, F.sum(F.col(loss) * F.col(tokens)) / n).otherwise(F.lit(INF))


def perplexity_capped(loss: Column) -> Column:
    """exp of the loss, the loss cut at 20: the figure of the evaluation and the step log."""
    return F.exp(F.least(loss, F.lit(LOSS_CAP)))


def perplexity_or_inf(loss: Column) -> Column:
    """exp of a loss below 20, else infinite: the figure of the validation pass."""
    return F.when(loss < LOSS_CAP, F.exp(loss)).otherwise(F.lit(INF))


def flops_per_token(d_model: int, n_layers: int, d_ff: int) -> int:
    """The published per-token estimate. It leaves out a quarter of the attention projections on purpose."""
    return n_layers * (6 * d_model * d_model + 6 * d_model * d_ff)


def peak_tflops(device: Column) -> Column:
    name = F.lower(device)
    return reduce(
        lambda other, row: F.when(F.contains(name, F.lit(row[0])), F.lit(row[1])).otherwise(other),
        reversed(PEAK_TFLOPS), F.lit(DEFAULT_PEAK_TFLOPS),
    )


def mfu_percent(tokens_per_sec: Column, flops: Column, peak: Column) -> Column:
    """Share of the peak used, in percent; 0 where no peak is known."""
    return F.when(peak > 0, tokens_per_sec * flops / (peak * 1e12) * 100).otherwise(F.lit(0.0))


def rank_mean_loss(batches: DataFrame, by: str) -> DataFrame:
    """Mean over ranks of each rank's weighted loss, beside the fully weighted mean.

    As published, perplexity is the first rank's own and is not recomputed from the mean.
    """
    per_rank = batches.groupBy(by, "rank").agg(
        weighted_loss().alias("rank_loss"), F.sum(F.col("loss") * F.col("tokens")).alias("__lt"),
        F.sum("tokens").alias("__t"),
    )
    return per_rank.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_ranks"), F.avg("rank_loss").alias("mean_loss"),
        (F.sum("__lt") / F.sum("__t")).alias("weighted_loss"),
        perplexity_or_inf(F.min_by("rank_loss", "rank")).alias("perplexity"),
    )


def bench_summary(steps: DataFrame, warmup: int, flops: int, peak: float) -> DataFrame:
    """Per run, after ``warmup`` steps: mean times, wait share, throughput, peak memory, utilisation."""
    tps = F.sum("tokens") / F.sum("step_time")
    return steps.filter(F.col("step") >= warmup).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_steps"), (F.avg("step_time") * 1000).alias("step_time_ms"),
        (F.avg("data_wait") * 1000).alias("data_wait_ms"),
        (F.avg("data_wait") / F.avg("step_time") * 100).alias("data_wait_pct"),
        tps.alias("tokens_per_sec"), F.max("gpu_mem").alias("peak_mem_gb"),
        mfu_percent(tps, F.lit(float(flops)), F.lit(peak)).alias("mfu_pct"),
    )


def interval_metrics(steps: DataFrame, every: int) -> DataFrame:
    """Per run and completed interval of ``every`` steps: throughput, waiting, last loss and perplexity."""
    group = F.floor((F.col("step") - 1) / every)
    out = steps.filter(F.col("step") >= 1).groupBy("run_id", group.alias("interval")).agg(
        F.max("step").alias("last_step"), F.sum("tokens").alias("tokens"), F.sum("step_time").alias("elapsed"),
        (F.avg("data_wait") * 1000).alias("data_wait_ms"), F.max_by("loss", "step").alias("loss"),
        F.max_by("grad_norm", "step").alias("grad_norm"), F.max_by("gpu_mem", "step").alias("gpu_mem"),
    )
    return out.select(
        "run_id", "interval", "last_step", "tokens",
        F.coalesce(F.try_divide("tokens", "elapsed"), F.lit(0.0)).alias("tokens_per_sec"),
        "data_wait_ms", "loss", perplexity_capped(F.col("loss")).alias("perplexity"), "grad_norm", "gpu_mem",
    )


def metrics_long(intervals: DataFrame) -> DataFrame:
    """Interval metrics as ``(run_id, tag, step, value)`` points."""
    tags = {
        "train/loss": "loss", "train/perplexity": "perplexity", "train/grad_norm": "grad_norm",
        "train/tokens_per_sec": "tokens_per_sec", "system/gpu_mem_allocated": "gpu_mem",
        "system/dataloader_wait_ms": "data_wait_ms",
    }
    wide = intervals.select(
        "run_id", F.col("last_step").alias("step"),
        *[F.col(c).cast("double").alias(t) for t, c in tags.items()],
    )
    return wide.unpivot(["run_id", "step"], list(tags), "tag", "value")


def run_health(steps: DataFrame, vocab_size: int) -> DataFrame:
    """The checks of a training run as columns. Steps count from 0 in step order.

    A run passes if no loss or gradient is exactly 0 after step 50, the mean loss of its last ten steps is
    more than 0.01 below that of steps 50 to 59, and it starts above 0.1.
    """
    at = row_position(steps, ["run_id"], "step", "i").select("run_id", "i", "loss", "grad_norm")
    late = F.col("i") > 50
    base = at.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.coalesce(F.bool_or(late & (F.col("loss") == 0)), F.lit(False)).alias("zero_loss"),
        F.coalesce(F.bool_or(late & (F.col("grad_norm") == 0)), F.lit(False)).alias("zero_grad"),
        F.avg(F.when(F.col("i").between(50, 59), F.col("loss"))).alias("early_loss"),
        F.min_by("loss", "i").alias("first_loss"),
    )
    newest = Window.partitionBy("run_id").orderBy(F.desc("i"))
    last = (
        at.withColumn("rn", F.row_number().over(newest)).filter(F.col("rn") <= 10)
        .groupBy("run_id").agg(F.avg("loss").alias("final_loss"))
    )
    falls = F.coalesce(F.col("final_loss") < F.col("early_loss") - 0.01, F.lit(False))
    return base.join(last, "run_id").select(
        "run_id", "n_steps", "zero_loss", "zero_grad", "early_loss", "final_loss", falls.alias("loss_falls"),
        (F.col("first_loss") > 0.1).alias("starts_high"),
        (F.col("first_loss") - F.log(F.lit(float(vocab_size)))).alias("first_minus_ln_vocab"),
        (~F.col("zero_loss") & ~F.col("zero_grad") & falls & (F.col("first_loss") > 0.1)).alias("healthy"),
    )


def rolling_step_time(steps: DataFrame, size: int = 100) -> DataFrame:
    return trailing_mean(steps.select("run_id", "step", "step_time"), "step_time", ["run_id"], "step", size,
                         "mean_step_time")


def best_checkpoints(series: DataFrame) -> DataFrame:
    """Points of ``(run_id, step, val_loss)`` that are strictly below everything before them in their run."""
    run = exclusive_fold(series, "val_loss", ["run_id"], "step", "best_before", MIN)
    return run.filter(F.col("val_loss") < F.coalesce("best_before", F.lit(INF))).select(
        "run_id", "step", "val_loss", "best_before"
    )


CHECKPOINT_NAME = r"checkpoint_step_(\d+)\.pt$"


def retention_plan(catalog: DataFrame, keep_last: int, free_gb: float) -> DataFrame:
    """Step checkpoints that a cleanup would delete; the newest ones and every best one stay.

    Per run only the newest ``k`` are ranked (a pre-shuffle limit), which gives the step to cut at.
    """
    keep = min(keep_last, max(1, int(free_gb / 2)))
    named = catalog.withColumn("step", F.regexp_extract("path", CHECKPOINT_NAME, 1).try_cast("long"))
    named = named.filter(F.col("step").isNotNull())
    newest = Window.partitionBy("run_id").orderBy(F.desc("step"))
    floor = (
        named.select("run_id", "step").withColumn("rn", F.row_number().over(newest))
        .filter(F.col("rn") <= keep).groupBy("run_id").agg(F.min("step").alias("oldest_kept"))
    )
    return named.join(floor, "run_id").filter(F.col("step") < F.col("oldest_kept")).select("run_id", "path", "step")


def metrics_by_window(points: DataFrame, width: str) -> DataFrame:
    """Points per tag and time window: count, mean and sum. Works on batch and streaming input alike."""
    return points.groupBy(F.window("ts", width), "tag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")
    ).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "tag", "n", "total")
