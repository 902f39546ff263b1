"""Order statistics that stay distributed: global ranks, threshold curves, exact samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: Range buckets of a global rank; the offset table has as many rows.
BUCKETS = 64


def global_rank(df: DataFrame, by: str, ties: list[str], out: str = "rank", start: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """Position of each row by ``by`` ascending, then ``ties``, without one task that sees all rows.

    Values are cut at approximate quantiles; rows are numbered within a bucket and moved by the
    rows of the buckets before. A value that fills several quantiles is cut again at quantiles of
    the first tie column, if that is a number. Nulls come last. The cuts, and so the offsets, are
    bounded by ``buckets`` squared.
    """
    cuts = [i / buckets for i in range(1, buckets)]
    marks = df.select(F.percentile_approx(by, cuts, 10_000)).first()[0] or []
    bounds = sorted(set(marks))
    heavy = [v for v in bounds if marks.count(v) > 1] if ties and isinstance(df.schema[ties[0]].dataType, NumericType) else []
    below = lambda values, c: F.size(F.filter(F.array(*map(F.lit, values)), lambda b: b < c)) if values else F.lit(0)
    part = F.lit(0)
    if heavy:
        row = df.agg(*[F.percentile_approx(F.when(F.col(by) == v, F.col(ties[0])), cuts).alias(f"v{i}") for i, v in enumerate(heavy)]).first()
        for i, v in enumerate(heavy):
            part = F.when(F.col(by) == v, 1 + below(sorted(set(row[i] or [])), F.col(ties[0]))).otherwise(part)
    bucket = F.when(F.col(by).isNull(), F.lit((buckets + 1) ** 2)).otherwise(below(bounds, F.col(by)) * (buckets + 1) + part)
    dealt = df.withColumn("_bucket", bucket)
    before, total = [], 0
    for row in dealt.groupBy("_bucket").agg(F.count("*").alias("_n")).orderBy("_bucket").collect():
        before += [F.lit(row["_bucket"]), F.lit(total)]
        total += row["_n"]
    offset = F.try_element_at(F.create_map(*before), F.col("_bucket")) if before else F.lit(0)
    own = F.row_number().over(Window.partitionBy("_bucket").orderBy(F.col(by).asc_nulls_last(), *ties))
    return dealt.withColumn(out, (own + offset + (start - 1)).cast("long")).drop("_bucket")


def blind_correct(scores: Column, threshold: float = 0.5) -> Column:
    """How many of the scores (text or numbers) reach the threshold; what can't be read counts for nothing."""
    return F.size(F.filter(scores, lambda s: F.coalesce(s.cast("string").try_cast("double") >= threshold, F.lit(False))))


def valid_loss(loss: Column) -> Column:
    return loss.isNotNull() & ~F.isnan(loss)


def overlap_curve(items: DataFrame, qid: str, k: str, loss: str, x_min: int = 0, x_max: int = 10) -> DataFrame:
    """(x, y, jaccard, delta_j, overlap): the y items answered right x times or more against the y of least loss.

    Two passes of partial aggregates over the ranked items; the thresholds are a small fixed
    range. Raises where no loss is valid. delta_j is the change from the last x with items.
    """
    good = items.where(valid_loss(F.col(loss)))
    xs = range(x_min, x_max + 1)
    sizes = good.agg(*[F.count_if(F.col(k) >= x).alias(f"y{x}") for x in xs], F.count("*").alias("n")).first()
    if not sizes["n"]:
        raise ValueError(f"no valid {loss}")
    ranked = global_rank(good, loss, [qid], "_rank", start=1)
    both = ranked.agg(*[F.count_if((F.col(k) >= x) & (F.col("_rank") <= sizes[f"y{x}"])).alias(f"i{x}") for x in xs])
    row = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(sizes[f"y{x}"]).cast("long").alias("y"), F.col(f"i{x}").alias("i")) for x in xs])
    flat = both.select(F.explode(row).alias("r")).select("r.*")
    jaccard = F.when(F.col("y") == 0, 0.0).otherwise(F.col("i").cast("double") / (2 * F.col("y") - F.col("i")))
    curve = flat.withColumn("jaccard", jaccard)
    before = F.last(F.when(F.col("y") > 0, F.col("jaccard")), ignorenulls=True).over(Window.orderBy("x").rowsBetween(Window.unboundedPreceding, -1))  # one row per threshold
    delta = F.when(F.col("y") == 0, 0.0).otherwise(F.coalesce(F.col("jaccard") - before, F.lit(0.0)))
    return curve.select("x", "y", "jaccard", delta.alias("delta_j"), F.when(F.col("y") == 0, 0.0).otherwise(F.col("i").cast("double") / F.col("y")).alias("overlap"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """One row: the x from 2 on with the largest delta_j, the first on ties, 0 if there is none."""
    best = F.max_by("x", F.struct("delta_j", -F.col("x")))
    return curve.where("x >= 2").agg(F.coalesce(best, F.lit(0)).alias("best_x"))


def stratified_sample(df: DataFrame, stratum: str, strata: list, n: int, key: Column, id_col: str) -> DataFrame:
    """Exactly n rows of each stratum, by the order of ``key``; raises where one has fewer."""
    counts = {r[0]: r[1] for r in df.where(F.col(stratum).isin(strata)).groupBy(stratum).count().collect()}
    short = [s for s in strata if counts.get(s, 0) < n]
    if short:
        raise ValueError(f"{stratum} {short[0]} has {counts.get(short[0], 0)} rows, {n} are needed")
    order = Window.partitionBy(stratum).orderBy(key, id_col)
    return df.where(F.col(stratum).isin(strata)).withColumn("pick", F.row_number().over(order)).where(F.col("pick") <= n)


def min_k_loss(nll: Column, fraction: float = 0.2) -> Column:
    """Mean of the largest fraction of losses, one at least; null for none."""
    kept = F.filter(nll, lambda x: x.isNotNull())
    count = F.greatest(F.lit(1), F.floor(F.size(kept) * F.lit(fraction)).cast("int"))
    top = F.slice(F.sort_array(kept, asc=False), F.lit(1), count)
    return F.when(F.size(kept) > 0, F.aggregate(top, F.lit(0.0), lambda a, x: a + x) / count)


def mean_loss(nll: Column) -> Column:
    kept = F.filter(nll, lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, F.aggregate(kept, F.lit(0.0), lambda a, x: a + x) / F.size(kept))


def min_k_confidence(nll: Column, offsets: Column, answer_at: Column, fraction: float = 0.2) -> Column:
    """Negative Min-K loss of the tokens that start in the answer; -999 for none."""
    own = F.filter(F.arrays_zip(nll.alias("l"), offsets.alias("o")), lambda t: t["o"] >= answer_at)
    return F.coalesce(-min_k_loss(F.transform(own, lambda t: t["l"]), fraction), F.lit(-999.0))
