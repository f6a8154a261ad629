"""k-means over integer 2-d points with truncating integer means, and the
per-cluster statistics.

Before the rounds, equal points are collapsed to `x, y, w` (w = how many)
with a partial + final count: points are (tag coordinate, score) pairs, so
there are far fewer distinct points than points, and weighted sums give the
very same integer means, counts and medians. The weighted points are kept
(persisted, and checkpointed when the session names a checkpoint folder).

Plan per round: the k centres travel as one literal array inside the
expression, so assigning a point is a projection with no join; the means are
a partial + final weighted `sum` per cluster, so every task shuffles at most k
rows whatever the cluster sizes; only k rows come back to the driver. The plan
shape is the same every round, only the literal changes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.numeric import sq_distance, trunc_div
from quarry.functions.report import REPORT_HEADER, report_line
from quarry.operators.sampling import seed_centres
from quarry.params import KMeansParams, Vocabulary
from quarry.session import keep, local_table, reread

Centres = list[tuple[int, int]]

def nearest(centres: Sequence[tuple[int, int]], x: str = "x", y: str = "y") -> Column:
    """Index of the centre with the least squared distance; the lowest index
    wins a tie (the first position of the least entry). An array of the k
    squared distances, compiled with the projection; built as one expression
    string: one call to the JVM per round instead of one per literal.

    The array is never empty, so the index is never null; `coalesce` with an
    index that cannot occur says so to the optimizer, which otherwise infers
    `isnotnull(k)` from a later join on `k` and pushes it down as a filter that
    evaluates this expression a second time for every point."""
    if not centres:
        raise ValueError("no centres")

    def sq(v: str, c: int) -> str:
        return f"(`{v}` - {int(c)}L) * (`{v}` - {int(c)}L)"

    d = "array(" + ", ".join(f"{sq(x, cx)} + {sq(y, cy)}" for cx, cy in centres) + ")"
    return F.expr(f"coalesce(cast(array_position({d}, array_min({d})) - 1 as int), -1)")


SEARCH_CENTRES = 64       # more centres are searched by bisection
LINES_MAX = 10_000        # lines (tag coordinates) for which a search table is made


def line_table(centres: Sequence[tuple[int, int]], x: int) -> list[tuple[int | None, int]]:
    """For points on the line of one x: `(from, index)` in order of y; a centre is
    the nearest from its `from` (the first: None) up to the next one's. Exact in
    whole numbers, the lowest index first on a tie.

    On a line the squared distance is y * y - 2 * cy * y + (cy * cy + (x - cx) ** 2):
    without the y * y that all have, a straight line in y for every centre, and
    the nearest one is the lower envelope of these."""
    best: dict[int, tuple[int, int]] = {}
    for i, (cx, cy) in enumerate(centres):
        rest = (cy * cy + (x - cx) ** 2, i)
        best[cy] = min(best.get(cy, rest), rest)
    table: list[tuple[int | None, int, int, int]] = []        # from, index, cy, rest
    for cy in sorted(best):
        rest, i = best[cy]
        start: int | None = None
        while table:
            begin, j, cy0, rest0 = table[-1]
            # first y where this centre is preferred to the last one of the table
            gain, per = rest - rest0, 2 * (cy - cy0)
            start = -(-gain // per)
            if gain % per == 0 and i > j:
                start += 1
            if begin is None or start > begin:
                break
            table.pop()
            start = None
        table.append((start, i, cy, rest))
    return [(begin, i) for begin, i, _, _ in table]


def nearest_on_lines(centres: Sequence[tuple[int, int]], lines: Sequence[int], x: str = "x", y: str = "y") -> Column:
    """`nearest` for points that lie on known lines of x (the tag coordinates): a
    bisection in the line's table, so a point meets some log2(k) of the k
    centres. -1 for a point on no such line."""
    starts: list[int] = []
    index: list[int] = []
    bounds = [0]
    for line in lines:
        for begin, i in line_table(centres, line):
            starts.append(-(1 << 63) if begin is None else max(-(1 << 63), min(begin, (1 << 63) - 1)))
            index.append(i)
        bounds.append(len(index))
    longest = max(b - a for a, b in zip(bounds, bounds[1:]))
    steps = [1 << p for p in reversed(range(max(1, longest.bit_length())))]

    def array(values: Sequence[int], typ: str) -> str:
        # one text literal, taken apart once when the plan is made
        return f"from_json('[{','.join(map(str, values))}]', 'array<{typ}>')"

    line = f"array_position({array(lines, 'bigint')}, `{x}`)"
    found = (f"aggregate({array(steps, 'int')}, get({array(bounds, 'int')}, cast({line} AS int) - 1), "
             f"(p, s) -> if(p + s < get({array(bounds, 'int')}, cast({line} AS int)) "
             f"AND get({array(starts, 'bigint')}, p + s) <= `{y}`, p + s, p))")
    return F.expr(f"if({line} > 0, coalesce(get({array(index, 'int')}, {found}), -1), -1)")


def tag_lines(points: DataFrame) -> list[int] | None:
    """The distinct x of the points, where there are up to `LINES_MAX` of them."""
    rows = points.select("x").distinct().limit(LINES_MAX + 1).collect()
    return sorted(r["x"] for r in rows) if 0 < len(rows) <= LINES_MAX else None


def assign(vectors: DataFrame, centres: Sequence[tuple[int, int]], lines: Sequence[int] | None = None) -> DataFrame:
    """Adds `k`, the nearest centre, to every point. With `lines`, every x that
    occurs, the centre is searched there by bisection."""
    return vectors.withColumn("k", nearest_on_lines(centres, lines) if lines else nearest(centres))


def _weight(weight: str | None) -> Column:
    return F.col(weight) if weight else F.lit(1).cast("bigint")


def weighted_points(vectors: DataFrame) -> DataFrame:
    """`x, y, w`: the distinct points and how many times each occurs."""
    return vectors.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))


def centre_means(assigned: DataFrame, weight: str | None = None) -> DataFrame:
    """`k, cx, cy, n` for clusters with points: bigint sums, divided with
    truncation toward zero. Empty clusters are absent. With `weight`, each
    row stands for that many equal points."""
    w = _weight(weight)
    return (assigned.groupBy("k")
            .agg(F.sum(F.col("x") * w).alias("_sx"), F.sum(F.col("y") * w).alias("_sy"),
                 F.sum(w).alias("n"))
            .select("k", trunc_div("_sx", "n").alias("cx"), trunc_div("_sy", "n").alias("cy"), "n"))


def centres_frame(spark: SparkSession, centres: Sequence[tuple[int, int]]) -> DataFrame:
    """`k int, cx bigint, cy bigint` from a driver list (k rows, k is a
    parameter), as a local table."""
    return local_table(spark, {"k": "int", "cx": "bigint", "cy": "bigint"},
                       [(i, int(cx), int(cy)) for i, (cx, cy) in enumerate(centres)])


def step_frame(vectors: DataFrame, centres: Sequence[tuple[int, int]],
               weight: str | None = None) -> DataFrame:
    """One round as a DataFrame: `k, cx, cy`, the new mean of every cluster,
    or its old centre when it got no point."""
    old = centres_frame(vectors.sparkSession, centres)
    new = (centre_means(assign(vectors, centres), weight)
           .select("k", F.col("cx").alias("_nx"), F.col("cy").alias("_ny")))
    # `new` has at most one row per centre index: k rows, k is a parameter.
    return (old.join(F.broadcast(new), "k", "left")
            .select("k", F.coalesce("_nx", "cx").alias("cx"), F.coalesce("_ny", "cy").alias("cy")))


def movement_frame(old: DataFrame, new: DataFrame) -> DataFrame:
    """`movement`: summed squared distance between matching centres (both
    frames hold one row per centre index, k rows)."""
    n = new.select("k", F.col("cx").alias("_nx"), F.col("cy").alias("_ny"))
    return (old.join(F.broadcast(n), "k", "inner")
            .agg(F.sum(sq_distance("cx", "cy", "_nx", "_ny")).cast("bigint").alias("movement")))


def movement(old: Sequence[tuple[int, int]], new: Sequence[tuple[int, int]]) -> int:
    """Summed squared distance between matching centres (exact integers)."""
    if len(old) != len(new):
        raise ValueError("centre lists differ in length")
    return sum((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 for a, b in zip(old, new))


def step(points: DataFrame, centres: Centres, weight: str | None = None,
         lines: Sequence[int] | None = None) -> Centres:
    """One round on the driver's k centres; k rows come back."""
    cols = ["x", "y"] + ([weight] if weight else [])
    rows = centre_means(assign(points.select(*cols), centres, lines), weight).collect()
    found = {r["k"]: (r["cx"], r["cy"]) for r in rows}
    return [found.get(i, c) for i, c in enumerate(centres)]


@dataclass
class KMeansResult:
    centres: Centres
    history: list[tuple[int, int]] = field(default_factory=list)   # (round, movement)
    converged: bool = False

    def centres_df(self, spark: SparkSession) -> DataFrame:
        return centres_frame(spark, self.centres)

    def history_df(self, spark: SparkSession) -> DataFrame:
        return local_table(spark, {"iter": "int", "movement": "bigint"}, list(self.history))


@contextmanager
def kept_points(vectors: DataFrame, *, checkpoint: bool = True) -> Iterator[DataFrame]:
    """The weighted points every round reads (`x, y, w`), kept once and
    released on exit. They stay partitioned: each round is a partial + final
    aggregate that shuffles at most k rows per task."""
    kept = keep(weighted_points(vectors), reliable=checkpoint)
    try:
        yield kept
    finally:
        kept.unpersist()


def kmeans(vectors: DataFrame, initial: Centres, params: KMeansParams, *,
           checkpoint: bool = True, resume: str | None = None) -> KMeansResult:
    """Rounds of assign -> mean -> keep old centre if empty -> movement, until
    the movement is below eta or max_iter rounds ran; the new centres of the
    last round are returned either way. With `resume`, a folder that outlives
    the session, every round is written there, and a fit that was stopped goes
    on after its last whole round (see `RoundLog`)."""
    with kept_points(vectors, checkpoint=checkpoint) as points:
        return _iterate(points, initial, params, resume)


class RoundLog:
    """The rounds of a fit in a folder: round 0 holds the initial centres, every
    later one the centres and the movement after it. A round counts once Spark
    has committed it. A folder of another fit (other initial centres or other
    parameters that the rounds depend on) is refused."""

    COLUMNS = {"k": "int", "cx": "bigint", "cy": "bigint", "movement": "decimal(38,0)"}

    def __init__(self, spark: SparkSession, folder: str, initial: Centres, params: KMeansParams):
        self.spark, self.folder = spark, f"{folder.rstrip('/')}/k{params.k}-spread{params.spread}"
        first = self.read(0)
        if first is None:
            self.write(0, list(initial), 0)
        elif first[0] != list(initial):
            raise ValueError(f"{folder} holds the rounds of a fit with other initial centres")

    def _path(self, it: int) -> str:
        return f"{self.folder}/round-{it:06d}"

    def read(self, it: int) -> tuple[Centres, int] | None:
        """Centres and movement of a round; None when it is not there."""
        done = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self._path(it)}/_SUCCESS")
        if not done.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
            return None
        rows = self.spark.read.schema(", ".join(f"{c} {t}" for c, t in self.COLUMNS.items())).parquet(self._path(it)).collect()
        by_k = {r["k"]: r for r in rows}     # k rows, k is a parameter
        return [(by_k[i]["cx"], by_k[i]["cy"]) for i in range(len(by_k))], int(rows[0]["movement"])

    def write(self, it: int, centres: Centres, moved: int) -> None:
        rows = [(i, int(cx), int(cy), moved) for i, (cx, cy) in enumerate(centres)]
        local_table(self.spark, self.COLUMNS, rows).coalesce(1).write.mode("overwrite").parquet(self._path(it))


def _iterate(points: DataFrame, initial: Centres, params: KMeansParams, resume: str | None = None) -> KMeansResult:
    """The rounds over kept weighted points `x, y, w`."""
    if len(initial) != params.k:
        raise ValueError(f"{len(initial)} initial centres for k={params.k}")
    log = RoundLog(points.sparkSession, resume, initial, params) if resume else None
    result = KMeansResult(centres=list(initial))
    lines = tag_lines(points) if params.k > SEARCH_CENTRES else None
    for it in range(1, params.max_iter + 1):
        known = log.read(it) if log else None
        if known:
            new, moved = known
        else:
            new = step(points, result.centres, "w", lines)
            moved = movement(result.centres, new)
            if log:
                log.write(it, new, moved)
        result.history.append((it, moved))
        result.centres = new
        if moved < params.eta:
            result.converged = True
            break
    return result


MEDIAN_RANGES = 1 << 16     # ranges into which a cluster's scores are counted in a round


def medians(counts: DataFrame, ranges: int = MEDIAN_RANGES) -> DataFrame:
    """`k, median` of `k, y, n` (see `_medians`)."""
    return local_table(counts.sparkSession, {"k": "int", "median": "bigint"}, sorted(_medians(counts, ranges).items()))


def _medians(counts: DataFrame, ranges: int = MEDIAN_RANGES) -> dict[int, int]:
    """The median (truncated toward zero) of every cluster of `k, y, n`: score y
    occurs n times in cluster k. Exact, by distributed selection.

    The scores between a cluster's least and greatest are counted in at most
    `ranges` ranges of equal width (partial + final sums); running counts over
    a cluster's ranges tell which one holds a middle rank. A round later the
    scores of that range alone are counted, in ranges of their own, until it
    holds one score: after one round when the scores span under `ranges`, after
    four whatever they are. No task holds more of a cluster than
    its ranges; per round two rows for each cluster come to the driver."""
    spark = counts.sparkSession
    sized = counts.groupBy("k").agg(F.sum("n").alias("n"), F.min("y").alias("lo"), F.max("y").alias("hi")).collect()
    # (cluster, which middle) -> least and greatest score left, rank among them
    left = {(r["k"], m): (r["lo"], r["hi"], (r["n"] - 1 + m) // 2) for r in sized for m in (0, 1)}
    found: dict[tuple[int, int], int] = {}
    while left:
        found |= {t: lo for t, (lo, hi, _) in left.items() if lo == hi}
        left = {t: v for t, v in left.items() if t not in found}
        if not left:
            break
        targets = local_table(spark, {"k": "int", "m": "int", "lo": "bigint", "hi": "bigint", "width": "decimal(20,0)", "rank": "bigint"},
                              [(k, m, lo, hi, -(-(hi - lo + 1) // ranges), rank) for (k, m), (lo, hi, rank) in left.items()])
        # two rows for each cluster: k is a parameter
        inside = counts.join(F.broadcast(targets), "k").where("y BETWEEN lo AND hi")
        place = F.expr("(cast(y AS decimal(20,0)) - cast(lo AS decimal(20,0))) div width").cast("bigint")
        per_range = (inside.groupBy("k", "m", "rank", place.alias("place"))
                     .agg(F.sum("n").alias("n"), F.min("y").alias("lo"), F.max("y").alias("hi")))
        running = F.sum("n").over(Window.partitionBy("k", "m").orderBy("place"))
        holds = per_range.withColumn("upto", running).where("upto - n <= rank AND rank < upto")
        left = {(r["k"], r["m"]): (r["lo"], r["hi"], r["rank"] - (r["upto"] - r["n"])) for r in holds.collect()}
    middle = {k: found[k, 0] + found[k, 1] for k, _ in found}
    return {k: (abs(v) // 2) * (1 if v >= 0 else -1) for k, v in middle.items()}


def cluster_stats(vectors: DataFrame, centres: Centres, tags: Vocabulary, spread: int,
                  weight: str | None = None) -> DataFrame:
    """`k, tag, pct, size, median_score` per non-empty cluster, by median.

    The points are reduced to counts per (cluster, tag coordinate, score) with
    a partial + final count. From those, the counts per (cluster, tag) give the
    dominant tag (most points, lowest coordinate on a tie), its share and the
    size; `medians` gives the exact median (mean of the two middle scores when
    the size is even, truncated toward zero). The medians are found when
    this is called, the rest when the frame is used."""
    lines = tag_lines(vectors) if len(centres) > SEARCH_CENTRES else None
    counts = (assign(vectors, centres, lines).groupBy("k", "x", "y")
              .agg(F.sum(_weight(weight)).alias("n")))
    per_cluster = counts.groupBy("k", "x").agg(F.sum("n").alias("n_tag")).groupBy("k").agg(
        F.max_by("x", F.struct(F.col("n_tag"), -F.col("x"))).alias("x"),
        F.max("n_tag").alias("top"),
        F.sum("n_tag").alias("size"),
    )
    middle = _medians(counts.groupBy("k", "y").agg(F.sum("n").alias("n")))
    # one entry for each cluster: k is a parameter
    listed = "[" + ", ".join(str(middle.get(i, "null")) for i in range(len(centres))) + "]"
    median = F.get(F.from_json(F.lit(listed), "array<bigint>"), F.col("k"))
    return (per_cluster
            .select(
                "k",
                tags.label(trunc_div("x", F.lit(spread))).alias("tag"),
                trunc_div(F.col("top") * F.lit(100), "size").cast("double").alias("pct"),
                F.col("size").cast("bigint").alias("size"),
                median.alias("median_score"),
            )
            .orderBy("median_score", "k"))


def fit(vectors: DataFrame, params: KMeansParams, n_tags: int, *, resume: str | None = None) -> KMeansResult:
    """Seeds and rounds from one kept copy of the vectors."""
    kept = keep(vectors.select("id", "x", "y"), reliable=False)
    try:
        return kmeans(kept, seed_centres(kept, params, n_tags), params, resume=resume)
    finally:
        kept.unpersist()


def seeded_points(vectors: DataFrame, params: KMeansParams, n_tags: int) -> tuple[DataFrame, Centres]:
    """The seed centres and the weighted points `x, y, w`, both from one kept
    copy of the vectors. With a checkpoint folder the points are checkpointed
    there, so a frame built on them reads the checkpoint instead of computing
    the vectors again; without one they are recomputed from lineage."""
    kept = keep(vectors.select("id", "x", "y"), reliable=False)
    try:
        seeds = seed_centres(kept, params, n_tags)
        return reread(weighted_points(kept)), seeds
    finally:
        kept.unpersist()


def fitted_stats(vectors: DataFrame, params: KMeansParams, tags: Vocabulary, *,
                 checkpoint: bool = True) -> DataFrame:
    """Seeds and rounds as in `run_clustering`, returning the statistics
    frame over the weighted points the rounds read. With a checkpoint folder
    the frame reads those points from their checkpoint when consumed, so the
    input (and its join) is not computed a second time; without one it is
    recomputed from lineage."""
    kept = keep(vectors.select("id", "x", "y"), reliable=False)
    with kept_points(kept, checkpoint=checkpoint) as points:
        try:
            seeds = seed_centres(kept, params, len(tags))
        finally:
            kept.unpersist()
        fit = _iterate(points, seeds, params)
        return cluster_stats(points, fit.centres, tags, params.spread, weight="w")


@dataclass
class ClusterRun:
    fit: KMeansResult
    stats: list          # rows of `cluster_stats`, ordered by median
    report: list[str]    # header lines, then one line per cluster


def run_clustering(vectors: DataFrame, params: KMeansParams, tags: Vocabulary, *,
                   checkpoint: bool = True) -> ClusterRun:
    """The whole clustering program: keep the vectors while the seeds are
    drawn and the points are collapsed, then iterate on the kept weighted
    points and take the per-cluster statistics and report lines from them (k
    rows each, k is a parameter)."""
    kept = keep(vectors.select("id", "x", "y"), reliable=False)
    with kept_points(kept, checkpoint=checkpoint) as points:
        try:
            seeds = seed_centres(kept, params, len(tags))
        finally:
            kept.unpersist()        # the weighted points are materialized already
        fit = _iterate(points, seeds, params)
        stats = cluster_stats(points, fit.centres, tags, params.spread, weight="w")
        rows = stats.withColumn("line", report_line()).collect()   # k rows, by median
        return ClusterRun(fit=fit, stats=[r.asDict() for r in rows],
                          report=list(REPORT_HEADER) + [r["line"] for r in rows])


def cluster_report(stats: DataFrame) -> DataFrame:
    """`k, line`: the fixed-width report line of every cluster."""
    return stats.select("k", report_line().alias("line"))
