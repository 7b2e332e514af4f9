"""Coverage cohorts and the cohort waterfall.

The waterfall places every eligible entity in exactly one cohort, trying
them in a fixed order.  A cohort (months m, newest N, target t) holds an
entity when the newest N of its m-month statements sum to t months.  Since
every such statement counts m months, that is ``m * least(N, n_m) == t``
where ``n_m`` is the entity's number of m-month statements, so the whole
waterfall is one CASE ladder over three per-entity counts, computed in one
pass over rows that are already partitioned by entity.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finwater.operators.ranking import KEY_TIES, key_order, newest_first
from finwater.schema import COHORT_COLUMNS

# --- fixed values: the cohort waterfall, in placement order ---
# (tag, statement months, newest N taken, months the N must cover)
WATERFALL = [
    ("A", 12, 2, 24),
    ("B", 1, 24, 24),
    ("D", 1, 12, 12),
    ("C", 12, 1, 12),
    ("F", 3, 8, 24),
    ("G", 3, 4, 12),
]
# --- fixed values: tag of entities no cohort holds ---
RESIDUAL = "R"
# --- fixed values: cohorts whose rank is forced to 1 ---
SINGLE_STATEMENT = {"C"}

COHORT_BY_TAG = {tag: (m, n, t) for tag, m, n, t in WATERFALL}


def _count_col(m: int) -> str:
    return f"_n{m}"


def coverage_filter(df: DataFrame, months: int, n: int, target: int, tag: str | None = None) -> DataFrame:
    """Stand-alone coverage test for one statement kind (no work list).

    Rows of ``months``-month statements, ranked newest first per entity, the
    newest ``n`` kept, and only entities whose kept months sum to ``target``.
    """
    w_rank = Window.partitionBy("entityid").orderBy(*key_order(df))
    kept = (
        df.filter(F.col("statementmonths") == months)
        .withColumn("ranked_order", F.dense_rank().over(w_rank).cast("bigint"))
        .filter(F.col("ranked_order") <= n)
    )
    # each kept statement counts ``months``, however many measure rows it has
    covered = kept.withColumn(
        "_cover", F.max("ranked_order").over(Window.partitionBy("entityid")) * F.lit(months)
    ).filter(F.col("_cover") == target)
    out = covered.drop("_cover")
    if tag is not None:
        out = out.withColumn("CF_Type", F.lit(tag))
    return out


def assign_cohorts(dd: DataFrame, include_residual: bool = True, partitioned: bool = False) -> DataFrame:
    """Tag each deduplicated statement with its entity's cohort and rank.

    Returns the statements each cohort keeps (``CF_Type``, ``ranked_order``);
    residual entities keep every statement ranked over all months.

    One exchange on ``entityid`` serves every window here and the later
    per-entity sums.  Input rows per entity are bounded after dedup (at most
    one per statement date and type), so no group grows with the data.
    """
    if not partitioned:
        dd = dd.repartition("entityid")
    w_entity = Window.partitionBy("entityid")
    kinds = sorted({m for _, m, _, _ in WATERFALL})
    # One sort serves every window: rank within the entity by (months, newest
    # first); the other windows need only a prefix of that order.  The rank
    # within a statement kind is the position inside its block of months.
    # Ranks are dense over distinct key rows, so a statement with several
    # measure rows is ranked and counted once.
    ties = [F.col(c) for c in KEY_TIES if c in dd.columns and c != "statementmonths"]
    by_kind = Window.partitionBy("entityid").orderBy(F.col("statementmonths"), *newest_first(), *ties)
    dd = dd.withColumn("_rn_e", F.dense_rank().over(by_kind))
    dd = dd.withColumn("_start", F.min("_rn_e").over(Window.partitionBy("entityid", "statementmonths")))
    dd = dd.withColumn("_rn_kind", F.col("_rn_e") - F.col("_start") + 1)
    dd = dd.withColumns({
        _count_col(m): F.coalesce(F.max(F.when(F.col("statementmonths") == m, F.col("_rn_kind"))).over(w_entity), F.lit(0))
        for m in kinds
    })
    if include_residual:
        dd = dd.withColumn("_rn_all", F.dense_rank().over(Window.partitionBy("entityid").orderBy(*key_order(dd))))

    ladder: Column | None = None
    for tag, m, n, t in WATERFALL:
        cond = F.lit(m) * F.least(F.lit(n), F.col(_count_col(m))) == F.lit(t)
        ladder = F.when(cond, F.lit(tag)) if ladder is None else ladder.when(cond, F.lit(tag))
    dd = dd.withColumn("CF_Type", ladder.otherwise(F.lit(RESIDUAL)))

    keep = reduce(
        lambda a, b: a | b,
        [
            (F.col("CF_Type") == tag) & (F.col("statementmonths") == m) & (F.col("_rn_kind") <= n)
            for tag, m, n, _ in WATERFALL
        ],
    )
    rank = F.col("_rn_kind")
    for tag in SINGLE_STATEMENT:
        rank = F.when(F.col("CF_Type") == tag, F.lit(1)).otherwise(rank)
    if include_residual:
        keep = keep | (F.col("CF_Type") == RESIDUAL)
        rank = F.when(F.col("CF_Type") == RESIDUAL, F.col("_rn_all")).otherwise(rank)
    out = dd.filter(keep).withColumn("ranked_order", rank.cast("bigint"))
    return out.drop(*[_count_col(m) for m in kinds], "_rn_e", "_start", "_rn_kind", "_rn_all")


def cohort_rows(tagged: DataFrame, tag: str | None = None) -> DataFrame:
    """The cohort table layout (8 columns), optionally one cohort only, as
    DISTINCT rows (the union of the cohorts removes repeats)."""
    if tag is not None:
        tagged = tagged.filter(F.col("CF_Type") == tag)
    return tagged.select(
        "entityid",
        "pkid_",
        "statementdatekey_",
        F.col("statementdatekey_").cast("date").alias("statment_date"),
        "statementtype",
        "statementmonths",
        "ranked_order",
        "CF_Type",
    ).select(*COHORT_COLUMNS).distinct()


def entity_cohorts(tagged: DataFrame) -> DataFrame:
    """One row per eligible entity with the cohort that holds it."""
    return tagged.select("entityid", "CF_Type").distinct()


def cohort_chain(dd: DataFrame, worklist: DataFrame, cut_lineage=None) -> DataFrame:
    """The waterfall stated literally: a shrinking work list of entities.

    Each cohort ranks the m-month statements of entities still on the list,
    keeps the newest N, takes entities whose kept months reach the target
    and removes them from the list; the single-annual cohort matches on the
    statement key alone (so a colliding key of another listed entity is
    taken along, as in the source batch).  ``cut_lineage`` (for example
    ``lambda df: df.checkpoint()``) is applied to each work list, otherwise
    every stage would re-plan all earlier ones.
    """
    cut = cut_lineage or (lambda df: df)
    order = Window.partitionBy("entityid").orderBy(*key_order(dd))
    wl = cut(worklist.select("entityid").distinct())
    parts = []
    for tag, m, n, t in WATERFALL:
        src = dd.join(wl, "entityid", "left_semi")
        if tag in SINGLE_STATEMENT:
            keys = (
                src.filter(F.col("statementmonths") == m)
                .groupBy("entityid", "pkid_")
                .agg(F.sum("statementmonths").alias("_months"))
                .filter(F.col("_months") == t)
                .select("pkid_")
                .distinct()
            )
            got = src.join(keys, "pkid_", "left_semi").withColumn("ranked_order", F.lit(1).cast("bigint"))
            leaving = got.select("entityid").distinct()
        else:
            ranked = src.filter(F.col("statementmonths") == m).withColumn(
                "ranked_order", F.row_number().over(order).cast("bigint")
            )
            kept = ranked.filter(F.col("ranked_order") <= n)
            covered = kept.groupBy("entityid").agg(F.sum("statementmonths").alias("_months")).filter(
                F.col("_months") == t
            )
            got = kept.join(covered.select("entityid"), "entityid", "left_semi")
            leaving = got.groupBy("entityid").count().filter(F.col("count") > 1).select("entityid")
        parts.append(got.withColumn("CF_Type", F.lit(tag)))
        wl = cut(wl.join(leaving, "entityid", "left_anti"))
    residual = (
        dd.join(wl, "entityid", "left_semi")
        .withColumn("ranked_order", F.row_number().over(order).cast("bigint"))
        .withColumn("CF_Type", F.lit(RESIDUAL))
    )
    parts.append(residual)
    return reduce(lambda a, b: a.unionByName(b), parts)


def _ladder(stages):
    expr = None
    for tag, m, n, t in stages:
        cond = F.lit(m) * F.least(F.lit(n), F.col(_count_col(m))) == F.lit(t)
        expr = F.when(cond, F.lit(tag)) if expr is None else expr.when(cond, F.lit(tag))
    return expr


def _kept(stages):
    return reduce(
        lambda a, b: a | b,
        [(F.col("CF_Type") == tag) & (F.col("statementmonths") == m) & (F.col("_rn_kind") <= n) for tag, m, n, _ in stages],
    )


_SPLIT = next(i for i, (tag, *_rest) in enumerate(WATERFALL) if tag in SINGLE_STATEMENT)
_BEFORE, _SINGLE, _AFTER = WATERFALL[:_SPLIT], WATERFALL[_SPLIT], WATERFALL[_SPLIT + 1 :]
_KINDS = sorted({m for _, m, _, _ in WATERFALL})


def entity_stage(dd: DataFrame) -> DataFrame:
    """Rows hashed by entity, with the entity's counts, the ranks, the cohorts
    decided before the single-statement one (``_early``) and whether the row
    is the lone single-kind row of its key (``_lone``)."""
    w_entity = Window.partitionBy("entityid")
    # counts and the rank within a statement kind share one (entity; months,
    # newest first) order; the residual rank needs its own
    ties = [F.col(c) for c in KEY_TIES if c in dd.columns and c != "statementmonths"]
    by_kind = Window.partitionBy("entityid").orderBy(F.col("statementmonths"), *newest_first(), *ties)
    staged = dd.repartition("entityid").distinct().withColumn("_rn_e", F.row_number().over(by_kind))
    cols = {_count_col(m): F.sum((F.col("statementmonths") == m).cast("int")).over(w_entity) for m in _KINDS}
    cols["_start"] = F.min("_rn_e").over(Window.partitionBy("entityid", "statementmonths"))
    staged = staged.withColumns(cols).withColumn("_rn_kind", F.col("_rn_e") - F.col("_start") + 1)
    staged = staged.withColumn("_rn_all", F.row_number().over(Window.partitionBy("entityid").orderBy(*key_order(dd))))
    staged = staged.withColumn("_early", _ladder(_BEFORE))
    tag, m, _, t = _SINGLE
    same_key = F.sum((F.col("statementmonths") == m).cast("int")).over(Window.partitionBy("entityid", "pkid_"))
    lone = F.col("_early").isNull() & (F.col("statementmonths") == m) & (F.lit(m) * F.col("_same_key") == F.lit(t))
    return staged.withColumn("_same_key", same_key).withColumn("_lone", lone.cast("int"))


def place_by_key(staged: DataFrame, cross_keys: DataFrame | None = None) -> DataFrame:
    """Tags and ranks from ``entity_stage`` rows, on their own partitioning.

    A row is hit when its key holds a lone single-kind row of an open entity:
    of its own entity (a window), or of another one, whose keys come in
    ``cross_keys`` (a small table ``pkid_``, broadcast by the caller)."""
    own = F.max("_lone").over(Window.partitionBy("entityid", "pkid_")) == 1
    if cross_keys is None:
        staged = staged.withColumn("_own", own).withColumn("_cross", F.lit(False))
    else:
        keys = cross_keys.select(F.col("pkid_").alias("_ck"))
        staged = staged.withColumn("_own", own).join(keys, F.col("pkid_") == F.col("_ck"), "left")
        staged = staged.withColumn("_cross", F.col("_ck").isNotNull()).drop("_ck")
    staged = staged.withColumn("_hit", F.col("_early").isNull() & (F.col("_own") | F.col("_cross")))
    staged = staged.withColumn("_single", F.max(F.col("_hit").cast("int")).over(Window.partitionBy("entityid")) == 1)
    single_tag = _SINGLE[0]
    tag = (
        F.when(F.col("_early").isNotNull(), F.col("_early"))
        .when(F.col("_single"), F.lit(single_tag))
        .otherwise(_ladder(_AFTER).otherwise(F.lit(RESIDUAL)))
    )
    tagged = staged.withColumn("CF_Type", tag)
    keep = (
        (F.col("_early").isNotNull() & _kept(_BEFORE))
        | ((F.col("CF_Type") == single_tag) & F.col("_hit"))
        | (F.col("_early").isNull() & ~F.col("_single") & (_kept(_AFTER) | (F.col("CF_Type") == RESIDUAL)))
    )
    rank = (
        F.when(F.col("CF_Type") == single_tag, F.lit(1))
        .when(F.col("CF_Type") == RESIDUAL, F.col("_rn_all"))
        .otherwise(F.col("_rn_kind"))
    )
    out = tagged.filter(keep).withColumn("ranked_order", rank.cast("bigint"))
    return out.drop(
        *[_count_col(m) for m in _KINDS],
        "_rn_e", "_start", "_rn_kind", "_rn_all", "_same_key", "_lone", "_early", "_own", "_cross", "_hit", "_single",
    )


def assign_cohorts_by_key(dd: DataFrame) -> DataFrame:
    """The waterfall with the source batch's key-only single-annual step.

    Equal to ``cohort_chain`` row for row, without its stage-by-stage work
    list: cohorts before the single-annual one are decided by per-entity
    counts; that cohort takes, among entities still open, every row whose key
    text is the key of a lone 12-month statement of *any* open entity (so a
    colliding key carries another entity along); later cohorts are decided
    by counts again.  This form hashes all rows by key text in between; the
    all-snapshots plan corrects only the keys that collide instead.
    """
    staged = entity_stage(dd).repartition("pkid_")
    cross = F.max("_lone").over(Window.partitionBy("pkid_")) == 1
    staged = staged.withColumn("_crossed", cross).repartition("entityid")
    staged = staged.withColumn("_lone", F.when(F.col("_crossed"), F.lit(1)).otherwise(F.col("_lone"))).drop("_crossed")
    return place_by_key(staged)
