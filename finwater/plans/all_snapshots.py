"""Reference-faithful client financials: lookups into every snapshot.

The source batch selects statements in the newest snapshot but looks them
up by text key (``entityid || statementid``, no separator) in the whole
history, once for the snapshot dates and once for the measures, and then
keeps DISTINCT rows.  So a statement present in S snapshots with K distinct
metric rows weighs S x K.  Here that product is not materialised: the slice
rows are joined to the history once on the key, the distinct snapshot dates
of each slice row are counted with a window on the join's partitioning, the
metric rows are de-duplicated there, and the count becomes a weight of the
sums.  The selection has the key-set dedup and the key-only single-annual
step, so key collisions behave as in the source; only keys that do collide
leave the per-entity path.  ``literal_chain=True`` runs the stage-by-stage
work-list chain instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finwater.functions import key_concat
from finwater.operators.cohorts import assign_cohorts_by_key, cohort_chain, entity_stage, place_by_key
from finwater.operators.eligibility import DEDUP_KEYS, dedup_statements_by_key_set, eligible
from finwater.operators.key_filter import key_filter, passing, size_for
from finwater.operators.metrics import metric_columns
from finwater.operators.periods import assign_period
from finwater.operators.snapshot import latest_snapshot
from finwater.operators.totals import period_totals
from finwater.schema import KEY_COLUMNS, MEASURES
from finwater.session import ensure_checkpoint_dir

SLICE_KEYS = ["TimeFrame", "entityid", "statementdatekey_", "statementmonths", "pkid_", "CF_Type"]


def reliable_cut(df: DataFrame) -> DataFrame:
    """Cut lineage into the session's shared checkpoint folder (survives
    executor loss, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Key texts (and their groups and entities) up to which corrections are
#: broadcast; about 100 bytes each.
MAX_COLLIDING = 200_000


def _small(df: DataFrame, limit: int) -> DataFrame | None:
    """``df`` stored and marked for broadcast, if it has at most ``limit`` rows."""
    stored = reliable_cut(df)
    return F.broadcast(stored) if stored.limit(limit + 1).count() <= limit else None


def colliding_rows(elig: DataFrame, limit: int = MAX_COLLIDING) -> tuple[DataFrame, DataFrame] | None:
    """(keys, entities): the key texts that several (entity, date, type)
    groups hold and that are the greatest of one of them, and the entities of
    their rows -- the only rows for which the key-set forms differ from the
    per-group ones.  None if any set on the way is too large to broadcast."""
    group = F.struct(*DEDUP_KEYS)
    shared = elig.groupBy("pkid_").agg(F.min(group).alias("a"), F.max(group).alias("b")).filter("a != b").select("pkid_")
    if (keys := _small(shared, limit)) is None:
        return None
    groups = _small(elig.join(keys, "pkid_", "left_semi").select(*DEDUP_KEYS).distinct(), limit)
    if groups is None:
        return None
    on = [elig[c].eqNullSafe(groups[c]) for c in DEDUP_KEYS]
    greatest = elig.join(groups, on, "left_semi").groupBy(*DEDUP_KEYS).agg(F.max("pkid_").alias("pkid_"))
    passing = _small(greatest.join(keys, "pkid_", "left_semi").select("pkid_").distinct(), limit)
    if passing is None:
        return None
    entities = _small(elig.join(passing, "pkid_", "left_semi").select("entityid").distinct(), limit)
    return None if entities is None else (passing, entities)


def _dedup_with(elig: DataFrame, passing: DataFrame) -> DataFrame:
    """Key-set dedup, given the shared keys that pass it (rows may repeat)."""
    newest_key = Window.partitionBy(*DEDUP_KEYS).orderBy(F.col("pkid_").desc())
    top = elig.withColumn("_rank", F.rank().over(newest_key)).filter("_rank = 1").drop("_rank")
    return top.join(passing, "pkid_", "left_anti").unionByName(elig.join(passing, "pkid_", "left_semi"))


def select_statements_all(stmts: DataFrame, literal_chain: bool = False, as_of=None, limit: int = MAX_COLLIDING) -> DataFrame:
    """Newest snapshot -> eligible -> key-set dedup -> waterfall.

    Key texts held by one group only cannot reach beyond it, so they are
    deduplicated and placed per group and entity (two exchanges); the few that
    collide are found first, and what they change is broadcast.  With more
    than ``limit`` of them all rows are hashed by key text instead.
    ``literal_chain`` runs the work-list chain stage by stage (lineage cut by
    checkpoints).
    """
    latest = latest_snapshot(stmts.select(*KEY_COLUMNS), as_of)
    elig = eligible(latest)
    if literal_chain:
        dd = dedup_statements_by_key_set(elig).distinct()
        return cohort_chain(reliable_cut(dd), elig, cut_lineage=reliable_cut)
    found = colliding_rows(elig, limit)
    if found is None:
        return assign_cohorts_by_key(dedup_statements_by_key_set(elig))
    passing, entities = found
    # lone single-kind keys among the colliding ones, from their entities alone
    theirs = entity_stage(_dedup_with(elig.join(entities, "entityid", "left_semi"), passing))
    lone = theirs.filter("_lone = 1").join(passing, "pkid_", "left_semi").select("pkid_").distinct()
    cross = F.broadcast(reliable_cut(lone))  # a subset of ``passing``
    return place_by_key(entity_stage(_dedup_with(elig, passing)), cross)


#: Slice keys up to which the history is filtered by a broadcast of them.
MAX_FILTER_KEYS = 1_000_000


def _cut_history(hist: DataFrame, slices: DataFrame, filter_keys: int) -> DataFrame:
    """The history's rows (with their ``_key``) that can meet a slice row: by a
    broadcast of the slices' keys, or beyond ``filter_keys`` of them by a Bloom
    filter of bounded size, so only what is needed is shuffled."""
    keys = slices.select(F.col("pkid_").alias("_key"))
    n = keys.count()
    if n <= filter_keys:
        return hist.join(F.broadcast(keys), "_key", "left_semi")
    words = size_for(n)
    return passing(hist, F.col("_key"), key_filter(keys, "_key", words), words)


def statement_snapshots(stmts: DataFrame, periods: DataFrame, filter_keys: int = MAX_FILTER_KEYS) -> DataFrame:
    """Each period-tagged statement with every snapshot date holding its key
    text (a left join into the whole history, as the source batch does). The
    slice rows are stored once and cut the history before its exchange; every
    slice key is in the history, but the join stays a left one."""
    hist = stmts.select(key_concat("entityid", "statementid").alias("_key"), F.col("asofdate").alias("AOD"))
    slices = reliable_cut(periods.select(*SLICE_KEYS).distinct())
    hist = _cut_history(hist, slices, filter_keys)
    return slices.join(hist, slices["pkid_"] == hist["_key"], "left").select(*SLICE_KEYS, "AOD").distinct()


def slice_metrics_all(stmts: DataFrame, periods: DataFrame, filter_keys: int = MAX_FILTER_KEYS) -> DataFrame:
    """Per slice row: its distinct metric rows, weighted by the number of
    snapshot dates of its key.

    The slice rows are stored once.  Every slice key is in the history (its
    own row is), so the lookup is an inner join on the key text, and the
    history is cut to them before it is shuffled (``_cut_history``).
    The distinct snapshot dates are counted with a ``dense_rank`` window and
    the metric rows de-duplicated after the join, both on the join's own key
    partitioning (no further exchange).  Groups are one statement's rows
    across snapshots, bounded by the number of snapshots.
    """
    hist = stmts.select(key_concat("entityid", "statementid").alias("_key"), F.col("asofdate").alias("_aod"), *MEASURES)
    slices = reliable_cut(periods.select(*SLICE_KEYS).distinct())
    hist = _cut_history(hist, slices, filter_keys)
    joined = slices.join(hist, slices["pkid_"] == hist["_key"])
    lines = joined.select(*SLICE_KEYS, "_aod", *metric_columns())
    per_slice = Window.partitionBy(*SLICE_KEYS)
    lines = lines.withColumn("_aod_rank", F.dense_rank().over(per_slice.orderBy("_aod")))
    lines = lines.withColumn("_weight", F.max("_aod_rank").over(per_slice))
    return lines.drop("_aod", "_aod_rank").distinct()


def client_financials_all_snapshots(stmts: DataFrame, customers: DataFrame | None = None, as_of=None) -> DataFrame:
    from finwater.plans.client_financials import attach_customers, report_columns

    periods = assign_period(select_statements_all(stmts, as_of=as_of))
    lines = slice_metrics_all(stmts, periods)
    report = report_columns(period_totals(lines, weight_col="_weight"))
    if customers is not None:
        report = attach_customers(report, customers)
    return report


__all__ = ["client_financials_all_snapshots", "select_statements_all", "slice_metrics_all", "statement_snapshots"]
