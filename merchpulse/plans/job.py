"""Whole-job operators (R1 full run, R2 one merchant) and their outputs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchpulse.operators.scoring import final_scores, score_quotas
from merchpulse.operators.slices import base_values, shared_slices, split_rows
from merchpulse.plans import general, single_pass
from merchpulse.plans.periods import Periods, periods
from merchpulse.schema import KEY, WEIGHTS, WINDOW_MONTHS
from merchpulse.session import SharedTable, cut_lineage, file_system

STRATEGIES = ("hybrid", "general", "single_pass")


@dataclass
class ScoreRun:
    quotas: DataFrame
    scores: DataFrame
    final: DataFrame
    rejects: DataFrame | None = None  # bad metric rows, with on_bad="quarantine"
    reject_counts: dict[str, int] = field(default_factory=dict)  # by reason
    tables: list[SharedTable] = field(default_factory=list)  # what the frames read

    def drop(self) -> None:
        """Remove the run's shared tables; its lazy frames are gone with them."""
        while self.tables:
            self.tables.pop().drop()


def materialize(df: DataFrame, how: str = "checkpoint") -> DataFrame:
    """Compute ``df`` once for several consumers.

    ``checkpoint`` writes it to the cluster's checkpoint folder (survives
    executor loss, cuts lineage); ``persist`` caches it on the executors
    (lost blocks are recomputed from lineage); ``none`` leaves it lazy.
    """
    if how == "checkpoint":
        return cut_lineage(df)
    if how == "persist":
        return df.persist()
    if how == "none":
        return df
    raise ValueError("how must be 'checkpoint', 'persist' or 'none'")


def compute_quotas(metrics: DataFrame, as_of, strategy: str = "hybrid", n: int = WINDOW_MONTHS,
                   on_bad: str = "fail", materialize_base: str | None = None) -> DataFrame:
    """Q12 by the chosen plan.

    * ``hybrid`` (default): checkpointed merchant fold; the growth operator
      only for merchants with conflicting months; exact for any input.
    * ``general``: one sub-plan per quota merged by the cogroup operator
      (the published job's shape); exact, many small shuffles.
    * ``single_pass``: one fold, two shuffles; raises if a merchant has two
      sales values for one month.

    The general plan reads the de-duplicated base once per quota, so it is
    materialised first (``materialize_base``, default ``slices``: a table in
    folders by code, of which each consumer reads its codes): otherwise
    Catalyst pushes each consumer's code filter into the source and every
    consumer re-reads it.  The other plans read it once (default ``none``).
    """
    p = periods(as_of, n)
    return quotas_of(base_values(metrics, p, on_bad=on_bad), p, strategy, materialize_base)


def quotas_of(base: DataFrame, p: Periods, strategy: str = "hybrid", materialize_base: str | None = None,
              tables: list[SharedTable] | None = None) -> DataFrame:
    """Q12 over base values by the chosen plan.  Tables that it writes and the
    result reads are added to ``tables``."""
    how = materialize_base or ("slices" if strategy == "general" else "none")
    if how == "slices" and strategy != "single_pass":
        table = shared_slices(base)
        base = table.frame
        if tables is not None:
            tables.append(table)
        how = "none"
    if strategy == "hybrid":
        return single_pass.all_quotas_hybrid(materialize(base, how), p)
    if strategy == "general":
        return general.all_quotas(materialize(base, how), p)
    if strategy == "single_pass":
        return single_pass.all_quotas(base, p)
    raise ValueError(f"strategy must be one of {STRATEGIES}")


def score_all(metrics: DataFrame, as_of, bands="as_published", weights: dict = WEIGHTS,
              strategy: str = "hybrid", n: int = WINDOW_MONTHS, on_bad: str = "fail",
              materialize_base: str | None = None) -> ScoreRun:
    """Quotas, scores and final score for every merchant.

    The plans materialise their intermediate results (the merchant fold,
    the general plan's base) when this is called; scoring after them is a
    lazy projection.
    """
    p, tables, rejects, counts = periods(as_of, n), [], None, {}
    if on_bad == "quarantine":
        base, rejects, counts, table = split_rows(metrics, p)
        tables.append(table)
    else:
        base = base_values(metrics, p, on_bad)
    quotas = quotas_of(base, p, strategy, materialize_base, tables)
    scores = score_quotas(quotas, bands)
    return ScoreRun(quotas, scores, final_scores(scores, weights), rejects, counts, tables)


def score_one(metrics: DataFrame, uuid: str, as_of, **kw) -> ScoreRun:
    """R2: the same run for one merchant.  The key predicate is a plain
    column comparison, so Catalyst pushes it into the source scan."""
    return score_all(metrics.where(F.col(KEY) == F.lit(uuid)), as_of, **kw)


#: Keys up to this many reach the scan as a list; more as a semi-join.
LISTED_KEYS = 1000


def of_merchants(metrics: DataFrame, uuids: Sequence[str]) -> DataFrame:
    """The rows of some merchants.  A short list is a predicate that the scan
    takes; a long one a semi-join, for which Spark makes a runtime filter or a
    broadcast by the list's size."""
    if len(uuids) <= LISTED_KEYS:
        return metrics.where(F.col(KEY).isin(list(uuids)))
    keys = metrics.sparkSession.createDataFrame([(u,) for u in uuids], f"{KEY} string")
    return metrics.join(keys, KEY, "left_semi")


def score_many(metrics: DataFrame, uuids: Sequence[str], as_of, **kw) -> ScoreRun:
    """R2 for a batch of merchants in one run."""
    return score_all(of_merchants(metrics, list(dict.fromkeys(uuids))), as_of, **kw)


def run_and_write_many(metrics: DataFrame, uuids: Sequence[str], as_of, base_path: str, **kw) -> ScoreRun:
    """The online outputs of a batch of merchants (K4): below
    ``<base>/online/yyyyMM/dd/<name>`` a folder for each merchant
    (``property_uuid=<key>``).  Only the folders of these merchants are
    replaced, and those of merchants that have no result any more are removed;
    other merchants' stay.
    """
    from merchpulse.sinks.text import online_root, write_rows_by_key

    uuids = list(dict.fromkeys(uuids))
    run = score_many(metrics, uuids, as_of, **kw)
    quotas = cut_lineage(run.quotas)
    scores = score_quotas(quotas, kw.get("bands", "as_published"))
    final = final_scores(scores, kw.get("weights", WEIGHTS))
    spark, root = metrics.sparkSession, online_root(base_path, as_of)
    for name, df in {"quotas": quotas, "quotaScores": scores, "finalScores": final}.items():
        write_rows_by_key(df, KEY, f"{root}/{name}")
    # the batch's keys, of which the caller holds the list
    left = set(uuids) - {r[KEY] for r in quotas.select(KEY).collect()}
    for name in ("quotas", "quotaScores", "finalScores"):
        fs, to_path = file_system(spark, f"{root}/{name}")
        for key in left:
            fs.delete(to_path(to_path(f"{root}/{name}"), f"{KEY}={spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(key)}"), True)
    run.drop()
    return ScoreRun(quotas, scores, final, None, run.reject_counts)


def run_and_write(metrics: DataFrame, as_of, base_path: str, uuid: str | None = None,
                  single_file: bool = False, **kw) -> ScoreRun:
    """Compute and write the three outputs, and the rejected rows of a
    quarantine run, as tab-separated text (K1, K4).

    The quota table is checkpointed once, so the three writes do not
    recompute it.  The outputs are published together (``sinks.publish``): a
    run that fails leaves those of the last run as they were.  The run's
    shared tables are dropped at its end; the rejects returned are read from
    their output's checkpoint.
    """
    from merchpulse.sinks.publish import Publication
    from merchpulse.sinks.text import output_root, write_rows

    run = score_one(metrics, uuid, as_of, **kw) if uuid is not None else score_all(metrics, as_of, **kw)
    quotas = cut_lineage(run.quotas)
    scores = score_quotas(quotas, kw.get("bands", "as_published"))
    final = final_scores(scores, kw.get("weights", WEIGHTS))
    rejects = None if run.rejects is None else cut_lineage(run.rejects)
    outputs = {"quotas": quotas, "quotaScores": scores, "finalScores": final}
    if rejects is not None:
        outputs["rejects"] = rejects
    with Publication(metrics.sparkSession, output_root(base_path, as_of, uuid)) as out:
        for name, df in outputs.items():
            write_rows(df, out.path(name), single_file=single_file)
    run.drop()
    return ScoreRun(quotas, scores, final, rejects, run.reject_counts)
