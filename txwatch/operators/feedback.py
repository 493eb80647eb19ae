"""Auditors' verdicts: an append-only table, the verdict that holds, and the queue ranked by calibrated probability.

A feedback row is (feedback_id, alerta_id, auditor, veredito, dt_veredito). Rows are never changed; a later row
replaces an earlier one of the same alert.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.operators.calibrator import VERDICTS, Calibrator, apply_calibrator, training_set, wide_scores

# What an auditor can say of an alert.
STATUSES = ("ABERTO", "EM_ANALISE", *VERDICTS)


def latest_verdicts(feedback: DataFrame) -> DataFrame:
    """One row per judged alert: the last verdict by (dt_veredito, feedback_id), and how many there were.

    Rows without an alert or with an unknown verdict do not count; a row without a date is older than any with
    one. Equal date and id: the greater verdict by name, then the greater auditor, so the choice never depends on
    the order of rows. The aggregate combines before the shuffle, so an alert judged many times is no hot group.
    """
    known = feedback.where(F.col("alerta_id").isNotNull() & F.col("veredito").isin(*STATUSES))
    order = F.struct("dt_veredito", "feedback_id", "veredito", "auditor")
    last = known.groupBy("alerta_id").agg(F.max(order).alias("u"), F.count(F.lit(1)).alias("vereditos"))
    return last.select(
        "alerta_id", F.col("u.veredito").alias("status"), F.col("u.auditor").alias("auditor"),
        F.col("u.dt_veredito").alias("dt_veredito"), "vereditos",
    )


def with_verdicts(alerts: DataFrame, feedback: DataFrame) -> DataFrame:
    """`alerts` with the status that their last verdict gives them; others keep their own."""
    verdicts = latest_verdicts(feedback).select("alerta_id", F.col("status").alias("_verdict"))
    judged = alerts.join(verdicts, "alerta_id", "left")
    return judged.withColumn("status", F.coalesce("_verdict", "status")).select(*alerts.columns)


def labelled(alerts: DataFrame, scores: DataFrame, feedback: DataFrame) -> DataFrame:
    """The training set of the calibrator after feedback: alerts whose last verdict is final."""
    return training_set(with_verdicts(alerts, feedback), scores)


def calibrated_queue(
    alerts: DataFrame, scores: DataFrame, feedback: DataFrame, tx: DataFrame, calibrator: Calibrator | None
) -> DataFrame:
    """Alerts that no final verdict has closed, with probability of confirmation and the slicers canal and ano_mes.

    Sorted by probability, then score, then id. Without a calibrator (fewer than MIN_LABELLED verdicts) the
    probability is null and the score decides. canal comes from the alert's transaction, null for alerts on
    members, branches and days. `scores` holds (alerta_id, regra_id, score).
    """
    status = F.col("status")
    waiting = with_verdicts(alerts, feedback).where(status.isNull() | ~status.isin(*VERDICTS))
    ids = waiting.select("transacao_id").where("transacao_id is not null").distinct()
    hit = tx.select("transacao_id", "canal").join(ids, "transacao_id")  # the alerts are the side to broadcast
    queue = waiting.join(hit, "transacao_id", "left").join(wide_scores(scores), "alerta_id", "left")
    if calibrator is None:
        queue = queue.withColumn("prob_confirmacao", F.lit(None).cast("double"))
    else:
        queue = apply_calibrator(calibrator, queue)
    return queue.select(
        "alerta_id", "transacao_id", F.date_format("dt_alerta", "yyyy-MM").alias("ano_mes"), "canal", "regra_id", "familia",
        "severidade", "score", "prob_confirmacao", "status",
    ).orderBy(F.desc_nulls_last("prob_confirmacao"), F.desc_nulls_last("score"), "alerta_id")

