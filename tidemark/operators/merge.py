"""Change capture: history, current state, snapshots, diffs, reviews.

A merge is one full outer join that yields the new rows with an ``action``
(insert, update, delete, keep).  Sides meet on their key; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import absent_keys, affected, latest_by
from ..functions.expr import row_hash

EVENT_KEY = ["policy_id", "updated_on", "op"]


def merge_history(history: DataFrame, batch: DataFrame, keys: list[str] = EVENT_KEY) -> DataFrame:
    """Events of the batch that the history doesn't have; events are never changed."""
    return absent_keys(batch.dropDuplicates(keys), history, keys)


def merge(target: DataFrame, source: DataFrame, key: str, delete_missing: bool = False, delete: Column | None = None, kept: list[str] | None = None) -> DataFrame:
    """All rows of both sides with an action.

    ``delete``: a condition on source rows that removes the key.  ``delete_missing``:
    the source is a complete snapshot.  ``kept``: columns that only the target has
    and that survive updates.
    """
    cols = [c for c in source.columns if c != key]
    kept = kept or []
    values = [c for c in cols if c in target.columns and c not in kept]
    t = target.select(key, F.struct(*[c for c in target.columns if c != key]).alias("_t"))
    removed = (delete if delete is not None else F.lit(False)).alias("_delete")
    s = source.select(key, F.struct(*cols).alias("_s"), removed)
    same = F.struct(*(F.col(f"_t.{c}") for c in values)).eqNullSafe(F.struct(*(F.col(f"_s.{c}") for c in values)))
    action = (
        F.when(F.col("_s").isNull(), "delete" if delete_missing else "keep")
        .when(F.col("_delete"), F.when(F.col("_t").isNull(), "none").otherwise("delete"))
        .when(F.col("_t").isNull(), "insert").when(same, "keep").otherwise("update")
    )
    df = t.join(s, key, "full").withColumn("action", action).where("action <> 'none'")
    from_source = F.col("action").isin("insert", "update")
    out = [F.when(from_source, F.col(f"_s.{c}")).otherwise(F.col(f"_t.{c}")).alias(c) if c in values else F.col(f"_t.{c}").alias(c) for c in target.columns if c != key]
    return df.select(key, *out, "action")


def live(merged: DataFrame) -> DataFrame:
    """The new state of a merge."""
    return merged.where("action <> 'delete'").drop("action")


def mutation_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy("action").agg(F.count(F.lit(1)).alias("rows"))


def merge_current(active: DataFrame, history: DataFrame, batch: DataFrame) -> DataFrame:
    """Current state after a batch that is in the history already.

    The latest event over the whole history of each touched key decides, so a
    late update can't undo a later delete, and a later one revives the key.
    """
    latest = latest_by(affected(history, batch, "policy_id"), ["policy_id"], "updated_on")
    return merge(active, latest, "policy_id", delete=F.col("op") == "D")


def current_state(history: DataFrame) -> DataFrame:
    """The state that all batches together lead to."""
    return latest_by(history, ["policy_id"], "updated_on").where("op <> 'D'")


def refresh_dimension(dim: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """A complete snapshot: missing keys go, an empty one empties the table."""
    return merge(dim, snapshot, key, delete_missing=True)


def upsert(target: DataFrame, batch: DataFrame, key: str, kept: list[str] | None = None) -> DataFrame:
    """Rows absent from the batch stay as they are."""
    return merge(target, batch, key, kept=kept)


def update_if_distinct(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Only the rows that change."""
    return merge(target, source, key).where("action IN ('insert', 'update')")


def is_fresh(resource: str, captured_at, applied: dict, exempt: tuple[str, ...] = ("policies",)) -> bool:
    """Whether a capture may be applied: never without a time, not before the last applied one; change feeds always."""
    if resource in exempt:
        return True
    return captured_at is not None and (applied.get(resource) is None or captured_at >= applied[resource])


def capture_times(raw: DataFrame, runs: DataFrame, resources: list[str]) -> DataFrame:
    """Per selected resource the latest time of its rows, else the end of its run."""
    wanted = raw.sparkSession.createDataFrame([(r,) for r in resources], "resource string")
    ended = runs.agg(F.max("finished_at").alias("_ended"))
    seen = raw.groupBy("resource").agg(F.max("ingested_at").alias("_seen"))
    return wanted.join(seen, "resource", "left").join(ended).select("resource", F.coalesce("_seen", "_ended").alias("captured_at"))


def advance_state(state: DataFrame, captured: DataFrame, run_id: str) -> DataFrame:
    """Capture times only move forward."""
    s = state.select("resource", F.col("captured_at").alias("_old"), F.col("run_id").alias("_run"))
    df = s.join(captured.where("captured_at IS NOT NULL"), "resource", "full")
    newer = F.col("captured_at") >= F.coalesce("_old", F.lit("1970-01-01").cast("timestamp"))
    return df.select("resource", F.greatest("_old", "captured_at").alias("captured_at"), F.when(newer, F.lit(run_id)).otherwise(F.col("_run")).alias("run_id"))


def snapshot_diff(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """NEW, CHANGED, UNCHANGED or ABSENT_REVIEW per key, with both hashes."""
    hashed = lambda df, n: df.select(key, row_hash(*[c for c in df.columns if c != key]).alias(n))
    a, b = hashed(previous, "previous_hash"), hashed(current, "current_hash")
    kind = (
        F.when(F.col("previous_hash").isNull(), "NEW").when(F.col("current_hash").isNull(), "ABSENT_REVIEW")
        .when(F.col("previous_hash") == F.col("current_hash"), "UNCHANGED").otherwise("CHANGED")
    )
    return a.join(b, key, "full").select(key, kind.alias("change_type"), "previous_hash", "current_hash")


def snapshot_absent(table: DataFrame, batch: DataFrame, recorded: DataFrame, key: str, run_id: str) -> DataFrame:
    """Keys of the table that the batch lacks, with the stored row's hash; once per run and key."""
    gone = absent_keys(table, batch, [key])
    out = gone.select(F.lit(run_id).alias("run_id"), key, row_hash(*[c for c in table.columns if c != key]).alias("previous_hash"), F.lit("ABSENT_REVIEW").alias("change_type"))
    return absent_keys(out, recorded, ["run_id", key])


def immutable_conflicts(history: DataFrame, batch: DataFrame, keys: list[str] = ["policy_id", "updated_on"]) -> DataFrame:  # noqa: B006
    """Events of the batch that differ from the stored event of the same policy and time; op is content here.

    Both sides are one table, shuffled once by the keys: a key of both with more than one content.
    """
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    h, b = history.withColumns({"_old": F.lit(True), "_new": F.lit(False)}), batch.select(*history.columns).withColumns({"_old": F.lit(False), "_new": F.lit(True)})
    contents = h.unionByName(b).where(known).repartition(*keys).groupBy(*history.columns).agg(F.bool_or("_old").alias("_old"), F.bool_or("_new").alias("_new"))
    per = contents.groupBy(*keys).agg(F.count(F.lit(1)).alias("_contents"), F.bool_or("_old").alias("_old"), F.bool_or("_new").alias("_new"))
    return per.where("_contents > 1 AND _old AND _new").select(*keys)


def op_violations(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Touched policies with an op outside I, U, D, or without exactly one I in their history and the batch; one shuffle by policy."""
    old = history.where("policy_id IS NOT NULL").select(*EVENT_KEY, F.lit(False).alias("_new"))
    events = old.unionByName(batch.select(*EVENT_KEY, F.lit(True).alias("_new"))).repartition("policy_id").groupBy(*EVENT_KEY).agg(F.bool_or("_new").alias("_new"))
    bad = ~F.coalesce(F.col("op").isin("I", "U", "D"), F.lit(False))
    per = events.groupBy("policy_id").agg(F.bool_or("_new").alias("_new"), F.count_if(F.col("op") == "I").alias("inserts"), F.count_if(bad).alias("bad_ops"))
    return per.where("_new AND (inserts <> 1 OR bad_ops > 0)").drop("_new")


def delta_window(events: DataFrame, watermark: str, overlap_seconds: int, at: str = "updated_on") -> DataFrame:
    """Events from the committed watermark less the overlap; the merge drops what is known."""
    start = F.lit(watermark).cast("timestamp") - F.make_interval(secs=F.lit(overlap_seconds))
    return events.where(F.col(at) >= start)


ISSUES = {
    "MONTO_NEGATIVO": "amount < 0",
    "MONEDA_NULA": "currency IS NULL",
    "MONEDA_NO_RECUPERABLE": "claim_currency IS NULL",
    "SIN_COTIZACION": "amount_state = 'SIN_COTIZACION'",
    "FUERA_PERIODO": "cover_state = 'FUERA_PERIODO'",
    "POLIZA_AUSENTE": "cover_state = 'POLIZA_AUSENTE'",
}


def claim_issues(claims: DataFrame) -> DataFrame:
    """One row per claim and issue, with the currency inferred for it if any."""
    codes = F.array_compact(F.array(*(F.when(F.expr(c), F.lit(n)) for n, c in ISSUES.items())))
    suggested = F.when(F.col("currency_origin") == "INFERIDA_POLIZA", F.col("claim_currency"))
    return claims.select("claim_id", suggested.alias("suggested_currency"), F.explode(codes).alias("issue_code"))


def merge_reviews(reviews: DataFrame, claims: DataFrame, at: str) -> DataFrame:
    """Review queue after a run: new issues enter, seen ones are stamped, pending ones that are gone are closed,
    and a missing currency that was inferred is marked as applied."""
    now = F.lit(at).cast("timestamp")
    found = claim_issues(claims).withColumn("_found", F.lit(True))
    old = reviews.withColumnRenamed("suggested_currency", "_old_currency")
    df = old.join(found, ["claim_id", "issue_code"], "full")
    here = F.col("_found").isNotNull()
    applied = here & (F.col("issue_code") == "MONEDA_NULA") & F.col("suggested_currency").isNotNull()
    status = (
        F.when(applied, "INFERENCE_APPLIED").when(here, F.coalesce("review_status", F.lit("PENDING")))
        .when(F.col("review_status") == "PENDING", "NO_LONGER_PRESENT").otherwise(F.col("review_status"))
    )
    return df.select(
        "claim_id", "issue_code", F.coalesce("first_seen_at", now).alias("first_seen_at"), F.when(here, now).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
        status.alias("review_status"), F.when(here, F.col("suggested_currency")).otherwise(F.col("_old_currency")).alias("suggested_currency"),
    )
