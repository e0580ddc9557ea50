"""State per message kept up to date from a growing action log (W1, J2, R2), and
alerts on what came since the last check (R5).

Both read only the folders of runs committed after a stored position, and move
that position in the commit that holds their result: a run that fails has read
nothing, as far as the next one is concerned, and a replayed one can't count
anything twice. Rows with an old stamp that arrive late are new rows like any
other, since positions are commits, not times.

The state is a mergeable aggregate -- number of actions, first and last action --
so old state and the aggregate of the new rows give the same as a full pass over
the log, whatever pieces it came in. Actions without an id have no state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import schemas
from ..sources.runs import REVIEW_TABLES, Run, RunStore, RunTable, attempt, moves, rewrites

LOG, STATE, ALERTS = "review_actions", "action_state", "alerts"
# An action, in the order that makes the first and last of a message unique.
ACTION = T.StructType([T.StructField(f, schemas.REVIEW_ACTIONS[f].dataType)
                       for f in ("created_at", "action", "actor_email", "reason")])
STATE_TABLES = {
    STATE: RunTable(T.StructType([T.StructField("email_id", T.StringType()), T.StructField("n_actions", T.LongType()),
                                  T.StructField("first", ACTION), T.StructField("last", ACTION)]), append=False),
    ALERTS: RunTable(T.StructType([T.StructField("consumer", T.StringType()), T.StructField("action", T.StringType()),
                                   T.StructField("n_new", T.LongType()),
                                   T.StructField("latest_at", T.TimestampNTZType()),
                                   T.StructField("from_commit", T.LongType()),
                                   T.StructField("to_commit", T.LongType())])),
}
TABLES = REVIEW_TABLES | STATE_TABLES


def state_of(actions: DataFrame) -> DataFrame:
    """State of the messages in ``actions`` (a plain aggregate)."""
    one = F.struct(*ACTION.names)
    return actions.where(F.col("email_id").isNotNull()).groupBy("email_id").agg(
        F.count(F.lit(1)).alias("n_actions"), F.min(one).alias("first"), F.max(one).alias("last"))


def merged(*states: DataFrame) -> DataFrame:
    """State of all rows behind several states."""
    whole = states[0]
    for other in states[1:]:
        whole = whole.unionByName(other)
    return whole.groupBy("email_id").agg(F.sum("n_actions").alias("n_actions"), F.min("first").alias("first"),
                                         F.max("last").alias("last"))


def new_actions(run: Run, position: str) -> tuple[DataFrame | None, int]:
    """Log rows committed after ``position`` (``None``: there are none), and the
    position itself."""
    after = run.store.offset(position, run.seen)
    if not run.store.folders(LOG, run.seen, after):
        return None, after
    return run.read(LOG, after), after


def update_state(store: RunStore) -> int | None:
    """Bring the state up to the last commit: the commit that shows it, ``None`` where
    the log has nothing new."""
    def work(run: Run) -> int | None:
        rows, _ = new_actions(run, STATE)
        if rows is None:
            return None
        run.write(STATE, merged(run.read(STATE), state_of(rows)))
        return run.commit(rewrites(STATE), {STATE: run.seen})
    return attempt(store, "state", work)


def flat_state(state: DataFrame) -> DataFrame:
    """The state in plain columns."""
    return state.select("email_id", "n_actions", *[
        F.col(f"{which}.{c}").alias(f"{which}_{name}") for which in ("first", "last")
        for c, name in (("created_at", "action_at"), ("action", "action"), ("actor_email", "actor"))])


def alert(store: RunStore, consumer: str = "default", by: Sequence[str] = ("action",)) -> int | None:
    """Count the actions committed since the consumer's last alert, per group, as one
    batch in ``alerts``; the batch and the new position are one commit."""
    position = f"alerts:{consumer}"

    def work(run: Run) -> int | None:
        rows, after = new_actions(run, position)
        if rows is None:
            return None
        run.write(ALERTS, rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_new"), F.max("created_at").alias("latest_at"))
                  .select(F.lit(consumer).alias("consumer"), F.concat_ws("|", *by).alias("action"), "n_new", "latest_at",
                          F.lit(after + 1).cast("long").alias("from_commit"),
                          F.lit(run.seen).cast("long").alias("to_commit")))
        return run.commit(moves(position), {position: run.seen})
    return attempt(store, "alert", work)
