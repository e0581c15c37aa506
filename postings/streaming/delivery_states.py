"""Current state of every delivery, kept by the stream: attempts in, state changes, due retries and dead letters out."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from postings.operators.keyed import latest_by
from postings.operators.ledgers import MAX_ATTEMPTS

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Seconds to the next try after the first failure; each further one doubles it, up to a day.
RETRY_SECONDS, RETRY_MOST = 300, 86_400
#: Buckets of deliveries, each one value of the state store.
BUCKETS = 16_384
#: JSON of keys that loses nothing of a time.
EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
CHANGE = ["delivery", "attempts", "state", "error", "last_at", "retry_at", "event"]


def retry_delay(failures: int, first: int = RETRY_SECONDS) -> timedelta:
    return timedelta(seconds=min(RETRY_MOST, first * 2 ** min(failures - 1, 30)))


def state_of(attempts: int, failures: int, sent: bool, max_attempts: int = MAX_ATTEMPTS) -> str:
    return "sent" if sent else "pending" if not failures else "dead-letter" if attempts >= max_attempts else "failed"


def new_delivery() -> dict:
    """State of a delivery without attempts: times are microseconds, ``seen`` has the outcome of each attempt id, ``waits`` is set until a retry was put out as due."""
    return {"attempts": 0, "failures": 0, "sent": False, "error": None, "error_at": None, "error_id": None, "last_at": None, "retry_at": None, "waits": False, "seen": {}}


class DeliveryFold:
    """Fold of the attempts of one bucket's deliveries: counts and the last error, whatever the order in which they come.

    An attempt id seen before is a repeat and changes nothing. A failure with attempts left waits for its retry time;
    the bucket's timeout is the first of these, and a delivery whose time has come is put out as ``retry_due``, unless something
    came in between. A call to Python costs some milliseconds, so deliveries share one by buckets, and their state is one value.
    """

    def __init__(self, max_attempts: int, first_delay: int):
        self.max_attempts, self.first_delay = max_attempts, first_delay

    def _state(self, one: dict) -> str:
        return state_of(one["attempts"], one["failures"], one["sent"], self.max_attempts)

    def _row(self, key: str, one: dict, event: str) -> tuple:
        state = self._state(one)
        return key, one["attempts"], state, None if one["sent"] else one["error"], one["last_at"], one["retry_at"] if state == "failed" else None, event

    def _add(self, one: dict, at: int | None, attempt_id: int, ok: bool | None, message: str | None) -> bool:
        """Whether an attempt changes its delivery."""
        before = one["seen"].get(attempt_id, "new")
        if before != "new" and (before is not None or ok is None):
            return False  # a repeat; an open attempt may still get its outcome
        one["seen"][attempt_id] = ok
        one["attempts"] += before == "new"
        one["sent"] = one["sent"] or ok is True
        if ok is False:
            one["failures"] += 1
            if one["error_at"] is None or at is not None and (at, attempt_id) > (one["error_at"], one["error_id"]):
                one["error"], one["error_at"], one["error_id"] = message, at, attempt_id
        if at is not None and (one["last_at"] is None or at > one["last_at"]):
            one["last_at"] = at
        return True

    def _retry(self, one: dict) -> None:
        one["waits"] = self._state(one) == "failed" and one["error_at"] is not None
        one["retry_at"] = one["error_at"] + retry_delay(one["failures"], self.first_delay) // timedelta(microseconds=1) if one["waits"] else None

    def __call__(self, bucket: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        known: dict[str, dict] = pickle.loads(bytes(held.get[0])) if held.exists else {}
        now, changed = held.getCurrentProcessingTimeMs(), {}
        for frame in [] if held.hasTimedOut else frames:
            for key, at, attempt_id, ok, message in zip(*(frame[c].tolist() for c in ("delivery", "at", "attempt_id", "ok", "error")), strict=True):
                one = known.setdefault(key, new_delivery())
                if self._add(one, None if pd.isna(at) else int(at), int(attempt_id), None if pd.isna(ok) else bool(ok), None if pd.isna(message) else str(message)):
                    changed[key] = one
        for one in changed.values():
            self._retry(one)
        rows = [self._row(key, one, "dead_letter" if self._state(one) == "dead-letter" else "changed") for key, one in changed.items()]
        due = {key: one for key, one in known.items() if one["waits"] and one["retry_at"] // 1000 <= now}  # one in the past is due in this batch
        rows += [self._row(key, one, "retry_due") for key, one in due.items()]
        for one in due.values():
            one["waits"] = False
        if rows:
            held.update((pickle.dumps(known),))
        left = [one["retry_at"] for one in known.values() if one["waits"]]
        if left:
            held.setTimeoutDuration(min(left) // 1000 - now)
        if rows:
            yield pd.DataFrame(rows, columns=CHANGE, dtype=object)


def delivery_states(attempts: DataFrame, keys: list[str], *, max_attempts: int = MAX_ATTEMPTS, first_delay: int = RETRY_SECONDS, buckets: int = BUCKETS) -> DataFrame:
    """State changes of deliveries from a stream of attempts (keys, at, attempt_id, ok, error).

    Rows (keys, attempts, state, error, last_at, retry_at, event): ``changed`` and ``dead_letter`` when attempts
    came in, ``retry_due`` with the first batch after a failed delivery's retry time (timers go by the clock, since
    an event-time watermark would drop attempts that come late). The last ``changed`` or ``dead_letter`` row of a key is what the batch fold
    (``ledgers.delivery_state``) says of all its attempts. State is one value a bucket of deliveries (by hash of their keys), with an entry an attempt;
    a batch rewrites the buckets that it touches, so ``buckets`` should grow with the deliveries kept. A stream's checkpoint holds to the number it began with.
    Use it with outputMode("update"); it sets the session's state store to RocksDB and batches without data off.
    """
    attempts.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    # a clock always asks for one more batch without data, and availableNow would never end
    attempts.sparkSession.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    fields = ", ".join(f"`{k}` {attempts.schema[k].dataType.simpleString()}" for k in keys)
    schema = "delivery string, attempts long, state string, error string, last_at long, retry_at long, event string"
    rows = attempts.select(
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket"), F.to_json(F.struct(*keys), EXACT | {"ignoreNullFields": "false"}).alias("delivery"), F.unix_micros(F.col("at").cast("timestamp")).alias("at"),
        F.col("attempt_id").cast("long").alias("attempt_id"), "ok", F.col("error").cast("string").alias("error"),
    )
    changes = rows.groupBy("bucket").applyInPandasWithState(DeliveryFold(max_attempts, first_delay), schema, "deliveries binary", "update", GroupStateTimeout.ProcessingTimeTimeout)
    changes = changes.withColumn("delivery", F.from_json("delivery", fields, EXACT))
    return changes.select(*(F.col("delivery")[k].alias(k) for k in keys), "attempts", "state", "error", *(F.timestamp_micros(c).alias(c) for c in ("last_at", "retry_at")), "event")


def latest_states(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The current state of each delivery from the log of its changes (with ``batch``, the number of the batch that wrote them)."""
    return latest_by(changes.where("event <> 'retry_due'").select(*keys, "batch", "attempts", "state", "error", "last_at"), keys, ["batch", "attempts", "last_at"]).drop("batch")

