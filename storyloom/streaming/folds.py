"""Story folds as streams: relationships and items kept in the state store, begun from a batch result and taken back as a table.

The batch forms are in ``operators.state``; drained streams hold the same rows. Keys are as fine as the folds allow (a pair of characters, an item of
one), so a story's updates are spread over all state partitions. Updates may arrive in any order within and across triggers: what counts is the
order column. State lives in the RocksDB store under the query's checkpoint, and a restarted query goes on from it.

Defined results: rows without character, target or item name are ignored, like actions of other names; a null order comes before all others; an update that
arrives twice (with one order) counts once in items and twice among events, as in the batch forms.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

#: stands for a null order, and for what a snapshot's rows without orders have
FIRST = -(1 << 63)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _at(value: Any) -> int:
    return FIRST if value is None else int(value)


class RelationshipState(StatefulProcessor):
    """The last opinion that says something with its order (null before there is one), and a list of events to which each update adds."""

    def __init__(self, key: list[str], order: str) -> None:
        self.key, self.order = key, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.opinion = handle.getValueState("opinion", "at long, opinion string")
        self.events = handle.getListState("events", "at long, event string")

    def _add(self, said: list[tuple[int, str | None]], told: list[tuple[int, str]]) -> str | None:
        """The opinion that counts now; a pair of which nothing is said is kept without one, so that the state names it."""
        known = self.opinion.get()
        now = known or (FIRST, None)
        for at, opinion in said:
            if opinion and (now[1] is None or at >= now[0]):
                now = (at, opinion)
        if known is None or tuple(known) != tuple(now):
            self.opinion.update(tuple(now))
        if told:
            self.events.appendList(told)
        return now[1]

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        self._add([(_at(initialState["opinion_at"]), initialState["opinion"])], [(_at(e["at"]), e["event"]) for e in initialState["events"] or ()])

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        said, told = [], []
        for r in rows:
            said.append((_at(r[self.order]), r["opinion"]))
            if r["new_event"]:
                told.append((_at(r[self.order]), r["new_event"]))
        yield Row(**dict(zip(self.key, key, strict=True)), opinion=self._add(said, told))

    def close(self) -> None:
        pass


class ItemState(StatefulProcessor):
    """An item's updates since its last removal, by order: what has gone before a removal no longer counts and is dropped.

    All of it is one value, read and written once a trigger, so the talk with the state store goes by items, not by updates.
    """

    def __init__(self, key: list[str], order: str) -> None:
        self.key, self.order = key, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.item = handle.getValueState("item", "removed long, at array<long>, action array<string>, new_state array<string>")

    def _put(self, more: list[tuple[int, str, str]]) -> list[tuple[int, str, str]]:
        """Add updates; those that count, in order."""
        last, *columns = self.item.get() or (None, [], [], [])
        updates = {*zip(*columns, strict=True), *(u for u in more if u[1] != "remove")}
        last = max((at for at in (last, *(u[0] for u in more if u[1] == "remove")) if at is not None), default=None)
        left = sorted(u for u in updates if last is None or u[0] > last)  # of one order the removal comes last
        self.item.update((last, *([u[i] for u in left] for i in range(3))))
        return left

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        gone = initialState["removed"]
        self._put([*([] if gone is None else [(int(gone), "remove", "")]), *((_at(u["at"]), u["action"], u["new_state"] or "") for u in initialState["updates"] or ())])

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held, state = False, ""
        for _, action, n in self._put([(_at(r[self.order]), r["action"], r["new_state"] or "") for r in rows]):
            if not held:
                held, state = True, n
            elif action == "modify" and n:
                state = n
        yield Row(**dict(zip(self.key, key, strict=True)), held=held, state=state)

    def close(self) -> None:
        pass


def _stream(blocks: DataFrame, processor: StatefulProcessor, key: list[str], out: str, initial: DataFrame | None) -> DataFrame:
    kinds = dict(blocks.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in key) + f", {out}"
    begun = initial.groupBy(*key) if initial is not None else None
    return blocks.groupBy(*key).transformWithState(statefulProcessor=processor, outputStructType=schema, outputMode="Update", timeMode="None", initialState=begun)


def relationship_stream(blocks: DataFrame, story: list[str], order: str, initial: DataFrame | None = None) -> DataFrame:
    """(story, character, target, opinion) of pairs that a trigger has touched. ``initial``: a snapshot as ``relationships_of`` or ``from_relationships`` gives it."""
    key = [*story, "character", "target"]
    fit = blocks.where("coalesce(character, '') <> '' and coalesce(target, '') <> ''").select(*key, order, "opinion", "new_event")
    return _stream(fit, RelationshipState(key, order), key, "opinion string", initial)


def item_stream(blocks: DataFrame, story: list[str], order: str, initial: DataFrame | None = None) -> DataFrame:
    """(story, character, item_name, held, state) of items that a trigger has touched. ``initial``: a snapshot as ``items_of`` or ``from_items`` gives it."""
    key = [*story, "character", "item_name"]
    fit = blocks.where("coalesce(character, '') <> '' and coalesce(item_name, '') <> '' and action in ('add', 'remove', 'modify')").select(*key, order, "action", "new_state")
    return _stream(fit, ItemState(key, order), key, "held boolean, state string", initial)


def session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams keep state in RocksDB; the caller's own settings stay."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return own


def drain(stream: DataFrame, checkpoint: str) -> StreamingQuery:
    """Bring the state up to all there is. The touched rows go nowhere: the state is the result."""
    return stream.writeStream.format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("update").start()


def _state(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()


def relationships_of(spark: SparkSession, checkpoint: str, story: list[str]) -> DataFrame:
    """(story, character, target, opinion, opinion_at, events): the state of a query's last trigger."""
    key = [*story, "character", "target"]
    own = [F.col(f"key.{k}").alias(k) for k in key]
    said = _state(spark, checkpoint, "opinion").select(*own, F.when(F.col("value.opinion").isNotNull(), F.col("value.at")).alias("opinion_at"), F.col("value.opinion").alias("opinion"))
    told = _state(spark, checkpoint, "events").select(*own, F.struct(F.col("list_element.at").alias("at"), F.col("list_element.event").alias("event")).alias("e"))
    listed = told.groupBy(*key).agg(F.array_sort(F.collect_list("e")).alias("events"))
    return said.join(listed, key, "full").select(*key, "opinion", "opinion_at", F.coalesce("events", F.array().cast("array<struct<at:bigint,event:string>>")).alias("events"))


def items_of(spark: SparkSession, checkpoint: str, story: list[str]) -> DataFrame:
    """(story, character, item_name, removed, updates): the state of a query's last trigger."""
    key = [*story, "character", "item_name"]
    own = [F.col(f"key.{k}").alias(k) for k in key]
    updates = F.arrays_zip(*[F.col(f"value.{c}").alias(c) for c in ("at", "action", "new_state")])
    return _state(spark, checkpoint, "item").select(*own, F.col("value.removed").alias("removed"), updates.alias("updates"))


def relationships(snapshot: DataFrame) -> DataFrame:
    """A snapshot as the rows of ``state.relationship_fold``."""
    return snapshot.withColumn("events", F.transform("events", lambda e: e["event"])).drop("opinion_at")


def items(snapshot: DataFrame, story: list[str]) -> DataFrame:
    """A snapshot as the rows of ``state.item_fold``."""
    from storyloom.operators import state

    each = snapshot.select(*story, "character", "item_name", F.explode("updates").alias("u")).select(*story, "character", "item_name", "u.*")
    return state.item_fold(each, story, "at")


def from_relationships(folded: DataFrame, at: int = FIRST) -> DataFrame:
    """A batch fold's rows as a snapshot to begin from; what they hold has orders from ``at`` on, so give one that lies before all updates to come."""
    events = F.transform("events", lambda e, i: F.struct((F.lit(at).cast("long") + i).alias("at"), e.alias("event")))
    return folded.withColumn("events", events).withColumn("opinion_at", F.lit(at).cast("long"))


def from_items(folded: DataFrame, at: int = FIRST) -> DataFrame:
    """A batch fold's rows as a snapshot to begin from: each item as one addition with the order ``at``."""
    held = F.array(F.struct(F.lit(at).cast("long").alias("at"), F.lit("add").alias("action"), F.col("state").alias("new_state")))
    return folded.withColumn("updates", held).withColumn("removed", F.lit(None).cast("long")).drop("state")
