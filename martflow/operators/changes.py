"""Database change events: normalize, filter, route, fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow import schemas
from martflow.functions.text import map_text

# Operation letters of the capture envelope and their names.
OPERATIONS = {"c": "insert", "r": "read", "u": "update", "d": "delete"}


def _empty_map() -> Column:
    return F.from_json(F.lit("{}"), "map<string,string>")


def normalize_envelopes(envelopes: DataFrame) -> DataFrame:
    """Capture envelopes to change events.

    A created row is an ``insert``, the other operations keep their lower-case
    names.  ``data`` is the row after the change, empty after a delete.  Other
    columns of the input are kept, ``before`` among them.
    """
    named = F.coalesce(
        *[F.when(F.col("op") == letter, name) for letter, name in OPERATIONS.items()],
        F.when(F.lower("op") == "create", "insert"),
        F.lower("op"),
    )
    kept = [c for c in envelopes.columns if c not in ("op", "after", "source")]
    return envelopes.select(
        *kept,
        F.col("source.db").alias("database"),
        F.col("source.table").alias("table"),
        named.alias("type"),
        F.coalesce("after", _empty_map()).alias("data"),
    )


def row_value(changes: DataFrame, column: str) -> Column:
    """A column of the changed row; of the row before the change where none is after."""
    value = F.col("data")[column]
    if "before" not in changes.columns:
        return value
    return F.coalesce(value, F.col("before")[column])


def valid_changes(changes: DataFrame) -> DataFrame:
    """Changes that name a table and whose data text is longer than 3 characters.

    A delete has no row after it; it is valid if it says which row was there.
    """
    filled = F.coalesce(F.length(map_text("data")) > 3, F.lit(False))
    if "before" in changes.columns:
        gone = F.col("type").eqNullSafe("delete")
        filled = filled | (gone & F.coalesce(F.length(map_text("before")) > 3, F.lit(False)))
    return changes.where((F.length("table") > 0) & filled)


def latest_rows(
    changes: DataFrame, keys: list[str], order: list[str], keep_deleted: bool = False
) -> DataFrame:
    """The last change of each key; keys whose last change is a delete go.

    A key that is no column of ``changes`` is one of the changed row (``row_value``).
    An aggregate, not a ranking: a key with a third of all changes leaves one
    row per map task.
    """
    added = {k: row_value(changes, k) for k in keys if k not in changes.columns}
    columns = [*changes.columns, *added]
    rest = [c for c in changes.columns if c not in keys]
    last = changes.withColumns(added).groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("r")
    )
    if not keep_deleted:
        last = last.where(~F.col("r.type").eqNullSafe("delete"))
    return last.select(*keys, "r.*").select(columns)


def change_table(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Snapshot rows and the changes after it as one change-event frame.

    ``snapshot`` has the columns of ``changes``; its rows are typed ``read``.
    """
    return snapshot.withColumn("type", F.lit("read")).unionByName(changes)


def latest_config(config_changes: DataFrame, order: list[str]) -> DataFrame:
    """Routing rules in force, from the config table's change events.

    A rule replaces the earlier one of the same table and operation; a deleted
    row takes its rule away.  ``before`` names the row where ``data`` is empty.
    """
    has_before = "before" in config_changes.columns
    row = (
        F.when(F.col("type") == "delete", F.col("before")).otherwise(F.col("data"))
        if has_before
        else F.col("data")
    )
    fields = [row[name].alias(name) for name in schemas.ROUTING.names]
    rules = config_changes.select("type", *order, *fields).where(
        F.col("source_table").isNotNull()
    )
    return latest_rows(rules, ["source_table", "operate_type"], order).select(
        schemas.ROUTING.names
    )


def rule_versions(config_changes: DataFrame, at: str, order: list[str] | None = None) -> DataFrame:
    """Every rule there ever was, with the stretch of positions it was in force.

    ``at`` is where a rule change stands, in the terms of the changes that will be routed:
    a time or an offset.  A version holds from ``since`` to before ``until``, the place of
    the next change of the same table and operation, or without end; a deleted rule ends,
    and so does one whose row goes over to another table or operation.  Of changes at one
    place the last by ``order`` counts.  The window runs over the history of one rule.
    """
    order = [at, *(order or [])]
    empty = _empty_map()
    before = F.col("before") if "before" in config_changes.columns else F.lit(None)
    before = F.coalesce(before.cast("map<string,string>"), empty)
    after = F.coalesce(F.when(~F.col("type").eqNullSafe("delete"), F.col("data")), empty)
    ended = F.struct(before.alias("rule"), F.lit(False).alias("holds"))
    started = F.struct(after.alias("rule"), F.lit(True).alias("holds"))
    ends = F.explode(F.array(ended, started)).alias("step")
    keys = ["source_table", "operate_type"]
    steps = config_changes.select(*order, ends).select(
        *order,
        F.col("step.holds").alias("holds"),
        *[F.col("step.rule")[name].alias(name) for name in schemas.ROUTING.names],
    )
    # A change ends what was in force and starts anew, in this order at one place.
    along = Window.partitionBy(*keys).orderBy(*order, "holds")
    steps = steps.where(F.col("source_table").isNotNull())
    steps = steps.withColumn("until", F.lead(at).over(along))
    held = steps.where(F.col("holds") & (F.col("until").isNull() | (F.col("until") > F.col(at))))
    return held.select(*schemas.ROUTING.names, F.col(at).alias("since"), "until")


def _meets(at: str, since: Column, until: Column) -> Column:
    """Whether a change stands where a rule version was in force."""
    place = F.col(at)
    return F.coalesce((place >= since) & (until.isNull() | (place < until)), F.lit(False))


def project_columns(data: Column | str, columns: Column | str) -> Column:
    """Keep the map entries a comma list names; an empty list keeps all."""
    data = F.col(data) if isinstance(data, str) else data
    columns = F.col(columns) if isinstance(columns, str) else columns
    names = F.split(columns, ",", -1)
    wanted = F.map_filter(data, lambda name, _: F.array_contains(names, name))
    return F.when(F.coalesce(F.length(columns), F.lit(0)) == 0, data).otherwise(wanted)


def _with_rules(changes: DataFrame, config: DataFrame, kept: list[str]) -> DataFrame:
    """Changes, typed as rules name operations, beside the rules of their table and type."""
    rules = config.select(
        F.col("source_table").alias("table"),
        F.col("operate_type").alias("type"),
        "sink_type",
        "sink_table",
        "sink_columns",
        F.coalesce("sink_pk", F.lit("id")).alias("sink_pk"),
        *kept,
    )
    return _typed(changes).join(rules, ["table", "type"])


def _typed(changes: DataFrame) -> DataFrame:
    inserted = F.col("type").isin(schemas.BOOTSTRAP_INSERT, "read")
    return changes.withColumn("type", F.when(inserted, "insert").otherwise(F.col("type")))


def _served() -> Column:
    return F.col("sink_type").isin(schemas.SINK_DIMENSION, schemas.SINK_FACT)


def route_changes(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Give each change its sink by (table, operation); no rule, no output.

    Bootstrap inserts and the rows of a snapshot count as inserts.  Adds ``sink_type``, ``sink_table``,
    ``sink_pk`` and cuts ``data`` to the rule's columns.  Only dimension and
    fact sinks are served.  ``config`` holds one rule per table and operation.
    """
    return _routed(_with_rules(changes, config.where(_served()), []), changes.columns)


def _routed(met: DataFrame, columns: list[str]) -> DataFrame:
    cut = met.withColumn("data", project_columns("data", "sink_columns"))
    return cut.select(*columns, "sink_type", "sink_table", "sink_pk")


def route_changes_as_of(changes: DataFrame, versions: DataFrame, at: str = "at") -> DataFrame:
    """:func:`route_changes` by the rule in force where each change stands.

    ``versions`` are those of :func:`rule_versions`, ``at`` is the place of a change in
    the same terms.  What was routed does not hang on when it was: a rule that changes in
    the middle of a micro-batch routes both halves rightly, and a rerun in batch agrees.
    """
    met = _with_rules(changes, versions.where(_served()), ["since", "until"])
    return _routed(met.where(_meets(at, F.col("since"), F.col("until"))), changes.columns)


def without_rule(changes: DataFrame, versions: DataFrame, at: str = "at") -> DataFrame:
    """Changes that a rule would take, but none was in force where they stand.

    Those from before the first rule of their table and operation, and after its end.
    Changes of tables and operations no rule ever named are not among them.
    """
    keys = ["table", "type"]
    rules = versions.select(
        F.col("source_table").alias("table"), F.col("operate_type").alias("type"), "since", "until"
    )
    # One row per rule: a change joins its rule's stretches, not each of them.
    stretches = rules.groupBy(*keys).agg(
        F.collect_list(F.struct("since", "until")).alias("_stretches")
    )

    def meets(stretch: Column) -> Column:
        return _meets(at, stretch["since"], stretch["until"])

    typed = _typed(changes.withColumn("_as", F.col("type")))
    missed = typed.join(stretches, keys).where(~F.exists("_stretches", meets))
    return missed.withColumn("type", F.col("_as")).select(changes.columns)


def handed_over(chunks: DataFrame, log: DataFrame) -> DataFrame:
    """A table's rows, read in chunks while it changed, and its log, as one change frame.

    ``log`` holds the changes from where the first chunk was begun, or from earlier;
    ``chunks`` holds ``read`` rows with the same columns, each at the log's position
    when its chunk was begun.  A chunk's row stands for all changes up to there; later
    ones come after it, also those that the chunk may have seen already.  So the fold of
    the result by (position, ``_read``), as ``latest_rows`` makes it, is the table at the
    log's end, in whatever order chunks and changes were taken.  Nothing is locked.
    """
    read = chunks.withColumn("_read", F.lit(True))
    return read.unionByName(log.withColumn("_read", F.lit(False)))


def handover_table(
    chunks: DataFrame, log: DataFrame, keys: list[str], position: str = "position"
) -> DataFrame:
    """The table at the log's end; see :func:`handed_over`."""
    both = handed_over(chunks, log)
    return latest_rows(both, keys, [position, "_read"]).drop("_read")


def dimension_changes(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("sink_type") == schemas.SINK_DIMENSION)


def fact_messages(routed: DataFrame) -> DataFrame:
    """Topic and message text of each change that goes to a fact topic."""
    return routed.where(F.col("sink_type") == schemas.SINK_FACT).select(
        F.col("sink_table").alias("topic"), map_text("data").alias("value")
    )


def fold_dimension(
    changes: DataFrame,
    columns: list[str],
    pk: str = "id",
    order: list[str] | None = None,
    keep_state: bool = False,
) -> DataFrame:
    """Fold upserts into one row per primary key.

    ``changes`` has ``type``, ``data`` and the ``order`` columns.  A message
    writes only the columns it carries, a null as an empty text; a delete takes
    the row away with everything written before it, and finds it by ``before``
    where its ``data`` is empty.  With ``keep_state`` each
    column comes as a struct of its value and the order it was written at, and
    deleted keys stay, so that the result can be folded again with later ones.
    """
    order = order or ["seq"]
    at = F.struct(*order)
    deleted = F.col("type").eqNullSafe("delete")
    aggregates = [
        F.max(F.when(deleted, at)).alias("_deleted_at"),
        F.max(F.when(~deleted, at)).alias("_written_at"),
    ]
    for name in columns:
        carried = F.map_contains_key("data", F.lit(name)) & ~deleted
        aggregates.append(
            F.max_by(
                F.struct(F.coalesce(F.col("data")[name], F.lit("")).alias("value"), at.alias("at")),
                F.when(carried, at),
            ).alias(name)
        )
    key = row_value(changes, pk)
    folded = changes.where(key.isNotNull()).groupBy(key.alias("_pk")).agg(*aggregates)
    if keep_state:
        return folded
    return visible_rows(folded, columns, pk)


def merge_folds(folds: DataFrame, columns: list[str]) -> DataFrame:
    """Fold several results of ``fold_dimension(keep_state=True)`` into one."""
    return folds.groupBy("_pk").agg(
        F.max("_deleted_at").alias("_deleted_at"),
        F.max("_written_at").alias("_written_at"),
        *[F.max_by(name, F.col(name)["at"]).alias(name) for name in columns],
    )


def visible_rows(folded: DataFrame, columns: list[str], pk: str = "id") -> DataFrame:
    """Rows that a delete has not taken away, as plain text columns."""
    gone = F.col("_deleted_at")
    alive = gone.isNull() | (F.col("_written_at") > gone)
    values = [
        F.col("_pk").alias(name)
        if name == pk
        else F.when(
            gone.isNull() | (F.col(name)["at"] > gone), F.col(name)["value"]
        ).alias(name)
        for name in columns
    ]
    return folded.where(F.col("_written_at").isNotNull() & alive).select(values)
