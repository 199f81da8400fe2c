"""Upsert as a join: the new table and its change rows come from one full outer join."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.keys import surrogate_key
from plinth.operators.latest import latest_per_key, single_per_key


def any_differs(left: str, right: str, cols: list[str]) -> Column:
    """True when at least one field of two struct columns differs; NULL equals NULL."""
    return reduce(
        lambda a, b: a | b, [~F.col(left)[c].eqNullSafe(F.col(right)[c]) for c in cols]
    )


def change_rows(old: Column, new: Column) -> Column:
    """Change rows of one key: an update is the old row as DELETE and the new one as INSERT."""

    def row(action: str, is_update: Column, image: Column) -> Column:
        return F.struct(
            F.lit(action).alias("_action"), is_update.alias("_is_update"), image.alias("_row")
        )

    both = old.isNotNull() & new.isNotNull()
    return F.when(both, F.array(row("DELETE", F.lit(True), old), row("INSERT", F.lit(True), new))).when(
        new.isNotNull(), F.array(row("INSERT", F.lit(False), new))
    ).otherwise(F.array(row("DELETE", F.lit(False), old)))


def fields(struct: str, columns: list[str], metadata: dict[str, dict]) -> list[Column]:
    """Columns out of a struct, with the metadata (such as tags) that a struct does not carry."""
    return [
        F.col(struct)[c].alias(c, metadata=metadata[c]) if metadata.get(c) else F.col(struct)[c].alias(c)
        for c in columns
    ]


def metadata_of(*tables: DataFrame) -> dict[str, dict]:
    """Metadata by column; the first table that has some for a column wins."""
    found: dict[str, dict] = {}
    for df in tables:
        for f in df.schema.fields:
            if f.metadata:
                found.setdefault(f.name, f.metadata)
    return found


@dataclass(frozen=True)
class Merged:
    """Result of :func:`merge`: one row per key with its old and new image.

    Table and changes are separate lazy views, so the source should be stored (or free of functions
    like ``current_timestamp``) when both are written.
    """

    rows: DataFrame
    columns: list[str]
    metadata: dict[str, dict]

    def table(self) -> DataFrame:
        """The target after the merge."""
        return self.rows.select(*fields("_new", self.columns, self.metadata))

    def changes(self) -> DataFrame:
        """``_action``, ``_is_update`` and the row image of everything the merge touched."""
        touched = self.rows.where(F.col("_op") != "keep")
        exploded = touched.select(F.explode(change_rows(F.col("_old"), F.col("_new"))).alias("c"))
        return exploded.select("c._action", "c._is_update", *fields("c._row", self.columns, self.metadata))


def without_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows :func:`merge` cannot place; callers quarantine them."""
    return df.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    *,
    update: list[str] | None = None,
    only_if_changed: list[str] | None = None,
    order_by: list[str] | None = None,
    newer_than: str | None = None,
    number: str | None = None,
) -> Merged:
    """Update matched rows, insert the others.

    ``update``: columns a match overwrites (default: all). ``only_if_changed``: update only when
    one of these differs. ``order_by``: keep the newest source row per key; without it, two
    source rows for one key fail the query. ``newer_than``: a match counts only if the source has
    a later (or first) value in this column, so a late row never replaces a newer one. ``number``:
    surrogate key column of the target; inserted rows go on from its largest number. Source rows
    with a NULL key take no part. Column metadata, such as tags, stays.
    """
    placed = without_null_keys(source, keys)
    unique = latest_per_key(placed, keys, order_by) if order_by else single_per_key(placed, keys)

    if number:
        fresh = unique.select(*keys).join(target.select(*keys), keys, "left_anti")
        last = target.agg(F.coalesce(F.max(number), F.lit(0))).scalar()
        unique = unique.drop(number).join(surrogate_key(fresh, keys, number, last), keys, "left")
    old = target.select(*[F.col(k).alias(f"_old_{k}") for k in keys], F.struct("*").alias("_old"))
    src = unique.select(*[F.col(k).alias(f"_src_{k}") for k in keys], F.struct("*").alias("_src"))
    on = [F.col(f"_old_{k}") == F.col(f"_src_{k}") for k in keys]
    joined = old.join(src, reduce(lambda a, b: a & b, on), "full_outer")

    inserted = F.col("_old").isNull()
    matched = F.col("_old").isNotNull() & F.col("_src").isNotNull()
    updated = matched & any_differs("_old", "_src", only_if_changed) if only_if_changed else matched
    if newer_than:
        before, now = F.col("_old")[newer_than], F.col("_src")[newer_than]
        updated = updated & F.coalesce(now >= before, before.isNull())
    overwrite = (set(update) if update is not None else set(source.columns) - set(keys)) - {number}

    def image(c: str) -> Column:
        kept = F.col("_old")[c]
        if c not in unique.columns:
            return kept.alias(c)
        given = F.col("_src")[c]
        value = F.when(inserted, given)
        if c in overwrite:
            value = value.when(updated, given)
        return value.otherwise(kept).alias(c)

    op = F.when(inserted, "insert").when(updated, "update").otherwise("keep")
    rows = joined.select(
        op.alias("_op"), "_old", F.struct(*[image(c) for c in target.columns]).alias("_new")
    )
    return Merged(rows, target.columns, metadata_of(target, source))


#: Marks a deleted row in a table that keeps its tombstones.
GONE = "_gone"


@dataclass(frozen=True)
class SoftMerged(Merged):
    """Result of :func:`merge_with_deletes`; :meth:`table` keeps the tombstones, :meth:`live` does not."""

    def live(self) -> DataFrame:
        return live(self.table())

    def changes(self) -> DataFrame:
        """Change rows as a reader of :meth:`live` sees them: a deletion is a DELETE without an INSERT."""
        columns = [c for c in self.columns if c != GONE]

        def image(side: str) -> Column:
            found = F.col(side)
            return F.when(found.isNotNull() & ~found[GONE], F.struct(*[found[c].alias(c) for c in columns]))

        seen = self.rows.where(F.col("_op") != "keep").select(image("_old").alias("_old"), image("_new").alias("_new"))
        touched = seen.where(F.col("_old").isNotNull() | F.col("_new").isNotNull())
        exploded = touched.select(F.explode(change_rows(F.col("_old"), F.col("_new"))).alias("c"))
        return exploded.select("c._action", "c._is_update", *fields("c._row", columns, self.metadata))


def live(table: DataFrame) -> DataFrame:
    """The rows of a table with tombstones that are not deleted."""
    return table.where(~F.col(GONE)).drop(GONE)


def merge_with_deletes(
    target: DataFrame, source: DataFrame, keys: list[str], modified: str, *,
    update: list[str] | None = None, only_if_changed: list[str] | None = None,
) -> SoftMerged:
    """:func:`merge` for sources whose rows may be deletions, in any order of arrival.

    Both tables have the boolean ``GONE``. A deleted row stays as a tombstone with the time of its
    deletion in ``modified``: an older row that comes in late does not bring it back, a newer one
    does. A deletion of an unknown key leaves a tombstone for the same reason. At one time, a
    deletion wins. Tombstones can go (``table.where``) once nothing older can come in any more.
    """
    overwritten = None if update is None else [*dict.fromkeys([*update, GONE, modified])]
    changed = None if only_if_changed is None else [*dict.fromkeys([*only_if_changed, GONE])]
    merged = merge(
        target, source, keys, update=overwritten, only_if_changed=changed, order_by=[modified, GONE], newer_than=modified,
    )
    # a deletion as old as the row it meets counts, a row as old as its deletion does not
    back = (F.col("_op") == "update") & F.col("_old")[GONE] & ~F.col("_new")[GONE]
    tie = back & F.col("_old")[modified].eqNullSafe(F.col("_new")[modified])
    rows = merged.rows.select(
        F.when(tie, "keep").otherwise(F.col("_op")).alias("_op"), "_old", F.when(tie, F.col("_old")).otherwise(F.col("_new")).alias("_new")
    )
    return SoftMerged(rows, merged.columns, merged.metadata)


def deletions(changes: DataFrame, modified: str, at: Column) -> DataFrame:
    """Change rows of a table upstream as a source of :func:`merge_with_deletes`: the newest image of
    each row, with ``GONE`` where it was deleted; a deletion takes ``at`` as its time."""
    deleted = (F.col("_action") == "DELETE") & ~F.col("_is_update")
    images = changes.where(deleted | (F.col("_action") == "INSERT"))
    kind = changes.schema[modified].dataType
    timed = images.withColumn(modified, F.when(deleted, at.cast(kind)).otherwise(F.col(modified)))
    return timed.withColumn(GONE, deleted).drop("_action", "_is_update")


DIGEST = "_digest"


def with_digest(df: DataFrame, compare: list[str]) -> DataFrame:
    """Add a 128-bit digest of the columns that make a difference, to be stored with the row."""
    whole = F.to_json(F.struct(*compare), {"ignoreNullFields": "false"})
    return df.withColumn(DIGEST, F.unhex(F.md5(whole.cast("binary"))))


def merge_by_digest(target: DataFrame, source: DataFrame, keys: list[str], compare: list[str]) -> Merged:
    """:func:`merge` with ``only_if_changed`` that moves keys and digests first, and whole rows of changed keys only.

    ``target`` stores :func:`with_digest` of ``compare``; the source, one row per key, gets its own
    here. The result's rows are those that changed: ``table()`` of it is what has to be written,
    ``changes()`` the change rows. All other rows of the target stay as they are.
    """
    digested = with_digest(without_null_keys(source, keys), compare)
    stored = target.select(*keys, F.col(DIGEST).alias("_stored"))
    changed = single_per_key(digested.select(*keys, DIGEST), keys).join(stored, keys, "left").where(
        ~F.col(DIGEST).eqNullSafe(F.col("_stored"))
    ).select(*keys, F.col("_stored").isNull().alias("_fresh"))
    fresh_or_not = digested.join(changed, keys)
    known = target.join(changed.where(~F.col("_fresh")).select(*keys), keys, "left_semi").select(*target.columns)
    src = fresh_or_not.select(*[F.col(k).alias(f"_src_{k}") for k in keys], F.struct(*target.columns).alias("_new"))
    old = known.select(*[F.col(k).alias(f"_old_{k}") for k in keys], F.struct(*target.columns).alias("_old"))
    on = reduce(lambda a, b: a & b, [F.col(f"_old_{k}") == F.col(f"_src_{k}") for k in keys])
    rows = src.join(old, on, "left").select(
        F.when(F.col("_old").isNull(), "insert").otherwise("update").alias("_op"), "_old", "_new"
    )
    return Merged(rows, target.columns, metadata_of(target, source))
