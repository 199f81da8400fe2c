"""Type-2 dimensions: versions with a validity interval and one current row per live key.

Dimension layout: ``<hk>``, business key, tracked attributes, ``eff_start``, ``eff_end`` (NULL
while open), ``is_current``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.keys import hash_key, with_key
from plinth.operators.merge import any_differs, fields, metadata_of, without_null_keys
from plinth.operators.ordered import ROWS_PER_SLICE, add_slice, big_keys, with_next, with_previous
from plinth.session import stored

MakeKey = Callable[..., Column]


def new_versions(
    rows: DataFrame, key: list[str], tracked: list[str], start: Column, hk: str = "hk",
    hash_cols: list[str] | None = None, make_key: MakeKey = hash_key,
) -> DataFrame:
    """Open versions for the given rows.

    The hash key covers key, tracked columns and start time, so going back to earlier values makes
    a new key; ``hash_cols`` narrows it to a plain attribute hash. ``make_key=digest`` gives the
    wide key that very large dimensions need. Rows with a NULL key open no version.
    """
    body = without_null_keys(rows, key).select(*key, *tracked, start.cast("timestamp").alias("eff_start"))
    return with_key(body, hk, hash_cols or [*key, *tracked, "eff_start"], make_key).select(
        hk, *key, *tracked, "eff_start",
        F.lit(None).cast("timestamp").alias("eff_end"), F.lit(True).alias("is_current"),
    )


def scd2_apply(
    dim: DataFrame, changes: DataFrame, key: list[str], tracked: list[str], as_of: Column, *,
    hk: str = "hk", hash_cols: list[str] | None = None, close_on_delete: bool = True,
    make_key: MakeKey = hash_key, at: str | None = None,
) -> DataFrame:
    """Dimension after a batch of change rows.

    Only open rows take part in the join; closed history passes through untouched. A version is
    opened when a key is new or a tracked column differs (NULL-safe), and the one before closes.
    A key that is deleted and comes back in one batch counts as changed. Applying the same batch
    twice changes nothing. Change rows with a NULL key take no part.

    Without ``at`` all changes happen at ``as_of``: a key may then have one INSERT image only, and
    a batch older than the version it would close fails the query. ``at`` names a column with each
    change's own time: a key's changes are chained, and ``as_of`` is not used.
    """
    wanted = without_null_keys(changes, key).where(
        (F.col("_action") == "INSERT") | (~F.col("_is_update") & F.lit(close_on_delete))
    )
    if at:
        return _chained(dim, wanted, key, tracked, at, hk, hash_cols, make_key)
    inserted = F.col("_action") == "INSERT"
    per_key = wanted.groupBy(*key).agg(
        F.max_by(F.struct(*tracked), inserted).alias("_state"), F.count_if(inserted).alias("_images"),
    )
    one = F.when(
        F.col("_images") > 1, F.raise_error(F.lit(f"several changes of one key ({', '.join(key)}) need their time")).cast("boolean")
    ).otherwise(F.col("_images") == 0)
    src = per_key.select(
        *[F.col(k).alias(f"_s_{k}") for k in key], one.alias("_gone"),
        F.struct(*key, *[F.col("_state")[c].alias(c) for c in tracked]).alias("_src"),
    )
    opened = dim.where(F.col("is_current")).select(
        *[F.col(k).alias(f"_d_{k}") for k in key], F.struct(*dim.columns).alias("_open")
    )
    on = reduce(lambda a, b: a & b, [F.col(f"_d_{k}") == F.col(f"_s_{k}") for k in key])
    joined = opened.join(src, on, "full_outer")

    present = F.col("_open").isNotNull()
    gone = F.coalesce(F.col("_gone"), F.lit(False))
    differs = any_differs("_open", "_src", tracked)
    closes = present & F.col("_src").isNotNull() & (gone | differs)
    opens = F.col("_src").isNotNull() & ~gone & (~present | differs)

    def image(values: dict[str, Column]) -> Column:
        return F.struct(*[values[c].cast(dim.schema[c].dataType).alias(c) for c in dim.columns])

    kept = {c: F.col("_open")[c] for c in dim.columns}
    in_order = as_of.cast(dim.schema["eff_start"].dataType) >= kept["eff_start"]
    closing = F.when(in_order, as_of).otherwise(
        F.raise_error(F.lit("the batch is older than a version it closes")).cast(dim.schema["eff_end"].dataType)
    )
    old = image({**kept, "eff_end": F.when(closes, closing).otherwise(kept["eff_end"]), "is_current": ~closes})
    new = image({
        **{c: F.col("_src")[c] for c in [*key, *tracked]},
        hk: F.lit(None), "eff_start": as_of, "eff_end": F.lit(None), "is_current": F.lit(True),
    })
    # one to two versions per key come out of one join
    versions = (
        F.when(present & opens, F.array(old, new)).when(present, F.array(old)).when(opens, F.array(new))
    )
    after = joined.select(F.explode(versions).alias("v")).select(*fields("v", dim.columns, metadata_of(dim, changes)))
    return _with_closed(dim, _keyed(after, hk, hash_cols or [*key, *tracked, "eff_start"], make_key))


def _keyed(versions: DataFrame, hk: str, cols: list[str], make_key: MakeKey) -> DataFrame:
    """Fill in the hash keys of versions that have none yet."""
    return with_key(versions, "_hk", cols, make_key).withColumn(hk, F.coalesce(hk, "_hk")).drop("_hk")


def _with_closed(dim: DataFrame, versions: DataFrame) -> DataFrame:
    return dim.where(~F.col("is_current")).unionByName(versions.select(*dim.columns)).select(*dim.columns)


def _chained(
    dim: DataFrame, changes: DataFrame, key: list[str], tracked: list[str], at: str, hk: str,
    hash_cols: list[str] | None, make_key: MakeKey, rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Open versions and changes of a key laid on one line of time, each ended by the next."""
    kind = dim.schema["eff_start"].dataType
    inserted = F.col("_action") == "INSERT"
    # at one instant an INSERT wins over a DELETE, and the largest image over the others
    image = F.when(inserted, F.struct(*[F.col(c).cast(dim.schema[c].dataType).alias(c) for c in tracked]))
    happened = changes.groupBy(*key, F.col(at).cast(kind).alias("_at")).agg(F.max(image).alias("_state"))
    line_keys = [*key, "_at"]
    opened = dim.where(F.col("is_current")).select(
        *[F.col(k).alias(f"_open_{k}") for k in key], F.col("eff_start").alias("_open__at"),
        F.struct(*tracked).alias("_first"), F.col(hk).alias("_known"),
    )
    at_once = [F.col(k) == F.col(f"_open_{k}") for k in line_keys]
    was_open, changed = F.col("_open__at").isNotNull(), F.col("_at").isNotNull()
    # a change at the very start of the open version must agree with it
    line = happened.join(opened, reduce(lambda a, b: a & b, at_once), "full_outer").select(
        *[F.coalesce(k, f"_open_{k}").alias(k) for k in line_keys],
        F.when(was_open, F.col("_first")).otherwise(F.col("_state")).alias("_state"),
        F.when(
            was_open & changed & ~F.col("_state").eqNullSafe(F.col("_first")),
            F.raise_error(F.lit("a change at the time its open version began")).cast("boolean"),
        ).otherwise(was_open).alias("_seed"),
        "_known",
    )
    # the line is read several times below, and the next batch reads the versions: both are written once
    line = stored(line, "scd2-line")
    sliced = add_slice(line, key, "_at", big_keys(line, key, "_at", rows_per_slice))
    stepped = with_previous(sliced, key, "_at", ["_state"])
    checked = stepped.withColumn("_seed", F.when(
        F.col("_seed") & F.col("_prev").isNotNull(),
        F.raise_error(F.lit("a change is older than the version it would close")).cast("boolean"),
    ).otherwise(F.col("_seed")))
    begins = F.when(F.col("_prev").isNull(), F.col("_state").isNotNull()).otherwise(
        ~F.col("_prev._state").eqNullSafe(F.col("_state"))
    )
    starts = checked.where(F.col("_seed") | begins).drop("_prev")
    versions = with_next(starts, key, "_at", "_at").where(F.col("_state").isNotNull()).select(
        F.col("_known").alias(hk), *key, *fields("_state", tracked, metadata_of(dim, changes)),
        F.col("_at").alias("eff_start"), F.col("_next").alias("eff_end"), F.col("_next").isNull().alias("is_current"),
    )
    keyed = _keyed(versions, hk, hash_cols or [*key, *tracked, "eff_start"], make_key)
    return _with_closed(dim, stored(keyed.select(*dim.columns), "scd2-versions"))


def scd2_late(
    dim: DataFrame, log: DataFrame, batch: DataFrame, key: list[str], ts: str, tracked: list[str], order_by: list[str], *,
    hk: str = "hk", rows_per_slice: int = ROWS_PER_SLICE, make_key: MakeKey = hash_key,
) -> DataFrame:
    """Dimension after a batch of dated states, however late some of them are.

    ``log`` holds the states of all batches before, ``dim`` is the dimension made of them; ``batch``
    goes into the log afterwards. A state that falls into closed history opens the interval it hits:
    the version there ends at it, and its own version lasts until the key's next known state. A
    dimension alone cannot tell when that is, since it does not keep states that repeated the one
    before; so the keys of the batch, and no others, are built anew from their part of the log. The
    result is that of :func:`scd2_from_log` over all batches, in whatever order they came.

    Two states of a key at one time are told apart by ``order_by``. States with a NULL key take no
    part. The versions of the batch's keys are written once, so a chain of batches reads each once.
    """
    keyed = without_null_keys(batch, key)
    touched = keyed.select(*key).distinct()
    states = log.join(touched, key, "left_semi").select(*log.columns).unionByName(keyed.select(*log.columns))
    built = scd2_from_log(stored(states, "scd2-states"), key, ts, tracked, order_by, hk=hk, rows_per_slice=rows_per_slice, make_key=make_key)
    kinds = {f.name: f.dataType for f in dim.schema.fields}
    versions = stored(built.select(*[F.col(c).cast(kinds[c]).alias(c) for c in dim.columns]), "scd2-versions")
    return dim.join(touched, key, "left_anti").select(*dim.columns).unionByName(versions)


def scd2_match_on(
    dim: DataFrame, changes: DataFrame, key: list[str], tracked: list[str], match_on: list[str],
    as_of: Column, *, hk: str = "hk", hash_cols: list[str] | None = None,
) -> DataFrame:
    """The literal merge form: change rows meet dimension rows on ``match_on`` with plain ``=``.

    A DELETE row of an update closes every version it matches; an INSERT row is added only when
    it matches no version, open or closed. Kept for warehouses that rely on that behaviour;
    :func:`scd2_apply` is the one that keeps a current row for every live key.
    """
    closing = changes.where((F.col("_action") == "DELETE") & F.col("_is_update"))
    hit = closing.select(*match_on).distinct().withColumn("_hit", F.lit(True))
    inserting = changes.where(F.col("_action") == "INSERT")
    after = (
        dim.join(hit, match_on, "left")
        .withColumn("eff_end", F.when(F.col("_hit"), as_of.cast("timestamp")).otherwise(F.col("eff_end")))
        .withColumn("is_current", F.when(F.col("_hit"), F.lit(False)).otherwise(F.col("is_current")))
        .select(*dim.columns)
    )
    fresh = inserting.join(dim.select(*match_on).distinct(), match_on, "left_anti")
    added = new_versions(fresh, key, tracked, as_of, hk, hash_cols)
    return after.unionByName(added).select(*dim.columns)


def empty_dim(rows: DataFrame, key: list[str], tracked: list[str], hk: str = "hk") -> DataFrame:
    """A dimension without rows, typed after ``rows``."""
    return new_versions(rows.limit(0), key, tracked, F.lit(None), hk)


def dim_current(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current"))


def scd2_from_log(
    log: DataFrame, key: list[str], ts: str, tracked: list[str], order_by: list[str], *,
    hk: str = "hk", rows_per_slice: int = ROWS_PER_SLICE, make_key: MakeKey = hash_key,
) -> DataFrame:
    """Build the whole dimension from a change log in one pass over time.

    Rows without a key belong to no version. Rows of a key at the same instant collapse to the last by ``order_by``; a version starts where
    the tracked columns differ from the row before and ends where the next version starts.
    """
    state = F.struct(*tracked)
    log = without_null_keys(log, key)
    instants = log.groupBy(*key, ts).agg(F.max_by(state, F.struct(*order_by)).alias("_state"))
    sliced = add_slice(instants, key, ts, big_keys(log, key, ts, rows_per_slice))
    stepped = with_previous(sliced, key, ts, ["_state"])
    starts = stepped.where(F.col("_prev").isNull() | ~F.col("_prev._state").eqNullSafe(F.col("_state")))
    ended = with_next(starts.drop("_prev"), key, ts, ts)
    body = ended.select(
        *key, "_state.*", F.col(ts).alias("eff_start"), F.col("_next").alias("eff_end")
    )
    return with_key(body, hk, [*key, *tracked, "eff_start"], make_key).select(
        hk, *key, *tracked, "eff_start", "eff_end", F.col("eff_end").isNull().alias("is_current")
    )


def valid_from(dim: DataFrame, key: list[str]) -> DataFrame:
    """Add ``valid_from``: ``eff_start``, but NULL (= always) for a key's first version.

    ``eff_start`` is load time, so without this every fact older than the first load would find
    no version.
    """
    first = dim.groupBy(*key).agg(F.min("eff_start").alias("_first"))
    return (
        dim.join(first, key, "left")
        .withColumn("valid_from", F.when(F.col("eff_start") > F.col("_first"), F.col("eff_start")))
        .drop("_first")
        .select(*dim.columns, "valid_from")
    )
