"""The way of an entity: landed text -> typed clean table -> type-2 dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.operators import quality
from plinth.operators.masking import tag_columns
from plinth.operators.merge import Merged, merge
from plinth.operators.scd2 import scd2_apply
from plinth.plans.entities import Entity
from plinth.sources.csv_drop import LINEAGE


def quarantine_rules(entity: Entity) -> dict[str, Column]:
    """Why a landed row cannot be merged: wrong delimiter, missing key, text that does not convert."""
    first, second = entity.stage[0], entity.stage[1]
    rules = {
        "wrong delimiter": quality.wrong_delimiter(first, second),
        f"{first} missing": F.col(first).isNull(),
    }
    for c, dtype in entity.must_cast.items():
        rules[f"{c} is not a {dtype.split('(')[0]}"] = quality.not_castable(c, dtype)
    return rules


def tag_stage(stage: DataFrame, entity: Entity) -> DataFrame:
    """Landed rows with the tags of the clean columns that are made of them."""
    return tag_columns(stage, {c: t for c, t in entity.stage_tags.items() if c in stage.columns})


def split_stage(stage: DataFrame, entity: Entity) -> tuple[DataFrame, DataFrame]:
    """Rows that can be merged, and the quarantine with a reason per row."""
    return quality.split_rows(stage, quarantine_rules(entity))


def clean_rows(stage: DataFrame, entity: Entity) -> DataFrame:
    """Typed rows of a landed batch, lineage columns kept, tagged columns tagged."""
    carried = [F.col(c) for c in LINEAGE if c in stage.columns]
    typed = stage.select(*[rule().alias(c) for c, rule in entity.clean.items()], *carried)
    return tag_columns(typed, entity.tags)


def merge_clean(
    target: DataFrame, source: DataFrame, entity: Entity, *, newer_only: bool = False, number: str | None = None
) -> Merged:
    """Upsert a cleaned batch into the entity's clean table, newest row per key.

    ``newer_only`` ignores rows older than what the table holds; ``number`` names the table's
    surrogate key, which inserted rows continue.
    """
    update = entity.update
    if update is not None:
        update = update + [c for c in LINEAGE if c in source.columns]
    return merge(
        target, source, entity.keys, update=update, only_if_changed=entity.only_if_changed,
        order_by=[entity.modified], newer_than=entity.modified if newer_only else None, number=number,
    )


def apply_dim(dim: DataFrame, changes: DataFrame, entity: Entity, as_of: Column) -> DataFrame:
    """Bring the entity's dimension up to date with the change rows of its clean table."""
    return scd2_apply(dim, changes, entity.keys, entity.tracked, as_of, hk=entity.hk, make_key=entity.make_key)
