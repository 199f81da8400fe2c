"""Column tags and tag-driven masking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = "pii_policy_tag"
# The tag's allowed values and the text each masked column shows.
ALLOWED_TAGS = ("PII", "PRICE", "SENSITIVE", "EMAIL")
MASKS = {"PII": "** PII **", "EMAIL": "** EMAIL **", "SENSITIVE": "** Phone **"}


def tag_columns(df: DataFrame, tags: dict[str, str]) -> DataFrame:
    """Attach a tag to columns as field metadata, which travels with select, join and parquet."""
    unknown = sorted(set(tags.values()) - set(ALLOWED_TAGS))
    if unknown:
        raise ValueError(f"tag values not allowed: {unknown}")
    for c, tag in tags.items():
        df = df.withMetadata(c, {**df.schema[c].metadata, TAG: tag})
    return df


def tags_of(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata[TAG] for f in df.schema.fields if TAG in f.metadata}


def check_tags(df: DataFrame) -> DataFrame:
    """Per tagged column: its tag, whether the tag is allowed, and how many values it covers."""
    tags = tags_of(df)
    row = df.agg(*[F.count(c).alias(c) for c in tags])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("tag"), F.lit(t in ALLOWED_TAGS).alias("allowed"), F.col(c).alias("tagged_values"))
        for c, t in tags.items()
    ]
    return row.select(F.inline(F.array(*rows)))


def mask_by_tag(
    df: DataFrame, masks: dict[str, str] | None = None, expected: dict[str, str] | None = None
) -> DataFrame:
    """Replace every tagged column by its mask text; tags without a mask stay readable.

    ``expected`` are the tags a table must have: one that got lost on the way fails the query
    instead of leaving the column readable.
    """
    chosen = MASKS if masks is None else masks
    tags = tags_of(df)
    lost = {c: t for c, t in (expected or {}).items() if c in df.columns and tags.get(c) != t}
    if lost:
        raise ValueError(f"tags are missing: {lost}")
    return df.select(
        *[
            F.lit(chosen[tags[c]]).alias(c) if tags.get(c) in chosen else F.col(c)
            for c in df.columns
        ]
    )
