"""Profile reads and bulk profile updates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from wardflow.functions import columns as col, constants as c


def profile_list(profiles: DataFrame) -> DataFrame:
    return profiles.orderBy("patient_id")


def profile_of(profiles: DataFrame, patient_id: str) -> DataFrame:
    return profiles.filter(F.col("patient_id") == patient_id).limit(1)


def known_patients(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """Rows of patients that have a profile.

    A left semi join: adaptive execution broadcasts the ids only when their measured size is small,
    and otherwise splits the partition of a hot patient. Where rows are aggregated by patient next,
    aggregate first and restrict the result.
    """
    return df.join(profiles.select("patient_id"), "patient_id", "left_semi")


def edit_patches(edits: DataFrame, as_of: datetime | str) -> DataFrame:
    """Patches from edit forms (patient_id, seq, name, email, phone, medical_notes).

    Text is stripped, an edit without a name is rejected, contact_info is replaced as a whole and
    last_updated becomes ``as_of``.
    """
    return edits.select(
        "patient_id",
        "seq",
        col.strip_text(F.col("name")).alias("name"),
        F.struct(
            col.strip_text(F.col("email")).alias("email"), col.strip_text(F.col("phone")).alias("phone")
        ).alias("contact_info"),
        col.strip_text(F.col("medical_notes")).alias("medical_notes"),
        col.instant(as_of).alias("last_updated"),
    ).filter(F.col("name") != "")


def risk_patches(changed: DataFrame, as_of: datetime | str) -> DataFrame:
    """Patches that store changed risk scores."""
    return changed.select(
        "patient_id",
        F.lit(1).cast("long").alias("seq"),
        "risk_score",
        col.instant(as_of).alias("risk_score_updated_at"),
        F.lit(c.RISK_SOURCE).alias("risk_score_source"),
    )


def apply_patches(profiles: DataFrame, patches: DataFrame) -> DataFrame:
    """Set whole top-level fields of known patients; unknown patients are not inserted.

    Every column of ``patches`` besides patient_id, seq and flags is a field to set, null included.
    A boolean column ``set_<field>`` limits a field to the rows where it is true. Of several
    patches to a field the one with the highest ``seq`` (unique per patient) holds, as if applied one
    after another. That is an aggregate with a partial step, so many patches to one patient do not gather in one task.
    """
    fields = [f for f in patches.columns if f in profiles.columns and f != "patient_id"]
    newest = []
    for f in fields:
        flag = f"set_{f}"
        seq = F.when(F.col(flag), F.col("seq")) if flag in patches.columns else F.col("seq")
        # Wrapped in a struct, so "set to null" differs from "not set".
        newest.append(F.max_by(F.struct(F.col(f).alias("v")), seq).alias(f"_new_{f}"))
    updates = patches.groupBy("patient_id").agg(*newest)
    joined = profiles.join(updates, "patient_id", "left")
    return joined.select(
        *[
            F.when(F.col(f"_new_{f}").isNotNull(), F.col(f"_new_{f}")["v"]).otherwise(F.col(f)).alias(f)
            if f in fields
            else F.col(f)
            for f in profiles.columns
        ]
    )
