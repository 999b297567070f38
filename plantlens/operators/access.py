"""Plant-scoped row-level access."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Teaching users and the plant each one sees.
PLANT_USERS = (
    ("plant_p01_user", "Plant_P01_Viewer", "P01", "Teaching RLS example: user can see only Plant P01."),
    ("plant_p02_user", "Plant_P02_Viewer", "P02", "Teaching RLS example: user can see only Plant P02."),
    ("plant_p03_user", "Plant_P03_Viewer", "P03", "Teaching RLS example: user can see only Plant P03."),
)
USER_SCHEMA = "username string, role_name string, plant_id string, policy_note string"


def user_plant_map(plants: DataFrame, users=PLANT_USERS) -> DataFrame:
    """The administrator on every plant, plus the listed users."""
    admin = plants.select(
        F.lit("admin").alias("username"),
        F.lit("Admin").alias("role_name"),
        "plant_id",
        F.lit("Administrator can see all plants.").alias("policy_note"),
    )
    return admin.unionByName(plants.sparkSession.createDataFrame(list(users), USER_SCHEMA))


def visible_to(df: DataFrame, user_plants: DataFrame, username: str) -> DataFrame:
    """Rows of the plants mapped to ``username``.

    A semi join: rows without a plant are visible to nobody, an unknown user
    sees nothing, and the name is a bound literal, never pasted into SQL text.
    """
    granted = user_plants.filter(F.col("username") == F.lit(username)).select("plant_id")
    return df.join(granted, "plant_id", "left_semi")
