"""Data model: which column plays which part, and the declared schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SPLITS = ("train", "validation", "test")


@dataclass(frozen=True)
class Roles:
    """Column roles of one flat modelling table."""

    id: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    target: str

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.id, *self.features, self.target)

    def schema(self) -> T.StructType:
        """Declared schema, so that a scan never infers one."""
        return T.StructType(
            [T.StructField(self.id, T.LongType(), False)]
            + [T.StructField(c, T.DoubleType()) for c in self.numeric]
            + [T.StructField(c, T.StringType()) for c in self.categorical]
            + [T.StructField(self.target, T.DoubleType())]
        )


# Column names of the turbine measurement table.
TURBINE = Roles(
    id="record_id",
    numeric=(
        "wind_speed",
        "wind_direction",
        "air_density",
        "temperature",
        "blade_angle",
        "rotor_speed",
        "generator_efficiency",
        "altitude",
        "humidity",
    ),
    categorical=("region", "turbine_id", "maintenance_status", "technician_note"),
    target="power_output",
)

# The stand-in with the same shape that is derived from the order tables.
ORDER_PROFILE = Roles(
    id="record_id",
    numeric=("n_lines", "qty", "disc_pts", "totalprice", "acctbal"),
    categorical=("status", "priority", "segment", "nation"),
    target="target",
)
