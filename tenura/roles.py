"""Which column plays which part in a wide customer table."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, types as T

FLAG_SUFFIX = "_was_missing"

# Column names of the customer table.
TARGET = "churn"
ID_PATTERNS = ("Customer_ID", "vpn_key")
CATEGORICAL = (
    "new_cell", "crclscod", "asl_flag", "prizm_social_one", "area", "dualband", "refurb_new",
    "hnd_webcap", "ownrent", "dwlltype", "marital", "infobase", "HHstatin", "dwllsize", "ethnic",
    "creditcd", "kid0_2", "kid3_5", "kid6_10", "kid11_15", "kid16_17",
)
BINARY = ("truck", "rv", "forgntvl")
BINARY_IN_PROFILE = ("truck", "rv")


@dataclass(frozen=True)
class Roles:
    """Column-role catalogue; every column that no role names is numeric."""

    target: str = TARGET
    id_patterns: tuple[str, ...] = ID_PATTERNS
    categorical: tuple[str, ...] = CATEGORICAL
    binary: tuple[str, ...] = BINARY
    row_id: str = "row_id"

    def for_profile(self) -> "Roles":
        """The profile treats one binary column fewer as a category."""
        return replace(self, binary=tuple(c for c in self.binary if c in BINARY_IN_PROFILE))

    def identifiers(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if any(p in c for p in self.id_patterns)]

    def categories(self, df: DataFrame) -> list[str]:
        declared = (*self.categorical, *self.binary)
        return [c for c in declared if c in df.columns]

    def measures(self, df: DataFrame) -> list[str]:
        """Columns read as decimal-comma numbers: all but target, row id and categories."""
        other = {self.target, self.row_id, *self.categorical, *self.binary}
        return [c for c in df.columns if c not in other]

    def numeric(self, df: DataFrame, *, flags: bool = True) -> list[str]:
        """Columns of a numeric type, without target, row id and binary categories."""
        skip = {self.target, self.row_id, *self.binary}
        return [
            f.name
            for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType)
            and f.name not in skip
            and (flags or not f.name.endswith(FLAG_SUFFIX))
        ]

    def undeclared_text(self, df: DataFrame) -> list[str]:
        declared = {self.target, self.row_id, *self.categorical, *self.binary}
        return [
            f.name
            for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in declared
        ]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "Roles":
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(text).items()})
