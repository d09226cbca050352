"""Run settings. Every threshold, seed and bound used by the operators is a field here."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

# Identifier markers looked for inside lower-cased column names.
ID_NAME_PARTS = ("id", "key", "uuid", "index", "serial", "number", "code", "pk", "sk")

# Usual target names, in order of preference.
COMMON_TARGET_NAMES = (
    "target", "label", "class", "output", "result", "prediction", "category", "score", "y",
)

# Stand-in level for a missing categorical value.
MISSING_LEVEL = "__MISSING__"

# Text that readers of delimited files turn into a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Date patterns tried in this order on text columns.
DATE_FORMATS = (
    "yyyy-MM-dd[ HH:mm[:ss[.SSSSSSSSS]]]",
    "yyyy-MM-dd'T'HH:mm[:ss[.SSSSSSSSS]][XXX]",
    "yyyy/MM/dd[ HH:mm[:ss]]",
    "MM/dd/yyyy[ HH:mm[:ss]]",
    "dd-MMM-yyyy[ HH:mm[:ss]]",
    "d MMM yyyy[ HH:mm[:ss]]",
    "MMM d, yyyy[ HH:mm[:ss]]",
)


@dataclass
class SourceSpec:
    """Where a table comes from; stored as JSON so a run can be repeated without questions."""

    kind: str = "file"
    path: str | None = None
    extension: str | None = None
    delimiter: str | None = None
    url: str | None = None
    query: str | None = None
    table: str | None = None
    driver: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "SourceSpec":
        return cls(**json.loads(text))


@dataclass
class RunConfig:
    """Settings of one run; the defaults give the documented behaviour."""

    target_col: str | None = None
    task_type: str | None = None
    key_cols: list[str] | None = None
    seed: int = 42

    column_missing_threshold: float = 0.8
    target_missing_threshold: float = 0.5
    date_formats: tuple[str, ...] = DATE_FORMATS
    date_probe_rows: int = 50

    max_onehot_levels: int | None = None
    kmeans_restarts: int = 10
    kmeans_max_iter: int = 300
    cluster_fit: str = "all"
    test_fraction: float = 0.2

    forest_trees: int = 100
    forest_depth: int = 10
    forest_bins: int = 32
    neighbours: int = 5

    shap_rows: int = 500
    shap_background: int = 100
    # "sample": copies of pdp_rows test rows; "rows": all test rows; "covers": the trees alone.
    pdp_method: str = "sample"
    pdp_rows: int = 500
    pdp_features: int = 6
    pdp_grid: int = 100
    pdp_exclude: list[str] = field(default_factory=list)
    top_features: int = 20
    tree_depth: int = 3

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "RunConfig":
        values = json.loads(text)
        values["date_formats"] = tuple(values["date_formats"])
        return cls(**values)
