"""Parameters of a run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from cytospark.functions.names import X_COLUMN, Y_COLUMN
from cytospark.functions.scalars import NEGATIVE_LABELS


@dataclass(frozen=True)
class RunConfig:
    # Input files.
    folders: Sequence[str] = ()
    extension: str = ".tsv"
    delimiter: str = "\t"
    exclude_markers: str = ""
    slide_by_prefix: bool = False
    folder_is_slide: bool = True
    # Output folder; a run without one leaves only what it returns.
    output: str | None = None
    # Names of columns.
    label: str = "Classification"
    batch: str = "Batch"
    image: str = "Image"
    slide: str = "Slide"
    x: str = X_COLUMN
    y: str = Y_COLUMN
    nuclear_marker: str = "DAPI"
    per_compartment: bool = False
    export_columns: Sequence[str] = (X_COLUMN, Y_COLUMN, "Image", "CellTypePrediction")
    # Normalisation; a name outside the four methods compares all of them.
    normalization: str = "boxcox"
    quantile_references: int = 1024
    exact_quantiles: bool = True
    gate: bool = True
    gate_prefix_match: str = "exact"
    cluster: bool = False
    clusters: int = 10
    # Holdout.
    holdout_fraction: float = 0.1
    minimum_labels: int = 20
    negative_labels: Sequence[str] = tuple(NEGATIVE_LABELS)
    # Feature selection.
    class_limit: int = 3000
    rfe_features: Sequence[int] = (2, 3)
    # Models.
    repeats: int = 10
    depths: Sequence[int] = field(default_factory=lambda: range(2, 11, 3))
    rates: Sequence[float] = (0.1, 1.0)
    rounds: int = 200
    model_kind: str = "boosted"
    # Spatial density.
    bin_size: float = 120.0
    density_cutoff: int = 3
