"""Defaults of every step (fixed values of the method)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Counting:
    min_dp: int = 5
    min_cc: int = 5
    min_bq: int = 20
    min_mq: int = 60
    min_ac: int = 0
    max_depth: int | None = None


@dataclass(frozen=True)
class Calling:
    min_cov: int = 5
    min_cells: int = 5
    min_ac_cells: int = 2
    min_ac_reads: int = 3
    max_cell_types: int = 1
    min_cell_types: int = 2
    fisher_cutoff: float = 1.0
    reads_ab: tuple[float, float] = (0.21356677091082193, 104.95163748636298)
    cells_ab: tuple[float, float] = (0.2474528917555431, 162.03696139428595)


@dataclass(frozen=True)
class Annotation:
    min_distance: int = 0
    max_af: float = 0.01


@dataclass(frozen=True)
class Final:
    delta_vaf: float = 0.05
    delta_mcf: float = 0.3
    min_ac_reads: int = 3
    min_ac_cells: int = 2
    clust_dist: int = 10_000
    chrm_contaminant: bool = True
    strict_compat: bool = False


@dataclass(frozen=True)
class Hccv:
    min_dp: int = 50
    delta_vaf: float = 0.2
    delta_mcf: float = 0.25
    clust_dist: int = 10_000
    strict_compat: bool = False


@dataclass(frozen=True)
class Reannotation:
    min_variants: int = 3
    min_fraction: float = 0.25


@dataclass(frozen=True)
class Fusion:
    min_ac_reads: int = 3
    min_ac_cells: int = 2
    max_mcf_noncancer: float = 0.1
    delta_mcf: float = 0.3


@dataclass(frozen=True)
class Genotype:
    min_bq: int = 30
    min_mq: int = 60
    alt_flag: str = "All"
    p_value: float = 0.01
    chrm_vaf: float = 0.3
    chrm_contaminant: bool = True
    cells_ab: tuple[float, float] = Calling.cells_ab


@dataclass(frozen=True)
class Matrix:
    min_cells_per_mut: int = 5
    min_pos_cov: int = 3


@dataclass(frozen=True)
class Clustering:
    steps: int = 1000
    chains: int = 4
    burn_in: float = 0.33
    fn: float = 0.1
    fp: float = 0.01
    prior: tuple[float, float] = (1.0, 1.0)
    dp_alpha: tuple[float, float] = (0.001, 5.0)
    seed: int = 42
    #: The run ends below this scale reduction factor, looked at every check_every steps.
    psrf_cutoff: float | None = None
    check_every: int = 50


@dataclass(frozen=True)
class Params:
    counting: Counting = field(default_factory=Counting)
    calling: Calling = field(default_factory=Calling)
    annotation: Annotation = field(default_factory=Annotation)
    final: Final = field(default_factory=Final)
    hccv: Hccv = field(default_factory=Hccv)
    reannotation: Reannotation = field(default_factory=Reannotation)
    fusion: Fusion = field(default_factory=Fusion)
    genotype: Genotype = field(default_factory=Genotype)
    matrix: Matrix = field(default_factory=Matrix)
    clustering: Clustering = field(default_factory=Clustering)
