"""Parameters of the lakehouse: fixed values of the domain and tunable settings."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

# --- Fixed values (must equal the published data contract) -------------------
TRANSMETRO = "TRANSMETRO"
TRANSURBANO = "TRANSURBANO"
METRORIEL = "METRORIEL"
AEROMETRO = "AEROMETRO"

# operador, nombre, modo, unidades_infra
OPERATORS = [
    (TRANSMETRO, "Transmetro", "BRT (bus articulado)", 8),
    (TRANSURBANO, "Transurbano", "Bus urbano", 41),
    (METRORIEL, "MetroRiel", "Tren ligero", 1),
    (AEROMETRO, "Aerometro", "Teleferico urbano", 2),
]
OPERATOR_CODES = [TRANSMETRO, TRANSURBANO, METRORIEL, AEROMETRO]
LINKED_OPERATORS = [TRANSMETRO, TRANSURBANO, METRORIEL]  # card digits name the person

PEAK_HOURS = [5, 6, 7, 8, 16, 17, 18, 19]
CITY_ZONES = 25
UTC_OFFSET_HOURS = -6  # the country keeps one offset all year

STATUS_OK_CODES = [1, 2, 3]
STATUS_NO_BALANCE = 7
STATUS_BAD_CARD = 9

REASON_DUPLICATE = "duplicado_torniquete"
REASON_FUTURE = "fecha_futura"
REASON_NO_STOP = "parada_nula"
REASON_NO_EXIT = "viaje_sin_salida"
REASON_REJECTED = "transaccion_no_exitosa"
REASON_MALFORMED = "formato_invalido"  # ours: rows whose id or time cannot be read
# --- end of fixed values ------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """What a run depends on besides its input files."""

    as_of: datetime  # local wall clock of the load; replaces current_timestamp
    salt: str  # pseudonym salt, deliberately without a default


@dataclass(frozen=True)
class CutWindows:
    """Windows around a cut date, in days."""

    window: int = 28
    short: int = 7
    half: int = 14
    horizon: int = 30
    min_trips: int = 2


@dataclass(frozen=True)
class CostScenario:
    """Economics of a retention call."""

    contact_cost: float = 5.0
    retention_rate: float = 0.25
    retained_value: float = 60.0

    @property
    def gain_tp(self) -> float:
        return self.retention_rate * self.retained_value - self.contact_cost

    @property
    def gain_fp(self) -> float:
        return -self.contact_cost

    @property
    def theoretical_threshold(self) -> float:
        return self.contact_cost / (self.retention_rate * self.retained_value)


CUTS = {"A": date(2026, 7, 1), "B": date(2026, 7, 31), "C": date(2026, 8, 30)}
SEED = 42
FOLDS = 5


@dataclass(frozen=True)
class ModelGrid:
    """Hyper-parameters of the compared models."""

    lambdas: tuple = tuple(10 ** (-3 + 0.5 * i) for i in range(13))
    penalties: dict = field(
        default_factory=lambda: {"L2": 0.0, "L1": 1.0, "Elastic Net (l1_ratio=0.5)": 0.5}
    )
    lr_max_iter: int = 3000
    lr_tol: float = 1e-4
    gbt_rounds: int = 300
    gbt_step: float = 0.05
    gbt_depth: int = 5  # of Spark's trees, at most 32 leaves
    gbt_min_leaf: int = 100
    gbt_leaves: int = 31
    gbt_l2: float = 1.0
    rf_trees: int = 300
    rf_min_leaf: int = 20
    rf_depth: int = 20
    permutation_repeats: int = 5
    kmeans_k: tuple = tuple(range(2, 9))
    kmeans_restarts: int = 10
